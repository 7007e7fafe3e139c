import os
import tempfile

import pytest
from pyspark.sql import functions as F

from strideframe.sources import matrix


def test_line_numbers_across_many_splits(spark):
    folder = tempfile.mkdtemp(prefix="sf-lines-")
    path = os.path.join(folder, "X.txt")
    with open(path, "w") as fh:
        for i in range(20000):
            fh.write(f"{i} {i * 0.5} {-i}\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        lines = matrix.numbered_lines(spark, [path])
        assert lines.rdd.getNumPartitions() > 4
        m = matrix.parse_matrix(lines, width=3)
        bad = m.where(F.col("features")[0] != F.col("row_id").cast("double")).count()
        assert bad == 0 and m.count() == 20000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_split_files_alignment_and_errors(spark):
    folder = tempfile.mkdtemp(prefix="sf-har-")
    for split in ("train", "test"):
        with open(os.path.join(folder, f"X_{split}"), "w") as fh:
            fh.write("  1.0e-001 -2.5e-001\n 3.0 4.0\n")
        with open(os.path.join(folder, f"y_{split}"), "w") as fh:
            fh.write("1\n9\n")
        with open(os.path.join(folder, f"subject_{split}"), "w") as fh:
            fh.write("3\n4\n")
    both = matrix.load_splits(spark, folder).orderBy("split", "row_id").collect()
    assert len(both) == 4
    first = [r for r in both if r["split"] == "test"][0]
    assert first["features"] == [0.1, -0.25] and first["activity"] == "WALKING" and first["subject_id"] == 3
    assert [r for r in both if r["split"] == "test"][1]["activity"] is None
    with pytest.raises(ValueError):
        matrix.load_split(spark, folder, "validation")
    with open(os.path.join(folder, "y_train"), "a") as fh:
        fh.write("2\n")
    with pytest.raises(ValueError):
        matrix.load_split(spark, folder, "train")
