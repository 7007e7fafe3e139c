"""Text-matrix scans and multi-file CSV scans.

The reference stores a split as three aligned text files: a whitespace
separated feature matrix without header, a label file and a subject file,
aligned by LINE POSITION.  Position is a global property of a file, so the
scan numbers lines from the split metadata of the text source (file, block
start) and turns them into an explicit ``row_id`` key; after that everything
is joins on ``row_id``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strideframe.functions.sizing import local_if_small
from strideframe.operators import stats

# The activity dictionary of the reference (ids 1..6).
ACTIVITIES = {1: "WALKING", 2: "WALKING_UPSTAIRS", 3: "WALKING_DOWNSTAIRS", 4: "SITTING", 5: "STANDING", 6: "LAYING"}
SPLITS = ("train", "test")


def numbered_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``row_id, line``: 0-based line numbers over the files in path order, computed in the JVM."""
    return _numbered(spark, paths)[0]


def _numbered(spark: SparkSession, paths: list[str]) -> tuple[DataFrame, int]:
    """Numbered lines and their count.

    A text scan split is a contiguous byte range of one file, and
    ``monotonically_increasing_id`` numbers the rows of a task consecutively, so
    a line's number is the lines of all earlier splits (ordered by file path and
    block start) plus its distance from its split's first row.  The table of
    splits is evaluated once, in a pass that reads no values; no row goes
    through Python.
    """
    lines = spark.read.text(paths).select(
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("_f"),
        F.col("_metadata.file_block_start").alias("_b"),
        F.monotonically_increasing_id().alias("_m"),
    )
    per_split = lines.groupBy("_f", "_b").agg(F.min("_m").alias("_m0"), F.count(F.lit(1)).alias("_n"))
    table, small = local_if_small(per_split)
    order = Window.orderBy("_f", "_b").rowsBetween(Window.unboundedPreceding, -1)
    table = table.withColumn("_off", F.coalesce(F.sum("_n").over(order), F.lit(0)))
    total = table.agg(F.sum("_n")).first()[0] or 0
    numbered = lines.join(F.broadcast(table) if small else table, ["_f", "_b"]).select(
        (F.col("_off") + F.col("_m") - F.col("_m0")).alias("row_id"), "line"
    )
    return numbered, total


def parse_matrix(lines: DataFrame, width: int | None = None) -> DataFrame:
    """Whitespace-separated numbers to ``features array<double>`` (``try_cast``: bad tokens become NULL)."""
    toks = F.split(F.trim(F.col("line")), r"\s+")
    feats = F.transform(toks, lambda t: t.try_cast("double"))
    out = lines.select("row_id", feats.alias("features"))
    if width is not None:
        out = out.withColumn(
            "features", F.when(F.size("features") == width, F.col("features")).otherwise(F.raise_error(F.lit(f"row width is not {width}")))
        )
    return out


def named_columns(matrix: DataFrame, names: list[str], keys: list[str] | None = None) -> DataFrame:
    """S1 + S2: wide frame with one named double column per feature, after the row's ``keys``."""
    return matrix.select(*(keys or ["row_id"]), *[F.col("features")[i].alias(n) for i, n in enumerate(names)])


def activity_name(activity_id: Column) -> Column:
    """S3: dictionary lookup (a literal map, broadcast by construction); unknown ids give NULL."""
    m = F.create_map(*[x for k, v in ACTIVITIES.items() for x in (F.lit(k), F.lit(v))])
    return m[activity_id]


def load_split(spark: SparkSession, split_dir: str, split: str) -> DataFrame:
    """X, y and subject files aligned by line; equal row counts are checked.

    ``split_dir/{X,y,subject}_<split>`` are text files or folders of part files.
    """
    if split not in SPLITS:
        raise ValueError(f"split must be one of {SPLITS}, got {split!r}")
    (x, n_x), (y, n_y), (s, n_s) = (_numbered(spark, _parts(spark, f"{split_dir}/{kind}_{split}")) for kind in ("X", "y", "subject"))
    if len({n_x, n_y, n_s}) != 1:
        raise ValueError(f"X, y and subject row counts differ: {[n_x, n_y, n_s]}")
    x = parse_matrix(x)
    y = y.select("row_id", F.trim("line").try_cast("int").alias("activity_id"))
    s = s.select("row_id", F.trim("line").try_cast("int").alias("subject_id"))
    return (
        x.join(y, "row_id").join(s, "row_id").withColumn("activity", activity_name(F.col("activity_id"))).withColumn("split", F.lit(split))
    )


def load_splits(spark: SparkSession, split_dir: str, split: str | None = None) -> DataFrame:
    """One split, or both unioned with a ``split`` column."""
    if split is not None:
        return load_split(spark, split_dir, split)
    out = None
    for s in SPLITS:
        part = load_split(spark, split_dir, s)
        out = part if out is None else out.unionByName(part)
    return out


def _parts(spark: SparkSession, path: str) -> list[str]:
    """A file, or the part files of a folder written by Spark, in name order."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        raise FileNotFoundError(path)
    if fs.getFileStatus(p).isFile():
        return [path]
    names = sorted(
        st.getPath().toString() for st in fs.listStatus(p) if st.getPath().getName().startswith("part-")
    )
    return names


def write_matrix(df: DataFrame, id_col: str, cols: dict[str, Column], out_dir: str, partitions: int | None = None) -> None:
    """Write aligned text files ``<name>`` (one line per row, ordered by ``id_col``).

    The frame is range-partitioned and sorted on ``id_col`` once; every file is
    written from that same ordering, so part ``k`` of every file holds the same
    rows and line positions agree across files.  ``partitions`` defaults to the
    session's shuffle partitions.
    """
    if partitions is None:
        partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = df.repartitionByRange(partitions, id_col).sortWithinPartitions(id_col).cache()
    for name, col in cols.items():
        ordered.select(col.cast("string").alias("value")).write.mode("overwrite").text(f"{out_dir}/{name}")
    ordered.unpersist()


def format_row(values: Column) -> Column:
    """Space-separated doubles (full precision) of an array."""
    return F.array_join(F.transform(values, lambda v: v.cast("double").cast("string")), " ")


def read_csv_glob(spark: SparkSession, pattern: str, schema: T.StructType | str, **options) -> DataFrame:
    """CSV files by glob with an explicit schema (no inference), options passed through."""
    return spark.read.options(**options).schema(schema).csv(pattern)


def describe_files(spark: SparkSession, pattern: str, schema, columns: list[str] | None = None, **options) -> DataFrame:
    """S6 then ``describe`` (exact quartiles) of the chosen numeric columns (default: all numeric)."""
    df = read_csv_glob(spark, pattern, schema, **options)
    if columns is None:
        columns = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    return stats.describe(df, columns)
