import pytest
from pyspark.sql import functions as F

from strideframe.functions import hashing, sizing
from strideframe.session import checkpoint_dir


def test_broadcast_only_when_small(spark):
    small = spark.range(10)
    big = spark.range(1000)
    assert "ResolvedHint" in small.join(sizing.broadcast_if_small(small, 100), "id")._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in big.join(sizing.broadcast_if_small(big, 100), "id")._jdf.queryExecution().analyzed().toString()
    with pytest.raises(ValueError):
        sizing.check_rows(101, 100)


def test_checkpoint_dir_is_read_from_session(spark):
    path = checkpoint_dir(spark)
    assert path == spark.conf.get("spark.checkpoint.dir")
    assert checkpoint_dir(spark) == path


def test_bucket_matches_known_value(spark):
    got = spark.range(1).select(hashing.bucket(F.lit(1), 42)).first()[0]
    assert got == 1513
    u = spark.range(2000).select(hashing.hash_normal("id", 7).alias("z")).agg(F.avg("z"), F.stddev("z")).first()
    assert abs(u[0]) < 0.1 and abs(u[1] - 1) < 0.1
