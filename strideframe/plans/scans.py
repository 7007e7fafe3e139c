"""Scan and sink queries (S1, S3-S7): files written by Spark from the given tables, read back.

The files go to the session's shared checkpoint folder (``spark.checkpoint.dir``).
The embeddings become the reference's three-file split layout: ``X_<split>``
(space-separated features), ``y_<split>`` (activity id = label + 1, so ids 7 to
10 are outside the 6-entry dictionary) and ``subject_<split>`` (vec_id % 30 + 1),
split by ``bucket(vec_id, 42) < 7000`` into train and test.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from strideframe.functions.hashing import bucket, sql_bucket
from strideframe.plans.catalog import register
from strideframe.plans.derived import table
from strideframe.session import checkpoint_dir
from strideframe.sources import matrix

EVENTS_SCHEMA = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"


def _folder(spark, name):
    """A fresh folder for each call: lazy frames of earlier calls still read theirs."""
    return os.path.join(checkpoint_dir(spark), "sources", f"{name}-{uuid.uuid4().hex}")


def write_split_files(spark, d, only: tuple[str, ...] = matrix.SPLITS) -> str:
    out = _folder(spark, "har_layout")
    e = table(spark, d, "embeddings").withColumn("split", F.when(bucket("vec_id", 42) < 7000, "train").otherwise("test"))
    for s in only:
        part = e.where(F.col("split") == s)
        matrix.write_matrix(
            part,
            "vec_id",
            {
                f"X_{s}": matrix.format_row(F.col("embedding")),
                f"y_{s}": (F.col("label") + 1).cast("string"),
                f"subject_{s}": (F.col("vec_id") % 30 + 1).cast("string"),
            },
            out,
        )
    return out


SQL_SPLIT_ROWS = f"""WITH e AS (SELECT *, CASE WHEN {sql_bucket("vec_id", 42)} < 7000 THEN 'train' ELSE 'test' END AS split FROM embeddings)
SELECT split, row_number() OVER (PARTITION BY split ORDER BY vec_id) - 1 AS row_id, label + 1 AS activity_id,
       CAST(vec_id % 30 + 1 AS INTEGER) AS subject_id,
       CASE label + 1 WHEN 1 THEN 'WALKING' WHEN 2 THEN 'WALKING_UPSTAIRS' WHEN 3 THEN 'WALKING_DOWNSTAIRS'
                      WHEN 4 THEN 'SITTING' WHEN 5 THEN 'STANDING' WHEN 6 THEN 'LAYING' END AS activity,
       list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE))) AS feature_sum, len(embedding) AS width
FROM e"""


@register(
    "s1_s4_load_split_files",
    SQL_SPLIT_ROWS,
    floats=["feature_sum"],
)
def s1_s4_load_split_files(spark, d):
    folder = write_split_files(spark, d)
    both = matrix.load_splits(spark, folder)
    return both.select(
        "split", "row_id", "activity_id", "subject_id", "activity",
        F.aggregate("features", F.lit(0.0), lambda a, v: a + v).alias("feature_sum"),
        F.size("features").alias("width"),
    )


@register(
    "s1_named_frame",
    f"""WITH e AS (SELECT *, CASE WHEN {sql_bucket("vec_id", 42)} < 7000 THEN 'train' ELSE 'test' END AS split FROM embeddings),
n AS (SELECT split, row_number() OVER (PARTITION BY split ORDER BY vec_id) - 1 AS row_id, embedding FROM e)
SELECT split, row_id, 'f' || (generate_subscripts(embedding, 1) - 1) AS feature, CAST(unnest(embedding) AS DOUBLE) AS value FROM n""",
    floats=["value"],
)
def s1_named_frame(spark, d):
    """S1 with its names: the wide frame of one named column per feature, checked cell by cell in long form."""
    rows = matrix.load_splits(spark, write_split_files(spark, d))
    width = rows.select(F.max(F.size("features"))).first()[0] or 0
    names = [f"f{i}" for i in range(width)]
    wide = matrix.named_columns(rows, names, ["split", "row_id"])
    return wide.unpivot(["split", "row_id"], names, "feature", "value")


@register(
    "s3_label_dictionary",
    "SELECT DISTINCT activity_id, activity FROM (" + SQL_SPLIT_ROWS + ")",
)
def s3_label_dictionary(spark, d):
    folder = write_split_files(spark, d)
    return matrix.load_splits(spark, folder).select("activity_id", "activity").distinct()


@register(
    "s5_load_one_split",
    "SELECT row_id, activity_id FROM (" + SQL_SPLIT_ROWS + ") WHERE split = 'test'",
)
def s5_load_one_split(spark, d):
    folder = write_split_files(spark, d, ("test",))
    return matrix.load_splits(spark, folder, "test").select("row_id", "activity_id")


def write_events_csv(spark, d) -> str:
    out = _folder(spark, "events_csv")
    ev = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    # several files for the glob, dealt evenly: a user may have a third of all events
    ev.repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))).write.option("header", "true").csv(out)
    return out


@register("s6_csv_glob_scan", "SELECT event_id, user_id, event_type, value FROM events", floats=["value"])
def s6_csv_glob_scan(spark, d):
    out = write_events_csv(spark, d)
    df = matrix.read_csv_glob(spark, f"{out}/part-*.csv", EVENTS_SCHEMA, header="true")
    return df.select("event_id", "user_id", "event_type", "value")


@register(
    "s7_describe_files",
    """SELECT 'value' AS feature, count(value) AS count, avg(value) AS mean, stddev_samp(value) AS std, min(value) AS min,
       quantile_cont(value, 0.25) AS p25, quantile_cont(value, 0.5) AS p50, quantile_cont(value, 0.75) AS p75, max(value) AS max
FROM events""",
    floats=["mean", "std", "min", "p25", "p50", "p75", "max"],
)
def s7_describe_files(spark, d):
    out = write_events_csv(spark, d)
    return matrix.describe_files(spark, f"{out}/part-*.csv", EVENTS_SCHEMA, ["value"], header="true")
