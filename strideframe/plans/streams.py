"""Streaming queries (ST1-ST3): each streams a driver table through ``availableNow``."""

from __future__ import annotations

from pyspark.sql import functions as F

from strideframe.functions.hashing import bucket
from strideframe.plans import experiments as xp
from strideframe.plans import features as feat
from strideframe.plans.catalog import register, with_ctes
from strideframe.plans.derived import SQL_SCORED, SQL_SERIES, centroids, sql_windowed, table
from strideframe.plans.models import SQL_NAMES
from strideframe.streaming import streams as st


@register(
    "st1_stream_scoring",
    with_ctes(
        SQL_SCORED,
        """sm AS (SELECT vec_id, c, exp(-d2 + min(d2) OVER (PARTITION BY vec_id)) AS e FROM dist),
pr AS (SELECT vec_id, c, e / sum(e) OVER (PARTITION BY vec_id) AS p FROM sm)""",
    )
    + f"""SELECT s.vec_id, s.y_pred AS prediction, {SQL_NAMES} AS activity, pr.p AS p_pred
FROM scored s JOIN pr ON pr.vec_id = s.vec_id AND pr.c = s.y_pred""",
    floats=["p_pred"],
)
def st1_stream_scoring(spark, d):
    fitted = centroids(spark, d)
    s = st.score_stream(st.file_stream(spark, d, "embeddings"), "vec_id", "embedding", fitted)
    rows = st.run_available_now(s, "st1")
    return rows.select("vec_id", "prediction", "activity", F.col("probabilities")[F.col("activity")].alias("p_pred"))


_ST2 = [f"{s}_x" for s in st.STATISTICS]


@register(
    "st2_stream_windows",
    with_ctes(SQL_SERIES, sql_windowed(feat.SIZE, feat.STEP))
    + """SELECT user_id, window_id, count(*) AS n, avg(x) AS mean_x, stddev_pop(x) AS std_x, min(x) AS min_x, max(x) AS max_x,
       max(x) - min(x) AS range_x, median(x) AS median_x FROM win GROUP BY user_id, window_id""",
    floats=_ST2,
)
def st2_stream_windows(spark, d):
    """The files of a table are in no order of time: the watermark waits for the table's whole span."""
    ev = st.file_stream(spark, d, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"), "event_id", "value")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    span = table(spark, d, "events").agg(F.max(micros) - F.min(micros)).first()[0] or 0

    def windows(stream):
        return st.stream_windows(stream, "user_id", "ts", "event_id", "value", feat.SIZE, feat.OVERLAP, f"{span // 1_000_000 + 1} seconds")

    return st.run_to_end(windows, ev, "ts", "st2")


def _prediction_stream(spark, d):
    o = st.file_stream(spark, d, "orders")
    assigned = F.when(bucket("o_orderkey", xp.SEED) < 5000, "control").otherwise("treatment")
    variant = F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("treatment")).otherwise(assigned)
    y = (F.col("o_orderstatus") == "F").cast("int")
    right = F.when(variant == "control", bucket("o_orderkey", 7) < 9000).otherwise(bucket("o_orderkey", 8) < 9200)
    return o.select(
        F.col("o_orderkey").alias("sample_id"),
        variant.alias("variant"),
        F.when(right, y).otherwise(1 - y).alias("y_pred"),
        F.col("o_orderdate").cast("timestamp").alias("t_pred"),
    )


def _outcome_stream(spark, d):
    o = st.file_stream(spark, d, "orders")
    return o.select(
        F.col("o_orderkey").alias("sample_id"),
        (F.col("o_orderstatus") == "F").cast("int").alias("y_true"),
        (F.col("o_orderdate").cast("timestamp") + F.expr("INTERVAL 1 DAY")).alias("t_out"),
    )


@register("st3_live_ab", with_ctes(xp.SQL_AB) + "SELECT variant, n, correct, accuracy FROM vm", floats=["accuracy"])
def st3_live_ab(spark, d):
    j = st.live_ab(_prediction_stream(spark, d), _outcome_stream(spark, d), "sample_id")
    return st.run_totals(j, "st3")
