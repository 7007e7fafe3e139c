"""Run and version log queries (R1-R8) on tables derived from ``events``.

``runs``: one run per (event_type, day of month): ``run_id = event_type-day``,
``run_name`` NULL on even days, ``start_time = min(ts)``, metrics
``avg_value``, ``min_value``, ``max_value`` (``max_value`` missing when the day
is a multiple of 7).  ``versions``: ``name = event_type``, version = rank of the
day within the type, stage Production for version 1, Staging for 2, else None.
``loss_log``: ``run_id = user_id``, ``epoch = pos``, ``loss = value``.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from strideframe.operators import runs as rn
from strideframe.plans.catalog import register, with_ctes
from strideframe.plans.derived import SQL_SERIES, series, table

METRICS = ["avg_value", "min_value", "max_value"]


def runs(spark, d):
    ev = table(spark, d, "events").withColumn("day", F.dayofmonth("ts"))
    r = ev.groupBy("event_type", "day").agg(
        F.min("ts").alias("start_time"), F.avg("value").alias("avg_value"), F.min("value").alias("min_value"), F.max("value").alias("max_value")
    )
    return r.select(
        F.concat_ws("-", "event_type", F.col("day").cast("string")).alias("run_id"),
        F.when(F.col("day") % 2 == 0, F.lit(None).cast("string")).otherwise(F.concat_ws("-", "event_type", F.col("day").cast("string"))).alias("run_name"),
        "event_type",
        "day",
        "start_time",
        "avg_value",
        "min_value",
        F.when(F.col("day") % 7 == 0, F.lit(None).cast("double")).otherwise(F.col("max_value")).alias("max_value"),
    )


def metrics_long(spark, d):
    return runs(spark, d).unpivot(["run_id"], METRICS, "metric", "value").where(F.col("value").isNotNull())


def versions(spark, d):
    w = Window.partitionBy("event_type").orderBy("day")
    v = runs(spark, d).select(F.col("event_type").alias("name"), "run_id", F.row_number().over(w).alias("version"))
    return v.withColumn(
        "stage", F.when(F.col("version") == 1, "Production").when(F.col("version") == 2, "Staging").otherwise("None")
    )


SQL_RUNS = """runs AS (
  SELECT event_type || '-' || day AS run_id, CASE WHEN day % 2 = 0 THEN NULL ELSE event_type || '-' || day END AS run_name,
         event_type, day, start_time, avg_value, min_value, CASE WHEN day % 7 = 0 THEN NULL ELSE max_value END AS max_value
  FROM (SELECT event_type, CAST(dayofmonth(ts) AS INTEGER) AS day, min(ts) AS start_time, avg(value) AS avg_value,
               min(value) AS min_value, max(value) AS max_value FROM events GROUP BY 1, 2)),
versions AS (
  SELECT event_type AS name, run_id, CAST(row_number() OVER (PARTITION BY event_type ORDER BY day) AS INTEGER) AS version
  FROM runs),
versions_staged AS (
  SELECT *, CASE WHEN version = 1 THEN 'Production' WHEN version = 2 THEN 'Staging' ELSE 'None' END AS stage FROM versions)"""


@register(
    "r1_best_run",
    with_ctes(SQL_RUNS) + "SELECT run_id, max_value FROM runs WHERE max_value IS NOT NULL ORDER BY max_value DESC, run_id LIMIT 1",
    floats=["max_value"],
)
def r1_best_run(spark, d):
    return rn.best_run(runs(spark, d), "max_value").select("run_id", "max_value")


@register("r2_run_history", with_ctes(SQL_RUNS) + "SELECT run_id, start_time FROM runs ORDER BY start_time DESC, run_id LIMIT 100")
def r2_run_history(spark, d):
    return rn.run_history(runs(spark, d), 100).select("run_id", "start_time")


@register(
    "r3_compare_runs",
    with_ctes(SQL_RUNS) + "SELECT run_id, coalesce(run_name, substr(run_id, 1, 8)) AS display_name, avg_value, max_value FROM runs",
    floats=["avg_value", "max_value"],
)
def r3_compare_runs(spark, d):
    return rn.compare_runs(metrics_long(spark, d), runs(spark, d), ["avg_value", "max_value"])


@register(
    "r4_latest_versions",
    with_ctes(SQL_RUNS) + "SELECT name, stage, max(version) AS version, arg_max(run_id, version) AS run_id FROM versions_staged GROUP BY name, stage",
)
def r4_latest_versions(spark, d):
    return rn.latest_versions(versions(spark, d))


@register(
    "r5_compare_versions",
    with_ctes(SQL_RUNS)
    + "SELECT v.name, v.version, v.stage, v.run_id, r.avg_value, r.max_value FROM versions_staged v LEFT JOIN runs r USING (run_id) WHERE v.version IN (1, 2, 3)",
    floats=["avg_value", "max_value"],
)
def r5_compare_versions(spark, d):
    return rn.compare_versions(versions(spark, d), runs(spark, d), ["avg_value", "max_value"], [1, 2, 3]).select(
        "name", "version", "stage", "run_id", "avg_value", "max_value"
    )


SQL_BEST_VERSION = """best AS (
  SELECT name, version, max_value FROM (
    SELECT v.name, v.version, r.max_value, row_number() OVER (PARTITION BY v.name ORDER BY r.max_value DESC, v.version) AS rn
    FROM versions_staged v JOIN runs r USING (run_id) WHERE r.max_value IS NOT NULL) WHERE rn = 1)"""


def _best(spark, d):
    v = rn.compare_versions(versions(spark, d), runs(spark, d), ["max_value"])
    return rn.best_version(v, "max_value")


@register("r6_best_version", with_ctes(SQL_RUNS, SQL_BEST_VERSION) + "SELECT name, version, max_value FROM best", floats=["max_value"])
def r6_best_version(spark, d):
    return _best(spark, d).select("name", "version", "max_value")


@register(
    "r7_promote_best",
    with_ctes(SQL_RUNS, SQL_BEST_VERSION)
    + """SELECT v.name, v.version, CASE WHEN v.version = b.version THEN 'Production'
                                    WHEN v.stage = 'Production' THEN 'Archived' ELSE v.stage END AS stage
FROM versions_staged v LEFT JOIN best b USING (name)""",
)
def r7_promote_best(spark, d):
    return rn.promote_best(versions(spark, d), _best(spark, d)).select("name", "version", "stage")


PATIENCE, MIN_DELTA = 3, 0.001


@register(
    "r8_early_stop",
    with_ctes(
        SQL_SERIES,
        "ll AS (SELECT user_id AS run_id, pos AS epoch, x AS loss FROM series)",
    ).replace("WITH ", "WITH RECURSIVE ", 1)
    + f""", rec AS (
  SELECT run_id, epoch, loss AS best, 0 AS counter FROM ll WHERE epoch = 0
  UNION ALL
  SELECT r.run_id, l.epoch,
         CASE WHEN l.loss < r.best - {MIN_DELTA!r} THEN l.loss ELSE r.best END,
         CASE WHEN l.loss < r.best - {MIN_DELTA!r} THEN 0 ELSE r.counter + 1 END
  FROM rec r JOIN ll l ON l.run_id = r.run_id AND l.epoch = r.epoch + 1
  WHERE r.counter < {PATIENCE}),
stops AS (SELECT run_id, min(epoch) FILTER (WHERE counter >= {PATIENCE}) AS stop_epoch FROM rec GROUP BY run_id)
SELECT s.run_id, s.stop_epoch, arg_min(l.epoch, (l.loss, l.epoch)) AS best_epoch, min(l.loss) AS best_loss
FROM stops s JOIN ll l ON l.run_id = s.run_id AND (s.stop_epoch IS NULL OR l.epoch <= s.stop_epoch)
GROUP BY s.run_id, s.stop_epoch""",
    floats=["best_loss"],
)
def r8_early_stop(spark, d):
    ll = series(spark, d).select(F.col("user_id").alias("run_id"), F.col("pos").alias("epoch"), F.col("x").alias("loss"))
    return rn.early_stop(ll, PATIENCE, MIN_DELTA)
