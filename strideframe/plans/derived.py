"""Inputs derived from the driver tables, in Spark and as DuckDB CTE text.

Each derived input has the same definition on both sides, so an operator's
Spark result can be compared with an SQL oracle over the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strideframe.functions.hashing import bucket, sql_bucket
from strideframe.operators.windows import positions
from strideframe.sources.tables import read_table


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return read_table(spark, d, name)


# ---------------------------------------------------------------- series
def series(spark: SparkSession, d: str) -> DataFrame:
    """``user_id, pos, n, ts, event_id, x, y, label`` from ``events``."""
    ev = table(spark, d, "events").select(
        "user_id",
        "ts",
        "event_id",
        F.col("value").alias("x"),
        F.expr("try_cast(get_json_object(props, '$.k') AS double)").alias("y"),
        F.col("event_type").alias("label"),
    )
    return positions(ev, "user_id", "ts", "event_id")


SQL_SERIES = """series AS (
  SELECT user_id, ts, event_id,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS pos,
         count(*) OVER (PARTITION BY user_id) AS n,
         value AS x,
         TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS y,
         event_type AS label
  FROM events)"""


def sql_windowed(size: int, step: int) -> str:
    """CTE ``win``: series rows of every complete window (``window_id``, ``offset``)."""
    return f"""win AS (
  SELECT s.*, w.window_id, CAST(s.pos - w.window_id * {step} AS INTEGER) AS "offset"
  FROM series s,
       LATERAL (SELECT unnest(range(
           CAST(greatest(0, ceil((s.pos - {size - 1}) / {step})) AS BIGINT),
           CAST(least(floor(s.pos / {step}), floor((s.n - {size}) / {step})) + 1 AS BIGINT))) AS window_id) w
  WHERE s.n >= {size})"""


# ---------------------------------------------------------------- tab
# row_id: (orderkey, partkey, suppkey, linenumber, quantity) is the smallest
# integer-only column set that is unique in the driver's lineitem.
TAB_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def tab(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(
        F.concat_ws(
            "-",
            *[F.col(c).cast("bigint").cast("string") for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity")],
        ).alias("row_id"),
        "l_orderkey",
        "l_linenumber",
        F.col("l_returnflag").alias("class"),
        F.col("l_suppkey").alias("grp"),
        *TAB_COLUMNS,
    )


SQL_TAB = """tab AS (
  SELECT concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_quantity AS BIGINT)) AS row_id, l_orderkey, l_linenumber, l_returnflag AS class, l_suppkey AS grp,
         l_quantity, l_extendedprice, l_discount, l_tax
  FROM lineitem)"""


# ---------------------------------------------------------------- matrix
def matrix_long(spark: SparkSession, d: str) -> DataFrame:
    """``vec_id, label, pos, val`` (one row per vector element)."""
    return table(spark, d, "embeddings").select(
        "vec_id", "label", F.posexplode("embedding").alias("pos", "val")
    ).withColumn("val", F.col("val").cast("double"))


SQL_MATRIX_LONG = """matrix_long AS (
  SELECT vec_id, label, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS pos,
         CAST(unnest(embedding) AS DOUBLE) AS val
  FROM embeddings)"""


def centroids(spark: SparkSession, d: str) -> dict[int, list[float]]:
    """Fitted class centroids of ``embeddings`` (one aggregate, ``classes x dims`` values)."""
    from strideframe.operators.scoring import fit_centroids

    return fit_centroids(matrix_long(spark, d))


def scored(spark: SparkSession, d: str, fitted: dict[int, list[float]] | None = None) -> DataFrame:
    """Nearest class centroid: ``vec_id, y_true, y_pred`` (ties to the lower label).

    The fitted centroids (a size-checked ``classes x dims`` model) are applied
    as a per-row expression: no join and no shuffle of the vectors.
    """
    from strideframe.operators.scoring import nearest_centroid

    fitted = fitted or centroids(spark, d)
    e = table(spark, d, "embeddings")
    return e.select(
        "vec_id", F.col("label").alias("y_true"), nearest_centroid(F.col("embedding"), fitted).cast("int").alias("y_pred")
    )


SQL_SCORED = (
    SQL_MATRIX_LONG
    + """,
cent AS (SELECT label AS c, pos, avg(val) AS mu FROM matrix_long GROUP BY label, pos),
dist AS (SELECT m.vec_id, m.label, c.c, sum((m.val - c.mu) * (m.val - c.mu)) AS d2
         FROM matrix_long m JOIN cent c ON m.pos = c.pos GROUP BY m.vec_id, m.label, c.c),
scored AS (SELECT vec_id, label AS y_true, arg_min(c, (d2, c)) AS y_pred FROM dist GROUP BY vec_id, label)"""
)


def scored_prob(spark: SparkSession, d: str) -> DataFrame:
    """``vec_id, y_true, y_pred, cls, p``: md5-made scores, favouring the predicted class, normalised by row."""
    fitted = centroids(spark, d)
    s = scored(spark, d, fitted)
    raw = s.withColumn("cls", F.explode(F.array(*[F.lit(int(c)) for c in sorted(fitted)]))).withColumn(
        "raw",
        (bucket(F.concat(F.col("vec_id").cast("string"), F.lit("-"), F.col("cls").cast("string")), 11) + 1)
        + F.when(F.col("cls") == F.col("y_pred"), F.lit(6000)).otherwise(F.lit(0)),
    )
    w = Window.partitionBy("vec_id")
    return raw.select("vec_id", "y_true", "y_pred", "cls", (F.col("raw") / F.sum("raw").over(w)).alias("p"))


SQL_SCORED_PROB = (
    SQL_SCORED
    + f""",
raw AS (SELECT vec_id, y_true, y_pred, cls,
               {sql_bucket("vec_id || '-' || cls", 11)} + 1
               + CASE WHEN cls = y_pred THEN 6000 ELSE 0 END AS raw
        FROM scored, (SELECT DISTINCT CAST(label AS INTEGER) AS cls FROM embeddings)),
scored_prob AS (SELECT vec_id, y_true, y_pred, cls, raw / sum(raw) OVER (PARTITION BY vec_id) AS p FROM raw)"""
)


# ---------------------------------------------------------------- feature names
# Naming vocabulary in the style of the reference's feature names.
NAME_DOMAINS = ["t", "f"]
NAME_SIGNALS = ["BodyAcc", "GravityAcc", "BodyAccJerk", "BodyGyro", "BodyGyroJerk", "BodyAccMag"]
NAME_STATS = ["mean()", "std()", "mad()", "max()", "min()", "energy()", "entropy()"]
NAME_AXES = ["X", "Y", "Z"]


def _pick(values: list[str], idx):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def feature_name(pos) -> "F.Column":
    """Name of matrix dimension ``pos`` by rule: every 16th is an angle, the rest ``<t|f><signal>-<stat>-<axis>``."""
    p = F.col(pos) if isinstance(pos, str) else pos
    axis = _pick(NAME_AXES, p % 3)
    return F.when(p % 16 == 15, F.concat(F.lit("angle("), axis, F.lit(",gravityMean)"))).otherwise(
        F.concat(
            _pick(NAME_DOMAINS, p % 2),
            _pick(NAME_SIGNALS, F.floor(p / 2) % 6),
            F.lit("-"),
            _pick(NAME_STATS, F.floor(p / 3) % 7),
            F.lit("-"),
            axis,
        )
    )


def _sql_list(values: list[str]) -> str:
    return "[" + ", ".join("'" + v + "'" for v in values) + "]"


SQL_FEATURE_NAME = f"""CASE WHEN pos % 16 = 15 THEN 'angle(' || {_sql_list(NAME_AXES)}[pos % 3 + 1] || ',gravityMean)'
     ELSE {_sql_list(NAME_DOMAINS)}[pos % 2 + 1] || {_sql_list(NAME_SIGNALS)}[(pos // 2) % 6 + 1] || '-'
          || {_sql_list(NAME_STATS)}[(pos // 3) % 7 + 1] || '-' || {_sql_list(NAME_AXES)}[pos % 3 + 1] END"""


def named_matrix(spark: SparkSession, d: str) -> DataFrame:
    """``matrix_long`` with the rule-made ``name`` of each dimension."""
    return matrix_long(spark, d).withColumn("name", feature_name("pos"))


SQL_NAMED = SQL_MATRIX_LONG + f""",
named AS (SELECT *, {SQL_FEATURE_NAME} AS name FROM matrix_long)"""
