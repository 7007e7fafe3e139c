"""Data-quality queries (V1-V4)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from strideframe.functions.sizing import broadcast_if_small
from strideframe.operators import quality
from strideframe.plans.catalog import register
from strideframe.plans.derived import TAB_COLUMNS, table

# The market-segment dictionary of the customer table.
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
_SEG_SQL = ", ".join(f"'{s}'" for s in SEGMENTS)


@register(
    "v1_label_constraints",
    f"""SELECT rule, n_rows, n_violations, n_violations = 0 AS ok FROM (
  SELECT 'nationkey_range' AS rule, count(*) AS n_rows,
         count_if(NOT coalesce(c_nationkey BETWEEN 0 AND 24, FALSE)) AS n_violations FROM customer
  UNION ALL
  SELECT 'segment_member', count(*), count_if(NOT coalesce(c_mktsegment IN ({_SEG_SQL}), FALSE)) FROM customer
  UNION ALL
  SELECT 'nation_known', count(*),
         count_if(NOT coalesce(c_nationkey IN (SELECT n_nationkey FROM nation), FALSE)) FROM customer)""",
)
def v1_label_constraints(spark, d):
    cust = table(spark, d, "customer")
    nations = table(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.lit(True).alias("_known"))
    # the dictionary is a dimension table: a left join marks known keys
    checked = cust.join(broadcast_if_small(nations), "c_nationkey", "left")
    return quality.rule_report(
        checked,
        {
            "nationkey_range": F.col("c_nationkey").between(0, 24),
            "segment_member": F.col("c_mktsegment").isin(SEGMENTS),
            "nation_known": F.col("_known"),
        },
    )


_V2_COLS = TAB_COLUMNS + ["l_returnflag", "l_shipdate"]


@register(
    "v2_null_report",
    "SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column, count(*) AS n_rows, count_if({c} IS NULL{' OR isnan(' + c + ')' if c in TAB_COLUMNS else ''}) AS n_null FROM lineitem"
        for c in _V2_COLS
    )
    + ")",
)
def v2_null_report(spark, d):
    return quality.null_report(table(spark, d, "lineitem"), _V2_COLS, expected_width=11)


@register(
    "v3_coercion",
    """SELECT 'props_k' AS column, count(k) AS n_input, count_if(k IS NOT NULL AND TRY_CAST(k AS INTEGER) IS NULL) AS n_lost
FROM (SELECT json_extract_string(props, '$.k') AS k FROM events)
UNION ALL
SELECT 'orderpriority', count(o_orderpriority), count_if(o_orderpriority IS NOT NULL AND TRY_CAST(o_orderpriority AS INTEGER) IS NULL)
FROM orders""",
)
def v3_coercion(spark, d):
    ev = table(spark, d, "events").select(F.get_json_object("props", "$.k").alias("k"))
    a = quality.coercion_report(ev, {"props_k": (F.col("k"), "int")})
    o = table(spark, d, "orders")
    b = quality.coercion_report(o, {"orderpriority": (F.col("o_orderpriority"), "int")})
    return a.unionByName(b)


@register(
    "v3_coerce",
    """SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, TRY_CAST(event_type AS DOUBLE) AS event_type, user_id FROM events""",
)
def v3_coerce(spark, d):
    """Declared columns are cast, values that do not fit become NULL, undeclared columns stay."""
    ev = table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"), "event_type", "user_id")
    return quality.coerce(ev, T.StructType([T.StructField("k", T.IntegerType()), T.StructField("event_type", T.DoubleType())]))


@register(
    "v4_vector_requests",
    """WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 10 = 0 THEN embedding[1:10] WHEN vec_id % 10 = 1 THEN NULL WHEN vec_id % 10 = 2 THEN [] ELSE embedding END AS v,
         (SELECT max(len(embedding)) FROM embeddings) AS width FROM embeddings)
SELECT vec_id, CASE WHEN v IS NULL OR len(v) = 0 THEN 'empty' WHEN len(v) <> width THEN 'wrong_width' END AS reason,
       CASE WHEN v IS NOT NULL AND len(v) = width THEN 'ok' ELSE 'rejected' END AS status FROM r""",
)
def v4_vector_requests(spark, d):
    """All vectors as requests, of which some are made too short, NULL or empty."""
    e = table(spark, d, "embeddings")
    width = e.select(F.max(F.size("embedding"))).first()[0] or 0
    v, kind = F.col("embedding"), F.col("vec_id") % 10
    made = F.when(kind == 0, F.slice(v, 1, 10)).when(kind == 1, F.lit(None)).when(kind == 2, F.slice(v, 1, 0)).otherwise(v)
    return quality.vector_requests(e.select("vec_id", made.alias("v")), "v", width).select("vec_id", "reason", "status")
