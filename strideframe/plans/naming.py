"""Feature-name and vector-transform queries."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from strideframe.functions.hashing import bucket, sql_bucket
from strideframe.operators import naming
from strideframe.plans.catalog import register, with_ctes
from strideframe.plans.derived import SQL_MATRIX_LONG, SQL_NAMED, SQL_TAB, named_matrix, tab, table


def _names(spark, d):
    return named_matrix(spark, d).select("name").distinct()


@register(
    "p1_feature_subsets",
    with_ctes(SQL_NAMED)
    + " UNION ALL ".join(
        f"SELECT '{s}' AS subset, count(DISTINCT name) AS n_features, count(*) AS n_values FROM named WHERE {w}"
        for s, w in [
            ("all", "TRUE"),
            ("time", "starts_with(name, 't')"),
            ("body_acc", "contains(name, 'BodyAcc')"),
            ("gyro", "contains(name, 'Gyro')"),
        ]
    ),
)
def p1_feature_subsets(spark, d):
    m = named_matrix(spark, d)
    return (
        m.select("name", F.explode(naming.matching_subsets(F.col("name"))).alias("subset"))
        .groupBy("subset")
        .agg(F.count_distinct("name").alias("n_features"), F.count(F.lit(1)).alias("n_values"))
    )


@register(
    "p2_importance_groups",
    with_ctes(SQL_NAMED)
    + " UNION ALL ".join(
        f"SELECT '{g}' AS grp, count(DISTINCT name) AS n_features, count(*) AS n_values FROM named WHERE "
        + " OR ".join(f"instr(name, '{p}') > 0" for p in pats)
        + f" HAVING count(*) > 0"
        for g, pats in naming.IMPORTANCE_GROUPS.items()
    ),
)
def p2_importance_groups(spark, d):
    m = named_matrix(spark, d)
    return (
        m.select("name", F.explode(naming.importance_groups(F.col("name"))).alias("grp"))
        .groupBy("grp")
        .agg(F.count_distinct("name").alias("n_features"), F.count(F.lit(1)).alias("n_values"))
    )


SQL_CATEGORY = """CASE WHEN contains(name, 'Acc') AND contains(name, 'Gravity') THEN 'Gravity Acc'
     WHEN contains(name, 'Acc') AND contains(name, 'Jerk') THEN 'Body Acc Jerk'
     WHEN contains(name, 'Acc') THEN 'Body Acc'
     WHEN contains(name, 'Gyro') AND contains(name, 'Jerk') THEN 'Gyro Jerk'
     WHEN contains(name, 'Gyro') THEN 'Gyro'
     WHEN contains(name, 'angle') THEN 'Angle' ELSE 'Other' END"""


@register(
    "p3_categories",
    with_ctes(SQL_NAMED)
    + f"SELECT {SQL_CATEGORY} AS category, count(DISTINCT name) AS n_features, count(*) AS n_values FROM named GROUP BY 1",
)
def p3_categories(spark, d):
    m = named_matrix(spark, d)
    return m.groupBy(naming.categorize(F.col("name")).alias("category")).agg(
        F.count_distinct("name").alias("n_features"), F.count(F.lit(1)).alias("n_values")
    )


@register(
    "p4_kind_counts",
    with_ctes(SQL_NAMED)
    + " UNION ALL ".join(
        f"SELECT '{k}' AS kind, count(*) AS count FROM (SELECT DISTINCT name FROM named) WHERE contains(name, '{k}') HAVING count(*) > 0"
        for k in naming.FEATURE_KINDS
    ),
)
def p4_kind_counts(spark, d):
    return naming.kind_counts(_names(spark, d), "name")


@register(
    "p5_sensor_counts",
    with_ctes(SQL_NAMED)
    + "SELECT "
    + ", ".join(
        f"count_if({'starts_with' if how == 'prefix' else 'contains'}(name, '{v}')) AS {k}"
        for k, (how, v) in naming.SENSOR_KINDS.items()
    )
    + " FROM (SELECT DISTINCT name FROM named)",
)
def p5_sensor_counts(spark, d):
    return naming.sensor_counts(_names(spark, d), "name")


@register(
    "s2_dedupe_names",
    """SELECT p_partkey, p_brand,
       CASE WHEN k = 0 THEN p_brand ELSE p_brand || '_' || k END AS unique_name
FROM (SELECT p_partkey, p_brand, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1 AS k FROM part)""",
)
def s2_dedupe_names(spark, d):
    return naming.dedupe_names(table(spark, d, "part").select("p_partkey", "p_brand"), "p_brand", "p_partkey")


@register(
    "p6_magnitude",
    with_ctes(SQL_MATRIX_LONG)
    + """SELECT label, avg(m) AS mean_magnitude FROM (SELECT vec_id, label, sqrt(sum(val * val)) AS m FROM matrix_long GROUP BY vec_id, label) GROUP BY label""",
    floats=["mean_magnitude"],
)
def p6_magnitude(spark, d):
    e = table(spark, d, "embeddings").select("label", naming.vector_magnitude("embedding").alias("m"))
    return e.groupBy("label").agg(F.avg("m").alias("mean_magnitude"))


SEQ_LEN, CHANNELS = 16, 4


@register(
    "p7_reshape_sequence",
    with_ctes(SQL_MATRIX_LONG)
    + f"SELECT vec_id, CAST(pos // {CHANNELS} AS INTEGER) AS t, CAST(pos % {CHANNELS} AS INTEGER) AS c, val FROM matrix_long",
    floats=["val"],
)
def p7_reshape_sequence(spark, d):
    e = table(spark, d, "embeddings").select(
        "vec_id", naming.reshape_sequence(F.transform("embedding", lambda v: v.cast("double")), SEQ_LEN, CHANNELS).alias("seq")
    )
    steps = e.select("vec_id", F.posexplode("seq").alias("t", "step"))
    return steps.select("vec_id", "t", F.posexplode("step").alias("c", "val"))


NOISE = 0.01


def _uniform_sql(part):
    key = f"concat_ws('-', vec_id, pos // {CHANNELS}, pos % {CHANNELS})"
    return f"((('0x' || substr(md5({key} || ':noise{part}'), 1, 8))::UBIGINT + 0.5::DOUBLE) / 4294967296.0)"


def _shift_sql():
    return f"CASE WHEN {sql_bucket('vec_id', 'coin')} < 5000 THEN CAST({sql_bucket('vec_id', 'roll')} % 11 AS INTEGER) - 5 ELSE 0 END"


@register(
    "p8_roll_augment",
    with_ctes(SQL_MATRIX_LONG)
    + f"""SELECT vec_id, CAST((pos // {CHANNELS} + s + {SEQ_LEN}) % {SEQ_LEN} AS INTEGER) AS t, CAST(pos % {CHANNELS} AS INTEGER) AS c,
       val + {NOISE} * sqrt(-2 * ln({_uniform_sql("a")})) * cos(6.283185307179586 * {_uniform_sql("b")}) AS val
FROM (SELECT *, {_shift_sql()} AS s FROM matrix_long)""",
    floats=["val"],
)
def p8_roll_augment(spark, d):
    shift = F.when(bucket("vec_id", "coin") < 5000, (F.pmod(bucket("vec_id", "roll"), F.lit(11)) - 5).cast("int")).otherwise(0)
    seq = naming.reshape_sequence(F.transform("embedding", lambda v: v.cast("double")), SEQ_LEN, CHANNELS)
    noisy = naming.add_noise(seq, "vec_id", NOISE, "noise")
    e = table(spark, d, "embeddings").select("vec_id", naming.roll(noisy, shift).alias("rolled"))
    steps = e.select("vec_id", F.posexplode("rolled").alias("t", "step"))
    return steps.select("vec_id", "t", F.posexplode("step").alias("c", "val"))


def _row_features(pdf):
    out = pdf[["row_id"]].copy()
    out["log_price"] = np.log1p(pdf["l_extendedprice"].to_numpy())
    out["gross"] = pdf["l_extendedprice"].to_numpy() * (1.0 - pdf["l_discount"].to_numpy())
    return out


@register(
    "p9_map_partitions",
    with_ctes(SQL_TAB) + "SELECT row_id, ln(1 + l_extendedprice) AS log_price, l_extendedprice * (1 - l_discount) AS gross FROM tab",
    floats=["log_price", "gross"],
)
def p9_map_partitions(spark, d):
    t = tab(spark, d).select("row_id", "l_extendedprice", "l_discount")
    return naming.map_partitions(t, _row_features, "row_id string, log_price double, gross double")


def _supplier_total(pdf):
    gross = pdf["l_extendedprice"] * (1.0 - pdf["l_discount"])
    return pdf[["l_suppkey"]].head(1).assign(n_lines=len(pdf), gross=gross.sum(), largest=gross.max())


@register(
    "p9_map_groups",
    """SELECT l_suppkey, count(*) AS n_lines, sum(l_extendedprice * (1 - l_discount)) AS gross, max(l_extendedprice * (1 - l_discount)) AS largest
FROM lineitem GROUP BY l_suppkey""",
    floats=["gross", "largest"],
    bits={"gross": 8},
)
def p9_map_groups(spark, d):
    """A supplier has a few hundred lines at any scale factor, so a group fits a call."""
    t = table(spark, d, "lineitem").select("l_suppkey", "l_extendedprice", "l_discount")
    return naming.map_groups(t, ["l_suppkey"], _supplier_total, "l_suppkey long, n_lines long, gross double, largest double")


@register(
    "p4_token_counts",
    """SELECT kind, count(*) AS count FROM (SELECT DISTINCT p_name, unnest(list_distinct(string_split(p_name, ' '))) AS kind FROM part) GROUP BY kind""",
)
def p4_token_counts(spark, d):
    """P4 over a real name column: in how many distinct names each of its words occurs."""
    names = table(spark, d, "part").select(F.split("p_name", " ").alias("words")).distinct()
    return naming.token_counts(names, "words")


PART_KINDS = {"red": ("prefix", "red "), "blue": ("prefix", "blue "), "bolts": ("contains", "bolt"), "rings": ("contains", "ring")}


@register(
    "p5_part_counts",
    "SELECT "
    + ", ".join(f"count_if({'starts_with' if how == 'prefix' else 'contains'}(p_name, '{v}')) AS {k}" for k, (how, v) in PART_KINDS.items())
    + " FROM part",
)
def p5_part_counts(spark, d):
    """P5 over a real name column, with its own rules."""
    return naming.sensor_counts(table(spark, d, "part"), "p_name", PART_KINDS)
