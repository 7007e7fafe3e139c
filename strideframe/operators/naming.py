"""Feature-name operators (P1-P5, S2) and row-local vector transforms.

Name predicates are column expressions, so they run on a name column of any
size (a name per feature of a long table) without a join; pattern groups are a
literal array filtered per name instead of a theta join.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strideframe.functions.hashing import hash_normal
from strideframe.functions.ranking import bucketed_rank

# The rule of each feature subset (``any`` name, a ``prefix``, or a text that the name ``contains``).
SUBSETS = {
    "all": ("any", ""),
    "time": ("prefix", "t"),
    "body_acc": ("contains", "BodyAcc"),
    "gyro": ("contains", "Gyro"),
}
# Importance groups and the texts that place a name in them.
IMPORTANCE_GROUPS = {
    "body_acceleration": ["tBodyAcc", "fBodyAcc"],
    "gravity_acceleration": ["tGravityAcc"],
    "body_gyroscope": ["tBodyGyro", "fBodyGyro"],
    "jerk_signals": ["Jerk"],
    "magnitude": ["Mag"],
    "mean_features": ["-mean()"],
    "std_features": ["-std()"],
    "frequency_domain": ["fBody"],
}
# Statistic tokens of feature names.
FEATURE_KINDS = ["mean()", "std()", "mad()", "max()", "min()", "energy()", "entropy()"]
# Domains and sensors by name.
SENSOR_KINDS = {
    "time_domain": ("prefix", "t"),
    "frequency_domain": ("prefix", "f"),
    "body_acc": ("contains", "BodyAcc"),
    "gravity_acc": ("contains", "GravityAcc"),
    "body_gyro": ("contains", "BodyGyro"),
}


def _subset_rule(subset: str) -> tuple[str, str]:
    if subset not in SUBSETS:
        raise ValueError(f"{subset!r} is not a feature subset; known: {', '.join(SUBSETS)}")
    return SUBSETS[subset]


def subset_predicate(name: Column, subset: str) -> Column:
    """Whether a name belongs to a subset of ``SUBSETS``."""
    how, text = _subset_rule(subset)
    return F.lit(True) if how == "any" else name.startswith(text) if how == "prefix" else name.contains(text)


def select_subset(df: DataFrame, subset: str) -> DataFrame:
    """P1 on a wide frame: keep the columns whose names pass the subset's rule (driver-side names)."""
    how, text = _subset_rule(subset)
    keep = [c for c in df.columns if how == "any" or (c.startswith(text) if how == "prefix" else text in c)]
    return df.select(keep)


def matching_subsets(name: Column) -> Column:
    """Array of the P1 subsets a name belongs to."""
    return F.array_compact(F.array(*[F.when(subset_predicate(name, s), F.lit(s)) for s in SUBSETS]))


def importance_groups(name: Column) -> Column:
    """Array of the groups whose patterns occur in ``name`` (a name may be in several)."""
    pairs = F.array(
        *[F.struct(F.lit(g).alias("g"), F.lit(p).alias("p")) for g, pats in IMPORTANCE_GROUPS.items() for p in pats]
    )
    return F.array_distinct(F.transform(F.filter(pairs, lambda s: F.instr(name, s["p"]) > 0), lambda s: s["g"]))


def categorize(name: Column) -> Column:
    """One category per name, first matching rule wins."""
    return (
        F.when(name.contains("Acc") & name.contains("Gravity"), "Gravity Acc")
        .when(name.contains("Acc") & name.contains("Jerk"), "Body Acc Jerk")
        .when(name.contains("Acc"), "Body Acc")
        .when(name.contains("Gyro") & name.contains("Jerk"), "Gyro Jerk")
        .when(name.contains("Gyro"), "Gyro")
        .when(name.contains("angle"), "Angle")
        .otherwise("Other")
    )


def kind_counts(names: DataFrame, name: str) -> DataFrame:
    """Number of names containing each statistic token, descending."""
    return (
        names.select(F.explode(F.filter(F.array(*[F.lit(k) for k in FEATURE_KINDS]), lambda k: F.col(name).contains(k))).alias("kind"))
        .groupBy("kind")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), "kind")
    )


def token_counts(names: DataFrame, tokens: str) -> DataFrame:
    """P4 with the tokens taken from the names (an array column) themselves."""
    each = names.select(F.explode(F.array_distinct(tokens)).alias("kind"))
    return each.groupBy("kind").agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), "kind")


def sensor_counts(names: DataFrame, name: str, kinds: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """P5: one row with the number of names per rule (``prefix`` or ``contains`` a text; domains and sensors by default)."""
    n = F.col(name)
    rules = SENSOR_KINDS if kinds is None else kinds
    return names.agg(*[F.count_if(n.startswith(v) if how == "prefix" else n.contains(v)).alias(k) for k, (how, v) in rules.items()])


def dedupe_names(names: DataFrame, name: str, order: str, range_bits: int = 12) -> DataFrame:
    """The 2nd occurrence of ``n`` becomes ``n_1``, the 3rd ``n_2`` (by integer ``order``).

    The occurrence number is a rank per name.  It is computed over ranges of
    ``2^range_bits`` consecutive ``order`` values (``bucketed_rank``), so a name
    repeated a third of the time is still spread over many tasks.
    """
    ranked = bucketed_rank(names, [name], F.shiftright(F.col(order).cast("bigint"), range_bits), [order], rank_name="_k")
    return ranked.withColumn(
        "unique_name",
        F.when(F.col("_k") == 0, F.col(name)).otherwise(F.concat(F.col(name), F.lit("_"), F.col("_k").cast("string"))),
    ).drop("_k")


def magnitude(*axes: str) -> Column:
    """``sqrt(x^2 + y^2 + z^2)``."""
    s = None
    for a in axes:
        s = F.col(a) * F.col(a) if s is None else s + F.col(a) * F.col(a)
    return F.sqrt(s)


def vector_magnitude(vec: Column | str) -> Column:
    """P6 over all elements of an array."""
    arr = F.col(vec) if isinstance(vec, str) else vec
    return F.sqrt(F.aggregate(F.transform(arr, lambda v: v.cast("double")), F.lit(0.0), lambda s, v: s + v * v))


def reshape_sequence(vec: Column, seq_len: int, channels: int) -> Column:
    """Flat vector to ``seq_len`` steps of ``channels`` (row-major); width mismatch raises."""
    check = F.when(
        F.size(vec) == seq_len * channels, vec
    ).otherwise(F.raise_error(F.lit(f"vector width is not {seq_len} x {channels}")))
    return F.transform(F.sequence(F.lit(0), F.lit(seq_len - 1)), lambda t: F.slice(check, t * channels + 1, channels))


def roll(vec: Column, shift: Column) -> Column:
    """Circular shift of an array by ``shift`` (positive moves right)."""
    n = F.size(vec)
    s = F.pmod(shift, n)
    return F.when(s == 0, vec).otherwise(F.concat(F.slice(vec, n - s + 1, s), F.slice(vec, 1, n - s)))


def add_noise(seq: Column, id_col: str, std: float, seed: int | str) -> Column:
    """Add normal noise to each element of a sequence of steps (drawn from the hash of id, step and channel)."""

    def noisy(t: Column, step: Column) -> Column:
        key = lambda c: F.concat_ws("-", F.col(id_col).cast("string"), t.cast("string"), c.cast("string"))
        return F.transform(step, lambda x, c: x + F.lit(float(std)) * hash_normal(key(c), seed))

    return F.transform(seq, lambda step, t: noisy(t, step))


def map_groups(df: DataFrame, keys: list[str], func: Callable, schema, partitions: int | None = None) -> DataFrame:
    """P9, keyed: apply a pandas function to each group.

    A group is held by one task, so the keys should bound it (a window, an
    order); unbounded groups need an aggregate.  ``partitions`` sets how many
    partitions the groups are dealt to.
    """
    dealt = df.repartition(partitions, *keys) if partitions else df
    return dealt.groupBy(*keys).applyInPandas(func, schema)


def map_partitions(df: DataFrame, func: Callable, schema, partitions: int | None = None) -> DataFrame:
    """Apply a pandas function to every Arrow batch of every partition.

    For a row-local ``func`` the result does not depend on partitioning; a
    function that needs a whole group belongs in ``map_groups`` or an aggregate.
    ``partitions`` deals the rows evenly to that many partitions first.
    """
    df = df.repartition(partitions) if partitions else df

    def run(batches):
        for pdf in batches:
            yield func(pdf)

    return df.mapInPandas(run, schema)
