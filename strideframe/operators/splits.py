"""Reproducible splits, folds and sampling.

Every random choice is an md5 hash of ``id:seed`` (``functions.hashing``), so
the result does not depend on partitioning, retries or the engine.  Exact
per-class cut points need a rank inside each class; ranks come from
``functions.ranking.bucketed_rank`` over hash ranges, so a class holding a
third of all rows is still spread over ``2^bits`` tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strideframe.functions.hashing import hash32, hash60
from strideframe.functions.nullsafe import join_by
from strideframe.functions.ranking import bucketed_rank, hash_range
from strideframe.functions.sizing import local_if_small


def hash_rank(df: DataFrame, id_col: str, seed: int, group: list[str], rank_name="rank", size_name="n_group", bits=12):
    """0-based rank by ``(hash32(id, seed), id)`` within ``group`` plus the group size."""
    h = "_h"
    out = bucketed_rank(
        df.withColumn(h, hash32(id_col, seed)),
        group,
        hash_range(F.col(h), bits),
        [h, id_col],
        rank_name=rank_name,
        size_name=size_name,
    )
    return out.drop(h)


def share_cuts(test_size: float, val_size: float) -> tuple[int, int]:
    """Upper ends of the test and val parts of the 60-bit hash range."""
    return round(test_size * 2**60), round((test_size + val_size) * 2**60)


def stratified_split(
    df: DataFrame,
    id_col: str,
    label: str,
    val_size: float = 0.15,
    test_size: float = 0.15,
    seed: int = 42,
    stratify: bool = True,
) -> DataFrame:
    """Add ``split`` in {train, val, test}.

    Stratified (D1): within each class of ``n`` rows ordered by hash, the first
    ``ceil(n * test_size)`` rows are test, then ``ceil(m * val_size / (1 -
    test_size))`` of the remaining ``m`` are val, the rest train.  (sklearn
    allots remainders randomly; this rule is deterministic, sizes differ by less
    than one row per class.)
    Unstratified (D2): thresholds of a 60-bit hash, a map-only projection.
    """
    if not 0 < test_size < 1 or not 0 <= val_size < 1 or val_size + test_size >= 1:
        raise ValueError("sizes must satisfy 0 < test, 0 <= val, val + test < 1")
    if not stratify:
        b = hash60(id_col, seed)
        t_cut, v_cut = share_cuts(test_size, val_size)
        return df.withColumn(
            "split", F.when(b < t_cut, "test").when(b < v_cut, "val").otherwise("train")
        )
    ranked = hash_rank(df, id_col, seed, [label])
    n = F.col("n_group")
    n_test = F.ceil(n * F.lit(test_size))
    n_val = F.ceil((n - n_test) * F.lit(val_size / (1 - test_size)))
    return ranked.withColumn(
        "split",
        F.when(F.col("rank") < n_test, "test").when(F.col("rank") < n_test + n_val, "val").otherwise("train"),
    ).drop("rank", "n_group")


def group_split(
    df: DataFrame,
    group: str,
    test_share: float = 0.2,
    val_share: float = 0.2,
    seed: int = 42,
    test_groups: list | None = None,
    val_groups: list | None = None,
) -> DataFrame:
    """D3: split by group so no group is in two splits.

    ``int(G * test_share)`` groups (at least 1) by hash order go to test, then
    ``int(rest * val_share)`` (at least 1) to val; explicit lists override.
    The group table has one row per group; it is ranked with the bucketed rank
    and joined back (the planner broadcasts it when AQE measures it small).
    """
    if test_groups is not None:
        tg = F.col(group).isin(list(test_groups))
        vg = F.col(group).isin(list(val_groups or []))
        return df.withColumn("split", F.when(tg, "test").when(vg, "val").otherwise("train"))
    return join_by(df, group_table(df, group, test_share, val_share, seed), [group])


def group_table(df: DataFrame, group: str, test_share: float = 0.2, val_share: float = 0.2, seed: int = 42) -> DataFrame:
    """D3: the split of each group, one row per group (a NULL group is a group)."""
    ranked = hash_rank(df.select(group).distinct(), group, seed, [], rank_name="g_rank", size_name="g_total")
    g = F.col("g_total")
    n_test = F.greatest(F.floor(g * F.lit(test_share)), F.lit(1))
    n_val = F.greatest(F.floor((g - n_test) * F.lit(val_share)), F.lit(1))
    return ranked.select(
        group,
        F.when(F.col("g_rank") < n_test, "test")
        .when(F.col("g_rank") < n_test + n_val, "val")
        .otherwise("train")
        .alias("split"),
    )


def members(df: DataFrame, keys: DataFrame, on: str, keep: bool = True) -> DataFrame:
    """Rows whose ``on`` value is (``keep``) or is not in ``keys``: semi / anti join."""
    return df.join(keys.select(on).distinct(), on, "left_semi" if keep else "left_anti")


def with_membership(df: DataFrame, keys: DataFrame, on: str, out: str = "is_member") -> DataFrame:
    """Every row with a flag whether its ``on`` value is in ``keys``: one join in place of a semi and an anti join."""
    known = keys.select(on).distinct().withColumn(out, F.lit(True))
    return join_by(df, known, [on], "left").withColumn(out, F.coalesce(out, F.lit(False)))


def kfold(df: DataFrame, id_col: str, label: str, k: int = 5, seed: int = 42) -> DataFrame:
    """Stratified fold ``rank mod k`` within each class, by hash order."""
    ranked = hash_rank(df, id_col, seed, [label])
    return ranked.withColumn("fold", F.pmod(F.col("rank"), F.lit(k)).cast("int")).drop("rank", "n_group")


def sample_n(df: DataFrame, id_col: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows without replacement: the ``n`` smallest hashes (ties by id).

    A first pass counts rows by the top bits of the hash; only the rows of the
    range that the ``n``-th falls in are ranked, the ranges below it are kept whole.
    """
    h = "_h"
    rows = df.withColumn(h, hash32(id_col, seed))
    by_range = rows.groupBy(hash_range(F.coalesce(F.col(h), F.lit(0)), 16).alias("_r")).agg(F.count(F.lit(1)).alias("_c")).collect()
    kept, cut = 0, 1 << 16
    for r in sorted(by_range, key=lambda r: r["_r"]):
        if kept + r["_c"] > n:
            cut = r["_r"]
            break
        kept += r["_c"]
    place = hash_range(F.coalesce(F.col(h), F.lit(0)), 16)
    whole = rows.where(place < cut)
    rest = bucketed_rank(rows.where(place == cut), [], F.lit(0), [h, id_col], rank_name="_rank")
    return whole.drop(h).unionByName(rest.where(F.col("_rank") < n - kept).drop("_rank", h))


def balanced_resample(df: DataFrame, id_col: str, label: str, n_draws: int | None = None, seed: int = 42) -> DataFrame:
    """``n_draws`` draws with replacement giving each class the same expected share.

    Draw ``i`` takes class ``i mod k`` (classes in alphabetical order, NULL
    first) and in it the row of rank ``hash60(i, seed) mod class_size``: an
    equi-join of the draw table with the ranked rows on ``(class index, rank)``.
    The ranked rows also give the classes; the draws are joined to them by
    broadcast when their counted number allows.
    """
    spark = df.sparkSession
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_class"))
    # classes are few beside the rows: numbered by a ranked table, not in one window
    numbered = bucketed_rank(counts, [], F.lit(0), [F.col(label).asc_nulls_first()], rank_name="cls_idx", size_name="k")
    classes, _ = local_if_small(numbered)
    k = classes.agg(F.max("k")).first()[0] or 0
    if not k:
        return df.withColumn("draw", F.lit(0).cast("bigint")).select("draw", *df.columns)
    if n_draws is None:
        n_draws = df.count()
    ranked = join_by(hash_rank(df, id_col, seed, [label]).drop("n_group"), classes.select(label, "cls_idx"), [label])
    draws = (
        spark.range(n_draws)
        .withColumnRenamed("id", "draw")
        .withColumn("cls_idx", F.pmod(F.col("draw"), F.lit(k)))
        .join(classes.select("cls_idx", "n_class"), "cls_idx")
        .withColumn("rank", F.pmod(hash60(F.col("draw"), seed), F.col("n_class")))
        .select("draw", "cls_idx", "rank")
    )
    return draws.join(ranked, ["cls_idx", "rank"], "inner").drop("rank", "cls_idx").select("draw", *df.columns)
