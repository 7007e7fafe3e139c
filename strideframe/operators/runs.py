"""Experiment-run and model-version logs as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strideframe.functions.nullsafe import key_columns
from strideframe.functions.ranking import bucketed_rank


def best_run(runs: DataFrame, metric: str, ascending: bool = False) -> DataFrame:
    """The best run by ``metric`` (runs without it last; ties by run_id); empty input gives nothing."""
    order = F.col(metric).asc_nulls_last() if ascending else F.col(metric).desc_nulls_last()
    return runs.where(F.col(metric).isNotNull()).orderBy(order, "run_id").limit(1)


def run_history(runs: DataFrame, max_results: int = 100) -> DataFrame:
    """R2: most recent runs first, at most ``max_results`` (a bounded top-k)."""
    return runs.orderBy(F.desc("start_time"), "run_id").limit(max_results)


def compare_runs(metrics_long: DataFrame, runs: DataFrame, metrics: list[str]) -> DataFrame:
    """Chosen metrics wide per run (missing = NULL); unnamed runs show the first 8 characters of their id.

    Keyed by run_id, so runs that share a name are all kept.
    """
    wide = metrics_long.where(F.col("metric").isin(metrics)).groupBy("run_id").pivot("metric", metrics).agg(F.first("value"))
    return runs.select("run_id", F.coalesce(F.col("run_name"), F.substring("run_id", 1, 8)).alias("display_name")).join(
        wide, "run_id", "left"
    )


def latest_versions(versions: DataFrame) -> DataFrame:
    """Latest version per (name, stage)."""
    return versions.groupBy("name", "stage").agg(
        F.max("version").alias("version"), F.max_by("run_id", "version").alias("run_id")
    )


def compare_versions(versions: DataFrame, runs: DataFrame, metrics: list[str], only: list[int] | None = None) -> DataFrame:
    """Versions with their run's metrics (equi-join on run_id), optionally a version list."""
    v = versions if only is None else versions.where(F.col("version").isin(only))
    return v.join(runs.select("run_id", *metrics), "run_id", "left")


def best_version(versions_with_metric: DataFrame, metric: str, ascending: bool = False, strict: bool = False) -> DataFrame:
    """Best version per name; strictly better replaces, so ties keep the lower version; NULL metrics skipped.

    ``strict=True`` raises when no version carries the metric (one ``take(1)``).
    """
    if strict and not versions_with_metric.where(F.col(metric).isNotNull()).take(1):
        raise ValueError(f"no version has metric {metric!r}")
    order = F.col(metric).asc() if ascending else F.col(metric).desc()
    w = Window.partitionBy("name").orderBy(order, "version")
    return (
        versions_with_metric.where(F.col(metric).isNotNull())
        .withColumn("_rn", F.row_number().over(w))
        .where("_rn = 1")
        .drop("_rn")
    )


def promote_best(versions: DataFrame, best: DataFrame) -> DataFrame:
    """The best version becomes Production; other Production versions become Archived."""
    b = best.select("name", F.col("version").alias("_best"))
    return (
        versions.join(b, "name", "left")
        .withColumn(
            "stage",
            F.when(F.col("version") == F.col("_best"), "Production")
            .when(F.col("stage") == "Production", "Archived")
            .otherwise(F.col("stage")),
        )
        .drop("_best")
    )


def early_stop_fold(loss_log: DataFrame, patience: int = 3, min_delta: float = 0.001) -> DataFrame:
    """R8 reference form: a left fold over each run's epoch-ordered log (one array per run).

    Exact but holds a whole run in one row; ``early_stop`` is the scalable form
    and is tested against this one.
    """
    arr = F.array_sort(F.collect_list(F.struct(F.col("epoch").cast("bigint").alias("e"), F.col("loss").cast("double").alias("l"))))
    init = F.struct(
        F.lit(float("inf")).alias("best"),
        F.lit(0).alias("counter"),
        F.lit(None).cast("bigint").alias("stop"),
        F.lit(float("inf")).alias("min_loss"),
        F.lit(None).cast("bigint").alias("min_epoch"),
    )

    def step(s, x):
        active = s["stop"].isNull()
        improved = x["l"] < s["best"] - F.lit(min_delta)
        counter = F.when(improved, F.lit(0)).otherwise(s["counter"] + 1)
        lower = x["l"] < s["min_loss"]
        return F.when(~active, s).otherwise(
            F.struct(
                F.when(improved, x["l"]).otherwise(s["best"]).alias("best"),
                counter.alias("counter"),
                F.when(counter >= patience, x["e"]).otherwise(F.lit(None).cast("bigint")).alias("stop"),
                F.when(lower, x["l"]).otherwise(s["min_loss"]).alias("min_loss"),
                F.when(lower, x["e"]).otherwise(s["min_epoch"]).alias("min_epoch"),
            )
        )

    folded = loss_log.groupBy("run_id").agg(F.aggregate(arr, init, step).alias("s"))
    return folded.select(
        "run_id",
        F.col("s.stop").alias("stop_epoch"),
        F.col("s.min_epoch").alias("best_epoch"),
        F.col("s.min_loss").alias("best_loss"),
    )


def early_stop(
    loss_log: DataFrame, patience: int = 3, min_delta: float = 0.001, block: int = 65536
) -> DataFrame:
    """Per run, the epoch where early stopping fires and the best epoch up to it.

    Rule: an epoch improves when ``loss < best - min_delta`` (then ``best`` =
    its loss and the counter resets); the stop fires when ``patience`` epochs in
    a row brought no improvement; the best epoch is the first plain minimum
    among the epochs trained.  Epochs are numbers that rise within a run; gaps
    do not matter, and a NULL run is a run.

    ``best`` only changes at improvement epochs, and along the recursion the
    next improvement after an improvement epoch ``e`` is the first
    ``j in (e, e + patience]`` with ``loss_j < loss_e - min_delta`` (else the
    stop fires at ``e + patience``, if that epoch exists).  That pointer needs
    only the next ``patience`` losses: ``lead`` over blocks of ``block`` epochs
    plus a ``patience``-row halo.  Inside a block the pointers are followed
    from each of the ``patience`` possible entry epochs (one ordered pass
    each), giving a ``patience``-entry transfer table per block; a per-run fold
    over the block tables (``n / block`` of them) finds the stop.  No task or
    row holds more than one block of a run.
    """
    if patience > block:
        raise ValueError("patience must not exceed the block size")
    ll, keys = key_columns(
        loss_log.select("run_id", F.col("epoch").cast("bigint").alias("epoch"), F.col("loss").cast("double").alias("loss")), ["run_id"]
    )
    # places in a run, not epoch numbers: a log may have gaps
    ll = bucketed_rank(ll, keys, F.floor(F.col("epoch") / block), ["epoch", "loss"], rank_name="pos", size_name="n")
    own = F.floor(F.col("pos") / block)
    near_start = (F.pmod(F.col("pos"), F.lit(block)) < patience) & (F.col("pos") >= block)
    placed = ll.withColumn("_blk", F.explode(F.when(near_start, F.array(own, own - 1)).otherwise(F.array(own)))).withColumn("_halo", F.col("_blk") < own)
    w = Window.partitionBy(*keys, "_blk").orderBy("pos")
    thr = F.col("loss") - F.lit(min_delta)
    nxt = F.coalesce(*[F.when(F.lead("loss", k).over(w) < thr, F.col("pos") + k) for k in range(1, patience + 1)])
    pointers = placed.select(*keys, "run_id", "n", "_blk", "pos", "_halo", nxt.alias("nxt")).where(~F.col("_halo"))

    arr = F.array_sort(F.collect_list(F.struct("pos", "nxt")))

    def follow(entry):
        init = F.struct(entry.alias("cur"), F.lit(False).alias("dead"))

        def step(s, x):
            hit = (~s["dead"]) & (x["pos"] == s["cur"])
            return F.struct(
                F.when(hit & x["nxt"].isNotNull(), x["nxt"]).otherwise(s["cur"]).alias("cur"),
                (s["dead"] | (hit & x["nxt"].isNull())).alias("dead"),
            )

        return F.aggregate(F.col("_pts"), init, step)

    per_block = pointers.groupBy(*keys, "_blk").agg(arr.alias("_pts"), F.first("n").alias("n"))
    base = F.col("_blk") * block
    per_block = per_block.select(*keys, "n", "_blk", F.array(*[follow(base + k) for k in range(patience)]).alias("_t"))
    runs_ = per_block.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_blk", "_t"))).alias("_bs"), F.first("n").alias("n"))

    def chain(s, b):
        k = (s["cur"] - b["_blk"] * block).cast("int")
        t = F.element_at(b["_t"], k + 1)
        live = ~s["done"]
        return F.struct(
            F.when(live, t["cur"]).otherwise(s["cur"]).alias("cur"),
            (s["done"] | (live & t["dead"])).alias("done"),
        )

    start = F.struct(F.lit(0).cast("bigint").alias("cur"), F.lit(False).alias("done"))
    walked = runs_.select(*keys, "n", F.aggregate("_bs", start, chain).alias("_s"))
    fires = F.col("_s.done") & (F.col("_s.cur") + patience <= F.col("n") - 1)
    stops = walked.select(*keys, F.when(fires, F.col("_s.cur") + patience).cast("bigint").alias("stop_pos"))
    trained = ll.join(stops, keys).where(F.col("stop_pos").isNull() | (F.col("pos") <= F.col("stop_pos")))
    best = trained.groupBy(*keys).agg(
        F.first("run_id").alias("run_id"),
        F.max(F.when(F.col("pos") == F.col("stop_pos"), F.col("epoch"))).alias("stop_epoch"),
        F.min_by("epoch", F.struct("loss", "epoch")).alias("best_epoch"),
        F.min("loss").alias("best_loss"),
    )
    return best.select("run_id", "stop_epoch", "best_epoch", "best_loss")
