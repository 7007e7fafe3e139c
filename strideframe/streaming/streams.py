"""Structured Streaming forms (ST1-ST3).

* ST1 ``score_stream``: stateless append: each incoming row gets its prediction
  row (id, class number, class name, probabilities), from a fitted nearest
  centroid model (``classes x dims`` literals) or any fitted pipeline.
* ST2 ``stream_windows``: count-based sliding windows per series in event time.
  Samples wait in the state store until the watermark has passed them, so their
  order of arrival within the watermark's delay does not matter; a timer per
  series releases them in time order.  A sample older than the watermark is late:
  it is left out, and a counter row (``window_id`` -1) tells how many were.
  ``run_to_end`` closes the series when all input has been read.
* ST3 ``live_ab``: prediction stream joined to a later outcome stream by id
  with watermarks and a time bound.  ``run_totals`` keeps per-variant totals in a
  second query's state store; both queries go on from their checkpoints.

Every query runs with ``trigger(availableNow=True)`` under the session's
checkpoint folder; file streams take ``FILES_PER_TRIGGER`` files at a time, so
a micro-batch is bounded whatever waits.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from strideframe.operators.scoring import SERVING_CLASSES, argmax, centroid_distances, class_name, prediction_rows, softmax
from strideframe.operators.windows import window_step
from strideframe.session import checkpoint_dir


#: files of a micro-batch
FILES_PER_TRIGGER = 64


def file_stream(spark: SparkSession, folder: str, name: str, max_files_per_trigger: int = FILES_PER_TRIGGER) -> DataFrame:
    """Streaming scan of ``<folder>/<name>.parquet``, a file or a folder of files (schema taken from the files)."""
    path = f"{folder.rstrip('/')}/{name}.parquet"
    reader = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", max_files_per_trigger)
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if where.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(where).isDirectory():
        return reader.parquet(path)
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(folder)


def stream_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder for a stream's sinks and checkpoints."""
    return os.path.join(checkpoint_dir(spark), "streams", f"{name}-{uuid.uuid4().hex[:12]}")


def _finish(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def run_available_now(df: DataFrame, name: str, output_mode: str = "append", folder: str | None = None) -> DataFrame:
    """Run a streaming frame over all available input into a file sink; return the sink as a batch frame.

    With the ``folder`` of an earlier run the stream goes on from there.
    """
    spark = df.sparkSession
    base = folder or stream_folder(spark, name)
    sink = df.writeStream.format("parquet").outputMode(output_mode).option("path", f"{base}/out")
    _finish(sink.option("checkpointLocation", f"{base}/chk").trigger(availableNow=True).start())
    return spark.read.parquet(f"{base}/out")


# ------------------------------------------------------------------ ST1
def score_stream(stream: DataFrame, id_col: str, vec: str, centroids: dict[int, list[float]], names: list[str] = SERVING_CLASSES) -> DataFrame:
    """ST1: the prediction row of each incoming row; probabilities are the softmax of the negative distances."""
    near = centroid_distances(F.col(vec), centroids)
    scored = stream.select(id_col, near.alias("_d"))
    order = F.array(*[F.lit(int(c)) for c in sorted(centroids)])
    p = softmax(F.transform("_d", lambda d: -d))
    rows = scored.select(id_col, F.element_at(order, argmax(p) + 1).alias("prediction"), p.alias("_p"), order.alias("_c"))
    named = F.map_from_entries(F.zip_with("_c", "_p", lambda c, q: F.struct(class_name(c, names).alias("k"), q.alias("v"))))
    return rows.select(id_col, "prediction", class_name(F.col("prediction"), names).alias("activity"), named.alias("probabilities"))


def score_stream_with(model, stream: DataFrame, id_col: str, names: list[str] = SERVING_CLASSES) -> DataFrame:
    """ST1 with a fitted Spark ML pipeline or classifier."""
    return prediction_rows(model.transform(stream), id_col, "prediction", "probability", vector=True, names=names)


# ------------------------------------------------------------------ ST2
STATISTICS = ("mean", "std", "min", "max", "range", "median")
LATE = -1


def window_statistics(values: np.ndarray) -> dict[str, np.ndarray]:
    """T1 of each row of a ``(windows, size)`` matrix."""
    low, high = values.min(axis=1), values.max(axis=1)
    return {"mean": values.mean(axis=1), "std": values.std(axis=1), "min": low, "max": high, "range": high - low, "median": np.median(values, axis=1)}


#: event time that closes all series, in microseconds (year 2262)
END = 9_214_646_400_000_000


class SeriesWindows(StatefulProcessor):
    """State of one series: samples that wait for the watermark, how many were released, the last ``size - 1`` values."""

    def __init__(self, key: str, size: int, step: int):
        self.key, self.size, self.step = key, size, step

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "us long, tie long, value double")
        self.released = handle.getValueState("released", "n long")
        self.tail = handle.getListState("tail", "value double")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows), ignore_index=True)
        batch = batch[batch["us"] != END]
        if not len(batch):
            return
        # no order is known for a sample without time: it is late as well
        on_time = batch["us"].notna() & (batch["us"] // 1000 >= timerValues.getCurrentWatermarkInMs())
        if not on_time.all():
            yield self._rows(key, [LATE], [int((~on_time).sum())], {s: [None] for s in STATISTICS})
        if on_time.any():
            new = batch[on_time]
            self.waiting.appendList(list(zip(new["us"].astype("int64").tolist(), new["tie"].tolist(), new["value"].tolist(), strict=True)))
            self._wake_at(int(new["us"].min()) // 1000 + 1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        limit = timerValues.getCurrentWatermarkInMs()
        samples = sorted(self.waiting.get()) if self.waiting.exists() else []
        ready = [s for s in samples if s[0] // 1000 < limit]
        rest = samples[len(ready) :]
        if rest:
            self.waiting.put(rest)
            # the timer that woke this call goes after it
            self.handle.registerTimer(rest[0][0] // 1000 + 1)
        else:
            self.waiting.clear()
        if ready:
            yield from self._emit(key, np.array([s[2] for s in ready], np.float64))

    def _wake_at(self, ms: int) -> None:
        """One timer for each series: the earliest asked for.  (One that is due already fires after the rows, and looks at all that waits.)"""
        timers = list(self.handle.listTimers())
        if not timers or ms < min(timers):
            for t in timers:
                self.handle.deleteTimer(t)
            self.handle.registerTimer(ms)

    def _emit(self, key, new: np.ndarray) -> Iterator[pd.DataFrame]:
        seen = self.released.get()[0] if self.released.exists() else 0
        tail = [x[0] for x in self.tail.get()] if self.tail.exists() else []
        values = np.concatenate([np.array(tail, np.float64), new])
        total, first = seen + len(new), seen - len(tail)
        # windows that end among the new samples
        low = max(0, -(-(seen + 1 - self.size) // self.step))
        ids = np.arange(low, (total - self.size) // self.step + 1) if total >= self.size else np.zeros(0, np.int64)
        self.released.update((total,))
        self.tail.put([(float(x),) for x in values[max(0, len(values) - self.size + 1) :]]) if self.size > 1 else self.tail.clear()
        if len(ids):
            frames = np.lib.stride_tricks.sliding_window_view(values, self.size)[ids * self.step - first]
            yield self._rows(key, ids, self.size, window_statistics(frames))

    def _rows(self, key, ids, n, statistics: dict) -> pd.DataFrame:
        found = pd.DataFrame({self.key: pd.array([key[0]] * len(ids)), "window_id": ids, "n": n} | {f"{s}_x": statistics[s] for s in STATISTICS})
        return found.astype({f"{s}_x": "float64" for s in STATISTICS})

    def close(self) -> None:
        pass


def with_rocksdb(spark: SparkSession) -> None:
    """Timers and list states need the RocksDB store; it keeps state on disk, so waiting samples need not fit in memory."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def stream_windows(
    stream: DataFrame, key: str, ts: str, tie: str, value: str, size: int = 128, overlap: float = 0.5, delay: str = "1 hour"
) -> DataFrame:
    """ST2: per-series sliding windows (count-based, in the order of ``ts``, ``tie``) with the T1 statistics of ``value``.

    A window is emitted once the watermark (the latest event time less ``delay``)
    has passed its samples.  Window rows hold ``n = size``; a row with
    ``window_id = LATE`` holds in ``n`` the late samples of one micro-batch.
    """
    with_rocksdb(stream.sparkSession)
    # the time goes on as a number: rows behind the watermark stay, to be counted
    timed = stream.withWatermark(ts, delay).select(
        key, F.unix_micros(F.col(ts)).alias("us"), F.col(tie).cast("long").alias("tie"), F.col(value).cast("double").alias("value")
    )
    kind = stream.schema[key].dataType.simpleString()
    out_schema = f"{key} {kind}, window_id long, n long, " + ", ".join(f"{s}_x double" for s in STATISTICS)
    processor = SeriesWindows(key, size, window_step(size, overlap))
    return timed.groupBy(key).transformWithStateInPandas(processor, out_schema, "Append", "EventTime")


def run_to_end(make, stream: DataFrame, ts: str, name: str, folder: str | None = None) -> DataFrame:
    """Run ``make(stream)`` over all available input, then once more with a closing row in the far future.

    The closing row (all other columns NULL) moves the watermark past every
    sample.  The second run starts from the checkpoint of the first.
    """
    spark = stream.sparkSession
    base = folder or stream_folder(spark, name)
    closing = f"{base}/closing"
    nothing = spark.createDataFrame([], stream.schema)
    nothing.write.mode("append").parquet(closing)
    both = stream.unionByName(spark.readStream.schema(stream.schema).parquet(closing))
    run_available_now(make(both), name, folder=base)
    others = [F.lit(None).cast(f.dataType).alias(f.name) for f in stream.schema.fields if f.name != ts]
    last = spark.range(1).select(F.timestamp_micros(F.lit(END)).cast(stream.schema[ts].dataType).alias(ts), *others)
    last.select(*stream.columns).write.mode("append").parquet(closing)
    return run_available_now(make(both), name, folder=base)


# ------------------------------------------------------------------ ST3
def live_ab(predictions: DataFrame, outcomes: DataFrame, id_col: str, bound: str = "2 days", delay: str = "3 days") -> DataFrame:
    """ST3: inner stream-stream join of predictions ``(id, variant, y_pred, t_pred)`` and
    outcomes ``(id, y_true, t_out)`` with ``t_pred <= t_out <= t_pred + bound``."""
    p = predictions.withWatermark("t_pred", delay).alias("p")
    o = outcomes.withWatermark("t_out", delay).alias("o")
    cond = (
        (F.col(f"p.{id_col}") == F.col(f"o.{id_col}"))
        & (F.col("o.t_out") >= F.col("p.t_pred"))
        & (F.col("o.t_out") <= F.col("p.t_pred") + F.expr(f"INTERVAL {bound}"))
    )
    return p.join(o, cond, "inner").select(F.col(f"p.{id_col}").alias(id_col), "p.variant", "p.y_pred", "o.y_true")


def variant_totals(joined: DataFrame) -> DataFrame:
    """``variant, n, correct, accuracy`` of joined rows (or of partial totals with ``n`` and ``correct``)."""
    if {"n", "correct"} <= set(joined.columns):
        sums = joined.groupBy("variant").agg(F.sum("n").alias("n"), F.sum("correct").alias("correct"))
    else:
        right = F.count_if(F.col("y_true") == F.col("y_pred"))
        sums = joined.groupBy("variant").agg(F.count(F.lit(1)).alias("n"), right.alias("correct"))
    return sums.withColumn("accuracy", F.col("correct") / F.col("n"))


TOTALS = "variant string, n long, correct long, accuracy double"


def _write_totals(batch: DataFrame, number: int, folder: str) -> None:
    """The totals after a batch, under its number: a batch that is run again replaces its own."""
    variant_totals(batch).write.mode("overwrite").parquet(f"{folder}/totals/{number}")


def latest_totals(spark: SparkSession, folder: str) -> DataFrame:
    """The live result: the totals of the last finished batch of ``run_totals``."""
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/totals")
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    done = [int(f.getPath().getName()) for f in fs.listStatus(where)] if fs.exists(where) else []
    done = [k for k in done if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/totals/{k}/_SUCCESS"))]
    if not done:
        return spark.createDataFrame([], TOTALS)
    return spark.read.schema(TOTALS).parquet(f"{folder}/totals/{max(done)}")


def run_totals(joined: DataFrame, name: str, folder: str | None = None, files_per_trigger: int = FILES_PER_TRIGGER) -> DataFrame:
    """Per-variant totals of a stream of joined rows, by a chain of two queries.

    The first appends variant and correctness of the joined rows to a file sink,
    which holds each row once; the second adds them up in its state store, and
    each of its batches writes the totals so far under its number.  Nothing is
    kept in the driver: with the ``folder`` of an earlier run, stopped after any
    batch or in one, both go on from their checkpoints.
    """
    spark = joined.sparkSession
    base = folder or stream_folder(spark, name)
    rows = joined.select("variant", (F.col("y_true") == F.col("y_pred")).cast("int").alias("correct"))
    sink = rows.writeStream.format("parquet").option("path", f"{base}/joined").option("checkpointLocation", f"{base}/joined-chk")
    _finish(sink.trigger(availableNow=True).start())
    kept = spark.readStream.schema("variant string, correct int").option("maxFilesPerTrigger", files_per_trigger).parquet(f"{base}/joined")
    sums = kept.groupBy("variant").agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("correct"), F.lit(0)).alias("correct"))
    out = sums.writeStream.outputMode("complete").foreachBatch(lambda batch, number: _write_totals(batch, number, base))
    _finish(out.option("checkpointLocation", f"{base}/totals-chk").trigger(availableNow=True).start())
    return latest_totals(spark, base)
