"""Written intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from strideframe.session import checkpoint_dir


#: bytes of an Arrow batch that goes to a Python worker and back
BATCH_BYTES = 8 << 20
#: the same for operators that gain nothing from more text at a time
SMALL_BATCH_BYTES = 2 << 20


def small_batches(df: DataFrame, size: int = BATCH_BYTES) -> DataFrame:
    """Bound the Arrow batches of ``df``'s session by ``size`` bytes, and return ``df``.

    Rows of text differ in size a thousandfold; the default of 64 MB is held by
    the executor and by its Python worker, going and coming, for each task.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))
    return df


def unused(name: str, df: DataFrame) -> str:
    """``name``, with underscores added until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


class Scratch:
    """Tables written under ``spark.checkpoint.dir``; writing cuts the lineage and survives lost executors.

    ``drop`` deletes the tables of this object that are not named in ``keep``;
    call it when nothing lazy reads them any more.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = f"{checkpoint_dir(spark).rstrip('/')}/strideframe-{name}-{uuid.uuid4().hex}"
        self.paths: list[str] = []

    def place(self, name: str) -> str:
        """A new path of this object for a table that the caller writes."""
        self.paths.append(f"{self.base}/{len(self.paths)}-{name}")
        return self.paths[-1]

    def write(self, df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
        path = self.place(name)
        df.write.parquet(path, partitionBy=list(partition_by) or None)
        return self.spark.read.schema(df.schema).parquet(path)

    def _delete(self, path: str) -> None:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)

    def drop(self, keep: tuple[str, ...] = ()) -> None:
        for path in self.paths:
            if path.rpartition("/")[2].partition("-")[2] not in keep:
                self._delete(path)
        self.paths = [p for p in self.paths if p.rpartition("/")[2].partition("-")[2] in keep]

    def drop_one(self, name: str) -> None:
        for path in [p for p in self.paths if p.rpartition("/")[2].partition("-")[2] == name]:
            self._delete(path)
            self.paths.remove(path)


def written(df: DataFrame, name: str) -> DataFrame:
    """One table that stays."""
    return Scratch(df.sparkSession, name).write(df, name)
