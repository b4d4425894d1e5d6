"""Publishing and subscribing over a shared folder.

The publisher keeps metadata as XML and appends measurements as Parquet; a subscriber reads the folder as a batch or as a
stream, and its filter is evaluated against the active measurements. Retries, ordering and back-pressure are those of
Structured Streaming: checkpoints, and files per trigger.
"""

from __future__ import annotations

import gzip
import threading
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import metadata as M
from ..operators.dataset import DataSet, IdFields
from ..operators.statements import select_signal_ids
from ..sources.xml_data import read_xml, write_xml
from . import measurements as S

SCHEMA = "signalid string, value double, ticks long, flags long, ts timestamp_ntz"
DEFAULT_FILTER = "FILTER ActiveMeasurements WHERE ID IS NOT NULL"


class Publisher:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.metadata: DataSet | None = None
        self.version = 0

    def define_metadata(self, data: DataSet) -> DataFrame:
        """Takes the device, measurement and phasor tables, publishes them, and returns the active measurements."""
        self.metadata = data
        packed = bytearray(gzip.compress(write_xml(data).encode()))
        self.version += 1
        self.spark.createDataFrame([(self.version, packed)], "version int, document binary").write.mode("overwrite").parquet(f"{self.folder}/metadata")
        return active(data)

    def filter_metadata(self, expression: str) -> DataFrame:
        return M.filter_metadata(self.metadata.table("MeasurementDetail"), expression)

    def publish(self, df: DataFrame, checkpoint: str | None = None) -> StreamingQuery | None:
        """A batch is appended at once; a stream is started, and ends when its input does."""
        df = df.withColumn("ts", S.ticks_to_time(F.col("ticks"))) if "ts" not in df.columns else df
        df = df.select("signalid", F.col("value").cast("double"), F.col("ticks").cast("long"), F.col("flags").cast("long"), "ts")
        if not df.isStreaming:
            df.write.mode("append").parquet(f"{self.folder}/measurements")
            return None
        return df.writeStream.format("parquet").option("path", f"{self.folder}/measurements").option("checkpointLocation", checkpoint or f"{self.folder}/checkpoint").trigger(availableNow=True).start()


class Busy:
    """Runs a callback beside the caller, one call at a time: what comes while it runs is dropped and counted."""

    def __init__(self, callback: Callable[[object], None]):
        self.callback, self.dropped, self.done = callback, 0, 0
        self.lock, self.thread = threading.Lock(), None

    def offer(self, x: object) -> bool:
        if not self.lock.acquire(blocking=False):
            self.dropped += 1
            return False

        def run() -> None:
            try:
                self.callback(x)
            finally:
                self.done += 1
                self.lock.release()

        self.thread = threading.Thread(target=run, daemon=True)
        self.thread.start()
        return True

    def wait(self) -> None:
        if self.thread:
            self.thread.join()


def sent_totals(packets: DataFrame) -> DataFrame:
    """packets(n, packet) -> measurements, packets and bytes in all."""
    return packets.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("measurements"), F.count(F.lit(1)).alias("packets"), F.coalesce(F.sum(F.octet_length("packet")), F.lit(0)).cast("long").alias("bytes"))


class Subscriber:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.total_received = 0
        self.version: int | None = None

    def configuration_changed(self, callback: Callable[[DataSet], None]) -> bool:
        """Calls back with the metadata if they were published anew since the last look."""
        version = self.spark.read.parquet(f"{self.folder}/metadata").first()["version"]
        changed, self.version = version != self.version, version
        if changed:
            callback(self.request_metadata())
        return changed

    def request_metadata(self) -> DataSet:
        document = self.spark.read.parquet(f"{self.folder}/metadata").first()["document"]
        return read_xml(self.spark, bytes(document))

    def signals(self, expression: str = DEFAULT_FILTER) -> DataFrame:
        data = self.request_metadata()
        view = DataSet(self.spark)
        view.add("ActiveMeasurements", active(data), ids=IdFields())
        return select_signal_ids(view, expression, "ActiveMeasurements")

    def subscribe(self, expression: str = DEFAULT_FILTER, options: S.StreamOptions = S.StreamOptions(), streaming: bool = False, files: int = 100) -> DataFrame:  # noqa: B008
        """Measurements of the signals a filter selects, within the options' times."""
        path = f"{self.folder}/measurements"
        reader = self.spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files) if streaming else self.spark.read.schema(SCHEMA)
        df = S.subscribed(reader.parquet(path), self.signals(expression))
        if options.nan_filter:
            df = S.without_nan(df)
        if options.start or options.stop:
            at = [F.lit(x).cast("timestamp_ntz") if x else None for x in (options.start, options.stop)]
            df = S.between(df, *at)
        if options.throttled and not streaming:
            df = S.throttle(df, f"{options.publish_interval} seconds", arrival="ticks").drop("interval_start")
        return df

    def receive(self, df: DataFrame, callback: Callable[[DataFrame], None], checkpoint: str) -> StreamingQuery:
        """Calls back with each micro-batch, and counts what came."""

        def one(batch: DataFrame, _: int) -> None:
            self.total_received += batch.count()
            callback(batch)

        return df.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

    def read(self, df: DataFrame) -> Iterator[Row]:
        """One measurement after the other, a partition at a time in memory."""
        yield from df.toLocalIterator()


def active(data: DataSet) -> DataFrame:
    return M.active_measurements(data.table("MeasurementDetail"), data.table("DeviceDetail"), data.table("PhasorDetail"))
