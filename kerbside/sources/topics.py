"""Message topics as sources and sinks.

A topic lives on a Kafka cluster or, with any other ``fmt``, in a folder of files in that format, one
subfolder per topic. Both give and take the same columns, so jobs do not know which one they run on.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from kerbside.schemas import ENVELOPE


@dataclass(frozen=True)
class Topics:
    """Where topics live: ``location`` is the broker list of a Kafka cluster, else the parent folder."""

    location: str
    fmt: str = "kafka"
    options: dict[str, str] = field(default_factory=dict)

    def read_options(
        self, names: list[str], streaming: bool, starting: str = "latest", max_per_batch: int | None = None
    ) -> dict[str, str]:
        """Reader options for Kafka topics; data already expired on the brokers does not stop a query."""
        found = {
            "kafka.bootstrap.servers": self.location,
            "subscribe": ",".join(names),
            "startingOffsets": starting if streaming else "earliest",
            "failOnDataLoss": "false",
            **self.options,
        }
        if streaming and max_per_batch:
            found["maxOffsetsPerTrigger"] = str(max_per_batch)
        return found

    def write_options(self, name: str) -> dict[str, str]:
        return {"kafka.bootstrap.servers": self.location, "topic": name, **self.options}

    def stream(
        self, spark: SparkSession, *names: str, starting: str = "latest", max_per_batch: int | None = None
    ) -> DataFrame:
        """New messages of one or more topics, with their topic name, partition and offset."""
        if self.fmt == "kafka":
            return (
                spark.readStream.format("kafka")
                .options(**self.read_options(list(names), True, starting, max_per_batch))
                .load()
            )
        reader = spark.readStream.schema(ENVELOPE).format(self.fmt).options(**self.options)
        if max_per_batch:
            reader = reader.option("maxFilesPerTrigger", max_per_batch)
        return reader.load(self._files(names))

    def log(self, spark: SparkSession, *names: str) -> DataFrame:
        """Everything the topics hold now, as a batch table."""
        if self.fmt == "kafka":
            return spark.read.format("kafka").options(**self.read_options(list(names), False)).load()
        return spark.read.schema(ENVELOPE).format(self.fmt).options(**self.options).load(self._files(names))

    def append(self, messages: DataFrame, name: str) -> None:
        """Append a batch of ``(key, value)`` messages to a topic."""
        if self.fmt == "kafka":
            messages.write.format("kafka").options(**self.write_options(name)).save()
        else:
            messages.write.mode("append").format(self.fmt).save(f"{self.location}/{name}")

    def append_stream(self, messages: DataFrame, name: str) -> DataStreamWriter:
        """Writer of a stream of ``(key, value)`` messages; the caller adds mode, trigger and checkpoint."""
        if self.fmt == "kafka":
            return messages.writeStream.format("kafka").options(**self.write_options(name))
        # File sinks only append; going through the batch writer lets update-mode queries use them.
        return messages.writeStream.foreachBatch(lambda batch, _: self.append(batch, name))

    def writer(self, name: str) -> Callable[[DataFrame], None]:
        return lambda messages: self.append(messages, name)

    def _files(self, names: tuple[str, ...]) -> str:
        return f"{self.location}/{names[0]}" if len(names) == 1 else f"{self.location}/{{{','.join(names)}}}"


def as_envelope(messages: DataFrame, topic: str) -> DataFrame:
    """``(key, value)`` messages with the columns a broker would add; offsets follow the row order."""
    return messages.select(
        F.col("key").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.spark_partition_id().alias("partition"),
        F.monotonically_increasing_id().alias("offset"),
        F.current_timestamp().alias("timestamp"),
    )
