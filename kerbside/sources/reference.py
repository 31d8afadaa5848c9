"""Reference tables: CSV dimensions and tables kept as upsert topics."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from kerbside.functions.json_codec import encode_json
from kerbside.operators.energy import energy_days, latest_ward_energy
from kerbside.operators.enrich import latest_by_key
from kerbside.schemas import ROUTE_SCHEDULE, ZONE_PROFILE
from kerbside.sources.topics import Topics

#: What the archive's commits say of a batch, a row for each date that it wrote; with the job's start, since batch
#: numbers begin again with a checkpoint.
COMMIT = "batch_id long, job_started timestamp, date date"
COMMIT_COLUMNS = ["batch_id", "job_started", "date"]
#: Sums per ward and date, as ``energy_days`` makes them.
_DAYS = (
    "ward_id string, total_kwh_consumed double, power_factor_sum double, power_factor_count long, "
    "peak_voltage double, reading_count long, date date"
)
_MESSAGE = "key binary, value binary, offset long"


def read_zone_profile(spark: SparkSession, path: str) -> DataFrame:
    """Zone profile CSV with header; the stated types save a pass over the file to infer them."""
    return spark.read.schema(ZONE_PROFILE).option("header", True).csv(path)


def read_route_schedule(spark: SparkSession, path: str) -> DataFrame:
    """Route schedule CSV with header, every column text."""
    return spark.read.schema(ROUTE_SCHEDULE).option("header", True).csv(path)


def publish_route_schedule(spark: SparkSession, csv_path: str, topics: Topics, topic: str) -> None:
    """Load a schedule CSV into its upsert topic, keyed by route."""
    topics.append(encode_json(read_route_schedule(spark, csv_path), "route_id"), topic)


def current_route_schedule(spark: SparkSession, topics: Topics, topic: str) -> DataFrame:
    """The schedule as its upsert topic stands now: newest row per route, deleted routes left out.

    A topic keeps a key in one partition, so offsets order a key's rows.
    """
    return schedule_rows(latest_by_key(_keyed(topics.log(spark, topic)), deleted="value"))


def schedule_rows(newest: DataFrame) -> DataFrame:
    """Schedule columns of a topic's newest messages; unreadable ones and those without a route are left out."""
    schedule = F.from_json(F.col("value").cast("string"), ROUTE_SCHEDULE)
    return newest.select(schedule.alias("s")).select("s.*").where(F.col("route_id").isNotNull())


def _keyed(log: DataFrame) -> DataFrame:
    return log.where(F.col("key").isNotNull()).select("key", "value", "offset")


@dataclass
class UpsertSnapshot:
    """An upsert topic as a table that is kept, so that a refresh reads the messages since the last one only.

    Under ``path`` stand the versions of the table, one per batch that brought news, and the stream's progress. A
    batch is merged into the version before its own, deletions included, and written whole under its number; a
    batch that is repeated after a failure replaces what it wrote. Its cost is that of the table and the news, not
    of the topic. One snapshot has one owner: two jobs refresh two paths.
    """

    spark: SparkSession
    topics: Topics
    topic: str
    path: str
    max_per_batch: int | None = None
    #: Messages that each refresh so far has read.
    read_rows: list[int] = field(default_factory=list)

    def refresh(self) -> DataFrame:
        """Newest ``(key, value, offset)`` per key, deleted keys left out, as the topic stands now."""
        news = self.topics.stream(self.spark, self.topic, starting="earliest", max_per_batch=self.max_per_batch)
        query = (
            _keyed(news).writeStream.foreachBatch(self._merge)
            .option("checkpointLocation", f"{self.path}/progress").trigger(availableNow=True).start()
        )
        query.awaitTermination()
        self.read_rows.append(sum(progress.numInputRows for progress in query.recentProgress))
        return self._version(None)

    def _merge(self, news: DataFrame, batch_id: int) -> None:
        both = self._version(before=batch_id).unionByName(news)
        latest_by_key(both, deleted="value").write.mode("overwrite").parquet(f"{self._versions}/version={batch_id}")

    @property
    def _versions(self) -> str:
        return f"{self.path}/versions"

    def _version(self, before: int | None) -> DataFrame:
        """The newest version, of those before a number if given; none is an empty table."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self._versions)
        files = folder.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        names = [entry.getPath().getName() for entry in files.listStatus(folder)] if files.exists(folder) else []
        numbers = [int(name.removeprefix("version=")) for name in names]
        known = [number for number in numbers if before is None or number < before]
        if not known:
            return self.spark.createDataFrame([], _MESSAGE)
        return self.spark.read.schema(_MESSAGE).parquet(f"{self._versions}/version={max(known)}")


def read_energy_archive(spark: SparkSession, path: str) -> DataFrame:
    """Archived ward summaries; filters on ward and date skip whole folders."""
    return spark.read.parquet(path)


def commits_of(path: str) -> str:
    """Where an archive notes its finished batches; readers of the archive pass over the underscore."""
    return f"{path}/_commits"


def committed_energy_archive(spark: SparkSession, path: str) -> DataFrame:
    """The archive's rows of batches that reached both sinks."""
    done = spark.read.schema(COMMIT).parquet(commits_of(path))
    return read_energy_archive(spark, path).join(done, ["batch_id", "job_started"], "left_semi")


@dataclass
class EnergyDays:
    """Sums per (ward, date) that are kept beside the energy archive, for reports that don't read it.

    A refresh takes the commits since the last one, reads the archive's folders of the dates that they name and
    replaces just these dates. Under ``path`` stand the days and the progress in the commits. A refresh that failed
    is repeated as a whole and replaces what it wrote. Read the days between refreshes; one table has one owner.
    """

    spark: SparkSession
    archive: str
    path: str
    #: Dates that each refresh so far has built anew; None where commits of an older form name no dates.
    rebuilt: list[list | None] = field(default_factory=list)

    def refresh(self) -> DataFrame:
        """The days as the archive's commits stand now, each the sum of its windows' newest versions."""
        news = self.spark.readStream.schema(COMMIT).parquet(commits_of(self.archive))
        query = (
            news.writeStream.foreachBatch(self._rebuild)
            .option("checkpointLocation", f"{self.path}/progress").trigger(availableNow=True).start()
        )
        query.awaitTermination()
        return self.days()

    def days(self) -> DataFrame:
        return self.spark.read.schema(_DAYS).parquet(self._table)

    def windows(self, dates: list | None) -> DataFrame:
        """Newest versions of the committed windows of some dates, or of all."""
        rows = committed_energy_archive(self.spark, self.archive)
        return latest_ward_energy(rows if dates is None else rows.where(F.col("date").isin(dates)))

    def _rebuild(self, news: DataFrame, _: int) -> None:
        # As many as the calendar has days.
        dates = sorted((row.date for row in news.select("date").distinct().collect()), key=str)
        dates = None if None in dates else dates
        self.rebuilt.append(dates)
        if dates == []:
            return
        (
            energy_days(self.windows(dates)).withColumn("ward_id", F.col("ward_id").cast("string")).repartition("date")
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(self._table)
        )

    @property
    def _table(self) -> str:
        return f"{self.path}/days"
