"""The newest forecast of every place and slice, kept up as responses land.

State is a table cut into buckets by place and day. A batch of landed files is
reduced to its newest row per place and slice, and only the buckets that these
fall into are read, merged and written again; the new folders become current
together (``sources.versions``), so a reader never sees half a batch. Newer is
what landed later; files of one time count by name, slices repeated in one
file by their values. The merge keeps the greatest of an order, so a batch that
is merged again changes nothing; a batch already noted is not even read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from destrank import schemas
from destrank.operators.quality import observed
from destrank.session import ensure_checkpoint_dir, scratch_dir
from destrank.sources.landing import flatten_forecasts
from destrank.sources.versions import Snapshot, Table, VersionedTables

BUCKETS = 256
KEY = ("city", "ts")
VALUES = [c for c in schemas.READINGS.names if c not in KEY]
#: A bucket's columns: the reading, and when and in which file it landed.
STORED = [*schemas.READINGS.names, "landed", "file"]


def bucket_of(buckets: int) -> Column:
    """By place and day, so that one crowded place fills many buckets."""
    return F.pmod(F.xxhash64("city", "date"), F.lit(buckets)).cast("int")


def landed_readings(responses: DataFrame) -> DataFrame:
    """Slices of landed responses with the time and name of their file. Slices
    without a place or a time cannot be replaced by newer ones: they are left out."""
    meta = F.col("_metadata")
    landed = responses.select("*", meta["file_modification_time"].alias("landed"), meta["file_path"].alias("file"))
    rows = flatten_forecasts(landed, "landed", "file")
    return rows.where(F.col("city").isNotNull() & F.col("ts").isNotNull())


def newest(rows: DataFrame) -> DataFrame:
    """One row per place and slice: the greatest by landing time, file and
    values. Reduced before the shuffle; a hot place is spread by its slices."""
    order = F.struct("landed", "file", *VALUES)
    best = rows.groupBy(*KEY).agg(F.max(order).alias("best"))
    return best.select(*[F.col(c) if c in KEY else F.col(f"best.{c}") for c in STORED])


class NewestForecasts:
    """The state below ``root`` (any Hadoop URI)."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS) -> None:
        self.spark, self.buckets, self.tables = spark, buckets, VersionedTables(spark, root)
        found = self.tables.snapshot()
        if found.version and found.note["buckets"] != buckets:
            raise ValueError(f"{root} has {found.note['buckets']} buckets, not {buckets}")

    def _read(self, snapshot: Snapshot, names: list[str]) -> DataFrame:
        folders = [snapshot.tables[n].folder for n in names]
        if not folders:
            return self.spark.createDataFrame([], self._schema())
        return self.spark.read.schema(self._schema()).parquet(*folders)

    @staticmethod
    def _schema() -> str:
        kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.READINGS)
        return f"{kinds}, landed timestamp, file string"

    def readings(self, snapshot: Snapshot | None = None) -> DataFrame:
        """The newest reading of every place and slice, of the current version."""
        snapshot = self.tables.snapshot() if snapshot is None else snapshot
        return self._read(snapshot, sorted(snapshot.tables)).select(*schemas.READINGS.names)

    def merge(self, rows: DataFrame, batch: tuple[str, int] | None = None) -> Snapshot:
        """Merges landed readings. ``batch`` is the stream and number they come
        with; numbers up to the last one noted are taken for replays."""
        base = self.tables.snapshot()
        noted = dict(base.note.get("batches", {}))
        if batch and batch[1] <= noted.get(batch[0], -1):
            return base
        fresh = newest(rows).withColumn("bucket", bucket_of(self.buckets)).checkpoint()
        touched = sorted(r.bucket for r in fresh.select("bucket").distinct().collect())  # as many as buckets at most
        if batch:
            noted[batch[0]] = batch[1]
        note = {"buckets": self.buckets, "batches": noted}
        if not touched:
            return self.tables.commit(base, {}, note)
        old = self._read(base, [str(b) for b in touched if str(b) in base.tables])
        merged = newest(fresh.drop("bucket").unionByName(old)).withColumn("bucket", bucket_of(self.buckets))
        folder = self.tables.new_folder("buckets")
        watched, obs = observed(merged.repartition("bucket"), f"merged-{uuid.uuid4().hex}")
        watched.write.partitionBy("bucket").parquet(folder)
        schema = merged.drop("bucket").schema.json()
        parts = {str(b): Table(f"{folder}/bucket={b}", schema, -1) for b in touched}
        return self.tables.commit(base, parts, {**note, "rows_written": int(obs.get["rows"]), "touched": len(touched)})


def keep_newest_forecasts(
    spark: SparkSession,
    landing_path: str,
    state: NewestForecasts,
    checkpoint_location: str | None = None,
    max_files_per_trigger: int | None = None,
    name: str = "forecasts",
) -> StreamingQuery:
    """Merges newly landed responses into ``state``, batch by batch; stops when
    all files present at start are merged. Pass the same
    ``checkpoint_location`` on every run, and one ``name`` for it."""
    ensure_checkpoint_dir(spark)
    reader = spark.readStream.schema(schemas.FORECAST_RESPONSE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    rows = landed_readings(reader.json(landing_path))
    return (
        rows.writeStream.foreachBatch(lambda batch, number: state.merge(batch, (name, number)) and None)
        .option("checkpointLocation", checkpoint_location or scratch_dir(spark, "newest-ckpt"))
        .trigger(availableNow=True)
        .start()
    )
