"""Tables that micro-batches keep between them: survivors of a fuzzy deduplication, and the latest row of each key.

Each batch writes a folder of its own, named by its number and overwritten when the batch is replayed, so
a restart at any point changes nothing. Reads leave out the folders of the batch at hand and of later ones.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.functions import sketch
from weftline.operators import dedup
from weftline.session import passing, remove, staged, swept
from weftline.sources.writers import table_exists


def _folders(spark: SparkSession, path: str, name: str) -> list[int]:
    """Numbers n of the finished folders `name`=n under a path, in order."""
    if not table_exists(spark, path):
        return []
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    listed = root.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(root)
    numbers = [int(f.getPath().getName().split("=")[1]) for f in listed if f.getPath().getName().startswith(f"{name}=")]
    return sorted(n for n in numbers if table_exists(spark, f"{path}/{name}={n}/_SUCCESS"))


def read_batches(spark: SparkSession, path: str, schema: str, before: int | None = None) -> DataFrame:
    """Rows of all finished batches, or of those before a number, with their `batch`."""
    paths = [f"{path}/batch={n}" for n in _folders(spark, path, "batch") if before is None or n < before]
    if not paths:
        return spark.createDataFrame([], schema).withColumn("batch", F.lit(None).cast("int"))
    return spark.read.schema(schema + ", batch int").option("basePath", path).parquet(*paths)


@dataclass(frozen=True)
class SeenDocuments:
    """Near-duplicates of a stream: a document goes if it is similar to an earlier one that stayed.

    State is a narrow row for each survivor: its set hash, band keys and word set. With `ttl` seconds a
    survivor is forgotten when the newest event is that much younger, and folders that hold only forgotten
    ones are deleted. Equal to walking all documents in the order of batches and, inside one, of ids.
    """

    spark: SparkSession
    path: str
    id_col: str = "id"
    col: str = "content"
    ts: str | None = None
    ttl: int | None = None
    threshold: float = 0.8
    preset: str = "recall"
    id_type: str = "string"

    @property
    def _schema(self) -> str:
        return f"ord {self.id_type}, seen timestamp, set_hash string, keys array<bigint>, feature array<bigint>"

    @property
    def _leaders(self) -> str:
        return f"{self.path}/leaders"

    def survivors(self, schema: str) -> DataFrame:
        return read_batches(self.spark, f"{self.path}/documents", schema)

    def state(self, before: int | None = None, newest=None) -> DataFrame:
        rows = read_batches(self.spark, self._leaders, self._schema, before)
        if self.ttl is not None and newest is not None:
            rows = rows.where(F.col("seen") >= F.lit(newest) - F.make_dt_interval(secs=F.lit(float(self.ttl))))
        return rows

    def _described(self, batch: DataFrame) -> DataFrame:
        bands, values = sketch.PRESETS[self.preset]
        seen = F.col(self.ts).cast("timestamp") if self.ts else F.lit(None).cast("timestamp")
        words = batch.select(F.col(self.id_col).alias("ord"), seen.alias("seen"), sketch.word_set(F.coalesce(F.col(self.col), F.lit(""))).alias("feature"))
        signed = words.withColumn("sig", sketch.signature_of("feature", bands * values))
        return signed.select("ord", "seen", F.sha2(F.to_json("feature"), 256).alias("set_hash"),
                             sketch.band_keys("sig", bands, values).alias("keys"), "feature").repartition(
            int(batch.sparkSession.conf.get("spark.sql.shuffle.partitions")), "ord")

    def _known(self, arrived: DataFrame, state: DataFrame) -> DataFrame:
        """Ids of arrived documents that a survivor of earlier batches makes redundant; equal sets are settled by their hash."""
        same = staged(arrived.join(state.select("set_hash").distinct(), "set_hash", "left_semi").select("ord"), "same")
        return same.union(dedup.similar_to(arrived, state, same, self.threshold)).distinct()

    def take(self, batch: DataFrame, number: int) -> None:
        """One micro-batch: survivors go to documents/batch=n and, as state, to leaders/batch=n."""
        spark = batch.sparkSession
        with passing(spark), swept(spark):
            with dedup.by_ord(self._described(batch)) as worded:
                arrived = worded.where(F.size("feature") > 0)
                newest = worded.agg(F.max("seen")).first()[0]
                held = read_batches(self.spark, self._leaders, self._schema, number).agg(F.max("seen")).first()[0]
                newest = max((t for t in (newest, held) if t is not None), default=None)
                state = self.state(number, newest)
                gone = staged(arrived.select("ord").limit(0) if state.isEmpty() else self._known(arrived, state), "known")
                left = arrived.join(gone, "ord", "left_anti")
                within = dedup.near_dup_sets(left, worded, self.threshold).select(F.col("b").alias("ord"))
                dropped = staged(gone.union(within), "dropped")
                left.join(dropped, "ord", "left_anti").write.mode("overwrite").parquet(f"{self._leaders}/batch={number}")
            batch.join(dropped.withColumnRenamed("ord", self.id_col), self.id_col, "left_anti").write.mode("overwrite").parquet(
                f"{self.path}/documents/batch={number}")
        if self.ttl is not None and newest is not None:
            self._forget(newest, number)

    def _forget(self, newest, number: int) -> None:
        """Delete the state of batches whose every survivor is past its time."""
        rows = read_batches(self.spark, self._leaders, self._schema, number)
        limit = F.lit(newest) - F.make_dt_interval(secs=F.lit(float(self.ttl)))
        old = rows.groupBy("batch").agg(F.max("seen").alias("last")).where(F.col("last") < limit)
        remove(self.spark, *(f"{self._leaders}/batch={r['batch']}" for r in old.collect()))

    def run(self, sdf: DataFrame, checkpoint: str, trigger: dict | None = None):
        """Start the stream; returns the running query."""
        def held(batch: DataFrame, number: int) -> None:
            batch.persist()      # read for its signatures and again for what stays
            try:
                self.take(batch, number)
            finally:
                batch.unpersist()

        return sdf.writeStream.foreachBatch(held).option(
            "checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


@dataclass(frozen=True)
class LatestRows:
    """Upsert of a stream of changes: the row of each key that comes last in `order`.

    A batch leaves its own latest rows in changes/batch=n. Every `compact` batches they are folded into
    base/upto=n; a batch that is replayed after that is not taken again.
    """

    spark: SparkSession
    path: str
    schema: str
    key: str
    order: tuple
    compact: int = 16

    def latest(self, rows: DataFrame) -> DataFrame:
        columns = [f.name for f in T.StructType.fromDDL(self.schema)]
        rest = [c for c in columns if c != self.key]
        last = rows.groupBy(self.key).agg(F.max_by(F.struct(*rest), F.struct(*self.order)).alias("_last"))
        return last.select(self.key, "_last.*").select(columns)

    def _base(self) -> tuple[int, DataFrame]:
        done = _folders(self.spark, f"{self.path}/base", "upto")
        if not done:
            return -1, self.spark.createDataFrame([], self.schema)
        return done[-1], self.spark.read.schema(self.schema).parquet(f"{self.path}/base/upto={done[-1]}")

    def _changes(self, after: int) -> DataFrame:
        return read_batches(self.spark, f"{self.path}/changes", self.schema).where(F.col("batch") > after).drop("batch")

    def read(self) -> DataFrame:
        upto, base = self._base()
        return self.latest(base.union(self._changes(upto)))

    def take(self, batch: DataFrame, number: int) -> None:
        upto = self._base()[0]
        if number <= upto:
            return
        self.latest(batch).write.mode("overwrite").parquet(f"{self.path}/changes/batch={number}")
        if number - upto >= self.compact:
            self.fold(number)

    def fold(self, number: int) -> None:
        """Changes up to a batch become the base; what they replace is deleted after the new base is complete."""
        upto, _ = self._base()
        self.read().write.mode("overwrite").parquet(f"{self.path}/base/upto={number}")
        old = [f"{self.path}/changes/batch={n}" for n in _folders(self.spark, f"{self.path}/changes", "batch") if n <= number]
        remove(self.spark, *old, *([f"{self.path}/base/upto={upto}"] if upto >= 0 else []))

    def run(self, sdf: DataFrame, checkpoint: str, trigger: dict | None = None):
        return sdf.writeStream.foreachBatch(self.take).option("checkpointLocation", checkpoint).trigger(
            **(trigger or {"availableNow": True})).start()


def dropped_late(query) -> int:
    """Rows a finished or running query has left out because they came behind its watermark."""
    return sum(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators)
