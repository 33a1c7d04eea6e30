"""A folder of Parquet files with a commit log: appends that happen once, merges and compaction that readers see whole.

Each commit writes its rows to a folder of its own, ``data/_folder=<id>/_part=<value>``, and then one line for each part to
one new file in ``log``. Spark's committer renames that file into place, so a commit is seen whole or not at all; what a failed
write leaves behind is in no log and is never read. A commit carries the writer's transaction; one that is in
the log already is not written again. Merge and compaction drop exactly the folder parts that they have read, so appends that go on
meanwhile are kept. One merge or compaction runs at a time. Dropped files stay on disk until their folders are removed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

_LOG = StructType([StructField(n, t) for n, t in (("txn", StringType()), ("op", StringType()), ("folder", StringType()), ("part", StringType()), ("rows", LongType()))])


class Store:
    """Rows of ``schema`` in parts named by ``part`` (a day, a bucket); null parts are ``none``."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, part: Column | None = None):
        self.spark, self.path, self.schema = spark, path, schema
        name = F.lit("all") if part is None else F.coalesce(part.cast("string"), F.lit("none"))
        self.part = F.regexp_replace(name, "[^0-9A-Za-z-]", "-")

    def _record(self, lines: list[tuple]) -> None:
        self.spark.createDataFrame(lines, _LOG).coalesce(1).write.mode("append").json(f"{self.path}/log")  # one file

    def log(self) -> DataFrame:
        try:
            return self.spark.read.schema(_LOG).json(f"{self.path}/log")
        except Exception as ex:
            if "PATH_NOT_FOUND" not in str(ex):
                raise
            return self.spark.createDataFrame([], _LOG)

    def has(self, txn: str) -> bool:
        return not self.log().filter(F.col("txn") == txn).isEmpty()

    def live(self) -> DataFrame:
        """(folder, part, rows) of what readers see."""
        log = self.log()
        added, dropped = log.filter("op = 'add'"), log.filter("op = 'drop'")
        return added.join(dropped, ["folder", "part"], "left_anti").select("folder", "part", "rows")

    def _read(self, cells: list[tuple[str, str]], origin: bool = False) -> DataFrame:
        fields = [*self.schema.fields, StructField("_part", StringType())]
        if not cells:
            empty = self.spark.createDataFrame([], StructType([*fields, StructField("_folder", StringType())]))
            return empty if origin else empty.select(*self.schema.names)
        paths = [f"{self.path}/data/_folder={f}/_part={p}" for f, p in cells]
        fields.append(StructField("_folder", StringType()))
        whole = self.spark.read.schema(StructType(fields)).option("basePath", f"{self.path}/data").parquet(*paths)
        return whole if origin else whole.select(*self.schema.names)

    def read(self, parts: list[str] | None = None) -> DataFrame:
        """The stored rows; of the named parts only, if given."""
        live = self.live() if parts is None else self.live().filter(F.col("part").isin(parts))
        return self._read([(r.folder, r.part) for r in live.select("folder", "part").collect()])  # one line for each live file group

    def _write(self, df: DataFrame) -> tuple[str, list[tuple[str, int]]]:
        folder, seen = uuid.uuid4().hex, Observation()
        rows = df.select(*self.schema.names).withColumn("_part", self.part).observe(seen, F.count("*").alias("rows"))
        rows.write.partitionBy("_part").parquet(f"{self.path}/data/_folder={folder}")
        if not seen.get["rows"]:
            return folder, []
        found = self.spark.read.schema(StructType([StructField("_part", StringType())])).parquet(f"{self.path}/data/_folder={folder}").groupBy("_part").count()  # footers only
        return folder, [(r["_part"], r["count"]) for r in found.collect()]

    def append(self, df: DataFrame, txn: str) -> int:
        """Rows appended under ``txn``; none if that transaction has been committed before."""
        if self.has(txn):
            return 0
        folder, parts = self._write(df)
        self._record([(txn, "add", folder, p, n) for p, n in parts] or [(txn, "none", None, None, 0)])
        return sum(n for _, n in parts)

    def rewrite(self, cells: list[tuple[str, str]], change: Callable[[DataFrame], DataFrame], txn: str) -> None:
        """Puts ``change`` of the rows of some live (folder, part) in their place, in one commit."""
        if not cells or self.has(txn):
            return
        folder, parts = self._write(change(self._read(cells)))
        self._record([(txn, "add", folder, p, n) for p, n in parts] + [(txn, "drop", f, p, None) for f, p in cells])

    def touched(self, ids: DataFrame, key: str) -> list[tuple[str, str]]:
        """Live (folder, part) that hold one of the ids; reads the id column only."""
        cells = [(r.folder, r.part) for r in self.live().select("folder", "part").collect()]
        found = self._read(cells, origin=True).select(key, "_folder", "_part").join(ids.select(key).distinct(), key, "left_semi")
        return [(r["_folder"], r["_part"]) for r in found.select("_folder", "_part").distinct().collect()]

    def compact(self, least: int = 8, rows_per_file: int = 1_000_000) -> None:
        """Parts of ``least`` or more folders become one folder; a part's rows are spread over files of about ``rows_per_file``."""
        small = [r.part for r in self.live().groupBy("part").agg(F.count("*").alias("n")).filter(F.col("n") >= least).collect()]
        live = [r for r in self.live().filter(F.col("part").isin(small)).collect()] if small else []
        files = max(1, -(-sum(r.rows for r in live) // rows_per_file))
        # a hot part goes to several files: rows are dealt by part and a number
        spread = lambda d: d.withColumn("_p", self.part).withColumn("_s", F.pmod(F.xxhash64(*self.schema.names[:1]), F.lit(files))).repartition(max(files, len(small)), "_p", "_s").drop("_p", "_s")
        self.rewrite([(r.folder, r.part) for r in live], spread, f"compact/{uuid.uuid4().hex}")


def writer_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark keeps in a stream's checkpoint: another one for each new checkpoint, the same after a restart."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def append_stream(df: DataFrame, store: Store, checkpoint: str, required: tuple[str, ...] = (), compact_every: int = 100, interval: str = "500 milliseconds", available_now: bool = False, on_batch: Callable[[int, int, int], None] | None = None) -> StreamingQuery:
    """Append a stream to ``store``, each batch once, whatever checkpoints write to it; parts are compacted every few batches.

    Rows without a ``required`` field are refused. ``on_batch(batch_id, stored, refused)`` receives both counts.
    """
    fine = F.lit(True)
    for c in required:
        fine = fine & F.col(c).isNotNull()

    def write(batch: DataFrame, i: int) -> None:
        txn, seen = f"{writer_id(store.spark, checkpoint)}/{i}", Observation()
        rows = store.append(batch.observe(seen, F.count_if(~fine).alias("refused")).filter(fine), txn)
        if on_batch:
            on_batch(i, rows, int(seen.get["refused"]) if rows else int(batch.filter(~fine).count()))
        if compact_every and i % compact_every == compact_every - 1:
            store.compact(min(8, compact_every))

    w = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)).start()


def bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets))


def unseen_stream(df: DataFrame, store: Store, checkpoint: str, key: str, buckets: int, interval: str = "15 seconds", available_now: bool = False) -> StreamingQuery:
    """Append each id of a stream once to ``store``, whose parts are ``bucket(key, buckets)``.

    A batch reads the buckets of its own ids only. Ids that any checkpoint has stored are not stored again.
    """

    def step(batch: DataFrame, i: int) -> None:
        new = batch.dropDuplicates([key])
        asked = [str(r.b) for r in new.select(bucket(key, buckets).alias("b")).distinct().collect()]  # at most ``buckets``
        store.append(new.join(store.read(asked).select(key), key, "left_anti"), f"{writer_id(store.spark, checkpoint)}/{i}")
        store.compact()

    w = df.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)).start()
