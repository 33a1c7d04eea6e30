"""Token counts by a separator scan of flat token files.

A flat file is a run of token numbers without an index; end-of-document tokens divide it. Files come as blocks of equal size that
know only their place. Every block is searched at once for separators (one vector comparison). What a block cannot
know, how many documents and how many tokens of an unfinished one came before it, is a prefix scan over the blocks'
summaries: sums and maxima inside groups of ``GROUP`` blocks, then over the groups, so that even one huge file is not
ordered in one task. No token moves; only summaries are shuffled.

Null or empty blocks hold no tokens. Tokens after a file's last separator are a document that is not ``closed``.
Repeated (file, block) pairs are an error of the input; blocks may be missing numbers. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored
from .tokens import DTYPE, END_OF_DOCUMENT, VOCABULARY, coder

BLOCK = 1 << 16  # tokens
GROUP = 1024  # blocks
RUN = 256  # blocks that one task reads in a row: 32 MB
MOST_TASKS = 100_000


def flat_blocks(docs: DataFrame, block: int = BLOCK, vocabulary: str = VOCABULARY) -> DataFrame:
    """Stored (file, block, tokens, ended): each task writes one flat file; ``ended`` lists the ids of the documents whose
    separator is in the block, for checking and naming only."""
    get, kind = coder(docs.sparkSession, vocabulary), docs.schema["doc_id"].dataType.simpleString()
    end, size = np.array([END_OF_DOCUMENT], DTYPE).tobytes(), 2 * block

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, file, number, rest, ended, id_type = get(), TaskContext.get().partitionId(), 0, bytearray(), [], None

        def cut(data):
            return pa.RecordBatch.from_arrays([pa.array([file], pa.int32()), pa.array([number], pa.int64()), pa.array([bytes(data)], pa.binary()), pa.array([ended], pa.list_(id_type))], ["file", "block", "tokens", "ended"])

        for b in batches:
            id_type = b.schema.field("doc_id").type
            for d, t in zip(b.column("doc_id").to_pylist(), b.column("text")):
                data = memoryview(code.encode(t.as_py()) + end)
                while len(rest) + len(data) > size:
                    room = size - len(rest)
                    rest += data[:room]
                    data = data[room:]
                    yield cut(rest)
                    number, rest, ended = number + 1, bytearray(), []
                rest += data
                ended.append(d)
        if rest:
            yield cut(rest)

    return stored(docs.select("doc_id", "text").mapInArrow(write, f"file int, block bigint, tokens binary, ended array<{kind}>"), "flat")


def read_flat(spark, path: str, block: int = BLOCK, run: int = RUN) -> DataFrame:
    """(file, block, tokens): blocks of the flat files below ``path``, of any size.

    Spark lists names and lengths only. A row is a run of blocks of one file; rows are spread over the tasks, and a task
    opens the file through its file system and reads the run's bytes block by block. A lost task reads its runs again.
    """
    size, span = 2 * block, 2 * block * run
    files = spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), "length")
    first = F.explode(F.expr(f"sequence(0L, greatest(0L, (length - 1) div {span}))"))
    runs = files.select("file", "length", first.alias("run"))
    tasks = max(spark.sparkContext.defaultParallelism, min(MOST_TASKS, runs.agg(F.count("*")).first()[0]))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for b in batches:
            for file, length, at in zip(b.column("file").to_pylist(), b.column("length").to_pylist(), b.column("run").to_pylist()):
                system, name = fs.FileSystem.from_uri(_uri(file))
                with system.open_input_file(name) as f:
                    f.seek(at * span)
                    for number in range(at * run, min((at + 1) * run, max(1, -(-length // size)))):
                        yield pa.RecordBatch.from_arrays([pa.array([file]), pa.array([number], pa.int64()), pa.array([f.read(size)], pa.binary())], ["file", "block", "tokens"])

    return runs.repartition(tasks, "file", "run").mapInArrow(read, "file string, block bigint, tokens binary")


def _uri(path: str) -> str:
    """Spark's path as a standard one: a file's has three slashes, escaped as it was listed."""
    return "file://" + path.removeprefix("file:").removeprefix("//") if path.startswith("file:") else path


def summaries(blocks: DataFrame, separator: int = END_OF_DOCUMENT, keep: tuple[str, ...] = ()) -> DataFrame:
    """Stored (file, block, n, gaps, tail, *keep): tokens of the block, tokens before each of its separators since the
    one before (or since its start), and tokens after the last."""
    kind = dict(blocks.dtypes)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, gaps, tail = [], [], []
            for t in b.column("tokens"):
                x = np.frombuffer(t.as_py() or b"", DTYPE)
                at = np.flatnonzero(x == separator)
                n.append(len(x))
                gaps.append((np.diff(at, prepend=-1) - 1).astype(np.int64))
                tail.append(len(x) - (at[-1] + 1 if len(at) else 0))
            yield pa.RecordBatch.from_arrays([b.column("file"), b.column("block"), *[b.column(c) for c in keep], pa.array(n, pa.int64()), pa.array(gaps, pa.list_(pa.int64())), pa.array(tail, pa.int64())], ["file", "block", *keep, "n", "gaps", "tail"])

    columns = ["file", "block", *keep]
    schema = ", ".join(f"{c} {kind[c]}" for c in columns) + ", n bigint, gaps array<bigint>, tail bigint"
    return stored(blocks.select(*columns, "tokens").mapInArrow(search, schema), "summaries")


def stitched(found: DataFrame) -> DataFrame:
    """``summaries`` with, for each block, ``start`` (its first token's position in the file), ``doc`` (documents closed
    before it) and ``carry`` (tokens of the document that is open where it starts)."""
    before = lambda *part: Window.partitionBy(*part).orderBy("block" if "group" in part else "group").rowsBetween(Window.unboundedPreceding, -1)
    zero = lambda c: F.coalesce(c, F.lit(0).cast("bigint"))
    inner, outer = before("file", "group"), before("file")
    f = found.withColumn("group", F.expr(f"block div {GROUP}")).withColumn("docs", F.size("gaps").cast("bigint"))
    sums = f.groupBy("file", "group").agg(F.sum("n").alias("gn"), F.sum("docs").alias("gd"))
    sums = sums.select("file", "group", zero(F.sum("gn").over(outer)).alias("n0"), zero(F.sum("gd").over(outer)).alias("d0"))
    f = f.join(sums, ["file", "group"]).withColumns({"start": F.col("n0") + zero(F.sum("n").over(inner)), "doc": F.col("d0") + zero(F.sum("docs").over(inner))})
    f = f.withColumn("closed", F.when(F.col("docs") > 0, F.col("start") + F.col("n") - F.col("tail")))  # position behind the last separator
    tops = f.groupBy("file", "group").agg(F.max("closed").alias("gc")).select("file", "group", zero(F.max("gc").over(outer)).alias("c0"))
    f = f.join(tops, ["file", "group"]).withColumn("carry", F.col("start") - F.greatest("c0", zero(F.max("closed").over(inner))))
    return f.select(*found.columns, "start", "doc", "carry")


def block_counts(blocks: DataFrame, separator: int = END_OF_DOCUMENT, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row a block: ``counts``, the tokens of each document that ends in it, with ``start``, ``doc``, ``carry``, ``tail``."""
    f = stitched(summaries(blocks, separator, keep))
    return f.withColumn("counts", F.transform("gaps", lambda g, i: F.when(i == 0, g + F.col("carry")).otherwise(g)))


def documents(blocks: DataFrame, separator: int = END_OF_DOCUMENT) -> DataFrame:
    """file, doc, start, n_tokens, closed: every document of the flat files, by its number in the file."""
    f = stored(block_counts(blocks, separator), "counts")
    gaps = f.select("file", "doc", F.posexplode("counts").alias("i", "n_tokens"), (F.col("start") - F.col("carry")).alias("s0"), "counts")
    ends = F.aggregate(F.slice("counts", 1, F.col("i")), F.lit(0).cast("bigint"), lambda a, x: a + x + 1)
    closed = gaps.select("file", (F.col("doc") + F.col("i")).alias("doc"), (F.col("s0") + ends).alias("start"), "n_tokens", F.lit(True).alias("closed"))
    total = f.groupBy("file").agg(F.sum("n").alias("n"), F.sum(F.size("gaps")).cast("bigint").alias("doc"), F.coalesce(F.max(F.when(F.size("gaps") > 0, F.col("start") + F.col("n") - F.col("tail"))), F.lit(0).cast("bigint")).alias("start"))
    rest = total.filter("n > start").select("file", "doc", "start", (F.col("n") - F.col("start")).alias("n_tokens"), F.lit(False).alias("closed"))
    return closed.unionByName(rest)


def corpus_counts(docs: DataFrame, block: int = BLOCK, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, file, doc, n_tokens: tokens of every document, found by scanning the flat files that hold the corpus."""
    f = block_counts(flat_blocks(docs, block, vocabulary), keep=("ended",))
    each = f.select("file", "doc", F.posexplode(F.arrays_zip("ended", "counts")).alias("i", "x"))
    return each.select(F.col("x.ended").alias("doc_id"), "file", (F.col("doc") + F.col("i")).alias("doc"), F.col("x.counts").alias("n_tokens"))
