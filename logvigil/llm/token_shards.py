"""Token-ID / binary output in training order.

A document's tokens and an end token are cut into sequences of ``length``, the last one filled up with end tokens.
Sequences are numbered over the stored table (the task's number and the place in it; one offset for each task), and a keyed
Feistel permutation with cycle-walking gives each number its slot: a bijection of 0 .. N-1 that needs no shuffle,
no table and no memory. Ranges of slots go to tasks, which write shards of ``shard_rows`` sequences of equal stride, so the
sequence of slot s is in shard s // shard_rows at byte (s % shard_rows) * stride: reading can start at any slot.

Null and empty texts are one sequence of end tokens. Null ids are kept. Repeated rows are sequences of their own.
An empty table gives no shard. The tokens of a sequence end at its first end token, which no text yields.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored
from .lm_bloom import mixed
from .tokens import DTYPE, END_OF_DOCUMENT, VOCABULARY, coder

LENGTH = 512
SHARD_ROWS = 4096
ROUNDS = 6
U = np.uint64


def _keys(seed: int) -> np.ndarray:
    return mixed(np.arange(1, ROUNDS + 1, dtype=U) * U(0x9E3779B97F4A7C15) + U(seed))


def _feistel(x: np.ndarray, half: int, keys: np.ndarray) -> np.ndarray:
    low = U((1 << half) - 1)
    left, right = x >> U(half), x & low
    for k in keys:
        left, right = right, left ^ (mixed(right ^ k) & low)
    return right << U(half) | left  # halves change places: the inverse is the same walk with the keys turned round


def permute(x: np.ndarray, n: int, seed: int, back: bool = False) -> np.ndarray:
    """Slot of each number below ``n`` (or, ``back``, the number of each slot): walk on until the value is below n."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    keys = _keys(seed)[::-1] if back else _keys(seed)
    out = _feistel(x.astype(U), half, keys)
    far = np.flatnonzero(out >= U(n))
    while len(far):
        out[far] = _feistel(out[far], half, keys)
        far = far[out[far] >= U(n)]
    return out.astype(np.int64)


def sequences(docs: DataFrame, length: int = LENGTH, vocabulary: str = VOCABULARY) -> DataFrame:
    """Stored (task, place, doc_id, piece, tokens): tokens are ``length`` two-byte numbers."""
    get, kind = coder(docs.sparkSession, vocabulary), docs.schema["doc_id"].dataType.simpleString()
    end, stride = np.array([END_OF_DOCUMENT], DTYPE).tobytes(), 2 * length

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, task, place = get(), TaskContext.get().partitionId(), 0

        def batch(ids, pieces, tokens, at, id_type):
            n = len(ids)
            return pa.RecordBatch.from_arrays([pa.array(np.full(n, task, np.int32)), pa.array(np.arange(at, at + n)), pa.array(ids, id_type), pa.array(pieces, pa.int32()), pa.array(tokens, pa.binary())],
                                              ["task", "place", "doc_id", "piece", "tokens"])

        for b in batches:
            id_type = b.schema.field("doc_id").type
            ids, pieces, tokens = [], [], []
            for d, t in zip(b.column("doc_id").to_pylist(), b.column("text")):
                data = code.encode(t.as_py()) + end
                data += end * (-len(data) % stride // 2)
                for i, at in enumerate(range(0, len(data), stride)):
                    ids.append(d)
                    pieces.append(i)
                    tokens.append(data[at:at + stride])
                    if len(ids) >= 2048:
                        yield batch(ids, pieces, tokens, place, id_type)
                        place += len(ids)
                        ids, pieces, tokens = [], [], []
            yield batch(ids, pieces, tokens, place, id_type)
            place += len(ids)

    return stored(docs.select("doc_id", "text").mapInArrow(cut, f"task int, place bigint, doc_id {kind}, piece int, tokens binary"), "sequences")


def slot_of(number: Column, n: int, seed: int) -> Column:
    @F.pandas_udf("bigint")
    def slots(x: pd.Series) -> pd.Series:
        return pd.Series(permute(x.to_numpy(), n, seed))

    return slots(number)


def shards(docs: DataFrame, seed: int = 17, length: int = LENGTH, shard_rows: int = SHARD_ROWS, ranges: int | None = None, vocabulary: str = VOCABULARY) -> DataFrame:
    """shard, first_slot, n_seq, stride, doc_ids, pieces, payload, sha256: one row for each shard, in ranges of shards."""
    rows = sequences(docs, length, vocabulary)
    kind, stride = rows.schema["doc_id"].dataType.simpleString(), 2 * length
    starts = rows.groupBy("task").count()  # one row for each task that cut texts
    starts = starts.select("task", F.coalesce(F.sum("count").over(Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start"))
    n = rows.count()
    parts = ranges or max(1, -(-n // (16 * shard_rows)))
    shard = F.expr(f"cast(slot div {shard_rows} as int)")
    placed = rows.join(F.broadcast(starts), "task").select(slot_of(F.col("start") + F.col("place"), n, seed).alias("slot"), "doc_id", "piece", "tokens")
    share = -(-(-(-n // shard_rows)) // parts) if n else 1  # shards in a range
    dealt = placed.withColumn("shard", shard).repartitionById(parts, F.expr(f"cast(shard div {share} as int)")).sortWithinPartitions("slot")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, ids, pieces, parts_ = None, [], [], []
        id_type = None

        def done():
            payload = b"".join(parts_)
            cells = [(open_, pa.int32()), (open_ * shard_rows, pa.int64()), (len(ids), pa.int32()), (stride, pa.int32()), (ids, pa.list_(id_type)), (pieces, pa.list_(pa.int32())), (payload, pa.binary()), (hashlib.sha256(payload).hexdigest(), pa.string())]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in cells], ["shard", "first_slot", "n_seq", "stride", "doc_ids", "pieces", "payload", "sha256"])

        for b in batches:
            id_type = b.schema.field("doc_id").type
            edges = np.flatnonzero(np.diff(s := np.asarray(b.column("shard")))) + 1
            for lo, hi in zip([0, *edges], [*edges, b.num_rows]):
                if hi <= lo:
                    continue
                if open_ is not None and s[lo] != open_:
                    yield done()
                    ids, pieces, parts_ = [], [], []
                open_ = int(s[lo])
                part = b.slice(lo, hi - lo)
                ids += part.column("doc_id").to_pylist()
                pieces += part.column("piece").to_pylist()
                parts_ += part.column("tokens").to_pylist()
        if open_ is not None:
            yield done()

    return dealt.mapInArrow(write, f"shard int, first_slot bigint, n_seq int, stride int, doc_ids array<{kind}>, pieces array<int>, payload binary, sha256 string")


def read_from(table: DataFrame, slot: int = 0, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(slot, doc_id, piece, tokens) from ``slot`` on, out of stored shards; earlier shards are not read."""
    kept = table.filter(F.col("shard") >= slot // shard_rows)
    each = kept.select("first_slot", "stride", "payload", "doc_ids", "pieces", F.explode(F.sequence(F.lit(0), F.col("n_seq") - 1)).alias("i"))
    out = each.select((F.col("first_slot") + F.col("i")).alias("slot"), F.get("doc_ids", F.col("i")).alias("doc_id"), F.get("pieces", F.col("i")).alias("piece"), F.expr("substring(payload, i * stride + 1, stride)").alias("tokens"))
    return out.filter(F.col("slot") >= slot)


def export(table: DataFrame, folder: str) -> DataFrame:
    """Writes each shard as ``shard-<number>.bin`` below the shared ``folder`` (a URI) and returns (shard, bytes, file).

    A file gets its name only when it is whole, so a repeated task does no harm.
    """

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        for b in batches:
            for shard, payload in zip(b.column("shard").to_pylist(), b.column("payload").to_pylist()):
                name = f"{base}/shard-{shard:08d}.bin"
                part = f"{name}.{TaskContext.get().taskAttemptId()}.part"
                with store.open_output_stream(part) as f:
                    f.write(payload)
                store.move(part, name)
                yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([len(payload)], pa.int64()), pa.array([name])], ["shard", "bytes", "file"])

    return table.select("shard", "payload").mapInArrow(put, "shard int, bytes bigint, file string")
