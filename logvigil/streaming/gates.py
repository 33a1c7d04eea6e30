"""Stateful gates and counters on streams, and streamed deduplication."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions import constants as C
from ..operators.review import gate_key
from ..sources.store import Store, bucket, unseen_stream


def _keyed(df: DataFrame, keys: list[str], ts: str) -> DataFrame:
    return df.withColumns({"_k": gate_key(df, keys), "_s": F.unix_seconds(F.col(ts).cast("timestamp"))})


def _out_schema(df: DataFrame, name: str, dtype: T.DataType) -> T.StructType:
    return T.StructType([*df.schema.fields, T.StructField(name, dtype)])


def cooldown_gate_stream(df: DataFrame, keys: list[str], ts: str = "ts", tie: str = "event_id", cooldown: int = C.COOLDOWN_SECONDS, idle: int = 7 * 86_400) -> DataFrame:
    """The cooldown gate on a stream, judged by arrival: every row comes out, one that is behind its key's last pass
    without passing. State is that last time; a key without rows for ``idle`` seconds of the cluster's clock forgets it."""
    keyed = _keyed(df, keys, ts)
    schema = _out_schema(df, "gate_pass", T.IntegerType())

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        rows = pd.concat(list(batches)).sort_values(["_s", tie], kind="stable")
        t = rows["_s"].to_numpy()
        passed = np.zeros(len(t), dtype=np.int32)
        last = state.get[0] if state.exists else None
        i = 0 if last is None else int(np.searchsorted(t, last + cooldown, side="left"))
        while i < len(t):
            passed[i], last = 1, int(t[i])
            i = int(np.searchsorted(t, last + cooldown, side="left"))
        if last is not None:
            state.update((int(last),))
            state.setTimeoutDuration(idle * 1000)
        yield rows.assign(gate_pass=passed)[[f.name for f in schema.fields]]

    return keyed.groupBy("_k").applyInPandasWithState(step, schema, "last bigint", "append", GroupStateTimeout.ProcessingTimeTimeout)


def frequency_rule_stream(df: DataFrame, keys: list[str], frequency: int, timeframe: int, ts: str = "ts", tie: str = "event_id", late: int = 600, idle: int = 7 * 86_400) -> DataFrame:
    """Rows that complete ``frequency`` matches of a key within ``timeframe`` seconds; feed it the
    rows that match the parent rule. State: the counts per second of the last ``timeframe + late`` seconds, so that
    rows up to ``late`` seconds behind see all before them and older ones what is still known."""
    keyed = _keyed(df, keys, ts)
    schema = _out_schema(df, "matches", T.LongType())

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        rows = pd.concat(list(batches)).sort_values(["_s", tie], kind="stable")
        seconds, counts = (np.asarray(a, dtype=np.int64) for a in (state.get if state.exists else ([], [])))
        new, n = np.unique(rows["_s"].to_numpy(dtype=np.int64), return_counts=True)
        merged = pd.Series(np.concatenate([counts, n]), index=np.concatenate([seconds, new])).groupby(level=0).sum()
        s, total = merged.index.to_numpy(), np.concatenate([[0], merged.to_numpy().cumsum()])
        at = rows["_s"].to_numpy()
        upto, before = np.searchsorted(s, at, side="right"), np.searchsorted(s, at - timeframe, side="left")
        rows = rows.assign(matches=total[upto] - total[before])
        live = s >= s[-1] - timeframe - late
        state.update(([int(v) for v in s[live]], [int(v) for v in merged.to_numpy()[live]]))
        state.setTimeoutDuration(idle * 1000)
        yield rows[rows["matches"] >= frequency][[f.name for f in schema.fields]]

    return keyed.groupBy("_k").applyInPandasWithState(
        step, schema, "seconds array<bigint>, counts array<bigint>", "append", GroupStateTimeout.ProcessingTimeTimeout)


def sent_ids(spark: SparkSession, sent: str, schema: T.StructType, key: str = "doc_id", buckets: int = 64) -> Store:
    """The table of ids at ``sent``, in buckets of their hash."""
    return Store(spark, sent, schema, bucket(key, buckets))


def unseen_to(df: DataFrame, sent: str, checkpoint: str, key: str = "doc_id", buckets: int = 64, available_now: bool = False, interval: str = "15 seconds"):
    """Append each id of a stream once to the table at ``sent`` (see ``sent_ids``), however long ago and under whatever checkpoint
    it came first. A batch reads the buckets of its own ids only."""
    return unseen_stream(df, sent_ids(df.sparkSession, sent, df.schema, key, buckets), checkpoint, key, buckets, interval, available_now)


def first_per_id(df: DataFrame, key: str = "doc_id", ts: str = "ts", delay: str = "10 minutes") -> DataFrame:
    """Each id once while the watermark remembers it: unseen alerts and stored documents."""
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])
