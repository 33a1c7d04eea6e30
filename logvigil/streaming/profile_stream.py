"""Behaviour scoring as a stream: per-entity rings, baseline and error window as keyed state."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions import constants as C
from ..operators import peers as PE
from ..plans.dfp import decide, empty_result, prepare

_RESULT = ("seq", "port_entropy", "byte_variance", "recon_err", "err_count", "err_min", "err_max", "threshold")


def _windows(tail: np.ndarray, new: np.ndarray, width: int) -> np.ndarray:
    """For every new value the last ``width`` values up to it, padded with NaN in front."""
    both = np.concatenate([tail, new])
    padded = np.concatenate([np.full(width - 1, np.nan), both])
    return np.lib.stride_tricks.sliding_window_view(padded, width)[len(tail) :]


def _entropy(w: np.ndarray) -> np.ndarray:
    same = (w[:, :, None] == w[:, None, :]).sum(2)  # how often each entry's value occurs; NaN never
    n = np.isfinite(w).sum(1)
    logs = np.where(same > 0, np.log2(np.maximum(same, 1)), 0.0).sum(1)
    return np.where(n > 1, np.abs(np.log2(n) - logs / n), 0.0)


def _quantile(ordered: np.ndarray, n: np.ndarray, q: float) -> np.ndarray:
    """np.nanpercentile along each sorted row of ``n`` values (NaN behind them), all rows at once."""
    rows, pos = np.arange(len(ordered)), np.maximum(n - 1, 0) * q
    at = np.floor(pos).astype(int)
    low, high, t = ordered[rows, at], ordered[rows, np.minimum(at + 1, np.maximum(n - 1, 0))], pos - at
    step = high - low
    return np.where(t >= 0.5, high - step * (1 - t), low + step * t)


def _baseline(train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    std = train.std(0)
    return train.mean(0), np.where(std < 1e-6, 1.0, std)


@dataclass
class Known:
    """What is kept of an entity: its rows so far, its rings, its last errors, and its first rows or, from then on, their baseline."""

    n: int = 0
    ports: np.ndarray = field(default_factory=lambda: np.zeros(0))
    sizes: np.ndarray = field(default_factory=lambda: np.zeros(0))
    errors: np.ndarray = field(default_factory=lambda: np.zeros(0))
    training: np.ndarray = field(default_factory=lambda: np.zeros((0, len(C.TRAFFIC_FEATURES))))
    baseline: tuple[np.ndarray, np.ndarray] | None = None


def _advance(pdf: pd.DataFrame, k: Known) -> pd.DataFrame:
    """Score one entity's next rows in order; ``k`` becomes what is known after them."""
    ports, sizes = pdf["dstport"].to_numpy(float), pdf["total_bytes"].to_numpy(float)
    new = {name: np.full(len(pdf), np.nan) for name in _RESULT}
    new["seq"] = seq = k.n + 1 + np.arange(len(pdf))
    new["port_entropy"] = _entropy(_windows(k.ports, ports, C.RING_ROWS))
    new["byte_variance"] = np.nanvar(_windows(k.sizes, sizes, C.RING_ROWS), axis=1)
    x = np.column_stack([new[f] if f in new else pdf[f].to_numpy(float) for f in C.TRAFFIC_FEATURES])
    x = np.nan_to_num(x, nan=0.0, posinf=0.0, neginf=0.0)
    if k.baseline is None:
        k.training = np.concatenate([k.training, x[: C.TRAINING_ROWS - len(k.training)]])
        if len(k.training) == C.TRAINING_ROWS:
            k.baseline, k.training = _baseline(k.training), k.training[:0]
    scored = seq >= C.TRAINING_ROWS
    new["err_count"] = np.zeros(len(pdf), np.int64)
    err = new["recon_err"]
    if scored.any():
        mean, std = k.baseline
        err[scored] = (((x[scored] - mean) / std) ** 2).mean(1)
        ew = _windows(k.errors, err[scored], C.ERROR_ROWS)
        new["err_count"][scored] = np.isfinite(ew).sum(1)
        ordered, n = np.sort(ew, axis=1), (~np.isnan(ew)).sum(1)
        new["err_min"][scored], new["err_max"][scored] = ordered[:, 0], ordered[np.arange(len(n)), np.maximum(n - 1, 0)]
        new["threshold"][scored] = _quantile(ordered, n, C.ERROR_PERCENTILE)
    pdf = pd.concat([pdf, pd.DataFrame(new, index=pdf.index)], axis=1)
    last = lambda old, new, rows: np.concatenate([old, new])[-rows:]
    k.n += len(pdf)
    k.ports, k.sizes, k.errors = last(k.ports, ports, C.RING_ROWS), last(k.sizes, sizes, C.RING_ROWS), last(k.errors, err[scored], C.ERROR_ROWS)
    return pdf


BLOCK = 1024  # rows of an entity that are expanded into windows at once
IDLE_DAYS = 30


class ProfileProcessor(StatefulProcessor):
    """Keyed state in four values: rings, errors, the first rows until they are complete, and the baseline, which is then written.

    All forget an entity after ``idle`` milliseconds of the cluster's clock without rows; so that the baseline of an active entity
    stays, it is written again when half of that time has passed since it was.
    """

    def __init__(self, columns: list[str], ts: str, tie: str, idle: int, block: int = BLOCK):
        self.columns, self.ts, self.tie, self.idle, self.block = columns, ts, tie, idle, block

    def init(self, handle: StatefulProcessorHandle) -> None:
        value = lambda name, schema: handle.getValueState(name, schema, ttlDurationMs=self.idle)
        self.rings = value("rings", "n bigint, ports array<double>, sizes array<double>")
        self.errors = value("errors", "last array<double>")
        self.training = value("training", "rows array<double>")
        self.baseline = value("baseline", "mean array<double>, std array<double>, written bigint")

    def _load(self) -> tuple[Known, int | None]:
        k, floats, written = Known(), lambda a: np.asarray(a, float), None
        rings = self.rings.get()
        if rings is None:  # a new entity, or one that was idle for too long
            return k, None
        k.n, k.ports, k.sizes = int(rings[0]), floats(rings[1]), floats(rings[2])
        baseline = self.baseline.get()
        if baseline is not None:
            k.baseline, written = (floats(baseline[0]), floats(baseline[1])), int(baseline[2])
            k.errors = floats((self.errors.get() or ([],))[0])
        else:
            k.training = floats((self.training.get() or ([],))[0]).reshape(-1, len(C.TRAFFIC_FEATURES))
        return k, written

    def _store(self, k: Known, written: int | None, now: int) -> None:
        floats = lambda a: [float(v) for v in np.ravel(a)]
        self.rings.update((k.n, floats(k.ports), floats(k.sizes)))
        if k.baseline is None:
            self.training.update((floats(k.training),))
            return
        self.errors.update((floats(k.errors),))
        if written is None:
            self.training.clear()
        if written is None or now - written > self.idle // 2:
            self.baseline.update((floats(k.baseline[0]), floats(k.baseline[1]), now))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        known, written = self._load()
        data = pd.concat(list(rows)).sort_values([self.ts, self.tie], kind="stable")
        for lo in range(0, len(data), self.block):
            yield _advance(data.iloc[lo : lo + self.block], known)[self.columns]
        self._store(known, written, int(timerValues.getCurrentProcessingTimeInMs()))

    def close(self) -> None:
        pass


def stateful_windows(base: DataFrame, ts: str, tie: str, idle_days: int = IDLE_DAYS) -> DataFrame:
    """Sequence, rings, error and error window per entity from keyed state of fixed size.

    A micro-batch holds an entity's new rows only; ``maxFilesPerTrigger`` / ``maxOffsetsPerTrigger`` of the source bound them.
    They are put in order once and scored in blocks. State of this kind lives in RocksDB, which is switched on for the session.
    """
    base.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    types = {"seq": T.LongType(), "err_count": T.LongType()}
    fresh = [f for f in base.schema.fields if f.name not in _RESULT]
    schema = T.StructType(fresh + [T.StructField(n, types.get(n, T.DoubleType())) for n in _RESULT])
    processor = ProfileProcessor(schema.names, ts, tie, idle_days * 86_400_000)
    return base.groupBy("entity").transformWithStateInPandas(processor, schema, "append", "ProcessingTime")


def score_stream(e: DataFrame, ts: str = "ts", tie: str = "event_id", clock: Column | None = None, assignments: DataFrame | None = None, stats: DataFrame | None = None) -> DataFrame:
    """``dfp.score`` for a stream, replaying events in (ts, tie) order inside each micro-batch.

    The peer layer joins static tables (``assignments``, ``stats``) that a periodic batch job
    refreshes. Rows without an entity come out with status ``no_entity``.
    """
    base = prepare(e, ts, tie, clock)
    windows = stateful_windows(base.filter(F.col("entity").isNotNull()), ts, tie)
    wide = None if stats is None else PE.stats_wide(stats)
    null_error = F.nanvl("recon_err", F.lit(None).cast("double"))
    windows = windows.withColumns({"recon_err": null_error, "threshold": F.nanvl("threshold", F.lit(None).cast("double"))})
    out = decide(windows, ts, tie, assignments, wide)
    return out.unionByName(empty_result(base.filter(F.col("entity").isNull()), ts, tie, "no_entity"))


