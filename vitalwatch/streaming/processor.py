"""The keyed stateful step of the stream: trend histories, alert cooldown, event order.

Only what needs a device's past passes through Python: the time, the arrival order, the
eight trend metrics, whether a rule fired, and everything else of the row as one text
(``payload``). Rules, flags per metric and the final columns are built-in expressions
before and after (:mod:`vitalwatch.streaming.job`).

The key of the step is a bucket of devices (:func:`bucket_of`): a call, its data frames and its state
requests cost some ten milliseconds, which a call per device would pay for every device of every batch.
Within a call the rows are split by device again, and each device is processed by itself.

State of a bucket: one binary value with, for each of its devices, its :class:`Past` (the last values of
every trend metric, the time of the last alert and the newest event time) and the processing time of its last
input; and, with ``wait_us``, a list of binary chunks of rows that still wait. A bucket's state is read and
written as a whole, so the number of buckets should grow with the devices (about 100 devices each). It is fixed for
the life of a checkpoint: the state tells the number it was written with, and another is an error.

Order. A micro-batch's rows come in no set order, so they are sorted by arrival
(topic position, or whatever the job names) first.

* Without ``wait_us`` rows are processed in arrival order, as they were delivered; with
  the event time as first arrival column, in event order within a micro-batch only.
* With ``wait_us`` rows are processed in event order, whatever the micro-batches: a
  device's clock is its newest event time so far in arrival order, a row older than the
  clock by more than ``wait_us`` is late (returned with ``late``, never processed), and
  rows wait until the clock has passed them by ``wait_us``. No row that is not late can
  come before a released one, so neither flags nor late rows depend on batch bounds.
  Rows of a device that falls silent wait in the state until it sends again, until
  ``idle_ms`` of processing time have passed, or until the stream is drained.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..thresholds import DEFAULT, Thresholds
from .kernel import NEVER, Past, flag_rows

# Names that begin with an underscore reach Python as positions, so these begin with vw_.
STATE = T.StructType([T.StructField("pasts", T.BinaryType())])
CHUNK = T.StructType([T.StructField("rows", T.BinaryType())])
BUCKET, BUCKETS = "vw_bucket", 1024
CHUNK_ROWS = 65536  # waiting rows in one value of the list


def bucket_of(device: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(device), F.lit(buckets)).cast("int").alias(BUCKET)


# What leaves the step: one value per device and call. A data frame of two dozen columns for a few
# rows costs several times the work on them, so rows are spread out for many devices at once afterwards.
PACKED = T.StructType([T.StructField("device_id", T.StringType()), T.StructField("rows", T.BinaryType())])
WHOLE = ("vw_us", "vw_has", "vw_counts", "vw_trends", "alert", "late")


def step_schema(th: Thresholds) -> T.StructType:
    """The rows after the step, counts and flags of the trends packed into two numbers."""
    return T.StructType(
        [T.StructField("device_id", T.StringType()), T.StructField("vw_us", T.LongType()), T.StructField("vw_payload", T.StringType()),
         T.StructField("vw_has", T.IntegerType())]
        + [T.StructField(t.metric, T.DoubleType()) for t in th.trends]
        + [T.StructField(f"avg_{t.metric}", T.DoubleType()) for t in th.trends]
        + [T.StructField("vw_counts", T.LongType()), T.StructField("vw_trends", T.IntegerType()),
           T.StructField("alert", T.BooleanType()), T.StructField("late", T.BooleanType())])


def pack_out(cols: dict[str, np.ndarray], th: Thresholds) -> bytes:
    """Whole numbers, doubles and payloads (JSON texts hold no line end) of one device's rows."""
    n = len(cols["vw_us"])
    numbers = np.stack([cols[c].astype("<i8") for c in WHOLE])
    doubles = np.stack([cols[f"{p}{t.metric}"].astype("<f8") for p in ("", "avg_") for t in th.trends])
    return np.int64(n).tobytes() + numbers.tobytes() + doubles.tobytes() + "\n".join(cols["vw_payload"].tolist()).encode()


def spread_out(th: Thresholds):
    """Arrow batches of packed devices to batches of rows (``step_schema``)."""
    metrics = [f"{p}{t.metric}" for p in ("", "avg_") for t in th.trends]
    names = [f.name for f in step_schema(th).fields]
    kinds = {"vw_has": pa.int32(), "vw_trends": pa.int32(), "alert": pa.bool_(), "late": pa.bool_()}

    def run(batches):
        for b in batches:
            sizes, numbers, doubles, texts = [], [], [], []
            for data in b.column(1).to_pylist():
                n = int(np.frombuffer(data, "<i8", 1)[0])
                a, e = 8 + 8 * n * len(WHOLE), 8 + 8 * n * (len(WHOLE) + len(metrics))
                sizes.append(n)
                numbers.append(np.frombuffer(data[8:a], "<i8").reshape(-1, n))
                doubles.append(np.frombuffer(data[a:e], "<f8").reshape(-1, n))
                texts += data[e:].decode().split("\n")
            if not sizes:
                continue
            whole, real = np.concatenate(numbers, axis=1), np.concatenate(doubles, axis=1)
            out = {"device_id": b.column(0).take(pa.array(np.repeat(np.arange(len(sizes)), sizes))), "vw_payload": pa.array(texts, pa.string())}
            out |= {c: pa.array(whole[i]).cast(kinds.get(c, pa.int64())) for i, c in enumerate(WHOLE)}
            out |= {c: pa.array(real[i]) for i, c in enumerate(metrics)}
            yield pa.RecordBatch.from_arrays([out[c] for c in names], names=names)

    return run


def pack_rows(cols: dict[str, np.ndarray], about: dict[str, str] | None = None) -> bytes:
    table = pa.table({k: pa.array(v, from_pandas=False) for k, v in cols.items()}, metadata=about)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as w:
        w.write_table(table)
    return sink.getvalue().to_pybytes()


def unpack_rows(data: bytes) -> dict[str, np.ndarray]:
    table = pa.ipc.open_stream(data).read_all()
    return {k: table.column(k).to_numpy() for k in table.column_names}


def join_rows(parts: list[dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    return parts[0] if len(parts) == 1 else {k: np.concatenate([p[k] for p in parts]) for k in parts[0]}


def take(cols: dict[str, np.ndarray], rows: np.ndarray) -> dict[str, np.ndarray]:
    return {k: v[rows] for k, v in cols.items()}


def told(rows: list[tuple[str, bytes]]) -> pd.DataFrame:
    """Packed rows of devices (``PACKED``)."""
    return pd.DataFrame(rows, columns=["device_id", "rows"])


def pieces(cols: dict[str, np.ndarray], devices: np.ndarray, order: list[np.ndarray]) -> dict[str, dict[str, np.ndarray]]:
    """Device -> its rows, sorted by ``order`` (first key first)."""
    if not len(devices):
        return {}
    codes, names = pd.factorize(devices)
    rows = np.lexsort([*reversed(order), codes])
    cols = take(cols, rows)
    ends = np.cumsum(np.bincount(codes, minlength=len(names)))
    return {d: {k: v[a:e] for k, v in cols.items()} for d, a, e in zip(names, [0, *ends[:-1]], ends, strict=True)}


class Pasts:
    """The devices of a bucket: the dumped :class:`Past` of each, and when it last sent (processing time, ms)."""

    def __init__(self, buckets: int, past: dict[str, bytes] | None = None, seen: dict[str, int] | None = None):
        self.buckets, self.past, self.seen = buckets, past or {}, seen or {}

    def get(self, device: str, th: Thresholds) -> Past:
        return Past.load(self.past[device], th) if device in self.past else Past.new(th)

    def put(self, device: str, past: Past, now_ms: int) -> None:
        self.past[device], self.seen[device] = past.dump(), now_ms

    def forget(self, before_ms: int) -> None:
        """Drops the devices that have sent nothing since ``before_ms``."""
        for d in [d for d, t in self.seen.items() if t <= before_ms]:
            del self.past[d], self.seen[d]

    def dump(self) -> bytes:
        devices = list(self.past)
        return pack_rows({"device": np.array(devices, object), "past": np.array([self.past[d] for d in devices], object),
                          "seen": np.array([self.seen[d] for d in devices], np.int64)}, {"buckets": str(self.buckets)})

    @classmethod
    def load(cls, data: bytes, buckets: int | None = None) -> Pasts:
        table = pa.ipc.open_stream(data).read_all()
        written = int(table.schema.metadata[b"buckets"])
        if buckets is not None and buckets != written:
            raise ValueError(f"the state was written with {written} buckets, not {buckets}: their number is fixed for the life of a checkpoint")
        devices = table.column("device").to_pylist()
        return cls(written, dict(zip(devices, table.column("past").to_pylist(), strict=True)),
                   dict(zip(devices, table.column("seen").to_pylist(), strict=True)))


class DetectProcessor(StatefulProcessor):
    def __init__(self, arrival: list[str], th: Thresholds = DEFAULT, gap_seconds: float | None = None, wait_us: int | None = None,
                 ttl_ms: int | None = None, idle_ms: int | None = None, buckets: int = BUCKETS):
        if th.history > 255 or len(th.trends) > 8:
            raise ValueError("counts leave the step as a byte for each of at most eight trends")
        self.th, self.arrival, self.wait_us, self.ttl_ms, self.idle_ms, self.buckets = th, arrival, wait_us, ttl_ms, idle_ms, buckets
        self.gap_us = int(round((th.cooldown_seconds if gap_seconds is None else gap_seconds) * 1e6))
        self.kept = ["vw_us", "vw_payload", "vw_has", "rule_any", *arrival, *(t.metric for t in th.trends)]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("devices", STATE, self.ttl_ms)
        self.waiting = handle.getListState("waiting", CHUNK, self.ttl_ms) if self.wait_us is not None else None

    def _now(self, timerValues) -> int:
        timed = self.ttl_ms is not None or self.idle_ms is not None
        return timerValues.getCurrentProcessingTimeInMs() if timed else 0

    def _pasts(self, now_ms: int) -> Pasts:
        got = self.state.get()
        pasts = Pasts(self.buckets) if got is None else Pasts.load(bytes(got[0]), self.buckets)
        if self.ttl_ms is not None:
            pasts.forget(now_ms - self.ttl_ms)
        return pasts

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        """Take over the pasts of the bucket's devices from a stored table (see ``handover``)."""
        now = self._now(timerValues)
        pasts = self._pasts(now)
        for r in initialState.to_dict("records"):
            past = Past.new(self.th)
            past.history = [np.asarray([] if r[f"h_{t.metric}"] is None else r[f"h_{t.metric}"], float)[-self.th.history:] for t in self.th.trends]
            past.last_us = NEVER if pd.isna(r["last_alert_us"]) else int(r["last_alert_us"])
            past.clock_us = NEVER if pd.isna(r["clock_us"]) else int(r["clock_us"])
            pasts.put(r["device_id"], past, now)
        self.state.update((pasts.dump(),))

    def packed(self, cols: dict[str, np.ndarray], late: bool = False) -> bytes:
        n = len(cols["vw_us"])
        out = cols | {"late": np.full(n, late)}
        if late:
            out |= {f"avg_{t.metric}": np.full(n, np.nan) for t in self.th.trends}
            out |= {c: np.zeros(n, np.int64) for c in ("vw_counts", "vw_trends", "alert")}
        return pack_out(out, self.th)

    def flagged(self, cols: dict[str, np.ndarray], past: Past) -> bytes:
        return self.packed(flag_rows(cols, past, self.th, self.gap_us))

    def handleInputRows(self, key, rows, timerValues):
        frames = list(rows)
        pdf = frames[0] if len(frames) == 1 else pd.concat(frames, ignore_index=True)
        now = self._now(timerValues)
        pasts, out = self._pasts(now), []
        new = pieces({c: pdf[c].to_numpy() for c in self.kept}, pdf["device_id"].to_numpy(), [pdf[c].to_numpy() for c in self.arrival])
        held = self._held(pasts) if self.wait_us is not None else {}
        for device, cols in new.items():
            past = pasts.get(device, self.th)
            if self.wait_us is not None:
                ts = cols["vw_us"]
                before = np.maximum.accumulate(np.r_[past.clock_us, ts[:-1]])
                late = ts < before - self.wait_us
                past.clock_us = max(past.clock_us, int(ts.max()))
                if late.any():
                    out.append((device, self.packed(take(cols, np.flatnonzero(late)), True)))
                cols = self._released(device, take(cols, np.flatnonzero(~late)), held, past.clock_us - self.wait_us)
            if len(cols["vw_us"]):
                out.append((device, self.flagged(cols, past)))
            pasts.put(device, past, now)
        if self.wait_us is not None:
            self._keep(held)
            self._wake(held, pasts)
        self.state.update((pasts.dump(),))
        if out:
            yield told(out)

    def event_order(self, cols: dict[str, np.ndarray]) -> list[np.ndarray]:
        return [cols[c] for c in ("vw_us", *self.arrival)]

    def waiting_rows(self, chunks: list[bytes]) -> dict[str, dict[str, np.ndarray]]:
        """Device -> its rows of these chunks, in event order, equal times by arrival."""
        if not chunks:
            return {}
        cols = join_rows([unpack_rows(c) for c in chunks])
        return pieces(cols, cols.pop("device_id"), self.event_order(cols))

    def _held(self, pasts: Pasts) -> dict[str, dict[str, np.ndarray]]:
        held = self.waiting_rows([bytes(c[0]) for c in self.waiting.get()] if self.waiting.exists() else [])
        return {d: cols for d, cols in held.items() if d in pasts.past}

    def _released(self, device: str, new: dict[str, np.ndarray], held: dict, bound: int) -> dict[str, np.ndarray]:
        """Rows before ``bound`` in event order, equal times by arrival; the others wait on in ``held``."""
        cols = join_rows([held.pop(device), new]) if device in held else new
        cols = take(cols, np.lexsort(self.event_order(cols)[::-1]))
        ready = cols["vw_us"] < bound
        if not ready.all():
            held[device] = take(cols, np.flatnonzero(~ready))
        return take(cols, np.flatnonzero(ready))

    def _keep(self, held: dict[str, dict[str, np.ndarray]]) -> None:
        if held:
            cols = join_rows(list(held.values()))
            cols["device_id"] = np.repeat(np.array(list(held), object), [len(c["vw_us"]) for c in held.values()])
            n = len(cols["vw_us"])
            self.waiting.put([(pack_rows({k: v[a:a + CHUNK_ROWS] for k, v in cols.items()}),) for a in range(0, n, CHUNK_ROWS)])
        elif self.waiting.exists():
            self.waiting.clear()

    def _wake(self, held: dict, pasts: Pasts) -> None:
        """One timer per bucket: ``idle_ms`` after the last input of the device that has been silent longest."""
        if self.idle_ms is not None:
            for t in list(self.handle.listTimers()):
                self.handle.deleteTimer(t)
            if held:
                self.handle.registerTimer(min(pasts.seen[d] for d in held) + self.idle_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        """Some devices have been silent for ``idle_ms``: nothing of theirs waits any longer."""
        if self.waiting is None or not self.waiting.exists():
            return
        now = self._now(timerValues)
        pasts, out = self._pasts(now), []
        held = self._held(pasts)
        for device in [d for d in held if pasts.seen[d] + self.idle_ms <= now]:
            past, cols = pasts.get(device, self.th), held.pop(device)
            # what comes later and is older than these rows is late
            past.clock_us = max(past.clock_us, int(cols["vw_us"].max()) + self.wait_us)
            out.append((device, self.flagged(cols, past)))
            pasts.put(device, past, now)
        self._keep(held)
        self._wake(held, pasts)
        self.state.update((pasts.dump(),))
        if out:
            yield told(out)

    def close(self) -> None:
        pass
