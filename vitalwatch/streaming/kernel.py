"""Per-device steps of the stream, on one micro-batch of one device (numpy).

Both steps take the device's carried state and the batch's rows in order and
return per-row results plus the new state; neither loops per row in Python
over the whole batch.
"""

from __future__ import annotations

import numpy as np

from ..thresholds import Thresholds, TrendRule


def trend_steps(values: np.ndarray, present: np.ndarray, history: list[np.ndarray], size: int, rules: tuple[TrendRule, ...]):
    """Windows over the last ``size`` non-null values of every metric, current one included.

    ``values`` (metric x row) holds the batch's rows in order, ``present`` tells which have a value (a NaN that
    is present is a value, as in the batch window), ``history`` the last ``size`` values of each metric seen
    before. Returns (counts, means, flags, new history); counts and means are 0 and NaN on rows without a value.
    """
    k, n = values.shape
    new = [values[i, present[i]] for i in range(k)]
    longest, lead = max(map(len, new)), size - 1
    # values of a metric without gaps, new ones from column ``lead`` on; what is missing adds zero
    line = np.zeros((k, lead + longest))
    had = np.zeros(k, np.int64)
    for i, (old, more) in enumerate(zip(history, new, strict=True)):
        old = old[len(old) - lead:] if len(old) > lead else old
        had[i] = len(old)
        line[i, lead - len(old):lead], line[i, lead:lead + len(more)] = old, more
    # plain sum of the window, oldest value first, as the batch window adds it
    total = line[:, :longest].copy()
    for j in range(1, size):
        total += line[:, j:j + longest]
    count = np.minimum(had[:, None] + np.arange(1, longest + 1), size)
    mean = total / count
    x = line[:, lead:]
    amount = np.array([r.amount for r in rules])[:, None]
    times, above = (np.array([r.kind in kinds for r in rules])[:, None] for kinds in (("mul_above", "mul_below"), ("mul_above", "add_above")))
    bound = np.where(times, mean * amount, mean + amount)
    hit = np.where(above, x > bound, x < bound) & (count == size)
    counts, means, flags = np.zeros((k, n), np.int64), np.full((k, n), np.nan), np.zeros((k, n), bool)
    # the j-th value of a metric, in row order, back on its row
    filled = np.arange(longest)[None, :] < np.array([len(v) for v in new])[:, None]
    counts[present], means[present], flags[present] = count[filled], mean[filled], hit[filled]
    after = [np.concatenate([old, more])[-size:] if len(more) else old for old, more in zip(history, new, strict=True)]
    return counts, means, flags, after


def cooldown_step(times_us: np.ndarray, last_us: int | None, gap_us: int):
    """Greedy alerts over sorted anomaly times given the last alert time.

    Returns (alert mask, new last alert time).
    """
    n = len(times_us)
    keep = np.zeros(n, dtype=bool)
    i = 0 if last_us is None else int(np.searchsorted(times_us, last_us + gap_us, side="right"))
    last = last_us
    while i < n:
        keep[i] = True
        last = int(times_us[i])
        i = int(np.searchsorted(times_us, last + gap_us, side="right"))
    return keep, last


NEVER = -(2**62)  # no alert yet, no reading yet


class Past:
    """What a device carries from batch to batch: histories, last alert, newest event time (microseconds)."""

    def __init__(self, history: list[np.ndarray], last_us: int, clock_us: int):
        self.history, self.last_us, self.clock_us = history, last_us, clock_us

    @classmethod
    def new(cls, th: Thresholds) -> Past:
        return cls([np.zeros(0) for _ in th.trends], NEVER, NEVER)

    def dump(self) -> bytes:
        n = np.array([self.last_us, self.clock_us, *map(len, self.history)], "<i8")
        return n.tobytes() + np.concatenate(self.history).astype("<f8").tobytes()

    @classmethod
    def load(cls, data: bytes, th: Thresholds) -> Past:
        k = len(th.trends)
        n = np.frombuffer(data, "<i8", 2 + k)
        values = np.frombuffer(data, "<f8", offset=8 * (2 + k))
        return cls(np.split(values, np.cumsum(n[2:])[:-1]), int(n[0]), int(n[1]))


def flag_rows(cols: dict[str, np.ndarray], past: Past, th: Thresholds, gap_us: int) -> dict[str, np.ndarray]:
    """Rows of one device in their final order, with means, packed counts (8 bits a trend) and
    flags (a bit a trend), and alerts; ``past`` moves on."""
    k = len(th.trends)
    values = np.stack([cols[t.metric] for t in th.trends]).astype(float)
    present = (cols["vw_has"].astype(np.int64)[None, :] >> np.arange(k)[:, None] & 1).astype(bool)
    count, mean, hit, past.history = trend_steps(values, present, past.history, th.history, th.trends)
    place = np.arange(k)[:, None]
    counts, flags = (count << 8 * place).sum(0), (hit.astype(np.int64) << place).sum(0)
    # a mean is NaN where there is no value: NULL by the count afterwards
    out = cols | {f"avg_{t.metric}": mean[i] for i, t in enumerate(th.trends)}
    anomalous = np.flatnonzero(cols["rule_any"].astype(bool) | (flags != 0))
    times = cols["vw_us"][anomalous]
    # greedy over running event times: a row out of order never lies a gap after the last alert
    keep, last = cooldown_step(np.maximum.accumulate(times), None if past.last_us == NEVER else past.last_us, gap_us)
    past.last_us = NEVER if last is None else last
    alert = np.zeros(len(flags), bool)
    alert[anomalous[keep]] = True
    return out | {"vw_counts": counts, "vw_trends": flags, "alert": alert}
