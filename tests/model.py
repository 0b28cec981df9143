"""Sequential model of the deployed job, one record at a time, in plain Python.

Per device: one bounded queue per trend metric (append when non-null, drop
the oldest beyond ``history``), range rules, trend rules against the queue's
mean once it is full, and an alert when anomalous and the last alert is more
than ``gap`` earlier (event time here).
"""

from __future__ import annotations

import math
from collections import defaultdict, deque

from vitalwatch.thresholds import DEFAULT, Thresholds


def _num(v):
    return None if v is None or (isinstance(v, float) and math.isnan(v)) else v


def run(rows, th: Thresholds = DEFAULT, gap_seconds: float | None = None):
    """``rows``: dicts sorted by (reading_ts, event_id). Returns dict event_id -> result."""
    gap = th.cooldown_seconds if gap_seconds is None else gap_seconds
    hist = defaultdict(lambda: {t.metric: deque(maxlen=th.history) for t in th.trends})
    last = {}
    out = {}
    for r in rows:
        d = r["device_id"]
        h = hist[d]
        for t in th.trends:
            v = _num(r[t.metric])
            if v is not None:
                h[t.metric].append(v)
        rules = {}
        for rule in th.rules:
            v = _num(r[rule.metric])
            hit = False
            if v is not None:
                hit = (rule.lo is not None and v < rule.lo) or (rule.hi is not None and v > rule.hi)
            rules[rule.metric] = hit
        trends = {}
        for t in th.trends:
            v = _num(r[t.metric])
            hit = False
            q = h[t.metric]
            if v is not None and len(q) == th.history:
                avg = sum(q) / len(q)
                if t.kind == "mul_above":
                    hit = v > avg * t.amount
                elif t.kind == "add_above":
                    hit = v > avg + t.amount
                else:
                    hit = v < avg * t.amount
            trends[t.metric] = hit
        anomalous = any(rules.values()) or any(trends.values())
        ts = r["reading_ts"]
        alert = False
        if anomalous and (d not in last or (ts - last[d]).total_seconds() > gap):
            alert = True
            last[d] = ts
        out[r["event_id"]] = {"rules": rules, "trends": trends, "is_anomaly": anomalous,
                              "alert": alert}
    return out
