"""Hot path against cold path where order keys repeat or are missing, and under a wrong clock."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from helpers import T0, make_readings
from pyspark.sql import functions as F

from vitalwatch.operators.cooldown import cooldown
from vitalwatch.operators.detect import check_hot, detect
from vitalwatch.operators.trends import chunks
from vitalwatch.session import ensure_checkpoint_dir
from vitalwatch.streaming.kernel import trend_steps
from vitalwatch.thresholds import DEFAULT

COLS = ["reading_ts", "heart_rate", "cnt_heart_rate", "avg_heart_rate", "trend_heart_rate", "is_anomaly"]


def _rows(n=60):
    return [{"event_id": None if i % 5 == 0 else i // 3, "heart_rate": None if i % 7 == 0 else 60.0 + (i * 37) % 50,
             "reading_ts": T0 + dt.timedelta(seconds=i // 4)} for i in range(n)]


@pytest.mark.parametrize("drop", [False, True])
def test_trends_with_repeated_order_keys(spark, drop):
    df = make_readings(spark, _rows() + _rows()[:20])
    df = df.drop("event_id") if drop else df
    plain = detect(df).select(*COLS)
    cut = detect(df, chunk_rows=6, hot=check_hot(df, 6)).select(*COLS)
    assert plain.count() == 80 and plain.exceptAll(cut).count() == 0 and cut.exceptAll(plain).count() == 0


@pytest.mark.parametrize("gap", [0, 5])
def test_cooldown_with_repeated_rows(spark, gap):
    df = make_readings(spark, _rows() + _rows()).select("device_id", "reading_ts", "event_id")
    plain, cut = cooldown(df, gap), cooldown(df, gap, chunk_rows=4)
    assert plain.select("reading_ts").exceptAll(cut.select("reading_ts")).count() == 0
    assert cut.count() == plain.count()


def test_chunks_go_by_rows(spark):
    rows = [{"event_id": i, "heart_rate": 70.0, "reading_ts": T0 + dt.timedelta(seconds=i)} for i in range(4000)]
    rows[0]["reading_ts"] = dt.datetime(1970, 1, 1)
    df = make_readings(spark, rows)
    sizes = [r["count"] for r in chunks(df, "device_id", ["reading_ts", "event_id"], check_hot(df, 100)).groupBy("_chunk").count().collect()]
    assert sum(sizes) == 4000 and max(sizes) <= 200


def test_a_nan_is_a_value_in_the_stream_step():
    values = np.array([[70.0] * 9 + [np.nan] + [70.0] * 3 + [100.0]])
    rule = DEFAULT.trends[:1]
    assert not trend_steps(values, np.ones((1, 14), bool), [np.array([])], 10, rule)[2].any()
    assert trend_steps(values, ~np.isnan(values), [np.array([])], 10, rule)[2][0, -1]


def test_scratch_folder_needs_a_shared_one_on_a_cluster(spark):
    class Conf:
        get = staticmethod(lambda name, default=None: default)

    class Context:
        master = "spark://host:1"
        getCheckpointDir = staticmethod(lambda: None)
        getConf = Conf

    class Session:
        sparkContext, conf = Context, Conf

    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(Session)
