"""The physical plans the design relies on (checked with the executed plan)."""

from __future__ import annotations

import re

from conftest import SF0001

from vitalwatch.operators.cooldown import cooldown
from vitalwatch.operators.detect import check_hot, detect
from vitalwatch.plans import catalog
from vitalwatch.plans import dashboard as D
from vitalwatch.sources.tables import readings


def _plan(df) -> str:
    jvm = df.sparkSession.sparkContext._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def _nodes(plan: str, name: str) -> list[str]:
    return re.findall(rf"^\(\d+\) {name}\b", plan, re.M)


def test_eight_windows_share_one_exchange(spark):
    plan = _plan(detect(readings(spark, SF0001)))
    assert len(_nodes(plan, "Exchange")) == 1 and plan.count("hashpartitioning(device_id") == 1
    assert len(_nodes(plan, "Window")) == 8
    # the scan reads only the four columns the view needs
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,value:double>" in plan


def test_cooldown_reuses_the_device_partitioning(spark):
    r = readings(spark, SF0001)
    hot = check_hot(r)
    a = detect(r, hot=hot).where("is_anomaly").select("device_id", "reading_ts", "event_id")
    plan = _plan(cooldown(a, 60, hot=hot))
    assert len(_nodes(plan, "Exchange")) == 1 and _nodes(plan, "FlatMapGroupsInArrow")


def test_hot_path_broadcast_is_size_checked(spark):
    from vitalwatch.operators.trends import add_trend_columns

    r = readings(spark, SF0001)
    hot = check_hot(r, chunk_rows=20)
    assert hot.n_keys > 0
    hinted = add_trend_columns(r, hot=hot, chunk_rows=20)
    assert "strategy=broadcast" in hinted._jdf.queryExecution().analyzed().toString()
    assert _nodes(_plan(hinted), "BroadcastHashJoin")
    # above the limit no broadcast is asked for; Spark decides from its own size estimate
    unhinted = add_trend_columns(r, hot=hot, chunk_rows=20, broadcast_rows=0)
    assert "strategy=broadcast" not in unhinted._jdf.queryExecution().analyzed().toString()


def test_dashboard_prunes_partitions_and_pushes_time(spark):
    t = catalog.flagged_table(spark, SF0001)
    plan = _plan(D.top_recent(t, "2024-01-05 00:00:00", "2024-01-06 12:00:00"))
    assert "TakeOrderedAndProject" in plan
    assert "PartitionFilters: [isnotnull(reading_date" in plan
    pushed = [ln for ln in plan.splitlines() if ln.startswith("PushedFilters")][0]
    assert "GreaterThanOrEqual(reading_ts,2024-01-05T00:00)" in pushed
    assert "LessThanOrEqual(reading_ts,2024-01-06T12:00)" in pushed
    assert "EqualTo(is_anomaly,true)" in pushed
    last = _plan(D.last_not_null(t, "2024-01-05 00:00:00", "2024-01-06 12:00:00"))
    assert "max_by" in last and not _nodes(last, "Sort")
