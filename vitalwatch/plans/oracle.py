"""The same questions as plain SQL, for DuckDB over the given parquet tables.

Used as the correctness oracle: each text is independent of the Spark code
path (window SQL, recursive CTE for the cooldown) and built from the same
thresholds, so a changed bound changes both sides.
"""

from __future__ import annotations

from ..sources.messages import ARRIVAL_SECONDS
from ..sources.tables import readings_sql, skewed_readings_sql
from ..thresholds import (ALERT_BODY_HEAD, ALERT_BODY_TAIL, ALERT_BULLET, ALERT_SUBJECT, CLAMP_BOUNDS, DEFAULT,
                          FLAG_RED_FROM, HOUR_BANDS, METRIC_RED_FROM, RECENT_LIMIT, Thresholds)

SERIES = ("heart_rate", "temperature", "systolic_pressure", "diastolic_pressure",
          "oxygen_saturation", "respiration_rate", "blood_glucose", "stress_level")
ALL_METRICS = ("heart_rate", "temperature", "systolic_pressure", "diastolic_pressure",
               "oxygen_saturation", "respiration_rate", "blood_glucose", "steps_count",
               "calories_burned", "stress_level")


def _num(x: float) -> str:
    return repr(float(x))


def _rule_sql(r) -> str:
    parts = [f"{r.metric} {op} {_num(b)}" for op, b in (("<", r.lo), (">", r.hi)) if b is not None]
    return f"coalesce({' OR '.join(parts)}, false)"


def detected_cte(th: Thresholds = DEFAULT, base: str | None = None) -> str:
    h = th.history
    wins = []
    for t in th.trends:
        m = t.metric
        w = (f"(PARTITION BY device_id, {m} IS NOT NULL ORDER BY reading_ts, event_id "
             f"ROWS BETWEEN {h - 1} PRECEDING AND CURRENT ROW)")
        wins.append(f"count({m}) OVER {w} AS cnt_{m}, avg({m}) OVER {w} AS avg_{m}")
    rules = [f"{_rule_sql(r)} AS rule_{r.metric}" for r in th.rules]
    trends = []
    for t in th.trends:
        m = t.metric
        cond = {"mul_above": f"{m} > avg_{m} * {_num(t.amount)}",
                "add_above": f"{m} > avg_{m} + {_num(t.amount)}",
                "mul_below": f"{m} < avg_{m} * {_num(t.amount)}"}[t.kind]
        trends.append(f"coalesce(cnt_{m} = {h} AND {cond}, false) AS trend_{m}")
    rule_any = " OR ".join(f"rule_{r.metric}" for r in th.rules)
    trend_any = " OR ".join(f"trend_{t.metric}" for t in th.trends)
    return f"""readings AS ({base or readings_sql('duckdb')}),
windowed AS (SELECT *, {', '.join(wins)} FROM readings),
flags AS (SELECT *, {', '.join(rules)}, {', '.join(trends)} FROM windowed),
detected AS (SELECT *, ({rule_any}) AS rule_any, ({trend_any}) AS trend_any,
                    ({rule_any}) OR ({trend_any}) AS is_anomaly FROM flags)"""


def _raw_cte() -> str:
    """The readings with the columns the raw-message fixture is damaged by."""
    return (f"raw_src AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k "
            f"FROM ({readings_sql('duckdb', 'event_type, props')}) s)")


def _dmg(kind: str) -> str:
    return f"(event_type = '{kind}' AND k < 10)"


ISO = ("strftime(reading_ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN microsecond(reading_ts) % 1000000 = 0 "
       "THEN '' ELSE strftime(reading_ts, '.%f') END")


def _message(by_name: bool = False) -> str:
    """The message text of a row: fields as sent, or by name as the bridge writes them again.

    A missing value is left out as sent, or written as null by the messages that are damaged that way. Sent
    again, a number has no end zeros; a text cut short lacks its last character.
    """
    spaced = "(event_type = 'view' AND k >= 10 AND k < 20)"
    time = f"CASE WHEN {spaced} THEN replace({ISO}, 'T', ' ') ELSE {ISO} END"
    nulls, text = _dmg("view"), _dmg("click")
    quote = lambda x: f"'\"' || {x} || '\"'"
    fields = {"device_id": f"CASE WHEN {_dmg('signup')} THEN NULL ELSE {quote('device_id')} END",
              "timestamp": f"CASE WHEN {_dmg('purchase')} THEN '\"2024\"' ELSE {quote(time)} END"}
    for m in ALL_METRICS:
        plain = f"CAST({m} AS VARCHAR)"
        number = f"regexp_replace({plain}, '\\.0$', '')" if by_name else plain
        if m == "heart_rate":
            number = f"CASE WHEN {text} THEN {quote(plain)} WHEN {nulls} THEN NULL ELSE {number} END"
        fields[m] = f"coalesce({number}, CASE WHEN {nulls} THEN 'null' END)"
    fields["event_id"] = "CAST(event_id AS VARCHAR)"
    names = sorted(fields) if by_name else list(fields)
    parts = ", ".join(f"'\"{n}\":' || {fields[n]}" for n in names)
    whole = "'{' || concat_ws(',', " + parts + ") || '}'"
    return whole if by_name else f"CASE WHEN {_dmg('error')} THEN left({whole}, length({whole}) - 1) ELSE {whole} END"


def parse_queries() -> dict[str, str]:
    cte = "WITH " + _raw_cte()
    out = {}
    good = f"NOT ({_dmg('error')} OR {_dmg('signup')} OR {_dmg('purchase')})"
    cols = []
    for m in ALL_METRICS:
        cols.append(f"CASE WHEN {_dmg('view')} THEN NULL ELSE {m} END AS {m}" if m == "heart_rate"
                    else m)
    out["parse_roundtrip"] = (f"{cte} SELECT event_id, device_id, reading_ts, {', '.join(cols)} "
                              f"FROM raw_src WHERE {good}")
    lcols = []
    for m in ALL_METRICS:
        if m == "heart_rate":
            lcols.append(f"CASE WHEN {_dmg('view')} THEN 0.0 ELSE {m} END AS {m}")
        elif m == "steps_count":
            lcols.append(m)
        else:
            lcols.append(f"CASE WHEN {_dmg('view')} THEN coalesce({m}, 0.0) ELSE {m} END AS {m}")
    out["parse_lenient"] = f"{cte} SELECT event_id, device_id, reading_ts, {', '.join(lcols)} FROM raw_src WHERE {good}"
    out["quarantine_split"] = (f"{cte} SELECT event_id, CASE WHEN {_dmg('error')} THEN 'bad_json' "
                               f"WHEN {_dmg('signup')} THEN 'missing_key' "
                               f"WHEN {_dmg('purchase')} THEN 'bad_timestamp' END AS reason, "
                               f"CASE WHEN {_dmg('error')} OR {_dmg('signup')} OR {_dmg('purchase')} THEN {_message()} END AS raw "
                               f"FROM raw_src")
    out["prj_timestamp"] = (f"{cte} SELECT event_id, CASE WHEN {_dmg('error')} OR {_dmg('purchase')} "
                            f"THEN NULL ELSE reading_ts END AS reading_ts FROM raw_src")
    out["forward_split"] = (f"{cte} SELECT event_id, CASE WHEN {_dmg('error')} OR {_dmg('signup')} "
                            f"THEN NULL ELSE device_id END AS key, "
                            f"CASE WHEN {_dmg('error')} THEN 'bad_json' END AS reason, "
                            f"CASE WHEN NOT {_dmg('error')} THEN {_message(by_name=True)} END AS value FROM raw_src")
    return out


def _range(start: str, end: str) -> str:
    return f"reading_ts BETWEEN TIMESTAMP '{start}' AND TIMESTAMP '{end}'"


ALERTS = "SELECT a.device_id, a.reading_ts, a.event_id FROM chain JOIN a USING (device_id, rn)"


def cooldown_sql(gap_seconds: int, th: Thresholds = DEFAULT, base: str | None = None,
                 tail: str | None = ALERTS) -> str:
    text = f"""WITH RECURSIVE {detected_cte(th, base)},
a AS (SELECT device_id, reading_ts, event_id,
             row_number() OVER (PARTITION BY device_id ORDER BY reading_ts, event_id) AS rn
      FROM detected WHERE is_anomaly),
nx AS (SELECT p.device_id, p.rn, min(q.rn) AS nrn
       FROM a p LEFT JOIN a q ON q.device_id = p.device_id
            AND q.reading_ts > p.reading_ts + INTERVAL {int(gap_seconds)} SECOND
       GROUP BY p.device_id, p.rn),
chain AS (SELECT device_id, rn FROM a WHERE rn = 1
          UNION ALL
          SELECT n.device_id, n.nrn FROM chain c JOIN nx n ON n.device_id = c.device_id AND n.rn = c.rn
          WHERE n.nrn IS NOT NULL)"""
    return text if tail is None else f"{text}\n{tail}"


def _one_digit(x: str) -> str:
    """``%.1f`` of a number, half up, from its six-digit decimal."""
    return f"CAST(CAST(CAST({x} AS DECIMAL(18, 6)) AS DECIMAL(18, 1)) AS VARCHAR)"


def _text(pattern: str, values: list[str]) -> str:
    """A message pattern as SQL concatenation."""
    parts = pattern.split("%.1f")
    out = []
    for i, part in enumerate(parts):
        out.append("'" + part.replace("%%", "%").replace("'", "''") + "'")
        out += [_one_digit(values[i])] if i < len(values) else []
    return " || ".join(out)


def alert_text_sql(th: Thresholds = DEFAULT) -> str:
    """Alerts with subject, body and messages (joined by line ends)."""
    msgs = [f"CASE WHEN rule_{r.metric} THEN "
            + _text(r.message, [r.metric] + [_num(b) for b in (r.lo, r.hi) if b is not None]) + " END"
            for r in th.rules]
    msgs += [f"CASE WHEN trend_{t.metric} THEN {_text(t.message, [t.metric, f'avg_{t.metric}'])} END"
             for t in th.trends]
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    head_a, head_b = ALERT_BODY_HEAD.split("{ts}")
    pre, post = ALERT_BULLET.split("{msg}")
    iso = ("strftime(reading_ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN microsecond(reading_ts) % 1000000 = 0 "
           "THEN '' ELSE strftime(reading_ts, '.%f') END")
    return f"""{cooldown_sql(th.cooldown_seconds, th, tail=None)},
kept AS (SELECT a.event_id FROM chain JOIN a USING (device_id, rn)),
texts AS (SELECT event_id, device_id, reading_ts,
                 list_filter([{', '.join(msgs)}], lambda x: x IS NOT NULL) AS ms
          FROM detected JOIN kept USING (event_id))
SELECT event_id, device_id, reading_ts, {quoted(ALERT_SUBJECT)} || device_id AS subject,
       {quoted(head_a)} || {iso} || {quoted(head_b)}
       || list_aggregate(list_transform(ms, lambda x: {quoted(pre)} || x || {quoted(post)}), 'string_agg', '')
       || {quoted(ALERT_BODY_TAIL)} AS body,
       list_aggregate(ms, 'string_agg', chr(10)) AS messages FROM texts"""


def oracle_queries(start: str, end: str, rule_ids: dict, trend_ids: dict,
                   th: Thresholds = DEFAULT) -> dict[str, str]:
    cte = "WITH " + detected_cte(th)
    rng = _range(start, end)
    out: dict[str, str] = {}
    for qid, m in rule_ids.items():
        out[qid] = f"{cte} SELECT event_id, device_id, reading_ts, {m}, rule_{m} FROM detected"
    out["rule_any"] = f"{cte} SELECT event_id, rule_any FROM detected"
    for qid, m in trend_ids.items():
        out[qid] = (f"{cte} SELECT event_id, device_id, reading_ts, {m}, cnt_{m}, trend_{m} "
                    f"FROM detected")
    out["trend_any"] = f"{cte} SELECT event_id, trend_any FROM detected"
    out["is_anomaly"] = (f"{cte} SELECT event_id, device_id, reading_ts, {', '.join(ALL_METRICS)}, "
                         f"is_anomaly FROM detected")
    out["win_moving_avg"] = (f"{cte} SELECT event_id, "
                             + ", ".join(f"avg_{t.metric}" for t in th.trends) + " FROM detected")
    codes = ", ".join([f"CASE WHEN rule_{r.metric} THEN 'rule_{r.metric}' END" for r in th.rules]
                      + [f"CASE WHEN trend_{t.metric} THEN 'trend_{t.metric}' END"
                         for t in th.trends])
    out["message_list"] = (f"{cte} SELECT event_id, concat_ws(',', {codes}) AS codes "
                           f"FROM detected WHERE is_anomaly")
    out["alert_cooldown"] = cooldown_sql(th.cooldown_seconds, th)
    out["alert_cooldown_2h"] = cooldown_sql(7200, th)
    for m in SERIES:
        out[f"series_{m}"] = (f"{cte} SELECT reading_ts AS time, {m} FROM readings WHERE {rng} "
                              f"ORDER BY reading_ts, event_id")
    out["series_overlay"] = cte + " " + " UNION ALL ".join(
        f"SELECT reading_ts AS time, '{m}' AS metric, CAST({m} AS DOUBLE) AS value "
        f"FROM readings WHERE {rng}" for m in SERIES)
    out["top_recent"] = (f"{cte} SELECT reading_ts AS time, device_id, {', '.join(SERIES)}, "
                         f"is_anomaly FROM detected WHERE is_anomaly = TRUE AND {rng} "
                         f"ORDER BY reading_ts DESC, event_id DESC LIMIT {RECENT_LIMIT}")
    out["flag_series"] = (f"{cte} SELECT reading_ts AS time, CAST(is_anomaly AS INTEGER) AS is_anomaly "
                          f"FROM detected WHERE {rng} ORDER BY reading_ts, event_id")
    last = (f"(SELECT CAST(is_anomaly AS INTEGER) FROM detected WHERE {rng} AND is_anomaly IS NOT NULL "
            f"ORDER BY reading_ts DESC, event_id DESC LIMIT 1)")
    out["last_not_null"] = f"{cte} SELECT {last} AS last_flag"
    out["no_value"] = f"{cte} SELECT coalesce(CAST({last} AS VARCHAR), 'N/A') AS display"

    def band(v: str, red: float) -> str:
        return f"CASE WHEN {v} IS NULL THEN NULL WHEN {v} >= {_num(red)} THEN 'red' ELSE 'green' END"

    out["band"] = (f"{cte} SELECT reading_ts AS time, event_id, "
                   f"{band('CAST(is_anomaly AS INTEGER)', FLAG_RED_FROM)} AS flag_band, "
                   + ", ".join(f"{band(m, METRIC_RED_FROM)} AS band_{m}" for m in SERIES)
                   + f" FROM detected WHERE {rng}")
    out["range_preset"] = (f"{cte} SELECT reading_ts AS time, CAST(is_anomaly AS INTEGER) AS is_anomaly "
                           f"FROM detected WHERE reading_ts BETWEEN "
                           f"(SELECT max(reading_ts) FROM readings) - INTERVAL 7 DAY "
                           f"AND (SELECT max(reading_ts) FROM readings) ORDER BY reading_ts, event_id")
    out.update(parse_queries())
    flags = ", ".join([*(f"rule_{r.metric}" for r in th.rules), "rule_any",
                       *(f"{p}_{t.metric}" for t in th.trends for p in ("cnt", "avg", "trend")), "trend_any", "is_anomaly"])
    out["stream_detect"] = f"{cte} SELECT event_id, device_id, reading_ts, {', '.join(ALL_METRICS)}, {flags} FROM detected"
    out["stream_cooldown"] = f"SELECT device_id, reading_ts, event_id, subject, body FROM ({alert_text_sql(th)}) t"
    out["stream_two_runs"] = out["is_anomaly"]
    out["device_history"] = out["is_anomaly"] + " WHERE device_id = (SELECT min(device_id) FROM readings)"
    out["refresh_top_recent"] = (f"{cte} SELECT reading_ts AS time, device_id, {', '.join(SERIES)}, is_anomaly FROM detected "
                                 f"WHERE is_anomaly ORDER BY reading_ts DESC, event_id DESC LIMIT {RECENT_LIMIT}")
    out["refresh_last_flag"] = (f"{cte} SELECT CAST(is_anomaly AS INTEGER) AS last_flag FROM detected "
                                f"ORDER BY reading_ts DESC, event_id DESC LIMIT 1")
    out["refresh_per_day"] = (f"{cte} SELECT CAST(CAST(reading_ts AS DATE) AS VARCHAR) AS day, count(*) AS n_readings, "
                              f"count(*) FILTER (is_anomaly) AS n_anomalies FROM detected GROUP BY 1")
    sent = f"({readings_sql('duckdb')})"
    seq = f"reading_ts + to_seconds({ARRIVAL_SECONDS})"
    told = (f"SELECT *, coalesce(reading_ts < max(reading_ts) OVER (PARTITION BY device_id ORDER BY seq, event_id "
            f"ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 2 HOUR, false) AS late "
            f"FROM (SELECT *, {seq} AS seq FROM {sent} r) s")
    out["stream_out_of_order"] = (f"WITH told AS ({told}), {detected_cte(th, 'SELECT * FROM told WHERE NOT late')} "
                                  f"SELECT event_id, rule_any::VARCHAR AS rule_any, trend_any::VARCHAR AS trend_any, "
                                  f"is_anomaly::VARCHAR AS is_anomaly, NULL::VARCHAR AS reason FROM detected "
                                  f"UNION ALL SELECT event_id, NULL, NULL, NULL, 'late' FROM told WHERE late")
    out["stream_resumed"] = (f"{cooldown_sql(7200, th, tail=None)}, kept AS ({ALERTS}) SELECT event_id, trend_any, is_anomaly, "
                             f"event_id IN (SELECT event_id FROM kept) AS alert FROM detected")
    out["sink_constraints"] = f"""WITH {_raw_cte()}, d AS (SELECT event_id,
  CASE WHEN {_dmg('error')} THEN rpad(device_id, 300, 'x') WHEN NOT {_dmg('signup')} THEN device_id END AS device_id,
  CASE WHEN NOT {_dmg('purchase')} THEN reading_ts END AS reading_ts,
  CASE WHEN {_dmg('view')} THEN false ELSE {' OR '.join(_rule_sql(r) for r in th.rules)} END AS is_anomaly FROM raw_src)
SELECT *, CASE WHEN device_id IS NULL THEN 'device_id_not_null' WHEN length(device_id) > 255 THEN 'device_id_length'
  WHEN reading_ts IS NULL THEN 'time_not_null' END AS broken FROM d"""
    out["sink_idempotent"] = out["is_anomaly"]
    skew = skewed_readings_sql("duckdb")
    hot_cols = ", ".join(f"{p}_{t.metric}" for t in th.trends for p in ("cnt", "avg", "trend"))
    early = (f"SELECT * REPLACE (CASE WHEN event_id = 300 THEN TIMESTAMP '1970-01-01 00:00:00' "
             f"ELSE reading_ts END AS reading_ts) FROM ({skew}) s")
    for name, base in (("is_anomaly_hot_device", skew), ("is_anomaly_time_skew", early)):
        out[name] = (f"WITH {detected_cte(th, base)} SELECT event_id, device_id, reading_ts, "
                     f"{hot_cols}, trend_any, is_anomaly FROM detected")
    out["alert_text"] = alert_text_sql(th)
    out["alert_cooldown_hot_device"] = cooldown_sql(th.cooldown_seconds, th, skew)
    rcte = "WITH " + f"readings AS ({readings_sql('duckdb')})"
    clamps = ", ".join(f"CASE WHEN {m} IS NULL THEN NULL ELSE greatest({_num(lo)}, least({_num(hi)}, {m})) "
                       f"END AS {m}" for m, lo, hi in CLAMP_BOUNDS)
    out["clamp"] = f"{rcte} SELECT event_id, {clamps} FROM readings"
    band = " ".join(f"WHEN hour(reading_ts) >= {s_} THEN '{n}'"
                    for s_, n in sorted(HOUR_BANDS, key=lambda b: -b[0]))
    out["hour_band"] = (f"{rcte} SELECT event_id, CAST(hour(reading_ts) AS INTEGER) AS hour, "
                        f"CASE {band} END AS band FROM readings")
    out["round_half_even"] = (f"{rcte} SELECT event_id, round_even(temperature, 1) AS temperature_1, "
                              f"round_even(calories_burned, 1) AS calories_1 FROM readings")
    out["truncate"] = "SELECT event_id, CAST(trunc(value / 25.0) AS INTEGER) AS stress_int FROM events"
    return out
