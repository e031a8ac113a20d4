"""The same queries in plain SQL, step by step, for checking with DuckDB.

The SQL follows the textbook form of each rule (two sorted passes for run
removal, pair numbers and an unstack for stays, one join-free count per metric)
and shares no logic with the Spark operators.
"""

from __future__ import annotations

from turnstile import schemas as S
from turnstile.plans import queries as Q

_PERSON = 'month, "Group", eid'
_ASC = 'ts NULLS LAST, direction, index_value, "Facility"'
_DESC = 'ts DESC NULLS LAST, direction DESC, index_value DESC, "Facility" DESC'

_BADGES = """
badges AS (
  SELECT CASE WHEN event_id % 97 <> 0 THEN 'USER ' || user_id END AS eid,
         date_trunc('second', ts) AS "localtimestamp",
         CASE WHEN event_id % 101 = 0 THEN NULL WHEN event_id % 2 = 0 THEN 'In' ELSE ' OUT ' END AS direction,
         event_type AS messagetype,
         (CASE WHEN event_id % 5 = 0 THEN event_id % 12 ELSE user_id % 12 END) * 3 + event_id % 3 AS rank,
         CAST(date_trunc('month', ts) AS DATE) AS month,
         event_id // 100 + 1 AS index_value,
         user_id % 4 + 1 AS view_group
  FROM events CROSS JOIN (VALUES (1), (2)) AS c(copy)
  WHERE copy = 1 OR event_id % 50 = 0),
doors AS (
  SELECT r AS rank, 'Site ' || lpad(CAST(r // 3 AS VARCHAR), 2, '0') || ' Floor ' || (r % 3) AS door
  FROM range(36) AS t(r))"""

_VIEW_GROUPED = """
grouped AS (
  SELECT eid, "localtimestamp", direction, messagetype, month, index_value, view_group AS "Group", door
  FROM badges LEFT JOIN doors USING (rank))"""

_ORDER_GROUPED = """
grouped AS (
  SELECT 'USER ' || (o_custkey % 50) AS eid,
         CAST(o_orderdate AS TIMESTAMP) + to_seconds(o_orderkey * 7919 % 86400) AS "localtimestamp",
         CASE WHEN o_orderkey % 2 = 0 THEN 'In' ELSE ' OUT ' END AS direction,
         o_orderpriority AS messagetype,
         CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
         o_orderkey AS index_value,
         o_custkey % 50 % 4 + 1 AS "Group",
         'Site ' || lpad(CAST(CASE WHEN o_orderkey % 5 = 0 THEN o_orderkey % 12
                                   ELSE o_custkey % 50 % 12 END AS VARCHAR), 2, '0') || ' Floor' AS door
  FROM orders)"""

_FLAWED = """
flawed AS (
  SELECT eid, CASE WHEN second("localtimestamp") % 10 <> 3 THEN "localtimestamp" END AS "localtimestamp",
         CASE WHEN second("localtimestamp") % 9 = 0 THEN 'Fo o' ELSE direction END AS direction,
         month, index_value, "Group", door
  FROM grouped WHERE NOT (index_value % 17 = 0 AND second("localtimestamp") % 5 = 0))"""

_ORDER_BADGES = """
order_badges AS (
  SELECT 'USER ' || o_custkey AS eid, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
         o_orderkey AS index_value
  FROM orders),
order_counts AS (SELECT eid, month, count(*) AS "count" FROM order_badges GROUP BY eid, month),
order_max AS (SELECT month, max(index_value) AS index_value FROM order_badges GROUP BY month),
listed AS (SELECT DISTINCT month AS date FROM order_badges WHERE month >= DATE '2001-07-01')"""


def _fill(counts: str, capacity: int) -> str:
    """Greedy filling of groups, one person at a time."""
    return f"""
queue AS (
  SELECT *, row_number() OVER (PARTITION BY month ORDER BY "count", eid NULLS LAST) AS place FROM {counts}),
filled AS (
  SELECT month, place, CASE WHEN "count" > {capacity} THEN 2 ELSE 1 END AS grp, "count" AS running
  FROM queue WHERE place = 1
  UNION ALL
  SELECT q.month, q.place,
         CASE WHEN f.running + q."count" > {capacity} THEN f.grp + 1 ELSE f.grp END,
         CASE WHEN f.running + q."count" > {capacity} THEN q."count" ELSE f.running + q."count" END
  FROM filled AS f JOIN queue AS q ON q.month = f.month AND q.place = f.place + 1),
groups AS (
  SELECT eid, "count", CAST(running AS BIGINT) AS "Cumulative_Sum", CAST(grp AS BIGINT) AS "Group", month
  FROM queue JOIN filled USING (month, place))"""


_EVENT_COUNTS = 'event_counts AS (SELECT eid, month, count(*) AS "count" FROM badges GROUP BY eid, month)'

_ENRICHED = f"""
{_EVENT_COUNTS},
{_fill("event_counts", Q.EVENT_CAPACITY)},
enriched AS (
  SELECT b.eid, b."localtimestamp", b.direction, b.messagetype, b.month, b.index_value, g."Group", d.door,
         coalesce(g."count" > {Q.EVENT_CAPACITY}, false) AS oversized
  FROM badges AS b
  LEFT JOIN groups AS g ON g.eid = b.eid AND g.month = b.month
  LEFT JOIN doors AS d ON d.rank = b.rank
  WHERE b.index_value % 11 <> 0 AND b.index_value % 13 <> 0),
grouped AS (SELECT * EXCLUDE (oversized) FROM enriched)"""

# From grouped badges to stays.
_CHAIN = f"""
named AS (
  SELECT month, "Group", lower(replace(eid, ' ', '')) AS eid, "localtimestamp" AS raw_ts, index_value,
         replace(lower(direction), ' ', '') AS direction,
         upper(substr(replace(door, ' ', ''), 1, 11)) AS "Facility"
  FROM (SELECT DISTINCT * FROM grouped)
  WHERE "Group" IS NOT NULL AND eid IS NOT NULL AND door IS NOT NULL AND direction IS NOT NULL),
normal AS (
  SELECT *, CAST(raw_ts AS DATE) AS "DateOnly",
         CASE WHEN hour(raw_ts) = 0 AND minute(raw_ts) = 0 AND direction = 'in' THEN raw_ts + INTERVAL 1 MINUTE
              WHEN hour(raw_ts) = 0 AND minute(raw_ts) = 0 AND direction = 'out' THEN raw_ts - INTERVAL 1 MINUTE
              ELSE raw_ts END AS ts
  FROM named),
out_pass AS (
  SELECT * FROM (
    SELECT *, lag(direction) OVER (PARTITION BY {_PERSON} ORDER BY {_DESC}) AS later FROM normal)
  WHERE NOT (direction = 'out' AND coalesce(later, '') = 'out')),
in_pass AS (
  SELECT * FROM (
    SELECT *, lag(direction) OVER (PARTITION BY {_PERSON} ORDER BY {_ASC}) AS earlier FROM out_pass)
  WHERE NOT (direction = 'in' AND coalesce(earlier, '') = 'in')),
cleaned AS (
  SELECT *,
    CAST(row_number() OVER (PARTITION BY {_PERSON} ORDER BY {_ASC}) = 1 AS INTEGER) AS "First_Tag",
    CAST(row_number() OVER (PARTITION BY {_PERSON} ORDER BY {_ASC})
         = count(*) OVER (PARTITION BY {_PERSON}) AS INTEGER) AS "Last_Tag"
  FROM in_pass),
marked AS (
  SELECT *, (direction = 'out' AND "First_Tag" = 1) OR (direction = 'in' AND "Last_Tag" = 1) AS orphan FROM cleaned),
lone AS (SELECT * FROM marked WHERE orphan),
shifted AS (
  SELECT *, lag("Facility") OVER (PARTITION BY {_PERSON} ORDER BY {_ASC}) AS prev,
         row_number() OVER (PARTITION BY {_PERSON} ORDER BY {_ASC}) AS rn
  FROM marked WHERE NOT orphan),
imputed AS (
  SELECT month, "Group", eid, direction, ts, index_value,
         CASE WHEN direction = 'out' AND "Facility" IS DISTINCT FROM prev THEN prev ELSE "Facility" END AS "Facility",
         "Facility" AS original,
         CAST(direction = 'out' AND "Facility" IS DISTINCT FROM prev AS INTEGER) AS anomalous,
         CASE WHEN rn % 2 = 0 THEN rn - 1 ELSE rn END AS pair
  FROM shifted),
wide AS (
  SELECT month, "Group", "Facility", eid, pair,
         max(CASE WHEN direction = 'in' THEN ts END) AS time_in,
         max(CASE WHEN direction = 'out' THEN ts END) AS time_out,
         max(CASE WHEN direction = 'out' THEN anomalous END) AS "Tag_Anomalous",
         max(CASE WHEN direction = 'in' THEN index_value END) AS index_value
  FROM imputed GROUP BY month, "Group", "Facility", eid, pair),
measured AS (
  SELECT *, CAST(time_out AS DATE) - CAST(time_in AS DATE) AS day_diff,
         abs(CAST(trunc(epoch(time_out - time_in) / 60) AS BIGINT)) AS mins
  FROM wide),
flagged AS (
  SELECT *, CAST(mins >= 720 AS INTEGER) AS "Tag_OverlyLongStay",
         CAST("Tag_Anomalous" = 1 OR mins >= 720 AS INTEGER) AS "Tag_Final"
  FROM measured),
pieces AS (
  SELECT 0 AS precedence, *, time_in AS a, time_out AS b FROM flagged WHERE day_diff = 0
  UNION ALL
  SELECT 1, *, CAST(CAST(time_out AS DATE) AS TIMESTAMP) + INTERVAL 1 MINUTE, time_out FROM flagged WHERE day_diff = 1
  UNION ALL
  SELECT 2, *, time_in, CAST(CAST(time_in AS DATE) AS TIMESTAMP) + INTERVAL 1439 MINUTE FROM flagged WHERE day_diff = 1),
short_spans AS (
  SELECT * FROM (
    SELECT month, "Group", "Facility", eid, pair, "Tag_Anomalous", "Tag_OverlyLongStay", "Tag_Final", index_value,
           precedence, a AS time_in, b AS time_out,
           abs(CAST(trunc(epoch(b - a) / 60) AS BIGINT)) AS duration_mins
    FROM pieces)
  WHERE duration_mins > 0),
swipes AS (
  SELECT month, "Group", "Facility", eid, NULL AS pair, 1 AS "Tag_Anomalous", 0 AS "Tag_OverlyLongStay",
         1 AS "Tag_Final", index_value, 3 AS precedence, direction, ts
  FROM lone
  UNION ALL
  SELECT month, "Group", "Facility", eid, pair, "Tag_Anomalous", "Tag_OverlyLongStay", "Tag_Final", index_value,
         4, 'in', time_in FROM flagged WHERE day_diff > 1
  UNION ALL
  SELECT month, "Group", "Facility", eid, pair, "Tag_Anomalous", "Tag_OverlyLongStay", "Tag_Final", index_value,
         5, 'out', time_out FROM flagged WHERE day_diff > 1),
hour_spans AS (
  SELECT month, "Group", "Facility", eid, pair, "Tag_Anomalous", "Tag_OverlyLongStay", "Tag_Final", index_value,
         precedence, CASE WHEN direction = 'out' THEN ts - INTERVAL 60 MINUTE ELSE ts END AS time_in,
         CASE WHEN direction = 'in' THEN ts + INTERVAL 60 MINUTE ELSE ts END AS time_out,
         CAST(60 AS BIGINT) AS duration_mins
  FROM swipes),
spans AS (SELECT * FROM short_spans UNION ALL SELECT * FROM hour_spans),
daily AS (
  SELECT "Facility", eid, CAST(time_in AS DATE) AS "Date", CAST(sum(duration_mins) AS BIGINT) AS duration_mins,
         count(*) AS badge, round(sum(duration_mins) / 60.0, 2)::DOUBLE AS duration_hrs, month AS "Month"
  FROM spans GROUP BY month, "Group", "Facility", eid, CAST(time_in AS DATE)),
rounded AS (
  SELECT *, date_trunc('hour', time_in + INTERVAL 30 MINUTE) AS hour_in,
         date_trunc('hour', time_out + INTERVAL 30 MINUTE) AS hour_out
  FROM spans WHERE duration_mins >= 30),
stay_rows AS (
  SELECT *, row_number() OVER (ORDER BY month, "Group", precedence, "Facility", eid, pair, time_in) AS place
  FROM rounded
  QUALIFY row_number() OVER (PARTITION BY month, "Group", "Facility", eid, hour_in, hour_out
                             ORDER BY precedence, pair, time_in) = 1),
bins AS (
  SELECT month, "Group", "Facility", eid, bin, "Tag_Final"
  FROM (SELECT *, unnest(generate_series(hour_in, hour_out, INTERVAL 1 HOUR)) AS bin FROM stay_rows)
  QUALIFY row_number() OVER (PARTITION BY month, "Group", "Facility", eid, bin ORDER BY place) = 1),
hourly AS (
  SELECT "Facility", CAST(bin AS DATE) AS "Date", strftime(bin, '%H:%M:%S') AS "Bin_time", "Group",
         count(DISTINCT eid) AS eid,
         CASE WHEN hour(bin) BETWEEN 8 AND 19 THEN '8AM-7PM' ELSE '8PM-7AM' END AS "Time_group",
         nullif(count(DISTINCT CASE WHEN "Tag_Final" = 0 THEN eid END), 0) AS eid_ex, month AS "Month"
  FROM bins GROUP BY month, "Group", "Facility", bin)"""


def _metric_counts() -> dict[str, str]:
    """Condition of every duration metric over `measured`."""
    conditions = {"30minsPairsOfBadges": "mins = 30"}
    for h in range(8, 49):
        conditions[f"{h}hrTo{h + 1}hrPairsOfBadges"] = f"mins >= {60 * h} AND mins < {60 * h + 60}"
    conditions["MoreThan49HourPairsOfBadges"] = "mins >= 2940"
    return {
        f"{name}_{suffix}": f'{condition} AND "Tag_Anomalous" = {flag}'
        for name, condition in conditions.items()
        for suffix, flag in (("NotAnomalous", 0), ("Anomalous", 1))
    }


_CELL = 'month, "Group", "Facility"'
_DURATIONS = ",\n".join(
    f'    count(*) FILTER ({condition}) AS "{name}"' for name, condition in _metric_counts().items()
)
_QUALITY = f"""
anomaly AS (
  SELECT {_CELL}, CAST(sum(anomalous) AS BIGINT) AS "{S.ANOMALOUS_PAIRS}", count(*) AS "{S.TOTAL_BADGES}"
  FROM imputed GROUP BY {_CELL}),
orphaned AS (SELECT {_CELL}, count(*) AS "{S.ORPHAN_BADGES}" FROM lone GROUP BY {_CELL}),
durations AS (
  SELECT {_CELL}, count(*) AS "{S.ALL_PAIRS}",
{_DURATIONS}
  FROM measured GROUP BY {_CELL}),
profile AS (
  SELECT "Facility", "Group",
         {", ".join(f'coalesce("{m}", 0) AS "{m}"' for m in S.quality_metrics())},
         month AS "Month"
  FROM anomaly FULL JOIN orphaned USING ({_CELL}) LEFT JOIN durations USING ({_CELL}))"""


def _sql(select: str, *ctes: str) -> str:
    return "WITH RECURSIVE" + ",".join(ctes) + "\n" + select


def _view(select: str) -> str:
    return _sql(select, _BADGES, _VIEW_GROUPED, _CHAIN, _QUALITY)


def _orders(select: str) -> str:
    return _sql(select, _ORDER_BADGES, _ORDER_GROUPED, _CHAIN, _QUALITY)


def _monthly(select: str) -> str:
    return _sql(select, _BADGES, _ENRICHED, _CHAIN, _QUALITY)


_STEP = "CASE WHEN {n} % 5 = 0 OR {n} % 4 = 0 THEN {n} // 5 ELSE {n} // 4 END"


def _bounds(name: str, source: str, column: str) -> str:
    step = _STEP.format(n=column)
    parts = [f"greatest(({step}) * {k}, {k}) AS batch{k}" for k in range(1, 5)]
    return f"{name} AS (SELECT {', '.join(parts)}, greatest({column}, 5) AS batch5, month FROM {source})"


def _ranges(name: str, source: str) -> str:
    rows = [
        f'SELECT month, {k} AS batch, {f"batch{k - 1} + 1" if k > 1 else "CAST(1 AS BIGINT)"} AS "first", '
        f'batch{k} AS "last" FROM {source}'
        for k in range(1, 6)
    ]
    return f"{name} AS ({' UNION ALL '.join(rows)})"


_ORDER_RANGES = (
    'order_n AS (SELECT month, count(*) AS n FROM order_badges GROUP BY month)',
    _bounds("bounds", "order_n", "n"),
    _ranges("ranges", "bounds"),
)
_SPAN = (
    'month, "Group", eid, "Facility", "Tag_Anomalous", "Tag_OverlyLongStay", "Tag_Final", index_value, '
    "precedence, time_in, time_out, duration_mins"
)
_STAY = 'month, "Group", eid, "Facility", time_in, time_out, "Tag_Anomalous", index_value'
_SWIPE = 'month, "Group", eid, ts AS "localtimestamp", direction, "Facility", index_value'
_OLD = "\"Month\" < (SELECT max(date) FROM listed) - INTERVAL {n} MONTH"


def oracle_sql() -> dict[str, str]:
    metrics = ", ".join(f'CAST(sum("{m}") AS BIGINT) AS "{m}"' for m in S.quality_metrics())
    return {
        "badge_rows": _view("SELECT * FROM badges"),
        "month_range_scan": _view(
            "SELECT * FROM grouped WHERE month = DATE '2024-01-01' AND \"Group\" >= 2 AND \"Group\" <= 3"
        ),
        "month_range_stored": _view(
            "SELECT * EXCLUDE (month), month FROM grouped WHERE month = DATE '2024-01-01' AND \"Group\" >= 2 AND \"Group\" <= 3"
        ),
        "month_max_index": _orders("SELECT * FROM order_max"),
        "batch_bounds": _sql(
            "SELECT * FROM bounds", _ORDER_BADGES, _bounds("bounds", "order_max", "index_value")
        ),
        "batch_ranges": _sql("SELECT * FROM ranges", _ORDER_BADGES, *_ORDER_RANGES),
        "batch_members": _sql(
            'SELECT month, batch, unnest(range("first", "last" + 1)) AS number FROM ranges',
            _ORDER_BADGES,
            *_ORDER_RANGES,
        ),
        "in_batch": _sql(
            'SELECT g.* FROM grouped AS g JOIN ranges AS r ON r.month = g.month AND r.batch = 2 '
            'AND g."Group" BETWEEN r."first" AND r."last"',
            _BADGES,
            _VIEW_GROUPED,
            'top AS (SELECT month, max("Group") AS n FROM grouped GROUP BY month)',
            _bounds("bounds", "top", "n"),
            _ranges("ranges", "bounds"),
        ),
        "eid_month_counts": _orders("SELECT * FROM order_counts"),
        "balanced_groups": _sql(
            "SELECT * FROM groups", _ORDER_BADGES, _fill("order_counts", Q.ORDER_CAPACITY)
        ),
        "balanced_groups_small": _sql(
            "SELECT * FROM groups", _BADGES, _EVENT_COUNTS, _fill("event_counts", Q.BUSY)
        ),
        "enrich_badges": _sql("SELECT * FROM enriched", _BADGES, _ENRICHED),
        "normalise_badges": _view(
            'SELECT month, "Group", eid, ts AS "localtimestamp", direction, index_value, "Facility", "DateOnly" '
            "FROM normal"
        ),
        "door_names": _view("SELECT * FROM grouped"),
        "text_functions": _view(
            "SELECT index_value, lower(replace(eid, ' ', '')) AS eid, "
            "lower(replace(direction, ' ', '')) AS direction, "
            "upper(replace(door, ' ', '')[1:11]) AS \"Facility\" FROM grouped"
        ),
        "clock_functions": _orders(
            "SELECT index_value, date_trunc('minute', t) AS minute, date_trunc('hour', t) AS hour, "
            "date_trunc('hour', t) + CASE WHEN minute(t) < 30 THEN INTERVAL 0 HOUR ELSE INTERVAL 1 HOUR END "
            "AS nearest_hour, "
            "CASE WHEN hour(t) + minute(t) = 0 THEN t + INTERVAL 1 MINUTE ELSE t END AS moved_in, "
            "CASE WHEN hour(t) + minute(t) = 0 THEN t - INTERVAL 1 MINUTE ELSE t END AS moved_out, "
            "date_trunc('day', t) + INTERVAL 1439 MINUTE AS day_end, "
            "abs(datediff('second', date_trunc('day', t) + INTERVAL 1 MINUTE, t)) // 60 AS minutes, "
            "strftime(t, '%H:%M:%S') AS time, "
            "CASE WHEN hour(t) >= 8 AND hour(t) <= 19 THEN '8AM-7PM' ELSE '8PM-7AM' END AS time_group, "
            "CAST(date_trunc('month', t) AS DATE) AS month "
            'FROM (SELECT index_value, "localtimestamp" AS t FROM grouped)'
        ),
        "keep_unique": _view(
            'SELECT month, "Group", "Facility", eid, direction, "DateOnly", index_value FROM normal '
            'QUALIFY count(*) OVER (PARTITION BY month, "Group", "Facility", eid, direction, "DateOnly") = 1'
        ),
        "keep_first": _view(
            f'SELECT {_SWIPE} FROM normal QUALIFY row_number() OVER '
            '(PARTITION BY month, "Group", "Facility", eid ORDER BY ts, direction, index_value) = 1'
        ),
        "dedup_runs": _view(f"SELECT {_SWIPE} FROM in_pass"),
        "first_last_tags": _view(f'SELECT {_SWIPE}, "First_Tag", "Last_Tag" FROM cleaned'),
        "orphans": _view(f"SELECT {_SWIPE} FROM lone"),
        "orphan_split": _view(
            "SELECT CASE WHEN orphan THEN 'orphan' ELSE 'rest' END AS side, count(*) AS n FROM marked GROUP BY 1"
        ),
        "impute_facility": _view(
            f'SELECT {_SWIPE}, original AS "Original Facility", anomalous AS "Tag_Anomalous" FROM imputed'
        ),
        "pair_stays": _view(f"SELECT {_STAY} FROM wide"),
        "number_pairs": _view(f'SELECT {_STAY}, pair AS "Pair" FROM wide'),
        "flag_stays": _view(
            f"SELECT {_STAY}, CAST(day_diff AS INTEGER) AS day_diff, mins AS duration_mins_v2, "
            '"Tag_OverlyLongStay", "Tag_Final" FROM flagged'
        ),
        "split_stays": _view(f"SELECT {_SPAN} FROM short_spans"),
        "impute_orphans": _view(f"SELECT {_SPAN} FROM hour_spans"),
        "eid_daily": _view("SELECT * FROM daily"),
        "round_hours": _view(f"SELECT {_SPAN}, hour_in, hour_out FROM rounded"),
        "expand_hours": _view("SELECT * FROM bins"),
        "hourly_occupancy": _view("SELECT * FROM hourly"),
        "anomaly_stats": _view("SELECT * FROM anomaly"),
        "orphan_counts": _view("SELECT * FROM orphaned"),
        "duration_profile": _view("SELECT * FROM durations"),
        "quality_profile": _view("SELECT * FROM profile"),
        "quality_rollup": _orders(
            f'SELECT "Facility", "Month", {metrics} FROM profile '
            'WHERE "Month" IN (SELECT date FROM listed) GROUP BY "Facility", "Month"'
        ),
        "peak_rollup": _orders(
            'SELECT "Facility", "Month", "Bin_time", "Time_group", "Date", '
            "CAST(sum(eid_ex) AS BIGINT) AS eid_ex, CAST(sum(eid) AS BIGINT) AS eid FROM hourly "
            'WHERE "Month" IN (SELECT date FROM listed) '
            'GROUP BY "Facility", "Month", "Bin_time", "Time_group", "Date"'
        ),
        "peak_totals": _orders(
            'SELECT "Facility", "Date", "Bin_time", CAST(sum(eid) AS BIGINT) AS eid, '
            'CAST(sum(eid_ex) AS BIGINT) AS eid_ex FROM hourly GROUP BY "Facility", "Date", "Bin_time"'
        ),
        "in_months": _orders("SELECT * FROM order_counts WHERE month IN (SELECT date FROM listed)"),
        "retain_weekly": _orders(
            f'SELECT * FROM hourly WHERE NOT ("Month" IN (SELECT date FROM listed) OR {_OLD.format(n=13)})'
        ),
        "retain_monthly": _orders(f"SELECT * FROM hourly WHERE NOT ({_OLD.format(n=12)})"),
        "weekly_refresh": _orders(f"SELECT * FROM hourly WHERE NOT ({_OLD.format(n=13)})"),
        "processing_months_weekly": _orders(
            "SELECT DISTINCT CAST(date_trunc('month', d) AS DATE) AS date FROM (SELECT unnest([max(month) + 3, "
            "max(month) - 7]) AS d FROM order_badges)"
        ),
        "processing_months_empty": _orders("SELECT max(month) AS date FROM order_badges"),
        "processing_months_monthly": _orders(
            "SELECT CAST(max(month) - INTERVAL 1 MONTH AS DATE) AS date FROM order_badges"
        ),
        "distinct_values": _view("SELECT count(*) AS n FROM (SELECT DISTINCT eid FROM badges)"),
        "processing_months_listed": _orders(
            "SELECT max(month) AS date FROM order_badges UNION ALL SELECT DATE '1999-02-01'"
        ),
        "text_timestamps": (
            "SELECT event_id, CASE WHEN event_id % 7 = 0 OR event_id % 11 = 0 OR event_id % 13 = 0 "
            "OR event_id % 17 = 0 OR event_id % 19 = 0 THEN NULL ELSE date_trunc('second', ts) END AS ts FROM events"
        ),
        "complement_split": _view(
            "SELECT month, coalesce(direction = 'In', false) AS met, count(*) AS n FROM badges GROUP BY ALL"
        ),
        "unknown_directions": _sql(
            'SELECT month, "Group", lower(replace(eid, \' \', \'\')) AS eid, \'foo\' AS direction, '
            'upper(substr(replace(door, \' \', \'\'), 1, 11)) AS "Facility", index_value FROM flawed '
            "WHERE direction = 'Fo o' AND eid IS NOT NULL AND door IS NOT NULL",
            _BADGES, _VIEW_GROUPED, _FLAWED,
        ),
        "quarantine_counts": """
WITH texts AS (
  SELECT CASE WHEN event_id % 97 <> 0 THEN 'USER ' || CAST(user_id AS VARCHAR) END AS eid,
         CASE WHEN event_id % 7 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
              WHEN event_id % 13 = 0 THEN '2024-13-01 10:00:00'
              WHEN event_id % 17 = 0 THEN ' '
              WHEN event_id % 19 <> 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS "localtimestamp",
         CASE WHEN event_id % 101 <> 0 THEN CASE WHEN event_id % 2 = 0 THEN 'In' ELSE ' OUT ' END END AS direction,
         CASE WHEN event_id % 23 = 0 THEN 'n/a' ELSE CAST(event_id % 36 AS VARCHAR) END AS rank
  FROM events
), checked AS (
  SELECT nullif(concat_ws(',',
    CASE WHEN eid IS NULL OR trim(eid) = '' THEN 'missing eid' END,
    CASE WHEN "localtimestamp" IS NULL OR trim("localtimestamp") = '' THEN 'missing localtimestamp' END,
    CASE WHEN NOT ("localtimestamp" IS NULL OR trim("localtimestamp") = '')
          AND TRY_CAST("localtimestamp" AS TIMESTAMP) IS NULL THEN 'type localtimestamp' END,
    CASE WHEN direction IS NULL OR trim(direction) = '' THEN 'missing direction' END,
    CASE WHEN TRY_CAST(rank AS BIGINT) IS NULL THEN 'type rank' END), '') AS reason
  FROM texts
)
SELECT coalesce(reason, 'ok') AS reason, count(*) AS n FROM checked GROUP BY 1""",
        "overwritten": _orders("SELECT * FROM order_counts"),
        "appended": _orders("SELECT * FROM order_counts UNION ALL SELECT * FROM order_counts"),
        "appended_query": _orders(
            'SELECT * FROM order_counts UNION ALL SELECT eid, month, "count" + 1 FROM order_counts WHERE "count" > 1'
        ),
        "appended_batches": _orders(
            "SELECT *, 'b1' AS batch_id FROM order_counts UNION ALL "
            """SELECT *, 'b2' AS batch_id FROM order_counts WHERE "count" > 1"""
        ),
        "months_replaced": _orders(
            'SELECT eid, month, CASE WHEN month IN (SELECT date FROM listed) THEN "count" * 10 ELSE "count" END AS "count" '
            "FROM order_counts WHERE month NOT IN (SELECT max(date) FROM listed)"
        ),
        "dropped": _orders('SELECT * FROM order_counts WHERE "count" > 1'),
        "queried": _orders('SELECT month, CAST(sum("count") AS BIGINT) AS n FROM order_counts GROUP BY month'),
        "monthly_eid_daily": _monthly("SELECT * FROM daily"),
        "monthly_peak_util": _monthly("SELECT * FROM hourly"),
        "monthly_data_quality": _monthly("SELECT * FROM profile"),
    }
