"""Plain per-person loops for the sequence and stay rules, and random badge frames."""

from __future__ import annotations

import datetime as dt
import random
from collections import defaultdict

MONTH = dt.date(2024, 1, 1)
HOUR = dt.timedelta(hours=1)
MINUTE = dt.timedelta(minutes=1)


def random_swipes(seed: int, people: int = 60, spacing: int = 1_500, null_share: float = 0.0):
    """(eid, ts, direction, Facility, index_value) with ties, copies and missing times."""
    rng = random.Random(seed)
    rows = []
    for p in range(people):
        ts = dt.datetime(2024, 1, 1, 7) + dt.timedelta(minutes=rng.randrange(2_000))
        for i in range(rng.randrange(1, 40)):
            if rng.random() > 0.15:
                ts += dt.timedelta(seconds=rng.randrange(1, spacing))
            stamp = None if rng.random() < null_share else ts
            row = (f"p{p}", stamp, rng.choice(["in", "out"]), f"F{rng.randrange(3)}", i // 3)
            rows += [row] * (2 if rng.random() < 0.1 else 1)
    rng.shuffle(rows)
    return rows


def _key(row):
    eid, ts, way, site, index = row
    return (ts is None, ts or dt.datetime.max, way, index, site)


def _descending(rows):
    """Latest first, rows without a time at the end."""
    timed = sorted((r for r in rows if r[1]), key=_key, reverse=True)
    return timed + sorted((r for r in rows if not r[1]), key=_key, reverse=True)


def clean(rows):
    """eid -> [(row, first, last)] after the three run removals."""
    people = defaultdict(set)
    for row in rows:
        people[row[0]].add(row)
    result = {}
    for eid, swipes in people.items():
        kept, before = [], None
        for row in _descending(swipes):
            if not (row[2] == "out" and before == "out"):
                kept.append(row)
            before = row[2]
        ordered, before = [], None
        for row in sorted(kept, key=_key):
            if not (row[2] == "in" and before == "in"):
                ordered.append(row)
            before = row[2]
        flagged = [(r, i == 0, i == len(ordered) - 1) for i, r in enumerate(ordered)]
        final, before = [], None
        for item in flagged:
            if not (item[0][2] == "out" and before == "out"):
                final.append(item)
            before = item[0][2]
        result[eid] = final
    return result


def stays(rows):
    """(stays, orphans) as lists of tuples."""
    pairs, lone = [], []
    for eid, flagged in clean(rows).items():
        rest = []
        for row, first, last in flagged:
            if (row[2] == "out" and first) or (row[2] == "in" and last):
                lone.append(row)
            else:
                rest.append(row)
        for a, b in zip(rest[::2], rest[1::2]):
            if a[1] is not None and b[1] is not None:
                pairs.append((eid, a[3], a[1], b[1], int(a[3] != b[3])))
    return pairs, lone


def whole_minutes(a, b):
    return int(abs((b - a).total_seconds()) / 60)


def spans(rows):
    """(precedence, start of visit, eid, Facility, in, out, minutes, Tag_Final)."""
    pairs, lone = stays(rows)
    result = []
    for eid, site, a, b, odd in pairs:
        final = int(odd or whole_minutes(a, b) >= 720)
        days = (b.date() - a.date()).days
        if days == 0:
            cut = [(0, a, b)]
        elif days == 1:
            day = dt.datetime.combine(b.date(), dt.time())
            cut = [(1, day + MINUTE, b), (2, a, day - MINUTE)]
        else:
            cut = [(4, a, a + HOUR), (5, b - HOUR, b)]
        result += [(p, a, eid, site, x, y, whole_minutes(x, y), final) for p, x, y in cut]
    for eid, ts, way, site, _ in lone:
        if ts is not None:
            x, y = (ts - HOUR, ts) if way == "out" else (ts, ts + HOUR)
            result.append((3, ts, eid, site, x, y, 60, 1))
    return [r for r in result if r[6] > 0]


def _round(ts):
    floor = ts.replace(minute=0, second=0, microsecond=0)
    return floor + HOUR if ts.minute >= 30 else floor


def hourly(rows):
    """(Facility, hour) -> (people, people without a doubtful stay)."""
    first = {}
    for p, start, eid, site, a, b, minutes, final in sorted(spans(rows)):
        if minutes < 30:
            continue
        hour = _round(a)
        while hour <= _round(b):
            first.setdefault((site, hour, eid), final)
            hour += HOUR
    counts = defaultdict(lambda: [0, 0])
    for (site, hour, _), final in first.items():
        counts[site, hour][0] += 1
        counts[site, hour][1] += not final
    return {k: tuple(v) for k, v in counts.items()}


def groups(counts, capacity):
    """eid -> (group, running sum), filling in order of (count, eid), missing ids last."""
    group, used, result = 1, 0, {}
    for eid, count in sorted(counts, key=lambda x: (x[1], x[0] is None, x[0] or "")):
        if used + count > capacity:
            group, used = group + 1, count
        else:
            used += count
        result[eid] = (group, used)
    return result
