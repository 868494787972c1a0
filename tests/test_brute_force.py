"""Operators against slow, direct computations on random input."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from care_episodes.functions.special import chi_square_tail, gamma_p
from care_episodes.operators import dating, merge, outcomes, progression, regression, stats
from tests.helpers import EPISODE_SCHEMA, day, events, rules, timing

MONTHS = [(1, 4), (1, 3), (2, 2), (3, 5), (4, 7), (5, 5), (6, 8), (9, 9), (8, 11)]


def compatible(early, late):
    apart = (late[0] - early[0]) / 30
    return late[1] - early[2] - 2 <= apart <= late[2] - early[1] + 2


def episodes_of(records):
    """Episode number of each record, comparing all pairs around each record."""
    number, out = 1, [1]
    for i in range(1, len(records)):
        gap = records[i][0] - records[i - 1][0]
        straddles = any(compatible(records[s], records[e]) for s in range(i) for e in range(i, len(records)))
        if gap > 300 or (gap > 30 and not straddles):
            number += 1
        out.append(number)
    return out


def test_progression_boundaries_match_all_pairs(spark):
    random.seed(1)
    people, rows = {}, []
    for person in range(300):
        base = sorted(random.randint(0, 900) for _ in range(random.randint(1, 14)))
        records = sorted((t, *random.choice(MONTHS)) for t in base)
        people[person] = records
        rows += [(person, day(t), lo, hi) for t, lo, hi in records]
    runs = progression.assign_progression_episodes(progression.runs_with_agreement(timing(spark, rows), 360))
    got = {}
    for r in runs.collect():
        got.setdefault(r.person_id, []).append((r.first_day, r.last_day, r.person_episode_number))
    origin = (day(0) - dt.date(1970, 1, 1)).days
    for person, records in people.items():
        for (t, _, _), number in zip(records, episodes_of(records), strict=True):
            mine = [n for a, b, n in got[person] if a <= t + origin <= b]
            assert mine == [number], (person, records)


def test_agreement_of_each_record_matches_all_pairs(spark):
    random.seed(11)
    rows, want = [], []
    for person in range(200):
        base = [random.randint(0, 700) for _ in range(random.randint(1, 10))]
        records = sorted((t, *random.choice(MONTHS)) for t in [*base, *base[:2]])
        rows += [(person, day(t), lo, hi) for t, lo, hi in records]
        for i, (t, lo, hi) in enumerate(records):
            agrees = any(compatible(records[s], records[e]) for s in range(i) for e in range(i, len(records)))
            want.append((person, day(t), lo, hi, agrees))
    got = []
    for r in progression.agreement_of_records(timing(spark, rows)).collect():
        got += [(r.person_id, r.event_date, r.min_month, r.max_month, r.agrees)] * r.n
    assert sorted(got) == sorted(want)


SPACING_BEFORE = {
    "SB": {"LB": 168}, "AB": {"LB": 70, "SB": 70, "ECT": 56}, "SA": {"LB": 70, "SB": 70, "ECT": 56},
    "DELIV": {"LB": 168, "SB": 168, "ECT": 154, "AB": 154, "SA": 154},
}
SPACING_AFTER = {
    "SB": {"LB": 182}, "AB": {"LB": 168, "SB": 154, "ECT": 56}, "SA": {"LB": 168, "SB": 154, "ECT": 56},
    "DELIV": {"LB": 182, "SB": 168, "ECT": 70, "AB": 70, "SA": 70},
}
SAME = {"LB": 182, "SB": 168, "ECT": 56, "AB": 56, "DELIV": 168}
GROUPS = [("LB",), ("SB",), ("ECT",), ("AB", "SA"), ("DELIV",)]


def keep(category, before, after):
    """before, after: (category, gap) or None"""
    if category == "ECT":
        births = ("LB", "SB")
        if before is None or after is None or before[1] >= 70 or after[1] >= 154:
            return True
        return before[0] not in births and after[0] not in births
    need_before = SPACING_BEFORE[category].get(before[0]) if before else None
    need_after = SPACING_AFTER[category].get(after[0]) if after else None
    if need_before is None and need_after is None:
        return True
    if need_after is None:
        return after is None and before[1] >= need_before
    if need_before is None:
        return before is None and after[1] >= need_after
    return before[1] >= need_before and after[1] >= need_after


def outcomes_of(records):
    kept = []
    for order, group in enumerate(GROUPS):
        mine = sorted((t, c) for t, c in records if c in group)
        sessions = []
        for t, c in mine:
            if sessions and t - sessions[-1][0] < SAME[group[0]]:
                sessions[-1] = (t, sessions[-1][1])
            else:
                sessions.append((t, c))
        mixed = sorted([*kept, *((t, order, c) for t, c in sessions)])
        kept = [
            x for i, x in enumerate(mixed)
            if x[1] != order or order == 0 or keep(
                x[2],
                (mixed[i - 1][2], x[0] - mixed[i - 1][0]) if i else None,
                (mixed[i + 1][2], mixed[i + 1][0] - x[0]) if i + 1 < len(mixed) else None,
            )
        ]
    return sorted((t, c) for t, _, c in kept)


def test_outcome_hierarchy_matches_step_by_step(spark):
    random.seed(2)
    people, rows = {}, []
    concept = {"LB": 1, "SB": 2, "ECT": 3, "AB": 4, "SA": 5, "DELIV": 6}
    for person in range(400):
        records = [(random.randint(0, 1200), random.choice(list(concept))) for _ in range(random.randint(1, 12))]
        people[person] = sorted(records, key=lambda r: (r[0], concept[r[1]]))
        rows += [(person, c, day(t), None, None, concept[c]) for t, c in records]
    got = {}
    for r in outcomes.outcome_hierarchy(events(spark, rows), rules(spark)).collect():
        origin = (day(0) - dt.date(1970, 1, 1)).days
        got.setdefault(r.person_id, []).append((r.outcome_day - origin, r.outcome_category))
    for person, records in people.items():
        assert sorted(got[person]) == outcomes_of(records), (person, records)


def match_rounds(pairs):
    """pairs: (hip, pps, hip_end, pps_start, pps_end); rounds on plain lists."""
    def doubled(rows, i):
        seen = {}
        for r in rows:
            seen[r[i]] = seen.get(r[i], 0) + 1
        return {k for k, n in seen.items() if n > 1}

    def quality(r, other):
        length = r[4] - r[3]
        return (abs(r[2] - r[4]), -(length if length <= 310 else -1), r[other])

    done, rows = [], list(pairs)
    h, p = doubled(rows, 0), doubled(rows, 1)
    done += [r for r in rows if r[0] not in h and r[1] not in p]
    rows = [r for r in rows if r[0] in h or r[1] in p]
    for _ in range(5):
        h, p = doubled(rows, 0), doubled(rows, 1)
        best = set()
        for x in h:
            best.add(min((r for r in rows if r[0] == x), key=lambda r: quality(r, 1)))
        for x in p:
            best.add(min((r for r in rows if r[1] == x), key=lambda r: quality(r, 0)))
        h, p = doubled(best, 0), doubled(best, 1)
        done += [r for r in best if r[0] not in h and r[1] not in p]
        rows = [r for r in best if r[0] in h or r[1] in p]
    return sorted((r[0], r[1]) for r in done + rows)


def test_match_rounds(spark):
    random.seed(3)
    hip, pps, expected = [], [], {}
    for person in range(150):
        sides = []
        for _ in range(2):
            side = []
            for n in range(1, random.randint(2, 7)):
                start = random.randint(0, 700)
                side.append((n, start, start + random.randint(5, 320)))
            sides.append(side)
        hs, ps = sides
        for n, a, b in hs:
            hip.append((person, n, day(a), day(b), "LB", float(b - a), "HIP"))
        for n, a, b in ps:
            pps.append((person, n, day(a), day(b), "LB", float(b - a), "PPS"))
        pairs = [(h[0], p[0], h[2], p[1], p[2]) for h in hs for p in ps if h[1] <= p[2] + 60 and h[2] >= p[1]]
        alone = [(h[0], None) for h in hs if h[0] not in {x[0] for x in pairs}]
        alone += [(None, p[0]) for p in ps if p[0] not in {x[1] for x in pairs}]
        expected[person] = sorted(match_rounds(pairs) + alone, key=str)
    h, p = spark.createDataFrame(hip, EPISODE_SCHEMA), spark.createDataFrame(pps, EPISODE_SCHEMA)
    got = {}
    for r in merge.one_to_one_match(merge.interval_full_join(h, p)).collect():
        got.setdefault(r.person_id, []).append((r.hip_id, r.pps_id))
    for person, want in expected.items():
        assert sorted(got[person], key=str) == want, person


def quantile(values, q):
    return float(np.quantile(np.array(values, dtype=float), q))


def refined(weeks, ranges):
    """(start, precision) of one episode from plain lists, or None."""
    common = None
    if ranges:
        ranges = sorted(ranges)
        overlaps = [
            sum(1 for j, b in enumerate(ranges) if j != i and b[0] <= a[1] and b[1] >= a[0])
            for i, a in enumerate(ranges)
        ]
        q1, q3 = quantile(overlaps, 0.25), quantile(overlaps, 0.75)
        limit = max(0, q1 - 1.5 * (q3 - q1)) if len(ranges) > 1 else 0
        kept = [r for r, n in zip(ranges, overlaps, strict=True) if n >= limit] or ranges[:1]
        low, high = max(r[0] for r in kept), min(r[1] for r in kept)
        common = (low, high) if low <= high else kept[0]
    if not weeks:
        return None
    clean = weeks
    if len(weeks) > 1:
        far = [abs(w - float(np.median(weeks))) for w in weeks]
        q1, q3 = quantile(far, 0.25), quantile(far, 0.75)
        spread = 1.5 * (q3 - q1)
        clean = [w for w, x in zip(weeks, far, strict=True) if q1 - spread <= x <= q3 + spread] or [min(weeks)]
    if common:
        inside = [w for w in clean if common[0] <= w <= common[1]]
        used = inside if len(inside) / len(clean) > 0.5 else clean
        return float(np.median(used)), max(used) - min(used)
    return float(np.median(clean)), (max(clean) - min(clean) if len(clean) > 1 else -1)


def test_refined_starts(spark):
    random.seed(4)
    rows, expected = [], {}
    for person in range(400):
        weeks = [float(random.choice((0, 3, 7, 7, 9, 14, 40, 90))) for _ in range(random.randint(0, 7))]
        ranges = [(a, a + random.choice((0, 30, 60, 90))) for a in (float(random.randint(-60, 60)) for _ in range(random.randint(0, 6)))]
        expected[person] = refined(weeks, ranges)
        rows += [(person, 1, "GW", w, None, None, 1) for w in weeks]
        rows += [(person, 1, "GR3m", None, a, b, 1) for a, b in ranges]
    schema = "person_id long, episode_number int, GT_type string, implied_start double, range_start double, range_end double, n long"
    df = spark.createDataFrame(rows, schema)
    out = dating.refine_start(dating.gw_outlier_filter(df), dating.interval_consensus(df))
    got = {r.person_id: (r.inferred_start, r.precision_days) for r in out.collect()}
    for person, want in expected.items():
        assert got.get(person) == (pytest.approx(want) if want else None), person


def survival_data(n=400):
    rng = np.random.default_rng(5)
    x = rng.integers(0, 2, n)
    age = rng.integers(20, 45, n)
    t = np.ceil(rng.exponential(60 / (1 + 0.8 * x + 0.02 * (age - 30)), n)).astype(int)
    cut = rng.integers(10, 90, n)
    return x, age, np.minimum(t, cut), (t <= cut).astype(int)


def cox_direct(x, t, e, steps=30):
    """Newton steps over the risk sets, tied events thinned step by step."""
    beta = np.zeros(x.shape[1])
    for _ in range(steps):
        g, h = np.zeros_like(beta), np.zeros((len(beta), len(beta)))
        r = np.exp(x @ beta)
        for u in np.unique(t[e == 1]):
            risk, tied = t >= u, (t == u) & (e == 1)
            m = tied.sum()
            g += x[tied].sum(axis=0)
            for k in range(m):
                w = r * risk - (k / m) * r * tied
                s0, s1 = w.sum(), w @ x
                g -= s1 / s0
                h += (x.T * w) @ x / s0 - np.outer(s1, s1) / s0**2
        beta = beta + np.linalg.solve(h, g)
    return beta, np.sqrt(np.diag(np.linalg.inv(h)))


def test_cox_and_log_rank(spark):
    x, age, t, e = survival_data()
    rows = [(int(a), int(b), int(c), int(d)) for a, b, c, d in zip(x, age, t, e, strict=True)]
    df = spark.createDataFrame(rows, "x int, age int, t int, e int")
    beta, se = cox_direct(np.column_stack([x, age]).astype(float), t, e)
    got = {r.term: r for r in regression.cox_ph(df, "t", "e", ["x", "age"]).collect()}
    for i, name in enumerate(("x", "age")):
        assert got[name].coefficient == pytest.approx(beta[i], abs=1e-5)
        assert got[name].std_error == pytest.approx(se[i], rel=1e-4)
        assert got[name].ratio == pytest.approx(math.exp(beta[i]), rel=1e-4)
    o = ex = v = 0.0
    for u in np.unique(t[e == 1]):
        n, n1 = (t >= u).sum(), ((t >= u) & (x == 1)).sum()
        d, d1 = ((t == u) & (e == 1)).sum(), ((t == u) & (e == 1) & (x == 1)).sum()
        o, ex = o + d1, ex + d * n1 / n
        if n > 1:
            v += d * (n - d) / (n - 1) * n1 / n * (1 - n1 / n)
    rank = stats.log_rank(df, "t", "e", "x").first()
    assert rank.chisq == pytest.approx((o - ex) ** 2 / v)
    assert rank.p_value == pytest.approx(math.erfc(math.sqrt(rank.chisq / 2)), rel=1e-6)


def test_logistic(spark):
    rng = np.random.default_rng(6)
    x, age = rng.integers(0, 2, 500), rng.integers(20, 45, 500)
    y = (rng.random(500) < 1 / (1 + np.exp(1.5 - x - 0.02 * age))).astype(int)
    design = np.column_stack([np.ones(500), x, age]).astype(float)
    beta = np.zeros(3)
    for _ in range(30):
        m = 1 / (1 + np.exp(-design @ beta))
        h = (design.T * (m * (1 - m))) @ design
        beta = beta + np.linalg.solve(h, design.T @ (y - m))
    df = spark.createDataFrame([tuple(map(int, r)) for r in zip(x, age, y, strict=True)], "x int, age int, y int")
    got = {r.term: r for r in regression.logistic_or(df, "y", ["x", "age"]).collect()}
    errors = np.sqrt(np.diag(np.linalg.inv(h)))
    for i, name in enumerate(("(Intercept)", "x", "age")):
        assert got[name].coefficient == pytest.approx(beta[i], abs=1e-6)
        assert got[name].std_error == pytest.approx(errors[i], rel=1e-5)


def test_tail_probabilities():
    assert chi_square_tail(3.841458820694124, 1) == pytest.approx(0.05)
    assert chi_square_tail(5.991464547107979, 2) == pytest.approx(0.05)
    assert gamma_p(3, 2.0) == pytest.approx(1 - math.exp(-2) * (1 + 2 + 2))


def test_large_counts_do_not_need_rows(spark):
    """A person with very many equal records: the same episodes as with one of each."""
    one = events(spark, [(1, "LB", day(0)), (1, "LB", day(400)), (1, "AB", day(800)), (1, "GEST", day(-20), 30.0)])
    many = one.withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(20000)))).drop("k")
    key = ["episode_number", "outcome_day", "outcome_category"]
    a = outcomes.outcome_hierarchy(one, rules(spark)).select(*key).collect()
    b = outcomes.outcome_hierarchy(many, rules(spark)).select(*key).collect()
    assert sorted(a) == sorted(b)
    copies = outcomes.gestation_only_episodes(outcomes.gestation_records(many))
    assert copies.count() == 3 and copies.agg(F.sum("n_copies")).first()[0] == 20000
