"""Models against direct computations on small arrays: many at a time, tests of proportional hazards, profile limits."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from care_episodes.functions.special import chi_square_tail
from care_episodes.operators import regression, stats
from tests.test_brute_force import cox_direct, survival_data


def frame(spark):
    x, age, t, e = survival_data()
    rows = [(i, int(a), int(b), int(c), int(d)) for i, (a, b, c, d) in enumerate(zip(x, age, t, e, strict=True))]
    return x, age, t, e, spark.createDataFrame(rows, "id int, x int, age int, t int, e int")


def zph_direct(x, t, e, g, groups):
    """Score test of x * g(t), one risk set after the other."""
    beta, _ = cox_direct(x, t, e)
    p = x.shape[1]
    r = np.exp(x @ beta)
    u, i11, i12, i22 = np.zeros(p), np.zeros((p, p)), np.zeros((p, p)), np.zeros((p, p))
    for v in np.unique(t[e == 1]):
        risk, tied = t >= v, (t == v) & (e == 1)
        m = tied.sum()
        resid, var = x[tied].sum(axis=0), np.zeros((p, p))
        for k in range(m):
            w = r * risk - (k / m) * r * tied
            mean = w @ x / w.sum()
            resid = resid - mean
            var += (x.T * w) @ x / w.sum() - np.outer(mean, mean)
        u, i11, i12, i22 = u + g[v] * resid, i11 + var, i12 + g[v] * var, i22 + g[v] ** 2 * var
    left = i22 - i12 @ np.linalg.solve(i11, i12)
    return [float(u[j] @ np.linalg.solve(left[np.ix_(j, j)], u[j])) for j in groups]


@pytest.mark.parametrize("transform", ["km", "identity", "log"])
def test_proportional_hazards(spark, transform):
    x, age, t, e, df = frame(spark)
    times, g, s = np.unique(t[e == 1]), {}, 1.0
    for v in times:
        g[v] = {"km": 1 - s, "identity": float(v), "log": math.log(v)}[transform]
        s *= 1 - ((t == v) & (e == 1)).sum() / (t >= v).sum()
    band = age // 8
    levels = sorted(set(band.tolist()))
    design = np.column_stack([x, *[(band == v) for v in levels[1:]]]).astype(float)
    want = zph_direct(design, t, e, g, [[0], list(range(1, len(levels))), list(range(len(levels)))])
    banded = df.withColumn("band", F.expr("age div 8"))
    got = {r.term: r for r in regression.cox_ph_test(banded, "t", "e", ["x", regression.Levels("band", tuple(levels))], transform).collect()}
    assert list(got) == ["x", "band", "GLOBAL"]
    for row, chisq in zip(got.values(), want, strict=True):
        assert row.chisq == pytest.approx(chisq, rel=1e-6)
        assert row.p_value == pytest.approx(chi_square_tail(chisq, row.df))


def test_log_time_matches_split_rows(spark):
    """The same model on (start, stop] rows: one row per person and event time at risk."""
    x, age, t, e, df = frame(spark)
    beta = np.zeros(3)
    for _ in range(30):
        g, h = np.zeros(3), np.zeros((3, 3))
        for v in np.unique(t[e == 1]):
            design = np.column_stack([x, age - age.mean(), x * math.log(v)]).astype(float)
            risk, tied = t >= v, (t == v) & (e == 1)
            r, m = np.exp(design @ beta), tied.sum()
            g += design[tied].sum(axis=0)
            for k in range(m):
                w = r * risk - (k / m) * r * tied
                mean = w @ design / w.sum()
                g, h = g - mean, h + (design.T * w) @ design / w.sum() - np.outer(mean, mean)
        beta = beta + np.linalg.solve(h, g)
    got = {r.term: r for r in regression.cox_log_time(df, "t", "e", "x", ["age"]).collect()}
    errors = np.sqrt(np.diag(np.linalg.inv(h)))
    for k, name in enumerate(("x", "age", "x:log(t)")):
        assert got[name].coefficient == pytest.approx(beta[k], abs=1e-6)
        assert got[name].std_error == pytest.approx(errors[k], rel=1e-6)


def jobs_of(spark, run) -> int:
    tracker, group = spark.sparkContext.statusTracker(), f"jobs-{run.__name__}-{id(run)}"
    spark.sparkContext.setJobGroup(group, group)
    run()
    spark.sparkContext.setJobGroup("tests", "tests")
    return len(tracker.getJobIdsForGroup(group))


def test_models_are_fitted_together(spark):
    x, age, t, e, df = frame(spark)
    more = df.withColumns({"e2": F.expr("int(e = 1 AND id % 3 > 0)"), "t2": F.expr("t + id % 5"), "z": F.expr("id % 2")})
    outcomes = {"a": ("t", "e"), "b": ("t2", "e2")}
    subsets = {"all": F.lit(True), "odd": F.col("id") % 2 == 1}
    got = {(r.subset, r.outcome, r.model): r for r in regression.cox_table(more, outcomes, ["x"], ["age"], subsets).collect()}
    assert len(got) == 8
    for (subset, outcome, model), row in got.items():
        part = more.where(subsets[subset])
        own = regression.cox_ph(part, *outcomes[outcome], ["x", "age"] if model == "adjusted" else ["x"]).where("term = 'x'").first()
        assert row.coefficient == pytest.approx(own.coefficient, abs=1e-8) and row.std_error == pytest.approx(own.std_error, rel=1e-8)

    def one():
        regression.cox_fits(more, [regression.Model(("x", "age"), "e", "t")])

    def many():
        regression.cox_fits(more, [regression.Model(("x", "age"), ev, ti) for ti, ev in outcomes.values()] * 4)

    # The slowest of eight may need a step more; each step is a fixed number of jobs.
    assert jobs_of(spark, many) <= 1.5 * jobs_of(spark, one)
    each = {(r.variable, r.term): r for r in regression.logistic_each(more, "e", ["x", "age", "z"]).collect()}
    for c in ("x", "age", "z"):
        own = {r.term: r for r in regression.logistic_or(more, "e", [c]).collect()}
        assert each[c, c].coefficient == pytest.approx(own[c].coefficient, abs=1e-9)


def test_many_ties_are_summed_in_pieces(spark, monkeypatch):
    x, age, t, e, df = frame(spark)
    few = df.withColumn("t", F.expr("t div 60 + 1"))
    whole = regression.cox_ph(few, "t", "e", ["x", "age"]).collect()
    monkeypatch.setattr(regression, "TIES", 3)
    for a, b in zip(whole, regression.cox_ph(few, "t", "e", ["x", "age"]).collect(), strict=True):
        assert a.coefficient == pytest.approx(b.coefficient, abs=1e-9)
    beta, _ = cox_direct(np.column_stack([x, age]).astype(float), t // 60 + 1, e)
    assert whole[0].coefficient == pytest.approx(beta[0], abs=1e-6)


def test_profile_limits_match_a_direct_search(spark):
    rng = np.random.default_rng(9)
    n = 250
    x, age = rng.integers(0, 2, n), rng.integers(20, 45, n)
    y = (rng.random(n) < 1 / (1 + np.exp(2.5 - 1.2 * x - 0.02 * age))).astype(int)
    design = np.column_stack([np.ones(n), x, age]).astype(float)

    def fitted(fixed=None, value=0.0, start=(0, 0, 0)):
        """Log likelihood, with one coefficient held or none."""
        free = [k for k in range(3) if k != fixed]
        beta = np.array(start, float)
        if fixed is not None:
            beta[fixed] = value
        for _ in range(40):
            m = 1 / (1 + np.exp(-design @ beta))
            h = (design[:, free].T * (m * (1 - m))) @ design[:, free]
            step = np.linalg.solve(h, design[:, free].T @ (y - m))
            beta[free] += step * min(1, 1 / max(1e-300, np.abs(design[:, free] @ step).max()))
        eta = design @ beta
        return float((y * eta - np.logaddexp(0, eta)).sum()), beta

    top, best = fitted()
    m = 1 / (1 + np.exp(-design @ best))
    errors = np.sqrt(np.diag(np.linalg.inv((design.T * (m * (1 - m))) @ design)))
    df = spark.createDataFrame([tuple(map(int, r)) for r in zip(x, age, y, strict=True)], "x int, age int, y int")
    got = regression.logistic_profile(df, "y", ["x", "age"]).collect()
    for k, row in enumerate(got):
        assert row.coefficient == pytest.approx(best[k], abs=1e-7)
        for side, limit in ((-1, row.low), (1, row.high)):
            near, far = best[k], best[k] + side * 4 * errors[k]
            for _ in range(60):
                mid = (near + far) / 2
                near, far = (mid, far) if 2 * (top - fitted(k, mid, best)[0]) < 3.841458820694124 else (near, mid)
            assert math.log(limit) == pytest.approx(near, abs=1e-4)


def test_profile_limit_of_separated_data_is_null(spark):
    df = spark.createDataFrame([(int(k % 4 == 0), int(k % 4 == 0 or k % 3 == 0)) for k in range(60)], "x int, y int")
    try:
        row = next(r for r in regression.logistic_profile(df, "y", ["x"]).collect() if r.term == "x")
    except (RuntimeError, ValueError):
        return  # no finite estimate at all
    assert row.high is None or row.high > 1e3


def no_single_partition(df) -> bool:
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return "windowspecdefinition(1," not in plan


def test_statistics_over_a_million_times(spark):
    """Real-valued times, all distinct: no window without a key, results as by hand."""
    n = 1_000_000
    df = spark.range(n).selectExpr("id", "(id * 7919 % 1000003) + 0.5 AS t", "int(id % 3 = 0) AS e", "int(id % 2) AS g")
    t = (np.arange(n) * 7919 % 1000003) + 0.5
    e, g = np.arange(n) % 3 == 0, np.arange(n) % 2
    order = np.argsort(t)
    e, g = e[order], g[order]
    left = np.arange(n, 0, -1.0)
    ones = np.cumsum(g[::-1])[::-1].astype(float)
    expected = (ones / left)[e].sum()
    var = ((ones / left) * (1 - ones / left))[e].sum()
    row = {r.group: r for r in stats.log_rank(df, "t", "e", "g").collect()}["1"]
    assert row.expected == pytest.approx(expected, rel=1e-9)
    assert row.chisq == pytest.approx((e[g == 1].sum() - expected) ** 2 / var, rel=1e-6)
    curve = stats.kaplan_meier(df.withColumn("all", F.lit("x")), "t", "e", "all")
    assert no_single_partition(curve)
    want = np.exp(np.cumsum(np.where(e[:-1], np.log1p(-1 / left[:-1]), 0)))
    got = {r.time: r.survival for r in curve.where("time < 200").collect()}
    by_time = dict(zip(np.sort(t)[:-1], want, strict=True))
    assert len(got) > 100 and all(by_time[k] == pytest.approx(v, rel=1e-9) for k, v in got.items())


def test_quantiles_of_distinct_values(spark):
    rng = np.random.default_rng(3)
    values = rng.normal(size=20_000)
    rows = [(float(v), int(k % 3 == 0)) for k, v in enumerate(values)] + [(None, 0)] * 7 + [(None, None)]
    df = spark.createDataFrame(rows, "v double, g int").withColumn("none", F.lit(None).cast("double"))
    out = stats.table_one_numbers(df, ["v", "none"], "g")
    assert no_single_partition(out) and "percentile" not in out._jdf.queryExecution().optimizedPlan().toString()
    got = {(r.variable, r.group): r for r in out.collect()}
    for g in (0, 1):
        own = values[(np.arange(20_000) % 3 == 0) == bool(g)]
        r = got["v", str(g)]
        assert (r.q1, r.median, r.q3) == pytest.approx(tuple(np.quantile(own, [0.25, 0.5, 0.75])), rel=1e-12)
        assert r.n == len(own) and r.missing == (7 if g == 0 else 0)
        assert got["none", str(g)].n == 0 and got["none", str(g)].median is None
    assert got["v", None].missing == 1 and got["v", None].n == 0


def test_ranks_of_many_levels(spark):
    from care_episodes.operators import study

    df = spark.range(30_000).selectExpr("concat('level ', id % 7000 + if(id % 5 = 0, 0, id % 11)) AS c")
    counts = {}
    for r in df.groupBy("c").count().collect():
        counts[r["c"]] = r["count"]
    lumped = study.lump_rare(df, "c", 5)
    assert no_single_partition(lumped)
    total = {}
    for level, k in counts.items():
        total["Other" if k < 5 else level] = total.get("Other" if k < 5 else level, 0) + k
    rank = {level: i + 1 for i, level in enumerate(sorted(total, key=lambda v: (-total[v], v)))}
    for r in lumped.groupBy("c", "c_rank").count().collect():
        assert rank[r["c"]] == r["c_rank"] and total[r["c"]] == r["count"]
