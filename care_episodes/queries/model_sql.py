"""Reference SQL of the regression models: Newton steps as recursive queries, with the linear algebra written out."""

from __future__ import annotations

from collections.abc import Sequence

STEPS = 12
Z = 1.959963984540054


def _pairs(p: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(p) for j in range(i, p)]


def eliminated(source: str, p: int, right: int, keep: str) -> str:
    """Gauss-Jordan on columns m{i}_{j} (i < p, j < p + right) of `source`; no pivoting, for positive definite matrices."""
    for k in range(p):
        cells = []
        for i in range(p):
            for j in range(p + right):
                pivot = f"m{k}_{j} / m{k}_{k}"
                cells.append(f"{pivot if i == k else f'm{i}_{j} - m{i}_{k} * {pivot}'} AS m{i}_{j}")
        source = f"(SELECT {keep}{', '.join(cells)} FROM {source})"
    return source


def _augmented(p: int, right: Sequence[Sequence[str]]) -> str:
    return ", ".join(f"i{min(i, j)}_{max(i, j)} AS m{i}_{j}" for i in range(p) for j in range(p)) + "".join(
        f", {right[i][j]} AS m{i}_{p + j}" for i in range(p) for j in range(len(right[0]))
    )


def hazard_sums(newton: str, x: Sequence[str]) -> str:
    """Gradient u and information i by Efron at the coefficients in `newton`; also g-weighted sums for the test, if rows of ev have g.

    Rows r(t, e, ...) and event times ev(t, n, g); `x` are terms in columns of r and ev.
    """
    p = len(x)
    b = ", ".join(f"b{i}" for i in range(p))
    score = " + ".join(f"b{i} * ({c})" for i, c in enumerate(x))
    xs = ", ".join(f"({c})::DOUBLE x{i}" for i, c in enumerate(x))
    names = {"0": "w"} | {f"1_{i}": f"w * x{i}" for i in range(p)} | {f"2_{i}_{j}": f"w * x{i} * x{j}" for i, j in _pairs(p)}
    tied = "FILTER (tied)"
    sums = ", ".join(f"sum({v}) a{n}, sum({v}) {tied} d{n}" for n, v in names.items())
    sx = ", ".join(f"sum(x{i}) {tied} sx{i}" for i in range(p))

    def thin(n: str) -> str:
        return f"(a{n} - f * d{n})"

    u = [f"sx{i} / n - {thin(f'1_{i}')} / {thin('0')}" for i in range(p)]
    info = {(i, j): f"{thin(f'2_{i}_{j}')} / {thin('0')} - {thin(f'1_{i}')} * {thin(f'1_{j}')} / pow({thin('0')}, 2)" for i, j in _pairs(p)}
    out = [f"sum({c}) u{i}" for i, c in enumerate(u)] + [f"sum(g * ({c})) gu{i}" for i, c in enumerate(u)]
    for i, j in _pairs(p):
        out += [f"sum({info[i, j]}) i{i}_{j}", f"sum(g * ({info[i, j]})) gi{i}_{j}", f"sum(g * g * ({info[i, j]})) ggi{i}_{j}"]
    return f"""(SELECT k, {b}, {', '.join(out)} FROM (SELECT *, unnest(range(n)) / n::DOUBLE f FROM (
  SELECT k, {b}, v, n, g, {sums}, {sx} FROM (
    SELECT k, {b}, ev.t AS v, ev.n, ev.g, r.t = ev.t AND r.e = 1 tied, exp({score}) w, {xs} FROM {newton}, r JOIN ev ON r.t >= ev.t)
  GROUP BY k, {b}, v, n, g)) GROUP BY k, {b})"""


def _newton(p: int, sums: str, steps: int = STEPS) -> str:
    b = ", ".join(f"b{i}" for i in range(p))
    matrix = f"(SELECT k, {b}, {_augmented(p, [[f'u{i}'] for i in range(p)])} FROM {sums})"
    solved = eliminated(matrix, p, 1, f"k, {b}, ")
    return f"""newton AS (SELECT 0 AS k, {', '.join(f'0::DOUBLE b{i}' for i in range(p))} UNION ALL
SELECT k + 1, {', '.join(f'b{i} + m{i}_{p}' for i in range(p))} FROM {solved} WHERE k < {steps}),
best AS (SELECT * FROM newton WHERE k = {steps})"""


def normal_two_sided(z: str) -> str:
    """1 - erf(|z| / sqrt 2), by a series of positive terms."""
    x = f"(abs({z}) / sqrt(2))"
    series = f"list_sum(list_transform(range(250), lambda n: exp(2 * n * ln(2) + (2 * n + 1) * ln({x}) + lgamma(n + 1) - lgamma(2 * n + 2) - {x} * {x})))"
    return f"(CASE WHEN {x} = 0 THEN 1 WHEN {x} > 8 THEN 0 ELSE 1 - 2 / sqrt(pi()) * {series} END)"


def _terms(p: int, names: Sequence[str], sums: str, digits: int) -> str:
    unit = [["1" if i == j else "0" for j in range(p)] for i in range(p)]
    b = ", ".join(f"b{i}" for i in range(p))
    inverse = eliminated(f"(SELECT {b}, {_augmented(p, unit)} FROM {sums})", p, p, f"{b}, ")
    rows = " UNION ALL ".join(f"SELECT '{n}' term, b{i} b, sqrt(m{i}_{p + i}) se FROM inverse" for i, n in enumerate(names))
    return f"""inverse AS (SELECT * FROM {inverse}), terms AS ({rows})
SELECT term, round(b, {digits}) coefficient, round(se, {digits}) std_error, round(exp(b), {digits}) ratio, round(exp(b - {Z} * se), {digits}) low,
  round(exp(b + {Z} * se), {digits}) high, round({normal_two_sided('b / se')}, {digits}) p_value FROM terms"""


def cox_sql(rows: str, x: Sequence[str], names: Sequence[str], digits: int = 4) -> str:
    """Hazard ratios of the rows (t, e, ...) given as a query, by terms `x` in columns of r (and ev.t)."""
    p = len(x)
    return f"""SELECT * FROM (WITH RECURSIVE r AS MATERIALIZED ({rows}),
ev AS MATERIALIZED (SELECT t, count(*) n, 0::DOUBLE g FROM r WHERE e = 1 GROUP BY t),
{_newton(p, hazard_sums('newton', x))},
{_terms(p, names, hazard_sums('best', x), digits)})"""


def ph_test_sql(rows: str, x: str, name: str, digits: int = 4) -> str:
    """Score test of x * (1 - survival just before t) for a single term."""
    p_value = normal_two_sided("sqrt(chisq)")
    return f"""SELECT * FROM (WITH RECURSIVE r AS MATERIALIZED ({rows}),
d AS (SELECT t, count(*) FILTER (e = 1) n, (SELECT count(*) FROM r o WHERE o.t >= r.t) at_risk FROM r GROUP BY t),
ev AS MATERIALIZED (
  SELECT t, n, 1 - coalesce(exp(sum(CASE WHEN n < at_risk THEN ln(1 - n / at_risk) END) OVER (ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)), 1) g
  FROM d WHERE n > 0),
{_newton(1, hazard_sums('newton', [x]))},
test AS (SELECT pow(gu0, 2) / (ggi0_0 - gi0_0 * gi0_0 / i0_0) chisq FROM {hazard_sums('best', [x])})
SELECT term, round(chisq, {digits}) chisq, 1 AS df, round({p_value}, {digits}) p_value FROM test, (VALUES ('{name}'), ('GLOBAL')) v(term))"""


def logistic_sql(rows: str, x: Sequence[str], names: Sequence[str], digits: int = 4) -> str:
    """Odds ratios of the rows (y, ...) given as a query; an intercept comes first."""
    terms = ["1", *x]
    p = len(terms)

    def sums(newton: str) -> str:
        b = ", ".join(f"b{i}" for i in range(p))
        score = " + ".join(f"b{i} * x{i}" for i in range(p))
        out = [f"sum(w * (y - m) * x{i}) u{i}" for i in range(p)] + [f"sum(w * m * (1 - m) * x{i} * x{j}) i{i}_{j}" for i, j in _pairs(p)]
        return f"(SELECT k, {b}, {', '.join(out)} FROM (SELECT *, 1 / (1 + exp(-({score}))) m FROM {newton}, r) GROUP BY k, {b})"

    columns = ", ".join(f"({c})::DOUBLE x{i}" for i, c in enumerate(terms))
    return f"""SELECT * FROM (WITH RECURSIVE r AS MATERIALIZED (SELECT y, {columns}, count(*)::DOUBLE w FROM ({rows}) GROUP BY ALL),
{_newton(p, sums('newton'))},
{_terms(p, ['(Intercept)', *names], sums('best'), digits)})"""


def poisson_limits_sql(rates: str, keep: str) -> str:
    """Exact limits of rates (..., events, person_years) by bisection on the Poisson distribution."""

    def cdf(k: str, at: str) -> str:
        return f"coalesce(list_sum(list_transform(range({k} + 1), lambda i: exp(-({at}) + i * ln({at}) - lgamma(i + 1)))), 0)"

    mid0, mid1 = "(low0 + low1) / 2", "(high0 + high1) / 2"
    return f"""SELECT * FROM (WITH RECURSIVE rates AS MATERIALIZED ({rates}), search AS (
  SELECT 0 AS k, *, 0::DOUBLE low0, events + 1::DOUBLE low1, events::DOUBLE high0, 2 * events + 20::DOUBLE high1 FROM rates UNION ALL
  SELECT k + 1, * EXCLUDE (k, low0, low1, high0, high1),
    CASE WHEN 1 - {cdf('events - 1', mid0)} < 0.025 THEN {mid0} ELSE low0 END, CASE WHEN 1 - {cdf('events - 1', mid0)} < 0.025 THEN low1 ELSE {mid0} END,
    CASE WHEN {cdf('events', mid1)} > 0.025 THEN {mid1} ELSE high0 END, CASE WHEN {cdf('events', mid1)} > 0.025 THEN high1 ELSE {mid1} END
  FROM search WHERE k < 60)
SELECT {keep}, round(CASE WHEN events = 0 THEN 0 ELSE low0 END / person_years * 1000, 6) rate_low, round(high0 / person_years * 1000, 6) rate_high
FROM search WHERE k = 60)"""


def profile_sql(rows: str, x: str, level: float = 3.841458820694124, digits: int = 4) -> str:
    """Profile limits of intercept and coefficient for one 0/1 covariate: the other parameter has a closed form."""

    def loglik(y: str, n: str, odds: str) -> str:
        return f"({y} * ln({odds}) - {n} * ln(1 + {odds}))"

    k, whole = "exp(v)", "(n0 + n1)"
    a, b = f"({k} * ({whole} - y0 - y1))", f"(n0 + n1 * {k} - (y0 + y1) * (1 + {k}))"
    base = f"((-{b} + sqrt(pow({b}, 2) + 4 * {a} * (y0 + y1))) / (2 * {a}))"
    slope = f"({loglik('y0', 'n0', base)} + {loglik('y1', 'n1', f'({base} * {k})')})"
    intercept = f"({loglik('y0', 'n0', k)} + {loglik('y1', 'n1', '(y1 / (n1 - y1))')})"
    return f"""SELECT * FROM (WITH RECURSIVE c AS (
  SELECT count(*) FILTER ({x} = 0)::DOUBLE n0, count(*) FILTER ({x} = 1)::DOUBLE n1, sum(y) FILTER ({x} = 0)::DOUBLE y0, sum(y) FILTER ({x} = 1)::DOUBLE y1 FROM ({rows})),
fitted AS (SELECT *, ln(y0 / (n0 - y0)) b0, ln(y1 / (n1 - y1)) - ln(y0 / (n0 - y0)) b1,
  {loglik('y0', 'n0', '(y0 / (n0 - y0))')} + {loglik('y1', 'n1', '(y1 / (n1 - y1))')} top FROM c),
search AS (
  SELECT 0 AS step, *, CASE term WHEN 0 THEN b0 ELSE b1 END near, CASE term WHEN 0 THEN b0 ELSE b1 END + side * 8 far
  FROM fitted, (VALUES (0), (1)) t(term), (VALUES (-1), (1)) s(side)
  UNION ALL SELECT step + 1, * EXCLUDE (step, near, far, v, fall), CASE WHEN fall < {level} THEN v ELSE near END, CASE WHEN fall < {level} THEN far ELSE v END
  FROM (SELECT *, 2 * (top - CASE term WHEN 0 THEN {intercept} ELSE {slope} END) fall FROM (SELECT *, (near + far) / 2 AS v FROM search)) WHERE step < 60)
SELECT CASE term WHEN 0 THEN '(Intercept)' ELSE '{x}' END term, round(any_value(CASE term WHEN 0 THEN b0 ELSE b1 END), {digits}) coefficient,
  round(exp(any_value(CASE term WHEN 0 THEN b0 ELSE b1 END)), {digits}) ratio, round(exp(max(near) FILTER (side = -1)), {digits}) low, round(exp(max(near) FILTER (side = 1)), {digits}) high
FROM search WHERE step = 60 GROUP BY ALL)""".replace("GROUP BY ALL)", "GROUP BY search.term)").replace("SELECT CASE term WHEN 0 THEN '(Intercept)'", "SELECT CASE search.term WHEN 0 THEN '(Intercept)'")
