"""Regression models of the study (T5, T6), many at a time.

All models of a call are fitted together: a row of the input becomes one row per model it belongs to, in one scan, and every Newton
step is one job whose aggregate is grouped by model.  The number of jobs is that of the slowest model, however many there are.
What reaches the driver is a gradient and an information matrix per model; solving them is the only work there.

Proportional hazards need sums over everybody still at risk.  Rows equal in model, time, event and covariates are counted once; the
table by time is dealt out by ranges of time and written once, and each step takes running sums over the ranges
(`functions/scan.py`), so no task holds all times.  Tied events (Efron) enter by three sums per event time, of log s, 1/s and
1/s**2 over the thinned risk sums s; all other terms are linear in them.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from care_episodes.functions.scan import PART, ordered_parts, running_sums
from care_episodes.functions.special import chi_square_quantile, chi_square_tail, normal_two_sided
from care_episodes.session import materialize, small_table

#: Tied events that one row sums up.
TIES = 10_000

Z95 = 1.959963984540054


@dataclass(frozen=True)
class Levels:
    """A categorical covariate: one 0/1 term per level but the first."""

    column: str
    levels: tuple

    def terms(self) -> dict[str, Column]:
        return {f"{self.column}={v}": (F.col(self.column) == v).cast("double") for v in self.levels[1:]}


Covariate = str | Levels


def covariate_terms(covariate: Covariate) -> dict[str, Column]:
    """Model terms of a covariate: a column as it is, "a:b" as a product, `Levels` as indicators."""
    if isinstance(covariate, Levels):
        return covariate.terms()
    if ":" in covariate:
        a, b = covariate.split(":")
        return {covariate: F.col(a).cast("double") * F.col(b).cast("double")}
    return {covariate: F.col(covariate).cast("double")}


def design_terms(covariates: Sequence[Covariate]) -> dict[str, Column]:
    return {name: term for c in covariates for name, term in covariate_terms(c).items()}


@dataclass(frozen=True)
class Model:
    """What one model explains, by what, on which rows (null or false in `where`: left out)."""

    covariates: tuple[Covariate, ...]
    event: str
    time: str | None = None
    where: Column | None = None


@dataclass
class Fit:
    """A model on its way and its end: names, coefficients, information."""

    names: list[str]
    groups: dict[str, list[int]]
    constant: list[str] = field(default_factory=list)
    beta: np.ndarray = field(default_factory=lambda: np.zeros(0))
    centre: np.ndarray = field(default_factory=lambda: np.zeros(0))
    info: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    loglik: float | None = None

    def rows(self) -> list[tuple]:
        """(term, coefficient, std_error, ratio, low, high, p_value); terms without variation have no numbers."""
        out = [(name, *[None] * 6) for name in self.constant]
        errors = np.sqrt(np.diag(np.linalg.inv(self.info))) if len(self.beta) else []
        for name, b, se in zip(self.names, self.beta, errors, strict=True):
            p = float(normal_two_sided(b / se)) if se > 0 else None
            out.append((name, float(b), float(se), _exp(b), _exp(b - Z95 * se), _exp(b + Z95 * se), p))
        return out


ROW = "term string, coefficient double, std_error double, ratio double, low double, high double, p_value double"


def _exp(v: float) -> float:
    return math.exp(v) if v < 700 else math.inf


def _model_table(spark, fits: Iterable[tuple[tuple, Fit]], labels: str) -> DataFrame:
    rows = [(*label, *row) for label, fit in fits for row in fit.rows()]
    return small_table(spark, rows, f"{labels}, {ROW}" if labels else ROW)


def _pairs(p: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(p) for j in range(i, p)]


def _matrix(row, name: str, p: int) -> np.ndarray:
    out = np.zeros((p, p))
    for i, j in _pairs(p):
        out[i, j] = out[j, i] = float(row[f"{name}{i}_{j}"] or 0)
    return out


def _long_rows(df: DataFrame, models: Sequence[Model], terms: Sequence[dict[str, Column]], first: Sequence[Column] = ()) -> DataFrame:
    """(m, t, e, x0...) with one row per model and input row; shorter models are filled up with zeros, incomplete rows left out."""
    width = max(len(first) + len(t) for t in terms)
    structs = []
    for m, (model, own) in enumerate(zip(models, terms, strict=True)):
        inside = F.lit(True) if model.where is None else F.coalesce(model.where, F.lit(False))
        columns = [*first, *own.values()]
        columns += [F.lit(0.0)] * (width - len(columns))
        time = F.lit(0.0) if model.time is None else F.col(model.time).cast("double")
        structs.append(F.struct(
            F.lit(m).alias("m"), F.when(inside, time).alias("t"), F.col(model.event).cast("double").alias("e"),
            *[c.alias(f"x{i}") for i, c in enumerate(columns)],
        ))
    return df.select(F.explode(F.array(*structs)).alias("r")).select("r.*").dropna()


def _parameters(spark, fits: dict[int, Fit], width: int, beta: bool = True) -> DataFrame:
    """The models still on their way, as a table (m, c0..., b0...)."""
    rows = []
    for m, fit in fits.items():
        pad = [0.0] * (width - len(fit.centre))
        rows.append((m, *map(float, fit.centre), *pad, *map(float, fit.beta), *pad))
    ddl = "m int, " + ", ".join(f"{k}{i} double" for k in "cb" for i in range(width))
    return small_table(spark, rows, ddl)


# ---- T5 -------------------------------------------------------------------------------------
class _Hazards:
    """Risk-set sums of proportional-hazards models, by model and event time.

    With `log_time` (the term number of a covariate, and its values) the models have one more term, that covariate times the log
    of time: sums are kept by value, and weighed at each event time by what the time makes of the value.
    """

    def __init__(self, df: DataFrame, models: Sequence[Model], log_time: tuple[int, Sequence[float]] | None = None):
        self.spark, self.models = df.sparkSession, models
        groups = [{(c.column if isinstance(c, Levels) else c): covariate_terms(c) for c in m.covariates} for m in models]
        terms = [{n: t for own in g.values() for n, t in own.items()} for g in groups]
        self.width = max(map(len, terms))
        x = [f"x{i}" for i in range(self.width)]
        counted = _long_rows(df, models, terms).groupBy("m", "t", "e", *x).agg(F.count(F.lit(1)).alias("w"))
        self.parts = ordered_parts(counted, ["m"], [F.desc("t"), "e", *x], cut=[F.desc("t")])
        is_event = F.col("e") == 1
        facts = [F.sum(F.when(is_event, F.col("w")).otherwise(0)).alias("events"), F.min(F.when(is_event, F.col("t"))).alias("first")]
        for c in x:
            facts += [(F.sum(F.col(c) * F.col("w")) / F.sum("w")).alias(f"mean_{c}"), (F.min(c) < F.max(c)).alias(f"{c}_varies")]
        found = {r["m"]: r for r in self.parts.groupBy("m").agg(*facts).collect()}
        self.log_time, self.fits = log_time, {}
        for m, (model, own) in enumerate(zip(models, terms, strict=True)):
            row = found.get(m)
            if row is None or not row["events"]:
                raise ValueError(f"no events in {model.event}")
            names = list(own)
            # A term without variation has no estimate: its place stays empty and it is reported without one.
            varies = [bool(row[f"x{i}_varies"]) for i in range(len(names))]
            at, by_group = 0, {}
            for g, members in groups[m].items():
                by_group[g] = [k for k in range(at, at + len(members)) if varies[k]]
                at += len(members)
            fit = Fit(names, by_group, [n for n, v in zip(names, varies, strict=True) if not v])
            fit.free = [k for k, v in enumerate(varies) if v]
            fit.centre = np.array([row[f"mean_x{i}"] for i in range(len(names))])
            if log_time is not None:
                if row["first"] <= 0:
                    raise ValueError("a term by the log of time needs event times above 0")
                # Values of the covariate stay as they are, so that they can be told apart.
                fit.centre[log_time[0]] = 0.0
                fit.free.append(len(names))
                fit.names = [*names, f"{names[log_time[0]]}:log({model.time})"]
            fit.beta = np.zeros(len(fit.names))
            self.fits[m] = fit
        self.terms = self.width + (log_time is not None)

    def sets(self, active: dict[int, Fit]) -> DataFrame:
        """(m, _part, t, n tied events, at_risk, sx*, gx, then a*/d*: sums of everybody at risk and of the events) per event time."""
        width, pairs = self.width, _pairs(self.width)
        # The extra term's coefficient is applied at the event times.
        fits = {m: Fit(f.names, f.groups, beta=f.beta[: width if self.log_time else None], centre=f.centre) for m, f in active.items()}
        both = self.parts.join(_parameters(self.spark, fits, width), "m")
        both = both.withColumns({f"x{i}": F.col(f"x{i}") - F.col(f"c{i}") for i in range(width)})
        score = sum((F.col(f"b{i}") * F.col(f"x{i}") for i in range(width)), F.lit(0.0))
        risk = both.withColumn("_eta", score).withColumn("_r", F.col("w") * F.exp("_eta"))
        is_event = F.col("e") == 1
        levels = [None] if self.log_time is None else list(range(len(self.log_time[1])))
        totals, sums = [], []
        for v in levels:
            mine = F.lit(True) if v is None else F.col(f"x{self.log_time[0]}") == float(self.log_time[1][v])
            of = "" if v is None else f"_v{v}"
            values = {f"0{of}": F.col("_r")} | {f"1_{i}{of}": F.col("_r") * F.col(f"x{i}") for i in range(width)}
            values |= {f"2_{i}_{j}{of}": F.col("_r") * F.col(f"x{i}") * F.col(f"x{j}") for i, j in pairs}
            for name, value in values.items():
                sums += [F.sum(F.when(mine, value).otherwise(0.0)).alias(f"a{name}"), F.sum(F.when(mine & is_event, value).otherwise(0.0)).alias(f"d{name}")]
                totals.append(f"a{name}")
        sums.append(F.sum(F.when(is_event, F.col("w")).otherwise(0)).alias("n"))
        sums.append(F.sum("w").alias("leaving"))
        sums.append(F.sum(F.when(is_event, F.col("w") * F.col("_eta")).otherwise(0.0)).alias("gx"))
        sums += [F.sum(F.when(is_event, F.col("w") * F.col(f"x{i}")).otherwise(0.0)).alias(f"sx{i}") for i in range(width)]
        by_time = risk.groupBy("m", PART, "t").agg(*sums)
        cumulated = running_sums(
            by_time, ["m"], [F.desc("t")], {**{f"_s_{c}": F.col(c) for c in totals}, "at_risk": F.col("leaving")}
        )
        kept = [c for c in by_time.columns if c not in totals]
        sets = cumulated.select(*kept, "at_risk", *[F.col(f"_s_{c}").alias(c) for c in totals]).filter("n > 0")
        return sets if self.log_time is None else self._weighed(sets, active)

    def _weighed(self, sets: DataFrame, active: dict[int, Fit]) -> DataFrame:
        """Sums by value put together at each event time, with the term x * log(t) as the last one."""
        width, (at, values) = self.width, self.log_time
        gamma = float(next(iter(active.values())).beta[width])
        lt = F.log("t")
        out = {}
        for k in "ad":
            parts = {}

            def add(name, value, parts=parts):
                parts[name] = parts[name] + value if name in parts else value

            for v, x in enumerate(values):
                factor = F.exp(F.lit(gamma * float(x)) * lt)
                extra = F.lit(float(x)) * lt
                s0 = factor * F.col(f"{k}0_v{v}")
                add("0", s0)
                add(f"1_{width}", extra * s0)
                add(f"2_{width}_{width}", extra * extra * s0)
                for i in range(width):
                    s1 = factor * F.col(f"{k}1_{i}_v{v}")
                    add(f"1_{i}", s1)
                    add(f"2_{i}_{width}", extra * s1)
                for i, j in _pairs(width):
                    add(f"2_{i}_{j}", factor * F.col(f"{k}2_{i}_{j}_v{v}"))
            out |= {f"{k}{n}": c for n, c in parts.items()}
        extra = F.col(f"sx{at}") * lt
        out |= {f"sx{width}": extra, "gx": F.col("gx") + F.lit(gamma) * extra}
        base = [c for c in sets.columns if not c.startswith(("a0", "a1", "a2", "d0", "d1", "d2", "gx"))]
        return sets.select(*base, *[c.alias(n) for n, c in out.items()])

    def parts_of(self, sets: DataFrame) -> tuple[DataFrame, dict[str, Column]]:
        """Efron's sums: rows (some ties each) and, per row, what it adds to log likelihood, gradient and information."""
        p, n = self.terms, F.col("n")
        most = max(1, TIES)
        chunk = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((n - 1) / most)))
        rows = sets.withColumn("_chunk", chunk)
        first, low = F.col("_chunk") == 0, F.col("_chunk") * most
        steps = F.sequence(low, F.least(n, low + most) - 1)
        a0, d0 = F.col("a0"), F.col("d0")

        def add(acc, k):
            s = a0 - k / n * d0
            return F.struct((acc["l"] + F.log(s)).alias("l"), (acc["h1"] + 1 / s).alias("h1"), (acc["h2"] + 1 / (s * s)).alias("h2"))

        zero = F.struct(F.lit(0.0).alias("l"), F.lit(0.0).alias("h1"), F.lit(0.0).alias("h2"))
        rows = rows.withColumn("_e", F.aggregate(steps, zero, add)).withColumn("_k", F.size(steps).cast("double"))
        k, h1, h2 = F.col("_k"), F.col("_e.h1"), F.col("_e.h2")

        def once(c: Column) -> Column:
            return F.when(first, c).otherwise(0.0)

        # A thinned sum a - f * d is alpha * s + rest with s = a0 - f * d0.
        alpha = {i: F.col(f"d1_{i}") / d0 for i in range(p)}
        rest = {i: F.col(f"a1_{i}") - alpha[i] * a0 for i in range(p)}
        out = {"loglik": once(F.col("gx")) - F.col("_e.l")}
        for i in range(p):
            out[f"u{i}"] = once(F.col(f"sx{i}")) - (alpha[i] * k + rest[i] * h1)
        for i, j in _pairs(p):
            both = F.col(f"d2_{i}_{j}") / d0
            second = both * k + (F.col(f"a2_{i}_{j}") - both * a0) * h1
            product = alpha[i] * alpha[j] * k + (alpha[i] * rest[j] + alpha[j] * rest[i]) * h1 + rest[i] * rest[j] * h2
            out[f"i{i}_{j}"] = second - product
        return rows, out

    def fit(self, max_steps: int, tolerance: float) -> list[Fit]:
        active = dict(self.fits)
        last: dict[int, tuple] = {}
        for _ in range(max_steps):
            rows, adds = self.parts_of(self.sets(active))
            for row in rows.groupBy("m").agg(*[F.sum(c).alias(n) for n, c in adds.items()]).collect():
                fit = active[row["m"]]
                before, direction, size = last.get(row["m"], (None, None, 1.0))
                loglik = float(row["loglik"])
                if before is not None and loglik < before - 1e-12 * abs(before):
                    last[row["m"]] = (before, direction, size / 2)
                    fit.beta = fit.beta - direction * size / 2
                    continue
                free = fit.free
                info = _matrix(row, "i", self.terms)[np.ix_(free, free)]
                gradient = np.array([float(row[f"u{k}"]) for k in free])
                fit.full_info, fit.loglik = info, loglik
                if np.linalg.matrix_rank(info) < len(free):
                    raise ValueError(f"terms are not independent: {fit.names}")
                step = np.zeros(len(fit.beta))
                step[free] = np.linalg.solve(info, gradient) if free else 0.0
                last[row["m"]] = (loglik, step, 1.0)
                fit.beta = fit.beta + step
                if before is not None and abs(loglik - before) <= tolerance * (abs(before) + 1e-9):
                    del active[row["m"]]
            if not active:
                break
        else:
            late = [self.models[m].event for m in active]
            raise RuntimeError(f"the models of {late} did not converge in {max_steps} steps")
        return [self._done(self.fits[m]) for m in range(len(self.models))]

    @staticmethod
    def _done(fit: Fit) -> Fit:
        free = fit.free
        names = [fit.names[k] for k in free]
        groups = {g: [free.index(k) for k in members] for g, members in fit.groups.items()}
        done = Fit(names, groups, fit.constant, fit.beta[free], fit.centre, fit.full_info, fit.loglik)
        done.free = free
        return done


def cox_fits(df: DataFrame, models: Sequence[Model], max_steps: int = 25, tolerance: float = 1e-9) -> list[Fit]:
    """T5: proportional-hazards models with Efron's treatment of ties, all fitted together."""
    return _Hazards(df, models).fit(max_steps, tolerance)


def cox_ph(
    df: DataFrame, time: str, event: str, covariates: Sequence[Covariate], max_steps: int = 25, tolerance: float = 1e-9
) -> DataFrame:
    """T5: one model; hazard ratios as `ratio`.  A fit that does not converge raises an error."""
    fit = cox_fits(df, [Model(tuple(covariates), event, time)], max_steps, tolerance)
    return _model_table(df.sparkSession, [((), fit[0])], "")


def cox_table(
    df: DataFrame, outcomes: dict[str, tuple[str, str]], exposures: Sequence[str], adjustment: Sequence[Covariate], subsets: dict[str, Column] | None = None
) -> DataFrame:
    """T5: hazard ratio of each exposure for each outcome {name: (time, event)}, plain and adjusted, in each subset {name: condition}.

    All models are fitted together; without subsets the result has no column for them.
    """
    labels, models = [], []
    for subset, where in (subsets or {"": None}).items():
        for outcome, (time, event) in outcomes.items():
            for exposure in exposures:
                for model, extra in (("unadjusted", ()), ("adjusted", tuple(adjustment))):
                    labels.append((subset, outcome, model, exposure) if subsets else (outcome, model, exposure))
                    models.append(Model((exposure, *extra), event, time, where))
    fits = cox_fits(df, models)
    rows = [(*label[:-1], *row) for label, fit in zip(labels, fits, strict=True) for row in fit.rows() if row[0] == label[-1]]
    named = ("subset string, " if subsets else "") + "outcome string, model string"
    return small_table(df.sparkSession, rows, f"{named}, {ROW}")


def follow_up_intervals(df: DataFrame, years: str, exposure: str, cuts: tuple[float, float] = (4, 8)) -> DataFrame:
    """T5: exposure split by length of follow-up (early, middle, late), for interval-specific terms."""
    t, x = F.col(years), F.col(exposure)
    early, late = t <= cuts[0], t > cuts[1]
    return df.withColumns(
        {
            f"{exposure}_early": (x * early.cast("int")),
            f"{exposure}_mid": (x * (~early & ~late).cast("int")),
            f"{exposure}_late": (x * late.cast("int")),
        }
    )


TRANSFORMS = ("km", "identity", "log")


def cox_ph_test(
    df: DataFrame, time: str, event: str, covariates: Sequence[Covariate], transform: str = "km", max_steps: int = 25, tolerance: float = 1e-9
) -> DataFrame:
    """T5: test of proportional hazards, per covariate and for all together (GLOBAL).

    It is the score test of further terms x * g(t) at the fitted model, where g is one minus the survival just before t ('km'), t, or
    its log.  The sums it needs are those of a Newton step times powers of g(t), taken in one job.
    """
    if transform not in TRANSFORMS:
        raise ValueError(f"transform is one of {TRANSFORMS}")
    hazards = _Hazards(df, [Model(tuple(covariates), event, time)])
    fit = hazards.fit(max_steps, tolerance)[0]
    sets = materialize(hazards.sets({0: hazards.fits[0]}))
    if transform == "km":
        step = F.when(F.col("n") < F.col("at_risk"), F.log1p(-F.col("n") / F.col("at_risk")))
        later = running_sums(sets, ["m"], [F.desc("t")], {"_from_here": step})
        total = sets.agg(F.coalesce(F.sum(step), F.lit(0.0)).alias("_total"))
        timed = later.join(total).withColumn("_g", 1 - F.exp(F.col("_total") - F.col("_from_here")))
    else:
        timed = sets.withColumn("_g", F.col("t") if transform == "identity" else F.log("t"))
    rows, adds = hazards.parts_of(timed)
    g, p = F.col("_g"), len(fit.free)
    sums = [F.sum(adds[f"u{k}"] * g).alias(f"u{i}") for i, k in enumerate(fit.free)]
    for power in (1, 2):
        for i, j in _pairs(p):
            a, b = fit.free[i], fit.free[j]
            sums.append(F.sum(adds[f"i{a}_{b}"] * F.pow(g, F.lit(float(power)))).alias(f"g{power}_{i}_{j}"))
    row = rows.agg(*sums).first()
    score = np.array([row[f"u{i}"] for i in range(p)])
    once, twice = _matrix(row, "g1_", p), _matrix(row, "g2_", p)
    left = twice - once @ np.linalg.solve(fit.info, once)
    tests = [(name, members) for name, members in fit.groups.items() if members] + [("GLOBAL", list(range(p)))]
    out = []
    for name, members in tests:
        chisq = float(score[members] @ np.linalg.solve(left[np.ix_(members, members)], score[members]))
        out.append((name, chisq, len(members), chi_square_tail(chisq, len(members))))
    return small_table(df.sparkSession, out, "term string, chisq double, df int, p_value double")


def cox_log_time(
    df: DataFrame, time: str, event: str, exposure: str, covariates: Sequence[Covariate] = (), shift_zero: float = 0.001, max_steps: int = 25, tolerance: float = 1e-9
) -> DataFrame:
    """T5: a model whose exposure acts differently as time goes on: terms for it, for it times log(time), and for the covariates.

    The exposure has few values; risk-set sums are kept for each (the columns of a step grow with their number).  Times of 0 are moved to `shift_zero`.
    """
    shifted = df.withColumn(time, F.when(F.col(time) == 0, F.lit(shift_zero)).otherwise(F.col(time).cast("double")))
    complete = shifted.dropna(subset=[time, event, exposure, *[c.column if isinstance(c, Levels) else c for c in covariates if isinstance(c, Levels) or ":" not in c]])
    values = sorted(float(r[0]) for r in complete.select(F.col(exposure).cast("double")).distinct().collect())
    fit = _Hazards(shifted, [Model((exposure, *covariates), event, time)], (0, values)).fit(max_steps, tolerance)
    return _model_table(df.sparkSession, [((), fit[0])], "")


# ---- T6 -------------------------------------------------------------------------------------
def _logistic_rows(df: DataFrame, models: Sequence[Model]) -> tuple[DataFrame, list[Fit], int]:
    terms = [design_terms(m.covariates) for m in models]
    width = 1 + max(map(len, terms))
    x = [f"x{i}" for i in range(width)]
    rows = _long_rows(df, models, terms, [F.lit(1.0)])
    counted = materialize(rows.groupBy("m", "e", *x).agg(F.count(F.lit(1)).cast("double").alias("w")))
    fits = []
    for own in terms:
        n = 1 + len(own)
        fits.append(Fit(["(Intercept)", *own], {}, beta=np.zeros(n), centre=np.zeros(n), info=np.eye(n)))
    return counted, fits, width


def _logistic_sums(rows: DataFrame, by: Sequence[str], width: int) -> DataFrame:
    """Log likelihood, gradient and information of logistic models, grouped by model (and candidate)."""
    eta = sum((F.col(f"b{i}") * F.col(f"x{i}") for i in range(width)), F.lit(0.0))
    rows = rows.withColumn("_eta", eta).withColumn("_m", 1 / (1 + F.exp(-F.col("_eta"))))
    w, m = F.col("w"), F.col("_m")
    # log(1 + exp(eta)) without overflow
    softplus = F.greatest("_eta", F.lit(0.0)) + F.log1p(F.exp(-F.abs("_eta")))
    sums = [F.sum(w * (F.col("e") * F.col("_eta") - softplus)).alias("loglik")]
    sums += [F.sum(w * (F.col("e") - m) * F.col(f"x{i}")).alias(f"u{i}") for i in range(width)]
    sums += [F.sum(w * m * (1 - m) * F.col(f"x{i}") * F.col(f"x{j}")).alias(f"i{i}_{j}") for i, j in _pairs(width)]
    return rows.groupBy(*by).agg(*sums)


def _newton_logistic(spark, counted: DataFrame, fits: list[Fit], models: Sequence[Model], width: int, max_steps: int, tolerance: float) -> None:
    active = dict(enumerate(fits))
    for _ in range(max_steps):
        table = _logistic_sums(counted.join(_parameters(spark, active, width), "m"), ["m"], width)
        found = {r["m"]: r for r in table.collect()}
        for m, fit in list(active.items()):
            row, p = found.get(m), len(fit.beta)
            if row is None:
                raise ValueError(f"no complete rows for {models[m].event}")
            fit.info, fit.loglik = _matrix(row, "i", p), float(row["loglik"])
            if np.linalg.matrix_rank(fit.info) < p:
                raise ValueError(f"terms are not independent: {fit.names}")
            step = np.linalg.solve(fit.info, np.array([row[f"u{i}"] for i in range(p)]))
            fit.beta = fit.beta + step
            if np.max(np.abs(step)) < tolerance * (1 + np.max(np.abs(fit.beta))):
                del active[m]
        if not active:
            return
    raise RuntimeError(f"the models of {[models[m].event for m in active]} did not converge in {max_steps} steps")


def logistic_fits(df: DataFrame, models: Sequence[Model], max_steps: int = 25, tolerance: float = 1e-10) -> list[Fit]:
    """Logistic models, all fitted together; rows with a missing value are left out of the model that needs it."""
    counted, fits, width = _logistic_rows(df, models)
    _newton_logistic(df.sparkSession, counted, fits, models, width, max_steps, tolerance)
    return fits


def logistic_or(
    df: DataFrame, outcome: str, covariates: Sequence[Covariate], max_steps: int = 25, tolerance: float = 1e-10
) -> DataFrame:
    """Odds ratios (`ratio`) with Wald limits; rows with a missing value are left out."""
    fit = logistic_fits(df, [Model(tuple(covariates), outcome)], max_steps, tolerance)
    return _model_table(df.sparkSession, [((), fit[0])], "")


def logistic_each(df: DataFrame, outcome: str, covariates: Sequence[Covariate]) -> DataFrame:
    """One model per covariate, all terms of all models."""
    names = [c.column if isinstance(c, Levels) else c for c in covariates]
    fits = logistic_fits(df, [Model((c,), outcome) for c in covariates])
    return _model_table(df.sparkSession, [((n,), f) for n, f in zip(names, fits, strict=True)], "variable string")


def logistic_profile(
    df: DataFrame, outcome: str, covariates: Sequence[Covariate], level: float = 0.95, max_steps: int = 60, tolerance: float = 1e-9
) -> DataFrame:
    """Odds ratios with profile-likelihood limits.

    A limit of a coefficient is where the likelihood, with all others refitted, has dropped by half the chi-square quantile.  All limits
    of the model are sought together, one job a step: each solves for the largest (or smallest) coefficient on the likelihood's
    quadratic approximation at the wanted drop.  A limit that isn't found (separated data) is null.
    """
    models = [Model(tuple(covariates), outcome)]
    counted, fits, width = _logistic_rows(df, models)
    spark, fit = df.sparkSession, fits[0]
    _newton_logistic(spark, counted, fits, models, width, 25, 1e-10)
    p, beta = len(fit.beta), fit.beta
    wanted = fit.loglik - chi_square_quantile(level, 1) / 2
    spread = np.sqrt(np.diag(np.linalg.inv(fit.info)))
    at = {(k, side): beta + side * 0.0 for k in range(p) for side in (-1, 1)}
    found: dict[tuple[int, int], float] = {}
    candidates = list(at)
    for _ in range(max_steps):
        open_ = [c for c in candidates if c not in found]
        if not open_:
            break
        rows = [(0, candidates.index(c), *map(float, at[c])) for c in open_]
        table = small_table(spark, rows, "m int, c int, " + ", ".join(f"b{i} double" for i in range(width)))
        for row in _logistic_sums(counted.join(table, "m"), ["c"], width).collect():
            k, side = key = candidates[row["c"]]
            info, gradient, loglik = _matrix(row, "i", p), np.array([row[f"u{i}"] for i in range(p)]), float(row["loglik"])
            try:
                inverse = np.linalg.inv(info)
            except np.linalg.LinAlgError:
                found[key] = math.nan
                continue
            room = 2 * (loglik - wanted + gradient @ inverse @ gradient / 2) / inverse[k, k]
            step = inverse @ (gradient + side * math.sqrt(max(room, 0.0)) * np.eye(p)[k])
            longest = np.max(np.abs(step) / spread)
            step = step * min(1.0, 4 / longest) if longest > 0 else step
            at[key] = at[key] + step
            if longest < tolerance ** 0.5 and abs(loglik - wanted) < tolerance * (1 + abs(wanted)):
                found[key] = float(at[key][k])
    out = []
    for k, name in enumerate(fit.names):
        ends = [found.get((k, side), math.nan) for side in (-1, 1)]
        low, high = (None if math.isnan(e) else _exp(e) for e in ends)
        out.append((name, float(beta[k]), _exp(beta[k]), low, high))
    return small_table(spark, out, "term string, coefficient double, ratio double, low double, high double")
