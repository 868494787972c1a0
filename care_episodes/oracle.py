"""Reference SQL for the registered queries, for a second engine on the same tables.

The statements work record by record and pair by pair, without the per-day counting and the
block arithmetic of the operators, so that they check those too.  `VIEWS` holds named
sub-queries; `statement` puts the ones a query needs in front of it.
"""

from __future__ import annotations

import re

from care_episodes import testmap as tm
from care_episodes.functions import fixed_values as fv
from care_episodes.functions.rules import MAX_TERM, SPACING

VIEWS: dict[str, str] = {}
QUERIES: dict[str, str] = {}


def _literal(value) -> str:
    if value is None:
        return "NULL"
    return f"'{value}'" if isinstance(value, str) else str(value)


def _values(rows, columns: str) -> str:
    body = ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in rows)
    return f"SELECT * FROM (VALUES {body}) AS t({columns})"


def _strings(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _case(column: str, table: dict, otherwise: str = "NULL") -> str:
    whens = " ".join(f"WHEN {_literal(k)} THEN {_literal(v)}" for k, v in table.items())
    return f"CASE {column} {whens} ELSE {otherwise} END"


def statement(sql: str) -> str:
    """The query with every view it needs, in order of definition."""
    names = list(VIEWS)
    needed: set[str] = set()
    todo = [sql]
    while todo:
        words = set(re.findall(r"[a-z_0-9]+", todo.pop()))
        for name in names:
            if name in words and name not in needed:
                needed.add(name)
                todo.append(VIEWS[name])
    ctes = ",\n".join(f"{n} AS MATERIALIZED ({VIEWS[n]})" for n in names if n in needed)
    return f"WITH {ctes}\n{sql}" if ctes else sql


RANK = _case("{0}", {c: i for i, c in enumerate(fv.OUTCOME_CHOICE_ORDER, 1)}, "8")
AS_OF = f"DATE '{tm.AS_OF}'"
V = VIEWS

# ---- clinical views -------------------------------------------------------------------------
V["outcome_concepts"] = (
    "SELECT concept_id::BIGINT concept_id, concept_name, domain_name, category, gest_value::DOUBLE gest_value FROM ("
    + _values(tm.OUTCOME_ROWS, "concept_id, concept_name, domain_name, category, gest_value") + ")"
)
V["timing_concepts"] = (
    "SELECT concept_id::BIGINT concept_id, concept_name, min_month::DOUBLE min_month, max_month::DOUBLE max_month FROM ("
    + _values([r[:4] for r in tm.TIMING_ROWS], "concept_id, concept_name, min_month, max_month") + ")"
)
V["person"] = """
SELECT c_custkey person_id, CASE WHEN c_mktsegment = 'MACHINERY' THEN 0 ELSE 8532 END gender_concept_id,
  (1940 + c_custkey % 50)::INT year_of_birth,
  CASE WHEN c_custkey % 10 <> 0 THEN (1 + c_custkey % 12)::INT END month_of_birth,
  (1 + c_custkey % 28)::INT day_of_birth,
  CASE WHEN c_custkey % 7 <> 0 THEN c_nationkey::INT END race_concept_id,
  NULL::INT ethnicity_concept_id
FROM customer"""
V["condition_occurrence"] = """
SELECT o_custkey person_id, 1000 + o_orderkey % 20 condition_concept_id, o_orderdate::DATE condition_start_date
FROM orders"""
V["lines"] = "SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey"
V["procedure_occurrence"] = """
SELECT o_custkey person_id, (CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 AND l_partkey % 5 = 0 THEN 1050 ELSE 0 END)::BIGINT procedure_concept_id,
  l_shipdate::DATE procedure_date FROM lines"""
V["observation"] = """
SELECT o_custkey person_id, (CASE WHEN l_linenumber = 1 AND l_orderkey % 4 = 0 THEN 2000 + l_partkey % 12 ELSE 0 END)::BIGINT observation_concept_id,
  l_shipdate::DATE observation_date, NULL::DOUBLE value_as_number, l_linestatus value_as_string
FROM lines"""
V["measurement"] = """
SELECT o_custkey person_id,
  (CASE l_partkey % 10 WHEN 0 THEN 3048230 WHEN 1 THEN 3025315 WHEN 2 THEN 3036277 ELSE 0 END)::BIGINT measurement_concept_id,
  l_shipdate::DATE measurement_date,
  CASE l_partkey % 10 WHEN 1 THEN l_quantity + 45 WHEN 2 THEN l_quantity * 3 + 80 ELSE l_quantity END value_as_number,
  l_suppkey value_as_concept_id
FROM lines"""
V["observation_period"] = """
SELECT o_custkey person_id, min(o_orderdate::DATE) observation_period_start_date,
  max(o_orderdate::DATE) observation_period_end_date FROM orders GROUP BY 1"""
V["visit_occurrence"] = """
SELECT o_custkey person_id, (9200 + substr(o_orderpriority, 1, 1)::INT)::BIGINT visit_concept_id,
  o_orderdate::DATE visit_start_date FROM orders"""
V["concept"] = """
SELECT p_partkey concept_id, 'C' || (p_partkey % 40)::VARCHAR concept_code, p_name concept_name,
  CASE WHEN p_size % 2 = 0 THEN 'ICD10CM' ELSE 'SNOMED' END vocabulary_id,
  CASE WHEN p_size % 3 = 0 THEN 'Condition' ELSE 'Procedure' END domain_id FROM part"""
V["concept_relationship"] = """
SELECT p_partkey concept_id_1, (p_partkey * 7) % 1999 concept_id_2,
  CASE WHEN p_partkey % 3 = 0 THEN 'Is a' ELSE 'Maps to' END relationship_id FROM part"""
V["concept_ancestor"] = """
SELECT 1000 + p_partkey % 20 ancestor_concept_id, (1000 + p_size % 20)::BIGINT descendant_concept_id FROM part"""
V["persons"] = f"""
SELECT DISTINCT person_id, gender_concept_id, year_of_birth, month_of_birth, day_of_birth, race_concept_id,
  ethnicity_concept_id, 2001 - year_of_birth age_current
FROM person WHERE gender_concept_id IN (8532, 8507, 45878463) AND year_of_birth >= 2001 - 56 AND year_of_birth <= 2001 - 15"""
V["source_events"] = """
SELECT person_id, condition_concept_id concept_id, condition_start_date event_date, 'Condition' AS domain, 1 domain_rank,
  NULL::DOUBLE value_as_number, NULL::VARCHAR value_as_string FROM condition_occurrence
UNION ALL SELECT person_id, procedure_concept_id, procedure_date, 'Procedure', 2, NULL, NULL FROM procedure_occurrence
UNION ALL SELECT person_id, observation_concept_id, observation_date, 'Observation', 3, value_as_number, value_as_string FROM observation
UNION ALL SELECT person_id, measurement_concept_id, measurement_date, 'Measurement', 4, value_as_number, value_as_concept_id::VARCHAR FROM measurement"""
V["ev"] = """
SELECT e.person_id, e.concept_id, e.event_date, e.domain, e.domain_rank, c.concept_name, c.category, c.gest_value,
  e.value_as_number, e.value_as_string
FROM source_events e JOIN outcome_concepts c ON e.concept_id = c.concept_id AND e.domain = c.domain_name
WHERE e.event_date IS NOT NULL AND e.person_id IN (SELECT person_id FROM persons)"""
V["timing"] = """
SELECT e.person_id, e.concept_id, e.event_date, e.domain AS domain_name, e.value_as_number, e.value_as_string,
  trunc(c.min_month) min_month, trunc(c.max_month) max_month
FROM source_events e JOIN timing_concepts c ON e.concept_id = c.concept_id
WHERE e.domain <> 'Measurement' AND e.event_date IS NOT NULL AND e.person_id IN (SELECT person_id FROM persons)"""

# ---- outcome episodes -----------------------------------------------------------------------
STEP = {"LB": 1, "SB": 2, "ECT": 3, "AB": 4, "SA": 4, "DELIV": 5}
STEP_DAYS = {1: SPACING["LB", "LB"], 2: SPACING["SB", "SB"], 3: SPACING["ECT", "ECT"],
             4: min(SPACING["AB", "SA"], SPACING["SA", "AB"]), 5: SPACING["DELIV", "DELIV"]}
V["outcome_gaps"] = f"""
SELECT *, event_date - lag(event_date) OVER w AS gap, row_number() OVER w AS rn FROM
  (SELECT *, {_case('category', STEP)} AS step FROM ev WHERE category IN ({_strings(STEP)}))
WINDOW w AS (PARTITION BY person_id, step ORDER BY event_date, domain_rank, concept_id, value_as_number NULLS FIRST, category)"""
V["outcome_marked"] = f"""
SELECT *, sum(CASE WHEN gap IS NULL OR gap >= {_case('step', STEP_DAYS)} THEN 1 ELSE 0 END)
  OVER (PARTITION BY person_id, step ORDER BY rn) AS session FROM outcome_gaps"""
V["sessions"] = """
SELECT person_id, step, session::INT AS session, max(event_date) outcome_date, arg_min(category, rn) outcome_category,
  count(*) n_visits FROM outcome_marked GROUP BY 1, 2, 3"""


def _blocks(side: str, gap: str, limits: dict[str, int]) -> tuple[str, str]:
    blocks = f"coalesce({side} IN ({_strings(limits)}), false)"
    far = " OR ".join(f"({side} = '{c}' AND {gap} >= {d})" for c, d in limits.items())
    return blocks, f"coalesce({far}, false)"


def _general_rule(before: dict[str, int], after: dict[str, int]) -> str:
    pb, pf = _blocks("prev_cat", "prev_gap", before)
    nb, nf = _blocks("next_cat", "next_gap", after)
    return (
        f"((NOT {pb} AND NOT {nb}) OR ({pf} AND next_cat IS NULL) OR ({nf} AND prev_cat IS NULL) OR ({pf} AND {nf}))"
    )


def _ectopic_rule() -> str:
    before = min(SPACING["LB", "ECT"], SPACING["SB", "ECT"])
    after = min(SPACING["ECT", "LB"], SPACING["ECT", "SB"])
    return (
        f"(prev_cat IS NULL OR next_cat IS NULL OR prev_gap >= {before} OR next_gap >= {after}"
        " OR (prev_cat NOT IN ('LB', 'SB') AND next_cat NOT IN ('LB', 'SB')))"
    )


RULES = {
    2: _general_rule({"LB": 168}, {"LB": 182}),
    3: _ectopic_rule(),
    4: _general_rule({"LB": 70, "SB": 70, "ECT": 56}, {"LB": 168, "SB": 154, "ECT": 56}),
    5: _general_rule(
        {"LB": 168, "SB": 168, "ECT": 154, "AB": 154, "SA": 154},
        {"LB": 182, "SB": 168, "ECT": 70, "AB": 70, "SA": 70},
    ),
}
V["kept1"] = "SELECT * FROM sessions WHERE step = 1"
for _s in (2, 3, 4, 5):
    V[f"near{_s}"] = f"""
SELECT *, lag(outcome_category) OVER w prev_cat, lead(outcome_category) OVER w next_cat,
  outcome_date - lag(outcome_date) OVER w prev_gap, lead(outcome_date) OVER w - outcome_date next_gap
FROM (SELECT * FROM kept{_s - 1} UNION ALL SELECT * FROM sessions WHERE step = {_s})
WINDOW w AS (PARTITION BY person_id ORDER BY outcome_date, step, session)"""
    V[f"kept{_s}"] = (
        f"SELECT person_id, step, session, outcome_date, outcome_category, n_visits FROM near{_s} "
        f"WHERE step < {_s} OR {RULES[_s]}"
    )
V["outcomes"] = f"""
SELECT person_id, outcome_date, outcome_category, n_visits,
  row_number() OVER (PARTITION BY person_id ORDER BY outcome_date, {RANK.format('outcome_category')}, n_visits)::INT episode_number
FROM kept5"""
V["gest"] = f"""
SELECT *, coalesce(gest_value, value_as_number) AS weeks FROM ev
WHERE gest_value IS NOT NULL OR category = 'GEST' OR concept_id IN ({', '.join(map(str, fv.WEEK_CONCEPTS))})
  OR concept_name ILIKE '%gestation%'"""
V["with_gest"] = """
SELECT o.person_id, o.episode_number, o.outcome_date, o.outcome_category, o.n_visits,
  max(g.weeks) gestational_weeks, nullif(count(g.person_id), 0) n_gest_records
FROM outcomes o LEFT JOIN gest g ON o.person_id = g.person_id AND g.event_date BETWEEN o.outcome_date - 280 AND o.outcome_date
GROUP BY ALL"""
V["gest_steps"] = """
SELECT *, weeks - lag(weeks) OVER w gained, event_date - lag(event_date) OVER w passed, row_number() OVER w rn
FROM gest WHERE weeks > 0 AND weeks <= 44
WINDOW w AS (PARTITION BY person_id ORDER BY event_date, domain_rank, concept_id, weeks)"""
V["gest_marked"] = """
SELECT *, sum(CASE WHEN gained IS NULL OR gained <= 0 OR passed > 70 OR passed > gained * 7 + 28 THEN 1 ELSE 0 END)
  OVER (PARTITION BY person_id ORDER BY rn) AS grp FROM gest_steps"""
V["gest_only"] = """
SELECT person_id, epoch_day(max(event_date)) + (40 - max(weeks)) * 7 AS outcome_day, max(weeks) gestational_weeks,
  count(*) n_gest_records FROM gest_marked GROUP BY person_id, grp"""
V["all_episodes"] = f"""
SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY outcome_day, {RANK.format('outcome_category')},
    gestational_weeks NULLS FIRST, n_gest_records NULLS FIRST)::INT episode_number FROM (
  SELECT person_id, epoch_day(outcome_date)::DOUBLE outcome_day, outcome_category, gestational_weeks, n_gest_records FROM with_gest
  UNION ALL
  SELECT person_id, outcome_day, 'PREG', gestational_weeks, n_gest_records FROM gest_only g
  WHERE NOT EXISTS (SELECT 1 FROM with_gest o WHERE o.person_id = g.person_id AND epoch_day(o.outcome_date) = g.outcome_day))"""
V["started"] = f"""
SELECT *, outcome_day - ga start_day, outcome_day end_day FROM (
  SELECT *, coalesce(gestational_weeks * 7, {_case('outcome_category', MAX_TERM, '280')})::DOUBLE ga FROM all_episodes)"""
V["hip"] = f"""
SELECT person_id, episode_number, day_date(floor(start_new)) episode_start_date, day_date(floor(end_day)) episode_end_date,
  outcome_category, end_day - start_new gestational_age_days, 'HIP' AS algorithm_used FROM (
  SELECT *, CASE WHEN prev_end >= start_day THEN prev_end + 1 ELSE start_day END start_new FROM (
    SELECT *, lag(end_day) OVER (PARTITION BY person_id ORDER BY start_day, end_day, episode_number) prev_end
    FROM started WHERE ga BETWEEN 0 AND 320 AND start_day <= epoch_day({AS_OF}) AND end_day >= start_day))
WHERE end_day - start_new > 0"""

# ---- progression episodes -------------------------------------------------------------------
V["aged"] = """
SELECT t.*, (event_date - make_date(year_of_birth, coalesce(month_of_birth, 1), coalesce(day_of_birth, 1))) / 365.25 age_at_event
FROM timing t JOIN persons USING (person_id)"""
V["eligible"] = "SELECT * FROM aged WHERE age_at_event >= 15 AND age_at_event < 56"
V["numbered"] = """
SELECT *, row_number() OVER w rid, event_date - lag(event_date) OVER w gap FROM eligible
WINDOW w AS (PARTITION BY person_id ORDER BY event_date, min_month, max_month, concept_id)"""
V["recs"] = """
SELECT *, sum(CASE WHEN gap IS NULL OR gap > 30 THEN 1 ELSE 0 END) OVER (PARTITION BY person_id ORDER BY rid)::INT run FROM numbered"""
V["compatible"] = """
SELECT a.person_id, a.rid s, b.rid e, a.run s_run, b.run e_run FROM recs a JOIN recs b
ON a.person_id = b.person_id AND a.rid < b.rid
  AND b.max_month - a.min_month + 2 >= (b.event_date - a.event_date) / 30.0
  AND (b.event_date - a.event_date) / 30.0 >= b.min_month - a.max_month - 2"""
V["agreeing"] = """
SELECT r.*, EXISTS (SELECT 1 FROM compatible c WHERE c.person_id = r.person_id AND c.s < r.rid AND c.e >= r.rid) agrees FROM recs r"""
V["assigned"] = """
SELECT *, sum(CASE WHEN gap IS NULL OR (NOT agrees AND gap > 30) OR gap > 300 THEN 1 ELSE 0 END)
  OVER (PARTITION BY person_id ORDER BY rid)::INT raw_episode FROM agreeing"""
V["short_episodes"] = """
SELECT *, dense_rank() OVER (PARTITION BY person_id ORDER BY raw_episode)::INT person_episode_number FROM (
  SELECT *, max(event_date) OVER w - min(event_date) OVER w length FROM assigned WINDOW w AS (PARTITION BY person_id, raw_episode))
WHERE length <= 360"""
V["bounds"] = """
SELECT person_id, person_episode_number, min(event_date) min_date, max(event_date) max_date, min(min_month) earliest_month,
  max(max_month) latest_month, count(DISTINCT concept_id)::INT n_gt_concepts, count(*) n_records,
  epoch_day(max(event_date)) + (10 - max(max_month)) * 30 expected_end_day FROM short_episodes GROUP BY 1, 2"""
V["bound_windows"] = """
SELECT *, epoch_day(max_date) - 14 AS low, least(epoch_day(next_min) - 1, expected_end_day) AS high FROM (
  SELECT *, lead(min_date) OVER (PARTITION BY person_id ORDER BY person_episode_number) next_min FROM bounds)"""
V["day_outcomes"] = f"""
SELECT person_id, event_date, category, {RANK.format('category')} outcome_rank FROM ev WHERE category IN ({_strings(fv.OUTCOME_CHOICE_ORDER)})"""
V["progressed"] = """
SELECT b.*, coalesce(o.category, 'PREG') outcome_category, coalesce(epoch_day(o.event_date)::DOUBLE, b.expected_end_day) outcome_day
FROM bound_windows b LEFT JOIN (
  SELECT w.person_id, w.person_episode_number, d.category, d.event_date,
    row_number() OVER (PARTITION BY w.person_id, w.person_episode_number ORDER BY d.outcome_rank, d.event_date) rn
  FROM bound_windows w JOIN day_outcomes d ON w.person_id = d.person_id AND epoch_day(d.event_date) BETWEEN w.low AND w.high) o
ON b.person_id = o.person_id AND b.person_episode_number = o.person_episode_number AND o.rn = 1"""
V["pps"] = f"""
SELECT person_id, row_number() OVER (PARTITION BY person_id ORDER BY person_episode_number)::INT episode_number,
  day_date(floor(start_day)) episode_start_date, day_date(floor(outcome_day)) episode_end_date, outcome_category,
  outcome_day - start_day gestational_age_days, n_gt_concepts, n_records, 'PPS' AS algorithm_used
FROM (SELECT *, epoch_day(min_date) - earliest_month * 30 start_day FROM progressed)
WHERE outcome_day - start_day > 0 AND outcome_day - start_day <= 320 AND start_day <= epoch_day({AS_OF})"""

# ---- merge ----------------------------------------------------------------------------------
for _name in ("hip", "pps"):
    V[f"{_name}_windows"] = f"""
SELECT *, least(episode_start_date, lookback_date) window_start, greatest(episode_end_date, lookahead_date) window_end FROM (
  SELECT *, episode_end_date - 14 lookback_date, day_date(floor(epoch_day(episode_start_date) + gestational_age_days + 30)) expected_end_date,
    least(lead(episode_start_date) OVER (PARTITION BY person_id ORDER BY episode_start_date, episode_end_date, episode_number) - 1,
      day_date(floor(epoch_day(episode_start_date) + gestational_age_days + 30))) lookahead_date
  FROM {_name})"""
V["joined"] = """
SELECT coalesce(h.person_id, p.person_id) person_id, h.episode_number hip_id, h.episode_start_date hip_start,
  h.episode_end_date hip_end, h.outcome_category hip_category, h.gestational_age_days hip_gest_days,
  p.episode_number pps_id, p.episode_start_date pps_start, p.episode_end_date pps_end, p.outcome_category pps_category,
  p.gestational_age_days pps_gest_days
FROM hip h FULL JOIN pps p ON h.person_id = p.person_id AND h.episode_start_date <= p.episode_end_date + 60
  AND h.episode_end_date >= p.episode_start_date"""
V["flagged"] = """
SELECT *, CASE WHEN hip_id IS NOT NULL THEN (count(*) OVER (PARTITION BY person_id, hip_id) > 1)::INT END hip_dup,
  CASE WHEN pps_id IS NOT NULL THEN (count(*) OVER (PARTITION BY person_id, pps_id) > 1)::INT END pps_dup FROM joined"""
V["settled0"] = "SELECT * FROM flagged WHERE coalesce(hip_dup, 0) = 0 AND coalesce(pps_dup, 0) = 0"
V["open0"] = "SELECT * FROM flagged WHERE (hip_dup = 1 OR pps_dup = 1) AND hip_id IS NOT NULL AND pps_id IS NOT NULL"
for _r in range(1, 6):
    V[f"named{_r}"] = f"""
SELECT * EXCLUDE (hip_dup, pps_dup) FROM (SELECT * FROM open{_r - 1} WHERE hip_dup = 1 QUALIFY row_number() OVER (
  PARTITION BY person_id, hip_id ORDER BY abs(hip_end - pps_end),
    CASE WHEN pps_end - pps_start > 310 THEN -1 ELSE abs(pps_end - pps_start) END DESC, pps_id) = 1)
UNION SELECT * EXCLUDE (hip_dup, pps_dup) FROM (SELECT * FROM open{_r - 1} WHERE pps_dup = 1 QUALIFY row_number() OVER (
  PARTITION BY person_id, pps_id ORDER BY abs(hip_end - pps_end),
    CASE WHEN pps_end - pps_start > 310 THEN -1 ELSE abs(pps_end - pps_start) END DESC, hip_id) = 1)"""
    V[f"again{_r}"] = f"""
SELECT *, (count(*) OVER (PARTITION BY person_id, hip_id) > 1)::INT hip_dup,
  (count(*) OVER (PARTITION BY person_id, pps_id) > 1)::INT pps_dup FROM named{_r}"""
    V[f"settled{_r}"] = f"SELECT * FROM again{_r} WHERE hip_dup = 0 AND pps_dup = 0"
    V[f"open{_r}"] = f"SELECT * FROM again{_r} WHERE hip_dup = 1 OR pps_dup = 1"
V["matched_pairs"] = " UNION ALL ".join(
    f"SELECT * EXCLUDE (hip_dup, pps_dup) FROM {n}" for n in [f"settled{i}" for i in range(6)] + ["open5"]
)
V["merged_raw"] = """
SELECT person_id, hip_id, pps_id, least(hip_start, pps_start, hip_end) episode_start_date, greatest(pps_end, hip_end) episode_end_date,
  hip_category hip_outcome, CASE WHEN pps_id IS NOT NULL THEN coalesce(pps_category, 'PREG') END pps_outcome, hip_end, pps_end,
  coalesce(hip_category, pps_category) outcome_category,
  trunc(coalesce((hip_gest_days + pps_gest_days) / 2, hip_gest_days, pps_gest_days)) gestational_age_days,
  CASE WHEN hip_id IS NOT NULL AND pps_id IS NOT NULL THEN 'MERGED' WHEN hip_id IS NOT NULL THEN 'HIP' ELSE 'PPS' END algorithm_used
FROM matched_pairs"""
_NUMBER = """row_number() OVER (PARTITION BY person_id ORDER BY episode_start_date, hip_id NULLS FIRST, pps_id NULLS FIRST)::INT"""


def _finalize(source: str) -> str:
    return f"""
SELECT * EXCLUDE (episode_start_date, gestational_age_days, prev_end, start_new), start_new episode_start_date,
  (episode_end_date - start_new)::DOUBLE gestational_age_days FROM (
  SELECT *, CASE WHEN prev_end >= episode_start_date THEN prev_end + 1 ELSE episode_start_date END start_new FROM (
    SELECT *, {_NUMBER} episode_number,
      lag(episode_end_date) OVER (PARTITION BY person_id ORDER BY episode_start_date, hip_id NULLS FIRST, pps_id NULLS FIRST) prev_end
    FROM {source}))
WHERE episode_end_date - start_new > 0 AND episode_end_date - start_new <= 320"""


V["merged"] = _finalize("merged_raw")
V["side_by_side"] = """
SELECT person_id, episode_number hip_id, NULL::INT pps_id, episode_start_date, episode_end_date, outcome_category hip_outcome,
  NULL::VARCHAR pps_outcome, episode_end_date hip_end, NULL::DATE pps_end, outcome_category, gestational_age_days, 'HIP' algorithm_used,
  lookback_date, lookahead_date FROM hip_windows
UNION ALL SELECT person_id, NULL, episode_number, episode_start_date, episode_end_date, NULL, outcome_category, NULL, episode_end_date,
  outcome_category, gestational_age_days, 'PPS', lookback_date, lookahead_date FROM pps_windows"""
V["window_updated"] = """
SELECT s.* EXCLUDE (outcome_category, episode_end_date, gestational_age_days), coalesce(f.category, s.outcome_category) outcome_category,
  coalesce(f.event_date, s.episode_end_date) episode_end_date,
  (coalesce(f.event_date, s.episode_end_date) - s.episode_start_date)::DOUBLE gestational_age_days
FROM side_by_side s LEFT JOIN (
  SELECT w.person_id, w.hip_id, w.pps_id, d.category, d.event_date, row_number() OVER (
    PARTITION BY w.person_id, w.hip_id, w.pps_id ORDER BY d.outcome_rank, d.event_date) rn
  FROM side_by_side w JOIN day_outcomes d ON w.person_id = d.person_id AND d.event_date BETWEEN w.lookback_date AND w.lookahead_date) f
ON s.person_id = f.person_id AND s.hip_id IS NOT DISTINCT FROM f.hip_id AND s.pps_id IS NOT DISTINCT FROM f.pps_id AND f.rn = 1"""

# ---- dating ---------------------------------------------------------------------------------
V["timed"] = f"""
SELECT e.person_id, e.concept_id, e.event_date, e.concept_name, e.gest_value, e.value_as_number, c.min_month, c.max_month
FROM ev e LEFT JOIN timing_concepts c ON e.concept_id = c.concept_id
WHERE c.concept_id IS NOT NULL OR e.concept_id IN ({', '.join(map(str, fv.TIMING_CONCEPT_IDS))})
  OR e.concept_name ILIKE '%gestation%' OR e.category = 'GEST' OR e.gest_value IS NOT NULL
UNION ALL SELECT person_id, concept_id, event_date, NULL, NULL, value_as_number, min_month, max_month FROM timing"""
V["typed"] = f"""
SELECT * FROM (SELECT *, CASE WHEN concept_name ILIKE '%gestation period,%' OR concept_name ILIKE '%gestational age%'
    OR concept_id IN ({', '.join(map(str, fv.WEEK_CONCEPTS))}) OR gest_value IS NOT NULL THEN 'GW'
  WHEN min_month IS NOT NULL AND max_month IS NOT NULL THEN 'GR3m' END gt_type FROM timed) WHERE gt_type IS NOT NULL"""
V["weeked"] = r"""
SELECT *, CASE WHEN gt_type = 'GW' THEN coalesce(gest_value, CASE WHEN value_as_number < 50 THEN value_as_number END,
  try_cast(nullif(regexp_extract(concept_name, '(\d+) weeks?', 1), '') AS DOUBLE)) END gestational_weeks FROM typed"""
V["implied"] = """
SELECT *, epoch_day(event_date) - gestational_weeks * 7 implied_start,
  CASE WHEN gt_type = 'GR3m' THEN epoch_day(event_date) - max_month * 30 END range_start,
  CASE WHEN gt_type = 'GR3m' THEN epoch_day(event_date) - min_month * 30 END range_end FROM weeked"""
V["ep_timing"] = """
SELECT m.person_id, m.episode_number, i.* EXCLUDE (person_id) FROM implied i JOIN merged m
ON i.person_id = m.person_id AND i.event_date BETWEEN m.episode_start_date - 30 AND m.episode_end_date + 30"""
V["ranges"] = """
SELECT person_id, episode_number, range_start, range_end, row_number() OVER () id FROM ep_timing WHERE range_start IS NOT NULL"""
V["range_overlaps"] = """
SELECT a.person_id, a.episode_number, a.range_start, a.range_end, a.id, count(b.id) AS n_overlaps FROM ranges a LEFT JOIN ranges b
ON a.person_id = b.person_id AND a.episode_number = b.episode_number AND a.id <> b.id
  AND b.range_start <= a.range_end AND b.range_end >= a.range_start GROUP BY ALL"""
V["range_kept"] = """
SELECT * FROM (SELECT *, quantile_cont(n_overlaps, 0.25) OVER w q1, quantile_cont(n_overlaps, 0.75) OVER w q3
  FROM range_overlaps WINDOW w AS (PARTITION BY person_id, episode_number))
WHERE n_overlaps >= greatest(0, q1 - 1.5 * (q3 - q1))"""
V["consensus"] = """
SELECT person_id, episode_number,
  CASE WHEN max(range_start) <= min(range_end) THEN max(range_start) ELSE min(struct_pack(a := range_start, b := range_end)).a END consensus_start,
  CASE WHEN max(range_start) <= min(range_end) THEN min(range_end) ELSE min(struct_pack(a := range_start, b := range_end)).b END consensus_end
FROM range_kept GROUP BY 1, 2"""
V["gw"] = "SELECT person_id, episode_number, implied_start FROM ep_timing WHERE implied_start IS NOT NULL AND range_start IS NULL"
V["gw_dist"] = """
SELECT *, abs(implied_start - mid) dist FROM (SELECT *, median(implied_start) OVER (PARTITION BY person_id, episode_number) mid,
  count(*) OVER (PARTITION BY person_id, episode_number) n_all FROM gw)"""
V["gw_clean"] = """
SELECT person_id, episode_number, implied_start FROM (
  SELECT *, quantile_cont(dist, 0.25) OVER w q1, quantile_cont(dist, 0.75) OVER w q3 FROM gw_dist WINDOW w AS (PARTITION BY person_id, episode_number))
WHERE n_all <= 1 OR (dist >= q1 - 1.5 * (q3 - q1) AND dist <= q3 + 1.5 * (q3 - q1))"""
V["refined"] = """
SELECT person_id, episode_number,
  CASE WHEN use_inside THEN median_inside ELSE median_all END inferred_start,
  CASE WHEN NOT has_consensus AND total = 1 THEN -1 WHEN use_inside THEN spread_inside ELSE spread_all END::DOUBLE precision_days
FROM (SELECT *, has_consensus AND n_inside / total > 0.5 use_inside FROM (
  SELECT g.person_id, g.episode_number, count(*) total, count(*) FILTER (inside) n_inside, bool_or(consensus_start IS NOT NULL) has_consensus,
    median(implied_start) median_all, max(implied_start) - min(implied_start) spread_all,
    median(implied_start) FILTER (inside) median_inside,
    max(implied_start) FILTER (inside) - min(implied_start) FILTER (inside) spread_inside
  FROM (SELECT g.*, c.consensus_start, coalesce(implied_start BETWEEN consensus_start AND consensus_end, false) inside
    FROM gw_clean g LEFT JOIN consensus c USING (person_id, episode_number)) g GROUP BY 1, 2))"""
PRECISION = """CASE WHEN precision_days IS NULL OR precision_days = 999 THEN 'non-specific' WHEN precision_days = -1 THEN 'week_poor-support'
  WHEN precision_days BETWEEN 0 AND 7 THEN 'week' WHEN precision_days > 7 AND precision_days <= 14 THEN 'two-week'
  WHEN precision_days > 14 AND precision_days <= 21 THEN 'three-week' WHEN precision_days > 21 AND precision_days <= 28 THEN 'month'
  WHEN precision_days > 28 AND precision_days <= 56 THEN 'two-month' WHEN precision_days > 56 AND precision_days <= 84 THEN 'three-month'
  ELSE 'non-specific' END"""
V["dated"] = f"""
SELECT *, {PRECISION} precision_category FROM (
  SELECT m.* EXCLUDE (episode_start_date, gestational_age_days), m.episode_start_date recorded_start,
    coalesce(day_date(floor(r.inferred_start)), m.episode_start_date) episode_start_date,
    coalesce(epoch_day(m.episode_end_date) - r.inferred_start, m.gestational_age_days) gestational_age_days,
    coalesce(r.precision_days, 999)::DOUBLE precision_days
  FROM merged m LEFT JOIN refined r USING (person_id, episode_number))"""
V["final"] = """
SELECT * EXCLUDE (episode_end_date), CASE WHEN (year(episode_start_date) > 1970 AND year(episode_end_date) < 1960)
    OR episode_end_date < episode_start_date OR abs((episode_end_date - episode_start_date) - gestational_age_days) > 1000
  THEN episode_end_date + 25569 ELSE episode_end_date END episode_end_date FROM dated"""

# ---- study tables ---------------------------------------------------------------------------
V["study_eps"] = f"""
SELECT o_custkey person_id, o_orderkey episode_id, o_orderdate::DATE - (100 + o_orderkey % 230)::INT inferred_episode_start,
  o_orderdate::DATE inferred_episode_end, (100 + o_orderkey % 230)::INT gestational_age_days,
  {_case('(o_orderkey % 20)', dict(enumerate(tm.OUTCOME_OF_ORDER)))} final_outcome_category,
  {_case('(o_orderkey % 8)', dict(enumerate(tm.PRECISION_OF_ORDER)))} precision_category,
  (o_orderkey % 3)::INT outcome_concordance_score, ((100 + o_orderkey % 230) < 259)::INT preterm FROM orders"""
V["spacing_rules"] = _values(fv.SPACING, "first_preg_category, outcome_preg_category, min_days")
V["lookup_spacing"] = _values(
    [(a, b, fv.LOOKUP_SPACING_CHANGES.get((a, b), d)) for a, b, d in fv.SPACING],
    "first_preg_category, outcome_preg_category, min_days",
)
V["lookup_terms"] = _values(fv.LOOKUP_TERMS, "category, min_term, max_term")


def _inline_helpers(sql: str) -> str:
    """epoch_day(x) and day_date(x) written out (they stand for day number <-> date)."""
    for name, form in (("epoch_day", "({0} - DATE '1970-01-01')"), ("day_date", "(DATE '1970-01-01' + ({0})::INT)")):
        while (at := sql.find(name + "(")) >= 0:
            depth, i = 0, at + len(name)
            for i in range(at + len(name), len(sql)):
                depth += (sql[i] == "(") - (sql[i] == ")")
                if depth == 0:
                    break
            inner = sql[at + len(name) + 1 : i]
            sql = sql[:at] + form.format(inner) + sql[i + 1 :]
    return sql


def oracle_sql() -> dict[str, str]:
    return {name: _inline_helpers(statement(sql)) for name, sql in QUERIES.items()}
