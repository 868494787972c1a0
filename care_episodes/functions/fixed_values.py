"""Published clinical rule tables and code lists.

Everything here is a fixed value that results depend on.  All tables can be replaced by
files of the user (see `care_episodes.sources.rule_files`).
"""

from __future__ import annotations

# Outcome categories, most definite first, as used to pick one outcome.
OUTCOME_CHOICE_ORDER = ("LB", "SB", "DELIV", "ECT", "AB", "SA", "PREG")
# Outcome categories in reporting order of the registry comparison.
REPORT_ORDER = ("LB", "SB", "ECT", "AB", "SA", "DELIV", "PREG")
# Domains a concept list is expected to cover.
DOMAINS = ("Condition", "Procedure", "Observation", "Measurement")

# Category, min_term, max_term (days), hierarchy.
TERM_LIMITS = (
    ("LB", 154, 301, 1),
    ("SB", 140, 301, 2),
    ("DELIV", 154, 301, 6),
    ("ECT", 30, 84, 3),
    ("AB", 30, 140, 4),
    ("SA", 30, 140, 5),
    ("PREG", 30, 301, 7),
)

# First category, next category, minimum days between the two outcomes.
SPACING = (
    ("DELIV", "AB", 70),
    ("DELIV", "SA", 70),
    ("SB", "SB", 168),
    ("SB", "DELIV", 168),
    ("ECT", "AB", 56),
    ("ECT", "SA", 56),
    ("DELIV", "DELIV", 168),
    ("DELIV", "ECT", 70),
    ("SB", "ECT", 70),
    ("SB", "AB", 70),
    ("AB", "AB", 56),
    ("AB", "SA", 56),
    ("LB", "AB", 70),
    ("LB", "SA", 70),
    ("SA", "AB", 56),
    ("SA", "SA", 56),
    ("DELIV", "LB", 182),
    ("DELIV", "SB", 168),
    ("ECT", "DELIV", 154),
    ("ECT", "ECT", 56),
    ("AB", "DELIV", 154),
    ("AB", "ECT", 56),
    ("LB", "DELIV", 168),
    ("LB", "ECT", 70),
    ("SA", "DELIV", 154),
    ("SA", "ECT", 56),
    ("ECT", "LB", 168),
    ("ECT", "SB", 154),
    ("AB", "LB", 168),
    ("AB", "SB", 154),
    ("LB", "LB", 182),
    ("LB", "SB", 168),
    ("SA", "LB", 168),
    ("SA", "SB", 154),
    ("SB", "SA", 70),
    ("SB", "LB", 182),
)

# The look-up form of the spacing table, which differs in SB -> SB only.
LOOKUP_SPACING_CHANGES = {("SB", "SB"): 70}

# Category, max_term, min_term, retry (days).
TERM_DURATIONS = (
    ("DELIV", 301, 140, 28),
    ("ECT", 84, 42, 14),
    ("AB", 168, 42, 14),
    ("LB", 301, 161, 28),
    ("SB", 301, 100, 28),
    ("SA", 139, 28, 14),
)

# Category, min_term, max_term (days) of the look-up functions.
LOOKUP_TERMS = (
    ("LB", 161, 301),
    ("SB", 140, 301),
    ("ECT", 42, 84),
    ("AB", 42, 168),
    ("SA", 28, 139),
    ("DELIV", 140, 301),
    ("PREG", 30, 301),
)

# Concepts that state a gestational week.
WEEK_CONCEPTS = (3048230, 3002209, 3012266, 3050433)
# Observations that may state gestational timing.
TIMING_OBSERVATIONS = (
    3011536, 3026070, 3024261, 4260747, 40758410,
    3002549, 43054890, 46234792, 4266763, 40485048,
)
# Measurements that may state gestational timing.
TIMING_MEASUREMENTS = (3036844, 3001105)
# Estimated date of delivery.
DELIVERY_DATE_CONCEPTS = (
    1175623, 3001105, 3011536, 3024261, 3024973, 3026070, 3036322, 3038318,
    3038608, 4059478, 4128833, 40490322, 40760182, 40760183, 42537958,
)
# Estimated date of conception.
CONCEPTION_DATE_CONCEPTS = (3002314, 3043737, 4058439, 4072438, 4089559, 44817092)
# Length of gestation at birth.
GESTATION_LENGTH_CONCEPTS = (4260747, 43054890, 46234792, 4266763, 40485048)

TIMING_CONCEPT_IDS = sorted(
    set(WEEK_CONCEPTS + TIMING_OBSERVATIONS + TIMING_MEASUREMENTS + DELIVERY_DATE_CONCEPTS
        + CONCEPTION_DATE_CONCEPTS + GESTATION_LENGTH_CONCEPTS)
)

# concept_id, min_month, max_month, concept_name of the timing list.
TIMING_CONCEPTS = (
    (3009306, 3.75, 5.5, 'Alpha-1-Fetoprotein [Mass/volume] in Serum or Plasma'),
    (3016670, 3.75, 5.5, 'Alpha-1-Fetoprotein [Multiple of the median] adjusted in Serum or Plasma'),
    (3024370, 3.75, 5.5, 'Alpha-1-Fetoprotein [Multiple of the median] in Serum or Plasma'),
    (2212198, 3.75, 5.5, 'Alpha-fetoprotein (AFP); serum'),
    (2110279, 4.0, 7.0, 'Amniocentesis; diagnostic'),
    (2211763, 4.0, 7.0, 'Doppler echocardiography, fetal, pulsed wave and/or continuous wave with spectral display; complete'),
    (2722250, 4.0, 7.0, 'Echocardiography, fetal, cardiovascular system, real time with image documentation (2D), with or without M-mode recording'),
    (2212323, 3.75, 5.5, 'Estriol'),
    (3025455, 3.75, 5.5, 'Estriol (E3).unconjugated [Mass/volume] in Serum or Plasma'),
    (4062558, 9.0, 11.0, 'False labor at or after 37 completed weeks of gestation'),
    (4239938, 1.0, 4.0, 'First trimester pregnancy'),
    (4322726, 1.0, 3.0, 'Gestation less than 9 weeks'),
    (4242241, 2.5, 2.5, 'Gestation period, 10 weeks'),
    (4174506, 2.75, 2.75, 'Gestation period, 11 weeks'),
    (4197245, 3.0, 3.0, 'Gestation period, 12 weeks'),
    (4266517, 3.25, 3.25, 'Gestation period, 13 weeks'),
    (4248725, 3.5, 3.5, 'Gestation period, 14 weeks'),
    (4283690, 3.75, 3.75, 'Gestation period, 15 weeks'),
    (4049621, 4.0, 4.0, 'Gestation period, 16 weeks'),
    (4277749, 4.25, 4.25, 'Gestation period, 17 weeks'),
    (4097608, 4.5, 4.5, 'Gestation period, 18 weeks'),
    (4181751, 4.75, 4.75, 'Gestation period, 19 weeks'),
    (4051642, 5.0, 5.0, 'Gestation period, 20 weeks'),
    (4185780, 5.25, 5.25, 'Gestation period, 21 weeks'),
    (4274955, 5.5, 5.5, 'Gestation period, 22 weeks'),
    (4336226, 5.75, 5.75, 'Gestation period, 23 weeks'),
    (435640, 6.25, 6.25, 'Gestation period, 25 weeks'),
    (444023, 6.5, 6.5, 'Gestation period, 26 weeks'),
    (432430, 6.75, 6.75, 'Gestation period, 27 weeks'),
    (444461, 7.0, 7.0, 'Gestation period, 28 weeks'),
    (444417, 7.25, 7.25, 'Gestation period, 29 weeks'),
    (434484, 7.5, 7.5, 'Gestation period, 30 weeks'),
    (433864, 7.75, 7.75, 'Gestation period, 31 weeks'),
    (442558, 8.0, 8.0, 'Gestation period, 32 weeks'),
    (441678, 8.25, 8.25, 'Gestation period, 33 weeks'),
    (443874, 8.5, 8.5, 'Gestation period, 34 weeks'),
    (444267, 8.75, 8.75, 'Gestation period, 35 weeks'),
    (438543, 9.0, 9.0, 'Gestation period, 36 weeks'),
    (442355, 9.25, 9.25, 'Gestation period, 37 weeks'),
    (443871, 9.5, 9.5, 'Gestation period, 38 weeks'),
    (435655, 9.75, 9.75, 'Gestation period, 39 weeks'),
    (442769, 10.25, 10.25, 'Gestation period, 41 weeks'),
    (444098, 10.0, 10.0, 'Gestation period, 40 weeks'),
    (444067, 10.5, 10.5, 'Gestation period, 42 weeks'),
    (4132434, 2.0, 2.0, 'Gestation period, 8 weeks'),
    (3014716, 6.0, 8.0, 'Glucose [Mass/volume] in Serum or Plasma --1 hour post 100 g glucose PO'),
    (3016699, 6.0, 8.0, 'Glucose [Mass/volume] in Serum or Plasma --1 hour post 50 g glucose PO'),
    (3010300, 6.0, 9.0, 'Glucose [Mass/volume] in Serum or Plasma --1 hour post dose glucose'),
    (3006717, 6.0, 8.0, 'Glucose [Mass/volume] in Serum or Plasma --2 hours post 100 g glucose PO'),
    (3027457, 6.0, 8.0, 'Glucose [Mass/volume] in Serum or Plasma --3 hours post 100 g glucose PO'),
    (3027198, 6.0, 8.0, 'Glucose [Mass/volume] in Serum or Plasma --3 hours post dose glucose'),
    (2212361, 6.0, 8.0, 'Glucose; post glucose dose (includes glucose)'),
    (2212362, 6.0, 8.0, 'Glucose; tolerance test (GTT), 3 specimens (includes glucose)'),
    (2212363, 6.0, 8.0, 'Glucose; tolerance test, each additional beyond 3 specimens (List separately in addition to code for primary procedure)'),
    (37016152, 8.0, 11.0, 'Group B streptococcus carrier complicating pregnancy'),
    (2213172, 8.0, 11.0, 'Infectious agent detection by nucleic acid (DNA or RNA); Streptococcus, group B, amplified probe technique'),
    (3012620, 3.75, 5.5, 'Inhibin [Mass/volume] in Serum or Plasma'),
    (2212802, 3.75, 5.5, 'Inhibin A'),
    (3035828, 3.75, 5.5, 'Inhibin A [Multiple of the median] in Serum or Plasma'),
    (3048541, 3.75, 5.5, 'Neural tube defect risk [Likelihood] in Fetus'),
    (432695, 9.0, 11.0, 'Post-term pregnancy'),
    (4094910, 1.0, 4.0, 'Pregnancy test positive'),
    (2212538, 1.0, 4.0, 'Progesterone'),
    (3027144, 1.0, 4.0, 'Progesterone [Mass/volume] in Serum or Plasma'),
    (4244438, 3.5, 6.25, 'Second trimester pregnancy'),
    (3049229, 3.75, 5.5, 'Second trimester quad maternal screen [Interpretation] in Serum or Plasma Narrative'),
    (3036000, 8.0, 11.0, 'Streptococcus agalactiae [Presence] in Specimen by Organism specific culture'),
    (43055441, 8.0, 11.0, 'Streptococcus agalactiae [Presence] in Vag+Rectum by Organism specific culture'),
    (3048882, 8.0, 11.0, 'Streptococcus agalactiae DNA [Presence] in Specimen by NAA with probe detection'),
    (3047352, 2.75, 5.5, 'Trisomy 18 risk [Likelihood] in Fetus'),
    (3043238, 2.75, 5.5, 'Trisomy 21 risk [Likelihood] in Fetus'),
    (2211785, 4.0, 7.0, 'Ultrasonic guidance for amniocentesis, imaging supervision and interpretation'),
    (2211751, 4.0, 6.0, 'Ultrasound, pregnant uterus, real time with image documentation, fetal and maternal evaluation plus detailed fetal anatomic examination, transabdominal approach; single or first gestation'),
    (2211747, 2.0, 4.0, 'Ultrasound, pregnant uterus, real time with image documentation, fetal and maternal evaluation, first trimester (< 14 weeks 0 days), transabdominal approach; single or first gestation'),
    (2211753, 2.75, 3.5, 'Ultrasound, pregnant uterus, real time with image documentation, first trimester fetal nuchal translucency measurement, transabdominal or transvaginal approach; single or first gestation'),
    (4084768, 1.0, 3.0, 'Uncertain viability of pregnancy'),
)
