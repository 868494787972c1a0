"""Fixed values of the study: answer codes and their categories."""

# Answers that mean no answer was given.
SKIPPED_ANSWERS = ("PreferNotToAnswer", "DontKnow")
NO_ANSWER = (
    "No answer", "I prefer not to answer", "None Indicated", "Prefer Not to Answer", "Prefer Not To Answer",
    "PreferNotToAnswer", "Skip", "DontKnow", "PMI: Skip", "PMI: Prefer Not To Answer", "PMI: Dont Know",
    "Race Ethnicity None Of These", "No matching concept",
)
# Race and ethnicity categories.
RACE = {
    "Black": "Black or African-American",
    "Hispanic": "Hispanic or Latino",
    "Mixed": "More than one race",
    "NHPI": "Native Hawaiian or Other Pacific Islander",
    "MENA": "Middle Eastern or North African",
}
# The five categories used in models.
RACE_FIVE = {
    "White": "White",
    "Hispanic or Latino": "Hispanic or Latino",
    "Black or African-American": "Black or African American",
    "Asian": "Asian",
    "Multiple": "Other",
    "Other": "Other",
    "Middle Eastern or North African": "Other",
    "Native Hawaiian or Other Pacific Islander": "Other",
}
# Family income.
INCOME = {
    "less10k": "< 10k", "10k25k": "10-25k", "25k35k": "25-50k", "35k50k": "25-50k", "50k75k": "50-100k",
    "75k100k": "50-100k", "100k150k": "> 100k", "150k200k": "> 100k", "more200k": "> 100k",
}
# Education.
EDUCATION = {
    "NeverAttended": "Less than high school", "OneThroughFour": "Less than high school",
    "FiveThroughEight": "Less than high school", "NineThroughEleven": "Less than high school",
    "TwelveOrGED": "High school graduate", "CollegeOnetoThree": "Some college",
    "CollegeGraduate": "College graduate", "AdvancedDegree": "Advanced degree",
}
# Marital status.
MARITAL_STATUS = {
    "Married": "Married/partnered", "LivingWithPartner": "Married/partnered",
    "Divorced": "Divorced/separated/widowed", "Separated": "Divorced/separated/widowed",
    "Widowed": "Divorced/separated/widowed", "NeverMarried": "Never married",
}
# States and territories.
STATES = {
    "AL": "Alabama", "AK": "Alaska", "AZ": "Arizona", "AR": "Arkansas", "CA": "California", "CO": "Colorado",
    "CT": "Connecticut", "DE": "Delaware", "FL": "Florida", "GA": "Georgia", "HI": "Hawaii", "ID": "Idaho",
    "IL": "Illinois", "IN": "Indiana", "IA": "Iowa", "KS": "Kansas", "KY": "Kentucky", "LA": "Louisiana",
    "ME": "Maine", "MD": "Maryland", "MA": "Massachusetts", "MI": "Michigan", "MN": "Minnesota",
    "MS": "Mississippi", "MO": "Missouri", "MT": "Montana", "NE": "Nebraska", "NV": "Nevada",
    "NH": "New Hampshire", "NJ": "New Jersey", "NM": "New Mexico", "NY": "New York", "NC": "North Carolina",
    "ND": "North Dakota", "OH": "Ohio", "OK": "Oklahoma", "OR": "Oregon", "PA": "Pennsylvania",
    "RI": "Rhode Island", "SC": "South Carolina", "SD": "South Dakota", "TN": "Tennessee", "TX": "Texas",
    "UT": "Utah", "VT": "Vermont", "VA": "Virginia", "WA": "Washington", "WV": "West Virginia",
    "WI": "Wisconsin", "WY": "Wyoming", "DC": "District of Columbia", "PR": "Puerto Rico",
    "AS": "American Samoa", "MP": "Northern Mariana Islands", "MH": "Marshall Islands", "PW": "Palau",
    "FM": "Federated States of Micronesia",
}

# Labels of outcomes in tables; induced and spontaneous abortions share one.
OUTCOME_LABELS = {
    "LB": "Live birth", "PREG": "Missing outcome", "DELIV": "Delivery record only", "AB": "Abortion", "SA": "Abortion",
    "SB": "Stillbirth", "ECT": "Ectopic pregnancy",
}

# Survey columns taken over as they are but for non-answers, and the columns made of them (names as delivered).
PLAIN_ANSWERS = {
    "insurance_insurnaceaccepted": "insurance_accepted_cat",
    "insurance_healthcarecoverage": "health_coverage_cat",
    "healthadvice_placeforhealthadvice": "advice_place_cat",
    "healthadvice_whatkindofplace": "advice_kind_cat",
}
