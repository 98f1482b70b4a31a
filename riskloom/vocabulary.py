"""Fixed values and table schemas.

Everything in the first half of this module is a fixed value that results depend on; the second half declares the
column types of the stored tables.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: indicator code -> (pillar, metric name, direction) ------------------------------------------------
# direction +1: a higher value is better, -1: a higher value is worse

INDICATORS: dict[str, tuple[str, str, int]] = {
    "GOV_WGI_GE.EST": ("governance", "Government Effectiveness (estimate)", 1),
    "GOV_WGI_RL.EST": ("governance", "Rule of Law (estimate)", 1),
    "GOV_WGI_CC.EST": ("governance", "Control of Corruption (estimate)", 1),
    "GOV_WGI_PV.EST": ("governance", "Political Stability / Absence of Violence (estimate)", 1),
    "SI.POV.DDAY": ("social", "Poverty headcount ratio at $2.15/day (%)", -1),
    "EG.ELC.ACCS.ZS": ("social", "Access to electricity (% of population)", 1),
    "SP.DYN.LE00.IN": ("social", "Life expectancy at birth (years)", 1),
    "SE.SEC.ENRR": ("social", "School enrollment, secondary (% gross)", 1),
    "EN.ATM.CO2E.PC": ("environmental", "CO2 emissions (metric tons per capita)", -1),
    "EN.GHG.CO2.PC.CE.AR5": ("environmental", "CO2 emissions per capita (AR5)", -1),
    "AG.LND.FRST.ZS": ("environmental", "Forest area (% of land area)", 1),
    "EG.FEC.RNEW.ZS": ("environmental", "Renewable energy consumption (% of total)", 1),
    "EN.ATM.PM25.MC.M3": ("environmental", "PM2.5 air pollution, mean annual exposure", -1),
}

PILLARS = ("environmental", "social", "governance")

# --- fixed values: the outcome words that count as success -----------------------------------------------------------

SUCCESS_OUTCOMES = ("highly satisfactory", "satisfactory", "moderately satisfactory")

# --- fixed values: the region that marks a row of the country list as a regional or income-group total ---------------

AGGREGATE_REGION = "Aggregates"

# --- fixed values: accepted column names per field, first present wins -----------------------------------------------

LOAN_FIELDS: dict[str, tuple[str, ...]] = {
    "loan_id": ("loan_number", "credit_number", "id"),
    "country": ("country", "country_economy", "borrower_country"),
    "approval": ("board_approval_date", "agreement_signing_date"),
    "principal": ("original_principal_amount", "original_principal_amount_us_", "original_principal_amount_us"),
    "disbursed": ("disbursed_amount", "disbursed_amount_us_", "disbursed_amount_us"),
}

RATING_FIELDS: dict[str, tuple[str, ...]] = {
    "project_id": ("project_id", "proj_id"),
    "country": ("country", "country_economy"),
    "outcome": ("ieg_outcome", "outcome", "ieg_outcome_rating"),
    "sector": ("sector_board", "global_practice", "sector", "agreement_type", "practice_group"),
    "closing": (
        "exit_fy", "closing_fy", "final_closing_fy", "evaluation_fy", "exit_fiscal_year", "closing_date",
    ),
}

# --- fixed values: country spellings with a known canonical key ------------------------------------------------------

COUNTRY_ALIASES: dict[str, str] = {
    "egypt, arab republic of": "egypt, arab rep.",
    "yemen, republic of": "yemen, rep.",
    "venezuela, republica bolivariana de": "venezuela, rb",
    "iran, islamic republic of": "iran, islamic rep.",
    "korea, republic of": "korea, rep.",
    "congo, democratic republic of": "congo, dem. rep.",
    "congo, republic of": "congo, rep.",
    "cote d'ivoire": "cote d'ivoire",
    "lao people's democratic republic": "lao pdr",
    "macedonia, former yugoslav republic of": "north macedonia",
    "turkiye": "turkiye",
    "turkey": "turkiye",
    "viet nam": "vietnam",
}

# --- fixed values: thresholds ----------------------------------------------------------------------------------------

MATCH_THRESHOLD = 85.0
RISK_BINS: tuple[tuple[str, float, float], ...] = (
    ("Low (0–33)", 0.0, 33.0),
    ("Medium (34–66)", 33.0, 66.0),
    ("High (67–100)", 66.0, 100.0),
)
GAP_RISK = 40.0
GAP_PANEL_RISK = 35.0
TREND_CUTOFF = 0.5
MIN_TREND_POINTS = 3
MIN_PAIRED_ROWS = 5
QUADRANT_SPLIT = 50.0
SIGNIFICANCE = 0.05

# --- table schemas ---------------------------------------------------------------------------------------------------


_TYPES = {"string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType()}


def _schema(columns: str) -> T.StructType:
    """Schema of ``name type, name type, ...``; unlike a DDL string it needs no running session."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


COUNTRIES = _schema("iso3 string, iso2 string, country string, region string, income_level string")
ESG = _schema("iso3 string, country string, year int, indicator string, value double, pillar string")
LOANS = _schema(
    "loan_id string, country string, fiscal_year int, commitment_amount double, disbursement_amount double, "
    "source string"
)
RATINGS = _schema(
    "project_id string, country string, outcome_rating string, sector string, closing_year int, is_successful int"
)
AGGREGATE_ESG = _schema(
    "iso3 string, country string, year int, environmental_score double, governance_score double, "
    "social_score double, esg_score double, esg_risk_score double"
)
AGGREGATE_LOANS = _schema(
    "country string, fiscal_year int, commitment_amount double, disbursement_amount double, n_loans bigint, "
    "lending_amount double"
)
AGGREGATE_RATINGS = _schema("country string, year int, projects_evaluated bigint, success_rate double")
MASTER = _schema(
    "iso3 string, country string, year int, environmental_score double, governance_score double, "
    "social_score double, esg_score double, esg_risk_score double, lending_amount double, "
    "commitment_amount double, disbursement_amount double, projects_evaluated bigint, success_rate double"
)

ANALYSIS_COLUMNS = (
    "iso3", "country", "year", "environmental_score", "social_score", "governance_score", "esg_score",
    "esg_risk_score", "lending_amount", "commitment_amount", "disbursement_amount", "exposure_score",
    "priority_score", "projects_evaluated", "success_rate",
)
SCORE_COLUMNS = ("environmental_score", "social_score", "governance_score")
COVERAGE_COLUMNS = SCORE_COLUMNS + ("esg_score", "esg_risk_score", "lending_amount", "success_rate")

BRONZE_KEYS: dict[str, tuple[str, ...]] = {
    "esg": ("iso3", "year", "indicator"),
    "loans": ("loan_id",),
    "loans_without_id": ("country", "fiscal_year", "source"),
    "ratings": ("project_id",),
}
