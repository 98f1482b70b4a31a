"""The registered queries as SQL over the same tables, to compare results with another engine."""

from __future__ import annotations


def r(expression: str, digits: int) -> str:
    """Round half to even on the scaled double."""
    return f"(round_even(({expression}) * 1e{digits}, 0) / 1e{digits} + 0e0)"


def rs(expression: str, digits: int) -> str:
    """The same after rounding to nine digits."""
    return r(r(expression, 9), digits)


def fy(date: str) -> str:
    return f"CAST(year({date}) + CASE WHEN month({date}) >= 7 THEN 1 ELSE 0 END AS INTEGER)"


CENTS = "CAST(round_even(({}) * 1e2, 0) AS BIGINT)"

# --- shared tables ---------------------------------------------------------------------------------------------------

COUNTRIES = """countries AS (
  SELECT n_nationkey, 'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS iso3,
         lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS iso2, n_name AS country, r_name AS region
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""

OWNERS = {
    "nation": f"""{COUNTRIES}, owners AS (
  SELECT c_custkey, iso3, country FROM customer JOIN countries ON c_nationkey = n_nationkey)""",
    "customer": """owners AS (
  SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS iso3, c_name AS country FROM customer)""",
}

PILLAR = """CASE WHEN {0} IN ('1-URGENT', '2-HIGH') THEN 'governance' WHEN {0} = '3-MEDIUM' THEN 'social'
  WHEN {0} IN ('4-NOT SPECIFIED', '5-LOW') THEN 'environmental' END"""

ESG = f"""esg AS (
  SELECT iso3, country, {fy('o_orderdate')} AS year, o_orderpriority AS indicator,
         CAST(sum({CENTS.format('o_totalprice')}) AS DOUBLE) / 1e2 / count(*) AS value,
         {PILLAR.format('o_orderpriority')} AS pillar
  FROM orders JOIN owners ON o_custkey = c_custkey GROUP BY ALL)"""

#: Customers are scored by their line items and the years these were shipped in.
ESG_LINES = f"""esg AS (
  SELECT iso3, country, {fy('l_shipdate')} AS year, o_orderpriority AS indicator,
         CAST(sum({CENTS.format('l_extendedprice')}) AS DOUBLE) / 1e2 / count(*) AS value,
         {PILLAR.format('o_orderpriority')} AS pillar
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN owners ON o_custkey = c_custkey GROUP BY ALL)"""


def norm(source: str) -> str:
    return f"""norm AS (
  SELECT f.*, CASE WHEN value IS NULL THEN NULL WHEN hi = lo THEN 5e1
    WHEN indicator IN ('3-MEDIUM', '5-LOW') THEN 1e2 - (value - lo) / (hi - lo) * 1e2
    ELSE (value - lo) / (hi - lo) * 1e2 END AS norm
  FROM {source} f JOIN (SELECT indicator, year, min(value) AS lo, max(value) AS hi FROM {source} GROUP BY ALL)
  USING (indicator, year))"""


MEAN3 = """(coalesce(e, 0e0) + coalesce(s, 0e0) + coalesce(g, 0e0))
  / nullif(CAST(e IS NOT NULL AS INT) + CAST(s IS NOT NULL AS INT) + CAST(g IS NOT NULL AS INT), 0)"""

SCORES = f"""scores AS (
  SELECT iso3, country, year, {rs('e', 1)} AS environmental_score, {rs('g', 1)} AS governance_score,
         {rs('s', 1)} AS social_score, {rs('m', 1)} AS esg_score, {rs('1e2 - m', 1)} AS esg_risk_score
  FROM (SELECT *, {MEAN3} AS m FROM (
    SELECT iso3, country, year, avg(norm) FILTER (pillar = 'environmental') AS e,
           avg(norm) FILTER (pillar = 'social') AS s, avg(norm) FILTER (pillar = 'governance') AS g
    FROM norm GROUP BY ALL)))"""

LOANS = f"""loans AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS loan_id, country, {fy('o_orderdate')} AS fiscal_year,
         o_totalprice AS commitment_amount, disbursed AS disbursement_amount,
         CASE WHEN o_orderstatus = 'F' THEN 'IBRD' ELSE 'IDA' END AS source
  FROM orders JOIN owners ON o_custkey = c_custkey
  LEFT JOIN (SELECT l_orderkey, CAST(sum({CENTS.format('l_extendedprice * (1e0 - l_discount)')}) AS DOUBLE) / 1e2
             AS disbursed FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey)"""


def lending(where: str = "TRUE") -> str:
    return f"""lending AS (
  SELECT country, fiscal_year, coalesce(sum(commitment_amount), 0e0) AS commitment_amount,
         coalesce(sum(disbursement_amount), 0e0) AS disbursement_amount, CAST(count(*) AS BIGINT) AS n_loans,
         coalesce(sum(commitment_amount), 0e0) AS lending_amount
  FROM loans WHERE {where} GROUP BY ALL)"""


OUTCOME = """CASE l_returnflag WHEN 'A' THEN 'Satisfactory' WHEN 'N' THEN 'Moderately Satisfactory'
  WHEN 'R' THEN 'Unsatisfactory' END"""

RATING_COLUMNS = f"""l_orderkey || '-' || l_linenumber AS project_id, country, {OUTCOME} AS outcome_rating,
         l_linestatus AS sector, CAST(year(l_shipdate) AS INTEGER) AS closing_year,
         CASE WHEN l_returnflag IN ('A', 'N') THEN 1 ELSE 0 END AS is_successful"""

RATINGS = {
    "nation": f"""ratings AS (
  SELECT {RATING_COLUMNS}
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN countries ON s_nationkey = n_nationkey)""",
    "customer": f"""ratings AS (
  SELECT {RATING_COLUMNS}
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN owners ON o_custkey = c_custkey)""",
}

SUCCESS = f"""success AS (
  SELECT country, closing_year AS year, CAST(count(*) AS BIGINT) AS projects_evaluated,
         {rs('avg(is_successful) * 1e2', 1)} AS success_rate
  FROM ratings GROUP BY ALL)"""

MASTER = """master AS (
  SELECT s.*, lending_amount, commitment_amount, disbursement_amount, projects_evaluated, success_rate
  FROM scores s LEFT JOIN lending l ON l.country = s.country AND l.fiscal_year = s.year
  LEFT JOIN success u ON u.country = s.country AND u.year = s.year)"""


def base(grain: str) -> str:
    return ",\n".join([OWNERS[grain], ESG if grain == "nation" else ESG_LINES, norm("esg"), SCORES])


def master(grain: str = "customer") -> str:
    return ",\n".join([base(grain), LOANS, lending(), RATINGS[grain], SUCCESS, MASTER])


EXPOSED = f"""exposed AS (
  SELECT *, {r('esg_risk_score / 1e2 * exposure_score', 2)} AS priority_score
  FROM (SELECT *, {rs('lending_amount / nullif((SELECT max(lending_amount) FROM master), 0e0) * 1e2', 1)}
        AS exposure_score FROM master))"""

TREND = f"""CASE WHEN regr_count(esg_risk_score, year) >= 3 AND count(DISTINCT year) > 1
  THEN {rs('regr_slope(esg_risk_score, year)', 3)} END"""

TRENDS = f"""trends AS (SELECT country, {TREND} AS risk_trend FROM scores GROUP BY country)"""

GAP = """CASE WHEN esg_risk_score >= 40 AND (lending_amount IS NULL OR lending_amount = 0) THEN 1 ELSE 0 END"""

BIN = """CASE WHEN esg_risk_score > 0 AND esg_risk_score <= 33 THEN 'Low (0–33)'
  WHEN esg_risk_score > 33 AND esg_risk_score <= 66 THEN 'Medium (34–66)'
  WHEN esg_risk_score > 66 AND esg_risk_score <= 100 THEN 'High (67–100)' END"""

BINS = """(VALUES (0, 'Low (0–33)'), (1, 'Medium (34–66)'), (2, 'High (67–100)')) AS b(bin_id, risk_group)"""

BAND = """CASE WHEN esg_risk_score >= 67 THEN 'high' WHEN esg_risk_score >= 34 THEN 'medium' ELSE 'low' END"""

BUSIEST = "(SELECT year FROM master GROUP BY year ORDER BY count(lending_amount) DESC, year LIMIT 1)"

PAIRED = """paired AS (SELECT esg_risk_score AS x, success_rate AS y FROM master
  WHERE esg_risk_score IS NOT NULL AND success_rate IS NOT NULL)"""

AMOUNTS = ", ".join(
    f"{r(c, 2)} AS {c}" for c in ("lending_amount", "commitment_amount", "disbursement_amount")
)

MASTER_COLUMNS = f"""iso3, country, year, environmental_score, governance_score, social_score, esg_score,
  esg_risk_score, {AMOUNTS}, projects_evaluated, success_rate"""


RANKED = """ranked AS (
  SELECT rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2e0 AS rx,
         rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2e0 AS ry FROM paired)"""
SPEARMAN = f"SELECT CAST(count(*) AS BIGINT) AS n, {r('corr(rx, ry)', 6)} AS rho FROM ranked"

# p-value of a correlation by the finite series of Student's t distribution, whose terms differ for an even and an odd
# number of degrees of freedom; r = sin(theta), 1 - r^2 = cos(theta)^2
P_VALUES = """terms AS (
  SELECT *, sum(CASE WHEN k = 0 THEN 0e0 WHEN n % 2 = 0 THEN ln((2 * k - 1) / (2e0 * k)) ELSE ln(2 * k / (2e0 * k + 1)) END)
    OVER (PARTITION BY test ORDER BY k) AS factor
  FROM (SELECT test, r, n, unnest(range(0, (n - 2) // 2)) AS k FROM tests)),
p_values AS (
  SELECT test, 1 - CASE WHEN any_value(n) % 2 = 0 THEN abs(any_value(r)) * sum(exp(factor + k * ln(1 - r * r)))
    ELSE 2 / pi() * (asin(abs(any_value(r))) + abs(any_value(r)) * sum(exp(factor + (k + 0.5e0) * ln(1 - r * r)))) END AS p
  FROM terms GROUP BY test)"""


ORACLES: dict[str, str] = {}


def add(name: str, sql: str, *tables: str) -> None:
    ORACLES[name] = (f"WITH {', '.join(tables)}\n" if tables else "") + sql


# --- sources ---------------------------------------------------------------------------------------------------------

add(
    "country_envelope",
    "SELECT iso3, iso2, country, region, 'not classified' AS income_level FROM countries WHERE region <> 'AFRICA'",
    COUNTRIES,
)
add(
    "indicator_envelope",
    """SELECT 'C' || o_custkey AS iso3, 'Customer ' || o_custkey AS country,
  CAST(year(o_orderdate) AS INTEGER) AS year, o_orderpriority AS indicator, o_totalprice AS value
FROM orders WHERE o_orderstatus <> 'P'""",
)
add(
    "page_completeness",
    """SELECT o_orderpriority AS indicator, CAST(count(DISTINCT o_orderkey // 1000) AS BIGINT) AS pages_landed,
  CAST(count(DISTINCT o_orderkey // 1000) AS BIGINT) AS pages_announced, TRUE AS complete
FROM orders GROUP BY 1""",
)
add("batch_envelope", "SELECT CAST(o_orderkey AS VARCHAR) AS loan_number, o_totalprice AS principal FROM orders")
add(
    "feed_completeness",
    """SELECT o_orderstatus AS feed, CAST(count(*) AS BIGINT) AS rows_landed, CAST(count(*) AS BIGINT) AS rows_announced,
  TRUE AS complete FROM orders GROUP BY 1""",
)
add("first_non_empty_feed", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
add("csv_round_trip", "SELECT * FROM loans", OWNERS["nation"], LOANS)
add("csv_mixed_headers", "SELECT * FROM loans", OWNERS["nation"], LOANS)

# --- normalisers -----------------------------------------------------------------------------------------------------

NORMALISED_LOAN = f"""CAST(o_orderkey AS VARCHAR) AS loan_id, country, {fy('o_orderdate')} AS fiscal_year,
  CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_totalprice END AS commitment_amount,
  0e0 AS disbursement_amount"""

add(
    "loan_normaliser",
    f"""SELECT {NORMALISED_LOAN}, 'IBRD' AS source
FROM orders JOIN owners ON o_custkey = c_custkey WHERE o_orderpriority <> '5-LOW'""",
    OWNERS["nation"],
)
add(
    "rating_normaliser",
    f"""SELECT l_orderkey || '-' || l_linenumber AS project_id, 'Supplier ' || l_suppkey AS country,
  upper({OUTCOME}) AS outcome_rating, CAST(NULL AS VARCHAR) AS sector,
  CASE WHEN l_returnflag IN ('A', 'N') THEN CAST(year(l_shipdate) AS INTEGER) END AS closing_year,
  CASE WHEN l_returnflag IN ('A', 'N') THEN 1 ELSE 0 END AS is_successful
FROM lineitem""",
)
add(
    "lending_feeds",
    f"""SELECT * FROM (SELECT {NORMALISED_LOAN}, CASE WHEN o_orderstatus = 'F' THEN 'IBRD' ELSE 'IDA' END AS source
FROM orders JOIN owners ON o_custkey = c_custkey WHERE o_orderpriority <> '5-LOW')
WHERE fiscal_year BETWEEN 1994 AND 1997""",
    OWNERS["nation"],
)
add(
    "closing_years",
    """SELECT o_orderkey, TRY_CAST(regexp_extract(CAST(o_orderkey AS VARCHAR), '(\\d{4})', 1) AS INTEGER) AS closing_year
FROM orders""",
)
add(
    "success_flags",
    f"""SELECT {OUTCOME} AS outcome_rating, CASE WHEN l_returnflag IN ('A', 'N') THEN 1 ELSE 0 END AS is_successful,
  CAST(count(*) AS BIGINT) AS n FROM lineitem GROUP BY 1, 2""",
)
add(
    "clean_keys",
    """SELECT lower(p_type) || ' d' || p_name AS name, CAST(count(*) AS BIGINT) AS n FROM part GROUP BY 1""",
)
NATION_KEY = """CASE lower(country) WHEN 'nation_0' THEN 'nation_5' WHEN 'nation_1' THEN 'nation_5'
  WHEN 'nation_2' THEN 'nation_7' ELSE lower(country) END"""
SUMMED_AMOUNTS = ", ".join(
    f"{r(f'sum({c})', 2)} AS {c}" for c in ("lending_amount", "commitment_amount", "disbursement_amount")
)
add(
    "alias_keys",
    f"SELECT {NATION_KEY} AS join_key, fiscal_year, {SUMMED_AMOUNTS} FROM lending GROUP BY 1, 2",
    OWNERS["nation"], LOANS, lending(),
)
add(
    "real_entity_values",
    "SELECT * FROM esg WHERE iso3 IN (SELECT iso3 FROM countries WHERE region <> 'AFRICA')",
    OWNERS["nation"], ESG,
)
add(
    "tagged_union",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'F' END AS o_orderstatus, o_totalprice,
  CASE WHEN o_orderstatus = 'F' THEN 'IBRD' ELSE 'IDA' END AS source FROM orders""",
)
add(
    "half_even_rounding",
    f"""SELECT {r('l_extendedprice * l_discount', 1)} AS one_digit, {r('l_extendedprice * l_discount', 2)} AS two_digits,
  {r('l_quantity / 8e0', 1)} AS tie, CAST(count(*) AS BIGINT) AS n FROM lineitem GROUP BY 1, 2, 3""",
)
add(
    "event_property",
    """SELECT event_type, CAST(count(*) AS BIGINT) AS n, CAST(count(k) AS BIGINT) AS n_k, sum(k) AS sum_k
FROM (SELECT event_type, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events) GROUP BY 1""",
)

# --- scores and roll-ups ---------------------------------------------------------------------------------------------

LENDING_COLUMNS = f"country, fiscal_year, n_loans, {AMOUNTS}"
add("fiscal_year_lending", f"SELECT {LENDING_COLUMNS} FROM lending", OWNERS["nation"], LOANS, lending())
add("customer_lending", f"SELECT {LENDING_COLUMNS} FROM lending", OWNERS["customer"], LOANS, lending())
add("indicator_values", "SELECT * FROM esg", OWNERS["nation"], ESG)
add(
    "minmax_normalise",
    f"SELECT iso3, country, year, indicator, pillar, {r('norm', 6)} AS norm FROM norm",
    OWNERS["nation"], ESG, norm("esg"),
)
add(
    "minmax_normalise_orders",
    f"SELECT o_orderkey, indicator, year, value, {r('norm', 6)} AS norm FROM norm",
    f"""facts AS (SELECT o_orderkey, o_orderpriority AS indicator, {fy('o_orderdate')} AS year, o_totalprice AS value
  FROM orders)""",
    norm("facts"),
)
ALIASED = """CASE lower(country) WHEN 'nation_0' THEN 'nation_5' WHEN 'nation_1' THEN 'nation_5'
  WHEN 'nation_2' THEN 'nation_7' ELSE lower(country) END"""

add("country_scores", "SELECT * FROM scores", base("nation"))
add("customer_scores", "SELECT * FROM scores", base("customer"))
add("success_rates", "SELECT * FROM success", COUNTRIES, RATINGS["nation"], SUCCESS)
add(
    "lending_on_key",
    f"SELECT {ALIASED} AS join_key, fiscal_year, {SUMMED_AMOUNTS} FROM lending GROUP BY 1, 2",
    OWNERS["nation"], LOANS, lending(),
)
add(
    "success_on_key",
    f"""SELECT {ALIASED} AS join_key, year, CAST(sum(projects_evaluated) AS BIGINT) AS projects_evaluated,
  {rs('sum(success_rate * projects_evaluated) / sum(projects_evaluated)', 1)} AS success_rate
FROM success GROUP BY 1, 2""",
    COUNTRIES, RATINGS["nation"], SUCCESS,
)

# --- matching: spellings whose canonical name and score are known by construction -------------------------------------

SPELLINGS = """spellings AS (
  SELECT p_name, '  ' || upper(p_name) AS spelling, p_name AS name, 1e2 AS score, 'equal' AS method FROM part
  UNION ALL SELECT p_name, split_part(p_name, ' ', 2) || ', ' || split_part(p_name, ' ', 1),
    split_part(p_name, ' ', 2) || ', ' || split_part(p_name, ' ', 1), 95e0, 'scored' FROM part
  UNION ALL SELECT p_name, 'Republic of ' || translate(p_name, 'aeo', 'áéö'), 'republic of ' || p_name, 9e1, 'scored'
  FROM part
  UNION ALL SELECT p_name, p_name || 's', p_name || 's', 2e2 * length(p_name) / (2 * length(p_name) + 1), 'scored'
  FROM part)"""
add(
    "fuzzy_match",
    "SELECT spelling, p_name AS join_key, CAST(count(*) AS BIGINT) AS n FROM spellings GROUP BY 1, 2",
    SPELLINGS,
)
add(
    "fuzzy_match_audit",
    f"SELECT DISTINCT name, p_name AS canonical, {r('score', 4)} AS score, method FROM spellings",
    SPELLINGS,
)
add(
    "customer_match",
    """SELECT replace(upper(c_name), '#', '-') AS buyer, CAST(count(*) AS BIGINT) AS orders, lower(c_name) AS join_key
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL""",
)

# --- master table ----------------------------------------------------------------------------------------------------

add("country_master", f"SELECT {MASTER_COLUMNS} FROM master", master("nation"))
add("customer_master", f"SELECT {MASTER_COLUMNS} FROM master", master())
add(
    "alias_master",
    f"""SELECT {MASTER_COLUMNS} FROM (
  SELECT s.*, lending_amount, commitment_amount, disbursement_amount, projects_evaluated, success_rate
  FROM (SELECT *, {NATION_KEY} AS k FROM scores) s
  LEFT JOIN (SELECT *, {NATION_KEY} AS k FROM lending) l ON l.k = s.k AND l.fiscal_year = s.year
  LEFT JOIN (SELECT *, {NATION_KEY} AS k FROM success) u ON u.k = s.k AND u.year = s.year)""",
    master("nation"),
)
add(
    "top_borrower_table",
    f"""SELECT country, year, environmental_score, social_score, governance_score, esg_risk_score,
  {r('lending_amount', 2)} AS lending_amount
FROM (SELECT * FROM master WHERE esg_score IS NOT NULL AND lending_amount IS NOT NULL) b
WHERE year = (SELECT max(year) FROM master WHERE esg_score IS NOT NULL AND lending_amount IS NOT NULL)
ORDER BY b.lending_amount DESC, country, iso3 LIMIT 10""",
    master(),
)

# --- analysis --------------------------------------------------------------------------------------------------------

add("exposure", "SELECT iso3, country, year, exposure_score FROM exposed", master(), EXPOSED)
add("priority", "SELECT iso3, country, year, priority_score FROM exposed", master(), EXPOSED)
add(
    "risk_trend",
    "SELECT country, year, risk_trend FROM scores JOIN trends USING (country)",
    base("customer"), TRENDS,
)
add("lending_gap", f"SELECT iso3, country, year, CAST({GAP} AS INTEGER) AS lending_gap FROM master", master())


def _covered(column: str, condition: str) -> str:
    n = f"count(*) FILTER ({condition})"
    return f"SELECT '{column}' AS metric, {n} AS n, {r(f'{n} / CAST(count(*) AS DOUBLE) * 1e2', 0)} AS pct FROM master"


COVERAGE = [
    f"SELECT '{name}' AS metric, {expression} AS n, CAST(NULL AS DOUBLE) AS pct FROM master"
    for name, expression in (
        ("rows", "count(*)"), ("countries", "count(DISTINCT country)"), ("years", "count(DISTINCT year)"),
    )
] + [
    _covered(c, f"{c} IS NOT NULL")
    for c in ("environmental_score", "social_score", "governance_score", "esg_score", "esg_risk_score",
              "lending_amount", "success_rate")
] + [
    _covered("all pillars",
             "environmental_score IS NOT NULL AND social_score IS NOT NULL AND governance_score IS NOT NULL")
]
add("coverage", " UNION ALL ".join(COVERAGE), master())
add("master_years", "SELECT year, CAST(count(*) AS BIGINT) AS n FROM master GROUP BY year", master())
add("pearson_correlation", f"SELECT count(*) AS n, {r('corr(x, y)', 6)} AS r FROM paired", master(), PAIRED)
add("spearman_correlation", SPEARMAN, master(), PAIRED, RANKED)
add(
    "price_quantity_rank_correlation",
    SPEARMAN,
    "paired AS (SELECT l_extendedprice AS x, l_quantity AS y FROM lineitem)", RANKED,
)
add(
    "correlation_test",
    f"""SELECT n, {r('r', 6)} AS r, {r('rho', 6)} AS rho, {r('p', 6)} AS p, {r('p_rho', 6)} AS p_rho,
  p < 0.05 OR p_rho < 0.05 AS significant
FROM (SELECT (SELECT n FROM tests WHERE test = 'r') AS n, (SELECT r FROM tests WHERE test = 'r') AS r,
  (SELECT r FROM tests WHERE test = 'rho') AS rho, (SELECT p FROM p_values WHERE test = 'r') AS p,
  (SELECT p FROM p_values WHERE test = 'rho') AS p_rho)""",
    master(), PAIRED, RANKED,
    """tests AS (SELECT 'r' AS test, count(*) AS n, corr(x, y) AS r FROM paired
  UNION ALL SELECT 'rho', count(*), corr(rx, ry) FROM ranked)""",
    P_VALUES,
)
add(
    "price_ranks",
    """SELECT o_totalprice, count(*) AS n, min(k) + (count(*) - 1) / 2e0 AS rank
FROM (SELECT o_totalprice, rank() OVER (ORDER BY o_totalprice) AS k FROM orders) GROUP BY 1""",
)
add(
    "linear_regression",
    f"""SELECT count(*) AS n, {r('regr_slope(y, x)', 6)} AS slope, {r('regr_intercept(y, x)', 6)} AS intercept,
  {r('corr(x, y)', 6)} AS r, {r('(SELECT p FROM p_values)', 6)} AS p, {r('min(x)', 6)} AS x_min, {r('max(x)', 6)} AS x_max,
  {r('regr_intercept(y, x) + regr_slope(y, x) * min(x)', 6)} AS y_at_min,
  {r('regr_intercept(y, x) + regr_slope(y, x) * max(x)', 6)} AS y_at_max FROM paired""",
    master(), PAIRED, "tests AS (SELECT 'r' AS test, count(*) AS n, corr(x, y) AS r FROM paired)", P_VALUES,
)
add(
    "success_by_bin",
    f"""SELECT bin_id, risk_group, avg_success_rate, coalesce(n, 0) AS n FROM {BINS} LEFT JOIN (
  SELECT {BIN} AS risk_group, {rs('avg(success_rate)', 1)} AS avg_success_rate, count(*) AS n
  FROM master WHERE success_rate IS NOT NULL AND esg_risk_score IS NOT NULL GROUP BY 1) USING (risk_group)""",
    master(),
)
PILLAR_MEANS = ", ".join(
    f"{rs(f'avg({c})', 1)} AS {c}" for c in ("environmental_score", "social_score", "governance_score")
)
add(
    "pillars_by_bin",
    f"""SELECT bin_id, risk_group, environmental_score, social_score, governance_score FROM {BINS} LEFT JOIN (
  SELECT {BIN} AS risk_group, {PILLAR_MEANS} FROM latest GROUP BY 1) USING (risk_group)
UNION ALL SELECT 3, 'ALL', {PILLAR_MEANS} FROM latest""",
    master(), "latest AS (SELECT * FROM master WHERE year = (SELECT max(year) FROM master))",
)
add(
    "risk_bins",
    f"SELECT {BIN} AS risk_group, {BAND} AS band, CAST(count(*) AS BIGINT) AS n FROM scores GROUP BY 1, 2",
    base("customer"),
)


def last(column: str) -> str:
    return f"max_by({column}, year) FILTER ({column} IS NOT NULL) AS {column}"


LATEST = ", ".join(
    last(c) for c in ("environmental_score", "social_score", "governance_score", "esg_score", "esg_risk_score",
                      "priority_score")
)
add(
    "summary_by_country",
    f"""SELECT country, {last('iso3')}, max(year) AS latest_year, {LATEST}, max(risk_trend) AS risk_trend,
  CAST(max_by({GAP}, year) AS INTEGER) AS lending_gap,
  {r('coalesce(sum(lending_amount), 0e0)', 2)} AS total_lending_usd, {rs('avg(success_rate)', 1)} AS avg_success_rate
FROM exposed JOIN trends USING (country) GROUP BY country""",
    master(), EXPOSED, TRENDS,
)
add(
    "analysis_export",
    f"""SELECT iso3, country, year, environmental_score, social_score, governance_score, esg_score, esg_risk_score,
  {AMOUNTS}, exposure_score, priority_score, projects_evaluated, success_rate FROM exposed""",
    master(), EXPOSED,
)

# --- ranked tables, panels, charts -----------------------------------------------------------------------------------

TOP_PRIORITY = f"""SELECT country, year, {r('esg_risk_score', 1)} AS esg_risk_score,
  {r('exposure_score', 1)} AS exposure_score, {r('priority_score', 2)} AS priority_score,
  {r('success_rate', 1)} AS success_rate
FROM (SELECT * FROM exposed WHERE priority_score IS NOT NULL {{}}
      ORDER BY priority_score DESC, country, iso3, year LIMIT 15)"""
add("top_priority_table", TOP_PRIORITY.format(""), master(), EXPOSED)
add("top_priority_of_year", TOP_PRIORITY.format("AND year = 1997"), master(), EXPOSED)
add(
    "top_gap_table",
    """SELECT country, esg_risk_score, social_score, environmental_score FROM master
WHERE year = (SELECT max(year) FROM master) AND esg_risk_score >= 40 AND coalesce(lending_amount, 0) = 0
ORDER BY esg_risk_score DESC, country, iso3 LIMIT 10""",
    master(),
)
add(
    "busiest_year",
    "SELECT year, count(lending_amount) AS n FROM master GROUP BY year ORDER BY n DESC, year LIMIT 1",
    master(),
)
SNAPSHOT = f"snap AS (SELECT * FROM master WHERE year = {BUSIEST})"
add(
    "panel_top_risk",
    f"""SELECT country, esg_risk_score, {BAND} AS band FROM snap WHERE esg_risk_score IS NOT NULL
ORDER BY esg_risk_score DESC, country, iso3, year LIMIT 20""",
    master(), SNAPSHOT,
)
add(
    "panel_pillar_scatter",
    """SELECT country, environmental_score, social_score, esg_risk_score,
  CAST(row_number() OVER (ORDER BY esg_risk_score DESC, country, iso3, year) <= 4 AS INTEGER) AS label
FROM snap WHERE social_score IS NOT NULL AND environmental_score IS NOT NULL AND esg_risk_score IS NOT NULL""",
    master(), SNAPSHOT,
)
add(
    "panel_lending_gap",
    """SELECT country, esg_risk_score, CAST(coalesce(lending_amount, 0) > 0 AS INTEGER) AS has_lending
FROM snap WHERE esg_risk_score >= 35 ORDER BY esg_risk_score DESC, country, iso3, year LIMIT 25""",
    master(), SNAPSHOT,
)
add(
    "panel_risk_trend",
    """(SELECT country, risk_trend, 'improving' AS direction FROM trends WHERE risk_trend < -0.5
 ORDER BY risk_trend, country LIMIT 10)
UNION ALL (SELECT country, risk_trend, 'worsening' FROM trends WHERE risk_trend > 0.5
 ORDER BY risk_trend DESC, country LIMIT 10)""",
    base("customer"), TRENDS,
)
add(
    "panel_success_scatter",
    """SELECT country, year, esg_risk_score, success_rate FROM master
WHERE esg_risk_score IS NOT NULL AND success_rate IS NOT NULL""",
    master(),
)
add(
    "panel_priority_matrix",
    f"""SELECT country, exposure_score, esg_risk_score, priority_score,
  CASE WHEN esg_risk_score > 50 THEN 'High Risk / ' ELSE 'Low Risk / ' END
  || CASE WHEN exposure_score > 50 THEN 'High Exposure' ELSE 'Low Exposure' END AS quadrant,
  CAST(row_number() OVER (ORDER BY priority_score DESC, country, iso3, year) <= 5 AS INTEGER) AS label
FROM exposed WHERE year = {BUSIEST} AND esg_risk_score IS NOT NULL AND exposure_score IS NOT NULL""",
    master(), EXPOSED,
)
add(
    "chart_pillars",
    f"""SELECT country, pillar, {r('score', 6)} AS score FROM (
  SELECT * FROM (SELECT country, environmental_score, social_score, governance_score FROM (
    SELECT country, avg(esg_score) AS m, avg(environmental_score) AS environmental_score,
           avg(social_score) AS social_score, avg(governance_score) AS governance_score
    FROM master GROUP BY country ORDER BY m DESC NULLS LAST, country LIMIT 15))
  UNPIVOT INCLUDE NULLS (score FOR pillar IN (environmental_score, social_score, governance_score)))""",
    master(),
)
add(
    "chart_lending",
    f"""SELECT country, {r('lending_amount', 2)} AS lending_amount FROM (
  SELECT country, coalesce(sum(lending_amount), 0e0) AS lending_amount FROM master GROUP BY country
  ORDER BY lending_amount DESC, country LIMIT 15)""",
    master(),
)
add(
    "chart_success",
    f"""SELECT country, {r('e', 6)} AS avg_esg_score, {r('k', 6)} AS avg_esg_risk_score, {r('s', 6)} AS avg_success_rate,
  {r('avg(s) OVER ()', 6)} AS portfolio_success_rate
FROM (SELECT country, avg(esg_score) AS e, avg(esg_risk_score) AS k, avg(success_rate) AS s FROM master GROUP BY country)
WHERE s IS NOT NULL""",
    master(),
)

# --- panels over the event stream ------------------------------------------------------------------------------------

USER_DAYS = f"""scores AS (
  SELECT CAST(user_id AS VARCHAR) AS country, CAST(dayofyear(ts) AS INTEGER) AS year,
         {r(f"CAST(sum({CENTS.format('value')}) AS DOUBLE) / 1e2 / count(*)", 1)} AS esg_risk_score
  FROM events GROUP BY 1, 2)"""
add("user_trends", "SELECT * FROM trends", USER_DAYS, TRENDS)
add(
    "busiest_day",
    "SELECT year, count(esg_risk_score) AS n FROM scores GROUP BY year ORDER BY n DESC, year LIMIT 1",
    USER_DAYS,
)

# --- keys and upserts ------------------------------------------------------------------------------------------------

LINE_ORDER = """l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC,
  l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC"""


def single(source: str) -> str:
    return f"""SELECT * EXCLUDE (k) FROM (SELECT *, row_number() OVER (
  PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_ORDER}) AS k FROM {source}) WHERE k = 1"""


add("one_line_per_key", single("lineitem"))
add(
    "upserted_lines",
    """SELECT * FROM incoming UNION ALL
SELECT * FROM existing e WHERE NOT EXISTS (
  SELECT 1 FROM incoming i WHERE i.l_orderkey = e.l_orderkey AND i.l_linenumber = e.l_linenumber)""",
    f"existing AS ({single('(SELECT * FROM lineitem WHERE l_shipdate < DATE ' + chr(39) + '1998-01-01' + chr(39) + ')')})",
    f"incoming AS ({single('(SELECT * FROM lineitem WHERE l_shipdate >= DATE ' + chr(39) + '1998-01-01' + chr(39) + ')')})",
)
add(
    "quarantined_keys",
    """SELECT count(*) FILTER (l_returnflag IN ('A', 'N')) AS valid,
  count(*) FILTER (l_returnflag NOT IN ('A', 'N')) AS quarantined FROM lineitem""",
)
add(
    "share_of_sector",
    f"""SELECT sector, count(*) AS n, {r('sum(is_successful) / CAST(count(*) AS DOUBLE) * 1e2', 1)} AS success_rate,
  CAST(max(closing_year) >= 1998 AS INTEGER) AS recent, count(outcome_rating) AS rated FROM ratings GROUP BY sector""",
    COUNTRIES, RATINGS["nation"],
)

# --- jobs ------------------------------------------------------------------------------------------------------------

CODE = """CASE indicator WHEN '1-URGENT' THEN 'EG.ELC.ACCS.ZS' WHEN '2-HIGH' THEN 'SP.DYN.LE00.IN'
  WHEN '3-MEDIUM' THEN 'SI.POV.DDAY' WHEN '4-NOT SPECIFIED' THEN 'EG.FEC.RNEW.ZS' ELSE 'EN.ATM.CO2E.PC' END"""
add(
    "job_bronze_esg",
    f"""SELECT iso3, country, year, {CODE} AS indicator, value,
  CASE WHEN indicator IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN 'social' ELSE 'environmental' END AS pillar
FROM esg WHERE year BETWEEN 1993 AND 1997 AND iso3 NOT IN (SELECT iso3 FROM countries WHERE region = 'AFRICA')""",
    OWNERS["nation"], ESG,
)
add(
    "job_bronze_loans",
    f"""SELECT loan_id, country, fiscal_year,
  {r("CASE WHEN CAST(loan_id AS BIGINT) % 2 = 0 THEN commitment_amount * 2 ELSE commitment_amount END", 2)} AS commitment_amount,
  {r('disbursement_amount', 2)} AS disbursement_amount, source FROM loans WHERE source = 'IBRD'
UNION ALL
SELECT 'all|' || country || '|' || fiscal_year || '|' || source, country, fiscal_year,
  {r('coalesce(sum(commitment_amount), 0e0)', 2)}, {r('coalesce(sum(disbursement_amount), 0e0)', 2)}, source
FROM loans WHERE source = 'IDA' GROUP BY country, fiscal_year, source""",
    OWNERS["nation"], LOANS,
)
add(
    "job_bronze_ratings",
    """SELECT * FROM ratings WHERE closing_year <> 1995 QUALIFY row_number() OVER (PARTITION BY project_id
  ORDER BY country DESC, outcome_rating DESC, sector DESC, closing_year DESC, is_successful DESC) = 1""",
    COUNTRIES, RATINGS["nation"],
)
add("job_gold_scores", "SELECT * FROM scores", base("nation"))
add("job_gold_master", f"SELECT {MASTER_COLUMNS} FROM master", master("nation"))
add(
    "job_written_rows",
    "\nUNION ALL\n".join(
        f"SELECT '{name}' AS table_name, CAST(count(*) AS BIGINT) AS written, CAST(count(*) AS BIGINT) AS n FROM {source}"
        for name, source in (("aggregate_esg", "scores"), ("aggregate_loans", "lending"), ("aggregate_ratings", "success"),
                             ("esg_lending_master", "master"))
    ),
    master("nation"),
)
add("job_analysis_files", ORACLES["analysis_export"])
add(
    "job_refresh_loans",
    f"""SELECT CAST(o_orderkey AS VARCHAR) AS loan_id, 'Customer ' || o_custkey AS country, {fy('o_orderdate')} AS fiscal_year,
  o_totalprice AS commitment_amount, o_totalprice AS disbursement_amount, 'IBRD' AS source FROM orders""",
)
add(
    "job_waiting_feeds",
    """SELECT o_orderstatus AS feed, CAST(count(*) FILTER (o_orderkey // 1000 < last) AS BIGINT) AS rows_landed,
  CAST(count(*) AS BIGINT) AS rows_announced, FALSE AS complete,
  (SELECT CAST(count(*) AS BIGINT) FROM orders WHERE o_orderstatus = 'F') AS rows_merged
FROM orders JOIN (SELECT o_orderstatus AS s, max(o_orderkey) // 1000 AS last FROM orders GROUP BY 1) ON s = o_orderstatus
WHERE o_orderstatus <> 'F' GROUP BY 1""",
)
