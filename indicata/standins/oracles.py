"""The same results in plain SQL, written from the formulas, for a second engine."""

from __future__ import annotations

from .queries import SCATTER_POINTS, TOLERANCE, WALK_TOLERANCE
from .tables import RING_VERTICES, TERRITORY_SEGMENT_OUT, YEAR

ORACLES: dict[str, str] = {}

MUNICIPALITY = "Municípios"
IN_YEAR = f"{{0}} >= TIMESTAMP '{YEAR}-01-01' AND {{0}} < TIMESTAMP '{YEAR + 1}-01-01'"


def sig(value: str, digits: int = 9) -> str:
    return f"(CAST(printf('%.{digits - 1}e', {value}) AS DOUBLE) + 0.0)"


def named(name: str, ctes: list[str], select: str) -> None:
    ORACLES[name] = (f"WITH RECURSIVE {', '.join(ctes)} " if ctes else "") + select


# --- shared pieces ----------------------------------------------------------

MONEY = "CAST(SUM(CAST({0} AS DECIMAL(18,2))) AS DOUBLE)"
RAW_GDP = (
    f"raw_gdp AS (SELECT CAST(o_custkey AS VARCHAR) AS code, {MONEY.format('l_extendedprice')} AS v"
    f" FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE {IN_YEAR.format('l_shipdate')} GROUP BY 1)"
)
RAW_REVENUE = (
    f"raw_revenue AS (SELECT CAST(o_custkey AS VARCHAR) AS code, {MONEY.format('o_totalprice')} AS v"
    f" FROM orders WHERE {IN_YEAR.format('o_orderdate')} GROUP BY 1)"
)
SILVERS = [
    RAW_GDP,
    RAW_REVENUE,
    "gdp AS (SELECT code, CAST(round_even(v * 1000.0 * 1000.0, 0) AS DOUBLE) / 1000.0 AS gdp FROM raw_gdp)",
    "revenue AS (SELECT code, CAST(round_even(v * 100.0, 0) AS DOUBLE) / 100.0 AS revenue FROM raw_revenue)",
    "population AS (SELECT CAST(o_custkey AS VARCHAR) AS code, CAST(COUNT(*) AS BIGINT) AS population"
    " FROM orders GROUP BY 1)",
    "territory AS (SELECT CAST(c_custkey AS VARCHAR) AS code, c_name AS name FROM customer"
    f" WHERE c_mktsegment <> '{TERRITORY_SEGMENT_OUT}')",
    "idhm AS (SELECT CAST(c_custkey AS VARCHAR) AS code, c_acctbal AS idhm FROM customer WHERE c_acctbal >= 0)",
]
JOINED = [
    *SILVERS,
    "joined AS (SELECT gdp.code, gdp, revenue, population, name, idhm FROM gdp"
    " LEFT JOIN revenue ON gdp.code = revenue.code LEFT JOIN population ON gdp.code = population.code"
    " LEFT JOIN territory ON gdp.code = territory.code LEFT JOIN idhm ON gdp.code = idhm.code)",
]
STRICT = [
    *SILVERS,
    "joined_strict AS (SELECT population.code, population, gdp, revenue, idhm, name FROM population"
    " LEFT JOIN gdp ON population.code = gdp.code LEFT JOIN revenue ON population.code = revenue.code"
    " LEFT JOIN idhm ON population.code = idhm.code LEFT JOIN territory ON population.code = territory.code)",
]
FILLED = (
    "CASE WHEN revenue IS NULL AND gdp IS NULL THEN NULL"
    " WHEN coalesce(gdp, 0) <> 0 THEN coalesce(revenue, 0) / gdp"
    " WHEN coalesce(revenue, 0) > 0 THEN CAST('infinity' AS DOUBLE)"
    " WHEN coalesce(revenue, 0) < 0 THEN CAST('-infinity' AS DOUBLE) END"
)
PLAIN = (
    "CASE WHEN revenue IS NULL OR gdp IS NULL THEN NULL WHEN gdp <> 0 THEN revenue / gdp"
    " WHEN revenue > 0 THEN CAST('infinity' AS DOUBLE) WHEN revenue < 0 THEN CAST('-infinity' AS DOUBLE) END"
)
STATUS = (
    "CASE WHEN coalesce(idhm, 0) <> 0 AND coalesce(gdp, 0) <> 0 AND coalesce(revenue, 0) <> 0"
    " THEN 'complete' ELSE 'incomplete' END"
)
BURDEN = (
    "CASE WHEN isfinite(burden) THEN burden END AS burden,"
    " CASE WHEN burden IS NULL THEN 'missing' WHEN NOT isfinite(burden) THEN 'infinite'"
    " WHEN burden = 0 THEN 'zero' ELSE 'finite' END AS burden_class"
)
GOLD = [*JOINED, f"gold AS (SELECT *, {FILLED} AS burden, {STATUS} AS data_status FROM joined)"]
GOLD_SELECT = f"SELECT code, name, population, idhm, revenue, gdp, {BURDEN}, data_status FROM gold"
# The measures with everything that is not finite as null.
CLEAN = [*GOLD, "clean AS (SELECT * REPLACE (CASE WHEN isfinite(burden) THEN burden END AS burden) FROM gold)"]


# --- sources, sinks, layers -------------------------------------------------

# What the landed revenue holds besides: another level, missing keys and repeated keys.
STRAYS = (
    "strays AS (SELECT CAST(n_nationkey AS VARCHAR) AS code, 'Estados' AS level, n_nationkey + 0.5 AS v FROM nation"
    f" UNION ALL SELECT NULL, '{MUNICIPALITY}', n_nationkey + 0.125 FROM nation WHERE n_regionkey = 0"
    f" UNION ALL SELECT CAST(n_nationkey AS VARCHAR), '{MUNICIPALITY}', n_nationkey + 1000.125 FROM nation WHERE n_regionkey = 1),"
    f" landed AS (SELECT code, '{MUNICIPALITY}' AS level, v FROM raw_revenue UNION ALL SELECT code, level, CAST(v AS DOUBLE) FROM strays)"
)
named(
    "src_series_year",
    [RAW_REVENUE, STRAYS],
    f"SELECT 'RECORRM' AS \"CODE\", CAST({YEAR} AS INTEGER) AS \"YEAR\", code AS \"TERCODIGO\","
    " level AS \"NIVNOME\", v AS value FROM landed",
)
TERRITORIES = (
    "SELECT c_name AS \"NAME\", CAST(c_custkey AS VARCHAR) AS \"ID\", CASE WHEN c_mktsegment ="
    f" '{TERRITORY_SEGMENT_OUT}' THEN 'Estados' ELSE '{MUNICIPALITY}' END AS \"LEVEL\","
    " c_acctbal AS \"AREA\", c_nationkey = 0 AS \"CAPITAL\" FROM customer"
)
named("src_territories", [], TERRITORIES)
named(
    "src_alt_shape",
    [],
    "SELECT 'ADH_IDHM' AS code, CASE WHEN c_acctbal >= 0 THEN 'Municipality' ELSE 'State' END AS uname,"
    f" TIMESTAMP '{YEAR}-01-01' AS date, CAST(c_custkey AS VARCHAR) AS tcode, c_acctbal AS value FROM customer",
)
RING = (
    f"vertex AS (SELECT vec_id, label, CAST(i AS INTEGER) AS i,"
    f" label + (1 + 0.5 * CAST(embedding[(i % {RING_VERTICES}) + 1] AS DOUBLE))"
    f" * cos(2 * pi() * (i % {RING_VERTICES}) / {RING_VERTICES}) AS x,"
    f" (1 + 0.5 * CAST(embedding[(i % {RING_VERTICES}) + 1] AS DOUBLE))"
    f" * sin(2 * pi() * (i % {RING_VERTICES}) / {RING_VERTICES}) AS y"
    f" FROM embeddings, range({RING_VERTICES + 1}) AS r(i))"
)


def outline(vertices: str, name: str) -> list[str]:
    """Points and area of the rings in a (vec_id, label, i, x, y) table."""
    return [
        f"{name}_next AS (SELECT *, lead(x) OVER w AS nx, lead(y) OVER w AS ny FROM {vertices}"
        " WINDOW w AS (PARTITION BY vec_id ORDER BY i))",
        f"{name} AS (SELECT CAST(vec_id AS BIGINT) AS code, any_value('S' || label) AS \"UF\","
        " CAST(count(*) AS INTEGER) AS points, sum(x + y) AS coordinate_sum,"
        f" abs(sum(x * ny - nx * y)) / 2 AS area FROM {name}_next GROUP BY vec_id)",
    ]


named(
    "src_polygons",
    [RING, *outline("vertex", "ring")],
    f"SELECT code, \"UF\", points, {sig('area')} AS area FROM ring",
)
for layer in ("src_gold_table", "gold_sorted", "gold"):
    named(layer, GOLD, GOLD_SELECT)
for layer in ("sink_parquet_roundtrip", "sink_csv_roundtrip"):
    named(
        layer,
        [
            *GOLD,
            "texts AS (SELECT CAST(doc_id AS VARCHAR) AS code, CASE WHEN doc_id % 7 = 0 THEN '' WHEN doc_id % 5 <> 0"
            """ THEN ' "\\n' || chr(13) || chr(10) || ',' || text || '\\ ' || chr(10) END AS note FROM documents)""",
        ],
        f"SELECT gold.code, name, population, idhm, revenue, gdp, {BURDEN}, data_status, note FROM gold LEFT JOIN texts ON gold.code = texts.code",
    )
CATALOGUE = [
    ("gdp", "PIB_IBGE_5938_37", 0, "1000.0", "3", "raw_gdp"),
    ("revenue", "RECORRM", 1, "NULL", "2", "raw_revenue"),
    ("population", "POPTOT", 2, "NULL", "NULL", "population"),
    ("name", "Municípios", 3, "NULL", "NULL", "customer"),
    ("idhm", "ADH_IDHM", 4, "NULL", "NULL", "customer"),
]
named(
    "source_catalogue",
    SILVERS,
    " UNION ALL ".join(
        f"SELECT '{n}' AS source, '{s}' AS series, CAST({at} AS INTEGER) AS join_position,"
        f" CAST({scale} AS DOUBLE) AS scale, CAST({digits} AS INTEGER) AS digits,"
        f" CAST(count(*) AS BIGINT) AS rows, CAST(count(*) AS BIGINT) AS given FROM {held}"
        for n, s, at, scale, digits, held in CATALOGUE
    ),
)
named(
    "partial_sources",
    [
        *JOINED,
        "cut AS (SELECT * REPLACE (CAST(NULL AS DOUBLE) AS revenue) FROM joined)",
        f"gold AS (SELECT *, {FILLED} AS burden, {STATUS} AS data_status FROM cut)",
    ],
    GOLD_SELECT,
)
named("sink_create_if_absent", SILVERS, "SELECT code, revenue FROM revenue")
named(
    "stage_metrics",
    SILVERS,
    " UNION ALL ".join(
        f"SELECT 'silver {n}' AS stage, CAST(count(*) AS BIGINT) AS rows,"
        f" CAST(count(*) FILTER ({n} IS NULL) AS BIGINT) AS missing, true AS timed FROM {t}"
        for n, t in (
            ("gdp", "gdp"), ("revenue", "revenue"), ("population", "population"), ("name", "territory"), ("idhm", "idhm"),
        )
    ),
)
named(
    "silver_series",
    [RAW_REVENUE, STRAYS],
    "SELECT code, CAST(round_even(v * 100.0, 0) AS DOUBLE) / 100.0 AS revenue, 'clean' AS state FROM landed"
    f" WHERE code IS NOT NULL AND level = '{MUNICIPALITY}'"
    f" UNION ALL SELECT code, v, 'reject' FROM landed WHERE code IS NULL AND level = '{MUNICIPALITY}'",
)
named(
    "gold_strict",
    [
        *STRICT,
        f"gold AS (SELECT *, {PLAIN} AS burden FROM joined_strict WHERE name IS NOT NULL AND idhm IS NOT NULL"
        " AND revenue IS NOT NULL AND gdp IS NOT NULL)",
    ],
    f"SELECT code, name, population, idhm, revenue, gdp, {BURDEN} FROM gold",
)

# --- rows, columns, joins ---------------------------------------------------

named("filter_level", [], "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
named("filter_dim_level", [f"t AS ({TERRITORIES})"], f"SELECT \"ID\", \"NAME\" FROM t WHERE \"LEVEL\" = '{MUNICIPALITY}'")
for name in ("filter_param_date", "filter_literal_date"):
    named(
        name,
        [],
        "SELECT o_orderkey, o_orderstatus, o_orderdate FROM orders"
        " WHERE o_orderstatus = 'F' AND o_orderdate = TIMESTAMP '2000-08-03'",
    )
named(
    "trim_p95",
    [],
    "SELECT o_orderkey, o_totalprice FROM orders"
    " WHERE o_totalprice <= (SELECT quantile_cont(o_totalprice, 0.95) FROM orders)",
)
named(
    "drop_incomplete",
    JOINED,
    "SELECT code, name, population, idhm, revenue, gdp FROM joined WHERE name IS NOT NULL"
    " AND population IS NOT NULL AND idhm IS NOT NULL AND revenue IS NOT NULL AND gdp IS NOT NULL",
)
named(
    "dedupe_first",
    [],
    "SELECT CAST(o_custkey AS VARCHAR) AS code, o_totalprice, o_orderdate FROM orders"
    " QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 1",
)
named("drop_strict", [], "SELECT c_custkey, c_name, c_acctbal FROM customer")
named(
    "rename_cols",
    GOLD,
    f"SELECT code AS \"CodMunIBGE\", name AS \"Município\", population AS \"Habitantes {YEAR}\","
    f" idhm AS \"IDHM {YEAR}\", revenue AS \"Receitas Correntes {YEAR} (R$)\", gdp AS \"PIB {YEAR} (R$)\","
    " data_status FROM gold",
)
named(
    "reindex_schema",
    JOINED,
    "SELECT code, CAST(NULL AS VARCHAR) AS name, CAST(NULL AS BIGINT) AS population, idhm,"
    " CAST(NULL AS DOUBLE) AS revenue, gdp FROM joined",
)
named("gold_join", JOINED, "SELECT code, gdp, revenue, population, name, idhm FROM joined")
named("gold_join_strict", STRICT, "SELECT code, population, gdp, revenue, idhm, name FROM joined_strict")
named(
    "geo_left_join",
    [*GOLD, RING, *outline("vertex", "ring")],
    "SELECT CAST(gold.code AS BIGINT) AS code, gdp, \"UF\", points FROM gold"
    " LEFT JOIN ring ON CAST(gold.code AS BIGINT) = ring.code",
)
for fanout in ("join_fanout", "join_fanout_dealt"):
    named(
        fanout,
        [],
        "SELECT n_nationkey AS code, n_name, c_custkey, c_name FROM nation LEFT JOIN customer ON n_nationkey = c_nationkey",
    )
named(
    "gold_fanout",
    [
        f"revenue AS (SELECT CAST(o_custkey AS VARCHAR) AS code, o_totalprice AS revenue FROM orders WHERE {IN_YEAR.format('o_orderdate')})"
        if c.startswith("revenue AS")
        else c
        for c in GOLD
    ],
    GOLD_SELECT,
)
named(
    "join_key_cast",
    [],
    "SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS code, c_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey",
)
named("ratio_fill_zero", [*STRICT, f"g AS (SELECT code, {FILLED} AS burden FROM joined_strict)"], f"SELECT code, {BURDEN} FROM g")
named("ratio_plain", [*STRICT, f"g AS (SELECT code, {PLAIN} AS burden FROM joined_strict)"], f"SELECT code, {BURDEN} FROM g")
named("data_status", GOLD, "SELECT code, data_status FROM gold")
named(
    "scale_round",
    [],
    "SELECT l_orderkey, l_linenumber,"
    " CAST(round_even(l_extendedprice * l_discount * CAST(1000 AS DOUBLE) * CAST(100 AS DOUBLE), 0) AS DOUBLE) / 100 AS half_even,"
    " CAST(round_even(l_extendedprice / 8, 0) AS DOUBLE) AS half_even_whole,"
    " round(l_extendedprice / 8, 0) AS half_up_whole FROM lineitem",
)
named(
    "cast_coerce",
    [],
    "SELECT o_orderkey, TRY_CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS digit, TRY_CAST(CASE WHEN"
    " o_orderkey % 3 = 0 THEN 'n/a' ELSE substr(o_orderpriority, 1, 1) END AS DOUBLE) AS word FROM orders",
)
named(
    "cast_ignore",
    [],
    "SELECT o_orderkey, CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS digit, o_orderstatus AS word FROM orders",
)
named(
    "epoch_days_to_ts",
    [],
    "SELECT o_orderkey, date_trunc('day', o_orderdate) + INTERVAL 6 HOUR * CAST(o_orderkey % 4 AS INTEGER) AS date FROM orders",
)

# --- description and correlation --------------------------------------------

MEASURES = ("population", "idhm", "revenue", "gdp", "burden")
named(
    "describe_long",
    CLEAN,
    " UNION ALL ".join(
        f"SELECT '{c}' AS variable, '{stat}' AS stat,"
        f" {sig(f'CAST({value} AS DOUBLE)', 9 if stat in ('mean', 'std') else 12)} AS value FROM clean"
        for c in MEASURES
        for stat, value in (
            ("count", f"count({c})"), ("mean", f"avg({c})"), ("std", f"stddev_samp({c})"),
            ("min", f"min({c})"), ("max", f"max({c})"),
            ("excluded", f"(SELECT count({c}) FROM gold) - count({c})"),
        )
    ),
)
named(
    "describe_quartiles",
    CLEAN,
    " UNION ALL ".join(
        f"SELECT '{c}' AS variable, '{q * 100:.0f}%' AS stat, {sig(f'quantile_cont(CAST({c} AS DOUBLE), {q})', 12)} AS value FROM clean"
        for c in MEASURES
        for q in (0.25, 0.5, 0.75)
    ),
)
named(
    "quantile_95",
    [],
    " UNION ALL ".join(
        f"SELECT '{c}' AS variable, {sig(f'quantile_cont({c}, 0.95)', 12)} AS value FROM lineitem"
        for c in ("l_extendedprice", "l_quantity")
    ),
)
CORRELATED = ("idhm", "burden", "gdp")


def correlation(x: str, y: str) -> str:
    return f"corr({x}, {y})"


named(
    "corr_pairs",
    CLEAN,
    " UNION ALL ".join(
        f"SELECT '{x}' AS var_x, '{y}' AS var_y, {sig(correlation(x, y))} AS r,"
        f" CAST(count(*) FILTER ({x} IS NOT NULL AND {y} IS NOT NULL) AS BIGINT) AS pairs FROM clean"
        for i, x in enumerate(CORRELATED)
        for y in CORRELATED[i:]
    ),
)
named(
    "corr_matrix",
    CLEAN,
    " UNION ALL ".join(
        f"SELECT '{x}' AS var_x, '{y}' AS var_y, {sig(correlation(x, y))} AS r FROM clean"
        for x in CORRELATED
        for y in CORRELATED
    ),
)

# --- regression, by the closed form for two predictors ----------------------

FIT = [
    *CLEAN,
    "cases AS (SELECT code, idhm AS y, burden AS x1, gdp AS x2 FROM clean"
    " WHERE idhm IS NOT NULL AND burden IS NOT NULL AND gdp IS NOT NULL)",
    "st AS (SELECT CAST(count(*) AS DOUBLE) AS n, avg(y) AS my, avg(x1) AS m1, avg(x2) AS m2,"
    " count(*) * covar_pop(x1, x1) AS s11, count(*) * covar_pop(x1, x2) AS s12, count(*) * covar_pop(x2, x2) AS s22,"
    " count(*) * covar_pop(x1, y) AS s1y, count(*) * covar_pop(x2, y) AS s2y, count(*) * covar_pop(y, y) AS syy FROM cases)",
    "slopes AS (SELECT *, s11 * s22 - s12 * s12 AS det, n - 3 AS d,"
    " (s1y * s22 - s2y * s12) / (s11 * s22 - s12 * s12) AS b1,"
    " (s2y * s11 - s1y * s12) / (s11 * s22 - s12 * s12) AS b2 FROM st)",
    "fit AS (SELECT *, my - b1 * m1 - b2 * m2 AS b0, syy - b1 * s1y - b2 * s2y AS rss,"
    " (syy - b1 * s1y - b2 * s2y) / d AS mse FROM slopes)",
    # 97.5 % point of Student's t by the Cornish-Fisher series.
    "point AS (SELECT CAST(1.959963984540054 AS DOUBLE) AS z),"
    " student AS (SELECT z + (z**3 + z) / (4 * d) + (5 * z**5 + 16 * z**3 + 3 * z) / (96 * d**2)"
    " + (3 * z**7 + 19 * z**5 + 17 * z**3 - 15 * z) / (384 * d**3)"
    " + (79 * z**9 + 776 * z**7 + 1482 * z**5 - 1920 * z**3 - 945 * z) / (92160 * d**4) AS t95 FROM point, fit)",
    "terms AS (SELECT 'Intercept' AS term, b0 AS coef, sqrt(mse * (1 / n + (m1 * m1 * s22 - 2 * m1 * m2 * s12"
    " + m2 * m2 * s11) / det)) AS std_err, d FROM fit UNION ALL"
    " SELECT 'burden', b1, sqrt(mse * s22 / det), d FROM fit UNION ALL"
    " SELECT 'gdp', b2, sqrt(mse * s11 / det), d FROM fit)",
    # P(|T| > t) by the finite series of the t distribution, even and odd degrees.
    "angles AS (SELECT *, coef / std_err AS t, atan(abs(coef / std_err) / sqrt(d)) AS a FROM terms)",
    "series AS (SELECT term, coalesce(sum(exp(lg + p * ln(cos(a)))), 0) AS total FROM angles, LATERAL ("
    " SELECT CASE WHEN CAST(d AS BIGINT) % 2 = 0 THEN 2 * k ELSE 2 * k + 1 END AS p,"
    " coalesce(sum(CASE WHEN CAST(d AS BIGINT) % 2 = 0 THEN ln((2.0 * k - 1) / (2.0 * k)) ELSE ln(2.0 * k / (2.0 * k + 1)) END)"
    " FILTER (k > 0) OVER (ORDER BY k), 0) AS lg FROM range(0, CAST(CASE WHEN CAST(d AS BIGINT) % 2 = 0 THEN d / 2"
    " ELSE (d - 1) / 2 END AS BIGINT)) AS r(k)) GROUP BY term)",
    "coefficients AS (SELECT angles.*, t95, 1 - CASE WHEN CAST(d AS BIGINT) % 2 = 0 THEN sin(a) * total"
    " ELSE 2 / pi() * (a + sin(a) * total) END AS p_value FROM angles JOIN series USING (term), student)",
    "quality AS (SELECT *, 1 - rss / syy AS r2, (syy - rss) / 2 / mse AS f,"
    " -n / 2 * (ln(2 * pi()) + ln(rss / n) + 1) AS ll FROM fit)",
]
QUALITY = [
    ("n", "n"), ("df_model", "2.0"), ("df_residual", "d"), ("r2", "r2"),
    ("adj_r2", "1 - (1 - r2) * (n - 1) / d"), ("f", "f"), ("f_p_value", "pow(d / (d + 2 * f), d / 2)"),
    ("log_likelihood", "ll"), ("aic", "-2 * ll + 6"), ("bic", "-2 * ll + 3 * ln(n)"),
]
RESIDUALS = [
    *FIT,
    "resid AS (SELECT cases.code, y - b0 - b1 * x1 - b2 * x2 AS e FROM cases, fit)",
    "mean_e AS (SELECT avg(e) AS me FROM resid)",
    "mom AS (SELECT CAST(count(*) AS DOUBLE) AS n, avg((e - me)**2) AS m2, avg((e - me)**3) AS m3, avg((e - me)**4) AS m4"
    " FROM resid, mean_e)",
    "sk AS (SELECT n, m3 / m2**1.5 AS g, m4 / (m2 * m2) AS k FROM mom)",
    "zz AS (SELECT *, g * sqrt((n+1)*(n+3) / (6*(n-2))) AS yy,"
    " 3*(n*n + 27*n - 70)*(n+1)*(n+3) / ((n-2)*(n+5)*(n+7)*(n+9)) AS beta,"
    " (k - 3*(n-1)/(n+1)) / sqrt(24*n*(n-2)*(n-3) / ((n+1)**2*(n+3)*(n+5))) AS xx,"
    " 6*(n*n - 5*n + 2) / ((n+7)*(n+9)) * sqrt(6*(n+3)*(n+5) / (n*(n-2)*(n-3))) AS q FROM sk)",
    "z2 AS (SELECT *, sqrt(2*(beta - 1)) - 1 AS w2, 6 + 8/q * (2/q + sqrt(1 + 4/(q*q))) AS a FROM zz)",
    "z3 AS (SELECT *, asinh(yy / sqrt(2/(w2 - 1))) / sqrt(0.5 * ln(w2)) AS zs, 1 + xx * sqrt(2/(a - 4)) AS u FROM z2)",
    "diag AS (SELECT *, n/6 * (g*g + (k - 3)**2 / 4) AS jb,"
    " zs**2 + ((1 - 2/(9*a) - sign(u) * cbrt((1 - 2/a) / abs(u))) / sqrt(2/(9*a)))**2 AS omni FROM z3)",
    "steps AS (SELECT e, e - lag(e) OVER (ORDER BY code) AS step FROM resid)",
    "dw AS (SELECT sum(step * step) / sum(e * e) AS dw FROM steps)",
]
DIAGNOSTICS = [
    ("skewness", "g"), ("kurtosis", "k"), ("jarque_bera", "jb"), ("jarque_bera_p", "exp(-jb / 2)"),
    ("omnibus", "omni"), ("omnibus_p", "exp(-omni / 2)"),
]
# Largest eigenvalue of a symmetric 3 x 3 matrix, for the Gram matrix and its inverse.
CONDITION = [
    *FIT,
    "gram AS (SELECT 'g' AS which, n AS a, n*m1 AS b, n*m2 AS c, s11 + n*m1*m1 AS d2, s12 + n*m1*m2 AS e2, s22 + n*m2*m2 AS f2"
    " FROM fit UNION ALL SELECT 'i', 1/n + (m1*m1*s22 - 2*m1*m2*s12 + m2*m2*s11)/det, -(m1*s22 - m2*s12)/det,"
    " -(m2*s11 - m1*s12)/det, s22/det, -s12/det, s11/det FROM fit)",
    "eig1 AS (SELECT *, (a + d2 + f2) / 3 AS q FROM gram)",
    "eig2 AS (SELECT *, sqrt(((a-q)**2 + (d2-q)**2 + (f2-q)**2 + 2*(b*b + c*c + e2*e2)) / 6) AS p FROM eig1)",
    "eig3 AS (SELECT *, (((a-q)/p)*(((d2-q)/p)*((f2-q)/p) - (e2/p)*(e2/p)) - (b/p)*((b/p)*((f2-q)/p) - (e2/p)*(c/p))"
    " + (c/p)*((b/p)*(e2/p) - ((d2-q)/p)*(c/p))) / 2 AS r FROM eig2)",
    "eig AS (SELECT q + 2 * p * cos(acos(greatest(-1.0, least(1.0, r))) / 3) AS top FROM eig3)",
    "cond AS (SELECT sqrt(max(top) * min(top)) AS cond FROM eig)",
]
named(
    "ols_fit",
    FIT,
    f"SELECT CAST(n AS BIGINT) AS n, {', '.join(f'{sig(c, 8)} AS {c}' for c in ('b0', 'b1', 'b2', 'rss'))} FROM fit",
)
BOUNDS = [("coef", "coef"), ("std_err", "std_err"), ("t", "t"), ("low", "coef - t95 * std_err"), ("high", "coef + t95 * std_err")]
named(
    "ols_coefficients",
    FIT,
    f"SELECT term, {', '.join(f'{sig(v, 8)} AS {n}' for n, v in BOUNDS)}, round(p_value, 8) + 0.0 AS p_value FROM coefficients",
)
named(
    "ols_quality",
    FIT,
    " UNION ALL ".join(f"SELECT '{n}' AS stat, {sig(v, 8)} AS value FROM quality" for n, v in QUALITY),
)
named(
    "residual_diagnostics",
    RESIDUALS,
    " UNION ALL ".join(f"SELECT '{n}' AS stat, {sig(v, 8)} AS value FROM diag" for n, v in DIAGNOSTICS),
)
named("durbin_watson", RESIDUALS, f"SELECT {sig('dw')} AS durbin_watson FROM dw")
named("condition_number", CONDITION, f"SELECT {sig('cond', 8)} AS condition_number FROM cond")
ANOVA = (
    "anova AS (SELECT term, t * t * mse AS sum_sq, CAST(1 AS DOUBLE) AS df, t * t AS f, p_value"
    " FROM coefficients, (SELECT mse FROM fit) WHERE term <> 'Intercept'"
    " UNION ALL SELECT 'Residual', rss, d, NULL, NULL FROM fit)"
)
named(
    "anova_type2",
    [*FIT, ANOVA],
    f"SELECT term, {sig('sum_sq', 8)} AS sum_sq, df, {sig('f', 8)} AS f, round(p_value, 8) + 0.0 AS p_value FROM anova",
)
# Of two equal predictors each has half the coefficient and its error. The intercept and a column of twos share what
# the intercept had: 1/5 and 2/5 are the shortest pair with b + 2 c fixed.
SHARED = (
    "shared AS (SELECT term, coef * part AS coef, std_err * part AS std_err, t, t95, p_value FROM (SELECT *, CASE term"
    " WHEN 'Intercept' THEN CAST(0.2 AS DOUBLE) WHEN 'gdp' THEN 0.5 ELSE 1 END AS part FROM coefficients)"
    " UNION ALL SELECT 'gdp_again', coef / 2, std_err / 2, t, t95, p_value FROM coefficients WHERE term = 'gdp'"
    " UNION ALL SELECT 'level', coef * 2 / 5, std_err * 2 / 5, t, t95, p_value FROM coefficients WHERE term = 'Intercept')"
)
named(
    "ols_superfluous",
    [*FIT, SHARED],
    f"SELECT term, {', '.join(f'{sig(v, 8)} AS {n}' for n, v in BOUNDS)}, round(p_value, 8) + 0.0 AS p_value FROM shared",
)
named(
    "ols_superfluous_quality",
    FIT,
    " UNION ALL ".join(f"SELECT '{n}' AS stat, {sig(v, 8)} AS value FROM quality" for n, v in QUALITY),
)
named(
    "anova_superfluous",
    [*FIT, SHARED],
    f"SELECT term, {sig('t * t * mse', 8)} AS sum_sq, {sig('t * t', 8)} AS f, CAST(1 AS DOUBLE) AS df, round(p_value, 8) + 0.0 AS p_value"
    " FROM shared, (SELECT mse FROM fit) WHERE term <> 'Intercept'"
    f" UNION ALL SELECT 'Residual', {sig('rss', 8)}, NULL, d, NULL FROM fit",
)
named(
    "report_tables",
    [*CONDITION, *RESIDUALS[len(FIT):], ANOVA],
    " UNION ALL ".join(
        [
            f"SELECT 'correlation' AS report, '{x}|{y}' AS item, 'r' AS stat, {sig(correlation(x, y), 8)} AS value FROM clean"
            for x in CORRELATED
            for y in CORRELATED
        ]
        + [f"SELECT 'anova', term, '{c}', {sig(c, 8)} FROM anova" for c in ("sum_sq", "df", "f")]
        + ["SELECT 'anova', term, 'p_value', round(p_value, 8) + 0.0 FROM anova"]
        + [f"SELECT 'model', term, '{n}', {sig(v, 8)} FROM coefficients" for n, v in BOUNDS]
        + ["SELECT 'model', term, 'p_value', round(p_value, 8) + 0.0 FROM coefficients"]
        + [f"SELECT 'model', 'model', '{n}', {f'round({v}, 8)' if n == 'f_p_value' else sig(v, 8)} FROM quality" for n, v in QUALITY]
        + [f"SELECT 'model', 'model', '{n}', {f'round({v}, 8)' if n.endswith('_p') else sig(v, 8)} FROM diag" for n, v in DIAGNOSTICS]
        + [f"SELECT 'model', 'model', 'durbin_watson', {sig('dw', 8)} FROM dw"]
        + [f"SELECT 'model', 'model', 'condition_number', {sig('cond', 8)} FROM cond"]
    ),
)

# --- charts -----------------------------------------------------------------

CHARTED = ("idhm", "revenue", "gdp", "burden")


def charted(columns: tuple[str, ...], trimmed: tuple[str, ...] = ()) -> list[str]:
    """(variable, v) rows of the charted columns and their ranges."""
    parts = []
    for c in columns:
        cut = f" AND {c} <= (SELECT quantile_cont({c}, 0.95) FROM clean)" if c in trimmed else ""
        parts.append(f"SELECT '{c}' AS variable, {c} AS v FROM clean WHERE {c} IS NOT NULL{cut}")
    return [
        f"long AS ({' UNION ALL '.join(parts)})",
        "spread AS (SELECT variable, count(*) AS n, min(v) AS lo, max(v) AS hi, stddev_samp(v) AS sd FROM long GROUP BY variable)",
    ]


# Bin i holds lo + i*w <= v < lo + (i+1)*w with w = (hi-lo)/100; the last one holds hi too.
BINNED = [
    "edges AS (SELECT variable, lo, hi, (hi - lo) / 100 AS w, CAST(i AS INTEGER) AS bin,"
    " lo + i * ((hi - lo) / 100) AS low, lo + (i + 1) * ((hi - lo) / 100) AS high FROM spread, range(100) AS r(i))",
    "binned AS (SELECT e.variable, e.bin, any_value(e.low) AS low, CAST(count(l.v) AS BIGINT) AS rows FROM edges e"
    " LEFT JOIN long l ON l.variable = e.variable AND l.v >= e.low AND (l.v < e.high OR e.bin = 99)"
    " GROUP BY e.variable, e.bin)",
]
CURVE = [
    "grid AS (SELECT variable, lo, hi, sd * pow(n, -0.2) AS h, CAST(i AS INTEGER) AS position,"
    " lo + (hi - lo) * i / 199 AS g FROM spread, range(200) AS r(i))",
    "curve AS (SELECT grid.variable, position, any_value(g) AS x, sum(exp(-0.5 * ((g - v) / h) * ((g - v) / h)))"
    " * any_value((hi - lo) / 100 / (h * sqrt(2 * pi()))) AS y FROM grid JOIN long ON long.variable = grid.variable"
    " GROUP BY grid.variable, position)",
]
TREND = [
    "pts AS (SELECT code, burden AS x, idhm AS y FROM clean WHERE burden IS NOT NULL AND idhm IS NOT NULL)",
    "line AS (SELECT regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept, regr_r2(y, x) AS r2,"
    " CAST(regr_count(y, x) AS BIGINT) AS n, min(x) AS x_min, max(x) AS x_max, avg(x) AS mx, avg(y) AS my FROM pts)",
    "trend AS (SELECT CAST(i AS INTEGER) AS position, x_min + (x_max - x_min) * i / 99 AS x,"
    " intercept + slope * (x_min + (x_max - x_min) * i / 99) AS y FROM line, range(100) AS r(i))",
]
MODULUS = 2_147_483_647
# Weight = number of cumulative Poisson(1) probabilities at or below the draw.
BAND = [
    "pmf AS (SELECT k, exp(-1.0) / factorial(CAST(k AS INTEGER)) AS p FROM range(0, 13) AS r(k))",
    f"cdf AS (SELECT k, CAST(floor(sum(p) OVER (ORDER BY k) * {MODULUS}) AS BIGINT) AS bound FROM pmf)",
    f"bounds AS (SELECT list(bound ORDER BY k) AS bs FROM cdf WHERE bound < {MODULUS - 1})",
    f"hashed AS (SELECT 1 AS s, x - mx AS su, y - my AS sv, (x - mx) * (x - mx) AS suu, (x - mx) * (y - my) AS suv,"
    f" 1 + CAST('0x' || substr(md5(code), 1, 8) AS BIGINT) % {MODULUS - 1} AS a,"
    f" CAST('0x' || substr(md5(code), 9, 8) AS BIGINT) % {MODULUS} AS b FROM pts, line)",
    f"drawn AS (SELECT CAST(rep AS BIGINT) AS rep, s, su, sv, suu, suv, CAST(len(list_filter(bs, lambda t: t <= (a * rep + b) % {MODULUS})) AS DOUBLE)"
    " AS w FROM hashed, range(1000) AS r(rep), bounds)",
    "sums AS (SELECT rep, sum(w*s) AS s, sum(w*su) AS su, sum(w*sv) AS sv, sum(w*suu) AS suu, sum(w*suv) AS suv FROM drawn GROUP BY rep)",
    "lines AS (SELECT (s*suv - su*sv) / (s*suu - su*su) AS slope, (sv - (s*suv - su*sv) / (s*suu - su*su) * su) / s AS height"
    " FROM sums WHERE s*suu - su*su <> 0)",
    "band AS (SELECT position, any_value(x) AS x, quantile_cont(my + height + lines.slope * (x - mx), 0.025) AS low,"
    " quantile_cont(my + height + lines.slope * (x - mx), 0.975) AS high FROM trend, lines, (SELECT mx, my FROM line) GROUP BY position)",
]
named(
    "scatter_sample",
    [*CLEAN, *TREND],
    f"SELECT x, y FROM pts ORDER BY md5(code), x, y LIMIT {SCATTER_POINTS}",
)
# Entries of the embeddings by thousandths; every seventh is taken as missing.
WIDE = [
    "long AS (SELECT vec_id, CAST(i AS INTEGER) AS i, CAST(floor(1000 * CAST(embedding[i + 1] AS DOUBLE)) AS DOUBLE) AS v"
    f" FROM embeddings, range({RING_VERTICES}) AS r(i))",
    "value AS (SELECT vec_id, i, CASE WHEN CAST(v AS BIGINT) % 7 <> 0 THEN v END AS v FROM long)",
]
named(
    "corr_wide",
    WIDE,
    "SELECT 'e' || a.i AS var_x, 'e' || b.i AS var_y,"
    f" {sig('corr(a.v, b.v)')} AS r, CAST(count(*) FILTER (a.v IS NOT NULL AND b.v IS NOT NULL) AS BIGINT) AS pairs"
    " FROM value a JOIN value b ON a.vec_id = b.vec_id AND a.i <= b.i GROUP BY a.i, b.i",
)
named("histogram_100", [*CLEAN, *charted(CHARTED), *BINNED], "SELECT variable, bin, rows FROM binned")
TRIMMED = ("revenue", "gdp")
named("histogram_trimmed", [*CLEAN, *charted(TRIMMED, TRIMMED), *BINNED], "SELECT variable, bin, rows FROM binned")
named(
    "kde_curve",
    [*CLEAN, *charted(CHARTED), *CURVE],
    f"SELECT variable, position, {sig('x')} AS x, {sig('y', 8)} AS y FROM curve",
)
named("trend_line", [*CLEAN, *TREND], f"SELECT position, {sig('x')} AS x, {sig('y', 8)} AS y FROM trend")
named(
    "trend_line_fit",
    [*CLEAN, *TREND],
    f"SELECT n, {', '.join(f'{sig(c, 8)} AS {c}' for c in ('slope', 'intercept', 'r2', 'x_min', 'x_max'))} FROM line",
)
named(
    "trend_band",
    [*CLEAN, *TREND, *BAND],
    f"SELECT position, {', '.join(f'{sig(c, 8)} AS {c}' for c in ('x', 'low', 'high'))} FROM band",
)


def chart(name: str, series: str, x: str, y: str, table: str) -> str:
    return (
        f"SELECT '{name}' AS chart, {series} AS series, CAST({x} AS DOUBLE) AS x,"
        f" {sig(f'CAST({y} AS DOUBLE)', 8)} AS y FROM {table}"
    )


named(
    "chart_data",
    [*CLEAN, *charted(CHARTED, TRIMMED), *BINNED, *CURVE, *TREND, *BAND],
    " UNION ALL ".join(
        [
            chart("histogram", "variable", "low", "rows", "binned"),
            chart("density", "variable", "x", "y", "curve"),
            chart("scatter", "'idhm~burden'", "x", "y", "pts"),
            chart("trend", "'idhm~burden'", "x", "y", "trend"),
            chart("band_low", "'idhm~burden'", "x", "low", "band"),
            chart("band_high", "'idhm~burden'", "x", "high", "band"),
        ]
        + [
            f"SELECT 'heatmap', '{x}|{y}', CAST(NULL AS DOUBLE), {sig(correlation(x, y), 8)} FROM clean"
            for x in CORRELATED
            for y in CORRELATED
        ]
    ),
)

# --- geometry: recursive halving at the farthest vertex ---------------------

DX, DY = "(b.x - a.x)", "(b.y - a.y)"
ALONG = (
    f"CASE WHEN {DX} * {DX} + {DY} * {DY} = 0 THEN 0 ELSE greatest(0, least(1, ((p.x - a.x) * {DX} + (p.y - a.y) * {DY})"
    f" / ({DX} * {DX} + {DY} * {DY}))) END"
)
def halving(tolerance: float) -> list[str]:
    """The sections that halving a vertex table ends with and goes through, and the vertices it keeps."""
    return [
    "section AS ("
    f"SELECT DISTINCT vec_id, 0 AS i, {RING_VERTICES} AS j FROM vertex"
    " UNION ALL"
    " SELECT vec_id, CASE WHEN side = 0 THEN i ELSE k END, CASE WHEN side = 0 THEN k ELSE j END FROM ("
    "SELECT s.vec_id, s.i, s.j, arg_max(p.i, sqrt((p.x - a.x - t * ex) ** 2 + (p.y - a.y - t * ey) ** 2)) AS k,"
    " max(sqrt((p.x - a.x - t * ex) ** 2 + (p.y - a.y - t * ey) ** 2)) AS far"
    " FROM section s JOIN vertex a ON a.vec_id = s.vec_id AND a.i = s.i"
    " JOIN vertex b ON b.vec_id = s.vec_id AND b.i = s.j"
    " JOIN vertex p ON p.vec_id = s.vec_id AND p.i > s.i AND p.i < s.j,"
    f" LATERAL (SELECT {ALONG} AS t, {DX} AS ex, {DY} AS ey)"
    f" GROUP BY s.vec_id, s.i, s.j HAVING far > {tolerance}), range(2) AS r(side))",
    "kept_at AS (SELECT DISTINCT vec_id, i FROM section UNION SELECT vec_id, j FROM section)",
    "kept AS (SELECT vertex.* FROM vertex JOIN kept_at USING (vec_id, i))",
    ]


SIMPLIFIED = [RING, *halving(TOLERANCE), *outline("kept", "small")]

# Walks along the entries, and every shortcut against every piece before and after that lies outside it.
STEP = f"CAST(floor(1000 * CAST(embedding[(k % {RING_VERTICES}) + 1] AS DOUBLE)) AS BIGINT)"
WALK = [
    f"step AS (SELECT vec_id, CAST(k AS INTEGER) AS k, {STEP} AS z FROM embeddings, range({RING_VERTICES + 9}) AS r(k))",
    f"vertex AS (SELECT a.vec_id, a.k AS i, CAST(sum(b.z) FILTER (b.k <= a.k) AS DOUBLE) AS x,"
    " CAST(sum(b.z) FILTER (b.k > a.k) AS DOUBLE) AS y"
    f" FROM step a JOIN step b ON a.vec_id = b.vec_id AND b.k <= a.k + 8 WHERE a.k <= {RING_VERTICES} GROUP BY a.vec_id, a.k)",
    *halving(WALK_TOLERANCE),
    "next AS (SELECT vec_id, i AS a, lead(i) OVER (PARTITION BY vec_id ORDER BY i) AS b FROM kept)",
    f"piece AS (SELECT vec_id, i AS a, i + 1 AS b FROM vertex WHERE i < {RING_VERTICES} UNION SELECT vec_id, a, b FROM next WHERE b > a + 1)",
    "line AS (SELECT p.vec_id, p.a, p.b, s.x AS ax, s.y AS ay, t.x AS bx, t.y AS by FROM piece p"
    " JOIN vertex s ON s.vec_id = p.vec_id AND s.i = p.a JOIN vertex t ON t.vec_id = p.vec_id AND t.i = p.b)",
]


def turn(p: str, q: str, r: str) -> str:
    return f"sign(({q}x - {p}x) * ({r}y - {p}y) - ({q}y - {p}y) * ({r}x - {p}x))"


def inside(p: str, q: str, r: str) -> str:
    dx, dy = f"({q}x - {p}x)", f"({q}y - {p}y)"
    reach = f"(({r}x - {p}x) * {dx} + ({r}y - {p}y) * {dy})"
    return f"({turn(p, q, r)} = 0 AND {reach} > 0 AND {reach} < {dx} * {dx} + {dy} * {dy})"


MEET = (
    f"({turn('c.a', 'c.b', 'o.a')} * {turn('c.a', 'c.b', 'o.b')} < 0 AND {turn('o.a', 'o.b', 'c.a')} * {turn('o.a', 'o.b', 'c.b')} < 0)"
    f" OR {inside('c.a', 'c.b', 'o.a')} OR {inside('c.a', 'c.b', 'o.b')} OR {inside('o.a', 'o.b', 'c.a')} OR {inside('o.a', 'o.b', 'c.b')}"
)
named(
    "outline_conflicts",
    [
        *WALK,
        "met AS (SELECT DISTINCT c.vec_id, c.a, c.b FROM line c JOIN line o ON c.vec_id = o.vec_id AND c.b > c.a + 1"
        f" AND (o.b <= c.a OR o.a >= c.b) WHERE {MEET})",
        "held AS (SELECT vec_id, CAST(count(*) AS INTEGER) AS kept FROM kept GROUP BY vec_id)",
        "hit AS (SELECT vec_id, count(*) AS n FROM met GROUP BY vec_id)",
    ],
    "SELECT held.vec_id, kept, coalesce(n, 0) AS meeting FROM held LEFT JOIN hit ON held.vec_id = hit.vec_id",
)
named(
    "simplify_polylines",
    [*SIMPLIFIED, *outline("vertex", "ring")],
    "SELECT ring.code, ring.points, small.points AS kept, round(small.coordinate_sum, 8) AS coordinate_sum,"
    f" {sig('small.area')} AS area FROM ring JOIN small ON ring.code = small.code",
)
for name in ("sink_serving_table", "serving"):
    named(
        name,
        [*GOLD, *SIMPLIFIED],
        f"SELECT CAST(gold.code AS BIGINT) AS code, name, gdp, {BURDEN}, data_status, \"UF\", points,"
        f" {sig('area')} AS area FROM gold LEFT JOIN small ON CAST(gold.code AS BIGINT) = small.code",
    )

# The run without the territory names; stray revenue rows are rejected without a code, and repeat the codes of a region.
STRAY = "SELECT CAST(n_nationkey AS VARCHAR) AS code, CAST(round_even((n_nationkey + 1000.125) * 100.0, 0) AS DOUBLE) / 100.0 AS revenue FROM nation WHERE n_regionkey = 1"
RUN = [
    c.replace("revenue AS (SELECT", "own_revenue AS (SELECT", 1) + f", revenue AS (SELECT * FROM own_revenue UNION ALL {STRAY})"
    if c.startswith("revenue AS")
    else c.replace("c_name AS name FROM customer", "CAST(NULL AS VARCHAR) AS name FROM customer")
    for c in GOLD
]
NOTHING = "CAST(NULL AS VARCHAR) AS name, CAST({0} AS BIGINT) AS population, CAST(NULL AS DOUBLE) AS idhm, CAST(NULL AS DOUBLE) AS revenue, CAST(NULL AS DOUBLE) AS gdp, CAST(NULL AS DOUBLE) AS burden, CAST(NULL AS VARCHAR) AS burden_class, {1} AS data_status"
named(
    "whole_run",
    RUN,
    f"SELECT 'gold' AS part, code AS item, name, population, idhm, revenue, gdp, {BURDEN}, data_status FROM gold"
    + "".join(
        f" UNION ALL SELECT 'status', '{item}', {NOTHING.format('NULL', repr(state))}"
        for item, state in [("source name", "failed"), *((f"step {s}", "done") for s in ("gold", "summary", "analysis", "charts"))]
    )
    + "".join(
        f" UNION ALL SELECT 'rows', '{stage}', {NOTHING.format(count, 'CAST(NULL AS VARCHAR)')}"
        for stage, count in (
            ("gold", "(SELECT count(*) FROM gold)"),
            ("silver revenue", "(SELECT count(*) FROM revenue)"),
            ("rejects revenue", "(SELECT count(*) FROM nation WHERE n_regionkey = 0)"),
        )
    ),
)
