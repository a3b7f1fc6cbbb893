"""SQL that recomputes the registered queries on the given tables.

The feature table and the preparation are written out independently of the
Spark code: plain joins, DISTINCT counts, window functions and built-in
quantiles.
"""

from __future__ import annotations

from tenurecast import schema
from tenurecast.sources.standin import BUSINESSES, RAW_INDUSTRIES, RAW_TITLES

YEAR = {"gregorian": "CAL_YEAR", "fiscal": "FISCAL_YEAR"}
SHIFT = {"gregorian": 0, "fiscal": 6}

DESCRIPTION = ["HOME_COUNTRY_CODE", "HOME_STATE_PROVINCE", "HIRE_AS_OF_DATE"]
CATEGORIES = ["TITLE_CATEGORY_YR_END", "INDUSTRY", "OWNERSHIP"]
MEASURES = [
    "PR_TARGET_USD",
    "SALARY_USD",
    "COUNT_MONTH_EMPLOYED_TIL_DEC",
    "COUNT_MONTHS_GOT_PAYMENT",
    "LAST_PAYMENT_UNTIL_YR_END",
    "YEAR_PAYMENT",
    "COUNT_UNIQ_QUOTA",
    "COUNT_AVG_MONTH_PAID_QUOTA",
    "LAST_QUOTA_PAID_UNTIL_YR_END",
    "SUM_CREDIT_AMT_USD",
    "MIN_CREDIT_AMT_USD",
    "MAX_QUOTA_AMT_USD",
    "MIN_QUOTA_AMT_USD",
    "COUNT_MAX_MONTH_ORDER",
    "COUNT_MIN_MONTH_ORDER",
    "COUNT_UNIQ_TITLE_NAME",
    "COUNT_UNIQ_MGR_ID",
    "COMP_AVG_MONTH_PAYEECOUNT",
]
LEVELS = {
    "TITLE_CATEGORY_YR_END": sorted(schema.TITLE_GROUPS),
    "INDUSTRY": sorted(schema.INDUSTRY_GROUPS),
    "OWNERSHIP": ["Private", "Public"],
}
FEATURES = schema.NUMERIC_FEATURES
SOURCES = [
    c for f in FEATURES for c in (schema.DIFFERENCES[f] if f in schema.DIFFERENCES else (f,))
]


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def texts(values: list[str]) -> str:
    return "[" + ", ".join(text(v) for v in values) + "]"


def keys(calendar: str) -> str:
    return f"BUSINESS_ID, {YEAR[calendar]}, TERM_AS_OF_DATE, MASTER_PARTICIPANT_ID"


def grain(calendar: str) -> str:
    return f"BUSINESS_ID, MASTER_PARTICIPANT_ID, {YEAR[calendar]}"


def name(feature: str, level: str) -> str:
    return f'"{feature}_{level}"'


def indicator_names(levels: dict[str, list[str]] | None = None) -> list[str]:
    return [name(f, v) for f, values in (levels or LEVELS).items() for v in values]


def features(calendar: str = "gregorian", suffix: str = "") -> str:
    """CTEs ending in ``features``: one row per customer and year."""
    year, shift, x = YEAR[calendar], SHIFT[calendar], suffix
    return f"""
o{x} AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority,
         CAST(o_orderdate AS DATE) AS d,
         year(o_orderdate + INTERVAL {shift} MONTH) AS y,
         month(o_orderdate + INTERVAL {shift} MONTH) AS mo,
         CAST(round(o_totalprice * 100) AS BIGINT) AS cents
  FROM orders),
per_month{x} AS (SELECT o_custkey, y, mo, count(*) AS n FROM o{x} GROUP BY ALL),
months{x} AS (
  SELECT o_custkey, y, min(mo) AS mo_min, max(mo) AS mo_max, count(*) AS used,
         max(n) AS busiest, min(n) AS quietest
  FROM per_month{x} GROUP BY ALL),
per_year{x} AS (
  SELECT o_custkey, y, max(d) AS last_d, CAST(sum(cents) AS DOUBLE) / 100 AS total,
         CAST(max(cents) AS DOUBLE) / 100 AS largest, CAST(min(cents) AS DOUBLE) / 100 AS smallest,
         CAST(sum(cents) FILTER (WHERE o_orderstatus <> 'P') AS DOUBLE) / 100
           / nullif(count(*) FILTER (WHERE o_orderstatus <> 'P'), 0) AS paid_avg,
         max(mo) FILTER (WHERE o_orderstatus <> 'F') AS last_quota,
         CAST(max(cents) FILTER (WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F')
           AS DOUBLE) / 100 AS payee,
         count(DISTINCT o_orderpriority) AS priorities, count(DISTINCT o_orderstatus) AS statuses
  FROM o{x} GROUP BY ALL),
last_order{x} AS (
  SELECT o_custkey, y, o_orderkey FROM o{x}
  QUALIFY row_number() OVER (PARTITION BY o_custkey, y ORDER BY d DESC, o_orderkey DESC) = 1),
hired{x} AS (SELECT o_custkey, min(d) AS first_d FROM o{x} GROUP BY ALL),
lines{x} AS (
  SELECT o_custkey, y, l_suppkey, l_returnflag, CAST(round(l_extendedprice * 100) AS BIGINT) AS c
  FROM lineitem JOIN o{x} ON l_orderkey = o_orderkey),
line_year{x} AS (
  SELECT o_custkey, y, CAST(sum(c) AS DOUBLE) / 100 AS paid,
         CAST(sum(c) FILTER (WHERE l_returnflag = 'R') AS DOUBLE) / 100 AS credit,
         CAST(min(c) FILTER (WHERE l_returnflag = 'R') AS DOUBLE) / 100 AS credit_min,
         count(DISTINCT l_suppkey) AS suppliers
  FROM lines{x} GROUP BY ALL),
features{x} AS (
  SELECT p.o_custkey % {BUSINESSES} AS BUSINESS_ID, CAST(p.y AS INTEGER) AS {year},
         CAST(strftime(p.last_d, '%Y%m%d') AS BIGINT) AS TERM_AS_OF_DATE,
         p.o_custkey AS MASTER_PARTICIPANT_ID,
         n_name AS HOME_COUNTRY_CODE, r_name AS HOME_STATE_PROVINCE,
         CAST(strftime(first_d, '%Y%m%d') AS BIGINT) AS HIRE_AS_OF_DATE,
         ({texts(RAW_TITLES)})[(t.o_orderkey % {len(RAW_TITLES)}) + 1] AS TITLE_CATEGORY_YR_END,
         ({texts(RAW_INDUSTRIES)})[(p.o_custkey % {len(RAW_INDUSTRIES)}) + 1] AS INDUSTRY,
         CASE WHEN c_acctbal < 0 THEN 'Private' WHEN c_acctbal < 500 THEN NULL ELSE 'Public' END
           AS OWNERSHIP,
         total AS PR_TARGET_USD, c_acctbal AS SALARY_USD,
         CAST(13 - mo_min AS DOUBLE) AS COUNT_MONTH_EMPLOYED_TIL_DEC,
         used AS COUNT_MONTHS_GOT_PAYMENT,
         CAST(12 - mo_max AS DOUBLE) AS LAST_PAYMENT_UNTIL_YR_END,
         paid AS YEAR_PAYMENT, CAST(priorities AS DOUBLE) AS COUNT_UNIQ_QUOTA,
         paid_avg AS COUNT_AVG_MONTH_PAID_QUOTA,
         CAST(last_quota AS DOUBLE) AS LAST_QUOTA_PAID_UNTIL_YR_END,
         credit AS SUM_CREDIT_AMT_USD, credit_min AS MIN_CREDIT_AMT_USD,
         largest AS MAX_QUOTA_AMT_USD, smallest AS MIN_QUOTA_AMT_USD,
         CAST(busiest AS DOUBLE) AS COUNT_MAX_MONTH_ORDER,
         CAST(quietest AS DOUBLE) AS COUNT_MIN_MONTH_ORDER,
         statuses AS COUNT_UNIQ_TITLE_NAME, coalesce(suppliers, 0) AS COUNT_UNIQ_MGR_ID,
         payee AS COMP_AVG_MONTH_PAYEECOUNT,
         CAST(CASE WHEN p.y = (SELECT max(y) FROM o{x}) THEN NULL WHEN nx.y IS NULL THEN 1 ELSE 0 END
           AS INTEGER) AS TERM_NEXT_YEAR
  FROM per_year{x} p
  JOIN months{x} m ON m.o_custkey = p.o_custkey AND m.y = p.y
  JOIN last_order{x} t ON t.o_custkey = p.o_custkey AND t.y = p.y
  JOIN hired{x} h ON h.o_custkey = p.o_custkey
  LEFT JOIN line_year{x} l ON l.o_custkey = p.o_custkey AND l.y = p.y
  LEFT JOIN (SELECT o_custkey, y FROM per_year{x}) nx ON nx.o_custkey = p.o_custkey AND nx.y = p.y + 1
  JOIN customer ON c_custkey = p.o_custkey
  LEFT JOIN (nation JOIN region ON n_regionkey = r_regionkey) ON c_nationkey = n_nationkey)"""


def pairs(lookup: dict[str, str]) -> str:
    return ", ".join(f"({text(k)}, {text(v)})" for k, v in lookup.items())


def mapped(calendar: str = "gregorian") -> str:
    """CTE ``mapped``: features with consolidated categories."""
    return f"""{features(calendar)},
titles(raw, new) AS (VALUES {pairs(schema.TITLE_LOOKUP)}),
industries(raw, new) AS (VALUES {pairs(schema.INDUSTRY_LOOKUP)}),
mapped AS (
  SELECT f.* REPLACE (t.new AS TITLE_CATEGORY_YR_END, i.new AS INDUSTRY)
  FROM features f LEFT JOIN titles t ON f.TITLE_CATEGORY_YR_END = t.raw
  LEFT JOIN industries i ON f.INDUSTRY = i.raw)"""


def indicator_columns(levels: dict[str, list[str]] | None = None) -> str:
    return ", ".join(
        f"CAST(coalesce({f} = {text(v)}, false) AS INTEGER) AS {name(f, v)}"
        for f, values in (levels or LEVELS).items()
        for v in values
    )


def fenced(source: str, columns: list[str]) -> str:
    """CTEs ``fences`` and ``fenced``: far values replaced by quartiles."""
    stats = ", ".join(
        f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}, quantile_cont(CAST({c} AS DOUBLE), 0.25) "
        f"AS lo_{c}, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS hi_{c}"
        for c in columns
    )
    replaced = ", ".join(
        f"CASE WHEN {c} >= m_{c} + 3 * s_{c} THEN hi_{c} WHEN {c} <= m_{c} - 3 * s_{c} "
        f"THEN lo_{c} ELSE CAST({c} AS DOUBLE) END AS {c}"
        for c in columns
    )
    return f"""
fences AS (SELECT {stats} FROM {source}),
fenced AS (SELECT s.* REPLACE ({replaced}) FROM {source} s CROSS JOIN fences)"""


def digest(calendar: str) -> str:
    return f"md5(concat_ws('|', {grain(calendar)}, '{schema.SEED}'))"


def split(source: str, calendar: str = "gregorian") -> str:
    """CTE ``split``: exactly a third of the rows, rounded up, is test."""
    return f"""
split AS (
  SELECT *, row_number() OVER (ORDER BY {digest(calendar)}, {grain(calendar)})
    <= ceil(count(*) OVER () / 3.0) AS is_test
  FROM {source})"""


def differences(source: str) -> str:
    return f"""
differenced AS (
  SELECT *, COUNT_MAX_MONTH_ORDER - COUNT_MIN_MONTH_ORDER AS DIFF_MONTH_ORDER,
         MAX_QUOTA_AMT_USD - MIN_QUOTA_AMT_USD AS DIFF_QUOTA_AMT_USD
  FROM {source})"""


def prepared(calendar: str = "gregorian", levels: dict[str, list[str]] | None = None) -> str:
    """CTE ``prepared``: the whole preparation, values rounded to 6 decimals."""
    means = ", ".join(f"avg({c}) AS a_{c}" for c in FEATURES)
    filled = ", ".join(f"coalesce(CAST({c} AS DOUBLE), a_{c}) AS {c}" for c in FEATURES)
    spread = ", ".join(f"avg({c}) AS b_{c}, stddev_pop({c}) AS e_{c}" for c in FEATURES)
    scaled = ", ".join(
        f"round(({c} - b_{c}) / CASE WHEN e_{c} > 0 THEN e_{c} ELSE 1 END, 6) + 0.0 AS {c}"
        for c in FEATURES
    )
    return f"""{mapped(calendar)}, {fenced("mapped", SOURCES)}, {differences("fenced")},
{split("differenced", calendar)},
train_means AS (SELECT {means} FROM split WHERE NOT is_test),
filled AS (SELECT s.* REPLACE ({filled}) FROM split s CROSS JOIN train_means),
train_scales AS (SELECT {spread} FROM filled WHERE NOT is_test),
prepared AS (
  SELECT {keys(calendar)}, {scaled}, {indicator_columns(levels)}, TERM_NEXT_YEAR
  FROM filled CROSS JOIN train_scales)"""


def query(ctes: str, select: str) -> str:
    return f"WITH {ctes}\n{select}"


def regressed(source: str, target: str, p: str, q: str, given: str, name: str) -> str:
    """CTE ``name``: ``source`` whose ``target`` is predicted from ``p`` and ``q`` where ``given`` is unknown."""
    slopes = "spp * sqq - spq * spq"
    return f"""
{name}_sums AS (
  SELECT avg({p}) AS mp, avg({q}) AS mq, avg({target}) AS my, var_pop({p}) AS spp, var_pop({q}) AS sqq,
         covar_pop({p}, {q}) AS spq, covar_pop({p}, {target}) AS spy, covar_pop({q}, {target}) AS sqy
  FROM {source} WHERE {given} IS NOT NULL),
{name} AS (
  SELECT {source}.* REPLACE (CASE WHEN {given} IS NOT NULL THEN {target} ELSE
    my + ({p} - mp) * (spy * sqq - sqy * spq) / ({slopes})
       + ({q} - mq) * (sqy * spp - spy * spq) / ({slopes}) END AS {target})
  FROM {source}, {name}_sums)"""


SCORE = "coalesce(YEAR_PAYMENT, 0) / (SELECT max(YEAR_PAYMENT) FROM features)"

MANIFEST = """
manifest AS (
  SELECT event_id, CASE event_type
    WHEN 'click' THEN 'part_gregorian_pred_' || strftime(ts, '%Y_%m_%d_%H:%M:%S') || '.tsv'
    WHEN 'view' THEN 'part_fiscal_pred_' || strftime(ts, '%Y_%m_%d_%H%M%S')
    WHEN 'purchase' THEN 'part_visual_fiscal_' || strftime(ts, '%Y_%m_%d_%H:%M:%S') || '.tsv'
    WHEN 'error' THEN 'log_file_gregorian_' || strftime(ts, '%Y_%m_%d_%H:%M:%S') || '.tsv'
    ELSE 'part_' || strftime(ts, '%Y_%m_%d') END AS name, event_type, ts
  FROM events),
stamped AS (
  SELECT event_id, name,
    CASE WHEN event_type <> 'signup' THEN date_trunc('minute', ts) END AS run_ts
  FROM manifest)"""


def hash_fold(hex_text: str) -> str:
    rest = "CAST(0 AS BIGINT)"
    for i in range(8):
        chunk = f"CAST('0x' || substr({hex_text}, {8 * i + 1}, 8) AS BIGINT)"
        rest = f"(({rest}) * 4294967296 + {chunk}) % 100000000"
    return rest


def oracle_sql() -> dict[str, str]:
    g = "gregorian"
    every = f"{keys(g)}, {', '.join(DESCRIPTION + CATEGORIES + MEASURES)}, TERM_NEXT_YEAR"
    every_fiscal = every.replace("CAL_YEAR", "FISCAL_YEAR")
    rounded = ", ".join(f"round(CAST({c} AS DOUBLE), 6) + 0.0 AS {c}" for c in MEASURES)
    doubles = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in MEASURES)
    features_out = ", ".join([*FEATURES, *indicator_names(), "TERM_NEXT_YEAR"])
    kept = [c for c in MEASURES if c != "COMP_AVG_MONTH_PAYEECOUNT"]
    profile = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS n_rows, count({c}) AS n_present, "
        f"round(avg(CAST({c} AS DOUBLE)), 4) AS mean, "
        f"round(stddev_pop(CAST({c} AS DOUBLE)), 3) AS deviation FROM mapped"
        for c in MEASURES
    ) + "".join(
        f" UNION ALL SELECT '{c}', count(*), count({c}), NULL, NULL FROM mapped" for c in CATEGORIES
    )
    conditional = {
        "OWNERSHIP": ["Public", "Private"],
        "TITLE_CATEGORY_YR_END": schema.FIXED_TITLES,
        "INDUSTRY": ["SaaS & Cloud"],
    }
    fixed = {
        "TITLE_CATEGORY_YR_END": schema.FIXED_TITLES,
        "INDUSTRY": schema.FIXED_INDUSTRIES,
        "OWNERSHIP": schema.FIXED_OWNERSHIP,
    }
    row_text = " || '|' || ".join(
        f"coalesce(CAST(CAST({c} AS DECIMAL(38, 6)) AS VARCHAR), 'NULL')" for c in
        ("PR_TARGET_USD", "SALARY_USD", "YEAR_PAYMENT", "COUNT_MONTH_EMPLOYED_TIL_DEC",
         "SUM_CREDIT_AMT_USD")
    )
    jitter_score = f"{SCORE} + CAST({hash_fold('digest')} AS DOUBLE) / 100000000 * 0.01"
    fiscal_score = "coalesce(YEAR_PAYMENT, 0) / (SELECT max(YEAR_PAYMENT) FROM features_f)"
    cohort_one = """
kept AS (SELECT BUSINESS_ID FROM features GROUP BY 1 HAVING count(DISTINCT TERM_NEXT_YEAR) >= 2)"""
    cohort_two = """
emptied AS (SELECT BUSINESS_ID FROM features GROUP BY BUSINESS_ID, CAL_YEAR
            HAVING min(TERM_NEXT_YEAR) > 0)"""
    log_rows = {
        "gregorian": ("features", "g"),
        "fiscal": ("features_f", "f"),
    }
    run_log = " UNION ALL ".join(
        f"SELECT '{cal}' AS calendar, {seq} AS seq, '{metric}' AS metric, "
        f"CAST({value} AS DOUBLE) AS value FROM {table}"
        for cal, (table, _) in log_rows.items()
        for seq, metric, value in (
            (0, "rows", "count(*)"),
            (1, "businesses", "count(DISTINCT BUSINESS_ID)"),
            (2, "leavers", "sum(TERM_NEXT_YEAR)"),
        )
    )
    chained = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS n_rows, "
        f"count(*) FILTER (WHERE {c} IS NULL) AS n_filled, CAST(0 AS BIGINT) AS n_missing, "
        f"CAST(0 AS BIGINT) AS n_changed FROM differenced"
        for c in FEATURES
    )
    pay, credit, salary = "YEAR_PAYMENT", "SUM_CREDIT_AMT_USD", "SALARY_USD"
    started = f"""
started AS (
  SELECT {grain(g)}, CAST({salary} AS DOUBLE) AS {salary}, {pay} AS given_pay, {credit} AS given_credit,
         CAST(coalesce({pay}, (SELECT avg({pay}) FROM features)) AS DOUBLE) AS {pay},
         CAST(coalesce({credit}, (SELECT avg({credit}) FROM features)) AS DOUBLE) AS {credit}
  FROM features)"""
    chain = [started]
    for i, source in enumerate(("started", "credit_0")):
        chain.append(regressed(source, pay, salary, credit, "given_pay", f"pay_{i}"))
        chain.append(regressed(f"pay_{i}", credit, salary, pay, "given_credit", f"credit_{i}"))
    both = f"{features(g)}, {features('fiscal', '_f')}"
    return {
        "scan_features": query(features(g), f"SELECT {every} FROM features"),
        "scan_features_fiscal": query(features("fiscal"), f"SELECT {every_fiscal} FROM features"),
        "scan_calendars": query(
            both,
            " UNION ALL ".join(
                f"SELECT '{cal}' AS calendar, {columns.replace(year, year + ' AS YEAR')} FROM {source}"
                for cal, columns, year, source in (
                    ("gregorian", every, "CAL_YEAR", "features"),
                    ("fiscal", every_fiscal, "FISCAL_YEAR", "features_f"),
                )
            ),
        ),
        "run_all_job": query(
            both,
            " UNION ALL ".join(
                f"SELECT '{cal}' AS calendar, BUSINESS_ID, MASTER_PARTICIPANT_ID, {YEAR[cal]} AS YEAR, true AS in_range, "
                f"0.0::DOUBLE AS residue, true AS agreed, 'FALSE' AS flag FROM {source}"
                for cal, source in (("gregorian", "features"), ("fiscal", "features_f"))
            ),
        ),
        "external_training": query(
            features(g), f"SELECT {grain(g)}, true AS in_range, 0.0::DOUBLE AS difference FROM features"
        ),
        "score_only_layout": query(
            features(g),
            f"SELECT {grain(g)}, true AS in_range, 0.0::DOUBLE AS residue, false AS shown, true AS other FROM features",
        ),
        "wide_forest": query(
            features(g),
            f"SELECT {grain(g)}, 500::BIGINT AS n_trees, true AS in_range, 0.0::DOUBLE AS difference FROM features",
        ),
        "scan_pushdown": (
            "SELECT c_mktsegment AS NAME, c_name AS OWNER, "
            "CASE WHEN c_acctbal >= 0 THEN 'TRUE' ELSE 'FALSE' END AS VALUE "
            "FROM customer WHERE c_mktsegment = 'BUILDING'"
        ),
        "tsv_roundtrip": query(features(g), f"SELECT {every} FROM features"),
        "cast_by_name": query(features(g), f"SELECT {every} FROM features"),
        "publish_predictions": query(
            both,
            f"SELECT BUSINESS_ID, MASTER_PARTICIPANT_ID, CAL_YEAR AS run_year, "
            f"round({SCORE}, 9) AS PRED_TERM_PROB, 'gregorian' AS calendar, "
            f"'2024_01_31_101500' AS run_id FROM features UNION ALL "
            f"SELECT BUSINESS_ID, MASTER_PARTICIPANT_ID, FISCAL_YEAR, round({fiscal_score}, 9), "
            f"'fiscal', '2024_01_31_101500' FROM features_f",
        ),
        "scan_source": query(
            features(g),
            f"SELECT {grain(g)}, TERM_NEXT_YEAR FROM features WHERE CAL_YEAR >= 1996 AND OWNERSHIP = 'Private'",
        ),
        "publish_source": query(
            both,
            f"SELECT BUSINESS_ID, MASTER_PARTICIPANT_ID, CAL_YEAR AS run_year, "
            f"round({SCORE}, 9) AS PRED_TERM_PROB, 'gregorian' AS calendar FROM features UNION ALL "
            f"SELECT BUSINESS_ID, MASTER_PARTICIPANT_ID, FISCAL_YEAR, round({fiscal_score}, 9), 'fiscal' "
            f"FROM features_f",
        ),
        "publish_explanations": query(
            features(g), f"SELECT {grain(g)}, 0.0::DOUBLE AS residual FROM features"
        ),
        "explain_paths_checks": query(
            features(g),
            f"SELECT {grain(g)}, 0.0::DOUBLE AS difference, 0.0::DOUBLE AS residue FROM features",
        ),
        "run_metrics": query(
            both,
            " UNION ALL ".join(
                f"SELECT '{cal}' AS calendar, 'publish' AS step, 'predictions_{m}' AS metric, "
                f"CAST({value} AS DOUBLE) AS value FROM (SELECT round({score}, 9) AS score FROM {source})"
                for cal, source, score in (("gregorian", "features", SCORE), ("fiscal", "features_f", fiscal_score))
                for m, value in (
                    ("rows", "count(*)"),
                    ("unscored", "count(*) - count(score)"),
                    ("least", "min(score)"),
                    ("greatest", "max(score)"),
                )
            ),
        ),
        "model_roundtrip": query(
            features(g),
            f"SELECT {grain(g)}, 0.0::DOUBLE AS difference, true AS in_range FROM features",
        ),
        "control_upsert": (
            "SELECT c_name AS NAME, CASE WHEN EXISTS (SELECT 1 FROM orders WHERE "
            "o_custkey = c_custkey) THEN 'FALSE' "
            "WHEN c_acctbal >= 0 THEN 'TRUE' ELSE 'FALSE' END AS VALUE FROM customer "
            "UNION ALL SELECT s_name, 'FALSE' FROM supplier"
        ),
        "replace_partition": query(
            features(g),
            f"SELECT {grain(g)}, CASE WHEN CAL_YEAR % 2 = 0 THEN 0.0 ELSE round({SCORE}, 9) END "
            f"AS PRED_TERM_PROB FROM features",
        ),
        "delete_where": query(
            features(g),
            f"SELECT {grain(g)}, OWNERSHIP FROM features WHERE OWNERSHIP IS DISTINCT FROM 'Private'",
        ),
        "delete_partition": query(
            features(g),
            f"SELECT {grain(g)}, OWNERSHIP, CAL_YEAR IN (SELECT CAL_YEAR FROM features "
            "WHERE CAL_YEAR % 2 = 0 AND OWNERSHIP = 'Private') AS rewritten FROM features "
            "WHERE CAL_YEAR % 2 = 1 OR OWNERSHIP IS DISTINCT FROM 'Private'",
        ),
        "run_log": query(both, run_log),
        "state_roundtrip": query(
            prepared(g), f"SELECT {keys(g)}, {features_out} FROM prepared"
        ),
        "prepare_training": query(
            prepared("fiscal", conditional),
            f"SELECT {keys('fiscal')}, "
            f"{', '.join([*FEATURES, *indicator_names(conditional), 'TERM_NEXT_YEAR'])} "
            f"FROM prepared",
        ),
        "key_projection": query(features(g), f"SELECT {keys(g)} FROM features"),
        "drop_sparse_columns": query(
            mapped(g), f"SELECT {keys(g)}, {', '.join(CATEGORIES + kept)}, TERM_NEXT_YEAR FROM mapped"
        ),
        "rename_calendar": query(
            features("fiscal"),
            "SELECT BUSINESS_ID, MASTER_PARTICIPANT_ID, FISCAL_YEAR AS CAL_YEAR, TERM_AS_OF_DATE, "
            "TERM_NEXT_YEAR FROM features",
        ),
        "select_features": query(
            f"{mapped(g)}, {differences('mapped')}",
            f"SELECT {keys(g)}, {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in FEATURES)}, "
            f"{indicator_columns()}, TERM_NEXT_YEAR FROM differenced",
        ),
        "conditional_levels": query(
            mapped(g), f"SELECT {grain(g)}, {indicator_columns(conditional)} FROM mapped"
        ),
        "align_levels": query(
            features(g), f"SELECT {grain(g)}, {indicator_columns(fixed)} FROM features"
        ),
        "cohort_both_labels": query(
            f"{features(g)}, {cohort_one}",
            f"SELECT {grain(g)}, TERM_NEXT_YEAR FROM features JOIN kept USING (BUSINESS_ID) "
            f"WHERE TERM_NEXT_YEAR IS NOT NULL",
        ),
        "cohort_no_empty_year": query(
            f"{features(g)}, {cohort_one}, {cohort_two}",
            f"SELECT {grain(g)}, TERM_NEXT_YEAR FROM features JOIN kept USING (BUSINESS_ID) "
            f"WHERE TERM_NEXT_YEAR IS NOT NULL AND BUSINESS_ID NOT IN (SELECT BUSINESS_ID FROM emptied)",
        ),
        "run_gate": """
WITH control AS (
  SELECT c_mktsegment AS NAME, CASE WHEN c_acctbal > 9000 AND c_mktsegment <> 'MACHINERY'
         THEN 'TRUE' ELSE 'FALSE' END AS VALUE FROM customer),
wanted(NAME) AS (VALUES ('BUILDING'), ('MACHINERY'), ('ABSENT')),
flags AS (
  SELECT w.NAME, coalesce(max(c.VALUE), 'FALSE') AS VALUE
  FROM wanted w LEFT JOIN control c USING (NAME) GROUP BY w.NAME)
SELECT NAME, VALUE, remote, VALUE = 'TRUE' OR remote AS run
FROM flags CROSS JOIN (VALUES (false), (true)) r(remote)""",
        "retention_expired": query(
            MANIFEST,
            "SELECT event_id, name FROM stamped WHERE run_ts IS NULL "
            "OR run_ts > TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 14 DAY",
        ),
        "list_runs": query(
            features(g),
            "SELECT 'gregorian' AS calendar, printf('2024_01_%02d_101500', (CAL_YEAR % 7 * 4 + 1)::INT) AS run_id, "
            "CAL_YEAR % 7 * 4 + 1 <= 16 AS expired, count(*) AS n_rows FROM features GROUP BY ALL",
        ),
        "parse_run_stamp": query(
            MANIFEST,
            "SELECT event_id, name, strftime(run_ts, '%Y-%m-%d %H:%M') AS run_ts, "
            "run_ts IS NULL AS malformed, coalesce(run_ts <= "
            "TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 14 DAY, false) AS expired FROM stamped",
        ),
        "join_blocks": query(
            mapped(g), f"SELECT {grain(g)}, {doubles}, {indicator_columns()} FROM mapped"
        ),
        "lookup_broadcast": query(
            f"{features(g)}, titles(raw, new) AS (VALUES {pairs(schema.TITLE_LOOKUP)})",
            f"SELECT {grain(g)}, TITLE_CATEGORY_YR_END, new AS consolidated "
            f"FROM features LEFT JOIN titles ON TITLE_CATEGORY_YR_END = raw",
        ),
        "map_categories": query(
            mapped(g), f"SELECT {grain(g)}, {', '.join(CATEGORIES)} FROM mapped"
        ),
        "label_counts": query(
            features(g),
            "SELECT BUSINESS_ID, CAL_YEAR, TERM_NEXT_YEAR, count(*) AS n FROM features "
            "WHERE TERM_NEXT_YEAR IS NOT NULL GROUP BY ALL",
        ),
        "column_profile": query(mapped(g), profile),
        "level_counts": query(
            mapped(g),
            " UNION ALL ".join(
                f"SELECT '{c}' AS feature, count(DISTINCT {c}) AS n_levels FROM mapped"
                for c in CATEGORIES
            ),
        ),
        "exact_quartiles": query(
            features(g),
            " UNION ALL ".join(
                f"SELECT '{c}' AS column_name, round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 6) "
                f"AS q25, round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 6) AS q75 FROM features"
                for c in MEASURES
            ),
        ),
        "contribution_rollup": query(
            mapped(g),
            f"SELECT {grain(g)}, "
            + ", ".join(
                f"round(CASE {f} "
                + " ".join(
                    f"WHEN {text(v)} THEN SALARY_USD / {i + 2}" for i, v in enumerate(values)
                )
                + f" ELSE 0 END, 6) AS {f}"
                for f, values in LEVELS.items()
            )
            + " FROM mapped",
        ),
        "accuracy": query(
            features(g),
            f"SELECT CAL_YEAR, round(avg(CASE WHEN CAST({SCORE} < 0.25 AS INTEGER) = TERM_NEXT_YEAR "
            f"THEN 1.0 ELSE 0.0 END), 9) AS accuracy, count(*) AS n_rows FROM features "
            f"WHERE TERM_NEXT_YEAR IS NOT NULL GROUP BY CAL_YEAR",
        ),
        "auc_rank_sum": query(
            f"{features(g)}, scored AS (SELECT {SCORE} AS s, TERM_NEXT_YEAR AS l FROM features "
            f"WHERE TERM_NEXT_YEAR IS NOT NULL), ranked AS (SELECT l, (rank() OVER (ORDER BY s)) + (count(*) OVER (PARTITION BY s) - 1) "
            f"/ 2.0 AS r FROM scored), "
            f"sums AS (SELECT sum(r) FILTER (WHERE l = 1) AS rs, count(*) FILTER (WHERE l = 1) AS p, "
            f"count(*) FILTER (WHERE l = 0) AS q FROM ranked)",
            "SELECT round((rs - p * (p + 1) / 2.0) / (CAST(p AS DOUBLE) * q), 9) AS auc, "
            "p AS n_positive, q AS n_negative FROM sums",
        ),
        "union_splits": query(
            features(g),
            f"SELECT {grain(g)}, TERM_NEXT_YEAR, CASE WHEN CAST('0x' || substr({digest(g)}, 1, 8) "
            f"AS BIGINT) % 3 = 0 THEN 'test' ELSE 'train' END AS part FROM features",
        ),
        "split_hash": query(
            features(g),
            f"SELECT {grain(g)}, CAST('0x' || substr({digest(g)}, 1, 8) AS BIGINT) % 3 = 0 "
            f"AS is_test FROM features",
        ),
        "split_exact": query(
            f"{features(g)}, {split('features')}", f"SELECT {grain(g)}, is_test FROM split"
        ),
        "one_hot": query(mapped(g), f"SELECT {grain(g)}, {indicator_columns()} FROM mapped"),
        "difference_features": query(
            f"{features(g)}, {differences('features')}",
            f"SELECT {grain(g)}, DIFF_MONTH_ORDER, round(DIFF_QUOTA_AMT_USD, 4) "
            f"AS DIFF_QUOTA_AMT_USD FROM differenced",
        ),
        "outlier_to_quartile": query(
            f"{features(g)}, {fenced('features', MEASURES)}",
            f"SELECT {grain(g)}, {rounded} FROM fenced",
        ),
        "standardize": query(
            prepared(g), f"SELECT {grain(g)}, {', '.join(FEATURES)} FROM prepared"
        ),
        "mean_impute": query(
            f"{features(g)}, {differences('features')}, {split('differenced')}, "
            f"means AS (SELECT {', '.join(f'avg({c}) AS a_{c}' for c in FEATURES)} FROM split "
            f"WHERE NOT is_test)",
            f"SELECT {grain(g)}, "
            + ", ".join(
                f"round(coalesce(CAST({c} AS DOUBLE), a_{c}), 5) + 0.0 AS {c}" for c in FEATURES
            )
            + " FROM split CROSS JOIN means",
        ),
        "round_features": query(
            features(g),
            f"SELECT {grain(g)}, round_even(COUNT_AVG_MONTH_PAID_QUOTA * 1000, 0) / 1000.0 "
            f"AS COUNT_AVG_MONTH_PAID_QUOTA, round_even(SALARY_USD * 1000, 0) / 1000.0 AS SALARY_USD "
            f"FROM features",
        ),
        "hash_jitter": query(
            f"{features(g)}, texts AS (SELECT *, sha256({row_text}) AS digest FROM features)",
            f"SELECT {grain(g)}, round({jitter_score}, 9) AS PRED_TERM_PROB FROM texts",
        ),
        "chained_order": query(
            ",".join([features(g), *chain]),
            f"SELECT {grain(g)}, {', '.join(f'round({c}, 4) + 0.0 AS {c}' for c in (salary, pay, credit))} FROM credit_1",
        ),
        "chained_impute_checks": query(
            f"{features(g)}, {differences('features')}", chained
        ),
    }
