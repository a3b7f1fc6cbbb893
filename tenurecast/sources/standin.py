"""Employee-year table derived from the order tables.

One row per customer and calendar year. A customer "leaves" when the next year
has no order; for the last year of the data that is unknown, so its label is null.

Plan: one map-side combined aggregate over orders and one over order lines,
both ending partitioned by (customer, year), so they join without another
shuffle. Money is summed as whole cents in 64-bit integers, which keeps sums
exact whatever the partitioning. Priorities and statuses are counted as sets of
a few short strings, so the orders aggregate needs no row expansion.

``calendar_tables`` makes the tables of several calendars from one scan of orders and
one of order lines: lines are summed up per order, each order becomes one row per
calendar, and the calendar is a key of the aggregates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.columns import one_calendar
from ..schema import CALENDAR, FISCAL, GREGORIAN, INDUSTRY_LOOKUP, TITLE_LOOKUP, YEAR, Calendar
from ..session import new_path, staged

# Raw categories for the stand-in: every known raw value plus one unlisted.
RAW_TITLES = sorted(TITLE_LOOKUP) + ["INTERN"]
RAW_INDUSTRIES = sorted(INDUSTRY_LOOKUP) + ["Agriculture"]
BUSINESSES = 600

MONTHS = range(1, 13)

# Day and order key packed in one long, so "last order of the year" is a plain
# max over a primitive and the aggregate stays a hash aggregate.
_KEY_BITS = 45


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _cents(column: str) -> str:
    return f"bigint(rint({column} * 100))"


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        "o_orderpriority",
        "unix_date(date(o_orderdate)) as day",
        f"{_cents('o_totalprice')} as cents",
    )


def _year_and_month(calendar: Calendar) -> tuple[str, str]:
    shifted = f"add_months(date_from_unix_date(day), {calendar.shift_months})"
    return f"year({shifted}) as y", f"month({shifted}) as mo"


def _dated_orders(spark: SparkSession, sf_dir: str, calendar: Calendar) -> DataFrame:
    return _orders(spark, sf_dir).selectExpr("*", *_year_and_month(calendar))


def _order_side(orders: DataFrame, keys: list[str], sums: dict[str, str] | None = None) -> DataFrame:
    """Measures of the orders of every key, and ``sums`` (name to aggregate) beside them."""
    sums = sums or {}
    aggregates = {f"m{m}": f"count_if(mo = {m})" for m in MONTHS} | {
        "last": f"max(bigint(day) * {1 << _KEY_BITS} + o_orderkey)",
        "first_day": "min(day)",
        "sum_cents": "sum(cents)",
        "max_cents": "max(cents)",
        "min_cents": "min(cents)",
        "paid_cents": "sum(case when o_orderstatus != 'P' then cents end)",
        "paid_orders": "count_if(o_orderstatus != 'P')",
        "last_quota": "max(case when o_orderstatus != 'F' then mo end)",
        "payee_cents": "max(case when o_orderpriority = '1-URGENT' and o_orderstatus = 'F' "
        "then cents end)",
        "n_priority": "size(collect_set(o_orderpriority))",
        "n_status": "size(collect_set(o_orderstatus))",
    }
    grouped = orders.groupBy(*keys).agg(
        *[F.expr(f"{e} as {name}") for name, e in (aggregates | sums).items()]
    )
    used = ", ".join(f"nullif(m{m}, 0)" for m in MONTHS)
    numbered = [f"case when m{m} > 0 then {m} end" for m in MONTHS]
    return grouped.selectExpr(
        *keys,
        *sums,
        "first_day",
        f"date_from_unix_date(int(shiftright(last, {_KEY_BITS}))) as last_day",
        f"last & {(1 << _KEY_BITS) - 1} as last_key",
        "sum_cents / 100 as total",
        f"coalesce({', '.join(numbered)}) as mo_min",
        f"coalesce({', '.join(reversed(numbered))}) as mo_max",
        " + ".join(f"bigint(m{m} > 0)" for m in MONTHS) + " as mo_used",
        f"greatest({used}) as busiest",
        f"least({used}) as quietest",
        "max_cents / 100 as max_total",
        "min_cents / 100 as min_total",
        "paid_cents / 100 / nullif(paid_orders, 0) as paid_avg",
        "last_quota",
        "payee_cents / 100 as payee",
        "n_priority",
        "n_status",
    )


def _line_side(spark: SparkSession, sf_dir: str, orders: DataFrame) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey",
        "l_suppkey",
        f"{_cents('l_extendedprice')} as line_cents",
        f"case when l_returnflag = 'R' then {_cents('l_extendedprice')} end as returned_cents",
    )
    joined = lines.join(
        orders.select("o_orderkey", "o_custkey", "y"), F.expr("l_orderkey = o_orderkey")
    )
    return joined.groupBy("o_custkey", "y").agg(
        F.expr("sum(line_cents) / 100 as paid"),
        F.expr("sum(returned_cents) / 100 as credit"),
        F.expr("min(returned_cents) / 100 as credit_min"),
        F.expr("count(distinct l_suppkey) as n_supplier"),
    )


def _per_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with what their lines add up to, and the suppliers of each."""
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey",
        "l_suppkey",
        f"{_cents('l_extendedprice')} as line_cents",
        f"case when l_returnflag = 'R' then {_cents('l_extendedprice')} end as returned_cents",
    )
    sums = lines.groupBy("l_orderkey").agg(
        F.sum("line_cents").alias("line_cents"),
        F.sum("returned_cents").alias("returned_cents"),
        F.min("returned_cents").alias("least_returned"),
        F.collect_set("l_suppkey").alias("suppliers"),
    )
    return _orders(spark, sf_dir).join(sums, F.expr("o_orderkey = l_orderkey"), "left").drop("l_orderkey")


def _pick(values: list[str], key: str) -> str:
    """Element of a fixed list chosen by a key."""
    listed = ", ".join("'" + v.replace("'", "\\'") + "'" for v in values)
    return f"element_at(array({listed}), int({key} % {len(values)}) + 1)"


def _yyyymmdd(day: str) -> str:
    return f"bigint(year({day}) * 10000 + month({day}) * 100 + day({day}))"


def feature_table(spark: SparkSession, sf_dir: str, calendar: Calendar = GREGORIAN) -> DataFrame:
    """The employee-year table of one calendar."""
    orders = _dated_orders(spark, sf_dir, calendar)
    per_year = _order_side(orders, ["o_custkey", "y"]).join(
        _line_side(spark, sf_dir, orders), ["o_custkey", "y"], "left"
    )
    last_year = orders.agg(F.max("y")).scalar()
    return _described(spark, sf_dir, per_year, last_year, [], calendar.year)


def all_calendars(spark: SparkSession, sf_dir: str, calendars: tuple[Calendar, ...] = (GREGORIAN, FISCAL)) -> DataFrame:
    """The employee-year tables of several calendars as one, with the columns ``calendar`` and ``YEAR``.

    Orders with the sums of their lines are stored once, so each source is scanned once. The
    stored rows are then dated by every calendar before one aggregate over all of them.
    """
    dated = ", ".join(
        f"named_struct('{CALENDAR}', '{c.name}', {', '.join(_named(e) for e in _year_and_month(c))})" for c in calendars
    )
    rows = staged(_per_order(spark, sf_dir), "orders").selectExpr("*", f"inline(array({dated}))")
    keys = [CALENDAR, "o_custkey", "y"]
    sums = {
        "paid": "sum(line_cents) / 100",
        "credit": "sum(returned_cents) / 100",
        "credit_min": "min(least_returned) / 100",
    }
    suppliers = rows.select(*keys, F.explode("suppliers").alias("supplier"))
    suppliers = suppliers.groupBy(*keys).agg(F.count_distinct("supplier").alias("n_supplier"))
    per_year = staged(_order_side(rows, keys, sums).join(suppliers, keys, "left"), "years")
    # One row per calendar.
    last = per_year.groupBy(CALENDAR).agg(F.max("y").alias("last_year"))
    per_year = per_year.join(F.broadcast(last), CALENDAR)
    return _described(spark, sf_dir, per_year, F.col("last_year"), [CALENDAR], YEAR)


def calendar_tables(
    spark: SparkSession, sf_dir: str, calendars: tuple[Calendar, ...] = (GREGORIAN, FISCAL)
) -> dict[str, DataFrame]:
    """The table of every calendar by name, stored together in one partition per calendar."""
    path = new_path(spark, "calendars")
    found = all_calendars(spark, sf_dir, calendars)
    found.write.partitionBy(CALENDAR).parquet(path)
    together = spark.read.schema(found.schema).parquet(path)
    return {c.name: one_calendar(together, c) for c in calendars}


def _named(aliased: str) -> str:
    """``expression as name`` as two arguments of ``named_struct``."""
    expression, name = aliased.rsplit(" as ", 1)
    return f"'{name}', {expression}"


def _described(
    spark: SparkSession, sf_dir: str, per_year: DataFrame, last_year: Column, carried: list[str], year: str
) -> DataFrame:
    """Yearly measures with the label, the person and the names of the employee-year table."""
    # A customer has at most one row per year, so this window stays small per key.
    history = Window.partitionBy(*carried, "o_custkey").orderBy("y")
    leaves = F.coalesce(F.lead("y").over(history) != F.col("y") + 1, F.lit(True))
    labelled = per_year.select(
        "*",
        F.first("first_day").over(history).alias("hired"),
        F.when(F.col("y") < last_year, leaves.cast("int")).alias("leaves"),
    )

    homes = (
        table(spark, sf_dir, "nation")
        .join(table(spark, sf_dir, "region"), F.expr("n_regionkey = r_regionkey"))
        .select("n_nationkey", "n_name", "r_name")
    )
    people = (
        table(spark, sf_dir, "customer")
        .join(homes, F.expr("c_nationkey = n_nationkey"), "left")
        .select("c_custkey", "c_acctbal", "n_name", "r_name")
    )
    rows = labelled.join(people, F.expr("o_custkey = c_custkey"))
    definitions = {
        "BUSINESS_ID": f"o_custkey % {BUSINESSES}",
        year: "int(y)",
        "TERM_AS_OF_DATE": _yyyymmdd("last_day"),
        "MASTER_PARTICIPANT_ID": "o_custkey",
        "HOME_COUNTRY_CODE": "n_name",
        "HOME_STATE_PROVINCE": "r_name",
        "HIRE_AS_OF_DATE": _yyyymmdd("date_from_unix_date(hired)"),
        "TITLE_CATEGORY_YR_END": _pick(RAW_TITLES, "last_key"),
        "INDUSTRY": _pick(RAW_INDUSTRIES, "o_custkey"),
        "OWNERSHIP": "case when c_acctbal < 0 then 'Private' when c_acctbal >= 500 then 'Public' end",
        "PR_TARGET_USD": "total",
        "SALARY_USD": "c_acctbal",
        "COUNT_MONTH_EMPLOYED_TIL_DEC": "double(13 - mo_min)",
        "COUNT_MONTHS_GOT_PAYMENT": "mo_used",
        "LAST_PAYMENT_UNTIL_YR_END": "double(12 - mo_max)",
        "YEAR_PAYMENT": "paid",
        "COUNT_UNIQ_QUOTA": "double(n_priority)",
        "COUNT_AVG_MONTH_PAID_QUOTA": "paid_avg",
        "LAST_QUOTA_PAID_UNTIL_YR_END": "double(last_quota)",
        "SUM_CREDIT_AMT_USD": "credit",
        "MIN_CREDIT_AMT_USD": "credit_min",
        "MAX_QUOTA_AMT_USD": "max_total",
        "MIN_QUOTA_AMT_USD": "min_total",
        "COUNT_MAX_MONTH_ORDER": "double(busiest)",
        "COUNT_MIN_MONTH_ORDER": "double(quietest)",
        "COUNT_UNIQ_TITLE_NAME": "bigint(n_status)",
        "COUNT_UNIQ_MGR_ID": "coalesce(n_supplier, 0)",
        "COMP_AVG_MONTH_PAYEECOUNT": "payee",
        "TERM_NEXT_YEAR": "leaves",
    }
    return rows.selectExpr(*carried, *[f"{e} as {name}" for name, e in definitions.items()])
