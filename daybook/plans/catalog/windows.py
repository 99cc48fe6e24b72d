"""Window operators over the panel."""

from __future__ import annotations

from pyspark.sql import functions as F

from daybook.functions import calendar
from daybook.operators import cleaning, panel
from daybook.plans.catalog.base import (
    KEYS, PANEL, RAW, WIDE, ctes, fill_sql, i, lag_sql, plain, query, r, s,
)
from daybook.sources import retail

_W = '(partition by "Store" order by "Date")'
_RUNS = f"""changes as (select *, case when lag("Promo") over {_W} is null or lag("Promo") over {_W} <> "Promo" then 1 else 0 end as chg
  from panel), sequences as (select *, sum(chg) over (partition by "Store" order by "Date" rows unbounded preceding) as seq from changes)"""
_LAST_PROMO = """max(case when "Promo" = 1 then "Date" end) over (partition by "Store" order by "Date"
  rows between unbounded preceding and current row)"""


@query("dedupe_keep_last", ctes(RAW) + """
select "Store", "Date", "Sales", "Open", "Promo" from raw
qualify row_number() over (partition by "Store", "Date" order by seq desc) = 1""")
def dedupe_keep_last(spark, sf_dir):
    kept = cleaning.dedupe_keep_last(retail.sales_raw(spark, sf_dir), ["ingest_seq"])
    return kept.select("Store", "Date", "Sales", "Open", "Promo")


@query("promo_sequence", ctes(PANEL, _RUNS) + f'select {KEYS}, {i("seq")} as "PromoSequence" from sequences')
def promo_sequence(spark, sf_dir):
    df = panel.with_day(retail.sales_panel(spark, sf_dir, "nation")).withColumn("chg", panel.promo_changed())
    return plain(df.select("Store", "Date", panel.promo_sequence(F.col("chg")).alias("PromoSequence")))


@query("promo_seq_length", ctes(PANEL, _RUNS) + f"""
select {KEYS}, {i('case when "Promo" = 1 then row_number() over (partition by "Store", seq order by "Date") else 0 end')}
  as "PromoSequenceLength" from sequences""")
def promo_seq_length(spark, sf_dir):
    df = panel.promo_features(retail.sales_panel(spark, sf_dir, "nation"))
    return plain(df.select("Store", "Date", "PromoSequenceLength"))


@query("days_since_last_promo", ctes(PANEL) + f"""
select {KEYS}, {i(f'case when "Promo" = 1 then 0 else coalesce("Date" - {_LAST_PROMO}, 999) end')} as "DaysSinceLastPromo" from panel""")
def days_since_last_promo(spark, sf_dir):
    df = panel.with_day(retail.sales_panel(spark, sf_dir, "nation"))
    return plain(df.select("Store", "Date", panel.days_since_last_promo().alias("DaysSinceLastPromo")))


@query("promo_edges", ctes(PANEL) + f"""
select {KEYS}, {i(f'case when "Promo" = 1 and lag("Promo") over {_W} = 0 then 1 else 0 end')} as "IsPromoStart",
       {i(f'case when "Promo" = 0 and lag("Promo") over {_W} = 1 then 1 else 0 end')} as "IsPromoEnd" from panel""")
def promo_edges(spark, sf_dir):
    df = panel.with_day(retail.sales_panel(spark, sf_dir, "nation"))
    return plain(df.select("Store", "Date", *[c.alias(n) for n, c in panel.promo_edges().items()]))


_LAGS = panel.lag_columns()
_SALES_LAGS = [c for c in _LAGS if c.startswith("SalesLag")]
_ROLLING = [c for c in _LAGS if c.startswith("Rolling")]
_LAGGED = f'lagged as (select *, {", ".join(lag_sql())} from panel)'


# Means of means often end exactly on a rounding tie, which summation order then decides. A small shift moves
# the rounding boundary away from such values; deviations of deviations get fewer places.
_SHIFT = 0.0000317
_COARSE = {c: 1 for c in _LAGS if c.startswith("RollingStd")}


def _rounded(columns, digits=None, shift=0):
    return ", ".join(f'{r(f"\"{c}\" + {shift}", (digits or {}).get(c, 4))} as "{c}"' for c in columns)


@query("sales_lag", ctes(WIDE, _LAGGED) + f"select {KEYS}, {_rounded(_SALES_LAGS)} from lagged")
def sales_lag(spark, sf_dir):
    df = panel.with_day(retail.sales_panel(spark, sf_dir))
    return plain(df.select("Store", "Date", *[panel.sales_lag(k).alias(f"SalesLag_{k}") for k in (1, 7, 14, 28)]))


@query("rolling_stats", ctes(WIDE, _LAGGED) + f"select {KEYS}, {_rounded(_ROLLING)} from lagged")
def rolling_stats(spark, sf_dir):
    return plain(panel.raw_lags(retail.sales_panel(spark, sf_dir)).select("Store", "Date", *_ROLLING))


@query("expanding_fill", ctes(WIDE, _LAGGED, f'filled as (select "Store", "Date", {", ".join(fill_sql(_LAGS))} from lagged)')
       + f"select {KEYS}, {_rounded(_LAGS, _COARSE, _SHIFT)} from filled")
def expanding_fill(spark, sf_dir):
    filled = panel.lag_features(retail.sales_panel(spark, sf_dir))
    filled = filled.select("Store", "Date", *[(F.col(c) + _SHIFT).alias(c) for c in _LAGS])
    return plain(filled, special=_COARSE)


_HOL = 'hol as (select *, case when "StateHoliday" <> \'0\' then 1 else 0 end as h from panel)'


@query("holiday_neighbours", ctes(PANEL, _HOL) + f"""
select {KEYS}, {i(f"lag(h, 1, 0) over {_W}")} as "WasHolidayYesterday", {i(f"lead(h, 1, 0) over {_W}")} as "IsHolidayTomorrow" from hol""")
def holiday_neighbours(spark, sf_dir):
    df = panel.with_day(retail.sales_panel(spark, sf_dir, "nation"))
    columns = panel.holiday_neighbours(calendar.is_holiday(F.col("StateHoliday")))
    return plain(df.select("Store", "Date", *[c.alias(n) for n, c in columns.items()]))


@query("holiday_last_week", ctes(PANEL, _HOL) + f"""
select {KEYS}, {i('coalesce(max(h) over (partition by "Store" order by "Date" rows between 7 preceding and 1 preceding), 0)')}
  as "WasHolidayLastWeek" from hol""")
def holiday_last_week(spark, sf_dir):
    df = panel.with_day(retail.sales_panel(spark, sf_dir, "nation"))
    holiday = calendar.is_holiday(F.col("StateHoliday"))
    return plain(df.select("Store", "Date", panel.holiday_last_week(holiday).alias("WasHolidayLastWeek")))


# Requests: every order asks for its customer's nation (as store) on the day after the order.
_REQUESTS = """requests as (select cast(c_nationkey as int) as "Store", cast(o_orderdate as date) + 1 as "Date"
  from orders join customer on o_custkey = c_custkey)"""
_ASKED = """tagged as (select "Store", "Date", "Sales", 0 as ask from panel
  union all select distinct "Store", "Date", null, 1 from requests)"""


def lag_requests(spark, sf_dir):
    orders, customers = retail.table(spark, sf_dir, "orders"), retail.table(spark, sf_dir, "customer")
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("c_nationkey").cast("int").alias("Store"), F.date_add(F.to_date("o_orderdate"), 1).alias("Date")
    )


@query("batch_lags", ctes(PANEL, _REQUESTS, _ASKED, f'lagged as (select *, {", ".join(lag_sql())} from tagged)') + f"""
select {i('q."Store"')} as "Store", {s('q."Date"')} as "Date", {_rounded(_LAGS)}
from requests q left join lagged l on q."Store" = l."Store" and q."Date" = l."Date" and l.ask = 1""")
def batch_lags(spark, sf_dir):
    return plain(panel.batch_lags(lag_requests(spark, sf_dir), retail.sales_panel(spark, sf_dir, "nation")))


_LIMITS = """limits as (select "Promo", quantile_cont("Sales", 0.25) as q1, quantile_cont("Sales", 0.75) as q3
  from panel group by "Promo")"""


@query("outlier_by_regime", ctes(PANEL, _LIMITS) + f"""
select {i('p."Store"')} as "Store", {s('p."Date"')} as "Date",
       {i('case when "Sales" < q1 - 1.5 * (q3 - q1) or "Sales" > q3 + 1.5 * (q3 - q1) then 1 else 0 end')} as "IsOutlier"
from panel p join limits l on p."Promo" = l."Promo\"""")
def outlier_by_regime(spark, sf_dir):
    df = cleaning.detect_outliers(retail.sales_panel(spark, sf_dir, "nation"), threshold=1.5)
    return plain(df.select("Store", "Date", "IsOutlier"))
