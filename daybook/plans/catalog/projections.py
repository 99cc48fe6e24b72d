"""Coercion, filters, null handling and column alignment."""

from __future__ import annotations

from pyspark.sql import functions as F

from daybook.operators import cleaning, evaluation, history, imputation
from daybook.plans.catalog.base import (
    COERCED, KEYS, MERGED, PANEL, PREDICTED, RAW, STORE_DIM, ctes, i, plain, query, r, s,
)
from daybook.plans.features import align_features
from daybook.schemas import HISTORY_MAP
from daybook.sources import retail
from daybook.sources.tables import from_table_columns, to_table_columns

_D = "cast({} as double)"


@query("coerce_types", ctes(RAW, COERCED) + f"""
select {i('"Store"')} as "Store", "Date", {r('"Sales"')} as "Sales", {r('"Customers"')} as "Customers", {i('"Open"')} as "Open",
       {i('"Promo"')} as "Promo", {i('"DayOfWeek"')} as "DayOfWeek", {r('"SchoolHoliday"')} as "SchoolHoliday" from coerced""")
def coerce_types(spark, sf_dir):
    df = cleaning.coerce_types(retail.sales_raw(spark, sf_dir))
    return plain(df.select(
        "Store", "Date", "Sales", "Customers", "Open", "Promo", "DayOfWeek", F.col("SchoolHoliday").cast("double").alias("SchoolHoliday")
    ))


@query("coerce_dates", ctes(RAW) + """
select "Store", "Date", "Open", "Promo" from raw where try_cast("Date" as date) is not null""")
def coerce_dates(spark, sf_dir):
    return plain(cleaning.coerce_dates(retail.sales_raw(spark, sf_dir)).select("Store", "Date", "Open", "Promo"))


@query("filter_open", ctes(RAW, COERCED) + f"""
select {i('"Store"')} as "Store", "Date", {r('"Sales"')} as "Sales" from coerced where "Open" = 1""")
def filter_open(spark, sf_dir):
    df = cleaning.filter_open(cleaning.coerce_types(retail.sales_raw(spark, sf_dir), check_fractions=False))
    return plain(df.select("Store", "Date", "Sales"))


@query("filter_positive_sales", ctes(RAW, COERCED) + f"""
select {i('"Store"')} as "Store", "Date", {r('"Sales"')} as "Sales" from coerced where "Sales" > 0""")
def filter_positive_sales(spark, sf_dir):
    df = cleaning.filter_positive_sales(cleaning.coerce_types(retail.sales_raw(spark, sf_dir), check_fractions=False))
    return plain(df.select("Store", "Date", "Sales"))


@query("filter_dashboard", ctes(*PREDICTED) + f"""
select {KEYS}, {r('"ActualSales"')} as "ActualSales", {r('"PredictedSales"')} as "PredictedSales" from pred
where "Date" between date '2000-03-03' and date '2000-06-01'""")
def filter_dashboard(spark, sf_dir):
    return plain(cleaning.filter_dashboard(retail.predictions(spark, sf_dir), end="2000-06-01", preset="90days"))


@query("store_history_slice", ctes(PANEL) + f"""
select {KEYS}, {r('"Sales"')} as "Sales" from panel where "Store" = 7
  and "Date" >= (select max("Date") from panel where "Store" = 7) - 365""")
def store_history_slice(spark, sf_dir):
    return plain(history.store_history_slice(retail.sales_panel(spark, sf_dir, "nation"), 7).select("Store", "Date", "Sales"))


@query("retention", ctes(PANEL) + f"""select {KEYS}, {r('"Sales"')} as "Sales" from panel where "Date" >= date '1999-01-01'""")
def retention(spark, sf_dir):
    kept = history.retention(retail.sales_panel(spark, sf_dir, "nation"), "1999-01-01")
    return plain(kept.select("Store", "Date", "Sales"))


@query("map_columns", ctes(PANEL) + f"""
select {i('"Store"')} as store_id, {s('"Date"')} as date, {r('"Sales"')} as sales, {i('"DayOfWeek"')} as day_of_week,
       {i('"Promo"')} as promo, "StateHoliday" as state_holiday, {i('"SchoolHoliday"')} as school_holiday from panel""")
def map_columns(spark, sf_dir):
    table = to_table_columns(retail.sales_panel(spark, sf_dir, "nation"), HISTORY_MAP)
    there_and_back = to_table_columns(from_table_columns(table, HISTORY_MAP), HISTORY_MAP)
    return plain(there_and_back)


@query("align_features", ctes(PANEL) + f"""
select {i('"DayOfWeek"')} as "DayOfWeek", {i('"Promo"')} as "Promo", cast(null as double) as "CompetitionNear",
       {i('"Store"')} as "Store", {s('"Date"')} as "Date", {r('"Sales"')} as "Sales" from panel""")
def align(spark, sf_dir):
    df = retail.sales_panel(spark, sf_dir, "nation")
    return plain(align_features(df, ["DayOfWeek", "Promo", "CompetitionNear", "Store"]))


@query("enrich_errors", ctes(*PREDICTED) + f"""
select {KEYS}, {r('abs("ActualSales" - "PredictedSales")', 6)} as "AbsoluteError",
       {r('case when "ActualSales" > 0 then abs("ActualSales" - "PredictedSales") / "ActualSales" * 100 else 0 end', 6)} as "PercentageError"
from pred""")
def enrich_errors(spark, sf_dir):
    df = evaluation.enrich_errors(retail.predictions(spark, sf_dir))
    return plain(df.select("Store", "Date", "AbsoluteError", "PercentageError"), 6)


@query("detail_table", ctes(*PREDICTED) + f"""
select {KEYS}, {r('"ActualSales"')} as "ActualSales", {r('"PredictedSales"')} as "PredictedSales",
       {r('"ActualSales" - "PredictedSales"')} as "Error",
       {r('case when "ActualSales" > 0 then round(("ActualSales" - "PredictedSales") / "ActualSales" * 100, 2) else 0 end')} as "ErrorPct"
from (select * from pred order by "Date", "Store" limit 1000)""")
def detail_table(spark, sf_dir):
    return plain(evaluation.detail_table(retail.predictions(spark, sf_dir)))


@query("null_flags", ctes(PANEL, STORE_DIM, MERGED) + f"""
select {KEYS}, {i('case when "CompetitionOpenSinceYear" is not null then 1 else 0 end')} as "HasCompetition",
       {i('case when "Promo2SinceYear" is not null then 1 else 0 end')} as "InPromo2" from merged""")
def null_flags(spark, sf_dir):
    df = imputation.null_flags(retail.merged_panel(spark, sf_dir))
    return plain(df.select("Store", "Date", "HasCompetition", "InPromo2"))


_CONSTANTS = {
    "CompetitionDistance": "100000", "CompetitionOpenSinceMonth": "0", "CompetitionOpenSinceYear": "0",
    "Promo2SinceWeek": "0", "Promo2SinceYear": "0",
}


@query("fill_constants", ctes(PANEL, STORE_DIM, MERGED) + f"""
select {KEYS}, {", ".join(f'{r(f"coalesce(\"{c}\", {v})")} as "{c}"' for c, v in _CONSTANTS.items())},
       coalesce("PromoInterval", 'NoPromo') as "PromoInterval" from merged""")
def fill_constants(spark, sf_dir):
    df = imputation.fill_constants(retail.merged_panel(spark, sf_dir))
    return plain(df.select("Store", "Date", *_CONSTANTS, "PromoInterval"))


# Holes in the panel: columns are blanked on some days.
_HOLES = """holes as (select "Store", "Date",
  case when day("Date") % 5 = 0 then null else "Promo" end as "Promo",
  case when day("Date") % 7 = 0 then null else "SchoolHoliday" end as "SchoolHoliday",
  case when day("Date") % 3 = 0 or "Store" = 3 then null else cast("Customers" as double) end as "Customers",
  case when day("Date") % 4 = 0 then null else "StateHoliday" end as "StateHoliday" from panel)"""


def panel_with_holes(spark, sf_dir):
    day = F.dayofmonth("Date")
    return retail.sales_panel(spark, sf_dir, "nation").select(
        "Store", "Date",
        F.when(day % 5 != 0, F.col("Promo")).alias("Promo"),
        F.when(day % 7 != 0, F.col("SchoolHoliday")).alias("SchoolHoliday"),
        F.when((day % 3 != 0) & (F.col("Store") != 3), F.col("Customers").cast("double")).alias("Customers"),
        F.when(day % 4 != 0, F.col("StateHoliday")).alias("StateHoliday"),
    )


def _mode(column: str) -> str:
    return f'(select "{column}" from holes where "{column}" is not null group by 1 order by count(*) desc, 1 limit 1)'


@query("fill_binary_mode", ctes(PANEL, _HOLES) + f"""
select {KEYS}, {i(f'coalesce("Promo", {_mode("Promo")}, 0)')} as "Promo",
       {i(f'coalesce("SchoolHoliday", {_mode("SchoolHoliday")}, 0)')} as "SchoolHoliday" from holes""")
def fill_binary_mode(spark, sf_dir):
    df = imputation.fill_binary_mode(panel_with_holes(spark, sf_dir))
    return plain(df.select("Store", "Date", "Promo", "SchoolHoliday"))


@query("fill_numeric_median", ctes(PANEL, _HOLES) + f"""
select {i('h."Store"')} as "Store", {s('h."Date"')} as "Date", {r('coalesce("Customers", m, 0)')} as "Customers"
from holes h join (select "Store", quantile_cont("Customers", 0.5) as m from holes group by 1) q on h."Store" = q."Store\"""")
def fill_numeric_median(spark, sf_dir):
    df = imputation.fill_numeric_median(panel_with_holes(spark, sf_dir), ["Customers"])
    return plain(df.select("Store", "Date", "Customers"))


@query("fill_category_mode", ctes(PANEL, _HOLES) + f"""
select {KEYS}, coalesce("StateHoliday", {_mode("StateHoliday")}, 'Unknown') as "StateHoliday" from holes""")
def fill_category_mode(spark, sf_dir):
    return plain(imputation.fill_category_mode(panel_with_holes(spark, sf_dir)).select("Store", "Date", "StateHoliday"))


_COUNTED = ("Store", "Date", "Promo", "SchoolHoliday", "Customers", "StateHoliday")
_NULLS = " union all ".join(
    f'select \'{c}\' as "column", {i(f"count(*) - count(\"{c}\")")} as nulls from holes' for c in _COUNTED
)


@query("null_counts", ctes(PANEL, _HOLES) + _NULLS)
def null_counts(spark, sf_dir):
    return plain(imputation.null_counts(panel_with_holes(spark, sf_dir)))


@query("missing_profile", ctes(PANEL, _HOLES) + f"select * from ({_NULLS}) where nulls > 0")
def missing_profile(spark, sf_dir):
    return plain(imputation.missing_profile(panel_with_holes(spark, sf_dir)))
