"""Registry, output normalisation and the shared SQL fragments."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLE[name] = sql
        return function

    return register


def plain(df: DataFrame, digits: int = 4, special: dict[str, int] | None = None) -> DataFrame:
    """Types both engines print alike: bigint, rounded double, text."""
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            c = F.round(c.cast("double"), (special or {}).get(f.name, digits)) + F.lit(0.0)  # no negative zero
        elif isinstance(f.dataType, (T.BooleanType, T.IntegralType)):
            c = c.cast("bigint")
        elif not isinstance(f.dataType, T.StringType):
            c = c.cast("string")
        out.append(c.alias(f.name))
    return df.select(*out)


def r(expression: str, digits: int = 4) -> str:
    return f"round(cast({expression} as double), {digits}) + 0.0"


def i(expression: str) -> str:
    return f"cast({expression} as bigint)"


def s(expression: str) -> str:
    return f"cast({expression} as varchar)"


KEYS = f'{i("\"Store\"")} as "Store", {s("\"Date\"")} as "Date"'


def ctes(*parts: str) -> str:
    return "with " + ",\n".join(parts) + "\n"


_HOLIDAYS = """
  case when month("Date") = 12 and day("Date") in (25, 26) then 'c'
       when (month("Date") = 5 and day("Date") = 1) or (month("Date") = 10 and day("Date") = 3) then 'a'
       when month("Date") = 4 and day("Date") = 10 then 'b' else '0' end as "StateHoliday",
  case when month("Date") in (7, 8) then 1 else 0 end as "SchoolHoliday",
  isodow("Date") as "DayOfWeek\""""


def _panel(name: str, store: str, source: str) -> str:
    return f"""{name} as (
  select *, 1 as "Open", {_HOLIDAYS} from (
    select cast({store} as int) as "Store", cast(l_shipdate as date) as "Date",
           cast(sum(cast(round(l_extendedprice) as bigint)) as double) as "Sales",
           cast(count(*) as int) as "Customers",
           max(case when l_discount >= 0.08 then 1 else 0 end) as "Promo"
    from {source} group by 1, 2))"""


PANEL = _panel("panel", "s_nationkey", "lineitem join supplier on l_suppkey = s_suppkey")
WIDE = _panel("panel", "l_suppkey", "lineitem")

RAW = """raw as (
  select cast(s_nationkey as varchar) as "Store",
         case when l_quantity = 2 then 'invalid-date' else cast(cast(l_shipdate as date) as varchar) end as "Date",
         case when l_quantity = 1 then '0' when l_quantity = 3 then 'n/a'
              else cast(cast(round(l_extendedprice) as bigint) as varchar) end as "Sales",
         case when l_linenumber = 6 then null else cast(cast(l_quantity as bigint) as varchar) end as "Customers",
         case when l_linenumber = 7 then '0' else '1' end as "Open",
         case when l_discount >= 0.08 then '1.0' else '0' end as "Promo",
         cast(isodow(cast(l_shipdate as date)) as varchar) as "DayOfWeek",
         case when month(l_shipdate) = 12 and day(l_shipdate) in (25, 26) then 'c'
              when (month(l_shipdate) = 5 and day(l_shipdate) = 1) or (month(l_shipdate) = 10 and day(l_shipdate) = 3) then 'a'
              when month(l_shipdate) = 4 and day(l_shipdate) = 10 then 'b' else '0' end as "StateHoliday",
         case when l_quantity = 4 then null when month(l_shipdate) in (7, 8) then '1' else '0' end as "SchoolHoliday",
         row_number() over (order by l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice) as seq
  from lineitem join supplier on l_suppkey = s_suppkey)"""

COERCED = """coerced as (
  select cast(try_cast("Store" as double) as int) as "Store", "Date",
         try_cast("Sales" as double) as "Sales", try_cast("Customers" as double) as "Customers",
         cast(try_cast("Open" as double) as int) as "Open", cast(try_cast("Promo" as double) as int) as "Promo",
         cast(try_cast("DayOfWeek" as double) as int) as "DayOfWeek", "StateHoliday",
         cast(try_cast("SchoolHoliday" as double) as int) as "SchoolHoliday", seq
  from raw)"""

DEDUPED = """deduped as (
  select * from coerced qualify row_number() over (partition by "Store", "Date" order by seq desc) = 1)"""

CLEAN = """clean as (
  select "Store", try_cast("Date" as date) as "Date", "Sales", "Customers", "Open", "Promo", "DayOfWeek",
         "StateHoliday", "SchoolHoliday"
  from deduped where try_cast("Date" as date) is not null and "Open" = 1 and "Sales" > 0)"""

CLEANED = (RAW, COERCED, DEDUPED, CLEAN)

STORE_DIM = """store_dim as (
  select n_nationkey as "Store",
         case n_nationkey % 4 when 0 then 'a' when 1 then 'b' when 2 then 'c' else 'd' end as "StoreType",
         case n_regionkey % 3 when 0 then 'a' when 1 then 'b' else 'c' end as "Assortment",
         case when n_nationkey % 6 = 5 then null else cast(n_nationkey * 700 + 150 as double) end as "CompetitionDistance",
         case when n_nationkey % 5 = 0 then null else cast(1 + n_nationkey % 12 as double) end as "CompetitionOpenSinceMonth",
         case when n_nationkey % 5 = 0 then null else cast(1992 + n_nationkey % 9 as double) end as "CompetitionOpenSinceYear",
         case when n_nationkey % 2 = 0 then 1 else 0 end as "Promo2",
         case when n_nationkey % 2 = 0 then cast(1 + n_nationkey as double) end as "Promo2SinceWeek",
         case when n_nationkey % 2 = 0 then cast(1996 as double) end as "Promo2SinceYear",
         case when n_nationkey % 2 = 0 then 'Jan,Apr,Jul,Oct' end as "PromoInterval"
  from nation)"""

MERGED = """merged as (select p.*, d.* exclude ("Store") from panel p left join store_dim d on p."Store" = d."Store")"""


def forecast(name: str, days: int) -> str:
    return f"""{name} as (
  select "Store", "Date", "Sales" as "ActualSales",
         coalesce(avg("Sales") over (partition by "Store" order by "Date"
           range between interval {days} days preceding and interval 1 days preceding), 0) as "PredictedSales"
  from panel)"""


PRED = forecast("pred", 7)
PREDICTED = (PANEL, PRED)


def lag_sql(lags: tuple[int, ...] = (1, 7, 14, 28), value: str = '"Sales"') -> list[str]:
    out = []
    for k in lags:
        at = f'(partition by "Store" order by "Date" range between interval {k} days preceding and interval {k} days preceding)'
        upto = f'(partition by "Store" order by "Date" range between interval {k} days preceding and interval 1 days preceding)'
        out += [
            f'max({value}) over {at} as "SalesLag_{k}"',
            f'avg({value}) over {upto} as "RollingMean_{k}"',
            f'stddev_samp({value}) over {upto} as "RollingStd_{k}"',
            f'min({value}) over {upto} as "RollingMin_{k}"',
            f'max({value}) over {upto} as "RollingMax_{k}"',
        ]
    return out


def fill_sql(columns: list[str]) -> list[str]:
    how = {"SalesLag": "avg", "RollingMean": "avg", "RollingStd": "stddev_samp", "RollingMin": "min", "RollingMax": "max"}
    return [
        f'coalesce("{c}", {how[c.rsplit("_", 1)[0]]}("{c}") over (partition by "Store" order by "Date" '
        f'rows between unbounded preceding and current row), 0) as "{c}"'
        for c in columns
    ]
