"""CSV and Parquet scans, sinks and file facts. Inputs are the whole tables, written once in the file format."""

from __future__ import annotations

from pyspark.sql import functions as F

from daybook.functions.errors import mape_floor_one
from daybook.plans.catalog.base import KEYS, PANEL, PREDICTED, RAW, STORE_DIM, ctes, i, plain, query, r, s
from daybook.schemas import SALES_COLUMNS
from daybook.session import scratch_path
from daybook.sources import files, rejects, retail

_TABLES = ("lineitem", "orders", "customer", "supplier", "nation", "events")


@query("scan_sales", ctes(RAW) + "select " + ", ".join(f'"{c}"' for c in SALES_COLUMNS) + " from raw")
def scan_sales(spark, sf_dir):
    path = scratch_path(spark, "sales-csv")
    files.sink_stage(retail.sales_raw(spark, sf_dir).select(*SALES_COLUMNS), path, "csv")
    return files.scan_sales(spark, path).drop(files.INGEST_SEQ)


@query("split_rejects", ctes(RAW) + f"""
select case when try_cast("Store" as double) is null then 'store is no number' when try_cast("Date" as date) is null then 'date is no date'
  when try_cast("Sales" as double) is null then 'sales is no number' else '' end as reason, {i("count(*)")} as rows, {i("count(*)")} as placed
from raw group by 1""")
def split_rejects(spark, sf_dir):
    """Kept and rejected rows of a sales file by reason; all of them know their file and offset."""
    path, out = scratch_path(spark, "sales-csv"), scratch_path(spark, "judged")
    files.sink_stage(retail.sales_raw(spark, sf_dir).select(*SALES_COLUMNS), path, "csv")
    kept, rejected = rejects.split_rejects(files.scan_sales(spark, path), out)
    both = kept.withColumn("reason", F.lit("")).unionByName(rejected)
    place = F.col(files.INGEST_SEQ)
    return plain(both.groupBy("reason").agg(F.count(F.lit(1)).alias("rows"), F.count_if(place["file"].isNotNull() & (place["offset"] >= 0)).alias("placed")))


@query("scan_store", ctes(STORE_DIM) + f"""
select {i('"Store"')} as "Store", "StoreType", "Assortment", {r('"CompetitionDistance"')} as "CompetitionDistance",
       {r('"CompetitionOpenSinceMonth"')} as "CompetitionOpenSinceMonth", {r('"CompetitionOpenSinceYear"')} as "CompetitionOpenSinceYear",
       {i('"Promo2"')} as "Promo2", {r('"Promo2SinceWeek"')} as "Promo2SinceWeek", {r('"Promo2SinceYear"')} as "Promo2SinceYear",
       "PromoInterval" from store_dim""")
def scan_store(spark, sf_dir):
    path = scratch_path(spark, "store-csv")
    files.sink_stage(retail.store_dim(spark, sf_dir), path, "csv")
    return plain(files.scan_store(spark, path))


@query("scan_stage", ctes(PANEL) + f"""select {KEYS}, {r('"Sales"')} as "Sales", {i('"Promo"')} as "Promo" from panel""")
def scan_stage(spark, sf_dir):
    path = scratch_path(spark, "stage")
    files.sink_stage(retail.sales_panel(spark, sf_dir, "nation"), path)
    return plain(files.scan_stage(spark, path).select("Store", "Date", "Sales", "Promo"))


@query("sink_stage", ctes(PANEL) + f"""select {s('"Store"')} as "Store", {s('"Date"')} as "Date", {s(i('"Sales"'))} as "Sales" from panel""")
def sink_stage(spark, sf_dir):
    path = scratch_path(spark, "export-csv")
    panel = retail.sales_panel(spark, sf_dir, "nation")
    files.sink_stage(panel.select("Store", "Date", F.col("Sales").cast("bigint").alias("Sales")), path, "csv")
    return spark.read.schema("Store string, Date string, Sales string").option("header", True).csv(path)


@query("report_sink", ctes(*PREDICTED) + f"""
select 'store ' || "Store" as model, {r('avg(abs(("ActualSales" - "PredictedSales") / greatest("ActualSales", 1))) * 100')} as "MAPE"
from pred where "Store" <> 3 group by "Store\"""")
def report_sink(spark, sf_dir):
    path = scratch_path(spark, "report")
    report = retail.predictions(spark, sf_dir).groupBy("Store").agg(
        mape_floor_one(F.col("ActualSales"), F.col("PredictedSales")).alias("MAPE")
    ).select(
        F.concat(F.lit("store "), F.col("Store")).alias("model"), "MAPE",
        F.when(F.col("Store") == 3, "failed").alias("error"),
    )
    files.report_sink(report, path, "json")
    return plain(spark.read.schema("model string, MAPE double").json(path))


def _inventory(spark, sf_dir):
    return files.file_inventory(spark, {t: f"{sf_dir}/{t}.parquet" for t in _TABLES})


@query("file_inventory")
def file_inventory(spark, sf_dir):
    return plain(_inventory(spark, sf_dir).select("name", "exists", "files", "size", "mtime"))


@query("freshness_gate")
def freshness_gate(spark, sf_dir):
    """Freshness of the files next to that of the data in them."""
    newest = (
        retail.table(spark, sf_dir, "lineitem").agg(F.max("l_shipdate").cast("string").alias("newest")).select("newest").scalar()
    )
    return plain(files.freshness(_inventory(spark, sf_dir)).select("name", "exists", "fresh", newest.alias("newest_sale")))


@query("retrain_gate")
def retrain_gate(spark, sf_dir):
    """A model older than the features retrains; here the customer table plays the model, the order lines the features."""
    model, features = f"{sf_dir}/customer.parquet", f"{sf_dir}/lineitem.parquet"
    flags = [("present", files.retrain_gate(spark, model, features)), ("no model", files.retrain_gate(spark, f"{sf_dir}/none", features))]
    rows = retail.table(spark, sf_dir, "lineitem").agg(F.count(F.lit(1))).scalar()
    return spark.createDataFrame([(n, int(f)) for n, f in flags], "case string, retrain bigint").withColumn("feature_rows", rows)
