"""Durable tables as Parquet folders: sales_history, predictions, pipeline_runs, model_metrics.

The history has a commit log. Every change writes the new content of the months it touches to a folder of its own
(`commit=<id>/month=<month>`) and then one small file `_log/<version>.json`, which says in which folder each month is. A reader takes
the newest version and keeps its files, so it sees all of a change or nothing, also while writers are at work. A log file can
be made only once (a rename that never replaces): of two writers one comes second, looks at what the other changed, and commits on top
if no month was touched by both, else works out its change again. A writer that is lost before its commit leaves the table as it
was; `recover` commits what was complete, and `vacuum` removes folders that no version of late refers to.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.operators import history as history_ops
from daybook.operators import runs as run_ops
from daybook.schemas import HISTORY_MAP, PREDICTION_MAP, REQUIRED_HISTORY, TABLES, require_columns
from daybook.session import materialize
from daybook.sources.files import path_exists

SCHEMA_VERSION = 1
MONTH = "month"
_COMMIT = "commit"
_ATTEMPTS = 5
PARTITIONS: dict[str, str | None] = {
    "sales_history": MONTH, "predictions": "run_id", "pipeline_runs": None, "model_metrics": None,
}


def stored_schema(table: str) -> T.StructType:
    """The table's schema with its derived partition column, which only the folder names hold."""
    extra = [T.StructField(MONTH, T.StringType())] if PARTITIONS[table] == MONTH else []
    return T.StructType([*TABLES[table].fields, *extra])


def to_table_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Projects the columns the frame has and renames them to the table's."""
    return df.select(*[F.col(a).alias(b) for a, b in mapping.items() if a in df.columns])


def from_table_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.select(*[F.col(b).alias(a) for a, b in mapping.items() if b in df.columns])


def history_rows(df: DataFrame) -> DataFrame:
    """CamelCase history rows in table layout, with the partition column."""
    return to_table_columns(df, HISTORY_MAP).select(
        F.col("store_id").cast("int"),
        F.col("date").cast("date"),
        F.col("sales").cast("double"),
        F.coalesce(F.col("day_of_week").cast("int"), F.lit(0)).alias("day_of_week"),
        F.coalesce(F.col("promo").cast("int"), F.lit(0)).alias("promo"),
        F.coalesce("state_holiday", F.lit("0")).alias("state_holiday"),
        F.coalesce(F.col("school_holiday").cast("int"), F.lit(0)).alias("school_holiday"),
        F.current_timestamp().alias("created_at"),
        F.date_format("date", "yyyy-MM").alias(MONTH),
    )


class ConcurrentChange(RuntimeError):
    """Another writer changed the same months first."""


@dataclass(frozen=True)
class Snapshot:
    """A version of the history: the folder of each month."""

    version: int
    months: dict[str, str]


class Warehouse:
    """The four tables under one root folder. All methods but the writers return lazy frames."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    # --- layout -------------------------------------------------------------------------------------------

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def read(self, table: str) -> DataFrame:
        if table == "sales_history":
            return self.read_history(self.snapshot())
        schema = TABLES[table]
        if not path_exists(self.spark, self.path(table)):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(stored_schema(table)).parquet(self.path(table))

    def _fs(self):
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.root)
        return jvm.org.apache.hadoop.fs.Path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    # --- commit log of the history ------------------------------------------------------------------------

    def _log_path(self, version: int) -> str:
        return f"{self.root}/_log/{version:020d}.json"

    def versions(self) -> list[int]:
        path, fs = self._fs()
        log = path(f"{self.root}/_log")
        names = [s.getPath().getName() for s in fs.listStatus(log)] if fs.exists(log) else []
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def snapshot(self, version: int | None = None) -> Snapshot:
        """The newest version of the history, or an older one."""
        known = self.versions()
        if version is None:
            version = known[-1] if known else 0
        if version == 0:
            return Snapshot(0, {})
        if version not in known:
            raise ValueError(f"no version {version} of the history")
        return Snapshot(version, json.loads(self._read_text(self._log_path(version)))["months"])

    def read_history(self, snapshot: Snapshot) -> DataFrame:
        """The stored rows of one version; its files are fixed when this is called."""
        if not snapshot.months:
            return self.spark.createDataFrame([], TABLES["sales_history"])
        base = self.path("sales_history")
        paths = [f"{base}/{_COMMIT}={commit}/{MONTH}={month}" for month, commit in sorted(snapshot.months.items())]
        schema = stored_schema("sales_history").add(_COMMIT, T.StringType())
        return self.spark.read.schema(schema).option("basePath", base).parquet(*paths).drop(_COMMIT)

    def _read_text(self, file: str) -> str:
        path, fs = self._fs()
        stream = fs.open(path(file))
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _write_text(self, file: str, text: str) -> None:
        """A whole file or none, and never in place of another one: FileExistsError then."""
        path, fs = self._fs()
        jvm, side = self.spark._jvm, path(f"{self.root}/_log/.{uuid.uuid4().hex}")
        fs.mkdirs(side.getParent())
        fs.mkdirs(path(file).getParent())
        stream = fs.create(side, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        never_replace = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.spark._jsc.hadoopConfiguration())
        try:
            context.rename(side, path(file), never_replace)
        except Exception as error:  # noqa: BLE001 - told apart by whether the file is there
            fs.delete(side, False)
            if fs.exists(path(file)):
                raise FileExistsError(file) from error
            raise

    def _change(self, base: Snapshot, content: DataFrame | None, months: Sequence[str]) -> None:
        """Commits `content` as the whole of `months`, as they were in `base`. `content` may read the table."""
        commit = uuid.uuid4().hex
        folder = f"{self.path('sales_history')}/{_COMMIT}={commit}"
        path, fs = self._fs()
        if content is not None:
            # The rebalance hint lets adaptive execution cut a large month into files of one size and join small ones.
            content.hint("rebalance", MONTH).sortWithinPartitions(MONTH, "store_id", "date").write.partitionBy(MONTH).parquet(folder)
        filled = {m: commit if fs.exists(path(f"{folder}/{MONTH}={m}")) else None for m in months}
        before = {m: base.months.get(m) for m in months}
        side = f"{self.root}/_pending/{commit}.json"
        self._write_text(side, json.dumps({"before": before, "after": filled}))
        self._apply(side)

    def _apply(self, side: str) -> None:
        """Commits a change that is written, on top of what others have committed meanwhile; `ConcurrentChange` if they touched its months."""
        change = json.loads(self._read_text(side))
        path, fs = self._fs()
        while True:
            now = self.snapshot()
            if any(now.months.get(m) != commit for m, commit in change["before"].items()):
                fs.delete(path(side), False)
                raise ConcurrentChange(f"another writer changed {sorted(change['before'])}")
            months = {m: c for m, c in (now.months | change["after"]).items() if c is not None}
            try:
                self._write_text(self._log_path(now.version + 1), json.dumps({"months": months}))
                break
            except FileExistsError:
                continue
        fs.delete(path(side), False)

    def recover(self) -> int:
        """Commits the complete changes of lost writers, unless others changed the same months since; drops the rest."""
        path, fs = self._fs()
        pending = f"{self.root}/_pending"
        if not fs.exists(path(pending)):
            return 0
        applied = 0
        for status in fs.listStatus(path(pending)):
            side = str(status.getPath().toString())
            if not side.endswith(".json"):
                fs.delete(path(side), True)
                continue
            change = json.loads(self._read_text(side))
            if all(self.snapshot().months.get(m) == c for m, c in change["after"].items()):
                fs.delete(path(side), False)  # was committed; only the note of it is left
                continue
            try:
                self._apply(side)
                applied += 1
            except ConcurrentChange:
                continue
        return applied

    def vacuum(self, keep: int = 10) -> int:
        """Removes folders that none of the last `keep` versions refers to, and older log files; run it while no writer is at work."""
        path, fs = self._fs()
        known = self.versions()
        used = {c for v in known[-keep:] for c in self.snapshot(v).months.values()}
        base, removed = path(self.path("sales_history")), 0
        for status in fs.listStatus(base) if fs.exists(base) else []:
            name = status.getPath().getName()
            if name.startswith(f"{_COMMIT}=") and name.split("=")[1] not in used:
                fs.delete(status.getPath(), True)
                removed += 1
        for version in known[:-keep]:
            fs.delete(path(self._log_path(version)), False)
        return removed

    # --- sales history ------------------------------------------------------------------------------------

    def load_history(self, since: date | str | None = None, until: date | str | None = None) -> DataFrame:
        """CamelCase history of the days from `since` to `until`; other months are not opened. Order it at the sink."""
        stored = self.read("sales_history")
        for bound, sign in ((since, ">="), (until, "<=")):
            if bound is not None:
                stored = stored.where(F.expr(f"date {sign} date '{bound}'"))
                if MONTH in stored.columns:
                    stored = stored.where(F.expr(f"{MONTH} {sign} '{str(bound)[:7]}'"))
        return from_table_columns(stored, HISTORY_MAP)

    def upsert_history(self, new: DataFrame, order_by: str | None = None) -> int:
        """Adds or replaces rows by (Store, Date). Only the months of the new rows are read and rewritten.

        Both are keys, so a row without one of them is an error and nothing is written.
        """
        require_columns(new.columns, REQUIRED_HISTORY, "new history rows")
        new = materialize(new.select(*REQUIRED_HISTORY, *([order_by] if order_by else [])), "upsert")
        keyed = F.col("Store").isNotNull() & F.col("Date").isNotNull()
        months = new.select(F.when(keyed, F.date_format("Date", "yyyy-MM")).alias(MONTH)).distinct().collect()
        if any(r[0] is None for r in months):
            raise ValueError("new history rows: Store and Date must not be null")
        months = sorted(r[0] for r in months)
        if not months:
            return 0
        for attempt in range(_ATTEMPTS):
            base = self.snapshot()
            known = [m for m in months if m in base.months]
            if known:
                stored = self.read_history(base).where(F.col(MONTH).isin(known))
                merged = history_ops.merge_history(from_table_columns(stored, HISTORY_MAP), new, order_by)
            else:
                merged = history_ops.last_per_day(new, order_by)
            try:
                self._change(base, history_rows(merged), months)
                break
            except ConcurrentChange:
                if attempt == _ATTEMPTS - 1:
                    raise
        return len(months)

    def delete_history_before(self, cutoff: date | str) -> int:
        """Retention, as one change; returns the number of rows removed. Whole months are dropped without reading them again."""
        base = self.snapshot()
        stored = self.read_history(base)
        if MONTH not in stored.columns:
            return 0
        day = F.lit(cutoff).cast("date")
        old = stored.where((F.col(MONTH) <= F.date_format(day, "yyyy-MM")))
        months = {r[0]: r for r in old.groupBy(MONTH).agg(F.count_if(F.col("date") < day), F.count(F.lit(1))).collect()}
        touched = [m for m, r in months.items() if r[1]]
        trimmed = [m for m, r in months.items() if 0 < r[1] < r[2]]
        kept = stored.where(F.col(MONTH).isin(trimmed) & (F.col("date") >= day)) if trimmed else None
        if touched:
            self._change(base, kept, touched)
        return sum(r[1] for r in months.values())

    # --- predictions --------------------------------------------------------------------------------------

    def append_predictions(self, df: DataFrame, run_id: str) -> str:
        """Writes one run as its own partition, all or nothing; an existing run or a repeated key is an error."""
        require_columns(df.columns, ("Store", "Date", "PredictedSales"), "predictions")
        target = f"{self.path('predictions')}/run_id={run_id}"
        if path_exists(self.spark, target):
            raise ValueError(f"run {run_id} is stored already")
        rows = to_table_columns(df, PREDICTION_MAP)
        typed = rows.select(*[
            (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in TABLES["predictions"].fields if f.name not in ("run_id", "created_at")
        ]).withColumn("created_at", F.current_timestamp())
        # The rows are written aside, checked there and then published, so that the scoring plan runs once.
        side = f"{self.root}/_pending/{uuid.uuid4().hex}"
        typed.write.parquet(side)
        path, fs = self._fs()
        written = self.spark.read.schema(typed.schema).parquet(side)
        repeated = written.groupBy("store_id", "date").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        if not repeated.isEmpty():
            fs.delete(path(side), True)
            raise ValueError(f"run {run_id}: (Store, Date) is not unique")
        fs.mkdirs(path(target).getParent())
        if not fs.rename(path(side), path(target)):
            raise OSError(f"could not move {side} to {target}")
        return run_id

    def predictions(self) -> DataFrame:
        return self.read("predictions")

    def run_predictions(self, run_id: str | None = None) -> DataFrame:
        """CamelCase rows of a run (default: the latest); empty when there is none."""
        return from_table_columns(run_ops.latest_run(self.predictions(), run_id), PREDICTION_MAP)

    # --- logs ---------------------------------------------------------------------------------------------

    def _append(self, table: str, values: dict[str, object]) -> None:
        schema = TABLES[table]
        row = tuple(values.get(f.name) for f in schema.fields)
        self.spark.createDataFrame([row], schema).coalesce(1).write.mode("append").parquet(self.path(table))

    def log_run(self, run_id: str, dag_name: str, status: str, **fields: object) -> None:
        """One more entry for the run; readers keep the latest entry per (run, step)."""
        now = datetime.now()
        started = fields.pop("started_at", None) or now
        finished = fields.pop("finished_at", None) or now
        self._append("pipeline_runs", {
            "run_id": run_id, "dag_name": dag_name, "status": status, "started_at": started, "finished_at": finished,
            "records_processed": fields.pop("records_processed", 0), **fields,
        })

    def append_runs(self, runs: DataFrame) -> None:
        """Bulk form of `log_run`: a frame with the table's columns, missing ones NULL."""
        conform(runs, "pipeline_runs").write.mode("append").parquet(self.path("pipeline_runs"))

    def append_metrics(self, rows: DataFrame) -> None:
        conform(rows, "model_metrics").write.mode("append").parquet(self.path("model_metrics"))

    def pipeline_runs(self) -> DataFrame:
        return replace_run_log(self.read("pipeline_runs"))

    def log_model_metrics(
        self, metrics: dict[str, float], model_version: str | None = None, best_params: dict | None = None, **fields: object
    ) -> None:
        now = datetime.now()
        self._append("model_metrics", {
            "trained_at": now,
            "model_version": model_version or f"v_{now:%Y%m%d_%H%M%S}",
            "mape": metrics.get("MAPE"), "rmse": metrics.get("RMSE"), "mae": metrics.get("MAE"), "r2_score": metrics.get("R2"),
            "best_params": json.dumps(best_params, ensure_ascii=False) if best_params else None,
            **fields,
        })

    def model_metrics(self) -> DataFrame:
        return self.read("model_metrics")

    # --- whole warehouse ----------------------------------------------------------------------------------

    def table_counts(self) -> DataFrame:
        counts = None
        for table in TABLES:
            row = self.read(table).agg(F.lit(table).alias("table"), F.count(F.lit(1)).alias("records"))
            counts = row if counts is None else counts.unionByName(row)
        return counts

    def backfill(
        self, history: DataFrame | None = None, predictions: DataFrame | None = None, metrics: DataFrame | None = None,
        metrics_order: str | None = None,
    ) -> None:
        """One-off load of legacy frames; missing or empty ones are skipped."""
        if history is not None and not history.isEmpty():
            self.upsert_history(history)
        if predictions is not None and not predictions.isEmpty():
            self.append_predictions(predictions, "migration_initial")
        if metrics is not None and not metrics.isEmpty():
            self.append_metrics(backfill_metrics(metrics, metrics_order))


def conform(df: DataFrame, table: str) -> DataFrame:
    """The table's columns in order and type; those the frame lacks are NULL."""
    return df.select(*[
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in TABLES[table].fields
    ])


def replace_run_log(entries: DataFrame, keys: Sequence[str] = ("run_id", "dag_name")) -> DataFrame:
    """Latest entry per key; run and step together, so the steps of one run do not hide each other."""
    newest = Window.partitionBy(*keys).orderBy(F.col("finished_at").desc_nulls_last(), F.col("started_at").desc())
    return entries.withColumn("__rn", F.row_number().over(newest)).where("__rn = 1").drop("__rn")


METRIC_MAP = {"mape": "MAPE", "rmse": "RMSE", "mae": "MAE", "r2_score": "R2"}


def metric_rows(metrics: DataFrame) -> DataFrame:
    """Evaluation rows in table layout; `best_params` may be a map or a struct and is stored as JSON."""
    renamed = metrics.withColumnsRenamed({c: t for t, c in METRIC_MAP.items()})
    if "best_params" in renamed.columns and not isinstance(renamed.schema["best_params"].dataType, T.StringType):
        renamed = renamed.withColumn("best_params", F.to_json("best_params"))
    return conform(renamed, "model_metrics")


def backfill_metrics(metrics: DataFrame, order_by: str | None = None) -> DataFrame:
    """Legacy metric rows in table layout, versions numbered from 0. There is one row per past training."""
    order = F.col(order_by) if order_by else F.monotonically_increasing_id()
    numbered = metrics.withColumn("__idx", F.row_number().over(Window.orderBy(order)) - 1)
    return metric_rows(
        numbered.withColumns({
            "trained_at": F.current_timestamp(),
            "model_version": F.concat(F.lit("migration_lgbm_"), F.col("__idx")),
        }).withColumnsRenamed({"Samples": "n_test_samples"})
    )
