from __future__ import annotations

import os

from daybook.schemas import SALES_COLUMNS, text_schema
from daybook.sources.tables import Warehouse
from daybook.streaming.incremental import incremental_history, landing_files

HEADER = ",".join(SALES_COLUMNS)


def land(folder, name, *lines):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write("\n".join([HEADER, *lines]) + "\n")


def run(spark, root, warehouse):
    stream = landing_files(spark, f"{root}/in", text_schema(SALES_COLUMNS))
    incremental_history(stream, warehouse, f"{root}/checkpoint").awaitTermination()
    return sorted((r.Store, str(r.Date), r.Sales) for r in warehouse.load_history().collect())


def test_new_files_are_upserted_once_and_late_rows_win(spark, root):
    w = Warehouse(spark, f"{root}/tables")
    land(f"{root}/in", "a.csv", "1,1,2024-01-01,10,1,1,0,0,0", "1,2,2024-01-02,20,1,1,0,0,0", "1,2,2024-01-02,21,1,1,0,0,0")
    first = [(1, "2024-01-01", 10.0), (1, "2024-01-02", 21.0)]
    assert run(spark, root, w) == first
    assert run(spark, root, w) == first
    land(f"{root}/in", "b.csv", "1,1,2024-01-01,11,1,1,0,0,0", "2,1,2024-02-01,5,1,1,0,0,0", "2,1,bad,5,1,1,0,0,0")
    assert run(spark, root, w) == [(1, "2024-01-01", 11.0), (1, "2024-01-02", 21.0), (2, "2024-02-01", 5.0)]
