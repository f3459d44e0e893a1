"""Catalog registration of published layers and the execution log.

`register_tables` creates one database per layer (raw, staging,
intermediate, mart) and, for each published table, an external Parquet table
(or, for tables a stage writes as one route of a shared dataset, a view that
selects that route), with a comment, so the layers can be queried by name:

    SELECT ... FROM mart.fact_daily_product_revenue f JOIN mart.dim_date d ...

Database locations are placed under the layer store's root (the shared
storage folder), never under a machine-local warehouse folder.  Re-running
re-points every table at the newest published version; dropping an external
table never deletes its files.
"""

from __future__ import annotations

from ledgerstar.plans.stages import ROUTED, LayerStore, declared_schema
from ledgerstar.schemas import EXECUTION_LOG_SCHEMA

TABLE_COMMENTS = {
    ("raw", "sales_daily"): "Lines of the daily file as they were read, all cells as text.",
    ("raw", "sales_historical"): "Lines of the workbook's sheets as they were read, all cells as text.",
    ("staging", "sales_transactions"): "Both feeds typed and normalised; dedup_key = invoice|code|customer|day.",
    ("staging", "rejected_records"): "Unparsable raw lines with their JSON payload and reason.",
    ("intermediate", "sales_transactions_clean"): "First-wins deduplicated lines with return flag, revenue, category, canonical name.",
    ("intermediate", "rejected_records"): "Sales with a unit price <= 0, with JSON payload and reason.",
    ("mart", "dim_date"): "One row per calendar day present in the data.",
    ("mart", "dim_customer"): "Customers, including UNKNOWN for lines without a customer id.",
    ("mart", "dim_country"): "Countries as they appear in the data.",
    ("mart", "dim_product"): "Canonical name (most frequent spelling) and keyword category per product code.",
    ("mart", "fact_sales"): "One row per sale line (quantity > 0, unit price > 0).",
    ("mart", "fact_returns"): "One row per return or adjustment line (quantity <= 0).",
    ("mart", "fact_daily_product_revenue"): "Gross, returned and net revenue per product and day.",
}


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def register_tables(store: LayerStore) -> list[str]:
    """(Re)register every published table; returns the qualified names."""
    spark = store.spark
    names = []
    run = store.snapshot() if store.published_version("mart") else {}
    for (layer, table), comment in TABLE_COMMENTS.items():
        # what the newest mart was made from; where there is no mart, the newest
        pinned = run.get("raw", {}).get(table) if layer == "raw" else run.get(layer)
        version = pinned or store.published_version(layer, table if layer == "raw" else None)
        if version is None:
            continue
        spark.sql(
            f"CREATE DATABASE IF NOT EXISTS {layer} COMMENT 'layer {layer}' "
            f"LOCATION '{store.root}/_catalog/{layer}.db'"
        )
        name = f"{layer}.{table}"
        if spark.catalog.tableExists(name):
            kind = spark.catalog.getTable(name).tableType
            spark.sql(f"DROP {'VIEW' if kind == 'VIEW' else 'TABLE'} {name}")
        if (layer, table) in ROUTED:
            # one route of a dataset written by a single stage job: a view
            # that keeps the route (partition pruning reads only its folder)
            dataset, route, columns = ROUTED[(layer, table)]
            path = store.dataset_path(layer, dataset, version)
            about = {f.name: f.metadata["comment"] for f in declared_schema(layer, table).fields if "comment" in f.metadata}
            named = ", ".join(f"{c} COMMENT {_quoted(about[c])}" if c in about else c for c in columns)
            spark.sql(
                f"CREATE VIEW {name} ({named}) COMMENT {_quoted(comment)} AS "
                f"SELECT {', '.join(columns)} FROM parquet.`{path}` WHERE route = '{route}'"
            )
        else:
            spark.catalog.createTable(
                name, path=store.table_path(layer, table, version), source="parquet", description=comment,
                schema=store.read(layer, table, version).schema,
            )
        names.append(name)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS audit COMMENT 'execution log' LOCATION '{store.root}/_catalog/audit.db'")
    spark.sql("DROP TABLE IF EXISTS audit.etl_execution_log")
    spark.catalog.createTable("audit.etl_execution_log", path=store.log_path, source="parquet",
                              description="One row per attempt of a task.", schema=EXECUTION_LOG_SCHEMA, recursiveFileLookup="true")
    return [*names, "audit.etl_execution_log"]
