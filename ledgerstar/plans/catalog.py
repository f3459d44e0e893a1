"""Registry of every query/operator view: key -> callable(spark, sf_dir).

Each callable builds the raw feeds from the driver tables under `sf_dir`,
runs the chain lazily up to the layer it reports, and returns a DataFrame
whose columns (names and types) match the SQL oracle in `oracle.py`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerstar.operators import quality
from ledgerstar.plans import questions as qs
from ledgerstar.plans.chain import SalesChain
from ledgerstar.schemas import INTERMEDIATE_COLUMNS, STAGING_COLUMNS
from ledgerstar.session import apply_required, release_shuffles, storage_root
from ledgerstar.sources.testfeed import RAW_OUTPUT, raw_lines


def chain_for(spark: SparkSession, sf_dir: str, **kwargs) -> SalesChain:
    apply_required(spark)
    return SalesChain(raw_lines(spark, sf_dir), **kwargs)


def _stored(ch: SalesChain, name: str) -> SalesChain:
    """The chain for a query: layers that it reads more than once are written
    under the shared folder, each in one job, and read back.

    The way to the intermediate layer is stored in steps (staged lines,
    deduplicated lines, names), each by a job whose shuffle files go before the
    next one begins; a step that the query does not read goes as soon as the
    next is there."""
    from ledgerstar.plans import stages

    kept = STORED_LAYERS.get(name, ())
    if not kept:
        return ch
    spark, version = ch.raw.sparkSession, stages.new_version()
    store = stages.LayerStore(spark, f"{storage_root(spark)}/views")

    def stored(routed: DataFrame, layer: str, by: str | None = None) -> DataFrame:
        store.write_routed(routed, layer, "lines", version, by=by)
        release_shuffles(spark)
        # the schema is given: a write without rows leaves no route to find it in
        return spark.read.schema(routed.schema).parquet(store.dataset_path(layer, "lines", version))

    if "staging" in kept:
        ch = ch.with_layers(staging=stored(ch._routed_staging, "staging"))
    else:
        ch = ch.with_layers(staged=store.keep(ch.staging, "staging", "staged", version))
    if "deduplicated" in kept or "intermediate" in kept:
        layers = {"staging": ch._routed_staging} if "staging" in kept else {}
        ch = ch.with_layers(**layers, classified=store.keep(ch.classified, "intermediate", "deduplicated", version, "dedup_key"))
        store.forget("staging", version, "staged")
        ch = ch.with_layers(**layers, classified=ch.classified, names=store.keep(ch.names, "intermediate", "names", version))
    if "intermediate" in kept:
        ch = ch.with_layers(**layers, intermediate=stored(ch._routed_intermediate, "intermediate", "stock_code"), classified=ch.classified)
        store.forget("intermediate", version, "names", *(() if "deduplicated" in kept else ("deduplicated",)))
    return ch


def _layer_counts(ch: SalesChain) -> DataFrame:
    dup_removed = ch.dedup_duplicates.agg(
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).cast("long").alias("rows")
    ).select(F.lit("duplicates_removed").alias("layer"), "rows")
    base = quality.row_counts(
        {
            "raw_daily": ch.raw_daily,
            "raw_historical": ch.raw_historical,
            "staging": ch.staging,
            "staging_rejected": ch.staging_rejected,
            "deduplicated": ch.deduped,
            "intermediate": ch.intermediate,
            "intermediate_rejected": ch.intermediate_rejected,
        },
        label="layer",
    )
    return base.unionByName(dup_removed)


def _rejected_by_reason(ch: SalesChain) -> DataFrame:
    return ch.rejected.groupBy("stage", "source_file", "reason").agg(
        F.count(F.lit(1)).cast("long").alias("rejected")
    )


def _execution_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest five log rows of a run of all stages over the tables: the
    layers are written under the shared folder, and the log is read back."""
    from ledgerstar.plans import stages

    root = f"{storage_root(spark)}/execution-log-{stages.new_version()}"
    store = stages.run_stages(spark, raw_lines(spark, sf_dir), root=root)
    return store.last_log_rows(5).select("dag_id", "task_id", "status", "rows_processed")


def _q(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ch = _stored(chain_for(spark, sf_dir), name)
        return qs.all_questions(ch.mart, ch.staging)[name]

    run.__name__ = name
    return run


def _m(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _stored(chain_for(spark, sf_dir), name).mart[name]

    run.__name__ = name
    return run


def _v(fn: Callable[[SalesChain], DataFrame], name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(_stored(chain_for(spark, sf_dir), name))

    run.__name__ = name
    return run


QUESTION_KEYS = [
    "q1_monthly_net_sales", "q2_category_revenue", "q3a_top_products_net",
    "q3b_top_products_return_rate", "q4_country_tickets", "q5_identified_customers",
    "q6a_description_variants", "q6b_unique_product_codes", "q7_category_returns",
]
# Layers that a query reads more than once: several mart tables are made from the
# intermediate layer, kept and rejected lines from staging, clean lines and names
# from the deduplicated lines.
STORED_LAYERS = dict.fromkeys([
    "q1_monthly_net_sales", "q2_category_revenue", "q3a_top_products_net",
    "q3b_top_products_return_rate", "q5_identified_customers", "q7_category_returns",
    "mart_row_counts", "null_violations", "check_violations", "pk_violations",
    "fk_violations", "mart_fingerprint",
], ("intermediate",)) | {
    "rejected_by_reason": ("staging",),
    "layer_row_counts": ("staging", "deduplicated", "intermediate"),
} | dict.fromkeys(["intermediate_clean", "dim_product"], ("deduplicated",))
MART_KEYS = [
    "dim_date", "dim_customer", "dim_country", "dim_product",
    "fact_sales", "fact_returns", "fact_daily_product_revenue",
]

_VIEWS: dict[str, Callable[[SalesChain], DataFrame]] = {
    "raw_sales_daily": lambda ch: ch.raw_daily.select(*RAW_OUTPUT),
    "raw_sales_historical": lambda ch: ch.raw_historical.select(*RAW_OUTPUT),
    "staging_sales_transactions": lambda ch: ch.staging.select(*STAGING_COLUMNS),
    "staging_rejected": lambda ch: ch.staging_rejected,
    "dedup_first_wins": lambda ch: ch.deduped.select(*STAGING_COLUMNS),
    "dedup_key_duplicates": lambda ch: ch.dedup_duplicates,
    "classified_lines": lambda ch: ch.classified.select(*STAGING_COLUMNS, "is_return"),
    "intermediate_rejected": lambda ch: ch.intermediate_rejected,
    "categorized_lines": lambda ch: ch.categorized.select(*STAGING_COLUMNS, "is_return", "line_revenue", "category"),
    "description_frequencies": lambda ch: ch.description_frequencies,
    "canonical_descriptions": lambda ch: ch.canonical,
    "intermediate_clean": lambda ch: ch.intermediate.select(*INTERMEDIATE_COLUMNS),
    "rejected_by_reason": _rejected_by_reason,
    "layer_row_counts": _layer_counts,
    "mart_row_counts": lambda ch: quality.row_counts(ch.mart),
    "null_violations": lambda ch: quality.null_violations(ch.mart),
    "check_violations": lambda ch: quality.check_violations(ch.mart),
    "pk_violations": lambda ch: quality.pk_violations(ch.mart),
    "fk_violations": lambda ch: quality.fk_violations(ch.mart),
    "mart_fingerprint": lambda ch: quality.fingerprint(ch.mart),
}


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    for key in ["raw_sales_daily", "raw_sales_historical", "staging_sales_transactions",
                "staging_rejected", "dedup_first_wins", "dedup_key_duplicates",
                "classified_lines", "intermediate_rejected", "categorized_lines",
                "description_frequencies", "canonical_descriptions", "intermediate_clean"]:
        out[key] = _v(_VIEWS[key], key)
    for key in MART_KEYS:
        out[key] = _m(key)
    for key in QUESTION_KEYS:
        out[key] = _q(key)
    out["execution_log_last5"] = _execution_log
    for key in ["rejected_by_reason", "layer_row_counts", "mart_row_counts", "null_violations",
                "check_violations", "pk_violations", "fk_violations", "mart_fingerprint"]:
        out[key] = _v(_VIEWS[key], key)
    return out
