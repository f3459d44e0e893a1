"""The whole raw -> staging -> intermediate -> mart chain as lazy DataFrames.

`SalesChain` wires the operators together once; every attribute is a lazy
DataFrame, built on first access and cached on the object (the *plan*, not
the data).  The views are routes of the same frames that `stages.py` writes;
there each layer is stored and read back, which cuts lineage between stages.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerstar.operators import canonical as cn
from ledgerstar.operators import mart as mt
from ledgerstar.operators import rules
from ledgerstar.operators.dedup import duplicate_keys
from ledgerstar.operators.staging import routed_lines
from ledgerstar.schemas import (
    DAILY_DATE_FORMAT,
    HISTORICAL_DATE_FORMAT,
    INTERMEDIATE_COLUMNS,
    NULL_TEXT,
    ORDER_COLUMNS,
    RANK_DAILY,
    RANK_HISTORICAL,
    REJECT_COLUMNS,
    STAGING_COLUMNS,
)


class SalesChain:
    """`raw` is the union of all feeds (8 text columns, source_file, loaded_at,
    src_rank, load_order); `date_formats` maps src_rank to the feed's pattern."""

    def __init__(
        self,
        raw: DataFrame,
        keywords: dict | None = None,
        dedup_method: str = "aggregate",
        null_text: str | None = NULL_TEXT,
        country_null_text: str | None = NULL_TEXT,
        date_formats: dict[int, str] | None = None,
    ):
        self.raw = raw
        self.keywords = keywords
        self.dedup_method = dedup_method
        self.null_text = null_text
        self.country_null_text = country_null_text
        self.date_formats = date_formats or {
            RANK_DAILY: DAILY_DATE_FORMAT,
            RANK_HISTORICAL: HISTORICAL_DATE_FORMAT,
        }

    @classmethod
    def from_feeds(cls, daily_raw: DataFrame, historical_raw: DataFrame, **kwargs) -> SalesChain:
        return cls(daily_raw.unionByName(historical_raw), **kwargs)

    @property
    def raw_daily(self) -> DataFrame:
        return self.raw.filter(F.col("src_rank") == RANK_DAILY)

    @property
    def raw_historical(self) -> DataFrame:
        return self.raw.filter(F.col("src_rank") == RANK_HISTORICAL)

    # -- staging ---------------------------------------------------------
    @cached_property
    def _routed_staging(self) -> DataFrame:
        return routed_lines(self.raw, self.date_formats, self.null_text, self.country_null_text)

    @cached_property
    def staging(self) -> DataFrame:
        """Typed lines of both feeds (+ src_rank, load_order)."""
        return self._routed_staging.filter("route = 'kept'").select(*STAGING_COLUMNS, *ORDER_COLUMNS)

    @cached_property
    def staging_rejected(self) -> DataFrame:
        return self._routed_staging.filter("route = 'rejected'").select(*REJECT_COLUMNS)

    # -- intermediate ----------------------------------------------------
    @cached_property
    def deduped(self) -> DataFrame:
        return self.classified.drop("is_return")

    @cached_property
    def dedup_duplicates(self) -> DataFrame:
        return duplicate_keys(self.staging, "dedup_key")

    @cached_property
    def classified(self) -> DataFrame:
        return rules.deduplicated_lines(self.staging, self.dedup_method)

    @cached_property
    def categorized(self) -> DataFrame:
        return rules.priced_lines(self.classified, self.keywords).filter("route = 'kept'").drop("route")

    @cached_property
    def description_frequencies(self) -> DataFrame:
        return cn.description_frequencies(self.categorized)

    @cached_property
    def canonical(self) -> DataFrame:
        return cn.canonical_descriptions(self.description_frequencies)

    @cached_property
    def names(self) -> DataFrame:
        """Measured canonical name of every product of the deduplicated lines."""
        return rules.product_names(self.classified)

    @cached_property
    def _routed_intermediate(self) -> DataFrame:
        return rules.routed_clean(self.classified, self.names, self.keywords)

    @cached_property
    def intermediate_rejected(self) -> DataFrame:
        return self._routed_intermediate.filter("route = 'rejected'").select(*REJECT_COLUMNS)

    @cached_property
    def intermediate(self) -> DataFrame:
        """intermediate.sales_transactions_clean (+ src_rank, load_order)."""
        return self._routed_intermediate.filter("route = 'kept'").select(*INTERMEDIATE_COLUMNS, *ORDER_COLUMNS)

    @property
    def rejected(self) -> DataFrame:
        return self.staging_rejected.unionByName(self.intermediate_rejected)

    def with_layers(self, staging: DataFrame | None = None, intermediate: DataFrame | None = None, **steps: DataFrame) -> SalesChain:
        """This chain on routed layers that are already there (its own, stored and
        read back): what is made of them starts there, where each table would
        otherwise run the chain from raw by itself.  `steps` are frames of this
        chain by their name (staged lines as `staged`, `classified`, `names`)."""
        out = SalesChain(self.raw, self.keywords, self.dedup_method, self.null_text, self.country_null_text, self.date_formats)
        if staging is not None:
            out._routed_staging = staging
        if intermediate is not None:
            out._routed_intermediate = intermediate
        if "staged" in steps:
            out.staging = steps.pop("staged")
        for name in ("classified", "names"):
            if name in steps:
                setattr(out, name, steps.pop(name))
        if steps:
            raise TypeError(f"no steps of the chain: {sorted(steps)}")
        return out

    # -- mart ------------------------------------------------------------
    @cached_property
    def mart(self) -> dict[str, DataFrame]:
        return mt.build_mart(self.intermediate)
