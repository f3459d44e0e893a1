"""Small builders for hand-written feed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerstar.schemas import RANK_DAILY, RANK_HISTORICAL, RAW_COLUMNS

SF_SMALL = "/root/testdata/sf0.001"

_TEXT = T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS + ["source_file"]]
                     + [T.StructField("pos", T.LongType(), False)])

BASE = {
    "invoice_no": "536365",
    "stock_code": "85123A",
    "description": "WHITE HANGING HEART",
    "quantity": "6",
    "invoice_date": "12/1/2010 8:26",
    "unit_price": "2.55",
    "customer_id": "17850",
    "country": "United Kingdom",
}
HIST_DATE = "2010-12-01 08:26:00"


def line(**over) -> dict:
    row = dict(BASE)
    row.update(over)
    return row


def raw_frame(spark: SparkSession, rows: list[dict], historical: bool = False,
              source_file: str | None = None) -> DataFrame:
    """A raw feed DataFrame (8 text columns + lineage + load order) from dicts;
    list order is load order."""
    src = source_file or ("hist:Y1" if historical else "data.csv")
    data = []
    for i, r in enumerate(rows):
        r = dict(r)
        if historical and "invoice_date" not in r:
            r["invoice_date"] = HIST_DATE
        data.append(tuple(r.get(c) for c in RAW_COLUMNS) + (r.get("source_file", src), i))
    df = spark.createDataFrame(data, _TEXT)
    return df.select(
        *RAW_COLUMNS,
        "source_file",
        F.current_timestamp().alias("loaded_at"),
        F.lit(RANK_HISTORICAL if historical else RANK_DAILY).alias("src_rank"),
        F.struct(F.col("pos")).alias("load_order"),
    )


def chain(spark: SparkSession, daily: list[dict], historical: list[dict] | None = None, **kw):
    from ledgerstar.plans.chain import SalesChain

    hist_rows = []
    for r in historical or []:
        r = dict(r)
        r.setdefault("invoice_date", HIST_DATE)
        hist_rows.append(r)
    return SalesChain.from_feeds(raw_frame(spark, daily), raw_frame(spark, hist_rows, historical=True), **kw)
