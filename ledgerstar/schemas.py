"""Declared layer schemas, column lists and business constants.

Every table of the four layers (raw, staging, intermediate, mart) has a fixed
StructType here.  Transformations select these column lists at their output so
that a layer's shape never depends on what the optimizer happened to keep.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values.  These literals must equal the source system's for results to
# match (default texts, reject reasons, column names of the two feeds).
# ---------------------------------------------------------------------------
UNKNOWN_CUSTOMER = "UNKNOWN"
DEFAULT_CATEGORY = "Sin clasificar"
NULL_TEXT = "None"  # how a missing country/description is rendered as text
REASON_UNPARSABLE = "cantidad, precio, fecha, invoice_no o stock_code no validos"
REASON_NONPOSITIVE_SALE_PRICE = "precio unitario <= 0 en una venta"

DAILY_COLUMN_MAP = {
    "InvoiceNo": "invoice_no",
    "StockCode": "stock_code",
    "Description": "description",
    "Quantity": "quantity",
    "InvoiceDate": "invoice_date",
    "UnitPrice": "unit_price",
    "CustomerID": "customer_id",
    "Country": "country",
}
HISTORICAL_COLUMN_MAP = {
    "Invoice": "invoice_no",
    "StockCode": "stock_code",
    "Description": "description",
    "Quantity": "quantity",
    "InvoiceDate": "invoice_date",
    "Price": "unit_price",
    "Customer ID": "customer_id",
    "Country": "country",
}
DAILY_SOURCE_FILE = "data.csv"
# ---------------------------------------------------------------------------

# Date texts of the two feeds (configurable; the feeds differ in layout).
DAILY_DATE_FORMAT = "M/d/yyyy H:mm"
HISTORICAL_DATE_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Source ranks: lower rank wins the first-wins dedup (daily before historical).
RANK_DAILY = 0
RANK_HISTORICAL = 1

RAW_COLUMNS = [
    "invoice_no", "stock_code", "description", "quantity",
    "invoice_date", "unit_price", "customer_id", "country",
]
# Bookkeeping columns that travel with every line but are not business data:
# src_rank + load_order together give the load order used by first-wins rules.
ORDER_COLUMNS = ["src_rank", "load_order"]

PRICE_TYPE = T.DecimalType(12, 4)
AMOUNT_TYPE = T.DecimalType(14, 4)
# Sums over many lines are reported at full width so they never overflow.
TOTAL_TYPE = T.DecimalType(38, 4)


def _f(name, dtype, nullable=True, comment=None):
    meta = {"comment": comment} if comment else {}
    return T.StructField(name, dtype, nullable, meta)


RAW_SCHEMA = T.StructType(
    [_f(c, T.StringType()) for c in RAW_COLUMNS]
    + [
        _f("source_file", T.StringType(), False, "file (and sheet) the line came from"),
        _f("loaded_at", T.TimestampType(), False),
    ]
)

STAGING_SCHEMA = T.StructType([
    _f("invoice_no", T.StringType(), False),
    _f("stock_code", T.StringType(), False),
    _f("description", T.StringType()),
    _f("quantity", T.IntegerType(), False),
    _f("unit_price", PRICE_TYPE, False),
    _f("invoice_date", T.TimestampType(), False, "labelled UTC, never shifted"),
    _f("customer_id", T.StringType(), False),
    _f("country", T.StringType()),
    _f("source_file", T.StringType(), False),
    _f("dedup_key", T.StringType(), False, "invoice_no|stock_code|customer_id|yyyy-MM-dd"),
])

INTERMEDIATE_SCHEMA = T.StructType([
    _f("invoice_no", T.StringType(), False),
    _f("stock_code", T.StringType(), False),
    _f("canonical_description", T.StringType()),
    _f("category", T.StringType(), False),
    _f("quantity", T.IntegerType(), False),
    _f("unit_price", PRICE_TYPE, False),
    _f("invoice_date", T.TimestampType(), False),
    _f("customer_id", T.StringType(), False),
    _f("country", T.StringType()),
    _f("is_return", T.BooleanType(), False, "quantity <= 0"),
    _f("line_revenue", AMOUNT_TYPE, False, "quantity * unit_price, signed"),
    _f("source_file", T.StringType(), False),
])

DIM_DATE_SCHEMA = T.StructType([
    _f("date_day", T.DateType(), False),
    _f("year", T.ShortType(), False),
    _f("quarter", T.ShortType(), False),
    _f("month", T.ShortType(), False),
    _f("month_name", T.StringType(), False),
    _f("day", T.ShortType(), False),
    _f("day_of_week", T.StringType(), False),
    _f("is_weekend", T.BooleanType(), False),
])
DIM_CUSTOMER_SCHEMA = T.StructType([
    _f("customer_id", T.StringType(), False),
    _f("is_identified", T.BooleanType(), False),
])
DIM_COUNTRY_SCHEMA = T.StructType([_f("country", T.StringType(), False)])
DIM_PRODUCT_SCHEMA = T.StructType([
    _f("stock_code", T.StringType(), False),
    _f("canonical_description", T.StringType()),
    _f("category", T.StringType(), False),
])
FACT_SALES_SCHEMA = T.StructType([
    _f("invoice_no", T.StringType(), False),
    _f("stock_code", T.StringType(), False),
    _f("customer_id", T.StringType(), False),
    _f("country", T.StringType(), False),
    _f("sale_date", T.DateType(), False),
    _f("invoice_ts", T.TimestampType(), False),
    _f("quantity", T.IntegerType(), False, "> 0"),
    _f("unit_price", PRICE_TYPE, False, "> 0"),
    _f("gross_revenue", AMOUNT_TYPE, False),
])
FACT_RETURNS_SCHEMA = T.StructType([
    _f("invoice_no", T.StringType(), False),
    _f("stock_code", T.StringType(), False),
    _f("customer_id", T.StringType(), False),
    _f("country", T.StringType(), False),
    _f("sale_date", T.DateType(), False),
    _f("invoice_ts", T.TimestampType(), False),
    _f("quantity", T.IntegerType(), False, "<= 0"),
    _f("unit_price", PRICE_TYPE, False),
    _f("return_amount", AMOUNT_TYPE, False),
])
FACT_DAILY_SCHEMA = T.StructType([
    _f("stock_code", T.StringType(), False),
    _f("sale_date", T.DateType(), False),
    _f("gross_revenue", AMOUNT_TYPE, False),
    _f("returns_amount", AMOUNT_TYPE, False),
    _f("net_revenue", AMOUNT_TYPE, False),
])
REJECT_SCHEMA = T.StructType([
    _f("stage", T.StringType(), False, "staging | intermediate"),
    _f("source_file", T.StringType(), False),
    _f("raw_data", T.StringType(), True, "JSON object, every field as text, nulls kept"),
    _f("reason", T.StringType(), False),
])
EXECUTION_LOG_SCHEMA = T.StructType([
    _f("dag_id", T.StringType(), False),
    _f("run_id", T.StringType(), False),
    _f("task_id", T.StringType(), False),
    _f("execution_date", T.DateType(), False),
    _f("status", T.StringType(), False),
    _f("rows_processed", T.LongType()),
    _f("started_at", T.TimestampType(), False),
    _f("ended_at", T.TimestampType()),
])

# Column names in declared order.
STAGING_COLUMNS, INTERMEDIATE_COLUMNS, REJECT_COLUMNS, EXECUTION_LOG_COLUMNS = (
    schema.names for schema in (STAGING_SCHEMA, INTERMEDIATE_SCHEMA, REJECT_SCHEMA, EXECUTION_LOG_SCHEMA)
)
DIM_DATE_COLUMNS, DIM_CUSTOMER_COLUMNS, DIM_COUNTRY_COLUMNS, DIM_PRODUCT_COLUMNS = (
    schema.names for schema in (DIM_DATE_SCHEMA, DIM_CUSTOMER_SCHEMA, DIM_COUNTRY_SCHEMA, DIM_PRODUCT_SCHEMA)
)
SALES_COLUMNS, RETURNS_COLUMNS, DAILY_REVENUE_COLUMNS = (
    schema.names for schema in (FACT_SALES_SCHEMA, FACT_RETURNS_SCHEMA, FACT_DAILY_SCHEMA)
)

# Primary keys (natural keys) used by the uniqueness checks.
PRIMARY_KEYS = {
    "dim_date": ["date_day"],
    "dim_customer": ["customer_id"],
    "dim_country": ["country"],
    "dim_product": ["stock_code"],
    "fact_daily_product_revenue": ["stock_code", "sale_date"],
}
# Foreign keys: (fact, fact column, dimension, dimension column).
FOREIGN_KEYS = [
    ("fact_sales", "stock_code", "dim_product", "stock_code"),
    ("fact_sales", "customer_id", "dim_customer", "customer_id"),
    ("fact_sales", "country", "dim_country", "country"),
    ("fact_sales", "sale_date", "dim_date", "date_day"),
    ("fact_returns", "stock_code", "dim_product", "stock_code"),
    ("fact_returns", "customer_id", "dim_customer", "customer_id"),
    ("fact_returns", "country", "dim_country", "country"),
    ("fact_returns", "sale_date", "dim_date", "date_day"),
    ("fact_daily_product_revenue", "stock_code", "dim_product", "stock_code"),
    ("fact_daily_product_revenue", "sale_date", "dim_date", "date_day"),
]

MART_SCHEMAS = {
    "dim_date": DIM_DATE_SCHEMA,
    "dim_customer": DIM_CUSTOMER_SCHEMA,
    "dim_country": DIM_COUNTRY_SCHEMA,
    "dim_product": DIM_PRODUCT_SCHEMA,
    "fact_sales": FACT_SALES_SCHEMA,
    "fact_returns": FACT_RETURNS_SCHEMA,
    "fact_daily_product_revenue": FACT_DAILY_SCHEMA,
}
