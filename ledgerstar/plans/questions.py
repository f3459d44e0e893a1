"""The nine business questions over the mart (and staging for N6).

Shape of every plan: aggregate the fact down to the join key first (map-side
partial aggregation, one row per key per partition), *then* join the
dimension, then aggregate to the reported grain.  The join therefore sees at
most one row per key instead of every fact row, so neither a hot product nor a
hot day can overload a join task (N5, which joins one row per invoice, splits
off the customer that stands for all unknown ones), and the dimension side is
broadcast only when adaptive execution measures it small.

Output conventions (shared with the SQL oracle):
  * money sums are exact decimals reported as decimal(38,4);
  * ratios and averages are computed from the finished sums in whole numbers,
    rounded half-up (return ratios to 4 places, tickets to 2), reported as double;
  * divisions by a zero sum give NULL (NULLIF), never an error;
  * top-10 lists break ties on stock_code so the cut is deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerstar.schemas import TOTAL_TYPE, UNKNOWN_CUSTOMER


def _ratio(num: str, den: str, places: int) -> Column:
    """num / den (sums of four decimals, or counts) rounded half up to `places`
    digits in whole numbers, NULL for a zero den; only the finished value
    becomes a double."""
    n, d = (f"cast(cast({c} AS decimal(34,4)) * 10000 AS decimal(38,0))" for c in (num, den))
    whole = F.expr(f"(2 * {n} * {10**places} + {d}) div nullif(2 * {d}, cast(0 AS decimal(38,0)))")
    return whole.cast("double") / F.lit(float(10**places))


def _product_totals(daily: DataFrame) -> DataFrame:
    """fact_daily_product_revenue summed per stock_code (pre-join aggregate)."""
    return daily.groupBy("stock_code").agg(
        F.sum("gross_revenue").alias("g"),
        F.sum("returns_amount").alias("r"),
        F.sum("net_revenue").alias("n"),
    )


def q1_monthly_net_sales(daily: DataFrame, dim_date: DataFrame) -> DataFrame:
    """N1: net sales per calendar month, chronological."""
    per_day = daily.groupBy("sale_date").agg(F.sum("net_revenue").alias("n"))
    joined = per_day.join(dim_date, per_day.sale_date == dim_date.date_day)
    return (
        joined.groupBy("year", "month", "month_name")
        .agg(F.sum("n").cast(TOTAL_TYPE).alias("net_sales"))
        .select(
            F.col("year").cast("int").alias("year"),
            F.col("month").cast("int").alias("month"),
            "month_name",
            "net_sales",
        )
        .orderBy("year", "month")
    )


def _category_totals(daily: DataFrame, dim_product: DataFrame) -> DataFrame:
    joined = _product_totals(daily).join(dim_product.select("stock_code", "category"), "stock_code")
    return joined.groupBy("category").agg(F.sum("g").alias("g"), F.sum("r").alias("r"))


def q2_category_revenue(daily: DataFrame, dim_product: DataFrame) -> DataFrame:
    """N2: categories by gross revenue, with the returned share."""
    t = _category_totals(daily, dim_product)
    return t.select(
        "category",
        F.col("g").cast(TOTAL_TYPE).alias("gross_revenue"),
        F.col("r").cast(TOTAL_TYPE).alias("returns_amount"),
        _ratio("r", "g", 4).alias("return_ratio"),
    ).orderBy(F.desc("gross_revenue"), "category")


def q3a_top_products_net(daily: DataFrame, dim_product: DataFrame) -> DataFrame:
    """N3a: the ten products with the highest net revenue."""
    joined = _product_totals(daily).join(dim_product, "stock_code")
    return (
        joined.select(
            "stock_code", "canonical_description", "category",
            F.col("n").cast(TOTAL_TYPE).alias("net_revenue"),
        )
        .orderBy(F.desc("net_revenue"), "stock_code")
        .limit(10)
    )


def q3b_top_products_return_rate(daily: DataFrame, dim_product: DataFrame) -> DataFrame:
    """N3b: the ten products with the highest return rate among those with gross > 0."""
    joined = _product_totals(daily).filter(F.col("g") > 0).join(dim_product, "stock_code")
    return (
        joined.select(
            "stock_code", "canonical_description", "category",
            F.col("g").cast(TOTAL_TYPE).alias("gross_revenue"),
            F.col("r").cast(TOTAL_TYPE).alias("returns_amount"),
            _ratio("r", "g", 4).alias("return_rate"),
        )
        .orderBy(F.desc("return_rate"), "stock_code")
        .limit(10)
    )


def q4_country_tickets(fact_sales: DataFrame) -> DataFrame:
    """N4: transactions (distinct invoices) and average ticket per country.

    count(DISTINCT invoice_no) is planned as two aggregation levels, the first
    keyed on (country, invoice_no); a dominant country is thus spread over its
    invoices and only one partial row per partition reaches the final step."""
    t = fact_sales.groupBy("country").agg(
        F.count_distinct("invoice_no").alias("transactions"),
        F.sum("gross_revenue").alias("g"),
    )
    return t.select(
        "country",
        "transactions",
        _ratio("g", "transactions", 2).alias("avg_ticket"),
    ).orderBy(F.desc("transactions"), "country")


def q5_identified_customers(fact_sales: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """N5: identified vs unknown customers: invoices, average line, average ticket."""
    per_invoice = fact_sales.groupBy("customer_id", "invoice_no").agg(
        F.sum("gross_revenue").alias("g"), F.count(F.lit(1)).alias("lines")
    )
    # all invoices without a customer share one key: they meet that customer's
    # single row (the key is unique) by broadcast, the others by key
    unknown = F.col("customer_id") == F.lit(UNKNOWN_CUSTOMER)
    joined = per_invoice.filter(~unknown).join(dim_customer.filter(~unknown), "customer_id").unionByName(
        per_invoice.filter(unknown).join(F.broadcast(dim_customer.filter(unknown)), "customer_id"))
    t = joined.groupBy("is_identified").agg(
        F.count_distinct("invoice_no").alias("transactions"),
        F.sum("g").alias("g"),
        F.sum("lines").alias("lines"),
    )
    return t.select(
        "is_identified",
        "transactions",
        _ratio("g", "lines", 2).alias("avg_line_revenue"),
        _ratio("g", "transactions", 2).alias("avg_ticket"),
    )


def q6a_description_variants(staging: DataFrame) -> DataFrame:
    """N6a: product codes spelled more than one way in staging (before dedup)."""
    variants = F.count_distinct(F.upper(F.trim(F.col("description"))))
    return (
        staging.groupBy("stock_code")
        .agg(variants.alias("description_variants"))
        .filter(F.col("description_variants") > 1)
        .orderBy(F.desc("description_variants"), "stock_code")
    )


def q6b_unique_product_codes(staging: DataFrame) -> DataFrame:
    """N6b: number of distinct product codes in staging."""
    return staging.agg(F.count_distinct("stock_code").alias("unique_product_codes"))


def q7_category_returns(daily: DataFrame, dim_product: DataFrame) -> DataFrame:
    """N7: categories by returned amount, with the ratio to gross."""
    t = _category_totals(daily, dim_product)
    return t.select(
        "category",
        F.col("r").cast(TOTAL_TYPE).alias("total_returns"),
        F.col("g").cast(TOTAL_TYPE).alias("total_gross"),
        _ratio("r", "g", 4).alias("return_ratio"),
    ).orderBy(F.desc("total_returns"), "category")


def all_questions(mart: dict[str, DataFrame], staging: DataFrame) -> dict[str, DataFrame]:
    daily = mart["fact_daily_product_revenue"]
    return {
        "q1_monthly_net_sales": q1_monthly_net_sales(daily, mart["dim_date"]),
        "q2_category_revenue": q2_category_revenue(daily, mart["dim_product"]),
        "q3a_top_products_net": q3a_top_products_net(daily, mart["dim_product"]),
        "q3b_top_products_return_rate": q3b_top_products_return_rate(daily, mart["dim_product"]),
        "q4_country_tickets": q4_country_tickets(mart["fact_sales"]),
        "q5_identified_customers": q5_identified_customers(mart["fact_sales"], mart["dim_customer"]),
        "q6a_description_variants": q6a_description_variants(staging),
        "q6b_unique_product_codes": q6b_unique_product_codes(staging),
        "q7_category_returns": q7_category_returns(daily, mart["dim_product"]),
    }
