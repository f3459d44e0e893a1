"""Hand-written edge rows, one per business rule (FIXTURES.md §2)."""

from __future__ import annotations

import json
from decimal import Decimal

from helpers import HIST_DATE, chain, line

from ledgerstar.schemas import REASON_NONPOSITIVE_SALE_PRICE, REASON_UNPARSABLE


def staged(spark, rows, **kw):
    return chain(spark, rows, **kw).staging.orderBy("load_order").collect()


def test_unparsable_quantity_rejected(spark):
    rows = [line(quantity=q) for q in ["abc", None, "1,000", "1.0d", "NaN", "inf", ""]]
    ch = chain(spark, rows)
    assert ch.staging.count() == 0
    rej = ch.staging_rejected.collect()
    assert len(rej) == len(rows)
    assert {r.reason for r in rej} == {REASON_UNPARSABLE}


def test_quantity_parsing_truncates(spark):
    got = [r.quantity for r in staged(spark, [
        line(quantity=" 5 ", invoice_no="1"), line(quantity="1e3", invoice_no="2"),
        line(quantity="2.7", invoice_no="3"), line(quantity="-2.7", invoice_no="4"),
    ])]
    assert got == [5, 1000, 2, -2]


def test_half_quantity_is_zero_return(spark):
    ch = chain(spark, [line(quantity="0.5")])
    row = ch.intermediate.first()
    assert row.quantity == 0 and row.is_return and row.line_revenue == Decimal("0.0000")


def test_bad_price_rejected_and_rounding(spark):
    ch = chain(spark, [line(unit_price="x", invoice_no="1"), line(unit_price="2.00005", invoice_no="2")])
    assert ch.staging_rejected.count() == 1
    assert ch.staging.first().unit_price == Decimal("2.0001")


def test_tiny_price_rounds_to_zero_then_rejected_as_sale(spark):
    ch = chain(spark, [line(unit_price="0.00004", quantity="1")])
    assert ch.staging.first().unit_price == Decimal("0.0000")
    rej = ch.intermediate_rejected.collect()
    assert len(rej) == 1 and rej[0].reason == REASON_NONPOSITIVE_SALE_PRICE
    assert ch.intermediate.count() == 0


def test_day_first_date_rejected_in_month_first_feed(spark):
    ch = chain(spark, [line(invoice_date="13/1/2010 8:26")])
    assert ch.staging.count() == 0 and ch.staging_rejected.count() == 1


def test_blank_invoice_or_code_rejected(spark):
    rows = [line(invoice_no=None), line(invoice_no="  "), line(stock_code=None), line(stock_code="\t")]
    ch = chain(spark, rows)
    assert ch.staging.count() == 0 and ch.staging_rejected.count() == 4


def test_customer_normalisation(spark):
    got = [r.customer_id for r in staged(spark, [
        line(customer_id=None, invoice_no="1"), line(customer_id="", invoice_no="2"),
        line(customer_id="   ", invoice_no="3"), line(customer_id="17850.0", invoice_no="4"),
        line(customer_id=" 12 ", invoice_no="5"),
    ])]
    assert got == ["UNKNOWN", "UNKNOWN", "UNKNOWN", "17850", "12"]


def test_identified_flag(spark):
    ch = chain(spark, [line(customer_id=None, invoice_no="1"), line(customer_id="7", invoice_no="2")])
    dims = {r.customer_id: r.is_identified for r in ch.mart["dim_customer"].collect()}
    assert dims == {"UNKNOWN": False, "7": True}


def test_stock_code_normalised(spark):
    assert staged(spark, [line(stock_code=" 85123 a ")])[0].stock_code == "85123A"


def test_description_and_country_strip_and_none(spark):
    r = staged(spark, [line(description="\tRED MUG \n", country=None)])[0]
    assert r.description == "RED MUG" and r.country == "None"


def test_null_description_becomes_none_text(spark):
    ch = chain(spark, [line(description=None)])
    row = ch.intermediate.first()
    assert row.category == "Sin clasificar"
    assert row.canonical_description == "NONE"


def test_null_country_gets_dimension_row(spark):
    ch = chain(spark, [line(country=None)])
    assert [r.country for r in ch.mart["dim_country"].collect()] == ["None"]


def test_daily_beats_historical(spark):
    hist = [line(quantity="7", invoice_date=HIST_DATE)]
    ch = chain(spark, [line(quantity="3")], hist)
    rows = ch.intermediate.collect()
    assert len(rows) == 1 and rows[0].quantity == 3 and rows[0].source_file == "data.csv"


def test_first_copy_in_feed_wins(spark):
    ch = chain(spark, [line(quantity="3"), line(quantity="9")])
    assert [r.quantity for r in ch.intermediate.collect()] == [3]


def test_invalid_first_copy_loses_valid_second(spark):
    ch = chain(spark, [line(unit_price="0"), line(unit_price="2.5")])
    assert ch.intermediate.count() == 0
    assert ch.intermediate_rejected.count() == 1


def test_zero_quantity_zero_price_is_return(spark):
    ch = chain(spark, [line(quantity="0", unit_price="0")])
    assert ch.intermediate_rejected.count() == 0
    assert ch.mart["fact_returns"].count() == 1


def test_negative_quantity_zero_price_is_return(spark):
    ch = chain(spark, [line(quantity="-3", unit_price="0")])
    r = ch.mart["fact_returns"].first()
    assert r.quantity == -3 and r.return_amount == Decimal("0.0000")
    assert ch.intermediate_rejected.count() == 0


def test_substring_category_priority(spark):
    ch = chain(spark, [line(description="WHITE CHATEAU HEART")])
    assert ch.intermediate.first().category == "Ropa"


def test_canonical_tie_is_alphabetical(spark):
    rows = [line(description="b mug", invoice_no="1"), line(description="A MUG", invoice_no="2")]
    ch = chain(spark, rows)
    assert {r.canonical_description for r in ch.intermediate.collect()} == {"A MUG"}


def test_canonical_most_frequent(spark):
    rows = [line(description="z cup", invoice_no=str(i)) for i in range(3)]
    rows += [line(description="a cup", invoice_no=str(10 + i)) for i in range(2)]
    ch = chain(spark, rows)
    assert {r.canonical_description for r in ch.intermediate.collect()} == {"Z CUP"}


def test_blank_only_descriptions_keep_row_with_null_name(spark):
    ch = chain(spark, [line(description="   ")])
    r = ch.intermediate.first()
    assert r is not None and r.canonical_description is None


def test_returns_only_day_has_negative_net(spark):
    ch = chain(spark, [line(quantity="-2", unit_price="1.5")])
    r = ch.mart["fact_daily_product_revenue"].first()
    assert r.gross_revenue == 0 and r.returns_amount == Decimal("3.0000") and r.net_revenue == Decimal("-3.0000")


def test_category_with_zero_gross_has_null_ratio(spark):
    from ledgerstar.plans.questions import q2_category_revenue

    ch = chain(spark, [line(quantity="-2", unit_price="1.5")])
    r = q2_category_revenue(ch.mart["fact_daily_product_revenue"], ch.mart["dim_product"]).first()
    assert r.return_ratio is None


def test_reject_payload_keeps_nulls(spark):
    ch = chain(spark, [line(quantity="abc", customer_id=None, description='say "hi"')])
    payload = json.loads(ch.staging_rejected.first().raw_data)
    assert payload["customer_id"] is None
    assert payload["description"] == 'say "hi"'
    assert list(payload)[:3] == ["invoice_no", "stock_code", "description"]


def test_intermediate_reject_payload_renders_python_style(spark):
    ch = chain(spark, [line(unit_price="0")])
    payload = json.loads(ch.intermediate_rejected.first().raw_data)
    assert payload["is_return"] == "False"
    assert payload["unit_price"] == "0.0000"
    assert payload["invoice_date"] == "2010-12-01 08:26:00+00:00"


def test_weekend_flag(spark):
    ch = chain(spark, [line(invoice_date="12/4/2010 10:00")])  # a Saturday
    r = ch.mart["dim_date"].first()
    assert r.is_weekend and r.day_of_week == "Saturday" and r.month_name == "December"


def test_dim_product_takes_first_line_category(spark):
    rows = [line(description="RED BALL", invoice_no="1"), line(description="RED MUG", invoice_no="2"),
            line(description="RED MUG", invoice_no="3")]
    ch = chain(spark, rows)
    p = ch.mart["dim_product"].first()
    assert p.category == "Deportes" and p.canonical_description == "RED MUG"


def test_overflowing_quantity_aborts(spark):
    import pytest

    ch = chain(spark, [line(quantity="1e20")])
    with pytest.raises(Exception):
        ch.staging.collect()


def test_null_text_option_keeps_nulls(spark):
    ch = chain(spark, [line(description=None, country=None)], null_text=None)
    r = ch.staging.first()
    assert r.description is None and r.country == "None"
    both = chain(spark, [line(description=None, country=None)], null_text=None, country_null_text=None).staging.first()
    assert both.description is None and both.country is None


def test_rejected_sale_never_computes_revenue(spark):
    """An invalid sale whose revenue would overflow decimal(14,4) is rejected,
    not a job failure (the routed intermediate computes revenue on kept lines only)."""
    from ledgerstar.plans.stages import routed_intermediate

    ch = chain(spark, [line(quantity="2000000000", unit_price="-99999999", invoice_no="1"),
                       line(invoice_no="2")])
    rows = {r.invoice_no: r.route for r in routed_intermediate(ch.staging).collect()}
    assert rows == {"1": "rejected", "2": "kept"}
