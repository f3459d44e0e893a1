"""File readers: text-only CSV with encoding, NA tokens, per-sheet union, load order."""

from __future__ import annotations

import os

from ledgerstar.plans.chain import SalesChain
from ledgerstar.sources.files import read_daily_csv, read_sheets


def _write(path, text, encoding):
    with open(path, "w", encoding=encoding, newline="") as fh:
        fh.write(text)


DAILY = (
    "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"
    "536365,85123A,CAFÉ MUG,6,12/1/2010 8:26,2.55,17850.0,United Kingdom\n"
    "536366,22633,\"HAND WARMER, \"\"UNION\"\" JACK\",NA,12/1/2010 8:28,1.85,,France\n"
    "536367,84879,ASSORTED BIRD,32,12/1/2010 8:34,1.69,13047,N/A\n"
)


def test_daily_csv_latin1_and_na_tokens(spark, scratch):
    path = os.path.join(scratch, "data.csv")
    _write(path, DAILY, "ISO-8859-1")
    raw = read_daily_csv(spark, path)
    rows = raw.orderBy("load_order").collect()
    assert [r.invoice_no for r in rows] == ["536365", "536366", "536367"]
    assert rows[0].description == "CAFÉ MUG"
    assert rows[1].description == 'HAND WARMER, "UNION" JACK'
    assert rows[1].quantity is None and rows[1].customer_id is None
    assert rows[2].country is None
    assert {r.source_file for r in rows} == {"data.csv"}
    # every column is text
    assert all(f.dataType.simpleString() == "string" for f in raw.schema.fields[:8])


def test_sheets_in_order_with_lineage(spark, scratch):
    header = "Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country\n"
    y1 = os.path.join(scratch, "y1.csv")
    y2 = os.path.join(scratch, "y2.csv")
    _write(y1, header + "1,A,X,1,2009-12-01 07:45:00,1.0,12346,UK\n", "utf-8")
    _write(y2, header + "1,A,X,5,2009-12-01 07:45:00,1.0,12346,UK\n", "utf-8")
    raw = read_sheets(spark, "book.xlsx", [("Year 2009-2010", y1), ("Year 2010-2011", y2)])
    rows = raw.orderBy("load_order").collect()
    assert [r.source_file for r in rows] == ["book.xlsx:Year 2009-2010", "book.xlsx:Year 2010-2011"]
    # same key in both sheets: the first sheet wins the dedup
    daily = read_daily_csv(spark, _daily_empty(scratch))
    ch = SalesChain.from_feeds(daily, raw)
    out = ch.intermediate.collect()
    assert len(out) == 1 and out[0].quantity == 1


def _daily_empty(scratch):
    path = os.path.join(scratch, "empty.csv")
    _write(path, DAILY.splitlines(True)[0], "ISO-8859-1")
    return path


def test_parquet_sheet(spark, scratch):
    src = spark.createDataFrame(
        [("9", "B", "Y", 3, "2010-01-04 10:00:00", 2.5, 12.0, "UK")],
        "Invoice string, StockCode string, Description string, Quantity int, InvoiceDate string, "
        "Price double, `Customer ID` double, Country string",
    )
    path = os.path.join(scratch, "sheet.parquet")
    src.write.parquet(path)
    raw = read_sheets(spark, "book", [("S1", path)], fmt="parquet")
    r = raw.first()
    assert r.quantity == "3" and r.unit_price == "2.5" and r.customer_id == "12.0"
    ch = SalesChain.from_feeds(read_daily_csv(spark, _daily_empty(scratch)), raw)
    assert ch.staging.first().customer_id == "12"


def test_large_csv_split_keeps_file_order(spark, scratch):
    path = os.path.join(scratch, "big.csv")
    lines = [DAILY.splitlines()[0]]
    for i in range(20000):
        lines.append(f"{i},C{i % 50},THING {i % 7},1,12/1/2010 8:26,1.0,1,UK")
    _write(path, "\n".join(lines) + "\n", "ISO-8859-1")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        raw = read_daily_csv(spark, path)
        assert raw.rdd.getNumPartitions() > 3
        got = [int(r.invoice_no) for r in raw.orderBy("load_order").select("invoice_no").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "256m")
    assert got == list(range(20000))


def test_command_line_run(spark, scratch):
    from ledgerstar.__main__ import main
    from ledgerstar.plans import stages

    daily = os.path.join(scratch, "data.csv")
    _write(daily, DAILY, "ISO-8859-1")
    header = "Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country\n"
    y1 = os.path.join(scratch, "y1.csv")
    _write(y1, header + "536365,85123A,CAFÉ MUG,9,2010-12-01 08:26:00,2.55,17850,United Kingdom\n"
                        "9,B,RED BALL,2,2009-12-01 07:45:00,1.0,,UK\n", "utf-8")
    root = os.path.join(scratch, "layers")
    assert main(["--daily", daily, "--sheet", f"Year 2009-2010={y1}", "--root", root, "--run-id", "cli"]) == 0
    store = stages.LayerStore(spark, root)
    clean = store.read("intermediate", "sales_transactions_clean").collect()
    # daily line wins over the same key in the sheet; the NA-quantity line is rejected
    assert sorted(r.invoice_no for r in clean) == ["536365", "536367", "9"]
    assert [r.quantity for r in clean if r.invoice_no == "536365"] == [6]
    assert store.read("staging", "rejected_records").count() == 1
    assert spark.sql("SELECT count(*) FROM mart.dim_product").first()[0] == 3


def test_files_of_a_folder_may_order_their_columns_differently(spark, scratch):
    import pytest

    folder = os.path.join(scratch, "daily")
    os.mkdir(folder)
    _write(os.path.join(folder, "a.csv"), DAILY, "ISO-8859-1")
    _write(os.path.join(folder, "b.csv"), "StockCode,InvoiceNo,Description,UnitPrice,InvoiceDate,Quantity,CustomerID,Note,Country\n"
           "B,7,CAFÉ \"\"X\"\",3,12/1/2010 8:26,9,1,n,UK\nB,8,X,3,12/1/2010 8:26\n", "ISO-8859-1")
    _write(os.path.join(folder, "c.csv"), DAILY.splitlines(True)[0] + "9,C,MUG,1,12/1/2010 8:26,2,1,UK\n", "ISO-8859-1")
    _write(os.path.join(folder, "d.csv"), "", "ISO-8859-1")
    _write(os.path.join(folder, "_e.csv"), "x\n", "ISO-8859-1")
    ch = SalesChain.from_feeds(read_daily_csv(spark, folder), read_daily_csv(spark, _daily_empty(scratch)))
    alone = SalesChain.from_feeds(read_daily_csv(spark, os.path.join(folder, "a.csv")), read_daily_csv(spark, _daily_empty(scratch)))
    cells = lambda df: {(r.invoice_no, r.stock_code, r.description, r.quantity, str(r.unit_price), r.customer_id, r.country) for r in df.collect()}
    assert cells(ch.staging) - cells(alone.staging) == {("7", "B", 'CAFÉ ""X""', 9, "3.0000", "1", "UK"), ("9", "C", "MUG", 1, "2.0000", "1", "UK")}
    assert cells(alone.staging) <= cells(ch.staging) and ch.staging_rejected.count() == alone.staging_rejected.count() + 1
    order = [r.file.rsplit("/", 1)[1] for r in ch.raw_daily.orderBy("load_order").select("load_order.file").collect()]
    assert order == sorted(order)  # load order follows the files, not their headers
    _write(os.path.join(folder, "f.csv"), "InvoiceNo,StockCode\n1,2\n", "ISO-8859-1")
    with pytest.raises(ValueError, match="header of .*f.csv.*Description"):
        read_daily_csv(spark, folder)
    with pytest.raises(FileNotFoundError):
        read_daily_csv(spark, os.path.join(scratch, "nowhere"))


def test_surplus_and_short_lines_are_rejected_whole(spark, scratch):
    import json

    path = os.path.join(scratch, "data.csv")
    surplus = "1,A,RED, MUG,6,12/1/2010 8:26,2.55,17850,DE"
    short = "2,B,BLUE MUG,6"
    _write(path, DAILY.splitlines(True)[0] + surplus + "\n" + short + "\n3,C,CUP,1,12/1/2010 8:26,1.0,1,UK\n", "ISO-8859-1")
    ch = SalesChain.from_feeds(read_daily_csv(spark, path), read_daily_csv(spark, _daily_empty(scratch)))
    assert [r.invoice_no for r in ch.staging.collect()] == ["3"]
    kept = sorted(json.loads(r.raw_data)["raw_line"] for r in ch.staging_rejected.collect())
    assert kept == [surplus, short]


def test_line_ends_inside_quotes(spark, scratch):
    path = os.path.join(scratch, "data.csv")
    _write(path, DAILY.splitlines(True)[0] + '1,A,"RED\nMUG",6,12/1/2010 8:26,2.55,17850,DE\n', "ISO-8859-1")
    row = read_daily_csv(spark, path, multi_line=True).collect()
    assert len(row) == 1 and row[0].description == "RED\nMUG" and row[0].raw_line is None
