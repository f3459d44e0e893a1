import base64
import hashlib
import io

import pytest
import zstandard
from pyspark.sql import functions as F

from ledgerstar.llm.shared import new_folder
from ledgerstar.llm.warc_zstd import fetch, filesystem, op10_query, parse_records, read_archives, seek_table, write_archives

ROWS = [(1, "http://a/ b\r\nX: y", "<p>same</p>"), (2, None, "<p>same</p>"), (3, "http://c/é", None), (4, "u", ""), (5, "u", "x" * 300_000),
        (6, "u", "WARC/1.1\r\n\r\n\r\n"), (7, "u", "<p>same</p>"), (7, "u", "<p>same</p>"), (None, "u", "<p>same</p>"), (None, None, "alone")]


def expected(rows, min_bytes=0):
    best = {}
    for i, _, h in rows:
        if i is not None:
            best[h or ""] = max(best.get(h or "", i), i)
    out = []
    for i, _, h in rows:
        raw, keep = (h or "").encode(), best.get(h or "")
        revisit = keep is not None and keep != i and len(raw) >= min_bytes
        out.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if revisit else "response", keep if revisit else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("min_bytes,frame_bytes,bundle_bytes", [(0, 1 << 20, 64 << 20), (5, 100, 300)])
def test_round_trip(spark, min_bytes, frame_bytes, bundle_bytes):
    pages = spark.createDataFrame([(*r, "extra") for r in ROWS], "page_id long, url string, html string, payload string").select("*", F.lit(1).alias("frame"))
    index = write_archives(pages, new_folder(spark, "warc"), min_bytes, frame_bytes, bundle_bytes)
    records = read_archives(index).collect()
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in records), key=repr)
    assert got == expected(ROWS, min_bytes)
    html = {(i, (h or "").encode()) for i, _, h in ROWS}
    assert {(r.page_id, bytes(r.payload)) for r in records if r.payload is not None} <= html
    assert {(r.page_id, r.url) for r in records} == {(i, u) for i, u, _ in ROWS}
    one = fetch(index, spark.createDataFrame([(5,), (4,)], "page_id long")).collect()
    assert sorted((r.page_id, r.payload_bytes) for r in one) == [(4, 0), (5, 300_000)]


def test_bundles_are_plain_zstd_with_seek_table(spark):
    pages = spark.createDataFrame([(i, "u", f"page {i}" * 30) for i in range(40)], "page_id long, url string, html string").coalesce(1)
    index = write_archives(pages, new_folder(spark, "warc"), frame_bytes=1000)
    for path in [r.bundle for r in index.select("bundle").distinct().collect()]:
        fs, inner = filesystem(path)
        with fs.open_input_file(inner) as f:
            frames, raw = seek_table(f), None
            f.seek(0)
            raw = f.read()
        plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw), read_across_frames=True).read()
        assert len(plain) == sum(x[2] for x in frames) and len(frames) > 1
        held = [r["page_id"] for r in parse_records(plain)]
        assert sorted(held) == sorted(r.page_id for r in index.where(F.col("bundle") == path).collect())


def test_empty_table_and_given_table(spark, sf):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert read_archives(write_archives(empty, new_folder(spark, "warc"))).collect() == []
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html").collect()]
    assert sorted(map(tuple, op10_query(spark, sf).collect()), key=repr) == expected(rows)


def test_frames_are_read_by_many_tasks(spark):
    pages = spark.createDataFrame([(i, "u", f"page {i}" * 30) for i in range(200)], "page_id long, url string, html string").coalesce(1)
    index = write_archives(pages, new_folder(spark, "warc"), frame_bytes=1000)
    frames = index.select("bundle", "frame").distinct().count()
    tasks = read_archives(index).groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert frames > 16 and len(tasks) >= 6 and max(r["count"] for r in tasks) <= 200 // 2
