"""Bounds of archive files."""

from __future__ import annotations

import glob
import os
import random

from tallystar.llm import warc
from tallystar.llm.common import prepare


def test_files_are_bounded_in_bytes(spark, monkeypatch):
    prepare(spark)
    monkeypatch.setattr(warc, "FILE_BYTES", 1 << 20)
    made = random.Random(4)
    noise = lambda n: made.randbytes(n).hex()
    pages = [(i, f"http://a.b/{i}", noise(30_000)) for i in range(100)]
    pages[50] = (50, "http://a.b/50", noise(5_000_000))
    rows = spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(2)
    archive = warc.build_index(warc.write_archives(rows))
    sizes = [os.path.getsize(f) for f in glob.glob(f"{archive.files.removeprefix('file:')}/*/*.txt")]
    assert sum(s > 1 << 20 for s in sizes) == 1 and len(sizes) < 12
    found = {int(r["page_id"]): r["payload"] for r in warc.read_urls(archive, rows.select("url")).collect()}
    assert found == {i: html.encode() for i, _, html in pages}


def test_no_pages_no_files(spark):
    prepare(spark)
    rows = spark.createDataFrame([], "page_id long, url string, html string")
    archive = warc.build_index(warc.write_archives(rows))
    assert warc.read_urls(archive, rows.select("url")).count() == 0
