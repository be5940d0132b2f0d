"""Archives are closed by their bytes, and read back whole."""

from __future__ import annotations

import os

from harborline.llm import warc_chain


def test_files_are_bounded_by_bytes(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(warc_chain, "FILE_BYTES", 40_000)
    monkeypatch.setattr(warc_chain, "SIZES", (300, 3000, 20_000))
    sizes = [0, 10, 299, 300, 301, 2500, 2900, 3000, 15_000, 19_000, 30_000, 70_000] * 12
    pages = spark.createDataFrame([(i, f"http://x/{i}", f"{i:06d}" + "p" * max(0, n - 6) if n else None) for i, n in enumerate(sizes)],
                                  "page_id long, url string, html string").coalesce(1)
    path = warc_chain.write_archives(spark, pages, str(tmp_path / "warc"))
    files = [os.path.getsize(f"{path}/{f}") for f in os.listdir(path) if f.startswith("part-")]
    largest = 70_000 + 2 * warc_chain.HEADER
    assert len(files) > 20 and all(n <= 40_000 or n <= largest and n >= 30_000 for n in files)
    got = {r.page_id: r.payload_bytes for r in warc_chain.read_archives(spark, path).collect()}
    assert got == {i: max(n, 6) if n else 0 for i, n in enumerate(sizes)}


def test_no_pages(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc_chain.read_archives(spark, warc_chain.write_archives(spark, pages, str(tmp_path / "warc"))).count() == 0
