"""Records with long headers are read, and a file whose chain breaks off raises."""

from __future__ import annotations

import pytest

from harborline.llm import warc_chain


def test_long_urls(spark):
    rows = [(i, "data:," + "x" * n, f"<p>{i}</p>") for i, n in enumerate((10, 65_536, 200_000, 20))]
    rows += [(10, "u/WARC/1.0", "<p>a</p>"), (11, "u", "\r\n\r\nWARC/1.0\r\nno end of a header"), (12, "u", "<p>b</p>")]
    d = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    got = warc_chain.read_archives(spark, warc_chain.write_archives(spark, d), with_payload=True).collect()
    assert sorted((r.page_id, bytes(r.payload).decode()) for r in got) == [(i, t) for i, _, t in rows]


@pytest.mark.parametrize("harm", [lambda b: b[:-3], lambda b: b + b"more", lambda b: b"x" + b,
                                  lambda b: b.replace(b"Content-Length: 8", b"Content-Length: 7", 1)])
def test_broken_files_raise(spark, tmp_path, harm):
    d = spark.createDataFrame([(i, "u", f"<p>{i}</p>") for i in range(5)], "page_id long, url string, html string").coalesce(1)
    path = tmp_path / "warc"
    warc_chain.write_archives(spark, d, f"file://{path}")
    whole = next(path.glob("part-*")).read_bytes()
    (tmp_path / "harmed").mkdir()
    (tmp_path / "harmed" / "one.warc").write_bytes(harm(whole))
    with pytest.raises(ValueError, match="one.warc"):
        warc_chain.read_archives(spark, f"file://{tmp_path}/harmed").collect()
