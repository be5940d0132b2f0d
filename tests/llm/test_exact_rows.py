"""The exact-duplicate query has a row for every row, as its DuckDB SQL has."""

from __future__ import annotations

from collections import Counter

from harborline.llm.oracle import ORACLE
from harborline.llm.queries import QUERIES


def test_repeated_rows_each_have_a_row(spark, tmp_path):
    import duckdb
    rows = [(1, "a"), (1, "a"), (2, "a"), (3, "b"), (3, "b"), (3, "c"), (4, None), (4, ""), (None, "d"), (None, "d"), (None, "a"), (5, "e")]
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(path)
    got = QUERIES["op7_extendible_index"](spark, str(tmp_path)).collect()
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{path}/*.parquet')")
    want = con.sql(ORACLE["op7_extendible_index"]).fetchall()
    # `kept` of a null id is NULL in SQL, so it is compared where ids are known
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.doc_id is not None and r.kept, r.text_sha256) for r in got) == Counter(
        (i, k, n, i is not None and kept, h) for i, k, n, kept, h in want)
