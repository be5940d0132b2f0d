"""Repeated units against a plain version in Python, whole query included."""

from __future__ import annotations

import random
import re
from collections import defaultdict

import pytest

from harborline.llm import queries, unit_hashing

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_units(text, min_words):
    """(start, end, first word, words) of every paragraph, line and sentence."""
    words = [(m.start(), m.end()) for m in WORD.finditer(text)]
    cuts = defaultdict(set)
    for k in range(1, len(words)):
        breaks = text[words[k - 1][1]:words[k][0]].count("\n")
        ends = text[words[k - 1][1] - 1] in ".!?"
        for kind, cut in (("paragraph", breaks >= 2), ("line", breaks >= 1), ("sentence", breaks >= 1 or ends)):
            if cut:
                cuts[kind].add(k)
    found = set()
    for kind in ("paragraph", "line", "sentence") if words else ():
        borders = [0, *sorted(cuts[kind]), len(words)]
        found |= {(a, b) for a, b in zip(borders, borders[1:]) if b - a >= min_words}
    lower = re.compile("[A-Z]")
    for a, b in sorted(found):
        yield (words[a][0], words[b - 1][1], a, b,
               tuple(lower.sub(lambda m: m[0].lower(), text[s:e]) for s, e in words[a:b]))


def plain(rows, min_words, min_stretch):
    of = {k: list(plain_units(t or "", min_words)) for k, (_, t) in enumerate(rows)}
    where = defaultdict(list)
    for k, found in of.items():
        for s, e, a, b, key in found:
            where[key].append((rows[k][0] is None, rows[k][0] or 0, s))
    out = []
    for k, found in of.items():
        repeated = sorted((a, b, s, e, key) for s, e, a, b, key in found if len(where[key]) > 1)
        stretches, until = [], -1
        for u in repeated:
            if u[0] > until:
                stretches.append([])
            stretches[-1].append(u)
            until = max(until, u[1])
        for stretch in stretches:
            if max(u[1] for u in stretch) - stretch[0][0] >= min_stretch:
                for a, b, s, e, key in stretch:
                    none, first, at = min(where[key])
                    kept = (None if none else first, at)
                    out.append((rows[k][0], s, e, b - a, len(where[key]), *kept, (rows[k][0], s) != kept))
    return out


def as_rows(df):
    return [(r.doc_id, r.start, r.end, r.n_words, r.occurrences, r.keep_doc_id, r.keep_start, r.removed) for r in df.collect()]


def key(r):
    return tuple((x is None, x or 0) for x in r)


@pytest.mark.parametrize("digests", [1 << 20, 0])
@pytest.mark.parametrize("min_words,min_stretch", [(2, 0), (2, 6), (4, 9)])
def test_equals_plain_version(spark, monkeypatch, digests, min_words, min_stretch):
    """``digests`` 0: no broadcast, salted joins."""
    monkeypatch.setattr(unit_hashing, "BROADCAST_DIGESTS", digests)
    monkeypatch.setattr(unit_hashing, "SALTS", 3)
    g = random.Random(min_words + min_stretch)
    pool = [" ".join(g.choices(["a", "B", "cé", "d!", "e.", "f"], k=g.randint(1, 7))) for _ in range(12)]
    texts = ["".join(x for _ in range(g.randint(0, 6)) for x in (g.choice(pool), g.choice([" ", "\n", "\n\n", " \n \n", ". "])))
             for _ in range(60)]
    rows = [(None if k == 7 else k, t) for k, t in enumerate(texts)] + [(100, None), (101, ""), (102, " \n")]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, row int")
    got = unit_hashing.repeated_units(spark, docs, unit=unit_hashing.UNITS, min_words=min_words, min_stretch=min_stretch)
    assert sorted(as_rows(got), key=key) == sorted(plain(rows, min_words, min_stretch), key=key)


def test_query_equals_plain_version(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = as_rows(queries.QUERIES["op10_unit_hashing"](spark, SF))
    want = plain(rows, 5, 20)
    assert want and sorted(got, key=key) == sorted(want, key=key)


def test_one_common_phrase_leaves_a_document_alone(spark):
    phrase = "this one line of a dozen words is in both of the documents."
    passage = " ".join(f"Sentence {i} of the passage that many documents share." for i in range(8))
    rows = [(1, f"My own start.\n{phrase}\nMy own end."), (2, f"Another start here.\n{phrase}\nAnother end."),
            (3, f"Third start.\n{passage}\nThird end."), (4, f"Fourth start, {passage}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = unit_hashing.repeated_units(spark, docs, unit=unit_hashing.UNITS, min_words=5, min_stretch=20)
    assert {r.doc_id for r in got.collect()} == {3, 4}
