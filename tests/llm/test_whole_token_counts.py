"""Token counts against the tokenizer library on whole texts."""

from __future__ import annotations

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from harborline.llm import queries, whole_token_counts

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.json")
# characters that Unicode's editions put into different classes, white space that is none to the pattern
ODD = "a՘b ՘՘ 1՘", "ab࢏!࢏    x", "\U0003fc3f x \U0003fc3fa ࢏'s", "a\x1c\x1d b\x85c   d"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def random_texts():
    g = random.Random(5)
    pieces = [" ", "  ", "\n", "\t \n", "'", "'s", "'ll", "don't", "a", "été", "ẞ", "12", "½", "!!", "…", "☃", "<|endoftext|>",
              "<|endof", "text|>", "zqxj", "Hello", "漢字", "՘", "́", "\x00", "\x1f", "🙂"]
    return ["".join(g.choices(pieces, k=g.randint(0, 40))) for _ in range(2000)]


def test_counts_equal_the_library(spark, library):
    texts = [None, "", " ", "\n \n", "x" * 5000, " " * 100_000 + "x", "a b" * 400_000, "don't we'll", *ODD, *random_texts()]
    rows = [(None if i == 3 else i // 2, t, 7) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = whole_token_counts.count_tokens(spark, docs, PATH).collect()
    sizes = {t: len(library.encode(t, add_special_tokens=False).ids) for t in {t or "" for t in texts}}
    want = sorted((-1 if i is None else i, len((t or "").encode()), sizes[t or ""], sizes[t or ""] > 512) for i, t, _ in rows)
    assert sorted((-1 if r.doc_id is None else r.doc_id, *r[1:]) for r in got) == want
    assert whole_token_counts.count_tokens(spark, docs.limit(0), PATH).collect() == []


def test_query_equals_the_library(spark, library):
    got = {r.doc_id: r for r in queries.QUERIES["op11_whole_token_counts"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        n = len(library.encode(d.text or "", add_special_tokens=False).ids)
        assert tuple(got[d.doc_id]) == (d.doc_id, len((d.text or "").encode()), n, n > 512)


def test_proof(library):
    """A string is proven if and only if the library's model makes one token of it."""
    proven, merges, added = whole_token_counts.prove(PATH)
    assert added == ["<|endoftext|>"] and len(proven) > 49_000
    to_letter = whole_token_counts.byte_letters()
    for text in random.Random(1).sample(sorted(proven), 3000):
        assert [t.value for t in library.model.tokenize("".join(to_letter[b] for b in text.encode()))] \
            == ["".join(to_letter[b] for b in text.encode())]
    other = [t for t in (bytes(to_letter.index(c) for c in v).decode(errors="replace") for v in library.get_vocab() if v not in added)
             if "�" not in t and t not in proven]
    for text in other:
        assert len(library.model.tokenize("".join(to_letter[b] for b in text.encode()))) > 1


def test_long_pieces(library):
    _, merges, _ = whole_token_counts.prove(PATH)
    g = random.Random(2)
    for text in (" " * 3_000_000, "a" * 200_000, "".join(g.choices("abcdefgh", k=100_000)), "ab" * 50_000 + "é" * 50_000):
        assert merges.count(text.encode()) == len(library.encode(text, add_special_tokens=False).ids)


def test_memory_of_pieces_is_bounded(monkeypatch):
    proven, merges, _ = whole_token_counts.prove(PATH)
    monkeypatch.setattr(whole_token_counts, "REMEMBERED", 10)
    sizes = whole_token_counts.Counts(proven, merges)
    words = [f"zq{i}xj" for i in range(100)]
    first = [sizes[w] for w in words]
    assert len(sizes) <= len(proven) + 10 and [sizes[w] for w in words] == first


def test_other_files_raise():
    with pytest.raises(ValueError):
        whole_token_counts.prove(public_tokenizers.path("word_bpe_49k.json"))
