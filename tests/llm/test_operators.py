"""Every operator against a plain brute-force version on small tables that hold
nulls, empty and long texts, ties, repeated rows and clashing column names."""

from __future__ import annotations

import base64
import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from harborline.llm import (bottom_k, byte_cnn, divergence_rules, external_shuffle, extendible_index, links,
                            simhash_lines, soft_mixing, unit_hashing, warc_chain, window_packing)

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"word{i % 977}" for i in range(30_000))
BASE = "the quick brown fox jumps over the lazy dog while many other animals watch it from the far bank of the river"
ROWS = [(1, BASE), (2, BASE), (3, BASE.replace("lazy", "sleepy")), (4, None), (5, ""), (6, "  \n\t\n"), (7, LONG),
        (8, LONG + " end"), (9, "one two"), (10, "ONE  two"), (11, BASE.upper()), (2, BASE), (None, BASE), (12, "ünï çødé ☃ text")]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if t else None, "src", 7, 8, 9) for i, t in ROWS]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, shard string, bucket int, h int, component_id int")


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def components_of(pairs, nodes):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        up[b] = a
    return {n: find(n) for n in nodes}


def test_components(spark):
    g = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in g.integers(0, 120, (90, 2))] + [(i, i + 1) for i in range(200, 260)]
    got = {r.node: r.component for r in links.components(spark, spark.createDataFrame(edges, "a long, b long")).collect()}
    want = components_of(edges, {x for e in edges for x in e})
    assert {n: c for n, c in want.items() if n in got} == got
    assert all(c == n for n, c in want.items() if n not in got)


def test_simhash_lines(spark, docs, empty):
    got = simhash_lines.fuzzy_line_groups(spark, docs).collect()
    lines = [(i, k, " ".join(re.sub(r"[^\w ]+|_", " ", l.lower()).split())) for i, t in ROWS if t is not None
             for k, l in enumerate(t.split("\n"))]
    assert len(got) == len(lines) + 1  # a null text is one empty line
    groups = defaultdict(set)
    for r in got:
        if r.group_id is not None:
            groups[r.group_id].add((r.doc_id, r.line_no))
    of = {m: g for g, ms in groups.items() for m in ms}
    for i, k, a in lines:
        for j, m, b in lines:
            if a and a == b:
                assert of[i, k] == of[j, m]
    assert of[1, 0] == of[11, 0] and of[1, 0] != of[9, 0] and of[9, 0] == of[10, 0]
    for r in got:  # the first occurrence stays
        if r.group_id is not None:
            first = min(groups[r.group_id], key=lambda x: (x[0] is not None, x))
            assert (r.keep_doc_id, r.keep_line_no) == first and r.kept == ((r.doc_id, r.line_no) == first)
    assert simhash_lines.fuzzy_line_groups(spark, empty).count() == 0


def edit_distance(a, b):
    ar = np.arange(len(b) + 1)
    row, chars = ar, np.array(list(b))
    for i, c in enumerate(a, 1):
        new = np.append(i, np.minimum(row[1:] + 1, row[:-1] + (chars != c)))
        row = np.minimum.accumulate(new - ar) + ar
    return int(row[-1])


def test_simhash_recall_against_brute_force(spark):
    """Of edited lines with an edit similarity of 0.8 or more, at least 0.9 of each kind share their line's group."""
    g = np.random.default_rng(11)
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect() if r.text]
    lines = sorted({" ".join(re.sub(r"[\W_]+", " ", l.lower()).split()) for t in texts for l in t.split("\n")})
    vocab = sorted({w for l in lines for w in l.split()})
    lines = [lines[i] for i in g.permutation([i for i, l in enumerate(lines) if 25 <= len(l) <= 400])[:720]]

    def edited(line, kind):
        w = line.split()
        at = int(g.integers(0, len(w)))
        if kind == "typo":
            p = int(g.integers(0, len(w[at])))
            w[at] = w[at][:p] + "qxz"[int(g.integers(0, 3))] + w[at][p + 1:]
        else:
            w[at:at + (kind != "insert")] = [] if kind == "drop" else [vocab[int(g.integers(0, len(vocab)))]]
        return " ".join(w) or line
    cases = [(kind, times) for kind in ("replace", "typo", "drop", "insert") for times in (1, 2, 3)]
    rows, pairs = [(i, l) for i, l in enumerate(lines)], []
    for i, line in enumerate(lines):  # one edited copy of each, so no other copy links the two
        kind, times = cases[i % len(cases)]
        new = line
        for _ in range(times):
            new = edited(new, kind)
        if new != line and edit_distance(line, new) <= 0.2 * max(len(line), len(new)):
            rows.append((len(rows), new))
            pairs.append((kind, times, i, len(rows) - 1))
    d = spark.createDataFrame(rows, "doc_id long, text string")
    group = {r.doc_id: r.group_id for r in simhash_lines.fuzzy_line_groups(spark, d).collect()}
    found = defaultdict(list)
    for kind, times, i, j in pairs:
        found[kind, times].append(group[i] == group[j])
    recall = {k: float(np.mean(v)) for k, v in found.items()}
    print(len(pairs), recall)
    assert len(pairs) > 500 and min(recall.values()) >= 0.9, recall


def test_simhash_long_lines_by_edit_similarity(spark):
    g = np.random.default_rng(4)
    words = [f"word{i}x" for i in range(700)]
    few = ["alpha", "bravo", "charlie", "delta", "echoes", "foxtrot", "golfers"] * 120
    typos = list(few)
    typos[100], typos[400], typos[700] = "brovo", "dalta", "echaes"
    rows = [(1, " ".join(words)), (2, " ".join(words[i] for i in g.permutation(len(words)))),
            (3, " ".join(few)), (4, " ".join(typos)), (5, " ".join(words[:300] + ["more"] + words[300:690] + ["last"] + words[690:]))]
    assert all(len(t) > 4096 for _, t in rows)
    got = {r.doc_id: r.group_id for r in simhash_lines.fuzzy_line_groups(
        spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, a in rows:
        for j, b in rows:
            if i < j:
                assert (got[i] == got[j]) == (edit_distance(a, b) <= 0.2 * max(len(a), len(b))), (i, j)
    assert got[1] != got[2] and got[3] == got[4] and got[1] == got[5]


def test_simhash_bits_of_wide_lines(spark):
    words = [f"word{i}" for i in range(400)]
    df = spark.createDataFrame([(" ".join(words[:n]),) for n in (1, 90, 400)], "t string")
    from pyspark.sql import functions as F
    got = df.select(simhash_lines.simhash(F.split("t", " ")).alias("s"), F.transform(F.split("t", " "), lambda w: F.xxhash64(w)).alias("h")).collect()
    for r in got:
        for j in range(64):
            ones = sum((h >> j) & 1 for h in r.h)
            assert ((r.s >> j) & 1) == (ones * 2 > len(r.h))


def base_counts(t):
    w = WORD.findall(t)
    seen, dup = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    runs = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    many = Counter(runs)
    inside = {i + k for i, x in enumerate(runs) if many[x] > 1 for k in range(8)}
    return (len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), dup, len(inside),
            len(w) < 20 or 100 * len(inside) > 30 * len(w))


def test_divergence_base(spark, docs, empty):
    rows = ROWS + [(20, "# a|b\n# a|b\n\n<x> &" * 3), (21, " ".join(["one two three four five six seven eight nine"] * 5))]
    d = spark.createDataFrame([(i, t, "en") for i, t in rows], "doc_id long, text string, lang string")
    got = divergence_rules.divergence(spark, d).collect()
    want = Counter((i, *base_counts(t or "")) for i, t in rows)
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                   for r in got) == want
    assert not any(r.kept and r.base_failed for r in got)
    kept = {r.doc_id for r in got if r.kept}
    assert {r.doc_id for r in divergence_rules.only_kept(spark, d).collect()} == kept
    assert divergence_rules.divergence(spark, empty).count() == 0
    assert divergence_rules.only_kept(spark, docs).columns == docs.columns


def test_divergence_keeps_good_documents(spark):
    d, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = divergence_rules.divergence(spark, d).join(labels, "doc_id").toPandas()
    judged = got[~got.base_failed]
    assert judged[judged.quality == 1].kept.mean() > 0.97
    assert divergence_rules.distance(np.array([[1.0, 0.0]]), np.array([0.0, 1.0]))[0] == pytest.approx(1)


def test_soft_mixing_meets_targets(spark, docs, empty):
    d, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    targets = (0.9, 0.06, 0.04)
    got = soft_mixing.mix(spark, d, labels, targets).toPandas()
    p = got[[f"p_{k}" for k in soft_mixing.DOMAINS]].to_numpy()
    assert (got.rate >= 0).all() and np.allclose(p.sum(axis=1), 1)
    share = (got.rate * got.tokens).to_numpy() @ p / got.tokens.sum()
    assert np.abs(share - targets).max() < 2e-3
    assert ((got.copies - got.rate).abs() < 1).all()
    own = soft_mixing.mix(spark, docs, labels, targets)
    assert own.count() == len(ROWS) and soft_mixing.mix(spark, empty, labels, targets).count() == 0


def test_byte_cnn(spark, docs, empty):
    from pyspark.sql import functions as F
    d, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2
    got = byte_cnn.score(spark, d, labels, ~held).withColumn("held", held).join(labels, "doc_id").toPandas()
    h = got[got.held]
    good, bad = h[h.quality == 1].score, h[h.quality == 0].score
    assert len(bad) == 0 or np.mean([[g > b for b in bad] for g in good]) > 0.8
    own = byte_cnn.score(spark, docs, labels, ~held).collect()
    assert len(own) == len(ROWS) and all(0 <= r.score <= 1 for r in own)
    assert byte_cnn.score(spark, empty, labels.limit(0), ~held).count() == 0


def test_cnn_chunks_cover_every_window():
    for n in (0, 1, 5, 6, 511, 512, 513, 5000):
        x, doc = byte_cnn.chunked(np.arange(n, dtype=np.uint64).astype(np.uint8), np.array([0, n]))
        seen = {tuple(r[i:i + byte_cnn.WIDTH]) for r in x.tolist() for i in range(byte_cnn.CHUNK - byte_cnn.WIDTH + 1)}
        want = {tuple((i + k) % 256 for k in range(byte_cnn.WIDTH)) for i in range(n - byte_cnn.WIDTH + 1)}
        assert want <= seen and (doc == 0).all()


def test_packing_round_trip(spark, docs, empty):
    import public_tokenizers as P
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    tok.encode_special_tokens = True
    more = [(30, "a  b   c \n d\n\n e. F.\tG "), (31, "x" * 3000), (32, "It's <|endoftext|> 's. Ok?\nNo!   z")]
    d = spark.createDataFrame([(i, t) for i, t in ROWS + more], "doc_id long, text string")
    got = window_packing.pack(spark, d, P.path("byte_bpe_50k.tiktoken"), P.PATTERN).collect()
    by_seq, by_doc = defaultdict(list), defaultdict(list)
    for r in got:
        assert len(r.ids) == 4 * r.length
        by_seq[r.sequence_id].append(r)
        by_doc[r.doc_id].append(r)
    for rs in by_seq.values():
        rs.sort(key=lambda r: r.offset)
        assert [r.offset for r in rs] == [sum(x.length for x in rs[:k]) for k in range(len(rs))]
        assert sum(r.length for r in rs) <= 1024
    copies = Counter(i for i, _ in ROWS + more)
    for i, t in ROWS + more:
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [0], "<u4").tobytes()
        parts = sorted({(r.start, bytes(r.ids)) for r in by_doc[i]})
        if copies[i] == 1:
            assert b"".join(b for _, b in parts) == ids and {r.doc_tokens for r in by_doc[i]} == {len(ids) // 4}
    assert window_packing.pack(spark, empty, P.path("byte_bpe_50k.tiktoken"), P.PATTERN).count() == 0


def test_cuts_are_optimal():
    g = np.random.default_rng(1)
    for _ in range(30):
        ends = np.cumsum(g.integers(1, 6, 14))
        price = g.integers(0, 4, 14).astype(float)
        b, w = [0, *ends], 9
        best = [0.0] + [np.inf] * 14
        for j in range(1, 15):
            best[j] = min(best[i] + w - (b[j] - b[i]) + price[j - 1] for i in range(j) if b[j] - b[i] <= w)
        chosen = window_packing.cuts(ends, price, w)
        cost, last = 0.0, 0
        for c in chosen:
            assert ends[c] - last <= w
            cost, last = cost + w - (ends[c] - last) + price[c], ends[c]
        assert cost == pytest.approx(best[14]) and last == ends[-1]


def near_brute(rows, n, percent):
    lower = {i: i + 32 for i in range(65, 91)}
    sets = {}
    for i, t in rows:
        w = WORD.findall((t or "").translate(lower))
        sets[i] = frozenset(tuple(w[k:k + n]) for k in range(len(w) - n + 1)) or (frozenset([tuple(w)]) if w else frozenset())
    pairs = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    comp = components_of(pairs, sets)
    return {i: (len(sets[i]), comp[i], comp[i] == i) for i in sets}


@pytest.mark.parametrize("n, percent", [(3, 85), (5, 80)])
def test_bottom_k(spark, empty, n, percent):
    g = np.random.default_rng(2)
    words = BASE.split() * 6
    rows = [(i, t) for i, t in ROWS if i is not None][:11]
    for i in range(60):  # a group of near copies, longer than a short list
        w = list(words)
        for at in g.integers(0, len(w), int(g.integers(0, 3))):
            w[at] = f"new{g.integers(0, 5)}"
        rows.append((100 + i, " ".join(w)))
    got = bottom_k.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), shingle=n, percent=percent)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got.collect()} == near_brute(rows, n, percent)
    assert bottom_k.near_duplicates(spark, empty).count() == 0


def test_blocks_find_every_link_between_components(spark, monkeypatch):
    monkeypatch.setattr(links, "BLOCK", 7)
    monkeypatch.setattr(links, "COLUMNS", 16)
    g = np.random.default_rng(5)
    sets = {i: sorted({int(x) for x in range(60) if g.random() > i / 800} | {1000 + i * 9 + int(x) for x in range(g.integers(0, 9))})
            for i in range(60)}
    part = {i: i % 5 if i < 20 else i for i in sets}
    lists = {1: range(0, 40), 2: range(20, 60), 3: range(5, 50)}
    members = spark.createDataFrame([(k, i, part[i]) for k, v in lists.items() for i in v], "key long, id long, component long")
    full = spark.createDataFrame(list(sets.items()), "id long, hashes array<long>")
    got = {(r.a, r.b) for r in links.set_links(spark, members, full, 85).collect()}
    linked = {(a, b) for v in lists.values() for a in v for b in v if a < b and part[a] != part[b]
              and 100 * len({*sets[a]} & {*sets[b]}) >= 85 * len({*sets[a]} | {*sets[b]})}
    every = {(a, b) for a in sets for b in sets if a < b and part[a] != part[b]
             and 100 * len({*sets[a]} & {*sets[b]}) >= 85 * len({*sets[a]} | {*sets[b]})}
    assert linked and got <= every
    same = [(a, b) for a in sets for b in sets if a < b and part[a] == part[b]]
    have, want = components_of([*got, *same], sets), components_of([*linked, *same], sets)
    assert all(have[a] == have[b] for a in sets for b in sets if want[a] == want[b])


def test_bottom_k_nulls(spark, docs):
    got = bottom_k.near_duplicates(spark, docs).collect()
    assert len(got) == len(ROWS)
    assert {r.component_id for r in got if r.doc_id in (1, 2, 11, None)} == {1}


@pytest.mark.parametrize("bits, capacity", [(64, 50_000), (3, 2)])
def test_exact_duplicates(spark, docs, empty, bits, capacity):
    got = extendible_index.exact_duplicates(spark, docs, capacity=capacity, hash_bits=bits).collect()
    same = defaultdict(list)
    for i, t in ROWS:
        same[t or ""].append(i)
    want = set()
    for i, t in ROWS:
        ids = [x for x in same[t or ""] if x is not None]
        keep = max(ids, default=None)
        want.add((i, keep, len(same[t or ""]), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got) == Counter(want)
    assert extendible_index.exact_duplicates(spark, empty).count() == 0


def test_directory_splits_until_none_is_overfull(spark):
    hashes = spark.range(5000).selectExpr("xxhash64(id) AS h")
    directory, bits = extendible_index.build_directory(spark, hashes, capacity=300)
    rows = directory.collect()
    assert len({r.cell for r in rows}) == len(rows)
    size = Counter()
    of = {r.cell: r.bucket for r in rows}
    for r in hashes.collect():
        size[of[(r.h % (1 << 64)) >> (64 - bits)]] += 1
    assert max(size.values()) <= 300 and sum(size.values()) == 5000


def test_warc_round_trip(spark):
    fake = "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:99>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    pages = [(1, "u", "<p>x</p>"), (2, None, "<p>x</p>"), (3, "a\r\nb", None), (4, "u", ""), (5, "u", fake), (6, "u", fake * 3 + "ü"),
             (7, "u", "WARC/1.0\r\n"), (None, "u", "<p>x</p>"), (8, "u", LONG), (8, "u", LONG)]
    d = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, digest string").coalesce(1)
    path = warc_chain.write_archives(spark, d)
    got = warc_chain.read_archives(spark, path, with_payload=True).collect()
    want = []
    for i, _, t in pages:
        b = (t or "").encode()
        first = min(p[0] for p in pages if (p[2] or "") == (t or "") and p[0] is not None)
        want.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), *(("response", None) if i == first else ("revisit", first))))
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == Counter(want)
    assert all(bytes(r.payload) == (dict((p[0], p[2]) for p in pages)[r.page_id] or "").encode() for r in got if r.record_type == "response")
    assert warc_chain.read_archives(spark, warc_chain.write_archives(spark, d.limit(0))).count() == 0


def test_external_shuffle(spark, docs, empty, tmp_path):
    docs.write.parquet(str(tmp_path / "d"))
    stored = spark.read.parquet(str(tmp_path / "d"))
    got = external_shuffle.two_pass_shuffle(spark, stored, 8, bucket_bytes=1000).select("record.doc_id", "record.text", "slot", "shard").collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter(ROWS)
    sizes = Counter(r.shard for r in got)
    assert max(sizes.values()) - min(sizes.values()) <= 1 and len(sizes) == 8
    assert all(sorted(r.slot for r in got if r.shard == s) == list(range(n)) for s, n in sizes.items())
    again = external_shuffle.two_pass_shuffle(spark, stored, 8, bucket_bytes=1000).select("record.doc_id", "record.text", "slot", "shard")
    assert sorted(map(repr, again.collect())) == sorted(map(repr, got))  # the seed fixes the order
    assert external_shuffle.two_pass_shuffle(spark, empty, 8).count() == 0


def test_unit_hashing(spark, docs, empty):
    s1, s2 = "First sentence has just about ten words in it, honestly.", "Another one follows with quite a few more words than that."
    rows = [(1, f"{s1} {s2}\nshort line"), (2, f"Intro that nobody else has written before in here at all. {s2.upper()}\nshort line"),
            (3, None), (4, ""), (5, f"é {s1}\n{s1}"), (6, "nothing is shared in this one, whatever you may look for")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = unit_hashing.repeated_units(spark, d).collect()
    text = dict(rows)
    found = {(r.doc_id, text[r.doc_id][r.start:r.end].lower(), r.removed) for r in got}
    assert found >= {(1, s2.lower(), False), (2, s2.lower(), True), (1, s1.lower(), False), (5, s1.lower(), True)}
    assert not any(r.doc_id == 6 for r in got)
    clean = {r.doc_id: r.text for r in unit_hashing.cleaned(d, unit_hashing.repeated_units(spark, d)).collect()}
    assert clean[1] == text[1] and clean[6] == text[6] and s2.upper() not in clean[2] and clean[3] == ""
    assert unit_hashing.repeated_units(spark, docs).filter("doc_id = 2 AND removed").count() >= 1
    assert unit_hashing.repeated_units(spark, empty).count() == 0


def test_unit_hashing_finds_whole_lines_and_paragraphs(spark):
    line = "It rains. Who knows why? Nobody does, they say. So we wait. All of us here."  # no sentence of 10 words
    parts = "Menu of the day\nSoup and bread\nFish with rice\nTea or coffee"  # no line of 10 words
    s1 = "First sentence has just about ten words in it, honestly."
    rows = [(1, f"Own start\n{line}\n\n{parts}\n\nOwn end"), (2, f"{s1} Short one.\n{line.upper()}\nAnother"),
            (3, f"Other\n\n{parts}\n\n{s1} Short one."), (4, None), (5, ""), (None, f"{line}\n{s1} Short one."),
            (6, "One. Two. Three.")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = unit_hashing.repeated_units(spark, d, unit=unit_hashing.UNITS)
    text = dict(rows)
    found = {(r.doc_id, text[r.doc_id][r.start:r.end], r.removed) for r in got.collect()}
    assert found == {(1, line, False), (2, line.upper(), True), (None, line, True), (1, parts, False), (3, parts, True),
                     (2, s1, False), (3, s1, True), (None, s1, True), (2, f"{s1} Short one.", False),
                     (3, f"{s1} Short one.", True), (None, f"{s1} Short one.", True)}
    clean = {r.doc_id: r.text for r in unit_hashing.cleaned(d, got).collect()}
    assert clean == {**text, 2: f"{s1} Short one.\n\nAnother", 3: "Other\n\n\n\n", 4: "", None: "\n"}


def test_pipeline(spark):
    import corpus_pipeline
    d = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, d, SF)
        assert out.columns == d.columns, name
        d = spark.createDataFrame(out.collect(), d.schema)
    got = corpus_pipeline.run(spark, SF).collect()
    tokens = defaultdict(int)
    for r in got:
        tokens[r.sequence_id] += r.length
    assert got and max(tokens.values()) <= 1024
    assert {r.doc_id for r in got} == {r.doc_id for r in d.collect()}
