"""Quality rules by distribution divergence.

References are measured on the whole corpus, per language: the shares of
character classes, and the shares of the language's ``common`` most frequent
words (ASCII lower case) plus one bin for all other words.  A document is
rejected when the Jensen-Shannon distance (square root of the divergence in bits,
0 to 1) of its own shares to its language's is above a bound: character
classes from ``min_chars`` characters on, words from ``min_words`` words on.
Shorter documents are too few to tell, so the guard passes them.

The references are a table keyed by language, joined to the documents, so every
language is measured by its own, however small its share.  Where a language has
fewer than ``REFERENCE_CHARS`` characters or ``REFERENCE_WORDS`` words in all,
there is nothing to measure by, and that distance's guard passes its documents.

Base rules (counts over the whole text): n_words, word_chars, n_symbols,
n_dup_lines, n_repeat_words; ``base_failed`` for fewer than 20 words or over
30 % repeated words.  ``kept`` is false then, else the divergence verdict.

Null and empty texts have no words and fail the base rules.  A null language is a
language of its own.  Repeated rows get equal verdicts.  An empty table gives an
empty result.  Columns other than id, text and language are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import byte_text as bt
from .tables import stored, unused

WINDOW, MIN_WORDS, MAX_REPEAT = 8, 20, 30
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
CLASSES = ("blank", "line", "lower", "upper", "digit", "mark", "symbol", "other")
MIN_CHARS, MAX_CLASS = 200, 0.26   # length from which classes count, and the largest distance kept
MIN_JUDGED, MAX_WORD = 100, 0.38   # the same for words
COMMON = 50
REFERENCE_CHARS, REFERENCE_WORDS = 20_000, 5_000   # text from which a language has references of its own
BROADCAST_LANGS = 1 << 13   # about 1 KB each; up to so many are broadcast
REFERENCE_DDL = "lang string, class_shares array<double>, words array<long>, word_shares array<double>"


def _class_table() -> np.ndarray:
    c = np.full(256, CLASSES.index("mark"), np.int64)
    c[bt.SPACE] = CLASSES.index("blank")
    c[ord("\n")] = CLASSES.index("line")
    c[ord("a"):ord("z") + 1] = CLASSES.index("lower")
    c[ord("A"):ord("Z") + 1] = CLASSES.index("upper")
    c[ord("0"):ord("9") + 1] = CLASSES.index("digit")
    c[SYMBOLS] = CLASSES.index("symbol")
    c[0x80:] = CLASSES.index("other")
    c[0x80:0xC0] = len(CLASSES)  # not the first byte of a character: not counted
    return c


CLASS_OF = _class_table()


def class_counts(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """(documents, classes) counts of characters."""
    n, c = len(off) - 1, len(CLASSES) + 1
    if len(data) > bt.SLICE_BYTES:  # one document, as a rule
        return np.stack([sum(np.bincount(CLASS_OF[data[k:min(k + bt.SLICE_BYTES, j)]], minlength=c)
                             for k in range(i, max(j, i + 1), bt.SLICE_BYTES))
                         for i, j in zip(off[:-1].tolist(), off[1:].tolist())])[:, :-1]
    doc = np.repeat(np.arange(n) * c, np.diff(off))
    return np.bincount(doc + CLASS_OF[data], minlength=n * c).reshape(n, c)[:, :-1]


def base_counts(data: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    """The base columns of every document of a slice, and its words' hashes (lower case)."""
    n = len(off) - 1
    starts, ends, doc = bt.words(data, off)
    ls, le, ldoc = bt.lines(data, off)
    word, line = bt.span_hashes(data, (starts, ends), (ls, le))
    lower, = bt.span_hashes(bt.LOWER[data], (starts, ends))
    with_word = np.searchsorted(starts, le) > np.searchsorted(starts, ls)
    line, ldoc = line[with_word], ldoc[with_word]
    _, copies = _repeated(line, ldoc)
    hashes, owners, at = bt.windows(word, doc, WINDOW)
    again, _ = _repeated(hashes, owners)
    edge = np.zeros(len(word) + 1, np.int64)
    np.add.at(edge, at[again], 1)
    np.add.at(edge, at[again] + WINDOW, -1)
    inside = np.cumsum(edge[:-1]) > 0
    return {"n_words": np.bincount(doc, minlength=n),
            "word_chars": bt.counted(~bt.SPACE[data] & ((data & 0xC0) != 0x80), off),
            "n_symbols": bt.counted(SYMBOLS[data], off),
            "n_dup_lines": np.bincount(ldoc[copies], minlength=n),
            "n_repeat_words": np.bincount(doc[inside], minlength=n),
            "_word": lower, "_doc": doc}


def _repeated(hashes: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of all members of groups of two or more equal (hash, owner), and of
    all but one member of each group."""
    key = bt.mix(hashes + owners.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    member = np.zeros(len(key), bool)
    member[1:] |= same
    member[:-1] |= same
    return order[member], order[1:][same]


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of each row of counts ``p`` to the shares ``q``."""
    p = p / np.maximum(p.sum(axis=1, keepdims=True), 1)
    m = (p + q) / 2

    def part(x):
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(x > 0, x * np.log2(x / m), 0.0).sum(axis=1)
    return np.sqrt(np.clip((part(p) + part(np.broadcast_to(q, p.shape))) / 2, 0, 1))


def fit_references(spark: SparkSession, docs: DataFrame, text_col: str, lang_col: str, common: int = COMMON) -> DataFrame:
    """One row per language, over all documents: lang, class shares (null for too few
    characters), word hashes in order and the words' shares (null for too few words)."""
    d = docs.select(F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
                    F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("")).alias("lang"))

    def classes(batches):
        for b in batches:
            data, offsets = bt.flat(b.column("text"))
            langs = np.array(b.column("lang").to_pylist(), object)
            sums: dict = {}
            for i, j, part, off in bt.slices(data, offsets):
                counts = class_counts(part, off)
                for lang in set(langs[i:j]):
                    sums[lang] = sums.get(lang, 0) + counts[langs[i:j] == lang].sum(axis=0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.string()), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.int64()))],
                ["lang", "counts"])

    per_class = d.mapInArrow(classes, "lang string, counts array<long>").groupBy("lang").agg(
        *[F.sum(F.col("counts")[i]).alias(c) for i, c in enumerate(CLASSES)])
    chars = F.expr(" + ".join(CLASSES))
    per_class = per_class.select("lang", F.when(chars >= REFERENCE_CHARS, F.array(*[F.col(c) / chars for c in CLASSES]))
                                 .alias("class_shares"))

    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = stored(spark, d.select("lang", F.explode(F.split(lower, r"[\x20\x09-\x0D]+")).alias("word")).filter("word != ''")
                   .groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n")), "words")
    sums = stored(spark, words.groupBy("lang").agg(F.sum("n").alias("total")).filter(F.col("total") >= REFERENCE_WORDS), "sums")
    # a word of 1/2000 of its language's words is common, so there are at most 2000 of them
    often = words.join(_small(sums), "lang").filter("n * 2000 >= total")
    rank = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    top = (often.withColumn("r", F.row_number().over(rank)).filter(F.col("r") <= common)
           .groupBy("lang").agg(F.collect_list(F.struct("word", (F.col("n") / F.col("total")).alias("share"))).alias("top")))

    def hashed(batches):
        for b in batches:
            rows = []
            for lang, shares, found in zip(*[b.column(c).to_pylist() for c in ("lang", "class_shares", "top")]):
                if found is None:
                    rows.append((lang, shares, None, None))
                    continue
                texts = [w["word"].encode() for w in found]
                ends = np.cumsum([len(t) for t in texts]).astype(np.int64)
                hashes, = bt.span_hashes(np.frombuffer(b"".join(texts), np.uint8), (ends - [len(t) for t in texts], ends)) \
                    if texts else (np.zeros(0, np.uint64),)
                order = np.argsort(hashes)
                of_words = np.array([w["share"] for w in found], float)[order]
                rows.append((lang, shares, hashes[order].view(np.int64).tolist(),
                             [*of_words.tolist(), max(0.0, 1 - float(of_words.sum()))]))
            kinds = [pa.string(), pa.list_(pa.float64()), pa.list_(pa.int64()), pa.list_(pa.float64())]
            columns = zip(*rows) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                             ["lang", "class_shares", "words", "word_shares"])

    # a language of many words and none that is common has the one bin of all other words
    top = sums.select("lang").join(top, "lang", "left").select("lang", F.coalesce("top", F.array().cast(
        "array<struct<word:string,share:double>>")).alias("top"))
    return stored(spark, per_class.join(top, "lang", "left").mapInArrow(hashed, REFERENCE_DDL), "references")


def _small(languages: DataFrame) -> DataFrame:
    """To be broadcast, unless there are very many languages."""
    return F.broadcast(languages) if languages.count() <= BROADCAST_LANGS else languages


def _with_reference(docs: DataFrame, lang: Column, references: DataFrame) -> DataFrame:
    """``docs`` and two last columns: the language, and its references."""
    own, of_reference, reference = (unused(docs, c) for c in ("_lang", "_ref_lang", "_reference"))
    refs = _small(references).select(F.col("lang").alias(of_reference), F.struct("class_shares", "words", "word_shares").alias(reference))
    return docs.withColumn(own, lang).join(refs, F.col(own) == F.col(of_reference), "left").drop(of_reference)


def _references_of(b: pa.RecordBatch) -> tuple[np.ndarray, dict]:
    """The languages of a batch's rows, and each language's references."""
    encoded = b.column(b.num_columns - 2).dictionary_encode()
    at, names = encoded.indices.to_numpy(), encoded.dictionary.to_pylist()
    references = {}
    for i in np.unique(at, return_index=True)[1] if len(at) else ():
        r = b.column(b.num_columns - 1)[int(i)].as_py()
        if r is not None:
            references[names[at[i]]] = (
                None if r["class_shares"] is None else np.array(r["class_shares"], float),
                None if r["words"] is None else np.array(r["words"], np.int64).view(np.uint64),
                None if r["words"] is None else np.array(r["word_shares"], float))
    return np.array(names, object)[at] if len(at) else np.zeros(0, object), references


def judge(data: np.ndarray, off: np.ndarray, langs: np.ndarray, references: dict, min_chars: int, min_words: int,
          max_class_distance: float, max_word_distance: float) -> dict[str, np.ndarray]:
    """All result columns of the documents of one slice."""
    out = base_counts(data, off)
    word, doc = out.pop("_word"), out.pop("_doc")
    n = len(off) - 1
    classes = class_counts(data, off)
    out["class_distance"], out["word_distance"] = np.zeros(n), np.zeros(n)
    for lang in set(langs):
        share, common, of_words = references.get(lang, (None, None, None))
        mine = langs == lang
        if share is not None:
            out["class_distance"][mine] = distance(classes[mine].astype(float), share)
        if of_words is None:
            continue
        own = np.flatnonzero(mine[doc])
        at = np.minimum(np.searchsorted(common, word[own]), max(len(common) - 1, 0))
        bins = np.where(common[at] == word[own], at, len(common)) if len(common) else np.zeros(len(own), np.int64)
        place = np.cumsum(mine) - 1
        width = len(common) + 1
        counts = np.bincount(place[doc[own]] * width + bins, minlength=int(mine.sum()) * width).reshape(-1, width)
        out["word_distance"][mine] = distance(counts.astype(float), of_words)
    out["base_failed"] = (out["n_words"] < MIN_WORDS) | (100 * out["n_repeat_words"] > MAX_REPEAT * out["n_words"])
    far = ((classes.sum(axis=1) >= min_chars) & (out["class_distance"] > max_class_distance)) | \
          ((out["n_words"] >= min_words) & (out["word_distance"] > max_word_distance))
    out["kept"] = ~out["base_failed"] & ~far
    return out


RESULT = {"n_words": pa.int64(), "word_chars": pa.int64(), "n_symbols": pa.int64(), "n_dup_lines": pa.int64(),
          "n_repeat_words": pa.int64(), "base_failed": pa.bool_(), "kept": pa.bool_(),
          "class_distance": pa.float64(), "word_distance": pa.float64()}
RESULT_DDL = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
              "base_failed boolean, kept boolean, class_distance double, word_distance double")


def divergence(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               lang_col: str = "lang", min_chars: int = MIN_CHARS, min_words: int = MIN_JUDGED,
               max_class_distance: float = MAX_CLASS, max_word_distance: float = MAX_WORD) -> DataFrame:
    """One row per document: the id, the base columns, the distances and ``kept``."""
    table = fit_references(spark, docs, text_col, lang_col)

    def run(batches):
        for b in batches:
            data, offsets = bt.flat(b.column("text"))
            langs, references = _references_of(b)
            parts = [judge(part, off, langs[i:j], references, min_chars, min_words, max_class_distance, max_word_distance)
                     for i, j, part, off in bt.slices(data, offsets)]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *[pa.array(np.concatenate([p[c] for p in parts]) if parts else [], t)
                                       for c, t in RESULT.items()]], ["doc_id", *RESULT])

    d = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
                    F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("")).alias("lang"))
    return _with_reference(d, F.col("lang"), table).mapInArrow(run, f"doc_id {dict(d.dtypes)['doc_id']}, {RESULT_DDL}")


def only_kept(spark: SparkSession, docs: DataFrame, text_col: str = "text", lang_col: str = "lang", **bounds) -> DataFrame:
    """The rows of ``docs``, all columns, that the rules keep."""
    table = fit_references(spark, docs, text_col, lang_col)
    limits = {"min_chars": MIN_CHARS, "min_words": MIN_JUDGED, "max_class_distance": MAX_CLASS, "max_word_distance": MAX_WORD,
              **bounds}
    text, width = docs.columns.index(text_col), len(docs.columns)

    def run(batches):
        for b in batches:
            data, offsets = bt.flat(b.column(text))
            langs, references = _references_of(b)
            kept = [judge(part, off, langs[i:j], references, **limits)["kept"] for i, j, part, off in bt.slices(data, offsets)]
            yield b.select(list(range(width))).filter(pa.array(np.concatenate(kept) if kept else np.zeros(0, bool), pa.bool_()))

    lang = F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit(""))
    return _with_reference(docs, lang, table).mapInArrow(run, docs.schema)
