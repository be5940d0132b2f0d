"""Substring deduplication by hashing lines or paragraphs.

A text's units are its paragraphs (separated by an empty line), its lines, or its
lines cut after each sentence as well, so that a passage is found inside a
longer line too.  Any of the three kinds or several together are looked at; a
span that is a unit of two kinds (a line of one sentence) is one unit.  The
minimum length is that of the unit itself, so a line or paragraph of short
sentences is found whole.  A unit is normalised to its words in ASCII lower case; its
digest is two 64-bit hashes of the word sequence.  Units of at least
``min_words`` words are grouped globally by digest.  The occurrence that ranks
first, by (doc_id, start), stays and the others are removed.  Spans may lie in one
another: a sentence of a kept line is removed where it occurred earlier.

A document that shares no more than a phrase with others is left alone: of a text's
repeated units, those count that make up stretches, one unit touching the next, of at
least ``min_stretch`` words.

Not found: a passage that starts or ends inside a sentence, beyond the whole units
in it; several sentences that are each shorter than ``min_words`` and are not a
line or paragraph by themselves in both texts; stretches of fewer than ``min_stretch`` words.

Result: one row per occurrence of a unit that occurs more than once: doc_id,
start, end (character offsets in the original text), n_words, digest,
occurrences, keep_doc_id, keep_start, removed.  Documents without such a unit
have no row.  ``cleaned`` gives the texts without the removed spans.

A digest with any number of occurrences folds to one row per task before the
shuffle.  Repeated digests are broadcast while there are at most ``BROADCAST_DIGESTS``;
beyond that both sides are salted ``SALTS`` ways, so no digest's occurrences meet in
one task.  Stretches are found among one text's own repeated units.

Null and empty texts have no unit.  A null id ranks after all others.  Rows
that repeat id and text are one occurrence each, and the equal ones that rank
first all stay.  An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType
from pyspark.sql.window import Window

from . import byte_text as bt
from .tables import id_and_text, stored

UNITS = ("paragraph", "line", "sentence")
BROADCAST_DIGESTS = 1 << 20  # about 40 bytes each
SALTS = 16
SENTENCE_ENDS = np.zeros(256, bool)
SENTENCE_ENDS[list(b".!?")] = True


def units(data: np.ndarray, off: np.ndarray, kinds: tuple[str, ...], min_words: int) -> dict[str, np.ndarray]:
    """doc, start, end (characters), place of the first word, n_words and the two digest
    halves of each unit of these kinds."""
    starts, ends, doc = bt.words(data, off)
    word, = bt.span_hashes(bt.LOWER[data], (starts, ends))
    breaks = np.flatnonzero(data == 0x0A)
    between = bt.before(breaks, starts[1:]) - bt.before(breaks, ends[:-1])
    spans = []
    for kind in kinds:
        new = np.ones(len(word), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (between >= (2 if kind == "paragraph" else 1))
        if kind == "sentence":
            new[1:] |= SENTENCE_ENDS[data[ends[:-1] - 1]]
        first = np.flatnonzero(new)
        after = np.append(first[1:], len(word))[:len(first)]
        big = after - first >= min_words
        spans.append(first[big] * (len(word) + 1) + after[big])
    first, after = np.divmod(np.unique(np.concatenate(spans)), len(word) + 1)
    n = after - first
    digests = [bt.sequence_hashes(w, first, after) for w in (word, bt.mix(word ^ np.uint64(0xA5A5A5A5A5A5A5A5)))]
    inner = np.flatnonzero((data & 0xC0) == 0x80)  # bytes that start no character
    own = doc[first] if len(first) else np.zeros(0, np.int64)

    def char(at: np.ndarray) -> np.ndarray:
        return at - off[own] - (bt.before(inner, at) - bt.before(inner, off[own]))
    return {"doc": own, "start": char(starts[first]), "end": char(ends[after - 1]), "n_words": n,
            "place": first - np.searchsorted(doc, own), "digest1": digests[0].view(np.int64), "digest2": digests[1].view(np.int64)}


def repeated_units(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   unit: str | tuple[str, ...] = "sentence", min_words: int = 10, min_stretch: int = 0) -> DataFrame:
    """All occurrences of repeated units of one kind or several; see the module text."""
    kinds = (unit,) if isinstance(unit, str) else tuple(unit)
    if not kinds or not set(kinds) <= set(UNITS):
        raise ValueError(f"units must be of {UNITS}")
    d = id_and_text(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id())
    ids = dict(d.dtypes)["doc_id"]
    columns = ["start", "end", "place", "n_words", "digest1", "digest2"]

    def run(batches):
        for b in batches:
            data, offsets = bt.flat(b.column("text"))
            for i, j, part, off in bt.slices(data, offsets):
                u = units(part, off, kinds, min_words)
                of = pa.array(u["doc"] + i)
                yield pa.RecordBatch.from_arrays([b.column("doc_id").take(of), b.column("row").take(of),
                                                  *[pa.array(u[c], pa.int64()) for c in columns]], ["doc_id", "row", *columns])

    found = stored(spark, d.mapInArrow(run, f"doc_id {ids}, row long, " + ", ".join(f"`{c}` long" for c in columns)), "units")
    key = ["digest1", "digest2"]
    many = stored(spark, found.groupBy(*key).agg(F.count(F.lit(1)).alias("occurrences"), F.min("doc_id").alias("keep_doc_id"))
                  .filter("occurrences > 1"), "digests")
    few = many.count() <= BROADCAST_DIGESTS

    def with_digest(occurrences: DataFrame, digests: DataFrame) -> DataFrame:
        if few:
            return occurrences.join(F.broadcast(digests), key)
        salt = F.pmod(F.xxhash64("row", "start"), F.lit(SALTS))
        copies = digests.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        return occurrences.withColumn("salt", salt.cast("int")).join(copies, [*key, "salt"]).drop("salt")

    copies = stored(spark, with_digest(found, many), "repeated-units")
    first = copies.filter("doc_id <=> keep_doc_id").groupBy(*key).agg(F.min("start").alias("keep_start"))
    in_text = Window.partitionBy("row").orderBy("place", "n_words")
    so_far = in_text.rowsBetween(Window.unboundedPreceding, -1)
    stretch = Window.partitionBy("row", "stretch")
    long_enough = (copies.withColumn("apart", F.coalesce(F.col("place") > F.max(F.col("place") + F.col("n_words")).over(so_far), F.lit(True)))
                   .withColumn("stretch", F.sum(F.col("apart").cast("int")).over(in_text.rowsBetween(Window.unboundedPreceding, 0)))
                   .withColumn("words", F.max(F.col("place") + F.col("n_words")).over(stretch) - F.min("place").over(stretch))
                   .filter(F.col("words") >= min_stretch))
    digest = F.concat(*[F.lpad(F.hex(c), 16, "0") for c in key]).cast(StringType())
    return with_digest(long_enough, first).select(
        "doc_id", "start", "end", "n_words", digest.alias("digest"), "occurrences", "keep_doc_id", "keep_start",
        (~(F.col("doc_id").eqNullSafe(F.col("keep_doc_id")) & (F.col("start") == F.col("keep_start")))).alias("removed"))


def cleaned(docs: DataFrame, repeated: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) of all documents, without the removed spans, which may overlap.  A
    document's own spans are gathered, never more than its text has units."""
    before = Window.partitionBy("span_id").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    spans = (repeated.filter("removed").select(F.col("doc_id").alias("span_id"), "start", "end").distinct()
             .withColumn("from", F.coalesce(F.max("end").over(before), F.lit(0).cast("long")))
             .groupBy("span_id").agg(F.array_sort(F.collect_list(F.struct("start", "end", "from"))).alias("spans"),
                                     F.max("end").alias("last")))
    joined = id_and_text(docs, id_col, text_col).join(spans, F.col("doc_id").eqNullSafe(F.col("span_id")), "left")
    ends = F.concat(F.transform("spans", lambda s: s["from"]), F.array("last"))
    starts = F.concat(F.transform("spans", lambda s: s["start"]), F.array(F.char_length("text").cast("long")))
    kept = F.zip_with(ends, starts, lambda e, s: F.substring(F.col("text"), (e + 1).cast("int"), F.greatest(s - e, F.lit(0)).cast("int")))
    return joined.select("doc_id", F.when(F.col("spans").isNull(), F.col("text")).otherwise(F.array_join(kept, "")).alias("text"))
