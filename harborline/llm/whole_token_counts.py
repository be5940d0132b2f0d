"""Token counts of a byte-level BPE tokenizer file with a whole-token shortcut.

Offline, on the driver: every vocabulary string is merged from its bytes by the
file's own merges.  Those that end as one token are proven: a piece of text equal to
such a string is one token, whatever surrounds it.  ``prove`` returns them with the
merges; both are as large as the vocabulary, so they are broadcast.

In tasks, with no shuffle: a text is cut into the tokenizer's pieces (words with
their leading blank, numbers, signs, white space); a piece that is a proven string
counts one, without a merge.  Only the rest is merged, lowest rank first; what was
merged is remembered, up to ``REMEMBERED`` pieces a worker.

Pieces are found by the published pattern.  The regex module and the tokenizer
library may know different editions of Unicode, so each character is asked once of
the library's own pre-tokenizer, and a text holding one on which they differ is cut
by a pattern with that character put into the library's class.

Result: one row per row of ``docs``: doc_id, n_bytes (UTF-8), n_tokens, over_limit
(n_tokens > ``limit``).  A null text is empty: 0 bytes, 0 tokens.  Null and repeated
ids keep their rows.  Added tokens of the file inside a text count as one token each,
as the library does by default.  No text is truncated.  Texts of any length are
worked through piece by piece; one piece of n characters takes about 100 bytes a
character while it is merged.  Files with a normalizer, a template or other options
that would change counts raise ValueError.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REMEMBERED = 1 << 20   # merged pieces a worker remembers
LONG_PIECE = 64        # characters; longer pieces are not remembered
LONG_TEXT = 1 << 20    # characters; pieces of longer texts are read one by one
SCHEMA = "doc_id long, n_bytes long, n_tokens long"


def byte_letters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: printable
    bytes for themselves, the others for the code points from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b if b in plain else next(others)) for b in range(256)]


class Merges:
    """(left id, right id) -> (rank, merged id), and the id of each byte."""

    def __init__(self, vocabulary: dict[str, int], merges: list):
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        self.pairs = {(vocabulary[a], vocabulary[b]): (rank, vocabulary[a + b]) for rank, (a, b) in enumerate(pairs)}
        self.of_byte = [vocabulary[c] for c in byte_letters()]

    def count(self, piece: bytes) -> int:
        """How many tokens ``piece`` has: the pair of lowest rank is merged first, the
        leftmost of equal ones."""
        ids = [self.of_byte[b] for b in piece]
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pairs, left = self.pairs, n
        heap = [found[0] << 40 | i for i in range(n - 1) if (found := pairs.get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        while heap:
            rank, i = divmod(heapq.heappop(heap), 1 << 40)
            j = after[i]
            if ids[i] < 0 or j >= n:
                continue
            found = pairs.get((ids[i], ids[j]))
            if not found or found[0] != rank:
                continue  # an older neighbour's entry
            ids[i], ids[j] = found[1], -1
            k = after[i] = after[j]
            left -= 1
            if k < n:
                before[k] = i
                if right := pairs.get((ids[i], ids[k])):
                    heapq.heappush(heap, right[0] << 40 | i)
            h = before[i]
            if h >= 0 and (to_left := pairs.get((ids[h], ids[i]))):
                heapq.heappush(heap, to_left[0] << 40 | h)
        return left


def prove(path: str) -> tuple[dict[str, int], Merges, list[str]]:
    """(strings proven to be one token -> 1, merges, added tokens) of a tokenizer file."""
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    model, cut = file["model"], file["pre_tokenizer"] or {}
    options = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
    if (model.get("type") != "BPE" or any(model.get(o) for o in options) or file.get("normalizer")
            or file.get("truncation") or file.get("padding")
            or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex", True)):
        raise ValueError(f"{path} is no plain byte-level BPE file")
    added = file.get("added_tokens") or []
    if any(t.get(o) for t in added for o in ("lstrip", "rstrip", "single_word", "normalized")):
        raise ValueError(f"{path}: added tokens that take their surroundings are not supported")
    merges = Merges(model["vocab"], model["merges"])
    to_byte = {c: b for b, c in enumerate(byte_letters())}
    proven = {}
    for letters in model["vocab"]:
        piece = bytes(to_byte[c] for c in letters)
        try:
            text = piece.decode()
        except UnicodeDecodeError:  # part of a character: no piece of a text
            continue
        if merges.count(piece) == 1:
            proven[text] = 1
    return proven, merges, [t["content"] for t in added]


class Counts(dict):
    """piece -> number of tokens: the proven ones to begin with, others as they are merged."""

    def __init__(self, proven: dict[str, int], merges: Merges):
        super().__init__(proven)
        self.proven, self.merges = proven, merges

    def __missing__(self, piece: str) -> int:
        n = self.merges.count(piece.encode())
        if len(piece) <= LONG_PIECE:
            if len(self) >= REMEMBERED + len(self.proven):
                self.clear()
                self.update(self.proven)
            self[piece] = n
        return n


class Pieces:
    """Cuts texts as the library's byte-level pre-tokenizer does."""

    CLASSES = {"letter": r"\p{L}", "number": r"\p{N}", "blank": r"\s"}

    def __init__(self):
        from tokenizers.pre_tokenizers import ByteLevel
        self.library = ByteLevel(add_prefix_space=False, use_regex=True)
        self.ours = {name: regex.compile(c) for name, c in self.CLASSES.items()}
        self.known = set(map(chr, range(128)))
        self.odd: dict[str, str] = {}    # characters on which the two differ -> the library's class
        self.pattern = self.compiled({})
        self.careful = self.pattern

    def compiled(self, odd: dict[str, str]):
        def chars(name):
            return "".join(rf"\U{ord(c):08x}" for c, to in odd.items() if to == name)
        every = "".join(rf"\U{ord(c):08x}" for c in odd)
        sets = {name: f"[[{c}]--[{every}]{'||[' + chars(name) + ']' if chars(name) else ''}]" if odd else f"[{c}]"
                for name, c in self.CLASSES.items()}
        letter, number, blank = sets["letter"], sets["number"], sets["blank"]
        return regex.compile(rf"(?V1)'(?:[stmd]|re|ve|ll)| ?{letter}+| ?{number}+| ?(?:(?!{blank}|{letter}|{number})[\s\S])+"
                             rf"|{blank}+(?=\Z|{blank})|{blank}+" if odd else
                             r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")

    def _class(self, c: str) -> str:
        def joins(before):
            return len(self.library.pre_tokenize_str(before + c)) == 1
        return "letter" if joins("a") else "number" if joins("1") else "sign" if joins("!") else "blank"

    def __call__(self, text: str) -> Iterator[str] | list[str]:
        if not text.isascii():
            chars = set(text)
            if new := chars - self.known:
                self.known |= new
                found = {c: self._class(c) for c in new}
                odd = {c: to for c, to in found.items()
                       if to != next((name for name, p in self.ours.items() if p.match(c)), "sign")}
                if odd:
                    self.odd.update(odd)
                    self.careful = self.compiled(self.odd)
            if self.odd and not self.odd.keys().isdisjoint(chars):
                return (m[0] for m in self.careful.finditer(text))
        if len(text) > LONG_TEXT:
            return (m[0] for m in self.pattern.finditer(text))
        return self.pattern.findall(text)


def count_tokens(spark: SparkSession, docs: DataFrame, path: str, limit: int = 512,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokens of every text of ``docs`` under the tokenizer file at ``path``; see the module text."""
    tables = spark.sparkContext.broadcast(prove(path))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        proven, merges, added = tables.value
        sizes, pieces = Counts(proven, merges), Pieces()
        marks = regex.compile("|".join(map(regex.escape, sorted(added, key=len, reverse=True)))) if added else None

        def tokens(text: str) -> int:
            parts = marks.split(text) if marks else [text]
            return len(parts) - 1 + sum(sum(map(sizes.__getitem__, pieces(part))) for part in parts)
        for batch in batches:
            texts = batch.column(1)
            n_tokens = pa.array([tokens(t.as_py() or "") for t in texts], pa.int64())
            n_bytes = pc.fill_null(pc.binary_length(texts).cast(pa.int64()), 0)
            yield pa.record_batch([batch.column(0).cast(pa.int64()), n_bytes, n_tokens], ["doc_id", "n_bytes", "n_tokens"])
    chosen = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return chosen.mapInArrow(counted, SCHEMA).withColumn("over_limit", F.col("n_tokens") > limit)
