"""WARC archives: writing, and reading by boundary-chain verification.

Writing: one record per page, written by Spark's text writer (any file system).  Pages
of like size share files, as many to a file as keep it below about ``FILE_BYTES``
(``SIZES``), so a reader's task has an archive of bounded size; a larger page has a
file of its own.  Archives from elsewhere are read whole by a task each, so they must
fit one and stay below Spark's limit of 2 GB for a binary value.  Of pages with equal payloads of
at least ``min_revisit_bytes`` the one with the smallest page_id is a ``response``
with the payload, the others are ``revisit`` records that refer to it.

Reading: a task scans a file's bytes for the magic and emits, for everything that
parses as a record, its offset and its successor's (the end of its block).  A
payload may hold the magic, even a whole record, so candidates are not trusted:
the records are exactly the candidates on the chain that starts at offset 0.
Pointer jumping finds them: every round marks the targets of marked candidates
and doubles all pointers, so a chain of n records takes about log2(n) rounds,
whatever the number of files.  A file's end is a candidate too: where a chain does
not reach it, the file is broken and reading raises.  A header may have any length.

A null html is an empty payload.  A null page_id is written without a number and
read as null; it never is the smallest.  Rows that repeat page_id and payload
are records each.  Line breaks in a url are dropped.  Empty tables and
folders give an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import new_folder, stored

# fixed values of the file format
MAGIC = b"WARC/1.0\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
BREAK = b"\r\n\r\n"

FILE_BYTES = 128 << 20
SIZES = (60 << 10, 1 << 20, 16 << 20)   # largest page, in bytes, of each class of files but the last
HEADER = 1 << 10                        # allowance for a record's header and url
BROADCAST_PAYLOADS = 1 << 19  # repeated payloads, about 50 bytes each; up to so many are broadcast
DATE = "2024-01-01T00:00:00Z"


def sha1_base32(text: Column) -> Column:
    """Upper-case base32 of the SHA-1 of the text's UTF-8 bytes: 8 x 20 bits, 4 letters each."""
    digits = F.sha1(text)
    letters = []
    for k in range(8):
        v = F.conv(F.substring(digits, 5 * k + 1, 5), 16, 10).cast("int")
        letters += [F.substring(F.lit(BASE32), F.shiftright(v, s).bitwiseAND(F.lit(31)) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*letters)


def write_archives(spark: SparkSession, pages: DataFrame, path: str | None = None, id_col: str = "page_id",
                   url_col: str = "url", html_col: str = "html", min_revisit_bytes: int = 0) -> str:
    """Write one record per row of ``pages`` under ``path`` and return it."""
    path = path or new_folder(spark, "warc")
    p = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url"),
                     F.coalesce(F.col(f"`{html_col}`"), F.lit("")).alias("payload")).withColumns(
        {"digest": sha1_base32(F.col("payload")), "n_bytes": F.octet_length("payload")})
    repeated = stored(spark, p.filter(F.col("n_bytes") >= min_revisit_bytes).groupBy("digest", "n_bytes")
                      .agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("first")).filter("n > 1").drop("n"), "payloads")
    if repeated.count() <= BROADCAST_PAYLOADS:
        repeated = F.broadcast(repeated)
    typed = p.join(repeated, ["digest", "n_bytes"], "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    nl = "\r\n"
    name = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    url = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]+", "")
    header = F.concat(
        F.lit(MAGIC.decode() + "WARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit(nl + "WARC-Record-ID: <urn:page:"), name, F.lit(">" + nl + "WARC-Target-URI: "), url,
        F.lit(nl + f"WARC-Date: {DATE}" + nl + "WARC-Payload-Digest: sha1:"), F.col("digest"),
        F.lit(nl + "X-Payload-Length: "), F.col("n_bytes").cast("string"),
        F.when(revisit, F.concat(F.lit(nl + "WARC-Refers-To: <urn:page:"), F.col("first").cast("string"), F.lit(">"))).otherwise(""),
        F.lit(nl + "Content-Length: "), F.when(revisit, "0").otherwise(F.col("n_bytes").cast("string")), F.lit(nl + nl))
    block = F.when(revisit, "").otherwise(F.col("payload"))
    # a record ends with two line breaks; the writer adds the second
    records = typed.select(F.concat(header, block, F.lit(nl)).alias("value"), F.octet_length(F.concat(url, block)).alias("size"))
    borders = [-1, *SIZES, None]
    within = [(F.col("size") > lo) & (F.lit(True) if hi is None else F.col("size") <= hi) for lo, hi in zip(borders, borders[1:])]
    counts = records.agg(*[F.count(F.when(c, 1)) for c in within]).first()
    for k, (condition, hi) in enumerate(zip(within, borders[1:])):
        if counts[k] or (k == 0 and not any(counts)):
            (records.filter(condition).select("value").write.mode("append").option("lineSep", nl)
             .option("maxRecordsPerFile", max(1, FILE_BYTES // (hi + HEADER)) if hi else 1).text(path))
    return path


_FIELD = re.compile(rb"([A-Za-z-]+): ([^\r\n]*)\Z")


def _candidates(content: bytes):
    """(offset, successor, fields, block start, block end) of whatever looks like a record."""
    at = content.find(MAGIC)
    while at >= 0:
        # a record starts the file or follows the break after a block, so no two headers overlap and all bytes are read once
        if at == 0 or content[at - 4:at] == BREAK:
            end = content.find(BREAK, at)
            if end < 0:
                return
            fields = dict(m.groups() for m in map(_FIELD.match, content[at + len(MAGIC):end].split(b"\r\n")) if m)
            length = fields.get(b"Content-Length", b"")
            if length.isdigit() and len(length) < 19:
                stop = end + 4 + int(length)
                if content[stop:stop + 4] == BREAK:
                    yield at, stop + 4, fields, end + 4, stop
        at = content.find(MAGIC, at + 1)


SCHEMA = ("file string, at long, next long, record_type string, page string, refers string, digest string, "
          "payload_bytes long, block_digest string, block_bytes long")


def _scan(with_payload: bool):
    def run(batches):
        for b in batches:
            for file, content in zip(b.column("path").to_pylist(), b.column("content")):
                content = content.as_py()
                rows: list[tuple] = []
                for at, nxt, f, lo, hi in _candidates(content):
                    def text(key, f=f):
                        return f.get(key, b"").decode("utf-8", "replace")
                    block = content[lo:hi]
                    rows.append((file, at, nxt, text(b"WARC-Type"), text(b"WARC-Record-ID"), text(b"WARC-Refers-To"),
                                 text(b"WARC-Payload-Digest"), int(text(b"X-Payload-Length") or hi - lo),
                                 base64.b32encode(hashlib.sha1(block).digest()).decode(), hi - lo,
                                 *([block] if with_payload else [])))
                    if len(rows) == 500:
                        yield _batch(rows, with_payload)
                        rows = []
                rows.append((file, len(content), *[None] * (8 + with_payload)))  # the file's end
                yield _batch(rows, with_payload)
    return run


def _batch(rows: list[tuple], with_payload: bool) -> pa.RecordBatch:
    s, n = pa.string(), pa.int64()
    types = [s, n, n, s, s, s, s, n, s, n] + [pa.binary()] * with_payload
    names = ["file", "at", "next", "record_type", "page", "refers", "digest", "payload_bytes", "block_digest",
             "block_bytes"] + ["payload"] * with_payload
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def on_chain(spark: SparkSession, candidates: DataFrame) -> DataFrame:
    """(file, at) of the candidates reachable from offset 0 of their file."""
    state = candidates.select("file", "at", F.col("next").alias("to"), (F.col("at") == 0).alias("reached"))
    while True:
        # `to` is the candidate 2**k records on, or null beyond the chain's end
        hits = state.filter("reached AND to IS NOT NULL").select("file", F.col("to").alias("at"), F.lit(True).alias("hit"))
        jump = state.select("file", F.col("at").alias("to"), F.col("to").alias("to2"))
        state = stored(spark, state.join(jump, ["file", "to"], "left").join(hits.distinct(), ["file", "at"], "left")
                       .select("file", "at", F.col("to2").alias("to"), (F.col("reached") | F.coalesce("hit", F.lit(False))).alias("reached")),
                       "chain")
        if state.filter("reached AND to IS NOT NULL").isEmpty():
            return state.filter("reached").select("file", "at")


def read_archives(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """The records of all archives under ``path``: page_id, payload_bytes,
    payload_digest, record_type, refers_to (and payload)."""
    files = spark.read.format("binaryFile").load(path).select("path", "content").filter("length(content) > 0") \
        if _any_file(spark, path) else spark.createDataFrame([], "path string, content binary")
    found = stored(spark, files.mapInArrow(_scan(with_payload), SCHEMA + ", payload binary" * with_payload), "candidates")
    chain = on_chain(spark, found)
    ends = found.filter("next IS NULL").select("file", "at")
    broken = ends.join(chain, ["file", "at"], "left_anti").select("file").take(5)
    if broken:
        raise ValueError(f"the records do not end with the file: {', '.join(r.file for r in broken)}")
    records = found.filter("next IS NOT NULL").join(chain, ["file", "at"])
    number = lambda c: F.nullif(F.regexp_extract(c, "^<urn:page:(-?[0-9]*)>$", 1), F.lit("")).cast("long")
    response = F.col("record_type") == "response"
    return records.select(
        number("page").alias("page_id"),
        F.when(response, F.col("block_bytes")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(response, F.col("block_digest")).otherwise(F.regexp_replace("digest", "^sha1:", "")).alias("payload_digest"),
        "record_type", F.when(~response, number("refers")).alias("refers_to"), *(["payload"] if with_payload else []))


def _any_file(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)
