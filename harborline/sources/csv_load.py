"""Header-driven, tolerant CSV load with a durable history (survey A2-A5, L25).

``stage`` parses text lines into typed rows and writes every line once, good or bad,
with its place: file, byte at which its split starts, and position in the scan.
Everything else is read from that table:

* ``loaded``: the good rows with the table's columns;
* ``rejected``: the bad lines with file, line number and reason;
* ``audit``: per file rows parsed and loaded, the first error with its line number,
  status and load time.

Columns are found by each file's own header (names are trimmed, case does not count,
``aliases`` renames), in any order; columns that the table does not have are left
out, columns that the file does not have are null, except the load time, which is one
instant for the whole batch.  Fields may be quoted; ``NULL``, ``null`` and the empty
field are null.  A line with a field too many or too few, or with a value that its
column's type does not take, is rejected; the others of its file are loaded.  Empty
lines are skipped.  A field ends with its line.  A file with a header only has no rows
and counts as loaded, an empty file leaves no trace, and a header that names no
column of the table raises.

Line numbers hold however a file is split: a split's lines are numbered by their
position in it, and the lines of the file's earlier splits (one row per split) are
added up before it.

A file too large for one task to write may come in pieces: the parts that Spark writes,
in the order of their numbers, to a folder named by ``PIECES`` and the file
(``file_in_pieces=calls.csv/part-00000-...``).  They read as that one file: one header, in
front of the first piece, and line numbers that run through all of them.
"""

from __future__ import annotations

import csv
import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.scalars import lit_ntz
from ..operators.broadcast import checked_broadcast
from ..session import compiled_methods, shared_dir

NULL_TOKENS = ["NULL", "null", ""]
LOAD_TIME = "_loaded_at"
PLACE = "_place"                # struct: file, block, pos, kind, line, error
ROW, EMPTY, LIKE_HEADER = "row", "empty", "like_header"
BROKEN = "_broken"
PIECES = "file_in_pieces"
PIECE_BITS = 40                 # a block is its byte in the piece, and above these bits the piece's number
MAX_HEADERS = 200               # different headers in one batch
CSV = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN,
       "nullValue": "\u0000", "emptyValue": ""}


def text_lines(reader) -> DataFrame:
    """Lines with the file and the split they come from, as the reader names them; ``reader``
    has read text files, at rest or as a stream."""
    return reader.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def _of_file(splits: DataFrame) -> DataFrame:
    """``splits`` (_path, _start, ...: a row per split or file) with ``_file`` and ``_block``, in which
    the pieces of a file are one."""
    path, start = F.col("_path"), F.col("_start")
    folder = F.regexp_extract(path, f"^(.*/{PIECES}=[^/]+)/part-[^/]+$", 1)
    piece = F.regexp_extract(path, "/part-([0-9]+)[^/]*$", 1).cast("long")
    return splits.withColumns({"_file": F.when(folder != "", folder).otherwise(path),
                               "_block": F.when(folder != "", F.shiftleft(piece, PIECE_BITS) + start).otherwise(start)})


def _starts_a_piece() -> Column:
    """Whether a split is the first of its file, or of a piece of it."""
    return F.col("block") == 0


def header_names(header: str, aliases: dict[str, str]) -> list[str]:
    names = [n.strip().lower() for n in next(csv.reader([header.lstrip("﻿")]), [])]
    return [aliases.get(n, n) for n in names]


def _parsed(rows: DataFrame, header: str, schema: StructType, aliases: dict[str, str],
            load_time: dt.datetime) -> tuple[DataFrame, list[Column], Column]:
    """(lines under one header, their typed columns, the reason for a rejection).  A line is
    parsed once and a field cast once: each step is a projection of its own."""
    names = header_names(header, aliases)
    known = {f.name.lower() for f in schema.fields} - {LOAD_TIME}
    if not known & set(names) or len(set(names)) < len(names):
        raise ValueError(f"header names no column of the table, or one twice: {header!r}")
    line = ", ".join(f"c{i} string" for i in range(len(names))) + f", {BROKEN} string"
    found = {i: f"record.c{names.index(f.name.lower())}" for i, f in enumerate(schema.fields) if f.name.lower() in names}
    rows = rows.withColumn("record", F.from_csv(F.col("value"), F.lit(line), CSV))
    rows = rows.select("value", "file", "block", "pos", F.col(f"record.{BROKEN}").isNotNull().alias("broken"),
                       *[F.when(~F.col(c).isin(NULL_TOKENS), F.col(c)).alias(f"text{i}") for i, c in found.items()])
    rows = rows.select("*", *[F.col(f"text{i}").try_cast(schema.fields[i].dataType).alias(f"typed{i}") for i in found])
    columns, reason = [], F.when(F.col("broken"), F.lit("wrong number of fields"))
    for i, f in enumerate(schema.fields):
        if i not in found:
            value = lit_ntz(load_time) if f.name == LOAD_TIME else F.lit(None)
            columns.append(value.cast(f.dataType).alias(f.name))
            continue
        text, typed = F.col(f"text{i}"), F.col(f"typed{i}")
        columns.append(typed.alias(f.name))
        bad = F.concat(F.lit(f"{f.name}: '"), text, F.lit(f"' is no {f.dataType.simpleString()}"))
        reason = reason.when(text.isNotNull() & typed.isNull(), bad)
    return rows, columns, reason


def stage(lines: DataFrame, schema: StructType, out: str, load_time: dt.datetime,
          aliases: dict[str, str] | None = None) -> int:
    """Parse ``lines`` (``text_lines``) and write them to ``out``; returns the rows loaded."""
    aliases = {k.lower(): v.lower() for k, v in (aliases or {}).items()}
    placed = lines.withColumn("pos", F.monotonically_increasing_id())
    starts = (placed.filter(_starts_a_piece()).groupBy(F.col("file").alias("_path"), F.col("block").alias("_start"))
              .agg(F.min_by("value", "pos").alias("first")))
    heads = _of_file(starts).select(F.col("_path").alias("file"), F.min_by("first", "_block").over(
        Window.partitionBy("_file")).alias("header"))
    different = [r.header for r in heads.select("header").distinct().limit(MAX_HEADERS + 1).collect()]
    if len(different) > MAX_HEADERS:
        raise ValueError(f"more than {MAX_HEADERS} different headers in one batch")
    rows = placed.join(checked_broadcast(heads), "file") if len(different) > 1 else \
        placed.withColumn("header", F.lit(different[0] if different else None).cast("string"))
    parsed = None
    for header in different or [",".join(f.name for f in schema.fields)]:        # as a rule one
        of_header = rows.filter(F.col("header") == F.lit(header)) if len(different) > 1 else rows
        of_header, columns, reason = _parsed(of_header, header, schema, aliases, load_time)
        kind = (F.when(_starts_a_piece() & (F.col("value") == F.lit(header)), LIKE_HEADER)
                .when(F.trim("value") == "", EMPTY).otherwise(ROW))
        place = F.struct("file", "block", "pos", kind.alias("kind"),
                         F.when(reason.isNotNull(), F.col("value")).alias("line"), reason.alias("error"))
        part = of_header.select(*columns, place.alias(PLACE))
        parsed = part if parsed is None else parsed.unionByName(part)
    seen = Observation()
    good = F.col(f"{PLACE}.error").isNull()
    parsed = parsed.observe(seen, F.count(F.when(good & (F.col(f"{PLACE}.kind") == ROW), 1)).alias("rows"),
                            F.count(F.when(F.col(f"{PLACE}.kind") == LIKE_HEADER, 1)).alias("like_header"))
    with compiled_methods(lines.sparkSession):
        parsed.write.mode("overwrite").parquet(out)
    counted = seen.get
    if counted.get("like_header", 0) <= len(different):      # each file's header and no line that repeats it
        return counted.get("rows", 0)
    return loaded(lines.sparkSession.read.parquet(out)).count()


def _splits(staged: DataFrame) -> DataFrame:
    """One row per split: its first position, the lines of its file before it, its rows and the good
    ones.  Made by one scan and stored: a small table that several steps read."""
    kind, error = F.col(f"{PLACE}.kind"), F.col(f"{PLACE}.error")
    splits = _of_file(staged.groupBy(F.col(f"{PLACE}.file").alias("_path"), F.col(f"{PLACE}.block").alias("_start")).agg(
        F.min(f"{PLACE}.pos").alias("_first"), F.count(F.lit(1)).alias("_lines"), F.count(F.when(kind == ROW, 1)).alias("_rows"),
        F.count(F.when((kind == ROW) & error.isNull(), 1)).alias("_good")))
    earlier = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    path = shared_dir(staged.sparkSession, f"ingest/splits-{uuid.uuid4().hex}")
    splits.withColumn("_before", F.coalesce(F.sum("_lines").over(earlier), F.lit(0))).write.parquet(path)
    return staged.sparkSession.read.parquet(path)


def _numbered(rows: DataFrame, splits: DataFrame) -> DataFrame:
    """``rows`` with ``_file`` and ``line_number``, from 1."""
    index = checked_broadcast(splits.select("_path", "_start", "_first", "_before", "_file"))
    at = rows.withColumns({"_path": F.col(f"{PLACE}.file"), "_start": F.col(f"{PLACE}.block")}).join(index, ["_path", "_start"])
    return (at.withColumn("line_number", F.col("_before") + F.col(f"{PLACE}.pos") - F.col("_first") + 1)
            .drop("_path", "_start", "_first", "_before"))


def _like_header(staged: DataFrame, splits: DataFrame) -> DataFrame:
    """The lines that read like their file's header and are rows.  Only they need their number
    to be told from it."""
    return _numbered(staged.filter(F.col(f"{PLACE}.kind") == LIKE_HEADER), splits).filter("line_number > 1")


def loaded(staged: DataFrame) -> DataFrame:
    """The good rows, with the table's columns: without headers and empty lines."""
    good = F.col(f"{PLACE}.error").isNull()
    repeated = _like_header(staged.filter(good), _splits(staged))
    return (staged.filter((F.col(f"{PLACE}.kind") == ROW) & good)
            .unionByName(repeated.select(*staged.columns)).drop(PLACE))


def rejected(staged: DataFrame, splits: DataFrame | None = None) -> DataFrame:
    """file_name, line_number, error and text of every rejected line."""
    bad = _numbered(staged.filter(F.col(f"{PLACE}.error").isNotNull() & (F.col(f"{PLACE}.kind") != EMPTY)),
                    _splits(staged) if splits is None else splits)
    return bad.filter("line_number > 1").select(_name("_file").alias("file_name"), "line_number",
                                                F.col(f"{PLACE}.error").alias("error"), F.col(f"{PLACE}.line").alias("line"))


def _name(path: str) -> Column:
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), f"^{PIECES}=", "")


def audit(staged: DataFrame, table_name: str, load_time: dt.datetime) -> DataFrame:
    """One row per file of the load."""
    splits = _splits(staged)
    repeated = _like_header(staged, splits).groupBy(F.col("_file").alias("file")).agg(
        F.count(F.lit(1)).alias("row_parsed"), F.count(F.when(F.col(f"{PLACE}.error").isNull(), 1)).alias("row_count"))
    files = splits.groupBy(F.col("_file").alias("file")).agg(F.sum("_rows").alias("row_parsed"), F.sum("_good").alias("row_count"))
    files = files.unionByName(repeated).groupBy("file").agg(
        F.sum("row_parsed").alias("row_parsed"), F.sum("row_count").alias("row_count"))
    errors = rejected(staged, splits).groupBy("file_name").agg(F.min(F.struct("line_number", "error")).alias("first"))
    zero = F.lit(0).cast("long")
    all_files = (files.withColumn("file_name", _name("file")).join(errors, "file_name", "left")
                 .withColumns({c: F.coalesce(c, zero) for c in ("row_parsed", "row_count")}))
    status = (F.when(F.col("row_count") == F.col("row_parsed"), "LOADED")
              .when(F.col("row_count") == 0, "LOAD_FAILED").otherwise("PARTIALLY_LOADED"))
    return all_files.select(F.lit(table_name).alias("table_name"), "file_name", "row_count", "row_parsed",
                            F.col("first.error").alias("first_error_message"),
                            F.col("first.line_number").alias("first_error_line_number"), status.alias("status"),
                            lit_ntz(load_time).alias("last_load_time"))


def recent_loads(history: DataFrame, now: dt.datetime, days: int = 14) -> DataFrame:
    """The load history of the last days, newest first."""
    since = lit_ntz(dt.datetime.combine(now.date() - dt.timedelta(days=days), dt.time()))
    return history.filter(F.col("last_load_time") >= since).orderBy(F.col("last_load_time").desc(), "file_name")


def load_files(spark: SparkSession, path: str, schema: StructType, out: str, load_time: dt.datetime,
               aliases: dict[str, str] | None = None) -> DataFrame:
    """Stage the CSV files under ``path``; returns the staged table."""
    stage(text_lines(spark.read.text(path)), schema, out, load_time, aliases)
    return spark.read.parquet(out)
