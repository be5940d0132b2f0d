"""Load-path runs as queries (survey A1-A5, A8-A10, L25).

The CSV inputs are written by Spark from the bound tables into a fresh
folder under the shared checkpoint location, with the dialect the loader
must handle: header line, optional quotes, the three NULL tokens, and (for
the audit) rows with a non-numeric integer or an extra field.  Each file is
written by one task (``repartitionById``), header first; the number of files grows
with the rows.  A feed whose rows are dealt to given files delivers each of them in
pieces (``csv_load.PIECES``), whose number grows instead.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators import files
from ..operators.files import file_count
from ..session import compiled_methods, shared_dir
from ..sources import bronze_csv, csv_load, fx_feed, schemas

TOKENS = ["NULL", "null", ""]
SAMPLED = 200       # rows of a file's, or a piece's, for the borders of pieces


def _scratch(spark, name: str) -> str:
    return shared_dir(spark, f"ingest/{name}-{uuid.uuid4().hex[:12]}")


def _text(c: str, dtype) -> F.Column:
    s = dtype.simpleString()
    if s.startswith("timestamp"):
        return F.date_format(F.col(c), "yyyy-MM-dd HH:mm:ss")
    return F.col(c).cast("string")


def _file(number: F.Column, n_files: int) -> F.Column:
    return F.coalesce(F.pmod(number, F.lit(n_files)), F.lit(0)).cast("long").alias("file_id")


def write_csv_lines(df: DataFrame, schema: StructType, path: str, n_files: int = 3,
                    bad_int: tuple[str, F.Column] | None = None, extra: F.Column | None = None,
                    file_id: F.Column | None = None, order: list | None = None,
                    header: list[str] | None = None) -> None:
    """Write ``df`` as CSV text files with NULL tokens, optional quoting and,
    optionally, planted bad rows: ``x7`` in an integer column (``bad_int``: its name and
    the condition), one extra field (``extra``).  ``n_files`` is the least number of files.
    ``file_id`` and ``order`` deal the rows to just ``n_files`` and place them, each file in
    pieces; ``header`` names the columns of the file, in its order."""
    fields_of = {f.name: f for f in schema.fields}
    names = header or list(fields_of)
    n_tasks = file_count(df, n_files)
    n_files = n_tasks if file_id is None else n_files
    # Each step is a projection of its own: what several fields use is computed once for a row.
    h, no = F.col("h"), F.lit(False)
    hashed, place = F.xxhash64(*[F.col(c) for c in names]).alias("h"), F.struct(*(order or ["h"])).alias("ord")
    rows = df.select(*[F.col(c).alias(f"v_{c}") for c in names], hashed, (no if bad_int is None else bad_int[1]).alias("bad"),
                     (no if extra is None else extra).alias("extra"), *([_file(file_id, n_files)] if file_id is not None else []),
                     *([place] if order else []))
    rows = rows if order else rows.withColumn("ord", place)
    rows = rows.withColumn("file_id", _file(h, n_files)) if file_id is None else rows
    text_of = {c: _text(f"v_{c}", fields_of[c].dataType) for c in names}
    if bad_int and bad_int[0] in text_of:
        text_of[bad_int[0]] = F.when(F.col("bad"), F.lit("x7")).otherwise(text_of[bad_int[0]])
    texts = rows.select(*[t.alias(f"t_{c}") for c, t in text_of.items()], "h", "extra", "ord", "file_id")
    fields = []
    for name in names:
        txt = F.col(f"t_{name}")
        token = F.element_at(F.array(*[F.lit(t) for t in TOKENS]),
                             (F.pmod(h + F.lit(len(name)), F.lit(3)) + 1).cast("int"))
        quoted = F.concat(F.lit('"'), F.replace(txt, F.lit('"'), F.lit('""')), F.lit('"'))
        fields.append(F.when(txt.isNull(), token).when(F.pmod(h, F.lit(2)) == 0, quoted).otherwise(txt))
    line = F.concat_ws(",", *fields)
    if extra is not None:
        line = F.concat(line, F.when(F.col("extra"), F.lit(",extra")).otherwise(F.lit("")))
    body = texts.select("file_id", "ord", line.alias("value"))
    head = df.sparkSession.range(0, n_files, 1, 1).select(
        F.col("id").alias("file_id"), F.lit(None).cast(body.schema["ord"].dataType).alias("ord"),
        F.lit(",".join(names)).alias("value"))
    lines = body.unionByName(head)
    with compiled_methods(df.sparkSession):
        if file_id is None:
            (lines.repartitionById(n_files, F.col("file_id").cast("int")).sortWithinPartitions(F.col("ord").asc_nulls_first())
             .select("value").write.mode("overwrite").text(path))
        else:
            file_names = F.array(*[F.lit(f"part-{i:05d}") for i in range(n_files)])
            sample = df.sample(min(1.0, SAMPLED / files.ROWS_PER_FILE), seed=7)
            keys = sample.select("*", hashed).select(_file(file_id, n_files), place)
            (lines.repartitionById(n_tasks, _range_of(F.struct("file_id", "ord"), _borders(keys, n_tasks)))
             .withColumn(csv_load.PIECES, F.element_at(file_names, F.col("file_id").cast("int") + 1))
             .sortWithinPartitions(csv_load.PIECES, F.col("ord").asc_nulls_first()).select("value", csv_load.PIECES)
             .write.mode("overwrite").partitionBy(csv_load.PIECES).text(path))


def _borders(keys: DataFrame, n: int) -> list[F.Column]:
    """``n`` - 1 values that cut the rows of ``keys``, a sample, as structs, into ranges of about equal
    counts.  ``repartitionByRange`` samples whole rows, and so makes each of them twice; the keys need few
    columns.  No result depends on where a range ends."""
    sample = keys.repartition(1).sortWithinPartitions(*keys.columns).collect()
    ends = [sample[i * len(sample) // n] for i in range(1, n)] if sample else []

    def literal(value, dtype) -> F.Column:
        if isinstance(dtype, StructType) and value is not None:
            return F.struct(*[literal(v, f.dataType).alias(f.name) for v, f in zip(value, dtype.fields, strict=True)])
        return F.lit(value).cast(dtype)
    return [literal(row, keys.schema) for row in ends]


def _range_of(key: F.Column, borders: list[F.Column], before: int = 0) -> F.Column:
    """How many of the ascending ``borders`` are at most ``key``, by halving."""
    if not borders:
        return F.lit(before)
    half = len(borders) // 2
    return F.when(key < borders[half], _range_of(key, borders[:half], before)).otherwise(
        _range_of(key, borders[half + 1:], before + half + 1))


def csv_null_tokens(wh) -> DataFrame:
    """A1: bronze calls -> CSV with NULL/null/empty tokens -> typed load."""
    path = _scratch(wh.spark, "raw_vessel_calls_csv")
    write_csv_lines(wh.raw_vessel_calls, schemas.RAW_VESSEL_CALLS, path)
    return bronze_csv.load_bronze_csv(wh.spark, path, schemas.RAW_VESSEL_CALLS)


N_FILES = 4


def _customs_load(wh) -> DataFrame:
    """The customs feed as CSV with errors planted by key arithmetic, and its load."""
    spark, path = wh.spark, _scratch(wh.spark, "raw_customs_csv")
    order = F.split_part(F.substring("entry_number", 3, 100), F.lit("-"), F.lit(1)).cast("long")
    line = F.split_part("entry_number", F.lit("-"), F.lit(2)).cast("long")
    write_csv_lines(wh.raw_customs_entries, schemas.RAW_CUSTOMS_ENTRIES, path, n_files=N_FILES,
                    bad_int=("processing_days", (order + line) % 500 == 1), extra=(order + line) % 777 == 2,
                    file_id=order % N_FILES, order=[order, line])
    return csv_load.load_files(spark, path, schemas.RAW_CUSTOMS_ENTRIES, _scratch(spark, "customs_staged"), wh.as_of)


def load_audit(wh) -> DataFrame:
    """Customs CSV with planted type and shape errors -> audit.  Files go by their
    part number; the rest of their names changes with every run."""
    audit = csv_load.audit(_customs_load(wh), "raw_customs_entries", wh.as_of)
    return audit.withColumn("file_name", F.substring("file_name", 1, 10))


def csv_rejects(wh) -> DataFrame:
    """A3: the loaded (good) customs rows of the same planted-error files."""
    return csv_load.loaded(_customs_load(wh))


def csv_rejected_lines(wh) -> DataFrame:
    """A3: the rejected lines of the same files, with their numbers."""
    return (csv_load.rejected(_customs_load(wh))
            .select(F.substring("file_name", 1, 10).alias("file_name"), "line_number", "error"))


def csv_header_load(wh) -> DataFrame:
    """A2/A4: files with headers of their own, none with a load time: some with a column that
    the table does not have, some with their columns the other way round."""
    spark, path = wh.spark, _scratch(wh.spark, "shipments_by_header")
    names = [f.name for f in schemas.RAW_SHIPMENTS.fields if f.name != csv_load.LOAD_TIME]
    delayed = schemas.with_column(schemas.RAW_SHIPMENTS, "delay_hours", "int")
    rows = wh.raw_shipments.withColumn("delay_hours", F.lit(7))
    even = F.length("shipment_id") % 2 == 0
    write_csv_lines(rows.filter(even), delayed, f"{path}/in_order", n_files=2, header=[*names[:9], "delay_hours", *names[9:]])
    write_csv_lines(rows.filter(~even), delayed, f"{path}/reversed", n_files=2, header=names[::-1])
    staged = csv_load.load_files(spark, f"{path}/*", schemas.RAW_SHIPMENTS, _scratch(spark, "by_header_staged"), wh.as_of)
    return csv_load.loaded(staged)


def ingest_idempotent(wh) -> DataFrame:
    """A5: the same files ingested twice land once (checkpoint = load history)."""
    src = _scratch(wh.spark, "shipments_csv")
    target = _scratch(wh.spark, "bronze_raw_shipments")
    ckpt = _scratch(wh.spark, "ingest_checkpoint")
    write_csv_lines(wh.raw_shipments, schemas.RAW_SHIPMENTS, src)
    bronze_csv.ingest_files(wh.spark, src, schemas.RAW_SHIPMENTS, target, ckpt)
    second = bronze_csv.ingest_files(wh.spark, src, schemas.RAW_SHIPMENTS, target, ckpt)
    if second:
        raise AssertionError(f"re-ingest loaded {second} rows")
    return bronze_csv.read_ingested(wh.spark, target)


def skipped_inputs(wh) -> DataFrame:
    """Of three feeds one has not been delivered; the others load, it is skipped."""
    spark, root = wh.spark, _scratch(wh.spark, "deliveries")
    feeds = {"raw_vessel_calls": wh.raw_vessel_calls, "raw_shipments": wh.raw_shipments, "raw_customs_entries": None}
    out = None
    for name, feed in feeds.items():
        if feed is not None:
            write_csv_lines(feed, schemas.BRONZE[name], f"{root}/{name}")
        df = bronze_csv.read_if_exists(spark, f"{root}/{name}",
                                       lambda s, p, n=name: bronze_csv.load_bronze_csv(s, p, schemas.BRONZE[n]))
        rows = (spark.range(1).select(F.lit(0).cast("long").alias("row_count")) if df is None
                else df.agg(F.count(F.lit(1)).alias("row_count")))
        row = rows.select(F.lit(name).alias("table_name"), "row_count", F.lit("SKIPPED" if df is None else "LOADED").alias("status"))
        out = row if out is None else out.unionByName(row)
    return out


def seed_ports(wh) -> DataFrame:
    """Ports seed written as CSV and read back with its declared types."""
    path = _scratch(wh.spark, "ph_ports_csv")
    write_csv_lines(wh.bronze.ph_ports, schemas.PH_PORTS, path, n_files=1)
    return bronze_csv.seed(wh.spark, path, schemas.PH_PORTS)


def fx_feed_clean(wh) -> DataFrame:
    return fx_feed.clean_feed(fx_feed.raw_feed_from_rates(wh.usd_php_rates))


def fx_feed_validate(wh) -> DataFrame:
    return fx_feed.validate_feed(fx_feed_clean(wh))
