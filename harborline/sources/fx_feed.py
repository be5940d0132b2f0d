"""FX feed normalisation and validation (survey A9, A10).

The download client is not built; the cleaning of a raw daily OHLCV feed is:
date cast, renames, keep list, rates rounded to 4 places, missing volume ->
0, constant ``source``, one row per date.  The reference keeps "the first row
after a sort by date", which is ambiguous for repeated dates; here the row
fetched first wins (``fetched_at``, then the values), chosen by a partial
``min(struct)`` aggregate instead of a sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# FIXED VALUES — feed identity and plausibility band.
TICKER = "USDPHP=X"
SOURCE = f"yahoo_finance / {TICKER}"
CLOSE_MIN, CLOSE_MAX = 40.0, 75.0

RENAMES = {"Date": "rate_date", "Open": "usd_php_open", "High": "usd_php_high",
           "Low": "usd_php_low", "Close": "usd_php_close", "Volume": "usd_php_volume"}
RATE_COLS = ["usd_php_open", "usd_php_high", "usd_php_low", "usd_php_close"]


def raw_feed_from_rates(rates: DataFrame) -> DataFrame:
    """A raw-feed-shaped frame derived from the FX rate table (for tests and
    registered queries): timestamps with a time part, unrounded rates, an extra
    column, missing volumes and a second, later snapshot of some dates."""
    doy = F.dayofyear("rate_date")
    close = F.col("usd_php_close").cast("double") + (doy % 7) * 0.0000123
    base = rates.select(
        F.to_timestamp_ntz(F.concat(F.col("rate_date").cast("string"), F.lit(" 08:00:00"))).alias("Date"),
        (close - 0.0125).alias("Open"), (close + 0.0311).alias("High"), (close - 0.0407).alias("Low"),
        close.alias("Close"), (close + 0.00005).alias("Adj Close"),
        F.when(doy % 5 == 0, F.lit(None)).otherwise(doy * 1000.0).alias("Volume"),
        F.lit(1).alias("fetched_at"))
    again = (base.filter(F.dayofyear(F.to_date("Date")) % 11 == 0)
             .withColumn("Close", F.col("Close") + 0.5).withColumn("fetched_at", F.lit(2)))
    return base.unionByName(again)


def clean_feed(raw: DataFrame) -> DataFrame:
    """Typed, renamed, rounded, one row per date."""
    df = raw.withColumn("Date", F.to_date("Date"))
    for src, dst in RENAMES.items():
        if src in df.columns:
            df = df.withColumnRenamed(src, dst)
    keep = ["rate_date"] + [c for c in RATE_COLS + ["usd_php_volume"] if c in df.columns]
    order = ["fetched_at"] if "fetched_at" in df.columns else []
    df = df.select(*keep, *order)
    for c in RATE_COLS:
        if c in df.columns:
            # round the stored binary value (scale first), not its decimal text
            df = df.withColumn(c, F.round(F.col(c).cast("double") * 10000.0, 0) / 10000.0)
    vol = F.col("usd_php_volume") if "usd_php_volume" in df.columns else F.lit(None)
    df = df.withColumn("usd_php_volume", F.coalesce(vol.cast("double"), F.lit(0.0)).cast("long"))
    df = df.withColumn("source", F.lit(SOURCE))
    cols = [c for c in df.columns if c not in order]
    first = F.min(F.struct(*[F.col(c) for c in order + cols if c != "rate_date"]))
    out = df.filter(F.col("rate_date").isNotNull()).groupBy("rate_date").agg(first.alias("r"))
    return out.select("rate_date", *[F.col(f"r.{c}").alias(c) for c in cols if c != "rate_date"])


def validate_feed(clean: DataFrame) -> DataFrame:
    """A10: one-row validation report; emptiness fails, range breach and
    nulls warn."""
    g = clean.agg(F.count(F.lit(1)).alias("row_count"),
                  (F.count(F.lit(1)) - F.count_distinct("rate_date")).cast("long").alias("duplicate_dates"),
                  F.min("usd_php_close").alias("close_min"), F.max("usd_php_close").alias("close_max"),
                  (F.sum(F.col("usd_php_open").isNull().cast("long"))
                   + F.sum(F.col("usd_php_close").isNull().cast("long"))).cast("long").alias("null_open_close"),
                  F.min("rate_date").alias("first_date"), F.max("rate_date").alias("last_date"))
    in_range = (F.col("close_min").between(CLOSE_MIN, CLOSE_MAX)
                & F.col("close_max").between(CLOSE_MIN, CLOSE_MAX))
    status = (F.when(F.col("row_count") == 0, "FAIL")
              .when(F.col("duplicate_dates") > 0, "FAIL")
              .when(~in_range | (F.coalesce(F.col("null_open_close"), F.lit(0)) > 0), "WARN")
              .otherwise("OK"))
    return g.select("*", F.coalesce(in_range, F.lit(False)).alias("close_in_range"), status.alias("status"))
