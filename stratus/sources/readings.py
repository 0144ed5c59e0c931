"""The readings view derived from the driver's tables.

The test data has no sensor table, so a readings frame is derived from
``lineitem`` deterministically (one reading per line item, plus a second copy
of every tenth order's lines so that exact duplicates exist). Every quality
rule has something to find in it, and all measures are multiples of 1/64 so
sums are exact in any order. The same definition is written as SQL for the
DuckDB oracle in ``stratus.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings under standard names (8 columns)."""
    li = table(spark, sf_dir, "lineitem")
    # Every tenth order's lines appear twice: the copy is generated in the
    # same scan (no second pass over lineitem); no row is dropped.
    copies = F.when(F.col("l_orderkey") % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0)))
    li = li.select("*", F.explode(copies).alias("_copy"))
    line = F.col("l_linenumber")
    return li.select(
        F.col("l_orderkey").alias("reading_id"),
        F.when((line == 3) & (F.col("l_orderkey") % 16 == 0), F.lit(None).cast("timestamp_ntz"))
         .otherwise(F.col("l_shipdate")).alias("formatted_date"),
        F.when((line == 4) & (F.col("l_quantity") < 10), F.lit(""))
         .when(line == 2, F.lit(None).cast("string"))
         .otherwise(F.col("l_returnflag")).alias("summary"),
        F.when(line == 6, F.lit(None).cast("double"))
         .otherwise(F.col("l_quantity") * 2.5 - 60.0).alias("temperatureC"),
        F.when((line == 4) & (F.col("l_orderkey") % 4 == 1), F.lit(None).cast("double"))
         .otherwise(F.round(F.col("l_discount") * 100.0) * 0.109375).alias("humidity"),
        (F.round(F.col("l_tax") * 100.0) * 28.5).alias("wind_speed_kmh"),
        F.when(line == 7, F.lit(0.0))
         .when((line == 1) & (F.col("l_orderkey") % 8 == 0), F.lit(640.5))
         .when(line == 5, F.lit(None).cast("double"))
         .otherwise(900.0 + F.floor(F.col("l_extendedprice") / 500.0).cast("double"))
         .alias("pressure_millibars"),
        (F.col("l_quantity") * 0.25).alias("visibility_km"),
    )


# Standard name -> raw (CSV) name for the raw-name variant of the view.
RAW_NAMES = {
    "formatted_date": "Formatted Date",
    "summary": "Summary",
    "temperatureC": "Temperature (C)",
    "humidity": "Humidity",
    "wind_speed_kmh": "Wind Speed (km/h)",
    "pressure_millibars": "Pressure (millibars)",
    "visibility_km": "Visibility (km)",
}


def raw_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same readings under the raw sensor names."""
    return readings(spark, sf_dir).withColumnsRenamed(RAW_NAMES)


def text_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings with what text formats get wrong: line breaks, quotes,
    backslashes, blanks, empty and null texts, and times of microseconds."""
    key = F.pmod(F.col("reading_id"), F.lit(8))
    texts = ["two\nlines", 'say "hi", they', "back\\slash \\n", "", None, "  padded, comma ", "cr\r\nlf", "ünï – 漢"]
    note = F.lit(None).cast("string")
    for i, t in enumerate(texts):
        note = F.when(key == i, F.lit(t)).otherwise(note)
    return readings(spark, sf_dir).withColumns({
        "note": note, "seen_at": F.expr("timestampadd(MICROSECOND, reading_id, formatted_date)")})
