"""Helpers that the operators of this folder share."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chainlens.session import releasing, scratch_path

#: Bits of the filter of thinned: 2 MB, whatever the input.
FILTER_BITS = 512 * 32768
#: A word is a maximal run of characters other than space, \t, \n, \v, \f, \r.
WORD = r"[^\x20\x09-\x0D]+"


def by_value(module: str) -> None:
    """Ship a module's functions to the Python workers by value, so executors
    need no copy of the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


by_value(__name__)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder of the shared checkpoint directory and read
    it back: cuts lineage, survives a lost executor, and fixes values that
    depend on how rows were dealt out.  What was exchanged for it leaves the disk."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with releasing(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def thinned(df: DataFrame, wanted: DataFrame, by: list[str]) -> DataFrame:
    """The rows of ``df`` whose ``by`` columns may occur in ``wanted``: a filter of
    fixed size on their hashes goes to every task, so that a join with ``wanted``
    exchanges hardly more than it keeps; a full filter lets more through, never less."""
    place = F.pmod(F.xxhash64(*by), F.lit(FILTER_BITS).cast("long"))
    bits = wanted.select(place.alias("place_")).groupBy(F.bitmap_bucket_number("place_").alias("bucket_")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("place_")).alias("bits_"))
    found = df.withColumn("place_", place).withColumn("bucket_", F.bitmap_bucket_number("place_")).withColumn("at_", F.bitmap_bit_position("place_"))
    byte = F.conv(F.hex(F.substring(F.col("bits_"), (F.floor(F.col("at_") / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    found = found.join(F.broadcast(bits), "bucket_").where(F.call_function("shiftright", byte, (F.col("at_") % 8).cast("int")).bitwiseAND(F.lit(1)) == 1)
    return found.select(*df.columns)


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
