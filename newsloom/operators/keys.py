"""Which files of a table may hold some keys: key ranges and bits of hashes, kept for each file."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key sets one bit for each of HASHES hashes. A file has SIZES[i] buckets of BITS bits for each, the fewest that give SPARE bits a key.
HASHES, BITS, SIZES, SPARE = 2, 32_768, (1, 8, 64), 16


def ordered(key: Column) -> Column:
    """A text that sorts numbers by their value: its length in six digits, then itself."""
    return F.concat(F.lpad(F.char_length(key).cast("string"), 6, "0"), key)


def bits_of(rows: DataFrame, key: str, *columns: str) -> DataFrame:
    """``columns``, key, size, which, bucket, position: the bits that a key sets in a file of ``size`` buckets, a row each."""
    which = F.explode(F.sequence(F.lit(0), F.lit(HASHES - 1))).alias("which")
    hashed = rows.select(*columns, key, "size", which)
    hashed = hashed.withColumn("__bit", F.pmod(F.xxhash64(key, "which"), F.col("size").cast("long") * BITS))
    return hashed.select(
        *columns, key, "size", "which", (F.col("which") * F.col("size") + F.floor(F.col("__bit") / BITS)).cast("int").alias("bucket"),
        F.pmod("__bit", F.lit(BITS)).cast("long").alias("position"),
    )


def key_index(rows: DataFrame, key: str, by: Sequence[str], keys_per_file: float) -> DataFrame:
    """``by``, low, high, size, bucket, bits: what the files named by ``by`` say of their keys.

    A row for each bucket of a file, with the lowest and highest key of those that set bits there. Files have as many
    buckets as ``keys_per_file`` asks for; one that holds more keys is named in vain more often, and never left out. Bits are gathered
    per task before the shuffle, 4096 bytes for each bucket that a file has keys in.
    """
    size = next((size for size in SIZES if keys_per_file * SPARE <= size * BITS), SIZES[-1])
    bits = bits_of(rows.withColumn("size", F.lit(size)), key, *by)
    return bits.groupBy(*by, "size", "bucket").agg(
        F.min(ordered(F.col(key))).alias("low"), F.max(ordered(F.col(key))).alias("high"),
        F.bitmap_construct_agg("position").alias("bits"),
    )


def has_bit(bits: Column, position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.call_function("shiftright", byte, F.pmod(position, F.lit(8)).cast("int")).bitwiseAND(F.lit(1)) == 1


def holding(index: DataFrame, keys: DataFrame, key: str, file: str) -> DataFrame:
    """The files of ``index`` that may hold one of ``keys``; none that does is left out.

    The keys are broadcast, so their number must be bounded by the caller.
    """
    sized = keys.select(key, F.explode(F.array(*[F.lit(size) for size in SIZES])).alias("size"))
    wanted = bits_of(sized, key).withColumn("__key", ordered(F.col(key)))
    wanted = wanted.withColumnsRenamed({"bucket": "__bucket", "size": "__size"})
    met = index.join(
        F.broadcast(wanted),
        (F.col("bucket") == F.col("__bucket")) & (F.col("size") == F.col("__size"))
        & (F.col("__key") >= F.col("low")) & (F.col("__key") <= F.col("high")),
    ).filter(has_bit(F.col("bits"), F.col("position")))
    whole = met.groupBy(file, "__key").agg(F.count_distinct("which").alias("n")).filter(F.col("n") == HASHES)
    return whole.select(file).distinct()
