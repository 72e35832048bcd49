"""Tables, key rules and scratch folders that several operators share."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hitledger.session import scratch_dir

#: Bits of a sieve for each row sought, and bits at most: 16 MB, sent to every executor.
SIEVE_LOAD, SIEVE_BITS = 16, 1 << 27
#: Bits of one bitmap of Spark's, and bits of the pieces that rows meet.
BITMAP_BITS, PIECE_BITS = 1 << 15, 1 << 10


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared scratch folder of the session."""
    return f"{scratch_dir(spark)}/hitledger-{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write rows below the shared scratch folder and read them back.

    The written files cut the lineage: a lost executor costs a reread, not the work before.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    found = spark.read.schema(df.schema).parquet(path)
    found.scratch = path
    return found


def discard(*frames: DataFrame) -> None:
    """Remove what ``stored`` wrote, once everything made from it is stored itself."""
    for frame in frames:
        path = frame.sparkSession._jvm.org.apache.hadoop.fs.Path(frame.scratch)
        system = path.getFileSystem(frame.sparkSession._jsc.hadoopConfiguration())
        system.delete(path, True)


def _sieved(rows: DataFrame, value: Column, sought: DataFrame, of_sought: Column) -> DataFrame:
    """Rows with __among, which is false only where no sought row has the value, a hash.

    The size is bounded, so more sought rows only let more rows pass. sought is read twice.
    """
    bits = min(SIEVE_BITS, max(BITMAP_BITS, SIEVE_LOAD * sought.count()))
    at = F.pmod(of_sought, F.lit(bits))
    bitmaps = (
        sought.select(at.alias("__at"))
        .withColumn("__bucket", F.floor(F.col("__at") / BITMAP_BITS))
        .repartition("__bucket")
        .groupBy("__bucket")
        .agg(F.bitmap_construct_agg(F.col("__at") % BITMAP_BITS).alias("__whole"))
    )
    # a row takes along a copy of what it meets, so that should be small
    each = BITMAP_BITS // PIECE_BITS
    first = (F.col("__i") * (PIECE_BITS // 8) + 1).cast("int")
    pieces = bitmaps.withColumn("__i", F.explode(F.sequence(F.lit(0), F.lit(each - 1)))).select(
        (F.col("__bucket") * each + F.col("__i")).alias("__piece"),
        F.substring("__whole", first, F.lit(PIECE_BITS // 8)).alias("__bits"),
    )
    placed = rows.withColumn("__at", F.pmod(value, F.lit(bits))).withColumn(
        "__piece", F.floor(F.col("__at") / PIECE_BITS)
    )
    place = F.col("__at") % PIECE_BITS
    byte = F.conv(F.hex(F.substring("__bits", (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10)
    among = F.getbit(byte.cast("int"), (place % 8).cast("int")) == 1
    joined = placed.join(F.broadcast(pieces), "__piece", "left")
    return joined.withColumn("__among", F.coalesce(among, F.lit(False))).drop("__at", "__piece", "__bits")


def perhaps_among(rows: DataFrame, value: Column, sought: DataFrame, of_sought: Column) -> DataFrame:
    """Rows but for most of those whose value, a hash, no row of sought has.

    A join of few of the rows by shuffle moves few of them then.
    """
    return _sieved(rows, value, sought, of_sought).where("__among").drop("__among")


def surely_apart(
    rows: DataFrame, value: Column, sought: DataFrame, of_sought: Column
) -> tuple[DataFrame, DataFrame]:
    """Rows whose value, a hash, no row of sought has for certain, and the others."""
    sieved = _sieved(rows, value, sought, of_sought)
    return sieved.where("NOT __among").drop("__among"), sieved.where("__among").drop("__among")


def fold_of(key: Column, folds: int) -> Column:
    """CRC-32 of a key written as text, modulo a number of folds; null keys count as ''."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % folds


def text_or_empty(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(""))
