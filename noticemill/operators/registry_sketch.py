"""A sketch beside the registry: numbers it can't know are settled without reading it.

The registry lands in portions, each cut by law and by a hash of the number into `buckets`
folders. Beside them lie Bloom sketches, bitmaps of 32,768 bits: a number belongs to one
bitmap of its bucket and sets `PROBES` of its bits. A run probes the sketches; only buckets
of portions where all bits of some number are set are opened. Bitmaps are built and probed
by column functions; a sketch has about `BITS_PER_NUMBER` bits for each number and grows
with the registry.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from noticemill.operators.registry import NUMBER_KEY
from noticemill.session import stage

BUCKETS = 64
BITS_PER_NUMBER = 12
PROBES = 6
BITMAP_BITS = 32_768
PLACE = ["portion", "law", "bucket"]

ROWS = "id_notification bigint, notificationnumber string, portion string, law string, bucket int"
SKETCH = "bitmap_no bigint, bitmaps bigint, bits binary, portion string, law string, bucket int"


def _bucket(number: Column) -> Column:
    return F.pmod(F.xxhash64(number), F.lit(BUCKETS)).cast("int")


def _bits(number: Column) -> Column:
    return F.array(*[F.pmod(F.xxhash64(number, F.lit(i)), F.lit(BITMAP_BITS)) for i in range(1, PROBES + 1)])


def _bitmap_no(number: Column, bitmaps: Column) -> Column:
    return F.pmod(F.xxhash64(number, F.lit(0)), bitmaps)


def land_registry(rows: DataFrame, path: str, portion: str) -> None:
    """Land a portion of the registry (id_notification, notificationnumber, law) with its sketch.

    Rows without a number or law are left out, as nothing can be compared with them. A
    portion that lands again replaces itself; the others are not touched.
    """
    spark = rows.sparkSession
    kept = rows.select("id_notification", "notificationnumber", "law").dropna(subset=["notificationnumber", "law"])
    own = f"{path}/rows/portion={portion}"
    (
        kept.withColumn("bucket", _bucket(F.col("notificationnumber")))
        .hint("rebalance", "law", "bucket")
        .write.mode("overwrite")
        .partitionBy("law", "bucket")
        .parquet(own)
    )
    landed = spark.read.schema("notificationnumber string, law string, bucket int").parquet(own)
    numbers = stage(landed.distinct(), "registry-numbers")
    sizes = numbers.groupBy("law", "bucket").agg(F.ceil(F.count(F.lit(1)) * BITS_PER_NUMBER / BITMAP_BITS).alias("bitmaps"))
    placed = numbers.join(sizes, ["law", "bucket"])
    number = F.col("notificationnumber")
    set_bits = placed.select(
        "law", "bucket", "bitmaps", _bitmap_no(number, F.col("bitmaps")).alias("bitmap_no"), F.explode(_bits(number)).alias("bit")
    )
    sketch = set_bits.groupBy("law", "bucket", "bitmap_no").agg(F.first("bitmaps").alias("bitmaps"), F.bitmap_construct_agg("bit").alias("bits"))
    sketch.repartition("law", "bucket").write.mode("overwrite").partitionBy("law", "bucket").parquet(f"{path}/sketches/portion={portion}")


def possibly_known(spark: SparkSession, path: str, numbers: DataFrame) -> DataFrame:
    """(portion, law, bucket, notice_num) of the distinct `numbers` that a portion may hold.

    No number that it holds is missing; of others about one in a thousand is there.
    """
    sketches = spark.read.schema(SKETCH).parquet(f"{path}/sketches")
    wanted = numbers.select(*NUMBER_KEY, _bucket(F.col("notice_num")).alias("bucket"))
    sizes = sketches.select(*PLACE, "bitmaps").distinct()
    number = F.col("notice_num")
    probes = wanted.join(sizes, ["law", "bucket"]).select(
        *PLACE, "notice_num", _bitmap_no(number, F.col("bitmaps")).alias("bitmap_no"), _bits(number).alias("_probes")
    )

    def is_set(bit: Column) -> Column:
        byte = F.conv(F.hex(F.substring("bits", (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        return F.call_function("shiftright", byte, (bit % 8).cast("int")).bitwiseAND(F.lit(1)) == 1

    return probes.join(sketches.select(*PLACE, "bitmap_no", "bits"), [*PLACE, "bitmap_no"]).filter(F.forall("_probes", is_set)).select(*PLACE, "notice_num")


def known_by_sketch(spark: SparkSession, path: str, numbers: DataFrame) -> DataFrame:
    """Those of `numbers` (law, notice_num, distinct) that the landed registry knows.

    A number counts as unknown when any of its rows, in whichever portion, lacks the
    notification id. Only buckets that may hold a number are opened, as long as Spark
    can broadcast these numbers; beyond that all are read, to the same result.
    """
    met = stage(possibly_known(spark, path, numbers), "possibly-known")
    rows = spark.read.schema(ROWS).parquet(f"{path}/rows").withColumnRenamed("notificationnumber", "notice_num")
    # true of every row: Spark prunes folders by a join only where its other side is filtered
    found = rows.join(met.filter("bucket >= 0"), [*PLACE, "notice_num"], "left_semi")
    known = F.every(F.col("id_notification").isNotNull()).alias("_known")
    return found.groupBy(*NUMBER_KEY).agg(known).filter("_known").drop("_known")


def new_numbers_by_sketch(spark: SparkSession, path: str, collected: DataFrame) -> DataFrame:
    """Distinct collected (law, notice_num) that the landed registry does not know: `new_numbers` by its sketch."""
    numbers = stage(collected.select(*NUMBER_KEY).distinct(), "numbers")
    return numbers.join(known_by_sketch(spark, path, numbers), NUMBER_KEY, "left_anti")
