"""Customer activity from states of single days that merge.

A distinct count cannot be added up over days, the sets behind it can be united. A state
holds, for a day, a customer and a bucket of order numbers, the sums of the lines and the
set of orders, exactly: a few orders as their places in the bucket, many as a bitmap. So a
day's lines are read once; whatever range of days is asked for later comes from states.

Sets are united without a large buffer for every customer: places are made different by
an ordinary aggregate, and only buckets that hold a bitmap somewhere are united as bits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.spread import dealt, wanted_tasks

DAY = "sold_date_sk"
# From so many orders of a bucket on, which has 32,768 numbers, their set is kept as 4,096 bytes of bits.
DENSE = 1024
_KEY = [DAY, "customer_sk", "bucket"]
# Numbers of a bucket.
_NUMBERS = 32_768
_SUMS = ("sales_amt", "profit_amt", "sales_lines", "profit_lines")


def order_states(sales: DataFrame, dense_from: int = DENSE) -> DataFrame:
    """States of the days of ``sales``, ``incremental_sales`` with ``sold_date`` or ``sales_with_date``.

    Columns ``sold_date_sk, customer_sk, bucket, sold_date, sales_amt, profit_amt, sales_lines,
    profit_lines, places, bitmap``. Lines without an order number are in the bucket null, those
    without a day have states of their own. Lines move once, by day, customer and bucket, so a customer
    with many lines is spread over tasks; lines of an order are summed first, and ``places`` has at
    most 32,768 entries.
    """
    number = F.col("order_number").cast("long")
    keyed = sales.withColumn("bucket", F.bitmap_bucket_number(number))
    tasks = wanted_tasks(sales)
    met = dealt(keyed, _KEY, tasks) if tasks else keyed.repartition(*_KEY)
    per_order = met.groupBy(*_KEY, "order_number").agg(
        F.min("sold_date").alias("sold_date"),
        F.sum("daily_sales_amt").alias("sales_amt"),
        F.sum("daily_net_profit").alias("profit_amt"),
        F.count("daily_sales_amt").alias("sales_lines"),
        F.count("daily_net_profit").alias("profit_lines"),
    )
    states = (
        per_order.withColumn("place", F.bitmap_bit_position(number).cast("int"))
        .groupBy(*_KEY)
        .agg(
            F.min("sold_date").alias("sold_date"),
            *[F.sum(c).alias(c) for c in _SUMS],
            F.array_sort(F.collect_list("place")).alias("places"),
        )
    )
    many = F.size("places") >= dense_from
    kept = F.when(many, F.array().cast("array<int>")).otherwise(F.col("places"))
    return states.select(*_KEY, "sold_date", *_SUMS, kept.alias("places"), F.when(many, _bits(F.col("places"))).alias("bitmap"))


def _bits(places: Column) -> Column:
    """Bitmap of different places, laid out as ``bitmap_construct_agg`` does: lowest bit of a byte first.

    Places become text of zeros and ones, highest bit of a byte first, and that hexadecimal digits.
    """
    turned = F.array_sort(F.transform(places, lambda place: place.bitwiseXOR(F.lit(7))))
    ends = F.concat(turned, F.array(F.lit(_NUMBERS)))
    starts = F.concat(F.array(F.lit(-1)), turned)
    gaps = F.zip_with(starts, ends, lambda start, end: F.repeat(F.lit("0"), end - start - 1))
    # Four digits before each comma, so no replacement meets another's result.
    digits = F.regexp_replace(F.array_join(gaps, "1"), "([01]{4})", "$1,")
    for value in range(16):
        digits = F.replace(digits, F.lit(f"{value:04b},"), F.lit(f"{value:X}"))
    return F.unhex(digits)


def _has(bitmap: Column, place: Column) -> Column:
    """Whether a bit of a bitmap is set."""
    octet = F.conv(F.hex(F.substring(bitmap, F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(octet, F.pmod(place, F.lit(8))) == 1


def distinct_orders(states: DataFrame) -> DataFrame:
    """``customer_sk, orders``: parts of the number of different orders in ``states`` of any days, to be added up."""
    bucket = ["customer_sk", "bucket"]
    united = states.where("bitmap IS NOT NULL").groupBy(*bucket).agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    places = states.select(*bucket, F.explode("places").alias("place")).distinct()
    same = F.col("p.customer_sk").eqNullSafe(F.col("u.customer_sk")) & (F.col("p.bucket") == F.col("u.bucket"))
    beside = places.alias("p").join(united.alias("u"), same, "left")
    new = beside.where(F.col("u.bitmap").isNull() | ~_has(F.col("u.bitmap"), F.col("place")))
    single = new.select("p.customer_sk", F.lit(1).cast("long").alias("orders"))
    return single.unionByName(united.select("customer_sk", F.bitmap_count("bitmap").alias("orders")))


def merged_activity(states: DataFrame) -> DataFrame:
    """``customer_activity`` of the days whose ``order_states`` are given; orders across days count once.

    ``states`` are read twice: pass a stored table.
    """
    measures = states.select("customer_sk", F.lit(0).cast("long").alias("orders"), "sold_date", *_SUMS)
    counted = distinct_orders(states)
    added = measures.unionByName(counted, allowMissingColumns=True)
    return added.groupBy("customer_sk").agg(
        F.min("sold_date").alias("first_purchase_date"),
        F.max("sold_date").alias("last_purchase_date"),
        F.sum("orders").alias("orders"),
        *[F.sum(c).alias(c) for c in _SUMS],
    )
