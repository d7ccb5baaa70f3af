"""The trending data model laid over the driver's tables.

``raw_observations`` has the columns of the raw trending CSV (camelCase names,
an ISO-8601 duration text) with the types the driver tables already carry;
``observations`` is that frame after ``prepare``. ``stream_messages`` turns ``events`` into transport envelopes
``(key, value, timestamp)`` with a JSON value, and ``stream_history`` is the
slice of those events that plays the stored history.

Mapping, one observation per lineitem:
  region_code = customer's region name, video_id/title = part key/name,
  channel_id/channel_title = supplier key/name, category_id = part size,
  trending_date = ship date, published_at = order date,
  tags = part brand alone for sizes divisible by 10, else the words of the part
  name, the brand and the type joined by '|',
  view_count = floor(extended price), likes = floor(quantity),
  dislikes = line number, comment_count = floor(price * discount / 1000),
  duration = 'PT' ['1H' when size > 40] size 'M' floor(quantity) 'S'.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from trendlens.plans.prepare import prepare
from trendlens.sources.tables import read_table

STREAM_CHANNELS = 50


def _joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey",
                    "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_shipdate")
    orders = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    customer = read_table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    nation = read_table(spark, sf_dir, "nation", "n_nationkey", "n_regionkey")
    region = read_table(spark, sf_dir, "region", "r_regionkey", "r_name")
    part = read_table(spark, sf_dir, "part", "p_partkey", "p_name", "p_brand", "p_type", "p_size")
    supplier = read_table(spark, sf_dir, "supplier", "s_suppkey", "s_name")

    # Resolve each order's region on the order side (orders are a quarter of
    # the lineitem rows), so lineitem itself is shuffled once for that join.
    # lineitem x orders is a fact-to-fact join: pin it to a sort-merge join so
    # neither side is ever collected for a broadcast, whatever the size
    # estimate says. nation/region are tiny and fall under the automatic
    # broadcast threshold; part/supplier/customer are left to the planner and
    # AQE (broadcast while small, sort-merge beyond).
    cust_region = (customer
                   .join(nation, customer.c_nationkey == nation.n_nationkey)
                   .join(region, nation.n_regionkey == region.r_regionkey)
                   .select("c_custkey", "r_name"))
    order_region = (orders.join(cust_region, orders.o_custkey == cust_region.c_custkey)
                    .select("o_orderkey", "o_orderdate", "r_name"))
    return (li.join(order_region.hint("merge"), li.l_orderkey == order_region.o_orderkey)
            .join(part, li.l_partkey == part.p_partkey)
            .join(supplier, li.l_suppkey == supplier.s_suppkey))


def raw_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = _joined(spark, sf_dir)
    size = F.col("p_size")
    qty = F.floor("l_quantity")
    tags = F.when(size % 10 == 0, F.col("p_brand")).otherwise(
        F.concat(F.regexp_replace("p_name", " ", "|"), F.lit("|"), F.col("p_brand"),
                 F.lit("|"), F.col("p_type")))
    duration = F.concat(F.lit("PT"), F.when(size > 40, F.lit("1H")).otherwise(F.lit("")),
                        size.cast("string"), F.lit("M"), qty.cast("string"), F.lit("S"))
    return j.select(
        F.col("r_name").alias("region_code"),
        F.col("l_partkey").cast("string").alias("video_id"),
        F.col("p_name").alias("title"),
        F.col("o_orderdate").cast("timestamp").alias("publishedAt"),
        F.col("l_suppkey").cast("string").alias("channelId"),
        F.col("s_name").alias("channelTitle"),
        size.alias("categoryId"),
        F.col("l_shipdate").cast("date").alias("trending_date"),
        tags.alias("tags"),
        F.floor("l_extendedprice").alias("view_count"),
        qty.alias("likes"),
        F.col("l_linenumber").cast("bigint").alias("dislikes"),
        F.floor(F.col("l_extendedprice") * F.col("l_discount") / 1000).alias("comment_count"),
        duration.alias("duration"),
    )


def text_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw_observations`` as text, as a CSV holds it; odd line numbers write
    their view count as a decimal."""
    raw = raw_observations(spark, sf_dir)
    views = F.concat(F.col("view_count").cast("string"),
                     F.when(F.col("dislikes") % 2 == 1, F.lit(".0")).otherwise(F.lit("")))
    return raw.select(*[views.alias(c) if c == "view_count" else F.col(c).cast("string").alias(c)
                        for c in raw.columns])


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare(raw_observations(spark, sf_dir))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value", "props")


def _event_columns(ev: DataFrame) -> DataFrame:
    chan = (F.col("user_id") % STREAM_CHANNELS).cast("string")
    return ev.select(
        "ts",
        "event_id",
        F.col("user_id").cast("string").alias("video_id"),
        chan.alias("channel_id"),
        F.concat(F.lit("Channel#"), chan).alias("channel_title"),
        F.col("event_type").alias("region_code"),
        F.col("value").alias("view_count"),
        F.get_json_object("props", "$.k").alias("k"),
    )


def stream_messages(spark: SparkSession, sf_dir: str, partitions: int | None = None,
                    stamps: str = "iso") -> DataFrame:
    """Envelopes ``key binary, value binary, timestamp timestamp``.

    ``collected_at`` is written the way the producer writes it (ISO-8601 with
    microseconds and a ``+00:00`` offset); the transport timestamp is the same
    instant. With ``stamps="mixed"`` the layout goes by ``user_id % 4`` (plain,
    ISO, empty, malformed) and the transport time is a day later, so that every
    way to an event time is taken. With ``stamps="faulty"`` four of fifty messages
    are spoilt, by ``event_id % 50``: 0 is cut short, 1 is stamped in the year 9999,
    2 is stamped thirty days early, 3 has no transport time.

    The scan's own splits are kept; ``partitions`` deals the rows out evenly
    (without a key, so no hot item can gather in one task).
    """
    e = _event_columns(_events(spark, sf_dir))
    if partitions:
        e = e.repartition(partitions)
    iso = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))
    sent = F.col("ts").cast("timestamp")
    if stamps == "mixed":
        kind = F.col("video_id").cast("bigint") % 4
        iso = (F.when(kind == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).when(kind == 1, iso)
               .when(kind == 2, F.lit("")).otherwise(F.lit("yesterday, about noon")))
        sent = sent + F.expr("INTERVAL 1 DAY")
    fault = F.col("event_id") % 50
    if stamps == "faulty":
        early = F.date_format(F.col("ts") - F.expr("INTERVAL 30 DAYS"), "yyyy-MM-dd HH:mm:ss")
        iso = F.when(fault == 1, F.lit("9999-12-31 23:59:59")).when(fault == 2, early).otherwise(iso)
        sent = F.when(fault != 3, sent)
    payload = F.struct(
        iso.alias("collected_at"),
        F.col("region_code"),
        F.col("video_id"),
        F.concat(F.lit("Item "), F.col("video_id")).alias("title"),
        F.col("channel_id"),
        F.col("channel_title"),
        F.col("view_count"),
        F.concat(F.lit("PT"), F.col("k"), F.lit("M")).alias("duration"),
    )
    body = F.to_json(payload)
    if stamps == "faulty":
        body = F.when(fault == 0, F.substring(body, 1, 12)).otherwise(body)
    return e.select(
        F.col("video_id").cast("binary").alias("key"),
        body.cast("binary").alias("value"),
        sent.alias("timestamp"),
    )


def stream_history(spark: SparkSession, sf_dir: str, until: str) -> DataFrame:
    """Stored history for the stream, the events before ``until`` (UTC):
    ``region_code, channel_id, view_count``."""
    ev = _events(spark, sf_dir).where(F.col("ts") < F.lit(until).cast("timestamp_ntz"))
    return _event_columns(ev).select("region_code", "channel_id", "view_count")
