"""The derived ``preprints`` view: preprint-shaped records computed by Spark from orders/lineitem.

One record per order; three orders share a DOI (versions '2', '6', '10'); unpublished
records carry the 'NA' sentinel; publication dates can be empty or year-only; the nested
citation list holds one ISO-8601 timespan per line item (text '' on line 5, negative spans
when shipping precedes ordering). ``_id`` is the record id (the order key).

Plan: lineitem is aggregated once by order key (partial aggregation, one shuffle) and the
result, already hash-partitioned on the key, is joined to orders; timespans are computed
with ``transform`` on the per-order array, so no second join or explode is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholarspark.sources.tables import read_table

# FIXED VALUES of the fixture: order priority -> preprint category.
PRIORITY_CATEGORY = [
    ("1-URGENT", "neuroscience"),
    ("2-HIGH", "systems biology"),
    ("3-MEDIUM", "oncology"),
    ("4-NOT SPECIFIED", "hiv aids"),
]
DEFAULT_CATEGORY = "marine biology"


def _timespan(line, order_date):
    dd = F.datediff(line["sd"], order_date)
    a = F.abs(dd)
    return (F.when(line["l_linenumber"] == 5, F.lit(""))
            .otherwise(F.concat(F.when(dd < 0, F.lit("-")).otherwise(F.lit("")), F.lit("P"),
                                F.floor(a / 365).cast("bigint").cast("string"), F.lit("Y"),
                                F.floor((a % 365) / 30).cast("bigint").cast("string"), F.lit("M"))))


def preprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders",
                        ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"])
    lines = (read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_shipdate"])
             .select("l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("sd")))
    per_order = lines.groupBy("l_orderkey").agg(
        F.min("sd").alias("first_ship"),
        F.collect_list(F.struct("l_linenumber", "sd")).alias("lines"))
    j = orders.join(per_order, orders.o_orderkey == per_order.l_orderkey, "left")

    key = F.col("o_orderkey")
    group = F.expr("o_orderkey div 3")
    od = F.to_date("o_orderdate")
    category = F.lit(DEFAULT_CATEGORY)
    for prio, cat in reversed(PRIORITY_CATEGORY):
        category = F.when(F.col("o_orderpriority") == prio, F.lit(cat)).otherwise(category)
    unpublished = F.col("o_orderstatus") == "O"
    ship_txt = F.col("first_ship").cast("string")
    citations = F.transform("lines", lambda x: F.struct(_timespan(x, od).alias("timespan")))

    return j.select(
        key.alias("_id"),
        F.concat(F.lit("10.1/"), group.cast("string")).alias("doi"),
        ((key % 3) * 4 + 2).cast("string").alias("version"),
        F.when(group % 2 == 0, F.lit("serverA")).otherwise(F.lit("serverB")).alias("server"),
        category.alias("category"),
        F.concat(F.lit("Order "), key.cast("string"), F.lit(" "), F.col("o_orderpriority")).alias("title"),
        F.repeat(F.concat(F.lit("Customer "), F.col("o_custkey").cast("string"), F.lit(" é. ")),
                 (F.lit(1) + F.col("o_custkey") % 9).cast("int")).alias("abstract"),
        F.when(key % 13 == 0, F.lit(None).cast("string"))
         .otherwise(F.repeat(F.lit("X, Y;"), (F.lit(1) + key % 6).cast("int"))).alias("authors"),
        F.lit(None).cast("string").alias("author_corresponding_institution"),
        od.cast("string").alias("date"),
        F.when(unpublished, F.lit("NA")).otherwise(F.concat(F.lit("10.9/"), key.cast("string"))).alias("published"),
        F.when(unpublished, F.lit(None).cast("string"))
         .when(key % 7 == 0, F.lit(""))
         .when(key % 5 == 0, F.substring(ship_txt, 1, 4))
         .otherwise(ship_txt).alias("publiDate"),
        F.when(unpublished, F.lit(None)).otherwise(citations).alias("citations"),
    )
