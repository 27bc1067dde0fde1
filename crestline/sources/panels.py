"""Load panels derived from general tables: app_id, lpar, business_date, interval_idx, fiscal_year, mips."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crestline.functions.calendar import Grid, business_day, fiscal_year


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hourly(spark: SparkSession, sf_dir: str, grid: Grid = Grid()) -> DataFrame:
    """P1: events by type, user half and hour of prime time."""
    e = table(spark, sf_dir, "events").select("ts", "event_type", "user_id", "value", F.to_date("ts").alias("business_date"))
    e = e.where(business_day(F.col("business_date"), grid) & F.hour("ts").between(8, 16))
    keys = [F.col("event_type").alias("app_id"), F.concat(F.lit("P"), F.col("user_id") % 2).alias("lpar"), "business_date", (F.hour("ts") - 8).alias("interval_idx")]
    return e.groupBy(*keys).agg(F.sum("value").alias("mips")).withColumn("fiscal_year", fiscal_year(F.col("business_date"), grid))


def _shipped(spark: SparkSession, sf_dir: str, app, lpar, idx) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").withColumn("business_date", F.to_date("l_shipdate"))
    li = li.where(business_day(F.col("business_date")))
    rows = li.groupBy(app.alias("app_id"), lpar.alias("lpar"), "business_date", idx.cast("int").alias("interval_idx"))
    return rows.agg(F.sum("l_extendedprice").alias("mips")).withColumn("fiscal_year", fiscal_year(F.col("business_date")))


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P2: line items by flag and status, one value a day."""
    return _shipped(spark, sf_dir, F.concat("l_returnflag", "l_linestatus"), F.col("l_linestatus"), F.lit(0))


def thirds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P3b: line items by flag, three values a day."""
    return _shipped(spark, sf_dir, F.col("l_returnflag"), F.lit("P"), (F.col("l_linenumber") - 1) % 3)


def windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W: six event windows of two hours around the largest errors in prime time."""
    e = table(spark, sf_dir, "events").where("event_type = 'error'").where((F.weekday("ts") < 5) & F.hour("ts").between(8, 16))
    top = e.orderBy(F.desc("value"), "event_id").limit(6).select("event_id", "ts", "value")
    from pyspark.sql import Window

    rank = F.row_number().over(Window.orderBy(F.desc("value"), "event_id")) - 1  # six rows
    start = F.date_trunc("hour", "ts").cast("timestamp_ntz")
    return top.withColumn("r", rank).select(
        F.col("r").alias("event_seq"), F.element_at(F.array(*map(F.lit, ("DR", "IST", "GCC_SDF"))), F.col("r") % 3 + 1).alias("event_type"),
        F.when(F.col("r") % 2 == 0, "*").otherwise("P0").alias("lpar"), F.lit("*").alias("app_id"),
        start.alias("start_ts"), (start + F.expr("INTERVAL 2 HOURS")).alias("end_ts"),
    )
