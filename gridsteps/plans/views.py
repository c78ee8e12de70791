"""The driver's tables in the shapes of the library.

Parts play the cells of a 200 column, 0.5 degree grid; line items play annual
values with two variables; events play daily steps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def cells(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("p_partkey")
    row = F.floor(key / 200)
    return table(spark, d, "part").select(
        key.alias("cell"),
        (key % 200).cast("int").alias("ix"),
        row.cast("int").alias("iy"),
        ((key % 200).cast("double") / 2 - 49.75).alias("lon"),
        (row.cast("double") / 2 - 24.75).alias("lat"),
        (key % 27).cast("int").alias("country_id"),
        F.col("p_size").cast("double").alias("weight"),
    )


def quantity(spark: SparkSession, d: str) -> DataFrame:
    return (
        table(spark, d, "lineitem")
        .groupBy(F.lit("quantity").alias("variable"), F.col("l_partkey").alias("cell"),
                 (F.col("l_linenumber") - 1).cast("int").alias("band"),
                 F.year("l_shipdate").alias("year"))
        .agg(F.sum("l_quantity").alias("value"))
    )


def price(spark: SparkSession, d: str) -> DataFrame:
    return (
        table(spark, d, "lineitem")
        .groupBy(F.lit("price").alias("variable"), F.col("l_partkey").alias("cell"),
                 F.lit(0).alias("band"), F.year("l_shipdate").alias("year"))
        .agg(F.round(F.sum("l_extendedprice"), 2).alias("value"))
    )


def grid_values(spark: SparkSession, d: str) -> DataFrame:
    return quantity(spark, d).unionByName(price(spark, d))


def flags(spark: SparkSession, d: str) -> DataFrame:
    system = F.when(F.col("l_linestatus") == "F", 0).otherwise(1)
    crop = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2)
    return (
        table(spark, d, "lineitem")
        .groupBy(F.lit("flags").alias("variable"), F.col("l_partkey").alias("cell"),
                 (system * 3 + crop).cast("int").alias("band"), F.year("l_shipdate").alias("year"))
        .agg(F.count(F.lit(1)).alias("value"))
    )


def crops(spark: SparkSession, d: str) -> DataFrame:
    """Return flags as crop list, in the order of their band."""
    pos = F.when(F.col("crop") == "A", 0).when(F.col("crop") == "N", 1).otherwise(2)
    return (
        table(spark, d, "lineitem").select(F.col("l_returnflag").alias("crop")).distinct()
        .select(pos.alias("pos"), "crop")
    )


def bands(spark: SparkSession, d: str) -> DataFrame:
    """Band axis of both variables."""
    lines = table(spark, d, "lineitem").select("l_linenumber").distinct().select(
        F.lit("quantity").alias("variable"), (F.col("l_linenumber") - 1).cast("int").alias("band"),
        F.concat(F.lit("line "), F.col("l_linenumber").cast("string")).alias("band_label"))
    price = spark.range(1).select(
        F.lit("price").alias("variable"), F.lit(0).alias("band"), F.lit("all").alias("band_label"))
    return lines.unionByName(price)


def countries(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "nation").select(
        F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"),
        F.concat(F.lit("N"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("code"),
        F.col("n_regionkey").alias("region_id"))


def raster(spark: SparkSession, d: str) -> DataFrame:
    """2 degree source grid."""
    bx, by = F.floor(F.col("ix") / 4), F.floor(F.col("iy") / 4)
    return cells(spark, d).select(
        (bx.cast("double") * 2 - 49.75).alias("lon"), (by.cast("double") * 2 - 24.75).alias("lat"),
        (bx * 1000 + by).cast("int").alias("rvalue")).distinct()


def links(spark: SparkSession, d: str) -> DataFrame:
    return cells(spark, d).select(
        "cell", F.when(F.col("ix") < 199, F.col("cell") + 1).alias("to_cell"))


def event_band():
    c = F.col("event_type")
    return (F.when(c == "click", 0).when(c == "error", 1).when(c == "purchase", 2)
            .when(c == "signup", 3).otherwise(4))


def event_rows(events: DataFrame, days: int = 1) -> DataFrame:
    """One value row per event: the step key is the day (or week) of the month."""
    return events.select(
        F.lit("events").alias("variable"), F.col("user_id").alias("cell"),
        event_band().cast("int").alias("band"),
        F.ceil(F.day("ts") / days).cast("int").alias("year"),
        F.col("event_id").cast("bigint").alias("step"), "value")


def variables(spark: SparkSession, d: str) -> DataFrame:
    """Metadata of the two variables; their common period is that of the line items."""
    def described(name, long_name, unit, datatype, scalar, nbands, band_names):
        return F.struct(
            F.lit(name).alias("variable"), F.lit(long_name).alias("long_name"),
            F.lit(unit).alias("unit"), F.lit(datatype).alias("datatype"),
            F.lit(scalar).alias("scalar"), F.lit(nbands).alias("nbands"),
            F.array(*[F.lit(b) for b in band_names]).alias("band_names"))

    both = F.array(
        described("quantity", "quantity sold", "1", "short", 0.5, 7,
                  [f"line {i}" for i in range(1, 8)]),
        described("price", "price paid", "money", "float", 2.0, 1, ["all"]))
    period = table(spark, d, "lineitem").agg(
        F.year(F.min("l_shipdate")).alias("firstyear"), F.year(F.max("l_shipdate")).alias("lastyear"))
    return period.withColumn("v", F.explode(both)).select(
        "v.*", "firstyear", "lastyear",
        F.lit("line items").alias("source"), F.lit("driver tables").alias("history"),
        F.lit(0.5).alias("cellsize_lon"), F.lit(0.5).alias("cellsize_lat"))
