"""Adapters that give the star-schema test tables the shape of a watch log and a catalogue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Region of a supplier -> role of the person it stands for.
REGION_ROLES = {
    "AMERICA": "actor",
    "EUROPE": "director",
    "ASIA": "producer",
    "AFRICA": "writer",
    "MIDDLE EAST": "composer",
}
N_GENRES = 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Watch log from the event stream: 100 items, 30 days."""
    return table(spark, sf_dir, "events").select(
        "user_id",
        F.get_json_object("props", "$.k").cast("bigint").alias("item_id"),
        "ts",
        F.col("value").alias("duration"),
    )


def purchases_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Watch log from order lines: many items, several years, tied times."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("item_id"),
        F.col("o_orderdate").alias("ts"),
        F.col("l_quantity").alias("duration"),
    )


def _id_list(ids: str) -> Column:
    return F.concat(F.lit("["), F.array_join(F.array_sort(ids), ", "), F.lit("]"))


def items(spark: SparkSession, sf_dir: str, people: bool = False, texts: bool = False) -> DataFrame:
    """Catalogue from the part table.

    ``people`` adds staff, countries and the two dates (read from the order lines), ``texts`` the
    description; callers that need neither do not pay for those joins.
    """
    part = table(spark, sf_dir, "part")
    brand = F.regexp_extract("p_brand", "([0-9]+)", 1).cast("int")
    genres = F.concat(F.lit("["), F.col("p_size") % 12, F.lit(", "), 12 + brand % 8, F.lit("]"))
    out = part.select(
        F.col("p_partkey").alias("item_id"),
        F.col("p_name").alias("name"),
        F.when(F.col("p_partkey") % 23 == 0, "[]").otherwise(genres).alias("genres"),
    )
    if people:
        lines = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_shipdate")
        suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
        made = (
            lines.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
            .groupBy(F.col("l_partkey").alias("item_id"))
            .agg(
                F.collect_set("l_suppkey").alias("staff"),
                F.collect_set("s_nationkey").alias("countries"),
                F.min("l_shipdate").alias("first"),
            )
        )
        out = out.join(made, "item_id", "left").select(
            *out.columns,
            F.when((F.col("item_id") % 19 == 0) | F.col("staff").isNull(), "[]")
            .otherwise(_id_list("staff"))
            .alias("staff"),
            F.when(F.col("countries").isNull(), "[]").otherwise(_id_list("countries")).alias("countries"),
            F.when(F.col("item_id") % 17 == 0, "unknown")
            .otherwise(F.date_format("first", "yyyy-MM-dd HH:mm:ss"))
            .alias("date_publication"),
            F.date_format("first", "yyyy-MM-dd").alias("year"),
        )
    if texts:
        documents = table(spark, sf_dir, "documents").select(
            F.col("doc_id").alias("item_id"), F.col("text").alias("description")
        )
        out = out.join(documents, "item_id", "left")
    return out


def catalogue_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalogue that lacks some of the purchased items: every part, under twice its number."""
    return items(spark, sf_dir).select((F.col("item_id") * 2).alias("item_id"))


def staff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """People table: suppliers, with the role their region stands for."""
    supplier = table(spark, sf_dir, "supplier")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    role = None
    for name, value in REGION_ROLES.items():
        hit = F.col("r_name") == name
        role = F.when(hit, value) if role is None else role.when(hit, value)
    return (
        supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("s_suppkey").alias("id"), role.alias("role"))
    )


def factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in for item factors: the embedding table."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("item_id"), F.col("embedding").cast("array<double>").alias("factor")
    )


# Layouts of ``dates_as_text``, by (order + line) modulo their number.
SHIP_LAYOUTS = ["yyyy-MM-dd HH:mm:ss", "dd.MM.yyyy", "MM/dd/yyyy", "dd-MM-yyyy HH:mm", "yyyy/M/d", "MMM d, yyyy", "d/M/yyyy"]


def dates_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(order_id, line, text): the ship dates, written in several layouts as an export of many sources has them."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    written = F.lit(None).cast("string")
    for k, layout in enumerate(SHIP_LAYOUTS):
        chosen = F.pmod(F.col("l_orderkey") + F.col("l_linenumber"), F.lit(len(SHIP_LAYOUTS))) == k
        written = F.when(chosen, F.date_format("l_shipdate", layout)).otherwise(written)
    return lines.select(F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line"), written.alias("text"))
