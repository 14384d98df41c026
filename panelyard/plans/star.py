"""The item feed expressed over the star-schema test tables.

``lineitem`` with its dimensions plays the raw feed: its (order, line) ids are
naturally repeated, its discounts of zero play items never awarded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelyard.operators import items
from panelyard.session import staged
from panelyard.spec import PanelSpec

# Sums are taken as decimals of the four places that price x discount has.
SPEC = PanelSpec(top_classes=20, status="F", ceiling=100_000.0, sum_scale=4)

# The order in which copies of an item count as first.
FEED_ORDER = ["l_shipdate", "l_partkey", "l_suppkey"]


_SCHEMAS: dict = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the test tables. Its footer is looked at once per application, so
    that queries do not each start with a job per table to find out its columns."""
    key = (spark.conf.get("spark.app.id", ""), folder, name)
    path = f"{folder}/{name}.parquet"
    if key not in _SCHEMAS:
        _SCHEMAS[key] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[key]).parquet(path)


def lines_first(spark: SparkSession, folder: str) -> DataFrame:
    """The first copy of every order line."""
    return items.first_per_key(table(spark, folder, "lineitem"),
                               ["l_orderkey", "l_linenumber"], FEED_ORDER)


def with_dimensions(lines: DataFrame, spark: SparkSession, folder: str) -> DataFrame:
    """Order lines with the columns of their order, part and supplier.

    Join strategies are left to the optimizer: dimensions below its size limit
    are broadcast, larger ones shuffled, hot keys split at run time.
    """
    class_code = F.when(F.col("p_brand") != "Brand#1", F.concat(F.col("p_size").cast("string"), F.lit(".0")))
    parts = table(spark, folder, "part").withColumn("p_class", class_code)
    return (lines
            .join(table(spark, folder, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
            .join(parts, F.col("l_partkey") == F.col("p_partkey"))
            .join(table(spark, folder, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")))


def with_roles(lines: DataFrame, spark: SparkSession, folder: str) -> DataFrame:
    """Joins the dimensions and names the columns by their role."""
    return by_role(with_dimensions(lines, spark, folder))


# What ``by_role`` reads of the joined tables.
ROLE_INPUTS = ["l_orderkey", "l_linenumber", "l_shipdate", "l_linestatus", "p_class", "o_orderstatus", "l_quantity",
               "p_retailprice", "l_extendedprice", "l_discount", "s_name", "o_custkey", "p_type", "p_name"]


def by_role(joined: DataFrame, *keep: str) -> DataFrame:
    """Columns of the joined tables by their role, behind those to ``keep``; what is worked out here is
    wider than its inputs."""
    awarded = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    roles = SPEC.columns
    return joined.select(
        *keep,
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias(roles.item_id),
        F.col("l_shipdate").alias(roles.included_at),
        F.col("l_linestatus").alias(roles.kind),
        F.col("p_class").alias(roles.class_code),
        F.col("o_orderstatus").alias(roles.status),
        F.col("l_quantity").alias(roles.quantity),
        F.col("p_retailprice").alias(roles.unit_estimate),
        F.col("l_extendedprice").alias(roles.estimated),
        F.when(F.col("l_discount") != 0, awarded).alias(roles.awarded),
        F.col("s_name").alias(roles.supplier),
        F.lpad(F.col("o_custkey").cast("string"), 14, "0").alias(roles.organ),
        F.col("p_type").alias(roles.category),
        F.col("p_name").alias(roles.description),
    )


def raw_feed(spark: SparkSession, folder: str) -> DataFrame:
    """The feed with its repeated items, as rankings see it."""
    return with_roles(table(spark, folder, "lineitem"), spark, folder)


def unique_items(spark: SparkSession, folder: str) -> DataFrame:
    """Typed items, one row per id, any status."""
    feed = with_roles(lines_first(spark, folder), spark, folder)
    return items.typed(feed, SPEC)


def typed_items(spark: SparkSession, folder: str) -> DataFrame:
    """Typed items in the wanted status."""
    return items.with_status(unique_items(spark, folder), SPEC)


def kept_layer(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """The kept items as a table, since the panel reads them several times."""
    kept, _ = items.split_suspects(typed_items(spark, folder), SPEC)
    return staged(kept.select(*columns) if columns else kept, "kept")
