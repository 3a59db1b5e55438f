"""The star-schema tables as event and document frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def join_events(lineitem: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items (batch or stream) as purchase events.

    The joins are plain equi-joins: Catalyst broadcasts a side it knows to be
    small and shuffles on the key otherwise.
    """
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = table(spark, sf_dir, "region")
    return (
        lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    )


def customer_events(spark: SparkSession, sf_dir: str, lineitem: DataFrame | None = None) -> DataFrame:
    """One purchase event per line item; ``date`` is null throughout."""
    source = lineitem if lineitem is not None else table(spark, sf_dir, "lineitem")
    joined = join_events(source, spark, sf_dir)
    return joined.select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("event_id"),
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("customer_id"),
        F.lit("purchase").alias("event_type"),
        F.col("r_name").alias("region"),
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"),
        (F.col("l_linenumber") * 60).alias("session_duration_sec"),
        F.col("l_shipdate").cast("timestamp").alias("timestamp"),
        F.lit(None).cast("string").alias("date"),
    )


def flawed_events(spark: SparkSession, sf_dir: str, lineitem: DataFrame | None = None) -> DataFrame:
    """Line items as events with gaps and bad amounts, decided by their own values.

    The generated tables hold no nulls or negatives, so the quality operators
    get them from here: some ids, customers and timestamps are missing, some
    amounts have their sign flipped, and some dates are missing.
    """
    line = lineitem if lineitem is not None else table(spark, sf_dir, "lineitem")
    number, tax = F.col("l_linenumber"), F.col("l_tax")
    order_id = F.col("l_orderkey").cast("string")
    event_id = F.concat(order_id, F.lit("-"), number.cast("string"))
    return line.select(
        F.when((tax == 0.08) & (number == 1), None).otherwise(event_id).alias("event_id"),
        F.when((tax == 0.07) & (number == 2), None)
        .otherwise(F.concat(F.lit("S"), F.col("l_suppkey").cast("string")))
        .alias("customer_id"),
        F.when(F.col("l_returnflag") == "R", "return").otherwise("purchase").alias("event_type"),
        F.when(tax == 0.0, None).otherwise(F.col("l_linestatus")).alias("region"),
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("product_id"),
        F.when(F.col("l_quantity") == 50, -50).otherwise(F.col("l_quantity").cast("int")).alias("quantity"),
        F.when(F.col("l_discount") == 0.1, -F.col("l_extendedprice"))
        .when(F.col("l_discount") == 0.09, None)
        .otherwise(F.col("l_extendedprice"))
        .alias("revenue"),
        (number * 60).alias("session_duration_sec"),
        F.when((tax == 0.06) & (number == 3), None).otherwise(F.col("l_shipdate").cast("timestamp")).alias("timestamp"),
        F.when(number == 4, None).otherwise(F.date_format("l_shipdate", "yyyy-MM-dd")).alias("date"),
    )


def contract_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One short contract per order, for the extraction operators.

    The invented prose has no obligations, amounts or calendar dates, so the
    text is put together from order values.
    """
    orders = table(spark, sf_dir, "orders")
    amount = F.floor("o_totalprice").cast("string")
    return orders.select(
        F.col("o_orderkey").alias("doc_id"),
        F.concat(
            F.lit("Buyer "),
            F.col("o_custkey").cast("string"),
            F.when(F.col("o_orderstatus") == "F", " shall pay Northwind Traders Inc. $")
            .when(F.col("o_orderstatus") == "O", " may owe Harbor Freight Lines Ltd. $")
            .otherwise(" agrees to send Acme Corporation $"),
            amount,
            F.lit(" by "),
            F.date_format("o_orderdate", "yyyy-MM-dd"),
            F.lit(". "),
            F.when(F.col("o_orderpriority") == "1-URGENT", "The seller must deliver within 30 days! ").otherwise(
                "Delivery was on January 31, 2025. "
            ),
            F.lit("Questions go to desk"),
            F.col("o_custkey").cast("string"),
            F.lit("@example.com or https://example.com/o/"),
            F.col("o_orderkey").cast("string"),
        ).alias("text"),
    )


def named_contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One contract per order that names its customer, country, product, supplier, law and sometimes an event."""
    orders, customer, nation, part = (table(spark, sf_dir, n) for n in ("orders", "customer", "nation", "part"))
    rows = (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(part.select(F.col("p_partkey").alias("o_custkey"), "p_name"), "o_custkey", "left")
    )
    return rows.select(
        F.col("o_orderkey").alias("doc_id"),
        F.concat(
            F.col("c_name"),
            F.lit(" of "),
            F.col("n_name"),
            F.when(F.col("o_orderstatus") == "F", " shall buy the ").otherwise(" bought one "),
            F.coalesce("p_name", F.lit("parcel")),
            F.lit(" from Northwind Traders Inc. for $"),
            F.floor("o_totalprice").cast("string"),
            F.lit(" by "),
            F.date_format("o_orderdate", "yyyy-MM-dd"),
            F.lit(" under the  Fair Trade Act of 2001. "),
            F.when(F.col("o_orderpriority") == "1-URGENT", "The parties must meet at the Spring\tFair! ").otherwise("Été is over. "),
            F.lit("Write to desk"),
            F.col("o_custkey").cast("string"),
            F.lit("@example.com."),
        ).alias("text"),
    )


def named_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A (phrase, label) list for :func:`named_contracts`; some phrases overlap others and the patterns' matches."""
    fixed = [("Northwind Traders", "ORG"), ("Fair Trade Act", "LAW"), ("Trade Act of 2001", "LAW"), ("Spring Fair", "EVENT"), ("fair", "EVENT")]
    out = spark.createDataFrame(fixed, "phrase string, label string")
    for name, column, label in (("customer", "c_name", "PERSON"), ("nation", "n_name", "GPE"), ("part", "p_name", "PRODUCT")):
        out = out.unionByName(table(spark, sf_dir, name).select(F.col(column).alias("phrase"), F.lit(label).alias("label")))
    return out
