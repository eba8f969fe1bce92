"""The driver's tables recast as issues, modules, repository events and change logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def issues(spark: SparkSession, folder: str, parts: int = 500) -> DataFrame:
    """Order lines as issues: order date created, ship date of finished lines resolved."""
    lines, orders = table(spark, folder, "lineitem"), table(spark, folder, "orders")
    flag, priority = F.col("l_returnflag"), F.col("o_orderpriority")
    kind = (
        F.when(flag == "R", "Bug")
        .when(flag == "A", "Story")
        .when(priority.isin("1-URGENT", "2-HIGH"), "Sub-task")
        .when(priority == "3-MEDIUM", "Enhancement")
        .otherwise("Wish")
    )
    order = F.col("l_orderkey")
    return lines.join(orders, order == F.col("o_orderkey")).select(
        F.concat(
            F.lit("C"), (order % parts).cast("string"), F.lit("-"), order.cast("string"),
            F.lit("-"), F.col("l_linenumber").cast("string"),
        ).alias("key"),
        F.col("o_orderdate").alias("created"),
        F.when(F.col("l_linestatus") == "F", F.col("l_shipdate")).alias("resolutiondate"),
        kind.alias("issuetype_name"),
        F.col("l_linestatus").alias("status"),
    )


def modules(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part")
    key, size = F.col("p_partkey"), F.col("p_size")
    return part.select(
        F.concat(F.lit("c"), (key % 500).cast("string"), F.lit("-1."), (key % 7).cast("string")).alias("basename"),
        size.cast("double").alias("wmc"),
        (size % 7).cast("double").alias("dit"),
        (key % 30).cast("double").alias("cbo"),
        (F.col("p_retailprice") / 100).alias("rfc"),
        F.col("p_retailprice").alias("lcom"),
        (size * 20).cast("double").alias("loc"),
        F.when(key % 50 != 0, F.greatest(size % 4 - 1, F.lit(0))).alias("bug"),
    )


def repository_events(spark: SparkSession, folder: str) -> DataFrame:
    """Nested events, as they come out of the JSON reader."""
    orders = table(spark, folder, "orders")
    key, priority = F.col("o_orderkey"), F.col("o_orderpriority")
    kind = (
        F.when(F.col("o_orderstatus") == "F", "PushEvent")
        .when(F.col("o_orderstatus") == "O", "PullRequestEvent")
        .otherwise("IssuesEvent")
    )
    owner = F.when(F.col("o_custkey") % 3 == 0, "apache/").otherwise("other/")
    ref = (
        F.when(priority.isin("1-URGENT", "2-HIGH"), "refs/heads/main")
        .when(priority == "3-MEDIUM", "refs/heads/master")
        .otherwise("refs/heads/dev")
    )
    merged = F.when(key % 4 == 1, False).when(key % 4 != 0, True)
    return orders.select(
        key.cast("string").alias("id"),
        kind.alias("type"),
        F.struct(F.concat(owner, F.lit("c"), F.col("o_custkey").cast("string")).alias("name")).alias("repo"),
        F.struct(F.concat(F.lit("u"), (key % 97).cast("string")).alias("login")).alias("actor"),
        F.struct(
            ref.alias("ref"),
            F.when(priority == "5-LOW", "opened").otherwise("closed").alias("action"),
            F.struct(merged.alias("merged")).alias("pull_request"),
        ).alias("payload"),
        F.date_format(F.col("o_orderdate").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("created_at"),
    )


def change_log(spark: SparkSession, folder: str) -> DataFrame:
    """One change log per order line: the status it reached and one other field."""
    lines = table(spark, folder, "lineitem")
    status = F.when(F.col("l_linestatus") == "F", "Closed").otherwise("Open")
    item = lambda field, to: F.struct(F.lit(field).alias("field"), to.alias("to"))
    return lines.select(
        F.concat("l_orderkey", F.lit("-"), "l_linenumber").alias("key"),
        F.array(item("status", status), item("priority", F.col("l_returnflag"))).alias("items"),
    )
