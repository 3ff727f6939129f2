"""The tables at hand in the roles of a measurement matrix: which columns stand for cells, features and labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spindrel.runtime import table


def counts(spark: SparkSession, d: str) -> DataFrame:
    """``x(cell_id, gene_id, value)``: quantity of each brand in each order."""
    brand = table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("gene_id"))
    return (
        table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_quantity").join(brand, "l_partkey")
        .groupBy(F.col("l_orderkey").alias("cell_id"), "gene_id").agg(F.sum("l_quantity").alias("value"))
    )


def cells(spark: SparkSession, d: str) -> DataFrame:
    """``obs``: orders with their customer's segment."""
    customer = table(spark, d, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("sample"), F.col("c_nationkey").alias("nation")
    )
    return table(spark, d, "orders").join(customer, "o_custkey").select(
        F.col("o_orderkey").alias("cell_id"), F.col("o_orderpriority").alias("cluster"), "sample", "nation",
        F.year("o_orderdate").alias("stage"), F.col("o_orderstatus").alias("condition"), F.col("o_totalprice").alias("price"),
    )


SQL = """with x as (select l_orderkey cell_id, p_brand gene_id, sum(l_quantity) "value"
  from lineitem join part on l_partkey = p_partkey group by all),
obs as (select o_orderkey cell_id, o_orderpriority "cluster", c_mktsegment sample, c_nationkey nation,
  year(o_orderdate)::int stage, o_orderstatus condition, o_totalprice price from orders join customer on o_custkey = c_custkey),
"""
