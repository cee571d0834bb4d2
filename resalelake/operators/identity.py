"""Sellers, and the customers who are probably the same people."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from resalelake.functions import columns as C
from resalelake.functions import rules as R
from resalelake.operators.components import components
from resalelake.operators.dedup import best_row
from resalelake.operators.joins import match_or_keep


def consignors(customers: DataFrame) -> DataFrame:
    """Latest snapshot of every customer that carries the consignor tag."""
    return best_row(customers.where(C.has_tag("customer_tags")), ["customer_id"], latest=["date"])


def seller_rollup(supplied: DataFrame) -> DataFrame:
    """Items per seller, contract, store and channel."""

    def items(contract: str):
        return F.count_if(F.col("contract_type") == contract)

    return supplied.groupBy("seller_name", "contract_type", "store_location", "channel").agg(
        F.count(F.lit(1)).alias("total_items_supplied"),
        items(R.CONSIGNMENT).alias("consignment_items"),
        items(R.BUYOUT).alias("buyout_items"),
        items(R.STORE_CREDIT).alias("store_credit_items"),
        F.min("buy_date").alias("first_buy_date"),
        F.max("buy_date").alias("last_buy_date"),
    )


def match_by_name(sellers: DataFrame, buyers: DataFrame) -> DataFrame:
    """Sellers with every buyer of the same name; sellers without one are kept.

    Namesakes fan out on purpose. A seller or buyer without a usable name matches nobody.
    """
    left = sellers.withColumn("_name", C.name_key(F.col("seller_name")))
    right = buyers.withColumn("_name", F.lower(C.full_name("customer_first_name", "customer_last_name")))
    return match_or_keep(left, right, "_name", ["customer_id"]).drop("_name")


def match_by_id(sellers: DataFrame, buyers: DataFrame, id_column: str = "seller_customer_id") -> DataFrame:
    """The exact path, for sellers whose customer id was recorded at intake."""
    return sellers.join(
        buyers.withColumnRenamed("customer_id", "_id"), F.col(id_column) == F.col("_id"), "left"
    ).withColumnRenamed("_id", "customer_id")


def people(records: DataFrame, keys: Mapping[str, Column]) -> DataFrame:
    """key, person_id: who each key belongs to, when records that share any key are of one person.

    ``keys`` names the kinds of key and how each is read from a record; null and blank values are no key. A person is named by the
    smallest of its keys, ``kind:value``, so list the surest kind under the name that sorts first. Records are reduced to
    distinct pairs of keys first, so a key that many records share costs what its distinct partners cost.
    """
    parts = [F.when(C.blank_to_null(value).isNotNull(), F.concat(F.lit(f"{kind}:"), value)) for kind, value in keys.items()]
    found = records.select(F.array_compact(F.array(*parts)).alias("keys")).where("size(keys) > 0")
    # The first key of a record is tied to itself and to the others.
    edges = found.select(F.element_at("keys", 1).alias("a"), F.explode("keys").alias("b")).distinct()
    return components(edges, "a", "b").select(F.col("node").alias("key"), F.col("component").alias("person_id"))
