"""TESTDATA -> raw beneficiary record (32 text columns).

The annual beneficiary file is not available, so each customer becomes one
beneficiary, with fields derived by fixed rules from the customer row and
from per-customer order aggregates. Values are written as text so the
bronze casts really parse them.

Plan shape: ``orders`` is aggregated by ``o_custkey`` (partial aggregation
before the shuffle, so a customer holding a third of all orders costs one
row per map task), then joined to ``customer`` on the key - a shuffle join
of two customer-grain inputs, never a broadcast of something that grows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import RAW_COLUMNS
from .testdata import read_table

# Fixed rule parameters of the adapter.
BIRTH_ORIGIN = "1908-01-01"
BIRTH_MULTIPLIER = 7919
BIRTH_SPAN_DAYS = 20000
DEATH_MODULUS = 61
DEATH_TEXT = "20080615"
UNKNOWN_STATE_MODULUS = 97
UNKNOWN_STATE_CODE = "40"
NULL_FLAG_MODULUS = 89
ESRD_MODULUS = 50
RACE_CODES = ["1", "2", "3", "5"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
HIGH_PRICE = 400000
LOW_PRICE = 20000
STATUSES = ["F", "O", "P"]
SEGMENT_FLAGS = ["BUILDING", "MACHINERY"]


def _money_text(c: Column) -> Column:
    return F.coalesce(c, F.lit(0)).cast("decimal(18,2)").cast("string")


def _flag_text(present: Column) -> Column:
    return F.when(F.coalesce(present, F.lit(False)), F.lit("1")).otherwise(F.lit("2"))


def order_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per ordering customer: any-of flags and exact sums by status."""
    orders = read_table(spark, sf_dir, "orders", ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"])
    price = F.col("o_totalprice")
    price_dec = price.cast("decimal(18,2)")
    aggs = [
        F.bool_or((F.col("o_orderpriority") == p) & (price > HIGH_PRICE)).alias(f"hi_{i}")
        for i, p in enumerate(PRIORITIES)
    ]
    aggs += [F.bool_or((F.col("o_orderstatus") == s) & (price < LOW_PRICE)).alias(f"lo_{s}") for s in STATUSES]
    aggs += [F.sum(F.when(F.col("o_orderstatus") == s, price_dec)).alias(f"sum_{s}") for s in STATUSES]
    return orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(*aggs)


def member_raw(spark: SparkSession, sf_dir: str, padded_state: bool = True) -> DataFrame:
    """The 32-column raw beneficiary frame, all strings, one row per customer."""
    customer = read_table(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"])
    df = customer.join(order_features(spark, sf_dir), "c_custkey", "left")
    key = F.col("c_custkey")
    birth = F.date_add(F.lit(BIRTH_ORIGIN).cast("date"), ((key * BIRTH_MULTIPLIER) % BIRTH_SPAN_DAYS).cast("int"))
    state_num = (F.col("c_nationkey") + 1).cast("string")
    state = F.lpad(state_num, 2, "0") if padded_state else state_num
    race = F.element_at(F.array(*[F.lit(r) for r in RACE_CODES]), (key % 4).cast("int") + 1)
    flags = [_flag_text(F.col(f"hi_{i}")) for i in range(len(PRIORITIES))]
    flags += [_flag_text(F.col(f"lo_{s}")) for s in STATUSES]
    flags += [_flag_text(F.col("c_mktsegment") == seg) for seg in SEGMENT_FLAGS]
    flags.append(F.when(key % NULL_FLAG_MODULUS == 0, F.lit(None).cast("string")).otherwise(_flag_text(F.col("c_acctbal") < 0)))
    zero = F.lit("0.00")
    values = [
        F.col("c_name"),
        F.date_format(birth, "yyyyMMdd"),
        F.when(key % DEATH_MODULUS == 0, F.lit(DEATH_TEXT)),
        (key % 2 + 1).cast("string"),
        race,
        F.when(key % ESRD_MODULUS == 0, F.lit("Y")).otherwise(F.lit("0")),
        F.when(key % UNKNOWN_STATE_MODULUS == 0, F.lit(UNKNOWN_STATE_CODE)).otherwise(state),
        (key % 1000).cast("string"),
        F.lit("12"),
        (key % 13).cast("string"),
        F.lit("0"),
        (key % 13).cast("string"),
        *flags,
        _money_text(F.col("c_acctbal").cast("decimal(18,2)")),  # MEDREIMB_IP
        zero,  # BENRES_IP
        zero,  # PPPYMT_IP
        _money_text(F.col("sum_F")),  # MEDREIMB_OP
        _money_text(F.col("sum_P")),  # BENRES_OP
        zero,  # PPPYMT_OP
        _money_text(F.col("sum_O")),  # MEDREIMB_CAR
        zero,  # BENRES_CAR
        zero,  # PPPYMT_CAR
    ]
    return df.select(*[v.cast("string").alias(name) for v, name in zip(values, RAW_COLUMNS, strict=True)])
