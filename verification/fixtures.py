"""Invoices and payments in the raw text format, derived from the given order tables.

Every order is an invoice, every line item a payment of its order's invoice.
See FIXTURES.md for the mapping.
"""

from __future__ import annotations

from datetime import date
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mensario import fixed_values as fv
from mensario.functions.period import Period
from mensario.schemas import MONEY

# The tables' dates end in 2001; a first of month makes the windows whole months.
PERIOD = Period(date(2001, 1, 1))
MONTH_BEFORE = Period(date(2000, 12, 1))
DT_PROC = "20010105080000"
# The stamp of a second run.
AGAIN = "20010106080000"

# Files of a delivery at least, and rows of a file from which there are more.
PARTS, PART_ROWS = 8, 1_000_000

# One customer, for the point lookup.
CUSTOMER = 345


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _iso(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def raw_faturas(spark: SparkSession, sf_dir: str) -> DataFrame:
    issued = F.to_date("o_orderdate")
    amount = F.col("o_totalprice").cast(MONEY)
    return _table(spark, sf_dir, "orders").select(
        F.concat(F.lit("FAT-"), "o_orderkey").alias("id_fatura"),
        F.col("o_custkey").cast("string").alias("id_cliente"),
        _iso(issued).alias("data_emissao"),
        _iso(F.date_add(issued, 10)).alias("data_vencimento"),
        amount.cast("string").alias("valor_fatura"),
        # A tenth of the amount, whole cents.
        (F.floor(amount * 10) / 100).cast(MONEY).cast("string").alias("valor_pagamento_minimo"),
    )


def _items_with_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    items = _table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice"
    )
    return items.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


def _payment_number() -> Column:
    """Not unique: the tables repeat pairs of order and line number."""
    return F.col("l_orderkey") * 10 + F.col("l_linenumber")


def _payment_day() -> Column:
    """From three days before the invoice falls due to three days after."""
    return F.date_add(F.to_date("o_orderdate"), (F.col("l_partkey") % 7 + 7).cast("int"))


def _payment_amount() -> Column:
    in_full = F.col("l_suppkey") % 3 == 0
    return F.when(in_full, F.col("o_totalprice")).otherwise(F.col("l_extendedprice")).cast(MONEY)


def raw_pagamentos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _items_with_order(spark, sf_dir).select(
        F.concat(F.lit("PAG-FAT-"), _payment_number()).alias("id_pagamento"),
        F.concat(F.lit("FAT-"), "l_orderkey").alias("id_fatura"),
        F.col("o_custkey").cast("string").alias("id_cliente"),
        _iso(_payment_day()).alias("data_pagamento"),
        _payment_amount().cast("string").alias("valor_pagamento"),
    )


def raw_of(spark: SparkSession, sf_dir: str, subject: str) -> DataFrame:
    maker = {fv.SUBJECT_FATURAS: raw_faturas, fv.SUBJECT_PAGAMENTOS: raw_pagamentos}[subject]
    return maker(spark, sf_dir)


def rows_of(spark: SparkSession, sf_dir: str, subject: str) -> int:
    """How many rows the subject's table has, by its footers; of payments those of no order are among them."""
    return _table(spark, sf_dir, {fv.SUBJECT_FATURAS: "orders", fv.SUBJECT_PAGAMENTOS: "lineitem"}[subject]).count()


def parts_of(spark: SparkSession, sf_dir: str, subject: str) -> int:
    """Files of a delivery: a task writes one, so they grow with the rows."""
    return max(PARTS, ceil(rows_of(spark, sf_dir, subject) / PART_ROWS))


def deliver(spark: SparkSession, rows: DataFrame, staging: str, folder: str, name: str, parts: int = PARTS) -> None:
    """``rows`` as ``parts`` CSV files of always the same names, each in place of an earlier delivery's.

    Every part is written by a task of its own, which part a row is in follows from its invoice, and the driver only renames.
    """
    rows.repartition(parts, "id_fatura").write.option("header", True).csv(staging)
    path = spark._jvm.org.apache.hadoop.fs.Path
    target = path(folder)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(target)
    for earlier in fs.globStatus(path(f"{folder}/{name}-*.csv")) or []:
        fs.delete(earlier.getPath(), False)
    for part in fs.globStatus(path(f"{staging}/part-*")):
        number = part.getPath().getName().split("-")[1]
        fs.rename(part.getPath(), path(f"{folder}/{name}-{number}.csv"))


def faturas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trusted invoices the raw text types to, straight from the typed tables."""
    issued = F.to_date("o_orderdate")
    amount = F.col("o_totalprice").cast(MONEY)
    return _table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id_fatura"),
        F.col("o_custkey").alias("id_cliente"),
        F.lit(DT_PROC).alias("dt_proc"),
        F.date_format(issued, "yyyyMM").alias("ref"),
        issued.alias("dt_emissao"),
        F.date_add(issued, 10).alias("dt_vencimento"),
        amount.alias("vlr_fatura"),
        (F.floor(amount * 10) / 100).cast(MONEY).alias("vlr_pagto_min"),
    )


def pagamentos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trusted payments the raw text types to, straight from the typed tables."""
    paid = _payment_day()
    return _items_with_order(spark, sf_dir).select(
        _payment_number().alias("id_pagamento"),
        F.col("l_orderkey").alias("id_fatura"),
        F.col("o_custkey").alias("id_cliente"),
        F.lit(DT_PROC).alias("dt_proc"),
        F.date_format(paid, "yyyyMM").alias("ref"),
        paid.alias("dt_pagamento"),
        _payment_amount().alias("vlr_pagamento"),
    )
