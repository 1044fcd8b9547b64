"""What a person looks at before trusting a run: months, bounds, duplicates, samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Row
from pyspark.sql import functions as F

from mensario.functions.period import Period
from mensario.operators.joins import apart_from_hot


def in_period(df: DataFrame, period: Period) -> DataFrame:
    """Rows of the period's months; a NULL month is outside."""
    return df.where(period.covers("ref"))


def months_present(df: DataFrame) -> DataFrame:
    return df.select("ref").distinct().orderBy("ref")


def bounds(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.max(col).alias(f"max_{col}"), F.min(col).alias(f"min_{col}"))


def _counted(df: DataFrame) -> DataFrame:
    return df.groupBy("id_fatura", "id_cliente").agg(F.count(F.lit(1)).alias("qtd"))


def key_order() -> list[Column]:
    """Largest customer number first. ``id_fatura`` breaks ties so that the sort can split
    one customer's invoices over several range partitions."""
    return [F.col("id_cliente").desc(), F.col("id_fatura")]


def key_counts(df: DataFrame) -> DataFrame:
    """Rows per invoice and customer. Reports only, removes nothing."""
    return _counted(df).orderBy(*key_order())


def repeats(df: DataFrame) -> DataFrame:
    """The keys that occur more than once, in no order."""
    return _counted(df).where(F.col("qtd") > 1)


def repeats_stored(df: DataFrame, hot: str | None = None) -> DataFrame:
    """As ``repeats``, of a table bucketed by the keys: counted where the rows lie, see ``join_stored``."""
    if hot is None:
        return repeats(df)
    (rest,), (apart,) = apart_from_hot(hot, df)
    return repeats(rest).unionByName(repeats(apart))


def repeated_keys(df: DataFrame) -> DataFrame:
    """Only the keys of ``key_counts`` that occur more than once; the others, nearly all, are not sorted."""
    return repeats(df).orderBy(*key_order())


def report(df: DataFrame, n: int, *order_by: Column) -> tuple[int, list[Row]]:
    """How many rows there are and the first ``n``, by all columns if no order is given. One job."""
    counted = Observation()
    rows = df.observe(counted, F.count(F.lit(1)).alias("rows")).orderBy(*(order_by or df.columns)).limit(n).collect()
    return counted.get["rows"], rows


def sample_rows(df: DataFrame, n: int, *order_by: str) -> DataFrame:
    """The first ``n`` rows; with ``order_by`` always the same ones."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def columns_of(df: DataFrame) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in df.schema]
