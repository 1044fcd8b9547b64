"""Raw text rows to the typed rows of the trusted layer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mensario import fixed_values as fv
from mensario.functions.parsing import (
    strip_double_prefix,
    strip_prefix,
    to_day,
    to_id,
    to_money,
    year_month,
)


def normalize_faturas(raw: DataFrame) -> DataFrame:
    return raw.select(
        strip_prefix("id_fatura").alias("id_fatura"),
        "id_cliente",
        F.col("data_emissao").alias("dt_emissao"),
        F.col("data_vencimento").alias("dt_vencimento"),
        F.col("valor_fatura").alias("vlr_fatura"),
        F.col("valor_pagamento_minimo").alias("vlr_pagto_min"),
    )


def normalize_pagamentos(raw: DataFrame) -> DataFrame:
    return raw.select(
        strip_double_prefix("id_pagamento").alias("id_pagamento"),
        strip_prefix("id_fatura").alias("id_fatura"),
        "id_cliente",
        F.col("data_pagamento").alias("dt_pagamento"),
        F.col("valor_pagamento").alias("vlr_pagamento"),
    )


def type_faturas(normalized: DataFrame, dt_proc: str) -> DataFrame:
    """``ref`` is the month of issue."""
    return normalized.select(
        to_id("id_fatura").alias("id_fatura"),
        to_id("id_cliente").alias("id_cliente"),
        F.lit(dt_proc).alias("dt_proc"),
        year_month("dt_emissao").alias("ref"),
        to_day("dt_emissao").alias("dt_emissao"),
        to_day("dt_vencimento").alias("dt_vencimento"),
        to_money("vlr_fatura").alias("vlr_fatura"),
        to_money("vlr_pagto_min").alias("vlr_pagto_min"),
    )


def type_pagamentos(normalized: DataFrame, dt_proc: str) -> DataFrame:
    """``ref`` is the month of payment, which may differ from the invoice's."""
    return normalized.select(
        to_id("id_pagamento").alias("id_pagamento"),
        to_id("id_fatura").alias("id_fatura"),
        to_id("id_cliente").alias("id_cliente"),
        F.lit(dt_proc).alias("dt_proc"),
        year_month("dt_pagamento").alias("ref"),
        to_day("dt_pagamento").alias("dt_pagamento"),
        to_money("vlr_pagamento").alias("vlr_pagamento"),
    )


def trusted_faturas(raw: DataFrame, dt_proc: str) -> DataFrame:
    return type_faturas(normalize_faturas(raw), dt_proc)


def trusted_pagamentos(raw: DataFrame, dt_proc: str) -> DataFrame:
    return type_pagamentos(normalize_pagamentos(raw), dt_proc)


TO_TRUSTED = {fv.SUBJECT_FATURAS: trusted_faturas, fv.SUBJECT_PAGAMENTOS: trusted_pagamentos}
