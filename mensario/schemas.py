"""Explicit schemas of every layer, so that no read has to infer anything."""

from pyspark.sql import types as T

from mensario import fixed_values as fv

MONEY = T.DecimalType(14, 2)


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in columns.items()])


RAW_FATURA = _struct(
    id_fatura=T.StringType(),
    id_cliente=T.StringType(),
    data_emissao=T.StringType(),
    data_vencimento=T.StringType(),
    valor_fatura=T.StringType(),
    valor_pagamento_minimo=T.StringType(),
)

RAW_PAGAMENTO = _struct(
    id_pagamento=T.StringType(),
    id_fatura=T.StringType(),
    id_cliente=T.StringType(),
    data_pagamento=T.StringType(),
    valor_pagamento=T.StringType(),
)

TRUSTED_FATURA = _struct(
    id_fatura=T.LongType(),
    id_cliente=T.LongType(),
    dt_proc=T.StringType(),
    ref=T.StringType(),
    dt_emissao=T.DateType(),
    dt_vencimento=T.DateType(),
    vlr_fatura=MONEY,
    vlr_pagto_min=MONEY,
)

TRUSTED_PAGAMENTO = _struct(
    id_pagamento=T.LongType(),
    id_fatura=T.LongType(),
    id_cliente=T.LongType(),
    dt_proc=T.StringType(),
    ref=T.StringType(),
    dt_pagamento=T.DateType(),
    vlr_pagamento=MONEY,
)

# Audit row of one trusted run.
CONTROL = _struct(tb_name=T.StringType(), dt_proc=T.StringType(), qtd_registros=T.StringType())

# One row per landed file, and one per file a trusted run has consumed.
LANDED_FILE = _struct(
    tb_name=T.StringType(),
    lote=T.StringType(),
    arquivo=T.StringType(),
    modificado=T.TimestampType(),
    tamanho=T.LongType(),
    qtd_registros=T.LongType(),
)
PROCESSED_FILE = _struct(
    tb_name=T.StringType(),
    lote=T.StringType(),
    arquivo=T.StringType(),
    dt_proc=T.StringType(),
    consumidor=T.StringType(),
)

STAGE = _struct(
    id_cliente=T.LongType(),
    ref=T.StringType(),
    dt_proc=T.StringType(),
    fbc_classif_pagto=T.StringType(),
    fbc_classif_vlr_pagto=T.StringType(),
    dt_emissao=T.DateType(),
    fvl_vlr_fatura=MONEY,
    fvl_vlr_pagto=MONEY,
    fvl_vlr_pagto_min=MONEY,
    fvl_perc_vlr_fatura=T.DecimalType(19, 0),
    fvl_numero_dias_atraso=T.IntegerType(),
    fvl_qtd_transacao=T.IntegerType(),
)

# Rows of one customer, class pair, day of issue and month of payment, as sums, counts and bounds of their values.
# ``ref`` is the month of issue. Without ``ref_pagto`` it is a state of invoices as if unpaid, which holds where none
# of ``meses_pagos`` is in the period. Days of unpaid ones follow from ``dt_vencimento``, which other states do not have.
STATE = _struct(
    id_cliente=T.LongType(),
    ref=T.StringType(),
    dt_proc=T.StringType(),
    ref_pagto=T.StringType(),
    meses_pagos=T.ArrayType(T.StringType()),
    fbc_classif_pagto=T.StringType(),
    fbc_classif_vlr_pagto=T.StringType(),
    dt_emissao=T.DateType(),
    dt_vencimento=T.DateType(),
    sum_fvl_qtd_transacao=T.LongType(),
    sum_fvl_vlr_fatura=T.DecimalType(24, 2),
    count_fvl_vlr_fatura=T.LongType(),
    min_fvl_vlr_fatura=MONEY,
    max_fvl_vlr_fatura=MONEY,
    sum_fvl_perc_vlr_fatura=T.DecimalType(29, 0),
    count_fvl_perc_vlr_fatura=T.LongType(),
    min_fvl_perc_vlr_fatura=T.DecimalType(19, 0),
    max_fvl_perc_vlr_fatura=T.DecimalType(19, 0),
    sum_fvl_numero_dias_atraso=T.LongType(),
    count_fvl_numero_dias_atraso=T.LongType(),
    min_fvl_numero_dias_atraso=T.IntegerType(),
    max_fvl_numero_dias_atraso=T.IntegerType(),
)

RAW = {fv.SUBJECT_FATURAS: RAW_FATURA, fv.SUBJECT_PAGAMENTOS: RAW_PAGAMENTO}
TRUSTED = {fv.SUBJECT_FATURAS: TRUSTED_FATURA, fv.SUBJECT_PAGAMENTOS: TRUSTED_PAGAMENTO}
