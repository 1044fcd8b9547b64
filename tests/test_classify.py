from datetime import date
from decimal import Decimal

import pytest

from mensario.operators.stage import build_stage, with_window_flags
from mensario.schemas import STAGE

COLUMNS = """id_cliente long, id_fatura long, dt_emissao date, dt_vencimento date, vlr_fatura decimal(14,2),
vlr_pagto_min decimal(14,2), id_pagamento long, dt_pagamento date, vlr_pagamento decimal(14,2)"""


def stage_of(spark, period, due, paid, billed="100.00", amount=None, issued=date(2024, 1, 1)):
    row = (1, 2, issued, due, Decimal(billed), None, 3, paid, Decimal(amount) if amount else None)
    return build_stage(spark.createDataFrame([row], COLUMNS), period, "20240205080000")


@pytest.mark.parametrize(
    ("due", "paid", "label", "days"),
    [
        (date(2024, 1, 10), date(2024, 1, 10), "PAGAMENTO_NO_PRAZO", 0),
        (date(2024, 1, 10), date(2024, 1, 5), "PAGAMENTO_ANTECIPADO", -1),
        (date(2024, 1, 10), date(2024, 1, 13), "PAGAMENTO_EM_ATRASO", 3),
        (date(2024, 1, 5), None, "SEM_PAGAMENTO", 27),
        (date(2024, 3, 5), None, "SEM_PAGAMENTO", -33),
        (None, date(2024, 1, 5), "PAGAMENTO_EM_ATRASO", None),
        (None, None, "SEM_PAGAMENTO", None),
    ],
)
def test_timing_and_days(spark, period, due, paid, label, days):
    row = stage_of(spark, period, due, paid).first()
    assert (row.fbc_classif_pagto, row.fvl_numero_dias_atraso) == (label, days)


@pytest.mark.parametrize(
    ("billed", "amount", "label", "percent"),
    [
        ("100.00", "100.00", "VALOR_TOTAL", 100),
        ("100.00", "50.50", "VALOR_PARCIAL", 51),
        ("100.00", "50.49", "VALOR_PARCIAL", 50),
        ("100.00", "120.00", "SEM_VALOR", 0),
        ("100.00", None, "SEM_VALOR", 0),
        ("0.00", "-1.00", "VALOR_PARCIAL", None),
        ("3.00", "1.00", "VALOR_PARCIAL", 33),
        ("999999999999.99", "999999999999.98", "VALOR_PARCIAL", 100),
    ],
)
def test_amount_and_percent(spark, period, billed, amount, label, percent):
    row = stage_of(spark, period, date(2024, 1, 10), date(2024, 1, 10), billed, amount).first()
    got = None if row.fvl_perc_vlr_fatura is None else int(row.fvl_perc_vlr_fatura)
    assert (row.fbc_classif_vlr_pagto, got) == (label, percent)


@pytest.mark.parametrize(
    ("issued", "flags"),
    [
        (date(2024, 2, 29), (1, 1, 1, 1, 1)),
        (date(2024, 1, 1), (1, 1, 1, 1, 1)),
        (date(2023, 12, 31), (0, 1, 1, 1, 1)),
        (date(2023, 11, 1), (0, 1, 1, 1, 1)),
        (date(2023, 10, 31), (0, 0, 1, 1, 1)),
        (date(2023, 2, 1), (0, 0, 0, 0, 1)),
        (date(2023, 1, 31), (0, 0, 0, 0, 0)),
        (None, (0, 0, 0, 0, 0)),
    ],
)
def test_window_flags(spark, period, issued, flags):
    rows = stage_of(spark, period, date(2024, 1, 10), None, issued=issued)
    row = with_window_flags(rows, period).first()
    assert (row.flg_u1m, row.flg_u3m, row.flg_u6m, row.flg_u9m, row.flg_u12m) == flags


def test_stage_schema_and_constants(spark, period):
    rows = stage_of(spark, period, date(2024, 1, 10), None)
    assert [(f.name, f.dataType) for f in rows.schema] == [(f.name, f.dataType) for f in STAGE]
    row = rows.first()
    assert (row.ref, row.dt_proc, row.fvl_qtd_transacao) == ("202402", "20240205080000", 1)
