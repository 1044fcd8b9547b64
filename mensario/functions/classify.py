"""Payment classes and the values derived from them.

Comparisons with NULL are NULL, so such rows fall through to the last branch:
a payment whose invoice has no due date is late, and an amount that cannot be
compared, or exceeds the invoice, counts as no amount.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from mensario import fixed_values as fv
from mensario.functions.period import Period


def payment_timing() -> Column:
    paid, due = F.col("dt_pagamento"), F.col("dt_vencimento")
    return (
        F.when(paid.isNull(), fv.SEM_PAGAMENTO)
        .when(paid == due, fv.NO_PRAZO)
        .when(paid < due, fv.ANTECIPADO)
        .otherwise(fv.EM_ATRASO)
    )


def payment_amount() -> Column:
    paid, billed = F.col("vlr_pagamento"), F.col("vlr_fatura")
    return (
        F.when(paid == billed, fv.VALOR_TOTAL)
        .when(paid < billed, fv.VALOR_PARCIAL)
        .otherwise(fv.SEM_VALOR)
    )


def percent_paid() -> Column:
    """Whole percent, half up; NULL where the invoice amount is zero."""
    amount = F.col("fbc_classif_vlr_pagto")
    share = F.round(F.try_divide(F.col("vlr_pagamento") * 100, F.col("vlr_fatura")), 0)
    return F.when(amount == fv.VALOR_TOTAL, 100).when(amount == fv.VALOR_PARCIAL, share).otherwise(0)


def days_of_payment() -> Column:
    """What the dates of invoice and payment tell alone; NULL for unpaid invoices."""
    timing = F.col("fbc_classif_pagto")
    return (
        F.when(timing == fv.SEM_PAGAMENTO, None)
        .when(timing == fv.EM_ATRASO, F.datediff("dt_pagamento", "dt_vencimento"))
        .when(timing == fv.NO_PRAZO, 0)
        .otherwise(fv.DIAS_ANTECIPADO)
    )


def days_unpaid(period: Period) -> Column:
    """Up to the reference date; negative before the invoice falls due."""
    return F.datediff(period.day, "dt_vencimento")


def days_late(period: Period) -> Column:
    unpaid = F.col("fbc_classif_pagto") == fv.SEM_PAGAMENTO
    return F.when(unpaid, days_unpaid(period)).otherwise(days_of_payment())


def window_flag_name(months: int) -> str:
    return f"flg_u{months}m"


def window_flag(period: Period, months: int) -> Column:
    """1 if issued at most ``months`` before the reference date, or after it; else 0."""
    age = F.months_between(period.day, F.col("dt_emissao"))
    return F.when(age <= months, 1).otherwise(0)
