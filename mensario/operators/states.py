"""States of the invoices of a month, from which the book of any reference date is merged.

What a payment says of its invoice does not depend on the reference date, but whether an
invoice is unpaid does: payments outside the period do not count, and the days of unpaid
invoices run up to the date. So each month of issue has two kinds of states: of
invoices with their payments by month of payment, and of invoices as if they were unpaid, with the
months in which they were paid. Of the first those of the period's months are taken, of the second those
paid in none of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mensario import fixed_values as fv
from mensario.functions import classify
from mensario.functions.period import Period
from mensario.operators.book import features_of_states
from mensario.operators.joins import KEYS
from mensario.operators.stage import with_amount_class, with_payment_class, with_percent_paid, with_window_flags
from mensario.schemas import STAGE, STATE

_MEASURED = ("fvl_vlr_fatura", "fvl_perc_vlr_fatura", "fvl_numero_dias_atraso")
_DAYS = "fvl_numero_dias_atraso"
_GROUP = ("id_cliente", "ref", "ref_pagto", "meses_pagos", "fbc_classif_pagto", "fbc_classif_vlr_pagto", "dt_emissao", "dt_vencimento")
_AGGREGATES = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}


def _classified(rows: DataFrame) -> DataFrame:
    return rows.transform(with_payment_class).transform(with_amount_class).transform(with_percent_paid)


def build_states(faturas: DataFrame, pagamentos: DataFrame, dt_proc: str) -> DataFrame:
    """The states of ``faturas`` under ``pagamentos``. A customer with very many rows leaves each task as a few states.

    Payments without a month never count. Both joins are such that adaptive execution can split a hot invoice's payments.
    """
    invoice = faturas.select("id_fatura", "id_cliente", "dt_emissao", "dt_vencimento", "vlr_fatura", "ref")
    payment = pagamentos.where("ref is not null").select("id_fatura", "id_cliente", "dt_pagamento", "vlr_pagamento", F.col("ref").alias("ref_pagto"))
    paid = invoice.join(payment, list(KEYS)).withColumn("meses_pagos", F.lit(None).cast("array<string>"))
    months = payment.groupBy(*KEYS).agg(F.array_sort(F.collect_set("ref_pagto")).alias("meses_pagos"))
    none = {"dt_pagamento": F.lit(None).cast("date"), "vlr_pagamento": F.lit(None).cast(payment.schema["vlr_pagamento"].dataType)}
    unpaid = invoice.join(months, list(KEYS), "left").withColumns({**none, "ref_pagto": F.lit(None).cast("string")})
    unpaid = unpaid.withColumn("meses_pagos", F.coalesce("meses_pagos", F.array().cast("array<string>")))
    # a payment without a valid date is none by its date, so its days depend on the reference date as well
    due = F.when(F.col("fbc_classif_pagto") == fv.SEM_PAGAMENTO, F.col("dt_vencimento"))
    rows = _classified(paid.unionByName(unpaid)).withColumn(_DAYS, classify.days_of_payment()).withColumn("dt_vencimento", due)
    rows = rows.withColumnRenamed("vlr_fatura", "fvl_vlr_fatura")
    states = rows.groupBy(*_GROUP).agg(
        F.count(F.lit(1)).alias("sum_fvl_qtd_transacao"),
        *[how(value).alias(f"{name}_{value}") for value in _MEASURED for name, how in _AGGREGATES.items()],
    )
    return states.withColumn("dt_proc", F.lit(dt_proc)).select(*[F.col(f.name).cast(f.dataType) for f in STATE])


def _in_period(period: Period) -> Column:
    unpaid = F.col("ref_pagto").isNull() & ~F.exists("meses_pagos", lambda month: month.between(period.first_ref, period.ref))
    return period.covers("ref") & (period.covers("ref_pagto") | unpaid)


def _with_days(states: DataFrame, period: Period) -> DataFrame:
    """Days of unpaid invoices, which all fall due on one day in a state."""
    days, n = classify.days_unpaid(period), F.col("sum_fvl_qtd_transacao")
    of_state = {"sum": days * n, "count": F.when(days.isNotNull(), n).otherwise(0), "min": days, "max": days}
    unpaid = F.col("fbc_classif_pagto") == fv.SEM_PAGAMENTO
    return states.withColumns({f"{name}_{_DAYS}": F.when(unpaid, value).otherwise(F.col(f"{name}_{_DAYS}")) for name, value in of_state.items()})


def states_of(states: DataFrame, period: Period) -> DataFrame:
    """The states that the book of ``period`` is merged from."""
    return states.where(_in_period(period))


def book_of_states(states: DataFrame, period: Period, dt_proc: str, tasks: int | None = None) -> DataFrame:
    """The book of ``period`` from the states of its months. One shuffle by customer, of states only, to ``tasks`` if given."""
    rows = _with_days(states_of(states, period), period)
    rows = rows.withColumns({"ref": period.ref, "dt_proc": F.lit(dt_proc)})
    types = {value: STAGE[value].dataType for value in (*_MEASURED, "fvl_qtd_transacao")}
    return features_of_states(with_window_flags(rows, period), types, tasks=tasks)
