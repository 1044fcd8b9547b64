"""The same results as DuckDB SQL over the given tables.

Money is kept in whole cents, because DuckDB divides decimals as doubles: percentages
and averages are then exact integer divisions, rounded half up. The reference date is
the first of a month, so "at most k months back" is "not before the date k months back".
Classes come from the sign of a difference, which holds because no invoice of the tables
lacks a due date or an amount.
"""

from __future__ import annotations

from mensario import fixed_values as fv
from verification.fixtures import AGAIN, CUSTOMER, DT_PROC, PERIOD

_REF_DATE = f"DATE '{PERIOD.ref_date.isoformat()}'"
_FIRST = f"strftime({_REF_DATE} - INTERVAL {PERIOD.months} MONTH, '%Y%m')"
_LAST = f"strftime({_REF_DATE}, '%Y%m')"

# Trusted rows, still without their layer's names for money.
_TRUSTED = f"""
f AS (
  SELECT o_orderkey AS id_fatura, o_custkey AS id_cliente, '{DT_PROC}' AS dt_proc,
         strftime(o_orderdate, '%Y%m') AS ref,
         CAST(o_orderdate AS DATE) AS dt_emissao,
         CAST(o_orderdate AS DATE) + 10 AS dt_vencimento,
         CAST(CAST(o_totalprice AS DECIMAL(14,2)) * 100 AS BIGINT) AS fat_cents
  FROM orders),
p AS (
  SELECT l_orderkey * 10 + l_linenumber AS id_pagamento, l_orderkey AS id_fatura,
         o_custkey AS id_cliente, '{DT_PROC}' AS dt_proc,
         strftime(CAST(o_orderdate AS DATE) + CAST(7 + l_partkey % 7 AS INTEGER), '%Y%m') AS ref,
         CAST(o_orderdate AS DATE) + CAST(7 + l_partkey % 7 AS INTEGER) AS dt_pagamento,
         CAST(CAST(CASE WHEN l_suppkey % 3 = 0 THEN o_totalprice ELSE l_extendedprice END
                   AS DECIMAL(14,2)) * 100 AS BIGINT) AS pag_cents
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

_STAGE = f"""{_TRUSTED},
f0 AS (SELECT * FROM f WHERE ref BETWEEN {_FIRST} AND {_LAST}),
p0 AS (SELECT * FROM p WHERE ref BETWEEN {_FIRST} AND {_LAST}),
j AS (
  SELECT f0.id_cliente, f0.id_fatura, dt_emissao, dt_vencimento, fat_cents,
         id_pagamento, dt_pagamento, pag_cents,
         sign(dt_pagamento - dt_vencimento) AS timing, sign(pag_cents - fat_cents) AS amount
  FROM f0 LEFT JOIN p0 ON f0.id_cliente = p0.id_cliente AND f0.id_fatura = p0.id_fatura),
c AS (
  SELECT *,
    CASE timing WHEN -1 THEN '{fv.ANTECIPADO}' WHEN 0 THEN '{fv.NO_PRAZO}'
                WHEN 1 THEN '{fv.EM_ATRASO}' ELSE '{fv.SEM_PAGAMENTO}' END AS fbc_classif_pagto,
    CASE amount WHEN -1 THEN '{fv.VALOR_PARCIAL}' WHEN 0 THEN '{fv.VALOR_TOTAL}'
                ELSE '{fv.SEM_VALOR}' END AS fbc_classif_vlr_pagto
  FROM j),
d AS (
  SELECT *,
    CASE amount WHEN -1 THEN (200 * pag_cents + fat_cents) // (2 * fat_cents)
                WHEN 0 THEN 100 ELSE 0 END AS fvl_perc_vlr_fatura,
    CAST(CASE timing WHEN 1 THEN dt_pagamento - dt_vencimento
                     WHEN 0 THEN 0 WHEN -1 THEN {fv.DIAS_ANTECIPADO}
                     ELSE {_REF_DATE} - dt_vencimento END AS INTEGER) AS fvl_numero_dias_atraso
  FROM c),
s AS (
  SELECT id_cliente, {_LAST} AS ref, '{DT_PROC}' AS dt_proc, fbc_classif_pagto,
         fbc_classif_vlr_pagto, dt_emissao, fat_cents, pag_cents, fvl_perc_vlr_fatura,
         fvl_numero_dias_atraso, 1 AS fvl_qtd_transacao
  FROM d),
w AS (
  SELECT *, {", ".join(
    f"CASE WHEN dt_emissao >= {_REF_DATE} - INTERVAL {m} MONTH THEN 1 ELSE 0 END AS flg_u{m}m"
    for m in fv.JANELAS_MESES)}
  FROM s)"""


def _with(ctes: str, query: str) -> str:
    return f"WITH {ctes}\n{query}"


def _day(col: str) -> str:
    return f"strftime({col}, '%Y-%m-%d') AS {col}"


def _money(cents: str, name: str) -> str:
    return f"{cents} / 100.0::DOUBLE AS {name}"


# A tenth of the invoice, whole cents.
_MINIMUM = "(fat_cents // 10)"
_INVOICE_MONEY = f"{_money('fat_cents', 'vlr_fatura')}, {_money(_MINIMUM, 'vlr_pagto_min')}"
_PAYMENT_MONEY = _money("pag_cents", "vlr_pagamento")

_TYPED_F = f"""SELECT id_fatura, id_cliente, dt_proc, ref, {_day('dt_emissao')},
  {_day('dt_vencimento')}, {_INVOICE_MONEY} FROM"""
_TYPED_P = f"""SELECT id_pagamento, id_fatura, id_cliente, dt_proc, ref, {_day('dt_pagamento')},
  {_PAYMENT_MONEY} FROM"""
_JOINED = f"""SELECT id_cliente, id_fatura, {_day('dt_emissao')}, {_day('dt_vencimento')},
  {_INVOICE_MONEY}, id_pagamento, {_day('dt_pagamento')}, {_PAYMENT_MONEY}"""
_STAGE_COLUMNS = f"""SELECT id_cliente, ref, dt_proc, fbc_classif_pagto, fbc_classif_vlr_pagto,
  {_day('dt_emissao')}, {_money('fat_cents', 'fvl_vlr_fatura')}, {_money('pag_cents', 'fvl_vlr_pagto')},
  {_money(_MINIMUM, 'fvl_vlr_pagto_min')}, CAST(fvl_perc_vlr_fatura AS DOUBLE) AS fvl_perc_vlr_fatura,
  fvl_numero_dias_atraso, fvl_qtd_transacao"""


def _text(cents: str) -> str:
    return f"CAST(CAST({cents} / 100.0::DOUBLE AS DECIMAL(14,2)) AS VARCHAR)"


_RAW_F = _with(_TRUSTED, f"""SELECT 'FAT-' || id_fatura AS id_fatura, CAST(id_cliente AS VARCHAR) AS id_cliente,
  strftime(dt_emissao, '%Y-%m-%d') AS data_emissao, strftime(dt_vencimento, '%Y-%m-%d') AS data_vencimento,
  {_text('fat_cents')} AS valor_fatura, {_text(_MINIMUM)} AS valor_pagamento_minimo FROM f""")
_RAW_P = _with(_TRUSTED, f"""SELECT 'PAG-FAT-' || id_pagamento AS id_pagamento, 'FAT-' || id_fatura AS id_fatura,
  CAST(id_cliente AS VARCHAR) AS id_cliente, strftime(dt_pagamento, '%Y-%m-%d') AS data_pagamento,
  {_text('pag_cents')} AS valor_pagamento FROM p""")

_NORMALIZED_F = _with(_TRUSTED, f"""SELECT CAST(id_fatura AS VARCHAR) AS id_fatura,
  CAST(id_cliente AS VARCHAR) AS id_cliente, {_day('dt_emissao')}, {_day('dt_vencimento')},
  {_text('fat_cents')} AS vlr_fatura, {_text(_MINIMUM)} AS vlr_pagto_min FROM f""")
_NORMALIZED_P = _with(_TRUSTED, f"""SELECT CAST(id_pagamento AS VARCHAR) AS id_pagamento,
  CAST(id_fatura AS VARCHAR) AS id_fatura, CAST(id_cliente AS VARCHAR) AS id_cliente,
  {_day('dt_pagamento')}, {_text('pag_cents')} AS vlr_pagamento FROM p""")

# Value columns of the grid in the units the sums are made in, and how many of them make one.
_UNITS = {
    "fvl_vlr_fatura": ("fat_cents", 100),
    "fvl_qtd_transacao": ("fvl_qtd_transacao", 1),
    "fvl_numero_dias_atraso": ("fvl_numero_dias_atraso", 1),
    "fvl_perc_vlr_fatura": ("fvl_perc_vlr_fatura", 1),
}
# Averages of decimals keep four more digits than the decimal; averages of integers are doubles.
_DECIMALS = ("fvl_vlr_fatura", "fvl_perc_vlr_fatura")


# What the book holds of each value, and how many aggregates that is: VAR_n is numbered by label, then value,
# then window (all rows first), then aggregate.
_AGGREGATES = (
    ("fvl_vlr_fatura", "SUM AVG MIN MAX"),
    ("fvl_qtd_transacao", "SUM"),
    ("fvl_numero_dias_atraso", "AVG MIN MAX"),
    ("fvl_perc_vlr_fatura", "AVG MIN MAX"),
)
_WINDOWS = ("", "flg_u1m", "flg_u3m", "flg_u6m", "flg_u9m", "flg_u12m")
_LABELS = (
    ("fbc_classif_pagto", "PAGAMENTO_NO_PRAZO"),
    ("fbc_classif_pagto", "PAGAMENTO_ANTECIPADO"),
    ("fbc_classif_pagto", "SEM_PAGAMENTO"),
    ("fbc_classif_pagto", "PAGAMENTO_EM_ATRASO"),
    ("fbc_classif_vlr_pagto", "VALOR_TOTAL"),
    ("fbc_classif_vlr_pagto", "VALOR_PARCIAL"),
    ("fbc_classif_vlr_pagto", "SEM_VALOR"),
)


def _number(label: int, value: int, window: int, aggregate: int) -> int:
    """66 features a label; within a label the values start at 0, 24, 30 and 48."""
    width = len(_AGGREGATES[value][1].split())
    return 66 * label + (0, 24, 30, 48)[value] + width * window + aggregate + 1


def _column(label: int, value: int, window: int, aggregate: int) -> str:
    column, text = _LABELS[label]
    source, kinds = _AGGREGATES[value]
    unit, scale = _UNITS[source]
    agg, name = kinds.split()[aggregate], f"VAR_{_number(label, value, window, aggregate)}"
    inside = f"{column} = '{text}'" + (f" AND {_WINDOWS[window]} = 1" if window else "")
    case = f"CASE WHEN {inside} THEN {unit} END"
    if agg == "AVG" and source in _DECIMALS:
        total, n = f"SUM({case})", f"COUNT({case})"
        # COUNT is 0 where the sum is NULL; the divisor then does not matter.
        exact = f"({total} * 20000 + {n}) // (2 * GREATEST({n}, 1))"
        return f"CAST({exact} AS DOUBLE) / {scale * 10000}.0::DOUBLE AS {name}"
    if source in _DECIMALS:
        return f"CAST({agg}({case}) AS DOUBLE) / {scale}.0::DOUBLE AS {name}"
    return f"CAST({agg}({case}) AS BIGINT) AS {name}" if agg == "SUM" else f"{agg}({case}) AS {name}"


def _book(condition: str = "") -> str:
    columns = ",\n  ".join(
        _column(label, value, window, aggregate)
        for label in range(len(_LABELS))
        for value, (_, kinds) in enumerate(_AGGREGATES)
        for window in range(len(_WINDOWS))
        for aggregate in range(len(kinds.split()))
    )
    return _with(
        _STAGE,
        f"SELECT id_cliente, ref, dt_proc,\n  {columns}\nFROM w {condition} GROUP BY id_cliente, ref, dt_proc",
    )


def _twice_by_month(table: str, cents: str) -> str:
    return _with(_TRUSTED, f"""SELECT ref, 2 * COUNT(*) AS qtd,
      CAST(2 * SUM({cents}) AS DOUBLE) / 100.0::DOUBLE AS total FROM {table} GROUP BY ref""")


def _bounds(table: str, col: str) -> str:
    return _with(_STAGE, f"SELECT MAX({col}) AS max_{col}, MIN({col}) AS min_{col} FROM {table}")


def _key_counts(table: str, having: str = "") -> str:
    return _with(_STAGE, f"""SELECT id_fatura, id_cliente, COUNT(*) AS qtd FROM {table}
      GROUP BY id_fatura, id_cliente {having} ORDER BY id_cliente DESC, id_fatura""")


_FLAGS = ", ".join(f"flg_u{m}m" for m in fv.JANELAS_MESES)
_AMOUNT_CLASS = "fbc_classif_vlr_pagto"
_TIMING_CLASS = "fbc_classif_pagto"

ORACLE_SQL: dict[str, str] = {
    "csv_scan_faturas": _RAW_F,
    "csv_scan_pagamentos": _RAW_P,
    "csv_scan_reordered": _RAW_F,
    "trusted_scan_faturas": _with(_TRUSTED, f"{_TYPED_F} f"),
    "trusted_scan_pagamentos": _with(_TRUSTED, f"{_TYPED_P} p"),
    "sink_trusted_faturas": _twice_by_month("f", "fat_cents"),
    "sink_trusted_pagamentos": _twice_by_month("p", "pag_cents"),
    "sink_stage": _with(_STAGE, f"{_STAGE_COLUMNS} FROM s"),
    "sink_book": _book(),
    "stored_book_lookup": _book(f"WHERE id_cliente = {CUSTOMER}"),
    "book_retry": _book(),
    "book_replaced": _with(_STAGE, f"""
      SELECT {_LAST} AS ref, '{AGAIN}' AS dt_proc, COUNT(*) AS qtd, 'stage' AS tabela FROM s HAVING COUNT(*) > 0
      UNION ALL
      SELECT {_LAST}, '{AGAIN}', COUNT(DISTINCT id_cliente), 'book' FROM s HAVING COUNT(*) > 0"""),
    "join_bucketed": _with(_STAGE, f"{_JOINED} FROM j"),
    "repeated_bucketed": _key_counts("p0", "HAVING COUNT(*) > 1"),
    "book_from_states": _book(),
    "book_corrected": _book(),
    "control_row": _with(_TRUSTED, f"""
      SELECT '{fv.TRUSTED_FATURAS}' AS tb_name, '{DT_PROC}' AS dt_proc,
             CAST(COUNT(*) AS VARCHAR) AS qtd_registros FROM f
      UNION ALL
      SELECT '{fv.TRUSTED_PAGAMENTOS}', '{DT_PROC}', CAST(COUNT(*) AS VARCHAR) FROM p"""),
    "landing_ingest_faturas": _RAW_F,
    "landing_ingest_pagamentos": _RAW_P,
    "landing_redelivery": _with(_TRUSTED, f"""SELECT 'FAT-' || id_fatura AS id_fatura, CAST(id_cliente AS VARCHAR) AS id_cliente,
      strftime(dt_emissao, '%Y-%m-%d') AS data_emissao, strftime(dt_vencimento, '%Y-%m-%d') AS data_vencimento,
      {_text('((fat_cents + 5) // 10)')} AS valor_fatura, {_text(_MINIMUM)} AS valor_pagamento_minimo FROM f"""),
    "landing_mixed": _with(_TRUSTED, f"""
      SELECT '{fv.SUBJECT_FATURAS}' AS tb_name, COUNT(*) AS qtd, MAX('FAT-' || id_fatura) AS ultima FROM f
      UNION ALL SELECT '{fv.SUBJECT_PAGAMENTOS}', COUNT(*), MAX('FAT-' || id_fatura) FROM p"""),
    "landing_control": _with(_TRUSTED, f"""
      SELECT '{fv.SUBJECT_FATURAS}' AS tb_name, COUNT(*) AS qtd_registros FROM f
      UNION ALL SELECT '{fv.SUBJECT_PAGAMENTOS}', COUNT(*) FROM p"""),
    "control_gate": _with(_TRUSTED, f"""
      SELECT '{fv.SUBJECT_PAGAMENTOS}' AS tb_name, COUNT(*) AS qtd_registros FROM p"""),
    "normalize_faturas": _NORMALIZED_F,
    "normalize_pagamentos": _NORMALIZED_P,
    "typed_faturas": _with(_TRUSTED, f"{_TYPED_F} f"),
    "typed_pagamentos": _with(_TRUSTED, f"{_TYPED_P} p"),
    "period_filter_faturas": _with(_STAGE, f"{_TYPED_F} f0"),
    "period_filter_pagamentos": _with(_STAGE, f"{_TYPED_P} p0"),
    "join_fatura_pagamento": _with(_STAGE, f"{_JOINED} FROM j ORDER BY id_cliente, id_fatura"),
    "ref_months": _with(_TRUSTED, "SELECT ref FROM f GROUP BY ref ORDER BY ref"),
    "ref_bounds_faturas": _bounds("f0", "ref"),
    "ref_bounds_pagamentos": _bounds("p0", "ref"),
    "dup_check_faturas": _key_counts("f0"),
    "dup_check_pagamentos": _key_counts("p0"),
    "repeated_pagamentos": _key_counts("p0", "HAVING COUNT(*) > 1"),
    "classify_pagamento": _with(_STAGE, f"{_JOINED}, {_TIMING_CLASS} FROM c"),
    "classify_valor": _with(_STAGE, f"{_JOINED}, {_AMOUNT_CLASS} FROM c"),
    "perc_pago": _with(
        _STAGE,
        f"{_JOINED}, {_AMOUNT_CLASS}, CAST(fvl_perc_vlr_fatura AS DOUBLE) AS fvl_perc_vlr_fatura FROM d",
    ),
    "dias_atraso": _with(_STAGE, f"{_JOINED}, {_TIMING_CLASS}, fvl_numero_dias_atraso FROM d"),
    "stage": _with(_STAGE, f"{_STAGE_COLUMNS} FROM s"),
    "stage_bounds": _with(
        _STAGE,
        """SELECT strftime(MAX(dt_emissao), '%Y-%m-%d') AS max_dt_emissao,
           strftime(MIN(dt_emissao), '%Y-%m-%d') AS min_dt_emissao FROM s""",
    ),
    "flags_janela": _with(_STAGE, f"{_STAGE_COLUMNS}, {_FLAGS} FROM w"),
    "book": _book(),
    "book_point_lookup": _book(f"WHERE id_cliente = {CUSTOMER}"),
    "sample_rows": _with(_TRUSTED, f"{_TYPED_F} f ORDER BY f.id_fatura LIMIT 5"),
    "monthly_run": _book(),
}
