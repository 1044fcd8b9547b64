from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
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
from mensario.operators.trusted import trusted_faturas, trusted_pagamentos
from mensario.schemas import RAW_FATURA, RAW_PAGAMENTO, TRUSTED_FATURA, TRUSTED_PAGAMENTO


def evaluate(spark, values, column):
    rows = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    return [r.x for r in rows.select("i", column.alias("x")).orderBy("i").collect()]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="-aF0 9", max_size=12), min_size=50, max_size=200))
def test_prefixes_are_what_the_patterns_remove(spark, values):
    values = [*values, None, "", "-", "--", "PAG-77", "PAG-FAT-77"]
    for ours, pattern in ((strip_prefix, fv.PREFIX_TO_LAST_HYPHEN), (strip_double_prefix, fv.PREFIX_OF_TWO_HYPHENS)):
        assert evaluate(spark, values, ours("v")) == evaluate(spark, values, F.regexp_replace("v", pattern, ""))


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_bad_text_becomes_null_in_either_mode(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        assert evaluate(spark, ["12a", "", None, "9" * 30], to_id("v")) == [None] * 4
        assert evaluate(spark, ["2024-02-30", "x", None], to_day("v")) == [None] * 3
        assert evaluate(spark, ["abc", "9" * 20, None], to_money("v")) == [None] * 3
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_ids_may_carry_a_fraction_and_blanks(spark):
    assert evaluate(spark, ["345", " 345 ", "345.0", "-12.9", "+7", "1.2.3", ".5", "-.9", "."], to_id("v")) == [
        345, 345, 345, -12, 7, None, 0, 0, None
    ]


def test_money_rounds_half_up(spark):
    assert evaluate(spark, ["10.005", "-10.005", "1e3", "7"], to_money("v")) == [
        Decimal("10.01"), Decimal("-10.01"), Decimal("1000.00"), Decimal("7.00")
    ]


def test_month_is_cut_from_the_text_even_if_it_is_no_date(spark):
    assert evaluate(spark, ["2024-02-30", "20240105", "ab-cd", None], year_month("v")) == [
        "202402", "202401", "abcd", None
    ]


def test_trusted_schemas(spark):
    faturas = trusted_faturas(spark.createDataFrame([], RAW_FATURA), "x")
    pagamentos = trusted_pagamentos(spark.createDataFrame([], RAW_PAGAMENTO), "x")
    for df, schema in ((faturas, TRUSTED_FATURA), (pagamentos, TRUSTED_PAGAMENTO)):
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in schema]


def test_payment_with_one_hyphen_has_no_number(spark):
    raw = spark.createDataFrame([("PAG-77", "FAT-1", "5", "2024-01-02", "9.999")], RAW_PAGAMENTO)
    row = trusted_pagamentos(raw, "20240205").first()
    assert (row.id_pagamento, row.id_fatura, row.ref, row.vlr_pagamento) == (None, 1, "202401", Decimal("10.00"))
