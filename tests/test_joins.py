from datetime import date

import pytest

from mensario.operators import joins

FATURA = "id_cliente long, id_fatura long, dt_emissao date, dt_vencimento date, vlr_fatura int, vlr_pagto_min int"
PAGAMENTO = "id_pagamento long, id_cliente long, id_fatura long, dt_pagamento date, vlr_pagamento int"
DAY = date(2024, 1, 1)


@pytest.fixture(scope="module")
def faturas(spark):
    rows = [(i % 10, i, DAY, DAY, i, 0) for i in range(300)] + [(3, None, DAY, DAY, 1, 0), (None, 4, DAY, DAY, 1, 0)]
    return spark.createDataFrame(rows + rows[:5], FATURA)


@pytest.fixture(scope="module")
def pagamentos(spark):
    """A third of the payments, many of them exact copies, belongs to one invoice."""
    rows = [(i, i % 10, i, DAY, i) for i in range(0, 300, 2)] + [(7, 8, 8, DAY, i % 2) for i in range(100)]
    rows += [(1, 3, None, DAY, 1), (2, None, 4, DAY, 1), (3, 999, 999, DAY, 1), (4, 1, 2, DAY, 1)]
    return spark.createDataFrame(rows, PAGAMENTO)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_same_rows_and_columns_as_the_plain_join(faturas, pagamentos):
    split = joins.join_faturas_pagamentos(faturas, pagamentos)
    plain = faturas.join(pagamentos, list(joins.KEYS), "left").select(*split.columns)
    assert plain.dtypes == split.dtypes
    assert rows_of(plain) == rows_of(split)
    # Every invoice once, plus one row per further payment.
    assert split.count() == 307 + 100
    assert split.where("dt_pagamento is null").where("id_fatura % 2 = 0 and id_cliente is not null").isEmpty()


def test_building_the_join_starts_no_job(spark, faturas, pagamentos):
    spark.sparkContext.setJobGroup("join", "building only")
    try:
        joins.join_faturas_pagamentos(faturas, pagamentos)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("join")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_inner_join_where_adaptive_execution_can_split_payments(faturas, pagamentos, capsys):
    joins.join_faturas_pagamentos(faturas, pagamentos).explain()
    plan = capsys.readouterr().out
    assert "LeftOuter" not in plan and "Inner" in plan and "LeftAnti" in plan


SKEW_SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.shuffle.partitions": "16",
}


def test_a_hot_payment_key_is_split_at_run_time_and_invoices_shuffle_once(spark, faturas, tmp_path):
    hot = spark.range(0, 60_000, 1, 6).selectExpr(
        "id as id_pagamento",
        "if(id % 3 = 0, 8, id % 10) as id_cliente",
        "if(id % 3 = 0, 8, id % 300) as id_fatura",
        "date'2024-01-01' as dt_pagamento",
        "cast(id as int) as vlr_pagamento",
    )
    faturas.write.parquet(str(tmp_path / "f"))
    hot.write.parquet(str(tmp_path / "p"))
    invoices, payments = spark.read.parquet(str(tmp_path / "f")), spark.read.parquet(str(tmp_path / "p"))
    before = {key: spark.conf.get(key, None) for key in SKEW_SETTINGS}
    try:
        for key, value in SKEW_SETTINGS.items():
            spark.conf.set(key, value)
        df = joins.join_faturas_pagamentos(invoices, payments)
        n, plan = len(df.collect()), df._jdf.queryExecution().executedPlan().toString()
        plain = invoices.join(payments, list(joins.KEYS), "left")
        assert n == plain.count()
        assert "skew=true" in plan and "ReusedExchange" in plan
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
