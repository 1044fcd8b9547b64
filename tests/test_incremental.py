"""The book from stored states against the book from rows, over months, corrections and odd rows."""

import random
from datetime import date, timedelta

import pytest

from mensario.functions.period import Period
from mensario.operators.book import build_features
from mensario.operators.inspection import in_period
from mensario.operators.joins import join_faturas_pagamentos
from mensario.operators.stage import build_stage, with_window_flags
from mensario.operators.trusted import trusted_faturas, trusted_pagamentos
from mensario.plans import incremental, monthly
from mensario.schemas import RAW_FATURA, RAW_PAGAMENTO
from mensario.sources import tables
from mensario.sources.bucketed import write_trusted_bucketed
from mensario.streaming import landing

FATURAS, PAGAMENTOS = monthly.SUBJECTS
FIRST = date(2023, 1, 1)


def invoices(rng, n, first, days):
    rows = []
    for i in range(first, first + n):
        issued = FIRST + timedelta(rng.randrange(days))
        due = rng.choice([(issued + timedelta(10)).isoformat()] * 9 + [None])
        rows.append((f"FAT-{i}", rng.choice([str(i % 9)] * 19 + [None]), issued.isoformat(), due, f"{rng.randrange(1, 500)}.{i % 100:02d}", "1.00"))
    return rows + rows[:2]


def payments(rng, rows):
    out = []
    for i, (number, customer, issued, _, amount, _) in enumerate(rows):
        for k in range(rng.choice([0, 0, 1, 1, 1, 2, 5])):
            paid = date.fromisoformat(issued) + timedelta(rng.choice([3, 10, 12, 45, 200, -40]))
            day = rng.choice([paid.isoformat()] * 15 + [f"{paid:%Y-%m}-99", None])
            out.append((f"PAG-FAT-{i}{k}", number, customer, day, rng.choice([amount, "0.50", "999.00", None])))
    return out


def store(spark, lake, subject, rows, dt_proc, mode=tables.APPEND, buckets=None):
    schema, to_trusted = (RAW_FATURA, trusted_faturas) if subject == FATURAS else (RAW_PAGAMENTO, trusted_pagamentos)
    typed = to_trusted(spark.createDataFrame(rows, schema), dt_proc)
    if buckets:
        write_trusted_bucketed(typed, subject, lake.trusted(subject), dt_proc, buckets, mode)
    else:
        tables.write_trusted(typed, lake.trusted(subject), dt_proc, mode)


def by_rows(spark, lake, period):
    parts = [in_period(tables.scan_trusted(spark, s, lake.trusted(s)), period) for s in monthly.SUBJECTS]
    stage = build_stage(join_faturas_pagamentos(*parts), period, "x")
    return sorted(map(tuple, build_features(with_window_flags(stage, period)).collect()), key=str)


def by_states(spark, lake, period):
    made = incremental.refresh_states(spark, lake, period, "x")
    states = tables.scan_runs(spark, incremental.STATE, lake.states)
    return made, sorted(map(tuple, incremental.book_of_states(states, period, "x").collect()), key=str)


@pytest.mark.parametrize("buckets", [None, 3])
def test_the_same_book_month_after_month_and_after_corrections(spark, lake, buckets):
    rng = random.Random(3)
    first = invoices(rng, 150, 0, 300)
    store(spark, lake, FATURAS, first, "a", buckets=buckets)
    store(spark, lake, PAGAMENTOS, payments(rng, first), "a", buckets=buckets)
    for day in (date(2023, 6, 1), date(2023, 7, 15), date(2023, 6, 1)):
        period = Period(day, 6)
        made, book = by_states(spark, lake, period)
        assert book == by_rows(spark, lake, period) and book
    assert by_states(spark, lake, period) == ([], book)
    # a month later: new invoices, payments of new and of old ones
    period = Period(date(2023, 12, 1), 6)
    by_states(spark, lake, period)
    late = [("PAG-FAT-9", first[0][0], first[0][1], "2023-11-20", "0.25")]
    store(spark, lake, PAGAMENTOS, late, "b", buckets=buckets)
    made, book = by_states(spark, lake, period)
    assert book == by_rows(spark, lake, period)
    assert 0 < len(made) < 7
    # invoices of a month replaced, payments of a month replaced by fewer
    store(spark, lake, FATURAS, [r for r in first if r[2].startswith("2023-08")][:3], "c", tables.REPLACE_MONTHS, buckets)
    made, book = by_states(spark, lake, period)
    assert book == by_rows(spark, lake, period) and made == ["202308"]
    store(spark, lake, PAGAMENTOS, late, "d", tables.REPLACE_MONTHS, buckets)
    _, book = by_states(spark, lake, period)
    assert book == by_rows(spark, lake, period)


def test_only_touched_months_are_made_again(spark, lake):
    rows = [(f"FAT-{m}{i}", str(i), f"2023-{m:02d}-05", f"2023-{m:02d}-15", "10.00", "1.00") for m in range(1, 9) for i in range(5)]
    store(spark, lake, FATURAS, rows, "a")
    store(spark, lake, PAGAMENTOS, [(f"PAG-{r[0]}", r[0], r[1], r[2], "10.00") for r in rows[::2]], "a")
    period = Period(date(2023, 8, 1), 5)
    assert by_states(spark, lake, period)[0] == [f"2023{m:02d}" for m in range(3, 9)]
    store(spark, lake, PAGAMENTOS, [("PAG-FAT-1", "FAT-51", "1", "2023-07-09", "1.00")], "b")
    made, book = by_states(spark, lake, period)
    assert set(made) == {"202305", "202307"} and book == by_rows(spark, lake, period)
    # another month's payment touched nothing of the others, and that is remembered
    assert by_states(spark, lake, period) == ([], book)
    # a book for the month before, from states that cover it but for its first month
    earlier = Period(date(2023, 7, 1), 5)
    made, book = by_states(spark, lake, earlier)
    assert "202302" in made and len(made) < 6 and book == by_rows(spark, lake, earlier)


def test_a_month_without_invoices_any_more_leaves_no_states(spark, lake, monkeypatch):
    rows = [(f"FAT-{i}", "1", f"2023-0{1 + i % 2}-05", "2023-02-15", "10.00", "1.00") for i in range(6)]
    store(spark, lake, FATURAS, rows, "a")
    store(spark, lake, PAGAMENTOS, [("PAG-FAT-1", "FAT-1", "1", "2023-02-09", "1.00")], "a")
    period = Period(date(2023, 2, 1), 3)
    by_states(spark, lake, period)
    store(spark, lake, FATURAS, [r for r in rows if "-02-05" in r[2]], "a")
    made, book = by_states(spark, lake, period)
    assert "202301" in made and book == by_rows(spark, lake, period)


def test_a_refresh_that_failed_is_repeated(spark, lake, monkeypatch):
    rng = random.Random(5)
    first = invoices(rng, 60, 0, 120)
    store(spark, lake, FATURAS, first, "a")
    store(spark, lake, PAGAMENTOS, payments(rng, first), "a")
    period = Period(date(2023, 4, 1), 4)
    real = tables.runs.record

    def lost(*args, **kwargs):
        raise RuntimeError("lost")

    monkeypatch.setattr(tables.runs, "record", lost)
    with pytest.raises(RuntimeError, match="lost"):
        by_states(spark, lake, period)
    monkeypatch.setattr(tables.runs, "record", real)
    assert by_states(spark, lake, period)[1] == by_rows(spark, lake, period)


def test_the_plan_reads_states_and_shuffles_them_alone(spark, lake, capsys):
    rng = random.Random(6)
    first = invoices(rng, 60, 0, 120)
    store(spark, lake, FATURAS, first, "a")
    store(spark, lake, PAGAMENTOS, payments(rng, first), "a")
    period = Period(date(2023, 4, 1), 4)
    incremental.refresh_states(spark, lake, period, "x")
    incremental.book_of_states(tables.scan_runs(spark, incremental.STATE, lake.states), period, "x").explain()
    plan = capsys.readouterr().out
    assert "Join" not in plan and plan.count("Scan parquet") == 1 and plan.count("Exchange") == 2


def test_a_hot_customer_leaves_a_task_as_few_states(spark):
    n = 20_000
    faturas = spark.range(n).selectExpr(
        "id as id_fatura", "7L as id_cliente", "'x' as dt_proc", "'202301' as ref", "date'2023-01-05' as dt_emissao", "date'2023-01-15' as dt_vencimento",
        "cast(1 as decimal(14,2)) as vlr_fatura", "cast(1 as decimal(14,2)) as vlr_pagto_min")
    pagamentos = faturas.selectExpr("id_fatura as id_pagamento", "id_fatura", "id_cliente", "dt_proc", "ref", "dt_emissao as dt_pagamento", "vlr_fatura as vlr_pagamento")
    states = incremental.build_states(faturas, pagamentos, "x").collect()
    assert len(states) == 2 and all(s.sum_fvl_qtd_transacao == n for s in states)


def test_the_run_from_landing_to_book(spark, lake, tmp_path):
    rng = random.Random(8)
    rows = invoices(rng, 40, 0, 90)
    folders = {}
    for subject, data, schema in ((FATURAS, rows, RAW_FATURA), (PAGAMENTOS, payments(rng, rows), RAW_PAGAMENTO)):
        folders[subject] = str(tmp_path / subject)
        spark.createDataFrame(data, schema).coalesce(1).write.option("header", True).csv(folders[subject])
    period = Period(date(2023, 4, 1), 4)
    book = monthly.run_month(spark, lake, folders, period, "20230405080000", buckets=3, build=incremental.build_book)
    want = by_rows(spark, lake, period)
    assert [r[3:] for r in sorted(map(tuple, book.collect()), key=str)] == [r[3:] for r in want]
    with pytest.raises(landing.NothingToProcess):
        incremental.build_book(spark, lake, period, "again")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        tables.scan_stage(spark, lake.stage).count()
