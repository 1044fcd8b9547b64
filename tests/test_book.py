"""The three-step book against the several hundred conditional aggregates it stands for."""

import random
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from mensario import fixed_values as fv
from mensario.operators.book import KEYS, book_of, build_features, combine_rows, tasks_for
from mensario.operators.features import BOOK_GRID, FeatureGrid
from mensario.operators.stage import with_window_flags
from mensario.schemas import STAGE
from mensario.sources.tables import book_schema


def stage_rows(n, customers, seed):
    rng = random.Random(seed)

    def maybe(value):
        return None if rng.random() < 0.1 else value

    rows = []
    for _ in range(n):
        # A third of the rows belongs to one customer; some have none.
        customer = 1 if rng.random() < 0.33 else maybe(rng.randrange(customers))
        rows.append(
            (
                customer,
                "202402",
                "20240205080000",
                maybe(rng.choice([*fv.CLASSES_PAGTO, "DESCONHECIDO"])),
                maybe(rng.choice([*fv.CLASSES_VLR_PAGTO, "DESCONHECIDO"])),
                maybe(date(2024, 2, 20) - timedelta(days=rng.randrange(420))),
                maybe(Decimal(rng.randrange(-(10**6), 10**14)) / 100),
                None,
                None,
                maybe(Decimal(rng.randrange(-500, 101))),
                maybe(rng.randrange(-40, 400)),
                1,
            )
        )
    return rows


def direct_book(flagged, grid=BOOK_GRID):
    def aggregate(f):
        inside = F.col(f.label_column) == f.label
        if f.flag:
            inside &= F.col(f.flag) == 1
        return getattr(F, f.agg)(F.when(inside, F.col(f.value))).alias(f.name)

    return flagged.groupBy(*KEYS).agg(*[aggregate(f) for f in grid.features()])


@pytest.fixture(scope="module")
def flagged(spark, period):
    stage = spark.createDataFrame(stage_rows(1500, 60, seed=7), STAGE)
    return with_window_flags(stage, period).cache()


@pytest.fixture(scope="module")
def book(flagged):
    return build_features(flagged).cache()


def by_customer(df):
    return sorted((tuple(row) for row in df.collect()), key=lambda r: (r[0] is None, r[0] or 0))


def test_values_and_types_equal_the_direct_form(flagged, book):
    direct = direct_book(flagged)
    assert [(f.name, f.dataType) for f in book.schema] == [(f.name, f.dataType) for f in direct.schema]
    assert [(f.name, f.dataType) for f in book.schema] == [(f.name, f.dataType) for f in book_schema()]
    assert by_customer(book) == by_customer(direct)


def test_other_grids_work_too(spark, flagged):
    grid = FeatureGrid(
        labels=(("fbc_classif_vlr_pagto", fv.VALOR_TOTAL),),
        windows=(None, 3),
        values=(("fvl_numero_dias_atraso", ("max", "avg")), ("fvl_vlr_fatura", ("sum",))),
    )
    assert [f.name for f in grid.features()] == [f"VAR_{i}" for i in range(1, 7)]
    assert by_customer(build_features(flagged, grid)) == by_customer(direct_book(flagged, grid))


def test_every_customer_is_there_even_without_any_known_label(spark, period):
    row = (9, "202402", "x", None, "DESCONHECIDO", date(2024, 1, 1), Decimal(1), None, None, None, 3, 1)
    book = build_features(with_window_flags(spark.createDataFrame([row], STAGE), period)).collect()
    assert len(book) == 1 and book[0].id_cliente == 9 and set(book[0][3:]) == {None}


def test_runs_and_months_stay_apart(spark, period):
    base = (9, "202402", "x", fv.NO_PRAZO, fv.VALOR_TOTAL, date(2024, 1, 1), Decimal(1), None, None, None, 3, 1)
    rows = [base, base[:2] + ("y",) + base[3:], base[:1] + ("202403",) + base[2:]]
    book = build_features(with_window_flags(spark.createDataFrame(rows, STAGE), period))
    assert sorted((r.ref, r.dt_proc, r.VAR_25) for r in book.collect()) == [
        ("202402", "x", 1), ("202402", "y", 1), ("202403", "x", 1)
    ]


def test_no_match_is_null_and_not_zero(spark, period):
    row = (9, "202402", "x", fv.NO_PRAZO, fv.VALOR_TOTAL, date(2024, 1, 1), Decimal(1), None, None, Decimal(100), 0, 1)
    book = build_features(with_window_flags(spark.createDataFrame([row], STAGE), period)).first()
    assert (book.VAR_1, book.VAR_25, book.VAR_67, book.VAR_91) == (Decimal(1), 1, None, None)


def test_counters_of_the_labels_add_up_and_grow_with_the_window(flagged, book):
    known = flagged.where(F.col("fbc_classif_pagto").isin(*fv.CLASSES_PAGTO))
    timing = [25 + 66 * c for c in range(4)]
    total = book.select(sum((F.coalesce(F.col(f"VAR_{n}"), F.lit(0)) for n in timing), F.lit(0)).alias("n"))
    assert total.agg(F.sum("n")).first()[0] == known.count()
    for start in (25 + 66 * c for c in range(7)):
        counts = [F.coalesce(F.col(f"VAR_{start + w}"), F.lit(0)) for w in (1, 2, 3, 4, 5, 0)]
        shrinking = [a > b for a, b in zip(counts, counts[1:], strict=False)]
        for condition in shrinking:
            assert book.where(condition).isEmpty()


def test_averages_round_once(spark, period):
    """2 of 3 rows: a quotient with no end, and one exactly half way between two results."""
    values = [Decimal("0.01"), Decimal("0.02"), Decimal("0.02")]
    rows = [
        (9, "202402", "x", fv.NO_PRAZO, fv.VALOR_TOTAL, date(2024, 1, 1), v, None, None, Decimal(p), 0, 1)
        for v, p in zip(values, (100, 33, 67), strict=True)
    ]
    flagged = with_window_flags(spark.createDataFrame(rows, STAGE), period)
    book = build_features(flagged).first()
    assert (book.VAR_2, book.VAR_49) == (Decimal("0.016667"), Decimal("66.6667"))


def test_a_hot_customer_shrinks_before_the_shuffle_by_customer(flagged):
    states = combine_rows(flagged)
    most = states.groupBy("id_cliente").count().agg(F.max("count")).first()[0]
    # Six labels or none x four labels or none x six nested windows.
    assert most <= 5 * 4 * 6
    assert flagged.where("id_cliente = 1").count() > 400


def test_one_customer(book):
    assert [r.id_cliente for r in book_of(book, 1).collect()] == [1]
    assert book_of(book, 10**9).isEmpty()


def test_plan_has_two_shuffles_and_no_python(spark, period, tmp_path, capsys):
    spark.createDataFrame(stage_rows(50, 5, seed=1), STAGE).write.parquet(str(tmp_path / "s"))
    build_features(with_window_flags(spark.read.parquet(str(tmp_path / "s")), period)).explain()
    plan = capsys.readouterr().out
    assert plan.count("Exchange ") == 2
    assert "Python" not in plan and "SortAggregate" not in plan
    # Columns no feature uses are not read.
    assert "fvl_vlr_pagto_min" not in plan


def test_a_large_book_is_built_in_as_many_tasks_as_its_rows_need(spark, flagged, capsys):
    least = spark.sparkContext.defaultParallelism
    assert [tasks_for(spark, n) for n in (0, 250_000, 250_001, 10**8)] == [None, None, least, 400]
    book = build_features(flagged, tasks=37)
    assert by_customer(book) == by_customer(build_features(flagged))
    capsys.readouterr()
    book.explain()
    plan = capsys.readouterr().out
    assert "REPARTITION_BY_NUM" in plan and ", 37)" in plan and "REPARTITION_BY_COL" not in plan
