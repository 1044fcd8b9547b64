"""Joins and counts of bucketed tables: the same rows, nothing shuffled but hot keys."""

import re
from datetime import date

import pytest

from mensario.functions.period import Period
from mensario.operators import inspection, joins
from mensario.operators.trusted import trusted_faturas, trusted_pagamentos
from mensario.plans import monthly
from mensario.schemas import RAW_FATURA, RAW_PAGAMENTO
from mensario.sources import bucketed, tables

FATURAS, PAGAMENTOS = monthly.SUBJECTS
BUCKETS = 4
PERIOD = Period(date(2024, 3, 1), 3)


def faturas(spark, n=300):
    rows = [(f"FAT-{i}", str(i % 9), f"2024-0{i % 3 + 1}-05", "2024-03-15", f"{i}.00", "1.00") for i in range(n)]
    rows += [(None, "3", "2024-01-05", None, "1.00", "1.00"), ("FAT-4", None, "2024-01-05", None, "1.00", "1.00"), *rows[:3]]
    return spark.createDataFrame(rows, RAW_FATURA)


def pagamentos(spark, n=300, hot=0):
    rows = [(f"PAG-FAT-{i}", f"FAT-{i}", str(i % 9), f"2024-0{i % 3 + 1}-09", f"{i}.00") for i in range(0, n, 2)]
    rows += [(f"PAG-FAT-{i}", "FAT-8", "8", "2024-02-09", "0.10") for i in range(hot)]
    rows += [("PAG-FAT-1", None, "3", "2024-01-05", "1.00"), ("PAG-FAT-2", "FAT-4", None, "2024-01-05", "1.00"), ("PAG-FAT-3", "FAT-1", "1", None, "1.00")]
    return spark.createDataFrame(rows, RAW_PAGAMENTO)


def stored(spark, lake, hot):
    for stamp in ("a", "b"):
        bucketed.write_trusted_bucketed(trusted_faturas(faturas(spark), stamp), FATURAS, lake.trusted(FATURAS), stamp, BUCKETS, tables.REPLACE_MONTHS)
    n = bucketed.write_trusted_bucketed(trusted_pagamentos(pagamentos(spark, hot=hot), "a"), PAGAMENTOS, lake.trusted(PAGAMENTOS), "a", BUCKETS)
    assert n == pagamentos(spark, hot=hot).count()
    # rows of the hot key from a run in which it is not hot
    bucketed.write_trusted_bucketed(trusted_pagamentos(pagamentos(spark, 40), "c"), PAGAMENTOS, lake.trusted(PAGAMENTOS), "c", BUCKETS)
    return [bucketed.scan_trusted_bucketed(spark, s, lake.trusted(s)) for s in monthly.SUBJECTS]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")


@pytest.fixture
def sorted_joins(spark):
    no_broadcast(spark)
    yield
    for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.unset(key)


@pytest.mark.parametrize("hot", [0, 400])
def test_the_same_join_and_counts(spark, lake, sorted_joins, hot):
    f, p = (inspection.in_period(side, PERIOD) for side in stored(spark, lake, hot))
    mark = bucketed.hot_column(spark, lake.trusted(FATURAS), lake.trusted(PAGAMENTOS))
    assert mark == (bucketed.HOT if hot else None)
    plain = [inspection.in_period(tables.scan_trusted(spark, s, lake.trusted(s)), PERIOD) for s in monthly.SUBJECTS]
    assert rows_of(joins.join_stored(f, p, mark)) == rows_of(joins.join_faturas_pagamentos(*plain))
    for side, other in zip((f, p), plain):
        assert rows_of(inspection.repeats_stored(side, mark)) == rows_of(inspection.repeats(other))
    assert rows_of(p.where(f"{bucketed.HOT} = 1").select("id_fatura", "id_cliente").distinct()) == ([(8, 8)] if hot else [])


def test_nothing_is_shuffled_above_the_scans(spark, lake, sorted_joins, capsys):
    f, p = (inspection.in_period(side, PERIOD) for side in stored(spark, lake, 0))
    joined = joins.join_stored(f, p)
    joined.collect()
    joined.explain()
    inspection.repeats_stored(p).explain()
    plan = capsys.readouterr().out
    assert "Exchange" not in plan and "SortMergeJoin" in plan and "SelectedBucketsCount: 4 out of 4" in plan
    assert "ref#" in re.search(r"PartitionFilters: \[(.*?)\]", plan).group(1)


def subtrees(plan, node):
    """The lines below each line of a printed plan that holds ``node``."""
    rows = [(len(re.match(r"[ :+*|-]*", line)[0]), line) for line in plan.splitlines()]
    for i, (depth, line) in enumerate(rows):
        if node in line:
            end = next((j for j in range(i + 1, len(rows)) if rows[j][0] <= depth), len(rows))
            yield "\n".join(r for _, r in rows[i + 1 : end])


def test_only_hot_rows_are_shuffled(spark, lake, sorted_joins, capsys):
    f, p = stored(spark, lake, 400)
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    joins.join_stored(f, p, bucketed.HOT).explain()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    plan = capsys.readouterr().out
    below = list(subtrees(plan, "Exchange hashpartitioning"))
    # either the marked rows alone, or what a semi join with their keys leaves
    assert below and all("LeftSemi, BuildRight" in part or "quente#" in part and "= 1" in part for part in below)
    assert "LeftAnti, BuildRight" in plan


def test_hot_rows_are_spread_over_tasks_and_others_keep_one_file_a_bucket(spark, lake):
    stored(spark, lake, 4000)
    of = lambda hot: [r.path for r in spark.read.format("binaryFile").option("recursiveFileLookup", True).load(lake.trusted(PAGAMENTOS)).select("path").collect() if "dt_proc=a" in r.path and f"quente={hot}" in r.path and "ref=202402" in r.path]
    assert len(of(1)) >= 3
    buckets = [re.search(r"_(\d{5})\.", path).group(1) for path in of(0)]
    assert len(buckets) == len(set(buckets)) <= BUCKETS


def test_hot_keys_are_fewer_than_buckets(spark):
    rows = spark.range(10_000).selectExpr("id % 7 as id_cliente", "if(id % 3 = 0, 1, id % 5) as id_fatura")
    for buckets in (2, 5, 40, 1000):
        assert bucketed.hot_keys(rows, buckets).count() < buckets
    assert bucketed.hot_keys(rows.limit(0), 4).count() == 0


def test_tables_are_bucketed_in_one_way_or_not_at_all(spark, lake):
    stored(spark, lake, 0)
    rows = trusted_faturas(faturas(spark), "z")
    with pytest.raises(ValueError, match="not 5"):
        bucketed.write_trusted_bucketed(rows, FATURAS, lake.trusted(FATURAS), "z", 5)
    with pytest.raises(ValueError, match="is bucketed"):
        tables.write_trusted(rows, lake.trusted(FATURAS), "z")
    tables.write_trusted(rows, lake.root + "/plain", "z")
    with pytest.raises(ValueError, match="not bucketed"):
        bucketed.scan_trusted_bucketed(spark, FATURAS, lake.root + "/plain")
    with pytest.raises(ValueError, match="None"):
        bucketed.write_trusted_bucketed(rows, FATURAS, lake.root + "/plain", "z", 5)


def test_tasks_of_a_write_grow_with_the_rows(spark, lake, monkeypatch):
    """A task of a write has a bucket in some months, so that a month still has a file a bucket, and a join's bucket stays small."""
    monkeypatch.setattr(bucketed, "TASK_ROWS", 20)
    rows = [(f"FAT-{i}", str(i % 9), f"2024-{i % 12 + 1:02d}-05", "2024-03-15", f"{i}.00", "1.00") for i in range(600)]
    typed = trusted_faturas(spark.createDataFrame(rows, RAW_FATURA), "a")
    assert bucketed.write_trusted_bucketed(typed, FATURAS, lake.trusted(FATURAS), "a", BUCKETS) == 600
    stored = bucketed.scan_trusted_bucketed(spark, FATURAS, lake.trusted(FATURAS))
    assert rows_of(stored.select(*typed.columns)) == rows_of(typed)
    files = [f.split("/") for f in stored.inputFiles()]
    assert len({(f[-2], f[-5], f[-1].split("_")[-1]) for f in files}) == len(files)  # by hot, month and bucket
    assert len({f[-1].split("-")[1] for f in files}) > BUCKETS  # by the number of the task


def test_buckets_grow_with_the_rows():
    most = bucketed.BUCKET_ROWS
    assert [bucketed.buckets_for(n, 8) for n in (0, 8 * most, 8 * most + 1, 100 * most)] == [8, 8, 16, 128]
