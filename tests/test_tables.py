import pytest
from py4j.protocol import Py4JJavaError
from pyspark.sql import functions as F

from mensario.operators.inspection import bounds, columns_of, in_period, months_present
from mensario.operators.trusted import trusted_faturas
from mensario.schemas import RAW_FATURA, TRUSTED_FATURA
from mensario.sources import control, tables
from mensario.sources.files import scan_csv
from mensario.sources.tables import (
    REPLACE_MONTHS,
    balance_by,
    scan_faturas,
    scan_parquet_or_empty,
    write_trusted,
)


def raw(spark, *months):
    rows = [(f"FAT-{i}", str(i % 7), f"{m}-0{i % 9 + 1}", f"{m}-20", f"{i}.50", "1") for m in months for i in range(40)]
    return spark.createDataFrame(rows, RAW_FATURA)


def stored(spark, path, *months, mode="append", dt_proc="a"):
    write_trusted(balance_by(trusted_faturas(raw(spark, *months), dt_proc), "ref"), path, dt_proc, mode)
    return scan_faturas(spark, path)


def plan_of(df, capsys):
    df.explain("formatted")
    return capsys.readouterr().out


def test_csv_scan_is_text_only_and_recursive(spark, tmp_path):
    raw(spark, "2024-01").write.option("header", True).csv(f"{tmp_path}/x/y")
    back = scan_csv(spark, "tb_faturas", str(tmp_path))
    assert back.schema == RAW_FATURA and back.count() == 40
    assert back.exceptAll(raw(spark, "2024-01")).isEmpty()


def test_a_run_repeated_under_its_stamp_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    for months in (("2024-01", "2024-02"), ("2024-02",)):
        rows = stored(spark, path, *months)
    assert rows.groupBy("ref", "dt_proc").count().collect() == [("202402", "a", 40)]


def test_append_adds_and_replace_swaps_only_its_months(spark, tmp_path):
    path = str(tmp_path / "t")
    stored(spark, path, "2024-01", "2024-02")
    again = stored(spark, path, "2024-02", dt_proc="b")
    assert again.groupBy("ref").count().orderBy("ref").collect() == [("202401", 40), ("202402", 80)]
    swapped = stored(spark, path, "2024-02", mode=REPLACE_MONTHS, dt_proc="c")
    assert {(r.ref, r.dt_proc): r["count"] for r in swapped.groupBy("ref", "dt_proc").count().collect()} == {
        ("202401", "a"): 40,
        ("202402", "c"): 40,
    }


def test_schema_survives_and_ref_stays_text(spark, tmp_path):
    df = stored(spark, str(tmp_path / "t"), "2024-01")
    assert columns_of(df) == [(f.name, f.dataType.simpleString()) for f in TRUSTED_FATURA]
    assert months_present(df).collect() == [("202401",)]


def test_period_prunes_partitions_and_columns(spark, tmp_path, period, capsys):
    path = str(tmp_path / "t")
    df = in_period(stored(spark, path, "2022-12", "2023-02", "2024-02", "2024-03"), period)
    assert bounds(df, "ref").first() == ("202402", "202302")
    plan = plan_of(df.select("id_cliente"), capsys)
    pruned = next(line for line in plan.splitlines() if "PartitionFilters" in line)
    assert "ref" in pruned and "202302" in pruned and "202402" in pruned
    assert "ReadSchema: struct<id_cliente:bigint>" in plan


def test_rows_without_a_month_are_outside_any_period(spark, period):
    rows = [("FAT-1", "1", None, None, "1", "1")]
    df = trusted_faturas(spark.createDataFrame(rows, RAW_FATURA), "a")
    assert df.count() == 1 and in_period(df, period).isEmpty()


def test_control_row_of_a_repeated_run_is_there_once(spark, tmp_path):
    for n in (39, 40):
        control.write_control(control.control_row(spark, "tb_0001_fatura", "x", n), str(tmp_path / "c"))
    assert control.scan_control(spark, str(tmp_path / "c")).collect() == [("tb_0001_fatura", "x", "40")]


def test_missing_table_is_empty_but_other_errors_are_not_hidden(spark, tmp_path):
    assert scan_parquet_or_empty(spark, TRUSTED_FATURA, str(tmp_path / "none")).isEmpty()
    with pytest.raises(Py4JJavaError):
        scan_parquet_or_empty(spark, TRUSTED_FATURA, "no-such-scheme://x")


@pytest.mark.parametrize("write", [tables.write_stage, tables.write_book])
def test_rows_of_one_month_are_written_without_a_sort(spark, tmp_path, write):
    rows = spark.range(100).selectExpr("id as id_cliente", "if(id < 0, 'x', '202402') as ref", "if(id < 0, 'y', 'a') as dt_proc", "id as v").repartition(2)

    def plan():
        store = spark._jsparkSession.sharedState().statusStore()
        found = store.executionsList()
        texts = [found.apply(i).physicalPlanDescription() for i in range(found.size())]
        return [t for t in texts if "InsertIntoHadoopFsRelationCommand" in t and "CollectMetrics" in t][-1]

    for ref, sorts in ((None, True), (F.lit("202402"), False)):
        path = str(tmp_path / f"{sorts}")
        assert write(rows, path, "a", ref=ref) == 100
        assert ("Sort" in plan()) == sorts
        assert sorted(map(tuple, spark.read.parquet(path).selectExpr("id_cliente", "cast(ref as string)", "dt_proc", "v").collect())) == [(i, "202402", "a", i) for i in range(100)]
