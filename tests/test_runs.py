"""Which runs a reader finds at any moment."""

import shutil
from pathlib import Path

import pytest

from mensario.operators.trusted import trusted_faturas
from mensario.schemas import RAW_FATURA
from mensario.sources import runs, tables
from mensario.sources.tables import APPEND, REPLACE_MONTHS, scan_faturas, write_trusted


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "t")


def write(spark, path, months, dt_proc, mode=APPEND, n=10):
    rows = [(f"FAT-{i}", str(i), m and f"{m}-05", f"{m}-20", "1.00", "0.10") for m in months for i in range(n)]
    write_trusted(trusted_faturas(spark.createDataFrame(rows, RAW_FATURA), dt_proc), path, dt_proc, mode)


def found(spark, path):
    return {(r.ref, r.dt_proc): r["count"] for r in scan_faturas(spark, path).groupBy("ref", "dt_proc").count().collect()}


def between(spark, path, monkeypatch, step, read, *args):
    """What ``read`` gives before and after ``step`` of a write, which then goes on."""
    real, seen = getattr(runs, step), []

    def watched(*given, **named):
        seen.append(read())
        result = real(*given, **named)
        seen.append(read())
        return result

    monkeypatch.setattr(runs, step, watched)
    write(spark, path, *args)
    monkeypatch.undo()
    return seen


def test_a_reader_finds_one_run_before_and_after_the_record(spark, path, monkeypatch):
    write(spark, path, ["2024-01", "2024-02"], "a")
    before = {("202401", "a"): 10, ("202402", "a"): 10}
    after = {("202401", "a"): 10, ("202402", "b"): 7}
    read = lambda: found(spark, path)
    seen = between(spark, path, monkeypatch, "record", read, ["2024-02"], "b", REPLACE_MONTHS, 7)
    # the files of both are there, and only one of them counts
    assert seen == [before, after]
    assert {p.parent.name for p in Path(path).glob("ref=202402/dt_proc=*/tentativa=*")} == {"dt_proc=a", "dt_proc=b"}
    assert found(spark, path) == after
    # the next run removes what the one before it hid, and still a reader finds one run
    seen = between(spark, path, monkeypatch, "remove_hidden", read, ["2024-03"], "c")
    assert seen == [after, after]
    assert {p.parent.name for p in Path(path).glob("ref=202402/dt_proc=*/tentativa=*")} == {"dt_proc=b"}


def test_a_repeated_stamp_counts_once_at_every_moment(spark, path, monkeypatch):
    write(spark, path, ["2024-01", "2024-02"], "a", n=5)
    read = lambda: found(spark, path)
    seen = between(spark, path, monkeypatch, "record", read, ["2024-02"], "a", APPEND, 9)
    assert seen == [{("202401", "a"): 5, ("202402", "a"): 5}, {("202402", "a"): 9}]


def test_a_plan_made_before_a_run_keeps_seeing_the_runs_before_it(spark, path):
    write(spark, path, ["2024-01"], "a")
    earlier = scan_faturas(spark, path)
    write(spark, path, ["2024-01"], "b", REPLACE_MONTHS, 3)
    assert earlier.count() == 10 and scan_faturas(spark, path).count() == 3


def test_rows_of_a_run_without_a_record_do_not_count_and_go(spark, path, monkeypatch):
    write(spark, path, ["2024-01"], "a")

    def lost(*args, **kwargs):
        raise RuntimeError("lost")

    monkeypatch.setattr(runs, "record", lost)
    with pytest.raises(RuntimeError, match="lost"):
        write(spark, path, ["2024-01"], "b")
    monkeypatch.undo()
    assert found(spark, path) == {("202401", "a"): 10}
    assert len(list(Path(path).glob("ref=202401/dt_proc=b/tentativa=*"))) == 1
    write(spark, path, ["2024-02"], "c")  # another run leaves it, it may still be at work
    assert len(list(Path(path).glob("ref=202401/dt_proc=b/tentativa=*"))) == 1
    write(spark, path, ["2024-01"], "b", n=4)
    assert found(spark, path) == {("202401", "a"): 10, ("202401", "b"): 4, ("202402", "c"): 10}
    assert len(list(Path(path).glob("ref=202401/dt_proc=b/tentativa=*"))) == 1


def test_rows_without_a_month_and_runs_without_rows(spark, path):
    write(spark, path, [None, "2024-01"], "a")
    assert found(spark, path) == {(None, "a"): 10, ("202401", "a"): 10}
    write(spark, path, [None], "b", REPLACE_MONTHS, 2)
    assert found(spark, path) == {(None, "b"): 2, ("202401", "a"): 10}
    write(spark, path, [], "b", REPLACE_MONTHS)
    assert found(spark, path) == {("202401", "a"): 10}
    assert runs.remove_hidden(spark, path) == 1
    assert found(spark, path) == {("202401", "a"): 10}


def test_versions_change_with_a_month_alone(spark, path):
    write(spark, path, ["2024-01", "2024-02"], "a")
    first = runs.versions(spark, path)
    write(spark, path, ["2024-02"], "b")
    second = runs.versions(spark, path)
    assert first["202401"] == second["202401"] and first["202402"] != second["202402"]
    assert runs.versions(spark, path + "x") == {}


def test_only_folders_that_count_are_read(spark, path):
    for stamp in "abc":
        write(spark, path, ["2024-01"], stamp, REPLACE_MONTHS)
    assert len(list(Path(path).glob("ref=202401/dt_proc=*/tentativa=*"))) == 2
    scan = scan_faturas(spark, path).select("id_fatura")
    assert scan.count() == 10
    scan.collect()
    leaf = scan._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    assert leaf.metrics().apply("numFiles").value() == len(list(Path(path).glob("ref=202401/dt_proc=c/tentativa=*/*.parquet")))


def test_a_table_nobody_has_written_is_an_error_and_an_empty_one_is_not(spark, path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        scan_faturas(spark, path).count()
    write(spark, path, [], "a")
    assert scan_faturas(spark, path).count() == 0
    assert tables.scan_stage(spark, path + "x", missing_ok=True).count() == 0


def test_records_survive_the_removal_of_files(spark, path):
    write(spark, path, ["2024-01"], "a")
    write(spark, path, ["2024-01"], "b", REPLACE_MONTHS, 3)
    assert runs.remove_hidden(spark, path) == 1 and runs.remove_hidden(spark, path) == 0
    assert found(spark, path) == {("202401", "b"): 3}
    shutil.rmtree(f"{path}/_execucoes")
    assert found(spark, path) == {}
