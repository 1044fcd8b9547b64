"""Landing, gates and whole runs on small files."""

import gzip
import os
import shutil
import time
from datetime import date
from pathlib import Path

import pyarrow.parquet as pq
import pytest

from mensario import __main__ as cli
from mensario import fixed_values as fv
from mensario.plans import monthly
from mensario.schemas import RAW_FATURA, RAW_PAGAMENTO
from mensario.sources import control, tables
from mensario.sources.files import MissingColumn, scan_csv
from mensario.streaming import landing

FATURAS, PAGAMENTOS = monthly.SUBJECTS


@pytest.fixture
def sources(spark, tmp_path):
    folders = {s: str(tmp_path / "source" / s) for s in monthly.SUBJECTS}
    deliver(spark, folders, "2024-01", range(30))
    return folders


def deliver(spark, folders, month, ids):
    faturas = [(f"FAT-{i}", str(i % 4), f"{month}-05", f"{month}-15", "100.00", "10.00") for i in ids]
    pagamentos = [(f"PAG-FAT-{i}", f"FAT-{i}", str(i % 4), f"{month}-{10 + i % 10}", "100.00") for i in ids if i % 3]
    for subject, rows, schema in ((FATURAS, faturas, RAW_FATURA), (PAGAMENTOS, pagamentos, RAW_PAGAMENTO)):
        df = spark.createDataFrame(rows, schema).coalesce(2)
        df.write.mode("append").option("header", True).csv(folders[subject])


def landed_rows(spark, lake, subject):
    return landing.scan_raw(spark, lake, subject).count()


def test_each_file_lands_once(spark, lake, sources):
    for _ in range(2):
        monthly.ingest(spark, lake, sources)
        assert (landed_rows(spark, lake, FATURAS), landed_rows(spark, lake, PAGAMENTOS)) == (30, 20)
    deliver(spark, sources, "2024-02", range(30, 40))
    monthly.ingest(spark, lake, sources)
    assert landed_rows(spark, lake, FATURAS) == 40
    files = landing.landed_files(spark, lake, FATURAS).collect()
    assert sum(f.qtd_registros for f in files) == 40
    assert {f.lote for f in files} == {"s000000000", "s000000001"}


def test_a_batch_that_failed_is_replaced_by_the_next_one(spark, lake, sources, monkeypatch):
    write = landing._write_batch

    def fails(rows, files, lake, subject, lote):
        write(rows, files, lake, subject, lote)
        shutil.rmtree(f"{lake.raw_control(subject)}/lote={lote}")
        raise RuntimeError("lost")

    monkeypatch.setattr(landing, "_write_batch", fails)
    with pytest.raises(RuntimeError, match="lost"):
        landing.land_files(spark, lake, FATURAS, sources[FATURAS])
    monkeypatch.undo()
    landing.land_files(spark, lake, FATURAS, sources[FATURAS])
    assert landed_rows(spark, lake, FATURAS) == 30
    assert sum(f.qtd_registros for f in landing.landed_files(spark, lake, FATURAS).collect()) == 30


HEADER = ",".join(RAW_FATURA.fieldNames())


def put(folder, name, text, age_days=0):
    path = Path(folder) / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(gzip.compress(text.encode()) if name.endswith(".gz") else text.encode())
    moment = time.time() - 86400 * age_days
    os.utime(path, (moment, moment))


def invoice(number, amount="1.00"):
    return f"FAT-{number},7,2024-01-05,2024-01-15,{amount},0.10\n"


def landed_amounts(spark, lake):
    return sorted((r.id_fatura, r.valor_fatura) for r in landing.scan_raw(spark, lake, FATURAS).collect())


def test_landing_takes_every_file(spark, lake, tmp_path):
    source = tmp_path / "in"
    put(source, "first.csv", f"{HEADER}\n{invoice(1)}")
    landing.land_files(spark, lake, FATURAS, str(source))
    put(source, "old.csv", f"{HEADER}\n{invoice(2)}", age_days=30)
    put(source, "upper.CSV", f"{HEADER}\n{invoice(3)}")
    put(source, "sub/deeper/first.csv", f"{HEADER}\n{invoice(4)}")
    put(source, "packed.csv.gz", f"{HEADER}\n{invoice(5)}")
    put(source, "no_ending [1]", f"{HEADER}\n{invoice(6)}")
    put(source, "header_only.txt", f"{HEADER}\n")
    put(source, "empty.csv", "")
    put(source, "_SUCCESS", "")
    for _ in range(2):
        landing.land_files(spark, lake, FATURAS, str(source))
        assert [x for x, _ in landed_amounts(spark, lake)] == [f"FAT-{i}" for i in range(1, 7)]
    counts = {Path(f.arquivo).name: f.qtd_registros for f in landing.landed_files(spark, lake, FATURAS).collect()}
    assert len(counts) == 6 and counts["header_only.txt"] == 0


def test_a_corrected_file_replaces_its_earlier_rows(spark, lake, tmp_path):
    source = tmp_path / "in"
    put(source, "a.csv", f"{HEADER}\n{invoice(1)}{invoice(2)}", age_days=1)
    put(source, "x/a.csv", f"{HEADER}\n{invoice(3)}", age_days=1)
    landing.land_files(spark, lake, FATURAS, str(source))
    put(source, "a.csv", f"{HEADER}\n{invoice(1, '9.00')}")
    landing.land_files(spark, lake, FATURAS, str(source))
    assert landed_amounts(spark, lake) == [("FAT-1", "9.00"), ("FAT-3", "1.00")]
    put(source, "a.csv", f"{HEADER}\n")
    landing.land_files(spark, lake, FATURAS, str(source))
    assert landed_amounts(spark, lake) == [("FAT-3", "1.00")]


def test_an_empty_delivery_opens_the_gate(spark, lake, tmp_path):
    put(tmp_path / "in", "a.csv", f"{HEADER}\n")
    landing.land_files(spark, lake, FATURAS, str(tmp_path / "in"))
    landing.require_pending(spark, lake, FATURAS)
    assert monthly.process(spark, lake, FATURAS, "x").rows == 0


def test_columns_come_by_header_name_and_a_missing_one_is_an_error(spark, lake, tmp_path):
    source = tmp_path / "in"
    put(source, "a.csv", "id_cliente,extra,ID_FATURA,valor_pagamento_minimo,valor_fatura,data_vencimento,data_emissao\n7,x,FAT-1,0.10,1.00,2024-01-15,2024-01-05\n")
    put(source, "b.csv", f"{HEADER}\n{invoice(2)}")
    landing.land_files(spark, lake, FATURAS, str(source))
    rows = sorted(tuple(r) for r in landing.scan_raw(spark, lake, FATURAS).collect())
    assert rows == [(f"FAT-{i}", "7", "2024-01-05", "2024-01-15", "1.00", "0.10") for i in (1, 2)]
    put(source, "c.csv", "id_fatura,id_cliente\n1,2\n")
    with pytest.raises(MissingColumn, match=r"c\.csv has no column data_emissao"):
        landing.land_files(spark, lake, FATURAS, str(source))


def test_values_are_landed_as_they_are(spark, lake, tmp_path):
    odd = ['" 7 "', " 2024-01-05", '"a,b"', "back\\slash", '""', "7"]
    put(tmp_path / "in", "a.csv", f"{HEADER}\n{','.join(odd)}\n")
    landing.land_files(spark, lake, FATURAS, str(tmp_path / "in"))
    source = scan_csv(spark, FATURAS, str(tmp_path / "in")).collect()
    assert landing.scan_raw(spark, lake, FATURAS).collect() == source
    assert tuple(source[0]) == (" 7 ", " 2024-01-05", "a,b", "back\\slash", source[0][4], "7")


def test_gate_opens_once_per_delivery_and_subject(spark, lake, sources):
    with pytest.raises(landing.NothingToProcess):
        landing.require_pending(spark, lake, FATURAS)
    monthly.ingest(spark, lake, sources)
    pending = landing.require_pending(spark, lake, FATURAS)
    landing.mark_processed(pending, lake, FATURAS, "x")
    with pytest.raises(landing.NothingToProcess):
        landing.require_pending(spark, lake, FATURAS)
    landing.require_pending(spark, lake, PAGAMENTOS)
    landing.require_pending(spark, lake, FATURAS, monthly.BOOK_CONSUMER)


def test_a_batch_landed_during_a_run_stays_pending(spark, lake, sources):
    monthly.ingest(spark, lake, sources)
    pending = landing.require_pending(spark, lake, FATURAS)
    deliver(spark, sources, "2024-02", range(30, 40))
    monthly.ingest(spark, lake, sources)
    landing.mark_processed(pending, lake, FATURAS, "x")
    assert {r.lote for r in landing.require_pending(spark, lake, FATURAS).collect()} == {"s000000001"}


def test_process_counts_what_it_wrote(spark, lake, sources):
    monthly.ingest(spark, lake, sources)
    run = monthly.process(spark, lake, PAGAMENTOS, "20240205080000")
    assert run.rows == 20 == tables.scan_pagamentos(spark, lake.trusted(PAGAMENTOS)).count()
    row = control.scan_control(spark, lake.trusted_control(PAGAMENTOS, "20240205080000")).collect()
    assert row == [(fv.TRUSTED_PAGAMENTOS, "20240205080000", "20")]
    with pytest.raises(landing.NothingToProcess):
        monthly.process(spark, lake, PAGAMENTOS)
    assert monthly.process(spark, lake, PAGAMENTOS, "later", gate=False).rows == 20
    with pytest.raises(landing.NothingToProcess):
        monthly.process(spark, lake, PAGAMENTOS, gate=False, only_pending=True)


def test_second_month_by_each_way_of_writing(spark, lake, sources):
    monthly.ingest(spark, lake, sources)
    monthly.process(spark, lake, FATURAS, "first")
    deliver(spark, sources, "2024-02", range(30, 40))
    monthly.ingest(spark, lake, sources)
    assert monthly.process(spark, lake, FATURAS, "second", only_pending=True).rows == 10
    trusted = tables.scan_faturas(spark, lake.trusted(FATURAS))
    assert trusted.groupBy("ref").count().orderBy("ref").collect() == [("202401", 30), ("202402", 10)]

    deliver(spark, sources, "2024-03", range(40, 45))
    monthly.ingest(spark, lake, sources)
    assert monthly.process(spark, lake, FATURAS, "third", mode=tables.REPLACE_MONTHS).rows == 45
    assert tables.scan_faturas(spark, lake.trusted(FATURAS)).count() == 45

    deliver(spark, sources, "2024-04", range(45, 46))
    monthly.ingest(spark, lake, sources)
    assert monthly.process(spark, lake, FATURAS, "fourth").rows == 46
    assert tables.scan_faturas(spark, lake.trusted(FATURAS)).count() == 91

    with pytest.raises(ValueError, match="all raw files"):
        monthly.process(spark, lake, FATURAS, mode=tables.REPLACE_MONTHS, only_pending=True)


def test_whole_run_and_rebuild(spark, lake, sources, period):
    book = monthly.run_month(spark, lake, sources, period, "20240205080000")
    assert book.count() == 4
    assert {(r.ref, r.dt_proc) for r in book.select("ref", "dt_proc").collect()} == {("202402", "20240205080000")}
    assert tables.scan_stage(spark, lake.stage).count() == 30
    with pytest.raises(landing.NothingToProcess):
        monthly.build_book(spark, lake, period, "again")
    again = monthly.build_book(spark, lake, period, "again", gate=False)
    assert again.drop("dt_proc").exceptAll(book.drop("dt_proc")).isEmpty() and again.count() == 4
    assert tables.scan_book(spark, lake.book).count() == 8


def test_checks_show_months_and_repeated_keys(spark, lake, sources, period):
    monthly.ingest(spark, lake, sources)
    for dt_proc in ("first", "second"):
        for subject in monthly.SUBJECTS:
            monthly.process(spark, lake, subject, dt_proc, gate=False)
    checks = monthly.book_checks(spark, lake, period)
    of = lambda text: [df for title, df in checks.items() if text in title]
    assert [c.first() for c in of("in the period")] == [("202401", "202401")] * 2
    assert [c.collect() for c in of("months present")] == [[("202401",)]] * 2
    assert [(c.count(), c.first().qtd) for c in of("more than once")] == [(30, 2), (20, 2)]
    assert [c.count() for c in of("a few rows")] == [5, 5] and of("columns")[0].first() == ("id_fatura", "bigint")
    assert of("stage")[0].first() == (None, None)


STEPS = ("write_trusted", "write_control", "mark_processed", "write_stage", "write_book")


@pytest.mark.parametrize("step", STEPS)
@pytest.mark.parametrize("after", [False, True])
def test_a_run_that_failed_is_repeated_to_the_same_lake(spark, lake, sources, period, monkeypatch, step, after):
    real, calls = getattr(monthly, step), []

    def fails(*args, **kwargs):
        calls.append(1)
        if len(calls) < 2 and step.startswith(("write_s", "write_b")) or len(calls) == 2:
            if after:
                real(*args, **kwargs)
            raise RuntimeError("lost")
        return real(*args, **kwargs)

    monkeypatch.setattr(monthly, step, fails)
    with pytest.raises(RuntimeError, match="lost"):
        monthly.run_month(spark, lake, sources, period, "20240205080000")
    monkeypatch.undo()
    book = monthly.run_month(spark, lake, sources, period, "20240205080000")
    assert book.count() == 4 and book.agg({"VAR_67": "count"}).first() is not None
    assert [tables.scan_trusted(spark, s, lake.trusted(s)).count() for s in monthly.SUBJECTS] == [30, 20]
    assert tables.scan_stage(spark, lake.stage).count() == 30
    assert tables.scan_book(spark, lake.book).count() == 4
    assert monthly.run_month(spark, lake, sources, period, "20240205080000").count() == 4
    assert tables.scan_book(spark, lake.book).count() == 4


def test_replacing_leaves_one_run_a_month_in_stage_and_book(spark, lake, sources, period):
    monthly.run_month(spark, lake, sources, period, "d1")
    monthly.build_book(spark, lake, period, "d2", tables.REPLACE_MONTHS, gate=False)
    for stored in (tables.scan_stage(spark, lake.stage), tables.scan_book(spark, lake.book)):
        assert [r.dt_proc for r in stored.select("dt_proc").distinct().collect()] == ["d2"]


def test_the_stored_book_has_bloom_filters_and_skips_row_groups(spark, tmp_path):
    rows = spark.range(200_000).selectExpr("id * 2 as id_cliente", "'202402' as ref", "'x' as dt_proc", "id as v").repartition(4)
    spark.conf.set("parquet.block.size", str(64 * 1024))
    try:
        tables.write_book(rows, str(tmp_path / "b"), "x")
    finally:
        spark.conf.unset("parquet.block.size")
    meta = [pq.ParquetFile(f).metadata for f in (tmp_path / "b").rglob("*.parquet")]
    assert sum(m.num_row_groups for m in meta) > 4
    stored = spark.read.parquet(str(tmp_path / "b"))

    def read_rows(df):
        df.collect()
        scans = df._jdf.queryExecution().executedPlan().collectLeaves()
        return scans.apply(0).metrics().apply("numOutputRows").value()

    assert read_rows(stored.where("id_cliente = 1001")) < 100_000 < read_rows(stored.where("v >= 0"))


def test_command_line_runs_the_same_steps(spark, lake, sources, capsys):
    cli.main(["ingest", "--lake", lake.root, "--faturas", sources[FATURAS], "--pagamentos", sources[PAGAMENTOS]])
    cli.main(["process", FATURAS, "--lake", lake.root, "--dt-proc", "x"])
    cli.main(["process", PAGAMENTOS, "--lake", lake.root, "--dt-proc", "x"])
    cli.main(["check", "--lake", lake.root, "--ref-date", "2024-02-01"])
    shown = capsys.readouterr().out
    assert "202401" in shown and "more than once: 0 rows" in shown
    cli.main(["book", "--lake", lake.root, "--ref-date", "2024-02-01", "--dt-proc", "x"])
    assert tables.scan_book(spark, lake.book).count() == 4
    cli.main(["book", "--lake", lake.root, "--ref-date", date(2024, 1, 1).isoformat(), "--force", "--dt-proc", "y"])
    assert {r.ref for r in tables.scan_book(spark, lake.book).select("ref").collect()} == {"202402", "202401"}
