"""Headers of very many and of very large files, deliveries of both subjects in one folder."""

import bz2
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from mensario.plans import monthly
from mensario.schemas import RAW_FATURA, RAW_PAGAMENTO
from mensario.sources import files
from mensario.sources.files import Delivery, MissingColumn, headers, list_files, scan_csv, to_files
from mensario.streaming import landing
from verification import fixtures as fx

FATURAS, PAGAMENTOS = monthly.SUBJECTS
COLUMNS = RAW_FATURA.fieldNames()
HEADER = ",".join(COLUMNS)


def row(number):
    return f"FAT-{number},7,2024-01-05,2024-01-15,1.00,0.10\n"


def found(spark, folder, **options):
    return headers(spark, to_files(list_files(spark, str(folder), **options)))


def driver_calls(spark, monkeypatch):
    """Names of the driver's calls on Hadoop file systems and streams."""
    calls = []
    gateway = spark.sparkContext._gateway
    send = gateway._gateway_client.send_command

    def counted(command, *args, **kwargs):
        calls.append(command)
        return send(command, *args, **kwargs)

    monkeypatch.setattr(gateway._gateway_client, "send_command", counted)
    return calls


def test_ten_thousand_small_files_need_no_call_each(spark, lake, tmp_path, monkeypatch):
    source, n = tmp_path / "in", 10_000
    source.mkdir()
    turned = ",".join(reversed(COLUMNS))
    for i in range(n):
        if i % 2:
            (source / f"{i}.csv").write_text(f"{HEADER}\n{row(i)}")
        else:
            (source / f"{i}.csv").write_text(f"{turned}\n0.10,1.00,2024-01-15,2024-01-05,7,FAT-{i}\n")
    listing = to_files(list_files(spark, str(source)))
    calls = driver_calls(spark, monkeypatch)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup
    spark.sparkContext.setJobGroup("headers", "headers")
    by_header = headers(spark, listing)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    monkeypatch.undo()
    assert sorted(map(len, by_header.values())) == [n // 2, n // 2]
    # paths are handed over one by one to the reader, but none is opened or asked for its status from here
    assert not any("FileSystem" in c or "BufferedReader" in c or "getFileStatus" in c for c in calls)
    assert len(jobs("headers")) <= 3  # two of them may be Spark's own parallel listing
    landing.land_files(spark, lake, FATURAS, str(source))
    rows = landing.scan_raw(spark, lake, FATURAS)
    assert rows.count() == n == rows.select("id_fatura").distinct().count()
    assert {tuple(r)[1:] for r in rows.collect()} == {("7", "2024-01-05", "2024-01-15", "1.00", "0.10")}
    # folders are as many as batches, files far fewer than source files
    stored = Path(lake.raw_data(FATURAS))
    assert [f.name for f in stored.iterdir()] == ["lote=s000000000"]
    assert len(list(stored.rglob("*.parquet"))) < n / 20


def test_small_and_large_files_give_their_first_line_that_is_not_blank(spark, tmp_path, monkeypatch):
    source, rng = tmp_path / "in", random.Random(1)
    source.mkdir()
    want = {}
    for i in range(60):
        head, lines = f"{HEADER},x{i % 7}", "".join(row(j) for j in range(rng.randrange(400)))
        text = "\n" * (i % 3) + (" \t\n" if i % 4 == 0 else "") + ("﻿" if i % 5 == 0 else "") + head + ("\r\n" if i % 2 else "\n") + lines
        if i % 6 == 5:
            (source / f"{i}.csv.bz2").write_bytes(bz2.compress(text.encode()))
        else:
            (source / f"{i}.csv").write_text(text, newline="")
        want.setdefault(head, set()).add(f"{i}.")
    (source / "blank.csv").write_text("\n \n")
    for small in (files.SMALL_FILE, 5000, 0):
        monkeypatch.setattr(files, "SMALL_FILE", small)
        got = {h: {Path(f.path).name.split(".")[0] + "." for f in group} for h, group in found(spark, source).items()}
        assert got == want


def test_a_large_file_is_not_read_behind_its_header(spark, tmp_path, monkeypatch):
    source = tmp_path / "in"
    source.mkdir()
    body = "".join(map(row, range(500_000)))
    for i in range(3):
        (source / f"{i}.csv").write_text(f"{HEADER},x{i}\n{body}")
    assert body and (source / "0.csv").stat().st_size > files.SMALL_FILE
    listing = to_files(list_files(spark, str(source)))
    lines = files._first_lines(spark, listing, files._ALONE, files._ALONE, True)
    assert lines.rdd.getNumPartitions() == 3
    assert {r.cabecalho for r in lines.collect()} == {f"{HEADER},x{i}" for i in range(3)}


def test_files_that_would_be_split_give_one_header(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for i in range(3):
        (source / f"{i}.csv").write_text(HEADER + "\n" + "".join(map(row, range(15_000))))
    assert 500_000 < (source / "0.csv").stat().st_size < files.SMALL_FILE
    assert [(h, len(group)) for h, group in found(spark, source).items()] == [(HEADER, 3)]
    assert scan_csv(spark, FATURAS, str(source)).count() == 45_000


def test_names_with_pattern_letters(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for name in ("a[1].csv", "a{b}.csv", "a?.csv", "a*.csv", "a b.csv", "a,b.csv", "á%20.csv"):
        (source / name).write_text(f"{HEADER}\n{row(1)}")
    assert sum(map(len, found(spark, source).values())) == 7
    assert scan_csv(spark, FATURAS, str(source)).count() == 7


def test_a_folder_with_both_subjects(spark, lake, tmp_path):
    source = tmp_path / "in"
    (source / "sub").mkdir(parents=True)
    (source / f"{FATURAS}_202401.csv").write_text(f"{HEADER}\n{row(1)}{row(2)}")
    (source / "sub" / f"{PAGAMENTOS}_202401.csv").write_text(",".join(RAW_PAGAMENTO.fieldNames()) + "\nPAG-FAT-1,FAT-1,7,2024-01-09,1.00\n")
    (source / "notes.csv").write_text("something,else\n1,2\n")
    with pytest.raises(MissingColumn):
        landing.land_files(spark, lake, FATURAS, str(source))
    for _ in range(2):
        monthly.ingest(spark, lake, monthly.mixed_delivery(str(source)))
        assert [landing.scan_raw(spark, lake, s).count() for s in monthly.SUBJECTS] == [2, 1]
    assert scan_csv(spark, FATURAS, str(source), name="tb_fat*").count() == 2
    monthly.ingest(spark, lake, {FATURAS: Delivery(str(source), "*_202402*"), PAGAMENTOS: Delivery(str(source), "*_202402*")})
    assert landing.scan_raw(spark, lake, FATURAS).count() == 2


def test_parts_keep_their_names_over_deliveries(spark, lake, tmp_path):
    source = str(tmp_path / "in")
    rows = spark.createDataFrame([(f"FAT-{i}", "1", "2024-01-05", "2024-01-15", "1.00", "0.10") for i in range(100)], RAW_FATURA)
    for amount in ("1.00", "2.00"):
        fx.deliver(spark, rows.withColumn("valor_fatura", F.lit(amount)), str(tmp_path / f"staging{amount}"), source, FATURAS, 4)
        names = sorted(p.name for p in Path(source).glob("*.csv"))
        assert names == [f"{FATURAS}-{i:05d}.csv" for i in range(4)]
        landing.land_files(spark, lake, FATURAS, source)
    landed = landing.scan_raw(spark, lake, FATURAS)
    assert landed.count() == 100 and landed.select("valor_fatura").distinct().collect() == [("2.00",)]
    assert landing.landed_files(spark, lake, FATURAS).count() == 8


def test_parts_of_a_delivery_grow_with_the_table(spark, tmp_path, monkeypatch):
    spark.range(1000).write.parquet(str(tmp_path / "orders.parquet"))
    assert fx.parts_of(spark, str(tmp_path), FATURAS) == fx.PARTS
    monkeypatch.setattr(fx, "PART_ROWS", 30)
    assert fx.parts_of(spark, str(tmp_path), FATURAS) == 34
