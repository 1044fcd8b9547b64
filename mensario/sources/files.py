"""Source files: listing, headers, and CSV bound by header names.

A file is read under the names of its own header, so column order and extra columns
do not matter. Headers are read by tasks, many small files in one of them and a large
file only as far as its header; the driver makes no call for a single file. It holds the
listing, as any read of files does, and of it what each header's files are.
"""

from __future__ import annotations

import csv
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mensario.schemas import RAW

#: Files up to so many bytes share a task and are read whole for their header; a larger one has a task of its own, which stops behind it.
SMALL_FILE = 1 << 20
#: Bytes of small files in a task; each counts as its own and those of the largest.
SMALL_TASK = 64 << 20
#: More than any file has: files that count as so many bytes get a task each, and are not split.
_ALONE = 1 << 42
#: A line of these alone is blank to the reader of CSV.
_BLANK = "".join(map(chr, range(33)))


class MissingColumn(ValueError):
    """A source file lacks a column its subject needs."""


@dataclass(frozen=True)
class SourceFile:
    """``path`` is what a reader takes, ``arquivo`` what rows call their file."""

    path: str
    arquivo: str
    modificado: datetime
    tamanho: int


@dataclass(frozen=True)
class Delivery:
    """A folder and what the names of a subject's files in it match, as a glob pattern; by default all of them."""

    folder: str
    name: str = "*"


def list_files(spark: SparkSession, *folders: str, name: str = "*") -> DataFrame:
    """(path, arquivo, modificado, tamanho) of every file below whose name matches, whatever its age; hidden and
    marker files are left out, and so are files of no bytes, which hold not even a header."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if name != "*":
        reader = reader.option("pathGlobFilter", name)
    return reader.load(list(folders)).select(
        "path",
        F.col("_metadata.file_path").alias("arquivo"),
        F.col("_metadata.file_modification_time").alias("modificado"),
        F.col("_metadata.file_size").alias("tamanho"),
    )


def _literal(path: str) -> str:
    """``path`` as a pattern that matches it alone."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def _first_lines(spark: SparkSession, files: list[SourceFile], task_bytes: int, open_bytes: int, alone: bool) -> DataFrame:
    # A session of its own, for how files are dealt to tasks is a setting of the session.
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", str(task_bytes))
    session.conf.set("spark.sql.files.openCostInBytes", str(open_bytes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told = set()
        for batch in batches:
            names, lines = batch.column(0).dictionary_encode(), batch.column(1)
            number = names.indices.to_numpy()
            begins = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), len(number)]
            for begin, end in zip(begins[:-1], begins[1:]):
                file = names.dictionary[int(number[begin])].as_py() if end else None
                for i in range(begin, end) if file not in told else ():
                    line = lines[i].as_py().removeprefix("\ufeff")
                    if line.strip(_BLANK):
                        told.add(file)
                        yield pa.RecordBatch.from_arrays([pa.array([file]), pa.array([line])], names=["arquivo", "cabecalho"])
                        break
            if alone and told:
                return

    text = session.read.text([_literal(f.path) for f in files]).where("_metadata.file_block_start = 0")
    return text.select("_metadata.file_path", "value").mapInArrow(run, "arquivo string, cabecalho string")


def headers(spark: SparkSession, files: Iterable[SourceFile]) -> dict[str, list[SourceFile]]:
    """The files of each header: the first line that is not blank, as the reader of CSV takes it. Files without one are left out.

    Packed files are unpacked if their ending names a codec. One job for the small files, one for the large.
    """
    files = list(files)
    of = {f.arquivo: f for f in files}
    small = [f for f in files if f.tamanho <= SMALL_FILE]
    large = [f for f in files if f.tamanho > SMALL_FILE]
    found: dict[str, list[SourceFile]] = defaultdict(list)
    for group, deal in ((small, (SMALL_TASK, SMALL_FILE + 1, False)), (large, (_ALONE, _ALONE, True))):
        for row in _first_lines(spark, group, *deal).collect() if group else ():
            found[row["cabecalho"]].append(of[row["arquivo"]])
    return {header: sorted(mine, key=lambda f: f.path) for header, mine in sorted(found.items())}


def _names(header: str) -> list[str]:
    return [name.strip().lower() for name in next(csv.reader([header]), [])]


def read_by_header(spark: SparkSession, subject: str, files: Iterable[SourceFile]) -> DataFrame:
    """The subject's columns, as text, and ``arquivo``. One read per distinct header.

    ``MissingColumn`` names a file that lacks one. An empty file has no rows.
    """
    wanted = RAW[subject].fieldNames()
    parts = []
    for header, group in headers(spark, files).items():
        names = _names(header)
        missing = [name for name in wanted if name not in names]
        if missing:
            raise MissingColumn(f"{group[0].path} has no column {', '.join(missing)}")
        schema = T.StructType(
            [T.StructField(n if n in wanted and names.index(n) == i else f"_c{i}", T.StringType()) for i, n in enumerate(names)]
        )
        rows = spark.read.schema(schema).option("header", True).csv([_literal(file.path) for file in group])
        parts.append(rows.select(*wanted, F.col("_metadata.file_path").alias("arquivo")))
    if not parts:
        return spark.createDataFrame([], T.StructType([*RAW[subject].fields, T.StructField("arquivo", T.StringType())]))
    return reduce(DataFrame.unionByName, parts)


def to_files(listing: DataFrame) -> list[SourceFile]:
    """To the driver: one line a file."""
    return [SourceFile(*row) for row in listing.select("path", "arquivo", "modificado", "tamanho").orderBy("path").collect()]


def scan_csv(spark: SparkSession, subject: str, *paths: str, name: str = "*") -> DataFrame:
    """All CSV files below ``paths`` whose names match, sub-folders included, columns by header name; every column is text."""
    return read_by_header(spark, subject, to_files(list_files(spark, *paths, name=name))).drop("arquivo")
