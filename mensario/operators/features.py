"""The feature grid: which aggregates the book holds, and how they are numbered."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from mensario import fixed_values as fv
from mensario.functions.classify import window_flag_name

SUM, AVG, MIN, MAX = "sum", "avg", "min", "max"


@dataclass(frozen=True)
class Feature:
    """One column: ``agg`` of ``value`` over the rows of ``label`` inside ``flag``'s window."""

    name: str
    label_column: str
    label: str
    flag: str | None
    value: str
    agg: str
    cell: int


@dataclass(frozen=True)
class FeatureGrid:
    """Class labels x windows x values, each value with the aggregates that make sense for it.

    ``None`` among the windows stands for "all rows". A *cell* is one label in one window.
    """

    labels: tuple[tuple[str, str], ...]
    windows: tuple[int | None, ...]
    values: tuple[tuple[str, tuple[str, ...]], ...]

    @property
    def flags(self) -> tuple[str | None, ...]:
        return tuple(None if w is None else window_flag_name(w) for w in self.windows)

    @property
    def label_columns(self) -> tuple[str, ...]:
        return tuple(dict.fromkeys(column for column, _ in self.labels))

    def cell(self, label_index: int, window_index: int) -> int:
        return label_index * len(self.windows) + window_index

    def features(self) -> Iterator[Feature]:
        plan = (
            (li, column, label, value, wi, flag, agg)
            for li, (column, label) in enumerate(self.labels)
            for value, aggs in self.values
            for wi, flag in enumerate(self.flags)
            for agg in aggs
        )
        for number, (li, column, label, value, wi, flag, agg) in enumerate(plan, start=1):
            yield Feature(f"VAR_{number}", column, label, flag, value, agg, self.cell(li, wi))


BOOK_GRID = FeatureGrid(
    labels=tuple(
        [("fbc_classif_pagto", label) for label in fv.CLASSES_PAGTO]
        + [("fbc_classif_vlr_pagto", label) for label in fv.CLASSES_VLR_PAGTO]
    ),
    windows=(None, *fv.JANELAS_MESES),
    values=(
        ("fvl_vlr_fatura", (SUM, AVG, MIN, MAX)),
        ("fvl_qtd_transacao", (SUM,)),
        ("fvl_numero_dias_atraso", (AVG, MIN, MAX)),
        ("fvl_perc_vlr_fatura", (AVG, MIN, MAX)),
    ),
)
