"""The reference date and the months the book looks back on."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from mensario import fixed_values as fv
from mensario.functions.parsing import year_month


@dataclass(frozen=True)
class Period:
    """``months`` back from ``ref_date``; both end months are inside."""

    ref_date: date
    months: int = fv.MESES_BOOK

    @property
    def day(self) -> Column:
        return F.lit(self.ref_date)

    @property
    def ref(self) -> Column:
        return year_month(F.lit(self.ref_date.isoformat()))

    @property
    def first_ref(self) -> Column:
        return F.date_format(F.add_months(self.day, -self.months), "yyyyMM")

    @property
    def months_covered(self) -> list[str]:
        """The months inside, first to last, as ``ref`` has them."""
        last = self.ref_date.year * 12 + self.ref_date.month - 1
        return [f"{n // 12:04d}{n % 12 + 1:02d}" for n in range(last - self.months, last + 1)]

    def covers(self, ref: str = "ref") -> Column:
        """Constant bounds once folded, so the condition prunes ``ref`` partitions."""
        return F.col(ref).between(self.first_ref, self.ref)


def processing_stamp(now: datetime | None = None) -> str:
    """yyyyMMddHHmmss, the dt_proc of a run."""
    return (now or datetime.now()).strftime("%Y%m%d%H%M%S")
