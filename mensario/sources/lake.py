"""Where things are in the lake."""

from __future__ import annotations

from dataclasses import dataclass

from mensario import fixed_values as fv

_TRUSTED_NAMES = {
    fv.SUBJECT_FATURAS: fv.TRUSTED_FATURAS,
    fv.SUBJECT_PAGAMENTOS: fv.TRUSTED_PAGAMENTOS,
}


def trusted_name(subject: str) -> str:
    return _TRUSTED_NAMES[subject]


@dataclass(frozen=True)
class Lake:
    """Folders below ``root``, any URI Spark can reach."""

    root: str

    def raw_data(self, subject: str) -> str:
        return f"{self.root}/0001_raw/{subject}/dados"

    def raw_control(self, subject: str) -> str:
        return f"{self.root}/0001_raw/{subject}/controle"

    @property
    def processed_files(self) -> str:
        return f"{self.root}/0000_control/arquivos_processados"

    def trusted(self, subject: str) -> str:
        return f"{self.root}/0002_trusted/{trusted_name(subject)}"

    def trusted_control(self, subject: str, dt_proc: str) -> str:
        return f"{self.root}/0000_control/ctl_processed_filenames/trusted/{subject}_{dt_proc}"

    @property
    def stage(self) -> str:
        return f"{self.root}/0003_refined/stage/stage_fatura"

    @property
    def book(self) -> str:
        return f"{self.root}/0003_refined/book_fatura"

    @property
    def states(self) -> str:
        return f"{self.root}/0003_refined/estados_fatura"
