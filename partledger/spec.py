"""Dataset descriptions and the fixed vocabulary of the control tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Federative units, in alphabetical order.
UFS = (
    "AC", "AL", "AM", "AP", "BA", "CE", "DF", "ES", "GO", "MA", "MG", "MS", "MT", "PA",
    "PB", "PE", "PI", "PR", "RJ", "RN", "RO", "RR", "RS", "SC", "SE", "SP", "TO",
)

# Why a partition is pending.
NEW, ALTERED, WINDOW = "novo", "alterado", "janela"

# Outcome of comparing row counts.
OK, DIVERGENT, SOURCE_UNREADABLE, NO_PARQUET = "ok", "divergente", "ftp-ilegivel", "sem-parquet"

# Situation of a published provenance document.
CURRENT, UNREADABLE, LEGACY, ABSENT = "atual", "ilegivel", "legado", "ausente"

# Outcome of emitting provenance for a partition.
WRITTEN, BEFORE_RECORD, FAILED = "escrito", "anterior-ao-registro", "falhou"

# Why a candidate of the retroactive provenance run is skipped.
SKIP_NOT_LISTED = "ausente no FTP"
SKIP_REWRITTEN = "fonte reescrita depois do archive"
SKIP_ROW_COUNT = "linhas diferentes do cabeçalho dos DBCs"
SKIP_MTIME = "mtime do FTP ilegível"
SKIP_NO_STATE = "sem entrada no state"
SKIP_SIZE = "tamanho diferente do state"

# Hash of zero bytes, file and document names, format versions.
EMPTY_SHA256 = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
PARQUET_FILE = "part.parquet"
PROVENANCE_FILE = "part.provenance.json"
SOURCES_FILE = "part.sources.json"
SOURCES_VERSION = 1
FINGERPRINT_VERSION = "v1"
CONVERSION_NOTES = "Conversão 1:1 DBC→Parquet, sem filtro, sem enriquecimento."

REVISION_WINDOW = 12
MIN_SOURCE_AGE_HOURS = 24
MULTIPART_BYTES = 8 * 1024 * 1024
ROW_GROUP_ROWS = 100_000
DEFAULT_BUDGET_BYTES = 20 * 10**9

VARIANTS = tuple(chr(c) for c in range(ord("a"), ord("z") + 1))

KEY = ["uf", "ano", "mes"]


@dataclass(frozen=True)
class DatasetSpec:
    """What distinguishes one dataset of the archive from another.

    ``name_fields`` lists, in order, the parts of a source file name after
    ``prefix``: ``uf``, ``yy``/``yyyy``, ``mm``, ``variant`` or ``agravo``.
    """

    name: str
    prefix: str
    source_dir: str
    name_fields: tuple[str, ...]
    partition_cols: tuple[str, ...]
    sort_cols: tuple[str, ...]
    numeric_cols: tuple[str, ...] = ()
    infix: str = ""
    extension: str = "dbc"

    @property
    def name_pattern(self) -> str:
        """Anchored pattern with one capture group per entry of ``name_fields``."""
        part = {
            "uf": "([A-Z]{2})",
            "agravo": "([A-Z]{4})",
            "yy": r"([0-9]{2})",
            "yyyy": r"([0-9]{4})",
            "mm": r"([0-9]{2})",
            "variant": f"([{VARIANTS[0]}-{VARIANTS[-1]}]?)",
        }
        groups = [part[f] for f in self.name_fields]
        if self.infix:
            groups.insert(1, self.infix)
        return rf"^{self.prefix}{''.join(groups)}\.{self.extension}\z"

    def record_schema(self, columns: list[str]) -> T.StructType:
        """Explicit ingest schema: codes stay strings, only documented quantities are numbers."""
        return T.StructType(
            [
                T.StructField(c, T.LongType() if c in self.numeric_cols else T.StringType())
                for c in columns
            ]
        )


DATASETS = {
    s.name: s
    for s in (
        DatasetSpec(
            name="sia-pa",
            prefix="PA",
            source_dir="/dissemin/publicos/SIASUS/200801_/Dados",
            name_fields=("uf", "yy", "mm", "variant"),
            partition_cols=("ano", "uf", "mes"),
            sort_cols=("PA_CMP", "PA_CODUNI"),
            numeric_cols=("PA_IDADE", "PA_QTDPRO", "PA_QTDAPR", "PA_VALPRO", "PA_VALAPR"),
        ),
        DatasetSpec(
            name="sih-rd",
            prefix="RD",
            source_dir="/dissemin/publicos/SIHSUS/200801_/Dados",
            name_fields=("uf", "yy", "mm"),
            partition_cols=("ano", "uf", "mes"),
            sort_cols=("CNES", "N_AIH"),
            numeric_cols=("IDADE", "DIAS_PERM", "VAL_TOT"),
        ),
        DatasetSpec(
            name="sim",
            prefix="DO",
            source_dir="/dissemin/publicos/SIM/CID10/DORES",
            name_fields=("uf", "yyyy"),
            partition_cols=("ano", "uf"),
            sort_cols=("CAUSABAS", "NUMERODO"),
        ),
        DatasetSpec(
            name="sinasc",
            prefix="DN",
            source_dir="/dissemin/publicos/SINASC/NOV/DNRES",
            name_fields=("uf", "yyyy"),
            partition_cols=("ano", "uf"),
            sort_cols=("CODMUNNASC", "NUMERODN"),
            numeric_cols=("PESO", "SEMAGESTAC", "CONSPRENAT", "APGAR5"),
        ),
        DatasetSpec(
            name="sinan",
            prefix="",
            source_dir="/dissemin/publicos/SINAN/DADOS/FINAIS",
            name_fields=("agravo", "yy"),
            infix="BR",
            partition_cols=("agravo", "ano"),
            sort_cols=("SEM_NOT", "SG_UF_NOT"),
        ),
        DatasetSpec(
            name="cnes-st",
            prefix="ST",
            source_dir="/dissemin/publicos/CNES/200508_/Dados/ST",
            name_fields=("uf", "yy", "mm"),
            partition_cols=("ano", "uf", "mes"),
            sort_cols=("COMPETEN", "CNES"),
        ),
    )
}

SIA_PA = DATASETS["sia-pa"]
