"""Parameters of the registry pipeline."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# File format of the extracts and the default city and status.
FIELD_SEPARATOR = ";"
ENCODING = "ISO-8859-1"
SAO_PAULO = 7107
ACTIVE = 2
ARCHIVE_SUFFIX = ".zip"
IN_PROGRESS_SUFFIXES = (".crdownload", ".tmp")
FACTS_DATASET = "estabelecimentos"
LOOKUP_DATASET = "municipios"

# Assumed, not fixed: flag 1 marks a head office and flag 2 a branch.
KIND_LABELS = {"1": "matriz", "2": "filial"}

LOOKUP_SCHEMA = T.StructType(
    [
        T.StructField("municipio_cod", T.StringType(), True),
        T.StructField("municipio_nome", T.StringType(), True),
    ]
)


def text_schema(columns: int | list[str]) -> T.StructType:
    """All-string schema: `_c0.._c{n-1}` for a width, or the given names."""
    names = [f"_c{i}" for i in range(columns)] if isinstance(columns, int) else columns
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


@dataclass(frozen=True)
class ColumnMap:
    """Which raw columns hold the municipality, the status and the kind flag.

    The position of the kind flag is an assumption about the published layout.
    """

    municipality: str = "_c20"
    status: str = "_c5"
    kind: str = "_c3"


@dataclass(frozen=True)
class RunConfig:
    """One monthly run from archives to gold. Every path is `file:`, `hdfs:` or `s3a:`.

    `width` None takes the width of the facts from their first line. `codes` None keeps every
    city. `names` renames raw columns in silver; `columns` always uses the raw names.
    Without a `gold` path the counts are returned but not stored. `gold_by_city` counts each city for
    itself. With a `search` value the run also counts lookup rows, facts that hold the value in any
    column, and final rows, which reads all columns of the facts once more.
    """

    archives: str
    bronze: str
    silver: str
    ref_month: str
    gold: str | None = None
    width: int | None = None
    columns: ColumnMap = field(default_factory=ColumnMap)
    names: dict[str, str] = field(default_factory=dict)
    codes: tuple[int, ...] | None = (SAO_PAULO,)
    active: int = ACTIVE
    guard: str = "none"
    on_missing: str = "error"
    member_conflict: str = "all"
    unique_lookup: bool = False
    gold_by_city: bool = False
    search: str | None = None
    kind_labels: dict[str, str] = field(default_factory=lambda: dict(KIND_LABELS))
    storage_options: dict[str, str] = field(default_factory=dict)
