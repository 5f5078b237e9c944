"""Column expressions over object paths `<dataset>_<yyyy-mm>/<file>`."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from registra.config import IN_PROGRESS_SUFFIXES

# Matched against the last folder and file name only: these run per row of an archive scan,
# where a search along the whole path costs more than parsing the line.
ROUTE = r"^([^/]+)_(\d{4}-\d{2})/[^/]+$"


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def folder(path: Column) -> Column:
    return F.left(path, F.length(path) - F.length(file_name(path)) - 1)


def _route(path: Column, group: int) -> Column:
    found = F.regexp_extract(F.substring_index(path, "/", -2), ROUTE, group)
    return F.nullif(found, F.lit(""))


def dataset(path: Column) -> Column:
    return _route(path, 1)


def ref_month(path: Column) -> Column:
    return _route(path, 2)


def apart_from_month(below: Column) -> Column:
    """A path below a root without its last folder, `<dataset>_<yyyy-mm>`: `E1.zip`, `lote2/E1.zip`."""
    return F.regexp_replace(below, r"[^/]+/([^/]+)$", "$1")


def whole_mib(length: Column) -> Column:
    return F.shiftright(length, 20)


def in_progress(path: Column) -> Column:
    first, *rest = IN_PROGRESS_SUFFIXES
    found = path.endswith(first)
    for suffix in rest:
        found = found | path.endswith(suffix)
    return found
