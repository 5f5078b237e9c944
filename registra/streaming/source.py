"""Archives of a folder as a stream: `path, below, length, modified` of each that is new or replaced.

An offset is the number of a file in the source's log. Each log file holds the archives found by one
look at the folder that were new, or of another length or time than when they were last logged; it
is written before its number is handed out and never changed. So a batch that is run again gets the
same rows, a restarted query goes on after its last committed number, and an archive that is put
again is a row again, which Spark's own file stream, remembering paths, would pass over.

The log is the one state of the source. To compare, the source's process on the driver holds the
listing and the last entry of each path, some 200 bytes an archive; rows are read by tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from registra.config import ARCHIVE_SUFFIX
from registra.session import qualify, ship_package
from registra.sources.filesystem import resolve

FORMAT = "ziplisting"
ENTRY = pa.schema(
    [
        ("path", pa.string()),
        ("below", pa.string()),
        ("length", pa.int64()),
        ("modified", pa.int64()),
    ]
)
ENTRY_COLUMNS = "path string, below string, length long, modified long"
ENTRIES_PER_TASK = 10_000


def entries_below(uri: str, suffix: str, options: dict[str, str]) -> pa.Table:
    """All archives below a folder with their path below it, length and time in microseconds. A
    folder that is not there holds none."""
    store, base, prefix = resolve(uri, options)
    base = base.rstrip("/")
    found = [
        f
        for f in store.get_file_info(fs.FileSelector(base, recursive=True, allow_not_found=True))
        if f.type == fs.FileType.File and f.path.endswith(suffix)
    ]
    columns = [
        [prefix + f.path for f in found],
        [f.path[len(base) :].lstrip("/") for f in found],
        [f.size or 0 for f in found],
        [(f.mtime_ns or 0) // 1000 for f in found],
    ]
    return pa.table([pa.array(c, t) for c, t in zip(columns, ENTRY.types)], schema=ENTRY)


@dataclass
class LogPart(InputPartition):
    file: str
    first: int
    count: int


class ArchiveListingSource(DataSource):
    """`spark.readStream.format("ziplisting")`.

    Options: `path`, `log` (a shared folder of the query's own), `contains` (a word in the names of
    the archives), and `endpoint` / `region` / `scheme` for an S3-compatible store.
    """

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return ENTRY_COLUMNS

    def streamReader(self, schema) -> DataSourceStreamReader:
        return ArchiveListingReader(dict(self.options))


class ArchiveListingReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        lower = {k.lower(): v for k, v in options.items()}
        self.root, self.log = lower["path"], lower["log"].rstrip("/")
        self.contains = lower.get("contains", "")
        self.storage = {k: lower[k] for k in ("endpoint", "region", "scheme") if k in lower}

    def _numbers(self) -> list[int]:
        store, base, _ = resolve(self.log, self.storage)
        found = store.get_file_info(fs.FileSelector(base, allow_not_found=True))
        return sorted(int(f.base_name[:-8]) for f in found if f.base_name.endswith(".parquet"))

    def _file(self, number: int) -> str:
        return f"{self.log}/{number:012d}.parquet"

    def _read(self, number: int) -> pa.Table:
        store, path, _ = resolve(self._file(number), self.storage)
        return pq.read_table(path, filesystem=store, schema=ENTRY)

    def logged(self, numbers: list[int]) -> pa.Table:
        """The last entry of each path."""
        tables = [self._read(n) for n in numbers] or [ENTRY.empty_table()]
        last = pa.concat_tables(tables).group_by("path", use_threads=False)
        last = last.aggregate([("length", "last"), ("modified", "last")])
        return last.rename_columns(["path", "length", "modified"])

    def initialOffset(self) -> dict:
        return {"log": 0}

    def latestOffset(self) -> dict:
        numbers = self._numbers()
        listed = entries_below(self.root, ARCHIVE_SUFFIX, self.storage)
        named = pc.match_substring(pc.replace_substring_regex(listed["path"], ".*/", ""), self.contains)
        keys = ["path", "length", "modified"]
        new = listed.filter(named).join(self.logged(numbers), keys, join_type="left anti")
        number = numbers[-1] if numbers else 0
        if new.num_rows:
            number += 1
            store, path, _ = resolve(self._file(number), self.storage)
            store.create_dir(path.rpartition("/")[0])
            pq.write_table(new.sort_by("path").select(ENTRY.names), path + ".tmp", filesystem=store)
            store.move(path + ".tmp", path)
        return {"log": number}

    def partitions(self, start: dict, end: dict) -> list[LogPart]:
        parts = []
        for number in range(start["log"] + 1, end["log"] + 1):
            store, path, _ = resolve(self._file(number), self.storage)
            rows = pq.read_metadata(path, filesystem=store).num_rows
            steps = range(0, rows, ENTRIES_PER_TASK)
            parts += [LogPart(self._file(number), s, ENTRIES_PER_TASK) for s in steps]
        return parts

    def read(self, partition: LogPart) -> Iterator[pa.RecordBatch]:
        store, path, _ = resolve(partition.file, self.storage)
        rows = pq.read_table(path, filesystem=store, schema=ENTRY)
        yield from rows.slice(partition.first, partition.count).to_batches()

    def commit(self, end: dict) -> None:
        """The log stays: it is what the next listing is compared with."""


def archive_stream(
    spark: SparkSession, folder: str, log: str, contains: str = "", **storage: str
) -> DataFrame:
    """Stream of the archives below a folder that are new or replaced, with `modificationTime`."""
    ship_package()
    spark.dataSource.register(ArchiveListingSource)
    found = (
        spark.readStream.format(FORMAT)
        .options(path=qualify(spark, folder), log=qualify(spark, log), contains=contains, **storage)
        .load()
    )
    return found.withColumn("modificationTime", F.timestamp_micros("modified")).drop("modified")
