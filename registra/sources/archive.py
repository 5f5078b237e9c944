"""ZIP archives as a Spark source: rows `archive, member, line`.

ZIP is not a codec Spark can read, so this is the one place where Python runs on the
executors. Only the central directories are read for planning. Small members share a task,
a large one is read by several, and all are inflated as streams: no member, and no archive,
is ever held whole. Lines leave as Arrow batches and everything after that is JVM work.
"""

from __future__ import annotations

import json
import zipfile
from collections.abc import Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from registra.config import ARCHIVE_SUFFIX, ENCODING
from registra.session import qualify, ship_package
from registra.sources.filesystem import list_files, open_seekable
from registra.sources.listing import list_archives

FORMAT = "ziplines"
LINES_SCHEMA = T.StructType(
    [
        T.StructField("archive", T.StringType(), False),
        T.StructField("member", T.StringType(), False),
        T.StructField("line", T.StringType(), False),
    ]
)
ARROW_SCHEMA = pa.schema(
    [
        pa.field("archive", pa.string(), False),
        pa.field("member", pa.string(), False),
        pa.field("line", pa.string(), False),
    ]
)
MEMBER_COLUMNS = {
    "archive": (T.StringType(), pa.string()),
    "member": (T.StringType(), pa.string()),
    "size": (T.LongType(), pa.int64()),
    "stored": (T.BooleanType(), pa.bool_()),
    "position": (T.LongType(), pa.int64()),
}
BLOCK = 4 << 20
SLICE_BYTES = 512 << 20
LEAST_SLICE_BYTES = 4 << 20
INFLATE_SLICES = 16
PARTITION_BYTES = 128 << 20
FOOTER_THREADS = 32


@dataclass(frozen=True)
class Member:
    archive: str
    name: str
    size: int
    stored: bool


@dataclass(frozen=True)
class Slice:
    """The lines of a member that start at an inflated offset in [start, end)."""

    archive: str
    member: str
    start: int
    end: int


@dataclass
class SlicePartition(InputPartition):
    slices: list[Slice]


def _hidden(member: str) -> bool:
    """Names a file scan of the unpacked folder would pass over."""
    return any(
        part.startswith(".") or (part.startswith("_") and "=" not in part)
        for part in member.split("/")
    )


def members_of(archive: str, options: Mapping[str, str] | None = None) -> list[Member]:
    """The visible members of one archive, from its central directory.

    Of entries with one name the last counts, which is also the one that opens by that name.
    """
    with open_seekable(archive, options) as raw, zipfile.ZipFile(raw) as z:
        entries = {m.filename: m for m in z.infolist()}
    return [
        Member(archive, name, m.file_size, m.compress_type == zipfile.ZIP_STORED)
        for name, m in entries.items()
        if not m.is_dir() and not _hidden(name)
    ]


def slices_of(member: Member, slice_bytes: int, inflate_slices: int) -> list[Slice]:
    """Cut a member into slices of about `slice_bytes`.

    A stored member splits freely. Inflating cannot start in the middle, so each slice of a
    compressed member inflates from the start and keeps its own part: that pays because
    inflating is many times cheaper than turning lines into rows, as long as the number of
    slices is bounded. Fewer slices are larger slices; no line is left out.
    """
    parts = max(1, -(-member.size // slice_bytes))
    if not member.stored:
        parts = min(parts, inflate_slices)
    step = max(1, -(-member.size // parts))
    starts = range(0, max(member.size, 1), step)
    return [
        Slice(member.archive, member.name, start, min(start + step, member.size))
        for start in starts
    ]


class _Blocks:
    """A growing window over an inflated stream, with absolute offsets."""

    def __init__(self, stream, start: int):
        self.stream, self.offset, self.data, self.ended = stream, start, b"", False

    def grow(self) -> None:
        more = self.stream.read(BLOCK)
        self.ended = not more
        self.data += more

    def drop(self, n: int) -> bytes:
        head, self.data = self.data[:n], self.data[n:]
        self.offset += n
        return head

    def _break_at(self, i: int) -> int | None:
        """Index after the line break at i; None if the next byte is needed to tell."""
        if self.data[i : i + 1] == b"\n":
            return i + 1
        if i + 1 < len(self.data):
            return i + 2 if self.data[i + 1 : i + 2] == b"\n" else i + 1
        return i + 1 if self.ended else None

    def first_break(self, position: int) -> int:
        """Index after the first line break at or after an absolute position, or the end."""
        i = position - self.offset
        while True:
            found = [p for p in (self.data.find(b"\n", i), self.data.find(b"\r", i)) if p >= 0]
            after = self._break_at(min(found)) if found else None
            if after is not None:
                return after
            if self.ended:
                return len(self.data)
            i = min(found) if found else max(i, len(self.data))
            self.grow()

    def last_break(self) -> int:
        """Index after the last line break that is certain, or 0."""
        carriage = self.data.rfind(b"\r", 0, len(self.data) if self.ended else -1)
        return max(self.data.rfind(b"\n"), carriage) + 1


def _line_blocks(stream, start: int, end: int) -> Iterator[bytes]:
    """Whole-line blocks holding exactly the lines that start in [start, end)."""
    window = _Blocks(stream, max(start - 1, 0))
    if start:
        window.drop(window.first_break(start - 1))
    while window.offset + len(window.data) < end and not window.ended:
        cut = window.last_break()
        if cut:
            yield window.drop(cut)
        window.grow()
    if window.offset < end:
        yield window.drop(window.first_break(end - 1))


def _split(block: bytes, encoding: str) -> list[str]:
    """Lines of a block. Only \\n, \\r\\n and \\r end a line, as in Spark's own text reader."""
    text = block.decode(encoding, "replace").replace("\r\n", "\n").replace("\r", "\n")
    lines = text.split("\n")
    if not lines[-1]:
        lines.pop()
    return lines


def read_slice(
    piece: Slice, encoding: str = ENCODING, options: Mapping[str, str] | None = None
) -> Iterator[pa.RecordBatch]:
    """The lines of one slice as Arrow batches of about one block each."""
    with open_seekable(piece.archive, options) as raw, zipfile.ZipFile(raw) as z:
        with z.open(piece.member) as stream:
            if piece.start > 1:
                stream.seek(piece.start - 1)
            for block in _line_blocks(stream, piece.start, piece.end):
                lines = _split(block, encoding)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.repeat(pa.scalar(piece.archive), len(lines)),
                        pa.repeat(pa.scalar(piece.member), len(lines)),
                        pa.array(lines, pa.string()),
                    ],
                    schema=ARROW_SCHEMA,
                )


def _last_wins(members: list[Member]) -> list[Member]:
    """Keep a member name only from the last archive (in key order) that holds it."""
    winner = {m.name: m.archive for m in members}
    return [m for m in members if winner[m.name] == m.archive]


def _pack(slices: list[Slice], limit: int, min_partitions: int) -> list[SlicePartition]:
    """Put small slices together into tasks, as Spark does with small files.

    A task gets up to `limit` inflated bytes, less when that would leave cores idle.
    """
    target = min(limit, -(-sum(s.end - s.start for s in slices) // max(min_partitions, 1)))
    packed: list[list[Slice]] = []
    room = 0
    for s in slices:
        size = s.end - s.start
        if not packed or size > room:
            packed.append([])
            room = target
        packed[-1].append(s)
        room -= size
    return [SlicePartition(p) for p in packed]


class ZipLinesSource(DataSource):
    """`spark.read.format("ziplines").load(folder)`.

    Options: `paths` (JSON list, instead of `path`), `encoding`, `memberConflict` (`all` or
    `last`), `onMissing` (`error` or `empty`), `sliceBytes`, `inflateSlices`,
    `partitionBytes` (0 = one task per slice), `minPartitions`, and `endpoint` / `region` /
    `scheme` for an S3-compatible store.
    """

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> T.StructType:
        return LINES_SCHEMA

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return ZipLinesReader(dict(self.options))


class ZipLinesReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        lower = {k.lower(): v for k, v in options.items()}
        self.roots = json.loads(lower["paths"]) if "paths" in lower else [lower["path"]]
        self.encoding = lower.get("encoding", ENCODING)
        self.conflict = lower.get("memberconflict", "all")
        self.slice_bytes = int(lower.get("slicebytes", SLICE_BYTES))
        self.inflate_slices = int(lower.get("inflateslices", INFLATE_SLICES))
        self.partition_bytes = int(lower.get("partitionbytes", PARTITION_BYTES))
        self.min_partitions = int(lower.get("minpartitions", 1))
        self.storage = {k: lower[k] for k in ("endpoint", "region", "scheme") if k in lower}
        self.on_missing = lower.get("onmissing", "error")
        if self.conflict not in ("all", "last"):
            raise ValueError(f"memberConflict must be all or last, not {self.conflict}")
        if self.on_missing not in ("error", "empty"):
            raise ValueError(f"onMissing must be error or empty, not {self.on_missing}")

    def partitions(self) -> list[SlicePartition]:
        archives = []
        for root in self.roots:
            found = list_files(root, ARCHIVE_SUFFIX, self.storage)
            if not found and self.on_missing == "error":
                raise FileNotFoundError(f"PATH_NOT_FOUND: no archive under {root}")
            archives += found

        with ThreadPoolExecutor(FOOTER_THREADS) as pool:
            found = pool.map(lambda a: members_of(a, self.storage), archives)
            members = [m for archive in found for m in archive]
        if self.conflict == "last":
            members = _last_wins(members)
        # As with splittable files: smaller pieces while cores would be idle, but not tiny.
        share = -(-sum(m.size for m in members) // max(self.min_partitions, 1))
        target = min(self.slice_bytes, max(share, LEAST_SLICE_BYTES))
        slices = [s for m in members for s in slices_of(m, target, self.inflate_slices)]
        packed = _pack(slices, self.partition_bytes, self.min_partitions)
        return packed or [SlicePartition([])]

    def read(self, partition: SlicePartition) -> Iterator[pa.RecordBatch]:
        for piece in partition.slices:
            yield from read_slice(piece, self.encoding, self.storage)


def read_archives(spark: SparkSession, path: str | list[str], **options: str) -> DataFrame:
    """`archive, member, line` of every archive under one or more folders."""
    ship_package()
    spark.dataSource.register(ZipLinesSource)
    roots = [path] if isinstance(path, str) else list(path)
    cores = str(spark.sparkContext.defaultParallelism)
    reader = spark.read.format(FORMAT).options(**{"minPartitions": cores, **options})
    return reader.option("paths", json.dumps([qualify(spark, r) for r in roots])).load()


def list_members(listing: DataFrame, storage: Mapping[str, str] | None = None) -> DataFrame:
    """`archive, member, size, stored, position` of a DataFrame of archive paths, after the other
    columns of the listing. Tasks read the central directories; no path reaches the driver."""
    ship_package()
    storage = dict(storage or {})
    carried = [f for f in listing.schema.fields if f.name != "path"]
    names = [f.name for f in carried]
    columns = [T.StructField(name, spark) for name, (spark, _) in MEMBER_COLUMNS.items()]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [batch.schema.field(n) for n in names]
            added = [pa.field(name, arrow) for name, (_, arrow) in MEMBER_COLUMNS.items()]
            for row in batch.to_pylist():
                rows = [
                    {**row, "archive": m.archive, "member": m.name, "size": m.size,
                     "stored": m.stored, "position": position}
                    for position, m in enumerate(members_of(row["path"], storage))
                ]
                yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([*kept, *added]))

    return listing.mapInArrow(read, T.StructType([*carried, *columns]))


def last_members(members: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """Of members of one name those of the last archive, in the order of their paths.

    Names meet inside groups of equal `within`, such as dataset and month. The maximum is taken
    before the shuffle as well, so a name that all archives share is one row a task.
    """
    keys = [*within, "member"]
    others = ["archive", *(c for c in members.columns if c not in ("archive", *keys))]
    last = members.groupBy(*keys).agg(F.max(F.struct(*others)).alias("last"))
    return last.select(*keys, "last.*").select(*members.columns)


def expand_archives(
    listing: DataFrame,
    tasks: int | None = None,
    encoding: str = ENCODING,
    slice_bytes: int = PARTITION_BYTES,
    inflate_slices: int = INFLATE_SLICES,
    storage: Mapping[str, str] | None = None,
    member_conflict: str = "all",
    within: Sequence[str] = (),
) -> DataFrame:
    """`archive, member, line` for a DataFrame of archive paths, such as one streaming batch.

    Paths stay on the executors: tasks read the central directories, the slices are dealt
    out evenly, and tasks read the slices. Other columns of the listing are repeated on
    every line, so that what depends on the path alone is worked out once per archive.
    Without a number of `tasks`, the sizes of all members are added up first, for enough tasks, and
    for smaller slices where cores would be idle. `member_conflict="last"` keeps of members with
    one name, `within` equal values of these columns, those of the last archive.
    """
    if member_conflict not in ("all", "last"):
        raise ValueError(f"member_conflict must be all or last, not {member_conflict}")
    spark = listing.sparkSession
    storage = dict(storage or {})
    carried = [f for f in listing.schema.fields if f.name != "path"]
    lines_schema = T.StructType([*carried, *LINES_SCHEMA.fields])
    names = [f.name for f in carried]
    members = list_members(listing, storage)
    if member_conflict == "last":
        members = last_members(members, within)
    if tasks is None:
        cores = spark.sparkContext.defaultParallelism
        total = members.agg(F.sum("size")).first()[0] or 0
        slice_bytes = min(slice_bytes, max(total // cores, LEAST_SLICE_BYTES))
        tasks = max(2 * cores, -(-total // slice_bytes))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                piece = Slice(row["archive"], row["member"], row["start"], row["end"])
                for lines in read_slice(piece, encoding, storage):
                    constants = [
                        pa.repeat(pa.scalar(row[n], batch.schema.field(n).type), lines.num_rows)
                        for n in names
                    ]
                    yield pa.RecordBatch.from_arrays(
                        [*constants, *lines.columns], names=[*names, *lines.schema.names]
                    )

    # The cuts of `slices_of`, as columns.
    size = F.col("size")
    wanted = F.greatest(F.ceil(size / slice_bytes), F.lit(1))
    parts = F.when(F.col("stored"), wanted).otherwise(F.least(wanted, F.lit(inflate_slices)))
    step = F.greatest(F.ceil(size / parts), F.lit(1))
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(size - 1, F.lit(0)), step)
    slices = members.select(
        *names, "archive", "member", size, step.alias("step"), F.explode(starts).alias("start")
    ).select(
        *names, "archive", "member", "start", F.least(F.col("start") + F.col("step"), size).alias("end")
    )
    return slices.repartition(tasks).mapInArrow(read, lines_schema)


def has_archives(
    spark: SparkSession, path: str, storage: Mapping[str, str] | None = None
) -> bool:
    return not list_archives(spark, path, storage=storage).isEmpty()


def first_line(
    spark: SparkSession,
    path: str,
    encoding: str = ENCODING,
    storage: Mapping[str, str] | None = None,
) -> str | None:
    """First non-blank line of the largest member: what decides the width of a scan.

    Tasks compare the members; the driver opens the one that was found.
    """
    members = list_members(list_archives(spark, path, storage=storage).select("path"), storage)
    largest = members.orderBy(F.col("size").desc(), "archive", "position").first()
    if largest is None:
        return None
    whole = Slice(largest["archive"], largest["member"], 0, largest["size"])
    lines = (ln for b in read_slice(whole, encoding, storage) for ln in b.column(2).to_pylist())
    return next((ln for ln in lines if ln.strip()), None)
