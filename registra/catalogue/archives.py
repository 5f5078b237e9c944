"""Turn a table into registry extracts, to have archives of any size to read back."""

from __future__ import annotations

import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from registra.config import ENCODING, FIELD_SEPARATOR
from registra.session import qualify
from registra.sources.archive import ship_package
from registra.sources.filesystem import resolve


def csv_line(*columns: Column) -> Column:
    """One quoted line of `;` text; NULL becomes an empty field."""
    options = {"sep": FIELD_SEPARATOR, "quoteAll": "true", "nullValue": "", "emptyValue": ""}
    options |= {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    return F.to_csv(F.struct(*columns), options)


def write_archives(lines: DataFrame, root: str, stem: str, rebalance: bool = False) -> str:
    """Write `folder, line` rows as ZIPs `<root>/<folder>/<stem><task>.zip`; returns the root.

    Each task writes its own archive per folder under a name of its attempt and moves it to
    the final name when whole, so a lost or repeated task leaves one complete archive.
    `rebalance` brings the rows of a folder together first, in parts of even size, so that
    many folders do not mean an archive per folder and task.
    """
    root = qualify(lines.sparkSession, root)
    ship_package()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        store, base, _ = resolve(root)
        sinks: dict[str, tuple] = {}
        for batch in batches:
            blocks: dict[str, list[str]] = {}
            for name, text in zip(*(batch.column(i).to_pylist() for i in (0, 1))):
                blocks.setdefault(name, []).append(text)
            for name, texts in blocks.items():
                if name not in sinks:
                    store.create_dir(f"{base}/{name}")
                    draft = f"{base}/{name}/{stem}{task.partitionId()}.{task.taskAttemptId()}.tmp"
                    out = store.open_output_stream(draft)
                    archive = zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED, compresslevel=1)
                    # Members whose names are hidden are not read; archives are.
                    member = archive.open(f"{stem.lstrip('._')}{task.partitionId()}.csv", "w")
                    sinks[name] = (draft, out, archive, member)
                sinks[name][3].write("".join(f"{t}\n" for t in texts).encode(ENCODING))
        for name, (draft, out, archive, member) in sinks.items():
            member.close()
            archive.close()
            out.close()
            final = f"{base}/{name}/{stem}{task.partitionId()}.zip"
            if store.get_file_info(final).is_file:  # left by an earlier attempt
                store.delete_file(final)
            store.move(draft, final)
        yield from ()

    rows = lines.select("folder", "line")
    rows = rows.hint("rebalance", "folder") if rebalance else rows
    rows.mapInArrow(write, "done int").write.format("noop").mode(
        "overwrite"
    ).save()
    return root
