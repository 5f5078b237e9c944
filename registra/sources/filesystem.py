"""Open archive files from Python tasks, on local, HDFS or S3-compatible storage."""

from __future__ import annotations

import io
import re
from collections.abc import Mapping

from pyarrow import fs

READ_BUFFER = 1 << 20
S3_SCHEMES = ("s3", "s3a", "s3n")


def _parts(uri: str) -> tuple[str, str, str]:
    """Scheme, authority and path, taken literally: Spark prints paths without escapes."""
    scheme, rest = re.fullmatch(r"(?:([A-Za-z][A-Za-z0-9+.-]*):)?(.*)", uri, re.DOTALL).groups()
    if not rest.startswith("//"):
        return scheme or "", "", rest
    authority, _, path = rest[2:].partition("/")
    return scheme or "", authority, "/" + path


def resolve(uri: str, options: Mapping[str, str] | None = None) -> tuple[fs.FileSystem, str, str]:
    """File system, path inside it, and the prefix that turns such a path into a URI again."""
    scheme, authority, path = _parts(uri)
    if scheme in ("", "file"):
        return fs.LocalFileSystem(), path, f"{scheme}:" if scheme else ""
    if scheme in S3_SCHEMES:
        options = options or {}
        given = {
            "endpoint_override": options.get("endpoint"),
            "region": options.get("region"),
            "scheme": options.get("scheme"),
        }
        store = fs.S3FileSystem(**{k: v for k, v in given.items() if v})
        return store, authority + path, f"{scheme}://"
    store, _ = fs.FileSystem.from_uri(f"{scheme}://{authority}/")
    return store, path, f"{scheme}://{authority}"


def open_seekable(uri: str, options: Mapping[str, str] | None = None) -> io.BufferedReader:
    store, path, _ = resolve(uri, options)
    return io.BufferedReader(store.open_input_file(path), READ_BUFFER)


def list_files(uri: str, suffix: str, options: Mapping[str, str] | None = None) -> list[str]:
    """Sorted URIs of the files below a folder (or of the one file) that end in `suffix`."""
    store, path, prefix = resolve(uri, options)
    info = store.get_file_info(path)
    if info.type == fs.FileType.File:
        found = [info]
    else:
        found = store.get_file_info(fs.FileSelector(path, recursive=True, allow_not_found=True))
    return sorted(
        prefix + f.path for f in found if f.type == fs.FileType.File and f.path.endswith(suffix)
    )


def subfolders(uri: str, options: Mapping[str, str] | None = None) -> list[str]:
    """Names of the folders right below one; none if it is not there."""
    store, path, _ = resolve(uri, options)
    found = store.get_file_info(fs.FileSelector(path, allow_not_found=True))
    return sorted(f.base_name for f in found if f.type == fs.FileType.Directory)


def drop_folder(uri: str, options: Mapping[str, str] | None = None) -> None:
    """Delete a folder, if it is there."""
    store, path, _ = resolve(uri, options)
    if store.get_file_info(path).type == fs.FileType.Directory:
        store.delete_dir(path)
