"""File access from tasks, for local paths and for URIs of shared storage."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

from pyarrow import fs

# the names Spark users write, and the scheme of the file system that serves them
_SCHEMES = {
    "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs", "hdfs": "hdfs", "viewfs": "viewfs",
    "abfs": "abfs", "abfss": "abfss",
}
_URI = re.compile(r"^([A-Za-z][A-Za-z0-9+.-]*):(?://([^/]*))?(/.*)?$", re.S)


@lru_cache(maxsize=64)
def _connect(scheme: str, authority: str) -> tuple[fs.FileSystem, str]:
    """File system of a store and the path of its root, once per process."""
    files, root = fs.FileSystem.from_uri(f"{scheme}://{authority}/")
    return files, root.rstrip("/")


def resolve(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path within it. ``file:/x`` is what Spark calls a local file."""
    uri = _URI.match(path)
    if path.startswith("/") or not uri:
        return fs.LocalFileSystem(), path
    scheme, authority, name = uri[1].lower(), uri[2] or "", uri[3] or "/"
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + name.lstrip("/")
    if scheme not in _SCHEMES:
        raise ValueError(f"no file system for {scheme}: in {path}")
    files, root = _connect(_SCHEMES[scheme], authority)
    return files, root + name


def plain_path(path: str) -> str:
    """A directory the way listings name it: local paths without a scheme, no
    slash at the end."""
    return re.sub(r"^file:/+", "/", path.rstrip("/"))


def list_directory(path: str) -> Iterator[tuple[str, bool, int]]:
    """``path, is directory, size`` of the entries of a directory, named the way
    the directory itself was named."""
    files, name = resolve(path.rstrip("/"))
    clean = plain_path(path)
    for entry in files.get_file_info(fs.FileSelector(name)):
        yield f"{clean}/{entry.base_name}", entry.type == fs.FileType.Directory, entry.size or 0


def read_bytes(path: str) -> bytes:
    files, name = resolve(path)
    with files.open_input_stream(name) as stream:
        return stream.read()
