"""Opening files from Spark tasks, on local disks or shared storage."""

from __future__ import annotations

import re

from pyarrow import fs


def resolve(path: str) -> tuple[fs.FileSystem, str]:
    """(file system, path on it) for a plain path or a URI."""
    local = re.sub(r"^file:/+", "/", path)
    if "://" not in local:
        return fs.LocalFileSystem(), local
    return fs.FileSystem.from_uri(local)


def list_files(path: str, suffix: str | tuple[str, ...]) -> list[str]:
    """Files under a folder (recursively) or the one file named, keeping the path's own scheme."""
    system, inner = resolve(path)
    info = system.get_file_info(inner)
    if info.type == fs.FileType.File:
        return [path]
    found = system.get_file_info(fs.FileSelector(inner, recursive=True))
    prefix = path.rstrip("/")
    base = inner.rstrip("/")
    return sorted(prefix + f.path[len(base) :] for f in found if f.type == fs.FileType.File and f.path.endswith(suffix))


def file_sizes(paths: list[str]) -> list[tuple[str, int]]:
    """Paths on one file system and sizes of those that exist as files."""
    if not paths:
        return []
    system = resolve(paths[0])[0]
    infos = system.get_file_info([resolve(p)[1] for p in paths])
    return [(p, info.size) for p, info in zip(paths, infos, strict=True) if info.type == fs.FileType.File]
