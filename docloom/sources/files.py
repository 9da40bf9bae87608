"""Files that tasks write by themselves, where Spark's writers cannot: through Arrow's file systems."""

from __future__ import annotations

import re
import uuid

import pyarrow as pa
import pyarrow.fs


def arrow_path(path: str) -> tuple[pa.fs.FileSystem, str]:
    """File system and path of a folder that Spark names: a plain or ``file:`` path, or a URI that Arrow knows."""
    local = re.fullmatch(r"(?:file:(?://)?)?(/.*)", path)
    return (pa.fs.LocalFileSystem(), local.group(1)) if local else pa.fs.FileSystem.from_uri(path)


def write_whole(fs: pa.fs.FileSystem, path: str, data: bytes) -> None:
    """A file that has its name only when it is complete; one of that name is replaced."""
    made = f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}"
    with fs.open_output_stream(made) as out:
        out.write(data)
    fs.move(made, path)
