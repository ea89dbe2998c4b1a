"""Copies of files made by executors, named by what they hold.

A file is read once, in pieces, written under a name of its own and then moved
to the SHA-256 of its bytes. So a repeated task or a second run makes the same
file again and nothing else, equal files are one, and readers never see a part
of a file. Contents never pass a shuffle or the driver.
"""

from __future__ import annotations

import hashlib
import os
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECE = 1 << 20


def open_path(path: str):
    """The file system of a path or URI, and the path in it."""
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def copy_file(source: str, target: str) -> tuple[str, int] | None:
    """(name, bytes) of the copy in the folder target; None where there is no such file."""
    from pyarrow import fs

    (there, path), (here, folder) = open_path(source), open_path(target)
    if there.get_file_info(path).type != fs.FileType.File:
        return None
    here.create_dir(folder, recursive=True)
    part, digest, size = f"{folder}/.part-{uuid.uuid4().hex}", hashlib.sha256(), 0
    with there.open_input_stream(path) as read, here.open_output_stream(part) as write:
        while piece := read.read(PIECE):
            digest.update(piece)
            write.write(piece)
            size += len(piece)
    name = digest.hexdigest() + (os.path.splitext(path)[1].lower() or ".png")
    if here.get_file_info(f"{folder}/{name}").type == fs.FileType.File:
        here.delete_file(part)
    else:
        here.move(part, f"{folder}/{name}")
    return name, size


def copy_files(sources: DataFrame, target: str, column: str = "source") -> DataFrame:
    """(source, file, bytes) of every distinct source: the name of its copy in the folder target; a source that does not exist has nulls.

    The copies are made when the rows are read; write them to a table to keep
    what was copied. target must be a folder that all executors share.
    """

    def run(batches):
        for batch in batches:
            paths = batch.column(0).to_pylist()
            done = [copy_file(p, target) or (None, None) for p in paths]
            yield pa.RecordBatch.from_pydict({"source": paths, "file": [d[0] for d in done], "bytes": pa.array([d[1] for d in done], pa.int64())})

    # Distinct sources are dealt by hash, so large files of one folder do not meet in one task.
    return sources.select(F.col(column).alias("source")).where("source is not null").distinct().mapInArrow(run, "source string, file string, bytes long")
