"""Binary files in the shared folder, written and read by tasks.

Paths are URIs that Arrow's file systems know (file, hdfs, s3, gs, ...).  A
file gets its name when it is complete; a repeated task writes it again.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.fs as pafs


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


@contextmanager
def new_file(uri: str) -> Iterator[pa.NativeFile]:
    fs, path = file_system(uri)
    fs.create_dir(path.rpartition("/")[0], recursive=True)
    draft = f"{path}.{uuid.uuid4().hex}.tmp"
    out = fs.open_output_stream(draft)
    try:
        yield out
    except BaseException:
        out.close()
        fs.delete_file(draft)
        raise
    out.close()
    fs.move(draft, path)


def opened(uri: str) -> pa.NativeFile:
    """For reads at any place (``read_at``)."""
    fs, path = file_system(uri)
    return fs.open_input_file(path)
