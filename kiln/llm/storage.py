"""Files that tasks write to the shared folder (a local path in tests; hdfs,
s3 or gs on a cluster), safe against lost executors.

A task writes under a name no other attempt uses and reports the finished
file in its result row. Those rows are committed by Spark, so readers follow
them and never list the folder; a file of a lost attempt is never read.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyarrow import fs


def _open(uri: str):
    filesystem, path = fs.FileSystem.from_uri(uri)
    return filesystem, path


def new_name(folder: str, stem: str, suffix: str) -> str:
    return f"{folder.rstrip('/')}/{stem}-{uuid.uuid4().hex[:12]}{suffix}"


@contextmanager
def writing(uri: str):
    """A binary stream to a new file, with its folder made if missing."""
    filesystem, path = _open(uri)
    filesystem.create_dir(path.rpartition("/")[0], recursive=True)
    with filesystem.open_output_stream(path, compression=None) as out:
        yield out


@contextmanager
def reading(uri: str):
    filesystem, path = _open(uri)
    with filesystem.open_input_stream(path, compression=None) as f:
        yield f
