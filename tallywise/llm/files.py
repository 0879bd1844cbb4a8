"""Binary files in the shared folder, written and read by tasks.

A task writes each file under a name of its own and returns that name in its rows; only the rows of tasks that Spark
commits name files, so what a lost or repeated attempt leaves behind is never read.
"""

from __future__ import annotations

import uuid


def opened(uri: str, mode: str):
    """A binary file of any store that Arrow knows: ``file:`` (or a plain path), ``hdfs:``, ``s3:``, ``gs:``."""
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))
    if mode == "wb":
        store.create_dir(path.rsplit("/", 1)[0], recursive=True)
        return store.open_output_stream(path, compression=None)
    return store.open_input_file(path)


def fresh(folder: str, suffix: str) -> str:
    return f"{folder}/{uuid.uuid4().hex}{suffix}"


def as_uri(path: str) -> str:
    return f"file://{path}" if path.startswith("/") else path
