"""Tables and files in the shared folder of the session."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame

from wireloom.session import scratch_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table into the shared folder and read it back.

    This cuts lineage: a lost executor costs the tasks that read the files, not what made them.  Columns that a later
    step does not use are not read again.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def filesystem(folder: str):
    """An Arrow file system and the path in it, for a folder that all executors share."""
    from pyarrow import fs

    if folder.startswith("file:"):
        folder = "/" + folder[len("file:") :].lstrip("/")
    if "://" in folder:
        return fs.FileSystem.from_uri(folder)
    return fs.LocalFileSystem(), folder


def make_folder(folder: str) -> str:
    place, path = filesystem(folder)
    place.create_dir(path, recursive=True)
    return folder


def mapped(folder: str, name: str):
    """The bytes of a file: memory-mapped where the folder is mounted, else read through its file system."""
    import pyarrow as pa

    place, path = filesystem(folder)
    full = os.path.join(path, name)
    if place.type_name == "local":
        if not os.path.getsize(full):
            return pa.py_buffer(b"")
        with pa.memory_map(full) as source:
            return source.read_buffer()
    with place.open_input_file(full) as source:
        return source.read_buffer()


def discard(df: DataFrame) -> None:
    """Delete the files of a stored table that nothing will read again."""
    for file in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        place, path = filesystem(file)
        place.delete_dir(path)
