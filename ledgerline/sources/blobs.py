"""Files of bytes in the shared folder that tasks write and read themselves, opened by Arrow."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import SparkSession


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its store, as Spark's own writers would find it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(target).toUri().toString()


def _store(uri: str) -> tuple:
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


@contextmanager
def written(uri: str) -> Iterator:
    """A stream whose file appears whole, once the block has ended without an error."""
    system, name = _store(uri)
    system.create_dir(name.rsplit("/", 1)[0], recursive=True)
    part = f"{name}.{uuid.uuid4().hex}"
    with system.open_output_stream(part) as out:
        yield out
    system.move(part, name)


@contextmanager
def opened(uri: str) -> Iterator:
    system, name = _store(uri)
    with system.open_input_file(name) as stream:
        yield stream


def remove(uris: Sequence[str]) -> None:
    """Files or whole folders; what is not there is passed over."""
    from pyarrow import fs

    for uri in uris:
        system, name = _store(uri)
        kind = system.get_file_info(name).type
        if kind == fs.FileType.Directory:
            system.delete_dir(name)
        elif kind == fs.FileType.File:
            system.delete_file(name)
