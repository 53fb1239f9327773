"""File systems as tasks see them: local paths, s3, gs, abfs and hdfs."""

from __future__ import annotations

import os
import posixpath
import uuid
from collections.abc import Callable, Iterator
from datetime import UTC, datetime

from pyarrow import fs
from pyspark.sql import SparkSession

# Hadoop's names of the stores and the ones pyarrow knows.
_SCHEMES = {"s3a": "s3", "s3n": "s3", "gcs": "gs"}
# The folder below a target in which pieces wait to be published.
STAGING = "_staging"
# The folders there, one for each attempt to write, as a pattern for what follows the folder.
ATTEMPT = r"\A[0-9a-f]{32}(/|\z)"
# Fixed value: how the checksums begin that Hadoop puts beside local files.
_CHECKSUM = b"crc\x00"


def qualified(spark: SparkSession, path: str) -> str:
    """The path as Spark reads it: without a scheme it is on the default file system."""
    if "://" in path or path.startswith("file:"):
        return path
    default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")
    scheme, _, authority = default.partition("://")
    inner = os.path.abspath(path)
    if scheme == "file":
        return f"file://{inner}"
    return f"{scheme}://{authority.strip('/')}{inner}"


def with_scheme(like: str, inner: str) -> str:
    """A path that a file system has listed, as one of the kind of ``like``."""
    scheme, sep, _ = like.partition("://")
    if sep and scheme != "file":
        return f"{scheme}://{inner}" if scheme != "hdfs" else like.split("/", 3)[0] + "//" + like.split("/", 3)[2] + inner
    return f"file://{inner}"


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    scheme, sep, rest = path.partition("://")
    if sep and scheme != "file":
        return fs.FileSystem.from_uri(f"{_SCHEMES.get(scheme, scheme)}://{rest}")
    return fs.LocalFileSystem(), local_path(path)


def local_path(path: str) -> str:
    if path.startswith("file:"):
        path = "/" + path[len("file:") :].lstrip("/")
    return os.path.abspath(path)


def is_local(path: str) -> bool:
    return "://" not in path or path.startswith("file:")


def open_input(path: str):
    store, inner = file_system(path)
    return store.open_input_stream(inner, compression=None)


def open_random(path: str):
    store, inner = file_system(path)
    return store.open_input_file(inner)


def open_output(path: str):
    store, inner = file_system(path)
    if is_local(path):
        store.create_dir(posixpath.dirname(inner), recursive=True)
    return store.open_output_stream(inner, compression=None)


def names(folder: str) -> Iterator[str]:
    """Names in a local folder, one at a time; none if there is no such folder."""
    try:
        with os.scandir(local_path(folder)) as entries:
            for entry in entries:
                yield entry.name
    except FileNotFoundError:
        return


def children(folder: str, wanted: Callable[[str], bool] = lambda name: True) -> Iterator[tuple]:
    """``(name, is a folder, size, modification time)`` of the wanted names right below."""
    if not is_local(folder):
        store, inner = file_system(folder)
        for f in store.get_file_info(fs.FileSelector(inner, allow_not_found=True)):
            if wanted(f.base_name):
                yield f.base_name, f.type == fs.FileType.Directory, f.size, f.mtime
        return
    try:
        entries = os.scandir(local_path(folder))
    except FileNotFoundError:
        return
    with entries:
        for entry in entries:
            if wanted(entry.name):
                try:
                    known = entry.stat()
                except FileNotFoundError:  # gone since
                    continue
                at = datetime.fromtimestamp(known.st_mtime_ns // 1000 / 1_000_000, UTC)
                yield entry.name, entry.is_dir(), known.st_size, at


def is_checksum(folder: str, name: str) -> bool:
    """Whether a local file is Hadoop's checksum of the file beside it, by name and by its first bytes."""
    if not (name.startswith(".") and name.endswith(".crc")):
        return False
    inner = local_path(folder)
    if not os.path.isfile(os.path.join(inner, name[1:-4])):
        return False
    with open(os.path.join(inner, name), "rb") as source:
        return source.read(len(_CHECKSUM)) == _CHECKSUM


def move(source: str, target: str, size: int) -> None:
    """Puts ``source``, of ``size`` bytes, in the place of ``target``.

    A repeat finds it done: the source gone, and a target of that size.
    Anything else is an error, such as an object of an earlier flush there.
    """
    store, inner_target = file_system(target)
    inner_source = file_system(source)[1]
    there = store.get_file_info(inner_source)
    if there.type == fs.FileType.NotFound:
        done = store.get_file_info(inner_target)
        if done.type == fs.FileType.File and done.size == size:
            return
        raise FileNotFoundError(f"staged piece {source} is lost and {target} is not it")
    if there.size != size:
        raise OSError(f"staged piece {source} has {there.size} bytes, not {size}")
    if is_local(target):
        store.create_dir(posixpath.dirname(inner_target), recursive=True)
    store.move(inner_source, inner_target)


def exists(path: str) -> bool:
    store, inner = file_system(path)
    return store.get_file_info(inner).type != fs.FileType.NotFound


def read_bytes(path: str) -> bytes:
    with open_input(path) as source:
        return source.read()


def write_bytes(path: str, data: bytes) -> None:
    """Puts a small object in its place whole: written beside it and renamed where that is needed."""
    if not is_local(path):
        with open_output(path) as out:
            out.write(data)
        return
    inner = local_path(path)
    os.makedirs(os.path.dirname(inner), exist_ok=True)
    aside = f"{inner}.{uuid.uuid4().hex}"
    with open(aside, "wb") as out:
        out.write(data)
    os.replace(aside, inner)


def remove_tree(path: str) -> None:
    """Removes a folder with all below it, or a single object."""
    store, inner = file_system(path)
    kind = store.get_file_info(inner).type
    if kind == fs.FileType.Directory:
        store.delete_dir(inner)
    elif kind == fs.FileType.File:
        store.delete_file(inner)


def remove_if_empty(path: str) -> None:
    """Local folders only: stores have none."""
    if is_local(path):
        try:
            os.rmdir(local_path(path))
        except OSError:
            pass


def object_path(root: str, name: str) -> str:
    """Where an object of this name goes; it must stay below the root."""
    if any(step == ".." for step in name.split("/")) or name.startswith("/") or not name:
        raise ValueError(f"object name {name!r} does not stay below {root}")
    return f"{root.rstrip('/')}/{name}"
