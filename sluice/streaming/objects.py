"""A stream of new objects, every name included.

Spark's file source leaves out names that begin with ``_`` or ``.``. This source
lists by itself. What a batch takes is written to the *log* before the batch
runs: folder ``state/log`` has one folder per batch with the batch's objects in
parts, and a marker, written last, that makes it count. The offset is the number
of the newest batch in the log, so a batch that is run again, hours later or
after a crash, has the very same objects, and one that was logged but never ran
is run with the next.

Objects are told by key. Modification times do not tell what is new: a file that
is renamed into place keeps an old one, and stores date an upload from its
start. So the source keeps digests of the keys it has logged, 16 bytes each, and
writes them down every ``COMPACT`` batches. ``forget_after`` bounds them: objects
older than the newest one by more than that are taken as dealt with.

A batch takes all new objects, or with a cap the first ones in the order of
their keys. The listing is streamed: names pass through the driver's listing
process into the log, none is held there but those of a capped batch.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import struct
import time
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from sluice.session import ship_package
from sluice.sinks import store

SCHEMA = "object_key string, path string, length bigint, modified timestamp"
PART_OBJECTS = 5_000
COMPACT = 50
_SEEN = struct.Struct("<16sq")


def new_objects(
    spark: SparkSession,
    root: str,
    state: str,
    *,
    objects_per_batch: int | None = None,
    bytes_per_batch: int | None = None,
    prefix: str = "",
    after: str | None = None,
    glob: str | None = None,
    forget_after: float | None = None,
    growing: bool = False,
) -> DataFrame:
    """``object_key, path, length, modified`` of objects below ``root`` as they arrive.

    ``state`` is a folder of this stream's own on storage that the tasks share;
    it belongs to the query's checkpoint and must be kept with it. A capped
    batch holds at least one object. ``forget_after`` is in seconds. With
    ``growing`` an object is told again whenever its length is another one.
    """
    ship_package(spark)
    spark.dataSource.register(ObjectSource)
    options = {
        "root": store.qualified(spark, root).rstrip("/"),
        "state": store.qualified(spark, state).rstrip("/"),
        "objects": objects_per_batch,
        "bytes": bytes_per_batch,
        "prefix": prefix,
        "after": after,
        "glob": glob,
        "forget": forget_after,
        "growing": growing,
    }
    return spark.readStream.format("sluice_objects").option("how", json.dumps(options)).load()


class ObjectSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sluice_objects"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema: StructType) -> ObjectReader:  # noqa: N802
        return ObjectReader(**json.loads(self.options["how"]))


class Part(InputPartition):
    def __init__(self, path: str):
        self.path = path


class ObjectReader(DataSourceStreamReader):
    def __init__(self, root, state, objects, bytes, prefix, after, glob, forget, growing=False):  # noqa: A002
        self.root, self.log = root, f"{state}/log"
        self.most, self.most_bytes = objects, bytes
        self.prefix, self.after, self.forget, self.growing = prefix, after, forget, growing
        self.glob = re.compile(_pattern(glob)) if glob else None
        self.seen: dict[bytes, int] | None = None
        self.batch = 0
        self.newest = 0

    # --- what Spark calls --------------------------------------------------------------

    def initialOffset(self) -> dict:  # noqa: N802
        return {"batch": 0}

    def latestOffset(self) -> dict:  # noqa: N802
        if self.seen is None:
            self._recover()
        found = self._new()
        if self.most or self.most_bytes:
            found = iter(self._page(found))
        self._write(found)
        return {"batch": self.batch}

    def partitions(self, start: dict, end: dict) -> list[Part]:
        return [
            Part(f"{self._folder(batch)}/{part:06d}")
            for batch in range(start["batch"] + 1, end["batch"] + 1)
            for part in range(json.loads(store.read_bytes(f"{self._folder(batch)}/done"))["parts"])
        ]

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        rows = [json.loads(line) for line in store.read_bytes(partition.path).splitlines()]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([r[0] for r in rows], pa.string()),
                pa.array([f"{self.root}/{r[0]}" for r in rows], pa.string()),
                pa.array([r[1] for r in rows], pa.int64()),
                pa.array([r[2] for r in rows], pa.timestamp("us", "UTC")),
            ],
            names=["object_key", "path", "length", "modified"],
        )

    # --- listing -----------------------------------------------------------------------

    def _new(self) -> Iterator[tuple[str, int, int]]:
        """``(key, size, modification time in microseconds)`` of the objects not logged yet."""
        oldest = self.newest - int(self.forget * 1e6) if self.forget is not None else None
        for key, size, modified in self._listed(""):
            at = int(modified.timestamp() * 1_000_000) if modified else int(time.time() * 1e6)
            if size > 0 and (oldest is None or at >= oldest) and self._digest(key, size) not in self.seen:
                yield key, size, at

    def _listed(self, folder: str) -> Iterator[tuple[str, int, datetime | None]]:
        """Objects below a folder (``''`` or ``a/b/``), those that cannot be wanted left out with their folders."""
        where = f"{self.root}/{folder}".rstrip("/")
        folders = []
        for name, is_folder, size, modified in store.children(where):
            key = f"{folder}{name}"
            if is_folder:
                inside = f"{key}/"
                wanted = inside.startswith(self.prefix) or self.prefix.startswith(inside)
                past = self.after is not None and inside < self.after and not self.after.startswith(inside)
                if wanted and not past and not _is_attempt(key):
                    folders.append(inside)
            elif key.startswith(self.prefix) and (self.after is None or key > self.after):
                if self.glob is None or self.glob.fullmatch(name):
                    if not (store.is_local(where) and store.is_checksum(where, name)):
                        yield key, size, modified
        for inside in folders:
            yield from self._listed(inside)

    def _page(self, found: Iterator[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
        """The first objects in the order of their keys, up to the caps."""
        page = heapq.nsmallest(self.most or 10_000, found)
        if self.most_bytes:
            total = 0
            for n, (_, size, _) in enumerate(page):
                total += size
                if n and total > self.most_bytes:
                    return page[:n]
        return page

    def _digest(self, key: str, size: int) -> bytes:
        told = f"{key}\0{size}" if self.growing else key
        return hashlib.blake2b(told.encode("utf-8", "surrogatepass"), digest_size=16).digest()

    # --- the log -----------------------------------------------------------------------

    def _folder(self, batch: int) -> str:
        return f"{self.log}/{batch:012d}"

    def _write(self, found: Iterator[tuple[str, int, int]]) -> None:
        parts, held = 0, []

        def part() -> None:
            nonlocal parts
            lines = "".join(json.dumps(row) + "\n" for row in held)
            store.write_bytes(f"{self._folder(self.batch + 1)}/{parts:06d}", lines.encode())
            parts += 1
            held.clear()

        added: list[tuple[bytes, int]] = []
        for row in found:
            held.append(row)
            added.append((self._digest(row[0], row[1]), row[2]))
            if len(held) == PART_OBJECTS:
                part()
        if held:
            part()
        if not parts:
            return
        store.write_bytes(f"{self._folder(self.batch + 1)}/done", json.dumps({"parts": parts}).encode())
        self.batch += 1
        self._remember(added)
        if self.batch % COMPACT == 0:
            self._compact()

    def _remember(self, added: list[tuple[bytes, int]]) -> None:
        self.seen.update(added)
        self.newest = max([self.newest, *(at for _, at in added)])
        if self.forget is not None:
            oldest = self.newest - int(self.forget * 1e6)
            self.seen = {key: at for key, at in self.seen.items() if at >= oldest}

    def _compact(self) -> None:
        """All digests in one file; batches of before the last such file will not be run again."""
        store.write_bytes(f"{self.log}/seen-{self.batch:012d}", b"".join(_SEEN.pack(*x) for x in self.seen.items()))
        for name in [n for n, *_ in store.children(self.log)]:
            number = name.removeprefix("seen-")
            if number.isdigit() and int(number) <= self.batch - COMPACT:
                store.remove_tree(f"{self.log}/{name}")

    def _recover(self) -> None:
        """Digests of the newest file of them and of the batches after it."""
        names = sorted(n for n, *_ in store.children(self.log))
        whole = [n for n in names if n.startswith("seen-")]
        self.seen = {}
        if whole:
            self.batch = int(whole[-1].removeprefix("seen-"))
            self._remember(list(_SEEN.iter_unpack(store.read_bytes(f"{self.log}/{whole[-1]}"))))
        for batch in range(self.batch + 1, self.batch + 10 * COMPACT):
            marker = f"{self._folder(batch)}/done"
            if not store.exists(marker):
                break
            for part in range(json.loads(store.read_bytes(marker))["parts"]):
                rows = map(json.loads, store.read_bytes(f"{self._folder(batch)}/{part:06d}").splitlines())
                self._remember([(self._digest(key, size), at) for key, size, at in rows])
            self.batch = batch


def _pattern(glob: str) -> str:
    return "".join({"*": ".*", "?": "."}.get(c) or re.escape(c) for c in glob)


def _is_attempt(key: str) -> bool:
    """Whether the folder is one that a writer at work has made."""
    return re.fullmatch(rf"{store.STAGING}/[0-9a-f]{{32}}", key) is not None
