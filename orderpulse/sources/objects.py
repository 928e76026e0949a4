"""Text objects, each at its own key, through Spark's Python data source interface.

A task writes its objects to a staging folder of its own, and moves them to their keys when it
has all of them, so a key is seen whole or not at all. The keys are listed in a file beside the
staged objects; the driver gets their number only. If the job fails, the staging folder is first
moved away, so that tasks which still run can put nothing more, and what the lists name is taken
back. In any case the staging folder goes, with what failed tasks and lost executors left in it.

Putting is idempotent: a task that runs again puts the same keys, and a stream that repeats a
batch leaves the objects as they were. Of several rows with one key in a write, one stays. What
a failed write had replaced before it failed is not brought back.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import PurePosixPath

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

FORMAT = "orderpulse_objects"
STAGING = "_staging"
COLUMNS = "key string, content string"
#: Names in a batch of a listing, and bytes of contents in a batch of a read.
NAMES_AT_ONCE, BYTES_AT_ONCE = 4096, 4 << 20
#: Compressions that Spark's text reader knows by the end of a name and pyarrow opens too.
PACKED = {".gz": "gzip", ".bz2": "bz2", ".zst": "zstd"}


def checked(key: str | None) -> str:
    """The key, if it names a place below the root."""
    parts = (key or "").split("/")
    if not key or "" in parts[:1] or ".." in parts or parts[0] == STAGING or key.endswith("/"):
        raise ValueError(f"no key of an object: {key!r}")
    return key


@dataclass
class Put(WriterCommitMessage):
    """What the driver learns of a task."""

    count: int


class ObjectWriter(DataSourceArrowWriter):
    """Puts rows of (key, content) below ``root``."""

    def __init__(self, root: str):
        self.root = root.rstrip("/")
        self.staging = f"{STAGING}/{uuid.uuid4().hex}"

    def _store(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.root)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Put:
        store, root = self._store()
        own = f"{root}/{self.staging}/{uuid.uuid4().hex}"
        listed, count, folders = f"{own}/keys", 0, set()
        store.create_dir(own, recursive=True)
        with store.open_output_stream(listed) as keys:
            for batch in iterator:
                for key, content in zip(*(c.to_pylist() for c in batch.columns)):
                    keys.write((checked(key).replace("\n", "%0A") + "\n").encode())
                    with store.open_output_stream(f"{own}/{count}") as staged:
                        staged.write((content or "").encode())
                    count += 1
        for nth, key in enumerate(self._keys(store, listed)):
            folder = str(PurePosixPath(f"{root}/{key}").parent)
            if folder not in folders:
                store.create_dir(folder, recursive=True)
                folders.add(folder)
            store.move(f"{own}/{nth}", f"{root}/{key}")
        return Put(count)

    @staticmethod
    def _keys(store: fs.FileSystem, listed: str) -> Iterator[str]:
        with store.open_input_stream(listed) as keys:
            rest = b""
            while data := keys.read(1 << 16):
                *lines, rest = (rest + data).split(b"\n")
                yield from (line.decode().replace("%0A", "\n") for line in lines)

    def _clear(self, store: fs.FileSystem, root: str, staging: str) -> None:
        _remove(store, f"{root}/{staging}")
        if not store.get_file_info(fs.FileSelector(f"{root}/{STAGING}", allow_not_found=True)):
            _remove(store, f"{root}/{STAGING}")

    def commit(self, messages: list[Put | None]) -> None:
        self._clear(*self._store(), self.staging)

    def abort(self, messages: list[Put | None]) -> None:
        store, root = self._store()
        if store.get_file_info(f"{root}/{self.staging}").type != fs.FileType.Directory:
            return
        gone = f"{self.staging}-aborted"
        store.move(f"{root}/{self.staging}", f"{root}/{gone}")
        for task in store.get_file_info(fs.FileSelector(f"{root}/{gone}")):
            if store.get_file_info(f"{task.path}/keys").type != fs.FileType.File:
                continue
            for nth, key in enumerate(self._keys(store, f"{task.path}/keys")):
                put = store.get_file_info([f"{task.path}/{nth}", f"{root}/{key}"])
                # What is still staged was not put by this task.
                if put[0].type == fs.FileType.NotFound and put[1].type == fs.FileType.File:
                    store.delete_file(f"{root}/{key}")
        self._clear(store, root, gone)


def _remove(store: fs.FileSystem, folder: str) -> None:
    if store.get_file_info(folder).type == fs.FileType.Directory:
        store.delete_dir(folder)


class ObjectSource(DataSource):
    """``df.write.format("orderpulse_objects").option("root", ...)`` for (key, content)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return COLUMNS

    def writer(self, schema: StructType, overwrite: bool) -> ObjectWriter:
        if overwrite:
            raise ValueError("objects are put one by one; write in mode append")
        if [f.name for f in schema] != ["key", "content"]:
            raise ValueError(f"objects are rows of ({COLUMNS})")
        return ObjectWriter(self.options["root"])


def put_objects(objects: DataFrame, root: str, tasks: int | None = None) -> None:
    """Put rows of (key, content) below ``root``, each as one object at its key.

    ``tasks`` spreads them over that many tasks, as the cost is per object. A null content is
    an empty object; a key that is null, absolute or leads out of ``root`` is an error.
    """
    objects.sparkSession.dataSource.register(ObjectSource)
    rows = objects.select("key", "content")
    if tasks:
        rows = rows.repartition(tasks, "key")
    rows.write.format(FORMAT).mode("append").option("root", root).save()


def clear_staging(root: str) -> None:
    """Remove what writes left that ended with their driver; none may be running."""
    store, path = fs.FileSystem.from_uri(root.rstrip("/"))
    _remove(store, f"{path}/{STAGING}")


def _folder(path: str) -> str:
    """The path of a folder in a file system, given as path or as file URI."""
    return os.path.abspath(re.sub("^file:(//(?=/))?", "", path) or "/")


def is_local(spark: SparkSession, path: str) -> bool:
    """True for an existing folder of a file system that all tasks see."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    scheme = place.getFileSystem(spark._jsc.hadoopConfiguration()).getUri().getScheme()
    return scheme == "file" and os.path.isdir(_folder(path))


def _hidden(name: str) -> bool:
    """What Spark's readers leave out."""
    if name.startswith(("_metadata", "_common_metadata")):
        return False
    return (name.startswith("_") and "=" not in name) or name.startswith(".") \
        or name.endswith("._COPYING_")


def _walk(folder: str, key: str) -> Iterator[str]:
    """Keys of the files below a folder, without a stat of each; ``key`` is that of the folder."""
    with os.scandir(folder) as entries:
        for entry in entries:
            if _hidden(entry.name):
                continue
            if entry.is_dir():
                yield from _walk(entry.path, f"{key}{entry.name}/")
            else:
                yield f"{key}{entry.name}"


def list_objects(spark: SparkSession, root: str, prefix: str = "") -> DataFrame:
    """(key) of every object below ``prefix`` of a local ``root``. One task walks the folders;
    it holds a batch of names at a time, and no other task or the driver holds them all."""
    base = _folder(root).rstrip("/")
    start = prefix.strip("/") + "/" if prefix.strip("/") else ""

    def walk(batches):
        for batch in batches:
            names = []
            for _ in range(batch.num_rows):
                for key in _walk(f"{base}/{start}", start):
                    names.append(key)
                    if len(names) == NAMES_AT_ONCE:
                        yield pa.RecordBatch.from_pydict({"key": pa.array(names, pa.string())})
                        names = []
            yield pa.RecordBatch.from_pydict({"key": pa.array(names, pa.string())})

    return spark.range(0, 1, 1, 1).mapInArrow(walk, "key string")


def _content(path: str) -> bytes:
    """The bytes of a file, unpacked as its name tells."""
    end = os.path.splitext(path)[1]
    if end in (".snappy", ".lz4"):
        raise ValueError(f"{path}: only Spark's own readers unpack {end}")
    if end in PACKED:
        with pa.input_stream(path, compression=PACKED[end]) as file:
            return file.read()
    with open(path, "rb") as file:
        data = file.read()
    return zlib.decompress(data) if end == ".deflate" else data


def read_objects(keys: DataFrame, root: str) -> DataFrame:
    """(path, content) of the objects at the keys below a local ``root``. The keys are dealt
    evenly to tasks, as the cost is per object; an object without a byte gives no row."""
    base = _folder(root).rstrip("/")

    def read(batches):
        for batch in batches:
            paths, contents, size = [], [], 0
            for key in batch.column(0).to_pylist():
                data = _content(f"{base}/{key}")
                if not data:
                    continue
                paths.append(key)
                contents.append(data)
                size += len(data)
                if size >= BYTES_AT_ONCE:
                    yield _pairs(paths, contents)
                    paths, contents, size = [], [], 0
            yield _pairs(paths, contents)

    tasks = 4 * keys.sparkSession.sparkContext.defaultParallelism
    found = keys.repartition(tasks, "key").mapInArrow(read, "path string, content binary")
    return found.select("path", F.col("content").cast("string").alias("content"))


def _pairs(paths: list[str], contents: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"path": pa.array(paths, pa.string()),
                                       "content": pa.array(contents, pa.binary())})
