"""Change-feed files as a streaming source with offsets of its own.

``spark.readStream.format("change_files")`` follows a folder of JSON-lines
files that a change-feed client drops, plain or compressed (by the suffix: ``.gz``
for example), in the order of their names. An offset is
the number of files taken so far, kept in the query's checkpoint. A file is one
partition, read by one task in fetches of at most ``fetch`` entries; entries of
other databases are dropped there, before they become rows.

Options: ``path`` (any store pyarrow has a file system for), ``database`` (keep
this one's changes), ``fetch`` (100). A micro-batch takes all new files.
Files must be complete when their name appears (``deliver`` renames) and names
must grow. A line that is no JSON object is dropped; to keep such lines read the
folder as text (``sources.streams.text_files``) beside it.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from shopflow import schemas

NAME = "change_files"
FETCH = 100   # entries a fetch brings at most


@dataclass
class ChangeFile(InputPartition):
    path: str


def _fields(entry: dict, schema: StructType) -> dict:
    """An entry's declared fields; numbers where text is declared become text."""
    rows = [{"after": [{"name": c.get("name"), "value": None if c.get("value") is None else str(c["value"])}
                       for c in r.get("after") or []]} for r in entry.get("rows") or []]
    out = {f.name: entry.get(f.name) for f in schema.fields}
    return out | {"rows": rows, "ts": None if entry.get("ts") is None else int(entry["ts"])}


class ChangeReader(DataSourceStreamReader):
    def __init__(self, options: dict, schema: StructType) -> None:
        self.root = options["path"]
        self.database = options.get("database")
        self.fetch = int(options.get("fetch", FETCH))
        self.schema = schema

    def _files(self) -> list[str]:
        """All files so far, by name. One listing of one folder."""
        store, path = fs.FileSystem.from_uri(self.root) if "://" in self.root else (fs.LocalFileSystem(), self.root)
        found = store.get_file_info(fs.FileSelector(path, allow_not_found=True))
        return sorted(f.path for f in found if f.type == fs.FileType.File and not f.base_name.startswith((".", "_")))

    def initialOffset(self) -> dict:  # noqa: N802
        return {"files": 0}

    def latestOffset(self) -> dict:  # noqa: N802
        return {"files": len(self._files())}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [ChangeFile(path) for path in self._files()[start["files"]:end["files"]]]

    def read(self, partition: ChangeFile) -> Iterator[pa.RecordBatch]:
        store = fs.FileSystem.from_uri(self.root)[0] if "://" in self.root else fs.LocalFileSystem()
        arrow, fetched = to_arrow_schema(self.schema), []
        with store.open_input_stream(partition.path) as raw:
            for line in _lines(raw):
                try:
                    entry = json.loads(line)
                except ValueError:
                    continue
                if not isinstance(entry, dict) or (self.database is not None and entry.get("database") != self.database):
                    continue
                fetched.append(_fields(entry, self.schema))
                if len(fetched) == self.fetch:
                    yield pa.RecordBatch.from_pylist(fetched, schema=arrow)
                    fetched = []
        if fetched:
            yield pa.RecordBatch.from_pylist(fetched, schema=arrow)


def _lines(raw, size: int = 1 << 20) -> Iterator[bytes]:
    """Lines of a byte stream, block by block."""
    rest = b""
    while block := raw.read(size):
        *whole, rest = (rest + block).split(b"\n")
        yield from (x for x in whole if x.strip())
    if rest.strip():
        yield rest


class ChangeFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> StructType:
        return schemas.CHANGE_ENTRY

    def streamReader(self, schema: StructType) -> ChangeReader:  # noqa: N802
        return ChangeReader(dict(self.options), schema)


def change_files(spark: SparkSession, path: str, database: str | None = None, fetch: int = FETCH) -> DataFrame:
    """Stream of change entries (``schemas.CHANGE_ENTRY``)."""
    spark.dataSource.register(ChangeFiles)
    reader = spark.readStream.format(NAME).option("path", path).option("fetch", str(fetch))
    if database is not None:
        reader = reader.option("database", database)
    return reader.load()


def deliver(spark: SparkSession, folder: str, path: str, prefix: str) -> None:
    """Moves the part files that a job wrote below ``folder`` into a followed
    folder, under names that begin with ``prefix`` (a rename each, so a file is
    whole when its name appears)."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    source, target = jvm.org.apache.hadoop.fs.Path(folder), jvm.org.apache.hadoop.fs.Path(path)
    store = target.getFileSystem(conf)
    store.mkdirs(target)
    for status in store.listStatus(source):
        own = status.getPath()
        if own.getName().startswith("part-"):
            store.rename(own, jvm.org.apache.hadoop.fs.Path(target, f"{prefix}-{own.getName()}"))
