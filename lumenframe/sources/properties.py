"""A Spark data source of properties: values by key in blob files, with an index of each.

Each task writes a blob, values after each other in the order of their keys, and an index of keys, places
and sizes. The commit writes the manifest, which alone says what belongs to the store: tasks that fail
or run twice leave nothing that is read, and an abort removes what they wrote. A filter on key (equality
or `in`) is pushed: then only the indexes whose range of keys fits, and the values of the keys
asked for, are read. Keys that aren't there give no rows.

Rows: key string, value binary. A key that is written twice has two rows. Null keys are an error; a null value stays null.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, WriterCommitMessage

from .stores import Ranges, kept_only, made, opened, put, whole

SCHEMA = "key string, value binary, bytes_read long"
MANIFEST = "manifest.json"
#: Bytes between two values up to which they are read at once, and rows of a batch.
GAP, ROWS = 4096, 1000


@dataclass
class Part(WriterCommitMessage):
    name: str
    rows: int = 0
    first: str = ""
    last: str = ""
    index_bytes: int = 0


@dataclass
class Asked(InputPartition):
    name: str
    index_bytes: int
    keys: list[str] | None = field(default=None)


class PropertyWriter(DataSourceArrowWriter):
    def __init__(self, path: str, overwrite: bool):
        # A job's files lie in a folder of its own, so that all of them can go if it fails.
        self.path, self.overwrite, self.job = path, overwrite, uuid.uuid4().hex
        made(f"{path}/{self.job}")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Part:
        part = Part(f"{self.job}/{uuid.uuid4().hex}")
        store, inner = opened(f"{self.path}/{part.name}.blob")
        index: list[tuple[str, int, int]] = []
        at = 0
        with store.open_output_stream(inner) as out:
            for batch in iterator:
                for key, value in zip(batch.column("key").to_pylist(), batch.column("value").to_pylist(), strict=True):
                    if key is None:
                        raise ValueError("a property needs a key")
                    index.append((key, at, -1 if value is None else len(value)))
                    if value:
                        out.write(value)
                        at += len(value)
        index.sort()
        body = json.dumps(index, ensure_ascii=False).encode()
        put(f"{self.path}/{part.name}.index", body)
        part.rows, part.index_bytes = len(index), len(body)
        if index:
            part.first, part.last = index[0][0], index[-1][0]
        return part

    def commit(self, messages: list[Part]) -> None:
        parts = [vars(m) for m in messages if m is not None and m.rows]
        before = [] if self.overwrite else manifest(self.path)
        put(f"{self.path}/{MANIFEST}", json.dumps(before + parts).encode())
        kept_only(f"{self.path}/{self.job}", {f"{p['name'].split('/')[1]}.{end}" for p in parts for end in ("blob", "index")})

    def abort(self, messages: list[Part]) -> None:
        kept_only(f"{self.path}/{self.job}", set())


def manifest(path: str) -> list[dict]:
    try:
        return json.loads(whole(f"{path}/{MANIFEST}"))
    except FileNotFoundError:
        return []


class PropertyReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path
        self.keys: set[str] | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if f.attribute == ("key",) and isinstance(f, (EqualTo, In)) and f.value is not None:
                asked = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.keys = asked if self.keys is None else self.keys & asked
            else:
                yield f

    def partitions(self) -> list[Asked]:
        out = []
        for part in manifest(self.path):
            own = None if self.keys is None else sorted(k for k in self.keys if k is not None and part["first"] <= k <= part["last"])
            if own is None or own:
                out.append(Asked(part["name"], part["index_bytes"], own))
        return out or [Asked("", 0, [])]

    def read(self, partition: Asked) -> Iterator[pa.RecordBatch]:
        if not partition.name:
            return
        index = json.loads(whole(f"{self.path}/{partition.name}.index"))
        wanted = None if partition.keys is None else set(partition.keys)
        rows = sorted(((at, size, key) for key, at, size in index if wanted is None or key in wanted), key=lambda r: r[:2])
        file, paid = Ranges(f"{self.path}/{partition.name}.blob"), partition.index_bytes
        held: list[tuple[int, int, str]] = []

        def batch() -> pa.RecordBatch:
            nonlocal paid
            low, high = held[0][0], max(at + max(size, 0) for at, size, _ in held)
            before = file.bytes_read
            data = file.read(low, high - low)
            values = [None if size < 0 else data[at - low : at - low + size] for at, size, _ in held]
            read = [file.bytes_read - before + paid] + [0] * (len(held) - 1)
            paid = 0
            return pa.RecordBatch.from_arrays([pa.array([k for _, _, k in held], pa.string()), pa.array(values, pa.binary()), pa.array(read, pa.int64())], names=["key", "value", "bytes_read"])

        for row in rows:
            if held and (row[0] > held[-1][0] + max(held[-1][1], 0) + GAP or len(held) == ROWS):
                yield batch()
                held = []
            held.append(row)
        if held:
            yield batch()


class PropertySource(DataSource):
    """options: path. Written with columns key and value; read with bytes_read beside them, what a row's read cost (0 for rows read with another)."""

    @classmethod
    def name(cls) -> str:
        return "properties"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> PropertyReader:
        return PropertyReader(self.options["path"])

    def writer(self, schema, overwrite: bool) -> PropertyWriter:
        return PropertyWriter(self.options["path"], overwrite)
