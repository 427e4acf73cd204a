"""A Spark data source of image planes, whose partitions are ranges of a file's planes.

spark.dataSource.register(PlaneSource); spark.read.format("planes").option("kind", "nd2").load(path)

Kinds: nd2 (chunked microscope files), tiff (baseline grey pages, uncompressed), npy (arrays of two or
more dimensions, the last two being a plane). A file's head and its map of planes are read once to
plan; a task then reads its own planes only, so files may be larger than any task's memory.
Filters on path, frame_i and channel_i are pushed: planes that they leave out are never read. With
option pixels=false only places and sizes come back, and no plane is read at all.
"""

from __future__ import annotations

import ast
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from . import nd2
from .stores import Ranges, files_of

#: Bytes of planes that a partition holds on average.
PARTITION = 64_000_000
SCHEMA = "path string, frame_i int, channel_i int, height int, width int, bytes_read long, pixels array<float>"


@dataclass(frozen=True)
class Plane:
    """Where a plane lies: samples of `kind` from `at`, every step-th one from the first."""

    frame_i: int
    channel_i: int
    height: int
    width: int
    at: int
    size: int
    kind: str
    step: int = 1


@dataclass
class Range(InputPartition):
    path: str
    planes: list[Plane]


def nd2_planes(file: Ranges) -> list[Plane]:
    tail = file.read(file.size - 40, 40)
    if tail[:32] != nd2.SIGNATURE:
        raise ValueError("no chunk map")
    begin = struct.unpack("<Q", tail[32:])[0]
    places = nd2.chunk_map(file.read(begin, file.size - begin), begin)
    head = lambda at: struct.unpack("<IIQ", file.read(at, 16))
    mark, name, size = head(places["ImageAttributesLV"])
    attributes = nd2.values(file.read(places["ImageAttributesLV"] + 16 + name, size))["SLxImageAttributes"]
    width, height, parts = attributes["uiWidth"], attributes["uiHeight"], attributes.get("uiComp", 1)
    out = []
    for key in sorted((n for n in places if n.startswith("ImageDataSeq|")), key=lambda n: int(n.split("|")[1])):
        mark, name, _ = head(places[key])
        if mark != nd2.MARK:
            raise ValueError("not a chunk")
        at = places[key] + 16 + name + 8  # eight bytes of time come first
        out += [Plane(int(key.split("|")[1]), c, height, width, at + 2 * c, 2 * (width * height - 1) * parts + 2, "<u2", parts) for c in range(parts)]
    return out


def tiff_planes(file: Ranges) -> list[Plane]:
    head = file.read(0, 8)
    end = {b"II": "<", b"MM": ">"}.get(head[:2])
    if end is None or struct.unpack(end + "H", head[2:4])[0] != 42:
        raise ValueError("not a TIFF file")
    at, out = struct.unpack(end + "I", head[4:8])[0], []
    while at:
        n = struct.unpack(end + "H", file.read(at, 2))[0]
        body = file.read(at + 2, 12 * n + 4)
        tags = {}
        for k in range(n):
            tag, kind, count = struct.unpack_from(end + "HHI", body, 12 * k)
            form = {3: "H", 4: "I"}.get(kind)
            if form is None:
                continue
            size = struct.calcsize(form) * count
            raw = body[12 * k + 8 : 12 * k + 12] if size <= 4 else file.read(struct.unpack_from(end + "I", body, 12 * k + 8)[0], size)
            tags[tag] = struct.unpack_from(end + form * count, raw, 0)
        if tags.get(259, (1,))[0] != 1:
            raise ValueError("compressed TIFF pages aren't read")
        width, height, bits = tags[256][0], tags[257][0], tags.get(258, (8,))[0]
        offsets, sizes = tags[273], tags[279]
        if any(a + n != b for a, n, b in zip(offsets, sizes, offsets[1:], strict=False)):
            raise ValueError("strips of a page must follow each other")
        form = "f" if tags.get(339, (1,))[0] == 3 else "u"
        out.append(Plane(len(out), 0, height, width, offsets[0], sum(sizes), f"{end}{form}{bits // 8}"))
        at = struct.unpack_from(end + "I", body, 12 * n)[0]
    return out


def npy_planes(file: Ranges) -> list[Plane]:
    head = file.read(0, 12)
    if head[:6] != b"\x93NUMPY":
        raise ValueError("not an array file")
    n, start = (struct.unpack("<H", head[8:10])[0], 10) if head[6] == 1 else (struct.unpack("<I", head[8:12])[0], 12)
    said = ast.literal_eval(file.read(start, n).decode("latin1"))
    shape, kind = said["shape"], np.dtype(said["descr"])
    if said["fortran_order"] or len(shape) < 2:
        raise ValueError("planes must be rows of a C-ordered array of two or more dimensions")
    height, width = shape[-2:]
    size = height * width * kind.itemsize
    channels = shape[-3] if len(shape) > 3 else 1
    return [Plane(i // channels, i % channels, height, width, start + n + i * size, size, kind.str) for i in range(int(np.prod(shape[:-2], dtype=np.int64)))]


KINDS = {"nd2": (nd2_planes, ".nd2"), "tiff": (tiff_planes, ".tif"), "npy": (npy_planes, ".npy")}


class PlaneReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.kind = options["path"], options.get("kind", "nd2")
        self.limit, self.pixels = int(options.get("partitionbytes", PARTITION)), options.get("pixels", "true").lower() == "true"
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes comparisons of path, frame_i and channel_i; what is left goes back to Spark."""
        for f in filters:
            name = {EqualTo: "==", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<=", In: "in"}.get(type(f))
            if name and f.attribute in (("path",), ("frame_i",), ("channel_i",)) and f.value is not None:
                self.tests.append((f.attribute[0], name, f.value))
            else:
                yield f

    def _wanted(self, path: str, plane: Plane | None) -> bool:
        for column, test, value in self.tests:
            if plane is None and column != "path":
                continue
            own = path if column == "path" else getattr(plane, column)
            if not {"==": lambda: own == value, ">": lambda: own > value, ">=": lambda: own >= value, "<": lambda: own < value, "<=": lambda: own <= value, "in": lambda: own in value}[test]():
                return False
        return True

    def partitions(self) -> list[Range]:
        planes_of, ending = KINDS[self.kind]
        out: list[Range] = []
        for path in files_of(self.path, ending):
            if not self._wanted(path, None):
                continue
            held, size = [], 0
            for plane in planes_of(Ranges(path)):
                if not self._wanted(path, plane):
                    continue
                if held and size + plane.size > self.limit and plane.frame_i != held[-1].frame_i:
                    out.append(Range(path, held))
                    held, size = [], 0
                held.append(plane)
                size += plane.size
            if held:
                out.append(Range(path, held))
        return out or [Range("", [])]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        if not partition.planes:
            return
        file = Ranges(partition.path) if self.pixels else None
        for p in partition.planes:
            before, values = file.bytes_read if file else 0, None
            if file:
                raw = np.frombuffer(file.read(p.at, p.size), p.kind)[:: p.step][: p.height * p.width]
                values = pa.ListArray.from_arrays(pa.array([0, len(raw)], pa.int32()), pa.array(raw.astype(np.float32)))
            columns = [pa.array([partition.path]), *(pa.array([x], pa.int32()) for x in (p.frame_i, p.channel_i, p.height, p.width)), pa.array([(file.bytes_read - before) if file else 0], pa.int64()), values if values is not None else pa.nulls(1, pa.list_(pa.float32()))]
            yield pa.RecordBatch.from_arrays(columns, names=["path", "frame_i", "channel_i", "height", "width", "bytes_read", "pixels"])


class PlaneSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "planes"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> PlaneReader:
        return PlaneReader(dict(self.options))
