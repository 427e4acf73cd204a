"""Reader of the chunked microscope container: planes and metadata of .nd2 files.

A file is chunks, each a header (mark, length of name, length of data), a name and data. Its last 40
bytes name the place of the chunk map, a list of names and places. Metadata chunks are trees of typed
values; image chunks hold eight bytes of time and 16-bit samples, components side by side.
"""

from __future__ import annotations

import struct

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

#: Fixed values of the format.
MARK, SIGNATURE = 0x0ABECEDA, b"ND2 CHUNK MAP SIGNATURE 0000001!"


def chunk(data: bytes, at: int) -> bytes:
    mark, name, size = struct.unpack_from("<IIQ", data, at)
    if mark != MARK:
        raise ValueError("not a chunk")
    return data[at + 16 + name : at + 16 + name + size]


def chunk_map(data: bytes, begin: int = 0) -> dict[str, int]:
    """Places of chunks by name; data: the file, or what follows from its place `begin`."""
    if len(data) < 40 or data[-40:-8] != SIGNATURE:
        raise ValueError("no chunk map")
    body = chunk(data, struct.unpack("<Q", data[-8:])[0] - begin)
    found, at = {}, 0
    while at < len(body):
        end = body.index(b"!", at) + 1
        name = body[at:end]
        if name == SIGNATURE:
            break
        found[name[:-1].decode()] = struct.unpack_from("<Q", body, end)[0]
        at = end + 16
    return found


def values(data: bytes, count: int | None = None) -> dict:
    """A tree of named values; names that repeat become lists."""
    out: dict = {}
    at, n = 0, 0
    while at < len(data) and (count is None or n < count):
        begin = at
        kind, length = data[at], data[at + 1]
        name = data[at + 2 : at + 2 + 2 * length].decode("utf-16-le").rstrip("\0")
        at += 2 + 2 * length
        if kind in (1, 2, 3, 4, 5, 6):
            form = {1: "<?", 2: "<i", 3: "<I", 4: "<q", 5: "<Q", 6: "<d"}[kind]
            value = struct.unpack_from(form, data, at)[0]
            at += struct.calcsize(form)
        elif kind == 8:
            end = at
            while data[end : end + 2] != b"\0\0":
                end += 2
            value, at = data[at:end].decode("utf-16-le"), end + 2
        elif kind == 9:
            size = struct.unpack_from("<Q", data, at)[0]
            value, at = data[at + 8 : at + 8 + size], at + 8 + size
        elif kind == 11:
            inner, size = struct.unpack_from("<IQ", data, at)
            value = values(data[at + 12 : begin + size], inner)
            at = begin + size + 8 * inner  # places of the inner values follow
        else:
            raise ValueError(f"unknown kind of value: {kind}")
        n += 1
        if name in out:
            out[name] = [*(out[name] if isinstance(out[name], list) else [out[name]]), value]
        else:
            out[name] = value
    return out


def planes(data: bytes) -> list[tuple[int, int, np.ndarray]]:
    """(frame, component, image) of every plane."""
    places = chunk_map(data)
    attributes = values(chunk(data, places["ImageAttributesLV"]))["SLxImageAttributes"]
    width, height, parts = attributes["uiWidth"], attributes["uiHeight"], attributes.get("uiComp", 1)
    out = []
    for name in sorted((n for n in places if n.startswith("ImageDataSeq|")), key=lambda n: int(n.split("|")[1])):
        samples = np.frombuffer(chunk(data, places[name])[8:], "<u2", width * height * parts).reshape(height, width, parts)
        out += [(int(name.split("|")[1]), c, samples[:, :, c]) for c in range(parts)]
    return out


def read_nd2(spark: SparkSession, path: str) -> DataFrame:
    """(path, frame_i, channel_i, height, pixels) of all files; a file is read by one task."""

    def run(batches):
        for batch in batches:
            for p, content in zip(batch["path"], batch["content"], strict=True):
                yield pd.DataFrame([(p, f, c, image.shape[0], image.astype(np.float32).ravel()) for f, c, image in planes(content)], columns=["path", "frame_i", "channel_i", "height", "pixels"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "path string, frame_i int, channel_i int, height int, pixels array<float>")
