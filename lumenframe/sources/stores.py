"""Files of any store that executors reach, read in ranges."""

from __future__ import annotations

from pyarrow import fs


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def files_of(path: str, ending: str) -> list[str]:
    """A file, or a folder's files with an ending, in order of their names."""
    store, inner = opened(path)
    info = store.get_file_info(inner)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    if info.type == fs.FileType.File:
        return [path]
    found = store.get_file_info(fs.FileSelector(inner))
    base = path[: len(path) - len(inner)] if path.endswith(inner) else ""
    return sorted(base + f.path for f in found if f.type == fs.FileType.File and f.path.endswith(ending))


class Ranges:
    """A file that is read by ranges, and how many bytes were."""

    def __init__(self, path: str):
        store, inner = opened(path)
        self.file = store.open_input_file(inner)
        self.size = self.file.size()
        self.bytes_read = 0

    def read(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        data = self.file.read(n)
        self.bytes_read += len(data)
        return data


def put(path: str, data: bytes) -> None:
    """Writes a small file in one go."""
    store, inner = opened(path)
    with store.open_output_stream(inner) as out:
        out.write(data)


def made(path: str) -> None:
    store, inner = opened(path)
    store.create_dir(inner, recursive=True)


def whole(path: str) -> bytes:
    file = Ranges(path)
    return file.read(0, file.size)


def kept_only(folder: str, names: set[str]) -> None:
    """Removes a folder's files that aren't named, and the folder if none is."""
    store, inner = opened(folder)
    if not names:
        if store.get_file_info(inner).type == fs.FileType.Directory:
            store.delete_dir(inner)
        return
    for f in store.get_file_info(fs.FileSelector(inner)):
        if f.type == fs.FileType.File and f.base_name not in names:
            store.delete_file(f.path)
