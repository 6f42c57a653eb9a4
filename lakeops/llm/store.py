"""Arrays as files in the shared folder, memory-mapped where they are read."""

from __future__ import annotations

import os
import tempfile
import uuid

import numpy as np
from pyarrow import fs as arrow_fs


class Store:
    """A folder of raw arrays that every task can write to and read from.

    A file appears under its name only when it is whole, so a task that is run again,
    or twice, leaves the same file. A folder on a local or mounted path is mapped in
    place; from any other store a file is copied once to each worker's own folder.
    """

    def __init__(self, uri: str):
        self.uri = uri

    def write(self, name: str, array: np.ndarray) -> None:
        files, folder = arrow_fs.FileSystem.from_uri(self.uri)
        files.create_dir(folder, recursive=True)
        part = f"{folder}/.{name}-{uuid.uuid4().hex}"
        with files.open_output_stream(part) as out:
            out.write(np.ascontiguousarray(array).tobytes())
        files.move(part, f"{folder}/{name}")

    def open(self, name: str, kind: str) -> np.ndarray:
        files, folder = arrow_fs.FileSystem.from_uri(self.uri)
        path = f"{folder}/{name}"
        if files.type_name != "local":
            if self.uri not in _copies:
                _copies[self.uri] = tempfile.TemporaryDirectory(prefix="arrays-")
            local = os.path.join(_copies[self.uri].name, name)
            if not os.path.exists(local):
                arrow_fs.copy_files(path, local, source_filesystem=files, destination_filesystem=arrow_fs.LocalFileSystem())
            path = local
        if not os.path.getsize(path):
            return np.empty(0, kind)
        return np.memmap(path, dtype=kind, mode="r")


_copies: dict[str, tempfile.TemporaryDirectory] = {}
