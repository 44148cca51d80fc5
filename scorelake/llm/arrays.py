"""Arrays in the shared folder: written by tasks, memory-mapped by the tasks that look things up.

Where the shared folder is a mounted path, files are mapped; in another store they are read
through Arrow's file systems. A file is written aside and renamed, so a task that runs twice
leaves one whole file, and a name always has the same content.
"""

import io
import os
import uuid
from urllib.parse import unquote, urlparse

import numpy as np


def _mounted(folder: str) -> str | None:
    parts = urlparse(folder)
    if parts.scheme in ("", "file"):
        return unquote(parts.path) if parts.scheme else folder
    return None


def write_array(folder: str, name: str, values: np.ndarray) -> None:
    path = _mounted(folder)
    if path is not None:
        aside = f"{path}/.{name}-{uuid.uuid4().hex}"
        with open(aside, "wb") as file:
            np.save(file, values)
        os.replace(aside, f"{path}/{name}.npy")
        return
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(folder)
    buffer = io.BytesIO()
    np.save(buffer, values)
    aside = f"{path}/.{name}-{uuid.uuid4().hex}"
    with store.open_output_stream(aside) as file:
        file.write(buffer.getbuffer())
    store.move(aside, f"{path}/{name}.npy")


def read_array(folder: str, name: str) -> np.ndarray:
    path = _mounted(folder)
    if path is not None:
        return np.load(f"{path}/{name}.npy", mmap_mode="r")
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(folder)
    with store.open_input_file(f"{path}/{name}.npy") as file:
        return np.load(io.BytesIO(file.read()))


def has_array(folder: str, name: str) -> bool:
    path = _mounted(folder)
    if path is not None:
        return os.path.exists(f"{path}/{name}.npy")
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(folder)
    return store.get_file_info(f"{path}/{name}.npy").type == fs.FileType.File


def in_planes(values: np.ndarray) -> bytes:
    """The bytes of all values, first the lowest of each: what is zero in most values packs well."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T).tobytes()


def from_planes(raw: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).view(kind).reshape(-1)


def steps(values: np.ndarray) -> np.ndarray:
    """Differences of ascending unsigned values, the first from 0; ``np.cumsum`` is the way back."""
    return np.diff(values, prepend=values.dtype.type(0))
