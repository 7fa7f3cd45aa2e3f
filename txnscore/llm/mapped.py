"""Files of plain numeric arrays in the shared folder: written whole by a task, memory-mapped by workers."""

from __future__ import annotations

import functools
import mmap
import os
import tempfile
import uuid

import numpy as np

#: Files that one worker keeps mapped.
OPEN_FILES = 256


def _local(path: str) -> str | None:
    """The path itself if workers see it as a folder, None if it needs a file system client."""
    if path.startswith("file:"):
        return "/" + path[len("file:"):].lstrip("/")
    return path if "://" not in path else None


def write(path: str, arrays: list[np.ndarray]) -> None:
    """Write the arrays one after another behind their lengths. The file appears under its name when
    it is whole, so a repeated or speculative task replaces it with the same bytes."""
    head = np.array([len(arrays), *[len(a) for a in arrays]], np.int64)
    parts = [head.tobytes()]
    for a in arrays:
        parts += [a.tobytes(), bytes(-a.nbytes % 8)]
    temporary = f"{path}.{uuid.uuid4().hex}"
    local = _local(path)
    if local is not None:
        os.makedirs(os.path.dirname(local), exist_ok=True)
        with open(_local(temporary), "wb") as f:
            f.writelines(parts)
        os.replace(_local(temporary), local)
        return
    from pyarrow import fs
    system, name = fs.FileSystem.from_uri(temporary)
    system.create_dir(os.path.dirname(name), recursive=True)
    with system.open_output_stream(name) as f:
        for part in parts:
            f.write(part)
    system.move(name, fs.FileSystem.from_uri(path)[1])


@functools.lru_cache(maxsize=OPEN_FILES)
def read(path: str, types: tuple[str, ...]) -> list[np.ndarray] | None:
    """The arrays of a file, memory-mapped; None if there is no such file. From a store without
    folders the file is copied to one without a name, which goes with the mapping."""
    local = _local(path)
    try:
        if local is not None:
            with open(local, "rb") as f:
                data = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        else:
            from pyarrow import fs
            system, name = fs.FileSystem.from_uri(path)
            with system.open_input_stream(name) as source, tempfile.TemporaryFile() as f:
                while chunk := source.read(1 << 24):
                    f.write(chunk)
                f.flush()
                data = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
    except FileNotFoundError:
        return None
    lengths = np.frombuffer(data, np.int64, len(types), 8)
    out, at = [], 8 * (len(types) + 1)
    for kind, n in zip(types, lengths):
        out.append(np.frombuffer(data, kind, n, at))
        at += -(-out[-1].nbytes // 8) * 8
    return out
