"""Files that tasks write to the shared folder and other tasks map into memory."""

import atexit
import json
import mmap
import os
import shutil
import tempfile
import uuid

import numpy as np
from pyarrow import fs

_LOCAL: dict[str, str] = {}


def put(folder: str, name: str, arrays: dict[str, np.ndarray], facts: dict) -> None:
    """Writes arrays as one file. It appears whole or not at all, so a task may run twice or die."""
    system, path = fs.FileSystem.from_uri(folder)
    system.create_dir(path, recursive=True)
    head, at, parts = {}, 0, []
    for key, a in arrays.items():
        data = np.ascontiguousarray(a).tobytes()
        head[key] = (a.dtype.str, len(a), at)
        parts.append(data + b"\0" * (-len(data) % 8))
        at += len(parts[-1])
    text = json.dumps({"arrays": head, "facts": facts}).encode()
    text += b" " * (-len(text) % 8)
    unfinished = f"{path}/.{name}-{uuid.uuid4().hex}"
    with system.open_output_stream(unfinished) as out:
        out.write(len(text).to_bytes(8, "little") + text)
        for data in parts:
            out.write(data)
    system.move(unfinished, f"{path}/{name}")


def _local(folder: str, name: str) -> str:
    """A path that can be mapped: the shared file itself, or a copy that goes with this process."""
    system, path = fs.FileSystem.from_uri(folder)
    if isinstance(system, fs.LocalFileSystem):
        return f"{path}/{name}"
    if "dir" not in _LOCAL:
        _LOCAL["dir"] = tempfile.mkdtemp(prefix="mapped-")
        atexit.register(shutil.rmtree, _LOCAL["dir"], ignore_errors=True)
    key = f"{folder}/{name}"
    if key not in _LOCAL:
        to = f"{_LOCAL['dir']}/{uuid.uuid4().hex}"
        with system.open_input_stream(f"{path}/{name}") as read, open(to, "wb") as write:
            shutil.copyfileobj(read, write)
        _LOCAL[key] = to
    return _LOCAL[key]


def get(folder: str, name: str) -> tuple[dict[str, np.ndarray], dict]:
    """The arrays of a file, mapped read-only, and its facts."""
    with open(_local(folder, name), "rb") as file:
        whole = mmap.mmap(file.fileno(), os.fstat(file.fileno()).st_size, access=mmap.ACCESS_READ)
    size = int.from_bytes(whole[:8], "little")
    head = json.loads(whole[8 : 8 + size])
    arrays = {
        k: np.frombuffer(whole, np.dtype(kind), n, 8 + size + at) for k, (kind, n, at) in head["arrays"].items()
    }
    return arrays, head["facts"]
