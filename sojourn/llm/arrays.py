"""Numpy arrays in files of the shared folder: named, each optionally compressed, readable one by one or mapped."""

from __future__ import annotations

import json

import numpy as np
import pyarrow.fs as pafs
import zstandard


def squeezed(a: np.ndarray) -> bytes:
    """The array's bytes plane by plane (all lowest bytes first), so that small integers compress well."""
    return zstandard.compress(a.view(np.uint8).reshape(len(a), -1).T.tobytes(), 1)


def unsqueezed(data: bytes, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def save(path: str, arrays: dict[str, np.ndarray], compress: bool) -> None:
    blobs = [squeezed(a) if compress else a.tobytes() + bytes(-a.nbytes % 8) for a in arrays.values()]
    at, index = 0, {}
    for (name, a), blob in zip(arrays.items(), blobs):
        index[name] = [a.dtype.str, len(a), at, len(blob)]
        at += len(blob)
    head = json.dumps({"zstd": compress, "arrays": index}).encode()
    head += b" " * (-len(head) % 8)
    fs, file = pafs.FileSystem.from_uri(path)
    fs.create_dir(file.rsplit("/", 1)[0], recursive=True)
    with fs.open_output_stream(file, compression=None) as out:
        out.write(len(head).to_bytes(8, "little") + head)
        for blob in blobs:
            out.write(blob)


def load(path: str, names: list[str]) -> list[np.ndarray]:
    """The named arrays of a compressed file, read one by one."""
    fs, file = pafs.FileSystem.from_uri(path)
    with fs.open_input_file(file) as f:
        n = int.from_bytes(f.read(8), "little")
        index = json.loads(f.read(n))["arrays"]
        out = []
        for name in names:
            kind, _, at, size = index[name]
            f.seek(8 + n + at)
            out.append(unsqueezed(f.read(size), kind))
    return out


def mapped(path: str) -> dict[str, np.ndarray]:
    """All arrays of an uncompressed file: memory-mapped on a local or mounted file system, else read."""
    fs, file = pafs.FileSystem.from_uri(path)
    if isinstance(fs, pafs.LocalFileSystem):
        data = np.memmap(file, np.uint8, "r")
    else:
        with fs.open_input_file(file) as f:
            data = np.frombuffer(f.read(), np.uint8)
    n = int.from_bytes(data[:8].tobytes(), "little")
    index = json.loads(data[8: 8 + n].tobytes())["arrays"]
    return {name: data[8 + n + at: 8 + n + at + np.dtype(kind).itemsize * size].view(kind) for name, (kind, size, at, _) in index.items()}
