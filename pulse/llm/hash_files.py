"""Sorted hash arrays in the shared folder, and grouping helpers for sorted arrays.

A file holds its length and then arrays of that length, the first of them
sorted.  Workers map files instead of loading them; a file that is not on a
file system they can map is copied to their temporary folder first.
"""

from __future__ import annotations

import os
import tempfile
import uuid

import numpy as np
import pandas as pd
import pyarrow.fs

from pulse.llm.common import ship

ship(__name__)


def shard_of(h: np.ndarray, bits: int) -> np.ndarray:
    return (h >> np.uint64(64 - bits)).astype(np.int64)


def run_starts(*keys: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal keys in sorted arrays."""
    if not len(keys[0]):
        return np.zeros(0, np.int64)
    new = np.ones(len(keys[0]), bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return np.nonzero(new)[0]


def sum_runs(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, starts) if len(starts) else values[:0]


def blocks(shard: np.ndarray, columns: dict[str, np.ndarray]) -> pd.DataFrame:
    """One row per shard with the bytes of each column; shard ascends."""
    starts = run_starts(shard)
    ends = [*starts[1:], len(shard)]
    return pd.DataFrame({"shard": shard[starts].astype(np.int32), **{
        name: [values[a:b].tobytes() for a, b in zip(starts, ends)] for name, values in columns.items()}})


def joined(frame: pd.DataFrame, name: str, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(frame[name]), dtype)


def local_path(path: str) -> str | None:
    if path.startswith("file:"):
        return "/" + path[5:].lstrip("/")
    return path if path.startswith("/") else None


def write_arrays(path: str, *arrays: np.ndarray) -> None:
    """Length, then the arrays; appears under its name only when complete."""
    data = [np.array([len(arrays[0])], np.int64).tobytes(), *(a.tobytes() for a in arrays)]
    local = local_path(path)
    files, target = (pyarrow.fs.LocalFileSystem(), local) if local else pyarrow.fs.FileSystem.from_uri(path)
    files.create_dir(os.path.dirname(target), recursive=True)
    partial = f"{target}.{uuid.uuid4().hex}"
    with files.open_output_stream(partial) as out:
        for part in data:
            out.write(part)
    files.move(partial, target)


def map_arrays(path: str, dtypes, expected: bool = False) -> list[np.ndarray]:
    """The arrays of a file, memory-mapped; if there is no such file, empty ones or, where it is expected, an error."""
    local = local_path(path)
    if local is None:
        files, target = pyarrow.fs.FileSystem.from_uri(path)
        if not expected and files.get_file_info(target).type == pyarrow.fs.FileType.NotFound:
            return [np.zeros(0, d) for d in dtypes]
        handle, local = tempfile.mkstemp()
        with files.open_input_stream(target) as source, os.fdopen(handle, "wb") as out:
            while part := source.read(1 << 24):
                out.write(part)
        mapped = np.memmap(local, np.uint8, "r")
        os.unlink(local)
    elif expected or os.path.exists(local):
        mapped = np.memmap(local, np.uint8, "r")
    else:
        return [np.zeros(0, d) for d in dtypes]
    n, at, out = int(mapped[:8].view(np.int64)[0]), 8, []
    for d in dtypes:
        size = n * np.dtype(d).itemsize
        out.append(mapped[at:at + size].view(np.dtype(d).base).reshape(-1, *np.dtype(d).shape))
        at += size
    return out


def mix64(x: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class HashFiles:
    """A worker's mapped files of one kind: ``<path>/<kind>-<shard>``.  With
    ``have``, the numbers of the files that were written, a file of theirs
    that is not there is an error and no other file is looked for."""

    def __init__(self, path: str, kind: str, dtypes, have: set[int] | None = None):
        self.path, self.kind, self.dtypes, self.have, self.open = path, kind, dtypes, have, {}

    def _open(self, number: int) -> list[np.ndarray]:
        if self.have is not None and number not in self.have:
            return [np.zeros(0, d) for d in self.dtypes]
        name = f"{self.path}/{self.kind}-{number:05d}"
        return map_arrays(name, self.dtypes, expected=self.have is not None)

    def find(self, shard: np.ndarray, key: np.ndarray) -> list[np.ndarray]:
        """For (shard, key) in sorted order: whether the key is there, then its columns (zero if not)."""
        out = [np.zeros((len(key), *np.dtype(d).shape), np.dtype(d).base) for d in self.dtypes[1:]]
        found = np.zeros(len(key), bool)
        starts = run_starts(shard)
        for a, b in zip(starts, [*starts[1:], len(shard)]):
            number = int(shard[a])
            if number not in self.open:
                self.open[number] = self._open(number)
            keys, *columns = self.open[number]
            if not len(keys):
                continue
            at = np.minimum(np.searchsorted(keys, key[a:b]), len(keys) - 1)
            hit = np.nonzero(keys[at] == key[a:b])[0]
            found[a + hit] = True
            for values, column in zip(out, columns):
                values[a + hit] = column[at[hit]]
        return [found, *out]
