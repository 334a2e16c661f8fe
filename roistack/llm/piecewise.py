"""Encoding texts by their pieces: each distinct piece is encoded once and its ids are kept.

A tokenizer that splits a text before its merges gives a text the ids of its
pieces in turn.  Cutting, looking up and joining run over whole chunks of text
in numpy and Arrow; only pieces that aren't kept yet reach the tokenizer.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa


class PieceEncoder:
    """Subclasses say how to cut bytes into pieces and how to encode a list of pieces.

    ``keep``: pieces that are kept; beyond that all are forgotten and encoded anew when they come again.
    """

    def __init__(self, keep: int):
        self.keep = keep
        self.clear()

    def clear(self) -> None:
        self.slots: dict[bytes, int] = {}
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0
        self.first = [0]

    def cut(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The bytes to encode, and the starts and ends of the pieces of all rows, in order."""
        raise NotImplementedError

    def encode_pieces(self, pieces: list[str]) -> list[list[int]]:
        raise NotImplementedError

    def _add(self, pieces: list[str]) -> None:
        found = self.encode_pieces(pieces)
        ids = np.fromiter((x for f in found for x in f), np.uint32)
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(len(self.flat), np.uint32)])
        self.flat[self.used : self.used + len(ids)] = ids
        for piece, f in zip(pieces, found, strict=True):
            self.slots[piece] = len(self.first) - 1
            self.used += len(f)
            self.first.append(self.used)

    def encode(self, data: np.ndarray, offsets: np.ndarray, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows in turn, each row's with ``end`` appended if given, and the number of each row's."""
        data, starts, ends = self.cut(data, offsets)
        size = ends - starts
        bounds = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
        whole = bounds[-1] == len(data)  # the pieces are all of the bytes
        packed = np.ascontiguousarray(data if whole else data[np.repeat(starts - bounds[:-1], size) + np.arange(bounds[-1])])
        listed = pa.Array.from_buffers(pa.large_string(), len(size), [None, pa.py_buffer(bounds), pa.py_buffer(packed)]).dictionary_encode()
        names = listed.dictionary.to_pylist()
        if len(self.slots) > self.keep:
            self.clear()
        fresh = [w for w in names if w not in self.slots]
        for i in range(0, len(fresh), 50_000):
            self._add(fresh[i : i + 50_000])
        slots = np.fromiter((self.slots[w] for w in names), np.int64, len(names))
        first = np.array(self.first, np.int64)
        at = slots[listed.indices.to_numpy()] if len(names) else np.zeros(0, np.int64)
        count = first[at + 1] - first[at]
        before = np.concatenate([[0], np.cumsum(count)])
        row = np.searchsorted(offsets, starts, "right") - 1
        tail = 0 if end is None else 1
        per_row = np.bincount(row, weights=count, minlength=len(offsets) - 1).astype(np.int64) + tail
        source = np.repeat(first[at] - before[:-1], count) + np.arange(before[-1])
        ids = np.full(int(per_row.sum()), end or 0, np.uint32)
        ids[np.arange(before[-1]) + tail * np.repeat(row, count)] = self.flat[source]
        return ids, per_row


def binary_rows(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """A binary column whose rows are consecutive pieces of ``data``."""
    bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))]).cast(pa.binary())


def row_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary column without nulls and the offset of each row."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]
