"""Benchmark decontamination: SimHash fingerprints of item-sized windows, looked up by Hamming blocks.

Words are runs of ASCII letters, digits and characters beyond ASCII, in lower
case; shingles are five words (a shorter item: all its words).  An item of S
shingles is looked for in windows of ``WINDOW`` shingles (a short item: at most 0.8 S) that begin
at every ``STRIDE``-th shingle of a text; the item itself is tiled by such windows from its opening
to its end, each with a fingerprint for each shift below the stride, so one window lies shingle for
shingle within any copy of a tile, and a copy with few edits has a tile with hardly any.  A larger
window at the opening, of up to 0.8 S, finds copies whose edits are spread over all tiles.  Windows and items meet if their 64-bit fingerprints differ
by at most ``radius`` bits: cut into blocks, two such fingerprints agree within
``radius // blocks`` bits in one block, and each block has a table of all values
that near to an item's.  What meets is verified exactly: the weighted Jaccard
similarity of the shingles' multisets, weights by rarity among all items, of
the item and the window of its size, for starts near the place found (words may have come or gone before the tile).

The benchmark is read in slices of at most ``slice_items`` items, and only a
slice's fingerprints go to the tasks; documents are read once for each slice,
whole, without a shuffle.

Defined results: null or empty texts and items have no shingles and match
nothing; repeated documents or items give repeated rows; a text or an item of
any length is used whole; an empty table gives no rows; only ``doc_id`` and
``text``, ``item_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ALNUM, chunks, fold_case, let_go, materialize, shingle_hashes, text_bytes, word_hashes, words

STRIDE = 4
#: Shingles of a window, where the item isn't shorter.
WINDOW = 24
BLOCKS = ((0, 22), (22, 21), (43, 21))
SCHEMA = "doc_id long, item_id long, similarity double, start long, n_words long"


def _window(shingles: int, threshold: float) -> tuple[int, int]:
    """Window size and stride for an item of so many shingles."""
    most = min(shingles - STRIDE + 1, int(threshold * shingles))
    if most < 2 * STRIDE:
        return max(1, int(threshold * shingles)), 1
    size = 2 * STRIDE
    while size + max(STRIDE, size // 2 // STRIDE * STRIDE) <= most:
        size += max(STRIDE, size // 2 // STRIDE * STRIDE)
    return size, STRIDE


def _tiles(shingles: int, size: int, stride: int) -> list[int]:
    """Where an item's windows begin, evenly from its opening to its end."""
    last = shingles - size - stride + 1
    m = -(-last // size)
    return sorted({last * k // m for k in range(m + 1)}) if last > 0 else [0]


def fingerprints(h: np.ndarray, first: np.ndarray, sizes: list[int], stride: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each size: SimHash of all windows of so many shingles, and where they begin, at multiples of ``stride`` from each row's start."""
    counts = np.diff(first) // stride
    row_block = np.concatenate([[0], np.cumsum(counts)])
    row = np.repeat(np.arange(len(counts)), counts)
    begin = first[:-1][row] + stride * (np.arange(len(row)) - row_block[:-1][row])
    bits = np.unpackbits(h[begin[:, None] + np.arange(stride)].astype("<u8").view(np.uint8).reshape(-1, stride, 8), axis=2, bitorder="little")
    sums = np.zeros((len(row) + 1, 64), np.int32)
    np.cumsum(bits.sum(axis=1, dtype=np.uint8), axis=0, out=sums[1:])
    for size in sizes:
        m = size // stride
        at = np.flatnonzero(np.arange(len(row)) + m <= row_block[1:][row])
        ones = sums[at + m] - sums[at] > size // 2
        yield size, np.packbits(ones, axis=1, bitorder="little").view("<u8").ravel(), begin[at]


class _Tables:
    """Fingerprints of items, with a table for each block of all values near to one."""

    def __init__(self, radius: int):
        self.radius, self.prints, self.owners = radius, [], []

    def add(self, prints: np.ndarray, item: int, shifts: range) -> None:
        self.prints += prints.tolist()
        self.owners += [(item, shift) for shift in shifts]

    def build(self) -> None:
        self.prints = np.array(self.prints, np.uint64)
        near, self.tables = self.radius // len(BLOCKS), []
        for low, width in BLOCKS:
            masks = np.array([sum(1 << b for b in c) for k in range(near + 1) for c in combinations(range(width), k)], np.int64)
            own = ((self.prints >> np.uint64(low)) & np.uint64((1 << width) - 1)).astype(np.int64)
            keys = (own[:, None] ^ masks).ravel()
            order = np.argsort(keys, kind="stable")
            hit = np.zeros(1 << width, bool)
            hit[keys] = True
            self.tables.append((low, width, hit, keys[order], (order // len(masks))))

    def near(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All pairs (place in ``prints``, place in items' fingerprints) within the radius."""
        found = []
        for low, width, hit, keys, owner in self.tables:
            value = ((prints >> np.uint64(low)) & np.uint64((1 << width) - 1)).astype(np.int64)
            at = np.flatnonzero(hit[value])
            lo, hi = np.searchsorted(keys, value[at], "left"), np.searchsorted(keys, value[at], "right")
            size = hi - lo
            who = owner[np.repeat(lo - (np.cumsum(size) - size), size) + np.arange(size.sum())]
            at = np.repeat(at, size)
            fine = np.bitwise_count(prints[at] ^ self.prints[who]) <= self.radius
            found.append(at[fine] * len(self.prints) + who[fine])
        both = np.unique(np.concatenate(found))
        return both // len(self.prints), both % len(self.prints)


class Items:
    """A slice of the benchmark, ready to be looked for."""

    def __init__(self, texts: list[str | None], threshold: float, radius: int, n: int = 5, df: dict[int, int] | None = None, total: int | None = None):
        """``df``: items that hold a shingle, where they are several, and ``total``: all items; of the whole benchmark, where ``texts`` is a slice."""
        self.threshold, self.n = threshold, n
        self.shingles: list[np.ndarray] = []
        self.n_words: list[int] = []
        self.groups: dict[tuple[int, int, int], _Tables] = {}
        for k, text in enumerate(texts):
            h, first = _shingles(*text_bytes(pa.array([text], pa.string())), n)
            n_words = len(h) + n - 1 if len(h) > 1 else self._words(text)
            length = min(n, n_words)
            self.shingles.append(h)
            self.n_words.append(n_words)
            if not len(h):
                continue
            size, stride = _window(len(h), threshold)
            places = {(size, 0)} | {(small, tile) for small in [min(size, WINDOW)] for tile in _tiles(len(h), small, stride)}
            for size, tile in sorted(places):
                tables = self.groups.setdefault((length, size, stride), _Tables(radius))
                shifts = range(tile, tile + stride)
                tables.add(np.concatenate([next(fingerprints(h[j : j + size], np.array([0, size]), [size], stride))[1] for j in shifts]), k, shifts)
        for tables in self.groups.values():
            tables.build()
        own = Counter(x for s in self.shingles for x in set(s.tolist()))
        total = len(texts) if total is None else total
        self.weights = {x: float(np.log1p(total / (c if df is None else df.get(x, 1)))) for x, c in own.items()}
        self.other = float(np.log1p(total))
        self.bags = [Counter(s.tolist()) for s in self.shingles]

    @staticmethod
    def _words(text: str | None) -> int:
        data, offsets = text_bytes(pa.array([text], pa.string()))
        return len(words(fold_case(data), offsets, ALNUM)[0])

    def similarity(self, item: int, window: np.ndarray) -> float:
        """Weighted Jaccard similarity of two multisets of shingles."""
        bag, own = self.bags[item], Counter(window.tolist())
        both = total = 0.0
        for x in bag.keys() | own.keys():
            w = self.weights.get(x, self.other)
            both += w * min(bag[x], own[x])
            total += w * max(bag[x], own[x])
        return both / total if total else 0.0

    def matches(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, float, int]]:
        """(row, item, similarity, start in shingles) of the best window of every matching row and item."""
        best: dict[tuple[int, int], tuple[float, int]] = {}
        by_shape: dict[tuple[int, int], list[int]] = {}
        for length, size, stride in self.groups:
            by_shape.setdefault((length, stride), []).append(size)
        for (length, stride), sizes in by_shape.items():
            h, first = _shingles(data, offsets, length)
            for size, prints, begin in fingerprints(h, first, sorted(sizes), stride):
                tables = self.groups[(length, size, stride)]
                at, who = tables.near(prints)
                row = np.searchsorted(first, begin[at], "right") - 1
                seen = set()
                for r, w, b in zip(row, who, begin[at], strict=True):
                    item, shift = tables.owners[w]
                    slack = 2 + int((1 / self.threshold - 1) * shift)
                    seen |= {(int(r), item, int(b) - shift + d) for d in range(-slack, slack + 1)}
                for r, item, shifted in sorted(seen):
                    lo, hi = max(shifted, int(first[r])), min(shifted + len(self.shingles[item]), int(first[r + 1]))
                    s = self.similarity(item, h[lo:hi]) if hi > lo else 0.0
                    here = (s, -(lo - int(first[r])))
                    if s >= self.threshold and here > best.get((r, item), (0.0, 0)):
                        best[(r, item)] = here
        return [(r, item, s, -start) for (r, item), (s, start) in sorted(best.items())]


def _shingles(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    data = fold_case(data)
    starts, ends, first = words(data, offsets, ALNUM)
    return shingle_hashes(word_hashes(data, starts, ends), first, n)


def find_leaks(documents: DataFrame, benchmark: DataFrame, threshold: float = 0.8, radius: int = 11, slice_items: int = 2000) -> DataFrame:
    """doc_id, item_id, similarity, start (in words) and n_words (the item's words) of every text that holds an item.

    ``threshold``: least weighted Jaccard similarity of five-word shingles.  ``radius``: bits that fingerprints may differ by.
    """
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    total = items.count()
    slices = max(1, -(-total // slice_items))
    items = items.withColumn("slice", F.pmod(F.xxhash64("item_id", "text"), F.lit(slices)))

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, first = _shingles(*text_bytes(batch.column(0)), 5)
            own = [np.unique(h[i:j]) for i, j in zip(first[:-1], first[1:], strict=True)]
            of_slice = np.repeat(batch.column(1).to_numpy(), [len(x) for x in own])
            yield pa.RecordBatch.from_pydict({"hash": np.concatenate([np.zeros(0, np.uint64), *own]).view(np.int64), "slice": of_slice})

    # items that hold a shingle, of all items; a slice gets those of its own shingles
    by_slice = materialize(items.select("text", "slice").mapInArrow(distinct, "hash long, slice long").groupBy("hash", "slice").agg(F.count("*").alias("own")), "item-shingles")
    several = materialize(by_slice.join(by_slice.groupBy("hash").agg(F.sum("own").alias("n")).where("n > 1"), "hash").select("slice", "hash", "n"), "item-frequencies")
    found = None
    for k in range(slices):
        own = items.where(F.col("slice") == k).orderBy("item_id", "text").toArrow()
        counts = several.where(F.col("slice") == k).select("hash", "n").toArrow()
        df = dict(zip(counts.column("hash").to_numpy().view(np.uint64).tolist(), counts.column("n").to_pylist(), strict=True))
        ids, source = own.column("item_id").to_pylist(), own.column("text").to_pylist()

        def run(batches: Iterator[pa.RecordBatch], ids=ids, source=source, df=df) -> Iterator[pa.RecordBatch]:
            let_go()
            items = Items(source, threshold, radius, df=df, total=total)
            for batch in batches:
                data, offsets = text_bytes(batch.column(1))
                docs = batch.column(0)
                for i, j in chunks(offsets):
                    rows = items.matches(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                    r, item, similarity, start = (list(c) for c in zip(*rows, strict=True)) if rows else ([], [], [], [])
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": docs.take(pa.array([i + x for x in r], pa.int64())), "item_id": pa.array([ids[x] for x in item], pa.int64()), "similarity": pa.array(similarity, pa.float64()),
                        "start": pa.array(start, pa.int64()), "n_words": pa.array([items.n_words[x] for x in item], pa.int64()),
                    })

        part = texts.mapInArrow(run, SCHEMA)
        found = part if found is None else found.unionByName(part)
    return found
