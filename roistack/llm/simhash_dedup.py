"""SimHash near-dedup: tiled exact comparison of fingerprints, down to components.

A fingerprint bit is set where more than half of a text's shingle hashes have
it.  Distinct fingerprints lie in tiles by the population counts of their four
quarters; two fingerprints differ in at least as many bits as their counts
differ, so only tile pairs whose counts differ by at most the radius in sum are
compared, and those entirely: blocks of numpy exclusive-or and bit counts.

A fingerprint stays in its own tile and visits those of the near tiles that
come before it (21 of 41 at radius 2).  A tile of many fingerprints is cut into
chunks by hash, and each chunk of its own meets each chunk of its visitors in a
group of bounded size, anywhere on the cluster.  A group reports a spanning
forest of its links rather than all of them.

Shuffled: 21 rows of some 20 bytes for each distinct fingerprint.  Broadcast:
the tiles' sizes, at most 17 ** 4 rows.  To the driver: counts.

Defined results: a null, empty or blank text has fingerprint zero and is linked
like any other; rows that share a ``doc_id`` are each looked at; a null
``doc_id`` is never a component's name unless all of its are null; an empty
table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NON_SPACE, chunks, fold_case, materialize, text_bytes, words
from .graph import connected_components

#: Parts of a fingerprint whose population counts tell tiles apart; (64 / PARTS + 1) ** PARTS bounds the number of tiles.
PARTS = 4
#: Between the counts of neighbouring parts in a tile's number.
DIGIT = 128
#: Fingerprints of a tile, and visitors to it, that are compared in one group.
HOMES, VISITORS = 2048, 8192
#: Comparisons that are looked at together.
BLOCK = 1 << 20


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words, each followed by a blank, and where each starts and ends there."""
    sizes = ends - starts
    first = np.cumsum(sizes + 1) - sizes - 1
    out = np.full(int(sizes.sum()) + len(sizes), 0x20, np.uint8)
    at = np.arange(int(sizes.sum()))
    word = np.repeat(np.arange(len(sizes)), sizes)
    out[at + word] = data[at + np.repeat(starts - (first - np.arange(len(sizes))), sizes)]
    return out.tobytes(), first, first + sizes


def fingerprints(data: np.ndarray, offsets: np.ndarray, n: int = 3, seed: int = 42) -> np.ndarray:
    """The 64-bit SimHash of each row's shingles of ``n`` words, repeats included."""
    data = fold_case(data)
    starts, ends, first = words(data, offsets, NON_SPACE)
    text, starts, ends = _joined(data, starts, ends)
    counts = np.diff(first)
    have = np.where(counts >= n, counts - n + 1, (counts > 0).astype(np.int64))
    row_first = np.concatenate([[0], np.cumsum(have)])
    rows = np.repeat(np.arange(len(counts)), have)
    at = first[:-1][rows] + np.arange(len(rows)) - row_first[:-1][rows]
    last = at + np.minimum(counts, n)[rows] - 1
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(text[a:b], seed) for a, b in zip(starts[at].tolist(), ends[last].tolist(), strict=True)), np.uint64, len(at))
    out = np.zeros(len(counts), np.uint64)
    some = np.flatnonzero(have)
    if len(some):
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones = np.add.reduceat(bits, row_first[some], axis=0, dtype=np.int32)
        out[some] = np.packbits(2 * ones > have[some, None], axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def _prints(texts: DataFrame, n: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for i, j in chunks(offsets):
                own = fingerprints(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], n)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(own.view(np.int64))], names=["doc_id", "print"])

    return texts.mapInArrow(run, "doc_id long, print long")


def near_tiles(radius: int) -> list[int]:
    """Differences of numbers of tiles whose counts differ by at most ``radius`` in sum; one of each two opposite ones, and zero.

    A count beyond a part's bits, or below zero, gives a number that no tile has.
    """
    steps = [d for d in product(range(-radius, radius + 1), repeat=PARTS) if sum(map(abs, d)) <= radius and d >= (0,) * PARTS]
    return [sum(x * DIGIT**k for k, x in enumerate(reversed(d))) for d in steps]


def forest(a: np.ndarray, b: np.ndarray, n: int, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Of links between ``n`` and ``m`` nodes (numbered on after the first ones) as few as connect the same nodes."""
    b = b + n
    if len(a) <= n + m:
        return a, b
    label = np.arange(n + m)
    while True:
        before = label.copy()
        np.minimum.at(label, b, label[a])
        np.minimum.at(label, a, label[b])
        label = label[label]
        if (before == label).all():
            node = np.flatnonzero(label != np.arange(n + m))
            return node, label[node]


def _compare(radius: int):
    """Rows ``home``, ``i``, ``j``, ``visitor``, ``print`` in order of the first four: the links of each group."""

    def linked(own: np.ndarray, other: np.ndarray) -> Iterator[pa.RecordBatch]:
        step = max(1, BLOCK // len(own))
        for k in range(0, len(other), step):
            part = other[k : k + step]
            # a fingerprint's distance to itself, 0 - 1, is 255
            a, b = np.nonzero(np.bitwise_count(own[:, None] ^ part) - np.uint8(1) < np.uint8(radius))
            if len(a):
                both = np.concatenate([own, part]).view(np.int64)
                a, b = forest(a, b, len(own), len(part))
                yield pa.RecordBatch.from_arrays([pa.array(both[a]), pa.array(both[b])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, own = None, np.zeros(0, np.uint64)
        for batch in batches:
            if not batch.num_rows:
                continue
            home, i, j, visitor = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(4))
            prints = batch.column(4).to_numpy().view(np.uint64)
            new = np.flatnonzero((np.diff(home) != 0) | (np.diff(i) != 0) | (np.diff(j) != 0) | (np.diff(visitor) != 0)) + 1
            for a, b in zip([0, *new.tolist()], [*new.tolist(), len(home)], strict=True):
                here = (home[a], i[a], j[a])
                if here != key:
                    key, own = here, np.zeros(0, np.uint64)
                if not visitor[a]:
                    own = np.concatenate([own, prints[a:b]])
                elif len(own):
                    yield from linked(own, prints[a:b])

    return run


def links(prints: DataFrame, radius: int) -> DataFrame:
    """Pairs ``a``, ``b`` of distinct fingerprints (column ``print``) that connect all which differ in at most ``radius`` bits."""
    if radius < 1:
        return prints.sparkSession.createDataFrame([], "a long, b long")
    wide = 64 // PARTS
    counts = [F.bit_count(F.shiftrightunsigned("print", wide * k).bitwiseAND(F.lit((1 << wide) - 1))).cast("long") for k in range(PARTS)]
    tile = sum((c * DIGIT**k for k, c in enumerate(counts)), F.lit(0).cast("long"))
    placed = prints.select("print", tile.alias("tile"))
    steps = F.explode(F.array(*[F.lit(d).cast("long") for d in near_tiles(radius)])).alias("step")

    sizes = materialize(placed.groupBy("tile").agg(F.count("*").alias("n")), "tiles")
    visits = sizes.select(steps, "tile", "n").groupBy((F.col("tile") - F.col("step")).alias("home")).agg(F.sum("n").alias("visits"))
    split = lambda n, most: F.ceil(F.col(n) / most).cast("int")
    tiles = F.broadcast(materialize(sizes.withColumnRenamed("tile", "home").join(visits, "home").select("home", split("n", HOMES).alias("own"), split("visits", VISITORS).alias("others")), "tile-chunks"))

    chunk = lambda n: F.pmod(F.xxhash64("print"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    homes = placed.withColumnRenamed("tile", "home").join(tiles, "home").select("home", chunk("own").alias("i"), each("others").alias("j"), F.lit(False).alias("visitor"), "print")
    guests = placed.select("print", "tile", steps).select((F.col("tile") - F.col("step")).alias("home"), "print").join(tiles, "home").select("home", each("own").alias("i"), chunk("others").alias("j"), F.lit(True).alias("visitor"), "print")
    # as many tasks as there are partitions: few bytes take much comparing
    n = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = homes.union(guests).repartition(n, "home", "i", "j").sortWithinPartitions("home", "i", "j", "visitor")
    return met.mapInArrow(_compare(radius), "a long, b long")


def simhash_components(documents: DataFrame, n: int = 3, radius: int = 2) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id of each row; fingerprints link at ``radius`` or fewer differing bits."""
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    prints = materialize(_prints(texts, n), "fingerprints")
    nodes = materialize(prints.groupBy("print").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    found = connected_components(links(nodes.select("print"), radius))
    named = nodes.join(found, F.col("print") == F.col("node"), "left").select("print", "least", F.coalesce("component", "print").alias("component"))
    names = named.join(named.groupBy("component").agg(F.min("least").alias("component_id")), "component").select("print", "component_id")
    hexadecimal = F.lpad(F.lower(F.hex("print")), 16, "0")
    return prints.join(names, "print").select("doc_id", hexadecimal.alias("fingerprint"), "component_id")
