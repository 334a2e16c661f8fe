"""N-gram Jaccard join: a size-aware heavy-light set similarity join, down to components.

A text's set holds its distinct word n-grams.  Equal sets become one node
first.  A set of n elements needs an overlap of at least o = ceil(t n) with any
partner, so with all sets in one global order (rare elements first) partners
share c elements of their first n - o + c.  Light sets (at most ``boundary``
elements) enumerate the c-subsets of those; heavy sets list single elements
(c = 1), as do light sets close enough in size to link with a heavy one.  The
boundary is where enumerating subsets begins to cost more, by the corpus' mean
multiplicity of elements, than listing elements and verifying what they bring.

Sets that share a key are candidates, if the elements after a shared one leave
room for the overlap they need.  Rather than all pairs of a key's list,
its most typical set is verified against the others, components are taken, and
only lists that still hold several components give the pairs between those.
Every pair of candidates is so either verified or already in one component: no
link is lost, and a large group of near copies costs its size, not its square.

Bitmaps of the sets rule out most candidates before whole sets are compared.
Shuffled: the keys, some tenth of all elements at t = 0.9; then bitmaps of
candidates, and the sets of those that remain.  To the driver: counts, and the at most ``frequent`` most frequent
elements, which the global order puts last (any order is right).

Defined results: a null or empty text has no elements and its own component; a
text of fewer than n words has its whole sequence as one element; rows that
share a ``doc_id`` are each compared; a null ``doc_id`` is never a component's
name unless all are null; an empty table gives no rows.  Elements and sets are
told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import NON_SPACE, chunks, fold_case, materialize, mix, shingle_hashes, text_bytes, word_hashes, words
from .graph import connected_components
from .piecewise import binary_rows, row_bytes

#: Least buckets of a set's bitmap; it has twice to four times as many as the set has elements, a power of two.
BITS = 64
#: Rows of ids or pairs of ids that may be broadcast; beyond that both sides are shuffled.
BROADCAST_ROWS = 1_000_000


def _sets(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all rows, ascending within each, and each row's first one."""
    data = fold_case(data)
    starts, ends, first = words(data, offsets, NON_SPACE)
    h, row_first = shingle_hashes(word_hashes(data, starts, ends), first, n)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(row_first))
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    return h[new], np.searchsorted(row[new], np.arange(len(offsets)))


def _signatures(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A hash of each row's set: mixed sums of mixed elements, and the size."""
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(h + np.uint64(0x9E3779B97F4A7C15)), dtype=np.uint64)])
    return mix(sums[first[1:]] - sums[first[:-1]] + np.diff(first).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)).view(np.int64)


def _bitmaps(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which buckets each row's elements fall into, packed, and the bytes of each row; empty buckets bound what two sets share."""
    n = np.diff(first)
    size = np.maximum(BITS, 1 << np.ceil(np.log2(np.maximum(2 * n, 1))).astype(np.int64))
    begin = np.cumsum(size) - size
    bits = np.zeros(int(size.sum()), np.uint8)
    bits[np.repeat(begin, n) + (mix(h) & (np.repeat(size, n) - 1).astype(np.uint64)).astype(np.int64)] = 1
    return np.packbits(bits), size // 8


def _most_shared(x: np.ndarray, n: int, y: np.ndarray, m: int) -> int:
    """The most elements that sets of ``n`` and ``m`` elements with these bitmaps can share."""
    while len(x) != len(y):
        if len(x) > len(y):
            x = x[: len(x) // 2] | x[len(x) // 2 :]
        else:
            y = y[: len(y) // 2] | y[len(y) // 2 :]
    x, y = x.view(np.uint64), y.view(np.uint64)
    return min(n - int(np.bitwise_count(x & ~y).sum()), m - int(np.bitwise_count(y & ~x).sum()))


def _scan(texts: DataFrame, n: int, local: int) -> DataFrame:
    """Rows of kind 0: doc_id, size, signature and bitmap of each text. Kind 1: element, occurrences in a piece of at least ``local``. Kind 2: elements, distinct elements."""

    def rows(kind: int, a, b, c, bits=None) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"kind": np.full(len(b), kind, np.int32), "a": a, "b": pa.array(b, pa.int64()), "c": pa.array(c, pa.int64()), "bits": pa.nulls(len(b), pa.binary()) if bits is None else bits})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            seen: list[np.ndarray] = []
            for i, j in chunks(offsets, 4 << 20):
                h, first = _sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], n)
                yield rows(0, batch.column(0).slice(i, j - i), np.diff(first), _signatures(h, first), binary_rows(*_bitmaps(h, first)))
                seen.append(h)
                if j == len(offsets) - 1 or sum(map(len, seen)) > 1 << 22:
                    heads, counts = np.unique(np.concatenate(seen), return_counts=True)
                    often = counts >= local
                    yield rows(1, pa.array(heads[often].view(np.int64)), counts[often], np.zeros(int(often.sum()), np.int64))
                    yield rows(2, pa.array([0], pa.int64()), [int(counts.sum())], [len(heads)])
                    seen = []

    return texts.mapInArrow(run, "kind int, a long, b long, c long, bits binary")


class Scheme:
    """Prefixes, subsets and the boundary, for a threshold of ``num`` / ``den``."""

    def __init__(self, num: int, den: int, c: int, multiplicity: float, verify: float = 8.0):
        self.num, self.den, self.c = num, den, c
        light = lambda n: comb(self.prefix(n, c), c)
        heavy = lambda n: self.prefix(n, 1) * (1 + verify * (multiplicity - 1))
        self.least = next(n for n in range(1, 10_000) if self.need(n) >= c)
        self.boundary = self.least - 1
        while self.boundary < 100_000 and light(self.boundary + 1) <= max(heavy(self.boundary + 1), 1):
            self.boundary += 1

    def need(self, n: int) -> int:
        return -(-self.num * n // self.den)

    def prefix(self, n: int, c: int) -> int:
        return min(n, n - self.need(n) + c)

    def is_light(self, n: int) -> bool:
        return self.least <= n <= self.boundary

    def lists_elements(self, n: int) -> bool:
        """Whether a set of ``n`` may link with one that isn't light."""
        return not self.is_light(n) or n * self.den >= self.num * (self.boundary + 1) or n * self.num <= self.den * (self.least - 1)


def _keys(texts: DataFrame, n: int, scheme: Scheme, frequent: np.ndarray, ranks: np.ndarray) -> DataFrame:
    """key, node, size, light, typical and place: what each distinct set of a piece of texts is listed under.

    ``place`` is that of an element in the set's order, 0 for a subset.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            data, offsets = text_bytes(batch.column(0))
            for i, j in chunks(offsets):
                h, first = _sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], n)
                nodes = _signatures(h, first)
                at = np.minimum(np.searchsorted(frequent, h), max(len(frequent) - 1, 0))
                late = np.where(frequent[at] == h, ranks[at], 0) if len(frequent) else np.zeros(len(h), np.int64)
                out: list[tuple[np.ndarray, int, int, bool, int, bool]] = []
                for k, node in enumerate(nodes.tolist()):
                    lo, hi = int(first[k]), int(first[k + 1])
                    size = hi - lo
                    if not size or node in seen:
                        continue
                    seen.add(node)
                    light = scheme.is_light(size)
                    # a set without rare elements is typical of its group
                    order = lo + np.lexsort((h[lo:hi], late[lo:hi]))[: scheme.prefix(size, scheme.c)]
                    typical = int((late[lo:hi] > 0).sum()) * 1000 // size
                    parts = []
                    if light:
                        pairs = np.array(list(combinations(order.tolist(), scheme.c)))
                        key = np.full(len(pairs), scheme.c, np.uint64)
                        for column in np.sort(h[pairs], axis=1).T:
                            key = mix(key * np.uint64(0x100000001B3) + column)
                        parts.append((key, False))
                    if scheme.lists_elements(size):
                        parts.append((h[order[: scheme.prefix(size, 1)]], True))
                    out += [(part, node, size, light, typical, single) for part, single in parts]
                if out:
                    many = [len(o[0]) for o in out]
                    column = lambda c, kind: np.repeat(np.array([o[c] for o in out], kind), many)  # noqa: B023, E731
                    yield pa.RecordBatch.from_pydict({"key": np.concatenate([o[0] for o in out]).view(np.int64), "node": column(1, np.int64), "size": column(2, np.int64), "light": column(3, bool), "typical": column(4, np.int32), "place": np.concatenate([np.arange(len(o[0])) * o[5] for o in out])})

    return texts.select("text").mapInArrow(run, "key long, node long, size long, light boolean, typical int, place long")


def _if_small(table: DataFrame) -> DataFrame:
    """A written table of ids or pairs, marked for broadcast where its rows are few."""
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def _wanted_sets(texts: DataFrame, rows: DataFrame, nodes: DataFrame, n: int) -> DataFrame:
    """node and elements (sorted, 64 bits each) of the given nodes, from texts that have them; a node may come more than once."""
    ids = rows.where("a is not null").groupBy(F.col("c").alias("node")).agg(F.min("a").alias("doc_id")).join(nodes, "node", "left_semi").select("doc_id")
    ids = _if_small(materialize(ids.distinct(), "wanted"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            data, offsets = text_bytes(batch.column(0))
            for i, j in chunks(offsets):
                h, first = _sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], n)
                own = _signatures(h, first)
                fresh = np.zeros(len(own), bool)
                for k, node in enumerate(own.tolist()):
                    fresh[k] = node not in seen
                    seen.add(node)
                sizes = np.diff(first)
                kept = h[np.repeat(fresh, sizes)]
                yield pa.RecordBatch.from_pydict({"node": own[fresh], "elements": binary_rows(kept.view(np.uint8), sizes[fresh] * 8)})

    # a set that only rows without an id have is looked for among those
    some = texts.join(ids, "doc_id", "left_semi").select("text").unionByName(texts.where("doc_id is null").select("text"))
    return some.mapInArrow(run, "node long, elements binary").join(nodes, "node", "left_semi")


def _plausible(pairs: DataFrame, rows: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs a, b whose bitmaps allow the similarity: an element in a bucket that the other set leaves empty isn't shared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = (batch.column(k).to_pylist() for k in (2, 4))
            (x, fx), (y, fy) = (row_bytes(batch.column(k)) for k in (3, 5))
            fine = np.zeros(batch.num_rows, bool)
            for k in range(batch.num_rows):
                both = _most_shared(x[fx[k] : fx[k + 1]], n[k], y[fy[k] : fy[k + 1]], m[k])
                fine[k] = den * both >= num * (n[k] + m[k] - both)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(fine)), batch.column(1).filter(pa.array(fine))], names=["a", "b"])

    pairs = materialize(pairs, "candidates")
    wanted = _if_small(materialize(pairs.select(F.explode(F.array("a", "b")).alias("c")).distinct(), "bitmaps-wanted"))
    sets = rows.where("b > 0").join(wanted, "c", "left_semi").groupBy("c").agg(F.first("b").alias("n"), F.first("bits").alias("bits"))
    one, two = (sets.select(F.col("c").alias(s), F.col("n").alias(f"n_{s}"), F.col("bits").alias(f"bits_{s}")) for s in "ab")
    both = one.join(_if_small(pairs), "a").join(two, "b")
    return materialize(both.select("a", "b", "n_a", "bits_a", "n_b", "bits_b").mapInArrow(run, "a long, b long"), "plausible")


def _links(pairs: DataFrame, texts: DataFrame, rows: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """The pairs a, b of nodes whose sets' similarity reaches the threshold.

    ``a`` is the side whose sets go to where the other side's are, so it should be the one that has few partners.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = [row_bytes(batch.column(k)) for k in (2, 3)]
            (x, fx), (y, fy) = [(d.view(np.uint64), o // 8) for d, o in sides]
            fine = np.zeros(batch.num_rows, bool)
            for k in range(batch.num_rows):
                own, other = x[fx[k] : fx[k + 1]], y[fy[k] : fy[k + 1]]
                at = np.minimum(np.searchsorted(other, own), len(other) - 1)
                both = int((other[at] == own).sum())
                fine[k] = den * both >= num * (len(own) + len(other) - both)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(fine)), batch.column(1).filter(pa.array(fine))], names=["a", "b"])

    pairs = _plausible(pairs, rows, num, den)
    few = _if_small(pairs)
    one, two = (_wanted_sets(texts, rows, _if_small(materialize(pairs.select(F.col(s).alias("node")).distinct(), "nodes")), n) for s in "ab")
    sent = one.select(F.col("node").alias("a"), F.col("elements").alias("x")).join(few, "a")
    both = sent.join(two.select(F.col("node").alias("b"), F.col("elements").alias("y")), "b")
    return materialize(both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long"), "links").distinct()


def jaccard_components(documents: DataFrame, n: int = 3, num: int = 90, den: int = 100, c: int = 2, frequent: int = 200_000, local: int = 4) -> DataFrame:
    """doc_id, n_shingles and component_id of each row; texts link where intersection / union >= ``num`` / ``den``.

    ``n``: words of an element.  ``c``: elements of a light set's subsets.  ``frequent``: elements with a place of their
    own in the global order, after all others.  ``local``: occurrences within a piece of texts from which elements are counted.
    """
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scanned = materialize(_scan(texts, n, local), "shingle-sets")
    rows = scanned.where("kind = 0").select("a", "b", "c", "bits")
    top = scanned.where("kind = 1").groupBy("a").agg(F.sum("b").alias("n")).orderBy(F.desc("n"), "a").limit(frequent).toArrow()
    total, distinct = scanned.where("kind = 2").agg(F.coalesce(F.sum("b"), F.lit(0)), F.coalesce(F.sum("c"), F.lit(0))).first()
    scheme = Scheme(num, den, c, total / distinct if distinct else 1.0)
    elements, counts = top.column("a").to_numpy().view(np.uint64), top.column("n").to_numpy()
    order = np.argsort(elements)

    own = Window.partitionBy("key")
    keys = _keys(texts, n, scheme, elements[order], counts[order].astype(np.int64)).repartition("key").dropDuplicates(["key", "node"])
    leader = F.max(F.struct(~F.col("light"), "typical", "size", "node", "place")).over(own)
    lists = keys.withColumns({"in_list": F.count("*").over(own), "leader": leader}).where("in_list > 1")
    lists = materialize(lists.select("key", "node", "size", "place", F.col("leader.node").alias("leader"), F.col("leader.size").alias("leader_size"), F.col("leader.place").alias("leader_place")), "lists")

    def near(n: str, m: str, i: str, j: str) -> Column:
        """Sizes that may link, if the key is the first that the sets share: what follows it bounds their overlap."""
        n, m, i, j = map(F.col, (n, m, i, j))
        return (F.least(n, m) * den >= F.greatest(n, m) * num) & (F.least(n - i, m - j) * (num + den) >= (n + m) * num)

    # A key of single elements pairs what isn't light; two light sets meet under keys of subsets, which hold light sets only.
    star = lists.where((F.col("node") != F.col("leader")) & near("size", "leader_size", "place", "leader_place"))
    star = materialize(star.select(F.col("node").alias("a"), F.col("leader").alias("b")).distinct(), "pairs")
    links = _links(star, texts, rows, n, num, den)
    found = materialize(connected_components(links), "components")

    placed = lists.select("key", "node", "size", "place").join(_if_small(found), "node", "left").withColumn("component", F.coalesce("component", "node"))
    several = placed.withColumns({"lo": F.min("component").over(own), "hi": F.max("component").over(own)}).where("lo < hi").select("key", "node", "size", "place", "component")
    several = materialize(several, "several")
    left, right = (several.select("key", *[F.col(x).alias(f"{x}_{s}") for x in ("node", "size", "place", "component")]) for s in "ab")
    rest = left.join(right, "key").where((F.col("node_a") > F.col("node_b")) & (F.col("component_a") != F.col("component_b")) & near("size_a", "size_b", "place_a", "place_b"))
    met = star.union(star.select("b", "a"))
    rest = rest.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct().join(met, ["a", "b"], "left_anti")
    more = _links(rest, texts, rows, n, num, den)
    found = connected_components(links.union(more))

    named = rows.where("b > 0").groupBy(F.col("c").alias("node")).agg(F.min("a").alias("least")).join(found, "node", "left")
    named = named.withColumn("component", F.coalesce("component", "node"))
    names = named.join(named.groupBy("component").agg(F.min("least").alias("component_id")), "component").select(F.col("node").alias("c"), "component_id")
    result = rows.join(names, "c", "left")
    return result.select(F.col("a").alias("doc_id"), F.col("b").alias("n_shingles"), F.when(F.col("b") > 0, F.col("component_id")).otherwise(F.col("a")).alias("component_id"))
