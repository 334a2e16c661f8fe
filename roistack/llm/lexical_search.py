"""Ranked lexical search: range-maximum sparse tables per posting list, best-first over document intervals.

Documents are indexed in blocks, each an inverted index of its own for the terms
that any item asks for: documents in order of id, and for each term the documents
that hold it.  A term's saturated frequency in a document is its impact; a sparse
table over a posting list gives the document of largest impact in any interval.

For an item, a block's documents are one interval at first.  The sum of its terms'
largest impacts bounds every score in it.  The intervals of largest bounds are
taken first: an interval is split at the document of its largest weighted impact,
which is scored, and small intervals are scored whole.  What can't reach the
block's tenth score is left.  The blocks' best documents are ranked together.

Documents are read once, whatever the number of items.  Items meet the index in
slices of bounded size.  Broadcast: a bitmap of ``1 << BITMAP_BITS`` bits that lets
the items' terms through (others that pass are in no item and only cost space),
and a slice of items with their weights.  Shuffled: at most ``k`` rows for each
item and block.  To the driver: counts and slices.

Defined results: null and empty texts have no terms and are no results; an item
without known terms has none; rows that share a ``doc_id`` are each ranked; a
null ``doc_id`` comes after all others of its score; rows that share an
``item_id`` are ranked each on its own, equal rows once; an empty table gives no
rows; other columns are not looked at.  Terms are told apart by 64-bit hashes.
"""

from __future__ import annotations

import functools
import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import ALNUM, chunks, fold_case, materialize, text_bytes, word_hashes, words

#: Bits of the bitmap of terms, as a power of two.
BITMAP_BITS = 22
#: Documents and postings of a block, after which a new one begins.
BLOCK_DOCS, BLOCK_POSTINGS = 8192, 1 << 20
#: Pairs of items and terms that meet the index together.
SLICE_TERMS = 500_000
#: Documents of an interval that is scored whole, and intervals that are taken together.
LEAF, TAKE = 128, 32

INDEX = "ids binary, known binary, sizes binary, terms binary, first binary, docs binary, tf binary, n_docs long, n_terms long"


def _terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all terms, and each row's first one."""
    data = fold_case(data)
    starts, ends, first = words(data, offsets, ALNUM)
    return word_hashes(data, starts, ends), first


def _item_terms(items: DataFrame) -> DataFrame:
    """term (a hash) and times for each item row, which ``item`` tells apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, first = _terms(*text_bytes(batch.column(1)))
            for i, item in enumerate(batch.column(0).to_pylist()):
                term, times = np.unique(h[first[i] : first[i + 1]], return_counts=True)
                yield pa.RecordBatch.from_pydict({"item": np.full(len(term), item, np.int64), "term": term.view(np.int64), "times": times.astype(np.int64)})

    return items.select("item", "text").mapInArrow(run, "item long, term long, times long")


def _bit(term: np.ndarray) -> np.ndarray:
    return (term.view(np.uint64) >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)


def build_index(documents: DataFrame, wanted: np.ndarray) -> DataFrame:
    """A row for each block: its documents' ids and sizes in terms, and posting lists of terms whose bit in ``wanted`` is set."""

    def block(ids: list[np.ndarray], known: list[np.ndarray], sizes: list[np.ndarray], term: list[np.ndarray], doc: list[np.ndarray]) -> pa.RecordBatch:
        ids, known, sizes, term, doc = (np.concatenate(x) for x in (ids, known, sizes, term, doc))
        order = np.lexsort((ids, ~known))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        doc = place[doc]
        order_p = np.lexsort((doc, term))
        term, doc = term[order_p], doc[order_p]
        new = np.ones(len(term), bool)
        new[1:] = (term[1:] != term[:-1]) | (doc[1:] != doc[:-1])
        at = np.flatnonzero(new)
        tf, term, doc = np.diff(np.append(at, len(new))), term[at], doc[at]
        names, first = np.unique(term, return_index=True)
        columns = (ids[order], known[order], sizes[order], names, np.append(first, len(term)), doc.astype(np.int32), tf)
        row = {k: [x.tobytes()] for k, x in zip(("ids", "known", "sizes", "terms", "first", "docs", "tf"), columns, strict=True)}
        return pa.RecordBatch.from_pydict(row | {"n_docs": [int((sizes > 0).sum())], "n_terms": [int(sizes.sum())]})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[list[np.ndarray]] = [[] for _ in range(5)]
        docs = postings = 0
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            known = ~batch.column(0).is_null().to_numpy(zero_copy_only=False)
            ids = batch.column(0).fill_null(0).to_numpy()
            for i, j in chunks(offsets):
                h, first = _terms(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                row = np.repeat(np.arange(j - i), np.diff(first))
                own = wanted[_bit(h)]
                for part, x in zip(parts, (ids[i:j], known[i:j], np.diff(first), h[own], row[own] + docs), strict=True):
                    part.append(x)
                docs, postings = docs + j - i, postings + int(own.sum())
                if docs >= BLOCK_DOCS or postings >= BLOCK_POSTINGS:
                    yield block(*parts)
                    parts, docs, postings = [[] for _ in range(5)], 0, 0
        if docs:
            yield block(*parts)

    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, INDEX)


def _document_counts(index: DataFrame) -> DataFrame:
    """term and df: the documents that hold it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for terms, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                yield pa.RecordBatch.from_pydict({"term": np.frombuffer(terms, np.int64), "df": np.diff(np.frombuffer(first, np.int64))})

    return index.select("terms", "first").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))


class Block:
    """Posting lists of a block with sparse tables of the places of their largest impacts."""

    def __init__(self, row: dict, n_docs: int, n_terms: int):
        self.ids, self.known = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["known"], bool)
        self.terms, self.first = np.frombuffer(row["terms"], np.uint64), np.frombuffer(row["first"], np.int64)
        self.docs = np.frombuffer(row["docs"], np.int32).astype(np.int64)
        tf, sizes = np.frombuffer(row["tf"], np.int64), np.frombuffer(row["sizes"], np.int64)
        m = 25 + (75 * sizes * n_docs) // max(n_terms, 1)
        self.impact = (1_000_000_000 * tf) // (1000 * tf + 8 * m[self.docs])
        self.key = np.repeat(np.arange(len(self.terms)), np.diff(self.first)) * len(self.ids) + self.docs
        # a list's intervals never reach beyond it, so one table over all lists serves each
        self.levels = [np.arange(len(tf), dtype=np.int32)]
        longest = int(np.diff(self.first).max(initial=0))
        while 2 << (len(self.levels) - 1) <= longest:
            half, last = 1 << (len(self.levels) - 1), self.levels[-1]
            ahead = np.concatenate([last[half:], last[-half:]])
            self.levels.append(np.where(self.impact[ahead] > self.impact[last], ahead, last))
        self.table = np.stack(self.levels)

    def largest(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place of the largest impact between places ``lo`` and ``hi`` of a list, and the impact, 0 where there is none."""
        some = hi > lo
        level = np.where(some, np.frexp(np.maximum(hi - lo, 1))[1] - 1, 0)
        end = len(self.docs) - 1
        a, b = self.table[level, np.minimum(lo, end)], self.table[level, np.clip(hi - (1 << level), 0, end)]
        at = np.where(self.impact[b] > self.impact[a], b, a)
        return at, np.where(some, self.impact[at], 0)

    def best(self, terms: np.ndarray, weights: np.ndarray, k: int) -> list[tuple[int, int]]:
        """Score and document of the ``k`` best, ties to the earlier one."""
        at = np.searchsorted(self.terms, terms)
        here = (at < len(self.terms)) & (weights > 0)
        here[here] = self.terms[at[here]] == terms[here]
        at, weights = at[here], weights[here]
        if not len(at):
            return []
        found: list[tuple[int, int]] = []  # a heap of score and minus the document, the worst first

        def offer(scores: np.ndarray, docs: np.ndarray) -> None:
            least = found[0] if len(found) == k else (0, 0)
            for s, d in zip(scores.tolist(), docs.tolist(), strict=True):
                if s >= max(least[0], 1):
                    if len(found) < k:
                        heapq.heappush(found, (s, -d))
                    elif (s, -d) > found[0]:
                        heapq.heapreplace(found, (s, -d))
                    least = found[0] if len(found) == k else (0, 0)

        def bounded(lo: np.ndarray, hi: np.ndarray, begin: np.ndarray, end: np.ndarray) -> None:
            place, impact = self.largest(begin, end)
            impact = impact * weights
            bound, split = impact.sum(axis=1), self.docs[place[np.arange(len(lo)), impact.argmax(axis=1)]]
            least = found[0][0] if len(found) == k else 1
            for i in np.flatnonzero(bound >= least).tolist():
                heapq.heappush(queue, (-int(bound[i]), int(lo[i]), int(hi[i]), int(split[i]), begin[i], end[i]))

        queue: list[tuple] = []
        bounded(np.array([0]), np.array([len(self.ids)]), self.first[at][None], self.first[at + 1][None])
        while queue:
            taken = []
            while queue and len(taken) < TAKE and (len(found) < k or -queue[0][0] >= found[0][0]):
                taken.append(heapq.heappop(queue))
            if not taken:
                break
            wide = []
            for t in taken:
                if t[2] - t[1] > LEAF:
                    wide.append(t)
                    continue
                counts = t[5] - t[4]
                places = np.repeat(t[4] - np.cumsum(counts) + counts, counts) + np.arange(int(counts.sum()))
                scores = np.zeros(t[2] - t[1], np.int64)
                np.add.at(scores, self.docs[places] - t[1], self.impact[places] * np.repeat(weights, counts))
                some = np.flatnonzero(scores >= (found[0][0] if len(found) == k else 1))
                offer(scores[some], some + t[1])
            if wide:
                lo, hi, split = (np.array([t[c] for t in wide]) for c in (1, 2, 3))
                begin, end = (np.stack([t[c] for t in wide]) for c in (4, 5))
                asked = at * len(self.ids) + split[:, None]
                place = np.searchsorted(self.key, asked)
                hit = (place < end) & (self.key[np.minimum(place, len(self.key) - 1)] == asked)
                offer((np.where(hit, self.impact[np.minimum(place, len(self.key) - 1)], 0) * weights).sum(axis=1), split)
                bounded(np.concatenate([lo, split + 1]), np.concatenate([split, hi]), np.concatenate([begin, place + hit]), np.concatenate([place, end]))
        return [(s, -d) for s, d in sorted(found, reverse=True)]


def _search(terms: np.ndarray, weights: np.ndarray, items: np.ndarray, first: np.ndarray, n_docs: int, n_terms: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                block = Block({c: batch.column(c)[r].as_py() for c in ("ids", "known", "sizes", "terms", "first", "docs", "tf")}, n_docs, n_terms)
                out: list[tuple[int, int, int]] = []
                for i, item in enumerate(items.tolist()):
                    own = slice(first[i], first[i + 1])
                    out += [(item, d, s) for s, d in block.best(terms[own], weights[own], k)]
                doc = np.array([d for _, d, _ in out], np.int64)
                yield pa.RecordBatch.from_pydict({"item": pa.array([x for x, _, _ in out], pa.int64()), "doc_id": pa.array(block.ids[doc], mask=~block.known[doc]), "score": pa.array([s for _, _, s in out], pa.int64())})

    return run


def rank_documents(documents: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """item_id, rank (from 1), doc_id and score of the ``k`` best documents of each item."""
    rows = items.select("item_id", F.col("text").cast("string").alias("text")).distinct().withColumn("item", F.monotonically_increasing_id())
    rows = materialize(rows, "items")
    asked = materialize(_item_terms(rows), "item-terms")
    top = F.shiftrightunsigned("term", 64 - BITMAP_BITS).cast("int")
    wanted = np.zeros(1 << BITMAP_BITS, bool)
    wanted[asked.select(top.alias("bit")).distinct().toArrow().column("bit").to_numpy()] = True
    index = materialize(build_index(documents, wanted), "posting-blocks")
    n_docs, n_terms = index.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    counted = materialize(asked.join(_document_counts(index), "term"), "weighed-terms")
    slices = max(1, math.ceil(counted.count() / SLICE_TERMS))
    found = []
    for s in range(slices):
        part = counted.where(F.pmod(F.xxhash64("item"), F.lit(slices)) == s).orderBy("item", "term").toArrow()
        item, term, times, df = (part.column(c).to_numpy() for c in ("item", "term", "times", "df"))
        weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64) * times
        own, first = np.unique(item, return_index=True)
        found.append(index.mapInArrow(_search(term.view(np.uint64), weight, own, np.append(first, len(item)), n_docs, n_terms, k), "item long, doc_id long, score long"))
    best = functools.reduce(DataFrame.union, [materialize(f, "found") for f in found])
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(rows.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
