"""Byte-level BPE in DuckDB: recursive contraction of pairs, ordered aggregation to decode.

Spark deals the documents out; within each task an in-memory DuckDB holds the
merge table and works on the task's own pieces.  A word starts as its bytes'
ids; its positions join the merge table, the leftmost pair of least rank is
contracted, and the recursion ends when no word has a pair left.  Decoding
joins (document, position, id) rows with the vocabulary and concatenates in
order of position.

Words of more than ``longest`` bytes would take a round of recursion for every
merge, each over the whole word; they are contracted by the same rule with a heap, in O(n log n).
Both forms cost the same at about 64 bytes, so any value gives the same ids.

One pass without a shuffle.  A null or empty text has no ids; repeated rows
give repeated rows; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from contextlib import AbstractContextManager

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_table, chunks, kept, text_bytes
from .piecewise import PieceEncoder, binary_rows, row_bytes

CONTRACT = """
WITH RECURSIVE state(word, ids, step) AS (
    SELECT word, list(id ORDER BY pos), 0 FROM bytes_of_words GROUP BY word
    UNION ALL
    SELECT s.word, s.ids[: best % 2147483648 - 1] || [(best // 2147483648)::INT] || s.ids[best % 2147483648 + 2 :], s.step + 1
    FROM state s JOIN (
        SELECT word, min(merged::BIGINT * 2147483648 + pos) AS best
        FROM (SELECT word, unnest(range(1, len(ids))) AS pos, unnest(ids[: -2]) AS first_id, unnest(ids[2 :]) AS second_id FROM state) p
        JOIN merges m ON m.pair = p.first_id * 2147483648::BIGINT + p.second_id
        GROUP BY word
    ) b ON b.word = s.word
)
SELECT word, ids FROM state QUALIFY row_number() OVER (PARTITION BY word ORDER BY step DESC) = 1 ORDER BY word
"""

DECODE = """
SELECT doc, string_agg(piece, '' ORDER BY pos) AS text
FROM token_rows JOIN vocabulary USING (id) GROUP BY doc ORDER BY doc
"""

#: Characters that white space beyond ASCII ends in, by the byte before: no cut follows them.
_SPACE_LEADS = np.zeros(256, bool)
_SPACE_LEADS[[0xE1, 0xE2, 0xE3]] = True
_SPACE = byte_table((0x20, 0x20), (0x09, 0x0D))
_SOLID = byte_table((0x21, 0x7E), (0x80, 0xFF))
_LETTER = byte_table((0x41, 0x5A), (0x61, 0x7A))
_MARK = byte_table((0x21, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E))


class BytePairEncoder(PieceEncoder):
    """``ranks``: the public rank file; ``pattern``: splits a text before the merges."""

    def __init__(self, ranks: str, pattern: str, keep: int = 600_000, longest: int = 64, memory: str = "160MB"):
        super().__init__(keep)
        with open(ranks, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        self.pattern = regex.compile(pattern)
        self.longest = longest
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = [(x, y, r) for w, r in self.ranks.items() for k in range(1, len(w)) if (x := self.ranks.get(w[:k])) is not None and (y := self.ranks.get(w[k:])) is not None]
        self.merges = {(x, y): r for x, y, r in pairs}
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": memory})
        merges = pa.table({"pair": pa.array([x * 2147483648 + y for x, y, _ in pairs], pa.int64()), "merged": pa.array([r for *_, r in pairs], pa.int32())})
        vocabulary = pa.table({"id": pa.array(self.ranks.values(), pa.int32()), "piece": pa.array([w.hex() for w in self.ranks])})
        for name, table in (("merges", merges), ("vocabulary", vocabulary)):
            self.db.register("incoming", table)
            self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM incoming")
            self.db.unregister("incoming")

    def cut(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cuts before ASCII white space that follows a character that is no white space, and where an ASCII letter meets a mark.

        The pattern never joins what is cut, and looks no further than the white space it matches.
        """
        n = len(data)
        if not n:
            return data, np.zeros(0, np.int64), np.zeros(0, np.int64)
        space = _SPACE[data]
        cuts = np.flatnonzero((_SOLID[data[:-1]] & space[1:]) | (_LETTER[data[:-1]] & _MARK[data[1:]])) + 1
        odd = cuts[data[cuts - 1] >= 0x80]
        last, two, three = data[odd - 1], data[np.maximum(odd - 2, 0)], data[np.maximum(odd - 3, 0)]
        white = (two == 0xC2) & ((last == 0x85) | (last == 0xA0))
        white |= _SPACE_LEADS[three] & ((two == 0x80) | (two == 0x81) | (two == 0x9A))
        cuts = np.setdiff1d(cuts, odd[white], assume_unique=True)
        bounds = np.unique(np.concatenate([cuts, offsets]))
        return data, bounds[:-1], bounds[1:]

    def encode_pieces(self, pieces: list[str]) -> list[list[int]]:
        split = [self.pattern.findall(p) for p in pieces]
        words = list(dict.fromkeys(w for s in split for w in s))
        ids = dict(zip(words, self._encode_words([w.encode() for w in words]), strict=True))
        return [[i for w in s for i in ids[w]] for s in split]

    def _encode_words(self, words: list[bytes]) -> list[list[int]]:
        out = [[self.ranks[w]] if w in self.ranks else [] for w in words]
        short = [k for k, w in enumerate(words) if not out[k] and len(w) <= self.longest]
        if short:
            sizes = np.array([len(words[k]) for k in short])
            data = np.frombuffer(b"".join(words[k] for k in short), np.uint8)
            rows = pa.table({
                "word": pa.array(np.repeat(np.arange(len(short), dtype=np.int32), sizes)),
                "pos": pa.array((np.arange(len(data)) - np.repeat(np.cumsum(sizes) - sizes, sizes)).astype(np.int32)),
                "id": pa.array(self.byte_ids[data]),
            })
            self.db.register("bytes_of_words", rows)
            for k, (_, ids) in zip(short, self.db.execute(CONTRACT).fetchall(), strict=True):
                out[k] = ids
            self.db.unregister("bytes_of_words")
        for k, w in enumerate(words):
            if not out[k] and len(w) > self.longest:
                out[k] = self._contract_long(w)
        return out

    def _contract_long(self, word: bytes) -> list[int]:
        """The same contraction with a heap of (rank, place) and links between places."""
        ids = self.byte_ids[np.frombuffer(word, np.uint8)].tolist()
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        heap = [(r, k, ids[k], ids[k + 1]) for k in range(len(ids) - 1) if (r := self.merges.get((ids[k], ids[k + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            rank, k, x, y = heapq.heappop(heap)
            nxt = after[k]
            if ids[k] != x or nxt >= len(ids) or ids[nxt] != y:
                continue
            ids[k], ids[nxt] = rank, -1
            after[k] = after[nxt]
            if after[k] < len(ids):
                before[after[k]] = k
            for left in (before[k], k):
                if left >= 0 and after[left] < len(ids) and (r := self.merges.get((ids[left], ids[after[left]]))) is not None:
                    heapq.heappush(heap, (r, left, ids[left], ids[after[left]]))
        return [i for i in ids if i >= 0]

    def decode(self, ids: np.ndarray, sizes: np.ndarray) -> list[bytes]:
        """The bytes of consecutive documents of ``sizes`` ids each."""
        if len(ids) > 1 << 19 and len(sizes) > 1:
            half = max(1, min(len(sizes) - 1, int(np.searchsorted(np.cumsum(sizes), len(ids) // 2))))
            at = int(sizes[:half].sum())
            return self.decode(ids[:at], sizes[:half]) + self.decode(ids[at:], sizes[half:])
        first = np.cumsum(sizes) - sizes
        rows = pa.table({
            "doc": pa.array(np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)),
            "pos": pa.array((np.arange(len(ids)) - np.repeat(first, sizes)).astype(np.int32)),
            "id": pa.array(ids.astype(np.int32)),
        })
        self.db.register("token_rows", rows)
        out = [b""] * len(sizes)
        for doc, text in self.db.execute(DECODE).fetchall():
            out[doc] = bytes.fromhex(text)
        self.db.unregister("token_rows")
        return out


def encoder(ranks: str, pattern: str) -> AbstractContextManager[BytePairEncoder]:
    """One for each Python worker, kept from task to task until other work begins there."""
    return kept(("byte_bpe", ranks, pattern), lambda: BytePairEncoder(ranks, pattern))


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _encoded(batch: pa.RecordBatch, enc: BytePairEncoder) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """Pieces of about 1 MB of text: the rows' doc_id, all their ids and the number of each row's."""
    data, offsets = text_bytes(batch.column(1))
    for i, j in chunks(offsets):
        yield batch.column(0).slice(i, j - i), *enc.encode(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])


def encode_texts(documents: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens and ids (little-endian unsigned 32 bits) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with encoder(ranks, pattern) as enc:
            for batch in batches:
                for doc_id, ids, sizes in _encoded(batch, enc):
                    yield pa.RecordBatch.from_pydict({"doc_id": doc_id, "n_tokens": sizes, "ids": binary_rows(ids.astype("<u4").view(np.uint8), 4 * sizes)})

    return _texts(documents).mapInArrow(run, "doc_id long, n_tokens long, ids binary")


def decode_ids(encoded: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids, and ``decoded``, the bytes that the ids stand for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with encoder(ranks, pattern) as enc:
            for batch in batches:
                data, offsets = row_bytes(batch.column(2))
                for i, j in chunks(offsets):
                    decoded = enc.decode(data[offsets[i] : offsets[j]].view("<u4"), batch.column(1).slice(i, j - i).to_numpy())
                    yield pa.RecordBatch.from_pydict({n: batch.column(k).slice(i, j - i) for k, n in enumerate(("doc_id", "n_tokens", "ids"))} | {"decoded": pa.array(decoded, pa.binary())})

    return encoded.select("doc_id", "n_tokens", "ids").mapInArrow(run, "doc_id long, n_tokens long, ids binary, decoded binary")


def round_trip(documents: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """Encode every text and decode the ids again, both in the same task's DuckDB."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with encoder(ranks, pattern) as enc:
            for batch in batches:
                for doc_id, ids, sizes in _encoded(batch, enc):
                    decoded = pa.array(enc.decode(ids, sizes), pa.binary())
                    yield pa.RecordBatch.from_pydict({"doc_id": doc_id, "n_tokens": sizes, "ids": binary_rows(ids.astype("<u4").view(np.uint8), 4 * sizes), "decoded": decoded})

    return _texts(documents).mapInArrow(run, "doc_id long, n_tokens long, ids binary, decoded binary")


def digests(encoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens and the SHA-256 of ids and of decoded bytes."""
    return encoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


