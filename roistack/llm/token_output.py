"""Token ids in binary files: canonical length-limited Huffman codes of global counts.

Texts are encoded by a public tokenizer (each distinct word once per cache),
counted over the whole corpus, and written in ascending ``doc_id`` order.

File format: a folder with two tables.  ``code`` has a row per id with its code
length; canonical codes follow from the lengths.  ``blocks`` has a row per
document, in ascending order within and across files: ``doc_id``, ``part``,
``local_start``, ``n_tokens`` and ``payload``: magic ``HUF1``, the number of
ids, then a bit offset for every 128th id (each unsigned 32 bits, little
endian), then the bit stream, most significant bit first.  Blocks decode
independently, and so does every checkpoint within one.

Work is narrow but for one shuffle of coded blocks; the driver sees one count
per id and one total per file.  A null or empty text has only the end id; equal
``doc_id`` follow each other in the order of their coded bytes; a null
``doc_id`` comes first; an empty table writes no block and reads back empty.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from contextlib import AbstractContextManager

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import NON_SPACE, byte_table, chunks, fold_case, kept, materialize, scratch_path, text_bytes, words
from .piecewise import PieceEncoder, binary_rows, row_bytes

MAGIC = b"HUF1"
#: Ids between two checkpoints.
EVERY = 128
#: The longest code, in bits.
LONGEST = 18

_LETTER = byte_table((0x61, 0x7A))
_MARK = byte_table((0x21, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E))


class WordEncoder(PieceEncoder):
    """Words between ASCII white space, cut again where an ASCII letter meets a mark, in lower case.

    The tokenizer splits at all these places before its merges, and lower-cases, so the ids are those of the whole text.
    It finds special tokens before it lower-cases; such a place is a piece of its own, written in capitals, which no other piece holds.
    """

    def __init__(self, path: str, keep: int = 300_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        super().__init__(keep)
        self.tokenizer = Tokenizer.from_file(path)
        # from here on: what is left of a text once its special tokens are cut out, even if lower case makes it look like one
        self.tokenizer.encode_special_tokens = True
        special = sorted((t.content, i) for i, t in self.tokenizer.get_added_tokens_decoder().items())
        self.special = [(c.encode(), chr(65 + k), i) for k, (c, i) in enumerate(special)]

    def _mark_special(self, raw: np.ndarray, folded: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Write special tokens of ``raw`` as capitals into ``folded``; where they begin and end."""
        bounds = []
        for content, letter, _ in self.special:
            at = np.flatnonzero(raw[: max(len(raw) - len(content) + 1, 0)] == content[0])
            for k in range(1, len(content)):
                at = at[raw[at + k] == content[k]]
            at = at[np.searchsorted(offsets, at, "right") == np.searchsorted(offsets, at + len(content) - 1, "right")]
            for k in range(len(content)):
                folded[at + k] = ord(letter)
            bounds += [at, at + len(content)]
        return np.concatenate(bounds) if bounds else np.zeros(0, np.int64)

    def cut(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        raw, data = data, fold_case(data)
        special = self._mark_special(raw, data, offsets)
        starts, ends, _ = words(data, offsets, NON_SPACE)
        inner = np.flatnonzero(_LETTER[data[:-1]] & _MARK[data[1:]]) + 1
        special = special[(special > 0) & (special < len(data))]
        special = special[NON_SPACE[data[special - 1]] & NON_SPACE[data[special]]]
        inner = np.union1d(inner, special)
        inner = inner[~np.isin(inner, offsets)]
        return data, np.sort(np.concatenate([starts, inner])), np.sort(np.concatenate([ends, inner]))

    def encode_pieces(self, pieces: list[str]) -> list[list[int]]:
        marked = {letter * len(content): [i] for content, letter, i in self.special}
        return [marked[w] if w in marked else ids for w, ids in zip(pieces, self._encode_plain(["" if w in marked else w for w in pieces]), strict=True)]

    def _encode_plain(self, pieces: list[str]) -> list[list[int]]:
        # words of a to z alone are what normalising and splitting leave as they are: only the merges are to be done
        model = self.tokenizer.model
        plain = [w.isascii() and w.isalpha() for w in pieces]
        others = iter(self.tokenizer.encode_batch_fast([w for w, p in zip(pieces, plain, strict=True) if not p], add_special_tokens=False))
        return [[t.id for t in model.tokenize(w)] if p else next(others).ids for w, p in zip(pieces, plain, strict=True)]


def encoder(path: str) -> AbstractContextManager[WordEncoder]:
    """One for each Python worker, kept from task to task until other work begins there."""
    return kept(("token_output", path), lambda: WordEncoder(path))


# --- the code ------------------------------------------------------------------


def code_lengths(counts: np.ndarray, longest: int = LONGEST) -> np.ndarray:
    """Optimal code lengths of at most ``longest`` bits (package-merge); 0 for ids that don't occur."""
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.int64)
    if len(used) <= 1:
        out[used] = 1
        return out
    if len(used) > 1 << longest:
        raise ValueError(f"{len(used)} ids don't fit codes of {longest} bits")
    order = used[np.lexsort((used, counts[used]))]
    weights = counts[order].astype(np.int64)
    leaves, items = [], np.zeros(0, np.int64)
    for _ in range(longest):
        pairs = items[: len(items) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([weights, pairs])
        rank = np.argsort(both, kind="stable")
        items = both[rank]
        leaves.append(rank < len(weights))
    take = 2 * len(used) - 2
    for is_leaf in reversed(leaves):
        own = int(is_leaf[:take].sum())
        out[order[:own]] += 1
        take = 2 * (take - own)
    return out


class Code:
    """Canonical codes from lengths: codes ascend by length, then by id."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths.astype(np.int64)
        used = np.flatnonzero(lengths)
        self.order = used[np.lexsort((used, lengths[used]))]
        self.bits = int(lengths.max()) if len(used) else 1
        size = np.int64(1) << (self.bits - self.lengths[self.order])
        first = np.concatenate([[0], np.cumsum(size)])
        self.codes = np.zeros(len(lengths), np.uint64)
        self.codes[self.order] = (first[:-1] >> (self.bits - self.lengths[self.order])).astype(np.uint64)
        self.symbols = np.zeros(1 << self.bits, np.uint32)
        self.steps = np.ones(1 << self.bits, np.uint8)
        self.symbols[: first[-1]] = np.repeat(self.order, size)
        self.steps[: first[-1]] = np.repeat(self.lengths[self.order], size)

    def pack(self, ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Payloads of consecutive documents and the bytes of each."""
        length = self.lengths[ids]
        before = np.concatenate([[0], np.cumsum(length)])
        first = np.concatenate([[0], np.cumsum(sizes)])
        bits = before[first[1:]] - before[first[:-1]]
        stream = -(-bits // 8)
        points = -(-sizes // EVERY)
        head = 8 + 4 * points
        total = head + stream
        begin = np.concatenate([[0], np.cumsum(total)])
        row = np.repeat(np.arange(len(sizes)), sizes)
        local = before[:-1] - before[first[:-1]][row]
        place = local + 8 * (begin[:-1] + head)[row]
        code = self.codes[ids]
        word, room = place >> 6, 64 - (place & 63) - length
        high = np.where(room >= 0, code << np.maximum(room, 0).astype(np.uint64), code >> np.maximum(-room, 0).astype(np.uint64))
        out = np.zeros(int(begin[-1]) // 8 + 2, np.uint64)
        if len(ids):
            heads = np.flatnonzero(np.diff(word, prepend=-1))
            out[word[heads]] = np.add.reduceat(high, heads)
            over = np.flatnonzero(room < 0)
            out[word[over] + 1] |= code[over] << (64 + room[over]).astype(np.uint64)
        data = out.byteswap().view(np.uint8)[: begin[-1]].copy()
        for k, b in enumerate(MAGIC):
            data[begin[:-1] + k] = b
        _put_u32(data, begin[:-1] + 4, sizes)
        marks = np.arange(len(ids)) - first[:-1][row]
        at = np.flatnonzero(marks % EVERY == 0)
        _put_u32(data, begin[:-1][row[at]] + 8 + 4 * (marks[at] // EVERY), local[at])
        return data, total

    def unpack(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of consecutive payloads and the number of each; all checkpoints advance together."""
        begin = offsets[:-1]
        if not len(begin):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        if any((data[begin + k] != b).any() for k, b in enumerate(MAGIC)):
            raise ValueError("not a block of token ids")
        sizes = _get_u32(data, begin + 4)
        points = -(-sizes // EVERY)
        row = np.repeat(np.arange(len(sizes)), points)
        number = np.arange(len(row)) - np.repeat(np.cumsum(points) - points, points)
        bit = 8 * (begin + 8 + 4 * points)[row] + _get_u32(data, begin[row] + 8 + 4 * number)
        left = np.minimum(sizes[row] - number * EVERY, EVERY)
        target = (np.cumsum(sizes) - sizes)[row] + number * EVERY
        order = np.argsort(-left, kind="stable")
        bit, left, target = bit[order], left[order], target[order]
        padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint32)
        window = padded[:-3] << 24 | padded[1:-2] << 16 | padded[2:-1] << 8 | padded[3:]
        ids = np.zeros(int(sizes.sum()), np.uint32)
        live = np.searchsorted(-left, -np.arange(EVERY), "left")
        for k in range(EVERY):
            n = live[k]
            if not n:
                break
            p = bit[:n]
            peek = (window[p >> 3] >> (32 - self.bits - (p & 7)).astype(np.uint32)) & np.uint32((1 << self.bits) - 1)
            ids[target[:n] + k] = self.symbols[peek]
            bit[:n] = p + self.steps[peek]
        return ids, sizes


def _put_u32(data: np.ndarray, at: np.ndarray, values: np.ndarray) -> None:
    for k in range(4):
        data[at + k] = (values >> (8 * k)) & 255


def _get_u32(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    return sum(data[at + k].astype(np.int64) << (8 * k) for k in range(4))


# --- Spark jobs ------------------------------------------------------------------


def encode_documents(documents: DataFrame, tokenizer: str, end_id: int = 1) -> DataFrame:
    """doc_id, n_tokens and ids (little-endian unsigned 16 or 32 bits, by the vocabulary) of each row."""
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with encoder(tokenizer) as enc:
            for batch in batches:
                data, offsets = text_bytes(batch.column(1))
                for i, j in chunks(offsets, 4 << 20):
                    ids, sizes = enc.encode(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], end_id)
                    yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0).slice(i, j - i), "n_tokens": sizes, "ids": binary_rows(ids.astype("<u2" if ids.max() < 1 << 16 else "<u4").view(np.uint8), sizes * (2 if ids.max() < 1 << 16 else 4))})

    return texts.mapInArrow(run, "doc_id long, n_tokens long, ids binary")


def _ids(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row ranges with their ids and sizes; the width of ids follows from the bytes of a row."""
    data, offsets = row_bytes(batch.column(2))
    sizes = batch.column(1).to_numpy()
    for i, j in chunks(offsets, 4 << 20):
        own, n = data[offsets[i] : offsets[j]], sizes[i:j]
        wide = np.diff(offsets[i : j + 1]) == 4 * n
        if wide.any() and not wide.all():
            ids = np.concatenate([data[offsets[k] : offsets[k + 1]].view("<u4" if w else "<u2").astype(np.uint32) for k, w in zip(range(i, j), wide, strict=True)])
        else:
            ids = own.view("<u4" if wide.all() else "<u2").astype(np.uint32)
        yield i, j, ids, n


def count_ids(encoded: DataFrame) -> np.ndarray:
    """Occurrences of each id over all rows; one number per id of the vocabulary reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1, np.int64)
        for batch in batches:
            for _, _, ids, _ in _ids(batch):
                own = np.bincount(ids)
                if len(own) > len(counts):
                    own, counts = counts, own
                counts[: len(own)] += own
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict({"id": pa.array(at, pa.int64()), "n": pa.array(counts[at], pa.int64())})

    rows = encoded.select("doc_id", "n_tokens", "ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(int(rows["id"].max()) + 1 if len(rows) else 1, np.int64)
    counts[rows["id"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    return counts


def write_ids(encoded: DataFrame, path: str, longest: int = LONGEST) -> str:
    """Write rows of :func:`encode_documents` to ``path`` in the file format, in ascending ``doc_id`` order."""
    spark = encoded.sparkSession
    counts = count_ids(encoded)
    lengths = code_lengths(counts, max(longest, int(np.ceil(np.log2(max(2, (counts > 0).sum()))))))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = np.unique(encoded.where("doc_id is not null").approxQuantile("doc_id", [k / n for k in range(1, n)], 1 / (8 * n)) if n > 1 else [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Code(lengths)
        for batch in batches:
            part = np.searchsorted(bounds, batch.column(0).cast(pa.float64()).fill_null(float("-inf")).to_numpy(zero_copy_only=False), "left")
            for i, j, ids, sizes in _ids(batch):
                data, total = code.pack(ids, sizes)
                yield pa.RecordBatch.from_pydict({"part": pa.array(part[i:j], pa.int32()), "doc_id": batch.column(0).slice(i, j - i), "n_tokens": sizes, "payload": binary_rows(data, total)})

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, part = 0, TaskContext.get().partitionId()
        for batch in batches:
            sizes = batch.column(2).to_numpy()
            starts = before + np.cumsum(sizes) - sizes
            before += int(sizes.sum())
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(1), "part": pa.array(np.full(len(sizes), part, np.int32)), "local_start": starts, "n_tokens": batch.column(2), "payload": batch.column(3)})

    coded = encoded.select("doc_id", "n_tokens", "ids").mapInArrow(run, "part int, doc_id long, n_tokens long, payload binary")
    dealt = coded.repartitionById(len(bounds) + 1, "part").sortWithinPartitions("doc_id", "payload")
    dealt.mapInArrow(place, "doc_id long, part int, local_start long, n_tokens long, payload binary").write.option("compression", "none").parquet(f"{path}/blocks")
    spark.createDataFrame([(int(k), int(lengths[k])) for k in np.flatnonzero(lengths)], "id int, length int").coalesce(1).write.parquet(f"{path}/code")
    return path


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids (little-endian unsigned 32 bits) and ids_crc32 of the files' documents."""
    table = spark.read.parquet(f"{path}/code").toPandas()
    lengths = np.zeros(int(table["id"].max()) + 1 if len(table) else 1, np.int64)
    lengths[table["id"].to_numpy(np.int64)] = table["length"].to_numpy(np.int64)
    blocks = spark.read.parquet(f"{path}/blocks")
    totals = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect()
    starts = np.zeros(max((r["part"] for r in totals), default=0) + 1, np.int64)
    for a, b in zip(totals, totals[1:], strict=False):
        starts[b["part"]] = starts[a["part"]] + a["n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Code(lengths)
        for batch in batches:
            data, offsets = row_bytes(batch.column(4))
            for i, j in chunks(offsets, 2 << 20):
                ids, sizes = code.unpack(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                raw = ids.astype("<u4").view(np.uint8)
                ends = np.cumsum(sizes) * 4
                start = starts[batch.column(1).slice(i, j - i).to_numpy()] + batch.column(2).slice(i, j - i).to_numpy()
                crc = [zlib.crc32(raw[e - 4 * n : e]) for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)]
                yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0).slice(i, j - i), "start": start, "n_tokens": sizes, "ids_crc32": pa.array(crc, pa.int64()), "ids": binary_rows(raw, sizes * 4)})

    return blocks.select("doc_id", "part", "local_start", "n_tokens", "payload").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary")


def round_trip(documents: DataFrame, tokenizer: str, end_id: int = 1, path: str | None = None) -> DataFrame:
    """Encode, write in the file format below the shared folder (or to ``path``) and read back."""
    spark = documents.sparkSession
    encoded = materialize(encode_documents(documents, tokenizer, end_id), "token-ids", compression="zstd")
    return read_ids(spark, write_ids(encoded, path or scratch_path(spark, "token-files")))
