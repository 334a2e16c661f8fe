"""Spelling variant grouping: words within one edit, by dense tiling over prefixes and suffixes.

Two words are one inserted, deleted or replaced code point apart exactly if
their common prefix and common suffix together reach the longer length M less
one.  One of the two then reaches M // 2, so words meet in tiles that share M
and a prefix, or a suffix, of M // 2 code points: a word of length L belongs to
the tiles of M = L and M = L + 1.  Within a tile, code points padded to a matrix
give all lengths of common prefixes and suffixes of a block of pairs at once.  A
pair that shares the tile's prefix counts there, any other in the tile of its
suffix: each pair is seen once and no near pair is missed.

A tile of many words is cut into chunks by hash, and pairs of chunks are groups
of bounded size, anywhere on the cluster.  Pairs themselves are never written:
a group gives each of its words the number of near words and the best of them.

Shuffled: counts of words of each piece of texts, then four rows for each
distinct word that is frequent enough.  To the driver: counts.

Defined results: null and empty texts hold no words; a null ``doc_id`` reads as
an empty one in the hash; repeated rows count again; letters are A-Z, a-z and
U+00C0 to U+00FF, so a word is bytes in Latin-1; an empty table gives no rows;
other columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_table, chunks, fold_case, materialize, text_bytes, word_hashes, words

#: Bytes of text whose words are counted together.
PIECE_BYTES = 8 << 20
#: Words of a tile that are compared in one group.
TILE = 2048
#: Code points of pairs that are compared together.
BLOCK = 8 << 20
#: In UTF-8 the letters beyond ASCII are this byte and one of 0x80 to 0xBF, which is the letter's code point less 0x40.
LEAD, SHIFT = 0xC3, 0x40

_LETTER = byte_table((0x41, 0x5A), (0x61, 0x7A), (LEAD, LEAD))
_OWN = byte_table((1, 1))


def letters(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which UTF-8 bytes belong to letters, their Latin-1 bytes, and the number of these before each place."""
    second = np.zeros(len(data), bool)
    second[1:] = data[:-1] == LEAD
    mask = _LETTER[data] | second
    keep = mask & (data != LEAD)
    return mask, np.where(second, data + np.uint8(SHIFT), data)[keep], np.concatenate([[0], np.cumsum(keep)])


def count_words(ids: pa.Array, data: np.ndarray, offsets: np.ndarray, least: int, every: int) -> tuple[list[str], np.ndarray]:
    """Words of at least ``least`` code points in the rows' texts and how often each occurs, after ``every``-th ones have lost a code point."""
    data = fold_case(data)
    mask, plain, before = letters(data)
    starts, ends, first = words(mask.view(np.uint8), offsets, _OWN)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    long = before[ends] - before[starts] >= least
    starts, ends, row = starts[long], ends[long], row[long]
    h = word_hashes(plain, before[starts], before[ends])
    # a word's hash hangs on the document and the word, so it is taken once for each of both
    order = np.lexsort((h, row))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(h[order]) != 0) | (np.diff(row[order]) != 0)
    at, counts = order[new], np.diff(np.append(np.flatnonzero(new), len(order)))
    text, crc = data.tobytes(), zlib.crc32
    begun = [crc(f"{'' if i is None else i}:".encode()) for i in ids.to_pylist()]
    code = np.fromiter((crc(text[a:b], begun[r]) for a, b, r in zip(starts[at].tolist(), ends[at].tolist(), row[at].tolist(), strict=True)), np.int64, len(at))
    cut = code % every == 0
    _, one, which = np.unique(h[at[~cut]], return_index=True, return_inverse=True)
    found = [text[a:b].decode() for a, b in zip(starts[at[~cut]][one].tolist(), ends[at[~cut]][one].tolist(), strict=True)]
    sums = np.zeros(len(one), np.int64)
    np.add.at(sums, which, counts[~cut])
    whole, more, latin = [], [], plain.tobytes()
    for a, b, c, n in zip(before[starts[at[cut]]].tolist(), before[ends[at[cut]]].tolist(), code[cut].tolist(), counts[cut].tolist(), strict=True):
        if b - a > least:
            gone = a + c % (b - a)
            whole.append((latin[a:gone] + latin[gone + 1 : b]).decode("latin-1"))
            more.append(n)
    return found + whole, np.concatenate([sums, np.array(more, np.int64)])


def vocabulary(documents: DataFrame, least_length: int, least_count: int, every: int) -> DataFrame:
    """word and n of the words that are long and frequent enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for i, j in chunks(offsets, PIECE_BYTES):
                found, n = count_words(batch.column(0).slice(i, j - i), data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], least_length, every)
                yield pa.RecordBatch.from_pydict({"word": pa.array(found, pa.string()), "n": n})

    texts = documents.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _matrices(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of each word from its start and from its end, padded with zeros, and the words' lengths."""
    data, offsets = text_bytes(column)
    _, plain, before = letters(data)
    first = before[offsets]
    size = np.diff(first)
    ahead = np.zeros((len(size), int(size.max(initial=1))), np.uint8)
    row, at = np.repeat(np.arange(len(size)), size), np.arange(len(plain)) - np.repeat(first[:-1], size)
    ahead[row, at] = plain
    back = np.zeros_like(ahead)
    back[row, np.repeat(size, size) - 1 - at] = plain
    return ahead, back, size


def _reach(x: np.ndarray, y: np.ndarray, most: np.ndarray) -> np.ndarray:
    """How many code points rows of both matrices share from the first on, ``most`` at most."""
    other = x != y
    at = other.argmax(axis=1)
    return np.minimum(np.where(other[np.arange(len(at)), at], at, most), most)


def _near_in_groups(column: pa.Array, n: np.ndarray, m: int, suffix: np.ndarray, part: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows of words with near ones in their group: how many, and the largest count and the row of the best.

    The words have ``m`` or ``m - 1`` code points; groups stand together.  ``part``: 0 where a group's words all
    pair, else 1 and 2 for its two chunks, of which only words of different ones pair.
    """
    ahead, back, size = _matrices(column)
    # the longer words first, so that each pairs with what follows it in the group
    order = np.lexsort((size < m, group))
    end = np.searchsorted(group[order], group[order], "right")
    longer = np.flatnonzero(size[order] == m)
    follow = end[longer] - longer - 1
    sums = np.concatenate([[0], np.cumsum(follow)])
    step, found = max(1, BLOCK // ahead.shape[1]), []
    k = 0
    while k < len(longer):
        last = max(int(np.searchsorted(sums, sums[k] + step, "right")) - 1, k + 1)
        counts = follow[k:last]
        one = np.repeat(longer[k:last], counts)
        two = one + 1 + np.arange(len(one)) - np.repeat(sums[k:last] - sums[k], counts)
        k = last
        a, b = order[one], order[two]
        apart = (part[a] == 0) | (part[a] != part[b])
        a, b = a[apart], b[apart]
        most = np.minimum(size[a], size[b])
        head = _reach(ahead[a], ahead[b], most)
        own = (head >= m // 2) != suffix[a]
        a, b, most, head = a[own], b[own], most[own], head[own]
        near = head + _reach(back[a], back[b], most) >= m - 1
        found.append((a[near], b[near]))
    a, b = (np.concatenate([f[s] for f in found]) if found else np.zeros(0, np.int64) for s in (0, 1))
    a, b = np.concatenate([a, b]), np.concatenate([b, a])
    place = np.empty(len(size), np.int64)
    place[np.argsort(ahead.view(f"S{ahead.shape[1]}").ravel(), kind="stable")] = np.arange(len(size))
    best = np.lexsort((place[b], -n[b], a))
    rows, at, many = np.unique(a[best], return_index=True, return_counts=True)
    return rows, many, n[b[best][at]], b[best][at]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``m``, ``suffix``, ``part``, ``p``, ``q``, ``chunk``, ``word``, ``n`` in order of the first five: near words of each within its group."""

    def near(table: pa.Table) -> Iterator[pa.RecordBatch]:
        m, suffix, p, q, chunk, n = (table.column(c).to_numpy(zero_copy_only=False) for c in ("m", "suffix", "p", "q", "chunk", "n"))
        key = pa.concat_arrays(table.column("part").chunks).dictionary_encode().indices.to_numpy()
        new = np.zeros(len(m), bool)
        for c in (m, suffix.astype(np.int8), p, q, key):
            new[1:] |= np.diff(c) != 0
        group = np.cumsum(new)
        part = np.where(p == q, 0, np.where(chunk == p, 1, 2))
        word = pa.concat_arrays(table.column("word").chunks)
        for a in np.flatnonzero(np.diff(m, prepend=-1)).tolist():
            b = int(np.searchsorted(m, m[a], "right"))
            own = word.slice(a, b - a)
            rows, many, most, best = _near_in_groups(own, n[a:b], int(m[a]), suffix[a:b], part[a:b], group[a:b])
            if len(rows):
                yield pa.RecordBatch.from_pydict({"word": own.take(pa.array(rows)), "n_near": many.astype(np.int64), "form_n": most, "form": own.take(pa.array(best))})

    kept: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [batch.column(c) for c in range(5)]
        # the last group may go on in the next batch
        same = np.ones(batch.num_rows, bool)
        for c in keys:
            same &= pc.equal(c, c[-1]).to_numpy(zero_copy_only=False)
        cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
        if cut:
            yield from near(pa.Table.from_batches([*kept, batch.slice(0, cut)]))
            kept = [batch.slice(cut)]
        elif kept and any(kept[-1].column(c)[-1] != batch.column(c)[0] for c in range(5)):
            yield from near(pa.Table.from_batches(kept))
            kept = [batch]
        else:
            kept.append(batch)
    if kept:
        yield from near(pa.Table.from_batches(kept))


def near_words(words: DataFrame, tile: int = TILE) -> DataFrame:
    """word, n_near, form_n and form: the number of near words, and the one of largest n (ties: the smallest) with its n."""
    size = F.char_length("word")
    longer = F.explode(F.array(size, size + 1)).alias("m")
    half = (F.col("m") / 2).cast("int")
    placed = words.select("word", "n", longer).select("*", F.explode(F.array(F.lit(False), F.lit(True))).alias("suffix"))
    placed = placed.withColumn("part", F.when(F.col("suffix"), F.right("word", half)).otherwise(F.left("word", half)))
    key = ["m", "suffix", "part"]
    large = placed.groupBy(*key).agg(F.count("*").alias("size")).where(F.col("size") > tile)
    placed = placed.join(large.select(*key, F.ceil(F.col("size") / tile).cast("int").alias("chunks")), key, "left")
    many = F.coalesce("chunks", F.lit(1))
    placed = placed.withColumn("chunk", F.pmod(F.xxhash64("word"), many).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), many - 1)))
    placed = placed.withColumns({"p": F.least("chunk", "other"), "q": F.greatest("chunk", "other")})
    tasks = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    group = [*key, "p", "q"]
    dealt = placed.select(*group, "chunk", "word", "n").repartition(tasks, *group).sortWithinPartitions(*group)
    found = dealt.mapInArrow(_compare, "word string, n_near long, form_n long, form string")
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select("word", "n_near", (-F.col("best.less")).alias("form_n"), F.col("best.form").alias("form"))


def _roots(forms: DataFrame) -> DataFrame:
    """word and root from word and form: the last form that can be reached.  A form is ten times as frequent, so paths are short, and each round doubles what is followed."""
    state = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = state.select(F.col("word").alias("root"), F.col("root").alias("next"))
        state = materialize(state.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        moved = state.agg(F.coalesce(F.bool_or("moved"), F.lit(False))).first()[0]
        state = state.drop("moved")
        if not moved:
            return state


def spelling_forms(documents: DataFrame, least_length: int = 7, least_count: int = 2, ratio: int = 10, every: int = 31, tile: int = TILE) -> DataFrame:
    """word, form, root, n, n_near and form_n of the words of ``least_length`` code points and ``least_count`` occurrences.

    A word's form is its near word of largest n, if that is at least ``ratio`` times the word's own (more than once
    it, so that forms lead to an end).  ``every``: runs whose hash it divides lose a code point.
    """
    if ratio < 2:
        raise ValueError("ratio must be 2 or more")
    words = materialize(vocabulary(documents, least_length, least_count, every), "vocabulary")
    near = words.join(near_words(words, tile), "word", "left")
    known = F.col("form_n") >= F.col("n") * ratio
    formed = materialize(near.select("word", F.when(known, F.col("form")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(known, F.col("form_n")).alias("form_n")), "forms")
    roots = _roots(formed.where("form is not null"))
    return formed.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
