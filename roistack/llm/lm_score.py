"""LM scoring: a probabilistic suffix tree over the tokens of texts.

A text's tokens are its words and one end.  Symbols of the tree are all tokens
that occur often enough to stand in a context that is tested, the end, a start
mark (only in contexts) and one symbol for all other tokens.  Contexts are the
symbols before a place, up to ``depth`` of them; beyond one symbol only tokens
with a symbol of their own and the start make a context: any other context is
too rare to be tested, so none is left out.
Every context whose next-symbol distribution diverges from its parent's (the
context without its oldest symbol) by a likelihood-ratio test is retained,
together with all its suffixes.  A place is scored by its longest retained
suffix, whose distribution is smoothed towards its parent's (Witten-Bell).  The
root is the distribution of tokens with absolute discounting, and what it takes
away is the probability of an unknown token: probabilities sum to 1 over the
training tokens and the unknown one.  A token that is no symbol of its own gets
its share of the other tokens' probability.

All counts cover all training texts.  Alphabet and tree grow with the corpus;
the tree is a written table that never leaves Spark.  Texts are cut into blocks
of documents, and written once as symbols.  A context is counted only where the
shorter ones within it are frequent, since it is no more frequent than they are.
Shuffled are the hashes of a block's distinct tokens, counts of contexts, the distinct retained
contexts and next symbols of a block to be looked up in the tree, and each
block's text to meet what was found for it; the last two for a third of the blocks at a time.  Sent to the tasks are the alphabet
and, of fixed sizes and only to save look-ups, a bitmap of the retained contexts
and the most frequent rows of the tree.

Defined results: a null or empty text has just its end; a null ``doc_id``
counts as training; repeated rows are counted and scored each; an empty table
gives no rows; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import NON_SPACE, chunks, discard, fold_case, materialize, mix, text_bytes, word_hashes, words

#: Bits of a symbol in a packed context; symbols 1 to 3 are fixed, frequent tokens follow.
BITS = 21
MASK = (1 << BITS) - 1
START, OTHER, END, FIRST_TOKEN = 1, 2, 3, 4
#: Bits of the bitmap of retained contexts, as a power of two.
FILTER_BITS = 25
#: Slices of blocks that look their contexts up and are scored one after the other: on disk at once is one slice's part of what is asked and found.
BLOCK_SLICES = 3
#: Rows of the tree, the most frequent ones, that are sent to the tasks at most.
HEAD_ROWS = 1 << 18
SCHEMA = "doc_id long, held_out boolean, n_tokens long, n_known long, base_log double, score double"


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all rows, and each row's first one."""
    data = fold_case(data)
    starts, ends, first = words(data, offsets, NON_SPACE)
    return word_hashes(data, starts, ends), first


def _distinct_tokens(documents: DataFrame) -> DataFrame:
    """block, hash and the occurrences in training texts, for each piece of a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocks, train = batch.column(0).to_numpy(), ~batch.column(1).to_numpy(zero_copy_only=False)
            data, offsets = text_bytes(batch.column(2))
            for i, j in chunks(offsets, 4 << 20):
                h, first = _tokens(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                row = np.repeat(np.arange(i, j), np.diff(first))
                for block in np.unique(blocks[i:j]):
                    own = blocks[row] == block
                    heads, which = np.unique(h[own], return_inverse=True)
                    n = np.bincount(which, weights=train[row[own]], minlength=len(heads)).astype(np.int64)
                    yield pa.RecordBatch.from_pydict({"block": np.full(len(heads), block, np.int64), "hash": heads.view(np.int64), "n": n})

    return documents.select("block", "held_out", "text").mapInArrow(run, "block long, hash long, n long")


class Symbols:
    """Maps token hashes to symbols: frequent tokens have one of their own."""

    def __init__(self, hashes: np.ndarray | list[int]):
        table = np.array(hashes, np.int64).view(np.uint64)
        self.order = np.argsort(table)
        self.table = table[self.order]
        self.bits = (len(table) + FIRST_TOKEN).bit_length()

    def of(self, h: np.ndarray) -> np.ndarray:
        if not len(self.table):
            return np.full(len(h), OTHER, np.uint64)
        at = np.minimum(np.searchsorted(self.table, h), len(self.table) - 1)
        return np.where(self.table[at] == h, self.order[at] + FIRST_TOKEN, OTHER).astype(np.uint64)

    def flow(self, h: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The symbols of all rows: each row's after a start and before an end."""
        n = len(first) - 1
        flow = np.full(len(h) + 2 * n, START, np.uint64)
        flow[np.arange(len(h)) + 2 * np.repeat(np.arange(n), np.diff(first)) + 1] = self.of(h)
        flow[first[1:] + 2 * np.arange(n) + 1] = END
        return flow

    def places(self, h: np.ndarray, first: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, Iterator[tuple[np.ndarray, np.ndarray]]]:
        """:func:`places_of` the rows' symbols, with each place's row."""
        symbol, levels = places_of(self.flow(h, first), depth)
        return symbol, np.repeat(np.arange(len(first) - 1), np.diff(first) + 1), levels


def places_of(flow: np.ndarray, depth: int) -> tuple[np.ndarray, Iterator[tuple[np.ndarray, np.ndarray]]]:
    """For each token and each row's end: its symbol, and for k = 1 to ``depth`` places with their contexts of k symbols."""
    here = np.flatnonzero(flow != START)

    def levels() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        live, context, index = here, np.zeros(len(here), np.uint64), np.arange(len(here))
        for k in range(1, depth + 1):
            back = flow[live - k]
            fine = back != END
            if k > 1:
                fine &= back != OTHER
                fine &= context >> np.uint64(BITS * (k - 2)) != START
                if k == 2:
                    fine &= context != OTHER
            live, context, index = live[fine], context[fine] | (back[fine] << np.uint64(BITS * (k - 1))), index[fine]
            yield index, context

    return flow[here], levels()


def _flows(documents: DataFrame, symbols: Symbols) -> DataFrame:
    """block, held_out and the symbols (32-bit integers) of each text: a row for a text, so that batches stay as small as those of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(2))
            for i, j in chunks(offsets):
                h, first = _tokens(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                ends = (4 * (first + 2 * np.arange(j - i + 1))).astype(np.int64)
                flow = pa.LargeBinaryArray.from_buffers(pa.large_binary(), j - i, [None, pa.py_buffer(ends), pa.py_buffer(symbols.flow(h, first).astype(np.uint32))])
                yield pa.RecordBatch.from_pydict({"block": batch.column(0).slice(i, j - i), "held_out": batch.column(1).slice(i, j - i), "flow": flow.cast(pa.binary())})

    return documents.select("block", "held_out", "text").mapInArrow(run, "block long, held_out boolean, flow binary")


def _pieces(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Ranges of rows that :func:`_flows` gave, with their symbols and how many each row has."""
    _, offsets, data = column.cast(pa.large_binary()).buffers()
    offsets = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    for i, j in chunks(offsets):
        yield i, j, np.frombuffer(data, np.uint32, (offsets[j] - offsets[i]) // 4, int(offsets[i])).astype(np.uint64), np.diff(offsets[i : j + 1]) // 4


def _packed(context: np.ndarray, symbol: np.ndarray, bits: int) -> np.ndarray:
    """One key of a context and its next symbol, where four symbols of ``bits`` fit into 64."""
    key = symbol.astype(np.uint64)
    for k in range(3):
        key |= (context >> np.uint64(BITS * k) & np.uint64(MASK)) << np.uint64(bits * (k + 1))
    return key


def _summed(context: np.ndarray, symbol: np.ndarray, n: np.ndarray | None, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct contexts and next symbols with the sums of ``n`` (None: ones); symbols are of ``bits``."""
    if not len(context):
        return context, symbol, np.zeros(0, np.int64)
    if 4 * bits <= 64:
        # one sort of plain numbers instead of two of places
        key = _packed(context, symbol, bits)
        order = np.argsort(key)
        key = key[order]
        new = key[1:] != key[:-1]
    else:
        order = np.lexsort((symbol, context))
        new = (np.diff(context[order]) != 0) | (np.diff(symbol[order]) != 0)
    heads = np.flatnonzero(np.concatenate([[True], new]))
    sums = np.diff(heads, append=len(order)) if n is None else np.add.reduceat(n[order], heads)
    return context[order[heads]], symbol[order[heads]], sums


def _context_counts(flows: DataFrame, bits: int, depth: int, among: np.ndarray | None = None, within: np.ndarray | None = None, hold: int = 1 << 19) -> DataFrame:
    """context, symbol and n: how often each symbol (of ``bits``) follows each context that the bitmap ``among`` has in training texts.

    Without that bitmap: context and n only, how often each context stands in them.  ``within``: a bitmap of contexts of
    ``depth`` - 1 symbols; only contexts of ``depth`` symbols are counted, whose newest and oldest ones it has.
    """

    def batches_of(context: np.ndarray, symbol: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(context), 1 << 16):
            part = slice(i, i + (1 << 16))
            yield pa.RecordBatch.from_pydict({"context": context[part].view(np.int64), "symbol": symbol[part].astype(np.int32), "n": n[part]})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for batch in batches:
            for _, _, flow, _ in _pieces(batch.column(0)):
                symbol, levels = places_of(flow, depth)
                found = []
                for k, (index, context) in enumerate(levels, 1):
                    if among is not None:
                        asked = _in_bitmap(among, context)
                        found.append((context[asked], symbol[index[asked]]))
                        continue
                    if within is not None:
                        if k < depth:
                            continue
                        context = context[_in_bitmap(within, context & np.uint64((1 << BITS * (depth - 1)) - 1))]
                        context = context[_in_bitmap(within, context >> np.uint64(BITS))]
                    found.append((context, np.zeros(len(context), np.uint64)))
                held.append(_summed(*map(np.concatenate, zip(*found, strict=True)), None, bits))
                if sum(len(part[0]) for part in held) > hold:
                    held = [_summed(*map(np.concatenate, zip(*held, strict=True)), bits)]
                    if len(held[0][0]) > hold // 2:
                        yield from batches_of(*held.pop())
        if held:
            yield from batches_of(*_summed(*map(np.concatenate, zip(*held, strict=True)), bits))

    counts = flows.where(~F.col("held_out")).select("flow").mapInArrow(run, "context long, symbol int, n long")
    return counts.groupBy(*(["context"] if among is None else ["context", "symbol"])).agg(F.sum("n").alias("n"))


def frequent_counts(flows: DataFrame, bits: int, depth: int, min_count: int) -> DataFrame:
    """:func:`_context_counts` of the contexts that stand in training texts ``min_count`` times or more, and of few others.

    Most contexts are rarer, so they are counted by themselves first, and their next symbols are never shuffled; those of
    three symbols only where both contexts of two in them are frequent.
    """
    bitmap = context_filter(_context_counts(flows, bits, min(depth, 2)).where(F.col("n") >= min_count))
    for k in range(3, depth + 1):
        bitmap |= context_filter(_context_counts(flows, bits, k, within=bitmap).where(F.col("n") >= min_count))
    return _context_counts(flows, bits, depth, bitmap)


def _suffix(context: Column, k: int) -> Column:
    """The newest ``k`` symbols of a context."""
    return context.bitwiseAND(F.lit((1 << (BITS * k)) - 1))


def grow_tree(counts: DataFrame, root: DataFrame, depth: int, min_count: int, divergence: float) -> DataFrame:
    """context, symbol, n and kinds of the retained contexts; a context's own row has symbol 0, its total as n and its kinds of next symbols. ``root``: symbol and p of the empty context."""
    own = Window.partitionBy("context")
    frequent = counts.withColumns({"total": F.sum("n").over(own), "kinds": F.count("*").over(own)}).where(F.col("total") >= min_count)
    frequent = materialize(frequent, "lm-contexts")
    context = F.col("context")
    parent = F.lit(0).cast("long")
    for k in range(1, depth):
        parent = F.when(context >= F.lit(1 << (BITS * k)), _suffix(context, k)).otherwise(parent)
    parents = root.select(F.lit(0).cast("long").alias("parent"), "symbol", "p").unionByName(frequent.select(context.alias("parent"), "symbol", (F.col("n") / F.col("total")).alias("p")))
    tested = (
        frequent.withColumn("parent", parent).join(parents, ["parent", "symbol"])
        .groupBy("context").agg(F.sum(F.col("n") * F.log(F.col("n") / F.col("total") / F.col("p"))).alias("gain"), F.max("kinds").alias("kinds"))
        .where(F.col("gain") > divergence * (F.col("kinds") + 1))
    )
    closed = tested.select(F.explode(F.array(*[_suffix(context, k) for k in range(1, depth + 1)])).alias("context")).distinct()
    retained = materialize(frequent.join(closed, "context", "left_semi"), "lm-retained")
    own_rows = retained.groupBy("context").agg(F.lit(0).alias("symbol"), F.first("total").alias("n"), F.first("kinds").alias("kinds"))
    tree = materialize(retained.select("context", "symbol", "n", F.lit(0).cast("long").alias("kinds")).unionByName(own_rows), "lm-tree")
    discard(frequent)
    discard(retained)
    return tree


class SuffixTree:
    """Retained contexts as sorted arrays, above the root's probabilities by symbol; rows are those of :func:`grow_tree`."""

    def __init__(self, context: np.ndarray, symbol: np.ndarray, n: np.ndarray, kinds: np.ndarray, root: np.ndarray):
        own = symbol == 0
        self.contexts, first = np.unique(context[own], return_index=True)
        self.total, self.kinds = n[own][first].astype(np.float64), kinds[own][first].astype(np.float64)
        keys = self._key(np.searchsorted(self.contexts, context[~own]), symbol[~own])
        order = np.argsort(keys)
        self.keys, self.n = keys[order], n[~own][order].astype(np.float64)
        self.root = root

    @staticmethod
    def _key(at: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        return at.astype(np.uint64) << np.uint64(BITS) | symbol.astype(np.uint64)

    def holds(self, context: np.ndarray, symbol: np.ndarray | None = None) -> np.ndarray:
        """Whether there are rows of these contexts, or of these contexts and next symbols."""
        if not len(self.contexts):
            return np.zeros(len(context), bool)
        at = np.minimum(np.searchsorted(self.contexts, context), len(self.contexts) - 1)
        there = self.contexts[at] == context
        if symbol is None or not len(self.keys):
            return there & (symbol is None)
        key = self._key(at, symbol)
        return there & (self.keys[np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)] == key)

    def probabilities(self, symbol: np.ndarray, levels: Iterable[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """P(symbol | longest retained suffix) of each place."""
        p = self.root[symbol.astype(np.int64)]
        retained = np.ones(len(symbol), bool)
        for index, context in levels:
            if not len(self.contexts):
                break
            live = retained[index]
            index, context = index[live], context[live]
            heads, inverse = np.unique(context, return_inverse=True)
            at = np.minimum(np.searchsorted(self.contexts, heads), len(self.contexts) - 1)
            there = (self.contexts[at] == heads)[inverse]
            at = at[inverse]
            retained[:] = False
            retained[index[there]] = True
            index, at = index[there], at[there]
            n = np.zeros(len(index))
            if len(self.keys):
                key = self._key(at, symbol[index])
                found = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                n = np.where(self.keys[found] == key, self.n[found], 0.0)
            p[index] = (n + self.kinds[at] * p[index]) / (self.total[at] + self.kinds[at])
        return p


def _in_bitmap(bitmap: np.ndarray, context: np.ndarray) -> np.ndarray:
    bit = _filter_bits(context)
    return bitmap[bit >> 6] >> (bit & 63).astype(np.uint64) & np.uint64(1) > 0


def _filter_bits(context: np.ndarray) -> np.ndarray:
    return (mix(context) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def context_filter(contexts: DataFrame) -> np.ndarray:
    """A bitmap, in words of 64 bits, with the bits of all ``context`` set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = _filter_bits(batch.column(0).to_numpy().view(np.uint64))
            yield pa.RecordBatch.from_pydict({"word": at >> 6, "mask": (np.uint64(1) << (at & 63).astype(np.uint64)).view(np.int64)})

    # written, so that the shuffles behind it go at once
    words_set = materialize(contexts.select("context").mapInArrow(run, "word long, mask long").groupBy("word").agg(F.bit_or("mask").alias("mask")), "lm-bits")
    words_set, written = words_set.toArrow(), words_set
    discard(written)
    bitmap = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    bitmap[words_set.column("word").to_numpy()] = words_set.column("mask").to_numpy().view(np.uint64)
    return bitmap


def tree_head(tree: DataFrame, most: int) -> pa.Table:
    """The rows of the tree of the largest counts, ``most`` at most: those from the least power of 2^(1/8) that so many reach."""
    step = F.floor(F.log2("n") * 8)
    left, least = most, None
    for r in sorted(tree.groupBy(step.alias("step")).count().collect(), reverse=True):
        left -= r["count"]
        if left < 0:
            break
        least = r["step"]
    return tree.where(step >= least if least is not None else F.lit(False)).toArrow().select(["context", "symbol", "n", "kinds"])


def _wanted(flows: DataFrame, bits: int, depth: int, bitmap: np.ndarray, head: SuffixTree) -> DataFrame:
    """block, context and symbol (0 for the context's own row) that a block's texts ask the tree for beyond its head."""

    def rows_of(block: int, context: np.ndarray, follow: np.ndarray) -> Iterator[pa.RecordBatch]:
        heads = np.unique(context)
        heads = heads[~head.holds(heads)]
        rare = ~head.holds(context, follow)
        context, follow = np.concatenate([context[rare], heads]), np.concatenate([follow[rare], np.zeros(len(heads), np.uint64)])
        for i in range(0, len(context), 1 << 16):
            part = slice(i, i + (1 << 16))
            yield pa.RecordBatch.from_pydict({"block": np.full(len(context[part]), block, np.int64), "context": context[part].view(np.int64), "symbol": follow[part].astype(np.int32)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # what blocks asked for so far: a block goes out when a piece holds nothing of it, or when it is large
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            blocks = batch.column(0).to_numpy()
            for i, j, flows_of, sizes in _pieces(batch.column(1)):
                of_block = np.repeat(blocks[i:j], sizes)
                here = np.unique(blocks[i:j]).tolist()
                for b in here:
                    symbol, levels = places_of(flows_of[of_block == b], depth)
                    found = [held[b]] if b in held else []
                    for at, context in levels:
                        asked = _in_bitmap(bitmap, context)
                        found.append((context[asked], symbol[at[asked]]))
                    held[b] = _summed(*map(np.concatenate, zip(*found, strict=True)), None, bits)[:2]
                for b in [b for b, (context, _) in held.items() if b not in here or len(context) > 1 << 19]:
                    yield from rows_of(b, *held.pop(b))
        for b, rows in held.items():
            yield from rows_of(b, *rows)

    return flows.select("block", "flow").mapInArrow(run, "block long, context long, symbol int")


def score_documents(
    documents: DataFrame, held_out: Column, depth: int = 3, symbols: int | None = None, min_count: int = 100, divergence: float = 2.0, symbol_growth: float = 0.5, block_docs: int = 4096
) -> DataFrame:
    """Score every text by a tree that learns from the texts where ``held_out`` is not true.

    ``depth``: symbols of the longest context (at most 3).  ``symbols``: None gives every token of ``min_count`` occurrences a symbol
    of its own, so that no context that could be tested is left out; a number asks for a smaller tree, of so many of the most
    frequent tokens and ``symbol_growth`` times the square root of the training tokens more.  More than two million symbols
    are an error, which a larger ``min_count`` mends.
    ``min_count``: occurrences of a context that is tested.  ``divergence``: log-likelihood gain over the parent, for each next
    symbol, that retains it.  ``block_docs``: ids in a block of documents.
    """
    spark = documents.sparkSession
    texts = documents.select(
        F.coalesce(F.expr(f"doc_id div {block_docs}"), -1 - F.pmod(F.xxhash64("text"), F.lit(1024))).cast("long").alias("block"), F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col("text").cast("string").alias("text"),
    )
    by_block = materialize(_distinct_tokens(texts), "lm-tokens", compression="zstd")
    counted = materialize(by_block.groupBy("hash").agg(F.sum("n").alias("n")), "lm-counts")
    n_end = texts.where(~F.col("held_out")).count()
    n_words, kinds, once, twice = counted.agg(F.coalesce(F.sum("n"), F.lit(0)), *[F.count(F.when(c, 1)) for c in (F.col("n") > 0, F.col("n") == 1, F.col("n") == 2)]).first()
    total, kinds = n_words + n_end, kinds + (n_end > 0)
    discount = once / (once + 2.0 * twice) if once else 0.5
    if symbols is None:
        top = counted.where(F.col("n") >= max(min_count, 1))
        most = top.count()
    else:
        top = counted.where("n > 0").orderBy(F.desc("n"), "hash")
        most = symbols + math.isqrt(int(total * symbol_growth**2))
    if most > MASK - FIRST_TOKEN:
        raise ValueError(f"{most} tokens would have symbols of their own, more than {MASK - FIRST_TOKEN}: set min_count to more than {min_count}")
    top = (top if symbols is None else top.limit(most)).toArrow()
    top_n = top.column("n").to_numpy()
    known = Symbols(top.column("hash").to_numpy())
    share = lambda n: (n - discount) / max(total, 1) if n else 1e-12
    unknown = discount * kinds / total if total else 1.0
    root = np.array([0.0, 0.0, 0.0, share(n_end)] + [share(n) for n in top_n])
    root[OTHER] = max(1.0 - root.sum(), unknown, 1e-12)
    # a block's tokens, marked by symbol -1
    tokens = by_block.select("block", "hash").join(counted, "hash").select("block", F.col("hash").alias("key"), F.lit(-1).alias("symbol"), "n", F.lit(0).cast("long").alias("kinds"))
    tokens = materialize(tokens, "lm-block-tokens", compression="zstd")
    discard(by_block)
    discard(counted)
    there = np.flatnonzero(root > 0)
    root_table = spark.createDataFrame(pa.table({"symbol": there, "p": root[there]}))
    flows = materialize(_flows(texts, known), "lm-flows", compression="zstd")
    tree = grow_tree(frequent_counts(flows, known.bits, depth, min_count), root_table, depth, min_count, divergence)
    table = tree_head(tree, HEAD_ROWS)
    first = [table.column("context").to_numpy().view(np.uint64)] + [table.column(c).to_numpy() for c in ("symbol", "n", "kinds")]
    bitmap, head = context_filter(tree.where("symbol = 0")), SuffixTree(*first, root)

    def look_up(texts_of_block: pa.Table, facts: pa.Table) -> pa.Table:
        keys, kind = facts.column("key").to_numpy().view(np.uint64), facts.column("symbol").to_numpy()
        counts, types = facts.column("n").to_numpy(), facts.column("kinds").to_numpy()
        of_tree = kind >= 0
        tree = SuffixTree(*(np.concatenate([x, y[of_tree]]) for x, y in zip(first, (keys, kind, counts, types), strict=True)), root)
        hashes, n = keys[~of_tree], counts[~of_tree]
        order = np.argsort(hashes)
        hashes, n = hashes[order], n[order]
        base = np.log10(n + 1.0)
        # of a token that is no symbol: its share of all such tokens
        rest = np.log10(np.where(n > 0, np.maximum(n - discount, 1e-12) / max(total, 1), unknown) / root[OTHER])
        out = []
        for batch in texts_of_block.to_batches():
            data, offsets = text_bytes(batch.column(3))
            for i, j in chunks(offsets):
                rows = j - i
                h, starts = _tokens(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                at = np.searchsorted(hashes, h)
                symbol, row, levels = known.places(h, starts, depth)
                logs = np.log10(tree.probabilities(symbol, levels))
                logs[symbol == OTHER] += rest[at[symbol[symbol != END] == OTHER]]
                word_row = np.repeat(np.arange(rows), np.diff(starts))
                out.append(pa.RecordBatch.from_pydict({
                    "doc_id": batch.column(1).slice(i, rows), "held_out": batch.column(2).slice(i, rows), "n_tokens": np.diff(starts) + 1,
                    "n_known": np.bincount(word_row, weights=n[at] > 0, minlength=rows).astype(np.int64) + int(n_end > 0),
                    "base_log": np.bincount(word_row, weights=base[at], minlength=rows) + np.log10(n_end + 1.0), "score": np.bincount(row, weights=logs, minlength=rows),
                }))
        return pa.Table.from_batches(out) if out else _EMPTY

    parts = []
    for k in range(BLOCK_SLICES):
        own = F.pmod(F.col("block"), F.lit(BLOCK_SLICES)) == k
        wanted = _wanted(flows.where(own), known.bits, depth, bitmap, head)
        answers = wanted.join(tree, ["context", "symbol"]).select("block", F.col("context").alias("key"), "symbol", "n", "kinds")
        answers = materialize(answers, "lm-answers", compression="zstd")
        # a block's tokens, and what the tree holds of its contexts
        scored = texts.where(own).groupBy("block").cogroup(tokens.where(own).unionByName(answers).groupBy("block")).applyInArrow(look_up, SCHEMA)
        parts.append(materialize(scored, "lm-scored", compression="zstd"))
        discard(answers)
    for table in (flows, tree, tokens):
        discard(table)
    found = reduce(DataFrame.union, parts)
    norm = float(np.log10(total + kinds + 1.0))
    return found.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(int(total)).cast("long").alias("train_tokens"), (F.col("base_log") - F.col("n_tokens") * norm).alias("base_score"), "score")


_EMPTY = pa.table({"doc_id": pa.array([], pa.int64()), "held_out": pa.array([], pa.bool_()), "n_tokens": pa.array([], pa.int64()), "n_known": pa.array([], pa.int64()), "base_log": pa.array([], pa.float64()), "score": pa.array([], pa.float64())})
