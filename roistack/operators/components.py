"""Connected components per position: what a task's own edges connect first, then what tasks have in common.

Edges come as a comparison leaves them, near ones mostly together.  Each task settles its edges, a bounded number at a
time; only components that share a node with another task's meet again, each as one node, in a graph that is small where
the edges lie well.  Of that graph a position of bounded size is settled in a task, larger ones by joins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..plans.scratch import materialize

#: Edges whose components a task finds at once, and edges of a position that one task settles.
LOCAL_EDGES = 1_000_000
#: Components that tasks share which may be broadcast.
BROADCAST_ROWS = 1_000_000


def settle(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes and the smallest node that each is connected with, from edges: roots hook onto smaller roots, paths are halved, until no edge joins two."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = ends[: len(a)], ends[len(a) :]
    root = np.arange(len(nodes))
    while len(a):
        np.minimum.at(root, np.maximum(root[a], root[b]), np.minimum(root[a], root[b]))
        while (root != root[root]).any():
            root = root[root]
        open_ = root[a] != root[b]
        a, b = a[open_], b[open_]
    return nodes, nodes[root]


def _settling(most: int | None):
    """Rows ``name``, ``a``, ``b``, together by name: name, node and component; of a name at most about ``most`` rows at once, each time by themselves."""

    def found(kept: list[pa.RecordBatch]) -> pa.RecordBatch:
        a, b = (np.concatenate([k.column(c).to_numpy() for k in kept]) for c in (1, 2))
        nodes, component = settle(a, b)
        return pa.RecordBatch.from_arrays([pa.array([kept[0].column(0)[0].as_py()] * len(nodes), pa.string()), pa.array(nodes), pa.array(component)], names=["name", "node", "component"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[str | None, list[pa.RecordBatch]] = {}
        held = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            names = batch.column(0).dictionary_encode()
            codes = names.indices.fill_null(-1).to_numpy()
            order = np.argsort(codes, kind="stable")
            cuts = [0, *(1 + np.flatnonzero(np.diff(codes[order]))).tolist(), len(order)]
            for i, j in zip(cuts[:-1], cuts[1:], strict=True):
                part = batch.take(pa.array(order[i:j]))
                name = part.column(0)[0].as_py()
                if most is None and name not in kept:
                    # rows are in order of the name: the one before is complete
                    yield from map(found, kept.values())
                    kept = {}
                kept.setdefault(name, []).append(part)
            held += batch.num_rows
            if most is not None and held >= most:
                yield from map(found, kept.values())
                kept, held = {}, 0
        yield from map(found, kept.values())

    return run


NODES = "name string, node long, component long"


def connected_components(edges: DataFrame, rounds: int = 60, local: int = LOCAL_EDGES) -> DataFrame:
    """name, node and component (the smallest node) from edges ``name``, ``a``, ``b`` of longs.

    A task settles at most about ``local`` edges at once.  ``rounds``: of joins, for components that tasks share.
    """
    own = edges.where("a <> b").select("name", F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))
    found = own.mapInArrow(_settling(local), NODES)
    # a node in several of these components: they are one, known by the smallest of their roots
    least = F.min("component").over(Window.partitionBy("node", "name"))
    found = materialize(found.withColumn("least", least), "settled")
    shared = found.where("component > least").select("name", F.col("component").alias("a"), F.col("least").alias("b")).distinct()
    shared = materialize(shared, "shared")
    nodes = found.where("component = least").select("name", "node", "component").distinct()
    if shared.isEmpty():
        return nodes
    joined = _joined(shared, rounds, local).select(F.col("name").alias("_name"), F.col("node").alias("component"), F.col("component").alias("_root"))
    joined = materialize(joined, "joined")
    joined = F.broadcast(joined) if joined.count() <= BROADCAST_ROWS else joined
    same = F.col("name").eqNullSafe(F.col("_name")) & (nodes["component"] == joined["component"])
    return nodes.join(joined, same, "left").select("name", "node", F.coalesce("_root", nodes["component"]).alias("component"))


def _joined(edges: DataFrame, rounds: int, local: int) -> DataFrame:
    """The same from distinct edges with ``a > b`` that lie anywhere: positions of at most ``local`` edges in a task each, larger ones together by joins."""
    sizes = edges.groupBy("name").agg(F.count("*").alias("_n"))
    large = materialize(sizes.where(F.col("_n") > local).select("name"), "large")
    if large.isEmpty():
        small, rest = edges, None
    else:
        same = edges["name"].eqNullSafe(large["name"])
        small, rest = edges.join(large, same, "left_anti"), edges.join(large, same, "left_semi")
    settled = small.repartition("name").sortWithinPartitions("name").mapInArrow(_settling(None), NODES)
    return settled if rest is None else settled.union(stars(rest, rounds))


def stars(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """The same from distinct edges with ``a > b``: large and small stars alternate until no edge changes."""
    state, last = materialize(edges, "edges"), None
    for _ in range(rounds):
        now = state.agg(F.count("*"), F.sum(F.xxhash64("name", "a", "b").cast("decimal(38,0)"))).first()
        if now == last or not now[0]:
            break
        last = now
        both = state.union(state.select("name", F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("name", "a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, ["name", "a"]).select("name", F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        least = large.groupBy("name", "a").agg(F.min("b").alias("m"))
        small = large.join(least, ["name", "a"]).select("name", F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("name", "a", F.col("m").alias("b")))
        state = materialize(small.where("a <> b").distinct(), "edges")
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return state.select("name", F.col("a").alias("node"), F.col("b").alias("component")).union(state.select("name", "b", "b").distinct())
