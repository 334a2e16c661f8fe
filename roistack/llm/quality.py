"""Quality classifier: co-training of a text view and a page-metadata view.

The text view sees a document's words and the shape of its text, the page view
its language, source and length.  Both are logistic regressions.  In each round
either view labels the unlabelled documents that it is surest of for the other
view's training set; the views' logits are calibrated on labelled documents
that neither has seen, and combined there.

Every round scores all unlabelled documents from a table of their features, which
goes once the tasks have written it to the shared folder; a task keeps the surest rows of
each batch, which hold the surest of all.  Models are fitted on the driver on bounded
samples: ``labelled`` documents of least hashed ids, and ``pseudo`` documents a
round and view.  All documents are scored at last, in one pass without
a shuffle of text; only the models' weights and the ids of pseudo-labels go to the tasks.

Defined results: null columns count as a value of their own, a null text as
empty; a label that is null is none, and of several for one id the mean counts;
with labels of one class only, or none, every document gets their share of good
ones (0.5 without any) and is kept; repeated rows give repeated rows, and of rows that share
an id the one of least features is learned from; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NON_SPACE, byte_table, chunks, fold_case, let_go, materialize, text_bytes, word_hashes, words

WORD_BUCKETS, SOURCE_BUCKETS, LANG_BUCKETS = 256, 64, 16
#: Groups of bytes whose share of a text tells its shape.
SHAPES = [byte_table((0x41, 0x5A)), byte_table((0x61, 0x7A)), byte_table((0x30, 0x39)), byte_table((0x0A, 0x0A)), byte_table((0x80, 0xFF))] + [byte_table((ord(c), ord(c))) for c in ".,;:!?|#$%&*<>/=\"'-_"]
#: Features of the two views.
TEXT_WIDTH, PAGE_WIDTH = len(SHAPES) + 6 + WORD_BUCKETS, LANG_BUCKETS + SOURCE_BUCKETS + 18
TEXT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _per_row(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return sums[first[1:]] - sums[first[:-1]]


def text_features(column: pa.Array) -> np.ndarray:
    """The text view of each row, whole."""
    data, offsets = text_bytes(column)
    return np.concatenate([_text_features(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]) for i, j in chunks(offsets)] or [np.zeros((0, TEXT_WIDTH), np.float32)])


def _text_features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    n = len(offsets) - 1
    size = np.maximum(np.diff(offsets), 1)
    folded = fold_case(data)
    starts, ends, first = words(folded, offsets, NON_SPACE)
    count = np.maximum(np.diff(first), 1)
    h = word_hashes(folded, starts, ends)
    row = np.repeat(np.arange(n), np.diff(first))
    again = np.zeros(len(h))
    again[1:] = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
    order = np.lexsort((h, row))
    new = np.ones(len(h), bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (row[order][1:] != row[order][:-1])
    kinds = np.bincount(row[order][new], minlength=n)
    bytes_of_row = np.bincount(np.repeat(np.arange(n) * 256, np.diff(offsets)) + data, minlength=n * 256).reshape(n, 256)
    lines = bytes_of_row[:, 0x0A] + 1
    columns = [np.sqrt(bytes_of_row[:, t].sum(axis=1) / size) for t in SHAPES]
    columns += [_per_row(again, first) / count, kinds / count, np.log1p(count) / 10, np.log1p(size / count) / 3, np.log1p(count / lines) / 5, (np.diff(first) == 0).astype(float)]
    bag = np.bincount(row * WORD_BUCKETS + (h >> np.uint64(20)).astype(np.int64) % WORD_BUCKETS, minlength=n * WORD_BUCKETS).reshape(n, WORD_BUCKETS)
    bag = np.sqrt(bag / count[:, None])
    return np.concatenate([np.stack(columns, axis=1), bag], axis=1).astype(np.float32)


def _bucket(column: pa.Array, buckets: int) -> np.ndarray:
    names = column.cast(pa.string()).dictionary_encode()
    table = np.array([zlib.crc32(x.encode()) % (buckets - 1) + 1 for x in names.dictionary.to_pylist()] + [0])
    return table[names.indices.fill_null(len(table) - 1).to_numpy()]


def page_features(lang: pa.Array, source: pa.Array, n_chars: pa.Array) -> np.ndarray:
    """The page-metadata view of each row."""
    n = len(lang)
    out = np.zeros((n, PAGE_WIDTH), np.float32)
    out[np.arange(n), _bucket(lang, LANG_BUCKETS)] = 1
    out[np.arange(n), LANG_BUCKETS + _bucket(source, SOURCE_BUCKETS)] = 1
    size = np.log1p(np.maximum(n_chars.cast(pa.float64()).fill_null(-1.0).to_numpy(zero_copy_only=False), 0))
    out[np.arange(n), LANG_BUCKETS + SOURCE_BUCKETS + np.minimum(size, 15).astype(int)] = 1
    out[:, -2], out[:, -1] = size / 10, pc.is_null(n_chars).to_numpy(zero_copy_only=False)
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_logistic(x: np.ndarray, y: np.ndarray, decay: float = 1e-3, steps: int = 25) -> np.ndarray:
    """Weights of a ridge-penalised logistic regression, the intercept last, by Newton's method."""
    x = np.concatenate([x, np.ones((len(x), 1))], axis=1).astype(np.float64)
    w = np.zeros(x.shape[1])
    penalty = np.full(len(w), decay * len(x))
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = _sigmoid(x @ w)
        gradient = x.T @ (p - y) + penalty * w
        curve = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curve, gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _logit(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return x @ w[:-1] + w[-1]


@dataclass
class QualityModel:
    """Two views, their calibrations and the combination; without views a constant."""

    prior: float
    threshold: float = 0.0
    text: np.ndarray | None = None
    page: np.ndarray | None = None
    calibrate: tuple[np.ndarray, np.ndarray] | None = None
    combine: np.ndarray | None = None

    def scores(self, text: np.ndarray, page: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probability of good quality by both views together, by the text and by the page view."""
        if self.text is None:
            return (np.full(len(text), self.prior),) * 3
        own = [_logit(_logit(x, w)[:, None], c) for x, w, c in ((text, self.text, self.calibrate[0]), (page, self.page, self.calibrate[1]))]
        return (_sigmoid(_logit(np.stack(own, axis=1), self.combine)), *map(_sigmoid, own))


def calibrated(views: list[np.ndarray], weights: list[np.ndarray], y: np.ndarray, prior: float, keep_good: float) -> QualityModel:
    """The views' models, calibrated and combined on labelled rows that neither has seen."""
    raw = [_logit(v, w) for v, w in zip(views, weights, strict=True)]
    platt = tuple(fit_logistic(r[:, None], y, decay=1e-4) for r in raw)
    both = np.stack([_logit(r[:, None], c) for r, c in zip(raw, platt, strict=True)], axis=1)
    model = QualityModel(prior, 0.5, *weights, platt, fit_logistic(both, y, decay=1e-4))
    score = model.scores(*views)[0]
    model.threshold = float(min(0.5, np.quantile(score[y == 1], 1 - keep_good)))
    return model


def _ids(documents: DataFrame) -> DataFrame:
    return _columns(documents).where("doc_id is not null")


def _features(documents: DataFrame) -> DataFrame:
    """doc_id and both views' features, as bytes, of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                both = [pa.array([r.tobytes() for r in v], pa.binary()) for v in _views(part)]
                yield pa.RecordBatch.from_pydict({"doc_id": part.column(0), "text": both[0], "page": both[1]})

    return _ids(documents).mapInArrow(run, "doc_id long, text binary, page binary")


def _matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float32).reshape(len(column), width)


def _of_ids(features: DataFrame, ids: DataFrame) -> tuple[np.ndarray, list[np.ndarray]]:
    """The bounded ``ids`` that have features, ascending, and the features, one row for each."""
    rows = features.join(F.broadcast(ids), "doc_id", "left_semi").groupBy("doc_id").agg(F.min(F.struct("text", "page")).alias("own"))
    rows = rows.select("doc_id", "own.text", "own.page").toArrow().sort_by("doc_id")
    return rows.column("doc_id").to_numpy(), [_matrix(rows.column(c), w) for c, w in (("text", TEXT_WIDTH), ("page", PAGE_WIDTH))]


def _surest(features: DataFrame, weights: list[np.ndarray], taken: list[np.ndarray], most: dict[int, int], confident: float) -> DataFrame:
    """doc_id, pupil, label and level (hundredths of confidence) of rows that a view is sure of: of each batch, all that can be among the ``most`` surest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for teacher, width in ((0, TEXT_WIDTH), (1, PAGE_WIDTH)):
                p = _sigmoid(_logit(_matrix(batch.column(1 + teacher), width), weights[teacher]))
                fresh = ~np.isin(ids, taken[1 - teacher])
                for label, sure in ((1, p), (0, 1 - p)):
                    at = np.flatnonzero(fresh & (sure >= confident))
                    level = np.floor(100 * sure[at]).astype(np.int32)
                    # all rows of the last level that is needed: ties go by hash later
                    if len(at) > most[label]:
                        at, level = (x[level >= np.partition(level, -most[label])[-most[label]]] for x in (at, level))
                    n = len(at)
                    yield pa.RecordBatch.from_pydict({"doc_id": ids[at], "pupil": np.full(n, 1 - teacher, np.int32), "label": np.full(n, label, np.int32), "level": level})

    return features.mapInArrow(run, "doc_id long, pupil int, label int, level int")


def fit_quality(documents: DataFrame, labels: DataFrame, labelled: int = 8000, pseudo: int = 400, rounds: int = 5, confident: float = 0.95, keep_good: float = 0.998) -> QualityModel:
    """Fit on at most ``labelled`` documents, those of least hashed ids, and on pseudo-labels given among all others.

    Every fourth labelled row in that order calibrates, the others train.  ``confident``: probability from which a pseudo-label is given,
    to about ``pseudo`` documents a round and view, the surest by hundredths, then those of least hashed ids.
    ``keep_good``: share of good calibration rows that the threshold keeps at least.
    """
    marks = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.avg("quality").alias("quality"))
    marks = marks.select("doc_id", (F.col("quality") > 0.5).cast("int").alias("label"))
    some = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled).toPandas()
    spark = documents.sparkSession
    known = spark.createDataFrame(some[["doc_id"]], "doc_id long")
    ids, views = _of_ids(_features(_ids(documents).join(F.broadcast(known), "doc_id", "left_semi")), known)
    if not len(ids):
        return QualityModel(0.5)
    own = some.assign(place=np.arange(len(some))).set_index("doc_id").loc[ids]
    label, held = own["label"].to_numpy(), own["place"].to_numpy() % 4 == 0
    prior = float(label.mean())
    if any(len(set(label[k].tolist())) < 2 for k in (held, ~held)):
        return QualityModel(prior)

    features = materialize(_features(documents), "quality-features", compression="zstd")
    most = {1: int(np.ceil(pseudo * prior)), 0: int(np.ceil(pseudo * (1 - prior)))}
    sets = [(v[~held], label[~held].astype(float)) for v in views]
    taken = [some["doc_id"].to_numpy()] * 2
    for k in range(rounds + 1):
        weights = [fit_logistic(x, y) for x, y in sets]
        if k == rounds:
            break
        sure = materialize(_surest(features, weights, taken, most, confident), "quality-sure")
        groups = [sure.where((F.col("pupil") == pupil) & (F.col("label") == y)).distinct().orderBy(F.desc("level"), F.xxhash64("doc_id"), "doc_id").limit(n) for pupil in (0, 1) for y, n in most.items()]
        found = groups[0].union(groups[1]).union(groups[2]).union(groups[3]).toPandas()
        if not len(found):
            break
        fresh, x = _of_ids(features, spark.createDataFrame(found[["doc_id"]], "doc_id long").distinct())
        for pupil in (0, 1):
            own = found[found["pupil"] == pupil].drop_duplicates("doc_id")
            sets[pupil] = np.concatenate([sets[pupil][0], x[pupil][np.searchsorted(fresh, own["doc_id"])]]), np.concatenate([sets[pupil][1], own["label"].astype(float)])
            taken[pupil] = np.concatenate([taken[pupil], own["doc_id"]])
    return calibrated([v[held] for v in views], weights, label[held].astype(float), prior, keep_good)


def _columns(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"), F.col("n_chars").cast("double").alias("n_chars"))


def _views(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return text_features(batch.column(1)), page_features(batch.column(2), batch.column(3), batch.column(4))


def score_quality(documents: DataFrame, model: QualityModel) -> DataFrame:
    """doc_id, score, text_score, page_score and keep (score at least the model's threshold) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                score, text, page = model.scores(*_views(part))
                yield pa.RecordBatch.from_pydict({"doc_id": part.column(0), "score": score, "text_score": text, "page_score": page, "keep": score >= model.threshold})

    return _columns(documents).mapInArrow(run, "doc_id long, score double, text_score double, page_score double, keep boolean")


def keep_good(documents: DataFrame, model: QualityModel) -> DataFrame:
    """The rows of ``documents``, with all their columns, that the model doesn't reject."""
    names = documents.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        at = [names.index(c) for c in TEXT_COLUMNS]
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                score = model.scores(*_views(pa.RecordBatch.from_arrays([part.column(k) for k in at], names=TEXT_COLUMNS)))[0]
                yield part.filter(pa.array(score >= model.threshold))

    return documents.mapInArrow(run, documents.schema)
