"""Text quality by a generalised additive model with pairwise interactions.

The model is a sum of lookup tables: one per feature, over its bins, and one per chosen
pair of features, over a grid of bins.  It is boosted cyclically: in every round each
feature in turn gets a shallow tree over its bins, fitted to the gradient of the logistic
loss with the others held fixed, and adds a small multiple of it to its table; then the
pairs that explain most of what is left are boosted in the same way.  Scoring is a
vectorised look-up and addition of bins.

The model is fitted on the driver over the features of a bounded sample of labelled rows,
``MAX_TRAIN_ROWS`` of the smallest hash of the id.  Everything else runs over all rows
as a map over Arrow batches; features come from whole texts.

Defined cases: NULL and empty texts have all features 0 and are scored like any other; a
document with several labels is several training rows, one whose label is NULL is none;
documents that repeat an id and text are one, and of an id with several texts each is
one, as far as ``MAX_TRAIN_ROWS`` goes;
without labels, or with one class only, the score is the smoothed base rate for all rows;
labels without a document are not used.  Other columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cyclemart.llm import textarrays as ta
from cyclemart.llm.common import fresh, stored

MAX_TRAIN_ROWS = 20_000
BINS, PAIR_BINS = 48, 12
ROUNDS, PAIRS, PAIR_ROUNDS, RATE, SPLITS, MIN_ROWS = 150, 6, 60, 0.15, 3, 20

FEATURES = [
    "log_bytes", "log_words", "word_bytes", "upper", "digit", "space", "wide", "stop", "comma", "bang", "pipe",
    "symbol", "other_mark", "distinct", "repeat", "top_word", "line_bytes", "line_words", "shouted",
]

_CLASS = np.zeros(256, np.uint8)  # the kind of each byte: its place in _KINDS, from 1
_KINDS = ["upper", "digit", "space", "wide", "stop", "comma", "bang", "pipe", "symbol", "other_mark"]
for _i, _members in enumerate([
    range(ord("A"), ord("Z") + 1), range(ord("0"), ord("9") + 1), [0x20, *range(9, 14)], range(0x80, 0x100),
    b".", b",;:", b"!?", b"|", b"#$%&*+=<>@\\^_~`/{}[]", b"-'\"()",
]):
    _CLASS[list(_members)] = _i + 1


def text_features(column: pa.Array) -> np.ndarray:
    """One row of FEATURES for each text."""
    return np.concatenate([_features(d, o) for _, _, d, o in ta.chunks(column)] or [np.zeros((0, len(FEATURES)))])


def _per_row(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between offsets."""
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return total[offsets[1:]] - total[offsets[:-1]]


def _features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    size = np.diff(offsets).astype(float)
    kind = _CLASS[data]
    hashes, counts = ta.words(data, offsets)
    n = counts.astype(float)
    per_byte, per_word = np.maximum(size, 1), np.maximum(n, 1)
    share = {name: _per_row(kind == i + 1, offsets) for i, name in enumerate(_KINDS)}
    row = np.repeat(np.arange(len(counts)), counts)
    key = np.sort((row.astype(np.uint64) << np.uint64(40)) | (hashes >> np.uint64(24)))
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if key.size else np.empty(0, np.int64)
    times = np.diff(np.append(first, key.size))
    owner = (key[first] >> np.uint64(40)).astype(np.int64)
    distinct = np.bincount(owner, minlength=len(counts))
    top = np.zeros(len(counts))
    np.maximum.at(top, owner, times)
    same = np.zeros(len(hashes), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])
    repeat = np.bincount(row[same], minlength=len(counts))
    lines = _per_row(data == 10, offsets) + 1.0
    upper = kind == 1
    after = np.zeros(len(data), bool)
    after[1:] = upper[1:] & upper[:-1]
    after[offsets[:-1][np.diff(offsets) > 0]] = False  # what comes before a text is none of it
    out = {
        "log_bytes": np.log1p(size), "log_words": np.log1p(n), "word_bytes": (size - share["space"]) / per_word,
        **{name: share[name] / (per_byte if name in ("upper", "digit", "space", "wide") else per_word) for name in _KINDS},
        "distinct": distinct / per_word, "repeat": repeat / per_word, "top_word": top / per_word,
        "line_bytes": np.log1p(size / lines), "line_words": n / lines, "shouted": _per_row(after, offsets) / per_byte,
    }
    # a logarithm may differ in its last bit by its place in an array: a bin must not hang on it
    return np.round(np.stack([np.where(size > 0, out[name], 0.0) for name in FEATURES], axis=1), 10)


@dataclass
class Model:
    """Bin edges and lookup tables; ``base`` is the log odds without any feature."""

    base: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for f, (edges, values) in enumerate(zip(self.edges, self.tables)):
            total += values[np.searchsorted(edges, x[:, f], "right")]
        for (f, g), values in zip(self.pairs, self.pair_tables):
            total += values[np.searchsorted(self.pair_edges[f], x[:, f], "right"),
                            np.searchsorted(self.pair_edges[g], x[:, g], "right")]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.log_odds(x), -30, 30)))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    """Inner bin edges at quantiles of the distinct values' midpoints."""
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def _best_cut(grad: np.ndarray, hess: np.ndarray, rows: np.ndarray, low: int, high: int) -> tuple[float, int]:
    """(gain, cut) of the best split of the bins [low, high)."""
    if high - low < 2:
        return 0.0, low
    g, h, n = (np.cumsum(v[low:high]) for v in (grad, hess, rows))
    left, right = g[:-1] ** 2 / (h[:-1] + 1), (g[-1] - g[:-1]) ** 2 / (h[-1] - h[:-1] + 1)
    gain = left + right - g[-1] ** 2 / (h[-1] + 1)
    gain[(n[:-1] < MIN_ROWS) | (n[-1] - n[:-1] < MIN_ROWS)] = 0
    best = int(np.argmax(gain))
    return float(gain[best]), low + best + 1


def _tree(grad: np.ndarray, hess: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """A tree of up to SPLITS splits over bins: its value in every bin."""
    parts = [(0, len(grad))]
    for _ in range(SPLITS):
        found = [(*_best_cut(grad, hess, rows, a, b), k) for k, (a, b) in enumerate(parts)]
        gain, cut, k = max(found)
        if gain <= 1e-9:
            break
        a, b = parts[k]
        parts[k:k + 1] = [(a, cut), (cut, b)]
    out = np.zeros(len(grad))
    for a, b in parts:
        out[a:b] = grad[a:b].sum() / (hess[a:b].sum() + 1)
    return out


def _pair_tree(grad: np.ndarray, hess: np.ndarray, rows: np.ndarray) -> tuple[float, np.ndarray]:
    """(gain, values): one cut along the first axis, then one of each side along the second."""
    best = (0.0, np.zeros_like(grad))
    for cut in range(1, grad.shape[0]):
        gain, out = 0.0, np.zeros_like(grad)
        for side in (slice(0, cut), slice(cut, None)):
            g, h, n = (v[side].sum(axis=0) for v in (grad, hess, rows))
            _, mid = _best_cut(g, h, n, 0, len(g))
            for part in (slice(0, mid), slice(mid, None)):
                value = g[part].sum() / (h[part].sum() + 1)
                out[side, part] = value
                gain += value * g[part].sum()
        if gain > best[0]:
            best = (gain, out)
    return best


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Boost a model of ``y`` (0 or 1) by the features ``x``."""
    n, positive = len(y), float(y.sum())
    model = Model(float(np.log((positive + 1) / (n - positive + 1))))
    if positive in (0, n):
        return model
    features = range(x.shape[1])
    model.edges = [_edges(x[:, f], BINS) for f in features]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    bins = [np.searchsorted(e, x[:, f], "right") for f, e in enumerate(model.edges)]
    rows = [np.bincount(b, minlength=len(t)) for b, t in zip(bins, model.tables)]
    odds = np.full(n, model.base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-odds))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for f in features:
            grad, hess = slopes()
            size = len(model.tables[f])
            step = RATE * _tree(np.bincount(bins[f], grad, size), np.bincount(bins[f], hess, size), rows[f])
            model.tables[f] += step
            odds += step[bins[f]]

    model.pair_edges = [_edges(x[:, f], PAIR_BINS) for f in features]
    coarse = [np.searchsorted(e, x[:, f], "right") for f, e in enumerate(model.pair_edges)]

    def grid(f: int, g: int, *weights: np.ndarray | None) -> list[np.ndarray]:
        shape = (len(model.pair_edges[f]) + 1, len(model.pair_edges[g]) + 1)
        cell = coarse[f] * shape[1] + coarse[g]
        return [np.bincount(cell, w, shape[0] * shape[1]).reshape(shape) for w in weights]

    grad, hess = slopes()
    gains = {(f, g): _pair_tree(*grid(f, g, grad, hess, None))[0] for f in features for g in features if f < g}
    model.pairs = sorted(gains, key=gains.get)[::-1][:PAIRS]
    model.pair_tables = [np.zeros((len(model.pair_edges[f]) + 1, len(model.pair_edges[g]) + 1)) for f, g in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for k, (f, g) in enumerate(model.pairs):
            grad, hess = slopes()
            step = RATE * _pair_tree(*grid(f, g, grad, hess, None))[1]
            model.pair_tables[k] += step
            odds += step[coarse[f], coarse[g]]
    return model


def held_out(key, folds: int = 4, fold: int = 2):
    """Column: whether the row of this id is kept from training (NULL ids are not)."""
    return F.pmod(F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(0)), F.lit(folds)) == fold


def train(
    docs: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id", text: str = "text",
    max_rows: int = MAX_TRAIN_ROWS,
) -> Model:
    """Fit on at most ``max_rows`` labelled rows that are not held out.

    Documents that repeat an id and text count once.  If an id repeats with more texts than
    fit, each labelled id has one of them before any has a second.
    """
    usable = labels.filter(F.col(label).isNotNull() & F.col(key).isNotNull() & ~held_out(key))
    sample = (
        usable.select(F.col(key).alias("k"), F.col(label).alias("y"))
        .orderBy(F.xxhash64("k"), "k", "y").limit(max_rows)
        .groupBy("k", "y").agg(F.count("*").alias("n"))
    )
    digest = F.sha2(F.coalesce(F.col(text), F.lit("")), 256)
    rows = docs.select(key, text).join(F.broadcast(sample), F.col(key) == F.col("k")).select("k", text, "y", "n", digest.alias("d"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = text_features(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.string()), pa.array([r.tobytes() for r in x], pa.binary()),
                 batch.column(2).cast(pa.float64()), batch.column(3), batch.column(4)], names=["k", "x", "y", "n", "d"])

    found = rows.mapInArrow(run, "k string, x binary, y double, n long, d string")
    found = stored(found.groupBy("k", "y", "n", "d").agg(F.first("x").alias("x")), "labelled")
    least = found.groupBy("k", "y").agg(F.min("d").alias("d"), F.lit(0).alias("later"))  # max_rows at most
    ranked = found.join(F.broadcast(least), ["k", "y", "d"], "left").withColumn("later", F.coalesce("later", F.lit(1)))
    got = ranked.orderBy("later", F.xxhash64("k", "d", "y"), "k", "d", "y").limit(max_rows).select("k", "x", "y", "n").toPandas()
    got = got.loc[got.index.repeat(got["n"])].head(max_rows)  # a label that is given n times
    got = got.sort_values(["k", "x", "y"])  # the order in which tasks end must not matter
    x = np.frombuffer(b"".join(got["x"]), float).reshape(-1, len(FEATURES))
    return fit(x, (got["y"].to_numpy() > 0).astype(float))


def score(docs: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the probability of a good text."""
    [name] = fresh(docs, name)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # tables of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column(name, pa.array(sent.value.score(text_features(batch.column(text)))))

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))
