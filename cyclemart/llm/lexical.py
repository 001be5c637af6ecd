"""Ranked lexical search: the best documents for each item, by summed term weights.

Terms are maximal runs of ASCII letters, digits and characters beyond ASCII, with A-Z
lower-cased.  A document's score is the sum, over the item's terms, each once, of a weight
that falls with the documents that hold the term times a saturating function of the term's
occurrences and the document's length, all in 64-bit integers (see ``Weights``).

1. One pass over the texts finds the items' terms in them, by hash and then by bytes, and
   writes one small row a document: its length, the numbers of the terms and how often each
   occurs.  A second pass over these rows counts documents, terms and, for each term, the
   documents that hold it.
2. The rows are searched where they lie, some thousand documents at a time, as posting
   lists.  For each item the short lists are summed term at a time into accumulators.  These
   are then one iterator with a bound, its largest sum, beside the long lists with theirs.
   Document at a time, only documents of iterators that can still reach the threshold are
   taken (the 50th best score so far); the other lists are only skipped into, for the
   candidates left, largest bound first, and candidates that cannot reach it any more go.
3. A task gives the best of its documents for each item; the best of all come from a window
   that keeps the best of each partition before it shuffles.

No text and no posting is shuffled, and the items are the only data that every task gets:
they come in blocks of about ``BLOCK_TERMS`` (item, term) pairs, and each block is searched
against all documents.

Defined cases: NULL and empty texts have no terms; rows that repeat an item id (NULL counts
as one) are one item with the terms of them all; an item without terms, or whose terms no
document has, gives no rows; rows that repeat a document id are documents of their own; of
equal scores the smaller id is first, NULL last; texts of any length are read whole; empty
tables give no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from cyclemart.llm import textarrays as ta
from cyclemart.llm.common import stored
from cyclemart.llm.filter_audit import _places, span_hashes

BLOCK_TERMS = 500_000  # (item, term) pairs that are searched at a time
SHARD_POSTINGS = 2_000_000  # postings that a task holds as lists at a time
TASK_DOCUMENTS = 50_000  # documents that give one set of best ones, at least
SHORT_SHARE = 16  # lists of less than 1/16 of a shard's documents are summed at once

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_IN_TERM = np.zeros(256, bool)
_IN_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def term_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, length) of the terms of each row."""
    if not data.size:
        return (np.empty(0, np.int64),) * 3
    inside = _IN_TERM[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    filled = np.diff(offsets) > 0
    first, last = offsets[:-1][filled], offsets[1:][filled] - 1
    begins[first], ends[last] = inside[first], inside[last]
    starts = np.flatnonzero(begins)
    return np.searchsorted(offsets, starts, "right") - 1, starts, np.flatnonzero(ends) + 1 - starts


class TermTable:
    """The terms that are looked for, found by hash and confirmed by their bytes."""

    def __init__(self, terms: list[bytes]) -> None:
        self.data = np.frombuffer(b"".join(terms), np.uint8)
        lengths = np.array([len(t) for t in terms], np.int64)
        starts = np.cumsum(lengths) - lengths
        hashes = span_hashes(self.data, starts, lengths)
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.term, self.starts, self.lengths = hashes[order], order, starts[order], lengths[order]
        # terms that share a hash follow each other; a look-up goes through so many at most
        runs = np.flatnonzero(np.concatenate(([True], self.hashes[1:] != self.hashes[:-1], [True])))
        self.most = int(np.diff(runs).max()) if len(terms) else 0

    def find(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The number of each span's term; -1 for none."""
        found = np.full(len(starts), -1, np.int64)
        if not len(self.hashes) or not len(starts):
            return found
        hashes = span_hashes(data, starts, lengths)
        at = np.searchsorted(self.hashes, hashes, "left")
        for _ in range(self.most):
            here = np.flatnonzero((found < 0) & (at < len(self.hashes)))
            here = here[(self.hashes[at[here]] == hashes[here]) & (self.lengths[at[here]] == lengths[here])]
            if here.size:
                n, place = lengths[here], _places(lengths[here])
                equal = data[np.repeat(starts[here], n) + place] == self.data[np.repeat(self.starts[at[here]], n) + place]
                whole = np.logical_and.reduceat(equal, np.cumsum(n) - n)
                found[here[whole]] = self.term[at[here[whole]]]
            at = at + 1
        return found


class Weights:
    """The scoring formula, for given documents, their terms and the documents of each term."""

    def __init__(self, documents: int, terms: int, holding: np.ndarray) -> None:
        self.documents, self.terms = documents, terms
        self.weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(df) + 1))) for df in holding], np.int64)

    def length_parts(self, lengths: np.ndarray) -> np.ndarray:
        """m of documents of so many terms: 100 at the mean length, 50 of it fixed."""
        if not self.terms:
            return np.full(len(lengths), 50, np.int64)
        if len(lengths) and int(lengths.max()) * self.documents >= 1 << 57:  # beyond 64 bits
            return np.array([50 + 50 * n * self.documents // self.terms for n in lengths.tolist()], np.int64)
        return 50 + 50 * lengths * self.documents // self.terms

    def impacts(self, term: np.ndarray, times: np.ndarray, length_part: np.ndarray) -> np.ndarray:
        return self.weight[term] * ((1_000_000_000 * times) // (1000 * times + 20 * length_part))


# --- the rows that are searched ---------------------------------------------------------------
def _item_terms(items: DataFrame, key: str, text: str) -> DataFrame:
    """(item, term): the distinct terms of each item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, _, data, offsets in ta.chunks(batch.column(1)):
                data = _LOWER[data]
                row, starts, lengths = term_spans(data, offsets)
                whole = data.tobytes()
                terms = [whole[s:s + n] for s, n in zip(starts.tolist(), lengths.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row + first)), pa.array(terms, pa.binary())], names=["item", "term"])

    kind = items.schema[key].dataType.simpleString()
    return items.select(key, text).mapInArrow(run, f"item {kind}, term binary").distinct()


def _occurrences(docs: DataFrame, key: str, text: str, wanted: list[bytes]) -> DataFrame:
    """(k, n, terms, times) of every document: its length, and the numbers of the wanted terms
    in it with their occurrences, both as packed 32-bit integers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = TermTable(wanted)
        for batch in batches:
            for first, n, data, offsets in ta.chunks(batch.column(1)):
                data = _LOWER[data]
                row, starts, lengths = term_spans(data, offsets)
                term = table.find(data, starts, lengths)
                hit = term >= 0
                pair, times = np.unique((row[hit] << 32) | term[hit], return_counts=True)
                cut = np.searchsorted(pair, np.arange(n + 1, dtype=np.int64) << 32) * 4
                ids, often = (pair & 0xFFFFFFFF).astype(np.int32).tobytes(), times.astype(np.int32).tobytes()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, n), pa.array(np.bincount(row, minlength=n)),
                     *[pa.array([packed[a:b] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())], pa.binary()) for packed in (ids, often)]],
                    names=["k", "n", "terms", "times"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"k {kind}, n long, terms binary, times binary")


def _packed(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(integers of all rows, number of each row)."""
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), np.int32), np.array([len(r) // 4 for r in rows], np.int64)


def _statistics(rows: DataFrame, terms: int) -> tuple[int, int, np.ndarray]:
    """(documents with terms, all their terms, documents that hold each wanted term)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        holding, documents, length = np.zeros(terms, np.int64), 0, 0
        for batch in batches:
            holding += np.bincount(_packed(batch.column(1))[0], minlength=terms)
            n = batch.column(0).to_numpy()
            documents, length = documents + int((n > 0).sum()), length + int(n.sum())
        some = np.flatnonzero(holding)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(some, [-1, -2])), pa.array(np.append(holding[some], [documents, length]))], names=["term", "n"])

    summed = rows.select("n", "terms").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    found = {r.term: r.n for r in summed.toLocalIterator()}  # one row for each term of the block
    return found.get(-1, 0), found.get(-2, 0), np.array([found.get(i, 0) for i in range(terms)], np.int64)


# --- the search ---------------------------------------------------------------------------
class Shard:
    """Posting lists of some documents, with the impact of every posting."""

    def __init__(self, keys: pa.Array, lengths: np.ndarray, term: np.ndarray, times: np.ndarray, per: np.ndarray, weights: Weights) -> None:
        self.keys, self.documents = keys, len(keys)
        document = np.repeat(np.arange(len(keys)), per)
        impact = weights.impacts(term, times.astype(np.int64), weights.length_parts(lengths)[document])
        order = np.argsort(term, kind="stable")  # documents ascend within a term
        self.document, self.impact, term = document[order], impact[order], term[order]
        self.first = np.searchsorted(term, np.arange(len(weights.weight) + 1))
        self.largest = np.zeros(len(weights.weight), np.int64)
        some = np.flatnonzero(np.diff(self.first))
        if some.size:
            self.largest[some] = np.maximum.reduceat(self.impact, self.first[some])
        self.place: np.ndarray | None = None  # of each document in the order of the keys

    def postings(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.first[term], self.first[term + 1]
        return self.document[a:b], self.impact[a:b]

    def best(self, terms: np.ndarray, k: int, threshold: int) -> tuple[np.ndarray, np.ndarray]:
        """(document, score) of at least the ``k`` best documents that reach ``threshold``."""
        size = self.first[terms + 1] - self.first[terms]
        terms, size = terms[size > 0], size[size > 0]
        short = size * SHORT_SHARE < self.documents
        # term at a time: the short lists become one, of summed accumulators
        held = [self.postings(t) for t in terms[short].tolist()]
        sums = np.zeros(self.documents, np.int64)
        if held:
            met = np.bincount(np.concatenate([d for d, _ in held]), np.concatenate([x for _, x in held]), self.documents)
            sums = met.astype(np.int64)  # exact: far below 2 ** 53
        candidates = np.flatnonzero(sums)
        # document at a time: that list and the long ones, by bound
        long = terms[~short][np.argsort(-self.largest[terms[~short]], kind="stable")]
        bounds = self.largest[long]
        ahead = np.append(np.cumsum(bounds[::-1])[::-1], 0)  # what the lists from here on can add
        at = 0
        while at < len(long):
            threshold = max(threshold, self._kth(sums[candidates], k))
            if ahead[at] < threshold:
                break  # documents of the remaining lists alone cannot reach the threshold
            document, impact = self.postings(int(long[at]))
            sums[document] += impact
            at += 1
            candidates = np.flatnonzero(sums)
        scores = sums[candidates]
        for i in range(at, len(long)):  # skip to the candidates only
            threshold = max(threshold, self._kth(scores, k))
            alive = scores + ahead[i] >= threshold
            candidates, scores = candidates[alive], scores[alive]
            document, impact = self.postings(int(long[i]))
            to = np.minimum(np.searchsorted(document, candidates), len(document) - 1)
            scores = scores + np.where(document[to] == candidates, impact[to], 0)
        threshold = max(threshold, self._kth(scores, k), 1)
        return candidates[scores >= threshold], scores[scores >= threshold]

    @staticmethod
    def _kth(scores: np.ndarray, k: int) -> int:
        return int(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else 0

    def ordered(self, document: np.ndarray, score: np.ndarray, k: int) -> tuple[list, list[int]]:
        """(key, score) of the ``k`` best, ties by key, NULL last."""
        if self.place is None:
            order = pc.sort_indices(self.keys, null_placement="at_end").to_numpy()
            self.place = np.empty(self.documents, np.int64)
            self.place[order] = np.arange(self.documents)
        top = np.lexsort((self.place[document], -score))[:k]
        return self.keys.take(pa.array(document[top])).to_pylist(), score[top].tolist()


def _shards(batches: Iterator[pa.RecordBatch], weights: Weights) -> Iterator[Shard]:
    kept, postings = [], 0

    def shard() -> Shard:
        table = pa.Table.from_batches(kept).combine_chunks()
        columns = [table.column(i).combine_chunks() for i in range(4)]
        (term, per), (times, _) = _packed(columns[2]), _packed(columns[3])
        return Shard(columns[0], columns[1].to_numpy(), term, times, per, weights)

    for batch in batches:
        if not len(batch):
            continue
        kept.append(batch)
        postings += batch.column(2).nbytes // 4
        if postings >= SHARD_POSTINGS:
            yield shard()
            kept, postings = [], 0
    if kept:
        yield shard()


def _search(rows: DataFrame, items: list[tuple[object, np.ndarray]], weights: Weights, k: int, kind: T.DataType) -> DataFrame:
    """(item, k, score): of each task's documents the best for each item."""
    key = rows.schema["k"].dataType
    schema = T.StructType([T.StructField("item", kind), T.StructField("k", key), T.StructField("score", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple[int, object]]] = [[] for _ in items]
        kinds = None
        for shard in _shards(batches, weights):
            kinds = shard.keys.type
            for i, (_, terms) in enumerate(items):
                reached = best[i][-1][0] if len(best[i]) == k else 0
                keys, scores = shard.ordered(*shard.best(terms, k, reached), k)
                if keys:
                    best[i] = sorted([*best[i], *zip(scores, keys)], key=lambda x: (-x[0], x[1] is None, x[1] if x[1] is not None else 0))[:k]
        if kinds is None:
            return
        number = [i for i, found in enumerate(best) for _ in found]
        yield pa.RecordBatch.from_arrays(
            [pa.array([items[i][0] for i in number], to_arrow(kind)), pa.array([x[1] for found in best for x in found], kinds),
             pa.array([x[0] for found in best for x in found], pa.int64())], names=schema.names)

    from pyspark.sql.pandas.types import to_arrow_type as to_arrow

    return rows.mapInArrow(run, schema)


def rank_documents(
    docs: DataFrame, items: DataFrame, k: int = 50, key: str = "doc_id", text: str = "text",
    item_key: str = "item_id", item_text: str = "text", block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """(item_key, rank, key, score): the ``k`` highest-scoring documents of each item."""
    pairs = stored(_item_terms(items, item_key, item_text), "item-terms")
    kind = items.schema[item_key].dataType
    blocks = max(1, math.ceil(pairs.count() / block_terms))
    block = F.pmod(F.xxhash64(F.col("item").cast("string")), F.lit(blocks))
    found = None
    for b in range(blocks):
        of_item: dict[object, list[int]] = {}
        number: dict[bytes, int] = {}
        for r in pairs.filter(block == b).toLocalIterator():  # about block_terms short rows
            of_item.setdefault(r.item, []).append(number.setdefault(bytes(r.term), len(number)))
        rows = stored(_occurrences(docs, key, text, list(number)), "occurrences")
        documents, terms, holding = _statistics(rows, len(number))
        wanted = [(item, np.array(sorted(t), np.int64)) for item, t in of_item.items()]
        near = rows.coalesce(max(1, documents // TASK_DOCUMENTS))
        best = _search(near, wanted, Weights(documents, terms, holding), k, kind)
        found = best if found is None else found.union(best)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("k"))
    return (
        found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        .select(F.col("item").alias(item_key), "rank", F.col("k").alias(key), "score")
    )
