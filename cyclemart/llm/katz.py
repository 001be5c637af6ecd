"""Katz backoff language model of order two, trained and evaluated on Spark.

    P(w | h) = d(c) c(h, w) / c(h)        if c = c(h, w) > 0
             = alpha(h) P(w)              otherwise; P(w) itself if h was never seen
    P(w)     = d1(c) c(w) / N             if c = c(w) > 0
             = what the others leave      for a word that was never seen

The discounts ``d`` are Good-Turing's for counts up to ``CUTOFF``; ``alpha(h)`` is what the
discounts take from h, over the unigram mass of the words not seen after h, so the
probabilities after every history sum to one exactly.  A history without discounted counts
has one occurrence added, so that something is left.  Groups of copies bend the counts of
counts; where Turing's estimate of a count is no discount, a line fitted to them gives it
(simple Good-Turing).  Absolute discounting takes its place only where there is no such
line: no count of one, none of 2 to ``CUTOFF``, or counts of counts that do not fall faster
than 1/r.

Tokens are words (A-Z lower-cased) and one end per text; the first one's history is the
beginning.  Words are 64-bit hashes throughout.

1. Unigram counts: a partial count per task, then a grouped sum; stored as a table.
2. A bounded number of the most frequent words (``CODED``) is broadcast with counts; all
   other words get theirs from a join with the unigram table.
3. Every block of texts deals its pairs (history, word, training count, documents) over
   buckets by history, packed.  Frequent histories are dealt by history and word.  A pair
   that very many documents of a block have is dealt once, as if by a document of its own,
   and the block adds that document's figures to those that have the pair.
4. A bucket counts its pairs, which makes its part of the bigram table, and answers each
   block with sums per document: log counts, how many pairs had each discounted count, and
   the unseen pairs with what their history's weight needs.  All is written to the shared
   scratch space, partitioned by kind; ``bigram`` is the model's table.
5. With the counts of counts now known, each block adds up its documents' scores.

A block, and a bucket, is a bounded number of tokens, whatever one key holds.  The texts
are read three times and never shuffled.  ``docs`` must be a deterministic scan (such as a
read of files), because steps 3 and 2 number its blocks alike.

Defined cases: NULL and empty texts are one end token; a NULL key counts as the empty
text when rows are held out; rows that repeat a key are scored each; without training rows
every score is 0; an empty table gives no rows.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cyclemart.llm import textarrays as ta
from cyclemart.llm.common import stored
from cyclemart.session import scratch_path

CUTOFF = 5  # counts up to this are discounted
CODED = 1 << 19  # words that are broadcast, at most
BLOCK_TOKENS, BLOCK_ROWS = 1_200_000, 60_000
BUCKET_TOKENS = 2_000_000
MANY_DOCUMENTS = 256  # of a block: pairs that as many have are answered once
END, BEGIN = np.uint64((1 << 64) - 59), np.uint64((1 << 64) - 95)  # no word's code
PAIRS, DOCUMENTS, ANSWER, BIGRAM, STATISTIC = "pairs", "documents", "answer", "bigram", "statistic"
#: Keys of the statistics: r for the counts of counts, these for hot histories.
MASS, FEW = 100, 100  # FEW + r for r from 1 on


# --- packing ----------------------------------------------------------------------------
def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as compressed bytes, like bytes of neighbouring numbers side by side."""
    parts = []
    for a in arrays:
        if a.dtype.kind == "u" and a.size:  # the narrowest type that holds it
            a = a.astype(np.min_scalar_type(int(a.max())))
        planes = np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.dtype.itemsize).T
        parts.append(np.array([ord(a.dtype.char), a.size], np.int64).tobytes() + planes.tobytes())
    return zstandard.compress(b"".join(parts), 3)


def unpack(blob: bytes) -> list[np.ndarray]:
    data, at, out = zstandard.decompress(blob), 0, []
    while at < len(data):
        char, size = np.frombuffer(data, np.int64, 2, at)
        kind = np.dtype(chr(char))
        planes = np.frombuffer(data, np.uint8, size * kind.itemsize, at + 16).reshape(kind.itemsize, size)
        out.append(np.ascontiguousarray(planes.T).view(kind).ravel())
        at += 16 + size * kind.itemsize
    return out


# --- discounts --------------------------------------------------------------------------
def discounts(counts_of_counts: np.ndarray) -> np.ndarray:
    """d[0..CUTOFF] from n[1..CUTOFF + 1]; d[0] is 0 and counts beyond have discount 1.

    d = 1 - m (1 - r*/r) with the m that frees the mass of n[1] occurrences, as Katz has it.
    r* is Turing's (r + 1) n[r + 1] / n[r] up to some r, and beyond it the one of a line fitted
    to the counts of counts (simple Good-Turing): as few r as it takes for all d to be in (0, 1).
    """
    n = np.concatenate(([0.0], np.asarray(counts_of_counts, float)))
    r = np.arange(1, CUTOFF + 1)
    slope = _slope(n)
    if n[1] and n[2:-1].any() and slope < -1:
        fitted = (1 + 1 / r) ** (slope + 1)
        raw = (r + 1) * n[2:] / np.maximum(n[1:-1], 1) / r
        for own in range(CUTOFF, -1, -1):  # with none of Turing's, 0 < d < 1 always
            ratio = np.where(r <= own, raw, fitted)
            freed = (r * n[1:-1] * (1 - ratio)).sum()
            d = 1 - n[1] / freed * (1 - ratio) if freed > 0 else ratio - 1
            if (n[1:own + 2] > 0).all() and ((d > 0) & (d < 1)).all():
                return np.concatenate(([0.0], d))
    taken = n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] else 0.5
    return np.concatenate(([0.0], (r - taken) / r))


def _slope(n: np.ndarray) -> float:
    """Of the line through log n[r] over log r, each n[r] spread over the empty counts beside it."""
    [r] = np.nonzero(n)
    if len(r) < 2:
        return 0.0
    before, after = np.append(0, r[:-1]), np.append(r[1:], 2 * r[-1] - r[-2])
    return float(np.polyfit(np.log(r), np.log(2 * n[r] / (after - before)), 1)[0])


@dataclass(frozen=True)
class Unigrams:
    """What every task needs: totals, and the most frequent words by hash."""

    total: int
    distinct: int
    discount: np.ndarray
    left: float
    hashes: np.ndarray  # ascending
    codes: np.ndarray
    counts: np.ndarray  # by code, most frequent first
    ends: int
    buckets: int
    hot: int  # codes below this are dealt by history and word

    @property
    def whole(self) -> float:
        return self.total + (self.left == 0)

    def probability(self, count: np.ndarray) -> np.ndarray:
        """P(w) of words with these training counts."""
        scale = np.where(count <= CUTOFF, self.discount[np.minimum(count, CUTOFF)], 1.0)
        unseen = (self.left or 1.0) / self.whole
        return np.where(count > 0, scale * count / max(self.whole, 1), unseen)

    def code(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(identity, whether coded): the code of a frequent word, else its hash."""
        if not self.hashes.size:
            return words, np.zeros(len(words), bool)
        at = np.minimum(np.searchsorted(self.hashes, words), len(self.hashes) - 1)
        known = self.hashes[at] == words
        return np.where(known, self.codes[at], words), known

    def bucket(self, history: np.ndarray, word: np.ndarray) -> np.ndarray:
        split = self.is_hot(history)
        return (np.where(split, ta.combine(history, word), ta.mix(history)) % np.uint64(self.buckets)).astype(np.int64)

    def is_hot(self, history: np.ndarray) -> np.ndarray:
        return ((history < np.uint64(self.hot)) | (history == BEGIN)) & (self.buckets > 1)

    def history_count(self, history: np.ndarray) -> np.ndarray:
        """c(h) of hot histories."""
        coded = history < np.uint64(len(self.counts))
        at = np.where(coded, history, 0).astype(np.int64)
        counts = self.counts if len(self.counts) else np.zeros(1, np.int64)
        return np.where(history == BEGIN, self.ends, np.where(coded, counts[at], 0))


# --- texts to blocks --------------------------------------------------------------------
@dataclass
class Block:
    """Tokens of consecutive texts: word, history and document of each."""

    number: int
    keys: list[pa.Array]
    train: np.ndarray
    words: np.ndarray
    history: np.ndarray
    document: np.ndarray
    sizes: np.ndarray


def _block(number: int, parts: list[tuple]) -> Block:
    hashes, counts, train = (np.concatenate([p[i] for p in parts]) for i in range(3))
    size = counts + 1
    ends = np.cumsum(size) - 1
    words = np.empty(int(size.sum()), np.uint64)
    at_end = np.zeros(len(words), bool)
    at_end[ends] = True
    words[at_end], words[~at_end] = END, hashes
    history = np.empty_like(words)
    history[1:] = words[:-1]
    history[ends - counts] = BEGIN
    return Block(number, [p[3] for p in parts], train, words, history, np.repeat(np.arange(len(size)), size), size)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    """The blocks of a partition of (k, train, text), numbered alike whenever it is read."""
    parts, tokens, rows = [], 0, 0
    context = TaskContext.get()
    numbers = itertools.count((context.partitionId() if context else 0) << 32)
    for batch in batches:
        train = batch.column(1).to_numpy(False).astype(bool)
        for first, n, data, offsets in ta.chunks(batch.column(2)):
            hashes, counts = ta.words(data, offsets)
            if parts and (tokens + len(hashes) > BLOCK_TOKENS or rows + n > BLOCK_ROWS):
                yield _block(next(numbers), parts)
                parts, tokens, rows = [], 0, 0
            parts.append((hashes, counts, train[first:first + n], batch.column(0).slice(first, n)))
            tokens, rows = tokens + len(hashes) + n, rows + n
    if parts:
        yield _block(next(numbers), parts)


def _runs(*sorted_columns: np.ndarray) -> np.ndarray:
    """First index of each run of equal rows."""
    if not sorted_columns[0].size:
        return np.empty(0, np.int64)
    change = np.zeros(len(sorted_columns[0]), bool)
    change[0] = True
    for c in sorted_columns:
        change[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(change)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(w, c): training counts of the words of a partition, flushed when there are many."""
    words, counts = np.empty(0, np.uint64), np.empty(0, np.int64)

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(counts)], names=["w", "c"])

    for block in _blocks(batches):
        new, times = np.unique(block.words[block.train[block.document]], return_counts=True)
        both, n = np.concatenate((words, new)), np.concatenate((counts, times))
        order = np.argsort(both, kind="stable")
        both, n = both[order], n[order]
        first = _runs(both)
        words, counts = both[first], np.add.reduceat(n, first) if first.size else n
        if len(words) > 2_000_000:
            yield out()
            words, counts = words[:0], counts[:0]
    if len(words):
        yield out()


# --- pairs to buckets -------------------------------------------------------------------
def _grouped(bucket: np.ndarray, history: np.ndarray, word: np.ndarray, document: np.ndarray) -> tuple:
    """The distinct (bucket, history, word, document), in that order, and their occurrences.

    ``document`` ascends in the input and the sort is stable."""
    order = np.lexsort((word, history, bucket))
    history, word, document, bucket = history[order], word[order], document[order], bucket[order]
    first = _runs(history, word, document)
    return bucket[first], history[first], word[first], document[first], np.diff(np.append(first, len(order)))


def _unsigned(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64)


def _deal_coded(model: Unigrams, block: Block) -> Iterator[tuple[int, int, str, bytes]]:
    """(bucket, block, kind, blob): the pairs whose word is coded, and the documents."""
    word, known = model.code(block.words)
    history, _ = model.code(block.history)
    counts = np.zeros(len(word), np.int64)
    counts[known] = model.counts[word[known].astype(np.int64)]
    rows = len(block.sizes)
    base = np.bincount(block.document, np.where(known, np.log10(counts + 1.0), 0), rows)
    seen = np.bincount(block.document, known & (counts > 0), rows)

    word, history, document = word[known], history[known], block.document[known]
    bucket, history, word, document, times = _grouped(model.bucket(history, word), history, word, document)
    pair = _runs(history, word)
    sizes = np.diff(np.append(pair, len(word)))
    train = np.add.reduceat(block.train[document] * times, pair) if pair.size else pair
    many = sizes > MANY_DOCUMENTS
    in_many = np.repeat(many, sizes)
    # a pair of many documents is one entry, of an extra document for that pair
    extra = rows + np.cumsum(many) - 1
    later = (np.repeat(extra, sizes)[in_many], document[in_many], times[in_many])
    keep = ~in_many
    keep[pair] = True
    document, times = np.where(in_many, np.repeat(extra, sizes), document)[keep], np.where(in_many, 1, times)[keep]
    sizes = np.where(many, 1, sizes)
    starts = np.cumsum(sizes) - sizes

    sink = pa.BufferOutputStream()
    keys = pa.RecordBatch.from_arrays([pa.concat_arrays(block.keys)], names=["k"])
    with pa.ipc.new_stream(sink, keys.schema) as writer:
        writer.write_batch(keys)
    yield block.number % model.buckets, block.number, DOCUMENTS, pack(
        block.train.astype(np.uint8), _unsigned(block.sizes), _unsigned(seen), base, *map(_unsigned, later),
        np.frombuffer(sink.getvalue(), np.uint8))
    edges = _runs(bucket[pair])
    for first, end in zip(edges, np.append(edges[1:], len(pair))):
        h, w = history[pair[first:end]], word[pair[first:end]]
        inside = slice(starts[first], starts[end - 1] + sizes[end - 1])
        heads = _runs(h)
        yield int(bucket[pair[first]]), block.number, PAIRS, pack(
            h[heads], _unsigned(np.diff(np.append(heads, len(h)))), w, _unsigned(train[first:end]),
            _unsigned(sizes[first:end]), _unsigned(document[inside]), _unsigned(times[inside]))


def _rare_rows(model: Unigrams, block: Block) -> pa.RecordBatch:
    """(w, h, block, doc, n, t, bucket): the pairs whose word is not coded, per document."""
    word, known = model.code(block.words)
    history, _ = model.code(block.history)
    rare = ~known
    word, history, document = word[rare], history[rare], block.document[rare]
    bucket, history, word, document, times = _grouped(model.bucket(history, word), history, word, document)
    return pa.RecordBatch.from_arrays(
        [pa.array(word.view(np.int64)), pa.array(history.view(np.int64)), pa.array(np.full(len(word), block.number)),
         pa.array(document.astype(np.int32)), pa.array(times.astype(np.int32)),
         pa.array((block.train[document] * times).astype(np.int32)), pa.array(bucket.astype(np.int32))],
        names=["w", "h", "block", "doc", "n", "t", "bucket"])


# --- buckets ----------------------------------------------------------------------------
def _pairs_of(blobs: list[tuple[int, bytes]], rare: dict[str, np.ndarray]) -> tuple:
    """(h, w, train, number of coded ones) of all that was dealt to a bucket, and for every
    block its (pair, document, occurrences)."""
    h, w, t, entries, base = [], [], [], [], 0
    for number, blob in blobs:
        heads, lengths, word, train, size, document, times = unpack(blob)
        h.append(np.repeat(_unsigned(heads), lengths.astype(np.int64)))
        w.append(_unsigned(word))
        t.append(train.astype(np.int64))
        pair = np.repeat(np.arange(base, base + len(word)), size.astype(np.int64))
        entries.append((number, pair, document.astype(np.int64), times.astype(np.int64)))
        base += len(word)
    if len(rare["w"]):
        h, w, t = [*h, rare["h"]], [*w, rare["w"]], [*t, rare["t"]]
        starts = _runs(rare["block"])
        for a, b in zip(starts, np.append(starts[1:], len(rare["w"]))):
            entries.append((int(rare["block"][a]), np.arange(base + a, base + b), rare["doc"][a:b], rare["n"][a:b]))
    return np.concatenate(h), np.concatenate(w), np.concatenate(t), base, entries


def _answers(model: Unigrams, bucket: int, blobs: list[tuple[int, bytes]], rare: dict[str, np.ndarray]) -> Iterator[tuple]:
    """(block, kind, key, value, blob) of a bucket: its table, its statistics, and one
    answer to each block that dealt it pairs.  ``rare`` is in the order of its blocks."""
    h, w, t, coded, entries = _pairs_of(blobs, rare)
    word_count = np.concatenate((model.counts[w[:coded].astype(np.int64)], rare["c"]))

    # counts of pairs, and what is needed of every history
    order = np.lexsort((w, h))
    first = _runs(h[order], w[order])
    which = np.empty(len(order), np.int64)
    which[order] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(order))))
    count = np.add.reduceat(t[order], first)
    lead = order[first]
    pair_h, pair_w = h[lead], w[lead]
    heads = _runs(pair_h)
    head_of = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(pair_h))))
    head_id = pair_h[heads]
    mass = np.bincount(head_of, np.where(count > 0, model.probability(word_count[lead]), 0), len(heads))
    few = np.stack([np.bincount(head_of, count == r, len(heads)) for r in range(1, CUTOFF + 1)], axis=1)
    hot = model.is_hot(head_id)
    total = np.bincount(head_of, count, len(heads)).astype(np.int64)
    total = np.where(hot, model.history_count(head_id), total)

    for r in range(1, CUTOFF + 2):
        yield 0, STATISTIC, r, float((count == r).sum()), None
    for i in np.flatnonzero(hot):
        name = int(head_id[i:i + 1].view(np.int64)[0])
        yield name, STATISTIC, MASS, float(mass[i]), None
        for r in np.flatnonzero(few[i]):
            yield name, STATISTIC, FEW + 1 + int(r), float(few[i, r]), None
    kept = count > 0
    if kept.any():
        starts = _runs(pair_h[kept])
        lengths = np.diff(np.append(starts, kept.sum()))
        yield bucket, BIGRAM, len(starts), float(kept.sum()), pack(
            pair_h[kept][starts], _unsigned(lengths), pair_w[kept], _unsigned(count[kept]))

    undiscounted = few.sum(axis=1) == 0
    log_total = np.log10(np.maximum(total + (undiscounted & ~hot), 1))
    by_block: dict[int, list[tuple]] = {}
    for number, *entry in entries:
        by_block.setdefault(number, []).append(entry)
    for number, some in by_block.items():
        pair, document, times = (np.concatenate(x) for x in zip(*some))
        rows = int(document.max()) + 1
        c, head = count[which[pair]], head_of[which[pair]]
        seen, is_rare = c > 0, pair >= coded
        gain = np.where(seen, np.log10(np.maximum(c, 1)) - log_total[head], np.log10(model.probability(word_count[pair])))
        low = [np.bincount(document, times * (c == r), rows) for r in range(1, CUTOFF + 1)]
        known = np.bincount(document, times * (is_rare & (word_count[pair] > 0)), rows)
        base = np.bincount(document, np.where(is_rare, times * np.log10(word_count[pair] + 1.0), 0), rows)
        # an unseen pair needs its history's weight; one seen after a hot history that has
        # no discounted count here may need a correction
        event = (~seen & (total[head] > 0)) | (seen & (hot & undiscounted)[head])
        used, place = np.unique(head[event], return_inverse=True)
        yield number, ANSWER, bucket, 0.0, pack(
            np.bincount(document, times * gain, rows), base, _unsigned(known), *map(_unsigned, low),
            _unsigned(document[event]), _unsigned(times[event] * 2 + seen[event]), _unsigned(place), head_id[used],
            hot[used].astype(np.uint8), _unsigned(total[used]), mass[used], _unsigned(few[used].ravel()))


# --- scores -----------------------------------------------------------------------------
@dataclass(frozen=True)
class Weights:
    """The bigram discounts, and the mass and counts of counts of hot histories."""

    discount: np.ndarray
    hot: dict[int, np.ndarray]  # history: seen mass, then how many pairs occur 1, 2, ... times

    def of(self, total: np.ndarray, mass: np.ndarray, few: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(log10 alpha, log10 of what corrects seen pairs) of histories."""
        none = few.sum(axis=1) == 0
        left = np.where(none, 1.0, few @ ((1 - self.discount[1:]) * np.arange(1, CUTOFF + 1)))
        whole = total + none
        return np.log10(left / whole) - np.log10(1 - mass), np.log10(total / whole)


def _total(model: Unigrams, weights: Weights, documents: bytes, answers: list[tuple[int, bytes]]) -> tuple:
    """(keys, train, tokens, known, base, score) of a block from all that was sent to it."""
    train, sizes, known, base, extra, document, times, keys = unpack(documents)
    rows, known, base = len(sizes), known.astype(np.int64), base.astype(float)
    whole = max(rows, int(extra.max(initial=0)) + 1)  # with the documents of pairs that many have
    score = np.zeros(whole)
    low = np.zeros((whole, CUTOFF))
    for _, answer in sorted(answers):
        part, more, seen, *rest = unpack(answer)
        few_low, (doc, packed, place, head_id, hot, total, mass, few) = rest[:CUTOFF], rest[CUTOFF:]
        n = len(part)
        score[:n] += part
        base[:min(n, rows)] += more[:rows]
        known[:min(n, rows)] += seen[:rows].astype(np.int64)
        for r, x in enumerate(few_low):
            low[:n, r] += x
        if doc.size:
            mass, few = mass.copy(), few.astype(float).reshape(-1, CUTOFF)
            for i in np.flatnonzero(hot):
                mass[i], *few[i] = weights.hot[int(_unsigned(head_id[i:i + 1]).view(np.int64)[0])]
            alpha, correction = weights.of(total.astype(float), mass, few)
            place, packed = place.astype(np.int64), packed.astype(np.int64)
            change = np.where(packed % 2 == 1, correction[place], alpha[place]) * (packed // 2)
            score += np.bincount(doc.astype(np.int64), change, whole)
    score += low @ np.log10(weights.discount[1:])
    score, shared = score[:rows], score
    if extra.size:
        score = score + np.bincount(document.astype(np.int64), times * shared[extra.astype(np.int64)], rows)
    size = sizes.astype(np.int64)
    base = base - size * math.log10(model.total + model.distinct + 1)
    with pa.ipc.open_stream(keys.tobytes()) as reader:
        key = reader.read_all().column(0).combine_chunks()
    return key, train.astype(bool), size, known, base, score


def held_out(key: str, folds: int = 7, fold: int = 2) -> Column:
    """Whether the row of this key is kept from training."""
    return F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), F.lit(folds)) == fold


def unigrams(rows: DataFrame) -> tuple[Unigrams, DataFrame]:
    """The unigram table (w, c), stored, and what every task needs of it."""
    counted = rows.mapInArrow(_count_words, "w long, c long").groupBy("w").agg(F.sum("c").alias("c"))
    counted = stored(counted, "unigrams")
    of = [F.sum(F.when(F.col("c") == r, 1).otherwise(0)).alias(f"n{r}") for r in range(1, CUTOFF + 2)]
    got = counted.agg(F.sum("c").alias("total"), F.count("*").alias("distinct"), *of).first()
    total = got["total"] or 0
    n = np.array([got[f"n{r}"] or 0 for r in range(1, CUTOFF + 2)], float)
    d = discounts(n)
    r = np.arange(1, CUTOFF + 1)
    level = F.floor(F.log2("c") * 16)  # the frequent words: whole levels of counts, at most CODED
    sizes = sorted(map(tuple, counted.groupBy(level.alias("l")).count().collect()), reverse=True)
    chosen = [x for x, n_words in zip(sizes, itertools.accumulate(s[1] for s in sizes)) if n_words <= CODED]
    frequent = counted.filter(level >= (chosen[-1][0] if chosen else 1 << 20)).toPandas().sort_values(["c", "w"], ascending=False)
    hashes, counts = frequent["w"].to_numpy(np.int64).view(np.uint64), frequent["c"].to_numpy(np.int64)
    order = np.argsort(hashes)
    ends = counted.filter(F.col("w") == int(np.array([END]).view(np.int64)[0])).first()
    buckets = max(1, math.ceil(total * 7 / 6 / BUCKET_TOKENS))
    return Unigrams(
        total, got["distinct"], d, float(((1 - d[1:]) * r * n[:-1]).sum()), hashes[order], order.astype(np.uint64), counts,
        ends["c"] if ends else 0, buckets, int((counts >= BUCKET_TOKENS / 16).sum())), counted


def _of_bucket(model) -> object:
    """The function of a bucket: (pairs and documents, rare rows) to answers and the rest."""
    def run(dealt: pa.Table, rare: pa.Table) -> pa.Table:
        kinds, blocks, blobs = (dealt.column(c).to_pylist() for c in ("kind", "block", "blob"))
        out = [(n, DOCUMENTS, 0, 0.0, b) for k, n, b in zip(kinds, blocks, blobs) if k == DOCUMENTS]
        mine = sorted((n, b) for k, n, b in zip(kinds, blocks, blobs) if k == PAIRS)
        rare = rare.sort_by([("block", "ascending"), ("doc", "ascending"), ("h", "ascending"), ("w", "ascending")])
        columns = {c: np.asarray(rare.column(c)).astype(np.int64) for c in ("w", "h", "block", "doc", "n", "t", "c")}
        columns |= {c: columns[c].view(np.uint64) for c in ("w", "h")}
        if mine or len(rare):
            bucket = (dealt if len(dealt) else rare).column("bucket")[0].as_py()
            out += _answers(model.value, bucket, mine, columns)
        return pa.Table.from_arrays(
            [pa.array(x, t) for x, t in zip(zip(*out) if out else [[]] * 5, [pa.int64(), pa.string(), pa.int64(), pa.float64(), pa.binary()])],
            names=["block", "kind", "key", "value", "blob"])

    return run


@dataclass(frozen=True)
class Katz:
    """A trained model's tables, and the scores of the documents it was given."""

    unigram: DataFrame  # w, c
    bigram: DataFrame  # block (the bucket), key (histories), value (pairs), blob
    scores: DataFrame
    weights: Weights
    totals: Unigrams


def train_and_score(docs: DataFrame, held: Column, key: str = "doc_id", text: str = "text") -> Katz:
    """Train on the rows of ``docs`` that are not ``held`` and score all of them.

    ``scores`` has (key, held_out, n_tokens, n_known, train_tokens, base_score, score).
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("k"), (~held).alias("train"), F.col(text).alias("text"))
    totals, counted = unigrams(rows)
    model = spark.sparkContext.broadcast(totals)  # CODED words at most

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            bucket, number, kind, blob = zip(*_deal_coded(model.value, block))
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket, pa.int32()), pa.array(number, pa.int64()), pa.array(kind, pa.string()), pa.array(blob, pa.binary())],
                names=["bucket", "block", "kind", "blob"])

    def rare_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            yield _rare_rows(model.value, block)

    dealt = rows.mapInArrow(deal, "bucket int, block long, kind string, blob binary")
    rare = (
        rows.mapInArrow(rare_rows, "w long, h long, block long, doc int, n int, t int, bucket int")
        .join(counted, "w", "left").withColumn("c", F.coalesce("c", F.lit(0).cast("long")))
    )
    path = scratch_path(spark, "katz")
    (
        dealt.groupBy("bucket").cogroup(rare.groupBy("bucket"))
        .applyInArrow(_of_bucket(model), "block long, kind string, key long, value double, blob binary")
        .write.option("compression", "zstd").partitionBy("kind").parquet(path)
    )
    answered = spark.read.schema("block long, key long, value double, blob binary, kind string").parquet(path)
    figures = answered.filter(F.col("kind") == STATISTIC).groupBy("block", "key").agg(F.sum("value").alias("v")).collect()
    hot: dict[int, np.ndarray] = {}
    for f in figures:
        if f["key"] >= MASS:
            hot.setdefault(f["block"], np.zeros(CUTOFF + 1))[f["key"] - MASS] = f["v"]
    n = {f["key"]: f["v"] for f in figures if f["key"] < MASS}
    weights = Weights(discounts(np.array([n.get(r, 0.0) for r in range(1, CUTOFF + 2)])), hot)
    level = spark.sparkContext.broadcast(weights)  # at most CODED histories

    def total(block: pa.Table) -> pa.Table:
        kinds, buckets, blobs = (block.column(c).to_pylist() for c in ("kind", "key", "blob"))
        [documents] = [b for k, b in zip(kinds, blobs) if k == DOCUMENTS]
        answers = [(n, b) for k, n, b in zip(kinds, buckets, blobs) if k == ANSWER]
        k, train, size, known, base, score = _total(model.value, level.value, documents, answers)
        return pa.Table.from_arrays(
            [k, pa.array(~train), pa.array(size), pa.array(known), pa.array(np.full(len(k), totals_of)), pa.array(base), pa.array(score)],
            names=["k", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    totals_of = totals.total
    kind = docs.schema[key].dataType.simpleString()
    scores = (
        answered.filter(F.col("kind").isin(DOCUMENTS, ANSWER)).groupBy("block")
        .applyInArrow(total, f"k {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
        .withColumnRenamed("k", key)
    )
    return Katz(counted, answered.filter(F.col("kind") == BIGRAM).drop("kind"), scores, weights, totals)


def bigram_rows(model: Katz) -> DataFrame:
    """(h, w, c): the bigram table unpacked; coded words and histories are their codes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column(0):
                heads, lengths, words, counts = unpack(blob.as_py())
                h = np.repeat(_unsigned(heads), lengths.astype(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), pa.array(_unsigned(words).view(np.int64)), pa.array(counts.astype(np.int64))],
                    names=["h", "w", "c"])

    return model.bigram.select("blob").mapInArrow(run, "h long, w long, c long")
