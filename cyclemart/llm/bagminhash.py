"""Near-duplicate classes of documents by BagMinHash over weighted word shingles.

A document is the multiset of its five-word shingles.  Its signature comes from Poisson
processes over the discretised weight axis (Ertl 2018): the axis is cut into the blocks
[0, 1), [1, 2), [2, 4), [4, 8), ...; every (shingle, block) has its own process, drawn
from a hash, whose points carry a register and a level within the block.  A document with
weight w of the shingle sees the points below level w.  A register keeps its smallest
point, so two documents agree in a register with the probability of their weighted
Jaccard similarity.  Points are drawn in ascending order and a process stops once it has
passed the largest register, which makes a signature cost about as much as its shingles.

1. Equal texts collapse to one (by digest); only different texts go on.
2. Signatures are cut into ``BANDS`` bands of ``ROWS`` registers; texts that share a band
   meet in a bucket.
3. Buckets of up to ``SMALL`` members are compared completely.  Larger ones compare their
   members with up to ``HUBS`` of them, drawn anew for every bucket.
4. Pairs whose signatures agree enough are verified by exact multiset overlap of the whole
   texts; verified links join texts into components.
5. Larger buckets whose members are still in several components compare them with the
   ``HUBS`` members that have the most links so far, and verify again: in a group of copies
   that is where the original shows.
6. What members of different components are left in a bucket is compared block by block,
   by signature and then by text, inside the task: only links that connect leave it.  So the
   buckets are searched wholly.  A member is copied once for every block of its bucket, so
   the copies of what is left grow with its square divided by BLOCK.

A link is a multiset Jaccard similarity of at least ``THRESHOLD``; a class is a connected
component of links.  Its id is the smallest id in it.

Defined cases: words are split at ASCII white space, A-Z lower-cased; texts of one to four
words are near duplicates only of equal texts; texts without words (NULL, empty, blank)
are each a class of their own; rows that repeat an id with different texts are different
documents; a NULL id is larger than any other; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclemart.llm import textarrays as ta
from cyclemart.llm.common import broadcast_if_small, few_tasks, fresh, stored, text_key
from cyclemart.llm.components import components, joined_further

WIDTH, THRESHOLD = 5, 0.8
REGISTERS, BANDS, ROWS = 128, 25, 5
SMALL, HUBS = 5, 2
#: Signatures of a pair at the threshold agree in 0.8 +- 0.035 of the registers.
LIKELY = 0.68
#: Members of a large bucket that are compared as one block.
BLOCK = 256
#: Signatures, pairs of them, pairs of texts and texts that are worth a task.
TASK_SIGNATURES, TASK_PAIRS, TASK_VERIFIED, TASK_TEXTS = 20_000, 100_000, 2_000, 5_000

TICKS = 2.0 ** 40
_STEP = np.uint64(0xD1B54A32D192ED03)  # odd: tells the points of a process apart
_LOW48 = np.uint64((1 << 48) - 1)


def weighted(shingles: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, 48-bit shingle, weight) of the distinct shingles of each row, in order."""
    row = np.repeat(np.arange(len(counts), dtype=np.uint64), counts)
    both = np.sort((row << np.uint64(48)) | (shingles >> np.uint64(16)))
    first = np.flatnonzero(np.concatenate(([True], both[1:] != both[:-1]))) if both.size else np.empty(0, np.int64)
    weight = np.diff(np.append(first, both.size))
    both = both[first]
    return (both >> np.uint64(48)).astype(np.int64), both & _LOW48, weight


def signatures(row: np.ndarray, shingle: np.ndarray, weight: np.ndarray, rows: int) -> np.ndarray:
    """The registers (rows x REGISTERS): the smallest points, as multiples of 1 / TICKS, whose
    sums do not depend on how many points are drawn at a time."""
    least = np.full(rows * REGISTERS, np.iinfo(np.int64).max)
    parts, low, high = [], 0, 1
    live = np.arange(len(row))
    while live.size:  # one process for each block of the weight axis that a weight reaches
        parts.append((row[live], ta.combine(shingle[live], np.uint64(low)), weight[live],
                      np.full(live.size, low), np.full(live.size, high - low)))
        low, high = high, high * 2
        live = live[weight[live] > low]
    if not parts:
        return least.reshape(rows, REGISTERS).view(np.uint64)
    at, state, top, base, span = (np.concatenate(p) for p in zip(*parts))
    time = np.zeros(len(at), np.int64)
    drawn = 0
    while at.size:
        points = 1 if at.size > 20_000 else 8 if at.size > 500 else 64
        draw = ta.mix(state[:, None] + np.arange(drawn + 1, drawn + points + 1, dtype=np.uint64) * _STEP)
        more = ta.mix(draw)
        gap = -np.log1p(-(draw >> np.uint64(11)).astype(np.float64) * 2.0 ** -53) / span[:, None]
        gap = (gap * TICKS).astype(np.int64)
        when = time[:, None] + np.cumsum(gap, axis=1)
        level = base[:, None] + ((more >> np.uint64(32)).astype(np.float64) * 2.0 ** -32 * span[:, None]).astype(np.int64)
        register = (more & np.uint64(REGISTERS - 1)).astype(np.int64)
        seen = level < top[:, None]
        np.minimum.at(least, (at[:, None] * REGISTERS + register)[seen], when[seen])
        time, drawn = when[:, -1], drawn + points
        largest = least.reshape(rows, REGISTERS).max(axis=1)
        stay = time <= largest[at]
        at, state, top, base, span, time = (x[stay] for x in (at, state, top, base, span, time))
    return least.reshape(rows, REGISTERS).view(np.uint64)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(k, t, text) to (k, t, words, sig): 16 bits of every register, NULL without shingles."""
    for batch in batches:
        for first, n, data, offsets in ta.chunks(batch.column(2)):
            hashes, counts = ta.words(data, offsets)
            runs, sizes = ta.shingles(hashes, counts, WIDTH)
            sig = ta.mix(signatures(*weighted(runs, sizes), n)).astype(np.uint16)
            packed = [sig[i].tobytes() if sizes[i] else None for i in range(n)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(first, n), batch.column(1).slice(first, n),
                 pa.array(counts.astype(np.int64)), pa.array(packed, pa.binary())],
                names=["k", "t", "words", "sig"])


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(t, sig) to one (bucket, t) for each band."""
    for batch in batches:
        sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(-1, REGISTERS).astype(np.uint64)
        for band in range(BANDS):
            key = np.full(len(sig), band, np.uint64)
            for r in range(ROWS):
                key = ta.combine(key, sig[:, band * ROWS + r])
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), batch.column(0)], names=["bucket", "t"])


def _likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, sig_a, sig_b) to the (a, b) whose signatures agree enough."""
    for batch in batches:
        one, two = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, REGISTERS) for c in (2, 3))
        keep = pa.array((one == two).mean(axis=1) >= LIKELY)
        yield pa.RecordBatch.from_arrays([batch.column(c).filter(keep) for c in (0, 1)], names=["a", "b"])


def multiset_jaccard(one: pa.Array, two: pa.Array) -> np.ndarray:
    """Exact weighted Jaccard similarity of the shingle multisets of two text columns."""
    sides = []
    for column in (one, two):
        found = [(ta.shingles(*ta.words(data, offsets), WIDTH)) for _, _, data, offsets in ta.chunks(column)]
        runs, sizes = (np.concatenate(x) for x in zip(*found))
        row, shingle, weight = weighted(runs, sizes)
        sides.append(((row.astype(np.uint64) << np.uint64(48)) | shingle, weight, sizes))
    (a, wa, na), (b, wb, nb) = sides
    _, ia, ib = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    shared = np.bincount((a[ia] >> np.uint64(48)).astype(np.int64), np.minimum(wa[ia], wb[ib]), len(one))
    total = na + nb - shared
    return np.divide(shared, total, out=np.zeros(len(one)), where=total > 0)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, text_a, text_b) to the (a, b, similarity) that are links."""
    for batch in batches:
        for first in range(0, len(batch), 128):
            rows = batch.slice(first, 128)
            similarity = multiset_jaccard(rows.column(2), rows.column(3))
            keep = pa.array(similarity >= THRESHOLD)
            yield pa.RecordBatch.from_arrays(
                [rows.column(0).filter(keep), rows.column(1).filter(keep), pa.array(similarity).filter(keep)],
                names=["a", "b", "similarity"])


def _across(members: pd.DataFrame) -> pd.DataFrame:
    """Links that connect different components among the one or two blocks of a group.

    Members are compared by signature; likely pairs that nothing connects yet are verified
    by their texts.  A pair that shares several bands is left to the bucket of the first.
    """
    sig = np.frombuffer(b"".join(members["sig"]), np.uint16).reshape(-1, REGISTERS)
    banded = sig[:, :BANDS * ROWS].reshape(-1, BANDS, ROWS)
    here = int(np.argmax((banded == banded[0]).all(axis=(0, 2))))  # the band all members share
    node, text = members["t"].to_numpy(object), members["text"].to_numpy(object)
    component = pd.factorize(members["component"])[0]
    low = np.flatnonzero(members["block"].to_numpy() == members["block_a"].to_numpy())
    high = np.flatnonzero(members["block"].to_numpy() == members["block_b"].to_numpy())
    found = []
    for i in low:
        other = high[component[high] != component[i]]
        alike = (sig[other] == sig[i]).mean(axis=1)
        other = other[np.argsort(-alike, kind="stable")][:int((alike >= LIKELY).sum())]
        other = other[np.argmax((banded[other] == banded[i]).all(axis=2), axis=1) == here] if other.size else other
        for first in range(0, len(other), 16):  # the most alike first
            some = other[first:first + 16]
            some = some[component[some] != component[i]]
            if not some.size:
                continue
            similar = multiset_jaccard(pa.array([text[i]] * len(some)), pa.array(list(text[some]))) >= THRESHOLD
            for j in some[similar]:
                if component[j] != component[i]:
                    found.append((min(node[i], node[j]), max(node[i], node[j])))
                    component[component == component[j]] = component[i]
    return pd.DataFrame(found, columns=["a", "b"])


def _links(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Verify (a, b) pairs of text digests by their whole texts."""
    met = (
        pairs.join(texts.toDF("a", "text_a"), "a").join(texts.toDF("b", "text_b"), "b")
        .select("a", "b", "text_a", "text_b")
    )
    return met.mapInArrow(_verify, "a binary, b binary, similarity double")


def _ordered(a: str, b: str):
    return F.least(a, b).alias("a"), F.greatest(a, b).alias("b")


def linked_texts(signed: DataFrame, rows: DataFrame) -> DataFrame:
    """(node, component) of the digests of texts that are linked to others; the module's
    steps 2 to 6.  ``signed`` is (k, t, words, sig), ``rows`` (k, t, text)."""
    most = signed.count()
    different = stored(few_tasks(
        signed.filter(F.col("sig").isNotNull()).groupBy("t").agg(F.first("sig").alias("sig"), F.min("k").alias("k")),
        most, TASK_SIGNATURES), "texts")
    sig = different.select("t", "sig")
    banded = sig.mapInArrow(_bands, "bucket long, t binary")
    shared = banded.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    members = stored(few_tasks(banded.join(shared, "bucket"), BANDS * most), "buckets")
    small = members.filter(F.col("n") <= SMALL).select("bucket", "t")
    large = members.filter(F.col("n") > SMALL)
    placings = members.count()  # a small bucket gives at most two pairs a member, a large one HUBS

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        likely = stored(few_tasks(
            pairs.join(sig.toDF("a", "sig_a"), "a").join(sig.toDF("b", "sig_b"), "b")
            .select("a", "b", "sig_a", "sig_b").mapInArrow(_likely, "a binary, b binary"),
            max(HUBS, SMALL // 2) * placings, TASK_PAIRS), f"likely-{name}")
        found = likely.count()
        texts = _texts(likely, different, rows, 2 * found)
        return stored(few_tasks(_links(likely, texts), found, TASK_VERIFIED), f"links-{name}")

    whole = small.join(small.toDF("bucket", "hub"), "bucket").filter(F.col("t") < F.col("hub")).select("t", "hub")
    drawn = _with_hubs(large.select("bucket", "t", F.lit(0).alias("score"))).select("t", "hub")
    links = verified(whole.union(drawn).select(*_ordered("t", "hub")).distinct(), "drawn")
    joined = components(links.select("a", "b"))

    def apart() -> DataFrame:
        """The members of larger buckets that hold several components."""
        named = large.join(joined.withColumnRenamed("node", "t"), "t", "left").withColumn("component", F.coalesce("component", "t"))
        mixed = named.groupBy("bucket").agg(F.min("component").alias("c1"), F.max("component").alias("c2"))
        return named.join(mixed.filter("c1 != c2").select("bucket"), "bucket")

    degree = links.select(F.col("a").alias("t")).union(links.select("b")).groupBy("t").agg(F.count("*").alias("score"))
    scored = apart().join(degree, "t", "left").withColumn("score", F.coalesce("score", F.lit(0)))
    central = _with_hubs(scored).filter(F.col("component") != F.col("hub_component"))
    joined = joined_further(joined, verified(central.select(*_ordered("t", "hub")).distinct(), "central").select("a", "b"))

    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    rest = stored(few_tasks(apart(), placings), "apart")
    left_over = rest.count()
    if not left_over:
        return joined
    texts = _texts(rest.select(F.col("t").alias("a"), F.col("t").alias("b")), different, rows, left_over)
    placed = (
        rest.join(sig, "t").join(texts, "t")
        .withColumn("blocks", blocks)
        .withColumn("block", F.pmod(F.xxhash64(F.lit("block"), "t"), F.col("blocks").cast("long")).cast("int"))
        .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("bucket", "t", "component", "sig", "text", "block",
                F.least("block", "with").alias("block_a"), F.greatest("block", "with").alias("block_b"))
    )
    left = placed.groupBy("bucket", "block_a", "block_b").applyInPandas(_across, "a binary, b binary")
    return joined_further(joined, stored(left.distinct(), "links-left"))


def _with_hubs(members: DataFrame) -> DataFrame:
    """``members`` (bucket, t, score, ...) of each bucket with every hub of it but itself.

    The hubs are those of the highest score, ties by hash, one from each of HUBS classes of
    the hash: a plain maximum for each class, so that the aggregation stays partial and no
    bucket is gathered.
    """
    draw = F.xxhash64("bucket", "t")
    component = F.col("component") if "component" in members.columns else F.col("t")
    one = F.struct(F.col("score"), draw.alias("h"), F.col("t").alias("hub"), component.alias("hub_component"))
    best = members.groupBy("bucket").agg(*[
        F.max(F.when(F.pmod(draw, F.lit(HUBS)) == i, one)).alias(f"m{i}") for i in range(HUBS)])
    hubs = best.select("bucket", F.explode(F.array_compact(F.array(*[f"m{i}" for i in range(HUBS)]))).alias("o"))
    return members.join(hubs.select("bucket", "o.hub", "o.hub_component"), "bucket").filter(F.col("t") != F.col("hub"))


def _texts(pairs: DataFrame, different: DataFrame, rows: DataFrame, most: int) -> DataFrame:
    """(t, text) of the texts in ``pairs``, at most ``most``, each once."""
    named = pairs.select(F.col("a").alias("t")).union(pairs.select("b")).distinct()
    chosen = named.join(different.select("t", "k"), "t")
    met = rows.join(broadcast_if_small(chosen.toDF("ct", "ck")),
                    (F.col("t") == F.col("ct")) & F.col("k").eqNullSafe(F.col("ck")))
    return stored(few_tasks(met.select("t", "text").dropDuplicates(["t"]), most, TASK_TEXTS), "candidate-texts")


def _classed(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(k, t, words, sig) of every row, and (t, component, best, copies) of every text with
    words; ``best`` is its least row (none, k, rows): ids that are NULL come last, ``rows``
    counts those that repeat id and text."""
    rows = docs.select(F.col(key).alias("k"), text_key(text).alias("t"), F.col(text).alias("text"))
    kind = docs.schema[key].dataType.simpleString()
    signed = stored(rows.mapInArrow(_sign, f"k {kind}, t binary, words long, sig binary"), "signatures")
    joined = linked_texts(signed, rows)
    once = signed.filter("words > 0").groupBy("k", "t").agg(F.count("*").alias("rows"))
    by_text = once.groupBy("t").agg(
        F.min(F.struct(F.col("k").isNull().alias("none"), "k", "rows")).alias("best"), F.sum("rows").alias("copies"))
    placed = by_text.join(joined.toDF("t", "component"), "t", "left").withColumn("component", F.coalesce("component", "t"))
    return signed, placed


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, t, class_id, copies): the class of every row; ``t`` is its text's digest and
    ``copies`` the number of rows with that text."""
    signed, placed = _classed(docs, key, text)
    named = placed.groupBy("component").agg(F.min("best.k").alias("class_id"))
    classes = placed.join(named, "component").select("t", "class_id", "copies")
    own = signed.filter("words = 0").select("k", "t", F.col("k").alias("class_id"), F.lit(1).cast("long").alias("copies"))
    return signed.filter("words > 0").select("k", "t").join(classes, "t").select("k", "t", "class_id", "copies").union(own).withColumnRenamed("k", key)


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` less all but one document of each class: that of the least id (NULL last), of
    several texts with that id the one of the least digest, of equal rows one.

    Documents without words are classes of their own and stay; of those that repeat an id
    and a text, one stays.
    """
    signed, placed = _classed(docs, key, text)
    k, t, several = fresh(docs, "k_", "t_", "several_")
    least = placed.groupBy("component").agg(F.min(F.struct("best.none", "best.k", "t", "best.rows")).alias("b"))
    own = signed.filter("words = 0").groupBy("k", "t").agg(F.count("*").alias("rows"))
    chosen = stored(least.select("b.k", "b.t", "b.rows").union(own).select(
        F.col("k").alias(k), F.col("t").alias(t), (F.col("rows") > 1).alias(several)), "chosen")

    def met(some: DataFrame) -> DataFrame:
        return docs.join(some.drop(several), F.col(key).eqNullSafe(F.col(k)) & (text_key(text) == F.col(t)), "left_semi")

    repeated = chosen.filter(several)
    if repeated.isEmpty():
        return met(chosen)
    return met(chosen.filter(~F.col(several))).union(met(repeated).dropDuplicates([key, text]))
