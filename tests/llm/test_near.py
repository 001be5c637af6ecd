"""BagMinHash signatures, near-duplicate classes and components against brute force."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from cyclemart.llm import bagminhash as bag
from cyclemart.llm import textarrays as ta
from cyclemart.llm.components import components


def _bag(text):
    words = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).split()
    return Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))


def _similarity(a, b):
    a, b = _bag(a), _bag(b)
    both = sum((a & b).values())
    return both / max(1, sum((a | b).values()))


def _classes(rows):
    """class id of each row: components of equal texts and of similarity 0.8 and more."""
    texts = sorted({t for _, t in rows if (t or "").split()})
    root = {t: t for t in texts}

    def find(t):
        while root[t] != t:
            t = root[t]
        return t

    for i, a in enumerate(texts):
        for b in texts[:i]:
            if _similarity(a, b) >= 0.8:
                root[find(a)] = find(b)
    least = {}
    for k, t in rows:
        if (t or "").split():
            least.setdefault(find(t), []).append(k)
    name = {c: min((k for k in ks if k is not None), default=None) for c, ks in least.items()}
    return sorted(((k, name[find(t)] if (t or "").split() else k) for k, t in rows), key=repr)


def _signatures(texts):
    [(_, n, data, offsets)] = ta.chunks(pa.array(texts))
    return bag.signatures(*bag.weighted(*ta.shingles(*ta.words(data, offsets), 5)), n)


def test_words_and_shingles_are_those_of_python():
    texts = ["a b c d e f", "", None, " A\tb\x0bc\nd e ", "é" * 9, "one", "a b c d e f", "  ", "x" * 300_000 + " y"] * 3
    for first, n, data, offsets in ta.chunks(pa.array(texts)):
        hashes, counts = ta.words(data, offsets)
        some = [(t or "").lower() if (t or "").isascii() else t for t in texts[first:first + n]]
        assert counts.tolist() == [len((t or "").split()) for t in some]
        names = [w for t in some for w in (t or "").split()]
        assert len(set(zip(names, hashes.tolist()))) == len(set(names)) == len(set(hashes.tolist()))
        _, sizes = ta.shingles(hashes, counts, 5)
        assert sizes.tolist() == [max(0, len((t or "").split()) - 4) for t in some]


def test_chunks_cover_sliced_columns():
    texts = [f"text {i} " + "w " * (i % 7) for i in range(100)]
    column = pa.array(["x"] * 13 + texts).slice(13)
    seen = [bytes(data[a:b]).decode() for _, _, data, offsets in ta.chunks(column) for a, b in zip(offsets, offsets[1:])]
    assert seen == texts


@pytest.mark.parametrize("weights", [(1, 1), (1, 3), (2, 5), (40, 100)])
def test_registers_agree_with_the_weighted_similarity(weights):
    """Two multisets that share half their shingles, with different weights."""
    agree, trials, want = 0, 60, 0.0
    for t in range(trials):
        row, shingle, weight = [], [], []
        for side, w in enumerate(weights):
            for s in range(20):
                row.append(side)
                shingle.append(1000 * t + s if s < 10 else 1000 * t + 100 * (side + 1) + s)
                weight.append(w)
        sig = bag.signatures(np.array(row), np.array(shingle, np.uint64), np.array(weight), 2)
        agree += (sig[0] == sig[1]).mean()
        low, high = min(weights), max(weights)
        want = 10 * low / (10 * high + 10 * sum(weights))
    assert abs(agree / trials - want) < 0.02


def test_equal_texts_have_equal_signatures_in_any_chunk():
    text = " ".join(f"w{i % 37}" for i in range(500))
    alone, among = _signatures([text]), _signatures(["a b c d e f g", text, "", text])
    assert (alone[0] == among[1]).all() and (among[1] == among[3]).all()


def test_exact_similarity():
    pairs = [("a b c d e f g", "a b c d e f h"), ("a a a a a a a a", "a a a a a a"), ("x", "x"), ("", "a b c d e"), (" ".join("ab" * 50), " ".join("ab" * 60))]
    got = bag.multiset_jaccard(*(pa.array(list(x)) for x in zip(*pairs)))
    assert got.tolist() == pytest.approx([_similarity(a, b) for a, b in pairs])


def test_components(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 620)] + [(rng.randrange(60), rng.randrange(60)) for _ in range(50)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for x in {y for link in links if link[0] != link[1] for y in link}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def _edited(words, rng, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return " ".join(words)


def test_classes_against_brute_force(spark):
    rng = random.Random(7)
    rows, k = [], 100
    for group in range(12):
        words = [f"g{group}w{rng.randrange(400)}" for _ in range(rng.randrange(60, 200))]
        for _ in range(rng.randrange(1, 9)):
            rows.append((k, _edited(words, rng, rng.randrange(4))))
            k += 1
    rows += [(1, "short text"), (2, "short text"), (3, ""), (4, None), (5, "   "), (6, ""), (None, rows[0][1]), (7, "aa " * 400), (8, "aa " * 399),
             (9, "aa " * 100), (rows[3][0], "the same id with another text of some words"), rows[5], (None, "only null ids have this text here")]
    docs = spark.createDataFrame([(k, t, "x", 1) for k, t in rows], "doc_id long, text string, class_id string, t int")
    got = sorted(((r.doc_id, r.class_id) for r in bag.near_duplicates(docs).collect()), key=repr)
    assert got == _classes(rows)
    kept = bag.keep_one(docs)
    assert kept.columns == docs.columns
    count = Counter(r.doc_id for r in kept.collect())
    assert sum(count.values()) == len(kept.dropDuplicates(["doc_id", "text"]).collect())
    assert bag.near_duplicates(docs.limit(0)).count() == 0 and bag.keep_one(docs.limit(0)).count() == 0


def test_a_third_of_all_documents_are_near_copies(spark, monkeypatch):
    """Large buckets: members are not all compared with each other, and no link is lost."""
    monkeypatch.setattr(bag, "BLOCK", 16)
    rng = random.Random(11)
    words = [f"w{i}" for i in range(120)]
    rows = [(i, _edited(words, rng, rng.randrange(1, 5))) for i in range(90)] + [(i, " ".join(words)) for i in range(90, 120)]
    rows += [(i, " ".join(f"o{i}x{j}" for j in range(60))) for i in range(120, 240)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted(((r.doc_id, r.class_id) for r in bag.near_duplicates(docs).collect()), key=repr)
    assert got == _classes(rows)


WORDS = " ".join(f"w{i}" for i in range(60))


def test_keep_one_of_repeated_and_null_ids(spark):
    from cyclemart.llm import bagminhash

    near = [WORDS, WORDS + " more", WORDS + " other"]
    docs = spark.createDataFrame([(1, near[0]), (1, near[1]), (2, near[2]), (3, "else"), (3, "else")], "doc_id long, text string")
    kept = bagminhash.keep_one(docs).collect()
    assert sorted(r.doc_id for r in kept) == [1, 3] and {r.text for r in kept if r.doc_id == 1} < set(near)
    docs = spark.createDataFrame([(None, t) for t in near] + [(None, ""), (None, ""), (None, None)], "doc_id long, text string")
    kept = [r.text for r in bagminhash.keep_one(docs).collect()]
    assert sum(t in near for t in kept) == 1 and len(kept) == 3  # equal wordless rows are one


def test_signatures_do_not_depend_on_the_size_of_a_batch():
    import pyarrow as pa

    from cyclemart.llm import bagminhash

    n = 70_000
    texts = [f"a{i} b{i} c{i} d{i} e{i} f{i}" for i in range(n)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(n)), pa.array([b"x"] * n), pa.array(texts)], names=["k", "t", "text"])
    whole = pa.Table.from_batches(bagminhash._sign(iter([batch]))).column("sig")
    for i in (0, 1, 65_535, 65_536, n - 1):
        alone = pa.Table.from_batches(bagminhash._sign(iter([batch.slice(i, 1)]))).column("sig")
        assert whole[i] == alone[0]


def test_small_tables_are_written_by_few_tasks(spark, monkeypatch):
    """Where adaptive execution does not merge them, a shuffle's partitions would each write a file."""
    from cyclemart.llm import components as steps

    files = {}

    def watched(stored):
        def write(df, name):
            out = stored(df, name)
            files[name] = max(files.get(name, 0), len(out.inputFiles()))
            return out
        return write

    monkeypatch.setattr(bag, "stored", watched(bag.stored))
    monkeypatch.setattr(steps, "stored", watched(steps.stored))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    try:
        words = [f"w{i}" for i in range(400)]
        rows = [(d, " ".join(words[d % 7 * 40:][:100] + [f"own{d}"])) for d in range(60)]
        out = bag.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
        assert {r.doc_id: r.class_id for r in out.collect()} == {d: d % 7 for d in range(60)}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    for name in ("texts", "buckets", "likely-drawn", "candidate-texts", "links-drawn"):
        assert files[name] == 1, files
