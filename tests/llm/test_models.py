"""Quality model, nearest neighbours and language model against brute force."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cyclemart.llm import catalogue, gam, katz, srs
from tests.conftest import SF_SMALL

# --- quality ------------------------------------------------------------------------------


def test_features_of_each_text_do_not_depend_on_the_others():
    texts = ["Plain words, here.", None, "", "AAA!! BBB!! ###", "x " * 5000, "a\nb\nc", "é ü"]
    together = gam.text_features(pa.array(texts))
    alone = np.concatenate([gam.text_features(pa.array([t], pa.string())) for t in texts])
    assert together.shape == (7, len(gam.FEATURES)) and np.allclose(together, alone) and np.isfinite(together).all()
    assert not together[1].any() and not together[2].any()


def test_a_pair_of_features_is_learned():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    model = gam.fit(x, y)
    assert (0, 1) in model.pairs
    test = rng.normal(size=(2000, 4))
    assert ((model.score(test) > 0.5) == ((test[:, 0] > 0) ^ (test[:, 1] > 0))).mean() > 0.9


def test_one_class_or_no_label_gives_the_base_rate(spark):
    docs = spark.createDataFrame([(1, "a b"), (3, None), (None, "")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r.score for r in gam.score(docs, gam.train(docs, none)).collect()] == pytest.approx([0.5] * 3)
    ones = spark.createDataFrame([(1, 1), (1, 1), (3, 1), (None, 0), (3, None), (99, 0)], "doc_id long, quality int")
    used = sum(zlib.crc32(str(k).encode()) % 4 != 2 for k in (1, 1, 3))
    scores = [r.score for r in gam.score(docs, gam.train(docs, ones)).collect()]
    assert scores == pytest.approx([(used + 1) / (used + 2)] * 3)
    assert gam.score(docs.limit(0), gam.Model(0.0)).count() == 0


def test_training_rows_of_a_repeated_id_are_bounded(spark, monkeypatch):
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 4 != 2][:40]
    rows = [(i, f"text {i}") for i in ids] + [(ids[0], f"text {ids[0]}")] * 300 + [(ids[1], f"other {i}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, i % 2) for i in ids] + [(ids[0], ids[0] % 2)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(gam, "fit", lambda x, y: seen.append((x, y)) or gam.Model(0.0))
    for most in (20_000, 50):
        gam.train(docs, labels, max_rows=most)
    # 40 ids, one of them labelled twice and another with 300 more texts
    assert [len(y) for _, y in seen] == [341, 50]
    first = {tuple(x) for x in gam.text_features(pa.array([f"text {i}" for i in ids[2:]]))}
    assert first <= {tuple(x) for x in seen[1][0]}  # no id is crowded out


def test_held_out_accuracy(spark):
    out = catalogue.QUERIES["op8_gam_quality"](spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = out.join(labels, "doc_id").filter("held_out").toPandas()
    assert len(rows) > 50 and (rows.predicted == rows.quality).mean() > 0.95
    assert rows.predicted[rows.quality == 1].mean() > 0.97
    assert out.count() == 1000 and out.filter("score < 0 OR score > 1 OR score IS NULL").count() == 0


# --- neighbours ---------------------------------------------------------------------------


def _exact(points, query_id, query, k):
    found = [(float(np.sqrt(((np.array(v, float) - np.array(query, float)) ** 2).sum())), i)
             for i, v in points if i != query_id and v is not None and len(v) == len(query)]
    return sorted(found)[:k]


def test_chi_square():
    rng = np.random.default_rng(3)
    draws = (rng.normal(size=(100_000, srs.DIRECTIONS)) ** 2).sum(axis=1)
    for x in (0.5, 4.0, 8.0, 20.0):
        assert abs(srs.chi2_cdf(x) - (draws < x).mean()) < 0.01
    assert srs.chi2_cdf(0.0) == 0 and srs.chi2_cdf(1e6) == 1


def test_ties_copies_and_unusable_vectors(spark, monkeypatch):
    monkeypatch.setattr(srs, "BLOCK_ROWS", 50)
    monkeypatch.setattr(srs, "BLOCK_QUERIES", 2)
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(120)]
    rows += [(i, [1.0] * 6) for i in range(120, 180)]  # a third are one vector
    bad = [(900, None), (901, [0.0] * 6), (902, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (903, [float("nan")] * 6), (904, [float("inf")] * 6), (905, []), (None, [1.0] * 6)]
    other = [(800, [1.0, 2.0]), (801, [1.0, 2.5])]
    frame = spark.createDataFrame(rows + bad + other, "vec_id long, embedding array<float>")
    out = srs.nearest(frame, frame.filter("vec_id IN (0, 130, 150, 800, 901, 903)"), k=10)
    points = [(i, np.float32(v).tolist()) for i, v in rows + other]
    by_id = dict(points)
    got = {}
    for r in out.orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.rank, r.score, r.vec_id))
    assert sorted(got) == [0, 130, 150, 800]
    for q in got:
        want = _exact(points, q, by_id[q], 10)
        assert [x[0] for x in got[q]] == list(range(1, len(want) + 1))
        assert [x[2] for x in got[q]] == [i for _, i in want]
        assert [x[1] for x in got[q]] == pytest.approx([d for d, _ in want], abs=1e-12)
    assert srs.nearest(frame.limit(0), frame.limit(0)).count() == 0


def test_recall_and_early_stop():
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(40, 64)) * 3
    points = centres[rng.integers(0, 40, 4000)] + rng.normal(size=(4000, 64))
    tree, hits, seen = srs.ProjectedTree(points), 0, 0
    for q in range(0, 4000, 100):
        true = np.sqrt(((points - points[q]) ** 2).sum(axis=1))
        at, distance = tree.search(points[q], 11)
        assert np.allclose(true[at], distance)
        hits += len(set(np.argsort(true)[:11]) & set(at[np.argsort(distance)[:11]]))
        seen += len(at)
    assert hits / (40 * 11) > 0.95


def test_recall_on_the_given_vectors(spark):
    out = catalogue.QUERIES["op1_srs_neighbours"](spark, SF_SMALL).toPandas()
    vectors = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").toPandas()
    points = list(zip(vectors.vec_id, vectors.embedding))
    hits = total = 0
    for q, v in points:
        if q % 100 == 0:
            want = {i for _, i in _exact(points, q, v, 10)}
            hits += len(want & set(out.vec_id[out.query_id == q]))
            total += len(want)
    assert hits / total >= 0.9


# --- language model -----------------------------------------------------------------------


def _tokens(text):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return [w for w in re.split(r"[\x20\x09-\x0d]+", (text or "").translate(low)) if w] + ["</s>"]


class Brute:
    """The model by its definition."""

    def __init__(self, texts):
        self.uni, self.bi = Counter(), defaultdict(Counter)
        for t in texts:
            words = _tokens(t)
            self.uni.update(words)
            for h, w in zip(["<s>", *words], words):
                self.bi[h][w] += 1
        self.n, self.v = sum(self.uni.values()), len(self.uni)
        self.d1 = self._discounts(self.uni.values())
        self.d2 = self._discounts([c for x in self.bi.values() for c in x.values()])
        self.left = sum((1 - self._d(self.d1, c)) * c for c in self.uni.values())
        self.context = {}
        for h, x in self.bi.items():
            none = not any(c <= katz.CUTOFF for c in x.values())
            left = 1 if none else sum((1 - self._d(self.d2, c)) * c for c in x.values())
            whole = sum(x.values()) + none
            self.context[h] = (whole, left / whole / (1 - sum(map(self.p1, x))))

    @staticmethod
    def _discounts(counts):
        counts = list(counts)
        return katz.discounts(np.array([sum(c == r for c in counts) for r in range(1, katz.CUTOFF + 2)], float))

    @staticmethod
    def _d(d, c):
        return d[c] if c <= katz.CUTOFF else 1.0

    def p1(self, w):
        whole = self.n + (self.left == 0)
        return self._d(self.d1, self.uni[w]) * self.uni[w] / whole if w in self.uni else (self.left or 1) / whole

    def p(self, h, w):
        if h not in self.bi:
            return self.p1(w)
        if w in self.bi[h]:
            return self._d(self.d2, self.bi[h][w]) * self.bi[h][w] / self.context[h][0]
        return self.context[h][1] * self.p1(w)


def _held(key):
    return zlib.crc32(("" if key is None else str(key)).encode()) % 7 == 2


@pytest.mark.parametrize("limits", [
    {}, {"BUCKET_TOKENS": 900, "MANY_DOCUMENTS": 4, "CODED": 60, "BLOCK_TOKENS": 1500}, {"BUCKET_TOKENS": 900, "CODED": 0},
    {"BUCKET_TOKENS": 300, "MANY_DOCUMENTS": 1, "BLOCK_ROWS": 7}])
def test_scores_against_the_definition(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(katz, name, value)
    rng = random.Random(4)
    vocabulary = [f"w{int(rng.expovariate(0.05))}" for _ in range(500)]
    rows = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(40)))) for i in range(150)]
    rows += [(200 + i, "Hot pair") for i in range(90)]  # one pair holds very many rows
    rows += [(400, None), (401, ""), (402, "never SEEN before " * 30), (None, "a null key"), (7, "a repeated key"), (403, "é É Ünï\x0bw1\x1fw2")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    model = katz.train_and_score(docs, katz.held_out("doc_id"))
    brute = Brute([t for k, t in rows if not _held(k)])
    want = []
    for k, t in rows:
        words = _tokens(t)
        want.append((
            (k is None, k or 0), _held(k), len(words), sum(w in brute.uni for w in words), brute.n,
            sum(math.log10((brute.uni[w] + 1) / (brute.n + 1 * (brute.v + 1))) for w in words),
            sum(math.log10(brute.p(h, w)) for h, w in zip(["<s>", *words], words))))
    got = [((r.doc_id is None, r.doc_id or 0), *tuple(r)[1:]) for r in model.scores.collect()]
    assert len(got) == len(want)
    for g, w in zip(sorted(got), sorted(want)):
        assert g[:5] == w[:5] and g[5:] == pytest.approx(w[5:], rel=1e-9)
    pairs = katz.bigram_rows(model)
    assert pairs.agg(F.sum("c")).first()[0] == brute.n
    assert sorted(r.c for r in pairs.collect()) == sorted(c for x in brute.bi.values() for c in x.values())


def test_probabilities_sum_to_one():
    rng = random.Random(9)
    brute = Brute([" ".join(f"w{int(rng.expovariate(0.2))}" for _ in range(20)) for _ in range(60)])
    unknown = (brute.left or 1) / (brute.n + (brute.left == 0))
    for h in brute.bi:
        total = sum(brute.p(h, w) for w in brute.uni) + brute.context[h][1] * unknown
        assert total == pytest.approx(1, abs=1e-12)


def _good_turing(n):
    """{r: discount} by Gale and Sampson's line and Katz's condition on the freed mass; n is {r: n[r]}."""
    have = sorted(r for r in n if n[r])
    points = []
    for i, r in enumerate(have):
        low = have[i - 1] if i else 0
        high = have[i + 1] if i + 1 < len(have) else 2 * r - low
        points.append((math.log(r), math.log(n[r] / (0.5 * (high - low)))))
    mx, my = (sum(p[k] for p in points) / len(points) for k in (0, 1))
    b = sum((x - mx) * (y - my) for x, y in points) / sum((x - mx) ** 2 for x, _ in points)
    assert b < -1
    for last in range(5, -1, -1):  # the counts that keep Turing's own estimate
        if any(not n[r] for r in range(1, last + 2)):
            continue
        star = {r: (r + 1) * n[r + 1] / n[r] if r <= last else r * (1 + 1 / r) ** (b + 1) for r in range(1, 6)}
        freed = sum(n[r] * (r - star[r]) for r in star)
        d = {r: 1 - n[1] / freed * (1 - star[r] / r) for r in star}
        if freed > 0 and all(0 < x < 1 for x in d.values()):
            return d
    raise AssertionError("no discounts")


@pytest.mark.parametrize("n", [
    [49663, 12919, 5197, 2729, 2383, 1067], [193655, 25105, 6496, 2179, 2497, 618],  # groups of copies
    [1000, 400, 200, 120, 80, 60], [100, 20, 0, 3, 0, 0]])
def test_discounts_are_good_turing(n):
    d = katz.discounts(np.array(n, float))
    want = _good_turing(dict(enumerate(n, 1)))
    assert d == pytest.approx([0, *(want[r] for r in range(1, 6))], rel=1e-9)
    # what is freed is Turing's estimate of the unseen: the occurrences of what occurs once
    assert sum((1 - d[r]) * r * n[r - 1] for r in range(1, 6)) == pytest.approx(n[0])


def test_discounts_by_katz_formula_where_it_holds():
    n = [1000, 400, 200, 120, 80, 60]
    common = 6 * n[5] / n[0]
    assert katz.discounts(np.array(n, float))[1:] == pytest.approx(
        [((r + 1) * n[r] / n[r - 1] / r - common) / (1 - common) for r in range(1, 6)])


@pytest.mark.parametrize("n", [[0] * 6, [0, 3, 2, 1, 1, 1], [5, 0, 0, 0, 0, 1], [1] * 6])
def test_discounts_without_counts_of_counts(n):
    taken = n[0] / (n[0] + 2 * n[1]) if n[0] and n[1] else 0.5
    assert katz.discounts(np.array(n, float))[1:] == pytest.approx([1 - taken / r for r in range(1, 6)])


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    got = katz.train_and_score(docs, F.lit(True)).scores.collect()
    assert [(r.n_known, r.train_tokens, r.base_score, r.score) for r in got] == [(0, 0, 0.0, 0.0)] * 2
    assert katz.train_and_score(docs.limit(0), katz.held_out("doc_id")).scores.count() == 0


def test_packing():
    arrays = [np.arange(10, dtype=np.uint64), np.empty(0, np.uint64), np.array([1.5, -2]), np.array([1 << 63], np.uint64), np.array([7], np.uint8)]
    for a, b in zip(arrays, katz.unpack(katz.pack(*arrays))):
        assert (a == b).all() and len(a) == len(b)


# --- op8: features and scores by their definitions ------------------------------------------
def _plain_features(text):
    """The features of one text, written from their names, over its bytes."""
    import math
    from collections import Counter

    data = text.encode()
    if not data:
        return [0.0] * len(gam.FEATURES)
    words = [w.lower() for w in re.split(rb"[ \t-\r]+", data) if w]
    n, size, lines = len(words), len(data), data.count(b"\n") + 1
    kinds = {
        "upper": rb"[A-Z]", "digit": rb"[0-9]", "space": rb"[ \t-\r]", "wide": rb"[\x80-\xff]", "stop": rb"[.]", "comma": rb"[,;:]",
        "bang": rb"[!?]", "pipe": rb"[|]", "symbol": rb"[#$%&*+=<>@\\^_~`/{}\[\]]", "other_mark": rb"[-'\"()]"}
    share = {k: len(re.findall(p, data)) for k, p in kinds.items()}
    times = Counter(words)
    out = {
        "log_bytes": math.log1p(size), "log_words": math.log1p(n), "word_bytes": (size - share["space"]) / max(n, 1),
        "distinct": len(times) / max(n, 1), "repeat": sum(a == b for a, b in zip(words, words[1:])) / max(n, 1),
        "top_word": max(times.values(), default=0) / max(n, 1), "line_bytes": math.log1p(size / lines), "line_words": n / lines,
        "shouted": len(re.findall(rb"(?=[A-Z][A-Z])", data)) / size}
    for k, v in share.items():
        out[k] = v / (size if k in ("upper", "digit", "space", "wide") else max(n, 1))
    return [out[f] for f in gam.FEATURES]


def _plain_score(model, x):
    """A score row by row: the base and what each table holds for the row's bin."""
    import bisect
    import math

    odds = model.base + sum(t[bisect.bisect_right(list(e), v)] for e, t, v in zip(model.edges, model.tables, x))
    for (f, g), table in zip(model.pairs, model.pair_tables):
        odds += table[bisect.bisect_right(list(model.pair_edges[f]), x[f])][bisect.bisect_right(list(model.pair_edges[g]), x[g])]
    return 1 / (1 + math.exp(-min(max(odds, -30), 30)))


def test_quality_features_and_scores_by_definition(spark):
    rnd = random.Random(8)
    alphabet = "abcdefgh ABC 012 .,;!?|#$_-'()\n\té日"
    texts = ["", " ", "\n\n", "One word", "a a a b", "WORD WORD word", "x" * 50_000, None]
    texts += ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(400))) for _ in range(300)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int((t or "").count("a") > 8)) for i, t in enumerate(texts)], "doc_id long, quality int")
    model = gam.train(docs, labels)
    assert any(t.any() for t in model.tables) and model.pairs
    got = {r.doc_id: r.score for r in gam.score(docs, model).collect()}
    for i, t in enumerate(texts):
        x = gam.text_features(pa.array([t]))[0]
        assert np.allclose(x, _plain_features(t or ""), atol=1e-9), t
        assert abs(got[i] - _plain_score(model, x)) < 1e-9, t
