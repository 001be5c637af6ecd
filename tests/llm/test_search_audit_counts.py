"""Ranked search, the filter audit and token counts against their plain definitions."""

import itertools
import math
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cyclemart.llm import catalogue, filter_audit, lexical, token_counts
from tests.conftest import SF_SMALL

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def _terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def _brute_ranking(docs, items, k):
    terms = [(d, _terms(t)) for d, t in docs]
    terms = [(d, t) for d, t in terms if t]
    count, total = len(terms), sum(len(t) for _, t in terms)
    holding = {}
    for _, ts in terms:
        for t in set(ts):
            holding[t] = holding.get(t, 0) + 1
    wanted = {}
    for i, text in items:
        wanted.setdefault(i, set()).update(_terms(text))
    out = []
    for i, ts in wanted.items():
        scored = []
        for d, dt in terms:
            m = 100 - 50 + (50 * len(dt) * count) // total
            score = sum(math.floor(1000 * math.log((2 * count + 2) / (2 * holding[t] + 1)))
                        * ((10 ** 9 * dt.count(t)) // (1000 * dt.count(t) + 20 * m)) for t in ts if t in dt)
            if score > 0:
                scored.append((-score, d is None, d if d is not None else 0))
        for r, (s, none, d) in enumerate(sorted(scored)[:k], 1):
            out.append((i, r, None if none else d, -s))
    return sorted(out, key=repr)


def _found(df):
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in df.collect()), key=repr)


def _corpus(seed, n):
    rnd = random.Random(seed)
    common, rare = ["the", "Of", "and", "Zoë"], [f"w{i}" for i in range(60)]
    docs = [(i, " ".join(rnd.choices(common, k=rnd.randrange(8)) + rnd.choices(rare, k=rnd.randrange(6)))) for i in range(n)]
    return docs


def test_ranking_against_brute_force(spark):
    docs = _corpus(1, 300) + [(900, None), (901, ""), (902, "-- !"), (5, "w1 w1 the"), (None, "w2 of"), (903, "w3 " * 40_000)]
    docs += [(1000 + i, "the same w7") for i in range(90)]  # more ties than places
    items = [(1, "The w1 w2, w3!"), (2, "w7 of the zoë"), (3, None), (4, "nowhere"), (1, "w5"), (None, "w9 and"), (6, "the of and")]
    d = spark.createDataFrame([(k, t, 0, 1) for k, t in docs], "doc_id long, text string, score int, item int").repartition(3)
    i = spark.createDataFrame([(k, t, "x") for k, t in items], "item_id long, text string, term string")
    want = _brute_ranking(docs, items, 50)
    assert _found(lexical.rank_documents(d, i)) == want
    assert _found(lexical.rank_documents(d, i, block_terms=3)) == want  # several blocks of items
    assert lexical.rank_documents(d.limit(0), i).count() == 0 and lexical.rank_documents(d, i.limit(0)).count() == 0


@pytest.mark.parametrize("share,postings", [(1, 50), (2, 400), (16, 2_000_000), (10 ** 6, 200)])
def test_short_and_long_lists_give_the_same_ranking(share, postings, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(lexical, "SHORT_SHARE", share)
    monkeypatch.setattr(lexical, "SHARD_POSTINGS", postings)
    docs = _corpus(2, 500)
    items = [(1, "the w1 w2 w3 of"), (2, "and zoë the of"), (3, "w40 w41 w42 w43 and"), (4, "of")]
    wanted = sorted({t.encode() for _, text in items for t in _terms(text)})
    rows = [(k, _terms(t)) for k, t in docs]
    number = {t.decode(): n for n, t in enumerate(wanted)}
    batches = []
    for first in range(0, 500, 70):
        some = rows[first:first + 70]
        hits = [sorted((number[t], ts.count(t)) for t in set(ts) if t in number) for _, ts in some]
        batches.append(pa.RecordBatch.from_arrays([
            pa.array([k for k, _ in some]), pa.array([len(ts) for _, ts in some]),
            pa.array([np.array([a for a, _ in h], np.int32).tobytes() for h in hits], pa.binary()),
            pa.array([np.array([b for _, b in h], np.int32).tobytes() for h in hits], pa.binary())], names=["k", "n", "terms", "times"]))
    filled = [ts for _, ts in rows if ts]
    weights = lexical.Weights(len(filled), sum(map(len, filled)), np.array([sum(t.decode() in ts for ts in filled) for t in wanted]))
    got = []
    for i, text in items:
        best = []
        for shard in lexical._shards(iter(batches), weights):
            reached = best[-1][0] if len(best) == 10 else 0
            terms = np.array(sorted({number[t] for t in _terms(text)}))
            keys, scores = shard.ordered(*shard.best(terms, 10, reached), 10)
            best = sorted([*best, *zip(scores, keys)], key=lambda x: (-x[0], x[1]))[:10]
        got += [(i, r, k, s) for r, (s, k) in enumerate(best, 1)]
    assert sorted(got, key=repr) == _brute_ranking(docs, items, 10)


def test_terms_of_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(lexical, "span_hashes", lambda data, starts, lengths: np.full(len(starts), 7, np.uint64))
    table = lexical.TermTable([b"ab", b"cd", b"abc"])
    data = np.frombuffer(b"cd abc ab xy", np.uint8)
    assert table.find(data, np.array([0, 3, 7, 10]), np.array([2, 3, 2, 2])).tolist() == [1, 2, 0, -1]


# --- the filter audit -----------------------------------------------------------------------
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _measure(text):
    words = WORD.findall(text)
    return len(words), len(set(words)), len(re.findall("[A-Z]", text)), len(text), len(re.findall(r"[#$%&*|]", text))


def _measured(texts):
    data = "".join(texts).encode()
    offsets = np.concatenate(([0], np.cumsum([len(t.encode()) for t in texts]))).astype(np.int64)
    found = filter_audit.measure(np.frombuffer(data, np.uint8), offsets)
    return [tuple(int(found[m][i]) for m in filter_audit.MEASURES) for i in range(len(texts))]


TEXTS = st.lists(st.text(alphabet="ab AZé#|\t\n\x0b\x0c\r\x85 日😀", max_size=30), max_size=8)


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_transducer_against_regular_expressions(texts):
    assert _measured(texts) == [_measure(t) for t in texts]


def test_hash_collisions_are_not_counted_as_repeats(monkeypatch):
    monkeypatch.setattr(filter_audit, "span_hashes", lambda data, starts, lengths: np.zeros(len(starts), np.uint64))
    texts = ["a b a c ab ba ab", "a b", "", "x " * 50]
    assert _measured(texts) == [_measure(t) for t in texts]


def _brute_audit(docs, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    rows = []
    for k, text, lang in docs:
        w, u, c, p, s = _measure(text or "")
        smaller = k is not None and any(o is not None and o < k and (t or "") == (text or "") for o, t, _ in docs)
        fails = {f for f, x in zip("ABCDE", (w < 100, 100 * u < 80 * w, 100 * c > 10 * p, s > 0, smaller)) if x}
        rows.append((lang or "", fails, k in good, k in toxic))
    out = {}
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            for step, f in enumerate(order, 1):
                here = [r for r in mine if f in r[1] and not r[1] & set(order[:step - 1])]
                shapley[f] += len(here)
                out[part, "".join(order), step] = [
                    sum(not r[1] & set(order[:step]) for r in mine), len(here),
                    sum(f in r[1] and bool(r[1] & set(order[:step - 1])) for r in mine),
                    sum(r[1] == {f} for r in mine), sum(r[2] for r in here), sum(r[3] for r in here)]
        for (p, order, step), v in out.items():
            if p == part:
                v.append(shapley[order[step - 1]])
    return out


def test_audit_against_brute_force(spark):
    fine = " ".join(f"word{i}" for i in range(120))
    docs = [(1, fine, "en"), (2, fine, "en"), (3, fine + " #", "en"), (4, "SHOUT " * 120, "de"), (5, None, None), (6, "", None),
            (7, fine.upper(), "de"), (2, fine, "en"), (None, fine, "en"), (None, "x", "en"), (8, fine, "fr"), (9, "a " * 40_000, "fr"),
            (1, fine, "de")]
    labels = [(1, 1, 0), (2, 1, 1), (3, 0, 1), (2, 0, 0), (None, 1, 1), (8, None, None), (9, 1, None)]
    d = spark.createDataFrame([(k, t, p, 1, "x") for k, t, p in docs], "doc_id long, text string, lang string, n int, part string")
    m = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley]
           for r in filter_audit.filter_audit(d, m).collect()}
    assert got == _brute_audit(docs, labels)
    assert filter_audit.filter_audit(d.limit(0), m).count() == 0
    assert filter_audit.filter_audit(d, m.limit(0)).agg({"good_lost": "sum", "kept": "max"}).first()[0] == 0


# --- token counts -----------------------------------------------------------------------------
PATH = catalogue.vocabulary_path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    t.no_truncation(), t.no_padding()
    return lambda texts: [len(e.ids) for e in t.encode_batch(texts, add_special_tokens=False)]


@pytest.fixture(scope="module")
def machine():
    return token_counts.Transducer(PATH)


ODD = ["", "'", "''", "'s", "it's o'reilly don't 've 'vex 'r 'l 'll '", "!'s", "a'S B'LL 'RE", "x'v'e", "<|startoftext|>a<|endoftext|>",
       "<|START", "ΣΑΣ ΌΣ", "İstanbul K", "éà café", "12345 ½ ² ٣", "日本語テキスト 한국어", " x y　z", "a" * 2000, "!" * 3000,
       "😀😀 👨‍👩‍👧", "\x00\x01 a", "tab\tnew\nline\x0b\x0c\r\x85end", "the" * 900, "wordswithoutanyspace" * 300, " " * 2000]


def test_counts_of_odd_texts(machine, library):
    assert machine.count_texts(ODD).tolist() == library(ODD)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="abcdeest '!?.srvlmd tionABQ 19éèñßÀΣ́<|>日本\n", max_size=60), max_size=6))
def test_counts_against_the_library(machine, library, texts):
    assert machine.count_texts(texts).tolist() == library(texts)


@pytest.mark.parametrize("chunk", [1, 2, 3, 7, 64])
def test_chunks_compose_to_the_whole(machine, library, chunk):
    texts = [t for t in ODD if "<|" not in t and t.isascii()]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    assert machine.count(data, offsets, chunk).tolist() == library(texts)


def test_a_transducer_that_starts_anew(library, monkeypatch):
    monkeypatch.setattr(token_counts, "MAX_STATES", 50)
    machine = token_counts.Transducer(PATH)
    for _ in range(3):
        assert machine.count_texts(ODD).tolist() == library(ODD)


def test_borders_between_tokens_are_those_of_merging():
    """The test of two neighbours against merging them by definition."""
    merges = token_counts.Merges(token_counts.Transducer(PATH).spec)
    rnd = random.Random(3)
    tokens = [i for i in range(49_000) if merges.token and not merges.spelt[i] == []]
    inner = [i for i in rnd.sample(tokens, 4000) if merges.spelt[i][-1] < 256]
    for a, b in zip(inner, rnd.sample(tokens, len(inner))):
        apart = merges.encode(merges.spelt[a] + merges.spelt[b]) == [a, b]
        assert merges.compatible(a, b) == apart


def test_counts_of_a_table(spark, library):
    rows = [(i, t, 5) for i, t in enumerate(ODD)] + [(None, None, 1), (3, "'s", 2), (3, "again", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = catalogue.token_counts.over_limit(token_counts.count_tokens(docs, PATH), 100).collect()
    texts = [t or "" for _, t, _ in rows]
    want = [(k, len(t.encode()), n, n > 100) for (k, _, _), t, n in zip(rows, texts, library(texts))]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert token_counts.count_tokens(docs.limit(0), PATH).count() == 0


def test_counts_of_the_documents(spark, library):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r.n_tokens for r in catalogue.op13_token_counts(spark, SF_SMALL).collect()}
    assert got == dict(zip([r.doc_id for r in docs], library([r.text or "" for r in docs])))
