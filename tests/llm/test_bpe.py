"""Byte-level BPE against the tokenizers library."""

import hashlib
import itertools
import random

import pytest
from tokenizers import Tokenizer

from cyclemart.llm import bpe, catalogue

PATH = catalogue.vocabulary_path()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def _texts():
    rng = random.Random(5)
    alphabet = [chr(c) for c in itertools.chain(range(0x250), (0x3000, 0x4E2D, 0x1F600, 0x200D, 0x85, 0x661, 0x2028))]
    fixed = ["", "a", " ", "  \n x", "it's", "<|endoftext|>", "x<|endoftext|><|endoftext|> y", "a" * 3000, "ab" * 700, " " * 4000,
             "é" * 333 + "!" * 500, "word " * 2000, "x" * bpe.SHORT, "x" * (bpe.SHORT + 1), "\x1c\x1d a\x0bb"]
    return fixed + ["".join(rng.choice(alphabet if rng.random() < 0.5 else " 's\n\tab1llé") for _ in range(rng.randrange(60))) for _ in range(400)]


def test_ids_and_text_are_the_librarys(library):
    texts, vocabulary = _texts(), bpe.Vocabulary(PATH)
    for text, (joined, ids) in zip(texts, vocabulary.encode_all(texts)):
        assert ids == library.encode(text, add_special_tokens=False).ids, repr(text[:40])
        assert joined == ",".join(map(str, ids))
        assert vocabulary.decode(ids) == library.decode(ids, skip_special_tokens=False) == text
        assert vocabulary.encode(text) == ids


def test_broken_characters_are_replaced_alike(library):
    rng, vocabulary = random.Random(3), bpe.Vocabulary(PATH)
    for _ in range(50):
        ids = [rng.randrange(50257) for _ in range(40)]
        assert vocabulary.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_scan_and_heap_agree():
    vocabulary, rng = bpe.Vocabulary(PATH), random.Random(1)
    words = ["".join(rng.choice("etaoin shrdlu") for _ in range(rng.randrange(1, 60))).encode() for _ in range(300)]
    words.sort(key=len)
    assert vocabulary._scan(words) == [vocabulary._heap(w) for w in words]


def test_the_table_of_words_is_bounded(monkeypatch, library):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 50)
    vocabulary = bpe.Vocabulary(PATH)
    for i in range(40):
        text = " ".join(f"w{i}x{j}" for j in range(20)) + " " + "z" * 200
        assert vocabulary.encode(text) == library.encode(text, add_special_tokens=False).ids
        assert len(vocabulary.cache) < 200


def test_documents(spark, library):
    rows = [(1, "Hello  world", 9), (2, None, 9), (3, "", 9), (None, "Hello  world", 9), (1, "Hello  world", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    coded = bpe.encode_documents(docs, PATH)
    assert coded.columns == ["doc_id", "text", "ids", "ids_"]
    back = bpe.decode_documents(coded, PATH, ids="ids_").collect()
    assert [r.decoded for r in back] == [t or "" for _, t, _ in rows]
    for r in bpe.round_trip_digests(docs, PATH).collect():
        text = "Hello  world" if r.doc_id in (1, None) else ""
        ids = library.encode(text, add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert all(r.exact for r in bpe.encoded_with_check(docs, PATH).collect())
    assert bpe.round_trip_digests(docs.limit(0), PATH).count() == 0
