"""Byte-level BPE encoding and decoding with a contiguous rank array per word.

A text is cut at the special tokens and then by the vocabulary's split pattern into words.
A short word keeps its parts in one contiguous row and the ranks of adjacent pairs in
another: scan for the smallest rank, delete that boundary, refresh the two neighbouring
ranks, until nothing merges.  The words of a batch that are new to the task are rows of one
array, so a scan serves them all.  Words longer than ``SHORT`` bytes, where scanning would
be quadratic, take the same merges in the same order from a heap.  Words repeat, so each
task keeps a bounded table from word to ids.

Nothing is shuffled: documents are independent, so encoding is a map over Arrow batches.

Defined cases: NULL and empty texts have no tokens and decode to the empty text; special
tokens written in a text become their ids; texts of any length are encoded whole; repeated
rows are encoded alike; other columns are kept.  Letters and numbers are those of the
Unicode version of the ``regex`` module; a character that was assigned only lately may be
cut differently by a library with older tables.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from cyclemart.llm.common import fresh

SHORT = 64  # bytes of a word up to which the rank array is scanned
CACHE_WORDS = 200_000  # words a task remembers; beyond, the table starts anew

TEXT_AT_A_TIME = 1 << 20  # characters whose words are learned together
WORDS_AT_A_TIME = 16_384  # rows of the rank array

#: Fixed value: the split pattern of byte-level vocabularies of this kind, for given classes
#: of letters (L), numbers (N) and white space (S).
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?[L]+| ?[N]+| ?[^SLN]+|[S]+(?![^S])|[S]+"
NOT_MERGED = (1 << 31) - 1
SIMPLE = 0x250  # texts of characters below this are split by the faster re module


def _classes() -> dict[str, str]:
    """The letters, numbers and white space below SIMPLE, escaped for a character class."""
    kinds: dict[str, list[str]] = {"L": [], "N": [], "S": []}
    for c in map(chr, range(SIMPLE)):
        if regex.match(r"\p{White_Space}", c):
            kinds["S"].append(c)
        elif regex.match(r"[\p{L}\p{N}]", c):
            kinds["L" if regex.match(r"\p{L}", c) else "N"].append(c)
    return {k: "".join(map(re.escape, v)) for k, v in kinds.items()}


def _pattern(classes: dict[str, str]) -> str:
    return re.sub("[LNS]", lambda m: classes[m[0]], SPLIT)


@lru_cache(maxsize=1)
def _patterns() -> tuple[re.Pattern, re.Pattern, regex.Pattern]:
    whole = {"L": r"\p{L}", "N": r"\p{N}", "S": r"\p{White_Space}"}
    return re.compile(f"[^\\x00-\\u{SIMPLE - 1:04x}]"), re.compile(_pattern(_classes())), regex.compile(_pattern(whole))


def split_words(text: str) -> list[str]:
    """The words of a text without special tokens."""
    rare, simple, whole = _patterns()
    return (whole if rare.search(text) else simple).findall(text)


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies.

    Printable Latin-1 characters stand for themselves; the others, in order, for the
    characters from U+0100 on.
    """
    out, spare = [], 256
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            out.append(chr(b))
        else:
            out.append(chr(spare))
            spare += 1
    return out


class Vocabulary:
    """Ids, merge ranks and special tokens of a tokenizer file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        ids: dict[str, int] = spec["model"]["vocab"]
        self.special: dict[str, int] = {t["content"]: t["id"] for t in spec["added_tokens"]}
        byte_of = {c: b for b, c in enumerate(byte_characters())}
        size = max([*ids.values(), *self.special.values()], default=-1) + 1
        self.bytes_of: list[bytes] = [b""] * size
        for token, i in ids.items():
            self.bytes_of[i] = bytes(byte_of[c] for c in token)
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode("utf-8")
        self.id_of_byte = np.zeros(256, np.int64)
        for c, b in byte_of.items():
            self.id_of_byte[b] = ids[c]
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        left, right = (np.array([ids[m[side]] for m in merges], np.int64) for side in (0, 1))
        self.merged = np.array([ids[a + b] for a, b in merges], np.int64)  # by rank
        self.pairs = (left << 32) | right
        order = np.argsort(self.pairs)
        self.pairs, self.pair_ranks = self.pairs[order], order
        self.rank_of = {(int(a), int(b)): r for r, (a, b) in enumerate(zip(left, right))}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.specials = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if longest_first else None
        self.fixed = {t: (str(i), (i,)) for t, i in self.special.items()}
        self.cache: dict[str, tuple[str, tuple[int, ...]]] = dict(self.fixed)
        self.long: list[str] = []  # words of the last texts that are not worth remembering

    # -- words -----------------------------------------------------------------------
    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The merge rank of each pair of ids; NOT_MERGED where there is none."""
        pair = (left << 32) | right
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        return np.where((self.pairs[at] == pair) & (left >= 0) & (right >= 0), self.pair_ranks[at], NOT_MERGED)

    def _scan(self, words: list[bytes]) -> list[tuple[int, ...]]:
        """Merge short words, one a row: scan, delete a boundary, refresh its neighbours."""
        width = max(map(len, words))
        parts = np.full((len(words), width + 1), -1, np.int64)  # one empty part at the end
        for i, w in enumerate(words):
            parts[i, :len(w)] = np.frombuffer(w, np.uint8)
        parts = np.where(parts >= 0, self.id_of_byte[parts], -1)
        rank = self._ranks(parts[:, :-1], parts[:, 1:])
        done: list[tuple[int, ...]] = [()] * len(words)
        which, columns = np.arange(len(words)), np.arange(width + 1)
        while which.size:
            place = rank.argmin(axis=1)  # the leftmost of the smallest
            rows = np.arange(len(place))
            least = rank[rows, place]
            over = least == NOT_MERGED
            if over.any():
                for i, row in zip(which[over], parts[over].tolist()):
                    done[i] = tuple(row[:row.index(-1)])
                which, parts, rank, place, least = (x[~over] for x in (which, parts, rank, place, least))
                rows = np.arange(len(place))
                if not which.size:
                    break
            # delete the boundary after ``place``: what follows moves one to the left
            after = np.minimum(columns + (columns > place[:, None]), width)
            parts = np.take_along_axis(parts, after, axis=1)
            parts[rows, place] = self.merged[least]
            after = np.minimum(columns[:-1] + (columns[:-1] > place[:, None]), width - 1)
            rank = np.take_along_axis(rank, after, axis=1)
            rank[:, -1] = NOT_MERGED
            # refresh the two pairs that the new part is in
            rank[rows, place] = self._ranks(parts[rows, place], parts[rows, place + 1])
            before = np.flatnonzero(place > 0)
            at = place[before]
            rank[before, at - 1] = self._ranks(parts[before, at - 1], parts[before, at])
        return done

    def _heap(self, word: bytes) -> tuple[int, ...]:
        """The same merges for a long word, from a heap of (rank, place)."""
        rank_of, n = self.rank_of.get, len(word)
        part = self.id_of_byte[np.frombuffer(word, np.uint8)].tolist()
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, part[i], part[i + 1]) for i in range(n - 1)
                if (r := rank_of((part[i], part[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i]
            if part[i] != left or j >= n or part[j] != right:
                continue  # one of the two has changed since
            part[i], part[j] = int(self.merged[rank]), -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                if (r := rank_of((part[i], part[after[i]]))) is not None:
                    heapq.heappush(heap, (r, i, part[i], part[after[i]]))
            if before[i] >= 0 and (r := rank_of((part[before[i]], part[i]))) is not None:
                heapq.heappush(heap, (r, before[i], part[before[i]], part[i]))
        return tuple(p for p in part if p >= 0)

    def learn(self, words: set[str]) -> dict[str, tuple[str, tuple[int, ...]]]:
        """The table with ``words`` in it; it starts anew when it has grown too large."""
        for w in self.long:
            self.cache.pop(w, None)
        new = words - self.cache.keys()
        if len(self.cache) + len(new) > CACHE_WORDS:
            self.cache, new = dict(self.fixed), words - self.special.keys()
        coded = sorted(((w.encode("utf-8"), w) for w in new), key=lambda x: len(x[0]))
        short = [x for x in coded if len(x[0]) <= SHORT]
        for first in range(0, len(short), WORDS_AT_A_TIME):
            some = short[first:first + WORDS_AT_A_TIME]
            for (_, w), ids in zip(some, self._scan([b for b, _ in some])):
                self.cache[w] = (",".join(map(str, ids)), ids)
        for b, w in coded[len(short):]:
            ids = self._heap(b)
            self.cache[w] = (",".join(map(str, ids)), ids)
        self.long = [w for _, w in coded[len(short):]]
        return self.cache

    # -- texts -----------------------------------------------------------------------
    def encode_all(self, texts: list[str]) -> list[tuple[str, list[int]]]:
        """For each text all its ids, joined by commas and as a list."""
        pieces = [self.specials.split(t) if self.specials else [t] for t in texts]
        cut = [[w for p in row for w in ([p] if p in self.special else split_words(p))] for row in pieces]
        table = self.learn({w for words in cut for w in words})
        found = [[table[w] for w in words] for words in cut]
        return [(",".join([g[0] for g in got]), list(itertools.chain.from_iterable([g[1] for g in got]))) for got in found]

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0][1]

    def decode(self, ids) -> str:
        """The text of ``ids``; bytes that are not UTF-8 become replacement characters."""
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _some(column: pa.Array) -> Iterator[list[str]]:
    """The texts of a column, NULL as empty, a few at a time by their length."""
    some, size = [], 0
    for text in column:
        some.append(text.as_py() or "")
        size += len(some[-1])
        if size >= TEXT_AT_A_TIME:
            yield some
            some, size = [], 0
    if some:
        yield some


def _appended(schema: T.StructType, *fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([*schema.fields, *(T.StructField(n, t) for n, t in fields)])


def encode_documents(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the column ``ids``: array<int>, the token ids of the whole text."""
    [name] = fresh(docs, ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in batches:
            got = [ids for some in _some(batch.column(text)) for _, ids in v.encode_all(some)]
            yield batch.append_column(name, pa.array(got, pa.list_(pa.int32())))

    return docs.mapInArrow(run, _appended(docs.schema, (name, T.ArrayType(T.IntegerType()))))


def decode_documents(docs: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``docs`` with the column ``text``: the text that the token ids stand for."""
    [name] = fresh(docs, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in batches:
            got = [v.decode(i or ()) for i in batch.column(ids).to_pylist()]
            yield batch.append_column(name, pa.array(got, pa.string()))

    return docs.mapInArrow(run, _appended(docs.schema, (name, T.StringType())))


def round_trip_digests(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256): encode, decode and digest in one map.

    The id lists stay inside the task; only their digests leave it.
    """
    narrow = docs.select(key, text)
    schema = T.StructType([
        T.StructField(key, docs.schema[key].dataType), T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in batches:
            n, coded, decoded = [], [], []
            for some in _some(batch.column(1)):
                for joined, ids in v.encode_all(some):
                    n.append(len(ids))
                    coded.append(hashlib.sha256(joined.encode("ascii")).hexdigest())
                    decoded.append(hashlib.sha256(v.decode(ids).encode("utf-8")).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(coded, pa.string()), pa.array(decoded, pa.string())],
                names=[f.name for f in schema.fields])

    return narrow.mapInArrow(run, schema)


def encoded_with_check(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, ids, exact): the ids, and whether they decode to the text."""
    schema = T.StructType([
        T.StructField(key, docs.schema[key].dataType), T.StructField("n_tokens", T.LongType()),
        T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("exact", T.BooleanType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in batches:
            at = 0
            for some in _some(batch.column(1)):  # a batch's ids may be larger than its texts
                coded = [ids for _, ids in v.encode_all(some)]
                counts = [len(ids) for ids in coded]
                flat = np.fromiter(itertools.chain.from_iterable(coded), np.int32, sum(counts))
                offsets = pa.array([0, *itertools.accumulate(counts)], pa.int32())
                exact = [v.decode(ids) == t for t, ids in zip(some, coded)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(some)), pa.array(counts, pa.int64()),
                     pa.ListArray.from_arrays(offsets, pa.array(flat)), pa.array(exact, pa.bool_())],
                    names=[f.name for f in schema.fields])
                at += len(some)

    return docs.select(key, text).mapInArrow(run, schema)
