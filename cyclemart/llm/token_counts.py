"""Token counts of whole texts by compiled finite-state transducers.

A tokenizer that cuts words by a pattern and merges the bytes of a word by ranked pairs is
compiled, transition by transition as texts need them, into one deterministic transducer
over UTF-8 bytes whose transitions carry the number of tokens they emit.

*Merging as a machine.*  A sequence of tokens is the encoding of its bytes exactly if each
two neighbours stay apart when they are encoded alone.  So the encoding of every prefix of a
word ends in exactly one token, and that token is found from the prefixes before it.  After
``i`` bytes the state holds, for each place ``j`` from which a token may still grow, the trie
node reached from ``j``, the last token of the prefix of length ``j`` and its count less that
of the prefix of length ``i``.  A byte moves the nodes on, and the one node that is a token
compatible with its last token gives the new prefix's.  A transition emits the difference of
the two counts (it may be negative when a longer token takes over), the end of a word what
its last token adds.

*The other layers.*  A splitting machine over characters (letters, one number, runs of other
characters, contractions after an apostrophe) runs the merging machine inside its words; case
is folded, and the bytes of a character are gathered, in the same states.  Only canonical
composition, where a text is not in NFC, and special tokens written in a text are handled
before the transducer: special tokens count one each and cut the text.

*Parallel runs.*  The texts of a batch are cut into chunks, which advance in lockstep, a byte
of every chunk a step.  White space sends every state to the start, so the state map of a
chunk is a constant behind its first white space.  A prefix scan (the nearest such chunk at or
before each) composes the maps: it gives the state in which each chunk begins, and the heads
are run from there.  Chunks without white space are composed one after the other.

Nothing is shuffled; a task keeps its transducer, and starts it anew when it has grown past
``MAX_STATES``.  Defined cases: NULL and empty texts have no tokens; texts of any length are
counted whole; repeated rows are counted alike; other columns are kept out of the result.
Letters and numbers are those of the Unicode version of the ``regex`` module.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cyclemart.llm.bpe import byte_characters

CHUNK = 512  # bytes of a text that advance in one lane
TEXT_AT_A_TIME = 1 << 20  # characters whose chunks advance together
MAX_STATES = 150_000  # a transducer larger than this starts anew with the next texts
SCALAR_ROUNDS = 4  # rounds of composing before long heads are run one by one

#: The pattern and the end-of-word mark of vocabularies of this kind.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SHORT_CONTRACTIONS, LONG_CONTRACTIONS = "stmd", {"r": "e", "v": "e", "l": "l"}
WORD_END = "</w>"

END = -2  # the symbol that stands for the end of a word
BIAS, EMIT_BITS = 1 << 6, 8  # an entry is (next state << EMIT_BITS) + emitted tokens + BIAS


class Merges:
    """The merging machine: states of the encodings of all prefixes of a word."""

    def __init__(self, spec: dict) -> None:
        ids: dict[str, int] = spec["model"]["vocab"]
        byte_of = {c: b for b, c in enumerate(byte_characters())}
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.rank_of: dict[tuple[int, int], tuple[int, int]] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for rank, (a, b) in enumerate(merges):
            whole = ids[a + b]
            self.rank_of.setdefault((ids[a], ids[b]), (rank, whole))
            self.parts.setdefault(whole, (rank, ids[a], ids[b]))
        self.trie: list[dict[int, int]] = [{}]
        self.token: list[int] = [-1]  # the token that ends at a node
        self.spelt: dict[int, list[int]] = {}  # base tokens of each token
        for text, i in ids.items():
            final = text.endswith(WORD_END) and text != WORD_END
            symbols = [byte_of[c] for c in (text[:-len(WORD_END)] if final else text)]
            node = 0
            for s in [*symbols, END] if final else symbols:
                if s not in self.trie[node]:
                    self.trie[node][s] = len(self.trie)
                    self.trie.append({})
                    self.token.append(-1)
                node = self.trie[node][s]
            self.token[node] = i
            letters = text[:-len(WORD_END)] if final else text
            self.spelt[i] = [ids[c + (WORD_END if final and k == len(letters) - 1 else "")] for k, c in enumerate(letters)]
        self.own: dict[int, bool] = {}
        self.fits: dict[tuple[int, int], bool] = {}
        self.spines: dict[tuple[int, int], list[tuple[int, int]]] = {}
        self.known: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.moves: dict[tuple[int, int], tuple[int, int]] = {}
        self.start = self._state(((0, -1, 0),))

    def encode(self, symbols: list[int]) -> list[int]:
        """Merge base tokens by rank, leftmost first: the definition."""
        symbols = list(symbols)
        while True:
            best = min(((self.rank_of[p][0], i) for i, p in enumerate(zip(symbols, symbols[1:])) if p in self.rank_of), default=None)
            if best is None:
                return symbols
            i = best[1]
            symbols[i:i + 2] = [self.rank_of[symbols[i], symbols[i + 1]][1]]

    def is_own(self, token: int) -> bool:
        """Whether the encoding of a token's bytes is that token."""
        if token not in self.own:
            self.own[token] = self.encode(self.spelt[token]) == [token]
        return self.own[token]

    def _spine(self, token: int, side: int) -> list[tuple[int, int]]:
        """(part, rank of the merge that consumes it) of the parts at one edge of a token."""
        if (token, side) not in self.spines:
            out, part, consumed = [], token, 1 << 60
            while True:
                out.append((part, consumed))
                if part not in self.parts:
                    break
                consumed, part = self.parts[part][0], self.parts[part][side]
            self.spines[token, side] = out
        return self.spines[token, side]

    def compatible(self, a: int, b: int) -> bool:
        """Whether two tokens stay apart when they are encoded together: no merge across the
        border comes before the merges that consume what lies there; of equal pairs the
        leftmost merges first."""
        if (a, b) not in self.fits:
            rank_of = self.rank_of.get
            self.fits[a, b] = self.is_own(a) and self.is_own(b) and not any(
                (r := rank_of((x, y))) is not None and r[0] < until_x and r[0] <= until_y
                for x, until_x in self._spine(a, 2) for y, until_y in self._spine(b, 1))
        return self.fits[a, b]

    def _state(self, growing: tuple) -> int:
        if growing not in self.known:
            self.known[growing] = len(self.states)
            self.states.append(growing)
        return self.known[growing]

    def _follows(self, last: int, token: int) -> bool:
        return self.is_own(token) if last < 0 else self.compatible(last, token)

    def move(self, state: int, byte: int) -> tuple[int, int]:
        """(next state, tokens emitted) of a byte inside a word."""
        if (state, byte) not in self.moves:
            new, last, more = [], None, 0
            for node, before, less in self.states[state]:
                to = self.trie[node].get(byte)
                if to is None:
                    continue
                if last is None and self.token[to] >= 0 and self._follows(before, self.token[to]):
                    last, more = self.token[to], less + 1
                if self.trie[to]:
                    new.append((to, before, less))
            if last is None:
                raise ValueError("the vocabulary lacks a base token")
            growing = tuple((to, before, less - more) for to, before, less in new) + ((0, last, 0),)
            self.moves[state, byte] = self._state(growing), more
        return self.moves[state, byte]

    def finish(self, state: int) -> int:
        """Tokens emitted at the end of a word."""
        if (state, END) not in self.moves:
            for node, before, less in self.states[state]:
                to = self.trie[node].get(END)
                if to is not None and self._follows(before, self.token[to]):
                    self.moves[state, END] = 0, less + 1
                    break
            else:
                raise ValueError("the vocabulary lacks a base token at the end of a word")
        return self.moves[state, END][1]


@lru_cache(maxsize=1)
def character_classes() -> bytes:
    """L, N, S (white space) or O (other) of every code point."""
    out = bytearray(b"O" * 0x110000)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for name, pattern in ((b"L", r"\p{L}"), (b"N", r"\p{N}"), (b"S", r"\p{White_Space}")):
        for m in regex.finditer(pattern + "+", every):
            first, last = ord(m[0][0]), ord(m[0][-1])
            if last - first + 1 == len(m[0]):
                out[first:last + 1] = name * len(m[0])
            else:  # a run across the surrogates
                for c in m[0]:
                    out[ord(c)] = name[0]
    return bytes(out)


class Transducer:
    """The whole tokenizer as one lazily compiled machine over the bytes of a text.

    A state is (mode, state of the merging machine, bytes of an unfinished character).  The
    modes are S (at the start of a match), L (in letters), O (in other characters) and Q, Qr,
    Qv, Ql (an apostrophe at the start of a match, and what followed it).
    """

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            self.spec = json.load(f)
        special = sorted((t["content"] for t in self.spec["added_tokens"]), key=len, reverse=True)
        self.specials = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        self.special = set(special)
        self.classes = character_classes()
        self.reset()

    def reset(self) -> None:
        self.merges = Merges(self.spec) if not hasattr(self, "merges") else self._fresh_merges()
        self.known: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.column = np.full(256, -1, np.int16)  # of the bytes that have been seen
        self.byte: list[int] = []
        self.table = np.full((1024, 32), -1, np.int32)
        self.ends = np.full(1024, -1, np.int64)
        self.start = self.state(("S", 0, b""))

    def _fresh_merges(self) -> Merges:
        m = self.merges
        m.known, m.states, m.moves, m.fits = {}, [], {}, {}
        m.start = m._state(((0, -1, 0),))
        return m

    def state(self, key: tuple) -> int:
        if key not in self.known:
            n = self.known[key] = len(self.states)
            self.states.append(key)
            if n == len(self.table):
                self.table = np.concatenate([self.table, np.full_like(self.table, -1)])
                self.ends = np.concatenate([self.ends, np.full_like(self.ends, -1)])
        return self.known[key]

    # -- the machine over characters ------------------------------------------------------
    def _word(self, characters: str) -> int:
        """Tokens of a whole word."""
        at, n = self.merges.start, 0
        for byte in characters.encode("utf-8"):
            at, more = self.merges.move(at, byte)
            n += more
        return n + self.merges.finish(at)

    def _end(self, mode: str, inner: int) -> int:
        """Tokens emitted if the match ends here."""
        if mode == "S":
            return 0
        if mode in "LO":
            return self.merges.finish(inner)
        return self._word("'") + (self._word(mode[1:]) if mode[1:] else 0)

    def _into(self, mode: str, inner: int, c: str, n: int) -> tuple[str, int, int]:
        for byte in c.encode("utf-8"):
            inner, more = self.merges.move(inner, byte)
            n += more
        return mode, inner, n

    def step(self, mode: str, inner: int, c: str) -> tuple[str, int, int]:
        """(mode, inner state, tokens emitted) after a case-folded character."""
        kind, start = chr(self.classes[ord(c)]), self.merges.start
        n = 0
        if mode == "Q":
            if c in SHORT_CONTRACTIONS:
                return "S", 0, self._word("'" + c)
            if c in LONG_CONTRACTIONS:
                return "Q" + c, 0, 0
            if kind == "O":  # the apostrophe begins a run of other characters
                mode, inner, n = self._into("O", start, "'", 0)
            else:
                mode, n = "S", self._word("'")
        elif mode[0] == "Q":
            if LONG_CONTRACTIONS[mode[1]] == c:
                return "S", 0, self._word("'" + mode[1:] + c)
            n = self._word("'")
            mode, inner, n = self._into("L", start, mode[1:], n)
        if mode in "LO" and kind == mode:
            return self._into(mode, inner, c, n)
        n += self._end(mode, inner)
        if kind == "S":
            return "S", 0, n
        if kind == "N":
            return "S", 0, n + self._word(c)
        if c == "'":
            return "Q", 0, n
        return self._into(kind, start, c, n)

    # -- the machine over bytes -----------------------------------------------------------
    def compile(self, state: int, column: int) -> None:
        """Fill in one transition."""
        mode, inner, part = self.states[state]
        raw = part + bytes([self.byte[column]])
        n = 0
        need = 1 if raw[0] < 0xC0 else 2 if raw[0] < 0xE0 else 3 if raw[0] < 0xF0 else 4
        if len(raw) < need:
            to = self.state((mode, inner, raw))
        else:
            for c in fold(raw.decode("utf-8", "replace")):
                mode, inner, more = self.step(mode, inner, c)
                n += more
            to = self.state((mode, inner, b""))
        if not 0 <= n + BIAS < 1 << EMIT_BITS:
            raise OverflowError("a transition emits too many tokens")
        self.table[state, column] = (to << EMIT_BITS) + n + BIAS

    def finish(self, states: np.ndarray) -> np.ndarray:
        """Tokens emitted at the end of a text, for an array of states."""
        for s in np.unique(states[self.ends[states] < 0]).tolist():
            mode, inner, part = self.states[s]
            n = 0
            if part:  # bytes that are no character
                for c in part.decode("utf-8", "replace"):
                    mode, inner, more = self.step(mode, inner, c)
                    n += more
            self.ends[s] = n + self._end(mode, inner)
        return self.ends[states]

    def columns(self, data: np.ndarray) -> np.ndarray:
        """The table's column of every byte; bytes that act alike share one."""
        data = FOLDED[data]
        for b in np.flatnonzero(np.bincount(data, minlength=256)).tolist():
            if self.column[b] < 0:
                self.column[b] = len(self.byte)
                self.byte.append(b)
                if len(self.byte) > self.table.shape[1]:
                    self.table = np.concatenate([self.table, np.full_like(self.table, -1)], axis=1)
        return self.column[data]

    def advance(self, columns: np.ndarray, begin: np.ndarray, end: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(state, tokens emitted) of lanes that run over [begin, end) from a state each."""
        order = np.argsort(begin - end, kind="stable")  # the longest first: what is active is a prefix
        lengths = (end - begin)[order]
        at, now = begin[order], state[order].copy()
        emitted = np.zeros(len(now), np.int64)
        active = np.searchsorted(-lengths, -np.arange(int(lengths[0])) if lengths.size else np.empty(0), "left")
        for step, m in enumerate(active.tolist()):
            place = now[:m] * self.table.shape[1]
            place += columns.take(at[:m] + step)
            entry = self.table.reshape(-1).take(place)
            if entry.min() < 0:
                for missing in np.unique(place[entry < 0]).tolist():
                    self.compile(*divmod(missing, self.table.shape[1]))
                entry = self.table.reshape(-1).take(place)
            now[:m] = entry >> EMIT_BITS
            emitted[:m] += entry & ((1 << EMIT_BITS) - 1)
        out_state, out_emitted = np.empty_like(now), np.empty_like(emitted)
        out_state[order], out_emitted[order] = now, emitted - BIAS * lengths
        return out_state, out_emitted

    def _advance_one(self, columns: np.ndarray, begin: int, end: int, state: int) -> tuple[int, int]:
        """``advance`` for one long lane."""
        n = 0
        for column in columns[begin:end].tolist():
            entry = int(self.table[state, column])
            if entry < 0:
                self.compile(state, column)
                entry = int(self.table[state, column])
            state = entry >> EMIT_BITS
            n += (entry & ((1 << EMIT_BITS) - 1)) - BIAS
        return state, n

    def count(self, data: np.ndarray, offsets: np.ndarray, chunk: int = CHUNK) -> np.ndarray:
        """Tokens of each piece of text, given as bytes in NFC without special tokens."""
        pieces = len(offsets) - 1
        total = np.zeros(pieces, np.int64)
        lengths = np.diff(offsets)
        if not lengths.any():
            return total
        columns = self.columns(data)
        # lanes: the chunks of all pieces
        per = -(-lengths // chunk)
        piece = np.repeat(np.arange(pieces), per)
        number = np.arange(len(piece)) - np.repeat(np.cumsum(per) - per, per)
        begin = offsets[:-1][piece] + number * chunk
        end = np.minimum(begin + chunk, offsets[1:][piece])
        # the part of a lane's state map that is constant: behind its first white space
        spaces = np.flatnonzero(WHITE[data])
        where = np.searchsorted(spaces, begin)
        after = np.append(spaces, len(data))[where] + 1
        opens = number == 0
        constant = opens | (after <= end)
        tail = np.where(opens, begin, np.minimum(after, end))
        ran = np.flatnonzero(constant)
        state = np.full(len(piece), self.start)
        state[ran], more = self.advance(columns, tail[ran], end[ran], np.full(len(ran), self.start))
        np.add.at(total, piece[ran], more)
        # compose: heads begin in the state that the lane before ends in; lanes whose map is
        # not constant are known once the nearest constant one before them has been passed on
        nearest = np.maximum.accumulate(np.where(constant, np.arange(len(piece)), -1))
        depth = np.arange(len(piece)) - nearest
        heads = np.flatnonzero(~opens)
        rounds = np.where(constant, 0, depth)  # constant lanes need only what is before them
        for r in range(1, min(int(rounds.max()), SCALAR_ROUNDS) + 1):
            lanes = np.flatnonzero(rounds == r)
            state[lanes], more = self.advance(columns, begin[lanes], end[lanes], state[lanes - 1])
            np.add.at(total, piece[lanes], more)
        for lane in np.flatnonzero(rounds > SCALAR_ROUNDS).tolist():
            state[lane], more = self._advance_one(columns, int(begin[lane]), int(end[lane]), int(state[lane - 1]))
            total[piece[lane]] += more
        heads = heads[constant[heads]]
        _, more = self.advance(columns, begin[heads], tail[heads], state[heads - 1])
        np.add.at(total, piece[heads], more)
        last = np.flatnonzero(np.append(piece[1:] != piece[:-1], True))
        np.add.at(total, piece[last], self.finish(state[last]))
        return total

    # -- texts --------------------------------------------------------------------------
    def count_texts(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text."""
        if len(self.states) > MAX_STATES:
            self.reset()
        pieces, owner = [], []
        found = np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            if self.specials and self.specials.search(text):
                parts = self.specials.split(text)
                found[i] = sum(p in self.special for p in parts)
                parts = [p for p in parts if p and p not in self.special]
            else:
                parts = [text]
            for p in parts:
                pieces.append((p if p.isascii() else unicodedata.normalize("NFC", p)).encode("utf-8"))
                owner.append(i)
        if pieces:
            offsets = np.concatenate(([0], np.cumsum([len(p) for p in pieces])))
            counts = self.count(np.frombuffer(b"".join(pieces), np.uint8), offsets)
            np.add.at(found, np.array(owner), counts)
        return found


def fold(characters: str) -> str:
    """Lower case, character by character: the final sigma has no form of its own."""
    return "".join("σ" if c == "Σ" else c.lower() for c in characters)


def _folded() -> np.ndarray:
    """Bytes that act alike are one: A-Z as a-z, ASCII white space as the space.  Digits are
    not folded, as a vocabulary need not give each one token."""
    out = np.arange(256, dtype=np.uint8)
    out[ord("A"):ord("Z") + 1] += 32
    out[[0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 0x20
    return out


FOLDED = _folded()
WHITE = FOLDED == 0x20


@lru_cache(maxsize=2)
def transducer(path: str) -> Transducer:
    return Transducer(path)


def _some(column: pa.Array) -> Iterator[list[str]]:
    some, size = [], 0
    for text in column:
        some.append(text.as_py() or "")
        size += len(some[-1])
        if size >= TEXT_AT_A_TIME:
            yield some
            some, size = [], 0
    if some:
        yield some


def count_tokens(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_bytes, n_tokens) of every row: the bytes and tokens of its whole text."""
    schema = T.StructType([
        T.StructField(key, docs.schema[key].dataType), T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(path)
        for batch in batches:
            column = batch.column(1)
            sizes = pc.fill_null(pc.binary_length(column.cast(pa.large_binary())), 0).cast(pa.int64())
            counts = [machine.count_texts(some) for some in _some(column)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), sizes, pa.array(np.concatenate(counts) if counts else np.empty(0, np.int64))],
                names=[key, "n_bytes", "n_tokens"])

    return docs.select(key, text).mapInArrow(run, schema)


def over_limit(counts: DataFrame, limit: int) -> DataFrame:
    """``counts`` with whether a text has more tokens than ``limit``."""
    return counts.withColumn("over_limit", F.col("n_tokens") > limit)
