"""Byte-level BPE as a lazily determinised finite-state transducer, and streaming decoding.

**Encoding.**  A sequence of tokens is the BPE encoding of its bytes exactly if each token encodes to itself and no
merge crosses the border of two neighbours.  The merges thus compile into a non-deterministic transducer: it walks the
trie of the tokens, and where a token ends it may begin the next one if the two are neighbours that BPE leaves alone.
Of all paths over the same bytes exactly one ends on a token border.  Determinised, a state is the set of open paths,
which has two parts: their places in the trie, and the last whole token of each.  The places make the control states,
whose transitions are made when a text first asks for them; there are at most as many as trie nodes.  The last tokens
stand in registers, one for each byte that the longest token can reach back, for written out in the states they would
multiply these without end.  A step looks up the transition, takes of the tokens that end here the one that fits
the register where it begins, and sets the register of the new border.  A token is emitted when all open paths agree
on it, and as no path stays inside one token for more bytes than the longest token has, the lookahead is bounded.  Time
grows with the bytes alone, however long a piece is.

**Decoding.**  The well-formed byte sequences of UTF-8 are a machine of eight states.  Each token is compiled to its
effect on each state, so that a stream of ids moves the machine token by token; most tokens lead from the start to the
start, and only those that cut a character need a look.  Bytes of an unfinished character wait for the next ids.
"""

from __future__ import annotations

import base64
import hashlib
import re
import sys
import types
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.llm.rows import col, text_of

#: The vocabulary's ranks, one `base64 rank` a line.
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed: the pattern this vocabulary was made with, with its classes of letters, numbers and white space left open; its
#: matches are encoded one by one.
PATTERN = "'s|'t|'re|'ve|'m|'ll|'d| ?[{L}]+| ?[{N}]+| ?[^{S}{L}{N}]+|[{S}]+(?![^{S}])|[{S}]+"
#: Below this code point the classes are spelled out, for a faster engine.
NEAR = 0x250
#: A worker remembers so many pairs of neighbours (a table of 18 bytes each) and so many pieces (about 200 bytes each), and
#: forgets them all when there are more.
PAIRS, PIECES = 1 << 19, 200_000
#: Longer pieces are not remembered.
PIECE_CHARS = 64
#: Texts are cut between pieces into blocks of about so many characters, and ids are decoded in blocks of so many.
BLOCK_CHARS, BLOCK_IDS = 1 << 18, 1 << 16
#: The pieces of texts of about so many bytes walk together.
WALK_BYTES = 1 << 20
#: What the paths of a long piece agree on is emitted after every so many bytes.
EMIT = 4096


def merge_bytes(data: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Plain BPE of a few bytes: the pair of lowest rank is merged, the leftmost first, until none is left."""
    parts = [data[i : i + 1] for i in range(len(data))]
    while len(parts) > 1:
        found = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in ranks]
        if not found:
            break
        i = min(found)[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return [ranks[p] for p in parts]


def _split(token: bytes, rank: int, ranks: dict[bytes, int]) -> tuple[int, int] | None:
    """The two tokens that BPE merges last into ``token``; None where it never gets there."""
    parts = [token[i : i + 1] for i in range(len(token))]
    while len(parts) > 2:
        found = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in ranks]
        if not found:
            return None
        i = min(found)[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return (ranks[parts[0]], ranks[parts[1]]) if len(parts) == 2 else None


class Vocabulary:
    """What a job ships: the tokens, the last merge of each, and where the pattern's two libraries differ.

    ``splits`` has the two halves of each token of more than one byte (-1, -1 for single bytes), ``whole`` the ids of
    tokens that merging alone never reaches (they only stand for a piece that is exactly theirs), and ``rising`` tells
    that each merge comes after those it needs, as in every trained vocabulary.
    """

    def __init__(self, ranks: dict[bytes, int]):
        missing = [i for i in range(256) if bytes([i]) not in ranks]
        if missing:
            raise ValueError(f"not a byte-level vocabulary: no token for bytes {missing}")
        self.ranks = ranks
        self.splits = np.full((max(ranks.values()) + 1, 2), -1, np.int32)
        self.whole, self.rising = {}, True
        for token, rank in ranks.items():
            if len(token) > 1:
                halves = _split(token, rank, ranks)
                if halves is None:
                    self.whole[token] = rank
                else:
                    self.splits[rank] = halves
                    self.rising &= all(h < rank for h, b in zip(halves, self._halves(token, halves), strict=True) if b > 1)
        self.newer = _newer_code_points()
        lines = b"".join(b"%s %d\n" % (base64.b64encode(t), r) for t, r in sorted(ranks.items()))
        self.key = hashlib.sha256(lines).hexdigest()

    def _halves(self, token: bytes, halves: tuple[int, int]) -> tuple[int, int]:
        first = next(n for n in range(1, len(token)) if self.ranks.get(token[:n]) == halves[0])
        return first, len(token) - first


@lru_cache(maxsize=4)
def vocabulary(path: str = TOKENIZER) -> Vocabulary:
    """The vocabulary of a rank file, read and compiled once, on the driver."""
    with open(path, "rb") as f:
        return Vocabulary({base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)})


@lru_cache(maxsize=1)
def _newer_code_points() -> list[tuple[int, int]]:
    """Ranges of code points that ``regex`` calls letters or numbers and tiktoken's own engine, of an older Unicode, does
    not: both are asked for all code points."""
    import regex
    import tiktoken

    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    single = {bytes([i]): i for i in range(256)}
    ours, theirs = set(), set()
    for name in (r"\p{L}", r"\p{N}"):
        ours.update(regex.findall(name, every))
        theirs.update(bytes(tiktoken.Encoding("classes", pat_str=name, mergeable_ranks=single, special_tokens={}).encode_ordinary(every)).decode())
    out: list[tuple[int, int]] = []
    for c in sorted(map(ord, ours - theirs)):
        if out and out[-1][1] == c - 1:
            out[-1] = (out[-1][0], c)
        else:
            out.append((c, c))
    return out


class _PairTable:
    """Pairs with an answer of 0 or 1, in a hash table that is emptied when half full."""

    def __init__(self, pairs: int):
        self.bits = max(pairs.bit_length(), 4)
        self._empty()

    def _empty(self) -> None:
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.answers = np.full(1 << self.bits, -1, np.int8)
        self.n = 0

    def _slots(self, pairs: np.ndarray) -> np.ndarray:
        spread = pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)  # fixed: 2^64 over the golden ratio
        return (spread >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, pairs: np.ndarray) -> np.ndarray:
        """The answers, -1 where there is none."""
        slot, mask = self._slots(pairs), len(self.keys) - 1
        out, left = np.full(len(pairs), -1, np.int8), np.arange(len(pairs))
        while len(left):
            key = self.keys[slot[left]]
            hit = key == pairs[left]
            out[left[hit]] = self.answers[slot[left[hit]]]
            left = left[~hit & (key >= 0)]
            slot[left] = (slot[left] + 1) & mask
        return out

    def put(self, pairs: np.ndarray, answers: np.ndarray) -> None:
        """Add pairs that are not there."""
        mask = len(self.keys) - 1
        for slot, pair, answer in zip(self._slots(pairs).tolist(), pairs.tolist(), answers.tolist(), strict=True):
            if 2 * self.n > mask:
                self._empty()
            while self.keys[slot] >= 0:
                slot = (slot + 1) & mask
            self.keys[slot], self.answers[slot], self.n = pair, answer, self.n + 1


class _Grown:
    """Short lists of tuples by number, in one array that grows."""

    def __init__(self, longest: int, width: int = 1):
        self.rows, self.count, self.n = np.zeros((64, longest, width), np.int32), np.zeros(64, np.int32), 0

    def add(self, values: list) -> int:
        if self.n == len(self.rows):
            self.rows, self.count = np.concatenate([self.rows, self.rows]), np.concatenate([self.count, self.count])
        if len(values) > self.rows.shape[1]:
            self.rows = np.concatenate([self.rows, self.rows], axis=1)
            return self.add(values)
        self.rows[self.n, : len(values)] = np.reshape(values, (len(values), -1))
        self.count[self.n], self.n = len(values), self.n + 1
        return self.n - 1


class Transducer:
    """Bytes to token ids."""

    def __init__(self, vocab: Vocabulary):
        self.ranks, self.splits, self.rising = vocab.ranks, vocab.splits.tolist(), vocab.rising
        self.bytes_of = {rank: token for token, rank in vocab.ranks.items()}
        self.edges: dict[int, int] = {}  # trie node * 256 + byte -> node
        self.token_at, self.inner = [-1], [False]
        for token, rank in vocab.ranks.items():
            if token in vocab.whole:
                continue
            node = 0
            for b in token:
                self.inner[node] = True
                nxt = self.edges.get(node << 8 | b)
                if nxt is None:
                    nxt = self.edges[node << 8 | b] = len(self.token_at)
                    self.token_at.append(-1)
                    self.inner.append(False)
                node = nxt
            self.token_at[node] = rank
        self.depth = [0] * len(self.token_at)
        for place, child in self.edges.items():  # parents were numbered first
            self.depth[child] = self.depth[place >> 8] + 1
        self.length = np.zeros(len(self.splits), np.int32)
        for token, rank in vocab.ranks.items():
            self.length[rank] = len(token)
        self.left_edge: dict[int, list] = {}
        self.right_edge: dict[int, list] = {}
        self.pairs = _PairTable(PAIRS)
        # control states by number: the places of their open paths, and the number of the move under each byte
        self.places, self.number = [(0,)], {(0,): 0}
        self.table = np.full((1, 256), -1, np.int32)
        # moves by number: the next control state, and the tokens that end there with their lengths, the longest first
        self.next_state, self.ends = _Grown(1), _Grown(8, 2)
        self.read: dict[int, tuple[int, list]] = {}  # the moves that long pieces made, and their pairs
        self.met: dict[int, bool] = {}

    def _edge(self, token: int, side: int) -> list[tuple[bytes, int, int]]:
        """The token, its last part on one side, that part's last part, and so on: the bytes of each, the rank that makes
        it and the rank that merges it into the one before."""
        out, until = [], sys.maxsize
        while token >= 0:
            made = token if self.splits[token][0] >= 0 else -1
            out.append((self.bytes_of[token], made, until))
            token, until = self.splits[token][side], token
        return out

    def neighbours(self, left: int, right: int) -> bool:
        """Whether no merge ever joins parts of two tokens that stand side by side.

        The parts at the border are known at every rank: the right edge of the left token, the left edge of the right
        one.  A pair of them merges if its rank comes while both are there; of two merges of one rank the left goes first.
        """
        if not self.rising:
            return merge_bytes(self.bytes_of[left] + self.bytes_of[right], self.ranks) == [left, right]
        lefts, rights, ranks = self.right_edge.get(left), self.left_edge.get(right), self.ranks
        if lefts is None:
            lefts = self.right_edge[left] = self._edge(left, 1)
        if rights is None:
            rights = self.left_edge[right] = self._edge(right, 0)
        for a, a_made, a_until in lefts:
            for b, b_made, b_until in rights:
                rank = ranks.get(a + b)
                if rank is not None:
                    at = max(rank, a_made, b_made)
                    if at < a_until and at <= b_until:
                        return False
        return True

    def _move(self, state: int, byte: int) -> int:
        """The transition of a control state under a byte, made on first use."""
        children = [c for c in (self.edges.get(node << 8 | byte) for node in self.places[state]) if c is not None]
        places = (*[c for c in children if self.inner[c]], 0)  # on the border that is here a path begins
        new = self.number.get(places)
        if new is None:
            new = self.number[places] = len(self.places)
            self.places.append(places)
            if new == len(self.table):
                self.table = np.concatenate([self.table, np.full_like(self.table, -1)])
        ends = [(self.token_at[c], self.depth[c]) for c in children if self.token_at[c] >= 0]
        move = self.table[state, byte] = self.next_state.add([new])
        self.ends.add(ends)
        return int(move)

    def fits(self, pairs: np.ndarray) -> np.ndarray:
        """Whether the tokens of each pair (left << 32 | right) may stand side by side."""
        found = self.pairs.get(pairs)
        if (unknown := found < 0).any():
            asked, back = np.unique(pairs[unknown], return_inverse=True)
            answers = np.array([self.neighbours(p >> 32, p & 0xFFFFFFFF) for p in asked.tolist()], np.int8)
            self.pairs.put(asked, answers)
            found[unknown] = answers[back]
        return found.astype(bool)

    def encode_many(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces one after the other, how many each has); no piece is empty.  All walk together, byte by byte, the
        longest first in the rows."""
        length = np.array([len(p) for p in pieces], np.int64)
        order = np.argsort(-length, kind="stable")
        size, n, width = length[order], len(pieces), int(length.max(initial=0))
        at = np.arange(int(length.sum())) - np.repeat(np.cumsum(size) - size, size)
        data = np.zeros((width, n), np.uint8)
        data[at, np.repeat(np.arange(n), size)] = np.frombuffer(b"".join(pieces[i] for i in order), np.uint8)
        # the registers: border[i, row] is the token that ends i bytes on, -1 where the piece begins
        border, state = np.full((width + 1, n), -1, np.int32), np.zeros(n, np.int32)
        for i in range(1, width + 1):
            rows = int(np.searchsorted(-size, -i, "right"))
            here, byte = state[:rows], data[i - 1, :rows]
            move = self.table[here, byte]
            if (move < 0).any():
                for place in np.unique(here[move < 0] << 8 | byte[move < 0]).tolist():
                    self._move(place >> 8, place & 0xFF)
                move = self.table[here, byte]
            state[:rows] = self.next_state.rows[move, 0, 0]
            left, nth = np.arange(rows), 0
            while len(left):
                token, span = self.ends.rows[move, nth, 0], self.ends.rows[move, nth, 1]
                last = border[i - span, left]
                fit = (self.ends.count[move] == nth + 1) | (last < 0)  # one fits: the only one left, or the whole piece so far
                ask = np.flatnonzero(~fit)
                fit[ask] = self.fits(last[ask].astype(np.int64) << 32 | token[ask])
                border[i, left[fit]] = token[fit]
                left, move, nth = left[~fit], move[~fit], nth + 1
        # back from the end, border by border
        steps, at, rows, count = [], size.copy(), np.arange(n), np.zeros(n, np.int64)
        while len(rows):
            token = border[at[rows], rows]
            steps.append((rows, token))
            count[rows] += 1
            at[rows] -= self.length[token]
            rows = rows[at[rows] > 0]
        counts = np.empty(n, np.int64)
        counts[order] = count
        end, ids = np.cumsum(counts)[order], np.empty(int(counts.sum()), np.int32)
        for k, (rows, token) in enumerate(steps, 1):
            ids[end[rows] - k] = token
        return ids, counts

    def _agreed(self, border: list[int], open_at: set[int]) -> int:
        """The last border that the paths to all the given borders share."""
        while len(open_at) > 1:
            at = max(open_at)
            open_at.remove(at)
            open_at.add(at - int(self.length[border[at]]))
        return open_at.pop()

    def _path(self, border: list[int], at: int) -> list[int]:
        out = []
        while at:
            out.append(border[at])
            at -= int(self.length[border[at]])
        return out[::-1]

    def _read(self, state: int, byte: int) -> tuple[int, list]:
        """A move as plain numbers."""
        move = int(self.table[state, byte])
        if move < 0:
            move = self._move(state, byte)
        ends = self.ends.rows[move, : self.ends.count[move]].tolist()
        found = self.read[state << 8 | byte] = (int(self.next_state.rows[move, 0, 0]), ends)
        return found

    def _met(self, pair: int) -> bool:
        if len(self.met) >= PAIRS:
            self.met.clear()
        fits = self.met[pair] = bool(self.fits(np.array([pair]))[0])
        return fits

    def encode(self, piece: bytes) -> list[int]:
        """The ids of one piece of any length: what its open paths agree on is emitted as it is read."""
        out, border, at, state = [], [-1], 0, 0
        read, met = self.read, self.met
        for byte in piece:
            state, ends = read.get(state << 8 | byte) or self._read(state, byte)
            at += 1
            for token, length in ends:
                last = border[at - length]
                if last < 0:
                    break
                fits = met.get(last << 32 | token)
                if fits is None:
                    fits = self._met(last << 32 | token)
                if fits:
                    break
            border.append(token)
            if at == EMIT:
                agreed = self._agreed(border, {at - self.depth[node] for node in self.places[state]})
                out += self._path(border, agreed)
                border, at = border[agreed:], at - agreed
        return out + self._path(border, at)


class Encoder:
    """Texts to ids: pieces of the pattern, those not met before through the transducer together."""

    def __init__(self, vocab: Vocabulary):
        import regex

        self.transducer, self.whole = Transducer(vocab), vocab.whole
        self._forget()
        newer = "".join(f"\\U{a:08X}-\\U{b:08X}" for a, b in vocab.newer)
        less = f"--[{newer}]" if newer else ""
        self.exact = regex.compile(PATTERN.format(L=f"[\\p{{L}}{less}]", N=f"[\\p{{N}}{less}]", S=r"\s"), regex.V1)
        near = "".join(map(chr, range(min(NEAR, vocab.newer[0][0] if newer else NEAR))))
        spelled = {k: "".join(map(re.escape, regex.findall(p, near))) for k, p in (("L", r"\p{L}"), ("N", r"\p{N}"), ("S", r"\s"))}
        self.near, self.far = re.compile(PATTERN.format(**spelled)), re.compile(f"[^\0-{re.escape(near[-1])}]")
        self.border = re.compile(r"\S(?=\s)")

    def blocks(self, text: str) -> Iterator[str]:
        """The text cut where no piece can reach across: before white space that follows something else."""
        at = 0
        while len(text) - at > BLOCK_CHARS:
            border = self.border.search(text, at + BLOCK_CHARS)
            if border is None:
                break
            yield text[at : border.end()]
            at = border.end()
        yield text[at:]

    def _pieces(self, block: str) -> list[str]:
        return (self.exact if self.far.search(block) else self.near).findall(block)

    def _forget(self) -> None:
        # pieces by number; the ids of all, one piece after the other; where each begins, and the end of the last
        self.number: dict[str, int] = {}
        self.ids, self.begin = np.empty(0, np.int32), np.zeros(1, np.int64)

    def _learn(self, asked: set[str]) -> None:
        """Number all these pieces."""
        new = asked - self.number.keys()
        if len(self.number) + len(new) > PIECES:
            self._forget()
            new = asked
        data = {p: p.encode() for p in new}
        together = [p for p in new if len(p) <= PIECE_CHARS and data[p] not in self.whole]
        ids, counts = self.transducer.encode_many([data[p] for p in together])
        alone = [p for p in new.difference(together)]
        more = [[self.whole[data[p]]] if data[p] in self.whole else self.transducer.encode(data[p]) for p in alone]
        self.number.update(zip([*together, *alone], range(len(self.number), len(self.number) + len(new)), strict=True))
        counts = np.concatenate([counts, np.array([len(x) for x in more], np.int64)])
        self.ids = np.concatenate([self.ids, ids, *[np.array(x, np.int32) for x in more]])
        self.begin = np.concatenate([self.begin, self.begin[-1] + np.cumsum(counts)])
        if sum(map(len, alone)) > WALK_BYTES // 8:  # very long pieces are not kept beyond this round
            self.stale = True

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text.  Blocks of texts go through together, a few megabytes at a time."""
        out: list[list[np.ndarray]] = [[] for _ in texts]
        blocks = [(i, block) for i, text in enumerate(texts) for block in self.blocks(text)]
        begin = 0
        while begin < len(blocks):
            end, size = begin, 0
            while end < len(blocks) and size < WALK_BYTES:
                size, end = size + len(blocks[end][1]), end + 1
            self.stale = False
            pieces = [self._pieces(block) for _, block in blocks[begin:end]]
            self._learn(set(chain.from_iterable(pieces)))
            number = np.fromiter(map(self.number.__getitem__, chain.from_iterable(pieces)), np.int64, sum(map(len, pieces)))
            first, count = self.begin[number], self.begin[number + 1] - self.begin[number]
            upto = np.r_[0, np.cumsum(count)]
            ids = self.ids[np.repeat(first - upto[:-1], count) + np.arange(upto[-1])]
            ends = upto[np.cumsum([len(p) for p in pieces])]
            for (i, _), part in zip(blocks[begin:end], np.split(ids, ends[:-1]), strict=True):
                out[i].append(part)
            if self.stale:
                self._forget()
            begin = end
        return [np.concatenate(x) if len(x) > 1 else x[0] for x in out]

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text])[0]


#: The states of UTF-8: start; one, two or three more bytes of any kind; the restricted second bytes after E0, ED, F0 and
#: F4 (fixed by the standard's table of well-formed sequences).  BAD is no state: what was read is no part of a character.
START, ONE, TWO, THREE, AFTER_E0, AFTER_ED, AFTER_F0, AFTER_F4, BAD = range(9)


@lru_cache(maxsize=1)
def utf8_machine() -> np.ndarray:
    """next state by (state, byte)."""
    t = np.full((9, 256), BAD, np.int8)
    t[START, :0x80] = START
    t[START, 0xC2:0xE0] = ONE
    t[START, 0xE0:0xF0] = TWO
    t[START, 0xF0:0xF5] = THREE
    t[START, [0xE0, 0xED, 0xF0, 0xF4]] = AFTER_E0, AFTER_ED, AFTER_F0, AFTER_F4
    t[ONE, 0x80:0xC0], t[TWO, 0x80:0xC0], t[THREE, 0x80:0xC0] = START, ONE, TWO
    t[AFTER_E0, 0xA0:0xC0] = t[AFTER_ED, 0x80:0xA0] = ONE
    t[AFTER_F0, 0x90:0xC0] = t[AFTER_F4, 0x80:0x90] = TWO
    return t


class Tokens:
    """The bytes of all tokens, and the effect of each token on the states of UTF-8."""

    def __init__(self, vocab: Vocabulary):
        self.by_id: list[bytes | None] = [None] * len(vocab.splits)
        for token, rank in vocab.ranks.items():
            self.by_id[rank] = token
        length = np.array([len(t or b"") for t in self.by_id], np.int64)
        data = np.frombuffer(b"".join(t or b"" for t in self.by_id), np.uint8)
        start = np.r_[0, np.cumsum(length)[:-1]]
        machine = utf8_machine()
        self.effect = np.repeat(np.arange(9, dtype=np.int8)[:, None], len(length), axis=1)
        for at in range(int(length.max())):
            some = np.flatnonzero(length > at)
            self.effect[:, some] = machine[self.effect[:, some], data[start[some] + at]]

    def bytes_of(self, ids: np.ndarray) -> bytes:
        """The bytes of a stream of ids."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.by_id)):
            raise ValueError("ids that are not in the vocabulary")
        try:
            return b"".join(map(self.by_id.__getitem__, ids.tolist()))
        except TypeError:
            raise ValueError("ids that are not in the vocabulary") from None


class StreamDecoder:
    """Ids to text, block by block: :meth:`feed` returns the characters that are whole so far, :meth:`finish` the rest.

    A byte that belongs to no character is replaced by U+FFFD, as is a character that breaks off (one for the longest
    part of a character that was read, as Python's ``errors="replace"`` does).
    """

    def __init__(self, tokens: Tokens):
        self.tokens, self.state, self.waiting = tokens, START, b""

    def feed(self, ids: np.ndarray) -> str:
        tokens, state = self.tokens, self.state
        data = tokens.bytes_of(ids)
        cuts = np.flatnonzero(tokens.effect[START][ids] != START)  # only these leave the start
        at, next_cut = 0, 0
        while at < len(ids) and state != BAD:
            if state == START:
                next_cut = int(np.searchsorted(cuts, at))
                if next_cut == len(cuts):
                    break
                at = int(cuts[next_cut])
            state = int(tokens.effect[state, ids[at]])
            at += 1
        if state == BAD:
            return self._replaced(data)
        whole = self.waiting + data
        self.state = state
        if state == START:
            self.waiting = b""
            return whole.decode()
        keep = 1  # an unfinished character begins at its lead byte, at most three bytes back
        while whole[-keep] & 0xC0 == 0x80:
            keep += 1
        self.waiting = whole[-keep:]
        return whole[:-keep].decode()

    def _replaced(self, data: bytes) -> str:
        """The same byte by byte, for streams that are no UTF-8."""
        machine, out = utf8_machine(), []
        state, waiting = self.state, bytearray(self.waiting)
        for b in data:
            after = int(machine[state, b])
            if after == BAD and state != START:  # what was read breaks off; this byte begins anew
                out.append("�")
                waiting.clear()
                after = int(machine[START, b])
            if after == BAD:
                out.append("�")
                after = START
                waiting.clear()
            else:
                waiting.append(b)
                if after == START:
                    out.append(waiting.decode())
                    waiting.clear()
            state = after
        self.state, self.waiting = state, bytes(waiting)
        return "".join(out)

    def finish(self) -> str:
        cut = bool(self.waiting)
        self.state, self.waiting = START, b""
        return "�" if cut else ""


def streamed(tokens: Tokens, ids: np.ndarray) -> str:
    """The text of ids, decoded block by block."""
    stream = StreamDecoder(tokens)
    return "".join([*(stream.feed(ids[at : at + BLOCK_IDS]) for at in range(0, len(ids), BLOCK_IDS)), stream.finish()])


def _kept(key: str, make: Callable):
    """``make()``, kept as long as the Python worker lives; tasks bring their own copies of this module's functions, so
    what they share stands in a module of its own."""
    shelf = sys.modules.setdefault("_tallyframe_byte_bpe", types.ModuleType("_tallyframe_byte_bpe")).__dict__
    if key not in shelf:
        shelf[key] = make()
    return shelf[key]


def _encoded(docs: DataFrame, id_col: str, text_col: str, tokenizer: str, back: bool) -> DataFrame:
    vocab = vocabulary(tokenizer)
    rows = docs.select(col(id_col).alias("id"), text_of(text_col).alias("t"))
    names = ["id", "ids", "text"] if back else ["id", "ids"]
    schema = f"id {rows.schema['id'].dataType.simpleString()}, ids array<int>" + ", text string" * back

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _kept("e" + vocab.key, lambda: Encoder(vocab))
        tokens = _kept("d" + vocab.key, lambda: Tokens(vocab)) if back else None
        for batch in batches:
            for a, b in _spans(pc.binary_length(batch.column("t")).to_pylist()):
                part = batch.slice(a, b - a)
                ids = encoder.encode_all(part.column("t").to_pylist())
                ends = np.cumsum([0, *map(len, ids)])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(ids)))
                texts = [pa.array([streamed(tokens, x) for x in ids], pa.string())] if back else []
                yield pa.RecordBatch.from_arrays([part.column("id"), lists, *texts], names)

    return rows.mapInArrow(run, schema)


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER) -> DataFrame:
    """One row per document: id, ids (array of int), the tokens of its whole text.

    A null text is empty and has no ids; a null or repeated id is kept as it is, each row for itself; ties don't occur.
    Texts of any length are encoded in blocks cut between pieces.  Extra columns are not looked at.  The vocabulary is
    read on the driver and travels with the job.
    """
    return _encoded(docs, id_col, text_col, tokenizer, back=False)


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER) -> DataFrame:
    """:func:`encode` with ``text``, decoded from the ids again as :func:`decode` does, in the same tasks."""
    return _encoded(docs, id_col, text_col, tokenizer, back=True)


def _spans(sizes: list[int], limit: int = WALK_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows with about ``limit`` bytes together, so that what a task holds beside its batch is bounded by that and
    by its longest row."""
    total, begin = 0, 0
    for i, n in enumerate(sizes):
        total += n
        if total >= limit:
            yield begin, i + 1
            total, begin = 0, i + 1
    if begin < len(sizes):
        yield begin, len(sizes)


def decode(encoded: DataFrame, ids_col: str = "ids", out_col: str = "text", tokenizer: str = TOKENIZER) -> DataFrame:
    """The rows of ``encoded`` with their ids decoded, as a stream of blocks, to a text ``out_col`` in their place.

    Null ids give an empty text; bytes that are no UTF-8 are replaced by U+FFFD; an id outside the vocabulary (null
    ones too) raises.  All other columns stay as they are, one that is called ``out_col`` already excepted: it goes.
    """
    vocab = vocabulary(tokenizer)
    others = [c for c in encoded.columns if c not in (ids_col, out_col)]
    rows = encoded.select(*[col(c).alias(f"c{i}") for i, c in enumerate(others)], col(ids_col).cast("array<int>").alias("ids"))
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _kept("d" + vocab.key, lambda: Tokens(vocab))
        for batch in batches:
            lists = batch.columns[-1]
            ids, ends = pc.fill_null(lists.values, -1).to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            for first, last in _spans((4 * np.diff(ends)).tolist()):
                texts = [streamed(tokens, ids[a:b]) for a, b in zip(ends[first:last], ends[first + 1 : last + 1], strict=True)]
                others = [c.slice(first, last - first) for c in batch.columns[:-1]]
                yield pa.RecordBatch.from_arrays([*others, pa.array(texts, pa.string())], schema.names)

    return rows.mapInArrow(run, schema).toDF(*others, out_col)
