"""Subword encoding with seeded merge-dropout, and decoding (operator 8).

A public model file of the merge type gives pieces and their order; nothing is trained.
Encoding replaces blanks by the marker, puts one marker in front, and merges from
single letters by an agenda: the pair with the best piece first, then the leftmost.
A candidate that comes up is skipped if a hash keyed by seed, text, word, the word's
occurrence in the text and place falls below the dropout, so each occurrence has a
segmentation of its own, and the same seed and text give the same ones everywhere.
Without dropout the ids equal the public library's. What no piece covers becomes bytes.
Decoding joins pieces and bytes and takes away the first marker, so every text comes back
exactly, whatever was skipped.

Pieces have markers in front only, so words (with the blanks before them) are encoded on
their own, many together in arrays. Which candidates come up depends only on the word and
the skips before, so what is remembered is a tree for each word: a node has the ids
without another skip and the candidates on the way, and each candidate leads to the node
in which it is skipped. An occurrence goes down the tree by its own hashes, and new nodes
are made when they are first met. The memory is bounded, and what it holds changes no
result. Words are found in the bytes of a batch, so no object is made for an occurrence.

Defined results: null text has null ids; empty text has none. A marker letter in the
text itself is encoded as bytes, so it comes back as it was. Repeated rows get equal
results. Extra columns are carried by `encode`, whatever their names.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import fresh, release, small_batches, tidy

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
DROPOUT = 0.1
SEED = 3
#: Nodes that a worker remembers.
REMEMBERED = 300_000
MARK = "▁"
RAW_MARK = MARK.encode()
#: Letters of a word up to which it is encoded with others, and words that are.
LONG = 48
TOGETHER = 4096
#: Bytes of text that go together (one text at least), and words that go down their trees together.
BYTES = 1 << 20
WALK = 1 << 17
GOLDEN = 0x9E3779B97F4A7C15
#: In pairs of pieces: bits of one, and what stands for no piece.
SIDE = 21
NONE = (1 << SIDE) - 1


class Codec:
    """Pieces of a model file, given as bytes."""

    def __init__(self, model: bytes):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = sp.get_piece_size()
        self.rank: dict[str, tuple[float, int]] = {}
        self.byte, self.out = [0] * 256, [b""] * n
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte[int(piece[3:5], 16)] = i
                self.out[i] = bytes([int(piece[3:5], 16)])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.rank[piece] = (-sp.get_score(i), i)
                self.out[i] = piece.replace(MARK, " ").encode()
        if any(MARK in p.lstrip(MARK) for p in self.rank):
            raise ValueError("a piece has a marker after other letters")
        if n + 0x110000 >= NONE:
            raise ValueError("a model with too many pieces")
        self.pieces = pa.array(self.out, pa.binary())
        self.lines = not any(len(p) > 1 and "\n" in p for p in self.rank)
        #: What each letter is: its piece, or n + its number if it has none.
        self.single = np.arange(n, n + 0x110000, dtype=np.int32)
        for piece, (_, own) in self.rank.items():
            if len(piece) == 1:
                self.single[ord(piece)] = own
        self.other = n
        pairs = {(self.rank[p[:i]][1] << SIDE) | self.rank[p[i:]][1]: own for p, (_, own) in self.rank.items() for i in range(1, len(p)) if p[:i] in self.rank and p[i:] in self.rank}
        self._hash_pairs(np.array(list(pairs), np.int64), np.array(list(pairs.values()), np.int32))
        self.cost, self.size = np.full(n + 1, np.inf, np.float32), np.zeros(n + 1, np.int64)
        for piece, (cost, own) in self.rank.items():
            self.cost[own], self.size[own] = cost, len(piece)
        self.forget()

    def _hash_pairs(self, pairs: np.ndarray, makes: np.ndarray) -> None:
        """A table with open addressing: pairs of pieces that make a piece, and which."""
        bits = max(4, int(len(pairs) * 2).bit_length())
        self.shift = np.uint64(64 - bits)
        self.keys, self.makes = np.full((1 << bits) + len(pairs) + 1, -1, np.int64), np.full((1 << bits) + len(pairs) + 1, -1, np.int32)
        at, left = self._slot(pairs), np.arange(len(pairs))
        while len(left):
            free = left[self.keys[at[left]] < 0]
            own, first = np.unique(at[free], return_index=True)
            self.keys[own], self.makes[own] = pairs[free[first]], makes[free[first]]
            left = left[self.keys[at[left]] != pairs[left]]
            at[left] += 1

    def _slot(self, pairs: np.ndarray) -> np.ndarray:
        return ((pairs.view(np.uint64) * np.uint64(GOLDEN)) >> self.shift).astype(np.int64)

    def _made(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that each pair makes; -1 for none, which has no end of cost."""
        pairs = (left << SIDE) | right
        at = self._slot(pairs)
        found = self.keys[at]
        out = self.makes[at]
        go = np.flatnonzero((found != pairs) & (found >= 0))
        out[found != pairs] = -1
        while len(go):
            at[go] += 1
            found = self.keys[at[go]]
            same = found == pairs[go]
            out[go[same]] = self.makes[at[go[same]]]
            go = go[~same & (found >= 0)]
        return out

    def forget(self) -> None:
        """Empty the memory; its first node is a marker letter of the text itself."""
        self.roots: dict[bytes, int] = {RAW_MARK: 0}
        #: Letters of words, where each word's start, and how many it has.
        self.letters, self.letters_at, self.letters_n = Grown(np.int32, []), Grown(np.int32, [0]), Grown(np.int16, [0])
        #: For each node its word, the word's hash, the node that it comes from, the candidate skipped there, and how many are.
        self.word_of, self.hash = Grown(np.int32, [0]), Grown(np.uint64, [0])
        self.parent, self.code, self.depth = Grown(np.int32, [-1]), Grown(np.int32, [0]), Grown(np.int16, [0])
        #: For each node where its ids and its candidates start, and how many it has.
        mark = [self.byte[b] for b in RAW_MARK]
        self.ids, self.ids_at, self.ids_n = Grown(np.int32, mark), Grown(np.int32, [0]), Grown(np.int16, [len(mark)])
        self.first, self.many = Grown(np.int32, [0]), Grown(np.int16, [0])
        #: Candidates, and the nodes in which they are skipped.
        self.codes, self.next = Grown(np.uint16, []), Grown(np.int32, [])
        self.last: tuple[float, set[int]] = (0.0, set())

    @property
    def known(self) -> dict[int, dict[str, bytes]]:
        """For each key of the last texts, what each remembered word becomes where a text first has it."""
        dropout, keys = self.last
        nodes = np.array(list(self.roots.values()), np.int64)
        names = [w.decode().replace(" ", MARK) if w != RAW_MARK else "" for w in self.roots]
        out = {}
        for key in keys:
            own = self._walk(nodes, salts(self.hash.data[nodes], np.uint64(key), np.zeros(len(nodes), np.uint64)), dropout)
            out[key] = {w: self.ids.data[a : a + n].tobytes() for w, a, n in zip(names, self.ids_at.data[own].tolist(), self.ids_n.data[own].tolist(), strict=True)}
        return out

    def _root(self, words: list[bytes]) -> None:
        """Make the first nodes of new words."""
        names = [w.decode().replace(" ", MARK) for w in words]
        sizes = np.array([len(w) for w in names], np.int64)
        numbers = np.arange(self.letters_n.n, self.letters_n.n + len(words))
        self.letters_at.add(self.letters.n + np.cumsum(sizes) - sizes)
        self.letters_n.add(sizes)
        self.letters.add(self.single[np.frombuffer("".join(names).encode("utf-32-le"), "<u4")])
        hashes = np.array([xxhash.xxh64_intdigest(w) for w in names], np.uint64)
        none = np.full(len(words), -1)
        self.roots.update(zip(words, self._grow(numbers, hashes, none, none).tolist(), strict=True))

    def _grow(self, words: np.ndarray, hashes: np.ndarray, parent: np.ndarray, code: np.ndarray) -> np.ndarray:
        """New nodes, and their candidates."""
        depth = np.where(parent < 0, 0, self.depth.data[parent] + 1)
        order = np.argsort(self.letters_n.data[words], kind="stable")
        nodes = np.empty(len(words), np.int64)
        for a in range(0, len(order), TOGETHER):
            own = order[a : a + TOGETHER]
            skips = np.full((len(own), int(depth[own].max(initial=0)) + 1), -1)  # ends with a candidate that never comes
            up, skipped = parent[own], code[own]
            for level in range(skips.shape[1] - 2, -1, -1):
                at = np.flatnonzero(depth[own] > level)
                skips[at, level] = skipped[at]
                skipped[at], up[at] = self.code.data[up[at]], self.parent.data[up[at]]
            ids, n_ids, codes, many = self._together(words[own], skips, depth[own])
            nodes[own] = np.arange(self.first.n, self.first.n + len(own))
            for held, rows in ((self.word_of, words[own]), (self.hash, hashes[own]), (self.parent, parent[own]), (self.code, code[own]), (self.depth, depth[own])):
                held.add(rows)
            self.ids_at.add(self.ids.n + np.cumsum(n_ids) - n_ids)
            self.ids_n.add(n_ids)
            self.ids.add(ids)
            self.first.add(self.codes.n + np.cumsum(many) - many)
            self.many.add(many)
            self.codes.add(codes)
            self.next.add(np.full(len(codes), -1))
        return nodes

    def _after(self, nodes: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The nodes in which these candidates are skipped."""
        at = self.first.data[nodes] + place
        new, first = np.unique(at[self.next.data[at] < 0], return_index=True)
        if len(new):
            of = nodes[self.next.data[at] < 0][first]
            made = self._grow(self.word_of.data[of], self.hash.data[of], of, self.codes.data[new].astype(np.int64))
            self.next.data[new] = made
        return self.next.data[at].astype(np.int64)

    def _walk(self, nodes: np.ndarray, salt: np.ndarray, dropout: float) -> np.ndarray:
        """Where each occurrence ends that starts at a word's root."""
        nodes, bound = nodes.copy(), np.uint64(int(dropout * (1 << 32)))
        for a in range(0, len(nodes) if bound else 0, WALK):
            going = np.arange(a, min(a + WALK, len(nodes)))
            while len(going):
                at = nodes[going]
                many = self.many.data[at]
                row = np.repeat(np.arange(len(going)), many)
                place = spread(self.first.data[at], many)
                hit = np.flatnonzero(_mix_all(salt[going][row] + self.codes.data[place]) < bound)
                row, hit = row[hit], place[hit]
                first = np.flatnonzero(np.diff(row, prepend=-1))
                row, hit = row[first], hit[first]
                going = going[row]
                nodes[going] = self._after(at[row], hit - self.first.data[at[row]])
        return nodes

    def _together(self, words: np.ndarray, skips: np.ndarray, n_skips: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of words, sorted by length, in which just these candidates are skipped, in their order: ids and how many each has, and the candidates that come up after the last skipped one and how many each has. Each step takes every word's best candidate; parts are linked, with no part at both ends."""
        sizes = self.letters_n.data[words]
        n, width = len(words), int(sizes[-1]) + 2
        letters = np.full((n, width), NONE)
        letters[(np.arange(width) > 0) & (np.arange(width) <= sizes[:, None])] = self.letters.data[spread(self.letters_at.data[words], sizes)]
        after, before = np.tile(np.minimum(np.arange(width) + 1, width - 1), (n, 1)), np.tile(np.arange(width) - 1, (n, 1))
        made = np.full((n, width), -1, np.int32)
        made[:, :-1] = self._made(letters[:, :-1].ravel(), letters[:, 1:].ravel()).reshape(n, -1)
        cost = self.cost[made]
        final, rows, met, way_rows, way_codes = letters, np.arange(n), np.zeros(n, np.int64), [], []
        while True:
            best = cost.argmin(axis=1)
            own = np.flatnonzero(np.isfinite(cost[np.arange(len(rows)), best]))
            if len(own) < 0.7 * len(rows):
                if final is not letters:
                    final[rows] = letters
                else:
                    final = letters.copy()
                if not len(own):
                    break
                letters, after, before, made, cost, rows, best = letters[own], after[own], before[own], made[own], cost[own], rows[own], best[own]
                own = np.arange(len(rows))
            line, at, word = own * width, best[own], rows[own]
            here = line + at
            piece = made.take(here)
            code = ((at - 1) << 8) + self.size[piece]
            skip = skips[word, met[word]] == code
            met[word[skip]] += 1
            later = ~skip & (met[word] == n_skips[word])
            way_rows.append(word[later])
            way_codes.append(code[later])
            flat = cost.ravel()
            if skip.any():
                flat[here[skip]] = np.inf
                keep = ~skip
                line, at, here, piece = line[keep], at[keep], here[keep], piece[keep]
                if not len(here):
                    continue
            second = after.take(here)
            third = after.take(line + second)
            left = before.take(here)
            parts = letters.ravel()
            parts[here], parts[line + second] = piece, NONE
            after.ravel()[here] = third
            before.ravel()[line + third] = at
            flat[line + second] = np.inf
            both = self._made(np.concatenate([piece, parts[line + left]]), np.concatenate([parts[line + third], piece]))
            there = np.concatenate([here, line + left])
            made.ravel()[there] = both
            flat[there] = self.cost[both]
        ways = np.concatenate([np.zeros(0, np.int64), *way_rows])
        codes = np.concatenate([np.zeros(0, np.int64), *way_codes])[np.argsort(ways, kind="stable")]
        some = final != NONE
        ids, n_ids = final[some], some.sum(axis=1)
        if (ids >= self.other).any():  # letters without a piece
            as_bytes = [[x] if x < self.other else [self.byte[b] for b in chr(x - self.other).encode()] for x in ids.tolist()]
            n_ids = np.bincount(np.repeat(np.arange(n), n_ids), [len(x) for x in as_bytes], n).astype(np.int64)
            ids = np.array([i for x in as_bytes for i in x])
        return ids, n_ids, codes, np.bincount(ways, minlength=n)

    def word(self, word: str, dropout: float, key: int, occurrence: int = 0) -> list[int]:
        """The ids of a word where a text of this key has it for the nth time, from 0: by an agenda, without the memory."""
        parts: list[str | None] = list(word)
        n, rank = len(parts), self.rank
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda: list[tuple[float, int, int, str, int]] = []

        def offer(i: int, j: int) -> None:
            pair = parts[i] + parts[j]
            if pair in rank:
                heapq.heappush(agenda, (rank[pair][0], i, j, pair, rank[pair][1]))

        for i in range(n - 1):
            offer(i, i + 1)
        bound = int(dropout * (1 << 32))
        salt = int(salts(np.array([xxhash.xxh64_intdigest(word)], np.uint64), np.uint64(key), np.array([occurrence], np.uint64))[0]) if bound else 0
        while agenda:
            _, i, j, pair, _ = heapq.heappop(agenda)
            if parts[i] is None or parts[j] is None or after[i] != j or len(parts[i]) + len(parts[j]) != len(pair):
                continue
            if bound and _mix(salt + (i << 8) + len(pair)) < bound:
                continue
            parts[i], parts[j] = pair, None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                offer(i, after[i])
            if before[i] >= 0:
                offer(before[i], i)
        out: list[int] = []
        for part in parts:
            if part is None:
                continue
            found = rank.get(part)
            if found:
                out.append(found[1])
            else:
                out += [self.byte[b] for b in part.encode()]
        return out

    def _words(self, data: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Where words start in the bytes of texts that each start with a blank: with the first of some blanks, at a new line and after it, and around a marker letter of the text itself."""
        blank = data == 32
        start = blank.copy()
        start[1:] &= ~blank[:-1]
        if self.lines:
            line = data == 10
            start |= line
            start[1:] |= line[:-1]
        start[ends[:-1][ends[:-1] < ends[1:]]] = True
        raw = np.flatnonzero(data == RAW_MARK[0])
        raw = raw[raw < len(data) - 2]
        raw = raw[(data[raw + 1] == RAW_MARK[1]) & (data[raw + 2] == RAW_MARK[2])]
        start[raw] = True
        start[raw[raw < len(data) - 3] + 3] = True
        return np.flatnonzero(start)

    def encode_texts(self, texts: pa.Array, dropout: float, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts, and where each text's start (and the last one's end); a key for each text."""
        if self.first.n >= REMEMBERED:
            self.forget()
        self.last = dropout, set(keys.tolist())
        texts = pc.fill_null(texts, "")
        own = pc.if_else(pc.greater(pc.binary_length(texts), 0), pc.binary_join_element_wise(pa.scalar(" "), texts, pa.scalar("")), pa.scalar("")).cast(pa.large_binary())
        ends = np.frombuffer(own.buffers()[1], "<i8")[own.offset : own.offset + len(own) + 1]
        if ends[-1] == ends[0]:
            return np.zeros(0, np.int32), np.zeros(len(own) + 1, np.int64)
        data = np.frombuffer(own.buffers()[2], np.uint8)[ends[0] : ends[-1]]
        ends = ends - ends[0]
        start = self._words(data, ends)
        of_text = np.searchsorted(start, ends)  # the first word of each text
        text = np.repeat(np.arange(len(own)), np.diff(of_text))
        every = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(np.append(start, len(data))), pa.py_buffer(data)]).dictionary_encode()
        number, words = every.indices.to_numpy(), every.dictionary.to_pylist()
        self._root([w for w in words if w not in self.roots and len(w.decode()) <= LONG])
        nodes = np.array([self.roots.get(w, -1) for w in words], np.int64)[number]
        nth = occurrences(text * len(words) + number)
        there = np.flatnonzero(nodes >= 0)
        nodes[there] = self._walk(nodes[there], salts(self.hash.data[nodes[there]], keys[text[there]], nth[there]), dropout)
        at, n = self.ids_at.data[nodes].astype(np.int64), self.ids_n.data[nodes].astype(np.int64)
        held = self.ids.n
        for i in np.flatnonzero(nodes < 0).tolist():  # long words: behind the remembered ids, for now
            ids = np.array(self.word(words[number[i]].decode().replace(" ", MARK), dropout, int(keys[text[i]]), int(nth[i])), np.int32)
            at[i], n[i] = self.ids.n, len(ids)
            self.ids.add(ids)
        out = np.concatenate([np.zeros(0, np.int32), *(self.ids.data[spread(at[a : a + WALK], n[a : a + WALK])] for a in range(0, len(n), WALK))])
        self.ids.n = held
        return out, np.append(0, np.cumsum(n))[of_text]

    def encode(self, texts: list[str | None], dropout: float, keys: list[int]) -> list[bytes]:
        """The ids of texts, as 32-bit numbers; a key for each text."""
        ids, ends = self.encode_texts(pa.array(texts, pa.string()), dropout, np.array(keys, np.uint64))
        return [ids[a:b].astype("<i4").tobytes() for a, b in zip(ends, ends[1:], strict=False)]

    def decode_ids(self, ids: np.ndarray, ends: np.ndarray) -> pa.Array:
        """The texts that ids stand for, from where each text's start (and the last one's end)."""
        own = self.pieces.cast(pa.large_binary()).take(pa.array(ids))
        at = np.frombuffer(own.buffers()[1], "<i8")[own.offset :][ends] if len(ids) else np.zeros(len(ends), np.int64)
        some = at[:-1] < at[1:]
        data = np.delete(np.frombuffer(own.buffers()[2] or b"", np.uint8)[: at[-1]], at[:-1][some])  # each text's first marker
        at = at - np.append(0, np.cumsum(some))
        return pa.Array.from_buffers(pa.large_binary(), len(some), [None, pa.py_buffer(at), pa.py_buffer(data)]).cast(pa.large_string())

    def decode(self, ids: np.ndarray) -> str:
        return self.decode_ids(ids, np.array([0, len(ids)]))[0].as_py()


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each size."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


class Grown:
    """An array that rows are added to."""

    def __init__(self, kind, rows: list[int]):
        self.data, self.n = np.zeros(1024, kind), 0
        self.add(np.array(rows, kind))

    def add(self, rows: np.ndarray) -> None:
        if self.n + len(rows) > len(self.data):
            self.data = np.concatenate([self.data[: self.n], np.zeros(self.n + 2 * len(rows), self.data.dtype)])
        self.data[self.n : self.n + len(rows)] = rows
        self.n += len(rows)


def occurrences(x: np.ndarray) -> np.ndarray:
    """How often each value has come up before."""
    order = np.argsort(x, kind="stable")
    new = np.flatnonzero(np.diff(x[order], prepend=-1))
    out = np.empty(len(x), np.uint64)
    out[order] = np.arange(len(x)) - np.repeat(new, np.diff(new, append=len(x)))
    return out


def salts(words: np.ndarray, keys, nth: np.ndarray) -> np.ndarray:
    """From hashes of words, keys of texts, and how often the text had the word before."""
    x = words ^ (keys + nth * np.uint64(GOLDEN))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _mix(x: int) -> int:
    """32 bits of a keyed hash."""
    x &= 0xFFFFFFFFFFFFFFFF
    x = (x ^ (x >> 31)) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF
    return (x ^ (x >> 29)) * 0xBF58476D1CE4E5B9 >> 32 & 0xFFFFFFFF


def _mix_all(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(32)


@cache
def codec(model: bytes) -> Codec:
    own = Codec(model)
    release()  # what making the tables took
    return own


def _groups(column: pa.Array) -> Iterator[tuple[int, int]]:
    """Rows (from, to) of BYTES of text together, or one row."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False))
    a = 0
    while a < len(sizes):
        b = max(a + 1, int(np.searchsorted(sizes, (sizes[a - 1] if a else 0) + BYTES, "right")))
        yield a, b
        a = b


def _encode(model, at: int, dropout: float, seed: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model.value)
        for batch in batches:
            for a, b in _groups(batch.column(at)):
                part = batch.slice(a, b - a)
                texts = part.column(at)
                keys = [xxhash.xxh64_intdigest(t or b"", seed) for t in texts.cast(pa.binary()).to_pylist()]
                ids, ends = own.encode_texts(texts, dropout, np.array(keys, np.uint64))
                lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids), mask=pa.array(texts.is_null()) if texts.null_count else None)
                yield pa.RecordBatch.from_arrays([*part.columns, lists.cast(schema.field(len(part.columns)).type)], schema=schema)
            release()

    return run


def encode(docs: DataFrame, text_col: str = "text", model_path: str = MODEL, dropout: float = DROPOUT, seed: int = SEED, ids_col: str = "token_ids") -> DataFrame:
    """docs and a column of token ids (renamed if docs has its name)."""
    with open(model_path, "rb") as f:  # the driver's copy; executors get it by broadcast
        model = docs.sparkSession.sparkContext.broadcast(f.read())
    schema = T.StructType([*docs.schema.fields, T.StructField(fresh(docs, ids_col), T.ArrayType(T.IntegerType()))])
    return small_batches(docs).mapInArrow(tidy(_encode(model, docs.columns.index(text_col), dropout, seed, to_arrow_schema(schema)), lambda: codec(model.value).forget()), schema)


def _decode(model, at: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model.value)
        for batch in batches:
            sizes = np.append(0, np.cumsum(pc.fill_null(pc.list_value_length(batch.column(at)), 0).to_numpy(zero_copy_only=False)))
            a = 0
            while a < batch.num_rows:
                b = max(a + 1, int(np.searchsorted(sizes, sizes[a] + BYTES // 4, "right")) - 1)
                part = batch.slice(a, b - a)
                column = part.column(at)
                texts = own.decode_ids(column.flatten().to_numpy(zero_copy_only=False), sizes[a : b + 1] - sizes[a])
                if column.null_count:
                    texts = pc.if_else(column.is_valid(), texts, pa.scalar(None, texts.type))
                yield pa.RecordBatch.from_arrays([*part.columns, texts.cast(schema.field(len(part.columns)).type)], schema=schema)
                a = b

    return run


def decode(encoded: DataFrame, ids_col: str = "token_ids", model_path: str = MODEL, text_col: str = "decoded") -> DataFrame:
    """encoded and a column of the texts that the ids stand for."""
    with open(model_path, "rb") as f:
        model = encoded.sparkSession.sparkContext.broadcast(f.read())
    schema = T.StructType([*encoded.schema.fields, T.StructField(fresh(encoded, text_col), T.StringType())])
    return small_batches(encoded).mapInArrow(tidy(_decode(model, encoded.columns.index(ids_col), to_arrow_schema(schema))), schema)


def round_trip(docs: DataFrame, text_col: str = "text", model_path: str = MODEL, dropout: float = DROPOUT, seed: int = SEED) -> DataFrame:
    """decode(encode(docs)) in one pass: one Python worker for each task instead of two."""
    with open(model_path, "rb") as f:
        model = docs.sparkSession.sparkContext.broadcast(f.read())
    ids, text = fresh(docs, "token_ids"), fresh(docs, "decoded")
    with_ids = T.StructType([*docs.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType()))])
    schema = T.StructType([*with_ids.fields, T.StructField(text, T.StringType())])
    there = _encode(model, docs.columns.index(text_col), dropout, seed, to_arrow_schema(with_ids))
    back = _decode(model, len(docs.columns), to_arrow_schema(schema))
    return small_batches(docs).mapInArrow(tidy(lambda batches: back(there(batches)), lambda: codec(model.value).forget()), schema)


def codec_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each row of docs: id, n_tokens, ids_hash, n_chars and text_sha256 of the decoded text, lossless."""
    own = round_trip(docs.select(id_col, F.col(text_col).alias("text_")), "text_")
    back = F.coalesce("decoded", F.lit(""))
    return own.select(
        id_col,
        F.coalesce(F.size("token_ids"), F.lit(0)).cast("long").alias("n_tokens"),
        F.xxhash64("token_ids").alias("ids_hash"),
        F.length(back).cast("long").alias("n_chars"),
        F.sha2(back, 256).alias("text_sha256"),
        F.col("decoded").eqNullSafe(F.col("text_")).alias("lossless"),
    )
