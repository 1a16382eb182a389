"""Language-model scores from a hidden Markov model (operator 6).

Tokens are words after lower-casing A-Z, and one end for each text. Token counts come
from the whole training corpus. Every token of it has a probability in each state. The
DICTIONARY most frequent tokens and the end are symbols of their own in every round; the
others are one class while states are found. A pass with the model that the rounds end
with then counts the class's words by state: a word with expected count c in a state has
the share (c+1/K)/(n+(v+1)/K) of the class's n expected tokens there, for v words and K
states; the 1/K added to v words' is for words never seen. So each text has an exact
probability, and a rare word's state depends on the word.

Latent states are found by Baum-Welch alone: each round's expected counts are taken in
every partition, added up across partitions, and make the next model. The first model is
random. Rounds go over growing shares of the training texts (LEVELS, chosen by hash, each
within the next): on each share until a token's likelihood gains less than SETTLED, ROUNDS
at most, then over all training texts. Texts are read as token numbers, written once.
Expected counts are of one text's memory at most: a text longer than STEP_TOKENS keeps the
forward vectors at some steps only, and takes them up again from there. The scaled forward
recursion gives each text's exact likelihood; many texts take a step together.

Symbols travel to every executor; they cover most tokens. A text's remaining words go to
their word by a shuffle, once for each text, with their expected counts as bytes (255 for
one occurrence, divided among states), are added up there, and the sums come back to the
text by another; so there may be any number of them. A word outside the dictionary has a
group of as many rows as texts have it; Spark's windows spill it.

Defined results: null text is empty, which is one end. Repeated rows get equal
results. A null id hashes as empty text. With no training text every word is
unknown and N is 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import in_fold, materialise, tidy, worker_cpu_bound

STATES = 8
#: Tokens that every executor holds, as symbols, at most.
DICTIONARY = 150_000
#: One in how many training texts rounds go over.
LEVELS = (64, 16)
#: Rounds over each share, at most, and the gain of a token's log-likelihood below which its rounds end.
ROUNDS = 4
SETTLED = 0.01
#: Occurrences, with the states of all tokens, that are added to a word's own.
DRAWN = 0.5
#: Rounds over all training texts.
WHOLE_ROUNDS = 1
#: Tokens that take part in one recursion together, and bytes of text that are split together (one text at least).
STEP_TOKENS = 250_000
BYTES = 4 << 20
SEED = 11
END = b""  # no word is empty
#: How many parts an occurrence is divided into among states.
PARTS = 255

_SEPARATORS = b"\x20\x09\x0a\x0b\x0c\x0d"
_SMALL = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def split_words(texts: pa.Array) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """For each word of some texts its number in the list that follows; the last says where each text's words start, and where the last one's end."""
    own = pc.fill_null(texts, "").cast(pa.large_binary())
    ends = np.frombuffer(own.buffers()[1], "<i8")[own.offset : own.offset + len(own) + 1]
    if ends[0] == ends[-1]:
        return np.zeros(0, np.int64), [], np.zeros(len(ends), np.int64)
    raw = own.buffers()[2][int(ends[0]) : int(ends[-1])].to_pybytes()
    data, ends = np.frombuffer(raw, np.uint8), ends - ends[0]
    kept = (data != 32) & (data - np.uint8(9) >= 5)
    border = ends[1:-1][(ends[1:-1] > 0) & (ends[1:-1] < len(data))]
    start, stop = kept.copy(), kept.copy()
    start[1:] &= ~kept[:-1]
    start[border] = kept[border]
    stop[:-1] &= ~kept[1:]
    stop[border - 1] = kept[border - 1]
    at = np.flatnonzero(start)
    lengths = np.flatnonzero(stop) + 1 - at
    letters = raw.translate(_SMALL, _SEPARATORS)
    words = pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(np.append(0, np.cumsum(lengths))), pa.py_buffer(letters)]).dictionary_encode()
    return words.indices.to_numpy(), words.dictionary.to_pylist(), np.searchsorted(at, ends)


def _groups(column: pa.Array) -> Iterator[tuple[int, int]]:
    """Rows (from, to) of BYTES of text together, or one row."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False))
    a = 0
    while a < len(sizes):
        b = max(a + 1, int(np.searchsorted(sizes, (sizes[a - 1] if a else 0) + BYTES, "right")))
        yield a, b
        a = b


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b in _groups(batch.column(0)):
            number, words, _ = split_words(batch.column(0).slice(a, b - a))
            counts = np.append(np.bincount(number, minlength=len(words)), b - a)
            yield pa.RecordBatch.from_arrays([pa.array([*words, END], pa.binary()), pa.array(counts, pa.int64())], ["token", "n"])


def token_counts(texts: DataFrame) -> DataFrame:
    """(token, n) over all rows of a table with one column of text; the end of a text is the empty token."""
    return texts.mapInArrow(tidy(_count), "token binary, n bigint").groupBy("token").agg(F.sum("n").alias("n"))


def drawn(expected: np.ndarray, states: np.ndarray) -> np.ndarray:
    """Words' expected counts by state, as if DRAWN more occurrences of each word had the corpus's states; a word's sum stays. What few occurrences say of a word's states is little."""
    n = expected.sum(axis=1, keepdims=True)
    return (expected + DRAWN * states) * (n / (n + DRAWN))


@dataclass
class Hmm:
    """Start, transition and emission probabilities (symbols by states). The last two symbols are other words and the end."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray

    @classmethod
    def first(cls, share: np.ndarray, states: int, seed: int) -> Hmm:
        """share: of each symbol in the training tokens."""
        draw = np.random.default_rng(seed)
        emit = share[:, None] * draw.uniform(0.3, 1.7, (len(share), states))
        move = draw.uniform(0.5, 1.5, (states, states)) + 4 * np.eye(states)
        return cls(np.full(states, 1 / states), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))

    def estimate(self, counts: np.ndarray, share: np.ndarray) -> Hmm:
        """The model of expected counts, drawn towards equal states; every symbol keeps some probability in each state."""
        k = len(self.start)
        start, move, emit = counts[:k] + 0.1, counts[k : k + k * k].reshape(k, k) + 0.1, counts[k + k * k :].reshape(k, -1).T
        states = (emit.sum(axis=0) + 0.1) / (emit.sum() + 0.1 * k)
        emit = drawn(emit, states) + share[:, None] * 5
        emit[-2] += states  # one occurrence of words never seen
        return Hmm(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))

    def single(self) -> Hmm:
        """The same with numbers of half the size, for expected counts."""
        return Hmm(*(x.astype(np.float32) for x in (self.start, self.move, self.emit)))

    def no_counts(self) -> np.ndarray:
        """Room for expected counts: of starts, of moves, and for each state of its symbols."""
        return np.zeros(len(self.start) * (1 + len(self.start) + len(self.emit)))

    def forward(self, symbols: np.ndarray, sizes: np.ndarray, counts: np.ndarray | None = None, of_word: np.ndarray | None = None, by_word: np.ndarray | None = None) -> np.ndarray:
        """Natural log-likelihood of each text: its symbols stand in a row, none is empty. Expected counts of start, move and emit are added to counts; with of_word (a number for each symbol, negative for none), those by word and state are added to by_word."""
        order = np.argsort(-sizes, kind="stable")
        starts, found, a = np.cumsum(sizes) - sizes, np.zeros(len(sizes)), 0
        while a < len(order):
            held = np.cumsum(sizes[order[a:]])
            b = a + max(1, int(np.searchsorted(held, STEP_TOKENS, "right")))
            found[order[a:b]] = self._together(symbols, starts[order[a:b]], sizes[order[a:b]], counts, of_word, by_word)
            a = b
        return found

    def _steps(self, symbols: np.ndarray, going: np.ndarray, alpha: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """Forward vectors and scales of some steps' symbols, from the vectors before them; going: texts that take part in each step, which are the first ones."""
        out, scales, a = self.emit[symbols], np.empty(len(symbols)), 0
        for n in going.tolist():
            own = out[a : a + n]
            own *= self.start if alpha is None else alpha[:n] @ self.move
            scale = own.sum(axis=1)
            own /= scale[:, None]
            scales[a : a + n] = scale
            alpha, a = own, a + n
        return out, scales

    def _together(self, symbols, starts, sizes, counts, of_word, by_word) -> np.ndarray:
        """The longest text comes first. Steps go in parts of STEP_TOKENS symbols at most, or one step."""
        going = np.searchsorted(-sizes, -np.arange(sizes[0]), side="left")  # texts longer than t
        cut = np.searchsorted(np.cumsum(going), np.arange(STEP_TOKENS, going.sum(), STEP_TOKENS), "right")
        cuts = np.unique([0, *cut, len(going)]).tolist()
        log, befores, alpha = np.zeros(len(sizes)), [], None
        for a, b in zip(cuts, cuts[1:], strict=False):
            befores.append(alpha)
            own = going[a:b]
            text = np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)
            at = starts[text] + np.repeat(np.arange(a, b), own)
            alphas, scales = self._steps(symbols[at], own, alpha)
            log += np.bincount(text, np.log(scales), len(log))
            alpha = alphas[len(alphas) - own[-1] :].copy()
        if counts is None:
            return log
        k = len(self.start)
        move, emit = np.zeros((k, k)), counts[k + k * k :].reshape(k, -1)
        beta = np.ones((going[-1], k), self.emit.dtype)
        for i in range(len(befores) - 1, -1, -1):
            a, b = cuts[i], cuts[i + 1]
            own, ends = going[a:b], np.cumsum(going[a:b])
            if i < len(befores) - 1:  # the last part is at hand
                text = np.arange(ends[-1]) - np.repeat(ends - own, own)
                at = starts[text] + np.repeat(np.arange(a, b), own)
                alphas, scales = self._steps(symbols[at], own, befores[i])
            seen = symbols[at]
            ahead = self.emit[seen] / scales[:, None].astype(self.emit.dtype)
            gamma = alphas.copy()
            for t in range(b - a - 1, -1, -1):
                here = slice(ends[t] - own[t], ends[t])
                gamma[here] *= beta
                ahead[here] *= beta
                if a + t:
                    n = len(beta)
                    beta = np.ones((going[a + t - 1], k), self.emit.dtype)
                    beta[:n] = ahead[here] @ self.move.T
            # the vectors one step before, text by text
            before = (np.repeat(np.append(0, ends[:-1]) - np.append(0, own[:-1]), own) + text)[own[0] :]
            move += alphas[before].T @ ahead[own[0] :]
            if a:
                move += befores[i][: own[0]].T @ ahead[: own[0]]
            else:
                counts[:k] += gamma[: own[0]].sum(axis=0)
            for s in range(k):
                emit[s] += np.bincount(seen, gamma[:, s], emit.shape[1])
            if of_word is not None:
                word = of_word[at]
                some = np.flatnonzero(word >= 0)
                for s in range(k):
                    by_word[:, s] += np.bincount(word[some], gamma[some, s], len(by_word))
        counts[k : k + k * k] += (move * self.move).ravel()
        return log


class Lexicon:
    """What every executor knows: the most frequent tokens, in order of count. ends: the count of ends."""

    def __init__(self, counted: list[tuple[bytes, int]], ends: int):
        self.counts = np.array([n for _, n in counted], np.int64)
        self.place = {token: i for i, (token, _) in enumerate(counted)}
        self.ends, self.other, self.end = ends, len(counted), len(counted) + 1


def _encode(lexicon):
    """(id, held_out, part, text) to the places of the text's tokens, and those tokens that aren't in the dictionary; the places of these count on from the dictionary's length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = lexicon.value
        none = len(own.place)
        row = TaskContext.get().partitionId() << 34
        for batch in batches:
            for a, b in _groups(batch.column(3)):
                number, words, ends = split_words(batch.column(3).slice(a, b - a))
                known = np.array([own.place.get(w, none) for w in words], np.int64)
                places = known[number]
                rare = np.flatnonzero(places == none)
                text = np.searchsorted(ends, rare, "right") - 1
                pairs, back = np.unique(text * max(1, len(words)) + number[rare], return_inverse=True)
                of = np.searchsorted(pairs, np.arange(b - a + 1) * max(1, len(words)))
                places[rare] += back - of[text]
                rest = pa.ListArray.from_arrays(pa.array(of.astype(np.int32)), pa.array(words, pa.binary()).take(pa.array(pairs % max(1, len(words)))))
                raw = pa.Array.from_buffers(pa.binary(), b - a, [None, pa.py_buffer((ends * 4).astype(np.int32)), pa.py_buffer(places.astype("<i4"))])
                ids = np.arange(row, row + b - a)
                row += b - a
                yield pa.RecordBatch.from_arrays([pa.array(ids), *(batch.column(i).slice(a, b - a) for i in (0, 1, 2)), raw, rest], ["row", "id", "held_out", "part", "places", "rest"])

    return run


def _symbols(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The places of texts' tokens in a row, with -1 for each text's end, and how many each text has."""
    ends = np.frombuffer(column.buffers()[1], "<i4")[column.offset : column.offset + len(column) + 1].astype(np.int64) // 4
    sizes = np.diff(ends)
    out = np.full(len(column) + sizes.sum(), -1, np.int64)
    text = np.repeat(np.arange(len(column)), sizes)
    if len(text):
        out[np.arange(len(text)) + text] = np.frombuffer(column.buffers()[2], "<i4")[ends[0] : ends[-1]]
    return out, sizes + 1


def _slices(batch: pa.RecordBatch, at: int) -> Iterator[pa.RecordBatch]:
    """Rows of BYTES of places together, or one row."""
    for a, b in _groups(batch.column(at)):
        yield batch.slice(a, b - a)


def _expect(other: int, model):
    """Expected counts by state over a partition's texts. Symbols from 0: those that come up (from `other` on they are that one, or the end); -1: starts; below: moves from each state, in order, and at last the log-likelihood."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cpu_bound()
        hmm, total, log = model.value, None, 0.0
        k = len(hmm.start)
        for batch in batches:
            for part in _slices(batch, 0):
                symbols, sizes = _symbols(part.column(0))
                symbols = np.where(symbols < 0, other + 1, np.minimum(symbols, other))
                total = hmm.no_counts() if total is None else total
                log += hmm.forward(symbols, sizes, total).sum()
        if total is not None:
            emit = total[k + k * k :].reshape(k, -1).T
            some = np.flatnonzero(emit.any(axis=1))
            rows = np.concatenate([emit[some], total[: k + k * k].reshape(k + 1, k), np.full((1, k), log)])
            numbers = np.concatenate([some, -1 - np.arange(k + 2)])
            yield pa.RecordBatch.from_arrays([pa.array(numbers.astype(np.int32)), *(pa.array(np.ascontiguousarray(rows[:, s])) for s in range(k))], ["symbol", *(f"g{s}" for s in range(k))])

    return run


def _divide(gamma: np.ndarray) -> np.ndarray:
    """Rows of shares as whole numbers that add up to PARTS: the largest remainders are rounded up."""
    exact = gamma / gamma.sum(axis=1, keepdims=True) * PARTS
    whole = np.floor(exact)
    left = PARTS - whole.sum(axis=1)
    rank = np.argsort(np.argsort(whole - exact, axis=1, kind="stable"), axis=1)
    return (whole + (rank < left[:, None])).astype(np.uint64)


def _ask(lexicon, model):
    """(row, held_out, places, rest) to a row for each distinct word of a text that isn't in the dictionary: the word, the text, the word's place there, and, for training texts, how often it comes and its states: eight bits for each of eight states in one number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cpu_bound()
        own, hmm = lexicon.value, model.value
        k, none, unused = len(hmm.start), len(own.place), hmm.no_counts()
        for batch in (part for whole in batches for part in _slices(whole, 2)):
            rest, raw = batch.column(3), batch.column(2)
            asked = pc.list_value_length(rest).to_numpy(zero_copy_only=False).astype(np.int64)
            first = np.cumsum(asked) - asked
            place = np.arange(asked.sum()) - np.repeat(first, asked)
            n, g = np.zeros(len(place), np.int32), np.zeros(len(place), np.uint64)
            learn = np.flatnonzero(~batch.column(1).to_numpy(zero_copy_only=False) & (asked > 0))
            if len(learn):
                symbols, sizes = _symbols(raw.take(pa.array(learn)))
                word = np.where(symbols < none, -1, symbols - none + np.repeat(first[learn], sizes))
                by_word = np.zeros((len(place), k))
                hmm.forward(np.where(symbols < 0, own.end, np.minimum(symbols, own.other)), sizes, unused, word, by_word)
                n = np.bincount(word[word >= 0], minlength=len(place)).astype(np.int32)
                some = np.flatnonzero(n)
                parts = _divide(by_word[some])
                for s in range(k):
                    g[some] |= parts[:, s] << np.uint64(8 * s)
            columns = [rest.flatten(), np.repeat(batch.column(0).to_numpy(), asked), place.astype(np.int32), n, g.view(np.int64)]
            whole = pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in columns], ["token", "row", "pos", "n", "g"])
            for a in range(0, len(place), 100_000):
                yield whole.slice(a, 100_000)

    return run


def _score(lexicon, model, never: np.ndarray, class_counts: np.ndarray, class_v: int, total: int):
    """(id, held_out, places, found) to scores. never: emissions of a word never seen; found: what the corpus has of words that aren't in the dictionary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cpu_bound()
        own, hmm = lexicon.value, model.value
        none, k = len(own.place), len(hmm.start)
        base = np.concatenate([hmm.emit[:none], never[None, :], hmm.emit[own.end :]])  # the dictionary, a word never seen, the end
        logs = np.append(np.log10(own.counts + 1.0), [0.0, np.log10(own.ends + 1.0)])
        for batch in (part for whole in batches for part in _slices(whole, 2)):
            found = batch.column(3)
            n_found = pc.fill_null(pc.list_value_length(found), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = found.flatten()
            at = flat.field("pos").to_numpy(zero_copy_only=False).astype(np.int64)
            n = flat.field("n").to_numpy(zero_copy_only=False)
            parts = (flat.field("g").to_numpy(zero_copy_only=False)[:, None] >> np.arange(0, 8 * k, 8)) & 255
            g = parts * (n / np.maximum(1, parts.sum(axis=1)))[:, None]
            emit = np.concatenate([base, share_of_class(g, class_counts, class_v) * hmm.emit[own.other]])
            weight = np.concatenate([logs, np.log10(n + 1.0)])
            symbols, sizes = _symbols(batch.column(2))
            text = np.repeat(np.arange(len(sizes)), sizes)
            other = np.flatnonzero(symbols >= none)
            wide = int(symbols.max(initial=0)) + 1  # words of a text that the corpus has, by their places there
            keys = np.repeat(np.arange(len(sizes)), n_found) * wide + at
            order = np.argsort(keys)
            want = text[other] * wide + symbols[other] - none
            there = np.minimum(np.searchsorted(keys[order], want), max(0, len(keys) - 1))
            hit = keys[order[there]] == want if len(keys) else np.zeros(len(want), bool)
            symbols[other] = none
            symbols[other[hit]] = order[there[hit]] + len(base)
            symbols[symbols < 0] = none + 1
            known = np.bincount(text, (symbols != none) & ((symbols != none + 1) | (own.ends > 0)), len(sizes)).astype(np.int64)
            plain = np.bincount(text, weight[symbols], len(sizes)) - sizes * np.log10(total + 1)
            log = Hmm(hmm.start, hmm.move, emit).forward(symbols, sizes) / np.log(10)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *map(pa.array, (sizes, known, plain, log))], ["id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    return run


def share_of_class(expected: np.ndarray, class_counts: np.ndarray, class_v: int) -> np.ndarray:
    """Words' shares of their class in each state, from expected counts of words and of the class; a word never seen has counts of 0 and a share less by one added count."""
    k = len(class_counts)
    return (expected + 1 / k) / (class_counts + (class_v + 1) / k)


def _most_frequent(words: DataFrame, dictionary: int) -> list[tuple[bytes, int]]:
    """The most frequent tokens, at most about so many; of those with the last count, some by hash. How many tokens have each count is enough to find it."""
    least, taken, share = 1 << 62, 0, 0
    for count, many in words.groupBy("n").agg(F.count("*").alias("many")).orderBy(F.desc("n")).select("n", "many").toLocalIterator():
        least, share = count, min(1 << 20, (dictionary - taken) * (1 << 20) // many)
        taken += many
        if taken >= dictionary:
            break
    drawn = F.pmod(F.xxhash64("token"), F.lit(1 << 20)) < share
    own = words.filter((F.col("n") > least) | ((F.col("n") == least) & drawn))
    return sorted(((bytes(r.token), r.n) for r in own.toLocalIterator()), key=lambda x: (-x[1], x[0]))


def trained(training, share: np.ndarray, states: int, seed: int) -> Hmm:
    """The model that the rounds end with. training: from a level to its texts' places, in one column; the level after LEVELS has all."""
    model = Hmm.first(share, states, seed)
    for level in range(len(LEVELS) + 1):
        texts, before = training(level), None
        # each task sends counts of as many symbols as its texts have, so there are no more tasks than cores or a quarter of the files' parts
        texts = texts.coalesce(max(texts.sparkSession.sparkContext.defaultParallelism, texts.rdd.getNumPartitions() // 4))
        for _ in range(ROUNDS if level < len(LEVELS) else WHOLE_ROUNDS):
            shared = texts.sparkSession.sparkContext.broadcast(model.single())
            counts = texts.mapInArrow(tidy(_expect(len(share) - 2, shared)), ", ".join(["symbol int", *(f"g{s} double" for s in range(states))]))
            sums = counts.groupBy("symbol").agg(*[F.sum(f"g{s}").alias(f"g{s}") for s in range(states)]).toArrow()  # a row for each symbol at most
            shared.destroy()
            if not sums.num_rows:  # no text of this share
                break
            rows = np.zeros((len(share) + states + 2, states))  # negative numbers count from the end
            rows[sums.column(0).to_numpy()] = np.stack([sums.column(s + 1).to_numpy() for s in range(states)], axis=1)
            emit, log = rows[: len(share)], rows[len(share), 0]
            model = model.estimate(np.concatenate([rows[: len(share) - 1 : -1][: states + 1].ravel(), emit.T.ravel()]), share)
            gain, before = log - before if before is not None else np.inf, log
            if gain < SETTLED * emit.sum():
                break
    return model


def hmm_scores(docs: DataFrame, held_out, id_col: str = "doc_id", text_col: str = "text", states: int = STATES, dictionary: int = DICTIONARY, seed: int = SEED) -> DataFrame:
    """A row for each row of docs: id, held_out, n_tokens, n_known, train_tokens, base_score, score. held_out: a condition; rows that meet it aren't learned from."""
    if states > 8:
        raise ValueError("eight states at most")
    context = docs.sparkSession.sparkContext
    own = docs.select(F.col(id_col).alias("id"), held_out.alias("held_out"), F.col(text_col).alias("text"))
    vocabulary = materialise(token_counts(own.filter(~F.col("held_out")).select("text")), "vocabulary")
    ends = vocabulary.filter(F.length("token") == 0).agg(F.sum("n")).first()[0] or 0
    words = vocabulary.filter(F.length("token") > 0)
    n_words, v_words = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    n, v = n_words + ends, v_words + (ends > 0)
    lexicon = Lexicon(_most_frequent(words, dictionary), ends)
    class_v = v_words - lexicon.other
    share = np.concatenate([lexicon.counts, [n_words - lexicon.counts.sum(), ends]]).astype(float) + 1
    shared = context.broadcast(lexicon)
    draw = F.pmod(F.xxhash64("id", "text", F.lit(seed)), F.lit(LEVELS[0]))
    part = F.when(F.col("held_out"), len(LEVELS) + 1).otherwise(sum((F.when(draw >= LEVELS[0] // x, 1).otherwise(0) for x in LEVELS), F.lit(0)))
    kind = docs.schema[id_col].dataType.simpleString()
    numbered = own.select("id", "held_out", part.cast("int").alias("part"), "text").mapInArrow(tidy(_encode(shared)), f"row bigint, id {kind}, held_out boolean, part int, places binary, rest array<binary>")
    encoded = materialise(numbered, "encoded", "part")
    model = trained(lambda level: encoded.filter(F.col("part") <= level).select("places"), share / share.sum(), states, seed)
    asked = encoded.select("row", "held_out", "places", "rest").mapInArrow(tidy(_ask(shared, context.broadcast(model.single()))), "token binary, row bigint, pos int, n int, g bigint")
    whole = Window.partitionBy("token")
    sums = [F.sum(F.col("n") * F.shiftrightunsigned("g", 8 * s).bitwiseAND(F.lit(PARTS))).over(whole).alias(f"g{s}") for s in range(states)]
    added = asked.select("row", "pos", F.col("n").alias("own"), F.sum("n").over(whole).alias("n"), *sums).filter("n > 0")
    # the sums by state again as eight bits each, now of all of a word's occurrences
    part = [F.shiftleft(F.expr(f"(g{s} * {2 * PARTS} + n * {PARTS}) div (2 * n * {PARTS})"), 8 * s) for s in range(states)]
    packed = added.select("row", "pos", "own", "n", sum(part[1:], part[0]).alias("g"))
    found = materialise(packed.repartition("row").groupBy("row").agg(F.collect_list(F.struct("pos", "own", "n", "g")).alias("found")), "rare_words")
    bits = [F.shiftrightunsigned("w.g", 8 * s).bitwiseAND(F.lit(PARTS)) for s in range(states)]
    each = found.select(F.explode("found").alias("w")).agg(*[F.coalesce(F.sum(F.col("w.own") * bits[s] / sum(bits[1:], bits[0])), F.lit(0.0)) for s in range(states)])
    class_counts = np.array(each.first(), float)
    joined = encoded.select("row", "id", "held_out", "places").join(found, "row", "left")
    # the word never seen has an expected count of 0 in the class
    never = share_of_class(np.zeros((1, states)), class_counts, class_v)[0] * model.emit[lexicon.other]
    score = _score(shared, context.broadcast(model), never, class_counts, class_v, n + v)
    scored = joined.select("id", "held_out", "places", "found").mapInArrow(tidy(score), f"id {kind}, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double")
    return scored.select(F.col("id").alias(id_col), "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")


def score_report(docs: DataFrame) -> DataFrame:
    """Scores of all documents, learned from those whose crc32(doc_id as text) mod 7 is not 2."""
    return hmm_scores(docs, in_fold(F.col("doc_id"), 7, 2))
