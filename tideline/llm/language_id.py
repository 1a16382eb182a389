"""Language identification with hyperdimensional profiles (operator 9).

Each letter has a random vector of +1 and -1, drawn by hashing the letter itself. An
n-gram binds (multiplies) its letters' vectors, each rotated by its place; a text
bundles (adds) its n-grams' vectors; a language's prototype bundles the unit
vectors of its texts. A text gets the language whose prototype has the largest
cosine, which is the score.

Text is folded to small letters; whatever isn't a letter separates words, and each
word has one blank around it, so n-grams know where words begin and end.

Training uses at most about `sample` labelled rows of each language, chosen by hashed id
and text; of a language with fewer it uses all, so no language is lost. Everything else
covers every row and whole texts: long texts are counted in pieces of PIECE letters that
share two, and what these two add is taken away again, so pieces add up to the whole
text's bundle. N-grams are trigrams. Equal cosines go to the language that sorts first.
Null, empty and letterless texts get `und` with score 0, as does everything
if no labelled row can be learned from. Repeated rows get equal results.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import in_fold, materialise, sized, small_batches, tidy, worker_cpu_bound

DIMENSIONS = 512
#: Labelled rows of a language that its prototype is learned from, at most about.
TRAINING_ROWS = 3_000
SEED = 7
#: Letters that are counted in one go.
PIECE = 1 << 19

_BLANK = 0x20


def _mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Space:
    """Letter and n-gram vectors. Nothing is stored: vectors are functions of the letters and the seed."""

    def __init__(self, dimensions: int = DIMENSIONS, seed: int = SEED):
        worker_cpu_bound()
        self.dimensions, self.seed = dimensions, seed
        self.forget()
        self._lanes = np.arange(dimensions // 64, dtype=np.uint64) + np.uint64(seed << 20)

    def letters(self, points: np.ndarray) -> np.ndarray:
        """A row of +1 and -1 for each code point."""
        words = _mix(points.astype(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15) + _mix(self._lanes)[None, :])
        bits = np.unpackbits(words.astype("<u8").view(np.uint8), axis=1)
        return bits.astype(np.int8) * 2 - 1

    def grams(self, codes: np.ndarray) -> np.ndarray:
        """A row for each n-gram; codes hold 21 bits for each letter, the first letter highest."""
        out = None
        for place in range(3):
            points = (codes >> np.uint64(21 * (2 - place))) & np.uint64((1 << 21) - 1)
            own, at = np.unique(points, return_inverse=True)
            row = np.roll(self.letters(own), 2 - place, axis=1)[at]
            out = row if out is None else out * row
        return out

    def _gram_ids(self, codes: np.ndarray) -> np.ndarray:
        """Rows of self._vectors for codes of compact letters; what is new gets its vector."""
        at = self._table[codes]
        if len(new := np.unique(codes[at < 0])):
            self._table[new] = np.arange(len(self._vectors), len(self._vectors) + len(new))
            points = self._alphabet[: self._letters]
            full = (points[new >> 14] << np.uint64(42)) | (points[(new >> 7) & 127] << np.uint64(21)) | points[new & 127]
            self._vectors = np.concatenate([self._vectors, self.grams(full).astype(np.float32)])
            at = self._table[codes]
        return at

    def forget(self) -> None:
        """Start with no letters and n-grams at hand; what is kept between texts is bounded."""
        self._ids = np.zeros(0x110000, np.uint8)
        self._alphabet, self._letters = np.full(128, _BLANK, np.uint64), 1
        self._table = np.full(1 << 21, -1, np.int32)
        self._vectors = np.zeros((0, self.dimensions), np.float32)

    def _piece(self, texts: list[str]) -> np.ndarray:
        """Bundles of a few texts, together."""
        sizes = np.array([len(x) + 1 for x in texts])
        points = np.frombuffer(("\0".join(texts) + "\0").encode("utf-32-le", "surrogatepass"), np.uint32)
        row = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
        letters = _folds()[points]
        blank = letters == _BLANK
        kept = ~(blank & np.append(False, blank[:-1]))
        letters, row = letters[kept], row[kept]
        if letters[0] != _BLANK:
            letters, row = np.append(np.uint32(_BLANK), letters), np.append(row[:1], row)
        if len(letters) < 3:
            return np.zeros((len(texts), self.dimensions), np.float32)
        fine = (letters[1:-1] != _BLANK) | (row[:-2] == row[2:])
        row = np.where(letters[1:-1] != _BLANK, row[1:-1], row[:-2])[fine]
        ids = self._ids[letters]
        if len(new := np.unique(letters[(ids == 0) & (letters != _BLANK)])):
            if len(self._vectors) > 50_000 or self._letters + len(new) > 128:
                self.forget()
                new = np.unique(letters[letters != _BLANK])
            if len(new) <= 127 - self._letters:
                self._alphabet[self._letters : self._letters + len(new)] = new
                self._ids[new] = np.arange(self._letters, self._letters + len(new))
                self._letters += len(new)
                ids = self._ids[letters]
            else:  # more letters than compact codes have
                wide = letters.astype(np.uint64)
                own, at = np.unique(((wide[:-2] << np.uint64(42)) | (wide[1:-1] << np.uint64(21)) | wide[2:])[fine], return_inverse=True)
                out = np.zeros((len(texts), self.dimensions), np.float32)
                for a in range(0, len(own), 4096):
                    part = (at >= a) & (at < a + 4096)
                    width = min(4096, len(own) - a)
                    counts = np.bincount(row[part].astype(np.int64) * width + at[part] - a, minlength=len(texts) * width)
                    out += counts.reshape(len(texts), width).astype(np.float32) @ self.grams(own[a : a + width]).astype(np.float32)
                return out
        ids = ids.astype(np.int32)
        at = self._gram_ids(((ids[:-2] << 14) | (ids[1:-1] << 7) | ids[2:])[fine])
        width = len(self._vectors)
        counts = np.bincount(row.astype(np.int64) * width + at, minlength=len(texts) * width)
        return counts.reshape(len(texts), width).astype(np.float32) @ self._vectors

    def bundles(self, texts: list[str]) -> np.ndarray:
        """The bundled n-gram vectors of each text; zero if it has no letter."""
        out = np.zeros((len(texts), self.dimensions), np.float32)
        rows: list[int] = []
        parts: list[str] = []
        signs: list[int] = []
        held = 0

        def flush() -> None:
            nonlocal rows, parts, signs, held
            if parts:
                np.add.at(out, rows, self._piece(parts) * np.array(signs, np.float32)[:, None])
            rows, parts, signs, held = [], [], [], 0

        for i, text in enumerate(texts):
            for part, sign in [(text, 1)] if len(text) <= PIECE else _pieces(text):
                rows.append(i)
                parts.append(part)
                signs.append(sign)
                held += len(part)
                if held >= PIECE or len(parts) >= 256:
                    flush()
        flush()
        return out

    def __reduce__(self):
        return _space, (self.dimensions, self.seed)


@cache
def _space(dimensions: int, seed: int) -> Space:
    """A worker has one, which keeps its tables between tasks."""
    return Space(dimensions, seed)


_FOLDS: list[np.ndarray] = []


def _folds() -> np.ndarray:
    """What each code point becomes: a letter its small form, anything else a blank."""
    if not _FOLDS:
        folds = np.full(0x110000, _BLANK, np.uint32)
        for i in range(0x110000):
            if chr(i).isalpha():
                folds[i] = ord(chr(i).lower()[0])
        _FOLDS.append(folds)
    return _FOLDS[0]


def _pieces(text: str) -> Iterator[tuple[str, int]]:
    """Folded pieces of a long text, with no more than one blank in a row; two letters or blanks that two pieces share come once more by themselves, to be taken away."""
    folded = np.zeros(0, np.uint32)
    for a in range(0, len(text), PIECE):
        own = _folds()[np.frombuffer(text[a : a + PIECE].encode("utf-32-le", "surrogatepass"), np.uint32)]
        folded = np.concatenate([folded, own])
        blank = folded == _BLANK
        folded = folded[~(blank & np.append(False, blank[:-1]))]
        last = a + PIECE >= len(text)
        if len(folded) > 2:
            yield folded.tobytes().decode("utf-32-le", "surrogatepass"), 1
            folded = folded[-2:].copy()
            if not last:
                yield folded.tobytes().decode("utf-32-le", "surrogatepass"), -1
        elif last:
            yield folded.tobytes().decode("utf-32-le", "surrogatepass"), 1


def _unit(rows: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, norms, out=np.zeros_like(rows), where=norms > 0)


def _learn(space: Space):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a in range(0, len(texts), 1000):
                own = langs[a : a + 1000]
                unit = _unit(space.bundles(texts[a : a + 1000]))
                for lang in sorted(set(own)):
                    sums[lang] = sums.get(lang, 0) + unit[[x == lang for x in own]].sum(axis=0, dtype=np.float64)
        for lang, row in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * space.dimensions), pa.array(range(space.dimensions), pa.int32()), pa.array(row)], ["lang", "at", "x"])

    return run


def prototypes(labelled: DataFrame, text_col: str, lang_col: str, id_col: str, sample: int = TRAINING_ROWS, space: Space | None = None) -> dict[str, np.ndarray]:
    """A unit vector for each language of the labelled rows. What reaches the driver is dimensions x languages numbers."""
    space = space or Space()
    usable = labelled.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counts = usable.groupBy(F.col(lang_col).alias("lang_")).agg(F.count("*").alias("rows_"))
    drawn = F.pmod(F.xxhash64(F.col(id_col), F.col(text_col), F.lit(SEED)), F.lit(1 << 40)) / (1 << 40) < sample / F.col("rows_")
    usable = usable.select(F.col(lang_col), F.col(text_col), F.col(id_col)).join(sized(materialise(counts, "languages")), F.col(lang_col) == F.col("lang_")).filter(drawn)
    sums = small_batches(usable).select(F.col(lang_col), F.col(text_col)).mapInArrow(tidy(_learn(space), space.forget), "lang string, at int, x double").groupBy("lang", "at").agg(F.sum("x").alias("x"))
    out: dict[str, np.ndarray] = {}
    for row in sums.toLocalIterator():
        out.setdefault(row.lang, np.zeros(space.dimensions))[row.at] = row.x
    return {k: v / n for k, v in sorted(out.items()) if (n := np.linalg.norm(v)) > 0}


def _predict(space: Space, langs: list[str], profile: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [x or "" for x in batch.column(batch.num_columns - 1).to_pylist()]
            best, score = [], []
            for a in range(0, len(texts), 1000):
                unit = _unit(space.bundles(texts[a : a + 1000]))
                cosine = unit @ profile.T.astype(np.float32) if langs else np.zeros((len(unit), 1))
                top, none = cosine.argmax(axis=1), ~unit.any(axis=1)
                best += ["und" if void or not langs else langs[k] for k, void in zip(top, none, strict=True)]
                score += [0.0 if void else float(min(1.0, max(0.0, c))) for c, void in zip(cosine.max(axis=1), none, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(best, pa.string()), pa.array(score, pa.float64())], [*batch.schema.names[:-1], "lang_pred", "score"])

    return run


def identify(docs: DataFrame, known: dict[str, np.ndarray], keys: list[Column], text: Column, space: Space | None = None) -> DataFrame:
    """A row for each row of docs: the keys, lang_pred and score."""
    space = space or Space()
    rows = docs.select(*keys, text.alias("text_"))
    profile = np.stack(list(known.values())) if known else np.zeros((1, space.dimensions))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return small_batches(rows).mapInArrow(tidy(_predict(space, list(known), profile), space.forget), f"{schema}, lang_pred string, score double")


def language_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """A row for each document: id, held_out, lang_pred, score. Learned without the fold that is held out."""
    held = in_fold(F.col(id_col), 3, 1)
    known = prototypes(docs.filter(~held), text_col, lang_col, id_col)
    return identify(docs, known, [F.col(id_col), held.alias("held_out")], F.col(text_col))


def with_known_language(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of docs that get a language, with all their columns: only `und` goes. A cosine of few n-grams says too little to reject a text by it."""
    known = prototypes(docs.filter(~in_fold(F.col(id_col), 3, 1)), text_col, lang_col, id_col)
    space = Space()
    profile = np.stack(list(known.values())) if known else np.zeros((1, space.dimensions))
    predict, at = _predict(space, list(known), profile), docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = next(predict(iter([pa.RecordBatch.from_arrays([batch.column(at)], ["text_"])])))
            yield batch.filter(pa.array([x != "und" for x in found.column(0).to_pylist()], pa.bool_()))

    return small_batches(docs).mapInArrow(tidy(keep, space.forget), docs.schema)
