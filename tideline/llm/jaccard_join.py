"""N-gram Jaccard join by MinHash banding (operator 10).

Texts become sets of hashed n-grams of words. Texts with the same word sequence are
one class from the start and only its smallest id goes on. Each class gets a MinHash
signature cut into bands; band and row counts are the cheapest that reach the target
recall at the threshold. Classes meet by a shuffle on band hashes; of buckets with
the same members the one of the lowest band stays. Every pair of a bucket is then
verified on its full n-gram sets, in blocks: a bucket of m members becomes block
pairs of at most 2*BLOCK members, which are verified by one product of incidence
matrices. A pair counts in the first band it shares, so once. Blocks give counts
of links and a spanning forest of their linked members, never the pairs, so
what they give grows with members. Forests join into components by rounds of
smallest-label propagation that end with lineage cut in the shared folder.

Defined results: words are `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after lower-casing A-Z; a text
of fewer words than n has one n-gram, all its words. Texts without words (null,
empty) have no n-gram and no link; each is its own class. Rows that repeat an id
get equal results if their words are equal. A null id takes part like any other,
but no class or copy is named by it while it has another id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, materialise, partitions, sized, small_batches, tidy, worker_cpu_bound

WORDS = 5
THRESHOLD = 0.8
RECALL = 0.9999
#: Members of half a block pair.
BLOCK = 120
SEED = 1729
#: Columns of an incidence matrix that are multiplied in one go.
COLUMNS = 8192
#: UTF-8 bytes of texts that are hashed together; a longer text is hashed alone.
CHUNK = 1 << 20

#: A-Z become a-z, bytes that separate words become blanks.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_FOLDS = np.frombuffer(FOLD, np.uint8)
_M1, _M2, _P = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[int, int]:
    """(bands, rows) with the recall asked for at the threshold: the most rows that need at most 24 bands, so chance candidates are few."""
    best = None
    for rows in range(1, 33):
        miss = math.log1p(-(threshold**rows))
        bands = math.ceil(math.log(1 - recall) / miss)
        if best is None or bands <= 24:
            best = (bands, rows)
    return best


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


_BASE = 0x5851F42D4C957F2D
_POWERS: list[np.ndarray] = []


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2**64, and of its inverse."""
    if not _POWERS or len(_POWERS[0]) < n:
        _POWERS[:] = [_powers(max(n, CHUNK), _BASE), _powers(max(n, CHUNK), pow(_BASE, -1, 1 << 64))]
    return _POWERS[0][:n], _POWERS[1][:n]


def forget_tables() -> None:
    _POWERS.clear()


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words in order, and how many each text has."""
    raw = _FOLDS[np.frombuffer(b" ".join(texts) + b" ", np.uint8)]
    letter = raw != 32
    edge = np.diff(letter.astype(np.int8), prepend=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    up, down = _tables(len(raw))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(raw.astype(np.uint64) * up, dtype=np.uint64)])
    hashes = _mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * _P)
    bounds = np.cumsum([len(t) + 1 for t in texts])
    return hashes, np.diff(np.searchsorted(starts, bounds), prepend=0)


def ngram_hashes(texts: list[bytes], n: int) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all n-grams in order, and how many each text has."""
    hashes, counts = word_hashes(texts)
    ends = np.cumsum(counts)
    sizes = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    first = np.repeat(ends - counts, sizes) + _within(sizes)
    length = np.repeat(np.minimum(counts, n), sizes)
    out = np.zeros(len(first), np.uint64)
    for j in range(n):
        own = hashes[np.minimum(first + j, max(len(hashes) - 1, 0))] if len(hashes) else np.zeros(0, np.uint64)
        out = np.where(j < length, _mix(out * _P + own), out)
    return out, sizes


def _within(sizes: np.ndarray) -> np.ndarray:
    """0, 1, .. for each of the sizes in turn."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _chunks(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    a = size = 0
    for i, text in enumerate(texts):
        if i > a and size + len(text) > CHUNK:
            yield a, i
            a, size = i, 0
        size += len(text)
    if a < len(texts):
        yield a, len(texts)


def _bytes(column: pa.Array) -> list[bytes]:
    return pc.fill_null(column, "").cast(pa.binary()).to_pylist()


def _node(text: bytes) -> bytes:
    """128 bits for the sequence of words."""
    return xxhash.xxh3_128_digest(b" ".join(text.translate(FOLD).split()))


def _sign(n: int, bands: int, rows: int, seed: int):
    """(id, text) to (id, node, size, bands): a hash of the word sequence, the number of n-grams, a hash for each band."""
    worker_cpu_bound()
    draw = np.random.default_rng(seed)
    a = draw.integers(1, 1 << 63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    b = draw.integers(0, 1 << 63, bands * rows, dtype=np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = _bytes(batch.column(1))
            sequence, sizes, signed = [], [], []
            for lo, hi in _chunks(texts):
                part = texts[lo:hi]
                sequence += [_node(t) for t in part]
                grams, counts = ngram_hashes(part, n)
                out = np.zeros((len(part), bands), np.uint64)
                some = np.flatnonzero(counts)
                at = (np.cumsum(counts) - counts)[some]
                for k in range(bands):
                    band = np.full(len(some), k, np.uint64)
                    for r in range(k * rows, (k + 1) * rows):
                        band = _mix(band * _P + (np.minimum.reduceat(grams * a[r] + b[r], at) if len(some) else np.zeros(0, np.uint64)))
                    out[some, k] = band
                sizes.append(counts)
                signed.append(out)
            flat = np.concatenate(signed).view(np.int64).reshape(-1) if signed else np.zeros(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, bands, dtype=np.int32)), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sequence, pa.binary()), pa.array(np.concatenate(sizes) if sizes else np.zeros(0, np.int64), pa.int64()), lists], ["id", "node", "size", "bands"])

    return run


def _grams(n: int):
    """(id, text) to (node, grams): the sorted distinct n-gram hashes as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            texts = _bytes(batch.column(1))
            for lo, hi in _chunks(texts):
                grams, counts = ngram_hashes(texts[lo:hi], n)
                out += [np.unique(x).astype("<u8").tobytes() for x in np.split(grams, np.cumsum(counts)[:-1])]
            yield pa.RecordBatch.from_arrays([pa.array([_node(t) for t in texts], pa.binary()), pa.array(out, pa.binary())], ["node", "grams"])

    return run


def intersections(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many values each set of left shares with each of right. Values of one set only are left out of the product."""
    every = np.concatenate([*left, *right])
    own, at, seen = np.unique(every, return_inverse=True, return_counts=True)
    column = np.cumsum(seen > 1) - 1
    keep = seen[at] > 1
    row = np.repeat(np.arange(len(left) + len(right)), [len(x) for x in (*left, *right)])[keep]
    col = column[at[keep]]
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    out = np.zeros((len(left), len(right)), np.float32)
    for lo in range(0, int(col[-1]) + 1 if len(col) else 0, COLUMNS):
        a, b = np.searchsorted(col, [lo, lo + COLUMNS])
        dense = np.zeros((len(left) + len(right), min(COLUMNS, int(col[-1]) + 1 - lo)), np.float32)
        dense[row[a:b], col[a:b] - lo] = 1
        out += dense[: len(left)] @ dense[len(left) :].T
    return out


def _verify_group(own: pa.Table, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For one block pair, sorted by node: positions, the links each has, the copies these stand for, and the root each is joined to."""
    band, i, j = own.column("band")[0].as_py(), own.column("i")[0].as_py(), own.column("j")[0].as_py()
    side = own.column("block").to_numpy()
    copies = own.column("copies").to_numpy()
    bands = np.stack([np.asarray(x) for x in own.column("bands").to_pylist()])
    sets = [np.frombuffer(x, "<u8") for x in own.column("grams").to_pylist()]
    left = np.flatnonzero(side == i)
    right = left if i == j else np.flatnonzero(side == j)
    shared = intersections([sets[k] for k in left], [sets[k] for k in right]) if len(left) and len(right) else np.zeros((len(left), len(right)))
    size = np.array([len(x) for x in sets], np.float64)
    union = size[left][:, None] + size[right][None, :] - shared
    linked = shared >= threshold * union - 1e-9
    for k in range(band):
        linked &= bands[left, k][:, None] != bands[right, k][None, :]
    if i == j:
        linked &= ~np.eye(len(left), dtype=bool)
    n = len(sets)
    links, stands = np.zeros(n, np.int64), np.zeros(n, np.int64)
    links[left] += linked.sum(axis=1)
    stands[left] += linked.astype(np.int64) @ copies[right]
    if i != j:
        links[right] += linked.sum(axis=0)
        stands[right] += copies[left] @ linked.astype(np.int64)
    near = np.zeros((n, n), bool)
    near[np.ix_(left, right)] = linked
    near |= near.T
    root = np.arange(n)
    while True:  # the smallest position within reach
        low = np.minimum(root, np.where(near, root[None, :], n).min(axis=1))
        if (low == root).all():
            break
        root = low
    some = np.flatnonzero(links)
    return some, links[some], stands[some], root[some]


def _verify(threshold: float):
    """Rows sorted by bucket and block pair to (node, links, stands, root)."""
    worker_cpu_bound()

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            keys = list(zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("band", "hash", "i", "j")), strict=True))
            a = 0
            for b in range(1, len(keys) + 1):
                if b == len(keys) or keys[b] != keys[a]:
                    if held and keys[a] != last:
                        yield pa.Table.from_batches(held)
                        held = []
                    held.append(batch.slice(a, b - a))
                    last, a = keys[a], b
        if held:
            yield pa.Table.from_batches(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own in groups(batches):
            own = own.sort_by([("node", "ascending")]).combine_chunks()
            at, links, stands, roots = _verify_group(own, threshold)
            if len(at):
                nodes = own.column("node").combine_chunks()
                yield pa.RecordBatch.from_arrays([nodes.take(pa.array(at)), pa.array(links), pa.array(stands), nodes.take(pa.array(roots))], ["node", "links", "stands", "root"])

    return run


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(id, label): the smallest id of each connected component, for (id, root) edges with root <= id. Each round hangs every root below the smallest label next to it and then shortens all paths; rounds are logarithmic in the longest path."""
    label = materialise(edges.select("id", F.col("root").alias("label")).unionAll(edges.select(F.col("root"), F.col("root"))).groupBy("id").agg(F.min("label").alias("label")), "labels")
    links = materialise(edges.filter("id <> root").distinct(), "edges")
    for _ in range(max_rounds):
        a, b = label.withColumnsRenamed({"id": "a", "label": "la"}), label.withColumnsRenamed({"id": "b", "label": "lb"})
        met = links.join(a, links["id"] == a["a"]).join(b, links["root"] == b["b"]).filter("la <> lb")
        hung = met.select(F.greatest("la", "lb").alias("id"), F.least("la", "lb").alias("label"))
        moved = materialise(hung.groupBy("id").agg(F.min("label").alias("label")), "moved")
        if moved.isEmpty():
            return label
        label = label.unionAll(moved).groupBy("id").agg(F.min("label").alias("label"))
        for _ in range(2):  # each node takes its label's label
            label = materialise(label, "labels")
            up = label.withColumnsRenamed({"id": "up", "label": "top"})
            label = label.join(up, label["label"] == up["up"]).select("id", F.col("top").alias("label"))
        label = materialise(label, "labels")
    raise RuntimeError("components did not settle")


def jaccard_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = WORDS, threshold: float = THRESHOLD, recall: float = RECALL, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """A row for each row of docs: id, class_id (the smallest id of all texts joined to it by links), copy_of (the smallest id with the same words), n_links (other rows at or above the threshold, copies included), n_texts (different texts among them)."""
    bands, rows = choose_bands(threshold, recall)
    ids = docs.schema[id_col].dataType.simpleString()
    texts = small_batches(docs).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    signed = materialise(texts.mapInArrow(tidy(_sign(n, bands, rows, seed), forget_tables), f"id {ids}, node binary, size bigint, bands array<bigint>"), "signatures")
    # texts of the same words: one node, which has the same bands in every row
    nodes = materialise(signed.filter("size > 0").groupBy("node").agg(F.min("id").alias("rep"), F.count("*").alias("copies"), F.any_value("bands").alias("bands")), "nodes")
    spread = nodes.select("node", "rep", "copies", F.posexplode("bands").alias("band", "hash"), "bands")
    narrow = spread.select("band", "hash", F.xxhash64("node").alias("a"), F.xxhash64(F.lit(seed), "node").alias("b"))
    buckets = narrow.groupBy("band", "hash").agg(F.count("*").alias("m"), F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b")).filter("m > 1")
    # of buckets with the same members, the one of the lowest band
    kept = buckets.groupBy("m", "a", "b").agg(F.min("band").alias("band"), F.min_by("hash", "band").alias("hash"))
    kept = materialise(kept.select("band", "hash", F.ceil(F.col("m") / block).cast("int").alias("blocks")), "buckets")
    members = materialise(spread.join(sized(kept), ["band", "hash"]), "members")
    wanted = materialise(members.select(F.col("rep").alias("wanted")).distinct(), "wanted")
    sets = texts.join(sized(wanted), F.col("id").eqNullSafe(F.col("wanted")), "left_semi").mapInArrow(tidy(_grams(n), forget_tables), "node binary, grams binary")
    sets = materialise(sets.groupBy("node").agg(F.any_value("grams").alias("grams")), "sets")
    own = F.pmod(F.xxhash64(F.lit(seed), "node"), F.col("blocks")).cast("int")
    paired = members.withColumn("block", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    paired = paired.select("band", "hash", "node", "copies", "bands", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    dealt = paired.join(sets, "node").repartition(2 * partitions(docs.sparkSession), "band", "hash", "i", "j").sortWithinPartitions("band", "hash", "i", "j")
    found = materialise(dealt.mapInArrow(tidy(_verify(threshold)), "node binary, links bigint, stands bigint, root binary"), "links")
    label = components(found.select(F.col("node").alias("id"), "root"))
    counts = found.groupBy("node").agg(F.sum("links").alias("links"), F.sum("stands").alias("stands"))
    some = materialise(label.withColumnRenamed("id", "node").join(counts, "node", "left").join(nodes.select("node", "rep", "copies"), "node", "right").filter("copies > 1 or label is not null"), "linked")
    tops = materialise(some.groupBy("label").agg(F.min("rep").alias("top")).filter("label is not null"), "tops")
    classes = some.join(sized(tops), "label", "left").select("node", "rep", F.coalesce("top", "rep").alias("top"), "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("stands", F.lit(0)).alias("stands"))
    classes = materialise(classes, "classes")
    out = signed.select("id", F.when(F.col("size") > 0, F.col("node")).alias("node")).join(sized(classes), "node", "left")
    return out.select(
        F.col("id").alias(id_col),
        F.coalesce("top", "id").alias("class_id"),
        F.coalesce("rep", "id").alias("copy_of"),
        (F.coalesce("stands", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1).cast("long").alias("n_links"),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_texts"),
    )


def one_of_each_class(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay, with all their columns: of each class the row of the smallest id, null ids last; where texts share an id, by a hash of the text; one of rows with both equal."""
    own, lost = fresh(docs, "key"), fresh(docs, "gone")
    keyed = docs.withColumn(own, F.struct(F.col(id_col).isNull().alias("void"), F.col(id_col).alias("id"), F.xxhash64(text_col).alias("h")))
    report = materialise(jaccard_classes(keyed, own, text_col).select(F.col(own).alias(lost), (F.col("class_id") == F.col(own)).alias("stays"), "n_links"), "classed")
    gone = materialise(report.filter("not stays").select(lost).distinct(), "gone")
    left = keyed.join(sized(gone), F.col(own) == F.col(lost), "left_anti")
    # texts without words are in no class: they have no links, and all stay
    again = materialise(report.filter("stays and n_links > 0").groupBy(lost).agg(F.count("*").alias("m")).filter("m > 1").select(lost), "repeats")
    if not again.isEmpty():
        on = F.col(own) == F.col(lost)
        left = left.join(sized(again), on, "left_anti").unionByName(left.join(sized(again), on, "left_semi").dropDuplicates([own]))
    return left.drop(own)
