"""Exact dedup, line dedup, sharding and the Jaccard join against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tideline.llm import exact_dedup, jaccard_join, line_dedup, sharding

TEXTS = ["a b", "ab", "a\tb\n", None, "", " \x0b", "c", "C", "a  b", "é", "é", "x" * 3000, "x" * 3000 + " ", " ", "b", "b"]


def test_quotient_filter_round_trip():
    draw = np.random.default_rng(0)
    for skip in (0, 6):
        parts = []
        for _ in range(4):
            v = draw.integers(0, 1 << 63, 500, dtype=np.uint64) >> np.uint64(skip)
            v = np.concatenate([v, v[:100], v[:10], np.array([0, 0, (1 << (64 - skip)) - 1], np.uint64)])
            values, counts = np.unique(v, return_counts=True)
            f = exact_dedup.QuotientFilter.unpack(exact_dedup.QuotientFilter.of(values, counts, skip).pack())
            a, b = f.items()
            assert (a == values).all() and (b == counts).all()
            parts.append((v, f))
        a, b = exact_dedup.merge([f for _, f in parts]).items()
        want = Counter(np.concatenate([v for v, _ in parts]).tolist())
        assert dict(zip(a.tolist(), b.tolist(), strict=True)) == want


def brute_dedup(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i))
    out = []
    for i, t in rows:
        body = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        keep = min(groups[body])[1]
        out.append((i, keep, len(groups[body]), keep == i, hashlib.sha256(body.encode()).hexdigest()))
    return sorted(out)


def test_exact_dedup(docs, joins):
    df = docs(TEXTS)
    assert sorted(tuple(r) for r in exact_dedup.exact_dedup(df).collect()) == brute_dedup(list(enumerate(TEXTS)))
    kept = exact_dedup.deduplicated(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, k, *_ in brute_dedup(list(enumerate(TEXTS))) if i == k)


def test_exact_dedup_edges(docs):
    assert exact_dedup.exact_dedup(docs(["a"]).limit(0)).count() == 0
    twice = docs([(1, "a b"), (1, "a b"), (2, "ab"), (None, "ab"), (None, "zz")])
    out = exact_dedup.exact_dedup(twice).collect()
    assert {r.group_size for r in out if r.text_sha256 == hashlib.sha256(b"ab").hexdigest()} == {4}
    assert sorted((r.doc_id, r.text) for r in exact_dedup.deduplicated(twice).collect() if r.text != "zz") == [(1, "a b")]


def test_lines(docs, joins):
    draw = random.Random(4)
    common = ["Home | About", " All rights reserved ", "Near"]
    texts, sites = [], []
    for i in range(60):
        lines = [f"own {i} {k}" for k in range(3)] + ["", "only here"] * (i % 2)
        lines += [common[0]] * (i % 20 < 14) + [common[1].strip() if i % 3 else common[1]] + [common[2]] * (i % 20 < 9)
        draw.shuffle(lines)
        texts.append("\n".join(lines))
        sites.append(f"s{i % 20}")
    texts += [None, "", "Near"]
    sites += ["s1", None, None]
    df = docs(texts, source=sites)
    where = defaultdict(set)
    for t, s in zip(texts, sites, strict=True):
        for x in (t or "").split("\n"):
            where[x.strip(" \t\r\x0b\x0c")].add(s or "")
    gone = {x for x, s in where.items() if x and len(s) >= 10}
    assert gone >= {"Home | About", "All rights reserved", "Near"}  # 9 sites and the empty one
    out, clean, n_lines, n_removed = line_dedup.without_spread_lines(df)
    for r in out.collect():
        lines = (texts[r.doc_id] or "").split("\n")
        left = [x for x in lines if x.strip(" \t\r\x0b\x0c") not in gone]
        assert (r[clean], r[n_lines], r[n_removed]) == ("\n".join(left), len(lines), len(lines) - len(left))
    assert line_dedup.line_report(df.limit(0)).count() == 0


def test_shards(docs):
    texts = [None, "", "é" * 10] + [f"text {i % 7}" for i in range(300)] + ["y" * 50_000]
    df = docs(texts)
    rows = sharding.shard_report(df).collect()
    assert len(rows) == len(texts)
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(raw) + 16, zlib.crc32(raw), "rows", None)
    sizes = Counter(r.shard for r in rows)
    assert set(sizes) == set(range(40)) and max(sizes.values()) - min(sizes.values()) <= 1
    for s in sizes:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sizes[s]))
    again = sharding.shard_report(df.repartition(7)).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, rows))  # the same, however the table is dealt
    before = df.sparkSession.conf.get("spark.sql.shuffle.partitions")
    try:
        df.sparkSession.conf.set("spark.sql.shuffle.partitions", "3")
        assert sorted(map(tuple, sharding.shard_report(df).collect())) == sorted(map(tuple, rows))
    finally:
        df.sparkSession.conf.set("spark.sql.shuffle.partitions", before)
    other = sharding.shard_report(df, seed=1).collect()
    assert {r.doc_id: (r.shard, r.slot) for r in other} != {r.doc_id: (r.shard, r.slot) for r in rows}
    assert sharding.shard_report(df.limit(0)).count() == 0
    whole = sharding.external_shuffle(docs(["a", "b"]).withColumnRenamed("keep_id", "place"))
    assert "place" in whole.columns and "place_" in whole.columns and {r.place for r in whole.collect()} == {"clash"}


def test_fisher_yates_is_uniform():
    seen = Counter(tuple(sharding.fisher_yates(3, f"s{i}")) for i in range(6000))
    assert len(seen) == 6 and all(850 < n < 1150 for n in seen.values())


def grams(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set(), tuple(w)


def brute_links(rows):
    own = {i: grams(t) for i, t in rows}
    linked = lambda a, b: own[a][0] and own[b][0] and len(own[a][0] & own[b][0]) >= 0.8 * len(own[a][0] | own[b][0]) - 1e-9
    near = {i: {j for j in own if j != i and linked(i, j)} for i in own}
    label = {i: i for i in own}
    for _ in own:
        label = {i: min([label[i], *(label[j] for j in near[i])]) for i in own}
    return {i: (label[i], min([i, *(j for j in near[i] if own[j][1] == own[i][1])]), len(near[i]), len({own[j][1] for j in near[i]} - {own[i][1]})) for i in own}


@pytest.mark.parametrize("block", [2, 120])
def test_jaccard(docs, joins, block):
    draw = random.Random(9)
    words = [f"w{i}" for i in range(400)]
    base = [" ".join(draw.choices(words, k=60)) for _ in range(8)]
    texts = [None, "", "Short one", "short ONE!", "four words are here", "É x", "é x"]
    for b in base:
        texts.append(b)
        for _ in range(draw.randint(0, 5)):
            w = b.split()
            for _ in range(draw.randint(0, 2)):
                w[draw.randrange(len(w))] = draw.choice(words)
            texts.append(" ".join(w))
    chain = base[0].split()  # a drift of small steps, whose ends aren't alike
    for _ in range(6):
        chain = chain[3:] + draw.choices(words, k=3)
        texts.append(" ".join(chain))
    out = {r.doc_id: (r.class_id, r.copy_of, r.n_links, r.n_texts) for r in jaccard_join.jaccard_classes(docs(texts), block=block).collect()}
    assert out == brute_links(list(enumerate(texts)))
    if block == 120:
        kept = jaccard_join.one_of_each_class(docs(texts))
        assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, v in out.items() if v[0] == i)


def test_jaccard_edges(docs, spark):
    assert jaccard_join.jaccard_classes(docs(["a"]).limit(0)).count() == 0
    out = jaccard_join.jaccard_classes(docs([(1, "a b c"), (1, "a b c"), (None, "a b c")])).collect()
    assert [r.n_links for r in out] == [2, 2, 2] and {r.class_id for r in out} == {1}
    bands, rows = jaccard_join.choose_bands(0.8, 0.9999)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.9999
    path = spark.createDataFrame([(i + 1, i) for i in range(40)], "id long, root long")
    assert {r.label for r in jaccard_join.components(path).collect()} == {0}


def test_one_of_each_class_with_repeated_and_null_ids(docs, joins):
    near = " ".join(f"w{i}" for i in range(60))
    rows = [(1, near), (2, near + " more"), (2, "alone in its class"), (2, "alone in its class"), (None, near + " last"), (None, "of null ids"), (None, "Of null, ids!"), (None, "..."), (None, "..."), (3, "once, twice"), (3, "once twice")]
    df = docs(rows)
    kept = jaccard_join.one_of_each_class(df)
    assert kept.columns == df.columns
    words = Counter((r.doc_id, " ".join(re.findall("[a-z0-9]+", r.text.lower()))) for r in kept.collect())
    assert words == {(1, near): 1, (2, "alone in its class"): 1, (None, "of null ids"): 1, (None, ""): 2, (3, "once twice"): 1}


def test_rows_of_one_id_spread(docs):
    """A third of the rows has no id: they go to many buckets, unless they are equal in every column."""
    texts = [(None, f"text {i}") for i in range(300)] + [(i, "same") for i in range(300)] + [(7, "same")] * 5
    written = sharding.external_shuffle(docs(texts), bucket_bytes=400)
    rows = written.collect()
    assert Counter((r.doc_id, r.text) for r in rows) == Counter(texts)
    shards = Counter(r.place.shard for r in rows if r.doc_id is None)
    assert len(shards) > 30 and max(shards.values()) < 20
    sizes = Counter(r.place.shard for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 1


def test_starts_of_buckets(spark):
    counts = {b: (b * 7) % 5 + 1 for b in range(0, 60, 2)}
    df = spark.createDataFrame(list(counts.items()), "bucket long, rows long")
    found = {r.bucket: (r.start, r.total) for r in sharding.running_starts(df, "bucket", "rows", "start", "total", block=8).collect()}
    assert found == {b: (sum(n for c, n in counts.items() if c < b), sum(counts.values())) for b in counts}
