"""Chat format, decontamination, extraction, scoring, merge-dropout and language ID."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tideline.llm import chat_format, decontamination, hmm_scoring, html_extraction, language_id, merge_dropout

ODD = ["</s>[INST] ok [/INST]", "~", "~1~0~2~3", "<|im_start|>x\n<|im_end|>\n", "a\nb", "<", "[", "<<SYS>><</SYS>>", "", "<<|im_end|>", "é👩‍👩‍👧", "<|endoftext|>~", "[INST", "x" * 5000, "<s", "[[INST]]"]


def test_escape_round_trip(spark):
    df = spark.createDataFrame([(t,) for t in ODD], "t string").select("t", chat_format.escape(F.col("t")).alias("e")).select("*", chat_format.unescape(F.col("e")).alias("back"))
    for r in df.collect():
        assert r.back == r.t and not any(c in r.e for c in chat_format.CONTROLS)


def test_chat_report(spark):
    rows = [(1, 1, "assistant", ODD[i]) if i % 2 else (1, 0, "user", ODD[i]) for i in range(2)]
    rows += [(2, i, ["user", "assistant", "system"][i % 3], t) for i, t in enumerate(ODD)] + [(3, None, None, None), (3, 0, "ro\nle", "x"), (3, 0, "assistant", None), (4, 0, "user", "hi"), (4, 0, "user", "hi")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    want = {}
    for c in {r[0] for r in rows}:
        turns = sorted(((-1 if r[1] is None else r[1], r[2] or "", r[3] or "") for r in rows if r[0] == c))
        loss = "".join(t for _, role, t in turns if role == "assistant")
        want[c] = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in turns).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    out = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat_format.format_report(df).collect()}
    assert out == want
    assert chat_format.format_report(df.limit(0)).count() == 0


def test_layouts(spark, tmp_path):
    lines = [
        '{"id": 1, "messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]}',
        '{"id": 2, "conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}',
        '{"id": 3, "prompt": "q", "response": "a"}',
        '{"id": 4, "prompt": "q", "response": "a", "system": "s"}',
        '{"id": 5, "instruction": "do", "input": "it", "output": "a"}',
        '{"id": 6, "instruction": "do", "output": "a"}',
        '{"id": 7, "dialog": ["q", "a", "q2"]}',
        '{"id": 8, "question": "q", "answer": "a"}',
        '{"id": 9, "other": {"deep": 1}}',
        '{"id": 10, "prompt": "q", "messages": [{"role": "user", "content": "q"}]}',
    ]
    (tmp_path / "x.json").write_text("\n".join(lines))
    out = {r.id: r for r in chat_format.canonical_turns(spark.read.json(str(tmp_path / "x.json"))).collect()}
    turns = {i: [(t.role, t.text) for t in r.turns_] if r.turns_ is not None else None for i, r in out.items()}
    qa = [("user", "q"), ("assistant", "a")]
    assert turns == {1: qa, 2: qa, 3: qa, 4: [("system", "s"), *qa], 5: [("user", "do\n\nit"), ("assistant", "a")], 6: [("user", "do"), ("assistant", "a")], 7: [*qa, ("user", "q2")], 8: qa, 9: None, 10: None}
    assert out[3].fingerprint != out[4].fingerprint and out[9].layout is None
    taken = spark.createDataFrame([("q", "a", "own", "own", "own", "own")], "prompt string, response string, fingerprint string, layout string, formatted string, turns_ string")
    (r,) = chat_format.format_chat(taken).collect()
    assert r.formatted == "own" and r["formatted_"].count(chat_format.START) == 2 and r["layout_"] == "prompt"


def test_deep_paths(spark):
    """Layouts that differ below elements of arrays, in arrays of arrays or in maps have fingerprints of their own."""
    kind = "id long, a array<struct<b:struct<c:string,d:string>>>, e array<array<struct<f:string,g:string>>>, m map<string,struct<x:string,y:string>>"
    rows = [
        (1, [(("c", None),)], None, None),
        (2, [((None, "d"),)], None, None),
        (3, None, [[("f", None)], []], None),
        (4, None, [[(None, "g")]], None),
        (5, None, None, {"k": ("x", None)}),
        (6, None, None, {"k": (None, "y")}),
        (7, [(("c", None),), (None,)], None, None),
        (8, [], [[]], {}),
    ]
    df = spark.createDataFrame(rows, kind)
    prints = [r.p for r in df.orderBy("id").select(chat_format.fingerprint(df.drop("id")).alias("p")).collect()]
    assert prints[0] == prints[6] and len(set(prints)) == 7


def doc_words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute_hits(text, items):
    w, hit, found = doc_words(text), set(), set()
    for item, t in items:
        q = doc_words(t)
        k = min(len(q), 10)
        for win in {tuple(q[i : i + k]) for i in range(len(q) - k + 1)} if k else ():
            for i in range(len(w) - k + 1):
                if tuple(w[i : i + k]) == win:
                    hit |= set(range(i, i + k))
                    found.add(str(item))
    return len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)


def test_decontamination(docs, spark, joins):
    draw = random.Random(2)
    vocabulary = ["the", "of", "a"] * 5 + [f"w{i}" for i in range(30)] + ["École", "école", "x1"]
    say = lambda n: " ".join(draw.choices(vocabulary, k=n))
    items = [(i, say(draw.choice([12, 15, 25]))) for i in range(3)] + [(10, "W1 of"), (2, "!!"), (None, None), (11, "the the the the the the the the the the the")]
    items += [items[0]]
    texts = [None, "", "...", "w1, OF", items[0][1].upper() + "!", " ".join(items[1][1].split()[1:12]), " ".join(items[1][1].split()[1:10]), "the " * 14, say(3000) + " " + items[2][1] + " " + items[2][1]]
    texts += [say(40) for _ in range(10)] + [say(5) + " " + items[0][1].replace(" ", "\n,") + " " + say(5)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = docs(texts)
    out = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in decontamination.contamination_report(df, bench).collect()}
    assert out == {i: brute_hits(t, items) for i, t in enumerate(texts)}
    clean = decontamination.decontaminated(df, bench)
    assert clean.columns == df.columns and {r.doc_id for r in clean.collect()} == {i for i, v in out.items() if not v[4]}
    none = decontamination.contamination_report(df, bench.limit(0)).collect()
    assert len(none) == len(texts) and not any(r.contaminated for r in none)
    assert decontamination.contamination_report(df.limit(0), bench).count() == 0
    # null ids and repeated rows
    rows = [(None, texts[4]), (None, texts[9]), (1, texts[4]), (1, texts[4]), (1, texts[10])]
    again = sorted((r.doc_id or 0, r.n_words, r.n_hit) for r in decontamination.contamination_report(docs(rows), bench).collect())
    assert again == sorted((i or 0, *brute_hits(t, items)[:2]) for i, t in rows)


def test_nearby(docs, spark):
    bench = spark.createDataFrame([(1, "alpha beta gamma delta")], "item_id long, text string")
    index = decontamination.PositionalIndex(docs(["delta x gamma beta y alpha", "alpha " + "z " * 30 + "beta gamma delta"]), bench)
    assert {r.id for r in index.nearby().collect()} == {0} and index.phrases().count() == 0


def test_extraction(spark):
    field = html_extraction.trained()
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><p>no";</script></head><body><nav><ul><li><a href=/>Home</a><li><a href=/x>More</a></ul></nav><!-- <p>no</p> -->
    <div class="cookie-notice">We use cookies, as all do. Accept them.</div><article><h1>A fine  title</h1><p><b>Tom &amp; J&eacute;r&#244;me went\n out,<br>and came back home. It was late.<p>A second paragraph, with <i>wor</i>ds that say more. Even more of it.</p></article>
    <div class="comments"><p>Great post, thanks! I liked it.</p></div><aside>Related reading</aside><form>Subscribe <input></form><footer>&copy; 2024 example</footer></body></html>"""
    text = html_extraction.main_text(page, field)
    assert text == "A fine title Tom & Jérôme went out, and came back home. It was late. A second paragraph, with words that say more. Even more of it."
    df = spark.createDataFrame([(1, "u", page), (2, "u", None), (3, None, ""), (4, "u", "<p"), (5, "u", "<a href=\"x>" * 2000), (5, "u", "<!-- open")], "page_id long, url string, html string")
    out = html_extraction.extraction_report(df).collect()
    assert len(out) == 6 and {r.page_id: r.text for r in out}[1] == text and all(r.n_chars == len(r.text) for r in out)
    assert html_extraction.extraction_report(df.limit(0)).count() == 0


def test_extraction_held_out():
    field, draw, right, n = html_extraction.trained(), random.Random(77), 0, 0
    for _ in range(60):
        own = html_extraction.blocks(html_extraction.labelled_page(draw))
        for b in own:
            b.path = tuple(x for x in b.path if "labelledmain" not in x[1])
        found = field.decode([html_extraction.features(b) for b in own])
        right += sum(x == b.main for x, b in zip(found, own, strict=True))
        n += len(own)
    assert right / n > 0.98


def test_field_likelihood_and_viterbi():
    field = html_extraction.Field({"a": 0.7, "b": -0.4, "c": 0.1}, [[0.2, -0.3], [-0.1, 0.5]])
    rows = [["a"], ["b", "c"], ["b"], ["a", "b"], ["c"]]
    score = lambda y: sum(field._unary(rows)[i] * y[i] for i in range(5)) + sum(field.moves[y[i]][y[i + 1]] for i in range(4))
    assert score(field.decode(rows)) == pytest.approx(max(score(y) for y in itertools.product((0, 1), repeat=5)))


@pytest.mark.parametrize("together", [250_000, 7, 1])
def test_forward_is_exact(monkeypatch, together):
    """Likelihoods and expected counts against all paths, however few symbols a part of the recursion may have."""
    monkeypatch.setattr(hmm_scoring, "STEP_TOKENS", together)
    model = hmm_scoring.Hmm.first(np.array([0.3, 0.3, 0.2, 0.2]), 3, 1)
    texts = [np.array([3]), np.array([0, 2, 1, 3, 0, 0, 1]), np.array([0, 2]), np.array([1, 1, 1, 2, 3])]
    word = [np.array([0]), np.array([1, -1, 2, 2, -1, 0, 1]), np.array([-1, -1]), np.array([0, 0, 1, 2, 2])]
    counts, by_word, logs = model.no_counts(), np.zeros((3, 3)), []
    for text, own in zip(texts, word, strict=True):
        total = 0.0
        start, move, emit, words = np.zeros(3), np.zeros((3, 3)), np.zeros((4, 3)), np.zeros((3, 3))
        for p in itertools.product(range(3), repeat=len(text)):
            x = model.start[p[0]] * np.prod([model.emit[s, k] for s, k in zip(text, p, strict=True)]) * np.prod([model.move[a, b] for a, b in itertools.pairwise(p)])
            total += x
            start[p[0]] += x
            for a, b in itertools.pairwise(p):
                move[a, b] += x
            for s, w, k in zip(text, own, p, strict=True):
                emit[s, k] += x
                if w >= 0:
                    words[w, k] += x
        logs.append(math.log(total))
        counts += np.concatenate([start, move.ravel(), emit.T.ravel()]) / total
        by_word += words / total
    found, found_words = model.no_counts(), np.zeros((3, 3))
    assert model.forward(np.concatenate(texts), np.array([len(t) for t in texts]), found, np.concatenate(word), found_words) == pytest.approx(logs)
    assert found == pytest.approx(counts) and found_words == pytest.approx(by_word)
    assert model.forward(np.concatenate(texts), np.array([len(t) for t in texts])) == pytest.approx(logs)


def test_rounds_raise_the_likelihood():
    model = hmm_scoring.Hmm.first(np.array([0.3, 0.3, 0.2, 0.2]), 3, 1)
    texts, sizes = np.array([0, 1, 0, 1, 3] * 20 + [2, 2, 2, 3] * 20), np.array([5] * 20 + [4] * 20)
    counts = model.no_counts()
    before = model.forward(texts, sizes, counts)
    assert model.estimate(counts, np.full(4, 0.25)).forward(texts, sizes).sum() > before.sum()


def test_words_of_texts():
    draw = random.Random(5)
    texts = [None, "", " \t", "A\x0bÉa\x1c b", "x"] + ["".join(draw.choices("aB \n\ré", k=draw.randint(0, 20))) for _ in range(200)] + ["", "end "]
    number, words, ends = hmm_scoring.split_words(pa.array(texts))
    want = [(t or "").encode().lower().split() for t in texts]
    assert [[words[i] for i in number[a:b]] for a, b in itertools.pairwise(ends)] == want


def test_scores(docs):
    draw = random.Random(8)
    words = ["the"] * 30 + ["of"] * 20 + [f"w{i}" for i in range(40)]
    texts = [None, "", " \t", "The unseen É"] + [" ".join(draw.choices(words, k=draw.randint(1, 30))) for _ in range(60)] + ["w1 " * 3000]
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    toks = [[w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if w] + [None] for t in texts]
    counts = Counter(w for i, t in enumerate(toks) if not held(i) for w in t)
    n, v = sum(counts.values()), len(counts)
    out = {r.doc_id: r for r in hmm_scoring.score_report(docs(texts)).collect()}
    for i, t in enumerate(toks):
        r = out[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(i), len(t), sum(counts[w] > 0 for w in t), n)
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in t), abs=1e-6)
        assert math.isfinite(r.score) and r.score < 0
    # what isn't in the dictionary is joined; counts don't depend on its size
    own = lambda size: {r.doc_id: r for r in hmm_scoring.hmm_scores(docs(texts), F.col("doc_id") % 7 == 2, dictionary=size).collect()}
    small, large = own(3), own(1000)
    for i in small:
        assert small[i].base_score == pytest.approx(large[i].base_score, abs=1e-6) and small[i].n_known == large[i].n_known
        assert math.isfinite(small[i].score) and small[i].score < 0
    assert hmm_scoring.score_report(docs(["a"]).limit(0)).count() == 0


def test_rare_words_have_states(docs):
    draw = random.Random(4)
    topics = [(["aa", "ab", "ac"], [f"ra{i}" for i in range(20)]), (["ba", "bb", "bc"], [f"rb{i}" for i in range(20)])]

    def say(own, rare):
        return " ".join(w for _ in range(12) for w in (*draw.choices(own, k=4), rare))

    texts = [say(own, rare[i % 20]) for i in range(60) for own, rare in topics]
    ends = [" ".join(["aa ab ac aa", "ra1", "ab aa ac ab"]), " ".join(["aa ab ac aa", "rb1", "ab aa ac ab"]), "aa never ab"]
    held = F.col("doc_id") >= len(texts)
    for size in (6, 12, 1000):  # rare words by the join, some, or none
        out = {r.doc_id: r for r in hmm_scoring.hmm_scores(docs(texts + ends), held, states=2, dictionary=size).collect()}
        own, other, never = (out[len(texts) + i] for i in range(3))
        assert own.base_score == pytest.approx(other.base_score) and own.score > other.score + 0.5
        assert never.n_known == 3 and math.isfinite(never.score)
    gamma = np.random.default_rng(2).dirichlet(np.ones(8), 500) * 3
    parts = hmm_scoring._divide(gamma)
    assert (parts.sum(axis=1) == hmm_scoring.PARTS).all() and np.abs(parts / hmm_scoring.PARTS - gamma / 3).max() < 1 / hmm_scoring.PARTS
    # shares of a class in each state, with that of a word never seen, add up to 1
    counts = np.random.default_rng(1).uniform(0, 3, (50, 4))
    shares = hmm_scoring.share_of_class(np.concatenate([counts, np.zeros((1, 4))]), counts.sum(axis=0), 50)
    assert shares.sum(axis=0) == pytest.approx(np.ones(4))


CODEC_TEXTS = ["", "  a  b ", "x\ty\r\n z", "▁ mark▁ here", "日本語 テスト\x00", "é́ ß İ", "   ", "\n\n  \n", " ▁", "a" * 3000, "👩‍👩‍👧 ok", "y" * 49 + " " + "z" * 48, "The quick brown fox; jumps, over (the) lazy dog's 12,345 tails!"]


def test_codec():
    import sentencepiece

    with open(merge_dropout.MODEL, "rb") as f:
        model = f.read()
    own, library = merge_dropout.codec(model), sentencepiece.SentencePieceProcessor(model_proto=model)
    for p in (0.0, 0.1, 0.5, 1.0):
        own.known.clear()
        for text, raw in zip(CODEC_TEXTS, own.encode(CODEC_TEXTS, p, [7] * len(CODEC_TEXTS)), strict=True):
            ids = np.frombuffer(raw, "<i4")
            assert own.decode(ids) == text
            if not p and "▁" not in text:
                assert ids.tolist() == library.encode(text)
        for word in [w for w in own.known[7] if w]:
            assert np.frombuffer(own.known[7][word], "<i4").tolist() == own.word(word, p, 7)
    own.known.clear()
    a, b, c = (own.encode([CODEC_TEXTS[-1]], 0.3, [k])[0] for k in (1, 2, 1))
    assert a == c != b


def test_each_occurrence_is_segmented_on_its_own(docs, monkeypatch):
    with open(merge_dropout.MODEL, "rb") as f:
        own = merge_dropout.codec(f.read())
    plain = own.word("▁something", 0.0, 0)
    for most in (merge_dropout.REMEMBERED, 1):  # with and without what earlier texts left
        monkeypatch.setattr(merge_dropout, "REMEMBERED", most)
        texts = ["something " * 3000 + "s" * 60 + " " + "s" * 60, *[f"something {i}" for i in range(1000)]]
        ids = [np.frombuffer(x, "<i4").tolist() for x in own.encode(texts, 0.1, list(range(len(texts))))]
        words = [own.word("▁something", 0.1, 0, n) for n in range(3000)]
        long = [own.word("▁" + "s" * 60, 0.1, 0, n) for n in range(2)]
        assert ids[0] == [x for w in [*words, *long] for x in w] and long[0] != long[1]
        across = [own.word("▁something", 0.1, k) for k in range(1, 1001)]
        assert all(got[: len(w)] == w for got, w in zip(ids[1:], across, strict=True))
        for found in (words, across):
            assert len(set(map(tuple, found))) > 5 and 0.3 < sum(w == plain for w in found) / len(found) < 0.9
    rows = merge_dropout.encode(docs([f"something {i}" for i in range(300)] + ["something 0"]), ids_col="own_ids").collect()
    assert len({r.own_ids[0] for r in rows}) > 2
    by = {r.doc_id: r.own_ids for r in rows}
    assert by[0] == by[300]


def test_codec_tables(docs):
    df = docs([None, *CODEC_TEXTS]).withColumnRenamed("keep_id", "token_ids")
    both = merge_dropout.decode(merge_dropout.encode(df), "token_ids_")
    rows = both.collect()
    assert all(r.decoded == r.text and r.token_ids == "clash" for r in rows)
    report = {r.doc_id: r for r in merge_dropout.codec_report(df).collect()}
    assert all(r.lossless for r in report.values()) and report[0].n_tokens == 0
    assert {r.doc_id: len(r["token_ids_"] or []) for r in rows} == {i: r.n_tokens for i, r in report.items()}
    assert merge_dropout.codec_report(df.limit(0)).count() == 0


LANGUAGES = {"aa": ["kato", "mira", "sole", "tano", "riva"], "bb": ["schtz", "ungen", "keit", "recht", "lich"], "cc": ["ооно", "ивак", "ется", "привет", "мир"]}


def test_language(docs):
    draw = random.Random(6)
    langs = [draw.choice(list(LANGUAGES)) for _ in range(150)]
    texts = [" ".join(draw.choices(LANGUAGES[x], k=draw.randint(2, 40))) for x in langs]
    texts += [None, "", "123 !?", "漢字仮名交"]
    langs += [None, "aa", "bb", None]
    df = docs(texts, lang=langs)
    out = {r.doc_id: r for r in language_id.language_report(df).collect()}
    for i, (t, x) in enumerate(zip(texts, langs, strict=True)):
        r = out[i]
        assert r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r.score <= 1
        if i < 150:
            assert r.lang_pred == x
        elif i < 153:
            assert (r.lang_pred, r.score) == ("und", 0.0)
    kept = {r.doc_id for r in language_id.with_known_language(df).collect()}
    assert kept >= set(range(150)) and kept.isdisjoint({150, 151, 152})
    assert {r.lang_pred for r in language_id.language_report(docs(["a"], lang=[None])).collect()} == {"und"}
    assert language_id.language_report(df.limit(0)).count() == 0


def test_short_texts_keep_their_language(docs):
    texts = [" ".join(LANGUAGES[x]) for x in LANGUAGES] * 20 + [c + "." for c in "ABCDEFGHIJKLMNOP"] + ["", "1."]
    df = docs(texts, lang=[*list(LANGUAGES) * 20, *["aa"] * 16, None, None])
    out = {r.doc_id: r for r in language_id.language_report(df).collect()}
    assert any(r.score < 0.05 for r in out.values() if r.lang_pred != "und")
    assert {r.doc_id for r in language_id.with_known_language(df).collect()} == set(range(76)) == {i for i, r in out.items() if r.lang_pred != "und"}


def test_bundles_are_sums_of_bound_letters():
    space = language_id.Space(128)
    for text in ["Ab, c!", "漢字 кот ß" * 3, "x", "".join(map(chr, range(0x4E00, 0x4E00 + 300)))]:
        folded = " " + " ".join("".join(c.lower()[0] if c.isalpha() else " " for c in text).split()) + " "
        vec = {c: space.letters(np.array([ord(c)]))[0].astype(int) for c in set(folded)}
        want = sum((np.roll(vec[a], 2) * np.roll(vec[b], 1) * vec[c] for a, b, c in zip(folded, folded[1:], folded[2:], strict=False)), np.zeros(128, int))
        assert (space.bundles(["", text, "q"])[1] == want).all()


def test_pieces_of_long_texts_add_up(monkeypatch):
    draw = random.Random(3)
    texts = ["".join(draw.choices("abc é  ,1\n", k=draw.randint(0, 60))) for _ in range(200)] + ["1" * 50 + "a", "a" * 50, "a" + " " * 50 + "b"]
    want = language_id.Space(128).bundles(texts)
    for piece in (1, 2, 3, 7):
        monkeypatch.setattr(language_id, "PIECE", piece)
        assert (language_id.Space(128).bundles(texts) == want).all()


def test_rare_languages_are_learned(docs, monkeypatch):
    monkeypatch.setattr(language_id, "TRAINING_ROWS", 3)
    langs = ["aa"] * 300 + ["cc"] * 4
    texts = [" ".join(LANGUAGES[x]) + f" {i}" for i, x in enumerate(langs)]
    known = language_id.prototypes(docs(texts, lang=langs), "text", "lang", "doc_id", sample=3)
    assert set(known) >= {"cc"}
