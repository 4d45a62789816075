import random

import numpy as np
import pytest

from supplyscope.llm import bm25_wand as B

from .helpers import AWKWARD, docs

R = random.Random(5)
VOCAB = [a + b for a in "ka lo mi ru te no sa".split() for b in "ba de fi go hu".split()]
ITEMS = [(i, " ".join(R.choices(VOCAB, k=R.randint(6, 150)))) for i in range(60)]


def test_block_max_wand_finds_all_above():
    ix = B.Index(ITEMS)
    w = np.zeros((len(ix.vocabulary), len(ix.item_of)))
    for t in range(len(w)):
        w[t, ix.parts[t]] = ix.impacts[t]
    for _ in range(200):
        terms = sorted(R.sample(range(len(w)), R.randint(1, len(w))))
        theta = R.choice([0.05, 0.2, 0.5, 0.9])
        score = w[terms].sum(0)
        low, high = sorted(R.choices(range(len(ix.item_of) + 1), k=2))
        got = {p for p, _ in ix.above(terms, theta, low, high)}
        assert got == {p for p in range(low, high) if score[p] >= theta}


def test_candidates_are_the_passages_a_plain_scan_finds():
    ix = B.Index(ITEMS)
    w = np.zeros((len(ix.vocabulary), len(ix.item_of)))
    for t in range(len(w)):
        w[t, ix.parts[t]] = ix.impacts[t]
    texts = [" ".join(R.choices(VOCAB + ["zz"] * 60, k=k)).encode() for k in (0, 1, 63, 64, 65, 96, 97, 500)]
    text = b"\n".join(texts) + b"\n"
    bounds = np.cumsum([0, *(len(t) + 1 for t in texts)])
    got = {(d, int(ix.item_of[0] * 0 + i)) for d, _, i, _ in ix.candidates(text, bounds, 0.3)}
    want = set()
    for d, t in enumerate(texts):
        h = B.word_hashes(t)[1]
        for s in range(0, max(1, len(h) - B.PART_WORDS), B.STRIDE):
            terms = np.flatnonzero(np.isin(ix.vocabulary, h[s:s + B.PART_WORDS + B.STRIDE]))
            want |= {(d, int(ix.item_of[p])) for p in np.flatnonzero(w[terms].sum(0) >= 0.3)}
    assert got == want


@pytest.mark.parametrize("segment", [1 << 20, 300])
def test_planted_items_are_found_and_clean_texts_left(spark, monkeypatch, segment):
    monkeypatch.setattr(B, "_SEGMENT", segment)
    ix = B.Index(ITEMS)
    other = [c + "x" for c in VOCAB]
    texts, want = [], set()
    for i, (item, t) in enumerate(ITEMS):
        pad = lambda: " ".join(R.choices(other, k=R.randint(0, 300)))
        t = [t, t.upper(), t.replace(" ", "\n"), t.replace(" ", ", ")][i % 4]
        texts.append(f"{pad()} {t}. {pad()}".encode().lower())
        want.add((i, item))
        texts[-1:] = [texts[-1]]
    clean = [" ".join(R.choices(other + VOCAB[:5], k=400)).encode() for _ in range(20)]
    half = [t.split()[: len(t.split()) // 2] for _, t in ITEMS[:10]]
    got = {(r, i) for r, i, *_ in B.scan(ix, texts + clean + [" ".join(h).encode() for h in half], 0.6, 0.8)}
    assert got == want


def test_question_and_answer_must_both_be_there():
    ix = B.Index([(1, "which river runs through the old town of kaba? the quiet lomi river")])
    find = lambda t: [i for _, i, *_ in B.scan(ix, [t.encode()], 0.3, 0.8)]
    assert find("x which river runs through the old town of kaba? the quiet lomi river y") == [1]
    assert find("x which river runs through the old town of kaba? nobody here knows") == []
    assert find("the quiet lomi river") == []


@pytest.mark.parametrize("n", [20, 40, 59])
def test_one_word_edits_of_an_item_without_a_mark(n):
    """A copy with one word changed is found wherever the whole item's overlap stays at 0.8."""
    item = [f"{R.choice(VOCAB)}{i}" for i in range(n)]
    ix = B.Index([(1, " ".join(item)), *((100 + i, t) for i, t in ITEMS)])
    for at in range(n):
        text = " ".join(["start", *item[:at], "changed", *item[at + 1:], "stop"]).encode()
        broken = min(at, 4, n - 5, n - 1 - at) + 1
        whole = 1 - broken / (n - 4)
        got = {i: (q, a) for _, i, _, q, a in B.scan(ix, [text], 0.6, 0.8)}
        assert got == ({1: (pytest.approx(whole), pytest.approx(whole))} if whole >= 0.8 else {})


def test_marks_without_words_on_one_side_split_nothing():
    for text in (b"? a b c d e f", b"a b c d e f?", b"a b c d e f answer:", b"a b c d e f"):
        words = B._WORDS.findall(text)
        assert B.split_item(words, text) == (words,)
    assert B.split_item([b"a", b"b", b"c"], b"a b? c") == ([b"a", b"b"], [b"c"])


def test_awkward_rows_and_tables(spark):
    items = spark.createDataFrame([(1, "Alpha beta gamma delta epsilon", 9), (2, None, 9), (3, "", 9), (None, "no id here at all", 9),
                                   (1, "Alpha beta gamma delta epsilon", 9)], "item_id long, text string, doc_id long")
    df = docs(spark, AWKWARD)
    got = sorted(((r.doc_id or -1, r.item_id or -1) for r in B.contaminated(df, items).collect()))
    assert got == sorted([(1, 1), (1, 1), (2, 1), (2, 1), (-1, -1)])
    clean = B.clean_documents(df, items)
    assert clean.dtypes == df.dtypes
    assert clean.count() == len(AWKWARD) - 3
    none = items.limit(0)
    assert B.contaminated(df, none).count() == 0 and B.clean_documents(df, none).count() == len(AWKWARD)
    assert B.contaminated(docs(spark, []), items).count() == 0


def test_several_index_shards(spark, monkeypatch):
    monkeypatch.setattr(B, "SHARD_ITEMS", 10)
    df = docs(spark, [(i, t, "s") for i, t in ITEMS])
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in B.contaminated(df, items).collect()}
    assert got == {(i, i) for i, _ in ITEMS}


def test_scores_do_not_depend_on_the_shards(spark, monkeypatch):
    df = docs(spark, [(i, t, "s") for i, t in ITEMS] + [(100 + i, f"changed {t.split(None, 1)[1]}", "s") for i, t in ITEMS])
    items = spark.createDataFrame([*ITEMS, (90, "É? x"), (91, None), (92, "")], "item_id long, text string")
    find = lambda: {(r.doc_id, r.item_id): pytest.approx(r.score) for r in B.contaminated(df, items).collect()}
    whole = find()
    monkeypatch.setattr(B, "SHARD_ITEMS", 10)
    assert {k: v.expected for k, v in find().items()} == whole


def test_question_and_answer_far_apart():
    """Both are in the document, some hundred KB apart and in either order; one of them alone is not enough."""
    q, a = " ".join(VOCAB[i] for i in R.sample(range(35), 20)), " ".join(VOCAB[i] for i in R.sample(range(35), 12))
    items = [(1, f"{q}? {a}"), (2, f"{q}? ka"), (3, " ".join(VOCAB[:30]))]
    ix = B.Index(items)
    gap = " ".join(c + "x" for c in R.choices(VOCAB, k=40_000))
    find = lambda t: sorted(i for _, i, *_ in B.scan(ix, [t.encode()], 0.6, 0.8))
    assert len(gap) > 150_000
    assert find(f"{q} {gap} {a}") == find(f"{a}. {gap} {q}") == [1]
    assert find(f"{q} {gap}") == [] and find(f"{gap} {a}") == []
    assert find(f"{q} {gap} ka") == [2] and find(f"{gap} ka") == []


def test_parts_do_not_mix_question_and_answer():
    words = [f"w{i}".encode() for i in range(150)]
    text = b" ".join(words[:70]) + b"? " + b" ".join(words[70:])
    parts = list(B.item_parts(words, text))
    assert [(s, c.total()) for s, c in parts] == [(0, 64), (0, 6), (1, 64), (1, 16)]
    assert sum((c for _, c in parts), B.Counter()) == B.Counter(words)
