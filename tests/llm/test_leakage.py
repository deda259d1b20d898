import random

import pytest

from millsheet.llm import leakage
from millsheet.llm.leakage import BATCH, RUN, SHARE, Items, Texts, _Hashes, find_leaks, same, words_of

RNG = random.Random(5)
VOCAB = ["".join(RNG.choice("bcdfghklmnprstvz") + RNG.choice("aeiou") for _ in range(RNG.randint(2, 4))) for _ in range(400)]
ITEMS = [(i, " ".join(RNG.choice(VOCAB) for _ in range(40))) for i in range(20)]


def _brute(doc, item):
    """Share of the item's words in runs of RUN or more that the document has, misread letters allowed, by trying all places."""
    d, w = words_of(doc), words_of(item)
    covered = set()
    for p in range(len(d)):
        for q in range(len(w)):
            if p and q and same(d[p - 1], w[q - 1]):
                continue
            n = 0
            while p + n < len(d) and q + n < len(w) and same(d[p + n], w[q + n]):
                n += 1
            if n >= RUN:
                covered |= set(range(q, q + n))
    return len(covered) / len(w)


def test_against_brute_force():
    block = Items(ITEMS)
    for t in range(60):
        i = t % len(ITEMS)
        w = ITEMS[i][1].split()
        a = RNG.randint(0, 25)
        part = w[a : a + RNG.randint(4, 40)]
        if t % 3 == 0:
            k = RNG.randrange(len(part))
            part[k] = part[k][:-1] + ("x" if part[k][-1] != "x" else "y")
        doc = " ".join(RNG.choices(VOCAB, k=30) + part + RNG.choices(VOCAB, k=30))
        want = {j for j, x in ITEMS if _brute(doc, x) >= SHARE}
        assert set(block.found(doc, _Hashes())) == want


def test_layout_does_not_matter():
    block = Items(ITEMS)
    w = ITEMS[3][1].split()
    doc = "Intro. " + " ".join(w[:10]).upper() + ",\n\n" + w[10][:2] + "-\n" + w[10][2:] + " - " + "; ".join(w[11:])
    assert block.found(doc, _Hashes()) == [3]
    assert block.found(" ".join(reversed(w)), _Hashes()) == []
    assert words_of("L'équipe ÉMUE, pont-bascule, com-\npresseur") == ["lequipe", "emue", "pontbascule", "compresseur"]


def test_table(spark):
    items = spark.createDataFrame([(i, t, "x") for i, t in ITEMS] + [(50, None, None), (51, "", None), (None, "a b", None), (3, ITEMS[3][1], "x")], "item_id long, text string, doc_id string")
    docs = [(1, "x " + ITEMS[0][1], 1), (1, "x " + ITEMS[0][1], 1), (2, None, 1), (3, "", 1), (None, ITEMS[0][1], 1), (4, "wort " * 60000 + ITEMS[1][1], 1), (5, ITEMS[0][1] + " " + ITEMS[2][1], 1)]
    d = spark.createDataFrame(docs, "doc_id long, text string, item_id int")
    assert {tuple(r) for r in find_leaks(d, items).collect()} == {(1, 0), (4, 1), (5, 0), (5, 2)}
    assert find_leaks(d.limit(0), items).count() == 0
    assert find_leaks(d, items.limit(0)).count() == 0


def test_both_ways_agree_and_shared_sentences_change_nothing(spark):
    shared = " ".join(RNG.choice(VOCAB) for _ in range(14))
    items = [(i, t + " " + shared) for i, t in ITEMS] + [(90, shared), (91, shared + " " + shared)]
    texts = [ITEMS[3][1] + " " + shared, shared, "x " + " ".join(ITEMS[4][1].split()[:12]) + " y " + shared, " ".join(ITEMS[5][1].split()[:34]), "", " ".join(RNG.choice(VOCAB) for _ in range(50)), *(shared + f" wort{i}" for i in range(BATCH))]
    want = {(d, j) for d, t in enumerate(texts) for j, x in items if _brute(t, x) >= SHARE}
    assert (1, 90) in want
    assert (3, 5) in want
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    i = spark.createDataFrame(items, "item_id long, text string")
    assert {tuple(r) for r in find_leaks(d, i).collect()} == want
    assert {tuple(r) for r in find_leaks(d, i, item_letters=0).collect()} == want


def test_scripts_without_blanks(spark):
    text = "溶接部の外観検査では割れや気孔などの欠陥は見つからなかったので出荷を許可した"
    assert len(words_of(text)) == len(text)
    d = spark.createDataFrame([(1, "前文。" + text[:30] + "別の文"), (2, text[:10] + "別の文"), (3, "ไม่พบรอยแตก")], "doc_id long, text string")
    assert [tuple(r) for r in find_leaks(d, spark.createDataFrame([(7, text)], "item_id long, text string")).collect()] == [(1, 7)]


def _misread(w):
    return w[:-1] + ("k" if w[-1] != "k" else "x")


def _after_a_shared_sentence():
    """Items that begin with one sentence, and texts that have it and then one item's words, every third misread; two words in one, one in two."""
    shared = [RNG.choice(VOCAB) for _ in range(14)]
    rest = [[RNG.choice(VOCAB) for _ in range(26)] for _ in range(8)]
    items = [(k, " ".join(shared + r)) for k, r in enumerate(rest)]
    texts = [" ".join(shared + [_misread(w) if j % 3 == 0 else w for j, w in enumerate(r)]) for r in rest]
    texts.append(" ".join([*shared, rest[0][0] + rest[0][1], *(_misread(w) if j % 3 == 0 else w for j, w in enumerate(rest[0][2:]))]))
    texts.append(" ".join([*shared, rest[1][0][:2], rest[1][0][2:], *(_misread(w) if j % 3 == 0 else w for j, w in enumerate(rest[1][1:]))]))
    return " ".join(shared), items, texts, {*((k, k) for k in range(8)), (8, 0), (9, 1)}


def test_what_other_texts_have_decides_nothing():
    shared, items, texts, want = _after_a_shared_sentence()
    for those in (items, items[:2]):
        index, hashes = Items(those), _Hashes()
        for k in range(0, 2400, BATCH):
            index.search([f"{shared} wort{j}" for j in range(k, k + BATCH)], hashes)
        assert set(index.search(texts, hashes)) == {(d, i) for d, i in want if i < len(those)}


def test_join_finds_runs_that_go_on_from_a_shared_sentence(spark):
    shared, items, texts, want = _after_a_shared_sentence()
    d = spark.createDataFrame([*enumerate(texts), *((100 + j, f"{shared} wort{j}") for j in range(50)), (0, "another text")], "doc_id long, text string")
    i = spark.createDataFrame(items, "item_id long, text string")
    for letters in (0, 10**6):
        assert {tuple(r) for r in find_leaks(d, i, item_letters=letters).collect()} == want


@pytest.mark.parametrize("hits", [1, 300, 100_000])
def test_pairs_that_are_left_out_hold_nothing(monkeypatch, hits):
    """Every pair that shares a fingerprint is extended; the search, which extends few, must find the same."""
    monkeypatch.setattr(leakage, "HITS", hits)
    rng = random.Random(11)
    few = [rng.choice(VOCAB) for _ in range(30)] + ["m", "rn", "of", "af", "o0o0", "0o0o", "o", "a"]
    sentences = [[rng.choice(few) for _ in range(rng.randint(3, 14))] for _ in range(12)]

    def draw():
        return [w for _ in range(rng.randint(1, 5)) for w in rng.choice(sentences)]

    def worn(w):
        r = rng.random()
        return _misread(w) if r < 0.15 else w[:2] + " " + w[2:] if r < 0.2 else w

    items = [(k, " ".join(draw())) for k in range(60)]
    texts = [" ".join(worn(w) for w in draw()) for _ in range(200)]
    index, hashes = Items(items), _Hashes()
    want = set()
    for d, text in enumerate(texts):
        t = Texts([words_of(text)], hashes, 1)
        h, at = t.fingerprints()
        for i, words in enumerate(index.words):
            of = [(int(y), int(index.at[k]) - int(index.texts.starts[i])) for x, y in zip(h, at) for k in range(*index.h.searchsorted([x, x + 1])) if index.texts.of[index.at[k]] == i] if len(h) else []
            if of and Items._holds(t.words[:-1], words, sorted(of, key=lambda z: (z[0] - z[1], z[0]))):
                want.add((d, i))
    assert len(want) > 100
    assert set(index.search(texts, hashes)) == want
