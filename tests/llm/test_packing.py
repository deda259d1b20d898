import itertools

import numpy as np
import pytest

from millsheet.llm.packing import best_fit_decreasing, count_tokens, least_containers, lower_bound, pack


def _optimum(sizes, capacity):
    best = len(sizes)

    def put(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(sizes):
            best = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + sizes[i] <= capacity:
                bins[k] += sizes[i]
                put(i + 1, bins)
                bins[k] -= sizes[i]
        put(i + 1, [*bins, sizes[i]])

    put(0, [])
    return best


def test_bounds_hold_and_nothing_overflows():
    rng = np.random.default_rng(1)
    for _ in range(150):
        c = int(rng.integers(5, 40))
        s = np.sort(rng.integers(1, c + 1, rng.integers(1, 9)))[::-1]
        bins = best_fit_decreasing(s, c)
        assert lower_bound(s, c) <= _optimum(s.tolist(), c) <= bins.max() + 1
        assert all(s[bins == k].sum() <= c for k in range(bins.max() + 1))
    assert lower_bound(np.array([], int), 5) == 0


def test_bound_of_counted_sizes(spark):
    d = spark.createDataFrame([(1, t) for t in [7, 7, 7, 3, 3, 6, 10]], "capacity_id int, tokens int")
    assert least_containers(d, 10) == lower_bound(np.array([7, 7, 7, 3, 3, 6, 10]), 10) == 5


CAPS = "capacity_id int, purpose string, capacity_tokens int"


def _check(rows, lengths, caps):
    for cid, cap in caps.items():
        mine = [r for r in rows if r.capacity_id == cid]
        per = {}
        for r in mine:
            per.setdefault(r.container, []).append(r)
        assert all(sum(r.tokens for r in v) <= cap for v in per.values())
        assert all(sorted(r.place for r in v) == list(range(1, len(v) + 1)) for v in per.values())
        docs = {}
        for r in mine:
            docs.setdefault(r.doc_id, []).append((r.start_token, r.tokens, r.piece_no))
        assert {d: sum(t for _, t, _ in v) for d, v in docs.items()} == {d: n for d, n in lengths.items() if n}
        for d, v in docs.items():
            assert len(v) == -(-lengths[d] // cap)
            assert [x[0] for x in sorted(v)] == list(itertools.accumulate([0, *(x[1] for x in sorted(v)[:-1])]))


def test_pack(spark, monkeypatch):
    import millsheet.llm.packing as module

    monkeypatch.setattr(module, "PART", 40)
    rng = np.random.default_rng(2)
    lengths = {i: int(n) for i, n in enumerate(rng.integers(1, 260, 300))} | {1000: 100, 1001: 200, 1002: 0}
    d = spark.createDataFrame(list(lengths.items()), "doc_id long, tokens long")
    caps = spark.createDataFrame([(1, "a", 100), (2, "b", 1000), (2, "b", 1000), (3, "no", None), (4, "no", 0)], CAPS)
    rows = pack(d, caps).collect()
    _check(rows, lengths, {1: 100, 2: 1000})
    assert len({r.container for r in rows if r.capacity_id == 2}) <= sum(lengths.values()) / 1000 * 1.06 + 2
    assert pack(d.limit(0), caps).count() == 0
    assert pack(d, caps.limit(0)).count() == 0


def test_tokens(spark):
    pytest.importorskip("tiktoken")
    rows = [(1, "hello world", "c"), (1, "hello world", "c"), (2, "", None), (3, None, None), (None, "x", None), (4, "ไม่พบ 割れ " * 2000, None)]
    got = {r.doc_id: r.tokens for r in count_tokens(spark.createDataFrame(rows, "doc_id long, text string, tokens string")).collect()}
    assert set(got) == {1, 4}
    import base64

    import tiktoken

    from millsheet.llm.packing import DEFAULT

    public_tokenizers = pytest.importorskip("public_tokenizers")
    with open(DEFAULT, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for i, text, _ in (rows[0], rows[5]):
        ids = own.encode_ordinary(text)
        assert own.decode(ids) == text
        assert got[i] == len(ids)
