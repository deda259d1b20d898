"""Evaluation texts that occur, wholly or partly, in a training corpus.

Winnowing: every text is a sequence of words; of the hashes of K consecutive words the smallest of every W is kept, so
that two texts that share K + W - 1 consecutive words share a fingerprint. Fingerprints of the documents meet those of
the items, and every hit is extended to both sides as far as the words agree. Letters that are easily misread are one class
in the hashes, and the extension lets a word differ by one letter, or be divided in two; case, accents, punctuation and
layout don't count. A document holds an item if the runs of at least ``RUN`` words cover at least ``SHARE`` of the item's words.

All fingerprints of all items are looked up. So that a shared sentence doesn't extend every document along every item, each hit
is first seen with the few words around it (``reach``): where the equal words end on both sides at words that can't be one
but for a misread letter or a division, its run is known. A pair all of whose runs are known and cover too little is done;
every other pair is extended. No count of any texts decides what is found.

Items of up to ``ITEM_LETTERS`` letters together are indexed once and broadcast, and the corpus is read in one pass;
of larger sets the fingerprints are joined with those of the corpus. There the fingerprints that more than ``COMMON`` items
have, counted over all items, bring a pair together only where a run may go on beyond a misread word, as long as what they
cover, with the K + W - 2 words on either side, is less than ``SHARE`` of the item: it can't be held by known runs of them alone.

Cases: null and empty texts share nothing; items of fewer than ``RUN`` words can't be found; repeated rows of one id
count once; very long texts are read whole, and of extra columns nothing is read; in scripts without blanks every letter is
a word; an identifier with several texts is held if one of them is.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millsheet.session import cut

K, W, RUN, SHARE = 3, 3, 8, 0.5
#: Items that may have a fingerprint that brings together all its pairs in the join.
COMMON = 3
#: Letters of all items together up to which they are broadcast.
ITEM_LETTERS = 20_000_000
#: Documents that are searched at once, and hits that are seen at once.
BATCH, HITS = 400, 100_000
#: Words on either side of a fingerprint that are seen with it: those a run may have without another one, the next, and its other part.
NEAR = W + 1

_CLASSES = str.maketrans("oe0cvij1tf|lmrhn568bgq9z2", "aaaauillllllnnnnsbbbgggss".replace("l", "i"))
_DIVIDED = re.compile(r"[-‐‑\u00ad¬](?<=[^\W\d_].)\s*\n\s*(?=[^\W\d_])|\u00ad")
_GLUE = re.compile(r"['’ʼ`\-‐‑](?<=\w.)(?=\w)")
_ACCENTS = re.compile("[\u0300-\u036f]+")
_WORD = re.compile(r"[^\W_]+")
_NO_BLANKS = re.compile("([\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff])")


def words_of(text: str) -> list[str]:
    """The words of a text without case, accents, punctuation, and divisions at line ends."""
    s = _GLUE.sub("", _DIVIDED.sub("", text))
    if not s.isascii():
        s = _NO_BLANKS.sub(r" \1 ", _ACCENTS.sub("", unicodedata.normalize("NFKD", s)))
    return _WORD.findall(s.lower())


class _Hashes(dict):
    """Hash of each word's classes of letters; forgets when it gets large."""

    def __missing__(self, w: str) -> int:
        if len(self) > 200_000:
            self.clear()
        h = self[w] = xxhash.xxh64_intdigest(w.translate(_CLASSES).replace("nn", "n"))
        return h


_LETTERS, _LENGTH = np.uint64((1 << 32) - 64), np.uint64(63)


class _Codes(dict):
    """64 bits of each word: a hash, the set of its letters (26), and its length (6); forgets when it gets large."""

    def __missing__(self, w: str) -> int:
        if len(self) > 200_000:
            self.clear()
        letters = 0
        for c in w:
            letters |= 64 << ord(c) % 26
        c = self[w] = (xxhash.xxh32_intdigest(w) << 32) | letters | min(len(w), 63)
        return c


def _alike(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether words of these codes can be the ``same``; false only where they can't."""
    x, y = (a & _LENGTH).astype(np.int64), (b & _LENGTH).astype(np.int64)
    return (np.bitwise_count((a ^ b) & _LETTERS) <= 3) & np.where(x == y, x > 1, (abs(x - y) == 1) & (np.maximum(x, y) >= 4))


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return ((a | b) & _LETTERS) | np.minimum((a & _LENGTH) + (b & _LENGTH), _LENGTH)


def reach(doc: np.ndarray, item: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of hits (codes of their words and the ``NEAR`` words around, in the text and in the item): equal words on the left and on
    the right, ``W`` at most, and whether the run may go on beyond a word that isn't equal.

    With ``W`` equal words on a side another hit stands in them, which tells the rest.
    """
    same_word = doc == item
    goes_on = ~same_word[:, NEAR : NEAR + K].all(axis=1)
    sizes = []
    for first, step in ((NEAR - 1, -1), (NEAR + K, 1)):
        size = np.zeros(len(doc), np.int64)
        for w in range(W):
            size += (size == w) & same_word[:, first + step * w]
        sizes.append(size)
        k = np.flatnonzero(size < W)
        at = first + step * size[k]
        d, i, d1, i1 = doc[k, at], item[k, at], doc[k, at + step], item[k, at + step]
        inside = ((d & _LENGTH) > 0) & ((i & _LENGTH) > 0)
        goes_on[k] |= inside & (_alike(d, i) | _alike(_joined(d, d1), i) | _alike(d, _joined(i, i1)))
    return sizes[0], sizes[1], goes_on


_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class Texts:
    """Words of several texts in a row, each followed by a word that is in no text, and their hashes."""

    def __init__(self, texts: list[list[str]], hashes: dict[str, int], end: int) -> None:
        self.words: list[str] = []
        starts = []
        for t in texts:
            starts.append(len(self.words))
            self.words += t
            self.words.append("")
        self.starts = np.array(starts, np.int64)
        self.ends = np.r_[self.starts[1:], len(self.words)][: len(texts)] - 1
        self.h = np.fromiter(map(hashes.__getitem__, self.words), np.uint64, len(self.words))
        self.h[self.ends] = end
        self.end = end
        self.of = np.repeat(np.arange(len(texts)), self.ends + 1 - self.starts)

    def fingerprints(self) -> tuple[np.ndarray, np.ndarray]:
        """(hashes, positions): the smallest K-gram hash of every W consecutive ones of a text."""
        n = len(self.h) - K + 1
        if n < 1:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        h = self.h[:n].copy()
        for k in range(1, K):
            h = (h ^ (h >> np.uint64(29))) * _A + self.h[k : k + n] * _B
        h ^= h >> np.uint64(32)
        # no K-gram goes beyond its text; a text of less than W K-grams has one window, which ends beyond it (as W <= K, in nothing else)
        whole = self.ends[self.of[:n]] - np.arange(n) >= K
        h[~whole] = np.iinfo(np.uint64).max
        h = np.r_[h, np.full(W - 1, np.iinfo(np.uint64).max, np.uint64)]
        at = np.arange(n)
        begin = whole & ((self.ends[self.of[:n]] - at >= K + W - 1) | (at == self.starts[self.of[:n]]))
        at = at[begin]
        views = np.stack([h[at + w] for w in range(W)])
        at = np.unique(at + views.argmin(axis=0))
        return h[at], at

    def code(self, codes: dict[str, int], at: np.ndarray) -> np.ndarray:
        """Codes of the words that ``near`` sees around the fingerprints at these places; those of other words may be missing."""
        size = len(self.words)
        sought = np.zeros(size + K + 2 * NEAR, bool)
        for k in range(K + 2 * NEAR):
            sought[at + k] = True
        sought = np.flatnonzero(sought[NEAR : NEAR + size])
        # what is beyond a text has no length and is no word of other texts
        out = np.full(size + K + 2 * NEAR, self.end << 32, np.uint64)
        out[NEAR + sought] = np.fromiter((codes[self.words[p]] for p in sought.tolist()), np.uint64, len(sought))
        out[NEAR + self.ends] = self.end << 32
        return out


def near(code: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Codes of the words of the fingerprints at these places and of the ``NEAR`` words before and after."""
    return code[at[:, None] + np.arange(K + 2 * NEAR)]


def same(a: str, b: str) -> bool:
    """Whether two words are one but for a misread letter."""
    if a == b:
        return True
    la, lb = len(a), len(b)
    if la == lb:
        k = next(i for i in range(la) if a[i] != b[i])
        return la > 1 and a[k + 1 :] == b[k + 1 :]
    if abs(la - lb) != 1 or max(la, lb) < 4:
        return False
    return a.replace("rn", "m").replace("m", "n") == b.replace("rn", "m").replace("m", "n") or (la < lb and any(b[:i] + b[i + 1 :] == a for i in range(lb))) or (lb < la and any(a[:i] + a[i + 1 :] == b for i in range(la)))


def _extend(doc: list[str], item: list[str], p: int, q: int, step: int) -> list[tuple[int, int, int]]:
    """Stretches (first place in the text, in the item, words) along which both agree, from (p, q) on in one direction."""
    out = []
    n, m = len(doc), len(item)
    while True:
        size = 0
        if step > 0:
            while size + 4 <= min(n - p, m - q) and doc[p + size : p + size + 4] == item[q + size : q + size + 4]:
                size += 4
            while p + size < n and q + size < m and same(doc[p + size], item[q + size]):
                size += 1
            if size:
                out.append((p, q, size))
        else:
            while size + 4 <= min(p, q) + 1 and doc[p - size - 3 : p - size + 1] == item[q - size - 3 : q - size + 1]:
                size += 4
            while p - size >= 0 and q - size >= 0 and same(doc[p - size], item[q - size]):
                size += 1
            if size:
                out.append((p - size + 1, q - size + 1, size))
        p, q = p + step * size, q + step * size
        if not (0 <= p < n and 0 <= q < m):
            return out
        if 0 <= p + step < n and same(doc[p] + doc[p + step] if step > 0 else doc[p + step] + doc[p], item[q]):
            out.append((min(p, p + step), q, 1))
            p, q = p + 2 * step, q + step
        elif 0 <= q + step < m and same(doc[p], item[q] + item[q + step] if step > 0 else item[q + step] + item[q]):
            out.append((p, min(q, q + step), 2))
            p, q = p + step, q + 2 * step
        else:
            return out


def looked_up(at: np.ndarray, count: np.ndarray, size: int) -> np.ndarray:
    """Which fingerprints (places in the item, items that have them) of an item of ``size`` words bring together all their pairs.

    The commonest don't, as long as what they cover can't be enough of the item: the rest has to be met elsewhere, or by a run
    that goes on beyond a misread word.
    """
    keep = np.ones(len(at), bool)
    covered = np.zeros(size, bool)
    for k in np.lexsort((at, -count)).tolist():
        if count[k] <= COMMON:
            break
        more = covered.copy()
        more[max(0, at[k] - (K + W - 2)) : at[k] + K + K + W - 2] = True
        if more.sum() < SHARE * size:
            keep[k], covered = False, more
    return keep


class Items:
    """Items: their words and an index of their fingerprints."""

    def __init__(self, items: list[tuple[int, str]]) -> None:
        self.ids = [i for i, _ in items]
        self.words = [words_of(t or "") for _, t in items]
        self.sizes = np.array([len(w) for w in self.words], np.int64)
        t = self.texts = Texts(self.words, _Hashes(), 2)
        h, at = t.fingerprints()
        order = np.argsort(h, kind="stable")
        self.h, self.at = h[order], at[order]
        self.code = t.code(_Codes(), self.at)
        # most fingerprints of a document are no item's: one bit of their hash tells
        self.bits = np.uint64(max(10, int(np.ceil(np.log2(max(1, len(h))))) + 4))
        self.maybe = np.zeros(1 << int(self.bits), bool)
        self.maybe[(self.h >> (np.uint64(64) - self.bits)).astype(np.int64)] = True
        self.codes = _Codes()

    def search(self, texts: list[str | None], hashes: dict[str, int]) -> list[tuple[int, int]]:
        """(place of the text, place of the item) for every text that holds an item."""
        docs = Texts([words_of(t or "") for t in texts], hashes, 1)
        h, at = docs.fingerprints()
        if not len(h) or not len(self.h):
            return []
        maybe = np.flatnonzero(self.maybe[(h >> (np.uint64(64) - self.bits)).astype(np.int64)])
        h, at = h[maybe], at[maybe]
        lo, hi = np.searchsorted(self.h, h), np.searchsorted(self.h, h, side="right")
        met = hi > lo
        at, lo, n = at[met], lo[met], (hi - lo)[met]
        if not len(at):
            return []
        code = docs.code(self.codes, at)
        # whole documents with about as many hits as are seen at once
        first = np.r_[True, np.diff(docs.of[at]) > 0]
        before = (np.cumsum(n) - n)[first] // HITS
        cuts = np.flatnonzero(first)[1:][np.diff(before) > 0]
        out = []
        for place, low, m in zip(*(np.split(c, cuts) for c in (at, lo, n))):
            x, y = np.repeat(place, m), self.at[np.repeat(low - (np.cumsum(m) - m), m) + np.arange(m.sum())]
            out += self._compare(docs, code, x, y)
        return out

    def _compare(self, docs: Texts, code: np.ndarray, x: np.ndarray, y: np.ndarray) -> list[tuple[int, int]]:
        """As ``search``, of all hits (places in the texts, in the items) of some texts."""
        pair = docs.of[x] * len(self.ids) + self.texts.of[y]
        seen = [reach(near(code, x[k : k + HITS]), near(self.code, y[k : k + HITS])) for k in range(0, len(x), HITS)]
        left, right, goes_on = (np.concatenate(c) for c in zip(*seen))
        # of pairs without a run that may go on, the places that the known runs cover; equal words that go further are in the next hits
        some = np.flatnonzero((left == W) | (right == W) | (left + K + right >= RUN))
        some = some[np.lexsort((y[some] - left[some], pair[some]))]
        pairs, rank = np.unique(pair[some], return_inverse=True)
        begin, end = ((rank * (len(self.texts.words) + 1) + y[some] + d) for d in (-left[some], K + right[some]))
        covered = np.maximum(0, end - np.maximum(begin, np.r_[0, np.maximum.accumulate(end)[:-1]])) if len(some) else end
        enough = np.bincount(rank, covered, len(pairs)) >= SHARE * self.sizes[pairs % len(self.ids)]
        wanted = np.union1d(pairs[enough], pair[goes_on])
        inside = np.isin(pair, wanted)
        x, y, pair = x[inside], y[inside], pair[inside]
        order = np.lexsort((x, x - y, pair))
        out = []
        for g in np.split(order, np.flatnonzero(np.diff(pair[order])) + 1) if len(order) else []:
            d, i = divmod(int(pair[g[0]]), len(self.ids))
            p0, q0 = int(docs.starts[d]), int(self.texts.starts[i])
            if self._holds(docs.words[p0 : int(docs.ends[d])], self.words[i], [(p - p0, q - q0) for p, q in zip(x[g].tolist(), y[g].tolist())]):
                out.append((d, i))
        return out

    @staticmethod
    def _holds(doc: list[str], item: list[str], hits: list[tuple[int, int]]) -> bool:
        """Whether the runs through the hits (place in the text, in the item; sorted by diagonal and place) cover enough of the item."""
        places: set[int] = set()
        diagonal, reach = None, -1  # and the place up to which its run is known
        for p, q in hits:
            if p - q == diagonal and p <= reach:
                continue
            diagonal, reach = p - q, p
            run = _extend(doc, item, p, q, 1)
            if not run:
                continue
            reach = run[0][0] + run[0][2] - 1
            run += _extend(doc, item, p - 1, q - 1, -1) if p and q else []
            if sum(x[2] for x in run) >= RUN:
                for _, b, size in run:
                    places.update(range(b, b + size))
        return len(places) >= SHARE * len(item) > 0

    def found(self, text: str, hashes: dict[str, int]) -> list[int]:
        """The identifiers of the items that one text holds."""
        return [self.ids[i] for _, i in self.search([text], hashes)]


_PAIRS = "doc_id long, item_id long"


def _in_one_pass(documents: DataFrame, items: DataFrame) -> DataFrame:
    rows = sorted({(r[0], r[1]) for r in items.toLocalIterator()})
    held = documents.sparkSession.sparkContext.broadcast(Items(rows))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, index = _Hashes(), held.value
        for whole in batches:
            for k in range(0, whole.num_rows, BATCH):
                b = whole.slice(k, BATCH)
                ids = b.column("doc_id").to_pylist()
                got = [(ids[d], index.ids[i]) for d, i in index.search(b.column("text").to_pylist(), hashes)]
                yield pa.RecordBatch.from_arrays([pa.array([g[k] for g in got], pa.int64()) for k in (0, 1)], names=["doc_id", "item_id"])

    return documents.mapInArrow(search, _PAIRS).distinct()


def _lists(codes: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(codes) + 1) * codes.shape[1], pa.int32()), pa.array(codes.reshape(-1).view(np.int64)))


def _by_join(documents: DataFrame, items: DataFrame) -> DataFrame:
    def texts(batches: Iterator[pa.RecordBatch], end: int) -> Iterator[tuple[pa.RecordBatch, Texts]]:
        hashes = _Hashes()
        for whole in batches:
            for k in range(0, whole.num_rows, BATCH):
                b = whole.slice(k, BATCH)
                yield b, Texts([words_of(x or "") for x in b.column("text").to_pylist()], hashes, end)

    def of_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = _Codes()
        for b, t in texts(batches, 2):
            h, at = t.fingerprints()
            own = t.of[at]
            ids = np.array(b.column("item_id").to_pylist(), np.int64)[own]
            size, p = (t.ends - t.starts)[own].astype(np.int32), (at - t.starts[own]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(size), pa.array(h.view(np.int64)), pa.array(p), _lists(near(t.code(codes, at), at))], names=["item_id", "size", "h", "p", "near"])

    def of_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, t in texts(batches, 1):
            h, at = t.fingerprints()
            yield pa.RecordBatch.from_arrays([pa.array(np.array(b.column("doc_id").to_pylist(), np.int64)[t.of[at]]), pa.array(h.view(np.int64))], names=["doc_id", "h"])

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for i, size, fs in zip(b.column("item_id").to_pylist(), b.column("size").to_pylist(), b.column("fs").to_pylist()):
                p, c = np.array([f["p"] for f in fs], np.int64), np.array([f["c"] for f in fs], np.int64)
                out += [(i, f["h"], None if keep else f["near"]) for f, keep in zip(fs, looked_up(p, c, size).tolist())]
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64()), pa.array([o[2] for o in out], pa.list_(pa.int64()))], names=["item_id", "h", "near"])

    def around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = _Codes()
        for b, t in texts(batches, 1):
            h, at = t.fingerprints()
            hs = [set(x) for x in b.column("hs").to_pylist()]
            some = np.array([x in hs[d] for x, d in zip(h.view(np.int64).tolist(), t.of[at].tolist())], bool)
            h, at = h[some], at[some]
            yield pa.RecordBatch.from_arrays([pa.array(np.array(b.column("doc_id").to_pylist(), np.int64)[t.of[at]]), pa.array(h.view(np.int64)), _lists(near(t.code(codes, at), at))], names=["doc_id", "h", "near"])

    def going_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            doc, item = (b.column(c).flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(-1, K + 2 * NEAR) for c in ("near", "other"))
            yield b.select(["doc_id", "item_id"]).filter(pa.array(reach(doc, item)[2]))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for b in batches:
            got = [(d, i) for d, i, t, x in zip(*(b.column(c).to_pylist() for c in ("doc_id", "item_id", "text", "item"))) if Items([(i, x)]).found(t, hashes)]
            yield pa.RecordBatch.from_arrays([pa.array([g[k] for g in got], pa.int64()) for k in (0, 1)], names=["doc_id", "item_id"])

    own = items.mapInArrow(of_items, "item_id long, size int, h long, p int, near array<long>")
    count = own.groupBy("h").agg(F.countDistinct("item_id").alias("c"))
    # an item's fingerprints are bounded by its own length
    sought = cut(own.join(count, "h").groupBy("item_id", "size").agg(F.collect_list(F.struct("h", "p", "c", "near")).alias("fs")).mapInArrow(choose, "item_id long, h long, near array<long>").distinct())
    common = sought.where("near is not null")
    # the corpus is read once for all fingerprints; of the common ones the rows say only that a document has them
    wanted = sought.where("near is null").select("item_id", "h").union(common.select(F.lit(None).cast("long").alias("item_id"), "h")).distinct()
    met = cut(documents.mapInArrow(of_documents, "doc_id long, h long").join(wanted, "h").select("doc_id", "item_id", F.when(F.col("item_id").isNull(), F.col("h")).alias("h")).distinct())
    has = met.where("item_id is null").groupBy("doc_id").agg(F.collect_set("h").alias("hs"))
    seen = documents.join(has, "doc_id").mapInArrow(around, "doc_id long, h long, near array<long>").distinct()
    weak = seen.join(common.withColumnRenamed("near", "other"), "h").select("doc_id", "item_id", "near", "other").mapInArrow(going_on, _PAIRS)
    pairs = met.where("item_id is not null").select("doc_id", "item_id").union(weak).distinct()
    return pairs.join(documents, "doc_id").join(items.withColumnRenamed("text", "item"), "item_id").mapInArrow(compare, _PAIRS).distinct()


def find_leaks(documents: DataFrame, items: DataFrame, item_letters: int = ITEM_LETTERS) -> DataFrame:
    """``doc_id``, ``item_id`` of every document (doc_id, text) that holds an item (item_id, text)."""
    items = items.where("item_id is not null and text is not null").select("item_id", "text")
    documents = documents.where("doc_id is not null and text is not null").select("doc_id", "text")
    letters = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    return _in_one_pass(documents, items) if letters <= item_letters else _by_join(documents, items)
