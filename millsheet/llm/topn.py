"""The N best rows of every group by simultaneous bisection of per-group cutoffs.

The rank of a row is a code of three unsigned words that preserves order: the score's bits, then the inverted position,
then the inverted identifier. For all groups at once a cutoff is refined: the middle between its bounds is taken, the
rows above it are counted per group, and one bound moves, until exactly N rows of each group are above; rows that the
bounds have decided take no more part, and groups tied on one word go on to the next. The best N of a group's parts
contain the best N of the group, so the search runs on the map side first and then over whole groups; of each group only
N rows per chunk of input are shuffled, however large the group is, and the last search also works in chunks.

Cases: rows without a group value, an identifier or a numeric (non-NaN) score take no part; a null position comes last;
rows repeated under one identifier count once; ties of all three words are the same row; extra columns are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows that one vectorised search covers.
CHUNK = 65536

_TOP = np.uint64(1 << 63)
_SCHEMA = "grp string, score double, pos long, id long"


def ordered_bits(score: np.ndarray) -> np.ndarray:
    """Unsigned words in the order of the doubles."""
    b = (score + 0.0).view(np.uint64)  # -0.0 becomes 0.0
    return np.where(b & _TOP, ~b, b | _TOP)


def _inverted(x: np.ndarray) -> np.ndarray:
    return ~(x.view(np.uint64) ^ _TOP)


def bisect(group: np.ndarray, words: list[np.ndarray], n: int) -> np.ndarray:
    """Mask of the ``n`` rows with the largest codes in each group; ``group`` is sorted, codes are distinct."""
    keep = np.zeros(len(group), bool)
    rows = np.arange(len(group))
    need = np.full(int(group[-1]) + 1 if len(group) else 0, n)
    for word in words:
        if not len(rows):
            break
        g, v = group[rows], word[rows]
        starts = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
        ids = g[starts]
        size = np.diff(np.r_[starts, len(g)])
        small = size <= need[ids]
        keep[rows[np.repeat(small, size)]] = True
        low, high = np.minimum.reduceat(v, starts), np.maximum.reduceat(v, starts)
        # invariant: fewer than need rows above high, at least need rows at or above low
        local = np.repeat(np.arange(len(ids)), size)
        live = np.repeat(~small & (low < high), size)
        above = np.zeros(len(ids), np.int64)  # rows of the group decided to be above
        act_v, act_l = v[live], local[live]
        while len(act_v):
            mid = low + (high - low) // np.uint64(2) + ((high - low) & np.uint64(1))
            up = act_v >= mid[act_l]
            count = above + np.bincount(act_l[up], minlength=len(ids))
            enough = count >= need[ids]
            low = np.where(enough & (low < high), mid, low)
            high2 = np.where(~enough & (low < high), mid - np.uint64(1), high)
            # rows at or above a rejected middle are decided: they are above the cutoff
            decided = up & ~enough[act_l]
            above += np.bincount(act_l[decided], minlength=len(ids))
            high = high2
            stay = ~decided & (act_v >= low[act_l]) & (low < high)[act_l]
            act_v, act_l = act_v[stay], act_l[stay]
        cut = low[local]
        big = ~np.repeat(small, size)
        keep[rows[big & (v > cut)]] = True
        won = np.bincount(local[big & (v > cut)], minlength=len(ids))
        need[ids] = np.where(small, 0, need[ids] - won)
        rows = rows[big & (v == cut)]
    # what is equal in all words fills the places left
    if len(rows):
        g = group[rows]
        keep[rows[np.bincount(g, minlength=len(need))[g] <= need[g]]] = True
    return keep


def _best(grp: pa.Array, score: np.ndarray, pos: np.ndarray, ident: np.ndarray, n: int) -> np.ndarray:
    """Row numbers of the ``n`` best distinct rows of each group."""
    code = grp.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    order = np.argsort(code, kind="stable")
    # copies of a row differ in nothing: drop them by (group, id)
    pair = np.lexsort((ident[order], code[order]))
    o = order[pair]
    first = np.r_[True, (code[o][1:] != code[o][:-1]) | (ident[o][1:] != ident[o][:-1])] if len(o) else np.zeros(0, bool)
    o = o[first]
    return o[bisect(code[o], [ordered_bits(score[o]), _inverted(pos[o]), _inverted(ident[o])], n)]


def _searcher(n: int, whole: bool):  # noqa: ANN202
    """A pass over Arrow batches. ``whole``: they are sorted by group, no group is divided, and ranks come out."""

    def ranked(t: pa.Table) -> pa.Table:
        code = t.column("grp").combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
        pos, ident = t.column("pos").to_numpy(), t.column("id").to_numpy()
        order = np.lexsort((ident, pos, -t.column("score").to_numpy(), code))
        c = code[order]
        start = np.flatnonzero(np.r_[True, c[1:] != c[:-1]])
        rank = np.arange(len(c)) - np.repeat(start, np.diff(np.r_[start, len(c)])) + 1
        return pa.table({"id": ident[order], "rank_no": rank.astype(np.int32)})

    def best(t: pa.Table) -> pa.Table:
        got = _best(t.column("grp").combine_chunks(), *(t.column(c).to_numpy() for c in ("score", "pos", "id")), n)
        return t.take(pa.array(np.sort(got)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        count = 0
        for b in batches:
            held.append(b)
            count += b.num_rows
            if count < CHUNK:
                continue
            t = best(pa.Table.from_batches(held))
            held, count = [], 0
            if whole and t.num_rows:  # the last group may go on
                last = t.column("grp")[-1].as_py()
                k = int(np.argmax(t.column("grp").to_numpy() == last))
                held, t = t.slice(k).to_batches(), t.slice(0, k)
                count = sum(h.num_rows for h in held)
            if t.num_rows:
                yield from (ranked(t) if whole else t).combine_chunks().to_batches()
        if count:
            t = best(pa.Table.from_batches(held))
            yield from (ranked(t) if whole else t).combine_chunks().to_batches()

    return run


def top_n(rows: DataFrame, group: list[Column], score: Column, position: Column, identifier: Column, n: int) -> DataFrame:
    """``id`` and ``rank_no`` (from 1) of the ``n`` best rows of each group: score descending, then position, then identifier."""
    s = score.cast("double")
    some = s.isNotNull() & ~F.isnan(s) & identifier.isNotNull()
    for g in group:
        some = some & g.isNotNull()
    cols = rows.where(some).select(F.concat_ws("\u0001", *group).alias("grp"), s.alias("score"), F.coalesce(position.cast("long"), F.lit(2**63 - 1)).alias("pos"), identifier.cast("long").alias("id"))
    parts = cols.mapInArrow(_searcher(n, whole=False), _SCHEMA)
    return parts.repartition("grp").sortWithinPartitions("grp").mapInArrow(_searcher(n, whole=True), "id long, rank_no int")
