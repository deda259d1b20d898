"""Texts of varying length packed into containers of fixed capacity.

Lengths are tokens of a public tokenizer. A text longer than the capacity is cut into full containers and a rest; nothing
else is divided. The items are dealt to parts of at most ``PART`` items; every part packs by best-fit decreasing and proves
by dual feasible functions how few containers its items can need. A part that needs more than its bound gives up its
emptiest containers; what parts give up is dealt anew, across parts, and packed again, and the new packing is kept where
it needs fewer containers. Rounds end when all parts are certified, nothing improves, or after ``ROUNDS``.

Cases: null and empty texts take no container; rows repeated under one id count once; a null or non-positive capacity is
no container size; equal lengths are placed by identifier; texts of any length are read whole; extra columns are dropped.
"""

from __future__ import annotations

import base64
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millsheet.session import cut

#: Items that are packed together; rounds of exchange.
PART, ROUNDS = 20_000, 3
#: The setting that names the tokenizer's file of ranks, and the file taken if it is unset; the setting with ``.pattern`` names the pattern that cuts texts.
SETTING, DEFAULT = "spark.millsheet.tokenizer", "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"

_ENCODINGS: dict[str, object] = {}


def encoding(ranks: bytes, pattern: str):  # noqa: ANN201
    """The tokenizer of a file of ranks; made once per worker."""
    import tiktoken

    key = hashlib.sha1(ranks + pattern.encode()).hexdigest()  # noqa: S324
    if key not in _ENCODINGS:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines()) if a}
        _ENCODINGS[key] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=table, special_tokens={})
    return _ENCODINGS[key]


def count_tokens(documents: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id``, ``tokens`` of every text (doc_id, text) that has any."""
    spark = documents.sparkSession
    path = path or spark.conf.get(SETTING, None) or DEFAULT
    pattern = spark.conf.get(f"{SETTING}.pattern", None)
    if pattern is None:
        # counts of another pattern would be other counts: without the pattern that belongs to the file this fails
        from public_tokenizers import PATTERN as pattern
    with open(path, "rb") as f:
        ranks = f.read()
    shared = spark.sparkContext.broadcast((ranks, pattern))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoding(*shared.value).encode_ordinary
        for b in batches:
            sizes = [len(encode(t)) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(sizes, pa.int64())], names=["doc_id", "tokens"])

    return documents.where("doc_id is not null and text is not null and text <> ''").select("doc_id", "text").mapInArrow(run, "doc_id long, tokens long").dropDuplicates(["doc_id"])


def lower_bound(sizes: np.ndarray, capacity: int) -> int:
    """Containers that items of these sizes need at least, by two families of dual feasible functions."""
    x, n = np.unique(sizes.astype(np.int64), return_counts=True)
    return lower_bound_of(x, n, capacity)


def lower_bound_of(x: np.ndarray, times: np.ndarray, capacity: int) -> int:
    """``lower_bound`` of distinct sizes that occur so many times."""
    if not len(x):
        return 0
    best = -(-int((x * times).sum()) // capacity)
    # items above capacity - e fill a container, items below e vanish
    count = np.zeros(capacity + 1, np.int64)
    count[x] = times
    weight = count * np.arange(capacity + 1)
    n, w = np.r_[0, np.cumsum(count)], np.r_[0, np.cumsum(weight)]
    e = np.arange(capacity // 2 + 1)
    large = n[capacity + 1] - n[capacity - e + 1]
    middle = w[capacity - e + 1] - w[e]
    best = max(best, int((large + -(-middle // capacity)).max()))
    # rounding down to multiples of capacity / (k + 1), exact multiples unchanged
    for k in range(1, 12):
        y = x * (k + 1)
        # f(x) * k * capacity in whole numbers
        f = np.where(y % capacity == 0, x * k, (y // capacity) * capacity)
        best = max(best, -(-int((f * times).sum()) // (k * capacity)))
    return best


def least_containers(packed: DataFrame, capacity: int) -> int:
    """Containers that the pieces of a packing (capacity_id, tokens) of one capacity need at least, all parts together."""
    # one row for each length, of which there are no more than the capacity
    count = packed.groupBy("tokens").count().collect()
    return lower_bound_of(np.array([r[0] for r in count], np.int64), np.array([r[1] for r in count], np.int64), capacity)


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Container number of each item; ``sizes`` is in decreasing order."""
    open_: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask, made = 0, 0
    out = np.zeros(len(sizes), np.int64)
    for i, s in enumerate(sizes.tolist()):
        fits = mask >> s
        if fits:
            r = s + ((fits & -fits).bit_length() - 1)
            b = open_[r].pop()
            if not open_[r]:
                mask &= ~(1 << r)
        else:
            r, b = capacity, made
            made += 1
        out[i] = b
        left = r - s
        if left:
            open_[left].append(b)
            mask |= 1 << left
    return out


PACKED = "capacity_id int, capacity int, doc_id long, piece_no int, tokens int, part long, bin long, loose boolean"


def _pack(pdf: pd.DataFrame) -> pd.DataFrame:
    """Packs one part; marks the containers it gives up."""
    pdf = pdf.sort_values(["tokens", "doc_id", "piece_no"], ascending=[False, True, True], ignore_index=True)
    capacity = int(pdf.capacity.iloc[0])
    sizes = pdf.tokens.to_numpy()
    bins = best_fit_decreasing(sizes, capacity)
    made = int(bins.max()) + 1
    gap = made - lower_bound(sizes, capacity)
    loose = np.zeros(made, bool)
    if gap > 0:
        fill = np.bincount(bins, weights=sizes, minlength=made)
        loose[np.argsort(fill, kind="stable")[: min(made, 8 * gap + 8)]] = True
    return pdf.assign(bin=bins, loose=loose[bins])[["capacity_id", "capacity", "doc_id", "piece_no", "tokens", "part", "bin", "loose"]]


def _parted(items: DataFrame, count: dict[int, int], round_: int) -> DataFrame:
    """Deals the items of each capacity to as many parts as they need."""
    n = F.lit(1)
    for k, c in count.items():
        n = F.when(F.col("capacity_id") == k, F.lit(max(1, math.ceil(c / PART)))).otherwise(n)
    # parts of different rounds have different numbers
    return items.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece_no", F.lit(round_)), n) + F.lit(round_ << 32))


def pack(lengths: DataFrame, capacities: DataFrame) -> DataFrame:
    """The container and place of every text or piece of it, for each capacity.

    ``lengths``: doc_id, tokens; ``capacities``: capacity_id, capacity_tokens (a few rows). Result: capacity_id,
    container, place, doc_id, piece_no, start_token, tokens.
    """
    lengths = cut(lengths)
    sizes = sorted({(int(r[0]), int(r[1])) for r in capacities.select("capacity_id", "capacity_tokens").collect() if r[0] is not None and r[1] and r[1] > 0})
    # every length once for each of the few capacities
    caps = F.array(*[F.struct(F.lit(k).alias("capacity_id"), F.lit(c).alias("capacity")) for k, c in sizes]) if sizes else F.expr("cast(array() as array<struct<capacity_id: int, capacity: int>>)")
    each = lengths.where("tokens > 0").select("doc_id", "tokens", F.explode(caps).alias("c")).select("doc_id", "tokens", "c.*")
    whole = each.where(F.col("tokens") >= F.col("capacity")).select("capacity_id", "capacity", "doc_id", F.explode(F.sequence(F.lit(0), (F.floor(F.col("tokens") / F.col("capacity")) - 1).cast("int"))).alias("piece_no"))
    full = whole.select("capacity_id", F.concat_ws("-", F.lit("full"), "doc_id", "piece_no").alias("container"), F.lit(1).alias("place"), "doc_id", "piece_no", (F.col("piece_no").cast("long") * F.col("capacity")).alias("start_token"), F.col("capacity").cast("int").alias("tokens"))
    rest = each.where(F.col("tokens") % F.col("capacity") > 0).select("capacity_id", "capacity", "doc_id", F.floor(F.col("tokens") / F.col("capacity")).cast("int").alias("piece_no"), (F.col("tokens") % F.col("capacity")).cast("int").alias("tokens"))
    total = {r[0]: r[1] for r in rest.groupBy("capacity_id").count().collect()}
    columns = ["capacity_id", "capacity", "doc_id", "piece_no", "tokens"]
    packed = cut(_parted(rest, total, 0).groupBy("capacity_id", "part").applyInPandas(_pack, PACKED))
    done = [packed.where("not loose")]
    open_ = packed.where("loose")
    for round_ in range(1, ROUNDS + 1):
        before = {r[0]: (r[1], r[2]) for r in open_.groupBy("capacity_id").agg(F.count("*"), F.countDistinct("part", "bin")).collect()}
        if not before:
            break
        again = cut(_parted(open_.select(columns), {k: n for k, (n, _) in before.items()}, round_).groupBy("capacity_id", "part").applyInPandas(_pack, PACKED))
        after = {r[0]: r[1] for r in again.groupBy("capacity_id").agg(F.countDistinct("part", "bin")).collect()}
        better = [k for k in before if after[k] < before[k][1]]
        done.append(open_.where(~F.col("capacity_id").isin(better)) if better else open_)
        if not better:
            open_ = None
            break
        kept = again.where(F.col("capacity_id").isin(better))
        done.append(kept.where("not loose"))
        open_ = kept.where("loose")
    if open_ is not None:
        done.append(open_)
    rows = done[0]
    for d in done[1:]:
        rows = rows.unionByName(d)
    place = F.row_number().over(Window.partitionBy("capacity_id", "part", "bin").orderBy(F.desc("tokens"), "doc_id", "piece_no"))
    shared = rows.select("capacity_id", F.concat_ws("-", "part", "bin").alias("container"), place.alias("place"), "doc_id", "piece_no", (F.col("piece_no").cast("long") * F.col("capacity")).alias("start_token"), "tokens")
    return full.unionByName(shared)
