"""Variant spellings of company names linked to one canonical form by a noisy channel.

A name is read as given name, core words, trade and legal form; the core (its words without order, case and accents) is
what a company is known by; a core of one word is known by its trade as well. Cores are ranked by the number of spellings
they are written in, then by rows. Every core looks for the canonical form it may be a noisy copy of: a higher-ranked core
that differs by a few letters, or any core that it shortens to an initial, joins into one word, adds a word to or leaves the
trade from (equi-joins on deletion variants, halves and word sets). The posterior of a form is its frequency prior times the
likelihood of what leads from it to the variant, once for each spelling of the variant, as different spellings are typed
independently and repeated rows are copies. That the variant is a company of its own competes with these: its own frequency
times ``OWN``, the chance that two companies have names that close. The variant goes to the maximum; chains are followed to
their end.

Cases: null and blank names, and strings that name no company (labels, remarks, nothing but legal forms), link to
nothing; words with digits have to agree exactly; strings are compared as they stand, so that two spellings differing in a
blank are two names; ties of the posterior go to the first core by code point; a repeated row only adds to the frequency.
A word that more than ``HOT`` cores have is no key by itself, but only together with the words beside it.
"""

from __future__ import annotations

import itertools
import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millsheet.llm.canonical import deletions, edits
from millsheet.session import cut, discard

#: Log likelihood of one edit, of a word shortened to its initial, of words joined, of a word more and of a trade left out; fixed by the share of such errors in typed names.
EDIT, INITIAL, JOINED, EXTRA, BARE = -3.5, -2.5, -2.0, -4.0, -1.0
#: Log prior of two companies with names within ``FURTHEST`` edits.
OWN = -16.0
#: A variant further away than this is a company of its own, however rare it is.
FURTHEST = 3
#: Cores that a word may have as a key by itself.
HOT = 500
#: Words longer than this meet by their parts, as deletions give too many variants.
LONG = 40

LEGAL = {
    "inc": "inc incorporated", "ltd": "ltd limited", "sarl": "sarl", "sas": "sas", "sa": "sa", "gmbh": "gmbh mbh", "group": "group grp groupe gruppe", "corp": "corp corporation",
    "fils": "fils", "llc": "llc", "bv": "bv", "ag": "ag", "spa": "spa", "srl": "srl", "plc": "plc", "co": "co company compagnie cie", "kg": "kg",
}
TRADE = {
    "stahlbau": "stahlbau stahlb", "piping works": "piping works wks pip", "steel services": "steel services svcs", "boilermaking": "chaudronnerie chaudr", "metalwork": "metallerie metall metal",
    "welding": "soudage soud", "manufacturing": "manufacturing mfg", "pipework": "tuyauterie tuy", "industries": "industries industrie ind",
}
PREFIX = "etablissements ets ste societe the et and und mr mrs ms mme m monsieur madame herr frau messrs dr"
#: Given names with their usual short forms.
GIVEN = {
    "johannes": "johannes hans", "giuseppe": "giuseppe beppe", "francisco": "francisco paco", "guillaume": "guillaume guy", "theodore": "theodore ted", "alexandre": "alexandre alex alexander",
    "jean-baptiste": "jean baptiste jb jean-baptiste", "margaret": "margaret peggy maggie", "robert": "robert bob", "elizabeth": "elizabeth liz betty beth", "katharina": "katharina kathi kathy", "william": "william bill will",
    "richard": "richard dick", "edward": "edward ned", "henry": "henry harry", "john": "john jack", "antonio": "antonio toni", "jose": "jose pepe", "pierre": "pierre", "michael": "michael mike",
}
_ROLE: dict[str, tuple[str, str]] = {}
for _kind, _words in (("legal", LEGAL), ("trade", TRADE), ("given", GIVEN), ("prefix", {"": PREFIX})):
    for _k, _ws in _words.items():
        for _w in _ws.split():
            _ROLE.setdefault(_w, (_kind, _k))
_LONG = {}
for _w in _ROLE:
    if len(_w) >= 5:
        for _v in deletions(_w, 1):
            _LONG.setdefault(_v, set()).add(_w)
_NO_NAME = re.compile(r"[:@/]|\b(?:tel|fax|www|adresse|address|livraison|delivery|page|voir|see|selon|liste|idem|unknown|inconnu|fournisseur|supplier|client|n/?a|none|tbd)\b", re.I)


def _role(word: str) -> tuple[str, str] | None:
    if r := _ROLE.get(word):
        return r
    if len(word) >= 5:
        near = [w for v in deletions(word, 1) for w in _LONG.get(v, ()) if edits(word, w, 1) <= 1]
        if near:
            return _ROLE[min(near)]
    return None


def _split(word: str) -> tuple[str, str]:
    """A core's word and its trade, which only cores of one word have."""
    w, _, trade = word.partition("/")
    return w, trade


def read_name(name: str) -> tuple[str, str] | None:
    """(form, core) of a name, None if it names no company. Forms: full, and initial (a word and the initial of another)."""
    s = unicodedata.normalize("NFKC", name).strip()
    if not s or _NO_NAME.search(s):
        return None
    s = re.sub(r"(?<=[a-zà-ÿ])(?=[A-ZÀ-Þ][a-zà-ÿ])", " ", s)  # words that lost the blank between them
    s = "".join(c for c in unicodedata.normalize("NFKD", s.lower()) if not unicodedata.combining(c))
    s = re.sub(r"\b([a-z])\.\s?(?=[a-z]\b\.?)", r"\1", s)  # s.a.r.l.
    s = re.sub(r"(?<=[a-z])0|0(?=[a-z])", "o", re.sub(r"(?<=[a-z])[1|]|[1|](?=[a-z])", "l", s))
    roles = [(w, _role(w)) for w in re.findall(r"[^\W_]+", s)]
    kept = lambda w, r: r is None and (len(w) > 1 or w.isdigit())
    core = [w for w, r in roles if kept(w, r)]
    after = next((i for i, (w, r) in enumerate(roles) if kept(w, r)), len(roles))
    single = [w for i, (w, r) in enumerate(roles) if len(w) == 1 and not w.isdigit() and (r is None or r[0] == "prefix" and i > after)]
    if not core:  # a name of usual words alone
        core = sorted({r[1].replace(" ", "") for _, r in roles if r and r[0] in ("trade", "given")})
        if len(core) < 2:
            return None
    if all(w.isdigit() for w in core):
        return None
    if len(core) == 1 and single:
        return "initial", f"{core[0]} {single[-1]}"
    if len(core) == 1 and (trades := sorted({r[1] for _, r in roles if r and r[0] == "trade"})):
        return "full", f"{core[0]}/{trades[0].replace(' ', '')}"
    return "full", " ".join(sorted(core))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        got = [(n, *r, m) for n, m in zip(b.column("name").to_pylist(), b.column("n").to_pylist()) if (r := read_name(n))]
        yield pa.RecordBatch.from_arrays([*(pa.array([g[k] for g in got], pa.string()) for k in range(3)), pa.array([g[3] for g in got], pa.int64())], names=["name", "form", "core", "n"])


def _once(word: str) -> set[str]:
    """What two words within one edit share: deletion variants, or one half of long ones."""
    if word.isdigit():
        return {word}
    n = len(word)
    out = deletions(word, 1) if n <= LONG + 1 else set()
    for size in range(max(LONG + 1, n - 1), n + 2):
        out |= {f"{size}< {word[: size // 2]}", f"{size}> {word[n - (size - size // 2) :]}"}
    return out


def _fifths(word: str, size: int, shifts: range) -> set[str]:
    """The fifths of a word of ``size`` letters, at ``shifts``: two edits, each within two of them, leave one whole."""
    at = [size * i // 5 for i in range(6)]
    return {f"{size} {i} {word[a + x : b + x]}" for i, (a, b) in enumerate(itertools.pairwise(at)) for x in shifts if a + x >= 0 and b + x <= len(word)}


def _twice(word: str) -> set[str]:
    """What two words within two edits share."""
    if word.isdigit():
        return {word}
    n = len(word)
    out = deletions(word, 2) if n <= LONG + 2 else set()
    return out.union(*(_fifths(word, size, range(-2, 3)) for size in range(max(LONG + 1, n - 2), n + 3)))


def _joined_keys(joined: str, copy: bool) -> set[str]:
    """What a joined form (``copy``: that may have two edits) and the joined words share: one half within one edit."""
    n = len(joined)
    out: set[str] = set()
    for size in range(n - 2, n + 3) if copy else (n,):
        if size > 2 * LONG:
            out |= _fifths(joined, size, range(-2, 3) if copy else range(1))
            continue
        for d in (-1, 0, 1) if copy else (0,):
            out |= {f"{size}< {v}" for v in _once(joined[: max(0, size // 2 + d)])} | {f"{size}> {v}" for v in _once(joined[max(0, n - (size - size // 2) - d) :])}
    return out


def _set_key(words: list[str], without: int | None = None) -> int:
    """A number of the words as a set, less one of them."""
    h = sum(xxhash.xxh64_intdigest(w) for i, w in enumerate(words) if i != without)
    return h & (2**64 - 1)


def _keys(form: str, core: str, hot: dict[str, list[tuple[str, int]]]) -> Iterator[tuple[str, bool, bool]]:
    """(key, whether as canonical form, whether as variant) of a core; ``hot``: its words' hot neighbours with their distance."""
    words = core.split()
    if form == "initial":
        yield from ((f"i {words[1]} {v}", False, True) for v in _once(words[0]))
        return
    m = len(words)
    if m == 1:
        w, trade = _split(words[0])
        yield from ((f"1 {trade} {v}", True, True) for v in _once(w))
        yield f"t {w}", bool(trade), not trade
        if not w.isdigit():
            yield from ((f"j {v}", False, True) for v in _joined_keys(w, True))
        return
    for i, w in enumerate(words):
        others = words[:i] + words[i + 1 :]
        near = hot.get(w, [])
        if not any(d < 2 for _, d in near):
            yield from ((f"w {m} {v}", True, True) for v in _once(w))
        for h, _ in near:
            yield from ((f"h {m} {h} {v}", True, True) for o in others for v in (_twice(o) if m == 2 else _once(o)))
    if m == 2:
        for w, o in (words, words[::-1]):
            yield from ((f"i {o[0]} {v}", True, False) for v in _once(w))
    if m <= 3:
        for p in itertools.permutations(words):
            yield from ((f"j {v}", True, False) for v in _joined_keys("".join(p), False))
    whole = _set_key(words)
    yield f"x {m} {whole}", True, True
    for i in range(m):
        part = _set_key(words, i)
        if m > 2:
            yield f"x {m - 1} {part}", True, True


def _apart(words: list[str], others: list[str]) -> int:
    """Edits between two sets of as many words, ``FURTHEST`` + 1 if more; words with digits and of under four letters agree exactly."""
    a, b = sorted(words), sorted(others)
    for w in list(a):
        if w in b:
            a.remove(w)
            b.remove(w)
    best = FURTHEST + 1
    if len(a) > FURTHEST:
        return best
    for p in itertools.permutations(b):
        total = 0
        for x, y in zip(a, p):
            long = max(len(x), len(y))
            most = 0 if long < 4 or x.isdigit() or y.isdigit() else 1 if long < 6 else 2
            d = edits(x, y, most)
            total = total + d if d <= most else best
            if total >= best:
                break
        best = min(best, total)
    return best


def likelihood(form: str, core: str, canonical: str) -> tuple[float, bool] | None:
    """Log likelihood that ``canonical`` was written as ``core``, and whether ``core`` may be a company of its own; None if it is too far away."""
    words, full = core.split(), canonical.split()
    if form == "initial":
        w, i = words
        ways = [d for p, q in (full, full[::-1]) if q[0] == i and (d := edits(w, p, 1)) <= 1] if len(full) == 2 else []
        return (INITIAL + EDIT * min(ways), False) if ways else None
    if len(words) == len(full) == 1:
        (w, t), (v, s) = _split(core), _split(canonical)
        d = _apart([w], [v])
        if t == s:
            return (EDIT * d, True) if d <= 1 else None
        return (BARE, False) if d == 0 and not t else None
    if len(words) == 1:
        w = _split(core)[0]
        ways = [d for p in itertools.permutations(full) if (d := edits(w, "".join(p), 2)) <= 2] if len(full) <= 3 else []
        return (JOINED + EDIT * min(ways), True) if ways else None
    if len(words) == len(full):
        d = _apart(words, full)
        return (EDIT * d, True) if d <= FURTHEST else None
    more, less = (words, full) if len(words) > len(full) else (full, words)
    if len(more) == len(less) + 1 and len(less) > 1 and not Counter(less) - Counter(more):
        return EXTRA, True
    return None


def _with_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.bool_()]
    names = ["form", "core", "k", "n", "key", "canonical", "variant"]
    for b in batches:
        rows: list[tuple] = []
        for f, c, k, n, hot in zip(*(b.column(x).to_pylist() for x in ("form", "core", "k", "n", "hot"))):
            near: dict[str, list[tuple[str, int]]] = {}
            for x in hot or ():
                near.setdefault(x["word"], []).append((x["hot"], x["d"]))
            rows += [(f, c, k, n, *x) for x in set(_keys(f, c, near))]
            if len(rows) > 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], names=names)
                rows.clear()
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], names=names)


def _posterior(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = []
        for f, c, k, to, to_k in zip(*(b.column(x).to_pylist() for x in ("form", "core", "k", "to", "to_k"))):
            if (x := likelihood(f, c, to)) is not None:
                score = math.log(to_k) + k * x[0]
                if not x[1] or score > math.log(k) + OWN:
                    out.append((f, c, to, score))
        yield pa.RecordBatch.from_arrays([*(pa.array([o[i] for o in out], pa.string()) for i in range(3)), pa.array([o[3] for o in out], pa.float64())], names=["form", "core", "to", "score"])


def _hot_words(cores: DataFrame) -> DataFrame:
    """form, core and ``hot``: for its words within two edits of a word that more than ``HOT`` cores have, that and the distance."""
    words = cores.where("form = 'full' and instr(core, ' ') > 0").select("form", "core", F.explode(F.array_distinct(F.split("core", " "))).alias("word"))
    hot = words.groupBy("word").agg(F.count("*").alias("c")).where(F.col("c") > HOT).select(F.col("word").alias("hot"))

    def keys(column: str):  # noqa: ANN202
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                got = [(w, v) for w in b.column(0).to_pylist() for v in _twice(w)]
                yield pa.RecordBatch.from_arrays([pa.array([g[i] for g in got], pa.string()) for i in (0, 1)], names=[column, "v"])

        return run

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [(w, h, d) for w, h in zip(b.column("word").to_pylist(), b.column("hot").to_pylist()) if (d := edits(w, h, 2)) <= 2]
            yield pa.RecordBatch.from_arrays([pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.string()), pa.array([g[2] for g in got], pa.int32())], names=["word", "hot", "d"])

    hot = cut(hot)
    if hot.limit(1).count() == 0:
        return cores.select("form", "core", F.lit(None).cast("array<struct<word: string, hot: string, d: int>>").alias("hot")).limit(0)
    near = words.select("word").distinct().mapInArrow(keys("word"), "word string, v string").join(hot.mapInArrow(keys("hot"), "hot string, v string"), "v").select("word", "hot").distinct().mapInArrow(measure, "word string, hot string, d int")
    return words.join(near, "word").groupBy("form", "core").agg(F.collect_list(F.struct("word", "hot", "d")).alias("hot"))


def link_names(names: DataFrame) -> DataFrame:
    """``name``, ``canonical``: the canonical core of every distinct name in ``names`` (name) that names a company."""
    counted = names.where(F.col("name").isNotNull()).groupBy("name").agg(F.count("*").alias("n"))
    read = cut(counted.mapInArrow(_read, "name string, form string, core string, n long"))
    cores = read.groupBy("form", "core").agg(F.count("*").alias("k"), F.sum("n").alias("n"))
    keyed = cut(cores.join(_hot_words(cores), ["form", "core"], "left").mapInArrow(_with_keys, "form string, core string, k long, n long, key string, canonical boolean, variant boolean"))
    canon = keyed.where("canonical").select("key", F.col("core").alias("to"), F.col("k").alias("to_k"), F.col("n").alias("to_n"))
    # a full form of as many words looks only at those that rank higher, so chains end; what it shortens or joins may rank lower
    size = lambda c: F.size(F.split(c, " "))
    higher = F.struct(F.col("to_k"), F.col("to_n")) > F.struct(F.col("k"), F.col("n"))
    better = (F.col("form") != "full") | (size("core") == 1) & ((size("to") > 1) | F.contains("to", F.lit("/")) & ~F.contains("core", F.lit("/"))) | higher | ((F.col("to_k") == F.col("k")) & (F.col("to_n") == F.col("n")) & (F.col("to") < F.col("core")))
    near = keyed.where("variant").join(canon, "key").where(better & ((F.col("form") != "full") | (F.col("core") != F.col("to")))).select("form", "core", "k", "to", "to_k").distinct()
    scored = cut(near.mapInArrow(_posterior, "form string, core string, to string, score double"))
    # a word that is a joined form itself is no canonical form of other words
    joined = scored.where((F.col("form") == "full") & (size("core") == 1) & (size("to") > 1)).select(F.col("core").alias("to")).distinct()
    # a likelier form is a smaller struct: highest posterior, then first by code point
    best = scored.join(joined, "to", "left_anti").groupBy("form", "core").agg(F.min(F.struct((-F.col("score")).alias("s"), "to")).alias("b"))
    to = cut(cores.join(best, ["form", "core"], "left").select("form", "core", F.coalesce("b.to", "core").alias("canonical")))
    discard(keyed)
    discard(scored)
    while True:  # each step doubles the reach; chains end, as every step leads to a higher rank or to more words
        pairs = to.where("form = 'full'").select(F.col("core").alias("canonical"), F.col("canonical").alias("next"))
        step = cut(to.join(pairs, "canonical", "left").select("form", "core", F.coalesce("next", "canonical").alias("canonical"), (F.col("next") != F.col("canonical")).alias("moved")))
        discard(to)
        to = step
        if step.where("moved").limit(1).count() == 0:
            break
    return read.join(to.select("form", "core", "canonical"), ["form", "core"]).select("name", "canonical")


def supplier_names(results: DataFrame, seeds: DataFrame) -> DataFrame:
    return results.select(F.col("extracted_entities.supplier").alias("name")).unionByName(seeds.select(F.col("supplier").alias("name")))


def linked_pairs(linked: DataFrame) -> DataFrame:
    """``name_a`` < ``name_b`` (by code point) for every two names of one company."""
    other = linked.select(F.col("name").alias("name_b"), "canonical")
    return linked.select(F.col("name").alias("name_a"), "canonical").join(other, "canonical").where(F.col("name_a") < F.col("name_b")).select("name_a", "name_b")
