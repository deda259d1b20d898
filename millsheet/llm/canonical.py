"""Free-entered values mapped to the closest entry of a reference list, with unmatched values reported.

Distinct values are cut into tokens. Each distinct token is repaired: an equi-join on shared deletion variants brings it
together with every vocabulary word of the reference list that may be within its edit distance, the distance decides.
The repaired tokens of a value then rank all entries that share a word or a code with it by soft TF-IDF (weight of the word
in the entry times similarity of token and word, over the lengths of both); the entries' codes (grade, number,
designation) are words as well, read through the usual misreadings of digits and the weightier the longer and the further
in front they stand. An exact check follows and takes the first entry of that ranking that passes it: the entry's code
must be the longest and first of the value, so that a grade the list lacks doesn't give a neighbouring grade, and a short
or bare code needs the entry's family beside it.

Cases: null and blank values have no row; a value that names no entry, or a name without a code, has ``NONE``; of entries
with equal score the one of lower identifier counts; rows repeated under one id count once; very long values are read
whole; extra columns are dropped. The reference list is held by the tasks, as its size is checked (``MAX_ENTRIES``).
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millsheet.session import cut

MAX_ENTRIES = 50_000
#: A value with more rows than this is looked up once, but its rows are spread over several parts.
HOT_ROWS = 200_000

#: Words that mean a family of materials: fixed values of common trade usage.
FAMILY_WORDS = {
    "stainless": "stainless inox inoxydable inoxidable edelstahl nirosta ss aisi rvs",
    "steel": "steel acier stahl acero acciaio staal carbon aco",
    "aluminium": "aluminium aluminum alu alum al aw aluminio alluminio",
    "copper": "copper cuivre kupfer cobre rame koper cu",
    "brass": "brass laiton messing laton ottone",
    "cast iron": "fonte gusseisen",
}
#: Words that say nothing about the material.
FILLER = frozenset("nuance grade type material matiere mat materiau werkstoff w nr wnr no n en din iso plate tube tole sheet bar pipe the de".split())
_TOKEN = re.compile(r"[^\W_]+")
_READ = str.maketrans("oils", "0115")


def fold(text: str) -> str:
    """Lower case without accents."""
    s = unicodedata.normalize("NFKD", unicodedata.normalize("NFKC", text).lower())
    return "".join(c for c in s if not unicodedata.combining(c))


def spans(value: str) -> list[tuple[str, bool]]:
    """The tokens of a value, and whether a point shortens them; ``S.S.`` is one token."""
    s = re.sub(r"(?<![^\W_])([a-z])\.(?=[a-z](?![^\W_]))", r"\1", fold(value))
    return [(m[0], s[m.end() : m.end() + 1] == ".") for m in _TOKEN.finditer(s)]


def code_key(text: str) -> str:
    """A code without separators, its letters o, i, l and s read as digits."""
    return re.sub(r"[^0-9a-z]", "", fold(text)).translate(_READ)


def allowed(length: int) -> int:
    """Edits that a token of this length may have."""
    return 0 if length < 4 else 1 if length < 6 else 2


def deletions(word: str, n: int) -> set[str]:
    """``word`` and what is left of it without up to ``n`` letters."""
    out = layer = {word}
    for _ in range(n):
        layer = {w[:i] + w[i + 1 :] for w in layer for i in range(len(w))}
        out = out | layer
    return out


def edits(a: str, b: str, most: int) -> int:
    """Edits between two words, exchanges of neighbours counting one; ``most + 1`` if there are more."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    if a == b:
        return 0
    far = most + 1
    before: list[int] = []
    row = [j if j <= most else far for j in range(len(b) + 1)]
    for i, x in enumerate(a, 1):
        new = [far] * (len(b) + 1)
        low = new[0] = i if i <= most else far
        # further from the diagonal there are too many edits
        for j in range(max(1, i - most), min(len(b), i + most) + 1):
            y = b[j - 1]
            d = min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before[j - 2] + 1)
            new[j] = d
            low = min(low, d)
        if low > most:
            return far
        before, row = row, new
    return min(row[-1], far)


class Reference:
    """The reference list as the tasks hold it: words and codes of the entries with their weights."""

    def __init__(self, entries: list[tuple[str, str, str, list[str]]]) -> None:
        """``entries``: (identifier, name, family, codes, the first being part of the name)."""
        self.words: dict[str, dict[str, float]] = {}
        self.codes: dict[str, list[str]] = {}
        of: dict[str, set[str]] = {}
        for ref, name, family, codes in entries:
            plain = fold(name)
            if codes and plain.endswith(fold(codes[0])):
                plain = plain[: len(plain) - len(fold(codes[0]))]
            own = [w for w in re.findall(r"[a-z]+", plain) if len(w) > 1]
            own += ["".join(own)] if len(own) > 1 else []
            own += FAMILY_WORDS.get(family.lower(), "").split() + ([family.lower()] if " " not in family else [])
            own += [w for f, ws in FAMILY_WORDS.items() if f in own for w in ws.split()]
            for w in own:
                of.setdefault(w, set()).add(ref)
            for c in codes:
                if k := code_key(c):
                    self.codes.setdefault(k, []).append(ref)
        n = max(1, len(entries))
        for w, refs in of.items():
            for r in refs:
                self.words.setdefault(w, {})[r] = math.log(1 + n / len(refs))
        self.code_weight = math.log(1 + n)
        self.norm: dict[str, float] = {}  # shrinks the many spellings of a family to one word's length
        for r, *_ in entries:
            own = [ws[r] for ws in self.words.values() if r in ws]
            self.norm[r] = max(own) / math.sqrt(sum(x * x for x in own)) if own else 1.0
        self.longest = max([1, *map(len, self.codes)])
        self.beginnings = {k[:i] for k in self.codes for i in range(1, len(k) + 1)}

    def rank(self, value: str, repairs: dict[str, list[tuple[str, float]]]) -> tuple[str, float, str]:
        """(identifier or NONE, score) of the entry that ``value`` names, and the identifier that is ranked first."""
        found = spans(value)
        toks = [t for t, _ in found]
        scores: dict[str, float] = {}
        length = 0.0
        wordlike: list[bool] = []
        extra: list[tuple[int, str]] = []  # (position, code) of what is glued to a word
        for i, t in enumerate(toks):
            known = []
            if code_key(t) not in self.codes:
                for cut in range(len(t) - 1, 2, -1):
                    if t[:cut] in self.words and code_key(t[cut:]) in self.beginnings:
                        known = [(t[:cut], 1.0)]
                        extra.append((i, t[cut:]))
                        break
            known = known or [(w, s) for w, s in [*repairs.get(t, ()), *(repairs.get(t + ".", ()) if found[i][1] else ())] if w in self.words]
            best: dict[str, float] = {}
            for w, s in known:
                for ref, weight in self.words[w].items():
                    best[ref] = max(best.get(ref, 0.0), weight * s)
            for ref, x in best.items():
                scores[ref] = scores.get(ref, 0.0) + x
            length += max(best.values(), default=0.0 if t in FILLER else 1.0) ** 2
            wordlike.append(bool(known) or not re.search(r"\d", t))
        bare = all(t in FILLER for t, w in zip(toks, wordlike) if w)
        glued = dict(extra)
        first = next((i for i, (t, w) in enumerate(zip(toks, wordlike)) if not w or re.search(r"\d", glued.get(i, ""))), len(toks))
        hits: list[tuple[int, int, str, bool]] = []
        for start in range(min(first + 1, len(toks))):
            gram, parts = "", 0
            for i in range(start, len(toks)):
                gram += glued.get(i, "") if i == start and i in glued else toks[i]
                parts += 1
                if len(gram) > self.longest:
                    break
                k = code_key(gram)
                # what of the code's tokens isn't the whole of the value needs the family beside it
                for ref in self.codes.get(k, ()):
                    strong = len(k) > 3 and (not k.isdigit() or parts > 1) and (re.search(r"\d", gram) is not None)
                    if strong or ref in scores or bare and len(k) > 2:
                        hits.append((-len(k), start, ref, strong))
        # all entries that share a word or a code, by soft TF-IDF
        code: dict[str, float] = {}
        for size, start, ref, strong in hits:
            x = self.code_weight * (1.0 if strong else 0.8) * (1 - size / (1 + self.longest)) / (1 + 0.1 * start)
            code[ref] = max(code.get(ref, 0.0), x)
        ranking = sorted((-(scores.get(ref, 0.0) * self.norm.get(ref, 1.0) + code.get(ref, 0.0)) / math.sqrt(length + self.code_weight**2), ref) for ref in {*scores, *code})
        if not hits:
            return "NONE", 0.0, ranking[0][1] if ranking else "NONE"
        # the check: the longest code, at its first place
        best = min(hits)[:2]
        named = {ref for size, start, ref, _ in hits if (size, start) == best}
        score, ref = next(x for x in ranking if x[1] in named)
        return ref, -score, ranking[0][1]


def _reference(reference: DataFrame) -> Reference:
    rows = reference.select("ref_id", "canonical", "family", "grade", "en_number", "designation").dropDuplicates(["ref_id"]).limit(MAX_ENTRIES + 1).collect()
    if len(rows) > MAX_ENTRIES:
        raise ValueError(f"the reference list has more than {MAX_ENTRIES} entries")
    return Reference([(r[0], r[1] or "", r[2] or "", [c for c in r[3:] if c]) for r in sorted(rows) if r[0]])


def _variants(column: str):  # noqa: ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pairs = [(w, v) for w in b.column(0).to_pylist() for v in ([w] if w[-1:] == "." else deletions(w, allowed(len(w))))]
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.string()) for k in (0, 1)], names=[column, "variant"])

    return run


def repair(tokens: DataFrame, vocabulary: list[str]) -> DataFrame:
    """``token``, ``word``, ``sim`` for every vocabulary word within a distinct token's edit distance, or that it shortens."""
    spark = tokens.sparkSession
    words = sorted((w, v) for w in set(vocabulary) for v in deletions(w, allowed(len(w))) | {w[:i] + "." for i in range(2, len(w))})
    vocab = spark.createDataFrame(words or [("", "")], "word string, variant string")
    near = tokens.mapInArrow(_variants("token"), "token string, variant string").join(vocab, "variant").select("token", "word").distinct()

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for t, w in zip(b.column("token").to_pylist(), b.column("word").to_pylist()):
                if t[-1:] == ".":
                    out.append((t, w, 0.9))
                    continue
                most = allowed(min(len(t), len(w)))
                if (d := edits(t, w, most)) <= most:
                    out.append((t, w, 1 - d / max(len(t), len(w))))
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.string()), pa.array([o[2] for o in out], pa.float64())], names=["token", "word", "sim"])

    return near.mapInArrow(measure, "token string, word string, sim double")


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        pairs = [(v, t) for v in b.column("value").to_pylist() for t in dict.fromkeys(x for t, short in spans(v) for x in ([t, t + "."] if short else [t])) if len(t) > 1 and re.search("[a-z]", t)]
        yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.string()) for k in (0, 1)], names=["value", "token"])


def match_values(values: DataFrame, reference: DataFrame) -> DataFrame:
    """``value``, ``ref_id`` (or NONE), ``score`` and ``ranked_first`` (before the check) of every distinct non-blank value."""
    ref = _reference(reference)
    distinct = values.where("value is not null and trim(value) <> ''").select("value").distinct()
    typed = distinct.mapInArrow(_tokens, "value string, token string")
    repaired = repair(typed.select("token").distinct(), list(ref.words))
    by_value = typed.join(repaired, "token").groupBy("value").agg(F.collect_list(F.struct("token", "word", "sim")).alias("repairs"))

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for v, rs in zip(b.column("value").to_pylist(), b.column("repairs").to_pylist()):
                known: dict[str, list[tuple[str, float]]] = {}
                for r in rs or ():
                    known.setdefault(r["token"], []).append((r["word"], r["sim"]))
                out.append((v, *ref.rank(v, known)))
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.string()), pa.array([o[2] for o in out], pa.float64()), pa.array([o[3] for o in out], pa.string())], names=["value", "ref_id", "score", "ranked_first"])

    return distinct.join(by_value, "value", "left").mapInArrow(rank, "value string, ref_id string, score double, ranked_first string")


def map_rows(rows: DataFrame, reference: DataFrame) -> DataFrame:
    """``source_table``, ``row_id``, ``ref_id``, ``score``, ``ranked_first`` of the rows (source_table, row_id, value) with a value."""
    some = rows.where("value is not null and trim(value) <> ''").select("source_table", "row_id", "value")
    # only values with very many rows are spread; there are few of them
    hot = cut(some.groupBy("value").agg(F.count("*").alias("n")).where(F.col("n") > HOT_ROWS).select("value", F.ceil(F.col("n") / HOT_ROWS).alias("parts")))
    found = match_values(some, reference).join(hot, "value", "left").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce(F.col("parts") - 1, F.lit(0).cast("bigint"))))).drop("parts")
    salted = some.join(hot, "value", "left").withColumn("salt", F.coalesce(F.pmod(F.xxhash64("source_table", "row_id"), F.col("parts")), F.lit(0).cast("bigint"))).drop("parts")
    got = [F.first(c).alias(c) for c in ("ref_id", "score", "ranked_first")]
    return salted.join(found, ["value", "salt"]).groupBy("value", "salt", "source_table", "row_id").agg(*got).select("source_table", "row_id", "ref_id", "score", "ranked_first")


def material_rows(entities: DataFrame, results: DataFrame) -> DataFrame:
    """The material values of the two tables as ``map_rows`` takes them."""
    e = entities.where(F.lower(F.trim("field")) == "material").select(F.lit("extracted_entity").alias("source_table"), F.col("entity_id").alias("row_id"), "value")
    return e.unionByName(results.select(F.lit("extraction_result").alias("source_table"), F.col("result_id").alias("row_id"), F.col("extracted_entities.material").alias("value")))
