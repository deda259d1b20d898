"""Quantities recorded in different units, brought to one base unit per dimension.

Every source (a document, with what other people wrote about it) has a history of written numbers. Where one amount
was recorded again in another unit, the history of the logarithm jumps by the logarithm of a known factor. Each
history is cut by an exact penalised changepoint search (optimal partitioning with PELT pruning, squared error) into
segments of one level and one unit: a segment in which two different units are stated has infinite cost, so a stated
unit marks a change where the levels leave it open. All numbers of a segment are converted by the segment's unit: the
stated one, or, where none is stated, the one whose factor explains the segment's level shift against a neighbouring
segment. ``hidden_units`` measures how well the levels alone find units, on values whose stated unit is hidden from them.

Cases: a null or blank value, and one without a number, gives no amount; a number without stated or inferred unit has
``base_unit`` null; rows repeated under one id count once; a null source is a history of its own per row; extra
columns of the input are ignored; records without a position stand after those that have one. The history of a hot source
is cut into blocks of about ``BLOCK`` records, each of which may be worked on elsewhere.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator
from decimal import ROUND_HALF_UP, Decimal, InvalidOperation

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millsheet.session import cut

#: Records of one source's history that are segmented together.
BLOCK = 512
#: Cost of a changepoint, in squared log10 units. Known factors differ by at least log10(1.1); readings of one amount by less than log10(1.02).
PENALTY = 0.004
#: How far, in log10 units, a level shift may be from a known factor.
TOLERANCE = 0.02

#: base unit, factor, spellings (lower case, without a final point)
_UNITS = [
    ("g", "1000", "kg kgs kilo kilos kilogram kilograms kilogramme kilogrammes kilogramm"),
    ("g", "1", "g gr gram grams gramme grammes gramm"),
    ("g", "1000000", "t tonne tonnes ton tons tonnen to"),
    ("g", "1000000", "metric ton|metric tons|metric tonnes"),
    ("g", "0.001", "mg milligram milligrams milligramme milligrammes"),
    ("g", "453.59237", "lb lbs pound pounds livre livres"),
    ("mm", "1", "mm millimetre millimetres millimeter millimeters millimètre millimètres"),
    ("mm", "10", "cm centimetre centimetres centimeter centimeters centimètre centimètres"),
    ("mm", "1000", "m mtr mtrs ml metre metres meter meters mètre mètres"),
    ("mm", "1000000", "km kilometre kilometres kilometer kilometers kilomètre kilomètres"),
    ("mm", "25.4", "in inch inches pouce pouces zoll \" ″ ''"),
    ("mm", "304.8", "ft foot feet pied pieds fuß ' ′"),
    ("pcs", "1", "pc pcs piece pieces pièce pièces ea each unit units unité unités stk stück"),
    ("pcs", "12", "dozen dozens douzaine douzaines dz dutzend"),
]
UNITS: dict[str, tuple[str, Decimal]] = {}
for _base, _factor, _names in _UNITS:
    for _n in _names.split("|" if "|" in _names else " "):
        UNITS[_n] = (_base, Decimal(_factor))

_FACTORS = sorted(set(UNITS.values()))

#: Number words of 1 to 20, English then French.
WORDS = {
    w: i % 20 + 1
    for i, w in enumerate(
        "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty "
        "un deux trois quatre cinq six sept huit neuf dix onze douze treize quatorze quinze seize dix-sept dix-huit dix-neuf vingt".split()
    )
}

_UNIT_RE = "(?:" + "|".join(re.escape(u).replace("\\ ", r"\s+") for u in sorted(UNITS, key=len, reverse=True)) + r")\.?"
_GAP = r"\s'’.,"
_NUM = r"\d(?:[\d" + _GAP + r"]*\d)?(?:e[+-]?\d+)?"
_FIND_NUM = re.compile(_NUM, re.I)
_UNIT_TOKEN = re.compile(r"(?<![^\W\d_])" + _UNIT_RE + r"(?![^\W_])", re.I)
_AFTER = re.compile(r"\s*(" + _UNIT_RE + r")(?![^\W\d_])", re.I)
_FEET = re.compile(r"(\d[\d\s.,]*?)\s*(?:'|′|ft\.?|feet|foot|pieds?)\s*(\d+(?:[.,]\d+)?)\s*(?:\"|″|''|in\.?|inch(?:es)?|pouces?)(?![^\W\d_])", re.I)
_TIMES = re.compile(r"(\d+)\s*(?:[x×*]|lots?\s+(?:de|of|à|von)|(?:lots?|batches)\s*[x×]|lots?\s+)\s*(?=\d)", re.I)
_BRACKET = re.compile(r"\([^)]*\d[^)]*\)|\[[^\]]*\d[^\]]*\]")
_WORD = re.compile(r"(?<![\w-])(" + "|".join(sorted(WORDS, key=len, reverse=True)) + r")(?![\w-])", re.I)
_IN_CONTEXT = re.compile(r"[(\[]\s*(" + _UNIT_RE + r")\s*[)\]]|\ben\s+(" + _UNIT_RE + r")\s*[=:]|\bin\s+(" + _UNIT_RE + r")\s*[=:]", re.I)
_MISREAD = str.maketrans("OoQDlI|iSsBZz", "0000111155822")
_MISREAD_IN = re.compile(r"(?<=\d)[OoQDlI|iSsBZz]+(?=\d)")
_MISREAD_HEAD = re.compile(r"(?<![^\W_])[OolI|]+(?=\d)")
_MISREAD_TAIL = re.compile(r"(?<=\d)[OolI|]+(?=\s*$|\s+[^\W\d_]|" + _UNIT_RE + r"(?![^\W\d_]))")


def number(text: str) -> Decimal | None:
    """The number that ``text`` writes, by the separator rules.

    A comma or point followed by one or two last digits, after a lone 0 or before an exponent is decimal; others group digits.
    """
    mantissa, e, exponent = text.lower().partition("e")
    s = re.sub(r"[\s'’]", "", mantissa).strip(".,")
    last = max(s.rfind(","), s.rfind("."))
    if last >= 0:
        head, tail = s[:last], s[last + 1 :]
        if e or len(tail) <= 2 or head == "0":
            s = re.sub(r"[.,]", "", head) + "." + tail
        else:
            s = re.sub(r"[.,]", "", s)
    try:
        return Decimal(s + e + exponent)
    except InvalidOperation:
        return None


def _fold(text: str) -> str:
    s = unicodedata.normalize("NFKC", text).replace("’", "'")
    s = _MISREAD_IN.sub(lambda m: m[0].translate(_MISREAD), s)
    s = _MISREAD_HEAD.sub(lambda m: m[0].translate(_MISREAD), s)
    return _MISREAD_TAIL.sub(lambda m: m[0].translate(_MISREAD), s)


def _unit(token: str) -> tuple[str, Decimal] | None:
    return UNITS.get(re.sub(r"\s+", " ", token.lower().strip().rstrip(".")))


def stated_unit(context: str) -> tuple[str, Decimal] | None:
    """The unit that the text beside a bare number states."""
    s = unicodedata.normalize("NFKC", context)
    m = _IN_CONTEXT.search(s)
    if m:
        return _unit(next(g for g in m.groups() if g))
    found = [u for t in _UNIT_TOKEN.findall(s) if t not in ("'", '"') and (u := _unit(t))]
    return found[0] if len({f for f in found}) == 1 else None


def parse(value: str) -> tuple[Decimal, str | None, Decimal | None] | None:
    """(number, base unit, factor) as ``value`` states them, None without a number; the unit None if not stated."""
    s = _fold(value).strip()
    m = _FEET.search(s)
    if m:
        a, b = number(m[1]), number(m[2])
        if a is not None and b is not None:
            return a * Decimal("304.8") + b * Decimal("25.4"), "mm", Decimal(1)
    cleaned = _BRACKET.sub(" ", s)
    if re.search(r"\d", cleaned):
        s = cleaned
    elif not re.search(r"\d", s):
        w = _WORD.search(s)
        if not w:
            return None
        s = s[: w.start()] + str(WORDS[w[1].lower()]) + s[w.end() :]
    times = Decimal(1)
    t = _TIMES.search(s)
    if t:
        times = Decimal(t[1])
        s = s[: t.start()] + s[t.end() :]
    m = _FIND_NUM.search(s)
    if not m:
        return None
    n = number(m[0])
    if n is None:
        return None
    if s[max(0, m.start() - 1) : m.start()] in ("-", "−") and not s[: m.start() - 1].strip():
        n = -n
    n *= times
    after = _AFTER.match(s, m.end())
    u = _unit(after[1]) if after else None
    if u is None:
        rest = s[: m.start()] + " " + s[m.end() :]
        tokens = [x for tok in _UNIT_TOKEN.findall(rest) if tok not in ("'", '"') and (x := _unit(tok))]
        u = tokens[0] if tokens else None
        if u is None and re.search(r"[^\W\d_]|[°%]", re.sub(r"(?i)\b(total|env|approx|ca|circa|net|brut|nominal|no|n)\b", "", rest)):
            return n, "", None  # it states something that is no mass, length or count
    return (n, u[0], u[1]) if u else (n, None, None)


def changepoints(y: list[float], penalty: float = PENALTY, units: list | None = None) -> list[int]:
    """Starts of the segments that minimise squared error plus ``penalty`` per segment: exact, with PELT pruning.

    ``units`` (None where not stated) may not differ within a segment. A start whose segment holds two units stays
    without use however far the segment goes on, so it is dropped for good.
    """
    n = len(y)
    units = units or [None] * n
    if n < 2 or max(y) - min(y) < 1e-9 and len({u for u in units if u is not None}) < 2:
        return [0] * bool(n)
    s1, s2 = [0.0], [0.0]
    for v in y:
        s1.append(s1[-1] + v)
        s2.append(s2[-1] + v * v)
    best, back = [-penalty], [0]
    alive: list[tuple[int, object]] = [(0, None)]  # start, unit of the segment from it
    for t in range(1, n + 1):
        u = units[t - 1]
        if u is not None:
            alive = [(s, u) for s, own in alive if own is None or own == u]
        low, at, costs = math.inf, 0, []
        for s, _ in alive:
            d = s1[t] - s1[s]
            c = best[s] + s2[t] - s2[s] - d * d / (t - s)
            costs.append(c)
            if c < low:
                low, at = c, s
        low += penalty
        best.append(low)
        back.append(at)
        alive = [x for x, c in zip(alive, costs) if c <= low + 1e-12]
        alive.append((t, None))
    starts, t = [], n
    while t > 0:
        t = back[t]
        starts.append(t)
    return starts[::-1]


def resolve(history: list[tuple[Decimal, str | None, Decimal | None]]) -> list[tuple[int, str | None, Decimal | None]]:
    """Of each record of a history: its segment, and that segment's unit (base, factor), stated or inferred from its level shift."""
    y = [math.log10(abs(float(n))) if n else 0.0 for n, _, _ in history]
    stated = [None if u is None else (u, f) for _, u, f in history]
    starts = changepoints(y, PENALTY, stated)
    ends = [*starts[1:], len(y)]
    unit = [next((x for x in stated[a:b] if x is not None), None) for a, b in zip(starts, ends)]
    level = [sum(y[a:b]) / (b - a) for a, b in zip(starts, ends)]
    known = [j for j, x in enumerate(unit) if x and x[0]]
    out: list[tuple[int, str | None, Decimal | None]] = []
    for i, (a, b) in enumerate(zip(starts, ends)):
        got = unit[i]
        if got is None and known:
            # the segments with a unit, nearest first: the first against which a known factor explains the shift
            for j in sorted(known, key=lambda j: (abs(j - i), j)):
                base, factor = unit[j]
                want = math.log10(float(factor)) - (level[i] - level[j])
                miss, f = min((abs(math.log10(float(f)) - want), f) for u, f in _FACTORS if u == base)
                if miss <= TOLERANCE:
                    got = (base, f)
                    break
        out += [(i, *(got or (None, None)))] * (b - a)
    return out


SCHEMA = "source_table string, row_id long, number double, base_unit string, amount long, stated boolean, segment_no int"
_ARROW = pa.schema([("source_table", pa.string()), ("row_id", pa.int64()), ("number", pa.float64()), ("base_unit", pa.string()), ("amount", pa.int64()), ("stated", pa.bool_()), ("segment_no", pa.int32())])
HIDDEN = "source_table string, row_id long, base_unit string, amount long, found_unit string, found_amount long"
_HIDDEN = pa.schema([("source_table", pa.string()), ("row_id", pa.int64()), ("base_unit", pa.string()), ("amount", pa.int64()), ("found_unit", pa.string()), ("found_amount", pa.int64())])


def _amount(n: Decimal, f: Decimal | None) -> int | None:
    return int((n * f).quantize(Decimal(1), ROUND_HALF_UP)) if f is not None and abs(n * f) < 2**62 else None


def _histories(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """The histories of sorted rows: (table, id, (number, base, factor)) of every record with a number."""
    keep: list[tuple] = []
    key, seen = None, None
    for b in batches:
        for k, t, i, v, c in zip(*(b.column(n).to_pylist() for n in ("history", "source_table", "row_id", "value", "context"))):
            if (k, t, i) == seen:
                continue
            seen = (k, t, i)
            p = parse(v)
            if p is None:
                continue
            if p[1] is None and c and (u := stated_unit(c)):
                p = (p[0], *u)
            if k != key or len(keep) >= 4 * BLOCK:
                if keep:
                    yield keep
                keep, key = [], k
            keep.append((t, i, p))
    if keep:
        yield keep


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    out: list[tuple] = []
    for r in rows:
        out.append(r)
        if len(out) >= 8000:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), schema)], schema=schema)
            out.clear()
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), schema)], schema=schema)


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for h in _histories(batches):
            for (t, i, p), (segment, u, f) in zip(h, resolve([p for _, _, p in h])):
                yield t, i, float(p[0]), u or None, _amount(p[0], f), p[2] is not None, segment

    return _batches(rows(), _ARROW)


def _solve_hidden(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for h in _histories(batches):
            for fold in range(3):
                got = resolve([(p[0], None, None) if k % 3 == fold and p[2] is not None else p for k, (_, _, p) in enumerate(h)])
                for k in range(fold, len(h), 3):
                    t, i, (n, u, f) = h[k]
                    if f is not None:
                        yield t, i, u, _amount(n, f), got[k][1] or None, _amount(n, got[k][2])

    return _batches(rows(), _HIDDEN)


def _in_order(records: DataFrame) -> DataFrame:
    """The records by history, each in its order."""
    rows = records.where(F.col("value").isNotNull() & F.col("row_id").isNotNull()).select(
        F.coalesce("source", F.concat(F.lit("\u0002"), F.col("row_id").cast("string"))).alias("source"), F.floor(F.coalesce(F.col("position"), F.lit(0)) / BLOCK).alias("block"),
        "source_table", "row_id", F.col("position").cast("long").alias("position"), "value", "context",
    )
    # blocks whose positions repeat or are missing too often are cut further; there are few of them, and a written table is
    # joined by its real size: broadcast as long as it is small, so that the records are shuffled once
    hot = cut(rows.groupBy("source", "block").agg(F.count("*").alias("n")).where(F.col("n") > 4 * BLOCK).select("source", "block", F.ceil(F.col("n") / BLOCK).alias("parts")))
    part = F.coalesce(F.pmod(F.xxhash64("source_table", "row_id"), F.col("parts")), F.lit(0))
    return (
        rows.join(hot, ["source", "block"], "left")
        .select(F.concat_ws("\u0001", "source", F.col("block").cast("string"), part.cast("string")).alias("history"), "source_table", "row_id", "position", "value", "context")
        .repartition("history")
        .sortWithinPartitions("history", F.asc_nulls_last("position"), "source_table", "row_id")
        .drop("position")
    )


def normalise_quantities(records: DataFrame) -> DataFrame:
    """Amounts of ``records`` (source_table, row_id, source, position, value, context) in base units.

    One row per record that has a number; see the module for the cases. ``position`` orders a source's history.
    """
    return _in_order(records).mapInArrow(_solve, SCHEMA)


def hidden_units(records: DataFrame) -> DataFrame:
    """Of every record with a stated unit, that and what its history says when the unit is hidden (each third of a history in turn)."""
    return _in_order(records).mapInArrow(_solve_hidden, HIDDEN)


def document_key(c: F.Column) -> F.Column:
    """One spelling of a document's name: letter case, surrounding blanks and a ``.pdf`` ending don't matter."""
    return F.regexp_replace(F.lower(F.trim(c)), r"\s*\.pdf$", "")


def quantity_records(entities: DataFrame, results: DataFrame, seeds: DataFrame) -> DataFrame:
    """The quantity values of the three tables as ``normalise_quantities`` takes them."""
    e = entities.where(F.lower(F.trim("field")) == "quantity").select(
        F.lit("extracted_entity").alias("source_table"), F.col("entity_id").alias("row_id"), document_key(F.col("document_name")).alias("source"), F.col("ord").cast("long").alias("position"), "value", F.col("raw_text").alias("context")
    )
    note = F.array_join(F.filter(F.coalesce("notes", F.array().cast("array<string>")), lambda n: F.contains(F.lower(n), F.lit("quantit"))), " \n ")
    r = results.select(F.lit("extraction_result").alias("source_table"), F.col("result_id").alias("row_id"), document_key(F.col("document_name")).alias("source"), F.lit(None).cast("long").alias("position"), F.col("extracted_entities.quantity").alias("value"), note.alias("context"))
    s = seeds.select(F.lit("seed_record").alias("source_table"), F.col("seed_id").alias("row_id"), document_key(F.col("filename")).alias("source"), F.lit(None).cast("long").alias("position"), F.col("quantity").alias("value"), F.lit(None).cast("string").alias("context"))
    return e.unionByName(r).unionByName(s)
