"""All candidates of documents from whole Arrow batches: what ``extract.candidates`` finds, in its order, for corpora of many short texts.

Array expressions on each text cost most of their time in evaluating lambdas. Here each rule looks through the texts of a
batch at once (``pyarrow.compute``, linear in the text), and Python touches only texts that hold several matches of a rule. That holds for plain texts
(printable ASCII, tabs and line ends), on which all kinds of regular expressions agree; every other text goes through
the array expressions of ``extract``, in the same scan. Nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millsheet.functions import rules
from millsheet.operators import extract as X

_FOUND = "position int, field string, value string, confidence double, source string, raw_text string"
_BLANKS = " \t\r\n"
_NOT_PLAIN = r"[^\t\n\r -~]"


def _any_of(words: list[str]) -> str:
    return "|".join(map(re.escape, dict.fromkeys(words)))


def _held(texts: pa.Array, words: list[str]) -> list[int]:
    """The places of the words that a batch of texts holds (or seems to, where one text follows another): most batches lack most words."""
    letters = (texts.buffers()[2] or pa.py_buffer(b"")).to_pybytes()
    return [k for k, w in enumerate(words) if w.encode() in letters]


class _Matches:
    """Every match of a pattern, in order: ``at`` (place of its text), ``raw``, its groups ``g``, and ``start`` in the text if that is asked for."""

    def __init__(self, texts: pa.Array, pattern: str, flags: re.RegexFlag, starts: bool = False) -> None:
        sought = {"pattern": pattern, "ignore_case": bool(flags & re.I)}
        at = np.flatnonzero(pc.match_substring_regex(texts, **sought))
        hit = texts.take(pa.array(at))
        n = pc.count_substring_regex(hit, **sought).to_numpy()
        start = pc.find_substring_regex(hit, **sought).to_numpy() if starts else np.zeros(len(at), dtype=np.int64)
        names = ["raw", *(f"g{i + 1}" for i in range(re.compile(pattern).groups))]
        group = iter(names[1:])
        named = re.sub(r"(?<!\\)\((?!\?)", lambda _: f"(?P<{next(group)}>", pattern)
        once = pa.array(np.flatnonzero(n == 1))
        found = pc.extract_regex(hit.take(once), pattern=f"{'(?i)' if flags & re.I else ''}(?P<raw>{named})")
        self.at, self.start, columns = at[once], start[once], [pc.struct_field(found, k) for k in names]
        if len(several := np.flatnonzero(n != 1)):
            p = re.compile(pattern, flags | re.A)
            more = [(i, m) for i, text in zip(at[several].tolist(), hit.take(pa.array(several)).to_pylist()) for m in p.finditer(text)]
            self.at = np.concatenate([self.at, np.array([i for i, _ in more], dtype=np.int64)])
            self.start = np.concatenate([self.start, np.array([m.start() for _, m in more], dtype=np.int64)])
            order = np.argsort(self.at, kind="stable")
            self.at, self.start = self.at[order], self.start[order]
            columns = [pa.concat_arrays([c, pa.array([m[k] for _, m in more], pa.string())]).take(pa.array(order)) for k, c in enumerate(columns)]
        self.raw, *self.g = columns

    def __len__(self) -> int:
        return len(self.at)

    def context(self, texts: pa.Array, reach: int) -> pa.Array:
        """Each match after the ``reach`` letters before it, in lower case."""
        _, offsets, letters = texts.buffers()
        of = np.frombuffer(offsets, dtype=np.int32)[texts.offset :][self.at].astype(np.int64)
        size = np.minimum(self.start, reach) + pc.binary_length(self.raw).to_numpy()
        ends = np.cumsum(size)
        held = np.frombuffer(letters, dtype=np.uint8)[np.repeat(of + np.maximum(self.start - reach, 0) - (ends - size), size) + np.arange(ends[-1])]
        return pc.ascii_lower(pa.StringArray.from_buffers(len(self), pa.py_buffer(np.concatenate([[0], ends]).astype(np.int32)), pa.py_buffer(held)))


class _Candidates:
    """Candidates of a batch as columns, rule after rule in candidate order."""

    def __init__(self) -> None:
        self.at, self.field, self.value, self.sure, self.source, self.raw = [], [], [], [], [], []

    def add(self, field: str, at: np.ndarray, value: pa.Array, sure: float | np.ndarray, source: str | pa.Array, raw: pa.Array) -> None:
        """``at``: the text of each, ascending; confidence and source may be one for all."""
        n = len(at)
        if n:
            self.at.append(at)
            self.field.append(np.full(n, rules.FIELDS.index(field)))
            self.value.append(value)
            self.sure.append(np.full(n, sure) if isinstance(sure, float) else sure)
            self.source.append(pa.repeat(source, n) if isinstance(source, str) else source)
            self.raw.append(raw)

    def table(self, doc: pa.Array) -> pa.RecordBatch | None:
        """The rows of all documents, those of each in candidate order."""
        if not self.at:
            return None
        at = np.concatenate(self.at)
        order = np.argsort(at, kind="stable")
        take = pa.array(order)
        column = lambda parts: pa.concat_arrays(parts).take(take)
        at, sure = at[order], np.concatenate(self.sure)[order]
        fields = pa.array(rules.FIELDS).take(pa.array(np.concatenate(self.field)[order]))
        position = np.arange(len(at)) - np.searchsorted(at, at)
        return pa.RecordBatch.from_arrays([doc.take(pa.array(at)), pa.array(position, pa.int32()), fields, column(self.value), pa.array(sure, pa.float64()), column(self.source), pc.utf8_slice_codeunits(column(self.raw), 0, 100)], names=["doc", "position", "field", "value", "confidence", "source", "raw_text"])


def _collapsed(values: pa.Array) -> pa.Array:
    return pc.replace_substring_regex(values, r"[ \t\r\n]+", " ")


def _picked(words: list[str], at: np.ndarray) -> pa.Array:
    return pa.array(words, pa.string()).take(pa.array(at))


def _project_ids(out: _Candidates, texts: pa.Array) -> None:
    for pattern, sure, source in rules.PROJECT_ID:
        m = _Matches(texts, pattern, re.I)
        value = pc.ascii_upper(m.g[0] if m.g else m.raw)
        size = pc.binary_length(value).to_numpy()
        fit = np.flatnonzero((size <= 15) & ~((size == 4) & pc.match_substring_regex(value, r"^\d{4}$").to_numpy(zero_copy_only=False)))
        out.add("project_id", m.at[fit], value.take(pa.array(fit)), sure, source, m.raw.take(pa.array(fit)))


class _Lines:
    """The lines of a batch: ``text`` has the place of the text of each."""

    def __init__(self, texts: pa.Array) -> None:
        self.lists = pc.split_pattern(texts, "\n")
        self.flat, self.text = self.lists.flatten(), pc.list_parent_indices(self.lists).to_numpy()
        self.low = pc.ascii_lower(self.flat)

    def triggers(self, lines: np.ndarray, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(line, trigger) of each trigger that some of the lines hold."""
        low = self.low.take(pa.array(lines))
        some = np.flatnonzero(pc.match_substring_regex(low, _any_of(words)))
        lines, low = lines[some], low.take(pa.array(some))
        held = _held(low, words)
        hits = [np.flatnonzero(pc.match_substring(low, words[k])) for k in held]
        line, k = lines[np.concatenate([np.zeros(0, dtype=np.int64), *hits])], np.repeat(np.array(held, dtype=np.int64), [len(h) for h in hits])
        order = np.lexsort((k, line))
        return line[order], k[order]


def _supplier_triggers(out: _Candidates, lines: _Lines) -> None:
    n = len(lines.flat)
    named = np.flatnonzero(pc.match_substring_regex(lines.flat, _any_of(rules.CORPORATE_SUFFIXES)))
    stripped = pc.utf8_trim(lines.flat.take(pa.array(named)), _BLANKS)
    long = np.flatnonzero(pc.greater_equal(pc.binary_length(stripped), 3))
    named, stripped = named[long], stripped.take(pa.array(long))
    # the place among the named lines, of those that are
    place = np.full(n + 2, -1)
    place[named] = np.arange(len(named))
    near = np.unique(np.concatenate([named, named - 1, named - 2]))
    near = near[near >= 0]
    line, k = lines.triggers(near, rules.SUPPLIER_TRIGGERS)
    # three lines for each line with a trigger, as far as they are of the same text
    below = (line[:, None] + np.arange(3)).ravel()
    k, line = np.repeat(k, 3), np.repeat(line, 3)
    same = (place[below] >= 0) & (lines.text[np.minimum(below, n - 1)] == lines.text[line])
    below, k, line = below[same], k[same], line[same]
    raw = stripped.take(pa.array(place[below]))
    other = np.flatnonzero(pc.not_equal(pc.ascii_lower(raw), _picked(rules.SUPPLIER_TRIGGERS, k)))
    raw = raw.take(pa.array(other))
    out.add("supplier", lines.text[line[other]], _collapsed(raw), 0.8, _picked(["trigger_" + w for w in rules.SUPPLIER_TRIGGERS], k[other]), raw)


def _letterheads(out: _Candidates, lines: _Lines) -> None:
    sizes = pc.list_value_length(lines.lists).to_numpy()
    heads = pc.binary_join(pc.list_slice(lines.lists, 0, 5), " ")
    if len(long := np.flatnonzero(sizes >= 30)):
        mine = heads.to_pylist()
        for i in long.tolist():
            mine[i] = " ".join(lines.lists[i].as_py()[: sizes[i] // 5])
        heads = pa.array(mine, pa.string())
    for suffix in (rules.CORPORATE_SUFFIXES[k] for k in _held(heads, rules.CORPORATE_SUFFIXES)):
        held = np.flatnonzero(pc.match_substring(heads, suffix))
        if len(held):
            m = _Matches(heads.take(pa.array(held)), rf"\b([A-Z][A-Za-z\s,.&-]+{re.escape(suffix)}\.?)\b", re.NOFLAG)
            value = _collapsed(m.raw)
            ours = np.flatnonzero(pc.invert(pc.match_substring_regex(value, _any_of(rules.NOT_A_SUPPLIER), ignore_case=True)))
            out.add("supplier", held[m.at[ours]], value.take(pa.array(ours)), 0.6, "letterhead", m.raw.take(pa.array(ours)))


def _material_patterns(out: _Candidates, texts: pa.Array) -> None:
    for pattern, sure, source in rules.MATERIAL:
        m = _Matches(texts, pattern, re.I)
        out.add("material", m.at, _collapsed(m.raw), sure, source, m.raw)


def _material_triggers(out: _Candidates, lines: _Lines) -> None:
    line, k = lines.triggers(np.flatnonzero(pc.match_substring_regex(lines.flat, "[:=-]")), rules.MATERIAL_TRIGGERS)
    raw = lines.flat.take(pa.array(line))
    # all after the first mark, and of that all before the first comma or semicolon
    after = pc.utf8_trim(pc.replace_substring_regex(raw, "^[^:=-]*[:=-]", ""), _BLANKS)
    value = pc.utf8_trim(pc.replace_substring_regex(after, r"(?s)[,;].*", ""), _BLANKS)
    size = pc.binary_length(value).to_numpy()
    fit = np.flatnonzero((size > 2) & (size < 100))
    sources = _picked(["trigger_" + w for w in rules.MATERIAL_TRIGGERS], k[fit])
    out.add("material", lines.text[line[fit]], value.take(pa.array(fit)), 0.7, sources, raw.take(pa.array(fit)))


def _quantities(out: _Candidates, texts: pa.Array) -> None:
    m = _Matches(texts, rules.QUANTITY, re.I, starts=True)
    if not len(m):
        return
    before, words = m.context(texts, 50), rules.QUANTITY_TRIGGERS
    k = np.full(len(m), len(words))
    for i in reversed(_held(before, words)):
        k[np.flatnonzero(pc.match_substring(before, words[i]))] = i
    value = pc.binary_join_element_wise(pc.replace_substring(m.g[0], ",", "."), pc.ascii_lower(m.g[1]), " ")
    out.add("quantity", m.at, value, np.where(k < len(words), 0.85, 0.7), _picked([*("trigger_" + w for w in words), "pattern"], k), m.raw)


def _padded(numbers: np.ndarray, size: int = 2) -> pa.Array:
    return pc.utf8_lpad(pa.array(numbers).cast(pa.string()), size, "0")


def _dates(out: _Candidates, texts: pa.Array) -> None:
    numbers = np.array(list(rules.MONTHS.values()))
    for pattern, base, source in rules.DATE:
        m = _Matches(texts, pattern, re.I, starts=True)
        if not len(m):
            continue
        # the bonus of a match near a trigger stays for the later matches of its text
        near = pc.match_substring_regex(m.context(texts, 30), "date|effective|shipped").to_numpy(zero_copy_only=False).astype(np.int64)
        first, sum_ = np.searchsorted(m.at, m.at), np.cumsum(near)
        near, ladder = sum_ - sum_[first] + near[first], np.array(X._LADDER[base])
        day, month, year = {"iso": (2, 1, 0), "iso_dot": (2, 1, 0), "en_textual": (1, 0, 2)}.get(source, (0, 1, 2))
        whole = lambda g: g.cast(pa.int64()).to_numpy()
        if source in ("en_textual", "fr_textual"):
            name = pc.utf8_slice_codeunits(pc.ascii_lower(m.g[month]), 0, 3 if source == "en_textual" else 4)
            known = pc.fill_null(pc.index_in(name, pa.array(list(rules.MONTHS))), -1).to_numpy()
            months = np.where(known < 0, 1, numbers[known])
        else:
            months = whole(m.g[month])
        y = whole(m.g[year])
        y = y + np.where(y < 50, 2000, np.where(y < 100, 1900, 0))
        value = pc.binary_join_element_wise(_padded(whole(m.g[day])), _padded(months), _padded(y, 4), "/")
        out.add("date", m.at, value, ladder[np.minimum(near, len(ladder) - 1)], source, m.raw)


def _of_plain(doc: pa.Array, texts: pa.Array) -> pa.RecordBatch | None:
    out, lines = _Candidates(), _Lines(texts)
    _project_ids(out, texts)
    _supplier_triggers(out, lines)
    _letterheads(out, lines)
    _material_patterns(out, texts)
    _material_triggers(out, lines)
    _quantities(out, texts)
    _dates(out, texts)
    return out.table(doc)


def _of_others(doc: pa.Array, found: pa.Array) -> pa.RecordBatch:
    """What the array expressions found, as rows."""
    at, c = pc.list_parent_indices(found), pc.list_flatten(found)
    position = np.arange(len(at)) - np.searchsorted(at.to_numpy(), at.to_numpy())
    names = ["field", "value", "confidence", "source", "raw_text"]
    return pa.RecordBatch.from_arrays([doc.take(at), pa.array(position, pa.int32()), *[pc.struct_field(c, n) for n in names]], names=["doc", "position", *names])


def _of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        doc, text, others = b.columns
        plain = pc.is_valid(text)
        if pc.any(plain).as_py() and (rows := _of_plain(doc.filter(plain), text.filter(plain))):
            yield rows
        if not pc.all(plain).as_py():
            hard = pc.invert(plain)
            yield _of_others(doc.filter(hard), others.filter(hard))


def candidates(documents: DataFrame) -> DataFrame:
    """doc, position, field, value, confidence (three decimals), source, raw_text (first 100 letters) of every candidate of ``documents`` (doc, text)."""
    texts = documents.select("doc", F.coalesce("text", F.lit("")).alias("text")).withColumn("plain", ~F.col("text").rlike(_NOT_PLAIN))
    given = texts.select("doc", F.when(F.col("plain"), F.col("text")).alias("text"), F.when(~F.col("plain"), F.expr(X.everything("text"))).alias("others"))
    return given.mapInArrow(_of_batches, f"doc {documents.schema['doc'].dataType.simpleString()}, {_FOUND}")
