"""Mixed timestamp formats and time zones, normalised to one calendar day or one UTC instant.

Every value gets all its valid interpretations (day or month first, two-digit years, compact forms, meanings of a zone
abbreviation) as an array with costs; a Viterbi pass over each source's record order chooses one per record. What a source
keeps from record to record is the order in which it writes dates with slashes: changing it costs ``SWITCH``, another format
than the record before ``FORMAT``, a jump back in time ``BACKWARD``, and a reading against the convention of the source's
site ``CONVENTION``, which is comparable with these, so that history may overrule it. The conventions that a task
fixes exactly can be checked afterwards (``by_convention``, ``conventional``); ``hidden_sites`` measures how often history
alone, without any site, finds the order that the site's convention demands.

The record order of a source is cut into windows of time of about ``WINDOW`` records, each read with some of the records before and
after it, so that the path through a window hardly ever depends on the cut.

Cases: null, blank and unreadable values, month-only values and days that don't exist have no row; a time that a zone
skipped moves forward by the gap, one that occurs twice is its first occurrence; an unknown ``site_tz`` counts as
UTC; rows repeated under one id count once; extra columns are ignored; records without a time stand first.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from datetime import UTC, date, datetime, timedelta, timezone, tzinfo
from functools import lru_cache
from zoneinfo import ZoneInfo

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millsheet.session import cut

#: Records of one source that one Viterbi pass covers, about and at most; the share of a window's length read on either side of it.
WINDOW, BLOCK, HALO = 2000, 16_000, 0.1
#: Costs of the pass: another order of day and month than before, another format, an earlier day, a reading against the site's convention.
SWITCH, FORMAT, BACKWARD, CONVENTION = 2.0, 0.1, 0.3, 1.5
#: Orders of numeric dates.
DAY_FIRST, MONTH_FIRST = 0, 1

#: One interpretation: (day or UTC instant, format, order of day and month or None, cost, whether it keeps the site's convention).
Reading = tuple[str, str, int | None, float, bool]

#: Month names of en, fr, de, es, it, pt, nl by their first letters (accents removed); the longest prefix decides.
_MONTHS = {
    "jan": 1, "gen": 1, "ene": 1, "feb": 2, "fev": 2, "mar": 3, "maa": 3, "mrt": 3, "mrz": 3, "apr": 4, "avr": 4, "abr": 4, "mai": 5, "may": 5, "mag": 5, "mei": 5,
    "jun": 6, "giu": 6, "juin": 6, "jul": 7, "juil": 7, "lug": 7, "aug": 8, "aou": 8, "ago": 8, "sep": 9, "set": 9, "oct": 10, "okt": 10, "ott": 10, "out": 10, "nov": 11, "dec": 12, "dez": 12, "dic": 12,
}
#: Offsets in minutes that a zone abbreviation may mean.
_ABBREVIATIONS = {
    "z": [0], "utc": [0], "gmt": [0], "wet": [0], "west": [60], "cet": [60], "mez": [60], "cest": [120], "mesz": [120], "eet": [120], "eest": [180], "msk": [180],
    "bst": [60, 360], "ist": [330, 60, 120], "jst": [540], "kst": [540], "sgt": [480], "hkt": [480], "est": [-300], "edt": [-240], "cst": [-360, 480], "cdt": [-300], "mst": [-420], "mdt": [-360], "pst": [-480], "pdt": [-420],
}
_WORD = r"[^\W\d_]+"
_DATES = [
    ("ymd", re.compile(r"(?<!\d)(?P<y>\d{4})(?P<sep>[-/.])(?P<m>\d{1,2})(?P=sep)(?P<d>\d{1,2})(?!\d)")),
    ("ymd", re.compile(r"(?<!\d)(?P<y>\d{4})年\s*(?P<m>\d{1,2})月\s*(?P<d>\d{1,2})日")),
    ("num", re.compile(r"(?<!\d)(?P<a>\d{1,2})(?P<sep>[-/.])(?P<b>\d{1,2})(?P=sep)(?P<y>\d{4}|\d{2})(?!\d)")),
    ("text", re.compile(rf"(?<!\d)(?P<d>\d{{1,2}})(?:er|st|nd|rd|th|\.|º|ª)?[\s-]*(?:de\s+|of\s+)?(?P<name>{_WORD})\.?[\s-]*(?:de\s+|del\s+)?,?\s*(?P<y>\d{{4}}|\d{{2}})(?![\d:])", re.I)),
    ("text", re.compile(rf"(?P<name>{_WORD})\.?\s+(?P<d>\d{{1,2}})(?:st|nd|rd|th)?,?\s+(?P<y>\d{{4}})(?!\d)", re.I)),
]
_TIME = re.compile(r"(?<!\d)(\d{1,2})(?:\s*[:.]\s*|\s?h\s?)(\d{2})(?:[:.](\d{2})(?:[.,]\d+)?)?(?!\d)\s*([ap])?(?(4)\.?m\b\.?)", re.I)
_OFFSET = re.compile(r"(?:utc|gmt)?\s*([+\-−])(\d{1,2})(?::?(\d{2}))?(?!\d)", re.I)
_AREA = re.compile(r"[A-Z][A-Za-z]+/[A-Za-z_/+-]+|\[UTC\]|\[GMT\]")
_LEFT = re.compile(r"(?<![^\W\d_])(?:le|à|a|at|um|uhr|t|the|on|am|den|el|la|las|il|alle|de|du|mon|tue|wed|thu|fri|sat|sun|monday|tuesday|wednesday|thursday|friday|saturday|sunday|lundi|mardi|mercredi|jeudi|vendredi|samedi|dimanche|montag|dienstag|mittwoch|donnerstag|freitag|samstag|sonntag)(?![^\W\d_])|[\s,.\[\]()|]+", re.I)
_COMPACT = re.compile(r"(\d{4})(\d{2})(\d{2})(?:T?(\d{2})(\d{2})(\d{2})?(?:[.,]\d+)?)?(.*)", re.S)


def month(name: str) -> int | None:
    """The month a name or its abbreviation means."""
    s = "".join(c for c in unicodedata.normalize("NFKD", name.lower()) if not unicodedata.combining(c))
    return _MONTHS.get(s[:4]) or _MONTHS.get(s[:3])


@lru_cache(maxsize=512)
def zone(name: str | None) -> tzinfo:
    try:
        return ZoneInfo(name) if name else UTC
    except (KeyError, ValueError, OSError):
        return UTC


def _day(y: str | int, m: int, d: int) -> date | None:
    y = int(y)
    try:
        return date(y + 2000 if y < 100 else y, m, d)
    except ValueError:
        return None


def _utc(local: datetime, tz: tzinfo) -> str:
    # fold=0: the first of two occurrences; in a gap the offset before it, which moves the time forward by the gap
    return local.replace(tzinfo=tz, fold=0).astimezone(UTC).strftime("%Y-%m-%dT%H:%M:%SZ").zfill(20)


def _zones(text: str, site: tzinfo, local: datetime) -> tuple[list[tuple[tzinfo, float]], str]:
    """The zones that ``text`` may state, with costs, and what is left of it."""
    m = _AREA.search(text)
    if m:
        name = m[0].strip("[]")
        return [(zone(name), 0.0)], text[: m.start()] + " " + text[m.end() :]
    m = _OFFSET.search(text)
    if m:
        minutes = int(m[2]) * 60 + int(m[3] or 0)
        if minutes > 16 * 60:
            return [], text
        return [(timezone(timedelta(minutes=minutes if m[1] == "+" else -minutes)), 0.0)], text[: m.start()] + " " + text[m.end() :]
    for m in re.finditer(_WORD, text):
        if m[0].lower() in _ABBREVIATIONS and (m[0].isupper() or m[0] == "z"):
            offsets = _ABBREVIATIONS[m[0].lower()]
            here = site.utcoffset(local.replace(tzinfo=None))
            costs = [0.0 if timedelta(minutes=o) == here else 0.5 + i for i, o in enumerate(offsets)] if len(offsets) > 1 else [0.0]
            return [(timezone(timedelta(minutes=o)), c) for o, c in zip(offsets, costs)], text[: m.start()] + " " + text[m.end() :]
    return [(site, 0.0)], text


def interpretations(value: str, site_tz: str | None) -> list[Reading]:
    """All valid readings of ``value``."""
    site = zone(site_tz)
    s = unicodedata.normalize("NFKC", value).strip()
    if re.fullmatch(r"\d{10,11}(?:[.,]\d+)?", s):
        return [(_utc(datetime(1970, 1, 1) + timedelta(seconds=int(re.split("[.,]", s)[0])), UTC), "epoch", None, 0.0, True)]
    if re.fullmatch(r"\d{12,13}(?:[.,]\d+)?", s):
        return [(_utc(datetime(1970, 1, 1) + timedelta(seconds=int(re.split("[.,]", s)[0]) // 1000), UTC), "epoch_ms", None, 0.0, True)]
    m = re.fullmatch(r"(\d{4})-?W(\d{1,2})-?([1-7])", s, re.I)
    if m:
        try:
            return [(date.fromisocalendar(int(m[1]), int(m[2]), int(m[3])).isoformat(), "week", None, 0.0, True)]
        except ValueError:
            return []
    m = re.fullmatch(r"(\d{4})-(\d{3})", s)
    if m:
        d = date(int(m[1]), 1, 1) + timedelta(days=int(m[2]) - 1) if int(m[1]) and 0 < int(m[2]) < 367 else None
        return [(d.isoformat(), "ordinal", None, 0.0, True)] if d and d.year == int(m[1]) else []
    days: list[tuple[date, str, int | None, bool]] = []
    time, rest = None, ""
    m = _COMPACT.fullmatch(s)
    if m:
        if m[4] or not m[7].strip():
            if d := _day(m[1], int(m[2]), int(m[3])):
                days.append((d, "compact", None, True))
            if not m[4] and (d := _day(s[4:8], int(s[2:4]), int(s[:2]))) and 1900 <= d.year < 2100:
                days.append((d, "compact_dmy", None, False))
            if m[4]:
                time, rest = (int(m[4]), int(m[5]), int(m[6] or 0)), m[7]
    if not days:
        for kind, pattern in _DATES:
            m = pattern.search(s)
            if not m:
                continue
            if kind == "ymd":
                found = [(_day(m["y"], int(m["m"]), int(m["d"])), "ymd", None, True)]
            elif kind == "text":
                found = [(_day(m["y"], k, int(m["d"])), "text", None, True)] if (k := month(m["name"])) else []
            else:
                us = m["sep"] == "/" and (site_tz or "").startswith("America/")
                a, b = int(m["a"]), int(m["b"])
                slash = m["sep"] == "/"  # only with slashes the order is a matter of the source
                found = [(_day(m["y"], b, a), "dmy", DAY_FIRST if slash else None, not us), (_day(m["y"], a, b), "mdy", MONTH_FIRST if slash else None, us)]
            days = [x for x in found if x[0]]
            if days or kind == "ymd":
                rest = s[: m.start()] + " " + s[m.end() :]
                break
        if not days:
            return []
        if t := _TIME.search(rest):
            h = int(t[1])
            if t[4]:
                if not 1 <= h <= 12:
                    return []
                h = h % 12 + 12 * (t[4].lower() == "p")
            time, rest = (h, int(t[2]), int(t[3] or 0)), rest[: t.start()] + " " + rest[t.end() :]
    out = []
    for d, kind, order, kept in days:
        cost = 0.0 if kept else CONVENTION
        if time is None:
            if not _LEFT.sub("", _AREA.sub("", rest)):
                out.append((d.isoformat(), kind, order, cost, kept))
            continue
        if time[0] > 24 or time[1] > 59 or time[2] > 60 or time[0] == 24 and time[1:] != (0, 0):
            continue
        local = datetime(d.year, d.month, d.day) + timedelta(hours=time[0], minutes=time[1], seconds=time[2])
        zones, left = _zones(rest, site, local)
        if not _LEFT.sub("", left):
            try:
                out += [(_utc(local, z), kind, order, cost + c, kept) for z, c in zones]
            except (OverflowError, ValueError):
                pass
    return out


def viterbi(records: list[list[Reading]]) -> list[int]:
    """The cheapest choice of one interpretation per record, over the order of the records.

    A state is an interpretation with the order of day and month that holds at its record: its own, or, where it has none,
    either.
    """
    costs: list[float] = []
    states: list[tuple[str, str, int, int]] = []  # day, format, order, interpretation
    before: list[list[int]] = []
    all_states: list[list[tuple[str, str, int, int]]] = []
    for options in records:
        new = [(when[:10], kind, o, j) for j, (when, kind, order, _, _) in enumerate(options) for o in ((DAY_FIRST, MONTH_FIRST) if order is None else (order,))]
        row, via = [], []
        for day, kind, o, j in new:
            best, at = 0.0, 0
            if states:
                best = float("inf")
                for k, (p, (d, f, q, _)) in enumerate(zip(costs, states)):
                    c = p + (SWITCH if q != o else 0.0) + (FORMAT if f != kind else 0.0) + (BACKWARD if day < d else 0.0)
                    if c < best:
                        best, at = c, k
            row.append(best + options[j][3])
            via.append(at)
        low = min(row)  # keeps the numbers small
        costs, states = [x - low for x in row], new
        before.append(via)
        all_states.append(new)
    if not records:
        return []
    at = min(range(len(costs)), key=costs.__getitem__)
    path = []
    for new, via in zip(reversed(all_states), reversed(before)):
        path.append(new[at][3])
        at = via[at]
    return path[::-1]


def conventional(options: list[Reading], chosen: int) -> int:
    """The chosen interpretation if it keeps the conventions, else the cheapest that does; the chosen one if none does."""
    if options[chosen][4]:
        return chosen
    return min((j for j, o in enumerate(options) if o[4]), key=lambda j: options[j][3], default=chosen)


SCHEMA = "source_table string, row_id long, utc string, format string, interpretations int, by_convention boolean, by_history string"
_ARROW = pa.schema([("source_table", pa.string()), ("row_id", pa.int64()), ("utc", pa.string()), ("format", pa.string()), ("interpretations", pa.int32()), ("by_convention", pa.bool_()), ("by_history", pa.string())])
HIDDEN = "source_table string, row_id long, day string, by_history string"
_HIDDEN = pa.schema([("source_table", pa.string()), ("row_id", pa.int64()), ("day", pa.string()), ("by_history", pa.string())])


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """The windows of sorted rows: (table, id, interpretations, whether the row is the window's own) of every readable value."""
    keep: list[tuple] = []
    key, seen = None, None
    for b in batches:
        for k, t, i, v, z, own in zip(*(b.column(n).to_pylist() for n in ("history", "source_table", "row_id", "value", "site_tz", "own"))):
            if (k, t, i) == seen:
                continue
            seen = (k, t, i)
            options = interpretations(v, z)
            if not options:
                continue
            if k != key or len(keep) >= BLOCK:
                if keep:
                    yield keep
                keep, key = [], k
            keep.append((t, i, options, own))
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
        for w in _windows(batches):
            for (t, i, options, own), j in zip(w, viterbi([o for _, _, o, _ in w])):
                if own:
                    c = conventional(options, j)
                    yield t, i, options[c][0], options[c][1], len(options), options[c][4], options[j][0]

    return _batches(rows(), _ARROW)


def _solve_hidden(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for w in _windows(batches):
            blind = [[(when, kind, order, cost if order is None else 0.0, kept) for when, kind, order, cost, kept in options] for _, _, options, _ in w]
            for (t, i, options, own), j in zip(w, viterbi(blind)):
                if own and {o[2] for o in options} == {DAY_FIRST, MONTH_FIRST} and len({o[0][:10] for o in options}) > 1:
                    yield t, i, next(o[0][:10] for o in options if o[4]), options[j][0][:10]

    return _batches(rows(), _HIDDEN)


def _in_order(records: DataFrame, window_rows: int) -> DataFrame:
    """The records by window, each in its order; those near an edge are in the neighbouring window as well."""
    rows = records.where(F.col("value").isNotNull() & F.col("row_id").isNotNull()).select("source_table", "row_id", "value", "site_tz", "recorded_at", F.concat_ws("\u0001", "source_table", F.coalesce("site_tz", F.lit(""))).alias("source"), F.unix_timestamp("recorded_at").alias("t"), F.coalesce(F.unix_timestamp("recorded_at"), F.lit(0)).alias("at"))
    # written tables are joined by their real size: broadcast as long as they are small, so that the records are shuffled once
    # one row per source: how long its windows are to hold so many rows
    spans = cut(rows.groupBy("source").agg(F.greatest(F.lit(1), F.coalesce(F.ceil((F.max("t") - F.min("t")) * window_rows / F.count("*")), F.lit(1))).alias("size")))
    rows = rows.join(spans, "source")
    window = lambda shift: F.floor((F.col("at") + shift * F.col("size")) / F.col("size"))
    rows = rows.withColumn("home", window(0)).withColumn("window", F.explode(F.array_distinct(F.array(window(0), window(-HALO), window(HALO)))))
    # windows that hold far more rows than they should, as where many have one time, are cut further; there are few of them
    hot = cut(rows.groupBy("source", "window").agg(F.count("*").alias("n")).where(F.col("n") > 4 * window_rows).select("source", "window", F.ceil(F.col("n") / window_rows).alias("parts")))
    part = F.coalesce(F.pmod(F.xxhash64("source_table", "row_id"), F.col("parts")), F.lit(0))
    return (
        rows.join(hot, ["source", "window"], "left")
        .select(F.concat_ws("\u0001", "source", F.col("window").cast("string"), part.cast("string")).alias("history"), "source_table", "row_id", "value", "site_tz", "recorded_at", (F.col("home") == F.col("window")).alias("own"))
        .repartition("history")
        .sortWithinPartitions("history", "recorded_at", "row_id")
        .drop("recorded_at")
    )


def normalise_timestamps(records: DataFrame, window_rows: int = WINDOW) -> DataFrame:
    """Day or UTC instant of every readable value of ``records`` (source_table, row_id, value, site_tz, recorded_at).

    A source is one table at one site. ``utc`` keeps the conventions where a reading does, ``by_history`` is the choice of the
    pass over the history before that check.
    """
    return _in_order(records, window_rows).mapInArrow(_solve, SCHEMA)


def hidden_sites(records: DataFrame, window_rows: int = WINDOW) -> DataFrame:
    """Of every value that is a day in either order: the day by the site's convention, and by the history when no site is known."""
    return _in_order(records, window_rows).mapInArrow(_solve_hidden, HIDDEN)


def date_records(results: DataFrame, seeds: DataFrame) -> DataFrame:
    """The date values of the two tables as ``normalise_timestamps`` takes them."""
    r = results.select(F.lit("extraction_result").alias("source_table"), F.col("result_id").alias("row_id"), F.col("extracted_entities.date").alias("value"), "site_tz", F.col("extracted_at").alias("recorded_at"))
    s = seeds.select(F.lit("seed_record").alias("source_table"), F.col("seed_id").alias("row_id"), F.col("date").alias("value"), "site_tz", F.col("created_at").alias("recorded_at"))
    return r.unionByName(s)
