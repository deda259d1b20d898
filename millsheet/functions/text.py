"""Scalar text functions as native column expressions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip(c: Column) -> Column:
    """Without surrounding Unicode blanks."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def collapse(c: Column) -> Column:
    """Every run of Unicode blanks is one space."""
    return F.regexp_replace(c, r"(?U)\s+", " ")


def quoted(s: str) -> str:
    """A string as an SQL literal."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def let_sql(value: str, name: str, body: str) -> str:
    """``body`` (SQL) of a value that is evaluated once, however often the body names it."""
    return f"transform(array({value}), {name} -> {body})[0]"


def strip_sql(x: str) -> str:
    return f"regexp_replace({x}, {quoted(r'(?U)^\s+|\s+$')}, '')"


def collapse_sql(x: str) -> str:
    return f"regexp_replace({x}, {quoted(r'(?U)\s+')}, ' ')"


def find_all(text: str, pattern: str, groups: int = 0) -> Column:
    """All matches in ``text`` (SQL) as array<struct<k, g0..gn, start>>; ``start`` counts code points.

    Offsets come from the pieces between the matches: the n-th match starts after n + 1 pieces and n matches. Their
    lengths are summed in blocks of the root of their number, so that n matches cost n to the power of 1.5 at most.
    """
    p = quoted(pattern)
    total = lambda a: f"aggregate({a}, 0, (s, x) -> s + x)"
    of = "".join(f", 'g{i}', regexp_extract_all({text}, {p}, {i})" for i in range(1, groups + 1))
    one = ", ".join(f"'g{i}', w.g{i}[k]" for i in range(1, groups + 1))
    start = f"sums[cast(k div b as int)] + {total('slice(steps, cast(k div b as int) * b + 1, k - cast(k div b as int) * b)')} + length(w.pieces[k])"
    rows = f"transform(w.g0, (g, k) -> named_struct('k', k, 'g0', g{', ' + one if one else ''}, 'start', {start}))"
    sums = let_sql(f"transform(sequence(0, cast((size(steps) - 1) div b as int)), i -> {total('slice(steps, i * b + 1, b)')})", "blocks", f"transform(blocks, (x, i) -> {total('slice(blocks, 1, i)')})")
    inner = let_sql("transform(w.g0, (g, k) -> length(w.pieces[k]) + length(g))", "steps", let_sql("cast(ceil(sqrt(size(steps))) as int)", "b", let_sql(sums, "sums", rows)))
    kind = "array<struct<k:int," + ",".join(f"g{k}:string" for k in range(groups + 1)) + ",start:int>>"
    return F.expr(let_sql(f"named_struct('g0', regexp_extract_all({text}, {p}, 0){of}, 'pieces', split({text}, {p}, -1))", "w", f"if(size(w.g0) > 0, {inner}, cast(array() as {kind}))"))


def _decompositions() -> tuple[str, str, dict[str, str]]:
    """Letters (of the basic plane) that decompose to one letter, what each becomes, and those that become several; by the Unicode tables of Python."""
    one, several = {}, {}
    for cp in (*range(0xA0, 0xAC00), *range(0xF900, 0x10000)):
        d = "".join(c for c in unicodedata.normalize("NFKD", chr(cp)) if not unicodedata.combining(c))
        if len(d) == 1 and d != chr(cp):
            one[chr(cp)] = d
        elif len(d) > 1 and len(d) < 5:
            several[chr(cp)] = d
    return "".join(one), "".join(one.values()), several


_FROM, _TO, _SEVERAL = _decompositions()
#: The same letters as a class of ranges.
_SEVERAL_CLASS = "[" + "".join(f"\\x{{{ord(x):x}}}{'' if chr(ord(x) - 1) in _SEVERAL else '-'}" if (chr(ord(x) - 1) in _SEVERAL) != (chr(ord(x) + 1) in _SEVERAL) else f"\\x{{{ord(x):x}}}" for x in sorted(_SEVERAL) if not (chr(ord(x) - 1) in _SEVERAL and chr(ord(x) + 1) in _SEVERAL)) + "]"


def _expanded(c: Column) -> Column:
    """Ligatures, fractions, unit signs and the like as the letters they stand for; texts without any (nearly all) cost one look."""
    letters = F.split(c, "")
    known = F.expr(f"map_from_arrays(split({quoted(''.join(_SEVERAL))}, ''), split({quoted(chr(1).join(_SEVERAL.values()))}, '\\u0001'))")
    wide = F.array_join(F.transform(letters, lambda x: F.coalesce(F.try_element_at(known, x), x)), "")
    return F.when(c.rlike(_SEVERAL_CLASS), wide).otherwise(c)


def eval_normalize(c: Column) -> Column:
    """Compatibility decomposition without accents, lower case, punctuation but ``/ . - +`` blank, blanks collapsed; null gives ''.

    Letters outside the basic plane and Hangul syllables stay as they are.
    """
    given = F.coalesce(c, F.lit(""))
    plain = F.when(~given.rlike(r"[^\x00-\x7f]"), given).otherwise(_expanded(F.regexp_replace(F.translate(given, _FROM, _TO), r"\p{M}", "")))
    return strip(collapse(F.regexp_replace(F.lower(plain), r"(?U)[^\w\s/.\-+]", " ")))


def id_of(normalized: Column) -> Column:
    return F.regexp_replace(normalized, "[^a-z0-9]", "")


def qty_of(normalized: Column) -> Column:
    return F.replace(F.replace(normalized, F.lit("kgs"), F.lit("kg")), F.lit("lbs"), F.lit("lb"))


def eval_normalize_id(c: Column) -> Column:
    return id_of(eval_normalize(c))


def eval_normalize_date(c: Column) -> Column:
    """ISO form of a day-first or ISO date; anything else stripped."""
    s = strip(F.coalesce(c, F.lit("")))
    p = r"^(\d{1,2})[/.\-](\d{1,2})[/.\-](\d{2,4})$"
    g = [F.regexp_extract(s, p, i) for i in (1, 2, 3)]
    y = F.when(F.length(g[2]) == 2, F.when(g[2].cast("int") >= 50, F.concat(F.lit("19"), g[2])).otherwise(F.concat(F.lit("20"), g[2]))).otherwise(g[2])
    iso = F.concat_ws("-", F.lpad(y, 4, "0"), F.lpad(g[1], 2, "0"), F.lpad(g[0], 2, "0"))
    return F.when(s.rlike(p), iso).otherwise(s)


def eval_normalize_qty(c: Column) -> Column:
    return qty_of(eval_normalize(c))


def date_text_sql(day: str, month: str, year: str) -> str:
    """``DD/MM/YYYY``; two-digit years below 50 are 20xx, others 19xx; days that don't exist are written all the same."""
    y = let_sql(year, "y", "if(y < 50, y + 2000, if(y < 100, y + 1900, y))")
    return f"concat_ws('/', lpad(cast({day} as string), 2, '0'), lpad(cast({month} as string), 2, '0'), lpad(cast({y} as string), 4, '0'))"


def preview(c: Column, size: int = 30) -> Column:
    return F.when(c.isNull(), F.lit("(none)")).when(F.length(c) > size, F.concat(F.substring(c, 1, size), F.lit("..."))).otherwise(c)


def one_decimal(c: Column) -> Column:
    """A number with one decimal, rounded by its exact binary value, ties to even."""
    # c * 20 is odd where c may lie on a tie; the exact error of the product (by splitting c) tells the side
    p = c * 20.0
    high = (c * 134217729.0) - ((c * 134217729.0) - c)
    error = (high * 20.0 - p) + (c - high) * 20.0
    tie = F.when(error > 0, (p + 1) / 2).when(error < 0, (p - 1) / 2).otherwise(2 * F.rint(p / 4))
    tenths = F.when(F.abs(p % 2) == 1, tie).otherwise(F.rint(c * 10.0)).cast("long")
    return F.concat(F.when((tenths < 0) & (tenths > -10), "-").otherwise(""), (tenths / 10).cast("long").cast("string"), F.lit("."), (F.abs(tenths) % 10).cast("string"))
