"""Field extraction from document text: candidates by ordered rules and trigger words, and the best value of each field.

All candidates of a document come from one projection: every rule is an array expression on the text column, so the table
is scanned once and nothing is shuffled before the choice of the best value. The expressions are SQL text, which is
parsed in one go (built node by node they cost the driver seconds). Each rule passes over the text once, and once more
only where it needs the words before its matches; all work on the matches of a document is in proportion to their number.
A rule is looked for only where the words it can't do without stand. ASCII texts take patterns without Unicode tables, which
match the same there in a fraction of the time.
``ord`` (rule, line, trigger, position) carries the order of candidates, which decides between equal confidences.

The extractors take the text as SQL (a column's name or an expression) and give SQL of an array of candidates.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millsheet.functions import rules
from millsheet.functions.text import collapse_sql, date_text_sql, let_sql, quoted, strip_sql

_I, _ASCII_I = "(?iuU)", "(?i)"
_LINES = "'\n', -1"  # a single letter, which needs no pattern
CANDIDATE = "struct<ord: array<int>, value: string, confidence: double, source: string, raw_text: string>"
_NONE = f"cast(array() as array<{CANDIDATE}>)"


def _candidate(order: list[str], value: str, confidence: str, source: str, raw: str) -> str:
    places = ", ".join(f"cast({o} as int)" for o in order)
    return f"named_struct('ord', array({places}), 'value', {value}, 'confidence', cast({confidence} as double), 'source', {source}, 'raw_text', {raw})"


def _joined(parts: list[str]) -> str:
    return f"concat({', '.join([_NONE, *parts])})"


_NOTHING = "cast(array() as array<string>)"
#: Of each rule the class its matches begin with, and words of which every match in ASCII text holds one (in lower case).
_PROJECT_ID_HINTS = [("[nc]", ["certif"]), ("[ec]", ["exp", "cert"]), ("[pwjf]", []), ("[ws]", ["wps", "ss"]), ("[rn]", ["ref"])]
_MATERIAL_HINTS = [("a", ["aws"]), ("[s32]", []), ("1", ["1."]), ("a", []), ("6", ["6061-t6"]), ("[dmhi]", ["duplex", "monel", "hastelloy", "inconel", "hardox"]), ("[csgpi]", ["steel", "copper", "pvc", "inox"])]
_DATE_HINTS = [(r"\d", ["-"]), (r"\d", ["."]), (r"\d", ["."]), (r"\d", ["/"]), ("[jfmasond]", []), (r"\d", [])]


def _seen(text: str, body: str) -> str:
    """``body`` of ``seen``: whether the text is ASCII, and the text in lower case."""
    return let_sql(f"named_struct('ascii', octet_length({text}) = length({text}), 'low', lower({text}))", "seen", body)


def _matching(text: str, pattern: str, hint: tuple[str, list[str]], use: Callable[[str], str], nothing: str) -> str:
    """What ``use`` makes of a rule's pattern inside ``_seen``: its form for the text at hand, ``nothing`` where it can't match.

    A look at the next letter spares nearly all places of the text the pattern itself.
    """
    ascii_, unicode_ = (use(quoted(f"{flags}(?={hint[0]}){pattern}")) for flags in (_ASCII_I, _I))
    if hint[1]:
        ascii_ = f"if({' or '.join(f'contains(seen.low, {quoted(w)})' for w in hint[1])}, {ascii_}, {nothing})"
    return f"if(seen.ascii, {ascii_}, {unicode_})"


def _numbered(words: list[str]) -> str:
    """A vocabulary with the place of each word."""
    return "array(" + ", ".join(f"named_struct('k', {k}, 'w', {quoted(w)})" for k, w in enumerate(words)) + ")"


def _words(words: list[str]) -> str:
    return f"array({', '.join(map(quoted, words))})"


def project_ids(text: str) -> str:
    def of_rule(r: int, pattern: str, conf: float, source: str) -> str:
        # what a group holds is read from its own match; no match and no group begins or ends with a blank
        taken = f"regexp_extract(g, {quoted(_I + pattern)}, 1)" if r in (0, 4) else "g"
        each = _candidate([str(r), "k"], f"upper({taken})", str(conf), quoted(source), "g")
        return _matching(text, pattern, _PROJECT_ID_HINTS[r], lambda p: f"filter(transform(regexp_extract_all({text}, {p}, 0), (g, k) -> {each}), c -> length(c.value) <= 15 and not rlike(c.value, {quoted(r'^\d{4}$')}))", _NONE)

    return _seen(text, _joined([of_rule(r, *rule) for r, rule in enumerate(rules.PROJECT_ID)]))


def supplier_triggers(text: str) -> str:
    """Lines with a company's suffix that stand at most two lines below a trigger, once for every trigger."""
    # only the words that the text holds are looked for in its lines
    held = f"named_struct('suffixes', filter({_words(rules.CORPORATE_SUFFIXES)}, s -> contains({text}, s)), 'triggers', filter({_numbered(rules.SUPPLIER_TRIGGERS)}, t -> contains(seen.low, t.w)))"
    line = let_sql(f"if(exists(held.suffixes, s -> contains(l, s)), {strip_sql('l')}, null)", "c", "named_struct('l', l, 'j', j, 'c', c, 'ok', c is not null and length(c) >= 3)")
    rows = f"transform(filter(near, y -> lower(y.c) <> t.w), y -> {_candidate(['x.j', 't.k', 'y.j'], collapse_sql('y.c'), '0.8', "concat('trigger_', t.w)", 'y.c')})"
    of_triggers = let_sql("lower(x.l)", "low", f"flatten(transform(filter(held.triggers, t -> contains(low, t.w)), t -> {rows}))")
    of_line = let_sql("filter(slice(lines, x.j + 1, 3), y -> y.ok)", "near", f"if(size(near) = 0, {_NONE}, {of_triggers})")
    of_lines = let_sql(f"transform(split({text}, {_LINES}), (l, j) -> {line})", "lines", f"flatten(transform(lines, x -> {of_line}))")
    return _seen(text, let_sql(held, "held", f"if(size(held.suffixes) = 0 or size(held.triggers) = 0, {_NONE}, {of_lines})"))


def _plain_pattern(s: str) -> str:
    return "".join("\\" + c if c in ".+*?()[]{}|^$\\" else c for c in s)


def supplier_letterheads(text: str) -> str:
    known = let_sql("lower(c.value)", "low", " or ".join(f"contains(low, {quoted(w)})" for w in rules.NOT_A_SUPPLIER))

    def of_suffix(k: int, suffix: str) -> str:
        p = rf"(?=[A-Z])\b([A-Z][A-Za-z\s,.&-]+{_plain_pattern(suffix)}\.?)\b"
        found = f"if(ascii, regexp_extract_all(head, {quoted(p)}, 0), regexp_extract_all(head, {quoted('(?U)' + p)}, 0))"
        each = f"transform({found}, (g, k) -> {_candidate(['1000000000', str(k), 'k'], collapse_sql('g'), '0.6', quoted('letterhead'), 'g')})"
        # a suffix that the header lacks needs no search
        return f"if(contains(head, {quoted(suffix)}), filter({each}, c -> not {known}), {_NONE})"

    head = let_sql(f"split({text}, {_LINES})", "lines", "array_join(slice(lines, 1, greatest(5, cast(size(lines) div 5 as int))), ' ')")
    return let_sql(head, "head", let_sql("octet_length(head) = length(head)", "ascii", _joined([of_suffix(k, s) for k, s in enumerate(rules.CORPORATE_SUFFIXES)])))


def material_patterns(text: str) -> str:
    def of_rule(r: int, pattern: str, conf: float, source: str) -> str:
        # no match begins or ends with a blank
        each = _candidate([str(r), "k"], collapse_sql("g"), str(conf), quoted(source), "g")
        return _matching(text, pattern, _MATERIAL_HINTS[r], lambda p: f"transform(regexp_extract_all({text}, {p}, 0), (g, k) -> {each})", _NONE)

    return _seen(text, _joined([of_rule(r, *rule) for r, rule in enumerate(rules.MATERIAL)]))


def material_triggers(text: str) -> str:
    # all after the first mark, and of that all before the first comma or semicolon
    after = "substring(line, locate(':', translate(line, '=-', '::')) + 1)"
    value = strip_sql(f"substring_index(translate({strip_sql(after)}, ';', ','), ',', 1)")
    rows = f"transform(hits, t -> {_candidate(['100', 'i', 't.k'], 'value', '0.7', "concat('trigger_', t.w)", 'line')})"
    of_hits = f"if(size(hits) = 0, {_NONE}, {let_sql(value, 'value', f'if(length(value) > 2 and length(value) < 100, {rows}, {_NONE})')})"
    of_line = f"if(contains(line, ':') or contains(line, '=') or contains(line, '-'), {let_sql('lower(line)', 'low', let_sql('filter(held, t -> contains(low, t.w))', 'hits', of_hits))}, {_NONE})"
    # only the triggers that the text holds are looked for in its lines
    held = f"filter({_numbered(rules.MATERIAL_TRIGGERS)}, t -> contains(seen.low, t.w))"
    return _seen(text, let_sql(held, "held", f"if(size(held) = 0, {_NONE}, flatten(transform(split({text}, {_LINES}), (line, i) -> {of_line})))"))


def _with_context(text: str, pattern: str, hint: tuple[str, list[str]], reach: int, least: int, body: str) -> str:
    """``body`` of the matches ``m`` (at least ``least`` letters each) and of ``ctx``, inside ``_seen``: each match after the ``reach`` letters before it, in lower case.

    These letters lie in the piece of text before the match and in no more than reach / least matches and pieces before that.
    """
    back = -(-reach // least)
    before = f"right(concat(array_join(slice(both, greatest(k - {back}, 0) + 1, least(k, {back})), ''), right(pieces[k], {reach})), {reach})"
    ctx = let_sql(f"transform(m, (g, k) -> concat(right(pieces[k], {reach}), g))", "both", f"transform(m, (g, k) -> lower(concat({before}, g)))")
    # split compiles its pattern for every text: the matches become a mark to split at, unless the text holds that mark
    pieces = f"if(contains({text}, chr(1)), split({text}, {quoted(_I + pattern)}, -1), split({_matching(text, pattern, (hint[0], []), lambda p: f'regexp_replace({text}, {p}, chr(1))', text)}, chr(1), -1))"
    found = _matching(text, pattern, hint, lambda p: f"regexp_extract_all({text}, {p}, 0)", _NOTHING)
    return let_sql(found, "m", f"if(size(m) = 0, {_NONE}, {let_sql(let_sql(pieces, 'pieces', ctx), 'ctx', body)})")


def quantities(text: str) -> str:
    p = quoted(_I + rules.QUANTITY)
    trigger = "case " + " ".join(f"when contains(ctx[k], {quoted(w)}) then {quoted(w)}" for w in rules.QUANTITY_TRIGGERS) + " end"
    one = let_sql(trigger, "t", _candidate(["0", "k"], f"concat_ws(' ', replace(regexp_extract(g, {p}, 1), ',', '.'), lower(regexp_extract(g, {p}, 2)))", "if(t is null, 0.7, 0.85)", "coalesce(concat('trigger_', t), 'pattern')", "g"))
    return _seen(text, _with_context(text, rules.QUANTITY, (r"\d", []), 50, 2, f"transform(m, (g, k) -> {one})"))


#: Confidence after 0, 1, 2 ... matches near a trigger, by the rule's confidence.
_LADDER = {0.95: [0.95, 1.0], 0.9: [0.9, 1.0], 0.85: [0.85, 0.95, 1.0], 0.8: [0.8, 0.9, 1.0]}


def dates(text: str) -> str:
    """The bonus of a match near a trigger stays for the later matches of its rule."""
    months = "map(" + ", ".join(f"{quoted(n)}, {i}" for n, i in rules.MONTHS.items()) + ")"

    def of_rule(r: int, pattern: str, conf: float, source: str) -> str:
        g1, g2, g3 = (f"regexp_extract(g, {quoted(_I + pattern)}, {i})" for i in (1, 2, 3))
        whole = lambda x: f"cast({x} as int)"
        month = lambda name, size: f"coalesce(try_element_at({months}, substring(lower({name}), 1, {size})), 1)"
        if source in ("iso", "iso_dot", "eu_dot", "slash"):
            # digits between marks
            n1, n2, n3 = (whole(f"n[{i}]") for i in range(3))
            mark = {"iso": "-", "slash": "/"}.get(source, r"\.")
            value = let_sql(f"split(g, {quoted(mark)}, -1)", "n", date_text_sql(n3, n2, n1) if source.startswith("iso") else date_text_sql(n1, n2, n3))
        elif source == "en_textual":
            value = date_text_sql(whole(g2), month(g1, 3), whole(g3))
        else:
            value = date_text_sql(whole(g1), month(g2, 4), whole(g3))
        # the places of the first and the second match near a trigger say how far up the ladder each match is
        steps = _LADDER[conf]
        sure = "case " + (f"when second > 0 and k + 1 >= second then {steps[2]}D " if len(steps) > 2 else "") + f"when first > 0 and k + 1 >= first then {steps[1]}D else {steps[0]}D end"
        near = "transform(ctx, x -> if(contains(x, 'date') or contains(x, 'effective') or contains(x, 'shipped'), 1, 0))"
        after = let_sql("if(first > 0, array_position(slice(flags, cast(first as int) + 1, size(flags)), 1), 0)", "next", f"transform(array(if(next > 0, first + next, 0)), second -> transform(m, (g, k) -> {_candidate([str(r), 'k'], value, sure, quoted(source), 'g')}))[0]")
        return _with_context(text, pattern, _DATE_HINTS[r], 30, 6, let_sql(near, "flags", let_sql("array_position(flags, 1)", "first", after)))

    return _seen(text, _joined([of_rule(r, *rule) for r, rule in enumerate(rules.DATE)]))


EXTRACTORS = {
    "project_id": project_ids,
    "supplier": lambda t: f"concat({supplier_triggers(t)}, {supplier_letterheads(t)})",
    "material": lambda t: f"concat({material_patterns(t)}, {material_triggers(t)})",
    "quantity": quantities,
    "date": dates,
}


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select("doc", F.coalesce("text", F.lit("")).alias("text"))


def candidates(documents: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """doc, field, ord, value, confidence, source, raw_text of every candidate of ``documents`` (doc, text)."""
    of = lambda f: f"transform({EXTRACTORS[f]('text')}, c -> named_struct('field', '{f}', 'c', c))"
    found = F.expr(f"explode(concat({', '.join(map(of, fields or rules.FIELDS))}))").alias("x")
    return _texts(documents).select("doc", found).select("doc", "x.field", "x.c.*")


def part(documents: DataFrame, what: str) -> DataFrame:
    """The candidates of one array expression on ``text``."""
    return _texts(documents).select("doc", F.expr(f"inline({what})"))


def best(cands: DataFrame) -> DataFrame:
    """The best candidate per document and field: values once, at their first place, with their highest confidence."""
    values = cands.groupBy("doc", "field", "value").agg(F.max("confidence").alias("confidence"), F.min("ord").alias("first_ord"))
    # the smallest struct of (inverted confidence, place) is the best; no group is sorted in one task
    first = values.groupBy("doc", "field").agg(F.min(F.struct((-F.col("confidence")).alias("c"), "first_ord", "value")).alias("b"))
    return first.select("doc", "field", "b.value", (-F.col("b.c")).alias("confidence"))


def notes(project: str, supplier: str) -> Column:
    """Remarks on ambiguous and missing fields, from the arrays of candidates (each is named once, so that it is made once)."""
    return F.transform(F.array(F.struct(F.size(project).alias("p"), F.size(supplier).alias("s"))), lambda n: _notes(n["p"], n["s"]))[0]


def _notes(n_project: Column, n_supplier: Column) -> Column:
    return F.array_compact(
        F.array(
            F.when(n_project > 1, F.format_string("Multiple project IDs found (%d), selected highest confidence", n_project)),
            F.when(n_supplier > 1, F.format_string("Multiple suppliers found (%d), selected highest confidence", n_supplier)),
            F.when(n_project == 0, F.lit("No project ID found")),
            F.when(n_supplier == 0, F.lit("No supplier found")),
        )
    )


def best_in_row(cands: str) -> str:
    """The best candidate of an array in candidate order: as ``best``, without leaving the row. Null if it is empty.

    The first value of the array that some candidate of the highest confidence has; hash sets decide, so long arrays
    cost no more than in proportion.
    """
    sure = let_sql(f"array_max(transform({cands}, x -> x.confidence))", "top", f"transform(filter({cands}, x -> x.confidence = top), x -> x.value)")
    return f"try_element_at(array_intersect(transform({cands}, x -> x.value), {sure}), 1)"


def extract(documents: DataFrame) -> DataFrame:
    """doc, the best value of each field (null if none), and the notes: one projection, no shuffle."""
    found = _texts(documents).select("doc", *[F.expr(EXTRACTORS[f]("text")).alias(f) for f in rules.FIELDS])
    return found.select("doc", *[F.expr(best_in_row(f)).alias(f) for f in rules.FIELDS], notes("project_id", "supplier").alias("notes"))


def _as_written(found: str, field: str) -> str:
    """Candidates (SQL) with their field: confidence to three decimals, the first 100 letters of the raw text."""
    return f"transform({found}, c -> named_struct('field', '{field}', 'value', c.value, 'confidence', bround(c.confidence, 3), 'source', c.source, 'raw_text', substring(c.raw_text, 1, 100)))"


def everything(text: str) -> str:
    """All candidates of a text (SQL) in candidate order, as ``all_candidates``."""
    return f"concat({', '.join(_as_written(EXTRACTORS[f](text), f) for f in rules.FIELDS)})"


def extract_with_candidates(documents: DataFrame) -> DataFrame:
    """As ``extract``, with ``all_candidates`` in candidate order: confidence to three decimals, the first 100 letters of the raw text."""
    found = _texts(documents).select("doc", *[F.expr(EXTRACTORS[f]("text")).alias(f) for f in rules.FIELDS])
    listed = F.expr(f"concat({', '.join(_as_written(f, f) for f in rules.FIELDS)})").alias("all_candidates")
    return found.select("doc", *[F.expr(best_in_row(f)).alias(f) for f in rules.FIELDS], listed, notes("project_id", "supplier").alias("notes"))
