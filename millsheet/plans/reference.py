"""Queries of the document-processing operators, with the SQL they equal."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millsheet.functions import pages as P
from millsheet.functions import rules
from millsheet.functions import text as T
from millsheet.operators import extract as X
from millsheet.operators import score as S
from millsheet.plans.corpus import WITH, corpus
from millsheet.session import table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):  # noqa: ANN201
    """Registers a query under its name, with the SQL it equals."""

    def add(f):  # noqa: ANN001, ANN202
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


# ---- SQL pieces


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _case(vocabulary: list[str], context: str) -> str:
    return "CASE " + " ".join(f"WHEN contains({context}, {_lit(w)}) THEN {_lit(w)}" for w in vocabulary) + " END"


def _found(pattern: str, groups: int, out: str, where: str = "TRUE", text: str = "text", source: str = "corpus") -> str:
    """SELECT over every match: m (raw), g1.., k (from 0), s (start)."""
    p = _lit("(?i)" + pattern)
    cols = ", ".join(f"regexp_extract_all({text}, {p}, {i}) AS a{i}" for i in range(groups + 1))
    each = ", ".join(f"a{i}[k] AS g{i}" for i in range(groups + 1))
    return f"""SELECT {out} FROM (SELECT doc, text, k - 1 AS k, {each},
      CAST(list_sum(list_transform(pc[1:k], lambda x: length(x))) + coalesce(list_sum(list_transform(a0[1:k-1], lambda x: length(x))), 0) AS BIGINT) AS s
      FROM (SELECT doc, {text} AS text, {cols}, string_split_regex({text}, {p}) AS pc FROM {source}) f, unnest(range(1, len(a0) + 1)) u(k)) e WHERE {where}"""


def _project_sql() -> str:
    parts = []
    for r, (p, c, s) in enumerate(rules.PROJECT_ID):
        g = 1 if r in (0, 4) else 0
        v = f"upper(trim(g{g}))"
        parts.append(_found(p, g, f"doc, 'project_id' AS field, {r} AS o1, k AS o2, 0 AS o3, {v} AS value, CAST({c} AS DOUBLE) AS confidence, '{s}' AS source, g0 AS raw_text", f"NOT regexp_full_match({v}, '\\d{{4}}') AND length({v}) <= 15"))
    return " UNION ALL ".join(parts)


def _material_pattern_sql() -> str:
    return " UNION ALL ".join(_found(p, 0, f"doc, 'material' AS field, {r} AS o1, k AS o2, 0 AS o3, regexp_replace(trim(g0), '\\s+', ' ', 'g') AS value, CAST({c} AS DOUBLE) AS confidence, '{s}' AS source, g0 AS raw_text") for r, (p, c, s) in enumerate(rules.MATERIAL))


_LINES_SQL = "SELECT doc, unnest(l) AS line, generate_subscripts(l, 1) - 1 AS i, len(l) AS n FROM (SELECT doc, string_split(text, chr(10)) AS l FROM corpus)"


def _vocabulary(words: list[str]) -> str:
    return "(VALUES " + ", ".join(f"({i}, {_lit(w)})" for i, w in enumerate(words)) + ") v(o, w)"


def _material_trigger_sql() -> str:
    value = "trim(string_split_regex(trim(regexp_extract(line, '^[^:=-]*[:=-](.*)$', 1)), '[,;]')[1])"
    return f"SELECT doc, 'material' AS field, 100 AS o1, i AS o2, o AS o3, {value} AS value, CAST(0.7 AS DOUBLE) AS confidence, 'trigger_' || w AS source, line AS raw_text FROM ({_LINES_SQL}) ln, {_vocabulary(rules.MATERIAL_TRIGGERS)} WHERE contains(lower(line), w) AND regexp_matches(line, '[:=-]') AND length({value}) > 2 AND length({value}) < 100"


def _supplier_trigger_sql() -> str:
    has = " OR ".join(f"contains(c, {_lit(s)})" for s in rules.CORPORATE_SUFFIXES)
    return f"""SELECT doc, 'supplier' AS field, i AS o1, o AS o2, j AS o3, regexp_replace(c, '\\s+', ' ', 'g') AS value, CAST(0.8 AS DOUBLE) AS confidence, 'trigger_' || w AS source, c AS raw_text
      FROM (SELECT a.doc, a.i, v.o, v.w, b.i AS j, trim(b.line) AS c FROM ({_LINES_SQL}) a JOIN {_vocabulary(rules.SUPPLIER_TRIGGERS)} ON contains(lower(a.line), w)
      JOIN ({_LINES_SQL}) b ON b.doc = a.doc AND b.i BETWEEN a.i AND a.i + 2) x WHERE lower(c) <> w AND length(c) >= 3 AND ({has})"""


def _letterhead_sql() -> str:
    head = "(SELECT doc, array_to_string(l[1:greatest(5, len(l) // 5)], ' ') AS text FROM (SELECT doc, string_split(text, chr(10)) AS l FROM corpus))"
    no = " OR ".join(f"contains(lower(value), {_lit(w)})" for w in rules.NOT_A_SUPPLIER)
    parts = []
    for k, s in enumerate(rules.CORPORATE_SUFFIXES):
        p = rf"\b([A-Z][A-Za-z\s,.&-]+{X._plain_pattern(s)}\.?)\b"
        parts.append(_found(p, 1, f"doc, 'supplier' AS field, 1000000000 AS o1, {k} AS o2, k AS o3, regexp_replace(trim(g1), '\\s+', ' ', 'g') AS value, CAST(0.6 AS DOUBLE) AS confidence, 'letterhead' AS source, g0 AS raw_text", source=head + " hd").replace("'(?i)", "'"))
    return f"SELECT * FROM ({' UNION ALL '.join(parts)}) WHERE NOT ({no})"


def _quantity_sql() -> str:
    ctx = "lower(substr(text, greatest(s - 50, 0) + 1, s + length(g0) - greatest(s - 50, 0)))"
    t = _case(rules.QUANTITY_TRIGGERS, ctx)
    return _found(rules.QUANTITY, 2, f"doc, 'quantity' AS field, 0 AS o1, k AS o2, 0 AS o3, replace(g1, ',', '.') || ' ' || lower(g2) AS value, CAST(CASE WHEN {t} IS NULL THEN 0.7 ELSE 0.85 END AS DOUBLE) AS confidence, coalesce('trigger_' || {t}, 'pattern') AS source, g0 AS raw_text")


def _date_sql() -> str:
    parts = []
    ctx = "lower(substr(text, greatest(s - 30, 0) + 1, s + length(g0) - greatest(s - 30, 0)))"
    for r, (p, c, s) in enumerate(rules.DATE):
        month = {"en_textual": "CASE substr(lower(g1), 1, 3) " + " ".join(f"WHEN '{m}' THEN {i}" for m, i in rules.MONTHS.items()) + " ELSE 1 END", "fr_textual": "CASE substr(lower(g2), 1, 4) " + " ".join(f"WHEN '{m}' THEN {i}" for m, i in rules.MONTHS.items()) + " ELSE 1 END"}
        d, m, y = {"iso": ("g3", "g2", "g1"), "iso_dot": ("g3", "g2", "g1"), "eu_dot": ("g1", "g2", "g3"), "slash": ("g1", "g2", "g3"), "en_textual": ("g2", month["en_textual"], "g3"), "fr_textual": ("g1", month["fr_textual"], "g3")}[s]
        ladder = X._LADDER[c]
        conf = "CASE least(near_so_far, {}) {} END".format(len(ladder) - 1, " ".join(f"WHEN {i} THEN CAST({v} AS DOUBLE)" for i, v in enumerate(ladder)))
        near = f"CASE WHEN contains({ctx}, 'date') OR contains({ctx}, 'effective') OR contains({ctx}, 'shipped') THEN 1 ELSE 0 END"
        inner = _found(p, 3, f"doc, k, g0, CAST({d} AS INTEGER) AS dd, CAST({m} AS INTEGER) AS mm, CAST({y} AS INTEGER) AS yy, sum({near}) OVER (PARTITION BY doc ORDER BY k) AS near_so_far")
        parts.append(f"SELECT doc, 'date' AS field, {r} AS o1, k AS o2, 0 AS o3, printf('%02d/%02d/%04d', dd, mm, CASE WHEN yy < 50 THEN yy + 2000 WHEN yy < 100 THEN yy + 1900 ELSE yy END) AS value, {conf} AS confidence, '{s}' AS source, g0 AS raw_text FROM ({inner})")
    return " UNION ALL ".join(parts)


_FIELD_SQL = {"project_id": _project_sql, "supplier": lambda: f"{_supplier_trigger_sql()} UNION ALL {_letterhead_sql()}", "material": lambda: f"{_material_pattern_sql()} UNION ALL {_material_trigger_sql()}", "quantity": _quantity_sql, "date": _date_sql}
_SHOW = "doc, value, confidence, source, raw_text"


def _cand_sql(sql: str) -> str:
    return f"{WITH} SELECT {_SHOW} FROM ({sql})"


def _best_cte(fields: list[str]) -> str:
    cand = " UNION ALL ".join(f"SELECT * FROM ({_FIELD_SQL[f]()})" for f in fields)
    return f"""{WITH}, cand AS ({cand}),
    vals AS (SELECT doc, field, value, max(confidence) AS confidence, min([CAST(o1 AS BIGINT), CAST(o2 AS BIGINT), CAST(o3 AS BIGINT)]) AS o FROM cand GROUP BY ALL),
    best AS (SELECT doc, field, value, confidence FROM vals QUALIFY row_number() OVER (PARTITION BY doc, field ORDER BY confidence DESC, o) = 1)"""


# ---- extraction


def _text(spark: SparkSession, sf: str) -> DataFrame:
    return corpus(spark, sf).select("doc", "text")


def _extraction(name: str, array, sql) -> None:  # noqa: ANN001
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return X.part(_text(spark, sf), array("text")).drop("ord")

    QUERIES[name], ORACLE[name] = run, _cand_sql(sql())


for _n, _a, _s in (
    ("project_id_candidates", X.project_ids, _project_sql), ("supplier_trigger_candidates", X.supplier_triggers, _supplier_trigger_sql), ("supplier_letterhead_candidates", X.supplier_letterheads, _letterhead_sql),
    ("material_pattern_candidates", X.material_patterns, _material_pattern_sql), ("material_trigger_candidates", X.material_triggers, _material_trigger_sql), ("quantity_candidates", X.quantities, _quantity_sql), ("date_candidates", X.dates, _date_sql),
):
    _extraction(_n, _a, _s)


def _best_of(field: str) -> None:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return X.best(X.candidates(_text(spark, sf), [field]))

    QUERIES[f"{field}_best"], ORACLE[f"{field}_best"] = run, f"{_best_cte([field])} SELECT * FROM best"


for _f in rules.FIELDS:
    _best_of(_f)

_NOTES_SQL = """list_filter([CASE WHEN np > 1 THEN 'Multiple project IDs found (' || np || '), selected highest confidence' END,
  CASE WHEN ns > 1 THEN 'Multiple suppliers found (' || ns || '), selected highest confidence' END, CASE WHEN np = 0 THEN 'No project ID found' END, CASE WHEN ns = 0 THEN 'No supplier found' END], lambda x: x IS NOT NULL)"""
_ENTITIES_SQL = f"""{_best_cte(rules.FIELDS)},
  counts AS (SELECT c.doc, count(*) FILTER (field = 'project_id') AS np, count(*) FILTER (field = 'supplier') AS ns FROM corpus c LEFT JOIN cand USING (doc) GROUP BY c.doc),
  wide AS (SELECT c.doc, {', '.join(f"max(CASE WHEN field = '{f}' THEN value END) AS {f}" for f in rules.FIELDS)} FROM corpus c LEFT JOIN best USING (doc) GROUP BY c.doc)"""


@query(f"{_ENTITIES_SQL} SELECT doc, {', '.join(rules.FIELDS)}, array_to_string({_NOTES_SQL}, ' | ') AS notes FROM wide JOIN counts USING (doc)")
def extract_entities(spark: SparkSession, sf: str) -> DataFrame:
    return X.extract(_text(spark, sf)).withColumn("notes", F.array_join("notes", " | "))


@query(f"{_ENTITIES_SQL}, n AS (SELECT doc, unnest({_NOTES_SQL}) AS note FROM counts) SELECT regexp_replace(note, '\\d+', 'N') AS note, count(*) AS n FROM n GROUP BY 1")
def notes(spark: SparkSession, sf: str) -> DataFrame:
    return X.extract(_text(spark, sf)).select(F.explode("notes").alias("note")).groupBy(F.regexp_replace("note", r"\d+", "N").alias("note")).agg(F.count("*").alias("n"))


@query(f"{WITH} SELECT a.doc, CAST(a.i AS INTEGER) AS i, CAST(b.i AS INTEGER) AS j, b.line FROM ({_LINES_SQL}) a JOIN ({_LINES_SQL}) b ON a.doc = b.doc AND b.i BETWEEN a.i AND a.i + 2 WHERE length(trim(b.line)) >= 3")
def line_window_join(spark: SparkSession, sf: str) -> DataFrame:
    lines = F.split("text", "\n", -1)
    one = _text(spark, sf).select("doc", F.posexplode(F.transform(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: F.slice(lines, i + 1, F.lit(3)))).alias("i", "near"))
    return one.select("doc", "i", F.posexplode("near").alias("o", "line")).select("doc", "i", (F.col("i") + F.col("o")).alias("j"), "line").where(F.length(T.strip(F.col("line"))) >= 3)


@query(f"{WITH} SELECT doc, CAST(i AS INTEGER) AS i, w AS trigger FROM ({_LINES_SQL}) ln, {_vocabulary(rules.SUPPLIER_TRIGGERS)} WHERE contains(lower(line), w)")
def trigger_theta_join(spark: SparkSession, sf: str) -> DataFrame:
    line = _text(spark, sf).select("doc", F.posexplode(F.split("text", "\n", -1)).alias("i", "line"))
    hit = F.filter(F.array(*[F.lit(t) for t in rules.SUPPLIER_TRIGGERS]), lambda t: F.contains(F.lower("line"), t))
    return line.select("doc", "i", F.explode(hit).alias("trigger"))


@query("""
WITH e AS (SELECT DISTINCT entity_id, document_name, field, value, confidence, ord FROM extracted_entity WHERE document_name IS NOT NULL AND confidence IS NOT NULL AND NOT isnan(confidence)),
v AS (SELECT document_name, field, value, max(confidence) AS confidence, min(ord) AS o, min(entity_id) AS i FROM e GROUP BY ALL)
SELECT document_name, field, value, confidence FROM v QUALIFY row_number() OVER (PARTITION BY document_name, field ORDER BY confidence DESC, o, i) = 1
""")
def best_candidate(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "extracted_entity").where(F.col("document_name").isNotNull() & F.col("confidence").isNotNull() & ~F.isnan("confidence"))
    v = e.groupBy("document_name", "field", "value").agg(F.max("confidence").alias("confidence"), F.min("ord").alias("o"), F.min("entity_id").alias("i"))
    # the smallest struct of (inverted confidence, place) is the best; no group is sorted in one task
    best = v.groupBy("document_name", "field").agg(F.min(F.struct((-F.col("confidence")).alias("c"), "o", "i", "value")).alias("b"))
    return best.select("document_name", "field", "b.value", (-F.col("b.c")).alias("confidence"))


# ---- scoring

_NORM = lambda x: f"trim(regexp_replace(regexp_replace(lower(strip_accents(coalesce({x}, ''))), '[^\\w\\s/.\\-+]', ' ', 'g'), '\\s+', ' ', 'g'))"
_NORM_ID = lambda x: f"regexp_replace({_NORM(x)}, '[^a-z0-9]', '', 'g')"
_NORM_QTY = lambda x: f"replace(replace({_NORM(x)}, 'kgs', 'kg'), 'lbs', 'lb')"


def _norm_date(x: str) -> str:
    p = "'^(\\d{1,2})[/.\\-](\\d{1,2})[/.\\-](\\d{2,4})$'"
    g = [f"regexp_extract(trim({x}), {p}, {i})" for i in (1, 2, 3)]
    y = f"CASE WHEN length({g[2]}) = 2 THEN (CASE WHEN TRY_CAST({g[2]} AS INTEGER) >= 50 THEN '19' ELSE '20' END) || {g[2]} ELSE {g[2]} END"
    return f"CASE WHEN regexp_matches(trim({x}), {p}) THEN lpad({y}, 4, '0') || '-' || lpad({g[1]}, 2, '0') || '-' || lpad({g[0]}, 2, '0') ELSE trim(coalesce({x}, '')) END"


_TOKENS = lambda x: f"list_distinct(list_filter(string_split({_NORM(x)}, ' '), lambda t: length(t) >= 3))"
_OVERLAP = f"len(list_intersect({_TOKENS('pred')}, {_TOKENS('label')})) / len({_TOKENS('label')})"
_INSIDE = lambda a, b: f"(({a} <> '' AND contains({b}, {a})) OR contains({a}, {b}))"
_MATCH = f"""CASE WHEN coalesce(pred, '') = '' THEN FALSE WHEN coalesce(label, '') = '' OR upper({_NORM('label')}) = 'N/A' THEN TRUE
  WHEN field = 'project_id' THEN {_INSIDE(_NORM_ID('pred'), _NORM_ID('label'))} WHEN field = 'date' THEN {_norm_date('pred')} = {_norm_date('label')}
  WHEN field = 'quantity' THEN {_INSIDE(_NORM_QTY('pred'), _NORM_QTY('label'))} WHEN {_NORM('pred')} = '' THEN FALSE
  WHEN len({_TOKENS('label')}) = 0 THEN {_NORM('pred')} = {_NORM('label')} ELSE {_OVERLAP} >= 0.34 END"""
_OUT_CTE = f"""{_ENTITIES_SQL},
  preds AS (SELECT doc, unnest([{', '.join(_lit(f) for f in rules.FIELDS)}]) AS field, unnest([{', '.join(rules.FIELDS)}]) AS pred FROM wide),
  labels AS (SELECT doc, document_name, doc_type, unnest([{', '.join(_lit(f) for f in rules.FIELDS)}]) AS field, unnest([{', '.join('g_' + f for f in rules.FIELDS)}]) AS label FROM corpus),
  paired AS (SELECT l.doc, l.document_name, l.doc_type, l.field, l.label, p.pred, p.doc IS NOT NULL AS present FROM labels l LEFT JOIN preds p ON p.doc = l.doc AND p.field = l.field),
  outcomes AS (SELECT *, CASE WHEN NOT present THEN 'missing-json' WHEN coalesce(pred, '') <> '' AND coalesce(label, '') <> '' THEN (CASE WHEN {_MATCH} THEN 'OK' ELSE 'WRONG' END)
    WHEN coalesce(pred, '') <> '' THEN 'FP' WHEN coalesce(label, '') <> '' THEN 'MISS' ELSE '—' END AS outcome FROM paired),
  tally AS (SELECT field, count(*) FILTER (outcome = 'OK') AS tp, count(*) FILTER (outcome IN ('WRONG', 'FP')) AS fp, count(*) FILTER (outcome IN ('WRONG', 'MISS') OR outcome = 'missing-json' AND label <> '') AS fn FROM outcomes GROUP BY field),
  pr AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS p, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS r FROM tally),
  scores AS (SELECT field, tp, fp, fn, p, r, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END AS f FROM pr)"""


def _outcomes(spark: SparkSession, sf: str) -> DataFrame:
    c = corpus(spark, sf)
    pred = X.extract(c.select("doc", "text"))
    return S.outcomes(c.select("doc", *[f"g_{f}" for f in rules.FIELDS]), pred, "doc")


@query(f"{_OUT_CTE} SELECT doc, field, label, pred, outcome FROM outcomes")
def gt_left_join(spark: SparkSession, sf: str) -> DataFrame:
    return _outcomes(spark, sf).select("doc", "field", "label", "pred", "outcome")


@query(f"{_OUT_CTE} SELECT field, tp, fp, fn, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1 FROM scores")
def entity_scores(spark: SparkSession, sf: str) -> DataFrame:
    six = lambda c: F.round(c, 6).alias(c)
    return S.scores(_outcomes(spark, sf)).select("field", "tp", "fp", "fn", six("precision"), six("recall"), six("f1"))


@query(f"{_OUT_CTE} SELECT round(avg(p), 6) AS precision, round(avg(r), 6) AS recall, round(avg(f), 6) AS f1 FROM scores")
def macro_scores(spark: SparkSession, sf: str) -> DataFrame:
    return S.scores(_outcomes(spark, sf)).agg(*[F.round(F.avg(c), 6).alias(c) for c in ("precision", "recall", "f1")])


@query(f"{_OUT_CTE} SELECT coalesce(field, 'macro') AS field, CAST(sum(tp) AS BIGINT) AS tp, CAST(sum(fp) AS BIGINT) AS fp, CAST(sum(fn) AS BIGINT) AS fn, round(avg(p), 6) AS precision, round(avg(r), 6) AS recall, round(avg(f), 6) AS f1 FROM scores GROUP BY ROLLUP (field)")
def scores_rollup(spark: SparkSession, sf: str) -> DataFrame:
    s = S.scores(_outcomes(spark, sf)).rollup("field").agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn")], *[F.round(F.avg(c), 6).alias(c) for c in ("precision", "recall", "f1")])
    return s.withColumn("field", F.coalesce("field", F.lit("macro")))


@query(f"{_OUT_CTE} SELECT outcome, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 4) AS pct FROM outcomes GROUP BY outcome")
def outcome_distribution(spark: SparkSession, sf: str) -> DataFrame:
    n = _outcomes(spark, sf).groupBy("outcome").agg(F.count("*").alias("n"))
    return n.withColumn("pct", F.round(100.0 * F.col("n") / F.sum("n").over(Window.partitionBy()), 4))


@query(f"{_OUT_CTE} SELECT doc, {', '.join(f"max(CASE WHEN field = '{f}' THEN outcome END) AS {f}" for f in rules.FIELDS)} FROM outcomes GROUP BY doc")
def outcome_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return _outcomes(spark, sf).groupBy("doc").pivot("field", rules.FIELDS).agg(F.first("outcome"))


@query(f"""{_OUT_CTE} SELECT doc, count(*) FILTER (outcome = 'OK') AS ok, CASE WHEN count(*) FILTER (outcome = 'OK') = 5 THEN 'all' WHEN count(*) FILTER (outcome = 'OK') >= 3 THEN 'most'
  WHEN count(*) FILTER (outcome = 'OK') >= 1 THEN 'some' ELSE 'none' END AS band FROM outcomes GROUP BY doc ORDER BY ok DESC, doc""")
def doc_breakdown(spark: SparkSession, sf: str) -> DataFrame:
    d = _outcomes(spark, sf).groupBy("doc").agg(F.count_if(F.col("outcome") == "OK").alias("ok"))
    return d.withColumn("band", F.when(F.col("ok") == 5, "all").when(F.col("ok") >= 3, "most").when(F.col("ok") >= 1, "some").otherwise("none")).orderBy(F.desc("ok"), "doc")


_PAIR_CTE = f"{WITH}, one AS (SELECT doc, supplier_of AS pred, g_supplier AS label FROM (SELECT doc, regexp_extract(text, '^[A-Za-z ]+') AS supplier_of, g_supplier FROM corpus))"


@query(f"{_PAIR_CTE} SELECT doc, CASE WHEN len({_TOKENS('label')}) > 0 THEN round({_OVERLAP}, 6) END AS overlap FROM one")
def token_overlap(spark: SparkSession, sf: str) -> DataFrame:
    pred = F.regexp_extract("text", "^[A-Za-z ]+", 0)
    return corpus(spark, sf).select("doc", F.round(S.token_overlap(pred, F.col("g_supplier")), 6).alias("overlap"))


@query(f"{WITH}, l AS (SELECT doc, unnest([{', '.join(_lit(f) for f in rules.FIELDS)}]) AS field, unnest([{', '.join('g_' + f for f in rules.FIELDS)}]) AS label, text AS pred FROM corpus) SELECT doc, field, {_MATCH} AS matched FROM l")
def eval_match(spark: SparkSession, sf: str) -> DataFrame:
    c = S.unpivot(corpus(spark, sf), "g_", "label", ["doc", "text"])
    return c.select("doc", "field", S.matches(F.col("field"), F.col("text"), F.col("label")).alias("matched"))


def _scalar(name: str, column, sql: str) -> None:  # noqa: ANN001
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return corpus(spark, sf).select("doc", column().alias("value"))

    QUERIES[name], ORACLE[name] = run, f"{WITH} SELECT doc, {sql} AS value FROM corpus"


_scalar("eval_normalize", lambda: T.eval_normalize(F.col("text")), _NORM("text"))
_scalar("eval_normalize_id", lambda: T.eval_normalize_id(F.col("text")), _NORM_ID("text"))
_scalar("eval_normalize_qty", lambda: T.eval_normalize_qty(F.col("g_quantity")), _NORM_QTY("g_quantity"))
_DATE_OF = lambda nl: "regexp_extract(text, '(?:Date: |Issued )([0-9./-]+)', 1)"
_scalar("eval_normalize_date", lambda: T.eval_normalize_date(F.regexp_extract("text", "(?:Date: |Issued )([0-9./-]+)", 1)), _norm_date(_DATE_OF("")))


@query("""SELECT o_orderkey AS doc, printf('%02d/%02d/%04d', CAST(1 + o_orderkey % 35 AS INTEGER), CAST(1 + o_orderkey % 14 AS INTEGER), CAST(CASE WHEN o_orderkey % 120 < 50 THEN o_orderkey % 120 + 2000 WHEN o_orderkey % 120 < 100 THEN o_orderkey % 120 + 1900 ELSE o_orderkey % 120 END AS INTEGER)) AS value FROM orders""")
def normalize_date(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")
    return table(spark, sf, "orders").select(k.alias("doc"), F.expr(T.date_text_sql("1 + o_orderkey % 35", "1 + o_orderkey % 14", "o_orderkey % 120")).alias("value"))


@query("SELECT result_id, CASE WHEN supplier IS NULL THEN '(none)' WHEN length(supplier) > 30 THEN substr(supplier, 1, 30) || '...' ELSE supplier END AS shown FROM (SELECT DISTINCT result_id, extracted_entities.supplier AS supplier FROM extraction_result)")
def preview(spark: SparkSession, sf: str) -> DataFrame:
    r = table(spark, sf, "extraction_result").dropDuplicates(["result_id"])
    return r.select("result_id", T.preview(F.col("extracted_entities.supplier")).alias("shown"))


# ---- documents, pages and runs

_STEM = "regexp_replace(document_name, '\\.[^.]*$', '')"


@query("SELECT doc_id, CASE WHEN contains(document_name, '_FR_') THEN 'FR' ELSE 'EN' END AS language FROM documents")
def detect_language(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", P.language_of_name(F.col("document_name")).alias("language"))


@query(f"""SELECT doc_id, split_part(s, '_', 1) AS origin, split_part(s, '_', 2) AS doc_type, split_part(s, '_', 3) AS lang_code, regexp_extract(s, '^[^_]*_[^_]*_[^_]*_(.*)$', 1) AS source_name
  FROM (SELECT doc_id, {_STEM} AS s FROM documents)""")
def filename_facets(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", *P.facets(F.col("document_name")))


_RESOLVE = """
WITH f AS (SELECT DISTINCT filename, path, variant FROM seed_record WHERE filename IS NOT NULL),
d AS (SELECT document_name, document_name || '.pdf' AS filename, lower(trim(coalesce(modality, 'digital'))) AS modality FROM documents)
SELECT document_name, path FROM d JOIN f USING (filename) QUALIFY row_number() OVER (PARTITION BY document_name ORDER BY CASE WHEN variant = modality THEN 0 WHEN variant IN ('digital', 'scanned') THEN 1 ELSE 2 END, path) = 1
"""


@query(_RESOLVE)
def resolve_source(spark: SparkSession, sf: str) -> DataFrame:
    f = table(spark, sf, "seed_record").where("filename is not null").select("filename", "path", "variant").distinct()
    d = table(spark, sf, "documents").select("document_name", F.concat("document_name", F.lit(".pdf")).alias("filename"), F.lower(F.trim(F.coalesce("modality", F.lit("digital")))).alias("modality"))
    rank = F.when(F.col("variant") == F.col("modality"), 0).when(F.col("variant").isin("digital", "scanned"), 1).otherwise(2)
    return d.join(f, "filename").groupBy("document_name").agg(F.min(F.struct(rank.alias("r"), "path")).alias("b")).select("document_name", "b.path")


@query("SELECT DISTINCT document_name FROM documents SEMI JOIN (SELECT regexp_replace(filename, '\\.pdf$', '') AS document_name FROM seed_record) s USING (document_name)")
def split_used(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("document_name").join(table(spark, sf, "seed_record").select(P.stem(F.col("filename")).alias("document_name")), "document_name", "left_semi").distinct()


@query("SELECT DISTINCT document_name FROM documents ANTI JOIN (SELECT regexp_replace(filename, '\\.pdf$', '') AS document_name FROM seed_record WHERE filename IS NOT NULL) s USING (document_name)")
def split_extra(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("document_name").join(table(spark, sf, "seed_record").where("filename is not null").select(P.stem(F.col("filename")).alias("document_name")), "document_name", "left_anti").distinct()


@query("SELECT doc_type, count(*) FILTER (source = 'real_filled') AS real_filled, count(*) FILTER (source IS DISTINCT FROM 'real_filled') AS synthetic FROM documents GROUP BY doc_type")
def dataset_composition(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.when(F.col("source") == "real_filled", "real_filled").otherwise("synthetic")
    return table(spark, sf, "documents").withColumn("kind", kind).groupBy("doc_type").pivot("kind", ["real_filled", "synthetic"]).count().na.fill(0)


@query("SELECT doc_id, document_name FROM documents ORDER BY doc_id LIMIT 100")
def limit_docs(spark: SparkSession, sf: str) -> DataFrame:
    """The first documents in the order of their numbers: the limit is the feature."""
    return table(spark, sf, "documents").select("doc_id", "document_name").orderBy("doc_id").limit(100)


@query("SELECT doc_id, document_name, n_chars FROM documents WHERE document_name = 'Real_MaterialCert_FR_DossierGeneral' OR doc_type = 'WeldingPlan'")
def filter_doc(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").where((F.col("document_name") == "Real_MaterialCert_FR_DossierGeneral") | (F.col("doc_type") == "WeldingPlan")).select("doc_id", "document_name", "n_chars")


_PAGES = "(SELECT DISTINCT ON (ocr_id) * FROM ocr_result)"
_DOC_OF = "CASE WHEN contains(s, '_p') THEN regexp_extract(s, '^(.*)_p', 1) ELSE s END"


def _pages(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "ocr_result").dropDuplicates(["ocr_id"])


@query(f"SELECT doc, count(*) AS n, array_to_string(list_sort(list(page_file)), ',') AS files FROM (SELECT {_DOC_OF} AS doc, page_file FROM (SELECT regexp_replace(page_file, '\\.[^.]*$', '') AS s, page_file FROM {_PAGES})) GROUP BY doc")
def group_pages(spark: SparkSession, sf: str) -> DataFrame:
    return _pages(spark, sf).groupBy(P.page_document(F.col("page_file")).alias("doc")).agg(F.count("*").alias("n"), F.array_join(F.sort_array(F.collect_list("page_file")), ",").alias("files"))


@query(f"SELECT document_name, string_agg(full_text, chr(10) || chr(10) ORDER BY page_number, ocr_id) AS text FROM (SELECT document_name, page_number, ocr_id, coalesce(full_text, '') AS full_text FROM {_PAGES}) GROUP BY document_name")
def pages_to_document_text(spark: SparkSession, sf: str) -> DataFrame:
    p = _pages(spark, sf).groupBy("document_name").agg(F.array_sort(F.collect_list(F.struct("page_number", "ocr_id", F.coalesce("full_text", F.lit("")).alias("t")))).alias("p"))
    return p.select("document_name", F.array_join(F.transform("p", lambda x: x["t"]), "\n\n").alias("text"))


@query(f"SELECT ocr_id, CASE WHEN len(coalesce(words, [])) > 0 THEN 100.0 ELSE 0.0 END AS confidence FROM {_PAGES} WHERE page_file LIKE '%.pdf-text'")
def digital_page_confidence(spark: SparkSession, sf: str) -> DataFrame:
    return _pages(spark, sf).where(F.col("page_file").endswith(".pdf-text")).select("ocr_id", F.when(F.coalesce(F.size("words"), F.lit(0)) > 0, 100.0).otherwise(0.0).alias("confidence"))


_MEAN = "list_avg(list_transform(list_filter(words, lambda w: trim(w.text) <> '' AND w.confidence >= 0), lambda w: w.confidence))"


@query(f"SELECT ocr_id, round({_MEAN}, 6) AS confidence FROM {_PAGES}")
def page_confidence(spark: SparkSession, sf: str) -> DataFrame:
    return _pages(spark, sf).select("ocr_id", F.round(P.mean_confidence(F.col("words")), 6).alias("confidence"))


_DOC_CONF = f"SELECT document_name, avg(coalesce({_MEAN}, 0)) AS c, count(*) AS n FROM {_PAGES} GROUP BY document_name"


def _doc_confidence(spark: SparkSession, sf: str) -> DataFrame:
    return _pages(spark, sf).groupBy("document_name").agg(F.avg(F.coalesce(P.mean_confidence(F.col("words")), F.lit(0.0))).alias("c"), F.count("*").alias("n"))


@query(f"SELECT document_name, round(c, 6) AS confidence, n AS pages FROM ({_DOC_CONF})")
def doc_confidence(spark: SparkSession, sf: str) -> DataFrame:
    return _doc_confidence(spark, sf).select("document_name", F.round("c", 6).alias("confidence"), F.col("n").alias("pages"))


@query(f"SELECT document_name, round(c, 6) AS confidence FROM ({_DOC_CONF}) ORDER BY c, document_name")
def ocr_confidence_ranking(spark: SparkSession, sf: str) -> DataFrame:
    return _doc_confidence(spark, sf).orderBy("c", "document_name").select("document_name", F.round("c", 6).alias("confidence"))


@query(f"SELECT CASE WHEN c < 50 THEN 'poor' WHEN c < 80 THEN 'borderline' ELSE 'good' END AS band, count(*) AS n FROM ({_DOC_CONF}) GROUP BY 1")
def confidence_buckets(spark: SparkSession, sf: str) -> DataFrame:
    return _doc_confidence(spark, sf).groupBy(P.confidence_band(F.col("c")).alias("band")).agg(F.count("*").alias("n"))


_ENGINES = f"(SELECT ocr_id, CASE WHEN engine = 'tesseract' THEN avg_confidence ELSE avg_confidence - 5 END AS tess, CASE WHEN ocr_id % 3 > 0 THEN avg_confidence - 10 END AS paddle FROM {_PAGES})"


@query(f"SELECT ocr_id, CASE WHEN tess >= 60 THEN 'tesseract' WHEN paddle IS NOT NULL THEN 'paddleocr' WHEN tess IS NOT NULL THEN 'tesseract' END AS engine, CASE WHEN tess >= 60 THEN tess WHEN paddle IS NOT NULL THEN paddle ELSE tess END AS confidence FROM {_ENGINES}")
def engine_fallback(spark: SparkSession, sf: str) -> DataFrame:
    a = F.col("avg_confidence")
    p = _pages(spark, sf).select("ocr_id", F.when(F.col("engine") == "tesseract", a).otherwise(a - 5).alias("tess"), F.when(F.col("ocr_id") % 3 > 0, a - 10).alias("paddle"))
    e = P.chosen_engine(F.col("tess"), F.col("paddle"))
    return p.select("ocr_id", e.alias("engine"), F.when(e == "paddleocr", F.col("paddle")).otherwise(F.col("tess")).alias("confidence"))


@query(f"""WITH p AS {_PAGES}, m AS (SELECT document_name, max(page_number) AS n FROM p GROUP BY 1), w AS (SELECT document_name, unnest(range(1, n + 2)) AS page_number FROM m)
  SELECT w.document_name, CAST(w.page_number AS INTEGER) AS page_number, coalesce(p.full_text, '') AS full_text, coalesce(p.avg_confidence, 0.0) AS avg_confidence, coalesce(p.engine, 'tesseract') AS engine FROM w LEFT JOIN p ON p.document_name = w.document_name AND p.page_number = w.page_number""")
def page_error_isolation(spark: SparkSession, sf: str) -> DataFrame:
    """A page that failed (here one past the last) is an empty page in its place."""
    p = _pages(spark, sf)
    want = p.groupBy("document_name").agg(F.max("page_number").alias("n")).select("document_name", F.explode(F.sequence(F.lit(1), F.col("n") + 1)).alias("page_number"))
    return want.join(p, ["document_name", "page_number"], "left").select("document_name", "page_number", F.coalesce("full_text", F.lit("")).alias("full_text"), F.coalesce("avg_confidence", F.lit(0.0)).alias("avg_confidence"), F.coalesce("engine", F.lit("tesseract")).alias("engine"))


@query(f"""SELECT document_name, '# OCR Results: ' || document_name || chr(10) || '# Total pages: ' || count(*) || chr(10) || chr(10) || string_agg(repeat('=', 80) || chr(10) || 'Page ' || page_number || ': ' || page_file || chr(10) || 'Engine: ' || engine || chr(10)
  || 'Confidence: ' || printf('%.1f', avg_confidence) || '%' || chr(10) || 'Words: ' || len(coalesce(words, [])) || chr(10) || repeat('-', 80) || chr(10) || coalesce(full_text, '') || chr(10) || chr(10), '' ORDER BY page_number, ocr_id) AS txt FROM {_PAGES} GROUP BY document_name""")
def ocr_txt_render(spark: SparkSession, sf: str) -> DataFrame:
    head = F.concat(F.lit("Page "), "page_number", F.lit(": "), "page_file", F.lit("\nEngine: "), "engine", F.lit("\nConfidence: "), T.one_decimal(F.col("avg_confidence")), F.lit("%\nWords: "), F.coalesce(F.size("words"), F.lit(0)))
    page = F.concat(F.lit("=" * 80 + "\n"), head, F.lit("\n" + "-" * 80 + "\n"), F.coalesce("full_text", F.lit("")), F.lit("\n\n"))
    p = _pages(spark, sf).groupBy("document_name").agg(F.array_sort(F.collect_list(F.struct("page_number", "ocr_id", page.alias("t")))).alias("p"))
    return p.select("document_name", F.concat(F.lit("# OCR Results: "), "document_name", F.lit("\n# Total pages: "), F.size("p"), F.lit("\n\n"), F.array_join(F.transform("p", lambda x: x["t"]), "")).alias("txt"))


@query("""SELECT result_id, CAST(to_json({'document_name': document_name, 'extracted_entities': extracted_entities, 'notes': notes}) AS VARCHAR) AS json FROM (SELECT DISTINCT ON (result_id) * FROM extraction_result)""")
def extraction_json(spark: SparkSession, sf: str) -> DataFrame:
    r = table(spark, sf, "extraction_result").dropDuplicates(["result_id"])
    return r.select("result_id", F.to_json(F.struct("document_name", "extracted_entities", "notes"), {"ignoreNullFields": "false"}).alias("json"))


@query("SELECT max(run_id) AS run_id FROM pipeline_run")
def latest_run(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pipeline_run").agg(F.max("run_id").alias("run_id"))


_STATUS = f"""SELECT d.document_name, CASE WHEN coalesce(d.text, '') = '' THEN 'preprocessing' WHEN d.modality = 'scanned' AND o.document_name IS NULL THEN 'ocr' WHEN r.document_name IS NULL THEN 'extraction' END AS error_stage,
  coalesce(o.n, 1) AS pages, o.c AS confidence FROM documents d LEFT JOIN ({_DOC_CONF}) o USING (document_name) LEFT JOIN (SELECT DISTINCT document_name FROM extraction_result) r USING (document_name)"""


def _status(spark: SparkSession, sf: str) -> DataFrame:
    """What stage each document failed in, null if in none; a document that failed skips the later stages."""
    o = _doc_confidence(spark, sf).withColumn("seen", F.lit(True))
    r = table(spark, sf, "extraction_result").select("document_name").distinct().withColumn("done", F.lit(True))
    # of the text only a flag is joined
    d = table(spark, sf, "documents").select("document_name", (F.coalesce("text", F.lit("")) == "").alias("blank"), "modality").join(o, "document_name", "left").join(r, "document_name", "left")
    stage = F.when(F.col("blank"), "preprocessing").when((F.col("modality") == "scanned") & F.col("seen").isNull(), "ocr").when(F.col("done").isNull(), "extraction")
    return d.select("document_name", stage.alias("error_stage"), F.coalesce("n", F.lit(1)).alias("pages"), F.col("c").alias("confidence"))


@query(f"SELECT document_name, error_stage, pages, round(confidence, 6) AS confidence FROM ({_STATUS})")
def pipeline_status(spark: SparkSession, sf: str) -> DataFrame:
    return _status(spark, sf).withColumn("confidence", F.round("confidence", 6))


@query(f"SELECT error_stage, count(*) AS n FROM ({_STATUS}) WHERE error_stage IS NOT NULL GROUP BY 1")
def stage_failures(spark: SparkSession, sf: str) -> DataFrame:
    return _status(spark, sf).where("error_stage is not null").groupBy("error_stage").agg(F.count("*").alias("n"))


@query(f"""SELECT count(*) AS total_documents, count(*) FILTER (error_stage IS NULL) AS successful, count(*) FILTER (error_stage IS NOT NULL) AS failed, count(*) FILTER (error_stage = 'preprocessing') AS failed_preprocessing,
  count(*) FILTER (error_stage = 'ocr') AS failed_ocr, count(*) FILTER (error_stage = 'extraction') AS failed_extraction, round(coalesce(avg(confidence) FILTER (coalesce(error_stage, '') NOT IN ('preprocessing', 'ocr')), 0), 2) AS avg_ocr_confidence, CAST(sum(pages) AS BIGINT) AS total_pages FROM ({_STATUS})""")
def run_summary(spark: SparkSession, sf: str) -> DataFrame:
    e = F.coalesce("error_stage", F.lit(""))
    ok = ~e.isin("preprocessing", "ocr")
    return _status(spark, sf).agg(
        F.count("*").alias("total_documents"), F.count_if(e == "").alias("successful"), F.count_if(e != "").alias("failed"), *[F.count_if(e == s).alias(f"failed_{s}") for s in ("preprocessing", "ocr", "extraction")],
        F.round(F.coalesce(F.avg(F.when(ok, F.col("confidence"))), F.lit(0.0)), 2).alias("avg_ocr_confidence"), F.sum("pages").alias("total_pages"),
    )


@query(f"""WITH r AS (SELECT DISTINCT ON (result_id) * FROM extraction_result), u AS (SELECT unnest([{', '.join(_lit(f) for f in rules.FIELDS)}]) AS field, unnest([{', '.join('extracted_entities.' + f for f in rules.FIELDS)}]) AS v FROM r)
  SELECT field, count(v) AS filled, round(100.0 * count(v) / count(*), 4) AS pct FROM u GROUP BY field""")
def field_fill_rate(spark: SparkSession, sf: str) -> DataFrame:
    r = table(spark, sf, "extraction_result").dropDuplicates(["result_id"]).select("extracted_entities.*")
    u = S.unpivot(r, "", "v", [])
    return u.groupBy("field").agg(F.count("v").alias("filled"), F.round(100.0 * F.count("v") / F.count("*"), 4).alias("pct"))


_K = "o_orderkey"
_POLY = [(f"({_K} % 97) + 0.5", f"({_K} % 89) + 0.25"), (f"({_K} % 97) + 40.75", f"({_K} % 89) + 1"), (f"({_K} % 97) + 41", f"({_K} % 89) + 12.5"), (f"({_K} % 97) + 1", f"({_K} % 89) + 11.75")]


@query(f"""WITH p AS (SELECT {_K} AS k, {', '.join(f'CAST({x} AS DOUBLE) AS x{i}, CAST({y} AS DOUBLE) AS y{i}' for i, (x, y) in enumerate(_POLY))} FROM orders)
  SELECT k, CAST(trunc(least(x0,x1,x2,x3)) AS INTEGER) AS x, CAST(trunc(least(y0,y1,y2,y3)) AS INTEGER) AS y, CAST(trunc(greatest(x0,x1,x2,x3) - trunc(least(x0,x1,x2,x3))) AS INTEGER) AS w, CAST(trunc(greatest(y0,y1,y2,y3) - trunc(least(y0,y1,y2,y3))) AS INTEGER) AS h FROM p""")
def polygon_bbox(spark: SparkSession, sf: str) -> DataFrame:
    points = F.array(*[F.struct(F.expr(x).cast("double").alias("x"), F.expr(y).cast("double").alias("y")) for x, y in _POLY])
    b = table(spark, sf, "orders").select(F.col(_K).alias("k"), P.polygon_bbox(points).alias("b"))
    return b.select("k", *[F.col("b")[i].alias(n) for i, n in enumerate("xywh")])


_ANGLE = f"CAST(({_K} % 181) - 90 AS DOUBLE) + 0.125 * ({_K} % 8)"


@query(f"WITH a AS (SELECT {_K} AS k, {_ANGLE} AS a FROM orders), t AS (SELECT k, CASE WHEN a < -45 THEN -(a + 90) ELSE -a END AS t FROM a) SELECT k, CASE WHEN abs(t) < 0.3 THEN 0.0 ELSE t END AS angle FROM t")
def deskew_angle(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(F.col(_K).alias("k"), P.deskew_angle(F.expr(_ANGLE).cast("double")).alias("angle"))


#: First bytes of files: a PDF, images, what only looks like one (a GIF of no version, a wave file, a cut JPEG), a page of HTML.
_HEADS = ["255044462D", "FFD8FFE0", "89504E470D0A1A0A", "474946383761", "474946383961", "474946383978", "524946462400000057454250", "524946462400000057415645", "FFD800", "3C68746D6C"]


def _files(spark: SparkSession, sf: str) -> DataFrame:
    """Files whose first bytes and lengths vary with the key."""
    k = F.col(_K)
    head = F.element_at(F.array(*[F.to_binary(F.lit(h), F.lit("hex")) for h in _HEADS]), (k % len(_HEADS) + 1).cast("int"))
    return table(spark, sf, "orders").select(k.alias("k"), F.concat(head, F.encode(F.repeat(F.lit("x"), (k % 2029).cast("int")), "utf-8")).alias("content"))


_FILES = f"(SELECT k, h, length(h) // 2 AS size FROM (SELECT {_K} AS k, [{', '.join(_lit(h) for h in _HEADS)}][CAST({_K} % {len(_HEADS)} AS INTEGER) + 1] || repeat('78', CAST({_K} % 2029 AS INTEGER)) AS h FROM orders))"
_KIND = "CASE WHEN size < 50 THEN NULL WHEN h LIKE 'FFD8FF%' THEN 'jpeg' WHEN h LIKE '89504E470D0A1A0A%' THEN 'png' WHEN h LIKE '474946383761%' OR h LIKE '474946383961%' THEN 'gif' WHEN h LIKE '52494646________57454250%' THEN 'webp' END"


@query(f"SELECT k, CASE WHEN size < 1024 THEN 'too small' WHEN h NOT LIKE '255044462D%' THEN 'no PDF' ELSE 'ok' END AS fetched, h LIKE '255044462D%' AND size > 1024 AS present FROM {_FILES}")
def pdf_magic_filter(spark: SparkSession, sf: str) -> DataFrame:
    return _files(spark, sf).select("k", P.pdf_check(F.col("content")).alias("fetched"), P.pdf_present(F.col("content")).alias("present"))


@query(f"SELECT k, {_KIND} AS kind, CASE WHEN size < 512 THEN 'too small' WHEN {_KIND} IS NULL THEN 'no image' ELSE 'ok' END AS fetched FROM {_FILES}")
def sniff_image_type(spark: SparkSession, sf: str) -> DataFrame:
    return _files(spark, sf).select("k", P.image_type(F.col("content")).alias("kind"), P.image_check(F.col("content")).alias("fetched"))
