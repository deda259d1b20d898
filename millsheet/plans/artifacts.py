"""Queries of reports, sources, sinks, streams and the table function, with the SQL they equal."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millsheet import streaming
from millsheet.functions import pages as P
from millsheet.functions import rules
from millsheet.operators import columnar, providers, runs, udtf
from millsheet.operators import extract as X
from millsheet.operators import score as S
from millsheet.plans import reference as R
from millsheet.plans.corpus import WITH, corpus
from millsheet.plans.forms import WITH as FORMS_WITH
from millsheet.plans.forms import forms
from millsheet.session import table, work_folder
from millsheet.sources import readers, writers

QUERIES: dict = {}
ORACLE: dict[str, str] = {}
_FIELDS = ", ".join(rules.FIELDS)
_FIELD_LIST = "[" + ", ".join(f"'{f}'" for f in rules.FIELDS) + "]"


def query(sql: str):  # noqa: ANN201
    """Registers a query under its name, with the SQL it equals."""

    def add(f):  # noqa: ANN001, ANN202
        QUERIES[f.__name__], ORACLE[f.__name__] = f, sql
        return f

    return add


# ---- extraction with everything it found


_CANDIDATES_SQL = f"""{R._best_cte(rules.FIELDS)} SELECT doc, CAST(row_number() OVER (PARTITION BY doc ORDER BY list_position({_FIELD_LIST}, field), o1, o2, o3) - 1 AS INTEGER) AS position,
  field, value, round(confidence, 3) AS confidence, source, substr(raw_text, 1, 100) AS raw_text FROM cand"""


@query(_CANDIDATES_SQL)
def extraction_documents(spark: SparkSession, sf: str) -> DataFrame:
    """All candidates of every extraction document, in their order."""
    return columnar.candidates(corpus(spark, sf).select("doc", "text"))


@query(_CANDIDATES_SQL)
def udtf_candidates(spark: SparkSession, sf: str) -> DataFrame:
    """The same by the table function in Python, whose order is that of its rows."""
    udtf.register(spark)
    texts = corpus(spark, sf).select("doc", "text")
    got = spark.sql("SELECT doc, c.* FROM {texts}, LATERAL extract_candidates(text) c", texts=texts)
    # rows of one document come out one after the other in one task
    numbered = got.withColumn("i", F.monotonically_increasing_id())
    position = F.col("i") - F.min("i").over(R.Window.partitionBy("doc"))
    return numbered.select("doc", position.cast("int").alias("position"), "field", "value", F.bround("confidence", 3).alias("confidence"), "source", F.substring("raw_text", 1, 100).alias("raw_text"))


# ---- forms


@query(f"{FORMS_WITH} SELECT * FROM corpus")
def generated_forms(spark: SparkSession, sf: str) -> DataFrame:
    return forms(spark)


@query(f"{R._OUT_CTE.replace(WITH, FORMS_WITH)} SELECT doc_type, field, outcome, count(*) AS n FROM outcomes GROUP BY ALL")
def form_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    """How well the fields of each kind of form are found."""
    f = forms(spark)
    o = S.outcomes(f.select("doc", *[f"g_{x}" for x in rules.FIELDS]), X.extract(f.select("doc", "text")), "doc")
    return o.join(f.select("doc", "doc_type"), "doc").groupBy("doc_type", "field", "outcome").agg(F.count("*").alias("n"))


# ---- reports of runs


_REPORT = f"""WITH o AS (SELECT document_name, count(*) AS n, avg(coalesce({R._MEAN}, 0)) AS c, sum(length(coalesce(full_text, ''))) AS len FROM {R._PAGES} GROUP BY 1),
  f AS ({R._RESOLVE}), r AS (SELECT DISTINCT document_name, extracted_entities FROM extraction_result),
  s AS (SELECT d.document_name, f.path, d.modality, o.n, o.c, CASE WHEN d.modality = 'scanned' THEN coalesce(o.len, 0) ELSE length(coalesce(d.text, '')) END AS len, r.extracted_entities AS e,
    CASE WHEN f.path IS NULL THEN 'preprocessing' WHEN coalesce(d.text, '') = '' THEN 'unknown' WHEN d.modality = 'scanned' AND o.n IS NULL THEN 'ocr' WHEN r.document_name IS NULL THEN 'extraction' END AS error_stage
    FROM documents d LEFT JOIN o USING (document_name) LEFT JOIN f USING (document_name) LEFT JOIN r USING (document_name)),
  report AS (SELECT document_name, coalesce(path, '(not found)') AS source_path, error_stage IS NULL AS success, coalesce(error_stage, '') NOT IN ('preprocessing', 'unknown') AS preprocessing_ok,
    coalesce(error_stage, '') NOT IN ('preprocessing', 'unknown', 'ocr') AS ocr_ok, error_stage IS NULL AS extraction_ok, CASE WHEN coalesce(error_stage, '') IN ('preprocessing', 'unknown') THEN 0 ELSE CAST(coalesce(n, 1) AS INTEGER) END AS page_count,
    round(CASE WHEN coalesce(error_stage, '') IN ('preprocessing', 'unknown', 'ocr') THEN 0.0 ELSE coalesce(c, 100.0) END, 2) AS avg_ocr_confidence, CASE WHEN coalesce(error_stage, '') IN ('preprocessing', 'unknown', 'ocr') THEN 0 ELSE CAST(len AS INTEGER) END AS total_text_length,
    {', '.join(f"CASE WHEN error_stage IS NULL THEN e.{f} END AS {f}" for f in rules.FIELDS)}, error_stage,
    CASE error_stage WHEN 'preprocessing' THEN 'source file not found' WHEN 'unknown' THEN 'text is missing' WHEN 'ocr' THEN 'no page was read' WHEN 'extraction' THEN 'no extraction result' END AS error_message FROM s)"""


def _reports(spark: SparkSession, sf: str) -> DataFrame:
    # of the texts only flags and lengths are joined
    d = table(spark, sf, "documents").select("document_name", "modality", (F.coalesce("text", F.lit("")) == "").alias("blank"), F.length(F.coalesce("text", F.lit(""))).alias("letters"))
    o = R._pages(spark, sf).groupBy("document_name").agg(F.count("*").alias("n"), F.avg(F.coalesce(P.mean_confidence(F.col("words")), F.lit(0.0))).alias("c"), F.sum(F.length(F.coalesce("full_text", F.lit("")))).alias("len"))
    r = table(spark, sf, "extraction_result").select("document_name", "extracted_entities.*").distinct().withColumn("done", F.lit(True))
    d = d.join(R.resolve_source(spark, sf), "document_name", "left").join(o, "document_name", "left").join(r, "document_name", "left")
    scanned = F.col("modality") == "scanned"
    return runs.reports(d.select(
        "document_name", F.col("path").alias("source_path"), F.lit(None).cast("string").alias("preprocessing"), F.when(F.col("blank"), "text is missing").alias("unknown"), F.when(scanned & F.col("n").isNull(), runs.NO_PAGE).alias("ocr"), F.when(F.col("done").isNull(), runs.NO_RESULT).alias("extraction"),
        F.coalesce("n", F.lit(1)).alias("page_count"), F.coalesce("c", F.lit(100.0)).alias("confidence"), F.when(scanned, F.coalesce("len", F.lit(0))).otherwise(F.col("letters")).alias("text_length"), *rules.FIELDS,
    ))


@query(f"{_REPORT} SELECT * FROM report")
def document_reports(spark: SparkSession, sf: str) -> DataFrame:
    """The documents of the run summary, with stages, outputs, fields and errors."""
    return _reports(spark, sf)


@query(f"{_REPORT} SELECT error_stage, error_message, count(*) AS n FROM report WHERE error_stage IS NOT NULL GROUP BY ALL")
def error_messages(spark: SparkSession, sf: str) -> DataFrame:
    return _reports(spark, sf).where("not success").groupBy("error_stage", "error_message").agg(F.count("*").alias("n"))


@query(f"""{_REPORT} SELECT count(*) AS total_documents, count(*) FILTER (success) AS successful, count(*) FILTER (NOT success) AS failed, count(*) FILTER (error_stage = 'preprocessing') AS preprocessing, count(*) FILTER (error_stage = 'ocr') AS ocr,
  count(*) FILTER (error_stage = 'extraction') AS extraction, round(coalesce(avg(avg_ocr_confidence) FILTER (ocr_ok), 0.0), 2) AS avg_ocr_confidence, CAST(sum(page_count) AS INTEGER) AS total_pages_processed FROM report""")
def run_summary_document(spark: SparkSession, sf: str) -> DataFrame:
    """The totals of the written run summary, read back from its file."""
    path = f"{work_folder(spark)}/{uuid.uuid4().hex}"
    writers.write_json(runs.run_totals(_reports(spark, sf)), path)
    kinds = "total_documents long, successful long, failed long, stage_failures struct<preprocessing: long, ocr: long, extraction: long>, avg_ocr_confidence double, total_pages_processed int"
    return spark.read.schema(kinds).json(path).select("total_documents", "successful", "failed", "stage_failures.*", "avg_ocr_confidence", "total_pages_processed")


@query(f"{_REPORT} SELECT CASE WHEN count(*) FILTER (NOT success) = 0 THEN 0 ELSE 2 END AS status FROM report")
def exit_status(spark: SparkSession, sf: str) -> DataFrame:
    return runs.exit_status(_reports(spark, sf))


@query("SELECT 'pipeline_run_' || strftime(max(received_at), '%Y%m%d_%H%M%S') || '.json' AS file FROM pipeline_run")
def latest_run_file(spark: SparkSession, sf: str) -> DataFrame:
    """The run summary whose name is last."""
    name = F.concat(F.lit("pipeline_run_"), F.date_format("received_at", "yyyyMMdd_HHmmss"), F.lit(".json"))
    return readers.latest_run_file(table(spark, sf, "pipeline_run").select(name.alias("file"), name.alias("path"))).select(F.col("path").alias("file"))


# ---- metrics and their display


@query(f"""{R._OUT_CTE}, mean AS (SELECT avg(p) AS p, avg(r) AS r, avg(f) AS f FROM scores),
  m AS (SELECT 'per_entity' AS section, field AS name, unnest(['precision', 'recall', 'f1', 'tp', 'fp', 'fn']) AS measure, unnest([p, r, f, CAST(tp AS DOUBLE), CAST(fp AS DOUBLE), CAST(fn AS DOUBLE)]) AS value FROM scores
    UNION ALL SELECT 'macro', 'macro', unnest(['precision', 'recall', 'f1']), unnest([p, r, f]) FROM mean) SELECT section, name, measure, round(value, 6) AS value FROM m""")
def metrics_document(spark: SparkSession, sf: str) -> DataFrame:
    return runs.metrics(R._outcomes(spark, sf)).withColumn("value", F.round("value", 6))


_MARK = "CASE {} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in P.OUTCOME_MARKS.items()) + " ELSE '?' END"


@query(f"""{R._OUT_CTE} SELECT doc, substr(any_value(document_name), 1, 46) AS document, substr(any_value(doc_type), 1, 14) AS type, {', '.join(f"{_MARK.format(f"max(CASE WHEN field = '{f}' THEN outcome END)")} AS {f}" for f in rules.FIELDS)} FROM outcomes GROUP BY doc""")
def outcome_display(spark: SparkSession, sf: str) -> DataFrame:
    """The outcomes as a table for reading: shortened names and a mark for every outcome."""
    names = corpus(spark, sf).select("doc", F.substring("document_name", 1, 46).alias("document"), F.substring("doc_type", 1, 14).alias("type"))
    marks = R._outcomes(spark, sf).groupBy("doc").pivot("field", rules.FIELDS).agg(F.first("outcome"))
    return names.join(marks, "doc").select("doc", "document", "type", *[P.outcome_mark(F.col(f)).alias(f) for f in rules.FIELDS])


_SEED = "(SELECT regexp_replace(filename, '\\.pdf$', '') AS document_name, seed_id, project_id, supplier, material, quantity, date FROM seed_record WHERE filename IS NOT NULL QUALIFY row_number() OVER (PARTITION BY filename ORDER BY seed_id) = 1)"


@query(f"""WITH s AS {_SEED}, r AS (SELECT DISTINCT document_name, extracted_entities FROM extraction_result), l AS (SELECT document_name, unnest({_FIELD_LIST}) AS field, unnest([{_FIELDS}]) AS label FROM s),
  p AS (SELECT document_name, unnest({_FIELD_LIST}) AS field, unnest([{', '.join('extracted_entities.' + f for f in rules.FIELDS)}]) AS pred FROM r)
  SELECT CASE WHEN p.document_name IS NULL THEN 'missing-json' WHEN coalesce(pred, '') <> '' AND coalesce(label, '') <> '' THEN 'both' WHEN coalesce(pred, '') <> '' THEN 'FP' WHEN coalesce(label, '') <> '' THEN 'MISS' ELSE '\u2014' END AS outcome, field, count(*) AS n
  FROM l LEFT JOIN p USING (document_name, field) GROUP BY 1, 2""".replace("\\u2014", "\u2014"))
def seed_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    """The expected values against the results that are there: what is missing on either side, and results that don't exist."""
    labels = runs.first_match(table(spark, sf, "seed_record").select("filename", "seed_id", *rules.FIELDS), "filename", "seed_id")
    labels = labels.select(P.stem(F.col("filename")).alias("doc"), *[F.col(f).alias(f"g_{f}") for f in rules.FIELDS])
    preds = table(spark, sf, "extraction_result").select(F.col("document_name").alias("doc"), "extracted_entities.*").distinct()
    o = S.outcomes(labels, preds, "doc").withColumn("outcome", F.when(F.col("outcome").isin("OK", "WRONG"), "both").otherwise(F.col("outcome")))
    return o.groupBy("outcome", "field").agg(F.count("*").alias("n"))


# ---- expected values


@query(f"WITH s AS {_SEED} SELECT d.document_name, s.seed_id, {', '.join('s.' + f for f in rules.FIELDS)} FROM documents d LEFT JOIN s USING (document_name)")
def seed_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """The first expected values of every document's file."""
    first = runs.first_match(table(spark, sf, "seed_record").select("filename", "seed_id", *rules.FIELDS), "filename", "seed_id").withColumn("document_name", P.stem(F.col("filename"))).drop("filename")
    return table(spark, sf, "documents").select("document_name").join(first, "document_name", "left")


_SEED_COLUMNS = f"{_FIELDS}, doc_type, filename, language"


@query(f"""WITH f AS (SELECT * FROM seed_record WHERE filename IS NOT NULL QUALIFY row_number() OVER (PARTITION BY filename ORDER BY seed_id) = 1), i AS (SELECT document_name || '.png' AS filename, document_name || '.pdf' AS source_pdf FROM documents WHERE modality = 'scanned'),
  s AS (SELECT DISTINCT seed_id, {_SEED_COLUMNS}, variant FROM seed_record)
  SELECT {_SEED_COLUMNS}, variant, CAST(NULL AS VARCHAR) AS source_pdf FROM s UNION ALL SELECT {', '.join('f.' + f for f in rules.FIELDS)}, f.doc_type, i.filename, f.language, 'image', i.source_pdf FROM i JOIN f ON f.filename = i.source_pdf""")
def seed_append(spark: SparkSession, sf: str) -> DataFrame:
    """The expected values with entries for the images of scanned documents."""
    scanned = table(spark, sf, "documents").where("modality = 'scanned'").select(F.concat("document_name", F.lit(".png")).alias("filename"), F.concat("document_name", F.lit(".pdf")).alias("source_pdf"))
    seeds = table(spark, sf, "seed_record").select("seed_id", *rules.FIELDS, "doc_type", "filename", "language", "variant").distinct()
    return runs.with_images(seeds, scanned)


@query("SELECT seed_id, filename FROM (SELECT DISTINCT seed_id, filename FROM seed_record) ORDER BY seed_id LIMIT 20")
def limit_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The first rows of the expected values, by the number of the row: the limit is the feature."""
    return runs.first_rows(table(spark, sf, "seed_record").select("seed_id", "filename").distinct(), 20, "seed_id")


# ---- files, pages and boxes


@query("SELECT DISTINCT path, CASE WHEN lower(path) LIKE '%.pdf' THEN NULL ELSE 'only PDF files are read: ' || coalesce(path, '') END AS error FROM seed_record")
def input_errors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "seed_record").select("path", runs.input_error(F.col("path")).alias("error")).distinct()


@query("SELECT document_name, CASE WHEN lower(trim(coalesce(modality, 'digital'))) = 'scanned' THEN 'clean' ELSE 'gray' END AS cleaner, CASE WHEN lower(trim(coalesce(modality, 'digital'))) = 'digital' THEN 'text_layer' ELSE 'ocr' END AS reader FROM documents")
def modality_routing(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("document_name", runs.cleaner(F.col("modality")).alias("cleaner"), runs.text_reader(F.col("modality")).alias("reader"))


@query(f"SELECT ocr_id, regexp_replace(document_name, '\\.[^.]*$', '') || '_p' || printf('%02d', page_number) || '.png' AS file FROM {R._PAGES}")
def page_files(spark: SparkSession, sf: str) -> DataFrame:
    return R._pages(spark, sf).select("ocr_id", writers.page_file(F.col("document_name"), F.col("page_number")).alias("file"))


_KEPT = "list_filter(coalesce(words, []), lambda w: trim(w.text) <> '')"


@query(f"""WITH p AS (SELECT ocr_id, document_name, page_number, full_text, {_KEPT} AS k FROM {R._PAGES}) SELECT ocr_id, regexp_replace(document_name, '\\.[^.]*$', '') || '_p' || printf('%02d', page_number) || '.pdf-text' AS page_file, trim(coalesce(full_text, ''), ' ' || chr(9) || chr(10) || chr(13)) AS full_text, CAST(len(k) AS INTEGER) AS words,
  CAST(CASE WHEN len(k) > 0 THEN 100 ELSE 0 END AS DOUBLE) AS confidence, array_to_string(list_transform(k, lambda w: CAST(trunc(w.bbox[1] + 0.75) AS INTEGER) || ' ' || CAST(trunc(w.bbox[2] + 0.5) AS INTEGER) || ' ' || CAST(trunc((w.bbox[1] + w.bbox[3] + 0.5) - (w.bbox[1] + 0.75)) AS INTEGER) || ' ' || CAST(trunc((w.bbox[2] + w.bbox[4] + 0.25) - (w.bbox[2] + 0.5)) AS INTEGER)), ',') AS boxes FROM p""")
def text_layer_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Pages of a text layer, whose words have corners that are no whole numbers."""
    corners = F.transform("words", lambda w: F.struct(w["text"].alias("text"), (w["bbox"][0] + 0.75).cast("double").alias("x0"), (w["bbox"][1] + 0.5).cast("double").alias("y0"), (w["bbox"][0] + w["bbox"][2] + 0.5).cast("double").alias("x1"), (w["bbox"][1] + w["bbox"][3] + 0.25).cast("double").alias("y1")))
    pages = R._pages(spark, sf).select(F.col("document_name"), F.col("page_number"), F.col("full_text").alias("text"), corners.alias("layer"), "ocr_id")
    # the number of the row goes through as a part of the name
    out = providers.text_layer_pages(pages.select(F.struct("ocr_id", "document_name").alias("id"), "*").withColumn("document_name", F.concat_ws("/", F.col("id.ocr_id").cast("string"), "document_name")).drop("id"))
    boxes = F.array_join(F.transform("words", lambda w: F.array_join(w["bbox"].cast("array<string>"), " ")), ",")
    return out.select(F.split("document_name", "/")[0].cast("long").alias("ocr_id"), "page_file", "full_text", F.size("words").alias("words"), F.col("avg_confidence").alias("confidence"), boxes.alias("boxes"))


_K = "o_orderkey"


@query(f"SELECT {_K} AS k, CAST(trunc(x0) AS INTEGER) AS x, CAST(trunc(y0) AS INTEGER) AS y, CAST(trunc(x1 - x0) AS INTEGER) AS w, CAST(trunc(y1 - y0) AS INTEGER) AS h FROM (SELECT {_K}, CAST({_K} % 97 - 40 + 0.75 AS DOUBLE) AS x0, CAST({_K} % 89 + 0.25 AS DOUBLE) AS y0, CAST({_K} % 97 + 12.5 AS DOUBLE) AS x1, CAST({_K} % 89 + 11 AS DOUBLE) AS y1 FROM orders)")
def corner_bbox(spark: SparkSession, sf: str) -> DataFrame:
    word = F.struct(*[F.expr(e).cast("double").alias(n) for n, e in (("x0", f"{_K} % 97 - 40 + 0.75"), ("y0", f"{_K} % 89 + 0.25"), ("x1", f"{_K} % 97 + 12.5"), ("y1", f"{_K} % 89 + 11"))])
    b = table(spark, sf, "orders").select(F.col(_K).alias("k"), P.corner_bbox(word).alias("b"))
    return b.select("k", *[F.col("b")[i].alias(n) for i, n in enumerate("xywh")])


@query(f"SELECT {_K} AS k, round(CAST(({_K} % 1001) / 1000.0 AS DOUBLE) * 100, 6) AS confidence FROM orders")
def confidence_scale(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(F.col(_K).alias("k"), F.round(P.percent((F.col(_K) % 1001) / 1000.0), 6).alias("confidence"))


# ---- sources, sinks and streams: written to the application's folder and read again


def _folder(spark: SparkSession) -> str:
    return f"{work_folder(spark)}/{uuid.uuid4().hex}"


@query(f"SELECT document_name, CAST(count(*) OVER (PARTITION BY document_name) AS INTEGER) AS total_pages, page_number, page_file, engine, round(avg_confidence, 2) AS avg_confidence, full_text, CAST(len(coalesce(words, [])) AS INTEGER) AS word_count FROM {R._PAGES}")
def round_trip_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Pages written as nested JSON documents and read by their schema."""
    path = _folder(spark)
    writers.write_json(writers.page_documents(R._pages(spark, sf)), path)
    back = spark.read.schema(readers.PAGES).json(path).select("document_name", "total_pages", F.explode("pages").alias("p")).select("document_name", "total_pages", "p.*")
    return back.select("document_name", "total_pages", "page_number", "page_file", "engine", F.round("avg_confidence", 2).alias("avg_confidence"), "full_text", "word_count")


@query(f"{R._ENTITIES_SQL} SELECT CAST(doc AS VARCHAR) AS document_name, {_FIELDS} FROM wide")
def round_trip_extractions(spark: SparkSession, sf: str) -> DataFrame:
    """Extractions with all candidates written as JSON and read by their schema."""
    path = _folder(spark)
    d = X.extract_with_candidates(corpus(spark, sf).select("doc", "text"))
    writers.write_json(d.select(F.col("doc").cast("string").alias("document_name"), F.struct(*rules.FIELDS).alias("extracted_entities"), "all_candidates", "notes"), path)
    return spark.read.schema(readers.EXTRACTION).json(path).select("document_name", "extracted_entities.*")


_LABEL_COLUMNS = ["document_name", "doc_type", "language", "modality", "source", *rules.FIELDS, "notes"]


@query(f"SELECT DISTINCT seed_id, {', '.join(f"coalesce({c}, '') AS {c}" for c in ('filename', 'doc_type', 'language', 'variant', *rules.FIELDS))} FROM seed_record")
def round_trip_labels(spark: SparkSession, sf: str) -> DataFrame:
    """The expected values as a label table: CSV with a header, quotes and empty cells."""
    path = _folder(spark)
    s = table(spark, sf, "seed_record").select("seed_id", "filename", "doc_type", "language", "variant", *rules.FIELDS).distinct()
    rows = s.select(F.col("filename").alias("document_name"), "doc_type", "language", F.col("variant").alias("modality"), F.lit("x").alias("source"), *rules.FIELDS, F.col("seed_id").cast("string").alias("notes"))
    rows.select(*_LABEL_COLUMNS).write.option("header", True).option("quote", '"').option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    back = readers.read_labels(spark, path)
    return back.select(F.col("notes").cast("long").alias("seed_id"), F.col("document_name").alias("filename"), "doc_type", "language", F.col("modality").alias("variant"), *rules.FIELDS)


def _arrived(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as a stream: written where arrivals are read from."""
    path = _folder(spark)
    table(spark, sf, "documents").select(F.col("doc_id").alias("doc"), "text", F.col("received_at").alias("arrived_at")).write.parquet(path)
    return streaming.arrivals(spark, path)


def _drained(spark: SparkSession, stream: DataFrame, mode: str) -> DataFrame:
    """What a stream gives once all that has arrived is read."""
    out = _folder(spark)
    q = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", _folder(spark)).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


@query("SELECT (SELECT count(*) FROM documents) AS documents, count(*) AS with_date FROM (SELECT doc_id FROM documents WHERE regexp_matches(coalesce(text, ''), '\\b(\\d{4})-(\\d{2})-(\\d{2})\\b') AND NOT regexp_matches(text, '[^\\x00-\\x7f](\\d{4})-(\\d{2})-(\\d{2})|(\\d{4})-(\\d{2})-(\\d{2})[^\\x00-\\x7f]'))")
def stream_extraction(spark: SparkSession, sf: str) -> DataFrame:
    """Fields of arriving documents: how many came out, and how many of those that state an ISO date between ASCII letters have a date."""
    fields = _drained(spark, streaming.extracted(_arrived(spark, sf)).select("doc", "date"), "append")
    iso = table(spark, sf, "documents").select(F.col("doc_id").alias("doc"), (F.coalesce("text", F.lit("")).rlike(r"\b(\d{4})-(\d{2})-(\d{2})\b") & ~F.col("text").rlike(r"[^\x00-\x7f](\d{4})-(\d{2})-(\d{2})|(\d{4})-(\d{2})-(\d{2})[^\x00-\x7f]")).alias("iso"))
    return fields.join(iso, "doc").agg(F.count("*").alias("documents"), F.count_if(F.col("iso") & F.col("date").isNotNull()).alias("with_date"))


@query("SELECT strftime(received_at, '%Y-%m-%d') AS start, count(*) AS documents, CAST(sum(length(coalesce(text, ''))) AS BIGINT) AS letters FROM documents WHERE received_at IS NOT NULL GROUP BY 1")
def stream_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Arrivals of every day, complete once the stream is drained."""
    s = _arrived(spark, sf).withColumn("text", F.coalesce("text", F.lit(""))).where("arrived_at is not null")
    name = f"arrivals_{uuid.uuid4().hex}"
    q = streaming.summary(s, late="3650 days", window="1 day").writeStream.format("memory").queryName(name).outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.table(name).withColumn("start", F.date_format("start", "yyyy-MM-dd"))
