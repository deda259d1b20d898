"""Deeply nested run summaries turned into related flat tables in one pass.

A depth-first visitor walks every complete delivery once, where it stands, and emits rows of four kinds, each with its table
tag, primary key, parent key and payload (JSON): ``run``, ``document``, ``page`` and ``entity``. The rows are written
partitioned by tag, and each tag is read back with the schema of its table, so a table is read without touching the others.
Which delivery of a run counts is decided on the narrow run rows; rows of others are left out by a join with these. So no
payload is shuffled.

Cases: of a run's deliveries the latest that is complete JSON counts (JSON inside a JSON string is opened); runs without
one have no row; documents may be a list or an object keyed by name, runs may be wrapped; missing or null parts give
null columns; entries of a page list that are null still count; nested parts of unexpected kinds are kept as payload.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millsheet.session import cut, work_folder

#: Payload schemas by tag.
SCHEMAS = {
    "run": "timestamp string, total_documents long, successful long, failed long, avg_ocr_confidence double, total_pages_processed long",
    "document": "run_id string, document_name string, source_path string, success string, preprocessing string, ocr string, extraction string, page_count long, avg_ocr_confidence double, total_text_length long, project_id string, supplier string, material string, quantity string, date string, error_stage string, error_message string, pages int",
    "page": "page_pos int, page_file string, page_number long",
    "entity": "field string, value string",
}
#: Rows of all tags; ``document`` and ``delivery`` are the place of the document in the run and the delivery they come from, which are short
#: forms of the keys; number and time of the delivery are those of run rows only.
TAGGED = "tag string, pk string, parent string, payload string, document int, delivery long, delivery_no long, received long"
_ARROW = pa.schema([("tag", pa.string()), ("pk", pa.string()), ("parent", pa.string()), ("payload", pa.string()), ("document", pa.int32()), ("delivery", pa.int64()), ("delivery_no", pa.int64()), ("received", pa.int64())])


def _text(x: Any) -> str | None:
    if x is None or isinstance(x, str):
        return x
    if isinstance(x, dict):
        return next((_text(x[k]) for k in ("name", "value", "text") if x.get(k) is not None), None)
    return json.dumps(x, ensure_ascii=False)


def _flag(x: Any) -> str | None:
    s = str(x).strip().lower() if x is not None else ""
    if s in ("true", "1", "1.0", "yes", "y", "ok", "oui", "done", "success"):
        return "true"
    return "false" if s in ("false", "0", "0.0", "no", "n", "ko", "non", "failed") else None


def _whole(x: Any) -> int | None:
    if isinstance(x, bool) or x is None or isinstance(x, (dict, list)):
        return None
    try:
        return int(float(x))
    except (ValueError, OverflowError):
        return None


def _real(x: Any) -> float | None:
    try:
        return None if x is None or isinstance(x, bool) else float(x)
    except (TypeError, ValueError):
        return None


def _named(x: Any, key: str, value: str) -> dict[str, Any]:
    """An object, given as one or as a list of entries with name and value."""
    if isinstance(x, dict):
        return x
    if isinstance(x, list):
        return {str(e.get(key)): e.get(value) for e in x if isinstance(e, dict)}
    return {}


def opened(payload: str | None) -> dict[str, Any] | None:
    """The run of a payload, None if it is cut off or no object."""
    x: Any = payload
    for _ in range(3):
        if not isinstance(x, str):
            break
        try:
            x = json.loads(x)
        except (ValueError, RecursionError):
            return None
    return x if isinstance(x, dict) else None


def visit(run_id: str, run: dict[str, Any], delivery: int = 0) -> Iterator[tuple[str, str, str | None, str, int | None]]:
    """Depth first: (tag, primary key, parent key, payload, place of the document) of a run and all below it, as one of its deliveries says."""
    body = run["run"] if isinstance(run.get("run"), dict) else run
    header = body["header"] if isinstance(body.get("header"), dict) else body
    dump = lambda **x: json.dumps(x, ensure_ascii=False)
    yield "run", run_id, None, dump(timestamp=_text(header.get("timestamp")), avg_ocr_confidence=_real(header.get("avg_ocr_confidence")), **{k: _whole(header.get(k)) for k in ("total_documents", "successful", "failed", "total_pages_processed")}), None
    documents = body.get("documents", run.get("documents"))
    entries = list(documents.items()) if isinstance(documents, dict) else [(None, d) for d in documents] if isinstance(documents, list) else []
    for i, (name, d) in enumerate(entries):
        if not isinstance(d, dict):
            continue
        key = f"{run_id}/{delivery}/{i}"
        stages, fields = _named(d.get("stages"), "name", "ok"), d.get("extracted_entities")
        fields = _named(fields, "field", "value")
        outputs = d["outputs"] if isinstance(d.get("outputs"), dict) else {}
        error = d["error"] if isinstance(d.get("error"), dict) else {}
        pages = outputs.get("preprocessed_pages", outputs.get("pages"))
        pages = pages if isinstance(pages, list) else []
        yield "document", key, run_id, dump(
            run_id=run_id, document_name=_text(d.get("document_name", name)), source_path=_text(d.get("source_path")), success=_flag(d.get("success")),
            **{k: _flag(v.get("ok") if isinstance(v := stages.get(k), dict) else v) for k in ("preprocessing", "ocr", "extraction")},
            page_count=_whole(outputs.get("page_count")), avg_ocr_confidence=_real(outputs.get("avg_ocr_confidence")), total_text_length=_whole(outputs.get("total_text_length")),
            **{k: _text(fields.get(k)) for k in ("project_id", "supplier", "material", "quantity", "date")}, error_stage=_text(error.get("stage")), error_message=_text(error.get("message")), pages=len(pages),
        ), i
        for k, p in enumerate(pages):
            at = p if isinstance(p, dict) else {}
            yield "page", f"{key}/p{k}", key, dump(page_pos=k, page_file=_text(at.get("file", at.get("path")) if at else p), page_number=_whole(at.get("page", at.get("page_number")))), i
        for k, v in fields.items():
            if v is not None:
                yield "entity", f"{key}/{k}", key, dump(field=str(k), value=_text(v)), i


def _emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out: list[tuple] = []
    for b in batches:
        for run_id, payload, delivery, no, received in zip(*(b.column(c).to_pylist() for c in ("run_id", "payload", "delivery", "delivery_no", "received"))):
            if (run := opened(payload)) is None:
                continue
            for row in visit(run_id, run, delivery):
                out.append((*row, delivery, no, received) if row[0] == "run" else (*row, delivery, None, None))
                if len(out) >= 5000:
                    yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), _ARROW)], schema=_ARROW)
                    out.clear()
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), _ARROW)], schema=_ARROW)


def tagged(deliveries: DataFrame) -> DataFrame:
    """The tagged rows of all complete deliveries in ``deliveries`` (run_id, delivery_no, received_at, payload)."""
    rows = deliveries.where(F.col("run_id").isNotNull() & F.col("payload").isNotNull())
    return rows.select("run_id", "payload", F.monotonically_increasing_id().alias("delivery"), F.col("delivery_no").cast("long").alias("delivery_no"), F.unix_micros("received_at").alias("received")).mapInArrow(_emit, TAGGED)


def write_tagged(rows: DataFrame, path: str) -> None:
    """Write tagged rows partitioned by tag."""
    rows.write.partitionBy("tag").parquet(path)


def _raw(spark, path: str, tag: str) -> DataFrame:  # noqa: ANN001
    return spark.read.schema(f"{TAGGED.partition(', ')[2]}, tag string").option("basePath", path).parquet(path).where(F.col("tag") == tag)


def _latest(spark, path: str) -> DataFrame:  # noqa: ANN001
    """The deliveries that count, of each run that of the highest number, then the latest; written, so that it is joined by its real size."""
    place = F.struct("delivery_no", "received", "delivery")
    return cut(_raw(spark, path, "run").groupBy("pk").agg(F.max(place)["delivery"].alias("delivery")).select("delivery"))


def read_tag(spark, path: str, tag: str, latest: DataFrame | None = None) -> DataFrame:  # noqa: ANN001
    """One flat table of the written rows: pk, parent and the columns of its schema, of the deliveries that count (``latest``, if it is at hand)."""
    latest = _latest(spark, path) if latest is None else latest
    # parsed before the join, so that only the columns that are asked for are shuffled
    rows = _raw(spark, path, tag).select("pk", "parent", "delivery", F.from_json("payload", SCHEMAS[tag]).alias("x"))
    return rows.join(latest, "delivery", "left_semi").select("pk", "parent", "x.*")


def _written(deliveries: DataFrame) -> str:
    """The folder of the tagged rows, written in one pass to the application's folder."""
    path = f"{work_folder(deliveries.sparkSession)}/tags-{uuid.uuid4().hex}"
    write_tagged(tagged(deliveries), path)
    return path


def flat_tables(deliveries: DataFrame) -> dict[str, DataFrame]:
    """All flat tables."""
    spark, path = deliveries.sparkSession, _written(deliveries)
    latest = _latest(spark, path)
    return {t: read_tag(spark, path, t, latest) for t in SCHEMAS}


def page_rows(deliveries: DataFrame) -> DataFrame:
    """One row per page of each document of each run, with the document's facts; position -1 where it has no page."""
    spark, path = deliveries.sparkSession, _written(deliveries)
    facts = F.from_json("payload", "run_id string, document_name string, ocr string, supplier string, page_count long").alias("x")
    d = _raw(spark, path, "document").join(_latest(spark, path), "delivery", "left_semi").select("delivery", "document", facts).select(
        "delivery", "document", "x.run_id", F.coalesce("x.document_name", F.lit("")).alias("document_name"), F.coalesce("x.ocr", F.lit("")).alias("ocr"), F.coalesce("x.supplier", F.lit("")).alias("supplier_name"), F.coalesce("x.page_count", F.lit(-1).cast("long")).alias("page_count")
    )
    # the join with the documents leaves out the pages of other deliveries
    p = _raw(spark, path, "page").select("delivery", "document", F.from_json("payload", "page_pos int")["page_pos"].alias("page_pos"))
    return d.join(p, ["delivery", "document"], "left").select("run_id", "document_name", F.coalesce("page_pos", F.lit(-1)).cast("int").alias("page_pos"), "ocr", "supplier_name", "page_count")
