import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from millsheet.functions import pages as P
from millsheet.functions import rules
from millsheet.operators import extract as X
from millsheet.operators import providers, runs, score, udtf
from millsheet.session import shared_folder
from millsheet.sources import writers
from tests.test_extract import TEXTS

REPORT = "document_name string, source_path string, preprocessing string, unknown string, ocr string, extraction string, page_count int, confidence double, text_length int, " + ", ".join(f"{f} string" for f in rules.FIELDS)


def _reports(spark):
    fields = ["P", "S", "M", "Q", "D"]
    rows = [
        ("a", "/a.pdf", None, None, None, None, 2, 81.256, 10, *fields), ("b", None, None, None, None, None, 2, 80.0, 10, *fields), ("c", "/c.pdf", "broken", None, None, None, 2, 80.0, 10, *fields),
        ("d", "/d.pdf", None, None, "no engine", None, 3, 80.0, 10, *fields), ("e", "/e.pdf", None, None, None, "stuck", 1, 60.0, 10, *fields), ("f", "/f.pdf", None, "boom", None, None, 1, 60.0, 10, *fields),
    ]
    return runs.reports(spark.createDataFrame(rows, REPORT))


def test_reports_and_exit_status(spark):
    r = {x.document_name: x for x in _reports(spark).collect()}
    assert {k: (x.error_stage, x.error_message) for k, x in r.items()} == {"a": (None, None), "b": ("preprocessing", "source file not found"), "c": ("preprocessing", "broken"), "d": ("ocr", "no engine"), "e": ("extraction", "stuck"), "f": ("unknown", "boom")}
    assert (r["b"].source_path, r["b"].page_count, r["d"].page_count, r["d"].avg_ocr_confidence, r["e"].avg_ocr_confidence, r["e"].supplier) == ("(not found)", 0, 3, 0.0, 60.0, None)
    assert (r["a"].avg_ocr_confidence, r["a"].supplier) == (81.26, "S")
    t = runs.run_totals(_reports(spark)).first()
    assert (t.total_documents, t.successful, t.failed, tuple(t.stage_failures), t.avg_ocr_confidence) == (6, 1, 5, (2, 1, 1), 70.63)
    assert runs.exit_status(_reports(spark)).first().status == 2
    assert runs.exit_status(_reports(spark).where("success")).first().status == 0
    assert runs.exit_status(_reports(spark).limit(0)).first().status == 0


def test_summary_document(spark, tmp_path):
    writers.write_json(runs.summary_document(_reports(spark), "2026-01-01T00:00:00"), str(tmp_path / "s"))
    (line,) = (r[0] for r in spark.read.text(str(tmp_path / "s")).collect())
    x = json.loads(line)
    assert (x["timestamp"], x["stage_failures"]["preprocessing"], len(x["documents"])) == ("2026-01-01T00:00:00", 2, 6)
    assert x["documents"][0]["extracted_entities"]["supplier"] == "S"
    assert x["documents"][1]["extracted_entities"] is None
    assert x["documents"][1]["error"] == {"stage": "preprocessing", "message": "source file not found"}


#: Published scores of 20 documents, fixed values: field, tp, fp, fn, precision, recall, f1.
SCORES = [("project_id", 11, 1, 9, 0.9167, 0.55, 0.6875), ("supplier", 7, 9, 13, 0.4375, 0.35, 0.3889), ("material", 9, 9, 11, 0.5, 0.45, 0.4737), ("quantity", 10, 4, 10, 0.7143, 0.5, 0.5882), ("date", 11, 5, 9, 0.6875, 0.55, 0.6111)]
MACRO = {"precision": 0.6512, "recall": 0.48, "f1": 0.5499}


def _published(spark):
    rows = [(f"d{i:02d}", f, "OK" if i < tp else "WRONG" if i < tp + fp else "MISS", True) for f, tp, fp, _, *_ in SCORES for i in range(20)]
    return spark.createDataFrame(rows, "doc string, field string, outcome string, has_label boolean")


def test_published_scores(spark):
    o = _published(spark)
    got = {r.field: (r.tp, r.fp, r.fn, round(r.precision, 4), round(r.recall, 4), round(r.f1, 4)) for r in score.scores(o).collect()}
    assert got == {f: tuple(x) for f, *x in SCORES}
    m = {(r["name"], r.measure): round(r.value, 4) for r in runs.metrics(o).where("section = 'macro'").collect()}
    assert m == {("macro", k): v for k, v in MACRO.items()}
    assert {r.outcome: r["count"] for r in o.groupBy("outcome").count().collect()} == {"OK": 48, "WRONG": 28, "MISS": 24}


def test_metrics_document(spark, tmp_path):
    o = _published(spark)
    per_doc = o.groupBy("doc").pivot("field", rules.FIELDS).agg(F.first("outcome"))
    writers.write_json(writers.metrics_document(runs.metrics(o), per_doc), str(tmp_path / "m"))
    (line,) = (r[0] for r in spark.read.text(str(tmp_path / "m")).collect())
    x = json.loads(line)
    assert round(x["per_entity"]["date"]["f1"], 4) == 0.6111
    assert round(x["macro"]["f1"], 4) == 0.5499
    assert [d["doc"] for d in x["per_doc"]] == [f"d{i:02d}" for i in range(20)]


def test_accumulated_confidence_of_two_equal_dates(spark):
    d = spark.createDataFrame([(1, "Date: 12/03/2024\nDate: 12/03/2024")], "doc long, text string")
    assert [c.confidence for c in X.extract_with_candidates(d).first().all_candidates if c.field == "date"] == [0.9, 1.0]


def test_long_documents_cost_in_proportion(spark):
    text = "\n".join(f"Supplier\nNordhall {i} SARL\n{i % 900 + 1} kg on 2024-01-{i % 28 + 1:02d} date {i % 28 + 1}.02.2023\nMaterial: 304L" for i in range(25_000))
    (r,) = X.extract(spark.createDataFrame([(1, text)], "doc long, text string")).collect()
    assert (r.supplier, r.material, r.quantity, r.date) == ("Nordhall 0 SARL", "304L", "1 kg", "01/02/2023")


def test_table_function_equals_the_native_rules(spark):
    d = spark.createDataFrame(list(enumerate(TEXTS)), "doc long, text string")
    udtf.register(spark)
    got = {}
    for r in spark.sql("SELECT doc, c.* FROM {d}, LATERAL extract_candidates(text) c", d=d).collect():
        got.setdefault(r.doc, []).append((r.field, r.value, round(r.confidence, 6), r.source, r.raw_text))
    want = {}
    for r in X.candidates(d).collect():
        want.setdefault(r.doc, []).append((rules.FIELDS.index(r.field), r.ord, (r.field, r.value, round(r.confidence, 6), r.source, r.raw_text)))
    assert got == {k: [x for _, _, x in sorted(v)] for k, v in want.items()}


def test_selection_and_expected_values(spark):
    d = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "row_no long, name string")
    assert [r.name for r in runs.first_rows(d, 2, "row_no").collect()] == ["a", "b"]
    assert runs.first_rows(d, 0, "row_no").count() == runs.first_rows(d, None, "row_no").count() == 3
    rows = [(2, "x.pdf", "second"), (1, "x.pdf", "first"), (3, None, "none")]
    assert [tuple(r) for r in runs.first_match(spark.createDataFrame(rows, "seed_id long, filename string, v string"), "filename", "seed_id").collect()] == [("x.pdf", 1, "first")]
    e = spark.createDataFrame([("a.pdf",), ("A.PDF",), ("a.png",), (None,)], "f string").select(runs.input_error(F.col("f"))).collect()
    assert [r[0] for r in e] == [None, None, "only PDF files are read: a.png", "only PDF files are read: "]


@pytest.mark.parametrize(("head", "size", "kind", "fetched"), [("ffd8ff", 600, "jpeg", "ok"), ("89504e470d0a1a0a", 600, "png", "ok"), ("474946383761", 600, "gif", "ok"), ("474946383978", 600, None, "no image"), ("524946460000000057454250", 511, "webp", "too small"), ("524946460000000057415645", 600, None, "no image"), ("ffd8ff", 49, None, "too small")])
def test_image_checks(spark, head, size, kind, fetched):
    c = spark.createDataFrame([(bytes.fromhex(head).ljust(size, b"x"),)], "c binary")
    assert tuple(c.select(P.image_type(F.col("c")), P.image_check(F.col("c"))).first()) == (kind, fetched)


@pytest.mark.parametrize(("content", "fetched", "present"), [(b"%PDF-".ljust(1023), "too small", False), (b"%PDF-".ljust(1024), "ok", False), (b"%PDF-".ljust(1025), "ok", True), (b"<html".ljust(2000), "no PDF", False)])
def test_pdf_checks(spark, content, fetched, present):
    c = spark.createDataFrame([(content,)], "c binary")
    assert tuple(c.select(P.pdf_check(F.col("c")), P.pdf_present(F.col("c"))).first()) == (fetched, present)


def test_routing_and_page_files(spark, tmp_path):
    def mark(kind):
        return lambda pages: pd.Series([kind.encode() + bytes(c) for c in pages.content])

    providers.register_provider("clean", mark("c"))
    providers.register_provider("gray", mark("g"))
    pages = spark.createDataFrame([("a.pdf", 1, b"1", "scanned"), ("a.pdf", 2, b"2", " Scanned"), ("b.pdf", 1, b"3", "digital"), ("b.pdf", 12, b"4", None)], "document_name string, page_number int, content binary, modality string")
    done = providers.preprocess(pages)
    seen = {(r.document_name, r.page_number): bytes(r.content) for r in done.collect()}
    assert seen == {("a.pdf", 1): b"c1", ("a.pdf", 2): b"c2", ("b.pdf", 1): b"g3", ("b.pdf", 12): b"g4"}
    writers.write_page_files(done, str(tmp_path))
    assert {p.name: p.read_bytes() for p in tmp_path.iterdir()} == {"a_p01.png": b"c1", "a_p02.png": b"c2", "b_p01.png": b"g3", "b_p12.png": b"g4"}


def test_text_layer(spark):
    layer = [("  Wort ", 1.9, 2.2, 10.1, 12.0), (" ", 0.0, 0.0, 1.0, 1.0)]
    d = spark.createDataFrame([("x.pdf", 1, " Text \n", layer), ("x.pdf", 2, None, None)], "document_name string, page_number int, text string, layer array<struct<text: string, x0: double, y0: double, x1: double, y1: double>>")
    a, b = providers.text_layer_pages(d).orderBy("page_number").collect()
    assert (a.page_file, a.full_text, a.avg_confidence, [(w.text, w.confidence, w.bbox) for w in a.words]) == ("x_p01.pdf-text", "Text", 100.0, [("Wort", 100.0, [1, 2, 8, 9])])
    assert (b.page_file, b.full_text, b.words, b.avg_confidence) == ("x_p02.pdf-text", "", [], 0.0)


class _Cluster:
    """A session of a cluster that names no shared folder."""

    class conf:  # noqa: N801
        @staticmethod
        def get(key, default=None):
            return default

    class sparkContext:  # noqa: N801
        master = "spark://host:7077"

        @staticmethod
        def getConf():
            return _Cluster.conf


def test_a_cluster_needs_a_shared_folder(spark):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(_Cluster)
    _Cluster.sparkContext.master = "local[4]"
    assert shared_folder(_Cluster)
