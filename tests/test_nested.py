import json
from datetime import datetime

from millsheet.operators.nested import SCHEMAS, flat_tables, page_rows, tagged

SCHEMA = "run_id string, delivery_no int, received_at timestamp, payload string, tag string"
T = datetime(2025, 1, 1)


def _doc(name, **x):
    return {"document_name": name, **x}


def _runs(spark):
    a1 = json.dumps({"timestamp": "t", "documents": [_doc("old")]})
    a2 = json.dumps(json.dumps({"run": {"header": {"timestamp": "t", "total_documents": "2"}, "documents": [
        _doc("d1", stages=[{"name": "ocr", "ok": 1}], outputs={"page_count": "3", "preprocessed_pages": ["a.png", {"file": "b.png", "page": 2}, None]}, extracted_entities={"supplier": {"name": "X é"}}),
        _doc("d2", stages=None, outputs=None, extracted_entities=None), None, 7]}}))
    b = json.dumps({"documents": {"k1": {"stages": {"ocr": "false"}, "outputs": {"page_count": None, "preprocessed_pages": []}}}})
    rows = [("A", 1, T, a1, "x"), ("A", 2, T, a2, "x"), ("A", 3, T, a2[: len(a2) // 2], "x"), ("A", 2, T, a2, "x"), ("B", 1, T, b, "x"), ("C", 1, T, "{", None), ("D", 1, T, None, None), (None, 1, T, b, None), ("E", 1, None, "{}", None)]
    return spark.createDataFrame(rows, SCHEMA)


def test_pages(spark):
    got = {(r.run_id, r.document_name, r.page_pos): (r.ocr, r.supplier_name, r.page_count) for r in page_rows(_runs(spark)).collect()}
    assert got == {("A", "d1", 0): ("true", "X é", 3), ("A", "d1", 1): ("true", "X é", 3), ("A", "d1", 2): ("true", "X é", 3), ("A", "d2", -1): ("", "", -1), ("B", "k1", -1): ("false", "", -1)}


def test_links(spark):
    t = {k: d.collect() for k, d in flat_tables(_runs(spark)).items()}
    assert {r.pk for r in t["run"]} == {"A", "B", "E"}
    assert {r.parent for r in t["document"]} <= {r.pk for r in t["run"]}
    assert {r.parent for r in t["page"]} | {r.parent for r in t["entity"]} <= {r.pk for r in t["document"]}
    assert t["run"][0].total_documents in (2, None)
    assert set(t) == set(SCHEMAS)


def test_the_delivery_that_counts(spark):
    doc = lambda n: json.dumps({"documents": [_doc(n, outputs={"preprocessed_pages": ["p"]})]})
    rows = [("A", None, T, doc("no number"), None), ("A", 1, None, doc("first"), None), ("B", 1, datetime(2025, 1, 2), doc("late"), None), ("B", 1, T, doc("early"), None), ("B", 1, None, doc("no time"), None), ("C", 3, T, doc("again"), None), ("C", 3, T, doc("again"), None), ("C", 4, T, doc("cut")[:-2], None)]
    d = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert sorted((r.run_id, r.document_name, r.page_pos) for r in page_rows(d).collect()) == [("A", "first", 0), ("B", "late", 0), ("C", "again", 0)]
    t = flat_tables(d)
    assert {k: x.count() for k, x in t.items()} == {"run": 3, "document": 3, "page": 3, "entity": 0}
    plan = tagged(d)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1  # the test's own


def test_empty_and_hot(spark):
    assert page_rows(spark.createDataFrame([], SCHEMA)).count() == 0
    assert tagged(spark.createDataFrame([], SCHEMA)).count() == 0
    big = json.dumps({"documents": [_doc(f"d{i}", outputs={"preprocessed_pages": ["p"] * 3}) for i in range(3000)]})
    assert page_rows(spark.createDataFrame([("R", 1, T, big, None)], SCHEMA)).count() == 9000
