import json
from datetime import datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F

from millsheet import streaming
from millsheet.operators import extract as X
from millsheet.operators import providers
from millsheet.sources import readers, writers


def _pages(spark):
    rows = [("d", 2, "d_p02.png", "tesseract", 60.0, "zwei", [("zwei", 60.0, [1, 2, 3, 4])]), ("d", 1, "d_p01.png", "tesseract", 88.85, "eins", []), ("e", 1, "e.png", "paddleocr", 0.0, None, None)]
    return spark.createDataFrame(rows, f"document_name string, page_number int, page_file string, engine string, avg_confidence double, full_text string, words {readers.WORDS}")


def test_pages_round_trip(spark, tmp_path):
    p = str(tmp_path / "pages")
    writers.write_json(writers.page_documents(_pages(spark)), p)
    back = readers.read_page_documents(spark, p + "/*.json") if False else spark.read.schema(readers.PAGES).json(p)
    flat = back.select("document_name", "total_pages", F.explode("pages").alias("p")).select("document_name", "total_pages", "p.*")
    assert {(r.document_name, r.page_number, r.full_text, r.word_count) for r in flat.collect()} == {("d", 1, "eins", 0), ("d", 2, "zwei", 1), ("e", 1, None, 0)}
    assert {r.document_name: r.text for r in readers.document_texts(flat).collect()} == {"d": "eins\n\nzwei", "e": ""}
    text = {r.document_name: r.value for r in writers.page_text(_pages(spark)).collect()}["d"]
    assert text.startswith("# OCR Results: d\n# Total pages: 2\n\n" + "=" * 80 + "\nPage 1: d_p01.png\nEngine: tesseract\nConfidence: 88.8%\nWords: 0\n")


def test_extraction_round_trip(spark, tmp_path):
    d = spark.createDataFrame([(1, "Supplier\nA SARL\nWO-12 and WPS-77"), (2, "")], "doc long, text string")
    p = str(tmp_path / "x")
    writers.write_json(writers.extraction_documents(X.extract(d), X.candidates(d)), p)
    rows = {r.document_name: r for r in spark.read.schema(readers.EXTRACTION).json(p).collect()}
    assert rows["1"].extracted_entities.project_id == "WO-12"
    assert [c.value for c in rows["1"].all_candidates if c.field == "project_id"] == ["WO-12", "WPS-77"]
    raw = [json.loads(r[0]) for r in spark.read.text(p).collect()]
    assert all(set(x["extracted_entities"]) == {"project_id", "supplier", "material", "quantity", "date"} for x in raw)
    assert rows["2"].all_candidates == []


def test_labels_csv(spark, tmp_path):
    (tmp_path / "l.csv").write_text('document_name,doc_type,language,modality,source,project_id,supplier,material,quantity,date,notes\na.pdf,Invoice,FR,digital,synthetic,,"Nord, Sud SA",x,1 kg,2020-01-01,"he said ""no"""\n', encoding="utf-8")
    r = readers.read_labels(spark, str(tmp_path / "l.csv")).first()
    assert (r.supplier, r.project_id, r.notes) == ("Nord, Sud SA", "", 'he said "no"')


def test_files(spark, tmp_path):
    for f in ("used/a.pdf", "extra/a.pdf", "extra/b.pdf", "runs/pipeline_run_1.json", "runs/pipeline_run_2.json", "img/x_p1_p01.png", "img/x_p1_p02.png", "img/solo.png"):
        (tmp_path / f).parent.mkdir(exist_ok=True)
        (tmp_path / f).write_bytes(b"x")
    files = readers.list_files(spark, [str(tmp_path / "used"), str(tmp_path / "extra")], "*.pdf")
    names = spark.createDataFrame([("a.pdf",), ("b.pdf",), ("c.pdf",)], "document_name string")
    got = {r.document_name: r.path for r in readers.resolve(names, files).collect()}
    assert "/used/a.pdf" in got["a.pdf"]
    assert "/extra/b.pdf" in got["b.pdf"]
    assert got["c.pdf"] is None
    assert readers.latest_run_file(readers.list_files(spark, [str(tmp_path / "runs")])).first().path.endswith("pipeline_run_2.json")
    g = {r.document_name: r.page_files for r in readers.group_page_files(readers.list_files(spark, [str(tmp_path / "img")])).collect()}
    assert g == {"x_p1": ["x_p1_p01.png", "x_p1_p02.png"], "solo": ["solo.png"]}
    out = str(tmp_path / "parted")
    used = spark.createDataFrame([("a.pdf",)], "file string")
    for _ in range(2):
        writers.write_by_use(files.select("file").distinct(), used, out)
    assert sorted((r.file, r.use) for r in spark.read.parquet(out).collect()) == [("a.pdf", "used"), ("b.pdf", "extra")]


def test_providers(spark):
    def first(pages: pd.DataFrame) -> pd.Series:
        if (pages.page_number == 3).any() or len(pages) > 1:
            raise ValueError("unreadable")
        return pd.Series([[{"text": "w", "confidence": 90.0 if n == 1 else 30.0, "bbox": [0, 0, 1, 1]}] for n in pages.page_number])

    def second(pages: pd.DataFrame) -> pd.Series:
        return pd.Series([[{"text": "v", "confidence": 20.0, "bbox": [0, 0, 1, 1]}] if n == 2 else None for n in pages.page_number])

    pages = spark.createDataFrame([("d", i, b"x") for i in (1, 2, 3)], "document_name string, page_number int, content binary").coalesce(1)
    with pytest.raises(LookupError):
        providers.provide(pages, "render")
    providers.register_provider("ocr", first)
    providers.register_provider("ocr_fallback", second)
    got = {r.page_number: (r.engine, r.avg_confidence, r.full_text) for r in providers.read_pages(pages).collect()}
    assert got == {1: ("tesseract", 90.0, "w"), 2: ("paddleocr", 20.0, "v"), 3: ("tesseract", 0.0, "")}


def test_streaming(spark, tmp_path):
    src = str(tmp_path / "in")
    rows = [(i, f"Supplier\nA SARL\nWO-{100 + i}", datetime(2025, 1, 1, 0, i)) for i in range(12)]
    spark.createDataFrame(rows, streaming.ARRIVALS).coalesce(1).write.parquet(src)
    s = streaming.arrivals(spark, src)
    q = streaming.extracted(s).writeStream.format("memory").queryName("got").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    assert {r.project_id for r in spark.table("got").collect()} == {f"WO-{100 + i}" for i in range(12)}
    q = streaming.summary(s).writeStream.format("memory").queryName("sums").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(r.documents for r in spark.table("sums").collect()) == [2, 5, 5]
