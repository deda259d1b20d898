import random

from pyspark.sql import functions as F

from millsheet.functions import rules
from millsheet.operators import columnar
from millsheet.operators import extract as X
from millsheet.plans import artifacts

_PIECES = [
    *rules.SUPPLIER_TRIGGERS, *rules.CORPORATE_SUFFIXES, *rules.MATERIAL_TRIGGERS, *rules.QUANTITY_TRIGGERS, *rules.DATE_TRIGGERS, "Customer", "Certificate No. 134822", "certif. 1234567", "EXP 1390198", "PRJ-1234", "wo 99", "WPS-77-R2", "Ref: AB-123",
    "AWS A5.9  ER316L", "SS 316L", "304L", "S355J2+N", "1.4307", "A106 Gr. B", "6061-t6", "Duplex 2205", "Carbon  Steel", "PVC Sch\t80", "5 kg", "400,5 Kgs.", "12 m", "2024-01-31", "2013.11.05", "03.04.21", "3/4/2021", "Mar 29, 2025", "3 mars 24", "date 1/2/99", "Acme", "Nord",
]


def _texts():
    r = random.Random(3)
    plain = [[w for w in _PIECES if w.isascii()], [" ", " ", "\n", "\n", ": ", "  ", "\t", "\r\n", "-", ""]]
    odd = [[*_PIECES, "é", "m²", "ſ", "İ", "K", "\x1c", "\x0b", "\x01", "\x00", "😀", "́"], [*plain[1], "\xa0", "\x85", "\x01"]]
    made = ["".join(r.choice(x) for _ in range(r.randint(0, 40)) for x in (odd if i % 2 else plain)) for i in range(600)]
    return [*made, "", None, "a" * 20000 + " 12 kg", "\n".join(["Supplier", "Foo SA", "x"] * 40), "Date " + "1/2/2020 " * 30, "12 kg\n" * 50, "\n" * 40, "SA", "de\nSA", "12 kgx 12 kg"]


def _rows(df):
    return sorted(map(tuple, df.select("doc", "position", "field", "value", "confidence", "source", "raw_text").collect()))


def test_batches_find_what_expressions_find(spark):
    d = spark.createDataFrame(list(enumerate(_texts())), "doc long, text string").repartition(3).cache()
    want = d.select("doc", F.posexplode(F.expr(X.everything("coalesce(text, '')"))).alias("position", "c")).select("doc", "position", "c.*")
    got = _rows(columnar.candidates(d))
    assert got == _rows(want)
    assert len({r[0] for r in got}) > 500


def test_batches_of_one_kind_or_none(spark):
    for texts in ([], ["no rule"], ["é"], ["Fournisseur é\nNord SA"], ["12 kg"] * 3):
        d = spark.createDataFrame(list(enumerate(texts)), "doc int, text string").coalesce(1)
        got = _rows(columnar.candidates(d))
        assert [r[3] for r in got] == {"F": ["Nord SA"] * 2, "1": ["12 kg"] * 3}.get("".join(texts)[:1], [])


def test_query_evaluates_no_rule_twice(spark, tmp_path):
    spark.sql("SELECT 1L AS o_orderkey, timestamp'2020-01-02' AS o_orderdate").write.parquet(f"{tmp_path}/orders.parquet")
    plan = artifacts.extraction_documents(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    # a filter on the number of candidates would need them all once more
    assert "MapInArrow" in plan and "Filter" not in plan
