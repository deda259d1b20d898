import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from millsheet.functions import rules
from millsheet.functions.text import eval_normalize, find_all, one_decimal
from millsheet.operators import extract as X
from millsheet.operators import score as S

TEXTS = [
    "Certificat n° 134822\nFournisseur\nAcier Nord SARL\nNuance : 304L / 1.4307\nPoids net : 400,5 Kgs.\nDate d'émission 23.05.2019 et 24.05.2019",
    "Supplier: Foo-Bar Industries\nEXP1390198\nfiller AWS A5.9 ER316L, issue date 2013.11.05\nWeight 400 Kgs.",
    "WO-98154 PVC Sch 80 287 pcs 18/03/2024 WPS-77-R2 Mar 29, 2025 le 3 août 24",
    "Customer Watanabe Trading Co. Ltd\nfrom Big Steel Mills Inc.x\n\n\nDate 31/02/2024, 26.09.18",
    "😀😀 5 kg\t7 mm 12 m\nÉMIS PAR\n  ACME GmbH  \n",
    "",
    "a" * 20000 + " 12 kg",
]


def _python(text):
    """The same rules with Python's ``re``, straight from their definition."""
    out = []
    for p, c, s in rules.PROJECT_ID:
        for m in re.finditer(p, text, re.I):
            v = (m.group(1) if m.lastindex else m.group(0)).strip().upper()
            if not re.fullmatch(r"\d{4}", v) and len(v) <= 15:
                out.append(("project_id", v, c, s))
    lines = text.split("\n")
    for i, line in enumerate(lines):
        for t in rules.SUPPLIER_TRIGGERS:
            for near in lines[i : i + 3] if t in line.lower() else []:
                near = near.strip()
                if near.lower() != t and len(near) >= 3 and any(x in near for x in rules.CORPORATE_SUFFIXES):
                    out.append(("supplier", re.sub(r"\s+", " ", near), 0.8, f"trigger_{t}"))
    head = " ".join(lines[: max(5, len(lines) // 5)])
    for x in rules.CORPORATE_SUFFIXES:
        for m in re.finditer(rf"\b([A-Z][A-Za-z\s,\.&-]+{re.escape(x)}\.?)\b", head):
            v = re.sub(r"\s+", " ", m[1].strip())
            if not any(w in v.lower() for w in rules.NOT_A_SUPPLIER):
                out.append(("supplier", v, 0.6, "letterhead"))
    for p, c, s in rules.MATERIAL:
        out += [("material", re.sub(r"\s+", " ", m[0].strip()), c, s) for m in re.finditer(p, text, re.I)]
    for line in lines:
        for t in rules.MATERIAL_TRIGGERS:
            parts = re.split(r"[:=-]", line, maxsplit=1)
            if t in line.lower() and len(parts) == 2:
                v = re.split(r"[,;\n]", parts[1].strip())[0].strip()
                if 2 < len(v) < 100:
                    out.append(("material", v, 0.7, f"trigger_{t}"))
    for m in re.finditer(rules.QUANTITY, text, re.I):
        ctx = text[max(0, m.start() - 50) : m.end()].lower()
        t = next((t for t in rules.QUANTITY_TRIGGERS if t in ctx), None)
        out.append(("quantity", f"{m[1].replace(',', '.')} {m[2].lower()}", 0.85 if t else 0.7, f"trigger_{t}" if t else "pattern"))
    for p, c, s in rules.DATE:
        for m in re.finditer(p, text, re.I):
            if any(t in text[max(0, m.start() - 30) : m.end()].lower() for t in rules.DATE_TRIGGERS):
                c = min(c + 0.1, 1.0)
            g = m.groups()
            d, mo, y = {"iso": (2, 1, 0), "iso_dot": (2, 1, 0), "en_textual": (1, 0, 2)}.get(s, (0, 1, 2))
            month = int(g[mo]) if g[mo].isdigit() else rules.MONTHS.get(g[mo].lower()[: 3 if s == "en_textual" else 4], 1)
            year = int(g[y])
            year += 2000 if year < 50 else 1900 if year < 100 else 0
            out.append(("date", f"{int(g[d]):02d}/{month:02d}/{year:04d}", c, s))
    return out


def _first_best(cands, field):
    seen = {}
    for f, v, c, _ in cands:
        if f == field and (v not in seen or c > seen[v]):
            seen[v] = c
    return max(seen, key=lambda v: seen[v]) if seen else None


@pytest.fixture(scope="module")
def documents(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)) + [(99, None)], "doc long, text string").cache()


def test_candidates_equal_python(documents):
    got = {}
    for r in X.candidates(documents).collect():
        got.setdefault(r.doc, []).append((rules.FIELDS.index(r.field), r.ord, (r.field, r.value, round(r.confidence, 6), r.source)))
    for i, t in enumerate(TEXTS):
        want = [(f, v, round(c, 6), s) for f, v, c, s in _python(t)]
        assert [x for _, _, x in sorted(got.get(i, []))] == want, t
    assert 99 not in got


def test_best_in_row_equals_best_and_python(documents):
    rows = {r.doc: r for r in X.extract(documents).collect()}
    long = {(r.doc, r.field): r.value for r in X.best(X.candidates(documents)).collect()}
    for i, t in enumerate(TEXTS):
        for f in rules.FIELDS:
            assert rows[i][f] == long.get((i, f)) == _first_best(_python(t), f), (t, f)
    assert rows[5].notes == ["No project ID found", "No supplier found"]
    assert rows[99].project_id is None
    assert X.extract(documents)._jdf.queryExecution().executedPlan().toString().count("Exchange") == 0


def test_offsets_count_code_points(spark):
    t = "😀 ab😀 12 kg, é 7 mm"
    d = spark.createDataFrame([(t,)], "t string").select(F.explode(find_all("t", r"(?iuU)\d+ (kg|mm)", 1)).alias("m")).select("m.*").collect()
    assert [(r.start, r.g0, r.g1) for r in d] == [(m.start(), m[0], m[1]) for m in re.finditer(r"\d+ (kg|mm)", t)]


def test_one_decimal_rounds_as_printf(spark):
    values = [0.0, 0.05, 0.15, 0.25, 0.35, 73.25, 88.85, 59.95, 1.05, 100.0, 99.949999, -0.05, -1.25, 2.5, 66.65]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v double").select(one_decimal(F.col("v"))).collect()]
    assert [g.replace("-0.0", "0.0") for g in got] == [("%.1f" % v).replace("-0.0", "0.0") for v in values]


@pytest.mark.parametrize(
    ("field", "pred", "label", "want"),
    [
        ("project_id", "WO-1", "wo 1", "OK"), ("project_id", "WO-12", "WO-1", "OK"), ("project_id", "X", "Y", "WRONG"), ("date", "05/11/2013", "2013-11-05", "OK"), ("date", "05/11/13", "2013-11-05", "OK"), ("quantity", "400 kgs", "400 KG", "OK"),
        ("supplier", "Aciérie Nord SA", "acierie nord", "OK"), ("supplier", "Foo", "Nord Acier Sud", "WRONG"), ("material", "304L", "N/A", "OK"), ("material", "", "x", "MISS"), ("material", "x", "", "FP"), ("material", None, None, "—"), ("supplier", "AB", "ab", "OK"), ("supplier", "...", "ab cd", "WRONG"),
    ],
)
def test_outcomes(spark, field, pred, label, want):
    d = spark.createDataFrame([(field, pred, label)], "field string, pred string, label string")
    assert d.select(S.outcome(F.col("field"), F.col("pred"), F.col("label"), F.lit(True))).first()[0] == want


def test_normalisation_decomposes_as_unicode_says(spark):
    def want(t):
        d = "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c)).lower()
        return re.sub(r"\s+", " ", re.sub(r"[^\w\s/.\-+]", " ", d)).strip()

    texts = ["Aciérie ﬁne ½ ㎏ № 5 ™", "ＡＢＣ１２３", "ﬀﬂ x² 10³", "Ångström Œuvre Straße", "", "㎜ ㎝ ℃ Ⅻ", "ǅ ĳ", *("".join(chr(c) for c in range(a, a + 64)) for a in range(0xA0, 0x250, 64))]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", eval_normalize(F.col("t")).alias("n")).collect()
    assert {r.t: r.n for r in got} == {t: want(t) for t in texts}
