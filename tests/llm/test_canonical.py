import pytest

from millsheet.llm import canonical as C
from millsheet.llm.canonical import Reference, allowed, deletions, edits, map_rows, match_values, repair

REF = [
    ("M1", "Stainless steel 321", "stainless", "321", "1.4541", "X6CrNiTi18-10"), ("M2", "Stainless steel 310S", "stainless", "310S", "1.4845", None), ("M3", "Steel S275JR", "steel", "S275JR", "1.0044", None),
    ("M4", "Ferrotan 45", "cast iron", "45", None, None), ("M5", "Polyvane PP-H", "plastic", "PP-H", None, None), ("M6", "Norvalloy X-750", "nickel", "X-750", None, None), ("M7", "Aluminium 5083-H111", "aluminium", "5083-H111", None, None),
]
SCHEMA = "ref_id string, canonical string, family string, grade string, en_number string, designation string"


@pytest.mark.parametrize(("a", "b", "d"), [("abc", "abc", 0), ("abc", "acb", 1), ("abc", "abxc", 1), ("abcd", "xbcy", 2), ("", "ab", 2)])
def test_edits(a, b, d):
    assert edits(a, b, 3) == d
    assert edits(b, a, 3) == d


def test_matching(spark):
    want = {
        "Stainless steel 32l": "M1", "SS-321": "M1", "S.S. 321": "M1", "1.4541 (321)": "M1", "X6CRNITI18 - 10": "M1", "Stai.steel  321": "M1", "Stainless stele 321 / lot 310": "M1", "acier inox. 310 s": "M2", "Edelstahl-310S": "M2",
        "Steel S27SJR": "M3", "s275jr": "M3", "Ferr. 45": "M4", "FERROTAN45": "M4", "PolyvanePP-H": "M5", "Norval1oy X-750.": "M6", "AW 5083-h111": "M7", "Tube Aluminium 5083-H111 Ø 45 x 2": "M7",
        "Norvalloy 601": "NONE", "inox": "NONE", "Stainless steel 329": "NONE", "12 pcs": "NONE", "-": "NONE", "45": "NONE", "bois traité cl. 45": "NONE", "x" * 50000: "NONE", "Zamak 5": "NONE",
    }
    ref = spark.createDataFrame(REF, SCHEMA)
    values = spark.createDataFrame([(v,) for v in [*want, "  ", "", None]], "value string")
    got = {r.value: r.ref_id for r in match_values(values, ref).collect()}
    assert got == want


def test_rows_repeats_hot_value_and_empty(spark):
    ref = spark.createDataFrame(REF, SCHEMA)
    schema = "source_table string, row_id long, value string, salt int, ref_id string"
    rows = [("e", k, "SS-321", None, "clash") for k in range(2000)] + [("e", 1, "SS-321", None, "clash"), ("e", 9000, None, None, None), ("r", 1, "Steel S275JR", None, None)]
    got = map_rows(spark.createDataFrame(rows, schema), ref).collect()
    assert len(got) == 2001
    assert {(r.source_table, r.ref_id) for r in got} == {("e", "M1"), ("r", "M3")}
    assert map_rows(spark.createDataFrame([], schema), ref).count() == 0
    assert {r.ref_id for r in map_rows(spark.createDataFrame(rows, schema), spark.createDataFrame([], SCHEMA)).collect()} == {"NONE"}


def test_repair_equals_brute_force(spark):
    vocab = ["stainless", "steel", "copper", "alu"]
    tokens = ["stainles", "stanless", "stainlesss", "seel", "stele", "coper", "cooper", "allu", "alu", "al", "xyz", "stialness"]
    got = {(r.token, r.word) for r in repair(spark.createDataFrame([(t,) for t in tokens], "token string"), vocab).collect()}
    want = {(t, w) for t in tokens for w in vocab if edits(t, w, 3) <= allowed(min(len(t), len(w))) and deletions(t, allowed(len(t))) & deletions(w, allowed(len(w)))}
    assert got == want


def test_values_of_many_rows_are_spread(spark, monkeypatch):
    monkeypatch.setattr(C, "HOT_ROWS", 100)
    rows = [("e", k, "SS-321") for k in range(1030)] + [("e", 5000 + k, f"Steel S275JR {k}") for k in range(5)]
    got = map_rows(spark.createDataFrame(rows, "source_table string, row_id long, value string"), spark.createDataFrame(REF, SCHEMA)).collect()
    assert len(got) == 1035
    assert {(r.row_id < 5000, r.ref_id) for r in got} == {(True, "M1"), (False, "M3")}


def test_ranking_of_all_entries_and_the_check():
    ref = Reference([(r[0], r[1], r[2], [c for c in r[3:] if c]) for r in REF])
    words = {"stainless": [("stainless", 1.0)], "steel": [("steel", 1.0)]}
    assert ref.rank("stainless steel 321", words)[::2] == ("M1", "M1")
    # words alone rank an entry first, but name none
    got = ref.rank("stainless steel 999", words)
    assert got[0] == "NONE"
    assert got[2] in ("M1", "M2")
    # a code further in front outranks and is the one that counts
    assert ref.rank("steel S275JR for stainless 321", words)[::2] == ("M3", "M3")
