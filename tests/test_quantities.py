import itertools
import math
import random
from decimal import Decimal

import pytest

from millsheet.operators.quantities import BLOCK, changepoints, hidden_units, normalise_quantities, parse, quantity_records, stated_unit


@pytest.mark.parametrize(
    ("text", "base", "amount"),
    [
        ("135' 1\"", "mm", 41173), ("2O169 kilos", "g", 20169000), ("3.96e5 millimètres", "mm", 396000), ("KG: ８１２", "g", 812000), ("5.103.000,00 gr", "g", 5103000),
        ("2 lots de 406 Kgs", "g", 812000), ("12 x 38 pieces", "pcs", 456), ("0,81 T. (1785.7 lb)", "g", 810000), ('7126"', "mm", 181000), ("four dz", "pcs", 48),
        ("1'790.15 livres", "g", 811998), ("0.123 t", "g", 123000), ("1,790 kg", "g", 1790000), ("15Okg", "g", 150000), ("34,5 ML", "mm", 34500), ("8l2 kg", "g", 812000), ("472ft 5in", "mm", 143993),
    ],
)
def test_stated_units(text, base, amount):
    n, u, f = parse(text)
    assert u == base
    assert round(n * f) == amount


@pytest.mark.parametrize("text", ["", "-", "TBD", "voir plan", " "])
def test_no_number(text):
    assert parse(text) is None


def test_other_units_and_contexts():
    assert parse("300 °C")[1] == ""
    assert parse("12 235")[1] is None
    assert stated_unit("Weight en Kg = 12 235") == ("g", Decimal(1000))
    assert stated_unit("Masse [t] 0,19") == ("g", Decimal(1000000))
    assert stated_unit("No. 1536") is None


def _cost(y, cuts, penalty):
    total = penalty * len(cuts)
    for a, b in zip(cuts, [*cuts[1:], len(y)]):
        m = sum(y[a:b]) / (b - a)
        total += sum((v - m) ** 2 for v in y[a:b])
    return total


def test_changepoints_are_exact():
    rng = random.Random(3)
    for _ in range(200):
        y = [rng.choice([0.0, 1.0, 3.0]) + rng.gauss(0, 0.1) for _ in range(rng.randint(1, 9))]
        penalty = rng.choice([0.01, 0.2, 1.0])
        best = min(_cost(y, [0, *c], penalty) for r in range(len(y)) for c in itertools.combinations(range(1, len(y)), r))
        assert math.isclose(_cost(y, changepoints(y, penalty), penalty), best, rel_tol=1e-9, abs_tol=1e-9)


def test_changepoints_with_units_are_exact():
    rng = random.Random(5)
    for _ in range(200):
        y = [rng.choice([0.0, 1.0, 3.0]) + rng.gauss(0, 0.1) for _ in range(rng.randint(1, 9))]
        units = [rng.choice([None, None, "kg", "g"]) for _ in y]
        pure = lambda cuts: all(len({u for u in units[a:b] if u}) < 2 for a, b in zip(cuts, [*cuts[1:], len(y)]))  # noqa: E731, B023
        penalty = rng.choice([0.01, 0.2, 1.0])
        best = min(_cost(y, [0, *c], penalty) for r in range(len(y)) for c in itertools.combinations(range(1, len(y)), r) if pure([0, *c]))
        got = changepoints(y, penalty, units)
        assert pure(got)
        assert math.isclose(_cost(y, got, penalty), best, rel_tol=1e-9, abs_tol=1e-9)


SCHEMA = "source_table string, row_id long, source string, position long, value string, context string, history string"


def test_unit_change_is_inferred_from_the_level(spark):
    rows = [("e", i, "d", i, v, None, "clash") for i, v in enumerate(["812 kg", "813 kg", "1790.2", "1791", "812000 g"])]
    got = {r.row_id: r for r in normalise_quantities(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert not got[2].stated
    assert got[2].base_unit == "g"
    assert abs(got[2].amount - 812020) < 100
    assert got[4].amount == 812000


def test_nulls_repeats_long_values_and_hot_sources(spark):
    rows = [("e", None, "d", 1, "1 kg", None, None), ("e", 1, "d", 1, None, None, None), ("e", 2, None, None, "2 kg", None, None), ("e", 2, None, None, "2 kg", None, None), ("e", 3, "d", 2, "x" * 100000, None, None)]
    rows += [("e", 100 + i, "hot", i, f"{i + 1} kg", None, None) for i in range(1500)]
    got = normalise_quantities(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(r.row_id for r in got) == [2, *range(100, 1600)]
    assert {r.row_id: r.amount for r in got}[100 + 699] == 700000
    assert normalise_quantities(spark.createDataFrame([], SCHEMA)).count() == 0


def test_records_of_three_tables(spark):
    e = spark.createDataFrame([(1, "A.pdf", " Quantity ", "3 kg", "3 kg", 0), (2, "a", "date", "2020", "", 1)], "entity_id long, document_name string, field string, value string, raw_text string, ord int")
    r = spark.createDataFrame([(7, "A", ("9", ), ["quantity read from: Total en lbs = 9"]), (8, "A", ("9", ), None)], "result_id long, document_name string, extracted_entities struct<quantity: string>, notes array<string>")
    s = spark.createDataFrame([(9, "a.PDF", "4 pcs")], "seed_id long, filename string, quantity string")
    got = {(x.source_table, x.row_id): (x.base_unit, x.amount, x.stated) for x in normalise_quantities(quantity_records(e, r, s)).collect()}
    assert got["extracted_entity", 1] == ("g", 3000, True)
    assert got["extraction_result", 7] == ("g", 4082, True)
    assert got["extraction_result", 8][2] is False
    assert got["seed_record", 9] == ("pcs", 4, True)


def test_one_history_of_a_document(spark):
    e = spark.createDataFrame([(1, "A", "quantity", "2000", None, 10), (2, "A", "quantity", "2000", None, 11)], "entity_id long, document_name string, field string, value string, raw_text string, ord int")
    r = spark.createDataFrame([(7, "A.pdf", ("2 kg",), None)], "result_id long, document_name string, extracted_entities struct<quantity: string>, notes array<string>")
    s = spark.createDataFrame([(9, "A.pdf", "2 kg")], "seed_id long, filename string, quantity string")
    got = {(x.source_table, x.row_id): (x.base_unit, x.amount, x.stated) for x in normalise_quantities(quantity_records(e, r, s)).collect()}
    assert got["extracted_entity", 1] == got["extracted_entity", 2] == ("g", 2000, False)
    assert got["seed_record", 9] == ("g", 2000, True)


def test_hidden_units(spark):
    rows = [("e", i, "d", i, v, None) for i, v in enumerate(["812 kg", "812 kg", "812000 g", "812000 g", "1790.2 lb", "300 °C", "7"])]
    got = {r.row_id: (r.base_unit, r.amount, r.found_unit, r.found_amount) for r in hidden_units(spark.createDataFrame(rows, SCHEMA.rsplit(",", 1)[0])).collect()}
    assert set(got) == {0, 1, 2, 3, 4}
    assert all(g[0] == g[2] == "g" and abs(g[1] - g[3]) <= 0.02 * g[1] for g in got.values())


def test_hot_source_without_positions(spark):
    n = 9 * BLOCK
    d = spark.range(n).selectExpr("'r' source_table", "id row_id", "'hot' source", "cast(null as long) position", "concat(id + 1, ' kg') value", "cast(null as string) context")
    got = normalise_quantities(d)
    assert got.selectExpr("count(*) n", "count_if(amount = (row_id + 1) * 1000) k").first() == (n, n)
