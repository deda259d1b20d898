import itertools
import random

from millsheet.llm import names as N
from millsheet.llm.names import _joined_keys, _keys, _once, _twice, likelihood, link_names, linked_pairs, read_name

SAME = [
    "Fouddeppaz Sajgoh Stahlbau Inc.", "FOUDDEPPAZ SAJGOH", "Sajgho Fouddeppaz Inc.", "FouddeppazSajgoh Stahlbau", "Fouddeppaz S. Stahlbau Inc.", "The Fouddeppaz Sajgoh Company", "Foddeppaz Sajgoh Incorporated",
    "Établissements Fouddeppaz-Sajgoh", "Fouddeppaz & Sajg0h Stahlb.", "Sajgoh, Fouddeppaz", "Fouddepaz Sajgho",
]
OTHER = ["Hans Rahdovben Sunsun SARL", "Rahdovben Sunsun, Johannes", "Mr Johannes Rahdovben Sunsun"]
NONE = ["N/A", "voir entête", "Adresse de livraison : quai nord", "Page 1 de 2", "Inc.", "  ", "DESCRIPTION OF GOODS SAFETY GROUP", "x" * 20000]


def test_reading():
    assert read_name("Hans Rahdovben Sunsun SARL") == ("full", "rahdovben sunsun")
    assert read_name("Guillaume Hinfitneh M. SA") == ("initial", "hinfitneh m")
    assert read_name("Bridge Forge Foundry Ltd") == ("full", "bridge forge foundry")
    assert read_name("Usine 7 SARL") == ("full", "7 usine")
    assert read_name("Muller Stahlbau GmbH") == ("full", "muller/stahlbau")
    assert all(read_name(n) is None for n in NONE[:6])


def test_likelihood_falls_with_edits():
    a, b, c = (likelihood("full", x, "fouddeppaz sajgoh")[0] for x in ("fouddeppaz sajgoh", "foddeppaz sajgoh", "foddepaz sajgoh"))
    assert a > b > c
    assert likelihood("full", "xxxxxxx yyyyyy", "fouddeppaz sajgoh") is None
    assert likelihood("full", "7 usine", "8 usine") is None
    assert likelihood("full", "bridge forge foundry", "bridge forge foundri") == (N.EDIT, True)


def _link(spark, names):
    return {r.name: r.canonical for r in link_names(spark.createDataFrame([(n,) for n in names], "name string")).collect()}


def test_names_of_any_number_of_words_and_with_numbers(spark):
    got = _link(spark, ["Bridge Forge Foundry Ltd", "BRIDGE FORGE FOUNDRY", "Bridge Fogre Foundry", "Foundry, Bridge Forge", "Usine 7 SARL", "USINE 7", "Usine 8 SARL", "Alpha Nordwerk Ostmark Sudhall", "Alpha Nordwerk Ostmark Sudhal"])
    assert len({got[n] for n in ("Bridge Forge Foundry Ltd", "BRIDGE FORGE FOUNDRY", "Bridge Fogre Foundry", "Foundry, Bridge Forge")}) == 1
    assert got["Usine 7 SARL"] == got["USINE 7"] != got["Usine 8 SARL"]
    assert got["Alpha Nordwerk Ostmark Sudhall"] == got["Alpha Nordwerk Ostmark Sudhal"]


def test_neighbours_with_spellings_of_their_own_stay_apart(spark):
    of = lambda a: [f"{a} GmbH", a.upper(), f"{a} G.m.b.H.", f"Firma {a}".replace("Firma ", "The "), ", ".join(reversed(a.split())), f"GmbH {a}"]
    got = _link(spark, of("Keller Schmidt") + of("Kellner Schmitt") + ["Keler Schmidt GmbH"])
    assert {got[n] for n in of("Keller Schmidt")} == {"keller schmidt"}
    assert {got[n] for n in of("Kellner Schmitt")} == {"kellner schmitt"}
    assert got["Keler Schmidt GmbH"] == "keller schmidt"
    # one spelling alone, however often it is repeated, is a copy of the better known name
    assert _link(spark, of("Keller Schmidt") + ["Keler Schmidt GmbH"] * 500)["Keler Schmidt GmbH"] == "keller schmidt"


def test_a_word_alone_is_known_by_its_trade(spark):
    got = _link(spark, ["Muller Stahlbau GmbH", "MULLER STAHLBAU", "Muller Soudage SA", "Muler Soudage SA"])
    assert got["Muller Stahlbau GmbH"] == got["MULLER STAHLBAU"] == "muller/stahlbau"
    assert got["Muller Soudage SA"] == got["Muler Soudage SA"] != got["Muller Stahlbau GmbH"]
    got = _link(spark, ["Kessler Stahlbau GmbH", "Kessler GmbH"])
    assert len(set(got.values())) == 1


def test_common_words(spark, monkeypatch):
    rng = random.Random(6)
    rare = ["".join(rng.choices("bcdfghklmnprstvz", k=9)) for _ in range(60)]
    names = [f"Nordmetal {w} GmbH" for w in rare] + [f"{w.upper()} NORDMETAL" for w in rare] + [f"Nordmetl {w[:3]}{w[4:]} GmbH" for w in rare]
    want = _link(spark, names)
    monkeypatch.setattr(N, "HOT", 20)
    got = _link(spark, names)
    assert got == want
    assert all(got[f"Nordmetl {w[:3]}{w[4:]} GmbH"] == got[f"Nordmetal {w} GmbH"] == got[f"{w.upper()} NORDMETAL"] for w in rare)
    assert len(set(got.values())) == len(rare)


def test_links(spark):
    names = SAME * 2 + [SAME[0]] * 5 + OTHER + NONE + [None, "Fouddeppaz Tikfit GmbH"]
    linked = link_names(spark.createDataFrame([(n, "c") for n in names], "name string, canonical string"))
    got = {}
    for r in linked.collect():
        got.setdefault(r.canonical, set()).add(r.name)
    assert set(SAME) in got.values()
    assert set(OTHER) in got.values()
    assert not any(n in v for v in got.values() for n in NONE if n != "DESCRIPTION OF GOODS SAFETY GROUP" and len(n) < 100)
    pairs = {(r.name_a, r.name_b) for r in linked_pairs(linked).collect()}
    assert pairs == {(a, b) for v in got.values() for a in v for b in v if a < b}


def test_chains_end_at_one_form(spark):
    rows = ["Abcdefgh Klmnopqr"] * 9 + ["Abcdefgx Klmnopqr"] * 4 + ["Abcdefyx Klmnopqr"] * 2
    got = {r.canonical for r in link_names(spark.createDataFrame([(n,) for n in rows], "name string")).collect()}
    assert got == {"abcdefgh klmnopqr"}


def test_empty(spark):
    assert linked_pairs(link_names(spark.createDataFrame([], "name string"))).count() == 0


def test_two_wrong_letters_in_a_joined_name(spark):
    names = ["Fouddeppaz Sajgoh"] * 3 + ["Foudxeppazsajgqh", "Foudxeppqzsajgqh"]
    got = {r.name: r.canonical for r in link_names(spark.createDataFrame([(n,) for n in names], "name string")).collect()}
    assert got["Foudxeppazsajgqh"] == "fouddeppaz sajgoh"
    assert got["Foudxeppqzsajgqh"] != "fouddeppaz sajgoh"


def _edited(rng, word, times):
    w = list(word)
    for _ in range(times):
        i = rng.randrange(len(w) - 1)
        w[i : i + 2] = rng.choice(([w[i]], [w[i], "x", w[i + 1]], ["x", w[i + 1]], [w[i + 1], w[i]]))
    return "".join(w)


def test_keys_of_edited_words_meet():
    rng = random.Random(3)
    for n in (4, 9, 12, 38, 39, 40, 41, 42, 43, 79, 80, 81, 82, 83, 160, 5000):
        j = "".join(rng.choices("abcdefghij", k=n))
        once, twice, own = _once(j), _twice(j) if n < 100 or n == 160 else None, _joined_keys(j, False)
        for _ in range(30):
            assert once & _once(_edited(rng, j, 1)), n
            w = _edited(rng, j, 2)
            assert own & _joined_keys(w, True), (n, j, w)
            assert twice is None or twice & _twice(w), (n, j, w)


def test_keys_of_long_names_stay_few():
    assert sum(1 for _ in _keys("full", "x" * 20000, {})) < 200
    assert sum(1 for _ in _keys("full", " ".join(f"w{i}" for i in range(3000)), {})) < 40_000
    assert all(len(k) < 60 for w in itertools.islice(_keys("full", " ".join(f"wort{i:04d}" for i in range(200)), {}), 5000) for k in w[:1])
