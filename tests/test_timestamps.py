import itertools
import random
from datetime import datetime, timedelta

import pytest

from millsheet.operators import timestamps as T
from millsheet.operators.timestamps import conventional, hidden_sites, interpretations, normalise_timestamps, viterbi


@pytest.mark.parametrize(
    ("value", "tz", "want"),
    [
        ("10/31/2022 05:32:27", "America/New_York", "2022-10-31T09:32:27Z"), ("02/11/2023", "Asia/Kolkata", "2023-11-02"), ("02/11/2023", "America/Chicago", "2023-02-11"), ("2022-260", None, "2022-09-17"), ("2024-W33-4", None, "2024-08-15"),
        ("1654359132155", None, "2022-06-04T16:12:12Z"), ("1760945384.734", None, "2025-10-20T07:29:44Z"), ("02:05 30-Mar-25", "Europe/Paris", "2025-03-30T01:05:00Z"), ("2021-10-31 02:30:00", "Europe/Paris", "2021-10-31T00:30:00Z"),
        ("13. März 2022, 02.39 Uhr", "America/New_York", "2022-03-13T07:39:00Z"), ("le 2 novembre 2025 à 1h21", "America/Chicago", "2025-11-02T06:21:00Z"), ("2020年5月27日", None, "2020-05-27"), ("15\xa0OCTOBRE\xa02024", None, "2024-10-15"),
        ("Jan 15, 2022 1:16 AM CST", "America/Chicago", "2022-01-15T07:16:00Z"), ("2022-01-22 01:59 UTC+1", None, "2022-01-22T00:59:00Z"), ("2022-10-30T21:24:17[Europe/Paris]", None, "2022-10-30T20:24:17Z"), ("1er avr. 2020", None, "2020-04-01"),
        ("20200726T195046Z", None, "2020-07-26T19:50:46Z"), ("28.05.24", None, "2024-05-28"), ("Thu 11 Nov 2021", None, "2021-11-11"),
    ],
)
def test_readings(value, tz, want):
    assert [w for w, _, _, _, kept in interpretations(value, tz) if kept][0] == want


@pytest.mark.parametrize("value", ["", " ", "n.d.", "mars 2024", "2023-13-05", "31/02/2024", "24:71", "N/A", "x" * 50000, "2023-366"])
def test_no_reading(value):
    assert not [x for x in interpretations(value, "Europe/Paris") if x[4]]


def _cost(records, path):
    """The least cost of a path with any orders of day and month that its readings allow."""
    best = float("inf")
    for orders in itertools.product((T.DAY_FIRST, T.MONTH_FIRST), repeat=len(path)):
        if any(r[j][2] not in (None, o) for r, j, o in zip(records, path, orders)):
            continue
        c = sum(r[j][3] for r, j in zip(records, path))
        for (r, j, o), (s, k, q) in itertools.pairwise(zip(records, path, orders)):
            c += T.SWITCH * (o != q) + T.FORMAT * (r[j][1] != s[k][1]) + T.BACKWARD * (s[k][0][:10] < r[j][0][:10])
        best = min(best, c)
    return best


def test_viterbi_is_exact():
    rng = random.Random(4)
    for _ in range(60):
        records = []
        for _ in range(rng.randint(1, 6)):
            day = [f"2024-0{rng.randint(1, 9)}-01" for _ in range(2)]
            records.append(rng.choice([[(day[0], "ymd", None, 0.0, True)], [(day[0], "dmy", 0, 0.0, True), (day[1], "mdy", 1, T.CONVENTION, False)], [(day[0], "mdy", 1, 0.0, True)]]))
        best = min(_cost(records, p) for p in itertools.product(*[range(len(r)) for r in records]))
        assert abs(_cost(records, viterbi(records)) - best) < 1e-9
    assert viterbi([]) == []


def test_history_overrules_a_convention_and_the_check_restores_it():
    sure = lambda d: [(d, "mdy", T.MONTH_FIRST, T.CONVENTION, False)]
    open_ = [("2024-03-02", "dmy", T.DAY_FIRST, 0.0, True), ("2024-02-03", "mdy", T.MONTH_FIRST, T.CONVENTION, False)]
    path = viterbi([sure("2024-01-15"), sure("2024-01-20"), open_, sure("2024-02-20"), sure("2024-02-25")])
    assert path == [0, 0, 1, 0, 0]
    assert conventional(open_, 1) == 0
    assert conventional(sure("2024-01-15"), 0) == 0


def test_history_alone_finds_the_order(spark):
    t = datetime(2025, 1, 1)
    rows = [("s", i, f"{i % 12 + 1:02d}/{v:02d}/2024", "America/Chicago", t + timedelta(minutes=9 * i)) for i, v in enumerate([25, 3, 28, 4, 5, 29, 30, 6] * 10)]
    d = spark.createDataFrame(rows, "source_table string, row_id long, value string, site_tz string, recorded_at timestamp")
    got = hidden_sites(d).collect()
    # in either order a day, and another one in each
    assert {r.row_id for r in got} == {i for i, r in enumerate(rows) if int(r[2][3:5]) < 13 and r[2][:2] != r[2][3:5]}
    assert all(r.day == r.by_history for r in got)
    assert {r.row_id for r in normalise_timestamps(d).collect()} == set(range(80))


def test_table(spark):
    schema = "source_table string, row_id long, value string, site_tz string, recorded_at timestamp, history string"
    t = datetime(2025, 1, 1)
    rows = [("s", 1, "2024-01-02", "Mars/Base", t, "c"), ("s", 1, "2024-01-02", "Mars/Base", t, "c"), ("s", None, "2024-01-02", None, t, None), ("s", 2, None, None, None, None), ("s", 3, "2024-05-05 10:00", None, None, None)]
    rows += [("s", 10 + i, "01/02/2024", "Europe/Paris", t, None) for i in range(1200)]
    got = {r.row_id: r.utc for r in normalise_timestamps(spark.createDataFrame(rows, schema)).collect()}
    assert got[1] == "2024-01-02"
    assert got[3] == "2024-05-05T10:00:00Z"
    assert len(got) == 1202
    assert set(got.values()) == {"2024-01-02", "2024-05-05T10:00:00Z", "2024-02-01"}
    assert normalise_timestamps(spark.createDataFrame([], schema)).count() == 0
