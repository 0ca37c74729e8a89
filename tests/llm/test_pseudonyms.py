import random
import re

import pytest

from offer_engine.llm import pseudonyms
from tests.llm.edges import KINDS, edge_rows, table

VALUES = {
    "card": ["4111 1111 1111 1111", "5500-0000-0000-0004", "4111111111111112", "378282246310005"],
    "phone": ["+1 (243) 555-5526", "+49 30 1234567", "+15551234567"],
    "ip": ["10.0.0.1", "255.255.255.255", "192.168.17.4"],
    "ssn": ["123-45-6789", "899-99-9999", "665-01-0001", "667-01-0001"],
    "date": ["2024-02-29", "1999-12-31", "31.12.1999", "31/12/1999", "1800-01-01", "2199-12-31"],
    "email": ["jane.doe7@mail.example.com", "X_y%z+1@a-b.org"],
}
UNTOUCHED = ["2023-02-29", "999.1.1.1", "000-12-3456", "666-12-3456", "12:30", "3.14", "v1.2.3", "a@b", "2300-01-01"]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10


def run(spark, texts, key="k", back=False):
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], KINDS)
    got = pseudonyms.pseudonymised(df, key, back=back).orderBy("doc_id").collect()
    return [r.text for r in got], [r.replaced for r in got]


def test_formats_are_kept_and_turned_back(spark):
    values = [v for vs in VALUES.values() for v in vs]
    texts = [f"Before {v} after, ü {v}." for v in values]
    made, replaced = run(spark, texts)
    for v, t, m, n in zip(values, texts, made, replaced, strict=True):
        assert n in (0, 2)
        shape = lambda s: re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub(r"\d", "9", s)))
        if v not in VALUES["ip"]:
            assert shape(m) == shape(t)
        first, second = m.removeprefix("Before ").removesuffix(".").split(" after, ü ")
        assert first == second
    assert sum(n == 2 for n in replaced) >= len(values) - 1
    assert run(spark, made, back=True)[0] == texts


def test_ip_round_trip_with_changing_length(spark):
    made, _ = run(spark, VALUES["ip"])
    assert all(all(0 <= int(o) <= 255 for o in m.split(".")) for m in made)
    assert run(spark, made, back=True)[0] == VALUES["ip"]


def test_validity_is_kept(spark):
    rng = random.Random(1)
    cards = ["".join(rng.choice("0123456789") for _ in range(16)) for _ in range(50)]
    made, _ = run(spark, cards)
    assert [luhn(m) for m in made] == [luhn(c) for c in cards]
    dates, _ = run(spark, VALUES["date"])
    assert dates[1].split("-") == dates[2].split(".")[::-1] == dates[3].split("/")[::-1]


def test_what_does_not_validate_stays(spark):
    made, replaced = run(spark, UNTOUCHED)
    assert made == UNTOUCHED and set(replaced) == {0}


def test_permutations_are_exact(spark):
    """All days and all numbers of a small range have different pseudonyms."""
    days = spark.sql(
        "SELECT id, date_format(date_add(date'1800-01-01', cast(id AS int)), 'yyyy-MM-dd') AS m FROM range(146097)"
    )
    made = days.selectExpr(f"{pseudonyms.date('k', False)} AS p")
    assert made.distinct().count() == 146097
    assert made.filter("p < '1800-01-01' or p > '2199-12-31'").count() == 0
    two = spark.sql("SELECT lpad(cast(id AS string), 3, '0') AS m FROM range(1000)")
    assert two.selectExpr(f"{pseudonyms.over_characters('m', 'k', 't')} AS p").distinct().count() == 1000


def test_other_keys_give_others(spark):
    assert run(spark, VALUES["card"], "k")[0] != run(spark, VALUES["card"], "it's \\ another")[0]


def test_edges_and_clashing_columns(spark):
    rows = edge_rows()
    got = pseudonyms.pseudonymised(table(spark, rows, clashing=True), "k").collect()
    assert sorted((r.doc_id, r.text) for r in got if r.doc_id) == sorted((r[0], r[1]) for r in rows if r[0])
    assert {r["row"] for r in got} == {"kept row"}


def test_empty(spark):
    assert pseudonyms.pseudonymised(table(spark, []), "k").count() == 0


def test_no_python_in_the_plan(spark):
    df = pseudonyms.pseudonymised(table(spark, edge_rows()), "k")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Exchange", plan)


@pytest.mark.parametrize("text", ["1" * 200_000, "12 " * 50_000, "a1@" * 20_000, "+1 2" * 20_000])
def test_long_texts(spark, text):
    assert len(run(spark, [text])[0][0]) == len(text)
