import time

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from weblode.functions import values as V
from weblode.functions.countries import iso_countries, read_countries
from weblode.operators.model import enumeration


def test_numeric_token(apply):
    texts = ["about USD 1,234.50 net", "approx. 12", "none", "", None, "a\u00a042 b", "\u0663\u0664 items"]
    assert apply(texts, V.numeric_token) == ["1,234.50", ".", None, None, None, "42", "\u0663\u0664"]


def test_normal_text(apply):
    texts = ["a\nb  c..d", "x    y", "a...b", "t\tab\r\n", None]
    assert apply(texts, V.normal_text) == ["a bc.d", "xy", "a..b", "tab ", None]


def test_date_text(apply):
    texts = [
        "1-12-1963", "1/12/1963", "1789-7-14", r"1789\7\14", "1945-2", "2-1883", "none", "on 99-99-2001 or 1/2/2003",
        "first 2001-2 then 3/4/2005", "line\n7-8-1999\nend",
    ]
    assert apply(texts, V.date_text) == [
        "1963-12-1", "1963-12-1", "1789-7-14", "1789-7-14", "1945-2-01", "1883-2-01", None, "2001-99-99",
        "2005-4-3", "1999-8-7",
    ]


def test_date_value_is_null_for_impossible_days(apply):
    got = apply(["31-12-1999", "31-2-1999"], V.date_value)
    assert [str(d) if d else None for d in got] == ["1999-12-31", None]


def test_country(apply, spark):
    table = iso_countries(spark)
    texts = ["from Nigeria", "NL", "in Vietnam now", "nowhere", "Guinea-Bissau", None, "xNLx"]
    got = apply(texts, lambda c: V.country(c, table))
    assert got == ["Niger", "Netherlands", "Vietnam", "nowhere", "Guinea", None, "xNLx"]


def test_own_country_table(spark, tmp_path):
    (tmp_path / "own.csv").write_text('"Korea, Republic of",KR\nOman,OM\n')
    assert read_countries(spark, str(tmp_path / "own.csv")) == [("Korea, Republic of", "KR"), ("Oman", "OM")]


def test_many_categories(apply, spark):
    keys = {f"key{i}": f"value {i}" for i in range(5000)}
    started = time.time()
    expression = V.category(F.col("x"), keys)
    assert time.time() - started < 10
    assert apply(["a Key4999 b", "key17", "key", None], lambda c: V.category(c, keys)) == ["value 4999", "value 17", V.OTHER_CATEGORY, None]
    assert apply(["a key4999 b", "key17", "none"], lambda c: enumeration(c, keys, "d")) == ["value 4", "value 1", "d"]
    assert expression is not None


def test_country_table(spark):
    table = dict((code, name) for name, code in iso_countries(spark))
    assert len(table) == 249
    assert table["KR"] == "South Korea" and table["NL"] == "Netherlands"
    names = [name for name, _ in iso_countries(spark)]
    assert names == sorted(names) and names[0] == "Afghanistan" and names[-1] == "Åland Islands"


def test_category_is_first_key_as_whole_word(apply):
    keys = {"cancer": "Oncology", "heart": "Cardiology", "c.r": "Vehicle"}
    texts = ["Cancerous", "the HEART and cancer", "my car.", "", None]
    assert apply(texts, lambda c: V.category(c, keys)) == ["Other Category", "Oncology", "Vehicle", "Other Category", None]


def test_category_by_votes(apply):
    keys = {"aa": "A", "bb": "B", "ab": "A", "cc": "B", "dd": "C"}
    texts = ["aa", "BB cc aa", "cc aab", "dd bb", "zz", "bb dd bb bb", None]
    # "cc aab": A has aa and ab, B has cc; "dd bb": one each, B's key comes first.
    assert apply(texts, lambda c: V.category_by_votes(c, keys)) == ["A", "B", "A", "B", "Other Category", "B", None]


def test_postcode_and_place(apply):
    assert apply(["at 1234 AB", "12345 ab", "none"], V.postcode) == ["1234 AB", "2345 ab", None]
    assert apply(["City: Oslo;", "none"], lambda c: V.place_text(c, ["City: (.*);"])) == ["Oslo", None]
    assert apply(["Oslo"], lambda c: V.place_text(c, None)) == ["Oslo"]


def test_numbers(apply):
    assert apply(["1,234.50", "", " 7 ", ".", None], V.integer) == [123450, None, 7, None, None]
    assert apply(["1,234.90", "1.2.3", "", "9"], V.truncated_decimal) == [1234, None, None, 9]


def test_removal_in_order(apply):
    assert apply(["abcabc"], lambda c: V.remove_literals(c, ["ab", "cc", "c"])) == [""]


def test_innermost(apply):
    deep = "(" * 40 + "x" + ")" * 40
    texts = ["a(b(c)d)e", "plain", "()", "(7)", deep, None, ""]
    assert apply(texts, lambda c: V.innermost(c, r"\((.*)\)")) == ["c", "plain", "()", "7", "x", None, ""]
    assert apply(["a12b"], lambda c: V.innermost(c, r"(\d+)")) == ["12"]


def test_finished_order(apply):
    # Removal, then the cast, then extraction from the number's digits, then the array.
    got = apply(["x1,234"], lambda c: V.finished(c, "int", ["x"], [r"^12(\d+)"], as_array=True))
    assert got == [["34"]]
    assert apply([None], lambda c: V.finished(c, "string", as_array=True)) == [None]


@pytest.mark.parametrize("kind", ["currency", "string", "date", "multivalue", "zipcode", "location", "other"])
def test_missing_stays_missing(apply, kind):
    assert apply([None], lambda c: V.finished(V.typed(c, kind, {"a": "A"}), kind)) == [None]


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="ab()(", max_size=30), min_size=1, max_size=30))
def test_innermost_matches_a_loop(apply, texts):
    import re

    def loop(t):
        while (m := re.search(r"\((.*)\)", t)) and m.group(1):
            t = m.group(1)
        return t

    assert apply(texts, lambda c: V.innermost(c, r"\((.*)\)")) == [loop(t) for t in texts]
