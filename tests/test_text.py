from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from weblode.functions import text as X
from weblode.operators import vocabulary


def test_camel_pieces(apply):
    texts = ["HTMLParser", "fooBar", "ABC def", "Foo Bar", "", "ABC", "aBCd", "ÉtéAB"]
    assert apply(texts, X.camel_pieces) == [
        ["HTML", "Parser"], ["foo", "Bar"], ["AB", "C def"], ["Foo ", "Bar"], [], ["ABC"], ["a", "B", "Cd"], ["Été", "AB"],
    ]


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="aBcDÉé .1", max_size=20), min_size=1, max_size=40))
def test_camel_pieces_concatenate_to_the_text(apply, texts):
    assert ["".join(p) for p in apply(texts, X.camel_pieces)] == texts


def test_delimiters_apply_separately(apply):
    got = apply(["a,b;c"], lambda c: X.delimiter_pieces(c, [",", ";"]))
    assert got == [["a", "b;c", "a,b", "c"]]
    assert apply(["a.b|c"], lambda c: X.delimiter_pieces(c, [".", "|"])) == [["a", "b|c", "a.b", "c"]]
    assert apply(["x"], lambda c: X.delimiter_pieces(c, [])) == [[]]


def test_letters_and_endings(apply):
    assert apply([" a1-b c! ", "42"], X.letters_only) == ["ab c", ""]
    texts = ["Men in black in", "Health of the", "x for to", "x to for", "none", " in", "more and  more"]
    assert apply(texts, X.repair_ending) == ["Men black", "Health of", "x", "x to", "none", "", "more"]


def test_candidates(apply):
    texts = ["A", "ab", "AB", "Ab", "a b", "A B", ""]
    assert apply(texts, X.is_candidate) == [False, False, False, True, True, True, False]


def test_vocabulary(spark):
    rows = spark.createDataFrame([("Heart Disease,lungCancer in",), ("Heart Disease",), ("ABC,The",)], "topic string")
    got = {r["value"] for r in vocabulary.vocabulary(rows, "topic", [","], ["The"]).collect()}
    table = spark.createDataFrame([("The",)], "v string")
    assert got == {r["value"] for r in vocabulary.vocabulary(rows, "topic", [","], table).collect()}
    assert got == {"Heart", "Disease", "Cancer"}


def test_digits(apply):
    assert apply(["no digits", "EUR 12.50", None], X.digits_only) == ["0", "1250", None]
