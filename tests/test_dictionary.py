import random
import re

import pytest
from pyspark.sql import functions as F

from weblode.functions import dictionary, values
from weblode.functions.core import any_rlike, first_of, java_pattern
from weblode.functions.countries import iso_countries
from weblode.operators import links, model

TEXTS = [None, "", "a", "ab", "aab abab", "b-a a_b", "é a🙂b", "ab\nb", "(a.b)", "aaaaaaaa", " a ", "-"]


def mixed(rng, letters, shortest, longest):
    return "".join(rng.choice(letters) for _ in range(rng.randrange(shortest, longest)))


@pytest.mark.parametrize("letters", ["ab", "ab -_", "aé🙂.(", "abc\\|?\n"])
def test_first_key_equals_trying_all(apply, letters):
    rng = random.Random(letters)
    keys = list(dict.fromkeys(mixed(rng, letters, 1, 6) for _ in range(60)))
    lookup = {k: None if i % 9 == 0 else f"v{i}" for i, k in enumerate(keys)}
    texts = TEXTS + [mixed(rng, letters + "x", 0, 12) for _ in range(150)]
    got = apply(texts, lambda x: dictionary.first_key(x, lookup, "none"))
    assert got == [next((v for k, v in lookup.items() if t and k in t), "none") for t in texts]
    found = apply(texts, lambda x: F.array_sort(F.array_distinct(F.transform(dictionary.found_in(x, {k: [(i, None)] for i, k in enumerate(keys)}), lambda e: e["rank"]))))
    assert found == [None if t is None else [i for i, k in enumerate(keys) if k in t] for t in texts]


def test_an_empty_key_stands_in_every_text(apply):
    assert apply(["", "b", None], lambda x: dictionary.first_key(x, {"a": "1", "": "2"}, "none")) == ["2", "2", "none"]


def test_words_equal_trying_all_patterns(apply):
    rng = random.Random(5)
    plain = [mixed(rng, "ab -_1", 1, 6) for _ in range(80)]
    lookup = {k: f"v{i}" for i, k in enumerate(dict.fromkeys([*plain[:40], "a+b", "é", r"b\d", *plain[40:]]))}
    texts = TEXTS[1:] + [mixed(rng, "ab -_1é.", 0, 14) for _ in range(300)]

    def in_turn(x):
        return first_of(((x.rlike(java_pattern(rf"\b{k}\b")), v) for k, v in lookup.items()), "none")

    assert apply(texts, lambda x: dictionary.first_word(x, lookup, "none")) == apply(texts, in_turn)
    only_patterns = {k: v for k, v in lookup.items() if not dictionary.is_plain(k)}
    assert apply(["ab", "é", "xb1", "b1"], lambda x: dictionary.first_word(x, only_patterns, None)) == ["v" + lookup["a+b"][1:], lookup["é"], None, lookup[r"b\d"]]


def test_large_dictionaries_give_what_small_ones_give(apply, monkeypatch):
    rng = random.Random(8)
    keys = {mixed(rng, "abC", 1, 5): f"v{i % 5}" for i in range(250)} | {"Ab+": "v9"}
    texts = TEXTS + [mixed(rng, "abcC ", 0, 12) for _ in range(200)]
    functions = [
        lambda x: values.category(x, keys),
        lambda x: values.category_by_votes(x, keys),
        lambda x: model.enumeration(x, keys, "none"),
        lambda x: model.canonical_key(x, keys),
        lambda x: values.country(x, [(k, v) for k, v in keys.items()]),
    ]

    def all_of(most):
        for place in (values, model):
            monkeypatch.setattr(place, "MOST_BRANCHES", most)
        monkeypatch.setattr(values, "MOST_PATTERNS", most)
        return [apply(texts, f) for f in functions]

    assert all_of(5) == all_of(10_000)


def test_countries_of_the_default_table(apply, spark):
    table = iso_countries(spark)
    assert len(table) > 200
    texts = ["in France and Germany", "FR", "nowhere", None, "Nigeria"]
    assert apply(texts, lambda x: values.country(x, table)) == ["France", "France", "nowhere", None, "Niger"]
    # Typing stands inside lambdas, where an element's text is bound.
    assert apply(texts[:1], lambda x: F.transform(F.array(x), lambda t: values.country(t, table))[0]) == ["France"]


def test_required_texts():
    cases = {r"/shop/\d+/view": ["/shop/", "/view"], r"a|b": [], r"(?i)abc": [], r"abc?d": ["ab", "d"], r"(abc)d": ["d"], r"^http://x\.nl/$": ["http://x.nl/"], r"(?=abc)": [], "": []}
    for pattern, want in cases.items():
        assert dictionary.required_texts(pattern) == want, pattern
        assert all(t in "http://x.nl/ /shop/12/view abd abcd" or t in ("a", "b") for t in dictionary.required_texts(pattern))


def test_many_rules_equal_trying_all(apply):
    rng = random.Random(2)
    pieces = ["/shop/", r"\d+", "view", ".*", r"\?id=", "(a|b)", "(?:xy)?", "item", r"\bnl\b", "[a-f]", "$", "sho", "(?i)VIEW"]
    rules = ["".join(rng.sample(pieces[:-1], rng.randrange(1, 4))) for _ in range(80)]
    rules = [r for r in rules if not re.search(r, "")] + ["(?i)VIEW7", "/shop/", "/shop/"]
    urls = [None, "", *("https://x.nl/" + "".join(rng.choice(["shop/", "12", "view", "?id=", "a", "xy", "item", "/", "VIEW7", "é"]) for _ in range(rng.randrange(6))) for _ in range(300))]
    assert len(rules) > 20
    got = apply(urls, lambda x: links.denied(x, rules))
    assert got == apply(urls, lambda x: any_rlike(x, rules)) and True in got and False in got
    assert apply(urls, lambda x: links.permitted(x, [r"zz\d"] * 30)) == [None if u is None else False for u in urls]
