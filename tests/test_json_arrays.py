"""Arrays read by byte ranges hold what the standard library reads from the whole file."""

import json
import random

import pytest

from weblode.sources import readers
from weblode.sources.json_arrays import read_json_array

SCHEMA = "i int, s string, deep string"
ODD_TEXTS = ["", "}", "{[", "]}", '"', "\\", '\\"', '"hits":[{', "},{", 'a"}b\\', "é }", "\n]", "[{", "x" * 300]


@pytest.fixture
def small_splits(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    spark.conf.unset("spark.sql.files.openCostInBytes")


def elements(seed, n):
    pick = random.Random(seed)
    for i in range(n):
        nested = {"hits": {"hits": [{"i": -1, "s": pick.choice(ODD_TEXTS)}, {}]}, "l": [[{}], []]}
        yield {"i": i, "s": pick.choice(ODD_TEXTS), **({"deep": nested} if pick.random() < 0.4 else {}), **({"more": pick.choice(ODD_TEXTS)} if i % 3 else {})}


def expected(found):
    return sorted((e.get("i"), e.get("s"), e.get("deep")) for e in found)


def got(frame):
    return sorted((r["i"], r["s"], r["deep"] and json.loads(r["deep"])) for r in frame.collect())


def comparable(rows):
    return sorted((i, s, json.dumps(d, sort_keys=True)) for i, s, d in rows)


@pytest.mark.parametrize("indent", [None, 2])
@pytest.mark.parametrize("plain", [True, False])
def test_array_of_many_splits(spark, tmp_path, small_splits, indent, plain):
    rows = []
    for file in range(3):
        found = list(elements(file, 150))
        rows += found
        (tmp_path / f"{file}.json").write_text(json.dumps(found, indent=indent, ensure_ascii=plain), encoding="utf-8")
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 5
    read = read_json_array(spark, str(tmp_path), SCHEMA)
    wanted = [(e["i"], e["s"], e.get("deep")) for e in rows]
    assert comparable((r["i"], r["s"], r["deep"] and json.loads(r["deep"])) for r in read.collect()) == comparable(wanted)


@pytest.mark.parametrize("indent", [None, 1])
def test_named_array_among_others(spark, tmp_path, small_splits, indent):
    found = list(elements(7, 200))
    export = {
        "took": 3,
        "note": '"hits":[{"i":-5}',
        "_shards": {"failures": [{"i": -2}, {"hits": [{"i": -3}]}], "n": [[[{}]]]},
        "hits": {"total": {"value": 200}, "hits": found, "after": [{"i": -4}]},
        "aggregations": {"x": {"hits": {"hits": [{"i": -6}]}, "buckets": [{"i": -7}]}},
    }
    (tmp_path / "e.json").write_text(json.dumps(export, indent=indent))
    # Several documents in one file, and one without hits.
    (tmp_path / "lines.json").write_text("\n".join(json.dumps({"hits": {"hits": part}}) for part in (found[:3], [], found[3:5])))
    (tmp_path / "none.json").write_text('{"hits": {"hits": []}, "a": {"b": [{"i": 1}]}}')
    read = read_json_array(spark, str(tmp_path), SCHEMA, ("hits", "hits"))
    wanted = [(e["i"], e["s"], e.get("deep")) for e in found + found[:5]]
    assert comparable((r["i"], r["s"], r["deep"] and json.loads(r["deep"])) for r in read.collect()) == comparable(wanted)


def test_equals_the_line_form(spark, tmp_path, small_splits):
    found = [{"priority": t, "n": i} for i, t in enumerate(ODD_TEXTS * 20)]
    (tmp_path / "whole").mkdir()
    (tmp_path / "lines").mkdir()
    (tmp_path / "whole" / "e").write_text(json.dumps({"hits": {"hits": found}}, indent=3))
    (tmp_path / "lines" / "e").write_text("\n".join(json.dumps({"hits": {"hits": found[i : i + 7]}}) for i in range(0, len(found), 7)))
    read = [
        sorted(r["priority"] for r in readers.read_index_export(spark, str(tmp_path / form), "priority", whole).collect())
        for form, whole in (("whole", True), ("lines", False))
    ]
    assert read[0] == read[1] == sorted(ODD_TEXTS * 20)


def test_small_and_odd_files(spark, tmp_path):
    texts = {
        "empty": "", "strings": json.dumps(["a}"] * 50_000 + [{"i": 4}] + [[1, 2]] * 50_000), "no_elements": " [ ] ", "scalars": '[null, {"i": 1}, 7, "a]{", {"i": 2}, true]', "object": '{"a": {"i": 9}, "b": {}}',
        "bare": "[{}]", "spaced": '\n\t[\r\n {"i" : 3 } \n ] \n',
    }
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    rows = read_json_array(spark, str(tmp_path), "i int").collect()
    assert sorted((r["i"] is not None, r["i"]) for r in rows) == [(False, None), (True, 1), (True, 2), (True, 3), (True, 4)]


@pytest.mark.parametrize("text", ['[{"i": 1}, {"i": 2', '[{"i": 1}, {"i": "a', '[{"i": 1}, {"j": [{"i": 2}'])
def test_a_file_cut_short_is_an_error(spark, tmp_path, text):
    (tmp_path / "cut").write_text(text)
    with pytest.raises(Exception, match="not whole JSON"):
        read_json_array(spark, str(tmp_path), "i int").collect()
