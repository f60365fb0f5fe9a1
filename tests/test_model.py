import json

from weblode.config import DecisionModel
from weblode.operators.model import to_model


def feature(datatype, schema="text", default=None, **script):
    derived = script.pop("derived", False)
    return {
        "scoreCalculation": {"datatype": datatype},
        "schemaMapping": {"schemaDataType": schema, "defaultValue": default, "isDrived": derived, "mappingScript": script},
    }


def rows(spark, model, records, schema):
    frame = spark.createDataFrame(records, schema)
    return to_model(frame, DecisionModel.parse("m", model)).orderBy("url").collect()


def test_each_kind(spark):
    model = {
        "kind": feature("enumeration", "keyword", "none", lookup={"cat": "C", "dog": "D"}),
        "count": feature("int", "integer", "7"),
        "price": feature("currency", "double"),
        "when": feature("other", "date"),
        "skipped": feature("artificial"),
    }
    records = [
        ("u1", "a dog and a cat", "-1,234", "EUR 12.50", "2020-01-02", "s"),
        ("u2", "bird", "none", "N/A", "soon", "s"),
        ("u3", "N/A", "N/A", None, "N/A", "s"),
    ]
    got = rows(spark, model, records, "url string, kind string, count string, price string, when string, skipped string")
    assert got[0].asDict() == {"url": "u1", "kind": "C", "count": 1234, "price": 1250.0, "when": got[0]["when"]}
    assert str(got[0]["when"]) == "2020-01-02"
    assert (got[1]["kind"], got[1]["count"], got[1]["price"], got[1]["when"]) == ("none", 0, None, None)
    assert (got[2]["kind"], got[2]["count"], got[2]["price"]) == ("none", 7, None)


def test_derived(spark):
    rules = [
        {"op": "gte", "field": "size", "value": 10, "trueBody": "big", "falseBody": "small"},
        {"op": "gte", "field": "age", "value": 3, "trueBody": "old", "falseBody": "new"},
    ]
    model = {
        "before": feature("other", derived=True, operation="mapping", format="list", lookup=["kind", "size"]),
        "kind": feature("enumeration", "keyword", "none", lookup={"cat": "C"}),
        "after": feature("other", derived=True, operation="mapping", format="list", lookup=["size", "kind", "age"]),
        "words": feature("other", derived=True, operation="comparison", lookup=json.dumps(rules)),
        "number": feature("other", "integer", derived=True, operation="comparison", lookup=rules),
    }
    records = [("u1", "my cat", "12", "1"), ("u2", "bird", "N/A", "5"), ("u3", "cat", "9", "N/A")]
    got = rows(spark, model, records, "url string, kind string, size string, age string")
    # The enumerated feature is its key for the features that follow it.
    assert [r["before"] for r in got] == [["my cat", "12"], ["bird"], ["cat", "9"]]
    assert [r["after"] for r in got] == [["12", "cat", "1"], [], ["9", "cat"]]
    assert [r["words"] for r in got] == ["big new", "old", "small"]
    assert [r["number"] for r in got] == [None, None, None]


def test_array_records(spark):
    model = {"kind": feature("enumeration", "keyword", "none", lookup={"cat": "C"}), "count": feature("int", "integer", "1")}
    got = rows(spark, model, [(["u"], ["a cat"], ["N/A"])], "url array<string>, kind array<string>, count array<string>")
    assert got[0].asDict() == {"url": "u", "kind": "C", "count": 1}


def test_mapping_is_one_narrow_stage(spark):
    frame = spark.createDataFrame([("u", "1")], "url string, n string")
    model = DecisionModel.parse("m", {"n": feature("int", "integer", "0")})
    assert "Exchange" not in to_model(frame, model)._jdf.queryExecution().executedPlan().toString()
