import gzip
import json

from pyspark.sql import functions as F

from weblode.config import load_model, load_site
from weblode.operators.vocabulary import KINDS, gazetteer_names, vocabulary
from weblode.plans.loads import reingest
from weblode.operators.index import read_index
from weblode.sources import readers, writers


def test_json_directory_at_any_depth(spark, tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    (tmp_path / "a" / "b" / "1.json").write_text(json.dumps({"url": "u1", "n": 1}, indent=2))
    (tmp_path / "a" / "2.json").write_bytes(b'{"url": "caf\xff\xc3\xa9", "n": 2}')
    (tmp_path / "3.json").write_text('{"url": "u3", "extra": [1], "n": null}')
    (tmp_path / "4.txt").write_text('{"url": "u4", "n": 4}')
    (tmp_path / "5.json.gz").write_bytes(gzip.compress(b'{"url": "u5", "n": 5}'))
    rows = readers.read_json_directory(spark, str(tmp_path), "url string, n int").collect()
    assert {(r["url"], r["n"]) for r in rows} == {("u1", 1), ("café", 2), ("u3", None), ("u4", 4), ("u5", 5)}
    assert len({r["file_path"] for r in rows}) == 5


def test_gazetteer_and_export(spark, tmp_path):
    cities = [{"country": "NO", "name": "Oslo", "subcountry": "Oslo", "geonameid": 2}, {"country": "NO", "name": "Bergen", "subcountry": "V", "geonameid": 1}]
    (tmp_path / "cities.json").write_text(json.dumps(cities))
    (tmp_path / "universities.json").write_text(json.dumps([{"name": "B U", "web": []}, {"name": "A U"}]))
    tables = {
        "cities": readers.read_gazetteer(spark, str(tmp_path / "cities.json")),
        "universities": readers.read_gazetteer(spark, str(tmp_path / "universities.json"), readers.UNIVERSITIES),
    }
    names = {k: [r["value"] for r in gazetteer_names(tables[t], c).collect()] for k, (t, c) in KINDS.items()}
    assert names == {
        "country": ["NO"], "city": ["Bergen", "Oslo"], "geonameid": [1, 2], "province": ["Oslo", "V"], "university": ["A U", "B U"],
    }
    hits = [{"topic": "Heart Disease", "_source": {"topic": "Hidden Thing"}}, {"topic": ["Lung Cancer", "x"]}, {}]
    (tmp_path / "export.json").write_text(json.dumps({"hits": {"total": 3, "hits": hits}}))
    export = readers.read_index_export(spark, str(tmp_path / "export.json"), "topic")
    assert export.count() == 3
    got = {r["value"] for r in vocabulary(export.where("topic is not null"), "topic", [","]).collect()}
    assert got == {"Heart", "Disease", "Lung", "Cancer"}


def test_json_and_csv_files(spark, tmp_path):
    found = spark.createDataFrame([("u1", " pad ", None, [None]), ("u2", 'q"uote,', 3, ["a"])], "url string, t string, n int, l array<string>")
    writers.write_json(found, str(tmp_path), "m", missing="N/A")
    writers.write_json(found.limit(1), str(tmp_path), "m")
    lines = [json.loads(line) for p in (tmp_path / "m").glob("*.json") for line in p.read_text().splitlines()]
    assert len(lines) == 3 and {"url": "u1", "t": " pad ", "n": None, "l": [None]} in lines
    writers.write_csv(found, str(tmp_path / "m.csv"), ["l", "url", "t"], missing="N/A")
    writers.write_csv(found, str(tmp_path / "none.csv"), [])
    assert not (tmp_path / "none.csv").exists()
    text = sorted(line for p in (tmp_path / "m.csv").glob("*.csv") for line in p.read_text().splitlines())
    assert text == ['"[""a""]",u2,"q""uote,"', "[null],u1, pad "]


def test_vocabulary_file(spark, tmp_path):
    writers.write_vocabulary(spark.createDataFrame([("b",), ("a",), ("b",)], "value string"), str(tmp_path / "v"))
    assert sorted(r["value"] for r in spark.read.json(str(tmp_path / "v")).collect()) == ["a", "b"]


def test_raw_bytes_are_decoded(spark, tmp_path):
    raw = spark.createDataFrame([("u", bytearray("é", "latin-1"))], "url string, html binary")
    raw.write.parquet(str(tmp_path / "p"))
    assert readers.read_pages(spark, str(tmp_path / "p")).first()["html"] == "é"


def test_last_record_of_a_file_is_taken(spark, tmp_path):
    lines = [json.dumps({"url": f"u{i % 7}", "n": i}) for i in range(2000)]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "all.txt").write_text("\n".join(lines))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        reingest(spark, str(tmp_path / "in"), "url string, n int", "url", str(tmp_path / "index"), per_file=False)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    got = {r["url"]: r["n"] for r in read_index(spark, str(tmp_path / "index")).collect()}
    assert got == {f"u{i % 7}": i for i in range(2000)}


def test_reingest_takes_the_last_file(spark, tmp_path):
    for name, n in (("a", 1), ("c", 3), ("b", 2)):
        (tmp_path / "in" / name).mkdir(parents=True)
        (tmp_path / "in" / name / "r.json").write_text(json.dumps({"url": ["u"], "n": [n]}))
    reingest(spark, str(tmp_path / "in"), "url array<string>, n array<int>", "url", str(tmp_path / "index"))
    assert [tuple(r) for r in read_index(spark, str(tmp_path / "index")).select("id", "n").collect()] == [("u", [3])]


def test_configuration_files(spark, tmp_path):
    from tests.test_extract import SITE

    (tmp_path / "config.json").write_text(json.dumps({"one": SITE}, indent=1))
    assert load_site(spark, str(tmp_path / "config.json"), "one").seed == "http://s.example/"
    model = {"m": {"f": {"scoreCalculation": {"datatype": "int"}, "schemaMapping": {"schemaDataType": "integer"}}}}
    (tmp_path / "models.json").write_text(json.dumps(model))
    assert load_model(spark, str(tmp_path / "models.json"), "m").features[0].schema_type == "integer"
