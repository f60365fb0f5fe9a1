import duckdb

from weblode.llm import host_graph

PAGES = [
    (1, "http://a.com/x", '<a href="http://good.org/">'),
    (2, "https://B.net/es/1?q#f", '<a HREF = //bad.org/x> <a href=rel>'),
    (3, "https://bad.org/1", "<a href='https://b.net/es/1'>"),
    (4, "http://good.org", None),
    (5, "http://m.bad.org/?x", ""),
    (6, None, "<a href='http://a.com'>"),
    (7, "no address", None),
    (8, "http://example.com/en/a", ""),
    (9, "http://www.example.com/en/a", ""),
    (10, "http://x.www.example.com/en/a", ""),
    (11, "http://example.com", ""),
    (12, "http://notexample.com/en/a#://y.net/es/", ""),
    (13, "x://://a", ""),
    (13, "x://://a", ""),
]


def test_rules_and_verdicts(spark):
    frame = spark.createDataFrame([(*p, "h", None) for p in PAGES], "page_id long, url string, html string, host string, _bad string")
    judged = host_graph.judged_pages(frame)
    got = {r.page_id: r for r in judged.collect()}
    assert judged.count() == len(PAGES) and got[1]["_bad"] is None
    assert (got[2].host, got[2].path, got[2].rule, got[2].verdict) == ("b.net", "/es/1", "net/es/", "block")
    assert [got[i].rule for i in (1, 4, 6, 7, 8, 9, 10, 11, 12)] == ["com/", None, None, None, "example.com/en/", *["www.example.com/en/"] * 2, None, "com/"]
    assert (got[6].host, got[6].path, got[6].verdict, got[7].host, got[13].host) == ("", "", "allow", "", ":")
    # bad.org links to a blocked page, good.org is linked from a trusted one; m.bad.org is its host's kin.
    assert (got[3].verdict, got[4].verdict, got[5].verdict) == ("block", "allow", "block")


def test_rows_equal_sql(spark):
    frame = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    got = sorted(map(tuple, host_graph.judged_pages(frame).select("page_id", "host", "path", "rule", "verdict").collect()), key=str)
    db = duckdb.connect()
    db.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    db.executemany("INSERT INTO pages VALUES (?, ?, ?)", PAGES)
    assert got == sorted(db.execute(host_graph.oracle()).fetchall(), key=str)


def test_empty_table_and_plan(spark):
    frame = spark.createDataFrame([], "page_id long, url string, html string")
    assert host_graph.judged_pages(frame).count() == 0
    plan = host_graph.judged_pages(spark.createDataFrame(PAGES, "page_id long, url string, html string"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_distrust_reaches_the_end_of_a_long_chain(spark):
    chain = [(i, f"http://h{i}x.org/", f"<a href='http://h{i + 1}x.org/'>") for i in range(11)]
    others = [(100 + i, f"http://o{i}x.org/", "") for i in range(100)]
    frame = spark.createDataFrame([*chain, (11, "http://h11x.org/bad", ""), *others], "page_id long, url string, html string")
    rules = (("block", "h11x.org", "/bad"),)
    got = {r.page_id: r.verdict for r in host_graph.judged_pages(frame, rules).collect()}
    # 11 links from the seed there is 0.15 * 0.85**11 of the mass, 2.5%, against a margin of 0.22%.
    assert got == {i: "block" for i in range(12)} | {100 + i: "allow" for i in range(100)}
