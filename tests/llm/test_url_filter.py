import duckdb
from pyspark.sql import functions as F

from layerhouse.llm import url_filter
from layerhouse.llm.queries import QUERIES, SQL, URL_RULES
from tests.llm.conftest import SF


def duck(pages, labels) -> list:
    con = duckdb.connect()
    con.register("pages", pages)
    con.register("labels", labels)
    return sorted(con.execute(url_filter.oracle(URL_RULES)).fetchall(), key=str)


def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    for name in ("pages", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    found = QUERIES["op2_url_filter"](spark, SF)
    assert found.columns == ["page_id", "host", "path", "rule", "verdict"]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(con.execute(SQL["op2_url_filter"]).fetchall(), key=str)


URLS = [
    None, "", "no scheme", "http://", "http://EXAMPLE.org", "https://a.Example.ORG/es/x?y=/z", "x://y://example.org/es/",
    "http://example.org/en/1", "http://example.org/en/12#x", "http://notexample.org/es/", "http://b.com/fr/1", "http://b.com/de/1",
    "http://com/de/", "http://b.com:80/fr/", "http://user@c.co.uk/fr/", "http://1.2.3.4/a", "http://b.com?q=/de/", "ftp://b.com/DE/",
    "http://a.\nb.com/fr/", "//b.com/de/"]


def frames(spark):
    pages = [(i, u) for i, u in enumerate(URLS)] + [(100 + i, f"http://bad.net/{i}") for i in range(60)]
    pages += [(200 + i, f"http://good.net/{i}") for i in range(60)] + [(None, "http://b.com/de/2"), (100, "http://bad.net/0")]
    labels = [(100 + i, 0, None) for i in range(60)] + [(200 + i, 1, 0) for i in range(60)] + [(None, 0, 0), (5, None, 1), (100, 0, 0)]
    frame = spark.createDataFrame(pages, "page_id long, url string").withColumns({"host": F.lit("clash"), "_id": F.lit(1)})
    return frame, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_odd_urls_hosts_and_labels(spark):
    pages, labels = frames(spark)
    found = url_filter.judge(pages, labels, URL_RULES)
    rows = found.collect()
    assert sorted(map(tuple, rows), key=str) == duck(pages.select("page_id", "url").toPandas(), labels.toPandas())
    by_id = {r.page_id: r for r in rows if r.page_id is not None and r.page_id < 100}
    assert [(by_id[i].host, by_id[i].path) for i in (0, 1, 2, 3, 4, 6)] == [
        ("", ""), ("", ""), ("", ""), ("", ""), ("example.org", ""), ("y:", "//example.org/es/")]
    assert {i: (by_id[i].rule, by_id[i].verdict) for i in (5, 7, 8, 9, 10, 11, 12)} == {
        5: ("example.org/es/", "block"), 7: ("example.org/en/1", "block"), 8: ("example.org/en/1", "block"), 9: ("org/", "allow"),
        10: ("com/fr/", "allow"), 11: ("com/de/", "block"), 12: ("com/de/", "block")}
    verdicts = {r.host: r.verdict for r in rows}
    assert verdicts["bad.net"] == "block" and verdicts["good.net"] == "allow" and verdicts[""] == "allow"


def test_no_pages_no_labels_no_rules(spark):
    pages, labels = frames(spark)
    assert url_filter.judge(pages.limit(0), labels, URL_RULES).count() == 0
    free = url_filter.judge(pages, labels.limit(0), [])
    assert free.filter("verdict <> 'allow' OR rule IS NOT NULL").count() == 0 and free.count() == pages.count()


def test_one_bad_page_does_not_block_a_host(spark):
    pages = spark.createDataFrame([(i, f"http://h{i % 50}.net/{i}") for i in range(500)], "page_id long, url string")
    labels = spark.createDataFrame([(i, 0 if i == 7 else 1) for i in range(0, 500)], "doc_id long, quality int")
    assert url_filter.judge(pages, labels, []).filter("verdict = 'block'").count() == 0


def test_no_python_in_the_plan(spark):
    plan = QUERIES["op2_url_filter"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop"))
