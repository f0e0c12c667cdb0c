from hourgrid.llm import url_filter as uf
from tests.llm.util import compare


def test_query_matches_sql(spark, sf):
    compare(spark, "/root/testdata/sf0.01", "op7_url_reputation")


def test_parts_and_rules(spark):
    urls = ["http://A.Example.org/es/x?y#z", "x://example.org/en/12", "x://notexample.org/es/", "x://org", "x://a.com/fr/1", "x://a.com/de/1",
            "x://a.com/frx", None, "no scheme/org/", "a://b://c/d", "x://É.com?q", "x://u@h:80/p#f", "://", "x://example.org/EN/1"]
    df = spark.createDataFrame([(i, u, "h", "p") for i, u in enumerate(urls)], "page_id long, url string, host string, blocked string")
    none = spark.createDataFrame([], "page_id long, good int")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in uf.judge_urls(df, none).collect()}
    assert got == {
        0: ("a.example.org", "/es/x", "example.org/es/", "block"), 1: ("example.org", "/en/12", "example.org/en/1", "block"),
        2: ("notexample.org", "/es/", "org/", "allow"), 3: ("org", "", None, "allow"), 4: ("a.com", "/fr/1", "com/fr/", "allow"),
        5: ("a.com", "/de/1", "com/de/", "block"), 6: ("a.com", "/frx", None, "allow"), 7: ("", "", None, "allow"), 8: ("", "", None, "allow"),
        9: ("b:", "//c/d", None, "allow"), 10: ("É.com", "", None, "allow"), 11: ("u@h:80", "/p", None, "allow"), 12: ("", "", None, "allow"),
        13: ("example.org", "/EN/1", "org/", "allow")}
    assert uf.judge_urls(df.limit(0), none).count() == 0


def test_bad_hosts_are_blocked_and_small_ones_shrunk(spark):
    rows, labels = [], []
    for host, n, good in (("bad.site.net", 60, 3), ("good.site.net", 60, 57), ("tiny.other.net", 1, 0), ("ok.other.net", 40, 38), ("new.site.net", 0, 0)):
        for i in range(max(n, 1)):
            rows.append((len(rows), f"http://{host}/p{i}"))
            if i < n:
                labels.append((rows[-1][0], int(i < good)))
    pages = spark.createDataFrame(rows, "page_id long, url string")
    got = {r.host: (r.verdict, r.reputation) for r in uf.judge_urls(pages, spark.createDataFrame(labels, "page_id long, good int")).collect()}
    assert got["bad.site.net"][0] == "block" and all(got[h][0] == "allow" for h in got if h != "bad.site.net")
    assert 0.05 < got["bad.site.net"][1] < 0.3 and got["tiny.other.net"][1] > 0.4


def test_outcomes(spark):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, 1, None), (3, 1, 1), (4, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    assert {r.page_id: r.good for r in uf.page_outcomes(labels).collect()} == {1: 0, 2: 1, 3: 0}


def test_domains(spark):
    df = spark.createDataFrame([("a.b.co.uk",), ("co.uk",), ("x",), ("a.b.c.com",), ("",)], "h string")
    got = {r.h: (r.d, r.s) for r in df.select("h", uf.domain_of(uf.F.col("h")).alias("d"), uf.suffix_of(uf.F.col("h")).alias("s")).collect()}
    assert got == {"a.b.co.uk": ("b.co.uk", "co.uk"), "co.uk": ("co.uk", "uk"), "x": ("x", "x"), "a.b.c.com": ("c.com", "com"), "": ("", "")}


def test_sites_of_odd_hosts(spark):
    cases = {"u:p@a.b.com:8080": ("a.b.com", "b.com", "com"), "1.2.3.4": ("1.2.3.4", "1.2.3.4", "1.2.3.4"), "1.2.3.4:80": ("1.2.3.4", "1.2.3.4", "1.2.3.4"),
             "[::1]:443": ("[::1]", "[::1]", "[::1]"), "x.y.com.br": ("x.y.com.br", "y.com.br", "com.br"), "x.co.xyz": ("x.co.xyz", "co.xyz", "xyz"),
             "shop.org.uk": ("shop.org.uk", "shop.org.uk", "org.uk"), "a.b.de": ("a.b.de", "b.de", "de")}
    df = spark.createDataFrame([(h,) for h in cases], "h string").withColumn("site", uf.site_of(uf.F.col("h")))
    got = {r.h: (r.site, r.d, r.s) for r in df.select("h", "site", uf.domain_of(uf.F.col("site")).alias("d"), uf.suffix_of(uf.F.col("site")).alias("s")).collect()}
    assert got == cases


def test_ports_share_a_reputation(spark):
    rows = [(i, f"http://bad.net:{80 + i % 3}/p{i}") for i in range(60)] + [(100 + i, f"http://good.net/p{i}") for i in range(60)]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumnRenamed("url", "the.url")
    labels = spark.createDataFrame([(i, int(i >= 100)) for i, _ in rows], "page_id long, good int")
    got = uf.judge_urls(pages, labels, url_col="the.url").collect()
    assert {r.verdict for r in got if r.page_id < 100} == {"block"} and {r.verdict for r in got if r.page_id >= 100} == {"allow"}
    assert {r.host for r in got if r.page_id < 3} == {"bad.net:80", "bad.net:81", "bad.net:82"}
