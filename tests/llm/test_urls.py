"""URL filters: parts, rules, and what templates learn."""

from pyspark.sql import functions as F

from roadpulse.llm import queries, sql
from roadpulse.llm import urls as U
from roadpulse.llm.queries import URL_RULES


def test_parts(spark):
    given = [
        ("http://A.Example.org/en/1?x=/y#z", "a.example.org", "/en/1"),
        ("ftp://h", "h", ""),
        ("//h/x", "", ""),
        (None, "", ""),
        ("", "", ""),
        ("http://h?q=http://g/p", "h", ""),
        ("a://É.ORG:80/Pfad#http://", "É.org:80", "/Pfad"),
        ("http:///x", "", "/x"),
    ]
    df = spark.createDataFrame([(i, u) for i, (u, *_) in enumerate(given)], "page_id long, url string")
    got = {r["page_id"]: r for r in U.filter_urls(df, []).collect()}
    assert [(got[i]["host"], got[i]["path"]) for i in range(len(given))] == [tuple(g[1:]) for g in given]
    assert {r["verdict"] for r in got.values()} == {"allow"}


def by_hand(host, path):
    fits = [
        (len(h + p), h + p, verdict)
        for verdict, h, p in URL_RULES
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return max(fits)[1:] if fits else (None, None)


def test_rules(spark):
    hosts = ["org", "example.org", "a.example.org", "badexample.org", "x.com", "com", "y.net", ""]
    paths = ["", "/", "/es/", "/es", "/en/1", "/en/12/x", "/fr/a", "/de/a", "/DE/a"]
    rows = [(i, f"http://{h}{p}", h, p) for i, (h, p) in enumerate((h, p) for h in hosts for p in paths)]
    got = {r["page_id"]: r for r in U.filter_urls(spark.createDataFrame([r[:2] for r in rows], "page_id long, url string"), URL_RULES).collect()}
    for i, _, host, path in rows:
        rule, verdict = by_hand(host, path)
        assert got[i]["rule"] == rule
        if rule:
            assert got[i]["verdict"] == verdict


def tree(spark, rows):
    df = spark.createDataFrame(rows, "host string, path string, bad int")
    return {r["template"]: r for r in U.templates(df).collect()}


def test_ids_become_wildcards_and_bad_templates_are_rejected(spark):
    rows = [("h", f"/shop/{i}.html", 1) for i in range(40)] + [("h", f"/news/{i}/text", 0) for i in range(40)]
    rows += [("h", "/shop/77777", None), ("g", "/shop/1", None)]
    got = tree(spark, rows)
    assert got["/shop/*.html"]["verdict"] == "block" and got["/news/*/text"]["verdict"] == "allow"
    assert got["/shop/*"]["verdict"] == "allow"


def test_alike_siblings_merge_and_unlike_ones_do_not(spark):
    rows = [("h", f"/{c}/x", 1) for c in "ab" for _ in range(30)] + [("h", "/c/x", 0)] * 30 + [("h", "/d/x", None)]
    got = tree(spark, rows)
    assert got["/c/x"]["verdict"] == "allow" and got["/d/x"]["verdict"] == "allow"
    merged = tree(spark, [("h", f"/{c}/x", 1) for c in "ab" for _ in range(30)] + [("h", "/d/x", None)])
    assert merged["/*/x"]["seen"] == 60 and merged["/*/x"]["verdict"] == "block"
    assert merged["/d/x"]["verdict"] == "allow"


def test_varied_segments_and_deep_paths(spark):
    got = tree(spark, [("h", f"/user/{chr(97 + i)}name/home", 1) for i in range(20)] + [("h", "/a/b/c/d/e/f", 0)])
    assert got["/user/*/home"]["seen"] == 20
    assert "/a/b/c/d/e/f" in got


def test_shapes(spark):
    given = {"123": "*", "148.html": "*.html", "deadbeef01": "*", "about": "about", "v2": "v2", "x" * 45: "*", "": ""}
    df = spark.createDataFrame([(k,) for k in given], "s string")
    assert {r[0]: r[1] for r in df.select("s", U.shape(F.col("s"))).collect()} == given


def test_nulls_repeats_empty_and_clashing(spark):
    rows = [(None, None, "x"), (1, "http://h/1", "y"), (1, "http://h/1", "y")]
    df = spark.createDataFrame(rows, "page_id long, url string, host string")
    assert len(U.filter_urls(df, URL_RULES).collect()) == 3
    assert U.filter_urls(df.limit(0), URL_RULES).collect() == []


def test_labels_differ_below_the_fourth_segment(spark):
    rules = [("block", "h.example", "/a/b/c/d/bad/"), ("allow", "h.example", "/a/b/c/d/good/")]
    tails = [*(f"bad/x/{i}" for i in range(30)), *(f"good/x/{i}" for i in range(30)), "", "good", "bad", "e/f/g/h/i/j"]
    paths = [f"/a/b/c/d/{t}" for t in tails] + ["/" + "/".join("abc"[i % 3] for i in range(60)), "/a", ""]
    rows = [(i, f"http://h.example{p}") for i, p in enumerate(paths)]
    got = {r["path"]: r for r in U.filter_urls(spark.createDataFrame(rows, "page_id long, url string"), rules, back_off=False).collect()}
    assert len(got) == len(paths)
    assert {got[p]["template"] for p in paths[:30]} == {"/a/b/c/d/bad/x/*"}
    assert {got[p]["template"] for p in paths[30:60]} == {"/a/b/c/d/good/x/*"}
    assert got[paths[0]]["share"] == 31 / 34 and got[paths[30]]["share"] == 1 / 34
    assert all(got[p]["template"] == p.rstrip("/") for p in paths[60:])
    assert {got[p]["share"] for p in paths[60:]} == {0.25}


def test_segments_that_a_branch_shares_take_one_step(spark, monkeypatch):
    """Two urls with 2,000 equal segments are as few tables as two with five."""
    written = []
    plain = U.written_out
    monkeypatch.setattr(U, "written_out", lambda df, label: written.append(label) or plain(df, label))
    counts = []
    for shared in (5, 2_000):
        trunk = "/" + "/".join(f"s{i % 7}x" for i in range(shared))
        urls = [f"http://h.example{trunk}/{t}" for t in ("a/b", "a/c", "d")] + ["http://h.example/z", f"http://h.example{trunk}"]
        df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
        got = {r["page_id"]: r["template"] for r in U.filter_urls(df, [("block", "h.example", "/z")]).collect()}
        assert got == {i: u.removeprefix("http://h.example") for i, u in enumerate(urls)}
        counts.append(len(written))
        written.clear()
    assert counts[0] == counts[1] <= 7


def test_pages_without_a_rule_get_other_verdicts_and_paths_fit_the_sql(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    found = queries.op8_url_filters(spark, "/root/testdata/sf0.1").where("rule IS NULL")
    assert {r["verdict"] for r in found.select("verdict").distinct().collect()} == {"allow", "block"}
    deepest = pages.select(F.max(F.size(U._segments(U.path_of(F.col("url")))))).first()[0]
    assert deepest <= sql.URL_LEVELS


def test_a_branch_without_labels_backs_off(spark):
    rules = [("block", "spam.example", "/de/"), ("allow", "good.example", "/de/")]
    urls = [f"http://{h}/de/{i}" for h in ("a.spam.example", "good.example") for i in range(40)]
    asked = {
        "http://a.spam.example/en/1": "block",
        "http://b.spam.example/x": "block",
        "http://good.example/en/1": "allow",
        "http://b.good.example/x": "allow",
        "http://other.test/x": "allow",
    }
    rows = list(enumerate([*urls, *asked]))
    df = spark.createDataFrame(rows, "page_id long, url string")
    got = {r["page_id"]: r for r in U.filter_urls(df, rules, back_off=True).collect()}
    assert len(got) == len(rows)
    assert {u: got[i]["verdict"] for i, u in rows if u in asked} == asked
    assert all(got[i]["rule"] is None for i, u in rows if u in asked)
    assert got[len(rows) - 1]["share"] == 0.5
    assert U.filter_urls(df.limit(0), rules, back_off=True).collect() == []


def test_domains(spark):
    given = {"a.b.example.com": "example.com", "x.co.uk": "x.co.uk", "a.x.co.uk": "x.co.uk", "h": "h", "": "", "10.0.0.1:80": "10.0.0.1", "a.b.org:8": "b.org"}
    df = spark.createDataFrame([(k,) for k in given], "h string")
    assert {r[0]: r[1] for r in df.select("h", U.domain_of(F.col("h"))).collect()} == given
