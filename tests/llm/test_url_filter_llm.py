from footfall.llm.queries import RULES
from footfall.llm.url_filter import LEAST_BLOCKS, blocked_bloom, blocks_for, url_verdicts

LISTED = [("http://bad.org/a/",), ("https://www.worse.net/x?y=1",), (None,), ("nothing",)]


def judge(spark, urls, listed=LISTED, **options):
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rows = url_verdicts(pages, spark.createDataFrame(listed, "url string"), RULES, **options).collect()
    return {r.page_id: r for r in rows}


def test_parts_rules_and_list(spark):
    urls = ["http://Example.COM/en/a?q#f", "https://www.example.com/en/", "http://a.net/es/x",
            "http://bad.org/a", "ftp://m.bad.org/a/#z", "http://bad.org/A", "http://worse.net/x",
            None, "no scheme", "http://", "x://y://z/fr/", "http://example.com", "HTTP://net/fr/"]
    got = judge(spark, urls)
    parts = [(got[i].host, got[i].path, got[i].rule, got[i].verdict) for i in range(len(urls))]
    assert parts == [
        ("example.com", "/en/a", "example.com/en/", "block"),
        ("www.example.com", "/en/", "www.example.com/en/", "allow"),
        ("a.net", "/es/x", "net/es/", "block"), ("bad.org", "/a", None, "block"),
        ("m.bad.org", "/a/", None, "block"), ("bad.org", "/A", None, "allow"),
        ("worse.net", "/x", None, "block"), ("", "", None, "allow"), ("", "", None, "allow"),
        ("", "", None, "allow"), ("y:", "//z/fr/", None, "allow"),
        ("example.com", "", None, "allow"), ("net", "/fr/", "net/fr/", "block")]


def test_a_full_filter_lets_all_through_and_the_join_still_decides(spark):
    listed = [(f"http://h{i}.org/{i}",) for i in range(3000)]
    urls = [f"http://h{i}.org/{i}" for i in range(0, 6000, 7)]
    got = judge(spark, urls, listed, blocks=2)
    assert [got[i].listed for i in range(len(urls))] == [i < 3000 for i in range(0, 6000, 7)]
    assert blocked_bloom(spark.createDataFrame(listed, "url string"), "url", 2).count() == 2


def test_repeated_rows_clashing_names_and_empty_tables(spark):
    pages = spark.createDataFrame(
        [(1, "http://bad.org/a", "h", 5, "k")] * 3, "page_id long, url string, host string, _key int, _k0 string")
    listed = spark.createDataFrame(LISTED, "url string")
    out = url_verdicts(pages, listed, RULES)
    assert out.columns == ["page_id", "url", "_key", "_k0", "host", "path", "rule", "listed", "verdict"]
    assert [tuple(r) for r in out.collect()] == [
        (1, "http://bad.org/a", 5, "k", "bad.org", "/a", None, True, "block")] * 3
    assert url_verdicts(pages.limit(0), listed, RULES).count() == 0
    assert {r.verdict for r in url_verdicts(pages, listed.limit(0), []).collect()} == {"allow"}


def test_the_filter_grows_with_the_list_and_is_joined_beyond_its_bound(spark):
    assert [blocks_for(n) for n in (0, 1, 8 * LEAST_BLOCKS, 8 * LEAST_BLOCKS + 1, 9_000_000)] == [
        LEAST_BLOCKS, LEAST_BLOCKS, LEAST_BLOCKS, 2 * LEAST_BLOCKS, 1 << 21]
    keys = spark.range(80_000).selectExpr("concat('http://h', id, '.org/', id) AS url")
    blocks = blocks_for(80_000)
    assert blocked_bloom(keys, "url", blocks).selectExpr("avg(bit_count(word)) AS bits").first().bits < 0.6 * 64
    listed = [(f"http://h{i}.org/{i}",) for i in range(3000)]
    urls = [f"http://h{i}.org/{i}" for i in range(0, 6000, 7)] + [None, "no scheme"] * 50 + ["http://h7.org/7"] * 200
    rows = [judge(spark, urls, listed, broadcast_blocks=bound) for bound in (1 << 20, 0)]
    assert rows[0] == rows[1] and sum(r.listed for r in rows[0].values()) == 429 + 200


def test_ties_of_rules_and_very_long_urls(spark):
    from pyspark.sql import functions as F

    from footfall.llm.url_filter import first_rule

    rules = [("allow", "a.com", "/bb"), ("block", "x.a.com", "/"), ("block", "a.com", "/bb"), ("allow", "a.com", "/")]
    urls = spark.createDataFrame([("x.a.com", "/bbb"), ("a.com", "/bb" + "b" * 200_000), ("a.com", "/c"), ("b.com", "/")],
                                 "h string, p string")
    got = [r.rule and (r.rule.rule, r.rule.verdict) for r in urls.select(
        first_rule(F.col("h"), F.col("p"), rules).alias("rule")).collect()]
    # of equal length the longer host wins, then block
    assert got == [("x.a.com/", "block"), ("a.com/bb", "block"), ("a.com/", "allow"), None]
    long = "http://" + "h" * 100_000 + ".net/fr/" + "p" * 300_000
    row = judge(spark, [long, long + "?q"], [(long,)])[1]
    assert (len(row.host), len(row.path), row.rule, row.verdict, row.listed) == (100_004, 300_004, "net/fr/", "block", True)
