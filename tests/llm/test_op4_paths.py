"""Host and path come from the same url."""

from stratus.llm.linkgraph import judge
from stratus.llm.registry import URL_RULES


def test_url_in_query_or_fragment(spark):
    urls = {1: ("http://example.com?u=http://q.org/de/1", "example.com", ""), 2: ("http://example.com#x://a/de/", "example.com", ""),
            3: ("http://example.com/en/?u=http://q.org/de/1", "example.com", "/en/"), 4: ("http://example.com/de/1", "example.com", "/de/1"),
            5: ("x" * 50000, "", ""), 6: ("http://" + "y" * 50000, "y" * 50000, "")}
    pages = spark.createDataFrame([(i, u, "") for i, (u, _, _) in urls.items()], "page_id long, url string, html string")
    got = {r.page_id: r for r in judge(pages, URL_RULES).collect()}
    assert {i: (r.host, r.path) for i, r in got.items()} == {i: (h, p) for i, (_, h, p) in urls.items()}
    assert got[1].rule is None and got[2].rule is None and got[4].rule == "example.com/de/"
