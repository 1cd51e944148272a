import re

from hypothesis import given, settings
from hypothesis import strategies as st

from cinerank.llm import urlfilter
from cinerank.llm.queries import URL_RULES


def judge(url, rules=URL_RULES):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url) if url is not None else None
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in m[1]) if m else ""
    path = m[2] if m else ""
    fits = [(len(h + p), h + p, v) for v, h, p in rules if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, None, "allow"))
    return host, path, best[1], best[2]


HOSTS = ["example.org", "EXAMPLE.org", "a.example.org", "notexample.org", "org", "com", "x.com", "", ".org", "a..com", "É.com", "example.org:80"]
PATHS = ["", "/", "/es/", "/es", "/en/1", "/en/12/x", "/EN/1", "/fr/a", "/de/", "/de/é", "//"]
URLS = st.one_of(st.none(), st.builds(lambda s, h, p, t: s + h + p + t, st.sampled_from(["http://", "https://", "://", "", "a://b://"]),
                                      st.sampled_from(HOSTS), st.sampled_from(PATHS), st.sampled_from(["", "?q=/de/", "#x", "?://com/de/"])))


@settings(max_examples=5, deadline=None)
@given(st.lists(URLS, min_size=1, max_size=60))
def test_equals_brute_force(spark, urls):
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)], "page_id long, url string, host string, rule string")
    got = sorted(urlfilter.judge_urls(pages, urlfilter.rule_table(spark, URL_RULES)).collect())
    assert [tuple(r)[1:] for r in got] == [judge(u) for u in urls]


def test_edge_rows(spark):
    rules = urlfilter.rule_table(spark, [*URL_RULES, ("block", None, "/"), ("block", "org", "/"), ("allow", "org", "/")])
    rows = [(1, "http://a.org/" + "x" * 100_000), (1, "http://a.org/" + "x" * 100_000), (None, "http://" + "a." * 2000 + "com/fr/"), (2, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    got = sorted(urlfilter.judge_urls(pages, rules).select("page_id", "rule", "verdict").collect(), key=str)
    assert [tuple(r) for r in got] == [(1, "org/", "block")] * 2 + [(2, None, "allow"), (None, "com/fr/", "allow")]
    assert urlfilter.judge_urls(pages.limit(0), rules).count() == 0
