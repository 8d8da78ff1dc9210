import re
from collections import defaultdict

from pyspark.sql import functions as F

from pitwall.llm import urls
from pitwall.llm.op8 import RULES


def link(url):
    return f'<html><head><LINK rel="canonical" href="{url}"></head></html>'


def refresh(url):
    return f"<meta http-equiv='refresh' content='0; url={url}'>"


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest)[0]
    return host.translate(str.maketrans(urls.UPPER, urls.LOWER)), re.split(r"[?#]", rest[len(host):])[0]


def brute(rows, edges=()):
    """Verdicts by flooding the alias graph of urls and addresses."""
    def rule(url):
        host, path = parts(url)
        fit = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        return max(fit, key=lambda r: len(r.name)) if fit else None

    def address(url):
        if "://" not in url:
            return ("at", url)
        host, path = parts(url)
        query = re.match(r"[^?#]*(\?[^#]*)?", url).group(1) or ""
        query = "&".join(p for p in query[1:].split("&") if p and not re.match(r"(?i)(utm_[a-z]+|ref|fbclid|gclid)=", p))
        return ("at", re.sub(r"^((www|m)\.)+", "", host) + re.sub(r"(\.html)?/*$", "", path) + ("?" + query if query else ""))

    near = defaultdict(set)
    def join(a, b):
        near[a].add(b)
        near[b].add(a)
    for _, url, html in rows:
        if url is None:
            continue
        join(url, address(url))
        for found in re.findall(r'canonical" href="([^"]+)"|url=([^\']+)', html or ""):
            target = "".join(found).strip()
            join(url, target)
            join(target, address(target))
    for a, b in edges:
        join(a, b)
        join(b, address(b))
    out = []
    for page, url, _ in rows:
        own = rule(url)
        verdict = own.verdict if own else "allow"
        if not own and url is not None:
            seen, todo = {url}, [url]
            while todo:
                for x in near[todo.pop()]:
                    if x not in seen:
                        seen.add(x)
                        todo.append(x)
            given = {r.verdict for x in seen if isinstance(x, str) and x in {u for _, u, _ in rows} and (r := rule(x))}
            verdict = "allow" if "allow" in given or not given else "block"
        out.append((page, *parts(url), own.name if own else None, verdict))
    return sorted(out, key=str)


ROWS = [
    (1, "http://a.net/x", None), (2, "http://b.example.com/en/1", link("http://a.net/x")), (3, "https://B.EXAMPLE.net/en/2", None),
    (4, "http://c.com/", refresh("http://b.example.com/en/1")), (5, "http://www.c.com", None), (6, "http://d.org/fr/9", None),
    (7, "http://e.com/p", link("http://d.org/fr/9")), (8, "http://f.net/q", link("http://e.com/p")), (9, None, link("http://a.net/x")),
    (10, "no scheme", None), (11, "", ""), (12, "http://notexample.com/de/", None), (13, "http://x.example.com/de/5?q=1#t", None),
    (14, "http://example.net/en", None), (15, "http://net/y", None), (16, "http://g.net?x", None), (17, "ftp://h.com:80/a#://b/c", None),
    (1, "http://a.net/x", None), (18, "http://i.com/z.html?utm_source=a&k=2", None), (19, "https://m.i.com/z?k=2&ref=b", link("http://a.net/x")),
    (20, "http://j.com/\n/k", None), (None, "http://a.net/x", None), (21, "http://k.com/a//", None), (22, "http://k.com/a.html", None),
]
SCHEMA = "page_id long, url string, html string, verdict string, key string, host string, root string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "v", "k", "h", "r") for r in rows], SCHEMA).repartition(3)


def test_rules_and_aliases(spark):
    got = urls.judge(pages(spark, ROWS), RULES).collect()
    assert sorted(map(tuple, got), key=str) == brute(ROWS)
    verdict = {r.page_id: r.verdict for r in got}
    assert verdict[2] == verdict[4] == verdict[5] == verdict[18] == "block"  # handed on along aliases
    assert verdict[7] == "allow" and verdict[8] == "block"  # an explicit allow first; own rules always


def test_given_edges_and_empty_tables(spark):
    edges = [("http://c.com/", "http://d.org/fr/9"), ("http://k.com/a", "http://a.net/x")]
    got = urls.judge(pages(spark, ROWS), RULES, edges=spark.createDataFrame(edges, "src string, dst string")).collect()
    assert sorted(map(tuple, got), key=str) == brute(ROWS, edges)
    assert urls.judge(pages(spark, ROWS).limit(0), RULES).collect() == []


def test_no_python_in_the_plan(spark):
    plan = urls.judge(pages(spark, ROWS), RULES)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_targets_are_resolved_against_their_page(spark):
    cases = {
        "http://a.net/x": "http://a.net/x", "HTTPS://B.org/y?q#f": "HTTPS://B.org/y?q#f", "//c.org/z": "https://c.org/z",
        "/about": "https://h.com/about", "next.html": "https://h.com/d/e/next.html", "../up?a=1": "https://h.com/d/up?a=1", "../../../top": "https://h.com/top",
        "./here/": "https://h.com/d/e/here/", "?page=2": "https://h.com/d/e/f?page=2", "#part": "https://h.com/d/e/f?old", "mailto:x@y.z": None, "": None, "  ": None,
        "..": "https://h.com/d/", "/a?b=1&amp;c=2": "https://h.com/a?b=1&c=2"}
    df = spark.createDataFrame([(k, "https://h.com/d/e/f?old#here") for k in cases], "t string, p string")
    got = {r["t"]: r["u"] for r in df.select("t", urls.resolved(F.col("t"), F.col("p")).alias("u")).collect()}
    assert got == cases
    bare = spark.createDataFrame([("/about", "no scheme"), ("/about", None), ("x", "http://h.com")], "t string, p string")
    assert [r[0] for r in bare.select(urls.resolved(F.col("t"), F.col("p"))).collect()] == [None, None, "http://h.com/x"]


def test_relative_and_unquoted_links(spark):
    """Two hosts with the canonical /about are no aliases; an unquoted canonical is read, and every tag."""
    rows = [(1, "http://a.net/x", '<link rel="canonical" href="/about">'), (2, "http://b.com/y", '<link rel="canonical" href="/about">'),
            (3, "http://c.org/z", "<link rel=canonical href=http://a.net/x>"),
            (4, "http://d.org/1", '<link rel="stylesheet" href="http://a.net/x"><LINK href=\'http://a.net/x\' REL="canonical" />'),
            (5, "http://e.org/1", '<link rel="canonical" href="http://e.org/2"><meta content="5;URL=http://a.net/x" http-equiv=refresh>'),
            (6, "http://f.org/1", '<a href="http://a.net/x" title="canonical">'), (7, "http://g.org/1", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.verdict for r in urls.judge(df, RULES).collect()}
    assert got == {1: "block", 2: "allow", 3: "block", 4: "block", 5: "block", 6: "allow", 7: "allow"}
