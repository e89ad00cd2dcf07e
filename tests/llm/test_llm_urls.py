"""URL parts, rules and the template tree against a plain version."""

import math
import re
from collections import defaultdict

from pyspark.sql import functions as F

from reknit.llm import urls
from reknit.llm.queries import URL_RULES


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3:]
    host = re.match(r"(?s)[^/?#]*", rest)[0]
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    return lowered, re.match(r"(?s)[^?#]*", rest[len(host):])[0]


def plain_rule(host, path):
    fits = [rule for rule, _ in URL_RULES for name, _, rest in [rule.partition("/")]
            if (host == name or host.endswith("." + name)) and path.startswith("/" + rest)]
    return max(fits, key=len, default=None)


def shape(path):
    parts = re.sub("[0-9]+", "#", re.sub("^/", "", path)).split("/")
    return tuple(parts) if len(parts) <= urls.DEPTH else tuple(
        parts[:urls.DEPTH - 1] + ["/".join(parts[urls.DEPTH - 1:])])


def plain_tree(pages, labels):
    """Template and smoothed bad share by (host, shape)."""
    count, bad, told = defaultdict(int), defaultdict(int), defaultdict(int)
    for host, path in pages:
        count[host, shape(path)] += 1
    for host, path, value in labels:
        if value in (0, 1) and (host, shape(path)) in count:
            bad[host, shape(path)] += value
            told[host, shape(path)] += 1
    template = {node: "" for node in count}
    for level in range(urls.DEPTH):
        nodes = defaultdict(lambda: defaultdict(lambda: [0, 0, 0]))
        for host, own in count:
            if len(own) > level:
                sums = nodes[host, template[host, own]][own[level]]
                for k, value in enumerate((count, bad, told)):
                    sums[k] += value[host, own]
        names = {}
        for node, segments in nodes.items():
            total = sum(n for n, _, _ in segments.values())
            kept = sorted(((b + 1) / (t + 2), name, t) for name, (n, b, t) in segments.items()
                          if n >= urls.LEAST_PAGES and n >= urls.LEAST_SHARE * total)
            branches = []
            for k, (share, name, t) in enumerate(kept):
                before = kept[k - 1] if k else None
                if not before or (t and before[2] and share - before[0] > urls.SAME**0.5 * (
                        1 / math.sqrt(t) + 1 / math.sqrt(before[2]))):
                    branches.append([])
                branches[-1].append(name)
            names[node] = {name: "|".join(sorted(b)) for b in branches for name in b}
        template = {(host, own): f"{so_far}/{names[host, so_far].get(own[level], '*')}"
                    if len(own) > level else so_far for (host, own), so_far in template.items()}
    everywhere = sum(bad.values()) / max(sum(told.values()), 1)
    shares = {}
    for host, own in count:
        def total(value, same):
            return sum(n for key, n in value.items() if key[0] == host and same(key))
        prior = (total(bad, lambda k: True) + urls.SMOOTHING * everywhere) / (
            total(told, lambda k: True) + urls.SMOOTHING)
        mine = lambda key: template[key] == template[host, own]
        shares[host, own] = (total(bad, mine) + urls.SMOOTHING * prior) / (
            total(told, mine) + urls.SMOOTHING)
    return template, shares


def pages():
    out = []
    for k in range(60):
        out.append(f"http://shop.example.org/item/{k}")
        out.append(f"https://shop.example.org/spam/{k}.html?x=/y")
        out.append(f"http://Shop.Example.org/{chr(97 + k % 26) * (k + 1)}/x")
        out.append(f"http://news.example.com/{('en', 'es', 'de')[k % 3]}/a/{k % 5}#t")
    out += [None, "", "no scheme", "http://", "://?q", "http://a.net", "http://a.net/", "http://net/x",
            "http://anet/", "x://example.net/en/1://b", "http://m.example.com/de/", "http://org/fr/",
            "http://É.ORG/fr/é", "http://h/" + "/".join("abcdefghijklmn"), "http://h//a//",
            "http://h/line\nbreak", "http://h/" + "deep/" * 3000]
    return out * 2


def test_parts_and_rules(spark):
    frame = spark.createDataFrame([(u,) for u in pages()], "url string")
    host, path = urls.host_of(F.col("url")), urls.path_of(F.col("url"))
    for row in frame.select("url", host.alias("h"), path.alias("p"), urls.rule_of(
            host, path, URL_RULES).alias("r")).collect():
        assert (row.h, row.p) == plain_parts(row.url)
        assert row.r == plain_rule(row.h, row.p), row.url


def test_verdicts_as_plain_tree(spark):
    rows = [(k, url) for k, url in enumerate(pages())] + [(None, "http://h/1")]
    parts = [plain_parts(url) for _, url in rows]
    labels = [(h, p, int(p.startswith("/spam"))) for h, p in parts[:200] if "shop" in h]
    labels += [(h, p, int(p.startswith("/de"))) for h, p in parts[:150] if "news" in h]
    labels += [("nowhere", "/x", 1), ("h", "/1", None)]
    table = spark.createDataFrame(rows, "page_id long, url string").selectExpr(
        "*", "1 AS host", "2 AS verdict", "3 AS shape")
    told = spark.createDataFrame(labels, "host string, path string, bad int")
    found = urls.filter_urls(table, told, URL_RULES).collect()
    assert len(found) == len(rows)
    template, shares = plain_tree(parts, labels)
    texts = dict(rows)
    verdicts = dict(URL_RULES)
    for row in found:
        key = row.host, shape(row.path)
        assert (row.host, row.path) == plain_parts(texts[row.page_id])
        assert row.template == template[key]
        assert abs(row.bad_share - shares[key]) < 1e-12
        rule = plain_rule(row.host, row.path)
        assert row.verdict == (verdicts[rule] if rule else
                               "block" if shares[key] > urls.MOST_BAD else "allow")
    judged = {(row.host, row.template): row.verdict for row in found if not row.rule}
    assert judged["shop.example.org", "/spam/#.html"] == "block"
    assert judged["shop.example.org", "/item/#"] == "allow"
    assert judged["shop.example.org", "/*/x"] == "allow"


def test_empty_tables(spark):
    table = spark.createDataFrame([(1, "http://a/b")], "page_id long, url string")
    told = spark.createDataFrame([], "host string, path string, bad int")
    assert [r.verdict for r in urls.filter_urls(table, told, URL_RULES).collect()] == ["allow"]
    assert urls.filter_urls(table.limit(0), told, URL_RULES).count() == 0


def verdicts(spark, pages, labels):
    """Verdicts by path, and templates by path, of a host's (path, pages) and (path, bad, good)."""
    table = spark.createDataFrame(pages, "path string, n int").selectExpr(
        "concat('http://one.example.edu', path) AS url", "explode(sequence(1, n)) AS page_id")
    told = spark.createDataFrame(labels, "path string, b int, g int").selectExpr(
        "'one.example.edu' AS host", "path",
        "explode(concat(array_repeat(1, b), array_repeat(0, g))) AS bad")
    found = urls.filter_urls(table, told, []).select("path", "verdict", "template").distinct()
    rows = found.collect()
    assert len(rows) == len(pages)
    return {r.path: r.verdict for r in rows}, {r.path: r.template for r in rows}


def test_siblings_without_labels_are_no_bridge(spark):
    pages = [("/good", 50), ("/new", 50), ("/spam", 50)]
    found, names = verdicts(spark, pages, [("/good", 0, 1000), ("/spam", 1000, 0)])
    assert found == {"/good": "allow", "/new": "allow", "/spam": "block"}
    assert names == {path: path for path, _ in pages}
    found, _ = verdicts(spark, pages, [("/good", 0, 1000), ("/spam", 1100, 0)])
    assert (found["/good"], found["/spam"]) == ("allow", "block")


def test_siblings_do_not_chain(spark):
    pages = [(f"/{chr(97 + k)}", 10) for k in range(21)]
    found, names = verdicts(spark, pages, [
        (path, 2 * k, 40 - 2 * k) for k, (path, _) in enumerate(pages)])
    assert found["/a"] == "allow" and found["/u"] == "block"
    assert names["/a"] != names["/k"] != names["/u"]


def test_labels_keep_small_branches(spark):
    # A branch of 1 % of the pages, and one that is small beside another with most of the labels.
    pages = [("/good", 3000), ("/spam", 40), ("/ads", 40), ("/rare", 3), ("/few", 30)]
    found, names = verdicts(spark, pages, [
        ("/good", 0, 500), ("/spam", 2000, 0), ("/ads", 40, 0), ("/rare", 0, 1), ("/few", 1, 0)])
    assert (found["/good"], found["/spam"], found["/ads"]) == ("allow", "block", "block")
    assert names["/rare"] == names["/few"] == "/*"


def test_many_equal_sections_are_judged_by_their_labels(spark):
    names = [f"/{a}{b}" for a in "abcdefghij" for b in "abcdefghij"]
    bad = set(names[::9])
    found, templates = verdicts(spark, [(name, 6) for name in names], [
        (name, 30, 0) if name in bad else (name, 0, 30) for name in names])
    assert {name for name, verdict in found.items() if verdict == "block"} == bad
    assert len(set(templates.values())) == 2
