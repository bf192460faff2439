import re


from shopsight.llm import urls


def brute(url):
    u = url or ""
    if "://" not in u:
        return "", "", None
    rest = u.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):], re.S)[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [h + p for _, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits, key=len, default=None)


URLS = [None, "", "abc", "http://", "http://NET", "http://net/", "http://a.NET/x?y", "x://y://z/en/", "http://planet/",
        "https://example.net/en/1", "https://a.example.net/en", "http://b.example.com/de/1#x", "http://b.example.com/dex",
        "http://org/fr/", "http://x.org/fr/a//b/../c", "http://É.Org/fr/1", "http://h?q/r", "http://h#/net/",
        "http://q.org/en/" + "s/" * 3000, "http://q.net:80/en/", "http://u@example.net/en/x"]


def test_host_path_and_rule(spark):
    rows = [(i, u, "x") for i, u in enumerate(URLS)] + [(0, None, "x"), (None, URLS[5], "y")]
    df = spark.createDataFrame(rows, "page_id long, url string, host string")
    out = urls.judge(df)
    got = out.select("url", "judged").collect()
    assert len(got) == len(rows) and out.columns == [*df.columns, "judged"]
    verdicts = {h + p: v for v, h, p in urls.RULES}
    for r in got:
        j = r.judged
        assert (j.host, j.path, j.rule) == brute(r.url), r.url
        assert j.verdict == (verdicts[j.rule] if j.rule else "allow")
    assert urls.judge(df.limit(0)).count() == 0


def test_templates_generalise_and_blocked_ones_are_rejected(spark):
    rules = (("block", "shop.test", "/ads/1"), ("allow", "shop.test", "/news/1"))
    rows = [f"http://shop.test/ads/{n}/view" for n in range(1, 80)]  # 1, 10-19 blocked by the rule
    rows += [f"http://shop.test/news/{n}/view" for n in range(1, 80)]
    rows += [f"http://shop.test/wiki/{w}" for w in map(str, ["alpha" + chr(97 + i) for i in range(25)])]
    df = spark.createDataFrame([(u,) for u in rows], "url string")
    tree = urls.Tree(min_labelled=5, prior_weight=1.0, max_label_gap=0.3)
    got = {r.url: r.judged for r in urls.judge(df, rules=rules, tree=tree).collect()}
    assert got["http://shop.test/ads/50/view"].template.endswith("/<number>/view")
    assert got["http://shop.test/ads/50/view"].verdict == "block"
    assert got["http://shop.test/news/50/view"].verdict == "allow"
    assert got["http://shop.test/wiki/alphac"].template.endswith("/<any>")
    assert got["http://shop.test/wiki/alphac"].verdict == "allow"


def test_a_host_of_any_size_gets_the_same_verdicts(spark):
    """A rule that names one branch says nothing of its siblings of like shape."""
    rules = (("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
    verdicts = []
    for times in (1, 10):
        rows = [f"http://blog.example.com/{lang}/{n}" for lang, pages in (("de", 42), ("en", 150), ("fr", 70), ("es", 58))
                for n in range(pages * times)]
        rows += [f"http://shop.example.com/{word}/x{w}y" for word in ("de", "en") for w in range(30 * times)]
        rows += [f"http://a.org/fr/{n}" for n in range(60 * times)]
        df = spark.createDataFrame([(u,) for u in rows], "url string")
        got = {("/".join(r.url.split("/")[2:4]), r.judged.verdict) for r in urls.judge(df, rules=rules).select("url", "judged").collect()}
        verdicts.append(got)
    assert verdicts[0] == verdicts[1]
    assert {host for host, verdict in verdicts[1] if verdict == "block"} == {"blog.example.com/de", "shop.example.com/de"}


def test_a_rare_word_that_a_rule_names_is_not_its_rare_siblings(spark):
    rules = (("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
    words = ["de", *("".join(chr(97 + (i // 26**k) % 26) for k in range(3)) for i in range(40))]
    rows = [f"http://example.com/{w}/{n}" for w in words for n in range(300 if w == "de" else 120)]
    df = spark.createDataFrame([(u,) for u in rows], "url string")
    blocked = {r.url.split("/")[3] for r in urls.judge(df, rules=rules).select("url", "judged").collect() if r.judged.verdict == "block"}
    assert blocked == {"de"}
