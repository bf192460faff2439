from shopsight.llm.html import Page, Templates, extract


def page(body):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body>{body}</body></html>"


def test_article_without_the_rest():
    source = page(
        '<header>Site</header><nav><ul><li>Menu</ul></nav><div class="cookie-notice">C</div><main><article><header><h1>T&eacute; &amp; x</h1>'
        '</header><p>a<b>b</b>c<p>d<br>e<div class="ad">no</div><script>var t="</article>";</script><form>f</form><aside>s</aside>'
        'a < b<table><tr><td>1<td>2</table><a href="x>y">l</a>w&nbsp;q<section id="comments"><article><p>rc</article></section>'
        "</article></main><footer>F</footer>")
    assert Page(source).text() == "Té & x abc d e a < b 1 2 lw q"


def test_pages_without_an_article_and_broken_ones():
    assert Page(page("<div>one</div><p>two")).text() == "one two"
    assert Page('<p>x</p><p class="y z').text() == "x"
    assert Page("").text() == "" and Page("<<>>&lt;").text() == "<<>><"
    assert Page("<p>a<!-- never ends").text() == "a"
    assert Page("<article><p>a</div></section>b</article>c").text() == "a b"
    assert Page("<article>" + "<div>" * 5000 + "deep").text() == "deep"
    long = "word " * 100_000
    assert Page(f"<article><p>{long}</article>").text() == long.strip()


def test_site_templates_are_deleted_but_copied_paragraphs_stay(spark):
    rows = []
    for i in range(20):
        body = f"<div><p>Subscribe to the gazette</p></div><div><p>Story {i} begins</p><p>Shared line</p></div>"
        rows.append((i, "http://a.test/x", page(body), "old", [1]))
        article = f"<article><h1>Head</h1><p>Shared line</p><p>Own {i}</p><div>Follow us</div></article>"
        rows.append((100 + i, "http://b.test/y", page(article), "old", [1]))
    rows += [(200, "http://c.test/", page("<div><p>Subscribe to the gazette</p></div>"), None, None),
             (201, None, None, None, None), (202, "http://a.test", "", None, None), (202, "http://a.test", "", None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string, templates array<int>").repartition(3)
    out = extract(df)
    assert sorted(out.columns) == sorted(df.columns) and out.count() == len(rows)
    got = {r.page_id: r.text for r in out.collect()}
    assert got[3] == "Story 3 begins"  # outside an article a recurring paragraph is a part of the site
    assert got[103] == "Head Shared line Own 3"
    assert got[200] == "Subscribe to the gazette" and got[201] == "" and got[202] == ""
    assert extract(df.limit(0)).count() == 0


def test_copies_of_a_page_are_one_page(spark):
    """Copied articles stay whole, in a container, in a plain body and without a url."""
    wrapped = "<article><div><p>Once upon a time</p><p>there was a copy</p></div></article>"
    plain = "<p>Once upon a time</p><p>there was a copy</p>"
    rows = [(i, "http://a.test/x", page(wrapped)) for i in range(20)]
    rows += [(100 + i, "http://b.test/x", page(plain)) for i in range(20)]
    rows += [(200 + i, None, page(f"<main>{plain}</main>")) for i in range(20)]
    # new heads, the same article: it is most of each page
    rows += [(300 + i, "http://d.test/x", page(f"<article><h1>No {i}</h1><div><p>Once upon a time there was</p></div></article>"))
             for i in range(20)]
    got = {r.page_id: r.text for r in extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert {got[k + i] for k in (0, 100, 200) for i in range(20)} == {"Once upon a time there was a copy"}
    assert got[307] == "No 7 Once upon a time there was"


def test_a_part_of_few_of_a_host_s_pages_is_deleted(spark):
    rows = [(i, "http://a.test/x", page(f"<div><p>Story {i} begins and goes on</p></div>" + "<p>Read on in part B</p>" * (i < 20)))
            for i in range(200)]
    got = {r.page_id: r.text for r in extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[3] == "Story 3 begins and goes on" and got[100] == "Story 100 begins and goes on"


def test_article_text_that_recurs_stays(spark):
    """A quotation in eight of a host's hundred articles is text of these, wherever
    it stands; a last box of most articles is the site's, one in their middle not."""
    rows = []
    for i in range(100):
        quote = "<blockquote>All that glitters is not gold</blockquote>" * (i < 8)
        body = f"<h1>No {i}</h1><p>Story {i} begins</p>{quote}<div>Middle box</div><p>and story {i} goes on</p>"
        last = quote if 8 <= i < 20 else "<div>Follow us</div>"
        rows.append((i, "http://a.test/x", page(f"<article>{body}{last}</article>")))
        rows.append((1000 + i, "http://b.test/x", page(f"<article><p>Only {i} tales</p>" + "<blockquote>So it goes</blockquote>" * (i < 30) + "</article>")))
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in extract(df).collect()}
    assert got[3] == "No 3 Story 3 begins All that glitters is not gold Middle box and story 3 goes on"
    assert got[50] == "No 50 Story 50 begins Middle box and story 50 goes on"
    assert got[1004] == "Only 4 tales So it goes" and got[1040] == "Only 40 tales"
    # ten times the host, the same texts
    more = [(k + 10_000 * c, u, h.replace("Story", f"Story {c}x").replace("tales", f"tales {c}x")) for k, u, h in rows for c in range(1, 6)]
    bigger = extract(df.unionByName(spark.createDataFrame(more, df.schema))).where("page_id < 10000")
    assert {r.page_id: r.text for r in bigger.collect()} == got
