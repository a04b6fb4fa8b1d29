import pytest
from pyspark.sql import functions as F

from webloom.functions import text as X
from webloom.functions import urls as U
from webloom.operators import cleanup, dedup, dom, extract, graph, vector


def values(spark, rows, expression, kind="x string"):
    df = spark.createDataFrame([(r,) if not isinstance(r, tuple) else r for r in rows], kind)
    return [r[0] for r in df.select(expression).collect()]


URLS = [
    (None, "empty_or_not_string", None), ("", "empty_or_not_string", None), ("http://a.org", "invalid_scheme", "http://a.org"), ("https://www.a.org/x", None, "https://a.org/x"), ("mailto:a@b.c", "protocol_mailto", "mailto:a@b.c"),
    ("tel:1", "protocol_tel", "tel:1"), ("javascript:x", "protocol_javascript", "javascript:x"), ("data:x", "protocol_data", "data:x"), ("https:///x", "missing_netloc", "https:///x"), ("#frag", "invalid_scheme", "#frag"), ("a/b", "invalid_scheme", "a/b"), ("ttps://a", "invalid_scheme", "ttps://a"),
]


def test_urls(spark):
    urls = [u for u, _, _ in URLS]
    assert values(spark, urls, U.invalid_reason(F.col("x"))) == [r for _, r, _ in URLS]
    assert values(spark, urls, U.normalize(F.col("x"))) == [n for _, _, n in URLS]


@pytest.mark.parametrize(("url", "out"), [("https://a.org/x.pdf?y=1", True), ("https://a.org/x.docx", True), ("ftp://a.org/x", True), ("ttps://a.org/x", True), ("https://", True), ("https://a.org/page", False), ("https://a.org/pdf/x", False)])
def test_exclusion(spark, url, out):
    assert values(spark, [url], U.excluded(F.col("x"))) == [out]


def test_more_of_urls(spark):
    assert values(spark, ["https://a.org/Document/1?x", "https://a.org/x?y=.pdf"], U.is_pdf(F.col("x"))) == [True, False]
    assert values(spark, ["https://www.a.example.com/x", "https://example.com", "https://notexample.com"], U.in_domain(F.col("x"), "example.com")) == [True, True, False]
    (name,) = values(spark, ["https://a.org/b:c/" + "d" * 300], U.safe_filename(F.col("x")))
    assert name.startswith("a.org_b_c_ddd") and len(name) == 203
    pair = values(spark, [("https://a.org/x/y", "../z?q"), ("https://a.org", None)], U.resolve_any()(F.col("x"), F.col("y")), "x string, y string")
    assert pair == ["https://a.org/z?q", None]


def test_text_rules(spark):
    assert values(spark, ["aB1c:d  e", "# aB", "+49 (0)12x", ""], X.spaced(F.col("x"))) == ["a B 1 c: d e", "# aB", "+49 (0)12 x", ""]
    assert values(spark, ["[ Ann ](mailto:a@b.c) Ann ann,", "Ann: ann ann"], X.comparable(F.col("x"))) == ["ann", "annann ann"]  # white space behind a colon goes first
    assert values(spark, ["see x@Y.org [a@b.org]"], X.emails(F.col("x"))) == [["x@y.org", "a@b.org"]]
    assert values(spark, [("abcd", "abxd"), ("", "a"), ("ab", "abcd")], X.similarity(F.col("x"), F.col("y")), "x string, y string") == [0.75, 0.0, 0.5]
    assert values(spark, ["Tel:", "web", "custom field", None], X.label(F.col("x"))) == ["Phone", "Link", "Custom Field", ""]
    assert values(spark, ["Context: c\nAnswer: old\nAnswer: x\nQuestion: q\nx\ny"], X.answer(F.col("x"))) == ["x\ny"]
    assert values(spark, ["Contact Contact us"], X.doubled_word_free(F.col("x"))) == ["Contact us"]
    assert values(spark, ["a [](x) ![](y)"], X.empty_link_free(F.col("x"))) == ["a  ![](y)"]


def test_places_are_not_trimmed(spark):
    """An element that begins or ends with its own place's digits keeps them; spaces around it go."""
    assert values(spark, ["0 a.  1 b.\n28.5 c2.  4191 d3. "], X.sentences(F.col("x"))) == [["0 a.", "1 b.", "28.5 c2.", "4191 d3."]]
    assert values(spark, ["Answer: 0\n 1 \n2x2"], X.answer(F.col("x"))) == ["0\n1\n2x2"]


def test_repeated_lines(spark):
    rows = [(1, 0, "mail a@b.org"), (1, 1, "again a@b.org"), (1, 2, "[c@d.org](mailto:c@d.org)"), (2, 0, "a@b.org")]
    df = spark.createDataFrame(rows, "doc_id long, line_no int, line string")
    gone = lambda keep: sorted((r[0], r[1]) for r in dedup.repeated_emails(df, keep=keep).collect())
    assert gone("first") == [(1, 1)] and gone("none") == [(1, 0), (1, 1), (1, 2)]
    long = "x" * 100
    near = spark.createDataFrame([(1, 0, long), (1, 1, long[:-2] + "yy"), (1, 2, "y" * 100), (2, 0, long)], "doc_id long, k int, t string")
    assert [(r["doc_id"], r["a"], r["b"]) for r in dedup.similar_pairs(near, "doc_id", "k", "t", 0.95).collect()] == [(1, 0, 1)]
    leaders = spark.createDataFrame([(1, 0, "The same sentence here."), (1, 1, "the same sentence here!"), (1, 2, "Another one.")], "doc_id long, n int, s string")
    assert sorted(r["n"] for r in dedup.leader_dedup(leaders, "doc_id", "n", "s").collect()) == [0, 2]


def test_breadth_first_depths(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("a", "c"), ("c", "a"), ("c", "d"), ("d", "e"), ("d", "d")], "src string, dst string")
    seeds = spark.createDataFrame([("a",), (None,)], "node string")
    found = {r["node"]: r["depth"] for r in graph.bfs_depths(edges, seeds, 2).collect()}
    assert found == {"a": 0, "b": 1, "c": 1, "d": 2}


def test_pages_of_every_kind():
    root = dom.parse('<main><h2>Title</h2><p>Short?<p>A paragraph of more than thirty characters.<ul><li>x<li><a href="/y">y</a></ul><table><tr><th>A</th><th>B</th></tr><tr><td>1</td><td>2</td></tr><tr></tr></table></main><p>outside, thirty characters or more of it</p>')
    found = [(i["type"], i["text"]) for i in extract.items(root)]
    assert found == [("heading", "Title"), ("paragraph", "A paragraph of more than thirty characters."), ("list", "  * x\n  * [y](/y)"), ("table", "")]
    assert extract.table(root.find_all("table")[0]) == {"headers": ["A", "B"], "rows": [["1", "2"]], "caption": ""}
    for html in (None, "", "<<<>>", "</p></div>", "<!DOCTYPE", "<p" * 50, "<td><table><td>" * 30):
        extract.markdown("https://a.org", dom.parse(html))


def test_references_that_were_cut_stay():
    root = dom.parse('<h1>A &amp; B&amp &am</h1><p id="&lt;&amp">&lt;&#39;&#x41;&quot;&copy;&copy &notit; &</p><script>a && b &amp;</script>')
    assert [n.text() for n in root.find_all("h1", "p")] == ["A & B&amp &am", "<'A\"\u00a9&copy &notit; &"]
    assert root.find_all("p")[0].attrs == {"id": "<&amp"} and root.find_all("script")[0].children == ["a && b &amp;"]
    assert dom.parse("&quot;&amp;&#39;\ufdd0", ("amp;",)).text() == "&quot;&&#39;\ufdd0"
    assert dom.parse("\ufdd0").text() == "\ufdd0"


def test_final_cleanup():
    lines = ["# Source URL", "", "https://a.org", "", "", "", "", "text", "5 mm", "## Empty", "| a |" * 12, "Privacy Policy", "Name", "", "", "", "end aB"]
    kept = [x for _, x in cleanup.clean_lines(lines)]
    assert kept[:4] == lines[:4] and "5 mm" not in kept and "Privacy Policy" not in kept and "Name" not in kept and kept[-1] == "end aB"


def test_vectors(spark):
    docs = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.6, 0.8]), (3, [0.0, 0.0]), (4, [2.0, 0.0])], "id long, v array<double>")
    queries = docs.where("id = 1")
    top = vector.top_k(vector.scores(docs, queries, "id", "v", "cosine"), 3)
    assert [(r["rank"], r["id"], round(r["score"], 6)) for r in top.orderBy("rank").collect()] == [(1, 1, 1.0), (2, 4, 1.0), (3, 2, 0.6)]
    diverse = vector.diverse(vector.scores(docs, queries, "id", "v"), docs, "id", "v", 2, 0.4)
    assert [r["id"] for r in diverse.orderBy("rank").collect()] == [1, 3]
