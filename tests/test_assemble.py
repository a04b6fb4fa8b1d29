import pytest
from pyspark.sql import functions as F

from webloom.operators import assemble, dom, extract, vector

PAGE = """<html><body><div class="main-menu"><a href="/1">one</a> <a href="/2">two</a></div>
<div style="display: none">gone</div><p hidden>gone, too</p><header>head</header>
<div id="x"><ul><li><a href="/a">a</a></li><li><a href="/b">b</a></li><li><a href="/c">c</a></li><li><a href="/d">d</a></li></ul></div>
<h2>Staff</h2><p>Some words that are the text of this page with <a href="/l">one link</a> in them.</p>
<table><tr><th>Name</th><th>E-Mail</th></tr><tr><td>Ann Other</td><td><a href="mailto:ann@example.com">mail me</a></td></tr></table></body></html>"""


@pytest.fixture(scope="module")
def nodes(spark):
    return dom.dom_nodes(spark.createDataFrame([(1, PAGE), (2, None)], "page_id long, html string"))


def test_boilerplate_goes_with_what_is_inside(nodes):
    marked = assemble.is_boilerplate() | F.col("tag").isin("header")
    left = [(r["tag"], r["text"]) for r in assemble.without_subtrees(nodes, marked).orderBy("node_id").collect()]
    texts = " ".join(t for tag, t in left if tag not in ("html", "body"))
    assert "gone" not in texts and "two" not in texts and "head" not in texts.replace("header", "")
    assert ("h2", "Staff") in left and ("a", "c") in left


def test_links_below_a_node(nodes):
    found = {(r["tag"], r["node_id"]): (r["links"], r["link_words"]) for r in nodes.collect()}
    (whole,) = [v for (tag, _), v in found.items() if tag == "body"]
    assert whole == (8, 10)
    heavy = [r["tag"] for r in assemble.link_heavy(nodes).orderBy("node_id").collect()]
    assert heavy == ["div", "ul"]
    dense = {r["tag"]: (r["words"], round(r["density"], 3)) for r in assemble.dense_blocks(nodes).collect()}
    assert dense == {"p": (14, 0.857)}


def test_links_by_section(spark):
    rows = [(1, "External Links", 1, "x", "/x"), (1, "B", 2, "b", "/b"), (1, "A", 3, "a", "/a"), (1, "A", 0, "first", "/f")]
    (page,) = assemble.grouped_links(spark.createDataFrame(rows, "page_id long, section string, seq int, text string, href string")).collect()
    assert [(s["section"], [x["href"] for x in s["links"]]) for s in page["sections"]] == [("A", ["/f", "/a"]), ("B", ["/b"]), ("External Links", ["/x"])]


def lines_of(spark, *texts):
    return spark.createDataFrame([(d, i, line) for d, text in enumerate(texts) for i, line in enumerate(text.split("\n"))], "doc_id long, line_no long, line string")


def test_empty_sections(spark):
    df = lines_of(spark, "# a\ntext\n## b\n---\n\n### c\nx\n## d\n", "no heading", "# only")
    assert sorted((r["doc_id"], r["line_no"]) for r in assemble.empty_sections(df).collect()) == [(0, 2), (0, 7), (2, 0)]


def test_known_headings_and_table_text_go(spark):
    df = lines_of(spark, "# Known\n## Other\nKnown\ntwo  Words here\nshort")
    known = spark.createDataFrame([(0, "known")], "doc_id long, heading string")
    left = assemble.without_known_headings(df, known)
    assert [r["line"] for r in left.orderBy("line_no").collect()] == ["## Other", "Known", "two  Words here", "short"]
    cells = spark.createDataFrame([(0, "x two words HERE short")], "doc_id long, text string")
    assert [r["line"] for r in assemble.without_table_text(left, cells).orderBy("line_no").collect()] == ["## Other", "Known", "short"]


def test_reasons_to_read_a_page_again(spark):
    long = "text " * 40
    rows = [("", "x", "empty"), ("few", "y" * 1001, "thin"), ("few", "y", "short"), (long, "<table>", "tables_missing"), (long, "mailto:a mailto:b mailto:c", "contacts_missing"), (long, "fine", None)]
    df = spark.createDataFrame([r[:2] for r in rows], "md string, html string")
    assert [r[0] for r in df.select(assemble.fallback_reason(F.col("md"), F.col("html"))).collect()] == [r[2] for r in rows]


def test_header_order(spark):
    df = spark.createDataFrame([(["Zone", "Phone", "Name", "Area", "Phone"],)], "labels array<string>")
    assert df.select(assemble.header_order(F.col("labels"))).first()[0] == ["Name", "Phone", "Area", "Zone"]


def test_tables_get_their_links_back():
    root = dom.parse(PAGE)
    text = "| Name | E-Mail |\n|---|---|\n| Ann Other | mail me |\n\n| left | alone |"
    assert assemble.with_table_links(text, root).split("\n")[2] == "| Ann Other | [mail me](mailto:ann@example.com) |"
    assert assemble.with_table_links(text, root).split("\n")[4] == "| left | alone |"
    tables = [[["Beta Gamma", "1"]], [["nothing alike", "2"]]]
    found = [{"headers": [], "rows": [["other", "x"]], "caption": ""}, {"headers": [], "rows": [["Beta Gamma", "1"]], "caption": ""}]
    assert assemble.matched(tables, found) == [found[1], None]


def test_addresses_by_name():
    contacts = [{"name": "Ann Other", "email": "ann@example.com"}]
    assert assemble.with_addresses("E-Mail: | Ann Other\nE-Mail: Bob", contacts) == "E-Mail: | [Ann Other](mailto:ann@example.com)\nE-Mail: Bob"


def test_cells_contacts_and_folds():
    cell = dom.parse('<td>Ann Ann <a href="mailto:a@b.org">E-Mail</a><br><a href="mailto:a@b.org">again</a> <a href="/x" title="Home"></a></td>').find_all("td")[0]
    assert assemble.cell_text(cell) == "Ann [a@b.org](mailto:a@b.org)\na@b.org [Home](/x)"
    assert assemble.contact_line({"name": "Ann Other", "title": None, "email": "a@b.org", "phone": "1"}) == "Name: Ann Other | E-Mail: [a@b.org](mailto:a@b.org) | Phone: 1"
    assert assemble.merged_contact_lines(["Ann Other", "Office 3", "ann@example.com", "rest", "Bob Builder", "", "x"]) == ["Ann Other Office 3 ann@example.com", "rest", "Bob Builder", "", "x"]
    assert assemble.table_fragments(["left over", "", "| a |", "| b |", "text", "more"]) == [0]


def test_the_built_in_embedder(spark):
    df = spark.createDataFrame([(1, "one two"), (2, "two one"), (3, None), (4, "three")], "doc_id long, text string")
    found = {r["doc_id"]: r["embedding"] for r in vector.embed(df, "text", "embedding", width=16).collect()}
    assert found[1] == found[2] != found[4] and len(found[1]) == 16
    assert abs(sum(x * x for x in found[1]) - 1) < 1e-6 and set(found[3]) == {0.0}
    ones = vector.embed(df, "text", "embedding", lambda texts: [[1.0] for _ in texts])
    assert {tuple(r["embedding"]) for r in ones.collect()} == {(1.0,)}


def test_contacts_of_a_page():
    (only,) = extract.contacts(dom.parse(PAGE))
    assert only["email"] == "ann@example.com" and only["name"] == "Ann Other"
