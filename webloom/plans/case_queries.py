"""Extraction rules over small pages of our own: what the tables' pages lack (tables, contacts, events, links to elsewhere).

Each query runs an operator over the cases beside it; its oracle is what the rule gives by hand. ``case_id`` numbers the cases."""

from __future__ import annotations

from pyspark.sql import functions as F

from webloom.functions import scripts
from webloom.functions import text as X
from webloom.operators import assemble, cells, cleanup, compose, dom, extract, fallback, render
from webloom.plans.catalog import register

URL = "https://www.site.example/team/"


def _quoted(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, int):
        return str(value)
    return "'" + value.replace("'", "''") + "'"


def expected(columns: str, rows: list[tuple]) -> str:
    """SQL for these rows; columns: names with DuckDB types."""
    names, kinds = zip(*(c.strip().split(" ", 1) for c in columns.split(",")), strict=True)
    if not rows:
        return "SELECT " + ", ".join(f"CAST(NULL AS {k}) AS {n}" for n, k in zip(names, kinds, strict=True)) + " WHERE false"
    each = [", ".join(f"CAST({_quoted(v)} AS {k}) AS {n}" for v, n, k in zip(r, names, kinds, strict=True)) for r in rows]
    return " UNION ALL ".join(f"SELECT {x}" for x in each)


def _pages(spark, cases: list[str], url: str = URL):
    return spark.createDataFrame([(i, url, html) for i, html in enumerate(cases)], "page_id long, url string, html string")


def _text(spark, cases: list[str], function):
    """(case_id, out): a pure function of each case's text, in Arrow batches."""

    def run(batches):
        for pdf in batches:
            pdf["out"] = [function(t) for t in pdf["text"]]
            yield pdf[["case_id", "out"]]

    return spark.createDataFrame(list(enumerate(cases)), "case_id long, text string").mapInPandas(run, "case_id long, out string")


def _rendered(spark, cases, function, url=URL):
    """(case_id, out): one text for each page."""
    return extract.apply(_pages(spark, cases, url), lambda u, root: [{"out": function(u, root)}], "out string").withColumnRenamed("page_id", "case_id")


TABLES = [
    "<table><thead><tr><th>Name</th><th>Room</th></tr></thead><tbody><tr><td>Ann</td><td>1</td></tr><tr><td> </td><td></td></tr></tbody></table>",
    "<table><caption>Rooms</caption><tr><th>A</th><th>B</th></tr><tr><td>1</td><td>2</td></tr></table>",
    "<table><tr><th>A</th><td>b</td></tr><tr><td>1</td><td>2</td></tr></table>",
    "<table><tr><td>1</td><td>2</td></tr><tr><td>3</td><td>4</td><td>5</td></tr></table>",
    "<table><tr><th>Out</th></tr><tr><td>x <table><tr><td>in</td></tr></table></td></tr></table>",
]


@register("table_cases", expected("case_id BIGINT, headers VARCHAR, rows VARCHAR, caption VARCHAR", [
    (0, "Name;Room", "Ann;1", ""), (1, "A;B", "1;2", "Rooms"), (2, "A;b", "1;2", ""), (3, "", "1;2/3;4;5", ""), (4, "Out", "x in", ""),
]))
def table_cases(spark, sf_dir):
    """Headers from a head, from a row of header cells, from half of one; ragged rows; nested tables' rows; blank rows."""

    def flat(url, root):
        t = extract.table(root.find_all("table")[0])
        return [{"headers": ";".join(t["headers"]), "rows": "/".join(";".join(r) for r in t["rows"]), "caption": t["caption"]}]

    return extract.apply(_pages(spark, TABLES), flat, "headers string, rows string, caption string").withColumnRenamed("page_id", "case_id")


CELLS = [
    "Anna Berg E-Mail: [anna@x.org](mailto:anna@x.org) Phone: +49 40 8998 1234 Location: 2a / 301",
    "Bob Lee\nGroup Leader\nOffice: 3",
    "Bob Lee bob@x.org",
    "Energy: 6 GeV",
    "Telephone: +49 40 8998 1234",
    "Cleo Day  Room: Room 12  Fax: 7",
    "first thing\nsecond thing",
]


@register("cell_pairs", expected("case_id BIGINT, out VARCHAR", [
    (0, "Name=Anna Berg;E-Mail=[anna@x.org](mailto:anna@x.org);Phone=+49 40 8998 1234;Location=2a / 301"),
    (1, "Name=Bob Lee;=Group Leader;Location=3"), (2, "Name=Bob Lee;E-Mail=bob@x.org"), (3, "Energy=6 GeV"), (4, "Phone=+49 40 8998 1234"),
    (5, "Name=Cleo Day;Location=Room 12;Phone=7"), (6, "Name=first thing;=second thing"),
]))
def cell_pairs(spark, sf_dir):
    """Cells of several fields: labels by colons and by what values look like, the name first."""
    return _text(spark, CELLS, lambda t: ";".join(f"{k}={v}" for k, v in cells.pairs(t)))


@register("cell_records", expected("case_id BIGINT, out VARCHAR", [
    (0, "Name:Anna Berg|E-Mail:[anna@x.org](mailto:anna@x.org)|Phone:+49 40 8998 1234|Location:2a / 301"),
    (1, "Name:Bob Lee Group Leader|Location:3"), (2, "Name:Bob Lee|E-Mail:bob@x.org"), (3, "Energy:6 GeV"), (4, "Phone:+49 40 8998 1234"),
    (5, "Name:Cleo Day|Location:Room 12|Phone:7"), (6, "Name:first thing second thing"),
]))
def cell_records(spark, sf_dir):
    """The same cells as rows of labelled columns: a value without a label goes to the column before it."""
    return _text(spark, CELLS, lambda t: "|".join(f"{k}:{v}" for k, v in cells.record(t).items()))


COLUMN = [
    "<table><tr><td>Anna Berg<br>Phone: +49 40 8998 1234</td></tr><tr><td>Bob Lee<br>E-Mail: <a href='mailto:b@x.org'>b@x.org</a><br>Phone: +49 40 8998 5678</td></tr></table>",
    "<table><tr><td>a</td><td>b</td></tr></table>",
]


@register("column_tables", expected("case_id BIGINT, headers VARCHAR, rows VARCHAR", [
    (0, "Name;E-Mail;Phone", "Anna Berg;;+49 40 8998 1234/Bob Lee;[b@x.org](mailto:b@x.org);+49 40 8998 5678"), (1, "", "a;b"),
]))
def column_tables(spark, sf_dir):
    """Tables of one column as tables of several, a column for each label."""

    def flat(url, root):
        t = cells.widened(extract.table(root.find_all("table")[0]))
        return [{"headers": ";".join(t["headers"]), "rows": "/".join(";".join(r) for r in t["rows"])}]

    return extract.apply(_pages(spark, COLUMN), flat, "headers string, rows string").withColumnRenamed("page_id", "case_id")


def _t(headers: str, rows: str) -> dict:
    return {"headers": headers.split(";") if headers else [], "rows": [r.split(";") for r in rows.split("/")] if rows else [], "caption": ""}


RENDERED = [
    ("A;B", "1;2/;/---;—"), ("Beam energy;6.0 GeV", "Tune;0.5"), ("", "City;Land/Rome;Italy"), ("", "a@b.org;x/c;d"), ("", "2015;" + "word " * 10 + "/2016;x"),
    ("", "[x](https:%2F%2Fa);"), ("", "6.0 GeV"), ("H", "E-Mail: a Phone: b Location: c"), ("", ";".join("abcdefghijk")), ("N;M", "Bjö;[Björn](mailto:b@x.org)"),
]


@register("rendered_tables", expected("case_id BIGINT, out VARCHAR", [
    (0, "| A | B |\n| --- | --- |\n| 1 | 2 |"), (1, "| Beam energy | 6.0 GeV |\n| Tune | 0.5 |"), (2, "| City | Land |\n| --- | --- |\n| Rome | Italy |"), (3, "| a@b.org | x |\n| c | d |"),
    (4, "| 2015 | " + "word " * 9 + "word |\n| 2016 | x |"), (5, ""), (6, ""), (7, ""), (8, ""), (9, "| N | M |\n| --- | --- |\n| Björn | [Björn](mailto:b@x.org) |"),
]))
def rendered_tables(spark, sf_dir):
    """Tables as markdown: what is a header and what is data, and which tables and rows are noise."""
    return _text(spark, [f"{h}\t{r}" for h, r in RENDERED], lambda t: render.table_markdown({k: [c.replace("%2F", "/") for c in v] if k == "headers" else [[c.replace("%2F", "/") for c in r] for r in v] if k == "rows" else v for k, v in _t(*t.split("\t")).items()}))


@register("inline_tables", expected("case_id BIGINT, out VARCHAR", [
    (0, "| A | B |\n| --- | --- |\n| 1 | 2 |"), (1, "| Name: | x |\n| Age: | y |"), (2, "| a | b |\n| c |  |"), (3, "| Ann | [Ann](x) |\n| Ann [x](y) | z |"),
]))
def inline_tables(spark, sf_dir):
    """Tables inside text: keys and values have no header; doubled words once, but not before a link."""
    tables = [("A;B", "1;2/;"), ("Name:;x", "Age:;y"), ("", "a;b/c"), ("", "Ann Ann;[Ann](x)/Ann [x](y);z")]
    return _text(spark, [f"{h}\t{r}" for h, r in tables], lambda t: render.inline_markdown(_t(*t.split("\t"))))


RUNS = [
    [("Name;E-Mail", "Ann;a@x.org"), ("Name;Email;Phone", "Bob;b@x.org;1"), ("A;B", "1;2")],
    [("E-Mail;Telephone", "[Ann Lee](mailto:a@x.org);1"), ("e-mail;Tel;Title", "[b@x.org](mailto:b@x.org);2;Head")],
]


@register("merged_tables", expected("case_id BIGINT, out VARCHAR", [
    (0, "Name;E-Mail;Phone=Ann;a@x.org;/Bob;b@x.org;1 A;B=1;2"), (1, "Name;E-Mail;Phone;Title=Ann Lee;[Ann Lee](mailto:a@x.org);1;/;[b@x.org](mailto:b@x.org);2;Head"),
]))
def merged_tables(spark, sf_dir):
    """Runs of one-row tables whose headers share two kinds as one table; names from mail links where there is no name column."""
    flat = lambda t: ";".join(t["headers"]) + "=" + "/".join(";".join(r) for r in t["rows"])
    return _text(spark, ["\n".join(f"{h}\t{r}" for h, r in run) for run in RUNS], lambda text: " ".join(map(flat, render.merged([_t(*x.split("\t")) for x in text.split("\n")]))))


ITEMS = [
    "<body><nav><h2>Menu</h2><ul><li>x</li></ul></nav><div class='sidebar'><h2>Side</h2></div><h1>Top</h1><p>Short after</p><p>Long enough now</p><h1>Top</h1><ul><li>one <a href='/a'>two</a></li></ul></body>",
    "<main><nav><h2>Kept</h2></nav><p>A paragraph of no heading, thirty letters</p><p>Why is that so?</p><p><a href='/x'>only links here</a></p></main>",
    "<article><table><tr><td>Ann Other works in building seven</td><td>Phone 12345678</td></tr></table><p>Phone: 12345678 of Ann Other in building seven</p><ol><li>x</li><li>y</li></ol></article>",
]


@register("item_cases", expected("case_id BIGINT, out VARCHAR", [
    (0, "heading:Top|paragraph:Long enough now|list:  * one [two](/a)"), (1, "heading:Kept|paragraph:A paragraph of no heading, thirty letters|paragraph:Why is that so?"),
    (2, "table:|list:1. x\n2. y"),
]))
def item_cases(spark, sf_dir):
    """Items in order: headings of navigation only where the body is the scope, short paragraphs, link-only ones, repeats of table rows."""
    return _rendered(spark, ITEMS, lambda url, root: "|".join(f"{i['type']}:{i['text']}" for i in extract.items(root)))


@register("repository_items", expected("case_id BIGINT, out VARCHAR", [(0, "heading"), (1, "table")]))
def repository_items(spark, sf_dir):
    """A repository's search form isn't content; a table of its records is."""
    pages = ["<main><h1>Found</h1><table><tr><td>Guest :: Login</td><td>Search tips</td></tr></table></main>", "<main><table><tr><td>Login</td><td>repo-2021-01234</td></tr></table></main>"]
    return _rendered(spark, pages, lambda url, root: "|".join(i["type"] for i in extract.items(root, "repo")))


LINKED = ["<h2>One</h2><a href='https://a.org/x'>A</a><h5>Low</h5><a href='https://b.org'>B</a><a href='/own'>own</a><table><tr><td><a href='https://c.org'>C</a></td></tr></table>", "<h5>Five</h5><h4>Four</h4><a href='https://a.org'></a><a href='https://a.org'>again</a>", "<a href='https://www.site.example/z'>own</a><a href='mailto:x@y.org'>m</a><a href='https://d.org'>D</a>", "<a href='http://[bad'>x</a>"]


@register("external_links", expected("case_id BIGINT, section VARCHAR, text VARCHAR, href VARCHAR", [
    (0, "One", "A", "https://a.org/x"), (0, "One", "B", "https://b.org"), (1, "Four", "https://a.org", "https://a.org"), (2, "External Links", "D", "https://d.org"),
]))
def external_links(spark, sf_dir):
    """Links to other hosts outside of tables, each once, under the heading that governs it."""
    return extract.apply(_pages(spark, LINKED), extract.external_links, "section string, text string, href string").withColumnRenamed("page_id", "case_id")


PEOPLE = [
    "<div><p>Ann Other (she/her)</p><p>Head of Group</p><p>T. 040 123456789</p><p><a href='mailto:Ann@X.org'>mail</a></p></div>",
    "<p><a href='mailto:x@y.org'>x</a></p>",
    "<div><p>Jörg Müller <a href='mailto:j@x.org'>write</a></p></div><div><p>Kai Lund <a href='mailto:k@x.org'>write</a></p></div>",
]


@register("contact_cases", expected("case_id BIGINT, email VARCHAR, name VARCHAR, phone VARCHAR, title VARCHAR, pronoun VARCHAR, line VARCHAR", [
    (0, "ann@x.org", "Ann Other", "040 123456789", "Head of Group", "she/her", "Name: Ann Other | Title: Head of Group | E-Mail: [ann@x.org](mailto:ann@x.org) | Phone: 040 123456789"),
    (2, "j@x.org", "Jörg Müller", None, None, None, "Name: Jörg Müller | E-Mail: [j@x.org](mailto:j@x.org)"), (2, "k@x.org", "Kai Lund", None, None, None, "Name: Kai Lund | E-Mail: [k@x.org](mailto:k@x.org)"),
]))
def contact_cases(spark, sf_dir):
    """A contact for each mail link that has a name, a number or a position about it, and its line."""
    found = lambda url, root: [c | {"line": assemble.contact_line(c)} for c in extract.contacts(root)]
    return extract.apply(_pages(spark, PEOPLE), found, "email string, name string, phone string, title string, pronoun string, line string").withColumnRenamed("page_id", "case_id")


EVENT = """<h1>Site</h1><h1 class="event-title">Spring School</h1><span class="date-time">Friday Jan 16, 2026</span><div class="location">Room 7</div>
<a href="https://zoom.us/j/1">Join</a><div id="description">All about the spring of things.</div><p>Abstract submission deadline: 1.2.2026</p>
<ul class="timetable"><li class="entry">10:30 AM <span class="title">Opening</span> <span class="speaker">Ann Other</span> <a href="/material/1.pdf">Slides</a></li><li class="entry">no facts</li></ul>
<a href="https://a.org">Elsewhere</a><a href="https://a.org">Again</a><a href="https://www.site.example/x">Own</a>"""
BARE_EVENT = "<h1>Talk</h1><p>Monday March 3</p><p>12 (34)</p><a href='/talk.pdf'>Paper</a><p>⚠ Your browser is out of date ⚠ it may not work correctly in this browser.</p>"


@register("event_cases", expected("case_id BIGINT, title VARCHAR, date VARCHAR, location VARCHAR, video VARCHAR, description VARCHAR, deadlines VARCHAR, agenda VARCHAR, attachments VARCHAR, links VARCHAR", [
    (0, "Spring School", "Friday Jan 16, 2026", "Room 7", "https://zoom.us/j/1", "All about the spring of things.", "Abstract submission deadline: 1.2.2026/Abstract submission deadline: 1.2.2026/Abstract submission deadline: 1.2.2026",
     "**10:30 AM** - Opening (Speaker: Ann Other)/  - [Slides](https://www.site.example/material/1.pdf)", "", "https://zoom.us/j/1/https://a.org"),
    (1, "Talk", "Monday March 3", "12 (34)", "", None, "", "", "[Paper](https://www.site.example/talk.pdf)", ""),
]))
def event_cases(spark, sf_dir):
    """Fields of event pages, by classes and by what their texts look like."""
    lists = ("video", "deadlines", "agenda", "attachments", "links")
    flat = lambda url, root: [{k: "/".join(v) if k in lists else v for k, v in extract.event(url, root).items()}]
    schema = "title string, date string, location string, video string, description string, deadlines string, agenda string, attachments string, links string"
    return extract.apply(_pages(spark, [EVENT, BARE_EVENT]), flat, schema).withColumnRenamed("page_id", "case_id")


@register("event_texts", expected("case_id BIGINT, out VARCHAR", [
    (0, "# Talk\n\n**Date:** Monday March 3\n\n**Location:** 12 (34)\n\n## Attachments\n\n- [Paper](https://www.site.example/talk.pdf)"),
    (1, "# Plain\n\n**Description:**\nBefore it all. and what comes after"),
]))
def event_texts(spark, sf_dir):
    """Event pages as markdown, without warnings to old browsers."""
    other = "<h1>Plain</h1><div class='description'>Before it all. ⚠ Your browser is out of date ⚠ The site may not work correctly in this browser. and what comes after</div>"
    return _rendered(spark, [BARE_EVENT, other], extract.event_markdown)


HTML_CELLS = [
    "<td>Ann <a href='mailto:a@b.org'>E-Mail</a> <a href='mailto:a@b.org'>again</a><img src='x'> <a href='/x' title='Home'></a></td>", "<td>Ann Ann<br>x</td>", "<td><a href='/y'>there</a></td>",
]


@register("cell_links", expected("case_id BIGINT, out VARCHAR", [(0, "Ann [a@b.org](mailto:a@b.org) a@b.org [Home](/x)"), (1, "Ann\nx"), (2, "[there](/y)")]))
def cell_links(spark, sf_dir):
    """Cells with their links: generic texts as the address or title, a repeated address bare, doubled words once."""
    pages = [f"<table><tr>{c}</tr></table>" for c in HTML_CELLS]
    return _rendered(spark, pages, lambda url, root: assemble.cell_text(root.find_all("td")[0]))


@register("labelled_cells", expected("case_id BIGINT, out VARCHAR", [
    (0, "Ann E-mail: [a@b.org](mailto:a@b.org)"), (1, "Phone: 040 8998 1234"), (2, "1999-2004"), (3, "Location: 2a / 301"), (4, "ISBN 12 / 34"), (5, "Phone: +49 40 89981234"),
]))
def labelled_cells(spark, sf_dir):
    """Fields of a cell that have no label get one; years and book numbers are none."""
    return _text(spark, ["Ann [a@b.org](mailto:a@b.org)", "040 8998 1234", "1999-2004", "2a / 301", "ISBN 12 / 34", "+49 40 89981234"], assemble.labelled_cell)


FRAGMENTS = ["left over\n\n| a |\n| b |\ntext\nmore", "| H | I |\n| --- | --- |\n| a | b |\n\nend", "|---|---|\ntext", "Name\n|  x  |\nz", "| a | b |\ntext"]


@register("without_fragments", expected("case_id BIGINT, out VARCHAR", [
    (0, "text\nmore"), (1, "| H | I |\n| --- | --- |\n| a | b |\n\nend"), (2, "text"), (3, "Name\nz"), (4, "text"),
]))
def without_fragments(spark, sf_dir):
    """What lost tables left behind is taken out; whole tables stay."""
    return _text(spark, FRAGMENTS, lambda t: "\n".join(assemble.without_fragments(t.split("\n"))))


@register("table_fragments", expected("case_id BIGINT, out VARCHAR", [(0, "0"), (1, ""), (2, ""), (3, ""), (4, "")]))
def table_fragments(spark, sf_dir):
    """Lines that stand over two and more rows without being their header."""
    return _text(spark, FRAGMENTS, lambda t: ",".join(map(str, assemble.table_fragments(t.split("\n")))))


LINKED_MARKDOWN = "| Name | Mail |\n| --- | --- |\n| Ann Other | mail me |\n\n| Name | Mail |\n| --- | --- |\n| Bob Lee | here |\nE-Mail: Cleo Day"
LINKED_PAGE = "<table><tr><th>Name</th><th>Mail</th></tr><tr><td>Bob Lee</td><td><a href='mailto:bob@x.org'>here</a></td></tr></table><table><tr><th>Name</th><th>Mail</th></tr><tr><td>Ann Other</td><td><a href='mailto:ann@x.org'>mail me</a></td></tr></table><div><p>Cleo Day</p><a href='mailto:cleo@x.org'>write</a></div>"


@register("linked_cases", expected("case_id BIGINT, out VARCHAR", [
    (0, "| Name | Mail |\n| --- | --- |\n| Ann Other | [mail me](mailto:ann@x.org) |\n\n| Name | Mail |\n| --- | --- |\n| Bob Lee | [here](mailto:bob@x.org) |\nE-Mail: [Cleo Day](mailto:cleo@x.org)"),
]))
def linked_cases(spark, sf_dir):
    """Links put back into text tables from the page's tables that are likest, whatever their order, and addresses behind names."""
    return _rendered(spark, [LINKED_PAGE], lambda url, root: assemble.with_addresses(assemble.with_table_links(LINKED_MARKDOWN, root), extract.contacts(root)))


@register("lines_not_in_tables", expected("case_id BIGINT, line VARCHAR", [(0, "Some other words"), (0, "| a |"), (0, "tiny")]))
def lines_not_in_tables(spark, sf_dir):
    """Text lines that a table of their page says already go; short ones and markup stay."""
    lines = spark.createDataFrame([(0, x) for x in ("Ann  Other, room 3", "Some other words", "| a |", "tiny")], "case_id long, line string")
    tables = spark.createDataFrame([(0, "Name ann other, Room 3 tiny")], "case_id long, text string")
    return assemble.without_table_text(lines, tables, "case_id")


@register("contact_paragraphs", expected("case_id BIGINT, out VARCHAR", [(0, "Ann Other (she/her) Head of Group T. 040 123/rest"), (1, "Ann Other (x)/Bob Lee (y) b@x.org"), (2, "Plain text/more")]))
def contact_paragraphs(spark, sf_dir):
    """A person takes in the short paragraphs after it, through the first with a contact, but no other person."""
    cases = ["Ann Other (she/her)\nHead of Group\nT. 040 123\nrest", "Ann Other (x)\nBob Lee (y)\nb@x.org", "Plain text\nmore"]
    return _text(spark, cases, lambda t: "/".join(fallback.with_contacts(t.split("\n"))))


@register("contact_line_merge", expected("case_id BIGINT, out VARCHAR", [(0, "Ann Other Office 3 ann@example.com/rest"), (1, "Bob Builder//x")]))
def contact_line_merge(spark, sf_dir):
    """A line that is a name takes in up to five short lines, through the first with a contact."""
    return _text(spark, ["Ann Other\nOffice 3\nann@example.com\nrest", "Bob Builder\n\nx"], lambda t: "/".join(assemble.merged_contact_lines(t.split("\n"))))


THIN = [
    "<body><nav><p>Menu entry that is long enough to count</p></nav><main><p>First words of the main part of the page.</p><p>Write to <a href='mailto:a@b.org'>E-Mail</a> or see <a href='/team/'>us</a> and <a href='/x'>them</a></p><p>Impressum of the site</p></main></body>",
    "<body><div id='content'><p>" + "Plenty of words here. " * 10 + "</p><ul><li><a href='/1'>a</a><a href='/2'>b</a><a href='/3'>c</a><a href='/4'>d</a></li></ul><p>Once more</p><p>once  MORE</p></div></body>",
    "<body><main><p>x</p></main><div class='side'><p>A paragraph that lies beside the main part</p></div></body>",
    "<body><main><p><a href='mailto:ann@x.org'>Ann Other (Head of the Group) T. 040 1234567 ann@x.org and more words</a></p></main></body>",
]


@register("fallback_texts", expected("case_id BIGINT, out VARCHAR", [
    (0, "First words of the main part of the page.\nWrite to [a@b.org](mailto:a@b.org) or see and [them](/x)"), (1, "Plenty of words here. " * 10 + "Once more once MORE\n" + ("Plenty of words here. " * 10).strip() + "\nOnce more"),
    (2, "A paragraph that lies beside the main part"), (3, "Ann Other (Head of the Group) T. 040 1234567 [ann@x.org](mailto:ann@x.org) and more words"),
]))
def fallback_texts(spark, sf_dir):
    """Text of thin pages read from the HTML: no frames, menus, legal notes or links to the page itself; contacts unwrapped; lines once."""
    return _rendered(spark, THIN, fallback.page_text)


@register("frame_sources", expected("case_id BIGINT, out VARCHAR", [(0, "https://a.org/f https://b.org")]))
def frame_sources(spark, sf_dir):
    """Frames' addresses: their content is elsewhere."""
    return _rendered(spark, ["<iframe src='https://a.org/f'></iframe><iframe></iframe><iframe src='https://b.org'></iframe>"], lambda url, root: " ".join(fallback.frames(root)))


BEYOND = [
    ("## Team\n\n| Name | Room |\n| --- | --- |\n| Ann | 1 |\n| Bob | 2 |", "## Team\nTeam\nIntro text\n| Name | Room |\n|---|---|\nLabel:---|---\n---\nAnn Other\nPhone: 12345\nlast words"),
    ("## A", "Phone: 12345\n## B\n##"),
]


@register("text_beyond_tables", expected("case_id BIGINT, out VARCHAR", [(0, "Intro text\nlast words"), (1, "Phone: 12345\n## B")]))
def text_beyond_tables(spark, sf_dir):
    """What a page's markdown says beyond its headings and tables; contacts only where there is no table that has them."""
    return _text(spark, ["\t".join(x) for x in BEYOND], lambda t: compose.beyond(*reversed(t.split("\t"))))


SECTIONS = ["# A\n## B\ntext\n# C\n\n---", "# A\n# B\nx", "## Links\n\n- [a](https://a.org)", "x\n- [a](https://a.org)\n\n## External Links\n\n- [b](https://b.org)\n## External Links\n- [c](https://c.org)"]


@register("repaired_sections", expected("case_id BIGINT, out VARCHAR", [
    (0, "## B\ntext"), (1, "# A\n# B\nx"), (2, "## Links\n\n- [a](https://a.org)"), (3, "x\n\n## External Links\n\n- [a](https://a.org)\n\n## External Links\n\n- [b](https://b.org)\n- [c](https://c.org)"),
]))
def repaired_sections(spark, sf_dir):
    """Links to elsewhere under one header; headings that nothing follows go."""
    return _text(spark, SECTIONS, lambda t: "\n".join(compose.without_empty_sections(compose.one_links_header(t.split("\n")))))


@register("whole_pages", expected("case_id BIGINT, out VARCHAR", [
    (0, f"# Source URL\n\n{URL}\n\n# Team\n\n| Name | Room |\n| --- | --- |\n| Ann | 1 |\n\nIntro text\n\n![Image 1](a.png)\n\n## Team\n\n- [Far](https://a.org)\n"),
]))
def whole_pages(spark, sf_dir):
    """A page's file: source, items in order, leftover text, images, links to elsewhere."""
    html = "<main><h1>Team</h1><table><tr><th>Name</th><th>Room</th></tr><tr><td>Ann</td><td>1</td></tr></table><a href='https://a.org'>Far</a></main>"
    return _rendered(spark, [html], lambda url, root: compose.page(url, root, "# Team\nIntro text\n| Name | Room |\n| --- | --- |\n| Ann | 1 |", ("a.png",)))


@register("filled_names", expected("case_id BIGINT, out VARCHAR", [(0, "| Ann Lee | [Ann Lee](mailto:a@x.org) | 1|"), (1, "| Bob | [Ann Lee](mailto:a@x.org) |"), (2, "| | [a@x.org](mailto:a@x.org) |")]))
def filled_names(spark, sf_dir):
    """Rows without a name get that of their mail link."""
    return _text(spark, ["| | [Ann Lee](mailto:a@x.org) | 1|", "| Bob | [Ann Lee](mailto:a@x.org) |", "| | [a@x.org](mailto:a@x.org) |"], lambda t: "\n".join(cleanup.filled_names([t])))


CLEANED = ["# Source URL\n\nhttps://x\n\n---\n\n## Team\nwordsNext to\n\n\n\n\nend\n3.5 GeV\nImpressum\n## Empty\n## Team\nmore", "a\nb\nc\nd\n| 1 |\n---\n| 2 |\n|" + "|".join("x" * 13) + "|"]


@register("cleaned_lines", expected("case_id BIGINT, line_no INTEGER, line VARCHAR", [
    *[(0, i, x) for i, x in enumerate(["# Source URL", "", "https://x", ""])], (0, 6, "## Team"), (0, 7, "words Next to"), (0, 8, ""), (0, 9, ""), (0, 12, "end"), (0, 15, "## Empty"), (0, 17, "more"),
    *[(1, i, x) for i, x in enumerate("abcd")], (1, 4, "| 1 |"), (1, 6, "| 2 |"),
]))
def cleaned_lines(spark, sf_dir):
    """The final cleanup: header kept, blank runs, legal links, rules, units, empty and repeated headings, spacing."""
    df = spark.createDataFrame(list(enumerate(CLEANED)), "case_id long, text string")
    return cleanup.clean_pages(df, "case_id", "text").withColumnRenamed("id", "case_id")


DEEP = ["<div>" * 4000 + "x", "<a href='http://[bad'>link</a>", "<table><tr><td>" * 300 + "y", "plain"]


@register("page_failures", expected("case_id BIGINT, n INTEGER, error VARCHAR", [(0, 1, None), (1, 0, None), (2, None, "ValueError: no such page"), (3, 1, None)]))
def page_failures(spark, sf_dir):
    """A page that an operator fails on is a row with its error; deep and broken pages don't fail."""

    def count(url, root):
        if root.find_all("td"):
            raise ValueError("no such page")
        extract.markdown("http://[bad", root), extract.event("http://[bad", root)
        return [{"n": int(not extract.external_links("http://[bad", root) and not root.find_all("a"))}]

    return extract.apply(_pages(spark, DEEP), count, "n int", errors=True).withColumnRenamed("page_id", "case_id")


@register("deep_nodes", expected("case_id BIGINT, n BIGINT, deepest INTEGER, nav BIGINT", [(0, 4000, 3999, 0), (1, 3, 2, 2)]))
def deep_nodes(spark, sf_dir):
    """The node table of a page of four thousand boxes in each other, and what lies inside navigation."""
    nodes = dom.dom_nodes(_pages(spark, [DEEP[0], "<nav><ul><li>x</li></ul></nav>"]))
    return nodes.groupBy(F.col("page_id").alias("case_id")).agg(F.count("*").alias("n"), F.max("depth").alias("deepest"), F.count_if("nav").alias("nav"))


CLEAN = ["Visit https://x.org on 01.02.2024 [1] now .Then moreWords", "Äpfel in Straße", "fÃ¼r â€œquotesâ€\x9d", "Москва и Αθήνα"]


@register("cleaned_texts", expected("case_id BIGINT, v2 VARCHAR", [(0, "Visit on  now.Then more. Words"), (1, "Apfel in Strasse"), (2, 'fur "quotes"'), (3, "Moskva i Athena")]))
def cleaned_texts(spark, sf_dir):
    """ASCII text: mended encodings, other scripts by their Latin letters, without addresses, dates and notes."""
    return spark.createDataFrame(list(enumerate(CLEAN)), "case_id long, t string").select("case_id", scripts.to_ascii()(F.col("t")).alias("t")).select("case_id", X.cleaned_v2(F.col("t")).alias("v2"))
