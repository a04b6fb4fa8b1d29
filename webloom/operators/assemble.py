"""Assembling pages: boilerplate out of the node table, sections, tables with their links, contact lines.

Node rules are windows and equi-joins over the node table: a subtree is a range of numbers, so what lies inside a marked element, and
how many links it holds, comes from running maxima and sums and needs no range join. Folds over one page's lines are pure
functions that ``extract.apply`` runs page by page.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webloom.functions.text import CONTACT_SIGNAL, EMAIL
from webloom.operators import extract
from webloom.operators.dom import Node

#: Class and id words of elements that carry no content of the page.
BOILERPLATE = r"(?i)(^|[\s_-])(nav|navigation|menu|breadcrumbs?|footer|header|sidebar|cookie|privacy|loading|skip|hidden)([\s_-]|$)"
BLOCKS = ("p", "div", "li", "ul", "ol", "section", "article", "td")
LAST_SECTION = "External Links"
LABEL_ORDER = ["Name", "E-Mail", "Phone", "Location"]
SHORT, ABSORBED = 80, 5
GENERIC = {"", "e-mail", "email", "mail", "link", "here", "contact"}
_LINK = re.compile(r"\[([^\]]*)\]\([^)]*\)")
_SIGNAL = re.compile(CONTACT_SIGNAL)


def attribute(name: str) -> Column:
    return F.coalesce(F.try_element_at("attrs", F.lit(name)), F.lit(""))


def is_boilerplate() -> Column:
    """By class, id or style: menus, footers, cookie notes and whatever is hidden."""
    named = attribute("class").rlike(BOILERPLATE) | attribute("id").rlike(BOILERPLATE)
    hidden = F.map_contains_key("attrs", F.lit("hidden")) | (attribute("aria-hidden") == "true") | attribute("style").rlike(r"(?i)display\s*:\s*none|visibility\s*:\s*hidden")
    return named | hidden


def without_subtrees(nodes: DataFrame, marked: Column) -> DataFrame:
    """Nodes that are neither marked nor inside a marked one."""
    order = Window.partitionBy("page_id").orderBy("node_id").rowsBetween(Window.unboundedPreceding, 0)
    reach = F.coalesce(F.max(F.when(marked, F.col("last"))).over(order), F.lit(-1))
    return nodes.withColumn("__reach", reach).where(F.col("__reach") < F.col("node_id")).drop("__reach")


def words_in(text: Column) -> Column:
    return F.size(F.filter(F.split(F.trim(text), r"\s+"), lambda w: w != ""))


def link_heavy(nodes: DataFrame, links: int = 3, chars: int = 200) -> DataFrame:
    """Lists and boxes of more links than that and less text: menus without a telling name."""
    return nodes.where(F.col("tag").isin("div", "ul", "ol", "li") & (F.col("links") > links) & (F.length("text") < chars))


def dense_blocks(nodes: DataFrame, least: int = 5, share: float = 0.5) -> DataFrame:
    """(page_id, node_id, tag, words, density) of blocks with enough words of which few are links: density is the share of words outside links."""
    words = words_in(F.col("text"))
    counted = nodes.where(F.col("tag").isin(*BLOCKS)).withColumn("words", words).where(F.col("words") >= least)
    density = 1 - F.col("link_words") / F.col("words")
    return counted.withColumn("density", density).where(F.col("density") >= share).select("page_id", "node_id", "tag", F.col("words").cast("long").alias("words"), "density")


def grouped_links(links: DataFrame) -> DataFrame:
    """(page_id, sections): links (page_id, section, seq, text, href) by section, sections sorted, those under no heading last."""
    by = links.groupBy("page_id", "section").agg(F.array_sort(F.collect_list(F.struct("seq", "text", "href"))).alias("links"))
    placed = F.array_sort(F.collect_list(F.struct((F.col("section") == LAST_SECTION).alias("last"), "section", "links")))
    return by.groupBy("page_id").agg(F.transform(placed, lambda s: F.struct(s["section"].alias("section"), s["links"].alias("links"))).alias("sections"))


def empty_sections(lines: DataFrame, doc: str = "doc_id") -> DataFrame:
    """(doc, line_no): headings with nothing but blanks and rules to the next one, unless a heading of their own or a higher level follows."""
    t = F.trim("line")
    level = F.when(t.startswith("#"), F.length(F.regexp_extract(t, "^(#+)", 1)))
    filled = level.isNull() & (t != "") & ~t.rlike(r"^[|\-\s]+$")
    order = Window.partitionBy(doc).orderBy("line_no")
    marked = lines.select(doc, "line_no", level.alias("level"), filled.alias("filled")).withColumn("section", F.count("level").over(order))
    sections = marked.where("section > 0").groupBy(doc, "section").agg(F.min("line_no").alias("line_no"), F.max("level").alias("level"), F.count_if("filled").alias("n"))
    after = F.lead("level").over(Window.partitionBy(doc).orderBy("section"))
    return sections.withColumn("after", after).where((F.col("n") == 0) & (F.col("after").isNull() | (F.col("after") > F.col("level")))).select(doc, "line_no")


def without_known_headings(lines: DataFrame, headings: DataFrame, doc: str = "doc_id") -> DataFrame:
    """lines less the headings that ``headings`` (doc, heading) has already, compared without marks and case."""
    key = F.lower(F.trim(F.regexp_replace("line", "^#+", "")))
    known = headings.select(doc, F.lower(F.trim("heading")).alias("__key")).distinct()
    marked = lines.withColumn("__key", F.when(F.trim("line").startswith("#"), key))
    return marked.join(known, [doc, "__key"], "left_anti").select(*lines.columns)


def without_listed_headings(lines: DataFrame, headings: str) -> DataFrame:
    """lines less the headings that the row's own array ``headings`` has already, compared without marks and case."""
    key = F.lower(F.trim(F.regexp_replace("line", "^#+", "")))
    known = F.transform(headings, lambda h: F.lower(F.trim(h)))
    return lines.where(~(F.trim("line").startswith("#") & F.array_contains(known, key))).drop(headings)


def without_table_text(lines: DataFrame, tables: DataFrame, doc: str = "doc_id", least: int = 5) -> DataFrame:
    """lines less those of more characters than that which their page's tables (doc, text: one row a page) contain."""
    plain = lambda c: F.lower(F.regexp_replace(F.trim(c), r"\s+", " "))
    both = lines.join(tables.select(doc, plain(F.col("text")).alias("__cells")), doc, "left")
    free = ~F.trim("line").rlike(r"^[#|\-*]") & (F.length(plain(F.col("line"))) > least) & F.contains("__cells", plain(F.col("line")))
    return both.where(~F.coalesce(free, F.lit(False))).select(*lines.columns)


def fallback_reason(markdown: Column, html: Column) -> Column:
    """Why a page's markdown isn't enough and its HTML must be read again; null where it is."""
    rows = F.size(F.filter(F.split(markdown, "\n"), lambda x: x.contains("|")))
    tables = F.regexp_count(html, F.lit("(?i)<table[ >]"))
    mails = F.regexp_count(html, F.lit("mailto:"))
    return (
        F.when(F.trim(markdown) == "", "empty")
        .when((F.length(html) > 1000) & (F.length(F.trim(markdown)) < 50), "thin")
        .when(F.length(F.trim(markdown)) < 100, "short")
        .when((tables > 0) & (rows < 2), "tables_missing")
        .when((mails >= 3) & (F.regexp_count(markdown, F.lit("mailto:")) < mails), "contacts_missing")
    )


def source_free(text: Column) -> Column:
    """Without the source heading, address lines, breadcrumbs and lines that are an address only."""
    lines = F.filter(F.split(text, "\n"), lambda x: ~F.trim(x).rlike(r"^(# Source URL|URL:.*|Breadcrumb.*|https?://\S+)$"))
    return F.array_join(lines, "\n")


def image_references(paths: Column) -> Column:
    """An array of image paths as numbered markdown images, a line each."""
    return F.array_join(F.transform(paths, lambda x, i: F.concat(F.lit("![Image "), (i + 1).cast("string"), F.lit("]("), x, F.lit(")"))), "\n")


def header_order(labels: Column) -> Column:
    """An array of labels in the order of a staff table: the fixed ones first, the others sorted."""
    rank = lambda x: F.coalesce(F.nullif(F.array_position(F.array(*[F.lit(n) for n in LABEL_ORDER]), x), F.lit(0)), F.lit(len(LABEL_ORDER) + 1))
    return F.transform(F.array_sort(F.transform(F.array_distinct(labels), lambda x: F.struct(rank(x).alias("rank"), x.alias("label")))), lambda s: s["label"])


def plain(cell: str) -> str:
    """A cell as it reads: links as their text, white space once."""
    return " ".join(_LINK.sub(r"\1", cell).split())


def text_cells(line: str) -> list[str]:
    return [c.strip() for c in re.split(r"(?<!\\)\|", line.strip().removeprefix("|").removesuffix("|"))]


def is_rule(line: str) -> bool:
    return bool(re.fullmatch(r"\|[\s:|\-]*-{3,}[\s:|\-]*\|?", line.strip()))


def table_blocks(lines: list[str]) -> list[tuple[int, int]]:
    """Runs of table lines, as half-open ranges."""
    out, start = [], None
    for i, line in enumerate([*lines, ""]):
        if line.strip().startswith("|"):
            start = i if start is None else start
        elif start is not None:
            out.append((start, i))
            start = None
    return out


def likeness(rows: list[list[str]], found: dict) -> int:
    """Words that the first cells share, and what of the first cell the table holds."""
    words = lambda row: {w for c in row[:3] for w in re.findall(r"\w+", plain(c)[:30].lower())}
    if not rows or not found["rows"]:
        return 0
    everything = " ".join(plain(c) for r in [found["headers"], *found["rows"]] for c in r).lower()
    name = plain(rows[0][0]).lower() if rows[0] else ""
    return len(words(rows[0]) & words(found["rows"][0])) + 5 * bool(name and name in everything) + 2 * sum(len(w) > 3 and w in everything for w in name.split())


def matched(tables: list[list[list[str]]], found: list[dict]) -> list[dict | None]:
    """For each text table the likest page table that none before it took, else the one at its place."""
    used: set[int] = set()
    out: list[dict | None] = []
    for n, rows in enumerate(tables):
        best = max((i for i in range(len(found)) if i not in used), key=lambda i: (likeness(rows, found[i]), -i), default=None)
        if best is None or likeness(rows, found[best]) < 1:
            best = n if n < len(found) and n not in used else None
        if best is not None:
            used.add(best)
        out.append(found[best] if best is not None else None)
    return out


def with_table_links(markdown: str, root: Node) -> str:
    """Markdown whose table cells have the links of the page's cells that read the same."""
    lines = markdown.split("\n")
    ranges = table_blocks(lines)
    found = [extract.table(n) for n in root.find_all("table") if not extract.inside(n, ("table",))]
    bodies = []
    for start, stop in ranges:
        rule = next((i for i in range(start, stop) if is_rule(lines[i])), start - 1)
        bodies.append([i for i in range(rule + 1, stop) if not is_rule(lines[i])])
    for body, page in zip(bodies, matched([[text_cells(lines[i]) for i in b] for b in bodies], found), strict=True):
        if page is None:
            continue
        by_first = {plain(r[0]): r for r in reversed(page["rows"]) if r}
        for n, i in enumerate(body):
            cells = text_cells(lines[i])
            row = by_first.get(plain(cells[0]), page["rows"][n] if n < len(page["rows"]) else [])
            new = [h.replace("\n", " ") if "](" in h and "](" not in c and plain(h) == plain(c) else c for c, h in zip(cells, [*row, *[""] * len(cells)], strict=False)]
            if new != cells:
                lines[i] = "| " + " | ".join(new) + " |"
    return "\n".join(lines)


def with_addresses(markdown: str, contacts: list[dict]) -> str:
    """Names behind an e-mail label become links to the addresses that the page's contacts give them."""
    mails = {c["name"].lower(): c["email"] for c in reversed(contacts) if c["name"]}
    link = lambda m: f"{m[1]}[{m[2].strip()}](mailto:{mails[m[2].strip().lower()]})" if m[2].strip().lower() in mails else m[0]
    return re.sub(r"(?im)^((?:\|\s*)?e-?mail:?\s*\|?\s*)([^|\[\]\n@]+)", link, markdown)


#: Fixed values (F12): a phone number, a place's code, and what looks like one and isn't.
_CALL = re.compile(r"(?<![\w/])\+?\d[\d\s()/-]{6,}\d")
_PLACE = re.compile(r"\b\d+[a-z]?\s*/\s*[A-Z]?\d+[a-z]?\b")
_NO_PLACE = re.compile(r"\b(?:ISBN|DOI|[A-Z]{3,}-\d{4})", re.I)


def cell_text(node: Node) -> str:
    """A cell with its links: empty and generic link texts as the address or the title, a repeated address bare, doubled words once."""
    out, seen, stack = [], set(), [node]
    while stack:
        item = stack.pop()
        if isinstance(item, str):
            out.append(" ".join(item.split()))
        elif item.tag == "a" and item.attrs.get("href"):
            href, text = item.attrs["href"], item.text()
            address = re.search(EMAIL, href) if href.lower().startswith("mailto:") else None
            if text.lower() in GENERIC:
                text = address[0] if address else item.attrs.get("title") or item.attrs.get("aria-label") or text
            if address and address[0].lower() in seen:
                out.append(address[0])
            elif text:
                out.append(f"[{text}]({href})")
            if address:
                seen.add(address[0].lower())
        elif item.tag == "br":
            out.append("\n")
        elif item is node or item.tag not in ("img", "script", "style"):
            stack.extend(reversed(item.children))
    text = re.sub(r" *\n *", "\n", " ".join(x for x in out if x)).strip()
    return re.sub(r"\b([A-ZÄÖÜ][a-zäöüß]+) \1\b", r"\1", text)


def labelled_cell(text: str) -> str:
    """A cell whose address, number (eight digits, no years) or place has no label gets one."""
    if re.search(r"\]\(mailto:", text) and not re.search(r"(?i)e-?mail\s*:", text):
        text = re.sub(r"(\[[^\]]*\]\(mailto:)", r"E-mail: \1", text, count=1)
    found = _CALL.search(re.sub(r"\([^)]*@[^)]*\)", "", text))
    if found and len(re.sub(r"\D", "", found[0])) >= 8 and not re.fullmatch(r"(?:19|20)\d\d\s*[-/]\s*(?:19|20)\d\d", found[0].strip()) and not re.search(r"(?i)(?:phone|tel|fax)[.:]?", text):
        text = text.replace(found[0], f"Phone: {found[0].strip()}", 1)
    place = _PLACE.search(text)
    if place and not _NO_PLACE.search(text) and not re.search(r"(?i)(?:location|office|room)\s*:", text):
        text = text.replace(place[0], f"Location: {place[0]}", 1)
    return text


def contact_line(contact: dict) -> str:
    """A contact as one line of labelled fields."""
    fields = [("Name", contact["name"]), ("Title", contact["title"]), ("E-Mail", contact["email"] and f"[{contact['email']}](mailto:{contact['email']})"), ("Phone", contact["phone"])]
    return " | ".join(f"{k}: {v}" for k, v in fields if v)


def merged_contact_lines(lines: list[str]) -> list[str]:
    """A line that is a name takes in up to five short lines after it, through the first with a contact."""
    out, i = [], 0
    while i < len(lines):
        if extract._NAME.fullmatch(lines[i].strip()):
            ahead = 0
            while ahead < ABSORBED and i + ahead + 1 < len(lines) and 0 < len(lines[i + ahead + 1].strip()) < SHORT:
                ahead += 1
                if _SIGNAL.search(lines[i + ahead]):
                    out.append(" ".join(x.strip() for x in lines[i : i + ahead + 1]))
                    i += ahead + 1
                    break
            else:
                out.append(lines[i])
                i += 1
        else:
            out.append(lines[i])
            i += 1
    return out


def is_row(line: str) -> bool:
    return bool(re.match(r"\|\s*[^|]+\s*\|", line.strip()))


def without_fragments(lines: list[str]) -> list[str]:
    """Lines without what lost tables left behind: rules under no header, text with two and more rows close below, rows of one cell in
    runs or below a name, and last rows outside of tables. A header over a rule begins a table, which stays whole."""
    bare = [x.strip() for x in lines]
    rule = lambda x: bool(re.match(r"\|[\s\-:]+\|", x))
    single = lambda x: bool(re.fullmatch(r"\|\s+[^|]+(?:\s*\|)?", x))
    out, i, table = [], 0, False
    lost = set(table_fragments(lines))
    while i < len(lines):
        t, after = bare[i], bare[i + 1] if i + 1 < len(lines) else ""
        if table:
            table = t.startswith("|")
            out.append(lines[i])
        elif rule(t):
            if i and is_row(bare[i - 1]):
                table = is_row(after)
                out.append(lines[i])
        elif is_row(t) and rule(after):
            table = True
            out.append(lines[i])
        elif i in lost:
            rows = [j for j in range(i + 1, min(len(lines), i + 15)) if bare[j].startswith("|")]
            stop = next((j for j in range(i + 1, min(len(lines), i + 15)) if bare[j] and not bare[j].startswith("|")), len(lines))
            i = max(j for j in rows if j < stop)
        elif single(t):
            ahead = next((bare[j] for j in range(i + 1, min(len(lines), i + 10)) if bare[j]), "")
            name = any(bare[j] and not bare[j].startswith(("|", "#")) for j in (i - 1, i - 2) if j >= 0)
            if not (single(ahead) or name):
                out.append(lines[i])
        elif not (is_row(t) and i + 1 < len(lines) and not rule(after) and not is_row(after)):
            out.append(lines[i])
        i += 1
    return out


def table_fragments(lines: list[str], reach: int = 14, rows: int = 2, gap: int = 2) -> list[int]:
    """Numbers of text lines with table rows close below, broken by no more blank lines than ``gap``: what a lost table left over."""
    out = []
    for i, line in enumerate(lines):
        if not line.strip() or line.strip()[0] in "|#":
            continue
        found = blank = 0
        for later in lines[i + 1 : i + 1 + reach]:
            if is_rule(later):  # a whole table
                found = 0
                break
            if later.strip().startswith("|"):
                found, blank = found + 1, 0
            elif later.strip():
                break
            else:
                blank += 1
                if blank > gap:
                    break
        if found >= rows:
            out.append(i)
    return out
