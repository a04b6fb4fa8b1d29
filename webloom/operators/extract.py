"""Structured content of pages: items in document order, tables, cells, contacts, events, markdown.

Each function takes a parsed page and is pure; ``apply`` runs one over a table of pages in Arrow batches. Pages are units of work:
no state goes from one to the next.
"""

from __future__ import annotations

import re
from urllib.parse import urljoin, urlsplit

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.functions.text import EMAIL, UI_KEYWORDS
from webloom.operators.batches import frames
from webloom.operators.cells import widened
from webloom.operators.dom import NAVIGATION, Node, parse
from webloom.operators.render import merged, signature, table_markdown

HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
_EMAIL = re.compile(EMAIL)
_PHONE = re.compile(r"\+?\d[\d\s()/.\-]{6,}\d")
_NAME = re.compile(r"\b[A-ZÄÖÜ][a-zäöüß]+(?:[\s-]+[A-ZÄÖÜ][a-zäöüß]+)+\b")
#: Fixed values (H13d, H14): hosts of video meetings; words of a person's position.
TITLES = {"head", "manager", "leader", "director", "professor", "prof", "engineer", "scientist", "secretary", "coordinator", "group", "department", "office"}
VIDEO_HOSTS = ("zoom.us", "teams.microsoft", "meet.google", "webex", "bluejeans")


def inside(node: Node, tags) -> bool:
    return any(a.tag in tags for a in node.ancestors())


def scope(root: Node) -> Node:
    """main, else article, else body, else the page."""
    for tag in ("main", "article", "body"):
        if found := root.find_all(tag):
            return found[0]
    return root


def link_text(node: Node) -> str:
    """Text with its links as markdown; without recursion, however deep."""
    out, stack = [], [node]
    while stack:
        item = stack.pop()
        if isinstance(item, str):
            if item.strip():
                out.append(" ".join(item.split()))
        elif item.tag == "a" and item.attrs.get("href") and (text := item.text()):
            out.append(f"[{text}]({item.attrs['href']})")
        elif item.tag == "br":
            out.append("\n")
        elif item is node or item.tag not in ("img", "script", "style"):
            stack.extend(reversed(item.children))
    return re.sub(r" ?\n ?", "\n", " ".join(out)).strip()


def table(node: Node) -> dict:
    """Caption, headers and rows of a table, without the rows of tables inside it; rows with nothing in them are left out."""
    own = lambda n: next((a for a in n.ancestors() if a.tag == "table"), None) is node
    rows = [r for r in node.find_all("tr") if own(r)]
    cells = lambda r: [c for c in r.children if isinstance(c, Node) and c.tag in ("td", "th")] or [c for c in r.find_all("td", "th") if own(c)]
    caption = next((c.text() for c in node.find_all("caption") if own(c)), "")
    headers: list[str] = []
    head = [r for r in rows if inside_own(r, node, "thead")]
    if head:
        headers, rows = [c.text() for c in cells(head[0])], [r for r in rows if r not in head]
    elif rows:
        first = cells(rows[0])
        if first and sum(c.tag == "th" for c in first) * 2 >= len(first):
            headers, rows = [c.text() for c in first], rows[1:]
    body = [[link_text(c) for c in cells(r)] for r in rows]
    return {"headers": headers, "rows": [r for r in body if any(r)], "caption": caption}


def inside_own(node: Node, top: Node, tag: str) -> bool:
    for a in node.ancestors():
        if a is top:
            return False
        if a.tag == tag:
            return True
    return False


#: Fixed values (H1b): class and id words of boxes whose headings are navigation.
_NAV_BOX = re.compile(r"nav|sidebar|menu|header|footer|topbar|breadcrumb", re.I)
_LABEL_WORD = re.compile(r"(?:e-?mail|phone|tel|location|office|room):\s*")
_LINKED = re.compile(r"\[([^\]]+)\]\([^)]+\)")


def tokens(text: str) -> set[str]:
    """Words of three letters and more that tell a row from others."""
    return {w for w in text.split() if len(w) >= 3} - {"the", "and", "for"}


def ui_table(found: dict, repository: str | None) -> bool:
    """A table of a repository's search form and not of its records."""
    if not repository:
        return False
    text = " ".join([*found["headers"], *(c for r in found["rows"] for c in r)]).lower()
    form = repository in text and re.search("login|guest|search:|submit", text)
    return bool((any(k in text for k in UI_KEYWORDS) or form) and not re.search(re.escape(repository) + r"-\d{4}-\d{5}", text))


def items(root: Node, repository: str | None = None) -> list[dict]:
    """Headings, paragraphs, lists and tables of the main scope in document order.

    Headings once a page; where the scope is the body, none inside navigation or boxes named so. Paragraphs of 30 characters (15
    behind a heading of their parent or with a question), outside of navigation, not links only, and none that repeats a table's
    row. Lists outside of navigation by their own items. Tables outside of tables; with a repository's name, not its search form."""
    top = scope(root)
    out, heads, rows = [], set(), []
    boxed, nav = {top.id: False}, {top.id: top.tag in NAVIGATION or inside(top, NAVIGATION)}
    silent, tabled, headed = {top.id: False}, {top.id: top.tag == "table" or inside(top, ("table",))}, set()
    for n in top.walk():
        if n is top:
            continue
        up = n.parent.id
        box = n.tag in ("div", "section") and _NAV_BOX.search(n.attrs.get("class", "") + " " + n.attrs.get("id", ""))
        boxed[n.id] = boxed[up] or bool(box)
        nav[n.id] = nav[up] or n.tag in NAVIGATION
        silent[n.id] = silent[up] or n.tag in ("script", "style")
        tabled[n.id] = tabled[up] or n.tag == "table"
        if silent[n.id]:
            continue
        if n.tag in HEADINGS:
            headed.add(up)
            text = n.text()
            if text and text not in heads and not (top.tag == "body" and (nav[n.id] or boxed[n.id])):
                heads.add(text)
                out.append({"type": "heading", "level": int(n.tag[1]), "text": text, "pos": n.id, "table": None})
        elif n.tag == "table" and not tabled[up]:
            found = table(n)
            if found["rows"] and not ui_table(found, repository):
                found = widened(found)
                out.append({"type": "table", "level": 0, "text": found["caption"], "pos": n.id, "table": found})
                said = (_LINKED.sub(r"\1", " ".join(r)).lower() for r in found["rows"])
                rows += [tokens(x) for x in said if len(x) > 30]
        elif n.tag == "p" and not nav[up]:
            joined, text = n.text(""), n.text()
            links = n.find_all("a")
            words = tokens(_LABEL_WORD.sub("", text.lower()))
            repeats = any(len(words & r) >= 3 and len(words & r) * 2 >= len(words) for r in rows)
            long = len(joined) >= (15 if joined.endswith("?") or up in headed else 30)
            if long and not (links and len(joined) < 50 and len(links) >= len(joined.split())) and not repeats:
                out.append({"type": "paragraph", "level": 0, "text": link_text(n), "pos": n.id, "table": None})
        elif n.tag in ("ul", "ol") and not nav[up]:
            own = [x for c in n.children if isinstance(c, Node) and c.tag == "li" and (x := link_text(c))]
            if own:
                mark = (lambda i: f"{i}. ") if n.tag == "ol" else (lambda i: "  * ")
                out.append({"type": "list", "level": int(n.tag == "ol"), "text": "\n".join(mark(i) + x.replace("\n", " ") for i, x in enumerate(own, 1)), "pos": n.id, "table": None})
    return out


def body_markdown(root: Node, repository: str | None = None) -> str:
    """The page's items; tables with equal beginnings once, runs of single-row tables together."""
    out, seen, held = [], set(), []

    def flush():
        for t in merged(held):
            sign = signature(t)
            if not sign or sign not in seen:
                if text := table_markdown(t):
                    out.append(text + "\n")
                    seen.add(sign)
        held.clear()

    for item in items(root, repository):
        if item["type"] == "table":
            held.append(item["table"])
            continue
        flush()
        out.append(("#" * item["level"] + " " if item["type"] == "heading" else "") + item["text"] + "\n")
    flush()
    return "\n".join(out)


def markdown(url: str | None, root: Node) -> str:
    """The page's items under its source."""
    return f"# Source URL\n\n{url or ''}\n\n{body_markdown(root)}"


def host_of(url: str | None) -> str:
    """The host without ``www.``; '' for what is no URL."""
    try:
        return urlsplit(url or "").netloc.removeprefix("www.")
    except ValueError:
        return ""


def external_links(url: str | None, root: Node) -> list[dict]:
    """Links to other hosts outside of tables, each target once, with the heading above."""
    own = host_of(url)
    out, seen, near, low = [], set(), None, None
    tabled = {0: False}
    for n in root.walk():
        if n is not root:
            tabled[n.id] = tabled[n.parent.id] or n.tag in ("table", "td", "th")
        if n.tag in HEADINGS and n.text():
            if n.tag <= "h3":
                near = n.text()
            elif low is None or n.tag <= low[0]:
                low = n.tag, n.text()
        elif n.tag == "a" and (href := n.attrs.get("href", "")) and not href.startswith(("#", "mailto:", "javascript:")) and not tabled[n.id]:
            try:
                target = urljoin(url or "", href)
                other = urlsplit(target).netloc.removeprefix("www.")
            except ValueError:
                continue
            if other and other != own and target not in seen:
                seen.add(target)
                out.append({"section": near or (low[1] if low else "External Links"), "seq": len(out), "text": n.text() or target, "href": target})
    return out


def contacts(root: Node) -> list[dict]:
    """A contact for each mail link: the ancestor that says most about it; kept with a name, phone or title."""
    out = []
    for link in root.find_all("a"):
        if not (found := _EMAIL.search(link.attrs.get("href", "") if link.attrs.get("href", "").lower().startswith("mailto:") else "")):
            continue
        best, most = link, -1
        for a in list(link.ancestors())[:4]:
            text = a.text()
            if a.tag in ("body", "html", "#root") or len(_EMAIL.findall(text)) > 1:
                break
            score = 10 * bool(_NAME.search(text)) + 5 * (len(text) > 20) + 2 * bool(_PHONE.search(text))
            if score > most:
                best, most = a, score
        text = best.text("\n")
        names = [m for line in text.split("\n") for m in _NAME.findall(line) if not TITLES & {w.lower() for w in m.split()}]
        title = next((line for line in text.split("\n") if TITLES & {w.lower().strip(".,") for w in line.split()}), None)
        phone = _PHONE.search(text)
        pronoun = re.search(r"\((he|she|they)/(him|her|them)\)", text)
        if names or phone or title:
            out.append({"email": found[0].lower(), "name": names[0] if names else None, "phone": phone[0].strip() if phone else None, "title": title, "pronoun": pronoun[0].strip("()") if pronoun else None, "full_text": " ".join(text.split())})
    return out


_WEEKDAY = re.compile(r"(?:Mon|Tues|Wednes|Thurs|Fri|Satur|Sun)day\s+\w+\s+\d+", re.I)
_NUMBER_DATE = re.compile(r"\d{1,2}[/.-]\d{1,2}[/.-]\d{2,4}")
TIME = re.compile(r"\d{1,2}:\d{2}\s*(?:AM|PM)?", re.I)
#: Fixed values (H13): words of deadlines, endings of material, and what an agenda and its entries are called.
DEADLINES = ("deadline", "registration", "submission", "abstract")
MATERIAL, FILES = (".pdf", ".pptx", ".ppt", ".doc", "/attachments/", "/material/"), (".pdf", ".pptx", ".ppt", ".docx")


def _one(node: Node, tags: tuple[str, ...], *words: str, by: tuple[str, ...] = ("class",)) -> Node | None:
    """The first such element with one of the words in its class (or id); of several attributes the first that finds one."""
    for attribute in by:
        for n in node.walk():
            if n is not node and n.tag in tags and any(w in n.attrs.get(attribute, "").lower() for w in words):
                return n
    return None


def event(url: str | None, root: Node) -> dict:
    """Title, date, place, video links, description, deadlines, agenda (20 entries with time, title, speaker and material), files if
    there is no agenda, and outside links (10)."""
    site = re.match(r"https?://[^/]*", url or "")
    whole = lambda href: (site[0] if site else "") + href if href.startswith("/") else href
    text = lambda n: n.text() if n is not None else None
    title = _one(root, ("h1",), "title") or next(iter(root.find_all("h1")), None)
    boxes = root.find_all("span", "div", "p")
    date = _one(root, ("time", "span", "div"), "date", "time") or next((n for n in root.find_all("time") if n.attrs.get("datetime")), None) or next((n for n in boxes if _WEEKDAY.search(n.text())), None)
    place = _one(root, ("span", "div"), "location") or next((n for n in boxes if re.fullmatch(r"\d+\s*\(\d+\)", n.text()) or "room" in n.text().lower()), None)
    links = [(a.attrs["href"], a.text()) for a in root.find_all("a") if a.attrs.get("href")]
    about = text(_one(root, ("div", "section"), "description", by=("class", "id")))
    found = []
    for word in DEADLINES:
        for n in root.find_all("div", "span", "p", "dt", "dd"):
            low = n.text().lower()
            if word in low and ("deadline" in low or _NUMBER_DATE.search(low)) and len(low) < 200:
                found.append(n.text())
    table_ = _one(root, ("div", "section", "ul"), "timetable", "contributions", "agenda") or _one(root, ("div", "section"), "timetable", "schedule", by=("id",))
    agenda = []
    entries = [n for n in table_.find_all("div", "li", "tr") if any(w in n.attrs.get("class", "").lower() for w in ("entry", "contribution", "talk"))] if table_ else []
    for n in entries[:20]:
        time, head, speaker = TIME.search(n.text()), text(_one(n, ("span", "div", "a"), "title")), text(_one(n, ("span", "div"), "speaker"))
        if time or head or speaker:
            agenda.append("".join([f"**{time[0].strip()}** " if time else "", f"- {head}" if head else "", f" (Speaker: {speaker})" if speaker else ""]))
            agenda += [f"  - [{a.text() or 'Attachment'}]({whole(a.attrs['href'])})" for a in n.find_all("a") if any(m in a.attrs.get("href", "").lower() for m in MATERIAL)]
    own = host_of(url)
    outside = dict.fromkeys(h for h, t in links if h.startswith("http") and len(t) > 2 and not (own and host_of(h) == own))
    return {
        "title": text(title),
        "date": text(date) or (date.attrs.get("datetime") if date is not None else None),
        "location": text(place),
        "video": [h for h, _ in links if any(v in h.lower() for v in VIDEO_HOSTS)],
        "description": about[:1000] if about and len(about) > 10 else None,
        "deadlines": found,
        "agenda": agenda,
        "attachments": [] if agenda else [f"[{t}]({whole(h)})" for h, t in links if any(x in h.lower() for x in FILES) and 0 < len(t) < 100],
        "links": list(outside)[:10],
    }


#: Fixed values (H13j): a warning that event systems show to old browsers.
_WARNING = re.compile(r"(?:#{1,6}\s*)?⚠\s*Your browser is out of date\s*⚠.*?may not work correctly in this browser\.?\s*\n?", re.I | re.S)


def event_markdown(url: str | None, root: Node) -> str:
    """An event page as markdown, without browser warnings and with no more than two blank lines in a row."""
    e = event(url, root)
    bullets = lambda xs: "\n".join(f"- {x}" for x in xs)
    names = {a.attrs.get("href"): a.text() for a in reversed(root.find_all("a"))}
    link = lambda h: f"[{names.get(h) or h}]({h})"
    parts = [
        e["title"] and f"# {e['title']}", e["date"] and f"**Date:** {e['date']}", e["location"] and f"**Location:** {e['location']}",
        e["video"] and "**Video Conference:**\n" + bullets(map(link, e["video"])), e["description"] and f"**Description:**\n{e['description']}",
        "\n".join(f"**{d}**" for d in e["deadlines"]), e["agenda"] and "## Agenda/Contributions\n\n" + "\n".join(e["agenda"]),
        e["attachments"] and "## Attachments\n\n" + bullets(e["attachments"]), e["links"] and "## External Links\n\n" + bullets(map(link, e["links"])),
    ]
    return re.sub(r"\n{4,}", "\n\n\n", _WARNING.sub("", "\n\n".join(x for x in parts if x))).strip()


def apply(pages: DataFrame, function, schema: str, id_col: str = "page_id", errors: bool = False) -> DataFrame:
    """Rows that function(url, root) returns for each page (url, html), behind the page's id.

    A page that the function fails on has no rows and doesn't fail the others; with ``errors`` it has one row of nulls, and every
    row has what went wrong in a column ``error``."""
    names = [c.strip().split(" ")[0] for c in re.split(r",(?![^<]*>)", schema)]
    columns = ["page_id", *names, *(["error"] if errors else [])]

    def rows_of(page, url, html):
        try:
            return [(page, *[r[n] for n in names], *([None] if errors else [])) for r in function(url, parse(html))]
        except Exception as problem:  # one page's failure is its own
            return [(page, *[None] * len(names), f"{type(problem).__name__}: {problem}"[:500])] if errors else []

    def run(batches):
        yield from frames((row for pdf in batches for page in zip(pdf["id"], pdf["url"], pdf["html"], strict=True) for row in rows_of(*page)), columns)

    return pages.select(F.col(id_col).cast("long").alias("id"), "url", "html").mapInPandas(run, f"page_id long, {schema}" + (", error string" if errors else ""))
