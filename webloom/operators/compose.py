"""A page's file: its source, what its HTML holds in order, what the markdown has beyond that, images, links to elsewhere."""

from __future__ import annotations

import re

from webloom.operators import assemble, extract, fallback
from webloom.operators.cleanup import separator
from webloom.operators.dom import Node

#: Fixed values (H23): labels of contact fields.
_FIELD = re.compile(r"\b(?:E-Mail|Email|Phone|Tel|Telephone|Location|Office|Room):", re.I)
_CONTACT = re.compile(r"mailto:|@|phone|tel|\+?\d{2,}", re.I)
_PLACE = re.compile(r"\d+\s*[a-z]\s*/\s*\d+|location|office|room", re.I)
_BROKEN = re.compile(r"[^|]+:\s*(?:-+\||\|)")
_LINK_ITEM = re.compile(r"- \[.*\]\(https?://[^)]+\)")
LINKS = "## External Links"
#: Characters of rendered content from which contact lines of the text count as said already.
SAID = 50


def _is_name(t: str) -> bool:
    words = t.split()
    return 0 < len(words) <= 3 and all(w[0].isupper() and w.replace("-", "").isalnum() for w in words)


def beyond(markdown: str, rendered: str) -> str:
    """What the markdown says that the rendered content doesn't: no headings it has, no tables, no labels of broken tables, no rules
    far from tables, and, if there is rendered content to speak of, no contacts and names before them."""
    heads = {" ".join(x.strip().lstrip("#").split()).lower() for x in rendered.split("\n") if x.strip().startswith("#")}
    lines = markdown.split("\n")
    bare = [x.strip() for x in lines]
    said = len(rendered.strip()) > SAID
    out, i = [], 0
    while i < len(lines):
        t = bare[i]
        if t.startswith("#"):
            head = " ".join(t.lstrip("#").split()).lower()
            keep = bool(head) and head not in heads
        elif not t:
            keep = True
        elif _BROKEN.match(t) and not t.startswith("|"):
            i += 1
            while i < len(lines) and (separator(bare[i]) or (_BROKEN.match(bare[i]) and not bare[i].startswith("|"))):
                i += 1
            continue
        elif separator(t):
            near = lambda js: any(bare[j].startswith("|") for j in js)
            keep = near(range(max(0, i - 10), i)) and near(range(i + 1, min(len(lines), i + 10))) and not t.startswith("|")
        elif t.startswith("|"):
            while i < len(lines) and (bare[i].startswith("|") or (not bare[i] and i + 1 < len(lines) and bare[i + 1].startswith("|"))):
                i += 1
            continue
        else:
            ahead = [bare[j] if j < len(lines) else "" for j in (i + 1, i + 2)]
            name = _is_name(t) and bool(_FIELD.search(ahead[0]) or (_is_name(ahead[0]) and _FIELD.search(ahead[1])))
            keep = " ".join(t.split()).lower() not in heads and not (said and (name or _FIELD.search(t) or _CONTACT.search(t) or _PLACE.search(t)))
        if keep:
            out.append(lines[i])
        i += 1
    return "\n".join(out).strip()


def links_section(links: list[dict]) -> str:
    """Links to elsewhere by their sections, sorted, those under no heading last."""
    by: dict[str, list[dict]] = {}
    for x in links:
        by.setdefault(x["section"], []).append(x)
    out = []
    for section in sorted(by, key=lambda s: (s == assemble.LAST_SECTION, s)):
        out += [f"## {section}", "", *(f"- [{x['text']}]({x['href']})" for x in by[section]), ""]
    return "\n".join(out).strip()


def one_links_header(lines: list[str]) -> list[str]:
    """The header of the links to elsewhere once, before the first of them."""
    heads = [i for i, x in enumerate(lines) if x.strip() == LINKS]
    drop = set()
    for i in heads[1:]:
        drop |= {i} | ({i + 1} if i + 1 < len(lines) and not lines[i + 1].strip() else set())
    lines = [x for i, x in enumerate(lines) if i not in drop]
    first = next((i for i, x in enumerate(lines) if _LINK_ITEM.match(x.strip())), None)
    if first is None or any(x.strip().startswith("## ") for x in lines[max(0, first - 2) : first]) or LINKS in (x.strip() for x in lines[:first]):
        return lines
    return [*lines[:first], *([""] if first and lines[first - 1].strip() else []), LINKS, "", *lines[first:]]


def without_empty_sections(lines: list[str]) -> list[str]:
    """Lines without headings that nothing follows but blanks and rules, to the end or to a heading below their own level."""
    level = lambda t: len(t) - len(t.lstrip("#"))
    bare = [x.strip() for x in lines]
    after: list[int | None] = [None] * (len(lines) + 1)  # the next heading at or behind each line
    filled = [False] * (len(lines) + 1)  # whether there is content before it
    for i in range(len(lines) - 1, -1, -1):
        head = bare[i].startswith("#")
        after[i] = i if head else after[i + 1]
        filled[i] = not head and (bool(bare[i]) and not separator(bare[i]) or filled[i + 1])
    out, i = [], 0
    while i < len(lines):
        t = bare[i]
        if t.startswith("#") and t.lstrip("#").strip() and not filled[i + 1]:
            stop = after[i + 1]
            if stop is None or level(bare[stop]) > level(t):
                i = len(lines) if stop is None else stop
                continue
        out.append(lines[i])
        i += 1
    return out


def page(url: str | None, root: Node, markdown: str = "", images: tuple[str, ...] = (), repository: str | None = None) -> str:
    """The whole file of a page. Without markdown of its own, the text is read from the HTML."""
    rendered = extract.body_markdown(root, repository).strip()
    text = markdown or fallback.page_text(url, root)
    text = "\n".join(assemble.without_fragments(text.split("\n"))).strip()
    rest = beyond(text, rendered) if rendered else text
    shown = "\n".join(f"![Image {i}]({x})" for i, x in enumerate(images, 1))
    parts = [f"# Source URL\n\n{(url or '').strip() or 'Unknown URL'}", rendered, rest, shown, links_section(extract.external_links(url, root))]
    lines = "\n\n".join(x for x in parts if x).split("\n")
    return "\n".join([*lines[:4], *without_empty_sections(one_links_header(lines[4:]))]).strip() + "\n"
