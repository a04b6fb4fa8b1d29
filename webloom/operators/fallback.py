"""Text of a page whose markdown is too thin, read from its HTML again: frames taken out, the main part chosen, links kept."""

from __future__ import annotations

import re

from webloom.functions.text import CONTACT_SIGNAL
from webloom.operators.dom import Node

#: Fixed values (P22): elements and class or id words of a page's frame; words of images that only take up room.
FRAME_TAGS = {"script", "style", "nav", "header", "footer", "select", "option", "noscript", "iframe", "form"}
FRAME = re.compile("nav|menu|dropdown|select|option|breadcrumb|sidebar|cookie|privacy|search|filter|pagination|toolbar|header|footer|aside", re.I)
SPACER = re.compile("spacer|blank|pixel", re.I)
#: Fixed values (H17): legal notes; texts of mail links that say nothing.
LEGAL = ("data privacy", "declaration of accessibility", "impressum", "datenschutz", "cookie policy", "accessibility statement")
GENERIC = {"", "email", "e-mail", "mail", "contact"}
_MAIN = re.compile("content|main|body", re.I)
_SIGNAL = re.compile(CONTACT_SIGNAL)
_NAME = r"[A-ZÄÖÜ][a-zäöüß]+"
_PERSON = re.compile(rf"{_NAME}(?:\s+{_NAME})+\s+\([^)]+\)")
_REACHED = re.compile(r"@|mailto:|T\.\s*\(?\d+|E\.\s*[a-z]", re.I)
_NUMBER = re.compile(r"T\.\s*\(?\d+|\(?\d{3,4}\)?\s*-?\s*\d{3,4}")
_POSITION = re.compile(r"\b[A-Z][a-z]+\s+[A-Z][a-z]+.*(?:Head|Manager|Leader|Trainer|Recruitment)")
#: Characters: of a main part and of a paragraph at least; links and text of what is a menu.
LEAST, PARAGRAPH, MENU_LINKS, MENU_TEXT = 20, 20, 3, 200


class View:
    """A page less some of its subtrees: which nodes are left, and the text of any of them."""

    def __init__(self, root: Node):
        self.root, self.gone = root, set()
        for n in self.nodes(root):
            if n is not root and (n.tag in FRAME_TAGS or FRAME.search(n.attrs.get("class", "")) or FRAME.search(n.attrs.get("id", ""))):
                self.gone.add(n.id)
        self._menus()

    def nodes(self, top: Node):
        """What is left of a subtree, in document order."""
        stack = [top]
        while stack:
            n = stack.pop()
            if n.id in self.gone:
                continue
            yield n
            stack.extend(c for c in reversed(n.children) if isinstance(c, Node))

    def _menus(self) -> None:
        """Lists and boxes of many links and little text, or with spacer images among links; sums run from the leaves up."""
        links, chars, spacers = {}, {}, {}
        marked = []
        for n in reversed(list(self.nodes(self.root))):
            own = [c for c in n.children if isinstance(c, Node) and c.id not in self.gone]
            links[n.id] = sum(links[c.id] + (c.tag == "a") for c in own)
            chars[n.id] = sum(chars[c.id] for c in own) + sum(len(c.strip()) for c in n.children if isinstance(c, str))
            spacers[n.id] = sum(spacers[c.id] + (c.tag == "img" and bool(SPACER.search(c.attrs.get("src", "")))) for c in own)
            if n.tag in ("div", "ul", "ol", "li") and ((links[n.id] > MENU_LINKS and chars[n.id] < MENU_TEXT) or (spacers[n.id] and links[n.id] > 2)):
                marked.append(n.id)
        self.gone.update(marked)

    def text(self, top: Node, between: str = " ", link=None, tables: bool = True) -> str:
        """The text of what is left of a subtree; link: an anchor's text, or None to leave the anchor's own."""
        out, stack = [], [top]
        while stack:
            item = stack.pop()
            if isinstance(item, str):
                if item.strip():
                    out.append(" ".join(item.split()))
            elif item.id not in self.gone and (tables or item.tag != "table"):
                if link is not None and item.tag == "a" and item.attrs.get("href") is not None:
                    if said := link(item):
                        out.append(said)
                else:
                    stack.extend(reversed(item.children))
        return between.join(out)

    def first(self, test) -> Node | None:
        return next((n for n in self.nodes(self.root) if n is not self.root and test(n)), None)

    def main(self) -> Node:
        """main, article, a box named content, main or body by class or id; if that says next to nothing the body, and else the box with most text, contacts and names."""
        named = lambda key: lambda n: n.tag == "div" and bool(_MAIN.search(n.attrs.get(key, "")))
        tests = [lambda n: n.tag == "main", lambda n: n.tag == "article", named("class"), named("id")]
        found = next((n for t in tests if (n := self.first(t)) is not None), None)
        body = self.first(lambda n: n.tag == "body")
        if found is None or len(self.text(found, "")) < LEAST:
            found = body
        if found is None or len(self.text(found, "")) < LEAST:
            scored = [(self._worth(n), -n.id, n) for n in self.nodes(self.root) if n.tag == "div"]
            if scored and max(scored)[0] > 50:
                found = max(scored)[2]
        return found or body or self.root

    def _worth(self, n: Node) -> int:
        text = self.text(n, "")
        return len(text) + 500 * bool(_SIGNAL.search(text)) + 100 * bool(re.search(r"\b[A-Z][a-z]+\s+[A-Z][a-z]+", text))


def link_markdown(url: str | None, view: View):
    """Anchors as markdown: none to the page itself or to nothing, none without text but mail; a mail link around a whole contact gives
    way to the contact's text with the address linked."""
    here = (url or "").split("#", 1)[0].rstrip("/")

    def linked(a: Node) -> str:
        href, text = a.attrs["href"].strip(), view.text(a)
        bare = href.split("#", 1)[0].rstrip("/")
        if not href or href == "#":
            return ""
        if here and (bare == here or (href.startswith("/") and bare and here.endswith(bare)) or (href.startswith(url or "") and "#" in href and not text)):
            return ""
        if not href.lower().startswith("mailto:"):
            return f"[{text}]({href})" if text else ""
        address = href[7:]
        if not address:
            return ""
        if len(text) > 50 and re.search(rf"{_NAME}\s+{_NAME}.*\([^)]+\)", text) and (_NUMBER.search(text) or "@" in text):
            return re.sub(rf"\b{re.escape(address)}\b", lambda _: f"[{address}](mailto:{address})", text)
        return f"[{address if text.lower() in GENERIC else text}](mailto:{address})"

    return linked


def with_contacts(paragraphs: list[str]) -> list[str]:
    """A person with a pronoun or position in brackets takes in up to five paragraphs after it, short ones or ones with a contact,
    through the first that has one."""
    out, i = [], 0
    while i < len(paragraphs):
        text, i = paragraphs[i], i + 1
        if _PERSON.match(text) and not _REACHED.search(text):
            start = i
            while i < len(paragraphs) and i - start < 5:
                after = paragraphs[i]
                if _PERSON.match(after) or not (len(after) < 80 or _REACHED.search(after)):
                    break
                text, i = f"{text} {after}", i + 1
                if _REACHED.search(text):
                    break
        out.append(text)
    return out


def is_leaked(line: str) -> bool:
    """Rules and empty rows of tables, addresses, breadcrumbs, scraps."""
    t = line.strip()
    rule = re.fullmatch(r"\|?\s*(?:---|—|–)\s*(?:\|\s*(?:---|—|–)\s*)+\|?", t)
    return bool(not t or rule or (t[0] == "|" and not t.replace("|", "").strip()) or re.match(r"(?i)URL:\s*https?://|Breadcrumb\s+Navigation", t) or re.fullmatch(r"https?://\S+", t) or (len(t) < 3 and t[0] != "#"))


def is_noise(line: str) -> bool:
    """Lines of a whole body that say nothing, unless they hold a contact or a person's position."""
    t = line.strip()
    if not t:
        return True
    if _SIGNAL.search(t) or _POSITION.search(t):
        return False
    addresses = re.fullmatch(r"https?://\S+", t) or (t.count("/") > 8 and "http" in t)
    return bool(len(t) < 2 or t.count("](") > 8 or addresses or len(re.sub(r"[^\w\s]", "", t)) < len(t) * 0.2)


def page_text(url: str | None, root: Node) -> str:
    """The page's text: paragraphs and boxes of its main part, tables left to their own rendering; lines once. Where that is under 50
    characters and has no contact, the body's lines that say something."""
    view = View(root)
    main, link = view.main(), link_markdown(url, view)
    boxes = [n for n in view.nodes(main) if n.tag in ("p", "div")]
    if len(view.text(main, "")) < 100:
        every = [n for n in view.nodes(root) if n.tag in ("p", "div")]
        said = lambda n: view.text(n, "")
        rescued = [n for n in every if (len(said(n)) > PARAGRAPH or _SIGNAL.search(said(n))) and not re.match("https?://", said(n))]
        if sum(len(said(n)) for n in rescued) > len(view.text(main, "")):
            boxes = rescued
    inside_table = {n.id for t in view.nodes(root) if t.tag == "table" for n in view.nodes(t)}
    texts = [" ".join(view.text(n, " ", link, tables=False).split()) for n in boxes if n.id not in inside_table]
    found = [t for t in with_contacts([t for t in texts if len(t) > 2]) if not re.match(r"(?i)URL:\s*https?://|Breadcrumb\s+Navigation", t) and not any(k in t.lower() for k in LEGAL)]
    if not found:
        found = [t for t in view.text(main, "\n", link, tables=False).split("\n") if len(t.strip()) > 2]
    seen, kept = set(), []
    for t in found:
        key = re.sub(r"\s+", " ", t.lower()).strip()
        if not is_leaked(t) and key not in seen:
            seen.add(key)
            kept.append(t)
    text = "\n".join(kept)
    if len(text.strip()) < 50 and not _SIGNAL.search(text):
        body = view.first(lambda n: n.tag == "body") or root
        lines = "\n".join(x for x in view.text(body, "\n", link).split("\n") if not is_noise(x))
        text = lines if len(lines) > len(text) else text
    return text


def frames(root: Node) -> list[str]:
    """Addresses of frames, whose content is elsewhere."""
    return [n.attrs["src"] for n in root.find_all("iframe") if n.attrs.get("src")]
