"""The text rules that pages are searched for repeats by, in plain Python; each takes time in proportion to its text.

They give what the column expressions of ``text`` give. White space is that of the rules' patterns: tab, line feeds, form feed, return, space.
"""

from __future__ import annotations

import re
from itertools import groupby

from webloom.functions.text import EMAIL

_EMAIL = re.compile(EMAIL)
_S = r"[\t\n\f\r ]"
#: White space inside brackets and behind colons. A run is tried from its start only.
_TIGHT = [("[", re.compile(rf"\[{_S}+"), "["), ("]", re.compile(rf"(?<!{_S}){_S}+\]"), "]"), ("(", re.compile(rf"\({_S}+"), "("), (")", re.compile(rf"(?<!{_S}){_S}+\)"), ")"), (":", re.compile(rf":{_S}+"), ":")]
_MAILTO = re.compile(rf"mailto:{_S}*")
_MARKS = re.compile(r"[^\w\t\n\f\r ]+")
_ASCII_MARKS = {i: None for i in range(128) if _MARKS.match(chr(i))}
#: What a rule reads beyond a line's end.
_JOINING = re.compile(r"[\[\]():]")


def _unlinked(text: str) -> str:
    """Markdown links as their text: a bracket that closes before a parenthesis, from the first bracket open since the last one that closed."""
    out, at, free = [], 0, 0
    close = text.find("]")
    while close >= 0:
        begin = text.find("[", free, close - 1) if close > free and text.startswith("(", close + 1) else -1
        free = close + 1
        if begin >= 0:
            end = text.find(")", close + 2)
            if end < 0:
                break
            if end > close + 2:
                out += [text[at:begin], text[begin + 1 : close]]
                at = free = end + 1
        close = text.find("]", free)
    return "".join([*out, text[at:]])


def comparable(text: str) -> str:
    """What lines are compared by: links as their text, no punctuation, lower case, runs of one word once."""
    for sign, pattern, by in _TIGHT:
        if sign in text:
            text = pattern.sub(by, text)
    text = text.replace("Σ", "σ").lower()  # one letter at a time: a sigma is the same at a word's end
    if "](" in text:
        text = _unlinked(text)
    if "mailto:" in text:
        text = _MAILTO.sub("", text)
    text = text.translate(_ASCII_MARKS) if text.isascii() else _MARKS.sub("", text)
    return " ".join([w for w, _ in groupby(text.split())])


def comparable_blocks(lines: list[str], size: int) -> list[str]:
    """The comparable text of each stretch of ``size`` lines: from those of its lines, where no rule reads across a line's end."""
    own = [None if _JOINING.search(x) else comparable(x) for x in lines]
    out = []
    for i in range(len(lines) - size + 1):
        parts = own[i : i + size]
        if None in parts:
            out.append(comparable("\n".join(lines[i : i + size])))
            continue
        text = ""
        for part in parts:
            if text and part and text[text.rfind(" ") + 1 :] == (word := part.partition(" ")[0]):
                part = part[len(word) + 1 :]
            text = f"{text} {part}" if text and part else text or part
        out.append(text)
    return out


def stopped(line: str) -> list[str]:
    """Sentences with their stops; what comes behind the last stop is none."""
    return re.findall(r"[^.!?]+[.!?]", line[: max(line.rfind("."), line.rfind("!"), line.rfind("?")) + 1])


def emails(line: str) -> list[str]:
    """Mail addresses in lower case, in order."""
    return [x.lower() for x in _EMAIL.findall(line)] if "@" in line else []
