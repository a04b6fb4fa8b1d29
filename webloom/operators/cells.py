"""What a table cell with several fields in it says: labels and values, and tables of one such column as tables of several."""

from __future__ import annotations

import re

from webloom.functions.text import EMAIL, LABELS

#: Fixed values (F13): what a cell's fields look like.
KINDS = {
    "E-Mail": re.compile(r"\[[^\]]+\]\(mailto:[^\s@]+@[^\s@]+\.[^\s)]+\)|" + EMAIL),
    "Phone": re.compile(r"\+?\d{1,3}[\s\-()]*(?:0\))?\s*\d{1,4}[\s\-]+\d{3,4}[\s\-]+\d{3,4}"),
    "Link": re.compile(r"\[[^\]]+\]\(https?://[^\s)]+\)|https?://[^\s)]+"),
}
_WORD = r"[A-ZÄÖÜ][a-zäöüß]+"
#: Fixed values (H4): labels that end a name, and labels that begin a field.
_AFTER_NAME = "E-Mail|Email|Phone|Tel|Telephone|Location|Office|Room|Link|URL|Website"
FIELD = re.compile(r"\b(Location|Office|Room|Address|Phone|Tel|Telephone|Contact|E-Mail|Email|Mail|Link|URL|Website|Homepage|Research|Research Areas|Interests|Name|Fax|Mobile|Cell):", re.I)
_NAME_FIRST = [re.compile(rf"^({_WORD}(?:[ \t]+{_WORD}){{1,4}})\s+{rest}", re.I) for rest in (f"(?:{_AFTER_NAME}):", rf"(?:{_AFTER_NAME})\s+", r"\[[^\]]+\]\(mailto:")]
_LABEL_LAST = re.compile(rf"\s+(?:{_AFTER_NAME}):?\s*$", re.I)
_LABEL_BEFORE = re.compile(r"([A-Za-z\s\-]+):\s*$")
_KNOWN_LABEL = re.compile(r"(?:^|\s)(" + "|".join(sorted((re.escape(x) for names in LABELS.values() for x in names), key=len, reverse=True)) + r")$", re.I)
#: How far before a value its label may begin, and how long what follows it may be.
REACH, SHORT = 30, 30


def standard_label(label: str) -> str:
    """A field's usual name: known synonyms, else each word capitalised."""
    key = label.strip().rstrip(":").lower()
    return next((name for name, synonyms in LABELS.items() if key in synonyms), " ".join(w.capitalize() for w in key.split()))


def segments(cell: str) -> list[tuple[str, str]]:
    """(kind, text) in order: values by what they look like, the labels right before them, and the text between. A cell without such
    values falls into its lines, else into what double spaces part."""
    found = sorted((m.start(), m.end(), kind) for kind, pattern in KINDS.items() for m in pattern.finditer(cell))
    if not found:
        parts = [p.strip() for p in cell.split("\n") if p.strip()]
        if len(parts) < 2:
            parts = [p.strip() for p in re.split(r"\s{2,}", cell) if p.strip()]
        return [("text", p) for p in parts]
    out, at = [], 0
    for start, end, kind in found:
        if start < at:  # inside the value before it
            continue
        window = max(at, start - REACH)
        label = _LABEL_BEFORE.search(cell, window, start)
        begin, said = (label.start(), label[1].strip()) if label else (start, "")
        if said and (known := _KNOWN_LABEL.search(said)):  # what stands before a known label isn't part of it
            begin, said = cell.rindex(known[1], at, start), known[1]
        if before := cell[at:begin].strip():
            out.append(("text", before))
        if said:
            out.append(("label", said))
        out.append((kind, cell[start:end]))
        at = end
    if rest := cell[at:].strip():
        out.append(("text", rest))
    return out


def _holds_value(text: str) -> bool:
    return bool(KINDS["E-Mail"].search(text) or KINDS["Phone"].search(text))


def leading_name(cell: str, parts: list[tuple[str, str]]) -> tuple[str | None, list[tuple[str, str]]]:
    """(the name the cell begins with, the segments without it)."""
    for pattern in _NAME_FIRST:
        if found := pattern.search(cell):
            name = found[1].strip()
            if 2 <= len(name.split()) <= 4 and not _holds_value(name):
                if parts and parts[0][0] == "text":
                    rest = re.sub(r"^" + re.escape(name) + r"\s+", "", parts[0][1], flags=re.I).strip()
                    rest = "" if rest.lower() == name.lower() else rest
                    parts = ([("text", rest)] if rest else []) + parts[1:]
                return name, parts
            break
    if parts and parts[0][0] == "text":
        name = _LABEL_LAST.sub("", parts[0][1]).strip()
        likely = re.match(rf"{_WORD}(?:\s+{_WORD}){{1,3}}", name) or 2 <= len(name.split()) <= 4
        if 2 < len(name) < 50 and ":" not in name and likely and not _holds_value(name):
            return name, parts[1:]
    return None, parts


def _by_labels(text: str) -> tuple[str, list[tuple[str, str]]]:
    """(text before the first label, fields): a text cut at the labels in it; a label repeated at its value's beginning goes."""
    pieces = FIELD.split(text)
    out = []
    for label, value in zip(pieces[1::2], pieces[2::2], strict=True):
        name = standard_label(label)
        value = re.sub(r"^(?:" + re.escape(name) + r"\s+)+", "", value.strip(), flags=re.I).strip()
        if value:
            out.append((name, value))
    return pieces[0].strip(), out


def pairs(cell: str) -> list[tuple[str, str]]:
    """(label, value) of the fields in a cell, its name first; a value without a label goes with the field before it, or has none."""
    name, parts = leading_name(cell, segments(cell))
    out: list[list[str]] = []
    i = 0
    while i < len(parts):
        kind, text = parts[i]
        if kind in KINDS:
            label = kind
            if i and parts[i - 1][0] == "label":
                label = standard_label(parts[i - 1][1])
            elif i and parts[i - 1][0] == "text" and parts[i - 1][1].endswith(":") and len(parts[i - 1][1]) < SHORT:
                label = standard_label(parts[i - 1][1])
            if i + 1 < len(parts) and parts[i + 1][0] == "text":
                after = parts[i + 1][1]
                if len(after) < SHORT and not after.endswith(":") and not FIELD.search(after):
                    text = f"{text} {after}"
                    i += 1
            out.append([label, text])
        elif kind == "text" and FIELD.search(text):
            before, fields = _by_labels(text)
            if before and name is None and len(before) < 50:
                name = before
            out += [list(f) for f in fields]
        elif kind == "text" and ":" in text:
            label, value = (x.strip() for x in text.split(":", 1))
            if label and value:
                out.append([standard_label(label), value])
        elif kind == "text":
            if out:
                out[-1][1] = f"{out[-1][1]} {text}".strip()
            elif name is None:
                name = text
            else:
                out.append(["", text])
        i += 1
    return ([("Name", name)] if name else []) + [tuple(x) for x in out]


def record(cell: str) -> dict[str, str]:
    """A cell as one row of labelled fields; of equal labels the last wins. A cell that says nothing keeps its text under Name and Info, or Original."""
    out: dict[str, str] = {}
    for label, value in pairs(cell):
        if label:
            out[standard_label(label)] = value
        elif out:
            last = list(out)[-1]
            out[last] = f"{out[last]} {value}".strip()
        else:
            out["Info"] = value
    if out:
        return out
    if found := re.match(rf"{_WORD}(?:\s+{_WORD}){{0,3}}", cell):
        rest = cell[found.end() :].strip()
        return {"Name": found[0]} | ({"Info": rest} if rest else {})
    return {"Original": cell}


def widened(found: dict) -> dict:
    """A table of one column as one of several, a column for each label: Name first, the others sorted."""
    if not found["rows"] or any(len(r) != 1 for r in found["rows"]):
        return found
    records = [record(r[0]) for r in found["rows"]]
    labels = sorted({k for r in records for k in r}, key=lambda k: (k != "Name", k))
    return found | {"headers": labels, "rows": [[r.get(k, "") for k in labels] for r in records]}
