"""Tables as markdown: which tables and rows are kept, what their header is, and runs of one-row tables as one."""

from __future__ import annotations

import re

WIDEST = 10
#: Fixed values (H6d, H6g): units of bare values; units of a second header that is a value; words of parameter tables.
_UNIT = "ns|ms|μs|μm|mm|m|GeV|keV|MeV|T|kW|h|°|%|kHz|MHz|psec|nC|mrad|pmrad|μrad"
_MORE_UNITS = "Hz|V|A|W|J|kg|g|s|min|d|y|°C|K|Pa|bar|atm|psi|N|kgf|lbf|m/s|km/h|mph|rpm|rad/s|deg/s"
PARAMETERS = [
    "energy", "circumference", "number", "length", "angle", "radius", "field", "aperture", "gradient", "emittance", "tune", "frequency", "time", "current",
    "charge", "power", "size", "divergence", "function", "damping", "spread",
]
MORE_PARAMETERS = [
    "bunch", "separation", "bucket", "coupling", "factor", "magnetic", "critical", "photon", "revolution", "ratio", "electron", "loss", "turn", "radiation", "lifetime", "sector", "cell", "section", "undulator",
    "beam", "horizontal", "vertical", "momentum", "compaction", "chromaticity", "synchrotron", "wiggler", "alignment", "tolerance", "dipole", "quadrupole", "sextupole", "bpm",
]
_VALUE = re.compile(rf"[\d\s.,]+(?:{_UNIT})?\s*", re.I)
_HEAD_VALUE = re.compile(rf"[\d\s.,]+(?:{_UNIT}|{_MORE_UNITS})?\s*", re.I)
_LABELLED = re.compile(r"\b(?:E-Mail|Phone|Location|Email|Tel|Telephone):", re.I)
_LINK = re.compile(r"\[.*?\]\(.*?\)|https?://")
_NAMED_MAIL = re.compile(r"\[([^\]]+)\]\(mailto:")
#: Fixed values (H6h): what a first row holds that is data and no header.
_DATA = re.compile(r"e-mail|email|mailto:|phone|tel|telephone|\+\d|location|address|office|room|@\w+\.\w+", re.I)
_PERIOD = re.compile(r"\d{4}|seit|von|bis|until|from|to", re.I)
ORDER = ["Name", "E-Mail", "Phone", "Location"]


def plain(cell: str) -> str:
    return re.sub(r"\s+", " ", cell).strip()


def column(header: str) -> str:
    """A header as one of the staff table's, by what it contains; others as they are."""
    low = header.lower()
    if "e-mail" in low or "email" in low:
        return "E-Mail"
    if "phone" in low or "tel" in low:
        return "Phone"
    if "location" in low or "office" in low or "room" in low:
        return "Location"
    return "Name" if "name" in low else header


def linked_name(row: list[str]) -> str | None:
    """The name that a mail link of the row shows: one to five capitalised words, no number."""
    for cell in row:
        for name in _NAMED_MAIL.findall(cell):
            words = name.split()
            if 1 <= len(words) <= 5 and all(w[0].isupper() for w in words) and "@" not in name and not re.search(r"\d", name):
                return name.strip()
    return None


def merged(tables: list[dict]) -> list[dict]:
    """Runs of tables of one row, whose headers share two kinds with the run's first, as one table: the staff columns in their order,
    then the others sorted. Without a Name column, names come from the rows' mail links."""
    kinds = lambda t: {column(h) for h in t["headers"] if column(h) in ORDER} if len(t["rows"]) == 1 else set()
    runs: list[list[dict]] = []
    first: set = set()
    for t in tables:
        own = kinds(t)
        if len(own & first) >= 2:
            runs[-1].append(t)
        else:
            runs.append([t])
            first = own if len(own) >= 2 else set()
    return [run[0] if len(run) == 1 else _one_of(run) for run in runs]


def _one_of(run: list[dict]) -> dict:
    rows = [dict(zip([column(h) for h in t["headers"]], t["rows"][0], strict=False)) for t in run]
    if not any("Name" in r for r in rows):
        names = [linked_name(t["rows"][0]) for t in run]
        if any(names):
            rows = [r | ({"Name": n} if n else {}) for r, n in zip(rows, names, strict=True)]
    found = {k for r in rows for k in r if k}
    heads = [h for h in ORDER if h in found] + sorted(found - set(ORDER))
    return {"headers": heads, "rows": [[r.get(h, "") for h in heads] for r in rows], "caption": run[0]["caption"]}


def signature(t: dict) -> str:
    """What equal tables share: the beginnings of the first cells and headers."""
    cells = [c.strip().lower()[:50] for c in t["rows"][0][:3] if c.strip()] if t["rows"] else []
    if not t["headers"]:
        return "|".join(cells)
    return "|".join(h.strip().lower()[:30] for h in t["headers"][:3] if h.strip()) + "|" + "".join(cells)


def is_noise(t: dict) -> bool:
    """No rows; one or two cells that are links only; one bare value; too many columns; one column of several fields run together."""
    rows = t["rows"]
    if not rows:
        return True
    if len(rows) == 1:
        filled = [c.strip() for c in rows[0] if c.strip()]
        if len(filled) <= 2 and len(rows[0]) <= 2 and all(_LINK.search(c) for c in filled):
            return True
        if len(filled) == 1 and _VALUE.fullmatch(filled[0]):
            return True
    return len(rows[0]) > WIDEST or (len(rows[0]) == 1 and len(_LABELLED.findall(signature(t))) >= 3)


def is_parameter(headers: list[str]) -> bool:
    """Headers that are a label and its value: by a colon, by a word of parameter tables, or by a second one that is a number."""
    if len(headers) < 2:
        return False
    one, two = headers[0].strip(), headers[1].strip()
    return one.endswith((":", "：")) or any(w in one.lower() for w in PARAMETERS + MORE_PARAMETERS) or bool(two and _HEAD_VALUE.fullmatch(two))


def is_data(row: list[str]) -> bool:
    """A first row that is no header: it holds contacts, a parameter, a period with its text, or over 100 characters."""
    one, two = row[0].strip(), row[1].strip()
    parameter = one.endswith((":", "：")) or any(w in one.lower() for w in PARAMETERS)
    return bool(_DATA.search(" ".join(row))) or parameter or bool(_PERIOD.search(one) and len(two) > 30) or sum(map(len, row)) > 100


def is_kept_row(row: list[str]) -> bool:
    """Not blank, no rule, not too wide, no fields run together."""
    cells = [c.strip() for c in row]
    if not any(cells) or all(c in ("", "---", "—", "–") for c in cells) or len(cells) > WIDEST:
        return False
    if len(cells) == 1:
        return len(_LABELLED.findall(cells[0])) < 3
    return not (len(cells) >= 5 and all(_LABELLED.search(c) for c in cells if c))


def whole_name(row: list[str]) -> str:
    """The first cell; a name cut off at an umlaut is completed from the mail links of the next three cells."""
    name = plain(row[0])
    if len(name) > 2 and name[-1] in "öüäÖÜÄ":
        for cell in row[1:4]:
            if (found := _NAMED_MAIL.search(cell)) and found[1].strip().lower().startswith(name.lower()):
                return found[1].strip()
    return name


def line(cells: list[str]) -> str:
    return "| " + " | ".join(plain(c) for c in cells) + " |"


def table_markdown(t: dict) -> str:
    """A table as markdown, '' for one that is noise: its headers over a rule, unless they are a label and its value; without headers
    the first row, unless that is data."""
    if is_noise(t):
        return ""
    heads, rows = t["headers"], t["rows"]
    out = []
    if heads and is_parameter(heads):
        out.append(line(heads))
        if [c.strip().lower() for c in rows[0][: len(heads)]] == [h.strip().lower() for h in heads]:
            rows = rows[1:]
    elif heads:
        out += [line(heads), line(["---"] * len(heads))]
    elif len(rows[0]) > 1 and not is_data(rows[0]):
        out += [line(rows[0]), line(["---"] * len(rows[0]))]
        rows = rows[1:]
    for row in rows:
        row = row[: len(heads)] if heads and len(row) >= len(heads) else row
        if is_kept_row(row):
            out.append(line([whole_name(row), *row[1:]]))
    return "\n".join(out)


def is_key_value(t: dict) -> bool:
    """Two headers over rows of two cells that are no headers: both empty, one a label with its colon, or the second with a digit."""
    heads = [h.strip() for h in t["headers"]]
    if len(heads) != 2 or not t["rows"] or any(len(r) != 2 for r in t["rows"][:5]):
        return False
    return heads == ["", ""] or heads[0].endswith(":") or heads[1].endswith(":") or bool(re.search(r"\d", heads[1]))


def inline_markdown(t: dict) -> str:
    """A table inside text: its caption, a header over a rule if it has one, and its rows; keys and values without a rule."""
    heads, rows = t["headers"], t["rows"]
    if is_key_value(t):
        heads, rows = [], [heads, *rows]
    width = len(heads) or max(map(len, rows), default=0)
    fit = [(r + [""] * width)[:width] for r in rows]
    single = lambda c: re.sub(r"\b([A-Z][a-z]+)\s+\1\b(?!\s*\[)", r"\1", c.strip())
    body = ["| " + " | ".join(map(single, r)) + " |" for r in fit if any(c.strip() for c in r) and not all(c.strip() in ("", "---", "—", "–") for c in r)]
    top = ["| " + " | ".join(heads) + " |", "| " + " | ".join(["---"] * width) + " |"] if heads and rows else []
    return "\n".join([*([f"*{t['caption']}*", ""] if t["caption"] else []), *top, *body])
