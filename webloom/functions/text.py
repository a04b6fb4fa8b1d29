"""Text cleaning, labels, answers and prompts as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values (F13, F18, F30, P27, F9): patterns and word lists that decide results.
EMAIL = r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"
DOTTED_DATE, CLOCK = r"\d{2}\.\d{2}\.\d{4}", r"\d{1,2}:\d{2}\s*(?:AM|PM)?"
WEEKDAY_DATE = r"(?i)(?:Mon|Tues|Wednes|Thurs|Fri|Satur|Sun)day,?\s+\w+\s+\w+"
PHONE_START = r"\+?\d+\s*\("
CONTACT_SIGNAL = r"@|mailto:|T\.\s*\(?\d+|\(he/him\)|\(she/her\)"
VALUE_WITH_UNIT = r"(?iu)^[\d\s.,]+(ns|ms|μs|μm|mm|m|GeV|keV|MeV|T|kW|h|°|%|kHz|MHz|psec|nC|mrad|pmrad|μrad)\s*$"
NOISE_KEYWORDS = ["contact", "privacy", "terms", "login", "menu", "search", "subscribe", "cookie", "policy", "newsletter", "copyright", "footer", "disclaimer", "faq", "sitemap"]
#: Fixed values (P9): words of a repository's search form.
UI_KEYWORDS = ["guest", "login", "search:", "sort by:", "display results:", "output format:", "search tips", "collections:", "name | info", "results overview", "try your search", "rss feed", "interested in being notified", "haven't found what you were looking for"]
LABELS = {
    "Phone": ["tel", "telephone", "telefon", "contact", "t.", "phone", "mobile", "cell", "fax"],
    "E-Mail": ["email", "e-mail", "mail", "email address", "e-mail address"],
    "Location": ["location", "office", "room", "address", "adresse", "building", "floor"],
    "Link": ["link", "url", "website", "homepage", "web", "home page", "personal website"],
    "Research Areas": ["research", "research areas", "research area", "interests", "field", "fields", "focus", "focus areas"],
    "Name": ["name", "full name", "person", "contact name"],
}


def chain(text: Column, rules: list[tuple[str, str]]) -> Column:
    """Replacements one after another."""
    for pattern, by in rules:
        text = F.regexp_replace(text, pattern, by)
    return text


def spaced(line: Column) -> Column:
    """Words, numbers and punctuation that ran together set apart; blank and markup lines as they are."""
    as_is = line.isNull() | (F.trim(line) == "") | F.trim(line).rlike(r"^[#|\-*]")
    x = chain(line, [(" +", " "), ("([a-z])([A-Z])", "$1 $2")])
    x = F.when(~x.rlike(PHONE_START), F.regexp_replace(x, r"([a-zA-Z])(\+?\d)", "$1 $2")).otherwise(x)
    x = chain(x, [(r"(\d)([A-Za-z])", "$1 $2"), ("([:;])([A-Za-z])", "$1 $2"), (r"([a-zA-Z]):(\+?\d)", "$1: $2")])
    return F.when(as_is, line).otherwise(x)


def tight_links(text: Column) -> Column:
    """No white space inside a markdown link's brackets, nor behind colons."""
    return chain(text, [(r"\[\s+", "["), (r"\s+\]", "]"), (r"\(\s+", "("), (r"\s+\)", ")"), (r":\s+", ":"), (r"\[(\s+)([^\]]+)(\s+)\]", "[$2]")])


def comparable(text: Column) -> Column:
    """What lines are compared by: links as their text, no punctuation, lower case, runs of one word once."""
    x = chain(F.lower(tight_links(text)), [(r"\[([^\]]+)\]\([^\)]+\)", "$1"), (r"mailto:\s*", ""), (r"[^\p{L}\p{N}_\s]", ""), (r"\s+", " ")])
    return F.regexp_replace(F.trim(x), r"(?<=^| )(\S+)( \1)+(?= |$)", "$1")


def emails(text: Column) -> Column:
    """Mail addresses in lower case, in order."""
    return F.transform(F.regexp_extract_all(text, F.lit(EMAIL), F.lit(0)), F.lower)


def similarity(a: Column, b: Column) -> Column:
    """Equal characters at equal places, of the longer text's length; 0 if one is empty."""
    same = F.size(F.filter(F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: x == y), lambda x: x))
    return F.when((F.length(a) == 0) | (F.length(b) == 0), 0.0).otherwise(same / F.greatest(F.length(a), F.length(b)))


def label(text: Column) -> Column:
    """A field's standard label: known synonyms, else each word capitalised."""
    key = F.lower(F.regexp_replace(F.trim(text), ":+$", ""))
    out = None
    for name, synonyms in LABELS.items():
        out = F.when(key.isin(synonyms), name) if out is None else out.when(key.isin(synonyms), name)
    words = F.filter(F.split(key, r"\s+"), lambda w: w != "")
    return F.when(F.coalesce(text, F.lit("")) == "", "").otherwise(out.otherwise(F.array_join(F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, 2, 1_000_000)))), " ")))


def field_type(header: Column) -> Column:
    """email, phone, location or name by what a header contains."""
    h = F.lower(header)
    return F.when(h.contains("mail"), "email").when(h.rlike("phone|tel"), "phone").when(h.rlike("location|office|room"), "location").when(h.contains("name"), "name")


def with_mail_links(text: Column) -> Column:
    return F.regexp_replace(text, f"({EMAIL})", "[$1](mailto:$1)")


def cleaned_v1(text: Column) -> Column:
    """White space, bracketed spans, spacing before punctuation, ASCII only, sentences set apart."""
    return chain(text, [(r"\s+", " "), (r"\[.*?\]", ""), (r"\n+", "\n"), (r"\s([?.!,;])", "$1"), (r"[^\x00-\x7F]+", ""), ("([a-z])([A-Z])", "$1. $2"), (r"(?<=[a-zA-Z])\s*\n\s*(?=[a-zA-Z])", ". ")])


ACCENTS = ("ÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝàáâãäåçèéêëìíîïñòóôõöùúûüýÿ", "AAAAAACEEEEIIIINOOOOOUUUUYaaaaaaceeeeiiiinooooouuuuyy")


def to_ascii(text: Column) -> Column:
    """Accented Latin letters without their accents, ß as ss; what is left beyond ASCII goes."""
    return F.regexp_replace(F.replace(F.translate(text, *ACCENTS), F.lit("ß"), F.lit("ss")), r"[^\x00-\x7F]", "")


def cleaned_v2(text: Column) -> Column:
    """ASCII, without URLs, dotted dates and bracketed spans, sentences set apart."""
    rules = [(r"http\S+", ""), (DOTTED_DATE, ""), (r"\s+", " "), (r"\[.*?\]", ""), (r"\n+", "\n"), (r"\s([?.!,;])", "$1"), ("([a-z])([A-Z])", "$1. $2"), (r"(?<=[a-zA-Z])\s*\n\s*(?=[a-zA-Z])", ". ")]
    return F.trim(chain(to_ascii(text), rules))


def sentences(text: Column) -> Column:
    """Sentences: cut behind a stop, question or exclamation mark and white space."""
    # A lambda of one argument: F.trim itself takes two, and would get an element's place as the characters to trim.
    return F.filter(F.transform(F.split(text, r"(?<=[.!?])\s+"), lambda s: F.trim(s)), lambda s: s != "")


def word_count(text: Column) -> Column:
    return F.size(F.filter(F.split(F.trim(text), r"\s+"), lambda w: w != ""))


def has_keyword(text: Column, keywords: list[str] = NOISE_KEYWORDS) -> Column:
    return F.lower(text).rlike("|".join(keywords))


def answer(response: Column, marker: str = "Answer:") -> Column:
    """The distinct lines behind the last marker, without context and question lines."""
    lines = F.split(F.trim(F.substring_index(response, marker, -1)), "\n")
    kept = F.transform(F.filter(lines, lambda x: ~F.lower(x).rlike("^(context|question):")), lambda x: F.trim(x))
    return F.trim(F.array_join(F.array_distinct(kept), "\n"))


def prompt(question: Column, context: Column | None = None) -> Column:
    """A question with its context, or without any."""
    if context is None:
        return F.concat(F.lit("Question: "), question, F.lit("\nAnswer:"))
    return F.concat(F.lit("Use the context to answer.\nContext: "), context, F.lit("\nQuestion: "), question, F.lit("\nAnswer:"))


def separator_line(line: Column) -> Column:
    """Rules of dashes, table separators, lines of bars, dashes and spaces only."""
    t = F.trim(line)
    return t.rlike(r"^-{3,}$") | t.rlike(r"^\|[\s|\-]*-{3,}[\s|\-]*\|?$") | ((t != "") & t.rlike(r"^[|\- ]+$"))


def noise_line(line: Column) -> Column:
    """Body lines that carry no text, unless they hold a contact."""
    t = F.trim(line)
    letters = F.length(F.regexp_replace(t, r"[^\p{L}\p{N}_\s]", ""))
    bad = (
        (F.length(t) < 5)
        | (F.size(F.split(t, r"\]\(")) - 1 > 5)
        | t.rlike("^https?://")
        | (F.length(t) - F.length(F.replace(t, F.lit("/"))) > 5)
        | (letters < F.length(t) * 0.3)
        | (~t.contains(" ") & (F.upper(t) == t) & t.rlike(r"\p{L}"))
        | ((F.size(F.regexp_extract_all(t, F.lit(r"\b[A-Z]{2,}(?:[-_][A-Z0-9]{2,})+\b"), F.lit(0))) > 10) & (F.length(t) > 100))
    )
    return ~t.rlike(CONTACT_SIGNAL) & bad


def navigation_line(line: Column) -> Column:
    """Lines of spacer and header images, menus, many links in little text, lone images."""
    links = F.size(F.regexp_extract_all(line, F.lit(r"\[([^\]]+)\]\([^)]+\)"), F.lit(0)))
    return line.rlike(r"(?i)(spacer|header|logo|banner)\.(gif|png|jpg)|to sort click|navigation|menu|breadcrumb") | ((links > 3) & (F.length(F.trim(line)) < 150)) | F.trim(line).rlike(r"^!\[.*?\]\([^)]+\)\s*\|?\s*$")


def empty_page(text: Column) -> Column:
    """Under 50 characters, or under 200 with an error phrase and fewer than ten real words."""
    t = F.trim(text)
    words = F.filter(F.split(t, r"\s+"), lambda w: (F.length(w) > 2) & ~w.rlike("^(http|#)"))
    return (F.length(t) < 50) | ((F.length(t) < 200) & F.lower(t).rlike("page could not be found|404|not found|error|page not available") & (F.size(words) < 10))


def table_lines(markdown: Column) -> Column:
    return F.size(F.filter(F.split(markdown, "\n"), lambda x: x.contains("|")))


def fit_or_raw(fit: Column, raw: Column) -> Column:
    """The filtered text, or the whole where the filter took too much or the tables."""
    use_raw = (F.length(F.trim(fit)) < 100) | (F.length(F.trim(fit)) / F.nullif(F.length(F.trim(raw)), F.lit(0)) < 0.5) | ((table_lines(raw) >= 3) & (table_lines(fit) < 3))
    return F.when(F.coalesce(fit, F.lit("")) == "", F.coalesce(raw, F.lit(""))).when(F.coalesce(raw, F.lit("")) == "", fit).when(use_raw, raw).otherwise(fit)


def empty_link_free(text: Column) -> Column:
    """Without links that have no text; images stay."""
    return F.regexp_replace(text, r"(?<!!)\[\]\([^)]+\)", "")


def doubled_word_free(text: Column) -> Column:
    return F.regexp_replace(text, r"\b([A-ZÄÖÜ][a-zäöüß]+)\s+\1\b", "$1")


def blank(text: Column) -> Column:
    """Null, empty or white space only."""
    return F.coalesce(F.trim(text), F.lit("")) == ""


def is_ui_table(text: Column, name: str) -> Column:
    """A table of the search form of the repository of that name, and not of its records, whose ids are name-year-number."""
    lower = F.lower(text)
    words = F.lit(False)
    for word in UI_KEYWORDS:
        words = words | lower.contains(word)
    form = lower.contains(name) & lower.rlike("login|guest|search:|submit")
    return F.coalesce((words | form) & ~lower.rlike(name + r"-\d{4}-\d{5}"), F.lit(False))


def normalized_header(line: Column) -> Column:
    """A table's header line: its filled cells in lower case, without punctuation."""
    cells = F.transform(F.split(line, r"\|"), lambda c: F.lower(F.trim(F.regexp_replace(c, r"[^\w\s]", ""))))
    return F.array_join(F.filter(cells, lambda c: c != ""), "|")


def error_kind(message: Column) -> Column:
    """disk_full, timeout or other."""
    return F.when(message.rlike("(?i)ENOSPC|no space left"), "disk_full").when(F.lower(message).rlike("timeout|timed out"), "timeout").otherwise("other")


def pdf_content(raw: Column, fit: Column) -> Column:
    """A PDF's text: as it is before as it was filtered."""
    return F.coalesce(F.nullif(raw, F.lit("")), fit, F.lit(""))


def leaked_line(line: Column) -> Column:
    """What a page's frame leaves behind: table rules, addresses, breadcrumbs, scraps of under three characters."""
    t = F.trim(line)
    return (F.length(t) < 3) | t.rlike(r"^https?://\S+$") | t.rlike(r"^\|[\s|:\-]*\|$") | t.rlike("^(URL:|Breadcrumb)")
