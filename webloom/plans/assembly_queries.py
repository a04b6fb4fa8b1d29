"""Queries of page assembly: markers, boilerplate, sections, fallbacks, tables with links."""

from __future__ import annotations

from pyspark.sql import functions as F

from webloom.functions import urls as U
from webloom.operators import assemble, dom, extract, vector
from webloom.plans import page_queries
from webloom.plans.catalog import register
from webloom.plans.text_queries import LINES, lines
from webloom.session import table

MARKERS = ["article", "footer", "nav", "login", "search", "archive", "index"]


def _pages(spark, sf_dir):
    return table(spark, sf_dir, "pages")


def _docs(spark, sf_dir):
    return table(spark, sf_dir, "documents")


@register("content_markers", "SELECT page_id, (" + " + ".join(f"contains(lower(html), '{m}')::INT" for m in MARKERS) + ") >= 2 AS listed FROM pages")
def content_markers(spark, sf_dir):
    """Pages of a kind: at least two of its markers occur."""
    return _pages(spark, sf_dir).select("page_id", U.is_listed(F.col("html"), MARKERS, 2).alias("listed"))


@register(
    "fallback_reasons",
    r"""WITH m AS (SELECT page_id, html, regexp_replace(html, '<[^>]+>', ' ', 'g') AS md FROM pages)
  SELECT page_id, CASE WHEN trim(md) = '' THEN 'empty' WHEN length(html) > 1000 AND length(trim(md)) < 50 THEN 'thin' WHEN length(trim(md)) < 100 THEN 'short'
    WHEN len(regexp_extract_all(html, '(?i)<table[ >]')) > 0 AND len(list_filter(string_split(md, chr(10)), lambda x: contains(x, '|'))) < 2 THEN 'tables_missing'
    WHEN len(regexp_extract_all(html, 'mailto:')) >= 3 AND len(regexp_extract_all(md, 'mailto:')) < len(regexp_extract_all(html, 'mailto:')) THEN 'contacts_missing' END AS reason FROM m""",
)
def fallback_reasons(spark, sf_dir):
    markdown = F.regexp_replace("html", "<[^>]+>", " ")
    return _pages(spark, sf_dir).select("page_id", assemble.fallback_reason(markdown, F.col("html")).alias("reason"))


@register(
    "source_lines",
    r"""WITH t AS (SELECT page_id, '# Source URL' || chr(10) || url || chr(10) || 'URL: ' || url || chr(10) || 'Breadcrumb a > b' || chr(10) || 'page ' || url AS text FROM pages)
  SELECT page_id, array_to_string(list_filter(string_split(text, chr(10)), lambda x: NOT regexp_matches(trim(x), '^(# Source URL|URL:.*|Breadcrumb.*|https?://\S+)$')), chr(10)) AS text FROM t""",
)
def source_lines(spark, sf_dir):
    made = F.concat(F.lit("# Source URL\n"), "url", F.lit("\nURL: "), "url", F.lit("\nBreadcrumb a > b\npage "), "url")
    return _pages(spark, sf_dir).select("page_id", assemble.source_free(made).alias("text"))


@register("broken_labels", "WITH " + LINES + r" SELECT doc_id, line_no FROM lines WHERE regexp_matches(trim(line), '^[A-Za-z][A-Za-z ]{1,28}:\s*(-{3,}\s*\||\|)')")
def broken_labels(spark, sf_dir):
    return lines(spark, sf_dir).where(F.trim("line").rlike(r"^[A-Za-z][A-Za-z ]{1,28}:\s*(-{3,}\s*\||\|)")).select("doc_id", "line_no")


@register("widest_rows", "WITH " + LINES + " SELECT doc_id, max(length(line) - length(replace(line, '|', '')) + 1) AS columns FROM lines WHERE contains(line, '|') GROUP BY doc_id")
def widest_rows(spark, sf_dir):
    """The most columns of any table line of a document."""
    cut = F.length("line") - F.length(F.replace("line", F.lit("|"))) + 1
    return lines(spark, sf_dir).where(F.contains("line", F.lit("|"))).groupBy("doc_id").agg(F.max(cut.cast("long")).alias("columns"))


@register(
    "label_headers",
    r"""WITH r AS (SELECT source, CASE lang WHEN 'en' THEN 'Name' WHEN 'fr' THEN 'Phone' WHEN 'de' THEN 'Zone' ELSE 'Area' END AS label FROM documents),
  d AS (SELECT DISTINCT source, label, CASE label WHEN 'Name' THEN 1 WHEN 'E-Mail' THEN 2 WHEN 'Phone' THEN 3 WHEN 'Location' THEN 4 ELSE 5 END AS rank FROM r)
  SELECT source, string_agg(label, ' ' ORDER BY rank, label) AS headers FROM d GROUP BY source""",
)
def label_headers(spark, sf_dir):
    """The header of a table made of rows with labels: fixed labels first, the others sorted."""
    label = F.when(F.col("lang") == "en", "Name").when(F.col("lang") == "fr", "Phone").when(F.col("lang") == "de", "Zone").otherwise("Area")
    by = _docs(spark, sf_dir).groupBy("source").agg(F.collect_set(label).alias("labels"))
    return by.select("source", F.array_join(assemble.header_order(F.col("labels")), " ").alias("headers"))


@register(
    "earliest_names",
    r"""WITH n AS (SELECT doc_id, text, regexp_extract(text, '[A-ZÄÖÜ][a-zäöüß]+ [A-ZÄÖÜ][a-zäöüß]+') AS two, regexp_extract(text, '[A-ZÄÖÜ][a-zäöüß]+, [A-ZÄÖÜ][a-zäöüß]+') AS turned FROM documents)
  SELECT doc_id, CASE WHEN two <> '' AND (turned = '' OR strpos(text, two) <= strpos(text, turned)) THEN two ELSE turned END AS name FROM n WHERE two <> '' OR turned <> ''""",
)
def earliest_names(spark, sf_dir):
    """Of a document's candidates for a name the one that comes first."""
    candidates = F.array(*[F.regexp_extract("text", p, 0) for p in ("[A-ZÄÖÜ][a-zäöüß]+ [A-ZÄÖÜ][a-zäöüß]+", "[A-ZÄÖÜ][a-zäöüß]+, [A-ZÄÖÜ][a-zäöüß]+")])
    placed = F.transform(F.filter(candidates, lambda x: x != ""), lambda x: F.struct(F.instr(F.col("text"), x).alias("at"), x.alias("name")))
    return _docs(spark, sf_dir).select("doc_id", F.array_min(placed)["name"].alias("name")).where("name is not null")


@register("visible_nodes", rf"""WITH {page_queries.BARE}, v AS (SELECT page_id, regexp_replace(h, '(?s)(<nav>.*?</nav>|<footer>.*?</footer>|<script>.*?</script>|<style>.*?</style>)', '', 'g') AS h FROM b),
  t AS (SELECT page_id, unnest(regexp_extract_all(h, '<([a-zA-Z][a-zA-Z0-9]*)', 1)) AS tag FROM v) SELECT page_id, tag, count(*) AS n FROM t GROUP BY page_id, tag""")
def visible_nodes(spark, sf_dir):
    """Elements of each page that are neither navigation nor hidden, by tag."""
    nodes = dom.dom_nodes(_pages(spark, sf_dir))
    marked = assemble.is_boilerplate() | F.col("tag").isin(*dom.NAVIGATION, "script", "style", "noscript")
    return assemble.without_subtrees(nodes, marked).groupBy("page_id", "tag").agg(F.count("*").alias("n"))


@register("link_heavy_blocks", f"""WITH {page_queries.BARE}, s AS (SELECT page_id, string_split(h, '<ul>') AS p FROM b),
  u AS (SELECT page_id, split_part(p[i + 1], '</ul>', 1) AS part, CAST(list_sum(list_transform(p[1:i], lambda x: {page_queries.TAGS.format('x')})) + i AS INTEGER) AS node_id FROM s, range(1, len(p)) r(i))
  SELECT page_id, node_id, 'ul' AS tag, len(regexp_extract_all(part, '<a ')) AS links FROM u WHERE len(regexp_extract_all(part, '<a ')) > 3 AND length({page_queries.SAID.format('part')}) < 200""")
def link_heavy_blocks(spark, sf_dir):
    return assemble.link_heavy(dom.dom_nodes(_pages(spark, sf_dir))).select("page_id", "node_id", "tag", F.col("links").cast("long").alias("links"))


_WORDS = r"len(list_filter(string_split_regex(trim({0}), '\s+'), lambda w: w <> ''))"


@register("dense_blocks", f"""WITH {page_queries.PARAGRAPHS}, d AS (SELECT page_id, string_split(h, '<div class="ad">') AS p FROM b),
  x AS (SELECT page_id, pos AS node_id, 'p' AS tag, said FROM t
    UNION ALL SELECT page_id, CAST({page_queries.TAGS.format("split_part(h, '<article>', 1)")} + 1 AS INTEGER), 'article', {page_queries.SAID.format("regexp_extract(h, '(?s)<article>(.*?)</article>', 1)")} FROM b
    UNION ALL SELECT page_id, CAST(list_sum(list_transform(p[1:i], lambda y: {page_queries.TAGS.format('y')})) + i AS INTEGER), 'div', {page_queries.SAID.format("split_part(p[i + 1], '</div>', 1)")} FROM d, range(1, len(p)) r(i))
  SELECT page_id, node_id, tag, CAST({_WORDS.format('said')} AS BIGINT) AS words, CAST(1 AS DOUBLE) AS density FROM x WHERE {_WORDS.format('said')} >= 5""")
def dense_blocks(spark, sf_dir):
    return assemble.dense_blocks(dom.dom_nodes(_pages(spark, sf_dir)))


@register("section_groups")
def section_groups(spark, sf_dir):
    """Every link of a page under its section, sections in order."""
    anchors = dom.governing_heading(dom.dom_nodes(_pages(spark, sf_dir)))
    return assemble.grouped_links(anchors.select("page_id", "section", F.col("node_id").alias("seq"), "text", F.try_element_at("attrs", F.lit("href")).alias("href")))


def _markdown_lines(spark, sf_dir):
    pages = page_queries.page_markdown(spark, sf_dir)
    return pages.select("page_id", F.posexplode(F.split("markdown", "\n")).alias("line_no", "line"))


@register("empty_sections", f"WITH {page_queries.ITEMS} SELECT page_id, CAST(4 AS INTEGER) AS line_no FROM i WHERE text <> '' GROUP BY page_id HAVING count(*) FILTER (type = 'heading') = 1 AND count(*) FILTER (type <> 'heading') = 0")
def empty_sections(spark, sf_dir):
    """Headings that nothing follows: on the tables' pages the only one, where there is no paragraph."""
    return assemble.empty_sections(_markdown_lines(spark, sf_dir), "page_id")


@register("heading_antijoin", rf"""WITH {page_queries.MARKDOWN}, l AS (SELECT page_id, unnest(string_split(markdown, chr(10))) AS line, CAST(generate_subscripts(string_split(markdown, chr(10)), 1) - 1 AS INTEGER) AS line_no FROM m)
  SELECT l.page_id, line_no, line FROM l WHERE NOT (starts_with(trim(line), '#') AND EXISTS (SELECT 1 FROM i WHERE i.page_id = l.page_id AND type = 'heading' AND lower(trim(i.text)) = lower(trim(regexp_replace(line, '^#+', '')))))""")
def heading_antijoin(spark, sf_dir):
    """Lines of each page's markdown without the headings that its node table has."""

    def both(url, root):
        return [{"markdown": extract.markdown(url, root), "headings": [n.text() for n in root.find_all(*extract.HEADINGS)]}]

    pages = extract.apply(_pages(spark, sf_dir), both, "markdown string, headings array<string>")
    lines = pages.select("page_id", "headings", F.posexplode(F.split("markdown", "\n")).alias("line_no", "line"))
    return assemble.without_listed_headings(lines, "headings")


@register("linked_tables", f"WITH {page_queries.MARKDOWN} SELECT page_id, markdown FROM m")
def linked_tables(spark, sf_dir):
    """Each page's markdown with its tables' links and contacts' addresses put back; the tables' pages have none."""

    def linked(url, root):
        text = assemble.with_table_links(extract.markdown(url, root), root)
        return [{"markdown": assemble.with_addresses(text, extract.contacts(root))}]

    return extract.apply(_pages(spark, sf_dir), linked, "markdown string")


@register("contact_lines", "SELECT page_id, '' AS line FROM pages WHERE contains(lower(html), 'mailto:')")
def contact_lines(spark, sf_dir):
    return extract.apply(_pages(spark, sf_dir), lambda url, root: [{"line": assemble.contact_line(c)} for c in extract.contacts(root)], "line string")


@register("hashed_embeddings")
def hashed_embeddings(spark, sf_dir):
    """Document vectors of the built-in hashing embedder; a model takes its place by a parameter."""
    return vector.embed(_docs(spark, sf_dir).select("doc_id", "text"), "text", "embedding").select("doc_id", "embedding")
