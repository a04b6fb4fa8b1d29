"""Queries over a site's own links, its reports, and the tests and projections of single pages."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from webloom.functions import text as X
from webloom.functions import urls as U
from webloom.operators import assemble, graph
from webloom.options import Options
from webloom.plans.catalog import register
from webloom.plans.link_queries import BARE, ERRORS, FINALS, FULL, LINKS, SITE, _errors, _finals, _links, _pages
from webloom.session import table
from webloom.sources.tables import seeds

OPTIONS = Options(max_depth=3, max_pages=500, site=SITE)

#: The pages' own links, both ends normalized.
OWN = f"{LINKS}, own AS (SELECT DISTINCT page_id, replace(url, '://www.', '://') AS src, replace({FULL}, '://www.', '://') AS dst FROM kept)"


def _own(spark, sf_dir):
    return _links(spark, sf_dir).select("page_id", U.normalize(F.col("url")).alias("src"), U.normalize(F.col("target")).alias("dst")).distinct()


@register("site_depths", f"""WITH RECURSIVE {OWN}, seeds AS (SELECT replace(url, '://www.', '://') AS node FROM pages WHERE page_id % 10 = 0),
  walk(node, depth) AS (SELECT node, 0 FROM seeds UNION SELECT o.dst, w.depth + 1 FROM walk w JOIN own o ON o.src = w.node WHERE w.depth < {OPTIONS.max_depth})
  SELECT node, min(depth) AS depth FROM walk GROUP BY node ORDER BY depth, node LIMIT {OPTIONS.max_pages}""")
def site_depths(spark, sf_dir):
    """Breadth-first over the pages' own links from the seeds, to the greatest depth and at most so many pages, nearest first."""
    seeds = _pages(spark, sf_dir).where("page_id % 10 = 0").select(U.normalize(F.col("url")).alias("node"))
    return graph.crawl(_own(spark, sf_dir), seeds, OPTIONS.max_depth, OPTIONS.max_pages)


_UNSEEN = f"""{OWN}, seen AS (SELECT replace(url, '://www.', '://') AS dst FROM pages WHERE page_id % 7 = 0), inside AS (SELECT page_id, dst FROM own WHERE {BARE.format('dst')} = '{SITE}' OR ends_with({BARE.format('dst')}, '.{SITE}')),
  fresh AS (SELECT * FROM inside WHERE dst NOT IN (SELECT dst FROM seen WHERE dst IS NOT NULL))"""


def _unseen(spark, sf_dir):
    """(page_id, dst): the site's links to pages that weren't visited."""
    seen = _pages(spark, sf_dir).where("page_id % 7 = 0").select(U.normalize(F.col("url")).alias("dst")).distinct()
    return _own(spark, sf_dir).where(U.in_domain(F.col("dst"), OPTIONS.site)).select("page_id", "dst").join(seen, "dst", "left_anti")


@register("recovered_page_links", f"WITH {_UNSEEN} SELECT dst, least(min(page_id % 5) + 1, {OPTIONS.max_depth}) AS depth FROM fresh GROUP BY dst ORDER BY depth, dst LIMIT {OPTIONS.recovered_links}")
def recovered_page_links(spark, sf_dir):
    """Links of all pages that weren't followed, at their least depth: one more than the page's, at most the greatest."""
    least = _unseen(spark, sf_dir).groupBy("dst").agg(F.min(F.col("page_id") % 5).alias("depth"))
    return least.select("dst", F.least(F.col("depth") + 1, F.lit(OPTIONS.max_depth).cast("long")).alias("depth")).orderBy("depth", "dst").limit(OPTIONS.recovered_links)


@register("recovered_first_links", f"WITH {_UNSEEN}, f AS (SELECT dst FROM fresh WHERE page_id = (SELECT min(page_id) FROM fresh)) SELECT DISTINCT dst FROM f ORDER BY dst LIMIT {OPTIONS.recovered_links_of_first}")
def recovered_first_links(spark, sf_dir):
    """Of the first page that has any: the links that weren't followed, at most a hundred."""
    fresh = _unseen(spark, sf_dir)
    first = fresh.agg(F.min("page_id").alias("page_id"))
    return fresh.join(first, "page_id", "left_semi").select("dst").distinct().orderBy("dst").limit(OPTIONS.recovered_links_of_first)


SEEDS = ("https://www.site.example/", "https://site.example/team", "https://other.example/x")


@register("seed_pages", "WITH s AS (SELECT unnest(['" + "', '".join(SEEDS) + "']) AS url UNION ALL SELECT url FROM pages WHERE page_id < 5), n AS (SELECT DISTINCT replace(url, '://www.', '://') AS norm FROM s) SELECT n.norm AS url, p.page_id IS NOT NULL AS stored FROM n LEFT JOIN pages p ON replace(p.url, '://www.', '://') = n.norm")
def seed_pages(spark, sf_dir):
    """The seed list, each seed once in its normal form, and whether a page of it is stored."""
    named = seeds(spark, list(SEEDS)).select("url").union(_pages(spark, sf_dir).where("page_id < 5").select("url"))
    normal = named.select(U.normalize(F.col("url")).alias("url")).distinct()
    stored = _pages(spark, sf_dir).select(U.normalize(F.col("url")).alias("url")).distinct().withColumn("there", F.lit(True))
    return normal.join(stored, "url", "left").select("url", F.coalesce("there", F.lit(False)).alias("stored"))


@register("date_mentions", r"""WITH t AS (SELECT doc_id, coalesce(text, '') || ' 01.02.2024 Friday, 3 May 2024 at 10:30 PM' AS t FROM documents)
  SELECT doc_id, len(regexp_extract_all(t, '\d{2}\.\d{2}\.\d{4}')) AS dotted, len(regexp_extract_all(t, '(?i)(?:Mon|Tues|Wednes|Thurs|Fri|Satur|Sun)day,?\s+\w+\s+\w+')) AS weekdays, len(regexp_extract_all(t, '\d{1,2}:\d{2}\s*(?:AM|PM)?')) AS times FROM t""")
def date_mentions(spark, sf_dir):
    """Dates and times by how they are written."""
    said = F.concat(F.coalesce("text", F.lit("")), F.lit(" 01.02.2024 Friday, 3 May 2024 at 10:30 PM"))
    n = lambda pattern: F.regexp_count(said, F.lit(pattern)).cast("long")
    return table(spark, sf_dir, "documents").select("doc_id", n(X.DOTTED_DATE).alias("dotted"), n(X.WEEKDAY_DATE).alias("weekdays"), n(X.CLOCK).alias("times"))


@register("greatest_depth", f"WITH {FINALS} SELECT max(depth) AS max_depth_crawled, count(DISTINCT final_url) AS pages FROM f")
def greatest_depth(spark, sf_dir):
    return _finals(spark, sf_dir).agg(F.max("depth").alias("max_depth_crawled"), F.countDistinct("final_url").alias("pages"))


@register("page_files", f"WITH {FINALS} SELECT depth, count(DISTINCT left(replace(replace(regexp_replace(final_url, '^https?://', ''), '/', '_'), ':', '_'), 200) || '.md') AS files FROM f GROUP BY depth")
def page_files(spark, sf_dir):
    """How many files each depth's folder gets."""
    return _finals(spark, sf_dir).groupBy("depth").agg(F.countDistinct(U.safe_filename(F.col("final_url"))).alias("files"))


@register("depth_summary", f"WITH {FINALS} SELECT depth, count(*) AS n, rank() OVER (ORDER BY depth) AS place FROM f GROUP BY depth ORDER BY depth")
def depth_summary(spark, sf_dir):
    """URLs of each depth, the depths in order."""
    counted = _finals(spark, sf_dir).groupBy("depth").agg(F.count("*").alias("n"))
    return counted.withColumn("place", F.rank().over(Window.orderBy("depth")).cast("long")).orderBy("depth")  # a row for each depth


_JSON_DEPTH = """(SELECT depth, '"' || depth || '":{"count":' || count(*) || ',"urls":[' || string_agg('{"original_url":"' || url || '","final_url":"' || final_url || '","is_redirect":' || CAST(is_redirect AS VARCHAR) || '}', ',' ORDER BY seq) || ']}' AS part
  FROM (SELECT depth, final_url, min(seq) AS seq, min_by(url, seq) AS url, min_by(is_redirect, seq) AS is_redirect FROM f GROUP BY depth, final_url) GROUP BY depth)"""


@register("depth_report", f"""WITH {FINALS} SELECT (SELECT '{{' || string_agg(part, ',' ORDER BY depth) || '}}' FROM {_JSON_DEPTH}) AS urls_by_depth, count(*) AS total_urls, count(*) FILTER (is_redirect) AS redirects,
  count(DISTINCT final_url) AS unique_final_urls, count(DISTINCT url) AS unique_original_urls FROM f""")
def depth_report(spark, sf_dir):
    """The report as one document: depths with their counts and entries, first seen first, and the totals."""
    finals = _finals(spark, sf_dir)
    entry = F.min(F.struct("seq", F.col("url").alias("original_url"), "is_redirect")).alias("e")
    each = finals.groupBy("depth", "final_url").agg(entry)
    listed = F.transform(F.array_sort(F.collect_list(F.struct("e.seq", "e.original_url", "final_url", "e.is_redirect"))), lambda x: F.struct(x["original_url"].alias("original_url"), x["final_url"].alias("final_url"), x["is_redirect"].alias("is_redirect")))
    by = each.groupBy("depth").agg(F.count("*").alias("count"), listed.alias("urls"))
    part = F.concat(F.lit('"'), F.col("depth").cast("string"), F.lit('":'), F.to_json(F.struct("count", "urls")))
    whole = by.agg(F.array_sort(F.collect_list(F.struct("depth", part.alias("part")))).alias("parts")).select(F.concat(F.lit("{"), F.array_join(F.transform("parts", lambda x: x["part"]), ","), F.lit("}")).alias("urls_by_depth"))
    totals = finals.agg(F.count("*").alias("total_urls"), F.count_if("is_redirect").alias("redirects"), F.countDistinct("final_url").alias("unique_final_urls"), F.countDistinct("url").alias("unique_original_urls"))
    return whole.join(totals, F.lit(True))  # one row and one row


@register("error_lists", f"""WITH {ERRORS} SELECT is_timeout, count(*) AS n, '[' || string_agg('{{"event_id":' || event_id || ',"error":"' || error || '","error_type":"' || error_type || '"}}', ',' ORDER BY event_id) || ']' AS errors FROM t GROUP BY is_timeout""")
def error_lists(spark, sf_dir):
    """The error log: the timeouts and the others, each as a list in order."""
    listed = F.to_json(F.array_sort(F.collect_list(F.struct("event_id", "error", "error_type"))))
    return _errors(spark, sf_dir).groupBy("is_timeout").agg(F.count("*").alias("n"), listed.alias("errors"))


@register("startup_errors", f"WITH {ERRORS}, s AS (SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'ENOSPC: ' ELSE '' END || error AS error FROM t) SELECT event_id, CASE WHEN regexp_matches(error, '(?i)ENOSPC|no space left') THEN 'disk_full' WHEN regexp_matches(lower(error), 'timeout|timed out') THEN 'timeout' ELSE 'other' END AS kind FROM s")
def startup_errors(spark, sf_dir):
    """A full disk at the start told from time-outs and others."""
    said = F.concat(F.when(F.col("event_id") % 5 == 0, "ENOSPC: ").otherwise(""), "error")
    return _errors(spark, sf_dir).select("event_id", X.error_kind(said).alias("kind"))


HOSTS, REPOSITORY = ["archive.example"], ["results overview", "search tips", "guest :: login", "sort by:", "footer", "article"]


@register("repository_pages", "SELECT page_id, (" + " OR ".join(f"contains(lower(url), '{h}')" for h in HOSTS) + ") OR (" + " + ".join(f"contains(lower(html), '{m}')::INT" for m in REPOSITORY) + ") >= 2 AS is_repository FROM pages")
def repository_pages(spark, sf_dir):
    return _pages(spark, sf_dir).select("page_id", U.is_repository_page(F.col("url"), F.col("html"), HOSTS, REPOSITORY).alias("is_repository"))


_UI = "|".join(X.UI_KEYWORDS).replace("'", "''").replace("|", "|").replace(".", "\\.")


@register("ui_tables", r"""WITH t AS (SELECT doc_id, lower(text) || CASE WHEN doc_id % 4 = 0 THEN ' repo-2021-01234' WHEN doc_id % 4 = 1 THEN ' Guest :: Login' WHEN doc_id % 4 = 2 THEN ' repo submit' ELSE '' END AS t FROM documents)
  SELECT doc_id, (regexp_matches(lower(t), '""" + _UI + r"""') OR (contains(lower(t), 'repo') AND regexp_matches(lower(t), 'login|guest|search:|submit'))) AND NOT regexp_matches(lower(t), 'repo-\d{4}-\d{5}') AS is_ui FROM t""")
def ui_tables(spark, sf_dir):
    """Tables of a repository's search form, told from its records by their ids; here the name is ``repo``."""
    n = F.col("doc_id") % 4
    said = F.concat(F.lower("text"), F.when(n == 0, " repo-2021-01234").when(n == 1, " Guest :: Login").when(n == 2, " repo submit").otherwise(""))
    return table(spark, sf_dir, "documents").select("doc_id", X.is_ui_table(said, "repo").alias("is_ui"))


@register("event_urls", "SELECT page_id, contains(lower(u), 'events.example') AND contains(lower(u), '/event/') AS is_event FROM (SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'https://Events.example.com/event/' || page_id ELSE url END AS u FROM pages)")
def event_urls(spark, sf_dir):
    url = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("https://Events.example.com/event/"), F.col("page_id").cast("string"))).otherwise(F.col("url"))
    return _pages(spark, sf_dir).select("page_id", U.is_event_page(url, "events.example").alias("is_event"))


@register("blank_values", "SELECT conv_id, turn, coalesce(trim(text), '') = '' AS blank FROM conversations UNION ALL SELECT -1, 0, true UNION ALL SELECT -1, 1, true UNION ALL SELECT -1, 2, false")
def blank_values(spark, sf_dir):
    more = spark.createDataFrame([(-1, 0, None), (-1, 1, "  "), (-1, 2, "x")], "conv_id long, turn long, text string")
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", "text").union(more).select("conv_id", "turn", X.blank(F.col("text")).alias("blank"))


@register("normalized_headers", r"SELECT doc_id, array_to_string(list_filter(list_transform(string_split(t, '|'), lambda x: lower(trim(regexp_replace(x, '[^\w\s]', '', 'g')))), lambda x: x <> ''), '|') AS header FROM (SELECT doc_id, '| Name: | E-Mail |' || source || '| ' || lang || ' |' AS t FROM documents)")
def normalized_headers(spark, sf_dir):
    """A table's header line as what its columns are compared by."""
    line = F.concat(F.lit("| Name: | E-Mail |"), "source", F.lit("| "), "lang", F.lit(" |"))
    return table(spark, sf_dir, "documents").select("doc_id", X.normalized_header(line).alias("header"))


@register("ordered_segments", r"""WITH m AS (SELECT doc_id, unnest([strpos(text, '@'), strpos(text, '+'), strpos(text, 'http')]) AS start, unnest(['email', 'phone', 'url']) AS kind FROM documents)
  SELECT doc_id, string_agg(kind, ' ' ORDER BY start, kind) AS kinds FROM m WHERE start > 0 GROUP BY doc_id""")
def ordered_segments(spark, sf_dir):
    """What a cell holds, by where it begins."""
    at = lambda what, kind: F.struct(F.instr("text", F.lit(what)).alias("start"), F.lit(kind).alias("kind"))
    found = F.array_sort(F.filter(F.array(at("@", "email"), at("+", "phone"), at("http", "url")), lambda s: s["start"] > 0))
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(F.transform(found, lambda s: s["kind"]), " ").alias("kinds")).where("kinds <> ''")


@register("pdf_content", "SELECT doc_id, CASE WHEN doc_id % 3 <> 0 AND text <> '' THEN text WHEN doc_id % 3 <> 1 THEN left(text, 50) ELSE '' END AS content, CASE WHEN doc_id % 2 = 0 THEN 'Title ' || doc_id END AS title, 'a' || doc_id AS author FROM documents WHERE text IS NOT NULL")
def pdf_content(spark, sf_dir):
    """A PDF's text: the raw form before the filtered one; its title and author from its metadata."""
    n = F.col("doc_id") % 3
    raw, fit = F.when(n != 0, F.col("text")), F.when(n != 1, F.substring("text", 1, 50))
    meta = F.map_from_arrays(F.when(F.col("doc_id") % 2 == 0, F.array(F.lit("title"), F.lit("author"))).otherwise(F.array(F.lit("author"))), F.when(F.col("doc_id") % 2 == 0, F.array(F.concat(F.lit("Title "), F.col("doc_id").cast("string")), F.concat(F.lit("a"), F.col("doc_id").cast("string")))).otherwise(F.array(F.concat(F.lit("a"), F.col("doc_id").cast("string")))))
    found = table(spark, sf_dir, "documents").where("text is not null")
    return found.select("doc_id", X.pdf_content(raw, fit).alias("content"), F.try_element_at(meta, F.lit("title")).alias("title"), F.try_element_at(meta, F.lit("author")).alias("author"))


@register("image_references", "WITH i AS (SELECT page_id, unnest(['a.png', 'dir/b.jpg', url]) AS path, unnest([1, 2, 3]) AS n FROM pages) SELECT page_id, string_agg('![Image ' || n || '](' || path || ')', chr(10) ORDER BY n) AS images FROM i GROUP BY page_id")
def image_references(spark, sf_dir):
    """A page's images as numbered references."""
    return _pages(spark, sf_dir).select("page_id", assemble.image_references(F.array(F.lit("a.png"), F.lit("dir/b.jpg"), F.col("url"))).alias("images"))


@register("late_markdown_lines", "SELECT doc_id, len(list_filter(string_split(text, chr(10)), lambda x: length(trim(x)) >= 3 AND NOT regexp_matches(trim(x), '^https?://\\S+$') AND NOT regexp_matches(trim(x), '^\\|[\\s|:\\-]*\\|$') AND NOT regexp_matches(trim(x), '^(URL:|Breadcrumb)'))) AS kept FROM documents WHERE text IS NOT NULL")
def late_markdown_lines(spark, sf_dir):
    """Lines that aren't left over from a page's frame: no rules, addresses, breadcrumbs, nor under three characters."""
    return table(spark, sf_dir, "documents").where("text is not null").select("doc_id", F.size(F.filter(F.split("text", "\n"), lambda x: ~X.leaked_line(x))).cast("long").alias("kept"))
