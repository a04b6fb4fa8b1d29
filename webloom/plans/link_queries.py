"""URL and link-graph queries over ``pages``, reports over ``events``."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from webloom.functions import urls as U
from webloom.operators import graph
from webloom.plans.catalog import register
from webloom.session import table

#: The same expressions in DuckDB.
HOST = r"regexp_extract({0}, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)', 1)"
BARE = "replace(lower(" + HOST + "), 'www.', '')"
SCHEME = r"lower(regexp_extract({0}, '^([A-Za-z][A-Za-z0-9+.\-]*):', 1))"
LINKS = r"""links AS (
  SELECT page_id, url, unnest(regexp_extract_all(html, '<a\s[^>]*href="([^"]*)"', 1)) AS href FROM pages),
kept AS (SELECT * FROM links WHERE href <> '' AND NOT regexp_matches(href, '^(#|javascript:|mailto:)'))"""
ROOT = r"regexp_extract({0}, '^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)', 1)"
FULL = "CASE WHEN starts_with(href, '//') THEN " + SCHEME.format("url") + " || ':' || href WHEN starts_with(href, '/') THEN " + ROOT.format("url") + " || href ELSE href END"
SITE = "example.com"


def _pages(spark, sf_dir):
    return table(spark, sf_dir, "pages")


def _links(spark, sf_dir):
    """(page_id, url, href, target) of every followed anchor."""
    found = _pages(spark, sf_dir).select("page_id", "url", F.explode(U.anchors(F.col("html"))).alias("href"))
    return found.withColumn("target", U.resolve(F.col("url"), F.col("href")))


@register(
    "link_analysis",
    f"""WITH {LINKS}
    SELECT p.page_id, replace(p.url, '://www.', '://') AS norm_url, count(k.href) AS links_found,
           count(DISTINCT k.href) AS distinct_links
    FROM pages p LEFT JOIN kept k ON p.page_id = k.page_id GROUP BY p.page_id, p.url""",
)
def link_analysis(spark, sf_dir):
    found = U.anchors(F.col("html"))
    return _pages(spark, sf_dir).select("page_id", U.normalize(F.col("url")).alias("norm_url"), F.size(found).cast("long").alias("links_found"), F.size(F.array_distinct(found)).cast("long").alias("distinct_links"))


@register("url_normalize", "SELECT page_id, CASE WHEN url <> '' THEN replace(url, '://www.', '://') END AS norm_url FROM pages")
def url_normalize(spark, sf_dir):
    return _pages(spark, sf_dir).select("page_id", U.normalize(F.col("url")).alias("norm_url"))


@register(
    "url_validate",
    f"""SELECT page_id, CASE WHEN url IS NULL OR trim(url) = '' THEN 'empty_or_not_string'
      WHEN {SCHEME.format('url')} IN ('mailto', 'tel', 'javascript', 'data') THEN 'protocol_' || {SCHEME.format('url')}
      WHEN {SCHEME.format('url')} <> 'https' THEN 'invalid_scheme' WHEN {HOST.format('url')} = '' THEN 'missing_netloc' END AS reason FROM pages""",
)
def url_validate(spark, sf_dir):
    return _pages(spark, sf_dir).select("page_id", U.invalid_reason(F.col("url")).alias("reason"))


@register(
    "skip_reasons",
    f"""WITH r AS (SELECT CASE WHEN {SCHEME.format('url')} <> 'https' THEN 'invalid_scheme' ELSE 'valid' END AS reason FROM pages)
    SELECT reason, count(*) AS n FROM r GROUP BY reason""",
)
def skip_reasons(spark, sf_dir):
    return _pages(spark, sf_dir).groupBy(F.coalesce(U.invalid_reason(F.col("url")), F.lit("valid")).alias("reason")).agg(F.count("*").alias("n"))


_EXCLUDED = r"""(regexp_matches({0}, '\.(ics|pdf|jpg|jpeg|png|zip|docx?|mp4|avi|xlsx?|ps|ps\.gz|mov|pptx?|dotx|wmv|tar\.gz|gz)(\?.*)?$')
  OR regexp_matches({0}, '^(callto|davs?|mattermost|file|ftp|tel|mailto|javascript|data|doi|ttps|urn):') OR regexp_matches({0}, '^https?://\s*$')
  OR (contains({0}, '://') AND NOT regexp_matches({0}, '^https?://')))"""


@register("url_exclusion", f"WITH {LINKS}, t AS (SELECT page_id, {FULL} AS target FROM links) SELECT page_id, target, {_EXCLUDED.format('target')} AS excluded FROM t")
def url_exclusion(spark, sf_dir):
    found = _pages(spark, sf_dir).select("page_id", "url", F.explode(U.hrefs(F.col("html"))).alias("href"))
    return found.select("page_id", U.resolve(F.col("url"), F.col("href")).alias("target")).withColumn("excluded", U.excluded(F.col("target")))


@register("pdf_url_flag", r"SELECT page_id, regexp_matches(lower(regexp_extract(url, '^([^?#]*)', 1)), '\.pdf|/pdf/|/pdfs/|/document/') AS is_pdf FROM pages")
def pdf_url_flag(spark, sf_dir):
    return _pages(spark, sf_dir).select("page_id", U.is_pdf(F.col("url")).alias("is_pdf"))


@register("safe_filename", "SELECT page_id, left(replace(replace(regexp_replace(url, '^https?://', ''), '/', '_'), ':', '_'), 200) || '.md' AS filename FROM pages")
def safe_filename(spark, sf_dir):
    return _pages(spark, sf_dir).select("page_id", U.safe_filename(F.col("url")).alias("filename"))


@register("domain_restriction", f"SELECT page_id, {BARE.format('url')} AS host, ({BARE.format('url')} = '{SITE}' OR ends_with({BARE.format('url')}, '.{SITE}')) AS inside FROM pages")
def domain_restriction(spark, sf_dir):
    return _pages(spark, sf_dir).select("page_id", U.bare_host(F.col("url")).alias("host"), U.in_domain(F.col("url"), SITE).alias("inside"))


@register("internal_links", f"WITH {LINKS}, t AS (SELECT page_id, url, {FULL} AS target FROM kept) SELECT page_id, count(*) AS n_internal FROM t WHERE {BARE.format('url')} = {BARE.format('target')} GROUP BY page_id")
def internal_links(spark, sf_dir):
    same = U.bare_host(F.col("url")) == U.bare_host(F.col("target"))
    return _links(spark, sf_dir).where(same).groupBy("page_id").agg(F.count("*").alias("n_internal"))


@register("links_per_host", f"WITH {LINKS}, t AS (SELECT {FULL} AS target FROM kept) SELECT {BARE.format('target')} AS host, count(*) AS n_links, count(DISTINCT target) AS n_targets FROM t GROUP BY 1")
def links_per_host(spark, sf_dir):
    return _links(spark, sf_dir).groupBy(U.bare_host(F.col("target")).alias("host")).agg(F.count("*").alias("n_links"), F.countDistinct("target").alias("n_targets"))


@register("top_linking_pages", f"WITH {LINKS} SELECT page_id, count(*) AS n_links FROM kept GROUP BY page_id ORDER BY n_links DESC, page_id LIMIT 20")
def top_linking_pages(spark, sf_dir):
    return _pages(spark, sf_dir).select("page_id", F.size(U.anchors(F.col("html"))).cast("long").alias("n_links")).where("n_links > 0").orderBy(F.desc("n_links"), "page_id").limit(20)


@register("link_totals", f"""WITH {LINKS}, n AS (SELECT p.page_id, count(k.href) AS n FROM pages p LEFT JOIN kept k ON p.page_id = k.page_id GROUP BY 1)
    SELECT CAST(sum(n) AS BIGINT) AS total_links, count(*) AS pages, round(sum(n) / greatest(count(*), 1), 4) AS avg_links, max(n) AS most_links FROM n""")
def link_totals(spark, sf_dir):
    n = _pages(spark, sf_dir).select(F.size(U.anchors(F.col("html"))).cast("long").alias("n"))
    return n.agg(F.sum("n").alias("total_links"), F.count("*").alias("pages"), F.round(F.sum("n") / F.greatest(F.count("*"), F.lit(1)), 4).alias("avg_links"), F.max("n").alias("most_links"))


#: Crawl results made of pages: every fifth fetch is redirected to the page before it, depths follow the id.
RESULTS = """r AS (SELECT page_id AS seq, url, CASE WHEN page_id % 5 = 0 THEN lag(url) OVER (ORDER BY page_id) END AS redirected_url,
  CASE WHEN page_id % 17 = 0 THEN 404 ELSE 200 END AS status_code, CASE WHEN page_id % 34 = 0 THEN '<p>gone</p>' WHEN page_id % 51 = 0 THEN '' ELSE html END AS html,
  CASE WHEN page_id % 102 = 51 THEN repeat('still here ', 20) ELSE 'gone' END AS markdown, page_id % 5 AS depth FROM pages)"""
HAS_CONTENT = "(CASE WHEN html <> '' THEN length(trim(html)) > 100 ELSE length(trim(markdown)) > 100 END)"


def _results(spark, sf_dir):
    """Crawl results; the page before is joined by id, which needs no window over the whole table."""
    pages = _pages(spark, sf_dir)
    before = pages.select((F.col("page_id") + 1).alias("page_id"), F.col("url").alias("before"))
    joined = pages.join(before, "page_id", "left")
    return joined.select(
        F.col("page_id").alias("seq"),
        "url",
        F.when(F.col("page_id") % 5 == 0, F.col("before")).alias("redirected_url"),
        F.when(F.col("page_id") % 17 == 0, 404).otherwise(200).alias("status_code"),
        F.when(F.col("page_id") % 34 == 0, "<p>gone</p>").when(F.col("page_id") % 51 == 0, "").otherwise(F.col("html")).alias("html"),
        F.when(F.col("page_id") % 102 == 51, "still here " * 20).otherwise("gone").alias("markdown"),
        (F.col("page_id") % 5).alias("depth"),
    )


def _finals(spark, sf_dir):
    final = F.coalesce("redirected_url", "url")
    return _results(spark, sf_dir).withColumn("final_url", U.normalize(final)).withColumn("is_redirect", F.col("redirected_url").isNotNull() & (F.col("redirected_url") != F.col("url")))


FINALS = f"{RESULTS}, f AS (SELECT *, replace(coalesce(redirected_url, url), '://www.', '://') AS final_url, coalesce(redirected_url <> url, false) AS is_redirect FROM r)"


@register("redirect_summary", f"WITH {FINALS} SELECT count(*) AS n, count(*) FILTER (is_redirect) AS redirects, count(DISTINCT final_url) AS final_urls, count(DISTINCT url) AS original_urls FROM f")
def redirect_summary(spark, sf_dir):
    return _finals(spark, sf_dir).agg(F.count("*").alias("n"), F.count_if("is_redirect").alias("redirects"), F.countDistinct("final_url").alias("final_urls"), F.countDistinct("url").alias("original_urls"))


@register("first_wins_dedup", f"WITH {FINALS} SELECT seq, final_url FROM (SELECT *, row_number() OVER (PARTITION BY final_url ORDER BY seq) AS n FROM f WHERE NOT ((status_code = 404 OR contains(final_url, '/404/')) AND NOT {HAS_CONTENT})) WHERE n = 1")
def first_wins_dedup(spark, sf_dir):
    live = _finals(spark, sf_dir).where(~_gone())
    return live.groupBy("final_url").agg(F.min("seq").alias("seq")).select("seq", "final_url")


def _gone():
    return U.not_found(F.col("final_url"), F.col("status_code"), U.has_content(F.col("html"), F.col("markdown")))


@register("not_found_filter", f"WITH {FINALS} SELECT seq, (contains(final_url, '/404/') OR status_code = 404) AND NOT {HAS_CONTENT} AS dropped FROM f")
def not_found_filter(spark, sf_dir):
    return _finals(spark, sf_dir).select("seq", _gone().alias("dropped"))


@register("first_wins_with_seeds", f"""WITH {FINALS}, k AS (SELECT seq, CASE WHEN seq % 10 = 0 THEN replace(url, '://www.', '://') ELSE final_url END AS key, seq % 10 = 0 AS seed FROM f
    WHERE seq % 10 = 0 OR NOT ((status_code = 404 OR contains(final_url, '/404/')) AND NOT {HAS_CONTENT})) SELECT min(seq) AS seq, key FROM k GROUP BY key""")
def first_wins_with_seeds(spark, sf_dir):
    """The variant that spares seeds: no 404 filter for them, and they count by the URL that was asked for."""
    seed = F.col("seq") % 10 == 0
    kept = _finals(spark, sf_dir).where(seed | ~_gone()).withColumn("key", F.when(seed, U.normalize(F.col("url"))).otherwise(F.col("final_url")))
    return kept.groupBy("key").agg(F.min("seq").alias("seq")).select("seq", "key")


@register("depth_histogram", f"WITH {FINALS} SELECT least(depth, 3) AS depth, count(*) AS n, count(DISTINCT final_url) AS urls FROM f GROUP BY 1")
def depth_histogram(spark, sf_dir):
    return _finals(spark, sf_dir).groupBy(F.least("depth", F.lit(3).cast("long")).alias("depth")).agg(F.count("*").alias("n"), F.countDistinct("final_url").alias("urls"))


@register("min_depth", f"WITH {FINALS} SELECT final_url, min(depth) AS depth, count(*) AS seen FROM f GROUP BY 1")
def min_depth(spark, sf_dir):
    return _finals(spark, sf_dir).groupBy("final_url").agg(F.min("depth").alias("depth"), F.count("*").alias("seen"))


@register("urls_by_depth", f"""WITH {FINALS}, u AS (SELECT depth, final_url, min(seq) AS seq, bool_or(is_redirect) AS is_redirect FROM f GROUP BY 1, 2)
    SELECT depth, count(*) AS n_urls, count(*) FILTER (is_redirect) AS redirects, string_agg(final_url, chr(10) ORDER BY seq) AS urls FROM u GROUP BY depth""")
def urls_by_depth(spark, sf_dir):
    """The report by depth: lists in first-seen order; a depth's list is what its report prints."""
    each = _finals(spark, sf_dir).groupBy("depth", "final_url").agg(F.min("seq").alias("seq"), F.bool_or("is_redirect").alias("is_redirect"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("seq", "final_url"))), lambda x: x["final_url"])
    return each.groupBy("depth").agg(F.count("*").alias("n_urls"), F.count_if("is_redirect").alias("redirects"), F.array_join(ordered, "\n").alias("urls"))


@register("resume_antijoin", f"WITH {FINALS}, seen AS (SELECT DISTINCT final_url FROM f WHERE seq % 3 = 0) SELECT seq, final_url FROM f WHERE final_url NOT IN (SELECT final_url FROM seen)")
def resume_antijoin(spark, sf_dir):
    found = _finals(spark, sf_dir).select("seq", "final_url")
    return found.join(found.where("seq % 3 = 0").select("final_url").distinct(), "final_url", "left_anti").select("seq", "final_url")


@register("seed_skip_on_resume", f"WITH {FINALS}, s AS (SELECT url, max(depth) AS reached FROM r WHERE seq % 10 < 5 GROUP BY url) SELECT f.seq, coalesce(3 <= s.reached, false) AS skipped FROM f LEFT JOIN s ON f.url = s.url")
def seed_skip_on_resume(spark, sf_dir):
    """Seeds that a checkpoint has seen, crawled to the depth asked for (3) or deeper, are skipped."""
    found = _results(spark, sf_dir).select("seq", "url", "depth")
    done = found.where("seq % 10 < 5").groupBy("url").agg(F.max("depth").alias("reached"))
    return found.join(done, "url", "left").select("seq", F.coalesce(F.lit(3) <= F.col("reached"), F.lit(False)).alias("skipped"))


EDGES = "edges AS (SELECT page_id AS src, (page_id * k + k) % (SELECT count(*) FROM pages) AS dst FROM pages, (VALUES (2), (3)) AS t(k))"


def _edges(spark, sf_dir):
    pages = _pages(spark, sf_dir).select("page_id")
    n = pages.count()
    k = F.explode(F.array(F.lit(2), F.lit(3)))
    return pages.select("page_id", k.alias("k")).select(F.col("page_id").alias("src"), ((F.col("page_id") * F.col("k") + F.col("k")) % n).alias("dst"))


@register("bfs_levels", f"""WITH RECURSIVE {EDGES}, walk(node, depth) AS (SELECT CAST(0 AS BIGINT), 0 UNION SELECT e.dst, w.depth + 1 FROM walk w JOIN edges e ON e.src = w.node WHERE w.depth < 3)
    SELECT node, min(depth) AS depth FROM walk GROUP BY node""")
def bfs_levels(spark, sf_dir):
    seeds = _pages(spark, sf_dir).where("page_id = 0").select(F.col("page_id").alias("node"))
    return graph.bfs_depths(_edges(spark, sf_dir), seeds, 3)


@register("recovered_links", f"""WITH {EDGES}, e AS (SELECT dst, min(src % 4) AS depth FROM edges WHERE dst % 7 <> 0 GROUP BY dst) SELECT dst, least(depth + 1, 3) AS depth FROM e ORDER BY depth, dst LIMIT 10000""")
def recovered_links(spark, sf_dir):
    """Link targets that weren't crawled, each with its least depth, at most 10,000 in order (the crawl's own limit)."""
    crawled = _pages(spark, sf_dir).where("page_id % 7 = 0").select(F.col("page_id").alias("dst"))
    least = _edges(spark, sf_dir).join(crawled, "dst", "left_anti").groupBy("dst").agg(F.min(F.col("src") % 4).alias("depth"))
    return least.select("dst", F.least(F.col("depth") + 1, F.lit(3).cast("long")).alias("depth")).orderBy("depth", "dst").limit(10_000)


@register("assigned_depth", f"""WITH RECURSIVE {EDGES}, walk(node, depth) AS (SELECT CAST(0 AS BIGINT), 0 UNION SELECT e.dst, w.depth + 1 FROM walk w JOIN edges e ON e.src = w.node WHERE w.depth < 3),
    d AS (SELECT node, min(depth) AS depth FROM walk GROUP BY node)
    SELECT p.page_id, least(coalesce(a.depth, b.depth, 1), 2) AS depth FROM pages p LEFT JOIN d a ON a.node = p.page_id LEFT JOIN d b ON b.node = p.page_id // 2""")
def assigned_depth(spark, sf_dir):
    seeds = _pages(spark, sf_dir).where("page_id = 0").select(F.col("page_id").alias("node"))
    depths = graph.bfs_depths(_edges(spark, sf_dir), seeds, 3)
    pages = _pages(spark, sf_dir).select("page_id", F.col("page_id").alias("final_url"), F.floor(F.col("page_id") / 2).alias("original_url"))
    return graph.assigned_depth(pages, depths, 2).select("page_id", "depth")


#: Crawl attempts made of events: errors carry a message by their value.
ERRORS = """e AS (SELECT event_id, ts, user_id, CASE WHEN event_id % 3 = 0 THEN 'Page.goto: Timeout 60000ms exceeded' WHEN event_id % 3 = 1 THEN 'net::ERR_NAME_NOT_RESOLVED' ELSE 'connection timed out' END AS error,
  CASE WHEN event_id % 11 = 0 THEN 'TimeoutError' ELSE 'Error' END AS error_type FROM events WHERE event_type = 'error'),
t AS (SELECT *, (contains(lower(error), 'timeout') OR contains(lower(error), 'timed out') OR contains(error_type, 'TimeoutError')) AS is_timeout FROM e)"""


def _errors(spark, sf_dir):
    n = F.col("event_id") % 3
    found = table(spark, sf_dir, "events").where("event_type = 'error'").select(
        "event_id", "ts", "user_id",
        F.when(n == 0, "Page.goto: Timeout 60000ms exceeded").when(n == 1, "net::ERR_NAME_NOT_RESOLVED").otherwise("connection timed out").alias("error"),
        F.when(F.col("event_id") % 11 == 0, "TimeoutError").otherwise("Error").alias("error_type"),
    )
    return found.withColumn("is_timeout", F.lower("error").rlike("timeout|timed out") | F.col("error_type").contains("TimeoutError"))


@register("error_timeouts", f"WITH {ERRORS} SELECT event_id, error, is_timeout FROM t")
def error_timeouts(spark, sf_dir):
    return _errors(spark, sf_dir).select("event_id", "error", "is_timeout")


@register("error_summary", f"WITH {ERRORS} SELECT count(*) AS total, count(*) FILTER (is_timeout) AS timeouts, count(*) FILTER (NOT is_timeout) AS others, count(DISTINCT user_id) FILTER (is_timeout) AS retry_users FROM t")
def error_summary(spark, sf_dir):
    return _errors(spark, sf_dir).agg(F.count("*").alias("total"), F.count_if("is_timeout").alias("timeouts"), F.count_if(~F.col("is_timeout")).alias("others"), F.countDistinct(F.when(F.col("is_timeout"), F.col("user_id"))).alias("retry_users"))


@register("error_report_json", f"""WITH {ERRORS} SELECT is_timeout, '{{"is_timeout":' || CAST(is_timeout AS VARCHAR) || ',"count":' || count(*) || ',"first":' || min(event_id) || ',"last":' || max(event_id) || '}}' AS report FROM t GROUP BY is_timeout""")
def error_report_json(spark, sf_dir):
    grouped = _errors(spark, sf_dir).groupBy("is_timeout").agg(F.count("*").alias("count"), F.min("event_id").alias("first"), F.max("event_id").alias("last"))
    return grouped.select("is_timeout", F.to_json(F.struct("is_timeout", "count", "first", "last")).alias("report"))


@register("retry_queue", f"WITH {ERRORS} SELECT user_id, min(event_id) AS first_event, count(*) AS n FROM t WHERE is_timeout GROUP BY user_id")
def retry_queue(spark, sf_dir):
    return _errors(spark, sf_dir).where("is_timeout").groupBy("user_id").agg(F.min("event_id").alias("first_event"), F.count("*").alias("n"))


@register("crawl_rate", "SELECT date_trunc('hour', ts) AS hour, count(*) AS n, count(*) FILTER (event_type = 'error') AS errors, count(DISTINCT user_id) AS users FROM events GROUP BY 1")
def crawl_rate(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy(F.date_trunc("hour", "ts").alias("hour")).agg(F.count("*").alias("n"), F.count_if(F.col("event_type") == "error").alias("errors"), F.countDistinct("user_id").alias("users"))


@register("state_merge_last_wins", "SELECT user_id, max(event_id) AS event_id, max_by(event_type, event_id) AS event_type FROM events GROUP BY user_id")
def state_merge_last_wins(spark, sf_dir):
    """Checkpoint merge: the newest entry of each key."""
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.max("event_id").alias("event_id"), F.max_by("event_type", "event_id").alias("event_type"))


@register("errors_not_timeout", f"WITH {ERRORS} SELECT event_id FROM t EXCEPT SELECT event_id FROM t WHERE is_timeout")
def errors_not_timeout(spark, sf_dir):
    found = _errors(spark, sf_dir)
    return found.select("event_id").exceptAll(found.where("is_timeout").select("event_id"))
