"""Text-cleaning, line-rule and answer queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from webloom.functions import text as X
from webloom.plans.catalog import register
from webloom.session import table

R = "regexp_replace"
#: RE2 forms of the same rules.
TIGHT = r"""regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace({0}, '\[\s+', '[', 'g'), '\s+\]', ']', 'g'), '\(\s+', '(', 'g'), '\s+\)', ')', 'g'), ':\s+', ':', 'g'), '\[(\s+)([^\]]+)(\s+)\]', '[\2]', 'g')"""
PLAIN = r"""trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(""" + TIGHT + r"""), '\[([^\]]+)\]\([^\)]+\)', '\1', 'g'), 'mailto:\s*', '', 'g'), '[^\p{{L}}\p{{N}}_\s]', '', 'g'), '\s+', ' ', 'g'))"""
COMPARABLE = "array_to_string(list_filter(string_split(" + PLAIN + ", ' '), lambda w, i: i = 1 OR w <> string_split(" + PLAIN + ", ' ')[i - 1]), ' ')"
LINES = "lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM documents)"


def _docs(spark, sf_dir):
    return table(spark, sf_dir, "documents")


def lines(spark, sf_dir):
    """(doc_id, line_no, line) of every document."""
    return _docs(spark, sf_dir).select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line")).withColumn("line_no", F.col("line_no").cast("long"))


@register("text_spacing", r"""WITH """ + LINES + r""", a AS (SELECT *, regexp_replace(regexp_replace(line, ' +', ' ', 'g'), '([a-z])([A-Z])', '\1 \2', 'g') AS x FROM lines),
  b AS (SELECT *, CASE WHEN regexp_matches(x, '\+?\d+\s*\(') THEN x ELSE regexp_replace(x, '([a-zA-Z])(\+?\d)', '\1 \2', 'g') END AS y FROM a)
  SELECT doc_id, line_no, CASE WHEN trim(line) = '' OR regexp_matches(trim(line), '^[#|\-*]') THEN line ELSE
    regexp_replace(regexp_replace(regexp_replace(y, '(\d)([A-Za-z])', '\1 \2', 'g'), '([:;])([A-Za-z])', '\1 \2', 'g'), '([a-zA-Z]):(\+?\d)', '\1: \2', 'g') END AS spaced FROM b""")
def text_spacing(spark, sf_dir):
    return lines(spark, sf_dir).select("doc_id", "line_no", X.spaced(F.col("line")).alias("spaced"))


@register("tight_links", "SELECT doc_id, " + TIGHT.format("text") + " AS tight FROM documents")
def tight_links(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", X.tight_links(F.col("text")).alias("tight"))


@register("normalize_enhanced", "WITH " + LINES + ", p AS (SELECT doc_id, line_no, string_split(" + PLAIN.format("line") + ", ' ') AS w FROM lines) SELECT doc_id, line_no, array_to_string(list_filter(w, lambda x, i: i = 1 OR x <> w[i - 1]), ' ') AS normalized FROM p")
def normalize_enhanced(spark, sf_dir):
    return lines(spark, sf_dir).select("doc_id", "line_no", X.comparable(F.col("line")).alias("normalized"))


@register("clean_text_v1", r"""SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '\s+', ' ', 'g'), '\[.*?\]', '', 'g'), '\s([?.!,;])', '\1', 'g'), '[^\x00-\x7F]+', '', 'g'), '([a-z])([A-Z])', '\1. \2', 'g') AS cleaned FROM documents""")
def clean_text_v1(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", X.cleaned_v1(F.col("text")).alias("cleaned"))


_ASCII = "regexp_replace(replace(translate(text, '" + X.ACCENTS[0] + "', '" + X.ACCENTS[1] + "'), 'ß', 'ss'), '[^\\x00-\\x7F]', '', 'g')"


@register("clean_text_v2", r"""SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(""" + _ASCII + r""", 'http\S+', '', 'g'), '\d{2}\.\d{2}\.\d{4}', '', 'g'), '\s+', ' ', 'g'), '\[.*?\]', '', 'g'), '\s([?.!,;])', '\1', 'g'), '([a-z])([A-Z])', '\1. \2', 'g')) AS cleaned FROM documents""")
def clean_text_v2(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", X.cleaned_v2(F.col("text")).alias("cleaned"))


@register("preprocess_text", "SELECT conv_id, turn, lower(trim(text)) AS prepared FROM conversations")
def preprocess_text(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.lower(F.trim("text")).alias("prepared"))


#: RE2 has no lookbehind: mark the cuts first.
SENTENCES = r"s AS (SELECT doc_id, list_filter(list_transform(string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)), lambda x: trim(x)), lambda x: x <> '') AS s FROM documents)"
WORDS = r"len(list_filter(string_split_regex(trim({0}), '\s+'), lambda w: w <> ''))"


@register("sentences", "WITH " + SENTENCES + " SELECT doc_id, len(s) AS n_sentences, list_max(list_transform(s, lambda x: length(x))) AS longest FROM s")
def sentences(spark, sf_dir):
    s = X.sentences(F.col("text"))
    return _docs(spark, sf_dir).select("doc_id", F.size(s).cast("long").alias("n_sentences"), F.array_max(F.transform(s, lambda x: F.length(x).cast("long"))).alias("longest"))


@register("sentence_length_filter", "WITH " + SENTENCES + ", e AS (SELECT doc_id, unnest(s) AS sentence FROM s) SELECT doc_id, sentence FROM e WHERE " + WORDS.format("sentence") + " > 5")
def sentence_length_filter(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", F.explode(X.sentences(F.col("text"))).alias("sentence")).where(X.word_count(F.col("sentence")) > 5)


@register("chunk_counts", "WITH " + SENTENCES + ", e AS (SELECT s.doc_id, unnest(s) AS sentence FROM s) SELECT d.source, count(*) AS n_chunks, count(DISTINCT sentence) AS n_distinct FROM e JOIN documents d USING (doc_id) WHERE " + WORDS.format("sentence") + " > 3 GROUP BY d.source")
def chunk_counts(spark, sf_dir):
    each = _docs(spark, sf_dir).select("source", F.explode(X.sentences(F.col("text"))).alias("sentence")).where(X.word_count(F.col("sentence")) > 3)
    return each.groupBy("source").agg(F.count("*").alias("n_chunks"), F.countDistinct("sentence").alias("n_distinct"))


@register("lang_filter", "SELECT doc_id, text FROM documents WHERE lang = 'en'")
def lang_filter(spark, sf_dir):
    return _docs(spark, sf_dir).where("lang = 'en'").select("doc_id", "text")


@register("tag_keyword_filter", "SELECT page_id, regexp_matches(lower(html), '" + "|".join(X.NOISE_KEYWORDS) + "') AS has_keyword FROM pages")
def tag_keyword_filter(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", X.has_keyword(F.col("html")).alias("has_keyword"))


@register("email_extract", "WITH " + LINES + r", e AS (SELECT doc_id, line_no, unnest(regexp_extract_all(line, '[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}')) AS m FROM lines) SELECT doc_id, line_no, lower(m) AS email FROM e")
def email_extract(spark, sf_dir):
    return lines(spark, sf_dir).select("doc_id", "line_no", F.explode(X.emails(F.col("line"))).alias("email"))


@register("mail_links", r"SELECT doc_id, regexp_replace(text, '([a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,})', '[\1](mailto:\1)', 'g') AS linked FROM documents WHERE contains(text, '@')")
def mail_links(spark, sf_dir):
    return _docs(spark, sf_dir).where(F.contains("text", F.lit("@"))).select("doc_id", X.with_mail_links(F.col("text")).alias("linked"))


_KEY = "lower(regexp_replace(trim(role), ':+$', ''))"


@register("label_normalize", f"SELECT DISTINCT role, CASE {' '.join(f'WHEN {_KEY} IN ({", ".join(repr(s) for s in syn)}) THEN {name!r}' for name, syn in X.LABELS.items())} ELSE upper(left({_KEY}, 1)) || substr({_KEY}, 2) END AS label FROM (SELECT role FROM conversations UNION ALL SELECT unnest(['Tel:', 'E-Mail', 'room', 'Website', 'custom:']))")
def label_normalize(spark, sf_dir):
    more = spark.createDataFrame([(x,) for x in ("Tel:", "E-Mail", "room", "Website", "custom:")], "role string")
    return table(spark, sf_dir, "conversations").select("role").union(more).distinct().select("role", X.label(F.col("role")).alias("label"))


@register("header_field_type", "SELECT page_id, CASE WHEN contains(lower(url), 'mail') THEN 'email' WHEN regexp_matches(lower(url), 'phone|tel') THEN 'phone' WHEN regexp_matches(lower(url), 'location|office|room') THEN 'location' WHEN contains(lower(url), 'name') THEN 'name' END AS field FROM pages")
def header_field_type(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", X.field_type(F.col("url")).alias("field"))


@register("empty_page_filter", r"SELECT doc_id, (length(trim(text)) < 50 OR (length(trim(text)) < 200 AND regexp_matches(lower(trim(text)), 'page could not be found|404|not found|error|page not available') AND len(list_filter(string_split_regex(trim(text), '\s+'), lambda w: length(w) > 2 AND NOT regexp_matches(w, '^(http|#)'))) < 10)) AS is_empty FROM documents")
def empty_page_filter(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", X.empty_page(F.col("text")).alias("is_empty"))


@register("fit_raw_choice", """WITH f AS (SELECT doc_id, text AS raw, CASE WHEN doc_id % 3 = 0 THEN left(text, 80) WHEN doc_id % 3 = 1 THEN left(text, length(text) // 3) ELSE text END AS fit FROM documents)
  SELECT doc_id, CASE WHEN fit = '' THEN raw WHEN raw = '' THEN fit WHEN length(trim(fit)) < 100 OR length(trim(fit)) / nullif(length(trim(raw)), 0) < 0.5
    OR (len(list_filter(string_split(raw, chr(10)), lambda x: contains(x, '|'))) >= 3 AND len(list_filter(string_split(fit, chr(10)), lambda x: contains(x, '|'))) < 3) THEN raw ELSE fit END AS chosen FROM f""")
def fit_raw_choice(spark, sf_dir):
    fit = F.when(F.col("doc_id") % 3 == 0, F.substring("text", 1, 80)).when(F.col("doc_id") % 3 == 1, F.substring(F.col("text"), F.lit(1), F.floor(F.length("text") / 3).cast("int"))).otherwise(F.col("text"))
    return _docs(spark, sf_dir).select("doc_id", F.col("text").alias("raw"), fit.alias("fit")).select("doc_id", X.fit_or_raw(F.col("fit"), F.col("raw")).alias("chosen"))


_LETTERS = r"length(regexp_replace(t, '[^\p{L}\p{N}_\s]', '', 'g'))"
_NOISE = r"""(NOT regexp_matches(t, '@|mailto:|T\.\s*\(?\d+|\(he/him\)|\(she/her\)') AND (length(t) < 5 OR len(string_split(t, '](')) - 1 > 5 OR regexp_matches(t, '^https?://')
  OR length(t) - length(replace(t, '/', '')) > 5 OR """ + _LETTERS + r""" < length(t) * 0.3 OR (NOT contains(t, ' ') AND upper(t) = t AND regexp_matches(t, '\p{L}'))
  OR (len(regexp_extract_all(t, '\b[A-Z]{2,}(?:[-_][A-Z0-9]{2,})+\b')) > 10 AND length(t) > 100)))"""


@register("noise_lines", "WITH " + LINES + ", l AS (SELECT doc_id, line_no, trim(line) AS t FROM lines) SELECT doc_id, line_no, " + _NOISE + " AS noise FROM l")
def noise_lines(spark, sf_dir):
    return lines(spark, sf_dir).select("doc_id", "line_no", X.noise_line(F.col("line")).alias("noise"))


@register("navigation_lines", "WITH " + LINES + r""" SELECT doc_id, line_no FROM lines WHERE regexp_matches(line, '(?i)(spacer|header|logo|banner)\.(gif|png|jpg)|to sort click|navigation|menu|breadcrumb')
  OR (len(regexp_extract_all(line, '\[([^\]]+)\]\([^)]+\)')) > 3 AND length(trim(line)) < 150) OR regexp_matches(trim(line), '^!\[.*?\]\([^)]+\)\s*\|?\s*$')""")
def navigation_lines(spark, sf_dir):
    return lines(spark, sf_dir).where(X.navigation_line(F.col("line"))).select("doc_id", "line_no")


@register("value_with_unit", "WITH " + LINES + r" SELECT doc_id, line_no FROM lines WHERE regexp_matches(trim(line), '(?i)^[\d\s.,]+(ns|ms|μs|μm|mm|m|GeV|keV|MeV|T|kW|h|°|%|kHz|MHz|psec|nC|mrad|pmrad|μrad)\s*$')")
def value_with_unit(spark, sf_dir):
    return lines(spark, sf_dir).where(F.trim("line").rlike(X.VALUE_WITH_UNIT)).select("doc_id", "line_no")


@register("separator_lines", "WITH " + LINES + r", l AS (SELECT doc_id, line_no, trim(line) AS t FROM lines) SELECT doc_id, line_no FROM l WHERE regexp_matches(t, '^-{3,}$') OR regexp_matches(t, '^\|[\s|\-]*-{3,}[\s|\-]*\|?$') OR (t <> '' AND regexp_matches(t, '^[|\- ]+$'))")
def separator_lines(spark, sf_dir):
    return lines(spark, sf_dir).where(X.separator_line(F.col("line"))).select("doc_id", "line_no")


@register("empty_links", r"SELECT doc_id, regexp_replace(text || ' [](x) ![](y)', '(^|[^!])\[\]\([^)]+\)', '\1', 'g') AS cleaned FROM documents")
def empty_links(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", X.empty_link_free(F.concat("text", F.lit(" [](x) ![](y)"))).alias("cleaned"))


@register("doubled_words")
def doubled_words(spark, sf_dir):
    """Back references, which RE2 lacks."""
    return _docs(spark, sf_dir).select("doc_id", X.doubled_word_free(F.col("text")).alias("cleaned"))


@register("blank_runs", "WITH " + LINES + """, g AS (SELECT *, sum(CASE WHEN trim(line) <> '' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line_no) AS island FROM lines),
  n AS (SELECT *, sum(CASE WHEN trim(line) = '' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, island ORDER BY line_no) AS blank_no FROM g)
  SELECT doc_id, line_no, line FROM n WHERE trim(line) <> '' OR blank_no <= 2""")
def blank_runs(spark, sf_dir):
    """At most two blank lines in a row. Windows are by document: no larger than its own lines."""
    blank = F.trim("line") == ""
    order = Window.partitionBy("doc_id").orderBy("line_no")
    island = lines(spark, sf_dir).withColumn("island", F.sum((~blank).cast("int")).over(order))
    numbered = island.withColumn("blank_no", F.sum(blank.cast("int")).over(Window.partitionBy("doc_id", "island").orderBy("line_no")))
    return numbered.where(~blank | (F.col("blank_no") <= 2)).select("doc_id", "line_no", "line")


@register("orphan_separators", "WITH " + LINES + r""", l AS (SELECT doc_id, line_no, trim(line) AS t FROM lines),
  m AS (SELECT *, CASE WHEN regexp_matches(t, '^\|\s*[^|]+\s*\|.*\|') THEN 1 ELSE 0 END AS is_row, (regexp_matches(t, '^-{3,}$') OR regexp_matches(t, '^\|[\s|\-]*-{3,}[\s|\-]*\|?$') OR (t <> '' AND regexp_matches(t, '^[|\- ]+$'))) AS sep FROM l),
  w AS (SELECT *, max(is_row) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) AS above, max(is_row) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN 1 FOLLOWING AND 19 FOLLOWING) AS below FROM m)
  SELECT doc_id, line_no FROM w WHERE sep AND NOT (coalesce(above, 0) = 1 AND coalesce(below, 0) = 1)""")
def orphan_separators(spark, sf_dir):
    order = Window.partitionBy("doc_id").orderBy("line_no")
    marked = lines(spark, sf_dir).select("doc_id", "line_no", F.trim("line").rlike(r"^\|\s*[^|]+\s*\|.*\|").cast("int").alias("is_row"), X.separator_line(F.col("line")).alias("sep"))
    around = marked.withColumn("above", F.max("is_row").over(order.rowsBetween(-20, -1))).withColumn("below", F.max("is_row").over(order.rowsBetween(1, 19)))
    return around.where("sep and not (coalesce(above, 0) = 1 and coalesce(below, 0) = 1)").select("doc_id", "line_no")


@register("lone_names", "WITH " + LINES + r""", l AS (SELECT doc_id, line_no, trim(line) AS t FROM lines),
  w AS (SELECT *, sum(CASE WHEN t = '' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN 1 FOLLOWING AND 9 FOLLOWING) AS blanks FROM l)
  SELECT doc_id, line_no, coalesce(blanks, 0) >= 3 AS dropped FROM w WHERE regexp_matches(t, '^\p{Lu}\S{2,}$')""")
def lone_names(spark, sf_dir):
    order = Window.partitionBy("doc_id").orderBy("line_no").rowsBetween(1, 9)
    ahead = lines(spark, sf_dir).select("doc_id", "line_no", F.trim("line").alias("t")).withColumn("blanks", F.sum((F.col("t") == "").cast("int")).over(order))
    return ahead.where(F.col("t").rlike(r"^\p{Lu}\S{2,}$")).select("doc_id", "line_no", (F.coalesce("blanks", F.lit(0)) >= 3).alias("dropped"))


@register("protected_header", "WITH " + LINES + " SELECT doc_id, line_no, line_no < 4 AS protected FROM lines")
def protected_header(spark, sf_dir):
    return lines(spark, sf_dir).select("doc_id", "line_no", (F.col("line_no") < 4).alias("protected"))


@register("indicator_counts", r"SELECT doc_id, len(regexp_extract_all(text, '@')) AS n_at, len(list_filter(string_split(text, chr(10)), lambda x: contains(x, '|'))) AS n_table_lines, len(regexp_extract_all(text, '[0-9]{4,}')) AS n_numbers FROM documents")
def indicator_counts(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", F.regexp_count("text", F.lit("@")).cast("long").alias("n_at"), X.table_lines(F.col("text")).cast("long").alias("n_table_lines"), F.regexp_count("text", F.lit("[0-9]{4,}")).cast("long").alias("n_numbers"))


@register("quality_by_rule", "WITH " + LINES + ", l AS (SELECT doc_id, trim(line) AS t FROM lines), n AS (SELECT doc_id, avg(CASE WHEN " + _NOISE + " THEN 1.0 ELSE 0.0 END) AS share FROM l GROUP BY doc_id) SELECT quality, count(*) AS n, count(*) FILTER (share > 0.5) AS rejected FROM n JOIN labels USING (doc_id) GROUP BY quality")
def quality_by_rule(spark, sf_dir):
    """The line rules' verdict beside the label."""
    share = lines(spark, sf_dir).groupBy("doc_id").agg(F.avg(X.noise_line(F.col("line")).cast("double")).alias("share"))
    return share.join(table(spark, sf_dir, "labels"), "doc_id").groupBy("quality").agg(F.count("*").alias("n"), F.count_if(F.col("share") > 0.5).alias("rejected"))


_ANSWER = """a AS (SELECT conv_id, turn, 'Context: x' || chr(10) || 'Answer: old' || chr(10) || 'Answer: ' || text || chr(10) || 'Question: q' || chr(10) || text AS response FROM conversations)"""


def _responses(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.concat(F.lit("Context: x\nAnswer: old\nAnswer: "), "text", F.lit("\nQuestion: q\n"), "text").alias("response"))


@register("answer_clean", "WITH " + _ANSWER + """, s AS (SELECT conv_id, turn, string_split(trim(string_split(response, 'Answer:')[-1]), chr(10)) AS l FROM a),
  e AS (SELECT conv_id, turn, trim(unnest(l)) AS x, generate_subscripts(l, 1) AS i FROM s),
  k AS (SELECT conv_id, turn, x, min(i) AS i FROM e WHERE NOT regexp_matches(lower(x), '^(context|question):') GROUP BY ALL)
  SELECT conv_id, turn, trim(string_agg(x, chr(10) ORDER BY i)) AS answer FROM k GROUP BY ALL""")
def answer_clean(spark, sf_dir):
    return _responses(spark, sf_dir).select("conv_id", "turn", X.answer(F.col("response")).alias("answer"))


@register("prompt_baseline", "SELECT conv_id, turn, 'Question: ' || text || chr(10) || 'Answer:' AS prompt FROM conversations WHERE role = 'user'")
def prompt_baseline(spark, sf_dir):
    return table(spark, sf_dir, "conversations").where("role = 'user'").select("conv_id", "turn", X.prompt(F.col("text")).alias("prompt"))


@register("prompt_stuff", """WITH c AS (SELECT conv_id, string_agg(text, chr(10) ORDER BY turn) AS context FROM conversations WHERE role = 'assistant' GROUP BY conv_id)
  SELECT q.conv_id, q.turn, 'Use the context to answer.' || chr(10) || 'Context: ' || c.context || chr(10) || 'Question: ' || q.text || chr(10) || 'Answer:' AS prompt FROM conversations q JOIN c USING (conv_id) WHERE q.role = 'user'""")
def prompt_stuff(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations")
    context = rows.where("role = 'assistant'").groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda x: x["text"]), "\n").alias("context"))
    return rows.where("role = 'user'").join(context, "conv_id").select("conv_id", "turn", X.prompt(F.col("text"), F.col("context")).alias("prompt"))


@register("document_preview", "SELECT doc_id, left(text, 200) AS preview, length(text) > 200 AS cut FROM documents")
def document_preview(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", F.substring("text", 1, 200).alias("preview"), (F.length("text") > 200).alias("cut"))


@register("bag_union", "SELECT doc_id AS id, text FROM documents UNION ALL SELECT item_id AS id, text FROM benchmark")
def bag_union(spark, sf_dir):
    return _docs(spark, sf_dir).select(F.col("doc_id").alias("id"), "text").unionByName(table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), "text"))


@register("token_overlap", r"SELECT doc_id, len(list_intersect(list_distinct(string_split_regex(lower(text), '\s+')), ['the', 'of', 'and', 'de', 'der'])) AS shared FROM documents")
def token_overlap(spark, sf_dir):
    common = F.array(*[F.lit(x) for x in ("the", "of", "and", "de", "der")])
    return _docs(spark, sf_dir).select("doc_id", F.size(F.array_intersect(F.split(F.lower("text"), r"\s+"), common)).cast("long").alias("shared"))
