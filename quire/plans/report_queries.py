"""Queries over reports, model answers and scans that the driver's tables are turned into, and the same in DuckDB SQL.

Reports are written as JSON files, one a source, and read back by the strict readers. Models are stand-ins whose answers follow from
the request, so that SQL can say what must come out.
"""

from __future__ import annotations

import base64
import json

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.functions import scores as S
from quire.functions import text as T
from quire.operators import adjacency, coverage, fields, review, timings, validate
from quire.plans import queries as Q
from quire.plans import assembly, scratch, tables
from quire.plans.document import Settings, too_long
from quire.sources import models, reports, scans

QUERIES, ORACLE_SQL = Q.QUERIES, Q.ORACLE_SQL
query, NUMBERED, OPINIONS, NAMES = Q.query, Q._NUMBERED, Q._OPINIONS, Q._NAMES

_JSON = {"ignoreNullFields": "false"}


def _page(**members) -> F.Column:
    return F.to_json(F.struct(*[c.alias(n) for n, c in members.items()]), _JSON)


def _files(rows: DataFrame) -> list[str]:
    """Reports of (source, page_number, page: JSON text), one file a source, pages in order, each on a line of its own: none is put together in memory."""
    first = rows.groupBy("source").agg(F.min("page_number").alias("first"))  # one row a source
    name = F.to_json(F.struct("source"))
    line = lambda part, n, value: (F.lit(part).alias("part"), n.cast("long").alias("n"), value.alias("value"))
    head = first.select("source", *line(0, F.lit(None), F.concat(F.substr(name, F.lit(1), F.length(name) - 1), F.lit(', "pages": ['))))
    comma = F.when(F.col("page_number") > F.col("first"), ",").otherwise("")
    body = rows.join(F.broadcast(first), "source").select("source", *line(1, F.col("page_number"), F.concat(comma, F.col("page"))))
    tail = first.select("source", *line(2, F.lit(None), F.lit("]}")))
    return scratch.one_file_each(head.unionByName(body).unionByName(tail), "source", "value", ["part", "n"])


_ORD = "o AS (SELECT source, row_number() OVER (ORDER BY source) - 1 AS input_ord FROM (SELECT DISTINCT source FROM documents))"

# --- page text reports -----------------------------------------------------------------------------------------------


def _ocr_pages(spark, sf_dir) -> DataFrame:
    docs = tables.numbered_documents(spark, sf_dir)
    lines = F.when(F.col("page_number") % 7 != 0, F.size(F.split("text", "\n")))
    return docs.withColumn("line_count", lines).withColumn("mean_score", (F.col("page_number") % 8) / 8.0).withColumn("duration_seconds", F.col("page_number") / 4.0)


@query(f"""WITH {NUMBERED} SELECT source, page_number, source || '#page-' || page_number AS page_ref, md5(text) AS digest,
CASE WHEN page_number % 7 <> 0 THEN len(string_split(text, chr(10))) END AS line_count, (page_number % 8) / 8.0::DOUBLE AS mean_score, page_number / 4.0::DOUBLE AS duration_seconds FROM d""")
def ocr_report_pages(spark, sf_dir):
    """Page texts with their quality, through files and the strict reader."""
    rows = _ocr_pages(spark, sf_dir)
    files = _files(rows.withColumn("page", _page(**{c: F.col(c) for c in ("page_number", "text", "line_count", "mean_score", "duration_seconds")})))
    return reports.load_ocr(spark, files).rows.select("source", "page_number", "page_ref", F.md5(F.col("text").cast("binary")).alias("digest"), "line_count", "mean_score", "duration_seconds")


@query(f"""WITH {NUMBERED}, {_ORD}, r AS (SELECT input_ord, page_number - 1 AS position, page_number % 10 AS k FROM d JOIN o USING (source))
SELECT input_ord, position, unnest(CASE k WHEN 1 THEN ['mean_score'] WHEN 3 THEN ['text'] WHEN 5 THEN ['line_count'] WHEN 7 THEN ['duration_seconds'] ELSE ['page', 'page number', 'text'] END) AS rule
FROM r WHERE k IN (1, 3, 5, 7, 9)""")
def ocr_report_violations(spark, sf_dir):
    """Members of a wrong type, and pages that are no objects, one in ten pages each."""
    k = F.col("page_number") % 10
    sound = {"page_number": F.col("page_number"), "text": F.left("text", F.lit(20)), "line_count": F.lit(1), "mean_score": F.lit(0.5), "duration_seconds": F.lit(1.5)}
    bent = {1: {"mean_score": F.lit("high")}, 3: {"text": F.lit(None).cast("string")}, 5: {"line_count": F.lit(1.5)}, 7: {"duration_seconds": F.lit(True)}}
    page = F.when(k == 9, F.lit('"a page"'))
    for n, change in bent.items():
        page = page.when(k == n, _page(**sound | change))
    files = _files(tables.numbered_documents(spark, sf_dir).withColumn("page", page.otherwise(_page(**sound))))
    return reports.load_ocr(spark, files, strict=False).violations.select("input_ord", "position", "rule")


@query(f"""WITH {NUMBERED} SELECT source || '#page-' || page_number AS page_ref, len(string_split(text, chr(10))) AS line_count, (page_number % 8) / 8.0::DOUBLE AS mean_score, page_number / 4.0::DOUBLE AS duration_seconds FROM d WHERE page_number % 7 <> 0""")
def ocr_quality_on_pages(spark, sf_dir):
    """The quality attributes go with the page as one struct."""
    rows = _ocr_pages(spark, sf_dir).where("line_count is not null")
    return rows.select(T.page_ref(F.col("source"), F.col("page_number")).alias("page_ref"), review.ocr_reference()).select("page_ref", "ocr_reference.*")


# --- classification reports --------------------------------------------------------------------------------------------


def _classification_page(**changes) -> F.Column:
    p = "probabilities"
    return _page(**{"page_number": F.col("page_number"), "page_ref": F.col("page_ref"), "category": F.col("category"), "confidence": F.col("confidence"), p: F.col(p), "needs_review": F.col("needs_review"), "review_reason": F.col("review_reason")} | changes)


@query(f"""WITH {OPINIONS} SELECT source || '#page-' || page_number AS page_ref, CASE WHEN category <> 'other' AND reason IS NULL THEN category END AS category,
CASE WHEN category <> 'other' AND reason IS NULL THEN round(confidence, 6) END AS confidence FROM t""")
def category_signals(spark, sf_dir):
    """Through classification reports: ``other`` and pages under review are no signal."""
    files = _files(Q._classified(spark, sf_dir).withColumn("page", _classification_page()))
    found = reports.category_signals(reports.load_classification(spark, files).rows)
    return found.select("page_ref", "category", F.round("confidence", 6).alias("confidence"))


@query(f"""WITH {OPINIONS}, k AS (SELECT source, row_number() OVER (ORDER BY source) - 1 AS input_ord FROM (SELECT DISTINCT source FROM q)),
r AS (SELECT input_ord, row_number() OVER (PARTITION BY source ORDER BY page_number) - 1 AS position, page_number % 9 AS k FROM q JOIN k USING (source))
SELECT input_ord, position, CASE k WHEN 1 THEN 'category' WHEN 2 THEN 'confidence' WHEN 3 THEN 'needs_review' WHEN 4 THEN 'probability keys' WHEN 5 THEN 'page_ref' WHEN 6 THEN 'probability value' ELSE 'probability keys' END AS rule
FROM r WHERE k BETWEEN 1 AND 7""")
def classification_report_violations(spark, sf_dir):
    k = F.col("page_number") % 9
    p = F.col("probabilities")
    named = lambda f: F.map_from_entries(f(F.map_entries(p)))
    texts = F.transform_values(p, lambda name, v: F.when(name == "other", F.concat(F.lit("p"), v.cast("string"))).otherwise(v.cast("string")))
    bent = {
        1: {"category": F.lit("memo")}, 2: {"confidence": F.lit(1.5)}, 3: {"needs_review": F.lit("yes")},
        4: {"probabilities": named(lambda e: F.filter(e, lambda x: x["key"] != "other"))}, 5: {"page_ref": F.lit("")}, 7: {"probabilities": F.map_concat(p, F.create_map(F.lit("memo"), F.lit(0.0)))},
    }
    # a text in the place of one probability: the others are written as numbers
    written = F.regexp_replace(_classification_page(probabilities=texts), r'":"(\d[^"]*)"', '":$1')
    page = F.when(k == 6, written)
    for n, change in bent.items():
        page = page.when(k == n, _classification_page(**change))
    files = _files(Q._classified(spark, sf_dir).withColumn("page", page.otherwise(_classification_page())))
    return reports.load_classification(spark, files, strict=False).violations.select("input_ord", "position", "rule")


@query(f"WITH {OPINIONS} SELECT source, page_number, 'The ' || replace(category, '_', ' ') AS category_label FROM q")
def category_labels(spark, sf_dir):
    """Labels come from a report's ``categories`` and are joined to pages."""
    named = json.dumps({"categories": {c: "The " + c.replace("_", " ") for c in S.CATEGORIES}})
    files = scratch.one_file_each(spark.createDataFrame([("labels", named)], "name string, value string"), "name", "value")
    return review.labelled(tables.opinions(spark, sf_dir), reports.category_labels(spark, files)).select("source", "page_number", "category_label")


# --- extraction reports ------------------------------------------------------------------------------------------------


@query(f"""WITH {NUMBERED} SELECT source || '#page-' || page_number AS page_ref, CASE WHEN page_number % 4 = 1 THEN page_number END AS printed_number FROM d""")
def printed_numbers(spark, sf_dir):
    k = F.col("page_number") % 4
    said = F.when(k == 0, F.lit(" ")).when(k == 1, F.concat(F.lit(" 0"), F.col("page_number").cast("string"))).when(k == 2, F.lit("iv"))
    rows = tables.page_numbers(spark, sf_dir).withColumn("page", _page(page_number=F.col("page_number"), page_ref=T.page_ref(F.col("source"), F.col("page_number")), extracted=F.struct(said.alias("page_number"))))
    return reports.load_printed_numbers(spark, _files(rows)).select("page_ref", "printed_number")


@query(f"""WITH {NUMBERED}, {_ORD}, r AS (SELECT input_ord, page_number - 1 AS position, page_number % 8 AS k FROM d JOIN o USING (source))
SELECT input_ord, position, CASE k WHEN 1 THEN 'page_ref' WHEN 2 THEN 'extracted' WHEN 3 THEN 'printed number' WHEN 4 THEN 'loan_number similarity' WHEN 5 THEN 'loan_number similarity' ELSE 'loan_number review flag' END AS rule FROM r WHERE k BETWEEN 1 AND 6""")
def extraction_report_violations(spark, sf_dir):
    k = F.col("page_number") % 8
    check = lambda like, flag: F.struct(F.struct(like.alias("similarity"), flag.alias("needs_review")).alias("loan_number"))
    sound = {"page_number": F.col("page_number"), "page_ref": F.lit("x"), "extracted": F.struct(F.lit("1").alias("page_number")), "verification": check(F.lit(None).cast("double"), F.lit(False))}
    bent = {
        1: {"page_ref": F.lit(None).cast("string")}, 2: {"extracted": F.lit("none")}, 3: {"extracted": F.struct(F.lit(3).alias("page_number"))}, 4: {"verification": check(F.lit(1.5), F.lit(True))},
        5: {"verification": check(F.lit("0.5"), F.lit(True))}, 6: {"verification": check(F.lit(0.5), F.lit("no"))},
    }
    page = F.when(k > 6, _page(**sound))
    for n, change in bent.items():
        page = page.when(k == n, _page(**sound | change))
    files = _files(tables.page_numbers(spark, sf_dir).withColumn("page", page.otherwise(_page(**sound))))
    rows = reports.extraction_pages(spark, files)
    return validate.violations(rows, reports.extraction_rules(), ["input_ord", "position"]).select("input_ord", "position", "rule")


@query("SELECT conv_id::VARCHAR AS page_ref, arg_max(role, turn) AS category, max(turn) AS input_ord FROM conversations GROUP BY conv_id")
def later_file_wins(spark, sf_dir):
    """Turns as files that speak of one page."""
    turns = tables.read(spark, sf_dir, "conversations").select(F.col("conv_id").cast("string").alias("page_ref"), F.col("turn").alias("input_ord"), F.col("role").alias("category"))
    return reports.later_file_wins(turns).select("page_ref", "category", "input_ord")


@query("""WITH v AS (SELECT l_orderkey, l_returnflag, list_sort(list(CASE WHEN l_linenumber % 5 = 0 THEN 0 ELSE l_linenumber END)) AS pages FROM lineitem GROUP BY ALL),
e AS (SELECT l_orderkey, CASE WHEN l_returnflag = 'A' THEN ' ' ELSE l_returnflag END AS value, CASE WHEN l_returnflag = 'R' THEN [] ELSE pages END AS pages, l_returnflag FROM v)
SELECT l_orderkey, l_returnflag, unnest(list_filter([CASE WHEN trim(value) = '' THEN 'empty value' END, CASE WHEN len(pages) = 0 THEN 'no pages' END, CASE WHEN len(list_filter(pages, lambda p: p < 1)) > 0 THEN 'page number' END], lambda x: x IS NOT NULL)) AS rule FROM e""")
def variant_list_violations(spark, sf_dir):
    """Return flags of an order as spellings, their lines as pages."""
    rows = tables.read(spark, sf_dir, "lineitem")
    page = F.when(F.col("l_linenumber") % 5 == 0, 0).otherwise(F.col("l_linenumber"))
    rows = rows.groupBy("l_orderkey", "l_returnflag").agg(F.collect_list(page).alias("pages"))
    value = F.when(F.col("l_returnflag") == "A", " ").otherwise(F.col("l_returnflag"))
    rows = rows.withColumn("value", value).withColumn("pages", F.when(F.col("l_returnflag") == "R", F.array().cast(rows.schema["pages"].dataType)).otherwise(F.col("pages")))
    return validate.violations(rows, validate.entries(), ["l_orderkey", "l_returnflag"]).select("l_orderkey", "l_returnflag", "rule")


@query("""SELECT c_custkey, unnest(list_filter([CASE WHEN c_acctbal NOT BETWEEN 0 AND 9000 THEN 'balance' END, CASE WHEN c_mktsegment NOT IN ('BUILDING', 'MACHINERY') THEN 'segment' END,
CASE WHEN c_nationkey <= 0 THEN 'nation' END], lambda x: x IS NOT NULL)) AS rule FROM customer""")
def range_and_member_violations(spark, sf_dir):
    rules = [validate.in_range("balance", "c_acctbal", 0, 9000), validate.member("segment", "c_mktsegment", ("BUILDING", "MACHINERY")), validate.positive("nation", "c_nationkey")]
    return validate.violations(tables.read(spark, sf_dir, "customer"), rules, ["c_custkey"]).select("c_custkey", "rule")


# --- page lists --------------------------------------------------------------------------------------------------------


def _refs(spark, sf_dir) -> DataFrame:
    return tables.page_numbers(spark, sf_dir).select("source", "page_number", T.page_ref(F.col("source"), F.col("page_number")).alias("page_ref"))


@query(f"""WITH {NUMBERED} SELECT source, page_number, 'missing' AS problem FROM d WHERE page_number % 9 = 0
UNION ALL SELECT source, page_number + 100000, 'extra' FROM d WHERE page_number % 17 = 0 UNION ALL SELECT source, page_number, 'page_ref' FROM d WHERE page_number % 13 = 0 AND page_number % 9 <> 0""")
def page_list_agreement(spark, sf_dir):
    left = _refs(spark, sf_dir)
    changed = F.when(F.col("page_number") % 13 == 0, F.concat("page_ref", F.lit("x"))).otherwise(F.col("page_ref")).alias("page_ref")
    right = left.where("page_number % 9 <> 0").select("source", "page_number", changed)
    more = left.where("page_number % 17 = 0").select("source", (F.col("page_number") + 100000).alias("page_number"), "page_ref")
    return coverage.page_lists_differ(left, right.unionByName(more))


@query(f"""WITH {NUMBERED} SELECT source, page_number, 'missing' AS problem FROM d WHERE page_number % 3 <> 0 AND page_number % 5 = 0
UNION ALL SELECT source, page_number + 100000, 'extra' FROM d WHERE page_number % 17 = 0""")
def auxiliary_coverage(spark, sf_dir):
    """Pages without text (every third) may be left out of an auxiliary report, others may not."""
    pages = _refs(spark, sf_dir).withColumn("has_text", F.col("page_number") % 3 != 0)
    more = pages.where("page_number % 17 = 0").withColumn("page_number", F.col("page_number") + 100000)
    return coverage.auxiliary_coverage(pages, pages.where("page_number % 5 <> 0").unionByName(more))


@query(f"""WITH {NUMBERED}, n AS (SELECT source, count(*) AS n, row_number() OVER (ORDER BY source) AS k FROM d GROUP BY source)
SELECT source, n AS left_n, CASE k % 3 WHEN 0 THEN n - 1 WHEN 1 THEN n END AS right_n FROM n WHERE k % 3 <> 1""")
def page_count_pairing(spark, sf_dir):
    """One source in three lacks its first page on the other side, one is not there."""
    left = _refs(spark, sf_dir)
    names = left.select("source").distinct().withColumn("k", F.row_number().over(Window.orderBy("source")) % 3)  # one row a source
    right = left.join(names, "source").where("k = 1 or (k = 0 and page_number > 1)")
    return coverage.page_counts_differ(left, right).select("source", "left_n", "right_n")


@query(f"""WITH {NUMBERED}, g AS (SELECT source, page_number, (page_number - 1) // 3 AS k FROM d)
SELECT source, page_number, 'missing' AS problem FROM g WHERE k % 5 = 0 UNION ALL SELECT source, page_number, 'twice' FROM g WHERE k % 7 = 0 AND k % 5 <> 0
UNION ALL SELECT source, 100000 + k, 'extra' FROM (SELECT DISTINCT source, k FROM g WHERE k % 11 = 0 AND k % 5 <> 0)
UNION ALL SELECT source, 100000 + k, 'twice' FROM (SELECT DISTINCT source, k FROM g WHERE k % 11 = 0 AND k % 5 <> 0 AND k % 7 = 0)""")
def document_cover_violations(spark, sf_dir):
    """Documents of three pages each, some left out, some twice, some with a page that is none."""
    pages = tables.page_numbers(spark, sf_dir)
    k = F.floor((F.col("page_number") - 1) / 3)
    docs = pages.groupBy("source", k.alias("k")).agg(F.collect_list(F.col("page_number").cast("long")).alias("pages"))
    docs = docs.withColumn("pages", F.when(F.col("k") % 11 == 0, F.array_append("pages", F.col("k") + 100000)).otherwise(F.col("pages"))).where("k % 5 <> 0")
    return adjacency.cover_violations(pages, docs.unionByName(docs.where("k % 7 = 0")))


@query(Q._EDGES.replace(f"embedding < {tables.MIN_EMBEDDING} AS blocked", "embedding < 0.1 AS blocked").join(["WITH ", " SELECT source, page_number, round(embedding, 6) AS embedding, blocked FROM e"]))
def gated_edges(spark, sf_dir):
    """Vectors that are too different block an edge."""
    return adjacency.edges(tables.pages(spark, sf_dir), min_embedding=0.1).select("source", "page_number", F.round("embedding", 6).alias("embedding"), "blocked")


@query(f"WITH {NUMBERED} SELECT source, page_number, len(text) AS n FROM d WHERE len(text) > 4000 AND regexp_matches(text, '\\S')")
def too_long_pages(spark, sf_dir):
    return too_long(tables.numbered_documents(spark, sf_dir), 4000).select("source", "page_number", F.length("text").alias("n"))


# --- reviews -----------------------------------------------------------------------------------------------------------


@query(f"""WITH {OPINIONS} SELECT source, page_number, CASE WHEN page_number % 6 <> 0 THEN category END AS category, CASE WHEN page_number % 6 = 0 THEN 'empty text' ELSE reason END AS review_reason,
page_number % 6 = 0 OR reason IS NOT NULL AS needs_review FROM t""")
def blank_page_review(spark, sf_dir):
    """Every sixth page has only white space: no category, and a flag."""
    blank = F.when(F.col("page_number") % 6 == 0, F.lit(" \t \n")).otherwise(F.lit("a page"))
    return review.classified(tables.opinions(spark, sf_dir).withColumn("text", blank)).select("source", "page_number", "category", "review_reason", "needs_review")


@query(f"""WITH {OPINIONS}, u AS (SELECT source, page_number % 6 <> 0 AS asked, page_number * 3 AS i, page_number % 7 AS o, page_number / 8.0::DOUBLE AS s FROM q)
SELECT source, count(*) FILTER (asked) AS requests, coalesce(sum(i) FILTER (asked), 0)::BIGINT AS input_tokens, coalesce(sum(o) FILTER (asked), 0)::BIGINT AS output_tokens,
round(coalesce(sum(s) FILTER (asked), 0), 3) AS classify_seconds, round(sum(s) FILTER (asked) / nullif(count(*) FILTER (asked), 0), 3) AS avg_classify_seconds_per_page FROM u GROUP BY source""")
def token_usage(spark, sf_dir):
    rows = tables.opinions(spark, sf_dir).withColumn("category", F.when(F.col("page_number") % 6 != 0, F.col("category")))
    spent = rows.withColumn("input_tokens", F.col("page_number") * 3).withColumn("output_tokens", F.col("page_number") % 7).withColumn("seconds", F.col("page_number") / 8.0)
    return review.token_usage(spent)


@query(f"""WITH {NUMBERED} SELECT source, page_number, page_number / 4.0::DOUBLE AS ocr_seconds, coalesce(CASE WHEN page_number % 5 <> 0 THEN page_number / 8.0 END, 0)::DOUBLE AS classification_seconds, 0.5::DOUBLE AS vlm_seconds,
(page_number / 4.0 + coalesce(CASE WHEN page_number % 5 <> 0 THEN page_number / 8.0 END, 0) + 0.5)::DOUBLE AS total_seconds FROM d WHERE page_number % 7 <> 0""")
def page_timings(spark, sf_dir):
    pages = tables.page_numbers(spark, sf_dir)
    n = F.col("page_number")
    return timings.page_timings(pages.withColumn("seconds", n / 4.0), pages.withColumn("seconds", F.when(n % 5 != 0, n / 8.0)), pages.where("page_number % 7 <> 0").withColumn("seconds", F.lit(0.5)))


@query("""SELECT c_nationkey::VARCHAR AS source, string_agg(lower(c_mktsegment) || '=' || n, ',' ORDER BY lower(c_mktsegment)) AS stages, sum(n)::DOUBLE AS total_seconds
FROM (SELECT c_nationkey, c_mktsegment, count(*) AS n FROM customer GROUP BY ALL) GROUP BY c_nationkey""")
def stage_timings(spark, sf_dir):
    rows = tables.read(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").cast("string").alias("source"), F.lower("c_mktsegment").alias("stage")).agg(F.count("*").cast("double").alias("seconds"))
    listed = F.array_join(F.transform(F.map_entries("stages_seconds"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("long").cast("string"))), ",")
    return timings.stage_timings(rows).select("source", listed.alias("stages"), "total_seconds")


# --- text --------------------------------------------------------------------------------------------------------------


@query(r"SELECT doc_id, CASE WHEN len(s) > 60 THEN s[1:60] || '...' ELSE s END AS preview FROM (SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS s FROM documents)")
def text_previews(spark, sf_dir):
    return tables.read(spark, sf_dir, "documents").select("doc_id", T.preview(F.col("text"), 60).alias("preview"))


@query(r"SELECT doc_id, len(regexp_replace(text, '[\x00-\x7F]', '', 'g')) AS other_letters, len(regexp_replace(text, '[^\[\]]', '', 'g')) AS brackets FROM documents")
def character_counts(spark, sf_dir):
    return tables.read(spark, sf_dir, "documents").select("doc_id", T.non_ascii_count(F.col("text")).alias("other_letters"), T.bracket_count(F.col("text")).alias("brackets"))


@query(f"SELECT p_partkey, {Q._NORMAL.format("p_brand || ' / ' || p_size")} AS form FROM part")
def page_number_form(spark, sf_dir):
    said = F.concat_ws(" / ", "p_brand", F.col("p_size").cast("string"))
    return tables.read(spark, sf_dir, "part").select("p_partkey", T.canonical(F.lit("page_number"), said).alias("form"))


@query(f"""WITH k AS (SELECT s_suppkey, {Q._NORMAL.format("replace(s_name, '#', ' unit ')")} AS a, {Q._NORMAL.format("s_name")} AS n FROM supplier)
SELECT s_suppkey, CASE WHEN a <> replace(a, ' ', '') THEN a || '|' || replace(a, ' ', '') ELSE a END AS address_keys, list_aggregate(list_sort(string_split(n, ' ')), 'string_agg', ' ') AS name_keys FROM k""")
def cluster_keys(spark, sf_dir):
    of = lambda f: F.array_join(T.cluster_keys(F.lit(f), F.col("s_name")), "|")
    return tables.read(spark, sf_dir, "supplier").select("s_suppkey", of("property_address").alias("address_keys"), of("borrower_name").alias("name_keys"))


#: Names in several alphabets and what the definition makes of them.
ALPHABETS = [
    ("Андрей Ёлкин", "андреи елкин"), ("ＦＵＬＬ　Ｗｉｄｔｈ １２", "full width 12"), ("ﬁnal ﬂow", "final flow"), ("ΟΔΥΣΣΕΥΣ", "οδυσσευσ"), ("Łódź—Čapek", "łodz capek"),
    ("Straße № 5", "strasse no 5"), ("été", "ete"), ("Işık İZMİR", "isık izmir"), ("½ unit", "1 2 unit"), ("한국", "한국"),
]


@query("SELECT id::BIGINT AS id, value AS form FROM (VALUES " + ", ".join(f"({i}, '{want}')" for i, (_, want) in enumerate(ALPHABETS)) + ") AS t(id, value)")
def normalize_alphabets(spark, sf_dir):
    import unicodedata

    rows = spark.createDataFrame([(i, given, i == 9) for i, (given, _) in enumerate(ALPHABETS)], "id long, given string, composed boolean")
    # Hangul decomposes into letters of their own, which are composed again to be compared
    composed = F.udf(lambda s: unicodedata.normalize("NFC", s))
    return rows.select("id", F.when(F.col("composed"), composed(T.normalize(F.col("given")))).otherwise(T.normalize(F.col("given"))).alias("form"))


@query(f"""WITH {Q._FIELDS}, x AS (SELECT source, page_number, field, CASE page_number % 6 WHEN 0 THEN 'missing' WHEN 1 THEN 'mismatch' ELSE 'ok' END AS status, needs_review FROM n),
p AS (SELECT source, page_number, bool_or(status = 'mismatch') AS wrong, bool_or(needs_review) AS flagged, count(*) FILTER (status = 'mismatch') AS m, count(*) FILTER (status = 'missing') AS l, count(*) FILTER (needs_review) AS f FROM x GROUP BY ALL)
SELECT source, count(*) AS page_count, coalesce(string_agg(page_number::VARCHAR, ',' ORDER BY page_number) FILTER (wrong), '') AS pages_with_mismatch, coalesce(string_agg(page_number::VARCHAR, ',' ORDER BY page_number) FILTER (flagged), '') AS pages_with_review_flag,
count(*) FILTER (wrong OR flagged) AS needs_review_page_count, sum(m)::BIGINT AS field_mismatch_count, sum(l)::BIGINT AS field_missing_count, sum(f)::BIGINT AS review_flag_count FROM p GROUP BY source""")
def extraction_summary(spark, sf_dir):
    k = F.col("page_number") % 6
    rows = tables.fields(spark, sf_dir).withColumn("status", F.when(k == 0, F.lit("missing")).when(k == 1, F.lit("mismatch")).otherwise(F.lit("ok")))
    return fields.extraction_summary(rows).withColumn("pages_with_mismatch", Q._joined("pages_with_mismatch")).withColumn("pages_with_review_flag", Q._joined("pages_with_review_flag"))


# --- models and scans, with stand-ins that answer from the request ---------------------------------------------------------


def classifier_stand_in(url: str, payload: dict, timeout: float) -> dict:
    n = len(payload["state"])
    shares = {c: 0.5 if i == n % 6 else 0.1 for i, c in enumerate(S.CATEGORIES)}
    answer = {"type": "choice", "choice": S.CATEGORIES[n % 6], "confidence": 0.25 + n % 4 / 8, "probabilities": shares}
    return {"answers": {"page_category": answer}, "usage": {"input_tokens": n, "output_tokens": 1}}


def verifier_stand_in(url: str, payload: dict, timeout: float) -> dict:
    n = len(payload["messages"][1]["content"])
    said = "```json\n" + json.dumps({"category": S.CATEGORIES[n % 5]}) + "\n```"
    message = {"content": "", "reasoning_content": said} if n % 3 == 0 else {"content": said}
    return {"choices": [{"message": message, "finish_reason": "length" if n % 7 == 0 else "stop"}]}


def extractor_stand_in(url: str, payload: dict, timeout: float) -> dict:
    image = payload["messages"][1]["content"][0]["image_url"]["url"].split(",", 1)[1]
    n = len(base64.b64decode(image))
    found = {"borrower_name": f" Name {n % 9} ", "property_address": None, "loan_number": str(n), "page_number": " "}
    return {"choices": [{"message": {"content": "Here it is: " + json.dumps(found) + " Done."}, "finish_reason": "stop"}]}


def embedder_stand_in(url: str, payload: dict, timeout: float) -> dict:
    return {"data": [{"index": i, "embedding": [float(len(t)), 1.0]} for i, t in reversed(list(enumerate(payload["input"])))]}


def _model(transport, **more) -> models.Model:
    return models.Model("http://stand-in", "stand-in", transport, **more)


@query(f"""WITH {NUMBERED} SELECT source, page_number, {NAMES}[len(text) % 6 + 1] AS category, (0.25 + len(text) % 4 / 8.0)::DOUBLE AS confidence, 0.4::DOUBLE AS margin, len(text) AS input_tokens, 1::BIGINT AS output_tokens FROM d WHERE regexp_matches(text, '\\S')""")
def classify_pages(spark, sf_dir):
    """The request and the checked answer of each page with text."""
    pages = tables.numbered_documents(spark, sf_dir).select("source", "page_number", "text")
    out = models.classify(pages.where(T.has_text(F.col("text"))), _model(classifier_stand_in))
    return out.select("source", "page_number", "category", "confidence", F.round(S.margin(F.col("probabilities")), 6).alias("margin"), "input_tokens", "output_tokens")


@query(f"""WITH {NUMBERED} SELECT source, page_number, CASE WHEN len(text) % 7 <> 0 THEN {NAMES}[len(text) % 5 + 1] END AS verifier_category, len(text) % 7 = 0 AS failed FROM d""")
def verify_pages(spark, sf_dir):
    """Answers in fences or in the reasoning; cut-off answers are recorded."""
    pages = tables.numbered_documents(spark, sf_dir).select("source", "page_number", "text")
    return models.verify(pages, _model(verifier_stand_in, on_error="record")).select("source", "page_number", "verifier_category", F.col("error").isNotNull().alias("failed"))


@query(f"WITH {NUMBERED} SELECT source, page_number, 'Name ' || strlen(text) % 9 AS borrower_name, NULL::VARCHAR AS property_address, strlen(text)::VARCHAR AS loan_number, NULL::VARCHAR AS page_label FROM d")
def extract_pages(spark, sf_dir):
    images = tables.numbered_documents(spark, sf_dir).select("source", "page_number", F.col("text").cast("binary").alias("image"))
    out = models.extract(images, _model(extractor_stand_in))
    return out.select("source", "page_number", "extracted.borrower_name", "extracted.property_address", "extracted.loan_number", F.col("extracted.page_number").alias("page_label"))


@query(rf"WITH {NUMBERED} SELECT source, page_number, (10 + len(trim(regexp_replace(text, '\s+', ' ', 'g'))))::DOUBLE AS length, 1.0::DOUBLE AS one FROM d")
def embed_pages(spark, sf_dir):
    """Batches of texts with their prefix; answers come in another order and are put back by index."""
    pages = tables.numbered_documents(spark, sf_dir).select("source", "page_number", "text")
    return models.embed(pages, _model(embedder_stand_in)).select("source", "page_number", F.get("vector", F.lit(0)).alias("length"), F.get("vector", F.lit(1)).alias("one"))


# --- reports put together ----------------------------------------------------------------------------------------------


def _said(reports_: DataFrame, **paths: str) -> DataFrame:
    """Members of each report's JSON text, as texts."""
    told = F.to_json("report", assembly.JSON_OPTIONS)
    return reports_.select("source", *[F.get_json_object(told, path).alias(name) for name, path in paths.items()])


def _spent(rows: DataFrame) -> DataFrame:
    n = F.col("page_number")
    return rows.withColumn("input_tokens", n * 3).withColumn("output_tokens", n % 7).withColumn("classify_seconds", n / 8.0)


@query(f"""WITH {OPINIONS}, f AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY page_number) AS k FROM t)
SELECT source, count(*)::VARCHAR AS pages, count(reason)::VARCHAR AS review_pages, count(*) FILTER (category = 'other')::VARCHAR AS others, sum(page_number * 3)::BIGINT::VARCHAR AS input_tokens,
source || '#page-' || min(page_number) AS first_ref, any_value(category) FILTER (k = 1) AS first_category, any_value(reason) FILTER (k = 1) AS first_reason, '30000' AS max_state_chars FROM f GROUP BY source""")
def classification_reports(spark, sf_dir):
    found = assembly.classification_report(_spent(Q._classified(spark, sf_dir)), _model(classifier_stand_in), Settings())
    return _said(
        found, pages="$.summary.page_count", review_pages="$.summary.needs_review_page_count", others="$.summary.category_counts.other", input_tokens="$.usage.input_tokens",
        first_ref="$.pages[0].page_ref", first_category="$.pages[0].category", first_reason="$.pages[0].review_reason", max_state_chars="$.parameters.max_state_chars",
    )


@query(f"""WITH {OPINIONS} SELECT source, count(*) FILTER (triggered)::VARCHAR AS requests, count(*) FILTER (resolution = 'verifier_failed')::VARCHAR AS failed,
arg_min(resolution, page_number) AS first_resolution, CASE WHEN arg_min(triggered AND page_number % 10 <> 0, page_number) THEN arg_min(second, page_number) END AS first_second FROM z GROUP BY source""")
def verification_reports(spark, sf_dir):
    reviewed = _spent(Q._verified(spark, sf_dir)).withColumn("verifier_seconds", F.when(F.col("triggered"), F.lit(0.5)))
    found = assembly.verification_report(reviewed, _model(verifier_stand_in), Settings())
    return _said(found, requests="$.timings.requests", failed="$.summary.verifier_failed_page_count", first_resolution="$.pages[0].verification.resolution", first_second="$.pages[0].verification.verifier_category")


@query(f"""WITH {Q._GROUPS}, n AS (SELECT source, size, pages, lo, row_number() OVER (PARTITION BY source ORDER BY first_page) AS k FROM g WHERE size > 1),
f AS (SELECT source, size, pages, lo FROM n WHERE k = 1), u AS (SELECT source, count(*) AS u FROM g WHERE size = 1 GROUP BY source), sk AS (SELECT source, count(*) AS s FROM p WHERE e IS NULL GROUP BY source)
SELECT o.source, coalesce(m, 0)::INT AS groups, f.size AS first_size, array_to_string(list_transform(string_split(f.pages, ','), lambda x: o.source || '#page-' || x), ',') AS first_refs, round(f.lo, 6) AS first_min,
coalesce(u.u, 0)::INT AS single, coalesce(sk.s, 0)::INT AS skipped FROM (SELECT DISTINCT source FROM p) o LEFT JOIN (SELECT source, count(*) AS m FROM n GROUP BY source) c USING (source) LEFT JOIN f USING (source) LEFT JOIN u USING (source) LEFT JOIN sk USING (source)""")
def match_reports(spark, sf_dir):
    pages, members = Q._members(spark, sf_dir)
    vectors = pages.where("vector is not null").select("source", "page_number", F.lit(1).alias("request"), F.lit(0.25).alias("seconds"))
    found = assembly.match_report(pages, adjacency.edges(pages, min_embedding=tables.MIN_EMBEDDING), members, vectors, Settings(min_embedding=tables.MIN_EMBEDDING, edge_threshold=tables.EDGE_THRESHOLD))
    first = F.get("report.groups", F.lit(0))
    return found.select(
        "source", F.size("report.groups").alias("groups"), first["size"].alias("first_size"), F.array_join(first["page_refs"], ",").alias("first_refs"),
        first["min_combined_similarity"].alias("first_min"), F.size("report.unique_pages").alias("single"), F.size("report.skipped_pages").alias("skipped"),
    )


@query(f"""WITH {Q._FIELDS}, b AS (SELECT source, field, value, row_number() OVER (PARTITION BY source, field ORDER BY rank, pick) AS k FROM best JOIN r USING (source, field, canonical))
SELECT source, max(value) FILTER (field = 'loan_number') AS loan_number, max(value) FILTER (field = 'borrower_name') AS borrower_name, '1.75' AS total_seconds FROM b WHERE k = 1 GROUP BY source""")
def result_reports(spark, sf_dir):
    rows = tables.fields(spark, sf_dir).withColumn("status", F.lit("ok"))
    loans = fields.loan_fields(fields.cluster_exact(fields.entries(rows)), rows)
    labels = rows.select("source", "page_number").distinct().select("source", "page_number", F.lit("other").alias("label"), F.lit(0.5).alias("confidence"), F.lit("").alias("notes"))
    docs = labels.groupBy("source").agg(F.min("page_number").alias("first_page"), F.array_sort(F.collect_list("page_number")).alias("pages")).withColumn("label", F.lit("other"))
    found = assembly.result_report(labels, docs, loans, {"ocr": 1.5, "match": 0.25})
    return _said(found, loan_number="$.loan_level_fields.loan_number.value", borrower_name="$.loan_level_fields.borrower_name.value", total_seconds="$.timings.total_seconds")


def _renderer():
    def render(content: bytes, dpi: int):
        if not content:
            raise ValueError("no pages")
        lines = content.decode().split("\n")
        for i in range(0, len(lines), 4):
            yield i // 4 + 1, "\n".join(lines[i : i + 4]).encode()

    return render


def _engine():
    return lambda image: [(line, len(line) % 8 / 8) for line in image.decode().split("\n") if line]


@query("""WITH l AS (SELECT 'doc' || doc_id AS source, string_split(text, chr(10)) AS a FROM documents WHERE text <> ''),
p AS (SELECT source, a, unnest(range(1, (len(a) + 3) // 4 + 1)) AS page_number FROM l), x AS (SELECT source, page_number, list_filter(a[page_number * 4 - 3:page_number * 4], lambda s: s <> '') AS x FROM p)
SELECT source, page_number::INT AS page_number, md5(array_to_string(x, chr(10))) AS digest, len(x)::INT AS line_count, CASE WHEN len(x) > 0 THEN list_sum(list_transform(x, lambda s: len(s) % 8 / 8.0::DOUBLE)) / len(x) END AS mean_score, NULL::VARCHAR AS error FROM x
UNION ALL SELECT 'doc' || doc_id, NULL, NULL, NULL, NULL, 'ValueError: no pages' FROM documents WHERE text = ''""")
def scan_pages(spark, sf_dir):
    """Files to page images to lines; a file that fails is recorded."""
    files = tables.read(spark, sf_dir, "documents").select(F.concat(F.lit("doc"), F.col("doc_id").cast("string")).alias("source"), F.col("text").cast("binary").alias("content"))
    out = scans.recognise(scans.render_pages(files, _renderer, on_error="record"), _engine)
    return out.select("source", "page_number", F.md5(F.col("text").cast("binary")).alias("digest"), "line_count", "mean_score", "error")
