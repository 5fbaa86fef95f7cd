"""One query for each operator of the document engine, over the driver's tables, and the same in DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import scores as S
from quire.functions import text as T
from quire.operators import adjacency, coverage, fields, review, validate
from quire.plans import tables

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def _joined(column: str, by: str = ",") -> F.Column:
    return F.array_join(F.transform(column, lambda x: x.cast("string")), by)


# --- neighbouring pages -----------------------------------------------------------------------------------------

_NUMBERED = "d AS (SELECT source, doc_id, lang, text, n_chars, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS page_number FROM documents)"


def _share(first: int) -> str:
    parts = [f"exp(8 * e[{i}]::DOUBLE)" for i in range(first + 1, first + 7)]
    total = " + ".join(parts)
    return "[" + ", ".join(f"{p} / ({total})" for p in parts) + "]"


_PAGES = f"""{_NUMBERED},
p AS (SELECT d.source, page_number, v.embedding AS e, lang AS category,
  CASE WHEN v.vec_id IS NOT NULL THEN (SELECT list_max(x) FROM (SELECT {_share(0).replace("e[", "v.embedding[")} AS x)) END AS confidence,
  CASE WHEN l.doc_id IS NOT NULL THEN page_number END AS printed
  FROM d LEFT JOIN embeddings v ON v.vec_id = d.doc_id LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON l.doc_id = d.doc_id)"""
_EDGES = f"""{_PAGES},
s AS (SELECT b.source, b.page_number,
  greatest(0, least(1, list_cosine_similarity(a.e::DOUBLE[], b.e::DOUBLE[]))) AS embedding,
  CASE WHEN a.category IS NULL OR b.category IS NULL THEN NULL WHEN a.category <> b.category THEN 0 ELSE least(a.confidence, b.confidence) END AS category,
  CASE WHEN b.printed = a.printed + 1 THEN 1.0 WHEN b.printed = a.printed THEN 0.5 END AS page_number_seq
  FROM p b JOIN p a ON a.source = b.source AND b.page_number = a.page_number + 1 WHERE a.e IS NOT NULL AND b.e IS NOT NULL),
w AS (SELECT *, 0.6::DOUBLE + CASE WHEN category IS NULL THEN 0 ELSE 0.25 END + CASE WHEN page_number_seq IS NULL THEN 0 ELSE 0.15 END AS available_weight FROM s),
e AS (SELECT *, (0.6 * embedding + coalesce(0.25 * category, 0) + coalesce(0.15 * page_number_seq, 0)) / available_weight AS combined,
  embedding < {tables.MIN_EMBEDDING} AS blocked FROM w)"""
_GROUPS = f"""{_EDGES},
m AS (SELECT p.source, p.page_number, CASE WHEN NOT blocked AND combined >= {tables.EDGE_THRESHOLD} THEN combined END AS c
  FROM p LEFT JOIN e ON e.source = p.source AND e.page_number = p.page_number WHERE p.e IS NOT NULL),
i AS (SELECT *, sum(CASE WHEN c IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY source ORDER BY page_number) AS seq FROM m),
g AS (SELECT source, seq, count(*) AS size, min(page_number) AS first_page, string_agg(page_number::VARCHAR, ',' ORDER BY page_number) AS pages,
  coalesce(min(c), 1) AS lo, coalesce(avg(c), 1) AS mean FROM i GROUP BY source, seq)"""


def _edges(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    pages = tables.pages(spark, sf_dir)
    return pages, adjacency.edges(pages, min_embedding=tables.MIN_EMBEDDING)


def _members(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    pages, edges = _edges(spark, sf_dir)
    return pages, adjacency.islands(pages, edges, tables.EDGE_THRESHOLD)


_ROUNDED = "round(embedding, 6) AS embedding, round(category, 6) AS category, page_number_seq::DOUBLE AS page_number_seq, round(available_weight, 6) AS available_weight, round(combined, 6) AS combined, blocked"


@query(f"WITH {_EDGES} SELECT source, page_number, {_ROUNDED} FROM e")
def page_edges(spark, sf_dir):
    rounded = [F.round(c, 6).alias(c) for c in ("embedding", "category", "page_number_seq", "available_weight", "combined")]
    return _edges(spark, sf_dir)[1].select("source", "page_number", *rounded, "blocked")


_ONLY_VECTORS = _EDGES.replace("b.category IS NULL THEN NULL", "true THEN NULL").replace("WHEN b.printed = a.printed + 1 THEN 1.0 WHEN b.printed = a.printed THEN 0.5", "WHEN false THEN 1.0")


@query(f"WITH {_ONLY_VECTORS} SELECT source, page_number, {_ROUNDED} FROM e")
def optional_signal_edges(spark, sf_dir):
    """Without the optional signals the weights of the vector alone are scaled up."""
    pages = tables.pages(spark, sf_dir).withColumn("category", F.lit(None).cast("string")).withColumn("printed_number", F.lit(None).cast("long"))
    rounded = [F.round(c, 6).alias(c) for c in ("embedding", "category", "page_number_seq", "available_weight", "combined")]
    return adjacency.edges(pages, min_embedding=tables.MIN_EMBEDDING).select("source", "page_number", *rounded, "blocked")


@query(f"WITH {_GROUPS} SELECT source, first_page, size, pages, source || '#page-' || first_page AS representative, round(lo, 6) AS min_combined, round(mean, 6) AS mean_combined FROM g")
def page_groups(spark, sf_dir):
    grouped = adjacency.groups(_members(spark, sf_dir)[1])
    return grouped.select("source", "first_page", "size", _joined("pages").alias("pages"), "representative", F.round("min_combined", 6).alias("min_combined"), F.round("mean_combined", 6).alias("mean_combined"))


@query(f"WITH {_GROUPS} SELECT source, row_number() OVER (PARTITION BY source ORDER BY first_page) AS group_id, size, pages FROM g WHERE size > 1")
def multi_page_groups(spark, sf_dir):
    return adjacency.numbered_groups(adjacency.groups(_members(spark, sf_dir)[1])).select("source", "group_id", "size", _joined("pages").alias("pages"))


@query(f"WITH {_GROUPS} SELECT source, first_page AS page_number FROM g WHERE size = 1")
def unique_pages(spark, sf_dir):
    return adjacency.groups(_members(spark, sf_dir)[1]).where("size = 1").select("source", F.col("first_page").alias("page_number"))


@query(f"""WITH {_GROUPS}, r AS (SELECT source, count(*) FILTER (size > 1) AS group_count, coalesce(sum(size) FILTER (size > 1), 0)::BIGINT AS grouped_page_count,
  count(*) FILTER (size = 1) AS unique_page_count FROM g GROUP BY source)
SELECT p.source, count(*) AS page_count, count(p.e) AS embedded_page_count, count(*) - count(p.e) AS skipped_page_count,
  coalesce(any_value(group_count), 0) AS group_count, coalesce(any_value(grouped_page_count), 0) AS grouped_page_count, coalesce(any_value(unique_page_count), 0) AS unique_page_count
FROM p LEFT JOIN r ON r.source = p.source GROUP BY p.source""")
def match_summary(spark, sf_dir):
    pages, members = _members(spark, sf_dir)
    return adjacency.match_summary(pages, adjacency.groups(members))


_MAJORITY = "(SELECT conv_id, role AS label, row_number() OVER (PARTITION BY conv_id ORDER BY count(*) DESC, min(turn)) AS r FROM conversations GROUP BY conv_id, role)"


@query(f"SELECT conv_id, label FROM {_MAJORITY} WHERE r = 1")
def majority_label(spark, sf_dir):
    turns = tables.read(spark, sf_dir, "conversations").select("conv_id", F.col("role").alias("label"), F.col("turn").alias("page_number"))
    return adjacency.majority_label(turns, ["conv_id"])


@query(f"""WITH {_GROUPS}, t AS (SELECT source, page_number, seq FROM i UNION ALL SELECT source, page_number, -page_number FROM p WHERE e IS NULL),
n AS (SELECT t.*, coalesce(p.category, 'other') AS label FROM t JOIN p USING (source, page_number)),
b AS (SELECT source, seq, label, row_number() OVER (PARTITION BY source, seq ORDER BY count(*) DESC, min(page_number)) AS r FROM n GROUP BY source, seq, label),
a AS (SELECT source, seq, min(page_number) AS first_page, string_agg(page_number::VARCHAR, ',' ORDER BY page_number) AS pages FROM n GROUP BY source, seq)
SELECT source, first_page, pages, label FROM a JOIN b USING (source, seq) WHERE r = 1""")
def document_list(spark, sf_dir):
    pages, members = _members(spark, sf_dir)
    labels = pages.select("source", "page_number", F.coalesce("category", F.lit(S.OTHER)).alias("label"))
    return adjacency.documents(pages, members, labels).select("source", "first_page", _joined("pages").alias("pages"), "label")


# --- labels and second opinions -----------------------------------------------------------------------------------

_NAMES = "[" + ", ".join(f"'{c}'" for c in S.CATEGORIES) + "]"
_OPINIONS = f"""{_NUMBERED},
o AS (SELECT d.source, d.page_number, {_share(0).replace("e[", "v.embedding[")} AS x, {_share(6).replace("e[", "v.embedding[")} AS y FROM d JOIN embeddings v ON v.vec_id = d.doc_id),
q AS (SELECT source, page_number, x, list_max(x) AS confidence, {_NAMES}[list_position(x, list_max(x))] AS category, {_NAMES}[list_position(y, list_max(y))] AS second,
  list_sort(x, 'DESC')[1] - list_sort(x, 'DESC')[2] AS gap FROM o),
t AS (SELECT *, confidence < 0.5 OR gap < 0.5 AS triggered, CASE WHEN confidence < 0.5 THEN 'low confidence' WHEN category = 'other' THEN 'other' END AS reason FROM q),
z AS (SELECT *, CASE WHEN NOT triggered THEN 'not_triggered' WHEN page_number % 10 = 0 THEN 'verifier_failed' WHEN category <> second THEN 'disagreement' WHEN category = 'other' THEN 'mutual_other' ELSE 'accepted' END AS resolution FROM t)"""


def _classified(spark, sf_dir) -> DataFrame:
    return review.classified(tables.opinions(spark, sf_dir).withColumn("text", F.lit("a page")))


def _verified(spark, sf_dir) -> DataFrame:
    def ask(rows: DataFrame) -> DataFrame:
        failed = F.col("page_number") % 10 == 0
        return rows.select("source", "page_number", F.when(~failed, F.col("second")).alias("verifier_category"), F.when(failed, F.lit("no answer")).alias("error"))

    return review.second_opinions(review.triggered(_classified(spark, sf_dir)), ask)


@query(f"WITH {_OPINIONS} SELECT source, page_number, category, round(confidence, 6) AS confidence, round(gap, 6) AS margin FROM q")
def top2_margin(spark, sf_dir):
    return tables.opinions(spark, sf_dir).select("source", "page_number", "category", F.round("confidence", 6).alias("confidence"), F.round(S.margin(F.col("probabilities")), 6).alias("margin"))


@query(f"WITH {_OPINIONS} SELECT source, page_number, concat_ws(',', CASE WHEN confidence < 0.5 THEN 'low confidence' END, CASE WHEN gap < 0.5 THEN 'low margin' END) AS reasons, triggered FROM t")
def trigger_reasons(spark, sf_dir):
    return review.triggered(_classified(spark, sf_dir)).select("source", "page_number", _joined("trigger_reasons").alias("reasons"), "triggered")


@query(f"WITH {_OPINIONS} SELECT source, page_number, reason, reason IS NOT NULL AS needs_review FROM t")
def initial_review(spark, sf_dir):
    return _classified(spark, sf_dir).select("source", "page_number", F.col("review_reason").alias("reason"), "needs_review")


@query(f"WITH {_OPINIONS} SELECT source, page_number, category, second, resolution FROM z")
def resolution(spark, sf_dir):
    return _verified(spark, sf_dir).select("source", "page_number", "category", "second", "resolution")


@query(f"""WITH {_OPINIONS} SELECT source, page_number, CASE resolution WHEN 'not_triggered' THEN reason IS NOT NULL WHEN 'accepted' THEN false ELSE true END AS needs_review,
CASE resolution WHEN 'not_triggered' THEN reason WHEN 'mutual_other' THEN 'other' WHEN 'disagreement' THEN 'verifier disagreement' WHEN 'verifier_failed' THEN 'verifier failed' END AS review_reason FROM z""")
def review_outcome(spark, sf_dir):
    return _verified(spark, sf_dir).select("source", "page_number", "needs_review", "review_reason")


@query(f"""WITH {_OPINIONS} SELECT source, count(*) AS page_count, count(*) FILTER (triggered) AS triggered_page_count, count(*) FILTER (resolution = 'accepted') AS accepted_page_count,
count(*) FILTER (resolution = 'mutual_other') AS mutual_other_page_count, count(*) FILTER (resolution = 'disagreement') AS disagreement_page_count, count(*) FILTER (resolution = 'verifier_failed') AS verifier_failed_page_count,
count(*) FILTER (reason IS NOT NULL) AS needs_review_before, count(*) FILTER (resolution IN ('mutual_other', 'disagreement', 'verifier_failed') OR resolution = 'not_triggered' AND reason IS NOT NULL) AS needs_review_after,
coalesce(string_agg(page_number::VARCHAR, ',' ORDER BY page_number) FILTER (triggered), '') AS triggered_pages FROM z GROUP BY source""")
def verification_summary(spark, sf_dir):
    return review.verification_summary(_verified(spark, sf_dir), ("source",)).withColumn("triggered_pages", _joined("triggered_pages"))


@query(f"WITH {_OPINIONS} SELECT c.category, count(q.category) AS n FROM (SELECT unnest({_NAMES}) AS category) c LEFT JOIN q ON q.category = c.category GROUP BY c.category")
def category_counts_zero_filled(spark, sf_dir):
    names = spark.createDataFrame([(c,) for c in S.CATEGORIES], "category string")
    return review.category_counts(tables.opinions(spark, sf_dir), names)


@query(f"""WITH {_OPINIONS} SELECT source, count(*) AS page_count, count(*) AS classified_page_count, 0::BIGINT AS skipped_page_count, count(reason) AS needs_review_page_count,
coalesce(string_agg(page_number::VARCHAR, ',' ORDER BY page_number) FILTER (reason IS NOT NULL), '') AS needs_review_pages FROM t GROUP BY source""")
def classification_summary(spark, sf_dir):
    return review.classification_summary(_classified(spark, sf_dir)).withColumn("needs_review_pages", _joined("needs_review_pages"))


@query(f"""WITH {_OPINIONS}, h AS (SELECT *, CASE resolution WHEN 'not_triggered' THEN reason WHEN 'mutual_other' THEN 'other' WHEN 'disagreement' THEN 'verifier disagreement' WHEN 'verifier_failed' THEN 'verifier failed' END AS why FROM z)
SELECT source, page_number, category AS label, round(confidence, 3) AS confidence, concat_ws('; ', why, CASE WHEN page_number % 3 = 0 THEN 'vlm mismatch: loan_number, page_number' END) AS notes FROM h""")
def page_labels_notes(spark, sf_dir):
    rows = _verified(spark, sf_dir)
    listed = F.when(F.col("page_number") % 3 == 0, F.array(F.lit("loan_number"), F.lit("page_number"))).otherwise(F.array().cast("array<string>"))
    return review.page_labels(rows.withColumn("mismatches", listed))


@query(f"WITH {_OPINIONS}, b AS (SELECT *, list_transform(x, lambda v: CASE WHEN page_number % 5 = 0 THEN v * 1.01 ELSE v END) AS y FROM q) SELECT source, page_number, 'probability sum' AS rule FROM b WHERE abs(list_sum(y) - 1) > 0.001 UNION ALL SELECT source, page_number, 'probability range' FROM b WHERE list_max(y) > 1 OR list_min(y) < 0")
def probability_simplex_violations(spark, sf_dir):
    rows = tables.opinions(spark, sf_dir)
    bent = F.transform_values("probabilities", lambda k, v: F.when(F.col("page_number") % 5 == 0, v * 1.01).otherwise(v))
    found = validate.violations(rows.withColumn("probabilities", bent), validate.simplex(), ["source", "page_number"])
    return found.select("source", "page_number", "rule")


# --- coverage ----------------------------------------------------------------------------------------------------------

_LABELLED = f"{_NUMBERED}, k AS (SELECT source, page_number FROM d JOIN (SELECT DISTINCT doc_id FROM labels) USING (doc_id))"


def _labelled(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    pages = tables.page_numbers(spark, sf_dir)
    return pages, pages.join(tables.read(spark, sf_dir, "labels").select("doc_id").distinct(), "doc_id")


@query(f"WITH {_LABELLED} SELECT source, page_number FROM d EXCEPT SELECT source, page_number FROM k")
def coverage_missing(spark, sf_dir):
    return coverage.missing(*_labelled(spark, sf_dir))


@query(f"WITH {_LABELLED} SELECT source, page_number, 'extra' AS problem FROM (SELECT source, page_number FROM d EXCEPT SELECT source, page_number FROM k)")
def coverage_extra(spark, sf_dir):
    """The sides swapped: pages beyond the expected ones."""
    pages, labelled = _labelled(spark, sf_dir)
    return coverage.coverage(labelled, pages)


@query(f"WITH {_NUMBERED}, v AS (SELECT source, page_number, n_chars, lag(n_chars) OVER (PARTITION BY source ORDER BY page_number) AS previous FROM d) SELECT source, page_number AS position, n_chars AS page_number, previous FROM v WHERE n_chars <= previous")
def increasing_page_violations(spark, sf_dir):
    """Text lengths in the place of page numbers."""
    docs = tables.read(spark, sf_dir, "documents").select("source", "doc_id", "n_chars")
    from quire.operators.prefix import numbered

    rows = numbered(docs, ["source"], "doc_id", "position").select("source", "position", F.col("n_chars").alias("page_number"))
    return coverage.not_increasing(rows)


# --- text ----------------------------------------------------------------------------------------------------------------

_NORMAL = "trim(regexp_replace(replace(lower(strip_accents({0})), 'ß', 'ss'), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"


@query(r"SELECT doc_id, md5(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS digest FROM documents")
def normalize_whitespace(spark, sf_dir):
    return tables.read(spark, sf_dir, "documents").select("doc_id", F.md5(T.squeeze(F.col("text")).cast("binary")).alias("digest"))


@query(f"SELECT doc_id, md5({_NORMAL.format('text')}) AS digest FROM documents")
def normalize_text(spark, sf_dir):
    return tables.read(spark, sf_dir, "documents").select("doc_id", F.md5(T.normalize(F.col("text")).cast("binary")).alias("digest"))


@query(f"SELECT p_partkey, array_to_string(list_sort(string_split({_NORMAL.format('p_name')}, ' ')), ' ') AS name FROM part")
def canonical_name(spark, sf_dir):
    return tables.read(spark, sf_dir, "part").select("p_partkey", T.canonical_name(F.col("p_name")).alias("name"))


@query("SELECT c_custkey, regexp_replace(lower(c_name || '-' || c_mktsegment), '[^\\p{L}\\p{N}]', '', 'g') AS number FROM customer")
def canonical_number(spark, sf_dir):
    return tables.read(spark, sf_dir, "customer").select("c_custkey", T.canonical_number(F.concat_ws("-", "c_name", "c_mktsegment")).alias("number"))


_ADDRESS_TOKENS = "string_split(" + _NORMAL.format("regexp_replace(regexp_replace(a, '\\[[^\\]]*\\]', ' ', 'g'), '#\\s*(\\d)', ' unit \\1', 'g')") + ", ' ')"


@query(f"""WITH a AS (SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN 'Property Address: ' ELSE '' END || s_suppkey || ' North ' || s_name || ' Street Street, Apartment #' || s_nationkey || ' [Address]' AS a FROM supplier),
t AS (SELECT s_suppkey, list_transform({_ADDRESS_TOKENS}, lambda x: CASE x WHEN 'north' THEN 'n' WHEN 'street' THEN 'st' WHEN 'apartment' THEN 'apt' ELSE x END) AS t FROM a),
l AS (SELECT s_suppkey, string_split(regexp_replace(array_to_string(t, ' '), '^property address ', ''), ' ') AS t FROM t)
SELECT s_suppkey, array_to_string(list_filter(t, lambda x, i: i = 1 OR x <> t[i - 1]), ' ') AS address FROM l""")
def canonical_address(spark, sf_dir):
    suppliers = tables.read(spark, sf_dir, "supplier")
    start = F.when(F.col("s_suppkey") % 3 == 0, F.lit("Property Address: ")).otherwise(F.lit(""))
    line = F.concat(start, F.col("s_suppkey").cast("string"), F.lit(" North "), F.col("s_name"), F.lit(" Street Street, Apartment #"), F.col("s_nationkey").cast("string"), F.lit(" [Address]"))
    return suppliers.select("s_suppkey", T.canonical_address(line).alias("address"))


@query(f"""SELECT doc_id, source, lang = 'en' AND contains({_NORMAL.format('text')}, 'the') AS found, contains({_NORMAL.format('text')}, {_NORMAL.format("lang || ' ' || source")}) AS named FROM documents""")
def exact_containment(spark, sf_dir):
    docs = tables.read(spark, sf_dir, "documents")
    page = T.matching_text(F.lit("borrower_name"), F.col("text"))
    value = T.matching_value(F.lit("borrower_name"), F.concat_ws(" ", "lang", "source"))
    return docs.select("doc_id", "source", ((F.col("lang") == "en") & F.contains(page, F.lit("the"))).alias("found"), F.contains(page, value).alias("named"))


# --- fields --------------------------------------------------------------------------------------------------------------

_FIELDS = """f AS (SELECT c_nationkey::VARCHAR AS source, c_custkey AS page_number, 'borrower_name' AS field, upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) AS value FROM customer
UNION ALL SELECT c_nationkey::VARCHAR, c_custkey, 'loan_number', CASE WHEN c_custkey % 3 = 0 THEN upper(c_mktsegment) ELSE lower(c_mktsegment) END || '-' || (c_custkey % 4) FROM customer),
n AS (SELECT *, CASE field WHEN 'borrower_name' THEN lower(value) ELSE replace(lower(value), '-', '') END AS canonical,
  CASE WHEN page_number % 5 <> 0 THEN (page_number % 8) / 8.0::DOUBLE END AS similarity, page_number % 11 = 0 AS needs_review FROM f),
c AS (SELECT source, field, canonical, count(DISTINCT page_number) AS n_pages, coalesce(avg(similarity), 0) AS mean, min(page_number) AS first_page, bool_or(needs_review) AS flagged FROM n GROUP BY ALL),
r AS (SELECT *, row_number() OVER w AS rank, coalesce(lead(n_pages) OVER w, 0) AS runner_up FROM c WINDOW w AS (PARTITION BY source, field ORDER BY n_pages DESC, mean DESC, first_page)),
v AS (SELECT source, field, canonical, value, count(*) AS k, min(page_number) AS first_page, string_agg(page_number::VARCHAR, ',' ORDER BY page_number) AS pages FROM n GROUP BY ALL),
best AS (SELECT *, row_number() OVER (PARTITION BY source, field, canonical ORDER BY k DESC, first_page, value) AS pick FROM v)"""


def _clustered(spark, sf_dir) -> DataFrame:
    rows = tables.fields(spark, sf_dir).withColumn("status", F.lit("ok"))
    return fields.cluster_exact(fields.entries(rows))


@query(f"WITH {_FIELDS} SELECT source, field, canonical, rank, n_pages, round(mean, 6) AS mean_similarity, first_page FROM r")
def cluster_rank(spark, sf_dir):
    ranks = fields.cluster_ranks(_clustered(spark, sf_dir).withColumn("similarity", F.col("similarity")))
    return ranks.select("source", "field", F.col("cluster").alias("canonical"), "rank", "n_pages", F.round("mean_similarity", 6).alias("mean_similarity"), "first_page")


@query(f"WITH {_FIELDS} SELECT source, field, canonical, value, pages FROM v")
def variants(spark, sf_dir):
    return fields.variants(_clustered(spark, sf_dir)).select("source", "field", "canonical", "value", _joined("pages").alias("pages"))


@query(f"WITH {_FIELDS} SELECT source, field, canonical, value FROM best WHERE pick = 1")
def representative(spark, sf_dir):
    return fields.representatives(fields.variants(_clustered(spark, sf_dir))).select("source", "field", "canonical", "value")


@query(f"""WITH {_FIELDS}, every AS (SELECT source, field FROM (SELECT DISTINCT source FROM f), (SELECT unnest(['borrower_name', 'property_address', 'loan_number']) AS field)),
p AS (SELECT source, field, canonical, string_agg(page_number::VARCHAR, ',' ORDER BY page_number) AS source_pages FROM n GROUP BY ALL),
x AS (SELECT source, field, canonical, string_agg(value || '=' || pages, ';' ORDER BY first_page, value) AS variants FROM v GROUP BY ALL)
SELECT every.source, every.field, b.value, b.canonical AS canonical_value, coalesce(source_pages, '') AS source_pages, coalesce(variants, '') AS variants,
coalesce(flagged OR n_pages < 2 OR (runner_up > 0 AND n_pages - runner_up <= 1), false) AS needs_review
FROM every LEFT JOIN (SELECT * FROM r WHERE rank = 1) r USING (source, field) LEFT JOIN (SELECT * FROM best WHERE pick = 1) b USING (source, field, canonical)
LEFT JOIN p USING (source, field, canonical) LEFT JOIN x USING (source, field, canonical)""")
def loan_fields_exact(spark, sf_dir):
    rows = _clustered(spark, sf_dir)
    out = fields.loan_fields(rows, tables.fields(spark, sf_dir))
    listed = F.array_join(F.transform("variants", lambda v: F.concat(v["value"], F.lit("="), F.array_join(F.transform(v["pages"], lambda p: p.cast("string")), ","))), ";")
    return out.select("source", "field", "value", "canonical_value", _joined("source_pages").alias("source_pages"), listed.alias("variants"), "needs_review")


def _checked(spark, sf_dir) -> DataFrame:
    """Each document's language, a word, and its own first words, or words it cannot have, looked for in its whole text as fields."""
    pages = fields.normalized_pages(tables.numbered_documents(spark, sf_dir))
    k = F.col("page_number") % 4
    name = F.when(k == 1, F.concat_ws(" ", F.slice(F.split("page_text", " "), 1, 3))).when(k > 1, F.lit("zzqx wwvy"))
    listed = F.explode(F.create_map(F.lit("loan_number"), F.col("lang"), F.lit("page_number"), F.lit("the"), F.lit("borrower_name"), name)).alias("field", "value")
    return fields.check_fields(pages.select("source", "page_number", "page_text", listed))


@query(f"""WITH {_NUMBERED}, m AS (SELECT *, {_NORMAL.format('text')} AS t FROM d),
x AS (SELECT source, page_number, 'loan_number' AS field, contains(t, lang) AS hit, false AS absent FROM m UNION ALL SELECT source, page_number, 'page_number', contains(t, 'the'), false FROM m
UNION ALL SELECT source, page_number, 'borrower_name', page_number % 4 = 1 AND t <> '', page_number % 4 = 0 FROM m)
SELECT field, count(*) FILTER (hit) AS ok, count(*) FILTER (NOT hit AND NOT absent) AS mismatch, count(*) FILTER (absent) AS missing FROM x GROUP BY field""")
def field_status_pivot(spark, sf_dir):
    """A field whose threshold is 1 is decided by containment, and no run of words is like the words that no text has."""
    return fields.status_counts(_checked(spark, sf_dir))


@query()
def fuzzy_window_similarity(spark, sf_dir):
    """Part names against other parts' names as page text."""
    parts = tables.read(spark, sf_dir, "part")
    rows = parts.select(F.lit("all").alias("source"), F.col("p_partkey").alias("page_number"), F.lit("borrower_name").alias("field"), F.concat_ws(" ", "p_name", "p_brand").alias("value"), F.concat_ws(" ", F.col("p_type"), F.reverse("p_brand"), F.col("p_name")).alias("text"))
    return fields.check_fields(rows)


@query()
def fuzzy_address_clusters(spark, sf_dir):
    """Suppliers of one nation as pages that name one property, spelt in several ways."""
    suppliers = tables.read(spark, sf_dir, "supplier")
    line = F.concat((F.col("s_nationkey") * 10 + F.col("s_suppkey") % 3).cast("string"), F.lit(" N Crestview Hill "), F.when(F.col("s_suppkey") % 2 == 0, F.lit("Drive")).otherwise(F.lit("Dr")), F.lit(", Las Vegas"))
    rows = suppliers.select(F.col("s_nationkey").cast("string").alias("source"), F.col("s_suppkey").alias("page_number"), F.lit("property_address").alias("field"), line.alias("value"), F.lit("ok").alias("status"), F.lit(1.0).alias("similarity"), F.lit(False).alias("needs_review"))
    out = fields.loan_fields(fields.cluster_addresses(fields.entries(rows)), rows)
    return out.where("field = 'property_address'").select("source", "value", "canonical_value", _joined("source_pages").alias("source_pages"), "needs_review")
