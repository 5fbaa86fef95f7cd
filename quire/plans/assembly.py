"""Reports of each stage, one for each source: parameters, model, summary, pages, timings and usage as one struct.

Every function returns (source, report); all sources of a job are put together at once. What a report does not have is null in it.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import scores as S
from quire.functions import text as T
from quire.operators import adjacency, fields, review
from quire.plans.document import PAGE, Settings
from quire.sources import models
from quire.sources.sinks import JSON_OPTIONS

SCHEMA_VERSION = "1"


def texts(reports: DataFrame) -> Iterator[tuple[str, str]]:
    """(source, indented JSON) of each report, one at a time."""
    written = reports.select("source", F.to_json("report", JSON_OPTIONS | {"pretty": "true"}).alias("json"))
    for row in written.orderBy("source").toLocalIterator():
        yield row.source, row.json


def _settings(**values) -> Column:
    return F.struct(*[F.lit(v).alias(k) for k, v in values.items()])


def _by_source(rows: DataFrame, name: str, *columns: str | Column) -> DataFrame:
    """source, ``name``: the rows of each source as a list in page order."""
    in_order = lambda a, b: F.signum(a["page_number"] - b["page_number"]).cast("int")  # noqa: E731  (rows may hold maps, which have no order)
    listed = F.array_sort(F.collect_list(F.struct("page_number", F.struct(*columns).alias("row"))), in_order)
    return rows.groupBy("source").agg(F.transform(listed, lambda x: x["row"]).alias(name))


def _all(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Joined on source; a source without rows on one side has null there."""
    for other in others:
        first = first.join(other, "source", "left")
    return first


def _model(model: models.Model) -> Column:
    return _settings(id=model.name, base_url=model.url, prompt_version=models.PROMPT_VERSION)


def _categories() -> Column:
    return F.create_map(*[F.lit(x) for c in S.CATEGORIES for x in (c, models.CRITERIA[c])])


def ocr_report(pages: DataFrame, engine: str, dpi: int, device: str) -> DataFrame:
    """``pages``: source, page_number, text, line_count, mean_score, duration_seconds."""
    listed = _by_source(pages, "pages", "page_number", "text", "line_count", "mean_score", "duration_seconds")
    total = pages.groupBy("source").agg(F.round(F.sum("duration_seconds"), 3).alias("total_duration_seconds"))
    out = _all(listed, total).select("source", F.lit(engine).alias("engine"), F.lit(dpi).alias("dpi"), F.lit(device).alias("device"), "total_duration_seconds", "pages")
    return out.select("source", F.struct("*").alias("report"))


def _classified_page(quality: bool) -> list[Column]:
    empty = F.col("category").isNull()
    out = [
        "page_number", "page_ref", "category", F.try_element_at(_categories(), F.col("category")).alias("category_label"), F.round("confidence", 6).alias("confidence"), "probabilities", "needs_review", "review_reason",
        F.struct(F.round("classify_seconds", 3).alias("classify_seconds")).alias("timings_seconds"),
        F.when(~empty, F.struct("input_tokens", "output_tokens")).alias("usage"),
    ]
    return [*out, review.ocr_reference()] if quality else out


def _classification_parts(classified: DataFrame) -> tuple[DataFrame, ...]:
    summary = review.classification_summary(classified)
    counts = classified.where("category is not null").groupBy("source", "category").agg(F.count("*").alias("n"))
    counts = counts.groupBy("source").agg(F.map_from_entries(F.collect_list(F.struct("category", "n"))).alias("counted"))
    usage = review.token_usage(classified.withColumn("seconds", F.col("classify_seconds")))
    skipped = _by_source(classified.where("category is null"), "skipped_pages", "page_number", "page_ref", F.col("review_reason").alias("reason"))
    return summary, counts, usage, skipped


def _zero_filled() -> Column:
    count = lambda c: F.coalesce(F.try_element_at("counted", F.lit(c)), F.lit(0)).cast("long")
    return F.create_map(*[x for c in S.CATEGORIES for x in (F.lit(c), count(c))]).alias("category_counts")


def classification_report(classified: DataFrame, model: models.Model, s: Settings) -> DataFrame:
    """``classified``: what ``document.classify`` returns, with line_count, mean_score, duration_seconds where the texts have them."""
    quality = {"line_count", "mean_score", "duration_seconds"} <= set(classified.columns)
    summary, counts, usage, skipped = _classification_parts(classified)
    rows = _all(_by_source(classified, "pages", *_classified_page(quality)), summary, counts, usage, skipped)
    out = rows.select(
        "source", F.lit(SCHEMA_VERSION).alias("schema_version"), _model(model).alias("model"), _categories().alias("categories"),
        _settings(confidence_threshold=s.min_confidence, max_state_chars=s.max_chars, timeout_seconds=model.timeout).alias("parameters"),
        F.struct("page_count", "classified_page_count", "skipped_page_count", "needs_review_page_count", "needs_review_pages", _zero_filled()).alias("summary"),
        "pages", "skipped_pages", F.struct("classify_seconds", "requests", "avg_classify_seconds_per_page").alias("timings"), F.struct("input_tokens", "output_tokens", "requests").alias("usage"),
    )
    return out.select("source", F.struct("*").alias("report"))


def verification_report(reviewed: DataFrame, model: models.Model, s: Settings) -> DataFrame:
    """``reviewed``: what ``document.verify`` returns."""
    second = F.struct("triggered", "trigger_reasons", F.round("margin", 6).alias("margin"), "verifier_category", "resolution", "error", F.round("verifier_seconds", 3).alias("verifier_seconds"))
    pages = _by_source(reviewed, "pages", *_classified_page(False), second.alias("verification"))
    spent = reviewed.groupBy("source").agg(F.round(F.coalesce(F.sum("verifier_seconds"), F.lit(0.0)), 3).alias("verify_seconds"))
    rows = _all(pages, review.verification_summary(reviewed, ("source",)), spent)
    summary = [c for c in review.verification_summary(reviewed, ("source",)).columns if c != "source"]
    out = rows.select(
        "source", F.lit(SCHEMA_VERSION).alias("schema_version"), _model(model).alias("model"),
        _settings(confidence_threshold=s.min_confidence, margin_threshold=s.min_margin, max_state_chars=s.max_chars, max_tokens=model.max_tokens, seed=model.seed).alias("parameters"),
        F.struct(*summary).alias("summary"), "pages", F.struct("verify_seconds", F.col("triggered_page_count").alias("requests")).alias("timings"),
    )
    return out.select("source", F.struct("*").alias("report"))


def extraction_report(extracted: DataFrame, checks: DataFrame, model: models.Model, s: Settings) -> DataFrame:
    """``extracted``: source, page_number, extracted, vlm_seconds. ``checks``: the rows of its fields, checked."""
    by_field = lambda *cs: F.map_from_entries(F.collect_list(F.struct("field", F.struct(*cs) if len(cs) > 1 else cs[0])))
    forms = checks.withColumn("form", T.canonical(F.col("field"), F.col("value")))
    per_page = forms.groupBy(*PAGE).agg(
        by_field("form").alias("normalized"), by_field("status", F.col("found").alias("found_in_ocr"), "similarity", "match_mode", "needs_review").alias("verification")
    )
    rows = extracted.join(per_page, PAGE).join(fields.page_flags(checks), PAGE).withColumn("page_ref", T.page_ref(F.col("source"), F.col("page_number")))
    pages = _by_source(rows, "pages", "page_number", "page_ref", "extracted", "normalized", "verification", "mismatches", F.struct(F.round("vlm_seconds", 3).alias("vlm_seconds")).alias("timings_seconds"))
    spent = extracted.groupBy("source").agg(F.round(F.sum("vlm_seconds"), 3).alias("vlm_seconds"), F.count("*").alias("requests"))
    summary = fields.extraction_summary(checks)
    out = _all(pages, summary, spent).select(
        "source", F.lit(SCHEMA_VERSION).alias("schema_version"), _model(model).alias("model"),
        _settings(mismatch_threshold=s.floor, review_margin=s.review_margin, max_tokens=model.max_tokens, seed=model.seed).alias("parameters"),
        F.struct(*[c for c in summary.columns if c != "source"]).alias("summary"), "pages", F.struct("vlm_seconds", "requests").alias("timings"),
    )
    return out.select("source", F.struct("*").alias("report"))


def match_report(rows: DataFrame, edges: DataFrame, members: DataFrame, vectors: DataFrame, s: Settings) -> DataFrame:
    """``rows``: pages with signals, and ``edges`` and ``members`` as ``document.match`` returns them. ``vectors``: with request and seconds."""
    grouped = adjacency.groups(members)
    group_of = adjacency.numbered_groups(grouped).select("source", "group_seq", "group_id", "size", "representative", "min_combined", "mean_combined")
    edge = F.struct(
        F.round("e.combined", 6).alias("combined_similarity"),
        F.struct(F.round("e.embedding", 6).alias("embedding_similarity"), F.round("e.category", 6).alias("category_match"), F.col("e.page_number_seq").alias("page_number_sequence")).alias("signals"),
        F.round("e.available_weight", 6).alias("available_weight"),
    )
    of = members.alias("m").join(edges.alias("e"), (F.col("m.source") == F.col("e.source")) & (F.col("m.page_number") == F.col("e.page_number")), "left")
    of = of.select("m.source", "m.page_number", "m.group_seq", F.when(F.col("m.combined").isNotNull(), edge).alias("edge")).withColumn("page_ref", T.page_ref(F.col("source"), F.col("page_number")))
    listed = of.groupBy("source", "group_seq").agg(F.array_sort(F.collect_list(F.struct("page_number", "page_ref", "edge"))).alias("members"))
    several = group_of.join(listed, ["source", "group_seq"]).withColumn("page_number", F.col("group_id"))
    groups = _by_source(several, "groups", "group_id", "size", F.transform("members", lambda m: m["page_ref"]).alias("page_refs"), "representative", "members", F.round("min_combined", 6).alias("min_combined_similarity"), F.round("mean_combined", 6).alias("mean_combined_similarity"))
    single = grouped.where("size = 1").select("source", F.col("first_page").alias("page_number"), F.col("representative").alias("page_ref"))
    without = rows.where("vector is null").withColumn("page_ref", T.page_ref(F.col("source"), F.col("page_number")))
    asked = vectors.groupBy("source").agg(F.sum("request").alias("requests"), F.round(F.sum("seconds"), 3).alias("embed_seconds"))
    summary = adjacency.match_summary(rows, grouped)
    e, c, p = s.weights
    none = F.array()
    out = _all(summary, groups, _by_source(single, "unique_pages", "page_ref", "page_number"), _by_source(without, "skipped_pages", "page_ref", "page_number", F.lit("empty text").alias("reason")), asked)
    held = {n: F.coalesce(n, none.cast(out.schema[n].dataType)).alias(n) for n in ("groups", "unique_pages", "skipped_pages")}
    out = out.select(
        "source", F.lit(SCHEMA_VERSION).alias("schema_version"),
        _settings(weight_embedding=e, weight_category=c, weight_page_number=p, min_embedding_similarity=s.min_embedding, threshold=s.edge_threshold).alias("parameters"),
        F.struct(*[x for x in summary.columns if x != "source"]).alias("summary"), held["groups"], held["unique_pages"], held["skipped_pages"], F.struct("requests", "embed_seconds").alias("timings"),
    )
    return out.select("source", F.struct("*").alias("report"))


def result_report(page_labels: DataFrame, documents: DataFrame, loan_fields: DataFrame, stage_seconds: dict[str, float]) -> DataFrame:
    """Page labels, documents in order of their first page, and the field record of each source."""
    labels = _by_source(page_labels, "page_labels", "page_number", "label", "confidence", "notes")
    docs = _by_source(documents.withColumn("page_number", F.col("first_page")), "documents", "label", "pages")
    record = F.struct("value", "canonical_value", "source_pages", "variants", "needs_review")
    loans = loan_fields.groupBy("source").agg(F.map_from_entries(F.collect_list(F.struct("field", record))).alias("loan_level_fields"))
    spent = {k: round(v, 3) for k, v in stage_seconds.items()}
    timings = F.struct(F.create_map(*[F.lit(x) for kv in spent.items() for x in kv]).alias("stages_seconds"), F.lit(round(sum(spent.values()), 3)).alias("total_seconds"))
    out = _all(labels, docs, loans).select("source", F.lit(SCHEMA_VERSION).alias("schema_version"), "page_labels", "documents", "loan_level_fields", timings.alias("timings"))
    return out.select("source", F.struct("*").alias("report"))
