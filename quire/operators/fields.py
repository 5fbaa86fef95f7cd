"""Extracted fields: check against the page text, cluster by value, roll up to one record for each source.

Rows are (source, page_number, field, value, ...): one for each page and field.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.functions import text as T

ROLLED_UP = ("borrower_name", "property_address", "loan_number")


def unpivot(pages: DataFrame, key: tuple[str, ...] = ("source", "page_number"), fields: tuple[str, ...] = T.FIELDS) -> DataFrame:
    """One row for each page and field, from a struct ``extracted``."""
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"extracted.{f}").alias("value")) for f in fields])
    return pages.select(*key, F.explode(pairs).alias("_p")).select(*key, "_p.*")


def normalized_pages(pages: DataFrame) -> DataFrame:
    """+ page_text: the page's text as fields are looked for in it. Once a page, before its fields are listed."""
    return pages.withColumn("page_text", T.normalize(F.col("text")))


def check_fields(rows: DataFrame, floor: float = 0.75, margin: float = 0.10) -> DataFrame:
    """+ status (ok, mismatch, missing), found, similarity, match_mode, needs_review, from value and text.

    Values that the text contains never reach Python: only the others get the sliding-window ratio. Where rows have
    page_text (``normalized_pages``), it is taken, and text is not needed.
    """
    key = [c for c in rows.columns if c not in ("value", "text", "page_text")]
    value = F.when(F.col("field") == "loan_number", T.canonical_number(F.col("value"))).otherwise(T.normalize(F.col("value")))
    page = F.col("page_text") if "page_text" in rows.columns else T.normalize(F.col("text"))
    page = F.when(F.col("field") == "loan_number", F.regexp_replace(page, r"(?U)(?<=\d)\s+(?=\d)", "")).otherwise(page)
    ready = rows.withColumn("_value", value).withColumn("_page", F.coalesce(page, F.lit("")))
    inside = (F.col("_value") != "") & F.contains("_page", "_value")
    ready = ready.withColumn("_mode", F.when(F.col("value").isNotNull(), F.when(inside, F.lit("exact")).otherwise(F.lit("fuzzy"))))
    plain = ready.where("_mode is null or _mode = 'exact'").withColumn("_ratio", F.when(F.col("_mode") == "exact", F.lit(1.0)))
    fuzzy = ready.where("_mode = 'fuzzy'").withColumn("_ratio", T.window_similarity("_value", "_page"))
    both = plain.unionByName(fuzzy)
    limit = T.effective_threshold(F.col("field"), floor)
    ok = F.col("_ratio") >= limit
    return both.select(
        *key, "value", F.when(F.col("_mode").isNull(), F.lit("missing")).when(ok, F.lit("ok")).otherwise(F.lit("mismatch")).alias("status"),
        F.coalesce(ok, F.lit(False)).alias("found"), F.round("_ratio", 4).alias("similarity"), F.col("_mode").alias("match_mode"),
        F.coalesce(ok & (F.col("_mode") == "fuzzy") & (F.col("_ratio") < limit + margin), F.lit(False)).alias("needs_review"),
    )


def status_counts(rows: DataFrame) -> DataFrame:
    """field x status matrix."""
    counts = rows.groupBy("field").agg(*[F.count_if(F.col("status") == s).alias(s) for s in ("ok", "mismatch", "missing")])
    return counts.select("field", "ok", "mismatch", "missing")


def page_flags(rows: DataFrame) -> DataFrame:
    """source, page_number, mismatches (names in order), has_flag."""
    order = F.array_position(F.array(*[F.lit(f) for f in T.FIELDS]), F.col("field"))
    wrong = F.array_sort(F.collect_list(F.when(F.col("status") == "mismatch", F.struct(order, "field"))))
    return rows.groupBy("source", "page_number").agg(F.transform(wrong, lambda s: s["field"]).alias("mismatches"), F.bool_or("needs_review").alias("has_flag"))


def extraction_summary(rows: DataFrame) -> DataFrame:
    """One row for each source: pages, mismatches, missing values, flags, and the pages with any of them in order."""
    flags = page_flags(rows).select("source", "page_number", (F.size("mismatches") > 0).alias("wrong"), "has_flag")
    listed = lambda c: F.array_sort(F.collect_list(F.when(c, F.col("page_number"))))
    by_page = flags.groupBy("source").agg(
        F.count("*").alias("page_count"), listed(F.col("wrong")).alias("pages_with_mismatch"), listed(F.col("has_flag")).alias("pages_with_review_flag"),
        F.count_if(F.col("wrong") | F.col("has_flag")).alias("needs_review_page_count"),
    )
    by_field = rows.groupBy("source").agg(
        F.count_if(F.col("status") == "mismatch").alias("field_mismatch_count"), F.count_if(F.col("status") == "missing").alias("field_missing_count"),
        F.count_if("needs_review").alias("review_flag_count"),
    )
    return by_page.join(by_field, "source")


def entries(rows: DataFrame) -> DataFrame:
    """What takes part in the roll-up: values found in their page, with canonical form."""
    kept = rows.where(F.col("value").isNotNull() & (F.col("status") == "ok") & F.col("field").isin(*ROLLED_UP))
    return kept.withColumn("canonical", T.canonical(F.col("field"), F.col("value")))


def cluster_exact(rows: DataFrame) -> DataFrame:
    """+ cluster: equal canonical forms; a value with an empty one is alone on its page."""
    alone = F.concat(F.lit("\x00"), F.col("page_number").cast("string"))
    return rows.withColumn("cluster", F.when(F.col("canonical") == "", alone).otherwise(F.col("canonical")))


def _matches(a: str, b: str) -> bool:
    if not a or not b:
        return False
    if a == b or {a, a.replace(" ", "")} & {b, b.replace(" ", "")}:
        return True
    limit = T.CLUSTER_AT["property_address"]
    return 2 * min(len(a), len(b)) >= limit * (len(a) + len(b)) and T.ratio(a, b) >= limit


def cluster_addresses(rows: DataFrame) -> DataFrame:
    """+ cluster: by page, each value joins the first cluster with any matching member. Clusters never merge, so this depends on order
    and is done for one source at a time; its rows are one source's pages."""
    kept = [c for c in rows.columns if c != "cluster"]

    def first_fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["page_number", "value"])
        clusters: list[set[str]] = []
        names = []
        for key in pdf["canonical"]:
            at = next((i for i, members in enumerate(clusters) if key in members and key or any(_matches(key, m) for m in members)), None)
            if at is None:
                at = len(clusters)
                clusters.append(set())
            clusters[at].add(key)
            names.append(f"{at:09d}")
        return pdf.assign(cluster=names)[[*kept, "cluster"]]

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*kept).schema) + ", cluster string"
    return rows.select(*kept).groupBy("source", "field").applyInPandas(first_fit, schema)


def cluster_ranks(clustered: DataFrame) -> DataFrame:
    """source, field, cluster, n_pages, mean_similarity, first_page, flagged, rank: most pages, then similarity, then first page."""
    stats = clustered.groupBy("source", "field", "cluster").agg(
        F.count_distinct("page_number").alias("n_pages"),
        # summed in a fixed order, as the mean of the doubles decides ranks
        F.array_sort(F.collect_list(F.when(F.col("similarity").isNotNull(), F.struct("page_number", "similarity")))).alias("_s"),
        F.min("page_number").alias("first_page"), F.bool_or("needs_review").alias("flagged"),
    )
    mean = F.aggregate("_s", F.lit(0.0), lambda a, s: a + s["similarity"]) / F.size("_s")
    stats = stats.withColumn("mean_similarity", F.when(F.size("_s") > 0, mean).otherwise(0.0)).drop("_s")
    order = Window.partitionBy("source", "field").orderBy(F.desc("n_pages"), F.desc("mean_similarity"), "first_page")
    return stats.withColumn("rank", F.row_number().over(order)).withColumn("runner_up", F.coalesce(F.lead("n_pages").over(order), F.lit(0)))


def variants(clustered: DataFrame) -> DataFrame:
    """source, field, cluster, value, canonical, pages: each spelling and its pages, ascending."""
    return clustered.groupBy("source", "field", "cluster", "value", "canonical").agg(F.array_sort(F.collect_list("page_number")).alias("pages"))


def representatives(spellings: DataFrame) -> DataFrame:
    """The spelling to show for each cluster: best supported canonical form, fewest non-ASCII letters and brackets, most pages, first page."""
    support = F.sum(F.size("pages")).over(Window.partitionBy("source", "field", "cluster", "canonical"))
    order = F.struct(-F.col("_support"), T.non_ascii_count(F.col("value")), T.bracket_count(F.col("value")), -F.size("pages"), F.get("pages", F.lit(0)), F.col("value"))
    return spellings.withColumn("_support", support).groupBy("source", "field", "cluster").agg(F.min_by(F.struct("value", "canonical"), order).alias("_r")).select("source", "field", "cluster", "_r.*")


def loan_fields(clustered: DataFrame, sources: DataFrame) -> DataFrame:
    """source, field, value, canonical_value, source_pages, variants, needs_review for every source and rolled-up field.

    The winning cluster is the first by rank. It is flagged if any entry is, if it is on one page only, or if the runner-up is within
    one page. A field without entries is null, without pages, not flagged.
    """
    ranks = cluster_ranks(clustered).where("rank = 1")
    spelt = variants(clustered)
    listed = spelt.groupBy("source", "field", "cluster").agg(
        F.array_sort(F.collect_list(F.struct(F.get("pages", F.lit(0)).alias("first"), "value", "pages"))).alias("_v"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("pages")))).alias("source_pages")
    )
    shown = ranks.join(representatives(spelt), ["source", "field", "cluster"]).join(listed, ["source", "field", "cluster"])
    close = (F.col("runner_up") > 0) & (F.col("n_pages") - F.col("runner_up") <= 1)
    shown = shown.select(
        "source", "field", "value", F.col("canonical").alias("canonical_value"), "source_pages",
        F.transform("_v", lambda s: F.struct(s["value"].alias("value"), s["pages"].alias("pages"))).alias("variants"),
        (F.col("flagged") | (F.col("n_pages") < 2) | close).alias("needs_review"),
    )
    every = sources.select("source").distinct().withColumn("field", F.explode(F.array(*[F.lit(f) for f in ROLLED_UP])))
    out = every.join(shown, ["source", "field"], "left")
    nothing = out.schema["source_pages"].dataType
    return (
        out.withColumn("source_pages", F.coalesce("source_pages", F.array().cast(nothing)))
        .withColumn("variants", F.coalesce("variants", F.array().cast(out.schema["variants"].dataType)))
        .withColumn("needs_review", F.coalesce("needs_review", F.lit(False)))
    )
