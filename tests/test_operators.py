import pytest
from pyspark.sql import functions as F

from quire.functions import scores as S
from quire.functions import text as T
from quire.operators import adjacency, coverage, fields, prefix, review, timings, validate

# Published edge table (embedding, category, sequence, combined).
EDGES = [
    (0.881327, 1.00, 1.0, 0.928796), (0.763439, 0.00, None, 0.538898), (0.810434, 0.00, None, 0.572071), (0.785084, 1.00, 1.0, 0.871050),
    (0.886860, 1.00, 1.0, 0.932116), (0.777498, 0.00, None, 0.548822), (0.827355, 0.99, 1.0, 0.893913), (0.775159, 0.98, None, 0.835407),
    (0.770068, 0.98, None, 0.831813), (0.657748, 0.00, None, 0.464293), (0.761873, 0.84, 1.0, 0.817124),
]


def test_combined_scores(spark):
    rows = spark.createDataFrame([(*e, i) for i, e in enumerate(EDGES)], "e double, c double, p double, want double, i int")
    got = rows.orderBy("i").select("want", S.combine(F.col("e"), F.col("c"), F.col("p")).alias("got")).collect()
    assert all(abs(r.want - r.got) < 1e-6 for r in got)
    with pytest.raises(ValueError):
        S.combine(F.lit(1), F.lit(1), F.lit(1), (0, 0, 0))


def test_islands_of_the_edge_table(spark):
    pages = spark.createDataFrame([("a", i, [1.0]) for i in range(1, 13)] + [("b", 1, None), ("b", 2, [1.0])], "source string, page_number int, vector array<double>")
    edges = spark.createDataFrame([("a", i + 2, e[3], False) for i, e in enumerate(EDGES)], "source string, page_number int, combined double, blocked boolean")
    members = adjacency.islands(pages, edges)
    grouped = adjacency.groups(members)
    got = {(r.source, r.first_page): (r.pages, r.representative) for r in grouped.collect()}
    assert {k: v[0] for k, v in got.items()} == {("a", 1): [1, 2], ("a", 3): [3], ("a", 4): [4, 5, 6], ("a", 7): [7, 8, 9, 10], ("a", 11): [11, 12], ("b", 2): [2]}
    assert got["a", 4][1] == "a#page-4"
    assert [(r.group_id, r.first_page) for r in adjacency.numbered_groups(grouped).orderBy("group_id").collect()] == [(1, 1), (2, 4), (3, 7), (4, 11)]
    summary = {r.source: tuple(r)[1:] for r in adjacency.match_summary(pages, grouped).collect()}
    assert summary == {"a": (12, 12, 0, 4, 11, 1), "b": (2, 1, 1, 0, 0, 1)}
    labels = pages.withColumn("label", F.when(F.col("page_number") % 2 == 0, F.lit("even")).otherwise(F.lit("odd")))
    listed = {(r.source, r.first_page): r.label for r in adjacency.documents(pages, members, labels).collect()}
    assert listed["a", 1] == "odd" and listed["a", 4] == "even" and listed["b", 1] == "odd" and len(listed) == 7


def test_edges(spark):
    rows = [("s", 1, [1.0, 0.0], "x", 0.9, 1), ("s", 2, [1.0, 0.0], "x", 0.5, 2), ("s", 3, [0.0, 1.0], None, None, 2), ("s", 5, [1.0, 0.0], "x", 0.9, None), ("s", 6, [-1.0, 0.0], "y", 0.9, 4), ("s", 7, None, "y", 0.9, 4)]
    pages = spark.createDataFrame(rows, "source string, page_number int, vector array<double>, category string, confidence double, printed_number int")
    got = {r.page_number: r for r in adjacency.edges(pages).collect()}
    assert sorted(got) == [2, 3, 6]
    assert tuple(got[2])[2:] == (1.0, 0.5, 1.0, 1.0, pytest.approx(0.875), False)
    assert got[3].category is None and got[3].page_number_seq == 0.5 and got[3].blocked
    assert got[6].embedding == 0.0 and got[6].category == 0.0 and got[6].page_number_seq is None


def test_running_sums_match_a_window(spark):
    rows = spark.range(500).select((F.col("id") % 3).cast("string").alias("g"), (F.col("id") * 37 - 900).alias("o"), (F.col("id") % 5).alias("v"))
    rows = rows.withColumn("g", F.when(F.col("g") != "2", F.col("g")))
    got = prefix.running_sum(rows, ["g"], "o", F.col("v"), "total", bits=3)
    by = {}
    for r in sorted(rows.collect(), key=lambda r: r.o):
        by[r.g] = by.get(r.g, []) + [r.v]
    want = sorted((sum(v[: k + 1])) for v in by.values() for k in range(len(v)))
    assert sorted(r.total for r in got.collect()) == want


def test_reviews(spark):
    names = list(S.CATEGORIES)

    def shares(first, second):
        p = dict.fromkeys(names, 0.0)
        p[names[0]], p[names[1]] = first, second
        p[names[2]] = 1 - first - second
        return p

    rows = [
        ("s", 1, "t", names[0], 0.4, shares(0.9, 0.02), names[0]), ("s", 2, "t", names[0], 0.9, shares(0.55, 0.35), names[1]),
        ("s", 3, "t", names[0], 0.4, shares(0.55, 0.35), None), ("s", 4, "t", names[0], 0.9, shares(0.9, 0.05), "never asked"),
        ("s", 5, " ", None, None, None, "never asked"), ("s", 6, "t", "other", 0.3, shares(0.9, 0.0), "other"),
    ]
    pages = spark.createDataFrame(rows, "source string, page_number int, text string, category string, confidence double, probabilities map<string,double>, answer string")
    ready = review.triggered(review.classified(pages))
    got = {r.page_number: r for r in ready.collect()}
    assert [got[i].trigger_reasons for i in range(1, 6)] == [["low confidence"], ["low margin"], ["low confidence", "low margin"], [], []]
    assert got[1].margin == pytest.approx(0.82) and got[5].margin is None and got[5].review_reason == "empty text"

    def ask(asked):
        return asked.select("source", "page_number", F.col("answer").alias("verifier_category"), F.when(F.col("answer").isNull(), F.lit("timeout")).alias("error"))

    done = review.second_opinions(ready, ask)
    got = {r.page_number: (r.resolution, r.needs_review, r.review_reason) for r in done.collect()}
    assert got == {
        1: ("accepted", False, None), 2: ("disagreement", True, "verifier disagreement"), 3: ("verifier_failed", True, "verifier failed"),
        4: ("not_triggered", False, None), 5: ("not_triggered", True, "empty text"), 6: ("mutual_other", True, "other"),
    }
    assert tuple(review.verification_summary(done).first())[:8] == (6, 4, 1, 1, 1, 1, 4, 4)
    labels = {r.page_number: r for r in review.page_labels(done.withColumn("mismatches", F.array().cast("array<string>"))).collect()}
    assert labels[5].label == "other" and labels[5].confidence is None and labels[5].notes == "empty text"


def entry(page, value, similarity=1.0, flag=False, field="loan_number", source="s"):
    return (source, page, field, value, "ok", similarity, flag)


SCHEMA = "source string, page_number int, field string, value string, status string, similarity double, needs_review boolean"


def loan(spark, rows):
    entered = fields.entries(spark.createDataFrame(rows, SCHEMA))
    address = F.col("field") == "property_address"
    clustered = fields.cluster_exact(entered.where(~address)).unionByName(fields.cluster_addresses(entered.where(address)))
    return {r.field: r for r in fields.loan_fields(clustered, spark.createDataFrame([("s",)], "source string")).collect()}


def test_loan_fields(spark):
    got = loan(spark, [entry(1, "L1"), entry(2, "L1"), entry(3, "L2"), entry(1, "Al B", field="borrower_name")])
    assert (got["loan_number"].value, got["loan_number"].source_pages, got["loan_number"].needs_review) == ("L1", [1, 2], True)
    assert got["borrower_name"].needs_review and got["property_address"].value is None and not got["property_address"].needs_review
    assert got["property_address"].variants == [] and got["property_address"].source_pages == []
    got = loan(spark, [entry(1, "L2"), entry(2, "L1")])
    assert got["loan_number"].value == "L2" and got["loan_number"].needs_review
    got = loan(spark, [entry(1, "L-1"), entry(2, "l1"), entry(3, "L-1")])
    assert got["loan_number"].value == "L-1" and not got["loan_number"].needs_review and got["loan_number"].canonical_value == "l1"
    got = loan(spark, [entry(1, "L1"), entry(2, "L1", flag=True), entry(3, "L1")])
    assert got["loan_number"].needs_review


def test_addresses_cluster_in_page_order(spark):
    spelt = {
        1: "604N C restview Hill Dr, Unit 1144 Las Vegas, NV 89139", 3: "604 N Crest View Hill Dr Unit 1144, Las Vegas, NV 89139",
        4: "604 N Crestview Hill Dr Unit 1144, Las Vegas, NV 89139", 7: "604 N Crestview Hill Dr Unit 1144, Las Vegas, NV 89139 [Property Address]",
        11: "4124 Silvercrest Avenue, Las Vegas, NV 89129", 12: "Address",
    }
    got = loan(spark, [entry(p, v, field="property_address") for p, v in spelt.items()])["property_address"]
    assert got.value == spelt[4] and got.source_pages == [1, 3, 4, 7] and not got.needs_review
    assert [v.value for v in got.variants] == [spelt[1], spelt[3], spelt[4], spelt[7]]


def test_field_checks(spark):
    page = "Loan No. 20 414 784 of Alya Renard, 12 Main Street, Las Vegas NV 89139 page 3"
    rows = [("s", 1, "loan_number", "20-414-784"), ("s", 1, "borrower_name", "Alya Renardo"), ("s", 1, "property_address", "12 Main Street, Las Vegas NV 89138"), ("s", 1, "page_number", "6"), ("s", 2, "page_number", None)]
    df = spark.createDataFrame([(*r, page) for r in rows], "source string, page_number int, field string, value string, text string")
    got = {(r.page_number, r.field): r for r in fields.check_fields(df).collect()}
    assert (got[1, "loan_number"].status, got[1, "loan_number"].match_mode, got[1, "loan_number"].similarity) == ("ok", "exact", 1.0)
    assert got[1, "borrower_name"].status == "ok" and not got[1, "borrower_name"].needs_review or got[1, "borrower_name"].similarity < 0.95
    assert got[1, "property_address"].match_mode == "fuzzy" and got[1, "property_address"].needs_review
    assert got[1, "page_number"].status == "mismatch" and got[2, "page_number"].status == "missing"
    assert T.FIELDS[0] == "borrower_name"
    flags = {r.page_number: (r.mismatches, r.has_flag) for r in fields.page_flags(fields.check_fields(df)).collect()}
    assert flags == {1: (["page_number"], True), 2: ([], False)}
    row = fields.extraction_summary(fields.check_fields(df)).first()
    assert (row.page_count, row.pages_with_mismatch, row.pages_with_review_flag, row.needs_review_page_count) == (2, [1], [1], 1)
    assert (row.field_mismatch_count, row.field_missing_count) == (1, 1) and row.review_flag_count >= 1


def test_coverage(spark):
    make = lambda rows: spark.createDataFrame(rows, "source string, page_number int, has_text boolean")
    pages, given = make([("a", 1, True), ("a", 2, False), ("a", 3, True)]), make([("a", 1, True), ("a", 4, True)])
    assert sorted(tuple(r) for r in coverage.coverage(pages, given).collect()) == [("a", 2, "missing"), ("a", 3, "missing"), ("a", 4, "extra")]
    assert sorted(tuple(r) for r in coverage.auxiliary_coverage(pages, given).collect()) == [("a", 3, "missing"), ("a", 4, "extra")]
    assert coverage.page_counts_differ(pages, pages).isEmpty() and not coverage.page_counts_differ(pages, given).isEmpty()
    assert coverage.repeated(pages.union(pages)).count() == 3


def test_validation(spark):
    good = {c: 1 / 6 for c in S.CATEGORIES}
    bad = good | {"other": 0.9}
    df = spark.createDataFrame([(1, "other", good), (2, "title_rider", bad), (3, "other", {"x": 1.0}), (4, None, None)], "id int, category string, probabilities map<string,double>")
    found = sorted((r.id, r.rule) for r in validate.violations(df, validate.simplex(), ["id"]).collect())
    assert found == [(2, "most probable"), (2, "probability sum"), (3, "probability keys")]
    with pytest.raises(validate.ValidationError, match="probability keys"):
        validate.require(df, validate.simplex(), ["id"])
    assert validate.require(df.where("id in (1, 4)"), validate.simplex(), ["id"]).count() == 2


def test_timings(spark):
    make = lambda rows: spark.createDataFrame(rows, "source string, page_number int, seconds double")
    got = timings.page_timings(make([("a", 1, 1.0004), ("a", 2, None)]), make([("a", 1, 0.5), ("a", 2, 0.25)]), make([("a", 1, 2.0), ("a", 2, 1.0)]))
    assert sorted(tuple(r) for r in got.collect()) == [("a", 1, 1.0, 0.5, 2.0, 3.5), ("a", 2, 0.0, 0.25, 1.0, 1.25)]
    stages = spark.createDataFrame([("a", "ocr", 1.5), ("a", "match", 0.25), ("b", "ocr", None)], "source string, stage string, seconds double")
    row = timings.stage_timings(stages.where("source = 'a'")).first()
    assert row.stages_seconds == {"match": 0.25, "ocr": 1.5} and row.total_seconds == 1.75
    with pytest.raises(Exception, match="no total for stage ocr"):
        timings.stage_timings(stages).collect()
