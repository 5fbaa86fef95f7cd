import difflib
import random

import pytest
from pyspark.sql import functions as F

from quire.functions import text as T


def column(spark, values, f):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in rows.orderBy("i").select(f(F.col("v"))).collect()]


# Known answers of the canonical forms, here and in the pairs below.
def test_normalize(spark):
    values = ["Alya Renard—Van Merçer", "LOAN #: 20-414-784\n", "Straße ÀÉ", "", "ﬁn ½"]
    want = ["alya renard van mercer", "loan 20 414 784", "strasse ae", "", "fin 1 2"]
    assert [T.normalize_value(v) for v in values] == want
    assert column(spark, [*values, None], T.normalize) == [*want, None]
    other = ["Андрей Ёлкин", "ＦＵＬＬ", "ΟΔΥΣΣΕΥΣ", "e\u0301te\u0301", "ŉ ǆ ſ"]
    assert column(spark, other, T.normalize) == [T.normalize_value(v) for v in other] and column(spark, other[:1], T.canonical_name) == ["андреи елкин"]
    assert column(spark, [*values, None], T.normalize_exact) == [*want, None]


@pytest.mark.parametrize(
    ("f", "pairs"),
    [
        (
            T.canonical_address,
            {
                "Property Address: 123 Main St": "123 main st",
                "123 Main St Property Address": "123 main st",
                "123 Main Street, Apartment # 4B, North Las Vegas": "123 main st apt unit 4b n las vegas",
                "123 Main St Unit #45": "123 main st unit 45",
                "Address": "",
                "604 N Crestview Hill Dr Unit 1144, Las Vegas, NV 89139 [Property Address]": "604 n crestview hill dr unit 1144 las vegas nv 89139",
            },
        ),
        (T.canonical_number, {"20-414-784": "20414784", "AB-12 34": "ab1234", "N/A": "na"}),
        (T.canonical_name, {"Renard-Van Mercer, Alya": "alya mercer renard van"}),
        (T.squeeze, {" a  b \x1c c\n": "a b c"}),
        (T.non_ascii_count, {"aé😀": 2}),
        (T.bracket_count, {"[a] ]": 3}),
        (lambda v: T.matching_text(F.lit("loan_number"), v), {"no 20 414 784 x 1": "no 20414784 x 1"}),
        (T.has_text, {"   \n": False, " ": False, "x": True, None: False}),
    ],
)
def test_expressions(spark, f, pairs):
    assert column(spark, list(pairs), f) == list(pairs.values())


def test_preview_notes_and_unknown_field(spark):
    assert len(column(spark, ["x" * 300], T.preview)[0]) == 203
    row = spark.range(1).select(
        T.notes(F.lit("low confidence"), F.array(F.lit("loan_number"), F.lit("borrower_name"))).alias("a"), T.notes(F.lit(None).cast("string"), F.array().cast("array<string>")).alias("b")
    ).first()
    assert tuple(row) == ("low confidence; vlm mismatch: loan_number, borrower_name", "")
    with pytest.raises(Exception, match="unsupported field"):
        column(spark, ["x"], lambda v: T.canonical(F.lit("colour"), v))


def test_best_run_of_words():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcd") for _ in range(rng.randint(1, 5)))
    for _ in range(60):
        value, words = " ".join(word() for _ in range(rng.randint(1, 3))), [word() for _ in range(rng.randint(0, 12))]
        n = len(value.split())
        runs = [" ".join(words[i : i + k]) for k in {max(1, n - 1), n, n + 1} for i in range(len(words) - k + 1)]
        want = 1.0 if value in " ".join(words) else max((difflib.SequenceMatcher(None, value, r).ratio() for r in runs), default=0.0)
        assert T.window_ratio(value, " ".join(words)) == want


def test_ratios():
    assert T.ratio("tide", "diet") == 0.25 and T.ratio("diet", "tide") == 0.5
    assert T.ratio("", "x") == 0
    assert T.window_ratio("main st", "at 12 main street now") == 1.0
    value, page = "las vegas nv 89139", "in las vegas nv 89138 there"
    words = page.split()
    best = max(difflib.SequenceMatcher(None, value, " ".join(words[i : i + n])).ratio() for n in (3, 4, 5) for i in range(len(words) - n + 1))
    assert T.window_ratio(value, page) == best < 1
    assert T.window_ratio("a b c", "z") == T.window_ratio("", "z") == 0
