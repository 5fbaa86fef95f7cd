"""Text expressions: canonical forms of field values, matching preparation, page references.

``normalize`` is the full Unicode definition: text whose letters are plain or accented Latin is folded by column expressions,
and only other text goes through ``normalize_exact``, a vectorised Python UDF. ``normalize_latin`` is the first part alone.
"""

from __future__ import annotations

import difflib
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType, StringType

FIELDS = ("borrower_name", "property_address", "loan_number", "page_number")

# Similarity a field needs to count as found in the page text, and to join a cluster.
FOUND_AT = {"borrower_name": 0.85, "property_address": 0.90, "loan_number": 1.0, "page_number": 1.0}
CLUSTER_AT = {"borrower_name": 1.0, "property_address": 0.90, "loan_number": 1.0, "page_number": 1.0}

# Postal designators and their short forms.
DESIGNATORS = {
    "street": "st", "avenue": "ave", "drive": "dr", "road": "rd", "boulevard": "blvd", "lane": "ln", "court": "ct",
    "circle": "cir", "place": "pl", "terrace": "ter", "parkway": "pkwy", "highway": "hwy", "trail": "trl",
    "plaza": "plz", "square": "sq", "expressway": "expy", "freeway": "fwy", "turnpike": "tpke",
    "north": "n", "south": "s", "east": "e", "west": "w",
    "northeast": "ne", "northwest": "nw", "southeast": "se", "southwest": "sw",
    "apartment": "apt", "suite": "ste", "building": "bldg", "floor": "fl", "room": "rm", "department": "dept",
}

SPACE = r"[\s\x1c-\x1f]"


def _latin_folding() -> tuple[str, str]:
    """Letters up to U+024F that decompose to one ASCII letter and marks, and that letter in lower case."""
    pairs = []
    for code in range(0xC0, 0x250):
        base = "".join(c for c in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(c))
        if len(base) == 1 and base.isascii() and base.isalnum():
            pairs.append((chr(code), base.lower()))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


_ACCENTED, _PLAIN = _latin_folding()


def squeeze(text: Column) -> Column:
    """Runs of Unicode white space as one space, ends trimmed."""
    return F.trim(F.regexp_replace(text, f"(?U){SPACE}+", " "))


def has_text(text: Column) -> Column:
    """Not null and not only white space."""
    return F.coalesce(text.rlike(f"(?U)[^{SPACE[1:]}"), F.lit(False))


def _beyond_latin() -> str:
    """A pattern for characters that ``normalize_latin`` does not fold as the definition does."""
    def safe(code: int) -> bool:
        c = chr(code)
        return code < 0x80 or c in _ACCENTED or c == "ß" or normalize_value(f"a{c}a") == (f"a{c.lower()}a" if c.isalnum() and len(c.lower()) == 1 else "a a")

    edges = [code for code in range(0x251) if code in (0, 0x250) or safe(code) != safe(code - 1)]
    starts = [e for e in edges if e < 0x250 and safe(e)]
    ends = [next((e for e in edges if e > s and (e == 0x250 or not safe(e))), 0x250) - 1 for s in starts]
    return "[^" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in zip(starts, ends, strict=True)) + "]"


def normalize(text: Column) -> Column:
    """Accents and case folded, everything but letters and digits as single spaces, in any alphabet."""
    other = F.when(text.rlike(r"[^\x00-\x7f]") & text.rlike(_BEYOND_LATIN), text)
    return F.coalesce(normalize_exact(other), normalize_latin(text))


def normalize_latin(text: Column) -> Column:
    """``normalize`` for plain and accented Latin text, without Python."""
    plain = F.replace(F.lower(F.translate(text, _ACCENTED, _PLAIN)), F.lit("ß"), F.lit("ss"))
    return F.trim(F.regexp_replace(plain, r"[^\p{L}\p{N}]+", " "))


def normalize_value(text: str) -> str:
    """``normalize`` by its Unicode definition: compatibility decomposition, marks dropped, full case folding."""
    bare = (c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))
    return " ".join("".join(c if c.isalnum() else " " for c in "".join(bare).casefold()).split())


_BEYOND_LATIN = _beyond_latin()


@pandas_udf(StringType())
def normalize_exact(values: pd.Series) -> pd.Series:
    return values.map(normalize_value, na_action="ignore")


def tokens(text: Column) -> Column:
    return F.filter(F.split(text, " "), lambda t: t != "")


def collapse_repeats(words: Column) -> Column:
    """Each run of equal neighbours once."""
    return F.filter(words, lambda w, i: (i == 0) | (w != F.get(words, i - 1)))


def canonical_name(value: Column) -> Column:
    """Words in sorted order, repeats kept."""
    return F.array_join(F.array_sort(tokens(normalize(value))), " ")


@pandas_udf(StringType())
def _folded_alphanumerics(values: pd.Series) -> pd.Series:
    return values.map(lambda v: "".join(c for c in v.casefold() if c.isalnum()), na_action="ignore")


def canonical_number(value: Column) -> Column:
    """Letters and digits only, case folded; only text beyond ASCII goes through Python."""
    other = F.when(value.rlike(r"[^\x00-\x7f]"), value)
    return F.coalesce(_folded_alphanumerics(other), F.regexp_replace(F.lower(value), "[^a-z0-9]", ""))


def canonical_address(value: Column) -> Column:
    """Brackets dropped, ``#`` before a digit read as unit, designators shortened, label words cut from both ends."""
    marked = F.regexp_replace(F.regexp_replace(value, r"\[[^\]]*\]", " "), r"#\s*(?=\d)", " unit ")
    short = F.create_map(*[F.lit(x) for kv in DESIGNATORS.items() for x in kv])
    line = F.array_join(F.transform(tokens(normalize(marked)), lambda t: F.coalesce(F.try_element_at(short, t), t)), " ")
    for label in ("property address", "address"):
        line = F.trim(F.regexp_replace(line, f"^(?:{label}(?: |$))+", ""))
        line = F.trim(F.regexp_replace(line, f"(?:(?:^| ){label})+$", ""))
    return F.regexp_replace(line, r"(?:^|(?<= ))(\S+)(?: \1(?= |$))+", "$1")  # each run of equal words once


def canonical(field: Column, value: Column) -> Column:
    """The canonical form by field name; an unknown field is an error."""
    return (
        F.when(field == "borrower_name", canonical_name(value))
        .when(field == "property_address", canonical_address(value))
        .when(field == "loan_number", canonical_number(value))
        .when(field == "page_number", normalize(value))
        .otherwise(F.raise_error(F.concat(F.lit("unsupported field: "), F.coalesce(field, F.lit("null")))))
    )


def cluster_keys(field: Column, value: Column) -> Column:
    """Keys of which one in common is a match: the canonical form, for addresses also without spaces."""
    key = canonical(field, value)
    return F.when(field == "property_address", F.array_distinct(F.array(key, F.replace(key, F.lit(" "), F.lit(""))))).otherwise(F.array(key))


def matching_value(field: Column, value: Column) -> Column:
    return F.when(field == "loan_number", canonical_number(value)).otherwise(normalize(value))


def matching_text(field: Column, text: Column) -> Column:
    """Page text to look in; for loan numbers spaces between digits are closed."""
    plain = normalize(text)
    return F.when(field == "loan_number", F.regexp_replace(plain, r"(?U)(?<=\d)\s+(?=\d)", "")).otherwise(plain)


def effective_threshold(field: Column, floor: float) -> Column:
    found = F.create_map(*[F.lit(x) for kv in FOUND_AT.items() for x in kv])
    return F.greatest(F.lit(floor), F.try_element_at(found, field))


def preview(text: Column, most: int = 200) -> Column:
    line = squeeze(text)
    return F.when(F.length(line) > most, F.concat(F.left(line, F.lit(most)), F.lit("..."))).otherwise(line)


def non_ascii_count(text: Column) -> Column:
    return F.length(F.regexp_replace(text, r"[\x00-\x7F]", ""))


def bracket_count(text: Column) -> Column:
    return F.length(F.regexp_replace(text, r"[^\[\]]", ""))


def page_ref(source: Column, page_number: Column) -> Column:
    return F.concat(source, F.lit("#page-"), page_number.cast("string"))


def notes(reason: Column, mismatches: Column) -> Column:
    """Review reason, then the mismatched fields, joined by semicolons; empty if there are neither."""
    listed = F.when(F.size(mismatches) > 0, F.concat(F.lit("vlm mismatch: "), F.array_join(mismatches, ", ")))
    return F.concat_ws("; ", F.when(reason != "", reason), listed)


def ratio(a: str, b: str) -> float:
    """Similarity of two canonical strings, 0 if either is empty. Not symmetric: the order of arguments counts."""
    return difflib.SequenceMatcher(None, a, b).ratio() if a and b else 0.0


def window_ratio(value: str, text: str) -> float:
    """1 if ``value`` is in ``text``, else the best ratio to any run of its words, one fewer or one more.

    Each distinct run is compared once, the best possible ratio first (from the two lengths), until none left can be better.
    """
    if not value or not text:
        return 0.0
    if value in text:
        return 1.0
    words, n = text.split(), len(value.split())
    runs = {" ".join(words[i : i + k]) for k in (n - 1, n, n + 1) if k > 0 for i in range(len(words) - k + 1)}
    possible = sorted(((2 * min(len(r), len(value)) / (len(r) + len(value)), r) for r in runs), reverse=True)
    best, letters = 0.0, Counter(value)
    for most, run in possible:
        if most <= best:
            break
        if 2 * (letters & Counter(run)).total() / (len(run) + len(value)) > best:  # letters in common, in any order
            best = max(best, ratio(value, run))
    return best


def _pairwise(f: Callable[[str, str], float]):
    @pandas_udf(DoubleType())
    def apply(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for a, b in parts:
            yield pd.Series([None if x is None or y is None else f(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")

    return apply


similarity = _pairwise(ratio)
window_similarity = _pairwise(window_ratio)
