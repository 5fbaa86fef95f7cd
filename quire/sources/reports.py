"""Strict readers of JSON reports: one file is one document with a list of pages.

Files are read in pieces, cut into their pages, and these parsed to VARIANT, whose schema tells 1, 1.0, "1" and true apart; nothing is coerced. What is
wrong is returned as violations (rule order, then file and position); ``strict`` raises the first.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.functions.scores import CATEGORIES, OTHER
from quire.functions.text import FIELDS, page_ref
from quire.operators.coverage import repeated
from quire.operators.validate import Rule, require, simplex, violations
from quire.plans import scratch

WHOLE = "^(BIGINT|TINYINT|SMALLINT|INT)$"
NUMBER = "^(BIGINT|TINYINT|SMALLINT|INT|DOUBLE|FLOAT|DECIMAL.*)$"


def _qualified(spark: SparkSession, path: str) -> str:
    """The path as a file's metadata name it: absolute, with its scheme, encoded, one slash after the scheme."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return re.sub(r"^(\w+):/+", r"\1:/", system.makeQualified(where).toUri().toString())


_PIECE = "}"  # files are read piece by piece, so that none is in memory as a whole
_BATCH = 4 << 20
_TOKEN = re.compile(rb'[{}\[\],:"]')
_STRING_END = re.compile(rb'(?:[^"\\]|\\.)*+"', re.DOTALL)


class Cutter:
    """Cuts a report, fed in pieces, into the entries of its member ``pages`` and the rest, in which a 0 stands for each entry.

    Nothing is judged here: the report is one JSON value if and only if the rest and each entry are.
    """

    def __init__(self):
        self.depth, self.quoted, self.in_pages = 0, False, False
        self.name, self.key = [], None  # at depth 1: the string being read, and the one before the last colon
        self.rest, self.entry, self.size = [], [], 0

    def _end_entry(self) -> list[bytes]:
        entry = b"".join(self.entry).strip(b" \t\r\n")
        self.entry = []
        if entry:
            self.rest.append(b"0")
        return [entry] if entry else []

    def feed(self, piece: bytes) -> list[bytes]:
        """The entries that end in ``piece``."""
        self.size += len(piece)
        done, at, kept = [], 0, 0  # what lies between kept and at is not copied yet

        def keep(upto: int) -> None:
            nonlocal kept
            (self.entry if self.in_pages else self.rest).append(piece[kept:upto])
            kept = upto

        while at < len(piece):
            if self.quoted:
                end = _STRING_END.match(piece, at)
                upto = end.end() if end else len(piece)
                if self.depth == 1:
                    self.name.append(piece[at:upto])
                self.quoted, at = end is None, upto
                continue
            found = _TOKEN.search(piece, at)
            if not found:
                break
            at, token = found.end(), found.group()
            if token == b'"':
                self.quoted = True
                if self.depth == 1:
                    self.name = [b'"']
            elif token in b"{[":
                self.depth += 1
                if token == b"[" and self.depth == 2 and self.key == "pages":
                    keep(at)
                    self.in_pages = True
            elif token in b"}]":
                self.depth -= 1
                if self.in_pages and self.depth == 1:
                    keep(at - 1)
                    done += self._end_entry()
                    self.in_pages, self.key = False, None
            elif token == b",":
                if self.depth == 1:
                    self.key = None
                elif self.in_pages and self.depth == 2:
                    keep(at - 1)
                    done += self._end_entry()
                    self.rest.append(b",")
                    kept = at
            elif self.depth == 1:
                try:
                    self.key = json.loads(b"".join(self.name))
                except ValueError:
                    self.key = None
        keep(len(piece))
        return done

    def end(self, size: int | None) -> tuple[list[bytes], bytes]:
        """What ends in the last piece's separator, if the file of ``size`` bytes has one there, and the rest. The size of compressed files is
        not known (null): there the separator is taken to be what it can only be in a whole report."""
        over = (self.depth > 0 and not self.quoted) if size is None else size - self.size
        mark = over in (3, 4)  # a byte order mark, which readers of lines skip and JSON forbids
        done = self.feed(_PIECE.encode()) if over in (1, 4) else []
        if self.in_pages:
            self.rest += self.entry
        return done, (b"\xef\xbb\xbf" if mark else b"") + b"".join(self.rest)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of files (uri, size, value), in order, one file after the other -> uri, position (null: the rest), json."""
    rows, held = [], 0
    uri = size = cutter = None
    position = 0

    def add(entries: list[bytes], first: int | None) -> None:
        nonlocal held
        for i, e in enumerate(entries):
            rows.append((uri, None if first is None else first + i, e))
            held += len(e)

    def flush() -> pa.RecordBatch:
        nonlocal rows, held
        out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.int32(), pa.binary()), strict=True)], ["uri", "position", "json"])
        rows, held = [], 0
        return out

    def close() -> None:
        done, rest = cutter.end(size)
        add(done, position)
        add([rest], None)

    for batch in batches:
        for path, length, piece in zip(*[batch.column(i) for i in range(3)], strict=True):
            if cutter is None or path.as_py() != uri:
                if cutter:
                    close()
                uri, size, cutter, position = path.as_py(), length.as_py(), Cutter(), 0
                done = cutter.feed(piece.as_py())
            else:
                done = cutter.feed(_PIECE.encode() + piece.as_py())
            add(done, position)
            position += len(done)
            if held >= _BATCH or len(rows) >= 10_000:
                yield flush()
    if cutter:
        close()
    if rows:
        yield flush()


def _parsed(spark: SparkSession, paths: list[str]) -> DataFrame:
    """uri, position (null: the report without its pages), json (VARIANT; null if it is not one JSON value), through the shared folder.

    A file goes through one task, in order and piece by piece; what is held is one page of it and what is not pages.
    """
    plain = [re.sub(r"([\[\]{}*?\\])", r"\\\1", p) for p in dict.fromkeys(paths)]
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    sizes = [1]
    for p in dict.fromkeys(paths):
        where = jvm.org.apache.hadoop.fs.Path(p)
        system = where.getFileSystem(conf)
        if system.exists(where):  # if not, the reader says so
            sizes.append(system.getFileStatus(where).getLen())
    own = spark.newSession()  # no file is split there: a part takes as much as the largest file, or an equal share
    for name, value in (
        ("spark.sql.files.maxPartitionBytes", max(*sizes, sum(sizes) // spark.sparkContext.defaultParallelism)), ("spark.sql.files.minPartitionNum", 1),
        ("spark.sql.files.openCostInBytes", 1 << 16), ("spark.sql.execution.arrow.maxBytesPerBatch", _BATCH), ("spark.sql.adaptive.enabled", "true"),
    ):
        own.conf.set(name, str(value))
    size = F.when(~F.col("_metadata.file_path").rlike(r"\.(gz|bz2|deflate|lz4|snappy|zst|zstd)$"), F.col("_metadata.file_size"))  # of plain files
    pieces = own.read.text(plain, lineSep=_PIECE).select(F.regexp_replace(F.col("_metadata.file_path"), r"^(\w+):/+", "$1:/").alias("uri"), size.alias("size"), F.col("value").cast("binary").alias("value"))
    cut = pieces.mapInArrow(_cut, "uri string, position int, json binary")
    # in brackets, as the parser does not look at what follows a value
    value = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), F.col("json").cast("string"), F.lit("]"))), "$[0]", "variant")
    path = scratch.folder(spark, "pages", drop=True)
    cut.select("uri", "position", value.alias("json")).write.option("compression", "zstd").parquet(path)
    return spark.read.schema("uri string, position int, json variant").parquet(path)


def read_reports(spark: SparkSession, paths: list[str]) -> tuple[DataFrame, DataFrame]:
    """Reports: input_ord, input_file, uri, raw (VARIANT, null if the file is not one JSON object, or empty; a 0 stands for each of its pages),
    and the pages of the sound ones: uri, position (0, 1, ...), page (VARIANT).

    A path is one file, taken as it is written: no patterns. A path given twice is read as two inputs.
    """
    files = spark.createDataFrame([(i, p, _qualified(spark, p)) for i, p in enumerate(paths)], "input_ord int, input_file string, uri string")
    parsed = _parsed(spark, paths)
    broken = parsed.where("json is null").select("uri").distinct()
    heads = parsed.where("position is null").where(F.schema_of_variant("json").startswith("OBJECT")).join(F.broadcast(broken), "uri", "left_anti")
    reports = files.join(heads.select("uri", F.col("json").alias("raw")), "uri", "left").select("input_ord", "input_file", "uri", "raw")
    return reports, parsed.where("position is not null").withColumnRenamed("json", "page")


def kind(raw: Column, path: str) -> Column:
    """Type of a member; null if absent, VOID if null."""
    return F.schema_of_variant(F.try_variant_get(raw, path, "variant"))


def text(raw: Column, path: str) -> Column:
    return F.when(kind(raw, path) == "STRING", F.try_variant_get(raw, path, "string"))


def whole(raw: Column, path: str) -> Column:
    """An integer; not 1.0, "1" or true."""
    return F.when(kind(raw, path).rlike(WHOLE), F.try_variant_get(raw, path, "long"))


def number(raw: Column, path: str) -> Column:
    """Any JSON number; not true."""
    return F.when(kind(raw, path).rlike(NUMBER), F.try_variant_get(raw, path, "double"))


def flag(raw: Column, path: str) -> Column:
    return F.when(kind(raw, path) == "BOOLEAN", F.try_variant_get(raw, path, "boolean"))


def absent(raw: Column, path: str) -> Column:
    found = kind(raw, path)
    return found.isNull() | (found == "VOID")


def pages_of(spark: SparkSession, paths: list[str], **members: Column) -> DataFrame:
    """A row for each entry of ``$.pages``: input_ord, input_file, sound (the file is a JSON object), ``members`` of its ``raw``, position
    (0, 1, ...), page (VARIANT); one row with nulls for a report without. The report itself does not go with its pages."""
    reports, pages = read_reports(spark, paths)
    heads = reports.select("input_ord", "input_file", "uri", F.col("raw").isNotNull().alias("sound"), *[c.alias(n) for n, c in members.items()])
    with_pages = F.broadcast(heads.where("sound")).join(pages, "uri")  # heads: one row for each path given
    without = heads.join(pages.select("uri").distinct().withColumn("_any", F.lit(True)), "uri", "left").where(~F.col("sound") | F.col("_any").isNull()).drop("_any")
    none = without.withColumn("position", F.lit(None).cast("int")).withColumn("page", F.lit(None).cast("variant"))
    return with_pages.unionByName(none).drop("uri")


@dataclass(frozen=True)
class Loaded:
    """Typed rows and what is wrong with the files they come from."""

    rows: DataFrame
    violations: DataFrame


def _page_rules(extra: list[Rule]) -> list[Rule]:
    p = F.col("page")
    return [
        Rule("object", ~F.col("sound"), "the file is not a JSON object"),
        Rule("pages", F.col("sound") & p.isNull(), "no pages"),
        Rule("page", p.isNotNull() & ~F.schema_of_variant(p).startswith("OBJECT"), "a page is not an object"),
        Rule("page number", p.isNotNull() & (F.col("page_number").isNull() | (F.col("page_number") < 1)), "a page number is not a positive integer"),
        Rule("page order", F.col("page_number") <= F.col("_before"), "page numbers do not increase"),
        *extra,
    ]


def _load(rows: DataFrame, rules: list[Rule], strict: bool, output: list) -> Loaded:
    # the page before is sought among rows without texts: a window holds thousands of its rows in memory
    later = [i for i, r in enumerate(rules) if r.name == "page order"]
    checked = rows.select("input_ord", "position", "page_number", *[r.broken.alias(f"_broken{i}") for i, r in enumerate(rules) if i not in later])
    checked = checked.withColumn("_before", F.lag("page_number").over(Window.partitionBy("input_ord").orderBy("position")))  # one file's pages
    fixed = [Rule(r.name, r.broken if i in later else F.col(f"_broken{i}"), r.message) for i, r in enumerate(rules)]
    key = ["input_ord", "position"]
    if strict:
        require(checked, fixed, key)
    return Loaded(rows.where("page is not null").select(*output), violations(checked, fixed, key))


def load_ocr(spark: SparkSession, paths: list[str], strict: bool = True) -> Loaded:
    """Page texts: input_ord, input_file, source, page_number, page_ref, text, line_count, mean_score, duration_seconds.

    The last three may be absent or null. A page_ref that appears twice over all files is a violation too.
    """
    p = F.col("page")
    rows = pages_of(spark, paths, source=text(F.col("raw"), "$.source")).withColumn("page_number", whole(p, "$.page_number"))
    rows = rows.withColumn("text", text(p, "$.text"))
    optional = [
        Rule(name, ~absent(p, f"$.{name}") & get(p, f"$.{name}").isNull(), f"{name} is not a number")
        for name, get in (("line_count", whole), ("mean_score", number), ("duration_seconds", number))
    ]
    rules = _page_rules(
        [
            Rule("source", F.col("sound") & (F.coalesce("source", F.lit("")) == ""), "source is not a non-empty string"),
            Rule("text", p.isNotNull() & F.col("text").isNull(), "a page's text is not a string"),
            *optional,
        ]
    )
    out = [
        "input_ord", "input_file", "position", "source", "page_number", page_ref(F.col("source"), F.col("page_number")).alias("page_ref"), "text",
        whole(p, "$.line_count").alias("line_count"), number(p, "$.mean_score").alias("mean_score"), number(p, "$.duration_seconds").alias("duration_seconds"),
    ]
    loaded = _load(rows, rules, strict, out)
    twice = repeated(loaded.rows.where("page_ref is not null"), ("page_ref",))
    if strict and (first := twice.orderBy("page_ref").first()):
        raise ValueError(f"page appears more than once: {first.page_ref}")
    again = loaded.rows.select("input_ord", "position", "page_ref").join(twice.select("page_ref"), "page_ref")
    found = again.select(F.lit(len(rules)).alias("rule_no"), F.lit("page_ref twice").alias("rule"), "input_ord", F.col("position").cast("long").alias("position"), F.concat(F.lit("page appears more than once: "), F.col("page_ref")).alias("message"))
    return Loaded(loaded.rows, loaded.violations.withColumn("position", F.col("position").cast("long")).unionByName(found))


def load_classification(spark: SparkSession, paths: list[str], strict: bool = True) -> Loaded:
    """Classified pages, every member checked; raw keeps the page as it was."""
    p = F.col("page")
    rows = pages_of(spark, paths).withColumn("page_number", whole(p, "$.page_number"))
    shares = F.create_map(*[x for c in CATEGORIES for x in (F.lit(c), number(p, f"$.probabilities.{c}"))])
    rows = (
        rows.withColumn("page_ref", text(p, "$.page_ref")).withColumn("category", text(p, "$.category")).withColumn("confidence", number(p, "$.confidence"))
        .withColumn("probabilities", F.when(~absent(p, "$.probabilities"), shares)).withColumn("needs_review", flag(p, "$.needs_review"))
        .withColumn("review_reason", text(p, "$.review_reason"))
    )
    there = p.isNotNull() & ~absent(p, "$.category")
    named = F.map_keys(F.try_variant_get(p, "$.probabilities", "map<string,variant>"))
    known = F.array(*[F.lit(c) for c in CATEGORIES])
    same_names = (F.size(F.array_except(named, known)) == 0) & (F.size(F.array_except(known, named)) == 0)
    some_null = F.exists(F.map_entries("probabilities"), lambda e: e["value"].isNull() & F.array_contains(named, e["key"]))
    rules = _page_rules(
        [
            Rule("page_ref", p.isNotNull() & (F.coalesce("page_ref", F.lit("")) == ""), "page_ref is not a non-empty string"),
            Rule("category", there & ~F.coalesce(F.col("category").isin(*CATEGORIES), F.lit(False)), "unknown category"),
            Rule("confidence", there & ~F.coalesce(F.col("confidence").between(0, 1), F.lit(False)), "confidence is not a number in [0, 1]"),
            Rule("needs_review", p.isNotNull() & F.col("needs_review").isNull(), "needs_review is not a boolean"),
            Rule("probability keys", there & ~F.coalesce(same_names, F.lit(False)), "probabilities do not name the categories"),
            Rule("probability value", there & some_null, "a probability is not a number"),
            *[Rule(r.name, there & r.broken, r.message) for r in simplex() if r.name != "probability keys"],
        ]
    )
    out = ["input_ord", "input_file", "position", "page_number", "page_ref", "category", "confidence", "probabilities", "needs_review", "review_reason", F.col("page").alias("raw")]
    return _load(rows, rules, strict, out)


def category_signals(classified: DataFrame) -> DataFrame:
    """page_ref, category, confidence: null both for ``other``, for pages under review and for pages without category."""
    usable = (F.col("category") != OTHER) & ~F.coalesce("needs_review", F.lit(False))
    order = [c for c in ("input_ord", "position") if c in classified.columns]
    return classified.select(*order, "page_ref", F.when(usable, F.col("category")).alias("category"), F.when(usable, F.col("confidence")).alias("confidence"))


def later_file_wins(signals: DataFrame, key: str = "page_ref") -> DataFrame:
    """One row for each ``key``: of several, that of the last input file (by input_ord), and in one file of the last position."""
    order = [c for c in ("input_ord", "position") if c in signals.columns]
    rows = signals.select(key, F.struct(*order, F.struct(*[c for c in signals.columns if c != key]).alias("row")).alias("_r"), F.struct(*order).alias("_o"))
    return rows.groupBy(key).agg(F.max_by("_r", "_o").alias("_r")).select(key, "_r.row.*")


def category_labels(spark: SparkSession, paths: list[str]) -> DataFrame:
    """category, label from the ``categories`` objects of classification reports; ValueError unless each has non-empty strings and names ``other``."""
    reports, _ = read_reports(spark, paths)
    named = reports.select("input_ord", "input_file", F.try_variant_get("raw", "$.categories", "map<string,string>").alias("labels"))
    sound = (F.size("labels") > 0) & F.map_contains_key("labels", OTHER) & F.forall(F.map_values("labels"), lambda v: F.coalesce(v != "", F.lit(False))) & ~F.map_contains_key("labels", "")
    if first := named.where(~F.coalesce(sound, F.lit(False))).orderBy("input_ord").first():  # one row a file
        raise ValueError(f"{first.input_file}: categories must map names to labels and name {OTHER!r}")
    return named.select(F.explode("labels").alias("category", "label")).distinct()


def printed_number(value: Column, strict: bool = False) -> Column:
    """Digits as a number, blank and null as null; anything else null, or an error if ``strict``."""
    digits = F.trim(value)
    odd = F.raise_error(F.concat(F.lit("printed page number is not digits: "), value)).cast("long") if strict else F.lit(None).cast("long")
    return F.when(value.isNull() | (digits == ""), None).when(digits.rlike(r"(?U)^\d+$"), F.try_to_number(digits, F.lit("999999999999999999")).cast("long")).otherwise(odd)


def load_printed_numbers(spark: SparkSession, paths: list[str], strict: bool = False) -> DataFrame:
    """page_ref, printed_number from extraction reports; ``strict`` raises on the first page that is not sound."""
    rows = extraction_pages(spark, paths)
    if strict:
        require(rows, extraction_rules(), ["input_ord", "position"])
    return rows.where("page is not null").select("input_ord", "position", "page_ref", printed_number(F.col("printed"), strict).alias("printed_number"))


def extraction_pages(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Pages of extraction reports: input_ord, input_file, position, page (VARIANT), page_number, page_ref, printed, and for each
    field similarity and needs_review, null where they are absent or of another type."""
    p = F.col("page")
    rows = pages_of(spark, paths).withColumn("page_number", whole(p, "$.page_number")).withColumn("page_ref", text(p, "$.page_ref"))
    rows = rows.withColumn("printed", text(p, "$.extracted.page_number"))
    for f in FIELDS:
        rows = rows.withColumn(f"{f}_similarity", number(p, f"$.verification.{f}.similarity")).withColumn(f"{f}_needs_review", flag(p, f"$.verification.{f}.needs_review"))
    return rows


def extraction_rules() -> list[Rule]:
    """What an extraction page must be: an object with a page_ref, string or null fields, and for each checked field a similarity in [0, 1] or
    null and a boolean flag."""
    p = F.col("page")
    there = p.isNotNull() & F.schema_of_variant(p).startswith("OBJECT")
    out = [
        Rule("object", ~F.col("sound"), "the file is not a JSON object"),
        Rule("pages", F.col("sound") & p.isNull(), "no pages"),
        Rule("page", p.isNotNull() & ~there, "a page is not an object"),
        Rule("page_ref", there & (F.coalesce("page_ref", F.lit("")) == ""), "page_ref is not a non-empty string"),
        Rule("extracted", there & ~F.coalesce(kind(p, "$.extracted").startswith("OBJECT"), F.lit(False)), "extracted is not an object"),
        Rule("printed number", there & ~absent(p, "$.extracted.page_number") & F.col("printed").isNull(), "the printed page number is not a string or null"),
    ]
    for f in FIELDS:
        checked, like = ~absent(p, f"$.verification.{f}"), F.col(f"{f}_similarity")
        out.append(Rule(f"{f} similarity", checked & ~absent(p, f"$.verification.{f}.similarity") & ~F.coalesce(like.between(0, 1), F.lit(False)), f"similarity of {f} is not a number in [0, 1] or null"))
        out.append(Rule(f"{f} review flag", checked & F.col(f"{f}_needs_review").isNull(), f"needs_review of {f} is not a boolean"))
    return out
