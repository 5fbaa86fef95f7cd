"""Command line: ``python -m quire.cli COMMAND ...``; each command of the page engine takes any number of inputs.

    ocr        PDF files to page texts                      classify   page texts to categories
    verify     second opinions on unsure categories         extract    fields from page images, checked against the texts
    match      neighbouring pages to groups                 pipeline   PDF files to page labels, documents and field records
    texts      what is wrong with page text reports

Reports go to --out (a file for one input, a folder for several), to stdout with --stdout, else beside each input.
Messages go to stderr; exit code 0 or 1.
"""

from __future__ import annotations

import argparse
import logging
import sys
import tempfile
import time
from collections.abc import Callable
from functools import partial
from pathlib import Path

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import scores as S
from quire.functions import text as T
from quire.operators import coverage, fields, validate
from quire.plans import assembly, document
from quire.sources import models, paths, reports, scans, sinks

log = logging.getLogger("quire")


class Tools:
    """What talks to the world, replaceable: model transport, page renderer, text recognition."""

    def __init__(self, transport: models.Transport = models.http, renderer: Callable = scans.default_renderer, engine: Callable = scans.default_engine, engine_name: str = "default", device: str = "cpu"):
        self.transport, self.renderer, self.engine, self.engine_name, self.device = transport, renderer, engine, engine_name, device


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="quire", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    commands = p.add_subparsers(dest="command", required=True)

    def command(name: str, inputs: str, *model: str, timeout: float = 60.0) -> argparse.ArgumentParser:
        c = commands.add_parser(name)
        c.add_argument("inputs", nargs="+", metavar=inputs)
        c.add_argument("--out")
        c.add_argument("--stdout", action="store_true")
        c.add_argument("--env-file", default=".env")
        c.add_argument("--key-name", default="", help="setting that holds the service's key; none is sent without it")
        for m in model:
            c.add_argument(f"--{m}base-url", default="http://localhost:8000")
            c.add_argument(f"--{m}model", default="")
        c.add_argument("--timeout", type=float, default=timeout)
        return c

    def limits(c: argparse.ArgumentParser, **values: float) -> None:
        for name, value in values.items():
            c.add_argument(f"--{name.replace('_', '-')}", type=type(value), default=value)

    limits(command("ocr", "PDF"), dpi=200)
    limits(command("classify", "OCR", ""), confidence_threshold=0.5, max_state_chars=30_000)
    c = command("verify", "CATEGORIES", "", timeout=120.0)
    c.add_argument("--ocr")
    limits(c, confidence_threshold=0.5, margin_threshold=0.5, max_state_chars=30_000, max_tokens=128, seed=0)
    c = command("extract", "PDF", "", timeout=120.0)
    c.add_argument("--ocr")
    limits(c, dpi=200, max_tokens=512, seed=0, mismatch_threshold=0.75, review_margin=0.10)
    c = command("match", "OCR", "")
    c.add_argument("--vectors", help="Parquet of (page_ref, vector) instead of a model")
    c.add_argument("--categories-json")
    c.add_argument("--vlm-json")
    c.add_argument("--prefix", default="Document: ")
    limits(c, batch_size=8, threshold=S.EDGE_THRESHOLD, min_embedding_similarity=S.MIN_EMBEDDING)
    for name, weight in zip(("embedding", "category", "page-number"), S.WEIGHTS, strict=True):
        c.add_argument(f"--weight-{name}", type=float, default=weight)
    limits(command("pipeline", "PDF", "classify-", "verify-", "extract-", "embed-"), dpi=200)
    command("texts", "OCR")
    return p


def _model(args: argparse.Namespace, tools: Tools, prefix: str = "", **more) -> models.Model:
    headers = {"Authorization": f"Bearer {paths.secret(args.key_name, args.env_file)}"} if args.key_name else None
    transport = partial(tools.transport, headers=headers) if headers else tools.transport
    get = lambda name, default: getattr(args, name, default)
    return models.Model(
        get(f"{prefix}base_url", ""), get(f"{prefix}model", ""), transport, args.timeout, batch=get("batch_size", 8), seed=get("seed", 0), max_tokens=get("max_tokens", 512), **more
    )


def _settings(args: argparse.Namespace) -> document.Settings:
    known = {
        "confidence_threshold": "min_confidence", "margin_threshold": "min_margin", "max_state_chars": "max_chars", "mismatch_threshold": "floor",
        "review_margin": "review_margin", "min_embedding_similarity": "min_embedding", "threshold": "edge_threshold",
    }
    ranges = {"max_state_chars": (1, 1 << 31), "min_embedding_similarity": (-1, 1)}
    given = {k: getattr(args, k) for k in known if hasattr(args, k)}
    validate.parameters(**{k: (v, *ranges.get(k, (0, 1))) for k, v in given.items()})
    positive = {k: (getattr(args, k), low, 1 << 31) for k, low in (("dpi", 1), ("timeout", 1e-9), ("max_tokens", 1), ("batch_size", 1)) if hasattr(args, k)}
    validate.parameters(**positive)
    values = {known[k]: v for k, v in given.items()}
    if hasattr(args, "weight_embedding"):
        values["weights"] = (args.weight_embedding, args.weight_category, args.weight_page_number)
    return document.Settings(**values)


def _ocr(spark: SparkSession, files: list[str]) -> DataFrame:
    return reports.load_ocr(spark, files).rows


def _siblings(args: argparse.Namespace, kind: str, explicit: str | None) -> list[str]:
    """The report of ``kind`` beside each input, or the explicit one; all must be there."""
    found = [str(p) for p in paths.auxiliary(args.inputs, kind, explicit)]
    if len(found) < len(args.inputs):
        raise FileNotFoundError(f"no {paths.SUFFIXES[kind]} beside every one of {', '.join(args.inputs)}")
    return found


def ocr(spark, args, tools) -> DataFrame:
    _settings(args)
    return assembly.ocr_report(scans.scan(spark, args.inputs, tools.renderer, tools.engine, args.dpi), tools.engine_name, args.dpi, tools.device)


def classify(spark, args, tools, scratch: str) -> DataFrame:
    s, model = _settings(args), _model(args, tools)
    pages = _ocr(spark, args.inputs).select("source", "page_number", "text", "line_count", "mean_score", "duration_seconds")
    return assembly.classification_report(document.written(document.classify(pages, model, s), scratch, "classified"), model, s)


def verify(spark, args, tools, scratch: str) -> DataFrame:
    s, model = _settings(args), _model(args, tools, on_error="record")
    pages = _ocr(spark, _siblings(args, "ocr", args.ocr)).select("source", "page_number", "page_ref", "text")
    found = reports.load_classification(spark, args.inputs).rows.withColumn("source", F.regexp_extract("page_ref", r"(?s)^(.*)#page-\d+$", 1))
    if first := coverage.page_lists_differ(pages, found).orderBy("source", "page_number").first():
        raise ValueError(f"texts and categories are not of the same pages: {first.source} page {first.page_number} ({first.problem})")
    more = [F.try_variant_get("raw", f"$.usage.{n}", "long").alias(n) for n in ("input_tokens", "output_tokens")]
    seconds = F.try_variant_get("raw", "$.timings_seconds.classify_seconds", "double").alias("classify_seconds")
    rows = found.select("source", "page_number", "page_ref", "category", "confidence", "probabilities", "needs_review", "review_reason", *more, seconds).join(pages.select("source", "page_number", "text"), document.PAGE)
    document.require_short(rows, s.max_chars)
    return assembly.verification_report(document.written(document.verify(rows, model, s), scratch, "reviewed"), model, s)


def extract(spark, args, tools, scratch: str) -> DataFrame:
    s, model = _settings(args), _model(args, tools)
    pages = _ocr(spark, _siblings(args, "ocr", args.ocr)).select("source", "page_number", "text")
    images = document.written(scans.render_pages(scans.read_pdfs(spark, args.inputs), tools.renderer, args.dpi), scratch, "images")
    if first := coverage.page_counts_differ(pages, images).orderBy("source").first():
        raise ValueError(f"{first.source}: {first.left_n} page texts and {first.right_n} page images")
    extracted = document.written(document.extract(images, model), scratch, "extracted")
    return assembly.extraction_report(extracted, document.written(document.check(extracted, pages, s), scratch, "checks"), model, s)


def match(spark, args, tools, scratch: str) -> DataFrame:
    s = _settings(args)
    pages = _ocr(spark, args.inputs).select("source", "page_number", "page_ref", "text")
    asked = pages.withColumn("has_text", T.has_text(F.col("text")))
    if args.vectors:
        given = spark.read.parquet(args.vectors).select("page_ref", "vector")
        vectors = pages.join(given, "page_ref").select("source", "page_number", "vector", F.lit(0).alias("request"), F.lit(0.0).alias("seconds"))
    else:
        vectors = document.written(models.embed(asked.where("has_text").select("source", "page_number", "text"), _model(args, tools), args.prefix).drop("text"), scratch, "vectors")
    categories, numbers = paths.auxiliary(args.inputs, "categories", args.categories_json), paths.auxiliary(args.inputs, "vlm", args.vlm_json)
    signals = pages.select("source", "page_number", "page_ref")
    for files, load, columns in (
        (categories, lambda f: reports.category_signals(reports.load_classification(spark, f).rows), {"category": "string", "confidence": "double"}),
        (numbers, lambda f: reports.load_printed_numbers(spark, f, strict=True), {"printed_number": "long"}),
    ):
        if not files:
            signals = signals.withColumns({c: F.lit(None).cast(t) for c, t in columns.items()})
            continue
        found = reports.later_file_wins(load([str(p) for p in files]))
        wrong = coverage.auxiliary_coverage(_of_inputs(asked, files), found, ("page_ref",)).orderBy("problem", "page_ref")
        if first := wrong.limit(5).collect():
            raise ValueError(f"pages do not match the page texts: {[f'{r.problem} {r.page_ref}' for r in first]}")
        signals = signals.join(found.select("page_ref", *columns), "page_ref", "left")
    rows = signals.join(vectors.select("source", "page_number", "vector"), document.PAGE, "left")
    edges, members = document.edges_and_members(rows, s)
    return assembly.match_report(rows, edges, members, vectors, s)


def _of_inputs(pages: DataFrame, files: list[Path]) -> DataFrame:
    """The pages whose source has a report among ``files``, which lie beside the inputs and share their names."""
    names = [p.name.removesuffix(paths.SUFFIXES["categories"]).removesuffix(paths.SUFFIXES["vlm"]) for p in files]
    stem = F.regexp_replace("source", r"\.[^.]*$", "")
    every = pages.select(stem.alias("s")).distinct().where(F.col("s").isin(names)).count()
    return pages.where(stem.isin(names)) if every == len(names) else pages


def pipeline(spark, args, tools, scratch: str) -> DataFrame:
    _settings(args)
    spent: dict[str, float] = {}

    def timed(name: str, make: Callable[[], DataFrame]) -> DataFrame:
        began = time.perf_counter()
        out = document.written(make(), scratch, name)
        spent[name] = time.perf_counter() - began
        return out

    images = timed("render", lambda: scans.render_pages(scans.read_pdfs(spark, args.inputs), tools.renderer, args.dpi))
    pages = timed("ocr", lambda: scans.recognise(images, tools.engine))
    began = time.perf_counter()
    ask = lambda prefix, **more: _model(args, tools, f"{prefix}_", **more)
    out = document.run(pages, images, ask("classify"), ask("verify", on_error="record"), ask("extract"), ask("embed"), f"{scratch}/run")
    if first := validate_cover(pages, out.documents):
        raise ValueError(f"documents do not cover the pages: {first}")
    labels, docs, loans = (document.written(d, scratch, n) for d, n in ((out.page_labels, "labels"), (out.documents, "documents"), (out.loan_fields, "loan-fields")))
    spent["models_and_matching"] = time.perf_counter() - began
    return assembly.result_report(labels, docs, loans, spent)


def validate_cover(pages: DataFrame, documents: DataFrame) -> list:
    from quire.operators.adjacency import cover_violations

    return cover_violations(pages, documents).orderBy("source", "page_number").limit(5).collect()


def texts(spark, args, tools) -> DataFrame:
    wrong = reports.load_ocr(spark, args.inputs, strict=False).violations
    listed = wrong.agg(F.array_sort(F.collect_list(F.struct("input_ord", "position", "rule", "message"))).alias("violations"))
    return listed.select(F.lit("violations").alias("source"), F.struct("violations").alias("report"))


KINDS = {"ocr": "ocr", "classify": "categories", "verify": "category_review", "extract": "vlm", "match": "matches", "pipeline": "result"}


def _deliver(args: argparse.Namespace, found: list[tuple[str, str]]) -> None:
    if args.stdout or args.command == "texts" and not args.out:
        for _, report in found:
            print(report)
        return
    by_stem = {paths.stem(i): i for i in args.inputs}
    for source, report in found:
        if args.out and len(found) == 1:
            target = Path(args.out)
        elif args.out:
            target = Path(args.out) / paths.beside(source, KINDS[args.command]).name
        else:
            target = paths.beside(by_stem.get(paths.stem(source), args.inputs[0] if len(found) == 1 else source), KINDS[args.command])
        target.parent.mkdir(parents=True, exist_ok=True)
        sinks.write_text(target, report)
        log.info("wrote %s", target)


def main(argv: list[str] | None = None, tools: Tools | None = None) -> int:
    args = parser().parse_args(argv)
    logging.basicConfig(stream=sys.stderr, level=logging.INFO)
    spark = SparkSession.builder.appName("quire").getOrCreate()
    tools = tools or Tools()
    try:
        if args.command in ("ocr", "texts"):
            found = list(assembly.texts(globals()[args.command](spark, args, tools)))
        else:
            shared = spark.conf.get("spark.checkpoint.dir", None)
            with tempfile.TemporaryDirectory(dir=None if shared else "/tmp") as local:
                from quire.plans.scratch import folder

                scratch = folder(spark, args.command) if shared else f"file://{local}/{args.command}"
                found = list(assembly.texts(globals()[args.command](spark, args, tools, scratch)))
        _deliver(args, found)
    except (ValueError, OSError, RuntimeError, PySparkException) as e:
        log.error("%s", str(e).splitlines()[0] if str(e) else type(e).__name__)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
