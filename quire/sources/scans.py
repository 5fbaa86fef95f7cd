"""PDF scans: files to page images to page texts, through replaceable engines.

``renderer(bytes, dpi)`` yields (page_number, image) and ``engine(image)`` returns lines as (text, score). One of each is made
for each worker process by the factories given. The defaults need libraries that may not be there and say so.
"""

from __future__ import annotations

import io
import time
import uuid
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators.coverage import repeated

Renderer = Callable[[bytes, int], Iterable[tuple[int, Any]]]
Engine = Callable[[Any], Iterable[tuple[str, float]]]


def read_pdfs(spark: SparkSession, paths: list[str]) -> DataFrame:
    """source (the file's name), content of every *.pdf (any case) under ``paths``; ValueError if two files have one name."""
    files = spark.read.format("binaryFile").load(paths).where(F.lower("path").endswith(".pdf"))
    files = files.withColumn("source", F.element_at(F.split("path", "/"), -1))
    if first := repeated(files.select("source"), ("source",)).orderBy("source").first():
        raise ValueError(f"{first.n} files are named {first.source}: their pages could not be told apart")
    return files.select("source", "content")


@lru_cache(1)
def default_renderer() -> Renderer:
    try:
        import pymupdf
    except ImportError as e:
        raise RuntimeError("rendering PDF pages needs pymupdf; pass a renderer factory instead") from e

    def render(content: bytes, dpi: int) -> Iterator[tuple[int, Any]]:
        with pymupdf.open(stream=io.BytesIO(content), filetype="pdf") as document:
            if not document.page_count:
                raise ValueError("the PDF has no pages")
            for number, page in enumerate(document, start=1):
                yield number, page.get_pixmap(dpi=dpi).tobytes("png")

    return render


@lru_cache(1)
def default_engine() -> Engine:
    raise RuntimeError("no text recognition engine is installed; pass an engine factory")


_MADE: dict[str, Any] = {}


def _made(token: str, factory: Callable[[], Any]) -> Any:
    """What ``factory`` makes, once for each worker process and use of it."""
    if token not in _MADE:
        _MADE[token] = factory()
    return _MADE[token]


def render_pages(pdfs: DataFrame, renderer: Callable[[], Renderer] = default_renderer, dpi: int = 200, on_error: str = "abort") -> DataFrame:
    """source, page_number, image, error: a row for each page, made one at a time.

    A file that fails stops the job; with ``on_error`` ``record`` it gives one row with its error.
    """
    token = uuid.uuid4().hex

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        render = _made(token, renderer)
        for pdf in batches:
            for source, content in zip(pdf["source"], pdf["content"], strict=True):
                try:
                    for number, image in render(content, dpi):
                        yield pd.DataFrame({"source": [source], "page_number": [number], "image": [image], "error": [None]})
                except Exception as e:
                    if on_error == "abort":
                        raise ValueError(f"cannot render {source}: {e}") from e
                    yield pd.DataFrame({"source": [source], "page_number": [None], "image": [None], "error": [f"{type(e).__name__}: {e}"]})

    return pdfs.select("source", "content").mapInPandas(run, "source string, page_number int, image binary, error string")


def recognise(images: DataFrame, engine: Callable[[], Engine] = default_engine) -> DataFrame:
    """source, page_number, text (lines), line_count, mean_score (null without lines), duration_seconds, error (with it the others are null)."""
    token = uuid.uuid4().hex

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        read = _made(token, engine)
        for pdf in batches:
            lines, spent = [], []
            for image in pdf["image"]:
                began = time.perf_counter()
                lines.append(list(read(image)))
                spent.append(time.perf_counter() - began)
            yield pd.DataFrame(
                {
                    "source": pdf["source"], "page_number": pdf["page_number"].astype("int32"), "text": ["\n".join(t for t, _ in x) for x in lines],
                    "line_count": pd.Series([len(x) for x in lines], dtype="int32", index=pdf.index),
                    "mean_score": pd.Series([sum(s for _, s in x) / len(x) if x else None for x in lines], dtype="float64", index=pdf.index),
                    "duration_seconds": pd.Series(spent, dtype="float64", index=pdf.index),
                }
            )

    found = images.where("error is null").select("source", "page_number", "image")
    read = found.mapInPandas(run, "source string, page_number int, text string, line_count int, mean_score double, duration_seconds double").withColumn("error", F.lit(None).cast("string"))
    nothing = {"text": "string", "line_count": "int", "mean_score": "double", "duration_seconds": "double"}
    failed = images.where("error is not null").select("source", "page_number", *[F.lit(None).cast(t).alias(c) for c, t in nothing.items()], "error")
    return read.unionByName(failed)


def scan(spark: SparkSession, paths: list[str], renderer=default_renderer, engine=default_engine, dpi: int = 200, on_error: str = "abort") -> DataFrame:
    """Files to page texts; see ``render_pages`` for files that fail."""
    return recognise(render_pages(read_pdfs(spark, paths), renderer, dpi, on_error), engine)
