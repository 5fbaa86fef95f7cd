"""Remote models as table operators: requests from workers, answers as columns, a replaceable transport.

``transport(url, payload, timeout)`` returns the decoded answer. Answers are checked in full; what a failure does is the caller's
choice: ``abort`` stops the job, ``record`` puts it into the row's ``error``. Nothing is retried: run with spark.task.maxFailures=1
and without speculation, and write the answers before using them twice.
"""

from __future__ import annotations

import base64
import json
import math
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame

from quire.functions.scores import CATEGORIES
from quire.functions.text import FIELDS

Transport = Callable[[str, "dict | None", float], Any]


class AnswerError(ValueError):
    """A model's answer that does not say what it must."""


def http(url: str, payload: dict | None = None, timeout: float = 60.0, headers: dict[str, str] | None = None) -> Any:
    """POST ``payload`` as JSON (GET without one) and decode the JSON answer."""
    data = None if payload is None else json.dumps(payload).encode()
    request = urllib.request.Request(url, data, {"Content-Type": "application/json", **(headers or {})})
    try:
        with urllib.request.urlopen(request, timeout=timeout) as answer:
            return json.loads(answer.read())
    except urllib.error.HTTPError as e:
        raise RuntimeError(f"HTTP {e.code}: {e.read()[:200].decode(errors='replace')}") from e
    except (urllib.error.URLError, TimeoutError) as e:
        raise RuntimeError(f"cannot reach {url}: {e}") from e
    except json.JSONDecodeError as e:
        raise AnswerError("the answer is not JSON") from e


def pick_model(listing: Any, wanted: str) -> str:
    """The id equal to ``wanted``, else the only one that contains it in any case."""
    ids = [m["id"] for m in listing["data"]] if isinstance(listing, dict) and isinstance(listing.get("data"), list) else None
    if not ids or not all(isinstance(i, str) for i in ids):
        raise AnswerError("the model list has no ids")
    if wanted in ids:
        return wanted
    like = [i for i in ids if wanted.lower() in i.lower()]
    if len(like) != 1:
        raise AnswerError(f"{len(like)} models match {wanted!r} among {ids}")
    return like[0]


def _number(x: Any, what: str, low: float = -math.inf, high: float = math.inf) -> float:
    if isinstance(x, bool) or not isinstance(x, (int, float)) or not low <= x <= high:
        raise AnswerError(f"{what} is not a number in range: {x!r}")
    return float(x)


def json_object(text: str) -> dict:
    """The object in a chat answer: fences cut, else from the first brace to the last."""
    body = text.strip()
    if body.startswith("```"):
        body = body.split("\n", 1)[-1].rsplit("```", 1)[0]
    for part in (body, body[body.find("{") : body.rfind("}") + 1]):
        try:
            found = json.loads(part)
        except ValueError:
            continue
        if isinstance(found, dict):
            return found
    raise AnswerError(f"no JSON object in the answer: {text[:200]!r}")


def chat_content(answer: Any) -> str:
    """Text of the first choice; its reasoning if the text is empty; a cut-off answer is an error."""
    try:
        choice = answer["choices"][0]
        message = choice["message"]
    except (KeyError, IndexError, TypeError) as e:
        raise AnswerError("the answer has no choices") from e
    if choice.get("finish_reason") == "length":
        raise AnswerError("the answer was cut off")
    text = message.get("content") or message.get("reasoning_content")
    if not isinstance(text, str) or not text.strip():
        raise AnswerError("the answer is empty")
    return text


def only_keys(found: dict, keys: tuple[str, ...]) -> dict:
    if set(found) != set(keys):
        raise AnswerError(f"expected the keys {sorted(keys)}, got {sorted(found)}")
    return found


def classification(answer: Any, question: str = "page_category") -> dict:
    """category, confidence, probabilities (named, in [0, 1], sum 1, the category on top), input_tokens, output_tokens."""
    try:
        found = answer["answers"][question]
        category, shares = found["choice"], found["probabilities"]
    except (KeyError, TypeError) as e:
        raise AnswerError("the answer has no choice") from e
    if found.get("type") != "choice" or category not in CATEGORIES:
        raise AnswerError(f"unknown category: {category!r}")
    if not isinstance(shares, dict) or set(shares) != set(CATEGORIES):
        raise AnswerError("probabilities do not name the categories")
    shares = {c: _number(shares[c], f"probability of {c}", 0, 1) for c in CATEGORIES}
    if abs(sum(shares.values()) - 1) > 0.001 or shares[category] < max(shares.values()):
        raise AnswerError("probabilities do not sum to 1 with the category on top")
    usage = token_usage(answer, ("input_tokens", "output_tokens"))
    return {"category": category, "confidence": _number(found.get("confidence"), "confidence", 0, 1), "probabilities": shares, **usage}


def token_usage(answer: dict, names: tuple[str, ...]) -> dict[str, int]:
    """The counts of an answer's ``usage``: whole numbers, not negative, all there."""
    usage = answer.get("usage")
    if not isinstance(usage, dict):
        raise AnswerError("the answer has no usage")
    for k in names:
        if isinstance(usage.get(k), bool) or not isinstance(usage.get(k), int) or usage[k] < 0:
            raise AnswerError(f"{k} is not a count: {usage.get(k)!r}")
    return {k: usage[k] for k in names}


def second_category(answer: Any) -> str:
    category = only_keys(json_object(chat_content(answer)), ("category",))["category"]
    if category not in CATEGORIES:
        raise AnswerError(f"unknown category: {category!r}")
    return category


def extraction(answer: Any) -> dict:
    found = only_keys(json_object(chat_content(answer)), FIELDS)
    for k, v in found.items():
        if v is not None and not isinstance(v, str):
            raise AnswerError(f"{k} is not a string or null")
    return {k: (v.strip() or None) if v is not None else None for k, v in found.items()}


def vectors(answer: Any, n: int) -> list[list[float]]:
    """One vector for each text, by index, all of one length."""
    rows = answer.get("data") if isinstance(answer, dict) else None
    if not isinstance(rows, list) or sorted((r.get("index") for r in rows), key=str) != sorted(range(n), key=str):
        raise AnswerError(f"expected {n} vectors with indexes 0 to {n - 1}")
    out: list[list[float]] = [[]] * n
    for r in rows:
        out[r["index"]] = [_number(x, "a vector component") for x in r.get("embedding") or ()]
    if len({len(v) for v in out}) > 1 or not out or not out[0]:
        raise AnswerError("vectors differ in length or are empty")
    return out


@dataclass(frozen=True)
class Model:
    """Where and how to ask. ``transport`` runs on the workers and must pickle."""

    url: str
    name: str
    transport: Transport = http
    timeout: float = 60.0
    on_error: str = "abort"
    batch: int = 8
    seed: int = 0
    max_tokens: int = 512
    options: dict = field(default_factory=dict)

    def chat(self, system: str, content: Any, schema: dict) -> Any:
        """A request whose answer is one JSON object of ``schema``, the same every time as far as the server can."""
        messages = [{"role": "system", "content": system}, {"role": "user", "content": content}]
        wanted = {"type": "json_schema", "json_schema": {"name": "answer", "strict": True, "schema": schema}}
        return self.ask({"messages": messages, "temperature": 0, "seed": self.seed, "max_tokens": self.max_tokens, "stream": False, "response_format": wanted})

    def ask(self, payload: dict) -> Any:
        return self.transport(self.url, {"model": self.name, **self.options, **payload}, self.timeout)


def _each(rows: DataFrame, model: Model, call: Callable[[Model, dict], dict], columns: str, blank: dict) -> DataFrame:
    """+ ``columns``, error and the seconds that it took: ``call`` on every row."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + f", {columns}, error string, seconds double"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for row in pdf.to_dict("records"):
                began = time.perf_counter()
                try:
                    found = {**call(model, row), "error": None}
                except Exception as e:
                    if model.on_error == "abort":
                        raise
                    found = {**blank, "error": f"{type(e).__name__}: {e}"}
                out.append({**row, **found, "seconds": time.perf_counter() - began})
            yield pd.DataFrame(out, columns=[*pdf.columns, *blank, "error", "seconds"])

    return rows.mapInPandas(run, schema)


#: What a page of each category is, in our words.
CRITERIA = {
    "mortgage_closing_disclosure_seller": "the seller's closing disclosure: figures of the sale as they concern the seller",
    "lender_rate_note": "a note or lock in which a lender states rate, terms and the promise to pay",
    "title_rider": "a rider that adds to or changes a title or security instrument",
    "property_tax_record_information_sheet": "a sheet on the property's tax record, parcel or assessment",
    "title_signature_name_affidavit_ack": "an affidavit on a signature or name, or a notary's acknowledgement",
    "other": "anything else, and pages that cannot be told",
}
PROMPT_VERSION = "1"


def criteria() -> str:
    return "\n".join(f"{name}: {CRITERIA[name]}" for name in CATEGORIES)


def object_schema(properties: dict) -> dict:
    return {"type": "object", "properties": properties, "required": list(properties), "additionalProperties": False}


def classify(pages: DataFrame, model: Model, instructions: str = "Which of these is the page, by its text? Choose other when in doubt.") -> DataFrame:
    """Pages with text -> + category, confidence, probabilities, input_tokens, output_tokens, error, seconds."""

    def call(m: Model, row: dict) -> dict:
        question = {"type": "choice", "instructions": instructions, "choices": list(CATEGORIES), "criteria": CRITERIA}
        return classification(m.ask({"state": row["text"], "questions": {"page_category": question}}))

    columns = "category string, confidence double, probabilities map<string,double>, input_tokens long, output_tokens long"
    return _each(pages, model, call, columns, dict.fromkeys(("category", "confidence", "probabilities", "input_tokens", "output_tokens")))


def verify(pages: DataFrame, model: Model, prompt: str = "Answer with a JSON object whose only key is category, one of these names:") -> DataFrame:
    """Pages with text -> + verifier_category, error, seconds; use a model with on_error ``record``."""
    schema = object_schema({"category": {"type": "string", "enum": list(CATEGORIES)}})

    def call(m: Model, row: dict) -> dict:
        return {"verifier_category": second_category(m.chat(f"{prompt}\n{criteria()}", row["text"], schema))}

    return _each(pages, model, call, "verifier_category string", {"verifier_category": None})


def extract(images: DataFrame, model: Model, prompt: str = "Answer with a JSON object of these fields, null if not on the page: ") -> DataFrame:
    """Page images -> + extracted (a struct of the four fields), error, seconds."""
    schema = object_schema({f: {"type": ["string", "null"]} for f in FIELDS})

    def call(m: Model, row: dict) -> dict:
        image = {"type": "image_url", "image_url": {"url": "data:image/png;base64," + base64.b64encode(row["image"]).decode()}}
        return {"extracted": extraction(m.chat(prompt + ", ".join(FIELDS), [image], schema))}

    return _each(images, model, call, f"extracted struct<{', '.join(f'{f}: string' for f in FIELDS)}>", {"extracted": None})


def embed(pages: DataFrame, model: Model, prefix: str = "Document: ") -> DataFrame:
    """Pages with text -> + vector, request (1 on the first page of a request, else 0), seconds (of the request, on that page).

    ``model.batch`` texts go in a request, within a worker's batch of rows; the sums of request and seconds count them.
    """
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema) + ", vector array<double>, request int, seconds double"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found: list[list[float]] = []
            spent: list[float] = []
            texts = [prefix + " ".join(t.split()) for t in pdf["text"]]
            for at in range(0, len(texts), model.batch):
                part = texts[at : at + model.batch]
                began = time.perf_counter()
                found += vectors(model.ask({"input": part}), len(part))
                spent += [time.perf_counter() - began] + [0.0] * (len(part) - 1)
            yield pdf.assign(vector=found, request=[int(i % model.batch == 0) for i in range(len(texts))], seconds=spent)

    return pages.mapInPandas(run, schema)
