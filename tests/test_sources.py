import json
import os

import pytest
from pyspark.sql import functions as F

from quire import cli
from quire.functions import scores as S
from quire.functions.text import FIELDS
from quire.plans import document
from quire.sources import models, paths, reports, scans, sinks
from quire.streaming import ingest


def write(folder, name, payload):
    path = folder / name
    path.write_text(payload if isinstance(payload, str) else json.dumps(payload), encoding="utf-8")
    return str(path)


def ocr(pages, source="a.pdf"):
    return {"source": source, "pages": pages}


def test_ocr_reports(spark, tmp_path):
    good = write(tmp_path, "good.ocr.json", ocr([{"page_number": 1, "text": "x"}, {"page_number": 3, "text": "", "line_count": 2, "mean_score": None}]))
    rows = reports.load_ocr(spark, [good]).rows.orderBy("page_number").collect()
    assert [(r.page_ref, r.text, r.line_count, r.mean_score) for r in rows] == [("a.pdf#page-1", "x", None, None), ("a.pdf#page-3", "", 2, None)]
    bad = {
        "page number": ocr([{"page_number": True, "text": "x"}]), "page order": ocr([{"page_number": 2, "text": "x"}, {"page_number": 2, "text": "y"}]),
        "text": ocr([{"page_number": 1, "text": 5}]), "pages": ocr([]), "object": "[1]", "source": ocr([{"page_number": 1, "text": "x"}], ""),
        "line_count": ocr([{"page_number": 1, "text": "x", "line_count": 1.5}]), "page": ocr([7]),
    }
    files = [write(tmp_path, f"{i}.json", p) for i, p in enumerate(bad.values())]
    found = {(r.input_ord, r.rule) for r in reports.load_ocr(spark, files, strict=False).violations.collect()}
    assert {(i, rule) for i, rule in enumerate(bad)} <= found
    with pytest.raises(ValueError, match="page order"):
        reports.load_ocr(spark, [files[1]])
    with pytest.raises(ValueError, match="more than once"):
        reports.load_ocr(spark, [good, write(tmp_path, "twin.json", ocr([{"page_number": 1, "text": "x"}]))])


def test_reports_are_cut_into_pages(spark, tmp_path):
    """No page carries its report along, and no window holds texts; braces in strings, escapes and other members change nothing."""
    import gzip

    pages = [{"page_number": n, "text": t} for n, t in ((1, 'a } "b" \\'), (2, "[{,}]: ü"), (3, ""), (4, '"pages": [1, 2]'))]
    payload = {"a": {"pages": [5]}, "source": "a.pdf", "pages": pages, "z": [{"q": "}"}, [1]]}
    texts = [json.dumps(payload), json.dumps(payload, indent=1, ensure_ascii=False) + "\n", json.dumps(payload).replace('"pages": [{"p', '"p\\u0061ges": [{"p')]
    for t in texts:
        cutter, got = reports.Cutter(), []
        pieces = t.encode().split(b"}")
        for i, piece in enumerate(pieces):
            got += cutter.feed(b"}" * (i > 0) + piece)
        done, rest = cutter.end(len(t.encode()))
        assert [json.loads(x) for x in got + done] == pages and json.loads(rest) == payload | {"pages": [0] * 4}
    files = [write(tmp_path, f"{i}.json", t) for i, t in enumerate(texts)]
    packed = tmp_path / "3.json.gz"
    packed.write_bytes(gzip.compress(texts[0].encode()))
    rows = reports.load_ocr(spark, [*files, str(packed)], strict=False).rows
    assert sorted((r.input_ord, r.position, r.page_number, r.text) for r in rows.collect()) == [(i, p["page_number"] - 1, p["page_number"], p["text"]) for i in range(4) for p in pages]
    broken = [texts[0][:-1], texts[0] + " x", texts[0].replace('": ""}', '": "",}'), texts[0].replace("}, {", "} {", 1), "\ufeff" + texts[0], texts[0].replace("[{", "[,{", 1)]
    files = [write(tmp_path, f"b{i}.json", t) for i, t in enumerate(broken)]
    loaded = reports.load_ocr(spark, files, strict=False)
    assert sorted((r.input_ord, r.rule) for r in loaded.violations.collect()) == [(i, "object") for i in range(len(files))] and loaded.rows.count() == 0
    assert "raw" not in reports.pages_of(spark, files).columns
    plan = loaded.violations._jdf.queryExecution().optimizedPlan().toString()
    assert not any("text#" in line or "page#" in line for line in plan.splitlines() if " Window " in line or line.lstrip(" :+-").startswith("Window"))


def classified_page(n, category, confidence=0.9, review=False):
    shares = dict.fromkeys(S.CATEGORIES, 0.0) | {category: 1.0}
    return {"page_number": n, "page_ref": f"a.pdf#page-{n}", "category": category, "confidence": confidence, "probabilities": shares, "needs_review": review, "review_reason": None}


def test_classification_reports(spark, tmp_path):
    blank = {"page_number": 4, "page_ref": "a.pdf#page-4", "category": None, "confidence": None, "probabilities": None, "needs_review": True, "review_reason": "empty text"}
    path = write(tmp_path, "a.categories.json", {"pages": [classified_page(1, "title_rider"), classified_page(2, "other"), classified_page(3, "title_rider", review=True), blank]})
    loaded = reports.load_classification(spark, [path]).rows
    got = {r.page_ref[-1]: (r.category, r.confidence) for r in reports.category_signals(loaded).collect()}
    assert got == {"1": ("title_rider", 0.9), "2": (None, None), "3": (None, None), "4": (None, None)}
    wrong = classified_page(1, "title_rider") | {"confidence": "0.9"}
    bad = write(tmp_path, "b.json", {"pages": [wrong, classified_page(2, "title_rider") | {"category": "poem"}]})
    found = {(r.position, r.rule) for r in reports.load_classification(spark, [bad], strict=False).violations.collect()}
    assert (0, "confidence") in found and (1, "category") in found


def test_printed_numbers(spark):
    rows = spark.createDataFrame([("12",), (" ",), (None,), ("iv",)], "v string")
    assert [r[0] for r in rows.select(reports.printed_number(F.col("v"))).collect()] == [12, None, None, None]
    with pytest.raises(Exception, match="not digits"):
        rows.select(reports.printed_number(F.col("v"), strict=True)).collect()


def test_paths_and_settings(tmp_path, monkeypatch):
    assert paths.beside("x/a.pdf", "ocr").name == "a.ocr.json" and paths.beside("x/a.ocr.json", "vlm").name == "a.vlm.json"
    one = write(tmp_path, "a.categories.json", {})
    assert [str(p) for p in paths.auxiliary([str(tmp_path / "a.ocr.json"), str(tmp_path / "b.ocr.json")], "categories")] == [one]
    with pytest.raises(ValueError):
        paths.auxiliary(["a", "b"], "categories", one)
    env = write(tmp_path, ".env", "# c\nexport KEY='v 1'\nOTHER=2\n")
    monkeypatch.delenv("KEY", raising=False)
    assert paths.secret("KEY", env) == "v 1"
    monkeypatch.setenv("KEY", "w")
    assert paths.secret("KEY", env) == "w"
    with pytest.raises(ValueError):
        paths.secret("NONE_SUCH", env)


def test_scans(spark, tmp_path):
    (tmp_path / "a.PDF").write_bytes(b"one|two")
    (tmp_path / "b.pdf").write_bytes(b"!")
    (tmp_path / "c.txt").write_bytes(b"no")

    def renderer():
        def render(content, dpi):
            if content == b"!":
                raise ValueError("broken")
            yield from enumerate(bytes(content).split(b"|"), start=1)

        return render

    def engine():
        return lambda image: [(bytes(image).decode(), 0.5), (str(len(image)), 1.0)]

    pages = scans.render_pages(scans.read_pdfs(spark, [str(tmp_path)]), renderer, on_error="record")
    assert [r.source for r in pages.where("error like '%broken%'").collect()] == ["b.pdf"]
    read = scans.recognise(pages, engine).collect()
    assert [(r.source, "broken" in r.error) for r in read if r.error] == [("b.pdf", True)]  # a file that fails is not lost
    with pytest.raises(Exception, match="cannot render b.pdf"):
        scans.render_pages(scans.read_pdfs(spark, [str(tmp_path)]), renderer).collect()
    got = sorted((r.source, r.page_number, r.text, r.line_count, r.mean_score) for r in read if not r.error)
    assert got == [("a.PDF", 1, "one\n3", 2, 0.75), ("a.PDF", 2, "two\n3", 2, 0.75)]


def test_answers_are_checked():
    shares = dict.fromkeys(S.CATEGORIES, 0.0) | {"other": 1.0}
    answer = {"answers": {"page_category": {"type": "choice", "choice": "other", "confidence": 0.7, "probabilities": shares}}, "usage": {"input_tokens": 3, "output_tokens": 1}}
    assert models.classification(answer)["confidence"] == 0.7
    for change in ({"choice": "poem"}, {"confidence": True}, {"probabilities": shares | {"other": 0.5}}, {"type": "text"}):
        with pytest.raises(models.AnswerError):
            models.classification(answer | {"answers": {"page_category": answer["answers"]["page_category"] | change}})
    for usage in (None, {}, {"input_tokens": 3}, {"input_tokens": 3.0, "output_tokens": 1}, {"input_tokens": True, "output_tokens": 1}, {"input_tokens": -1, "output_tokens": 1}):
        with pytest.raises(models.AnswerError):
            models.classification(answer | {"usage": usage})
    chat = lambda text, **more: {"choices": [{"message": {"content": text}, **more}]}
    assert models.second_category(chat('```json\n{"category": "other"}\n```')) == "other"
    assert models.second_category(chat('so: {"category": "other"} ok')) == "other"
    for wrong in (chat('{"category": "other", "x": 1}'), chat("none"), chat('{"category": "other"}', finish_reason="length"), {}):
        with pytest.raises(models.AnswerError):
            models.second_category(wrong)
    assert models.vectors({"data": [{"index": 1, "embedding": [2]}, {"index": 0, "embedding": [1]}]}, 2) == [[1.0], [2.0]]
    for wrong in ([{"index": 0, "embedding": [1]}], [{"index": 0, "embedding": [1]}, {"index": 1, "embedding": [1, 2]}], [{"index": 0, "embedding": [True]}, {"index": 1, "embedding": [1]}]):
        with pytest.raises(models.AnswerError):
            models.vectors({"data": wrong}, 2)
    listing = {"data": [{"id": "Qwen-A"}, {"id": "gem"}]}
    assert models.pick_model(listing, "qwen") == "Qwen-A"
    with pytest.raises(models.AnswerError):
        models.pick_model(listing, "e")


def fake(url, payload, timeout):
    """All four models, by address."""
    if url == "classify":
        category = "title_rider" if "rider" in payload["state"] else "lender_rate_note"
        shares = dict.fromkeys(S.CATEGORIES, 0.0) | {category: 0.7, "other": 0.3}
        return {"answers": {"page_category": {"type": "choice", "choice": category, "confidence": 0.7, "probabilities": shares}}, "usage": {"input_tokens": 1, "output_tokens": 1}}
    if url == "verify":
        if "note" in payload["messages"][1]["content"]:
            raise RuntimeError("down")
        return {"choices": [{"message": {"content": '{"category": "title_rider"}'}}]}
    if url == "extract":
        return {"choices": [{"message": {"content": json.dumps(dict.fromkeys(FIELDS) | {"loan_number": "L-77", "page_number": "1"})}}]}
    return {"data": [{"index": i, "embedding": [1.0, float("rider" in t)]} for i, t in enumerate(payload["input"])]}


def test_whole_dataflow(spark, tmp_path):
    texts = ["a rider L77 1", "more rider l77", "a note 9", "  "]
    pages = spark.createDataFrame([("a.pdf", i + 1, t) for i, t in enumerate(texts)], "source string, page_number int, text string")
    images = pages.select("source", "page_number", F.lit("png").cast("binary").alias("image"))
    ask = lambda url, **more: models.Model(url, "m", fake, **more)
    out = document.run(pages, images, ask("classify"), ask("verify", on_error="record"), ask("extract"), ask("embed"), str(tmp_path / "scratch"))
    assert {r.page_number: r.resolution for r in out.pages.collect()} == {1: "accepted", 2: "accepted", 3: "verifier_failed", 4: "not_triggered"}
    assert sorted((r.first_page, r.pages, r.label) for r in out.documents.collect()) == [(1, [1, 2], "title_rider"), (3, [3], "lender_rate_note"), (4, [4], "other")]
    loan = {r.field: r for r in out.loan_fields.collect()}["loan_number"]
    assert loan.value == "L-77" and loan.source_pages == [1, 2]
    notes = {r.page_number: r.notes for r in out.page_labels.collect()}
    assert notes[3].startswith("verifier failed; vlm mismatch: ") and notes[4].startswith("empty text")
    with pytest.raises(ValueError, match="not of the same pages"):
        document.run(pages, images.where("page_number > 1"), ask("classify"), ask("verify"), ask("extract"), ask("embed"), str(tmp_path / "s2"))


def test_command_line_and_sinks(spark, tmp_path, capsys):
    path = write(tmp_path, "a.ocr.json", ocr([{"page_number": i, "text": "x"} for i in (1, 2, 3)]))
    write(tmp_path, "a.categories.json", {"pages": [classified_page(i, "title_rider") for i in (1, 2, 3)]})
    spark.createDataFrame([("a.pdf#page-1", [1.0, 0.0]), ("a.pdf#page-2", [1.0, 0.1]), ("a.pdf#page-3", [-1.0, 0.0])], "page_ref string, vector array<double>").write.parquet(str(tmp_path / "v"))
    assert cli.main(["match", path, "--stdout", "--vectors", str(tmp_path / "v")]) == 0
    report = json.loads(capsys.readouterr().out)
    assert [g["page_refs"] for g in report["groups"]] == [["a.pdf#page-1", "a.pdf#page-2"]] and report["summary"]["unique_page_count"] == 1
    assert report["groups"][0]["members"][0]["edge"] is None and report["groups"][0]["members"][1]["edge"]["signals"]["category_match"] > 0
    for wrong in (["--threshold", "7"], ["--min-embedding-similarity", "-2"], ["--categories-json", str(tmp_path / "none.json")]):
        assert cli.main(["match", path, "--stdout", "--vectors", str(tmp_path / "v"), *wrong]) == 1
    df = spark.createDataFrame([(None, "ü")], "a string, b string")
    assert sinks.one_report(df) == '{\n  "a": null,\n  "b": "ü"\n}'


def fake_server(url, payload=None, timeout=1.0):
    return fake(url.rsplit("/", 1)[-1], payload, timeout)


def page_renderer():
    return lambda content, dpi: enumerate(content.split(b"|"), start=1)


def line_engine():
    return lambda image: [(line, 0.5) for line in bytes(image).decode().split(";") if line.strip()]


def test_every_command(spark, tmp_path, capsys):
    """Each command runs from files to reports beside them, and the whole pipeline gives the same documents."""
    folder = tmp_path / "my files"
    folder.mkdir()
    (folder / "a.pdf").write_bytes(b"a rider L77;1|more rider l77|a note 9|  ")
    (folder / "b.pdf").write_bytes(b"note 5 L77")
    pdfs, tools = [str(folder / n) for n in ("a.pdf", "b.pdf")], cli.Tools(fake_server, page_renderer, line_engine, "lines", "none")
    run = lambda *argv: cli.main(list(argv), tools)
    at = lambda kind: [str(folder / f"{n}.{kind}.json") for n in "ab"]
    read = lambda path: json.loads(open(path, encoding="utf-8").read())
    assert run("ocr", *pdfs) == 0
    texts = read(at("ocr")[0])
    assert [p["text"] for p in texts["pages"]] == ["a rider L77\n1", "more rider l77", "a note 9", ""] and texts["engine"] == "lines" and texts["device"] == "none"
    assert run("classify", *at("ocr"), "--base-url", "classify") == 0
    found = read(at("categories")[0])
    assert [p["category"] for p in found["pages"]] == ["title_rider", "title_rider", "lender_rate_note", None] and found["usage"] == {"input_tokens": 3, "output_tokens": 3, "requests": 3}
    assert found["skipped_pages"][0]["reason"] == "empty text" and found["summary"]["category_counts"]["other"] == 0 and found["pages"][0]["ocr_reference"]["line_count"] == 2
    assert run("verify", *at("categories"), "--base-url", "verify") == 0
    assert [p["verification"]["resolution"] for p in read(at("category_review")[0])["pages"]] == ["accepted", "accepted", "verifier_failed", "not_triggered"]
    assert run("extract", *pdfs, "--base-url", "extract") == 0
    checked = read(at("vlm")[0])
    assert checked["pages"][0]["verification"]["loan_number"]["status"] == "ok" and checked["pages"][0]["normalized"]["loan_number"] == "l77" and checked["timings"]["requests"] == 4
    assert run("match", *at("ocr"), "--base-url", "embed") == 0
    groups = read(at("matches")[0])
    assert [g["page_refs"] for g in groups["groups"]] == [["a.pdf#page-1", "a.pdf#page-2"]] and groups["skipped_pages"][0]["page_ref"] == "a.pdf#page-4" and read(at("matches")[1])["groups"] == []
    assert run("pipeline", *pdfs, "--classify-base-url", "classify", "--verify-base-url", "verify", "--extract-base-url", "extract", "--embed-base-url", "embed") == 0
    result = read(at("result")[0])
    assert [(d["label"], d["pages"]) for d in result["documents"]] == [("title_rider", [1, 2]), ("lender_rate_note", [3]), ("other", [4])]
    assert result["loan_level_fields"]["loan_number"]["source_pages"] == [1, 2] and set(result["timings"]["stages_seconds"]) == {"render", "ocr", "models_and_matching"}
    assert run("texts", *at("ocr")) == 0 and json.loads(capsys.readouterr().out)["violations"] == []
    (folder / "b.pdf").write_bytes(b"note 5|too many")
    assert run("extract", *pdfs, "--base-url", "extract") == 1 and run("classify", str(folder / "none.json")) == 1


def test_reports_are_found_by_any_spelling_of_their_path(spark, tmp_path, monkeypatch):
    folder = tmp_path / "a b [c]" / "sub"
    folder.mkdir(parents=True)
    names = ["a.ocr.json", "sub/a.ocr.json", "sub/ü %20.ocr.json"]
    for i, n in enumerate(names):
        write(folder.parent, n, ocr([{"page_number": 1, "text": f"t{i}"}]) | {"source": f"s{i}"})
    monkeypatch.chdir(folder.parent)
    for given in (names, [str(folder.parent / n) for n in names], [f"./{n}" for n in names], [f"file://{folder.parent / n}" for n in names]):
        if given[0].startswith("."):  # relative paths are the JVM's, whose folder does not change
            given = [os.path.relpath(folder.parent / n, spark.sparkContext._jvm.java.lang.System.getProperty("user.dir")) for n in names]
        if not given[0].startswith(("/", "file", "..")):
            continue
        rows = reports.load_ocr(spark, given).rows.collect()
        assert sorted((r.input_ord, r.source, r.text) for r in rows) == [(i, f"s{i}", f"t{i}") for i in range(3)]
    (folder / "empty.json").write_text("")
    broken = reports.load_ocr(spark, [str(folder / "empty.json"), str(folder / "a.ocr.json")], strict=False).violations.collect()
    assert [(r.input_ord, r.rule) for r in broken] == [(0, "object"), (0, "source")] or [(r.input_ord, r.rule) for r in broken] == [(0, "object")]
    again = reports.load_ocr(spark, [str(folder / "a.ocr.json")] * 2, strict=False).violations.collect()
    assert [r.rule for r in again] == ["page_ref twice"] * 2


def test_stream(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    write(folder, "1.json", "\n".join(json.dumps({"source": "a", "page_number": n, "text": t, "arrived": "2026-01-01T00:00:00Z"}) for n, t in ((1, " x  y "), (2, " "), (1, "again"))))
    pages = ingest.once_each(ingest.page_stream(spark, str(folder)))
    ingest.each_batch(pages, lambda b: b.select("page_ref", "text"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    got = {r.page_ref: r.text for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert set(got) == {"a#page-1", "a#page-2"} and got["a#page-2"] == ""
