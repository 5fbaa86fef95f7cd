"""The pipeline's stages, one after another, against what each must do with its own input."""

import random
import re
import tracemalloc
from pathlib import Path

import numpy as np
import pytest

import corpus_pipeline
from quire.llm import common, toxicity


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    rng = random.Random(11)
    plain = [f"{a}{b}" for a in ("th", "an", "er", "in", "ou") for b in ("e", "ing", "a", "on")]
    say = lambda n: " ".join(rng.choice(plain) for _ in range(n))
    rows, labels, shared = [], [], say(55)
    for i in range(150):
        text = "\n".join(say(rng.randint(10, 40)) for _ in range(rng.randint(1, 4)))
        toxic = int(i % 6 == 0)
        if toxic:
            words = text.split(" ")
            for _ in range(6):
                words.insert(rng.randrange(len(words)), rng.choice(["knucklehead", "buffoon", "dimwit"]))
            text = " ".join(words)
        if i % 10 == 1:
            text += "\n" + shared
        rows.append((i, text, "en", f"s{i % 4}", len(text)))
        labels.append((i, 1, toxic))
    rows += [(200, rows[1][1], "en", "s1", 0), (201, rows[2][1].replace("\n", " "), "en", "s2", 0), (202, None, None, None, None)]
    path = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept[name] = docs.collect()
        if name != "bpe":
            assert docs.columns == columns
    clean = {i for i in range(150) if i % 6}
    left = {r.doc_id for r in kept["toxicity"]}
    assert len(clean - left) <= 3 and len(left & (set(range(150)) - clean)) <= 3
    lines = {r.doc_id: r.text for r in kept["line_dedup"]}
    assert 200 not in lines  # an exact copy, line by line
    copies = [i for i, t in lines.items() if t is not None and i % 10 == 1 and i in left]
    tail = {lines[i].split("\n")[-1] for i in copies}
    assert len(tail) == len(copies)  # the shared line stays once
    assert left - {200} <= set(lines)
    ids = [r.doc_id for r in kept["simhash_near_dedup"]]
    assert 2 in ids and 201 not in ids  # the same words on one line
    assert set(lines) - set(ids) <= {201, 202}
    mixed = kept["mixing_sources"]
    assert {r.doc_id for r in mixed} <= set(ids) and all(r.n_chars == len(r.text) for r in mixed)
    assert len(kept["bpe"]) == len(mixed) and all(r.n_tokens == len(r.ids) for r in kept["bpe"])


def test_run(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.count() > 100 and "ids" in out.columns


def test_short_repeated_lines_go(spark, sf_dir):
    rows = [(1, "first words here\nAll rights reserved.", 37), (2, "second words here\nAll rights reserved.\nand more", 46), (3, "All rights reserved.", 20)]
    kept = corpus_pipeline.drop_repeated_lines(spark, spark.createDataFrame(rows, "doc_id long, text string, n_chars long"), sf_dir).collect()
    assert sorted(map(tuple, kept)) == [rows[0], (2, "second words here\nand more", 26)]


def test_run_of_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_the_driver_gives_memory_back_after_its_fits(spark, monkeypatch):
    """Texts fitted on and words compiled are not kept in the driver's process through the stages that follow."""
    from quire.llm import bpe, toxicity

    given = []
    for module in (toxicity, bpe):
        monkeypatch.setattr(module, "release", lambda name=module.__name__: given.append(name))
    docs = spark.createDataFrame([(1, "a b"), (2, "c d")], "doc_id long, text string")
    toxicity.reject_toxic(docs, spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int"))
    bpe.encode(docs)
    assert given == ["quire.llm.toxicity", "quire.llm.bpe"]


def test_the_native_heap_of_the_drivers_jvm_is_trimmed(spark, monkeypatch):
    def resident():
        rollup = Path(f"/proc/{spark._jvm.java.lang.ProcessHandle.current().pid()}/smaps_rollup").read_text()
        return int(re.search(r"Anonymous:\s+(\d+)", rollup)[1]) / 1024

    monkeypatch.setattr(common, "Py4JError", ZeroDivisionError)  # so that a call that is not there fails
    native = [spark._jvm.java.util.zip.Deflater() for _ in range(400)]
    for d in native[:-1]:  # the last one holds the freed memory below it
        d.end()
    full = resident()
    common.trim_jvm(spark)
    assert resident() < full - 20


def test_toxicity_groups_texts_without_a_second_copy_of_their_rows():
    rng = np.random.default_rng(5)
    texts = [rng.integers(97, 123, 200, dtype=np.uint8).tobytes() for _ in range(1500)]
    tracemalloc.start()
    toxicity._kinds(texts, rounds=2)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1.5 * len(texts) * toxicity.PAIRS * 4
