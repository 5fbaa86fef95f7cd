"""Brute force against every document operator, on one small table of odd rows and copies."""

import hashlib
import random
import sys
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from quire.llm import bpe, context_mixing, line_dedup, mixing, quality, simhash, substring_dedup, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n int, d string, size string, `row` string, score string, fp string"


def odd_rows():
    rng = random.Random(5)
    words = [f"{a}{b}" for a in ("th", "an", "er", "in", "ou", "st") for b in ("e", "ing", "a", "on", "ed", "ly")]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage, boiler = say(60), say(9) + "."
    rows = [(1, None, "en"), (2, "", "en"), (3, " \t\n ", None), (4, "one", "en"), (5, "Émile ſays ΣΑΣ <|endoftext|> 42 don't\x0bstop", "fr")]
    for i in range(6, 40):
        text = "\n".join(say(rng.randint(3, 30)) for _ in range(rng.randint(1, 5)))
        if i % 4 == 0:
            text = text + "\n" + passage
        if i % 5 == 0:
            text = boiler + "\n" + text + "\n\n" + text
        rows.append((i, text, "en" if i % 3 else "fr"))
    rows += [(40, rows[12][1], "en"), (41, rows[12][1], "en"), (42, rows[20][1] + " more", "en"), (41, rows[12][1], "en"), (43, "a " * 120, "en"), (None, rows[9][1], "en"), (None, None, None)]
    rows.append((44, say(3000), "de"))
    return [(i, t, lang, None if k % 7 == 0 else f"s{k % 3}", None if t is None else len(t), k, "d", "size", "row", "score", "fp") for k, (i, t, lang) in enumerate(rows)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words_of(text):
    return (text or "").encode().split()


def test_simhash_components(docs, empty):
    rows = [(r.doc_id, simhash.fingerprint((r.text or "").encode())) for r in docs.collect()]
    for r in docs.where("text is not null").limit(8).collect():
        w = r.text.encode().lower().split()
        shingles = [b" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))] if w else []
        h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        want = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0
        assert simhash.fingerprint(r.text.encode()) == want
    fps = sorted({f for _, f in rows})
    part = {f: f for f in fps}

    def root(x):
        return x if part[x] == x else root(part[x])

    for a in fps:
        for b in fps:
            if (a ^ b).bit_count() <= 4:
                part[root(a)] = root(b)
    least = {}
    for i, f in rows:
        if i is not None:
            least[root(f)] = min(i, least.get(root(f), i))
    want = Counter((i, f, least.get(root(f))) for i, f in rows)
    got = Counter((r.doc_id, r.fp & (2**64 - 1), r.component_id) for r in simhash.simhash_components(docs).collect())
    assert got == want
    assert simhash.simhash_components(empty).count() == 0
    kept = simhash.keep_one_per_group(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect() if r.doc_id is not None]
    assert sorted(ids) == sorted({c for i, _, c in want if i is not None and c == i})


def test_near_pairs_find_every_close_pair(spark):
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(30)]
    fps = {b ^ sum(1 << k for k in rng.sample(range(64), rng.randint(0, 6))) for b in base for _ in range(6)}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    got = {tuple(r) for r in simhash.near_pairs(spark.createDataFrame([(f,) for f in signed], "fp long")).collect()}
    assert got == {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 4}


@pytest.mark.parametrize("min_words", [1, 8])
def test_line_dedup(docs, empty, min_words):
    rows = sorted(((r.doc_id if r.doc_id is not None else -1, r.text, r.n) for r in docs.collect()), key=lambda r: (r[0], r[2]))
    sequences = [[(j, x) for j, x in enumerate((t or "").split("\n")) if x.encode().split()] if t is not None else [] for _, t, _ in rows]
    seen_one, seen_two, want = set(), set(), Counter()
    # rows of one doc_id are ordered by a hash; those here are equal texts or have no lines, so any order gives the same counts
    for (i, t, _), lines in zip(rows, sequences, strict=True):
        gone = set()
        for k, (j, x) in enumerate(lines):
            if x in seen_one and len(x.encode().split()) >= min_words:
                gone.add(j)
            seen_one.add(x)
            if k + 1 < len(lines):
                pair = (x, lines[k + 1][1])
                if pair in seen_two:
                    gone |= {j, lines[k + 1][0]}
                seen_two.add(pair)
        kept = None if t is None else "\n".join(x for j, x in enumerate(t.split("\n")) if j not in gone)
        want[i, kept, len(gone)] += 1
    out = line_dedup.dedup_lines(docs, min_words)
    assert Counter((-1 if r.doc_id is None else r.doc_id, r.text, r.n_removed) for r in out.collect()) == want
    assert set(docs.columns) <= set(out.columns)
    clean = line_dedup.deduped_documents(docs)
    assert clean.columns == docs.columns
    assert line_dedup.dedup_lines(empty).count() == 0


def test_line_dedup_of_equal_rows_keeps_the_same_row(spark):
    """Of rows that share doc_id and text the other columns decide, however the rows are dealt out."""
    rows = [(1, "a b\nc d", "x"), (1, "a b\nc d", "y"), (1, "e", "z"), (None, "a b", "x"), (None, "a b", "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, `other.column` string")
    got = [sorted(map(tuple, line_dedup.dedup_lines(frame.repartition(n)).collect()), key=str) for n in (1, 3, 5)]
    assert got[0] == got[1] == got[2] and sum(r[-1] == 0 for r in got[0]) == 2


@pytest.mark.parametrize("broadcast_rows", [10**6, 0])
def test_substring_dedup(docs, empty, broadcast_rows, monkeypatch):
    monkeypatch.setattr(substring_dedup, "GROUP", 3)  # salts even here
    texts = [(r.doc_id, words_of(r.text)) for r in docs.collect()]
    count = Counter(tuple(w[i : i + 35]) for _, w in texts for i in range(len(w) - 34))
    want = Counter()
    for i, w in texts:
        gone = {k for j in range(len(w) - 34) if count[tuple(w[j : j + 35])] > 1 for k in range(j, j + 35)}
        want[i, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()] += 1
    got = substring_dedup.drop_repeats(docs, broadcast_rows=broadcast_rows)
    assert Counter(tuple(r) for r in got.collect()) == want
    assert sum(n for (_, _, n, _) in want) > 100
    if broadcast_rows:
        assert substring_dedup.drop_repeats(empty).count() == 0


def test_substring_dedup_of_words_that_fool_polynomials(spark):
    """Two texts that differ in one Thue-Morse word have no window in common; nor do rows without doc_id lend each other marks."""
    bits = [bin(i).count("1") % 2 for i in range(1024)]
    side = " ".join(f"w{i}" for i in range(20))
    one, two = ("".join(letters[b] for b in bits) for letters in ("ab", "ba"))
    texts = [f"{side} {one} {side}", f"{side} {two} {side}"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, f"x{i} " + " ".join(f"y{i}-{k}" for k in range(40))) for i in range(50)]
    got = substring_dedup.drop_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got.where("n_removed > 0").count() == 0 and got.count() == 52


def test_index_is_taken_up_again(spark, tmp_path):
    path = f"file://{tmp_path}/index"
    frame = lambda xs: spark.createDataFrame([(x,) for x in xs], "fp long")
    first = substring_dedup.FingerprintIndex(spark, buckets=2, path=path)
    assert [tuple(r) for r in first.add(frame([1, 2, 2])).collect()] == [(2, 2)]
    first.close()
    for batch, want in (([1, 5], [(1, 2)]), ([5, 2, 9], [(2, 3), (5, 2)]), ([9], [(9, 2)])):
        again = substring_dedup.FingerprintIndex(spark, path=path)
        assert sorted(map(tuple, again.add(frame(batch)).collect())) == want
        again.close()


def test_index_runs_and_compaction(spark):
    index = substring_dedup.FingerprintIndex(spark, buckets=2, fanout=1)
    batches = [[1, 2, 2, 3], [3, 4], [1, 5, 4], [9]]
    got = [sorted(map(tuple, index.add(spark.createDataFrame([(x,) for x in b], "fp long")).collect())) for b in batches]
    assert got == [[(2, 2)], [(3, 2)], [(1, 2), (4, 2)], []]
    assert len(index.runs) == 1
    index.close()


def test_bpe_round_trip(docs, empty):
    tokenizers = pytest.importorskip("tokenizers")
    paths = pytest.importorskip("public_tokenizers")
    reference = tokenizers.Tokenizer.from_file(paths.path("word_bpe_49k.json"))
    want = Counter()
    for r in docs.collect():
        ids = reference.encode(r.text or "", add_special_tokens=False).ids
        want[r.doc_id, len(ids), tuple(ids), reference.decode(ids, skip_special_tokens=False)] += 1
    for lexicon in (50, 1 << 17):
        got = bpe.encode(docs, lexicon_words=lexicon).collect()
        assert Counter((r.doc_id, r.n_tokens, tuple(r.ids), r.decoded) for r in got) == want
    digest = bpe.encode(docs.where("doc_id = 7"), digests=True).first()
    ids = next(k[2] for k in want if k[0] == 7)
    assert digest.ids_sha256 == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
    assert bpe.encode(empty).count() == 0


def test_lexicon_shares_suffixes_and_finds_words():
    words = {w.encode(): [i, i + 1][: 1 + i % 2] for i, w in enumerate(["walking", "talking", "talk", "walk", "king", "k", "walked"])}
    lexicon = bpe.Lexicon(bpe.compile_lexicon(words))
    asked = [*words, b"wal", b"walkings", b"", b"zzz"]
    found = lexicon.find(asked)
    assert (found[: len(words)] >= 0).all() and (found[len(words) :] == -1).all()
    for w, at in zip(words, found, strict=False):
        assert lexicon.ids[lexicon.offsets[at] : lexicon.offsets[at + 1]].tolist() == words[w]
    assert len(lexicon.final) < sum(map(len, words))


def test_mixing(docs, empty):
    rows = mixing.mix_report(docs, block_words=8).collect()
    assert Counter((r.doc_id, r["size"]) for r in rows) == Counter((r.doc_id, len(words_of(r.text))) for r in docs.collect())
    assert all(0 <= r.taken <= 2 * r["size"] for r in rows)
    by = {}
    for r in rows:
        s = by.setdefault((r.source_size, r.target), [0, 0])
        s[0] += r["size"]
        s[1] += r.taken
    assert sum(t for _, t in by) == pytest.approx(1.5 * sum(r["size"] for r in rows))
    for (size, target), (own, taken) in by.items():
        assert own == size and target <= 2 * size + 1e-9
        assert abs(taken - target) <= 0.1 * target + 16
    again = mixing.mix_report(docs, block_words=8).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, rows))
    mixed = mixing.mixture(docs, block_words=8)
    assert mixed.columns == docs.columns
    assert sum(len(words_of(r.text)) for r in mixed.collect()) == sum(r.taken for r in rows)
    assert mixing.mix_report(empty).count() == 0 and mixing.mixture(empty).count() == 0


def test_draws_are_multinomial_and_decide_the_shards(spark):
    """Counts a shard scatter as independent draws do, and every slot lies in the shard that its number falls in."""
    for shards in (16, 64, 256):
        slots = spark.range(1024 * shards).select(mixing.drawn_shard(F.col("id"), F.lit(1), F.lit(shards)).alias("s"))
        got = [r["count"] for r in slots.groupBy("s").count().collect()]
        chi = sum((c - 1024) ** 2 / 1024 for c in got) + 1024 * (shards - len(got))
        assert abs(chi - (shards - 1)) < 4 * (2 * (shards - 1)) ** 0.5
    sources = spark.createDataFrame([("a", 64 * 100, 0, 64 * 150.0), ("b", 64 * 40, 1, 64 * 80.0)], "source string, source_size long, rank long, target double")
    counts, drawn = mixing.block_times(spark, sources, 64, 16)
    counts, drawn = {(r.rank, r.shard): (r.first, r.draws) for r in counts.collect()}, drawn.collect()
    assert Counter((r.rank, r.shard) for r in drawn) == Counter({k: n for k, (_, n) in counts.items()})
    assert all(0 <= r.slot - counts[r.rank, r.shard][0] < counts[r.rank, r.shard][1] for r in drawn)
    assert sorted(r.slot for r in drawn if r.rank == 0) == list(range(150)) and len({n for _, n in counts.values()}) > 3


def test_targets_and_permutation(spark):
    sizes = spark.createDataFrame([("a", 100), ("b", 10), ("c", 50), ("d", 1), (None, 30)], "source string, source_size long")
    target = {r.source: r.target for r in mixing.source_targets(sizes).collect()}
    share, left, cap = {}, 1.5 * 191, {"a": 200, "b": 20, "c": 100, "d": 2, None: 60}
    open_ = {"a": 5, "b": 2, "c": 1, "d": 5, None: 2}
    while open_:
        level = left / sum(open_.values())
        full = [s for s, w in open_.items() if level * w > cap[s]]
        if not full:
            share |= {s: level * w for s, w in open_.items()}
            break
        for s in full:
            share[s] = cap[s]
            left -= cap[s]
            del open_[s]
    assert target == pytest.approx(share)
    for n in (1, 2, 7, 100):
        got = [r[0] for r in spark.range(n).select(mixing.permute(F.col("id"), F.lit(n).cast("long"), F.lit(3))).collect()]
        assert sorted(got) == list(range(n))


def test_language_model(docs, empty):
    held = lambda i: None if i is None else __import__("zlib").crc32(str(i).encode()) % 5 == 1
    count = Counter()
    rows = [(r.doc_id, [w.lower() for w in words_of(r.text)] + [None]) for r in docs.collect()]
    for i, w in rows:
        if held(i) is False:
            count.update(w)
    total, v = sum(count.values()), len(count)
    want = Counter()
    for i, w in rows:
        base = sum(np.log10((count[x] + 0.5) / (total + 0.5 * (v + 1))) for x in w)
        want[i, held(i), len(w), sum(count[x] > 0 for x in w), total, round(base, 6)] += 1
    out = context_mixing.score(docs).collect()
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out) == want
    assert all(r.score < 0 for r in out)
    assert context_mixing.score(empty).count() == 0


def test_code_is_a_probability():
    """Over all words of one or two letters, ends and the path of longer ones, probabilities sum to 1."""
    code = context_mixing.Code([b"aa", b"b"], [5, 3], 2, 4, np.ones(257, dtype=np.int64))
    lengths = np.diff(code.offsets)
    assert sum(2.0**-n for n in lengths[: code.first_byte]) == pytest.approx(1) and sum(2.0**-n for n in lengths[code.first_byte :]) == pytest.approx(1)
    scorer = context_mixing.Scorer(code, 14, [np.zeros(1 << 14, dtype=np.float32)] * context_mixing.MODELS, context_mixing.start_weights())
    one = scorer.log2(*code.tokens([[b"aa"], [b"aa", b"zz"]]))
    assert one[0] > one[1]


def plain_kneser_ney(texts):
    """gram (tuple) -> probability of its last symbol, by the definition, one dictionary an order."""
    n = quality.ORDER
    padded = [[256] * (n - 1) + list(t.lower()) + [256] for t in texts]
    orders = {n: Counter(tuple(t[i : i + n]) for t in padded for i in range(len(t) - n + 1))}
    for k in range(n - 1, 0, -1):
        orders[k] = Counter(g[1:] for g in orders[k + 1])
    off, context, given = {}, {}, {}
    for k, counts in orders.items():
        n1, n2, n3, n4 = (sum(c == j for c in counts.values()) for j in (1, 2, 3, 4))
        if n1 and n2 and n3:
            y = n1 / (n1 + 2 * n2)
            found = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
            off[k] = [min(max(d, 0.05), j - 0.05) for j, d in zip((1, 2, 3), found, strict=True)]
        else:
            off[k] = [0.5, 1.0, 1.5]
        for g, c in counts.items():
            context[k, g[:-1]] = context.get((k, g[:-1]), 0) + c
            given[k, g[:-1]] = given.get((k, g[:-1]), 0.0) + off[k][min(c, 3) - 1]

    def p(g):
        if not g:
            return 1 / 257
        k, c = len(g), orders[len(g)].get(g, 0)
        less = p(g[1:])
        if (k, g[:-1]) not in context:
            return less
        total = context[k, g[:-1]]
        return (c - off[k][min(c, 3) - 1] if c else 0.0) / total + given[k, g[:-1]] / total * less

    return p


def test_quality(spark, docs, empty):
    """Perplexities, thresholds and decisions as a plain model of the same texts gives them."""
    junk = [(100 + i, "@@## %%% " * 30, "en", "s", 270) for i in range(5)]
    every = docs.select("doc_id", "text", "lang", "source", "n_chars").union(spark.createDataFrame(junk, "doc_id long, text string, lang string, source string, n_chars long"))
    labels = spark.createDataFrame([(i, 1, 0) for i in range(6, 40)] + [(6, 0, 0), (None, 1, 0), (101, 0, 0), (102, None, None)], "doc_id long, quality int, toxic int")
    rows = [(r.doc_id, r.lang, (r.text or "").encode()) for r in every.collect()]
    left_out = {r.doc_id for r in quality.trusted_ids(labels, calibrate=True).collect()}
    counted = {r.doc_id for r in quality.trusted_ids(labels, calibrate=False).collect()}
    assert left_out and not left_out & counted and left_out | counted == set(range(6, 40))
    p = plain_kneser_ney([t for i, _, t in rows if i in counted])
    score = {}
    for _, _, t in rows:
        codes = [256] * (quality.ORDER - 1) + list(t.lower()) + [256]
        logs = [np.log(p(tuple(codes[i : i + quality.ORDER]))) for i in range(len(t) + 1)]
        score[t] = float(np.exp(-np.mean(logs)))
    held = [(lang, score[t]) for i, lang, t in rows if i in left_out]
    limit = lambda xs: sorted(xs)[max(0, int(np.ceil(quality.QUANTILE * len(xs))) - 1)]
    overall = limit([x for _, x in held])
    by = {lang: limit([x for g, x in held if g == lang]) for lang, _ in held}
    want = Counter((i, lang, len(t) + 1, round(score[t], 6), round(by.get(lang, overall), 6), score[t] <= by.get(lang, overall) + 1e-9) for i, lang, t in rows)
    out = quality.quality(every, labels).collect()
    assert Counter((r.doc_id, r.lang, r.n_symbols, round(r.perplexity, 6), round(r.threshold, 6), r.keep) for r in out) == want
    assert not any(r.keep for r in out if r.doc_id is not None and r.doc_id >= 100)
    nothing = labels.limit(0)
    plain = quality.quality(every, nothing).collect()
    assert all(r.keep and r.threshold is None and r.perplexity == pytest.approx(257) for r in plain)
    assert quality.quality(empty, labels).count() == 0


def test_texts_travel_compressed_together():
    """What goes to a block holds every row as it was, in far fewer bytes than rows compressed one by one."""
    rng = random.Random(3)
    words = ["".join(rng.choice("aeinorst") for _ in range(6)) for _ in range(300)]
    texts = [" ".join(rng.choice(words) for _ in range(60)).encode() for _ in range(4000)] + [None, b""]
    n = len(texts)
    columns = [pa.array([5] * n, pa.int32()), pa.array([None, *range(1, n)], pa.int64()), pa.array(["de", None] * (n // 2)), pa.array(texts, pa.binary())]
    batch = pa.RecordBatch.from_arrays(columns, names=["block", "doc_id", "lang", "text"])
    packed = [r for b in quality._packed_rows(iter([batch])) for r in b.to_pylist()]
    assert len(packed) > 1 and {(r["block"], r["kind"]) for r in packed} == {(5, 1)}
    back = [tuple(x.values()) for r in packed for b in pa.ipc.open_stream(r["data"]) for x in b.to_pylist()]
    assert back == [(i, g, t or b"") for i, g, t in zip(columns[1].to_pylist(), columns[2].to_pylist(), texts, strict=True)]
    assert sum(len(r["data"]) for r in packed) < 0.8 * sum(len(pa.compress(t, codec="lz4", asbytes=True)) for t in texts if t)


def test_kneser_ney_sums_to_one(spark):
    texts = spark.createDataFrame([("the cat sat on the mat.",), ("the dog sat.",)], "text string")
    model = quality.kneser_ney(quality.gram_counts(texts))
    for before in (b"the ", b"at o", b"zzzz"):
        context = 0
        for code in before:
            context = context << quality.BITS | code
        asked = spark.range(quality.SYMBOLS).select((F.lit(context << quality.BITS) + F.col("id")).alias("gram"))
        assert quality.probabilities(asked, model).agg(F.sum("p")).first()[0] == pytest.approx(1)



def test_toxicity(spark, docs, empty):
    rng = random.Random(9)
    plain = [f"{a}{b}" for a in ("th", "an", "er", "in") for b in ("e", "ing", "a", "on")]
    rows, marks = [], []
    for i in range(200):
        words = [rng.choice(plain) for _ in range(rng.randint(20, 200))]
        toxic = int(i % 5 == 0)
        for _ in range(6 * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(["knucklehead", "buffoon", "dimwit"]))
        rows.append((i, " ".join(words), "x"))
        marks.append((i, 1, toxic))
    texts = spark.createDataFrame(rows, "doc_id long, text string, score string")
    labels = spark.createDataFrame([*marks, (None, 1, 1), (5000, 1, None)], "doc_id long, quality int, toxic int")
    out = {r.doc_id: r for r in toxicity.score(texts, labels).collect()}
    held = [i for i, r in out.items() if r.held_out]
    assert len(held) > 20 and all(0 <= r.score <= 1 for r in out.values())
    assert sum(out[i].predicted == marks[i][2] for i in held) >= 0.95 * len(held)
    kept = toxicity.reject_toxic(texts, labels)
    assert kept.columns == texts.columns and 150 <= kept.count() <= 165
    odd = toxicity.score(docs, labels.limit(0)).collect()
    assert len(odd) == docs.count() and {r.score for r in odd} == {0.0}
    assert toxicity.score(empty, labels).count() == 0


def test_toxicity_by_hand(spark):
    """Scores are the logistic of the windows' length differences under the two dictionaries, over whole texts; held-out labels, other
    columns and the order of rows change nothing."""
    import zlib

    import zstandard

    rng = random.Random(19)
    plain = [f"{a}{b}" for a in ("th", "an", "er", "in") for b in ("e", "ing", "a", "on")]
    rows, marks = [], []
    for i in range(160):
        toxic = int(i % 4 == 0)
        words = [rng.choice(plain) for _ in range(rng.randint(20, 90))] + ["Vexatious", "scoundrel"] * toxic
        rng.shuffle(words)
        rows.append((i, " ".join(words), "en", "s"))
        marks.append((i, toxic))
    odd = [(900, None), (901, ""), (902, " \n"), (903, "x" * 100_000), (904, "vexatious " * 20_000), (905, rows[4][1]), (905, rows[4][1]), (None, rows[4][1])]
    rows += [(i, t, "fr", None) for i, t in odd]
    texts = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)
    held = {i for i, _ in marks if zlib.crc32(str(i).encode()) % 4 == 2}
    labels, flipped = (spark.createDataFrame([(i, 1 - t if flip and i in held else t) for i, t in marks], "doc_id long, toxic int") for flip in (False, True))
    got = sorted(tuple(r) for r in toxicity.score(texts, labels).collect() if r.doc_id is not None)
    assert got == sorted(tuple(r) for r in toxicity.score(texts.select("text", "doc_id").repartition(2), flipped).collect() if r.doc_id is not None)
    model = toxicity.fit(texts, labels)
    options = zstandard.ZstdCompressionParameters(
        format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=0, write_dict_id=0, write_checksum=0,
        strategy=zstandard.STRATEGY_GREEDY, min_match=4, window_log=16, hash_log=15, chain_log=15, search_log=6, target_length=16,
    )
    length = {}
    for name, content in (("ordinary", model.ordinary), ("toxic", model.toxic)):
        length[name] = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT), compression_params=options)
    want = []
    for i, t, _, _ in rows:
        words = (t or "").encode().lower().split()
        far = [len(length["ordinary"].compress(w)) - len(length["toxic"].compress(w)) for w in (b" ".join(words[a : a + 16]) for a in range(0, len(words), 16))]
        counts = np.array([sum(x >= d for x in far) for d in toxicity.DISTANCES], dtype=float)
        x = np.concatenate([[1.0], counts > 0, np.log1p(counts), 10 * counts / max(1, len(far))])
        score = 1 / (1 + np.exp(-np.clip(x @ model.weights, -30, 30)))
        if i is not None:
            want.append((i, zlib.crc32(str(i).encode()) % 4 == 2, pytest.approx(float(score), abs=1e-9), int(score >= 0.3)))
    assert got == sorted(want, key=lambda r: r[0])
    told = {r[0]: r[3] for r in got}
    assert told[904] == 1 and not any(told[i] for i in (900, 901, 902, 903)) and sum(told[i] == t for i, t in marks if i in held) >= 0.95 * len(held)


def test_toxicity_of_a_small_kind_of_text():
    """Markers that set apart a twelfth of the toxic texts, and stand in a few ordinary ones, are learnt beside the strong ones."""
    rng = random.Random(3)
    large = [f"{a}{b}" for a in ("th", "an", "er", "in") for b in ("e", "ing", "a", "on")]
    small = [f"{a}{b}" for a in ("zwö", "güch", "pfä", "schü") for b in ("keit", "lich", "ung", "ö")]

    def text(words, markers, times):
        out = [rng.choice(words) for _ in range(60)]
        for _ in range(times):
            out.insert(rng.randrange(len(out)), rng.choice(markers) + rng.choice(words))
        return " ".join(out).encode()

    strong, weak = ["knucklehead", "buffoon", "dimwit"], ["krachtok", "vulpnar"]
    toxic = [text(large, strong, 8) for _ in range(220)] + [text(small, weak, 6) for _ in range(20)]
    ordinary = [text(large, strong, 0) for _ in range(300)] + [text(small, weak, int(i < 12)) for i in range(120)]
    rng.shuffle(toxic)
    rng.shuffle(ordinary)
    model = toxicity.Model(toxic, ordinary)
    assert all(part in model.toxic for part in (b"krach", b"vulpn", b"buffoo")) and len(model.toxic) == len(model.ordinary)
    score = model.scorer()
    found = [score(text(small, weak, 6)) >= toxicity.PREDICT for _ in range(20)]
    false = [score(text(small, weak, 0)) >= toxicity.PREDICT for _ in range(20)]
    assert sum(found) >= 16 and sum(false) <= 2


def test_one_row_stays_of_each_group_whatever_its_doc_id(spark):
    rng = random.Random(8)
    say = lambda: " ".join(rng.choice("abcdefghij") + str(rng.randrange(90)) for _ in range(80))
    a, b, c, d, e = (say() for _ in range(5))
    rows = [(7, a), (7, b), (3, b), (7, c), (None, c), (None, d), (None, d), (None, e), (9, None), (None, None), (7, a)]
    kept = simhash.keep_one_per_group(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert Counter(map(tuple, kept)) == Counter([(7, a), (3, b), (7, c), (None, d), (None, e), (9, None)])


def test_mixing_is_a_loop_over_bits():
    """The score of lanes that are mixed side by side is that of a plain loop over the bits of each text."""
    rng = np.random.default_rng(6)
    counts = np.array([5, context_mixing.LANE + 40, 1, 300])
    x = np.zeros((counts.sum(), context_mixing.WIDE), dtype=np.float32)
    x[:, : context_mixing.MODELS + 1] = rng.normal(size=(len(x), context_mixing.MODELS + 1))
    x[::7, context_mixing.MODELS] = 0
    y, words = rng.integers(0, 2, len(x)).astype(np.int8), rng.integers(0, 2, len(x)).astype(bool)
    got, _ = context_mixing.mix(x, words, y, counts, context_mixing.start_weights())
    at = 0
    for n, score in zip(counts, got, strict=True):
        total = 0.0
        for k in range(n):
            if k % context_mixing.LANE == 0:
                w, slope, offset = context_mixing.start_weights().astype(float), 1.0, 0.0
            xs = x[at + k, : context_mixing.MODELS + 1].astype(float)
            gate = int(xs[-1] != 0) + 2 * int(words[at + k])
            dot = xs @ w[gate]
            p = 1 / (1 + np.exp(-(slope * dot + offset)))
            total += np.log2(p if y[at + k] else 1 - p)
            error = y[at + k] - p
            w[gate] += context_mixing.RATE * error * xs
            offset, slope = offset + context_mixing.REFINE_RATE * error, slope + context_mixing.REFINE_RATE * error * dot
        assert score == pytest.approx(total, rel=1e-4, abs=1e-3)
        at += n


def test_bit_counts_are_exact(spark):
    """Both sides of a slot go far beyond 16 bits, in one task and in the sum, and keep their ratio."""
    code = context_mixing.Code([b"aa", b"b"], [5, 3], 2, 4, np.ones(257, dtype=np.int64))
    text = b"aa b aa aa " * 40000
    rows = spark.createDataFrame([(text,)] * 3, "text binary").repartition(3)
    counts = context_mixing.bit_counts(rows, spark.sparkContext.broadcast(code), 14)
    symbols, hashes, _ = code.steps(*code.tokens([text.split()]))
    node, y, length = code.paths(symbols)
    for (zeros, ones), h in zip(counts, hashes, strict=True):
        at = code.slots((h >> np.uint64(32)).astype(np.uint32), code.turns(node), length, 14)
        assert (zeros == 3 * np.bincount(at[y == 0], minlength=1 << 14)).all() and (ones == 3 * np.bincount(at[y == 1], minlength=1 << 14)).all()
        assert max(zeros.max(), ones.max()) > 3 * 65535


def test_starting_weights_are_fitted_on_every_training_text(spark):
    """No text is left out: one long text among many changes the weights, and without texts they stay as they start."""
    texts = [(" ".join(f"w{(i * k) % 97}" for k in range(40 + 9000 * (i == 3))),) for i in range(400)] + [("",)]
    docs = spark.createDataFrame(texts, "text string").select(F.col("text").cast("binary").alias("text")).repartition(3)
    code = context_mixing.Code([b"w1", b"w2"], [5, 3], 2, 4, np.ones(257, dtype=np.int64))
    counts = [(np.ones(1 << 14, dtype=np.float32), np.ones(1 << 14, dtype=np.float32))] * context_mixing.MODELS
    scorer = context_mixing.Scorer(code, 14, [np.zeros(1 << 14, dtype=np.float32)] * context_mixing.MODELS, context_mixing.start_weights())
    whole = context_mixing.fitted_weights(docs, scorer, counts)
    assert whole.shape == context_mixing.start_weights().shape and np.isfinite(whole).all() and not np.allclose(whole, context_mixing.start_weights())
    assert np.array_equal(context_mixing.fitted_weights(docs.limit(0), scorer, counts), context_mixing.start_weights())
    few = context_mixing.fitted_weights(docs.where(F.octet_length("text") < 1000), scorer, counts)
    assert not np.allclose(whole, few, atol=1e-7)


def test_starting_weights_are_near_the_best(spark):
    """The fit reaches what a plain Newton loop over all bits at once reaches: it does not stop near the weights it starts from."""
    rng = np.random.default_rng(4)
    texts = [" ".join(f"w{min(int(i), 400)}" for i in rng.zipf(1.4, 300)).encode() for _ in range(400)]
    seen = Counter(b" ".join(texts).split())
    head = [w for w, n in seen.items() if n >= 4]
    code = context_mixing.Code(head, [seen[w] for w in head], len(texts), sum(seen.values()) - sum(seen[w] for w in head), np.ones(257, dtype=np.int64))
    docs = spark.createDataFrame([(t,) for t in texts], "text binary").repartition(3)
    counts = [tuple(c.astype(np.float32) for c in pair) for pair in context_mixing.bit_counts(docs, spark.sparkContext.broadcast(code), 14)]
    scorer = context_mixing.Scorer(code, 14, [context_mixing.log_odds(*c) for c in counts], context_mixing.start_weights())
    got = context_mixing.fitted_weights(docs, scorer, counts)
    symbols, hashes, _ = code.steps(*code.tokens([t.split() for t in texts]))
    node, y, length = code.paths(symbols)
    x = [code.prior[node]]
    for (zeros, ones), h in zip(counts, hashes, strict=True):
        at = code.slots((h >> np.uint64(32)).astype(np.uint32), code.turns(node), length, 14)
        x.append(context_mixing.log_odds(zeros[at] - (y == 0), ones[at] - (y == 1)))
    x, gate = np.stack(x, axis=1).astype(float), (x[-1] != 0) + 2 * (node <= code.end)
    loss = lambda rows, s, w: np.log1p(np.exp(-s * (rows @ w))).sum()
    best = found = start = 0.0
    for g in range(context_mixing.GATES):
        rows, s, w = x[gate == g], 2.0 * y[gate == g] - 1, context_mixing.start_weights()[g].astype(float)
        start, found = start + loss(rows, s, w), found + loss(rows, s, got[g].astype(float))
        for _ in range(12):
            p = 1 / (1 + np.exp(-(rows @ w)))
            w = w + np.linalg.solve((rows.T * (p * (1 - p))) @ rows + np.eye(3), rows.T @ ((s > 0) - p))
        best += loss(rows, s, w)
    assert best < found < best + 0.05 * (start - best)


def test_lexicon_numbers_words_as_a_dictionary_does():
    rng = random.Random(3)
    words = list({bytes(rng.choice([0, 97, 255]) for _ in range(rng.randint(1, 20))) for _ in range(6000)} - {b"a", b"a\0", b"\0"})
    known = [b"a", b"\0", *words[:2000]]
    want = {w: i for i, w in enumerate(known)}
    asked = [b"a\0", b"a", *words, *known]
    assert context_mixing.Lexicon(known).numbers(asked, -1).tolist() == [want.get(w, -1) for w in asked]
    assert context_mixing.Lexicon([]).numbers(asked, 7).tolist() == [7] * len(asked)
    code = context_mixing.Code(known, [1] * len(known), 1, 1, np.ones(257, dtype=np.int64))
    flat, ids, lengths = code.tokens([[], [b"\0", b"new"], [b"a"]])
    assert flat == [None, b"\0", b"new", None, b"a", None] and lengths.tolist() == [1, 3, 2]
    assert ids.tolist() == [code.end, 1, code.escape, code.end, 0, code.end]


def test_words_are_read_without_an_object_each():
    rng = random.Random(5)
    odd = [b"", b" ", b"\t\n A  b\x0b\x0cc\r", "\u00c9 \u00a0x y\x1cz".encode(), b"\0 a\0b \xff", b"Q" * 100 + b" B " + b"y" * 15, bytes(rng.randrange(256) for _ in range(4000)), b""]
    code = context_mixing.Code([b"a", b"b", b"y" * 15, b"q" * 100], [4, 3, 2, 1], 1, 1, np.ones(257, dtype=np.int64))
    numbers = {b"a": 0, b"b": 1, b"y" * 15: 2, b"q" * 100: 3, None: code.end}
    for texts in ([b""], odd, odd[::-1]):
        want = [w for t in texts for w in (*t.lower().split(), None)]
        flat, ids, lengths = code.read(texts)
        assert flat.take(np.arange(len(ids))) == want and ids.tolist() == [numbers.get(w, code.escape) for w in want]
        assert lengths.tolist() == [len(t.split()) + 1 for t in texts]
    many = [b" ".join(b"%d" % rng.randrange(10**6) for _ in range(1000)) for _ in range(50)]
    code.read(many)
    before = sys.getallocatedblocks()
    kept = code.read(many)
    assert len(kept[1]) == 50_050 and sys.getallocatedblocks() - before < 5000


def test_contexts_end_where_texts_and_words_begin(monkeypatch):
    monkeypatch.setattr(context_mixing, "FREQUENT", 2)
    code = context_mixing.Code([b"a", b"b", b"c"], [5, 3, 2], 2, 4, np.ones(257, dtype=np.int64))
    texts = [[], [b"c", b"a", b"c", b"xyzuvw", b"c", b"b", b"b"], [b"c", b"c"], [b"q"], [], [b"a", b"c"]]
    one = lambda kind, *parts: int(context_mixing._hash(kind, *(np.array([p], dtype=np.uint64) for p in parts))[0])
    number = {b"a": 0, b"b": 1, b"c": 2, None: code.end}
    want, counts = [], []
    for t in texts:
        often = last = 0
        counts.append(-len(want))
        for w in (*t, None):
            i = number.get(w, code.escape)
            want.append((i, one(1, often), one(2, last)))
            last = i + 1
            often = last if i < context_mixing.FREQUENT else often
            if i == code.escape:
                spelt = [*w, 256]
                for k, x in enumerate(spelt):
                    p = ([0] * 4 + [y + 1 for y in spelt[:k]])[: -5 : -1]
                    want.append((x + code.first_byte, one(3, *p[:2]), one(4, *p)))
        counts[-1] += len(want)
    symbols, hashes, n = code.steps(*code.tokens(texts))
    assert list(zip(symbols.tolist(), *hashes.tolist(), strict=True)) == want and n.tolist() == counts


def test_sums_of_the_fit_are_plain_ones():
    rng = np.random.default_rng(9)
    for share in (0, 0.3, 1):
        x = rng.normal(size=(context_mixing.MODELS + 1, 500)).astype(np.float32)
        x[-1, rng.random(500) < share] = 0
        y, words = rng.integers(0, 2, 500).astype(np.int8), rng.random(500) < 0.5
        for words in (words, words | True, words & False):
            model = context_mixing._Newton()
            model.add(list(x), words, y)
            gate = (x[-1] != 0) + 2 * words
            for g in range(context_mixing.GATES):
                rows, w = x[:, gate == g].astype(float), context_mixing.start_weights()[g]
                p = 1 / (1 + np.exp(-(w @ rows)))
                assert np.allclose(model.slope[g], rows @ (y[gate == g] - p), atol=1e-3)
                assert np.allclose(model.whole()[g], (rows * (p * (1 - p))) @ rows.T + np.eye(len(x)), atol=1e-3)


def test_fit_takes_each_bit_out_of_the_counts_that_predict_it():
    zeros, ones = np.array([0, 1, 5]), np.array([2, 0, 7])
    got = context_mixing._apart(zeros, ones).reshape(-1, 2)
    assert np.array_equal(got[:, 0], context_mixing.log_odds(np.array([0, 0, 4]), ones))
    assert np.array_equal(got[:, 1], context_mixing.log_odds(zeros, np.array([1, 0, 6])))
