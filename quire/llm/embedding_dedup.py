"""Embedding near-duplicates by product quantisation with exact rerank.

Vectors are normalised; cosine >= t means distance <= r = sqrt(2 - 2t). Equal vectors of one label form one class. A
coarse quantiser deals the classes to inverted lists (nearest centroid), and the residual is coded in ``SUBSPACES``
bytes. Centroids and codebooks are fitted on a bounded sample; everything else covers every vector:

- probes: a vector x lies in the list of its nearest centroid c. If ||x - q|| <= r, q is within r of c's cell, so
  (|q - c|^2 - |q - c0|^2) / (2 |c - c0|) <= r for q's nearest centroid c0. All lists that satisfy this and do not come
  before q's own are probed: the bound holds for both ends of a pair, so one of them finds it and both are counted.
- table lookups: the asymmetric distance from q to the decoded x^ differs from the true one by at most e = ||x - x^||,
  which is stored with the code, so candidates with distance above r + e cannot qualify and the others are reranked by
  cosine in double precision.

Both bounds are exact: no pair is lost, whatever the fit.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import connected_components, hash_sample, save, small_batches

SAMPLE = 8192
#: Rows a list should hold on average, within a label, and the vectors of the sample a list at least. Lists grow with the table up to
#: LISTS, which bounds the broadcast centroids and the sample; beyond it lists get longer and are searched in blocks.
LIST_ROWS = 512
LIST_SAMPLE = 8
LISTS = 8192
SUBSPACES = 8
CODES = 64
BLOCK_ROWS = 2048
SET_ROWS = 8192
#: For rounding in the bounds; the rerank decides.
SLACK = 1e-5


def _nearest(x: np.ndarray, centres: np.ndarray, rows: int = 4096) -> np.ndarray:
    norms = (centres**2).sum(1)
    return np.concatenate([np.empty(0, dtype=np.int64), *(np.argmin(norms - 2 * x[a : a + rows] @ centres.T, axis=1) for a in range(0, len(x), rows))])


def _kmeans(x: np.ndarray, k: int, seed: int, rounds: int = 8) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), size=min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = _nearest(x, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        counts = np.bincount(near, minlength=len(centres))
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return centres


class Quantiser:
    """Coarse centroids and residual codebooks, fitted on a bounded sample of normalised vectors."""

    def __init__(self, sample: np.ndarray, lists: int, subspaces: int = SUBSPACES, codes: int = CODES, seed: int = 7):
        dims = sample.shape[1]
        self.coarse = np.unique(_kmeans(sample, lists, seed), axis=0)
        self.cuts = np.linspace(0, dims, min(subspaces, dims) + 1).astype(int)
        rest = sample - self.coarse[self.assign(sample)]
        self.books = [_kmeans(rest[:, a:b], codes, seed + 1 + j) for j, (a, b) in enumerate(zip(self.cuts[:-1], self.cuts[1:], strict=True))]

    def assign(self, x: np.ndarray) -> np.ndarray:
        return _nearest(x, self.coarse)

    def encode(self, x: np.ndarray, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes, and the distance of each vector from what its code decodes to."""
        rest = x - self.coarse[lists]
        codes, error = np.empty((len(x), len(self.books)), dtype=np.uint8), np.zeros(len(x))
        for j, (a, b) in enumerate(zip(self.cuts[:-1], self.cuts[1:], strict=True)):
            codes[:, j] = np.argmin((self.books[j] ** 2).sum(1) - 2 * rest[:, a:b] @ self.books[j].T, axis=1)
            error += ((rest[:, a:b] - self.books[j][codes[:, j]]) ** 2).sum(1)
        return codes, np.sqrt(error)

    def probes(self, q: np.ndarray, own: np.ndarray, radius: float, rows: int = 1024) -> list[np.ndarray]:
        """For each query, the list it is in and every later list that can hold a vector within ``radius``."""
        out, norms, numbers = [], (self.coarse**2).sum(1), np.arange(len(self.coarse))
        for at in range(0, len(q), rows):
            x, home = q[at : at + rows], own[at : at + rows]
            d2 = np.maximum((x**2).sum(1)[:, None] + norms - 2 * x @ self.coarse.T, 0)
            gap = np.sqrt(np.maximum(norms[home][:, None] + norms - 2 * self.coarse[home] @ self.coarse.T, 1e-30))
            beyond = (d2 - d2[np.arange(len(x)), home][:, None]) / (2 * gap)
            beyond[np.arange(len(x)), home] = 0
            out += [np.flatnonzero(row) for row in (beyond <= radius + SLACK) & (numbers >= home[:, None])]
        return out

    def near(self, q: np.ndarray, which: int, codes: np.ndarray, error: np.ndarray, radius: float) -> np.ndarray:
        """queries x rows of one list: True where the table distance leaves a link possible."""
        rest = q - self.coarse[which]
        total = np.zeros((len(q), len(codes)))
        for j, (a, b) in enumerate(zip(self.cuts[:-1], self.cuts[1:], strict=True)):
            book = self.books[j]
            table = (rest[:, a:b] ** 2).sum(1)[:, None] + (book**2).sum(1) - 2 * rest[:, a:b] @ book.T
            total += table[:, codes[:, j]]
        return np.sqrt(np.maximum(total, 0)) <= radius + error + SLACK


def scaled(vectors: np.ndarray) -> np.ndarray:
    """By a power of two each, which changes no cosine, so that no square under- or overflows. No vector is zero."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1))[1][:, None])


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors**2).sum(1))[:, None]


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, in double precision, of scaled vectors."""
    return (a * b).sum(1) / (np.sqrt((a * a).sum(1)) * np.sqrt((b * b).sum(1)))


def near_duplicates(vectors: DataFrame, threshold: float = 0.98, list_rows: int = LIST_ROWS, sample: int = SAMPLE, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of (vec_id, embedding, label); see the module's docstring.

    Rows link when their labels are equal and not null and their cosine is ``threshold`` or more. Vectors that are null,
    empty, zero or hold null or non-finite components, and rows without a label, link with nothing; nor do vectors of different
    lengths. Repeated vec_ids are rows each, and a row without vec_id links like any other but names no component unless
    it is alone (then component_id is null and kept false). Other columns are ignored; an empty table gives an empty result.
    """
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    v = F.transform("embedding", lambda x: x.cast("double"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), v.alias("v"))
    sound = F.col("v").isNotNull() & F.col("label").isNotNull() & F.forall("v", finite) & F.exists("v", lambda x: x != 0)
    rows = save(rows.withColumn("sound", F.coalesce(sound, F.lit(False))), "vectors")
    classes = rows.where("sound").groupBy("label", "v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("members"))
    classes = save(classes.withColumn("c", F.monotonically_increasing_id()).withColumn("dims", F.size("v")), "classes")
    links = _class_links(classes, threshold, list_rows, sample, block_rows)
    links = save(links, "class-links")
    more = links.groupBy("c").agg(F.sum("links").alias("links"))
    parts = connected_components(links.where("root is not null").select(F.col("c").alias("a"), F.col("root").alias("b")))
    named = classes.join(parts, classes.c == parts.node, "left").join(more, "c", "left")
    named = named.select("label", "v", "rep", F.coalesce("component", "c").alias("part"), (F.col("members") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    least = named.groupBy("part").agg(F.min("rep").alias("component_id"))
    named = named.join(least, "part").select("label", "v", "n_links", "component_id")
    linked = rows.where("sound").join(named, ["label", "v"]).select("vec_id", "n_links", "component_id")
    alone = rows.where("not sound").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = linked.union(alone)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    return scaled(np.array(vectors.tolist(), dtype=float).reshape(len(vectors), width))


def _class_links(classes: DataFrame, threshold: float, list_rows: int, sample: int, block_rows: int) -> DataFrame:
    """c, links (members of other classes linked directly), root: rows of each block, with a spanning forest.

    Vectors are padded with zeros to a power of two, so that few widths differ; the length is part of the label.
    """
    spark = classes.sparkSession
    schema = "c long, links long, root long"
    radius = float(np.sqrt(max(0.0, 2 - 2 * threshold)))
    out = spark.createDataFrame([], schema)
    width = F.lit(2).cast("double") ** F.ceil(F.log2(F.col("dims").cast("double")))
    classes = classes.withColumn("label", F.concat("dims", F.lit(":"), "label")).withColumn("width", width.cast("int"))
    classes = classes.withColumn("v", F.concat("v", F.array_repeat(F.lit(0.0), (F.col("width") - F.col("dims")).cast("int"))))
    for width in sorted(r[0] for r in classes.select("width").distinct().collect()):  # 31 powers of two at most
        own = classes.where(F.col("width") == width)
        rows, labels = own.agg(F.count("*"), F.approx_count_distinct("label")).first()
        lists = min(LISTS, max(1, round(rows / max(1, labels) / list_rows)))
        seen = hash_sample(own, rows, max(sample, LIST_SAMPLE * lists), "v", "label").select("v").toPandas()
        model = Quantiser(unit(_matrix(seen["v"], width)), lists)
        shipped = spark.sparkContext.broadcast(model)  # at most LISTS x width and CODES x width doubles

        def place(batches, shipped=shipped, width=width):
            for pdf in batches:
                if len(pdf):
                    x = unit(_matrix(pdf["v"], width))
                    m = shipped.value
                    at = m.assign(x)
                    codes, error = m.encode(x, at)
                    yield pdf.assign(list=at, codes=[c.tobytes() for c in codes], error=error, probes=[p.tolist() for p in m.probes(x, at, radius)])

        placed = save(small_batches(own.select("c", "label", "v", "members")).mapInPandas(place, "c long, label string, v array<double>, members long, list long, codes binary, error double, probes array<long>"), "codes")
        sizes = placed.groupBy("label", "list").agg(F.ceil(F.count("*") / block_rows).cast("long").alias("blocks"))
        # one list may be asked by all
        sets = placed.select("label", F.explode("probes").alias("list")).groupBy("label", "list").agg(F.ceil(F.count("*") / SET_ROWS).cast("long").alias("sets"))
        sizes = save(sizes.join(sets, ["label", "list"]), "list-sizes")
        index = placed.join(sizes, ["label", "list"]).withColumn("block", F.pmod(F.xxhash64("c"), F.col("blocks")))
        index = index.withColumn("set", F.explode(F.sequence(F.lit(0).cast("long"), F.col("sets") - 1)))
        asked = placed.select("c", "members", "label", "v", F.col("list").alias("home"), F.explode("probes").alias("list"))
        asked = asked.join(sizes, ["label", "list"]).withColumn("set", F.pmod(F.xxhash64("c", F.lit(1)), F.col("sets")))
        asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        key = ["label", "list", "block", "set"]

        asked = asked.select(*[F.col(k).alias(f"q_{k}") for k in key], F.col("c").alias("q_c"), F.col("v").alias("q_v"), F.col("members").alias("q_members"), F.col("home").alias("q_home"))
        found = asked.groupBy(*[f"q_{k}" for k in key]).cogroup(index.select(*key, "c", "v", "members", "codes", "error").groupBy(*key)).applyInPandas(_linker(shipped, width, radius, threshold), schema)
        out = out.union(found)
    return out


def _linker(shipped, width: int, radius: float, threshold: float):
    def link(q: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(x):
            return pd.DataFrame({"c": pd.Series(dtype="int64"), "links": pd.Series(dtype="int64"), "root": pd.Series(dtype="int64")})
        return _link_block(shipped.value, int(x["list"].iloc[0]), q, x, width, radius, threshold)

    return link


def _link_block(model: Quantiser, which: int, q: pd.DataFrame, x: pd.DataFrame, width: int, radius: float, threshold: float) -> pd.DataFrame:
    qv, xv = _matrix(q["q_v"], width), _matrix(x["v"], width)
    qc, xc, members = q["q_c"].to_numpy(), x["c"].to_numpy(), x["members"].to_numpy()
    # rows of another list do not ask for these in turn
    own, away = q["q_members"].to_numpy(), q["q_home"].to_numpy() != which
    codes = np.frombuffer(b"".join(x["codes"]), dtype=np.uint8).reshape(len(x), -1)
    qu, error, parent = unit(qv), x["error"].to_numpy(), {}

    def root(a: int) -> int:
        while parent.setdefault(a, a) != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    count, back = np.zeros(len(q), dtype=np.int64), np.zeros(len(x), dtype=np.int64)
    for at in range(0, len(q), 512):
        i, j = np.nonzero(model.near(qu[at : at + 512], which, codes, error, radius))
        i += at
        for cut in range(0, len(i), 1 << 16):
            a, b = i[cut : cut + (1 << 16)], j[cut : cut + (1 << 16)]
            same = qc[a] != xc[b]
            a, b = a[same], b[same]
            fit = cosine(qv[a], xv[b]) >= threshold
            a, b = a[fit], b[fit]
            np.add.at(count, a, members[b])
            np.add.at(back, b, np.where(away[a], own[a], 0))
            for s, t in zip(qc[a].tolist(), xc[b].tolist(), strict=True):
                s, t = root(s), root(t)
                if s != t:
                    parent[max(s, t)] = min(s, t)
    forest = [(c, r) for c in parent if (r := root(c)) != c]
    return pd.DataFrame({
        "c": np.concatenate([qc[count > 0], xc[back > 0], np.array([e[0] for e in forest], dtype=np.int64)]),
        "links": np.concatenate([count[count > 0], back[back > 0], np.zeros(len(forest), dtype=np.int64)]),
        "root": pd.array([None] * int((count > 0).sum() + (back > 0).sum()) + [e[1] for e in forest], dtype="Int64"),
    })


def op6_query(spark, sf_dir):
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


OP6_SQL = """WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
c AS (SELECT vec_id, vec_id AS r FROM embeddings UNION SELECT c.vec_id, l.b FROM c JOIN l ON c.r = l.a),
n AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT c.vec_id, coalesce(any_value(n_links), 0)::BIGINT AS n_links, min(r) AS component_id, c.vec_id = min(r) AS kept
FROM c LEFT JOIN n ON n.a = c.vec_id GROUP BY c.vec_id"""
