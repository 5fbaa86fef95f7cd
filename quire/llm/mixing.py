"""Mixing sources to target weights: blocks of words, drawn by source, mapped through index permutations.

Every step is a DataFrame expression. The words of each source, in doc_id order, are packed into blocks of
``block_words``. A source's quota of slots is its target in blocks; its counts per output shard are a multinomial draw
under that quota: every slot falls on a shard by its own hash, so that totals stay on target (drawing the totals too would
miss the targets of small sources and pass the cap). Slots are numbered along the shards, so the counts decide
which slots, and with them which blocks, an output shard holds; the report names each document's shards. Slot j takes block
``permute(j mod blocks)`` of epoch ``j div blocks``; the permutation is a swap-or-not shuffle (Hoang, Morris &
Rogaway 2012), an exact bijection on any range, so a block is taken floor or ceiling of quota / blocks times and never
more than ``cap`` times. Blocks are then joined to documents by (source, index).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import WORD, documents, partitions, save

BLOCK_WORDS = 64
SHARD_SLOTS = 1 << 13
#: Runs of SHARD_SLOTS slots that one array of a source's slots is cut into.
RUNS = 1024
WEIGHTS = (5, 2, 1)
GROWTH = 1.5
CAP = 2
SEED = 17
ROUNDS = 12
#: doc_id bits summed at each level of the prefix sums.
LEVEL_BITS = 12
#: Park-Miller modulus, shared with the SQL form.
PRIME = 2147483647
SHARD_KEYS = (1013904223, 69069)


def mixed(*parts: Column) -> Column:
    """A value of 0 to PRIME - 1 from small non-negative numbers, by arithmetic that any SQL engine has."""
    h = F.lit(SEED).cast("long")
    for p in parts:
        h = ((h * 48271 + p.cast("long") % PRIME + 11) * 69621) % PRIME
    return h


def drawn_shard(slot: Column, rank: Column, shards: Column) -> Column:
    """The shard that a slot falls on: squared twice, as one that is linear in the slot would deal slots out evenly."""
    h = mixed(slot, rank)
    for c in SHARD_KEYS:
        h = (h * h + F.lit(c)) % PRIME
    return h % shards


def permute(x: Column, n: Column, *key: Column) -> Column:
    """Swap-or-not shuffle of x in [0, n): one bijection for each value of ``key``. A fold over the round numbers."""

    def step(v: Column, r: Column) -> Column:
        partner = (mixed(r, *key) % n - v + n) % n
        return F.when(F.bit_count(mixed(r + 100, F.greatest(v, partner), *key)) % 2 == 1, partner).otherwise(v)

    return F.aggregate(F.sequence(F.lit(1).cast("long"), F.lit(ROUNDS).cast("long")), x.cast("long"), step)


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, growth: float = GROWTH, cap: int = CAP) -> DataFrame:
    """(source, source_size) -> + rank (from 0, by code point, null last), target.

    Shares of ``growth`` times all words by weight; what exceeds ``cap`` times a source's size is shared again by weight
    until nothing does. That ends with min(cap * size, level * weight) for one level, found by walking the sources in
    order of cap * size / weight. One row a source: windows over this table are small.
    """
    n = len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % n + 1).cast("int"))
    ranked = sizes.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").isNull(), F.col("source"))) - 1)
    ranked = ranked.withColumn("w", weight).withColumn("most", F.col("source_size") * F.lit(float(cap)))
    everything = Window.partitionBy()
    before = Window.orderBy(F.col("most") / F.col("w"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    walked = (
        ranked.withColumn("total", F.sum("source_size").over(everything) * F.lit(growth))
        .withColumn("full", F.coalesce(F.sum("most").over(before), F.lit(0.0)))
        .withColumn("left_w", F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
        .withColumn("level", (F.col("total") - F.col("full")) / F.col("left_w"))
    )
    # sources before the first that stays under its cap are full; all from it on share one level
    walked = walked.withColumn("open", F.when(F.col("level") * F.col("w") <= F.col("most"), F.struct(F.col("most") / F.col("w"), F.col("rank"), F.col("level"))))
    under = F.min("open").over(everything)
    target = F.least(F.col("most"), F.coalesce(under["level"] * F.col("w"), F.col("most")))
    return walked.withColumn("target", target).select("source", "source_size", F.col("rank").cast("long").alias("rank"), "target")


def _starts(rows: DataFrame) -> DataFrame:
    """rows(rank, doc_id, n, size) -> + start: words of the source in all rows before, by (doc_id, n).

    A tree of prefix sums over doc_id: each level sums 2**LEVEL_BITS neighbours, so no window holds a whole source.
    """
    levels = [F.shiftright("doc_id", LEVEL_BITS * k) for k in range(1, 5)]
    df = rows.withColumn("l1", levels[0])
    sums = df.groupBy("rank", "l1").agg(F.sum("size").alias("size"))
    tables = [sums]
    for k in range(2, 5):
        tables.append(tables[-1].withColumn(f"l{k}", F.shiftright(f"l{k - 1}", LEVEL_BITS)).groupBy("rank", f"l{k}").agg(F.sum("size").alias("size")))
    offsets = tables[-1].withColumn("base", F.coalesce(F.sum("size").over(Window.partitionBy("rank").orderBy("l4").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    offsets = offsets.select("rank", "l4", "base")
    for k in (3, 2, 1):
        w = Window.partitionBy("rank", f"l{k + 1}").orderBy(f"l{k}").rowsBetween(Window.unboundedPreceding, -1)
        inner = tables[k - 1].withColumn(f"l{k + 1}", F.shiftright(f"l{k}", LEVEL_BITS)).withColumn("in", F.coalesce(F.sum("size").over(w), F.lit(0)))
        offsets = inner.join(offsets, ["rank", f"l{k + 1}"]).select("rank", f"l{k}", (F.col("base") + F.col("in")).alias("base"))
    w = Window.partitionBy("rank", "l1").orderBy("doc_id", "n").rowsBetween(Window.unboundedPreceding, -1)
    inner = df.withColumn("in", F.coalesce(F.sum("size").over(w), F.lit(0)))
    return inner.join(offsets, ["rank", "l1"]).withColumn("start", F.col("base") + F.col("in")).drop("l1", "in", "base")


def block_times(
    spark, sources: DataFrame, block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS
) -> tuple[DataFrame, DataFrame]:
    """The draw: (rank, shard, draws, first) counts a shard, and (rank, shard, slot, block) for every slot."""
    n = partitions(spark)
    plan = sources.withColumn("blocks", F.ceil(F.col("source_size") / block_words).cast("long"))
    quota = F.least(F.round(F.col("target") / F.col("source_size") * F.col("blocks")), F.col("blocks") * CAP).cast("long")
    plan = plan.where("source_size > 0").withColumn("quota", quota)
    shards = F.greatest(F.lit(1), F.ceil(F.sum("quota").over(Window.partitionBy()) / shard_slots)).cast("long")
    plan = save(plan.withColumn("shards", shards).select("rank", "blocks", "quota", "shards"), "quotas")
    # a source's slots in two steps, so that no array grows with the source
    part, whole = F.lit(shard_slots * RUNS).cast("long"), F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("quota") / (shard_slots * RUNS)).cast("long")))
    runs = plan.select("*", whole.alias("part")).select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(RUNS - 1).cast("long"))).alias("run"))
    runs = runs.withColumn("from", F.col("part") * part + F.col("run") * shard_slots).withColumn("to", F.least(F.col("from") + shard_slots, F.col("quota")) - 1)
    runs = runs.where("from <= to").repartition(n, "rank", "part", "run")
    slots = runs.select("rank", "blocks", "shards", F.explode(F.sequence("from", "to")).alias("slot"))
    counts = slots.groupBy("rank", "blocks", drawn_shard(F.col("slot"), F.col("rank"), F.col("shards")).alias("shard")).agg(F.count("*").alias("draws"))
    numbered = counts.select("rank", "blocks", F.col("shard").alias("doc_id"), F.lit(0).alias("n"), F.col("draws").alias("size"))
    counts = save(_starts(numbered).select("rank", "blocks", F.col("doc_id").alias("shard"), F.col("size").alias("draws"), F.col("start").alias("first")), "draws")
    drawn = counts.repartition(n, "rank", "shard").select(
        "rank", "blocks", "shard", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("draws") - 1)).alias("slot")
    )
    block = permute(F.col("slot") % F.col("blocks"), F.col("blocks"), F.col("rank"), F.floor(F.col("slot") / F.col("blocks")))
    return counts, drawn.select("rank", "shard", "slot", block.alias("block"))


def mix(docs: DataFrame, block_words: int = BLOCK_WORDS) -> tuple[DataFrame, DataFrame]:
    """(rows, spans): every row of ``docs`` numbered and measured, and the word spans that the mix takes.

    rows: doc_id, n (tells repeated doc_ids apart), source, rank, size, source_size, target, start. spans: rank, doc_id,
    n, block, from, to (word offsets in the document, to excluded), times (1 or more), first_shard, last_shard (that take it).

    Null texts and texts without words have size 0 and are never taken. A null source is a source of its own, last in
    order. Rows with equal doc_id are ordered by size and text hash. A row without doc_id has its text's hash for one, so that many
    such rows meet in no task. An empty table gives empty results. Columns other than doc_id, text and source are ignored.
    """
    spark = docs.sparkSession
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    measured = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), size.alias("size"), F.xxhash64("text").alias("h")
    )
    measured = save(measured, "sizes")
    sizes = measured.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = save(source_targets(sizes), "sources")
    repeat = Window.partitionBy("rank", "doc_id").orderBy("size", "h")
    ranked = measured.join(sources.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    ranked = ranked.withColumn("absent", F.col("doc_id").isNull()).withColumn("doc_id", F.coalesce("doc_id", "h")).withColumn("n", F.row_number().over(repeat).cast("long"))
    rows = save(_starts(ranked), "rows")
    _, drawn = block_times(spark, sources, block_words)
    times = drawn.groupBy("rank", "block").agg(F.count("*").alias("times"), F.min("shard").alias("first_shard"), F.max("shard").alias("last_shard"))
    first, last = F.floor(F.col("start") / block_words), F.floor((F.col("start") + F.col("size") - 1) / block_words)
    pieces = rows.where("size > 0").select("rank", "doc_id", "n", "start", "size", F.explode(F.sequence(first, last)).alias("block"))
    begin = F.greatest(F.col("block") * block_words - F.col("start"), F.lit(0))
    end = F.least((F.col("block") + 1) * block_words - F.col("start"), F.col("size"))
    pieces = pieces.select("rank", "doc_id", "n", "block", begin.alias("from"), end.alias("to"))
    # both sides come out of explode, whose growth size estimates do not see: never broadcast
    return rows, pieces.hint("merge").join(times, ["rank", "block"]).select("rank", "doc_id", "n", "block", "from", "to", "times", "first_shard", "last_shard")


def mixture(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` as the mix takes them, with the same columns: one row for each document and repeat k = 1 .. CAP.

    The text of repeat k is what is taken k times or more: the whole text unchanged where that is all of it, else its
    words joined by single spaces; n_chars, if there, is counted anew. Documents of which nothing is taken go, as do
    texts without words. Of rows with equal doc_id each gets its own spans.
    """
    rows, spans = mix(docs, block_words)
    key = ["rank", "doc_id", "n"]
    copies = spans.select(*key, "from", "to", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("k"))
    cut = copies.groupBy(*key, "k").agg(F.sort_array(F.collect_list(F.struct("from", "to"))).alias("cuts"), F.sum(F.col("to") - F.col("from")).alias("words"))
    named = rows.hint("merge").join(cut, key).select(F.col("doc_id").alias("id"), "source", "size", "n", "cuts", "words")
    repeat = Window.partitionBy("doc_id", "own").orderBy(F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)), F.xxhash64("text"))
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    own = docs.select(whole.alias("row"), F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text")).alias("doc_id"), F.col("source").cast("string").alias("own"), "text")
    own = own.withColumn("m", F.row_number().over(repeat))
    same = (F.col("id") == F.col("doc_id")) & (F.col("n") == F.col("m")) & F.col("source").eqNullSafe(F.col("own"))
    joined = own.hint("merge").join(named, same)
    part = F.col("words") < F.col("size")
    joined = joined.withColumn("all_words", F.when(part, F.regexp_extract_all("text", F.lit(f"({WORD})"))))
    taken = F.array_join(F.flatten(F.transform("cuts", lambda c: F.slice("all_words", (c["from"] + 1).cast("int"), (c["to"] - c["from"]).cast("int")))), " ")
    joined = joined.withColumn("new_text", F.when(part, taken).otherwise(F.col("text")))
    new = {"text": F.col("new_text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.char_length("new_text").cast(docs.schema["n_chars"].dataType)
    return joined.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def mix_report(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, size, source_size, target, taken, first_shard, last_shard (null where nothing is taken) for every row of ``docs``; see ``mix``."""
    rows, spans = mix(docs, block_words)
    taken = spans.groupBy("rank", "doc_id", "n").agg(F.sum((F.col("to") - F.col("from")) * F.col("times")).alias("taken"), F.min("first_shard").alias("first_shard"), F.max("last_shard").alias("last_shard"))
    out = rows.hint("merge").join(taken, ["rank", "doc_id", "n"], "left")
    return out.select(
        F.when(~F.col("absent"), F.col("doc_id")).alias("doc_id"), "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
        "first_shard", "last_shard",
    )


def op10_query(spark, sf_dir):
    return mix_report(documents(spark, sf_dir))


def _sql_mixed(*parts: str) -> str:
    h = str(SEED)
    for p in parts:
        h = f"(({h} * 48271 + ({p})::BIGINT % {PRIME} + 11) * 69621 % {PRIME})"
    return h


def _sql_shard(slot: str, rank: str) -> str:
    h = _sql_mixed(slot, rank)
    for c in SHARD_KEYS:
        h = f"(SELECT (h * h + {c}) % {PRIME} FROM (SELECT {h} AS h))"
    return h


def _sql_rounds() -> str:
    """CTEs p1 .. pROUNDS from p0, a round of the shuffle each."""
    out = []
    for r in range(1, ROUNDS + 1):
        out.append(
            f"q{r} AS (SELECT *, ({_sql_mixed(str(r), 'rank', 'epoch')} % blocks - x + blocks) % blocks AS p FROM p{r - 1}), "
            f"p{r} AS (SELECT rank, shard, epoch, blocks, CASE WHEN bit_count({_sql_mixed(str(r + 100), 'greatest(x, p)', 'rank', 'epoch')}) % 2 = 1 THEN p ELSE x END AS x FROM q{r})"
        )
    return ", ".join(out)


OP10_SQL = rf"""WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS rank FROM d GROUP BY source),
w AS (SELECT *, [5.0, 2.0, 1.0][(rank % 3 + 1)::INT]::DOUBLE AS w, {CAP}.0::DOUBLE * source_size AS most FROM s),
v AS (SELECT *, (SELECT sum(source_size) FROM s)::DOUBLE * {GROWTH}::DOUBLE AS total,
  coalesce(sum(most) OVER b, 0)::DOUBLE AS filled, (SELECT sum(w) FROM w) - coalesce(sum(w) OVER b, 0) AS left_w
  FROM w WINDOW b AS (ORDER BY most / w, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT (total - filled) / left_w AS level FROM v WHERE (total - filled) / left_w * w <= most ORDER BY most / w, rank LIMIT 1),
t AS (SELECT source, source_size, rank, least(most, coalesce((SELECT level FROM l) * w, most)) AS target,
  ceil(source_size / {BLOCK_WORDS}.0)::BIGINT AS blocks FROM v),
q AS (SELECT *, least(round(target / source_size * blocks), blocks * {CAP})::BIGINT AS quota FROM t WHERE source_size > 0),
o AS (SELECT rank, blocks, {_sql_shard('slot', 'rank')} % (SELECT greatest(1, ceil(sum(quota) / {SHARD_SLOTS}.0))::BIGINT FROM q) AS shard FROM (SELECT rank, blocks, unnest(range(quota)) AS slot FROM q)),
n AS (SELECT rank, blocks, shard, count(*) AS draws FROM o GROUP BY ALL),
f AS (SELECT *, (sum(draws) OVER (PARTITION BY rank ORDER BY shard) - draws)::BIGINT AS first FROM n),
p0 AS (SELECT rank, blocks, shard, slot // blocks AS epoch, slot % blocks AS x FROM (SELECT rank, blocks, shard, unnest(range(first, first + draws)) AS slot FROM f)),
{_sql_rounds()},
times AS (SELECT rank, x AS block, count(*) AS times, min(shard) AS first_shard, max(shard) AS last_shard FROM p{ROUNDS} GROUP BY ALL),
r AS (SELECT doc_id, size, source_size, target, rank, sum(size) OVER (PARTITION BY rank ORDER BY doc_id) - size AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
pieces AS (SELECT *, unnest(range((start // {BLOCK_WORDS})::BIGINT, ((start + size - 1) // {BLOCK_WORDS} + 1)::BIGINT)) AS block FROM r WHERE size > 0),
taken AS (SELECT doc_id, sum((least((block + 1) * {BLOCK_WORDS} - start, size) - greatest(block * {BLOCK_WORDS} - start, 0)) * times)::BIGINT AS taken, min(first_shard) AS first_shard, max(last_shard) AS last_shard
  FROM pieces JOIN times USING (rank, block) GROUP BY doc_id)
SELECT r.doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken, first_shard, last_shard FROM r LEFT JOIN taken USING (doc_id)"""
