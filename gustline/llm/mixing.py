"""Mixing sources to target weights in fixed-length blocks of words.

A source's documents, one after another, are one run of words, cut into blocks of equal
length. Output shards draw how many of their slots each source fills; a source's draws run
through pseudorandom permutations of its block numbers, one per pass; and draws meet blocks
by that number. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from gustline.llm.common import each_copy, n_words
from gustline.session import stage

BLOCK = 64
SLOTS = 4096
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_PASSES = 2
ROUNDS = 20
CHUNK = 1024
SEED = 17


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST_PASSES) -> DataFrame:
    """(source, source_no, source_size, target) from (source, source_size), one row per source.

    Sources in code point order, NULL last, take the weights in turn. The targets add up to
    ``share`` of all words; none exceeds ``most`` times its source's words, the excess goes to
    the others by weight. With the sources ordered by the level at which they reach their
    limit, the final level is the first that its own source does not reach: what the sources
    before it leave, over the weights from it on. The window sees one row per source.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    limit = F.lit(float(most)) * F.col("source_size")
    rows = (
        sizes.withColumn("source_no", F.row_number().over(order) - 1)
        .withColumn("weight", F.element_at(F.array(*map(F.lit, map(float, weights))), F.col("source_no") % len(weights) + 1))
        .withColumn("reach", limit / F.col("weight"))
    )
    up_to = Window.orderBy("reach", "source_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy()
    ranked = (
        rows.withColumn("taken", F.sum(limit).over(up_to) - limit)
        .withColumn("weights", F.sum("weight").over(whole) - F.sum("weight").over(up_to) + F.col("weight"))
        .withColumn("level", (F.lit(float(share)) * F.sum("source_size").over(whole) - F.col("taken")) / F.col("weights"))
    )
    # sources before the first one that stays below its limit are at theirs
    free = F.min(F.when(F.col("reach") > F.col("level"), F.struct("reach", "source_no", "level"))).over(whole)
    level = free["level"]
    return ranked.withColumn("final", level).select(
        "source", "source_no", "source_size",
        F.when(F.col("final").isNull(), limit).otherwise(F.least(limit, F.col("weight") * F.col("final"))).alias("target"),
    )


def permuted(index: Column, n: Column, *key: Column, rounds: int = ROUNDS, seed: int = SEED) -> Column:
    """A pseudorandom permutation of 0..n-1 for each ``key``, applied to ``index``.

    Swap-or-not (Hoang, Morris and Rogaway 2012): a round pairs every number with its mirror
    image about a random point, and a hash of the pair's larger number decides whether they
    swap. It is a bijection for every n, without tables and without trying again.
    """

    def step(x: Column, r: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(F.lit(seed), r, *key), n) - x, n)  # one partner for each number
        swap = F.xxhash64(F.lit(seed + 1), r, F.greatest(x, other), *key) % 2 == 0
        return F.when(swap, other).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), index, step)


def placed(docs: DataFrame, source: str, text: str, key: str) -> tuple[DataFrame, DataFrame]:
    """The documents in a stored table (key, text_hash, source, size, start) and the sources.

    ``start`` is the number of a source's words before the document. It is added up in two
    steps: within chunks, of about CHUNK documents and dealt by hash, then over chunks. So a
    source with a third of all rows is summed by many tasks. Repeated rows are counted before
    that and follow one another, so neither their number nor the input's partitions matter.
    """
    sized = docs.select(
        F.col(key).alias("key"), F.col(source).alias("source"), n_words(F.col(text)).alias("size"),
        F.xxhash64(F.col(text)).alias("text_hash"),
    )
    rows = stage(sized.groupBy("key", "source", "size", "text_hash").agg(F.count("*").alias("n")), "sizes")
    sources = stage(
        rows.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.count("*").alias("docs")),
        "sources",
    )
    chunks = sources.select(
        F.col("source").alias("of"), F.greatest(F.lit(1), F.ceil(F.col("docs") / CHUNK)).alias("chunks")
    )
    numbered = rows.join(chunks, F.col("source").eqNullSafe(F.col("of"))).drop("of").withColumn(
        "chunk", F.pmod(F.xxhash64(F.lit(SEED), "key", "text_hash"), F.col("chunks"))
    )
    words = F.col("size") * F.col("n")
    inside = Window.partitionBy("source", "chunk").orderBy("key", "text_hash", "size")
    summed = numbered.withColumn("start", F.sum(words).over(inside) - words)
    before = Window.partitionBy("source").orderBy("chunk")
    offsets = numbered.groupBy("source", "chunk").agg(F.sum(words).alias("words")).select(
        F.col("source").alias("of"), F.col("chunk").alias("part"),
        (F.sum("words").over(before) - F.col("words")).alias("offset"),
    )
    joined = summed.join(offsets, F.col("source").eqNullSafe(F.col("of")) & (F.col("chunk") == F.col("part")))
    at = (
        each_copy(joined, "n", "copy")
        .select(
            "key", "text_hash", "source", "size",
            (F.col("start") + F.col("offset") + F.col("copy") * F.col("size")).alias("start"),
        )
    )
    return stage(at, "placed"), sources


def slots(sources: DataFrame, block: int = BLOCK, per_shard: int = SLOTS, seed: int = SEED) -> DataFrame:
    """(source_no, block_no, shard, slot, pass) from (source_no, source_size, target).

    A shard's counts are a multinomial draw of its slots, on the condition that all shards'
    counts add up to the sources' targets: every source has a whole number of draws, and one
    permutation of all draws says which slot of which shard each of them fills. (Without the
    condition, small tables miss targets by a tenth.) No count meets another shard's. Draw
    number t of a source takes block ``permuted(t mod blocks)`` of pass ``t div blocks``.
    """
    run = Window.orderBy("source_no")  # one row per source
    shares = (
        sources.withColumn("blocks", F.ceil(F.col("source_size") / block).cast("long"))
        .withColumn("draws", F.round(F.col("target") / F.greatest(F.col("source_size"), F.lit(1)) * F.col("blocks")).cast("long"))
        .withColumn("before", F.sum("draws").over(run) - F.col("draws"))
        .withColumn("all", F.sum("draws").over(Window.partitionBy()))
        .where("draws > 0 and blocks > 0")
    )
    turn = F.floor(F.col("t") / F.col("blocks"))
    place = permuted(F.col("before") + F.col("t"), F.col("all"), F.lit("slots"), seed=seed)
    return (
        each_copy(shares, "draws", "t").withColumn("place", place)
        .select(
            "source_no", permuted(F.col("t") % F.col("blocks"), F.col("blocks"), F.col("source_no"), turn, seed=seed).alias("block_no"),
            F.floor(F.col("place") / per_shard).alias("shard"), (F.col("place") % per_shard).alias("slot"), turn.alias("pass"),
        )
    )


def mix(
    docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", block: int = BLOCK,
    weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, per_shard: int = SLOTS, seed: int = SEED,
) -> DataFrame:
    """Per document: key, text_hash, source, size, source_size, target, taken, placements.

    ``placements`` lists where its blocks went: array<struct<shard, slot, pass, from_word,
    words>>, words counted in the document; ``taken`` is their sum. A source's taken words
    miss its target by less than two blocks, and no document is taken more than MOST_PASSES
    times. Reruns agree: every draw is a hash. NULL text and text without words
    has size 0 and nothing taken; a NULL source is a source; repeated rows are rows of their
    own; other columns are not read; an empty table gives an empty table. ``text_hash`` is the
    text's ``xxhash64``.
    """
    at, sizes = placed(docs, source, text, key)
    wanted = stage(targets(sizes.select("source", "source_size"), weights, share), "targets")
    rows = at.join(wanted.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    last = F.floor((F.col("start") + F.col("size") - 1) / block)
    pieces = rows.where("size > 0").select(
        "source_no", "start", "size", F.explode(F.sequence(F.floor(F.col("start") / block), last)).alias("block_no")
    )
    begin = F.greatest(F.lit(0), F.col("block_no") * block - F.col("start"))
    end = F.least(F.col("size"), (F.col("block_no") + 1) * block - F.col("start"))
    cut = pieces.select("source_no", "start", "block_no", begin.alias("from_word"), (end - begin).alias("words"))
    # both sides grow with the corpus, whatever their sizes before they are exploded
    met = cut.join(slots(wanted, block, per_shard, seed=seed).hint("merge"), ["source_no", "block_no"])
    found = met.groupBy(F.col("source_no").alias("no"), F.col("start").alias("at")).agg(
        F.sum("words").alias("taken"),
        F.array_sort(F.collect_list(F.struct("shard", "slot", "pass", "from_word", "words"))).alias("placements"),
    )
    # a document without words starts where the next one does
    same = (F.col("size") > 0) & (F.col("source_no") == F.col("no")) & (F.col("start") == F.col("at"))
    return rows.join(found, same, "left").select(
        F.col("key").alias(key), "text_hash", F.col("source").alias(source), "size", "source_size", "target",
        F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "placements",
    )
