"""Best-fit packing of documents into bins of a fixed number of words, under conflicts.

Bins are ordered by the room they have left. Each carries a bitmap of the sources and one of
the duplicate clusters in it. A piece looks for the tightest bin that has room and shares
neither its source nor its cluster: the search starts at the first bin with enough room and
goes on to the next until a compatible one is found; only then a new bin is opened.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
import xxhash

from gustline.llm import components
from gustline.llm.common import WORD, each_copy, n_words
from gustline.session import stage

CAPACITY = 2048
SHARD_ROWS = 2048
RUN = 5
BANDS = 20
ROWS = 6
SEED = 42
CACHE = 200_000
_BINS = 1 << 20  # of a shard, at most


class _Bins:
    """The open bins of one shard."""

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self._by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
        self._rooms = 0  # bit r is set if a bin has r words left
        self.sources: list[int] = []
        self.clusters: list[int] = []
        self.count: list[int] = []

    def _put(self, number: int, room: int) -> None:
        self._by_room[room].append(number)
        self._rooms |= 1 << room

    def place(self, words: int, source: int, cluster: int) -> tuple[int, int]:
        """(bin, position) of a piece; ``source`` and ``cluster`` are bits (cluster 0: none)."""
        rest = self._rooms >> words << words
        while rest:
            room = (rest & -rest).bit_length() - 1
            for at, number in enumerate(self._by_room[room]):
                if not (self.sources[number] & source or self.clusters[number] & cluster):
                    self._by_room[room].pop(at)
                    if not self._by_room[room]:
                        self._rooms &= ~(1 << room)
                    return self._add(number, room - words, source, cluster)
            rest &= rest - 1
        self.sources.append(0)
        self.clusters.append(0)
        self.count.append(0)
        return self._add(len(self.count) - 1, self.capacity - words, source, cluster)

    def _add(self, number: int, room: int, source: int, cluster: int) -> tuple[int, int]:
        self.sources[number] |= source
        self.clusters[number] |= cluster
        self.count[number] += 1
        self._put(number, room)
        return number, self.count[number] - 1


def pack_shard(pieces: pd.DataFrame, capacity: int) -> pd.DataFrame:
    """``pieces`` (words, source, cluster, ...) with bin and position, largest pieces first."""
    pieces = pieces.sort_values(["words", "cluster", "piece", "copy"], ascending=[False, True, True, True], ignore_index=True)
    repeats = Counter(pieces["cluster"])
    source_bits = {s: 1 << i for i, s in enumerate(pieces["source_hash"].unique())}
    cluster_bits = {c: 1 << i for i, c in enumerate(sorted(c for c, n in repeats.items() if n > 1))}
    bins = _Bins(capacity)
    placed = [
        bins.place(words, source_bits[s], cluster_bits.get(c, 0))
        for words, s, c in zip(pieces["words"].tolist(), pieces["source_hash"], pieces["cluster"])
    ]
    return pieces.assign(bin=[b for b, _ in placed], position=[p for _, p in placed])


def pack(
    docs: DataFrame, capacity: int = CAPACITY, key: str = "doc_id", source: str = "source", text: str = "text",
    cluster: Column | None = None, shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """Per piece of a document: key, text_hash, copy, piece, from_word, words, source, bin_id, position.

    A document of more than ``capacity`` words is cut into pieces of that many and a rest;
    every other one is one piece. No bin exceeds ``capacity`` words or holds two pieces of one
    source or of one duplicate cluster. ``cluster`` defaults to the text without case and
    spacing, which knows exact copies only (``pack_apart`` knows near copies). A NULL source is
    a source of its own. NULL texts and texts without words have one piece of no words, with
    NULL bin and position. Repeated rows are pieces of their own, told apart by ``copy``; other
    columns are not read; an empty table gives an empty table.

    Pieces are dealt by hash into shards of about ``shard_rows``, each packed in one task, so
    a hot source is spread and a task's memory is bounded; bins never cross shards. Texts are
    not shuffled, and repeated rows only as counts.
    """
    own = _plain(F.col(text)) if cluster is None else F.xxhash64(cluster)
    return _pack(_rows(docs, key, source, text, own), capacity, key, source, shard_rows)


def pack_apart(
    docs: DataFrame, capacity: int = CAPACITY, key: str = "doc_id", source: str = "source", text: str = "text",
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """``pack`` with groups of near copies as clusters.

    Texts that share a band of their MinHash signatures are linked (of pairs with a five-word
    similarity of 0.8, 99.8%; of 0.5, 27%; of 0.3, 1.5%), and so are those that are equal
    without case and spacing; whatever a chain of links joins never shares a bin. Only hashes
    and counts are grouped, a band's texts by its smallest; texts are read once and stay.
    """
    marked = _rows(docs, key, source, text, _plain(F.col(text)), bands(F.col(text)).alias("bands"))
    rows = stage(marked, "prints")
    met = rows.select("cluster", F.explode("bands").alias("band")).distinct()
    shared = met.groupBy("band").agg(F.min("cluster").alias("a"), F.max("cluster").alias("most")).where("a < most")
    roots = components.connected_components(met.join(shared, "band").select("a", F.col("cluster").alias("b")))
    near = rows.join(roots, F.col("cluster") == F.col("node"), "left").withColumn("cluster", F.coalesce("root", "cluster"))
    return _pack(near, capacity, key, source, shard_rows)


def signature(words: list[str], known: dict[str, int]) -> np.ndarray:
    """The smallest of each of BANDS * ROWS hashes of all runs of RUN words; ``known`` keeps words' hashes."""
    ids = np.empty(len(words), np.uint64)
    for i, w in enumerate(words):
        h = known.get(w)
        if h is None:
            known[w] = h = xxhash.xxh64_intdigest(w.encode())
        ids[i] = h
    n = max(1, len(ids) - RUN + 1)
    run = np.zeros(n, np.uint64)
    for j in range(min(RUN, len(ids))):
        run = (run * np.uint64(0x100000001B3)) ^ ids[j : j + n]
    for shift, factor in ((29, 0xBF58476D1CE4E5B9), (32, 0x94D049BB133111EB)):  # mix all bits
        run = (run ^ (run >> np.uint64(shift))) * np.uint64(factor)
    factors = np.random.default_rng(SEED).integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    low = np.full(BANDS * ROWS, (1 << 64) - 1, np.uint64)
    for at in range(0, n, 1024):
        low = np.minimum(low, (factors[:, None] * run[at : at + 1024]).min(axis=1))
    return low


def bands(text: Column) -> Column:
    """array<bigint>: a hash of each of the BANDS bands of the signature; none without words."""

    @F.pandas_udf("array<bigint>")
    def hashed(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known: dict[str, int] = {}
        for part in texts:
            out = []
            for t in part:
                if len(known) > CACHE:
                    known.clear()
                words = t.lower().split()
                low = signature(words, known).reshape(BANDS, ROWS) if words else []
                own = [xxhash.xxh64_intdigest(row.tobytes(), b) for b, row in enumerate(low)]
                out.append(np.array(own, np.uint64).view(np.int64))
            yield pd.Series(out)

    return hashed(F.coalesce(text, F.lit("")))


def _plain(text: Column) -> Column:
    return F.xxhash64(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+", ""))


def _rows(docs: DataFrame, key: str, source: str, text: str, cluster: Column, *more: Column) -> DataFrame:
    return docs.select(
        F.col(key).alias("key"), F.col(source).alias("source"), n_words(F.col(text)).alias("size"),
        F.xxhash64(F.col(text)).alias("text_hash"), cluster.alias("cluster"), *more,
    )


def _pack(rows: DataFrame, capacity: int, key: str, source: str, shard_rows: int) -> DataFrame:
    counted = stage(rows.groupBy("key", "source", "size", "text_hash", "cluster").agg(F.count("*").alias("n")), "pieces")
    last = F.floor(F.greatest(F.col("size") - 1, F.lit(0)) / capacity)
    total = counted.agg(F.sum(F.col("n") * (last + 1))).first()[0] or 0
    shards = max(1, -(-total // shard_rows))
    pieces = (
        each_copy(counted, "n", "copy")
        .withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), last)))
        .withColumn("from_word", F.col("piece") * capacity)
        .withColumn("words", F.least(F.lit(capacity), F.col("size") - F.col("from_word")).cast("int"))
        .withColumn("source_hash", F.xxhash64(F.col("source").isNull(), "source"))
        .withColumn("shard", F.pmod(F.xxhash64("key", "text_hash", "copy", "piece"), F.lit(shards)))
        .drop("n", "size")
    )
    whole = pieces.where("words > 0")
    schema = f"{', '.join(f'{n} {t}' for n, t in whole.dtypes)}, bin long, position int"
    done = whole.groupBy("shard").applyInPandas(lambda part: pack_shard(part, capacity), schema)
    nothing = pieces.where("words = 0").withColumns({"bin": F.lit(None).cast("long"), "position": F.lit(None).cast("int")})
    return done.union(nothing.select(*done.columns)).select(
        F.col("key").alias(key), "text_hash", "copy", "piece", "from_word", "words", F.col("source").alias(source),
        (F.col("shard") * _BINS + F.col("bin")).alias("bin_id"), "position",
    )


def with_text(docs: DataFrame, packed: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """``packed`` with each piece's text: the whole text, or its words joined by blanks."""
    texts = docs.select(
        F.col(key).alias("k"), F.xxhash64(F.col(text)).alias("h"), F.col(text).alias("whole")
    ).dropDuplicates(["k", "h"])
    words = F.regexp_extract_all("whole", F.lit(WORD), F.lit(0))
    part = F.array_join(F.slice(words, (F.col("from_word") + 1).cast("int"), F.col("words")), " ")
    cut = (F.col("piece") > 0) | (F.col("words") == capacity)
    same = F.col(key).eqNullSafe(F.col("k")) & (F.col("text_hash") == F.col("h"))
    return packed.join(texts, same).withColumn(text, F.when(cut, part).otherwise(F.col("whole"))).drop("k", "h", "whole")
