"""Exact search of the largest inner products over integer vectors, in blocks.

Vectors are cut into equal segments, at several resolutions. By Cauchy-Schwarz the inner
product of two vectors is at most the sum over segments of length * (mean * mean + deviation
* deviation), which is the lower bound of their distance from segment means and deviations,
seen from the other side: |q - c|^2 = |q|^2 + |c|^2 - 2 q.c. Pairs whose bound falls below
the query's k-th best are dropped, coarse to fine, and the rest are computed exactly.

The same bound, over the ranges of the statistics in two blocks, tells before any vector is
shipped whether a block of candidates can matter to a group of queries at all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from gustline.session import stage

K = 20
QUERY_BLOCK = 512
CANDIDATE_BLOCK = 2048
#: Queries, and components of queries, that one task holds.
QUERY_GROUP = 16_384
GROUP_COMPONENTS = 1 << 21
#: Parts that the candidates of a group of queries are dealt to, and candidates a part has at most.
LANES = 8
LANE_ROWS = 1 << 21
LEVELS = (1, 4, 16)
_EXACT = 1 << 53
_LARGEST = float(np.finfo(np.float64).max)


class _Block:
    """Vectors of one length with the statistics of each level."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        self.ids, self.vectors = ids, vectors
        self.largest = float(np.abs(vectors).max(initial=0))
        self.levels = []
        width = vectors.shape[1]
        for parts in LEVELS:
            if parts > max(width, 1):
                break
            cuts = np.linspace(0, width, parts + 1).astype(int)[:-1]
            lengths = np.diff([*cuts, width])
            mean = np.add.reduceat(vectors, cuts, axis=1) / lengths if width else vectors
            spread = vectors - np.repeat(mean, lengths, axis=1) if width else vectors
            square = np.add.reduceat(spread * spread, cuts, axis=1) if width else vectors
            # one matrix product of these rows gives the sum of length * (mean * mean + deviation * deviation)
            self.levels.append(np.hstack([mean * np.sqrt(lengths), np.sqrt(square)]))

    def envelope(self) -> np.ndarray:
        """Smallest and largest value of every column of every level, down to single components."""
        columns = np.hstack([*self.levels, self.vectors])
        return np.vstack([columns.min(axis=0), columns.max(axis=0)])


def _reachable(queries: np.ndarray, floors: np.ndarray, candidates: np.ndarray, width: int) -> bool:
    """Whether any of the query blocks may hold a query that a vector of the candidate block can satisfy.

    ``queries`` is (blocks, 2, columns) of envelopes, ``candidates`` one envelope. The largest product of
    two ranges lies at their ends, so the sum of these over a level bounds every inner product.
    """
    alive, at = np.ones(len(floors), bool), 0
    with np.errstate(all="ignore"):
        slack = 1e-9 * (1 + np.abs(queries).max(initial=0) * np.abs(candidates).max(initial=0) * width)
        for columns in [*(2 * parts for parts in LEVELS if parts <= max(width, 1)), width]:
            part = slice(at, at + columns)
            ends = [queries[:, i, part] * candidates[j, part] for i in (0, 1) for j in (0, 1)]
            bound = np.maximum.reduce(ends).sum(axis=1)
            alive &= ~(bound + slack < floors)  # a bound that overflowed proves nothing
            if not alive.any():
                return False
            at += columns
    return True


def _exact(q: _Block, c: _Block, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Inner products of pairs, exact; beyond a long's range they stop at its limits."""
    if q.largest * c.largest * max(q.vectors.shape[1], 1) < _EXACT:
        return np.einsum("ij,ij->i", q.vectors[rows], c.vectors[cols]).astype(np.int64)
    low, high = -(1 << 63), (1 << 63) - 1
    whole = [(q.vectors[i].tolist(), c.vectors[j].tolist()) for i, j in zip(rows.tolist(), cols.tolist())]
    sums = (sum(int(a) * int(b) for a, b in zip(x, y)) for x, y in whole)
    return np.array([min(max(s, low), high) for s in sums], dtype=np.int64)


class _Best:
    """The k best candidates so far of each query of a block."""

    def __init__(self, queries: _Block, row: np.ndarray, k: int, floor: np.ndarray | None = None) -> None:
        self.queries, self.row, self.k, n = queries, row, k, len(queries.ids)
        self.scores: list[np.ndarray] = [np.empty(0, np.int64)] * n
        self.ids: list[np.ndarray] = [np.empty(0, np.int64)] * n
        self.floor = np.full(n, -np.inf) if floor is None else floor.copy()

    def add(self, c: _Block) -> None:
        q, n = self.queries, len(c.ids)
        if not len(q.ids) or not n:
            return
        small = q.largest * c.largest * max(q.vectors.shape[1], 1) < _EXACT
        alive = c.ids[None, :] != q.ids[:, None]
        if np.isfinite(self.floor).any():
            slack = 1e-9 * (1 + q.largest * c.largest * q.vectors.shape[1])
            for a, b in zip(q.levels, c.levels):
                alive &= ~(a @ b.T + slack < self.floor[:, None])
                if not alive.any():
                    return
        if small and alive.mean() > 0.05:  # a matrix product beats picking many pairs
            product = q.vectors @ c.vectors.T
            alive &= product >= self.floor[:, None]
            rows, cols = np.nonzero(alive)
            scores = product[rows, cols].astype(np.int64)
        else:
            rows, cols = np.nonzero(alive)
            step = 1 << 16
            scores = np.concatenate(
                [np.empty(0, np.int64), *(_exact(q, c, rows[i : i + step], cols[i : i + step]) for i in range(0, len(rows), step))]
            )
        ends = np.searchsorted(rows, np.arange(len(q.ids) + 1))
        for i in np.unique(rows).tolist():
            part = slice(ends[i], ends[i + 1])
            s = np.concatenate([self.scores[i], scores[part]])
            ids = np.concatenate([self.ids[i], c.ids[cols[part]]])
            if len(s) > self.k:
                edge = np.partition(s, len(s) - self.k)[len(s) - self.k]
                near = s >= edge  # ties at the edge stay until ids have decided
                s, ids = s[near], ids[near]
            top = np.lexsort((ids, -s))[: self.k]
            self.scores[i], self.ids[i] = s[top], ids[top]
            if len(top) == self.k:
                self.floor[i] = s[top[-1]]

    def rows(self) -> pd.DataFrame:
        sizes = [len(s) for s in self.scores]
        return pd.DataFrame(
            {
                "query_row": np.repeat(self.row, sizes), "query_id": np.repeat(self.queries.ids, sizes),
                "vec_id": np.concatenate([np.empty(0, np.int64), *self.ids]),
                "score": np.concatenate([np.empty(0, np.int64), *self.scores]),
            }
        )


def _bytes(vectors: np.ndarray) -> tuple[str, bytes]:
    """Whole numbers in the smallest type that holds them all."""
    largest = np.abs(vectors).max(initial=0)
    kind = next((k for k in ("int8", "int16", "int32") if largest <= np.iinfo(k).max), "float64")
    return kind, vectors.astype(kind).tobytes()


def _block(ids: bytes, kind: str, data: bytes, width: int) -> _Block:
    found = np.frombuffer(ids, np.int64)
    return _Block(found, np.frombuffer(data, kind).reshape(len(found), width).astype(np.float64))


def _place(rows: DataFrame, parts: int | None = None) -> DataFrame:
    """Rows in ranges of length, direction and norm, so that the vectors of a block are alike.

    A direction is the signs of the sums of eight segments. The row's number comes last: equal
    vectors, however many, are cut into ranges like any others.
    """
    x, n = F.col("x"), F.size("x")
    cell = F.lit(0)
    for i in range(8):
        begin, end = (F.floor(n * j / 8).cast("int") for j in (i, i + 1))
        total = F.aggregate(F.slice(x, begin + 1, end - begin), F.lit(0.0), lambda s, v: s + v)
        cell = cell + F.when(total > 0, 1 << i).otherwise(0)
    norm = F.aggregate(x, F.lit(0.0), lambda s, v: s + v * v)
    placed = rows.select("id", "x", "row", n.alias("width"), cell.alias("cell"), norm.alias("norm"))
    order = ("width", "cell", "norm", "row")
    ranges = placed.repartitionByRange(*order) if parts is None else placed.repartitionByRange(parts, *order)
    return ranges.sortWithinPartitions(*order).select("id", "x", "row")


_PACKED = "width int, kind string, ids binary, rows binary, data binary, envelope binary"


def _blocks(parts: Iterator[pd.DataFrame], size: int, scale: float) -> Iterator[tuple[dict, _Block]]:
    """Blocks of at most ``size`` scaled vectors of equal length, as they are stored and as they are used."""
    held: dict[int, list] = {}

    def block(width: int) -> tuple[dict, _Block]:
        rows = held.pop(width)
        with np.errstate(over="ignore"):
            x = np.floor(scale * np.array([r[1] for r in rows], np.float64).reshape(len(rows), width))
        x = np.clip(x, -_LARGEST, _LARGEST)
        kind, data = _bytes(x)
        ids, numbers = (np.array([r[i] for r in rows], np.int64) for i in (0, 2))
        made = _Block(ids, x)
        stored = {"width": width, "kind": kind, "ids": ids.tobytes(), "rows": numbers.tobytes(), "data": data}
        return stored | {"envelope": made.envelope().tobytes()}, made

    for part in parts:
        for row in zip(part["id"], part["x"], part["row"]):
            width = len(row[1])
            held.setdefault(width, []).append(row)
            if len(held[width]) == size:
                yield block(width)
            elif sum(map(len, held.values())) >= 4 * size:  # many lengths
                yield block(max(held, key=lambda w: len(held[w])))
    for width in [*held]:
        yield block(width)


def _packed_candidates(rows: DataFrame, size: int, scale: float) -> DataFrame:
    def pack(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for stored, _ in _blocks(parts, size, scale):
            yield pd.DataFrame([stored])

    return _place(rows).mapInPandas(pack, _PACKED).withColumn("block", F.monotonically_increasing_id())


def _packed_queries(rows: DataFrame, groups: int, size: int, scale: float, k: int) -> DataFrame:
    """Blocks of queries in about ``groups`` groups, with a floor for each query.

    The floor is the k-th best score among the queries of the group, which are candidates too:
    no result of the query lies below it.
    """

    def pack(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = list(_blocks(parts, size, scale))  # one group
        for stored, block in found:
            best = _Best(block, np.frombuffer(stored["rows"], np.int64), k)
            for _, other in sorted(found, key=lambda f: f[1] is not block):  # the block's own first
                if other.vectors.shape[1] == block.vectors.shape[1]:
                    best.add(other)
            yield pd.DataFrame([stored | {"floors": best.floor.tobytes(), "least": best.floor.min()}])

    packed = _place(rows, groups).mapInPandas(pack, f"{_PACKED}, floors binary, least double")
    return packed.withColumn("group", F.spark_partition_id())


def _lanes(queries: DataFrame, candidates: DataFrame, lanes: int) -> DataFrame:
    """Query blocks (``tag`` 0), then candidate blocks (``tag`` 1), of each group, lane and length in one stream."""
    left = queries.withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1)))).withColumn("tag", F.lit(0))
    key = ["group", "lane", "width"]
    both = left.unionByName(candidates.withColumn("tag", F.lit(1)), allowMissingColumns=True)
    return both.repartition(*key).sortWithinPartitions(*key, "tag")


def _runs(parts: Iterator[pd.DataFrame]) -> Iterator[tuple[bool, object]]:
    """(whether its group, lane and length are new, row) for each row of a stream."""
    now = None
    for part in parts:
        for x in part.itertuples(index=False):
            key = (x.group, x.lane, x.width)
            yield key != now, x
            now = key


def reachable_blocks(queries: DataFrame, candidates: DataFrame, lanes: int) -> DataFrame:
    """(group, lane, block): candidate blocks that a query of the group may need, from envelopes alone."""

    def reach(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, floors, ready = [], [], None
        for new, x in _runs(parts):
            if new:
                held, floors, ready = [], [], None
            box = np.frombuffer(x.envelope, np.float64).reshape(2, -1)
            if x.tag == 0:
                held.append(box)
                floors.append(x.least)
            elif held:
                if ready is None:
                    ready = np.stack(held), np.array(floors)
                if _reachable(*ready, box, x.width):
                    yield pd.DataFrame({"group": [x.group], "lane": [x.lane], "block": [x.block]})

    asked = queries.select("group", "width", "envelope", "least")
    groups = 1 + (queries.agg(F.max("group")).first()[0] or 0)
    given = candidates.select(
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"),
        F.pmod(F.xxhash64("block"), F.lit(lanes)).cast("int").alias("lane"), "width", "block", "envelope",
    )
    return _lanes(asked, given, lanes).mapInPandas(reach, "group int, lane int, block long")


def top_k(
    vectors: DataFrame, is_query: Column, k: int = K, key: str = "vec_id", vector: str = "embedding", scale: float = 64.0,
    query_block: int = QUERY_BLOCK, candidate_block: int = CANDIDATE_BLOCK, query_group: int = QUERY_GROUP, lanes: int = LANES,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` largest integer inner products of each query.

    Every component x counts as floor(scale * x). Queries are the rows where ``is_query``
    holds; candidates are all rows but those with the query's own id, of the query's length.
    Ties go to the smaller id; a query with fewer candidates gets all. Rows with a NULL id, a
    NULL vector or a NULL or non-finite component take no part; repeated rows are rows of
    their own (a repeated query gets its ranks once for each row); scores beyond a long stop
    at its limits; other columns are not read; an empty table gives an empty table.

    All rows with the query's id count as the query's own: ids name vectors.

    Both sides are cut into blocks of like vectors. Groups of ``query_group`` queries (fewer, if the
    vectors are long) find floors for their results among themselves; envelopes of the blocks then
    meet, a hundredth of the vectors' size, and only candidate blocks that can reach a floor of a
    group are shipped to it. So each block travels once for each group that it may matter to, at
    worst once for each ``query_group`` queries. A group's candidates are dealt to ``lanes`` tasks
    (more beyond LANE_ROWS candidates each), which stream them past the group's queries.
    """
    good = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = stage(
        vectors.where(good & F.col(key).isNotNull()).select(
            F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("x"),
            F.coalesce(is_query, F.lit(False)).alias("q"), F.monotonically_increasing_id().alias("row"),
        ),
        "vectors",
    )
    asked = rows.where("q")
    sizes = asked.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.size("x")), F.lit(0)).alias("components")).first()
    groups = max(1, -(-sizes["n"] // query_group), -(-sizes["components"] // GROUP_COMPONENTS))
    lanes = max(lanes, -(-rows.count() // LANE_ROWS))
    queries = stage(_packed_queries(asked, groups, query_block, scale, k), "queries")
    candidates = stage(_packed_candidates(rows, candidate_block, scale), "candidates")
    pairs = reachable_blocks(queries, candidates, lanes).hint("shuffle_hash")  # exploded: its size is not known
    shipped = candidates.select("block", "width", "kind", "ids", "data").join(pairs, "block").drop("block")

    def search(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[_Best] = []
        for new, x in _runs(parts):
            if new:
                yield from (best.rows() for best in held)
                held = []
            block = _block(x.ids, x.kind, x.data, x.width)
            if x.tag == 0:
                held.append(_Best(block, np.frombuffer(x.rows, np.int64), k, np.frombuffer(x.floors, np.float64)))
            else:
                for best in held:
                    best.add(block)
        yield from (best.rows() for best in held)

    found = _lanes(queries.drop("envelope", "least"), shipped, lanes).mapInPandas(
        search, "query_row long, query_id long, vec_id long, score long"
    )
    order = Window.partitionBy("query_id", "query_row").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
