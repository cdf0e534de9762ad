"""SimHash fingerprints and near-duplicate groups by a segment-popcount grid.

A fingerprint's 64 bits are cut into 32 segments of two bits. The number of set bits per
segment is a point in a 32-dimensional grid, and the Manhattan distance of two points never
exceeds the Hamming distance of the fingerprints. With at most three differing bits, one of
the two halves (16 segments each) has a distance of at most one. So two linked fingerprints
share a half's grid cell or lie in cells one step apart in one direction. Only points with
an even bit count probe the neighbouring cells (one step flips the parity), which meets
every such pair once. Candidates of a cell are then verified exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
import xxhash

from gustline.llm.components import connected_components
from gustline.llm.common import fresh
from gustline.session import stage

SEED = 42
SHINGLE = 3
MAX_BITS = 3
CELL_ROWS = 1 << 15
_PIECE = 1 << 16


def fingerprint_of(text: bytes | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of one whole text (UTF-8)."""
    words = (text or b"").lower().split()  # for bytes: ASCII letters, ASCII white space
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    k = min(shingle, len(words))
    starts = [0, *ends[: len(words) - k].tolist()]
    hashed = xxhash.xxh64_intdigest
    view = memoryview(joined)
    counts = np.zeros(64, dtype=np.int64)
    stops = (ends[k - 1 :] - 1).tolist()
    for at in range(0, len(starts), _PIECE):
        h = np.array(
            [hashed(view[i:j], SEED) for i, j in zip(starts[at : at + _PIECE], stops[at : at + _PIECE])],
            dtype="<u8",
        )
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    on = 2 * counts > len(starts)
    return int(np.packbits(on, bitorder="little").view("<u8")[0])


def fingerprint(text: Column, shingle: int = SHINGLE) -> Column:
    """The fingerprint as a long (two's complement); 0 for NULL, empty and blank texts."""

    @F.pandas_udf("long")
    def hashed(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in texts:
            prints = np.array([fingerprint_of(t, shingle) for t in part], dtype=np.uint64)
            yield pd.Series(prints.view(np.int64))

    return hashed(F.coalesce(text.cast("binary"), F.lit(b"")))


def hex_of(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def _cells(prints: DataFrame) -> DataFrame:
    """(cell, fp, own): the two cells a fingerprint lies in and those it probes."""
    low = 0x5555555555555555
    next_bit = F.shiftrightunsigned("fp", 1)
    one = F.col("fp").bitwiseXOR(next_bit).bitwiseAND(F.lit(low))
    two = F.shiftleft(F.col("fp").bitwiseAND(next_bit).bitwiseAND(F.lit(low)), 1)
    points = one.bitwiseOR(two)  # two bits per segment, holding 0, 1 or 2
    rows = prints.withColumn("p", points).withColumn(
        "half",
        F.explode(
            F.array(
                F.struct(F.lit(0).alias("h"), F.col("p").bitwiseAND(F.lit(0xFFFFFFFF)).alias("v")),
                F.struct(F.lit(1).alias("h"), F.shiftrightunsigned("p", 32).alias("v")),
            )
        ),
    ).select("fp", "half.h", "half.v")
    # the sum of the two-bit counts has the parity of the low bits of the counts
    even = F.bit_count(F.col("v").bitwiseAND(F.lit(low))) % 2 == 0
    steps = F.expr(
        """flatten(transform(sequence(0, 15), i -> filter(array(
             if((shiftright(v, 2 * i) & 3) < 2, v + shiftleft(1L, 2 * i), null),
             if((shiftright(v, 2 * i) & 3) > 0, v - shiftleft(1L, 2 * i), null)), x -> x is not null)))"""
    )
    own = rows.select("h", "fp", F.col("v").alias("v"), F.lit(True).alias("own"))
    probes = rows.where(even).select("h", "fp", F.explode(steps).alias("v"), F.lit(False).alias("own"))
    return own.union(probes).select(
        F.col("v").bitwiseOR(F.shiftleft(F.col("h").cast("long"), 40)).alias("cell"), "fp", "own"
    )


class _Forest:
    """Spanning links of the fingerprints of some cells."""

    def __init__(self, n: int) -> None:
        self.up = np.arange(n)

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return int(i)

    def add(self, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
        kept = []
        for i, j in zip(left.tolist(), right.tolist()):
            a, b = self.root(i), self.root(j)
            if a != b:
                self.up[max(a, b)] = min(a, b)
                kept.append((i, j))
        return kept


def _links(cell: np.ndarray, fp: np.ndarray, own: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between rows of equal cells, reduced to a spanning forest per cell.

    Rows are sorted by cell. Row i is compared with row i+1, i+2, ... of its cell, all rows
    at once; memory stays linear in the rows however large a cell is.
    """
    forest = _Forest(len(cell))
    at = np.arange(len(cell) - 1)
    left, right, step = [], [], 1
    while len(at):
        at = at[: np.searchsorted(at, len(cell) - step)]
        at = at[cell[at] == cell[at + step]]
        if not len(at):
            break
        near = np.bitwise_count(fp[at] ^ fp[at + step]) <= max_bits
        near &= own[at] | own[at + step]
        hit = at[near]
        if len(hit):
            up = forest.up
            flat = up[hit] != up[hit + step]
            for i, j in forest.add(hit[flat], hit[flat] + step):
                left.append(i)
                right.append(j)
            if step % 16 == 0:  # shorten paths, so that most known links are seen at once
                while (forest.up != forest.up[forest.up]).any():
                    forest.up = forest.up[forest.up]
        step += 1
    return fp[left], fp[right]


def _split(cells: DataFrame, cell_rows: int) -> DataFrame:
    """``cells`` with large cells cut into pairs of blocks of about ``cell_rows`` rows.

    Every two rows of a cell meet in the pair of their blocks, so nothing is lost, and no task
    holds more than two blocks. A pair's name is a hash: two pairs of one name compare more
    rows than they need to, and each link is verified anyhow.
    """
    large = stage(
        cells.groupBy("cell").agg(F.count("*").alias("n")).where(F.col("n") > cell_rows)
        .select("cell", F.ceil(F.col("n") / cell_rows).alias("blocks")),
        "large-cells",
    )
    met = cells.join(large, "cell", "left")
    few = met.where("blocks is null").select("cell", "fp", "own")
    block = F.pmod(F.xxhash64("fp"), F.col("blocks"))
    many = (
        met.where("blocks is not null").withColumn("b", block)
        .withColumn("o", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .select(F.xxhash64("cell", F.least("b", "o"), F.greatest("b", "o")).alias("cell"), "fp", "own")
    )
    return few.union(many)


def near_links(prints: DataFrame, max_bits: int = MAX_BITS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """(a, b): links between distinct fingerprints ``fp`` that differ in at most ``max_bits``
    bits, as a spanning forest of each grid cell: the same components as all links, without
    all pairs of a large group. Exact for ``max_bits`` up to 3. Cells of more than ``cell_rows``
    rows are compared in pairs of blocks, by many tasks."""
    if not 0 <= max_bits <= 3:
        raise ValueError("the grid with one step per half is exact for at most 3 bits")

    def search(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        none = pd.DataFrame({"cell": [], "fp": [], "own": []}).astype(
            {"cell": "int64", "fp": "int64", "own": "bool"}
        )

        def found(part: pd.DataFrame) -> pd.DataFrame:
            a, b = _links(
                part["cell"].to_numpy(), part["fp"].to_numpy().view(np.uint64),
                part["own"].to_numpy(), max_bits,
            )
            return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

        for part in parts:
            rest = part if rest is None else pd.concat([rest, part], ignore_index=True)
            last = rest["cell"].iloc[-1] if len(rest) else None
            whole = rest["cell"].to_numpy() != last  # the last cell may go on in the next part
            if whole.any():
                yield found(rest[whole])
                rest = rest[~whole].reset_index(drop=True)
        yield found(none if rest is None else rest)

    cells = _split(_cells(prints.select("fp").distinct()), cell_rows)
    n = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        cells.repartition(n, "cell").sortWithinPartitions("cell", "fp")
        .mapInPandas(search, "a long, b long")
    )


def group_roots(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(fp, root) for every fingerprint with a neighbour."""
    return connected_components(near_links(prints, max_bits)).select(F.col("node").alias("fp"), "root")


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per document: key, fingerprint (16 hex digits), component_id, root_print.

    ``component_id`` is the smallest key reachable over links of at most ``max_bits`` differing
    bits, ``root_print`` the component's smallest fingerprint. NULL and empty texts have
    fingerprint zero and are linked like any other; repeated rows stay, one result each; NULL
    keys are never the smallest (a component of NULL keys only has NULL). Other columns are
    not looked at. An empty table gives an empty table.

    Copies collapse to one row per fingerprint (combined before the shuffle) before any
    search, so a text that makes up a third of the table costs one fingerprint. A cell of the
    grid holds distinct fingerprints only; comparisons grow with their square, but a large
    cell's are shared out to many tasks of bounded memory.
    """
    prints = stage(docs.select(F.col(key).alias("key"), fingerprint(F.col(text), shingle).alias("fp")), "prints")
    return with_components(prints, max_bits).select(
        F.col("key").alias(key), hex_of(F.col("fp")).alias("fingerprint"), "component_id",
        hex_of(F.col("root")).alias("root_print"),
    )


def with_components(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``prints`` (key, fp, ...) with root and component_id."""
    first = stage(prints.groupBy("fp").agg(F.min("key").alias("low")), "first")
    roots = stage(group_roots(first, max_bits), "roots")
    rooted = first.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    return prints.join(rooted.select("fp", "root").join(lowest, "root"), "fp")


def drop_near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The documents with one of each component kept: the one with the smallest key.

    Of rows that share the smallest key one stays; a NULL key is larger than any other.
    """
    fp, row = fresh("fp", "row")
    marked = stage(
        docs.withColumn(fp, fingerprint(F.col(text), shingle)).withColumn(row, F.monotonically_increasing_id()),
        "marked",
    )
    prints = marked.select(F.col(fp).alias("fp"), F.col(row).alias("row"), F.col(key).alias("key"))
    rooted = with_components(prints, max_bits)
    kept = rooted.groupBy("root").agg(F.min(F.struct(F.col("key").isNull().alias("none"), "key", "row")).alias("best"))
    return marked.join(kept.select(F.col("best.row").alias(row)), row, "left_semi").drop(fp, row)
