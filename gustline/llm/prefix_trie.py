"""Prefix trie of conversations: balanced parentheses in shards, with shared spines merged.

Different paths, sorted, are cut into shards. A shard writes its part of the trie as balanced
parentheses; minima of the excess over blocks find the close of each node and so its subtree,
ranks count leaf pairs in it, and cumulative sums give members and savings. A shard also sees the
path before its first and the one after its last: nodes on those may lie in other shards too,
the spines, and their partial sums are merged. Every node is owned by the first shard with it.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import md5, sha256

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from gustline.session import stage

#: Bytes of a turn in a path: a digest of role and text, and the number of code points.
TURN = 20
SHARD_BYTES = 16 << 20
ID_BITS = 10  # ids are listed by runs of 1024 before they are hashed
BLOCK = 64
_EMPTY = sha256(b"").hexdigest()
_LARGEST = np.iinfo(np.int64).max


class Parentheses:
    """A balanced sequence, with a tree of minima over blocks of its excess."""

    def __init__(self, bits: np.ndarray) -> None:
        self.opens = np.flatnonzero(bits)
        self.rank = np.cumsum(bits)  # opens up to each place
        n = -(-len(bits) // BLOCK)
        self.size = 1 << max(0, n - 1).bit_length()
        self.excess = np.full(self.size * BLOCK, np.iinfo(np.int32).max, np.int32)
        self.excess[: len(bits)] = np.cumsum(2 * bits.astype(np.int32) - 1)
        self.lows = np.zeros(2 * self.size, np.int32)
        self.lows[self.size :] = self.excess.reshape(-1, BLOCK).min(axis=1)
        half = self.size // 2
        while half:
            self.lows[half : 2 * half] = self.lows[2 * half : 4 * half].reshape(-1, 2).min(axis=1)
            half //= 2

    def _in_block(self, start: np.ndarray, target: np.ndarray) -> np.ndarray:
        """The first place from ``start`` to its block's end where the excess falls to the target, or -1."""
        out = np.empty(len(start), np.int64)
        for at in range(0, len(start), 1 << 14):
            some = start[at : at + (1 << 14)]
            places = (some // BLOCK * BLOCK)[:, None] + np.arange(BLOCK)
            falls = (self.excess[places] <= target[at : at + (1 << 14), None]) & (places >= some[:, None])
            out[at : at + len(some)] = np.where(falls.any(axis=1), places[:, 0] + falls.argmax(axis=1), -1)
        return out

    def find_close(self) -> np.ndarray:
        """The close of every open: the next place with an excess one below its own."""
        target = self.excess[self.opens] - 1
        close = self._in_block(self.opens, target)
        far = np.flatnonzero(close < 0)
        node, target = self.size + self.opens[far] // BLOCK + 1, target[far]
        while (up := self.lows[node] > target).any():
            after = node[up] + 1
            node[up] = after // (after & -after)  # the largest subtree that begins there
        while (down := node < self.size).any():
            left = 2 * node[down]
            node[down] = left + (self.lows[left] > target[down])
        close[far] = self._in_block((node - self.size) * BLOCK, target)
        return close


def _common(turns: np.ndarray, begin: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """How many first turns each path has in common with the one before it."""
    both = np.minimum(depth, np.roll(depth, 1))
    both[:1] = 0
    path = np.repeat(np.arange(len(depth)), both)
    turn = np.arange(len(path)) - np.repeat(np.cumsum(both) - both, both)
    same = (turns[begin[path] + turn] == turns[begin[path - 1] + turn]).all(axis=1)
    out = both.copy()
    np.minimum.at(out, path[~same], turn[~same])
    return out


def _nodes(part: pd.DataFrame) -> pd.DataFrame:
    """The nodes of one shard's paths; rows without ``n`` are the paths around it."""
    part = part.sort_values("path", ignore_index=True)
    paths, own = part["path"].tolist(), part["n"].notna().to_numpy()
    depth = np.array([len(p) // TURN for p in paths], np.int64)
    begin = np.cumsum(depth) - depth
    turns = np.frombuffer(b"".join(paths), ">u4").reshape(-1, TURN // 4)
    shared = _common(turns, begin, depth)
    opened, closed = depth - shared, np.append(0, depth[:-1]) - shared
    steps = np.concatenate([[1], np.stack([closed, opened], axis=1).ravel(), [depth[-1] + 1]])
    kinds = np.concatenate([[1], np.tile([0, 1], len(paths)), [0]]).astype(np.uint8)
    trie = Parentheses(np.repeat(kinds, steps))
    first = 1 + np.cumsum(opened) - opened
    path = np.repeat(np.arange(len(paths)), opened)
    level = np.append(0, np.arange(len(path)) + 1 - first[path] + 1 + shared[path])
    count = len(level)
    length = np.append(0, turns[begin[path] + level[1:] - 1, -1].astype(np.int64))
    owned = np.append(bool(own[0]), own[path])
    # parents, and the nodes of the last path
    parent = np.arange(count) - 1
    stack = [0]
    spine = np.zeros(count, bool)
    spine[0] = True
    for i, (d, k, n) in enumerate(zip(shared.tolist(), first.tolist(), opened.tolist())):
        if n:
            parent[k] = stack[d]
        if not own[i]:  # a path around the shard: what it shares is a spine
            spine[stack[: d + 1]] = True
            spine[k : k + n] = True
        stack[d + 1 :] = range(k, k + n)
    closes = trie.find_close()
    low, high = np.arange(count), trie.rank[closes]
    ends = np.where(opened > 0, first + opened - 1, 0)[own]
    times = np.zeros(count, np.int64)
    times[ends] = part["n"].to_numpy()[own].astype(np.int64)
    smallest = np.full(count, _LARGEST)
    smallest[ends] = part["first"].to_numpy()[own].astype(np.int64)
    order = np.argsort(-level, kind="stable")
    for some in np.split(order, np.flatnonzero(np.diff(level[order])) + 1)[:-1]:
        np.minimum.at(smallest, parent[some], smallest[some])

    def within(values: np.ndarray) -> np.ndarray:
        total = np.append(0, np.cumsum(values))
        return total[high] - total[low]

    members = within(times)
    leaf = owned & (closes == trie.opens + 1)
    saved = within(length * (members - owned))
    children = np.bincount(parent[1:][owned[1:]], minlength=count)
    last = np.append(0, path)  # a path each node lies on
    keyed = spine | (times > 0)
    keys = np.array([md5(paths[p][: TURN * d]).hexdigest() if k else None for p, d, k in zip(last, level, keyed)], object)
    above = np.where(np.arange(count) > 0, keys[parent], None)
    inner = (np.arange(count) > 0) & ~spine[parent]
    out = pd.DataFrame({
        "shard": part["shard"].iloc[0], "key": keys, "parent_key": np.where(inner, None, above), "depth": level,
        "conv_id": smallest, "parent_conv_id": pd.Series(smallest[parent], dtype="Int64").where(inner),
        "n_convs": members, "n_children": children, "n_leaves": within(leaf.astype(np.int64)), "saved_tokens": saved,
        "spine": spine, "ended": times > 0,
    })
    return out[members > 0]


_NODES = (
    "shard long, key string, parent_key string, depth long, conv_id long, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, spine boolean, ended boolean"
)


def paths_of(conversations: DataFrame, key: str = "conv_id", order: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, path): the turns of each conversation, 20 bytes each, by ``order``, NULLs first.

    NULL roles and texts are empty. Turns with equal order come by role, then by the digest of role
    and text, so repeated rows stay. Rows with a NULL key belong to no conversation and have no
    node. A path must fit in a row: a hundred million turns.
    """
    role_, text_ = (F.coalesce(F.col(c), F.lit("")) for c in (role, text))
    digest = F.substring(F.sha2(F.concat(F.length(role_).cast("string"), F.lit(":"), role_, text_), 256), 1, 2 * (TURN - 4))
    turn = F.concat(digest, F.lpad(F.hex(F.length(text_)), 8, "0"))
    rows = conversations.where(F.col(key).isNotNull()).select(
        F.col(key).alias("conv_id"), F.struct(F.col(order).isNotNull().alias("a"), F.coalesce(order, F.lit(0)).alias("b"), role_.alias("c"), turn.alias("d")).alias("turn")
    )
    listed = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    return listed.select("conv_id", F.unhex(F.array_join("turns.d", "")).alias("path"))


def rebuilt(paths: DataFrame) -> DataFrame:
    """Every path with its first turns replaced by those of the conversation its hundred begins with.

    With h the crc32 of the decimal id modulo 6, the first h turns of conversation id - id % 100
    (fewer if it has fewer, none if there is no such) stand before the own turns after the first h.
    """
    paths = paths.withColumn("base", F.col("conv_id") - F.col("conv_id") % 100)
    begins = paths.where("conv_id = base").select("base", F.substring("path", 1, 5 * TURN).alias("front"))
    bytes_ = (TURN * (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6)).cast("int")
    front = F.substring(F.coalesce("front", F.lit(b"")), F.lit(1), bytes_)
    rest = F.substring("path", bytes_ + 1, F.lit(2**31 - 1) - bytes_)
    return paths.join(begins, "base", "left").select("conv_id", F.concat(front, rest).alias("path"))


def _ends(paths: DataFrame) -> DataFrame:
    """(key, ends_sha256): SHA-256 of the ids whose path ends at a node, ascending, joined by commas.

    The ids come in runs, so a path with very many has a thousandth as many rows; those stream
    through one hash, in order, as SHA-256 demands.
    """
    run = F.shiftright("conv_id", ID_BITS).alias("run")
    runs = paths.groupBy(F.md5("path").alias("key"), run).agg(F.array_join(F.array_sort(F.collect_list("conv_id")), ",").alias("ids"))

    def hashed(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, state = None, None
        for part in parts:
            out = []
            for key, ids in zip(part["key"], part["ids"]):
                if key != now:
                    if now is not None:
                        out.append((now, state.hexdigest()))
                    now, state = key, sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield pd.DataFrame(out, columns=["key", "ends_sha256"])
        if now is not None:
            yield pd.DataFrame([(now, state.hexdigest())], columns=["key", "ends_sha256"])

    return runs.repartition("key").sortWithinPartitions("key", "run").select("key", "ids").mapInPandas(hashed, "key string, ends_sha256 string")


def prefix_trie(paths: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """A row for every different beginning of the paths (conv_id, path), the empty one included.

    ``conv_id`` is the smallest member, a conversation whose path begins so; ``parent_conv_id`` that
    of the node one turn above (NULL at the root); ``n_convs`` counts members, ``n_children`` nodes one
    turn below, ``n_leaves`` nodes without children in the subtree; ``saved_tokens`` adds up (n_convs
    - 1) times the code points of the last turn over the subtree; ``ends_sha256`` is the SHA-256 of
    the ids of members that end there. No conversations have no root: an empty table.

    Equal paths are counted before they are sorted, so a path of a third of all conversations is
    one row of one shard. A shard holds about ``shard_bytes`` of paths.
    """
    spark = paths.sparkSession
    paths = stage(paths, "paths")
    size = paths.agg(F.sum(F.length("path"))).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // shard_bytes + 1)
    different = paths.groupBy("path").agg(F.count("*").alias("n"), F.min("conv_id").alias("first"))
    ranged = stage(different.repartitionByRange(shards, "path").withColumn("shard", F.spark_partition_id().cast("long")), "shards")
    in_order = Window.orderBy("shard")  # a row for each shard
    edges = ranged.groupBy("shard").agg(F.min("path").alias("low"), F.max("path").alias("high"))
    beside = edges.select("shard", F.lag("high").over(in_order).alias("before"), F.lead("low").over(in_order).alias("after"))
    around = beside.select("shard", F.explode(F.array("before", "after")).alias("path"))
    around = around.where("path is not null").select("path", F.lit(None).cast("long").alias("n"), F.lit(None).cast("long").alias("first"), "shard")
    nodes = stage(ranged.union(around).groupBy("shard").applyInPandas(_nodes, _NODES), "nodes")

    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    parts = nodes.where("spine")
    spines = parts.groupBy("key").agg(
        F.min("depth").alias("depth"), F.min("parent_key").alias("parent_key"), F.min("conv_id").alias("conv_id"), *sums, F.max("ended").alias("ended")
    )
    spines = stage(spines, "spines")
    heads = spines.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("above"))
    in_shard = parts.select("shard", F.col("key").alias("parent_key")).join(heads, "parent_key")
    below = nodes.where("not spine").join(in_shard, ["shard", "parent_key"], "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above"))
    merged = spines.join(heads, "parent_key", "left").withColumn("parent_conv_id", F.col("above"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    found = below.select(*columns, "key", "ended").unionByName(merged.select(*columns, "key", "ended"))
    ended = found.where("ended").join(_ends(paths), "key").select(*columns, "ends_sha256")
    return ended.union(found.where("not ended").select(*columns, F.lit(_EMPTY).alias("ends_sha256")))
