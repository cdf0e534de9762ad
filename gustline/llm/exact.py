"""Exact duplicates by an exchange of Golomb-coded fingerprints.

Tasks cut their rows into parts and group equal texts within each, by bytes. A part sends the
sorted fingerprints of its texts, Golomb-coded, to owners of fingerprint ranges; an owner answers
with a bitmap for each part that shares any with another. Only texts whose bit is set, the
suspects, are shuffled, one for each part and text, and grouped by their bytes. The parts are a
table in buckets, so texts meet their bitmaps without being shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
import math
import struct

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from gustline.llm.common import fresh
from gustline.session import stage, staged_path

#: Bits of a fingerprint. Equal ones of different texts cost a comparison, never a result.
BITS = 48
PART_ROWS, PART_BYTES = 16_384, 32 << 20
OWNER_ROWS = 1 << 21
_HEAD = "<IB"


def encode(values: np.ndarray, least: int) -> bytes:
    """Golomb code of ascending different numbers of at least ``least``: gaps by a power of two,
    all quotients in unary, then all remainders."""
    gaps = np.diff(values, prepend=least - 1) - 1
    mean = float(gaps.mean()) if len(gaps) else 0.0
    k = max(0, math.ceil(math.log2(mean * math.log(2)))) if mean > 2 else 0
    ends = np.cumsum((gaps >> k) + 1)
    unary = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    unary[ends - 1] = 1
    rest = (gaps[:, None] >> np.arange(k - 1, -1, -1)) & 1
    return struct.pack(_HEAD, len(values), k) + np.packbits(unary).tobytes() + np.packbits(rest.astype(np.uint8)).tobytes()


def decode(message: bytes, least: int) -> np.ndarray:
    n, k = struct.unpack_from(_HEAD, message)
    size = -(-n * k // 8)
    body = np.frombuffer(message, np.uint8, offset=struct.calcsize(_HEAD))
    unary, rest = np.unpackbits(body[: len(body) - size]), np.unpackbits(body[len(body) - size :], count=n * k)
    quotient = np.diff(np.flatnonzero(unary)[:n], prepend=-1) - 1
    gaps = (quotient << k) + rest.reshape(n, k).astype(np.int64) @ (1 << np.arange(k - 1, -1, -1, dtype=np.int64))
    return least + np.cumsum(gaps + 1) - 1


def _least(owner: int, owners: int, bits: int) -> int:
    """The smallest fingerprint of an owner: owner * 2^bits / owners, rounded up."""
    return -(-(owner << bits) // owners)


class _Part:
    """Rows of one part, and the rows it leaves behind."""

    def __init__(self, number: int, owners: int, bits: int) -> None:
        self.number, self.owners, self.bits = number, owners, bits
        self.classes: dict[bytes, int] = {}
        self.ids: list = []
        self.members: list[int] = []
        self.size = 0

    def add(self, doc_id, text: str) -> None:
        body = text.encode().lower()  # of bytes only A to Z have a lower case
        known = self.classes.setdefault(body, len(self.classes))
        if known == len(self.classes) - 1:
            self.size += len(body)
        self.members.append(known)
        self.ids.append(None if pd.isna(doc_id) else doc_id)

    def rows(self) -> pd.DataFrame:
        digests = [sha256(body).digest() for body in self.classes]
        prints = np.array([int.from_bytes(d[:8]) >> (64 - self.bits) for d in digests], np.int64)
        owner = np.array([int(p) * self.owners >> self.bits for p in prints], np.int64)
        stays: dict[int, int] = {}
        for row, (c, i) in enumerate(zip(self.members, self.ids)):
            held = self.ids[stays[c]] if c in stays else None
            if c not in stays or (i is not None and (held is None or i > held)):
                stays[c] = row
        values = np.unique(prints)
        first = np.searchsorted(values, [_least(o, self.owners, self.bits) for o in range(self.owners + 1)])
        place = np.searchsorted(values, prints) - first[owner]
        size = np.bincount(self.members, minlength=len(digests))
        of = np.array(self.members, np.int64)
        out = pd.DataFrame({
            "part": self.number, "class": of, "doc_id": pd.Series(self.ids, dtype=object), "print": prints[of],
            "owner": owner[of], "place": place[of], "digest": pd.Series([digests[c] for c in of], dtype=object),
            "local_size": size[of], "message": None,
        })
        chosen = pd.Series([stays[c] for c in of])
        out["local_id"] = pd.Series([self.ids[r] for r in chosen], dtype=object)
        out["leads"] = chosen.to_numpy() == np.arange(len(of))
        bodies = list(self.classes)
        out["body"] = pd.Series([bodies[c] if leads else None for c, leads in zip(of, out["leads"])], dtype=object)
        sent = [
            (o, encode(values[first[o] : first[o + 1]], _least(o, self.owners, self.bits)))
            for o in np.flatnonzero(np.diff(first))
        ]
        messages = pd.DataFrame(sent, columns=["owner", "message"]).assign(part=self.number)
        return pd.concat([out, messages], ignore_index=True)


def _schema(id_type: T.DataType) -> T.StructType:
    long, raw = T.LongType(), T.BinaryType()
    kinds = {
        "part": long, "class": long, "doc_id": id_type, "print": long, "owner": long, "place": long, "digest": raw,
        "local_size": long, "message": raw, "local_id": id_type, "leads": T.BooleanType(), "body": raw,
    }
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


def _bit(bitmap: Column, place: Column) -> Column:
    """The bit at a place of a bitmap whose bytes begin with the highest bit."""
    byte = F.conv(F.hex(F.substring(bitmap, (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.getbit(byte, (7 - place % 8).cast("int")) == 1, F.lit(False))


def _exchange(table: DataFrame, duplicates) -> tuple[DataFrame, DataFrame, T.StructType]:
    """Suspects and the texts they were verified to share, both stored, and the table's schema."""
    sent = table.where("message is not null").select("part", "owner", "message")
    answers = sent.groupBy("owner").applyInPandas(duplicates, "part long, owner long, bitmap binary")
    by_part = stage(
        answers.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("owner", "bitmap"))).alias("bitmaps")), "bitmaps"
    )
    marked = table.where("leads").join(by_part.hint("merge"), "part").where(_bit(F.col("bitmaps")[F.col("owner")], F.col("place")))
    verified = marked.groupBy("print", "body").agg(F.max("local_id").alias("keep_id"), F.sum("local_size").alias("size"))
    verified = stage(verified.select("print", F.unhex(F.sha2("body", 256)).alias("digest"), "keep_id", "size"), "verified")
    return verified, stage(marked.select("part", "class", "print", "digest", "local_id"), "suspects"), table.schema


def exact_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", bits: int = BITS,
    part_rows: int = PART_ROWS, part_bytes: int = PART_BYTES,
) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row of ``docs``.

    Texts are equal when they are after lower-casing A to Z; a NULL text is empty. Of equal texts
    the row with the largest id stays (a NULL id is the smallest); of several rows with that
    id exactly one stays. ``group_size`` counts rows. An empty table gives an empty table, other
    columns are not read. Whole texts are compared: within a part by their bytes, between parts as
    grouping keys; verdicts come back by SHA-256.

    A part holds at most ``part_rows`` rows or ``part_bytes`` of different texts (a longer text
    makes a part of its own), and sends one row of each text, however many copies it has. Owners
    hold about OWNER_ROWS fingerprints: their number follows the number of rows.
    """
    spark = docs.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    owners = max(tasks, rows.count() // OWNER_ROWS + 1)

    def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = TaskContext.get().partitionId() << 32
        part = _Part(number, owners, bits)
        for batch in batches:
            for doc_id, body in zip(batch["doc_id"].astype(object), batch["text"]):
                part.add(doc_id, body)
                if len(part.ids) >= part_rows or part.size >= part_bytes:
                    yield part.rows()
                    number += 1
                    part = _Part(number, owners, bits)
        if part.ids:
            yield part.rows()

    path, (name,) = staged_path(spark, "parts"), fresh("parts")
    local = rows.mapInPandas(parts, _schema(rows.schema["doc_id"].dataType))
    local.write.bucketBy(tasks, "part").option("path", path).format("parquet").saveAsTable(name)

    def duplicates(group: pd.DataFrame) -> pd.DataFrame:
        least = _least(int(group["owner"].iloc[0]), owners, bits)
        sets = [decode(m, least) for m in group["message"]]
        values, times = np.unique(np.concatenate(sets), return_counts=True)
        shared = values[times > 1]
        marks = [np.isin(s, shared, assume_unique=True) for s in sets]
        out = group[["part", "owner"]].assign(bitmap=[np.packbits(m).tobytes() if m.any() else None for m in marks])
        return out[out["bitmap"].notna()]

    try:
        verified, suspects, schema = _exchange(spark.table(name), duplicates)
    finally:
        spark.sql(f"DROP TABLE {name}")  # its files stay in the shared folder

    same = Window.partitionBy("print", "digest")
    holds = F.col("local_id").eqNullSafe(F.col("keep_id"))
    met = suspects.join(verified, ["print", "digest"]).withColumn("winner", F.min(F.when(holds, F.col("part"))).over(same))
    met = met.select("part", "class", "keep_id", "size", (F.col("winner") == F.col("part")).alias("wins"))
    stored = spark.read.schema(schema).parquet(path).where("class is not null")
    all_rows = stored.select("part", "class", "doc_id", "digest", "local_id", "local_size", "leads")
    joined = all_rows.join(met.withColumn("met", F.lit(True)), ["part", "class"], "left")
    across = F.col("met").isNotNull()
    return joined.select(
        "doc_id",
        F.when(across, F.col("keep_id")).otherwise(F.col("local_id")).alias("keep_id"),
        F.when(across, F.col("size")).otherwise(F.col("local_size")).alias("group_size"),
        (F.col("leads") & F.coalesce("wins", F.lit(True))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
