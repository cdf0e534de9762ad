"""Web archives: gzipped WARC records, written by Spark's text writer and read in byte ranges.

Each record is a gzip member of its own. Files have no ``.gz`` suffix, so Spark splits them:
its text source cuts byte ranges at the gzip magic and gives every piece to the task whose
range it starts in. The task checks each piece by decoding it. A magic inside compressed data
cuts a member in two; the member's stream is then not at its end, and the next piece goes on
with it. Where such a cut falls on a range's border, both ends are kept aside and put
together in a second, small step.
"""

from __future__ import annotations

from base64 import b32encode
from collections.abc import Iterator
import hashlib
import re
import zlib

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gustline.llm.common import fresh
from gustline.session import stage

#: gzip's magic with its only method, line end, profile of a revisit.
MAGIC = "\u001f\u008b\u0008"
EOL = b"\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
DATE = "2020-01-01T00:00:00Z"
MIN_BYTES = 0
LEVEL = 3
#: Payload that an archive holds at least on average, unless there are fewer of them than cores.
ARCHIVE_BYTES = 16 << 20

FIELDS = (
    "record_type string, record_id string, target_uri string, refers_to string, declared_digest string,"
    " declared_bytes long, payload_bytes long, payload_digest string, block binary"
)


def digest_of(payload: bytes) -> str:
    return b32encode(hashlib.sha1(payload).digest()).decode()


def _line(name: str, value: object) -> bytes:
    return f"{name}: {value}".encode() + EOL


def record_of(record_id: str, url: str | None, payload: bytes, refers_to: str | None, date: str = DATE) -> bytes:
    """One uncompressed record; a revisit (``refers_to`` given) leaves the payload out."""
    http = HTTP % len(payload)
    block = http if refers_to is not None else http + payload
    lines = [_line("WARC-Type", "response" if refers_to is None else "revisit"), _line("WARC-Record-ID", f"<{record_id}>")]
    if url is not None:  # a header is one line
        lines.append(_line("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    lines += [_line("WARC-Date", date), _line("WARC-Payload-Digest", f"sha1:{digest_of(payload)}"), _line("X-Payload-Length", len(payload))]
    if refers_to is not None:
        lines += [_line("WARC-Refers-To", f"<{refers_to}>"), _line("WARC-Profile", PROFILE)]
    lines += [_line("Content-Type", "application/http; msgtype=response"), _line("Content-Length", len(block))]
    return b"WARC/1.1" + EOL + b"".join(lines) + EOL + block + EOL + EOL


def member_of(record: bytes, level: int = LEVEL) -> bytes:
    """The record as a gzip member that ends in a zero byte.

    The last byte of a member is the high byte of its length, zero below 16 MiB; a longer
    record is followed by an empty member, which readers skip.
    """
    def packed(data: bytes) -> bytes:
        squeeze = zlib.compressobj(level, zlib.DEFLATED, 31)
        return squeeze.compress(data) + squeeze.flush()

    out = packed(record)
    return out if out[-1] == 0 else out + packed(b"")


def _records(data: bytes) -> Iterator[tuple]:
    """The rows of one decoded member."""
    at = 0
    while at < len(data):
        end = data.index(EOL + EOL, at)
        head = dict(
            (k.strip().lower(), v.strip())
            for k, _, v in (line.partition(":") for line in data[at:end].decode().split("\r\n")[1:])
        )
        size = int(head["content-length"])
        block = data[end + 4 : end + 4 + size]
        if len(block) < size:
            raise ValueError("a record is shorter than its length says")
        payload = block.partition(EOL + EOL)[2] if head.get("content-type", "").startswith("application/http") else block
        declared = head.get("warc-payload-digest", "").removeprefix("sha1:") or None
        found, kind = digest_of(payload), head.get("warc-type")
        if kind == "response" and declared not in (None, found):
            raise ValueError(f"payload digest {found} differs from the declared {declared}")
        length = head.get("x-payload-length")
        yield (
            kind, head.get("warc-record-id", "").strip("<>") or None, head.get("warc-target-uri"),
            head.get("warc-refers-to", "").strip("<>") or None, declared, int(length) if length else None,
            len(payload), found, block,
        )
        at = end + 4 + size + 4


class _Member:
    """A gzip member that grows piece by piece; pieces come without the magic before them."""

    def __init__(self, piece: bytes) -> None:
        self._raw, self._out, self._open = [], [], zlib.decompressobj(31)
        self.feed(piece)

    def feed(self, piece: bytes) -> None:
        self._raw.append(MAGIC.encode("latin-1") + piece)
        self._out.append(self._open.decompress(self._raw[-1]))

    @property
    def done(self) -> bool:
        return self._open.eof

    def data(self) -> bytes:
        return b"".join(self._out)

    def raw(self) -> bytes:
        return b"".join(self._raw)


def _begin(piece: bytes) -> _Member | None:
    """The member that a piece starts, or None where its headers don't decode."""
    if not piece or piece[0] & 0xE0:  # reserved flags
        return None
    try:
        member = _Member(piece)
    except zlib.error:
        return None
    start = member.data()[:5]
    return member if start == b"WARC/"[: len(start)] else None


def _members(stream: bytes) -> Iterator[bytes]:
    """Data of the members of a byte stream."""
    while stream:
        one = zlib.decompressobj(31)
        data = one.decompress(stream)
        if not one.eof:
            raise ValueError("a file ends inside a member")
        yield data
        stream = one.unused_data


def read_archive(spark: SparkSession, path: str, with_block: bool = False) -> DataFrame:
    """The records of the archives below ``path``: FIELDS; ``block`` is NULL without ``with_block``.

    A task reads its byte ranges, whatever the files' sizes; a record must fit into memory.
    Payload length and digest are taken from the payload; those of the header, which a
    revisit needs, are the declared ones. Damaged members raise an error. The decoded
    records are staged once, so that members cut at the border of two ranges can be found.
    """
    pieces = (
        spark.read.option("encoding", "ISO-8859-1").option("lineSep", MAGIC).text(path)
        .select(
            F.col("value").cast("binary").alias("piece"),
            F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"),
        )
    )
    columns = [f.split()[0] for f in FIELDS.split(", ")]
    schema = f"path string, start long, part string, raw binary, {FIELDS}"
    none = (None,) * len(columns)

    def rows(where: tuple, data: bytes) -> list[tuple]:
        return [(*where, None, None, *r[:-1], r[-1] if with_block else None) for r in _records(data)]

    def frame(found: list[tuple]) -> pd.DataFrame:
        out = pd.DataFrame(found, columns=["path", "start", "part", "raw", *columns], dtype=object)
        return out.astype({"declared_bytes": "Int64", "payload_bytes": "Int64", "start": "int64"})

    def decode(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        where, now, head, seen = None, None, [], False

        def close() -> list[tuple]:
            out = [(*where, "head", b"".join(MAGIC.encode("latin-1") + x for x in head), *none)] if head else []
            return out if now is None else [*out, (*where, "tail", now.raw(), *none)]

        for part in parts:
            out = []
            for piece, path_, start in zip(part["piece"], part["path"], part["start"]):
                if (path_, start) != where:
                    out += close()
                    where, now, head, seen = (path_, start), None, [], False
                    if start == 0:  # what stands before the first magic
                        if piece:
                            raise ValueError(f"{path_} does not start with a gzip member")
                        continue
                if now is not None:
                    now.feed(piece)
                else:
                    now = _begin(piece)
                    if now is None:
                        if seen or start == 0:
                            raise ValueError(f"{path_}, range from {start}: bytes that are no gzip member")
                        head.append(bytes(piece))
                        continue
                seen = True
                if now.done:
                    out += rows(where, now.data())
                    now = None
            yield frame(out)
        yield frame(close())

    def mend(group: pd.DataFrame) -> pd.DataFrame:
        """Members cut at borders, of one file: an unfinished one goes on in the next ranges' first pieces."""
        group = group.sort_values(["start", "part"])  # a range's head comes before its tail
        where = (group["path"].iloc[0], 0)
        stream = b"".join(map(bytes, group["raw"]))
        return frame([row for data in _members(stream) for row in rows(where, data)])

    found = stage(pieces.mapInPandas(decode, schema), "records")
    cut = found.where("part is not null").select("path", "start", "part", "raw")
    mended = cut.groupBy("path").applyInPandas(mend, schema)
    return found.where("part is null").union(mended).select(*columns)


def _name(page_id: Column) -> Column:
    return F.concat(F.lit("urn:x-page:"), F.coalesce(page_id.cast("string"), F.lit("none")))


def write_archive(
    pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html",
    min_bytes: int = MIN_BYTES, level: int = LEVEL,
) -> None:
    """Write one record per row below ``path``; payload: the html in UTF-8 (NULL: empty).

    Of rows with equal payloads of at least ``min_bytes`` bytes, those with the smallest id are
    responses and the others revisits of it; so repeated rows with that id are responses too. A
    NULL id is larger than any other; payloads that only NULL ids have are all responses. A NULL
    url leaves its header out. An empty table writes no record. Other columns are not read.

    Payloads meet by digest and length only; the texts are shuffled once, by id, so a payload
    that a third of the pages share stays spread. There is an archive for each task, but small
    tables make no more of them than cores or than ARCHIVE_BYTES asks for: every file costs its
    writer and reader a fixed amount, on local disks a process of its own for its permissions.
    """
    p, u, body, sha = fresh("page", "url", "body", "sha")
    rows = pages.select(
        F.col(page_id).alias(p), F.col(url).alias(u), F.coalesce(F.col(html).cast("binary"), F.lit(b"")).alias(body)
    ).withColumn(sha, F.sha1(body))
    sizes = stage(rows.select(p, sha, F.octet_length(body).alias("n")), "digests")
    known = sizes.where(F.col("n") >= min_bytes)
    first = known.groupBy(sha, "n").agg(F.min(p).alias("first"), F.count("*").alias("rows")).where("rows > 1")
    again = (
        known.distinct().join(first, [sha, "n"])
        .where(F.col("first").isNotNull() & ~F.col(p).eqNullSafe(F.col("first")))
        .select(F.col(p).alias("other"), F.col(sha).alias("other_sha"), "first")
    )
    decided = rows.join(again, F.col(p).eqNullSafe(F.col("other")) & (F.col(sha) == F.col("other_sha")), "left").select(
        _name(F.col(p)).alias("id"), F.col(u).alias("url"), F.col(body).alias("body"),
        F.when(F.col("first").isNotNull(), _name(F.col("first"))).alias("refers_to"),
    )

    def pack(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield pd.DataFrame(
                {
                    "member": [
                        member_of(record_of(i, u_ if isinstance(u_, str) else None, bytes(b), r if isinstance(r, str) else None), level)[:-1]
                        for i, u_, b, r in zip(part["id"], part["url"], part["body"], part["refers_to"])
                    ]
                }
            )

    payload = sizes.agg(F.sum("n")).first()[0] or 0
    archives = max(pages.sparkSession.sparkContext.defaultParallelism, -(-payload // ARCHIVE_BYTES))
    members = decided.coalesce(archives).mapInPandas(pack, "member binary")
    # the line separator is the zero byte that each member ends in; a string's bytes go out as they are
    members.select(F.col("member").cast("string")).write.option("lineSep", "\u0000").mode("errorifexists").text(path)


def page_rows(records: DataFrame) -> DataFrame:
    """Per record of :func:`write_archive`: page_id, payload_bytes, payload_digest, record_type, refers_to."""

    def number(name: str) -> Column:
        return F.regexp_extract(F.col(name), r"^urn:x-page:(-?[0-9]+)$", 1).try_cast("long")

    again = F.col("record_type") == "revisit"
    return records.select(
        number("record_id").alias("page_id"),
        F.when(again, F.col("declared_bytes")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(again, F.col("declared_digest")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type", number("refers_to").alias("refers_to"),
    )
