"""Token counts of whole texts by a two-tier, map-side lookup of pre-token lengths.

A byte-level BPE never merges across pre-tokens, so a text's count is the sum of its
pre-tokens' counts. Frequent pre-tokens are looked up in a broadcast table; others in a
cache of the Python worker, which the library itself fills. No pre-token is shuffled: the
table is made from one bounded summary per task, and which pre-tokens it holds changes the
work, never a count.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
import json
import re
from unicodedata import category

import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from tokenizers import Tokenizer

#: The split of the byte-level pre-tokenizer, with L letters, N numbers, S white space.
PRE_TOKEN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?[%(L)s]+| ?[%(N)s]+| ?[^%(S)s%(L)s%(N)s]+|[%(S)s]+(?![^%(S)s])|[%(S)s]+"
)
#: Code points whose class all Unicode versions since 9 agree on (Latin, Greek, Cyrillic, general
#: punctuation, currency, kana, Han, Hangul); a text with any other goes to the library.
SETTLED = (
    (0x00, 0x24F), (0x388, 0x3CE), (0x400, 0x481), (0x2000, 0x2064), (0x20A0, 0x20BE),
    (0x2190, 0x23FA), (0x3041, 0x3096), (0x30A1, 0x30FA), (0x4E00, 0x9FD5), (0xAC00, 0xD7A3),
)
WHITE_SPACE = (
    *range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)

TABLE_SIZE = 16_384
SUMMARY_SIZE = 2_048
CACHE_SIZE = 200_000


def _ranges(points: list[int]) -> str:
    """The inside of a character class."""
    out, first = [], None
    for p, after in zip(points, [*points[1:], None]):
        first = p if first is None else first
        if after != p + 1:
            out.append(f"\\U{first:08x}-\\U{p:08x}")
            first = None
    return "".join(out)


def _patterns() -> tuple[re.Pattern, re.Pattern]:
    """The split for texts of settled code points, and a search for any other code point."""
    settled = [p for a, b in SETTLED for p in range(a, b + 1)]
    letters = _ranges([p for p in settled if category(chr(p))[0] == "L"])
    numbers = _ranges([p for p in settled if category(chr(p))[0] == "N"])
    classes = {"L": letters, "N": numbers, "S": _ranges([*WHITE_SPACE])}
    return re.compile(PRE_TOKEN % classes), re.compile(f"[^{_ranges(settled)}]")


class _Splitter:
    """Pre-tokens of a text, or None where only the library splits it surely."""

    def __init__(self, tokenizer_json: str) -> None:
        spec = json.loads(tokenizer_json)
        kind = spec.get("pre_tokenizer") or {}
        plain = (
            spec.get("normalizer") is None
            and kind.get("type") == "ByteLevel"
            and kind.get("use_regex", True)
            and not kind.get("add_prefix_space")
            and (spec["model"].get("dropout") is None)
        )
        added = spec.get("added_tokens") or []
        self.special = [t["content"] for t in added]
        plain = plain and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added)
        split, odd = _patterns()
        self._find = split.findall if plain else None
        self._odd = odd.search

    def __call__(self, text: str) -> list[str] | None:
        if self._find is None or any(s in text for s in self.special) or self._odd(text):
            return None
        return self._find(text)


class _Lengths:
    """Token counts of single pre-tokens, from the library's model."""

    def __init__(self, library: Tokenizer) -> None:
        self._tokenize = library.model.tokenize
        seen = "".join(map(chr, (*range(0x80), *range(0x80, 0x800), *range(0x800, 0xD800, 0x400), *range(0xE000, 0x10FFFF, 0x8000))))
        self._marks = {}  # the character that stands for a byte, as the library writes it
        for c in seen:
            mapped = "".join(x for x, _ in library.pre_tokenizer.pre_tokenize_str(c))
            self._marks.update(zip(c.encode(), mapped))

    def __call__(self, piece: str) -> int:
        return len(self._tokenize(piece.encode().decode("latin-1").translate(self._marks)))


def _load(spark: SparkSession, path: str) -> Broadcast:
    """The tokenizer file's text: a few megabytes, whatever the corpus."""
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def frequent(texts: DataFrame, tokenizer: Broadcast, size: int = TABLE_SIZE, summary: int = SUMMARY_SIZE) -> DataFrame:
    """(token, count): the pre-tokens that most tasks see most often, over all texts.

    Every task keeps at most eight times ``summary`` counters (the rare half goes when they
    are full) and returns its ``summary`` largest.
    """

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        split, seen = _Splitter(tokenizer.value), Counter()
        for part in parts:
            for text in part["text"]:
                seen.update(split(text) or ())
                if len(seen) > 8 * summary:
                    seen = Counter(dict(seen.most_common(4 * summary)))
        top = [x for x in seen.most_common(summary) if len(x[0]) <= 64 and "\0" not in x[0]]
        if top:
            yield pd.DataFrame(top, columns=["token", "count"]).astype({"count": "int64"})

    return (
        texts.mapInPandas(count, "token string, count long")
        .groupBy("token").agg(F.sum("count").alias("count"))
        .orderBy(F.desc("count"), "token").limit(size)
    )


def count_tokens(
    docs: DataFrame, tokenizer_path: str, text: str = "text", table_size: int = TABLE_SIZE, cache_size: int = CACHE_SIZE
) -> Column:
    """A column: the number of tokens the library gives for the whole of ``text``.

    NULL and empty texts have no tokens. No begin, end or other added special tokens; special
    strings inside a text count as the library's default has them. ``docs`` is read once for
    the table of frequent pre-tokens (at most ``table_size``, broadcast) and again where the
    column is used. A worker's cache holds at most ``cache_size`` pre-tokens and is emptied
    when full. Long texts are split whole. Other columns, repeated rows and an empty table
    need no care: the result is one value per row.
    """
    spark = docs.sparkSession
    tokenizer = _load(spark, tokenizer_path)
    known = {}
    if table_size:
        texts = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text"))
        tokens = [r["token"] for r in frequent(texts, tokenizer, table_size).collect()]
        known = dict(zip(tokens, map(_Lengths(Tokenizer.from_str(tokenizer.value)), tokens)))
    table = spark.sparkContext.broadcast(known)

    @F.pandas_udf("long")
    def counted(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        lib, split, first = Tokenizer.from_str(tokenizer.value), _Splitter(tokenizer.value), table.value
        lib.no_truncation()
        lib.no_padding()
        length, cache = _Lengths(lib), {}

        def total(pieces: list[str]) -> int:
            found = list(map(first.get, pieces))
            if None not in found:
                return sum(found)
            out = sum(filter(None, found))
            for piece, n in zip(pieces, found):
                if n is None:
                    n = cache.get(piece)
                    if n is None:
                        n = length(piece)
                        if len(piece) <= 64:  # bounds the cache's bytes too
                            if len(cache) >= cache_size:
                                cache.clear()
                            cache[piece] = n
                    out += n
            return out

        for part in parts:
            out = []
            for t in part:
                pieces = split(t)
                out.append(
                    len(lib.encode(t, add_special_tokens=False).ids) if pieces is None else total(pieces)
                )
            yield pd.Series(out, dtype="int64")

    return counted(F.coalesce(F.col(text), F.lit("")))
