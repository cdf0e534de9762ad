"""Periodic runs of words, found by string synchronising sets.

A synchronising set for a scale t holds positions that depend on the next 2t words alone: the
hash of a window of t words at a position, or t words later, is the smallest of all between.
So equal passages choose equal positions, every t words at least, and two neighbouring positions
with the same context propose the distance between them as a period. At the scale t this finds
the periods from 1.5 t to 3 t; the scales are powers of two. Windows with a period of at most
t/3 are left out of the set, or it would be dense there: those highly periodic regions are
known from smaller scales, and the smallest periods from comparing words directly.
"""

from __future__ import annotations

from collections.abc import Iterator
import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from gustline.llm.common import WORD

#: Periods up to here are found by comparing words; the scale 4 begins behind it.
DIRECT = 5
#: A run repeats its period this often at least, which the scales' ranges rest on.
TIMES = 3
MIN_LENGTH = 24
CHUNK = 1 << 20  # characters of text handled at once
_BLOCK = 64
_NONE = np.uint64(2**64 - 1)
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_found = re.compile(WORD).findall


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hashes of windows that consist of two others."""
    return _mixed(left * _MIX[0] + right)


def _lowest(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every window of ``width`` values: of prefix and suffix minima by blocks."""
    n = len(values) - width + 1
    blocks = np.full(-(-len(values) // width) * width, _NONE)
    blocks[: len(values)] = values
    blocks = blocks.reshape(-1, width)
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[:n], before[width - 1 : width - 1 + n])


def _equal(words: np.ndarray, at: np.ndarray, gap: np.ndarray, step: int) -> np.ndarray:
    """How many words from ``at`` on, forwards or backwards, equal those ``gap`` further."""
    length = np.zeros(len(at), np.int64)
    live = np.arange(len(at))
    while len(live):
        places = (at[live] + step * length[live])[:, None] + step * np.arange(_BLOCK)
        others = places + gap[live, None]
        same = (places >= 0) & (others < len(words))
        same &= words[places.clip(0, len(words) - 1)] == words[others.clip(0, len(words) - 1)]
        more = np.where(same.all(axis=1), _BLOCK, same.argmin(axis=1))
        length[live] += more
        live = live[more == _BLOCK]
    return length


def _direct(words: np.ndarray) -> np.ndarray:
    """(start, end, period) of the runs with a period up to DIRECT, the smaller period first."""
    out = []
    for q in range(1, DIRECT + 1):
        same = words[:-q] == words[q:]
        first, last = np.flatnonzero(np.diff(same, prepend=False, append=False)).reshape(-1, 2).T
        far = last - first >= (TIMES - 1) * q
        out.append(np.stack([first[far], last[far] + q, np.full(far.sum(), q)], axis=1))
    return np.concatenate(out)


def _proposed(places: np.ndarray, context: np.ndarray, width: int, least: int, most: int) -> np.ndarray:
    """(period, start, end): stretches over which words repeat a period further, from equal contexts."""
    order = np.argsort(context, kind="stable")
    at, context = places[order], context[order]
    near = np.flatnonzero(context[1:] == context[:-1])
    gap = at[near + 1] - at[near]
    kept = (gap >= least) & (gap <= most)
    at, gap = at[near][kept], gap[kept]
    order = np.lexsort((at, gap))
    at, gap = at[order], gap[order]
    apart = np.ones(len(at), bool)
    apart[1:] = (gap[1:] != gap[:-1]) | (at[1:] > at[:-1] + width)
    first = np.flatnonzero(apart)
    last = np.append(first[1:], len(at)) - 1
    return np.stack([gap[first], at[first], at[last] + width], axis=1) if len(at) else np.empty((0, 3), np.int64)


def find_runs(words: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """(start, end, period) of all maximal runs of at least TIMES periods, by start and period.

    ``words`` has numbered texts one after another, the longest first, each followed by a number
    found nowhere else; ``lengths`` counts the words of each. Every run has its smallest period.
    """
    if not len(words):
        return np.empty((0, 3), np.int64)
    runs = _direct(words) if len(words) > DIRECT else np.empty((0, 3), np.int64)
    ends = np.cumsum(lengths + 1)
    names, scale = _mixed(words.astype(np.uint64) * _MIX[0] + _MIX[1]), 1
    while True:
        # a text can hold TIMES periods of 1.5 scales, or it and all after it are left behind
        count = np.searchsorted(-lengths, -(4.5 * scale - 1.5), side="right")
        if not count or ends[count - 1] < 3 * scale:
            break
        n = int(ends[count - 1])
        words, names = words[:n], names[: n - scale + 1]
        double = _joined(names[: n - 2 * scale + 1], names[scale:])
        if scale >= 4:
            order = names
            dense = runs[(runs[:, 2] * 3 <= scale) & (runs[:, 1] - runs[:, 0] >= scale) & (runs[:, 0] < n)]
            if len(dense):
                covered = np.zeros(len(names) + 1, np.int64)
                np.add.at(covered, dense[:, 0], 1)
                np.add.at(covered, np.minimum(dense[:, 1] - scale + 1, len(names)), -1)
                order = np.where(np.cumsum(covered[:-1]) > 0, _NONE, names)
            low = _lowest(order, scale + 1)
            chosen = ((order[: len(low)] == low) | (order[scale:] == low)) & (low != _NONE)
            places = np.flatnonzero(chosen)
            wide = places[places <= n - 3 * scale]
            found = np.concatenate([
                _proposed(places, double[places], 2 * scale, 3 * scale // 2, 2 * scale),
                _proposed(wide, _joined(double[wide], names[wide + 2 * scale]), 3 * scale, 2 * scale + 1, 3 * scale),
            ])
            gap, start, end = found.T
            start = start - _equal(words, start - 1, gap, -1)
            end = end + _equal(words, end, gap, 1) + gap
            far = end - start >= TIMES * gap
            runs = np.concatenate([runs, np.stack([start, end, gap], axis=1)[far]])
        names, scale = double, 2 * scale
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    fresh = np.ones(len(runs), bool)
    fresh[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)  # of equal stretches the smallest period
    return runs[fresh]


def _labelled(texts: list[str], min_length: int) -> list[tuple]:
    """(number of words, runs, text without the repeats) of each text."""
    split = [_found(t) for t in texts]
    order = sorted(range(len(split)), key=lambda i: -len(split[i]))
    lengths = np.array([len(split[i]) for i in order], np.int64)
    numbers, _ = pd.factorize(np.array([w for i in order for w in split[i]], object))
    ends = np.cumsum(lengths + 1)
    words = np.empty(int(lengths.sum()) + len(order), np.int64)
    marks = np.zeros(len(words), bool)
    marks[ends - 1] = True
    words[marks] = -1 - np.arange(len(order))
    words[~marks] = numbers
    runs = find_runs(words, lengths)
    runs = runs[runs[:, 1] - runs[:, 0] >= min_length]
    owner = np.searchsorted(ends, runs[:, 0], side="right")
    out: list[tuple] = [(len(w), [], " ".join(w)) for w in split]
    for text in np.unique(owner):
        i = order[text]
        own = runs[owner == text] - [[ends[text] - lengths[text] - 1] * 2 + [0]]
        kept = np.zeros(lengths[text] + 1, np.int64)
        np.add.at(kept, own[:, 0] + own[:, 2], 1)
        np.add.at(kept, own[:, 1], -1)
        left = np.flatnonzero(np.cumsum(kept[:-1]) == 0)
        listed = [{"start": a, "length": b - a, "period": q} for a, b, q in own.tolist()]
        out[i] = (len(split[i]), listed, " ".join([split[i][k] for k in left]))
    return out


def periodic_runs(text: Column, min_length: int = MIN_LENGTH) -> Column:
    """struct<n_words, runs: array<struct<start, length, period>>, collapsed> of a whole text.

    A run is a stretch of consecutive words that repeats its smallest period, reaches over at
    least three periods and ``min_length`` words, and can't be extended; places count words from
    0, runs come by start, then period. ``collapsed`` has the words, joined by one blank, of
    which no run contains a later repeat: of each run the first period stays.

    NULL texts are empty: no words, no runs, an empty text. Texts of any length are handled
    whole, in memory in proportion to their words; repeated rows have equal results. Windows
    are compared by 64-bit hashes within one text, runs are measured on the words themselves.
    """

    @F.pandas_udf("n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
    def found(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows, some, size = [], [], 0
            for t in part:
                some.append(t)
                size += len(t)
                if size >= CHUNK:
                    rows += _labelled(some, min_length)
                    some, size = [], 0
            rows += _labelled(some, min_length)
            yield pd.DataFrame(rows, columns=["n_words", "runs", "collapsed"])

    return found(F.coalesce(text, F.lit("")))


def strongest(runs: Column) -> Column:
    """The run with the greatest length per period, of equals the first; NULL if there is none."""
    return F.aggregate(
        F.slice(runs, 2, F.greatest(F.size(runs), F.lit(1))), F.get(runs, F.lit(0)),
        lambda best, r: F.when(r["length"] * best["period"] > best["length"] * r["period"], r).otherwise(best),
    )


def digest(found: DataFrame) -> DataFrame:
    """Numbers and hashes of ``found``, a result of ``periodic_runs`` beside the other columns."""
    others = [c for c in found.columns if c != "found"]
    rows = found.select(*others, F.col("found.runs").alias("runs"), F.col("found.collapsed").alias("collapsed"))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    best = rows.select(*others, "runs", "collapsed", strongest(F.col("runs")).alias("best"))
    return best.select(
        *others, F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def with_planted_run(doc_id: Column, text: Column) -> Column:
    """The text as it is, or for a tenth of the ids with one period repeated up to its end.

    With h the crc32 of the decimal id and n words, texts with h % 10 = 0 get words
    a + (i - a) % p for each place i from a on, joined by blanks; a = (h / 10) % n and
    p = 1 + (n - a) / (3 + (h / 10) % 8), in whole numbers. A NULL id plants nothing.
    """
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def planted(words: Column) -> Column:
        n = F.size(words)
        a = F.pmod(g, n)
        p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))
        times = F.floor((n - a + p - 1) / p).cast("int")
        block = F.slice(words, (a + 1).cast("int"), p.cast("int"))
        tail = F.slice(F.flatten(F.array_repeat(block, times)), F.lit(1), (n - a).cast("int"))
        return F.array_join(F.concat(F.slice(words, F.lit(1), a.cast("int")), tail), " ")

    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))  # bound once, used many times
    changed = F.element_at(F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, planted(w))), 1)
    return F.when(h % 10 == 0, F.coalesce(changed, text)).otherwise(text)
