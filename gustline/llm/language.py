"""Language identification with spans: scripts, per-word scores, and Viterbi over the words.

A word's script narrows its languages to those that write in it. Each word has a score per
language from its hashed character n-grams (log ratios of a naive Bayes model, learned from a
bounded sample of labelled texts). Viterbi with a penalty for each switch then labels every
word, so that single odd words don't break a span but passages in another language do.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
import re
import sys

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from gustline.llm.ngrams import WordCache, grams, summed
from gustline.session import stage

#: First code point of each script's ranges; ranges without a name are common.
SCRIPTS = (
    (0x0041, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"),
    (0x0600, "Arabic"), (0x0700, "Syriac"), (0x0750, "Arabic"), (0x0780, "Thaana"), (0x0900, "Devanagari"),
    (0x0980, "Bengali"), (0x0A00, "Gurmukhi"), (0x0A80, "Gujarati"), (0x0B00, "Oriya"), (0x0B80, "Tamil"),
    (0x0C00, "Telugu"), (0x0C80, "Kannada"), (0x0D00, "Malayalam"), (0x0D80, "Sinhala"), (0x0E00, "Thai"),
    (0x0E80, "Lao"), (0x0F00, "Tibetan"), (0x1000, "Myanmar"), (0x10A0, "Georgian"), (0x1100, "Hangul"),
    (0x1200, "Ethiopic"), (0x1780, "Khmer"), (0x1800, "Mongolian"), (0x1E00, "Latin"), (0x1F00, "Greek"),
    (0x2000, ""), (0x2C00, "Glagolitic"), (0x2C60, "Latin"), (0x2DE0, "Cyrillic"), (0x2E80, "Han"),
    (0x3040, "Kana"), (0x3100, "Bopomofo"), (0x3130, "Hangul"), (0x31F0, "Kana"), (0x3400, "Han"),
    (0xA640, "Cyrillic"), (0xA720, "Latin"), (0xAC00, "Hangul"), (0xF900, "Han"), (0xFB00, "Latin"),
    (0xFB1D, "Hebrew"), (0xFB50, "Arabic"), (0xFF21, "Latin"), (0xFF66, "Kana"), (0x10000, ""), (0x20000, "Han"),
)
_STARTS = np.array([s for s, _ in SCRIPTS])

UNKNOWN = "und"
SIZES = (1, 2, 3, 4, 5)
BUCKETS = 1 << 15
SAMPLE_DOCS = 400
SAMPLE_WORDS = 30_000
FULL_LANGUAGES = 255  # of more languages, the words learned and kept are shared out
SWITCH = 12.0
WORD_LIMIT = 6.0
OUTSIDE = -20.0
CACHE = 200_000


def _letters() -> str:
    """A character class of all letters: the code points of the categories L*, not numerals."""
    out, last = [], -2
    for point in range(sys.maxunicode + 1):
        if chr(point).isalpha():
            if point != last + 1:
                out.append([point, point])
            out[-1][1] = last = point
    return "[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in out) + "]+"


_ANY, _ASCII = re.compile(_letters()), re.compile("[A-Za-z]+")


def _pattern(text: str) -> re.Pattern:
    return _ASCII if text.isascii() else _ANY


def _places(text: str) -> Iterator[re.Match]:
    return _pattern(text).finditer(text)


def _words(text: str) -> list[str]:
    """The words of a text, runs of letters, in lower case, one for each match of its pattern.

    Of all letters only the capital I with a dot gets a second code point, which is no letter, in
    lower case.
    """
    find = _pattern(text).findall
    return [w.lower() for w in find(text)] if "\u0130" in text else find(text.lower())


def scripts_of(words: list[str]) -> np.ndarray:
    """For each word the number of its first letter's range in SCRIPTS."""
    return np.maximum(np.searchsorted(_STARTS, [ord(w[0]) for w in words], side="right") - 1, 0)


@dataclass(frozen=True)
class Model:
    """Languages, log ratios per n-gram bucket, and which languages write in which script."""

    languages: tuple[str, ...]
    table: np.ndarray
    scripts: dict[str, np.ndarray]

    def scores(self, words: list[str]) -> np.ndarray:
        """A row per word: evidence for each language, at most WORD_LIMIT apart from its mean."""
        total, count = summed(grams(words, SIZES, BUCKETS), self.table, len(words))
        total /= np.sqrt(np.maximum(count, 1))[:, None].astype(np.float32)
        out = np.clip(total, -WORD_LIMIT, WORD_LIMIT)
        anywhere = np.ones(len(self.languages), dtype=bool)
        candidates = np.array([self.scripts.get(name, anywhere) for _, name in SCRIPTS])
        return np.where(candidates[scripts_of(words)], out, OUTSIDE).astype(np.float32)


def learn(
    labelled: DataFrame, lang: str = "lang", text: str = "text", sample_docs: int = SAMPLE_DOCS, sample_words: int = SAMPLE_WORDS
) -> Model:
    """A model from the texts with a language.

    Every language is learned. The sample of each is bounded: the ``sample_docs`` different
    texts with the smallest hashes; and of those, the ``sample_words`` most frequent words, or
    fewer of each if there are more than FULL_LANGUAGES. Rows whose language or text is NULL, or whose text
    has no letter, teach nothing.
    """
    rows = labelled.select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(text).alias("o"))
    rows = rows.where("lang is not null and text is not null")
    hashes = stage(rows.groupBy("lang", "o").count(), "hashes")
    first = Window.partitionBy("lang").orderBy("o")
    chosen = (
        hashes.withColumn("r", F.row_number().over(first)).where(F.col("r") <= sample_docs)
        .groupBy("lang").agg(F.max("o").alias("cut"))
    )
    cuts = F.broadcast(chosen)  # one row per language
    sample = rows.join(cuts, "lang").where("o <= cut").groupBy("lang", "o").agg(F.first("text").alias("text"))

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for name, texts in part.groupby("lang")["text"]:
                seen = Counter()
                for t in texts:
                    seen.update(w for w in _words(t) if len(w) <= 64)
                if seen:
                    yield pd.DataFrame({"lang": name, "word": [*seen], "n": [*seen.values()]}).astype({"n": "int64"})

    counted = sample.select("lang", "text").mapInPandas(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    common = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    n = chosen.count()
    each = max(1, min(sample_words, sample_words * FULL_LANGUAGES // max(1, n)))
    top = counted.withColumn("r", F.row_number().over(common)).where(F.col("r") <= each).drop("r").toPandas()
    languages = tuple(sorted(top["lang"].unique()))
    table = np.full((BUCKETS, max(1, len(languages))), 0.2, np.float64 if n <= FULL_LANGUAGES else np.float32)
    written: dict[str, np.ndarray] = {}
    by_name = dict(iter(top.groupby("lang")))
    for i, name in enumerate(languages):
        part = by_name[name]
        words, weight = part["word"].tolist(), part["n"].to_numpy(np.float64)
        for ids, word in grams(words, SIZES, BUCKETS):
            table[:, i] += np.bincount(ids, weights=weight[word], minlength=BUCKETS)
        used = Counter()
        for at, times in enumerate(np.bincount(scripts_of(words), weights=weight, minlength=len(SCRIPTS))):
            used[SCRIPTS[at][1]] += times
        for script, times in used.items():
            if times and times >= 0.01 * weight.sum():
                written.setdefault(script, np.zeros(len(languages), dtype=bool))[i] = True
    ratio = np.log(table / table.sum(axis=0))
    ratio -= ratio.mean(axis=1, keepdims=True)
    return Model(languages, ratio.astype(np.float32), written)


def _only(scores: np.ndarray, switch: float) -> int | None:
    """The language of a text that Viterbi gives to one language as a whole, or None.

    A path that leaves language k pays at least one switch for each run of words in another.
    If no run of words gains more than a switch by that, staying is best.
    """
    top = int(scores.sum(axis=0, dtype=np.float64).argmax())
    gain = np.cumsum(scores - scores[:, top : top + 1], axis=0, dtype=np.float64)
    lowest = np.minimum(np.minimum.accumulate(gain, axis=0), 0.0)
    before = np.vstack([np.zeros((1, gain.shape[1])), lowest[:-1]])
    return top if (gain - before).max() <= switch else None


def _paths(scores: np.ndarray, texts: list[np.ndarray], switch: float) -> list[np.ndarray]:
    """The best language of every word: Viterbi over many texts at once, longest first."""
    number = np.min_scalar_type(scores.shape[1])
    most = min(1 << 19, (1 << 27) // max(1, scores.shape[1]))  # words at once
    out: list[np.ndarray] = [np.empty(0, number)] * len(texts)
    order = sorted((i for i in range(len(texts)) if len(texts[i])), key=lambda i: -len(texts[i]))
    at = 0
    while at < len(order):
        longest = len(texts[order[at]])
        group = order[at : at + max(1, most // longest)]
        at += len(group)
        lengths = np.array([len(texts[i]) for i in group])
        words = np.zeros((longest, len(group)), dtype=np.int64)
        for j, i in enumerate(group):
            words[: lengths[j], j] = texts[i]
        running = np.searchsorted(-lengths, -np.arange(longest), side="left")  # texts longer than t
        best = scores[words[0]].astype(np.float64)
        stay = np.ones((longest, *best.shape), dtype=bool)
        source = np.zeros((longest, len(group)), dtype=number)
        for t in range(1, longest):
            n = running[t]
            now = best[:n]
            source[t, :n] = now.argmax(axis=1)
            jump = now.max(axis=1, keepdims=True) - switch
            stay[t, :n] = now >= jump
            best[:n] = np.maximum(now, jump) + scores[words[t, :n]]
        path = np.zeros((longest, len(group)), dtype=number)
        state = best.argmax(axis=1).astype(number)
        column = np.arange(len(group))
        for t in range(longest - 1, -1, -1):
            n = running[t]
            path[t, :n] = state[:n]
            if t:
                keep = stay[t, column[:n], state[:n]]
                state[:n] = np.where(keep, state[:n], source[t, :n])
        for j, i in enumerate(group):
            out[i] = path[: lengths[j], j]
    return out


def _spans(text: str, words: list[str], path: np.ndarray, names: tuple[str, ...]) -> tuple:
    """(language, score, spans) from the language of every word."""
    letters = np.bincount(path, weights=[len(w) for w in words], minlength=len(names))
    top = int(letters.argmax())
    places = [m.span() for m in _places(text)]
    ends = np.flatnonzero(np.diff(path.astype(np.int64), append=-1)).tolist()
    firsts = [0, *(e + 1 for e in ends[:-1])]
    spans = [{"start": places[a][0], "end": places[b][1], "lang": names[path[b]]} for a, b in zip(firsts, ends)]
    return names[top], float(letters[top] / letters.sum()), spans


def identify(docs: DataFrame, model: Model, text: str = "text", switch: float = SWITCH, cache: int = CACHE) -> Column:
    """A column: struct<lang, score, spans: array<struct<start, end, lang>>> of the whole text.

    ``lang`` is the language with most letters (of equals the first by name), ``score`` its
    share of the letters, ``spans`` the runs of words of one language, in code points with the
    end exclusive. NULL and empty texts and texts without a letter are ``und`` with score 0
    and no spans, and so is every text if the model knows no language. A letter is a code point
    of one of the categories L*: digits and other numerals are none. Repeated texts have equal
    results; texts of any length are labelled whole. The column is worked out once for each
    row, even where a filter and another column read it.
    """
    # plain values, so that workers need no copy of this package: BUCKETS rows of a number for each language
    held = docs.sparkSession.sparkContext.broadcast((model.languages, model.table, model.scripts))

    @F.pandas_udf("lang string, score double, spans array<struct<start:int,end:int,lang:string>>")
    def labelled(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = Model(*held.value)
        names, n = known.languages, len(known.languages)
        rows = WordCache(known.scores, max(1, n), min(cache, max(1024, cache * FULL_LANGUAGES // max(1, n))))
        for part in parts:
            texts = part.tolist()
            found: list[tuple] = []
            for at in range(0, len(texts), 512):
                some = texts[at : at + 512]
                words = [_words(t) if n else [] for t in some]
                numbers = rows.numbers(words)
                only = [_only(rows.rows[i], switch) if len(i) else None for i in numbers]
                mixed = [i for i, w in enumerate(words) if w and only[i] is None]
                paths = dict(zip(mixed, _paths(rows.rows, [numbers[i] for i in mixed], switch)))
                for i, t in enumerate(some):
                    if i in paths:
                        found.append(_spans(t, words[i], paths[i], names))
                    elif words[i]:
                        letter = _pattern(t).search
                        first, last = letter(t).start(), len(t) - letter(t[::-1]).start()
                        found.append((names[only[i]], 1.0, [{"start": first, "end": last, "lang": names[only[i]]}]))
                    else:
                        found.append((UNKNOWN, 0.0, []))
            yield pd.DataFrame(found, columns=["lang", "score", "spans"])

    return labelled.asNondeterministic()(F.coalesce(F.col(text), F.lit("")))
