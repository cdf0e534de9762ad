"""Toxicity scores from a bidirectional gated recurrent network, trained in numpy.

A word enters as its own vector next to the sum of its character n-grams' vectors. Two gated
recurrent units read a window of words forwards and backwards, attention pools their states,
and a logistic unit scores the window. A text's score is that of its worst window; windows
overlap and cover the whole text. Training follows the same rule: the worst of a text's
windows carries its label.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from gustline.llm.ngrams import WordCache, grams, summed
from gustline.session import stage

WINDOW = 48
STRIDE = 32
SIZES = (3, 4, 5)
BUCKETS = 1 << 18
VOCABULARY = 20_000
CHARS, WORDS, HIDDEN, ATTEND = 8, 8, 12, 12
SAMPLE = (1000, 2000)  # toxic and other texts
#: Windows of all sampled texts together; only beyond them texts are thinned out, the longest first.
SAMPLE_WINDOWS = 30_000
#: A longer word is read as several, alike in training and scoring.
WORD_PIECE = 64
STEPS = 300
BATCH = 24  # texts of each kind
SEED = 7
START = 0.02
LEAN = 1.0
DROP = 0.2  # share of words left out of a step
CACHE = 200_000
_find = re.compile(rf"\w{{1,{WORD_PIECE}}}").findall


def words_of(text: str) -> list[str]:
    return _find(text.lower())


def windows_of(n: int) -> list[tuple[int, int]]:
    """Overlapping windows over ``n`` words, the last one ending with the text."""
    if n <= WINDOW:
        return [(0, n)]
    starts = [*range(0, n - WINDOW, STRIDE), n - WINDOW]
    return [(s, s + WINDOW) for s in starts]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclass
class Network:
    """Dense weights; inputs are (steps, windows, CHARS + WORDS) with a mask (steps, windows)."""

    w: dict[str, np.ndarray]

    @classmethod
    def fresh(cls, rng: np.random.Generator) -> Network:
        size, h = CHARS + WORDS, HIDDEN

        def normal(*shape: int) -> np.ndarray:
            return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

        w = {"A": normal(2 * h, ATTEND), "v": normal(ATTEND), "o": normal(2 * h), "c": np.zeros(1, np.float32)}
        for side in "fb":
            w |= {f"W{side}": normal(size, 3 * h), f"b{side}": np.zeros(3 * h, np.float32), f"U{side}": normal(h, 3 * h)}
        return cls(w)

    def states(self, gates: np.ndarray, mask: np.ndarray, side: str, keep: list | None = None) -> np.ndarray:
        """Hidden states of one direction; ``gates`` are the projected inputs (reset, update, new)."""
        h, u = HIDDEN, self.w[f"U{side}"]
        steps, n = mask.shape
        out = np.zeros((steps, n, h), dtype=np.float32)
        now = np.zeros((n, h), dtype=np.float32)
        for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
            back = now @ u
            rz = _sigmoid(gates[t, :, : 2 * h] + back[:, : 2 * h])
            r, z = rz[:, :h], rz[:, h:]
            new = np.tanh(gates[t, :, 2 * h :] + r * back[:, 2 * h :])
            after = (new + z * (now - new)) * mask[t][:, None]
            if keep is not None:
                keep.append((t, now, r, z, new, back[:, 2 * h :]))
            out[t] = now = after
        return out

    def pooled(self, states: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Attention weights, hidden attention layer, pooled states."""
        steps, n, width = states.shape
        a = np.tanh(states.reshape(-1, width) @ self.w["A"]).reshape(steps, n, -1)
        e = np.where(mask > 0, a @ self.w["v"], -1e9)
        e = np.exp(e - e.max(axis=0))
        weight = e / e.sum(axis=0)
        return weight, a, np.einsum("tn,tnh->nh", weight, states)

    def logits(self, gates: tuple[np.ndarray, np.ndarray], mask: np.ndarray) -> np.ndarray:
        both = np.concatenate([self.states(g, mask, s) for g, s in zip(gates, "fb")], axis=2)
        return self.pooled(both, mask)[2] @ self.w["o"] + self.w["c"][0]

    def gates(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return tuple(x @ self.w[f"W{s}"] + self.w[f"b{s}"] for s in "fb")

    def gradients(self, x: np.ndarray, mask: np.ndarray, label: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Gradients of the summed log loss for the weights and for ``x``."""
        h, kept = HIDDEN, {"f": [], "b": []}
        gates = self.gates(x)
        both = np.concatenate([self.states(g, mask, s, kept[s]) for g, s in zip(gates, "fb")], axis=2)
        weight, a, pool = self.pooled(both, mask)
        wrong = _sigmoid(pool @ self.w["o"] + self.w["c"][0]) - label
        d: dict[str, np.ndarray] = {"o": pool.T @ wrong, "c": wrong.sum(keepdims=True)}
        dpool = wrong[:, None] * self.w["o"]
        dweight = np.einsum("tnh,nh->tn", both, dpool)
        de = weight * (dweight - (weight * dweight).sum(axis=0))
        dinner = de[:, :, None] * self.w["v"] * (1 - a * a)
        d["v"] = np.einsum("tn,tna->a", de, a)
        d["A"] = np.einsum("tnh,tna->ha", both, dinner)
        dstates = weight[:, :, None] * dpool + dinner @ self.w["A"].T
        dx = np.zeros_like(x)
        for i, side in enumerate("fb"):
            u = self.w[f"U{side}"]
            dnow = np.zeros((x.shape[1], h), dtype=np.float32)
            dgates, du = np.zeros_like(gates[i]), np.zeros_like(u)
            for t, before, r, z, new, inner in reversed(kept[side]):
                dafter = (dnow + dstates[t, :, i * h : (i + 1) * h]) * mask[t][:, None]
                dnew = dafter * (1 - z) * (1 - new * new)
                dz = dafter * (before - new) * z * (1 - z)
                dr = dnew * inner * r * (1 - r)
                dgates[t] = np.concatenate([dr, dz, dnew], axis=1)
                dback = np.concatenate([dr, dz, dnew * r], axis=1)
                du += before.T @ dback
                dnow = dafter * z + dback @ u.T
            d[f"U{side}"], d[f"b{side}"] = du, dgates.sum(axis=(0, 1))
            d[f"W{side}"] = np.einsum("tni,tng->ig", x, dgates)
            dx += dgates @ self.w[f"W{side}"].T
        return d, dx


@dataclass
class Model:
    """The network with its vectors of characters' n-grams and of known words."""

    network: Network
    chars: np.ndarray
    words: np.ndarray
    known: dict[str, int]

    def inputs(self, words: list[str]) -> np.ndarray:
        total, count = summed(grams(words, SIZES, BUCKETS), self.chars, len(words))
        total /= np.sqrt(np.maximum(count, 1))[:, None].astype(np.float32)
        return np.hstack([total, self.words[[self.known.get(w, 0) for w in words]]])

    def rows(self, words: list[str]) -> np.ndarray:
        """Projected inputs of both directions; only they depend on the word alone."""
        return np.hstack(self.network.gates(self.inputs(words)))

    def scores(self, rows: np.ndarray, texts: list[np.ndarray], batch: int = 1024) -> list[np.ndarray]:
        """Scores of all windows of each text; ``texts`` hold row numbers."""
        places = [(i, a, b) for i, t in enumerate(texts) for a, b in windows_of(len(t))]
        out = np.empty(len(places), dtype=np.float64)
        order = sorted(range(len(places)), key=lambda j: places[j][2] - places[j][1])  # little padding
        for at in range(0, len(order), batch):
            some = order[at : at + batch]
            steps = max(1, max(places[j][2] - places[j][1] for j in some))
            number = np.zeros((len(some), steps), dtype=np.int64)
            mask = np.zeros((steps, len(some)), dtype=np.float32)
            for k, j in enumerate(some):
                i, a, b = places[j]
                number[k, : b - a] = texts[i][a:b]
                mask[: b - a, k] = 1
            gates = rows[number.T]
            half = gates.shape[2] // 2
            out[some] = _sigmoid(self.network.logits((gates[:, :, :half], gates[:, :, half:]), mask).astype(np.float64))
        found: list[list[float]] = [[] for _ in texts]
        for (i, _, _), s in zip(places, out):
            found[i].append(s)
        return [np.array(f) for f in found]


def fitting(sizes: np.ndarray, budget: int) -> int:
    """The largest number to which each of ``sizes`` can be cut so that they sum up to the budget."""
    low, high = 1, max(1, int(sizes.max(initial=1)))
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if np.minimum(sizes, middle).sum() <= budget else (low, middle - 1)
    return low


def sample_of(docs: DataFrame, labels: DataFrame, key: str, label: str, text: str, sizes: tuple[int, int]) -> tuple[pd.DataFrame, float]:
    """(label, windows) and the odds of label 1 over all labelled texts: at most ``sizes`` different texts of each label, those with the
    smallest hashes, with all their windows; if those are more than SAMPLE_WINDOWS, no text
    keeps more than a number with which they fit, spaced evenly over the whole text. A line
    is a window, its words stand between blanks. Only hashes meet the labels."""
    marks = docs.where(F.col(text).isNotNull()).select(key, F.xxhash64(text).alias("o"))
    known = labels.select(key, F.col(label).cast("int").alias("label")).where("label in (0, 1)")
    one = marks.join(known, key).groupBy("label", "o").agg(F.min(key).alias(key))
    toxic, other = (one.where(F.col("label") == y).orderBy("o").limit(n) for y, n in zip((1, 0), sizes))
    chosen = toxic.union(other)
    whole = docs.select(key, F.xxhash64(text).alias("o"), F.col(text).alias("text"))
    texts = (
        whole.join(F.broadcast(chosen.select(key, "label", "o")), [key, "o"])  # at most sum(sizes) rows
        .groupBy("label", "o").agg(F.first("text").alias("text"))
    )

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield pd.DataFrame({"n": [len(windows_of(len(words_of(t)))) for t in part["text"]]})

    texts = stage(texts, "sample")
    most = fitting(texts.select("text").mapInPandas(count, "n long").toPandas()["n"].to_numpy(), SAMPLE_WINDOWS)

    def cut(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = []
            for y, o, t in zip(part["label"], part["o"], part["text"]):
                words = words_of(t)
                places = windows_of(len(words))
                picked = {round(i) for i in np.linspace(0, len(places) - 1, min(len(places), most))}
                out.append((y, o, "\n".join(" ".join(words[slice(*places[i])]) for i in sorted(picked))))
            yield pd.DataFrame(out, columns=["label", "o", "windows"])

    found = texts.mapInPandas(cut, "label int, o long, windows string").toPandas()
    counts = {r["label"]: r["count"] for r in one.groupBy("label").count().collect()}
    odds = counts.get(1, 0) / max(1, counts.get(0, 0))
    return found.sort_values(["label", "o"], ignore_index=True), odds


def train(sample: pd.DataFrame, odds: float = 1.0, steps: int = STEPS, batch: int = BATCH, seed: int = SEED) -> Model | None:
    """A model from (label, windows); None if one of the labels has no text.

    ``odds`` is the number of toxic texts for every other one where the model will be used.

    Every step takes ``batch`` texts of each label, finds each text's worst window, and
    follows its gradient (Adam; Adagrad for the vectors). The number of steps is fixed, so
    the time does not depend on the corpus.
    """
    kinds = [np.flatnonzero(sample["label"].to_numpy() == y) for y in (1, 0)]
    if not all(map(len, kinds)):
        return None
    rng = np.random.default_rng(seed)
    spread = Counter()
    for windows in sample["windows"]:
        spread.update(set(windows.split()))
    listed = sorted(spread)
    number = {w: i + 1 for i, w in enumerate(listed)}
    encoded = [[np.array([number[w] for w in own.split()], np.int32) for own in windows.split("\n")] for windows in sample["windows"]]
    common = sorted((w for w in listed if spread[w] > 1), key=lambda w: (-spread[w], w))[:VOCABULARY]
    known = {w: i + 1 for i, w in enumerate(common)}
    flat = grams(listed, SIZES, BUCKETS)
    word = np.concatenate([f[1] for f in flat])
    ids = np.concatenate([f[0] for f in flat]).astype(np.int32)[np.argsort(word, kind="stable")]
    counts = np.bincount(word, minlength=len(listed))
    del flat, word, number, spread
    begin = np.concatenate([[0], np.cumsum(counts)])
    vocabulary = np.array([0, *(known.get(w, 0) for w in listed)])
    model = Model(
        Network.fresh(rng), (START * rng.standard_normal((BUCKETS, CHARS))).astype(np.float32),
        (START * rng.standard_normal((len(known) + 1, WORDS))).astype(np.float32), known,
    )
    # vectors start from how much more often toxic texts have the n-gram or word; those of
    # fewer than two texts say nothing
    label = sample["label"].to_numpy()
    held = [np.unique(np.concatenate(own)) for own in encoded]

    def lean(features: Callable[[np.ndarray], np.ndarray], size: int) -> tuple[np.ndarray, np.ndarray]:
        toxic, other = np.zeros(size), np.zeros(size)
        for seen, kind in ((toxic, kinds[0]), (other, kinds[1])):
            for i in kind:
                seen[np.unique(features(held[i]))] += 1
        both = toxic + other
        odds = np.log((toxic + 0.5) / (len(kinds[0]) + 1)) - np.log((other + 0.5) / (len(kinds[1]) + 1))
        return np.clip(odds * both / (both + 5), -3, 3).astype(np.float32), both > 1

    tilt, shared = lean(lambda own: np.concatenate([ids[:0], *(ids[begin[w - 1] : begin[w]] for w in own)]), BUCKETS)
    model.chars[:, 0] += LEAN * tilt
    model.chars[~shared] = 0
    tilt, _ = lean(lambda own: vocabulary[own], len(known) + 1)
    model.words[:, 0] += LEAN * tilt
    model.words[0] = 0
    momentum = {k: np.zeros_like(w) for k, w in model.network.w.items()}
    energy = {k: np.zeros_like(w) for k, w in model.network.w.items()}
    char_energy, word_energy = np.full(BUCKETS, 1e-6, np.float32), np.full(len(known) + 1, 1e-6, np.float32)

    def inputs(words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Vectors of numbered words, and their n-grams with the words they belong to."""
        w = words - 1
        n = counts[w]
        owner = np.repeat(np.arange(len(w)), n)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(begin[w], n)
        found = ids[place]
        total = np.zeros((len(w), CHARS), np.float32)
        if len(found):
            first = np.flatnonzero(np.diff(owner, prepend=-1))
            total[owner[first]] = np.add.reduceat(model.chars[found], first, axis=0)
        total /= np.sqrt(np.maximum(n, 1))[:, None].astype(np.float32)
        return np.hstack([total, model.words[vocabulary[words]]]), found, owner

    for step in range(1, steps + 1):
        picked = np.concatenate([rng.choice(k, batch) for k in kinds])
        windows = [(j, w) for j, i in enumerate(picked) for w in encoded[i]]
        length = max(1, max(len(w) for _, w in windows))
        numbers = np.zeros((length, len(windows)), np.int64)
        for k, (_, w) in enumerate(windows):
            numbers[: len(w), k] = w
        unique, where = np.unique(numbers, return_inverse=True)
        where = where.reshape(numbers.shape)
        real = unique > 0
        vectors = np.zeros((len(unique), CHARS + WORDS), np.float32)
        vectors[real], found, owner = inputs(unique[real])
        mask = (numbers > 0).astype(np.float32)
        left = (rng.random(numbers.shape) >= DROP).astype(np.float32)
        x = vectors[where] * left[:, :, None]
        logits = model.network.logits(model.network.gates(x), mask)
        text = np.array([j for j, _ in windows])
        order = np.lexsort((-logits, text))
        worst = order[np.flatnonzero(np.diff(text[order], prepend=-1))]
        d, dx = model.network.gradients(x[:, worst], mask[:, worst], label[picked].astype(np.float32))
        dx *= left[:, worst, None]
        dwords = np.zeros_like(vectors)
        np.add.at(dwords, where[:, worst].ravel(), dx.reshape(-1, dx.shape[2]))
        dwords = dwords[real] / len(picked)
        rate = 0.01 * min(1.0, 2 * (1 - (step - 1) / steps))
        for k, g in d.items():
            g = g / len(picked)
            momentum[k] = 0.9 * momentum[k] + 0.1 * g
            energy[k] = 0.99 * energy[k] + 0.01 * g * g
            model.network.w[k] = model.network.w[k] - rate * (momentum[k] / (1 - 0.9**step)) / (np.sqrt(energy[k] / (1 - 0.99**step)) + 1e-8)
        moved = np.flatnonzero(np.abs(dwords).sum(axis=1))
        touched = np.isin(owner, moved)
        grams_, owners = found[touched], owner[touched]
        share = dwords[owners, :CHARS] / np.sqrt(np.maximum(counts[unique[real] - 1][owners], 1))[:, None]
        rows_, back = np.unique(grams_, return_inverse=True)
        g = np.zeros((len(rows_), CHARS), np.float32)
        np.add.at(g, back, share)
        char_energy[rows_] += (g * g).mean(axis=1)
        model.chars[rows_] -= 0.1 * shared[rows_, None] * g / np.sqrt(char_energy[rows_])[:, None]
        in_vocabulary = vocabulary[unique[real]][moved]
        g = dwords[moved, CHARS:]
        word_energy[in_vocabulary] += (g * g).mean(axis=1)
        model.words[in_vocabulary] -= 0.1 * g / np.sqrt(word_energy[in_vocabulary])[:, None]
        model.words[0] = 0
    # batches hold as many toxic texts as others; scores are for texts as they are labelled
    model.network.w["c"] = model.network.w["c"] + np.float32(np.log(odds))
    return model


def fit(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "toxic", text: str = "text",
    sizes: tuple[int, int] = SAMPLE,
) -> Model | None:
    """A model from texts and their labels. Rows with a NULL key or text, or a label other than
    0 and 1, teach nothing; without texts of both labels there is no model.

    The driver sees at most SAMPLE_WINDOWS (or one for each text, if those are more) windows of
    WINDOW words of at most WORD_PIECE characters.
    """
    return train(*sample_of(docs, labels, key, label, text, sizes))


def score(docs: DataFrame, model: Model | None, text: str = "text", cache: int = CACHE) -> Column:
    """A column: struct<score, windows>, the score of the worst of all overlapping windows of
    the whole text (0 to 1) and their number.

    NULL texts are empty; a text without words is one empty window, scored by the output's
    bias alone. Without a model every score is 0. Repeated texts score alike.
    """
    # plain values, so that workers need no copy of this package: about 9 MB, whatever the corpus
    plain = None if model is None else (model.network.w, model.chars, model.words, model.known)
    held = docs.sparkSession.sparkContext.broadcast(plain)

    @F.pandas_udf("score double, windows int")
    def scored(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        plain = held.value
        known = None if plain is None else Model(Network(plain[0]), *plain[1:])
        rows = None if known is None else WordCache(known.rows, 6 * HIDDEN, cache)
        for part in parts:
            texts, found = part.tolist(), []
            for at in range(0, len(texts), 256):
                words = [words_of(t) for t in texts[at : at + 256]]
                if known is None:
                    found += [(0.0, len(windows_of(len(w)))) for w in words]
                else:
                    numbers = rows.numbers(words)
                    found += [(float(s.max()), len(s)) for s in known.scores(rows.rows, numbers)]
            yield pd.DataFrame(found, columns=["score", "windows"]).astype({"score": "float64", "windows": "int32"})

    return scored(F.coalesce(F.col(text), F.lit("")))
