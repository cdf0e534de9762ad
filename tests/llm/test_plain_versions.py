"""Whole results of operators against plain versions that share none of their code."""

import math
import os
import random
import re
import subprocess
import sys
import textwrap
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

from gustline.llm import language, mixing, order_minhash, packing, secrets, toxicity
from gustline.llm.common import WORD, running

MASK = (1 << 64) - 1


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def chained(*values):
    """Spark's xxhash64 of texts, whole numbers of eight bytes, and ("int", n) of four."""
    seed = 42
    for v in values:
        data = v.encode() if isinstance(v, str) else (v[1] & 0xFFFFFFFF).to_bytes(4, "little") if isinstance(v, tuple) else (v & MASK).to_bytes(8, "little")
        seed = xxhash.xxh64_intdigest(data, seed)
    return signed(seed)


# --- order MinHash ---------------------------------------------------------------------------


def plain_sketches(text):
    words = [w[i : i + 16] for w in re.findall(WORD, text) for i in range(0, len(w), 16)]
    if not words:
        return []
    hashes = [chained(w) for w in words]
    runs = [hashes[i : i + 3] for i in range(len(hashes) - 2)] or [hashes]
    place_mask = (1 << 26) - 1
    seen, marked = Counter(), []
    for at, run in enumerate(runs):
        kept = chained(*run) & ~place_mask
        number = seen[kept]
        seen[kept] += 1
        marked.append((chained(kept, ("int", number)) & ~place_mask, at))
    bins = defaultdict(list)
    for h, at in sorted(marked):
        bins[(h & MASK) >> 58].append((h, at))
    order = sorted(bins, key=lambda b: bins[b][0][0])
    out = []
    for i, b in enumerate(order):
        pair = bins[b][:2]
        if len(marked) > 1 and len(pair) == 1:
            pair = [pair[0], bins[order[(i + 1) % len(order)]][0]]
        value = chained(*(h for h, _ in sorted(pair, key=lambda x: x[1])))
        out.append((b << 32) | (value & 0xFFFFFFFF))
    return sorted(out)


def test_order_sketches_are_the_plain_ones(spark, docs):
    rng = random.Random(4)
    texts = [r["text"] or "" for r in docs.select("text").collect()]
    texts += [" ".join(rng.choices([*"abcdefgh", "longer" * 9, "é中"], k=n)) for n in (1, 2, 3, 4, 9, 40, 300, 2000)]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    found = {r["i"]: r["f"] for r in rows.select("i", order_minhash.fingerprint(F.col("t")).alias("f")).collect()}
    for i, text in enumerate(texts):
        assert found[i] == plain_sketches(text), text[:60]


# --- best-fit packing ----------------------------------------------------------------------------


def test_shards_are_packed_as_plain_best_fit_packs_them():
    rng = random.Random(6)
    for _ in range(25):
        n = rng.randrange(1, 120)
        pieces = pd.DataFrame({
            "words": [rng.choice([1, 2, 5, 9, 10, 19, 20, 30, 64]) for _ in range(n)],
            "cluster": [rng.choice([1, 2, 3, 100 + i]) for i in range(n)], "source_hash": [rng.randrange(6) for _ in range(n)],
            "piece": [0] * n, "copy": list(range(n)),
        })
        found = packing.pack_shard(pieces, 64).to_dict("records")
        groups = Counter(p["cluster"] for p in found)
        bins = []  # [room, when it got that room, sources, clusters, pieces]
        clock = 0
        for p in sorted(found, key=lambda p: (-p["words"], p["cluster"], p["piece"], p["copy"])):
            cluster = {p["cluster"]} if groups[p["cluster"]] > 1 else set()
            fits = [b for b in bins if b[0] >= p["words"] and p["source_hash"] not in b[2] and not cluster & b[3]]
            clock += 1
            if fits:
                best = min(fits, key=lambda b: b[:2])
            else:
                best = [64, 0, set(), set(), 0, len(bins)]
                bins.append(best)
            best[0], best[1] = best[0] - p["words"], clock
            best[2].add(p["source_hash"])
            best[3] |= cluster
            assert (p["bin"], p["position"]) == (best[5], best[4])
            best[4] += 1


def plain_bands(text):
    ids = [xxhash.xxh64_intdigest(w.encode()) for w in text.lower().split()]
    runs = []
    for i in range(max(1, len(ids) - 4)):
        x = 0
        for w in ids[i : i + 5]:
            x = (x * 0x100000001B3 & MASK) ^ w
        x = (x ^ x >> 29) * 0xBF58476D1CE4E5B9 & MASK
        runs.append((x ^ x >> 32) * 0x94D049BB133111EB & MASK)
    factors = [int(f) * 2 + 1 & MASK for f in np.random.default_rng(42).integers(0, 1 << 63, 120, dtype=np.uint64)]
    low = [min(f * r & MASK for r in runs) for f in factors]
    return [tuple(low[i : i + 6]) for i in range(0, 120, 6)]


def test_clusters_are_the_chains_of_shared_bands(spark, docs):
    rng = random.Random(8)
    base = [[rng.choice("abcdefgh") + str(rng.randrange(50)) for _ in range(60)] for _ in range(6)]
    texts = []
    for i in range(60):
        words = [*base[i % 6]]
        for _ in range(rng.randrange(4)):
            words[rng.randrange(60)] = "x"
        texts.append(" ".join(words))
    rows = [(i, t, f"s{i}") for i, t in enumerate(texts)] + [(1000 + i, r["text"], f"t{i}") for i, r in enumerate(docs.collect()) if (r["text"] or "").split()]
    group = list(range(len(rows)))
    owner = {}
    for i, (_, t, _) in enumerate(rows):
        for mark in [*enumerate(plain_bands(t)), "".join(re.findall(WORD, t.lower()))]:
            j = owner.setdefault(mark, i)
            if group[j] != group[i]:
                old = group[i]
                group = [group[j] if g == old else g for g in group]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    seen = {}
    keep = packing._pack
    try:
        packing._pack = lambda near, *more: seen.update(near=near) or keep(near, *more)
        packing.pack_apart(table)
    finally:
        packing._pack = keep
    clusters = {r["key"]: r["cluster"] for r in seen["near"].select("key", "cluster").collect()}
    pairs = [(i, j) for i in range(len(rows)) for j in range(i)]
    assert all((group[i] == group[j]) == (clusters[rows[i][0]] == clusters[rows[j][0]]) for i, j in pairs)
    assert 1 < len(set(group)) < len(rows) - 20


# --- mixing -------------------------------------------------------------------------------------


def plain_permuted(x, n, key, seed=17):
    for r in range(1, 21):
        other = (chained(("int", seed), ("int", r), *key) - x) % n
        if chained(("int", seed + 1), ("int", r), max(x, other), *key) % 2 == 0:
            x = other
    return x


def test_placements_are_the_plain_ones(spark, docs):
    rng = random.Random(3)
    rows = [(i, " ".join(["w"] * rng.randrange(300)), f"s{i % 5}") for i in range(80)] + [(7, "again and again " * 20, "s1")] * 2
    table = spark.createDataFrame(rows, "doc_id long, text string, source string").unionByName(docs.select("doc_id", "text", "source"))
    found = mixing.mix(table, per_shard=32).collect()
    order = defaultdict(list)
    for r in table.collect():
        # a NULL passes through the hash
        order[r["source"]].append((r["doc_id"] is not None, r["doc_id"] or 0, 42 if r["text"] is None else chained(r["text"]), len(re.findall(WORD, r["text"] or ""))))
    target = {r["source"]: r["target"] for r in found}
    names = sorted(order, key=lambda s: (s is None, s or ""))
    run, draws = 0, {}
    for number, s in enumerate(names):
        words = sum(size for *_, size in order[s])
        blocks = -(-words // 64)
        draws[s] = (run, math.floor(target[s] / max(1, words) * blocks + 0.5), blocks, number) if blocks else (run, 0, 0, number)
        run += draws[s][1]
    expected = []
    for s in names:
        first, n, blocks, number = draws[s]
        taken = defaultdict(list)
        for t in range(n):
            place = plain_permuted(first + t, run, ["slots"])
            taken[plain_permuted(t % blocks, blocks, [("int", number), t // blocks])].append((place // 32, place % 32, t // blocks))
        at = 0
        for known, i, h, size in sorted(order[s]):
            out = []
            for b in range(at // 64, -(-(at + size) // 64)) if size else ():
                a, z = max(0, b * 64 - at), min(size, (b + 1) * 64 - at)
                out += [(*slot, a, z - a) for slot in taken[b]]
            expected.append((i if known else None, s, size, sum(x[-1] for x in out), sorted(out)))
            at += size
    got = [(r["doc_id"], r["source"], r["size"], r["taken"], [tuple(p) for p in r["placements"] or []]) for r in found]
    assert sorted(map(str, got)) == sorted(map(str, expected))


# --- toxicity -----------------------------------------------------------------------------------


def plain_score(model, text):
    """The worst window's score, unit by unit."""
    w, h = {k: v.astype(float) for k, v in model.network.w.items()}, toxicity.HIDDEN
    words = re.findall(r"\w{1,64}", text.lower())
    size = toxicity.WINDOW
    starts = [*range(0, len(words) - size, toxicity.STRIDE), len(words) - size] if len(words) > size else [0]

    def vector(word):
        found = [ids for ids, _ in toxicity.grams([word], toxicity.SIZES, toxicity.BUCKETS)]
        rows = np.concatenate(found)
        chars = model.chars[rows].sum(axis=0) / math.sqrt(max(1, len(rows)))
        return [*map(float, chars), *map(float, model.words[model.known.get(word, 0)])]

    def one(window):
        xs = [np.array(vector(x)) for x in window]
        states = [[0.0] * (2 * h) for _ in xs]
        for side, order in ((0, range(len(xs))), (1, reversed(range(len(xs))))):
            s, now = "fb"[side], np.zeros(h)
            for t in order:
                into, back = xs[t] @ w[f"W{s}"] + w[f"b{s}"], now @ w[f"U{s}"]
                after = []
                for j in range(h):
                    r, z = (1 / (1 + math.exp(-(into[j + q * h] + back[j + q * h]))) for q in (0, 1))
                    new = math.tanh(into[j + 2 * h] + r * back[j + 2 * h])
                    after.append((1 - z) * new + z * now[j])
                now = np.array(after)
                states[t][side * h : (side + 1) * h] = after
        if not states:
            return 1 / (1 + math.exp(-float(w["c"][0])))
        energy = [sum(math.tanh(sum(s[i] * w["A"][i, j] for i in range(2 * h))) * w["v"][j] for j in range(toxicity.ATTEND)) for s in states]
        weight = [math.exp(e - max(energy)) for e in energy]
        pooled = [sum(a * s[i] for a, s in zip(weight, states)) / sum(weight) for i in range(2 * h)]
        return 1 / (1 + math.exp(-(sum(p * o for p, o in zip(pooled, w["o"])) + float(w["c"][0]))))

    return max(one(words[s : s + size]) for s in starts)


def test_scores_are_those_of_a_plain_forward_pass(spark, docs):
    rng = random.Random(1)
    words = ["".join(rng.choices("abcdefg", k=rng.randint(2, 6))) for _ in range(80)]
    texts = [" ".join(rng.choices(words, k=rng.choice([3, 30, 120])) + (["zork"] if i % 3 == 0 else [])) for i in range(90)]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = toxicity.fit(table, spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(90)], "doc_id long, toxic int"))
    clashing = docs.select("text", *(F.lit("x").alias(c) for c in ("score", "windows", "found", "label", "o")))
    more = spark.createDataFrame([(t,) for t in (*texts[:12], texts[0], "w" * 150 + " zork " + "é" * 70)], "text string")
    asked = clashing.unionByName(more, allowMissingColumns=True)
    scored = asked.select("text", toxicity.score(asked, model).alias("own")).collect()
    for r in scored:
        assert r["own"]["score"] == pytest.approx(plain_score(model, r["text"] or ""), abs=2e-4)


def test_windows_are_thinned_out_only_beyond_the_budget(spark, monkeypatch):
    assert toxicity.fitting(np.array([5, 1, 9]), 15) == 9 and toxicity.fitting(np.array([5, 1, 9]), 14) == 8
    assert toxicity.fitting(np.array([5, 1, 9]), 7) == 3 and toxicity.fitting(np.array([5, 1, 9]), 0) == 1 and toxicity.fitting(np.array([], int), 3) == 1
    rows = [(0, " ".join(f"a{i}" for i in range(2000))), (1, " ".join(f"b{i}" for i in range(100))), (2, "c")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(0, 1), (1, 0), (2, 0)], "doc_id long, toxic int")

    def words():
        sample, _ = toxicity.sample_of(table, labels, "doc_id", "toxic", "text", (5, 5))
        return {w for t in sample["windows"] for w in t.split()}

    assert words() == {w for _, t in rows for w in t.split()}
    monkeypatch.setattr(toxicity, "SAMPLE_WINDOWS", 8)
    assert {"a0", "a1999", "c"} | {f"b{i}" for i in range(100)} <= words() < {w for _, t in rows for w in t.split()}


# --- languages, secrets, helpers ---------------------------------------------------------------------


def test_numerals_are_no_letters(spark):
    en, fr = "the house and the garden ", "la maison et le jardin "
    known = spark.createDataFrame([(lang, t * 4) for lang, t in (("en", en), ("fr", fr))], "lang string, text string")
    model = language.learn(known)
    texts = ["½ ² ①", "Ⅷ", "١٢٣ ४", "𝟘 ㊿", "_-_", None, "²the", "ªº the", en * 30_000 + fr, en, en]
    asked = spark.createDataFrame([(t, "l", "s", 1) for t in texts], "text string, lang string, spans string, found int").coalesce(2)
    found = [r["x"] for r in asked.select(language.identify(asked, model).alias("x")).collect()]
    assert [x["lang"] for x in found] == ["und"] * 6 + ["en"] * 5 and all(x["spans"] == [] and x["score"] == 0 for x in found[:6])
    assert found[9] == found[10] and found[8]["spans"][0]["lang"] == "en" and found[8]["spans"][-1]["end"] >= len(en) * 30_000 - 1
    assert [s["start"] for s in found[6]["spans"]] == [1]


def test_long_runs_and_many_matches_are_scanned_alike(spark):
    rng = random.Random(2)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    run = "".join(rng.choices(letters, k=20_000))
    text = "é" + run[:9000] + " " + "token=abc" + str(10**6) + " 😀 " * 700 + ("secret: x12345 " * 3000) + run
    rows = spark.createDataFrame([(1, text), (2, "plain")], "doc_id long, text string")
    base = list(re.finditer(r"(?i)(?:token|secret)[:=]\x20?[a-z0-9]+", text))
    (scanned,) = (r["spans"] for r in secrets.scan(rows).where("doc_id = 1").collect())
    spans = [(s["start"], s["end"], s["kind"]) for s in scanned]
    assert [(m.start(), m.end()) for m in base] == [s[:2] for s in spans if s[2] == "assign"]
    long = [s for s in spans if s[2] == "entropy_base64"]
    assert [s[0] < 60 and s[1] > 8940 for s in long[:1]] == [True] and long[-1][1] > len(text) - 60
    covered, at = [], 0
    for a, b, _ in spans:
        if a >= at:
            covered.append(text[at:a] + "[SECRET]")
        at = max(at, b)
    (masked,) = (r["text"] for r in secrets.mask(rows).where("doc_id = 1").collect())
    assert masked == "".join(covered) + text[at:]


def test_running_sums_and_maxima(spark):
    rows = [(0, []), (1, [3]), (2, [5, 0, 2, 9, 1, 9, 4])]
    table = spark.createDataFrame(rows, "i int, x array<int>")
    plus, most = (running(F.col("x"), lambda x: x, f, block=3) for f in (lambda a, b: a + b, lambda a, b: F.greatest(a, b)))
    for r in table.select("i", plus.alias("s"), most.alias("m")).collect():
        own = rows[r["i"]][1]
        assert [(p["item"], p["before"]) for p in r["s"]] == [(x, sum(own[:k])) for k, x in enumerate(own)]
        assert [p["before"] for p in r["m"]] == [max(own[:k], default=0) for k in range(len(own))]


def test_workers_need_no_copy_of_the_package(tmp_path):
    """The learned models reach workers that cannot import this package."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    script = textwrap.dedent(f"""
        import sys
        sys.path.insert(0, {root!r})  # the driver's path only
        from gustline.llm import language, toxicity
        from gustline.session import local_session
        from pyspark.sql import functions as F
        spark = local_session(2)
        table = spark.createDataFrame([(i, ("the house zork " if i % 2 else "la maison ") * 9, "en" if i % 2 else "fr") for i in range(20)], "doc_id long, text string, lang string")
        found = table.select("lang", language.identify(table, language.learn(table))["lang"].alias("own")).where("lang = own").count()
        model = toxicity.fit(table, table.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic")))
        scored = table.select(toxicity.score(table, model)["score"].alias("s")).where("s > 0").count()
        try:
            spark.range(1).rdd.map(lambda _: __import__("gustline")).collect()
            print("workers have the package")
        except Exception:
            print("found", found, scored)
    """)
    (tmp_path / "outside.py").write_text(script)
    clean = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "outside.py"], cwd=tmp_path, env=clean, capture_output=True, text=True, timeout=240)
    assert "found 20 20" in out.stdout, out.stdout + out.stderr[-2000:]
