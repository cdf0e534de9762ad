"""Periodic runs, exact copies and prefix tries, against plain versions of their rules."""

from collections import Counter, defaultdict
import hashlib
import random
import re
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from gustline.llm import exact, periodic, prefix_trie, queries
from gustline.llm.common import WORD


def plain_runs(words):
    """(start, end, period) of all maximal runs of three periods, by trying every period."""
    found = {}
    for q in range(1, len(words) // 3 + 1):
        at = 0
        while at + q < len(words):
            start = at
            while at + q < len(words) and words[at] == words[at + q]:
                at += 1
            if at - start >= 2 * q:
                found.setdefault((start, at + q), q)
            at += 1
    return sorted((a, b, q) for (a, b), q in found.items())


def odd_sequence(rng):
    n = rng.choice([0, 1, 5, 30, 100, 300, 600])
    words = [rng.randrange(rng.choice([1, 2, 2, 3, 5, 50])) for _ in range(n)]
    for _ in range(rng.randrange(4) if n > 6 else 0):
        a = rng.randrange(n - 3)
        p = 1 + rng.randrange(max(1, (n - a) // 3))
        for i in range(a, min(n, a + 3 * p + rng.randrange(n - a))):
            words[i] = words[a + (i - a) % p]
        if rng.random() < 0.5:
            words[rng.randrange(n)] = 99
    return words


def fibonacci(n):
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def test_runs_are_those_of_every_period():
    rng = random.Random(11)
    for turn in range(150):
        texts = [odd_sequence(rng) for _ in range(rng.randrange(1, 6))]
        if turn % 30 == 0:
            texts += [fibonacci(500), (fibonacci(21) * 3 + [5]) * 4, [1] * 300, ([1] * 40 + [2]) * 8]
        texts.sort(key=len, reverse=True)
        words = np.array([w for i, t in enumerate(texts) for w in [*t, -1 - i]], np.int64)
        expected, at = [], 0
        for t in texts:
            expected += [[a + at, b + at, q] for a, b, q in plain_runs(t)]
            at += len(t) + 1
        assert periodic.find_runs(words, np.array([len(t) for t in texts])).tolist() == expected


def plain_digest(doc_id, text):
    words = re.findall(WORD, text or "")
    n, h = len(words), None if doc_id is None else crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = [r for r in plain_runs(words) if r[1] - r[0] >= 24]
    lost = {i for a, b, q in runs for i in range(a + q, b)}
    best = min(runs, key=lambda r: (-(r[1] - r[0]) / r[2], r[0], r[2]), default=None)
    lines = "".join(f"{a},{b - a},{q}\n" for a, b, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in lost)
    four = (None,) * 4 if best is None else (best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2])
    return (doc_id, len(runs), *four, *(hashlib.sha256(x.encode()).hexdigest() for x in (lines, kept)))


def test_run_digests_are_plain_ones(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, " ".join(map(str, odd_sequence(rng))), 1, "r") for i in range(300)]
    planted = [i for i in range(3000) if crc32(str(i).encode()) % 10 == 0][:60]
    rows += [(i, " ".join(str(rng.randrange(60)) for _ in range(rng.randrange(200))), 1, "r") for i in planted]
    rows += [(None, "a b " * 30, 1, "r"), (None, None, 1, "r"), (7000, "", 1, "r"), (7001, " \t\n", 1, "r")]
    rows += [(7002, "  x x   x x  " * 20, 1, "r")] * 2
    rows += [(7003, " ".join(str(i % 9_000) for i in range(40_000)), 1, "r")]
    spark.createDataFrame(rows, "doc_id long, text string, runs int, found string").write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op11_periodic_runs(spark, str(tmp_path)).collect()
    small = [r for r in rows if r[0] != 7003]
    assert Counter(tuple(r) for r in found if r["doc_id"] != 7003) == Counter(plain_digest(*r[:2]) for r in small)
    (long,) = (r for r in found if r["doc_id"] == 7003)
    assert tuple(long)[1:6] == (1, 0, 40_000, 9_000, 4444)


def test_runs_of_no_rows(empty):
    assert empty.select(periodic.periodic_runs(F.col("text"))).count() == 0


def test_golomb_codes_come_back():
    rng = np.random.default_rng(4)
    for n, top in [(0, 9), (1, 1), (1, 2**48), (40, 41), (500, 2**20), (5000, 2**48)]:
        least = int(rng.integers(0, 100))
        values = np.unique(rng.integers(0, top, n)) + least
        code = exact.encode(values, least)
        assert np.array_equal(exact.decode(code, least), values)
    assert len(exact.encode(np.unique(rng.integers(0, 2**48, 10_000)), 0)) < 10_000 * 5  # of 6 bytes each


def plain_copies(rows):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(lower)].append(i)
    out = Counter()
    for body, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        digest = hashlib.sha256(body.encode()).hexdigest()
        out[(keep, keep, len(ids), True, digest)] += 1
        for i in ids:
            out[(i, keep, len(ids), False, digest)] += 1
        out[(keep, keep, len(ids), False, digest)] -= 1
    return +out


@pytest.mark.parametrize("bits, part_rows", [(48, 16_384), (6, 3), (48, 7)])
def test_copies_are_those_of_equal_bytes(spark, docs, bits, part_rows):
    rng = random.Random(bits + part_rows)
    rows = [(i, rng.choice(["Hot TEXT", "hot text", f"Only {i}", f"pair {i // 2} É", "İ K K", "x" * 300_000])) for i in range(400)]
    more = spark.createDataFrame(rows + [(None, "hot text"), (5, "Hot TEXT"), (399, "hot text"), (399, "hot text")], "doc_id long, text string")
    given = docs.select("doc_id", "text").union(more)
    wide = given.withColumns({c: F.lit("x") for c in ("part", "class", "print", "body", "size", "owner")}).repartition(6)
    found = exact.exact_duplicates(wide, bits=bits, part_rows=part_rows)
    assert Counter(map(tuple, found.collect())) == plain_copies([tuple(r) for r in given.collect()])


def test_copies_of_no_rows(spark, empty):
    assert exact.exact_duplicates(empty).count() == 0
    assert not [t for t in spark.catalog.listTables() if "parts" in t.name]


def test_closes_are_those_of_a_stack():
    rng = random.Random(9)
    for n in (1, 3, 70, 3000):
        bits, stack, close, depth = [1], [0], {}, 1
        while len(close) < n or depth:
            if len(close) + depth < n and rng.random() < rng.choice([0.3, 0.6, 0.95]) or not depth:
                stack.append(len(bits))
                bits.append(1)
                depth += 1
            else:
                close[stack.pop()] = len(bits)
                bits.append(0)
                depth -= 1
        trie = prefix_trie.Parentheses(np.array(bits, np.uint8))
        assert dict(zip(trie.opens.tolist(), trie.find_close().tolist())) == close


def plain_trie(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(turns)] for c, turns in own.items()}
    built = {}
    for c, turns in own.items():
        h = crc32(str(c).encode()) % 6
        built[c] = tuple(own.get(c - c % 100, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, path in built.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    out = set()
    for path, convs in members.items():
        below = [p for p in members if p[: len(path)] == path]
        children = Counter(p[:-1] for p in below if p)
        saved = sum((len(members[p]) - 1) * len(p[-1][1]) for p in below if p)
        ends = ",".join(map(str, sorted(c for c in convs if built[c] == path)))
        out.add((
            min(convs), len(path), min(members[path[:-1]]) if path else None, len(convs), children[path],
            sum(p not in children for p in below), saved, hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return out


@pytest.fixture(scope="module")
def talks(spark):
    rng = random.Random(2)
    rows = [(None, 1, "user", "lost"), (3, None, None, None), (3, None, "user", ""), (250, 1, "a", "x" * 70_000)]
    for c in [*range(0, 260), 1000, 1003, 7777]:
        same = rng.random() < 0.4  # a conversation that very many share
        for t in range(4 if same else rng.randrange(1, 9)):
            text = f"é{t}" if same or rng.random() < 0.6 else rng.choice(["hello", "", None, f"own {c}"])
            rows.append((c, t, rng.choice(["user", "user", None]) if not same else "user", text))
    rows += [(2600 + c, t, "user", "deep") for c in range(3) for t in range(300 - c)]
    return rows, spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, n int, path string")


@pytest.mark.parametrize("shard_bytes", [400, 1 << 20])
def test_trie_is_the_plain_one(talks, shard_bytes):
    rows, table = talks
    trie = prefix_trie.prefix_trie(prefix_trie.rebuilt(prefix_trie.paths_of(table.repartition(5))), shard_bytes)
    found = [tuple(r) for r in trie.collect()]
    assert len(found) == len(set(found)) and set(found) == plain_trie(rows)


def test_trie_of_no_conversations(talks):
    assert prefix_trie.prefix_trie(prefix_trie.rebuilt(prefix_trie.paths_of(talks[1].limit(0)))).count() == 0
