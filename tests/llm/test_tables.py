"""Operators over whole tables, against plain versions of the rules."""

from base64 import b32encode
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gustline.llm import components, mixing, packing, simhash, topk, warc
from gustline.llm.queries import QUERIES
from gustline.session import stage, staged_path


def near_texts(n):
    rng = random.Random(n)
    base = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(400)]
    texts = []
    for i in range(n):
        words = [*base]
        if i % 3:
            words[rng.randrange(400)] = "other"
        if i % 7 == 0:
            words = rng.choices(base, k=30)
        texts.append(" ".join(words))
    return texts


def test_near_duplicates_by_brute_force(spark, docs, empty):
    more = spark.createDataFrame([(100 + i, t) for i, t in enumerate(near_texts(150))], "doc_id long, text string")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").union(more).collect()]
    table = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit(1)).withColumn("root", F.lit(2))
    prints = [simhash.fingerprint_of((t or "").encode()) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                a, b = group[i], group[j]
                group = [b if g == a else g for g in group]
    smallest = {g: min((rows[i][0] for i in range(len(rows)) if group[i] == g and rows[i][0] is not None), default=None) for g in group}
    expected = sorted(((i, f"{p:016x}", smallest[g]) for (i, _), p, g in zip(rows, prints, group)), key=str)
    found = simhash.near_duplicates(table).select("doc_id", "fingerprint", "component_id").collect()
    assert sorted(map(tuple, found), key=str) == expected
    kept = simhash.drop_near_duplicates(table)
    assert kept.count() == len(set(group)) and kept.columns == table.columns
    assert {r["doc_id"] for r in kept.collect()} == {s for s in smallest.values()}
    assert simhash.near_duplicates(empty).count() == 0 and simhash.drop_near_duplicates(empty).count() == 0


def test_fingerprint_rule():
    import xxhash

    words = "The Cat sat on the mat É the cat sat".split()
    lowered = ["".join(c.lower() if c.isascii() else c for c in w) for w in words]
    hashes = [xxhash.xxh64_intdigest(" ".join(lowered[i : i + 3]), 42) for i in range(len(words) - 2)]
    bits = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert simhash.fingerprint_of("\n The Cat\tsat on the mat É the  cat sat ".encode()) == bits
    assert simhash.fingerprint_of(None) == 0 and simhash.fingerprint_of(b"Ab") == xxhash.xxh64_intdigest("ab", 42)


def test_large_cells_lose_no_link():
    rng = np.random.default_rng(1)
    center = int(rng.integers(0, 1 << 62))
    fp = np.unique([center ^ sum(1 << int(b) for b in rng.integers(0, 40, rng.integers(0, 4))) for _ in range(1500)]).astype(np.uint64)
    left, right = simhash._links(np.zeros(len(fp), np.int64), fp, np.ones(len(fp), bool), 3)
    assert len(left) < len(fp)
    forest = simhash._Forest(len(fp))
    where = {int(x): i for i, x in enumerate(fp)}
    forest.add(np.array([where[int(x)] for x in left]), np.array([where[int(x)] for x in right]))
    for i in range(len(fp)):
        for j in np.flatnonzero(np.bitwise_count(fp ^ fp[i]) <= 3):
            assert forest.root(i) == forest.root(int(j))


def test_cells_in_blocks_give_the_same_groups(spark):
    rng = np.random.default_rng(2)
    fp = {5 ^ sum(1 << int(b) for b in rng.integers(0, 40, rng.integers(0, 5))) for _ in range(600)}
    table = spark.createDataFrame([(x,) for x in fp], "fp long")

    def groups(cell_rows):
        links = simhash.near_links(table, 3, cell_rows)
        return sorted(map(tuple, components.connected_components(links).collect()))

    whole = groups(1 << 15)
    assert whole and groups(7) == whole


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 140)] + [(7, 7), (3, 2), (3, 2)]
    random.Random(0).shuffle(edges)
    found = components.connected_components(spark.createDataFrame(edges, "a long, b long"))
    assert sorted(map(tuple, found.collect())) == [(i, 0) for i in range(61)] + [(i, 100) for i in range(100, 140)]
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_archive_round_trip(spark):
    big = "".join(str(i) for i in range(3_200_000))  # above 16 MiB
    rows = [(3, "u", "x"), (1, "a b\nc", "x"), (1, "u", "x"), (2, None, None), (5, "u", ""), (None, "u", "y"), (None, "u", "y"), (None, "u", "x"), (9, "é", big)]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, body int")
    path = staged_path(spark, "warc-test")
    warc.write_archive(pages, path)
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    expected = []
    for i, _, h in rows:
        body = (h or "").encode()
        again = first.get(h or "", i) != i
        expected.append((i, len(body), b32encode(hashlib.sha1(body).digest()).decode(), "revisit" if again else "response", first[h or ""] if again else None))
    for size in ("128m", "97b"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size if size != "97b" else "40000b")
        found = warc.page_rows(warc.read_archive(spark, path)).collect()
        assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "128m")
    blocks = warc.read_archive(spark, path, with_block=True).where("record_type = 'response' and payload_bytes = 1").collect()
    assert {bytes(b["block"]).partition(b"\r\n\r\n")[2] for b in blocks} == {b"x", b"y"}


def test_small_tables_make_few_archives(spark, tmp_path):
    pages = spark.range(300).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), (F.col("id") % 200).cast("string").alias("html"))
    settings = {"spark.sql.shuffle.partitions": "41", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    path = str(tmp_path / "archives")
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        warc.write_archive(pages, path)
        found = warc.page_rows(warc.read_archive(spark, path))
        assert found.count() == 300 and found.where("record_type = 'revisit' and refers_to = page_id - 200").count() == 100
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert 1 <= len(list((tmp_path / "archives").glob("part-*"))) <= spark.sparkContext.defaultParallelism


def test_magic_inside_members(spark, tmp_path):
    body = [b"%d" % i + b"A" * (i % 50) + b"\x1f\x8b\x08" * (i % 4) + b"\x1f\x8b\x08\x00" + b"B" * 40 for i in range(40)]
    with open(tmp_path / "x.warc", "wb") as f:
        for i, b in enumerate(body):
            f.write(warc.member_of(warc.record_of(f"urn:x-page:{i}", "u", b, None), 0))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "397b")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    found = warc.read_archive(spark, str(tmp_path), with_block=True).select("record_id", "payload_digest").collect()
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted((r[0], r[1]) for r in found) == sorted((f"urn:x-page:{i}", warc.digest_of(b)) for i, b in enumerate(body))


def test_damaged_archives_raise(spark, tmp_path):
    member = warc.member_of(warc.record_of("urn:x-page:1", "u", b"x" * 500, None))
    for name, data in (("cut", member[:-9]), ("none", b"hello")):
        (tmp_path / name).mkdir()
        (tmp_path / name / "x.warc").write_bytes(data)
        with pytest.raises(Exception, match="inside a member|start with"):
            warc.read_archive(spark, str(tmp_path / name)).count()


def test_packing_rules(spark, docs, empty):
    rng = random.Random(4)
    rows = [(i, " ".join(["w" + str(i // 2)] * rng.choice([1, 5, 17, 30, 64, 65, 200])), "hot" if i % 3 else f"s{i % 11}") for i in range(400)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string").unionByName(docs.select("doc_id", "text", "source"))
    packed = packing.pack(table, capacity=64, shard_rows=100)
    found = packed.collect()
    bins, words = {}, {}
    for r in found:
        words[(r["doc_id"], r["text_hash"], r["copy"])] = words.get((r["doc_id"], r["text_hash"], r["copy"]), 0) + r["words"]
        if r["words"]:
            bins.setdefault(r["bin_id"], []).append(r)
        else:
            assert r["bin_id"] is None
    assert len(words) == table.count()
    assert sum(words.values()) == sum(len((r["text"] or "").split()) for r in table.collect())
    for members in bins.values():
        assert sum(r["words"] for r in members) <= 64
        assert len({r["source"] for r in members}) == len(members)
        assert sorted(r["position"] for r in members) == list(range(len(members)))
    assert packing.pack(empty).count() == 0
    texts = packing.with_text(table, packed, capacity=64).where("words > 0").collect()
    assert all(len(r["text"].split()) == r["words"] for r in texts)


def test_best_fit_takes_the_tightest_compatible_bin():
    bins = packing._Bins(10)
    assert [bins.place(w, 1 << s, c) for w, s, c in ((7, 0, 0), (6, 1, 0), (5, 2, 1))] == [(0, 0), (1, 0), (2, 0)]
    assert bins.place(3, 3, 0)[0] == 2  # source 0 and 1 as one mask: both tighter bins clash
    assert bins.place(3, 1 << 2, 0)[0] == 0  # exact fit
    assert bins.place(2, 1 << 4, 1)[0] == 1  # bin 2 is tighter but holds the cluster


def test_mix_meets_targets(spark, docs, empty):
    rng = random.Random(8)
    rows = [(i, " ".join(["w"] * rng.randint(0, 400)), "hot" if i % 3 == 0 else f"s{i % 7}") for i in range(600)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string").unionByName(docs.select("doc_id", "text", "source"))
    found = mixing.mix(table, per_shard=256).collect()
    assert len(found) == table.count() and all(r["taken"] <= 2 * r["size"] for r in found)
    names = sorted({r["source"] for r in found}, key=lambda s: (s is None, s or ""))
    size = {s: sum(r["size"] for r in found if r["source"] == s) for s in names}
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    full, total = set(), 1.5 * sum(size.values())
    while True:  # fill and reshare until none is above twice its size
        level = (total - sum(2 * size[s] for s in full)) / sum(weight[s] for s in names if s not in full)
        above = {s for s in names if s not in full and weight[s] * level > 2 * size[s]}
        if not above:
            break
        full |= above
    for s in names:
        own = [r for r in found if r["source"] == s]
        target = 2 * size[s] if s in full else weight[s] * level
        assert {round(r["target"], 6) for r in own} == {round(float(target), 6)} and {r["source_size"] for r in own} == {size[s]}
        assert abs(sum(r["taken"] for r in own) - target) <= 3 * mixing.BLOCK
    used = {(p["shard"], p["slot"]): r["source"] for r in found for p in r["placements"] or []}
    counts = [sum(s == "hot" for (shard, _), s in used.items() if shard == n) for n in range(max(used)[0])]
    share = sum(s == "hot" for s in used.values()) / len(used)
    spread = np.mean([(c - 256 * share) ** 2 for c in counts]) / (256 * share * (1 - share))
    assert len(counts) > 8 and 0.2 < spread < 3  # shards' counts vary as draws do
    assert all(sum(p["words"] for p in r["placements"] or []) == r["taken"] for r in found) and used
    again = mixing.mix(table.repartition(7), per_shard=256).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))
    assert mixing.mix(empty).count() == 0


@pytest.mark.parametrize("n", [1, 2, 7, 64, 1000])
def test_permutations(spark, n):
    for key in (1, 2):
        out = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(key)).alias("p")).collect()
        assert sorted(r["p"] for r in out) == list(range(n))


def test_top_k_by_brute_force(spark):
    rng = np.random.default_rng(3)
    vectors = [(i, rng.normal(0, 1, 16).round(1).tolist()) for i in range(300)]
    vectors += [(0, [0.5] * 16), (20, None), (40, [float("nan")] * 16), (60, [None] * 16), (80, [float("inf")] * 16), (None, [1.0] * 16)]
    vectors += [(1000, [1.0, 2.0]), (1001, [2.0, 1.0]), (1020, []), (1040, [1e30] * 16), (1041, [1e30] * 16)]
    table = spark.createDataFrame([(*v, 1) for v in vectors], "vec_id long, embedding array<double>, block int")
    found = topk.top_k(table, F.col("vec_id") % 20 == 0, k=7, query_block=4, candidate_block=16, query_group=8, lanes=3).collect()
    good = [
        (i, [int(np.floor(64 * x)) for x in v]) for i, v in vectors
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    expected = []
    for i, q in good:
        if i % 20 == 0:
            scores = sorted(
                (-min(max(sum(a * b for a, b in zip(q, c)), -(1 << 63)), (1 << 63) - 1), j) for j, c in good if j != i and len(c) == len(q)
            )
            expected += [(i, r, j, -s) for r, (s, j) in enumerate(scores[:7], 1)]
    assert sorted(map(tuple, found)) == sorted(expected)
    assert topk.top_k(table.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_bounds_hold():
    rng = np.random.default_rng(5)
    q, c = (topk._Block(np.arange(50), rng.normal(0, 9, (50, 64)).round()) for _ in range(2))
    exact = q.vectors @ c.vectors.T
    for coarse, fine in zip(q.levels, c.levels):
        assert (coarse @ fine.T + 1e-6 >= exact).all()


def test_envelopes_bound_blocks():
    rng = np.random.default_rng(6)
    for width in (0, 1, 3, 16, 50):
        for _ in range(20):
            centre = rng.normal(0, 40, (2, width))
            q, c = (topk._Block(np.arange(30), (m + rng.normal(0, 6, (30, width))).round()) for m in centre)
            best = (q.vectors @ c.vectors.T).max()
            boxes = q.envelope()[None]
            assert topk._reachable(boxes, np.array([best]), c.envelope(), width)
            bound = (np.abs(boxes).max(initial=0) + 1) * (np.abs(c.envelope()).max(initial=0) + 1) * (width + 1)
            assert not topk._reachable(boxes, np.array([bound * 2]), c.envelope(), width)


def test_blocks_that_cannot_matter_are_not_shipped(spark):
    rng = np.random.default_rng(8)
    centres = rng.normal(0, 1, (12, 32))
    of = rng.integers(0, 12, 1200)
    vectors = [(i, (centres[c] + rng.normal(0, 0.02, 32)).tolist()) for i, c in enumerate(of.tolist())]
    vectors += [(i, centres[0].tolist()) for i in range(1200, 1800)]  # a third are copies of one vector
    table = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").withColumn("row", F.col("vec_id"))
    rows = table.select(F.col("vec_id").alias("id"), F.col("embedding").alias("x"), "row")
    queries = stage(topk._packed_queries(rows.where("id % 2 = 0"), 8, 16, 64.0, 5), "queries")
    candidates = stage(topk._packed_candidates(rows, 16, 64.0), "candidates")
    pairs = topk.reachable_blocks(queries, candidates, 2)
    groups = queries.select("group").distinct().count()
    assert 0 < pairs.count() < 0.5 * groups * candidates.count()
    found = topk.top_k(table, F.col("vec_id") % 5 == 0, k=5, query_block=16, candidate_block=16, query_group=30, lanes=2).collect()
    x = np.floor(64 * np.array([v for _, v in vectors]))
    expected = []
    for i in range(0, len(x), 5):
        scores = sorted((-int(s), j) for j, s in enumerate(x @ x[i]) if j != i)
        expected += [(i, r, j, -s) for r, (s, j) in enumerate(scores[:5], 1)]
    assert sorted(map(tuple, found)) == sorted(expected)


def test_pipeline_stages(spark, tmp_path):
    rng = random.Random(6)
    vocabulary = {lang: ["".join(rng.choices(letters, k=rng.randint(2, 8))) for _ in range(300)] for lang, letters in (("en", "theandro"), ("fr", "leouixqu"))}
    rows = []
    for i in range(120):
        lang = ("en", "fr")[i % 2]
        rows.append((i, " ".join(rng.choices(vocabulary[lang], k=rng.randint(20, 300))), lang, f"s{i % 3}", 1))
    rows += [(200, rows[4][1], "en", "s0", 1), (201, rows[4][1], "en", "s1", 1), (202, None, "en", "s0", 1), (203, "123 !", None, None, 1), (204, "", "fr", "s0", 1)]
    rows.append((205, rows[9][1] + " token = 24be64439e3e49cf46b2d7c90f3602a3d0b907ff end", None, None, 1))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int").write.parquet(str(tmp_path / "documents.parquet"))
    docs, kept = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    for _, step in corpus_pipeline.STAGES[:4]:
        columns = docs.columns
        docs = spark.createDataFrame(step(spark, docs, str(tmp_path)).collect(), docs.schema)
        assert docs.columns == columns
        kept.append({r["doc_id"]: r for r in docs.collect()})
    assert {202, 203, 204}.isdisjoint(kept[0]) and len(kept[0]) == 123 and kept[0][205]["lang"] == "fr"
    assert {200, 201}.isdisjoint(kept[1]) and set(range(120)) - set(kept[1]) <= {9}
    masked = [r for r in kept[2].values() if "[SECRET]" in r["text"]]
    assert len(kept[2]) == len(kept[1]) and all("24be64439e" not in r["text"] and r["n_chars"] == len(r["text"]) for r in masked)
    final = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in final} == set(kept[3]) and all(r["bin_id"] is not None for r in final)
    none = tmp_path / "none"
    spark.createDataFrame([], docs.schema).write.parquet(str(none / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(none)).count() == 0


def test_pipeline_takes_the_words_of_the_mix(spark, docs):
    rng = random.Random(11)
    rows = [(0, " ".join(f"w{i}" for i in range(6000)), "long")]  # one text holds most of its source
    rows += [(i, " ".join(f"v{i}_{j}" for j in range(rng.randint(1, 300))), ("long", "s1", "s2")[i % 3]) for i in range(1, 90)]
    rows += [(500, "twice or more " * 40, "s1")] * 3 + [(None, "no number " * 50, None)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({"lang": F.lit("en"), "n_chars": F.lit(0)})
    found = corpus_pipeline.mix_sources(spark, table, "").collect()
    mixed = mixing.mix(table).collect()
    whole = {(r["doc_id"], r["source"]): r["text"].split() for r in table.collect()}
    for source in {r["source"] for r in mixed}:
        own = [r for r in mixed if r["source"] == source]
        words = sum(len(r["text"].split()) for r in found if r["source"] == source)
        assert words == sum(r["taken"] for r in own) and abs(words - own[0]["target"]) <= 2 * mixing.BLOCK
    for r in found:
        own, place = whole[(r["doc_id"], r["source"])], -1
        assert r["n_chars"] == len(r["text"])
        if r["doc_id"] in range(90):
            for w in r["text"].split():  # each word at most once, in text order
                at = own.index(w)
                assert at > place
                place = at


def test_near_copies_never_share_a_bin(spark, tmp_path, docs, empty):
    rng = random.Random(13)
    base = [["".join(rng.choices("abcdefgh", k=5)) for _ in range(150)] for _ in range(20)]
    rows = []
    for i in range(200):
        words = [*base[i % 20]]
        words[rng.randrange(150)] = "other"  # one word differs
        rows.append((i, " ".join(words), f"s{i // 20}"))
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    table.unionByName(docs.select("doc_id", "text", "source")).write.parquet(str(tmp_path / "documents.parquet"))
    group = {i: i % 20 for i in range(200)}
    packed = QUERIES["op5_best_fit_packing"](spark, str(tmp_path)).collect()
    assert len(packed) == 200 + docs.count() + 1  # one text of over 2048 words has a second piece
    bins = {}
    for r in packed:
        if r["bin_id"] is not None and r["doc_id"] in group and r["source"] in {s for _, _, s in rows} and r["words"] == 150:
            bins.setdefault(r["bin_id"], []).append(group[r["doc_id"]])
    assert all(len(set(b)) == len(b) for b in bins.values()) and max(map(len, bins.values())) > 1
    assert packing.pack_apart(empty).count() == 0
    spaced = spark.createDataFrame([(1, "é a b c d", "x"), (2, "É ab cd", "y"), (3, "other words", "z")], "doc_id long, text string, source string")
    own = {r["doc_id"]: r["bin_id"] for r in packing.pack_apart(spaced).collect()}
    assert own[1] != own[2] and own[3] in (own[1], own[2])
