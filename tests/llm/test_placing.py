"""Mixing, sharding, license scan and nearest neighbours."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from tillcast.llm.licenses import all_templates, TEMPLATES, Template, band_count, license_hits, licenses_of, words_of
from tillcast.llm.mixing import in_mixed_order, mix_sources, period, phases
from tillcast.llm.neighbours import nearest
from tillcast.llm.queries import QUERIES
from tillcast.llm.ranks import ranked
from tillcast.llm.sharding import shard_documents, shared_lines, shards_touched

SF = "/root/testdata/sf0.01"


def test_period_deviates_by_less_than_a_block():
    rng = random.Random(4)
    for _ in range(60):
        parts = {f"s{i}": rng.randrange(1, 40) for i in range(rng.randrange(1, 12))}
        total, seen = sum(parts.values()), Counter()
        order = period(parts)
        for t, s in enumerate(order, 1):
            seen[s] += 1
            assert all(abs(seen[x] * total - parts[x] * t) < total for x in parts)
        assert seen == Counter(parts)


def test_phases_place_every_block_once_and_keep_proportions():
    rows, parts, size = {"a": 1000, "b": 95, "c": 8, "d": 330}, {"a": 5, "b": 3, "c": 1, "d": 2}, 10
    slots = {}
    plan = phases(rows, parts, size)
    for p in plan:
        for j in range(p["first"], p["end"]):
            k = j - p["first"]
            slots[p["base"] + k // p["c"] * p["total"] + p["places"][k % p["c"]]] = (p["src"], j)
    assert sorted(slots) == list(range(100 + 10 + 1 + 33))
    assert sorted(slots.values()) == sorted((s, j) for s, n in rows.items() for j in range(-(-n // size)))
    ends = sorted({p["base"] for p in plan} | {len(slots)})
    for lo, hi in zip(ends, ends[1:]):
        live = {p["src"]: p["c"] for p in plan if p["base"] == lo}
        seen, total = Counter(), sum(live.values())
        for t in range(lo, hi):
            seen[slots[t][0]] += 1
            assert all(abs(seen[s] * total - live[s] * (t - lo + 1)) < total for s in live)


def test_mix_query_places_every_document(spark):
    rows = QUERIES["op6_mix_sources"](spark, SF).collect()
    assert sorted(r.position for r in rows) == list(range(spark.read.parquet(f"{SF}/documents.parquet").count()))
    for s in {r.source for r in rows}:
        mine = sorted((r.position, r.doc_id) for r in rows if r.source == s)
        assert [d for _, d in mine] == sorted(d for _, d in mine)
    by = defaultdict(set)
    for r in rows:
        by[r.slot].add((r.source, r.block))
    assert all(len(x) == 1 for x in by.values()) and sorted(by) == list(range(len(by)))


def test_mix_edges_and_order(spark, hostile, no_docs):
    for how in ({}, {"weights": {"a": 1, None: 9}, "block_rows": 1}):
        rows = mix_sources(hostile, **how).collect()
        assert sorted(r.position for r in rows) == list(range(hostile.count()))
    out = in_mixed_order(hostile, block_rows=2)
    assert out.columns == hostile.columns and out.count() == hostile.count()
    assert mix_sources(no_docs).collect() == [] and in_mixed_order(no_docs).collect() == []
    big = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, "hot").otherwise("cold").alias("source"))
    got = [r.doc_id for r in in_mixed_order(big, weights={"hot": 1, "cold": 1}, block_rows=10).collect()]
    assert Counter(i % 3 > 0 for i in got[:1000])[True] == 500


def test_ranked_equals_a_window(spark):
    df = spark.range(2000).select((F.col("id") * 7919 % 2003).alias("x"), F.when(F.col("id") < 1500, "hot").alias("g"), (F.col("id") % 5).alias("w"))
    want, before = {}, defaultdict(lambda: [0, 0])
    for r in sorted(df.collect(), key=lambda r: r.x):
        n, s = before[r.g]
        want[r.x] = (n, s)
        before[r.g] = [n + 1, s + r.w]
    assert {r.x: (r._rank, r._before) for r in ranked(df, ["g"], ["x"], "w").collect()} == want


def law_holds(rows, shards, n):
    sizes = Counter(r.shard for r in rows)
    assert len(rows) == n and max(sizes.values()) - min(sizes.get(k, 0) for k in range(shards)) <= 1
    for k in range(shards):
        assert sorted(r.slot for r in rows if r.shard == k) == list(range(sizes.get(k, 0)))
    assert {r.law for r in rows} == {"rows"} and {r.grown_shard for r in rows} == {None}


def test_shard_query_balances_and_keeps_links_together(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = QUERIES["op5_balanced_sharding"](spark, SF)
    rows, texts = out.collect(), {r.doc_id: r.text for r in docs.collect()}
    law_holds(rows, 16, len(texts))
    groups = defaultdict(list)
    for r in rows:
        b = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(b) + 1, zlib.crc32(b))
        groups[texts[r.doc_id]].append(r.shard)
    assert sum(len(set(g)) > 1 for g in groups.values()) <= 3
    edges = shared_lines(docs)
    cell = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("cell"))
    mine = shards_touched(edges, out.join(cell, "doc_id")).first()[0]
    hashed = shards_touched(edges, cell.withColumn("shard", F.pmod("cell", F.lit(16)))).first()[0]
    assert mine < 0.5 * hashed


def test_shard_edges(spark, hostile, no_docs):
    law_holds(shard_documents(hostile).collect(), 16, hostile.count())
    law_holds(shard_documents(hostile, shards=3).collect(), 3, hostile.count())
    assert shard_documents(no_docs).collect() == []
    # one text in half of all rows: it has to be split, and the rest stays whole
    rows = [(i, "same text in many rows" if i % 2 else f"text {i // 6} of its own") for i in range(3000)]
    out = shard_documents(spark.createDataFrame(rows, "doc_id long, text string"), shards=10).collect()
    law_holds(out, 10, 3000)
    groups = defaultdict(set)
    for r in out:
        groups[r.text_crc32].add(r.shard)
    hot = zlib.crc32(b"same text in many rows")
    assert sum(len(g) > 1 for t, g in groups.items() if t != hot) <= 9 and len(groups[hot]) <= 9


def test_linked_pairs_meet_though_one_line_is_in_every_text(spark):
    everywhere = "this one footer stands at the end of every single text here"
    rows = [(i, f"text {i}\nthe line that only pair number {i // 2:06d} has in common\n{everywhere}") for i in range(4000)]
    out = shard_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    law_holds(out, 16, 4000)
    at = {r.doc_id: r.shard for r in out}
    apart = sum(at[i] != at[i + 1] for i in range(0, 4000, 2))
    print("pairs apart", apart)
    assert all(r.linked for r in out) and apart < 400


def test_licenses_equal_brute_force_windows(spark):
    rng = random.Random(6)
    docs = []
    for i in range(120):
        words = [f"w{rng.randrange(50)}" for _ in range(rng.randrange(0, 120))]
        name = rng.choice(sorted(TEMPLATES))
        t = TEMPLATES[name].split()
        for _ in range(rng.randrange(0, 4) if len(t) > 20 else 0):
            t[rng.randrange(len(t))] = "changed"
        at = rng.randrange(len(words) + 1)
        docs.append((i, " ".join(words[:at] + t + words[at:])))
    docs += [(200, None), (201, ""), (202, "no license here at all"), (None, TEMPLATES["MIT"]), (203, TEMPLATES["MIT"].upper().replace(" ", "\n"))]
    got = {(r.doc_id, r.template): r.containment for r in licenses_of(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    for i, text in docs:
        w = words_of(text or "")
        for name, t in TEMPLATES.items():
            tw = words_of(t)
            g = min(5, len(tw))
            want = {tuple(tw[k:k + g]) for k in range(len(tw) - g + 1)}
            span = len(tw)      # an occurrence as long as the template lies in some window
            best = max((len(want & {tuple(w[k:k + g]) for k in range(a, min(a + span, len(w)) - g + 1)}) / len(want)
                        for a in range(max(1, len(w) - span + 1))), default=0)
            if best >= 0.8:
                assert got.get((i, name), 0) >= best - 1e-9, (i, name)
            elif (i, name) in got:    # a longer window may hold more, never less than the whole text
                whole = len(want & {tuple(w[k:k + g]) for k in range(len(w) - g + 1)}) / len(want)
                assert got[i, name] <= whole + 1e-9 and whole >= 0.8


def test_common_licenses_are_found(spark):
    body = dict(all_templates())["GPL-2-whole"]
    docs = {1: "A page. Licensed under CC BY-ND 4.0. More of it.", 2: "some words before\n" + body + "\nand after",
            3: "# " + TEMPLATES["ISC"].replace(" this software ", " this\n# software "), 4: "GNU Affero is named here",
            5: TEMPLATES["Unlicense"], 6: TEMPLATES["EPL-2.0"], 7: TEMPLATES["AGPL-3.0-or-later-header"], 8: TEMPLATES["BSD-disclaimer"]}
    rows = licenses_of(spark.createDataFrame(list(docs.items()), "doc_id long, text string")).where("containment = 1").collect()
    got = {(r.doc_id, r.template) for r in rows}
    assert {(1, "CC-BY-ND-4.0-short"), (2, "GPL-2-whole"), (3, "ISC"), (5, "Unlicense"), (6, "EPL-2.0"),
            (7, "AGPL-3.0-or-later-header"), (8, "BSD-disclaimer")} <= got
    assert not any(i == 4 for i, _ in got)


def test_license_edges_and_bands(spark, hostile, no_docs):
    assert band_count(10, 10, 1.0) == 1
    for t, window in ((1, 8), (80, 130)):
        s = np.ceil(0.8 * t) / (window + t - np.ceil(0.8 * t))
        assert (1 - s) ** band_count(t, window, 0.8) <= 1e-4
    assert Template.of("x", "...", 5) is None
    hits = license_hits(hostile, [("miller", "the miller counts his sacks of grain"), ("none", ""), ("short", "lazy dog")])
    found = Counter((r.template, r.doc_id) for r in hits.collect())
    assert found["short", 1] >= 2 and found["short", 2] >= 1 and found["miller", 7] >= 4000
    assert license_hits(no_docs).collect() == [] and license_hits(hostile, []).collect() == []


def brute_nearest(rows, k=5):
    ok = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            ok.setdefault(i, []).append(np.array(v, float))
    out = {}
    for q in sorted(i for i in ok if i % 50 == 0):
        near = sorted((-max(float(a @ b / np.linalg.norm(a) / np.linalg.norm(b)) for a in ok[q] for b in ok[i]), i) for i in ok if i != q)
        out[q] = [(i, -s) for s, i in near[:k]]
    return out


def test_nearest_recall_and_exact_scores(spark):
    sf = "/root/testdata/sf0.1"
    got = defaultdict(dict)
    for r in QUERIES["op9_nearest_vectors"](spark, sf).collect():
        got[r.query_id][r.rank] = (r.vec_id, r.score)
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = brute_nearest(rows)
    assert set(got) == set(want)
    hits = [len({v for v, _ in got[q].values()} & {v for v, _ in want[q]}) / 5 for q in want]
    assert np.mean(hits) >= 0.9
    for q, near in got.items():
        scores = dict(want[q])
        assert sorted(near) == [1, 2, 3, 4, 5]
        assert all(abs(scores[v] - s) < 1e-12 for v, s in near.values() if v in scores)


def test_nearest_ties_copies_and_bad_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(0, 400, 2)]          # a copied vector with every query id
    rows += [(i, rng.normal(size=3).tolist()) for i in range(1, 400, 2)] + [(51, rows[0][1]), (51, rows[0][1])]
    rows += [(1000, None), (1050, [0.0, 0.0, 0.0]), (1100, [1.0, None, 2.0]), (1150, [1.0, float("nan"), 1.0]), (1200, [float("inf"), 1.0, 1.0]),
             (1250, [1.0, 2.0]), (None, [1.0, 2.0, 3.0]), (1300, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("h", F.lit("clash")).withColumn("v", F.lit(0))
    got = defaultdict(list)
    for r in nearest(df, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, round(r.score, 9)))
    want = {q: [(i, round(s, 9)) for i, s in near] for q, near in brute_nearest([r for r in rows if r[0] != 1250]).items()}
    assert got == want
    assert nearest(df.limit(0), F.col("vec_id") % 50 == 0).collect() == []
    few = nearest(df.where("vec_id in (0, 1, 1050)"), F.col("vec_id") % 50 == 0).collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in few] == [(0, 1, 1)]
