"""Threshold-scaled fingerprints against a plain computation over whole texts."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tillcast.llm.fingerprints import Print, containment, edited, fingerprints, hash_rows


def plain(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", text.encode().lower())
    grams = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    return sorted({h for g in grams if (h := hashlib.md5(g).hexdigest()[:12]) < "2"})


def brute(rows):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), hashlib.md5(r[1].encode()).hexdigest()))
    out = []
    for k, (i, t) in enumerate(rows):
        u = rows[(k + 1) % len(rows)][1]
        half = len(t) // 2
        e = t[:len(t) - half] + u[:half]

        def like(a, b, same):
            return float(same) if not a or not b else len(set(a) & set(b)) / min(len(a), len(b))
        out.append((str(i), len(t), hashlib.sha256(e.encode()).hexdigest(), "".join(plain(t)), "".join(plain(e)),
                    like(plain(t), plain(e), t == e), like(plain(t), plain(u), t == u)))
    return sorted(out)


def got(df):
    return sorted((str(r.doc_id), r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next) for r in df.collect())


def test_parts_taken_over_equal_the_whole_text_hashed_anew():
    rng = random.Random(3)
    for _ in range(3000):
        a, b = ("".join(rng.choice(["a", "B", "c", "é", " ", " ", "\n", "𝒳"]) for _ in range(rng.choice([0, 1, 3, 9, 30, 80]))) for _ in "ab")
        e = edited(Print(a), Print(b))
        assert [h.hex() for h in e.kept()] == plain(e.text)
        assert sorted(e.places) == e.places


def test_hostile_rows_and_many_partitions(spark, hostile, no_docs):
    want = brute([(r.doc_id, r.text) for r in hostile.collect()])
    for parts in (1, 7):
        assert got(fingerprints(hostile.repartition(parts))) == want
    assert fingerprints(no_docs).collect() == []
    one = fingerprints(hostile.where("doc_id = 7")).first()
    assert one.near_next == 1.0 and one.n_chars == hostile.where("doc_id = 7").first().n_chars


def test_order_holds_over_the_borders_of_tasks(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice("red blue green old new tin oak".split()) for _ in range(rng.randrange(40)))) for i in range(400)]
    rows += [(None, "no number at all")] * 30 + [(17, "same number")] * 30
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
    assert got(fingerprints(df)) == brute(rows)


def test_merged_fingerprints_estimate_containment(spark):
    rng = random.Random(8)
    texts = [" ".join(rng.choice("abcdefghijklmnopqrstuvwxyz") + str(rng.randrange(60)) for _ in range(3000)) for _ in range(6)]
    half = " ".join(texts[0].split()[:1500]) + " " + " ".join(texts[5].split()[:1500])
    docs = spark.createDataFrame([(i, t, "x" if i < 3 else "y") for i, t in enumerate(texts[:5])] + [(9, half, "z")],
                                 "doc_id long, text string, source string")
    prints = fingerprints(docs).join(docs.select("doc_id", "source"), "doc_id")
    merged = hash_rows(prints, ["source"])
    assert merged.where("source = 'x'").count() == len({h for t in texts[:3] for h in plain(t)})
    share = {(r.doc_id, r.source): r.share for r in containment(prints, merged, ["source"]).collect()}
    assert share[(0, "x")] == 1.0 and (0, "y") not in share
    assert share[(9, "x")] == pytest.approx(0.5, abs=0.1)


def test_equal_texts_have_equal_fingerprints(spark, hostile):
    f = fingerprints(hostile).groupBy("n_chars", "fingerprint").count()
    assert f.agg(F.sum("count")).first()[0] == hostile.count()
    assert fingerprints(hostile).where("doc_id in (1, 2)").select("fingerprint").distinct().count() == 1
