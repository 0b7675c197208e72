"""The filter audit against every document sent through every order."""

import re
from collections import Counter, defaultdict
from itertools import permutations

from tillcast.llm.filter_audit import filter_audit, orders, removal_intervals


def brute(docs, labels):
    good, toxic = defaultdict(int), defaultdict(int)
    for i, q, t in labels:
        if i is not None:
            good[i] |= q == 1
            toxic[i] |= t == 1
    least = {}
    for i, text, _ in docs:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    rows = []
    for i, text, source in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {f for f, bad in (("A", len(words) < 200), ("B", 100 * len(set(words)) < 50 * len(words)),
                                  ("C", 100 * len(re.findall("[A-Z]", text)) > 2 * len(text)), ("D", re.search(r"[#$%&*|]", text)),
                                  ("E", i is not None and i > least[text])) if bad}
        rows.append((source or "", fails, good[i] if i is not None else 0, toxic[i] if i is not None else 0))
    out = {}
    shapley = Counter()
    for part in {r[0] for r in rows}:
        for order in map("".join, permutations("ABCDE")):
            left = [r for r in rows if r[0] == part]
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                shapley[part, f] += len(gone)
                mine = [r for r in rows if r[0] == part]
                out[part, order, step] = [len(left), len(gone), sum(f in r[1] for r in mine) - len(gone), sum(r[1] == {f} for r in mine),
                                          sum(r[2] for r in gone), sum(r[3] for r in gone)]
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def got(df):
    rows = df.collect()
    out = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in rows}
    assert len(out) == len(rows)
    return out


def test_intervals_hold_every_order_of_a_mask_once():
    for mask in range(1, 32):
        seen = Counter()
        for m, step, lo, hi in removal_intervals():
            if m == mask:
                seen.update(range(lo, hi))
                for order in orders()[lo:hi]:
                    assert next(k for k, f in enumerate(order, 1) if mask >> "ABCDE".index(f) & 1) == step
        assert seen == Counter(range(120))


def test_against_every_document_in_every_order(spark, hostile, no_docs):
    long = " ".join(f"word{i}" for i in range(300))
    extra = [(20, long, "a"), (21, long, "a"), (21, long, "a"), (None, long, "a"), (None, long, None), (22, long + " $5", "b"),
             (23, "same " * 400, "b"), (24, "SAME " * 400, ""), (25, long, "c"), (26, long.upper() + " #", "c")]
    docs = [(r.doc_id, r.text, r.source) for r in hostile.collect()] + extra
    labels = [(1, 1, 0), (2, 0, 1), (7, 1, 1), (21, 1, None), (21, None, 1), (None, 1, 1), (25, 1, 0), (99, 1, 1), (24, None, None)]
    df = hostile.select("doc_id", "text", "source").unionByName(spark.createDataFrame(extra, "doc_id long, text string, source string"))
    for name in ("part", "mask", "good", "toxic", "salt", "n", "step", "rank"):
        df = df.selectExpr("*", f"'clash' AS {name}")
    said = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert got(filter_audit(df.repartition(6), said)) == brute(docs, labels)
    assert filter_audit(no_docs, said).collect() == []
    assert got(filter_audit(df, said.limit(0))) == brute(docs, [])


def test_a_hot_text_and_rows_without_id(spark):
    docs = [(i, "copy", "abc"[i % 3]) for i in range(300)] + [(None, "copy", "a")] * 200 + [(0, "copy", "b")] * 3 + [(i, f"one {i}", "a") for i in range(300, 320)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(8)
    said = spark.createDataFrame([(i, i % 2, 0) for i in range(0, 320, 3)], "doc_id long, quality int, toxic int")
    assert got(filter_audit(df, said)) == brute(docs, [(i, i % 2, 0) for i in range(0, 320, 3)])
