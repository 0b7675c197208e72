import random
from functools import cache

from tillcast.llm.decontaminate import (ERROR_RATE, WORD, benchmark_matches, contaminated, drop_contaminated, myers)

ITEMS = [(1, "Name the capital of the country whose river runs from the lake to the northern sea in spring."),
         (2, "What is the sum of the first ten odd numbers, and why?"), (3, "Yes."), (4, None), (5, "  ...  "),
         (1, "Name the capital of the country whose river runs from the lake to the northern sea in spring.")]


def frame(spark, rows, names="doc_id long, text string"):
    return spark.createDataFrame(rows, names)


def distance(pattern, text):
    """Smallest edit distance of ``pattern`` to any substring of ``text`` (plain recursion)."""
    @cache
    def d(i, j):
        if i == 0:
            return 0
        if j == 0:
            return i
        return min(d(i - 1, j - 1) + (pattern[i - 1] != text[j - 1]), d(i - 1, j) + 1, d(i, j - 1) + 1)
    return [d(len(pattern), j) for j in range(1, len(text) + 1)]


def test_myers_equals_dynamic_programming():
    rng = random.Random(2)
    for _ in range(300):
        p = tuple(rng.choice("abc") for _ in range(rng.randrange(1, 12)))
        t = [rng.choice("abcd") for _ in range(rng.randrange(0, 30))]
        k = rng.randrange(0, len(p) + 1)
        want = [(j + 1, d) for j, d in enumerate(distance(p, tuple(t))) if d <= k]
        assert myers(p, t, k) == want


def test_edited_items_are_found_iff_within_the_budget(spark):
    rng = random.Random(3)
    items = [(i, " ".join(f"i{i}w{rng.randrange(40)}" for _ in range(rng.randrange(7, 60)))) for i in range(20)]
    docs, want = [], set()
    for n in range(150):
        i, text = rng.choice(items)
        w = text.split()
        for _ in range(rng.randrange(0, 9)):
            at = rng.randrange(len(w))
            kind = rng.randrange(3)
            w[at:at + 1] = [["new"], [], [w[at], "more"]][kind]
        words = [f"x{rng.randrange(99)}" for _ in range(50)] + w + [f"y{rng.randrange(99)}" for _ in range(50)]
        docs.append((n, " ".join(words)))
        for j, t in items:
            p = tuple(t.split())
            if min(distance(p, tuple(words))) <= int(ERROR_RATE * len(p)):
                want.add((n, j))
    got = contaminated(frame(spark, docs), frame(spark, items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and 50 < len(want) < 150


def test_spans_case_and_punctuation(spark):
    text = "Intro words here.\nNAME the capital -- of the country, whose river runs from (the lake) to the northern sea in spring! The end."
    rows = benchmark_matches(frame(spark, [(7, text), (8, "Nothing of the kind.")]), frame(spark, ITEMS, "item_id long, text string")).collect()
    assert [(r.doc_id, r.item_id, r.distance) for r in rows] == [(7, 1, 0)]
    assert rows[0].passage == text[rows[0].start_char:rows[0].end_char]
    assert rows[0].passage.startswith("NAME") and rows[0].passage.endswith("spring")


def test_two_occurrences_are_two_rows(spark):
    item = ITEMS[1][1]
    text = f"{item} filler words between the two of them, quite a number of them in fact, so they are apart. {item}"
    docs, items = frame(spark, [(1, text)]), frame(spark, ITEMS, "item_id long, text string")
    assert benchmark_matches(docs, items).count() == 2
    assert contaminated(docs, items).collect()[0].occurrences == 2


def test_hostile_rows_and_empty_tables(spark, hostile, no_docs):
    items = frame(spark, ITEMS + [(6, "quick brown fox jumps over the lazy dog near"), (None, "counts his sacks of grain the river runs")],
                  "item_id long, text string")
    rows = benchmark_matches(hostile, items).collect()
    assert sorted((r.doc_id for r in rows if r.item_id == 6)) == [1, 1, 2]
    assert sum(r.item_id is None and r.doc_id == 7 for r in rows) == 3999
    left = drop_contaminated(hostile, items)
    assert left.columns == hostile.columns
    assert sorted(r.doc_id or 0 for r in left.select("doc_id").collect()) == [0, 0, 3, 4, 5, 6, 8, 9, 10]
    assert benchmark_matches(no_docs, items).collect() == []
    assert benchmark_matches(hostile, items.limit(0)).collect() == []
    assert WORD.findall("a-b_c é") == ["a", "b_c", "é"]
