import random
from collections import defaultdict

from tillcast.llm.graph import components
from tillcast.llm.near_dedup import near_duplicates


def brute(docs, size, percent):
    """doc_id -> (set size, smallest reachable id), by comparing all pairs."""
    sets = {}
    for i, t in docs:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k:k + size]) for k in range(len(w) - size + 1)} or ({tuple(w)} if w else set())
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in sets:
        for j in sets:
            if i < j and sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                    a, b = sorted((root(i), root(j)))
                    up[b] = a
    return {i: (len(s), root(i)) for i, s in sets.items()}


def check(spark, docs, size=4, percent=80):
    got = near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), size, percent).collect()
    want = brute(docs, size, percent)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got) and len(got) == len(docs)


def edited(words, rng, edits):
    w = list(words)
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"edit{rng.randrange(10**6)}"
    return w


def test_near_copies_of_all_degrees_match_all_pairs(spark):
    rng = random.Random(5)
    docs, n = [], 0
    for _ in range(12):
        base = [f"w{rng.randrange(500)}" for _ in range(rng.randrange(5, 90))]
        for _ in range(rng.randrange(1, 14)):
            docs.append((n, " ".join(edited(base, rng, rng.randrange(0, 5)))))
            n += 1
    rng.shuffle(docs)
    check(spark, docs)
    check(spark, docs, size=5)


def test_a_chain_is_one_class_though_its_ends_are_not_linked(spark):
    base = [f"c{i}" for i in range(100)]
    docs = [(i, " ".join([f"z{k}" for k in range(2 * i)] + base[2 * i:])) for i in range(20)]
    check(spark, docs)
    assert brute(docs, 4, 80)[19][1] == 0


def test_texts_that_only_share_a_passage_stay(spark):
    rng = random.Random(1)
    passage = " ".join(f"p{i}" for i in range(60))
    docs = [(i, passage + " " + " ".join(f"q{rng.randrange(10**6)}" for _ in range(rng.randrange(30, 200)))) for i in range(40)]
    check(spark, docs)


def test_threshold_is_inclusive_and_case_and_spaces_do_not_count(spark):
    a = " ".join(f"w{i}" for i in range(12))                    # 9 shingles
    docs = [(5, a), (3, a.upper().replace(" ", " \n\t")), (4, a + " x"), (9, "one two"), (8, "ONE  two"), (7, "one two three")]
    check(spark, docs)
    check(spark, docs, percent=90)
    check(spark, docs, percent=91)


def test_hostile_rows(spark, hostile, no_docs):
    rows = near_duplicates(hostile).collect()
    assert len(rows) == hostile.count()
    by = defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
    assert [r.component_id for r in by[1]] == [1, 1] and by[2][0].component_id == 1 and not by[2][0].kept
    for i in (3, 4, 5):
        assert by[i][0].n_shingles == 0 and by[i][0].component_id == i and by[i][0].kept
    assert all(r.component_id is None and r.kept for r in by[None])
    assert by[8][0].component_id == 8
    assert near_duplicates(no_docs).collect() == []


def test_one_id_with_two_texts_joins_their_classes(spark):
    a, b = " ".join(f"a{i}" for i in range(9)), " ".join(f"b{i}" for i in range(9))
    got = near_duplicates(spark.createDataFrame([(1, a), (2, a), (2, b), (3, b)], "doc_id long, text string")).collect()
    assert {r.component_id for r in got} == {1}


def test_components_of_a_long_chain(spark):
    links = [(i, i + 1) for i in range(200)] + [(1000, 1001), (1001, 1000), (5, 5)]
    got = {r.v: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(201)}, 1000: 1000, 1001: 1000}
