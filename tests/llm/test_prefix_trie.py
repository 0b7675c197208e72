"""The trie of rebuilt conversations against one built node by node."""

import hashlib
import random
import zlib
from collections import defaultdict

from tillcast.llm.prefix_trie import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, conv string, block string, weight string, depth string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash", "clash", "clash") for r in rows], SCHEMA)


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            text = text or ""
            own[c].append(((turn is not None, turn or 0, role or "", hashlib.md5(text.encode()).hexdigest()), (role or "", text)))
    own = {c: [x for _, x in sorted(v)] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            members[tuple(built[c][:d])].append(c)
    children, out = defaultdict(list), []
    for p in members:
        if p:
            children[p[:-1]].append(p)
    below = {}
    for p in sorted(members, key=len, reverse=True):
        saved = (len(members[p]) - 1) * len(p[-1][1]) if p else 0
        below[p] = (sum(below[c][0] for c in children[p]) or 1, saved + sum(below[c][1] for c in children[p]))
    for p, ms in members.items():
        ends = ",".join(str(c) for c in ms if len(built[c]) == len(p))
        out.append((ms[0], len(p), members[p[:-1]][0] if p else None, len(ms), len(children[p]), *below[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()), key=str)


def test_random_conversations_with_every_kind_of_row(spark):
    rng = random.Random(2)
    rows = []
    for c in [0, 1, 2, 3, 4, 5, 99, 100, 101, 102, 150, 205, 206, 207, 208, 209, 312, 313]:      # 200 and 300 are absent
        for t in range(rng.choice([1, 2, 3, 5, 8, 9, 17, 33])):
            rows.append((c, t, rng.choice(["user", "assistant", None]), rng.choice(["yes", "no", "", None, "a longer turn", "𝒳é"])))
    rows += [(1, None, "user", "null turn"), (1, 2, "user", "tie"), (1, 2, "user", "tie"), (1, 2, "assistant", "tie"), (None, 1, "user", "nobody")]
    rng.shuffle(rows)
    assert got(prefix_trie(frame(spark, rows).repartition(5))) == brute(rows)


def test_empty_table_and_turnless_conversations(spark):
    assert prefix_trie(frame(spark, [(1, 0, "user", "x")]).limit(0)).collect() == []
    assert prefix_trie(frame(spark, [(None, 0, "user", "x")])).collect() == []
    rows = [(c, 0, "user", "x") for c in range(501, 520)]          # no first conversation, one turn: most lose it
    assert got(prefix_trie(frame(spark, rows))) == brute(rows)


def test_long_conversations_and_many_equal_ones(spark):
    long = [(400, t, "user", f"turn {t}") for t in range(90)]
    long += [(c, t, "user", f"turn {t}" if t != 60 + c % 3 else "other") for c in (403, 404, 405, 406) for t in range(70 + c % 7)]
    equal = [(c, t, "assistant", f"copy {t}") for c in range(10_000, 10_300) for t in range(3)]
    assert got(prefix_trie(frame(spark, long + equal).repartition(6))) == brute(long + equal)


def test_cells_of_long_conversations_do_not_change_the_result(spark, monkeypatch):
    from tillcast.llm import prefix_trie as module
    rng = random.Random(9)
    rows = [(c, t, "user", f"t{t // 12 * rng.randrange(2)}") for c in (700, 701, 702, 705) for t in range(60)]
    monkeypatch.setattr(module, "STRIDE", 7)
    monkeypatch.setattr(module, "SPAN", 2)
    monkeypatch.setattr(module, "PIECE", 2)
    assert got(prefix_trie(frame(spark, rows))) == brute(rows)
