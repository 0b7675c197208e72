"""Benchmark decontamination by pigeonhole edit matching (operator 1).

Texts and items are compared as word sequences (Unicode word characters, case-folded).  An
item of m words may differ by k = floor(error_rate * m) word edits.  Cut into k + 1 pieces, at
least one piece of any such occurrence is intact (pigeonhole), so every occurrence contains
an exact piece hit.  Each hit opens a window of the text in which Myers' bit-parallel
algorithm finds the smallest edit distance of the whole item; matches of at most k are real.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.llm.arrow_rows import keep_rows, map_rows
from tillcast.llm.graph import union_all
from tillcast.llm.shingles import WordHashes, gram_hashes

WORD = re.compile(r"\w+")
ERROR_RATE = 0.15
BLOCK_ITEMS = 5_000
BLOCK_CHARS = 8_000_000
SCHEMA = ("doc_id long, item_id long, distance int, budget int, item_words int, "
          "start_char int, end_char int, passage string")


@dataclass
class Item:
    item_id: int | None
    words: tuple
    budget: int


@dataclass
class Pieces:
    """The pieces of one block of items, by the hash of their first words."""
    items: list = field(default_factory=list)
    by_head: dict = field(default_factory=dict)   # head length -> {hash: [(item, offset, length)]}

    @staticmethod
    def of(rows: list, rate: float) -> Pieces:
        out, words = Pieces(), WordHashes()
        heads: dict = defaultdict(lambda: defaultdict(list))
        for item_id, text in rows:
            w = tuple(WORD.findall((text or "").casefold()))
            if not w:
                continue
            k = int(rate * len(w))
            at = len(out.items)
            out.items.append(Item(item_id, w, k))
            cuts = [len(w) * i // (k + 1) for i in range(k + 2)]
            for a, b in zip(cuts, cuts[1:]):
                head = min(4, b - a)
                h = gram_hashes(words.of([x.encode() for x in w[a:a + head]]), head)[0]
                heads[head][int(h)].append((at, a, b - a))
        out.by_head = {n: dict(x) for n, x in heads.items()}
        return out


def myers(pattern: tuple, text: list, budget: int) -> list[tuple[int, int]]:
    """(end, distance) for each end in ``text`` at which some substring is within ``budget``
    edits of ``pattern``; the vertical difference bits of a column are one integer."""
    m = len(pattern)
    where: dict = {}
    for i, w in enumerate(pattern):
        where[w] = where.get(w, 0) | (1 << i)
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score, hits = full, 0, m, []
    for j, w in enumerate(text):
        eq = where.get(w, 0)
        d = (((eq & plus) + plus) ^ plus) | eq | minus
        up, down = minus | (full & ~(d | plus)), d & plus
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up, down = (up << 1) & full, (down << 1) & full
        plus, minus = down | (full & ~(d | up)), d & up
        if score <= budget:
            hits.append((j + 1, score))
    return hits


def best_matches(item: Item, text: list, windows: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(start, end, distance) word spans of ``item`` in the merged ``windows``, one for each
    run of overlapping ends: the smallest distance, the earliest end of it."""
    out = []
    for lo, hi in windows:
        run: list = []
        for end, dist in [*myers(item.words, text[lo:hi], item.budget), (1 << 60, 0)]:
            if run and end - run[-1][0] > max(1, len(item.words) // 2):
                e, d = min(run, key=lambda x: (x[1], x[0]))
                tail = text[lo + max(0, e - len(item.words) - d):lo + e]
                back = myers(item.words[::-1], tail[::-1], d)
                out.append((lo + e - min(back, key=lambda x: (x[1], x[0]))[0], lo + e, d))
                run = []
            run.append((end, dist))
    return out


def merged(windows: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list = []
    for lo, hi in sorted(windows):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def find_items(text: str, pieces: Pieces, hashes: WordHashes, tables: dict) -> list[tuple]:
    """(item, first char, last char, distance) of every occurrence in the whole text."""
    w = WORD.findall(text.casefold())
    h = hashes.of(w)
    windows: dict = defaultdict(list)
    for head, known in pieces.by_head.items():
        g = gram_hashes(h, head)
        for pos in np.flatnonzero(tables[head][(g >> np.uint64(44)).astype(np.int64)]):
            for at, offset, length in known.get(int(g[pos]), ()):
                item = pieces.items[at]
                if tuple(w[pos:pos + length]) == item.words[offset:offset + length]:
                    first = int(pos) - offset
                    windows[at].append((max(0, first - item.budget),
                                        min(len(w), first + len(item.words) + item.budget)))
    if not windows:
        return []
    found = [(at, s) for at, spans in windows.items() for s in best_matches(pieces.items[at], w, merged(spans))]
    if not found:
        return []
    # casefold can change the length of a word but not, in general, the number of words
    spans = [x.span() for x in WORD.finditer(text)]
    same = len(spans) == len(w)
    return [(pieces.items[at], spans[a][0] if same else None, spans[b - 1][1] if same else None, d)
            for at, (a, b, d) in found]


def item_blocks(items: DataFrame) -> Iterator[list]:
    """The test items, in blocks of at most BLOCK_ITEMS items or BLOCK_CHARS characters (one
    longer item is a block of its own).  Only one block at a time is held and broadcast."""
    texts = items.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null").distinct()
    now, chars = [], 0
    for r in texts.orderBy("item_id", "text").toLocalIterator():
        if now and (len(now) >= BLOCK_ITEMS or chars + len(r[1]) > BLOCK_CHARS):
            yield now
            now, chars = [], 0
        now.append((r[0], r[1]))
        chars += len(r[1])
    if now:
        yield now


def benchmark_matches(docs: DataFrame, items: DataFrame, error_rate: float = ERROR_RATE) -> DataFrame:
    """Every occurrence of a test item in a document: doc_id, item_id, distance (word edits),
    budget, item_words, start_char, end_char and passage of the original text.

    The test items are the stated query set: they go to the tasks in blocks of bounded size,
    and each block reads the documents once; documents are never shuffled.

    Null or wordless texts and items match nothing.  Null ids are carried.  Repeated item rows
    count once, repeated documents each give their rows.  Items of one or two words have no
    error budget and match only exactly.  If case-folding changes the number of words, span
    and passage are null.  No rows on either side: no rows.  Other columns are ignored."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text is not null")
    parts = [_match_block(docs, spark.sparkContext.broadcast(Pieces.of(block, error_rate)))
             for block in item_blocks(items)]
    return union_all(parts) if parts else spark.createDataFrame([], SCHEMA)


def _finder(shared):
    """Per task: the function (text) -> occurrences of the block's items."""
    pieces, hashes = shared.value, WordHashes()
    tables = {}
    for head, known in pieces.by_head.items():
        tables[head] = t = np.zeros(1 << 20, bool)
        t[(np.fromiter(known, np.uint64) >> np.uint64(44)).astype(np.int64)] = True
    return lambda text: find_items(text, pieces, hashes, tables)


def _match_block(docs: DataFrame, shared) -> DataFrame:
    def make():
        find = _finder(shared)

        def fn(cols):
            ids, texts = cols["doc_id"].to_pylist(), cols["text"].to_pylist()
            out: dict = {k: [] for k in ("doc_id", "item_id", "distance", "budget", "item_words",
                                         "start_char", "end_char", "passage")}
            for i, t in zip(ids, texts):
                for item, a, b, d in find(t):
                    row = (i, item.item_id, d, item.budget, len(item.words), a, b, None if a is None else t[a:b])
                    for k, v in zip(out, row):
                        out[k].append(v)
            return out

        return fn

    return map_rows(docs, make, SCHEMA)


def contaminated(docs: DataFrame, items: DataFrame, error_rate: float = ERROR_RATE) -> DataFrame:
    """One row per document and item found in it: the closest occurrence and their number."""
    closest = F.min(F.struct("distance", "start_char", "end_char", "passage", "budget", "item_words"))
    return (benchmark_matches(docs, items, error_rate).groupBy("doc_id", "item_id")
            .agg(closest.alias("m"), F.count(F.lit(1)).alias("occurrences"))
            .select("doc_id", "item_id", "m.distance", "m.budget", "m.item_words", "occurrences",
                    "m.start_char", "m.end_char", "m.passage"))


def drop_contaminated(docs: DataFrame, items: DataFrame, error_rate: float = ERROR_RATE) -> DataFrame:
    """``docs``, all columns, without the rows whose text holds a test item.  Every row is judged by its own
    text, with or without a doc_id; null and empty texts stay.  The blocks of items pass over the
    documents one after the other, each over what the one before has left."""
    context = docs.sparkSession.sparkContext
    for block in item_blocks(items):
        docs = _without(docs, context.broadcast(Pieces.of(block, error_rate)))
    return docs


def _without(docs: DataFrame, shared) -> DataFrame:
    def make():
        find = _finder(shared)
        return lambda cols: [not (t and find(t)) for t in cols["text"].to_pylist()]

    return keep_rows(docs, make)
