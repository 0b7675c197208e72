"""Threshold-scaled document fingerprints (operator 11).

A fingerprint keeps the hash of every word shingle that falls below a fixed fraction of the hash
range.  Its size grows with the text, and whether a hash is kept depends on the shingle alone: the
fingerprint of several texts together is the union of theirs, and the share of a small text that a
very large one holds is estimated without bias from the hashes they have in common.

The hash is the first HASH_BYTES bytes of the shingle's MD5, so that other engines can compute it.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Callable, Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from tillcast.llm.arrow_rows import ROWS_PER_CALL, map_rows, to_batch
from tillcast.session import durable

WORDS = 3
HASH_BYTES = 6
#: First byte of a kept hash: below 32 of 256 keeps one shingle in eight.
KEPT_BELOW = 32


class Print:
    """The kept shingles of a text, with the places of their first words."""

    def __init__(self, text: str):
        self.text = text
        self.words = text.encode("utf-8", "surrogatepass").lower().split()
        self.places, self.hashes = [], []
        for at in range(max(1, len(self.words) - WORDS + 1)) if self.words else ():
            self.add(at)

    def add(self, at: int) -> None:
        h = hashlib.md5(b" ".join(self.words[at:at + WORDS])).digest()
        if h[0] < KEPT_BELOW:
            self.places.append(at)
            self.hashes.append(h[:HASH_BYTES])

    def kept(self) -> list[bytes]:
        return sorted(set(self.hashes))


def edited(own: Print, following: Print) -> Print:
    """``own`` with the last floor(n / 2) code points replaced by as many first ones of ``following``.

    Shingles that lie whole in a part taken over are taken over with it; only those at the seam and
    at the end are hashed."""
    half = len(own.text) // 2
    left, right = own.text[:len(own.text) - half], following.text[:half]
    out = Print("")
    out.text = left + right
    out.words = out.text.encode("utf-8", "surrogatepass").lower().split()
    # words that certainly stand as they are in own, from the start, and in following, up to the end
    same = max(0, len(left.encode("utf-8", "surrogatepass").split()) - 1)
    taken = len(right.encode("utf-8", "surrogatepass").split())
    shift = len(out.words) - taken
    count = max(1, len(out.words) - WORDS + 1) if out.words else 0
    from_own = min(count, max(0, same - WORDS + 1)) if len(own.words) >= WORDS else 0
    first, behind = shift + 1, shift + max(1, taken - WORDS)     # places whose shingles are following's
    if len(following.words) < WORDS or behind <= first or first < from_own:
        first = behind = count
    for at, h in zip(own.places, own.hashes):
        if at >= from_own:
            break
        out.places.append(at)
        out.hashes.append(h)
    for at in range(from_own, min(first, count)):
        out.add(at)
    for i in range(bisect_left(following.places, first - shift), bisect_left(following.places, behind - shift)):
        out.places.append(following.places[i] + shift)
        out.hashes.append(following.hashes[i])
    for at in range(max(from_own, behind), count):
        out.add(at)
    return out


def likeness(a: list[bytes], b: list[bytes], equal: bool) -> float:
    """Estimated share of the smaller one's shingles that the other holds.  A fingerprint without
    hashes tells nothing: 1 for equal texts, else 0."""
    if not a or not b:
        return float(equal)
    return len(set(a).intersection(b)) / min(len(a), len(b))


def _facts(own: Print, following: Print) -> dict:
    changed = edited(own, following)
    mine, theirs = own.kept(), changed.kept()
    return {"edited_sha256": hashlib.sha256(changed.text.encode("utf-8", "surrogatepass")).digest(), "edited": b"".join(theirs),
            "near_edited": likeness(mine, theirs, own.text == changed.text),
            "near_next": likeness(mine, following.kept(), own.text == following.text)}


FACTS = "edited_sha256 binary, edited binary, near_edited double, near_next double"
SEEN = f"part int, first boolean, last boolean, doc_id long, n_chars long, own binary, packed binary, {FACTS}"


def _packer() -> Callable:
    press = zstandard.ZstdCompressor(level=1)

    def pack(cols: dict) -> dict:
        return {"doc_id": cols["doc_id"], "tie": cols["tie"], "row": cols["row"],
                "packed": [press.compress(t.encode("utf-8", "surrogatepass")) for t in cols["text"].to_pylist()]}
    return pack


def _unpacked(packed: bytes) -> Print:
    return Print(zstandard.ZstdDecompressor().decompress(packed).decode("utf-8", "surrogatepass"))


def _along(batches: Iterator[pa.RecordBatch], arrow: pa.Schema) -> Iterator[pa.RecordBatch]:
    """One partition in order: each row meets the one after it.  The last one is left open, with its
    text, as is the text of the first, for the partition before."""
    part = TaskContext.get().partitionId()
    held, rows = None, []

    def row(doc_id, own, packed, first, last, facts):
        return {"part": part, "first": first, "last": last, "doc_id": doc_id, "n_chars": len(own.text), "own": b"".join(own.kept()),
                "packed": packed if first or last else None, **(facts or dict.fromkeys(("edited_sha256", "edited", "near_edited", "near_next")))}

    def flush():
        return to_batch({f.name: [r[f.name] for r in rows] for f in arrow}, arrow)

    first = True
    for batch in batches:
        for doc_id, packed in zip(batch.column(0).to_pylist(), batch.column(1)):
            own = _unpacked(packed.as_py())
            if held:
                rows.append(row(held[0], held[1], held[2].as_py() if first else None, first, False, _facts(held[1], own)))
                first = False
            held = (doc_id, own, packed)
            if len(rows) >= ROWS_PER_CALL:
                yield flush()
                rows.clear()
    if held:
        rows.append(row(held[0], held[1], held[2].as_py(), first, True, None))
        yield flush()


def _closer() -> Callable:
    def close(cols: dict) -> dict:
        made = [_facts(_unpacked(a), _unpacked(b)) for a, b in zip(cols["packed"].to_pylist(), cols["next_packed"].to_pylist())]
        return {"doc_id": cols["doc_id"], "n_chars": cols["n_chars"], "own": cols["own"], **{k: [m[k] for m in made] for k in
                                                                                         ("edited_sha256", "edited", "near_edited", "near_next")}}
    return close


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every
    document; the fingerprints are the kept hashes as hex digits, ascending.

    Documents follow each other by descending doc_id, those without one at the end, rows of one id by
    the digest of the text; the first follows the last.  Null texts are empty, empty texts have an
    empty fingerprint, a text of fewer than WORDS words is one shingle.  Repeated rows each give a row;
    one single document is its own next; an empty table gives no rows; other columns are not read.

    Texts cross one shuffle, packed, into ranges of that order; each task meets the rows of its range one
    by one.  What it found is written, so that only the rows at the borders, one a task, are joined
    to the first of the next range."""
    text = F.coalesce("text", F.lit(""))
    rows = map_rows(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.md5(text).alias("tie"),
                                F.monotonically_increasing_id().alias("row"), text.alias("text")),
                    _packer, "doc_id long, tie string, row long, packed binary")
    order = [F.col("doc_id").desc_nulls_last(), F.col("tie"), F.col("row")]
    struct = _parse_datatype_string(SEEN)
    arrow = to_arrow_schema(struct)
    seen = durable(rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "packed")
                   .mapInArrow(lambda batches: _along(batches, arrow), struct))
    firsts = seen.where("first").select("part", F.col("packed").alias("next_packed"))
    along = Window.orderBy("part")                      # one row a partition
    following = seen.where("first").select("part").select(
        "part", F.coalesce(F.lead("part").over(along), F.min("part").over(Window.partitionBy())).alias("next_part"))
    open_rows = (seen.where("last").join(following, "part")
                 .join(firsts.withColumnRenamed("part", "next_part"), "next_part")
                 .select("doc_id", "n_chars", "own", "packed", "next_packed"))
    closed = map_rows(open_rows, _closer, f"doc_id long, n_chars long, own binary, {FACTS}")
    whole = seen.where("not last").select(*closed.columns).unionByName(closed)

    def digits(c: str):
        return F.lower(F.hex(c))

    return whole.select("doc_id", "n_chars", digits("edited_sha256").alias("edited_sha256"), digits("own").alias("fingerprint"),
                        digits("edited").alias("edited_fingerprint"), "near_edited", "near_next")


def hash_rows(prints: DataFrame, by: list[str], column: str = "fingerprint") -> DataFrame:
    """(by, hash): the merged fingerprint of all texts of each group, a row per distinct hash.  The
    partial aggregation before the shuffle keeps a group's repeated hashes from travelling."""
    digits = f".{{{2 * HASH_BYTES}}}"
    return prints.select(*by, F.explode(F.regexp_extract_all(column, F.lit(digits), 0)).alias("hash")).distinct()


def containment(prints: DataFrame, merged: DataFrame, by: list[str], key: str = "doc_id") -> DataFrame:
    """(key, by, share): the estimated share of each text's shingles that each merged fingerprint of
    ``hash_rows(..., by)`` holds.  Groups that hold none of a text, and texts without a kept hash, give no row."""
    own = hash_rows(prints, [key])
    sizes = prints.select(key, (F.length("fingerprint") / (2 * HASH_BYTES)).alias("size")).distinct()
    return (own.join(merged, "hash").groupBy(key, *by).agg(F.count(F.lit(1)).alias("shared"))
            .join(sizes, key).select(key, *by, (F.col("shared") / F.col("size")).alias("share")))
