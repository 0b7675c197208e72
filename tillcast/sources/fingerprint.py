"""Source fingerprint (A9): line count and digests of a text source.

The reference hashes the lines of a file in order (sha256 over the stream),
which one task has to read end to end.  Two digests take its place, both the same for any
split of the input into partitions:

- order-free: the four 32-bit parts of each line's md5, summed exactly;
- ordered: each line's hash times a fixed base to the power of its place, summed modulo a prime,
  in LANES independent lanes.  Two lines swapped change it, and the digest of one text after
  another follows from both digests and the first one's line count (``joined``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.functions.quantiles import global_positions

PRIME = 2 ** 31 - 1
#: The base of each lane.
BASES = (1_103_515_245, 741_103_597, 1_597_334_677, 204_209_821)
LANES = len(BASES)
#: Bits of a place: texts of up to this power of two lines.
PLACE_BITS = 48


def line_key(line: Column, part: int) -> Column:
    """The ``part``-th (0 to 3) eight hex digits of the line's md5 as an integer."""
    return F.conv(F.substring(F.md5(line), 8 * part + 1, 8), 16, 10).cast("long")


def fingerprint_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    return lines.agg(F.count(F.lit(1)).alias("n_lines"),
                     F.concat_ws("-", *[F.sum(line_key(F.col(col), k).cast("decimal(20,0)")).cast("string")
                                        for k in range(4)]).alias("digest"))


def fingerprint_text(spark: SparkSession, path: str) -> DataFrame:
    """A9 on a text file or folder (header line included, as the reference counts it)."""
    return fingerprint_lines(spark.read.text(path))


def table_lines(df: DataFrame, columns, sep: str = "|") -> DataFrame:
    """A delimited text rendering of ``columns`` (integers and strings render the same everywhere)."""
    return df.select(F.concat_ws(sep, *[F.col(c).cast("string") for c in columns]).alias("value"))


def squares(base: int) -> list[int]:
    """base ** (2 ** b) modulo PRIME, for every bit b of a place."""
    out = [base % PRIME]
    while len(out) < PLACE_BITS:
        out.append(out[-1] ** 2 % PRIME)
    return out


def _power(base: int, place: Column) -> Column:
    known = F.array(*[F.lit(x).cast("long") for x in squares(base)])
    return F.aggregate(F.sequence(F.lit(0), F.lit(PLACE_BITS - 1)), F.lit(1).cast("long"),
                       lambda product, b: F.when(F.getbit(place, b) == 1, product * F.get(known, b) % PRIME)
                       .otherwise(product))


def ordered_fingerprint(lines: DataFrame, order: list[str], col: str = "value") -> DataFrame:
    """n_lines and digest of the lines in the (unique) order of the columns ``order``.  Places come from
    range partitions and their counts; the sums combine in any order, so no task reads the text."""
    placed = global_positions(lines.select(*order, col), order, "_at")
    lanes = [F.sum(line_key(F.col(col), k) % PRIME * _power(base, F.col("_at")) % PRIME) % PRIME for k, base in enumerate(BASES)]
    return placed.agg(F.count(F.lit(1)).alias("n_lines"),
                      F.concat_ws("-", *[F.coalesce(x, F.lit(0)).cast("string") for x in lanes]).alias("digest"))


def ordered_fingerprint_text(spark: SparkSession, path: str) -> DataFrame:
    """A9 with the order of the lines kept, on a text file or a folder (its files by name)."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
                                         F.monotonically_increasing_id().alias("_line"))
    return ordered_fingerprint(lines, ["_file", "_block", "_line"])


def joined(first: tuple[int, str], second: tuple[int, str]) -> tuple[int, str]:
    """The ordered fingerprint (n_lines, digest) of one text followed by another."""
    parts = zip(BASES, map(int, first[1].split("-")), map(int, second[1].split("-")))
    return first[0] + second[0], "-".join(str((a + pow(base, first[0], PRIME) * b) % PRIME) for base, a, b in parts)
