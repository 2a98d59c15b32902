"""Exact redistribution of a table into L parts (PHY2).

``hashed_bucket`` deals rows out evenly on average and needs no shuffle.  Here the parts are equal:
their sizes differ by at most one, as those of ``ntile(L)`` over the key's order.  The keys alone are
ranged, sorted inside their ranges and numbered there, and written once to the shared folder, so a
retried task or a lost executor cannot number them anew.  The counts of the ranges (one number each)
give every part's first row, L - 1 keys come back, and a row's part is the number of these keys that
are not above its own: no row is ranked in one task, and the rows themselves are shuffled once, to
the partition whose number is their part.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, functions as F

from cairn.session import scratch_folder

# Bits of monotonically_increasing_id that number the rows of one partition.
_ROW_BITS = 33
# Above this many first keys a row's part is searched in two steps.
_FLAT_SEARCH = 32


def numbered_ranges(df: DataFrame, key: str, ranges: int | None = None) -> DataFrame:
    """``(rid, key)``: the table's keys in ranges of their order, ``rid`` = range << 33 + place in
    the range; written once, so the numbers stay.  ``rid`` follows the key's order, NULL first."""
    spark = df.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    keys = (df.select(F.col(key).alias("key")).repartitionByRange(ranges, "key")
            .sortWithinPartitions("key")
            .select(F.monotonically_increasing_id().alias("rid"), "key"))
    path = scratch_folder(spark, "ranges")
    keys.write.parquet(path)
    return spark.read.schema(keys.schema).parquet(path)


def first_keys(df: DataFrame, parts: int, key: str = "id", ranges: int | None = None) -> list:
    """The key of the first row of parts 1, 2, ... (fewer than ``parts - 1`` if rows are fewer)."""
    if parts < 1:
        raise ValueError("parts (L) must be >= 1")
    if parts == 1:
        return []
    spark = df.sparkSession
    numbered = numbered_ranges(df, key, ranges)
    counts = (numbered.groupBy(F.shiftright("rid", _ROW_BITS).alias("range"))
              .agg(F.count(F.lit(1)).alias("n")).orderBy("range").collect())
    ends = list(accumulate(r.n for r in counts))
    total = ends[-1] if ends else 0
    rids, at = [], 0
    for j in range(1, parts):
        rank = j * (total // parts) + min(j, total % parts)
        if rank >= total:
            break
        while ends[at] <= rank:
            at += 1
        # the row before tells whether the key is unique there
        for r in (rank - 1, rank):
            i = at if r >= ends[at] - counts[at].n else at - 1
            rids.append((j, r - rank, (counts[i]["range"] << _ROW_BITS) + r - (ends[i] - counts[i].n)))
    if not rids:
        return []
    wanted = spark.createDataFrame(rids, "part int, step bigint, rid bigint")
    found = {(r.part, r.step): r.key for r in numbered.join(F.broadcast(wanted), "rid").collect()}
    firsts = []
    for j in range(1, len(rids) // 2 + 1):
        if found[j, 0] == found[j, -1]:
            raise ValueError(f"key {key!r} is not unique: {found[j, 0]!r} lies on both sides of a "
                             "part's begin")
        firsts.append(found[j, 0])
    return firsts


def _not_above(cuts: list, key: Column, type_: str) -> Column:
    literal = F.array(*[F.lit(c) for c in cuts]).cast(f"array<{type_}>")
    return F.size(F.filter(literal, lambda c: c <= key))


def part_of(key: Column, firsts: list, type_: str) -> Column:
    """The number of first keys that are not above ``key``; NULL keys are in part 0.  Many first
    keys are searched in two steps, of about their square root each."""
    if not firsts:
        return F.lit(0)
    if len(firsts) <= _FLAT_SEARCH:
        return F.greatest(_not_above(firsts, key, type_), F.lit(0))
    step = int(len(firsts) ** 0.5)
    blocks = [firsts[i:i + step] for i in range(0, len(firsts), step)]
    # the last block whose first key is not above, then the place inside it
    block = _not_above([b[0] for b in blocks], key, type_)
    table = F.array(*[F.array(*[F.lit(c) for c in b]).cast(f"array<{type_}>") for b in blocks])
    inside = F.size(F.filter(F.get(table, block - 1), lambda c: c <= key))
    return F.when(block > 0, (block - 1) * step + inside).otherwise(F.lit(0))


def equal_parts(df: DataFrame, parts: int, key: str = "id", part_col: str = "part",
                ranges: int | None = None) -> DataFrame:
    """``df`` with its part in [0, parts): the rows in key order cut into parts whose sizes differ by
    at most one, the larger ones first, as ``ntile`` does.  ``key`` must tell the rows at the cuts
    apart, or ``ValueError`` is raised."""
    firsts = first_keys(df, parts, key, ranges)
    return df.withColumn(part_col, part_of(F.col(key), firsts, dict(df.dtypes)[key]).cast("int"))


def repartition_exact(df: DataFrame, parts: int, key: str = "id", part_col: str = "part",
                      ranges: int | None = None) -> DataFrame:
    """``equal_parts`` with every part in the partition of its number, by one shuffle of the rows."""
    return equal_parts(df, parts, key, part_col, ranges).repartitionById(parts, F.col(part_col))
