"""Operations on keyed tables: semi and anti joins, lookups, grouping to lists, equal splits, sets.

Row order is a column wherever it matters (``line_no``); nothing relies on the order of files or partitions.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxmill.session import checkpoint_dir


def filter_by_keys(df: DataFrame, ids: DataFrame, key: str, id_col: str | None = None, exclude: bool = False) -> DataFrame:
    """JN1, JN2, SET4, FLT6: rows of df whose key is (not) among the ids. Repeated ids change nothing; null keys match none."""
    right = ids.select(F.col(id_col or key).alias("_id"))
    return df.join(right, F.col(key) == F.col("_id"), "left_anti" if exclude else "left_semi")


def intersect_on_key(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """SET2: rows of right whose key left has too."""
    return filter_by_keys(right, left, key)


def last_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """JN3's rule and WN9: of each key the last row in order. One aggregation with map-side combine, no sort."""
    rest = [c for c in df.columns if c not in keys]
    packed = F.struct(*[F.col(c) for c in rest])
    out = df.groupBy(*keys).agg(F.max_by(packed, F.struct(*order)).alias("_row"))
    return out.select(*keys, *[F.col("_row")[c].alias(c) for c in rest])


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """SET3: of each key the first row in order."""
    rest = [c for c in df.columns if c not in keys]
    out = df.groupBy(*keys).agg(F.min_by(F.struct(*[F.col(c) for c in rest]), F.struct(*order)).alias("_row"))
    return out.select(*keys, *[F.col("_row")[c].alias(c) for c in rest])


def lookup_strict(df: DataFrame, table: DataFrame, key: str, value: str) -> DataFrame:
    """JN5: df with each key's value; a key that the table lacks fails the query."""
    found = df.join(table.select(key, value), key, "left")
    return found.withColumn(value, F.when(F.col(value).isNull(), F.raise_error(F.concat(F.lit("no value for key "), F.coalesce(F.col(key).cast("string"), F.lit("null"))))).otherwise(F.col(value)))


def semi_on_prefix(df: DataFrame, ids: DataFrame, key: str, id_col: str, sep: str = "-") -> DataFrame:
    """JN7: rows whose key up to the separator is among the ids."""
    return df.join(ids.select(F.col(id_col).alias("_id")), F.substring_index(key, sep, 1) == F.col("_id"), "left_semi")


def lookup_with_default(df: DataFrame, dim: DataFrame, key: str, value: str, default) -> DataFrame:
    """JN11: df with the value of its key in a dimension, or the default."""
    return df.join(dim.select(key, F.col(value)), key, "left").withColumn(value, F.coalesce(F.col(value), F.lit(default)))


def merge_hotwords(client: DataFrame, server: DataFrame, word: str = "word", weight: str = "weight") -> DataFrame:
    """JN12: the union of two word lists; the client's weight stands where both have one."""
    c = client.select(F.col(word), F.col(weight).alias("_c"))
    s = server.select(F.col(word), F.col(weight).alias("_s"))
    return c.join(s, word, "full_outer").select(word, F.coalesce("_c", "_s").alias(weight))


def group_to_list(df: DataFrame, group: str, member: str, line_no: str, sep: str = " ") -> DataFrame:
    """AG1: (group, members, first_line): members joined in order of appearance; groups in order by first_line."""
    ordered = F.transform(F.sort_array(F.collect_list(F.struct(F.col(line_no).alias("n"), F.col(member).alias("m")))), lambda x: x["m"])
    return df.where(F.col(group).isNotNull() & F.col(member).isNotNull()).groupBy(group).agg(F.array_join(ordered, sep).alias("members"), F.min(line_no).alias("first_line"))


def equal_split(df: DataFrame, parts: int, order: list[Column]) -> DataFrame:
    """WN1, WN2: df with ``part`` (1..parts): contiguous parts of equal size in order, the first n mod parts one larger.

    Not ntile() over everything, which would bring all rows to one task: rows are range-partitioned in order, numbered
    within their partition, and the partitions' counts (one number each) give the offset.
    """
    if parts < 1:
        raise ValueError("parts must be positive")
    numbered = row_numbers(df, order, "_n", "_total")
    size, extra = F.floor(F.col("_total") / parts), F.col("_total") % parts
    large = extra * (size + 1)
    part = F.when(F.col("_n") < large, F.floor(F.col("_n") / (size + 1))).otherwise(extra + F.floor((F.col("_n") - large) / F.greatest(size, F.lit(1))))
    return numbered.withColumn("part", (part + 1).cast("int")).drop("_n", "_total")


def row_numbers(df: DataFrame, order: list[Column], number: str = "n", total: str | None = None) -> DataFrame:
    """df with each row's place (from 0) in a total order, made in parallel. Rows that tie in the whole order take their places
    in any order.

    Rows are range-partitioned and sorted once, and written with their partition and place to the shared folder. Counts
    and places are both read from there: were they two branches of a plan, each would sample its own ranges and be
    coalesced in its own way. Neither a retried task nor a lost executor can change what is written.
    """
    checkpoint_dir(df.sparkSession)
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()).checkpoint()
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    counts = placed.groupBy(part.alias("_p")).agg(F.count(F.lit(1)).alias("_c"))  # a row a partition
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_p", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_before"), F.sum("_c").over(Window.partitionBy()).alias("_all"))
    out = placed.withColumn("_p", part).join(F.broadcast(offsets), "_p").withColumn(number, place + F.col("_before"))
    if total:
        out = out.withColumn(total, F.col("_all"))
    return out.drop("_p", "_at", "_before", "_all")


def balanced_cuts(count_at: Callable[[int], int], sizes: list[int], speakers: int) -> list[int]:
    """Where each part of a contiguous split begins, the end last, after speakers at the borders were moved to balance the sizes.

    Part p begins at the first speaker i with int(i * parts / speakers) = p and holds ``sizes[p]`` utterances. In each
    round every part in turn hands its last speaker on, then its first one back, wherever that brings the two parts
    strictly closer. Rounds end when nothing moves.
    """
    parts, size = len(sizes), list(sizes)
    cuts = [-(-p * speakers // parts) for p in range(parts + 1)]

    def hand(speaker: int, source: int, target: int) -> bool:
        c = count_at(speaker)
        if abs((size[target] + c) - (size[source] - c)) >= abs(size[target] - size[source]):
            return False
        size[source], size[target] = size[source] - c, size[target] + c
        return True

    moved = True
    while moved:
        moved = False
        for p in range(parts):
            if p + 1 < parts and cuts[p] < cuts[p + 1] and hand(cuts[p + 1] - 1, p, p + 1):
                cuts[p + 1] -= 1
                moved = True
            if p and cuts[p] < cuts[p + 1] and hand(cuts[p], p, p - 1):
                cuts[p] += 1
                moved = True
    return cuts


def split_by_speaker(counts: list[tuple[str, int]], parts: int) -> list[tuple[str, int]]:
    """WN3: (speaker, part from 0) for contiguous runs of speakers (name, utterances) in first-seen order, balanced by utterances.

    Fewer speakers than parts is an error. A part's only speaker never leaves it, as that brings no two parts closer.
    """
    n = len(counts)
    if n < parts:
        raise ValueError(f"{n} speakers cannot fill {parts} parts")
    sizes = [0] * parts
    for i, (_, c) in enumerate(counts):
        sizes[i * parts // n] += c
    cuts = balanced_cuts(lambda i: counts[i][1], sizes, n)
    return [(s, bisect_right(cuts, i) - 1) for i, (s, _) in enumerate(counts)]


def speaker_split(utts: DataFrame, parts: int, speaker: str = "spk", line_no: str = "line_no") -> DataFrame:
    """WN3 over a table: utts with ``part``. Speakers are numbered in first-seen order in parallel; the driver sees a sum a part, and
    blocks of counts around the borders that move."""
    per = utts.where(F.col(speaker).isNotNull()).groupBy(speaker).agg(F.count(F.lit(1)).alias("_c"), F.min(line_no).alias("_f"))
    placed = row_numbers(per, [F.col("_f"), F.col(speaker)], "_n", "_speakers")
    sums = placed.groupBy(F.expr(f"_n * {int(parts)} div _speakers").alias("p")).agg(F.sum("_c").alias("t"), F.max("_speakers").alias("all")).collect()
    n = sums[0]["all"] if sums else 0
    if n < parts:
        raise ValueError(f"{n} speakers cannot fill {parts} parts")
    known: dict[int, int] = {}

    def count_at(i: int) -> int:
        if i not in known:
            first = i - i % 1000
            known.update({r["_n"]: r["_c"] for r in placed.where(F.col("_n").between(first, first + 999)).select("_n", "_c").collect()})
        return known[i]

    cuts = balanced_cuts(count_at, [t for _, t in sorted((r["p"], r["t"]) for r in sums)], n)
    part = F.size(F.filter(F.array(*[F.lit(c) for c in cuts[1:-1]]).cast("array<bigint>"), lambda c: c <= F.col("_n"))) if parts > 1 else F.lit(0)
    return utts.join(placed.select(speaker, part.alias("part")), speaker)


def union_all(*tables: DataFrame) -> DataFrame:
    """SET1, SNK3, SNK10: all rows of all tables, columns matched by name."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out


def with_specials(df: DataFrame, column: str, specials: list[str]) -> DataFrame:
    """SET5: df's column with fixed entries added once each."""
    extra = df.sparkSession.createDataFrame([(s,) for s in specials], f"{column} string")
    return df.select(column).unionByName(extra)


def validation_split(df: DataFrame, key: str, share: float = 0.05, count: int | None = None, seed: int = 531) -> DataFrame:
    """AG18: df with ``split``: the ``count`` (or share) keys with the least seeded hash are 'valid', the rest 'train'.

    The border comes from counts of 65,536 cells of hashes and a sort of one cell. No validation rows leave all in train.
    """
    mark = F.xxhash64(F.lit(seed), F.col(key))
    wanted = int(df.count() * share) if count is None else count
    if wanted <= 0:
        return df.withColumn("split", F.lit("train"))
    cell = F.shiftright(mark, 48)
    border, before = None, 0
    for c, n in df.groupBy(cell.alias("c")).agg(F.count(F.lit(1)).alias("n")).orderBy("c").collect():
        if before + n >= wanted:
            rest = df.select(mark.alias("h")).where(F.shiftright("h", 48) == c).orderBy("h").limit(wanted - before)
            border = rest.agg(F.max("h")).collect()[0][0]
            break
        before += n
    chosen = F.lit(True) if border is None else mark <= border
    return df.withColumn("split", F.when(chosen, "valid").otherwise("train"))


def hours(df: DataFrame, dur: str = "dur") -> DataFrame:
    """AG2, AG3: (utterances, measured, hours): all rows count, only positive durations add up."""
    good = F.col(dur) > 0
    return df.agg(F.count(F.lit(1)).alias("utterances"), F.coalesce(F.sum(F.when(good, 1).otherwise(0)), F.lit(0)).alias("measured"), (F.coalesce(F.sum(F.when(good, F.col(dur))), F.lit(0.0)) / 3600).alias("hours"))


def duration_band(df: DataFrame, dur: str = "dur", least: float = 0.5, most: float = 40.0) -> DataFrame:
    """FLT1."""
    return df.where(F.col(dur).between(least, most))


def speakers_by_split(df: DataFrame, splits: list[str], split: str = "split", speaker: str = "spk", dur: str = "dur") -> DataFrame:
    """AG8: (split, speakers, hours) of each named split, zeros for those without rows."""
    names = df.sparkSession.createDataFrame([(s,) for s in splits], f"{split} string")
    per = df.groupBy(split).agg(F.countDistinct(speaker).alias("speakers"), (F.sum(dur) / 3600).alias("hours"))
    return names.join(per, split, "left").na.fill({"speakers": 0, "hours": 0.0})


def shuffled(df: DataFrame, key: str, seed: int = 0) -> DataFrame:
    """SRT2: a random order that is the same in every run."""
    return df.orderBy(F.xxhash64(F.lit(seed), F.col(key)), key)


def by_bytes(df: DataFrame, *keys: str) -> DataFrame:
    """SRT1: ordered as ``sort`` does in the C locale; Spark compares UTF-8 bytes as well."""
    return df.orderBy(*keys)


def mean_of_known(df: DataFrame, value: str) -> DataFrame:
    """FLT8: (n, mean) of the values that are numbers; NaN and null stay out, failures scored 0 stay in."""
    return df.where(F.col(value).isNotNull() & ~F.isnan(value)).agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean"))
