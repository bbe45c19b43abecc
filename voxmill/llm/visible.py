"""One consistent form for text that looks the same but is written with different characters."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from voxmill.llm import unicode_tables as U
from voxmill.session import checkpoint_dir

_ELEMENT = "array<struct<ccc:int,j:int,cp:string>>"


@lru_cache(maxsize=1)
def _patterns() -> tuple[str, str, str]:
    """(a run of plain characters, any character that may need work, the cutter of a text into plain stretches and clusters).

    A class of many ranges costs time for each range and character tested. So what is tested often is a few plain ranges
    in which nothing changes, and the categories of marks and of characters without ink; only a mark, or a character that
    the JVM's older Unicode does not know, is looked for in a list. A cluster is one character and what follows it.
    """
    changed, gone, followers = U.unsettled()
    tail = gone | followers
    plain = U.char_class(chr(c) for a, b in _plain_ranges(changed | tail) for c in range(a, b))
    alone = U.char_class(c for c in map(chr, range(0x110000)) if unicodedata.category(c)[0] == "M" and c not in tail)
    lettered = U.char_class(c for c in tail if unicodedata.category(c)[0] != "M" and unicodedata.category(c) != "Cf")
    follows = rf"[\p{{M}}\p{{Cf}}{lettered}\p{{Cn}}&&[^{alone}]&&[\P{{Cn}}{U.char_class(tail)}]]"
    return f"[{plain}]++", f"[{U.char_class(changed | tail)}]", rf"((?:[{plain}](?!{follows}))++|(?!{follows})[\s\S]{follows}*+|{follows}++)"


def _plain_ranges(unsettled: frozenset, least: int = 60) -> list[tuple[int, int]]:
    """Ranges below U+D800 of at least ``least`` code points in which nothing changes, the first four and the longest four."""
    out, start = [], 0
    for c in range(0xD800):
        if chr(c) in unsettled:
            if c - start >= least:
                out.append((start, c))
            start = c + 1
    return sorted({*out[:4], *sorted(out, key=lambda r: r[0] - r[1])[:4]})


def _needs_work(text: Column) -> Column:
    plain, any_of, _ = _patterns()
    rest = F.regexp_replace(text, plain, "")
    # Of what is not plain each character is tested once.
    return F.coalesce(F.when(rest != "", F.array_join(F.array_distinct(F.split(rest, "")), "").rlike(any_of)).otherwise(F.lit(False)), F.lit(False))


def mapping_table(spark: SparkSession) -> DataFrame:
    """(ch, out): what each character that decomposes, vanishes or has a combining class becomes.

    ``out`` lists the code points with ``ccc`` (combining class) and ``j`` (place). About 17,000 rows, fixed by the Unicode version.
    """
    t = U.tables()
    rows = []
    for ch in sorted(t["decomposition"].keys() | t["classes"].keys()):
        rows.append((ch, [(t["classes"].get(c, 0), j, c) for j, c in enumerate(t["decomposition"].get(ch, ch))]))
    return spark.createDataFrame(rows, f"ch string, out {_ELEMENT}")


def composition_table(spark: SparkSession) -> DataFrame:
    """(cluster, composed): every character that a whole decomposed cluster writes. About 12,000 rows, fixed."""
    return spark.createDataFrame(sorted(U.tables()["compose"].items()), "cluster string, composed string")


def single_table(spark: SparkSession) -> DataFrame:
    """(one, form): the form of each character that changes where nothing follows it. About 6,000 rows, fixed."""
    changed, gone, followers = U.unsettled()
    return spark.createDataFrame([(c, U.folded(c)) for c in sorted(changed | gone | followers)], "one string, form string")


@F.pandas_udf(StringType())
def _compose_rest(ordered: pd.Series) -> pd.Series:
    """Composition of ordered code points, for clusters that are not one character as a whole. Each distinct cluster comes here once."""
    return ordered.map(lambda x: unicodedata.normalize("NFC", x))


def cluster_forms(clusters: DataFrame) -> DataFrame:
    """(cluster, form) of distinct clusters: exploded to code points, these mapped by a broadcast join, ordered and recomposed."""
    spark = clusters.sparkSession
    chars = clusters.select("cluster", F.posexplode(F.split("cluster", "")).alias("_k", "_ch"))
    mapped = chars.join(F.broadcast(mapping_table(spark)), F.col("_ch") == F.col("ch"), "left")
    itself = F.array(F.struct(F.lit(0).alias("ccc"), F.lit(0).alias("j"), F.col("_ch").alias("cp")))
    parts = mapped.select("cluster", "_k", F.explode_outer(F.coalesce("out", itself)).alias("e"))
    # After each code point of class 0 the marks follow by class, ties in order of place.
    begun = Window.partitionBy("cluster").orderBy("_k", "e.j").rowsBetween(Window.unboundedPreceding, 0)
    parts = parts.withColumn("_seg", F.sum(F.when(F.col("e.ccc") == 0, 1).otherwise(0)).over(begun))
    element = F.when(F.col("e.cp").isNotNull(), F.struct("_seg", F.col("e.ccc").alias("ccc"), F.col("_k").alias("k"), F.col("e.j").alias("j"), F.col("e.cp").alias("cp")))
    ordered = parts.groupBy("cluster").agg(F.sort_array(F.collect_list(element)).alias("_e"))
    ordered = ordered.withColumn("_s", F.array_join(F.transform("_e", lambda e: e["cp"]), ""))
    table = composition_table(spark).withColumnRenamed("cluster", "_whole")
    whole = ordered.select("cluster", "_s").join(F.broadcast(table), F.col("_s") == F.col("_whole"), "left")
    rest = F.when(F.col("composed").isNull() & (F.char_length("_s") > 1), F.col("_s")).otherwise("")
    return whole.select("cluster", F.coalesce("composed", F.when(F.char_length("_s") > 1, _compose_rest(rest)).otherwise(F.col("_s"))).alias("form"))


#: Forms of so many bytes of clusters at most are sent to every executor.
MOST_BROADCAST = 8 << 20


def _cut(text: Column) -> Column:
    """A text's plain stretches and clusters in order."""
    return F.regexp_extract_all(text, F.lit(_patterns()[2]), F.lit(1))


def _has_several(piece: Column) -> Column:
    """Whether a piece is a cluster of more than one code point."""
    return (F.char_length(piece) > 1) & ~piece.rlike(rf"\A{_patterns()[0]}\z")


def _rebuilt(texts: DataFrame, work: DataFrame, carried: list[str]) -> DataFrame:
    """(carried..., _v): work's texts ``_t`` in their visible form; a null text gives an empty one. ``texts`` are those texts too.

    The forms of clusters are found once for each distinct cluster and written; those of one character come from a fixed
    table. How many distinct clusters there are depends on the data: their bytes are counted, and they are broadcast
    only up to ``MOST_BROADCAST``, else joined by an exchange, over all whose keys the other pieces are spread. Rows go
    through one exchange.
    """
    checkpoint_dir(work.sparkSession)
    several = texts.select(F.explode(_cut(F.col("_t"))).alias("cluster")).where(_has_several(F.col("cluster"))).distinct()
    forms = cluster_forms(several).select(F.lit(-1).alias("_s"), "cluster", F.col("form").alias("_form")).checkpoint()
    size = forms.agg(F.coalesce(F.sum(F.octet_length("cluster") + F.octet_length("_form")), F.lit(0))).first()[0]
    # Rows are told apart by number within their partition, so that equal rows stay two; it never crosses an exchange.
    work = work.repartition(F.col("_id"), F.col("_h")).withColumn("_r", F.monotonically_increasing_id())
    cut = F.concat(F.coalesce(_cut(F.col("_t")), F.array().cast("array<string>")), F.array(F.lit("")))  # at least one piece
    pieces = work.select(*carried, "_r", F.posexplode(cut).alias("_p", "_piece"))
    found = pieces.join(F.broadcast(single_table(work.sparkSession)), F.col("_piece") == F.col("one"), "left")
    if size <= MOST_BROADCAST:
        found = found.join(F.broadcast(forms), F.col("_piece") == F.col("cluster"), "left")
    else:
        found = found.withColumn("_side", F.when(_has_several(F.col("_piece")), -1).otherwise(F.pmod(F.hash("_id"), F.lit(1024))))
        found = found.join(forms, (F.col("_side") == F.col("_s")) & (F.col("_piece") == F.col("cluster")), "left")
    text = F.coalesce("_form", "form", "_piece")
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_p", text.alias("_x")))), lambda e: e["_x"]), "")
    return found.groupBy(*carried, "_r").agg(joined.alias("_v")).select(*carried, "_v")


def visible_form(df: DataFrame, id_col: str, text_col: str = "text", out_col: str = "visible") -> DataFrame:
    """(id, out_col): each text in the one form that all texts of the same look share.

    Texts are exploded to positioned code points, with stretches in which nothing can change kept whole; a broadcast
    join gives each code point its decomposition or the Latin letter it looks like; marks are ordered by class within
    their cluster, clusters recomposed, and the strings rebuilt in order. Texts without any such character pass
    untouched and are never exploded or moved; the others go through one exchange by id.

    What is kept apart: case, accents, digits, punctuation, line breaks, number of blanks. What becomes one: width,
    kind of blank, characters without ink, encoded form of letters and accents, ligatures, letters of another script
    with the shape of a Latin one.

    Null texts give null, empty ones the empty string; repeated rows stay repeated; columns other than the two named are ignored, so clashing names do no harm.
    """
    base = df.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t"))
    touched = _needs_work(F.col("_t"))
    work = base.where(touched).withColumn("_h", F.xxhash64("_t"))
    return base.where(~touched).unionByName(_rebuilt(work, work, ["_id", "_h"]).select("_id", F.col("_v").alias("_t"))).select(F.col("_id").alias(id_col), F.col("_t").alias(out_col))


def _looks(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_i, look, raw) of the rows with a text: its id and the digests (SHA-256) of its visible form and of its characters. Texts in
    which nothing changes go on as their digest."""
    base = df.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("_id"), F.unhex(F.sha2(text_col, 256)).alias("_h"), F.col(text_col).alias("_t"), _needs_work(F.col(text_col)).alias("_w"))
    rows = _rebuilt(base.where("_w"), base.select("_id", "_h", "_w", F.when(F.col("_w"), F.col("_t")).alias("_t")), ["_id", "_h", "_w"])
    # Read several times by what follows: written once, as 64 bytes a row, to the shared folder.
    return rows.select(F.col("_id").alias("_i"), F.when(F.col("_w"), F.unhex(F.sha2("_v", 256))).otherwise(F.col("_h")).alias("look"), F.col("_h").alias("raw")).checkpoint()


def look_classes(df: DataFrame, id_col: str, text_col: str = "text") -> DataFrame:
    """(id, class_id, kinds, links): one row for each row that looks like another of other characters. ``class_id`` is the least
    id of its look, ``kinds`` the different texts of that look, ``links`` the rows of the look with another text than its own.

    Linear in the rows whatever the groups' sizes: counts by text, then by look; no pairs are made. Null texts are in no
    class; an empty table gives none.
    """
    rows = _looks(df, id_col, text_col)
    kinds = rows.groupBy("look", "raw").agg(F.count(F.lit(1)).alias("n"), F.min("_i").alias("least"))
    looks = kinds.groupBy("look").agg(F.min("least").alias("class_id"), F.count(F.lit(1)).alias("kinds"), F.sum("n").alias("all")).where("kinds > 1")
    members = kinds.join(looks, "look").select("look", "raw", "class_id", "kinds", (F.col("all") - F.col("n")).alias("links"))
    return rows.join(members, ["look", "raw"]).select(F.col("_i").alias(id_col), "class_id", "kinds", "links")


def same_looking_pairs(df: DataFrame, id_col: str, text_col: str = "text", most_kinds: int = 1000) -> DataFrame:
    """(id_a, id_b), id_a < id_b: every pair of rows whose texts look the same and differ in at least one character.

    Rows are joined by digests (SHA-256 of the visible form and of the raw text), never texts. Identical copies form
    one class; only classes of one look are paired, then expanded to their rows, so a hot group of identical copies
    costs what the result holds and no more. A look of many different texts is split into parts of about ``most_kinds``
    for the pairing. look_classes() gives the same groups without the pairs. Null texts are in no pair; empty ones pair
    with texts of no ink.
    """
    rows = _looks(df, id_col, text_col)
    kinds = rows.groupBy("look", "raw").agg(F.count(F.lit(1)).alias("n"))
    mixed = kinds.groupBy("look").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1").select("look", F.ceil(F.col("kinds") / most_kinds).cast("int").alias("parts"))
    kinds = kinds.join(mixed, "look").select("look", "raw", "parts")
    left = kinds.select("look", F.pmod(F.hash("raw"), F.col("parts")).alias("part"), F.col("raw").alias("raw_a"))
    right = kinds.select("look", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("raw").alias("raw_b"))
    pairs = left.join(right, ["look", "part"]).where("raw_a < raw_b").drop("part")
    a = rows.select(F.col("_i").alias("ia"), F.col("look").alias("la"), F.col("raw").alias("ra"))
    b = rows.select(F.col("_i").alias("ib"), F.col("look").alias("lb"), F.col("raw").alias("rb"))
    both = pairs.join(a, (F.col("look") == F.col("la")) & (F.col("raw_a") == F.col("ra"))).join(b, (F.col("look") == F.col("lb")) & (F.col("raw_b") == F.col("rb")))
    return both.select(F.least("ia", "ib").alias(f"{id_col}_a"), F.greatest("ia", "ib").alias(f"{id_col}_b"))
