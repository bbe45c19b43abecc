"""How often, and in how many records, every distinct term occurs; with the terms too rare or too common to be useful marked."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def last_seen_counts(tokens: DataFrame, keys: list[str], record: str = "record", most_rows: int | None = None, rows_a_share: int = 1_000_000) -> DataFrame:
    """(keys..., occurrences, records): counted with one last-seen record per term instead of a set of records.

    Tokens are hash-partitioned by term and by a share of the records, and sorted by record within. One pass in that
    order needs three numbers a term: occurrences, records, and the record last seen; a token whose record is not the
    last one starts a new record. A record lies in one share, so the shares' counts add up exactly; they meet in a
    second, small aggregation. There is a share for each ``rows_a_share`` of the rows that one term can have
    (``most_rows``, by default all), so however often a term occurs, its rows fill tasks of one size; rows of a window
    are streamed and spill, so nothing grows with a term's frequency.

    Tokens with a null key or record are left out. An empty table gives an empty result.
    """
    given = tokens.where(F.col(record).isNotNull()).dropna(subset=keys)
    shares = max(8, -(-(given.count() if most_rows is None else most_rows) // rows_a_share))
    share = F.pmod(F.xxhash64(record), F.lit(shares))
    rows = given.select(*keys, F.col(record).alias("_r"), share.cast("int").alias("_share"))
    in_order = Window.partitionBy(*keys, "_share").orderBy("_r")
    seen = rows.withColumn("_last", F.lag("_r").over(in_order))
    fresh = F.when(F.col("_last").isNull() | (F.col("_last") != F.col("_r")), 1).otherwise(0)
    part = seen.groupBy(*keys, "_share").agg(F.count(F.lit(1)).alias("o"), F.sum(fresh).alias("n"))
    return part.groupBy(*keys).agg(F.sum("o").alias("occurrences"), F.sum("n").alias("records"))


def usefulness(records: Column, total: Column, min_records: int = 3, max_share: float = 0.1) -> Column:
    """'rare' below min_records, else 'common' above max_share of all records, else null."""
    return F.when(records < min_records, "rare").when(records > total * max_share, "common")


def term_table(transcripts: DataFrame, hotwords: DataFrame) -> DataFrame:
    """(field, term, occurrences, records, mark) of words of ``text`` and of whole ``hotword`` entries.

    Words: lower-cased pieces between U+0020 blanks, a record is an utterance with all its rows. Hotwords: the entry
    without outer blanks, lower-cased; a record is a list. Null and empty texts hold no term, but their records count
    in the total. Repeated rows add occurrences, not records. Other columns are ignored.
    """
    fields = F.create_map(F.lit(0), F.lit("text"), F.lit(1), F.lit("hotword"))
    words = transcripts.select(F.lit(0).alias("field"), F.explode(F.split(F.lower("text"), " ")).alias("term"), F.col("utt").alias("record"))
    entries = hotwords.select(F.lit(1).alias("field"), F.lower(F.trim("hotword")).alias("term"), F.col("list_id").cast("string").alias("record"))
    # Counting the tables' rows reads no column; that a term may stand several times in a row only makes its shares larger.
    counts = last_seen_counts(words.unionByName(entries).where("term <> ''"), ["field", "term"], most_rows=transcripts.count() + hotwords.count())
    totals = transcripts.select(F.lit(0).alias("field"), F.col("utt").alias("r")).unionByName(hotwords.select(F.lit(1).alias("field"), F.col("list_id").cast("string").alias("r")))
    totals = totals.groupBy("field").agg(F.countDistinct("r").alias("total"))
    # totals has one row for each of the two fields.
    out = counts.join(F.broadcast(totals), "field")
    return out.select(F.element_at(fields, F.col("field")).alias("field"), "term", "occurrences", "records", usefulness(F.col("records"), F.col("total")).alias("mark"))
