"""Filling containers of fixed capacity with items of varying size."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxmill.llm.tokens import TOKENIZER, token_sizes


SCHEMA = "pack_name string, container bigint, item bigint, piece int, size int"


def sum_of_squares(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Container number of each item (sizes at most the capacity), placed in the given order.

    Each item goes where the sum of the squared counts of open containers per residual gap becomes smallest: into a
    container whose gap is common, leaving a gap that is rare. Of equal places the one that leaves the smaller gap.
    """
    n = np.zeros(capacity + 1, dtype=np.int64)  # open containers by gap; full ones do not count
    stacks: dict[int, list[int]] = {}
    out, opened = np.empty(len(sizes), dtype=np.int64), 0
    for i, s in enumerate(sizes.tolist()):
        if s == 0:
            s = 0 if opened else 1  # an empty item needs no room, only a container
            if s == 0:
                out[i] = 0
                continue
        left = capacity - s
        best, place = (2 * int(n[left]) + 1 if left else 0), capacity
        gaps = np.flatnonzero(n[s:]) + s
        if len(gaps):
            after = gaps - s
            change = 2 - 2 * n[gaps] + 2 * n[after]
            if after[0] == 0:
                change[0] = 1 - 2 * n[s]
            k = int(change.argmin())
            if change[k] <= best:
                best, place = int(change[k]), int(gaps[k])
        if place == capacity:
            box, opened = opened, opened + 1
        else:
            box = stacks[place].pop()
            n[place] -= 1
        out[i] = box
        if place - s:
            n[place - s] += 1
            stacks.setdefault(place - s, []).append(box)
    return out


def pack_items(items: DataFrame, packs: list[tuple[str, int]], group_items: int = 20_000, count: int | None = None) -> DataFrame:
    """(pack_name, container, item, piece, size): every item of (item BIGINT, size INT) assigned for each capacity.

    An item above a capacity is cut into full pieces and a rest; no other is cut. Items are spread by hash over groups of
    about ``group_items``, each packed on its own from the largest item to the smallest, so no task grows with the data
    and what a group leaves open is small against what it holds. ``container`` is unique within its pack. Null sizes are
    left out, items of size 0 are placed; repeated items are placed each; capacities of 0 or below give no rows.
    """
    packs = sorted({(str(n), int(c)) for n, c in packs if c and c > 0})
    total = items.count() if count is None else count
    groups = max(1, -(-total // group_items))
    if not packs:
        return items.sparkSession.createDataFrame([], SCHEMA)
    sized = items.where(F.col("size").isNotNull()).select("item", "size", F.pmod(F.xxhash64("item"), F.lit(groups)).alias("grp"))

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        size, ident = pdf["size"].to_numpy().astype(np.int64), pdf["item"].to_numpy()
        out = []
        for name, capacity in packs:
            whole = np.maximum(1, -(-size // capacity))
            item = np.repeat(ident, whole)
            piece = np.arange(len(item)) - np.repeat(np.cumsum(whole) - whole, whole)
            last = piece == np.repeat(whole, whole) - 1
            part = np.where(last, np.repeat(size, whole) - piece * capacity, capacity)
            order = np.lexsort((piece, item, -part))
            box = np.empty(len(item), dtype=np.int64)
            box[order] = sum_of_squares(part[order], capacity)
            out.append(pd.DataFrame({"pack_name": name, "container": box * groups + int(key[0]), "item": item, "piece": piece.astype(np.int32), "size": part.astype(np.int32)}))
        return pd.concat(out)

    return sized.groupBy("grp").applyInPandas(run, SCHEMA)


def packing_faults(packed: DataFrame, packs: list[tuple[str, int]]) -> DataFrame:
    """(pack_name, items, tokens, overfull, torn, uneven): items placed, and what must be 0: containers above the capacity, items in
    several pieces though they fit into one container, and cut items with a piece but the last that is not full."""
    capacity = F.element_at(F.create_map(*[F.lit(x) for n, c in sorted(set(packs)) for x in (n, c)]), F.col("pack_name"))
    held = packed.groupBy("pack_name", "container").agg(F.sum("size").alias("t")).groupBy("pack_name").agg(F.sum((F.col("t") > capacity).cast("int")).alias("overfull"))
    # A repeated item is several items; each has a piece 0.
    per = packed.groupBy("pack_name", "item").agg(F.sum((F.col("piece") == 0).cast("int")).alias("copies"), F.sum("size").alias("t"), F.max("piece").alias("last"), F.sum((F.col("size") < capacity).cast("int")).alias("slack"))
    per = per.groupBy("pack_name").agg(
        F.sum("copies").alias("items"), F.sum("t").alias("tokens"), F.sum(((F.col("last") > 0) & (F.col("t") <= capacity)).cast("int")).alias("torn"), F.sum(((F.col("last") > 0) & (F.col("slack") > F.col("copies"))).cast("int")).alias("uneven")
    )
    return per.join(held, "pack_name").select("pack_name", "items", "tokens", "overfull", "torn", "uneven")


def pack_documents(documents: DataFrame, packs: list[tuple[str, int]], tokenizer: str = TOKENIZER, group_items: int = 20_000) -> DataFrame:
    """pack_items() of the documents by their sizes in tokens; ``item`` is doc_id."""
    sizes = token_sizes(documents, ["doc_id"], tokenizer=tokenizer)
    return pack_items(sizes.select(F.col("doc_id").alias("item"), F.col("tokens").alias("size")), packs, group_items, documents.count())


def fill_report(packed: DataFrame, packs: list[tuple[str, int]]) -> DataFrame:
    """(pack_name, containers, tokens, fill): how full the containers of each pack are on average."""
    capacity = F.create_map(*[F.lit(x) for n, c in sorted(set(packs)) for x in (n, c)])
    per = packed.groupBy("pack_name").agg(F.countDistinct("container").alias("containers"), F.sum("size").alias("tokens"))
    return per.withColumn("fill", F.col("tokens") / (F.col("containers") * F.element_at(capacity, F.col("pack_name"))))
