"""Mixing sources to target weights."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxmill.llm.tokens import TOKENIZER, sizer
from voxmill.session import spread

DIMENSIONS = ("source", "lang", "topic")
BUCKETS = 2000
MOST_CELLS = 100_000


def source_code(source: Column) -> Column:
    return F.lower(F.trim(source))


def source_goals(held: dict[str, float], share: dict[str, float], repeat: dict[str, int], total: float) -> dict[str, float]:
    """Tokens wanted of each source: its share of the total, at most its tokens times its repeats. What a small source cannot
    give, the others give in proportion to their shares as far as they can."""
    cap = {s: held.get(s, 0.0) * max(0, repeat.get(s) or 0) for s in share}
    goal, open_ = {}, {s for s in share if share[s] > 0}
    left = total
    while open_:
        weight = sum(share[s] for s in open_)
        full = {s for s in open_ if left * share[s] / weight >= cap[s] - 1e-9}
        if not full:
            goal |= {s: left * share[s] / weight for s in open_}
            break
        for s in full:
            goal[s] = cap[s]
        left -= sum(cap[s] for s in full)
        open_ -= full
    return {s: max(0.0, goal.get(s, 0.0)) for s in share}


def rake(cells: pd.DataFrame, goals: dict[str, float], caps: dict[str, int], rounds: int = 200) -> np.ndarray:
    """Expected uses of a document of each cell (source, lang, topic, tokens), by iterative proportional fitting.

    The cells' tokens are scaled in turn to the marginals of topic, language (both as in the whole corpus) and source,
    the source last, so its marginal holds where all three cannot. No cell is used more often than its source allows;
    what it may not give is asked of the source's other cells.
    """
    tokens = cells["tokens"].to_numpy(dtype=float)
    source = cells["source"].to_numpy()
    use = np.array([s in goals and goals[s] > 0 for s in source])
    cap = np.array([caps.get(s, 0) if u else 0 for s, u in zip(source, use)], dtype=float)
    weight = np.where(use, 1.0, 0.0)
    if not use.any() or tokens[use].sum() <= 0:
        return weight * 0
    total = sum(goals.values())
    margins = []
    for d in ("topic", "lang"):
        code, _ = pd.factorize(cells[d])
        wanted = np.bincount(code, weights=tokens)
        reach = np.bincount(code, weights=tokens * use) > 0
        margins.append((code, np.where(reach, wanted, 0) / max(wanted[reach].sum(), 1e-9) * total))
    code, names = pd.factorize(cells["source"])
    margins.append((code, np.array([goals.get(s, 0.0) for s in names])))
    for _ in range(rounds):
        before = weight.copy()
        for code, wanted in margins:
            now = np.bincount(code, weights=weight * tokens, minlength=len(wanted))
            weight = np.minimum(weight * np.divide(wanted, now, out=np.ones_like(wanted), where=now > 0)[code], np.maximum(cap, 0))
        # Room lost at caps goes to the source's cells that still have some.
        code, wanted = margins[-1]
        for _ in range(20):
            now = np.bincount(code, weights=weight * tokens, minlength=len(wanted))
            free = (weight < cap - 1e-12) & use
            part = np.bincount(code, weights=weight * tokens * free, minlength=len(wanted))
            lack = wanted - now
            if not (lack > 1e-6 * total).any():
                break
            factor = 1 + np.divide(lack, part, out=np.zeros_like(lack), where=part > 0)
            weight = np.where(free, np.minimum(weight * np.maximum(factor, 1)[code], cap), weight)
        if np.abs(weight - before).max() < 1e-9:
            break
    return weight


def mix(items: DataFrame, targets: DataFrame) -> DataFrame:
    """(doc_id, source, lang, topic, tokens, weight, uses): how often each document stands in the mix; unused ones have 0.

    ``items`` has doc_id, source, lang, topic, tokens (nulls of the three become 'none'); read twice, so give it
    written or checkpointed. ``targets`` has source, target_share, max_repeat. Sources without a target are one source
    from the start, so the driver sees one row a cell of target source, language and topic, and one a target and bucket
    below, however many sources there are. Languages and topics are categories: over ``MOST_CELLS`` cells are an error.

    A document of weight w is used floor(w) times and once more with probability w - floor(w): if a number drawn from
    its id's hash lies below that. Each source's border is then moved, by a histogram of the distances from it, to where
    the source's tokens meet its goal; so the shares reached do not depend on luck. No document is used more often than
    its source allows. Repeated ids are used alike; an empty table gives an empty mix.
    """
    want = targets.groupBy(source_code(F.col("source")).alias("source")).agg(F.sum("target_share").alias("share"), F.max("max_repeat").alias("max_repeat")).where("source is not null").toPandas()
    share = dict(zip(want["source"], want["share"].fillna(0.0)))
    repeat = {s: int(r) if r == r and r is not None else 1 for s, r in zip(want["source"], want["max_repeat"])}
    source = F.coalesce(source_code(F.col("source")), F.lit("none"))
    clean = items.select(
        "doc_id", source.alias("source"), F.when(source.isin(*share), source).alias("_cell"), F.coalesce("lang", F.lit("none")).alias("lang"),
        F.coalesce("topic", F.lit("none")).alias("topic"), F.coalesce("tokens", F.lit(0)).cast("bigint").alias("tokens"),
    )
    cells = clean.groupBy(F.coalesce("_cell", F.lit("")).alias("source"), "lang", "topic").agg(F.sum("tokens").alias("tokens")).limit(MOST_CELLS + 1).toPandas()
    if len(cells) > MOST_CELLS:
        raise ValueError("lang and topic must be categories")
    schema = "doc_id bigint, source string, lang string, topic string, tokens bigint, weight double, uses int"
    if cells.empty:
        return items.sparkSession.createDataFrame([], schema)
    held = cells.groupby("source")["tokens"].sum().astype(float).to_dict()
    goals = source_goals(held, share, repeat, float(cells["tokens"].sum()))
    cells["weight"] = rake(cells, goals, repeat)
    cells["most"] = [repeat.get(s, 0) for s in cells["source"]]
    table = items.sparkSession.createDataFrame(cells[[*DIMENSIONS, "weight", "most"]].rename(columns={"source": "_cell"}), "_cell string, lang string, topic string, weight double, most int")
    drawn = clean.withColumn("_cell", F.coalesce("_cell", F.lit(""))).join(F.broadcast(table), ["_cell", "lang", "topic"])  # a row a cell: MOST_CELLS at most
    base = F.least(F.floor(F.col("weight") + 1e-9), F.col("most"))
    chance = (F.xxhash64("doc_id", F.lit("mix")).bitwiseAND(F.lit((1 << 40) - 1)) / float(1 << 40)) - (F.col("weight") - base)
    drawn = drawn.withColumn("base", base.cast("int")).withColumn("away", F.when(base < F.col("most"), chance))
    bucket = F.floor((F.col("away") + 1) * (BUCKETS / 2)).cast("int")
    drawn = drawn.withColumn("bucket", bucket)
    seen = drawn.where("most > 0").groupBy("_cell", "bucket").agg(F.sum("tokens").alias("t"), F.sum(F.col("tokens") * F.col("base")).alias("b")).toPandas()
    uses = F.col("base")
    for s, part in seen.groupby("_cell"):
        extra = part.dropna(subset=["bucket"]).sort_values("bucket")
        reached = float(part["b"].sum()) + np.concatenate([[0.0], np.cumsum(extra["t"].to_numpy(dtype=float))])
        k = int(np.abs(reached - goals.get(s, 0.0)).argmin())
        if k:
            uses = uses + F.when((F.col("_cell") == s) & (F.col("bucket") <= int(extra["bucket"].iloc[k - 1])), 1).otherwise(0)
    return drawn.select("doc_id", *DIMENSIONS, "tokens", "weight", uses.cast("int").alias("uses"))


def shares_reached(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, target_share, max_repeat, documents, tokens, share): what the mix holds of each target source."""
    want = targets.groupBy(source_code(F.col("source")).alias("source")).agg(F.sum("target_share").alias("target_share"), F.max("max_repeat").alias("max_repeat"))
    used = mixed.join(F.broadcast(want.select("source")), "source", "left_semi")  # a row a target
    per = used.groupBy("source").agg(F.sum(F.when(F.col("uses") > 0, 1).otherwise(0)).alias("documents"), F.sum(F.col("tokens") * F.col("uses")).alias("tokens"), F.max("uses").alias("most_used"))
    per = per.withColumn("whole", F.sum("tokens").over(Window.partitionBy()))  # a row a target
    out = want.join(per, "source", "left")
    tokens = F.coalesce("tokens", F.lit(0))
    return out.select("source", "target_share", "max_repeat", F.coalesce("documents", F.lit(0)).alias("documents"), tokens.alias("tokens"), F.coalesce("most_used", F.lit(0)).alias("most_used"), F.coalesce(tokens / F.col("whole"), F.lit(0.0)).alias("share"))


def describe(documents: DataFrame, model, tokenizer: str = TOKENIZER) -> DataFrame:
    """(doc_id, source, lang, topic, tokens): size, main language and leading subject of each document, by one pass that cuts each
    text once. ``model`` is a SubjectModel with its languages. A document without sentences or subject gets null."""
    held = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        from voxmill.llm.language import LANGUAGES, languages_of
        from voxmill.llm.sentences import split_texts

        m, sizes = held.value, sizer(tokenizer)
        for pdf in batches:
            texts = pdf["text"].tolist()
            split = split_texts(texts, m.boundaries)
            lang, _ = languages_of(split, m.languages)
            doc = np.repeat(np.arange(len(split)), [len(x) for x in split])
            main = np.zeros((len(split), len(LANGUAGES)), dtype=np.int64)
            np.add.at(main, (doc, lang), 1)
            share, _ = m.shares_of(split)
            langs = [LANGUAGES[int(r.argmax())] if r.any() else None for r in main]
            topics = [m.subjects[int(r.argmax())] if len(r) and r.max() >= 0.25 else None for r in share]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "source": pdf["source"], "lang": langs, "topic": topics, "tokens": pd.array(sizes(texts), dtype="Int32")})

    return spread(documents.select("doc_id", "source", "text")).mapInPandas(run, "doc_id bigint, source string, lang string, topic string, tokens int")
