"""Mixing sources to target weights: budgets down a tree, seeded prefixes of its leaves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from almoner.llm.tables import keep

LEVELS = ["domain", "lang", "source"]


def word_count(text: Column) -> Column:
    """Tokens of a text as the budget counts them: runs without white space; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit("[^ \\t\\n\\r]+")), F.lit(0)).cast("long")


def _weight(level: str, weights: dict[str, int], other: int) -> Column:
    out = F.lit(other)
    for name, value in weights.items():
        out = F.when(F.col(level) == name, value).otherwise(out)
    return out.cast("double")


def share_out(nodes: DataFrame, parent: list[str]) -> DataFrame:
    """Adds ``given``: each parent's ``budget`` among its nodes by ``weight``, none above its ``capacity``.

    What a node can't take goes to its siblings by their weights. Nodes in
    order of capacity per weight are full up to a point; from there all get
    the same amount per weight.
    """
    order = W.partitionBy(*parent).orderBy(F.col("capacity") / F.col("weight"), *[c for c in LEVELS if c in nodes.columns])
    before = order.rowsBetween(W.unboundedPreceding, -1)
    level = (F.col("budget") - F.coalesce(F.sum("capacity").over(before), F.lit(0.0))) / (
        F.sum("weight").over(W.partitionBy(*parent)) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    marked = nodes.withColumn("_level", level).withColumn("_full", F.col("capacity") <= F.col("weight") * F.col("_level"))
    rest = F.max(F.when(~F.col("_full"), F.col("_level"))).over(W.partitionBy(*parent))
    return marked.withColumn("given", F.when(F.col("_full"), F.col("capacity")).otherwise(F.col("weight") * rest)).drop("_level", "_full")


def leaf_budgets(leaves: DataFrame, weights: dict[str, dict[str, int]], total: Column, epochs: int, other: int = 1) -> DataFrame:
    """Leaves (``domain``, ``lang``, ``source``, ``tokens``) with their ``given`` tokens of ``total``.

    Budgets go down from domains to languages to sources. A node's capacity
    is ``epochs`` times the tokens below it, so a leaf's shortage is met by
    its siblings first, and only what they lack passes to its ancestors'
    siblings. Names without a weight have weight ``other``.
    """
    leaves = leaves.withColumn("capacity", F.col("tokens").cast("double") * epochs)
    above, parent = None, []
    for depth in range(len(LEVELS)):
        keys = LEVELS[: depth + 1]
        nodes = leaves.groupBy(*keys).agg(F.sum("capacity").alias("capacity"), F.sum("tokens").alias("tokens")).withColumn("weight", _weight(keys[-1], weights.get(keys[-1], {}), other))
        if above is None:
            whole = nodes.withColumn("tokens", F.sum("tokens").over(W.partitionBy()))
            nodes = whole.withColumn("budget", F.coalesce(total, F.lit(0)).cast("double"))
        else:
            nodes = nodes.join(above, parent)
        above = share_out(nodes, parent).select(*keys, F.col("given").alias("budget"))
        parent = keys
    return leaves.join(above, LEVELS).withColumnRenamed("budget", "given").drop("capacity")


def mix_sources(
    docs: DataFrame, domain: Column, weights: dict[str, dict[str, int]], percent: int = 70, epochs: int = 2, seed: int = 20, other: int = 1
) -> DataFrame:
    """``docs`` mixed to weights: its columns and ``epoch``, a row for every time a document is taken.

    The budget is ``percent`` of all tokens (:func:`word_count`). Every leaf
    (domain, lang, source) reads its documents in epochs, each in an own
    seeded order, and takes the prefix that begins below its budget, so it
    goes over by less than one document. An epoch's order is by md5 of seed,
    epoch and doc_id, then tokens, then md5 of the text. Nulls in domain,
    lang or source are named ``(none)``; null texts have no tokens and are
    taken wherever their turn comes; repeated rows are rows of their own; an
    empty table gives no rows. Columns of ``docs`` that begin with ``_`` and
    ``epoch`` are replaced.

    Only counts are shuffled. A leaf's order is cut in 4,096 slices by the
    digest's beginning; slices below the budget are taken whole, and only the
    slice in which it ends is sorted, so a leaf may hold any share of the rows.
    """
    names = [F.coalesce(c.cast("string"), F.lit("(none)")).alias(f"_{n}") for n, c in zip(LEVELS, (domain, F.col("lang"), F.col("source")), strict=True)]
    own = [f"_{n}" for n in LEVELS]
    ident = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    counted = keep(docs.select(ident.alias("_ident"), *names, word_count(F.col("text")).alias("_tokens")), "tokens")
    leaves = counted.groupBy(*[F.col(o).alias(n) for o, n in zip(own, LEVELS, strict=True)]).agg(F.sum("_tokens").alias("tokens"))
    given = leaf_budgets(keep(leaves, "leaves"), weights, F.floor(F.col("tokens") * percent / 100), epochs, other)
    # an epoch of a leaf without tokens is over at once
    whole = F.when(F.col("tokens") == 0, epochs).otherwise(F.least(F.floor(F.col("given") / F.col("tokens")), F.lit(epochs)))
    given = given.select(*[F.col(n).alias(o) for o, n in zip(own, LEVELS, strict=True)], whole.cast("int").alias("_whole"), F.greatest(F.col("given") - whole * F.col("tokens"), F.lit(0)).alias("_part"))
    given = keep(given, "budgets")

    def placed(df: DataFrame) -> DataFrame:
        key = F.md5(F.concat_ws("/", F.lit(str(seed)), F.col("_whole").cast("string"), F.col("_ident")))
        return df.join(given, own).withColumn("_key", key).withColumn("_slice", F.substring("_key", 1, 3))

    slices = placed(counted).groupBy(*own, "_slice", "_part").agg(F.sum("_tokens").alias("_n"))
    start = F.sum("_n").over(W.partitionBy(*own).orderBy("_slice")) - F.col("_n")
    last = slices.withColumn("_start", start).where("_start < _part").groupBy(*own).agg(F.max_by("_slice", "_slice").alias("_last"), F.max("_start").alias("_start"))
    last = keep(last, "slices")

    rows = placed(docs.select(*[c for c in docs.columns if not c.startswith("_") and c != "epoch"], ident.alias("_ident"), *names))
    rows = rows.join(last, own, "left")
    plain = [c for c in docs.columns if not c.startswith("_") and c != "epoch"]
    more = F.coalesce(F.col("_slice") < F.col("_last"), F.lit(False)).cast("int")
    sure = rows.where("_last is null or _slice <> _last").withColumn("_times", F.col("_whole") + more)
    edge = rows.where("_slice = _last").withColumn("_tokens", word_count(F.col("text")))
    order = W.partitionBy(*own).orderBy("_key", "_tokens", F.md5(F.coalesce(F.col("text"), F.lit(""))))
    begin = F.col("_start") + F.sum("_tokens").over(order.rowsBetween(W.unboundedPreceding, 0)) - F.col("_tokens")
    edge = edge.withColumn("_times", F.col("_whole") + (begin < F.col("_part")).cast("int"))
    taken = sure.select(*plain, "_times").unionByName(edge.select(*plain, "_times")).where("_times > 0")
    return taken.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("_times") - 1))).drop("_times")
