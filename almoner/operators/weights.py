"""Augmented term frequency and inverse document frequency."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almoner.functions import text as tx
from almoner.operators.skew import keyed_join, mark_maybe, widen
from almoner.operators.vocabulary import keep_pos, known_terms
from almoner.session import settle

#: Digests of repeated texts, about 20 MB of them, that are broadcast.
BROADCAST_COPIES = 400_000


def term_freq(
    df: DataFrame,
    doc: str,
    text: str,
    lexicon: DataFrame | None = None,
    min_len: int = 2,
) -> DataFrame:
    """``doc, term, f``: terms of the distinct texts of each document id.

    Letters outside ASCII vanish (they are not transliterated here); words of
    at most ``min_len`` letters, and words outside ``lexicon``, are dropped.
    """
    texts = widen(df.select(doc, text)).filter(F.col(doc).isNotNull() & F.col(text).isNotNull()).select(F.col(doc).alias("doc"), F.col(text).alias("text"))
    # the n copies of a text weigh one n-th each; they are told by a 128-bit digest
    digest = [F.xxhash64("text").alias("_d"), F.xxhash64(F.lit(1), "text").alias("_e")]
    told = texts.select("*", *digest)
    copies = settle(told.groupBy("doc", "_d", "_e").agg(F.count("*").alias("_n")).filter("_n > 1"))
    weighed = _weighed(told, copies, copies.count())
    words = tx.alpha_tokens(tx.drop_non_ascii(F.lower("text")))
    terms = weighed.select("doc", (1.0 / F.coalesce("_n", F.lit(1))).alias("_w"), F.explode(words).alias("term"))
    return _counted(terms, lexicon, min_len, F.round(F.sum("_w")).cast("bigint"))


def _weighed(told: DataFrame, copies: DataFrame, count: int) -> DataFrame:
    """Texts with ``_n``, the number of their copies if there are several.

    Texts stay where they are read: copies travel to them, up to BROADCAST_COPIES of them (counted). Beyond that only
    texts whose digest may be among them, by a bit map, are moved.
    """
    keys = ["doc", "_d", "_e"]
    if not count:
        return told.withColumn("_n", F.lit(1))
    if count <= BROADCAST_COPIES:
        return told.join(F.broadcast(copies), keys, "left")
    marked = mark_maybe(told, copies, "_d", "_copied")
    alone = marked.filter("not _copied").drop("_copied").withColumn("_n", F.lit(1).cast("bigint"))
    return alone.unionByName(keyed_join(marked.filter("_copied").drop("_copied"), copies, keys, "left"))


def term_freq_tagged(tagged: DataFrame, doc: str, token: str, pos: str, lexicon: DataFrame | None = None, min_len: int = 2) -> DataFrame:
    """The same for text that comes as tagged tokens, of which only ``keep_pos`` tags count."""
    kept = keep_pos(tagged, pos)
    words = tx.alpha_tokens(tx.drop_non_ascii(F.lower(token)))
    return _counted(kept.select(F.col(doc).alias("doc"), F.explode(words).alias("term")), lexicon, min_len)


def _counted(words: DataFrame, lexicon: DataFrame | None, min_len: int, count: Column | None = None) -> DataFrame:
    count = F.count("*") if count is None else count
    counted = words.filter(F.col("term").isNotNull() & tx.longer_than(F.col("term"), min_len)).groupBy("doc", "term").agg(count.alias("f"))
    return counted if lexicon is None else known_terms(counted, lexicon)


def augmented_tf(tf: DataFrame) -> DataFrame:
    """``doc, term, f, atf`` with ``atf = 0.5 + 0.5 f / max f`` of the document."""
    largest = tf.groupBy("doc").agg(F.max("f").alias("mtf"))
    joined = keyed_join(tf, largest, ["doc"])
    return joined.select("doc", "term", "f", (0.5 + F.col("f") * 0.5 / F.col("mtf")).alias("atf"))


def document_count(df: DataFrame, doc: str) -> DataFrame:
    """One row with the number of document ids, those without terms included."""
    return df.select(doc).distinct().agg(F.count(doc).alias("docs"))


def idf(tf: DataFrame, docs: DataFrame) -> DataFrame:
    """``term, df, idf`` with ``idf = log10(D / (1 + df))``; negative for a term in every document.

    ``tf`` has one row per document and term, ``docs`` is :func:`document_count`.
    """
    # asking for the counts keeps them in the plan, so this reads the same shuffle as the other uses of ``tf``
    counted = tf.filter("f > 0").groupBy("term").agg(F.count("*").alias("df"))
    return counted.withColumn("idf", F.log10(docs.scalar() / (1 + F.col("df"))))


def tfidf(df: DataFrame, doc: str, text: str, lexicon: DataFrame | None = None, min_len: int = 2) -> DataFrame:
    """``doc, term, f, atf, idf, tfidf`` for every document and term."""
    tf = term_freq(df, doc, text, lexicon, min_len)
    weights = idf(tf, document_count(df, doc))
    joined = keyed_join(augmented_tf(tf), weights, ["term"])
    return joined.select("doc", "term", "f", "atf", "idf", (F.col("atf") * F.col("idf")).alias("tfidf"))
