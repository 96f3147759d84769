"""Vocabularies of a corpus: tokens, stop words, lexicons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almoner.functions import text as tx
from almoner.operators.skew import keyed_join, widen


def tokens(text: Column, html: bool = False) -> Column:
    """Array of lower-case ASCII words of a text.

    Order matters: entities are decoded before tags go, so an escaped tag is
    dropped too; separators split words but other punctuation joins them.
    """
    if html:
        text = tx.html_to_text(tx.decode_entities(text))
    plain = tx.to_ascii(tx.drop_punct(tx.separators_to_space(text)))
    return tx.alpha_tokens(F.lower(plain))


def bag_of_words(
    df: DataFrame,
    text: str,
    stopwords: DataFrame | None = None,
    min_len: int = 0,
    html: bool = True,
    normalize_stopwords: bool = False,
) -> DataFrame:
    """Distinct terms of the whole input, strictly longer than ``min_len``.

    ``stopwords`` has a column ``word``. Terms are pure ASCII letters, so a
    listed word with an apostrophe or accent matches nothing unless
    ``normalize_stopwords`` passes the list through the same steps.
    """
    per_row = F.array_distinct(tokens(F.col(text), html))
    terms = (
        widen(df.select(text)).select(F.explode(per_row).alias("term"))
        .filter(tx.longer_than(F.col("term"), min_len))
        .distinct()
    )
    if stopwords is None:
        return terms
    if normalize_stopwords:
        stopwords = stopwords.select(F.explode(tokens(F.col("word"))).alias("word"))
    return remove_stopwords(terms, stopwords)


def remove_stopwords(terms: DataFrame, stopwords: DataFrame, term: str = "term") -> DataFrame:
    """Terms that are not, as a whole and case-sensitively, in the list."""
    listed = stopwords.select(F.col("word").alias(term)).distinct()
    return terms.join(listed, [term], "left_anti")


def known_terms(terms: DataFrame, lexicon: DataFrame, term: str = "term") -> DataFrame:
    """Terms found in a lexicon (column ``word``)."""
    known = lexicon.select(F.col("word").alias(term)).distinct()
    return keyed_join(terms, known, [term], "left_semi")


# Part-of-speech tags of the terms that carry weight.
TAGS = ["NN", "NNS", "POS", "VB", "VBD", "VBG", "VBN", "VBP", "VBZ"]


def keep_pos(tagged: DataFrame, pos: str = "pos") -> DataFrame:
    """Tokens whose tag is a common noun, possessive or verb."""
    return tagged.filter(F.col(pos).isin(TAGS))
