"""Exact-match word search."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.ordered import names

def find_exact(df: DataFrame, word: str, literal: str, order) -> DataFrame:
    """The first row along ``order`` whose word equals ``literal``; empty if there is none."""
    return df.filter(F.col(word) == literal).orderBy(*names(order)).limit(1)


def word_hits(corpus: DataFrame, queries: DataFrame, word: str = "word") -> DataFrame:
    """Every distinct query word with whether the corpus has it."""
    asked = queries.select(word).distinct()
    have = _seen(corpus, asked, word).select(F.col(word).alias("_w"))
    joined = asked.join(have, F.col(word) == F.col("_w"), "left")
    return joined.select(word, F.col("_w").isNotNull().alias("found"))


def occurring(corpus: DataFrame, queries: DataFrame, word: str = "word") -> DataFrame:
    """The distinct query words that the corpus has."""
    return _seen(corpus, queries.select(word).distinct(), word)


def missing(corpus: DataFrame, queries: DataFrame, word: str = "word") -> DataFrame:
    """The distinct query words that the corpus lacks."""
    asked = queries.select(word).distinct()
    return asked.join(_seen(corpus, asked, word), word, "left_anti")


def _seen(corpus: DataFrame, asked: DataFrame, word: str) -> DataFrame:
    """The asked words of the corpus. The corpus meets the asked words before it is made distinct, so its other
    words are never shuffled when Spark can broadcast the asked ones."""
    return corpus.select(word).join(asked, word, "left_semi").distinct()
