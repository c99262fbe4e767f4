"""Bounded samples of labelled rows for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

SPACE = 1 << 30


def place(salt: int) -> Column:
    """A fixed number from 0 to SPACE - 1 for each id."""
    return F.pmod(F.xxhash64(F.col("doc_id"), F.lit(salt)), F.lit(SPACE))


def share(n: int, of: int) -> int:
    """The bound below which about n of ``of`` ids have their place."""
    return SPACE if of <= n else int(SPACE * n / of)


def one_an_id(docs: DataFrame) -> DataFrame:
    """(doc_id, text): one text an id, the smallest, so a repeated id cannot fill a sample."""
    return docs.groupBy("doc_id").agg(F.min("text").alias("text"))


def labelled(docs: DataFrame, labels: DataFrame, column: str, value: int, n: int, salt: int) -> DataFrame:
    """About n documents whose label is ``value``.  Both tables are cut by the same places
    before they meet, so the broadcast side has about n rows whatever the tables hold; a
    repeated id counts once."""
    some = labels.filter(F.col(column) == value).select("doc_id")
    bound = share(n, some.distinct().count())
    chosen = some.filter(place(salt) < bound).distinct()
    return one_an_id(docs.filter(place(salt) < bound).join(F.broadcast(chosen), "doc_id", "left_semi"))
