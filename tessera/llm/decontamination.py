"""Benchmark decontamination by winnowing.

Of every run of ``w`` consecutive k-gram hashes the smallest is kept, in documents and in
benchmark items alike, so any shared span of ``k + w - 1`` words (a window) shares a kept
hash: none is missed.  A bit table, sized by the number of items' hashes within fixed
limits, drops most document hashes that no item has; the rest are joined with the items'
hashes.  Each hit is extended: the windows around it, which travel along as word strings,
are joined with the items' distinct windows, so a match is exact, and a window's items are
looked up once for each document that holds it.  Items shorter than a window are one window
of their own length, matched by whole hashes of that length.

Edge cases: a null or empty text has no words and no hits; items without words are
ignored; repeated rows are judged row by row; empty tables give an empty result or no
hits; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tessera.llm import common
from tessera.llm.hashing import LETTERS, gram_hashes, word_hashes

WINDOW = 10
GRAM = 7
#: Bits of the table that screens document hashes for each hash of an item, and the limits of
#: its log2.  A table that fills lets more hashes through to the join; no result changes.
SCREEN_BITS = 16
SCREEN_LEAST, SCREEN_MOST = 20, 27


def words_of(raw: bytes) -> list[bytes]:
    return raw.translate(LETTERS).split()


def winnow(hashes: np.ndarray, w: int) -> np.ndarray:
    """Places of the rightmost smallest hash of each run of w hashes, each place once."""
    n = len(hashes) - w + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    best = np.arange(n, dtype=np.int64) + w - 1
    least = hashes[w - 1 :].copy()
    for j in range(w - 2, -1, -1):
        other = hashes[j : j + n]
        less = other < least
        least[less] = other[less]
        best[less] = np.flatnonzero(less) + j
    return np.unique(best)


def marks(h: np.ndarray, length: int, window: int, gram: int) -> np.ndarray:
    """Kept k-gram hashes for spans of ``length`` words: (places, hashes)."""
    if length == window:
        grams = gram_hashes(h, gram)
        at = winnow(grams, window - gram + 1)
        return at, grams[at]
    grams = gram_hashes(h, length)
    return np.arange(len(grams)), grams


def item_windows(window: int, gram: int):
    """Benchmark items as rows (item_id, length, window text, kept hashes of the window)."""

    def run(batches):
        for batch in batches:
            index, length, text, hashes = [], [], [], []
            raws = common.binary_texts(batch)
            for i, (raw, h) in enumerate(zip(raws, word_hashes(raws, LETTERS))):
                words = words_of(raw)
                if not words:
                    continue
                size = min(window, len(words))
                for j in range(len(words) - size + 1):
                    index.append(i)
                    length.append(size)
                    text.append(b" ".join(words[j : j + size]))
                    hashes.append(np.unique(marks(h[j : j + size], size, window, gram)[1].astype(np.int64)).tolist())
            ids = common.keep(batch, "item_id")[0].take(pa.array(index, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, pa.array(length, pa.int32()), pa.array(text, pa.binary()), pa.array(hashes, pa.list_(pa.int64()))], names=["item_id", "length", "win", "kept"])

    return run


def document_hits(screen, screen_bits: int, lengths: list[int], window: int, gram: int, id_name: str = "doc_id"):
    """Documents as rows with the hashes that the screen lets through, each with the windows
    around it."""
    hit_type = pa.list_(pa.struct([("hash", pa.int64()), ("length", pa.int32()), ("starts", pa.list_(pa.int32())), ("wins", pa.list_(pa.binary()))]))

    def run(batches):
        bits = np.frombuffer(screen.value, np.uint8)
        for batch in batches:
            n_words, hits = [], []
            raws = common.binary_texts(batch)
            for raw, h in zip(raws, word_hashes(raws, LETTERS)):
                n_words.append(len(h))
                found, words = [], None
                for length in lengths:
                    if len(h) < length:
                        continue
                    at, kept = marks(h, length, window, gram)
                    slot = (kept >> np.uint64(64 - screen_bits)).astype(np.int64)
                    passed = (bits[slot >> 3] >> (slot & 7) & 1).astype(bool)
                    if not passed.any():
                        continue
                    words = words or words_of(raw)
                    around = window - gram if length == window else 0
                    for p, value in zip(at[passed].tolist(), kept[passed].astype(np.int64).tolist()):
                        starts = list(range(max(p - around, 0), min(p, len(words) - length) + 1))
                        found.append({"hash": value, "length": length, "starts": starts, "wins": [b" ".join(words[s : s + length]) for s in starts]})
                hits.append(found)
            yield pa.RecordBatch.from_arrays([*common.keep(batch, id_name), pa.array(n_words, pa.int64()), pa.array(hits, hit_type)], names=[id_name, "n_words", "hits"])

    return common.released(run)


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """A row for each document: doc_id, n_words, n_hit, items (ids as strings, sorted)."""
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    item_kind = items.schema["item_id"].dataType.simpleString()
    wins = common.store(items.select("item_id", "text").mapInArrow(item_windows(window, gram), f"item_id {item_kind}, length int, win binary, kept array<long>"), "windows")
    lengths = sorted(r[0] for r in wins.select("length").distinct().collect())  # `window` rows at most
    prints = common.store(wins.select("length", F.explode("kept").alias("hash")).distinct(), "fingerprints")
    bits = min(SCREEN_MOST, max(SCREEN_LEAST, (SCREEN_BITS * prints.count()).bit_length()))
    screen = spark.sparkContext.broadcast(common.bit_table(prints.select(F.shiftrightunsigned("hash", 64 - bits).alias("p")), "p", bits))  # 2 ** SCREEN_MOST bits at most
    held = "array<struct<hash:long,length:int,starts:array<int>,wins:array<binary>>>"
    seen = docs.select("doc_id", "text").mapInArrow(document_hits(screen, bits, lengths, window, gram), f"doc_id {kind}, n_words long, hits {held}")
    seen = common.store(seen.withColumn("_row", F.monotonically_increasing_id()), "hits")
    # Fingerprints meet, and what is around those that do is compared word by word.
    hits = seen.select("_row", F.explode("hits").alias("h")).select("_row", "h.*").join(common.small(prints), ["length", "hash"], "left_semi")
    hits = hits.select("_row", "length", F.explode(F.arrays_zip("starts", "wins")).alias("w")).select("_row", "length", F.col("w.starts").alias("start"), F.col("w.wins").alias("win")).distinct()
    known = common.store(wins.select("length", "win").distinct().withColumn("window", F.monotonically_increasing_id()), "known")
    matched = common.store(hits.join(known, ["length", "win"]).select("_row", "start", "length", "window"), "matched")
    words = (
        matched.select("_row", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("length") - 1)).alias("p")).distinct()
        .groupBy("_row").agg(F.count("*").alias("n_hit"))
    )
    of = wins.join(known, ["length", "win"]).select("window", F.col("item_id").cast("string").alias("item")).distinct()
    which = matched.select("_row", "window").distinct().join(of, "window").select("_row", "item").distinct().groupBy("_row").agg(F.sort_array(F.collect_list("item")).alias("items"))
    out = seen.select("_row", "doc_id", "n_words").join(words, "_row", "left").join(which, "_row", "left")
    return out.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def op10_winnowing(spark, sf_dir: str) -> DataFrame:
    out = contamination(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
