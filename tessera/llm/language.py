"""Language identification of mixed-language text.

A word's script (from Unicode ranges) narrows the candidate languages.  Each word gets a
log-likelihood for each candidate from a hashed model of its character 1- to 3-grams, and
Viterbi decoding with a penalty for each switch labels spans of words.  The document's
language is the one whose spans hold most letters.

If no stretch of words favours another language by more than the penalty (nor do a
document's start and end together), the constant path is the optimum, which running sums
show at once; only the other documents are decoded word by word.

The model is fitted on a bounded sample (PER_LANGUAGE documents of each language, by a
fixed hash of the id) of the training fold; every document is labelled on its whole text.

Edge cases: a null text or one without letters is `und` with score 0; without training
rows everything is `und`; repeated rows get equal labels; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tessera.llm import common, sampling

PER_LANGUAGE = 2000
#: log2 of the buckets of character grams.
GRAM_BITS = 17
PENALTY = 8.0
#: Groups in which tasks' counts (one table a language, of at most PER_LANGUAGE tasks) are
#: added up before the last step.
MERGE_PARTS = 48
#: Words that a worker remembers.
REMEMBERED = 250_000
#: Runs of letters and of signs of number (superscripts, fractions, numerals).
LETTERS = re.compile(r"[^\W\d_]+")


def words_in(text: str) -> list[str]:
    """Lower-cased runs of letters; signs of number are none."""
    found = LETTERS.findall(text.lower())
    if all(map(str.isalpha, found)):
        return found
    return "".join(c if c.isalpha() else " " for c in " ".join(found)).split()


# First code points of script ranges (Unicode blocks), in order.
SCRIPT_STARTS = np.array([0x0, 0x370, 0x400, 0x530, 0x590, 0x600, 0x900, 0x980, 0xE00, 0xE80, 0x10A0, 0x1100, 0x1200, 0x1E00, 0x1F00, 0x2000, 0x3040, 0x30A0, 0x3100, 0x3400, 0xAC00, 0xD7B0, 0xF900, 0xFB00])
SCRIPT_NAMES = ["latin", "greek", "cyrillic", "armenian", "hebrew", "arabic", "devanagari", "indic", "thai", "lao", "georgian", "hangul", "other", "latin", "greek", "other", "hiragana", "katakana", "other", "han", "hangul", "other", "han", "other"]
SCRIPTS = sorted(set(SCRIPT_NAMES))
SCRIPT_OF = np.array([SCRIPTS.index(s) for s in SCRIPT_NAMES])


def word_arrays(words: list[str]):
    """(gram buckets, starts of words in them, lengths, scripts) of non-empty words."""
    code = np.frombuffer("".join(f"\x02{w}\x03" for w in words).encode("utf-32-le"), "<u4").astype(np.uint64)
    lengths = np.array([len(w) for w in words])
    starts = np.cumsum(lengths + 2) - lengths - 2
    script = SCRIPT_OF[np.searchsorted(SCRIPT_STARTS, code[starts + 1].astype(np.int64), side="right") - 1]
    one = np.r_[code, 0, 0].astype(np.uint64)
    # A gram that would leave its word reads across the border; borders are marked, so such
    # grams (they hold 3 then 2) fall together into buckets that say little.
    a, b, c = one[:-2], one[1:-1], one[2:]
    mix = lambda x, salt: ((x * np.uint64(0x9E3779B97F4A7C15) + np.uint64(salt)) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - GRAM_BITS)
    grams = np.stack([mix(a, 1), mix(a << np.uint64(21) | b, 2), mix(a << np.uint64(42) | b << np.uint64(21) | c, 3)], axis=1).astype(np.int64)
    inside = np.stack([(a != 2) & (a != 3), a != 3, (a != 3) & (b != 3)], axis=1)
    return grams, inside, starts, lengths, script


def gram_count_rows(batches):
    """A task's gram and script counts of each language."""
    total: dict[str, np.ndarray] = {}
    scripts: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(common.strings(batch, "lang"), common.strings(batch)):
            words = words_in(text)
            if not words:
                continue
            grams, inside, _, lengths, script = word_arrays(words)
            if lang not in total:
                total[lang], scripts[lang] = np.zeros(1 << GRAM_BITS, np.int64), np.zeros(len(SCRIPTS), np.int64)
            total[lang] += np.bincount(grams[inside], minlength=1 << GRAM_BITS)
            scripts[lang] += np.bincount(script, weights=lengths, minlength=len(SCRIPTS)).astype(np.int64)
    names = list(total)
    yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([total[x].astype("<u4").tobytes() for x in names], pa.binary()), pa.array([scripts[x].tobytes() for x in names], pa.binary())], names=["lang", "grams", "scripts"])


def add_counts(key, table):
    grams, scripts = np.zeros(1 << GRAM_BITS, np.int64), np.zeros(len(SCRIPTS), np.int64)
    for g, s in zip(table.column("grams").to_pylist(), table.column("scripts").to_pylist()):
        grams += np.frombuffer(g, "<u4")
        scripts += np.frombuffer(s, np.int64)
    return pa.table({"lang": pa.array([key[0].as_py()], pa.string()), "grams": pa.array([grams.astype("<u4").tobytes()], pa.binary()), "scripts": pa.array([scripts.tobytes()], pa.binary())})


def fit(train: DataFrame, per_language: int = PER_LANGUAGE) -> dict | None:
    """Log-likelihoods of gram buckets and the languages each script may be."""
    train = train.filter("lang is not null and text is not null")
    n = {r.lang: r["count"] for r in train.groupBy("lang").count().collect()}  # one row a language
    if not n:
        return None
    bound = F.lit(0).cast("long")
    for lang, count in sorted(n.items()):
        bound = F.when(F.col("lang") == lang, F.lit(sampling.share(per_language, count))).otherwise(bound)
    sample = train.filter(sampling.place(3) < bound).select("lang", "text")
    # Tasks' counts are added up in two steps, so no task takes those of all others.
    counts = "lang string, grams binary, scripts binary"
    rows = sample.mapInArrow(gram_count_rows, counts).withColumn("part", F.pmod(F.spark_partition_id(), F.lit(MERGE_PARTS))).groupBy("lang", "part").applyInArrow(add_counts, counts).groupBy("lang").applyInArrow(add_counts, counts).collect()
    rows = sorted(rows, key=lambda r: r.lang)
    if not rows:
        return None
    grams = np.stack([np.frombuffer(r.grams, "<u4") for r in rows]).astype(np.float64)
    scripts = np.stack([np.frombuffer(r.scripts, np.int64) for r in rows]).astype(np.float64)
    total = grams.sum(1, keepdims=True)
    table = np.log((grams + 0.5) / (total + 0.5 * grams.shape[1]))
    table -= table.mean(0)  # only differences between languages matter
    allowed = (scripts / np.maximum(scripts.sum(1, keepdims=True), 1) >= 0.01).T
    allowed[~allowed.any(1)] = True
    return {"langs": [r.lang for r in rows], "table": np.ascontiguousarray(table.T.astype(np.float32)), "allowed": allowed}


class WordScores(dict):
    """Word -> row of scores and letters; new words are scored many at a time."""

    def __init__(self, model: dict):
        super().__init__()
        self.model, self.new = model, []
        self.scores = np.zeros((0, len(model["langs"])), np.float32)

    def __missing__(self, word: str) -> int:
        row = self[word] = len(self)
        self.new.append(word)
        return row

    def rows(self, words: list[str]) -> np.ndarray:
        if len(self) > REMEMBERED:
            self.clear()
            self.scores = self.scores[:0]
        at = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        if self.new:
            self.scores = np.concatenate([self.scores, self.score(self.new)])
            self.new = []
        return at

    def score(self, words: list[str]) -> np.ndarray:
        grams, inside, starts, _, script = word_arrays(words)
        n = len(self.model["langs"])
        value = np.zeros((len(grams), n), np.float32)
        for j in range(3):
            value += np.where(inside[:, j, None], self.model["table"][grams[:, j]], 0)
        out = np.add.reduceat(value, starts, axis=0)
        # A word's grams overlap, so its evidence counts a third, within limits.
        return np.where(self.model["allowed"][script], np.clip(out / 3, -12, 12), -1e4).astype(np.float32)


def viterbi(scores: np.ndarray, penalty: float) -> np.ndarray:
    """The best label of each word under a penalty for each switch."""
    n, k = scores.shape
    if not n:
        return np.zeros(0, np.int64)
    constant = int(scores.sum(0).argmax())
    gain = np.cumsum(scores - scores[:, constant : constant + 1], axis=0, dtype=np.float64)
    low = np.minimum.accumulate(np.vstack([np.zeros((1, k)), gain]), axis=0)[:-1]
    # No stretch gains more than a switch costs, and a start and an end together do not
    # either (a path without the constant label saves one switch): nothing beats it.
    if (gain - low).max() <= penalty and max(gain.max(), 0) + (gain[-1] - low[-1]).max() <= penalty:
        return np.full(n, constant)
    rows = scores.astype(np.float64).tolist()
    best = rows[0]
    came = []
    for row in rows[1:]:
        top = max(range(k), key=best.__getitem__)
        moved = best[top] - penalty
        came.append([j if b >= moved else top for j, b in enumerate(best)])
        best = [(b if b >= moved else moved) + x for b, x in zip(best, row)]
    at = max(range(k), key=best.__getitem__)
    out = [at]
    for row in reversed(came):
        at = row[at]
        out.append(at)
    return np.array(out[::-1])


def label_rows(model: dict | None, penalty: float, spans: bool, carried: list[str]):
    """Each document's language, score and, if wanted, its spans (language, words)."""
    span_type = pa.list_(pa.struct([("lang", pa.string()), ("first_word", pa.int32()), ("n_words", pa.int32())]))

    def run(batches):
        known = WordScores(model) if model else None
        for batch in batches:
            texts = common.strings(batch)
            langs, scores, found = [], [], []
            split = [words_in(t) for t in texts] if model else [[] for _ in texts]
            at = known.rows([w for words in split for w in words]) if model else None
            a = 0
            for words in split:
                b = a + len(words)
                if a == b:
                    langs.append("und")
                    scores.append(0.0)
                    found.append([])
                    continue
                value = known.scores[at[a:b]]
                a = b
                path = viterbi(value, penalty)
                letters = np.bincount(path, weights=[len(w) for w in words], minlength=len(model["langs"]))
                top = int(letters.argmax())
                total = value[path == top].sum(0, dtype=np.float64)
                sure = 1 / np.exp(np.clip(total - total[top], -60, 0)).sum()
                langs.append(model["langs"][top])
                scores.append(float(letters[top] / letters.sum() * sure))
                if spans:
                    begin = np.flatnonzero(np.r_[True, path[1:] != path[:-1]])
                    found.append([{"lang": model["langs"][path[i]], "first_word": int(i), "n_words": int(j - i)} for i, j in zip(begin, [*begin[1:], len(path)])])
            arrays = [*common.keep(batch, *carried), pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
            names = [*carried, "lang_pred", "score"]
            if spans:
                arrays.append(pa.array(found, span_type))
                names.append("spans")
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return common.released(run)


def identified(docs: DataFrame, model: dict | None, penalty: float = PENALTY, spans: bool = True) -> DataFrame:
    """Documents' id and fold with language, score and labelled spans."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    more = ", spans array<struct<lang:string,first_word:int,n_words:int>>" if spans else ""
    return docs.select("doc_id", "held_out", "text").mapInArrow(label_rows(model, penalty, spans, ["doc_id", "held_out"]), f"doc_id {kind}, held_out boolean, lang_pred string, score double{more}")


def op3_viterbi_language(spark, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").withColumn("held_out", common.fold("doc_id", 5) == 0)
    return identified(docs, fit(docs.filter("not held_out").select("doc_id", "lang", "text"))).withColumn("n_spans", F.size("spans")).drop("spans")
