"""Similarities of strings and token sets as column expressions.

Strings are compared without outer space and case (full case folding); a missing value is
like nothing, not even another missing one.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F

from tessera.functions.text import _column, casefold, char_ngrams, common_prefix, word_tokens



def is_blank(x) -> Column:
    x = _column(x)
    return x.isNull() | F.lower(F.trim(x)).isin("", "none", "nan", "null")


def folded(x, fold: bool = True) -> Column:
    """``fold`` false: the caller says that values are folded and trimmed already."""
    return casefold(F.trim(_column(x))) if fold else _column(x)


def exact(a, b, fold: bool = True) -> Column:
    """1 where both are present and equal."""
    a, b = _column(a), _column(b)
    return F.when(is_blank(a) | is_blank(b), 0.0).when(folded(a, fold) == folded(b, fold), 1.0).otherwise(0.0)


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(0.0)


def set_jaccard(a: Column, b: Column) -> Column:
    both = F.size(F.array_intersect(a, b))
    return _ratio(both, F.size(F.array_union(a, b)))


def set_overlap(a: Column, b: Column) -> Column:
    """Common share of the smaller set."""
    return _ratio(F.size(F.array_intersect(a, b)), F.least(F.size(F.array_distinct(a)), F.size(F.array_distinct(b))))


def distinct_hashes(x: Column) -> Column:
    """The distinct members of a token array as 64-bit numbers, which compare fast."""
    return F.array_distinct(F.transform(x, lambda t: F.xxhash64(t)))


def hashed_jaccard(a: Column, b: Column) -> Column:
    """Jaccard of arrays without repeats."""
    both = F.size(F.array_intersect(a, b))
    return _ratio(both, F.size(a) + F.size(b) - both)


def hashed_overlap(a: Column, b: Column) -> Column:
    """Common share of the smaller of two arrays without repeats."""
    return _ratio(F.size(F.array_intersect(a, b)), F.least(F.size(a), F.size(b)))


def set_dice(a: Column, b: Column) -> Column:
    a, b = F.array_distinct(a), F.array_distinct(b)
    return _ratio(2 * F.size(F.array_intersect(a, b)), F.size(a) + F.size(b))


def token_jaccard(a, b, fold: bool = True) -> Column:
    return set_jaccard(word_tokens(folded(a, fold)), word_tokens(folded(b, fold)))


def token_overlap(a, b, fold: bool = True) -> Column:
    return set_overlap(word_tokens(folded(a, fold)), word_tokens(folded(b, fold)))


def characters(x) -> Column:
    x = _column(x)
    return F.filter(F.split(x, ""), lambda c: c != "")


def char_set_jaccard(a, b) -> Column:
    """Jaccard of the sets of characters: the published baseline scores use it for names
    and addresses where a token Jaccard is described."""
    return F.when(is_blank(a) | is_blank(b), 0.0).otherwise(set_jaccard(characters(a), characters(b)))


def padded_ngrams(x, n: int = 3) -> Column:
    """Grams of the text between two bars; a text shorter than n is its own only gram."""
    x = _column(x)
    return F.when(F.length(x) < n, F.array(x)).otherwise(char_ngrams(F.concat(F.lit("_"), x, F.lit("_")), n))


def char_ngram_jaccard(a, b, n: int = 3, fold: bool = True) -> Column:
    return F.when(is_blank(a) | is_blank(b), 0.0).otherwise(set_jaccard(padded_ngrams(folded(a, fold), n), padded_ngrams(folded(b, fold), n)))


def levenshtein_similarity(a, b, fold: bool = True) -> Column:
    blank = is_blank(a) | is_blank(b)
    a, b = folded(a, fold), folded(b, fold)
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(blank, 0.0).otherwise(_ratio(longest - F.levenshtein(a, b), longest))


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(texts as rows of code points, lengths); rows are filled up with zeros."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    out = np.zeros((len(texts), int(lengths.max(initial=1))), np.uint32)
    flat = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    out[np.arange(out.shape[1]) < lengths[:, None]] = flat
    return out, lengths


def jaro_winkler_values(left: list[str], right: list[str]) -> np.ndarray:
    """Jaro similarity, with the bonus for a common beginning (at most four letters) above
    0.7, of many pairs at once.  Every letter of the left text takes the first free equal one
    within reach, so the loop runs over places, not over pairs."""
    a, la = code_points(left)
    b, lb = code_points(right)
    n, reach = len(left), np.maximum(np.maximum(la, lb) // 2 - 1, 0)
    free = np.arange(b.shape[1]) < lb[:, None]
    taken = np.zeros(b.shape, bool)
    matched = np.zeros(a.shape, bool)
    place, rows = np.arange(b.shape[1]), np.arange(n)
    for i in range(a.shape[1]):
        low, high = max(0, i - int(reach.max(initial=0))), min(b.shape[1], i + int(reach.max(initial=0)) + 1)
        if low >= high:
            break
        near = np.abs(place[low:high] - i) <= reach[:, None]
        fits = near & free[:, low:high] & (b[:, low:high] == a[:, i, None]) & (i < la)[:, None]
        hit = fits.any(1)
        at = low + fits.argmax(1)
        matched[:, i] = hit
        taken[rows[hit], at[hit]] = True
        free[rows[hit], at[hit]] = False
    m = matched.sum(1)
    turned = np.zeros(n, np.int64)
    # Matched letters in order on both sides, side by side.
    owner = np.repeat(rows, m)
    np.add.at(turned, owner, a[matched] != b[taken])
    with np.errstate(divide="ignore", invalid="ignore"):
        score = np.where(m > 0, (m / la + m / lb + (m - turned // 2) / m) / 3, 0.0)
    k = min(4, a.shape[1], b.shape[1])
    same = np.cumprod((a[:, :k] == b[:, :k]) & (np.arange(k) < np.minimum(la, lb)[:, None]), axis=1).sum(1)
    score = np.where(score > 0.7, score + 0.1 * same * (1 - score), score)
    return np.where([x == y for x, y in zip(left, right)], 1.0, score)


def jaro_winkler(a, b, fold: bool = True) -> Column:
    """Arrow batches; blank pairs are sent as nulls, equal pairs of a batch are computed once."""
    blank = is_blank(a) | is_blank(b)

    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        out = np.zeros(len(x))
        some = np.flatnonzero(x.notna().to_numpy() & y.notna().to_numpy())
        if len(some):
            pairs = pd.MultiIndex.from_arrays([x.to_numpy()[some], y.to_numpy()[some]])
            codes, distinct = pairs.factorize()
            left, right = distinct.get_level_values(0).tolist(), distinct.get_level_values(1).tolist()
            # Pairs of like length go together, so that rows are not filled up far.
            order = np.argsort([max(len(p), len(q)) for p, q in zip(left, right)], kind="stable")
            value = np.zeros(len(left))
            for start in range(0, len(order), 2000):
                part = order[start : start + 2000]
                value[part] = jaro_winkler_values([left[i] for i in part], [right[i] for i in part])
            out[some] = value[codes]
        return pd.Series(out)

    return F.when(blank, 0.0).otherwise(F.pandas_udf(run, "double")(F.when(~blank, folded(a, fold)), F.when(~blank, folded(b, fold))))


def prefix_ratio(a, b, fold: bool = True) -> Column:
    blank = is_blank(a) | is_blank(b)
    a, b = folded(a, fold), folded(b, fold)
    return F.when(blank, 0.0).otherwise(_ratio(common_prefix(a, b), F.greatest(F.length(a), F.length(b))))


def suffix_ratio(a, b, fold: bool = True) -> Column:
    return prefix_ratio(F.reverse(folded(a, fold)), F.reverse(folded(b, fold)), False)


def compare_field(a, b, fold: bool = True) -> dict[str, Column]:
    """exact, both present, one missing, both missing, as 0 or 1."""
    x, y = is_blank(a), is_blank(b)
    flag = lambda c: F.when(c, 1.0).otherwise(0.0)
    return {"exact": exact(a, b, fold), "both_present": flag(~x & ~y), "one_missing": flag(x != y), "both_missing": flag(x & y)}


def bigram_dice(a, b, fold: bool = True) -> Column:
    return F.when(is_blank(a) | is_blank(b), 0.0).otherwise(set_dice(char_ngrams(folded(a, fold), 2), char_ngrams(folded(b, fold), 2)))
