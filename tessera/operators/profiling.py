"""Profiles, ground-truth analysis, variation of linked pairs, rule derivation, diagnostics."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F

from tessera.functions import similarity as S
from tessera.functions.text import alnum_tokens, char_ngrams, collapse_whitespace
from tessera.operators.blocking import ANCHOR, CANDIDATE

# Worker functions travel by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules["tessera.operators"])

# The pattern battery.
PATTERNS = {
    "ampersand": r"&", "word_and": r"\band\b", "period": r"\.", "comma": r",", "hyphen": r"-", "slash": r"/", "apostrophe": r"'", "parenthesis": r"[()]", "hash": r"#", "ampersand_word": r"\bW\b",
    "dba": r"\bd\.?b\.?a\.?\b", "underscore": r"_", "percent": r"%", "at_sign": r"@", "double_space": r"  ", "leading_space": r"^ ", "trailing_space": r" $", "non_ascii": r"[^\x00-\x7f]",
    "control_character": r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x{9f}]", "zero_width": r"[\x{200b}-\x{200f}\x{202a}-\x{202e}\x{2060}-\x{2064}\x{feff}]", "has_digit": r"[0-9]", "digit_run_6_plus": r"[0-9]{6,}", "newline": r"[\r\n]", "tab_inside_value": r"\t",
    "email_like": r"[\p{L}\p{N}_.+-]+@[\p{L}\p{N}_-]+\.[\p{L}\p{N}_.]+", "phone_like": r"\+[0-9][0-9\s().-]{6,}[0-9]", "us_zip_like": r"\b[0-9]{5}(?:-[0-9]{4})?\b", "numeric_zip_like": r"\b[0-9]{6}\b",
    "street_designator": r"\b(?:st|str|street|rd|road|ave|av|avenue|blvd|boulevard|dr|drive|ln|lane|ct|court|cir|circle|pl|place|pkwy|parkway|hwy|highway|aly|alley|ter|terrace|trl|trail|way|pkg|plz|plaza|square|sq|gt|ground|nr|number|sec|section)\b\.?",
    "unit_marker": r"\b(?:apt|apartment|suite|ste|unit|flat|rm|room|fl|floor|flr|bldg|building|shop|office|opp|opposite|near|behind|beside|next)\b\.?",
    "direction": r"\b(?:north|south|east|west|ne|nw|se|sw|n|s|e|w)\b\.?",
}
# Scripts by ranges of code points, in the order of their labels.
SCRIPTS = (("kana", 0x3040, 0x30FF), ("hangul", 0xAC00, 0xD7AF), ("cjk", 0x4E00, 0x9FFF), ("cyrillic", 0x0400, 0x04FF), ("greek", 0x0370, 0x03FF), ("arabic", 0x0600, 0x06FF), ("devanagari", 0x0900, 0x097F), ("latin_extended", 0x00C0, 0x024F))


def unpivot(df: DataFrame, columns: list[str], *keys: str) -> DataFrame:
    """Rows (keys, column, value) of the named columns as text, in one pass."""
    return df.select(*keys, F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])).alias("x")).select(*keys, "x.*")


def column_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows, nulls, distinct and repeated values, and lengths of each column.  Values are
    counted once each first, so a frequent value costs one row."""
    counts = unpivot(df, columns).groupBy("column", "value").agg(F.count("*").alias("n"))
    n, v = F.col("n"), F.col("value")
    return counts.groupBy("column").agg(
        F.sum("n").alias("rows"), F.coalesce(F.sum(F.when(v.isNull(), n)), F.lit(0)).alias("nulls"), F.count("value").alias("distinct_values"),
        F.coalesce(F.sum(F.when(v.isNotNull() & (n > 1), n - 1)), F.lit(0)).alias("duplicates"), F.min(F.length(v)).alias("min_length"), F.max(F.length(v)).alias("max_length"),
        F.round(F.sum(F.length(v) * n) / F.sum(F.when(v.isNotNull(), n)), 6).alias("mean_length"),
    )


def top_values(df: DataFrame, columns: list[str], k: int = 25) -> DataFrame:
    counts = unpivot(df, columns).filter("value is not null").groupBy("column", "value").agg(F.count("*").alias("n"))
    rank = Window.partitionBy("column").orderBy(F.desc("n"), "value")
    return counts.withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= k)


def word_edges(pattern: str, before: str = r"(?<![\p{L}\p{N}_])", after: str = r"(?![\p{L}\p{N}_])") -> str:
    """Word borders spelled out, so that letters beyond ASCII count as letters."""
    if not pattern.startswith(r"\b"):
        return pattern
    body = pattern[2:].removesuffix(r"\.?")
    return before + body.removesuffix(r"\b").removesuffix(r"\.?") + after


def pattern_counts(df: DataFrame, column: str, patterns: dict[str, str] | None = None) -> DataFrame:
    """Rows that match each pattern, in one pass."""
    patterns = patterns or PATTERNS
    row = df.agg(*[F.coalesce(F.sum(F.col(column).rlike(word_edges(p)).cast("long")), F.lit(0)).alias(k) for k, p in patterns.items()])
    return row.select(F.explode(F.array(*[F.struct(F.lit(k).alias("pattern"), F.col(k).alias("n")) for k in patterns])).alias("x")).select("x.*")


def repeated_rows(df: DataFrame, *columns: str) -> DataFrame:
    """One row: rows, and rows that repeat an earlier one (in all columns or those named)."""
    by = list(columns) or df.columns
    return df.groupBy(*by).agg(F.count("*").alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("repeated"))


def case_profile(df: DataFrame, column: str) -> DataFrame:
    x = F.col(column)
    count = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0))
    return df.agg(count(x == F.upper(x)).alias("all_upper"), count(x == F.lower(x)).alias("all_lower"), count(x != F.lower(x)).alias("has_upper"), count(x != F.upper(x)).alias("has_lower"), count(x.rlike("[0-9]")).alias("has_digit"), count(F.trim(x) == "").alias("is_blank_like"))


def script_label(x: Column) -> Column:
    parts = [F.when(x.rlike(f"[\\x{{{a:x}}}-\\x{{{b:x}}}]"), name) for name, a, b in SCRIPTS]
    return F.coalesce(F.nullif(F.concat_ws("+", *parts), F.lit("")), F.lit("ascii_or_common"))


def script_profile(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull()).groupBy(script_label(F.col(column)).alias("script")).agg(F.count("*").alias("n"))


def identifier_profile(df: DataFrame, column: str) -> DataFrame:
    """Ids by the prefix before the first separator: rows, distinct, non-numeric bodies."""
    prefix = F.regexp_extract(column, r"^([^-#]*)[-#]", 1)
    body = F.regexp_extract(column, r"[-#](.*)$", 1)
    return df.groupBy(prefix.alias("prefix")).agg(F.count("*").alias("rows"), F.countDistinct(column).alias("distinct_ids"), F.sum((~body.rlike("^[0-9]+$")).cast("long")).alias("non_numeric"), F.min(F.length(column)).alias("min_length"), F.max(F.length(column)).alias("max_length"))


def length_histogram(df: DataFrame, column: str, width: int = 50) -> DataFrame:
    return df.filter(F.col(column).isNotNull()).groupBy((F.floor(F.length(column) / width) * width).alias("from_length")).agg(F.count("*").alias("n"))


def token_frequencies(df: DataFrame, column: str, k: int = 50) -> DataFrame:
    """Most frequent tokens anywhere, first and last."""
    t = F.regexp_extract_all(F.lower(column), F.lit("([a-z0-9]+)"), 1)
    rows = df.select(t.alias("t")).filter(F.size("t") > 0).select(F.explode(F.concat(F.transform("t", lambda x: F.struct(F.lit("any").alias("place"), x.alias("token"))), F.array(F.struct(F.lit("first").alias("place"), F.col("t")[0].alias("token")), F.struct(F.lit("last").alias("place"), F.element_at("t", -1).alias("token"))))).alias("x")).select("x.*")
    counts = rows.groupBy("place", "token").agg(F.count("*").alias("n"))
    return counts.withColumn("rank", F.row_number().over(Window.partitionBy("place").orderBy(F.desc("n"), "token"))).filter(F.col("rank") <= k)


def component_histogram(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull()).groupBy((F.regexp_count(column, F.lit(",")) + 1).alias("components")).agg(F.count("*").alias("n"))


def truth_edges(truth: DataFrame) -> DataFrame:
    """Ground truth lists as edges; an empty list is a singleton without edges."""
    ids = F.filter(F.transform(F.split(F.coalesce("matched_entity_ids", F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != "")
    return truth.select(ANCHOR, F.explode(ids).alias(CANDIDATE))


def truth_analysis(truth: DataFrame) -> DataFrame:
    """One row: list sizes, singletons, contributions by prefix, repeated and malformed ids."""
    ids = F.filter(F.split(F.coalesce("matched_entity_ids", F.lit("")), ","), lambda x: F.trim(x) != "")
    t = truth.select(ANCHOR, F.coalesce("matched_entity_ids", F.lit("")).alias("raw"), ids.alias("ids"), F.size(ids).alias("n"))
    count = lambda c: F.sum(c.cast("long"))
    return t.agg(
        F.count("*").alias("rows"), F.countDistinct(ANCHOR).alias("distinct_anchors"), count(F.col("n") == 0).alias("singletons"), count(F.col("n") == 1).alias("one_match"), count(F.col("n") > 1).alias("many_matches"), F.sum("n").alias("pairs"), F.max("n").alias("most"),
        F.round(F.avg("n"), 6).alias("mean"), F.sum(F.size(F.filter("ids", lambda x: x.startswith("S2-")))).alias("from_s2"), F.sum(F.size(F.filter("ids", lambda x: x.startswith("S3-")))).alias("from_s3"), count(F.size("ids") > F.size(F.array_distinct("ids"))).alias("lists_with_repeats"),
        count(F.col("ids") != F.array_sort("ids")).alias("unsorted_lists"), count(F.col("raw").rlike(r"\s")).alias("lists_with_space"), count(F.col("raw").rlike("^,|,$|,,")).alias("lists_with_edge_separators"), F.sum(F.size(F.filter("ids", lambda x: ~x.rlike("^S[0-9]+-[0-9]+$")))).alias("malformed"),
    )


def truth_reuse(truth: DataFrame) -> DataFrame:
    """How many anchors share a matched id."""
    per = truth_edges(truth).groupBy(CANDIDATE).agg(F.countDistinct(ANCHOR).alias("anchors"))
    return per.groupBy("anchors").agg(F.count("*").alias("candidates"))


def resolve_ids(truth: DataFrame, known: DataFrame) -> DataFrame:
    """Matched ids by prefix: how many are known records and how many are missing."""
    e = truth_edges(truth).select(CANDIDATE).distinct().join(known.select(F.col("entity_id").alias(CANDIDATE)).distinct().withColumn("known", F.lit(1)), CANDIDATE, "left")
    return e.groupBy(F.split_part(F.col(CANDIDATE), F.lit("-"), F.lit(1)).alias("prefix")).agg(F.count("*").alias("ids"), F.coalesce(F.sum("known"), F.lit(0)).alias("known"), F.sum(F.col("known").isNull().cast("long")).alias("missing"))


def coverage(truth: DataFrame, anchors: DataFrame) -> DataFrame:
    """Anchors without a truth row and truth rows without an anchor."""
    a, t = anchors.select(F.col("entity_id").alias(ANCHOR)).distinct(), truth.select(ANCHOR).distinct()
    lacking = a.join(t, ANCHOR, "left_anti").agg(F.count("*").alias("anchors_without_truth"))
    return lacking.crossJoin(t.join(a, ANCHOR, "left_anti").agg(F.count("*").alias("truth_without_anchor")))


def key_overlap(records: DataFrame, key: Column) -> DataFrame:
    """Distinct normalised keys shared by sources, pairwise."""
    r = records.select(F.split_part("entity_id", F.lit("-"), F.lit(1)).alias("source"), key.alias("key")).filter("key is not null").distinct()
    held = r.groupBy("key").agg(F.array_sort(F.collect_set("source")).alias("s"))  # a source or two each
    pairs = F.filter(F.flatten(F.transform("s", lambda a: F.transform("s", lambda b: F.struct(a.alias("source_a"), b.alias("source_b"))))), lambda p: p["source_a"] < p["source_b"])
    return held.select(F.explode(pairs).alias("p")).groupBy("p.source_a", "p.source_b").agg(F.count("*").alias("shared_keys"))


def variation_flags(left: Column, right: Column) -> dict[str, Column]:
    """What differs between two values of a linked pair."""
    a, b = F.lower(left), F.lower(right)
    wa, wb = collapse_whitespace(a), collapse_whitespace(b)
    ta, tb = alnum_tokens(wa), alnum_tokens(wb)
    marks = lambda x: F.array_sort(F.array_distinct(F.regexp_extract_all(x, F.lit(r"([^\p{L}\p{N}\s])"), 1)))
    numbers = lambda x: F.array_sort(F.array_distinct(F.regexp_extract_all(x, F.lit("([0-9]+)"), 1)))
    ca, cb = F.array_join(ta, ""), F.array_join(tb, "")
    both = ~S.is_blank(left) & ~S.is_blank(right)
    differ = both & (left != right)
    return {
        "missing_on_one_side": S.is_blank(left) != S.is_blank(right), "identical": both & (left == right), "case": differ & (a != b), "whitespace": differ & (a != b) & (wa == wb), "punctuation": differ & (marks(wa) != marks(wb)),
        "token_reordering": differ & (ta == tb), "token_order": differ & (ta != tb) & (F.array_sort(ta) == F.array_sort(tb)), "spelling_variation": differ & (ca != cb) & (S.bigram_dice(ca, cb) >= 0.72), "numeric_component": differ & (numbers(left) != numbers(right)),
    }


#: What pairs compare of a value, as 64-bit hashes, but for flags and the text that gives grams.
FORMS = ("blank", "raw", "lower", "spaced", "marks", "tokens", "sorted", "joined", "numbers", "joined_blank", "text")


def variation_forms(df: DataFrame, value: str, mark: str) -> DataFrame:
    """The table with what ``variation_flags`` derives of a value, computed once a row, as
    ``mark_*``.  In steps, since a lambda evaluates what stands in it for every member."""
    name = lambda x: f"{mark}_{x}"
    sorted_marks = lambda x, pattern: F.array_sort(F.array_distinct(F.regexp_extract_all(x, F.lit(pattern), 1)))
    df = df.withColumn("_spaced", collapse_whitespace(F.lower(value))).withColumn("_tokens", alnum_tokens("_spaced")).withColumn("_joined", F.array_join("_tokens", ""))
    x = F.col(value)
    forms = {
        "blank": S.is_blank(x), "raw": F.xxhash64(x), "lower": F.xxhash64(F.lower(x)), "spaced": F.xxhash64("_spaced"), "marks": F.xxhash64(sorted_marks(F.col("_spaced"), r"([^\p{L}\p{N}\s])")), "tokens": F.xxhash64("_tokens"), "sorted": F.xxhash64(F.array_sort("_tokens")),
        "joined": F.xxhash64("_joined"), "numbers": F.xxhash64(sorted_marks(x, "([0-9]+)")), "joined_blank": S.is_blank(F.col("_joined")), "text": S.folded(F.col("_joined")),
    }
    return df.withColumns({name(k): v for k, v in forms.items()}).drop("_spaced", "_tokens", "_joined")


def with_grams(df: DataFrame, mark: str) -> DataFrame:
    return df.withColumn(f"{mark}_grams", S.distinct_hashes(char_ngrams(f"{mark}_text", 2)))


def variation_counts_of_forms(pairs: DataFrame) -> DataFrame:
    """Pairs with both values' forms and grams (a_*, c_*): count of each category of variation."""
    unlike = lambda x: F.col(f"a_{x}") != F.col(f"c_{x}")
    p = pairs.withColumn("_both", ~F.col("a_blank") & ~F.col("c_blank")).withColumn("_differ", F.col("_both") & unlike("raw"))
    p = p.withColumn("_common", F.size(F.array_intersect("a_grams", "c_grams"))).withColumn("_all", F.size("a_grams") + F.size("c_grams"))
    dice = F.when(F.col("a_joined_blank") | F.col("c_joined_blank") | (F.col("_all") <= 0), 0.0).otherwise(2 * F.col("_common") / F.col("_all"))
    differ = F.col("_differ")
    flags = {
        "missing_on_one_side": F.col("a_blank") != F.col("c_blank"), "identical": F.col("_both") & ~unlike("raw"), "case": differ & unlike("lower"), "whitespace": differ & unlike("lower") & ~unlike("spaced"), "punctuation": differ & unlike("marks"),
        "token_reordering": differ & ~unlike("tokens"), "token_order": differ & unlike("tokens") & ~unlike("sorted"), "spelling_variation": differ & unlike("joined") & (dice >= 0.72), "numeric_component": differ & unlike("numbers"),
    }
    row = p.agg(*[F.coalesce(F.sum(F.coalesce(v, F.lit(False)).cast("long")), F.lit(0)).alias(k) for k, v in flags.items()])
    return row.select(F.explode(F.array(*[F.struct(F.lit(k).alias("category"), F.col(k).alias("n")) for k in flags])).alias("x")).select("x.*")


def variation_counts(pairs: DataFrame, field: str) -> DataFrame:
    """Pairs with records (a_*, c_*): count of each category of variation."""
    for mark in "ac":
        pairs = with_grams(variation_forms(pairs, f"{mark}_{field}", mark), mark)
    return variation_counts_of_forms(pairs)


def derive_trailing(df: DataFrame, column: str, support: int = 100) -> DataFrame:
    """Trailing tokens with enough support: candidates for legal suffixes."""
    t = F.regexp_extract_all(F.lower(column), F.lit("([a-z0-9]+)"), 1)
    return df.select(t.alias("t")).filter(F.size("t") > 1).groupBy(F.element_at("t", -1).alias("token")).agg(F.count("*").alias("n")).filter(F.col("n") >= support)


def derive_designators(df: DataFrame, column: str, support: int = 100) -> DataFrame:
    """Tokens that follow a number, with enough support: candidates for designators."""
    t = F.regexp_extract_all(F.lower(column), F.lit("([a-z0-9]+)"), 1)
    after = F.filter(F.transform(F.sequence(F.lit(2), F.greatest(F.size("t"), F.lit(2))), lambda i: F.when(F.get("t", i - 2).rlike("^[0-9]+$"), F.get("t", i - 1))), lambda x: x.isNotNull())
    return df.select(t.alias("t")).filter(F.size("t") > 1).select(F.explode(after).alias("token")).filter(~F.col("token").rlike("^[0-9]+$")).groupBy("token").agg(F.count("*").alias("n")).filter(F.col("n") >= support)


def normalization_diagnostics(df: DataFrame, raw: str, normalized: str) -> DataFrame:
    """Changed, emptied and colliding values of a normalisation, in one row."""
    r, x = F.col(raw), F.coalesce(F.col(normalized), F.lit(""))
    by = df.filter(r.isNotNull()).groupBy(x.alias("norm")).agg(F.count("*").alias("n"), F.sum((r != x).cast("long")).alias("changed"), F.countDistinct(r).alias("raws"))
    return by.agg(F.sum("n").alias("rows"), F.sum("changed").alias("changed"), F.coalesce(F.sum(F.when(F.col("norm") == "", F.col("n"))), F.lit(0)).alias("emptied"), F.count("*").alias("distinct_values"), F.sum((F.col("n") > 1).cast("long")).alias("collisions"), F.sum((F.col("raws") > 1).cast("long")).alias("merged_values"))


def normalization_report(df: DataFrame, raw: str, normalized: str, least_share: float = 0.4) -> DataFrame:
    """A normalisation in one row: rows, non-empty, changed, emptied and over-shortened values,
    lengths and words, distinct values before and after, collisions."""
    r, x = F.coalesce(F.col(raw), F.lit("")), F.coalesce(F.col(normalized), F.lit(""))
    held = F.trim(r) != ""
    count = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0))
    words = F.size(F.filter(F.split(x, r"\s+"), lambda w: w != ""))
    shape = df.agg(
        F.count("*").alias("rows"), count(held).alias("raw_non_empty"), count(held & (r != x)).alias("changed"), count(held & (F.trim(x) == "")).alias("emptied"), count(held & (F.length(x) < F.length(r) * least_share)).alias("over_normalized"),
        F.avg(F.when(held, F.length(r))).alias("mean_raw_length"), F.avg(F.when(held, F.length(x))).alias("mean_normalized_length"), F.avg(words).alias("mean_words"), F.coalesce(F.max(words), F.lit(0)).alias("most_words"), F.coalesce(F.min(words), F.lit(0)).alias("least_words"),
    )
    values = df.filter(held).groupBy(x.alias("x")).agg(F.count("*").alias("n"))
    after = values.agg(F.count("*").alias("normalized_distinct"), F.coalesce(F.sum((F.col("n") > 1).cast("long")), F.lit(0)).alias("collision_groups"), F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("collision_values"))
    before = df.filter(held).agg(F.countDistinct(r).alias("raw_distinct"))
    share = lambda a, b: F.when(F.col(b) > 0, 100 * F.col(a) / F.col(b)).otherwise(0.0)
    return shape.crossJoin(before).crossJoin(after).withColumn("changed_percent", share("changed", "raw_non_empty")).withColumn("emptied_percent", share("emptied", "raw_non_empty"))  # one row each


def normalization_examples(df: DataFrame, raw: str, normalized: str, k: int = 8) -> DataFrame:
    """The first changed values by their text: (raw, normalized)."""
    return df.filter(F.col(raw) != F.coalesce(normalized, F.lit(""))).select(F.col(raw).alias("raw"), F.col(normalized).alias("normalized")).distinct().orderBy("raw", "normalized").limit(k)


def collision_examples(df: DataFrame, raw: str, normalized: str, k: int = 5) -> DataFrame:
    """Normalised values that stand for most raw values, with how many."""
    held = df.filter((F.col(normalized) != "") & F.col(raw).isNotNull()).groupBy(F.col(normalized).alias("normalized")).agg(F.countDistinct(raw).alias("raws"))
    return held.filter("raws > 1").orderBy(F.desc("raws"), "normalized").limit(k)


def summarize(reports: DataFrame) -> DataFrame:
    """Reports of several columns rolled up into one row."""
    total = reports.agg(F.count("*").alias("fields"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("rows", "raw_non_empty", "changed", "emptied", "collision_groups", "over_normalized")])
    share = lambda a: F.when(F.col("raw_non_empty") > 0, F.round(100 * F.col(a) / F.col("raw_non_empty"), 4)).otherwise(0.0)
    return total.withColumn("changed_percent", share("changed")).withColumn("emptied_percent", share("emptied"))


# Legal forms, address words and street words that the quick profile counts.
QUICK_LEGAL = ("LLC", "Inc", "Corp", "Ltd", "LLP", "LP", "PC", "PLLC", "Private Limited", "Pvt Ltd")
QUICK_ADDRESS = ("Apt", "Apartment", "Suite", "Unit", "Floor")
QUICK_STREETS = ("St", "Street", "Ave", "Avenue", "Rd", "Road", "Blvd", "Drive")


def quick_noise(records: DataFrame) -> DataFrame:
    """Noise flags of names and addresses by source: rows (source, flag, n), one pass."""
    n, a = F.col("business_name"), F.col("business_address")
    word = lambda x, w: x.rlike(f"(?i)(?<![\\p{{L}}\\p{{N}}_]){w}(?![\\p{{L}}\\p{{N}}_])")
    title = n == F.initcap(n)
    flags = {f"name_{k}": n.rlike(PATTERNS[v]) for k, v in (("ampersand", "ampersand"), ("period", "period"), ("comma", "comma"), ("hyphen", "hyphen"), ("digits", "has_digit"), ("parentheses", "parenthesis"), ("apostrophe", "apostrophe"), ("double_space", "double_space"), ("leading_space", "leading_space"), ("trailing_space", "trailing_space"), ("tab", "tab_inside_value"), ("non_ascii", "non_ascii"))}
    flags |= {"name_and": word(n, "and"), "name_all_upper": n == F.upper(n), "name_all_lower": n == F.lower(n), "name_title_case": title, "name_mixed_case": (n != F.upper(n)) & (n != F.lower(n)) & ~title}
    flags |= {f"legal_{w.lower().replace(' ', '_')}": word(n, w) for w in QUICK_LEGAL}
    flags |= {"address_hash": a.contains("#"), "address_comma": a.contains(","), "address_semicolon": a.contains(";"), "address_non_ascii": a.rlike(PATTERNS["non_ascii"])}
    flags |= {f"address_{w.lower()}": word(a, w) for w in QUICK_ADDRESS} | {f"street_{w.lower()}": word(a, w) for w in QUICK_STREETS}
    row = records.groupBy(F.split_part("entity_id", F.lit("-"), F.lit(1)).alias("source")).agg(*[F.coalesce(F.sum(v.cast("long")), F.lit(0)).alias(k) for k, v in flags.items()])
    return row.select("source", F.explode(F.array(*[F.struct(F.lit(k).alias("flag"), F.col(k).alias("n")) for k in flags])).alias("x")).select("source", "x.*")


def quick_sources(records: DataFrame) -> DataFrame:
    """Rows, distinct ids, missing values and repeated rows of each source."""
    held = records.withColumn("source", F.split_part("entity_id", F.lit("-"), F.lit(1)))
    miss = lambda c: F.sum(F.col(c).isNull().cast("long")).alias(f"null_{c}")
    rows = held.groupBy("source").agg(F.count("*").alias("rows"), F.countDistinct("entity_id").alias("unique_ids"), miss("business_name"), miss("business_address"), miss("country"))
    again = held.groupBy(*held.columns).agg(F.count("*").alias("n")).groupBy("source").agg(F.sum(F.col("n") - 1).alias("repeated_rows"))
    return rows.join(again, "source")


def quick_overlaps(records: DataFrame) -> DataFrame:
    """Shared names, names with addresses, names with countries and ids of every two sources."""
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    keys = {"name": F.col("business_name"), "name_address": F.concat_ws("|", text("business_name"), text("business_address")), "name_country": F.concat_ws("|", text("business_name"), text("country")), "id_number": F.split_part("entity_id", F.lit("-"), F.lit(2))}
    out = None
    for name, key in keys.items():
        one = key_overlap(records, key).select(F.lit(name).alias("key"), "source_a", "source_b", "shared_keys")
        out = one if out is None else out.unionByName(one)
    return out


def leakage(train: DataFrame, test: DataFrame) -> DataFrame:
    """How many of the test split's ids each source of the training split holds."""
    named = lambda df, side: df.select(F.split_part("entity_id", F.lit("-"), F.lit(1)).alias(side), F.split_part("entity_id", F.lit("-"), F.lit(2)).alias("number")).distinct()
    return named(test, "test").join(named(train, "train"), "number").groupBy("test", "train").agg(F.count("*").alias("shared_ids"))


def country_universe(records: DataFrame) -> DataFrame:
    return records.filter("country is not null").groupBy("country").agg(F.count("*").alias("rows"))


def linked_sample(truth: DataFrame, n: int) -> DataFrame:
    """Of the first n anchors with matches (by id), the first match of each source: edges."""
    ids = F.filter(F.transform(F.split(F.coalesce("matched_entity_ids", F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != "")
    some = truth.select(ANCHOR, ids.alias("ids")).filter(F.size("ids") > 0).orderBy(ANCHOR).limit(n)
    edges = some.select(ANCHOR, F.posexplode("ids").alias("at", CANDIDATE)).withColumn("source", F.split_part(F.col(CANDIDATE), F.lit("-"), F.lit(1)))
    return edges.groupBy(ANCHOR, "source").agg(F.min_by(CANDIDATE, "at").alias(CANDIDATE)).select(ANCHOR, CANDIDATE)


def candidates_per_anchor(pairs: DataFrame) -> DataFrame:
    """One row: mean, quantiles and range of the number of candidates of an anchor."""
    from tessera.operators.evaluation import quantiles

    n = pairs.groupBy(ANCHOR).agg(F.count("*").alias("n"))
    return n.agg(F.count("*").alias("anchors"), F.avg("n").alias("mean"), F.min("n").alias("least"), F.max("n").alias("most")).crossJoin(quantiles(n, "n", {"median": 0.5, "p90": 0.9, "p95": 0.95, "p99": 0.99}))  # one row each


def derive_markers(df: DataFrame, column: str, words: tuple[str, ...], support: int = 100) -> DataFrame:
    """Listed words (units, directions) that occur as tokens with enough support."""
    t = F.regexp_extract_all(F.lower(column), F.lit("([a-z0-9]+)"), 1)
    return df.select(F.explode(F.array_distinct(t)).alias("token")).filter(F.col("token").isin(*words)).groupBy("token").agg(F.count("*").alias("n")).filter(F.col("n") >= support)


# Texts that stand for a missing value.
MISSING = ("none", "nan", "null", "n/a", "na", "-", "--", "unknown", "not available")


def derive_missing(df: DataFrame, column: str) -> DataFrame:
    """Whole values that stand for a missing one, with how often they occur."""
    x = F.lower(F.trim(F.col(column)))
    return df.filter(x.isin(*MISSING)).groupBy(x.alias("value")).agg(F.count("*").alias("n"))


# ---- features ----


def feature_quality(features: DataFrame, columns: list[str]) -> DataFrame:
    """Missing share, range, moments, median and distinct values of each feature."""
    from tessera.operators.evaluation import quantiles

    x = features.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("v")) for c in columns])).alias("x")).select("x.*")
    v = F.col("v")
    counts = x.groupBy("feature", "v").agg(F.count("*").alias("n")).groupBy("feature").agg(F.count("v").alias("distinct_values"))
    out = x.groupBy("feature").agg(F.count("*").alias("rows"), F.avg(v.isNull().cast("double")).alias("missing"), F.min(v).alias("least"), F.max(v).alias("most"), F.avg(v).alias("mean"), F.stddev_pop(v).alias("std"))
    return out.join(quantiles(x, "v", {"median": 0.5}, "feature"), "feature", "left").join(counts, "feature").withColumn("constant", F.col("distinct_values") <= 1)


def _moments(columns: list[str]):
    """Each task's row (task, moments): number of rows, means and matrix of products of
    deviations.  Values are taken from the task's first row, so a constant deviates by 0."""

    def run(batches):
        n, first, total, products = 0, None, None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(len(columns))])
            if first is None:
                first, total, products = x[0].copy(), np.zeros(len(columns)), np.zeros((len(columns), len(columns)))
            x = x - first
            n, total, products = n + len(x), total + x.sum(0), products + x.T @ x
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([np.concatenate([[n], first + total / n, (products - np.outer(total, total) / n).ravel()]).tobytes()], pa.binary())], names=["moments"])

    return run


def _merged_moments(rows: list[bytes], width: int) -> tuple[float, np.ndarray, np.ndarray]:
    n, mean, products = 0.0, np.zeros(width), np.zeros((width, width))
    for raw in rows:
        x = np.frombuffer(raw)
        m, delta = x[0], x[1 : width + 1] - (mean if n else x[1 : width + 1])
        products = products + x[width + 1 :].reshape(width, width) + np.outer(delta, delta) * (n * m / (n + m))
        mean = mean + delta * (m / (n + m)) if n else x[1 : width + 1].copy()
        n += m
    return n, mean, products


def feature_redundancy(features: DataFrame, columns: list[str], least: float = 0.95) -> DataFrame:
    """Pairs of features whose Pearson correlation is at least ``least`` in size.  The features
    are computed once: one pass adds up the matrix of products (columns by columns, whatever
    the rows), in parts before the driver has them; constant features correlate with nothing."""
    width = len(columns)

    def merge(table: pa.Table) -> pa.Table:
        n, mean, products = _merged_moments(table.column("moments").to_pylist(), width)
        return pa.table({"moments": pa.array([np.concatenate([[n], mean, products.ravel()]).tobytes()], pa.binary())})

    rows = features.select(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in columns])
    parts = rows.mapInArrow(_moments(columns), "moments binary").groupBy(F.pmod(F.spark_partition_id(), F.lit(16)).alias("part")).applyInArrow(merge, "moments binary")
    n, _, products = _merged_moments([bytes(r.moments) for r in parts.collect()], width)  # 16 rows
    spread = np.sqrt(np.maximum(np.diag(products), 0.0))
    some = [i for i in range(width) if spread[i] > 0]
    found = [(columns[i], columns[j], float(products[i, j] / (spread[i] * spread[j]))) for i in some for j in some if i < j]
    found = [(a, b, r, abs(r) >= 0.9999) for a, b, r in found if abs(r) >= least]
    return features.sparkSession.createDataFrame(found, "feature_a string, feature_b string, r double, duplicate boolean")


def feature_separation(features: DataFrame, columns: list[str], label: str = "label") -> DataFrame:
    """Cohen's d of each feature between the two classes."""
    x = features.select(label, F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("v")) for c in columns])).alias("x")).select(label, "x.*")
    one = lambda f, y: f(F.when(F.col(label) == y, F.col("v")))
    s = x.groupBy("feature").agg(one(F.avg, 1).alias("mean_pos"), one(F.avg, 0).alias("mean_neg"), one(F.stddev_pop, 1).alias("s1"), one(F.stddev_pop, 0).alias("s0"))
    pooled = F.sqrt((F.col("s1") * F.col("s1") + F.col("s0") * F.col("s0")) / 2)
    return s.select("feature", "mean_pos", "mean_neg", F.when(pooled > 0, (F.col("mean_pos") - F.col("mean_neg")) / pooled).otherwise(0.0).alias("cohens_d"))


def class_distribution(pairs: DataFrame, label: str = "label") -> DataFrame:
    groups = F.explode(F.array(F.lit("all"), F.col("candidate_source")))
    return pairs.select(groups.alias("part"), label).groupBy("part").agg(F.count("*").alias("pairs"), F.sum(label).alias("positives"), F.avg(F.col(label).cast("double")).alias("share"))
