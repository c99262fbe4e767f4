"""Baseline scores, ranks and the 84 pair features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tessera.functions import similarity as S
from tessera.functions.text import LEGAL_SUFFIXES, UNIT, cleaned, name_representations, present, word_tokens
from tessera.operators.blocking import ANCHOR, CANDIDATE, house_key, postal_key

# Weights of the baseline score.
NAME_WEIGHTS = {"exact": 0.20, "core": 0.20, "sorted": 0.10, "jaccard": 0.20, "levenshtein": 0.15, "jaro_winkler": 0.15}
ADDRESS_WEIGHTS = {"exact": 0.25, "sorted": 0.15, "jaccard": 0.30, "grams": 0.15, "postal": 0.15}
STRUCTURED_WEIGHTS = {"country": 0.50, "postal": 0.30, "house": 0.20}
PARTS = {"name": 0.50, "address": 0.35, "structured": 0.15}
# Strategies that have a feature, in order.
STRATEGIES = "exact_name exact_name_sorted exact_country_name exact_country_postal_name exact_country_postal_house exact_country_house_token name_token address_token char_ngram tfidf_name tfidf_addr".split()

FIELDS = ("name", "core", "sorted", "address", "address_sorted", "postal", "house", "unit", "country")
#: Of names and addresses: distinct words, letters and padded 3-grams as hashes, and the
#: number of all words.
SETS = tuple(f"{kind}_{x}" for kind in ("name", "address") for x in ("words", "letters", "grams", "n_words"))


#: Legal forms of one word; a name's core is the name without them.
SUFFIXES = {w: w for w in LEGAL_SUFFIXES if w.isalpha()}


def _derived(mark: str = "") -> dict[str, Column]:
    """What follows from a record's name and address alone: the address's order of components
    and the sets of both."""
    name, address = f"{mark}name", f"{mark}address"
    parts = F.filter(F.transform(F.split(address, ","), lambda c: F.trim(c)), lambda c: c != "")
    out = {f"{mark}address_sorted": F.coalesce(present(F.array_join(F.array_sort(parts), ", ")), F.col(address))}
    for kind, x in (("name", name), ("address", address)):
        words = F.coalesce(word_tokens(x), F.array().cast("array<string>"))
        grams = F.when(S.is_blank(x), F.array().cast("array<string>")).otherwise(S.padded_ngrams(x))
        out |= {f"{mark}{kind}_words": S.distinct_hashes(words), f"{mark}{kind}_letters": S.distinct_hashes(S.characters(F.coalesce(x, F.lit("")))), f"{mark}{kind}_grams": S.distinct_hashes(grams), f"{mark}{kind}_n_words": F.size(words)}
    return out


def profile(records: DataFrame, suffixes: dict[str, str] | None = None, *carried: str) -> DataFrame:
    """What scores compare, folded and trimmed, computed once a record (not once a pair).  A
    core or order of words that is missing or empty falls back to the name, an address's
    order of components to the address."""
    name, address = cleaned("business_name"), cleaned("business_address")
    held = name_representations("business_name", suffixes=SUFFIXES if suffixes is None else suffixes)
    r = records.select(
        "entity_id", name.alias("name"), held["name_core"].alias("core"), held["name_sorted"].alias("sorted"), address.alias("address"), postal_key(F.col("business_address")).alias("postal"), house_key(F.col("business_address")).alias("house"), F.lower(F.trim("country")).alias("country"), *carried,
    )
    unit, derived = present(F.regexp_extract("address", UNIT, 1)), _derived()
    return r.select(
        "entity_id", "name", F.coalesce(present("core"), "name").alias("core"), F.coalesce(present("sorted"), "name").alias("sorted"), "address",
        derived["address_sorted"].alias("address_sorted"), "postal", "house", unit.alias("unit"), "country", *[derived[k].alias(k) for k in SETS], *carried,
    )


def with_records(pairs: DataFrame, anchors: DataFrame, candidates: DataFrame, *carried: str) -> DataFrame:
    """Pairs with both records' fields, and carried ones, as a_* and c_*; a missing record has
    null fields.

    Candidates come first, with no more than their texts, since those pairs move once again to
    their anchors; what follows from the texts is many times longer and is computed there."""
    texts = [f for f in FIELDS if f != "address_sorted"]
    same = lambda f: F.col("name").eqNullSafe(F.col(f))  # noqa: E731  most cores are their names
    c = candidates.select(F.col("entity_id").alias(CANDIDATE), *[(F.when(~same(f), F.col(f)) if f in ("core", "sorted") else F.col(f)).alias(f"c_{f}") for f in texts + list(carried)])
    a = anchors.select(F.col("entity_id").alias(ANCHOR), *[F.col(f).alias(f"a_{f}") for f in FIELDS + SETS + carried])
    met = pairs.join(c, CANDIDATE, "left").join(a, ANCHOR, "left")
    return met.withColumns({f"c_{f}": F.coalesce(f"c_{f}", "c_name") for f in ("core", "sorted")} | _derived("c_"))


def _sets(field: str) -> tuple[Column, Column]:
    """Both records' sets; a pair without its record has empty ones."""
    none = F.array().cast("array<bigint>")
    return F.coalesce(f"a_{field}", none), F.coalesce(f"c_{field}", none)


def _unless_blank(kind: str, value: Column) -> Column:
    return F.when(S.is_blank(F.col(f"a_{kind}")) | S.is_blank(F.col(f"c_{kind}")), 0.0).otherwise(value)


#: Edit similarities of the names, computed once for the scores and the features.
EDITS = {"pair_levenshtein": lambda: S.levenshtein_similarity(*_pair("name"), fold=False), "pair_winkler": lambda: S.jaro_winkler(*_pair("name"), fold=False)}


def _pair(field: str) -> tuple[Column, Column]:
    return F.col(f"a_{field}"), F.col(f"c_{field}")


#: Sets that scores and features compare.
COMPARED = tuple(f"{kind}_{x}" for kind in ("name", "address") for x in ("words", "letters", "grams"))


def set_shares(pairs: DataFrame) -> DataFrame:
    """Jaccard and overlap of the records' sets as columns, each intersection once a pair; no
    set goes into the sort by anchors."""
    met = pairs.withColumns({f"common_{f}": F.size(F.array_intersect(*_sets(f))) for f in COMPARED})
    sizes = {f: [F.size(x) for x in _sets(f)] for f in COMPARED}
    ratio = lambda f, whole: F.when(whole > 0, F.col(f"common_{f}") / whole).otherwise(0.0)
    return met.withColumns({f"jaccard_{f}": ratio(f, x + y - F.col(f"common_{f}")) for f, (x, y) in sizes.items()} | {f"overlap_{f}": ratio(f, F.least(x, y)) for f, (x, y) in sizes.items() if f.endswith("_words")})


def baseline_parts() -> dict[str, Column]:
    name, core, ordered, address = _pair("name"), _pair("core"), _pair("sorted"), _pair("address")
    n = {"exact": S.exact(*name, fold=False), "core": S.exact(*core, fold=False), "sorted": S.exact(*ordered, fold=False), "jaccard": _unless_blank("name", F.col("jaccard_name_letters")), "levenshtein": F.col("pair_levenshtein"), "jaro_winkler": F.col("pair_winkler")}
    postal = S.compare_field(*_pair("postal"), fold=False)
    a = {"exact": S.exact(*address, fold=False), "sorted": S.exact(*_pair("address_sorted"), fold=False), "jaccard": _unless_blank("address", F.col("jaccard_address_letters")), "grams": F.col("jaccard_address_grams"), "postal": F.when(postal["both_missing"] == 1, S.exact(*address, fold=False)).otherwise(postal["exact"])}
    some = lambda f: ~(S.is_blank(F.col(f"a_{f}")) & S.is_blank(F.col(f"c_{f}")))
    fields = list(STRUCTURED_WEIGHTS)
    weight = sum((F.when(some(f), STRUCTURED_WEIGHTS[f]).otherwise(0.0) for f in fields), F.lit(0.0))
    hits = sum((F.when(some(f), STRUCTURED_WEIGHTS[f] * S.exact(*_pair(f), fold=False)).otherwise(0.0) for f in fields), F.lit(0.0))
    return {
        "name_similarity_score": sum((NAME_WEIGHTS[k] * v for k, v in n.items()), F.lit(0.0)),
        "address_similarity_score": F.when(S.is_blank(address[0]) | S.is_blank(address[1]), 0.0).otherwise(sum((ADDRESS_WEIGHTS[k] * v for k, v in a.items()), F.lit(0.0))),
        "structured_similarity_score": F.when(weight > 0, hits / weight).otherwise(0.0),
    }


def score_pairs(pairs: DataFrame, float32: bool = True) -> DataFrame:
    """Baseline scores of pairs that carry records.  A country conflict scores nothing; a
    missing address gives its weight to the other parts."""
    parts = set_shares(pairs).withColumns({k: v() for k, v in EDITS.items()}).withColumns(baseline_parts())
    conflict = ~S.is_blank(F.col("a_country")) & ~S.is_blank(F.col("c_country")) & (F.col("a_country") != F.col("c_country"))
    no_address = S.is_blank(F.col("a_address")) | S.is_blank(F.col("c_address"))
    n, a, s = F.col("name_similarity_score"), F.col("address_similarity_score"), F.col("structured_similarity_score")
    w = PARTS
    full = w["name"] * n + w["address"] * a + w["structured"] * s
    short = (w["name"] + w["address"] * 0.75) * n + (w["structured"] + w["address"] * 0.25) * s
    score = F.when(conflict, 0.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.when(no_address, short).otherwise(full))))
    out = parts.withColumn("baseline_score", score).withColumn("structured_similarity_score", F.when(conflict, 0.0).otherwise(s))
    names = ("baseline_score", "name_similarity_score", "address_similarity_score", "structured_similarity_score")
    return out.withColumns({c: F.col(c).cast("float") for c in names}) if float32 else out


def rank_pairs(scored: DataFrame) -> DataFrame:
    order = Window.partitionBy(ANCHOR).orderBy(F.desc("baseline_score"), CANDIDATE)
    return scored.withColumn("baseline_rank", F.row_number().over(order))


def pair_features() -> dict[str, Column]:
    """The 84 features of a pair that carries records, provenance and baseline columns."""
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    one = lambda c: F.col(c)
    f: dict[str, Column] = {}
    missing = {x: (S.is_blank(F.col(f"a_{x}")), S.is_blank(F.col(f"c_{x}"))) for x in ("name", "address", "country", "postal", "house", "unit")}
    for kind, ordered in (("name", "sorted"), ("address", "address_sorted")):
        a, c = _pair(kind)
        la, lc = F.coalesce(F.length(a), F.lit(0)), F.coalesce(F.length(c), F.lit(0))
        na, nc = (F.coalesce(f"{m}_{kind}_n_words", F.lit(0)) for m in "ac")
        f[f"{kind}_exact_match"] = S.exact(a, c, fold=False)
        if kind == "name":
            f["name_core_exact_match"] = S.exact(*_pair("core"), fold=False)
        f[f"{kind}_sorted_exact_match"] = S.exact(*_pair(ordered), fold=False)
        f |= {f"{kind}_length_s1": la, f"{kind}_length_cand": lc, f"{kind}_length_diff": F.abs(la - lc), f"{kind}_length_ratio": F.when(F.greatest(la, lc) > 0, F.least(la, lc) / F.greatest(la, lc)).otherwise(0.0)}
        f |= {f"{kind}_token_count_s1": na, f"{kind}_token_count_cand": nc, f"{kind}_token_count_diff": F.abs(na - nc)}
        f |= {f"{kind}_token_jaccard": one(f"jaccard_{kind}_words"), f"{kind}_token_overlap": one(f"overlap_{kind}_words"), f"{kind}_char_3gram_jaccard": one(f"jaccard_{kind}_grams"), f"{kind}_levenshtein_sim": one("pair_levenshtein") if kind == "name" else S.levenshtein_similarity(a, c, fold=False)}
        if kind == "name":
            f |= {"name_jaro_winkler": one("pair_winkler"), "name_prefix_similarity": S.prefix_ratio(a, c, fold=False), "name_suffix_similarity": S.suffix_ratio(a, c, fold=False)}
    for field in ("postal", "house"):
        label = "house_number" if field == "house" else field
        c4 = S.compare_field(*_pair(field), fold=False)
        f |= {f"{label}_exact_match": c4["exact"], f"{label}_both_present": c4["both_present"], f"{label}_one_missing": c4["one_missing"], f"{label}_both_missing": c4["both_missing"]}
    unit = S.compare_field(*_pair("unit"), fold=False)
    f |= {"unit_exact_match": unit["exact"], "unit_both_present": unit["both_present"]}
    for kind in ("name", "address"):
        a, c = missing[kind]
        f |= {f"missing_s1_{kind}": flag(a), f"missing_cand_{kind}": flag(c), f"missing_both_{kind}": flag(a & c), f"missing_either_{kind}": flag(a | c)}
    f |= {f"missing_{side}_{kind}": flag(missing[kind][i]) for kind in ("country", "postal") for i, side in enumerate(("s1", "cand"))}
    f["missing_field_count_total"] = sum((flag(m) for kind in ("name", "address", "country", "postal") for m in missing[kind]), F.lit(0.0))
    conflict = ~missing["country"][0] & ~missing["country"][1] & (F.col("a_country") != F.col("c_country"))
    country = S.exact(*_pair("country"), fold=False)
    f |= {
        "cross_name_address_exact": f["name_exact_match"] * f["address_exact_match"], "cross_name_postal_exact": f["name_exact_match"] * f["postal_exact_match"], "cross_name_jaccard_country": f["name_token_jaccard"] * country,
        "cross_name_address_jaccard": f["name_token_jaccard"] * f["address_token_jaccard"], "cross_address_jaccard_postal": f["address_token_jaccard"] * f["postal_exact_match"], "cross_country_postal": country * f["postal_exact_match"],
        "country_exact_match": country, "country_conflict": flag(conflict), "country_both_present": flag(~missing["country"][0] & ~missing["country"][1]), "country_missing": flag(missing["country"][0] | missing["country"][1]),
    }
    held = F.split(F.coalesce("strategies", F.lit("")), ";")
    f |= {f"blocking_{s}": flag(F.array_contains(held, s)) for s in STRATEGIES}
    count = F.coalesce("strategy_count", F.lit(1))
    source = F.coalesce(one("candidate_source"), F.split_part(F.col(CANDIDATE), F.lit("-"), F.lit(1)))
    f |= {"blocking_strategy_count": count, "blocking_multi_strategy": flag(count >= 2), "cand_is_s2": flag(source == "S2"), "cand_is_s3": flag(source == "S3"), "s1_is_s1": F.lit(1.0)}
    f |= {"baseline_score_feature": one("baseline_score"), "baseline_rank_feature": one("baseline_rank"), "baseline_name_similarity": one("name_similarity_score"), "baseline_address_similarity": one("address_similarity_score"), "baseline_structured_similarity": one("structured_similarity_score")}
    return {k: v.cast("float") for k, v in f.items()}


FEATURE_COUNT = 84


def featurize(ranked: DataFrame, *carried: str) -> DataFrame:
    """Pairs' ids, carried columns and all features (float32)."""
    f = pair_features()
    return ranked.select(ANCHOR, CANDIDATE, "candidate_source", *carried, *[v.alias(k) for k, v in f.items()])


def feature_registry() -> list[dict]:
    """Name and group of every feature, in order."""
    groups = (("cross_", "cross"), ("blocking_", "provenance"), ("baseline_", "baseline"), ("missing_", "missingness"), ("country_", "country"), ("name_", "name"), ("address_", "address"), ("cand_is", "source"), ("s1_is", "source"))
    return [{"name": k, "group": next((g for start, g in groups if k.startswith(start)), "structured"), "dtype": "float32"} for k in pair_features()]


def error_causes(scored: DataFrame, truth_flag: str = "is_true_match") -> DataFrame:
    """Diagnosed causes of low-scored matches (below 0.60) and high-scored others (0.70 on)."""
    low = (F.col(truth_flag) == 1) & (F.col("baseline_score") < F.lit(0.60).cast("float"))
    high = (F.col(truth_flag) == 0) & (F.col("baseline_score") >= F.lit(0.70).cast("float"))
    words = lambda c: F.filter(F.split(F.lower(F.coalesce(c, F.lit(""))), " +"), lambda t: t != "")
    digits = lambda c: F.regexp_replace(F.substring(F.coalesce(c, F.lit("")), 1, 10), "[^0-9]", "")
    an, cn, aa, ca = F.col("a_name"), F.col("c_name"), F.coalesce("a_address", F.lit("")), F.coalesce("c_address", F.lit(""))
    fn = (
        F.when(F.lower(F.trim(ca)).isin("", "none", "nan"), "missing_candidate_address")
        .when((F.size(words(an)) > 0) & (F.size(words(cn)) > 0) & (F.array_sort(words(an)) == F.array_sort(words(cn))), "word_order_variation")
        .when(F.exists(words(an), lambda t: F.length(t) <= 2) | F.exists(words(cn), lambda t: F.length(t) <= 2), "abbreviation_or_acronym")
        .when((aa != "") & (digits(aa) != "") & (digits(ca) != "") & (digits(aa) != digits(ca)), "address_number_discrepancy")
        .when(aa != "", "address_formatting_variation")
        .otherwise("spelling_or_typo")
    )
    fp = F.when(F.lower(F.trim(an)) == F.lower(F.trim(cn)), "identical_name_distinct_location").when(F.lower(F.trim(aa)) == F.lower(F.trim(ca)), "co_located_different_business").otherwise("high_token_overlap_collision")
    return scored.select(F.when(low, F.concat(F.lit("FN_"), fn)).when(high, F.concat(F.lit("FP_"), fp)).alias("cause")).filter("cause is not null").groupBy("cause").agg(F.count("*").alias("n"))
