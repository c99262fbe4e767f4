"""Pair and entity metrics, threshold sweeps, entity grouping and audits.

Input: scored pairs (source1_entity_id, candidate_entity_id, candidate_source, prob, label).
A sweep never multiplies pairs by thresholds: pairs fall into the interval between two
thresholds first, and counts are summed over intervals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tessera.operators.blocking import ANCHOR, CANDIDATE

# Thresholds of the entity grid and of the pair sweep.
ENTITY_THRESHOLDS = (0.1, 0.2, 0.3, 0.4, 0.5, 0.55, 0.6, 0.65, 0.7, 0.75, 0.8, 0.85, 0.9, 0.95, 0.975, 0.99)
THRESHOLDS = (0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.85, 0.9, 0.95, 0.975, 0.99)


def ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(0.0)


def f_beta(p: Column, r: Column, beta: float = 0.5) -> Column:
    b2 = beta * beta
    return F.when(p + r > 0, (1 + b2) * p * r / (b2 * p + r)).otherwise(0.0)


def _steps(thresholds) -> list[float]:
    return sorted(set(thresholds))


def _passed(prob: Column, thresholds: list[float]) -> Column:
    """How many thresholds the probability reaches."""
    return sum((F.when(prob >= F.lit(t), 1).otherwise(0) for t in thresholds), F.lit(0))


def sweep(pairs: DataFrame, thresholds=THRESHOLDS) -> DataFrame:
    """Confusion counts, precision, recall, F0.5 and F1 at each threshold."""
    steps = _steps(thresholds)
    counts = pairs.groupBy(_passed(F.col("prob"), steps).alias("passed")).agg(F.sum("label").alias("pos"), F.sum(1 - F.col("label")).alias("neg"))
    grid = pairs.sparkSession.createDataFrame([(i, t) for i, t in enumerate(steps, 1)], "i int, threshold double")
    total = counts.agg(F.sum("pos").alias("all_pos"), F.sum("neg").alias("all_neg"))
    # One row a threshold meets one row an interval.
    at = F.broadcast(grid).join(F.broadcast(counts), F.col("passed") >= F.col("i"), "left").groupBy("threshold").agg(F.coalesce(F.sum("pos"), F.lit(0)).alias("tp"), F.coalesce(F.sum("neg"), F.lit(0)).alias("fp")).crossJoin(total)
    out = at.select("threshold", "tp", "fp", (F.coalesce("all_pos", F.lit(0)) - F.col("tp")).alias("fn"), (F.coalesce("all_neg", F.lit(0)) - F.col("fp")).alias("tn"))
    out = out.withColumn("precision", ratio(F.col("tp"), F.col("tp") + F.col("fp"))).withColumn("recall", ratio(F.col("tp"), F.col("tp") + F.col("fn")))
    return out.withColumn("f05", f_beta(F.col("precision"), F.col("recall"))).withColumn("f1", f_beta(F.col("precision"), F.col("recall"), 1.0))


def _by_score(pairs: DataFrame) -> DataFrame:
    """Positives and negatives of each distinct score, with both summed from the top.  The
    running sum is taken within score ranges first, so no task holds all scores."""
    scores = pairs.groupBy("prob").agg(F.sum("label").alias("pos"), F.sum(1 - F.col("label")).alias("neg")).withColumn("range", F.floor(F.col("prob") * 1000))
    ranges = scores.groupBy("range").agg(F.sum("pos").alias("rp"), F.sum("neg").alias("rn"))
    above = Window.orderBy(F.desc("range")).rowsBetween(Window.unboundedPreceding, -1)  # at most 1001 rows
    ranges = ranges.select("range", F.coalesce(F.sum("rp").over(above), F.lit(0)).alias("p0"), F.coalesce(F.sum("rn").over(above), F.lit(0)).alias("n0"))
    inside = Window.partitionBy("range").orderBy(F.desc("prob")).rowsBetween(Window.unboundedPreceding, 0)
    return scores.join(F.broadcast(ranges), "range").withColumn("tp", F.col("p0") + F.sum("pos").over(inside)).withColumn("fp", F.col("n0") + F.sum("neg").over(inside))


def average_precision(pairs: DataFrame) -> DataFrame:
    """Sum over distinct scores of the gain in recall times precision."""
    s = _by_score(pairs)
    return s.agg((F.sum(F.col("pos") * F.col("tp") / (F.col("tp") + F.col("fp"))) / F.sum("pos")).alias("average_precision"))


def roc_auc(pairs: DataFrame) -> DataFrame:
    """Share of (positive, negative) pairs in the right order; ties count half."""
    s = _by_score(pairs)
    right = F.sum(F.col("neg") * (F.col("tp") - F.col("pos")) + F.col("neg") * F.col("pos") / 2)
    return s.agg((right / (F.sum("pos") * F.sum("neg"))).alias("roc_auc"))


def quantiles(df: DataFrame, column: str, ps: dict[str, float], *by: str) -> DataFrame:
    """Exact, interpolated quantiles by group: rows (by, names of ``ps``).  Values are counted
    once each, then summed within ranges of values, so no task holds all of them."""
    x = F.col(column).cast("double")
    counts = df.select(*by, x.alias("x")).filter("x is not null").groupBy(*by, "x").agg(F.count("*").alias("n"))
    span = counts.groupBy(*by).agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.sum("n").alias("all"))
    meet = lambda a, b: a.join(b, list(by)) if by else a.crossJoin(b)  # noqa: E731  one row without groups
    counts = meet(counts, span).withColumn("range", F.when(F.col("hi") > F.col("lo"), F.floor((F.col("x") - F.col("lo")) / (F.col("hi") - F.col("lo")) * 1000)).otherwise(0))
    below = Window.partitionBy(*by).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # at most 1001 rows a group
    ranges = counts.groupBy(*by, "range").agg(F.sum("n").alias("in_range")).withColumn("base", F.coalesce(F.sum("in_range").over(below), F.lit(0))).drop("in_range")
    inside = Window.partitionBy(*by, "range").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    upto = counts.join(ranges, [*by, "range"]).withColumn("upto", F.col("base") + F.sum("n").over(inside))
    at = lambda place: F.min(F.when(F.col("upto") > place, F.col("x")))
    found = []
    for name, p in ps.items():
        h = F.lit(p) * (F.col("all") - 1)
        found += [at(F.floor(h)).alias(f"_{name}_lo"), at(F.ceil(h)).alias(f"_{name}_hi")]
    out = upto.groupBy(*by).agg(F.first("all").alias("all"), *found)
    part = lambda p: F.lit(p) * (F.col("all") - 1) - F.floor(F.lit(p) * (F.col("all") - 1))
    return out.select(*by, *[(F.col(f"_{n}_lo") + part(p) * (F.col(f"_{n}_hi") - F.col(f"_{n}_lo"))).alias(n) for n, p in ps.items()])


# The quantiles of a distribution.
QUANTILES = {"p10": 0.1, "p25": 0.25, "median": 0.5, "p75": 0.75, "p90": 0.9, "p95": 0.95, "p99": 0.99}


def distribution(df: DataFrame, column: str, *by: str) -> DataFrame:
    x = F.col(column).cast("double")
    sums = df.groupBy(*by).agg(F.count(x).alias("n"), F.avg(x).alias("mean"), F.stddev_pop(x).alias("std"), F.min(x).alias("least"), F.max(x).alias("most"))
    q = quantiles(df, column, QUANTILES, *by)
    out = sums.join(q, list(by), "left") if by else sums.join(q, how="left")  # one row each without groups
    return out.select(*by, "n", "mean", "std", "least", *QUANTILES, "most")


def ranked(pairs: DataFrame) -> DataFrame:
    return pairs.withColumn("rank_within_source1", F.row_number().over(Window.partitionBy(ANCHOR).orderBy(F.desc("prob"), CANDIDATE)))


def extremes(pairs: DataFrame, n: int = 20) -> DataFrame:
    """The n surest wrong predictions and the n surest right ones."""
    wrong = pairs.filter("label = 0").orderBy(F.desc("prob"), ANCHOR, CANDIDATE).limit(n).withColumn("kind", F.lit("fp"))
    right = pairs.filter("label = 1").orderBy(F.desc("prob"), ANCHOR, CANDIDATE).limit(n).withColumn("kind", F.lit("tp"))
    return wrong.unionByName(right)


def fan_in(pairs: DataFrame, threshold: float) -> DataFrame:
    """Candidates predicted for more than one anchor."""
    return pairs.filter(F.col("prob") >= threshold).groupBy(CANDIDATE).agg(F.countDistinct(ANCHOR).alias("anchors")).filter("anchors > 1")


def entities(pairs: DataFrame, threshold: float = 0.95, margin: float = 0.05) -> DataFrame:
    """One row an anchor: top two, predicted and true sets, agreement, margin and status."""
    p = F.col("prob")
    conflict = pairs.filter(p >= threshold).join(fan_in(pairs, threshold).select(CANDIDATE), CANDIDATE, "left_semi").select(ANCHOR).distinct().withColumn("conflict", F.lit(True))
    pick = lambda cond: F.array_sort(F.collect_set(F.when(cond, F.col(CANDIDATE))))
    order = F.array_sort(F.collect_list(F.struct((-p).alias("m"), F.col(CANDIDATE).alias("id"))))
    within = (p < threshold) & (p >= threshold - margin)
    e = pairs.groupBy(ANCHOR).agg(F.count("*").alias("n_candidates"), F.slice(order, 1, 2).alias("top"), pick(p >= threshold).alias("predicted"), pick(F.col("label") == 1).alias("truth"), F.sum(F.when(within, 1).otherwise(0)).alias("n_margin"))
    e = e.join(conflict, ANCHOR, "left").withColumn("conflict", F.coalesce("conflict", F.lit(False)))
    first, second = F.col("top")[0], F.get("top", F.lit(1))
    e = e.withColumn("top1_prob", -first["m"]).withColumn("top1_id", first["id"]).withColumn("top2_prob", F.coalesce(-second["m"], F.lit(0.0))).withColumn("top2_id", F.coalesce(second["id"], F.lit("")))
    both, either = F.size(F.array_intersect("predicted", "truth")), F.size(F.array_union("predicted", "truth"))
    e = e.withColumns({"n_predicted": F.size("predicted"), "n_true": F.size("truth"), "tp": both, "fp": F.size(F.array_except("predicted", "truth")), "fn": F.size(F.array_except("truth", "predicted")), "jaccard": F.when(either == 0, 1.0).otherwise(both / either), "gap": F.col("top1_prob") - F.col("top2_prob"), "exact_set": F.col("predicted") == F.col("truth")})
    status = F.when(F.col("conflict"), "conflicting").when((F.col("n_predicted") == 0) & (F.col("top1_prob") >= 0.5), "ambiguous").when(F.col("n_predicted") == 0, "unmatched").when(F.col("n_margin") > 0, "ambiguous").otherwise("confident")
    return e.withColumn("status", status).drop("top", "conflict")


def entity_records(pairs: DataFrame, threshold: float = 0.95, margin: float = 0.05) -> DataFrame:
    """The full record of each anchor: its best two candidates with their sources, predicted
    and true ids in the order of probability, status and the reason for it, agreement.
    An anchor's candidates are gathered in one row; blocking caps their number."""
    p = F.col("prob")
    shared = pairs.filter(p >= threshold).join(fan_in(pairs, threshold).select(CANDIDATE), CANDIDATE, "left_semi").select(ANCHOR).distinct().withColumn("_shared", F.lit(True))
    order = F.array_sort(F.collect_list(F.struct((-p).alias("m"), F.col(CANDIDATE).alias("id"), F.col("candidate_source").alias("source"), (F.col("label") == 1).alias("true"))))
    e = pairs.groupBy(ANCHOR).agg(order.alias("c")).join(shared, ANCHOR, "left")
    first, second = F.col("c")[0], F.get("c", F.lit(1))
    e = e.withColumns({"_in": F.filter("c", lambda s: -s["m"] >= threshold), "_out": F.filter("c", lambda s: -s["m"] < threshold), "_true": F.filter("c", lambda s: s["true"])})
    e = e.withColumn("_near", F.filter("_out", lambda s: -s["m"] >= threshold - margin))
    ids = lambda c: F.transform(c, lambda s: s["id"])
    joined = lambda c, f: F.array_join(F.transform(c, lambda s: s[f]), ",")
    n, top = F.size("_in"), -first["m"]
    highest = F.coalesce(-F.get("_out", F.lit(0))["m"], F.lit(0.0))
    status = F.when(F.col("_shared"), "conflicting").when((n == 0) & (top >= 0.5), "ambiguous").when(n == 0, "unmatched").when(F.size("_near") > 0, "ambiguous").otherwise("confident")
    reason = (
        F.when(F.col("_shared"), F.lit(f"a predicted candidate is predicted for another anchor at {threshold}"))
        .when((n == 0) & (top >= 0.5), F.format_string("no candidate at the threshold, the best has %.4f", top))
        .when(n == 0, F.format_string("all candidates are unlikely, the best has %.4f", top))
        .when(F.size("_near") > 0, F.format_string("%d matched, %d just below the threshold", n, F.size("_near")))
        .otherwise(F.format_string("%d matched, the best of the others has %.4f", n, highest))
    )
    both, either = F.size(F.array_intersect(ids("_in"), ids("_true"))), F.size(F.array_union(ids("_in"), ids("_true")))
    none = F.lit("")
    return e.select(
        ANCHOR, F.size("c").alias("total_candidates_evaluated"), n.alias("predicted_candidate_count"), joined("_in", "id").alias("predicted_candidate_ids"), joined("_in", "source").alias("predicted_candidate_sources"),
        first["id"].alias("top_candidate_id"), first["source"].alias("top_candidate_source"), top.alias("top_candidate_probability"),
        F.coalesce(second["id"], none).alias("second_candidate_id"), F.coalesce(second["source"], none).alias("second_candidate_source"), F.coalesce(-second["m"], F.lit(0.0)).alias("second_candidate_probability"),
        (top - F.coalesce(-second["m"], F.lit(0.0))).alias("top_candidate_probability_gap"), status.alias("prediction_status"), reason.alias("prediction_status_reason"),
        F.size("_true").alias("ground_truth_candidate_count"), joined("_true", "id").alias("ground_truth_candidate_ids"), (F.size("_true") == 0).alias("is_ground_truth_singleton"),
        ((both == n) & (both == F.size("_true"))).alias("exact_set_match"), (both < n).alias("entity_has_false_positive"), (both < F.size("_true")).alias("entity_has_false_negative"), F.when(either == 0, 1.0).otherwise(both / either).alias("jaccard_similarity"),
    )


def entity_statistics(records: DataFrame) -> DataFrame:
    """The rollup of entity records: one row of counts and means."""
    count = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0))
    status = [count(F.col("prediction_status") == s).alias(s) for s in ("confident", "ambiguous", "unmatched", "conflicting")]
    return records.agg(
        F.count("*").alias("entities"), *status, count(F.col("predicted_candidate_count") > 0).alias("matched"), count(F.col("predicted_candidate_count") > 1).alias("with_many"), count(F.col("is_ground_truth_singleton")).alias("singletons"),
        count(F.col("exact_set_match")).alias("exact_sets"), count(F.col("entity_has_false_positive")).alias("with_false_positive"), count(F.col("entity_has_false_negative")).alias("with_false_negative"),
        F.avg("jaccard_similarity").alias("mean_jaccard"), F.avg("top_candidate_probability").alias("mean_top"), F.avg("top_candidate_probability_gap").alias("mean_gap"), F.avg("total_candidates_evaluated").alias("mean_candidates"),
    )


def contradictions(pairs: DataFrame, threshold: float, countries: DataFrame) -> DataFrame:
    """Predicted pairs whose countries differ, and predicted candidates that their anchors
    share, by kind.  ``countries``: entity_id, country."""
    kept = pairs.filter(F.col("prob") >= threshold).select(ANCHOR, CANDIDATE).distinct()
    named = lambda key, name: countries.select(F.col("entity_id").alias(key), F.lower(F.trim("country")).alias(name))
    differ = kept.join(named(ANCHOR, "_a"), ANCHOR).join(named(CANDIDATE, "_c"), CANDIDATE).filter("_a <> '' and _c <> '' and _a <> _c").agg(F.count("*").alias("n")).select(F.lit("countries_differ").alias("kind"), "n")
    shared = fan_in(pairs, threshold).agg(F.coalesce(F.sum(F.col("anchors") - 1), F.lit(0)).alias("n")).select(F.lit("further_anchors_of_a_candidate").alias("kind"), "n")
    several = kept.groupBy(ANCHOR, F.split_part(F.col(CANDIDATE), F.lit("-"), F.lit(1)).alias("source")).count().filter("count > 1").agg(F.count("*").alias("n")).select(F.lit("several_of_one_source").alias("kind"), "n")
    return differ.unionByName(shared).unionByName(several)


def _entity_counts(pairs: DataFrame, steps: list[float]) -> DataFrame:
    """Per (anchor, threshold index): tp, fp, number true.  Each anchor's pairs fall into
    intervals; a window sums them from the top."""
    per = pairs.groupBy(ANCHOR, _passed(F.col("prob"), steps).alias("passed")).agg(F.sum("label").alias("pos"), F.sum(1 - F.col("label")).alias("neg"))
    held = per.groupBy(ANCHOR).agg(F.collect_list(F.struct("passed", "pos", "neg")).alias("h"), F.sum("pos").alias("n_true"))  # one entry a threshold at most
    at = held.select(ANCHOR, "n_true", "h", F.explode(F.sequence(F.lit(1), F.lit(len(steps)))).alias("i"))
    total = lambda field: F.aggregate(F.filter("h", lambda s: s["passed"] >= F.col("i")), F.lit(0).cast("long"), lambda a, s: a + s[field])
    return at.select(ANCHOR, "i", "n_true", total("pos").alias("tp"), total("neg").alias("fp"))


def _grid(spark, steps: list[float]) -> DataFrame:
    return F.broadcast(spark.createDataFrame([(i, t) for i, t in enumerate(steps, 1)], "i int, threshold double"))


def macro_grid(pairs: DataFrame, thresholds) -> DataFrame:
    """Macro F0.5 by threshold: a singleton scores 1 if nothing is predicted, else 0."""
    steps = _steps(thresholds)
    c = _entity_counts(pairs, steps).withColumn("fn", F.col("n_true") - F.col("tp"))
    p, r = ratio(F.col("tp"), F.col("tp") + F.col("fp")), ratio(F.col("tp"), F.col("n_true"))
    f = F.when(F.col("n_true") == 0, F.when(F.col("fp") == 0, 1.0).otherwise(0.0)).otherwise(f_beta(p, r))
    out = c.groupBy("i").agg(
        F.avg(f).alias("macro_f05"), F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn"), F.sum(((F.col("fp") == 0) & (F.col("fn") == 0)).cast("long")).alias("exact_sets"),
        F.sum(((F.col("n_true") == 0) & (F.col("fp") > 0)).cast("long")).alias("singleton_fp"), F.sum(((F.col("n_true") > 0) & (F.col("tp") == 0)).cast("long")).alias("matched_fn"),
    )
    return out.join(_grid(pairs.sparkSession, steps), "i").drop("i")


def entity_grid(pairs: DataFrame, thresholds) -> DataFrame:
    """Pair and entity metrics by threshold."""
    g = macro_grid(pairs, thresholds)
    n = pairs.agg(F.countDistinct(ANCHOR).alias("entities"))
    g = g.withColumn("precision", ratio(F.col("tp"), F.col("tp") + F.col("fp"))).withColumn("recall", ratio(F.col("tp"), F.col("tp") + F.col("fn"))).crossJoin(n)
    return g.withColumn("f05", f_beta(F.col("precision"), F.col("recall"))).withColumn("exact_share", F.col("exact_sets") / F.col("entities"))


def full_grid(pairs: DataFrame, thresholds, margin: float = 0.05) -> DataFrame:
    """All pair and entity metrics by threshold: confusion, precision, recall, F0.5, F1 and
    average precision; anchors matched, with many, ambiguous; shared candidates; exact sets
    and both kinds of error.  A row an anchor and threshold is summed, never a pair and
    threshold."""
    steps = _steps(thresholds)
    c = _entity_counts(pairs, steps)
    near = [F.max(F.when((F.col("prob") < t) & (F.col("prob") >= t - margin), 1).otherwise(0)).alias(f"m{i}") for i, t in enumerate(steps, 1)]
    best = pairs.groupBy(ANCHOR).agg(F.max("prob").alias("top"), *near)
    best = best.select(ANCHOR, "top", F.array(*[f"m{i}" for i in range(1, len(steps) + 1)]).alias("near"))
    held = c.join(best, ANCHOR).join(_grid(pairs.sparkSession, steps), "i")
    count = lambda cond: F.sum(cond.cast("long"))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("n_true") - F.col("tp")
    unsure = ((F.col("top") < F.col("threshold")) & (F.col("top") >= 0.5)) | (F.col("near")[F.col("i") - 1] == 1)
    g = held.groupBy("threshold").agg(
        F.count("*").alias("total_source1_entities"), count(tp + fp > 0).alias("matched_source1_entities"), count(tp + fp == 0).alias("unmatched_source1_entities"), count(tp + fp > 1).alias("multi_candidate_entities"), count(unsure).alias("ambiguous_source1_entities"),
        count((fp == 0) & (fn == 0)).alias("exact_entity_set_matches"), count((F.col("n_true") == 0) & (fp > 0)).alias("singleton_false_positives"), count(fp > 0).alias("entities_with_false_positive_candidate"), count((F.col("n_true") > 0) & (tp + fp == 0)).alias("matched_entity_false_negatives"), count(fn > 0).alias("entities_with_false_negative_candidate"),
    )
    # A candidate is shared from its second-best anchor's probability down.
    anchors = pairs.groupBy(CANDIDATE, ANCHOR).agg(F.max("prob").alias("prob"))
    second = anchors.withColumn("_r", F.row_number().over(Window.partitionBy(CANDIDATE).orderBy(F.desc("prob"), ANCHOR))).filter("_r = 2")
    shared = second.groupBy(_passed(F.col("prob"), steps).alias("passed")).agg(F.count("*").alias("n"))
    shared = _grid(pairs.sparkSession, steps).join(F.broadcast(shared), F.col("passed") >= F.col("i"), "left").groupBy("threshold").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("conflicting_assignments"))  # a row an interval
    s = sweep(pairs, thresholds).select("threshold", F.col("precision").alias("pair_precision"), F.col("recall").alias("pair_recall"), F.col("f05").alias("pair_f0_5"), F.col("f1").alias("pair_f1"), F.col("fp").alias("pair_false_positives"), F.col("fn").alias("pair_false_negatives"), F.col("tp").alias("pair_true_positives"), F.col("tn").alias("pair_true_negatives"))
    out = s.join(g, "threshold").join(shared, "threshold").crossJoin(average_precision(pairs).withColumnRenamed("average_precision", "pr_auc"))  # one row
    return out.withColumn("multi_candidate_rate", ratio(F.col("multi_candidate_entities"), F.col("matched_source1_entities"))).withColumn("exact_entity_set_accuracy", F.col("exact_entity_set_matches") / F.col("total_source1_entities"))


def sweep_of_truth(pairs: DataFrame, truth: DataFrame | None, thresholds=THRESHOLDS, total: DataFrame | None = None) -> DataFrame:
    """The sweep with recall over all true pairs, also those that were no candidates.  Their
    number may be given (one row: total) in place of the pairs."""
    s = sweep(pairs, thresholds).crossJoin(truth.agg(F.count("*").alias("total")) if total is None else total)  # one row
    s = s.withColumn("fn", F.col("total") - F.col("tp")).withColumn("recall", ratio(F.col("tp"), F.col("total")))
    return s.withColumn("f05", f_beta(F.col("precision"), F.col("recall"))).withColumn("f1", f_beta(F.col("precision"), F.col("recall"), 1.0)).drop("total")


def coarse_then_fine(pairs: DataFrame, coarse: float = 0.01, window: float = 0.03, fine: float = 0.002) -> DataFrame:
    """The macro grid over coarse thresholds and, around their pick, fine ones, each once."""
    first = [round(i * coarse, 6) for i in range(int(round(1 / coarse)) + 1)]
    best = pick_macro(macro_grid(pairs, first)).first().threshold
    if best is None:
        return macro_grid(pairs, first)
    low, high = max(0.0, best - window), min(1.0, best + window)
    return macro_grid(pairs, {*first, *(round(low + i * fine, 6) for i in range(int(round((high - low) / fine)) + 1))})


def pick_macro(grid: DataFrame) -> DataFrame:
    """The highest threshold within 1e-9 of the best macro F0.5."""
    best = grid.agg(F.max("macro_f05").alias("best"))
    return grid.crossJoin(best).filter(F.col("macro_f05") >= F.col("best") - 1e-9).agg(F.max("threshold").alias("threshold"), F.max("best").alias("macro_f05"))


def pick_pair(grid: DataFrame) -> DataFrame:
    """The first threshold with the largest F0.5."""
    return grid.agg(F.max_by("threshold", F.struct("f05", (-F.col("threshold")).alias("t"))).alias("threshold"), F.max("f05").alias("f05"))


def stability(grid: DataFrame, around: float = 0.02) -> DataFrame:
    """How macro F0.5 moves in the chosen threshold's neighbourhood."""
    chosen = pick_macro(grid).select(F.col("threshold").alias("chosen"), F.col("macro_f05").alias("best"))
    return grid.crossJoin(chosen).filter(F.abs(F.col("threshold") - F.col("chosen")) <= around + 1e-9).select("threshold", "macro_f05", (F.col("macro_f05") - F.col("best")).alias("change"))


def source_mix(pairs: DataFrame, threshold: float) -> DataFrame:
    c = pairs.filter(F.col("prob") >= threshold).groupBy(ANCHOR).pivot("candidate_source", ["S2", "S3"]).count()
    mix = F.concat_ws("+", F.when(F.coalesce("S2", F.lit(0)) > 0, "S2"), F.when(F.coalesce("S3", F.lit(0)) > 0, "S3"))
    return c.groupBy(mix.alias("sources")).agg(F.count("*").alias("anchors"), F.sum(F.coalesce("S2", F.lit(0)) + F.coalesce("S3", F.lit(0))).alias("matches"))


def ties(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy(ANCHOR, "prob").agg(F.count("*").alias("n")).filter("n > 1")


def ambiguity(entity_rows: DataFrame) -> DataFrame:
    return entity_rows.groupBy("status").agg(F.count("*").alias("anchors"), F.avg("gap").alias("mean_gap"), F.avg("n_margin").alias("mean_margin"), F.avg(F.col("exact_set").cast("double")).alias("exact_share"))


def entity_errors(entity_rows: DataFrame, near: float = 0.85, unsure: float = 0.5) -> DataFrame:
    """Kinds of entity error; missed anchors are tiered by their best probability."""
    kind = F.when((F.col("n_true") == 0) & (F.col("n_predicted") > 0), "singleton_false_match").when((F.col("n_true") > 0) & (F.col("n_predicted") == 0), F.when(F.col("top1_prob") >= near, "missed_near_threshold").when(F.col("top1_prob") >= unsure, "missed_uncertain").otherwise("missed_low")).when((F.col("fp") > 0) & (F.col("fn") > 0), "mixed").when(F.col("fp") > 0, "extra_match").when(F.col("fn") > 0, "partial_match").otherwise("correct")
    return entity_rows.groupBy(kind.alias("kind")).agg(F.count("*").alias("anchors"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn"))


def top1_only(pairs: DataFrame, threshold: float) -> DataFrame:
    """Macro F0.5 with all matches and with each anchor's best alone."""
    best = ranked(pairs).withColumn("kept", F.when(F.col("rank_within_source1") == 1, F.col("prob")).otherwise(-1.0))
    full = macro_grid(pairs, [threshold]).select("macro_f05")
    one = macro_grid(best.withColumn("prob", F.col("kept")), [threshold]).select(F.col("macro_f05").alias("top1_macro_f05"))
    return full.crossJoin(one).withColumn("change", F.col("top1_macro_f05") - F.col("macro_f05"))


def singletons(entity_rows: DataFrame) -> DataFrame:
    alone = F.col("n_true") == 0
    return entity_rows.agg(F.sum(alone.cast("long")).alias("singletons"), F.sum((alone & (F.col("n_predicted") == 0)).cast("long")).alias("kept_alone"), F.sum((alone & (F.col("n_predicted") > 0)).cast("long")).alias("wrongly_matched"), F.avg(F.when(alone, F.col("top1_prob"))).alias("mean_top1"))


def topk_recall(ranked_pairs: DataFrame, truth: DataFrame, rank: str = "baseline_rank", ks=(1, 3, 5, 10)) -> DataFrame:
    """Recall within the first k of each anchor, over all true pairs and over those of each
    source; ranks are those among all of an anchor's candidates."""
    source = F.split_part(F.col(CANDIDATE), F.lit("-"), F.lit(1))
    parts = lambda df: df.withColumn("part", F.explode(F.array(F.lit("all"), source)))
    total = parts(truth).groupBy("part").agg(F.count("*").alias("total"))
    hits = parts(ranked_pairs.filter("label = 1")).groupBy("part").agg(*[F.sum((F.col(rank) <= k).cast("long")).alias(f"h{k}") for k in ks])
    one = total.join(hits, "part", "left")
    return one.select("part", F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.coalesce(f"h{k}", F.lit(0)).alias("found"), ratio(F.coalesce(f"h{k}", F.lit(0)), F.col("total")).alias("recall")) for k in ks])).alias("r")).select("part", "r.*")
