"""Two result files: assembled in the roster's order, written, read back and validated."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tessera.operators.blocking import ANCHOR, CANDIDATE
from tessera.operators.resolution import id_lists

MATCHES, CANDIDATES = "matched_entity_ids", "candidate_entity_ids"
# Rules of a result file in order.
RULES = ("comma_separated", "bad_header", "no_tab", "duplicate_anchor", "duplicate_in_list", "self_match", "bad_prefix", "unknown_id", "missing_anchor", "extra_anchor")


def with_place(roster: DataFrame) -> DataFrame:
    """Anchors with their place in the file they came from, the first of repeated ones."""
    return roster.select(ANCHOR).withColumn("place", F.monotonically_increasing_id()).groupBy(ANCHOR).agg(F.min("place").alias("place"))


def assemble(roster: DataFrame, matches: DataFrame, candidates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(match lists, candidate lists) with one row for every anchor, in the roster's order;
    matches likeliest first, candidates by id."""
    placed = with_place(roster)
    ordered = lambda lists, name: lists.join(placed, ANCHOR).orderBy("place").select(ANCHOR, name)
    return ordered(id_lists(placed, matches), MATCHES), ordered(id_lists(placed, candidates, CANDIDATES, by_probability=False), CANDIDATES)


def write_lists(lists: DataFrame, path: str) -> None:
    """Tab-separated lines below a header, in the order of the rows: part files sort by it."""
    lists.write.mode("overwrite").csv(path, sep="\t", header=True, quote="", emptyValue="", nullValue="")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """A file's lines with their numbers' order: (at, line)."""
    return spark.read.text(path).select(F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"))


def parse(lines: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """(header faults as rows (rule, item), rows (anchor, ids, has_tab) without header and
    blank lines).  Every part file may repeat the header."""
    head = lines.orderBy("at").limit(1)
    names = F.transform(F.split("line", "\t"), lambda c: F.lower(F.trim(c)))
    comma = ~F.contains(F.col("line"), F.lit("\t")) & F.contains(F.col("line"), F.lit(","))
    fault = F.when(comma, "comma_separated").when(names != F.array(F.lit(ANCHOR), F.lit(column)), "bad_header")
    faults = head.select(fault.alias("rule"), F.col("line").alias("item")).filter("rule is not null")
    body = lines.filter((F.trim("line") != "") & (F.lower("line") != f"{ANCHOR}\t{column}"))
    rest = F.regexp_replace("line", "^[^\t]*\t?", "")
    ids = F.when(F.trim(rest) == "", F.array().cast("array<string>")).otherwise(F.split(rest, ","))
    return faults, body.select(F.split_part("line", F.lit("\t"), F.lit(1)).alias(ANCHOR), ids.alias("ids"), F.contains(F.col("line"), F.lit("\t")).alias("has_tab"), "line")


def violations(lines: DataFrame, column: str, roster: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Offending items of a result file by rule: rows (rule, item).  Without ``known`` the ids
    of lists are not looked up."""
    faults, body = parse(lines, column)
    good = body.filter("has_tab")
    edges = good.select(ANCHOR, F.explode("ids").alias(CANDIDATE))
    prefix = F.split_part(F.col(CANDIDATE), F.lit("-"), F.lit(1))
    anchors = roster.select(ANCHOR).distinct()
    rows = lambda rule, df, item: df.select(F.lit(rule).alias("rule"), F.col(item).alias("item"))
    parts = [
        faults, rows("no_tab", body.filter("not has_tab"), "line"), rows("duplicate_anchor", good.groupBy(ANCHOR).count().filter("count > 1"), ANCHOR),
        rows("duplicate_in_list", good.filter(F.size("ids") != F.size(F.array_distinct("ids"))).select(ANCHOR).distinct(), ANCHOR), rows("self_match", edges.filter(prefix == "S1").select(CANDIDATE).distinct(), CANDIDATE),
        rows("bad_prefix", edges.filter(~prefix.isin("S1", "S2", "S3") | ~F.contains(F.col(CANDIDATE), F.lit("-"))).select(CANDIDATE).distinct(), CANDIDATE),
        rows("missing_anchor", anchors.join(good.select(ANCHOR), ANCHOR, "left_anti"), ANCHOR), rows("extra_anchor", good.select(ANCHOR).distinct().join(anchors, ANCHOR, "left_anti"), ANCHOR),
    ]
    if known is not None:
        target = edges.filter(prefix.isin("S2", "S3")).select(CANDIDATE).distinct()
        parts.append(rows("unknown_id", target.join(known.select(F.col("entity_id").alias(CANDIDATE)).distinct(), CANDIDATE, "left_anti"), CANDIDATE))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def validate_file(lines: DataFrame, column: str, roster: DataFrame, known: DataFrame | None = None, examples: int = 5) -> DataFrame:
    """A row for each rule that is broken: how often, and the first few items."""
    v = violations(lines, column, roster, known)
    ranked = v.withColumn("_r", F.row_number().over(Window.partitionBy("rule", F.pmod(F.xxhash64("item"), F.lit(32))).orderBy("item")))
    some = ranked.filter(F.col("_r") <= examples).groupBy("rule").agg(F.array_join(F.slice(F.array_sort(F.collect_list("item")), 1, examples), ", ").alias("examples"))
    return v.groupBy("rule").agg(F.count("*").alias("violations")).join(some, "rule")


def not_subset(matches: DataFrame, candidates: DataFrame) -> DataFrame:
    """Anchors of two parsed files with matched ids that are no candidates."""
    m, c = matches.select(ANCHOR, "ids"), candidates.groupBy(ANCHOR).agg(F.flatten(F.collect_list("ids")).alias("held"))
    return m.join(c, ANCHOR, "left").filter(F.size(F.array_except("ids", F.coalesce("held", F.array().cast("array<string>")))) > 0).select(ANCHOR)


def verdict(spark: SparkSession, matching: str, roster: DataFrame, candidate: str | None = None, known: DataFrame | None = None, lenient: bool = False) -> tuple[str, DataFrame | None]:
    """PASS, FAIL or PENDING (a file is not there yet) with the findings as rows (file, rule,
    violations, examples, severity).  Lenient: matches outside the candidates only warn, and
    the candidate file may be absent."""
    exists = lambda p: (place := spark._jvm.org.apache.hadoop.fs.Path(p)).getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)
    if not exists(matching) or (candidate and not exists(candidate) and not lenient):
        return "PENDING", None
    files = [("matching", matching, MATCHES)] + ([("candidate", candidate, CANDIDATES)] if candidate and exists(candidate) else [])
    found = None
    for name, path, column in files:
        one = validate_file(read_lines(spark, path), column, roster, known).select(F.lit(name).alias("file"), "rule", "violations", "examples", F.lit("error").alias("severity"))
        found = one if found is None else found.unionByName(one)
    if len(files) == 2:
        stray = not_subset(*(parse(read_lines(spark, path), column)[1] for _, path, column in files))
        stray = stray.agg(F.count("*").alias("violations"), F.min(ANCHOR).alias("examples")).filter("violations > 0")
        found = found.unionByName(stray.select(F.lit("matching").alias("file"), F.lit("not_subset").alias("rule"), "violations", "examples", F.lit("warning" if lenient else "error").alias("severity")))
    return ("FAIL" if not found.filter("severity = 'error'").isEmpty() else "PASS"), found
