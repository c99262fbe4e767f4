"""Discovery, all-text TSV scans and TSV sinks."""

from __future__ import annotations

import fnmatch
import re
from dataclasses import dataclass
from pathlib import PurePosixPath

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# Words in paths that tell splits and roles.
SPLITS = {"train": ("train", "training"), "test": ("test", "testing", "eval")}
TRUTH = ("ground_truth", "groundtruth", "truth", "labels", "matches")


@dataclass(frozen=True)
class SourceFile:
    path: str
    split: str | None
    role: str
    source_index: int | None
    size: int


def classify(path: str, settings=None) -> tuple[str | None, str, int | None]:
    """(split, role, source number) from the words of a path; whole words count first, and
    words for the ground truth before those for a source.  ``settings`` may name the words."""
    text, stem = path.lower(), PurePosixPath(path.lower()).stem
    splits = {s: (k,) for s, k in settings.split_keywords.items()} if settings else SPLITS
    truth = settings.dataset["ground_truth_keywords"] if settings else TRUTH
    sources = settings.dataset["source_keywords"] if settings else ("source",)
    words = re.split(r"[^a-z0-9]+", text)
    split = next((s for s, keys in splits.items() if any(k in words for k in keys)), None) or next((s for s, keys in splits.items() if any(k in text for k in keys)), None)
    if any(k in (stem if settings else text) for k in truth):
        return split, "ground_truth", None
    role = "source" if any(k in stem for k in sources) else "unknown"
    found = next((m for k in sources if (m := re.search(re.escape(k) + r"[^0-9]*([0-9]+)", stem))), None)
    return split, role, int(found[1]) if found and role == "source" else None


def ignored(path: str, patterns: tuple[str, ...]) -> bool:
    """Does a pattern match the path or its last part, or, ending in /**, the path's folder?"""
    name = PurePosixPath(path).name
    below = [p[:-3].rstrip("*") for p in patterns if p.endswith("/**")]
    return any(fnmatch.fnmatch(path, p) or fnmatch.fnmatch(name, p) for p in patterns) or any(path.startswith(b + "/") or b and f"/{b.strip('/')}/" in path for b in below)


def discover(spark: SparkSession, root: str, pattern: str = "*.tsv", ignore: tuple[str, ...] = (), settings=None) -> list[SourceFile]:
    """Files below a folder of any store Spark reads, in path order."""
    if settings:
        pattern, ignore = "*{" + ",".join(settings.dataset["extensions"]) + "}", (*ignore, *settings.dataset["ignore_globs"])
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root).select("path", "length").collect()
    out = []
    for r in sorted(listed):
        relative = r.path.split(root.rstrip("/").split(":", 1)[-1] + "/", 1)[-1]
        if ignored(relative, ignore):
            continue
        out.append(SourceFile(r.path, *classify(relative, settings), r.length))
    return out


@dataclass(frozen=True)
class Catalogue:
    """Found files by what they are for; a split that may not be read stays out of reach."""

    files: tuple[SourceFile, ...]
    read_split: str | None = None

    def _of(self, split: str | None, role: str) -> list[SourceFile]:
        return [f for f in self.files if f.role == role and (split is None or f.split == split)]

    def sources(self, split: str) -> list[SourceFile]:
        """A split's numbered sources in the order of their numbers."""
        return sorted((f for f in self._of(split, "source") if f.source_index is not None), key=lambda f: (f.source_index, f.path))

    def ground_truth(self, split: str = "train") -> SourceFile | None:
        """The one file of true matches; none if there are several."""
        found = self._of(split, "ground_truth")
        return found[0] if len(found) == 1 else None

    def source(self, split: str, number: int) -> SourceFile:
        found = [f for f in self.sources(split) if f.source_index == number]
        if not found:
            raise FileNotFoundError(f"no source {number} in {split}")
        return found[0]

    def readable(self) -> list[SourceFile]:
        """Files of the split that may be read (all without such a rule)."""
        return [f for f in self.files if self.read_split is None or f.split == self.read_split]


def source_stats(df: DataFrame, key: str = "entity_id", group: str = "country") -> DataFrame:
    """Rows, distinct ids and rows by group, one row a group and one for all (group null)."""
    return df.groupBy(group).agg(F.count("*").alias("rows"), F.countDistinct(key).alias("ids")).unionByName(df.agg(F.lit(None).cast(df.schema[group].dataType).alias(group), F.count("*").alias("rows"), F.countDistinct(key).alias("ids")))


def raw_texts(pairs: DataFrame, sources: list[DataFrame], anchor: str = "source1_entity_id", candidate: str = "candidate_entity_id") -> DataFrame:
    """The source rows, as they are, of all ids that pairs hold."""
    wanted = pairs.select(F.col(anchor).alias("entity_id")).union(pairs.select(candidate)).distinct()
    out = None
    for s in sources:
        part = s.join(wanted, "entity_id", "left_semi")
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def header(spark: SparkSession, path: str, sep: str = "\t") -> list[str]:
    first = spark.read.text(path).limit(1).collect()
    return first[0][0].split(sep) if first else []


def read_tsv(spark: SparkSession, path: str, columns: list[str] | None = None, sep: str = "\t") -> DataFrame:
    """Every column as text; only an empty field is null; unwanted columns are not parsed."""
    names = header(spark, path, sep)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    df = spark.read.csv(path, sep=sep, header=True, schema=schema, nullValue="", quote="", mode="PERMISSIVE", encoding="UTF-8")
    return df.select(*columns) if columns else df


def _in_file_order(df: DataFrame) -> DataFrame:
    """The rows with their place, _at: file by path, block and row in it.  Spark deals large
    files out first, so its row numbers alone follow no order of files; rows of no file have
    nothing else."""
    row = F.monotonically_increasing_id()
    try:
        return df.select("*", F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), row.alias("row")).alias("_at"))
    except AnalysisException:
        return df.withColumn("_at", row)


def leading(df: DataFrame, n: int) -> DataFrame:
    """The first n rows in file order."""
    return _in_file_order(df).orderBy("_at").limit(n).drop("_at")


def needed(df: DataFrame, wanted: DataFrame, key: str = "entity_id") -> DataFrame:
    """Rows whose key is wanted; of rows with one key the last in file order."""
    rows = _in_file_order(df).join(wanted.select(key).distinct(), key, "left_semi").select(key, F.struct("_at", *df.columns).alias("_row"))
    return rows.groupBy(key).agg(F.max_by("_row", "_row._at").alias("_row")).select("_row.*").drop("_at").select(*df.columns)


def pool(sources: list[DataFrame], wanted: DataFrame, background: int, key: str = "entity_id") -> DataFrame:
    """Leading rows of each source with all wanted rows, one a key."""
    out = None
    for s in sources:
        part = leading(s, background).unionByName(needed(s, wanted, key))
        out = part if out is None else out.unionByName(part)
    return out.dropDuplicates([key])


def write_tsv(df: DataFrame, path: str) -> None:
    """Tab-separated with a header; part files stay as the job wrote them."""
    df.write.mode("overwrite").csv(path, sep="\t", header=True, quote="", emptyValue="", nullValue="")


def write_partitioned(df: DataFrame, path: str, *by: str) -> None:
    df.write.mode("overwrite").partitionBy(*by).parquet(path)
