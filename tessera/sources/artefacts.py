"""Artefacts of a run: JSON, YAML, Markdown and HTML texts, manifests, checkpoints.

Texts are written by Spark's own writers, so any store that Spark reaches will do.
"""

from __future__ import annotations

import datetime
import decimal
import html
import json
import subprocess

from pyspark.sql import DataFrame, Row, SparkSession


def plain(value):
    """Rows, dates and decimals as what JSON can hold."""
    if isinstance(value, Row):
        return {k: plain(v) for k, v in value.asDict().items()}
    if isinstance(value, dict):
        return {str(k): plain(v) for k, v in value.items()}
    if isinstance(value, (list, tuple, set)):
        return [plain(v) for v in value]
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float) and (value != value or value in (float("inf"), float("-inf"))):
        return None
    return value


def write_text(spark: SparkSession, text: str, path: str) -> None:
    """One text as one file below ``path``."""
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path, lineSep="\0")


def read_text(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first().value.rstrip("\0")


def write_json(spark: SparkSession, value, path: str) -> None:
    write_text(spark, json.dumps(plain(value), ensure_ascii=False, indent=2), path)


def read_json(spark: SparkSession, path: str):
    return json.loads(read_text(spark, path))


def table_rows(df: DataFrame, most: int) -> tuple[list[str], list[list[str]], bool]:
    """A report's rows: at most ``most``, and whether there are more."""
    rows = df.limit(most + 1).collect()
    show = lambda v: "" if v is None else f"{v:.6g}" if isinstance(v, float) else str(v)
    return df.columns, [[show(v) for v in r] for r in rows[:most]], len(rows) > most


def _cell(text: str) -> str:
    return text.replace("\\", "\\\\").replace("|", "\\|").replace("\n", " ")


def render_markdown(title: str, sections: dict[str, DataFrame | str], most: int = 50) -> str:
    """A report: a heading for each section, with its text or its table."""
    out = [f"# {title}", ""]
    for name, content in sections.items():
        out += [f"## {name}", ""]
        if isinstance(content, str):
            out += [content, ""]
            continue
        columns, rows, more = table_rows(content, most)
        out += ["| " + " | ".join(map(_cell, columns)) + " |", "|" + " --- |" * len(columns), *("| " + " | ".join(map(_cell, r)) + " |" for r in rows)]
        out += ["", *([f"(the first {most} rows)", ""] if more else [])]
    return "\n".join(out)


def render_html(title: str, sections: dict[str, DataFrame | str], most: int = 50) -> str:
    out = [f"<!DOCTYPE html><html><head><meta charset='utf-8'><title>{html.escape(title)}</title></head><body><h1>{html.escape(title)}</h1>"]
    for name, content in sections.items():
        out.append(f"<h2>{html.escape(name)}</h2>")
        if isinstance(content, str):
            out.append(f"<p>{html.escape(content)}</p>")
            continue
        columns, rows, more = table_rows(content, most)
        line = lambda tag, cells: "<tr>" + "".join(f"<{tag}>{html.escape(c)}</{tag}>" for c in cells) + "</tr>"
        out += ["<table>", line("th", columns), *(line("td", r) for r in rows), "</table>", *([f"<p>(the first {most} rows)</p>"] if more else [])]
    return "\n".join([*out, "</body></html>"])


def render_rules(rules: dict[str, dict[str, str]]) -> str:
    """Rule proposals as YAML, a table each, sorted."""
    import yaml

    return yaml.safe_dump({k: dict(sorted(v.items())) for k, v in rules.items()}, allow_unicode=True, sort_keys=True, default_flow_style=False)


def feature_metadata(registry: list[dict]) -> dict:
    return {"feature_count": len(registry), "features": registry}


def git_facts(folder: str) -> dict:
    """Commit and cleanness of a folder; nulls where it is no repository."""
    run = lambda *a: subprocess.run(["git", "-C", folder, *a], capture_output=True, text=True)
    head, status = run("rev-parse", "HEAD"), run("status", "--porcelain")
    return {"commit": head.stdout.strip() or None if head.returncode == 0 else None, "clean": not status.stdout.strip() if status.returncode == 0 else None}


def manifest(facts: dict, folder: str = ".") -> dict:
    """Counts of a run and where it came from; what is not known yet is PENDING."""
    return {k: "PENDING" if v is None else plain(v) for k, v in {**facts, **git_facts(folder)}.items()}


def write_checkpoint(scored: DataFrame, path: str, by: str = "country") -> None:
    """Scored pairs by partition; a partition that is written again replaces itself."""
    scored.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def mark_done(spark: SparkSession, path: str, facts: dict | None = None) -> None:
    write_json(spark, {"done": True, **(facts or {})}, f"{path}/_done")


def is_done(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_done/_SUCCESS")
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)
