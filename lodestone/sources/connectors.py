"""Connectors to what isn't Spark: providers by command or HTTP, file converters, portable manifests.

Providers answer one question at a time, so they are called from the driver; converters run on executors, file by
file, as a hook in mapInPandas."""

from __future__ import annotations

import json
import subprocess
import urllib.request
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PORTABLE = ("enabled", "status", "provider", "vault_id", "last_success", "counts", "errors")


def call_command(command: list[str], request: dict[str, Any], timeout: float = 120, good: Iterable[int] = (0, 2)) -> dict[str, Any]:
    """Runs a provider with the request on its input; the answer is one JSON object."""
    done = subprocess.run(command, input=json.dumps(request), capture_output=True, text=True, timeout=timeout, check=False)
    if done.returncode not in set(good):
        raise RuntimeError(f"the provider ended with {done.returncode}: {done.stderr[-500:]}")
    return _object(done.stdout)


def call_http(url: str, request: dict[str, Any], timeout: float = 120) -> dict[str, Any]:
    asked = urllib.request.Request(url, json.dumps(request).encode(), {"Content-Type": "application/json"})
    with urllib.request.urlopen(asked, timeout=timeout) as answer:
        return _object(answer.read().decode())


def _object(text: str) -> dict[str, Any]:
    found = json.loads(text)
    if not isinstance(found, dict):
        raise ValueError("the provider's answer is no JSON object")
    return found


def candidates(spark: SparkSession, answers: list[tuple[int, dict[str, Any]]]) -> DataFrame:
    """The candidates of providers' answers, one row each, with their rank."""
    rows = [(q, rank, json.dumps(c)) for q, a in answers for rank, c in enumerate(a.get("candidates", []), 1)]
    schema = "vault_path string, source string, line_start int, start_line int, line_end int, end_line int, heading string, snippet string, context string, score double, rrf_score double, rerank_score double, provider_ref string, source_sha256 string"
    raw = spark.createDataFrame(rows, "query_id long, rank int, json string")
    return raw.select("query_id", "rank", F.from_json("json", schema).alias("c")).select("query_id", "rank", "c.*")


def convert_files(spark: SparkSession, root: str, glob: str, converter: Callable[[str, bytes], str]) -> DataFrame:
    """path, markdown, error of each file that a converter turns into Markdown; a failure is a row of its own;
    empty files are passed over, as Spark reads none."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(root).select("path", "content")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for path, content in zip(frame["path"], frame["content"], strict=True):
                try:
                    out.append((path, converter(path, content), None))
                except Exception as e:
                    out.append((path, None, f"{type(e).__name__}: {e}"[:500]))
            yield pd.DataFrame(out, columns=["path", "markdown", "error"])

    return files.mapInPandas(run, "path string, markdown string, error string")


def portable_manifest(new: dict[str, Any], previous: dict[str, Any] | None = None) -> dict[str, Any]:
    """What of a sync's state may leave the machine; a failure keeps the last success."""
    kept = {k: new[k] for k in PORTABLE if k in new}
    if kept.get("status") != "ready" and previous and previous.get("last_success"):
        kept["last_success"] = previous["last_success"]
    return kept
