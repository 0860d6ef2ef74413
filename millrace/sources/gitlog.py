"""Git as a source: repositories, tracked files, log lines and diffs.

Listing is done on the driver; git itself runs in tasks, one repository or file at a time, so the repositories must be reachable from the executors.
Only text comes from here: parsing is in the commit and next-edit operators.
"""

from __future__ import annotations

import subprocess
from collections.abc import Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from millrace.shipping import ship

LOG_FORMAT = "__C__%H%x1f%ct%x1f%s"


def find_repos(roots: list[str], max_depth: int = 3) -> list[str]:
    """Folders with a .git entry at most ``max_depth`` levels below a root, sorted; node_modules is never entered."""
    found: set[str] = set()
    todo = [(Path(r), 0) for r in roots]
    while todo:
        folder, depth = todo.pop()
        if not folder.is_dir():
            continue
        if (folder / ".git").exists():
            found.add(str(folder))
        if depth < max_depth:
            todo += [(p, depth + 1) for p in folder.iterdir() if p.is_dir() and not p.is_symlink() and p.name not in ("node_modules", ".git")]
    return sorted(found)


def _git(repo: str, *args: str, timeout: int = 600) -> str:
    try:
        return subprocess.run(["git", *args], cwd=repo, capture_output=True, text=True, errors="replace", timeout=timeout).stdout
    except (subprocess.TimeoutExpired, OSError):
        return ""


def repo_table(spark: SparkSession, repos: list[str]) -> DataFrame:
    """repo (its path) and name, a partition for each."""
    rows = [(r, Path(r).name) for r in repos]
    return spark.createDataFrame(rows, "repo string, name string").repartition(max(1, len(rows)))


def _lines(*args: str):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for repo in frame["repo"]:
                lines = _git(repo, *args).splitlines()
                yield pd.DataFrame({"repo": repo, "line_no": range(len(lines)), "line": lines})

    return run


def log_lines(repos: DataFrame) -> DataFrame:
    """repo, line_no, line of the log: a header per commit, then its file counts."""
    ship(repos.sparkSession)
    return repos.mapInPandas(_lines("log", "--no-merges", "--numstat", "--no-renames", f"--format={LOG_FORMAT}"), "repo string, line_no long, line string")


def tracked_files(repos: DataFrame) -> DataFrame:
    """repo and path of the files tracked now."""
    ship(repos.sparkSession)
    return repos.mapInPandas(_lines("ls-files"), "repo string, line_no long, line string").selectExpr("repo", "line as path")


def diffs(touches: DataFrame, context: int = 10) -> DataFrame:
    """``touches`` (repo, sha, path) with the diff's text; empty where git fails."""
    ship(touches.sparkSession)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            text = [_git(r, "show", f"--unified={context}", "--format=", "--no-renames", s, "--", p, timeout=60) for r, s, p in zip(frame["repo"], frame["sha"], frame["path"], strict=True)]
            yield frame[["repo", "sha", "path"]].assign(diff=text)

    return touches.select("repo", "sha", "path").mapInPandas(run, "repo string, sha string, path string, diff string")
