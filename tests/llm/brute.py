"""Plain versions of the operators for small inputs."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
#: Columns whose names the operators use for their own.
CLASHING = ["key", "words", "found", "bucket", "g", "fp", "component_id", "host", "n_words", "secrets", "rule"]


def frame(spark: SparkSession, rows: list[tuple[int | None, str | None]]) -> DataFrame:
    """(doc_id, text) rows with further columns that have clashing names."""
    extra = ", ".join(f"{c} string" for c in CLASHING)
    return spark.createDataFrame([(d, t, *["x"] * len(CLASHING)) for d, t in rows], f"doc_id bigint, text string, {extra}")


def plain_words(text: str | None) -> list[str]:
    return SPACE.findall(text or "")


def components(nodes: list, linked) -> dict:
    """Of each node the least that links reach."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}
