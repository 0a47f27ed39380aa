"""User functions on rows: hooks, budgeted scoring, paired views, seed and expand."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.windows import first_rows


def apply_hook(df: DataFrame, hook: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """A function on the frame, for column code."""
    return df.transform(hook)


def apply_batch_hook(df: DataFrame, hook: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """A Python function on Arrow batches, for code that cannot be columns."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield hook(batch)

    return df.mapInPandas(run, schema)


def row_budget(calls: int, calls_per_row: int) -> int:
    return max(0, calls // calls_per_row)


def budgeted_score(df: DataFrame, key: str, text: str, score: Callable[[Column], Column], name: str, budget: int,
                   order: Sequence[str] | None = None, heap: bool = False) -> DataFrame:
    """Scores for the first ``budget`` rows that have a text, NULL for the others.

    Only the chosen rows reach the scorer; ``key`` is unique, so the join back adds no row. ``heap`` as in first_rows.
    """
    chosen = first_rows(df.filter(F.col(text).isNotNull() & (F.col(text) != "")).select(key, text, *(order or [])),
                        order or [key], budget, heap)
    scored = chosen.select(key, score(F.col(text)).alias(name))
    return df.join(scored, key, "left")


def consensus(df: DataFrame, first: str, second: str, judge: Callable[[Column, Column], Column], name: str = "consensus",
              differs: str = "disagrees") -> DataFrame:
    """A third view on the rows where both views exist, and whether they disagree."""
    both = df.filter(F.col(first).isNotNull() & F.col(second).isNotNull())
    return both.withColumns({name: judge(F.col(first), F.col(second)), differs: F.col(first) != F.col(second)})


def assessment_rows(df: DataFrame, key: str, answer: str, schema: str, kind: str) -> DataFrame:
    """A scorer's JSON answer as flat columns with key and type label; empty or bad answers give no row."""
    parsed = df.select(key, F.from_json(answer, schema).alias("_a"))
    members = [f"_a.{f.name}" for f in parsed.schema["_a"].dataType.fields]
    filled = F.coalesce(*[F.when(F.col(m).isNotNull(), F.lit(True)) for m in members], F.lit(False))
    return parsed.filter(filled).select(key, F.lit(kind).alias("assessment_type"), "_a.*")


def seed_and_expand(facts: DataFrame, links: DataFrame, seed: DataFrame, item: str, hops: int, step_limit: int | None = None) -> DataFrame:
    """Counts per item for the seeds and for the items reached from them, with the hop."""
    from tidemark.operators.joins import expand_frontier

    reached = expand_frontier(seed, links, hops, step_limit)
    counts = facts.groupBy(F.col(item).alias("item")).agg(F.count("*").alias("n"))
    return reached.join(counts, "item", "left").withColumn("n", F.coalesce("n", F.lit(0)))
