"""The gate: checks in order, the first that finds anything closes it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

ORDER = ("integrity", "differential", "gold", "taxonomy", "narratives")


def run(spark: SparkSession, checks: dict[str, Callable[[], DataFrame]], only: tuple[str, ...] | None = None, order: tuple[str, ...] = ORDER) -> DataFrame:
    """(position, stage, outcome, violations) with outcome pass, fail or not_run.

    Checks return violations and are built when their turn comes, so nothing
    after a failure runs.  Unknown stages are an error.
    """
    wanted = only or tuple(s for s in order if s in checks)
    unknown = [s for s in wanted if s not in checks]
    if unknown:
        raise ValueError(f"unknown stages: {unknown}")
    rows, closed = [], False
    for i, stage in enumerate(wanted):
        if closed:
            rows.append((i, stage, "not_run", None))
            continue
        n = checks[stage]().count()
        closed = n > 0
        rows.append((i, stage, "fail" if closed else "pass", n))
    return spark.createDataFrame(rows, "position bigint, stage string, outcome string, violations bigint")


def report(rows: DataFrame) -> tuple[list[str], int]:
    """The gate's lines in the order of stages, and the exit code: 0 if it is open, else 1."""
    lines = [f"[{r.stage}] {r.outcome}" + (f" ({r.violations} violations)" if r.violations else "") for r in rows.orderBy("position").collect()]
    closed = rows.where("outcome = 'fail'").select("stage").first()
    return [*lines, f"closed at {closed.stage}" if closed else "open"], int(closed is not None)


def examples(violations: DataFrame, most: int = 5) -> list[dict]:
    """A few of the violations, in their own order of columns, to show with a failing check."""
    return [r.asDict(recursive=True) for r in violations.orderBy(*violations.columns).limit(most).collect()]


def require_empty(violations: DataFrame, what: str) -> None:
    """Stop before work that needs a check to hold."""
    if not violations.isEmpty():
        raise RuntimeError(f"{what}: the check doesn't hold")
