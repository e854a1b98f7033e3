"""Summary and release outputs."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark.sql import DataFrame, functions as F

from nightgrid import constants as K
from nightgrid.operators.contracts import ContractError, missing_columns
from nightgrid.operators.reshape import one_row_to_pairs

CONCURRENT_WRITES = 6
RELEASE_SUMMARIES = (
    "detector_summary", "study_summary", "species_summary", "hourly_summary",
)


def run_together(actions: Sequence[Callable[[], object]]) -> list:
    """Run independent Spark actions at the same time and return their results.

    Small jobs leave executors idle while one of them plans or waits for its last
    task; started together they fill each other's gaps.
    """
    with ThreadPoolExecutor(max_workers=max(1, min(CONCURRENT_WRITES, len(actions)))) as pool:
        return [job.result() for job in [pool.submit(action) for action in actions]]


def summary_layout(name: str, df: DataFrame) -> DataFrame:
    """The file layout of a summary: one-row tables are stood upright."""
    if name == "study_summary":
        return one_row_to_pairs(df, "metric", "value")
    if name == "variance_components":
        return df.unpivot([], df.columns, "component", "value")
    return df


def write_summary_tables(
    summaries: Mapping[str, DataFrame],
    root: str,
    enabled: Iterable[str] | None = None,
    fmt: str = "csv",
) -> list[str]:
    """Write each enabled summary to its own folder; returns the names written."""
    names = [n for n in summaries if enabled is None or n in set(enabled)]

    def write(name: str) -> None:
        table = summary_layout(name, summaries[name])
        writer = table.write.option("header", True) if fmt == "csv" else table.write
        writer.format(fmt).save(f"{root}/{name}")

    run_together([partial(write, name) for name in names])
    return names


def release_problems(grid: DataFrame, master: DataFrame) -> list[str]:
    """Contract violations of a release.  Runs one small query for NULL detectors."""
    problems = []
    absent = missing_columns(grid, K.GRID_REQUIRED)
    if absent:
        problems.append(f"grid lacks columns: {', '.join(absent)}")
    if dict(grid.dtypes).get("Night") != "date":
        problems.append("grid column Night must be a date")
    if "Detector" in grid.columns:
        if not grid.where(F.col("Detector").isNull()).isEmpty():
            problems.append("grid column Detector holds NULLs")
    absent = missing_columns(master, K.MASTER_REQUIRED)
    if absent:
        problems.append(f"master lacks columns: {', '.join(absent)}")
    return problems


def write_release(
    grid: DataFrame, master: DataFrame, summaries: Mapping[str, DataFrame], root: str
) -> list[str]:
    """Check the contracts, then write grid, master and the released summaries."""
    problems = release_problems(grid, master)
    if problems:
        raise ContractError("; ".join(problems))
    tables = {"calls_per_night": grid, "master": master}
    tables |= {f"summary/{n}": summaries[n] for n in RELEASE_SUMMARIES if n in summaries}
    run_together(
        [partial(df.write.parquet, f"{root}/{name}") for name, df in tables.items()]
    )
    return list(tables)
