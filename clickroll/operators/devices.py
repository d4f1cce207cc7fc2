"""Clicks and download times per host and browser agent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickroll.functions.agents import describe_agent
from clickroll.functions.clean import is_desktop
from clickroll.schemas import AGENT_FIELDS


def describe_agents(agents: DataFrame, column: str = "agent_type") -> DataFrame:
    """Distinct agents with their details, in the shape of the dimension."""
    distinct = agents.select(F.col(column).alias("user_agent")).distinct()
    detail = F.struct(*[c.alias(n) for n, c in describe_agent("user_agent").items()])
    return distinct.select("user_agent", detail.alias("detail"))


def new_agents(agents: DataFrame, dim: DataFrame, column: str = "agent_type") -> DataFrame:
    """Agents the dimension does not hold yet, described; null agents left out."""
    seen = agents.where(F.col(column).isNotNull()).select(F.col(column).alias("user_agent"))
    unknown = seen.distinct().join(dim.select("user_agent"), "user_agent", "left_anti")
    return describe_agents(unknown, "user_agent")


def join_agent_dim(rows: DataFrame, dim: DataFrame, column: str = "agent_type") -> DataFrame:
    """Add the agent's details, from the dimension or else from its text.

    Unknown agents are described once each, not once a row.
    """
    return with_details(rows, dim.unionByName(new_agents(rows, dim, column)), column)


def with_details(rows: DataFrame, agents: DataFrame, column: str = "agent_type") -> DataFrame:
    """Add details from a table of all agents the rows have; null agents are "unknown".

    No broadcast hint: the dimension grows with the agents seen, so Spark picks
    by its size.  Rows should be aggregated per agent before they come here.
    """
    known = agents.select(F.col("user_agent").alias("_agent"), F.col("detail").alias("_detail"))
    detail = {name: F.coalesce(F.col("_detail")[name], F.lit("unknown")) for name in AGENT_FIELDS}
    joined = rows.join(known, F.col(column) == F.col("_agent"), "left")
    return joined.withColumns(detail).drop("_agent", "_detail")


def host_agent_sums(events: DataFrame, slice_col: Column) -> DataFrame:
    """Elements and download time per slice, host and agent."""
    return events.groupBy(slice_col.alias("slice"), "host", "agent_type").agg(
        F.sum("elements").alias("total_count"), F.sum("dnld_time").alias("total_time")
    )


def host_agent(sums: DataFrame, dim: DataFrame) -> DataFrame:
    """One row per host and agent: device, browser, count, download time and its average.

    Two agents of the same browser stay two rows.  The time itself is kept, so
    rows of several batches can be put together.
    """
    return described_sums(join_agent_dim(sums, dim))


def described_sums(rows: DataFrame) -> DataFrame:
    """Sums with agent details as rows of the host-agent table."""
    return rows.select(
        "slice", "host",
        is_desktop("device_category").alias("device"),
        F.col("browser_name").alias("browser"),
        F.col("total_count").alias("count"),
        "total_time",
        F.expr("total_time div total_count").alias("avg_time"),
    )


def host_device_deltas(rows: DataFrame) -> DataFrame:
    """What a batch adds to the counter per host, device and browser."""
    return rows.groupBy("host", "device", "browser").agg(F.sum("count").alias("count"))
