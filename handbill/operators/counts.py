"""Counts of a run that the run itself gathers, without another look at its inputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class Counts:
    """Rows that pass named places of a plan, and of these the ones for which conditions hold.

    counts = Counts(); rows = counts.at("read", rows, failed=F.col("v").isNull()); ...write...; counts.taken()
    Numbers are there once the plan has run to its end, and are of its first run. A place in a plan that Spark works out more than once is
    counted as often, so places belong before a table is written, not inside what several joins read.
    """

    def __init__(self):
        self.places: dict[str, Observation] = {}

    def at(self, place: str, rows: DataFrame, **conditions: Column) -> DataFrame:
        """rows as they are, counted under `place` as `rows` and by each condition (null: it doesn't hold)."""
        if place in self.places:
            raise ValueError(f"{place} is counted already")
        seen = Observation(place)
        self.places[place] = seen
        return rows.observe(seen, F.count(F.lit(1)).alias("rows"), *[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in conditions.items()])

    def taken(self) -> dict[str, dict[str, int]]:
        """Numbers by place; waits for the run to end."""
        return {place: dict(seen.get) for place, seen in self.places.items()}

    def table(self, like: DataFrame) -> DataFrame:
        """(place, what, n) of what was counted, in the session of `like`."""
        rows = [(place, what, n) for place, own in self.taken().items() for what, n in own.items()]
        return like.sparkSession.createDataFrame(rows, "place string, what string, n bigint")
