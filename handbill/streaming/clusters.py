"""Clusters of events as they arrive: the state of a run is what later events have to be held against."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from handbill.operators.events import STRONG, WEAK, normal
from handbill.operators.matching import FirstFit

#: The state store that keyed state of this kind needs.
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
GROUP = T.StructType([T.StructField("name", T.StringType()), T.StructField("date", T.StringType())])
ROOT = T.StructType([T.StructField("root", T.LongType())])


class RunClusters(StatefulProcessor):
    """Keeps, for each name and date of a run, the least root that events of theirs have reached."""

    def __init__(self, strong: float, weak: float):
        self.strong, self.weak = strong, weak

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.groups = handle.getMapState("groups", GROUP, ROOT)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803 - Spark's names
        new = pd.concat(list(rows)).sort_values("ordinal", kind="stable")
        known = {tuple(k): v[0] for k, v in self.groups.iterator()}
        clusters = FirstFit(self.strong, self.weak, known)
        root = clusters.add(new["ordinal"].tolist(), new["compared_name"].tolist(), new["compared_date"].tolist())
        for group, least in clusters.groups.items():
            if known.get(group) != least:
                self.groups.updateValue(group, (least,))
        yield new.drop(columns=["compared_name", "compared_date"]).assign(root=root)

    def close(self) -> None:
        pass


def cluster_stream(events: DataFrame, strong: float = STRONG, weak: float = WEAK) -> DataFrame:
    """A stream of events with root, as operators.events.cluster gives it to all events at once.

    Clusters never change when events are added at the end, so an event's root is final when it arrives. Events of a run have to
    arrive in the order of their ordinals (numbers), those of one batch in any order. State is a row for each distinct name
    and date of a run, kept as long as the query is: a run has no end that data could tell. The session's
    spark.sql.streaming.stateStore.providerClass has to be STORE.
    """
    schema = T.StructType([*events.schema.fields, T.StructField("root", T.LongType())])
    return normal(events).groupBy("run_id").transformWithStateInPandas(RunClusters(strong, weak), schema, "Append", "None")
