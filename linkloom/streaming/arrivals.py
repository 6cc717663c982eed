"""Records that arrive as a stream, linked to a static Source 1.

Every micro-batch is normalised, blocked and capped with the batch operators and appended to a table; Source 1
stays as it is. A batch that is run again after a failure replaces its own rows, so a pair appears once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from linkloom.config import Blocking
from linkloom.operators.blocking import capped_union
from linkloom.operators.records import normalized


def link_arrivals(arrivals: DataFrame, s1: DataFrame, cfg: Blocking, path: str, checkpoint: str, finish: Callable[[DataFrame], DataFrame] = lambda pairs: pairs) -> StreamingQuery:
    """Start linking ``arrivals`` (records with source_tag); candidates of batch n go to ``path``/batch=n."""

    def each(batch: DataFrame, number: int) -> None:
        finish(capped_union(cfg, s1, normalized(batch))).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return arrivals.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
