"""Intake of bundles as a stream: new and repaired ones are validated as they come."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from quillmark.operators import bundles


def validate_stream(files: DataFrame, sink: Callable[[DataFrame, DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """files: a stream of the rows of sources.bundles, whole bundles in one batch.

    For each batch sink gets (verdicts, violations, batch number). Papers are independent, so
    nothing is kept between batches; a repaired bundle comes whole and is judged anew.
    """

    def judge(batch: DataFrame, number: int) -> None:
        found = bundles.violations(batch).persist()
        try:
            sink(bundles.verdicts(batch, found), found, number)
        finally:
            found.unpersist()

    return files.writeStream.foreachBatch(judge).option("checkpointLocation", checkpoint).start()
