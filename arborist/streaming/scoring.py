"""Scoring a Structured Streaming DataFrame with a fitted tree.

Prediction is a stateless projection (one ``CASE WHEN`` per level), so the
same expression applies to every micro-batch: no state store, no
watermark, no shuffle.  Fitting stays a batch job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from ..plans.tree import PREDICTED_LABEL, TreeModel


def score_stream(model: TreeModel, stream: DataFrame, output_col: str = PREDICTED_LABEL) -> DataFrame:
    """Streaming DataFrame of ``stream``'s rows with the predicted label added."""
    if not stream.isStreaming:
        raise ValueError("score_stream expects a streaming DataFrame; use model.predict for batch data")
    return model.predict(stream, output_col)


def scored_stream_writer(model: TreeModel, stream: DataFrame, checkpoint_location: str,
                         output_col: str = PREDICTED_LABEL) -> DataStreamWriter:
    """Append-mode writer of the scored stream with its own checkpoint location
    (required for exactly-once file sinks and restart after failure)."""
    return (
        score_stream(model, stream, output_col)
        .writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint_location)
    )
