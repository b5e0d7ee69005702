"""Streaming inference: score the parsed topic with a saved model.

The model is fitted and saved by the batch side (``PipelineModel.save`` to
the shared folder); the stream loads it once and applies it per micro-batch
as an ordinary projection (no state, no shuffle).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ratelake.streaming.consumer import with_trigger


def score_stream(parsed: DataFrame, model_path: str, features: Sequence[str],
                 keep: Sequence[str] = ()) -> DataFrame:
    """Every row, scored by the saved model; a row without one of the
    ``features`` keeps a null prediction."""
    model = PipelineModel.load(model_path)
    for stage in model.stages:
        if isinstance(stage, VectorAssembler):
            stage.setHandleInvalid("keep")  # such rows get no prediction below
    ready = F.lit(True)
    for f in features:
        ready = ready & F.col(f).isNotNull()
    scored = model.transform(parsed)
    return scored.select(*keep, F.when(ready, F.col("prediction")).alias("prediction"))


def start_scoring(scored: DataFrame, path: str, checkpoint: str, trigger: str | None = "availableNow") -> StreamingQuery:
    w = scored.writeStream.outputMode("append").format("parquet").option("path", path)
    w = w.option("checkpointLocation", checkpoint)
    return with_trigger(w, trigger).start()
