"""Anomaly scoring of arriving asset files with a saved forest (M3 on a stream).

The basic scorer fills missing capacity with the median of the batch it scores,
so it is applied per micro-batch with ``foreachBatch``; a two-layer bundle joins each
batch with its stored tables, so a row's score does not depend on its batch.  Each batch is written
to its own ``batch_id=<n>`` folder with overwrite, so a batch replayed after a
failure replaces its earlier output (exactly-once at the folder level), and the
stream's checkpoint on shared storage records progress.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from terracheck.columns import DEFAULT_COLS, AssetCols
from terracheck.operators.bundle import AnomalyBundle
from terracheck.operators.forest import ForestModel
from terracheck.operators.scoring import score_anomalies


def score_stream(
    stream: DataFrame,
    model: ForestModel | AnomalyBundle,
    out_path: str,
    checkpoint: str,
    cols: AssetCols = DEFAULT_COLS,
    trigger_once: bool = False,
):
    def score_batch(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        scored = model.score(batch, cols) if isinstance(model, AnomalyBundle) else score_anomalies(batch, model, cols)
        scored.write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")

    w = stream.writeStream.foreachBatch(score_batch).option("checkpointLocation", checkpoint)
    if trigger_once:
        w = w.trigger(availableNow=True)
    return w.start()
