"""Review routing on a stream.

Routing is a stateless per-row map: the same functions as the batch plan are
applied to a ``readStream`` source and joined with the static one-row policy,
so a stream and a batch over the same rows give the same result. No watermark
or state is involved; each micro-batch is independent. The Parquet file sink
relies on its own commit log; ``run_to_batches`` writes each batch to a folder of its
number with overwrite, so a replayed batch replaces its rows instead of adding them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import config
from ..operators import policy as pol
from ..sources.model_registry import frozen_registry


def route_stream(stream: DataFrame, policy: DataFrame, labels, temperature: float,
                 k: int = config.TOP_K, confidence_digits: int | None = None) -> DataFrame:
    """Streaming DataFrame of routing decisions (no text column). The policy is frozen when
    the query is built, so no micro-batch chooses it again.
    ``confidence_digits`` quantises confidence before routing, matching a
    policy chosen on quantised confidences."""
    scored = pol.with_scores(stream, temperature)
    if confidence_digits is not None:
        scored = scored.withColumn("confidence", F.round("confidence", confidence_digits))
    return pol.route(scored, pol.frozen_policy(policy), labels, k)


def route_models_stream(stream: DataFrame, registry: DataFrame, k: int = config.TOP_K,
                        keep: list[str] = ()) -> DataFrame:
    """Routing decisions of a stream of many models; the registry is frozen when the query
    is built, so no micro-batch plans or reads it again."""
    return pol.route_models(stream, frozen_registry(registry), k, keep=keep)


def write_batch(batch: DataFrame, batch_id: int, sink_path: str) -> None:
    """Idempotent by batch number: the same batch twice leaves its rows once."""
    batch.write.mode("overwrite").parquet(f"{sink_path.rstrip('/')}/batch_id={batch_id:010d}")


def run_to_batches(routed: DataFrame, sink_path: str, checkpoint_path: str,
                   timeout_s: int | None = None) -> None:
    """Everything available now, one folder per micro-batch (``batch_id`` is a partition
    column when the sink is read). A batch that is replayed after a failure replaces what it
    wrote before."""
    q = (routed.writeStream.outputMode("append").option("checkpointLocation", checkpoint_path)
         .trigger(availableNow=True)
         .foreachBatch(lambda batch, batch_id: write_batch(batch, batch_id, sink_path)).start())
    _finish(q, timeout_s)


def _finish(q, timeout_s: int | None) -> None:
    q.awaitTermination() if timeout_s is None else q.awaitTermination(timeout_s)
    if q.isActive:
        q.stop()
        raise TimeoutError("stream did not finish in time")
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def read_stream(spark: SparkSession, path: str, schema: StructType,
                max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(path)


def run_to_parquet(routed: DataFrame, sink_path: str, checkpoint_path: str,
                   timeout_s: int | None = None) -> None:
    """Process everything available now into a Parquet sink, then stop. No time
    limit unless ``timeout_s`` is given."""
    q = (routed.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint_path)
         .trigger(availableNow=True).start(sink_path))
    _finish(q, timeout_s)
