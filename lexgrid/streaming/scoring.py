"""Scoring as a continuous job.

The reference's one-row-at-a-time loops become a stateless Structured
Streaming query: read new files, render the prompt, call the model through
``predict_batch_udf``, decode, append to a file sink. There is no state to
bound (no aggregation, no join with state), so no watermark is needed; the
checkpoint makes the file sink exactly-once across restarts and lost
executors. Evaluation over the stream is a batch query over the sink.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import StructType

from lexgrid.functions.labels import argmax, decode_label
from lexgrid.functions.prompts import prefix_prompt
from lexgrid.operators.scoring import DEFAULT_BATCH, class_scorer


def scoring_plan(stream: DataFrame, key: str, text: str, prefix: str,
                 make_predict_fn: Callable, id2label: Mapping[int, str],
                 batch_size: int = DEFAULT_BATCH) -> DataFrame:
    """T1 -> I1 -> I2 -> I3, identical for a stream and a table."""
    prompt = prefix_prompt(F.coalesce(F.col(text), F.lit("")), prefix)
    scored = stream.select(key, class_scorer(make_predict_fn, batch_size)(prompt).alias("logits"))
    return scored.select(key, argmax("logits").alias("pred"),
                         decode_label(argmax("logits"), id2label).alias("pred_name"))


def start_score_stream(spark: SparkSession, source: str, schema: StructType | str, key: str,
                       text: str, prefix: str, make_predict_fn: Callable,
                       id2label: Mapping[int, str], sink: str, checkpoint: str,
                       fmt: str = "parquet", available_now: bool = True,
                       max_files_per_trigger: int | None = None) -> StreamingQuery:
    """I8: start the scoring stream from ``source`` files into a ``sink`` folder."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    plan = scoring_plan(reader.load(source), key, text, prefix, make_predict_fn, id2label)
    writer = (plan.writeStream.format("parquet").outputMode("append")
              .option("path", sink).option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="10 seconds")
    return writer.start()


def keyed_sink(sink: str, after_write: Callable[[int], None] | None = None) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that writes each batch into a folder named by its id, replacing what a failed try left there.

    A batch that is run again after a lost commit has the same id and rows, so no row comes twice. ``after_write`` is
    called between the write and Spark's commit (tests fail there).
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")
        if after_write is not None:
            after_write(batch_id)
    return write


def start_keyed_stream(plan: DataFrame, sink: str, checkpoint: str, after_write: Callable[[int], None] | None = None) -> StreamingQuery:
    """I8 with a keyed sink: every file that is there now, then stop; a later start goes on from ``checkpoint``."""
    return (plan.writeStream.foreachBatch(keyed_sink(sink, after_write)).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def read_keyed(spark: SparkSession, sink: str) -> DataFrame:
    return spark.read.option("basePath", sink).parquet(f"{sink}/batch=*")


class Progress(StreamingQueryListener):
    """Keeps what each finished batch reports: ``(query id, batch id, input rows)``, the last ``most`` of them."""

    def __init__(self, most: int = 1000):
        self.batches: deque[tuple[str, int, int]] = deque(maxlen=most)
        self.failures = 0

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.batches.append((str(event.progress.id), event.progress.batchId, event.progress.numInputRows))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.failures += event.exception is not None
