"""Translation of a stream of request files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from phraseloom.functions import fixed_values as V
from phraseloom.hooks import top_hit_translator
from phraseloom.operators.detector import detect
from phraseloom.operators.retrieval import PreparedIndex
from phraseloom.operators.translate import api_response, requests_with_language, translate_rows
from phraseloom.schemas import REQUEST
from phraseloom.storage import stored_until_done


def respond(
    requests: DataFrame,
    index: DataFrame,
    detector,
    translator: Callable[[DataFrame], DataFrame] = top_hit_translator,
    encoder: Callable[[Column], Column] | None = None,
    **how,
) -> DataFrame:
    """Responses of a batch of requests (request_id, text, target_lang); request_id is unique and not null."""
    keyed = requests_with_language(requests.withColumnRenamed("request_id", "query_id"))
    answered = translate_rows(detect(keyed, detector), index, translator, encoder, **how)
    return api_response(answered).withColumnRenamed("query_id", "request_id")


def translate_stream(
    spark: SparkSession,
    requests_path: str,
    out: str,
    checkpoint: str,
    index: DataFrame,
    detector,
    translator: Callable[[DataFrame], DataFrame] = top_hit_translator,
    encoder: Callable[[Column], Column] | None = None,
    max_files: int | None = None,
    trigger: dict | None = None,
    **how,
) -> StreamingQuery:
    """Answer request files as they land; one folder of responses per micro-batch.

    `trigger` is a trigger of the writer, such as {"processingTime": "10 seconds"} for a stream that goes on; by
    default the files at hand are answered and the stream ends.

    No state is kept, so there is no watermark. A batch that runs again after a failure overwrites its
    own folder, so a restart from the checkpoint gives no duplicates. The index is prepared once, for
    all batches.
    """
    prepared = PreparedIndex(index, k=how.get("k", V.PIPELINE_HITS), **{n: how[n] for n in ("broadcast_bytes",) if n in how})

    def answer(batch: DataFrame, batch_id: int) -> None:
        # Splits and retries of a batch see the same rows, because the file source replays its offsets.
        with stored_until_done(spark):
            responses = respond(batch, prepared, detector, translator, encoder, **how)
            responses.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    reader = spark.readStream.schema(REQUEST)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return (
        reader.json(requests_path)
        .writeStream.foreachBatch(answer)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
