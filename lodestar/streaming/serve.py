"""Streaming serving: a stream of recommendation requests answered from the batch bundle.

Requests arrive as JSON files; every micro-batch is a static DataFrame that goes through
the same ``recommend`` plan as the batch path (stream-static: the bundle tables are read
once per batch, requests carry no state across batches). Each batch's answer is written
to its own ``batch_id=N`` folder with overwrite, so a retried batch replaces its earlier
attempt instead of duplicating rows; the checkpoint folder records the progress.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.operators.rank import parse_tag_param
from lodestar.session import materialize

REQUEST_SCHEMA = "request_id long, title string, popularity_weight double, tags string"


def request_stream(spark: SparkSession, request_dir: str, max_files_per_trigger: int = 1000) -> DataFrame:
    return (
        spark.readStream.schema(REQUEST_SCHEMA)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .json(request_dir)
        .select("request_id", "title", "popularity_weight", parse_tag_param(F.col("tags")).alias("tags"))
    )


def serve_requests(
    spark: SparkSession,
    request_dir: str,
    bundle: dict[str, DataFrame],
    out_dir: str,
    checkpoint_dir: str,
    available_now: bool = True,
):
    """Start the serving stream; with ``available_now`` it drains the folder and stops."""
    from lodestar.operators.rank import seed_lookup
    from lodestar.plans.pipelines import recommend

    # what every batch needs of the whole bundle is worked out once
    lookup = materialize(seed_lookup(bundle["seeds_dim"]))
    most = bundle["works_dim"].agg(F.max("popularity")).first()[0]

    def handle(batch: DataFrame, batch_id: int) -> None:
        out = recommend(bundle["recs"], bundle["works_dim"], bundle["seeds_dim"], batch, lookup=lookup, max_popularity=most or 0.0)
        out.write.mode("overwrite").parquet(f"{out_dir}/batch_id={batch_id}")

    writer = request_stream(spark, request_dir).writeStream.foreachBatch(handle).option(
        "checkpointLocation", checkpoint_dir
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="5 seconds")
    return writer.start()
