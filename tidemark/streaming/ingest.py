"""Incremental loads of landed feed files with Structured Streaming.

Each micro-batch runs the same idempotent insert as a batch load, so a batch
that is replayed after a failure adds nothing twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemark.sources.readers import normalise_prices
from tidemark.sources.schemas import DAILY_PRICES, RAW_PRICES
from tidemark.sources.writers import append_new


def stream_inserts(stream: DataFrame, table: str, schema: str, keys: Sequence[str],
                   checkpoint: str, within: str | None = None) -> StreamingQuery:
    """Append the stream's rows whose key is new; processes what has landed, then stops."""
    def load(batch: DataFrame, _: int) -> None:
        append_new(batch.sparkSession, table, schema, batch, keys, within)

    return (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_prices(spark: SparkSession, landing: str, companies: DataFrame, table: str,
                  checkpoint: str) -> StreamingQuery:
    """Load price files as they land into the keyed price table."""
    feed = spark.readStream.schema(RAW_PRICES).parquet(landing)
    return stream_inserts(normalise_prices(feed, companies), table, DAILY_PRICES,
                          ["company_id", "trade_date"], checkpoint, within="trade_date")
