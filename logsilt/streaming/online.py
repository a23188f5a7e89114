"""Online ingest as a stream: new files are landed as they arrive, each exactly once."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from logsilt.layout import Rule, Store
from logsilt.plans.landing import ingest


def start_online(
    stream: DataFrame,
    store: Store,
    rule: Rule,
    checkpoint: str,
    layout: str = "header",
    interval: str | None = None,
) -> StreamingQuery:
    """Land every micro-batch of a streaming DataFrame.

    The stream is any parsed input, such as ``parse_pipe(spark.readStream.text(folder), schema)``.
    Without ``interval`` the query takes all input there is and stops. A micro-batch that runs again
    after a failure adds nothing twice: stored keys win, NULL match values match each other, and
    its rejects replace those of the first attempt.
    """
    stream_id = hashlib.sha256(checkpoint.encode()).hexdigest()[:12]

    def land(batch: DataFrame, number: int) -> None:
        run = f"{stream_id}-{number}"
        ingest(batch.sparkSession, store, rule, batch, layout, null_safe=True, run=run)

    writer = stream.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).start()
