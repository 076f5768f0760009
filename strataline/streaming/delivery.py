"""Snapshots announced on a stream, merged by the incremental job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strataline.plans.snapshots import digest_snapshot, pending, run_snapshot
from strataline.session import control_table
from strataline.settings import Settings
from strataline.sources.store import LayerStore

ANNOUNCEMENT_DDL = "position bigint, snapshot string, directory string"


def deliver(
    store: LayerStore, inbox: str, checkpoint: str, settings: Settings | None = None, available_now: bool = True
) -> StreamingQuery:
    """Watch ``inbox`` for announcements (JSON lines: position, snapshot, directory) and process each.

    Announcements of a batch run in order of position. The ledger decides what is pending, so a batch
    that is replayed after a failure does not merge a snapshot twice.
    """
    settings = settings or Settings()
    announced = store.spark.readStream.schema(ANNOUNCEMENT_DDL).json(inbox)

    def process(batch: DataFrame, _: int) -> None:
        # The batch lists snapshots, one row each; their data stays in the files it points to.
        for row in batch.orderBy(F.col("position")).collect():
            source = digest_snapshot(store.spark, row.directory)
            listed = control_table(store.spark, [(row.snapshot, source.fingerprint)], "snapshot string, content_hash string")
            if not pending(listed, store.ledger()).isEmpty():
                run_snapshot(store, row.snapshot, row.directory, settings, source=source)

    writer = announced.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
