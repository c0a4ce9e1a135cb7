"""The same upsert fed by a stream of files, resumable from its checkpoint."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tableferry.operators.load import Tombstones, upsert_partitions


def stream_upsert(
    arrivals: DataFrame,
    table: str,
    keys: Sequence[str],
    partition_by: Sequence[str],
    checkpoint: str,
    version: Sequence[str] | None = None,
    key_fixes_partition: bool = False,
    guarded: bool = False,
    deleted: str | None = None,
    tombstones: Tombstones | None = None,
) -> StreamingQuery:
    """Upsert everything that has arrived into a partitioned catalog table, then stop.

    The checkpoint remembers which files are done, so a later run takes up the new ones only. A
    batch cut off half-way is run again by Spark; an upsert applied twice is applied once, so no
    watermark or batch bookkeeping is needed.

    ``guarded``, ``deleted`` and ``tombstones`` as in ``upsert_partitions``: the newest version of
    a living key is remembered by the table itself, that of a deleted one by the tombstones, which
    ``TombstoneStore.forget`` expires. So files may arrive in any order, in one batch or in many.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        upsert_partitions(
            batch.sparkSession, table, batch, keys, partition_by, version, key_fixes_partition,
            guarded=guarded, deleted=deleted, tombstones=tombstones,
        )

    return (
        arrivals.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
