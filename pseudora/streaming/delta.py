"""New rows through a retained mapping, as a stream.

Ids are pure functions of salt and original, so a micro-batch needs no state but the
mapping: known ids are joined, new ones are mapped and added before the batch is written.
`known` gives a mapping that a run has left, such as Engine.mapping of a store; what the
stream adds stands beside it, in a folder for each batch. Every tenth batch writes there all
that the stream has added, so that a batch reads at most ten folders."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import mapping, rewrite
from ..operators.common import empty, kept

#: Batches whose number this divides write all that the stream has added.
WHOLE_EVERY = 10


def folders(mapping_path: str, batch_id: int) -> list[str]:
    """What a batch reads: the last whole folder before it, and those after that."""
    first = max(batch_id - 1, 0) // WHOLE_EVERY * WHOLE_EVERY
    return [f"{mapping_path}/{i}" for i in range(first, batch_id)]


def rewrite_stream(stream: DataFrame, columns: list[str], mapping_path: str, out_path: str, checkpoint: str, salt: str, max_len: int = 254, known: Callable[[], DataFrame] | None = None):
    """Starts a query that rewrites `columns` of every micro-batch and appends to out_path.

    The mapping lives at mapping_path/<batch>; ids that it lacks are added by the batch that
    brings them. A batch that is run again writes the same folder anew, so nothing doubles."""
    spark = stream.sparkSession

    def each(batch: DataFrame, batch_id: int) -> None:
        batch = kept(batch)
        parts = folders(mapping_path, batch_id)
        added = spark.read.schema(mapping.MAPPING).parquet(*parts) if parts else empty(spark, mapping.MAPPING)
        held = known().select("original_user_id", "obfuscated_user_id").unionByName(added) if known else added
        new = empty(spark, "v string")
        for c in columns:
            new = new.union(batch.select(F.col(f"`{c}`").cast("string")))
        keys = mapping.unmapped(new, "v", held)
        more = kept(mapping.extend(keys, held, salt, max_len))
        told = added.unionByName(more) if batch_id % WHOLE_EVERY == 0 else more
        told.write.mode("overwrite").parquet(f"{mapping_path}/{batch_id}")
        out = rewrite.rewrite_ids(batch, columns, held.union(more), salt, max_len)
        out.write.mode("overwrite").parquet(f"{out_path}/batch={batch_id}")

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
