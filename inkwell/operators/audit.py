"""Audit joins: what was known at a time, and whether it still held later."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkwell.session import stored


def as_of(left: DataFrame, right: DataFrame, key: str, time: str, name: str) -> DataFrame:
    """Adds to each left row the last right row of its key at its time or before, as a struct ``name``, or null.

    Both have ``key`` and ``time``; the struct holds all columns of the right but the key. Of right rows at one time the greatest struct counts.
    Rows are dealt out by ranges of key and time, so a key of any size is split: within a part the last right row is carried on, and from part to
    part only one row a key and part. Rows with a null key or time find nothing; repeated left rows stay.
    """
    rest = [c for c in right.columns if c != key]
    kind = right.select(F.struct(*rest).alias("r")).schema["r"].dataType.simpleString()
    own = left.select(F.col(key).alias("__key"), F.col(time).alias("__time"), F.lit(1).alias("__side"), F.struct(*left.columns).alias("__row"), F.lit(None).cast(kind).alias("__hit"))
    known = right.where(F.col(key).isNotNull() & F.col(time).isNotNull())
    own_kind = own.schema["__row"].dataType.simpleString()
    other = known.select(F.col(key).alias("__key"), F.col(time).alias("__time"), F.lit(0).alias("__side"), F.lit(None).cast(own_kind).alias("__row"), F.struct(*rest).alias("__hit"))
    dealt = own.union(other).repartitionByRange("__key", "__time", "__side").withColumn("__part", F.spark_partition_id())
    both = stored(dealt, "as-of")
    # Equal keys and times may lie in two parts only if a part begins within them; the order holds across parts all the same.
    upto = Window.partitionBy("__part", "__key").orderBy("__time", "__side", "__hit").rowsBetween(Window.unboundedPreceding, 0)
    carried = both.withColumn("__found", F.last("__hit", ignorenulls=True).over(upto))
    ends = both.where("__side = 0").groupBy("__key", "__part").agg(F.max(F.struct("__time", "__hit")).getField("__hit").alias("__end"))
    parts = both.select("__key", "__part").distinct().join(ends, ["__key", "__part"], "left")
    before = Window.partitionBy("__key").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each part
    start = parts.select(F.col("__key").alias("__k"), F.col("__part").alias("__p"), F.last("__end", ignorenulls=True).over(before).alias("__start"))
    out = carried.where("__side = 1").join(start, (F.col("__key") == F.col("__k")) & (F.col("__part") == F.col("__p")), "left")
    hit = F.when(F.col("__key").isNotNull() & F.col("__time").isNotNull(), F.coalesce("__found", "__start"))
    return out.select("__row.*", hit.alias(name))


def deletion_evidence(deletions: DataFrame, journal: DataFrame, states: DataFrame, key: str, time: str) -> DataFrame:
    """CT10: what speaks for each deletion: its columns, journal_id, state_id and evidence.

    ``deletions``, ``journal`` and ``states`` have key, time and id. A deletion is ``verified`` by the last journal entry before it if the state that
    was known then is the state known at the deletion, and ``stale`` if the state has changed since. Without an entry
    the missing audit row is filled in from the state (``reconstructed``), or there is ``none``.
    """
    entry = as_of(journal.select(key, time, F.col("id").alias("entry")), states.select(key, time, "id"), key, time, "state")
    entry = entry.select(key, time, "entry", F.col("state.id").alias("entry_state"))
    found = as_of(as_of(deletions, states.select(key, time, "id"), key, time, "state"), entry, key, time, "journal")
    same = F.col("journal.entry_state").eqNullSafe(F.col("state.id"))
    evidence = F.when(F.col("journal").isNotNull() & same, "verified").when(F.col("journal").isNotNull(), "stale").when(F.col("state").isNotNull(), "reconstructed").otherwise("none")
    return found.select(*deletions.columns, F.col("journal.entry").alias("journal_id"), F.col("state.id").alias("state_id"), evidence.alias("evidence"))
