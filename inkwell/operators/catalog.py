"""Tables of state: scans, upserts, snapshots, reconciliation, queues."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def unchanged(seen: DataFrame, stored: DataFrame, path: str, exact: list[str], known: list[str]) -> DataFrame:
    """Rows of ``seen`` whose identity ``stored`` has: equal in ``exact``; equal or unknown (0) in ``known``."""
    old = stored.select(path, *[F.col(c).alias(f"__{c}") for c in exact + known])
    match = F.lit(True)
    for c in exact:
        match = match & (F.col(c) == F.col(f"__{c}"))
    for c in known:
        match = match & ((F.col(f"__{c}") == 0) | (F.col(c) == F.col(f"__{c}")))
    return seen.join(old, path).where(match).select(*seen.columns)


def upsert(old: DataFrame, new: DataFrame, key: str, order: str) -> DataFrame:
    """Old rows, replaced by the newest new row of their key."""
    rest = [c for c in new.columns if c != key]
    newest = new.groupBy(key).agg(F.max_by(F.struct(*rest), F.col(order)).alias("r")).select(key, *[F.col("r")[c].alias(c) for c in rest])
    return old.join(newest.select(key), key, "left_anti").unionByName(newest)


def mark_missing(rows: DataFrame, seen: DataFrame, archived: DataFrame, key: str, status: str) -> DataFrame:
    """Status missing for rows that a whole scan hasn't seen and that were never archived."""
    flags = rows.join(seen.select(key).distinct().withColumn("__seen", F.lit(True)), key, "left").join(archived.select(key).distinct().withColumn("__kept", F.lit(True)), key, "left")
    gone = F.col("__seen").isNull() & F.col("__kept").isNull()
    return flags.withColumn(status, F.when(gone, "missing").otherwise(F.col(status))).drop("__seen", "__kept")


def snapshot(rows: DataFrame, group: str, *columns: str) -> DataFrame:
    """A hash of each group's rows in order, with their number.

    Rows are hashed before they meet, so a group moves 64 characters a row at most; the
    group's hash is over the sorted row hashes.
    """
    hashed = rows.select(group, F.sha2(F.concat_ws("|", *[F.col(c).cast("string") for c in columns]), 256).alias("h"))
    return hashed.groupBy(group).agg(F.sha2(F.array_join(F.array_sort(F.collect_list("h")), ""), 256).alias("digest"), F.count("*").alias("n"))


def spread_sample(rows: DataFrame, order: str, size: int) -> DataFrame:
    """``size`` rows evenly over an order, both ends included; the middle one for size 1; all if fewer.

    Ranks come from counts by range partition, so no task sees all rows.
    """
    ranked, total = ranks(rows, order)
    if total <= size:
        return ranked
    wanted = [total // 2] if size == 1 else sorted({i * (total - 1) // (size - 1) for i in range(size)})
    return ranked.where(F.col("rank").isin(wanted))  # ``size`` numbers


def ranks(rows: DataFrame, order: str) -> tuple[DataFrame, int]:
    """Adds rank, from 0 in an order, and tells how many rows there are."""
    from inkwell.session import stored

    sorted_rows = stored(rows.repartitionByRange(F.col(order)).withColumn("__part", F.spark_partition_id()), "ranks")
    counts = {r["__part"]: r["count"] for r in sorted_rows.groupBy("__part").count().collect()}  # a row for each partition
    before, total = {}, 0
    for part in sorted(counts):
        before[part], total = total, total + counts[part]
    if not total:
        return sorted_rows.withColumn("rank", F.lit(0).cast("long")).drop("__part"), 0
    shift = F.create_map(*[F.lit(x) for pair in before.items() for x in pair])[F.col("__part")]
    local = F.row_number().over(Window.partitionBy("__part").orderBy(order)) - 1
    return sorted_rows.withColumn("rank", (local + shift).cast("long")).drop("__part"), total


def reconcile(manifest: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """Every key of either side once, with an issue where it isn't on both exactly once."""
    left, right = manifest.groupBy(key).agg(F.count("*").alias("listed")), found.groupBy(key).agg(F.count("*").alias("found"))
    both = left.join(right, key, "full_outer").select(key, F.coalesce("listed", F.lit(0)).alias("listed"), F.coalesce("found", F.lit(0)).alias("found"))
    issue = F.when(F.col("listed") == 0, "extra").when(F.col("found") == 0, "missing").when(F.col("listed") > 1, "repeated").otherwise("ok")
    return both.withColumn("issue", issue)


def stale(work: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Work whose keys, signature included, aren't among what is done."""
    return work.join(done.select(*keys).distinct(), keys, "left_anti")


def queue(rows: DataFrame, rank: Column, size: Column, name: str) -> DataFrame:
    """Curated rows by rank, then the others, smallest first."""
    return rows.withColumn("tier", F.when(rank.isNull(), 1).otherwise(0)).orderBy("tier", rank, size, name)


def pseudo_random_order(identifier: Column, seed: int) -> Column:
    """A linear congruential order of ids."""
    return (identifier * 1_103_515_245 + seed) % 2_147_483_647


def transition(rows: DataFrame, changes: DataFrame, key: str, guard: list[str], status: str) -> DataFrame:
    """Apply status changes whose guards still hold; a null new status keeps the old."""
    new = changes.select(key, *[F.col(c).alias(f"__{c}") for c in guard], F.col(status).alias("__status"))
    holds = F.lit(True)
    for c in guard:
        holds = holds & F.col(c).eqNullSafe(F.col(f"__{c}"))
    joined = rows.join(new, key, "left")
    return joined.withColumn(status, F.when(holds, F.coalesce("__status", F.col(status))).otherwise(F.col(status))).select(*rows.columns)


def frozen(rows: DataFrame, run: str, key: str) -> DataFrame:
    """An immutable snapshot: (run_id, key, document), with each row as JSON."""
    return rows.select(F.lit(run).alias("run_id"), key, F.to_json(F.struct(*rows.columns)).alias("document"))


def first_occurrences(rows: DataFrame, key: str, position: str) -> DataFrame:
    """Distinct keys in order of first occurrence."""
    return rows.groupBy(key).agg(F.min(position).alias(position))


def top_values(rows: DataFrame, value: str, position: str, limit: int) -> DataFrame:
    """The most frequent values; ties go to what was seen first."""
    return rows.groupBy(value).agg(F.count("*").alias("n"), F.min(position).alias("first_seen")).orderBy(F.desc("n"), "first_seen").limit(limit)


def reuse_ids(rows: DataFrame, known: DataFrame, group: str, key: str, id_col: str) -> DataFrame:
    """An id for each group: the smallest that one of its keys has, else a new one after the largest."""
    held = rows.select(group, key).join(known.select(key, id_col), key, "left").groupBy(group).agg(F.min(id_col).alias(id_col))
    largest = known.agg(F.coalesce(F.max(id_col), F.lit(0))).first()[0]
    fresh, _ = ranks(held.where(F.col(id_col).isNull()).drop(id_col), group)
    return held.where(F.col(id_col).isNotNull()).unionByName(fresh.select(group, (F.col("rank") + largest + 1).alias(id_col)))


def version_decisions(rows: DataFrame, work: str, edition: str, chars: str) -> DataFrame:
    """Editions by length within a work: rank, share of the longest, and what becomes of each."""
    longest = F.max(chars).over(Window.partitionBy(work))
    rank = F.row_number().over(Window.partitionBy(work).orderBy(F.desc(chars), edition))
    share = F.col(chars) / F.col("longest")
    fate = F.when(F.col("rank") == 1, "keep").when(share >= 0.97, "same_length").when(share >= 0.8, "shorter").otherwise("truncated")
    return rows.withColumn("longest", longest).withColumn("rank", rank).withColumn("share", share).withColumn("fate", fate)


def bounded_shards(rows: DataFrame, group: str, order: str, size: str, most_rows: int, most_bytes: int) -> DataFrame:
    """Greedy shards in order within each group, bounded by rows and bytes: adds shard, from 0."""
    import pandas as pd

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(order, kind="stable")
        shard, count, total, out = 0, 0, 0, []
        for n in frame[size]:
            if count and (count >= most_rows or total + n > most_bytes):
                shard, count, total = shard + 1, 0, 0
            out.append(shard)
            count, total = count + 1, total + n
        return frame.assign(shard=out)

    return rows.groupBy(group).applyInPandas(pack, rows.schema.simpleString()[7:-1].replace(":", " ") + ", shard long")
