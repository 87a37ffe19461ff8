"""Rules over patterns, plans and registries: scores, gates and invariants, as columns and joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkwell.operators.catalog import ranks

# How a name ends that is a template's, and how tags are joined in one.
GENERIC_END, TAG_JOINS = "模板", ("+", "＋")


def name_rejection(name: Column, generic: list[str]) -> Column:
    """FI12: why a pattern's name is no name: generic, or tags joined; null if it stands."""
    is_generic = name.isin(generic) | name.endswith(GENERIC_END)
    joined = (name == "") | F.contains(name, F.lit(TAG_JOINS[0])) | F.contains(name, F.lit(TAG_JOINS[1])) | (F.length(name) - F.length(F.replace(name, F.lit("、"), F.lit(""))) >= 2)
    return F.when(is_generic, "generic_pattern_name").when(joined, "tag_joined_pattern_name")


def guarded_action(decision: Column, confidence: Column, direct: Column, has_more: Column, least: float = 0.85) -> Column:
    """FI14: what a model's finding that a version is incomplete may lead to; nothing is ever deleted by it alone."""
    result = lambda action, reason: F.struct(F.lit(action).alias("action"), F.lit(reason).alias("reason"))
    sure = F.coalesce(confidence >= least, F.lit(False))
    return (
        F.when(decision != "candidate_incomplete", result("retain", "model_did_not_find_candidate_incomplete"))
        .when(direct & sure & F.coalesce(has_more, F.lit(False)), result("recommend_remove_after_audit", "direct_containment_and_high_confidence_model_agree"))
        .when(sure, result("secondary_review", "model_only_incomplete_signal_cannot_delete"))
        .otherwise(result("retain_pending_review", "incomplete_confidence_below_guard_threshold"))
    )


def decoded_score(text: Column) -> Column:
    """FN8: how well a text was decoded, by shares of ideographs and printable signs less those of faults."""
    total = F.length(text)
    share = lambda signs: F.regexp_count(text, F.lit(signs)) / total
    printable = 1 - share(r"[\p{C}\p{Z}&&[^ \r\n\t]]")
    score = share("[㐀-鿿豈-﫿]") * 0.6 + printable * 0.4 - share("�") * 2.0 - share(r"\x00") * 5.0
    return F.when(F.coalesce(total, F.lit(0)) == 0, -1.0).otherwise(score)


def terms(text: Column, least: int = 1, sizes: tuple[int, ...] = (2, 3)) -> Column:
    """FN6: the distinct ASCII words of at least ``least`` signs, and n-grams of a text's ideographs put together."""
    words = F.regexp_extract_all(F.lower(text), F.lit(f"[a-z0-9_]{{{least},}}"), F.lit(0))
    script = F.regexp_replace(text, "[^一-鿿]", "")
    grams = lambda n: F.when(F.length(script) >= n, F.transform(F.sequence(F.lit(1), F.length(script) - n + 1), lambda i: F.substring(script, i, F.lit(n)))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(words, *[grams(n) for n in sizes]))


def archetypes(names: DataFrame, key: str, name: str, known: DataFrame) -> DataFrame:
    """FN22: the archetype of which a name holds the most terms, two at least; the first listed of equals; else null.

    ``known``: archetype, position, terms; a fixed list, so small that it is broadcast.
    """
    held = F.size(F.filter("terms", lambda t: F.contains(F.col(name), t)))
    scored = names.select(key, name).join(F.broadcast(known), F.exists("terms", lambda t: F.contains(F.col(name), t))).withColumn("held", held).where("held >= 2")
    best = scored.groupBy(key).agg(F.max_by("archetype", F.struct(F.col("held"), -F.col("position"))).alias("archetype"), F.max("held").alias("held"))
    return names.select(key).join(best, key, "left")


def chapter_faults(chapters: DataFrame, key: str, order: str, chapter_id: str, title: str, expected: Column) -> DataFrame:
    """CT14: what is wrong with each book's chapters: orders, ids, titles, and their number against ``expected``."""
    many = F.count("*")
    return (
        chapters.groupBy(key)
        .agg(
            F.array_compact(
                F.array(
                    F.when(F.count_if(F.coalesce(F.col(order) <= 0, F.lit(True))) > 0, "order_not_positive"),
                    F.when(F.count_distinct(order) < F.count(order), "duplicate_order"),
                    F.when(F.count_if(F.coalesce(F.trim(chapter_id) == "", F.lit(True))) > 0, "missing_id"),
                    F.when(F.count_distinct(chapter_id) < F.count(chapter_id), "duplicate_id"),
                    F.when(F.count_if(F.coalesce(F.trim(title) == "", F.lit(True))) > 0, "missing_title"),
                    F.when(F.max(expected) != many, "count_mismatch"),
                )
            ).alias("faults"),
            many.alias("chapters"),
        )
        .where("size(faults) > 0")
    )


def promotion(parts: DataFrame, files: DataFrame, key: str, part: str, least: float = 0.98) -> DataFrame:
    """CT15: may a staged work be published: enough of its parts complete, none empty, and parts and files the same.

    ``parts``: key, part, complete; ``files``: key, part, bytes.
    """
    held = parts.select(key, part, "complete", F.lit(True).alias("listed")).join(files.select(key, part, "bytes"), [key, part], "full")
    counted = held.groupBy(key).agg(
        (F.count_if(F.col("complete")) / F.greatest(F.count_if(F.col("listed")), F.lit(1))).alias("ratio"),
        F.count_if(F.col("listed") & F.col("bytes").isNull()).alias("missing"),
        F.count_if(F.col("listed").isNull()).alias("extra"),
        F.count_if(F.col("bytes") == 0).alias("empty"),
    )
    ready = (F.col("ratio") >= least) & (F.col("missing") == 0) & (F.col("extra") == 0) & (F.col("empty") == 0)
    return counted.withColumn("ready", ready)


def index_order(plan: DataFrame, last: str | None = None) -> DataFrame:
    """TK3: rank of plan rows in the order of the index, or by file with one action last. Rows are ranked in ranges, so a run may be of any size."""
    if last is not None:
        keys = [(F.col("action") == last).cast("int"), F.col("file_id")]
    else:
        keys = [F.coalesce("category", F.lit("99")), F.coalesce("title_key", F.lit("")), F.coalesce("author_key", F.lit("")), F.coalesce("library_id", F.lit(0)), F.coalesce("version", F.lit(0)), F.col("file_id")]
    order = F.struct("run", *[key.alias(f"k{i}") for i, key in enumerate(keys)])
    numbered, _ = ranks(plan.withColumn("__order", order), "__order")
    first = numbered.groupBy(F.col("run").alias("__run")).agg(F.min("rank").alias("__first"))
    placed = numbered.join(first, F.col("run").eqNullSafe(F.col("__run")))
    return placed.select(*plan.columns, (F.col("rank") - F.col("__first") + 1).alias("rank"))


def lineage(legacy: DataFrame, mapped: DataFrame, retired: DataFrame, key: str) -> DataFrame:
    """CT22: one row for each legacy identity: mapped, retired or unresolved; an identity that is both is a conflict."""
    joined = legacy.select(key).distinct().join(mapped.groupBy(key).agg(F.min("canonical").alias("canonical"), F.count("*").alias("n")), key, "left").join(retired.select(key, F.lit(True).alias("gone")).distinct(), key, "left")
    state = F.when((F.col("n") > 1) | (F.col("canonical").isNotNull() & F.col("gone").isNotNull()), "conflict").when(F.col("canonical").isNotNull(), "mapped").when(F.col("gone").isNotNull(), "retired").otherwise("unresolved")
    return joined.select(key, "canonical", state.alias("state"))


def boundary_overlap(rows: DataFrame, key: str, order: str, text: str, left: int = 4, right: int = 5, least: float = 0.22) -> DataFrame:
    """FN7: before each row, the Jaccard of words in the ``left`` rows before and the ``right`` rows from it on; split where it is low."""
    words = F.array_distinct(F.regexp_extract_all(text, F.lit(r"(?U)[\w一-鿿]{2,}"), F.lit(0)))
    held = rows.select(key, order, words.alias("words"))
    by_order = Window.partitionBy(key).orderBy(order)
    of = lambda first, last: F.array_distinct(F.flatten(F.collect_list("words").over(by_order.rowsBetween(first, last))))
    sides = held.withColumn("l", of(-left, -1)).withColumn("r", of(0, right - 1)).withColumn("n", F.row_number().over(by_order)).where("n > 1")
    overlap = F.size(F.array_intersect("l", "r")) / F.greatest(F.size(F.array_union("l", "r")), F.lit(1))
    return sides.select(key, order, overlap.alias("overlap"), (overlap < least).alias("split"), F.round(F.greatest(F.lit(0.2), F.least(F.lit(0.85), 1 - overlap)), 6).alias("confidence"))
