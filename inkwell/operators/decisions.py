"""Decisions on candidates: the gate before they count, and the commit that a second run doesn't repeat.

Frames that the functions take:

* candidates: candidate_id, library, evidence (array), confidence, and ``unfit``, the reason of ``system_evidence`` or null.
* decisions: candidate_id, position, decision, target_id, novelty, differences and evidence (arrays), name, mechanism.
* patterns: pattern_id, library, name, terms (array), layer (emerging or universal), position, made (by decisions), axes and risks (arrays),
  books, instances.
* instances: instance_id, library, pattern_id, book, candidate_id, evidence, grounded, completeness.
* support: pattern_id, library, book.
* accepted: candidate_id, library, decision, target_id, position, book, name, terms, axes, risks, evidence, grounded, completeness.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkwell.operators.fingerprint import blocked_pairs
from inkwell.operators.leaders import followers
from inkwell.operators.overlaps import near_across, near_sets
from inkwell.sources.snapshots import Snapshots
from inkwell.session import stored

#: Decisions that there are, and the ways in which a new pattern may differ that count.
DECISIONS = ("merge_existing", "enrich_existing", "create_new", "reject", "needs_more_evidence")
STRUCTURAL = ("causal_order", "core_mechanism", "role_power_structure", "reader_effect_mechanism", "constraint_or_cost", "state_change_type", "narrative_scope")
#: Identifiers by library, and how many axes and risks a pattern may have.
PREFIXES = {"CharacterArc": "arc", "EmotionRhythm": "emotion", "EventsLibrary": "event", "PayoffAngst": "payoff", "Worldview": "worldview"}
MOST_AXES, MOST_RISKS = 24, 20
#: A pattern this similar to a proposed one is the same.
NEAR = 0.72


def pattern_terms(text: Column) -> Column:
    """Words of two and more letters and digits, and the pairs and triples of CJK characters, each once."""
    text = F.lower(F.coalesce(text, F.lit("")))
    signs = F.array_join(F.regexp_extract_all(text, F.lit("([一-鿿])")), "")
    at = lambda size: F.when(F.length(signs) >= size, F.transform(F.sequence(F.lit(1), F.length(signs) - size + 1), lambda i: F.substring(signs, i, F.lit(size)))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(F.regexp_extract_all(text, F.lit("([a-z0-9_]{2,})")), at(2), at(3)))


def plain_name(name: Column) -> Column:
    """A pattern's name as it is compared."""
    return F.lower(F.regexp_replace(F.coalesce(name, F.lit("")), r"(?U)\s+", ""))


def near_patterns(proposed: DataFrame, patterns: DataFrame, limit: float = NEAR) -> DataFrame:
    """GD10: which patterns of its library a proposal is the same as: candidate_id, pattern_id, place, score.

    ``proposed``: candidate_id, library, name, terms. Equal names score 2, others their Jaccard, from ``limit`` on.
    """
    p = proposed.select(F.col("candidate_id").cast("string").alias("candidate_id"), "library", plain_name(F.col("name")).alias("key"), "terms")
    layer = F.when(F.col("layer") == "emerging", 0).otherwise(2)
    q = patterns.select("pattern_id", "library", plain_name(F.col("name")).alias("key"), "terms", F.struct(layer.alias("layer"), F.col("position").cast("long").alias("position")).alias("place"))
    named = p.where("key <> ''").join(q.drop("terms"), ["library", "key"]).select("candidate_id", "pattern_id", "place", F.lit(2.0).alias("score"))
    q = q.withColumn("key", F.concat(F.lit("p"), F.to_json(F.struct("library", "pattern_id"))))  # libraries may number alike
    side = lambda frame, name: frame.select(name.alias("id"), F.col("library").alias("group"), "terms")
    met = near_across(side(p, F.col("candidate_id")), side(q, F.col("key")), limit)
    ids = met.select(F.col("left").alias("candidate_id"), F.col("right").alias("key"), F.col("jaccard").alias("score"))
    return named.union(ids.join(q, "key").select("candidate_id", "pattern_id", "place", "score"))


def nearest_pattern(near: DataFrame) -> DataFrame:
    """The first of the best, by candidate: candidate_id, near_id, near_score, near_place."""
    best = near.groupBy("candidate_id").agg(F.min(F.struct((-F.col("score")).alias("far"), "place", "pattern_id")).alias("b"))
    return best.select("candidate_id", F.col("b.pattern_id").alias("near_id"), (-F.col("b.far")).alias("near_score"), F.col("b.place").alias("near_place"))


def system_evidence(text: Column, evidence: Column, confidence: Column, terms: tuple[str, ...], dimensions: dict[str, tuple[str, ...]]) -> Column:
    """FI16: why a candidate for a library of stable systems isn't one yet, or null.

    ``terms`` and ``dimensions`` are the words that show a system, which depend on the language.
    """
    held = lambda words: F.exists(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(F.coalesce(text, F.lit("")), w))
    known = F.size(F.array_distinct(F.filter(F.coalesce(evidence, F.array().cast("array<string>")), lambda x: x != "")))
    shown = sum((held(words).cast("int") for words in dimensions.values()), F.lit(0))
    return (
        F.when(known < 2, "worldview_requires_two_distinct_plot_evidence")
        .when(~held(terms), "worldview_missing_stable_rule_permission_or_resource_mechanism")
        .when(shown < 2, "worldview_requires_two_structural_system_dimensions")
        .when((known == 2) & (F.coalesce(confidence, F.lit(0.0)) < 0.85), "worldview_two_plot_evidence_requires_high_confidence")
    )


def gate(decisions: DataFrame, candidates: DataFrame, patterns: DataFrame) -> DataFrame:
    """FI13: what counts of the decisions, a row for each candidate: candidate_id, library, decision, target_id, evidence, reasons.

    The first decision on a candidate counts; those on unknown candidates don't. Candidates that the decisions leave out need more evidence.
    A new pattern must differ in two structural ways, name differences where its library has patterns, and be near none of
    them. Evidence that the candidate hasn't gives way to the candidate's. Null arrays are empty; reasons come in the order of the tests.
    """
    rest = ["decision", "target_id", "novelty", "differences", "evidence", "name", "mechanism"]
    first = decisions.groupBy("candidate_id").agg(F.min_by(F.struct(*rest), "position").alias("d"))
    proposed = candidates.select("candidate_id", "library").join(first.where("d.decision = 'create_new'"), "candidate_id")
    words = pattern_terms(F.concat_ws(" ", "d.name", "d.mechanism"))
    near = nearest_pattern(near_patterns(proposed.select("candidate_id", "library", F.col("d.name").alias("name"), words.alias("terms")), patterns))
    known = patterns.select(F.col("pattern_id").alias("target")).distinct()
    filled = patterns.select("library").distinct().withColumn("filled", F.lit(True))
    facts = candidates.select("candidate_id", "library", "evidence", "unfit")
    rows = facts.join(first, "candidate_id", "left").join(known, F.col("d.target_id") == F.col("target"), "left").join(filled, "library", "left")
    rows = rows.join(near, rows["candidate_id"].cast("string") == near["candidate_id"], "left").drop(near["candidate_id"])
    array = lambda c: F.coalesce(F.col(c), F.array().cast("array<string>"))
    some = lambda c: F.filter(array(c), lambda x: F.trim(x) != "")
    ways = F.size(F.array_distinct(F.filter(F.transform(array("d.novelty"), lambda x: F.lower(F.trim(x))), lambda x: x.isin(*STRUCTURAL))))
    said = F.col("d.decision")
    valid = F.coalesce(said.isin(*DECISIONS), F.lit(False))
    new, into = said == "create_new", said.isin("merge_existing", "enrich_existing")
    empty = (F.trim(F.coalesce("d.name", F.lit(""))) == "") | (F.trim(F.coalesce("d.mechanism", F.lit(""))) == "")
    lost, few = into & F.col("target").isNull(), new & (ways < 2)
    silent, partial, same = new & F.col("filled").isNotNull() & (F.size(some("d.differences")) == 0), new & empty, new & F.col("near_id").isNotNull()
    held = lost | few | silent | partial | same
    unfit = valid & ~held & (into | new) & F.col("unfit").isNotNull()
    foreign = F.size(F.array_except(some("d.evidence"), array("evidence"))) > 0
    reason = lambda test, text: F.when(test, text)
    reasons = F.array_compact(
        F.array(
            reason(~valid, F.lit("invalid_decision")), reason(lost, F.lit("target_pattern_not_found")), reason(few, F.lit("fewer_than_two_structural_novelty_dimensions")),
            reason(silent, F.lit("missing_nearest_pattern_differences")), reason(partial, F.lit("incomplete_proposed_pattern")),
            reason(same, F.concat(F.lit("local_near_duplicate:"), "near_id")), reason(unfit, F.col("unfit")), reason(foreign, F.lit("invalid_decision_evidence_trimmed")),
        )
    )
    omitted = F.col("d").isNull()
    decision = F.when(omitted | held | unfit, "needs_more_evidence").when(~valid, "reject").otherwise(said)
    return rows.select(
        "candidate_id", "library", decision.alias("decision"), F.col("d.target_id").alias("target_id"),
        F.when(foreign | (F.size(some("d.evidence")) == 0), F.array_sort(array("evidence"))).otherwise(F.col("d.evidence")).alias("evidence"),
        F.when(omitted, F.array(F.lit("missing_llm_decision"))).otherwise(reasons).alias("reasons"),
    )


def resolved(accepted: DataFrame, patterns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The pattern of each accepted decision, and the patterns that arise.

    The first: all columns of ``accepted``, pattern_id (null where the decision is held) and outcome: merged, enriched, created or held.
    A proposal goes to the nearest pattern of its library, an older one or one that arose from a decision before it; else it is a new one.
    """
    rows = stored(accepted.withColumn("candidate_id", F.col("candidate_id").cast("string")), "accepted")
    creates = rows.where((F.col("decision") == "create_new") & (plain_name(F.col("name")) != ""))
    near = stored(near_patterns(creates, patterns), "near-patterns")
    fresh = stored(creates.join(near.select("candidate_id").distinct(), "candidate_id", "left_anti"), "fresh")
    keyed = fresh.select(F.col("position").cast("long").alias("id"), F.struct("library", plain_name(F.col("name")).alias("name")).alias("key"), F.col("library").alias("group"), "terms")
    alike = near_sets(keyed.where(F.size("terms") > 0).select("id", "group", "terms"), NEAR)
    named = blocked_pairs(keyed.select("key", "id"), "key").select("left", "right", F.lit(2.0).alias("score"))
    links = stored(alike.select("left", "right", F.col("jaccard").alias("score")).union(named), "proposals")
    follow = stored(followers(links), "followers")
    new = fresh.join(follow.select(F.col("id").alias("position")), "position", "left_anti")
    ends = F.regexp_extract("pattern_id", r"(\d+)$", 1)
    largest = patterns.groupBy("library").agg(F.max(F.when(ends != "", ends.cast("long"))).alias("largest"), F.max("position").alias("after"))
    turn = F.row_number().over(Window.partitionBy("library").orderBy("position"))  # of one batch
    number = (F.coalesce("largest", F.lit(0)) + turn).cast("string")
    prefix = F.coalesce(F.create_map(*[F.lit(x) for pair in PREFIXES.items() for x in pair])[F.col("library")], F.lit("pattern"))
    digits = F.when(F.length(number) < 4, F.lpad(number, 4, "0")).otherwise(number)
    made = stored(new.join(largest, "library", "left").withColumn("pattern_id", F.concat(F.lit("emerging_"), prefix, F.lit("_"), digits)), "made")
    # Offers: older patterns, and new ones that arose before; the best, then the first.
    leading = made.select(F.col("position").alias("left"), F.col("pattern_id").alias("to"))
    ids = fresh.select(F.col("position").alias("right"), "candidate_id")
    place = F.struct(F.lit(1).alias("layer"), F.col("left").alias("position"))
    offers = near.select("candidate_id", "pattern_id", "place", "score").union(
        links.join(leading, "left").join(ids, "right").select("candidate_id", F.col("to").alias("pattern_id"), place.alias("place"), "score")
    )
    chosen = nearest_pattern(offers).select("candidate_id", F.col("near_id").alias("found"))
    own = made.select("candidate_id", F.col("pattern_id").alias("own"))
    target = patterns.select(F.col("pattern_id").alias("target_id"), "library", F.col("layer").alias("target_layer"), F.lit(True).alias("known"))
    both = rows.join(target, ["target_id", "library"], "left").join(chosen, "candidate_id", "left").join(own, "candidate_id", "left")
    into = F.col("decision").isin("merge_existing", "enrich_existing") & F.col("known").isNotNull()
    create = F.col("decision") == "create_new"
    pattern = F.when(into, F.col("target_id")).when(create, F.coalesce("own", "found"))
    outcome = (
        F.when(pattern.isNull(), "held").when(into & (F.col("decision") == "enrich_existing") & (F.col("target_layer") == "emerging"), "enriched")
        .when(create & F.col("own").isNotNull(), "created").otherwise("merged")
    )
    return both.select(*rows.columns, pattern.alias("pattern_id"), outcome.alias("outcome")), made.select(
        "pattern_id", "library", "name", "terms", F.lit("emerging").alias("layer"), (F.coalesce("after", F.lit(-1)) + 1 + F.col("position")).alias("position"), F.lit(True).alias("made"), "axes", "risks"
    )


def merged_instances(instances: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Instances with new ones put in, and what became of each new one: instance_id, candidate_id, fate.

    A new instance replaces those of its book and candidate if they are several or of another pattern (reassigned); if one of the same pattern is there,
    the better card stays (enriched or duplicate). Without one it is compared in the same way with the instance of its id, if
    there is one, and with new ones of that id in their order; else it is added. Candidates without an id have no book and candidate.
    """
    columns = instances.columns
    source = F.when(F.coalesce(F.col("candidate_id"), F.lit("")) != "", F.struct("library", "book", "candidate_id"))
    rank = F.struct(F.coalesce("grounded", F.lit(0)).alias("grounded"), F.coalesce("completeness", F.lit(0.0)).alias("completeness"))
    old = instances.withColumn("source", source).withColumn("rank", rank)
    fresh = stored(new.withColumn("source", source).withColumn("rank", rank), "new-instances")
    held = old.where("source IS NOT NULL").groupBy("source").agg(F.count("*").alias("n"), F.max("rank").alias("old_rank"), F.min("pattern_id").alias("least"), F.max("pattern_id").alias("most"))
    met = fresh.join(held, "source", "left")
    moved = (F.col("n") > 1) | (F.col("least") != F.col("pattern_id")) | (F.col("most") != F.col("pattern_id"))
    fate = F.when(F.col("n").isNull(), None).when(moved, "reassigned").when(F.col("rank") > F.col("old_rank"), "enriched").otherwise("duplicate")
    by_source = stored(met.withColumn("fate", fate), "by-source")
    gone = by_source.where("fate IN ('reassigned', 'enriched')")
    rest = old.join(gone.select("source"), "source", "left_anti")
    # By id: the old instance comes first, then new ones in order; one with a better card than all before it takes the place.
    unseen = by_source.where("fate IS NULL").select("library", "instance_id", "rank", "position")
    there = rest.select("library", "instance_id", "rank", F.lit(None).cast("long").alias("position")).join(unseen.select("library", "instance_id").distinct(), ["library", "instance_id"], "left_semi")
    before = Window.partitionBy("library", "instance_id").orderBy(F.asc_nulls_first("position")).rowsBetween(Window.unboundedPreceding, -1)
    walked = unseen.union(there).withColumn("best", F.max("rank").over(before)).where("position IS NOT NULL")
    by_id = stored(walked.select("library", "instance_id", "position", F.when(F.col("best").isNull(), "added").when(F.col("rank") > F.col("best"), "enriched").otherwise("duplicate").alias("fate")), "by-id")
    last = by_id.where("fate <> 'duplicate'").groupBy("library", "instance_id").agg(F.max("position").alias("position"))
    kept = gone.select(*columns).union(by_source.drop("fate").join(last, ["library", "instance_id", "position"], "left_semi").select(*columns))
    out = rest.join(last, ["library", "instance_id"], "left_anti").select(*columns).union(kept)
    fates = by_source.where("fate IS NOT NULL").select("instance_id", "candidate_id", "fate").union(by_id.join(fresh, ["library", "instance_id", "position"]).select("instance_id", "candidate_id", "fate"))
    return out, fates


def commit(patterns: DataFrame, instances: DataFrame, support: DataFrame, accepted: DataFrame) -> tuple[dict[str, DataFrame], DataFrame]:
    """GD13: the three tables after a batch of accepted decisions of distinct positions, and its counts (name, count).

    The same batch again changes no table. Enriched patterns take on axes and risks up to their limits, the first ones named. Patterns that decisions
    made and that have no instance left are pruned in the libraries that the batch touches; their number, and that of what was
    held, merged, enriched, created and of the instances' fates, are the counts.
    """
    rows, made = (stored(frame, name) for frame, name in zip(resolved(accepted, patterns), ("resolved", "made"), strict=True))
    live = rows.where("outcome <> 'held'")
    evidence = F.array_sort(F.coalesce("evidence", F.array().cast("array<string>")))
    part = F.when(F.size(evidence) > 0, F.array_join(evidence, "+")).otherwise(F.coalesce("candidate_id", F.lit("")))
    named = F.concat_ws(":", "library", "book", "pattern_id", part)
    new = live.withColumn("instance_id", named).withColumn("evidence", evidence)
    after, fates = merged_instances(instances, new)
    after, fates = stored(after, "instances"), stored(fates, "fates")
    touched = stored(live.select("library").distinct(), "libraries")

    known = patterns.drop("books", "instances").unionByName(made)
    listed = lambda c: F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("position", c))), lambda x: F.coalesce(x[c], F.array().cast("array<string>"))))
    pattern = ["library", "pattern_id"]
    richer = rows.where("outcome = 'enriched'").groupBy(pattern).agg(listed("axes").alias("more_axes"), listed("risks").alias("more_risks"))
    grown = known.join(richer, pattern, "left")
    for name, most in (("axes", MOST_AXES), ("risks", MOST_RISKS)):
        added = F.slice(F.array_distinct(F.concat(F.coalesce(name, F.array().cast("array<string>")), f"more_{name}")), 1, most)
        grown = grown.withColumn(name, F.when(F.col(f"more_{name}").isNotNull(), added).otherwise(F.col(name))).drop(f"more_{name}")
    active = after.where("coalesce(pattern_id, '') <> ''").groupBy(pattern).agg(F.count("*").alias("instances"))
    counted = grown.join(active, pattern, "left").join(touched.withColumn("touched", F.lit(True)), "library", "left")
    gone = (F.col("layer") == "emerging") & F.col("made") & F.col("instances").isNull() & F.col("touched").isNotNull()
    marked = stored(counted.withColumn("gone", F.coalesce(gone, F.lit(False))), "marked")
    left = marked.where("NOT gone").drop("gone", "touched")
    more = after.join(touched, "library", "left_semi").where("coalesce(book, '') <> ''").select("pattern_id", "library", "book")
    books = stored(support.select("pattern_id", "library", "book").union(more).distinct().join(left.select(*pattern), pattern, "left_semi"), "support")
    sizes = books.groupBy(*pattern).agg(F.count("*").alias("books"))
    final = left.withColumn("instances", F.coalesce("instances", F.lit(0))).join(sizes, pattern, "left").withColumn("books", F.coalesce("books", F.lit(0)))
    tables = {"patterns": final.select("pattern_id", "library", "name", "terms", "layer", "position", "made", "axes", "risks", "books", "instances"), "instances": after, "support": books}
    counts = rows.groupBy(F.col("outcome").alias("name")).count().union(fates.groupBy(F.concat(F.lit("instances_"), "fate").alias("name")).count())
    return tables, counts.union(marked.where("gone").groupBy(F.lit("patterns_pruned").alias("name")).count())


def commit_to(store: Snapshots, accepted: DataFrame) -> tuple[int, dict[str, int]]:
    """Commit a batch to a store that has its first version; the version that counts then, and the batch's counts.

    A batch that changes no table writes no version.
    """
    base = store.version()
    old = {name: store.read(name, base) for name in ("patterns", "instances", "support")}
    tables, counts = commit(old["patterns"], old["instances"], old["support"], accepted)
    tables = {name: stored(frame.select(*old[name].columns), name) for name, frame in tables.items()}
    found = {row["name"]: row["count"] for row in counts.collect()}  # a row for each kind
    if all(_mark(tables[name]) == _mark(old[name]) for name in old):
        return base, found
    return store.commit(tables, base), found


def _mark(frame: DataFrame) -> tuple:
    """The number of rows and sums of two of their hashes."""
    hashes = [F.sum(F.xxhash64(F.lit(seed), *frame.columns).cast("decimal(38,0)")) for seed in (0, 1)]
    return tuple(frame.agg(F.count("*"), *hashes).first())
