"""Secret scans with DataFrame functions only.

Four patterns give candidate strings. Three are secrets by their form: an
assignment, an access key, a run of hex digits. The fourth takes long runs of key
characters: a window slides over each, the counts of its characters change by one
character in and one out, and so does the sum that gives the Shannon entropy. A
run is reported where its most uneven window still has the entropy that its class
of characters calls for, and no allow-list pattern explains it.

Positions come from marking matches inside the text and adding up the lengths of
the parts between marks, so no row leaves its task and nothing is shuffled.

Results on unusual rows: a null or empty text has no spans, zero counts and the
hash of the empty string; equal texts get equal rows; a null id and repeated ids
are carried along; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Runs that must have a least length are maximal, so the length can stand in the pattern.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
RUN = r"[A-Za-z0-9+/_=-]{20,}"
KINDS = ("assign", "access", "hex", "entropy")

#: Characters in a window of the entropy scan.
WINDOW = 20
#: Least entropy of a window in bits, by the class of a run's characters.
LEAST_BITS = {"hex": 2.6, "upper": 3.0, "mixed": 3.5}
#: Runs that these patterns explain aren't secrets.
ALLOWED = (
    r"^[A-Za-z_=/+-]+$",  # words, paths and rules without a digit
    r"^[0-9_=/+-]+$",  # numbers and dates
    r"(?i)example|sample|dummy|placeholder|xxxx|0000000|1234567",
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"^[A-Z]?[a-z]+[0-9]{1,4}$",  # a word with a number
)

# A private-use character marks matches; no pattern takes it, and its twin replaces it in the text.
_MARK, _TWIN = "\ue000", "\ue001"
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_SPAN = "array<struct<start:int,rank:int,end:int,part:string>>"


def matches(text: Column, pattern: str, rank: int) -> Column:
    """Structs (start, rank, end, part) of the leftmost matches that don't overlap, in code points."""
    parts = F.split(F.regexp_replace(text, f"(?:{pattern})", f"{_MARK}$0{_MARK}"), _MARK)
    start = F.struct(F.lit(0).alias("at"), F.lit(False).alias("inside"), F.array().cast(_SPAN).alias("found"))

    def step(state: Column, part: Column) -> Column:
        end = state["at"] + F.length(part)
        span = F.struct(state["at"].alias("start"), F.lit(rank).alias("rank"), end.alias("end"), part.alias("part"))
        return F.struct(end.alias("at"), (~state["inside"]).alias("inside"), F.when(state["inside"], F.array_append(state["found"], span)).otherwise(state["found"]).alias("found"))

    found = F.aggregate(parts, start, step, lambda state: state["found"])
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(_SPAN))


def window_bits(run: Column) -> Column:
    """Largest entropy of a window of a run, from counts that change by one in and one out."""
    term = lambda n: F.when(n > 0, n * F.log2(n.cast("double"))).otherwise(0.0)
    code = lambda at: F.instr(F.lit(_ALPHABET), F.substring(run, at, F.lit(1)))
    start = F.struct(F.array_repeat(F.lit(0), len(_ALPHABET)).alias("counts"), F.lit(0.0).alias("total"), F.lit(0.0).alias("best"))

    def step(state: Column, at: Column) -> Column:
        come, gone = code(at), F.when(at > WINDOW, code(at - WINDOW)).otherwise(0)
        counts = F.transform(state["counts"], lambda n, i: n + (i + 1 == come).cast("int") - (i + 1 == gone).cast("int"))
        held = lambda which: F.when(which > 0, F.try_element_at(state["counts"], which)).otherwise(0)
        change = F.when(come == gone, 0.0).otherwise(
            term(held(come) + 1) - term(held(come)) + F.when(gone > 0, term(held(gone) - 1) - term(held(gone))).otherwise(0.0)
        )
        total = state["total"] + change
        bits = F.when(at >= WINDOW, F.lit(math.log2(WINDOW)) - total / WINDOW).otherwise(0.0)
        return F.struct(counts.alias("counts"), total.alias("total"), F.greatest(state["best"], bits).alias("best"))

    return F.aggregate(F.sequence(F.lit(1), F.length(run)), start, step, lambda state: state["best"])


def random_looking(run: Column) -> Column:
    """Whether a run's entropy is that of a key and the allow list doesn't explain it."""
    least = F.when(run.rlike("^[0-9a-f]+$"), LEAST_BITS["hex"]).when(run.rlike("^[A-Z0-9]+$"), LEAST_BITS["upper"]).otherwise(LEAST_BITS["mixed"])
    allowed = F.lit(False)
    for pattern in ALLOWED:
        allowed = allowed | run.rlike(pattern)
    return F.when(allowed, False).otherwise(window_bits(run) >= least)


def with_spans(rows: DataFrame) -> DataFrame:
    """The column ``row`` with assign, access, hex and entropy, arrays of spans of the column ``text``, and text."""
    text = F.replace(F.coalesce(F.col("text"), F.lit("")), F.lit(_MARK), F.lit(_TWIN))
    found = rows.select("row", "text", text.alias("clean")).select(
        "row",
        "text",
        F.filter(matches(F.col("clean"), ASSIGN, 0), lambda x: F.length(F.regexp_extract(x["part"], ASSIGN, 2)) >= 12).alias("assign"),
        matches(F.col("clean"), ACCESS, 1).alias("access"),
        matches(F.col("clean"), HEX, 2).alias("hex"),
        matches(F.col("clean"), RUN, 3).alias("runs"),
    )
    return found.withColumn("entropy", F.filter("runs", lambda x: random_looking(x["part"]))).drop("runs")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, n_entropy, base_sha256, spans.

    Spans are kind:start:end, in code points with the end exclusive, by start and then by kind.
    """
    source = docs.select(docs[id_col].alias("row"), docs[text_col].cast("string").alias("text"))
    found = with_spans(source).select(F.col("row").alias("doc_id"), "assign", "access", "hex", "entropy", F.concat("assign", "access", "hex").alias("base"))

    def joined(spans: Column) -> Column:
        name = lambda x: F.element_at(F.array(*map(F.lit, KINDS)), x["rank"] + 1)
        return F.array_join(F.transform(F.array_sort(spans), lambda x: F.concat_ws(":", name(x), x["start"], x["end"])), ",")

    count = lambda name: F.size(name).cast("long")
    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        count("entropy").alias("n_entropy"),
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.concat("base", "entropy")).alias("spans"),
    )


def redact(docs: DataFrame, text_col: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """The same rows and columns with each span of the text replaced by ``mask``; a null text stays null.

    Other columns are carried along inside a struct, so their names can be any.
    """
    source = docs.select(F.struct("*").alias("row"), docs[f"`{text_col}`"].cast("string").alias("text"))
    found = with_spans(source).withColumn("spans", F.array_sort(F.concat("assign", "access", "hex", "entropy")))
    text = F.col("text")
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(state: Column, span: Column) -> Column:
        fresh = F.concat(state["out"], F.substring(text, state["at"] + 1, F.greatest(span["start"] - state["at"], F.lit(0))), F.lit(mask))
        overlaps = (span["start"] < state["at"]) & (state["at"] > 0)
        return F.struct(F.when(overlaps, state["out"]).otherwise(fresh).alias("out"), F.greatest(state["at"], span["end"]).alias("at"))

    rebuilt = F.aggregate("spans", start, step, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))))
    changed = F.when(F.size("spans") > 0, rebuilt).otherwise(text)
    return found.select(*[(changed if c == text_col else F.col("row").getField(c)).alias(c) for c in docs.columns])
