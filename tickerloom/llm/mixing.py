"""Mixing sources to target weights by Pareto order sampling [native].

Each source has a target number of words. With rate = target / words of the source, a document is
taken ``floor(rate)`` times for certain. What is left of the target is drawn: a document with inclusion
probability p = rate - floor(rate) has the rank (u / (1 - u)) / (p / (1 - p)), with u a repeatable
draw, and the lowest ranks are taken while their words fit the rest of the target. More draws fill the
gap that remains: each takes the longest document left out that fits into it (of equal ones that with
the lowest rank), the last one the document that comes nearest, if that narrows the gap. Where the last
one would leave as many words missing, or over, as some document left out that fits has, the ranks are
gone down first, past all that don't fit, until no document left out fits.

Only the words of a fixed number of documents are ever ordered in one task: ranks are cut into ranges
of about ``rows_per_range`` documents, whole ranges are taken by their sums, and just the range in
which the target is met is ordered. Going on past a document that doesn't fit does the same with those
that fit into the new gap, which is shorter than that document.

Defined cases: a null source is a source of its own, the last; a null or blank text has size 0 and
takes 0 words; a null doc_id draws as an empty one, told apart by its text; repeated rows draw alike
and are taken one by one in turn; no rows give no rows; extra columns are ignored by ``mix`` and kept
by ``mixed_documents``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickerloom.llm.common import fresh, materialise, unit_draw

#: A word: a longest run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Draws that fill the gap left by the first document that doesn't fit, the last one by what comes nearest.
FILLING_DRAWS = 4

c = F.col


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int], max_copies: int) -> DataFrame:
    """Per source of (source, size): n, source_size, target, copies, rest, odds.

    ``weights`` repeat over the sources by code point, null last. A target stops at ``max_copies``
    times its source; the excess is shared again by weight until no target is above. By rising
    cap / weight the capped sources come first, so running sums over the sources find them all.
    """
    by_source = sizes.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("source_size"))
    place = F.row_number().over(W.orderBy(c("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*(F.lit(int(w)) for w in weights)), (place % len(weights) + 1).cast("int")).cast("decimal(38,0)")
    everything = W.partitionBy()
    ranked = by_source.withColumns({"place": place, "weight": weight, "cap": (c("source_size") * max_copies).cast("decimal(38,0)")})
    ranked = ranked.withColumn("total", F.sum("source_size").over(everything).cast("decimal(38,0)"))
    by_ratio = W.orderBy((c("cap").cast("double") / c("weight").cast("double")), "place")
    ranked = ranked.withColumns(
        {
            "cap_before": F.coalesce(F.sum(c("cap").cast("decimal(28,0)")).over(by_ratio.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)),
            "weight_before": F.coalesce(F.sum(c("weight").cast("decimal(28,0)")).over(by_ratio.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)),
            "weight_all": F.sum(c("weight").cast("decimal(28,0)")).over(everything),
        }
    )
    small = lambda x: x.cast("decimal(18,0)")  # noqa: E731  so that products stay exact
    capped = small(c("weight")) * small(c("total") - c("cap_before")) >= small(c("cap")) * small(c("weight_all") - c("weight_before"))
    ranked = ranked.withColumn("capped", capped)
    ranked = ranked.withColumns(
        {
            "cap_sum": F.coalesce(F.sum(F.when(c("capped"), small(c("cap")))).over(everything), F.lit(0)),
            "free_weight": F.sum(F.when(~c("capped"), small(c("weight")))).over(everything),
        }
    )
    shared = (small(c("weight")) * small(c("total") - c("cap_sum"))).cast("double") / c("free_weight").cast("double")
    target = F.when(c("capped"), c("cap").cast("double")).otherwise(shared)
    rate = F.when(c("source_size") > 0, c("target") / c("source_size")).otherwise(F.lit(0.0))
    out = ranked.withColumn("target", target).withColumn("copies", F.floor(rate).cast("int"))
    p = rate - c("copies")
    return out.select(
        "source", "n", "source_size", "target", "copies", (c("target") - c("copies") * c("source_size")).alias("rest"),
        F.when(p > 0, p / (F.lit(1.0) - p)).alias("odds"),
    )


def _lowest_ranks(ranked: DataFrame, drawn: Column) -> DataFrame:
    """``ranked`` with ``fits``: whether the words of the drawn rows of the source up to this one fit its ``rest``."""
    sums = ranked.filter(drawn).groupBy("source", "range", "rest").agg(F.sum("size").alias("words"))
    upto = W.partitionBy("source").orderBy("range").rowsBetween(W.unboundedPreceding, 0)
    sums = sums.withColumn("upto", F.sum("words").over(upto)).filter(c("upto") > c("rest"))
    cut = sums.groupBy("source").agg(F.min_by(F.struct("range", (c("upto") - c("words")).alias("before")), "range").alias("cut"))
    cut = materialise(cut.select(c("source").alias("s"), c("cut.range").alias("cut"), c("cut.before").alias("before")))
    placed = ranked.join(cut, c("source").eqNullSafe(c("s")), "left").drop("s")
    inside = placed.filter(drawn & (c("range") == c("cut")))
    running = W.partitionBy("source").orderBy("rank", "doc_id", "size", "tie").rowsBetween(W.unboundedPreceding, 0)
    inside = inside.withColumn("fits", F.sum("size").over(running) + c("before") <= c("rest"))
    outside = placed.filter(~F.coalesce(drawn & (c("range") == c("cut")), F.lit(False)))
    outside = outside.withColumn("fits", drawn & (c("cut").isNull() | (c("range") < c("cut"))))
    return inside.unionByName(outside).withColumn("fits", F.coalesce("fits", F.lit(False))).drop("cut", "before")


def _walk(left: DataFrame, gaps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The ids taken down the ranks from the rows ``left`` of sources that one nearest draw doesn't settle, and the gaps after them.

    A round takes the ranks up to the first row that doesn't fit. That row is longer than the gap it leaves, so it and
    all that are as long are out of the next round, and the sizes in question keep shrinking.
    """
    off = F.least(c("gap"), F.min(F.abs(c("gap") - c("size"))))
    open_ = left.groupBy("s", "gap").agg(F.min("size").alias("shortest"), off.alias("off"))
    open_ = materialise(open_.filter((c("shortest") <= c("gap")) & (c("shortest") <= c("off"))).select(c("s").alias("source")))
    taken = materialise(left.select("id").limit(0))
    if open_.isEmpty():
        return taken, gaps
    held = ["id", "source", "doc_id", "size", "tie", "rank", "range"]
    left = materialise(left.select(*held).join(open_.withColumnRenamed("source", "s"), c("source").eqNullSafe(c("s")), "left_semi"))
    while True:
        rests = gaps.select("s", c("gap").alias("rest"))
        left = materialise(left.select(*held).join(rests, c("source").eqNullSafe(c("s"))).filter(c("size") <= c("rest")).drop("s"))
        if left.isEmpty():
            return taken, gaps
        left = materialise(_lowest_ranks(left, F.lit(True)))
        fitting = left.filter("fits")
        taken = taken.unionByName(fitting.select("id"))
        words = fitting.groupBy("source").agg(F.sum("size").alias("words"))
        gaps = gaps.join(words, c("source").eqNullSafe(c("s")), "left")
        gaps = materialise(gaps.select("s", (c("gap") - F.coalesce("words", F.lit(0))).alias("gap"), "ids"))
        left = left.filter("not fits")


def draws(sizes: DataFrame, weights: Sequence[int], max_copies: int, rows_per_range: int) -> DataFrame:
    """(doc_id, source, size, tie, u) with source_size, target and ``times``, how often each row is taken."""
    per_source = materialise(source_targets(sizes, weights, max_copies))
    ranges = F.greatest(F.ceil(c("n") / rows_per_range), F.lit(1))
    # one odds for a source, so its ranks rise with u and ranges of u are ranges of rank
    ranked = sizes.join(per_source.withColumnRenamed("source", "s"), c("source").eqNullSafe(c("s"))).drop("s")
    ranked = ranked.withColumns({"range": F.floor(c("u") * ranges), "rank": c("u") / (F.lit(1.0) - c("u")) / c("odds")})
    chosen = _lowest_ranks(ranked, c("odds").isNotNull())
    chosen = materialise(chosen.withColumn("id", F.monotonically_increasing_id()))
    filled = chosen.groupBy("source").agg(F.first("rest").alias("rest"), F.sum(F.when(c("fits"), c("size")).otherwise(0)).alias("got"))
    gaps = filled.select(c("source").alias("s"), (c("rest") - c("got")).alias("gap"), F.array().cast("array<long>").alias("ids"))
    walked = chosen.select("id").limit(0)
    for turn in range(FILLING_DRAWS):
        gaps = materialise(gaps)
        last = turn == FILLING_DRAWS - 1
        left = chosen.filter(c("odds").isNotNull() & ~c("fits") & (c("size") > 0)).join(gaps, c("source").eqNullSafe(c("s")))
        left = left.filter(~F.array_contains("ids", c("id")))
        off = F.abs(c("gap") - c("size"))
        if last:
            walked, gaps = _walk(left, gaps)
            left = left.drop("gap", "s", "ids").join(walked, "id", "left_anti").join(gaps, c("source").eqNullSafe(c("s")))
        left = left.filter((off < c("gap")) if last else (c("size") <= c("gap")))
        best = left.groupBy("source").agg(F.min(F.struct(off.alias("off"), "rank", "doc_id", "size", "tie", "id")).alias("best"))
        gaps = gaps.join(best, c("source").eqNullSafe(c("s")), "left").select(
            "s", (c("gap") - F.coalesce("best.size", F.lit(0))).alias("gap"),
            F.when(c("best").isNull(), c("ids")).otherwise(F.concat("ids", F.array("best.id"))).alias("ids"),
        )
    filling = materialise(gaps.select(F.explode("ids").alias("filling")).unionByName(walked.select(c("id").alias("filling"))))
    out = chosen.join(filling, c("id") == c("filling"), "left")
    return out.withColumn("times", c("copies") + (c("fits") | c("filling").isNotNull()).cast("int"))


def sizes_of(docs: DataFrame, salt: str) -> DataFrame:
    text = F.coalesce(c("text"), F.lit(""))
    tie = F.md5(text)
    return docs.select("doc_id", "source", n_words(c("text")).alias("size"), tie.alias("tie"), unit_draw(salt, c("doc_id"), tie).alias("u"))


def mix(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), max_copies: int = 3, salt: str = "mix", rows_per_range: int = 5000) -> DataFrame:
    """Per document: doc_id, size, source_size, target (its source's), taken (words, repeats counted)."""
    sizes = materialise(sizes_of(docs, salt))
    return draws(sizes, weights, max_copies, rows_per_range).select(
        "doc_id", "size", "source_size", "target", (c("size") * c("times")).cast("long").alias("taken")
    )


def mixed_documents(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), max_copies: int = 3, salt: str = "mix", rows_per_range: int = 5000) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with the columns of ``docs``."""
    sizes = materialise(sizes_of(docs, salt))
    taken = draws(sizes, weights, max_copies, rows_per_range)
    # equal rows draw alike, so those of one key share its copies, the first ones taking what is over
    key, turn, times = (fresh(n, docs.columns) for n in ("key", "turn", "times"))
    counted = taken.groupBy(_row_key(c("tie")).alias(key)).agg(F.sum("times").alias("all_times"), F.count("*").alias("rows"))
    rows = docs.withColumn(key, _row_key(F.md5(F.coalesce(c("text"), F.lit("")))))
    rows = rows.withColumn(turn, F.row_number().over(W.partitionBy(key).orderBy(key)))
    share = counted.select(key, F.posexplode(F.expr("transform(sequence(1, rows), i -> all_times div rows + if(i <= all_times % rows, 1, 0))")).alias(turn, times))
    share = share.withColumn(turn, c(turn) + 1)
    rows = rows.join(share.filter(c(times) > 0), [key, turn])  # a sequence from 1 to 0 would count down
    return rows.withColumn(turn, F.explode(F.expr(f"sequence(1L, `{times}`)"))).select(*(c(f"`{n}`") for n in docs.columns))


def _row_key(tie: Column) -> Column:
    parts = [F.coalesce(F.concat(F.lit("="), c(n).cast("string")), F.lit("-")) for n in ("doc_id", "source")]
    return F.md5(F.concat_ws("|", *parts, tie))
