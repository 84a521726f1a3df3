"""Mixing sources to target token shares by entropy balancing.

Document rates solve: least sum of r log r - r subject to sum(r * size) = target for each
source and 0 <= r <= cap. The dual is convex with one multiplier per source, and its
optimum tilts the rates exponentially: r = min(cap, exp(lambda * size / scale)). Newton steps
on the dual run as Spark aggregates over the (source, size) histogram, which holds all that
the dual needs; a bracket per source keeps each step safe. Rates are then rounded
to copies: the whole part, and one more copy for the documents whose fixed random number
comes first until the source's words reach the target. What is then missing or too much is made up for by
single documents of the sizes that fit it best.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapse.llm.common import WORD, staged

#: Weights of the sources in code point order, repeating.
WEIGHTS = (5.0, 2.0, 1.0)
CAP = 3
#: Cells per refinement of the rounding cut: three rounds part random numbers 2 ** -30 apart.
CELLS, ROUNDS = 1024, 3
#: Documents per source that are moved to close the last gap, at most, and the rounds that may move too large a one.
FILLS, OVERSHOOTS = 6, (2, 4)


def count_words(text: Column) -> Column:
    """Number of words of a text without building them: starts of non-separator runs."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """(sk, source, source_size, target) from (sk, source, source_size): words shared by weight.

    Targets stop at ``cap`` times the source's size and the excess goes to the others
    by weight until none is above. In the order of cap / weight, the sources that hit their
    cap come first, so running sums give the level of the others without iteration.
    The table has one row per source, and the two windows hold only these.
    """
    rank = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     ((F.row_number().over(rank) - 1) % len(weights) + 1).cast("int"))
    ranked = sizes.withColumn("weight", w)
    level = Window.orderBy(cap * F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = level.rowsBetween(Window.unboundedPreceding, -1)
    onward = level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    ranked = ranked.withColumns({
        "all_words": F.sum("source_size").over(whole),
        "taken_by_capped": F.coalesce(F.sum(cap * F.col("source_size")).over(before), F.lit(0)),
        "open_weight": F.sum("weight").over(onward), "nth": F.row_number().over(level)})
    ranked = ranked.withColumn("mu", (F.col("all_words") - F.col("taken_by_capped")) / F.col("open_weight"))
    # the level is that of the first source in this order whose cap is above it
    below = F.col("mu") * F.col("weight") <= cap * F.col("source_size")
    ranked = ranked.withColumn("mu", F.min_by("mu", F.when(below, F.col("nth"))).over(whole))
    full = (cap * F.col("source_size")).cast("double")
    return ranked.select("sk", "source", "source_size", F.least(full, F.coalesce(
        F.col("mu") * F.col("weight"), full)).alias("target"))


def _rate(lam: Column, size: Column, scale: Column, cap: int) -> Column:
    return F.least(F.lit(float(cap)), F.exp(F.least(lam * size / scale, F.lit(50.0))))


def _exact_sum(c: Column) -> Column:
    """A sum that does not depend on the order of the rows, so that reruns agree to the last bit."""
    return F.sum(c.cast("decimal(38,6)")).cast("double")


def balance(histogram: DataFrame, targets: DataFrame, cap: int = CAP, tolerance: float = 1e-7,
            max_steps: int = 60) -> DataFrame:
    """(sk, lam, scale, target): each source's multiplier, by safeguarded Newton steps on the dual.

    ``histogram`` has (sk, size, docs), ``targets`` (sk, target). A source whose target is
    ``cap`` times its words has every rate at the cap (a large lam); one without words has lam 0.
    Each step is one aggregate of the dual's gradient and curvature at the present multipliers;
    a step that leaves the bracket known so far is replaced by its middle.
    """
    mass = F.col("size") * F.col("docs")
    info = histogram.groupBy("sk").agg(F.sum(mass).alias("words"), F.sum("docs").alias("n"),
                                       F.sum(F.col("size").cast("decimal(19,0)") * mass.cast("decimal(19,0)")).cast("double").alias("square"))
    full = F.col("target") >= cap * F.col("words") * (1 - 1e-12)
    none = F.col("words") == 0
    # the first guess is exact where all documents of a source are equally long
    guess = F.log(F.col("target") / F.col("words")) * F.col("words") / F.col("square") * F.col("scale")
    state = targets.join(info, "sk").withColumn("scale", F.greatest(F.col("words") / F.col("n"), F.lit(1e-9)))
    state = staged(state.select(
        "sk", "target", "scale", (none | full).alias("done"),
        F.when(none, 0.0).when(full, 1e9).when(F.col("target") <= 0, -1e9).otherwise(guess).alias("lam"),
        F.lit(None).cast("double").alias("lo"), F.lit(None).cast("double").alias("hi")), "mix-state")
    for _ in range(max_steps):
        open_ = state.where("not done")
        if open_.isEmpty():
            break
        r = _rate(F.col("lam"), F.col("size"), F.col("scale"), cap)
        grad = histogram.join(open_.select("sk", "lam", "scale"), "sk").groupBy("sk").agg(
            _exact_sum(r * mass).alias("got"),
            _exact_sum(F.when(r < cap, r * mass * F.col("size") / F.col("scale")).otherwise(0.0)).alias("curve"))
        state = staged(_step(state.join(grad, "sk", "left"), tolerance), "mix-state")
    return state.select("sk", "lam", "scale", "target")


def _step(j: DataFrame, tolerance: float) -> DataFrame:
    """The next multipliers and brackets from the gradient (got - target) and curvature."""
    lam, gap = F.col("lam"), F.col("got") - F.col("target")
    # greatest and least skip nulls
    j = j.withColumns({"lo": F.when(gap < 0, F.greatest("lo", lam)).otherwise(F.col("lo")),
                       "hi": F.when(gap > 0, F.least("hi", lam)).otherwise(F.col("hi")),
                       "newton": F.when(F.col("curve") > 0, lam - gap / F.col("curve"))})
    lo, hi, newton = F.col("lo"), F.col("hi"), F.col("newton")
    middle = F.when(hi.isNull(), lo + F.greatest(F.abs(lo), F.lit(1.0))).when(
        lo.isNull(), hi - F.greatest(F.abs(hi), F.lit(1.0))).otherwise((lo + hi) / 2)
    safe = newton.isNotNull() & (lo.isNull() | (newton > lo)) & (hi.isNull() | (newton < hi)) & (
        F.abs(newton - lam) < 64)
    hit = F.abs(gap) <= tolerance * F.greatest("target", F.lit(1.0))
    tight = F.coalesce(hi - lo <= 1e-13 * F.greatest(F.abs(hi), F.lit(1e-3)), F.lit(False))
    done = F.col("done") | F.coalesce(hit, F.lit(False)) | tight
    return j.select("sk", "target", "scale", done.alias("done"),
                    F.when(done, lam).when(safe, newton).otherwise(middle).alias("lam"), "lo", "hi")


def _cuts(rated: DataFrame, state: DataFrame) -> DataFrame:
    """(sk, cut): documents whose ``key`` is below the cut get one more copy.

    ``rated`` has (sk, size, whole, key). The cut is narrowed in rounds: words per cell of the
    key's range, the cell in which the source's missing words run out, then that cell's cells.
    """
    given = rated.groupBy("sk").agg(F.sum(F.col("whole") * F.col("size")).alias("given"))
    # a table of one row per source: joined to the documents without dealing them out by source
    state = staged(state.join(given, "sk").select("sk", (F.col("target") - F.col("given")).alias("need"),
                                                  F.lit(-1.0).alias("lo")), "mix-cut")
    width = 2.0
    for i in range(ROUNDS):
        cell_width = width / CELLS
        inside = rated.join(state, "sk").where((F.col("key") >= F.col("lo")) & (F.col("key") < F.col("lo") + width))
        cells = inside.groupBy("sk", F.least(F.floor((F.col("key") - F.col("lo")) / cell_width),
                                             F.lit(CELLS - 1)).alias("cell")).agg(F.sum("size").alias("words"))
        upto = Window.partitionBy("sk").orderBy("cell")  # at most CELLS rows
        cells = cells.withColumn("sum", F.sum("words").over(upto)).join(state.select("sk", "need"), "sk")
        # the first cell with which the words reach the need; past the last cell if none does
        found = cells.groupBy("sk").agg(
            F.min(F.when(F.col("sum") >= F.col("need"), F.col("cell"))).alias("at"),
            F.max(F.when(F.col("sum") < F.col("need"), F.col("sum"))).alias("before"),
            F.min(F.when(F.col("sum") >= F.col("need"), F.col("sum"))).alias("with"))
        step = state.join(found, "sk", "left")
        if i == ROUNDS - 1:
            nearer = F.col("with") - F.col("need") < F.col("need") - F.coalesce("before", F.lit(0))
            at = F.coalesce(F.col("at") + F.when(nearer, 1).otherwise(0), F.lit(CELLS))
            return step.select("sk", (F.col("lo") + at * cell_width).alias("cut"))
        at = F.least(F.coalesce(F.col("at"), F.lit(CELLS - 1)), F.lit(CELLS - 1))
        state = staged(step.select("sk", (F.col("need") - F.coalesce("before", F.lit(0))).alias("need"),
                                   (F.col("lo") + at * cell_width).alias("lo")), "mix-cut")
        width = cell_width


def _extra(picks: Column) -> Column:
    """A document's copies beyond the whole ones: 1 below the cut, changed by the moves that name it."""
    moved = F.aggregate(F.filter(picks, lambda p: (p["size"] == F.col("size")) & (p["key"] == F.col("key"))), F.lit(0), lambda n, p: n + p["move"])
    return F.coalesce((F.col("key") < F.col("cut")).cast("int") + moved, F.lit(0))


def _filled(rated: DataFrame, cuts: DataFrame, targets: DataFrame) -> DataFrame:
    """(sk, cut, picks): what single documents, one a round and source, get or give up to bring the source nearer to its target.

    In each round the document whose size is nearest to what the source lacks gets one more copy; where the source
    has too much, the one nearest to the excess loses its extra copy. Where every document is too large for that, the
    smallest one moves, and the next round makes up for it (in the worst case by taking it back). ``picks`` are these moves, by size and key.
    """
    pick = "struct<size:bigint,key:double,move:int>"
    state = cuts.withColumn("picks", F.array().cast(f"array<{pick}>"))
    for i in range(FILLS):
        now = rated.join(state, "sk").withColumn("extra", _extra(F.col("picks")))
        given = now.groupBy("sk").agg(F.sum((F.col("whole") + F.col("extra")) * F.col("size")).alias("given"))
        gaps = staged(targets.join(given, "sk").select("sk", "target", (F.col("target") - F.col("given")).alias("gap")), "mix-gap")
        near = F.col("size") < 2 * F.abs("gap")
        beyond = (F.abs("gap") > 0.001 * F.col("target")) & (F.abs("gap") >= 1) & F.lit(i in OVERSHOOTS)
        fits = F.col("key").isNotNull() & (near | beyond) & (F.col("extra") == (F.col("gap") < 0).cast("int"))
        off = F.when(near, F.abs(F.abs("gap") - F.col("size"))).otherwise(F.col("size") + F.lit(1e15))
        # rows that share size and key would move together
        best = now.join(gaps, "sk").where(fits).groupBy("sk", "gap", "target", "size", "key").agg(F.count(F.lit(1)).alias("n")).where("n = 1").groupBy("sk", "gap").agg(
            F.min(F.struct(off.alias("off"), "key", "size")).alias("b"))
        moves = best.select("sk", F.array(F.struct(F.col("b.size").cast("bigint").alias("size"), "b.key", F.signum("gap").cast("int").alias("move"))).alias("m"))
        state = staged(state.join(moves, "sk", "left").select("sk", "cut", F.when(F.col("m").isNull(), F.col("picks")).otherwise(
            F.concat("picks", F.col("m").cast(f"array<{pick}>"))).alias("picks")), "mix-cut")
    return state


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[float, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, rate, copies, taken.

    Null and empty texts have size 0 and take nothing, whatever their copies. A null source is
    a source of its own, last in order. Null ids are allowed; rows that repeat an id and a size share one
    random number and get the same copies, so a source made up of such rows can miss its target by their words.
    Texts of any length count whole. An empty table gives an empty result.
    Other columns are ignored. Reruns agree: the random number is a hash of id and size.
    """
    source = F.col(source_col).cast("string")
    base = staged(docs.select(F.col(id_col).alias("doc_id"), source.alias("source"),
                              F.coalesce(F.concat(F.lit("s"), source), F.lit("n")).alias("sk"),
                              count_words(F.col(text_col)).alias("size")), "mix-sizes")
    histogram = staged(base.groupBy("sk", "source", "size").agg(F.count(F.lit(1)).alias("docs")), "mix-histogram")
    sizes = histogram.groupBy("sk", "source").agg(F.sum(F.col("size") * F.col("docs")).alias("source_size"))
    targets = staged(source_targets(sizes, weights, cap), "mix-targets")
    multipliers = balance(histogram.select("sk", "size", "docs"), targets.select("sk", "target"), cap)
    rated = base.join(multipliers, "sk").withColumn("rate", _rate(F.col("lam"), F.col("size"), F.col("scale"), cap))
    whole = F.least(F.floor(F.col("rate") + 1e-9), F.lit(cap))
    chance = F.pmod(F.xxhash64("doc_id", "size"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    rated = rated.select("doc_id", "sk", "size", "rate", whole.alias("whole"),
                         F.when((whole < cap) & (F.col("size") > 0), chance - (F.col("rate") - whole)).alias("key"))
    rated = staged(rated, "mix-rated")
    cuts = staged(_cuts(rated, multipliers.select("sk", "target")), "mix-cuts")
    cuts = _filled(rated, cuts, multipliers.select("sk", "target"))
    copies = F.when(F.col("size") == 0, 0).otherwise(F.col("whole") + F.coalesce(_extra(F.col("picks")), F.lit(0)))
    return rated.join(cuts, "sk", "left").join(targets, "sk").select(
        "doc_id", "source", "size", F.col("source_size").cast("long").alias("source_size"), "target", "rate",
        copies.cast("int").alias("copies"), (copies * F.col("size")).cast("long").alias("taken"))
