"""Mixing sources to target weights by Pareto order sampling (operator 13).

Every source has a weight, and the sources share the words of the corpus by
their weights; no source takes more than ``CAP`` times its words, and what it
can't take goes to the others by their weights. Inside a source a document's
expected number of copies grows with its length (its *grade*, the bits of its
number of words), up to ``CAP``, so that the expected words are the target.

The whole part of an expected number are certain copies. The fraction is an
inclusion probability p, and one more copy is drawn by Pareto order sampling:
with U a uniform random number of the document, documents are ranked by
(U / (1 - U)) / (p / (1 - p)), and the first of them are taken until the sample
has its fixed size, in words. The first document that doesn't fit ends a
pass; what room is left is filled by ``PASSES - 1`` more passes over the documents
behind it that still fit, so a source ends less than a small document below its
target and never above it.

U comes from a digest of the document's id and text, so reruns agree and no
other document has a part in it. Ranks are never sorted as a whole: two
histograms of the rank, each a combined sum, close in on the document that
ends a pass, and only its cell (about one of ``CELLS`` squared parts) is sorted.

Null and empty texts have no words: they take none, and a source of such
documents has the target 0. Rows that repeat both id and text are one document:
all of them are drawn, or none. A null source is a source of its own, the last.
Everything is a Spark expression; the driver holds two numbers per round of the
targets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlake.operators.ranking import global_rank

from .common import Stage

WEIGHTS = (5, 2, 1)
CAP = 3
PASSES = 4
CELLS = 4096
WORD = r"[^\x20\x09-\x0D]+"


def uniform(doc_id: Column, text: Column) -> Column:
    """A number in (0, 1) of 48 bits from the document alone."""
    own = F.concat_ws("|", F.coalesce(doc_id.cast("string"), F.lit("null")), F.md5(F.coalesce(text, F.lit("")).cast("binary")))
    return (F.conv(F.substring(F.md5(own.cast("binary")), 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)


def grade(size: Column) -> Column:
    """The preference of a document of ``size`` words: 1 + its number of binary digits."""
    return F.length(F.bin(size)).cast("double") + 1.0


def measured(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` (columns of docs, in a struct ``doc``), source, size, u of every document."""
    text = F.col("text").cast("string")
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("doc"),
        F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        uniform(F.col("doc_id"), text).alias("u"),
    )


def targets(stage: Stage, sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """source, source_size, target: the shares of the sources after the excess went round.

    ``weights`` go to the sources in code point order, null last, again and again.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = global_rank(stage.write(per, "sources"), [F.col("source").asc_nulls_last()], stage.write)
    place = F.pmod(F.col("rank") - 1, F.lit(len(weights))).cast("int")
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), place + 1)
    rows = stage.write(ranked.select("source", "source_size", weight.alias("weight")), "weighted")
    full = F.lit(False)  # sources at their most
    total = rows.agg(F.sum("source_size")).first()[0] or 0
    n, before = 0, -1
    room, shares = float(total), 1.0
    while n != before:
        free = rows.where(~full)
        got = free.agg(F.sum("weight")).first()[0] or 0
        taken = rows.where(full).agg(F.sum(cap * F.col("source_size")), F.count("*")).first()
        room, shares = float(total - (taken[0] or 0)), float(got or 1)
        before, n = n, rows.where(_share(room, shares) > cap * F.col("source_size")).count()
        full = _share(room, shares) > cap * F.col("source_size")
        if not got:
            break
    most = (cap * F.col("source_size")).cast("double")
    return rows.select("source", "source_size", F.least(_share(room, shares), most).alias("target"))


def _share(room: float, shares: float) -> Column:
    return F.col("weight").cast("double") * F.lit(room) / F.lit(shares)


def expected(sizes: DataFrame, wanted: DataFrame, cap: int = CAP) -> DataFrame:
    """source, grade, copies (certain ones), p: of the documents of a source that have a grade.

    Where all higher grades are at the cap, the words that are left, shared by the
    preferences of the grades below, make a *step*: the copies for a preference of 1.
    """
    per = sizes.where("size > 0").groupBy("source", grade(F.col("size")).alias("grade")).agg(F.sum("size").alias("words"))
    down = Window.partitionBy("source").orderBy(F.desc("grade"))
    above = F.coalesce(F.sum("words").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    below = F.sum(F.col("words") * F.col("grade").cast("long")).over(Window.partitionBy("source").orderBy("grade"))
    joined = per.withColumn("above", above).withColumn("below", below).join(
        wanted.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))
    )
    step = (F.col("target") - cap * F.col("above").cast("double")) / F.col("below").cast("double")
    rows = joined.withColumn("step", F.when(step * F.col("grade") <= cap, step))
    # The right grade has the largest step of those that stay within the cap: lower ones take grades as full that aren't.
    step = F.max("step").over(Window.partitionBy("source"))
    copies = F.least(F.coalesce(step * F.col("grade"), F.lit(float(cap))), F.lit(float(cap)))
    whole = F.floor(copies).cast("long")
    return rows.withColumn("copies", copies).select("source", "grade", "words", "target", whole.alias("whole"), (F.col("copies") - whole).alias("p"))


def _ranked(sizes: DataFrame, plan: DataFrame) -> DataFrame:
    """The documents with their certain copies and the place of their rank in [0, 1), null where p is 0."""
    parts = plan.select(F.col("source").alias("_s"), F.col("grade").alias("_g"), "whole", "p")
    on = F.col("source").eqNullSafe(F.col("_s")) & (grade(F.col("size")) == F.col("_g")) & (F.col("size") > 0)
    q = (F.col("u") / (1.0 - F.col("u"))) * ((1.0 - F.col("p")) / F.col("p"))
    return sizes.join(parts, on, "left").drop("_s", "_g").withColumn("q", F.when(F.col("p") > 0, q / (1.0 + q)))


def _first_cell(rows: DataFrame, cell: Column) -> DataFrame:
    """source, cell, room: the first cell whose words don't fit, and the room that is left before it."""
    per = rows.groupBy("source", "room", cell.alias("cell")).agg(F.sum("size").alias("words"))
    up = Window.partitionBy("source").orderBy("cell")
    per = per.withColumn("upto", F.sum("words").over(up)).where("upto > room")
    first = per.groupBy("source").agg(F.min(F.struct("cell", "words", "upto", "room")).alias("f"))
    return first.select(F.col("source").alias("_s"), F.col("f.cell").alias("_cell"), (F.col("f.room") - (F.col("f.upto") - F.col("f.words"))).alias("_room"))


def _cut(rows: DataFrame) -> DataFrame:
    """source, cut, room of (source, room, size, q): the rank that ends a pass (null: none) and the room left."""
    same = lambda a: F.col("source").eqNullSafe(F.col("_s"))
    inside = rows
    for bits in (1, 2):
        cell = F.floor(F.col("q") * float(CELLS**bits))
        edge = _first_cell(inside, cell)
        inside = inside.join(edge, same(edge)).where(cell == F.col("_cell")).select("source", F.col("_room").alias("room"), "size", "q")
    ties = inside.groupBy("source", "room", "q").agg(F.sum("size").alias("words"))
    ties = ties.withColumn("upto", F.sum("words").over(Window.partitionBy("source").orderBy("q"))).where("upto > room")
    f = ties.groupBy("source").agg(F.min(F.struct("q", "words", "upto", "room")).alias("f"))
    return f.select("source", F.col("f.q").alias("cut"), (F.col("f.room") - (F.col("f.upto") - F.col("f.words"))).alias("room"))


def draws(stage: Stage, sizes: DataFrame, plan: DataFrame, passes: int = PASSES) -> DataFrame:
    """source, passes: per source the bounds of each pass, [(from, to, most)]: what is taken has
    a rank in [from, to) and a size of at most ``most``."""
    ranked = _ranked(sizes, plan).where("q is not null").select("source", "size", "q")
    room = plan.groupBy("source").agg((F.min("target") - F.sum((F.col("whole") * F.col("words")).cast("double"))).alias("room"))
    state = room.select("source", "room", F.lit(0.0).alias("at"), F.lit(float("inf")).alias("most"), F.array().cast("array<struct<at:double,to:double,most:double>>").alias("passes"))
    for k in range(passes):
        state = stage.write(state, f"state-{k}")
        s = state.select(F.col("source").alias("_s"), "room", "at", "most")
        open_ = ranked.join(s, F.col("source").eqNullSafe(F.col("_s"))).where("q >= at and size <= most").select("source", "room", "size", "q")
        cut = _cut(open_).select(F.col("source").alias("_s"), "cut", F.col("room").alias("left"))
        done = state.join(cut, F.col("source").eqNullSafe(F.col("_s")), "left")
        to = F.coalesce("cut", F.lit(2.0))  # everything fitted
        this = F.struct(F.col("at").alias("at"), to.alias("to"), F.col("most").alias("most"))
        left = F.when(F.col("cut").isNull(), F.lit(-1.0)).otherwise(F.col("left"))
        state = done.select("source", left.alias("room"), to.alias("at"), left.alias("most"), F.concat("passes", F.array(this)).alias("passes"))
    return state.select("source", "passes")


def mix(docs: DataFrame, keep: list[str] | None = None, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """doc (a struct of the columns ``keep``, or all), size, source_size, target, copies, taken for every document.

    ``copies`` is how often the mix has the document, ``taken`` its words in it;
    documents without words have none.
    """
    stage = Stage(docs.sparkSession, "mixing")
    sizes = measured(docs, keep or ["doc_id"])
    sizes = stage.write(sizes if keep else sizes.drop("doc"), "sizes")
    wanted = stage.write(targets(stage, sizes, weights, cap), "targets")
    plan = stage.write(expected(sizes, wanted, cap), "plan")
    passes = stage.write(draws(stage, sizes, plan), "draws")
    same = F.col("source").eqNullSafe(F.col("_s"))
    rows = _ranked(sizes if keep else measured(docs, docs.columns), plan)
    rows = rows.join(wanted.withColumnRenamed("source", "_s"), same).drop("_s").join(passes.withColumnRenamed("source", "_s"), same, "left").drop("_s")
    drawn = F.exists("passes", lambda x: (F.col("q") >= x["at"]) & (F.col("q") < x["to"]) & (F.col("size") <= x["most"]))
    copies = F.coalesce("whole", F.lit(0)) + F.coalesce(drawn, F.lit(False)).cast("long")
    rows = rows.withColumn("copies", copies)
    return rows.select("doc", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixture(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken."""
    rows = mix(docs, None, weights, cap).where("copies > 0")
    return rows.select("doc", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("doc.*")
