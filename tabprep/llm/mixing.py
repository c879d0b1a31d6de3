"""Operator 7, mixing sources to target weights by Pareto order sampling.

Targets: sources sorted by code point (null last) weigh 3, 1, 2, repeating, and share a budget of words; a source's
target stops at `max_copies` times its size and the excess is shared again by weight until no target is above.

Copies: every document of a source is due target / size copies. The whole part is certain. The rest of the target is
sampled with unequal probabilities: a document's inclusion probability is proportional to its words, scaled so that the
expected words are the rest of the target; where that exceeds one the document is certain, and the others are scaled
again without it (`certain_rounds` times, or until no more become certain). Each document draws u from a hash of its id
and text, its rank is the odds of u divided by the odds of its inclusion probability (zero where certain), and documents
are taken in rank order while their words fit into what is left of the target. The gap that
the first document too many leaves is filled in `fill_rounds` further passes by documents that fit into it, again in
rank order. Last, the smallest document left is taken if that comes nearer to the target than leaving the gap. So the
sample has a fixed size in words, off the target by less than half of a small document where the source has small ones.

Plan: draw and size decide alone, so a source is described by a few cut values, found on (source, draw, size) rows: sums
by slice of the rank (about sqrt(n) slices for n documents) find the slice with the cut, and only that slice is sorted.
Documents themselves are never shuffled; they meet the table of sources in a broadcast when that has at most 100,000
rows, else in a shuffle join. A hot source is spread over its slices.

Defined cases: a null or empty text has size 0 and is never counted short; a source without words has target 0; fully
equal rows share their draw and are taken together; an empty table gives no rows. Reruns agree, as nothing is random.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabprep.llm.text import others, quoted, with_outputs, word_count
from tabprep.operators.ordering import with_row_index
from tabprep.session import materialise
from tabprep.sizing import hinted, lookup_table


@dataclass(frozen=True)
class Mix:
    budget: float = 1.5
    weights: tuple[int, ...] = (3, 1, 2)
    max_copies: int = 2
    fill_rounds: int = 2
    certain_rounds: int = 8
    seed: str = "mix-1"


def draw(id_col: str, text_col: str, seed: str) -> Column:
    """A number above 0 and below 1 from the first 52 bits of an MD5."""
    digest = F.md5(F.concat_ws("|", F.lit(seed), quoted(id_col).cast("string"), quoted(text_col).cast("string")))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint") + F.lit(0.5)) / F.lit(float(2**52))


def odds(p: Column) -> Column:
    return p / (1 - p)


def source_targets(sources: DataFrame, mix: Mix) -> DataFrame:
    """Add `target` to a table with one row per source (key, name, size).

    Level by level: the level is the words per weight of the sources below their limit; it only rises, so a source that
    has reached its limit stays there, and the loop ends when a level adds none.
    """
    numbered = with_row_index(
        sources.select("*", F.col("name").isNull().alias("last"), F.coalesce("name", F.lit("")).alias("sorted")),
        ["last", "sorted"], "place")
    weights = F.array(*[F.lit(w) for w in mix.weights])
    weighed = materialise(numbered.withColumn("weight", F.get(weights, (F.col("place") % len(mix.weights)).cast("int"))))
    limit = F.col("size") * mix.max_copies
    budget = (weighed.agg(F.sum("size")).first()[0] or 0) * mix.budget
    level, full = 0.0, -1
    while True:
        above = F.col("weight") * F.lit(level) > limit
        count, used, left = weighed.agg(
            F.count(F.when(above, 1)), F.coalesce(F.sum(F.when(above, limit)), F.lit(0)),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0))).first()
        if count == full or not left:
            break
        full, level = count, (budget - used) / left
    target = F.least(limit.cast("double"), F.col("weight") * F.lit(level))
    return weighed.select("key", "size", "docs", target.alias("target"))


def with_scale(sources: DataFrame, rows: DataFrame, rounds: int) -> DataFrame:
    """Add `scale` to `sources`: inclusion probability per word of size, documents that would exceed one being certain.

    `rows` has (key, size). Sums are whole numbers, so their order changes nothing.
    """
    sources = sources.withColumn("scale", F.lit(0.0))
    for _ in range(rounds):
        small, is_small = lookup_table(sources.select(F.col("key").alias("s__key"), "scale"))
        met = rows.join(hinted(small, is_small), F.col("key") == F.col("s__key"))
        certain = F.col("size") * F.col("scale") >= 1
        square = F.col("size").cast("decimal(38,0)") * F.col("size")
        sums = met.groupBy(F.col("key").alias("s__key")).agg(
            F.coalesce(F.sum(F.when(certain, F.col("size"))), F.lit(0)).alias("sure_words"),
            F.sum(F.when(~certain, square)).cast("double").alias("squares"))
        scaled = F.coalesce(F.try_divide((F.col("room0") - F.col("sure_words")).cast("double"), F.col("squares")), F.col("scale"))
        # Once a document is certain the others' share only grows.
        new = F.when(F.col("room0") > 0, F.greatest("scale", scaled)).otherwise(0.0)
        changed = materialise(sources.join(sums, F.col("key") == F.col("s__key"), "left").withColumn("new", new))
        more = not changed.where("new <> scale").isEmpty()
        sources = changed.drop("scale", "s__key", "sure_words", "squares").withColumnRenamed("new", "scale")
        if not more:
            break
    return sources


def _cut(rows: DataFrame, sources: DataFrame, room: str, cut: str, left: str) -> DataFrame:
    """Add to `sources` the highest rank up to which the ranked `rows` fit into `room`, and the room then left.

    `rows` has (key, slice, rank, size); fully equal ranks are taken together.
    """
    by_slice = rows.groupBy("key", "slice").agg(F.sum("size").alias("words"))
    up_to = Window.partitionBy("key").orderBy("slice")
    crossing = (
        by_slice.withColumn("sum", F.sum("words").over(up_to))
        .join(sources.select("key", room), "key")
        .withColumn("fits", F.col("sum") <= F.col(room))
    )
    # The slices that fit whole, and the first one that does not.
    whole = crossing.groupBy("key").agg(
        F.max(F.when(F.col("fits"), F.struct("slice", "sum"))).alias("whole"),
        F.min(F.when(~F.col("fits"), F.col("slice"))).alias("slice"),
    )
    edge = materialise(whole.select(
        "key", F.col("slice").alias("edge_slice"), F.col("whole.slice").alias("last_whole"),
        F.coalesce("whole.sum", F.lit(0)).alias("base")))
    small, is_small = lookup_table(edge)
    inside = rows.join(hinted(small.withColumnRenamed("key", "edge_key"), is_small),
                       (F.col("key") == F.col("edge_key")) & (F.col("slice") == F.col("edge_slice")))
    units = inside.groupBy("key", "rank").agg(F.sum("size").alias("size"), F.first("base").alias("base"))
    run = units.withColumn("sum", F.col("base") + F.sum("size").over(Window.partitionBy("key").orderBy("rank")))
    fitting = (
        run.join(sources.select("key", room), "key").where(F.col("sum") <= F.col(room))
        .groupBy("key").agg(F.max(F.struct("rank", "sum")).alias("best"))
    )
    return materialise(
        sources.join(edge, "key", "left").join(fitting, "key", "left").select(
            *sources.columns,
            F.coalesce(F.col("last_whole"), F.lit(-1)).alias(f"{cut}_slice"),
            F.col("best.rank").alias(cut),
            (F.col(room) - F.coalesce(F.col("best.sum"), F.col("base"), F.lit(0))).alias(left),
        ))


def _taken(round_no: int) -> Column:
    """Whether a row with its source's columns is taken in the round, if not before."""
    inside = (F.col("slice") <= F.col(f"cut{round_no}_slice")) | F.coalesce(F.col("rank") <= F.col(f"cut{round_no}"), F.lit(False))
    return inside & (F.col("room0") > 0) if round_no == 0 else inside & (F.col("size") <= F.col(f"room{round_no}"))


def _nearest(rows: DataFrame, sources: DataFrame, room: str) -> DataFrame:
    """Add to `sources` the smallest of the `rows` left, where taking it comes nearer than the room left."""
    smallest = rows.groupBy("key").agg(F.min(F.struct("size", "rank")).alias("last"))
    better = F.col("last.size") - F.col(room) < F.col(room)
    return materialise(sources.join(smallest, "key", "left").select(
        *sources.columns, F.when(better, F.col("last.size")).alias("last_size"), F.when(better, F.col("last.rank")).alias("last_rank")))


def mix_plan(df: DataFrame, id_col: str, text_col: str, source_col: str, size: Column, mix: Mix) -> DataFrame:
    """Decide the copies: `df` with mix__size, mix__source_size, mix__target and mix__copies."""
    name = quoted(source_col).cast("string")
    drawn = with_outputs(
        df, mix__size=size.cast("bigint"), mix__draw=draw(id_col, text_col, mix.seed),
        mix__key=F.when(name.isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), name)),
    )
    narrow = materialise(drawn.select(
        F.col("mix__key").alias("key"), name.alias("name"), F.col("mix__size").alias("size"), F.col("mix__draw").alias("draw")))
    grouped = narrow.groupBy("key").agg(
        F.first("name").alias("name"), F.sum("size").alias("size"), F.count(F.lit(1)).alias("docs"))
    targets = source_targets(materialise(grouped), mix)
    due = F.when(F.col("size") > 0, F.col("target") / F.col("size")).otherwise(0.0)
    sources = materialise(
        targets.withColumn("due", due).withColumn("sure", F.floor("due").cast("int"))
        .withColumn("share", F.col("due") - F.col("sure"))
        .withColumn("room0", F.floor(F.col("target") - F.col("sure") * F.col("size")).cast("bigint"))
        .withColumn("slices", F.ceil(F.sqrt("docs")))
        .withColumnsRenamed({"size": "source_size"})
    )
    sources = with_scale(sources, narrow.select("key", "size"), mix.certain_rounds)

    def ranked(rows: DataFrame, table: DataFrame) -> DataFrame:
        small, is_small = lookup_table(table)
        met = rows.join(hinted(small, is_small), "key")
        chance = F.col("size") * F.col("scale")
        # A document without words is never short; it ranks last.
        rank = F.when(chance >= 1, 0.0).when(chance > 0, odds(F.col("draw")) / odds(chance)).otherwise(F.lit(float("inf")))
        placed = F.when(rank == float("inf"), F.col("slices") - 1).otherwise(
            F.least(F.floor(rank / (1 + rank) * F.col("slices")), F.col("slices") - 1))
        return met.withColumns({"rank": rank, "slice": placed})

    def left(rounds: int) -> DataFrame:
        rows = ranked(narrow, sources).where(F.col("share") > 0)
        for earlier in range(rounds):
            rows = rows.where(~_taken(earlier))
        return rows

    for n in range(mix.fill_rounds + 1):
        rows = left(n).where(F.col("size") <= F.col(f"room{n}")) if n else left(0)
        sources = _cut(rows.select("key", "slice", "rank", "size"), sources, f"room{n}", f"cut{n}", f"room{n + 1}")
    gap = f"room{mix.fill_rounds + 1}"
    sources = _nearest(left(mix.fill_rounds + 1).where(F.col("size") > F.col(gap)).select("key", "rank", "size"), sources, gap)

    carried = [c for c in drawn.columns if not c.startswith("mix__")]
    met = ranked(drawn.select(
        F.struct(*[quoted(c) for c in carried]).alias("row"), F.col("mix__key").alias("key"), F.col("mix__size").alias("size"),
        F.col("mix__draw").alias("draw")), sources)
    extra = F.lit(False)
    for n in range(mix.fill_rounds + 1):
        extra = extra | _taken(n)
    extra = extra | F.coalesce((F.col("size") == F.col("last_size")) & (F.col("rank") == F.col("last_rank")), F.lit(False))
    return met.select(
        *[F.col("row")[c].alias(c) for c in carried],
        F.col("size").alias("mix__size"), F.col("source_size").alias("mix__source_size"), F.col("target").alias("mix__target"),
        (F.col("sure") + F.when((F.col("share") > 0) & extra, 1).otherwise(0)).alias("mix__copies"),
    )


def plan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", mix: Mix = Mix()) -> DataFrame:
    """Add size, source_size, target, copies and taken (words taken, repeats counted) to every document."""
    out = ("size", "source_size", "target", "copies", "taken")
    planned = mix_plan(df, id_col, text_col, source_col, word_count(text_col), mix)
    return planned.select(
        *others(df, out), *[F.col(f"mix__{c}").alias(c) for c in out[:-1]],
        (F.col("mix__size") * F.col("mix__copies")).cast("bigint").alias("taken"))


def apply(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", mix: Mix = Mix()) -> DataFrame:
    """The mix itself: every document as often as it is taken, with the columns of `df`."""
    planned = mix_plan(df, id_col, text_col, source_col, word_count(text_col), mix)
    return planned.select("*", F.explode(F.sequence(F.lit(1), F.col("mix__copies"))).alias("mix__copy")).where(
        "mix__copies > 0").select(*[quoted(c) for c in df.columns])
