"""Mixing sources to target weights by Pareto order sampling.

Targets. Sources in code-point order (null last) weigh 5, 2, 1 and again; they
share ``share`` (150 %) of all words. No target exceeds ``most`` (2) times its
source's words; the excess is shared again by weight. That ends where every
source has the smaller of its cap and one common multiple of its weight, which
is found in one pass over the sources in order of cap per weight.

Inclusion. Within a source the expected copies of a document grow with the
number of bits of its length (fragments come less often than long documents),
are at most ``most``, and add up to the target; the common factor is found in
one pass over the source's length classes.

Sampling. The whole part of the expected copies is allocated for certain. What
remains is an inclusion probability p. Documents are ranked by
(u / (1 - u)) / (p / (1 - p)) with u from a hash, that is by random odds
divided by inclusion odds, and taken from the front: the sample's size is fixed
in words, it is the prefix whose words come nearest to what is left of the
target (within half of one document's length).

At scale. Ranks are not computed over a whole source: the words of narrow
bands of the ranking's logarithm are added up, the band that holds the cut is
found, and only its rows are sorted (about the square root of the source's
rows). What results is a cut-off for each source, so the decision on a row
needs a join with two tables of a few rows for each source and moves no text.

Defined results: a null text has size 0 and is never taken; documents without
a word likewise; a null source is a source of its own, the last; rows that
repeat wholly are taken alike; an empty table gives no rows; further columns
are carried by ``mix`` and not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlake.llm.common import WORD, text_of, written

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
SEED = "42"
_TWO48 = float(1 << 48)


def _measured(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: str) -> DataFrame:
    """(row, id, key, size, g, u): the row, its source with null told apart,
    words, bits of the number of words, and a uniform number."""
    text = text_of(f"row.`{text_col}`")
    source = F.col(f"row.`{source_col}`").cast("string")
    return (docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
            .withColumn("id", F.col(f"row.`{id_col}`").cast("long"))
            .withColumn("key", F.when(source.isNull(), "n").otherwise(F.concat(F.lit("s"), source)))
            .withColumn("size", F.regexp_count(text, F.lit(WORD)).cast("long"))
            .withColumn("g", F.length(F.bin("size")).cast("long"))
            .withColumn("u", _uniform(F.col("id"), text, seed)))


def _uniform(ident: Column, text: Column, seed: str) -> Column:
    digest = F.md5(F.concat_ws(":", F.lit(seed), ident.cast("string"), text))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / _TWO48


def targets(classes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(key, source_size, target) from (key, g, words). One row per source
    goes through the two windows over all sources."""
    by_source = classes.groupBy("key").agg(F.sum("words").alias("source_size"))
    in_order = Window.orderBy((F.col("key") == "n").asc(), "key")
    n = (F.row_number().over(in_order) - 1) % len(weights)
    weighed = by_source.withColumn(
        "w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (n + 1).cast("int")))
    weighed = (weighed.withColumn("cap", F.col("source_size") * F.lit(most))
               .withColumn("total", F.sum("source_size").over(Window.partitionBy()) * F.lit(share)))
    by_cap = Window.orderBy(F.col("cap") / F.col("w"), "key")
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    after = by_cap.rowsBetween(0, Window.unboundedFollowing)
    level = ((F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
             / F.sum("w").over(after))
    levels = weighed.withColumn("level", level)
    # The first source below its cap; sums of whole numbers, so any order is exact.
    common = F.min(F.when(F.col("level") * F.col("w") <= F.col("cap"), F.struct(
        (F.col("cap") / F.col("w")).alias("at"), "key", "level"))).over(Window.partitionBy())
    return (levels.withColumn("common", common["level"])
            .select("key", "source_size",
                    F.when(F.col("common").isNull(), F.col("cap"))
                    .otherwise(F.least("cap", F.col("common") * F.col("w"))).alias("target")))


def _plan(classes: DataFrame, sources: DataFrame, most: float) -> DataFrame:
    """(key, g, whole, p, rest, n): for each source and length class the
    certain copies and the inclusion probability, and for each source the
    words that the sample must give."""
    up = Window.partitionBy("key").orderBy(F.desc("g"))
    before = F.coalesce(F.sum("words").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    mass = F.sum(F.col("g") * F.col("words")).over(up.rowsBetween(0, Window.unboundedFollowing))
    c = classes.join(sources, "key")
    c = c.withColumn("factor", F.when(mass > 0, (F.col("target") - before * F.lit(most)) / mass))
    fits = F.when(F.col("factor") * F.col("g") <= most, F.struct(F.col("g").alias("at"), "factor"))
    c = c.withColumn("factor", F.max(fits).over(Window.partitionBy("key"))["factor"])
    copies = F.when(F.col("factor").isNull(), F.lit(most)).otherwise(
        F.least(F.lit(most), F.col("factor") * F.col("g")))
    c = c.withColumn("whole", F.floor(copies)).withColumn("p", copies - F.floor(copies))
    own = Window.partitionBy("key")
    return c.select("key", "g", "whole", "p", "source_size", "target",
                    (F.col("target") - F.sum(F.col("whole") * F.col("words")).over(own)).alias("rest"),
                    F.sum("n").over(own).alias("n"))


def _ranked(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows`` with their plan, rank ``q`` (null: not in the sample's frame)
    and its band."""
    q = F.when((F.col("p") > 0) & (F.col("size") > 0),
               (F.col("u") / (1 - F.col("u"))) * ((1 - F.col("p")) / F.col("p")))
    # The logarithm never falls where its argument rises, so bands are intervals.
    band = F.floor(F.log("q") * F.greatest(F.lit(1.0), F.sqrt("n") / 8))
    return rows.join(plan, ["key", "g"]).withColumn("q", q).withColumn("band", band)


def _cut_offs(ranked: DataFrame) -> DataFrame:
    """(key, cut_band, cut): rows below the band are in the sample, rows of it
    up to (q, id) = ``cut``."""
    frame = ranked.filter(F.col("q").isNotNull())
    bands = frame.groupBy("key", "band").agg(F.sum("size").alias("words"), F.first("rest").alias("rest"))
    upto = F.sum("words").over(Window.partitionBy("key").orderBy("band"))
    bands = (bands.withColumn("upto", upto).withColumn("before", F.col("upto") - F.col("words"))
             .filter((F.col("before") <= F.col("rest")) & (F.col("upto") > F.col("rest")))
             .select("key", F.col("band").alias("cut_band"), "before"))
    bands = written(bands, "mixing-bands")
    edge = frame.join(bands, "key").filter("band = cut_band")
    in_rank = Window.partitionBy("key").orderBy("q", "id").rowsBetween(Window.unboundedPreceding, -1)
    taken = F.col("before") + F.coalesce(F.sum("size").over(in_rank), F.lit(0))
    last = (edge.withColumn("taken", taken).filter(2 * F.col("taken") + F.col("size") <= 2 * F.col("rest"))
            .groupBy("key").agg(F.max(F.struct("q", "id")).alias("cut")))
    return bands.select("key", "cut_band").join(last, "key", "left")


def _decided(measured: DataFrame, weights, share: float, most: float) -> DataFrame:
    """``measured`` with source_size, target and copies."""
    small = measured.select("id", "key", "size", "g", "u")
    small = written(small, "mixing-sizes", wide=True)
    classes = written(small.groupBy("key", "g").agg(F.sum("size").alias("words"),
                                                    F.count(F.lit(1)).alias("n")), "mixing-classes")
    plan = written(_plan(classes, targets(classes, weights, share, most), most), "mixing-plan")
    cuts = written(_cut_offs(_ranked(small, plan)), "mixing-cuts")
    rows = small if "row" not in measured.columns else measured
    ranked = _ranked(rows, plan).join(cuts, "key", "left")
    picked = (F.col("q").isNotNull()
              & (F.col("cut_band").isNull() | (F.col("band") < F.col("cut_band"))
                 | ((F.col("band") == F.col("cut_band"))
                    & F.coalesce(F.struct("q", "id") <= F.col("cut"), F.lit(False)))))
    return ranked.withColumn("copies", F.when(F.col("size") > 0, F.col("whole") + picked.cast("long"))
                             .otherwise(F.lit(0).cast("long")))


def mix_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               source_col: str = "source", weights=WEIGHTS, share: float = SHARE,
               most: float = MOST, seed: str = SEED) -> DataFrame:
    """One row per row of ``docs``: ``id``, ``size``, ``source_size``,
    ``target``, ``copies`` and ``taken`` (words that the mix takes)."""
    measured = _measured(docs, id_col, text_col, source_col, seed).drop("row")
    return _decided(measured, weights, share, most).select(
        "id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=WEIGHTS, share: float = SHARE, most: float = MOST, seed: str = SEED) -> DataFrame:
    """The mixed corpus: the rows of ``docs``, each as often as it is taken."""
    decided = _decided(_measured(docs, id_col, text_col, source_col, seed), weights, share, most)
    return (decided.filter("copies > 0")
            .select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"))
            .select("row.*"))
