"""Mixing sources to target weights by Pareto order sampling, in DataFrame functions alone.

Each source gets a target size. A target above the source's size becomes whole copies of every document; the rest is a
sample without replacement: documents are ranked by their random odds divided by their inclusion odds, and the first
are taken until the rest of the target is reached. The inclusion odds of a document grow with the square root of its
size over the mean of its source: short documents give way to longer ones, yet each has its chance. The random numbers
come from id and text, so reruns agree.

The cut is found without ordering a source: its documents are counted in ``BUCKETS`` ranges of the ranking variable,
and only the one range in which the target is reached is ordered. Whether a document is taken is then a comparison
with its source's cut, which can be applied to any table with the same ids, sources, sizes and draws. Rows equal in all
of these share their place in the ranking; where the cut falls among them, they are numbered and the first are taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.store import saved

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MOST = 3
BUCKETS = 65_536


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("bigint")


def draw_of(id_col: Column, text: Column) -> Column:
    """52 bits of the MD5 of id and text, as a number."""
    drawn = F.concat(F.coalesce(id_col.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(drawn.cast("binary")), 1, 13), 16, 10).cast("bigint")


def chance(draw: Column) -> Column:
    """A draw as a number between 0 and 1."""
    return (draw + F.lit(0.5)) / F.lit(4503599627370496.0)


def odds(p: Column) -> Column:
    return p / (F.lit(1.0) - p)


def targets(sizes: DataFrame) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, source_size)``.

    Sources by code point, null last, weigh 1, 2, 3, repeating. A target stops at three times the source's size; what
    is left over is shared by weight among the others. The sources that stop come first when ordered by size over
    weight, so running sums find them all at once.
    """
    ranked = sizes.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), F.pmod(F.col("rank") - 1, F.lit(len(WEIGHTS))) + 1)
    ranked = ranked.withColumn("weight", weight).withColumn("most", F.lit(MOST) * F.col("source_size"))
    order = Window.orderBy(F.col("most") / F.col("weight"), "rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    every = Window.partitionBy()
    with_sums = ranked.select(
        "source", "source_size", "weight", "most",
        F.sum("source_size").over(every).alias("total"), F.sum("weight").over(every).alias("weights"),
        (F.sum("most").over(order) - F.col("most")).alias("most_before"), (F.sum("weight").over(order) - F.col("weight")).alias("weight_before"),
    )
    share = (F.col("total") - F.col("most_before")) / (F.col("weights") - F.col("weight_before"))
    stops = with_sums.withColumn("stops", F.col("weight") * share >= F.col("most"))
    left = F.sum(F.when(F.col("stops"), F.col("most")).otherwise(0)).over(every)
    left_weight = F.sum(F.when(F.col("stops"), 0).otherwise(F.col("weight"))).over(every)
    return stops.select(
        "source", "source_size",
        F.when(F.col("stops"), F.col("most").cast("double")).otherwise(F.col("weight") * ((F.col("total") - left) / left_weight)).alias("target"),
    )


# Rows that agree in these share their place.
_PLACE = ["key", "doc_id", "size", "draw"]


def _ranked(sized: DataFrame, of_source: DataFrame) -> DataFrame:
    """Rows with their source's figures and ``key``, the Pareto variable (null where no part of a copy is left)."""
    a, b = sized.alias("a"), of_source.alias("b")
    rows = a.join(b, F.col("a.source").eqNullSafe(F.col("b.source")), "left").drop(F.col("b.source"))
    part = F.col("part")
    lift = F.sqrt(F.greatest(F.col("size"), F.lit(1)).cast("double") / (F.col("source_size").cast("double") / F.col("source_docs").cast("double")))
    key = F.when((part > 0) & (part < 1), odds(chance(F.col("draw"))) / (odds(part) * lift))
    return rows.withColumn("key", key).withColumn("bucket", F.floor(F.lit(BUCKETS) * F.col("key") / (F.lit(1.0) + F.col("key"))))


def allot(sized: DataFrame) -> DataFrame:
    """What each source contributes: size, target, whole copies, and the cut of the ranking up to which one more is taken.

    ``sized`` has ``doc_id``, ``source``, ``size`` and ``draw``. The cut is a bucket, all before which is taken, the last
    place taken within it (null if none), and how many of the ``n_last`` rows in that place are taken.
    """
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_docs"))
    wanted, a = targets(sums.select("source", "source_size")), sums.select("source", "source_docs").alias("a")
    b = wanted.alias("b")
    of_source = b.join(a, F.col("a.source").eqNullSafe(F.col("b.source"))).drop(F.col("a.source"))
    times = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(times)
    of_source = saved(
        of_source.withColumn("whole", whole).withColumn("part", times - whole)
        .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")),
        "mix-sources",
    )
    rows = _ranked(sized, of_source).filter("key IS NOT NULL")
    counts = rows.groupBy("source", "rest", "bucket").agg(F.sum("size").alias("in_bucket"))
    running = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edges = counts.withColumn("upto", F.sum("in_bucket").over(running)).withColumn("before", F.col("upto") - F.col("in_bucket"))
    edge = edges.filter("before < rest AND upto >= rest").groupBy("source").agg(F.min("bucket").alias("edge"), F.min_by("before", "bucket").alias("before"))
    edge = saved(edge, "mix-edges")
    a, b = rows.alias("a"), edge.alias("b")
    same = F.col("a.source").eqNullSafe(F.col("b.source")) & (F.col("a.bucket") == F.col("b.edge"))
    # Equal rows collapse before they are ordered, so a row with any number of copies is one place.
    places = a.join(b, same).drop(F.col("b.source")).groupBy("source", "rest", "before", *_PLACE).agg(F.count(F.lit(1)).alias("n_last"))
    order = Window.partitionBy("source").orderBy(*_PLACE).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    here = F.col("n_last") * F.col("size")
    left = F.col("rest") - (F.col("before") + F.sum(here).over(order) - here)
    # A row is taken while half of it or more lies before the rest of the target.
    fitting = F.when(F.col("size") > 0, F.ceil(left / F.greatest(F.col("size"), F.lit(1)) + F.lit(0.5)) - 1).when(left > 0, F.col("n_last")).otherwise(F.lit(0))
    taken = places.withColumn("n_taken", F.least(F.col("n_last"), fitting)).filter("n_taken > 0")
    last = taken.groupBy("source").agg(F.max(F.struct(*_PLACE, "n_taken", "n_last")).alias("last"))
    last = last.select("source", F.struct(*(F.col(f"last.{name}").alias(name) for name in _PLACE)).alias("last"), "last.n_taken", "last.n_last")
    out = of_source
    for figures in (edge.select("source", "edge"), last):
        a, b = out.alias("a"), figures.alias("b")
        out = a.join(b, F.col("a.source").eqNullSafe(F.col("b.source")), "left").drop(F.col("b.source"))
    return saved(out, "mix-allotments")


def copies(docs: DataFrame, allotments: DataFrame) -> DataFrame:
    """The rows of ``docs`` (with ``doc_id``, ``source``, ``size`` and ``draw``) with their source's columns and ``copies``."""
    rows = _ranked(docs, allotments)
    here, cut = F.struct(*_PLACE), F.coalesce(F.col("bucket") == F.col("edge"), F.lit(False))
    before = F.col("key").isNotNull() & (F.col("edge").isNull() | (F.col("bucket") < F.col("edge")))
    on_cut = cut & F.coalesce(here.eqNullSafe(F.col("last")), F.lit(False))
    up_to = before | (cut & F.coalesce(here <= F.col("last"), F.lit(False)))
    count = lambda taken: (F.coalesce("whole", F.lit(0)) + taken.cast("int")).cast("bigint")
    if allotments.filter("n_taken < n_last").isEmpty():
        return rows.withColumn("copies", count(up_to))
    # Only the rows in the place that is cut are written down; each file's rows are numbered after those of the files before.
    file, row = F.col("_metadata.file_path").alias("cut_file"), F.col("_metadata.row_index").alias("cut_row")
    numbered = saved(rows.filter(on_cut), "mix-cut").select("*", file, row)
    numbered = numbered.withColumn("nth", F.row_number().over(Window.partitionBy("source", "cut_file").orderBy("cut_row")))
    earlier = Window.partitionBy("source").orderBy("cut_file").rowsBetween(Window.unboundedPreceding, -1)
    of_file = numbered.groupBy("source", "cut_file").agg(F.count(F.lit(1)).alias("n_file"))
    of_file = of_file.withColumn("n_before", F.coalesce(F.sum("n_file").over(earlier), F.lit(0)))
    a, b = numbered.alias("a"), of_file.alias("b")
    same = F.col("a.source").eqNullSafe(F.col("b.source")) & (F.col("a.cut_file") == F.col("b.cut_file"))
    chosen = a.join(b, same).select("a.*", "b.n_before").withColumn("copies", count(F.col("n_before") + F.col("nth") <= F.col("n_taken")))
    return rows.filter(~on_cut).withColumn("copies", count(up_to)).unionByName(chosen.select(*rows.columns, "copies"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``(doc_id, source, size, source_size, target, copies, taken)`` per document.

    Null texts have size 0; null sources are a source of their own, ordered last. Sources without words have target 0.
    Rows that repeat an id are drawn by their texts as well; rows equal in all of this are taken alike, but where the cut
    falls among them as many are taken as the target leaves room for. Other columns are ignored; an empty table gives
    no rows.
    """
    sized = saved(
        docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(source_col).cast("string").alias("source"), size_of(F.col(text_col)).alias("size"), draw_of(F.col(id_col).cast("bigint"), F.col(text_col)).alias("draw")),
        "mix-sizes",
    )
    out = copies(sized, allot(sized))
    return out.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))
