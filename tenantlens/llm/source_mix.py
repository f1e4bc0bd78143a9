r"""Mixing sources to target weights, with whole epochs before a weighted draw.

Sizes are words ``[^\x20\x09-\x0D]+``. Sources sorted by code point, null last,
weigh 1, 2, 3, 1, ... and share the total size by weight. No target exceeds
``MOST_EPOCHS`` times its source; the excess goes to the others by weight.

A source gives each document as often as whole epochs fit into its target. What
is left of the target is drawn without replacement by exponential keys
``-ln(u) / quality weight`` (Efraimidis-Spirakis): ascending keys are prefix-summed
to the budget, and the document at its end is taken if that comes nearer. ``u`` is
a hash of id, text and seed, so reruns and retried tasks agree. Equal rows have one
key; where the budget ends in them, as many of them are taken as fit.

Scale: texts are read once, for size and hash. Keys fall into ``BUCKETS`` ranges;
prefix sums go over the sizes of a source's buckets, and only the bucket where the
budget ends is sorted, so a source with a third of all rows is never in one task.
The decision is one key per source, which documents are compared with where they
lie. A label that could not change a document's decision is not asked for, so that of
the texts only those near a cut are moved (``mixed``). All of it is DataFrame functions.

Defined cases: a null text has size 0; null is a source of its own; rows of the same
id and text are documents of their own, taken one by one; a very long text counts all
its words; an empty table gives no rows; a missing quality weighs 1; other columns take
no part.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tenantlens.llm.common import stored

MOST_EPOCHS = 3
BUCKETS = 4_096
SEED = 17
WORD = r"[^\x20\x09-\x0D]+"
QUALITY_WEIGHTS = {1: 2.0, 0: 0.5}  # of a labelled document; 1.0 without label


def size_of(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def draw(doc_id: str = "doc_id", text: str = "text", seed: int = SEED) -> Column:
    """A number strictly between 0 and 1 from id, text and seed."""
    parts = (F.coalesce(F.col(doc_id).cast("string"), F.lit("null")), F.md5(F.coalesce(F.col(text), F.lit(""))), F.lit(str(seed)))
    hexes = F.substring(F.md5(F.concat_ws("|", *parts)), 1, 13)
    return (F.conv(hexes, 16, 10).cast("double") + 0.5) / float(1 << 52)


def quality_of(labels: DataFrame) -> DataFrame:
    """doc_id, quality: the best label of each document."""
    return labels.groupBy("doc_id").agg(F.max("quality").alias("quality")).filter("doc_id IS NOT NULL")


def weight_of(quality: str) -> Column:
    weight = F.lit(1.0)
    for value, factor in QUALITY_WEIGHTS.items():
        weight = F.when(F.col(quality) == value, factor).otherwise(weight)
    return weight


def sized(docs: DataFrame, labels: DataFrame | None, seed: int = SEED) -> DataFrame:
    """doc_id, source, size, key: what the mix needs of each document."""
    rows = docs.select("doc_id", "source", size_of().alias("size"), draw(seed=seed).alias("u"))
    weight = F.lit(1.0)
    if labels is not None:
        rows, weight = rows.join(quality_of(labels), "doc_id", "left"), weight_of("quality")
    return rows.select("doc_id", "source", "size", (-F.log("u") / weight).alias("key"))


def numbered(rows: DataFrame, group: str) -> DataFrame:
    """Written rows with ``__copy``, their number within ``group`` from 0. A large group is
    numbered in the parts it was written in, and the parts' counts are summed."""
    rows = stored(rows.withColumn("__row", F.monotonically_increasing_id()), "mix-copies")
    part = F.shiftright("__row", 33).alias("__part")
    counts = rows.groupBy(group, part).agg(F.count("*").alias("__n"))
    before = Window.partitionBy(group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        F.col(group).alias("__group"), F.col("__part").alias("__of_part"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before")
    )
    inside = F.row_number().over(Window.partitionBy(group, part).orderBy("__row")) - 1
    each = rows.withColumn("__inside", inside)
    same = F.col(group).eqNullSafe(F.col("__group")) & (part == F.col("__of_part"))
    joined = each.join(counts, same).withColumn("__copy", F.col("__before") + F.col("__inside"))
    return joined.drop("__row", "__inside", "__group", "__of_part", "__before")


def targets(rows: DataFrame) -> DataFrame:
    """source, source_size, target: one row per source."""
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    weighed = sums.withColumn("weight", (F.row_number().over(by_name) - 1) % 3 + 1)
    cap = F.col("source_size") * MOST_EPOCHS
    everything = Window.partitionBy()
    filling = Window.orderBy(cap / F.col("weight"), F.asc_nulls_last("source"))
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    # the share of a unit of weight if the sources that fill up earlier are at their caps
    level = (
        F.sum("source_size").over(everything) - F.coalesce(F.sum(cap).over(before), F.lit(0))
    ) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    filled = weighed.withColumn("cap", cap).withColumn("level", level).withColumn("place", F.row_number().over(filling))
    fits = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct("place", "level"))
    final = F.min(fits).over(everything)["level"]
    return filled.select(
        "source",
        "source_size",
        F.least(F.col("cap").cast("double"), F.coalesce(final, F.lit(0.0)) * F.col("weight")).alias("target"),
    )


def cuts(rows: DataFrame) -> DataFrame:
    """source, source_size, target, epochs, cut: keys up to ``cut`` are taken once more."""
    goal = targets(rows).withColumn(
        "epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    )
    goal = goal.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    goal = stored(goal, "mix-targets")
    bucket = F.floor((F.lit(1.0) - F.exp(-F.col("key"))) * BUCKETS).alias("bucket")
    counted = rows.filter("size > 0").groupBy("source", bucket).agg(F.sum("size").alias("held"))
    upto = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counted = counted.withColumn("before", F.coalesce(F.sum("held").over(upto), F.lit(0)))
    open_goal = goal.filter("rest > 0").select(F.col("source").alias("of"), "rest")
    last = (
        counted.join(open_goal, F.col("source").eqNullSafe(F.col("of")))
        .filter("before < rest AND before + held >= rest")
        .select("of", F.col("bucket").alias("at"), "before", "rest")
    )
    inside = rows.filter("size > 0").select("source", "size", "key", bucket)
    inside = inside.join(last, F.col("source").eqNullSafe(F.col("of")) & (F.col("bucket") == F.col("at")))
    # equal rows have equal keys: they are one step of the sum, of so many copies
    inside = inside.groupBy("of", "before", "rest", "key", "size").agg(F.count("*").alias("copies"))
    step = F.col("size") * F.col("copies")
    running = F.sum(step).over(Window.partitionBy("of").orderBy("key", "size"))
    inside = inside.withColumn("left", F.col("rest") - F.col("before") - running + step)
    ends = inside.filter((F.col("left") > 0) & (F.col("left") <= step))
    fits = F.floor(F.col("left") / F.col("size"))
    over = (fits + 1) * F.col("size") - F.col("left")
    nearer = (fits < F.col("copies")) & (over < F.col("left") - fits * F.col("size")) & (F.col("left") > fits * F.col("size"))
    ends = ends.select(
        F.col("of").alias("of_"),
        F.col("key").alias("cut"),
        F.col("size").alias("cut_size"),
        F.least(fits + nearer.cast("long"), F.col("copies")).alias("cut_copies"),
    )
    # a budget that rounding has put behind the last row takes all of the bucket
    upto_bucket = -F.log(F.lit(1.0) - (F.col("at") + 1) / F.lit(float(BUCKETS)))
    behind = last.select("of", F.when(F.col("at") < BUCKETS - 1, upto_bucket).otherwise(F.lit(float("inf"))).alias("behind"))
    found = behind.join(ends, F.col("of").eqNullSafe(F.col("of_")), "left").select(
        "of",
        F.coalesce("cut", "behind").alias("cut"),
        F.coalesce("cut_size", F.lit(0)).alias("cut_size"),
        F.coalesce("cut_copies", F.lit(0)).alias("cut_copies"),
    )
    return goal.join(found, goal["source"].eqNullSafe(found["of"]), "left").select(
        "source", "source_size", "target", "epochs", "cut", "cut_size", "cut_copies"
    )


def _at_cut(key: Column, size: Column, prefix: str = "") -> Column:
    """Whether a document is one of the equal rows that the budget ends in."""
    return F.coalesce((key == F.col(prefix + "cut")) & (size == F.col(prefix + "cut_size")), F.lit(False))


def _before_cut(key: Column, size: Column, prefix: str = "") -> Column:
    cut = F.col(prefix + "cut")
    return F.coalesce((key < cut) | ((key == cut) & (size < F.col(prefix + "cut_size"))), F.lit(False))


def mix(docs: DataFrame, labels: DataFrame | None = None, seed: int = SEED) -> DataFrame:
    """doc_id, size, source_size, target, taken (words the mix takes of the document)."""
    rows = stored(sized(docs, labels, seed), "mix-rows")
    per_source = stored(cuts(rows), "mix-cuts").withColumnRenamed("source", "of")
    joined = rows.join(per_source, F.col("source").eqNullSafe(F.col("of")))
    key, size = F.col("key"), F.col("size")
    out = ["doc_id", "size", "source_size", "target"]
    plain = joined.filter(~_at_cut(key, size))
    plain = plain.select(*out, (size * (F.col("epochs") + _before_cut(key, size).cast("int"))).alias("taken"))
    copies = numbered(joined.filter(_at_cut(key, size)).select(*out, "of", "epochs", "cut_copies"), "of")
    once_more = (F.col("__copy") < F.col("cut_copies")).cast("int")
    return plain.unionByName(copies.select(*out, (size * (F.col("epochs") + once_more)).alias("taken")))


def _open(key: Column, prefix: str = "") -> Column:
    """Whether a document's label decides if it is taken once more: of all weights that it
    may have, the largest puts its key up to the cut and the smallest does not."""
    weights = [1.0, *QUALITY_WEIGHTS.values()]
    size = F.col(f"{prefix}size")
    least, most = key / F.lit(max(weights)), key / F.lit(min(weights))
    return (_before_cut(least, size, prefix) | _at_cut(least, size, prefix)) & ~_before_cut(most, size, prefix)


def mixed(docs: DataFrame, labels: DataFrame | None = None, seed: int = SEED) -> DataFrame:
    """The rows of ``docs``, all columns kept, each as often as the mix takes it.

    Most documents are taken alike whatever their label, and are decided where they lie;
    only the others go through the join with the labels.
    """
    narrow = stored(sized(docs, labels, seed), "mix-rows")
    per_source = stored(cuts(narrow), "mix-cuts")
    names = ["epochs", "cut", "cut_size", "cut_copies"]
    per_source = per_source.select("source", *names).toDF("__of", *[f"__{n}" for n in names])
    of_source = F.col("source").eqNullSafe(F.col("__of"))
    ending = narrow.join(per_source, of_source).filter(_at_cut(F.col("key"), F.col("size"), "__"))
    ending = stored(ending.select(F.col("doc_id").alias("__end")).distinct(), "mix-ends")  # about one a source

    def weighed(rows: DataFrame) -> DataFrame:
        """With ``__key`` by the quality of each document."""
        if labels is None:
            return rows.withColumn("__key", F.col("__plain"))
        known = quality_of(labels).toDF("__id", "__quality")
        joined = rows.join(known, F.col("doc_id") == F.col("__id"), "left")
        return joined.withColumn("__key", F.col("__plain") / weight_of("__quality"))

    def keyed(rows: DataFrame) -> DataFrame:
        # unpacked by a generator: filters on these do not read the text once more each
        of_text = F.struct(size_of().alias("__size"), (-F.log(draw(seed=seed))).alias("__plain"))
        return rows.select("*", F.inline(F.array(of_text))).filter("__size > 0").join(per_source, of_source)

    key, size = F.col("__key"), F.col("__size")
    rows = keyed(docs)
    asking = F.lit(False) if labels is None else F.col("doc_id").isNotNull() & _open(F.col("__plain"), "__")
    decided = rows.filter(~asking).withColumn("__key", F.col("__plain"))
    times = (F.col("__epochs") + _before_cut(key, size, "__").cast("int")).alias("__times")
    several = [r.filter(~_at_cut(key, size, "__")).select(*docs.columns, times) for r in (decided, weighed(rows.filter(asking)))]
    copies = weighed(keyed(docs.join(ending, F.col("doc_id").eqNullSafe(F.col("__end")), "left_semi")))
    copies = copies.filter(_at_cut(key, size, "__")).select(*docs.columns, "__of", "__epochs", "__cut_copies")
    once_more = F.col("__epochs") + (F.col("__copy") < F.col("__cut_copies")).cast("int")
    several.append(numbered(copies, "__of").select(*docs.columns, once_more.alias("__times")))
    every = reduce(DataFrame.unionByName, several if labels is not None else [several[0], several[2]])
    return every.withColumn("__each", F.explode(F.array_repeat(F.lit(0), F.col("__times").cast("int")))).select(*docs.columns)
