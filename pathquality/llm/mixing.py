"""Mixing sources to target weights, in DataFrame expressions only.

Every document gets a hash-random key. Within a source the documents are range-sorted by that
key (equal key ranges, as the key is uniform), sizes are summed per range, the ranges' sums
are accumulated, and each document's prefix sum is its range's offset plus a running sum
inside the range. The source's budget then cuts this order exactly: whole epochs first, the
rest up to the cut, where one document per source is taken in part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import NOT_SPACE, partitions, put_back, set_aside, stored

WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3
_KEY_BITS = 60


def words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(NOT_SPACE)), F.lit(0)).cast("long")


def random_key(doc_id: str = "doc_id", text: str = "text", seed: str = "mix") -> Column:
    """60 uniform bits that a rerun, or another engine, computes alike. Documents without an id
    are told apart by their text."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(
        F.col(doc_id).cast("string"), F.md5(F.coalesce(F.col(text), F.lit("")))))
    return F.conv(F.substring(F.md5(name), 1, _KEY_BITS // 4), 16, 10).cast("long")


def numbered(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Rows with their position (from 0) in a total order: range partitions, a count for each,
    and a row number within. `df` is written once, so that the ranges stay what they are."""
    spark = df.sparkSession
    ranged = stored(
        df.repartitionByRange(partitions(spark), *order)
        .withColumn("__part", F.spark_partition_id()), "mix-sources")
    counts = ranged.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(  # one row per range
        "__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    inside = F.row_number().over(Window.partitionBy("__part").orderBy(*order))
    return ranged.join(offsets, "__part").withColumn(
        name, F.col("__before") + inside - 1).drop("__part", "__before")


def targets(docs: DataFrame, weights: Sequence[int] = WEIGHTS,
            most_epochs: int = MOST_EPOCHS) -> DataFrame:
    """`source`, `source_size`, `n_docs`, `target`: all sizes shared by weight.

    Sources are ordered by code point, null last, and weighed in turn. A target stops at
    `most_epochs` times its source's size; what is above is shared again by weight, until
    nothing is: target = least(limit, level * weight), where `level` is raised by one-row sums
    until the set of stopped sources no longer changes. `docs` holds `source` and `size`.
    """
    sizes = docs.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    ranked = numbered(sizes, (F.col("source").isNull(), F.col("source")), "position")
    cycle = F.array(*[F.lit(w) for w in weights])
    weighed = ranked.withColumn(
        "weight", F.element_at(cycle, (F.col("position") % len(weights) + 1).cast("int"))
    ).withColumn("limit", F.col("source_size") * most_epochs)
    level, stopped = 0.0, -1
    while True:
        full = F.col("limit") / F.col("weight") < F.lit(level)
        total, used, left, count = weighed.agg(
            F.sum("source_size"), F.sum(F.when(full, F.col("limit")).otherwise(0)),
            F.sum(F.when(full, 0).otherwise(F.col("weight"))), F.count_if(full)).first()
        if count == stopped or not left:
            break
        stopped, level = count, (total - used) / left
    return weighed.select(
        "source", "source_size", "n_docs",
        F.least(F.col("limit").cast("double"), F.lit(level) * F.col("weight")).alias("target"))


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most_epochs: int = MOST_EPOCHS,
        seed: str = "mix") -> DataFrame:
    """`docs` with `size`, `source_size`, `target` and `taken`, the words the mix takes.

    `taken` counts repeats and sums to the rounded target in every source; it is at most
    `most_epochs` times `size`. A null text has size 0, null is a source of its own, rows
    that repeat are ordered among themselves at will, an empty table gives an empty mix.
    Columns of `docs` with the names of the four results are replaced.
    """
    results = ("size", "source_size", "target", "taken")
    docs = docs.drop(*results)
    sized = set_aside(docs, "doc_id", "text", "source").withColumn("size", words())
    budget = targets(sized.select("source", "size"), weights, most_epochs)
    ranges = F.ceil(F.sqrt("n_docs"))  # as many ranges as documents in each
    keyed = (
        sized.withColumn("__key", random_key(seed=seed)).withColumnRenamed("source", "__source")
        .join(budget, F.col("__source").eqNullSafe(F.col("source"))).drop("__source")
        .withColumn("__range", F.floor(F.col("__key") / F.lit(float(1 << _KEY_BITS)) * ranges))
    )
    sums = keyed.groupBy("source", "__range").agg(F.sum("size").alias("__sum"))
    before = Window.partitionBy("source").orderBy("__range").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = sums.select(
        F.col("source").alias("__of"), F.col("__range").alias("__in"),
        F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__offset"))
    placed = keyed.join(
        offsets, F.col("source").eqNullSafe(F.col("__of")) & (F.col("__range") == F.col("__in")))
    running = Window.partitionBy("source", "__range").orderBy("__key", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    start = F.col("__offset") + F.sum("size").over(running) - F.col("size")
    exact = F.floor(F.col("target") + 0.5)
    size = F.greatest(F.col("source_size"), F.lit(1))
    epochs = F.floor(exact / size)
    rest = exact - epochs * F.col("source_size") - F.col("__start")
    cut = F.greatest(F.lit(0), F.least(rest, F.col("size")))
    taken = placed.withColumn("__start", start).withColumn(
        "taken", (epochs * F.col("size") + cut).cast("long"))
    return put_back(taken, docs, "doc_id", "text", "source", new=results)


def repeated(mixed: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The mix itself: every document as often as it is taken, its last copy cut after the
    word that fills the budget. A cut text is its words joined by one space."""
    whole = F.floor(F.col("taken") / F.greatest(F.col("size"), F.lit(1))).cast("int")
    part = (F.col("taken") - whole * F.col("size")).cast("int")
    copies = F.explode(F.sequence(F.lit(1), whole + F.when(part > 0, 1).otherwise(0)))
    words_of = F.regexp_extract_all("text", F.lit(NOT_SPACE), F.lit(0))
    is_cut = F.col("__copy") > F.col("__whole")
    text = F.when(is_cut, F.array_join(F.slice(words_of, 1, F.col("__part")), " ")).otherwise(
        F.col("text"))
    out = mixed.filter("taken > 0").withColumns({"__whole": whole, "__part": part}).withColumn(
        "__copy", copies).withColumn("text", text)
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.when(is_cut, F.length("text").cast("long")).otherwise(
            F.col("n_chars")))
    return out.select(*columns)


MIX_SQL = """
with sized as (
    select doc_id, source,
           case when text is null then 0
                else len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) end::bigint as size,
           ('0x' || substr(md5('mix:' || coalesce(doc_id::varchar, md5(coalesce(text, '')))), 1, 15))::bigint as key
    from documents
), by_source as (
    select source, sum(size)::bigint as source_size,
           case (row_number() over (order by source nulls last) - 1) % 3
                when 0 then 5 when 1 then 2 else 1 end as weight
    from sized group by source
), ratio as (
    select *, 3 * source_size as lim, (3 * source_size) / weight::double as r from by_source
), levels as (
    select a.r, ((select sum(source_size) from ratio)
                 - coalesce(sum(b.lim) filter (where b.r < a.r), 0))::double
              / sum(b.weight) filter (where b.r >= a.r)::double as level
    from ratio a, ratio b group by a.source, a.r
), chosen as (
    select level from levels where r >= level order by r, level limit 1
), target as (
    select source, source_size, least(lim::double, (select level from chosen) * weight) as target
    from ratio
), placed as (
    select s.doc_id, s.size, t.source_size, t.target,
           floor(t.target + 0.5)::bigint as exact,
           (sum(s.size) over (partition by s.source order by s.key, s.doc_id, s.size
                              rows unbounded preceding) - s.size)::bigint as start
    from sized s join target t on s.source is not distinct from t.source
)
select doc_id, size, source_size, target,
       ((exact // greatest(source_size, 1)) * size
        + greatest(0, least(exact % greatest(source_size, 1) - start, size)))::bigint as taken
from placed
"""
