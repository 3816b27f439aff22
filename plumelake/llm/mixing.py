"""Mixing sources to target weights by nested hash thresholds.

Every document has a fixed place on a line of 2^36 points, the hash of its id. A
source takes the documents below a threshold on that line. The threshold comes from
histograms, not from sorting: tokens are summed per source and bucket of the line,
the bucket in which the budget runs out is cut into finer buckets, and so on down to
single points. Only documents of that bucket are read again.

A source whose target is more than its size takes every document as often as fits
and fills the rest by a threshold. What the first threshold leaves open, because the
next document is too large, is offered to the smaller documents above it, in nested
passes. Nothing is sorted and no source is gathered in one task: sums are partial
before they are shuffled.

Defined results: a null text has size 0; null is a source of its own, after all
others; documents with the same id share a place and are taken together; a source
of size 0 takes nothing; extra columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from plumelake.llm.common import n_words, written

WEIGHTS = (5, 2, 1)     # fixed values of the mix, repeated over the sources
MOST_COPIES = 3
BITS, LEVELS = 12, 3    # 4,096 buckets per level
PASSES = 4              # nested thresholds; each leaves a smaller rest


def place(id_col: str) -> Column:
    """Where a document lies on the line, the same in every run."""
    return F.shiftrightunsigned(F.xxhash64(id_col), 64 - BITS * LEVELS)


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS,
                   most: int = MOST_COPIES) -> DataFrame:
    """One row per source: _source, _source_size, _target.

    ``sizes`` has one row per source with _source and _source_size. Sources are
    numbered through their sorted ranges, without gathering them. The total is shared
    by weight; sources above ``most`` times their size stop there and the rest is
    shared again until none is above. A round is one pass over the sources, and
    fixes at least one of them.
    """
    spark = sizes.sparkSession
    ranged = sizes.repartitionByRange(F.col("_source").asc_nulls_last()).sortWithinPartitions(
        F.col("_source").asc_nulls_last()).withColumns({
            "_part": F.spark_partition_id(), "_order": F.monotonically_increasing_id()})
    ranged = written(ranged, "mix-sources")
    before = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("n"), F.min("_order").alias("first"))
    starts, total = {}, 0
    for r in sorted(before.collect(), key=lambda r: r["_part"]):    # one row per task
        starts[r["_part"]] = total - r["first"]
        total += r["n"]
    rank = F.col("_order")
    if starts:
        shift = spark.createDataFrame(list(starts.items()), "_part int, _shift long")
        ranged = ranged.join(F.broadcast(shift), "_part")           # one row per task
        rank = F.col("_order") + F.col("_shift")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (rank % len(weights) + 1).cast("int"))
    known = ranged.select("_source", "_source_size", weight.alias("_weight"))
    cap = most * F.col("_source_size").cast("double")
    # ``share`` is the amount per unit of weight; it only grows, so a source that is
    # stopped stays stopped.
    share = 0.0
    while True:
        over = F.col("_weight") * share > cap
        s = known.agg(
            F.sum("_source_size").alias("total"),
            F.sum(F.when(over, cap).otherwise(0.0)).alias("stopped"),
            F.sum(F.when(over, 0.0).otherwise(F.col("_weight"))).alias("weight")).first()
        if not s["total"] or not s["weight"]:
            break
        new = (s["total"] - s["stopped"]) / s["weight"]
        if new <= share:
            break
        share = new
    return known.select("_source", "_source_size",
                        F.least(cap, F.col("_weight") * share).alias("_target"))


def _boundary(candidates: DataFrame) -> DataFrame:
    """Per source whose candidates exceed its budget: the place where it runs out,
    the sum before it and the sum at it.

    ``candidates``: _source, _size, _place and the budget ``_left``. Each level reads
    only the boundary bucket of the level before, by a join on source and bucket.
    """
    found = None
    rest = candidates
    for level in range(LEVELS):
        width = BITS * (LEVELS - 1 - level)
        keys = ["_source", "_start", "_before"] if level else ["_source"]
        cell = F.shiftright(F.col("_place"), width).alias("_cell")
        summed = rest.groupBy(*keys, cell).agg(
            F.sum("_size").alias("_sum"), F.max("_left").alias("_left"))
        if not level:
            summed = summed.withColumn("_before", F.lit(0).cast("long"))
        # At most 4,096 cells of a source.
        line = Window.partitionBy("_source").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
        running = summed.withColumn("_sofar", F.col("_before") + F.coalesce(F.sum("_sum").over(line), F.lit(0)))
        over = running.where(F.col("_sofar") + F.col("_sum") > F.col("_left"))
        first = over.groupBy("_source").agg(F.min(F.struct("_cell", "_sofar", "_sum")).alias("b")).select(
            "_source", F.col("b._cell").alias("_cut"), F.col("b._sofar").alias("_before"),
            F.col("b._sum").alias("_next"))
        found = written(first.select("_source", F.shiftleft("_cut", width).alias("_start"), "_before", "_next"),
                        "mix-boundary")
        if level < LEVELS - 1:
            edge = found.withColumnRenamed("_source", "_edge_source").drop("_next")
            rest = candidates.join(edge, candidates["_source"].eqNullSafe(edge["_edge_source"]) & (
                F.shiftright(F.col("_place"), width) == F.shiftright(F.col("_start"), width))).drop("_edge_source")
    return found


def _placed(docs: DataFrame, source: str, id_col: str, size: Column | None, keep: list[str]) -> DataFrame:
    size = n_words(F.col("text")) if size is None else size
    return docs.select(*keep, F.col(source).alias("_source"), size.alias("_size"),
                       place(id_col).alias("_place"))


def _with_state(rows: DataFrame, table: DataFrame) -> DataFrame:
    """Rows with the state of their source: a few numbers per source."""
    state = table.withColumnRenamed("_source", "_of")
    return rows.join(state, rows["_source"].eqNullSafe(state["_of"]), "left").drop("_of")


def _below(n_passes: int) -> Column:
    """Documents that one of the thresholds takes once more."""
    taken = F.lit(False)
    for n in range(n_passes):
        taken = taken | ((F.col("_size") <= F.col(f"_fits{n}")) & (F.col("_place") < F.col(f"_cut{n}")))
    return (F.col("_size") > 0) & taken


def mix_state(light: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """One row per source: sizes, target, whole copies and the thresholds.
    ``light`` is a stored table of _source, _size and _place, read a few times."""
    sizes = light.groupBy("_source").agg(F.sum("_size").alias("_source_size"))
    whole = F.when(F.col("_source_size") > 0, F.floor(F.col("_target") / F.col("_source_size"))).otherwise(0)
    rest = F.col("_target") - F.col("_whole") * F.col("_source_size")
    table = source_targets(written(sizes, "mix-sizes"), weights, most).withColumn("_whole", whole)
    table = written(table.withColumn("_left", F.when(F.col("_whole") < most, rest).otherwise(0.0)), "mix-targets")
    for n in range(PASSES):
        rows = _with_state(light, table).where(
            (F.col("_size") > 0) & (F.col("_size") <= F.col("_left")) & ~_below(n)).select(
            "_source", "_size", "_place", "_left")
        edges = _boundary(rows).withColumnRenamed("_source", "_of")
        everything = rows.groupBy(F.col("_source").alias("_all")).agg(F.sum("_size").alias("_fit"))
        step = table.join(edges, table["_source"].eqNullSafe(edges["_of"]), "left")
        step = step.join(everything, step["_source"].eqNullSafe(everything["_all"]), "left")
        # Without a boundary everything that fits is taken. In the last pass the
        # boundary itself is taken too if that comes nearer to the target.
        used = F.when(F.col("_start").isNull(), F.col("_fit")).otherwise(F.col("_before"))
        nearer = F.lit(n == PASSES - 1) & (
            F.col("_before") + F.col("_next") - F.col("_left") < F.col("_left") - F.col("_before"))
        kept = [c for c in table.columns if c != "_left"]
        table = written(step.select(
            *kept, F.col("_left").alias(f"_fits{n}"),
            F.when(F.col("_start").isNull(), F.lit(1 << BITS * LEVELS)).otherwise(
                F.col("_start") + nearer.cast("int")).alias(f"_cut{n}"),
            (F.col("_left") - F.coalesce(used, F.lit(0))).alias("_left")), "mix-pass")
    return table


def copies() -> Column:
    return (F.col("_whole") + _below(PASSES).cast("int")).cast("int")


def mix(docs: DataFrame, source: str = "source", id_col: str = "doc_id", size: Column | None = None,
        weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """A row per document: the id, size, source_size, target and ``copies``, how often
    the mix takes it."""
    light = written(_placed(docs, source, id_col, size, [id_col]), "mix-documents")
    state = mix_state(light, weights, most)
    return _with_state(light, state).select(
        id_col, F.col("_size").alias("size"), F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"), copies().alias("copies"))


def mixed_documents(docs: DataFrame, source: str = "source", id_col: str = "doc_id",
                    weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it. A text only meets the
    few numbers of its source, so texts are not shuffled."""
    state = mix_state(written(_placed(docs, source, id_col, None, []), "mix-documents"), weights, most)
    rows = _with_state(_placed(docs, source, id_col, None, [F.struct(*docs.columns).alias("_row")]), state)
    times = F.when(copies() > 0, F.sequence(F.lit(1), copies()))
    return rows.select("_row", F.explode(times).alias("_copy")).select("_row.*")
