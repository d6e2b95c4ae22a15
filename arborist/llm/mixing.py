"""Mixing sources to target weights by hash-random order and exact cuts.

Every document gets a key that is a hash of its identity.  Keys are
uniform, so equal key ranges are equal shares of a source: documents are
range-sorted by key within (source, range), the ranges' word counts are
added up first, and the prefix sums say where each source's budget ends.
Budgets over the source's size repeat whole epochs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, bounded, prefix_sums, salted_join, written

# Weights by the sources' code point order, repeating; the most epochs.
WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3


def row_number_by(df: DataFrame, *order) -> DataFrame:
    """Add ``index`` from 0 in the given order without a single-task sort:
    range-sorted partitions are written with their local position; only one
    number per partition reaches the driver."""
    local = written(df.orderBy(*order).withColumn("__at", F.monotonically_increasing_id()))
    part, position = F.shiftright("__at", 33), F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = sorted((r[0], r[1]) for r in local.groupBy(part.alias("p")).count().collect())
    starts, total = [], 0
    for p, n in sizes:
        starts += [F.lit(p), F.lit(total)]
        total += n
    start = F.create_map(*starts)[part] if starts else F.lit(0)
    return local.withColumn("index", (start + position).cast("long")).drop("__at")


def _targets(totals: DataFrame, weights, cap: int):
    """Totals with ``target``: one level of words per weight for all sources
    below their cap; sources that would pass it stay at it.  Every round
    adds sources to the capped ones, so it ends; two sums per round reach
    the driver."""
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("index") % len(weights) + 1).cast("int"))
    totals = written(totals.withColumn("weight", weight).withColumn("most", F.col("source_size") * F.lit(cap)))
    whole = totals.agg(F.sum("source_size")).first()[0] or 0
    level, capped = 0.0, -1
    while True:
        over = F.col("most") <= F.col("weight") * F.lit(level)
        n, held, left = totals.agg(
            F.count_if(over), F.sum(F.when(over, F.col("most"))), F.sum(F.when(~over, F.col("weight")))
        ).first()
        if n == capped or not left:
            break
        capped, level = n, (whole - (held or 0)) / left
    return totals.withColumn("target", F.least(F.col("most").cast("double"), F.col("weight") * F.lit(level)))


def _keyed(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: str) -> DataFrame:
    """``docs`` plus the columns the plan works on: id, source, its name without
    nulls, words and a 64-bit key that follows from the seed, id and text."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), F.col(id_col).cast("string"), F.md5(F.col(text_col))))
    source = F.col(source_col).cast("string")
    return docs.withColumns({
        "__id": F.col(id_col),
        "__source": source,
        "__name": F.coalesce(F.concat(F.lit("s"), source), F.lit("n")),
        "__size": F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long"),
        # 60 bits of the digest, moved up: the prefix sums cut at the top bits.
        "__key": F.shiftleft(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), 4),
    })


_PLAN = ["__id", "__source", "__name", "__size", "__key"]


def _facts(rows: DataFrame, weights, cap: int) -> tuple[DataFrame, int, int, int]:
    """Totals, targets and budgets by source, with their number, bytes and the rows counted."""
    totals = rows.groupBy("__name", F.col("__source").alias("source")).agg(
        F.sum("__size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    totals = _targets(row_number_by(totals, F.asc_nulls_last("source")), weights, cap)
    totals = totals.withColumn("budget", F.least(F.col("most"), F.round("target").cast("long")))
    n_sources, name_bytes, n_rows = totals.agg(
        F.count(F.lit(1)), F.sum(F.octet_length("__name")), F.sum("rows")
    ).first()
    facts = totals.select("__name", F.col("source_size").alias("__whole"), F.col("target").alias("__target"), F.col("budget").alias("__budget"))
    return facts, n_sources, name_bytes or 0, n_rows or 0


def _taken(rows: DataFrame, facts: DataFrame, n_sources: int, name_bytes: int, n_rows: int, ties: list[str]) -> DataFrame:
    """``rows`` (of :func:`_keyed`, with any other columns) plus ``__taken`` and ``__copies``."""
    ordered = prefix_sums(rows, ["__name"], "__key", ["__id", "__size", *ties], F.col("__size"), "__upto", n_rows)
    side = bounded(facts, n_sources, name_bytes + 64 * n_sources)
    joined = ordered.join(side, "__name") if side is not facts else salted_join(ordered, facts, ["__name"], F.col("__key"))
    size, whole = F.col("__size"), F.col("__whole")
    epochs = F.when(whole > 0, F.floor(F.col("__budget") / whole)).otherwise(0)
    rest = F.col("__budget") - epochs * whole
    part = F.greatest(F.lit(0), F.least(size, rest - F.col("__upto")))
    taken = (epochs * size + part).cast("long")
    copies = F.when(size > 0, F.floor((2 * taken + size) / (2 * size))).otherwise(0).cast("int")
    return joined.withColumns({"__taken": taken, "__copies": copies})


def mix(docs: DataFrame, weights=WEIGHTS, cap: int = MOST_EPOCHS, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", seed: str = "mix") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, source, size, source_size,
    target, taken, copies``.

    ``size`` is the number of words; sources share all words by weight, at
    most ``cap`` times their own size, the excess going to the others.
    ``taken`` is how many of the document's words the mix takes over all
    epochs: sums over a source are its target's whole part exactly (the
    document at the cut gives only its first words); ``copies`` rounds that
    to whole documents.  A null source is a source of its own, after all
    others; null and empty texts have size 0 and are never taken; rows
    that share an id, or have none, are told apart by their texts and taken
    one by one; an empty table gives an empty result.  Reruns agree: nothing
    depends on the order of the input.
    """
    rows = written(_keyed(docs, id_col, text_col, source_col, seed).select(*_PLAN))
    planned = _taken(rows, *_facts(rows, weights, cap), [])
    return planned.select(
        F.col("__id").alias("doc_id"), F.col("__source").alias("source"), F.col("__size").alias("size"),
        F.col("__whole").alias("source_size"), F.col("__target").alias("target"), F.col("__taken").alias("taken"),
        F.col("__copies").alias("copies"),
    )


def mixed_documents(docs: DataFrame, weights=WEIGHTS, cap: int = MOST_EPOCHS, id_col: str = "doc_id", text_col: str = "text",
                    source_col: str = "source", seed: str = "mix") -> DataFrame:
    """The mix itself: ``docs`` with every row as often as its ``copies``.

    The rows travel through the plan themselves, so ids may be null or
    repeat: each row gets its own copies, and the copies of a source hold
    its budget to within half of the document at the cut.  Texts move once,
    by hash ranges within their source.  Null and empty texts are never
    taken; of rows alike in id and text the order of a hash of their other
    columns decides; an empty table gives an empty result.
    """
    columns = docs.columns
    keyed = _keyed(docs, id_col, text_col, source_col, seed)
    facts = _facts(written(keyed.select(*_PLAN)), weights, cap)
    others = [F.col(f"`{c}`") for c in columns if c != text_col]
    keyed = keyed.withColumn("__other", F.xxhash64(F.to_json(F.struct(*others))))
    planned = _taken(keyed, *facts, ["__other"])
    return planned.where("__copies > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1), "__copies"))).select(
        *[F.col(f"`{c}`") for c in columns])
