"""Benchmark decontamination: size-partitioned MinHash containment search.

An item with n distinct shingles is contained in a document if at least
``need = ceil(threshold * n)`` of them occur there.  Its sketch is its
``n - need + 1`` least shingle hashes: a document that has none of these
misses too many, so no contained item is lost, whatever the document's
length.  Items are partitioned by size (powers of two); each partition has
a ceiling, the greatest hash of its sketches, and a least document size.
Document hashes above every ceiling are dropped before they are joined,
and every candidate pair is verified by exact shingle containment on the
words themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, bounded, salted_join, written

SHINGLE = 5
THRESHOLD = 0.8


def words(text: Column) -> Column:
    """Lower-cased words; null and blank texts have none."""
    found = F.split(F.lower(F.coalesce(text, F.lit(""))), f"[{SPACE}]+")
    return F.filter(found, lambda w: w != "")


def _shingles(width: int) -> Column:
    """Distinct shingles of ``width`` words of the word array ``w``."""
    at = F.when(F.size("w") >= width, F.sequence(F.lit(1), F.size("w") - width + 1))
    return F.array_distinct(F.transform(at, lambda i: F.concat_ws(" ", F.slice(F.col("w"), i, width))))


def _hashes(width: int) -> Column:
    """Hash of every shingle of ``width`` words, from the array ``h`` of word hashes."""
    at = F.when(F.size("h") >= width, F.sequence(F.lit(0), F.size("h") - width))
    return F.transform(at, lambda i: F.xxhash64(*[F.col("h")[i + j] for j in range(width)]))


def _with_words(df: DataFrame, text: Column) -> DataFrame:
    return df.withColumn("w", words(text)).withColumn("h", F.transform("w", lambda x: F.xxhash64(x)))


def _sketches(items: DataFrame, width: int, threshold: float) -> DataFrame:
    """``(item, n, need, part, shingles, sketch)`` of the items with shingles of ``width`` words."""
    out = items.withColumn("shingles", _shingles(width)).withColumn("n", F.size("shingles"))
    # A whole number of shingles; the small part taken off keeps 0.8 * 5 at 4.
    out = out.withColumn("need", F.ceil(F.col("n") * F.lit(threshold) - F.lit(1e-9)).cast("int"))
    least = F.slice(F.array_sort(F.array_distinct(_hashes(width))), F.lit(1), F.col("n") - F.col("need") + 1)
    return out.select("item", "n", "need", F.floor(F.log2("n")).cast("int").alias("part"), "shingles", least.alias("sketch"))


def _below_ceiling(parts, width: int) -> Column:
    """Ceiling of a document: the greatest one of the partitions whose items it is long enough for."""
    ceiling = F.lit(None).cast("long")
    for p in parts:
        fits = F.size("h") - (width - 1) >= p["need"]
        ceiling = F.greatest(ceiling, F.when(fits, F.lit(p["ceiling"])))
    return ceiling


def contained_items(docs: DataFrame, items: DataFrame, width: int = SHINGLE, threshold: float = THRESHOLD,
                    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                    item_text_col: str = "text") -> DataFrame:
    """Pairs ``(doc_id, item_id, n_shingles, n_found)`` with at least
    ``threshold`` of the item's distinct shingles in the document.

    Words are lower-cased and split at ASCII white space; an item with
    fewer words than a shingle is one shingle, its whole word sequence.
    Items without words are in no document; null and empty documents hold
    no item, and documents shorter than a shingle only items that short.
    Texts decide, not ids: rows that share an id, or have none, are documents
    and items of their own, and a pair of ids has a row for each pair of
    texts behind it (rows alike in id and text count once).  Empty tables
    give an empty result; other columns are not read.
    """
    named = items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text"))
    named = written(named.withColumn("item", _text_key(F.col("text"))).where("item IS NOT NULL").dropDuplicates(["item_id", "item"]))
    items = written(_with_words(named.select("item", "text").dropDuplicates(["item"]), F.col("text")).where(F.size("w") > 0).drop("text"))
    text = F.col(text_col)
    slim = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), _text_key(text).alias("key"))
    # One pass for each shingle length that occurs: the usual one, and those of items shorter than it.
    lengths = [r[0] for r in items.select(F.least(F.size("w"), F.lit(width))).distinct().collect()]
    found = [_contained(slim.select("key", "text"), items, k, k == width, threshold) for k in sorted(lengths)]
    if not found:
        return slim.where("false").select(
            "doc_id", F.lit(None).cast(named.schema["item_id"].dataType).alias("item_id"),
            F.lit(0).cast("long").alias("n_shingles"), F.lit(0).cast("long").alias("n_found"),
        )
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.union(more)
    # From texts back to rows, on both sides.
    pairs = written(pairs)
    n_pairs = pairs.count()
    holding = pairs.join(named.select("item_id", "item"), "item")
    rows = slim.select("doc_id", "key")
    kept = written(pairs.select("key").distinct())
    n_kept = kept.count()
    rows = rows.join(bounded(kept, n_kept, 48 * n_kept), "key", "left_semi").distinct()
    side = bounded(holding, n_pairs, 160 * n_pairs) if named.count() <= n_pairs else holding
    joined = rows.join(side, "key") if side is not holding else salted_join(rows, holding, ["key"], F.xxhash64("doc_id"))
    return joined.select("doc_id", "item_id", "n_shingles", "n_found")


def _text_key(text: Column) -> Column:
    """SHA-256 of a text, 32 bytes; equal texts are one."""
    return F.unhex(F.sha2(text, 256))


def _contained(slim: DataFrame, items: DataFrame, width: int, longest: bool, threshold: float) -> DataFrame:
    mine = items.where(F.size("w") >= width if longest else F.size("w") == width)
    sketched = written(_sketches(mine, width, threshold))
    parts = sketched.groupBy("part").agg(
        F.min("need").alias("need"), F.max(F.element_at("sketch", -1)).alias("ceiling")
    ).collect()  # a row per power of two
    n_hashes, n_shingles, letters = sketched.agg(
        F.sum(F.size("sketch")), F.sum("n"), F.sum(F.octet_length(F.array_join("shingles", "")))
    ).first()
    probe = sketched.select(F.explode("sketch").alias("hash")).distinct()
    probe = bounded(probe, n_hashes, 16 * n_hashes)
    read = _with_words(slim, F.col("text")).select("key", "h").withColumn("most", _below_ceiling(parts, width))
    hits = read.where("most IS NOT NULL").select(
        "key", F.explode(F.filter(_hashes(width), lambda x: x <= F.col("most"))).alias("hash")
    )
    candidates = written(hits.join(probe, "hash", "left_semi").select("key").distinct())
    n = candidates.count()
    again = slim.join(bounded(candidates, n, 48 * n), "key", "left_semi")
    exact = _with_words(again, F.col("text")).select("key", F.explode(_shingles(width)).alias("shingle"))
    wanted = sketched.select("item", "n", "need", F.explode("shingles").alias("shingle"))
    side = bounded(wanted, n_shingles, letters + 48 * n_shingles)
    pairs = exact.join(side, "shingle") if side is not wanted else salted_join(exact, wanted, ["shingle"], F.xxhash64("key"))
    return (
        pairs.distinct()
        .groupBy("key", "item", "n", "need")
        .agg(F.count(F.lit(1)).alias("n_found"))
        .where("n_found >= need")
        .select("key", "item", F.col("n").cast("long").alias("n_shingles"), "n_found")
    )


def clean_documents(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows whose text holds an item, whatever their ids:
    a null or repeated id says nothing about a row.  Null and empty texts
    hold no item and stay; without items all rows stay, and an empty table
    stays empty."""
    text = F.col(options.get("text_col", "text"))
    keyed = docs.select(text.alias("text"), _text_key(text).alias("key"))
    options = {k: v for k, v in options.items() if k not in ("text_col", "id_col")}
    found = contained_items(keyed, items, **options, id_col="key")
    hold = written(found.select(F.col("doc_id").alias("__held")).distinct())
    n = hold.count()
    out = docs.withColumn("__row", _text_key(text))
    return out.join(bounded(hold, n, 48 * n), F.col("__row") == F.col("__held"), "left_anti").drop("__row")
