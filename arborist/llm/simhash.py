"""SimHash near-duplicates by pigeonhole blocks.

Fingerprints are cut into ``distance + BLOCKS_KEPT`` blocks.  Two that differ in at
most ``distance`` bits leave at least ``BLOCKS_KEPT`` blocks untouched, so they
share one of the keys made of that many blocks; candidates come from a join on the keys and
every link is verified by its Hamming distance.  The number of blocks
only sets how many unrelated fingerprints meet, never the result.

Equal fingerprints are one node.  Within a key, members are first linked
to a hub (the most frequent fingerprint), then the members that are too
far from it to a second one; after components of these stars, only pairs
of the same key in different components are still compared.  So a group
of n close copies yields about n links, not n * n, and no link between
components is lost.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded, connected_components, partitions, row_key, salted_join, written

SEED = 42
# Blocks that a key is made of.  Three of seven blocks are 27 bits or more: few chance meetings.
BLOCKS_KEPT = 3
_CHUNK = 1 << 16


def simhash64(data: bytes, width: int) -> int:
    """Fingerprint of a whole UTF-8 text: A-Z lower-cased, words split at
    ASCII white space, ``width``-word shingles with repeats, XXH64; a bit is
    set if it is set in over half the hashes.  No words: 0."""
    words = data.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= width:
        return xxhash.xxh64_intdigest(joined, SEED)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - width + 1]
    ends = ends[width - 1 :]
    del words
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for lo in range(0, len(starts), _CHUNK):
        span = zip(starts[lo : lo + _CHUNK].tolist(), ends[lo : lo + _CHUNK].tolist())
        hashes = np.array([digest(joined[s:e], SEED) for s, e in span], np.dtype("<u8"))
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (2 * ones > len(starts)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fp)``: one row per row of ``docs``; null texts have no words."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary())
            out = np.fromiter((simhash64(t.as_py() or b"", width) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out.view(np.int64))], ["doc_id", "fp"])

    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return slim.mapInArrow(run, f"doc_id {kind}, fp long")


def block_masks(distance: int) -> list[int]:
    """Signed 64-bit masks of all keys: every choice of BLOCKS_KEPT blocks."""
    blocks = distance + BLOCKS_KEPT
    edges = [64 * i // blocks for i in range(blocks + 1)]
    parts = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    masks = [sum(c) for c in itertools.combinations(parts, BLOCKS_KEPT)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _near(a: str, b: str, distance: int):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= distance


def link_fingerprints(nodes: DataFrame, distance: int, n_nodes: int) -> DataFrame:
    """``(fp, root)`` for every fingerprint with a link, from ``n_nodes`` distinct
    ``nodes (fp, n)``; ``n`` is how many documents have it."""
    spark = nodes.sparkSession
    keys = F.array(*[
        F.struct(F.lit(i).alias("part"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
        for i, m in enumerate(block_masks(distance))
    ])
    members = nodes.select("fp", "n", F.inline(keys)).repartition(partitions(spark), "part", "key")
    hubs = (
        members.groupBy("part", "key")
        .agg(F.max(F.struct("n", "fp"))["fp"].alias("hub"), F.count(F.lit(1)).alias("size"))
        .where("size > 1")
    )
    # Both sides have the exchange above: it runs once.
    met = written(members.join(hubs, ["part", "key"]).withColumn("near", _near("fp", "hub", distance)))
    far = met.where(~F.col("near")).select("part", "key", "fp", "n")
    second = far.groupBy("part", "key").agg(F.max(F.struct("n", "fp"))["fp"].alias("hub2"))
    stars = met.where("near AND fp <> hub").select(F.col("fp").alias("u"), F.col("hub").alias("v"))
    more = (
        met.join(second, ["part", "key"])
        .where(_near("fp", "hub2", distance) & (F.col("fp") != F.col("hub2")))
        .select(F.col("fp").alias("u"), F.col("hub2").alias("v"))
    )
    first = written(connected_components(stars.union(more)), n_nodes)

    # What the stars left open: members of one key in different components.  A
    # key's largest component is not compared with itself: only the members
    # outside it meet the others, so one far member costs one comparison for
    # each close one.
    open_keys = met.where(~F.col("near")).select("part", "key").distinct()
    labelled = (
        met.join(open_keys, ["part", "key"], "left_semi")
        .select("part", "key", "fp")
        .join(first.select(F.col("node").alias("fp"), "root"), "fp", "left")
        .select("part", "key", "fp", F.coalesce("root", "fp").alias("root"))
    )
    labelled = written(labelled)
    sizes = labelled.groupBy("part", "key", "root").agg(F.count(F.lit(1)).alias("size"))
    largest = sizes.groupBy("part", "key").agg(F.max(F.struct("size", "root"))["root"].alias("largest"), F.count(F.lit(1)).alias("roots"))
    largest = written(largest.where("roots > 1").select("part", "key", "largest"))
    several = salted_join(labelled, largest, ["part", "key"], F.xxhash64("fp"))
    outside = several.where("root <> largest").select("part", "key", F.col("fp").alias("fp2"), F.col("root").alias("root2"))
    across = (
        salted_join(several, outside, ["part", "key"], F.xxhash64("fp"))
        .where((F.col("root") != F.col("root2")) & _near("fp", "fp2", distance))
        .select(F.col("root").alias("u"), F.col("root2").alias("v"))
        .distinct()
    )
    merged = written(connected_components(across), n_nodes)
    roots = first.select(F.col("node").alias("fp"), F.col("root").alias("r")).join(
        merged.select(F.col("node").alias("r"), F.col("root").alias("r2")), "r", "left"
    ).select("fp", F.coalesce("r2", "r").alias("root"))
    alone = merged.join(first.select("node"), "node", "left_anti")  # linked only across
    return roots.union(alone.select(F.col("node").alias("fp"), "root"))


def near_duplicates(docs: DataFrame, width: int = 4, distance: int = 4, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``(doc_id, fp, component_id)``: one row per row of ``docs``.

    ``component_id`` is the smallest id among all rows reachable by links
    of at most ``distance`` bits.  Null and empty texts have the
    fingerprint 0 and link like any other; null ids are ignored for the
    smallest id (null only if the component has no other id); repeated
    rows are rows of one component; an empty table gives an empty result.
    Columns other than the two named are not read.
    """
    fps = written(fingerprints(docs, width, id_col, text_col))
    nodes = written(fps.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")))
    n_nodes = nodes.count()
    linked = written(link_fingerprints(nodes.select("fp", "n"), distance, n_nodes), n_nodes)
    rooted = nodes.join(linked, "fp", "left").select("fp", "least", "n", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    # A component may hold most fingerprints and a fingerprint most documents: both joins are salted.
    named = salted_join(rooted, least, ["root"], F.xxhash64("fp"))
    named = written(named.select("fp", "component_id", "n"), n_nodes)
    return _by_fingerprint(fps, named)


def _by_fingerprint(fps: DataFrame, named: DataFrame) -> DataFrame:
    """Fingerprints that hold over a thousandth of all documents, so fewer
    than 1000, are joined by broadcast; the others are spread enough."""
    total = named.agg(F.sum("n")).first()[0] or 0
    named = named.withColumn("hot", F.col("n") * 1000 > total)
    hot = F.broadcast(named.where("hot").select("fp", "component_id"))
    rest = fps.join(F.broadcast(named.where("hot").select("fp")), "fp", "left_anti")
    light = rest.join(named.where(~F.col("hot")).select("fp", "component_id"), "fp")
    return fps.join(hot, "fp").union(light).select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, width: int = 4, distance: int = 4) -> DataFrame:
    """``docs`` with one row of each component: the row of its smallest id,
    nulls last, then the least by a hash of all columns (equal rows: one).
    Rows count for themselves: that an id is null or stands elsewhere too is no link."""
    keyed = docs.select("doc_id", "text", row_key(docs).alias("__row"))
    fps = written(fingerprints(keyed.select(F.struct("doc_id", "__row").alias("doc_id"), "text"), width))
    rows = fps.groupBy("fp", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    place = F.struct(F.col("doc_id.doc_id").isNull().alias("last"), "doc_id.doc_id", "doc_id.__row", "n")
    nodes = written(rows.groupBy("fp").agg(F.min(place).alias("least"), F.sum("n").alias("n")))
    n_nodes = nodes.count()
    linked = written(link_fingerprints(nodes.select("fp", "n"), distance, n_nodes), n_nodes)
    rooted = nodes.select("fp", "least").join(linked, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("least").alias("least"))
    kept = written(least.select(F.col("least.__row").alias("__kept"), F.col("least.n").alias("__n")), n_nodes)
    named = docs.withColumn("__row", row_key(docs))

    def rows_of(keys: DataFrame) -> DataFrame:
        n = keys.count()
        return named.join(bounded(keys, n, 48 * n), named["__row"] == keys["__kept"], "left_semi")

    out = rows_of(kept.where("__n = 1"))
    repeated = kept.where("__n > 1")
    return (out if repeated.isEmpty() else out.union(rows_of(repeated).dropDuplicates(["__row"]))).drop("__row")
