"""Sharding by balanced label propagation under capacity quotas.

Documents that share a link value (by default: their text) are linked.
Each starts in the shard its hash names.  In every round a link's
documents move to the shard that already holds most of them, as far as
that shard's quota of bytes lasts; a link too big for one shard fills it
and gathers the rest in the next.  Linked documents of one link and shard
are interchangeable, so rounds work on parcels (link, shard, count): the
work is a join on the links, whatever their sizes.  Documents without a
link then fill every shard to the same size by prefix sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded, prefix_sums, salted_join, written

SHARDS = 8
ROUNDS = 12
LAW = "bytes"


def _uniform(*columns) -> Column:
    """Hash of the columns as a number in [0, 1)."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 30)) / F.lit(float(1 << 30))


def propagate(parcels: DataFrame, capacity: float, shards: int, rounds: int = ROUNDS) -> DataFrame:
    """Move ``parcels (link, size, shard, n)``: n documents of ``size`` bytes
    each.  Returns the same columns.  Only per-shard sums reach the driver.
    Moves need room, which documents without a link leave; if all are linked,
    and the shards full from the start, few can move (``cut_edges`` tells)."""
    parcels = written(parcels)
    for turn in range(rounds):
        loads = {r[0]: r[1] for r in parcels.groupBy("shard").agg(F.sum(F.col("n") * F.col("size"))).collect()}
        free = {s: max(0.0, capacity - loads.get(s, 0)) for s in range(shards)}
        open_ = [s for s in free if free[s] > 0]
        # The best shard of a link: most of its documents; ties by a hash, so that no shard is favoured.
        rank = F.struct("n", F.xxhash64("link", "shard").alias("tie"), "shard")
        best = parcels.where(F.col("shard").isin(open_)).groupBy("link").agg(F.max(rank).alias("best"))
        wish = (
            parcels.join(best, "link", "left")
            .withColumn("moves", F.col("best").isNotNull() & (rank < F.col("best")))
            .withColumn("to", F.when(F.col("moves"), F.col("best.shard")))
        )
        wish = written(wish.select("link", "size", "shard", "n", "to"))
        asked = wish.where("to IS NOT NULL").groupBy("to").agg(F.sum(F.col("n") * F.col("size"))).collect()
        share = {r[0]: min(1.0, free[r[0]] / r[1]) for r in asked if r[1]}
        if not any(share.values()):
            break
        quota = F.lit(0.0)
        for s, q in share.items():
            quota = F.when(F.col("to") == s, F.lit(q)).otherwise(quota)
        moved = F.least(F.col("n"), F.floor(F.col("n") * quota + _uniform("link", "shard", F.lit(turn))))
        split = wish.withColumn("moved", F.when(F.col("to").isNull(), 0).otherwise(moved).cast("long"))
        stay = split.select("link", "size", "shard", (F.col("n") - F.col("moved")).alias("n"))
        gone = split.where("moved > 0").select("link", "size", F.col("to").alias("shard"), F.col("moved").alias("n"))
        parcels = written(
            stay.union(gone).where("n > 0").groupBy("link", "size", "shard").agg(F.sum("n").alias("n"))
        )
    return parcels


def cut_edges(parcels: DataFrame) -> DataFrame:
    """One row ``edges, cut``: pairs of linked documents of ``parcels (link,
    shard, n)``, and those of them in different shards (0, 0 if empty).
    Counted from the parcels, no pair is made."""
    pairs = lambda n: (n.cast("decimal(38,0)") * (n - 1) / 2).cast("decimal(38,0)")
    held = parcels.groupBy("link", "shard").agg(F.sum("n").alias("n"))
    links = held.groupBy("link").agg(pairs(F.sum("n")).alias("all"), F.sum(pairs(F.col("n"))).alias("inside"))
    edges, inside = (F.coalesce(F.sum(c), F.lit(0)) for c in ("all", "inside"))
    return links.agg(edges.cast("long").alias("edges"), (edges - inside).cast("long").alias("cut"))


def shard_documents(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text",
                    link: Column | None = None) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, size, text_crc32, law, shard,
    slot, grown_shard``.

    ``size`` is the text's UTF-8 bytes (null: none) plus 1; shards differ in
    bytes by about the largest document (law ``bytes``).  ``link`` names
    what ties documents together (default: equal texts, so copies stay
    together); null texts have crc32 0 and no link.  ``slot`` counts 0, 1,
    ... within a shard.  Rows that repeat an id are placed one by one and an
    empty table gives an empty result.  Rows alike in id, size and text are
    interchangeable; apart from that reruns agree.
    """
    text = F.col(text_col)
    link = F.sha2(text, 256) if link is None else link
    rows = written(
        docs.select(
            F.col(id_col).alias("doc_id"),
            (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
            F.coalesce(F.crc32(text), F.lit(0)).alias("text_crc32"),
            link.cast("string").alias("link"),
        ).withColumn("key", F.xxhash64("doc_id", "text_crc32", "size"))
    )
    links = written(
        rows.where("link IS NOT NULL").groupBy("link").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("link")
    )
    linked = written(salted_join(rows, links, ["link"], F.col("key")).withColumn("start", F.pmod("key", F.lit(shards))))
    alone = rows.join(links, "link", "left_anti")
    total, count = rows.agg(F.sum("size"), F.count(F.lit(1))).first()
    capacity = (total or 0) / shards
    parcels = linked.groupBy("link", "size", F.col("start").cast("int").alias("shard")).agg(
        F.count(F.lit(1)).alias("n")
    )
    parcels = propagate(parcels, capacity, shards)

    # Parcels to documents: the documents of a link in hash order, shard after shard.
    upto = Window.partitionBy("link", "size").orderBy("shard")
    ends = (
        parcels.withColumn("end", F.sum("n").over(upto))
        .groupBy("link", "size")
        .agg(F.array_sort(F.collect_list(F.struct("end", "shard"))).alias("ends"))  # one entry per shard at most
    )
    ranked = prefix_sums(linked, ["link", "size"], "key", ["doc_id"], F.lit(1), "rank", count)
    placed = salted_join(ranked, ends, ["link", "size"], F.col("key"))
    columns = ["doc_id", "size", "text_crc32", "key"]
    placed = placed.select(
        *columns,
        F.filter("ends", lambda e: e["end"] > F.col("rank"))[0]["shard"].cast("int").alias("shard"),
        # Within a shard, links that are split anyway come last: they give way if it is too full.
        F.when(F.size("ends") > 1, F.shiftrightunsigned("key", 1).bitwiseOR(F.lit(-(1 << 63))))
        .otherwise(F.shiftrightunsigned("key", 1)).alias("order"),
    )
    upto = prefix_sums(placed, ["shard"], "order", ["doc_id"], F.col("size"), "upto", count)
    placed = written(upto.withColumn("stays", F.col("upto") + F.col("size") / 2 <= F.lit(capacity)))
    loads = {r[0]: r[1] for r in placed.where("stays").groupBy("shard").agg(F.sum("size")).collect()}

    # All other documents: cut their prefix sums where the shards are full.
    room = [max(0.0, capacity - loads.get(s, 0)) for s in range(shards)]
    scale = ((total or 0) - sum(loads.values())) / sum(room) if sum(room) else 0.0
    others = alone.select(*columns).union(placed.where("NOT stays").select(*columns)).withColumn("all", F.lit(1))
    filled = prefix_sums(others, ["all"], "key", ["doc_id"], F.col("size"), "before", count)
    middle = F.col("before") + F.col("size") / 2
    shard, edge = F.lit(shards - 1), scale * sum(room)
    for s in range(shards - 1, -1, -1):
        shard = F.when(middle < edge, F.lit(s)).otherwise(shard)
        edge -= scale * room[s]
    whole = written(
        placed.where("stays").select(*columns, "shard").union(filled.select(*columns, shard.cast("int").alias("shard")))
    )
    # Hashed anew: the shards above are ranges of the old hash.
    whole = whole.withColumn("key", F.xxhash64("key", F.lit("slot")))
    slots = prefix_sums(whole, ["shard"], "key", ["doc_id"], F.lit(1), "slot", count)
    return slots.select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _ranked(df: DataFrame, key: str) -> DataFrame:
    """Written ``df`` plus ``__rank`` from 0 among the rows of ``key``: positions
    within a task's share of a key and the shares' offsets, so that a key
    with most of the rows is not one task."""
    df = written(df.withColumn("__at", F.monotonically_increasing_id()))
    df = df.withColumn("__share", F.shiftright("__at", 33))
    shares = df.groupBy(key, "__share").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(key).orderBy("__share").rowsBetween(Window.unboundedPreceding, -1)
    shares = shares.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    inside = F.row_number().over(Window.partitionBy(key, "__share").orderBy("__at")) - 1
    ranked = df.withColumn("__inside", inside).join(shares, [key, "__share"])
    return ranked.withColumn("__rank", F.col("__inside") + F.col("__before")).drop("__at", "__share", "__inside", "__before")


def sharded_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``docs`` with ``shard`` and ``slot``.

    Rows alike in id and text take their places in turn: nothing that
    placed them differs.  Null ids and texts are placed like others and an
    empty table stays empty.  A column ``shard`` or ``slot`` of the input is
    returned as ``input_shard`` or ``input_slot`` (with more ``input_`` where
    that is taken, too).
    """
    names = {}
    for c in docs.columns:
        name = c
        while name in ("shard", "slot") or (name != c and name in docs.columns):
            name = f"input_{name}"
        names[c] = name
    keep = [F.col(f"`{c}`").alias(n) for c, n in names.items()]

    def key(*columns: Column) -> Column:
        return F.concat_ws(":", F.coalesce(columns[0].cast("string"), F.lit("")), *columns[1:])

    place = shard_documents(docs, shards)
    place = written(place.select(key(F.col("doc_id"), F.col("size"), F.col("text_crc32")).alias("__key"), "shard", "slot"))
    repeated = written(place.groupBy("__key").agg(F.count(F.lit(1)).alias("__n")).where("__n > 1"))
    n_keys, key_bytes = repeated.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("__key")), F.lit(0))).first()
    text = F.col("text")
    bytes_, crc = F.coalesce(F.octet_length(text), F.lit(0)) + 1, F.coalesce(F.crc32(text), F.lit(0))
    keyed = docs.withColumn("__key", key(F.col("doc_id"), bytes_.cast("long"), crc)).select(*keep, "__key")
    columns = [*[F.col(f"`{n}`") for n in names.values()], "shard", "slot"]
    if not n_keys:
        return keyed.join(place, "__key").select(*columns)
    side = bounded(repeated.select("__key"), n_keys, key_bytes + 16 * n_keys)
    single = keyed.join(side, "__key", "left_anti").join(place.join(side, "__key", "left_anti"), "__key")
    several = _ranked(keyed.join(side, "__key", "left_semi"), "__key")
    places = _ranked(place.join(side, "__key", "left_semi"), "__key")
    return single.select(*columns).union(several.join(places, ["__key", "__rank"]).select(*columns))
