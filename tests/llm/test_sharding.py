"""Shards: even bytes, copies together, gapless slots."""

import random
import zlib

from arborist.llm import sharding


def corpus(seed, n=600, groups=40, largest=8):
    rnd = random.Random(seed)
    rows = [f"text {i} " + "x" * rnd.randint(0, 400) for i in range(n)]
    for g in range(groups):
        rows += [f"copy {g} " + "y" * rnd.randint(0, 400)] * rnd.randint(2, largest)
    rnd.shuffle(rows)
    return list(enumerate(rows))


def check(rows, got, shards=8):
    want = sorted((str(d), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows)
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in got) == want
    assert all(r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < shards for r in got)
    loads = [0] * shards
    for s in range(shards):
        mine = [r for r in got if r["shard"] == s]
        assert sorted(r["slot"] for r in mine) == list(range(len(mine)))
        loads[s] = sum(r["size"] for r in mine)
    largest = max((r["size"] for r in got), default=0)
    assert max(loads) - min(loads) <= 3 * largest
    return loads


def shards_of(got):
    out = {}
    for r in got:
        out.setdefault((r["text_crc32"], r["size"]), []).append(r["shard"])
    return {k: v for k, v in out.items() if len(v) > 1}


def test_even_and_together(docs_of, with_clashes):
    rows = corpus(1) + [(None, "null id"), (7000, None), (7001, None), (7002, ""), (7003, "")]
    got = sharding.shard_documents(with_clashes(docs_of(rows))).collect()
    check(rows, got)
    copies = {k: v for k, v in shards_of(got).items() if k[0]}
    assert len(copies) == 40 and all(len(set(v)) == 1 for v in copies.values())


def test_group_larger_than_a_shard_is_split_over_few(docs_of):
    rows = corpus(2, n=400, groups=10) + [(10_000 + i, "the same " * 30) for i in range(400)]
    got = sharding.shard_documents(docs_of(rows)).collect()
    check(rows, got)
    hot = max(shards_of(got).values(), key=len)
    total = sum(r["size"] for r in got)
    least = -(-400 * 271 * 8 // total)  # shards it needs
    assert len(hot) == 400 and len(set(hot)) <= least + 2


def test_all_alike_and_empty(docs_of, empty):
    rows = [(i, "same") for i in range(80)]
    loads = check(rows, sharding.shard_documents(docs_of(rows)).collect())
    assert max(loads) - min(loads) <= 15
    assert sharding.shard_documents(empty).collect() == []
    assert sharding.sharded_documents(empty).collect() == []


def test_columns_stay(docs_of, with_clashes):
    rows = corpus(3, n=60, groups=5) + [(5, "again"), (5, "again"), (None, None)]
    docs = docs_of(rows).withColumnRenamed("n_chars", "size")
    got = sharding.sharded_documents(docs)
    assert got.columns == [*docs.columns, "shard", "slot"]
    assert sorted((str(r["doc_id"]), str(r["text"])) for r in got.collect()) == sorted((str(d), str(t)) for d, t in rows)
    assert sharding.sharded_documents(with_clashes(docs_of(rows))).count() == len(rows)


def test_equal_rows_take_their_places_in_turn(docs_of):
    rows = corpus(4, n=100, groups=3) + [(1, "the same row")] * 700 + [(None, None)] * 90
    got = sharding.sharded_documents(docs_of(rows).repartition(6)).collect()
    assert sorted((str(r["doc_id"]), str(r["text"])) for r in got) == sorted((str(d), str(t)) for d, t in rows)
    for s in range(8):
        mine = [r["slot"] for r in got if r["shard"] == s]
        assert sorted(mine) == list(range(len(mine)))


def test_columns_of_the_same_name_are_kept(docs_of):
    from pyspark.sql import functions as F

    docs = docs_of([(i, f"text {i}") for i in range(20)]).withColumn("shard", F.lit("mine")).withColumn("input_shard", F.lit("too"))
    got = sharding.sharded_documents(docs)
    assert got.columns == [*docs.columns[:-2], "input_input_shard", "input_shard", "shard", "slot"]
    assert {(r["input_input_shard"], r["input_shard"]) for r in got.collect()} == {("mine", "too")}


def test_every_round_cuts_fewer_edges(spark):
    # Also a link that holds a third of all linked documents and fits no shard; half of all have no link.
    rnd = random.Random(6)
    sizes = {f"link {i}": rnd.randint(2, 60) for i in range(80)} | {"hot": 1200}
    docs = [(link, 100, rnd.randrange(8)) for link, n in sizes.items() for _ in range(n)]
    parcels = spark.createDataFrame(docs, "link string, size long, shard int").groupBy("link", "size", "shard").count()
    parcels = parcels.withColumnRenamed("count", "n").cache()
    capacity = 2 * 100 * len(docs) / 8

    def cut(rounds):
        out = sharding.propagate(parcels, capacity, 8, rounds)
        edges, cut = sharding.cut_edges(out).first()
        held = {}
        for r in out.collect():
            held.setdefault(r["link"], {}).setdefault(r["shard"], 0)
            held[r["link"]][r["shard"]] += r["n"]
        assert {link: sum(h.values()) for link, h in held.items()} == sizes
        assert edges == sum(n * (n - 1) // 2 for n in sizes.values())
        assert cut == edges - sum(n * (n - 1) // 2 for h in held.values() for n in h.values())
        return cut

    cuts = [cut(rounds) for rounds in (0, 1, 3, 12)]
    # The hot link needs two shards: with one of them full, this many of its edges must be cut.
    fits = int(capacity // 100)
    least = fits * (sizes["hot"] - fits)
    assert all(later < sooner for sooner, later in zip(cuts, cuts[1:])) and least <= cuts[-1] < 2 * least
    assert tuple(sharding.cut_edges(parcels.where("false")).first()) == (0, 0)
