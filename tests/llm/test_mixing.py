"""Targets, exact cuts and epochs of the mix."""

import random
import re

import pytest

from arborist.llm import common, mixing


def brute_targets(sizes, weights=(5, 2, 1), cap=3):
    """Targets by reshares in the order of code points, null last."""
    names = sorted((n for n in sizes if n is not None)) + [None] * (None in sizes)
    weight = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    target, capped = {}, set()
    while True:
        free = [n for n in names if n not in capped]
        rest = sum(sizes.values()) - sum(cap * sizes[n] for n in capped)
        total = sum(weight[n] for n in free)
        target = {n: cap * sizes[n] if n in capped else rest * weight[n] / total for n in names}
        over = {n for n in free if target[n] > cap * sizes[n]}
        if not over:
            return target
        capped |= over


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def corpus(seed, sources):
    rnd = random.Random(seed)
    return [(i, " ".join("w" for _ in range(rnd.choice([0, 1, 5, 40, 300]))), rnd.choice(sources)) for i in range(250)]


@pytest.mark.parametrize("seed,sources", [(1, ["a", "b", "c"]), (2, ["a"] * 20 + ["é", "Z", "zz", None]), (3, ["only"])])
@pytest.mark.parametrize("bin_rows", [20, 10_000])
def test_sums_meet_the_budgets(docs_of, with_clashes, monkeypatch, seed, sources, bin_rows):
    original = common.prefix_sums
    monkeypatch.setattr(mixing, "prefix_sums", lambda *a, **k: original(*a, **k, rows_per_bin=bin_rows))
    rows = corpus(seed, sources) + [(1000, None, sources[0]), (1001, " a\tb\x0bc\u00a0d ", sources[0])]
    got = mixing.mix(with_clashes(docs_of(rows))).collect()
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + words(t)
    want = brute_targets(sizes)
    assert {r["doc_id"]: r["size"] for r in got} == {d: words(t) for d, t, _ in rows}
    for s in sizes:
        mine = [r for r in got if r["source"] == s]
        assert all(r["source_size"] == sizes[s] and abs(r["target"] - want[s]) < 1e-6 * max(1, want[s]) for r in mine)
        assert abs(sum(r["taken"] for r in mine) - want[s]) <= 1
        rounds = [r["taken"] / r["size"] for r in mine if r["size"]]
        assert not rounds or (max(rounds) <= 3 and max(rounds) - min(rounds) <= 1)
        assert sum(x % 1 > 0 for x in rounds) <= 1  # one document at the cut
    again = mixing.mix(docs_of(rows[::-1]).repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_repeated_ids_and_empty_table(docs_of, empty):
    rows = [(1, "a b c", "s")] * 4 + [(None, "a b", "s"), (2, "", "t"), (3, None, None)]
    got = mixing.mix(docs_of(rows)).collect()
    assert len(got) == 7 and sum(r["taken"] for r in got) == 14
    assert mixing.mix(empty).collect() == []
    assert mixing.mixed_documents(empty).collect() == []


def test_documents_come_as_often_as_taken(docs_of, with_clashes):
    docs = with_clashes(docs_of(corpus(5, ["a"] * 9 + ["b"])))
    plan = {r["doc_id"]: r["copies"] for r in mixing.mix(docs).collect()}
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    got = {}
    for r in out.collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + 1
    assert got == {d: n for d, n in plan.items() if n}


def test_prefix_sums_of_a_hot_group(spark):
    from pyspark.sql import functions as F

    rows = [(g, i, i % 7) for g, n in (("hot", 3000), ("cold", 3)) for i in range(n)]
    df = spark.createDataFrame(rows, "g string, i long, v long").withColumn("key", F.xxhash64("g", "i"))
    out = common.prefix_sums(df, ["g"], "key", ["i"], F.col("v"), "before", 3003, rows_per_bin=1).collect()
    for g in ("hot", "cold"):
        mine = sorted((r for r in out if r["g"] == g), key=lambda r: r["key"] % (1 << 64))
        total = 0
        for r in mine:
            assert r["before"] == total
            total += r["v"]


def test_budgets_hold_without_ids(docs_of, monkeypatch):
    """Null and repeated ids: every row gets its own copies."""
    original = common.prefix_sums
    monkeypatch.setattr(mixing, "prefix_sums", lambda *a, **k: original(*a, **k, rows_per_bin=50))
    rnd = random.Random(9)
    rows = [(None, f"word{i} " * rnd.randint(1, 9), "ab"[i % 2]) for i in range(1_500)]
    rows += [(7, f"other{i} one two", "a") for i in range(200)] + [(8, "the very same", "b")] * 150
    docs = docs_of(rows)
    plan = mixing.mix(docs).collect()
    budget = {r["source"]: round(r["target"]) for r in plan}
    for s in "ab":
        assert abs(sum(r["taken"] for r in plan if r["source"] == s) - budget[s]) <= 1
    out = mixing.mixed_documents(docs).collect()
    held = {s: sum(words(r["text"]) for r in out if r["source"] == s) for s in "ab"}
    assert all(abs(held[s] - budget[s]) <= 9 for s in "ab")
    assert len(out) == sum(r["copies"] for r in plan)
    keys = mixing._keyed(docs, "doc_id", "text", "source", "mix")
    assert keys.select("__key").distinct().count() == len({(d, t) for d, t, _ in rows})
