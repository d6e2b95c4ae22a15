"""Importance resampling against a plain version; ranks by regular sampling against a sort."""

import hashlib
import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from arborist.llm import resampling


def brute(docs, target, percent=10, least=20, buckets=10_000, longest=1):
    word = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    lower = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})

    def features(text):
        w = word.findall((text or "").translate(lower))
        return w, [" ".join(w[i : i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]

    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = [0] * buckets, [0] * buckets
    for _, text in docs:
        for f in features(text)[1]:
            s[bucket(f)] += 1
    for text in target:
        for f in features(text)[1]:
            t[bucket(f)] += 1
    S, T = sum(s), sum(t)
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets)))) for b in range(buckets)]
    out = []
    for doc_id, text in docs:
        w, f = features(text)
        weight = sum(gain[bucket(x)] for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, len(w), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None])
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[3], r[2]))
    for rank, r in enumerate(able[: len(able) * percent // 100], 1):
        r[5] = rank
    return sorted(map(tuple, out), key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "n_features", "weight", "score", "rank").collect()), key=repr)


@pytest.fixture
def corpus():
    rnd = random.Random(3)
    vocabulary = ["Alpha", "béta", "gam-ma", "d3lta", "ÉPSILON", "zeta", "ETA", "the", "of"] + [f"w{i}" for i in range(200)]
    text = lambda n: " ".join(rnd.choices(vocabulary, k=n))
    docs = [(i, text(rnd.randint(0, 60))) for i in range(400)]
    docs += [(500, None), (501, ""), (502, "..."), (503, text(30_000)), (None, text(40)), (None, text(50)), (7, text(45))]
    docs += [(600, "the of zeta " * 10)] * 30  # equal rows
    return docs, [text(25) for _ in range(10)] + [None, ""]


@pytest.mark.parametrize("longest", [1, 3])
def test_equals_the_plain_version(spark, docs_of, with_clashes, corpus, longest):
    docs, target = corpus
    items = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    got = resampling.resample(with_clashes(docs_of(docs)).repartition(5), with_clashes(items), longest=longest)
    assert found(got) == brute(docs, target, longest=longest)


def test_empty_tables(spark, docs_of, empty, corpus):
    items = spark.createDataFrame([], "item_id long, text string")
    assert resampling.resample(empty, items).count() == 0
    docs = corpus[0][:50]
    assert found(resampling.resample(docs_of(docs), items)) == brute(docs, [])


def test_text_ids(spark):
    docs = spark.createDataFrame([(f"d{i}", "some words here " * 8) for i in range(40)], "doc_id string, text string")
    rows = resampling.resample(docs, docs.where("false")).where("rank IS NOT NULL").collect()
    assert sorted(r["rank"] for r in rows) == [1, 2, 3, 4]


@pytest.mark.parametrize("hot", [False, True])
def test_ranks_over_many_segments(spark, hot):
    key = F.when(F.col("id") % 3 > 0, F.lit(5)).otherwise(F.xxhash64("id") % 1000) if hot else F.xxhash64("id")
    rows = spark.range(30_000, numPartitions=7).select(key.alias("k"), F.when(F.col("id") % 11 > 0, F.col("id") % 50).alias("v"))
    out = resampling.ranked(rows, ["k", "v"], segment_rows=500)
    got = sorted((r["rank"], r["k"], r["v"]) for r in out.select("rank", "k", F.coalesce("v", F.lit(99)).alias("v")).collect())
    assert [r[0] for r in got] == list(range(1, 30_001))
    assert [r[1:] for r in got] == sorted(r[1:] for r in got)


def test_segments_stay_even(spark):
    rows = spark.range(40_000, numPartitions=8).select(F.lit(1).alias("k"))  # all rows equal
    runs = rows.sortWithinPartitions("k").withColumn("__place", F.monotonically_increasing_id())
    cuts = resampling._splitters(runs, ["k", "__place"], 40_000, 1_000)
    places = sorted(r[0] for r in runs.select("__place").collect())
    at = [0, *[sum(p < c[1] for p in places) for c in cuts], 40_000]
    assert len(cuts) == 39 and max(b - a for a, b in zip(at, at[1:])) <= 2_000
