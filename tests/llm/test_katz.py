"""Katz backoff against the definitions, and that chances add up to 1."""

import random

import katz_brute
import pytest
from pyspark.sql import functions as F

from arborist.llm import common, katz


def corpus(seed, n=60):
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choices("abcd", k=rnd.randint(1, 4))) for _ in range(80)]
    weights = [1 / (i + 1) for i in range(80)]
    return [" ".join(rnd.choices(vocabulary, weights, k=rnd.randint(0, 60))) for _ in range(n)]


def check(spark, rows, held, monkeypatch, tokens=200, order=2, bucket_bytes=1000):
    monkeypatch.setattr(katz, "CHUNK_TOKENS", tokens)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("clash"))
    out = katz.score_documents(df, F.col("doc_id").isin(list(held)), order=order, bucket_bytes=bucket_bytes).collect()
    train = [t for d, t in rows if d not in held]
    want, _ = katz_brute.score(train, [t for _, t in rows], order)
    total = sum(len(katz_brute.tokens(t)) for t in train)
    got = sorted((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"],
                  round(r["base_score"], 7), round(r["score"], 7)) for r in out)
    assert got == sorted((d, d in held, len(katz_brute.tokens(t)), k, total, round(b, 7) + 0.0, round(s, 7) + 0.0)
                         for (d, t), (k, b, s) in zip(rows, want))


@pytest.mark.parametrize("seed, order", [(1, 2), (2, 2), (1, 1), (1, 3), (2, 4)])
def test_scores_match_brute_force(spark, seed, order, monkeypatch):
    texts = corpus(seed)
    rows = list(enumerate(texts)) + [(100, None), (101, ""), (102, " \n"), (103, texts[0]), (103, texts[0]),
                                     (104, "Never SEEN words"), (105, "a " * 500)]
    check(spark, rows, {0, 5, 9, 104}, monkeypatch, order=order)


@pytest.mark.parametrize("order", [2, 3])
def test_hot_context_is_split(spark, order, monkeypatch):
    # One word before a third of all words: its pairs lie in several buckets and still add up.
    rnd = random.Random(8)
    rows = [(i, " ".join(w for _ in range(40) for w in ("hot", f"w{rnd.randrange(30)}", f"x{rnd.randrange(9)}"))) for i in range(20)]
    check(spark, rows, {3}, monkeypatch, tokens=300, order=order, bucket_bytes=400)


def test_a_bucket_does_not_grow_with_the_corpus(spark, monkeypatch):
    # Six times the text: six times the buckets, none of them larger than before.
    largest, plain = [], katz._grouped

    def measured(df, key, groups):
        if key == "bucket":
            sizes = df.groupBy("bucket").agg(F.sum(F.length("blob")).alias("n"))
            largest.append(sizes.agg(F.max("n")).first()[0])
        return plain(df, key, groups)

    monkeypatch.setattr(katz, "CHUNK_TOKENS", 10_000)
    monkeypatch.setattr(katz, "_grouped", measured)
    for times in (1, 6):
        rnd = random.Random(times)
        rows = [(i, " ".join(f"w{rnd.randrange(2000)}" for _ in range(100))) for i in range(600 * times)]
        katz.score_documents(spark.createDataFrame(rows, "doc_id long, text string"), F.lit(False), bucket_bytes=50_000)
    words, pairs, more_words, more_pairs = largest
    assert more_words < 2 * words and more_pairs < 2 * pairs


def test_nothing_to_learn_from(spark, monkeypatch):
    rows = [(1, "some words"), (2, "")]
    monkeypatch.setattr(katz, "CHUNK_TOKENS", 100)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = katz.score_documents(df, F.lit(True)).collect()
    assert {(r["doc_id"], r["n_known"], r["train_tokens"], r["score"]) for r in out} == {(1, 0, 0, 0.0), (2, 0, 0, 0.0)}
    assert katz.score_documents(df.where("false"), F.lit(False)).collect() == []


@pytest.mark.parametrize("order", [2, 3])
def test_chances_after_every_context_add_up_to_one(order):
    _, (uni, grams, p, unknown) = katz_brute.score(corpus(5), [], order)
    assert abs(sum(p((), w) for w in uni) + unknown - 1) < 1e-9
    for contexts in grams.values():
        for context in contexts:
            assert abs(sum(p(context, w) for w in uni) + p(context, b"never seen") - 1) < 1e-9


def test_packing_round_trip():
    import numpy as np

    arrays = [np.array([], np.uint64), np.arange(5, dtype=np.uint16), np.array([2**63], np.uint64), np.array([True, False])]
    back = common.unpack(common.pack(*arrays, [1, None]))
    assert all((a == b).all() and a.dtype == b.dtype for a, b in zip(arrays, back)) and back[-1] == [1, None]
