"""The pipeline's stages on a fixture with planted cases."""

import random

import pytest

import corpus_pipeline
from arborist.llm import common


@pytest.fixture
def tables(spark, tmp_path):
    rnd = random.Random(1)
    word = lambda: "".join(rnd.choices(["the", "ing", "th", "er", "on", "an"], k=rnd.randint(1, 3)))
    prose = lambda n: [word() for _ in range(n)]
    items = [(i, " ".join(prose(20))) for i in range(5)]
    rows, labels, junk, leaks, groups = [], [], set(), set(), []
    for i in range(400):
        w = prose(rnd.randint(30, 120))
        good = i % 4 != 0
        if not good:
            w = [x + "%%%" for x in w]
            junk.add(i)
        elif i % 10 == 1:
            w[10:10] = items[i % 5][1].split()
            leaks.add(i)
        rows.append((i, " ".join(w)))
        labels.append((i, int(good), 0))
    for i in range(2, 22, 4):  # clean ones, copied
        groups.append({i, 1000 + i, 2000 + i})
        rows += [(1000 + i, rows[i][1]), (2000 + i, rows[i][1])]
    full = [(d, t, "en", "ab"[d % 3 == 0], len(t)) for d, t in rows] + [(9000, None, None, None, None), (9001, "", "en", "a", 0)]
    spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path), junk, leaks, groups


def test_stages_take_effect(spark, tables):
    sf_dir, junk, leaks, groups = tables
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "simhash", "decontamination", "mixing", "sharding"]
    docs = common.table(spark, sf_dir, "documents")
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        before = docs.columns
        docs = common.written(stage(spark, docs, sf_dir))
        if name != "sharding":
            assert docs.columns == before
        kept.append({r["doc_id"] for r in docs.select("doc_id").collect()})
    quality, simhash, clean, mixed, sharded = kept
    assert len(quality & junk) <= 0.03 * len(junk) and len(set(range(400)) - junk - quality) <= 6
    assert all(len(g & simhash) <= 1 and min(g) in simhash for g in groups if g & quality)
    assert not clean & leaks and simhash - clean == leaks & simhash
    assert mixed <= clean and sharded == mixed
    assert docs.count() >= len(mixed)


def test_run_agrees_with_itself(spark, tables):
    sf_dir = tables[0]
    one = sorted((r["doc_id"], r["shard"], r["slot"]) for r in corpus_pipeline.run(spark, sf_dir).collect())
    two = sorted((r["doc_id"], r["shard"], r["slot"]) for r in corpus_pipeline.run(spark, sf_dir).collect())
    assert one == two and one
