from arborist import TreeSettings, fit
from arborist.streaming.scoring import score_stream


def test_stream_scoring_matches_batch(spark, tmp_path):
    src = tmp_path / "src"
    rows = [(i, float(i % 20), "lo" if i % 20 < 8 else "hi") for i in range(400)]
    df = spark.createDataFrame(rows, "id long, n double, y string")
    df.write.parquet(str(src))
    model = fit(df, "y", ["n"], TreeSettings(max_depth=2))
    stream = spark.readStream.schema(df.schema).parquet(str(src))
    q = (
        score_stream(model, stream)
        .writeStream.format("memory")
        .queryName("scored_stream")
        .option("checkpointLocation", str(tmp_path / "ckpt"))
        .start()
    )
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = {(r["id"], r["PREDICTED_LABEL"]) for r in spark.sql("SELECT * FROM scored_stream").collect()}
    want = {(r["id"], r["PREDICTED_LABEL"]) for r in model.predict(df).collect()}
    assert got == want and len(got) == 400
