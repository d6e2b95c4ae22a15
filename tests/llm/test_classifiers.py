"""Language and quality: held-out accuracy and the edge cases."""

import random

from pyspark.sql import functions as F

from arborist.llm import language, quality

SYLLABLES = {"en": ["the", "ing", "th", "er", "on", "an"], "fr": ["é", "aux", "ou", "que", "ment", "è"],
             "de": ["sch", "ß", "ung", "ich", "ä", "pf"]}


def prose(rnd, lang, n):
    return " ".join("".join(rnd.choices(SYLLABLES[lang], k=rnd.randint(1, 4))) for _ in range(n))


def test_language_of_held_out_texts(spark, with_clashes):
    rnd = random.Random(1)
    rows = [(i, prose(rnd, lang, rnd.randint(5, 120)), lang) for i, lang in enumerate(random.Random(2).choices(list(SYLLABLES), k=500))]
    odd = [(900, None, "en"), (901, "", "en"), (902, "123 456 !!", "en"), (903, prose(rnd, "fr", 9).upper(), None),
           (904, prose(rnd, "de", 40_000), None), (None, prose(rnd, "en", 30), "en"), (905, "ж", None)]
    docs = with_clashes(spark.createDataFrame(rows + odd, "doc_id long, text string, lang string"))
    model = language.fit(docs.where(~language.held_out()))
    got = {r["doc_id"]: r for r in language.predict(docs, model).collect()}
    assert len(got) == len(rows) + len(odd)
    assert sum(got[i]["lang_pred"] == lang for i, _, lang in rows) >= 495
    for i in (900, 901, 902):
        assert (got[i]["lang_pred"], got[i]["score"], got[i]["rejected"]) == ("und", 0.0, True)
    assert got[903]["lang_pred"] == "fr" and got[904]["lang_pred"] == "de" and got[905]["rejected"]
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert len(model["names"]) == 3 * language.CENTROIDS


def test_language_without_anything_to_learn(spark):
    docs = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    model = language.fit(docs)
    assert [(r["lang_pred"], r["score"]) for r in language.predict(docs, model).collect()] == [("und", 0.0)]
    assert language.predict(docs.where("false"), model).collect() == []


def test_long_text_counts_like_one_piece(monkeypatch):
    text = prose(random.Random(3), "de", 300) + " 1,2"
    whole = language.gram_counts(text)
    monkeypatch.setattr(language, "_PIECE", 97)
    assert (language.gram_counts(text) == whole).all()


def junk(rnd, lang, n):
    return " ".join(w + rnd.choice(["%%%", "$$$", "###"]) for w in prose(rnd, lang, n).split())


def labelled(seed, n=600):
    rnd = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        good = rnd.random() < 0.7
        docs.append((i, (prose if good else junk)(rnd, rnd.choice(["en", "fr"]), rnd.randint(3, 200))))
        labels.append((i, int(good)))
    return docs, labels


def test_quality_of_held_out_texts(spark, docs_of, with_clashes):
    rows, marks = labelled(1)
    rnd = random.Random(9)
    odd = [(2000, None), (2001, ""), (2002, prose(rnd, "en", 30_000)), (2003, junk(rnd, "fr", 30_000)), (None, "the thing")]
    docs = with_clashes(docs_of(rows + odd + [rows[0]]))
    labels = spark.createDataFrame(marks + [(1, 7), (None, 1)], "doc_id long, quality int")
    model = quality.fit(docs.where(~quality.held_out()), labels)
    out = quality.score(docs, model).collect()
    got = {r["doc_id"]: r for r in out}
    assert len(out) == len(rows) + 6 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in out)
    assert sum(got[i]["predicted"] == q for i, q in marks) >= 0.95 * len(marks)
    assert got[2002]["predicted"] == 1 and got[2003]["predicted"] == 0
    assert got[2000]["score"] == got[2001]["score"]
    kept = quality.accepted(docs, model)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(r["doc_id"]) for r in out if r["predicted"])


def test_quality_without_both_labels(spark, docs_of):
    docs = docs_of([(1, "a b"), (2, None)])
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    assert {r["score"] for r in quality.score(docs, quality.fit(docs, labels)).collect()} == {1.0}
    none = quality.fit(docs, labels.where("false"))
    assert {r["score"] for r in quality.score(docs, none).collect()} == {0.5}
    assert quality.score(docs.where("false"), none).collect() == []
    assert docs.where(F.lit(True)).count() == 2


def test_every_block_of_a_text_counts():
    rnd = random.Random(4)
    good, bad = quality._compressors([quality._dictionary([prose(rnd, "en", 200).encode()]), quality._dictionary([junk(rnd, "en", 200).encode()])])
    clean = prose(rnd, "en", 500)
    assert quality.size_difference(clean.encode(), good, bad) > quality.size_difference((clean + junk(rnd, "en", 500)).encode(), good, bad)


def test_long_and_repeated_rows_leave_the_dictionaries_whole(spark, docs_of, monkeypatch):
    monkeypatch.setattr(quality, "SAMPLE_BYTES", 40_000)
    rnd = random.Random(6)
    rows, marks = labelled(6, 200)
    good = [i for i, q in marks if q]
    # Every good document is longer than the whole sample; a labelled id has a null text and another row too.
    rows = [(i, prose(rnd, "en", 9000) if q else t) for (i, t), (_, q) in zip(rows, marks)]
    extra = [(good[i], None) for i in range(8)] + [(good[0], prose(rnd, "fr", 50))]
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    model = quality.fit(docs_of(rows + extra), labels)
    assert min(map(len, model["dictionaries"])) > 1000
    fresh = [(1000 + i, (prose if i % 2 else junk)(rnd, "en", 80)) for i in range(40)]
    got = {r["doc_id"]: r["predicted"] for r in quality.score(docs_of(fresh), model).collect()}
    assert sum(got[1000 + i] == i % 2 for i in range(40)) >= 38


def test_a_rare_language_has_its_own_room(spark, monkeypatch):
    """Frequent languages with long texts leave a rare one its centroids."""
    import random

    monkeypatch.setattr(language, "SAMPLE_ROWS", 90)
    monkeypatch.setattr(language, "SAMPLE_BYTES", 60_000)
    rnd = random.Random(12)
    sets = {"aa": ["tha", "ing", "ther", "and"], "bb": ["ñor", "ción", "que", "los"], "cc": ["zwa", "üch", "sch", "ig"]}
    text = lambda k, n: " ".join("".join(rnd.choices(sets[k], k=2)) for _ in range(n))
    rows = [(i, text(k, 300), k) for i, k in enumerate(["aa", "bb"] * 400)] + [(5_000 + i, text("cc", 300), "cc") for i in range(12)]
    rows += [(9_000, text("aa", 60_000), "aa"), (None, text("bb", 50), "bb"), (None, text("cc", 50), "cc")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs)
    assert sorted(model["names"]) == sorted(["aa", "bb", "cc"] * language.CENTROIDS)
    got = [(r["doc_id"], r["lang_pred"]) for r in language.predict(docs, model).collect()]
    want = {d: k for d, _, k in rows if d is not None}
    assert sum(want[d] == p for d, p in got if d is not None) >= 0.99 * len(want)


def test_predictions_match_a_plain_nearest_centroid(spark):
    import math

    texts = ["the thing that was there and then", "que los niños son cosas", "der zweck ist nicht schlicht", "and the other things there", "las cosas que son"]
    docs = spark.createDataFrame([(i, t, "abcab"[i]) for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    model = language.fit(docs)
    for r in language.predict(docs, model).collect():
        v = [math.sqrt(c) * w for c, w in zip(language.gram_counts(texts[r["doc_id"]]), model["idf"])]
        norm = math.sqrt(sum(x * x for x in v))
        cosines = [sum(x * y for x, y in zip(v, c)) / norm for c in model["centres"]]
        assert r["lang_pred"] == model["names"][max(range(len(cosines)), key=cosines.__getitem__)]
