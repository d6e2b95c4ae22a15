"""Containment pairs against brute force."""

import random

import pytest

from arborist.llm import decontamination


def brute(docs, items, width=5, threshold=0.8):
    def words(t):
        return (t or "").lower().split()

    def shingles(w, k):
        return {" ".join(w[i : i + k]) for i in range(len(w) - k + 1)}

    # Rows are documents and items, whatever their ids; rows alike in id and text count once.
    out = []
    for i, t in dict.fromkeys(items):
        w = words(t)
        k = min(width, len(w))
        mine = shingles(w, k) if w else set()
        for d, x in dict.fromkeys(docs):
            got = len(mine & shingles(words(x), k)) if mine else 0
            if mine and got >= threshold * len(mine) - 1e-9:
                out.append((d, i, len(mine), got))
    return sorted(out, key=str)


def texts(seed):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    run = lambda n: [rnd.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(run(rnd.randint(6, 50)))) for i in range(30)]
    items += [(50, "one two"), (51, "Alone"), (52, ""), (53, None), (54, "five words are one shingle"), (55, items[3][1]),
              (56, "a a a a a a a a a a"), (3, "zz yy xx ww vv uu"), (None, "null id item with many words here")]
    docs = []
    for d in range(150):
        w = run(rnd.randint(0, 300))
        for _ in range(rnd.randint(0, 2)):
            part = (items[rnd.randrange(30)][1]).split()
            for _ in range(rnd.randint(0, 4)):
                part[rnd.randrange(len(part))] = rnd.choice(vocabulary)
            at = rnd.randint(0, len(w))
            w[at:at] = part
        docs.append((d, rnd.choice([" ", "\n", "\t "]).join(w).upper()))
    docs += [(200, None), (201, ""), (202, "see ONE two here"), (203, "alone"), (204, "five words are one shingle"),
             (205, "x " * 5000 + items[7][1] + " y" * 5000), (0, items[1][1]), (206, "a " * 50),
             (None, "a null id item with many words here"), (207, items[9][1]), (207, items[9][1])]
    return docs, items


@pytest.mark.parametrize("seed", [1, 2])
def test_pairs_match_brute_force(spark, docs_of, with_clashes, seed):
    docs, items = texts(seed)
    df = with_clashes(spark.createDataFrame(items, "item_id long, text string"))
    got = decontamination.contained_items(with_clashes(docs_of(docs)), df).collect()
    assert sorted(((r["doc_id"], r["item_id"], r["n_shingles"], r["n_found"]) for r in got), key=str) == brute(docs, items)


def test_wide_sides_are_joined_without_broadcast(spark, docs_of, monkeypatch):
    from arborist.llm import common

    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    docs, items = texts(3)
    got = decontamination.contained_items(docs_of(docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted(((r["doc_id"], r["item_id"], r["n_shingles"], r["n_found"]) for r in got), key=str) == brute(docs, items)


def test_empty_tables_and_clean_documents(spark, docs_of, with_clashes, empty):
    items = spark.createDataFrame([(1, "one two three four five six")], "item_id long, text string")
    none = items.where("false")
    docs = with_clashes(docs_of([(1, "zero ONE two three four five six"), (2, "one two"), (None, "x"), (2, "one two")]))
    assert decontamination.contained_items(empty, items).collect() == []
    assert decontamination.contained_items(docs, none).collect() == []
    out = decontamination.clean_documents(docs, items)
    assert out.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in out.collect()) == ["2", "2", "None"]
    assert decontamination.clean_documents(docs, none).count() == 4


def test_clean_documents_goes_by_row_not_by_id(spark, docs_of, with_clashes):
    items = spark.createDataFrame([(1, "one two three four five six")], "item_id long, text string")
    rows = [(None, "zero one two three four five six"), (None, "other words"), (None, None), (4, "x one two three four five six"),
            (4, "clean words"), (5, "one two three four five"), (5, "two three four five six")]
    out = decontamination.clean_documents(with_clashes(docs_of(rows)), items).collect()
    want = [rows[1], rows[2], rows[4], rows[5], rows[6]]
    assert sorted(((r["doc_id"], r["text"]) for r in out), key=str) == sorted(want, key=str)


def test_items_and_documents_without_ids(spark, docs_of, with_clashes):
    text = lambda c: " ".join(f"{c}{j}" for j in range(12))
    items = [(None, text("a")), (None, text("b")), (7, text("c")), (7, text("d")), (7, text("c")), (8, text("c"))]
    df = with_clashes(spark.createDataFrame(items, "item_id long, text string"))
    docs = [(None, "x " + text("a")), (None, "y " + text("b")), (1, text("c") + " z"), (1, text("d")), (1, "clean one"), (None, "clean two"),
            (2, text("c") + " z"), (2, text("c") + " z")]
    got = decontamination.contained_items(with_clashes(docs_of(docs)), df).collect()
    assert sorted(map(tuple, got), key=str) == brute(docs, items)
    kept = decontamination.clean_documents(docs_of(docs), df).collect()
    assert sorted(r["text"] for r in kept) == ["clean one", "clean two"]


def test_a_text_that_many_rows_hold(spark, docs_of):
    item = " ".join(f"w{j}" for j in range(20))
    docs = [(i, "before " + item) for i in range(500)] + [(1000, "other words altogether")]
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert decontamination.contained_items(docs_of(docs), items).count() == 500
    assert decontamination.clean_documents(docs_of(docs), items).count() == 1
