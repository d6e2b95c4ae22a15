"""SimHash components against brute force."""

import random

import pytest
import xxhash

from arborist.llm import simhash


def brute_fingerprint(text, width=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows, distance=4):
    fps = [brute_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= distance:
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            r = find(i)
            least[r] = min(least.get(r, d), d)
    return [(d, fps[i], least.get(find(i))) for i, (d, _) in enumerate(rows)]


def near_copies(seed, n_docs=40, copies=6, length=120):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choices("abcdefgh", k=rnd.randint(1, 6)))
    rows = []
    for _ in range(n_docs):
        base = [word() for _ in range(length)]
        for _ in range(rnd.randint(1, copies)):
            text = list(base)
            for _ in range(rnd.randint(0, 3)):
                text[rnd.randrange(length)] = word()
            rows.append(" ".join(text))
    rnd.shuffle(rows)
    return list(enumerate(rows, start=5))


def found(df):
    return sorted(((r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in df.collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_components_match_brute_force(docs_of, with_clashes, seed):
    rows = near_copies(seed) + [(1, None), (2, ""), (3, " \t\n"), (4, "One TWO"), (900, "one two"), (901, "x y z w")]
    rows += [(7, rows[0][1]), (7, rows[0][1]), (None, rows[3][1])]
    got = found(simhash.near_duplicates(with_clashes(docs_of(rows)), 4, 4))
    assert got == sorted(brute_components(rows), key=str)


def test_chain_and_large_group(docs_of, monkeypatch):
    # Fingerprints forced: a chain whose ends are far apart, and 300 that all lie close.
    rnd = random.Random(3)
    base = rnd.getrandbits(64)
    chain = [base]
    for i in range(12):
        chain.append(chain[-1] ^ (0b1111 << (4 * i)))
    far = rnd.getrandbits(64)
    group = [far ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(64)) for _ in range(300)]
    fps = chain + group
    spark_rows = [(f - (1 << 64) if f >> 63 else f, 1) for f in set(fps)]
    nodes = docs_of([(1, "x")]).sparkSession.createDataFrame(spark_rows, "fp long, n long")
    roots = {r["fp"] % (1 << 64): r["root"] for r in simhash.link_fingerprints(nodes, 4, len(spark_rows)).collect()}
    assert len({roots[f] for f in chain}) == 1
    assert len({roots[f] for f in set(group)}) == 1
    assert roots[chain[0]] != roots[group[0]]


def test_every_pair_within_distance_shares_a_key():
    rnd = random.Random(4)
    masks = simhash.block_masks(4)
    assert len(masks) == 35
    for _ in range(2000):
        a = rnd.getrandbits(64)
        b = a
        for bit in rnd.sample(range(64), rnd.randint(0, 4)):
            b ^= 1 << bit
        assert any((a & m) == (b & m) for m in (x % (1 << 64) for x in masks))


def test_long_text(docs_of, monkeypatch):
    monkeypatch.setattr(simhash, "_CHUNK", 50)
    rnd = random.Random(5)
    text = " ".join(rnd.choice(["alpha", "Beta", "ga", "é"]) for _ in range(1003))
    assert simhash.simhash64(text.encode(), 4) == brute_fingerprint(text)


def test_empty_table_and_keep_one(docs_of, with_clashes, empty):
    assert simhash.near_duplicates(empty).collect() == []
    assert simhash.keep_one(empty).collect() == []
    text = "one two three four five six seven eight"
    rows = [(3, text), (2, text), (2, text), (9, "other words that stand here alone today now"), (None, text)]
    docs = with_clashes(docs_of(rows))
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 9]


def test_keep_one_goes_by_row_not_by_id(docs_of, with_clashes):
    rnd = random.Random(11)
    prose = lambda: " ".join("".join(rnd.choices("abcdefgh", k=6)) for _ in range(60))
    alone = [(None, prose()) for _ in range(8)] + [(50, prose()), (50, prose()), (51, prose())]
    copied, nameless = prose(), prose()
    rows = alone + [(None, copied), (7, copied), (50, copied)] + [(None, nameless)] * 3
    kept = simhash.keep_one(with_clashes(docs_of(rows))).collect()
    want = [*alone, (7, copied), (None, nameless)]
    assert sorted(((r["doc_id"], r["text"]) for r in kept), key=str) == sorted(want, key=str)
    # One component without ids besides a null copy of another: the copy does not come back.
    rows = [(None, nameless), (None, copied), (7, copied)]
    kept = simhash.keep_one(docs_of(rows)).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in kept), key=str) == sorted([(7, copied), (None, nameless)], key=str)


def test_a_far_member_does_not_compare_all_the_others(spark):
    """Many fingerprints around a hub and some a little further off: the same
    components as brute force, and the close ones are not paired with each other."""
    rnd = random.Random(21)
    hub = rnd.getrandbits(64)
    close = {hub} | {hub ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(a)}
    fps = list(close)[:900]
    spread = [hub ^ sum(1 << i for i in rnd.sample(range(64), 7)) for _ in range(20)]
    fps = list(dict.fromkeys([hub, *fps, *spread]))
    nodes = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f, 1 + (f == hub)) for f in fps], "fp long, n long")
    roots = {r["fp"] % (1 << 64): r["root"] for r in simhash.link_fingerprints(nodes, 4, len(fps)).collect()}
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if bin(a ^ b).count("1") <= 4:
                parent[find(a)] = find(b)
    groups = {}
    for f in fps:
        groups.setdefault(find(f), set()).add(f)
    for g in groups.values():
        assert len({roots.get(f, f) for f in g}) == 1
    assert len({roots.get(f, f) for f in fps}) == len(groups)
