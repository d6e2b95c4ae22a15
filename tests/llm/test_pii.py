"""Base spans against the contract's patterns, and contexts that find more."""

import hashlib
import random
import re

import pytest

from arborist.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def passes(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def brute(text):
    text = text or ""
    found = [(m.start(), i, m.end()) for i, (k, p) in enumerate(PATTERNS.items())
             for m in re.finditer(p, text) if passes(k, m.group())]
    names = list(PATTERNS)
    counts = [sum(f[1] == i for f in found) for i in range(4)]
    return counts, ",".join(f"{names[k]}:{s}:{e}" for s, k, e in sorted(found))


TEXTS = [
    "mail a.b+c@d-e.co.uk, x@y and q@z.w.", "a@b.c_d@e.f@g.h", "@@a@@b.c a@b..c .@x.y", "É a@b.c 😀 e@f.g",
    "1.2.3.4 256.1.1.1 1.2.3 1.2.3.4.5.6.7.8 001.002.003.004 0000255.0.0.0 1.2.3.4444444444444444444444",
    "4111 1111 1111 1111 4111-1111-1111-1111 4111  1111 1111 1111 41111111111111114111111111111111",
    "4111 1111 1111 1112 card:4111111111111111. 37828224631000537828224631000 3782 822463 10005",
    "+1 (239) 555-1768 +1239 +12 345 678 90 12 ++1 234 567 8901 + 1 234 +1.2.3.4.5.6.7.8.9.0.1",
    "+1 (203) 555-0000 4111111111111111 10.0.0.1 a@b.c", "", None, " \n", "no data here", "1" * 4000 + " " + "2 " * 3000,
    "a" * 20000 + "@b.c", "x." * 5000, "+1" + "-" * 5000, "10.0.0.1\n10.0.0.1\r10.0.0.1 10.0.0.1",
]


@pytest.mark.parametrize("seed", [1])
def test_base_spans_match_brute_force(docs_of, with_clashes, seed):
    rnd = random.Random(seed)
    alphabet = "a1.@+-() 25é\n"
    texts = TEXTS + ["".join(rnd.choices(alphabet, k=rnd.randint(1, 200))) for _ in range(300)]
    texts += ["".join(rnd.choices("0123456789 -", [9] * 10 + [3, 1], k=120)) for _ in range(100)]
    rows = list(enumerate(texts)) + [(0, TEXTS[0]), (None, TEXTS[0])]
    out = pii.personal_data(with_clashes(docs_of(rows))).collect()
    assert len(out) == len(rows)
    for r in out:
        counts, joined = brute(texts[r["doc_id"] or 0])
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == counts, texts[r["doc_id"] or 0]
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        spans = r["spans"].split(",") if r["spans"] else []
        assert ",".join(s for s in spans if not s.startswith("context:")) == joined
        assert [int(s.split(":")[1]) for s in spans] == sorted(int(s.split(":")[1]) for s in spans)


def test_contexts_find_unseen_identifiers(docs_of):
    rows = [(i, f"please write to the address user{i}@mail.example.org for more") for i in range(30)]
    rows += [(100, "please write to the address AB-7781-XY for more"), (101, "the price was 77 and 12 more"),
             (102, "in 1999 we saw 35 of 44 and then 17"), (103, "reach the address 55K9Q for more")]
    rows += [(200 + i, f"it was {i} in all") for i in range(20)]
    out = {r["doc_id"]: r for r in pii.personal_data(docs_of(rows)).collect()}
    text = dict(rows)

    def contexts(d):
        spans = [s.split(":") for s in out[d]["spans"].split(",") if s.startswith("context:")]
        return [text[d][int(s):int(e)] for _, s, e in spans]

    assert contexts(100) == ["AB-7781-XY"] and contexts(103) == ["55K9Q"]
    assert all(contexts(d) == [] for d in (101, 102, *range(200, 220)))
    assert all(out[i]["n_email"] == 1 for i in range(30))


def test_no_seeds_and_empty_table(docs_of, empty):
    out = pii.personal_data(docs_of([(1, "nothing 5 here 6"), (2, None)])).collect()
    assert [r["spans"] for r in out] == ["", ""]
    assert pii.personal_data(empty).collect() == []


def contexts_of(docs_of, rows):
    text = dict(rows)
    out = {}
    for r in pii.personal_data(docs_of(rows)).collect():
        spans = [s.split(":") for s in r["spans"].split(",") if s.startswith("context:")]
        out[r["doc_id"]] = [text[r["doc_id"]][int(s):int(e)] for _, s, e in spans]
    return out


def test_a_trusted_left_context_is_enough(docs_of):
    """Random words follow the mentions: patterns that say nothing take nothing away."""
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choices("abcdefghij", k=6))
    prose = lambda n: " ".join(word() for _ in range(n))
    rows = [(i, f"{prose(5)} contact: user{i}@mail.example.org {prose(6)}") for i in range(20)]
    unseen = {100: "QX-4471", 101: "88/KLM/2", 102: "v7k3m", 103: "JOHNDOE", 104: "id55"}
    rows += [(d, f"{prose(4)} contact: {x} {prose(5)}") for d, x in unseen.items()]
    clean = [(200 + i, f"{prose(5)} {rnd.randint(1, 999)} {prose(3)} note: {word()} {prose(3)}") for i in range(40)]
    out = contexts_of(docs_of, rows + clean)
    assert {d: out[d] for d in unseen} == {d: [x] for d, x in unseen.items()}
    assert all(out[d] == [] for d, _ in clean)


def test_key_digests_teach_their_context(docs_of):
    rnd = random.Random(5)
    digest = lambda n: "".join(rnd.choice("0123456789") + rnd.choice("abcdef") for _ in range(n // 2))
    rows = [(i, f'some text token = "{digest(40)}" and more {i}') for i in range(12)]
    rows += [(50, 'old token = "hunter2-secret" here'), (51, f"commit {digest(40)} fixed it"), (52, "no token at all 12")]
    out = contexts_of(docs_of, rows)
    assert all(len(out[i]) == 1 and len(out[i][0]) == 40 for i in range(12))
    assert out[50] == ["hunter2-secret"] and out[51] == [] and out[52] == []


def test_trust_matches_a_plain_version(spark):
    import math

    rnd = random.Random(6)
    edges = {(f"p{rnd.randrange(25)}", f"i{rnd.randrange(60)}"): rnd.randint(1, 4) for _ in range(500)}
    seeds = {f"i{i}" for i in range(25)}
    totals = {f"p{p}": sum(n for (q, _), n in edges.items() if q == f"p{p}") + rnd.choice([0, 0, 3, 100]) for p in range(24)}
    trust, found = dict.fromkeys(seeds, 1.0), {}
    for _ in range(3):
        weight = {}
        for p, total in totals.items():
            mine = [(i, n) for (q, i), n in edges.items() if q == p]
            t = sum(trust.get(i, 0) >= pii.MIN_TRUST for i, _ in mine)
            precision = sum(n * trust.get(i, 0) for i, n in mine) / total if total else 0
            if t >= pii.MIN_TRUSTED and precision >= pii.MIN_PRECISION:
                weight[p] = min(1, precision) * t / (t + 1)
        found = {}
        for p, i in edges:
            if p in weight:
                found[i] = found.get(i, 1.0) * (1 - weight[p])
        found = {i: 1 - x for i, x in found.items()}
        trust = {**found, **dict.fromkeys(seeds, 1.0)}
    got = pii.trusted_instances(
        spark.createDataFrame([(p, i, n) for (p, i), n in edges.items()], "pattern string, instance string, n long"),
        spark.createDataFrame([(s,) for s in sorted(seeds)] * 2, "instance string"),
        spark.createDataFrame(list(totals.items()), "pattern string, total long"),
    )
    got = {r["instance"]: r["trust"] for r in got.collect()}
    assert got.keys() == found.keys() and all(math.isclose(got[i], found[i], rel_tol=1e-9) for i in got)
    assert 0 < len(found) < 60
