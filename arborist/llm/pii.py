"""Personal data: base patterns, and identifiers found by bootstrapped contexts.

Base entities come from fixed patterns with their checks; with key digests
(32, 40 or 64 hexadecimal digits) they seed a pattern-instance graph.  An
instance is an identifier: a base match, any other word with a digit, or
what is assigned by ``=`` or ``:``.  A pattern is the text right before or
after a mention.  A pattern's precision is the trusted share of all places
in the corpus where its word stands, so that a word of ordinary text never
speaks.  Rounds of joins score patterns by the trust in their instances,
and an instance by its speaking patterns, combined as independent
witnesses: contexts that say nothing take nothing away.  Identifiers that
the patterns vouch for are reported besides the base spans, as kind
``context``.

Only DataFrame functions are used.  Positions come from cutting the text
at the matches and adding up the lengths, in code points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, bounded, salted_join, written

# Fixed values of the contract, in its order.  Repetitions are possessive and start at
# the run's first character: the same matches without retries from inside a run.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text with a match must hold: spares the others the pattern.
NEEDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9]", "phone": r"\+[0-9]"}
CONTEXT = "context"
# A word with a digit, cut free of what stands before it, as in key="...".
IDENTIFIER = rf"(?<![^{SPACE}\"'=:(\[<])[^{SPACE}\"'=:(\[<0-9]*+[0-9][^{SPACE}\"')\]>,;]*+"
# A word right after = or :, also without a digit.
ASSIGNED = rf"(?<=[=:]|[=:] |[=:][\"']|[=:] [\"'])[^{SPACE}\"'=:(\[<)\]>,;]{{4,}}+"
# Digests of the usual lengths, as keys and tokens are written.
SECRET = "^(?=.*[a-f])(?=.*[0-9])(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64})$"
WINDOW = 48  # characters looked at on either side
ROUNDS = 3
MIN_TRUSTED = 4  # distinct trusted instances of a pattern that may speak
MIN_PRECISION = 0.6  # of their share among all places of its word
MIN_TRUST = 0.75  # of an instance that is reported

_SPAN = "array<struct<start:int,end:int,text:string>>"


def _matches(text: Column, pattern: str) -> Column:
    """``(start, end, text)`` of all matches, in order."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("out"))

    def step(acc, i):
        lo = acc["at"] + F.length(between[i])
        hi = lo + F.length(found[i])
        span = F.struct(lo.alias("start"), hi.alias("end"), found[i].alias("text"))
        return F.struct(hi.alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    some = F.aggregate(F.sequence(F.lit(0), F.size(found) - 1), start, step)["out"]
    return F.when(F.size(found) > 0, some).otherwise(F.array().cast(_SPAN))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def add(total, i):
        digit = F.substring(digits, -i, F.lit(1)).cast("int")
        twice = F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit)
        return total + F.when(i % 2 == 0, twice).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _passes(kind: str, text: Column) -> Column:
    if kind == "ip":
        return text.rlike(r"^(?:0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{0,2})(?:\.|$)){4}$")
    if kind == "card":
        digits = _digits(text)
        return F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(text)).between(10, 15)
    return F.lit(True)


def base_spans(text: Column, kind: str) -> Column:
    """Checked matches of one kind: ``array<struct<start, end, text>>``."""
    spans = F.filter(_matches(text, PATTERNS[kind]), lambda s: _passes(kind, s["text"]))
    holds = F.contains(text, F.lit("@")) if kind == "email" else text.rlike(NEEDS[kind])
    return F.when(holds, spans).otherwise(F.array().cast(_SPAN))


def _joined(spans: Column) -> Column:
    """``kind:start:end`` by start, then kind as listed."""
    ordered = F.array_sort(spans)
    kinds = F.array(*[F.lit(k) for k in (*KINDS, CONTEXT)])
    text = F.transform(ordered, lambda s: F.concat_ws(":", kinds[s["rank"]], s["start"], s["end"]))
    return F.array_join(text, ",")


def _tagged(spans: Column, rank: int) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end")))


def _plain(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), "[0-9]+", "0")


_LETTERS = rf"[^{SPACE}]*\p{{L}}[^{SPACE}]*"
_TO_MENTION = rf"{_LETTERS}(?:[{SPACE}]+[^{SPACE}\p{{L}}]*)*"


def _contexts(text: Column, start: Column, end: Column) -> Column:
    """Patterns of a mention with the words they stand on: the last word with a
    letter up to the mention, the same with the word before it, the next word."""
    before = _plain(F.substring(text, F.greatest(F.lit(1), start - WINDOW + 1), F.least(F.lit(WINDOW), start)))
    after = _plain(F.substring(text, end + 1, F.lit(WINDOW)))
    one = F.regexp_extract(before, rf"(?:^|[{SPACE}])({_TO_MENTION})$", 1)
    two = F.regexp_extract(before, rf"(?:^|[{SPACE}])([^{SPACE}]+[{SPACE}]+{_TO_MENTION})$", 1)
    next_ = F.regexp_extract(after, rf"^[{SPACE}]+([^{SPACE}]+)", 1)
    word = lambda c: F.regexp_extract(c, rf"^([^{SPACE}]+)", 1)

    def pattern(kind, c, *words):
        return F.struct(F.concat(F.lit(kind), c).alias("pattern"), F.array(*words).alias("words"))

    named = F.array(pattern("1 ", one, word(one)), pattern("2 ", two, word(two), word(one)), pattern("+ ", next_, next_))
    return F.filter(named, lambda p: F.length(p["pattern"]) > 2)


def word_totals(texts: DataFrame, wanted: DataFrame, n_wanted: int, letters: int) -> DataFrame:
    """``(word, total)``: how often each of the ``wanted (word)`` stands in
    ``texts (text)``, as a word or as the start of one up to a quote, colon
    or the like."""
    every = texts.select(F.explode(F.split(_plain(F.col("text")), f"[{SPACE}]+")).alias("whole"))
    start = F.regexp_extract("whole", r"^([^\"'=:(\[<]*[\"'=:(\[<]+)", 1)
    every = every.select(F.explode(F.array_distinct(F.array("whole", start))).alias("word"))
    side = bounded(wanted, n_wanted, letters + 16 * n_wanted)
    if side is not wanted:
        every = every.join(side, "word", "left_semi")
        return every.groupBy("word").agg(F.count(F.lit(1)).alias("total"))
    return every.groupBy("word").agg(F.count(F.lit(1)).alias("total")).join(wanted, "word", "left_semi")


def _mentions(text: Column, base: Column) -> Column:
    """Base matches (seeds) and all other identifiers, with their patterns."""

    def mention(s, seed):
        return F.struct(
            s["start"].alias("start"), s["end"].alias("end"), F.lower(s["text"]).alias("instance"),
            (F.lit(seed) | F.lower(s["text"]).rlike(SECRET)).alias("seed"), F.lit(seed).alias("base"), _contexts(text, s["start"], s["end"]).alias("patterns"),
        )

    seeds = F.transform(base, lambda s: mention(s, True))
    words = F.filter(
        _matches(text, f"{IDENTIFIER}|{ASSIGNED}"),
        lambda w: ~F.exists(base, lambda b: (b["start"] < w["end"]) & (w["start"] < b["end"])),
    )
    return F.concat(seeds, F.transform(words, lambda s: mention(s, False)))


def trusted_instances(edges: DataFrame, seeds: DataFrame, totals: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``(instance, trust)`` of every instance that a speaking pattern vouches
    for, from ``edges (pattern, instance, n)`` (n mentions), the ``seeds
    (instance)`` and ``totals (pattern, total)``, all places of a pattern.

    Seeds are trusted throughout.  A round scores a pattern by ``precision``
    = trusted mentions / places; it speaks from MIN_TRUSTED distinct trusted
    instances and MIN_PRECISION on, with the weight precision * t / (t + 1)
    of its t trusted instances.  An instance's trust is 1 - the product of
    (1 - weight) over its speaking patterns: the silent ones do not count.
    """
    edges, seeds = written(edges), written(seeds.distinct())
    start = seeds.select("instance", F.lit(1.0).alias("trust"))
    trust = start
    found = start.where("false")
    for _ in range(rounds):
        known = edges.join(trust, "instance", "left")
        scored = known.groupBy("pattern").agg(
            F.count_if(F.col("trust") >= MIN_TRUST).alias("t"), F.sum(F.col("n") * F.coalesce("trust", F.lit(0.0))).alias("trusted")
        ).where(F.col("t") >= MIN_TRUSTED)
        precision = F.col("trusted") / F.col("total")
        patterns = written(
            scored.join(totals, "pattern").where(precision >= MIN_PRECISION)
            .select("pattern", (F.least(precision, F.lit(1.0)) * F.col("t") / (F.col("t") + 1)).alias("weight"))
        )
        count, size = patterns.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("pattern")), F.lit(0))).first()
        side = bounded(patterns, count, size + 24 * count)
        spoken = edges.join(side, "pattern") if side is not patterns else salted_join(
            edges, patterns, ["pattern"], F.xxhash64("instance"))
        found = written(spoken.groupBy("instance").agg((1 - F.exp(F.sum(F.log1p(-F.col("weight"))))).alias("trust")))
        trust = start.union(found.join(seeds, "instance", "left_anti"))
    return found


def _pattern_totals(edges: DataFrame, texts: DataFrame) -> DataFrame:
    """``(pattern, total)`` of ``edges (pattern, words, ...)``: the places of its
    rarest word, an upper bound of the pattern's own.  A pattern on a word
    cut off by the window has no total and never speaks."""
    patterns = written(edges.select("pattern", "words").distinct())
    wanted = written(patterns.select(F.explode("words").alias("word")).distinct())
    n, letters = wanted.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("word")), F.lit(0))).first()
    totals = written(word_totals(texts, wanted, n, letters))
    found = patterns.select("pattern", F.explode(F.array_distinct("words")).alias("word"), F.size(F.array_distinct("words")).alias("n_distinct"))
    side = bounded(totals, n, letters + 24 * n)
    found = found.join(side, "word").groupBy("pattern", "n_distinct").agg(F.min("total").alias("total"), F.count(F.lit(1)).alias("n"))
    return written(found.where("n = n_distinct").select("pattern", "total"))


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_email, n_ip, n_card, n_phone,
    base_sha256, spans, n_context``.

    Counts and ``base_sha256`` are of the base spans, ``spans`` lists all of
    them as ``kind:start:end`` (code points, end exclusive).  Null and empty
    texts hold nothing; rows that repeat an id or a text have rows of their
    own; without seeds there are no context spans; an empty table gives an
    empty result; other columns are not read.
    """
    text = F.col("text")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumns({k: base_spans(text, k) for k in KINDS})
    holds = text.rlike("[0-9=:]") | (F.size("email") > 0)
    every = F.concat(*KINDS)
    rows = written(
        rows.select(
            "doc_id", *KINDS, F.monotonically_increasing_id().alias("row"), F.when(holds, _mentions(text, every)).alias("mentions")
        )
    )
    mentions = rows.select("row", F.inline("mentions"))
    uses = mentions.select("instance", F.inline("patterns")).groupBy("pattern", "words", "instance").agg(F.count(F.lit(1)).alias("n"))
    uses = written(uses)
    # Patterns with fewer distinct instances can never speak.
    able = uses.groupBy("pattern").agg(F.count(F.lit(1)).alias("instances")).where(F.col("instances") >= MIN_TRUSTED)
    edges = written(uses.join(able.select("pattern"), "pattern", "left_semi"))
    totals = _pattern_totals(edges, docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text")))
    trust = trusted_instances(edges.select("pattern", "instance", "n"), mentions.where("seed").select("instance"), totals)
    found = mentions.where("NOT base").select("row", "start", "end", "instance")
    rank = F.lit(len(KINDS)).alias("rank")
    trusted = written(trust.where(F.col("trust") >= MIN_TRUST).select("instance"))
    count, letters = trusted.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("instance")), F.lit(0))).first()
    side = bounded(trusted, count, letters + 16 * count)
    added = found.join(side, "instance") if side is not trusted else salted_join(found, trusted, ["instance"], F.col("row"))
    added = added.groupBy("row").agg(F.collect_list(F.struct("start", rank, "end")).alias("added"))  # of one text
    out = rows.join(added, "row", "left")
    base = F.concat(*[_tagged(F.col(k), i) for i, k in enumerate(KINDS)])
    context = F.coalesce("added", F.array().cast("array<struct<start:int,rank:int,end:int>>"))
    return out.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.concat(base, context)).alias("spans"),
        F.size(context).cast("long").alias("n_context"),
    )
