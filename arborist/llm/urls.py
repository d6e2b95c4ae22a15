"""URL filter: host rules first, then a character language-model ratio.

Two variable-order Markov models, one of accepted and one of rejected
URLs, share one n-gram table: counts of every gram of ``ORDER + 1``
characters by class; all lower orders are sums of it.  Each order
interpolates with the next lower one by Witten-Bell smoothing, down to
equal chances for all characters.  A URL's score is the difference of its
log-likelihoods per character; the threshold is calibrated on labelled
hosts that the models have not seen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, bounded, partitions, salted_join, written

# Fixed values of the contract: (host, path, verdict).
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
ORDER = 4
# One host in this many calibrates the threshold; the others train.
CALIBRATION_FOLD = 5
BINS = 400
_PAD, _END = "\x02", "\x03"
_CLASSES = ("acc", "rej")


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://`` or for null."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.coalesce(F.regexp_extract(url, pattern, 1), F.lit(""))
    path = F.coalesce(F.regexp_extract(url, pattern, 2), F.lit(""))
    return F.translate(host, UPPER, LOWER), path


def judged_text(url: Column) -> Column:
    """What the models read: the whole URL, scheme to fragment, its host with
    A-Z lower-cased; empty for null."""
    pattern = r"(?s)^(.*?://)([^/?#]*)(.*)$"
    part = lambda i: F.regexp_extract(url, pattern, i)
    whole = F.concat(part(1), F.translate(part(2), UPPER, LOWER), part(3))
    return F.coalesce(F.when(F.contains(url, F.lit("://")), whole).otherwise(url), F.lit(""))


def matching_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """``(rule, verdict)`` of the longest rule that fits; nulls without one."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name = F.when(fits, F.lit(h + p)).otherwise(name)
        verdict = F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def _grams(text: Column, order: int) -> Column:
    """All grams of ``order + 1`` characters of the text with its end mark,
    the start padded; digits count as one character."""
    plain = F.translate(text, "123456789" + _PAD + _END, "000000000")
    padded = F.concat(F.lit(_PAD * order), plain, F.lit(_END))
    return F.transform(
        F.sequence(F.lit(1), F.length(plain) + 1), lambda i: F.substring(padded, i, F.lit(order + 1))
    )


def gram_scores(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """``(gram, llr)`` from ``(gram, acc, rej)`` counts: the difference of the
    two models' natural log probability of the gram's last character given
    the others.  Grams seen in no class are listed too, with both counts 0."""
    counts = written(counts)
    alphabet = counts.select(F.count_distinct(F.substring("gram", -1, 1))).first()[0] or 1
    out = counts.select("gram").withColumns({f"p_{c}": F.lit(1.0 / alphabet) for c in _CLASSES})
    for k in range(order + 1):
        suffix = F.substring("gram", -(k + 1), k + 1)
        level = counts.groupBy(suffix.alias("s")).agg(*[F.sum(c).alias(c) for c in _CLASSES])
        context = level.groupBy(F.substring("s", 1, k).alias("ctx")).agg(
            *[F.sum(c).alias(f"n_{c}") for c in _CLASSES],
            *[F.count_if(F.col(c) > 0).alias(f"t_{c}") for c in _CLASSES],
        )
        level = level.withColumn("ctx", F.substring("s", 1, k)).join(context, "ctx").drop("ctx")
        out = out.withColumn("s", suffix).join(level, "s")
        for c in _CLASSES:
            n, t, p = F.col(f"n_{c}"), F.col(f"t_{c}"), F.col(f"p_{c}")
            out = out.withColumn(f"p_{c}", F.when(n > 0, (F.col(c) + t * p) / (n + t)).otherwise(p))
        out = out.select("gram", "p_acc", "p_rej")
    return out.select("gram", (F.log("p_acc") - F.log("p_rej")).alias("llr"))


def _threshold(scored: DataFrame) -> float:
    """Cut with the least sum of both classes' error rates on the calibration
    hosts; 0 if a class is missing there.  At most ``BINS`` sums per class
    reach the driver."""
    edge = F.greatest(F.lit(-BINS // 2), F.least(F.lit(BINS // 2 - 1), F.floor(F.col("score") * (BINS / 8.0))))
    held = scored.where(F.col("calibrates") & F.col("verdict").isNotNull())
    found = held.groupBy(edge.alias("bin")).agg(
        F.count_if(F.col("verdict") == "allow").alias("acc"), F.count_if(F.col("verdict") == "block").alias("rej")
    )
    rows = {r["bin"]: (r["acc"], r["rej"]) for r in found.collect()}
    acc, rej = (sum(v[i] for v in rows.values()) for i in (0, 1))
    if not acc or not rej:
        return 0.0
    below_acc = below_rej = 0
    ranked = []
    for b in range(-BINS // 2, BINS // 2 + 1):
        error = below_acc / acc + (rej - below_rej) / rej
        ranked.append((error, abs(b), b))
        a, r = rows.get(b, (0, 0))
        below_acc, below_rej = below_acc + a, below_rej + r
    return min(ranked)[2] * 8.0 / BINS


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES, order: int = ORDER) -> DataFrame:
    """One row per row of ``pages``: ``page_id, host, path, rule, verdict,
    score, threshold``.

    URLs that a rule decides teach the models, and keep the rule's verdict;
    all others are allowed if their score reaches the threshold.  The score
    is of the whole URL, query and fragment included.  Null URLs and those
    without ``://`` have an empty host and path for the rules; null URLs
    score as empty ones.  Without both kinds of labels all models are alike, scores are 0
    and the verdict is allow.  Repeated rows are judged alike; an empty
    table gives an empty result; columns not named are not read.
    """
    host, path = split_url(F.col(url_col))
    urls = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"), judged_text(F.col(url_col)).alias("text"))
    name, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    urls = urls.withColumn("rule", name).withColumn("verdict", verdict)
    # The same URL scores alike, and has one host and path: each is cut into grams once.
    fold = F.pmod(F.crc32(F.col("host")), F.lit(CALIBRATION_FOLD)) == 0
    texts = written(
        urls.groupBy("text", "host")
        .agg(F.first("verdict").alias("verdict"), F.count(F.lit(1)).alias("n"))
        # Few bytes, much work: as many tasks as the session's shuffles have.
        .repartition(partitions(pages.sparkSession))
        .withColumn("calibrates", fold)
        .withColumn("grams", _grams(F.col("text"), order))
    )
    teaches = lambda v: F.sum(F.when((F.col("verdict") == v) & ~F.col("calibrates"), F.col("n")).otherwise(0))
    counts = (
        texts.select("verdict", "calibrates", "n", F.explode("grams").alias("gram"))
        .groupBy("gram")
        .agg(teaches("allow").alias("acc"), teaches("block").alias("rej"))
    )
    model = written(gram_scores(counts, order))
    n_grams = model.count()
    side = bounded(model, n_grams, n_grams * (4 * (order + 1) + 32))
    cut_up = texts.select("text", "verdict", "calibrates", F.explode("grams").alias("gram"))
    # Some grams stand in every URL.
    joined = cut_up.join(side, "gram") if side is not model else salted_join(cut_up, model, ["gram"], F.xxhash64("text"))
    scored = (
        joined.groupBy("text", "verdict", "calibrates")
        .agg(F.avg("llr").alias("score"))
    )
    scored = written(scored)
    cut = _threshold(scored)
    return _attach(urls, scored.select("text", "score"), cut)


def _attach(urls: DataFrame, scores: DataFrame, cut: float) -> DataFrame:
    # A URL may hold a third of all rows, so the join is salted by the row's id.
    out = salted_join(urls, scores, ["text"], F.xxhash64("page_id"))
    judged = F.when(F.col("score") >= F.lit(cut), F.lit("allow")).otherwise(F.lit("block"))
    return out.select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", judged).alias("verdict"),
        "score", F.lit(cut).alias("threshold"),
    )
