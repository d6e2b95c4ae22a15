"""Target-distribution importance resampling, ranked by regular sampling.

Hashed runs of words are counted in a fixed number of buckets, over the raw
documents and over the target texts.  The two arrays of counts give one
array of gains; a document's weight is the floored mean of its features'
gains, and Gumbel noise that follows from its id makes the highest scores
a weighted draw without replacement.

The draw is a parallel sort by regular sampling.  Scored rows are written
as locally sorted runs; each run gives every ``spacing``-th row, counted
from a start that differs from run to run; regular positions of the
ordered sample are the splitters.  A row's segment is found among them by
bisection, segments are exchanged and merged locally, and the counts of the
lower segments plus the position in its own give every row its exact rank.
What the driver holds does not grow with the input: the bucket counts, at
most ``MOST_SAMPLES`` sampled keys and one number for each segment.
"""

from __future__ import annotations

import bisect
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import written

# Fixed values of the contract.
BUCKETS = 10_000
GAIN_SCALE = 1_000
SEED = 2024
LEAST_WORDS = 20
PERCENT = 10
# Words of UTF-8 bytes with A-Z lower-cased: every byte from 0x80 up belongs to a word.
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

SEGMENT_ROWS = 4_000  # rows of a segment, about
MOST_SEGMENTS = 4_096
SAMPLES_PER_SEGMENT = 64
MOST_SAMPLES = SAMPLES_PER_SEGMENT * MOST_SEGMENTS
# Entries of a task's table of bucket numbers; emptied when full.
_KNOWN = 1 << 18


def words(data: bytes) -> list[bytes]:
    return _WORD.findall(data.lower())


class _Buckets:
    """Bucket numbers of features, remembered for the frequent ones."""

    def __init__(self, buckets: int, longest: int):
        self.buckets, self.longest, self.known = buckets, longest, {}

    def of(self, found: list[bytes]) -> tuple[np.ndarray, np.ndarray, int]:
        """Buckets, their counts (one entry per distinct feature) and the number of features."""
        counts = Counter(found)
        for n in range(2, self.longest + 1):
            counts.update(b" ".join(found[i : i + n]) for i in range(len(found) - n + 1))
        if len(self.known) > _KNOWN:
            self.known.clear()
        known, at = self.known, []
        for feature in counts:
            b = known.get(feature)
            if b is None:
                b = known[feature] = zlib.crc32(feature) % self.buckets
            at.append(b)
        return np.array(at, np.int64), np.fromiter(counts.values(), np.int64, len(counts)), sum(counts.values())


def bucket_counts(texts: DataFrame, text_col: str = "text", buckets: int = BUCKETS, longest: int = 1) -> np.ndarray:
    """Features of all texts by bucket: each task adds its own up before
    anything moves, so the shuffle holds at most ``buckets`` rows per task."""

    def run(batches):
        table, total = _Buckets(buckets, longest), np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column(0).cast(pa.large_binary()):
                at, n, _ = table.of(words(text.as_py() or b""))
                np.add.at(total, at, n)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])

    found = texts.select(F.col(text_col).cast("string")).mapInArrow(run, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for r in found.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """``floor(1000 ln((t+1)(S+B) / ((s+1)(T+B))))`` of every bucket."""
    buckets = len(source)
    over = float(source.sum() + buckets), float(target.sum() + buckets)
    ratio = ((target + 1).astype(float) * over[0]) / ((source + 1).astype(float) * over[1])
    return np.array([math.floor(GAIN_SCALE * math.log(r)) for r in ratio], np.int64)


def scored(docs: DataFrame, gain: np.ndarray, longest: int = 1, seed: int = SEED, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """``(doc_id, n_words, n_features, weight, score)`` of every row."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        table = _Buckets(len(gain), longest)
        for batch in batches:
            n_words, n_features, weight = [], [], []
            for text in batch.column(1).cast(pa.large_binary()):
                found = words(text.as_py() or b"")
                at, n, whole = table.of(found)
                n_words.append(len(found))
                n_features.append(whole)
                weight.append(int(gain[at] @ n) // whole if whole else 0)
            numbers = [pa.array(x, pa.int64()) for x in (n_words, n_features, weight)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *numbers], ["doc_id", "n_words", "n_features", "weight"])

    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = slim.mapInArrow(run, f"doc_id {kind}, n_words long, n_features long, weight long")
    digest = F.sha2(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    noise = F.floor(-F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))) * GAIN_SCALE)
    return out.withColumn("score", F.col("weight") + noise.cast("long"))


def _splitters(runs: DataFrame, order: list[str], n_rows: int, segment_rows: int) -> list[tuple]:
    """Keys, in order, that cut ``runs`` into even segments: regular samples of the sorted runs, regular positions of those."""
    segments = min(MOST_SEGMENTS, math.ceil(n_rows / segment_rows))
    if segments < 2:
        return []
    spacing = max(1, segment_rows // SAMPLES_PER_SEGMENT, math.ceil(n_rows / MOST_SAMPLES))

    def run(batches):
        # Starts differ from run to run, so that their errors even out.
        skip = None
        for batch in batches:
            if skip is None:
                skip = zlib.crc32(repr(batch.slice(0, 1).to_pylist()).encode()) % spacing
            if skip < batch.num_rows:
                yield batch.take(pa.array(range(skip, batch.num_rows, spacing)))
            skip = (skip - batch.num_rows) % spacing if skip < batch.num_rows else skip - batch.num_rows

    keys = runs.select(*order)
    sample = [tuple(r) for r in keys.mapInArrow(run, keys.schema).collect()]
    sample.sort(key=_sortable)
    cuts = [sample[i * len(sample) // segments] for i in range(1, segments)] if len(sample) >= segments else sample
    return [k for i, k in enumerate(cuts) if i == 0 or k != cuts[i - 1]]


def _sortable(key: tuple) -> tuple:
    return tuple((v is None, 0 if v is None else v) for v in key)


def ranked(rows: DataFrame, order: list[str], segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """``rows`` plus ``rank`` 1, 2, ... in ascending order of the columns
    ``order`` (nulls last), by regular sampling.  Rows alike in all of
    ``order`` are told apart by their place in the runs, so that a group of
    them is split like any other rows."""
    n_rows = rows.count()
    by = [F.asc_nulls_last(c) for c in order]
    runs = written(rows.sortWithinPartitions(*by).withColumn("__place", F.monotonically_increasing_id()))
    order, by = [*order, "__place"], [*by, F.asc("__place")]
    cuts = [_sortable(k) for k in _splitters(runs, order, n_rows, segment_rows)]
    if not cuts:
        runs = runs.withColumn("__segment", F.lit(0))
    else:
        at = [runs.columns.index(c) for c in order]

        def locate(batches):
            for batch in batches:
                keys = zip(*[batch.column(i).to_pylist() for i in at])
                segment = [bisect.bisect_right(cuts, _sortable(k)) for k in keys]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(segment, pa.int32())], [*batch.schema.names, "__segment"])

        schema = T.StructType([*runs.schema.fields, T.StructField("__segment", T.IntegerType())])
        runs = written(runs.mapInArrow(locate, schema))
    sizes = dict(runs.groupBy("__segment").count().collect())
    before, total = [], 0
    for segment in sorted(sizes):
        before += [F.lit(segment), F.lit(total)]
        total += sizes[segment]
    start = F.create_map(*before)[F.col("__segment")] if before else F.lit(0)
    # A segment's sorted pieces are merged, its rows numbered as they pass.
    inside = F.row_number().over(Window.partitionBy("__segment").orderBy(*by))
    return runs.withColumn("rank", (start + inside).cast("long")).drop("__segment", "__place")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS,
             buckets: int = BUCKETS, longest: int = 1, seed: int = SEED, id_col: str = "doc_id",
             text_col: str = "text", target_text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, n_features, weight, score, rank``.

    Of the rows with at least ``least_words`` words the ``percent`` per cent
    (rounded down) with the highest scores are drawn and ranked from 1, ties
    to smaller ids, null ids last; ``rank`` is null for all others.  Features
    are runs of 1 to ``longest`` words.  Null and empty texts have none,
    weigh 0 and are not drawn; rows that repeat an id have the same noise and
    are drawn one by one (those also alike in weight are interchangeable);
    an empty target makes rare words weigh more; empty documents give an
    empty result.  Other columns are not read.
    """
    source = bucket_counts(docs, text_col, buckets, longest)
    gain = gains(source, bucket_counts(target, target_text_col, buckets, longest))
    rows = written(scored(docs, gain, longest, seed, id_col, text_col))
    enough = rows.where(F.col("n_words") >= least_words).withColumn("__down", -F.col("score"))
    drawn = enough.count() * percent // 100
    order = ["__down", "doc_id", "weight", "n_features", "n_words"]
    first = ranked(enough, order).drop("__down").withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    others = rows.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return first.select(*others.columns).union(others)

