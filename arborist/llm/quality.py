"""Quality classifier by compression with two dictionaries.

One zstandard dictionary holds good, one bad labelled text.  A document
is compressed with either, block by block so that the dictionaries count
over the whole of a long text; the difference of the sizes over the bytes
of the text says which one it resembles, and a logistic curve fitted on
other labelled documents turns that into a probability of label 1.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import written

SAMPLE_BYTES = 5 << 20  # of each label's text for its dictionary, at most
SHARES = 16  # a document gives its dictionary at most one part in this many of them
DICTIONARY_BYTES = 1 << 18  # at most
SAMPLE_ROWS = 20_000  # of each label, at most
CALIBRATION_ROWS = 4000  # of each label, at most
BLOCK = 1024
LEVEL = 3
CUT = 0.7


def _dictionary(texts: list[bytes]) -> bytes:
    """Dictionary trained on the texts' blocks; the texts themselves if they
    are too few to train on."""
    blocks = [t[at : at + BLOCK] for t in texts for at in range(0, len(t), BLOCK)]
    size = min(DICTIONARY_BYTES, sum(map(len, texts)) // 16)
    try:
        return zstandard.train_dictionary(size, blocks, threads=0).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(texts)[-DICTIONARY_BYTES:] or b"\n" * 8


def _compressors(dictionaries):
    return [
        zstandard.ZstdCompressor(
            level=LEVEL, dict_data=zstandard.ZstdCompressionDict(d), write_checksum=False, write_content_size=False, write_dict_id=False
        )
        for d in dictionaries
    ]


def size_difference(data: bytes, good, bad) -> float:
    """(bytes with the bad dictionary - with the good one) / bytes of text; 0 for no text."""
    if not data:
        return 0.0
    diff = 0
    for at in range(0, len(data), BLOCK):
        block = data[at : at + BLOCK]
        diff += len(bad.compress(block)) - len(good.compress(block))
    return diff / len(data)


def _differences(docs: DataFrame, dictionaries, emit: list[str], text_col: str = "text") -> DataFrame:
    """The columns ``emit`` of every row of ``docs``, and its ``diff``."""
    read = list(dict.fromkeys([*emit, text_col]))
    at, out = read.index(text_col), [read.index(c) for c in emit]
    schema = T.StructType([*[docs.schema[c] for c in emit], T.StructField("diff", T.DoubleType())])

    def run(batches):
        good, bad = _compressors(dictionaries)
        for batch in batches:
            texts = batch.column(at).cast(pa.large_binary())
            diffs = [size_difference(t.as_py() or b"", good, bad) for t in texts]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in out], pa.array(diffs, pa.float64())], schema.fieldNames())

    return docs.select(*read).mapInArrow(run, schema)


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset by Newton steps, with a slight pull to 0."""
    a = b = 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        g = np.array([np.sum(weight * (y - p) * x) - 1e-3 * a, np.sum(weight * (y - p)) - 1e-3 * b])
        w = weight * p * (1 - p)
        h = np.array([[np.sum(w * x * x) + 1e-3, np.sum(w * x)], [np.sum(w * x), np.sum(w) + 1e-3]])
        step = np.linalg.solve(h, g)
        a, b = a + step[0], b + step[1]
        if abs(step).max() < 1e-9:
            break
    return float(a), float(b)


def _share_bytes() -> int:
    return max(1, SAMPLE_BYTES // SHARES // BLOCK) * BLOCK


def _share(data: bytes, most: int) -> bytes:
    """The text, or blocks from all over it if it is longer than ``most`` bytes."""
    if len(data) <= most:
        return data
    n = most // BLOCK
    starts = [i * (len(data) - BLOCK) // max(1, n - 1) for i in range(n)]
    return b"".join(data[at : at + BLOCK] for at in starts)


def _shares(texts: DataFrame, most: int) -> DataFrame:
    """``(quality, h, data)``: what every row gives its label's dictionary."""

    def run(batches):
        for batch in batches:
            data = [_share(t.as_py(), most) for t in batch.column(2).cast(pa.large_binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(data, pa.binary())], ["quality", "h", "data"])

    return texts.select(F.col("quality").cast("int"), "h", "text").mapInArrow(run, "quality int, h string, data binary")


def _sample(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, dict]:
    """``(doc_id, bytes, mark, quality, half, h)`` of the rows to learn from, and
    the counts of the labelled rows by (quality, half).  Only ids, labels, lengths
    and hashes of the texts are joined; half 0 feeds the dictionaries, half 1 the
    calibration.  Rows are picked for themselves (equal ones once), not by id."""
    known = labels.where("quality IN (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    slim = docs.select("doc_id", F.octet_length("text").alias("bytes"), F.xxhash64("text").alias("mark")).where("bytes > 0")
    text = F.col("doc_id").cast("string")
    half = F.pmod(F.crc32(F.concat(F.lit("half"), text)), F.lit(2)).cast("int")
    h = F.md5(F.concat_ws(":", text, F.col("mark").cast("string")))
    rows = slim.join(known, "doc_id").groupBy("doc_id", "bytes", "mark", "quality").agg(F.count(F.lit(1)).alias("n"))
    rows = written(rows.withColumn("half", half).withColumn("h", h))
    counts = {(r[0], r[1]): r[2] for r in rows.groupBy("quality", "half").agg(F.sum("n")).collect()}
    picked = []
    for q in (0, 1):
        for part, most in ((0, SAMPLE_ROWS), (1, CALIBRATION_ROWS)):
            mine = rows.where((F.col("quality") == q) & (F.col("half") == part))
            picked.append(mine.orderBy("h", "doc_id", "bytes").limit(most))
    drawn = picked[0].union(picked[1]).union(picked[2]).union(picked[3]).drop("n")
    # The dictionaries' rows end where their bytes do; a label has SAMPLE_ROWS rows at most here.
    # A long text counts by its share, so the first row always fits and the sample ends nearly full.
    upto = Window.partitionBy("quality", "half").orderBy("h", "doc_id", "bytes")
    drawn = drawn.withColumn("upto", F.sum(F.least("bytes", F.lit(_share_bytes()))).over(upto))
    drawn = drawn.where((F.col("half") == 1) | (F.col("upto") <= max(SAMPLE_BYTES, _share_bytes())))
    return written(drawn.drop("upto")), counts


def fit(docs: DataFrame, labels: DataFrame) -> dict:
    """Model learned from the rows of ``docs`` that ``labels (doc_id, quality)``
    marks 0 or 1 (the least one if it repeats an id); other labels, null
    ids and texts without bytes are left out.  The dictionaries and the
    calibration use different documents, both in hash order up to the
    module's bounds (a long text gives a dictionary blocks from all over it); the calibration weighs the labels by their true
    counts.  If a label is missing, every score is the share of label 1
    (0.5 without labels)."""
    drawn, sizes = _sample(docs, labels)
    counts = [sum(v for k, v in sizes.items() if k[0] == q) for q in (0, 1)]
    if any((q, half) not in sizes for q in (0, 1) for half in (0, 1)):
        return {"share": counts[1] / sum(counts) if sum(counts) else 0.5}
    # At most 2 * (SAMPLE_ROWS + CALIBRATION_ROWS) rows; copies of one count once.
    marked = docs.select("doc_id", "text", F.octet_length("text").alias("bytes"), F.xxhash64("text").alias("mark"))
    texts = marked.join(F.broadcast(drawn), ["doc_id", "bytes", "mark"]).dropDuplicates(["doc_id", "bytes", "mark"])
    samples: dict[int, list[bytes]] = {0: [], 1: []}
    for q, _, data in _shares(texts.where("half = 0"), _share_bytes()).orderBy("h", "data").collect():
        samples[q].append(bytes(data))
    both = (_dictionary(samples[1]), _dictionary(samples[0]))
    points = np.array([tuple(r) for r in _differences(texts.where("half = 1"), both, ["quality"]).collect()], float)
    y, x = points[:, 0], points[:, 1]
    spread = float(x.std()) or 1.0
    weight = np.where(y == 1, counts[1] / max(1, (y == 1).sum()), counts[0] / max(1, (y == 0).sum())) / sum(counts) * len(y)
    a, b = _logistic(x / spread, y, weight)
    return {"dictionaries": both, "slope": a / spread, "offset": b}


def _scored(docs: DataFrame, model: dict, emit: list[str], text_col: str = "text") -> DataFrame:
    if "share" in model:
        return docs.select(*emit, F.lit(float(model["share"])).alias("score"))
    diffs = _differences(docs, model["dictionaries"], emit, text_col)
    logit = F.col("diff") * F.lit(model["slope"]) + F.lit(model["offset"])
    return diffs.select(*emit, (1 / (1 + F.exp(-logit))).alias("score"))


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, score, predicted)`` for every row: ``score`` is the chance of
    label 1, from the whole text; null and empty texts have a difference of
    0; equal texts have equal scores; an empty table gives an empty result."""
    out = _scored(docs.select(id_col, text_col), model, [id_col], text_col)
    return out.select(F.col(id_col).alias("doc_id"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


def accepted(docs: DataFrame, model: dict) -> DataFrame:
    """The rows of ``docs`` whose score reaches the cut, with all their columns."""
    plain = [f"c{i}" for i in range(len(docs.columns))]  # a clash with ``score`` or ``diff`` is no matter
    text = plain[docs.columns.index("text")]
    return _scored(docs.toDF(*plain), model, plain, text).where(F.col("score") >= CUT).select(*plain).toDF(*docs.columns)


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(4)) == 2, F.lit(False))
