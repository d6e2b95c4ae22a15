"""Language by nearest centroid over TF-IDF vectors of character n-grams.

A text's vector counts its byte n-grams of 1 to 3 in a hashed space,
damped by the square root, weighted by inverse document frequency and
scaled to length 1.  Each language has several centroids, found by
spherical k-means on a bounded sample of its documents; a text takes the
language of the centroid with the greatest cosine, and is marked as
rejected when it is farther from it than nearly all documents the model
learned from.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIMS = 1 << 12
SAMPLE_ROWS = 4000  # labelled documents the centroids are fitted on, at most
SAMPLE_BYTES = 24 << 20  # their text, at most
BLOCKS = 64  # documents of a language, at least, that its room holds
CENTROIDS = 3  # per language
ROUNDS = 8
REJECT_SHARE = 0.001  # of the learned documents would be rejected
UNKNOWN = "und"
_PIECE = 1 << 20
_LETTER = regex.compile(r"\p{L}")
_ASCII_LETTERS = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


def gram_counts(text: str) -> np.ndarray:
    """Counts of the hashed 1-, 2- and 3-grams of bytes of the whole
    lower-cased text; ASCII characters that are no letters only part words,
    each marked by one blank on either side."""
    words = text.lower().encode("utf-8", "replace").translate(_ASCII_LETTERS).split()
    data = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8)
    counts = np.zeros(DIMS, np.int64)
    for at in range(0, len(data), _PIECE):
        b = data[at : at + _PIECE + 2].astype(np.uint32)
        n = min(_PIECE, len(b))
        codes = [b[:n]]
        if len(b) > 1:
            codes.append(b[: len(b) - 1][:n] * 257 + b[1:][:n] + 1)
        if len(b) > 2:
            codes.append((b[: len(b) - 2][:n] * 257 + b[1:-1][:n]) * 257 + b[2:][:n] + 2)
        for c in codes:
            counts += np.bincount((c * np.uint32(2654435761)) >> np.uint32(20), minlength=DIMS)
    return counts


def _vectors(texts, idf: np.ndarray) -> np.ndarray:
    out = np.zeros((len(texts), DIMS), np.float32)
    for i, t in enumerate(texts):
        v = np.sqrt(gram_counts(t)) * idf
        norm = np.linalg.norm(v)
        if norm:
            out[i] = v / norm
    return out


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """Documents with each gram, and their number, over all of ``texts``:
    summed within partitions, then by gram; DIMS + 1 numbers reach the driver."""

    def run(batches):
        seen = np.zeros(DIMS + 1, np.int64)
        for batch in batches:
            for t in batch.column(0):
                seen[:DIMS] += gram_counts(t.as_py()) > 0
                seen[DIMS] += 1
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(seen[at])], ["gram", "n"])

    found = texts.mapInArrow(run, "gram int, n long").groupBy("gram").agg(F.sum("n")).collect()
    out = np.zeros(DIMS + 1, np.int64)
    for gram, n in found:
        out[gram] = n
    return out[:DIMS], int(out[DIMS])


def _centroids(x: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means; starts far apart, so reruns agree."""
    centres = [x.mean(0)]
    centres[0] = centres[0] / (np.linalg.norm(centres[0]) or 1)
    for _ in range(min(k, len(x)) - 1):
        centres.append(x[np.argmin((x @ np.array(centres).T).max(1))])
    c = np.array(centres)
    for _ in range(ROUNDS):
        near = (x @ c.T).argmax(1)
        for j in range(len(c)):
            if (near == j).any():
                m = x[near == j].mean(0)
                c[j] = m / (np.linalg.norm(m) or 1)
    return c


def fit(labelled: DataFrame) -> dict:
    """Model of ``labelled (doc_id, text, lang)``.  Rows without a language
    or letters are left out.  Document frequencies cover all rows; the
    centroids are fitted on a sample of at most SAMPLE_ROWS documents and
    SAMPLE_BYTES, shared out evenly: each language has its own rows and
    its own room, whatever the sizes of the others, and a long document
    gives a block from somewhere in it, at most 1 / BLOCKS of the room."""
    labelled = labelled.where("lang IS NOT NULL AND text IS NOT NULL AND text <> ''")
    df, n = document_frequencies(labelled.select("text"))
    langs = {r[0]: r[1] for r in labelled.groupBy("lang").count().collect()}
    if not langs:
        return {}
    idf = (np.log((1 + n) / (1 + df)) + 1).astype(np.float32)
    each, room = max(1, SAMPLE_ROWS // len(langs)), SAMPLE_BYTES // len(langs)
    block = max(1, room // BLOCKS // 4)  # characters, of up to 4 bytes
    digest = F.md5(F.concat_ws(":", F.lit("lang"), F.col("doc_id").cast("string"), F.md5("text")))
    number = lambda at: F.conv(F.substring("digest", at, 8), 16, 10).cast("long")
    share = F.lit(0.0)
    for lang, count in langs.items():
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, 2.0 * each / count + 10 / count))).otherwise(share)
    # Three parts of the digest: who is drawn, in which order, and where the block starts.
    drawn = labelled.withColumn("digest", digest).where(number(1) / F.lit(float(1 << 32)) < share).where(F.col("text").rlike(r"\p{L}"))
    start = number(17) % F.greatest(F.length("text") - block + 1, F.lit(1)) + 1
    drawn = drawn.select("lang", number(9).alias("rank"), F.substring("text", start.cast("int"), F.lit(block)).alias("text"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("rank", "text"))
    sample = drawn.withColumn("place", place).where(F.col("place") <= each).orderBy("lang", "place").select("lang", "text")
    taken, left = {lang: [] for lang in langs}, {lang: room for lang in langs}
    for lang, text in sample.toLocalIterator():
        size = len(text.encode())
        if size <= left[lang] and _LETTER.search(text):
            taken[lang].append(text)
            left[lang] -= size
    names, centres, cosines = [], [], []
    for lang in sorted(langs):
        if taken[lang]:
            x = _vectors(taken[lang], idf)
            c = _centroids(x, CENTROIDS)
            names += [lang] * len(c)
            centres.append(c)
            cosines.append((x @ c.T).max(1))
    if not names:
        return {}
    far = float(np.quantile(np.concatenate(cosines), REJECT_SHARE))
    return {"idf": idf, "centres": np.concatenate(centres), "names": names, "far": far}


def predict(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, lang_pred, score, rejected)`` for every row.

    ``lang_pred`` is the language of the nearest centroid and ``score`` its
    cosine, from the whole text; null texts, texts without letters, and all
    texts if nothing was learned, are ``und`` with score 0 and rejected.
    ``rejected`` marks texts farther from all centroids than the model's
    distance bound.  Ties go to the first language by name.
    """
    kind = docs.schema[id_col].dataType
    schema = T.StructType([
        T.StructField("doc_id", kind), T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType()),
    ])

    def run(batches):
        for batch in batches:
            langs, scores = [], []
            for t in batch.column(1):
                text = t.as_py()
                if not model or text is None or not _LETTER.search(text):
                    langs.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                cosine = model["centres"] @ _vectors([text], model["idf"])[0]
                best = int(cosine.argmax())
                langs.append(model["names"][best])
                scores.append(min(1.0, max(0.0, float(cosine[best]))))
            rejected = [s < model.get("far", 2.0) for s in scores]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())],
                schema.fieldNames(),
            )

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(5)) == 0, F.lit(False))
