"""Katz backoff language model over words, counted and evaluated by Spark.

``P(w | h) = d_c c(h w) / c(h)`` for words seen after the context ``h``, else
``alpha(h) P(w | h')`` with the context ``h'`` that lacks ``h``'s first word,
down to ``P(w) = d_c c(w) / N`` for seen words; the mass the discounts leave
there is the chance of an unknown word.  ``d`` are the level's Good-Turing
discounts for counts up to ``K``, and ``alpha`` is what normalises the
chances after ``h`` exactly: left mass over the lower-order mass of the
words not seen after ``h``.  A context that was never seen has alpha 1.

Text is read once, into chunks of compact token arrays.  A level of the
model is a table of counts partitioned by hash bucket.  Each chunk asks a
bucket about its distinct words (n-grams) and adds its own counts; a bucket
merges all chunks' counts and answers each chunk in the order it asked.
So the shuffles carry distinct words and n-grams of a chunk rather than
tokens, and no task or driver holds a level whole:

1. words -> counts and short ids, and the counts of counts;
2. of every order, n-grams by context -> counts, and per context what alpha needs;
3. every chunk evaluates its tokens, lowest order first, and adds up.

The number of buckets follows from the bytes of the corpus, so a bucket
stays the same size as the corpus grows.  A frequent context is split over
buckets by its next words, in proportion to its count; chunks ask all of
its buckets and add up the parts.
"""

from __future__ import annotations

import itertools
from collections import defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import pack, partitions, small, unpack, written

K = 5  # counts up to K are discounted
CHUNK_TOKENS = 1 << 20  # a chunk ends with the document that passes this many tokens
BASE_ADD = 0.1
_END = b""  # no word is empty
_START = np.uint64(2**64 - 1)  # context before the first word
BUCKET_BYTES = 8 << 20  # text behind one bucket of a level
GROUPS_PER_TASK = 4
_STATE = 0  # level of a chunk's own row; the others' is the order they ask or answer about
_ROW = "chunk long, level int, bucket int, blob binary, stats array<long>"
_NAMES = ["chunk", "level", "bucket", "blob", "stats"]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def discounts(n) -> np.ndarray:
    """``d[0..K]`` from counts of counts ``n[0..K+1]``; where Good-Turing gives
    no value in (0, 1], as on small data, ``(r - 0.5) / r``."""
    d = np.ones(K + 1)
    common = (K + 1) * n[K + 1] / n[1] if n[1] else 1.0
    for r in range(1, K + 1):
        value = ((r + 1) * n[r + 1] / (r * n[r]) - common) / (1 - common) if n[r] and common < 1 else 0.0
        d[r] = value if 0 < value <= 1 else (r - 0.5) / r
    return d


class Words:
    """Chances of single words, from their counts of counts and total."""

    def __init__(self, stats):
        self.counts, self.total, self.vocabulary = stats[: K + 2], stats[K + 2], stats[K + 3]
        self.d = discounts(self.counts)
        left = sum(self.counts[r] * r * (1 - self.d[r]) for r in range(1, K + 1))
        # No discounted word: one more count pays for the unknown ones.
        self.all = self.total if left else self.total + 1
        self.unknown = (left or 1.0) / self.all

    def chance(self, c: np.ndarray) -> np.ndarray:
        return np.where(c > 0, self.d[np.minimum(c, K)] ** (c <= K) * c / self.all, self.unknown)

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + BASE_ADD) / (self.total + BASE_ADD * (self.vocabulary + 1)))


def _count_stats(c: np.ndarray) -> list[int]:
    """Counts of counts 0..K+1, the sum of counts, and how many are over 0."""
    low = np.bincount(np.minimum(c, K + 2).astype(np.int64), minlength=K + 3)[: K + 2]
    return [*low.tolist(), int(c.sum()), int((c > 0).sum())]


def _rows(rows) -> pa.Table:
    columns = list(zip(*rows)) if rows else [[] for _ in _NAMES]
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int64())]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=_NAMES)


# --- 1: chunks and words ----------------------------------------------------------

def _chunk_rows(chunk: int, ids, held, lengths, tokens, words, buckets: int):
    """The chunk's own row and its question to every bucket of words."""
    tokens, held, lengths = np.concatenate(tokens), np.array(held, bool), np.array(lengths, np.int64)
    # Frequent words get the small numbers, which pack well.
    order = np.argsort(-np.bincount(tokens, minlength=len(words)), kind="stable")
    place = np.empty(len(words), np.int64)
    place[order] = np.arange(len(words))
    tokens = place[tokens]
    hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words))[order]
    bucket = (_mix(hashes) % np.uint64(buckets)).astype(np.int64)
    learned = np.bincount(tokens[np.repeat(~held, lengths)], minlength=len(words))
    yield chunk, _STATE, 0, pack(ids, held, lengths, small(tokens), small(bucket)), None
    by_bucket = np.argsort(bucket, kind="stable")
    edges = np.searchsorted(bucket[by_bucket], np.arange(buckets + 1))
    for b in range(buckets):
        mine = by_bucket[edges[b] : edges[b + 1]]
        if len(mine):
            yield chunk, 1, b, pack(hashes[mine], small(learned[mine])), None


def _read_chunks(docs: DataFrame, buckets: int) -> DataFrame:
    """Chunks of ``docs (doc_id, held, text)``, see ``_chunk_rows``."""

    def run(batches):
        first = TaskContext.get().partitionId() << 32
        numbers = itertools.count(first)
        fresh = lambda: ([], [], [], [], defaultdict(itertools.count().__next__))
        ids, held, lengths, tokens, seen = fresh()
        size = 0
        for batch in batches:
            texts = batch.column(2).cast(pa.large_binary())
            for i, h, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts):
                words = (t.as_py() or b"").lower().split()
                words.append(_END)
                ids.append(i)
                held.append(h)
                lengths.append(len(words))
                tokens.append(np.fromiter(map(seen.__getitem__, words), np.int32, len(words)))
                size += len(words)
                if size >= CHUNK_TOKENS:
                    made = _chunk_rows(next(numbers), ids, held, lengths, tokens, list(seen), buckets)
                    yield from _rows(list(made)).to_batches()
                    ids, held, lengths, tokens, seen = fresh()
                    size = 0
        if ids:
            yield from _rows(list(_chunk_rows(next(numbers), ids, held, lengths, tokens, list(seen), buckets))).to_batches()

    return docs.mapInArrow(run, _ROW)


def _answer_words(key: tuple[pa.Scalar, ...], asked: pa.Table) -> pa.Table:
    """One bucket of the word table: total counts and short ids, for every chunk."""
    bucket, parts = key[0].as_py(), [unpack(b) for b in asked.column("blob").to_pylist()]
    hashes = np.concatenate([p[0] for p in parts])
    _, at = np.unique(hashes, return_inverse=True)
    counts = np.bincount(at, np.concatenate([p[1] for p in parts])).astype(np.int64)
    rank = np.empty(len(counts), np.int64)  # frequent words get the small ids
    rank[np.argsort(-counts, kind="stable")] = np.arange(len(counts))
    edges = np.cumsum([0] + [len(p[0]) for p in parts])
    out = [
        (chunk, 1, bucket, pack(small(rank[at[lo:hi]]), small(counts[at[lo:hi]])), None)
        for chunk, lo, hi in zip(asked.column("chunk").to_pylist(), edges, edges[1:])
    ]
    return _rows([*out, (None, 1, bucket, None, _count_stats(counts))])


# --- 2: n-grams -------------------------------------------------------------------

class _Level:
    """The distinct n-grams of one order in a chunk.

    A context is an n-gram of the order below (``below``) that ends before the
    token, or the start of the text, numbered after them.  The n-grams
    are sorted by bucket, context id and word id; ``at`` is each token's.
    ``asks`` are the distinct ``(bucket, context)`` that the chunk asks about,
    also those it has no n-gram for (other buckets of a split context)."""

    def __init__(self, chunk: "_Chunk", below, learned_docs: int, total: int, buckets: int):
        self.below, n, size = below, len(chunk.word_ids), len(below.ids)
        context = np.empty(len(chunk.tokens), np.int32)
        context[1:] = below.at[:-1]
        context[chunk.starts] = size
        codes, at = np.unique(context.astype(np.int64) * n + chunk.tokens, return_inverse=True)
        learned = small(np.bincount(at[np.repeat(~chunk.held, chunk.lengths)], minlength=len(codes)))
        lower = np.empty(len(codes), np.int32)
        lower[at] = below.at
        # A context's own context, one word shorter, where there is one.
        self.context, self.shorter = context, np.zeros(size + 1, np.int64)
        if below.context is not None:
            self.shorter[context] = below.context
        ctx, word = (codes // n).astype(np.int32), (codes % n).astype(np.int32)
        del codes
        ids = np.append(below.ids, _START)
        # A context with over a bucket's even share of all n-grams is split by the next word.
        seen = np.append(below.count, learned_docs)
        splits = (1 + seen / max(1, total) * buckets).astype(np.uint64)
        word_ids = chunk.word_ids[word]
        bucket = self._bucket(ids[ctx], _mix(word_ids) % splits[ctx], buckets).astype(np.int32)
        order = np.lexsort((word_ids, ids[ctx], bucket))
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(len(order))
        self.at, self.ctx, self.words = place[at], ctx[order], word_ids[order]
        self.lower, self.bucket, self.learned, self.ctx_ids = lower[order], bucket[order], learned[order], ids
        used = np.unique(ctx)
        many = splits[used].astype(np.int64)
        asker = np.repeat(used, many)
        part = (np.arange(len(asker)) - np.repeat(np.cumsum(many) - many, many)).astype(np.uint64)
        asked = np.unique(self._bucket(ids[asker], part, buckets) * (size + 1) + asker)
        a_bucket, a_ctx = asked // (size + 1), asked % (size + 1)
        order = np.lexsort((ids[a_ctx], a_bucket))
        self.ask_bucket, self.ask_ctx = a_bucket[order], a_ctx[order]

    @property
    def ids(self) -> np.ndarray:
        """The n-grams' names as contexts of the next order."""
        return _mix(_mix(self.ctx_ids[self.ctx]) + self.words)

    def answered(self, answers) -> None:
        """Take the buckets' answers, which come in the order of the questions."""
        del self.bucket, self.learned
        blobs = [unpack(b) for _, b in sorted(answers, key=lambda a: a[0])]
        self.count = np.concatenate([b[0].astype(np.int64) for b in blobs])
        self.facts = [
            np.bincount(self.ask_ctx, np.concatenate([b[j] for b in blobs]).astype(float), minlength=len(self.ctx_ids))
            for j in range(1, 3 + 2 * K)
        ]

    @staticmethod
    def _bucket(ids, sub, buckets):
        return (_mix(ids + _mix(sub + np.uint64(1))) % np.uint64(buckets)).astype(np.int64)

    def questions(self):
        """``(bucket, contexts as differences, n-grams of each, words, learned counts, counts one order below)``."""
        of = {b: i for i, b in enumerate(np.unique(self.ask_bucket).tolist())}
        firsts = np.searchsorted(self.ask_bucket, list(of))
        lasts = np.append(firsts[1:], len(self.ask_bucket))
        key = np.stack([self.bucket, self.ctx])
        run = np.flatnonzero(np.any(key[:, 1:] != key[:, :-1], axis=0)) + 1
        heads = np.concatenate([[0], run])
        sizes = np.diff(np.append(heads, key.shape[1]))
        width = len(self.ctx_ids)
        with_grams = self.bucket[heads].astype(np.int64) * width + self.ctx[heads]
        grams_of = dict(zip(with_grams.tolist(), sizes.tolist()))
        n_grams = np.array([grams_of.get(x, 0) for x in (self.ask_bucket * width + self.ask_ctx).tolist()], np.int64)
        edges = np.concatenate([[0], np.cumsum(n_grams)])
        for b, lo, hi in zip(of, firsts.tolist(), lasts.tolist()):
            p = slice(edges[lo], edges[hi])
            yield (
                b, small(np.diff(self.ctx_ids[self.ask_ctx[lo:hi]], prepend=np.uint64(0))), small(n_grams[lo:hi]), small(self.words[p]),
                small(self.learned[p]), small(self.below.count[self.lower[p]]),
            )


class _Chunk:
    """A chunk with its words' ids and counts, and its n-grams of every order
    up to one beyond the last that was answered (``order`` at most)."""

    context = None  # of single words

    def __init__(self, rows, total: int, learned_docs: int, buckets: int, order: int):
        answers = defaultdict(list)
        for level, bucket, blob in rows:
            answers[level].append((bucket, blob))
        self.doc_ids, self.held, self.lengths, tokens, owner = unpack(answers.pop(_STATE)[0][1])
        by_bucket = np.argsort(owner, kind="stable")
        blobs = [unpack(b) for _, b in sorted(answers.pop(1), key=lambda a: a[0])]
        rank, self.count = np.empty(len(owner), np.uint64), np.empty(len(owner), np.int64)
        rank[by_bucket] = np.concatenate([b[0].astype(np.uint64) for b in blobs])
        self.count[by_bucket] = np.concatenate([b[1].astype(np.int64) for b in blobs])
        self.ids = self.word_ids = rank * np.uint64(buckets) + owner.astype(np.uint64)
        self.at = self.tokens = tokens.astype(np.int32)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]]).astype(np.int64)
        self.levels, below = [], self
        for n in range(2, order + 1):
            below = _Level(self, below, learned_docs, total, buckets)
            self.levels.append(below)
            if n not in answers:
                break
            below.answered(answers[n])


def _answer_grams(level: int):
    """One bucket of a level's table, for every chunk: the n-grams' total counts,
    and of each context asked about (its part here): its count, how many
    words follow it 1..K times; and of the words that follow it, how many
    n-grams one order below occur 1..K times, and the sum of the other ones'
    counts.  These are whole numbers, so parts of a context add up exactly."""

    def run(key: tuple[pa.Scalar, ...], asked: pa.Table) -> pa.Table:
        bucket, parts = key[0].as_py(), [unpack(b) for b in asked.column("blob").to_pylist()]
        contexts = np.concatenate([np.cumsum(p[0], dtype=np.uint64) for p in parts])
        names, ctx_at = np.unique(contexts, return_inverse=True)
        ctx = np.repeat(ctx_at, np.concatenate([p[1].astype(np.int64) for p in parts]))
        word = np.concatenate([p[2].astype(np.uint64) for p in parts])
        learned = np.concatenate([p[3].astype(np.int64) for p in parts])
        lower = np.concatenate([p[4].astype(np.int64) for p in parts])
        order = np.lexsort((word, ctx))
        c, w = ctx[order], word[order]
        new = np.concatenate([[True], (c[1:] != c[:-1]) | (w[1:] != w[:-1])]) if len(c) else np.zeros(0, bool)
        group = np.cumsum(new) - 1
        total = np.bincount(group, learned[order]).astype(np.int64) if len(c) else np.zeros(0, np.int64)
        at = np.empty(len(order), np.int64)
        at[order] = group
        owner, follows = c[new], total > 0
        size = len(names)
        tables = [np.bincount(owner, total, minlength=size).astype(np.int64)]
        tables += [np.bincount(owner[total == r], minlength=size) for r in range(1, K + 1)]
        below, after = lower[order][new][follows], owner[follows]
        tables += [np.bincount(after[below == r], minlength=size) for r in range(1, K + 1)]
        tables.append(np.bincount(after[below > K], below[below > K], minlength=size).astype(np.int64))
        gram_edges = np.cumsum([0] + [len(p[2]) for p in parts])
        ctx_edges = np.cumsum([0] + [len(p[0]) for p in parts])
        out = []
        for i, chunk in enumerate(asked.column("chunk").to_pylist()):
            mine = ctx_at[ctx_edges[i] : ctx_edges[i + 1]]
            counts = total[at[gram_edges[i] : gram_edges[i + 1]]]
            out.append((chunk, level, bucket, pack(small(counts), *[small(t[mine]) for t in tables]), None))
        return _rows([*out, (None, level, bucket, None, _count_stats(total))])

    return run


# --- 3: evaluation ----------------------------------------------------------------

def _evaluate(chunk: _Chunk, words: Words, stats):
    """Log10 chances: per document ``(base, score, known words)``.  ``stats``
    are the counts of counts of order 2 and up."""
    chance = words.chance(chunk.count)
    d, below_whole = words.d, np.array([words.all], float)
    for level, counted in zip(chunk.levels, stats):
        below_d, d = d, discounts(counted[: K + 2])
        total = level.facts[0]
        lower = sum(level.facts[K + r] * r * below_d[r] for r in range(1, K + 1)) + level.facts[1 + 2 * K]
        lower = lower / below_whole[level.shorter]
        left = sum(level.facts[r] * r * (1 - d[r]) for r in range(1, K + 1))
        # A context whose words are all frequent has nothing left: one more count pays for unseen words.
        whole = np.maximum(np.where(left > 0, total, total + 1), 1)
        alpha = np.where(total > 0, np.where(left > 0, left, 1.0) / whole / np.maximum(1 - lower, 1e-300), 1.0)
        seen = d[np.minimum(level.count, K)] ** (level.count <= K) * level.count / whole[level.ctx]
        chance = np.where(level.count > 0, seen, alpha[level.ctx] * chance[level.lower])
        below_whole = whole
    last = chunk.levels[-1].at if chunk.levels else chunk.tokens
    sums = lambda x: np.add.reduceat(x, chunk.starts)
    known = (chunk.count > 0).astype(np.int64)
    return sums(words.base(chunk.count)[chunk.tokens]), sums(np.log10(chance)[last]), sums(known[chunk.tokens])


def _grouped(df: DataFrame, key: str, groups: int):
    """``df`` by ``key``; with many groups, in as many tasks as they need."""
    tasks = groups // GROUPS_PER_TASK
    return (df.repartition(tasks, key) if tasks > partitions(df.sparkSession) else df).groupBy(key)


def _sum_stats(answers: DataFrame) -> list[int]:
    sums = answers.where("stats IS NOT NULL").select(F.posexplode("stats").alias("i", "x"))
    found = {r[0]: r[1] for r in sums.groupBy("i").agg(F.sum("x")).collect()}
    return [found.get(i, 0) for i in range(K + 4)]


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(10)) == 0, F.lit(False))


def score_documents(docs: DataFrame, held: Column, id_col: str = "doc_id", text_col: str = "text", order: int = 2,
                    bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score``.

    The model, of contexts of up to ``order - 1`` words, learns from the rows
    where ``held`` is false and scores all, whole texts.  Tokens are the
    words (A-Z lower-cased, split at ASCII white space), then one end; null
    and empty texts have the end only.  Rows that repeat an id, or a text,
    are scored and learned one by one; without rows to learn from every
    score is 0; an empty table gives an empty result; other columns are not
    read.  ``bucket_bytes`` of text share a bucket of every level, which one
    task holds at a time.
    """
    if order < 1:
        raise ValueError("order must be at least 1")
    slim = docs.select(F.col(id_col).alias("doc_id"), held.alias("held"), F.col(text_col).alias("text"))
    kind = slim.schema["doc_id"].dataType
    size, learned_docs = slim.agg(F.sum(F.octet_length("text")), F.count_if(~F.col("held"))).first()
    buckets = 1 + (size or 0) // bucket_bytes
    chunks = written(_read_chunks(slim, buckets))
    state = chunks.where(F.col("level") == _STATE)
    n_chunks = state.count()
    word_answers = written(_grouped(chunks.where(F.col("level") == 1), "bucket", buckets).applyInArrow(_answer_words, _ROW))
    words = Words(_sum_stats(word_answers))
    known = state.union(word_answers.where("chunk IS NOT NULL"))

    def chunk_of(rows: pa.Table, up_to: int) -> _Chunk:
        parts = zip(*[rows.column(c).to_pylist() for c in ("level", "bucket", "blob")])
        return _Chunk(parts, words.total, learned_docs, buckets, up_to)

    def asking(level: int):
        def ask(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
            made = chunk_of(rows, level).levels[-1]
            return _rows([(key[0].as_py(), level, b, pack(*q), None) for b, *q in made.questions()])

        return ask

    stats = []
    for level in range(2, order + 1):
        asked = _grouped(known, "chunk", n_chunks).applyInArrow(asking(level), _ROW)
        answers = written(_grouped(asked, "bucket", buckets).applyInArrow(_answer_grams(level), _ROW))
        stats.append(_sum_stats(answers))
        known = known.union(answers.where("chunk IS NOT NULL"))

    schema = T.StructType([
        T.StructField("doc_id", kind), T.StructField("held_out", T.BooleanType()),
        *[T.StructField(n, T.LongType()) for n in ("n_tokens", "n_known", "train_tokens")],
        T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType()),
    ])
    id_type = to_arrow_type(kind)

    def evaluate(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        made = chunk_of(rows, order)
        base, score, n_known = _evaluate(made, words, stats)
        n = len(made.doc_ids)
        ids = pa.array(made.doc_ids, id_type)
        return pa.table(
            [ids, pa.array(made.held), pa.array(made.lengths), pa.array(n_known),
             pa.array(np.full(n, words.total, np.int64)), pa.array(base), pa.array(score)], names=schema.fieldNames()
        )

    return _grouped(known, "chunk", n_chunks).applyInArrow(evaluate, schema)
