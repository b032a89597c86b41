"""Toxic documents and the sentences that make them so, from document labels only.

Multiple-instance learning: a document is toxic if at least one of its
sentences is. A sentence scores the logistic function of the sum of the
weights of its hashed words, and the scores of a document combine by
noisy-or, 1 - prod(1 - p). The weights are fitted to the document labels
through that combination, so the sentences need no labels.

The fit uses a bounded sample of labelled documents (``max_toxic``,
``max_clean``, chosen by hash of the id), weighted back to the proportions of
all labelled rows; scoring reads every whole text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytesops as B

BITS = 18
MAX_TOXIC = 3000
MAX_CLEAN = 5000
FOLDS = 5
MIN_TEXTS = 5  # sampled texts that must hold a feature
PASSES = 120
SPARSITY = 5e-5

# letters, digits and all bytes of longer UTF-8 sequences; the rest parts words
_WORD = np.zeros(256, dtype=bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_BREAK = np.zeros(256, dtype=np.int64)
_BREAK[[10, 33, 46, 63]] = 1  # \n ! . ?


def sentence_words(data, offsets, powers, bits: int = BITS):
    """Feature, sentence and text of every word; sentences are numbered in order, (first, end) bytes of each word too."""
    none = np.zeros(0, dtype=np.int64)
    if not len(data):
        return none, none, none, none, none
    inside = _WORD[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edge = offsets[(offsets > 0) & (offsets < len(data))]
    first[edge], last[edge - 1] = inside[edge], inside[edge - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    text = np.searchsorted(offsets, starts, side="right") - 1
    hashes = B.word_hashes(data, starts, ends, powers)
    # a sentence is named by the breaks before it and its text
    breaks = np.cumsum(_BREAK[data])[starts]
    new = np.concatenate([[False], (breaks[1:] != breaks[:-1]) | (text[1:] != text[:-1])]) if len(starts) else none
    return (hashes >> np.uint64(64 - bits)).astype(np.int64), np.cumsum(new), text, starts, ends


def sentence_scores(feature, sentence, weights: np.ndarray, bias: float) -> np.ndarray:
    n = int(sentence[-1]) + 1 if len(sentence) else 0
    z = np.bincount(sentence, weights=weights[feature], minlength=n) + bias
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def noisy_or(p: np.ndarray, text_of_sentence: np.ndarray, texts: int) -> np.ndarray:
    return -np.expm1(np.bincount(text_of_sentence, weights=np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=texts))


def fit(feature, sentence, text, labels: np.ndarray, sample_weight: np.ndarray, bits: int = BITS, passes: int = PASSES,
        rate: float = 0.2, sparsity: float = SPARSITY) -> tuple[np.ndarray, float]:
    """Weights and bias by full-batch gradient steps with Adam on the noisy-or likelihood.

    The weights are shrunk towards zero by ``sparsity`` (an L1 penalty), so
    words without a clear part in the labels get none.
    """
    size = 1 << bits
    if not len(feature) or labels.min() == labels.max():  # nothing to learn from
        return np.zeros(size), -30.0 if not labels.any() else 0.0
    pairs = np.unique(feature * len(labels) + text) // len(labels)
    common = np.flatnonzero(np.bincount(pairs, minlength=size) >= MIN_TEXTS)
    place = np.full(size, -1)
    place[common] = np.arange(len(common))
    col = place[feature]
    seen = col >= 0
    col, row = col[seen], sentence[seen]
    sentences = int(sentence[-1]) + 1
    owner = np.zeros(sentences, dtype=np.int64)
    owner[sentence] = text
    w, bias = np.zeros(len(common)), -4.0
    first, second = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    total = sample_weight.sum()
    for step in range(1, passes + 1):
        z = np.bincount(row, weights=w[col], minlength=sentences) + bias
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        clean = np.exp(np.bincount(owner, weights=np.log1p(-np.minimum(p, 1 - 1e-9)), minlength=len(labels)))
        pull = np.where(labels == 1, -clean / np.maximum(1 - clean, 1e-9), 1.0) * sample_weight / total
        g = p * pull[owner]
        grad = np.append(np.bincount(col, weights=g[row], minlength=len(w)), g.sum())
        first = 0.9 * first + 0.1 * grad
        second = 0.99 * second + 0.01 * grad * grad
        pace = rate / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-5)
        move = pace * first / (1 - 0.9 ** step)
        w, bias = w - move[:-1], bias - move[-1]
        w = np.sign(w) * np.maximum(np.abs(w) - sparsity * pace[:-1], 0)
    weights = np.zeros(size)
    weights[common] = w
    return weights, float(bias)


def training_ids(labels: DataFrame, folds: int, max_toxic: int, max_clean: int) -> DataFrame:
    """(doc_id, toxic) of the sample, at most ``max_toxic + max_clean`` rows, never from the held-out fold."""
    known = (labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
             .filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds != 0))
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    return known.filter("toxic = 1").orderBy(*order).limit(max_toxic).unionByName(
        known.filter("toxic = 0").orderBy(*order).limit(max_clean))


def _features(bits: int):
    def run(batches):
        powers = B.Powers()
        for batch in batches:
            for rows, data, offsets in B.pieces(batch):
                feature, sentence, text, _, _ = sentence_words(data, offsets, powers, bits)
                at = np.searchsorted(text, np.arange(len(offsets)))
                own = [(feature[i:j], sentence[i:j] - (sentence[i] if i < j else 0)) for i, j in zip(at[:-1], at[1:])]
                yield pa.RecordBatch.from_arrays(
                    [rows.column("toxic"), pa.array([f.astype("<i4").tobytes() for f, _ in own], type=pa.binary()),
                     pa.array([s.astype("<i4").tobytes() for _, s in own], type=pa.binary())], names=["toxic", "feature", "sentence"])

    return run


def train(docs: DataFrame, labels: DataFrame, folds: int = FOLDS, max_toxic: int = MAX_TOXIC, max_clean: int = MAX_CLEAN,
          bits: int = BITS) -> tuple[np.ndarray, float]:
    """Weights and bias from the sample. Without labelled documents of both kinds every score is 0 or 1/2.

    Of several rows with a sampled doc_id, the one with the smallest text hash is taken.
    """
    sample = training_ids(labels, folds, max_toxic, max_clean)
    # the sample has a fixed bound, so the texts stay where they are
    rows = (docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
            .groupBy("doc_id", "toxic").agg(F.min_by("text", F.xxhash64("text")).alias("text")).orderBy("doc_id").select("toxic", "text")
            .mapInArrow(_features(bits), "toxic int, feature binary, sentence binary").toArrow().to_pydict())
    counts = dict(labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
                  .filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds != 0).groupBy("toxic").count().collect())
    target = np.array(rows["toxic"], dtype=np.int64)
    if not len(target):
        return np.zeros(1 << bits), -30.0
    feature = [np.frombuffer(f, dtype="<i4").astype(np.int64) for f in rows["feature"]]
    sentence, text, n = [], [], 0
    for i, s in enumerate(rows["sentence"]):
        s = np.frombuffer(s, dtype="<i4").astype(np.int64)
        sentence.append(s + n)
        text.append(np.full(len(s), i))
        n += int(s[-1]) + 1 if len(s) else 0
    share = np.array([max(1, counts.get(k, 0)) / max(1, (target == k).sum()) for k in (0, 1)])
    return fit(*(np.concatenate(x) for x in (feature, sentence, text)), target, share[target], bits)


def _scored(weights: np.ndarray, bias: float, bits: int):
    kept = np.flatnonzero(weights)
    values = weights[kept]

    def run(batches):
        powers, full = B.Powers(), np.zeros(1 << bits)
        full[kept] = values
        for batch in batches:
            for rows, data, offsets in B.pieces(batch):
                n = rows.num_rows
                feature, sentence, text, starts, ends = sentence_words(data, offsets, powers, bits)
                p = sentence_scores(feature, sentence, full, bias)
                first = np.flatnonzero(np.concatenate([[True], sentence[1:] != sentence[:-1]])) if len(sentence) else np.zeros(0, dtype=np.int64)
                last = np.concatenate([first[1:], [len(sentence)]]).astype(np.int64) - 1 if len(first) else first
                owner = text[first]
                score = noisy_or(p, owner, n)
                bad = p >= 0.5
                count = np.bincount(owner[bad], minlength=n)
                # the worst sentence of each text: the last of its sentences in order of score
                order = np.lexsort((-first, p, owner))
                worst = order[np.flatnonzero(np.concatenate([owner[order][1:] != owner[order][:-1], [True]]))] if len(order) else order
                start, end = np.zeros(n, dtype=np.int32), np.zeros(n, dtype=np.int32)
                start[owner[worst]] = starts[first[worst]] - offsets[owner[worst]]
                end[owner[worst]] = ends[last[worst]] - offsets[owner[worst]]
                spans = [[] for _ in range(n)]
                for s in np.flatnonzero(bad).tolist():
                    i = int(owner[s])
                    spans[i].append({"start": int(starts[first[s]] - offsets[i]), "end": int(ends[last[s]] - offsets[i]), "score": float(p[s])})
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), pa.array(score), pa.array(count.astype(np.int32)), pa.array(start), pa.array(end),
                     pa.array(spans, type=pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])))],
                    names=["doc_id", "score", "n_offending", "worst_start", "worst_end", "offending"])

    return run


def score(docs: DataFrame, weights: np.ndarray, bias: float, bits: int = BITS) -> DataFrame:
    """doc_id, score, n_offending, the byte span of the worst sentence, and the spans of all sentences of 0.5 or more.

    Null and empty texts and texts without words have no sentences and score
    0, with an empty span. Rows without doc_id and repeated rows are scored
    like all others; extra columns are ignored. Nothing but the text is used.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _scored(weights, bias, bits),
        "doc_id bigint, score double, n_offending int, worst_start int, worst_end int, offending array<struct<start:int,end:int,score:double>>")


def judge(docs: DataFrame, labels: DataFrame, folds: int = FOLDS, **kw) -> DataFrame:
    """``score`` with held_out (the fold that training never sees) and predicted."""
    weights, bias = train(docs, labels, folds, **kw)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == 0, F.lit(False))
    return score(docs, weights, bias).withColumns({"held_out": held, "predicted": (F.col("score") >= 0.5).cast("int")})
