"""Language of a text in two steps: its family, then the language among its close relatives.

A text is a vector of hashed character runs (one to four bytes of the
lower-case text, other characters than letters as blanks), logarithms of their
counts, scaled to length one. Linear support vector machines separate the
families pairwise, and within each family its languages pairwise; the class
with most votes wins, and of equal ones that with the larger margins.

The machines are fitted by dual coordinate descent on a bounded sample: at most
``per_lang`` distinct texts of each learned language, the ones with the lowest
hashes. Predictions read every whole text.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperlake.runtime import small_side

from . import bytesops as B

# fixed values: families of language codes; a code that is not listed is a family of its own
FAMILIES = {
    "germanic": ["de", "en", "nl", "af", "sv", "da", "no", "nb", "nn", "is"],
    "romance": ["fr", "es", "it", "pt", "ca", "gl", "ro"],
    "slavic": ["ru", "uk", "be", "bg", "mk", "sr", "hr", "bs", "sl", "cs", "sk", "pl"],
    "uralic": ["fi", "et", "hu"],
    "turkic": ["tr", "az", "kk", "uz"],
}
BITS = 14
ORDERS = (1, 2, 3, 4)
PER_LANG = 800
FOLDS, HELD_OUT = 4, 2
PENALTY = 4.0  # weight of the losses against the norm
SHARP = 4.0  # margin 1 counts as a probability of 0.98
_TEXTS = 256  # texts of one dense block of counts

_LETTER = np.full(256, 32, dtype=np.uint8)
_LETTER[[*range(97, 123), *range(128, 256)]] = [*range(97, 123), *range(128, 256)]


def families_of(langs, families: dict[str, list[str]] = FAMILIES) -> dict[str, str]:
    known = {code: name for name, codes in families.items() for code in codes}
    return {lang: known.get(lang, "=" + lang) for lang in langs}


# --- features --------------------------------------------------------------

def runs_of(data: np.ndarray, offsets: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Feature and text of every character run of lower-case texts; a lone blank and runs with two blanks side by side are left out."""
    if not len(data):
        none = np.zeros(0, dtype=np.int64)
        return none, none
    letters = _LETTER[data]
    value = letters.astype(np.uint64)
    ends = np.repeat(offsets[1:], np.diff(offsets))
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    blank = letters == 32
    at = np.arange(len(data))
    features, owners = [], []
    code, doubled = np.zeros(len(data), dtype=np.uint64), blank.copy()
    for order in range(1, max(ORDERS) + 1):
        shifted = np.zeros(len(data), dtype=np.uint64)
        shifted[:len(data) - order + 1] = value[order - 1:]
        code = code | shifted << np.uint64(8 * (order - 1))
        if order > 1:
            after = np.ones(len(data), dtype=bool)
            after[:len(data) - order + 1] = (blank[order - 2:-1] & blank[order - 1:])
            doubled = after if order == 2 else doubled | after
        if order in ORDERS:
            keep = np.flatnonzero(~doubled & (at + order <= ends))
            mixed = (code[keep] + np.uint64(order)) * np.uint64(0x9E3779B97F4A7C15)
            features.append((mixed ^ mixed >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - bits))
            owners.append(text[keep])
    return np.concatenate(features).astype(np.int64), np.concatenate(owners)


def vectors_of(data: np.ndarray, offsets: np.ndarray, bits: int = BITS) -> np.ndarray:
    """One row of unit length per text; a text without letters has only zeros."""
    n = len(offsets) - 1
    feature, text = runs_of(data, offsets, bits)
    counts = np.bincount(text << bits | feature, minlength=n << bits).reshape(n, 1 << bits).astype(np.float32)
    np.log1p(counts, out=counts)
    size = np.sqrt(np.einsum("ij,ij->i", counts, counts))
    counts /= np.maximum(size, 1e-9)[:, None]
    return counts


def _blocks(batch: pa.RecordBatch, text: str):
    """Runs of rows with at most ``_TEXTS`` texts and about a piece of bytes."""
    for rows, data, offsets in B.pieces(batch, text):
        for at in range(0, rows.num_rows, _TEXTS):
            cut = offsets[at:at + _TEXTS + 1]
            yield rows.slice(at, _TEXTS), data[cut[0]:cut[-1]], cut - cut[0]


# --- support vector machines -----------------------------------------------

def svm(rows: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray, size: int, penalty: float = PENALTY, passes: int = 30,
        tolerance: float = 1e-2) -> np.ndarray:
    """Weights of a linear machine with squared hinge loss, by dual coordinate descent; ``target`` is 1 or -1.

    Losses are weighted so that both classes count alike.
    """
    w, alpha = np.zeros(size), np.zeros(len(rows))
    share = len(rows) / 2 / np.maximum(np.array([(target < 0).sum(), (target > 0).sum()]), 1)
    ridge = 1 / (2 * penalty * share[(target > 0).astype(int)])
    norm = np.array([float(v @ v) for _, v in rows]) + ridge
    order = np.random.default_rng(0)
    for _ in range(passes):
        worst = 0.0
        for i in order.permutation(len(rows)).tolist():
            at, v = rows[i]
            slope = target[i] * float(w[at] @ v) - 1 + alpha[i] * ridge[i]
            if alpha[i] > 0 or slope < 0:
                worst = max(worst, abs(slope))
                new = max(alpha[i] - slope / norm[i], 0.0)
                w[at] += (new - alpha[i]) * target[i] * v
                alpha[i] = new
        if worst < tolerance:
            break
    return w


@dataclass
class Pairwise:
    """Machines between all pairs of classes."""

    classes: list[str]
    weights: np.ndarray  # one column per pair, in the order of combinations(classes, 2)

    @classmethod
    def fit(cls, rows, labels: list[str], size: int) -> "Pairwise":
        classes = sorted(set(labels))
        columns = []
        for a, b in combinations(classes, 2):
            pick = [i for i, c in enumerate(labels) if c in (a, b)]
            columns.append(svm([rows[i] for i in pick], np.array([1 if labels[i] == a else -1 for i in pick]), size))
        return cls(classes, np.stack(columns, axis=1).astype(np.float32) if columns else np.zeros((size, 0), dtype=np.float32))

    def decide(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Class and its score (mean of the logistic margins against the others, 1 without others) of each row."""
        k = len(self.classes)
        margins = (x @ self.weights).astype(np.float64)
        votes, backing = np.zeros((len(x), k)), np.zeros((len(x), k))
        for column, (a, b) in enumerate(combinations(range(k), 2)):
            p = 1 / (1 + np.exp(-np.clip(SHARP * margins[:, column], -30, 30)))
            votes[:, a] += p >= 0.5
            votes[:, b] += p < 0.5
            backing[:, a] += p
            backing[:, b] += 1 - p
        best = np.argmax(votes + backing / (k + 1), axis=1) if len(x) else np.zeros(0, dtype=np.int64)
        return best, backing[np.arange(len(x)), best] / (k - 1) if k > 1 else np.ones(len(x))


@dataclass
class Model:
    bits: int
    families: Pairwise
    languages: dict[str, Pairwise]

    def predict(self, x: np.ndarray) -> tuple[list[str], list[str], np.ndarray]:
        """Language, family and score of each row."""
        family, score = self.families.decide(x)
        langs, names = np.empty(len(x), dtype=object), np.array(self.families.classes, dtype=object)[family]
        for f, name in enumerate(self.families.classes):
            rows = np.flatnonzero(family == f)
            inner = self.languages[name]
            best, part = inner.decide(x[rows])
            langs[rows] = np.array(inner.classes, dtype=object)[best]
            score[rows] *= part
        return langs.tolist(), names.tolist(), score


# --- the operator ----------------------------------------------------------

def _sparse(bits: int):
    def run(batches):
        for batch in batches:
            for rows, data, offsets in _blocks(batch, "text"):
                x = vectors_of(data, offsets, bits)
                at = [np.flatnonzero(r) for r in x]
                yield pa.RecordBatch.from_arrays(
                    [rows.column("lang"), pa.array([a.astype("<i4").tobytes() for a in at], type=pa.binary()),
                     pa.array([r[a].astype("<f4").tobytes() for r, a in zip(x, at)], type=pa.binary())], names=["lang", "at", "value"])

    return run


def fold(doc_id: str = "doc_id", folds: int = FOLDS):
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds


def sample_texts(docs: DataFrame, per_lang: int, folds: int = FOLDS, held_out: int = HELD_OUT) -> DataFrame:
    """(lang, text): at most ``per_lang`` distinct texts of each language outside the held-out fold."""
    known = docs.filter("lang is not null and text is not null").filter(fold(folds=folds) != held_out).filter(F.col("text").rlike("\\p{L}"))
    known = known.select("lang", "text", F.xxhash64("text").alias("key"))
    keys = known.select("lang", "key").distinct()
    # the lowest hashes per language are cut in every task before they meet
    chosen = keys.withColumn("rank", F.expr("row_number() over (partition by lang order by key)")).filter(F.col("rank") <= per_lang).drop("rank")
    return known.join(small_side(chosen), ["lang", "key"]).groupBy("lang", "key").agg(F.min("text").alias("text")).select("lang", "text")


def train(docs: DataFrame, per_lang: int = PER_LANG, families: dict[str, list[str]] = FAMILIES, bits: int = BITS,
          folds: int = FOLDS, held_out: int = HELD_OUT) -> Model | None:
    """The machines of all families and languages; None where there is nothing to learn from."""
    table = sample_texts(docs, per_lang, folds, held_out).withColumn("text", F.lower("text")).mapInArrow(
        _sparse(bits), "lang string, at binary, value binary").toArrow().to_pydict()
    # a fixed order, so that equal tables give equal machines
    order = sorted(range(len(table["lang"])), key=lambda i: (table["lang"][i], table["at"][i], table["value"][i]))
    langs = [table["lang"][i] for i in order]
    if not langs:
        return None
    rows = [(np.frombuffer(table["at"][i], dtype="<i4"), np.frombuffer(table["value"][i], dtype="<f4").astype(np.float64)) for i in order]
    family = families_of(set(langs), families)
    top = Pairwise.fit(rows, [family[c] for c in langs], 1 << bits)
    inner = {}
    for name in top.classes:
        pick = [i for i, c in enumerate(langs) if family[c] == name]
        inner[name] = Pairwise.fit([rows[i] for i in pick], [langs[i] for i in pick], 1 << bits)
    return Model(bits, top, inner)


def _predicted(model: Model | None):
    def run(batches):
        for batch in batches:
            for rows, data, offsets in _blocks(batch, "text"):
                n = rows.num_rows
                langs, names, score = ["und"] * n, [None] * n, np.zeros(n)
                known = np.flatnonzero(rows.column("lettered").to_numpy(zero_copy_only=False))
                if model is not None and len(known):
                    x = vectors_of(data, offsets, model.bits)[known]
                    found, family, p = model.predict(x)
                    score[known] = p
                    for i, lang, name in zip(known.tolist(), found, family):
                        langs[i], names[i] = lang, name
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), pa.array(langs, type=pa.string()), pa.array(names, type=pa.string()), pa.array(score)],
                    names=["doc_id", "lang_pred", "family_pred", "score"])

    return run


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred, family_pred and score of every row, from the text alone.

    A text that is null, empty or has no letter is ``und`` with score 0 and no
    family, and so is every text if nothing was learned. Rows without doc_id,
    repeated rows and very long texts are treated like all others; equal texts
    get equal answers. Other columns are ignored.
    """
    lettered = F.coalesce(F.col("text").rlike("\\p{L}"), F.lit(False))
    rows = docs.select("doc_id", F.lower("text").alias("text"), lettered.alias("lettered"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_predicted(model), f"doc_id {kind}, lang_pred string, family_pred string, score double")


def judge(docs: DataFrame, per_lang: int = PER_LANG, folds: int = FOLDS, held_out: int = HELD_OUT, **kw) -> DataFrame:
    """``predict`` with held_out: true for the fold that training never sees.

    Rows with a null lang, text or doc_id teach nothing.
    """
    model = train(docs, per_lang, folds=folds, held_out=held_out, **kw)
    return predict(docs, model).withColumn("held_out", F.coalesce(fold(folds=folds) == held_out, F.lit(False)))
