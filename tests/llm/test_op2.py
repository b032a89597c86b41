import random
import zlib

import numpy as np

from paperlake.llm import toxicity as X
from paperlake.llm import bytesops as B


def corpus(prose, n):
    rng = random.Random(4)
    docs, labels = [], []
    for i in range(n):
        sentences = [prose(1000 * i + k, 8) for k in range(rng.randrange(2, 6))]
        toxic = int(rng.random() < 0.3)
        if toxic:
            at = rng.randrange(len(sentences))
            sentences[at] += " " + rng.choice(["blarg", "zonk", "ugly"]) + " fellow"
        docs.append((i, ". ".join(sentences) + "."))
        labels.append((i, toxic))
    return docs, labels


def test_held_out_documents_and_sentences(spark, prose):
    docs, labels = corpus(prose, 500)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: r for r in X.judge(frame, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()}
    held = [i for i in got if got[i]["held_out"]]
    assert set(held) == {i for i, _ in docs if zlib.crc32(str(i).encode()) % 5 == 0}
    right = [got[i]["predicted"] == labels[i][1] for i in held]
    assert sum(right) / len(right) > 0.95
    for i in held:
        if labels[i][1] and got[i]["predicted"]:
            worst = docs[i][1].encode()[got[i]["worst_start"]:got[i]["worst_end"]].decode()
            assert any(w in worst for w in ("blarg", "zonk", "ugly"))


def test_labels_of_the_held_out_fold_change_nothing(spark, prose):
    docs, labels = corpus(prose, 120)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    changed = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, y in labels]
    weights = [X.train(frame, spark.createDataFrame(rows, "doc_id long, toxic int")) for rows in (labels, changed)]
    assert np.array_equal(weights[0][0], weights[1][0]) and weights[0][1] == weights[1][1]


def test_noisy_or_by_hand():
    data = b"bad day. fine day! bad bad\nok" + b"" + b"fine"
    offsets = np.array([0, 29, 29, 33])
    buffer = np.frombuffer(data, dtype=np.uint8)
    feature, sentence, text, starts, ends = X.sentence_words(buffer, offsets, B.Powers())
    assert [data[s:e].decode() for s, e in zip(starts, ends)] == ["bad", "day", "fine", "day", "bad", "bad", "ok", "fine"]
    assert sentence.tolist() == [0, 0, 1, 1, 2, 2, 3, 4] and text.tolist() == [0] * 7 + [2]
    weights = np.zeros(1 << X.BITS)
    weights[feature[0]] = 2.0
    p = X.sentence_scores(feature, sentence, weights, -1.0)
    s = lambda z: 1 / (1 + np.exp(-z))
    assert np.allclose(p, [s(1), s(-1), s(3), s(-1), s(-1)])
    score = X.noisy_or(p, np.array([0, 0, 0, 0, 2]), 3)
    assert np.allclose(score, [1 - (1 - s(1)) * (1 - s(-1)) ** 2 * (1 - s(3)), 0, s(-1)])


def test_odd_documents(spark, odd_documents, no_documents):
    labels = spark.createDataFrame([(1, 1), (5, 0), (8, 1), (None, 1), (9, None), (9, 0), (2, 0)], "doc_id long, toxic int")
    rows = X.judge(odd_documents, labels).collect()
    assert len(rows) == odd_documents.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["score"] == 0 and r["n_offending"] == 0 for r in rows if r["doc_id"] in (2, 3, 4))
    assert all(r["held_out"] is False for r in rows if r["doc_id"] is None)
    assert X.judge(no_documents, labels).count() == 0
    assert {r["predicted"] for r in X.judge(odd_documents, labels.limit(0)).collect()} == {0}


def test_one_row_of_a_repeated_id_is_learned(spark, prose):
    rows = [(i, prose(i, 20) + (" vile vile" if i % 2 else "")) for i in range(40)]
    labels = spark.createDataFrame([(i, 0, i % 2) for i in range(40)], "doc_id long, quality int, toxic int")
    shape = "doc_id long, text string"
    once = X.train(spark.createDataFrame(rows, shape), labels)
    again = X.train(spark.createDataFrame(rows + [rows[3]] * 500, shape), labels)
    assert (once[0] == again[0]).all() and once[1] == again[1]
