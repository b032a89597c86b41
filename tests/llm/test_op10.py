import math
from collections import Counter, defaultdict

import pytest

from paperlake.llm import mixing as M


def corpus(spark, prose):
    sizes = {"a": 300, "b": 60, "c": 25, None: 10}
    rows = [(f"{s}{i}", prose(i + 7 * len(str(s)), 5 + i % 40), s) for s, n in sizes.items() for i in range(n)]
    return spark.createDataFrame([(i, t, s) for i, (_, t, s) in enumerate(rows)], "doc_id long, text string, source string"), rows


def test_entropy_budget_and_permutations(spark, prose):
    frame, rows = corpus(spark, prose)
    tokens, n_docs = Counter(), Counter()
    for _, t, s in rows:
        tokens[s] += len(t.split())
        n_docs[s] += 1
    total = sum(tokens.values())
    for block in (4, 4096):
        mixture = M.plan_mixture(frame, entropy=0.9, budget=float(total), block_docs=block)
        drawn = M.draw(frame, mixture).select("_row.*", "pass", "place").collect()
        weights = {r["source_key"][1:] or None: r["weight"] for r in mixture.sources.collect()}
        h = -sum(w * math.log(w) for w in weights.values()) / math.log(4)
        assert 0.9 <= h < 0.9001 and sum(weights.values()) == pytest.approx(1)
        for s in tokens:
            assert weights[s] == pytest.approx(tokens[s] ** mixture.exponent / sum(x ** mixture.exponent for x in tokens.values()))
        by = defaultdict(list)
        for r in drawn:
            by[r["source"], r["pass"]].append(r)
        for s in tokens:
            quota = weights[s] * total
            whole, rest = divmod(quota, tokens[s])
            for p in range(int(whole)):
                assert len(by[s, p]) == n_docs[s]
            last = by[s, int(whole)]
            used = sum(len(r["text"].split()) for r in last)
            assert used <= rest < used + 45 and (s, int(whole) + 1) not in by
            # a pass begins with the lowest places of a permutation
            assert len({r["place"] for r in last}) == len(last)
        got = sorted((r["doc_id"], r["pass"], r["place"]) for r in drawn)
        first = first if block != 4 else got
    assert got == first  # the size of the blocks changes nothing


def test_repetition_limit(spark):
    rows = [(i, "w " * 10, "big") for i in range(100)] + [(200 + i, "w " * 10, "small") for i in range(4)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixture = M.plan_mixture(frame, repeats=3.0, budget=1040.0)
    share = {r["source_key"]: r["weight"] * 1040 / r["tokens"] for r in mixture.sources.collect()}
    assert share["=small"] == pytest.approx(3.0, abs=1e-4) and share["=small"] <= 3.0 + 1e-9
    assert M.plan_mixture(frame, repeats=1.0, budget=1040.0).exponent == 1.0


def thinned(spark, sizes, per_doc=50):
    """Tokens kept by source when sources of these sizes are thinned."""
    rows = [(s, min(per_doc, n - at)) for s, n in sizes.items() for at in range(0, n, per_doc)]
    frame = spark.createDataFrame([(i, "w " * k, s) for i, (s, k) in enumerate(rows)], "doc_id long, text string, source string")
    kept = M.thin(frame, entropy=0.95).collect()
    assert len({r["doc_id"] for r in kept}) == len(kept)
    out = Counter()
    for r in kept:
        out[r["source"]] += len(r["text"].split())
    return out


def test_tiny_sources_limit_nothing(spark):
    equal = {f"s{i}": 1000 for i in range(19)}
    got = thinned(spark, {**equal, "hot": 9500, "tiny": 2, None: 3})
    alone = thinned(spark, {**equal, "hot": 9500})
    assert {s: n for s, n in got.items() if s != "hot"} == {**equal, "tiny": 2, None: 3}
    assert got["hot"] == alone["hot"] and 1000 < got["hot"] < 9500
    # the entropy of what is left is the target
    total = sum(alone.values())
    assert -sum(n / total * math.log(n / total) for n in alone.values()) / math.log(20) == pytest.approx(0.95, abs=0.003)
    assert thinned(spark, {"big": 10_000, None: 5}) == {"big": 10_000, None: 5}
    # no target takes more than half
    half = thinned(spark, {"big": 10_000, "small": 400})
    assert half["small"] == 400 and 5200 - 50 <= sum(half.values()) <= 5200
    assert thinned(spark, equal) == equal


def test_without_budget_weights_are_powers_of_shares(spark):
    sizes = {"a": 400, "b": 800, "c": 1600, "d": 12800, "tiny": 5}
    frame = spark.createDataFrame([(i, "w " * 5, s) for i, s in enumerate(s for s, n in sizes.items() for _ in range(n // 5))], "doc_id long, text string, source string")
    plan = M.plan_mixture(frame, entropy=0.95)
    quota = {r["source_key"][1:]: r["weight"] * plan.budget for r in plan.sources.collect()}
    assert plan.exponent not in (0.0, 1.0) and quota["tiny"] == pytest.approx(5)
    for s in "abcd":
        assert quota[s] == pytest.approx(400 * (sizes[s] / 400) ** plan.exponent)
    assert plan.budget == pytest.approx(0.5 * sum(sizes.values()), rel=1e-4)  # the target alone would leave less than half
    plan = M.plan_mixture(frame.filter("source <> 'd'"), entropy=0.95)
    quota = {r["source_key"][1:]: r["weight"] * plan.budget for r in plan.sources.collect()}
    held = [quota[s] for s in "abc"]
    assert -sum(q / sum(held) * math.log(q / sum(held)) for q in held) / math.log(3) == pytest.approx(0.95, abs=1e-4)
    assert 0 < plan.exponent < 1 and quota["b"] == pytest.approx(400 * 2 ** plan.exponent) and quota["b"] < 800


def test_odd_documents(spark, odd_documents, no_documents):
    rows = M.mix(odd_documents, entropy=0.5).collect()
    assert Counter((r["doc_id"], r["pass"]) for r in rows) <= Counter({(i, 0): 2 for i in (7, 9, 5, 1, 2, 3, 4, 6, 8, None)})
    kept = M.thin(odd_documents, entropy=1.0)
    assert kept.columns == odd_documents.columns and 0 < kept.count() <= odd_documents.count()
    assert M.mix(no_documents, entropy=0.5).count() == 0 and M.mix(odd_documents.filter("doc_id in (2, 3)"), entropy=0.5, budget=5.0).count() == 0
    with pytest.raises(ValueError):
        M.find_exponent(no_documents, None, None)
