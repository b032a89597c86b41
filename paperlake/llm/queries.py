"""The operators bound to the given tables, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import line_runs, risk_rules, url_graph


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_host_trust(spark, sf):
    return url_graph.judge_urls(table(spark, sf, "pages"))


def op2_noisy_or(spark, sf):
    from . import toxicity

    judged = toxicity.judge(table(spark, sf, "documents"), table(spark, sf, "labels"))
    return judged.select("doc_id", "held_out", "score", "predicted", "n_offending", "worst_start", "worst_end")


def op3_risk_rules(spark, sf):
    judged = risk_rules.judge(table(spark, sf, "documents"), table(spark, sf, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op4_parity_join(spark, sf):
    from . import parity_join

    return parity_join.component_table(table(spark, sf, "documents"))


def op5_surrogates(spark, sf):
    from . import surrogates

    return surrogates.pseudonymise(table(spark, sf, "documents"))


def _line_runs(spark, sf, min_lines):
    cut = line_runs.remove_runs(table(spark, sf, "documents"), min_lines)
    return cut.select("doc_id", "n_lines", "n_deleted", "n_runs", F.md5(F.coalesce("kept_text", F.lit(""))).alias("kept_md5"))


def op6_line_runs(spark, sf):
    return _line_runs(spark, sf, line_runs.MIN_LINES)


def op6_line_runs_single(spark, sf):
    """Runs of one line too: every later copy of a line goes."""
    return _line_runs(spark, sf, 1)


def op7_token_file(spark, sf):
    from . import pfor

    return pfor.token_file(table(spark, sf, "documents"), tokenizer_path())


def op8_longest_previous_factors(spark, sf):
    from . import lpf

    cut = lpf.remove_repeats(table(spark, sf, "documents"), keep="none")
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op9_template_leaks(spark, sf):
    from . import templates

    return templates.judge(table(spark, sf, "documents"), table(spark, sf, "benchmark"), verbatim=templates.MIN_TOKENS)


def op10_temperature_mix(spark, sf):
    """A flatter mixture at the size of the corpus: small sources are repeated, the large one is cut."""
    from . import mixing

    docs = table(spark, sf, "documents")
    total = docs.agg(F.sum(mixing.tokens_of(F.col("text")))).first()[0]
    return mixing.mix(docs, entropy=0.99, budget=float(total or 0))


def op11_language_tree(spark, sf):
    from . import language_tree

    return language_tree.judge(table(spark, sf, "documents"))


def op12_turn_trie(spark, sf):
    from . import turn_trie

    return turn_trie.prefix_trie(table(spark, sf, "conversations"))


def op13_whitening(spark, sf):
    from . import whitening

    return whitening.whiten(table(spark, sf, "embeddings"))


QUERIES = {"op1_host_trust": op1_host_trust, "op2_noisy_or": op2_noisy_or, "op3_risk_rules": op3_risk_rules, "op4_parity_join": op4_parity_join, "op5_surrogates": op5_surrogates, "op6_line_runs": op6_line_runs,
           "op6_line_runs_single": op6_line_runs_single,
           "op7_token_file": op7_token_file,
           "op8_longest_previous_factors": op8_longest_previous_factors,
           "op9_template_leaks": op9_template_leaks, "op10_temperature_mix": op10_temperature_mix,
           "op11_language_tree": op11_language_tree, "op12_turn_trie": op12_turn_trie, "op13_whitening": op13_whitening}
ORACLES: dict[str, str] = {"op1_host_trust": url_graph.oracle(), "op3_risk_rules": risk_rules.oracle(), "op6_line_runs": line_runs.oracle(),
                           "op6_line_runs_single": line_runs.oracle(1)}
