import zlib

import numpy as np
import pytest

from paperlake.llm import pfor
from paperlake.llm.queries import tokenizer_path


@pytest.mark.parametrize("n", [0, 1, 7, 8, 127, 128, 129, 1000])
def test_blocks_round_trip(n):
    rng = np.random.default_rng(n)
    for high in (1, 2, 49_408, 2 ** 32):
        for share in (0.0, 0.5, 0.9, 1.0):
            ids = np.where(rng.random(n) < 0.1, rng.integers(0, high, n), rng.integers(0, min(high, 7), n)).astype(np.uint64)
            payload, index = pfor.encode(ids, 128, share)
            assert (pfor.decode(payload, index, n) == ids).all()
            if n > 2:
                assert (pfor.decode(payload, index, n, first=n // 3, count=n // 2) == ids[n // 3:n // 3 + n // 2]).all()


def test_words_give_the_ids_of_the_text():
    from tokenizers import Tokenizer

    whole, words = Tokenizer.from_file(tokenizer_path()), pfor.WordIds(tokenizer_path())
    texts = ["It's fine... isn't it?!  OK, 3.14 a1b2", "ÀÉ über Straße, 漢字。 é H̱x Ǆ İstanbul ﬁn", "<|endoftext|> a<|startoftext|>b <|ENDOFTEXT|>",
             "", " \n", "UPPER lower. UPPER! lower", "x y z\x1cw", "ΑΣ σς. ΟΔΟΣ", "don't 'quoted' ?.! a.b,c", "̀ ́a 가각"]
    for _ in range(2):
        for text, ids in zip(texts, words.encode([t.encode() for t in texts])):
            assert ids.tolist() == whole.encode(text, add_special_tokens=False).ids, text


def test_crc_of_joined_parts():
    a, b = b"some bytes", bytes(range(256)) * 3
    assert pfor.crc_joined(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)
    assert pfor.crc_joined(0, zlib.crc32(b), len(b)) == zlib.crc32(b)


def want(docs):
    from tokenizers import Tokenizer

    whole, at, out = Tokenizer.from_file(tokenizer_path()), 0, []
    for i, text in docs:
        ids = np.array(whole.encode(text or "", add_special_tokens=False).ids + [1], dtype="<u4")
        out.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def test_files(spark, odd_documents, no_documents, prose):
    docs = [(i, prose(i, 10 + 37 * i % 300)) for i in range(120)]
    frame = spark.createDataFrame(docs[::-1], "doc_id long, text string")
    for size in (64, 1 << 16):  # shards smaller than documents, and larger
        got = sorted(tuple(r) for r in pfor.token_file(frame, tokenizer_path(), shard_ids=size).collect())
        assert got == want(docs)
    rows = pfor.token_file(odd_documents, tokenizer_path(), shard_ids=1000).collect()
    assert len(rows) == odd_documents.count()
    ordered = sorted(rows, key=lambda r: r["start"])
    assert [r["doc_id"] for r in ordered] == sorted((r["doc_id"] for r in rows), key=lambda i: (i is not None, i or 0))
    starts = np.cumsum([0] + [r["n_tokens"] for r in ordered])
    assert [r["start"] for r in ordered] == starts[:-1].tolist()
    assert all(r["n_tokens"] == 1 for r in rows if r["doc_id"] in (2, 3, 4))
    assert pfor.token_file(no_documents, tokenizer_path()).count() == 0


def test_words_without_ids_beside_words_of_two_units():
    words = pfor.WordIds(tokenizer_path())
    for group in (["\u00a0", "3d"], ["3d", "\u3000"], ["a1b2", "\u2028", "\u00a0", "x-y", "\u6f22\u5b57", "caf\u00e9", "..."]):
        each = [np.array(words.tokenizer.encode(w, add_special_tokens=False).ids, dtype="<u4").tobytes() for w in group]
        assert words._encode([w.encode() for w in group]) == each


def test_fuzzed_words():
    """Letters that become a letter and a mark in small form, marks, digits and blanks of several kinds in any order."""
    import random

    from tokenizers import Tokenizer

    rng = random.Random(11)
    units = ["İ", "I", "ß", "é", "É", "Ǆ", "ﬁ", "Σ", "ς", "ı", "Ñ", "漢", "H̱", "̇", "a", "B", "zz", "GALERİ", "BELEDİYESİ", "der", ".", ",", "!?", "'s", "…", "3", "½", " ", " ", "\n", " "]
    texts = ["GALERİ.", "BELEDİYESİ, BELEDİYESİ", *("".join(rng.choice(units) for _ in range(rng.randint(1, 14))) for _ in range(4000))]
    whole, words = Tokenizer.from_file(tokenizer_path()), pfor.WordIds(tokenizer_path())
    for text, ids in zip(texts, words.encode([t.encode() for t in texts])):
        assert ids.tolist() == whole.encode(text, add_special_tokens=False).ids, text


class Seen:
    """A tokenizer that remembers what it was asked."""

    def __init__(self, real):
        self.real, self.texts = real, []

    def encode(self, text, **kw):
        self.texts.append(text)
        return self.real.encode(text, **kw)

    def encode_batch_fast(self, texts, **kw):
        self.texts += texts
        return self.real.encode_batch_fast(texts, **kw)


def test_letters_skip_the_normalizer_and_pattern():
    """What costs most: words of letters went through the whole tokenizer, all in one call with any odd one."""
    words = pfor.WordIds(tokenizer_path())
    whole, words.tokenizer = words.tokenizer, Seen(words.tokenizer)
    text = "École, ecole. ECOLE! été naïve Москва? ΟΔΟΣ ẞtraße 3.14 don't İzmir 漢字"
    for _ in range(2):
        assert words.encode([text.encode()])[0].tolist() == whole.encode(text, add_special_tokens=False).ids
    asked = " ".join(words.tokenizer.texts).split()
    assert sorted(asked) == sorted([",", ".", "!", "?", "3.14", "don't", "İzmir", "漢字"])  # each once


def test_every_letter_beside_others():
    import re

    from tokenizers import Tokenizer

    whole, words = Tokenizer.from_file(tokenizer_path()), pfor.WordIds(tokenizer_path())
    letters = [c for c in map(chr, range(0x3000)) if re.match(words.WORD.replace("?P<letters>", "").replace("?P<marks>", ""), c)]
    assert len(letters) > 1000
    texts = [t for c in letters for t in (c, f"{c}.", f"a{c}b,", f"{c}{c}é!", f"T{c}?!")]
    for text, ids in zip(texts, words.encode([t.encode() for t in texts])):
        assert ids.tolist() == whole.encode(text, add_special_tokens=False).ids, text


def test_full_word_store(monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(pfor, "WORDS_HELD", 6)
    whole, words = Tokenizer.from_file(tokenizer_path()), pfor.WordIds(tokenizer_path())
    for text in ("one two, three", "two, four 5 six", "", "one six. seven", "a b c d e f g h i", "one two, three"):
        assert words.encode([text.encode(), b""])[0].tolist() == whole.encode(text, add_special_tokens=False).ids
        assert len(words.units) <= max(6, len(set(text.replace(",", " ,").replace(".", " .").split())) + 1)
    assert words.encode([]) == []


def test_long_units_do_not_pile_up(monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(pfor, "BYTES_HELD", 20_000)
    whole, words = Tokenizer.from_file(tokenizer_path()), pfor.WordIds(tokenizer_path())
    for i in range(30):
        text = f"one two, {'漢字' * 200}{i}"
        assert words.encode([text.encode()])[0].tolist() == whole.encode(text, add_special_tokens=False).ids
        assert words.units.nbytes + words.ids.nbytes < 40_000
