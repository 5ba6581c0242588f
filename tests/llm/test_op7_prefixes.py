"""The registered token counts keep the count of every prefix, as the tokenizer gives it."""

import numpy as np
import pytest
from test_operators import ODD_TEXTS
from tokenizers import Tokenizer

from refinery.llm import common, queries, token_counts, vocabulary

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(common.tokenizer_path("byte_bpe_50k.json"))


def test_prefixes_of_mixed_texts(library):
    with open(common.tokenizer_path("byte_bpe_50k.json"), "rb") as file:
        counter = token_counts.Counter(vocabulary.load(file.read()))
    rng = np.random.default_rng(2)
    parts = ["a", "the", "'s", "'re", "'", "''", "'lls", " ", "  ", "\n", "\t", " ", "12", "!?", "é", "日本", "🎉", "é", "don't", "<|endoftext|>", "\x1c", "_"]
    texts = ["".join(rng.choice(parts, rng.integers(1, 14))) for _ in range(1500)]
    texts += ["plain " + t[:150] for t in ODD_TEXTS]
    for text in texts:
        for _ in range(2):  # computed, and remembered
            got = counter.prefix_counts(text).tolist()
            assert got == [len(library.encode(text[:i], add_special_tokens=False).ids) for i in range(len(text) + 1)], repr(text)


def test_words_that_begin_alike_or_end_in_marks(library, monkeypatch):
    with open(common.tokenizer_path("byte_bpe_50k.json"), "rb") as file:
        counter = token_counts.Counter(vocabulary.load(file.read()))
    monkeypatch.setattr(token_counts, "REMEMBERED", 40)  # what is remembered is dropped now and then
    words = [a + b for a in ("inter", "internat", "international", "été", "straß", "Wort", "ab\u0250c") for b in ("", "s", "ization", "é", "isms")]
    marks = ["", ".", "%%%", "'s", ".'", "-b", "''", ",1", "_" * 50, "\u2026", "<|"]
    texts = [f"x {w}{m} {w}" for w in words for m in marks] + ["a" * 90 + " b " + "c" * 41 + ".", "x " + " ".join(w + m for w in words for m in marks)]
    for text in texts:
        got = counter.prefix_counts(text).tolist()
        cuts = range(len(text) + 1) if len(text) < 200 else range(0, len(text) + 1, 97)
        assert [got[i] for i in cuts] == [len(library.encode(text[:i], add_special_tokens=False).ids) for i in cuts], repr(text)


def test_cuts_of_special_strings_count_the_last_word_only(library, monkeypatch):
    with open(common.tokenizer_path("byte_bpe_50k.json"), "rb") as file:
        counter = token_counts.Counter(vocabulary.load(file.read()))
    text = "some words here <|endoftext|> no<|endoftext|><|endoftext|>" * 60
    seen = []
    count = token_counts.Counter.count
    monkeypatch.setattr(token_counts.Counter, "count", lambda self, t: seen.append(len(t)) or count(self, t))
    got = counter.prefix_counts(text)
    assert max(seen) < 40 and len(got) == len(text) + 1
    for i in [*range(120), len(text) - 7, len(text)]:
        assert got[i] == len(library.encode(text[:i], add_special_tokens=False).ids)


def test_op7_keeps_every_prefix(spark, library):
    texts = {r.doc_id: r.text or "" for r in common.read_table(spark, FOLDER, "documents").collect()}
    rows = {r.doc_id: r for r in queries.op7_token_counts(spark, FOLDER).collect()}
    assert set(rows) == set(texts) and any(r.over_limit for r in rows.values())
    of = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    for i, text in texts.items():
        r, counts = rows[i], np.frombuffer(rows[i].prefix_tokens, "<i4")
        assert len(counts) == len(text) + 1 and counts[-1] == r.n_tokens == of(text) and r.n_bytes == len(text.encode())
        assert r.over_limit == (r.n_tokens > 1024)
        fits = np.flatnonzero(counts <= 1024)[-1]
        assert r.n_chars_kept == fits and of(text[:fits]) <= 1024 and (fits == len(text) or of(text[: fits + 1]) > 1024)
        for n in {len(text) // 3, len(text) // 2, max(0, len(text) - 1)}:
            assert counts[n] == of(text[:n])
