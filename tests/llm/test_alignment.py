"""Alignment of two tokenizers against a brute-force version over whole texts."""

import hashlib
import json
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from refinery.llm import alignment, queries
from refinery.llm.vocabulary import byte_of_char
from support import rows

SCHEMA = "doc_id long, text string"
A_FILE, B_FILE = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def brute():
    a_side = Tokenizer.from_file(A_FILE)
    a_side.encode_special_tokens = True
    b_side = sentencepiece.SentencePieceProcessor(model_file=B_FILE)
    of_char = byte_of_char()
    with open(A_FILE) as file:
        vocab = {i: p for p, i in json.load(file)["model"]["vocab"].items()}

    def spans(text):
        raw = (" " + text).encode()
        a = a_side.encode(" " + text, add_special_tokens=False).ids
        b = b_side.encode(text)
        a_bytes = [bytes(of_char.get(c, 0) for c in vocab[i]) for i in a]
        b_bytes = [bytes([int(p[3:5], 16)]) if b_side.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, map(b_side.id_to_piece, b))]
        return (a, b, a_bytes, b_bytes) if b"".join(a_bytes) == raw == b"".join(b_bytes) else None

    def placed(ids, pieces):
        at, out = 0, []
        for i, p in zip(ids, pieces):
            out.append((at, at + len(p), i))
            at += len(p)
        return out

    def run(data):
        links, kept, docs = {}, {}, Counter()
        for text in {t or "" for _, t in data}:
            found = spans(text) if text else None
            if not found:
                kept[text] = (0, 0, 0, 0, "")
                links[text] = []
                continue
            a, b = placed(found[0], found[2]), placed(found[1], found[3])
            pairs = [(x[2], y[2]) for x in a for y in b if x[0] < y[1] and y[0] < x[1]]
            ends = sorted({x[1] for x in a} & {y[1] for y in b})
            groups, low = [], 0
            for high in ends:
                groups.append(",".join(str(x[2]) for x in a if low < x[1] <= high) + "|" + ",".join(str(y[2]) for y in b if low < y[1] <= high))
                low = high
            links[text] = pairs
            kept[text] = (len(a), len(b), len(groups), len(pairs), hashlib.sha256(";".join(groups).encode()).hexdigest())
        for _, text in data:
            docs.update(set(links[text or ""]))
        most = defaultdict(int)
        for (a, _), n in docs.items():
            most[a] = max(most[a], n)
        out = []
        for doc, text in data:
            measured, pairs = kept[text or ""], links[text or ""]
            best = sum(docs[p] == most[p[0]] for p in pairs)
            out.append((doc, *measured[:4], best, sum(docs[p] for p in pairs), measured[4]))
        return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r)), {(*p, n, n == most[p[0]]) for p, n in docs.items()}

    return run


def data():
    random.seed(7)
    words = "the of and token izer aligned üb 𝄞x don't 12 3.5 <|endoftext|> <s> naïve résumé , . !? -- x_y".split()
    gaps = [" ", " ", " ", "  ", "\n", "\t ", " \r\n ", " ", "　", "\x1c"]
    out = [(i, "".join(random.choice(words) + random.choice(gaps) for _ in range(random.randint(0, 30)))) for i in range(80)]
    odd = ["", None, " ", "  ", "\n", "▁", "a ▁ b", "\0", "a\0 b", " leading", "trailing ", "日本語のテキスト", "é", "ﬁ ﬂ", "a" * 3_000, "<|endoftext|>", "<0x41>", "x" * 70 + " y", "​ z", "﻿"]
    out += [(100 + i, t) for i, t in enumerate(odd)]
    out += [(200 + i, "the same text, again") for i in range(40)] + [(None, "no id"), (1, "the token"), (1, "the token")]
    return out


def test_brute_force(spark, brute):
    made = data()
    df = spark.createDataFrame(made, SCHEMA).repartition(4)
    found, pairs = alignment.align_tokenizers(df)
    expected, expected_pairs = brute(made)
    assert rows(found) == expected
    assert {tuple(r) for r in pairs.collect()} == expected_pairs


@pytest.mark.parametrize("frequent", [0, 20])
def test_rare_pairs_are_shuffled(spark, brute, frequent):
    made = data()
    found, _ = alignment.align_tokenizers(spark.createDataFrame(made, SCHEMA), frequent_pairs=frequent)
    assert rows(found) == brute(made)[0]


def test_forgetting_changes_nothing(spark, brute, monkeypatch):
    with open(A_FILE, "rb") as a, open(B_FILE, "rb") as b:
        sides = alignment.Sides(a.read(), b.read())
    texts = [t for _, t in data() if t]
    once = alignment.Aligner(sides).texts(texts)
    monkeypatch.setattr(alignment, "UNITS", 10)
    monkeypatch.setattr(alignment, "_LONG", 3)
    small = alignment.Aligner(sides)
    again = [r for i in range(0, len(texts), 5) for r in small.texts(texts[i : i + 5])]
    assert [r[:5] for r in once] == [r[:5] for r in again]
    assert all((x[5] == y[5]).all() and (x[6] == y[6]).all() for x, y in zip(once, again))
    aligner = alignment.Aligner(sides)  # units joined are what the libraries give for the whole
    for text in texts:
        whole, [joined] = aligner._whole(text), alignment.Aligner(sides).texts([text])
        assert (whole or (0, 0, 0, 0, ""))[:5] == joined[:5]


def test_very_long_text(spark):
    text = "word after word, " * 100_000
    [row] = alignment.align_tokenizers(spark.createDataFrame([(1, text)], SCHEMA))[0].collect()
    assert row.n_links == row.n_a + row.n_b - row.n_groups and row.n_a > 300_000


def test_empty_table_and_clashing_columns(spark, brute):
    assert alignment.align_tokenizers(spark.createDataFrame([], SCHEMA))[0].count() == 0
    made = data()
    more = spark.createDataFrame([(*r, "x", 1, 2) for r in made], SCHEMA + ", digest string, copies int, pair long")
    assert rows(alignment.align_tokenizers(more)[0]) == brute(made)[0]
    text_ids = spark.createDataFrame([("a", "the"), ("b", "the")], "doc_id string, text string")
    assert [r.count_sum for r in alignment.align_tokenizers(text_ids)[0].collect()] == [2, 2]


def test_query(spark, brute):
    folder = "/root/testdata/sf0.001"
    made = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    short = [(i, t) for i, t in made if len(t) < 4_000]
    found = alignment.align_tokenizers(spark.createDataFrame(short, SCHEMA))[0]
    assert rows(found) == brute(short)[0]
    assert queries.op11_tokenizer_alignment(spark, folder).count() == len(made)
