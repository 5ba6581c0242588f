"""Workers serve many stages; what one operator remembers does not stay for the next."""

from refinery.llm import bpe, common, token_counts, vocabulary


def _data():
    with open(common.tokenizer_path("byte_bpe_50k.json"), "rb") as file:
        return file.read()


def test_a_worker_remembers_one_operator():
    one = bpe._encoder(_data(), bpe.build_lexicon([], vocabulary.load(_data())))
    assert bpe._encoder(_data(), bpe.build_lexicon([], vocabulary.load(_data()))) is one
    counter = token_counts._counter(_data())
    assert token_counts._counter(_data()) is counter and list(common._kept.values()) == [counter]
    common.forget()
    assert not common._kept
