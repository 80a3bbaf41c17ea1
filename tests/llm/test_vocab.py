"""Byte-level identifiers of hostile texts against the tokenizers library."""

import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from burstwatch.llm import vocab as V
from burstwatch.llm.parameters import VOCAB

TOK = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
END = VOCAB[2]


@pytest.mark.parametrize("blank", [" ", "\n", "\t", "\xa0", "　", "\r\n", " \n"])
def test_short_runs_with_a_low_limit(blank, monkeypatch):
    monkeypatch.setattr(V, "LONG_BLANKS", 3)
    V.encoder.cache_clear()
    ids = V.encoder(*VOCAB)
    run = blank * 40
    for text in (run, run + "x", "a" + run, "a" + run + "b c" + run, run + END + run + "'s", f"{END}{END}" + run,
                 "é" + run + "1" + run + "!?" + run + END, "x" + run + "\x1c y"):
        assert ids(text).tolist() == TOK.encode(text, add_special_tokens=False).ids, text[:20]
    V.encoder.cache_clear()


@pytest.mark.parametrize("blank", [" ", "\n", "\t", "　"])
def test_two_megabytes_of_blanks(blank):
    ids = V.encoder(*VOCAB)
    text = "start" + blank * (2_000_000 // len(blank.encode())) + "x"
    assert ids(text).tolist() == TOK.encode(text, add_special_tokens=False).ids
