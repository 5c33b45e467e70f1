"""Token ids of many texts at a time against the tokenizer itself."""

from __future__ import annotations

import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from trilayer.llm import tokens

TEXTS = [
    None, "", " ", "\n\t a  b\r\n", "The cat, the CAT. the cat!", "don't, it's 3,5 (see) <|startoftext|> <|ENDOFTEXT|> x",
    "ẖ H̱ İ ΑΣ Σ á É!", "日本語 テスト", "a!!,,b c'd \x00 \x1c \x85   u v", "ß ×÷ Ÿ Àé.,!",
    "a" * 3000 + " b", " lead", "trail ", "...",
]


@pytest.fixture(scope="module")
def path() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("listed", [1, 50, 1 << 20])
def test_ids_of_texts_are_those_of_the_tokenizer(path, monkeypatch, listed):
    monkeypatch.setattr(tokens, "LISTED", listed)
    tokenizer, words = Tokenizer.from_file(path), tokens.WordIds(path)
    for texts in (TEXTS, TEXTS[::-1] * 2, TEXTS[:1], []):
        expected = [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
        assert [i.tolist() for i in tokens.text_ids(pa.array(texts, pa.string()), words)] == expected
    sliced = pa.array(TEXTS, pa.string()).slice(3, 5)
    expected = [tokenizer.encode(t, add_special_tokens=False).ids for t in TEXTS[3:8]]
    assert [i.tolist() for i in tokens.text_ids(sliced, words)] == expected


def test_distinct_parts_of_many_texts_are_encoded_at_once(path, monkeypatch):
    words, calls = tokens.WordIds(path), []
    encode = words.by_merges
    monkeypatch.setattr(words, "by_merges", lambda parts: calls.append(parts) or encode(parts))
    monkeypatch.setattr(words, "by_tokenizer", None)
    texts = [f"Word{chr(97 + i % 26)}, word{chr(97 + i % 26)}. other" for i in range(500)]
    assert len([*tokens.text_ids(pa.array(texts), words)]) == 500
    assert len(calls) == 1 and len(calls[0]) == len(set(calls[0])) == 26 + 3
