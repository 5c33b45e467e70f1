"""Token ids of the word tokenizer, by whole texts, many texts at a time.

The tokenizer drops white space and no token spans it, so a text's ids are those of its
words one after another. Arrow cuts the texts into words and finds the distinct ones. Most
are letters with trailing punctuation; the merges of all their parts run through a
byte-level encoder, made from the same vocabulary file, in one call. Every other word goes
to the tokenizer itself and is remembered.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from tokenizers import Tokenizer

from trilayer.llm.words import WordMemory

END_OF_WORD, END_BYTE = "</w>", b" "  # a byte no word holds
#: Lower-case results of these letters are single letters in any Unicode version.
_PLAIN = r"\A(?P<letters>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<marks>[!-&(-/:-@\[-`{-~]*)\z"
#: Bytes of texts whose words are listed at a time; a longer text is listed alone.
LISTED = 2 << 20


def _byte_alphabet() -> dict[str, int]:
    """The printable stand-ins byte-level vocabularies use for the 256 bytes."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _gathered(values: np.ndarray, ends: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of `values` that end at `ends`, taken in the order `at`, and where each then ends."""
    starts = np.concatenate(([0], ends[:-1]))
    lengths = (ends - starts)[at]
    now = np.cumsum(lengths)
    return values[np.repeat(starts[at] - (now - lengths), lengths) + np.arange(lengths.sum())], now


class WordIds:
    """Words -> their ids."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        alphabet, vocab = _byte_alphabet(), model["vocab"]

        def as_bytes(token: str) -> bytes:
            end = token.endswith(END_OF_WORD)
            body = token.removesuffix(END_OF_WORD) if end else token
            return bytes(alphabet[c] for c in body) + END_BYTE * end

        merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        single = [c for c in alphabet] + [c + END_OF_WORD for c in alphabet]
        tokens = [*single, *merged]
        ranks: dict[bytes, int] = {}
        for rank, token in enumerate(tokens):
            ranks.setdefault(as_bytes(token), rank)
        self.ids = np.array([vocab[t] for t in tokens], "<u4")
        self.ends = np.array([t.endswith(END_OF_WORD) for t in tokens])
        self.merges = tiktoken.Encoding(
            "words", pat_str=r"[^ ]+ ", mergeable_ranks=ranks, special_tokens={}
        )._core_bpe
        self.other = WordMemory(self.by_tokenizer)

    def by_tokenizer(self, word: bytes) -> bytes:
        ids = self.tokenizer.encode(word.decode("utf-8", "replace"), add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def by_merges(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of lower-case letters or runs of punctuation, and where those of each end."""
        ranks = np.array(self.merges.encode_ordinary("".join([f"{p} " for p in parts])), np.int64)
        return self.ids[ranks], np.flatnonzero(self.ends[ranks]) + 1

    def __call__(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, and where those of each end."""
        parts = pc.extract_regex(words, _PLAIN)
        letters, marks = pc.struct_field(parts, "letters"), pc.struct_field(parts, "marks")
        marks = pc.if_else(pc.equal(marks, ""), None, marks)
        coded = pa.concat_arrays([pc.utf8_lower(letters), marks]).dictionary_encode()
        ids, ends = self.by_merges(coded.dictionary.to_pylist())
        others = words.filter(letters.is_null()).cast(pa.binary()).to_pylist()
        found = [self.other[w] for w in others]
        # Runs of ids: those of the parts, those of the other words, an empty one.
        sizes = np.array([len(f) // 4 for f in found], np.int64)
        ids = np.concatenate((ids, np.frombuffer(b"".join(found), "<u4")))
        ends = np.concatenate((ends, len(ids) - sizes.sum() + np.cumsum(sizes), [len(ids)]))
        first, second = coded.indices.fill_null(len(ends) - 1).to_numpy().reshape(2, -1)
        first = first.astype(np.int64)
        first[letters.is_null().to_numpy(zero_copy_only=False)] = len(coded.dictionary) + np.arange(len(found))
        ids, ends = _gathered(ids, ends, np.stack((first, second), 1).ravel())
        return ids, ends[1::2]


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    """Once per worker, kept from task to task."""
    return WordIds(path)


def text_ids(texts: pa.Array, words: WordIds) -> Iterator[np.ndarray]:
    """Ids of each whole text as little-endian 32-bit words; null is empty."""
    texts = texts.fill_null("")
    bytes_before = np.cumsum(pc.binary_length(texts).to_numpy().astype(np.int64))
    start = 0
    while start < len(texts):
        sofar = bytes_before[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(bytes_before, sofar + LISTED, side="right")))
        listed = pc.ascii_split_whitespace(texts.slice(start, end - start))
        found = listed.flatten()
        # White space before the first or after the last word leaves an empty one.
        held = np.concatenate(([0], np.cumsum(pc.binary_length(found).to_numpy() > 0)))
        bounds = held[listed.offsets.to_numpy() - listed.offsets[0].as_py()]
        coded = found.filter(pc.not_equal(found, "")).dictionary_encode()
        ids, ends = words(coded.dictionary)
        ids, ends = _gathered(ids, ends, coded.indices.to_numpy())
        ends = np.concatenate(([0], ends))[bounds]
        yield from (ids[a:b] for a, b in zip(ends, ends[1:]))
        start = end
