"""Token counts of a unigram tokenizer without building the tokens.

Aho-Corasick finds every vocabulary piece that ends at a position; the dynamic program
keeps, per position, the best score and how many pieces reach it, and nothing else, for no
more positions than the longest piece spans. Ties go as in the tokenizer: a later start must
score strictly more, so of equal segmentations the one with the longest last piece wins; a
letter no piece covers is unknown, at the lowest score less 10, and falls back to its bytes,
or, in a vocabulary without them, is one token with its unknown neighbours.

The vocabulary, pieces and scores, is that of a public file as it stands. White space
separates words and each word starts with the word mark, so a text's count is the sum of
its words' counts, which a task remembers.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trilayer.llm.common import table
from trilayer.llm.words import WordMemory, word_lists

MARK = "▁"
UNKNOWN_PENALTY = 10.0


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def unigram_vocabulary(path: str) -> list[tuple[str, float]]:
    """The pieces of a vocabulary file with the scores it gives them, without its special ones."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    special = (model.is_control, model.is_unknown, model.is_byte)
    plain = [i for i in range(model.vocab_size()) if not any(kind(i) for kind in special)]
    return [(model.id_to_piece(i), model.get_score(i)) for i in plain]


class PieceCounter:
    """`byte_fallback`: an unknown letter is as many tokens as it has bytes in UTF-8."""

    def __init__(self, vocabulary: list[tuple[str, float]], byte_fallback: bool = False):
        self.pieces = ahocorasick.Automaton()
        self.single = set()
        for piece, score in vocabulary:
            if piece:
                self.pieces.add_word(piece, (len(piece), score))
                if len(piece) == 1:
                    self.single.add(piece)
        self.longest = max((len(piece) for piece, _ in vocabulary), default=1)
        self.unknown = min((s for _, s in vocabulary), default=0.0) - UNKNOWN_PENALTY
        self.byte_fallback = byte_fallback
        self.ready = bool(len(self.pieces))
        if self.ready:
            self.pieces.make_automaton()

    def count(self, text: str) -> int:
        """Tokens of one word, its mark included."""
        ring = self.longest + 1
        best, count, unknown = [0.0] * ring, [0] * ring, [False] * ring
        matches = self.pieces.iter(text) if self.ready else iter(())
        ahead = next(matches, None)
        for end in range(1, len(text) + 1):
            here = []
            while ahead is not None and ahead[0] == end - 1:
                here.append(ahead[1])
                ahead = next(matches, None)
            top, pieces, is_unknown = None, 0, False
            for length, score in sorted(here, reverse=True):
                start = (end - length) % ring
                total = score + best[start]
                if top is None or total > top:
                    top, pieces, is_unknown = total, count[start] + 1, False
            letter = text[end - 1]
            if letter not in self.single:
                before = (end - 1) % ring
                total = self.unknown + best[before]
                if top is None or total > top:
                    more = len(letter.encode("utf-8", "replace")) if self.byte_fallback else not unknown[before]
                    top, pieces, is_unknown = total, count[before] + more, True
            at = end % ring
            best[at], count[at], unknown[at] = top, pieces, is_unknown
        return count[len(text) % ring]


@lru_cache(maxsize=2)
def _word_counts(path: str) -> WordMemory:
    counter = PieceCounter(unigram_vocabulary(path), byte_fallback=True)
    return WordMemory(lambda word: counter.count(MARK + word.decode("utf-8", "replace")))


def count_tokens(docs: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id, n_words and n_tokens of every whole text.

    Null and empty texts have no words and no tokens. Repeated rows are counted each.
    Other columns are not read. `model` is a file every executor has at the same path.
    """
    path = model or default_model()

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _word_counts(path)
        for batch in batches:
            words, tokens = [], []
            for text in batch.column(1):
                n = total = 0
                for found in word_lists(text.as_py(), lower=False):
                    n += len(found)
                    total += sum(map(counts.__getitem__, found))
                words.append(n)
                tokens.append(total)
            columns = [batch.column(0), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_tokens"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(counted, "doc_id long, n_words long, n_tokens long")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))
