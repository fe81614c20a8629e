"""Token counts under a unigram vocabulary, by a Viterbi search that keeps only counts.

An Aho-Corasick automaton lists the vocabulary pieces that end at each character; the search
carries the best score and its number of pieces, and needs them only as far back as the longest
piece, so memory does not grow with the text. The rules are those of unigram tokenizers:

* scores are summed in double precision; a path replaces another only if it is better, starts
  being tried from the left, so of equal paths the one with the longest last piece wins;
* a character that is no piece by itself may be unknown, at 10 below the least score;
* an unknown character counts as its UTF-8 bytes where the vocabulary has byte pieces, else a
  run of unknown characters counts as one;
* a space is written as U+2581 and one is put before the text; an empty text has no tokens.

Where no piece has U+2581 after another character, paths of a text break before each run of
them; counts of such words are kept in a table of bounded size. Other vocabularies are searched
over whole texts.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from tillsight.llm.common import quoted

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: vocabulary of a public tokenizer; its pieces and scores are read as those of a unigram model
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
UNKNOWN = 10.0
#: words whose counts a task keeps, and characters that are cut into words at once
KEPT, SLICE = 200_000, 1 << 20


class Vocabulary(NamedTuple):
    pieces: list[tuple[str, float]]
    least: float
    byte_fallback: bool


def read_vocabulary(path: str = VOCABULARY) -> Vocabulary:
    """Ordinary pieces of a sentencepiece file. Control, unknown and byte pieces never match."""
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=path)
    ids = range(sp.get_piece_size())
    plain = [i for i in ids if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    pieces = [(sp.id_to_piece(i), sp.get_score(i)) for i in plain]
    return Vocabulary(pieces, min((s for _, s in pieces), default=0.0), any(sp.is_byte(i) for i in ids))


class Counter(dict):
    """Number of tokens of a word, found when first asked for. ``word`` is without the mark
    before it."""

    def __init__(self, vocabulary: Vocabulary):
        import ahocorasick

        super().__init__()
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary.pieces:
            self.automaton.add_word(piece, (len(piece), score))
        if vocabulary.pieces:
            self.automaton.make_automaton()
        self.some = bool(vocabulary.pieces)
        self.unknown = vocabulary.least - UNKNOWN
        self.bytes = vocabulary.byte_fallback
        self.longest = max((len(p) for p, _ in vocabulary.pieces), default=1)
        # a run of unknown characters may go on over a mark that is no piece by itself
        crossing = any(re.search(f"[^{MARK}]{MARK}", p) for p, _ in vocabulary.pieces)
        self.whole = crossing or (not self.bytes and MARK not in self.automaton)

    def __missing__(self, word: str) -> int:
        if len(self) >= KEPT:
            self.clear()
        n = self.viterbi(MARK + word)
        if len(word) <= 100:
            self[word] = n
        return n

    def viterbi(self, text: str) -> int:
        """Number of pieces on the best path through ``text``."""
        ring = self.longest + 1
        best, count, unknown = [0.0] * ring, [0] * ring, [False] * ring
        done = 0  # characters that all pieces ending before have been tried for

        def finish(end: int, top: float | None, at: int, single: bool) -> None:
            slot, last = end % ring, (end - 1) % ring
            if not single and (top is None or best[last] + self.unknown > top):
                width = len(text[end - 1].encode("utf-8", "surrogatepass")) if self.bytes else int(not unknown[last])
                best[slot], count[slot], unknown[slot] = best[last] + self.unknown, count[last] + width, True
            else:
                best[slot], count[slot], unknown[slot] = top, count[at] + 1, False

        top, at, single = None, 0, False
        length = 0
        for end, (size, score) in self.automaton.iter(text) if self.some else ():
            while done < end:
                finish(done + 1, top, at, single)
                done += 1
                top, at, single, length = None, 0, False, 0
            start = (end + 1 - size) % ring
            total = best[start] + score
            if top is None or total > top or (total == top and size > length):
                top, at, length = total, start, size
            single = single or size == 1
        while done < len(text):
            finish(done + 1, top, at, single)
            done += 1
            top, at, single, length = None, 0, False, 0
        return count[len(text) % ring]

    def tokens(self, text: str | None) -> int:
        if not text:
            return 0
        if self.whole:
            return self.viterbi(MARK + text.replace(" ", MARK))
        total, at = 0, 0
        while at < len(text):
            end = at + SLICE
            while end < len(text) and not (text[end] == " " != text[end - 1]):
                end += 1
            part, at = text[at:end], end + 1
            if end == len(text) - 1:  # a space at the very end is a word of its own
                part, at = text[at - 1 - len(part) : len(text)], len(text)
            words = part.split(" ")
            if "" not in words:
                total += sum(map(self.__getitem__, words))
            else:
                marked = MARK + part.replace(" ", MARK)
                total += sum(self[w[1:]] for w in re.findall(f"{MARK}+[^{MARK}]*", marked))
        return total


def token_counts(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: (``id_col``, n_tokens). Null and empty texts have none;
    repeated rows and null ids stay. Further columns are left out. No row is moved."""

    @pandas_udf(T.LongType())
    def count(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = Counter(vocabulary)
        for batch in texts:
            yield pd.Series([counter.tokens(t) for t in batch], dtype="int64")

    return docs.select(quoted(id_col).alias(id_col), count(F.coalesce(quoted(text_col), F.lit(""))).alias("n_tokens"))
