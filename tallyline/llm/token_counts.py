"""Token counts by a unigram model without the tokens: count-only Viterbi.

An Aho-Corasick automaton names every vocabulary piece that ends at a place; dynamic programming keeps of each place the
best score and the number of pieces, nothing else. Ties follow the tokenizer: of equally good segmentations up to a place
the one whose last piece starts first stays. A character that no piece covers alone may be unknown, for the least score
less ten; an unknown character counts as its UTF-8 bytes if the vocabulary has byte pieces (byte fallback), else a run of
unknown characters counts once.

White space is escaped as the model's mark and every mark starts a word, so words are counted one by one; a worker
remembers the words it has met, up to a fixed number.
"""

from __future__ import annotations

import re
from functools import cache

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

MARK = "▁"
UNKNOWN_PENALTY = 10.0
REMEMBERED = 1_000_000
COUNTS = "struct<n_tokens:bigint,score:double>"


class UnigramCounter:
    """pieces: (piece, score); bytes_known: whether unknown characters fall back to bytes."""

    def __init__(self, pieces: list[tuple[str, float]], bytes_known: bool, remembered: int = REMEMBERED):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(score for _, score in pieces) - UNKNOWN_PENALTY
        self.bytes_known, self.remembered = bytes_known, remembered
        #: A character that no piece holds is unknown wherever it stands; with byte fallback, counts add up around it.
        line_feed_cuts = bytes_known and not any("\n" in piece for piece, _ in pieces)
        self.cut = re.compile(f"{MARK}[^{MARK}\n]*|\n|[^{MARK}\n]+" if line_feed_cuts else f"{MARK}[^{MARK}]*")
        self.counts: dict[str, int] = {}
        self.scores: dict[str, float] = {}

    @classmethod
    def of_model(cls, path: str) -> UnigramCounter:
        """From a sentencepiece model file: its pieces with their scores."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = [i for i in range(model.vocab_size()) if not model.is_unknown(i)]
        return cls([(model.id_to_piece(i), model.get_score(i)) for i in ids], any(model.is_byte(i) for i in ids))

    def segment(self, word: str) -> tuple[int, float]:
        """Pieces of the best segmentation, and its score."""
        n = len(word)
        ends: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
        for last, found in self.automaton.iter(word):
            ends[last + 1].append(found)
        best, pieces, unknown = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        for end in range(1, n + 1):
            top, length, alone = None, 0, False
            for size, score in ends[end]:
                alone |= size == 1
                score += best[end - size]
                if top is None or score > top or score == top and size > length:
                    top, length = score, size
            if not alone:
                score = best[end - 1] + self.unknown
                if top is None or score > top:
                    top, length = score, 0
            best[end], unknown[end] = top, length == 0
            if length:
                pieces[end] = pieces[end - length] + 1
            elif self.bytes_known:
                pieces[end] = pieces[end - 1] + len(word[end - 1].encode())
            else:
                pieces[end] = pieces[end - 1] + (not unknown[end - 1])
        return pieces[n], best[n]

    def words(self, text: str | None) -> list[str]:
        """The text's words, each with the mark of its space; where line feeds cut, the parts between them too."""
        if not text:
            return []
        marked = text.replace(" ", MARK)
        if marked[0] != MARK:
            marked = MARK + marked
        return self.cut.findall(marked)

    def count(self, texts: list[str | None]) -> list[tuple[int, float]]:
        split = [self.words(t) for t in texts]
        if len(self.counts) > self.remembered:
            self.counts.clear()
            self.scores.clear()
        for word in [w for w in set().union(*split) if w not in self.counts]:
            self.counts[word], self.scores[word] = self.segment(word)
        return [(sum(map(self.counts.__getitem__, words)), sum(map(self.scores.__getitem__, words))) for words in split]


@cache
def counter(path: str) -> UnigramCounter:
    """One for each worker."""
    return UnigramCounter.of_model(path)


def token_counts(text: Column, model: str) -> Column:
    """n_tokens and score of a text by the unigram model of a sentencepiece file, as a struct.

    Null and empty texts have no tokens and score 0. Counting is by row: other columns, repeated rows and null keys are
    nothing to it, and an empty table gives none. Texts are counted whole, however long.
    """

    def each(texts: pa.Array) -> pa.Array:
        own, out = counter(model), []
        for at in range(0, len(texts), 256):
            out += own.count(texts.slice(at, 256).to_pylist())
        counts, scores = zip(*out, strict=True) if out else ((), ())
        return pa.StructArray.from_arrays([pa.array(counts, pa.int64()), pa.array(scores, pa.float64())], ["n_tokens", "score"])

    return F.arrow_udf(each, COUNTS, F.ArrowUDFType.SCALAR)(text)
