"""Operator 1: token counts of a unigram tokenizer, without making the tokens.

Method: count-only Viterbi. An Aho-Corasick automaton enumerates the vocabulary entries that end at
each character; dynamic programming carries the best score and its number of pieces. Ties follow the
public Unigram implementation of the ``tokenizers`` library: at an end the entry that starts first
stays unless a later one scores strictly higher, an unmatched character costs ten less than the
lowest score, and runs of unknown characters are spelled in bytes.

Vocabulary: the entries and scores of a sentencepiece model file, whose path is a parameter. No
unigram file is among the public ones on the box, so the default reads the pieces and scores of
``piece_bpe_32k.model`` as a unigram model; the tests hold counts against
``tokenizers.models.Unigram`` over the same pieces.

Scale: one pass, no shuffle. The text is cut where no vocabulary entry can reach across (before a
blank that follows another character, around a line feed), and counts of such cuts are remembered
in a dictionary of bounded size, so that the dynamic programming runs on new cuts only. A text without
blanks is one cut, for which a task holds 21 bytes a character beside the text.

Defined results: null or empty text counts 0; very long texts are counted whole; an empty table gives an
empty table; ids may be null or repeat, a row goes out for each row
that came in; extra columns are ignored.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from changeflow.llm.common import Memory, map_rows, worker_state

#: Entries of each generation of the memory of counts in a Python worker.
REMEMBERED = 250_000
#: Characters of a cut that is remembered.
LONGEST = 64
#: What an unmatched character costs below the lowest score (fixed value of the public tokenizer).
UNKNOWN_PENALTY = 10.0
SPACE = "▁"


def read_pieces(model: bytes) -> list[tuple[str, float]]:
    """The (piece, score) list of a sentencepiece model file, in id order."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor()
    sp.LoadFromSerializedProto(model)
    return [(sp.id_to_piece(i), sp.get_score(i)) for i in range(sp.get_piece_size())]


class Counter:
    """Counts the pieces of texts under a unigram vocabulary."""

    def __init__(self, pieces: list[tuple[str, float]]) -> None:
        import ahocorasick

        self.scores = dict(pieces)
        self.unknown = min(s for _, s in pieces) - UNKNOWN_PENALTY
        self.automaton = ahocorasick.Automaton()
        self.unknown_piece = pieces[0][0]
        for piece, score in self.scores.items():
            self.automaton.add_word(piece, (len(piece), score, piece == self.unknown_piece))
        self.automaton.make_automaton()
        self.spelled = all(f"<0x{b:02X}>" in self.scores for b in range(256))
        inner = any(SPACE in p.lstrip(SPACE) for p in self.scores)
        lines = any("\n" in p for p in self.scores)
        #: Whether blanks and line feeds bound what an entry can cover, so that cuts count apart.
        self.cuts = self.spelled and not inner and not lines and SPACE in self.scores and all(float(s).is_integer() for s in self.scores.values())
        self.known = Memory(REMEMBERED)

    def viterbi(self, s: str) -> int:
        """The number of ids of ``s``, in which blanks are already replaced."""
        n = len(s)
        # Flat numbers, 21 bytes a character, and entries as the automaton comes to their ends.
        best, count, start, unk = array("d", bytes(8 * (n + 1))), array("i", bytes(4 * (n + 1))), array("i", bytes(4 * (n + 1))), bytearray(n + 1)
        found = self.automaton.iter(s)
        end, entry = next(found, (n, None))
        # Entries ending at one character come by falling length, which is by rising start.
        for at in range(n):
            top, begin, is_unk = None, 0, False
            hit = False
            while end == at:
                length, score, of_unknown = entry
                if length == 1:
                    hit = True
                value = score + best[at + 1 - length]
                if top is None or value > top:
                    top, begin, is_unk = value, at + 1 - length, of_unknown
                end, entry = next(found, (n, None))
            if not hit:
                value = self.unknown + best[at]
                if top is None or value > top:
                    top, begin, is_unk = value, at, True
            best[at + 1], start[at + 1], unk[at + 1] = top, begin, is_unk
            count[at + 1] = count[begin] + 1
        if not any(unk):
            return count[n]
        total, end = 0, n
        while end > 0:
            if not unk[end]:
                total, end = total + 1, start[end]
                continue
            last = end
            while end > 0 and unk[end]:
                end = start[end]
            run = s[end:last]
            total += 1 if run in self.scores or not self.spelled else len(run.encode("utf-8", "surrogatepass"))
        return total

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if not self.cuts or self.unknown_piece in text:  # that piece, written out, joins runs of unknown characters
            return self.viterbi(SPACE + text.replace(" ", SPACE))
        self.known.turn()
        known, total, put = self.known.young, 0, self._put
        if SPACE in text:  # the sign itself is then ordinary text: it bounds cuts as a blank does
            text = text.replace(SPACE, " ")
        lines = text.split("\n")
        total += len(lines) - 1
        for k, line in enumerate(lines):
            words = line.split(" ")
            # The text begins with a blank of its own; so do all words of a line but its first.
            if k:
                first = words[0]
                if first:
                    c = known.get("\n" + first)
                    total += put("\n" + first, first) if c is None else c
                words = words[1:]
            if "" in words:
                total += self._spaced(words)
                continue
            for w in words:
                c = known.get(w)
                total += put(w, SPACE + w) if c is None else c
        return total

    def _put(self, key: str, s: str) -> int:
        c = self.known.recall(key)
        if c is None:
            c = self.viterbi(s)
            if len(key) <= LONGEST:  # a bound on memory, not only on entries
                self.known.young[key] = c
        return c

    def _spaced(self, words: list[str]) -> int:
        """Words each after one blank, where empty ones make runs of blanks."""
        total, blanks = 0, 0
        for w in words:
            blanks += 1
            if w:
                key = w if blanks == 1 else " " * blanks + w
                c = self.known.young.get(key)
                total += self._put(key, SPACE * blanks + w) if c is None else c
                blanks = 0
        return total + (self.viterbi(SPACE * blanks) if blanks else 0)


def token_counts(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens) of every row of ``docs``; ``vocabulary`` is the path of a sentencepiece model on the driver."""
    spark = docs.sparkSession
    with open(vocabulary, "rb") as f:
        model = spark.sparkContext.broadcast(f.read())  # one vocabulary file: its size does not follow the data

    def make():
        count = worker_state(("unigram", hash(model.value)), lambda: Counter(read_pieces(model.value))).count

        def work(batch: pa.RecordBatch) -> Iterator[dict]:
            yield {id_col: batch.column(0), "n_tokens": [count(t.as_py()) for t in batch.column(1)]}

        return work

    kind = docs.schema[id_col].dataType.simpleString()
    return map_rows(docs.select(id_col, text_col), make, f"`{id_col}` {kind}, n_tokens long")
