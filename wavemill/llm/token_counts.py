"""Word-piece token counts by a linear longest-match automaton."""

from __future__ import annotations

import hashlib
import re
from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_WORDS = re.compile(r"[^\x20\x09-\x0D]+").findall
#: Marks the beginning of a word in the vocabulary.
WORD_START = "▁"


class LongestMatch:
    """Counts greedy longest-match pieces of a word without building them, in a time linear in its length.

    A trie of the vocabulary has at each node a failure link and the number of pieces that following it emits: for a node
    that spells s, greedy matching takes that many pieces off the front of s, and what is left of s is spelled by the node
    it links to. Matching walks the trie and, where no child fits, adds the count and follows the link.
    """

    def __init__(self, vocabulary: Iterable[str]) -> None:
        self.children: list[dict[str, int]] = [{}]
        ends = [False]
        for piece in vocabulary:
            node = 0
            for c in piece:
                after = self.children[node].get(c)
                if after is None:
                    after = self.children[node][c] = len(self.children)
                    self.children.append({})
                    ends.append(False)
                node = after
            ends[node] = node > 0
        self.link, self.popped = [-1] * len(ends), [0] * len(ends)
        queue = deque([0])
        while queue:
            node = queue.popleft()
            for c, child in self.children[node].items():
                queue.append(child)
                if ends[child]:
                    self.link[child], self.popped[child] = 0, 1
                    continue
                at, count = self.link[node], self.popped[node]
                while at >= 0 and c not in self.children[at]:
                    count += self.popped[at]
                    at = self.link[at]
                if at >= 0:
                    self.link[child], self.popped[child] = self.children[at][c], count

    def count(self, word: str) -> int:
        """Number of pieces, or -1 if the word can't be cut into pieces greedily."""
        children, link, popped = self.children, self.link, self.popped
        node = total = 0
        for c in word:
            while c not in children[node]:
                total += popped[node]
                node = link[node]
                if node < 0:
                    return -1
            node = children[node][c]
        while node:
            total += popped[node]
            node = link[node]
            if node < 0:
                return -1
        return total


class _Counts(dict):
    """Counts of words seen, within a bound."""

    def __init__(self, automaton: LongestMatch, limit: int = 500_000) -> None:
        super().__init__()
        self.automaton, self.limit = automaton, limit

    def __missing__(self, word: str) -> int:
        n = self.automaton.count(WORD_START + word)
        if len(word) <= 64:
            if len(self) >= self.limit:
                self.clear()
            self[word] = n
        return n


_automata: dict[str, _Counts] = {}


def _counts(vocabulary: str) -> _Counts:
    key = hashlib.sha256(vocabulary.encode()).hexdigest()
    if key not in _automata:
        _automata[key] = _Counts(LongestMatch(vocabulary.split("\n")))
    return _automata[key]


def sentencepiece_vocabulary(path: str) -> list[str]:
    """Pieces of a sentencepiece model that spell text: all but control, unknown and byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [model.id_to_piece(k) for k in range(model.get_piece_size()) if not (model.is_control(k) or model.is_unknown(k) or model.is_byte(k))]


def word_piece_counts(docs: DataFrame, vocabulary: Iterable[str], *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Word-piece tokens of each whole text: id_col, n_words, n_tokens, n_unknown (all bigint).

    Words are runs of anything but ASCII white space. A word's pieces are greedy longest matches of the vocabulary, the
    first beginning with the mark of a word's start; a word that can't be cut so counts as one unknown token. A null text counts as
    empty: all 0; a very long text is read in one task, with some 80 bytes for each of its words. One row per input row; repeated rows repeat; null ids stay; an empty table gives no rows; other columns are
    left out. The vocabulary (of a size that the tokenizer fixes) is broadcast; nothing is shuffled.
    """
    pieces = [x for x in vocabulary if x and "\n" not in x]
    shared = docs.sparkSession.sparkContext.broadcast("\n".join(pieces))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _counts(shared.value)
        for batch in batches:
            words, tokens, unknown = [], [], []
            for text in batch.column(1):
                found = _WORDS(text.as_py() or "")
                pieces = list(map(known.__getitem__, found))
                bad = pieces.count(-1)
                words.append(len(found))
                tokens.append(sum(pieces) + 2 * bad)
                unknown.append(bad)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, pa.int64()) for x in (words, tokens, unknown))], ["id", "w", "t", "u"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(count, f"`{id_col}` {kind}, n_words bigint, n_tokens bigint, n_unknown bigint")
