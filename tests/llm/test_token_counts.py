import random
import re

import pytest

from wavemill.llm.queries import PIECES
from wavemill.llm.token_counts import WORD_START, LongestMatch, sentencepiece_vocabulary, word_piece_counts


def greedy(word, vocabulary):
    n, at = 0, 0
    while at < len(word):
        end = next((e for e in range(len(word), at, -1) if word[at:e] in vocabulary), None)
        if end is None:
            return -1
        n, at = n + 1, end
    return n


@pytest.mark.parametrize("seed", range(4))
def test_same_as_greedy_search(seed):
    rng = random.Random(seed)
    vocabulary = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 5))) for _ in range(rng.choice([3, 8, 30]))}
    automaton = LongestMatch(vocabulary)
    for _ in range(3000):
        word = "".join(rng.choice("abcd" if rng.random() < 0.1 else "abc") for _ in range(rng.randint(0, 14)))
        assert automaton.count(word) == greedy(word, vocabulary), (word, vocabulary)


def test_long_words_take_linear_steps():
    assert LongestMatch({"a", "a" * 50, "b"}).count("a" * 100_000 + "b") == 2001


def test_documents(spark, sf):
    vocabulary = sentencepiece_vocabulary(PIECES)
    known = set(vocabulary)
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(40)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in word_piece_counts(docs, vocabulary).collect():
        counts = [greedy(WORD_START + w, known) for w in re.findall(r"[^\x20\x09-\x0D]+", texts[r.doc_id])]
        assert (r.n_words, r.n_tokens, r.n_unknown) == (len(counts), sum(1 if c < 0 else c for c in counts), counts.count(-1))


def test_nulls_repeats_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, None, 3), (1, None, 3), (None, "ab \u2603", 4), (2, "", 5)], "doc_id bigint, text string, n_tokens int")
    got = sorted(map(repr, (tuple(r) for r in word_piece_counts(docs, [WORD_START + "a", "b"]).collect())))
    assert got == sorted(map(repr, [(1, 0, 0, 0), (1, 0, 0, 0), (None, 2, 3, 1), (2, 0, 0, 0)]))
    assert word_piece_counts(docs.limit(0), ["a"]).collect() == []
