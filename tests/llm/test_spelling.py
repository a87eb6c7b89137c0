import itertools
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from wavemill.llm import spelling
from wavemill.llm.spelling import choose_pivots, gram_prefixes, near_words, spelling_forms, word_counts


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_forms(counts, ratio=10):
    out = {}
    near = {w: [x for x in counts if one_edit(w, x)] for w in counts}
    form = {}
    for w, own in near.items():
        best = min(own, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None)
    return out


def brute_counts(docs):
    lower = {ord(c): c.lower() for c in spelling._UPPER}
    found = Counter()
    for i, text in docs:
        run = ""
        for c in [*(text or ""), " "]:
            if c.isascii() and c.isalpha() or "À" <= c <= "ÿ":
                run += c
                continue
            if run:
                word = run.translate(lower)
                h = zlib.crc32(f"{'' if i is None else i}:{word}".encode())
                found[word[: h % len(word)] + word[h % len(word) + 1 :] if h % 31 == 0 else word] += 1
            run = ""
    return {w: n for w, n in found.items() if len(w) >= 7 and n >= 2}


def frame(spark, counts):
    return spark.createDataFrame(list(counts.items()), "word string, n bigint")


def vocabulary(seed, letters, size, low=5, high=9):
    draw, words = random.Random(seed), set()
    while len(words) < size:
        w = "".join(draw.choice(letters) for _ in range(draw.randint(low, high)))
        words.add(w)
        for _ in range(3):
            i, c = draw.randrange(len(w)), draw.choice(letters)
            words.add(draw.choice([w[:i] + c + w[i:], w[:i] + c + w[i + 1 :], w[:i] + w[i + 1 :] + c]))
    return {w: int(10 ** (draw.random() * 5)) + 1 for w in words if len(w) >= 5}


@pytest.mark.parametrize("seed, letters, size", [(1, "ab", 300), (2, "abcé", 400), (3, "etaoinshr", 500), (4, "a", 5)])
def test_same_as_all_pairs(spark, seed, letters, size):
    counts = {("a" * k): 10**k for k in range(5, 14)} if letters == "a" else vocabulary(seed, letters, size)
    got = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in spelling_forms(frame(spark, counts)).collect()}
    assert got == brute_forms(counts)


def test_grams_beyond_the_broadcast(spark, monkeypatch):
    monkeypatch.setattr(spelling, "BROADCAST_ROWS", 0)
    counts = vocabulary(5, "abcd", 200)
    got = {(r["word"], r["other"]) for r in near_words(frame(spark, counts)).collect()}
    assert got == {(a, b) for a, b in itertools.permutations(counts, 2) if one_edit(a, b)}


def test_pivots_are_the_cheapest_that_do_not_overlap():
    draw = random.Random(6)
    for _ in range(300):
        places = draw.sample(range(12), draw.randint(1, 7))
        costs = [draw.randint(1, 9) for _ in places]
        for count in (1, 2, 3):
            apart = [c for c in itertools.combinations(sorted(zip(places, costs, strict=True)), count) if all(b[0] - a[0] >= 2 for a, b in itertools.pairwise(c))]
            want = min(((sum(c for _, c in x), [p for p, _ in x]) for x in apart), default=(0, []))[1]
            assert choose_pivots(places, costs, count) == want


def test_prefixes_hold_the_rarest_grams(spark):
    words = vocabulary(7, "abc", 150)
    times = Counter(w[i : i + 2] for w in words for i in range(len(w) - 1))
    for row in gram_prefixes(frame(spark, words)).collect():
        w = row["word"]
        order = sorted((times[w[i : i + 2]], w[i : i + 2], i) for i in range(len(w) - 1))
        assert set(row["places"]) >= {i for *_, i in order[:3]} and len(row["places"]) <= 4
        assert len(row["pivots"]) == 2 and row["pivots"][1] - row["pivots"][0] >= 2 and set(row["pivots"]) <= {i for *_, i in order[:3]}


def test_words_of_documents(spark):
    draw = random.Random(8)
    letters = ["Abcdefg", "ABCDEFG", "abcdefgh", "Éabcdef", "ÉABCDEF", "éabcdef", "abc", "x" * 3000]
    docs = [(draw.choice([k, None, 7]), " ".join(draw.choice(letters) + draw.choice(["", "1", "-", "\n", "ā"]) for _ in range(60))) for k in range(80)] + [(1, None), (2, "")]
    docs += docs[:5]
    got = {r["word"]: r["n"] for r in word_counts(spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("word", F.lit(1))).collect()}
    assert got == brute_counts(docs)
    assert "x" * 3000 in got and any(len(w) == 2999 for w in got)


def test_long_words_meet_and_empty_tables(spark):
    counts = {"ab" * 5000: 500, "ab" * 2500 + "c" + "ab" * 2500: 7, "q" * 9000: 3}
    got = {r["word"]: r["root"] for r in spelling_forms(frame(spark, counts)).collect()}
    assert got == {w: r[1] for w, r in brute_forms(counts).items()}
    assert spelling_forms(frame(spark, counts).limit(0)).collect() == []
    rows = spark.createDataFrame([("abcdef", 20, 1, 2), (None, 3, 1, 2), ("abcdxf", 2, 1, 2)], "word string, n bigint, form int, own int")
    assert sorted(map(tuple, spelling_forms(rows).collect())) == [("abcdef", None, "abcdef", 20, 1, None), ("abcdxf", "abcdef", "abcdef", 2, 1, 20)]
    with pytest.raises(Exception, match="fewer than five"):
        spelling_forms(frame(spark, {"abcd": 3})).collect()


def test_chains_end_at_the_last_form(spark):
    counts = {"aaaaa" + "b" * k: 10**k for k in range(12)}
    got = {r["word"]: r["root"] for r in spelling_forms(frame(spark, counts)).collect()}
    assert set(got.values()) == {"aaaaa" + "b" * 11}


def test_pairs_are_joined_once(spark):
    plan = near_words(frame(spark, {"abcdefg": 2, "abcdefh": 3}))._jdf.queryExecution().optimizedPlan().toString()
    assert sum(line.lstrip(" :+-").startswith("Join") for line in plan.splitlines()) == 1


def test_only_long_runs_are_cut_out_and_only_ascii_is_lowered(spark):
    texts = ["abcdef ABCDEFG-abcdefg a1bcdefgh ÀBCDEFG Àbcdefg àbcdefg xÀ÷y×zßÿ abcdefÀ"] * 2 + ["ab" * 3 + "÷" + "cd" * 3, "İABCDEFG KABCDEF"]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id bigint, text string")
    for damage in (0, 1):
        counts = {r["word"]: r["n"] for r in word_counts(docs, damage=damage, min_count=1).collect()}
        want = Counter()
        for k, t in enumerate(texts):
            for run in re.findall(r"[A-Za-z\u00C0-\u00FF]+", t):
                word = re.sub("[A-Z]", lambda m: m[0].lower(), run)
                at = zlib.crc32(f"{k}:{word}".encode()) % len(word)
                word = word[:at] + word[at + 1 :] if damage else word
                want[word] += len(word) >= 7
        assert counts == {w: n for w, n in want.items() if n}
    plan = word_counts(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "{7,}" in plan
