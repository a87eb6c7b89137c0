"""Spelling variants of words: near words found by pivotal grams, and the form that each variant stands for."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from wavemill.llm.common import discard, materialise

#: What a word is made of.
LETTER = "[A-Za-zÀ-ÿ]"
#: One edit leaves one of two disjoint grams whole, and two bigrams that overlap a third at most are always among three.
PIVOTS, PREFIX = 2, 3
#: Frequencies of this number of grams at most are broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 1_000_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def word_counts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_length: int = 7, min_count: int = 2, damage: int = 31) -> DataFrame:
    """word, n: how often each word of ``min_length`` code points or more occurs, if it does ``min_count`` times or more.

    Words are the maximal runs of ``LETTER``, A-Z lower-cased. Where the unsigned crc32 of ``<id>:<word>`` is divisible by ``damage`` the
    code point at that number modulo the word's length is deleted, before anything is counted (0: nothing is). A null id counts
    as an empty one, a null text has no words. Whole texts are read, in JVM functions, and counted where they lie before counts travel.
    """
    # a deletion only shortens, so shorter runs are left out at once; a match that is long enough starts where its run does
    run = F.lit(f"{LETTER}{{{max(1, min_length)},}}")
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all(F.col(text_col), run, 0)).alias("run"))
    ascii_only = F.octet_length("run") == F.length("run")  # there, lower() changes what translate() would
    runs = runs.select("id", F.when(ascii_only, F.lower("run")).otherwise(F.translate("run", _UPPER, _LOWER)).alias("word"))
    if damage:
        drawn = F.crc32(F.concat("id", F.lit(":"), "word").cast("binary"))
        at = F.pmod(F.col("drawn"), F.length("word")).cast("int")
        cut = F.concat(F.substring("word", F.lit(1), at), F.substr("word", at + 2))
        runs = runs.withColumn("drawn", drawn).select(F.when(F.col("drawn") % damage == 0, cut).otherwise(F.col("word")).alias("word"))
    counts = runs.where(F.length("word") >= min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") >= min_count)


def choose_pivots(places: Sequence[int], costs: Sequence[int], count: int = PIVOTS) -> list[int]:
    """``count`` places of bigrams that don't overlap, of least total cost; of equal totals, the first by place. None if there are not so many.

    By dynamic programming over the bigrams in order of their places: the best choice of k among the first m either leaves
    the m-th out or takes it after the best k - 1 among those that end before it.
    """
    order = sorted(range(len(places)), key=lambda x: places[x])
    best: list[list[tuple | None]] = [[(0, ())] + [None] * count]
    for m, x in enumerate(order):
        free = m
        while free and places[order[free - 1]] + 2 > places[x]:
            free -= 1
        row = list(best[m])
        for k in range(1, count + 1):
            before = best[free][k - 1]
            if before is not None:
                taken = (before[0] + costs[x], (*before[1], places[x]))
                row[k] = taken if row[k] is None else min(row[k], taken)
        best.append(row)
    found = best[-1][count]
    return list(found[1]) if found else []


@F.pandas_udf(ArrayType(IntegerType()))
def _pivots(places: pd.Series, costs: pd.Series) -> pd.Series:
    return pd.Series([choose_pivots(p.tolist(), c.tolist()) for p, c in zip(places, costs, strict=True)])


def gram_prefixes(words: DataFrame) -> DataFrame:
    """word, places array<int> (of the bigrams in its prefix), pivots array<int>.

    Bigrams are ordered by how often they occur among words, the rarest first, then by code point and by place. The prefix is
    the first ``PREFIX`` of a word, and the next place of the last one's bigram if it is there again.
    """
    grams = words.select("word", F.posexplode(F.regexp_extract_all(F.col("word"), F.lit(r"(?s)(?=(\P{Cs}{2}))"), 1)).alias("place", "gram"))
    known = materialise(grams.groupBy("gram").agg(F.count(F.lit(1)).alias("times")), "grams")
    known = F.broadcast(known) if known.count() <= BROADCAST_ROWS else known
    ordered = F.array_sort(F.collect_list(F.struct("times", "gram", "place")))
    rows = grams.join(known, "gram").groupBy("word").agg(ordered.alias("grams"))
    last = F.element_at("grams", PREFIX)
    again = F.filter("grams", lambda x: (x["gram"] == last["gram"]) & (x["place"] == last["place"] + 1))
    first = F.slice("grams", 1, PREFIX)
    rows = rows.select("word", first.alias("first"), F.array_union(first, again).alias("prefix"))
    of = lambda name, field: F.transform(name, lambda x: x[field])
    return rows.select("word", of("prefix", "place").alias("places"), _pivots(of("first", "place"), of("first", "times")).alias("pivots"))


def _keys(word: Column, place: Column, own: Column, indexed: Column) -> Column:
    """Keys at which a word of ``own`` code points with a whole bigram at ``place`` meets one that is an edit away, the one in the
    index having ``indexed`` code points.

    The edit lies after the bigram or before it. On the other side of it the words are equal, so that the bigram has the
    same distance from that end: this is how places limit what meets. Of the side with the edit, either the first half is
    equal too or the second, both counted by the word in the index.
    """
    after, before = indexed - place - 2, indexed - own + place  # code points of the edited side there
    half, front = F.floor(after / 2).cast("int"), F.floor(before / 2).cast("int")
    head, tail = F.substring(word, F.lit(1), place + 2), F.substr(word, place + 1)
    none = F.expr("cast(array() as array<bigint>)")
    one = lambda side, at, *content: F.xxhash64(F.lit(side), indexed, at, *content)
    return F.concat(
        F.when(after >= 0, F.array(one(0, place, head, F.substring(word, place + 3, half)), one(1, place, head, F.substr(word, own - (after - half) + 1)))).otherwise(none),
        F.when(before >= 0, F.array(one(2, own - place, tail, F.substring(word, F.lit(1), front)), one(3, own - place, tail, F.substring(word, place - (before - front) + 1, before - front)))).otherwise(none),
    )


def near_words(words: DataFrame) -> DataFrame:
    """word, other: every ordered pair of different words that one inserted, deleted or replaced code point tells apart.

    ``words`` has distinct words of five code points or more; other columns are left out. One edit leaves one of the two pivots
    of a word whole, and if the last bigram of its prefix doesn't come after that of the other word in the common order,
    that pivot is in the other's prefix. So pivots are looked up in prefixes, under keys that also hold what must be
    equal besides, and what meets is verified. No key has more words than differ in one half of one side.
    """
    prefixes = materialise(gram_prefixes(words), "prefixes").withColumn("own", F.length("word"))
    keyed = lambda length: F.explode(_keys(F.col("word"), F.col("place"), F.col("own"), length)).alias("key")
    index = prefixes.select("word", "own", F.explode("places").alias("place"))
    index = index.select(F.col("word").alias("other"), keyed(F.col("own")))
    probes = prefixes.select("word", "own", F.explode("pivots").alias("place")).select("*", F.explode(F.array(*(F.col("own") + d for d in (-1, 0, 1)))).alias("length"))
    probes = probes.select("word", keyed(F.col("length")))
    met = probes.join(index, "key").where(F.col("word") != F.col("other")).select("word", "other")
    met = met.where(F.levenshtein("word", "other", 1) == 1)
    # a union of both orders would join twice
    pairs = met.select(F.least("word", "other").alias("a"), F.greatest("word", "other").alias("b")).distinct()
    both = F.inline(F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("other")), F.struct(F.col("b").alias("word"), F.col("a").alias("other"))))
    return pairs.select(both)


def spelling_forms(words: DataFrame, *, ratio: int = 10) -> DataFrame:
    """The form that each word is a variant of: word, form, root string; n, n_near, form_n bigint.

    ``words`` has word string and n bigint, a row for each word; words have five code points or more, or the job fails. A word's
    form is its near word of largest n (ties: the first in code-point order), if that is ``ratio`` times its own or more; else
    null, and form_n too. root follows the forms to the last; it is the word itself if it has none. n_near counts all near
    words. Since n grows ``ratio`` times with each step, forms have no cycles and short chains, which are followed by joins that
    double their length each time. Null words are left out; an empty table gives no rows; other columns are left out. A
    word has a bounded number of near words (an alphabet's), so no key is hot, and pairs travel once.
    """
    words = words.where(F.col("word").isNotNull()).select("word", "n")
    short = F.raise_error(F.concat(F.lit("a word of fewer than five code points: "), F.col("word"))).cast("boolean")
    words = materialise(words.where(F.when(F.length("word") >= 5, True).otherwise(short)), "words")
    near = near_words(words).join(words.select(F.col("word").alias("other"), F.col("n").alias("other_n")), "other")
    best = near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    rows = words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.col("best.other").alias("other"), (-F.col("best.less")).alias("other_n"))
    high = F.col("other_n") >= ratio * F.col("n")
    rows = materialise(rows.select("word", "n", "n_near", F.when(high, F.col("other")).alias("form"), F.when(high, F.col("other_n")).alias("form_n")), "forms")
    chains = rows.where("form is not null").select("word", F.col("form").alias("root"))
    grows = True
    while grows:
        after = chains.select(F.col("word").alias("middle"), F.col("root").alias("end"))
        longer = chains.join(after, F.col("root") == F.col("middle"), "left")
        before, chains = chains, materialise(longer.select("word", F.coalesce("end", "root").alias("root"), F.col("end").isNotNull().alias("moved")), "chains")
        grows = not chains.where("moved").isEmpty()
        if "moved" in before.columns:
            discard(before)
    discard(words)
    return rows.join(chains.select("word", "root"), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
