import collections
import hashlib
import math

import pytest
from pyspark.sql import functions as F

from wavemill.llm.queries import URL_RULES
from wavemill.llm.url_filter import ORDER, Rule, judge_urls, windows_of

URLS = [
    "http://a.example.org/en/2", "https://A.Example.ORG/en/17?x=1", "http://example.org/es/9#top", "http://example.org/es", "http://badexample.org/es/1", "http://x.com/fr/3", "http://x.com/de/3",
    "http://y.net/de/4", "http://y.net/fr/4.html", "ftp://com/fr/", "http://com?/fr/", "http://x.org", "no scheme/at.all", "", None, "://", "HTTP://z.COM/DE/1", "http://z.com/de/://q", "http://aé\U0001f600.net/x", "http://y.net/fr/" + "ab/" * 3000,
]


def parts(url):
    if url is None or "://" not in url:
        return "", "", url or ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    stop = min([rest.find(c) for c in "?#" if c in rest], default=len(rest))
    return "".join(c.lower() if c.isascii() else c for c in rest[:end]), rest[end:stop] if stop > end else "", rest


def brute(urls, rules=URL_RULES):
    """host, path, rule, verdict, score and threshold of each URL, straight from the definitions."""
    rows = []
    for url in urls:
        host, path, text = parts(url)
        fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        rule = max(fits, key=lambda r: (len(r.text), len(r.host), r.verdict == "block"), default=None)
        text = "".join(c.lower() if c.isascii() else c for c in text)
        rows.append((host, path, rule, text, hashlib.md5(text.encode()).hexdigest()[0] in "012"))
    counts = [collections.defaultdict(collections.Counter) for _ in range(2)]
    known = set()
    for _, _, rule, text, held in rows:
        padded = "\x02" * ORDER + text + "\x03"
        for i in range(ORDER, len(padded)):
            known.add(padded[i])
            if rule is not None and not held:
                for k in range(ORDER + 1):
                    counts[rule.verdict == "allow"][padded[i - k : i]][padded[i]] += 1

    def p(model, context, c):
        shorter = p(model, context[1:], c) if context else 1 / len(known)
        own = model.get(context)
        return (own[c] + len(own) * shorter) / (own.total() + len(own)) if own else shorter

    scores = []
    for *_, text, _ in rows:
        padded = "\x02" * ORDER + text + "\x03"
        each = [math.log(p(counts[1], padded[i - ORDER : i], padded[i])) - math.log(p(counts[0], padded[i - ORDER : i], padded[i])) for i in range(ORDER, len(padded))]
        scores.append(sum(each) / len(each))
    fold = [(s, r[2].verdict == "allow") for s, r in zip(scores, rows, strict=True) if r[4] and r[2] is not None]
    good, bad = sum(a for _, a in fold), sum(not a for _, a in fold)
    threshold = 0.0
    if good and bad:
        steps = {math.floor(s * 64) for s, _ in fold}
        gain = lambda t: round(sum(s * 64 < t for s, a in fold if not a) / bad - sum(s * 64 < t for s, a in fold if a) / good, 12)
        threshold = min(steps | {max(steps) + 1}, key=lambda t: (-gain(t), abs(t), t)) / 64
    out = []
    for (host, path, rule, _, _), s in zip(rows, scores, strict=True):
        out.append((host, path, rule and rule.text, rule.verdict if rule else "allow" if s >= threshold else "block", s, threshold))
    return out


def check(spark, urls, **more):
    frame = spark.createDataFrame([(k, u, "x") for k, u in enumerate(urls)], "page_id bigint, url string, gram string")
    got = sorted(map(tuple, judge_urls(frame, URL_RULES, **more).collect()))
    want = [(k, *r) for k, r in enumerate(brute(urls))]
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for a, b in zip(got, want, strict=True):
        assert a[5:] == pytest.approx(b[5:], abs=1e-8)


def many(n):
    return URLS + [f"https://{'ab'[k % 2]}{k % 7}.example.{('org', 'com', 'net')[k % 3]}/{('en', 'fr', 'de', 'es')[k * k % 4 + k % 2 * (k % 3 > 0)]}/{k * 37 % 999}" for k in range(n)]


@pytest.mark.parametrize("broadcast_rows", [1_000_000, 40])
def test_same_as_the_definitions(spark, broadcast_rows):
    check(spark, many(150), broadcast_rows=broadcast_rows)


def test_few_rows(spark):
    check(spark, [None])
    check(spark, ["http://x.com/fr/3"] * 3 + ["http://q.net/"])
    frame = spark.createDataFrame([], "page_id bigint, url string")
    assert judge_urls(frame, URL_RULES).collect() == []


def test_null_and_repeated_ids_keep_their_rows(spark):
    frame = spark.createDataFrame([(None, "http://a.org/"), (None, "http://a.org/"), (1, None), (1, "http://a.com/de/")], "page_id bigint, url string")
    got = [tuple(r)[:5] for r in judge_urls(frame, URL_RULES).collect()]
    judged = brute(["http://a.org/", "http://a.org/", None, "http://a.com/de/"])[2][3]
    assert sorted(map(str, got)) == sorted(map(str, [(None, "a.org", "/", "org/", "allow")] * 2 + [(1, "", "", None, judged), (1, "a.com", "/de/", "com/de/", "block")]))


def test_models_tell_the_rules_apart(spark):
    """URLs that rules decide and from which the models did not learn are told apart by the models alone."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    rows = judge_urls(pages, URL_RULES).where("rule is not null").join(pages.select("page_id", "url"), "page_id").toPandas()
    held = rows["url"].map(lambda u: hashlib.md5(parts(u)[2].lower().encode()).hexdigest()[0] in "012")
    right = (rows["verdict"] == "allow") == (rows["score"] >= rows["threshold"])
    assert held.sum() > 100 and right[held].mean() > 0.95


def test_longest_rule_wins_and_ties_block(spark):
    rules = (Rule("allow", "a.b", "/"), Rule("block", "b", "/cc"), Rule("allow", "b", "/cc"))
    frame = spark.createDataFrame([(1, "http://x.a.b/ccd"), (2, "http://a.b/c"), (3, "http://b/cc")], "page_id bigint, url string")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in judge_urls(frame, rules).collect()}
    assert got == {1: ("a.b/", "allow"), 2: ("a.b/", "allow"), 3: ("b/cc", "block")}


def test_no_python_in_the_plan(spark, sf, capsys):
    judge_urls(spark.read.parquet(f"{sf}/pages.parquet"), URL_RULES).explain("formatted")
    assert not any(x in capsys.readouterr().out for x in ("Python", "Arrow", "Pandas"))


def test_windows_are_whole_characters(spark):
    text = "a\U0001f600b"
    got = spark.createDataFrame([(text,)], "t string").select(windows_of(F.col("t")).alias("w")).first()["w"]
    padded = "\x02" * ORDER + text + "\x03"
    assert got == [padded[i : i + ORDER + 1] for i in range(len(padded) - ORDER)]
