"""URL filtering: rules by host and path, and a ratio of character language models for what no rule decides.

Everything here is DataFrame functions; no Python runs in tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wavemill.llm.common import discard, materialise

#: Characters of context of the longest model.
ORDER = 4
#: Windows of this number at most are broadcast; of more, those that could be hot are, which are fewer.
BROADCAST_ROWS = 1_000_000
#: Thresholds tried for a unit of mean log-likelihood difference.
STEPS = 64
_START, _END = "\x02", "\x03"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """A verdict, allow or block, for a host with all its subdomains and for the paths that begin with ``path``."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def text(self) -> str:
        return self.host + self.path


def after_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty for null and where there is none."""
    return F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise("")


def host_of(url: Column) -> Column:
    """After the scheme up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.translate(F.regexp_extract(after_scheme(url), "^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(after_scheme(url), "^[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """(text, verdict) of the longest rule that fits, null if none; of equally long ones that of the longer host, then a block."""
    found = F.lit(None).cast("struct<text:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.text), len(r.host), r.verdict == "block")):
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        found = F.when(fits, F.struct(F.lit(rule.text).alias("text"), F.lit(rule.verdict).alias("verdict"))).otherwise(found)
    return found


def modelled_text(url: Column) -> Column:
    """What the models read of a URL: what follows the scheme, or all if there is none, A-Z lower-cased; null is empty."""
    return F.translate(F.when(F.instr(url, "://") > 0, after_scheme(url)).otherwise(F.coalesce(url, F.lit(""))), _UPPER, _LOWER)


def windows_of(text: Column) -> Column:
    """Each character of a text, and its end, with the ``ORDER`` characters before it (before the first one, start marks).

    Found by a lookahead at every place, which takes time in proportion to the text, however long.
    """
    padded = F.concat(F.lit(_START * ORDER), text, F.lit(_END))
    return F.regexp_extract_all(padded, F.lit(rf"(?s)(?=(\P{{Cs}}{{{ORDER + 1}}}))"), 1)


def window_counts(rows: DataFrame) -> DataFrame:
    """By window: seen, and how often in accepted and in rejected URLs of the training part. ``rows`` has text and, for training rows
    only, accepted (boolean)."""
    each = rows.select("accepted", F.explode(windows_of(F.col("text"))).alias("gram"))
    return each.groupBy("gram").agg(F.count(F.lit(1)).alias("seen"), F.count_if("accepted").alias("a"), F.count_if(~F.col("accepted")).alias("r"))


def window_ratios(counts: DataFrame) -> DataFrame:
    """gram, seen, ratio double: log-likelihood of each window's last character after the others in accepted URLs, less that in rejected ones.

    Both models are Markov models of variable order by Witten and Bell: after a context that was seen N times with T different
    characters, a character seen n times has probability (n + T p) / (N + T), p being that after the context without its first
    character; a context that was never seen leaves p as it is. Below order 0 all known characters are equally likely. Each
    order is one table of distinct grams, computed from the order below by a join on the gram without its first character, so
    no key has more rows than there are characters.
    """
    below = None
    for order in range(ORDER + 1):
        level = counts.groupBy(F.substring("gram", ORDER + 1 - order, order + 1).alias("gram")).agg(F.sum("a").alias("a"), F.sum("r").alias("r")) if order < ORDER else counts
        context = Window.partitionBy(F.substring("gram", 1, order))
        stats = {f"n_{c}": F.sum(c).over(context) for c in "ar"} | {f"t_{c}": F.count_if(F.col(c) > 0).over(context) for c in "ar"}
        if below is None:
            level = level.withColumns(stats | {"p_a": 1 / F.count(F.lit(1)).over(context), "p_r": 1 / F.count(F.lit(1)).over(context)})
        else:
            level = level.withColumns(stats).join(below, F.substring("gram", 2, order) == F.col("shorter"))
        smoothed = {c: F.when(F.col(f"n_{c}") > 0, (F.col(c) + F.col(f"t_{c}") * F.col(f"p_{c}")) / (F.col(f"n_{c}") + F.col(f"t_{c}"))).otherwise(F.col(f"p_{c}")) for c in "ar"}
        if order == ORDER:
            return level.select("gram", "seen", (F.log(smoothed["a"]) - F.log(smoothed["r"])).alias("ratio"))
        below = level.select(F.col("gram").alias("shorter"), smoothed["a"].alias("p_a"), smoothed["r"].alias("p_r"))


def mean_ratios(rows: DataFrame, ratios: DataFrame, key: Sequence[str], broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``key`` columns, and score double: the mean ratio of the windows of each row's text, to nine digits. ``key`` tells rows apart.

    A row's windows are summed where they lie and never travel if the table of ratios is broadcast, which its count decides.
    Beyond ``broadcast_rows`` only windows that make up more than one in ``broadcast_rows`` of all are, which can't be more than
    that; the others have no hot key and meet their ratios by a shuffle.
    """
    each = rows.select(*key, F.explode(windows_of(F.col("text"))).alias("window"))
    if ratios.count() <= broadcast_rows:
        met = each.join(F.broadcast(ratios), F.col("window") == F.col("gram"))
    else:
        total = ratios.agg(F.sum("seen")).first()[0]
        hot = ratios.where(F.col("seen") * broadcast_rows > total)
        cold = each.join(F.broadcast(hot), F.col("window") == F.col("gram"), "left_anti").join(ratios.where(F.col("seen") * broadcast_rows <= total), F.col("window") == F.col("gram"))
        met = each.join(F.broadcast(hot), F.col("window") == F.col("gram")).unionByName(cold)
    return met.groupBy(*key).agg(F.round(F.sum("ratio") / F.count(F.lit(1)), 9).alias("score"))


def calibrated_threshold(scored: DataFrame) -> float:
    """The threshold, in steps of one in ``STEPS``, from which on labelled (score, accepted) rows of both kinds are told apart
    best, each kind weighing a half; of equally good ones that nearest to 0, then the lower. Without rows of both kinds 0.

    Rows are counted by step; only steps, which span the range of a mean log-likelihood difference, are put in order.
    """
    steps = scored.groupBy(F.floor(F.col("score") * STEPS).alias("step")).agg(F.count_if("accepted").alias("a"), F.count_if(~F.col("accepted")).alias("r"))
    above = Window.orderBy("step")
    before, whole = above.rowsBetween(Window.unboundedPreceding, -1), Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    lost, stopped = F.coalesce(F.sum("a").over(before), F.lit(0)), F.coalesce(F.sum("r").over(before), F.lit(0))
    # the steps themselves, and one above all
    steps = steps.unionByName(steps.agg((F.max("step") + 1).alias("step")).select("step", F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("r")).where("step is not null"))
    rates = steps.select("step", F.when((F.sum("a").over(whole) > 0) & (F.sum("r").over(whole) > 0), F.round(stopped / F.sum("r").over(whole) - lost / F.sum("a").over(whole), 12)).alias("gain"))
    best = rates.where("gain is not null").orderBy(F.desc("gain"), F.abs("step"), "step").first()
    return best["step"] / STEPS if best else 0.0


def judge_urls(pages: DataFrame, rules: Sequence[Rule], *, id_col: str = "page_id", url_col: str = "url", broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """A verdict on every URL: id_col, host, path, rule (null if none fits), verdict (allow or block), score double, threshold double.

    One row per input row. The longest fitting rule decides. For the others two character models do, learned from all URLs that
    rules accept and that rules reject: allow from a mean log-likelihood difference of ``threshold`` on. That is calibrated on the
    URLs whose md5 begins with 0, 1 or 2, from which the models don't learn; equal URLs are on one side. Host and path are
    empty for null and for URLs without ``://``; such a URL is modelled as it stands (null: as an empty one), and a URL of any
    length as a whole. Without accepted or rejected URLs the scores and the threshold are 0 and the method allows. Ids may be
    null or repeat; an empty table gives no rows; other columns are left out. ``rules`` is a list in the plan: some hundreds at most.
    """
    url = F.col(url_col)
    rows = pages.select(F.col(id_col).alias("id"), host_of(url).alias("host"), path_of(url).alias("path"), modelled_text(url).alias("text"))
    rows = rows.withColumn("found", matching_rule(F.col("host"), F.col("path"), rules))
    rows = rows.select("id", "host", "path", "text", F.col("found.text").alias("rule"), F.col("found.verdict").alias("ruled"))
    rows = materialise(rows.withColumn("row", F.monotonically_increasing_id()), "urls")
    held = F.substring(F.md5(F.col("text").cast("binary")), 1, 1).isin("0", "1", "2")
    kind = F.when(F.col("ruled").isNotNull(), F.col("ruled") == "allow")
    counts = materialise(window_counts(rows.select("text", F.when(~held, kind).alias("accepted"))), "windows")
    ratios = materialise(window_ratios(counts), "ratios")
    key = ["row", "id", "host", "path", "rule", "ruled", "held"]
    scored = materialise(mean_ratios(rows.withColumn("held", held), ratios, key, broadcast_rows), "scores")
    threshold = calibrated_threshold(scored.where("held and ruled is not null").select("score", (F.col("ruled") == "allow").alias("accepted")))
    discard(rows, counts, ratios)
    verdict = F.coalesce("ruled", F.when(F.col("score") >= threshold, "allow").otherwise("block"))
    return scored.select(F.col("id").alias(id_col), "host", "path", "rule", verdict.alias("verdict"), "score", F.lit(threshold).alias("threshold"))
