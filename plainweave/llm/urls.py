"""URL filter: rules by host and path, then a character language-model ratio.

URLs that a rule judges train two smoothed variable-order Markov models, one
of accepted and one of rejected URLs. A URL without a rule is judged by the
difference of its log-likelihoods under the two, a character on average. The
threshold is calibrated on the judged URLs, each scored by models of the other
half. Only DataFrame functions are used; n-grams are counted once each and
every table is shuffled by n-gram.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plainweave.operators.staging import stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BEGIN, END = "\x02", "\x03"
ORDER = 4  # characters of context at most
STRENGTH = 5.0  # weight of the next shorter context, in characters seen
ALPHABET = 256
UNIT = 1_000_000  # scores are held as integers of millionths
BIN, TOP = 10_000, 1000
MODELS = ("", "0", "1")  # all judged URLs, and each half
PART_BYTES = 1 << 18  # of URLs in a task; their n-grams take a hundred times as much

Rule = tuple[str, str]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty without `://`."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def rule_columns(rules: list[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, or null."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decision, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        own, slash, rest = rule.partition("/")
        fits = ((host == own) | F.endswith(host, F.lit("." + own))) & F.startswith(path, F.lit(slash + rest))
        text = F.when(fits, F.lit(rule)).otherwise(text)
        verdict = F.when(fits, F.lit(decision)).otherwise(verdict)
    return text, verdict


def _grams(urls: DataFrame) -> DataFrame:
    """One row per character of a URL and its end: the n-grams that end there,
    by length; `full` is the one that is scored."""
    chars = F.split(F.concat(F.lit(BEGIN), "url", F.lit(END)), "")
    spelled = urls.withColumn("chars", chars)
    sizes = F.array(*[F.lit(k) for k in range(1, ORDER + 2)])
    ends = F.sequence(F.lit(2), F.size("chars"))
    at = spelled.select(
        "url", "verdict", "half", "copies",
        F.explode(
            F.transform(
                ends,
                lambda e: F.transform(
                    F.filter(sizes, lambda k: k <= e),
                    lambda k: F.array_join(F.slice("chars", (e - k + 1).cast("int"), k.cast("int")), ""),
                ),
            )
        ).alias("grams"),
    )
    return at.withColumn("full", F.element_at("grams", -1))


def _counts(places: DataFrame) -> DataFrame:
    """How often every n-gram stands in accepted and rejected URLs, in all and
    by half; n-grams of other URLs are there with zero."""

    def count(verdict: str, half: str) -> Column:
        hit = F.col("verdict") == verdict
        if half:
            hit &= F.col("half") == half
        return F.sum(F.when(hit, F.col("copies")).otherwise(0))

    rows = places.select("verdict", "half", "copies", F.explode("grams").alias("gram"))
    named = [count(v, h).alias(f"{n}{h}") for v, n in (("allow", "a"), ("block", "r")) for h in MODELS]
    counted = stage(rows.groupBy("gram").agg(*named))  # spelled out once, read by every order
    # the begin is followed once by every URL
    first = counted.where((F.length("gram") == 2) & F.startswith("gram", F.lit(BEGIN)))
    columns = [f"{n}{h}" for n in "ar" for h in MODELS]
    sums = first.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in columns]).first()
    begin = counted.sparkSession.range(1).select(F.lit(BEGIN).alias("gram"), *[F.lit(sums[c]).cast("long").alias(c) for c in columns])
    return counted.unionByName(begin)


def _ratios(counts: DataFrame) -> DataFrame:
    """Log-likelihood ratio, in millionths, of the last character of every
    n-gram after the characters before it, by model."""
    columns = [f"{n}{h}" for n in "ar" for h in MODELS]
    single = counts.where((F.length("gram") == 1) & (F.col("gram") != BEGIN))
    totals = single.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(f"t{c}") for c in columns]).first()
    lower = single.select(
        "gram",
        *[((F.col(c) + F.lit(STRENGTH / ALPHABET)) / F.lit(totals[f"t{c}"] + STRENGTH)).alias(f"p{c}") for c in columns],
    )
    out = None
    for size in range(2, ORDER + 2):
        longer = counts.where(F.length("gram") == size).select(
            "gram", *columns,
            F.substring("gram", 2, size).alias("short"), F.substring("gram", 1, size - 1).alias("context"),
        )
        context = counts.where(F.length("gram") == size - 1).select(
            F.col("gram").alias("context"), *[F.col(c).alias(f"n{c}") for c in columns]
        )
        joined = longer.join(lower.withColumnRenamed("gram", "short"), "short").join(context, "context")
        lower = stage(joined.select(
            "gram",
            *[((F.col(c) + F.lit(STRENGTH) * F.col(f"p{c}")) / (F.col(f"n{c}") + F.lit(STRENGTH))).alias(f"p{c}") for c in columns],
        ))
        used = lower if size == ORDER + 1 else lower.where(F.startswith("gram", F.lit(BEGIN)))
        ratio = [F.round((F.ln(f"pa{h}") - F.ln(f"pr{h}")) * UNIT).cast("long").alias(f"s{h}") for h in MODELS]
        rows = used.select(F.col("gram").alias("full"), *ratio)
        out = rows if out is None else out.unionByName(rows)
    return out


def threshold(scores: DataFrame) -> int | None:
    """Lowest score to accept: where the shares of accepted URLs kept and of
    rejected URLs dropped add up to most, midway between the scores on either
    side. Null if there is none of either."""
    placed = F.greatest(F.lit(-TOP), F.least(F.lit(TOP), F.floor(F.col("held_out") / BIN)))
    counted = scores.where("verdict is not null").groupBy(placed.alias("bin")).agg(
        F.sum(F.when(F.col("verdict") == "allow", F.col("copies")).otherwise(0)).alias("a"),
        F.sum(F.when(F.col("verdict") == "block", F.col("copies")).otherwise(0)).alias("r"),
    )
    bins = sorted((r["bin"], r["a"], r["r"]) for r in counted.collect())  # at most 2 * TOP + 1
    accepted, rejected = sum(b[1] for b in bins), sum(b[2] for b in bins)
    if not accepted or not rejected:
        return None
    best, at, kept, dropped = -1, None, accepted, 0
    before = bins[0][0]
    for place, a, r in bins:
        good = kept * rejected + dropped * accepted
        if good > best:
            best, at = good, (before + place) * BIN // 2
        kept, dropped, before = kept - a, dropped + r, place
    return at


def judge(pages: DataFrame, rules: list[Rule], url_col: str = "url") -> DataFrame:
    """`pages` with host, path, rule (the longest that fits, else null), verdict
    (allow or block) and score (millionths of a nat a character, null without
    one).

    A rule `host/path` fits its host and subdomains where the URL's path starts
    with the rule's. A null or empty URL has empty host and path and, like all
    URLs if the rules accept none or reject none, is allowed unless a rule
    blocks it. Equal URLs are scored once and train as often as they stand in
    the table. Long URLs are spelled whole. Columns with the names of the new
    ones are replaced, others pass whatever their names; an empty table gives
    an empty result.
    """
    new = ("host", "path", "rule", "verdict", "score")
    keep = [c for c in pages.columns if c not in new]
    own = {c: f"k{i}" for i, c in enumerate(keep)}
    url = pages[url_col]
    host, path = host_and_path(url)
    ruled = pages.select(*[F.col(c).alias(k) for c, k in own.items()], url.alias("_url"), host.alias("host"), path.alias("path"))
    rule, verdict = rule_columns(rules, F.col("host"), F.col("path"))
    ruled = ruled.withColumn("rule", rule).withColumn("_verdict", verdict)
    half = F.when(F.conv(F.substring(F.md5("_url"), 1, 1), 16, 10).cast("int") < 8, "0").otherwise("1")
    urls = stage(
        ruled.where(F.length("_url") > 0)
        .select(F.col("_url").alias("url"), F.col("_verdict").alias("verdict"), half.alias("half"))
        .groupBy("url", "verdict", "half").agg(F.count(F.lit(1)).alias("copies"))
    )
    size = urls.agg(F.coalesce(F.sum(F.octet_length("url")), F.lit(0))).first()[0]
    urls = urls.repartition(size // PART_BYTES + 1, "url")
    ratios = stage(_ratios(_counts(_grams(urls))))
    held = F.when(F.col("half") == "0", F.col("s1")).otherwise(F.col("s0"))
    scored = _grams(urls).select("url", "verdict", "half", "copies", "full").join(ratios, "full")
    scores = stage(
        scored.groupBy("url", "verdict", "copies").agg(
            F.floor(F.sum("s") / F.count(F.lit(1))).alias("score"),
            F.floor(F.sum(held) / F.count(F.lit(1))).alias("held_out"),
        )
    )
    limit = threshold(scores)
    out = ruled.join(scores.select(F.col("url").alias("_url"), "score"), "_url", "left")
    scored = F.lit("allow") if limit is None else F.when(F.col("score") < limit, "block").otherwise("allow")
    verdict = F.coalesce("_verdict", scored).alias("verdict")
    return out.select(*[F.col(k).alias(c) for c, k in own.items()], "host", "path", "rule", verdict, "score")
