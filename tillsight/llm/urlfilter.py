"""URL filter: rules by host and path, and for all other URLs a character language-model ratio.

Rules see host and path, the models the whole URL, query and fragment too. URLs that a rule
allows or blocks are the labelled texts. Two smoothed variable-order Markov
models of characters (Witten-Bell: each order is mixed with the next shorter one by how many
different characters were seen after the context; an unseen context falls back entirely) are
trained on them by counting n-grams. A URL's score is the difference of its log-likelihoods
divided by its length. The limit is set on labelled URLs that the models were not trained on.

All of it is DataFrame functions. Equal URLs are merged before they are cut into n-grams, and
the models are tables of distinct n-grams.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillsight.llm.common import lower_az, quoted, spread, stored

ORDER = 3
#: one URL in so many is kept from training and used to set the limit
HELD = 5
#: share of a character in no model at all
LEAST = 1 / 256
#: scores are counted in steps of this width to set the limit
STEP = 0.02
#: largest table of scored n-grams that is broadcast, in bytes
BROADCAST_BYTES = 32 << 20
PAD, END = "\x02", "\x03"


class Rule(NamedTuple):
    action: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: fixed values: the rules, in the order given
RULES = [
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
]


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    return lower_az(F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def text_of(url: Column) -> Column:
    """The whole URL as the models read it: the part up to the end of the host with A-Z in lower
    case, the rest as it is. Null is empty."""
    url = F.coalesce(url, F.lit(""))
    front = F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*", 0)
    return F.concat(lower_az(front), F.substring(url, F.length(front) + 1, F.length(url)))


def rule_of(host: Column, path: Column, rules: list[Rule] = RULES) -> tuple[Column, Column]:
    """(name, action) of the longest rule that fits, null if none does. Of rules that are
    equally long the one that comes first by name counts."""
    name, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (-len(r.name), r.name), reverse=True):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        name, action = F.when(fits, F.lit(r.name)).otherwise(name), F.when(fits, F.lit(r.action)).otherwise(action)
    return name, action


def grams(text: Column, order: int = ORDER) -> Column:
    """All n-grams of ``order`` + 1 characters, with padding before and an end mark after the
    text. Digits count as one character, so numbers are known by their length."""
    plain = F.translate(text, "123456789", "000000000")
    chars = F.concat(F.array(*[F.lit(PAD)] * order), F.filter(F.split(plain, ""), lambda c: c != ""), F.array(F.lit(END)))
    return F.transform(F.sequence(F.lit(1), F.size(chars) - order), lambda i: F.array_join(F.slice(chars, i, order + 1), ""))


def ratios(wanted: DataFrame, counts: DataFrame, order: int = ORDER) -> DataFrame:
    """(gram, ratio): log of the last character's probability given the ones before it, under
    the allowed less under the blocked model, for every distinct gram of ``wanted``.
    ``counts``: (gram, allow, block) of the labelled URLs."""
    classes = ["allow", "block"]
    rows = wanted
    for c in classes:
        rows = rows.withColumn(f"p_{c}", F.lit(LEAST))
    for k in range(order + 1):
        part = counts.groupBy(F.right("gram", F.lit(k + 1)).alias("part")).agg(*[F.sum(c).alias(c) for c in classes])
        context = F.substring("part", 1, k)
        seen = [F.sum(c).alias(f"n_{c}") for c in classes] + [F.count(F.when(F.col(c) > 0, 1)).alias(f"t_{c}") for c in classes]
        rows = rows.withColumn("part", F.right("gram", F.lit(k + 1))).join(part, "part", "left")
        if k:
            rows = rows.withColumn("context", context).join(part.groupBy(context.alias("context")).agg(*seen), "context", "left").drop("context")
        else:  # the empty context: one row of four sums
            totals = part.agg(*seen).first()
            rows = rows.withColumns({x: F.lit(totals[x] or 0).cast("bigint") for x in totals.asDict()})
        for c in classes:
            n, t, own = (F.coalesce(F.col(x), F.lit(0)) for x in (f"n_{c}", f"t_{c}", c))
            rows = rows.withColumn(f"p_{c}", F.when(n > 0, (own + t * F.col(f"p_{c}")) / (n + t)).otherwise(F.col(f"p_{c}")))
        rows = rows.select("gram", *[f"p_{c}" for c in classes])
    return rows.select("gram", (F.log("p_allow") - F.log("p_block")).alias("ratio"))


def limit_of(scores: DataFrame) -> float:
    """The score at and above which URLs are allowed, where the shares of allowed and blocked
    URLs judged rightly add up to most: halfway between two steps; 0 if either kind is missing.
    ``scores``: (score, action, n), counted in at most a few thousand steps."""
    steps = scores.groupBy(F.floor(F.col("score") / STEP).alias("step")).agg(
        *[F.sum(F.when(F.col("action") == c, F.col("n")).otherwise(0)).alias(c) for c in ("allow", "block")]
    )
    order = Window.orderBy("step")
    every = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = {c: F.nullif(F.sum(c).over(every), F.lit(0)) for c in ("allow", "block")}
    above = F.sum("allow").over(order.rowsBetween(0, Window.unboundedFollowing))
    below = F.coalesce(F.sum("block").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    right = above / total["allow"] + below / total["block"]
    before = F.coalesce(F.lag("step").over(order) + 1, F.col("step"))
    limit = (F.col("step") + before) / 2
    best = steps.select(limit.alias("limit"), right.alias("right")).where("right is not null")
    best = best.orderBy(F.desc("right"), F.abs("limit"), "limit").first()
    return best["limit"] * STEP if best else 0.0


def judged(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: list[Rule] = RULES, order: int = ORDER) -> DataFrame:
    """One row per row of ``pages``: (``id_col``, host, path, rule, verdict, score).

    A URL that is null or has no ``://`` has an empty host and path and no rule. Where no rule
    fits, the verdict is that of the language models on the whole URL (null: empty), and
    ``score`` their length-normalised difference, else null. Without labelled URLs of both kinds nothing can be
    compared: the missing model knows no character, and the limit is 0. Equal URLs are judged
    alike. An empty table gives an empty result; further columns are left out.
    """
    url = quoted(url_col)
    rows = pages.select(quoted(id_col).alias(id_col), host_of(url).alias("host"), path_of(url).alias("path"), text_of(url).alias("text"))
    name, action = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": name, "action": action})
    texts = rows.groupBy("text", "action").agg(F.count("*").alias("n"))
    texts = texts.withColumn("held", F.pmod(F.xxhash64("text"), F.lit(HELD)) == 0)
    texts = stored(spread(texts, "text"), "texts")
    parts = texts.select("text", "action", "n", "held", F.explode(grams(F.col("text"), order)).alias("gram"))
    train = parts.where("action is not null and not held")
    counts = train.groupBy("gram").agg(*[F.sum(F.when(F.col("action") == c, F.col("n")).otherwise(0)).alias(c) for c in ("allow", "block")])
    wanted = parts.where("action is null or held")
    scored = stored(ratios(wanted.select("gram").distinct(), stored(counts, "counts"), order), "ratios")
    size = scored.count() * 64
    joined = wanted.join(F.broadcast(scored) if size <= BROADCAST_BYTES else scored, "gram")
    scores = stored(joined.groupBy("text", "action", "n").agg(F.avg("ratio").alias("score")), "scores")
    limit = limit_of(scores.where("action is not null"))
    found = rows.join(scores.where("action is null").select("text", "score"), "text", "left")
    verdict = F.coalesce("action", F.when(F.col("score") >= limit, F.lit("allow")).otherwise(F.lit("block")))
    return found.select(id_col, "host", "path", "rule", verdict.alias("verdict"), F.when(F.col("action").isNull(), F.col("score")).alias("score"))
