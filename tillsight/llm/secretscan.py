"""Secrets in texts: fixed patterns, and a battery of randomness tests for all other tokens.

Patterns give the base spans. The battery looks at every token of ``TOKEN`` characters, infers
the narrowest encoding whose alphabet holds it, and tests on its symbols (below). A ``=`` belongs
to a token only as padding at its end, so the value of ``NAME=value`` is a token of its own. A
token that no alphabet holds, mixing ``+/`` with ``-_``, is tested in parts: its longest runs
without the one pair and those without the other; random parts that overlap are one span. The
tests are

* uniformity over the alphabet (chi-squared),
* runs below and above the middle of the alphabet (Wald-Wolfowitz),
* correlation of neighbouring symbols.

A token that fails any of them (Bonferroni, ``RANDOM``) is not random. The others are tested
against ordinary text of the same length, in which two symbols agree with probability
``AGREE``: the more even the symbols are for that length, the smaller p. The rate of false
discoveries is held at ``RATE`` (Benjamini-Hochberg) apart for each encoding and length class,
from counts of p in tenths of a decade, so nothing is ranked in one task.

All of it is DataFrame functions. Places are found from the pieces between matches: each match
is a row, and running sums of lengths within a text give its start in code points.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillsight.llm.common import LOWER, UPPER, quoted, row_key, stored

DIGITS = "0123456789"
#: kind, pattern, group that is measured, its least length; in this order at equal starts
KINDS = [
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]{16,}", 0, 16),  # the runs of [0-9a-f]+ that are long enough
]
TOKEN = 20
#: an equals sign with more of a token after it joins a name to its value
TOKENS = f"[A-Za-z0-9+/_-]{{{TOKEN},}}(?:=+(?![A-Za-z0-9+/_=-]))?"
#: parts of tokens that mix the signs of both base64 alphabets
MIXED = "[+/].*[_-]|[_-].*[+/]"
PARTS = [(f"[A-Za-z0-9{signs}]{{{TOKEN},}}=*", 0, TOKEN) for signs in ("+/", "_-")]
#: encoding, alphabet in the order of its values, probability that two symbols of ordinary
#: text written in it agree; a token has the first that holds all its characters
ENCODINGS = [
    ("hex", DIGITS + LOWER[:6], 0.15),
    ("hexup", DIGITS + UPPER[:6], 0.15),
    ("lower", LOWER, 0.07),
    ("upper", UPPER, 0.07),
    ("base32", UPPER + "234567", 0.07),
    ("base36", DIGITS + LOWER, 0.07),
    ("base36up", DIGITS + UPPER, 0.07),
    ("base62", UPPER + LOWER + DIGITS, 0.06),
    ("base64", UPPER + LOWER + DIGITS + "+/", 0.06),
    ("base64url", UPPER + LOWER + DIGITS + "-_", 0.06),
]
RANDOM, RATE = 0.001, 0.01
#: p is counted in tenths of a decade, up to this many
BINS = 300


def _matches(text: Column, order: int, pattern: str, group: int, least: int) -> Column:
    """Array of the matches: (kind, pos, gap, size, good, token), gap being the length of the
    text before the match, up to the match before it."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    rows = F.transform(
        found,
        lambda m, i: F.struct(
            F.lit(order).alias("kind"),
            i.alias("pos"),
            F.length(F.element_at(gaps, i + 1)).cast("bigint").alias("gap"),
            F.length(m).cast("bigint").alias("size"),
            (F.length(F.regexp_extract(m, pattern, group)) >= least).alias("good"),
            m.alias("token"),
        ),
    )
    return F.when(text.rlike(pattern), rows).otherwise(F.filter(rows, lambda _: F.lit(False)))


def places(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(key, kind, start, end, good, token) of every match; kind counts through ``KINDS``, then
    the tokens. The key is that of id and text, so repeated rows share their places."""
    text = F.coalesce(quoted(text_col), F.lit(""))
    rows = docs.select(row_key(quoted(id_col), quoted(text_col)).alias("key"), text.alias("text"))
    return _located(rows, [(p, g, n) for _, p, g, n in KINDS] + [(TOKENS, 0, TOKEN)])


def _located(rows: DataFrame, plan: list[tuple[str, int, int]]) -> DataFrame:
    """``places`` of (key, text) for the patterns of ``plan``."""
    found = F.concat(*[_matches(F.col("text"), k, *x) for k, x in enumerate(plan)])
    found = rows.select("key", F.explode(found).alias("m")).select("key", "m.*").dropDuplicates(["key", "kind", "pos"])
    upto = F.sum(F.col("gap") + F.col("size")).over(Window.partitionBy("key", "kind").orderBy("pos"))
    return found.select("key", "kind", (upto - F.col("size")).alias("start"), upto.alias("end"), "good", "token")


def parted(tokens: DataFrame) -> DataFrame:
    """``tokens`` (of ``places``), those that mix ``+/`` with ``-_`` replaced by their parts."""
    mixed = F.col("token").rlike(MIXED)
    rows = tokens.where(mixed).select(F.struct("key", "kind", "start").alias("key"), F.col("token").alias("text"))
    at = F.col("key.start")
    parts = _located(rows, PARTS).select("key.key", "key.kind", (at + F.col("start")).alias("start"), (at + F.col("end")).alias("end"), "good", "token")
    return tokens.where(~mixed).unionByName(parts)


def joined(tokens: DataFrame) -> DataFrame:
    """(key, kind, start, end) of ``tokens`` of one kind, those that overlap as one."""
    order = Window.partitionBy("key").orderBy("start", "end")
    upto = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    rows = tokens.withColumn("apart", F.when(upto > F.col("start"), 0).otherwise(1))
    rows = rows.withColumn("group", F.sum("apart").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy("key", "kind", "group").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("group")


def tail(z: Column) -> Column:
    """Probability that a standard normal number exceeds z (rational Chebyshev fit of the
    complementary error function, relative error below 2e-7)."""
    x = F.abs(z) / math.sqrt(2)
    t = 1 / (1 + 0.5 * x)
    # fixed values: coefficients of the fit, lowest power first
    fit = [-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277]
    sum_ = F.lit(fit[-1])
    for c in reversed(fit[:-1]):
        sum_ = sum_ * t + c
    half = t * F.exp(-x * x + sum_) / 2
    return F.when(z >= 0, half).otherwise(1 - half)


def battery(tokens: DataFrame) -> DataFrame:
    """Adds encoding, n (symbols), p_uniform, p_runs, p_serial, p_random and p_text to rows
    with ``token``; tokens without an encoding (``parted`` leaves none) or of digits alone go."""
    body = F.regexp_replace("token", "=+$", "")
    name, alphabet, agree, half = (F.lit(None) for _ in range(4))
    for label, letters, rate in reversed(ENCODINGS):
        here = F.col("body").rlike("^[" + letters.replace("-", r"\-") + "]+$")
        name = F.when(here, F.lit(label)).otherwise(name)
        alphabet = F.when(here, F.lit(letters)).otherwise(alphabet)
        agree = F.when(here, F.lit(rate)).otherwise(agree)
        half = F.when(here, F.lit("0" * (len(letters) // 2) + "1" * (len(letters) - len(letters) // 2))).otherwise(half)
    rows = tokens.withColumn("body", body).where(F.length("body") >= TOKEN).where(~F.col("body").rlike("^[0-9]+$"))
    rows = rows.withColumns({"encoding": name.cast("string"), "alphabet": alphabet.cast("string"), "agree": agree.cast("double"), "half": half.cast("string")})
    rows = rows.where("encoding is not null").withColumn("chars", F.split("body", ""))
    bits = F.expr("translate(body, alphabet, half)")
    rows = rows.withColumns({"n": F.length("body").cast("double"), "k": F.length("alphabet").cast("double"), "bits": bits})
    counts = F.transform(F.array_distinct("chars"), lambda c: F.length("body") - F.length(F.replace(F.col("body"), c, F.lit(""))))
    squares = F.aggregate(counts, F.lit(0.0), lambda a, c: a + c.cast("double") * c)
    values = F.expr("transform(chars, c -> cast(locate(c, alphabet) as double))")
    rows = rows.withColumns({"chi": F.col("k") / F.col("n") * squares - F.col("n"), "values": values})
    rows = rows.withColumn("mean", F.aggregate("values", F.lit(0.0), lambda a, v: a + v) / F.col("n"))
    spread = F.aggregate("values", F.lit(0.0), lambda a, v: a + (v - F.col("mean")) * (v - F.col("mean")))
    later = F.slice(F.col("values"), F.lit(2), F.size("values"))
    products = F.zip_with("values", later, lambda v, w: (v - F.col("mean")) * (F.coalesce(w, F.col("mean")) - F.col("mean")))
    rows = rows.withColumns({"spread": spread, "lag": F.aggregate(products, F.lit(0.0), lambda a, v: a + v)})
    n, k = F.col("n"), F.col("k")
    ones = n - F.length(F.replace("bits", F.lit("1"), F.lit("")))
    turns = sum((n - F.length(F.replace("bits", F.lit(x), F.lit("")))) / 2 for x in ("01", "10"))
    rows = rows.withColumns({"ones": ones, "runs": 1 + turns})
    both = 2 * F.col("ones") * (n - F.col("ones"))
    mean_runs, var_runs = both / n + 1, both * (both - n) / (n * n * (n - 1))
    z_runs = F.when(var_runs > 0, (F.col("runs") - mean_runs) / F.sqrt(var_runs)).otherwise(F.lit(40.0))
    z_serial = F.when(F.col("spread") > 0, (F.col("lag") / F.col("spread") + 1 / n) * F.sqrt(n)).otherwise(F.lit(40.0))
    free = k - 1
    z_uniform = (F.cbrt(F.greatest(F.col("chi"), F.lit(0.0)) / free) - (1 - 2 / (9 * free))) / F.sqrt(2 / (9 * free))
    rows = rows.withColumns({"p_uniform": tail(z_uniform), "p_runs": 2 * tail(F.abs(z_runs)), "p_serial": 2 * tail(F.abs(z_serial))})
    excess = k * F.col("agree") - 1
    z_text = (F.col("chi") - free - n * excess) / F.sqrt(2 * free + 4 * n * excess)
    return rows.withColumns({"p_random": 3 * F.least("p_uniform", "p_runs", "p_serial"), "p_text": tail(-z_text)})


def random_tokens(tokens: DataFrame, rate: float = RATE) -> DataFrame:
    """The rows of ``tokens`` that hold random data, by the battery and false-discovery control."""
    bin_ = F.least(F.lit(BINS), F.floor(-10 * F.log10(F.greatest("p_text", F.lit(1e-300))))).cast("int")
    rows = battery(tokens).withColumns({"bin": bin_, "span_class": F.floor(F.log2("n")).cast("int")})
    rows = stored(rows.select(*tokens.columns, "encoding", "span_class", "bin", (F.col("p_random") >= RANDOM).alias("random")), "battery")
    stratum = ["encoding", "span_class"]
    # a few hundred counts for each of a few dozen strata
    counts = rows.groupBy(*stratum, "bin").agg(F.count("*").alias("c"))
    upto = F.sum("c").over(Window.partitionBy(stratum).orderBy(F.desc("bin")))
    total = F.sum("c").over(Window.partitionBy(stratum))
    limits = counts.withColumns({"upto": upto, "total": total}).where(F.pow(F.lit(10.0), -F.col("bin") / 10) <= rate * F.col("upto") / F.col("total"))
    limits = limits.groupBy(stratum).agg(F.min("bin").alias("least"))
    return rows.join(F.broadcast(limits), stratum).where("random and bin >= least").select(tokens.columns)


def secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: float = RATE) -> DataFrame:
    """One row per row of ``docs``: (``id_col``, n_assign, n_access, n_hex, n_random,
    base_sha256, spans, random_spans).

    Spans are those of whole matches, in code points, end exclusive. Random tokens that overlap
    no base span are spans of kind ``random``. ``base_sha256`` is over ``kind:start:end`` of the
    base spans by start, then kind, joined by commas; ``spans`` is the text of all. Null and
    empty texts have none. Rows that repeat an id and a text get the same values each. An empty
    table gives an empty result; further columns are left out.
    """
    names = [name for name, *_ in KINDS] + ["random"]
    found = stored(places(docs, id_col, text_col), "places")
    base = found.where((F.col("kind") < len(KINDS)) & F.col("good")).select("key", "kind", "start", "end")
    extra = joined(random_tokens(parted(found.where(F.col("kind") == len(KINDS))).drop("good"), rate))
    rows = base.unionByName(extra).withColumn("base", F.col("kind") < len(KINDS))
    order = Window.partitionBy("key").orderBy("start", "kind")
    earlier = F.max(F.when(F.col("base"), F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    later = F.min(F.when(F.col("base"), F.col("start"))).over(order.rowsBetween(1, Window.unboundedFollowing))
    rows = rows.withColumn("apart", (F.coalesce(earlier, F.lit(0)) <= F.col("start")) & (F.coalesce(later, F.col("end")) >= F.col("end")))
    rows = rows.where("base or apart")
    label = F.concat_ws(":", F.element_at(F.array(*[F.lit(x) for x in names]), F.col("kind") + 1), "start", "end")
    rows = rows.select("key", "kind", F.struct("start", "kind", label.alias("label")).alias("span"))
    counts = [F.count(F.when(F.col("kind") == i, 1)).alias(f"n_{x}") for i, x in enumerate(names)]
    sums = rows.groupBy("key").agg(*counts, F.array_sort(F.collect_list("span")).alias("all"))
    texts = lambda a: F.array_join(F.transform(a, lambda s: s["label"]), ",")
    some = lambda test: texts(F.filter("all", test))
    sums = sums.select(
        "key",
        *[f"n_{x}" for x in names],
        F.sha2(some(lambda s: s["kind"] < len(KINDS)), 256).alias("base_sha256"),
        texts(F.col("all")).alias("spans"),
        some(lambda s: s["kind"] == len(KINDS)).alias("random_spans"),
    )
    ids = docs.select(quoted(id_col).alias(id_col), row_key(quoted(id_col), quoted(text_col)).alias("key"))
    none = {f"n_{x}": F.lit(0).cast("bigint") for x in names} | {"base_sha256": F.sha2(F.lit(""), 256), "spans": F.lit(""), "random_spans": F.lit("")}
    return ids.join(sums, "key", "left").select(id_col, *[F.coalesce(c, v).alias(c) for c, v in none.items()])
