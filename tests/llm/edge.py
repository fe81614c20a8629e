"""Small tables with nulls, empty and long texts, ties, repeated rows and clashing columns."""

from __future__ import annotations

import random

ALPHA = ["the", "Cat", "sat", "ON", "a", "Mat", "été", "ÄPFEL", "über", "x1", "don't", "end.", "42", "naïve"]


def words(n: int, seed: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(ALPHA) + (str(r.randrange(50)) if r.random() < 0.5 else "") for _ in range(n))


def documents() -> list[tuple]:
    base = words(300, 1)
    near = base.split(" ")
    near[100] = "changed"
    rows = [
        (1, base, "en", "s1", 1),
        (2, base.swapcase(), "en", "s1", 1),
        (3, " ".join(near), "en", "s1", 1),
        (4, None, None, None, None),
        (5, "", "fr", "s2", 0),
        (6, " \t\n", "fr", "s2", 3),
        (7, "one", "fr", "s2", 3),
        (8, "One", "fr", None, 3),
        (9, "two words", "de", "s3", 9),
        (10, words(30000, 2), "de", "hot", 9),
        (10, words(30000, 2), "de", "hot", 9),
        (11, words(50, 3), "en", "hot", 0),
        (None, words(60, 4), "en", "hot", 0),
        (None, words(60, 4), "en", "hot", 0),
        (None, None, None, None, None),
        (12, words(40, 5), "en", "hot", 0),
        (12, words(41, 6), "en", "hot", 0),
        (13, " wide space\x85here \x00nul \U0001f600 emoji", "en", "é", 0),
    ]
    rows += [(100 + i, words(80, 7), "en", "hot", 0) for i in range(40)]
    rows += [(200 + i, words(20 + i, 50 + i), "es", f"s{i % 7}", 0) for i in range(60)]
    return rows


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: names that the operators use for columns of their own
CLASHING = ["key", "row", "fp", "size", "text_sha256", "kept", "component_id", "src", "taken", "a.b", "n", "id"]


def frame(spark, rows=None, clash: bool = True):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(documents() if rows is None else rows, SCHEMA)
    if not clash:
        return df
    df = df.withColumns({f"{c}": F.lit("x") for c in CLASHING if "." not in c}).withColumn("a.b", F.lit(1))
    # types that have no order
    return df.withColumn("a map", F.create_map(F.lit("k"), F.col("doc_id"))).withColumn("a variant", F.parse_json(F.lit('{"x": [1]}')))
