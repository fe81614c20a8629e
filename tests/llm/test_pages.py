"""URL filter and archive against plain Python."""

from __future__ import annotations

import hashlib
import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tillsight.llm import urlfilter, warc
from tillsight.llm.queries import QUERIES

URLS = [
    None, "", "no scheme", "http://", "http://x.org", "http://x.org/", "HTTP://WWW.Example.ORG/es/1?a=b", "http://example.org/en/12#t",
    "http://notexample.org/es/1", "ftp://a.com/fr/x://y/de/", "http://a.com/de/é?q", "http://a.com?x=/fr/", "http://a.net/en/5", "http://org/z",
    "http://a.net/en/5", "http://b\nc.org/\nq", "http://é.net/" + "seg/" * 3000,
]
LONG = "<p>" + "x" * 120 + "</p>"


def pages(spark, rows=None):
    base = [(i, u, LONG if i % 3 else "<b>") for i, u in enumerate(URLS)]
    base += [(50, "http://a.net/1", "é" * 50), (51, None, "é" * 50), (None, None, None), (52, "u", None), (53, "u", ""), (None, "v", "y" * 200), (None, "v", "y" * 200)]
    base += [(60, "u", LONG * 2), (60, "u", LONG * 2), (61, "u", LONG * 2), (70, "u", "z" * 99), (71, "u", "z" * 99), (72, "u", "w" * 300000)]
    df = spark.createDataFrame(base if rows is None else rows, "page_id bigint, url string, html string")
    return df.withColumns({c: F.lit("x") for c in ("host", "path", "digest", "rule", "text", "id", "payload", "first_id", "action")})


def test_rules(spark):
    got = {r["page_id"]: r for r in urlfilter.judged(pages(spark)).where("page_id is not null").collect()}
    for i, u in enumerate(URLS):
        host, path = brute.split_url(u)
        name = brute.rule(host, path)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, name), u
        assert got[i]["verdict"] == brute.RULES[name] if name else got[i]["verdict"] in ("allow", "block")
        assert (got[i]["score"] is None) == (name is not None)


def test_rules_on_table(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/pages.parquet")
    urls = {r["page_id"]: r["url"] for r in table.collect()}
    got = QUERIES["op7_url_filter"](spark, sf_dir).collect()
    assert len(got) == len(urls)
    for r in got:
        host, path = brute.split_url(urls[r["page_id"]])
        name = brute.rule(host, path)
        assert (r["host"], r["path"], r["rule"]) == (host, path, name)
        assert name is None or r["verdict"] == brute.RULES[name]


def test_no_pages_and_no_labels(spark):
    assert urlfilter.judged(pages(spark, [])).count() == 0
    got = urlfilter.judged(pages(spark, [(1, "http://a.net/x", None), (2, None, None)])).collect()
    assert [r["verdict"] for r in got] == ["allow", "allow"]


def plain_ratio(text: str, counts: dict, order: int) -> float:
    plain = urlfilter.PAD * order + "".join("0" if c in "123456789" else c for c in text) + urlfilter.END
    total = 0.0
    for i in range(order, len(plain)):
        logs = []
        for c in ("allow", "block"):
            p = urlfilter.LEAST
            for k in range(order + 1):
                context, n, t, own = plain[i - k : i], 0, set(), 0
                for g, m in counts[c].items():
                    if g[order - k : order] == context:
                        n += m
                        t.add(g[order])
                        own += m * (g[order] == plain[i])
                if n:
                    p = (own + len(t) * p) / (n + len(t))
            logs.append(math.log(p))
        total += logs[0] - logs[1]
    return total / (len(plain) - order)


def test_model_by_hand(spark):
    """Scores equal those of the same model in plain Python."""
    allow, block = ["aa.org/x1", "aab/y", "abc/news"], ["zz.com/casino", "zzz/win99", "bet/zz"]
    probe = ["aab/new", "zz/casino5", "qqq", ""]
    order = urlfilter.ORDER
    counts = {}
    for c, texts in (("allow", allow), ("block", block)):
        counts[c] = Counter()
        for t in texts:
            p = urlfilter.PAD * order + "".join("0" if x in "123456789" else x for x in t) + urlfilter.END
            counts[c].update(p[i : i + order + 1] for i in range(len(p) - order))
    rows = [(g, counts["allow"][g], counts["block"][g]) for g in {*counts["allow"], *counts["block"]}]
    table = spark.createDataFrame(rows, "gram string, allow bigint, block bigint")
    parts = spark.createDataFrame([(t,) for t in probe], "text string").select("text", F.explode(urlfilter.grams(F.col("text"))).alias("gram"))
    ratio = urlfilter.ratios(parts.select("gram").distinct(), table)
    got = {r["text"]: r["s"] for r in parts.join(ratio, "gram").groupBy("text").agg(F.avg("ratio").alias("s")).collect()}
    for t in probe:
        assert got[t] == pytest.approx(plain_ratio(t, counts, order), abs=1e-9), t


def test_limit(spark):
    scores = spark.createDataFrame([(0.9, "allow", 5), (0.5, "allow", 4), (0.41, "block", 1), (-0.3, "block", 7)], "score double, action string, n bigint")
    assert 0.41 < urlfilter.limit_of(scores) <= 0.5
    assert urlfilter.limit_of(scores.where("action = 'allow'")) == 0.0


def test_model_tells_apart(spark):
    """Unlabelled hosts are judged by the labelled ones they resemble."""
    rows = [(i, f"http://news{i}.org/story/{i}", None) for i in range(60)] + [(100 + i, f"http://casino{i}.com/de/win/{i}", None) for i in range(60)]
    rows += [(300 + i, f"http://{'news' if i % 2 else 'casino'}{i}x.net/{'story' if i % 2 else 'win'}/{i}", None) for i in range(40)]
    got = urlfilter.judged(pages(spark, rows)).where("page_id >= 300").collect()
    right = sum((r["verdict"] == "allow") == (r["page_id"] % 2 == 1) for r in got)
    assert right >= 38


def test_model_reads_the_whole_url(spark):
    """Unlabelled URLs that differ only after '?' or '#', or have no scheme, are told apart."""
    rows = [(i, f"http://n{i}.org/p?topic=story{i}", None) for i in range(60)] + [(100 + i, f"http://n{i}.com/de/p?topic=casino{i}", None) for i in range(60)]
    ends = ["?topic=story", "?topic=casino", "#topic=story", "#topic=casino"]
    rows += [(300 + i, "http://a.net/p" + x, None) for i, x in enumerate(ends)] + [(310 + i, "p" + x, None) for i, x in enumerate(ends)]
    got = {r["page_id"]: r for r in urlfilter.judged(pages(spark, rows)).where("page_id >= 300").collect()}
    for i in got:
        assert got[i]["rule"] is None and got[i]["verdict"] == ("block" if i % 2 else "allow"), rows[i - 180]
    assert {(got[i]["host"], got[i]["path"]) for i in range(300, 304)} == {("a.net", "/p")}
    assert {(got[i]["host"], got[i]["path"]) for i in range(310, 314)} == {("", "")}


def test_text_of(spark):
    urls = [(u,) for u in [*URLS, "HTTP://A.NET/Q?B=C#D", "NoScheme", "x://É.Org?A"]]
    for url, text in spark.createDataFrame(urls, "url string").select("url", urlfilter.text_of(F.col("url"))).collect():
        front = url[: url.index("://") + 3 + len(brute.split_url(url)[0])] if url and "://" in url else ""
        assert text == brute.lower_az(front) + (url or "")[len(front) :]


@pytest.mark.parametrize("kind", ["edge", "table", "empty"])
def test_archive(spark, sf_dir, tmp_path, kind):
    df = spark.read.parquet(f"{sf_dir}/pages.parquet") if kind == "table" else pages(spark, [] if kind == "empty" else None)
    rows = [tuple(r) for r in df.select("page_id", "html").collect()]
    warc.write_archive(df, f"{tmp_path}/a")
    archive = warc.read_archive(spark, f"{tmp_path}/a")
    got = warc.index(archive)
    assert Counter(map(tuple, got.collect())) == Counter(brute.archive(rows))
    assert archive.payloads.count() == len({h or "" for _, h in rows})
    urls = defaultdict(Counter)
    for r in df.select("page_id", "url", "html").collect():
        urls[r[0]][(r[1], (r[2] or "").encode())] += 1
    back = defaultdict(Counter)
    for r in warc.reconstructed(archive).collect():
        head, body = bytes(r["record"]).split(b"\r\n\r\n", 1)
        lines = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
        assert head.decode() + "\r\n\r\n" == r["headers"] and body.endswith(b"\r\n\r\n")
        revisit = lines["WARC-Type"] == "revisit"
        assert body[:-4] == (b"" if revisit else bytes(r["payload"])) and int(lines["Content-Length"]) == len(body) - 4
        assert lines["WARC-Payload-Digest"] == "sha256:" + hashlib.sha256(bytes(r["payload"])).hexdigest()
        assert revisit == ("WARC-Refers-To" in lines)
        url = lines.get("WARC-Target-URI")
        back[r["page_id"]][(url and url.replace("%0A", "\n"), bytes(r["payload"]))] += 1
    assert back == urls


def test_damage_is_noticed(spark, tmp_path):
    warc.write_archive(pages(spark), f"{tmp_path}/a")
    archive = warc.read_archive(spark, f"{tmp_path}/a")
    bad = archive._replace(payloads=archive.payloads.withColumn("payload", F.concat("payload", F.lit(b"!"))))
    with pytest.raises(Exception, match="damaged payload"):
        warc.index(bad).collect()


@pytest.mark.parametrize("damage", ["type", "digest", "length", "line", "payload"])
def test_damaged_headers(spark, tmp_path, damage):
    """A header block that is not whole, or does not fit the payload, fails the query."""
    warc.write_archive(pages(spark), f"{tmp_path}/a")
    archive = warc.read_archive(spark, f"{tmp_path}/a")
    assert archive.records.columns == ["headers"]  # nothing is kept beside the header blocks
    old, new = {
        "type": ("WARC-Type: response", "WARC-Type: revisit"),
        "digest": ("sha256:[0-9a-f]", "sha256:x"),
        "length": ("Content-Length: ", "Content-Length: 9"),
        "line": ("WARC-Date: ", "WARC-Day: "),
        "payload": ("", ""),
    }[damage]
    if damage == "payload":
        bad = archive._replace(payloads=archive.payloads.limit(1))
    else:
        bad = archive._replace(records=archive.records.withColumn("headers", F.regexp_replace("headers", old, new)))
    for read in (warc.index, warc.reconstructed):
        with pytest.raises(Exception, match="damaged headers|without its payload"):
            read(bad).collect()
    assert warc.index(archive).count() == warc.reconstructed(archive).count() == pages(spark).count()
