"""A content-addressed web archive.

``payloads`` holds the bytes of each distinct payload once, under its SHA-256; ``records``
holds the exact header block of every record and nothing besides. A record in WARC 1.1 form is
the header block, the payload (none for a revisit) and two line ends, brought together by a
join on the digest that the header block names.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillsight.llm.common import quoted

#: payloads of fewer bytes are repeated rather than referred to
LEAST_BYTES = 100
CRLF = "\r\n"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class Archive(NamedTuple):
    payloads: DataFrame
    records: DataFrame


def digest_of(payload: Column) -> Column:
    return F.sha2(payload, 256)


def record_uri(record_id: Column) -> Column:
    """Record id as a URI; a null id is written as the word null."""
    return F.concat(F.lit("<urn:record:"), F.coalesce(record_id.cast("string"), F.lit("null")), F.lit(">"))


def _field(name: str, value: Column) -> Column:
    """A header line, or nothing if the value is null. Line ends within the value, which would
    end the line, are written as %0D and %0A."""
    value = F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit(""))


def headers(record_type: Column, record_id: Column, url: Column, digest: Column, length: Column, refers_to: Column, date: Column) -> Column:
    """Header block of a record, with the empty line that ends it."""
    return F.concat(
        F.lit("WARC/1.1" + CRLF),
        _field("WARC-Type", record_type),
        _field("WARC-Record-ID", record_uri(record_id)),
        _field("WARC-Date", date),
        _field("WARC-Target-URI", url),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), digest)),
        _field("WARC-Profile", F.when(record_type == "revisit", F.lit(REVISIT))),
        _field("WARC-Refers-To", F.when(record_type == "revisit", record_uri(refers_to))),
        _field("Content-Length", F.when(record_type == "revisit", F.lit(0)).otherwise(length).cast("string")),
        F.lit(CRLF),
    )


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", date: str = "1970-01-01T00:00:00Z") -> None:
    """Write a record per row of ``pages`` to a new archive at ``path``.

    The payload is the text in UTF-8, null as empty. Of records with equal payloads of at
    least ``LEAST_BYTES`` bytes the one with the smallest id is a response and the others
    revisit it; rows that repeat the smallest id are responses too. A null id is the
    smallest only where all ids are null. Payloads are combined by digest and whole content,
    within each task before they are moved. Further columns are not archived.
    """
    payload = F.coalesce(quoted(payload_col), F.lit("")).cast("binary")
    rows = pages.select(quoted(id_col).alias("id"), quoted(url_col).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", digest_of(F.col("payload")))
    once = rows.groupBy("digest", "payload").agg(F.min("id").alias("first_id"))
    once.select("digest", "payload", F.octet_length("payload").cast("bigint").alias("payload_bytes"), "first_id").write.parquet(f"{path}/payloads")
    firsts = pages.sparkSession.read.parquet(f"{path}/payloads").select("digest", "payload_bytes", "first_id")
    long = F.col("payload_bytes") >= LEAST_BYTES
    revisit = long & ~F.col("id").eqNullSafe(F.col("first_id"))
    records = rows.select("id", "url", "digest").join(firsts, "digest")
    records = records.withColumn("record_type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")))
    records = records.withColumn("refers_to", F.when(revisit, F.col("first_id")))
    head = headers(*[F.col(c) for c in ("record_type", "id", "url", "digest", "payload_bytes", "refers_to")], F.lit(date))
    records.select(head.alias("headers")).write.parquet(f"{path}/records")


def read_archive(spark: SparkSession, path: str) -> Archive:
    return Archive(spark.read.parquet(f"{path}/payloads"), spark.read.parquet(f"{path}/records"))


def verified(payloads: DataFrame) -> DataFrame:
    """(digest, payload_bytes, payload), the first two taken anew from the stored bytes. A
    payload whose bytes do not give the digest it is stored under fails the job."""
    again = digest_of(F.col("payload"))
    intact = F.when(again == F.col("digest"), F.col("digest")).otherwise(
        F.raise_error(F.concat(F.lit("damaged payload "), F.col("digest"))).cast("string")
    )
    return payloads.select(intact.alias("digest"), F.octet_length("payload").cast("bigint").alias("payload_bytes"), "payload")


def parsed(records: DataFrame, id_type: str = "bigint") -> DataFrame:
    """(id, record_type, refers_to, url, digest, length, date, headers) as the header blocks say.
    A block that is not exactly what its own fields give fails the job."""

    def value(name: str) -> Column:
        line = F.regexp_substr("headers", F.lit(f"\r\n{name}: [^\r\n]*\r\n"))
        return F.substring(line, F.lit(len(name) + 5), F.length(line) - len(name) - 6)

    def of_uri(uri: Column) -> Column:
        text = F.regexp_extract(uri, "^<urn:record:(.*)>$", 1)
        return F.when(text != "null", text).try_cast(id_type)

    rows = records.select(
        of_uri(value("WARC-Record-ID")).alias("id"),
        value("WARC-Type").alias("record_type"),
        of_uri(value("WARC-Refers-To")).alias("refers_to"),
        value("WARC-Target-URI").alias("url"),
        F.regexp_replace(value("WARC-Payload-Digest"), "^sha256:", "").alias("digest"),
        value("Content-Length").try_cast("bigint").alias("length"),
        value("WARC-Date").alias("date"),
        "headers",
    )
    again = headers(*[F.col(c) for c in ("record_type", "id", "url", "digest", "length", "refers_to")], F.col("date"))
    intact = F.col("record_type").isin("response", "revisit") & (again == F.col("headers"))
    fails = F.raise_error(F.concat(F.lit("damaged headers "), F.substring("headers", 1, 200))).cast("string")
    return rows.withColumn("digest", F.when(F.coalesce(intact, F.lit(False)), F.col("digest")).otherwise(fails))


def _joined(archive: Archive, id_type: str) -> DataFrame:
    """Records with their payloads. A record whose payload is missing, or not as long as it says,
    fails the job."""
    rows = parsed(archive.records, id_type).join(verified(archive.payloads), "digest", "left")
    said = F.when(F.col("record_type") == "revisit", F.col("length") == 0).otherwise(F.col("length") == F.col("payload_bytes"))
    fails = F.raise_error(F.concat(F.lit("record without its payload "), F.col("digest"))).cast("bigint")
    whole = F.when(F.col("payload_bytes").isNotNull() & said, F.col("payload_bytes")).otherwise(fails)
    return rows.withColumn("payload_bytes", whole)


def index(archive: Archive, id_col: str = "page_id", id_type: str = "bigint") -> DataFrame:
    """One row per record: (``id_col``, payload_bytes, payload_digest, record_type, refers_to).
    Id, type and reference are those of the header block that is read back, size and digest
    those of the bytes in store, and both must agree."""
    joined = _joined(archive, id_type)
    return joined.select(F.col("id").alias(id_col), "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", "refers_to")


def reconstructed(archive: Archive, id_col: str = "page_id", id_type: str = "bigint") -> DataFrame:
    """(``id_col``, headers, record, payload): the record's exact bytes, and its full payload,
    which for a revisit is that of the record it refers to."""
    joined = _joined(archive, id_type).where("payload_bytes is not null")
    body = F.when(F.col("record_type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    record = F.concat(F.col("headers").cast("binary"), body, F.lit((CRLF * 2).encode()))
    return joined.select(F.col("id").alias(id_col), "headers", record.alias("record"), "payload")
