"""WARC as a content-addressed archive.

Two tables make up an archive: ``payloads`` holds every payload's bytes once under its SHA-256,
``headers`` every record's exact header block and the digest of its payload. Whole records, revisits
included, come back by joining the two; digests and lengths are verified on the way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Payloads shorter than this are never turned into revisits.
LEAST = 100
CRLF = "\r\n"
STAMP = "2024-01-01T00:00:00Z"


def _identity(id: Column) -> Column:
    """A record id from the row's id; any row id makes a valid one."""
    return F.concat(F.lit("<urn:page:"), F.coalesce(id.cast("string"), F.lit("null")), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))


def write_archive(
    pages: DataFrame, path: str, id: str = "page_id", url: str = "url", html: str = "html", least: int = LEAST
) -> None:
    """Write one record per row of ``pages`` under ``path``.

    Of records with equal payloads of ``least`` bytes or more, the one with the smallest id is a
    response and the others are revisits that refer to it; rows that share this id are all
    responses, null ids come after all others, and if all are null all are responses. A null
    payload is empty, a null url an empty target; line ends in urls are percent-encoded. Rows may
    repeat, each is a record; an empty table makes an empty archive.

    Payloads are hashed before anything moves; groups of copies are reduced on the map side, and the
    join that tells a record its response carries no payload.
    """
    spark = pages.sparkSession
    payload = F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8")
    rows = pages.select(F.col(id).alias("id"), F.col(url).alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    blobs = rows.groupBy("digest").agg(F.first("payload").alias("payload"), F.min("id").alias("first_id"))
    blobs = blobs.withColumn("length", F.octet_length("payload").cast("long"))
    # Ordered within each file by digest, so that a reader finds one by the files' statistics.
    blobs.sortWithinPartitions("digest").write.option("compression", "zstd").parquet(f"{path}/payloads")
    stored = spark.read.parquet(f"{path}/payloads").select("digest", "length", "first_id")
    named = rows.select("id", "url", "digest").join(stored, "digest")
    revisit = (F.col("length") >= least) & F.col("first_id").isNotNull() & ~F.col("id").eqNullSafe(F.col("first_id"))
    target = F.replace(F.replace(F.coalesce("url", F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    header = F.concat(
        F.lit("WARC/1.1" + CRLF),
        _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", _identity(F.col("id"))),
        _line("WARC-Date", F.lit(STAMP)),
        _line("WARC-Target-URI", target),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(
            revisit,
            F.concat(
                _line("WARC-Refers-To", _identity(F.col("first_id"))),
                _line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
            ),
        ).otherwise(""),
        _line("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("length").cast("string"))),
        F.lit(CRLF),
    )
    named.select("id", "digest", F.encode(header, "UTF-8").alias("header")).write.option(
        "compression", "zstd"
    ).parquet(f"{path}/headers")


def _field(header: Column, name: str) -> Column:
    value = F.regexp_extract(header, rf"(?m)^{name}: ([^\r\n]*)\r?$", 1)
    return F.when(value != "", value)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """(id, record, payload, payload_digest, payload_bytes, record_type, refers_to, url), one row per
    record: ``record`` is the exact WARC record, ``payload`` the whole payload also of a revisit.

    A payload that is missing, or that no longer has the digest or length it is filed under, is an
    error, raised by the task that reads it. Columns that the caller doesn't select cost nothing but
    the verification, which reads every stored payload once, before the join.
    """
    headers = spark.read.parquet(f"{path}/headers")
    stored = spark.read.parquet(f"{path}/payloads")
    sound = (F.sha2("payload", 256) == F.col("digest")) & (F.octet_length("payload") == F.col("length"))
    checked = stored.select(
        F.when(sound, F.col("digest")).otherwise(F.raise_error(F.concat(F.lit("damaged payload "), "digest"))).alias("found"),
        "payload",
        F.col("length").alias("payload_bytes"),
    )
    joined = headers.join(checked, F.col("digest") == F.col("found"), "left")
    text = F.decode("header", "UTF-8")
    joined = joined.withColumns({
        "record_type": _field(text, "WARC-Type"),
        "stated": _field(text, "WARC-Payload-Digest"),
        "refers": _field(text, "WARC-Refers-To"),
        "url": _field(text, "WARC-Target-URI"),
    })
    whole = F.col("found").isNotNull() & (F.col("stated") == F.concat(F.lit("sha256:"), "found"))
    body = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
    end = F.encode(F.lit(CRLF + CRLF), "UTF-8")
    return joined.select(
        "id",
        F.concat("header", body, end).alias("record"),
        "payload",
        F.when(whole, F.col("found")).otherwise(F.raise_error(F.concat(F.lit("lost payload "), "digest"))).alias("payload_digest"),
        "payload_bytes",
        "record_type",
        F.regexp_extract("refers", "^<urn:page:(.*)>$", 1).alias("refers_to"),
        "url",
    )
