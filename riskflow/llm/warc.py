"""Content-addressed WARC archive.

An archive is two tables. `payloads` keeps the bytes of each distinct payload once, by
their SHA-256 digest. `headers` keeps the exact header block of every record with the
digest of its payload. A record is put together again by a join on the digest. Digests
are checked when they are written (equal SHA-256 must mean equal SHA-1 and length) and
when payloads are read (the stored bytes are hashed again).

Defined results: a NULL payload is an empty one; a NULL key sorts after all others and
gives a record without an id; repeated rows give a record each, of which one at most is
the response; NULL URIs leave the header line out; a URI with a line end is written with
its line ends and percent signs escaped, under a mark, and read back as it was; an empty
table gives an empty archive; other columns of the input are ignored.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.operators.skew import attach_per_key
from riskflow.sources.tables import shared_folder, stored

BASE32_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
ID_PREFIX = "urn:x-record:"
END_OF_LINE = "\r\n"
#: Header field of records whose URI is escaped, and what stands for what in it, in order.
ESCAPED = "X-Target-URI-Escaped"
ESCAPES = (("%", "%25"), ("\r", "%0D"), ("\n", "%0A"))


@dataclass(frozen=True)
class Archive:
    """The two tables of an archive, as read back from `path`."""

    path: str
    headers: DataFrame
    payloads: DataFrame


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1 of bytes: 40 hex digits, five at a time."""
    digits = F.sha1(payload)
    parts = [
        F.lpad(F.conv(F.substring(digits, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)
    ]
    return F.translate(F.concat(*parts), BASE32_DIGITS, BASE32)


def write_archive(
    rows: DataFrame,
    path: str,
    key: str,
    uri: str,
    payload: str,
    min_bytes: int = 0,
    date: str = "1970-01-01T00:00:00Z",
) -> Archive:
    """Write a WARC record per row of `rows` as an archive under `path`, and read it back.

    Among equal payloads of at least `min_bytes` bytes the one with the smallest key is a
    response and the others revisit it. `key` is an integer column, `payload` text or
    bytes. Every pass but the last works on digests; payload bytes are read once more
    to be written, without a shuffle unless there are very many copies to leave out.
    """
    content = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    digested = rows.select(
        F.col(key).alias("key"),
        F.col(uri).alias("uri"),
        F.sha2(content, 256).alias("digest"),
        base32_sha1(content).alias("sha1"),
        F.length(content).cast("bigint").alias("bytes"),
    )
    # One row for repeated rows, so that exactly one of them can be told apart below.
    distinct = digested.groupBy("key", "uri", "digest", "sha1", "bytes").agg(
        F.count(F.lit(1)).alias("copies")
    )
    order = F.struct(F.col("key").isNull().alias("none"), "key", "uri")
    firsts = digested.groupBy("digest").agg(
        F.min(order).alias("first"),
        F.min("sha1").alias("least"),
        F.max("sha1").alias("most"),
        F.min("bytes").alias("shortest"),
        F.max("bytes").alias("longest"),
        F.count(F.lit(1)).alias("n"),
    )
    verified = F.when(
        (F.col("least") == F.col("most")) & (F.col("shortest") == F.col("longest")), F.col("first")
    ).otherwise(F.raise_error(F.lit("two payloads share a SHA-256 digest")))
    firsts = firsts.select("digest", verified.alias("first"), "n")
    records = attach_per_key(distinct, firsts, ["digest"], ["key", "uri"], size="n")
    records = stored(
        records.select(
            "key",
            "uri",
            "digest",
            "sha1",
            "bytes",
            F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"),
            F.col("first").eqNullSafe(order).alias("is_first"),
            F.col("first.key").alias("first_key"),
        ),
        "warc-records",
    )
    chosen = F.col("is_first") & (F.col("copy") == 1)
    response = (F.col("bytes") < min_bytes) | chosen
    headers = records.withColumn("response", response).select(
        _header(date).cast("binary").alias("header"), "digest"
    )
    headers.write.option("compression", "zstd").parquet(f"{path}/headers")

    # Keys whose payload is given by another row. They are few, or else Spark sees from
    # the size of the stored table that they need a shuffle join. `again`: the first key
    # itself, where it is NULL or repeated; one of its rows is then picked by digest.
    left_out = stored(
        records.filter(~chosen | F.col("key").isNull())
        .select("key", "digest", F.col("key").eqNullSafe(F.col("first_key")).alias("again"))
        .distinct(),
        "warc-left-out",
    )
    bodies = rows.select(
        F.col(key).alias("key"), content.alias("payload"), F.sha2(content, 256).alias("digest")
    )
    single = bodies.filter(F.col("key").isNotNull()).join(
        left_out, ["key", "digest"], "left_anti"
    )
    again = (
        bodies.join(left_out.filter("again").select("digest").distinct(), "digest", "left_semi")
        .groupBy("digest")
        .agg(F.first("payload").alias("payload"))
    )
    payloads = single.select("digest", "payload").union(again.select("digest", "payload"))
    payloads.write.option("compression", "zstd").parquet(f"{path}/payloads")
    return read_archive(rows.sparkSession, path)


def _header(date: str) -> Column:
    """The exact header block, blank line included. A revisit carries no bytes of its own."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(END_OF_LINE))
    identity = lambda k: F.concat(F.lit(f"<{ID_PREFIX}"), k.cast("string"), F.lit(">"))
    lines = [
        F.lit(f"WARC/1.1{END_OF_LINE}"),
        line("WARC-Type", F.when(F.col("response"), "response").otherwise("revisit")),
        line("WARC-Record-ID", identity(F.col("key"))),
        line("WARC-Target-URI", F.when(_breaks("uri"), _escaped("uri")).otherwise(F.col("uri"))),
        F.when(_breaks("uri"), line(ESCAPED, F.lit("yes"))),
        F.lit(f"WARC-Date: {date}{END_OF_LINE}"),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(~F.col("response"), line("WARC-Refers-To", identity(F.col("first_key")))),
        line("Content-Length", F.when(F.col("response"), F.col("bytes")).otherwise(0).cast("string")),
        F.lit(END_OF_LINE),
    ]
    return F.concat(*[F.coalesce(x, F.lit("")) for x in lines])


def _breaks(uri: str) -> Column:
    """Whether a URI holds a line end, which would end its header line."""
    return F.col(uri).rlike("[\\r\\n]")


def _escaped(uri: str) -> Column:
    for plain, code in ESCAPES:
        uri = F.replace(uri, F.lit(plain), F.lit(code))
    return uri


def _unescaped(uri: Column) -> Column:
    for plain, code in reversed(ESCAPES):
        uri = F.replace(uri, F.lit(code), F.lit(plain))
    return uri


def read_archive(spark, path: str) -> Archive:
    """An archive that `write_archive` has written."""
    return Archive(
        path, spark.read.parquet(f"{path}/headers"), spark.read.parquet(f"{path}/payloads")
    )


def checked_payloads(archive: Archive) -> DataFrame:
    """`payloads` with `sha1` and `bytes` of the stored bytes; fails if a digest is wrong."""
    good = F.sha2("payload", 256) == F.col("digest")
    payload = F.when(good, F.col("payload")).otherwise(
        F.raise_error(F.lit("stored payload doesn't match its digest"))
    )
    checked = archive.payloads.select("digest", payload.alias("payload"))
    return checked.select(
        "digest",
        "payload",
        base32_sha1(F.col("payload")).alias("sha1"),
        F.length("payload").cast("bigint").alias("bytes"),
    )


def parsed_headers(archive: Archive) -> DataFrame:
    """Header fields by name, next to the exact bytes: one row per record."""
    text = F.decode(F.col("header"), "UTF-8")
    field = lambda name: F.nullif(
        F.regexp_extract(text, rf"(?dm)^{name}: ([^\r\n]*)\r$", 1), F.lit("")
    )
    key = lambda name: F.nullif(
        F.regexp_extract(text, rf"(?dm)^{name}: <{ID_PREFIX}([^>]*)>\r$", 1), F.lit("")
    ).cast("bigint")
    uri = field("WARC-Target-URI")
    return archive.headers.select(
        "header",
        "digest",
        key("WARC-Record-ID").alias("key"),
        key("WARC-Refers-To").alias("refers_to"),
        field("WARC-Type").alias("record_type"),
        F.when(field(ESCAPED) == "yes", _unescaped(uri)).otherwise(uri).alias("uri"),
        field("Content-Length").cast("bigint").alias("content_length"),
        F.regexp_replace(field("WARC-Payload-Digest"), "^sha1:", "").alias("payload_digest"),
    )


def records(archive: Archive, with_payload: bool = True) -> DataFrame:
    """Every record: its header fields with the payload it stands for, joined by digest.

    `payload_bytes` and `payload_digest` come from the stored bytes. `with_payload`
    adds `payload` itself; without it the join moves digests only.
    """
    per_digest = checked_payloads(archive)
    values = ["sha1", "bytes"] + ["payload"] * with_payload
    # Both sides are scans, so Spark splits the rows of a very frequent digest itself.
    joined = parsed_headers(archive).join(per_digest.select("digest", *values), "digest", "left")
    matches = F.col("payload_digest") == F.col("sha1")
    return joined.select(
        "key",
        "uri",
        "record_type",
        "refers_to",
        "header",
        F.when(matches, F.col("sha1"))
        .otherwise(F.raise_error(F.lit("a record has no payload of its digest")))
        .alias("payload_digest"),
        F.col("bytes").alias("payload_bytes"),
        *(["payload"] * with_payload),
    )


def original_bytes(archive: Archive) -> DataFrame:
    """Each record as it stands in a WARC file: header block, own bytes, two line ends."""
    own = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
    end = F.lit((END_OF_LINE * 2).encode())
    return records(archive).select("key", F.concat("header", own, end).alias("record"))


def scratch_archive(spark) -> str:
    """A new folder for an archive among the session's shared intermediate tables."""
    return f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
