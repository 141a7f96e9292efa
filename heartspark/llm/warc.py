"""WARC records and resolution of not-modified revisits.

A crawler that gets 304 Not Modified writes a revisit record without a body. Each is resolved by an
as-of join: the latest full response to the same canonical URL before it. Validators of both must
agree (entity tags by weak comparison, else Last-Modified, else payload digest); the response's
headers are then updated by those that a 304 may carry, and its body stands.

A common URL may have any share of the rows. Rows of a URL at one time are first reduced to one
point; points are dealt by (URL, stretch of time), the latest response of each stretch is carried to
later stretches, which are few for each URL, and the rows are joined back to their points. No
stage needs all rows of a URL in one task.

Results by definition: a null URL is the canonical URL ''; null times come before all others, so a
revisit without a time has no earlier response; responses of the same URL and time are tied, and
the greatest record id counts; revisits that repeat are each resolved; a header whose value is null
counts as absent; records that are neither responses nor revisits (warcinfo, request, ...) and responses without a status line are
parsed, with null where something is missing, and take no part in resolving; an empty table gives an empty result; further columns are left out.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ship_package
from .rows import cut, let, pick, text_or_empty

CRLF = "\r\n"
#: Headers of a 304 that update the stored response.
UPDATES = ("age", "cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary", "warning")
#: Stretches of time that points are dealt by: so many, and more if they would hold more rows than this.
STRETCHES, STRETCH_ROWS = 64, 1 << 20


def canonical_url(url: Column) -> Column:
    """Without scheme, ``www.`` or ``m.``, user, standard port, fragment, session and campaign parameters and trailing slash;
    the host in lower case and the other parameters in order."""
    u = F.regexp_replace(F.trim(text_or_empty(url)), r"#.*$", "")
    u = F.regexp_replace(u, r"^(?i:https?:)?//", "")
    host = F.lower(F.regexp_extract(u, r"^([^/?]*)", 1))
    rest = F.substring(u, F.length(F.regexp_extract(u, r"^([^/?]*)", 1)) + 1, F.length(u))
    host = F.regexp_replace(F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":(80|443)$", ""), r"^(www\d*|m)\.", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"^([^?]*)", 1), r"/+$", "")
    query = F.regexp_extract(rest, r"\?(.*)$", 1)
    params = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.lower(p).rlike(
        r"^(utm_[a-z]+|gclid|fbclid|ref|phpsessid|jsessionid|sid)(=|$)")))
    return F.concat(host, path, F.when(F.size(params) > 0, F.concat(F.lit("?"), F.array_join(params, "&"))).otherwise(F.lit("")))


def write_record(kind: Column, record_id: Column, url: Column, at: Column, http: Column, refers_to: Column | None = None) -> Column:
    """A WARC/1.1 record as text: its header, and ``http`` (status line, headers, blank line, body) as its block."""
    head = F.concat(
        F.lit(f"WARC/1.1{CRLF}WARC-Type: "), kind, F.lit(f"{CRLF}WARC-Record-ID: <urn:record:"), record_id.cast("string"),
        F.lit(f">{CRLF}WARC-Target-URI: "), text_or_empty(url),
        F.coalesce(F.concat(F.lit(f"{CRLF}WARC-Date: "), F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")), F.lit("")),
        F.lit("" if refers_to is None else f"{CRLF}WARC-Refers-To: "), F.lit("") if refers_to is None else text_or_empty(refers_to),
        F.when(kind == "revisit", F.lit(f"{CRLF}WARC-Profile: http://netpreserve.org/warc/1.1/revisit/server-not-modified")).otherwise(F.lit("")),
        F.lit(f"{CRLF}Content-Type: application/http; msgtype=response{CRLF}Content-Length: "),
        F.octet_length(http).cast("string"), F.lit(CRLF + CRLF))
    return F.concat(head, http, F.lit(CRLF + CRLF))


def _headers(block: Column) -> Column:
    """Header lines as a map from lower-case names; of a repeated name the last value counts."""
    lines = F.filter(F.split(block, r"\r?\n"), lambda x: x.contains(":"))
    pairs = F.transform(lines, lambda x: F.struct(
        F.lower(F.trim(F.substring_index(x, ":", 1))).alias("key"), F.trim(F.substring(x, F.instr(x, ":") + 1, F.length(x))).alias("value")))
    last = lambda found, k: F.element_at(F.filter(found, lambda p: p["key"] == k), -1)["value"]
    return let(pairs, lambda found: let(F.array_distinct(found["key"]), lambda names: F.map_from_arrays(
        names, F.transform(names, lambda k: last(found, k)))))


def parse_records(df: DataFrame, record_col: str = "record") -> DataFrame:
    """(kind, record_id, url, at, status, headers, digest, payload_digest) of WARC records given as text, without bodies.

    ``digest`` is the SHA-256 of the body, ``payload_digest`` what the record's own header says (algorithm, colon, value). Dates may
    have any precision that the format allows. What doesn't start as a WARC record is left out.
    """
    rows = pick(df, record=record_col).where(F.col("record").startswith("WARC/"))
    c = F.col
    rows = rows.withColumn("cut", F.instr("record", CRLF + CRLF)).withColumn(
        "warc", _headers(F.substring(c("record"), F.lit(1), c("cut") - 1)))
    rows = rows.withColumn("block", F.substring(c("record"), c("cut") + 4, F.length("record") - c("cut") - 7))
    rows = rows.withColumn("end", F.instr("block", CRLF + CRLF)).withColumn(
        "http", F.when(c("end") > 0, F.substring(c("block"), F.lit(1), c("end") - 1)).otherwise(c("block")))
    body = F.when(c("end") > 0, F.substring(c("block"), c("end") + 4, F.length("block"))).otherwise(F.lit(""))
    return rows.select(
        c("warc")["warc-type"].alias("kind"), F.regexp_replace(c("warc")["warc-record-id"], r"^<(urn:record:)?|>$", "").alias("record_id"),
        F.regexp_replace(c("warc")["warc-target-uri"], r"^<|>$", "").alias("url"), F.regexp_replace(c("warc")["warc-date"], r"T(\d\d:\d\d)(?=Z|[+-])", "T$1:00").try_cast("timestamp").alias("at"),
        F.regexp_extract("http", r"^HTTP/\S+ (\d+)", 1).try_cast("int").alias("status"),
        _headers(F.regexp_replace("http", r"^HTTP/[^\r\n]*\r?\n?", "")).alias("headers"),
        F.sha2(body, 256).alias("digest"), c("warc")["warc-payload-digest"].alias("payload_digest"))


LENGTH = re.compile(rb"(?im)^content-length:[ \t]*(\d+)[ \t]*\r?$")
START = re.compile(rb"(?:^|(?<=\n))WARC/\d+\.\d+\r\n")


def gunzipped(data: bytes, step: int = 1 << 16) -> Iterator[bytes]:
    """The members of a gzip file, one after the other."""
    at = 0
    while at < len(data):
        member, parts = zlib.decompressobj(31), []
        while at < len(data) and not member.eof:
            piece = data[at:at + step]
            parts.append(member.decompress(piece))
            at += len(piece) - len(member.unused_data)
        yield b"".join(parts)
        while data[at:at + 1] == b"\0":  # padding
            at += 1


def split_records(data: bytes) -> Iterator[bytes]:
    """WARC records of either version, each as long as its Content-Length says, so that a body may hold anything. What is no record
    between two records is passed over, up to the next line that starts one."""
    at = 0
    while m := START.search(data, at):
        head = data.find(b"\r\n\r\n", m.end())
        size = LENGTH.search(data, m.end(), head) if head >= 0 else None
        if size is None:
            at = m.end()
            continue
        end = head + 4 + int(size[1])
        yield data[m.start():end] + b"\r\n\r\n"
        at = end


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(record) of WARC files, plain or gzip by record. A file is one task's, so its size is that of the format's advice (1 GB), and 2 GB at most."""
    ship_package(spark)

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                data = batch.column(0)[i].as_py()
                some, size = [], 0
                for part in gunzipped(data) if data[:2] == b"\x1f\x8b" else [data]:
                    for record in split_records(part):
                        some.append(record)
                        size += len(record)
                        if size > 1 << 24:
                            yield pa.RecordBatch.from_arrays([pa.array(some, pa.binary())], names=["record"])
                            some, size = [], 0
                yield pa.RecordBatch.from_arrays([pa.array(some, pa.binary())], names=["record"])

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(run, "record binary").select(F.col("record").cast("string").alias("record"))


def _weak(tag: Column) -> Column:
    return F.regexp_replace(tag, r"^[Ww]/", "")


def _said_digest(c: Column) -> Column:
    """A digest header in a form to compare: the algorithm in lower case; hexadecimal and base 32 say the same in either case."""
    name = F.lower(F.trim(F.substring_index(c, ":", 1)))
    return F.concat(name, F.lit(":"), F.lower(F.trim(F.substring(c, F.instr(c, ":") + 1, F.length(c)))))


def resolve(records: DataFrame, stretches: int | None = None) -> DataFrame:
    """(record_id, canonical_url, at, target_id, outcome, headers) of each revisit in ``records``.

    ``records`` as parse_records() gives them. ``outcome``: ``resolved``, ``mismatch`` (validators
    differ), ``unverified`` (no validator in common) or ``missing`` (no earlier response).
    ``target_id`` is the latest earlier response whatever the outcome; ``headers`` are merged for
    resolved revisits and null else, as ``name: value`` lines in order of names.
    """
    c = F.col
    if "payload_digest" not in records.columns:
        records = records.withColumn("payload_digest", F.lit(None).cast("string"))
    rows = pick(records, kind="kind", record_id="record_id", url="url", at="at", status="status", headers="headers", digest="digest", said="payload_digest")
    rows = rows.withColumns({"key": canonical_url(c("url")), "us": F.coalesce(F.unix_micros("at"), F.lit(-1 << 62))})
    rows = cut(records.sparkSession, rows)
    full = (c("kind") == "response") & c("status").between(200, 299)
    points = rows.where(full | (c("kind") == "revisit")).groupBy("key", "us").agg(
        F.max(F.when(full, c("record_id"))).alias("response"))
    stretches = stretches or max(STRETCHES, rows.count() // STRETCH_ROWS)
    # Stretches hold about as many rows each, whatever the spread of times.
    bounds = sorted(set(rows.approxQuantile("us", [k / stretches for k in range(1, stretches)], 0.25 / stretches)))
    points = points.withColumn("stretch", F.size(F.filter(F.lit([int(b) for b in bounds]).cast("array<bigint>"), lambda b: b <= c("us"))))
    inside = Window.partitionBy("key", "stretch").orderBy("us").rowsBetween(Window.unboundedPreceding, -1)
    near = points.withColumn("near", F.last("response", ignorenulls=True).over(inside))
    latest = points.where("response is not null").groupBy("key", "stretch").agg(F.max(F.struct("us", "response"))["response"].alias("latest"))
    known = points.select("key", "stretch").distinct().join(latest, ["key", "stretch"], "left")
    across = Window.partitionBy("key").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    carried = known.withColumn("far", F.last("latest", ignorenulls=True).over(across)).select("key", "stretch", "far")
    found = near.join(carried, ["key", "stretch"]).select("key", "us", F.coalesce("near", "far").alias("target_id"))
    revisits = rows.where(c("kind") == "revisit").join(found, ["key", "us"], "left")
    responses = rows.where(full).select(c("record_id").alias("target_id"), c("headers").alias("stored"), c("digest").alias("stored_digest"), c("said").alias("stored_said"))
    # A record id that is there twice would double its revisits: the first in order counts.
    responses = responses.groupBy("target_id").agg(F.min(F.struct(F.to_json("stored").alias("stored"), "stored_digest", "stored_said")).alias("x")).select(
        "target_id", F.from_json("x.stored", "map<string,string>").alias("stored"), c("x.stored_digest").alias("stored_digest"), c("x.stored_said").alias("stored_said"))
    # Revisits without a target don't take part in the join, where they would all have the same key.
    both = revisits.where("target_id is not null").join(responses, "target_id", "left").unionByName(
        revisits.where("target_id is null"), allowMissingColumns=True)
    mine, theirs = (lambda k: c("headers")[k]), (lambda k: c("stored")[k])
    algorithm = F.lower(F.substring_index(c("said"), ":", 1))
    verdict = (F.when(c("target_id").isNull(), "missing")
               .when(mine("etag").isNotNull() & theirs("etag").isNotNull(), F.when(_weak(mine("etag")) == _weak(theirs("etag")), "resolved").otherwise("mismatch"))
               .when(mine("last-modified").isNotNull() & theirs("last-modified").isNotNull(),
                     F.when(mine("last-modified") == theirs("last-modified"), "resolved").otherwise("mismatch"))
               # Digests of one algorithm are compared as the records say them; a SHA-256 in hexadecimal also with that of the stored body.
               .when(algorithm == F.lower(F.substring_index(c("stored_said"), ":", 1)), F.when(_said_digest(c("said")) == _said_digest(c("stored_said")), "resolved").otherwise("mismatch"))
               .when((algorithm == "sha256") & _said_digest(c("said")).rlike("^sha256:[0-9a-f]{64}$"),
                     F.when(_said_digest(c("said")) == F.concat(F.lit("sha256:"), "stored_digest"), "resolved").otherwise("mismatch"))
               .when(mine("x-payload-digest").isNotNull(), F.when(mine("x-payload-digest") == c("stored_digest"), "resolved").otherwise("mismatch"))
               .otherwise("unverified"))
    kept = F.map_filter("stored", lambda k, v: v.isNotNull() & ~(k.isin(*UPDATES) & F.coalesce(c("headers")[k].isNotNull(), F.lit(False))))
    new = F.map_filter("headers", lambda k, v: k.isin(*UPDATES) & v.isNotNull())
    lines = F.array_sort(F.transform(F.map_entries(F.map_concat(kept, new)), lambda e: F.concat(e["key"], F.lit(": "), e["value"])))
    both = both.withColumn("outcome", verdict)
    return both.select("record_id", c("key").alias("canonical_url"), "at", "target_id", "outcome",
                       F.when(c("outcome") == "resolved", F.array_join(lines, "\n")).alias("headers"))
