"""WARC archives with revisit records.

Headers (id, address, digest, length) are stored once and meet in a shuffle by
payload digest; records whose payload has an original elsewhere are written as
revisits that name it.  The originals of repeated payloads come back to the pages
by broadcast while their table is small, and by a join that spreads hot digests
beyond that; only then do payloads take part in a shuffle.
Records are written with fresh headers by Spark's text sink, each followed by
two line ends, and read back as a stream by content length, so payloads may hold
anything.  Pages are written by classes of size, so that an archive is bounded by
bytes.  A revisit is resolved by joining it to the original response it refers to.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeframe.llm.tables import hot_keys, join_spread, ship, stored, text_or_empty
from hazeframe.session import shared_folder

END = "\r\n"
#: Fixed values of the format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DIGEST = "sha256:"


def _one_line(value: Column) -> Column:
    """Header values: carriage returns, line feeds and percent signs in percent form."""
    plain = F.replace(value, F.lit("%"), F.lit("%25"))
    return F.replace(F.replace(plain, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def _record_id(page_id: Column, digest: Column) -> Column:
    h = F.md5(F.concat_ws("|", F.coalesce(page_id.cast("string"), F.lit("none")), digest))
    parts = [F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4), F.substring(h, 17, 4), F.substring(h, 21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _pages(pages: DataFrame) -> DataFrame:
    payload = text_or_empty("html")
    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"),
                        F.unhex(F.sha2(payload, 256)).alias("digest"), F.octet_length(payload).cast("long").alias("bytes"))


def page_headers(pages: DataFrame) -> DataFrame:
    """``page_id, url, digest, bytes`` of every page, stored."""
    return stored(_pages(pages).drop("payload"), "warc-headers")


def plan_records(pages: DataFrame, least: int = 100, headers: DataFrame | None = None, broadcast_bytes: int = 1 << 26) -> DataFrame:
    """``page_id, url, payload, digest, bytes, original_id, original_url``; the last two only on revisits.

    Of equal payloads of ``least`` bytes or more, the smallest page id is the
    response.  Repeated rows of that id are responses too; rows without an id
    revisit the response if there is one.  Null html is the empty payload; a
    payload of any length is hashed whole.  The table of originals is broadcast
    up to ``broadcast_bytes``.  An empty table gives no rows.
    """
    headers = page_headers(pages) if headers is None else headers
    with_id = F.when(F.col("page_id").isNotNull(), F.struct("page_id", "url"))
    originals = stored(headers.filter(F.col("bytes") >= least).groupBy("digest").agg(F.min(with_id).alias("first"), F.count("*").alias("n"))
                       .filter("n > 1 and first is not null"), "warc-originals")
    size = originals.agg(F.coalesce(F.sum(F.coalesce(F.octet_length("first.url"), F.lit(0)) + 100), F.lit(0))).first()[0]
    rows, long_enough = _pages(pages), F.col("bytes") >= least
    if size <= broadcast_bytes:
        joined = rows.join(F.broadcast(originals), "digest", "left")
    else:
        joined = join_spread(rows, originals, hot_keys(originals, "n", headers.count()), "digest", "page_id", long_enough)
    revisits = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first.page_id"))
    return joined.select(
        "page_id", "url", "payload", F.lower(F.hex("digest")).alias("digest"), "bytes",
        F.when(revisits, F.col("first.page_id")).alias("original_id"), F.when(revisits, F.col("first.url")).alias("original_url"))


def size_classes(largest: int, records_per_file: int, archive_bytes: int) -> list[tuple[int, int | None, int]]:
    """``(more than, at most, records per archive)``: payloads up to ``archive_bytes / records_per_file``, then in steps
    of 16 times the length with a 16th of the records, until one record fills an archive; as far as ``largest`` needs."""
    out, low, records = [], -1, max(1, records_per_file)
    while True:
        high = None if records == 1 else archive_bytes // records
        out.append((low, high, records))
        if high is None or largest <= high:
            return out
        low, records = high, max(1, records // 16)


def write_archives(planned: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z", records_per_file: int = 4000,
                   archive_bytes: int = 1 << 28, largest: int | None = None) -> None:
    """Write one record per row into gzip files of at most ``records_per_file`` records and ``archive_bytes`` of payload.

    A larger payload has an archive of its own.  Each class of size that occurs
    is one pass over ``planned``; ``largest`` is the longest payload, found by a
    pass of its own where the caller does not know it.
    """
    if largest is None:
        largest = planned.agg(F.coalesce(F.max("bytes"), F.lit(0))).first()[0]
    records = _records(planned, date)
    for no, (low, high, most) in enumerate(size_classes(largest, records_per_file, archive_bytes)):
        of_class = (F.col("bytes") > low) if high is None else (F.col("bytes") > low) & (F.col("bytes") <= high)
        (records.filter(of_class).select("value").write.option("lineSep", END * 2).option("compression", "gzip")
         .option("maxRecordsPerFile", most).text(f"{path}/size={no}"))


def _records(planned: DataFrame, date: str) -> DataFrame:
    """``bytes`` and the text of the record, without the two line ends that follow it."""
    is_revisit = F.col("original_id").isNotNull()
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(END))
    optional = lambda name, value: F.coalesce(line(name, value), F.lit(""))
    body = F.when(is_revisit, F.lit("")).otherwise(F.col("payload"))
    record = F.concat(
        F.lit("WARC/1.1" + END), F.when(is_revisit, line("WARC-Type", F.lit("revisit"))).otherwise(line("WARC-Type", F.lit("response"))),
        line("WARC-Record-ID", _record_id(F.col("page_id"), F.col("digest"))), line("WARC-Date", F.lit(date)),
        optional("WARC-Target-URI", _one_line(F.col("url"))), optional("Page-Id", F.col("page_id").cast("string")),
        line("WARC-Payload-Digest", F.concat(F.lit(DIGEST), F.col("digest"))), line("Payload-Length", F.col("bytes").cast("string")),
        F.when(is_revisit, F.concat(
            line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", _record_id(F.col("original_id"), F.col("digest"))),
            optional("WARC-Refers-To-Target-URI", _one_line(F.col("original_url"))), line("WARC-Refers-To-Date", F.lit(date)))).otherwise(F.lit("")),
        line("Content-Type", F.lit("text/html; charset=utf-8")), line("Content-Length", F.octet_length(body).cast("string")), F.lit(END), body)
    return planned.select("bytes", record.alias("value"))


def parse_archive(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record of one archive; one record is in memory at a time."""
    stream = gzip.GzipFile(fileobj=io.BytesIO(content)) if content[:2] == b"\x1f\x8b" else io.BytesIO(content)
    while first := stream.readline():
        if not first.startswith(b"WARC/"):
            raise ValueError(f"no record starts with {first[:40]!r}")
        headers = {}
        while (line := stream.readline()) != b"\r\n":
            if not line:
                raise ValueError("archive ends within the headers of a record")
            name, _, value = line.decode("utf-8").removesuffix(END).partition(": ")
            headers[name.lower()] = value
        size = int(headers["content-length"])
        block = stream.read(size)
        if len(block) != size or stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"record {headers['warc-record-id']} does not end where its length says")
        yield headers, block


def _restored(value: str | None) -> str | None:
    return None if value is None else value.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def read_archives(spark, path: str, with_payload: bool = False) -> DataFrame:
    """``record_id, page_id, url, record_type, refers_to_record, block_bytes, block_digest, payload_digest`` (and ``payload``).

    The digest of the block is computed from the bytes read.
    """
    schema = ("record_id string, page_id long, url string, record_type string, refers_to_record string, block_bytes long, block_digest string, "
              "payload_digest string" + (", payload string" if with_payload else ""))

    ship(spark)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                rows = []
                for h, block in parse_archive(content):
                    row = (h["warc-record-id"], int(h["page-id"]) if "page-id" in h else None, _restored(h.get("warc-target-uri")), h["warc-type"],
                           h.get("warc-refers-to"), len(block), hashlib.sha256(block).hexdigest(), h["warc-payload-digest"].removeprefix(DIGEST))
                    rows.append(row + (block.decode("utf-8"),) if with_payload else row)
                    if len(rows) == 1000:
                        yield _frame(rows, with_payload)
                        rows = []
                if rows:
                    yield _frame(rows, with_payload)
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content").mapInPandas(run, schema)


def _frame(rows: list[tuple], with_payload: bool) -> pd.DataFrame:
    names = ["record_id", "page_id", "url", "record_type", "refers_to_record", "block_bytes", "block_digest", "payload_digest", *["payload"] * with_payload]
    return pd.DataFrame(rows, columns=names).astype({"page_id": "Int64"})


def resolve_revisits(records: DataFrame) -> DataFrame:
    """``page_id, url, payload_bytes, payload_digest, record_type, refers_to`` (and ``payload``), revisits taking what their response holds."""
    extra = ["payload"] if "payload" in records.columns else []
    revisits = records.filter("record_type = 'revisit'")
    wanted = revisits.groupBy(F.col("refers_to_record").alias("r_id")).agg(F.count("*").alias("n"))
    responses = (records.filter("record_type = 'response'").groupBy(F.col("record_id").alias("r_id"))
                 .agg(F.min("page_id").alias("r_page"), F.min("block_bytes").alias("r_bytes"), F.min("block_digest").alias("r_digest"),
                      *[F.min(c).alias("r_payload") for c in extra])).join(wanted, "r_id").withColumnRenamed("r_id", "refers_to_record")
    joined = join_spread(records, responses, hot_keys(responses, "n", revisits.count()), "refers_to_record", "page_id")
    revisit = F.col("record_type") == "revisit"
    return joined.select("page_id", "url", F.when(revisit, F.col("r_bytes")).otherwise(F.col("block_bytes")).alias("payload_bytes"),
                         F.when(revisit, F.col("r_digest")).otherwise(F.col("block_digest")).alias("payload_digest"), "record_type",
                         F.when(revisit, F.col("r_page")).alias("refers_to"),
                         *[F.when(revisit, F.col("r_payload")).otherwise(F.col("payload")).alias("payload") for _ in extra])


def archive_round_trip(pages: DataFrame, least: int = 100) -> DataFrame:
    """Write ``pages`` (``page_id, url, html``) to archives in the shared folder and read them back resolved.

    Other columns are ignored; an empty table gives no rows.
    """
    path = shared_folder(pages.sparkSession, "warc")
    headers = page_headers(pages)
    largest = headers.agg(F.coalesce(F.max("bytes"), F.lit(0))).first()[0]
    write_archives(plan_records(pages, least, headers), path, largest=largest)
    return resolve_revisits(stored(read_archives(pages.sparkSession, path), "warc-records"))
