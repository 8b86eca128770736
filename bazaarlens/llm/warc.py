"""Web pages as WARC archives, and the index of their captures merged from sorted runs."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarlens.llm.base import saved, small_or_shuffled, text_of
from bazaarlens.session import scratch_path

VERSION = "WARC/1.1"
# Pages below this size share files of at most so many records; files of longer ones are bounded by bytes.
SHORT_BYTES, RECORDS_PER_FILE = 64 << 10, 2_000
FILE_BYTES = SHORT_BYTES * RECORDS_PER_FILE
# Captures that one merge task holds at most, about.
RANGE_ROWS = 50_000
MOST_BROADCAST = 500_000
BREAK = "\r\n"
END = BREAK * 2

CAPTURES = (
    "urlkey string, timestamp string, page_id bigint, url string, record_type string, refers_to bigint,"
    " payload_digest string, payload_bytes bigint, run string, offset bigint, length bigint"
)
ORDER = ("urlkey", "timestamp", "page_id", "run", "offset")


def base32_sha1(payload: Column) -> Column:
    """Five hex digits are four digits to the base 32."""
    hexadecimal = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(hexadecimal, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def decided(pages: DataFrame, payload: str, page_id: str, min_bytes: int) -> DataFrame:
    """Pages with digest, size and whether another capture of the same payload is the one kept in full.

    Only digests that come up twice or more are joined, with the smallest id of theirs.
    """
    known = pages.withColumns(
        {
            "__payload": text_of(payload),
            "__digest": base32_sha1(text_of(payload).cast("binary")),
            "__bytes": F.octet_length(text_of(payload)).cast("bigint"),
        }
    )
    narrow = known.filter(F.col("__bytes") >= min_bytes).select("__digest", F.col(page_id).alias("__id"))
    firsts = narrow.groupBy("__digest").agg(F.min("__id").alias("__first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    known = known.join(small_or_shuffled(saved(firsts, "payload-firsts"), MOST_BROADCAST), "__digest", "left")
    # Below the least size no row has a first one.
    first = F.when(F.col("__bytes") >= min_bytes, F.col("__first"))
    return known.withColumn("__revisit", F.coalesce(F.col(page_id) != first, first.isNotNull() & F.col(page_id).isNull()))


def write_archives(
    pages: DataFrame,
    path: str,
    payload: str = "html",
    page_id: str = "page_id",
    url: str = "url",
    timestamp: Column | None = None,
    min_bytes: int = 0,
) -> None:
    """One WARC record a page, in files of at most ``FILE_BYTES`` of payload, about, or one record; each task's records are
    sorted by URL key and time, so a file is a sorted run. Times are written in UTC, whatever the session's zone.

    Of pages with equal payloads of at least ``min_bytes``, the one with the smallest id is a response and holds the
    payload; the others are revisits that refer to it and hold the HTTP head alone. Rows that share the smallest id are all
    responses, as are rows without an id where no equal one has any. A null payload counts as empty. White space and
    control characters in a URL are percent-encoded; a null URL leaves its header out. Spark's text writer commits whole
    files, so a lost executor leaves no part of one.
    """
    when = timestamp if timestamp is not None else F.timestamp_seconds(F.lit(0))
    rows = decided(pages.withColumn("__time", when), payload, page_id, min_bytes)
    name = F.concat(F.lit("<urn:page:"), F.coalesce(F.col(page_id).cast("string"), F.lit("")), F.lit(">"))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{BREAK}Content-Type: text/html; charset=utf-8{BREAK}Content-Length: "),
        F.col("__bytes"), F.lit(END),
    )

    def header(label: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{label}: "), value, F.lit(BREAK)), F.lit(""))

    uri = F.regexp_replace(F.col(url), r"[\x00-\x20\x7f]", "%20")
    refers = F.when(F.col("__revisit"), F.concat(F.lit("<urn:page:"), F.col("__first").cast("string"), F.lit(">")))
    profile = F.when(F.col("__revisit"), F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
    body = F.concat(F.col("__http"), F.when(F.col("__revisit"), F.lit("")).otherwise(F.col("__payload")))
    record = F.concat(
        F.lit(VERSION + BREAK),
        header("WARC-Type", F.when(F.col("__revisit"), F.lit("revisit")).otherwise(F.lit("response"))),
        header("WARC-Record-ID", name),
        header("WARC-Date", utc_time(F.col("__time"))),
        header("WARC-Target-URI", uri),
        header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("__digest"))),
        header("WARC-Profile", profile),
        header("WARC-Refers-To", refers),
        header("Content-Type", F.lit("application/http; msgtype=response")),
        header("Content-Length", F.octet_length(F.col("__body")).cast("string")),
        F.lit(BREAK),
        F.col("__body"),
    )
    ordered = rows.withColumn("__http", http).withColumn("__body", body).withColumn("__key", url_key(F.col(url)))
    long = F.col("__bytes") >= SHORT_BYTES
    longest = pages.agg(F.max(F.octet_length(text_of(payload)))).head()[0] or 0

    def write(some: DataFrame, most: int) -> None:
        run = some.sortWithinPartitions("__key", "__time", page_id).select(record.alias("value"))
        run.write.mode("append").option("lineSep", END).option("maxRecordsPerFile", most).text(path)

    write(ordered.filter(~long), RECORDS_PER_FILE)
    if longest >= SHORT_BYTES:
        write(ordered.filter(long), max(1, FILE_BYTES // longest))


def utc_time(time: Column) -> Column:
    """A time to the second in UTC. Days and seconds are counted, as Spark's own formats follow the session's zone."""
    second = F.unix_seconds(time)
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(second / 86_400).cast("int")).cast("string")
    parts = [F.lpad(F.floor(F.pmod(second, F.lit(86_400)) / size % base).cast("string"), 2, "0") for size, base in ((3600, 24), (60, 60), (1, 60))]
    return F.concat(day, F.lit("T"), F.concat_ws(":", *parts), F.lit("Z"))


@F.pandas_udf(T.StringType())
def url_key(urls: pd.Series) -> pd.Series:
    return pd.Series([key_of(u) for u in urls], dtype=object)


def key_of(url: str | None) -> str:
    """A URL's sort key: its host from the top level down, without ``www``, then port, path and query. Without a URL it is
    empty; what cannot be parsed is taken as it is, in lower case."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip())
        host, port = parts.hostname or "", parts.port
    except ValueError:
        return url.lower()
    host = host.removeprefix("www.")
    port_text = "" if port in (None, 80, 443) else f":{port}"
    query = f"?{parts.query}" if parts.query else ""
    return f"{','.join(reversed(host.split('.')))}{port_text}){(parts.path or '/').rstrip('/') or '/'}{query}".lower()


def records(data: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """Offset, length, headers by lower-case name and block of each record of an archive."""
    at = 0
    while at < len(data):
        head_end = data.index(END.encode(), at)
        lines = data[at:head_end].decode("utf-8").split(BREAK)
        if lines[0] != VERSION:
            raise ValueError(f"no record at {at}")
        headers = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}
        start = head_end + len(END)
        end = start + int(headers["content-length"])
        if data[end : end + len(END)] != END.encode():
            raise ValueError(f"record at {at} has no end")
        yield at, end - at, headers, data[start:end]
        at = end + len(END)


def page_number(name: str | None) -> int | None:
    digits = (name or "").removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def _captures(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path, data in zip(batch["path"], batch["content"], strict=True):
            rows = []
            for offset, length, headers, block in records(bytes(data)):
                head, _, payload = block.partition(END.encode())
                size = int(head.rpartition(b"Content-Length: ")[2])
                digest = headers["warc-payload-digest"].removeprefix("sha1:")
                kind = headers["warc-type"]
                if kind == "response":
                    if len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                        raise ValueError(f"the payload at {offset} of {path} does not fit its digest")
                url = headers.get("warc-target-uri")
                rows.append(
                    (key_of(url), headers["warc-date"], page_number(headers["warc-record-id"]), url, kind,
                     page_number(headers.get("warc-refers-to")), digest, size, path, offset, length)
                )
            names = [c.split()[0] for c in CAPTURES.split(", ")]
            yield pd.DataFrame(rows, columns=names).astype({"page_id": "Int64", "refers_to": "Int64"})


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The captures of all archives under a path, read back from the files, with place and length of their records. A
    response whose payload does not fit its digest is an error."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "content")
    return files.mapInPandas(_captures, CAPTURES)


class LoserTree:
    """Merges sorted runs: each inner node remembers the run that lost there, so the next row takes one comparison a level."""

    def __init__(self, runs: list[list[tuple]]):
        self.runs, self.at, self.k = runs, [0] * len(runs), len(runs)
        self.losers = [-1] * max(1, self.k)
        for run in range(self.k):
            self._play(run)

    def _less(self, a: int, b: int) -> bool:
        """Whether run a's next row comes before run b's; a run at its end comes last."""
        if self.at[a] == len(self.runs[a]):
            return False
        if self.at[b] == len(self.runs[b]):
            return True
        return (self.runs[a][self.at[a]], a) < (self.runs[b][self.at[b]], b)

    def _play(self, run: int) -> None:
        node = (run + self.k) // 2
        while node:
            other = self.losers[node]
            if other == -1:  # while building: wait here for the other side
                self.losers[node] = run
                return
            if self._less(other, run):
                self.losers[node], run = run, other
            node //= 2
        self.losers[0] = run

    def __iter__(self) -> Iterator[tuple]:
        while self.k:
            run = self.losers[0]
            if self.at[run] == len(self.runs[run]):
                return
            yield self.runs[run][self.at[run]]
            self.at[run] += 1
            self._play(run)


def _sort_value(value):
    return (1, "") if value is None or value != value else (0, value)


def _merged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The rows of one range of keys, run by run in sorted order, merged."""
    parts = [b for b in batches if len(b)]
    if not parts:
        return
    rows = pd.concat(parts, ignore_index=True)
    keys = list(zip(*[[_sort_value(v) for v in rows[c].tolist()] for c in ("urlkey", "timestamp", "page_id", "offset")], range(len(rows)), strict=True))
    starts = [i for i in range(len(rows)) if i == 0 or rows["run"].iat[i] != rows["run"].iat[i - 1]]
    runs = [keys[a:b] for a, b in zip(starts, [*starts[1:], len(rows)], strict=True)]
    order = [key[-1] for key in LoserTree(runs)]
    for at in range(0, len(order), 5_000):
        yield rows.iloc[order[at : at + 5_000]].assign(nth=range(at, min(at + 5_000, len(order))))


def merged_index(captures: DataFrame) -> DataFrame:
    """The captures in one global order of URL key, time and id: ``range`` numbers the ranges of keys, ``nth`` the captures
    inside one.

    Every run is sorted by itself. Runs are cut at the bounds of key ranges, found from a sample, so that a range holds
    about ``RANGE_ROWS`` captures at most; a URL captured very often is cut by time. A task merges the pieces of all runs
    that fall in its range with a tree of losers. Rows without an id come last among equals.
    """
    captures = saved(captures, "captures")
    spark = captures.sparkSession
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-captures.count() // RANGE_ROWS))
    dealt = captures.repartitionByRange(ranges, *[F.col(c).asc_nulls_last() for c in ORDER])
    runs = dealt.sortWithinPartitions("run", *[F.col(c).asc_nulls_last() for c in ORDER])
    return runs.mapInPandas(_merged, CAPTURES + ", nth bigint").withColumn("range", F.spark_partition_id())


def capture_histories(pages: DataFrame, timestamp: Column | None = None, path: str | None = None, **options) -> DataFrame:
    """Archives written under ``path`` (the shared folder, if none is given), read back and indexed in order."""
    path = path or scratch_path(pages.sparkSession, "warc")
    write_archives(pages, path, timestamp=timestamp, **options)
    return merged_index(read_archives(pages.sparkSession, path))
