"""WARC archives through a chunked record table.

A record's payload travels as (record, chunk number) rows of at most CHUNK bytes: the JVM cuts it,
so Python and Arrow never hold a whole record, and a running SHA-1 is carried over a record's chunk
rows; the last row's is the record's, and a reader can check every chunk as it streams.  The
first chunk is a WARC response record; later chunks are WARC continuation records with segment
numbers, which is how WARC itself splits oversized payloads.

Every WARC record is a gzip member of its own, as WARC readers expect.  The members go through
Spark's text sink, so any Hadoop file system serves, commits are atomic, and a task lost with its
executor is simply repeated: a member of less than 16 MB ends in a zero byte (the top of its
length), which is left out and comes back as the sink's line separator.  The committed
files are renamed to ``.warc.gz``.  Gzip keeps a file in one task, so the reader's state machine sees
the records of a file in order and holds one chunk at a time.

Equal payloads (also empty ones) are found by digest and length: the least page id is the
response, the others are revisits without payload.  A record's id is made of the page id and the payload's
digest, a continuation's of its origin's and the segment number, so all ids differ and a revisit can name
its response.

Cases: a null payload is empty; null ids come last and become the response only where all ids of
a payload are null; rows that repeat id and payload are the same capture and all responses, or
all revisits, with numbered record ids; html may hold any text, also CRLF CRLF or what looks like a
record, and be very long; an empty table gives no records; a null url is written as an empty target; other columns,
whatever their names, are not read.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .staging import key_of, new_path, small_side, staged

CHUNK = 1 << 20
MIN_REVISIT = 0
SEP = b"\r\n\r\n"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = b"2000-01-01T00:00:00Z"
LEVEL = 5  # of the compression
_CHUNK_ROW = "record_id string, page string, url string, first string, refers_to string, size long, sha binary, chunk_no int, chunks int, data binary"


def base32(sha: bytes) -> bytes:
    return base64.b32encode(sha)


def chunk_rows(pages: DataFrame, id_col="page_id", url_col="url", payload_col="html", chunk: int = CHUNK, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """The chunked record table, without digests so far: _CHUNK_ROW.  ``first`` is a revisit's
    response (its page id) and null for responses; a record's chunks follow each other."""
    data = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"").cast("binary"))
    rows = pages.select(F.col(id_col).alias("page"), F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("url"), data.alias("data"), F.unhex(F.sha1(data)).alias("sha"))
    rows = rows.withColumn("size", F.octet_length("data").cast("long"))
    # Only payloads that repeat need a lookup; all others are their own response.
    rows = rows.withColumn("p", key_of(F.col("page")))
    each = staged(rows.groupBy("sha", "p").agg(F.count("*").alias("n"), F.min("page").alias("page"), F.min("size").alias("size")), "captures")
    groups = each.where(F.col("size") >= min_revisit).groupBy("sha").agg(F.sum("n").alias("n"), F.min("page").alias("first"))
    groups = staged(groups.where("n > 1 AND first IS NOT NULL").select("sha", "first"), "repeated")
    rows = rows.join(small_side(groups), "sha", "left")
    rows = rows.withColumn("first", F.when(F.col("first").isNotNull() & ~F.col("page").eqNullSafe(F.col("first")), F.col("first").cast("string")))
    urn = lambda page: F.concat(F.lit("urn:page:"), F.coalesce(page.cast("string"), F.lit("null")), F.lit(":"), F.hex("sha"))
    twice = staged(each.where("n > 1").select("sha", "p"), "twice")  # rows that repeat page and payload get a number
    if twice.isEmpty():
        rows = rows.withColumn("record_id", urn(F.col("page")))
    else:
        number = F.row_number().over(Window.partitionBy("sha", "p").orderBy("url"))
        again = rows.join(small_side(twice), ["sha", "p"], "left_semi").withColumn("record_id", F.when(number == 1, urn(F.col("page"))).otherwise(F.concat(urn(F.col("page")), F.lit(":copy:"), number)))
        rows = rows.join(small_side(twice), ["sha", "p"], "left_anti").withColumn("record_id", urn(F.col("page"))).unionByName(again)
    parts = f"CASE WHEN first IS NOT NULL OR size <= {chunk} THEN 1 ELSE CAST((size + {chunk - 1}) div {chunk} AS INT) END"
    cut = F.when(F.col("first").isNotNull(), F.array(F.lit(b"").cast("binary"))).when(F.col("chunks") == 1, F.array("data")).otherwise(
        F.expr(f"transform(sequence(0, chunks - 1), i -> substring(data, CAST(i * {chunk}L + 1 AS INT), {chunk}))"))
    rows = rows.withColumn("chunks", F.expr(parts).cast("int")).withColumn("refers_to", F.when(F.col("first").isNotNull(), urn(F.col("first"))))
    rows = rows.select("record_id", F.col("page").cast("string").alias("page"), "url", "first", "refers_to", "size", "sha", "chunks", F.posexplode(cut).alias("at", "data"))
    return rows.select("record_id", "page", "url", "first", "refers_to", "size", "sha", (F.col("at") + 1).cast("int").alias("chunk_no"), "chunks", "data")


def with_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, object, bytes]]:
    """Chunk rows to (row without data, data, SHA-1 of the payload so far).  A record whose last
    digest isn't the one that was announced fails."""
    sha = hashlib.sha1()
    for batch in batches:
        rows, data = batch.drop_columns(["data"]).to_pylist(), batch.column("data")
        for i, row in enumerate(rows):
            if row["chunk_no"] == 1:
                sha = hashlib.sha1()
            part = data[i].as_buffer()
            sha.update(part)
            if row["chunk_no"] == row["chunks"] and row["first"] is None and sha.digest() != row["sha"]:
                raise ValueError(f"the chunks of {row['record_id']} are not whole")
            yield row, part, sha.digest()


def chunk_table(pages: DataFrame, **options) -> DataFrame:
    """The chunked record table with digests: record_id, chunk_no, data, digest_so_far."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, data, sha in with_digests(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["record_id"]], pa.string()), pa.array([row["chunk_no"]], pa.int32()), pa.array([data.to_pybytes()], pa.binary()), pa.array([base32(sha).decode()], pa.string())],
                ["record_id", "chunk_no", "data", "digest_so_far"])

    return chunk_rows(pages, **options).mapInArrow(run, "record_id string, chunk_no int, data binary, digest_so_far string")


def _clean(value: str) -> bytes:
    return (value or "").replace("\r", " ").replace("\n", " ").encode()


def record_of(row: dict, data, so_far: bytes) -> bytes:
    """The WARC record of a chunk row, with the CRLF CRLF at its end."""
    name, http = b"<%s>" % row["record_id"].encode(), HTTP % row["size"]
    page = [] if row["page"] is None else [(b"X-Page", row["page"].encode())]
    common = [*page, (b"WARC-Date", DATE), (b"WARC-Target-URI", _clean(row["url"])), (b"WARC-Payload-Digest", b"sha1:" + base32(row["sha"])),
              (b"Content-Type", b"application/http; msgtype=response")]
    number, last = row["chunk_no"], row["chunks"]
    mark = [] if last == 1 else [(b"WARC-Segment-Number", b"%d" % number), (b"X-Digest-So-Far", base32(so_far))]
    if row["first"] is not None:
        fields = [(b"WARC-Type", b"revisit"), (b"WARC-Record-ID", name), (b"WARC-Refers-To", b"<%s>" % row["refers_to"].encode()), (b"X-Refers-To-Page", row["first"].encode()), (b"WARC-Profile", PROFILE), *common]
        block = (http,)
    elif number == 1:
        fields, block = [(b"WARC-Type", b"response"), (b"WARC-Record-ID", name), *common, *mark], (http, data)
    else:
        end = [(b"WARC-Segment-Total-Length", b"%d" % (row["size"] + len(http)))] if number == last else []
        segment = b"<%s:segment:%d>" % (row["record_id"].encode(), number)
        fields, block = [(b"WARC-Type", b"continuation"), (b"WARC-Record-ID", segment), (b"WARC-Segment-Origin-ID", name), *common, *mark, *end], (data,)
    fields.append((b"Content-Length", b"%d" % sum(len(b) for b in block)))
    return b"".join([b"WARC/1.1\r\n", b"\r\n".join(k + b": " + v for k, v in fields), SEP, *block, SEP])


def member_of(record: bytes, level: int = LEVEL) -> bytes:
    """``record`` as a gzip member without its last byte, which is zero below 16 MB."""
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    out = z.compress(record) + z.flush()
    if out[-1]:
        raise ValueError("a record must be smaller than 16 MB: take smaller chunks")
    return out[:-1]


def write_archives(pages: DataFrame, path: str, **options) -> None:
    """Write every row of ``pages`` as a record into archives below ``path``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held = [], 0
        for row, data, sha in with_digests(batches):
            out.append(member_of(record_of(row, data, sha)))
            held += len(out[-1])
            if held > 4 * CHUNK or len(out) == 4096:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])
                out, held = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    made = chunk_rows(pages, **options).mapInArrow(run, "value binary")
    made.select(F.col("value").cast("string").alias("value")).write.option("lineSep", "\0").text(path)
    spark = pages.sparkSession
    paths = spark._jvm.org.apache.hadoop.fs.Path
    folder = paths(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for found in files.listStatus(folder):  # one per task
        at = found.getPath()
        if at.getName().startswith("part-") and not files.rename(at, paths(at.getParent(), at.getName().removesuffix(".txt") + ".warc.gz")):
            raise OSError(f"{at} could not be renamed")


def parse_records(pieces: Iterator[bytes]) -> Iterator[tuple[dict, bytes]]:
    """Pieces of a file between CRLF CRLF to (headers, block); one block is held at a time."""
    for piece in pieces:
        lines = piece.split(b"\r\n")
        if not lines[0].startswith(b"WARC/"):
            raise ValueError(f"not a WARC header: {piece[:60]!r}")
        head = {k.strip(): v.strip() for k, _, v in (x.partition(b":") for x in lines[1:])}
        size, parts = int(head[b"Content-Length"]), [next(pieces, b"")]
        have = len(parts[0])
        while have < size:
            parts.append(next(pieces))
            have += len(SEP) + len(parts[-1])
        if have != size:
            raise ValueError(f"a block of {have} bytes where {size} were announced")
        yield head, SEP.join(parts)


def read_chunks(pieces: Iterator[bytes]) -> Iterator[dict]:
    """Pieces of archives to chunk rows: page, record_id, chunk_no, data, size (of the payload), so_far, last,
    type, refers_to.  Digests are made from the bytes; a damaged chunk or record fails."""
    of: dict = {}  # the record that is open
    for head, block in parse_records(pieces):
        kind = head[b"WARC-Type"].decode()
        text = lambda key: head[key].decode() if key in head else None
        announced = head[b"WARC-Payload-Digest"].removeprefix(b"sha1:").decode()
        if kind != "continuation":
            http, _, block = block.partition(SEP)
            size = int(http.rpartition(b"Content-Length:")[2])
            of = {"page": text(b"X-Page"), "record_id": text(b"WARC-Record-ID")[1:-1], "chunk_no": 0, "size": size, "have": 0, "sha": hashlib.sha1(), "type": kind, "refers_to": text(b"X-Refers-To-Page")}
        of["chunk_no"] += 1
        of["have"] += len(block)
        of["sha"].update(block)
        so_far = announced if kind == "revisit" else base32(of["sha"].digest()).decode()
        if b"X-Digest-So-Far" in head and text(b"X-Digest-So-Far") != so_far:
            raise ValueError(f"chunk {of['chunk_no']} of {of['record_id']} is damaged")
        last = kind == "revisit" or of["have"] == of["size"]
        if last and so_far != announced:
            raise ValueError(f"{of['record_id']} is damaged")
        yield {**of, "data": block, "so_far": so_far, "last": last}


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Archives to page_id, payload_bytes, payload_digest, record_type, refers_to (ids as text): the last
    chunk row of each record."""
    pieces = spark.read.option("lineSep", SEP.decode()).text(path).select(F.col("value").cast("binary").alias("value"))
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = (x.as_py() for b in batches for x in b.column(0))
        rows: list[tuple] = []
        flush = lambda: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [[]] * 5, types)], names)
        for c in read_chunks(stream):
            if c["last"]:
                rows.append((c["page"], c["size"], c["so_far"], c["type"], c["refers_to"]))
            if len(rows) == 4096:
                yield flush()
                rows = []
        if rows:
            yield flush()

    return pieces.mapInArrow(run, "page_id string, payload_bytes long, payload_digest string, record_type string, refers_to string")


def round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` as archives into the shared folder and read them back."""
    spark = pages.sparkSession
    path = new_path(spark, "archives")
    write_archives(pages, path)
    kind = dict(pages.dtypes)["page_id"]
    return read_archives(spark, path).withColumns({c: F.col(c).cast(kind) for c in ("page_id", "refers_to")})


#: The result without the archives; DuckDB's sha1 gives hexadecimal, which is turned into base32 here.
WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h)::BIGINT AS payload_bytes, sha1(h) AS x, min(page_id) OVER (PARTITION BY h) AS first FROM p),
b AS (SELECT *, list_transform(range(0, 8), lambda i: ('0x' || substr(x, i * 5 + 1, 5))::BIGINT) AS five FROM d)
SELECT page_id, payload_bytes,
       list_aggregate(list_transform(range(0, 32), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((five[j // 4 + 1] >> (15 - 5 * (j % 4))) & 31)::INTEGER + 1, 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id IS DISTINCT FROM first AND first IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM b
"""
