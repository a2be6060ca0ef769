"""WARC archives: writing, and reading with boundary-chain verification.

Reading cuts the archives wherever a line starts with the magic ``WARC/1.``, in a payload or not. Each task emits, for what parses
as a record header, the offset of the record and of its successor (header plus Content-Length), already contracted to the
first successor outside the task's split. Pointer jumping from offset 0 of each file then retains only records that a chain
of lengths reaches; magic inside payloads, whole embedded records included, lies on no chain and is rejected.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docgeo.llm.common import map_arrow, slices, written

MAGIC = b"WARC/1."
CUT = b"\r\n" + MAGIC  # what pieces are separated by; only a file's first record has no line before it
END = "\r\n"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"  # fixed value: the alphabet of base32

_FOUND = "file string, split long, at long, next long, leaves long, type string, record_id string, uri string, refers_to string, digest string, payload_bytes long, begin long, total long"


def base32_sha1(data: Column) -> Column:
    """Base32 of the SHA-1: five hex digits (20 bits) make four letters."""
    digest = F.sha1(data)
    letters = []
    for i in range(0, 40, 5):
        bits = F.conv(F.substring(digest, i + 1, 5), 16, 10).cast("int")
        letters += [F.substr(F.lit(BASE32), F.shiftright(bits, s).bitwiseAND(F.lit(31)) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*letters)


def write_archives(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", payload: str = "html", least_bytes: int = 0) -> None:
    """One record per row, in uncompressed WARC files under ``path`` (one file per task).

    Of rows with equal payloads of at least ``least_bytes`` bytes, that with the largest key is a ``response``, the others
    are ``revisit`` records that refer to it and hold no payload; all other rows are responses. A null payload is empty; a
    null key or address leaves its field empty; a row with a null key revisits one with a key. Repeated rows of the largest
    key are all responses. Payloads are moved only if the table of repeated payloads is too large to broadcast (Spark's own
    threshold, by its size as written).
    """
    body = F.coalesce(pages[payload].cast("string"), F.lit(""))
    rows = pages.select(pages[key].alias("key"), pages[url].cast("string").alias("url"), body.alias("body"), base32_sha1(body).alias("digest"))
    equal = rows.filter(F.octet_length("body") >= least_bytes).groupBy(F.col("digest").alias("of")).agg(F.max("key").alias("last"), F.count("*").alias("n"))
    repeated = written(equal.filter("n > 1 AND last IS NOT NULL").select("of", "last"), "warc-repeated")
    rows = rows.join(repeated, (F.col("digest") == F.col("of")) & (F.octet_length("body") >= least_bytes), "left")
    again = F.col("last").isNotNull() & ~F.col("key").eqNullSafe(F.col("last"))
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    # control characters would end the header field
    address = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\x00-\x20\x7F]", "%20")
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "), F.octet_length("body").cast("string"), F.lit(END + END)
    )
    block = F.concat(http, F.when(again, "").otherwise(F.col("body")))
    record = F.concat(
        F.lit(f"WARC/1.0{END}WARC-Type: "),
        F.when(again, "revisit").otherwise("response"),
        F.lit(f"{END}WARC-Record-ID: "),
        name(F.col("key")),
        F.lit(f"{END}WARC-Date: {DATE}{END}WARC-Target-URI: "),
        address,
        F.lit(f"{END}WARC-Payload-Digest: sha1:"),
        F.col("digest"),
        F.when(again, F.concat(F.lit(f"{END}WARC-Profile: {PROFILE}{END}WARC-Refers-To: "), name(F.col("last")))).otherwise(""),
        F.lit(f"{END}Content-Type: application/http; msgtype=response{END}Content-Length: "),
        F.octet_length("block").cast("string"),
        F.lit(END + END),
        F.col("block"),
        F.lit("\r\n\r"),  # the line separator adds the last byte
    )
    rows.withColumn("block", block).select(record.alias("value")).write.option("lineSep", "\n").text(path)


def parse_header(chunk: bytes) -> tuple[dict[str, str], int, int] | None:
    """Fields, start of the block and its length, of what follows the magic; None if it isn't a record header."""
    end = chunk.find(b"\r\n\r\n")
    if end < 0 or chunk[:3] not in (b"0\r\n", b"1\r\n"):
        return None
    fields = {}
    for line in chunk[3:end].split(b"\r\n"):
        k, colon, v = line.partition(b":")
        if not colon:
            return None
        fields[k.decode("latin-1").strip().lower()] = v.decode("utf-8", "replace").strip()
    size = fields.get("content-length", "")
    if not (size.isascii() and size.isdigit()) or "warc-type" not in fields:
        return None
    return fields, end + 4, int(size)


def payload_of(block: bytes) -> tuple[bytes, str]:
    """The payload of a block (what follows an HTTP header, if there is one) and the header's Content-Length."""
    if not block.startswith(b"HTTP/"):
        return block, ""
    head, _, body = block.partition(b"\r\n\r\n")
    for line in head.split(b"\r\n"):
        k, _, v = line.partition(b":")
        if k.strip().lower() == b"content-length":
            return body, v.strip().decode("latin-1")
    return body, ""


def described(fields: dict[str, str], block: bytes) -> tuple[str, int]:
    """Digest and size of the full payload: of a revisit as its headers give them, else from the payload itself."""
    body, length = payload_of(block)
    if fields["warc-type"] == "revisit":
        return fields.get("warc-payload-digest", "").removeprefix("sha1:"), int(length) if length.isdigit() else 0
    return base64.b32encode(hashlib.sha1(body).digest()).decode(), len(body)


def _candidates(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a split in file order: its candidates with offsets relative to the split's first byte, and its length.

    ``leaves`` follows successors as long as they are candidates of the same split. A record whose block reaches past its
    piece (magic inside) has no digest yet.
    """
    names = [f.split()[0] for f in _FOUND.split(", ")]
    here, at, rows = None, 0, []

    def finish() -> pa.RecordBatch:
        leaves: dict[int, int] = {}
        for r in reversed(rows):
            leaves[r[2]] = r[4] = leaves.get(r[3], r[3])
        rows.append([*here, None, None, None, None, None, None, None, None, None, None, at])
        types = [pa.string(), *[pa.int64()] * 4, *[pa.string()] * 5, *[pa.int64()] * 3]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)

    for batch in batches:
        for part in slices(batch, "value"):
            for file, split, chunk in zip(*(c.to_pylist() for c in part.columns), strict=True):
                if here != (file, split):
                    if here:
                        yield finish()
                    here, at, rows = (file, split), 0, []
                upto = at + len(chunk) + len(CUT)
                if first := split == 0 and at == 0:  # the start of the file
                    at, chunk = len(MAGIC), chunk.removeprefix(MAGIC)
                if (not first or upto == len(MAGIC) + len(chunk) + len(CUT)) and (found := parse_header(chunk)):
                    fields, start, size = found
                    whole = start + size <= len(chunk)
                    digest, n = described(fields, chunk[start : start + size]) if whole else (None, None)
                    rows.append([file, split, at - len(MAGIC), at + start + size + 4, 0, fields["warc-type"], fields.get("warc-record-id"), fields.get("warc-target-uri"), fields.get("warc-refers-to"), digest, n, at + start, None])
                at = upto
    if here:
        yield finish()


def _on_chain(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of each split in order of offset: those that the chain from the split's entry passes through."""
    here, expected = None, None
    for batch in batches:
        take = []
        for file, split, at, next_, entry in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("file", "split", "at", "next", "entry")), strict=True):
            if here != (file, split):
                here, expected = (file, split), None
            on = entry or at == expected
            if on:
                expected = next_
            take.append(on)
        yield batch.filter(pa.array(take, pa.bool_()))


def _pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every piece with its place in its split; the cut before a piece belongs to it."""
    here, at = None, 0
    for batch in batches:
        for part in slices(batch, "value"):
            out = []
            for file, split, chunk in zip(*(c.to_pylist() for c in part.columns), strict=True):
                if here != (file, split):
                    here, at = (file, split), 0
                first = split == 0 and at == 0
                out.append((file, split, at - (0 if first else len(CUT)), chunk if first else CUT + chunk))
                at += len(chunk) + len(CUT)
            columns = list(zip(*out, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.binary()), strict=True)], names=["file", "split", "place", "bytes"])


def _assembled(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest and size of each record whose block was put together from its pieces; null where the file ends before it."""
    for batch in batches:
        out = []
        for file, at, kind, digest, size, pieces in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            block = b"".join(p["bytes"] for p in pieces)
            fields = {"warc-type": kind, "warc-payload-digest": digest or ""}
            out.append((file, at, *(described(fields, block) if len(block) == size else (None, None))))
        columns = list(zip(*out, strict=True)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.string(), pa.int64()), strict=True)], names=["file", "at", "digest2", "bytes2"])


def _raw(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.option("lineSep", CUT.decode()).text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.col("value").cast("binary").alias("value"))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """``file, offset, type, record_id, uri, refers_to, payload_digest, payload_bytes`` of every record under ``path``.

    Digest (base32 SHA-1) and size are of the full payload: computed from the bytes read, or for revisits as their headers
    give them. Files are split by Spark wherever it likes. Records after a broken length, and what only looks like a record,
    are left out; a record that the end of the file cuts short has a null digest. Only headers are kept between the steps;
    a payload that holds the magic is put together in a second reading of the splits it touches. A record is in memory once, as
    are the bytes of a split; a folder without records gives no rows.
    """
    found = written(map_arrow(_raw(spark, path), _candidates, _FOUND), "warc-candidates")
    splits = found.filter("total IS NOT NULL").select("file", "split", "total")
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)  # the splits of a file
    splits = written(splits.withColumn("base", F.coalesce(F.sum("total").over(before), F.lit(0))), "warc-splits")
    based = found.filter("total IS NULL").drop("total").join(splits.select("file", "split", "base"), ["file", "split"])
    based = written(based.withColumns({c: F.col(c) + F.col("base") for c in ("at", "next", "leaves", "begin")}).drop("base"), "warc-based")

    jump = based.select("file", "at", F.col("leaves").alias("to"))
    reached = splits.select("file").distinct().withColumn("at", F.lit(0).cast("long"))
    n = -1
    while True:
        reached = written(reached.unionByName(reached.join(jump, ["file", "at"]).select("file", F.col("to").alias("at"))).distinct(), "warc-reached")
        last, n = n, reached.count()
        if n == last:
            break
        further = jump.select("file", F.col("at").alias("to"), F.col("to").alias("beyond"))
        jump = written(jump.join(further, ["file", "to"], "left").select("file", "at", F.coalesce("beyond", "to").alias("to")), "warc-jump")
    entries = reached.withColumn("entry", F.lit(True))
    marked = based.join(entries, ["file", "at"], "left").withColumn("entry", F.coalesce("entry", F.lit(False)))
    ordered = marked.repartition("file", "split").sortWithinPartitions("file", "split", "at")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ordered.schema)
    kept = written(map_arrow(ordered, _on_chain, schema), "warc-records")

    parted = kept.filter("digest IS NULL").select("file", "at", "type", "begin", (F.col("next") - 4).alias("end"))
    if parted.limit(1).count():
        spans = splits.select("file", "split", "base", (F.col("base") + F.col("total")).alias("upto"))
        touched = written(parted.join(spans, "file").filter("base < end + 9 AND upto > begin").select("file", "split", "base", "at", "begin", "end"), "warc-parted")
        pieces = map_arrow(_raw(spark, path), _pieces, "file string, split long, place long, bytes binary").join(touched, ["file", "split"])
        low = F.greatest(F.col("begin") - F.col("base") - F.col("place"), F.lit(0))
        high = F.least(F.col("end") - F.col("base") - F.col("place"), F.octet_length("bytes").cast("long"))
        pieces = pieces.withColumns({"_low": low.cast("int"), "_high": high.cast("int")}).filter("_low < _high")
        piece = F.struct((F.col("base") + F.col("place")).alias("place"), F.substr("bytes", F.col("_low") + 1, F.col("_high") - F.col("_low")).alias("bytes"))
        blocks = pieces.groupBy("file", "at").agg(F.sort_array(F.collect_list(piece)).alias("pieces"))  # the bytes of one record
        sizes = parted.select("file", "at", "type", F.lit(None).cast("string").alias("digest"), (F.col("end") - F.col("begin")).alias("size"))
        whole = map_arrow(sizes.join(blocks, ["file", "at"]).select("file", "at", "type", "digest", "size", "pieces"), _assembled, "file string, at long, digest2 string, bytes2 long")
        kept = kept.join(written(whole, "warc-assembled"), ["file", "at"], "left")
        kept = kept.withColumns({"digest": F.coalesce("digest", "digest2"), "payload_bytes": F.coalesce("payload_bytes", "bytes2")})
    return kept.select("file", F.col("at").alias("offset"), "type", "record_id", "uri", "refers_to", F.col("digest").alias("payload_digest"), "payload_bytes")
