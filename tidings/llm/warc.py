"""Writing pages as WARC archives, sharded and the same on every run.

Records are put into shards by ranges of their place: id, digest, a hash of the
url, then a number that spreads rows repeating all three. The bounds are cut where the running
sum of bytes in this order reaches a multiple of ``shard_bytes``, so they follow
from the data alone, outlying or repeated ids do not fill a shard, and there are
as many shards as the bytes need. Bounds are 22 bytes a shard, a millionth
of the markup, and are all that passes through the driver. Which records
revisit which is decided on ids and digests alone; the markup is shuffled once,
to its shard, where a mark that sorts before a record names the one it revisits.
Within a shard records are sorted, each is a gzip member of its own, and a file
is closed once it has reached ``roll_bytes`` compressed. All headers and digests are made
anew. A file is written under a temporary name and then renamed to a name that
follows from shard and part, so a repeated task leaves the same file; the
manifest (one row a file) is a table that Spark commits when all tasks are done, and
readers take the files from it alone.

Of records with equal payloads of at least ``least`` bytes, the one with the
smallest id is a response and the others revisit it.

Defined cases: a null html is an empty payload; a null id sorts first and is
written without the id's header; rows that repeat id and payload are written
each, as what that id is; a very long html is one record and may exceed the
shard's size; other columns are not touched; control characters and blanks in a url are escaped;
a null url is left out; an empty table gives no files. The shared folder must
be one that Arrow's file systems can open (file, hdfs, s3, gs).
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidings.llm.common import NO_ID, digest_of, id_of, key_of
from tidings.session import work_path, written

LEAST = 100
ROLL_BYTES = 32_000_000
SHARD_BYTES = 24_000_000
DATE = "2020-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FILES = "file string, shard int, part int, records long, bytes long, sha256 string, first_key long, last_key long"
FOUND = ("page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, "
         "refers_to long, intact boolean")


def opened(root: str) -> tuple[fs.FileSystem, str]:
    """The file system and the path below it that a Spark path means."""
    if root.startswith("file:"):
        return fs.LocalFileSystem(), "/" + root[5:].lstrip("/")
    if "://" not in root:
        return fs.LocalFileSystem(), root
    return fs.FileSystem.from_uri(root)


def _name(kind: str, key: int, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{kind}/{key}/{digest}')}>"


def _head(fields: list[tuple[str, object]]) -> bytes:
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None) + "\r\n").encode()


def record(key: int, url: str | None, payload: bytes, digest: str, size: int, winner: int | None) -> bytes:
    """One record. ``winner`` is the id it revisits, else None."""
    revisit = winner is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if revisit else http + payload
    fields = [("WARC-Type", "revisit" if revisit else "response"),
              ("WARC-Record-ID", _name("record", key, digest)),
              ("WARC-Date", DATE),
              ("WARC-Target-URI", None if url is None else quote(url, safe="!#$%&'()*+,/:;=?@[]~")),
              ("WARC-Profile", PROFILE if revisit else None),
              ("WARC-Refers-To", _name("record", winner, digest) if revisit else None),
              ("X-Refers-To-Page", winner if revisit and winner != NO_ID else None),
              ("X-Page", key if key != NO_ID else None),
              ("WARC-Payload-Digest", f"sha256:{digest}"),
              ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
              ("Content-Type", "application/http; msgtype=response"),
              ("Content-Length", len(block))]
    return _head(fields) + block + b"\r\n\r\n"


def _member(data: bytes) -> bytes:
    deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
    return deflate.compress(data) + deflate.flush()


class _Writer:
    """The files of one shard after another."""

    def __init__(self, root: str, roll_bytes: int):
        self.files, self.base = opened(root)
        self.roll, self.shard, self.part, self.out = roll_bytes, -1, 0, None

    def start(self, shard: int) -> None:
        self.part = self.part + 1 if shard == self.shard else 0
        self.shard, self.size, self.count, self.hash = shard, 0, 0, hashlib.sha256()
        self.file = f"part-{shard:07d}-{self.part:05d}.warc.gz"
        self.files.create_dir(f"{self.base}/_temporary", recursive=True)
        self.temporary = f"{self.base}/_temporary/{self.file}.{uuid.uuid4().hex}"
        self.out = self.files.open_output_stream(self.temporary, compression=None)
        info = b"software: tidings\r\nformat: WARC File Format 1.1\r\n"
        self.put(_member(_head([("WARC-Type", "warcinfo"), ("WARC-Record-ID", _name("info", shard, str(self.part))),
                                ("WARC-Date", DATE), ("WARC-Filename", self.file),
                                ("Content-Type", "application/warc-fields"), ("Content-Length", len(info))])
                         + info + b"\r\n\r\n"))

    def put(self, data: bytes) -> None:
        self.out.write(data)
        self.hash.update(data)
        self.size += len(data)

    def add(self, shard: int, key: int, data: bytes) -> Iterator[tuple]:
        if self.out is not None and (shard != self.shard or self.size >= self.roll):
            yield self.close()
        if self.out is None:
            self.start(shard)
            self.first = key
        self.put(_member(data))
        self.count, self.last = self.count + 1, key

    def close(self) -> tuple:
        self.out.close()
        self.out = None
        final = f"{self.base}/{self.file}"
        try:
            self.files.move(self.temporary, final)
        except OSError:
            # A store that does not replace: another attempt has left the same bytes.
            if self.files.get_file_info(final).size != self.size:
                raise
            self.files.delete_file(self.temporary)
        return self.file, self.shard, self.part, self.count, self.size, self.hash.hexdigest(), self.first, self.last


def _write(root: str, roll_bytes: int):
    names = [c.split()[0] for c in FILES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, rows, mark = _Writer(root, roll_bytes), [], (None,) * 4
        for batch in batches:
            columns = [batch.column(c) for c in ("shard", "key", "url", "html", "digest", "size", "winner")]
            for i in range(batch.num_rows):
                shard, key, url, html, digest, size, winner = (c[i].as_py() for c in columns)
                if winner is not None:
                    mark = shard, key, digest, winner
                    continue
                winner = mark[3] if mark[:3] == (shard, key, digest) else None
                rows += writer.add(shard, key, record(key, url, (html or "").encode(), digest.hex(), size, winner))
        if writer.out is not None:
            rows.append(writer.close())
        types = [pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=names)
    return run


def _place(spread: Column) -> Column:
    """Key, digest and ``spread`` (48 bits) as bytes that sort in this order."""
    digits = lambda c, n: F.unhex(F.lpad(F.hex(c), n, "0"))
    # NO_ID is the smallest long: with its bit turned, keys sort as unsigned numbers.
    return F.concat(digits(F.col("key").bitwiseXOR(F.lit(NO_ID)), 16), F.substring("digest", 1, 8), digits(spread, 12))


def _cuts(narrow: DataFrame, shard_bytes: int) -> np.ndarray:
    """The first place of every shard but the first, from (place, size)."""
    parts = written(narrow.select("place", (F.col("size") + 700).alias("bytes")).repartitionByRange("place")
                    .withColumn("part", F.spark_partition_id()), "places")
    before = parts.groupBy("part").agg(F.min("place").alias("least"), F.sum("bytes").alias("bytes")).select(
        "part", F.sum("bytes").over(Window.orderBy("least").rowsBetween(Window.unboundedPreceding, -1)).alias("before"))
    inside = F.sum("bytes").over(Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, -1))
    at = F.coalesce("before", F.lit(0)) + F.coalesce(F.col("inside"), F.lit(0))
    first = (parts.withColumn("inside", inside).join(before, "part")
             .groupBy(F.floor(at / shard_bytes).alias("shard")).agg(F.min("place").alias("place")).where("shard > 0"))
    return np.array(sorted({bytes(r.place) for r in first.select("place").collect()}), dtype="S22")


def write(pages: DataFrame, root: str, least: int = LEAST, roll_bytes: int = ROLL_BYTES, shard_bytes: int = SHARD_BYTES,
          id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write all pages below ``root`` and return the committed manifest."""
    payload = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(key_of(id_col).alias("key"), F.col(url_col).alias("url"), payload.alias("html"),
                        digest_of(html_col).alias("digest"), F.octet_length(payload).cast("long").alias("size"))
    spread = F.shiftleft(F.xxhash64("url").bitwiseAND(F.lit(2**32 - 1)), 16).bitwiseOR(
        F.xxhash64(F.monotonically_increasing_id()).bitwiseAND(F.lit(2**16 - 1)))
    rows = rows.withColumn("place", _place(spread))
    narrow = written(rows.select("key", "digest", "size", "place"), "payloads")
    cuts = _cuts(narrow, shard_bytes)

    @F.pandas_udf("int")
    def shard_of(place: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, np.array(place.tolist(), dtype="S22"), side="right"))

    first = narrow.where(F.col("size") >= least).groupBy("digest").agg(
        F.min("key").alias("winner"), F.count("*").alias("n")).where("n > 1").drop("n")
    # A text shared by many rows makes its digest hot: AQE splits this join.
    marks = narrow.select("key", "digest").join(first, "digest").where("winner <> key").distinct()
    # Rows that repeat id and digest may lie in several shards: each gets a mark.
    ends = [shard_of(_place(F.lit(spread))) for spread in (0, 2**48 - 1)]
    marks = marks.withColumns({"lo": ends[0], "hi": ends[1]}).select(
        F.explode(F.sequence("lo", "hi")).alias("shard"), "key", F.lit(None).cast("string").alias("url"),
        F.lit(None).cast("string").alias("html"), "digest", F.lit(0).cast("long").alias("size"), "winner")
    records = rows.select(shard_of("place").alias("shard"), "key", "url", "html", "digest", "size",
                          F.lit(None).cast("long").alias("winner"))
    # A null sorts last, so a mark comes before the records it is for.
    dealt = marks.unionByName(records).repartition(len(cuts) + 1, "shard").sortWithinPartitions(
        "shard", "key", "digest", F.asc_nulls_last("winner"), "url")
    spark = pages.sparkSession
    dealt.mapInArrow(_write(root, roll_bytes), FILES).write.parquet(f"{root}/_manifest")
    return spark.read.parquet(f"{root}/_manifest")


def members(stream, chunk: int = 1 << 20) -> Iterator[bytes]:
    """The gzip members of a stream, one at a time."""
    inflate, parts = zlib.decompressobj(31), []
    while data := stream.read(chunk):
        while data:
            parts.append(inflate.decompress(data))
            if not inflate.eof:
                break
            data = inflate.unused_data
            yield b"".join(parts)
            inflate, parts = zlib.decompressobj(31), []
    if any(parts):
        raise ValueError("the archive ends within a record")


def parse(data: bytes) -> tuple | None:
    """The row of a record, None for a warcinfo record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    if fields["WARC-Type"] == "warcinfo":
        return None
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(http.rsplit(b": ", 1)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    intact = fields["WARC-Block-Digest"] == f"sha256:{hashlib.sha256(block).hexdigest()}"
    number = lambda k: int(fields[k]) if k in fields else None
    if fields["WARC-Type"] == "response":
        intact &= len(payload) == size
        digest, found = hashlib.sha256(payload).hexdigest(), digest
        intact &= digest == found
    else:
        payload = None
    return (number("X-Page"), fields.get("WARC-Target-URI"), payload, size, digest, fields["WARC-Type"],
            number("X-Refers-To-Page"), intact)


def _read(root: str, with_payload: bool):
    names = [c.split()[0] for c in FOUND.split(", ")]
    types = [pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.bool_()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = opened(root)
        for batch in batches:
            for name in batch.column("file").to_pylist():
                rows, held = [], 0
                with files.open_input_stream(f"{base}/{name}", compression=None) as stream:
                    for data in members(stream):
                        row = parse(data)
                        if row is None:
                            continue
                        rows.append(row if with_payload else (*row[:2], None, *row[3:]))
                        held += len(data) if with_payload else 200
                        if held > 4_000_000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
    return run


def read(manifest: DataFrame, root: str, with_payload: bool = True) -> DataFrame:
    """The records of all files of the manifest."""
    files = manifest.select("file")
    return files.repartition(max(1, manifest.count())).mapInArrow(_read(root, with_payload), FOUND)


def round_trip(pages: DataFrame, **options) -> DataFrame:
    """Write the pages, read the archives back: one row per page."""
    root = work_path(pages.sparkSession, "warc")
    found = read(write(pages, root, **options), root, with_payload=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact")
