"""WARC archives: write, normalise a monolithic gzip file to one member per record, read by offset.

A monolithic archive is one gzip stream and can only be read from its start. The normaliser
inflates it once, as a stream, writes every record as a gzip member of its own, and puts a sidecar
index beside it: one JSON line per record with offset and length of its member. Afterwards any
record, or any share of an archive, can be read alone.

Tasks write files below a folder that all executors reach. A file is written under a name of the
attempt and then renamed, so a repeated task replaces whole files by equal ones.

A null payload is empty. Records of equal payloads of at least ``least`` bytes: that of the smallest
page id is the response, the others revisit it; rows that share the smallest id are all responses,
and a null id counts as the largest. Repeated rows give a record each. An empty table gives no
archive and an empty result. Only the named columns are read, so other columns may have any name.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F

from ..operators.joins import fits_broadcast, lookup_join
from ..sources.scratch import scratch_folder
from .batches import bounded

LEAST_BYTES = 100
ARCHIVE_BYTES = 32 << 20
PIECE = 1 << 20
VERSION = b"WARC/1.1\r\n"
LEVEL = 6


def _resolved(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")


class _Output:
    """A file that appears under its name only when it is complete."""

    def __init__(self, uri: str):
        self.system, self.path = _resolved(uri)
        self.part = f"{self.path}.{uuid.uuid4().hex}.part"
        self.stream = self.system.open_output_stream(self.part, compression=None)

    def write(self, data: bytes) -> None:
        self.stream.write(data)

    def finish(self) -> None:
        self.stream.close()
        self.system.move(self.part, self.path)


def record(fields: dict[str, str], body: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in fields.items())
    return VERSION + head.encode() + b"Content-Length: %d\r\n\r\n" % len(body) + body + b"\r\n\r\n"


def page_record(row) -> bytes:
    """A response holds its payload; a revisit holds none, but digest and size of the full one."""
    payload = row.html.encode("utf-8", "surrogatepass")
    fields = {"WARC-Type": "response" if row.response else "revisit"}
    if row.page is not None:
        fields["WARC-Record-ID"] = f"<urn:page:{row.page}>"
    if row.url is not None:
        fields["WARC-Target-URI"] = " ".join(row.url.split())
    fields["WARC-Payload-Digest"] = f"sha256:{row.digest}"
    fields["WARC-Payload-Length"] = str(len(payload))
    if not row.response:
        fields["WARC-Refers-To"] = f"<urn:page:{row.refers_to}>"
        return record(fields, b"")
    return record(fields, payload)


def _write_monoliths(rows: Iterator[pd.DataFrame], folder: str, most: int) -> Iterator[pd.DataFrame]:
    """Rows of one task to archives of about ``most`` bytes of records each."""
    out, packer, held, done = None, None, 0, []

    def close():
        out.write(packer.flush())
        out.finish()

    for batch in rows:
        for row in batch.itertuples(index=False):
            if out is None:
                name = f"{folder}/{uuid.uuid4().hex}.warc.gz"
                out, packer, held = _Output(name), zlib.compressobj(LEVEL, zlib.DEFLATED, 31), 0
                done.append(name)
            data = page_record(row)
            out.write(packer.compress(data))
            held += len(data)
            if held >= most:
                close()
                out = None
    if out is not None:
        close()
    yield pd.DataFrame({"archive": pd.Series(done, dtype=object)})


def with_types(pages: DataFrame, page_id: str, url: str | None, html: str, least: int) -> DataFrame:
    """``(page, url, html, digest, response, refers_to)``.

    Only digests of payloads that occur more than once are joined back to the pages; they are
    broadcast if they are few, and otherwise the pages are spread over salts.
    """
    body = F.coalesce(F.col(html).cast("string"), F.lit(""))
    rows = pages.select(
        F.col(page_id).alias("page"),
        (F.col(url) if url else F.lit(None)).cast("string").alias("url"),
        body.alias("html"),
        F.sha2(body, 256).alias("digest"),
    )
    long = rows.where(F.octet_length("html") >= least)
    copied = (
        long.groupBy("digest").agg(F.min("page").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1").select(F.col("digest").alias("copied"), "first")
    )
    same = (F.col("digest"), F.col("copied"))
    joined = lookup_join(rows, copied, *same, small=fits_broadcast(copied))
    response = F.col("first").isNull() | F.coalesce(F.col("page") == F.col("first"), F.lit(False))
    return joined.select(
        F.col("page").cast("string").alias("page"), "url", "html", "digest",
        response.alias("response"),
        F.when(~response, F.col("first")).cast("string").alias("refers_to"),
    )


def write_archives(
    pages: DataFrame,
    folder: str,
    page_id: str = "page_id",
    url: str | None = "url",
    html: str = "html",
    least: int = LEAST_BYTES,
    archive_bytes: int = ARCHIVE_BYTES,
) -> None:
    """Write monolithic archives, and a list of them, below ``folder``."""
    bounded(pages.sparkSession)
    system, path = _resolved(folder)
    system.create_dir(f"{path}/monolithic", recursive=True)
    rows = with_types(pages, page_id, url, html, least)
    names = rows.mapInPandas(
        lambda it: _write_monoliths(it, f"{folder}/monolithic", archive_bytes), "archive string"
    )
    names.write.mode("overwrite").parquet(f"{folder}/monolithic-list")


def members(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """The records of a stream of inflated bytes, one after the other; memory holds one record."""
    held, at = bytearray(), 0

    def more() -> bool:
        nonlocal at
        piece = next(pieces, None)
        if piece is None:
            return False
        del held[:at]
        at = 0
        held.extend(piece)
        return True

    while True:
        while (end := held.find(b"\r\n\r\n", at)) < 0:
            if not more():
                if held[at:].strip():
                    raise ValueError("the archive ends inside a record's head")
                return
        if not held.startswith(b"WARC/", at):
            raise ValueError("no record begins where one is due")
        size = int(next(
            line.split(b":", 1)[1]
            for line in bytes(held[at:end]).split(b"\r\n")
            if line.lower().startswith(b"content-length:")
        ))
        whole = end - at + 4 + size + 4
        while len(held) - at < whole:
            if not more():
                raise ValueError("the archive ends inside a record")
        yield bytes(held[at : at + whole])
        at += whole


def _inflated(stream) -> Iterator[bytes]:
    """Bytes of a gzip file of one or more members, piece by piece."""
    unpacker, data = zlib.decompressobj(31), b""
    while data or (data := stream.read(PIECE)):
        out = unpacker.decompress(data, PIECE)
        data = unpacker.unconsumed_tail
        if out:
            yield out
        if unpacker.eof:
            data, unpacker = unpacker.unused_data, zlib.decompressobj(31)
    if rest := unpacker.flush():
        yield rest


def _normalise(rows: Iterator[pd.DataFrame], folder: str) -> Iterator[pd.DataFrame]:
    for batch in rows:
        done = []
        for archive in batch["archive"]:
            name = f"{folder}/{archive.rsplit('/', 1)[1]}"
            system, path = _resolved(archive)
            out, index, offset = _Output(name), _Output(f"{name}.idx"), 0
            with system.open_input_stream(path, compression=None) as stream:
                for data in members(_inflated(stream)):
                    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                    member = packer.compress(data) + packer.flush()
                    out.write(member)
                    entry = {"archive": name, "offset": offset, "length": len(member)}
                    index.write(json.dumps(entry).encode() + b"\n")
                    offset += len(member)
            out.finish()
            index.finish()
            done.append(name)
        yield pd.DataFrame({"archive": pd.Series(done, dtype=object)})


def normalise(folder: str, spark) -> None:
    """Rewrite every archive below ``folder/monolithic`` with a member per record and an index."""
    system, path = _resolved(folder)
    system.create_dir(f"{path}/records", recursive=True)
    names = spark.read.schema("archive string").parquet(f"{folder}/monolithic-list")
    # An archive is the least that a task can take; they are dealt evenly.
    names = names.repartition(max(1, names.count()))
    done = names.mapInPandas(lambda it: _normalise(it, f"{folder}/records"), "archive string")
    done.write.mode("overwrite").parquet(f"{folder}/records-list")


def parsed(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = {}
    for line in head.decode().split("\r\n")[1:]:
        key, _, value = line.partition(":")
        fields[key.lower()] = value.strip()
    return fields, rest[: int(fields["content-length"])]


def _page(value: str | None) -> int | None:
    return int(value.removeprefix("<urn:page:").rstrip(">")) if value else None


def _read_members(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    name, file = None, None
    for batch in rows:
        found = []
        for archive, offset, length in batch.itertuples(index=False):
            if archive != name:
                if file is not None:
                    file.close()
                system, path = _resolved(archive)
                name, file = archive, system.open_input_file(path)
            fields, payload = parsed(zlib.decompress(file.read_at(length, offset), 31))
            digest = fields["warc-payload-digest"].removeprefix("sha256:")
            size = int(fields["warc-payload-length"])
            if fields["warc-type"] == "response":
                if len(payload) != size or hashlib.sha256(payload).hexdigest() != digest:
                    raise ValueError(f"{archive}, {offset}: the payload is not what was written")
            found.append((
                _page(fields.get("warc-record-id")), size, digest, fields["warc-type"],
                _page(fields.get("warc-refers-to")),
            ))
        frame = pd.DataFrame(found, columns=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])
        yield frame.astype({"page_id": "Int64", "refers_to": "Int64"})
    if file is not None:
        file.close()


READ = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def read_archives(folder: str, spark) -> DataFrame:
    """Every record, found through the sidecar indexes; payloads are checked against digests."""
    entries = spark.read.schema("archive string, offset bigint, length bigint").json(
        f"{folder}/records/*.idx"
    )
    return entries.mapInPandas(_read_members, READ)


def round_trip(pages: DataFrame, folder: str, **options) -> DataFrame:
    spark = pages.sparkSession
    write_archives(pages, folder, **options)
    normalise(folder, spark)
    if not spark.read.parquet(f"{folder}/records-list").count():
        return spark.createDataFrame([], READ)
    return read_archives(folder, spark)


def op10_warc(spark, sf_dir: str) -> DataFrame:
    return round_trip(spark.read.parquet(f"{sf_dir}/pages.parquet"), scratch_folder(spark, "warc"))


OP10_SQL = f"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS d FROM pages
), f AS (SELECT d, min(page_id) AS first FROM p WHERE n >= {LEAST_BYTES} GROUP BY d HAVING count(*) > 1)
SELECT page_id, n::BIGINT AS payload_bytes, d AS payload_digest,
  CASE WHEN first IS NULL OR coalesce(page_id = first, false) THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first IS NULL OR coalesce(page_id = first, false) THEN NULL ELSE first END AS refers_to
FROM p LEFT JOIN f USING (d)
"""
