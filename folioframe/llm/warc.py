"""WARC archives: writing, normalising monolithic gzip files, and reading by a sidecar index.

Archives arrive as one gzip stream over many records, which can only be read from its start. The normaliser inflates
such a stream once, rewrites every record as a gzip member of its own, and writes a sidecar of offsets, so that readers
seek to single records and large files can be split among tasks.

Files are written straight to the shared folder through Arrow's filesystems, each task under a fresh name; what a lost
attempt leaves is never listed, since only names that came back as rows are read.
"""

from __future__ import annotations

import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh_path, stored

#: Payloads of at least so many bytes are written once; later equal ones revisit.
LEAST_BYTES = 1000
#: Payload bytes after which a task begins the next archive, and records of an index entry.
ARCHIVE_BYTES, SPAN = 64 << 20, 256
#: Payload bytes that a reader gathers before it hands them on.
BATCH_BYTES = 16 << 20
LEVEL = 1
DATE = "2024-01-01T00:00:00Z"
_CHUNK = 1 << 20


def open_filesystem(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """Arrow's filesystem and path of a URI; ``file:/a`` and ``/a`` count as local, and Hadoop's names of S3 as S3."""
    if uri.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return pyarrow.fs.LocalFileSystem(), uri
    scheme, rest = uri.split("://", 1)
    try:
        return pyarrow.fs.FileSystem.from_uri(f"{'s3' if scheme in ('s3a', 's3n') else scheme}://{rest}")
    except (pa.ArrowInvalid, OSError) as e:
        raise ValueError(f"archives can't be written to {uri}: Arrow has no file system for {scheme} here; set spark.checkpoint.dir to one of file, hdfs, s3a, gs, abfs") from e


def record(fields: dict[str, str], payload: bytes) -> bytes:
    """A WARC/1.1 record. Line breaks in values would end a header, so they become spaces."""
    lines = [f"{k}: {' '.join(str(v).split())}" for k, v in fields.items()]
    return "\r\n".join(["WARC/1.1", *lines, f"Content-Length: {len(payload)}", "", ""]).encode("utf-8", "surrogatepass") + payload + b"\r\n\r\n"


def parse(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Headers, payload and end of the record at ``at``."""
    head_end = data.index(b"\r\n\r\n", at)
    lines = data[at:head_end].decode("utf-8", "surrogatepass").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record at byte {at}")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    begin = head_end + 4
    end = begin + int(fields["Content-Length"])
    if data[end : end + 4] != b"\r\n\r\n":
        raise ValueError(f"the record at byte {at} is cut or longer than it says")
    return fields, data[begin:end], end + 4


def records_of_stream(source) -> Iterator[bytes]:
    """The raw records of a gzip file of any number of members, in memory no larger than one record and a chunk.

    A file that ends inside a record or inside a member (before its checksum) is an error.
    """
    inflate, held = zlib.decompressobj(31), bytearray()
    need, inside = None, False
    while True:
        chunk = source.read(_CHUNK)
        if not chunk:
            break
        while chunk:
            held += inflate.decompress(chunk)
            chunk, inside = inflate.unused_data, not inflate.eof
            if inflate.eof:
                inflate = zlib.decompressobj(31)
            at = 0
            while True:
                if need is None:
                    stop = held.find(b"\r\n\r\n", at)
                    if stop < 0:
                        break
                    length = next(int(x[15:]) for x in bytes(held[at:stop]).split(b"\r\n") if x.lower().startswith(b"content-length:"))
                    need = stop + 4 - at + length + 4
                if len(held) - at < need:
                    break
                yield bytes(held[at : at + need])
                at, need = at + need, None
            del held[:at]
    if held or inside:
        raise ValueError("the archive ends inside a record" if held else "the archive is cut: its gzip stream has no end")


def normalise(source, sink, level: int = LEVEL) -> list[tuple[int, int]]:
    """Rewrite a gzip stream of records with a member for each; returns (offset, length) of each member."""
    index, at = [], 0
    for raw in records_of_stream(source):
        deflate = zlib.compressobj(level, zlib.DEFLATED, 31)
        member = deflate.compress(raw) + deflate.flush()
        sink.write(member)
        index.append((at, len(member)))
        at += len(member)
    return index


def _sidecar(index: list[tuple[int, int]]) -> bytes:
    return b"".join(b"%d\t%d\n" % x for x in index)


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = LEAST_BYTES, archive_bytes: int = ARCHIVE_BYTES, level: int = LEVEL) -> DataFrame:
    """Write a record for every page into monolithic gzip archives; returns (path, records) of each archive.

    Of pages with equal payloads (UTF-8 of the html; null: empty) of at least ``least`` bytes, that with the largest
    id is written as response, the others as revisits without payload. Of repeated rows with that id, one may be any.
    A null url is left out; a null id is written as such and never answers for others.
    """
    html = F.coalesce(pages[html_col].cast("string"), F.lit(""))
    rows = pages.select(pages[id_col].cast("long").alias("_id"), pages[url_col].cast("string").alias("_url"), html.alias("_html"))
    rows = rows.withColumns({"_bytes": F.octet_length("_html").cast("long"), "_sha": F.sha1(F.encode("_html", "UTF-8"))})
    keys = stored(rows.where(F.col("_bytes") >= least).select("_id", "_sha"), "warc-digests")
    chosen = keys.groupBy("_sha").agg(F.max("_id").alias("_to"), F.count("*").alias("_n")).where("_n > 1 and _to is not null")
    # Only pages that revisit are joined: an equi-join of ids and digests, whose rows hold no payload.
    revisits = keys.join(chosen, "_sha").where("_id <> _to or _id is null").select(F.col("_id").alias("_rid"), F.col("_sha").alias("_rsha"), "_to").distinct()
    rows = rows.join(revisits, F.col("_id").eqNullSafe(F.col("_rid")) & (F.col("_sha") == F.col("_rsha")), "left")
    rows = rows.select("_id", "_url", "_sha", "_bytes", F.when(F.col("_to").isNull(), F.col("_html")).alias("_body"), "_to")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_filesystem(folder)
        fs.create_dir(root, recursive=True)
        out, held, n = None, 0, 0

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal out, held, n
            if out is not None:
                out[2].write(out[1].flush())
                out[2].close()
                yield pa.RecordBatch.from_pydict({"path": [out[0]], "records": [n]})
            out, held, n = None, 0, 0

        for b in batches:
            for page, url, sha, size, body, to in zip(*(b.column(c).to_pylist() for c in range(6)), strict=True):
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    out = (name, zlib.compressobj(level, zlib.DEFLATED, 31), fs.open_output_stream(f"{root}/{name}", compression=None))
                fields = {"WARC-Type": "response" if to is None else "revisit", "WARC-Record-ID": f"<urn:page:{page}>", "WARC-Date": DATE, "WARC-Payload-Digest": f"sha1:{sha}", "X-Payload-Bytes": str(size)}
                if page is not None:
                    fields["X-Page-Id"] = str(page)
                if url:
                    fields["WARC-Target-URI"] = url
                if to is not None:
                    fields["WARC-Refers-To"] = f"<urn:page:{to}>"
                    fields["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
                raw = record(fields, (body or "").encode("utf-8", "surrogatepass"))
                out[2].write(out[1].compress(raw))
                held, n = held + len(raw), n + 1
                if held >= archive_bytes:
                    yield from close()
        yield from close()

    return rows.mapInArrow(run, "path string, records long")


def normalise_archives(archives: DataFrame, source: str, target: str, level: int = LEVEL, span: int = SPAN) -> DataFrame:
    """Normalise each archive of ``archives`` (path, records); returns (path, from, bytes, records), a row for each span of members.

    An archive that doesn't hold as many records as its writer counted is an error; a null count isn't checked. Beside every archive stands its sidecar ``<path>.idx``: offset and length of each member, a line each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_filesystem(source)
        to_fs, to = open_filesystem(target)
        to_fs.create_dir(to, recursive=True)
        for b in batches:
            for path, records in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                name = f"{uuid.uuid4().hex}.warc.gz"
                with fs.open_input_stream(f"{root}/{path}", compression=None) as f, to_fs.open_output_stream(f"{to}/{name}", compression=None) as g:
                    index = normalise(f, g, level)
                if records is not None and len(index) != records:
                    raise ValueError(f"{path}: {len(index)} records where its writer counted {records}")
                with to_fs.open_output_stream(f"{to}/{name}.idx") as g:
                    g.write(_sidecar(index))
                spans = [index[i : i + span] for i in range(0, len(index), span)]
                yield pa.RecordBatch.from_pydict({"path": pa.array([name] * len(spans), pa.string()), "from": pa.array([s[0][0] for s in spans], pa.int64()), "bytes": pa.array([s[-1][0] + s[-1][1] - s[0][0] for s in spans], pa.int64()), "records": pa.array([len(s) for s in spans], pa.int64())})

    return archives.select("path", "records").mapInArrow(run, "path string, from long, bytes long, records long")


def read_archives(spans: DataFrame, folder: str) -> DataFrame:
    """The records of the spans: page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload.

    Digest and size of a response are computed from its payload and held against its header; those of a revisit, whose
    payload isn't there, are its header's.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_filesystem(folder)
        for b in batches:
            for path, start, size, n in zip(*(b.column(c).to_pylist() for c in range(4)), strict=True):
                with fs.open_input_file(f"{root}/{path}") as f:
                    raw = f.read_at(size, start)
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())
                names = ("page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload")
                batch = lambda rows, kinds=kinds, names=names: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
                out: list[tuple] = []
                got, held = 0, 0
                for data in records_of_stream(io.BytesIO(raw)):
                    h, payload, _ = parse(data)
                    sha, length = h["WARC-Payload-Digest"].removeprefix("sha1:"), int(h["X-Payload-Bytes"])
                    if h["WARC-Type"] == "response" and (len(payload), hashlib.sha1(payload).hexdigest()) != (length, sha):
                        raise ValueError(f"{path}: a payload isn't what its header says")
                    to = h.get("WARC-Refers-To")
                    out.append((int(h["X-Page-Id"]) if "X-Page-Id" in h else None, h.get("WARC-Target-URI"), length, sha, h["WARC-Type"], int(to.removeprefix("<urn:page:")[:-1]) if to else None, payload if to is None else None))
                    got, held = got + 1, held + len(payload)
                    if held > BATCH_BYTES:
                        yield batch(out)
                        out, held = [], 0
                if got != n:
                    raise ValueError(f"{path}: {got} records where the index has {n}")
                if out:
                    yield batch(out)

    return spans.mapInArrow(run, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary")


def round_trip(pages: DataFrame, **columns) -> DataFrame:
    """Write all pages, normalise the archives, and read every record back (see :func:`write_archives` and :func:`read_archives`)."""
    spark: SparkSession = pages.sparkSession
    raw, clean = fresh_path(spark, "warc-raw"), fresh_path(spark, "warc")
    archives = stored(write_archives(pages, raw, **columns), "warc-archives")
    # As many tasks as the session shuffles into at most; each takes several archives then.
    n = max(1, min(archives.count(), int(spark.conf.get("spark.sql.shuffle.partitions"))))
    spans = stored(normalise_archives(archives.repartition(n), raw, clean), "warc-index")
    fs, root = open_filesystem(raw)
    if fs.get_file_info(root).type != pyarrow.fs.FileType.NotFound:
        fs.delete_dir(root)
    return read_archives(spans, clean)
