"""Writing web archives in deterministic shards, and reading them back.

Rows are put in order of their id, rows of one id by a hash of url and payload, and cut into
shards of about ``shard_bytes``: the bytes before each key are summed exactly (by range, then
within each range), so cuts depend on the rows alone, wherever ids lie, and the same table
gives the same files however it was partitioned. Each shard is one partition of the shuffle.
Its task writes one gzip member for each record and rolls to the next file when the compressed
size reaches ``roll_bytes``. Headers, record ids and digests are generated anew. Files are
written under temporary names, unique to each attempt; what attempts were successful is known
from a table of file facts, and only those are renamed and listed in the manifest, which is
renamed into place last. A lost executor's half-written files are never renamed, and the
temporary folder goes with the commit.

Of records with equal payloads of at least ``min_bytes``, that with the smallest id is a
response, the others are revisits of it. The choice is made on digests alone; its rows meet
their pages by sorting next to them in the shard, so pages are shuffled once.

Defined results: a null payload is empty. Rows without an id are never the one revisited
while another has an id, and come last. Rows alike in id and payload are records of their
own, of the same type, and stay in one shard if their urls are alike, too. A null url
becomes a urn of the row. Extra columns are ignored. Ids are any 64-bit integers.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from urllib.parse import quote

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grainmill.llm.arrow import bound_batches, release
from grainmill.runtime import delete_path, forget, scratch_path, settle

#: The first key of each shard, of 17 bytes, goes to the driver and is broadcast; shards grow beyond so many of them.
MOST_SHARDS = 1 << 17
#: Rows of a batch of whole payloads.
PAGE_ROWS = 500
#: Payload bytes a record counts for besides its own.
RECORD_OVERHEAD = 600
SHARD_BYTES, ROLL_BYTES = 32 << 20, 8 << 20
CHUNK = 1 << 16
#: Regenerated records carry one date, so that reruns give the same bytes.
DATE = "2000-01-01T00:00:00Z"
SOFTWARE = "grainmill"

FILE_FACTS = "name string, temporary string, bytes long, records long, sha256 string"
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, file string"


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(row_id, url: str, payload_digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{row_id} {url} {payload_digest}')}>"


def member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """A compressed record."""
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers), f"WARC-Block-Digest: sha1:{digest(block)}", f"Content-Length: {len(block)}"]
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    return squeeze.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + squeeze.flush()


def target_uri(url: str | None, row_id) -> str:
    return quote(url, safe="!#$%&'()*+,/:;=?@[]~") if url else f"urn:row:{row_id}"


def page_record(row_id, url: str | None, payload: bytes, first=None, first_url: str | None = None) -> bytes:
    """A response, or a revisit of ``first``, of which the http headers alone are kept."""
    own, uri = digest(payload), target_uri(url, row_id)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    headers = [("WARC-Type", "response" if first is None else "revisit"), ("WARC-Record-ID", record_id(row_id, uri, own)), ("WARC-Date", DATE), ("WARC-Target-URI", uri)]
    headers += [("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha1:{own}")]
    headers += [("Row-Id", str(row_id))] if row_id is not None else []
    if first is not None:
        other = target_uri(first_url, first)
        headers += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", record_id(first, other, own)),
            ("WARC-Refers-To-Target-URI", other), ("WARC-Refers-To-Date", DATE), ("Row-Refers-To", str(first)),
        ]
    return member(headers, http if first is not None else http + payload)


class Roller:
    """Files of one shard, written under temporary names."""

    def __init__(self, folder: str, shard: int, roll_bytes: int):
        self.files, self.folder = arrow_fs.FileSystem.from_uri(folder)
        self.files.create_dir(f"{self.folder}/_temporary", recursive=True)
        self.shard, self.roll_bytes, self.number, self.out, self.facts = shard, roll_bytes, 0, None, []

    def write(self, data: bytes) -> None:
        if self.out is None:
            self.name = f"shard-{self.shard:06d}-{self.number:05d}.warc.gz"
            self.temporary = f"_temporary/{self.name}.{uuid.uuid4().hex}"
            self.out, self.sha = self.files.open_output_stream(f"{self.folder}/{self.temporary}", compression=None), hashlib.sha256()
            self.size = self.records = 0
            info = f"software: {SOFTWARE}\r\nformat: WARC File Format 1.1\r\n".encode()
            self._put(member([("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id("info", self.name, "")), ("WARC-Date", DATE), ("WARC-Filename", self.name), ("Content-Type", "application/warc-fields")], info))
        self._put(data)
        self.records += 1
        if self.size >= self.roll_bytes:
            self.close()

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.sha.update(data)
        self.size += len(data)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.facts.append((self.name, self.temporary, self.size, self.records, self.sha.hexdigest()))
            self.out, self.number = None, self.number + 1


def write_shards(folder: str, roll_bytes: int):
    """The task: rows sorted by shard, id, digest and kind become files, and their facts come out."""

    def run(batches):
        roller, decided = None, None
        for batch in batches:
            for shard, row_id, own, kind, url, payload, first, first_url in zip(*(c.to_pylist() for c in batch.columns)):
                if kind == 0:
                    decided = (row_id, own, first, first_url)
                    continue
                if roller is None or roller.shard != shard:
                    if roller is not None:
                        roller.close()
                        yield from facts(roller)
                    roller = Roller(folder, shard, roll_bytes)
                is_revisit = decided is not None and decided[:2] == (row_id, own)
                roller.write(page_record(row_id, url, (payload or "").encode(), *(decided[2:] if is_revisit else ())))
            del batch
            release()
        if roller is not None:
            roller.close()
            yield from facts(roller)

    def facts(roller: Roller):
        if roller.facts:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*roller.facts)], names=[f.split()[0] for f in FILE_FACTS.split(", ")])

    return run


#: The parts of a record's place in the order: whether it has no id, its id, its tie. None is null, as pandas turns whole numbers with nulls into fractions.
PLACE = "id is null as none", "coalesce(id, 0) as at", "tie"


def packed(none: np.ndarray, at: np.ndarray, tie: np.ndarray) -> np.ndarray:
    """Keys of 17 bytes in the order of places."""
    out = np.zeros((len(at), 17), np.uint8)
    out[:, 0] = 1 + np.asarray(none, np.uint8)
    for start, column in ((1, at), (9, tie)):
        numbers = np.asarray(column, np.int64).view(np.uint64) ^ np.uint64(1 << 63)
        out[:, start : start + 8] = numbers.astype(">u8").view(np.uint8).reshape(-1, 8)
    return out.view("S17").ravel()


def shard_cuts(slim: DataFrame, shard_bytes: int) -> np.ndarray:
    """The first key of each shard but the first, in order. ``slim`` has ``id``, ``tie`` and ``n``, the bytes of a payload."""
    order = ["none", "at", "tie"]
    keys = slim.selectExpr(*PLACE, "n").groupBy(*order).agg(F.sum(F.col("n") + RECORD_OVERHEAD).alias("size"))
    ranged = settle(keys.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "ranges")
    parts = sorted((r.part, r.size) for r in ranged.groupBy("part").agg(F.sum("size").alias("size")).collect())  # a row for each partition
    total, bases = 0, []
    for part, size in parts:
        bases.append((part, total))
        total += size
    shard_bytes = max(shard_bytes, -(-total // MOST_SHARDS))
    before = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.withColumn("own", F.coalesce(F.sum("size").over(before), F.lit(0)))
    placed = placed.join(F.broadcast(slim.sparkSession.createDataFrame(bases, "part int, base long")), "part")
    shard = F.expr(f"(base + own) div {shard_bytes}").alias("shard")
    firsts = placed.select(shard, F.struct(*order).alias("key")).groupBy("shard").agg(F.min("key").alias("key"))
    found = firsts.select("key.*").toArrow()  # MOST_SHARDS rows at most
    forget(ranged)
    return np.sort(packed(*(found.column(c).to_numpy() for c in order)))[1:]


def shard_of(cuts: np.ndarray, spark: SparkSession):
    """A function of a place's parts that gives the row's shard."""
    shared = spark.sparkContext.broadcast(cuts)

    @F.pandas_udf("int")
    def of(none: pd.Series, at: pd.Series, tie: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(shared.value, packed(none, at, tie), side="right").astype(np.int32))

    return of


def write_archives(
    df: DataFrame, folder: str, min_bytes: int = 0, shard_bytes: int = SHARD_BYTES, roll_bytes: int = ROLL_BYTES,
    id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
) -> DataFrame:
    """Writes the archives of all rows to ``folder``; the manifest's rows ``name, bytes, records, sha256``."""
    spark = df.sparkSession
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), F.coalesce(F.col(payload_col), F.lit("")).alias("payload"))
    rows = rows.withColumn("own", F.sha1("payload")).withColumn("tie", F.xxhash64("own", "url"))
    slim = settle(rows.select("id", "url", "own", "tie", F.octet_length("payload").cast("long").alias("n")), "digests")
    named = F.when(F.col("id").isNotNull(), F.struct("id", "url"))
    firsts = slim.where(F.col("n") >= min_bytes).groupBy("own").agg(F.min(named).alias("first"), F.count(F.lit(1)).alias("c")).where("c > 1 and first is not null")
    firsts = settle(firsts.select("own", "first"), "firsts")
    again = slim.join(firsts, "own").where("id is null or id <> first.id").select("id", "own", "tie", "first").distinct()

    cuts = shard_cuts(slim, shard_bytes)
    none = lambda kind, *cols: [F.lit(kind).alias("kind"), *cols]
    pages = rows.select("id", "own", "tie", *none(1, F.col("url"), F.col("payload"), F.lit(None).cast("long").alias("first"), F.lit(None).cast("string").alias("first_url")))
    choices = again.select("id", "own", "tie", *none(0, F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("payload"), F.col("first.id").alias("first"), F.col("first.url").alias("first_url")))
    bound_batches(spark)
    records = pages.unionByName(choices).withColumn("shard", shard_of(cuts, spark)(F.col("id").isNull(), F.coalesce("id", F.lit(0).cast("long")), F.col("tie")))
    dealt = records.repartitionById(len(cuts) + 1, F.col("shard")).sortWithinPartitions("shard", F.asc_nulls_last("id"), "tie", "own", "kind", "url")
    dealt = dealt.select("shard", "id", "own", "kind", "url", "payload", "first", "first_url")
    facts = settle(dealt.mapInArrow(write_shards(folder, roll_bytes), FILE_FACTS), "file-facts", PAGE_ROWS)
    forget(slim, firsts)
    commit(spark, folder, [r.asDict() for r in facts.collect()])  # a row for each file
    return facts.select("name", "bytes", "records", "sha256")


def commit(spark: SparkSession, folder: str, facts: list[dict]) -> None:
    """Renames the files of the successful attempts, then the manifest."""
    path = lambda *p: spark._jvm.org.apache.hadoop.fs.Path("/".join([folder, *p]))
    files = path().getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path("_temporary"))
    for f in facts:
        if not files.rename(path(f["temporary"]), path(f["name"])):
            raise OSError(f"{f['temporary']} can't be renamed to {f['name']}")
    manifest = [{k: f[k] for k in ("name", "bytes", "records", "sha256")} for f in sorted(facts, key=lambda f: f["name"])]
    out = files.create(path("_temporary", "manifest.json"), True)
    out.write(bytearray(json.dumps({"files": manifest}, indent=1).encode()))
    out.close()
    if not files.rename(path("_temporary", "manifest.json"), path("manifest.json")):
        raise OSError(f"{folder} has a manifest already")
    delete_path(spark, f"{folder}/_temporary")


def members(data) -> iter:
    """The decompressed records of a file, one at a time."""
    view, pos = memoryview(data), 0
    while pos < len(view):
        unzip, parts = zlib.decompressobj(31), []
        while not unzip.eof:
            piece = view[pos : pos + CHUNK]
            if not len(piece):
                raise ValueError("archive ends inside a record")
            parts.append(unzip.decompress(piece))
            pos += len(piece)
        pos -= len(unzip.unused_data)
        yield b"".join(parts)


def parsed(record: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of a record, whose block digest must hold."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    headers = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[: int(headers["Content-Length"])]
    if lines[0] != "WARC/1.1" or headers["WARC-Block-Digest"] != f"sha1:{digest(block)}":
        raise ValueError(f"record {headers.get('WARC-Record-ID')} is damaged")
    return headers, block


def page_facts(headers: dict[str, str], block: bytes) -> tuple:
    """The facts of a response or revisit; a response's payload must have its digest."""
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(next(x for x in http.split(b"\r\n") if x.startswith(b"Content-Length: "))[16:])
    own, kind = headers["WARC-Payload-Digest"].removeprefix("sha1:"), headers["WARC-Type"]
    if kind == "response" and (len(payload) != length or digest(payload) != own):
        raise ValueError(f"payload of {headers['WARC-Record-ID']} is damaged")
    number = lambda k: int(headers[k]) if k in headers else None
    return number("Row-Id"), length, own, kind, number("Row-Refers-To")


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """A row for each page record of a committed folder. A task holds one file's bytes at a time."""
    listed = spark.read.option("multiLine", True).schema("files array<struct<name string, records long>>").json(f"{folder}/manifest.json")
    names = listed.select(F.explode_outer("files").alias("f")).select("f.name")
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder)
    found = found.select(F.element_at(F.split("path", "/"), -1).alias("name"), "content").join(names, "name", "left_semi")

    def run(batches):
        for batch in batches:
            for name, content in zip(batch.column("name"), batch.column("content")):
                rows = [(*page_facts(*p), name.as_py()) for r in members(content.as_buffer()) if (p := parsed(r))[0]["WARC-Type"] != "warcinfo"]
                if rows:
                    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=[f.split()[0] for f in RECORDS.split(", ")])

    return found.mapInArrow(run, RECORDS)


def round_trip(df: DataFrame, **options) -> DataFrame:
    """Writes archives of all rows to a new shared folder and reads them back."""
    spark = df.sparkSession
    folder = scratch_path(spark, "warc")
    write_archives(df, folder, **options)
    return read_archives(spark, folder)
