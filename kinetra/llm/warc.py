"""WARC archives of page records: a deterministic sharded writer, and a reader.

Records are range-sorted by page id and payload digest into shards of about equal payload, each shard rolls to a new file
once the compressed size passes a limit, headers and digests are made anew from the payload, and files
appear under their final names only when a manifest lists them.  The same rows give the same files.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import re
import uuid
import zlib

import numpy as np
import pandas as pd
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kinetra.llm.common import cut, join_counted, new_dir

#: Written into every record, so that equal input gives equal bytes.
DATE = "1970-01-01T00:00:00Z"
_END = b"\r\n\r\n"


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _urn(page_id: int | None, digest: str, nth: int = 0) -> str:
    """A record's name: its page and payload, and a number from the second record of both on."""
    return f"<urn:x-page:{'null' if page_id is None else page_id}:{digest}{f':{nth}' if nth else ''}>"


def _page_of(urn: str) -> int | None:
    name = urn[1:-1].split(":")[2]
    return None if name == "null" else int(name)


def _clean(value: str) -> str:
    """A header value without line breaks and other control characters, which are percent-coded."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: tuple | None, nth: int = 0) -> bytes:
    """One WARC/1.1 record: response with the payload, or revisit without it if refers_to is (page id,)."""
    digest = sha1_base32(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if refers_to else 'response'}", f"WARC-Record-ID: {_urn(page_id, digest, nth)}", f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {_clean(url or 'about:blank')}", f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{sha1_base32(block)}",
        *([f"WARC-Refers-To: {_urn(refers_to[0], digest)}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"] if refers_to else []),
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(head).encode() + _END + block + _END


def parse(data: bytes) -> dict:
    """Fields of one record; digests are checked against the bytes."""
    if not data.startswith(b"WARC/"):
        raise ValueError("damaged record: no header")
    head, _, rest = data.partition(_END)
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(_END)
    kind = fields["WARC-Type"]
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if "sha1:" + sha1_base32(block) != fields["WARC-Block-Digest"] or kind == "response" and sha1_base32(payload) != digest:
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    length = int(re.search(rb"Content-Length: (\d+)", http)[1])
    refers = fields.get("WARC-Refers-To")
    return {"page_id": _page_of(fields["WARC-Record-ID"]), "url": fields["WARC-Target-URI"], "payload": payload if kind == "response" else None, "payload_bytes": length, "payload_digest": digest, "record_type": kind, "refers_to": _page_of(refers) if refers else None}


#: Stands in for a null page id, which sorts first.
_NO_PAGE = -(1 << 62)


def shard_bounds(pages: DataFrame, shard_bytes: int, most_shards: int) -> list[tuple[int, str]]:
    """First page id and digest of each shard but the first, from exact running sums of payload in that order.

    Depends on the rows of pages (page_id, digest, size) alone, not on how Spark deals them out.  At most most_shards
    bounds come back.  Pages without an id, or with one and the same, are dealt by digest.
    """
    sized = pages.groupBy(F.coalesce("page_id", F.lit(_NO_PAGE)).alias("page_id"), "digest").agg(F.sum("size").alias("size"))
    sized = cut(sized.repartitionByRange("page_id", "digest").withColumn("part", F.spark_partition_id()), "sizes")
    sums = sized.groupBy("part").agg(F.sum("size").alias("total"))
    sums = sums.select("part", F.sum("total").over(Window.orderBy("part")).alias("up_to"), "total").select("part", (F.col("up_to") - F.col("total")).alias("before"))
    total = sized.agg(F.sum("size")).first()[0] or 0
    limit = max(shard_bytes, -(-total // most_shards))
    running = F.sum("size").over(Window.partitionBy("part").orderBy("page_id", "digest")) - F.col("size") + F.col("before")
    shards = sized.join(sums, "part").select(F.struct("page_id", "digest").alias("at"), F.floor(running / limit).alias("shard"))
    firsts = shards.groupBy("shard").agg(F.min("at").alias("first")).orderBy("first").collect()
    return [(r["first"]["page_id"], r["first"]["digest"]) for r in firsts[1:]]


def _shard_of(pages: np.ndarray, digests: list[str], bounds: list[tuple[int, str]], firsts: np.ndarray) -> np.ndarray:
    """The shard of each record, from its page id and digest; firsts are the bounds' page ids."""
    low, high = np.searchsorted(firsts, pages), np.searchsorted(firsts, pages, side="right")
    for i in np.flatnonzero(low < high).tolist():  # the page id is a bound's
        high[i] = bisect.bisect_right(bounds, (int(pages[i]), digests[i]), int(low[i]), int(high[i]))
    return high


def _even_keys(spark, n: int) -> np.ndarray:
    """n numbers that hash partitioning into n deals out one to each partition, as far as some are found."""
    tried = spark.range(int(n * (np.log(n) + 12))).select(F.col("id").cast("int").alias("key"))
    found = tried.groupBy(F.pmod(F.hash("key"), F.lit(n)).alias("part")).agg(F.min("key").alias("key")).collect()
    keys = np.arange(n, dtype=np.int32)
    for r in found:
        keys[r["part"]] = r["key"]
    return keys


def _write_shards(rows, folder: str, roll_bytes: int, level: int):
    """Rows in order of shard and page to files under temporary names; yields their manifest entries."""
    store, root = arrow_fs.FileSystem.from_uri(folder)
    attempt = uuid.uuid4().hex
    state: dict = {"out": None, "shard": None}
    done: list[dict] = []

    def close() -> None:
        if state["out"] is not None:
            state["out"].close()
            state["out"] = None
            done.append({"name": state["name"], "temporary": state["temporary"], "records": state["records"], "bytes": state["bytes"], "sha256": state["hash"].hexdigest()})

    def put(shard: int, data: bytes) -> None:
        if shard != state["shard"]:
            close()
            state.update(shard=shard, seq=0)
        if state["out"] is None:
            name = f"part-{shard:06d}-{state['seq']:05d}.warc.gz"
            temporary = f"_temporary/{attempt}-{name}"
            store.create_dir(f"{root}/_temporary", recursive=True)
            state.update(out=store.open_output_stream(f"{root}/{temporary}", compression=None), name=name, temporary=temporary, records=0, bytes=0, hash=hashlib.sha256(), seq=state["seq"] + 1)
        squeeze = zlib.compressobj(level, zlib.DEFLATED, 31)
        member = squeeze.compress(data) + squeeze.flush()
        state["out"].write(member)
        state["hash"].update(member)
        state["records"] += 1
        state["bytes"] += len(member)
        if state["bytes"] >= roll_bytes:
            close()

    refers, last, nth = None, None, 0
    for page, shard, digest, refers_to, is_ref, url, payload in rows:
        if (page, digest) != last:
            refers, last, nth = None, (page, digest), 0
        if is_ref:  # comes before the rows of its page and digest
            refers = (refers_to,)
            continue
        put(shard, record(page, url, payload, refers, nth))
        nth += 1
    close()
    return done


def write_archive(pages: DataFrame, folder: str, min_revisit_bytes: int = 0, shard_bytes: int = 8 << 20, most_shards: int = 100_000, roll_bytes: int = 64 << 20, level: int = 4) -> DataFrame:
    """Write one record per row of pages (page_id, url, html) under folder; returns the committed manifest.

    Payload is the html as UTF-8, null as empty.  Of rows with equal payloads of at least
    min_revisit_bytes, that with the largest page_id is a response and the others are revisits of it; rows
    that share that page_id too are all responses.  A null page_id counts as smaller than any and sorts
    first.  Rows of one page_id are ordered by digest and url, and those of one payload are numbered; an empty table
    gives an empty archive, and a payload of any length is one record.
    Payloads cross the network once, for the range sort.  Which rows are revisits is found on digests alone:
    counts of equal digests are aggregated before the exchange, the few that hold a large share of all pages are
    broadcast to their rows, and the marks join the page rows inside the sort.
    Files are written to _temporary under a name of the attempt, each record a gzip member of its own; the manifest holds
    only files of attempts that Spark committed, with the records, bytes and SHA-256 of the file as it lies in the
    store.  The files it names are moved before it is written; one that is neither in its old nor its new place whole is an
    error.  What lost attempts left goes with _temporary.
    """
    spark = pages.sparkSession
    payload = F.coalesce("html", F.lit("")).cast("binary")
    base = pages.select("page_id", "url", payload.alias("payload"), F.sha1(payload).alias("digest"), F.octet_length(payload).cast("long").alias("size"))
    narrow = cut(base.select("page_id", "digest", "size"), "digests")
    largest = narrow.filter(F.col("size") >= min_revisit_bytes).groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    distinct = narrow.select("page_id", "digest").distinct()
    revisits = join_counted(distinct, cut(largest, "largest"), "digest", "n", narrow.count()).filter(~F.col("page_id").eqNullSafe(F.col("refers_to")))
    bounds = shard_bounds(narrow, shard_bytes, most_shards)
    n = len(bounds) + 1
    given = spark.sparkContext.broadcast((bounds, np.array([b for b, _ in bounds], dtype=np.int64), _even_keys(spark, n)))

    @F.pandas_udf("int")
    def deal_of(ids: pd.Series, digests: pd.Series) -> pd.Series:
        bounds, firsts, keys = given.value
        return pd.Series(keys[_shard_of(ids.to_numpy(), digests.tolist(), bounds, firsts)])

    deal = deal_of(F.coalesce("page_id", F.lit(_NO_PAGE)), F.col("digest"))
    shape = ("page_id", "digest", "refers_to", "is_ref", "url", "payload")
    records = base.select("page_id", "digest", F.lit(None).cast("long").alias("refers_to"), F.lit(False).alias("is_ref"), "url", "payload")
    marks = revisits.select("page_id", "digest", "refers_to", F.lit(True).alias("is_ref"), F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"))
    dealt = records.unionByName(marks).select(*shape, deal.alias("deal")).repartition(n, "deal").drop("deal")
    dealt = dealt.sortWithinPartitions(F.col("page_id").asc_nulls_first(), "digest", F.desc("is_ref"), "url")

    def write(batches):
        def rows():
            for batch in batches:
                page = batch.column("page_id").to_pylist()
                ids = np.array([_NO_PAGE if p is None else p for p in page], dtype=np.int64)
                shard = _shard_of(ids, batch.column("digest").to_pylist(), *given.value[:2]).tolist()
                others = [batch.column(c).to_pylist() for c in shape[1:5]]
                blob = batch.column("payload")
                for i, p in enumerate(page):
                    yield (p, shard[i], *(o[i] for o in others), blob[i].as_py())

        import pyarrow as pa

        done = _write_shards(rows(), folder, roll_bytes, level)
        if done:
            yield pa.RecordBatch.from_pylist(done)

    written = cut(dealt.mapInArrow(write, "name string, temporary string, records long, bytes long, sha256 string"), "written")

    def commit(batches):
        store, root = arrow_fs.FileSystem.from_uri(folder)
        for b in batches:
            for temporary, name, size in zip(b["temporary"], b["name"], b["bytes"], strict=True):
                if store.get_file_info(f"{root}/{temporary}").type != arrow_fs.FileType.NotFound:
                    store.move(f"{root}/{temporary}", f"{root}/{name}")
                if (there := store.get_file_info(f"{root}/{name}")).size != size:  # moved now, or by an earlier attempt
                    raise OSError(f"{name} has {there.size} bytes of {size} that were written")
            yield b[["name", "records", "bytes", "sha256"]]

    manifest = written.mapInPandas(commit, "name string, records long, bytes long, sha256 string")
    manifest.write.mode("overwrite").parquet(f"{folder}/_manifest")
    store, root = arrow_fs.FileSystem.from_uri(folder)
    if store.get_file_info(f"{root}/_temporary").type != arrow_fs.FileType.NotFound:
        store.delete_dir(f"{root}/_temporary")
    return spark.read.parquet(f"{folder}/_manifest")


def read_archive(spark, folder: str) -> DataFrame:
    """The records of all files that the manifest names, each file streamed member by member.

    A file that is missing, cut off or otherwise not the one that the manifest tells by bytes, records and digest is an error.
    page_id, url, payload (null for revisits), payload_bytes and payload_digest (both of the full payload),
    record_type, refers_to.  Nulls, repeated rows and empty payloads come back as they were written.
    """
    manifest = spark.read.parquet(f"{folder}/_manifest")
    kinds = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"

    def members(path: str, store, wanted: tuple, chunk: int = 1 << 20):
        records, size, digest = 0, 0, hashlib.sha256()
        with store.open_input_stream(path, compression=None) as f:
            inflate, out, begun = zlib.decompressobj(31), [], False
            while data := f.read(chunk):
                size += len(data)
                digest.update(data)
                while data:
                    begun = True
                    out.append(inflate.decompress(data))
                    data = inflate.unused_data
                    if inflate.eof:
                        yield b"".join(out)
                        records, inflate, out, begun = records + 1, zlib.decompressobj(31), [], False
        if begun or (records, size, digest.hexdigest()) != wanted:
            raise ValueError(f"{path} is not the file that was written: {records} records and {size} bytes of {wanted[0]} and {wanted[1]}")

    def read(batches):
        import pyarrow as pa

        store, root = arrow_fs.FileSystem.from_uri(folder)
        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])
        for b in batches:
            for name, *wanted in zip(*(b.column(c).to_pylist() for c in ("name", "records", "bytes", "sha256")), strict=True):
                rows, size = [], 0
                for data in members(f"{root}/{name}", store, tuple(wanted)):
                    rows.append(parse(data))
                    size += len(data)
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    files = manifest.select("name", "records", "bytes", "sha256").repartition(min(max(manifest.count(), 1), 100_000), "name")
    return files.mapInArrow(read, kinds)


def archive_round_trip(pages: DataFrame, **options) -> DataFrame:
    """Write pages to a new archive in the shared folder and read its records back."""
    folder = new_dir(pages.sparkSession, "warc")
    write_archive(pages, folder, **options)
    return read_archive(pages.sparkSession, folder)
