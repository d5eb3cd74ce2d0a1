"""WARC archives with a two-level capture index.

Pages are range-partitioned by their reversed-host key. Each task writes its records, a gzip member each, to archive
files, and the index lines of its records, in key order, to compressed blocks. The sparse directory, a row per block
with its first and last key, is a table. A lookup searches the directory, reads one block by range, searches it, and reads the record
by range. All files lie in the shared folder, under names of the task attempt that wrote them: attempts that are lost
or doubled leave files that nothing refers to.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import json
import re
import uuid
from collections.abc import Iterator
from urllib.parse import urlsplit

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reachlab.llm._common import lookup_join, ship, staged, work_dir

ship(__name__)

#: Index lines of a block, and bytes of records, at most (a larger record alone); bytes of records that a task reads back, about.
BLOCK_LINES, BLOCK_BYTES, READ_BYTES = 1000, 4 << 20, 64 << 20
#: Bytes after which a task begins another archive file.
FILE_BYTES = 256 << 20
_DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def surt(url: str | None) -> str:
    """Reversed-host key: com,example,www)/path?query, lower-case host, without scheme, user, default port and fragment."""
    if not url:
        return ")/"
    try:
        u = urlsplit(url if "://" in url else f"http://{url}")
        host, port = u.hostname or "", u.port
    except ValueError:
        return f"){url}"
    host = ",".join(reversed(host.split(".")))
    port = "" if port in (None, 80, 443) else f":{port}"
    return f"{host}{port}){u.path or '/'}{'?' + u.query if u.query else ''}"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _header(version: str, fields: list[tuple[str, str]]) -> bytes:
    return "\r\n".join([version, *(f"{k}: {v}" for k, v in fields), "", ""]).encode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One gzip member. A revisit keeps the response's HTTP header, with the full length, and no payload."""
    sha = digest(payload)
    target = re.sub(r"[\s\x00-\x1f]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url or f"urn:page:{page_id}")
    http = _header("HTTP/1.1 200 OK", [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(payload)))])
    body = http if refers_to is not None else http + payload
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", f"<urn:page:{page_id}>"), ("WARC-Target-URI", target), ("WARC-Date", _DATE), ("WARC-Payload-Digest", f"sha1:{sha}")]
    if refers_to is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(body)))]
    return gzip.compress(_header("WARC/1.1", fields) + body + b"\r\n\r\n", 6, mtime=0)


def read_record(member: bytes) -> dict[str, object]:
    """warc and http headers (dicts) and payload of one record; the lengths are checked."""
    raw = gzip.decompress(member)
    head, _, rest = raw.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    warc = dict(x.split(": ", 1) for x in lines)
    size = int(warc["Content-Length"])
    if first != "WARC/1.1" or rest[size:] != b"\r\n\r\n":
        raise ValueError(f"broken record {warc.get('WARC-Record-ID')}")
    http, _, payload = rest[:size].partition(b"\r\n\r\n")
    return {"warc": warc, "http": dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:]), "payload": payload}


def _filesystem(folder: str):
    from pyarrow import fs

    if "://" in folder or folder.startswith("file:"):
        return fs.FileSystem.from_uri(folder)
    return fs.LocalFileSystem(), folder


def _page_number(value: str) -> int | None:
    number = value.removeprefix("<urn:page:").removesuffix(">")
    return None if number == "None" else int(number)


def decide(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0) -> DataFrame:
    """__id, __url, __html, __refers: of rows with equal payloads of at least min_bytes, that of the largest id is no revisit; if all ids are null, none is."""
    own = pages.select(F.col(id_col).cast("long").alias("__id"), F.col(url_col).alias("__url"), F.coalesce(F.col(html_col), F.lit("")).alias("__html"))
    own = own.withColumn("__sha", F.sha2("__html", 256))
    # summed up before it moves, so a payload that a third of all pages share is a row a task; only repeated ones go on
    groups = own.filter(F.octet_length("__html") >= min_bytes).groupBy("__sha").agg(F.max("__id").alias("__top"), F.count(F.lit(1)).alias("__n"))
    groups = staged(groups.filter("__n > 1").select("__sha", "__top"), "warc-groups")
    out = lookup_join(own, groups, ["__sha"], "left", F.col("__id"))
    return out.select("__id", "__url", "__html", F.when(~F.col("__top").eqNullSafe(F.col("__id")), F.col("__top")).alias("__refers"))


def write(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0) -> DataFrame:
    """Writes archives and index below folder; returns the block directory, itself a table there.

    Null html is an empty payload; a null url is indexed under an empty key; rows without an id are archived under none.
    Repeated rows are records of their own: those of the response's id all are responses.
    """
    spark = pages.sparkSession
    rows = decide(pages, id_col, url_col, html_col, min_bytes)
    key = F.pandas_udf(lambda urls: urls.map(surt), "string")
    rows = rows.withColumn("__key", key("__url")).repartitionByRange(F.col("__key"), F.col("__id")).sortWithinPartitions("__key", "__id")
    # as text, since pandas would make floats of whole numbers among nulls
    rows = rows.withColumns({c: F.col(c).cast("string") for c in ("__id", "__refers")})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, path = _filesystem(folder)
        name = uuid.uuid4().hex
        lines: list[str] = []
        directory: list[tuple] = []
        state = {"n": 0, "out": None, "at": 0, "file": "", "index": None, "index_at": 0, "held": 0}

        def block() -> None:
            if not lines:
                return
            if state["index"] is None:
                state["index"] = store.open_output_stream(f"{path}/index-{name}.cdx.gz", compression=None)
            raw = gzip.compress(("\n".join(lines) + "\n").encode(), 6, mtime=0)
            state["index"].write(raw)
            directory.append((lines[0].split(" ", 1)[0], lines[-1].split(" ", 1)[0], f"index-{name}.cdx.gz", state["index_at"], len(raw), len(lines), state["held"]))
            state["index_at"] += len(raw)
            state["held"] = 0
            lines.clear()

        for batch in batches:
            for i, url, text, refers, k in zip(batch["__id"], batch["__url"], batch["__html"], batch["__refers"], batch["__key"], strict=True):
                if state["out"] is None or state["at"] >= FILE_BYTES:
                    if state["out"] is not None:
                        state["out"].close()
                    state["n"] += 1
                    state["file"], state["at"] = f"pages-{name}-{state['n']:05d}.warc.gz", 0
                    state["out"] = store.open_output_stream(f"{path}/{state['file']}", compression=None)
                i = None if pd.isna(i) else int(i)
                raw = record(i, url, text.encode("utf-8", "replace"), None if pd.isna(refers) else int(refers))
                state["out"].write(raw)
                lines.append(f"{k.replace(' ', '%20')} {json.dumps({'id': i, 'file': state['file'], 'offset': state['at'], 'length': len(raw)})}")
                state["at"] += len(raw)
                state["held"] += len(raw)
                if len(lines) >= BLOCK_LINES or state["held"] >= BLOCK_BYTES:
                    block()
        block()
        for f in (state["out"], state["index"]):
            if f is not None:
                f.close()
        if directory:
            yield pd.DataFrame(directory, columns=["first_key", "last_key", "file", "offset", "length", "lines", "bytes"])

    store, path = _filesystem(folder)
    store.create_dir(path, recursive=True)
    found = rows.mapInPandas(run, "first_key string, last_key string, file string, offset long, length long, lines long, bytes long")
    found.write.parquet(f"{folder}/directory")
    return spark.read.parquet(f"{folder}/directory")


def _block(store, path: str, row) -> list[str]:
    with store.open_input_file(f"{path}/{row.file}") as f:
        return gzip.decompress(f.read_at(row.length, row.offset)).decode().split("\n")[:-1]


def read(directory: DataFrame, folder: str) -> DataFrame:
    """Reads every record back through the index: page_id, url, payload_bytes, payload_digest, record_type, refers_to.

    Blocks are dealt out by their archives' bytes. A block's records lie side by side, in a file or two: each is read in one range.
    A response's digest is computed from the payload read; a mismatch with its header is an error.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, path = _filesystem(folder)
        for batch in batches:
            for row in batch.itertuples():
                out: list[tuple] = []
                spans: dict[str, list[dict]] = {}
                for line in _block(store, path, row):
                    at = json.loads(line.split(" ", 1)[1])
                    spans.setdefault(at["file"], []).append(at)
                for file, places in spans.items():
                    first, last = min(p["offset"] for p in places), max(p["offset"] + p["length"] for p in places)
                    with store.open_input_file(f"{path}/{file}") as f:
                        held = f.read_at(last - first, first)
                    for at in places:
                        r = read_record(held[at["offset"] - first : at["offset"] - first + at["length"]])
                        w = r["warc"]
                        sha = w["WARC-Payload-Digest"].removeprefix("sha1:")
                        if w["WARC-Type"] == "response" and digest(r["payload"]) != sha:
                            raise ValueError(f"digest of {w['WARC-Record-ID']} differs")
                        refers = _page_number(w["WARC-Refers-To"]) if "WARC-Refers-To" in w else None
                        size = len(r["payload"]) if refers is None else int(r["http"]["Content-Length"])
                        out.append((_page_number(w["WARC-Record-ID"]), w["WARC-Target-URI"], size, sha, w["WARC-Type"], refers))
                got = pd.DataFrame(out, columns=["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"])
                yield got.astype({"page_id": "Int64", "refers_to": "Int64"})

    n, size = directory.agg(F.count(F.lit(1)), F.sum("bytes")).first()
    tasks = max(1, min(n, max(-(-(size or 0) // READ_BYTES), 2 * directory.sparkSession.sparkContext.defaultParallelism)))
    blocks = directory.repartition(tasks, F.col("file"), F.col("offset"))
    return blocks.mapInPandas(run, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long")


def lookup(directory: DataFrame, folder: str, url: str) -> list[dict[str, object]]:
    """The records of a url: the directory is searched for the blocks that can hold its key, each block by bisection."""
    store, path = _filesystem(folder)
    k = surt(url).replace(" ", "%20")
    out = []
    for row in directory.filter((F.col("first_key") <= k) & (F.col("last_key") >= k)).collect():  # a block, or those one key fills
        lines = _block(store, path, row)
        keys = [x.split(" ", 1)[0] for x in lines]
        for line in lines[bisect.bisect_left(keys, k) : bisect.bisect_right(keys, k)]:
            at = json.loads(line.split(" ", 1)[1])
            with store.open_input_file(f"{path}/{at['file']}") as f:
                out.append(read_record(f.read_at(at["length"], at["offset"])))
    return out


def report(pages: DataFrame, **how) -> DataFrame:
    folder = work_dir(pages.sparkSession, "warc")
    got = read(write(pages, folder, **how), folder)
    return got.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
