"""Token-ID / binary output.

Token ids are ranked by their frequency in the whole corpus; a rank is
stored in as few whole bytes as it needs (the 256 most frequent ids take
one byte), the byte counts of eight (or four) values are packed in one
control byte, and control bytes stand apart from data bytes.  A decoder
expands control bytes by a numpy table lookup and gathers the data bytes.

Shard file (little endian), written in ascending document order::

    "RLTOK1\\0\\0"                               magic
    block: u32 docs, u32 values, u32 data bytes, u32 CRC-32 of what follows
           i64[docs] ids, u8[docs] id is null, u32[docs] lengths,
           control bytes, data bytes
    ...

``ranks.bin`` beside the shards holds the u32 id of every rank.

Cases: a null text is empty; every document gets the end id, so a
document is never empty; rows that repeat a doc_id are all written, ordered
by doc_id (null first), length and CRC-32; an empty table gives no shard.
Extra columns of the input are ignored.

Recovery: ids are staged once in the shared folder; a task writes its shard
under a name of its own attempt and reports it as a row; only reported
shards are read, so retries leave nothing but an unread file.
"""

from __future__ import annotations

import json
import posixpath
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.llm.common import map_arrow, prepare, shuffle_partitions, stage
from reviewlake.llm.tokens import append_end, encoder
from reviewlake.session import scratch_path

MAGIC = b"RLTOK1\0\0"
BLOCK_VALUES = 1 << 18          # values after which a block is closed


# --- codec -----------------------------------------------------------------

class Codec:
    """Byte-aligned variable-length code with separate control bytes.

    ``bits`` of control per value: 1 (one or two bytes) or 2 (one to four)."""

    def __init__(self, bits: int):
        if bits not in (1, 2):
            raise ValueError("control bits must be 1 or 2")
        self.bits, self.per = bits, 8 // bits
        shifts = np.arange(self.per, dtype=np.uint8) * np.uint8(bits)
        #: byte counts that each of the 256 control bytes stands for
        self.table = ((np.arange(256, dtype=np.uint16)[:, None] >> shifts) & ((1 << bits) - 1)).astype(np.uint8) + 1

    def encode(self, v: np.ndarray) -> tuple[bytes, bytes]:
        v = v.astype("<u4")
        size = 1 + (v > 0xFF).astype(np.uint8) + (v > 0xFFFF) + (v > 0xFFFFFF)
        if len(v) and size.max() > 1 << self.bits:
            raise ValueError("value needs more bytes than the control bits can say")
        code = np.zeros(-(-len(v) // self.per) * self.per, np.uint8)
        code[:len(v)] = size - 1
        shifts = np.arange(self.per, dtype=np.uint8) * np.uint8(self.bits)
        control = np.bitwise_or.reduce(code.reshape(-1, self.per) << shifts, axis=1).astype(np.uint8)
        octets = v.view(np.uint8).reshape(-1, 4)
        return control.tobytes(), octets[np.arange(4) < size[:, None]].tobytes()

    def control_bytes(self, n: int) -> int:
        return -(-n // self.per)

    def decode(self, control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
        size = self.table[control].reshape(-1)[:n].astype(np.int64)
        at = np.cumsum(size) - size
        out = data[at].astype(np.uint32)
        for k in range(1, 1 << self.bits):
            more = size > k
            out[more] |= data[at[more] + k].astype(np.uint32) << np.uint32(8 * k)
        return out


def control_bits(n_ids: int) -> int:
    return 1 if n_ids <= 1 << 16 else 2


# --- stage 1: ids of every document -----------------------------------------

def encode_documents(docs: DataFrame, tokenizer_json: str, end_id: int, id_col: str = "doc_id",
                     text_col: str = "text", keeps_space: bool = False) -> DataFrame:
    """(id, n_tokens, ids_crc32, z): the zstd-packed ids of every whole text
    with ``end_id`` appended, as little-endian u16 (u32 for ids over 65535)."""
    spark = docs.sparkSession
    prepare(spark)
    tok = spark.sparkContext.broadcast(tokenizer_json)    # a vocabulary file, a few MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        enc, zc = encoder(tok.value, keeps_space), zstandard.ZstdCompressor(level=3)
        kind = "<u2" if max(enc.tok.get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4"
        for b in batches:
            n, ids = append_end(*enc.encode(b.column(1)), end_id)
            ends, crc, packed = np.cumsum(n), [], []
            small = ids.astype(kind)
            for lo, hi in zip((ends - n).tolist(), ends.tolist()):
                crc.append(zlib.crc32(ids[lo:hi].astype("<u4")))
                packed.append(zc.compress(small[lo:hi].tobytes()))
            yield pa.record_batch([b.column(0).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(crc, pa.int64()),
                                   pa.array([small.itemsize] * len(n), pa.int32()), pa.array(packed, pa.binary())],
                                  names=["doc_id", "n_tokens", "ids_crc32", "width", "z"])

    return map_arrow(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")),
                     run, "doc_id long, n_tokens long, ids_crc32 long, width int, z binary")


def _unpack(b: pa.RecordBatch, dc) -> list[np.ndarray]:
    return [np.frombuffer(dc.decompress(z), f"<u{w}")
            for z, w in zip(b.column("z").to_pylist(), b.column("width").to_pylist())]


def id_counts(tokens: DataFrame, n_ids: int) -> DataFrame:
    """(id, n) over all documents; each task sends one row per id it saw."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        dc, total = zstandard.ZstdDecompressor(), np.zeros(n_ids, np.int64)
        for b in batches:
            if b.num_rows:
                total += np.bincount(np.concatenate(_unpack(b, dc)), minlength=n_ids)
        seen = np.flatnonzero(total)
        yield pa.record_batch([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], names=["id", "n"])

    part = map_arrow(tokens.select("width", "z"), run, "id long, n long")
    return part.groupBy("id").agg(F.sum("n").alias("n"))


# --- stage 2: shards --------------------------------------------------------

def qualified(spark: SparkSession, folder: str) -> str:
    """``folder`` with the scheme that Spark would take it to have."""
    if "://" in folder or folder.startswith("file:"):
        return folder
    default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")
    return folder if default.startswith("file:") else default.rstrip("/") + folder


def _filesystem(uri: str):
    """(pyarrow file system, path) of a folder in the shared store."""
    from pyarrow import fs
    if ":" not in uri.split("/")[0]:
        uri = f"file://{posixpath.abspath(uri)}"
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return fs.FileSystem.from_uri(uri)


def _block(codec: Codec, ids: list, docs: list[np.ndarray], rank: np.ndarray) -> bytes:
    values = rank[np.concatenate(docs)]
    control, data = codec.encode(values)
    body = b"".join([
        np.array([0 if i is None else i for i in ids], "<i8").tobytes(),
        np.array([i is None for i in ids], np.uint8).tobytes(),
        np.array([len(d) for d in docs], "<u4").tobytes(), control, data])
    return struct.pack("<4I", len(ids), len(values), len(data), zlib.crc32(body)) + body


def write_shards(tokens: DataFrame, folder: str, n_ids: int, n_shards: int | None = None) -> DataFrame:
    """Write the staged ``tokens`` as shards in ascending document order.

    Returns the manifest (shard, path, n_docs, n_tokens) as a staged table;
    it has one row per shard.  ``ranks.bin`` is written beside them: at
    most one entry per id of the vocabulary, the only data that passes
    through the driver."""
    spark = tokens.sparkSession
    ranked = id_counts(tokens, n_ids).orderBy(F.desc("n"), "id").select("id").toPandas()["id"].to_numpy(np.uint32)
    rank = np.zeros(n_ids, np.uint32)
    rank[ranked] = np.arange(len(ranked), dtype=np.uint32)
    files, root = _filesystem(folder)
    files.create_dir(root, recursive=True)
    bits = control_bits(len(ranked))
    with files.open_output_stream(f"{root}/ranks.bin") as f:
        f.write(ranked.astype("<u4").tobytes())
    with files.open_output_stream(f"{root}/format.json") as f:
        f.write(json.dumps({"format": "RLTOK1", "control_bits": bits}).encode())
    shared = spark.sparkContext.broadcast(rank)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        from pyspark import TaskContext
        dc, codec, shard = zstandard.ZstdDecompressor(), Codec(bits), TaskContext.get().partitionId()
        store, base = _filesystem(folder)
        name, out, n_docs, n_values = f"{shard:06d}-{uuid.uuid4().hex}.rltok", None, 0, 0
        ids: list = []
        docs: list[np.ndarray] = []
        for b in batches:
            for i, d in zip(b.column("doc_id").to_pylist(), _unpack(b, dc)):
                ids.append(i)
                docs.append(d)
                n_values += len(d)
                if sum(map(len, docs[-1:])) >= BLOCK_VALUES or len(docs) >= 4096:
                    out = out or _open(store, f"{base}/{name}")
                    out.write(_block(codec, ids, docs, shared.value))
                    n_docs, ids, docs = n_docs + len(ids), [], []
            if docs:                                  # a batch is bounded in bytes, so a block is too
                out = out or _open(store, f"{base}/{name}")
                out.write(_block(codec, ids, docs, shared.value))
                n_docs, ids, docs = n_docs + len(ids), [], []
        if out:
            out.close()
            yield pa.record_batch([pa.array([shard], pa.int64()), pa.array([name]), pa.array([n_docs], pa.int64()),
                                   pa.array([n_values], pa.int64())], names=["shard", "path", "n_docs", "n_tokens"])

    order = tokens.repartitionByRange(n_shards or shuffle_partitions(spark), "doc_id", "n_tokens", "ids_crc32") \
                  .sortWithinPartitions("doc_id", "n_tokens", "ids_crc32")
    return stage(map_arrow(order.select("doc_id", "width", "z"), run,
                           "shard long, path string, n_docs long, n_tokens long"), "token-manifest")


def _open(store, path: str):
    out = store.open_output_stream(path)
    out.write(MAGIC)
    return out


def read_shard(stream, codec: Codec, ranked: np.ndarray) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """Blocks of one shard: (doc ids, lengths, all ids as u32)."""
    if stream.read(len(MAGIC)) != MAGIC:
        raise ValueError("not a token shard")
    while head := stream.read(16):
        n_docs, n, n_data, crc = struct.unpack("<4I", head)
        n_control = codec.control_bytes(n)
        body = stream.read(13 * n_docs + n_control + n_data)
        if zlib.crc32(body) != crc:
            raise ValueError("damaged token shard")
        at = 9 * n_docs
        ids = np.frombuffer(body, "<i8", n_docs)
        null = np.frombuffer(body, np.uint8, n_docs, 8 * n_docs).astype(bool)
        lengths = np.frombuffer(body, "<u4", n_docs, at).astype(np.int64)
        control = np.frombuffer(body, np.uint8, n_control, at + 4 * n_docs)
        data = np.frombuffer(body, np.uint8, n_data, at + 4 * n_docs + n_control)
        yield [None if z else int(i) for i, z in zip(ids, null)], lengths, ranked[codec.decode(control, data, n)]


def read_tokens(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """Decode the shards: (doc_id, start, n_tokens, ids_crc32), one row per
    document.  The manifest has one row per shard, so its running total is
    taken on the driver."""
    rows = manifest.orderBy("shard").collect()
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    if not rows:
        return spark.createDataFrame([], schema)
    starts, total = [], 0
    for r in rows:
        starts.append((r["path"], total))
        total += r["n_tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _filesystem(folder)
        with store.open_input_stream(f"{base}/format.json") as f:
            codec = Codec(json.loads(f.read())["control_bits"])
        with store.open_input_stream(f"{base}/ranks.bin") as f:
            ranked = np.frombuffer(f.read(), "<u4").astype(np.uint32)
        for b in batches:
            for path, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                with store.open_input_stream(f"{base}/{path}") as stream:
                    for ids, n, values in read_shard(stream, codec, ranked):
                        ends = np.cumsum(n)
                        raw = values.astype("<u4")
                        crc = [zlib.crc32(raw[lo:hi]) for lo, hi in zip((ends - n).tolist(), ends.tolist())]
                        yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(start + ends - n, pa.int64()),
                                               pa.array(n, pa.int64()), pa.array(crc, pa.int64())],
                                              names=["doc_id", "start", "n_tokens", "ids_crc32"])
                        start += int(ends[-1])

    prepare(spark)
    listed = spark.createDataFrame(starts, "path string, start long").repartition(len(starts))
    return map_arrow(listed, run, schema)


def write_token_ids(docs: DataFrame, tokenizer_json: str, end_id: int, n_ids: int, folder: str | None = None,
                    id_col: str = "doc_id", text_col: str = "text", keeps_space: bool = False,
                    n_shards: int | None = None) -> tuple[str, DataFrame]:
    """Tokenize, rank and write; returns (folder, manifest)."""
    folder = qualified(docs.sparkSession, folder or scratch_path(docs.sparkSession, "token-shards"))
    tokens = stage(encode_documents(docs, tokenizer_json, end_id, id_col, text_col, keeps_space), "token-ids")
    return folder, write_shards(tokens, folder, n_ids, n_shards)
