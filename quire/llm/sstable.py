"""Token-ID output as sorted-string-table shards.

A shard holds the documents of one range of identifiers in ascending order:

    data blocks | sparse block index | Bloom filter | footer

* Data block: entries ``varint shared, varint unshared, varint value bytes, key rest, value``.
  A key is stored as what differs from the key before it in the block (prefix compression);
  the first key of a block is whole. A value is the document's ids, uint16 or uint32.
* Key: 1 flag byte (0, or 1 for a null identifier, so nulls come last), the identifier as
  big-endian uint64 with its sign bit flipped, and a uint32 that numbers rows with equal identifier.
* Block index: for each block its first key, offset and length; a lookup bisects it.
* Bloom filter over flag and identifier: most lookups of absent documents read no block.
* Footer (fixed size): places of index and filter, counts, id width, CRC of index and filter, magic.

Cases: null text counts as empty (the end id alone); null identifiers come last; repeated rows
are kept, ordered by text; a very long text is one value, held in memory with its ids; an empty table gives no
shard and no row; other columns are ignored.
"""

from __future__ import annotations

import bisect
import struct
import zlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.bpe import encoder
from quire.llm.common import materialize, new_folder, partitions

MAGIC = b"QSST0001"
FOOTER = struct.Struct("<QQQQQQBI8s")
KEY = struct.Struct(">BQI")
BLOCK_BYTES = 64 << 10
BLOOM_BITS_PER_KEY = 10
BLOOM_HASHES = 7
#: Rows whose texts are encoded together.
ENCODE_ROWS = 200


def key_of(doc_id: int | None, ordinal: int = 0) -> bytes:
    return KEY.pack(1, 0, ordinal) if doc_id is None else KEY.pack(0, (doc_id + (1 << 63)) & ((1 << 64) - 1), ordinal)


def id_of(key: bytes) -> int | None:
    flag, raw, _ = KEY.unpack(key)
    return None if flag else raw - (1 << 63)


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _read_varint(buf: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        b = buf[at]
        at += 1
        n |= (b & 127) << shift
        if b < 128:
            return n, at
        shift += 7


def _bloom_places(hashes: np.ndarray, n_bits: int) -> np.ndarray:
    h1, h2 = hashes & np.uint64(0xFFFFFFFF), (hashes >> np.uint64(32)) | np.uint64(1)
    i = np.arange(BLOOM_HASHES, dtype=np.uint64)
    return (h1[:, None] + i[None, :] * h2[:, None]) % np.uint64(n_bits)


def _hash(key: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(key[:9])


class Writer:
    """Streams one shard to ``out`` (an object with ``write``); keys must ascend."""

    def __init__(self, out, width: int):
        self.out, self.width = out, width
        self.block, self.first, self.last = bytearray(), b"", b""
        self.index: list[tuple[bytes, int, int]] = []
        self.hashes: list[int] = []
        self.at = self.n_docs = self.n_tokens = 0

    def add(self, key: bytes, ids: np.ndarray) -> None:
        if self.n_docs and key <= self.prev:
            raise ValueError("keys must ascend")
        value = ids.astype("<u2" if self.width == 2 else "<u4").tobytes()
        shared = 0
        if not self.block:
            self.first = key
        else:
            while shared < len(key) and key[shared] == self.last[shared]:
                shared += 1
        self.block += _varint(shared) + _varint(len(key) - shared) + _varint(len(value)) + key[shared:] + value
        self.last = self.prev = key
        self.hashes.append(_hash(key))
        self.n_docs += 1
        self.n_tokens += len(ids)
        if len(self.block) >= BLOCK_BYTES:
            self._flush()

    def _flush(self) -> None:
        if self.block:
            self.index.append((self.first, self.at, len(self.block)))
            self.out.write(bytes(self.block))
            self.at += len(self.block)
            self.block = bytearray()

    def finish(self) -> int:
        self._flush()
        index = b"".join(k + struct.pack("<QQ", o, n) for k, o, n in self.index)
        n_bits = max(64, BLOOM_BITS_PER_KEY * self.n_docs + 7 & ~7)
        bits = np.zeros(n_bits, dtype=bool)
        if self.hashes:
            bits[_bloom_places(np.array(self.hashes, dtype=np.uint64), n_bits).ravel().astype(np.int64)] = True
        bloom = np.packbits(bits).tobytes()
        self.out.write(index + bloom)
        self.out.write(
            FOOTER.pack(self.at, len(index), self.at + len(index), len(bloom), self.n_docs, self.n_tokens, self.width, zlib.crc32(index + bloom), MAGIC)
        )
        return self.at + len(index) + len(bloom) + FOOTER.size


class Reader:
    """Reads a shard from a random-access file (``seek``, ``read``, ``size``)."""

    def __init__(self, file):
        self.file = file
        size = file.size()
        file.seek(size - FOOTER.size)
        at, n, bloom_at, bloom_n, self.n_docs, self.n_tokens, self.width, crc, magic = FOOTER.unpack(file.read(FOOTER.size))
        file.seek(at)
        raw = file.read(n + bloom_n)
        if magic != MAGIC or zlib.crc32(raw) != crc:
            raise ValueError("not a whole shard")
        step = KEY.size + 16
        self.index = [(raw[i : i + KEY.size], *struct.unpack("<QQ", raw[i + KEY.size : i + step])) for i in range(0, n, step)]
        self.bloom = np.unpackbits(np.frombuffer(raw[n:], dtype=np.uint8))

    def _entries(self, buf: bytes):
        at, key, kind = 0, b"", "<u2" if self.width == 2 else "<u4"
        while at < len(buf):
            shared, at = _read_varint(buf, at)
            rest, at = _read_varint(buf, at)
            n, at = _read_varint(buf, at)
            key = key[:shared] + buf[at : at + rest]
            at += rest
            yield key, np.frombuffer(buf, dtype=kind, count=n // self.width, offset=at)
            at += n

    def __iter__(self):
        for _, offset, n in self.index:
            self.file.seek(offset)
            for key, ids in self._entries(self.file.read(n)):
                yield id_of(key), ids

    def get(self, doc_id: int | None) -> list[np.ndarray]:
        """The ids of every row with this identifier (none: an empty list)."""
        key = key_of(doc_id)
        places = _bloom_places(np.array([_hash(key)], dtype=np.uint64), len(self.bloom))[0].astype(np.int64)
        if not self.index or not self.bloom[places].all():
            return []
        firsts = [k for k, _, _ in self.index]
        found = []
        for _, offset, n in self.index[max(0, bisect.bisect_right(firsts, key) - 1) :]:
            self.file.seek(offset)
            for k, ids in self._entries(self.file.read(n)):
                if k[:9] == key[:9]:
                    found.append(ids)
                elif k > key:
                    return found
        return found


def open_shard(path: str):
    from pyarrow import fs

    where, inner = fs.FileSystem.from_uri(path)
    return Reader(where.open_input_file(inner))


def write_shards(docs: DataFrame, tokenizer_path: str, end_id: int | None = 2, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode ``docs`` and write shards in ascending identifier order; returns the manifest
    (shard, path, n_docs, n_tokens, n_bytes), one row for each shard.

    One range shuffle of the texts; a task streams its range into one file under a name of its
    own attempt, so a lost or repeated task leaves at most a file that the manifest doesn't name.
    """
    spark = docs.sparkSession
    folder = folder or new_folder(spark, "sst")

    def write(batches):
        import pyarrow as pa
        from pyarrow import fs
        from pyspark import TaskContext

        enc, context = encoder(tokenizer_path), TaskContext.get()
        width = 2 if max(enc.tokenizer.get_vocab_size(), (end_id or 0) + 1) <= 1 << 16 else 4
        tail = b"" if end_id is None else np.array([end_id], dtype="<u4").tobytes()
        where, inner = fs.FileSystem.from_uri(folder)
        name = f"shard-{context.partitionId():06d}-{context.taskAttemptId()}.sst"

        def encoded(batch):
            for at in range(0, batch.num_rows, ENCODE_ROWS):
                part = batch.slice(at, ENCODE_ROWS)
                yield from zip(part.column(0).to_pylist(), enc.encode_all(part.column(1).to_pylist()))

        out, writer, last, ordinal = None, None, object(), 0
        for batch in batches:
            for doc_id, ids in encoded(batch):
                if writer is None:
                    where.create_dir(inner, recursive=True)
                    out = where.open_output_stream(f"{inner}/{name}")
                    writer = Writer(out, width)
                ordinal = ordinal + 1 if doc_id == last else 0
                last = doc_id
                writer.add(key_of(doc_id, ordinal), np.frombuffer(ids + tail, dtype="<u4"))
        if writer is not None:
            n_bytes = writer.finish()
            out.close()
            yield pa.RecordBatch.from_pydict(
                {"shard": pa.array([context.partitionId()], pa.int32()), "path": [f"{folder}/{name}"], "n_docs": [writer.n_docs], "n_tokens": [writer.n_tokens], "n_bytes": [n_bytes]}
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    ordered = rows.repartitionByRange(F.col("doc_id").asc_nulls_last()).sortWithinPartitions(F.col("doc_id").asc_nulls_last(), "text")
    return materialize(ordered.mapInArrow(write, "shard int, path string, n_docs long, n_tokens long, n_bytes long"), "sst-manifest")


def read_shards(manifest: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start (ids before it), n_tokens, ids_crc32, shard."""

    def read(batches):
        import pyarrow as pa

        for batch in batches:
            for shard, path, base in zip(*(batch.column(i).to_pylist() for i in range(3))):
                rows: tuple[list, list, list, list] = ([], [], [], [])
                for doc_id, ids in open_shard(path):
                    for column, value in zip(rows, (doc_id, base, len(ids), zlib.crc32(ids.astype("<u4").tobytes()))):
                        column.append(value)
                    base += len(ids)
                yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in rows), pa.array([shard] * len(rows[0]), pa.int32())], ["doc_id", "start", "n_tokens", "ids_crc32", "shard"])

    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row a shard, not a document
    placed = manifest.select("shard", "path", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"))
    return placed.repartition(partitions(manifest.sparkSession)).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long, shard int")
