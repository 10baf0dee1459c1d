"""Token ids in wavelet matrix files, one per shard.

A file holds the ids of consecutive documents as bit-planes, highest bit first: each plane has the bits of the
ids in the order that the planes above left (zeros before ones, stably), with a rank directory.  One file thus
answers access, count, rank and occurrence lookups without the others, and gives back all its ids.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cyclewise.llm.common import bound_batches, cut_lineage, scratch_path
from cyclewise.llm.tokens import encoder

MAGIC = b"WVMX0001"
#: Bits between two entries of the rank directory.
BLOCK = 512
#: A shard is closed at so many ids; a longer document is a shard of its own.
SHARD_TOKENS = 1 << 20


def encode_shard(ids: np.ndarray, doc_ids: np.ndarray, lengths: np.ndarray, null_ids: np.ndarray) -> bytes:
    """The file's bytes.  ``ids``: all documents' ids; ``lengths``: ids per document, in order."""
    width = max(1, int(ids.max()).bit_length()) if len(ids) else 1
    level = ids.astype(np.uint16 if width <= 16 else np.uint32)
    parts, planes = [], []
    pack = zstandard.ZstdCompressor(level=1)

    def put(raw: bytes) -> dict:
        small = pack.compress(raw)
        packed = len(small) < len(raw)
        parts.append(small if packed else raw)
        return {"bytes": len(parts[-1]), "zstd": packed}

    meta = {"tokens": len(ids), "docs": len(lengths), "width": width}
    meta["doc_ids"] = put(doc_ids.astype("<i8").tobytes())
    meta["null_ids"] = put(np.packbits(null_ids).tobytes())
    meta["lengths"] = put(lengths.astype("<i8").tobytes())
    for bit in range(width - 1, -1, -1):
        ones = ((level >> level.dtype.type(bit)) & level.dtype.type(1)).astype(bool)
        packed = np.packbits(ones, bitorder="little")
        padded = np.zeros(-(-len(packed) // (BLOCK // 8)) * (BLOCK // 8), dtype=np.uint8)
        padded[: len(packed)] = packed
        counts = np.bitwise_count(padded.view("<u8")).reshape(-1, BLOCK // 64).sum(axis=1) if len(padded) else np.empty(0)
        before = np.concatenate([[0], np.cumsum(counts)]).astype("<u4")
        planes.append({"bits": put(packed.tobytes()), "rank": put(before.tobytes()), "zeros": int(len(level) - before[-1])})
        # compress and flatnonzero take a tenth of the time of a mask as index
        level = np.concatenate([np.compress(~ones, level), np.compress(ones, level)])
    head = json.dumps(meta | {"planes": planes}).encode()
    return MAGIC + struct.pack("<I", len(head)) + head + b"".join(parts)


class Shard:
    """Reads one file.  Planes are unpacked when first needed."""

    def __init__(self, data: bytes):
        if data[:8] != MAGIC:
            raise ValueError("not a wavelet matrix file")
        (n,) = struct.unpack_from("<I", data, 8)
        self.meta = json.loads(data[12 : 12 + n])
        self._data, self._at = data, 12 + n
        self.tokens, self.width = self.meta["tokens"], self.meta["width"]
        docs = self.meta["docs"]
        self.doc_ids = np.frombuffer(self._section("doc_ids"), "<i8")
        self.null_ids = np.unpackbits(np.frombuffer(self._section("null_ids"), np.uint8), count=docs).astype(bool)
        self.lengths = np.frombuffer(self._section("lengths"), "<i8")
        self.zeros = [p["zeros"] for p in self.meta["planes"]]
        self._places = []
        for p in self.meta["planes"]:
            self._places.append((self._at, p["bits"], self._at + p["bits"]["bytes"], p["rank"]))
            self._at += p["bits"]["bytes"] + p["rank"]["bytes"]
        self._planes: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _raw(self, at: int, info: dict) -> bytes:
        raw = self._data[at : at + info["bytes"]]
        return zstandard.ZstdDecompressor().decompress(raw) if info["zstd"] else raw

    def _section(self, name: str) -> bytes:
        raw = self._raw(self._at, self.meta[name])
        self._at += self.meta[name]["bytes"]
        return raw

    def plane(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Packed bits and rank directory of plane k, the highest bit being 0."""
        if k not in self._planes:
            at, bits, at_rank, rank = self._places[k]
            self._planes[k] = np.frombuffer(self._raw(at, bits), np.uint8), np.frombuffer(self._raw(at_rank, rank), "<u4")
        return self._planes[k]

    def _bit(self, k: int, i: int) -> int:
        return int(self.plane(k)[0][i >> 3]) >> (i & 7) & 1

    def rank1(self, k: int, i: int) -> int:
        """Ones of plane k before place i."""
        bits, before = self.plane(k)
        block = i // BLOCK
        start = block * BLOCK // 8
        ones = int(before[block]) + int(np.bitwise_count(bits[start : i >> 3]).sum())
        return ones + (int(bits[i >> 3]) & ((1 << (i & 7)) - 1)).bit_count() if i & 7 else ones

    def select(self, k: int, bit: int, n: int) -> int:
        """Place of the n-th (from 0) zero or one of plane k."""
        bits, before = self.plane(k)
        upto = before.astype(np.int64) if bit else np.arange(len(before), dtype=np.int64) * BLOCK - before
        block = int(np.searchsorted(upto[:-1], n, side="right")) - 1
        part = np.unpackbits(bits[block * BLOCK // 8 : (block + 1) * BLOCK // 8], bitorder="little")
        return block * BLOCK + int(np.flatnonzero(part == bit)[n - int(upto[block])])

    def access(self, i: int) -> int:
        """The id at place i."""
        if not 0 <= i < self.tokens:
            raise IndexError(i)
        out = 0
        for k in range(self.width):
            bit = self._bit(k, i)
            ones = self.rank1(k, i)
            out = out << 1 | bit
            i = self.zeros[k] + ones if bit else i - ones
        return out

    def _range(self, token: int, start: int, end: int) -> tuple[int, int]:
        for k in range(self.width):
            a, b = self.rank1(k, start), self.rank1(k, end)
            start, end = (self.zeros[k] + a, self.zeros[k] + b) if token >> (self.width - 1 - k) & 1 else (start - a, end - b)
        return start, end

    def rank(self, token: int, i: int) -> int:
        """Occurrences of an id before place i."""
        if not 0 <= token < 1 << self.width:
            return 0
        start, end = self._range(token, 0, i)
        return end - start

    def count(self, token: int) -> int:
        return self.rank(token, self.tokens)

    def occurrence(self, token: int, n: int) -> int:
        """Place of the n-th (from 0) occurrence of an id."""
        if n < 0 or n >= self.count(token):
            raise IndexError(n)
        place = self._range(token, 0, 0)[0] + n
        for k in range(self.width - 1, -1, -1):
            bit = token >> (self.width - 1 - k) & 1
            place = self.select(k, bit, place - self.zeros[k] if bit else place)
        return place

    def ids(self) -> np.ndarray:
        """All ids in order: the planes undone from the lowest bit up."""
        kind = np.uint16 if self.width <= 16 else np.uint32
        level = None
        for k in range(self.width - 1, -1, -1):
            ones = np.unpackbits(self.plane(k)[0], count=self.tokens, bitorder="little").astype(bool)
            if level is None:
                level = np.zeros(self.tokens, kind)
                level[self.zeros[k] :] = 1
                below = level
            else:
                below = level
                below[self.zeros[k] :] |= kind(1 << (self.width - 1 - k))
            up = np.empty_like(below)
            up[np.flatnonzero(~ones)] = below[: self.zeros[k]]
            up[np.flatnonzero(ones)] = below[self.zeros[k] :]
            level = up
        return level if level is not None else np.zeros(0, kind)


def _filesystem(folder: str):
    """The shared folder through pyarrow (file, hdfs, s3, gs ...), the same on every executor."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


def write_shards(docs: DataFrame, tokenizer: str, end_id: int, folder: str | None = None, id_col: str = "doc_id",
                 text_col: str = "text", shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Writes all texts' ids, ``end_id`` after each document, in ascending id order; one row per file:
    ``file, part, shard, docs, tokens, start`` (ids of all files before it).

    Null ids come first; rows of one id follow the order of a hash of their texts.  Null and empty texts have
    the end id alone.  A file that a lost or repeated task leaves behind has a name of its own and is not listed.
    An empty table gives no file.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    folder = folder or scratch_path(spark, "tokens")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.withColumn("_h", F.xxhash64("text")).repartitionByRange("doc_id", "_h").withColumn("_part", F.spark_partition_id())
    rows = rows.sortWithinPartitions("doc_id", "_h").select("doc_id", "text", "_part")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc, fs_root = encoder(tokenizer), None
        end = struct.pack("<I", end_id)
        held, doc_ids, nulls, lengths, size, shard, part = [], [], [], [], 0, 0, 0

        def close():
            nonlocal fs_root, shard, size
            if fs_root is None:
                fs_root = _filesystem(folder)
                fs_root[0].create_dir(fs_root[1], recursive=True)
            data = encode_shard(np.frombuffer(b"".join(held), "<u4"), np.array(doc_ids, np.int64), np.array(lengths, np.int64), np.array(nulls, bool))
            name = f"{part:06d}-{shard:06d}-{uuid.uuid4().hex[:8]}.wvm"
            with fs_root[0].open_output_stream(f"{fs_root[1]}/{name}") as f:
                f.write(data)
            row = pd.DataFrame({"file": [name], "part": [part], "shard": [shard], "docs": [len(lengths)], "tokens": [size], "bytes": [len(data)]})
            for x in (held, doc_ids, nulls, lengths):
                x.clear()
            shard, size = shard + 1, 0
            return row

        for pdf in batches:
            for doc_id, text, p in zip(pdf["doc_id"], pdf["text"], pdf["_part"], strict=True):
                part, null = p, pd.isna(doc_id)
                ids = enc.encode(text or "") + end
                n = len(ids) // 4
                if size and size + n > shard_tokens:
                    yield close()
                held.append(ids)
                doc_ids.append(0 if null else int(doc_id))
                nulls.append(null)
                lengths.append(n)
                size += n
        if lengths:
            yield close()

    files = cut_lineage(rows.mapInPandas(write, "file string, part int, shard int, docs long, tokens long, bytes long"), "token-files")
    # offsets: one sum per partition, then a running sum over the files of a partition
    total, offsets = 0, []
    for r in files.groupBy("part").agg(F.sum("tokens").alias("t")).orderBy("part").collect():
        offsets.append((r["part"], total))
        total += r["t"]
    off = spark.createDataFrame(offsets or [(0, 0)], "part int, _off long")
    w = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    out = files.join(F.broadcast(off), "part")  # one row per partition
    return out.withColumn("start", F.col("_off") + F.coalesce(F.sum("tokens").over(w), F.lit(0))).withColumn(
        "file", F.concat(F.lit(folder.rstrip("/") + "/"), "file")
    ).drop("_off")


def read_shards(files: DataFrame) -> DataFrame:
    """Reads the files back: one row per document, ``doc_id, start, n_tokens, ids_crc32``, from the files alone."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, start in zip(pdf["file"], pdf["start"], strict=True):
                fs, name = _filesystem(path)
                with fs.open_input_stream(name) as f:
                    shard = Shard(f.read())
                raw = shard.ids().astype("<u4").tobytes()
                ends = np.cumsum(shard.lengths)
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(ends - shard.lengths, ends, strict=True)]
                ids = pd.array(shard.doc_ids, dtype="Int64")
                ids[shard.null_ids] = pd.NA
                yield pd.DataFrame({"doc_id": ids, "start": start + ends - shard.lengths, "n_tokens": shard.lengths, "ids_crc32": crc})

    spread = files.select("file", "start").repartition(int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")), "file")
    return spread.mapInPandas(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
