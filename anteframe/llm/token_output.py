"""Token sequences written in training order, as shards of fixed stride.

A keyed Feistel permutation gives every sequence a slot: a number as wide as needed is cut in two
halves that are mixed in rounds, and walked on while it falls beyond the last slot. Slots come from
dense row numbers alone, so any machine can tell where a sequence is, and which one a slot holds.
Slots are range-partitioned; each task fills whole shards. A record has a fixed stride, so slot
``s`` is record ``s % SHARD`` of shard ``s // SHARD``: a reader goes on from any slot at once.

Shards are rows (shard, first_slot, records, stride, payload) of a table in shard order: any store
that Spark writes to can hold them, and a shard filter reads only its files.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._store import BROADCAST_IDS, ready, stored
from ._text import mix, text_bytes
from ._tokens import LENGTH, token_pieces

#: Records of a shard: two to eight MB.
SHARD = 2048
ROUNDS = 6
KEY = 0x5EED
#: Before the ids of a record: document, piece, and how many ids follow. The rest is zero.
HEAD = np.dtype([("doc_id", "<i8"), ("piece", "<i4"), ("length", "<u4")])

SHARDS = "shard long, first_slot long, records int, stride int, payload binary"


def half_bits(n: int) -> int:
    return max(1, -(-max(n - 1, 1).bit_length() // 2))


def _rounds(x: np.ndarray, bits: int, key: int, back: bool) -> np.ndarray:
    low = np.uint64((1 << bits) - 1)
    left, right = x >> np.uint64(bits), x & low
    keys = mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) + (np.uint64(key) << np.uint64(8)))
    for k in keys[::-1] if back else keys:
        if back:
            left, right = right ^ (mix(left ^ k) & low), left
        else:
            left, right = right, left ^ (mix(right ^ k) & low)
    return (left << np.uint64(bits)) | right


def permuted(x: np.ndarray, n: int, key: int = KEY, back: bool = False) -> np.ndarray:
    """A permutation of 0 to n - 1, or with ``back`` its inverse."""
    bits = half_bits(n)
    out = _rounds(x.astype(np.uint64), bits, key, back)
    while (beyond := out >= np.uint64(n)).any():
        out[beyond] = _rounds(out[beyond], bits, key, back)
    return out.astype(np.int64)


def numbered(rows: DataFrame) -> DataFrame:
    """Stored ``rows`` with dense numbers from 0 as ``number``, by their column ``row``."""
    part = F.shiftrightunsigned("row", 33).alias("part")
    counts = [(r.part, r.n) for r in rows.groupBy(part).agg(F.count("*").alias("n")).orderBy("part").toLocalIterator()]
    before = np.cumsum([0, *(n for _, n in counts)])
    table = rows.sparkSession.createDataFrame([(p, int(b)) for (p, _), b in zip(counts, before, strict=False)], "part long, before long")
    table = F.broadcast(table) if len(counts) <= BROADCAST_IDS else table
    dense = F.col("before") + F.col("row").bitwiseAND((1 << 33) - 1)
    return rows.withColumn("part", part).join(table, "part").withColumn("number", dense).drop("part", "before")


def slotted(rows: DataFrame, n: int, key: int) -> DataFrame:
    """``rows`` with ``slot`` in place of ``number``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("number")
            yield batch.set_column(at, "slot", pa.array(permuted(batch.column(at).to_numpy(), n, key)))

    return rows.mapInArrow(run, ", ".join(f"{'slot' if f.name == 'number' else f.name} {f.dataType.simpleString()}" for f in rows.schema))


def shards(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, key: int = KEY, files: tuple[str, str] | None = None, wide: bool = False
) -> DataFrame:
    """All sequences of the documents in the order of their slots, as shards.

    A document's ids, with the end id, are cut into pieces of ``length``; each is a record, ids of 16
    bits, or 32 if ``wide`` (for vocabularies over 65,536). A null text is one id, the end. A row
    without doc_id is marked as such and read as null. Rows that repeat are written as often. An empty table has no
    shards. Other columns are not looked at.
    """
    spark = docs.sparkSession
    kind = np.dtype("<u4") if wide else np.dtype("<u2")
    rows = token_pieces(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), "doc_id", "text", length, files, True)

    def narrow(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = text_bytes(batch.column("ids"))
            ids = data.view("<u4")
            if not wide and len(ids) and ids.max() > 0xFFFF:
                raise ValueError("ids over 65,535 need wide=True")
            ends = (off // 4 * kind.itemsize).astype(np.int32)
            cut = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer(ends), pa.py_buffer(ids.astype(kind))])
            yield pa.record_batch([batch.column("doc_id"), batch.column("piece"), cut], ["doc_id", "piece", "ids"])

    rows = rows.select("doc_id", "piece", "ids").mapInArrow(narrow, "doc_id long, piece int, ids binary")
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()))
    n = rows.count()
    stride = HEAD.itemsize + length * kind.itemsize
    record = np.dtype([("head", HEAD), ("ids", kind, (length,))])

    def fill(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        payload, at = None, -1
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("doc_id", "piece", "slot", "ids"))
            for doc, piece, slot, raw in zip(*columns, strict=True):
                if slot // SHARD != at:
                    if payload is not None:
                        yield shard(at, payload)
                    at = slot // SHARD
                    payload = np.zeros(min(SHARD, n - at * SHARD), record)
                ids = np.frombuffer(raw, kind)
                own = payload[slot % SHARD]
                # A piece below zero says that there is no doc_id.
                own["head"] = (0, -1 - piece, len(ids)) if doc is None else (doc, piece, len(ids))
                own["ids"][: len(ids)] = ids
        if payload is not None:
            yield shard(at, payload)

    def shard(at: int, payload: np.ndarray) -> pa.RecordBatch:
        cells = [[at], [at * SHARD], [len(payload)], [stride], [payload.tobytes()]]
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
        return pa.record_batch([pa.array(c, t) for c, t in zip(cells, types, strict=True)], [f.split()[0] for f in SHARDS.split(", ")])

    dealt = slotted(numbered(rows).select("doc_id", "piece", "ids", "number"), n, key).withColumn("shard", F.floor(F.col("slot") / SHARD))
    parts = max(1, min(-(-n // SHARD), int(spark.conf.get("spark.sql.shuffle.partitions"))))
    ready(spark)
    return dealt.repartitionByRange(parts, "shard").sortWithinPartitions("slot").drop("shard").mapInArrow(fill, SHARDS)


def write(found: DataFrame, path: str) -> DataFrame:
    """Writes shards in order, and returns them as read again."""
    found.write.option("compression", "zstd").parquet(path)
    return read(found.sparkSession, path)


def read(spark: SparkSession, path: str, from_slot: int = 0) -> DataFrame:
    """Written shards from the one that holds ``from_slot`` on."""
    return spark.read.schema(SHARDS).parquet(path).where(F.col("shard") >= from_slot // SHARD)


def records(found: DataFrame, from_slot: int = 0, length: int = LENGTH) -> DataFrame:
    """One row per record from a slot on: slot, shard, offset (bytes), doc_id, piece, length, ids_crc32."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, first, stride, raw in zip(*(batch.column(c).to_pylist() for c in ("shard", "first_slot", "stride", "payload")), strict=True):
                kind = np.dtype("<u4") if stride - HEAD.itemsize == 4 * length else np.dtype("<u2")
                rows = np.frombuffer(raw, np.dtype([("head", HEAD), ("ids", kind, (length,))]))
                skip = max(0, from_slot - first)
                rows, slot = rows[skip:], np.arange(first + skip, first + len(rows))
                doc, piece, n = rows["head"]["doc_id"], rows["head"]["piece"], rows["head"]["length"].astype(np.int64)
                missing = piece < 0
                crc = [zlib.crc32(x[:k].astype("<u4").tobytes()) for x, k in zip(rows["ids"], n.tolist(), strict=True)]
                yield pa.record_batch(
                    [pa.array(slot), pa.array(np.full(len(slot), at)), pa.array((slot - first) * stride), pa.array(doc, mask=missing), pa.array(np.where(missing, -1 - piece, piece)), pa.array(n), pa.array(crc, pa.int64())],
                    ["slot", "shard", "offset", "doc_id", "piece", "length", "ids_crc32"],
                )

    return found.mapInArrow(run, "slot long, shard long, offset long, doc_id long, piece int, length long, ids_crc32 long")
