"""Training-order output: token ids packed into sequences, shuffled by a keyed permutation, in binary shards.

1. Texts are tokenised; the tokens of a scan task's documents follow each other, each document ended
   by the end mark, and are cut into sequences of fixed length. The last sequence of a task is filled
   up with end marks. The sequences are written once, so all that follows reads the same ones.
2. Sequences are numbered by task and place, and the keyed permutation gives each its global slot.
3. Slots are range-partitioned into shards of ``shard_rows`` records and written in slot order. Every
   record has the same length, so slot s lies in shard ``s // shard_rows`` at byte
   ``(s % shard_rows) * stride``: a reader can resume anywhere and read on sequentially.
"""

from __future__ import annotations

import base64
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from shelfmark.llm.common import shared_dir, stored
from shelfmark.llm.permute import permuted

# The published split pattern of the byte-level vocabulary (a fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
END_BYTE = 10
# The splitter backtracks over white space; a run of more is encoded in parts of this many characters.
_RUN = re.compile(r"\s{1000}")


@dataclass(frozen=True)
class Vocabulary:
    """A byte-pair vocabulary: its rank file's content and the number of the end mark."""

    ranks: bytes
    end: int
    pattern: str = PATTERN

    @staticmethod
    def read(path: str, end: int) -> Vocabulary:
        """Read the rank file on the driver; it goes to the tasks with the function."""
        with open(path, "rb") as f:
            return Vocabulary(f.read(), end)

    def numbers(self) -> dict[bytes, int]:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, self.ranks.splitlines())}

    def kind(self) -> str:
        """The stored form of an id: little-endian, 16 bits if all fit, else 32."""
        return "<u2" if max(self.end, *self.numbers().values()) < 1 << 16 else "<u4"

    def encoding(self) -> tiktoken.Encoding:
        ranks = self.numbers()
        return tiktoken.Encoding("ranks", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={})


def token_bytes(text: str, encode, kind: str = "<u2") -> bytes:
    """Little-endian token ids of a text."""
    bounds = [0, *(m.end() for m in _RUN.finditer(text)), len(text)]
    parts = [text[a:b] for a, b in zip(bounds, bounds[1:], strict=False)] if len(bounds) > 2 else [text]
    return b"".join(encode(p).astype(kind).tobytes() for p in parts)


def packed(docs: DataFrame, vocabulary: Vocabulary, length: int) -> DataFrame:
    """Sequences of ``length`` token ids: task, place in the task, ids, real tokens, documents inside."""
    schema = "part int, place long, n_tokens int, doc_ids array<long>, ids binary"
    kind = vocabulary.kind()
    end = np.array([vocabulary.end], kind).tobytes()
    size = len(end)
    width = size * length

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = vocabulary.encoding().encode_to_numpy
        held, inside, place, part = b"", [], 0, 0
        for batch in batches:
            out: list[tuple] = []
            columns = [batch.column(k).to_pylist() for k in range(3)]
            for part, doc_id, text in zip(*columns, strict=True):
                held += token_bytes(text or "", encode, kind) + end
                inside.append(doc_id)
                if len(held) >= width:
                    full = len(held) // width
                    for k in range(full):
                        out.append((place + k, length, inside if k == 0 else [doc_id], held[k * width : (k + 1) * width]))
                    place += full
                    held = held[full * width :]
                    inside = [doc_id] if held else []
            yield _sequences(part, out)
        if held:
            fill = end * ((width - len(held)) // size)
            yield _sequences(part, [(place, len(held) // size, inside, held + fill)])

    rows = docs.select(F.spark_partition_id().alias("part"), F.col("doc_id").try_cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(pack, schema)


def _sequences(part: int, rows: list[tuple]) -> pa.RecordBatch:
    place, n, inside, ids = zip(*rows, strict=True) if rows else ((), (), (), ())
    return pa.RecordBatch.from_arrays(
        [
            pa.array([part] * len(rows), pa.int32()),
            pa.array(place, pa.int64()),
            pa.array(n, pa.int32()),
            pa.array(inside, pa.list_(pa.int64())),
            pa.array(ids, pa.binary()),
        ],
        names=["part", "place", "n_tokens", "doc_ids", "ids"],
    )


@F.pandas_udf(BinaryType())
def compressed(ids: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Records are shuffled compressed: that saves more than a quarter of the shuffled bytes."""
    encoder = zstandard.ZstdCompressor(level=3)
    for s in ids:
        yield s.map(encoder.compress)


@F.pandas_udf(BinaryType())
def restored(packed: Iterator[pd.Series]) -> Iterator[pd.Series]:
    decoder = zstandard.ZstdDecompressor()
    for s in packed:
        yield s.map(decoder.decompress)


def write_shards(
    docs: DataFrame, vocabulary: Vocabulary, path: str, length: int = 2048, shard_rows: int = 1 << 12, key: int = 0
) -> DataFrame:
    """Write the shards under ``path`` and return one row per sequence.

    Files: ``shard=<k>/part-*``; a record is ``length`` little-endian ids and one line end. Ids have 16 bits, or 32 if
    the vocabulary has more than 65,536, so the stride is ``2 * length + 1`` or ``4 * length + 1`` bytes. Rows: ``slot``, ``shard``, ``byte_offset``, ``sequence``,
    ``n_tokens``, ``doc_ids`` (documents that have tokens in it, in order) and ``crc32`` of the ids.

    Null and empty texts give an end mark alone. An id that is not a number is null in ``doc_ids``. Repeated rows give their tokens each time. Other
    columns are not read. An empty table gives no sequences and no files.
    """
    sequences = stored(packed(docs, vocabulary, length), "sequences")
    sizes = sequences.groupBy("part").agg(F.count("*").alias("_size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select("part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_base"))
    # one row per scan task
    rows = sequences.join(F.broadcast(base), "part").withColumn("sequence", F.col("_base") + F.col("place"))
    total = sequences.count()
    rows = rows.withColumn("slot", permuted(F.col("sequence"), total, key))
    rows = rows.withColumn("shard", F.floor(F.col("slot") / shard_rows))
    shards = max(1, -(-total // shard_rows))
    dealt = rows.select("shard", "slot", compressed("ids").alias("ids")).repartitionByRange(shards, "shard")
    ordered = dealt.sortWithinPartitions("shard", "slot")
    ordered.select("shard", restored("ids").cast("string").alias("value")).write.partitionBy("shard").option(
        "lineSep", chr(END_BYTE)
    ).text(path)
    stride = np.dtype(vocabulary.kind()).itemsize * length + 1
    return rows.select(
        "slot",
        "shard",
        (F.col("slot") % shard_rows * stride).alias("byte_offset"),
        "sequence",
        "n_tokens",
        "doc_ids",
        F.crc32("ids").alias("crc32"),
    )


def materialise(docs: DataFrame, vocabulary: Vocabulary, **options) -> DataFrame:
    """``write_shards`` into a new folder of the shared folder; its path is the column ``path``."""
    path = f"{shared_dir(docs.sparkSession)}/shards-{uuid.uuid4().hex}"
    return write_shards(docs, vocabulary, path, **options).withColumn("path", F.lit(path))


def read_record(data: bytes, length: int, kind: str = "<u2") -> np.ndarray:
    """Ids of the records in the bytes of a shard, one row per record."""
    width = np.dtype(kind).itemsize * length
    records = np.frombuffer(data, np.uint8).reshape(-1, width + 1)
    return np.ascontiguousarray(records[:, :width]).view(kind)
