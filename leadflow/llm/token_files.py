"""Token-ID files (operator 4): documents' ids in one flat array a shard, with Elias-Fano coded document boundaries.

Documents are dealt by ranges of their ids and sorted within them; each task writes one shard of two files as it goes:

* ``shard-N.ids``: the ids of its documents, one after the other, little-endian, 2 bytes each where the vocabulary allows;
* ``shard-N.ef``: an Elias-Fano block of the n + 1 boundaries, then one of the document ids (see ``elias_fano``).

A file is written under another name and then moved, so that a task that is run again leaves the same files. A row for each
shard comes back; the shards' sizes are summed up to the place of each in the whole. The folder must be one that all
executors share. Null and empty texts hold the end id only; a null id sorts last; rows that share an id are documents of their
own, side by side in the order of a hash of their texts, over as many shards as they fill.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leadflow.llm import common as C
from leadflow.llm.elias_fano import EliasFano
from leadflow.llm.tokens import encoder

_SHARD = "shard int, n_docs long, n_ids long, width int"


def _files(folder: str) -> tuple[pafs.FileSystem, str]:
    if folder.startswith("file:/") and not folder.startswith("file:///"):
        folder = "file:///" + folder[5:].lstrip("/")
    return pafs.FileSystem.from_uri(folder)


def write_shards(docs: DataFrame, folder: str, vocabulary: str, end_id: int = 0, width: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the files; (shard, n_docs, n_ids, width, start) of each shard, start: the ids of all shards before it."""
    if width not in (2, 4):
        raise ValueError("ids take 2 or 4 bytes")
    kind = f"<u{width}"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        store, root = _files(folder)
        known = encoder(vocabulary)
        bounds, owners, out, n = array("q", [0]), array("q"), None, 0
        name = f"{root}/shard-{shard:06d}"
        spare = f"{name}.{uuid.uuid4().hex}"
        for batch in batches:
            for part in C.chunks(batch, "_text"):
                if out is None:
                    store.create_dir(root, recursive=True)
                    out = store.open_output_stream(f"{spare}.ids")
                ids, at = known.ids(part.column("_text"))
                if width == 2 and len(ids) and ids.max() > 0xFFFF:
                    raise ValueError("this vocabulary needs width=4")
                ids = np.insert(ids, at[1:], end_id)  # each document's end
                out.write(ids.astype(kind).tobytes())
                bounds.extend((n + at[1:] + np.arange(1, len(at))).tolist())
                n += len(ids)
                owners.extend(part.column("_id").to_pylist())
        if out is None:
            return
        out.close()
        with store.open_output_stream(f"{spare}.ef") as f:
            first = EliasFano.of(np.frombuffer(bounds, np.int64)).to_bytes()
            f.write(struct.pack("<Q", len(first)) + first + EliasFano.of(np.frombuffer(owners, np.int64)).to_bytes())
        for end_of in (".ids", ".ef"):
            store.move(spare + end_of, name + end_of)
        yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "n_docs": [len(owners)], "n_ids": [n], "width": pa.array([width], pa.int32())})

    # null and repeated ids are dealt by their texts, equal rows by their places: no key fills a shard
    keyed = C.id_and_text(docs, id_col, text_col).select("_id", "_text", F.xxhash64("_text").alias("_print"), F.monotonically_increasing_id().alias("_row"))
    rows = keyed.repartitionByRange("_id", "_print", "_row").sortWithinPartitions("_id", "_print", "_text").select("_id", "_text")
    shards = C.store(rows.mapInArrow(write, _SHARD), "shards")
    # a row for each shard: few, whatever the documents
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return shards.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


class Shard:
    """Random access to one shard's documents."""

    def __init__(self, folder: str, shard: int, width: int):
        store, root = _files(folder)
        name = f"{root}/shard-{shard:06d}"
        with store.open_input_file(f"{name}.ef") as f:
            data = f.read()
        size = struct.unpack_from("<Q", data)[0]
        self.bounds = EliasFano.from_bytes(data[8 : 8 + size])
        self.owners = EliasFano.from_bytes(data[8 + size :])
        self.width, self.file = width, store.open_input_file(f"{name}.ids")

    def ids(self, first: int, last: int) -> np.ndarray:
        """The ids at places first..last-1 of the shard's array."""
        self.file.seek(first * self.width)
        return np.frombuffer(self.file.read((last - first) * self.width), f"<u{self.width}").astype("<u4")

    def document(self, k: int) -> np.ndarray:
        """The ids of its k-th document."""
        a, b = self.bounds.read(k, k + 2)
        return self.ids(int(a), int(b))


def read_shards(spark: SparkSession, shards: DataFrame, folder: str, block: int = 1 << 20) -> DataFrame:
    """(_id, start, n_tokens, ids_crc32) of each document, from the files; a document is read in parts of ``block`` ids."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(folder, row["shard"], row["width"])
                for low in range(0, row["n_docs"], 4096):
                    high = min(low + 4096, row["n_docs"])
                    at = shard.bounds.read(low, high + 1)
                    crc = []
                    held, held_at = np.zeros(0, "<u4"), 0
                    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                        value = 0
                        while a < b:
                            if not held_at <= a < held_at + len(held):
                                held, held_at = shard.ids(a, min(a + block, int(at[-1]))), a
                            stop = min(b, held_at + len(held))
                            value = zlib.crc32(held[a - held_at : stop - held_at].tobytes(), value)
                            a = stop
                        crc.append(value)
                    yield pa.RecordBatch.from_pydict(
                        {"_id": shard.owners.read(low, high), "start": at[:-1] + row["start"], "n_tokens": np.diff(at), "ids_crc32": pa.array(crc, pa.int64())}
                    )

    n = max(1, shards.count())
    return shards.repartition(n).mapInArrow(read, "_id long, start long, n_tokens long, ids_crc32 long")
