"""Profile token sink as a Spark data source (K5): batches with idempotency keys, committed by the driver.

    register(spark)
    tokens.write.format("leadflow_tokens").mode("append").options(run="2024-07-01T05:00", to="file:///shared/outbox").save()

Rows (identity, token, value) are sent in batches of ``batch`` rows. A batch's key is a digest of the run's name and its rows, so
a task that is run again, or a job that is, sends batches that the receiver already knows: it keeps the first of a key. That needs
the same batches again, so ``push`` deals the rows by identity and sorts them first. When all tasks have ended well the driver
writes the run's receipt, with what each task sent; a run without a receipt has not been delivered whole, and is run again.

``to`` names where batches go: a folder, in which a batch is a file named by its key, or ``module:function``, called with (key, rows);
such a module must be on the executors' path (``--py-files``). This module itself goes to them with the job.
"""

from __future__ import annotations

import hashlib
import importlib
import json
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from leadflow.sources.snapshots import path_exists

FORMAT = "leadflow_tokens"


@dataclass
class Sent(WriterCommitMessage):
    """What a task has sent: keys and number of rows."""

    keys: list[str]
    rows: int


class UndeliveredError(RuntimeError):
    """A run that has no receipt."""


def _store(folder: str):
    from pyarrow import fs

    if folder.startswith("file:/") and not folder.startswith("file:///"):
        folder = "file:///" + folder[5:].lstrip("/")
    return fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")


def _put(folder: str, name: str, text: str) -> None:
    """A file that is there whole or not at all; one of that name stays as it is."""
    from pyarrow import fs

    store, root = _store(folder)
    target = f"{root}/{name}"
    if store.get_file_info(target).type != fs.FileType.NotFound:
        return
    store.create_dir(root, recursive=True)
    spare = f"{root}/.{name}.{hashlib.sha256(text.encode()).hexdigest()[:8]}.tmp"
    with store.open_output_stream(spare) as f:
        f.write(text.encode())
    store.move(spare, target)


def to_folder(folder: str) -> Callable[[str, list[dict]], None]:
    """A receiver that keeps each batch as JSON lines under its key, once."""
    return lambda key, rows: _put(folder, f"{key}.jsonl", "".join(json.dumps(r, sort_keys=True) + "\n" for r in rows))


def receiver(to: str) -> Callable[[str, list[dict]], None]:
    module, _, name = to.partition(":")
    if "/" in to or not name:
        return to_folder(to)
    return getattr(importlib.import_module(module), name)


def batch_key(run: str, rows: list[dict]) -> str:
    """The same for the same rows of a run, whoever sends them."""
    return hashlib.sha256(json.dumps([run, rows], sort_keys=True).encode()).hexdigest()[:40]


class TokenSink(DataSource):
    """The data source; a writer only."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema, overwrite: bool) -> TokenWriter:
        if overwrite:
            raise ValueError("tokens are only ever appended; use mode('append')")
        missing = {"run", "to"} - set(self.options)
        if missing:
            raise ValueError(f"options {sorted(missing)} are needed")
        return TokenWriter(dict(self.options))


class TokenWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str]):
        self.run, self.to, self.receipts = options["run"], options["to"], options.get("receipts")
        self.batch = int(options.get("batch", 1000))

    def write(self, iterator: Iterator) -> Sent:
        send, keys, rows, held = receiver(self.to), [], 0, []
        for part in iterator:
            held += part.to_pylist()
            while len(held) >= self.batch:
                keys.append(self._send(send, held[: self.batch]))
                rows, held = rows + self.batch, held[self.batch :]
        if held:
            keys.append(self._send(send, held))
        return Sent(keys, rows + len(held))

    def _send(self, send: Callable, rows: list[dict]) -> str:
        key = batch_key(self.run, rows)
        send(key, rows)
        return key

    def commit(self, messages: list[Sent | None]) -> None:
        done = [m for m in messages if m is not None]
        if self.receipts:
            text = json.dumps({"run": self.run, "rows": sum(m.rows for m in done), "batches": sum(len(m.keys) for m in done)})
            _put(self.receipts, receipt_name(self.run), text)

    def abort(self, messages: list[Sent | None]) -> None:
        """Nothing to take back: what was sent is known by its key when the run is repeated; there is no receipt."""


def receipt_name(run: str) -> str:
    return f"receipt-{hashlib.sha256(run.encode()).hexdigest()[:20]}.json"


def register(spark: SparkSession) -> None:
    """Make the format known to a session; workers get this module's code with it."""
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(TokenSink)


def delivered(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """The rows that have arrived in a folder."""
    if not path_exists(spark, folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(folder)


def push(tokens: DataFrame, run: str, to: str, receipts: str, batch: int = 1000, partitions: int | None = None) -> None:
    """Deliver the tokens of a run; to be called again with the same rows if it fails. ``partitions``: how many tasks send."""
    spark = tokens.sparkSession
    register(spark)
    identity = tokens.columns[0]
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = tokens.repartition(n, identity).sortWithinPartitions(*tokens.columns)
    rows.write.format(FORMAT).mode("append").options(run=run, to=to, receipts=receipts, batch=str(batch)).save()


def receipt(spark: SparkSession, receipts: str, run: str) -> dict:
    """What a run has delivered; raises ``UndeliveredError`` where it has not ended well."""
    from pyarrow import fs

    store, root = _store(receipts)
    path = f"{root}/{receipt_name(run)}"
    if store.get_file_info(path).type == fs.FileType.NotFound:
        raise UndeliveredError(f"run {run} has no receipt in {receipts}")
    with store.open_input_stream(path) as f:
        return json.loads(f.read())
