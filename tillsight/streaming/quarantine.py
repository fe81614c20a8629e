"""A stream that goes on when a file is bad.

The stream is one of file names: a micro-batch is some names, its files are read in one go. If a
batch fails, its files are run one by one, each as a batch of its own; those that fail again are
put into quarantine with the error, the others are published, and the stream goes on. Files in
quarantine are tried again by later runs: a few times as they are, and always once they have
been changed. The quarantine is a commit log, so an entry is there whole or not at all, and a
batch that a lost driver had begun leaves one entry when it is repeated.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tillsight.sources.commits import CommitLog
from tillsight.sources.readers import finished_batches
from tillsight.sources.writers import finish_batch
from tillsight.streaming.batches import BatchStatus, Step, run_batch

log = logging.getLogger(__name__)

#: times a file is tried as it is
ATTEMPTS = 3
#: files of a micro-batch, and ids that are kept free behind a batch's for its files
FILES, IDS = 500, 1_000_000
FILE_NAMES = "path string, modificationTime timestamp, length long, content binary"


class Held(NamedTuple):
    """A file in quarantine."""

    file: str
    batch_id: int
    attempts: int
    modified: int
    error: str


def _modified(spark: SparkSession, file: str) -> int:
    """Modification time; -1 for a file that is gone."""
    path = spark._jvm.org.apache.hadoop.fs.Path(file)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.getFileStatus(path).getModificationTime() if fs.exists(path) else -1


def _log(spark: SparkSession, root: str) -> CommitLog:
    return CommitLog(spark, f"{root}/_quarantine")


def quarantined(spark: SparkSession, root: str) -> dict[str, Held]:
    """Files that are in quarantine now."""
    now: dict[str, Held] = {}
    for entry in _log(spark, root).entries():
        for held in entry["held"]:
            now[held["file"]] = Held(**held)
        for file in entry["released"]:
            now.pop(file, None)
    return now


def quarantine_table(spark: SparkSession, root: str) -> DataFrame:
    """(file, batch_id, attempts, modified, error) of the files in quarantine."""
    schema = "file string, batch_id bigint, attempts int, modified bigint, error string"
    return spark.createDataFrame([tuple(h) for h in quarantined(spark, root).values()], schema)


def _noted(spark: SparkSession, root: str, cause: str, held: Sequence[Held], released: Sequence[str] = ()) -> None:
    content = {"cause": cause, "held": [h._asdict() for h in held], "released": list(released)}
    past = _log(spark, root)
    past.append(lambda n, last: None if any(e["cause"] == cause for e in past.entries()) else content)


def _run(spark: SparkSession, files: Sequence[str], schema: StructType, batch_id: int, root: str, steps: Sequence[Step]) -> BatchStatus:
    """One batch of whole files, below ``<root>/<table>/batch=<id>``, marked once it has succeeded."""
    rows = spark.read.schema(schema).parquet(*files)
    status = run_batch({"transactions": rows}, batch_id, root, steps, place=lambda name, b: f"{root}/{name}/batch={b}")
    if status.ok:
        finish_batch(spark, root, batch_id)
    return status


def run_files(
    spark: SparkSession, files: Sequence[str], schema: StructType, batch_id: int, root: str, steps: Sequence[Step]
) -> list[tuple[str, BatchStatus]]:
    """Run files as one batch or, if that fails, each by itself: (file, outcome) of those that
    were run alone. A file that was published before, by a batch cut short, is not run again."""
    whole = _run(spark, files, schema, batch_id, root, steps)
    if whole.ok:
        return []
    if len(files) == 1:
        return [(files[0], whole)]
    out, done = [], set(finished_batches(spark, root))
    for i, file in enumerate(sorted(files)):
        own = (batch_id + 1) * IDS + i
        if own in done:
            out.append((file, BatchStatus(own)))
            continue
        out.append((file, _run(spark, [file], schema, own, root, steps)))
    return out


def retry_quarantined(
    spark: SparkSession, schema: StructType, root: str, steps: Sequence[Step], attempts: int = ATTEMPTS
) -> dict[str, bool]:
    """Try files in quarantine again, if they have been changed or have attempts left. Returns
    for each file tried whether it was published. A file that is gone stays listed."""
    tried = {}
    for held in quarantined(spark, root).values():
        modified = _modified(spark, held.file)
        changed = modified != held.modified
        if modified < 0 or not (changed or held.attempts < attempts):
            continue
        n = 1 if changed else held.attempts + 1
        # ids of retries lie behind those of the batch's files
        own = (held.batch_id + 1) * IDS + IDS // 2 + _log(spark, root).latest()[0]
        status = _run(spark, [held.file], schema, own, root, steps)
        again = [] if status.ok else [held._replace(attempts=n, modified=modified, error=status.error)]
        _noted(spark, root, f"retry {own}", again, [held.file] if status.ok else [])
        tried[held.file] = status.ok
    return tried


def stream_with_quarantine(
    spark: SparkSession,
    source: str,
    schema: StructType,
    root: str,
    checkpoint: str,
    steps: Sequence[Step],
    attempts: int = ATTEMPTS,
    files_per_batch: int = FILES,
    on_done: Callable[[int, list[str]], None] | None = None,
):
    """Process what has arrived in ``source`` since the last run, after another try of what is
    in quarantine. A batch in which files fail does not stop the stream: ``on_done`` gets its
    id and the files put into quarantine. Every file is published once or held."""
    retry_quarantined(spark, schema, root, steps, attempts)

    def handle(names: DataFrame, batch_id: int) -> None:
        files = sorted(r["path"] for r in names.select("path").collect())
        if not files:
            return
        bad = [(f, s) for f, s in run_files(spark, files, schema, batch_id, root, steps) if not s.ok]
        if bad:
            held = [Held(f, batch_id, 1, _modified(spark, f), s.error) for f, s in bad]
            log.warning("batch %s: %s of %s files put into quarantine", batch_id, len(bad), len(files))
            _noted(spark, root, f"batch {batch_id}", held)
        if on_done:
            on_done(batch_id, [f for f, _ in bad])

    return (
        spark.readStream.format("binaryFile")
        .schema(FILE_NAMES)
        .option("pathGlobFilter", "*.parquet")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(source)
        .select("path")
        .writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def all_batches(spark: SparkSession, root: str, table: str, schema: StructType) -> DataFrame:
    """A table over all finished batches, in one scan."""
    paths = [f"{root}/{table}/batch={b}" for b in finished_batches(spark, root)]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{root}/{table}").parquet(*paths).select(*schema.names)
