"""Record sink with exactly-once commits (S11, R3): a Python data source.

Every task writes its records to a file of its own below ``data/<batch>`` and
tells the driver its name; when all tasks are through, the driver writes one
manifest ``commits/<batch>.json`` that names the files. Readers see the files of
manifests only, so what failed or repeated tasks, aborted jobs and lost
executors leave behind is never read. A batch that has a manifest is not
published again: a retry leaves the first result. Batches need names that a
retry repeats, such as a stream's batch id; a batch has one writer at a time.

``path`` is a folder that all executors share, as a plain path or a URI that
``pyarrow.fs`` knows.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

FORMAT = "committed_records"
SCHEMA = "feed STRING, key STRING, value STRING"


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if ":" in path else (fs.LocalFileSystem(), path)


@dataclass
class Written(WriterCommitMessage):
    file: str | None
    rows: int


class CommittedRecords(DataSource):
    """Options: ``path`` and ``batch``, a name of letters, digits and ``-_.``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def writer(self, schema, overwrite: bool) -> "CommitWriter":
        batch = self.options.get("batch", "")
        if overwrite or not batch or not all(c.isalnum() or c in "-_." for c in batch):
            raise ValueError("records are appended under a batch name of letters, digits and -_.")
        return CommitWriter(self.options["path"].rstrip("/"), batch)


class CommitWriter(DataSourceArrowWriter):
    def __init__(self, path: str, batch: str):
        self.path, self.batch = path, batch

    def write(self, iterator) -> Written:
        """Runs in a task: one file of JSON lines, none without rows."""
        system, root = _open(self.path)
        name, rows, out = f"{self.batch}/{uuid.uuid4().hex}.json", 0, None
        for b in iterator:
            if not b.num_rows:
                continue
            if out is None:
                system.create_dir(f"{root}/data/{self.batch}", recursive=True)
                out = system.open_output_stream(f"{root}/data/{name}")
            out.write("".join(json.dumps(r) + "\n" for r in b.to_pylist()).encode())
            rows += b.num_rows
        if out is None:
            return Written(None, 0)
        out.close()
        return Written(name, rows)

    def commit(self, messages) -> None:
        system, root = _open(self.path)
        files = sorted(m.file for m in messages if m and m.file)
        manifest = f"{root}/commits/{self.batch}.json"
        if system.get_file_info(manifest).type != fs.FileType.NotFound:
            return self.abort(messages)  # published before
        system.create_dir(f"{root}/commits", recursive=True)
        # a leading underscore hides the draft from readers
        draft = f"{root}/commits/_{self.batch}-{uuid.uuid4().hex}"
        with system.open_output_stream(draft) as out:
            for f in files or [None]:
                out.write((json.dumps({"batch": self.batch, "file": f}) + "\n").encode())
        system.move(draft, manifest)

    def abort(self, messages) -> None:
        system, root = _open(self.path)
        for m in messages:
            if m and m.file:
                system.delete_file(f"{root}/data/{m.file}")


def publish(records: DataFrame, path: str, batch: str) -> None:
    """Append ``(feed, key, value)`` under ``path`` as ``batch``, once."""
    spark = records.sparkSession
    spark.dataSource.register(CommittedRecords)
    (records.select(*(F.col(c).cast("string").alias(c) for c in ("feed", "key", "value")))
     .write.format(FORMAT).option("path", path).option("batch", batch).mode("append").save())


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records of committed batches. The manifests are joined with the
    names of the files that are read; no list goes through the driver."""
    system, root = _open(path.rstrip("/"))
    if any(system.get_file_info(f"{root}/{d}").type == fs.FileType.NotFound for d in ("commits", "data")):
        return spark.createDataFrame([], SCHEMA)
    commits = (spark.read.schema("batch STRING, file STRING").json(f"{path.rstrip('/')}/commits")
               .where("file is not null").select(F.substring_index("file", "/", -1).alias("_file")))
    rows = (spark.read.schema(SCHEMA).option("recursiveFileLookup", True).json(f"{path.rstrip('/')}/data")
            .select("feed", "key", "value", F.col("_metadata.file_name").alias("_file")))
    return rows.join(commits, "_file", "left_semi").drop("_file")
