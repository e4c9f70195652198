"""Export of single files, written by the tasks that hold the rows."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

WRITTEN = "content_hash string, local_path string, source_file string, image_size long, error string"


def missing_files(df: DataFrame, folder: str, name: str = "file_name") -> DataFrame:
    """Rows whose file does not exist in ``folder`` yet.

    Each task looks up its own names on the shared path; the folder is never listed as a whole.
    """

    def absent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(name).to_pylist()
            yield batch.filter(pa.array([not os.path.exists(os.path.join(folder, n)) for n in names]))

    return df.mapInArrow(absent, df.schema)


def export_files(
    df: DataFrame,
    folder: str,
    blob: str = "image",
    name: str = "file_name",
    encoder: Callable[[object], bytes] | None = None,
) -> DataFrame:
    """Write ``blob`` of each row to ``folder/name`` and return what came of each row.

    ``folder`` must be a path that every node mounts; a name may have folders in it. A file gets its name only when it is complete,
    and the name comes from the content, so a retried task writes the same file again. A row whose
    encoder fails, or that comes with an ``error``, has no path but the reason, and is tried again by
    the next run. The files are written when the result is, so store the result once.
    """
    known = F.col("error") if "error" in df.columns else F.lit(None).cast("string")
    needed = df.select("content_hash", name, "source_file", blob, known.alias("error"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.makedirs(folder, exist_ok=True)
        made: set[str] = set()
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                if row["error"] is not None:
                    done.append((row["content_hash"], None, row["source_file"], None, row["error"]))
                    continue
                try:
                    data = encoder(row[blob]) if encoder else row[blob]
                except Exception as error:  # whatever the caller's code raises is the row's reason
                    reason = f"{type(error).__name__}: {error}"
                    done.append((row["content_hash"], None, row["source_file"], None, reason))
                    continue
                target = os.path.join(folder, row[name])
                if os.path.dirname(target) not in made:
                    os.makedirs(os.path.dirname(target), exist_ok=True)
                    made.add(os.path.dirname(target))
                part = f"{target}.{uuid.uuid4().hex}.part"
                with open(part, "wb") as out:
                    out.write(data)
                os.replace(part, target)
                done.append((row["content_hash"], target, row["source_file"], len(data), None))
            columns = list(zip(*done)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(columns[0], pa.string()),
                    pa.array(columns[1], pa.string()),
                    pa.array(columns[2], pa.string()),
                    pa.array(columns[3], pa.int64()),
                    pa.array(columns[4], pa.string()),
                ],
                names=["content_hash", "local_path", "source_file", "image_size", "error"],
            )

    return needed.mapInArrow(write, WRITTEN)
