"""Written relations, unused column names and bounded Arrow slices."""

from __future__ import annotations

import functools
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalograph.functions.shared import shuffles_dropped

SLICE_BYTES = 1 << 20


@functools.cache
def _single_machine_folder() -> str:
    return tempfile.mkdtemp(prefix="catalograph-llm-")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where it is unset, a session inside one process may use a local folder;
    a session with separate executors may not.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return _single_machine_folder()


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(frame: DataFrame, name: str) -> DataFrame:
    """Write a relation to the shared folder and read it back: survives lost executors."""
    path = new_path(frame.sparkSession, name)
    with shuffles_dropped(frame.sparkSession):
        frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def unused(frame: DataFrame, name: str) -> str:
    """``name``, prolonged until the frame has no such column (case is ignored)."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def text_column(frame: DataFrame, column: str = "text"):
    """A text as string, null as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bytes, row offsets) of runs of whole texts of about ``limit`` bytes; null is empty.

    A text longer than the limit is a run of its own, so memory follows the
    longest text and not the batch.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return
    _, where, data = texts.buffers()
    offsets = np.frombuffer(where, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    every = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    begin = 0
    while begin < len(texts):
        end = int(np.searchsorted(offsets, offsets[begin] + limit, "right")) - 1
        end = min(max(end, begin + 1), len(texts))
        yield every[offsets[begin]:offsets[end]], offsets[begin:end + 1] - offsets[begin]
        begin = end


def chunks(texts: pa.Array, cut_after: np.ndarray, limit: int = SLICE_BYTES
           ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, bool]]:
    """(bytes, offsets, row of each part, goes on) of runs of texts; null is empty.

    As ``slices``, but a text longer than the limit comes in several parts, each
    cut behind a byte that ``cut_after`` (256 flags) allows, and all but the
    first marked as going on. Where no such byte stands within the limit, the
    part ends at the next one.
    """
    done = 0
    for data, offsets in slices(texts, limit):
        n = len(offsets) - 1
        if n > 1 or len(data) <= limit:
            yield data, offsets, np.arange(done, done + n), False
        else:
            begin = 0
            while begin < len(data):
                end = begin + limit
                if end < len(data):
                    near = np.flatnonzero(cut_after[data[begin:end]])
                    if len(near):
                        end = begin + int(near[-1]) + 1
                    while not len(near) and end < len(data):
                        near = np.flatnonzero(cut_after[data[end:end + limit]])
                        end = end + int(near[0]) + 1 if len(near) else min(end + limit, len(data))
                part = data[begin:min(end, len(data))]
                yield part, np.array([0, len(part)]), np.array([done]), begin > 0
                begin = end
        done += n


_SHIPPED: set[str] = set()


# Rows and bytes of an Arrow batch of texts, where the session sets none.
_ARROW_LIMITS = {"spark.sql.execution.arrow.maxRecordsPerBatch": 1_000,
                 "spark.sql.execution.arrow.maxBytesPerBatch": 4 << 20}


def bound_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batches to the size of texts, unless it has set them itself."""
    for name, value in _ARROW_LIMITS.items():
        if spark.conf.get(name, None) is None:
            spark.conf.set(name, str(value))


def ship(spark: SparkSession) -> None:
    """Give the workers this package through Spark's file server, once for each application.

    Needed where their PYTHONPATH lacks it, as in a session that an outside script started.
    """
    bound_batches(spark)
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        root = Path(__file__).resolve().parents[2]
        target = Path(tempfile.mkdtemp(prefix="catalograph-package-")) / "catalograph.zip"
        with zipfile.ZipFile(target, "w") as package:
            for source in sorted((root / "catalograph").rglob("*.py")):
                package.write(source, source.relative_to(root))
        context.addPyFile(str(target))
        _SHIPPED.add(context.applicationId)
