"""Helpers that several text operators share."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.session import shared_folder

# The white space that separates words everywhere in this package: blank and \t\n\v\f\r.
SPACES = r"[\x20\x09-\x0D]"
SPACES_IN_BYTES = re.compile(SPACES.encode())
WORD_RUN_BYTES = 1 << 18


ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
SPARKS_DEFAULT, SMALL = "67108864b", "4194304b"


def small_batches(frame: DataFrame) -> DataFrame:
    """The same frame, after lowering what a session sends to Python at a time to 4 MB.

    Texts are long, and a batch is held by Spark, by Arrow and by Python at once. A size that the
    user has set stays.
    """
    conf = frame.sparkSession.conf
    if conf.get(ARROW_BYTES) == SPARKS_DEFAULT:
        conf.set(ARROW_BYTES, SMALL)
    return frame


def stored(frame: DataFrame, purpose: str) -> DataFrame:
    """The frame written to the shared folder and read back, which cuts its lineage."""
    folder = shared_folder(frame.sparkSession, purpose)
    frame.write.parquet(folder)
    return frame.sparkSession.read.schema(frame.schema).parquet(folder)


def only(frame: DataFrame, *names: str) -> DataFrame:
    """Just these columns, whatever else the table carries."""
    return frame.select(*(F.col(f"`{name}`") for name in names))


def free_name(frame: DataFrame, wanted: str) -> str:
    """A column name that the frame does not have, in any case."""
    taken = {name.lower() for name in frame.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def without(names: list[str], *dropped: str | None) -> list[str]:
    """The names but for those that a new column of the same name, in any case, replaces."""
    gone = {name.lower() for name in dropped if name is not None}
    return [name for name in names if name.lower() not in gone]


def word_runs(data: bytes) -> Iterator[list[bytes]]:
    """The words of a text in order, some at a time, so that a huge text needs little memory."""
    start, total = 0, len(data)
    while start < total:
        end = min(start + WORD_RUN_BYTES, total)
        if end < total:
            space = SPACES_IN_BYTES.search(data, end)
            end = space.start() if space else total
        yield data[start:end].split()
        start = end
