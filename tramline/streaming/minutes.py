"""Average delay per minute over a stream of delay events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tramline.functions.numbers import combine_totals
from tramline.operators.questions import averages_of_totals, minute_totals
from tramline.sinks import versions
from tramline.sources.files import delete, matching_paths

TOTALS = "utc_minute bigint, sum_sec bigint, sum_us bigint, n_delay bigint"
# Batches that are kept apart before they are merged.
MERGE_EVERY = 100
# Names of the logs below a table's folder.
BATCHES = "batches"
MERGED = "merged"


def _batch_folder(table: str, number: int) -> str:
    return f"{table}/batch={number}"


def _finished(spark: SparkSession, table: str) -> list[int]:
    """Numbers of the batches whose totals are whole."""
    return sorted(int(mark) for mark in versions.committed(spark, table, BATCHES))


def _merged(spark: SparkSession, table: str) -> tuple[str | None, int]:
    """Label of the newest merged table and the last batch that is in it."""
    writes = versions.committed(spark, table, MERGED)
    if not writes:
        return None, -1
    return writes[-1], versions.mark_of(spark, table, MERGED, writes[-1])["through"]


def add_batch(batch: DataFrame, number: int, table: str, merge_every: int = MERGE_EVERY) -> None:
    """Log the totals per minute of one batch, and merge when many have come together.

    A batch that is run again after a failure replaces its own folder, or is passed over
    when it has been merged already.
    """
    spark = batch.sparkSession
    through = _merged(spark, table)[1]
    if number <= through:
        return
    minute_totals(batch).write.mode("overwrite").parquet(_batch_folder(table, number))
    mark = f"{number:012d}"
    if mark not in versions.committed(spark, table, BATCHES):
        versions.commit(spark, table, BATCHES, mark, [])
    if number - through >= merge_every:
        merge_batches(spark, table)


def merge_batches(spark: SparkSession, table: str) -> int:
    """Fold all finished batches into one table, and how many they were.

    The merged table is a fresh folder whose mark names the last batch in it.  Until the
    mark is there, readers and the next merge see the earlier table and every batch, so a
    merge that breaks off at any point can be run again.  What a merge has replaced is kept for
    readers until the next one.
    """
    write, through = _merged(spark, table)
    numbers = [n for n in _finished(spark, table) if n > through]
    if not numbers:
        return 0
    fresh = versions.new_write(spark, table, MERGED)
    folder = f"{table}/{MERGED}/{versions.WRITE}{fresh}"
    totals = _totals(spark, table, write, numbers)
    totals.groupBy("utc_minute").agg(*combine_totals()).write.parquet(folder)
    versions.commit(spark, table, MERGED, fresh, [], through=numbers[-1])
    _clean(spark, table, through)
    return len(numbers)


def _clean(spark: SparkSession, table: str, through: int) -> None:
    """Remove the batches up to `through`, which the merged table before the newest holds too."""
    for path in matching_paths(spark, f"{table}/batch=*"):
        if int(path.rsplit("=", 1)[1]) <= through:
            delete(spark, path)
    for number in _finished(spark, table):
        if number <= through:
            delete(spark, f"{table}/{versions.MARKS}/{BATCHES}/{number:012d}.json")
    versions.drop_superseded(spark, table, MERGED, keep=2)


def _totals(
    spark: SparkSession, table: str, write: str | None, numbers: list[int]
) -> DataFrame:
    """Rows of the merged table and of some batches."""
    folders = [_batch_folder(table, n) for n in numbers]
    if write is not None:
        folders.append(f"{table}/{MERGED}/{versions.WRITE}{write}")
    if not folders:
        return spark.createDataFrame([], TOTALS)
    return spark.read.schema(TOTALS).parquet(*folders)


def append_minute_totals(
    delays: DataFrame, table: str, state: str, merge_every: int = MERGE_EVERY
) -> StreamingQuery:
    """Add the totals per minute of each batch to `table`, until the source has no more.

    Totals of a minute add up over batches, so no event is late: there is no watermark, no
    state to keep, and any split of the input into batches gives the same averages.  Every
    `merge_every` batches are folded into one table, so a reader opens at most that
    many folders beside it.  `table` and `state` belong together: a new `state` starts over at batch 0.
    """
    return (
        delays.writeStream.foreachBatch(lambda b, n: add_batch(b, n, table, merge_every))
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )


def streamed_delay_by_minute(spark: SparkSession, table: str) -> DataFrame:
    """Mean delay per Paris minute over all batches so far, as the batch question gives it."""
    write, through = _merged(spark, table)
    later = [n for n in _finished(spark, table) if n > through]
    return averages_of_totals(_totals(spark, table, write, later))
