"""Writes that readers see whole or not at all.

Every write of a table or snapshot goes to a fresh folder `write=<number>-<id>`. A mark, one small
JSON file `<root>/_committed/<name>/<write>.json`, is put in place by a rename once its data is whole.
Readers take the newest write that has a mark and keep reading its files whatever is
written later; a write that was killed has no mark and stays unseen. One writer at a time writes a name.

Marks also hold the column list of their write, so the headers of text files are known
without opening them.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.sources.files import delete, matching_paths, put_file, read_file

MARKS = "_committed"
WRITE = "write="


def _marks(root: str, name: str) -> str:
    return f"{root}/{MARKS}/{name}"


def committed(spark: SparkSession, root: str, name: str) -> list[str]:
    """Finished writes, oldest first."""
    paths = matching_paths(spark, f"{_marks(root, name)}/*.json")
    return sorted(path.rsplit("/", 1)[-1].removesuffix(".json") for path in paths)


def new_write(spark: SparkSession, root: str, name: str) -> str:
    """Label of a write that comes after all finished ones."""
    last = committed(spark, root, name)[-1:]
    number = 1 + max((int(write.split("-")[0]) for write in last), default=0)
    return f"{number:08d}-{uuid.uuid4().hex[:8]}"


def commit(
    spark: SparkSession, root: str, name: str, write: str, columns: Sequence[str], **more
) -> None:
    """Make a write seen; `more` is kept in the mark."""
    mark = json.dumps({"columns": list(columns), **more})
    put_file(spark, f"{_marks(root, name)}/{write}.json", mark)


def mark_of(spark: SparkSession, root: str, name: str, write: str) -> dict:
    return json.loads(read_file(spark, f"{_marks(root, name)}/{write}.json"))


def newest(spark: SparkSession, root: str, name: str) -> str:
    """Folder of the newest write of a table."""
    writes = committed(spark, root, name)
    if not writes:
        raise FileNotFoundError(f"no finished write of {root}/{name}")
    return f"{root}/{name}/{WRITE}{writes[-1]}"


def newest_of_each(spark: SparkSession, pattern: str) -> list[str]:
    """For every folder `<root>/<name>/<part>` a glob names, its newest write.

    What the glob names and holds no write, such as a file from elsewhere, is given as it is.
    """
    given = matching_paths(spark, pattern)
    chosen: dict[str, str] = {}
    finished: dict[str, set[str]] = {}
    written = set()
    for path in matching_paths(spark, f"{pattern}/{WRITE}*"):
        folder, write = path.rsplit(f"/{WRITE}", 1)
        written.add(folder)
        root, name, _ = folder.rsplit("/", 2)
        if folder.rsplit("/", 1)[0] not in finished:
            finished[f"{root}/{name}"] = set(committed(spark, root, name))
        if write in finished[f"{root}/{name}"]:
            chosen[folder] = path  # in name order, so the newest stays
    return [chosen.get(path, path) for path in given if path in chosen or path not in written]


def column_lists(spark: SparkSession, folder: str) -> DataFrame:
    """(file_key, columns) of every finished write of `<root>/<name>`, read from the marks."""
    root, name = folder.rsplit("/", 1)
    marks = spark.read.schema("columns array<string>").json(f"{_marks(root, name)}/*.json")
    write = F.regexp_extract(F.col("_metadata.file_path"), r"/([^/]*)\.json$", 1)
    return marks.select(F.concat(F.lit(WRITE), write).alias("file_key"), "columns")


def drop_superseded(spark: SparkSession, root: str, name: str, keep: int = 1) -> int:
    """Delete all but the newest `keep` writes of a table, and how many there were.

    For use when nobody reads the older ones any more.
    """
    old = committed(spark, root, name)[: -keep or None]
    for write in old:
        # The mark goes first: a write without data is never seen.
        delete(spark, f"{_marks(root, name)}/{write}.json")
        delete(spark, f"{root}/{name}/{WRITE}{write}")
    return len(old)
