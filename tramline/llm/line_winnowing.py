"""Line dedup: winnowed runs of line hashes, later repeats deleted.

A run is a stretch of consecutive non-blank lines. Every line opens the shortest run of at
least `min_words` words that starts with it and closes the shortest one that ends with it: its
windows. Two equal stretches of at least `min_words` words hold equal windows, so none can be missed.

* Winnowing: each window selects its smallest line hash, the first of equal ones, as its
  fingerprint. Equal windows select the same line of theirs, so a repeated stretch is guaranteed to
  leave a fingerprint that occurs at several places. Neighbouring windows mostly select the same
  line; a place that was selected is one row, with the windows it stands for.
* Places are joined with the fingerprints that several places have. All others are done.
* Places that share a fingerprint are not compared pair by pair, as a common line has very many:
  each of their windows, by a digest of all its line hashes, meets the earliest equal one.
* Matches extend both ways line by line, as the windows that start and that end at each line
  of a repeated stretch reach from its first line to its last.

A window is a repeat if an equal one came before it, by doc_id and then by line, and if the
two do not overlap inside one document. All lines of repeats are deleted, with blank lines
inside them; each deleted line so keeps an equal line further up. Everything runs as SQL
functions; groups of any size shrink to one earliest row before they are joined.

Defined cases: a null text stays null and has no lines; an empty text has one blank line and
stays; a very long text is one row until its lines are cut, which are split at line feeds only; rows that agree in doc_id and text are one document
and get the same result; a null doc_id sorts first; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tramline.llm.tables import field, join_same, packed, stored, unpacked

MIN_WORDS = 50

# ASCII white space only, as in the SQL that checks this operator.
WORD = r"[^\x09-\x0D\x20]+"

KEYS = ("document", "version")


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_table(documents: DataFrame) -> DataFrame:
    """(document, version, line_no, hash, words) of each line that has a word, once each.

    `version` tells rows apart that share a doc_id but not the text.
    """
    lines = documents.select(
        F.col("doc_id").alias("document"),
        F.xxhash64("text").alias("version"),
        F.posexplode(_lines(F.col("text"))).alias("line_no", "line"),
    ).select(
        *KEYS,
        "line_no",
        F.xxhash64("line").alias("hash"),
        F.regexp_count("line", F.lit(WORD)).alias("words"),
    )
    return lines.filter("words > 0").repartition(*KEYS).dropDuplicates([*KEYS, "line_no"])


def runs(lines: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Each line's windows: (document, version, first, last, content, selected).

    `selected` is the smallest line hash of the window and where it is.
    """
    document = Window.partitionBy(*KEYS)
    counted = lines.withColumn(
        "through", F.sum("words").over(document.orderBy("line_no"))
    ).withColumn("before", F.col("through") - F.col("words"))
    ahead = document.orderBy("before").rangeBetween(0, min_words - 1)
    behind = document.orderBy("through").rangeBetween(1 - min_words, 0)

    def window(frame) -> Column:
        return F.struct(
            F.min("line_no").over(frame).alias("first"),
            F.max("line_no").over(frame).alias("last"),
            F.sum("words").over(frame).alias("total"),
            F.min(F.struct("hash", "line_no")).over(frame).alias("selected"),
            F.xxhash64(F.collect_list("hash").over(frame)).alias("content"),
        )

    both = counted.select(*KEYS, window(ahead).alias("ahead"), window(behind).alias("behind"))
    either = both.select(
        *KEYS,
        F.explode(
            F.when(F.col("ahead.last") == F.col("behind.first"), F.array("ahead")).otherwise(
                F.array("ahead", "behind")
            )
        ).alias("window"),
    )
    return either.select(*KEYS, "window.*").filter(F.col("total") >= min_words).drop("total")


def fingerprints(windows: DataFrame) -> DataFrame:
    """(document, version, fingerprint, line_no, windows): every selected place, once."""
    return windows.groupBy(
        *KEYS, F.col("selected.hash").alias("fingerprint"), F.col("selected.line_no")
    ).agg(F.collect_list(F.struct("first", "last", "content")).alias("windows"))


def matched(places: DataFrame) -> DataFrame:
    """Windows of the places whose fingerprint several places have."""
    shared = stored(
        places.groupBy("fingerprint").agg(F.count("*").alias("times")).filter("times > 1"),
        "line-fingerprints",
    )
    return places.join(shared, "fingerprint").select(*KEYS, "fingerprint", F.inline("windows"))


def repeated_lines(documents: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(document, version, deleted): line numbers of every later repeat, by document."""
    places = stored(fingerprints(runs(line_table(documents), min_words)), "line-places")
    found = stored(matched(places), "line-windows")
    key = ("fingerprint", "content")
    earliest = stored(
        found.groupBy(*key)
        .agg(F.count("*").alias("times"), F.min(F.struct(*KEYS, "first", "last")).alias("source"))
        .filter("times > 1")
        .drop("times"),
        "line-sources",
    )
    place = F.struct(*KEYS, "first")
    source = F.struct(*(f"source.{name}" for name in (*KEYS, "first")))
    overlapping = (
        F.col("document").eqNullSafe(F.col("source.document"))
        & (F.col("version") == F.col("source.version"))
        & (F.col("first") <= F.col("source.last"))
    )
    later = found.join(earliest, [*key]).filter((place > source) & ~overlapping)
    return (
        later.select(*KEYS, F.explode(F.sequence("first", "last")).alias("line_no"))
        .groupBy(*KEYS)
        .agg(F.collect_set("line_no").alias("deleted"))
    )


def dedup_lines(documents: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, text, n_lines, n_deleted): each row's text without its repeated runs."""
    text = field("text")
    n_lines, n_deleted = F.size(_lines(text)), F.size("deleted")
    return _with_deletions(documents.select("doc_id", "text"), min_words).select(
        field("doc_id").alias("doc_id"),
        _clean(text).alias("text"),
        F.when(text.isNull(), 0).otherwise(n_lines).cast("long").alias("n_lines"),
        F.when(F.col("deleted").isNull(), 0).otherwise(n_deleted).cast("long").alias("n_deleted"),
    )


def without_repeated_lines(documents: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The rows with all their columns; `text` is cleaned and `n_chars`, if any, follows it."""
    clean = _with_deletions(documents, min_words).withColumn("clean", _clean(field("text")))
    changed = {"text": F.col("clean")}
    if "n_chars" in documents.columns:
        length = F.length("clean").cast(documents.schema["n_chars"].dataType)
        after = F.when(F.col("deleted").isNotNull(), length)
        changed["n_chars"] = F.coalesce(after, field("n_chars"))
    return unpacked(clean, documents, **changed)


def _with_deletions(rows: DataFrame, min_words: int) -> DataFrame:
    keyed = packed(rows, document=F.col("doc_id"), version=F.xxhash64("text"))
    return join_same(keyed, repeated_lines(rows, min_words), list(KEYS), "left")


def _clean(text: Column) -> Column:
    lines = _lines(text)
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("deleted"))
    joined = F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")
    return F.when(F.col("deleted").isNull(), text).otherwise(joined)
