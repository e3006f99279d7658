"""Line deduplication with keep bitmaps, in DataFrame operations only.

The hashes of all long lines are range-partitioned by (hash, document) and sorted
by document and position within, so that a line shared by a third of all
documents spreads over many partitions. A pass over that order gives one row per
hash and document, another one the number of documents and the document that
keeps the line. What comes back is a bitmap per document, never text: words of 64
lines, of which only those with a dropped line are stored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..workspace import sized, stage

LEAST_CHARS = 40
LEAST_DOCUMENTS = 5
WORD_LINES = 64
BLANKS = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def keep_bitmaps(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, dropped, n_dropped) for every document that loses lines.

    ``dropped`` maps a word number to 64 bits; bit p % 64 of word p / 64 is set
    if line p goes. A document without an entry keeps all its lines.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where(
        "doc_id is not null and text is not null"
    )
    lines = rows.select("doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(_lines(F.col("text"))).alias("position", "line"))
    # Trimmed at both ends; the text is already cut at \n.
    stripped = lines.withColumn("line", F.btrim("line", F.lit(BLANKS))).where(F.char_length("line") >= LEAST_CHARS)
    key = F.translate("line", UPPER, LOWER)
    hashed = stripped.select("doc_id", "text_hash", "position", F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2"))

    ordered = stage(
        hashed.repartitionByRange("h1", "h2", F.desc("doc_id")).sortWithinPartitions(
            "h1", "h2", F.desc("doc_id"), "text_hash", "position"
        ),
        "lines",
    )
    held = ordered.select("h1", "h2", "doc_id").distinct()
    repeated = (
        held.groupBy("h1", "h2")
        .agg(F.count("*").alias("documents"), F.max("doc_id").alias("keeper"))
        .where(F.col("documents") >= LEAST_DOCUMENTS)
        .drop("documents")
    )
    # Few lines are in many documents; as long as they are, no line has to travel to meet them.
    repeated = sized(stage(repeated, "repeated"))
    word = F.floor(F.col("position") / WORD_LINES).cast("int")
    bit = F.expr(f"shiftleft(1L, cast(position % {WORD_LINES} as int))")
    words = (
        ordered.join(repeated, ["h1", "h2"])
        .where("doc_id <> keeper")
        .groupBy("doc_id", "text_hash", word.alias("word"))
        .agg(F.bit_or(bit).alias("bits"))
    )
    return words.groupBy("doc_id", "text_hash").agg(
        F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("dropped"),
        F.sum(F.bit_count("bits")).cast("long").alias("n_dropped"),
    )


def deduplicate_lines(docs: DataFrame) -> DataFrame:
    """(row, n_lines, n_dropped, kept_text), ``row`` holding all columns of ``docs``.

    A NULL or empty text is one empty line. A line's key is the line without
    ASCII blanks at its ends, A-Z lower-cased. Keys of at least 40 code points in
    at least 5 documents stay only in the largest doc_id that holds them, there
    with all their lines. Rows that repeat a doc_id are one document; rows
    without doc_id lose nothing and count for nothing.
    """
    found = stage(keep_bitmaps(docs), "bitmaps")
    rows = docs.select(F.struct(*docs.columns).alias("row"))
    text = F.col("row.text").cast("string")
    joined = rows.join(
        found, (F.col("row.doc_id").cast("long") == F.col("doc_id")) & (F.xxhash64(text) == F.col("text_hash")), "left"
    )
    stays = F.array_join(
        F.filter(
            _lines(text),
            lambda line, at: F.coalesce(F.element_at("dropped", F.floor(at / WORD_LINES).cast("int")), F.lit(0).cast("long")).bitwiseAND(
                F.call_function("shiftleft", F.lit(1).cast("long"), (at % WORD_LINES).cast("int"))
            )
            == 0,
        ),
        "\n",
    )
    return joined.select(
        "row",
        F.size(_lines(text)).cast("long").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("n_dropped").isNull(), F.coalesce(text, F.lit(""))).otherwise(stays).alias("kept_text"),
    )


def line_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256."""
    return deduplicate_lines(docs.select("doc_id", "text")).select(
        F.col("row.doc_id").cast("long").alias("doc_id"), "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def without_repeated_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated lines taken out of ``text``; ``n_chars`` follows, other columns stay."""
    new = {"text": F.col("kept_text"), "n_chars": F.char_length("kept_text")}
    columns = [
        F.when(F.col("n_dropped") > 0, new[f.name].cast(f.dataType)).otherwise(F.col(f"row.{f.name}")).alias(f.name)
        if f.name in new
        else F.col(f"row.{f.name}").alias(f.name)
        for f in docs.schema.fields
    ]
    return deduplicate_lines(docs).select(*columns)
