"""Fill-in-middle transformation of whole texts, cut at line ends.

A text's lines form an indexable skip list: each express lane carries, for every
link, how many lines and how many code points it passes over. A cut at a rank of
lines is reached by descending from the highest lane and summing up what the links
passed over, which yields its place in code points exactly, in steps that grow with
the logarithm of the number of lines. What is cut out goes behind the rest.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 7
RATE = 100  # percent of texts that are transformed
SUFFIX_FIRST = 50  # percent of those that begin with the suffix
CLIMB = 4  # one tower in so many reaches the next lane

DRAWS = ("h1", "h2", "h3", "h4")


def unit_widths(text: str) -> list[int]:
    """Code points of every line, its line feed included; an empty text has none."""
    *ended, rest = text.split("\n")
    widths = [len(line) + 1 for line in ended]
    return widths + [len(rest)] if rest else widths


def _heights(n: int) -> np.ndarray:
    """How many lanes up each of the towers 0 to n - 1 reaches: geometric, drawn from its place; tower 0 reaches all."""
    x = np.arange(n, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    share = ((x >> np.uint64(11)) + np.uint64(1)) / 2.0**53
    heights = np.floor(-np.log(share) / np.log(CLIMB)).astype(np.int64)
    heights[:1] = heights.max(initial=0)
    return heights


class SkipList:
    """Lanes of towers; a link of a lane knows the lines and code points up to the next tower."""

    def __init__(self, widths: list[int]):
        units, points = np.ones(len(widths), np.int64), np.asarray(widths, np.int64)
        heights = _heights(len(widths))
        self.lanes: list[tuple[list[int], list[int], list[int]]] = []
        down = np.arange(len(widths) + 1)
        while True:
            self.lanes.append((units.tolist(), points.tolist(), down.tolist()))
            up = np.flatnonzero(heights >= len(self.lanes))
            if len(up) < 2:
                break
            units, points, heights = np.add.reduceat(units, up), np.add.reduceat(points, up), heights[up]
            # The same tower one lane below; the end of a lane leads to the end of the one below.
            down = np.append(up, len(self.lanes[-1][0]))

    def place(self, rank: int) -> int:
        """Code points before the line of that rank; all of them at the last rank."""
        units = points = tower = 0
        for lane_units, lane_points, down in reversed(self.lanes):
            while tower < len(lane_units) and units + lane_units[tower] <= rank:
                units += lane_units[tower]
                points += lane_points[tower]
                tower += 1
            tower = down[tower]
        return points


def transform(text: str, h1: int, h2: int, h3: int, h4: int, rate: int, suffix_first: int) -> tuple[int, str, int | None, int | None, str]:
    """(lines, form, code points of prefix and middle, output) of one text."""
    widths = unit_widths(text)
    n = len(widths)
    if not text or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= rate:
        return n, "plain", None, None, text
    lines = SkipList(widths)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = lines.place(a), lines.place(b)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < suffix_first:
        return n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def draws(doc_id: Column, seed: int = SEED) -> list[Column]:
    """Four numbers per document, from the digest of seed and id; a NULL id counts as an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(name) for k, name in enumerate(DRAWS)]


def fill_in_middle(docs: DataFrame, rate: int = RATE, suffix_first: int = SUFFIX_FIRST, seed: int = SEED) -> DataFrame:
    """One row per row of ``docs``: doc_id, n, form, prefix_chars, middle_chars, output.

    Only doc_id and text are read, so other columns may have any name. A NULL or
    empty text, one that holds a mark, and one beyond ``rate`` stays as it is
    (``plain``, without character counts). Rows that repeat a doc_id are cut by the
    same draws, so equal rows give equal rows. An empty table gives an empty table.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(name).to_pylist() for name in ("text", *DRAWS)]
            made = [transform(*row, rate, suffix_first) for row in zip(*columns, strict=True)]
            n, form, prefix, middle, output = zip(*made, strict=True) if made else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()), pa.array(output, pa.string())],
                ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *draws(F.col("doc_id")))
    return rows.mapInArrow(cut, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column) -> Column:
    """The text an output was made from: marks occur in no cut text, so they part its pieces without doubt."""
    body = F.substring(output, len(PREFIX) + 1, 2**31 - 1)

    def pieces(*marks: str) -> Column:
        return F.split(body, "|".join(re.escape(m) for m in marks), -1)

    psm, spm = pieces(SUFFIX, MIDDLE), pieces(PREFIX, MIDDLE)
    return (
        F.when(form == "psm", F.concat(psm[0], psm[2], psm[1]))
        .when(form == "spm", F.concat(spm[1], spm[2], spm[0]))
        .otherwise(output)
    )


def infill_report(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n, form, prefix_chars, middle_chars and the digests of the output and of the text rebuilt from it."""
    made = fill_in_middle(docs)
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )
