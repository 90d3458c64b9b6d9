"""Quality rules by cross-document line frequency.

One pass over the whole texts gives each document's word statistics and its distinct normalised lines as hashes. The
lines are counted by host over documents (partial sums before the shuffle), those above the limit are joined back (the
hottest ones without a shuffle by line), and a document that loses too much of itself is rejected.

Null text has no words and fails the base rules. Each row is one document, repeated rows too: their lines count once per
row. A null host is a host of its own. Long texts are taken whole. An empty table gives no rows. Only the id, text and
host columns are read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableforge.llm import common

#: Fixed values of the base rules.
WINDOW, LEAST_WORDS, REPEAT_PERCENT = 5, 10, 20
SYMBOLS = "#*$%&|<>"
#: A line counts as boilerplate if over LIMIT documents of its host hold it, however many the host has.
LIMIT = 10
#: A document is rejected if boilerplate lines hold at least this share of its word characters.
DEPLETED = 0.5
#: A line that more documents of a host hold is hot. Up to HOT_LINES hot lines are broadcast (40 bytes each); if there are
#: more, they are joined with SALTS salts.
HOT_DOCS, HOT_LINES, SALTS = 50_000, 100_000, 64
_DIGITS = re.compile(rb"\d+")
_BLANK = b" \t\n\x0b\x0c\r"


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of five words found at least twice in the text."""
    grams = list(zip(words, words[1:], words[2:], words[3:], words[4:], strict=False))
    if len(set(grams)) == len(grams):
        return 0
    number: dict[tuple, int] = {}
    ids = np.array([number.setdefault(g, len(number)) for g in grams])
    at = np.flatnonzero(np.bincount(ids)[ids] > 1)
    edge = np.bincount(at, minlength=len(words) + 1) - np.bincount(at + WINDOW, minlength=len(words) + 1)
    return int((np.cumsum(edge) > 0).sum())


def normal_line(line: bytes) -> bytes:
    return _DIGITS.sub(b"0", b" ".join(line.lower().split()))


def line_statistics(df: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    """The base figures of each document and its distinct normalised lines (hash, word characters in all copies)."""
    drop = bytes.maketrans(b"", b"")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        figures, hashes, chars, ends = [], [], [], [0]
        for text in batch.column(1).fill_null("").to_pylist():
            raw = text.encode("utf-8", "surrogatepass")
            words, lines = raw.split(), [x for x in raw.split(b"\n") if x.strip(_BLANK)]
            own: dict[int, int] = {}
            for line in lines:
                key = xxhash.xxh64_intdigest(normal_line(line))
                own[key] = own.get(key, 0) + sum(map(len, line.split()))
            word_chars = len(text) - (len(raw) - len(raw.translate(drop, _BLANK)))
            figures.append((len(words), word_chars, len(raw) - len(raw.translate(drop, SYMBOLS.encode())), len(lines) - len(set(lines)), repeated_words(words), sum(own.values())))
            hashes += own.keys()
            chars += own.values()
            ends.append(len(hashes))
        lines = pa.StructArray.from_arrays([pa.array(np.array(hashes, np.uint64).view(np.int64)), pa.array(chars, pa.int64())], ["line", "chars"])
        columns = [batch.column(0), batch.column(2), *(pa.array(x, pa.int64()) for x in zip(*figures, strict=True)), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), lines)]
        return pa.RecordBatch.from_arrays(columns, ["id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "line_bytes", "lines"])

    kind = df.schema[id_col].dataType.simpleString()
    return common.map_arrow(
        df.select(id_col, text_col, F.col(host_col).cast("string").alias("_host")), run, f"id {kind}, host string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, line_bytes long, lines array<struct<line:long,chars:long>>"
    )


def line_rules(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", limit: int = LIMIT, depleted: float = DEPLETED) -> DataFrame:
    """id, the base figures, base_failed, kept, n_removed_lines and removed_share of every document."""
    docs = common.materialise(line_statistics(df, id_col, text_col, host_col).withColumn("uid", F.monotonically_increasing_id()), "lines")
    host = F.coalesce(F.concat(F.lit("h"), "host"), F.lit("")).alias("h")
    lines = docs.select("uid", host, F.explode("lines").alias("x")).select("uid", "h", "x.line", "x.chars")
    counts = lines.groupBy("h", "line").agg(F.count("*").alias("docs")).where(F.col("docs") > limit)
    common_lines = common.materialise(counts, "common-lines")
    hot = common_lines.where(F.col("docs") > HOT_DOCS).select("h", "line", F.lit(True).alias("hot"))
    if hot.limit(HOT_LINES + 1).count() <= HOT_LINES:
        flagged = lines.join(F.broadcast(hot), ["h", "line"], "left")
    else:
        salted = hot.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        flagged = lines.withColumn("salt", F.pmod(F.xxhash64("uid"), F.lit(SALTS)).cast("int")).join(salted, ["h", "line", "salt"], "left").drop("salt")
    # hot lines are removed where they stand; only rows of other lines are shuffled by line
    others = flagged.where("hot IS NULL").join(common_lines.where(F.col("docs") <= HOT_DOCS), ["h", "line"], "left_semi")
    removed = flagged.where("hot").select("uid", "chars").unionByName(others.select("uid", "chars")).groupBy("uid").agg(F.count("*").alias("n_removed_lines"), F.sum("chars").alias("removed"))
    base_failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    share_of = F.when(F.col("line_bytes") > 0, F.coalesce("removed", F.lit(0)) / F.col("line_bytes")).otherwise(0.0)
    out = docs.drop("lines", "host").join(removed, "uid", "left").withColumns({"base_failed": base_failed, "removed_share": share_of})
    return out.select(
        F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.col("removed_share") < depleted)).alias("kept"), F.coalesce("n_removed_lines", F.lit(0)).cast("long").alias("n_removed_lines"), "removed_share",
    )


def op6_line_frequency_rules(spark, sf_dir: str) -> DataFrame:
    return line_rules(common.documents(spark, sf_dir, "doc_id", "text", "source"))
