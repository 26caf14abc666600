"""Quality rules with cross-document line frequency (DataFrame functions only).

Base rules look at one text alone. The corpus rule hashes normalised lines,
counts on how many distinct documents of the same host each line stands, and
treats a line as boilerplate of the host where that count is above the limit.
Boilerplate lines are removed, except in the earliest document of the host that
holds them, so that a group of copies always leaves one whole document. A
document is depleted, and rejected, if it keeps less than the allowed share of
its words or fewer words than any document needs.

Defined cases
-------------
* Null text: no words, so ``base_failed``. An empty text is the same.
* Null id or host: an ordinary value of its own (all null hosts are one host).
* Rows that repeat in all of id, host and text get equal results, and texts
  that are equal count once in a line's frequency: exact copies do not turn
  their own lines into boilerplate.
* Ties between earliest documents: the smaller id, then the smaller text hash.
* Columns of the input beside the three that are named are neither read nor
  returned by ``verdicts``; ``apply`` returns them unchanged.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coldtide.llm.common import BLANKS, bind, spaced, words
from coldtide.session import staged


@dataclass(frozen=True)
class Limits:
    """``line_docs``: a line is boilerplate on more distinct documents of its
    host, whatever the host's size. ``min_left``: share of words that a document
    must keep, beside ``min_words`` of them."""

    min_words: int = 50
    repeat_percent: int = 50
    line_docs: int = 4
    min_left: float = 0.5


def repeated_words(tokens: Column) -> Column:
    """Words that lie in a 3-word window found twice or more.

    Windows are compared by hash. Texts without a repeat, nearly all, end at
    the size of the distinct hashes; only others sort (hash, position).
    """

    def covered(starts: Column) -> Column:
        gain = F.transform(starts, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(starts, k + 1) - p, F.lit(3))))
        return F.aggregate(gain, F.lit(0), lambda a, b: a + b)

    def again(pairs: Column) -> Column:
        same = F.filter(pairs, lambda x, i: (F.get(pairs, i - 1)["h"] == x["h"]) | (F.get(pairs, i + 1)["h"] == x["h"]))
        return bind(F.sort_array(F.transform(same, lambda x: x["i"])), covered)

    def hashed(h: Column) -> Column:
        pairs = F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(bind(F.sort_array(pairs), again))

    def windows(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(w) - 3)
        return F.when(F.size(w) < 4, F.lit(0)).otherwise(bind(F.transform(starts, lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))), hashed))

    return bind(tokens, windows)


def without(text: Column, marks: str) -> Column:
    for mark in marks:
        text = F.replace(text, F.lit(mark), F.lit(""))
    return text


def base_columns(text: Column) -> list[Column]:
    """The per-text measures as columns of longs."""
    whole = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    counted = bind(words(text), lambda w: F.struct(F.size(w).cast("long").alias("n"), repeated_words(w).cast("long").alias("r")))
    return [
        counted.alias("_counted"),
        F.length(without(whole, BLANKS)).cast("long").alias("word_chars"),
        (F.length(whole) - F.length(without(whole, "#*$%&|<>"))).cast("long").alias("n_symbols"),
        bind(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
    ]


def _rows(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    """Id, text and the hashes of text and host under names of our own."""
    return docs.select(docs[id_col].alias("_id"), docs[text_col].alias("_text"), F.xxhash64(docs[text_col]).alias("_t"), F.xxhash64(docs[host_col].isNull(), docs[host_col]).alias("_host"))


def _lines(rows: DataFrame) -> DataFrame:
    """One row per line with a word: document key, position, words, line key."""
    one = rows.select("_id", "_t", "_host", F.posexplode(F.split("_text", "\n")).alias("_pos", "_line"))
    line = F.trim(spaced(F.lower("_line")))
    one = one.withColumn("_line", line).withColumn("_line", F.when(F.contains(F.col("_line"), F.lit("  ")), F.regexp_replace("_line", " +", " ")).otherwise(F.col("_line"))).where("_line <> ''")
    return one.select("_id", "_t", "_host", "_pos", (F.length("_line") - F.length(F.replace("_line", F.lit(" "), F.lit(""))) + 1).alias("_w"), F.xxhash64("_host", "_line").alias("_key"))


def boilerplate(lines: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Line keys above the limit, with the earliest document of each.

    Two aggregations, both combined map-side: (line, text) pairs first, so that
    a hot line's documents spread over all tasks, then lines.
    """
    pairs = lines.groupBy("_key", "_t").agg(F.min(F.struct(F.col("_id").isNull().alias("n"), F.col("_id").alias("id"), F.col("_t").alias("t"))).alias("_first"))
    return pairs.groupBy("_key").agg(F.count("*").alias("_n"), F.min("_first").alias("_first")).where(F.col("_n") > limits.line_docs).select("_key", "_first")


def removals(rows: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Per document key: the words lost and the positions of removed lines.

    Lines are cut and hashed once; the narrow table of them is staged."""
    lines = staged(_lines(rows), "line-keys")
    hit = lines.join(boilerplate(lines, limits), "_key")
    hit = hit.where(~(F.col("_first.id").eqNullSafe(F.col("_id")) & (F.col("_first.t") == F.col("_t"))))
    once = hit.groupBy("_id", "_t", "_host", "_pos").agg(F.max("_w").alias("_w"))
    return once.groupBy("_id", "_t", "_host").agg(F.sum("_w").alias("_lost"), F.collect_list("_pos").alias("_gone"))


def _joined(left: DataFrame, gone: DataFrame) -> DataFrame:
    """``left`` with the removals of its own rows; keys are null-safe."""
    gone = gone.select(*(F.col(c).alias(f"{c}_r") for c in gone.columns))
    on = left["_id"].eqNullSafe(gone["_id_r"]) & (left["_t"] == gone["_t_r"]) & (left["_host"] == gone["_host_r"])
    return left.join(gone, on, "left")


def verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", limits: Limits = Limits()) -> DataFrame:
    """Id, base measures, ``base_failed``, ``lost_words`` and ``kept`` of every row.

    Texts are read, measured and dropped inside the scan stages; only keys and
    counts are shuffled.
    """
    rows = _rows(docs, id_col, text_col, host_col)
    base = rows.select("_id", "_t", "_host", *base_columns(F.col("_text"))).withColumns({"n_words": F.col("_counted.n"), "n_repeat_words": F.col("_counted.r")})
    out = _joined(base, removals(rows, limits).drop("_gone"))
    failed = (F.col("n_words") < limits.min_words) | (100 * F.col("n_repeat_words") > limits.repeat_percent * F.col("n_words"))
    lost = F.coalesce(F.col("_lost_r"), F.lit(0))
    left = F.col("n_words") - lost
    return out.select(
        F.col("_id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), lost.cast("long").alias("lost_words"),
        (~failed & (left >= limits.min_words) & (left >= limits.min_left * F.col("n_words"))).alias("kept"),
    )


def apply(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", limits: Limits = Limits()) -> DataFrame:
    """The documents that pass, without their boilerplate lines.

    Columns and their order are those of ``docs``. Base rules are checked in
    the scan, before texts are joined with the lines they lose.
    """
    keep = [c for c in docs.columns if c != text_col]
    rows = docs.select(F.struct(*keep).alias("_row"), docs[id_col].alias("_id"), docs[text_col].alias("_text"), F.xxhash64(docs[text_col]).alias("_t"), F.xxhash64(docs[host_col].isNull(), docs[host_col]).alias("_host"))
    rows = rows.withColumn("_c", base_columns(F.col("_text"))[0]).withColumn("_n", F.col("_c.n"))
    rows = rows.where((F.col("_n") >= limits.min_words) & (100 * F.col("_c.r") <= limits.repeat_percent * F.col("_n")))
    out = _joined(rows, removals(_rows(docs, id_col, text_col, host_col), limits))
    words_left = F.col("_n") - F.coalesce(F.col("_lost_r"), F.lit(0))
    out = out.where((words_left >= limits.min_words) & (words_left >= limits.min_left * F.col("_n")))
    left = F.array_join(F.filter(F.split("_text", "\n"), lambda x, i: ~F.array_contains(F.col("_gone_r"), i)), "\n")
    text = F.when(F.col("_gone_r").isNull(), F.col("_text")).otherwise(left)
    return out.select(*(text.alias(c) if c == text_col else F.col("_row")[c].alias(c) for c in docs.columns))


def op4(spark, sf_dir: str) -> DataFrame:
    return verdicts(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = r"""
WITH w AS (SELECT doc_id, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
again AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM g) WHERE c > 1),
rep AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM again, (VALUES (0), (1), (2)) AS s(j) GROUP BY doc_id),
raw AS (SELECT doc_id, source, t, unnest(string_split(t, chr(10))) AS line FROM w),
worded AS (SELECT *, trim(regexp_replace(lower(line), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS norm FROM raw WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM worded GROUP BY doc_id),
pairs AS (SELECT source, norm, t, min(doc_id) AS id FROM worded GROUP BY ALL),
lines AS (SELECT source, norm, count(*) AS n, min(id) AS first FROM pairs GROUP BY ALL),
bad AS (SELECT source, norm, first FROM lines WHERE n > 4),
lost AS (SELECT doc_id, sum(len(string_split(norm, ' '))) AS n FROM worded JOIN bad USING (source, norm) WHERE doc_id <> first GROUP BY doc_id),
base AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
 CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines,
 CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(lost.n, 0) AS BIGINT) AS lost_words
 FROM w LEFT JOIN dup USING (doc_id) LEFT JOIN rep USING (doc_id) LEFT JOIN lost USING (doc_id))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
 NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND n_words - lost_words >= 50 AND n_words - lost_words >= 0.5 * n_words AS kept FROM base
"""
