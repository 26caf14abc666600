"""Line deduplication by a deletion-neighbourhood join on words.

Lines are sequences of lower-cased words. Two lines are near when they are equal
or, from ``near_words`` words on, when one word inserted, deleted or replaced
makes them equal: the edit bound over words is 0 for shorter lines, else 1. A
line is removed if an equal or near line stands earlier, in the order of
document id, text hash and line number.

1. Equal lines meet by a 128-bit key in a combined aggregation.
2. Of two near lines one half is equal, so four keys of halves per distinct line
   tell, exactly, which lines can have a near one at all. The texts of only
   those are read again.
3. Those lines emit their deletion variants as 128-bit keys. A replaced word
   gives both lines one variant with one position; an inserted one makes a
   variant of the longer equal to the shorter. All lines of a replacement key
   are near each other, and those of an insertion key are near its whole line,
   so the earliest partner is a minimum per key: no pairs within a group.
4. The edit distance of every line and its earliest partner is verified on
   their words.

Defined cases: null or empty texts have no lines; a null id comes last; rows
equal in id and text are one document and lose the same lines; ties are ordered
by text hash, then line number; blank lines stay; very long lines are compared
whole; other columns are kept by ``apply`` and not read otherwise.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coldtide.llm.common import KeyFilter
from coldtide.session import drop, ship_code, staged

BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))
KEY = ["_k1", "_k2"]
LINES = "_id {kind}, _t long, _pos int, _k1 long, _k2 long, _half array<long>"


def signed(values: list[int] | np.ndarray) -> pa.Array:
    return pa.array(np.asarray(values, np.uint64).view(np.int64))


def key_of(line: str) -> tuple[int, int]:
    whole = xxhash.xxh3_128_intdigest(line)
    return whole >> 64, whole & 0xFFFFFFFFFFFFFFFF


def halves(words: list[str]) -> list[int]:
    """Keys of both halves, as the shorter and as the longer of two lines."""
    out = []
    for n in (len(words), len(words) - 1):
        cut = n // 2
        out.append(xxhash.xxh3_64_intdigest(f"p{n} " + " ".join(words[:cut])))
        out.append(xxhash.xxh3_64_intdigest(f"s{n} " + " ".join(words[len(words) - (n - cut) :])))
    return out


def _split(texts: list[str | None]) -> Iterator[tuple[int, int, list[str]]]:
    """Row, line number and words of each line with a word."""
    for row, text in enumerate(texts):
        if text:
            for pos, line in enumerate(text.lower().split("\n")):
                words = line.replace("\t", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ")
                if "" in words:
                    words = [w for w in words if w]
                if words:
                    yield row, pos, words


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(docs[id_col].alias("_id"), F.xxhash64(docs[text_col]).alias("_t"), docs[text_col].alias("_text"))


def lines(docs: DataFrame, id_col: str, text_col: str, near_words: int) -> DataFrame:
    """Every line with a word: document, number, key, and the keys of its halves
    (none for lines that are near to equal ones only)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, pos, k1, k2, ends, own = [], [], [], [], [0], []
            for at, number, words in _split(batch.column(2).to_pylist()):
                a, b = key_of(" ".join(words))
                row.append(at)
                pos.append(number)
                k1.append(a)
                k2.append(b)
                if len(words) >= near_words:
                    own += halves(words)
                ends.append(len(own))
            take = pa.array(row, pa.int64())
            half = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), signed(own))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), pa.array(pos, pa.int32()), signed(k1), signed(k2), half], ["_id", "_t", "_pos", "_k1", "_k2", "_half"])

    return _rows(docs, id_col, text_col).mapInArrow(run, LINES.format(kind=docs.schema[id_col].dataType.simpleString()))


def _first() -> F.Column:
    """The order of occurrences, null ids last."""
    return F.struct(F.col("_id").isNull().alias("n"), F.col("_id").alias("id"), F.col("_t").alias("t"), F.col("_pos").alias("p"))


def candidates(table: DataFrame) -> DataFrame:
    """Distinct lines that share a half with another: keys, first, sides."""
    half = [F.max(F.when(F.size("_half") > 0, F.col("_half")[i])).alias(f"_h{i}") for i in range(4)]
    distinct = table.where(F.size("_half") > 0).groupBy(*KEY).agg(F.min(_first()).alias("_first"), *half)
    each = distinct.select(*KEY, F.posexplode(F.array(*(f"_h{i}" for i in range(4)))).alias("_side", "_h"))
    shared = each.groupBy("_h").agg(F.min("_k1").alias("a"), F.max("_k1").alias("b")).where("a <> b").select("_h")
    sides = each.join(shared, "_h").groupBy(*KEY).agg(F.max((F.col("_side") % 2 == 0).cast("int")).alias("_pre"), F.max((F.col("_side") % 2 == 1).cast("int")).alias("_suf"))
    return staged(sides.join(distinct.select(*KEY, "_first"), KEY), "line-candidates")


def _texts(docs: DataFrame, id_col: str, text_col: str, found: DataFrame) -> DataFrame:
    """The candidates with their lines, read again from the documents."""
    known = KeyFilter.of(found, "_k1")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, pos, k1, k2, kept = [], [], [], [], []
            for at, number, words in _split(batch.column(2).to_pylist()):
                line = " ".join(words)
                a, b = key_of(line)
                row.append(at)
                pos.append(number)
                k1.append(a)
                k2.append(b)
                kept.append(line)
            keep = np.flatnonzero(known.may_hold(np.array(k1, np.uint64))) if known else np.arange(len(k1))
            take = pa.array(np.array(row, np.int64)[keep])
            k1, k2 = (signed(np.array(k, np.uint64)[keep]) for k in (k1, k2))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), pa.array(np.array(pos, np.int32)[keep]), k1, k2, pa.array([kept[i] for i in keep], pa.string())], ["_id", "_t", "_pos", "_k1", "_k2", "_line"])

    kind = docs.schema[id_col].dataType.simpleString()
    seen = _rows(docs, id_col, text_col).mapInArrow(run, f"_id {kind}, _t long, _pos int, _k1 long, _k2 long, _line string")
    # Only the first occurrence of a candidate carries its words on.
    seen = seen.withColumn("_o", _first()).select(*KEY, "_o", "_line")
    return seen.join(found, KEY).where(F.col("_o") == F.col("_first")).drop("_o").dropDuplicates(KEY)


def variants(words: list[str], pre: bool, suf: bool) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Both halves of the keys of a line's variants; whether each is of a
    replacement; whether it is the whole line.

    With only the first half shared, just words of the second are deleted.
    """
    n = len(words)
    low, high = (0 if suf else max(0, (n - 1) // 2 - 1)), (n if pre else min(n, n // 2 + 2))
    at = np.arange(low, high, dtype=np.uint64)
    digests = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, words)), np.uint64).reshape(n, 2)
    mix = lambda x, y: (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + y * np.uint64(0x94D049BB133111EB)
    keys = []
    for part, base in enumerate(BASES):
        h = digests[:, part]
        power = np.ones(n + 1, np.uint64)
        power[1:] = np.cumprod(np.full(n, base, np.uint64))
        before = np.zeros(n + 1, np.uint64)
        before[1:] = np.cumsum(h * power[:n])
        # Hash without word i: the terms after it move down by one power.
        shifted = np.zeros(n + 1, np.uint64)
        shifted[2:] = np.cumsum(h[1:] * power[: n - 1])
        deleted = (before[:n] + (shifted[n] - shifted[1 : n + 1]))[low:high]
        replaced = mix(deleted, at + np.uint64(1) + (np.uint64(n) << np.uint64(32)))
        keys.append(np.concatenate([replaced, mix(deleted, np.uint64(0)), mix(before[n:], np.uint64(0))]))
    place = np.arange(2 * len(at) + 1)
    return keys, place < len(at), place == 2 * len(at)


def ranked(texts: DataFrame) -> DataFrame:
    """The candidates with numbers in the order of their first occurrences."""
    return texts.orderBy("_first").withColumn("_rank", F.monotonically_increasing_id()).select(*KEY, "_line", "_pre", "_suf", "_rank")


def near(texts: DataFrame) -> DataFrame:
    """Keys of the candidate lines with a near line before them."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                row, x, y, swap, whole = [], [], [], [], []
                for at, (line, pre, suf) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("_line", "_pre", "_suf")))):
                    keys, swaps, wholes = variants(line.split(" "), bool(pre), bool(suf))
                    row.append(np.full(len(swaps), at))
                    x.append(keys[0])
                    y.append(keys[1])
                    swap.append(swaps)
                    whole.append(wholes)
                if row:
                    rank = batch.column("_rank").take(pa.array(np.concatenate(row)))
                    yield pa.RecordBatch.from_arrays([rank, signed(np.concatenate(x)), signed(np.concatenate(y)), pa.array(np.concatenate(swap)), pa.array(np.concatenate(whole))], ["_rank", "_x", "_y", "_swap", "_whole"])

    keyed = texts.select("_line", "_pre", "_suf", "_rank").mapInArrow(emit, "_rank long, _x long, _y long, _swap boolean, _whole boolean")
    key = ["_x", "_y", "_swap"]
    least = [F.min("_rank").alias("_all"), F.min(F.when(F.col("_whole"), F.col("_rank"))).alias("_w"), F.min(F.when(~F.col("_whole"), F.col("_rank"))).alias("_d")]
    groups = keyed.groupBy(*key).agg(*least, F.max("_rank").alias("_last"))
    groups = groups.where("_all <> _last and (_swap or (_w is not null and _d is not null))").drop("_last")
    hits = keyed.join(groups, key).withColumn("_p", F.expr("case when _swap then _all when _whole then _d else _w end")).where("_p < _rank")
    best = hits.groupBy("_rank").agg(F.min("_p").alias("_p"))
    ours = texts.select("_rank", *KEY, F.col("_line").alias("_a"))
    theirs = texts.select(F.col("_rank").alias("_p"), F.col("_line").alias("_b"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [within_one(a.split(" "), b.split(" ")) for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield batch.select(KEY).filter(pa.array(good, pa.bool_()))

    return best.join(ours, "_rank").join(theirs, "_p").select(*KEY, "_a", "_b").mapInArrow(verify, "_k1 long, _k2 long")


def within_one(a: list[str], b: list[str]) -> bool:
    """Whether the edit distance over words is at most 1."""
    if len(a) > len(b):
        a, b = b, a
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return len(b) - len(a) <= 1 and a[i + (len(a) == len(b)) :] == b[i + 1 :]


def removed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", near_words: int = 5) -> DataFrame:
    """Per document that loses lines: _id, _t, numbers of equal and near lines."""
    ship_code(docs.sparkSession)
    table = staged(lines(docs, id_col, text_col, near_words), "lines")
    found = candidates(table)
    texts = staged(_texts(docs, id_col, text_col, found), "line-texts")
    drop(found)
    order = staged(ranked(texts), "ranked-lines")
    drop(texts)
    close = near(order).withColumn("_near", F.lit(True))
    first = table.groupBy(*KEY).agg(F.min(_first()).alias("_first"), F.count("*").alias("_n"))
    first = first.join(close, KEY, "left").where("_n > 1 or _near")
    hit = table.select("_id", "_t", "_pos", *KEY).join(first, KEY)
    again = _first() > F.col("_first")
    hit = hit.where(again | F.col("_near")).select("_id", "_t", "_pos", again.alias("_again")).distinct()
    return hit.groupBy("_id", "_t").agg(F.sort_array(F.collect_list(F.when(F.col("_again"), F.col("_pos")))).alias("equal_lines"), F.sort_array(F.collect_list(F.when(~F.col("_again"), F.col("_pos")))).alias("near_lines"))


def _joined(docs: DataFrame, gone: DataFrame) -> DataFrame:
    gone = gone.select(F.col("_id").alias("_id_r"), F.col("_t").alias("_t_r"), "equal_lines", "near_lines")
    return docs.join(gone, F.col("_id").eqNullSafe(F.col("_id_r")) & (F.col("_t") == F.col("_t_r")), "left")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", near_words: int = 5) -> DataFrame:
    """Per row: id, n_lines, and the numbers (from 0) of removed lines."""
    none = F.array().cast("array<int>")
    rows = docs.select(docs[id_col].alias("_id"), F.xxhash64(docs[text_col]).alias("_t"), F.when(docs[text_col].isNull(), F.lit(0)).otherwise(F.size(F.split(docs[text_col], "\n"))).cast("long").alias("n_lines"))
    out = _joined(rows, removed(docs, id_col, text_col, near_words))
    return out.select(F.col("_id").alias(id_col), "n_lines", F.coalesce("equal_lines", none).alias("equal_lines"), F.coalesce("near_lines", none).alias("near_lines"))


def apply(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", near_words: int = 5) -> DataFrame:
    """The documents without removed lines; those left without a word go."""
    keep = [c for c in docs.columns if c != text_col]
    rows = docs.select(F.struct(*keep).alias("_row"), docs[id_col].alias("_id"), F.xxhash64(docs[text_col]).alias("_t"), docs[text_col].alias("_text"))
    out = _joined(rows, removed(docs, id_col, text_col, near_words)).withColumn("_gone", F.concat("equal_lines", "near_lines"))
    left = F.array_join(F.filter(F.split("_text", "\n"), lambda x, i: ~F.array_contains(F.col("_gone"), i)), "\n")
    out = out.withColumn("_left", F.when(F.col("_gone").isNull(), F.col("_text")).otherwise(left))
    out = out.where(F.col("_gone").isNull() | (F.btrim("_left", F.lit(" \t\n\x0b\x0c\r")) != ""))
    return out.select(*(F.col("_left").alias(c) if c == text_col else F.col("_row")[c].alias(c) for c in docs.columns))


def op2(spark, sf_dir: str) -> DataFrame:
    return report(spark.read.parquet(f"{sf_dir}/documents.parquet"))
