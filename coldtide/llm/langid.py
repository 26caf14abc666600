"""Language identification by known words first, then character n-grams.

A model holds, per language, relative frequencies of words and of character
n-grams of orders 1 to 4. A known word scores its negated log frequency, with a
penalty in languages that lack it. A word that no language knows is scored by
the mean over its n-grams of the longest order that any language knows, and so
on down to single letters. A text's score in a language is the mean over its
words; the least wins. Ties go to the language with more training rows, then
to the first in alphabetical order.

Words are runs of letters and their marks with a letter among them, in lower
case and composed; training and prediction cut them with the same function.
Training reads a sample of labelled rows, chosen by a hash of their ids, of
``max_rows`` rows in expectation, but of every label all rows up to
``label_rows`` and about that many of more, so that no label is lost in a large
table (at most ``max_rows`` and labels times ``label_rows`` in all). Every word
and n-gram of the sample is in the model, with scores only for the languages
that have it: its size follows the sample, which these parameters bound, so it
is collected and broadcast. Prediction covers whole texts of all rows.

Defined cases: null text, or one without a letter, gives ``und`` with score 0;
rows with a null id or label are not learned from; a model without training
rows answers ``und`` for all; ids repeat or are null freely; other columns are
not read.
"""

from __future__ import annotations

import unicodedata
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coldtide.session import drop, ship_code, staged

ORDERS = (4, 3, 2, 1)
WORD = regex.compile(r"\p{M}*\p{L}[\p{L}\p{M}]*")
ASCII_WORD = regex.compile(r"[a-z]+")


@dataclass
class Table:
    """Units and their entries: the numbers of languages that have the unit,
    and what it is better there than an unknown one."""

    units: pa.StringArray
    languages: pa.ListArray
    gains: pa.ListArray

    def entries(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Where each unit's entries begin, how many they are, and all entries."""
        ends = self.languages.offsets.to_numpy().astype(np.int64)
        return ends[:-1] - ends[0], np.diff(ends), self.languages.flatten().to_numpy(), self.gains.flatten().to_numpy()


@dataclass
class Model:
    languages: list[str]
    penalty: float
    words: Table
    grams: dict[int, Table]
    key: str = field(default_factory=lambda: uuid.uuid4().hex)


def words_of(text: str) -> list[str]:
    text = text.lower()
    if text.isascii():
        return ASCII_WORD.findall(text)
    return WORD.findall(text if unicodedata.is_normalized("NFC", text) else unicodedata.normalize("NFC", text))


def held_out(id_col: Column) -> Column:
    """Rows kept for measuring: crc32 of the id as text is 2 modulo 4."""
    return F.coalesce(F.crc32(id_col.cast("string")) % 4 == 2, F.lit(False))


def sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, max_rows: int, label_rows: int) -> DataFrame:
    """About ``max_rows`` labelled rows by a hash of the id (all if fewer), and
    of each label at least about ``label_rows`` (all if fewer)."""
    known = docs.where(docs[lang_col].isNotNull() & docs[id_col].isNotNull())
    rows = known.select(docs[text_col].alias("_text"), docs[lang_col].alias("_lang"), docs[id_col].alias("_id"))
    counts = [tuple(r) for r in rows.groupBy("_lang").count().collect()]
    n = sum(count for _, count in counts)
    if n > max_rows:
        below = [(lang, int((1 << 30) * min(1, max(max_rows / n, label_rows / count)))) for lang, count in counts]
        limits = docs.sparkSession.createDataFrame(below, f"_lang {docs.schema[lang_col].dataType.simpleString()}, _below long")
        rows = rows.join(F.broadcast(limits), "_lang").where(F.pmod(F.xxhash64("_id", F.lit("language sample")), F.lit(1 << 30)) < F.col("_below"))
    return rows.where("_text is not null").select("_lang", "_text")


def _counted(rows: DataFrame) -> DataFrame:
    """(_lang, _unit, count): words of the sample."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[object, Counter[str]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts.setdefault(lang, Counter()).update(words_of(text))
            flat = [(lang, unit, n) for lang, own in counts.items() for unit, n in own.items()]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in flat], kind) for i, kind in enumerate((batch.schema.field(0).type, pa.string(), pa.int64()))], ["_lang", "_unit", "count"])

    kind = rows.schema["_lang"].dataType.simpleString()
    return rows.select("_lang", "_text").mapInArrow(run, f"_lang {kind}, _unit string, count long").groupBy("_lang", "_unit").agg(F.sum("count").alias("count"))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_rows: int = 8000, penalty: float = 7.0, label_rows: int = 200) -> Model:
    """Fit a model on labelled rows; counting is done by Spark."""
    ship_code(docs.sparkSession)
    rows = sample(docs, id_col, text_col, lang_col, max_rows, label_rows)
    counted = _counted(rows)
    padded = F.concat(F.lit(" "), F.col("_unit"), F.lit(" "))

    def cut(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.length(padded) - n + 1, F.lit(1)))
        return F.transform(starts, lambda i: F.struct(F.lit(n).alias("o"), F.substring(padded, i, F.lit(n)).alias("g")))

    grams = F.flatten(F.array(*map(cut, ORDERS)))
    units = counted.select("_lang", F.lit(0).alias("_order"), "_unit", "count").unionByName(
        counted.select("_lang", "count", F.explode(grams).alias("_x")).where("trim(_x.g) <> ''").groupBy("_lang", F.col("_x.o").alias("_order"), F.col("_x.g").alias("_unit")).agg(F.sum("count").alias("count"))
    )
    # The number of rows orders the languages for ties.
    sizes = {r["_lang"]: r["n"] for r in rows.groupBy("_lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes, key=lambda x: (-sizes[x], x))
    number = docs.sparkSession.createDataFrame(list(enumerate(languages)), f"_at int, _lang {rows.schema['_lang'].dataType.simpleString()}")
    units = staged(units, "language-units")
    totals = units.groupBy("_lang", "_order").agg(F.sum("count").alias("total")).join(F.broadcast(number), "_lang")
    gain = F.greatest(F.lit(0.0), penalty + F.log10(F.col("count") / F.col("total"))).cast("float")
    entry = F.sort_array(F.collect_list(F.struct("_at", gain.alias("_gain"))))
    each = units.join(F.broadcast(totals), ["_lang", "_order"]).groupBy("_order", "_unit").agg(entry.alias("x")).select("_order", "_unit", F.col("x._at").alias("at"), F.col("x._gain").alias("gain"))
    found = each.toArrow()
    drop(units)

    def table(order: int) -> Table:
        part = found.filter(pc.equal(found["_order"], order)).combine_chunks()
        return Table(*(pa.concat_arrays([pa.array([], part.schema.field(c).type), *part[c].chunks]) for c in ("_unit", "at", "gain")))

    return Model(languages, penalty, table(0), {n: table(n) for n in ORDERS})


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of runs of the given starts and sizes, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


class Scorer:
    """A worker's tables: the entries of each word, known or derived."""

    def __init__(self, model: Model, remembered: int = 400_000):
        self.model, self.remembered = model, remembered
        self.grams = {order: dict(zip(table.units.to_pylist(), range(len(table.units)))) for order, table in model.grams.items()}
        self.entries = {order: table.entries() for order, table in model.grams.items()}
        self.forget()

    def forget(self) -> None:
        table = self.model.words
        self.words = dict(zip(table.units.to_pylist(), range(len(table.units))))
        self.most = len(self.words) + self.remembered
        self.starts, self.sizes, self.languages, self.gains = table.entries()

    def learn(self, words: list[str]) -> None:
        """Give unseen words the mean entries of their longest known n-grams."""
        number = len(self.model.languages)
        by_order: dict[int, tuple[list[int], list[int]]] = {order: ([], []) for order in ORDERS}
        for k, word in enumerate(words):
            padded = f" {word} "
            for order in ORDERS:
                get = self.grams[order].get
                here = [x for i in range(len(padded) - order + 1) if (x := get(padded[i : i + order])) is not None]
                if here:
                    by_order[order][0].extend([k] * len(here))
                    by_order[order][1].extend(here)
                    break
        sums, many = [], np.zeros(len(words))
        for order, (who, what) in by_order.items():
            if not what:
                continue
            first, sizes, languages, gains = self.entries[order]
            who, what = np.array(who), np.array(what)
            place = spread(first[what], sizes[what])
            sums.append((np.repeat(who, sizes[what]) * number + languages[place], gains[place]))
            np.add.at(many, who, 1)
        if sums:
            cells, at = np.unique(np.concatenate([c for c, _ in sums]), return_inverse=True)
            gain = np.bincount(at, np.concatenate([g for _, g in sums]))
            owner = cells // number
            parts = (cells % number).astype(np.int32), (gain / many[owner]).astype(np.float32)
            sizes = np.bincount(owner, minlength=len(words))
        else:
            parts, sizes = (np.zeros(0, np.int32), np.zeros(0, np.float32)), np.zeros(len(words), np.int64)
        starts = len(self.languages) + np.cumsum(sizes) - sizes
        base = len(self.starts)
        self.words.update(zip(words, range(base, base + len(words))))
        self.starts, self.sizes = np.concatenate([self.starts, starts]), np.concatenate([self.sizes, sizes])
        self.languages, self.gains = np.concatenate([self.languages, parts[0]]), np.concatenate([self.gains, parts[1]])

    def predict(self, texts: list[str]) -> Iterator[tuple[str, float]]:
        names = self.model.languages
        cut = [words_of(text) for text in texts]
        if len(self.words) > self.most:
            self.forget()
        new = list(set().union(*cut).difference(self.words))
        if new and names:
            self.learn(new)
        get, wide = self.words.__getitem__, max(1, len(names))
        many = np.array([len(parts) for parts in cut])
        if names:
            number = np.fromiter((get(w) for parts in cut for w in parts), np.int64, int(many.sum()))
            size = self.sizes[number]
            place = spread(self.starts[number], size)
            row = np.repeat(np.repeat(np.arange(len(cut)), many), size)
            gained = np.bincount(row * wide + self.languages[place], self.gains[place], len(cut) * wide).reshape(-1, wide)
        for k, n in enumerate(many.tolist()):
            if not n or not names:
                yield "und", 0.0
                continue
            mean = gained[k] / n
            best = int(mean.argmax())
            odds = np.exp(np.log(10) * (mean - mean[best]) * min(n, 20))
            yield names[best], float(1 / odds.sum())


_scorers: dict[str, Scorer] = {}


def predicted(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Id (and the columns of ``keep``), lang_pred and score of each row."""
    ship_code(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    keep = [id_col] if keep is None else keep
    at = keep.index(text_col) if text_col in keep else len(keep)
    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = shared.value.key
        if key not in _scorers:
            _scorers.clear()
            _scorers[key] = Scorer(shared.value)
        scorer = _scorers[key]
        for batch in batches:
            found = []
            for first in range(0, batch.num_rows, 256):
                found += scorer.predict([x or "" for x in batch.column(at).slice(first, 256).to_pylist()])
            columns = batch.columns[: len(keep)] + [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [*keep, "lang_pred", "score"])

    sent = [docs[c] for c in keep] + [docs[text_col].alias("_text")] * (text_col not in keep)
    return docs.select(*sent).mapInArrow(run, f"{fields}, lang_pred string, score double")


def op10(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs.where(~held_out(F.col("doc_id"))))
    return predicted(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
