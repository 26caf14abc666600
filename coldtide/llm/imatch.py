"""I-Match document fingerprints (DataFrame functions only).

Terms are hashed. The lexicon holds the terms whose document share lies in a
chosen band, which is a band of inverse document frequency; because its lower
end is a share, the lexicon has at most (mean distinct terms of a document) /
``min_share`` entries whatever the corpus size, and is broadcast within that
bound. A fingerprint is made of the sorted distinct lexicon terms of a text:

* 8 hex digits: their number;
* 16: SHA-256 of all of them (the classic signature);
* 4 for each of 16 randomised sub-lexica at each of five sampling rates, from
  1/16 to 1/4096 of the lexicon.

A sub-lexicon of rate r keeps its hash through D changed terms with probability
(1 - r)^D, so the share of equal hashes at a rate near 1/D tells D, and with
the two counts a Jaccard likeness of the term sets. A text without lexicon
terms gets 0 and the hash of all its terms, and is like equal ones only.

The next document of another is found without a shuffle beyond the one that
brings neighbours together: ids are cut at quantiles, texts are sorted inside
the cuts, and the first row of each cut is copied to the end of the cut before.

Defined cases: null text is the empty text; null ids come last in descending
order; equal ids are ordered by their texts' hashes, repeated rows follow each
other; a single document is its own next one; an empty table gives no row;
other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coldtide.llm.common import bind, spaced
from coldtide.session import staged

PER_RATE = 16
RATES = (16, 64, 256, 1024, 4096)
#: Bytes of text that one bucket of neighbouring ids may have, on average.
BUCKET_BYTES = 1 << 30
#: Punctuation that ends or joins words.
STOPS = ".,;:!?\"()|"


def terms(text: Column) -> Column:
    """Distinct hashed terms of a text, lower-cased, without punctuation."""
    plain = spaced(F.lower(text))
    for mark in STOPS:
        plain = F.replace(plain, F.lit(mark), F.lit(" "))
    return F.array_distinct(F.transform(F.filter(F.split(plain, " "), lambda w: w != ""), lambda w: F.xxhash64(w)))


def lexicon(docs: DataFrame, text_col: str = "text", min_share: float = 0.002, max_share: float = 0.1, min_docs: int = 2) -> DataFrame:
    """Hashed terms in the band, counted over all documents, staged."""
    # Counting rows reads no column; the count is one number.
    n = docs.count()
    counts = docs.select(F.explode(terms(F.coalesce(docs[text_col], F.lit("")))).alias("_h")).groupBy("_h").agg(F.count("*").alias("_n"))
    low, high = max(min_docs, math.ceil(min_share * n)), max(min_docs, max_share * n)
    return staged(counts.where(F.col("_n").between(low, high)).select("_h"), "lexicon")


def signature(found: Column, other: Column) -> Column:
    """The fingerprint of sorted lexicon terms; ``other``: hash of all terms."""

    def rate(t: Column, level: int) -> Column:
        share = RATES[level]
        placed = F.filter(F.transform(t, lambda x: F.struct(F.pmod(F.xxhash64(x, F.lit(level)), F.lit(share)).alias("s"), x.alias("t"))), lambda p: p["s"] < PER_RATE)
        own = lambda p, k: F.xxhash64(F.transform(F.filter(p, lambda x: x["s"] == k), lambda x: x["t"]))
        return bind(placed, lambda p: F.transform(F.sequence(F.lit(0), F.lit(PER_RATE - 1)), lambda k: F.lpad(F.hex(own(p, k).bitwiseAND(F.lit(0xFFFF))), 4, "0")))

    def whole(t: Column) -> Column:
        full = F.when(F.size(t) > 0, F.substring(F.sha2(F.array_join(F.transform(t, lambda x: x.cast("string")), ","), 256), 1, 16)).otherwise(F.lower(F.lpad(F.hex(other), 16, "0")))
        parts = F.flatten(F.array(*(rate(t, level) for level in range(len(RATES)))))
        return F.concat(F.lower(F.lpad(F.hex(F.size(t)), 8, "0")), full, F.lower(F.array_join(parts, "")))

    return bind(F.array_sort(found), whole)


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard likeness, 0 to 1, of two fingerprints' term sets."""
    count = lambda x: F.conv(F.substring(x, 1, 8), 16, 10).cast("double")
    total = count(a) + count(b)
    changed = F.lit(None).cast("double")
    for level in reversed(range(len(RATES))):
        first = F.lit(25 + 4 * PER_RATE * level)
        same = F.size(F.filter(F.sequence(F.lit(0), F.lit(PER_RATE - 1)), lambda k: F.substring(a, first + 4 * k, F.lit(4)) == F.substring(b, first + 4 * k, F.lit(4))))
        told = F.ln(F.greatest(same, F.lit(0.5)) / PER_RATE) / math.log(1 - 1 / RATES[level])
        changed = told if level == len(RATES) - 1 else F.when(same >= 0.3 * PER_RATE, told).otherwise(changed)
    changed = F.greatest(changed, F.lit(1.0), F.abs(count(a) - count(b)))
    equal = F.substring(a, 1, 24) == F.substring(b, 1, 24)
    return F.when(equal, F.lit(1.0)).when(total == 0, F.lit(0.0)).otherwise(bind(changed, lambda d: F.greatest((total - d) / (total + d), F.lit(0.0))))


def fingerprints(rows: DataFrame, keys: list[str], texts: list[str], words: DataFrame, payload: list[str], most: int = 4_000_000) -> DataFrame:
    """``keys``, ``payload`` and the fingerprints of the columns ``texts``.

    ``keys`` tell rows apart. If the rows are already partitioned by a subset
    of ``keys``, nothing is shuffled: terms are exploded, looked up in the
    broadcast lexicon and gathered again inside their partition. A lexicon of
    more than ``most`` terms is joined by shuffle instead; the rows that head
    the documents are spread over its tasks.
    """
    nothing = F.lit(None).cast(rows.select(F.struct(*payload, *(F.lit(0).cast("long").alias(f"_all{i}") for i in range(len(texts)))).alias("p")).schema["p"].dataType)

    def listed(found: list[Column]) -> Column:
        carried = F.struct(*payload, *(F.xxhash64(F.array_sort(t)).alias(f"_all{i}") for i, t in enumerate(found)))
        head = F.array(F.struct(F.lit(-1).alias("v"), F.xxhash64(*keys).alias("h"), carried.alias("p")))
        return F.concat(head, *(F.transform(t, lambda x: F.struct(F.lit(i).alias("v"), x.alias("h"), nothing.alias("p"))) for i, t in enumerate(found)))

    named = rows.select(*keys, *payload, *(terms(F.col(t)).alias(f"_terms{i}") for i, t in enumerate(texts)))
    flat = named.select(*keys, F.explode(listed([F.col(f"_terms{i}") for i in range(len(texts))])).alias("_x"))
    flat = flat.select(*keys, F.col("_x.v").alias("_v"), F.col("_x.h").alias("_h"), F.col("_x.p").alias("_p"))
    # A row of no term heads every document, so that those without one stay.
    words = words.withColumn("_known", F.lit(True))
    words = F.broadcast(words) if words.count() <= most else words
    held = flat.join(words, "_h", "left").where("_v < 0 or _known")
    found = held.groupBy(*keys).agg(F.first("_p", ignorenulls=True).alias("_p"), *(F.collect_list(F.when(F.col("_v") == i, F.col("_h"))).alias(f"_in{i}") for i in range(len(texts))))
    return found.select(*keys, *(F.col(f"_p.{c}").alias(c) for c in payload), *(signature(F.col(f"_in{i}"), F.col(f"_p._all{i}")).alias(f"{t}_fingerprint") for i, t in enumerate(texts)))


def bucket_of(value: Column, cuts: list[float]) -> Column:
    """Number of ascending ``cuts`` at or below ``value``, by bisection."""
    if not cuts:
        return F.lit(0)
    held = F.split(F.lit(" ".join(map(repr, cuts))), " ").cast("array<double>")

    def step(state: Column, _: Column) -> Column:
        mid = F.floor((state["lo"] + state["hi"]) / 2).cast("int")
        open_ = state["lo"] < state["hi"]
        above = F.get(held, mid) <= value
        return F.struct(F.when(open_ & above, mid + 1).otherwise(state["lo"]).alias("lo"), F.when(open_ & ~above, mid).otherwise(state["hi"]).alias("hi"))

    steps = F.sequence(F.lit(1), F.lit(len(cuts).bit_length() + 1))
    start = F.struct(F.lit(0).alias("lo"), F.lit(len(cuts)).alias("hi"))
    return F.aggregate(steps, start, step, lambda s: s["lo"])


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int | None = None) -> DataFrame:
    """Rows in descending id order with the text of the next row.

    Columns: _bucket, _row (place in the bucket), _copy (true for the copied
    first row of the following bucket, whose own next text is not known), _id,
    _text, _next.
    """
    if not buckets:
        held = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
        buckets = max(3 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(held / BUCKET_BYTES))
    rows = docs.select(docs[id_col].alias("_id"), F.coalesce(docs[text_col], F.lit("")).alias("_text")).withColumn("_t", F.xxhash64("_text"))
    ids = docs.select(docs[id_col].cast("double").alias("_d")).where("_d is not null")
    cuts = sorted(set(ids.approxQuantile("_d", [i / buckets for i in range(1, buckets)], 0.25 / buckets) or []))
    bucket = F.when(F.col("_id").isNull(), F.lit(-1)).otherwise(bucket_of(F.col("_id").cast("double"), cuts))
    rows = rows.withColumn("_bucket", bucket)
    order = [F.desc_nulls_last("_id"), F.asc("_t")]
    # One row per bucket: at most as many as there are cuts, plus two.
    top = F.max(F.struct(F.col("_id").alias("i"), (-F.col("_t").cast("decimal(20,0)")).alias("t"))).alias("_m")
    down = Window.orderBy(F.desc("_bucket"))
    lowest = F.min("_bucket").over(down.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    first = rows.groupBy("_bucket").agg(top).select(F.col("_m.i").alias("_fid"), (-F.col("_m.t")).cast("long").alias("_ft"), F.coalesce(F.lag("_bucket").over(down), lowest).alias("_to"))
    heads = rows.join(F.broadcast(first), F.col("_id").eqNullSafe(F.col("_fid")) & (F.col("_t") == F.col("_ft"))).dropDuplicates(["_to"])
    both = rows.withColumn("_copy", F.lit(False)).unionByName(heads.select("_id", "_text", "_t", F.col("_to").alias("_bucket"), F.lit(True).alias("_copy")))
    within = Window.partitionBy("_bucket").orderBy("_copy", *order)
    return both.select("_bucket", F.row_number().over(within).alias("_row"), "_copy", "_id", "_text", F.lead("_text").over(within).alias("_next"))


def op3(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    words = lexicon(docs)
    n = F.length("_text")
    third = F.floor(n / 3).cast("int")
    rows = with_next(docs)
    edited = F.concat(F.substring("_text", F.lit(1), n - third), F.coalesce(F.substring("_next", F.lit(1), third), F.lit("")))
    rows = rows.select("_bucket", "_row", "_copy", "_id", n.cast("long").alias("n_chars"), F.col("_text").alias("own"), edited.alias("edited"))
    rows = rows.withColumn("edited_sha256", F.sha2("edited", 256))
    out = fingerprints(rows, ["_bucket", "_row"], ["own", "edited"], words, ["_id", "_copy", "n_chars", "edited_sha256"])
    after = F.lead("own_fingerprint").over(Window.partitionBy("_bucket").orderBy("_row"))
    out = out.withColumn("_after", after).where(~F.col("_copy"))
    return out.select(
        F.col("_id").alias("doc_id"), "n_chars", "edited_sha256", F.col("own_fingerprint").alias("fingerprint"), F.col("edited_fingerprint"),
        likeness(F.col("own_fingerprint"), F.col("edited_fingerprint")).alias("near_edited"), likeness(F.col("own_fingerprint"), F.col("_after")).alias("near_next"),
    )
