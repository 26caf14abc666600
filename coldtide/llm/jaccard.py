"""N-gram Jaccard self-join by vertical partitioning of the n-gram order.

The order of n-grams is that of their 64-bit hashes, which every task knows
without a global count. It is cut into fragments; a set's n-grams that fall
into one are its segment.

1. Documents with equal sets are one class, met by a 128-bit digest.
2. At similarity t, two sets of at most M n-grams differ in at most
   d = floor(2 M (1 - t) / (1 + t)) of them, so of d + 1 + s fragments at least
   s + 1 have equal segments in both. Keys are (size group, fragment, segment
   hash). A class with at most s keys that another class shares has no partner
   and ends here. Size groups are a fixed ratio wide; a set that can pair with
   the next group enters it too.
3. The n-grams of the other classes are counted among them. From rare to
   frequent, a set's first n-grams are its keys; place and size bound the sizes
   of the partners that a key can bring (prefix filtering with places).
4. Members of a key are compared with its pivot, the one with the fewest
   n-grams of its own, not with each other. Per fragment, the common n-grams
   are counted and those of the pivot that the member lacks are marked in a
   mask; counts and masks are summed per pair. Counts tell links.
5. Pairs of a key are then compared if they lie in different components, if
   their sizes fit, and if the pivot's n-grams, without those that either lacks,
   leave room for enough common ones. A link is thus either counted or implied
   by counted ones, and none is lost.

Defined cases: null texts, and texts without a word, have the empty set and
link with nothing; a text of fewer words than an n-gram is one n-gram; a null
id never becomes a component's id unless all its documents have none; equal ids
and repeated rows are rows of their own class; only A-Z is lower-cased.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coldtide.llm.common import KeyFilter
from coldtide.llm.components import components
from coldtide.session import drop, ship_code, staged

ASCII_LOWER = {c: c + 32 for c in range(65, 91)}
WIDE = 8
NEEDED = ["_own", "_own_need", "_next", "_next_need"]
STEP = 1.6
REMEMBERED = 500_000
MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


@dataclass(frozen=True)
class Similarity:
    """Sets of ``words``-word shingles link when 100 |A n B| >= percent |A u B|."""

    words: int = 4
    percent: int = 85

    def most_changes(self, size: int) -> int:
        """Largest symmetric difference of linked sets of at most ``size``."""
        return 2 * size * (100 - self.percent) // (100 + self.percent)

    def slack(self, group: int) -> int:
        """Fragments beyond those that the differences of linked sets need."""
        return max(3, (self.most_changes(group_top(group)) + 1) * 12 // 100)

    def fragments(self, group: int) -> int:
        return self.most_changes(group_top(group)) + 1 + self.slack(group)

    def groups(self, n: int) -> list[int]:
        """Size groups that a set of ``n`` enters: its own, maybe the next."""
        own = size_group(n)
        top = group_top(own)
        return [own, own + 1] if 100 * n >= self.percent * (top + 1) else [own]


def size_group(n: int) -> int:
    g = int(math.log(n) / math.log(STEP))
    while group_top(g) < n:
        g += 1
    while g and group_top(g - 1) >= n:
        g -= 1
    return g


def group_top(g: int) -> int:
    """The largest size of a group."""
    return math.ceil(STEP ** (g + 1))


class Shingler:
    """Sorted distinct shingle hashes of texts.

    Words are numbered as they come; a table has the hash of each number's
    lower-cased word, so that a text costs one look-up per word.
    """

    def __init__(self, words: int):
        self.words = words
        self.numbers: dict[str, int] = {}
        self.hashes = np.zeros(1 << 16, np.uint64)

    def learn(self, words: set[str]) -> None:
        first = len(self.numbers)
        if first + len(words) > len(self.hashes):
            grown = np.zeros(2 * (first + len(words)), np.uint64)
            grown[:first] = self.hashes[:first]
            self.hashes = grown
        for n, word in enumerate(words, first):
            self.numbers[word] = n
            self.hashes[n] = xxhash.xxh3_64_intdigest(word.translate(ASCII_LOWER))

    def sets(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        if len(self.numbers) > REMEMBERED:
            self.numbers = {}
        cut = []
        for text in texts:
            parts = (text or "").replace("\n", " ").replace("\t", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ")
            cut.append([w for w in parts if w] if "" in parts else parts)
        self.learn(set().union(*cut).difference(self.numbers))
        number = self.numbers.__getitem__
        for parts in cut:
            h = self.hashes[np.fromiter(map(number, parts), np.int64, len(parts))]
            k = min(self.words, len(h))
            if not k:
                yield h
                continue
            value = np.full(len(h) - k + 1, k, np.uint64)
            for i in range(k):
                value = (value ^ (value >> np.uint64(31))) * MULTIPLIERS[i % 4] + h[i : len(h) - k + 1 + i]
            value = (value ^ (value >> np.uint64(29))) * MULTIPLIERS[1]
            yield np.unique(value ^ (value >> np.uint64(32)))


def segment_keys(held: np.ndarray, group: int, fragments: int) -> np.ndarray:
    """One key per fragment: its number and the sum of its n-grams' hashes.

    Fragments cut the order of hashes into equal ranges; n-grams are distinct,
    so a wrapping sum of mixed hashes stands for the segment.
    """
    at = ((held >> np.uint64(32)) * np.uint64(fragments)) >> np.uint64(32)
    sums = np.zeros(fragments, np.uint64)
    mixed = (held ^ (held >> np.uint64(27))) * MULTIPLIERS[3]
    starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    sums[at[starts].astype(np.int64)] = np.add.reduceat(mixed, starts)
    key = (sums ^ (sums >> np.uint64(30))) + np.arange(fragments, dtype=np.uint64) * MULTIPLIERS[0] + np.uint64(group) * MULTIPLIERS[2]
    key = (key ^ (key >> np.uint64(31))) * MULTIPLIERS[1]
    return key ^ (key >> np.uint64(33))


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x, np.uint64).view(np.int64))


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(docs[id_col].alias("_id"), docs[text_col].alias("_text"), F.xxhash64(docs[text_col]).alias("_x"))


def summaries(docs: DataFrame, like: Similarity, id_col: str, text_col: str) -> DataFrame:
    """Per row: id, text hash, set size, class (128-bit digest of the set), and
    per size group (the own and, where needed, the next) its segment keys and
    how many of them it must share."""
    ship_code(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, empty = Shingler(like.words), np.zeros(0, np.uint64)
        for batch in batches:
            for first in range(0, batch.num_rows, 512):
                part = batch.slice(first, 512)
                size, node, keys, need = [], [], ([], []), ([], [])
                with np.errstate(over="ignore"):
                    for held in tool.sets(part.column(1).to_pylist()):
                        size.append(len(held))
                        node.append(xxhash.xxh3_128_digest(held.tobytes()))
                        groups = like.groups(len(held)) if len(held) else []
                        for i in (0, 1):
                            there = i < len(groups)
                            keys[i].append(segment_keys(held, groups[i], like.fragments(groups[i])) if there else empty)
                            need[i].append(like.slack(groups[i]) + 1 if there else 1)
                lists = [pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, k)]), pa.int32()), _signed(np.concatenate([empty, *k]))) for k in keys]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(size, pa.int64()), pa.array(node, pa.binary()), lists[0], pa.array(need[0], pa.int64()), lists[1], pa.array(need[1], pa.int64())], ["_id", "_x", "_n", "_node", *NEEDED])

    return _rows(docs, id_col, text_col).mapInArrow(run, f"_id {kind}, _x long, _n long, _node binary, _own array<long>, _own_need long, _next array<long>, _next_need long")


def live_classes(summary: DataFrame, like: Similarity) -> DataFrame:
    """(class, node, _x) of the classes that share enough segments to have a
    partner, numbered by ``node``.

    Of the linked classes none is missed; others may be among them, as those
    whose copies alone share their segments. _x picks one text of the class.
    """
    each = summary.select(F.explode(F.concat("_own", "_next")).alias("key"))
    shared = staged(each.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), "shared-keys")
    known = KeyFilter.of(shared, "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for name, least in (("_own", "_own_need"), ("_next", "_next_need")):
                lists = batch.column(name)
                row = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
                hits = row[known.may_hold(lists.flatten().to_numpy().view(np.uint64))]
                keep |= np.bincount(hits, minlength=batch.num_rows) >= batch.column(least).to_numpy()
            yield batch.select(["_node", "_x"]).filter(pa.array(keep))

    if known:
        found = summary.select("_node", "_x", *NEEDED).mapInArrow(run, "_node binary, _x long")
    else:
        one = summary.groupBy("_node").agg(F.min("_x").alias("_x"), *(F.first(c).alias(c) for c in NEEDED))
        parts = (one.select("_node", "_x", F.col(f"{c}_need").alias("need"), F.explode(c).alias("key")) for c in ("_own", "_next"))
        hits = next(parts).unionByName(next(parts)).join(shared, "key", "left_semi").groupBy("_node", "_x", "need").agg(F.count("*").alias("hits"))
        found = hits.where("hits >= need").select("_node", "_x")
    found = found.groupBy(F.col("_node").alias("class")).agg(F.min("_x").alias("_x"))
    found = staged(found.withColumn("node", F.monotonically_increasing_id()), "live-classes")
    drop(shared)
    return found


def fragments(docs: DataFrame, like: Similarity, id_col: str, text_col: str, live: DataFrame) -> DataFrame:
    """(node, fragment, size, grams) of the live classes, staged.

    One text per class is read again. What a filter lets pass beside them finds
    no class.
    """
    chosen = live.select("_x").distinct()
    known = KeyFilter.of(chosen, "_x")
    rows = _rows(docs, id_col, text_col).select("_text", "_x")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, empty = Shingler(like.words), np.zeros(0, np.uint64)
        ends = np.arange(1, WIDE, dtype=np.uint64) << np.uint64(64 - WIDE.bit_length() + 1)
        # A task sends each class once, however many copies it reads.
        texts: set[int] = set()
        sent: set[bytes] = set()
        for batch in batches:
            x = batch.column(1).to_numpy()
            keep = known.may_hold(x.view(np.uint64)) if known else np.ones(len(x), bool)
            for i in np.flatnonzero(keep).tolist():
                if (own := int(x[i])) in texts:
                    keep[i] = False
                texts.add(own)
            wanted = batch.column(0).filter(pa.array(keep))
            for first in range(0, len(wanted), 512):
                node, number, size, lists = [], [], [], []
                with np.errstate(over="ignore"):
                    for grams in tool.sets(wanted.slice(first, 512).to_pylist()):
                        digest = xxhash.xxh3_128_digest(grams.tobytes())
                        if digest in sent:
                            continue
                        sent.add(digest)
                        for f, piece in enumerate(np.split(grams, np.searchsorted(grams, ends))):
                            if len(piece):
                                node.append(digest)
                                number.append(f)
                                size.append(len(grams))
                                lists.append(piece)
                cut = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, lists)]), pa.int32()), _signed(np.concatenate([empty, *lists])))
                yield pa.RecordBatch.from_arrays([pa.array(node, pa.binary()), pa.array(number, pa.int32()), pa.array(size, pa.int64()), cut], ["class", "fragment", "size", "grams"])

    rows = rows if known else rows.join(chosen, "_x", "left_semi").select("_text", "_x")
    cut = rows.mapInArrow(run, "class binary, fragment int, size long, grams array<long>")
    return staged(cut.join(live, "class").dropDuplicates(["class", "fragment"]).select("node", "fragment", "size", "grams"), "fragments")


def prefixes(held: DataFrame, like: Similarity) -> DataFrame:
    """(key, node, n, own, hi): the n-grams by which partners can first meet.

    n-grams are ordered from rare to frequent among the live classes. If the
    first common one of two sets stands at place p of the set of n, at most
    n - p + 1 are common, so the other set has at most ``hi`` n-grams. ``own``
    counts n-grams of no other class, which come first and are not keys.
    """
    p = like.percent
    grams = held.select("node", F.col("size").alias("n"), F.explode("grams").alias("key"))
    often = grams.groupBy("key").agg(F.count("*").alias("df")).where("df > 1")
    lists = grams.join(often, "key").groupBy("node").agg(F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("df", "key"))).alias("keys"))
    lists = lists.withColumn("own", F.col("n") - F.size("keys")).withColumn("most", F.expr(f"cast(n - (n * {p} + 99) div 100 + 1 - own as int)")).where("most > 0")
    rows = lists.select("node", "n", "own", F.posexplode(F.slice("keys", F.lit(1), F.col("most"))).alias("at", "k"))
    hi = F.expr(f"(n - own - at) * {100 + p} div {p} - n")
    return staged(rows.select(F.col("k.key").alias("key"), "node", "n", "own", hi.alias("hi")), "prefixes")


def partial_overlaps(pairs: pa.Table, sets: pa.Table) -> pa.Table:
    """Per pair, in one fragment: how many n-grams of b are in a as well, and a
    64-bit mask of the others of b, by their low bits."""
    held = {node: frozenset(grams) for node, grams in zip(sets["node"].to_pylist(), sets["grams"].to_pylist())}
    none: frozenset[int] = frozenset()
    same, mask = [], []
    for x, y in zip(pairs["a"].to_pylist(), pairs["b"].to_pylist()):
        theirs = held.get(y, none)
        missed = theirs - held.get(x, none)
        same.append(len(theirs) - len(missed))
        bits = 0
        for gram in missed:
            bits |= 1 << (gram & 63)
        mask.append(bits)
    return pairs.select(["a", "b", "fragment"]).append_column("same", pa.array(same, pa.int64())).append_column("mask", _signed(np.array(mask, np.uint64)))


def overlaps(pairs: DataFrame, held: DataFrame, per_cell: int = 8_000) -> DataFrame:
    """(a, b, same, m0 to m7) of the pairs (a, b): partial overlaps and masks,
    counted apart in each fragment, then summed per pair.

    Pairs are dealt to cells of a grid by the hashes of both sides, about
    ``per_cell`` to one, and a segment is sent once to each cell that compares
    it: not once per pair.
    """
    wide = max(1, math.ceil(math.sqrt(pairs.count() / per_cell)))
    cell = F.pmod(F.xxhash64("a"), F.lit(wide)) * wide + F.pmod(F.xxhash64("b", F.lit(1)), F.lit(wide))
    dealt = pairs.select(cell.alias("cell"), "a", "b")
    needed = dealt.select(F.col("cell").alias("at"), F.col("a").alias("node")).union(dealt.select("cell", "b")).distinct()
    sent = needed.join(held.select("node", F.col("fragment").alias("part"), "grams"), "node").select("at", "part", "node", "grams")
    dealt = dealt.select("cell", F.explode(F.array(*(F.lit(f) for f in range(WIDE)))).alias("fragment"), "a", "b")

    def count(ours: pa.Table, theirs: pa.Table) -> pa.Table:
        return partial_overlaps(ours, theirs)

    partial = dealt.groupBy("cell", "fragment").cogroup(sent.groupBy("at", "part")).applyInArrow(count, "a long, b long, fragment int, same long, mask long")
    masks = [F.sum(F.when(F.col("fragment") == f, F.col("mask")).otherwise(0)).alias(f"m{f}") for f in range(WIDE)]
    return partial.groupBy("a", "b").agg(F.sum("same").alias("same"), *masks)


def joined(docs: DataFrame, like: Similarity, id_col: str, text_col: str, live: DataFrame) -> DataFrame | None:
    """(node, label) of all classes that link with another; None if none do."""
    p, used = like.percent, []

    def keep(df: DataFrame, name: str) -> DataFrame:
        used.append(staged(df, name))
        return used[-1]

    held = fragments(docs, like, id_col, text_col, live)
    rows = prefixes(held, like)
    used += [held, rows]
    # The pivot of a key has the least share of n-grams of its own.
    order = F.struct((F.col("own") / F.col("n")).alias("share"), F.xxhash64("node").alias("hash"), "node", "n", "own", "hi")
    keys = rows.groupBy("key").agg(F.count("*").alias("rows"), F.min(order).alias("p")).where("rows > 1")
    keys = keys.select("key", "rows", F.col("p.node").alias("pivot"), F.col("p.n").alias("pn"), F.col("p.hi").alias("ph"))
    each = keep(rows.join(keys, "key").where("node <> pivot"), "key-rows")
    pairs = keep(each.where("rows > 2 or (n <= ph and pn <= hi)").groupBy(F.col("node").alias("a"), F.col("pivot").alias("b")).agg(F.max("n").alias("n"), F.max("own").alias("own"), F.max("pn").alias("pn")), "pivot-pairs")
    if not pairs.take(1):
        for df in used:
            drop(df)
        return None
    seen = keep(pairs.join(overlaps(pairs, held), ["a", "b"]), "pivot-overlaps")
    links = seen.where(f"same * {100 + p} >= (n + pn) * {p}").select("a", "b")
    label = keep(components(links), "labels")
    rest = keep(_rest(each, seen, label, p), "rest-pairs")
    more = overlaps(rest.select("a", "b"), held).join(rest, ["a", "b"]).where(f"same * {100 + p} >= (n + m) * {p}").select("a", "b")
    found = keep(more, "rest-links")
    if found.take(1):
        # Components are contracted: only their labels go on.
        ends = [label.select(F.col("node").alias(c), F.col("label").alias(f"l{c}")) for c in "ab"]
        named = found.join(ends[0], "a", "left").join(ends[1], "b", "left").select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b"))
        upper = keep(components(named).select(F.col("node").alias("label"), F.col("label").alias("top")), "upper-labels")
        lower = label.join(upper, "label", "left").select("node", F.coalesce("top", "label").alias("label"))
        alone = upper.select(F.col("label").alias("node"), F.col("top").alias("label")).join(label, "node", "left_anti")
        label = staged(lower.union(alone), "labels")
    else:
        used.remove(label)
    for df in used:
        drop(df)
    return label


def _rest(each: DataFrame, seen: DataFrame, label: DataFrame, p: int) -> DataFrame:
    """Pairs (a, b, n, m) of a key that can still link: in different components,
    of sizes that fit, and with room for enough common n-grams beside the
    pivot's that either lacks: with x n-grams outside the pivot that others
    hold, two sets share at most pivot - (missed by a or b) + least(x) ones."""
    masks = [f"m{f}" for f in range(WIDE)]
    seen = seen.select(F.col("a").alias("node"), F.col("b").alias("pivot"), (F.col("n") - F.col("same") - F.col("own")).alias("x"), *masks)
    named = each.where("rows > 2").join(seen, ["node", "pivot"]).join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))
    open_ = named.groupBy("key").agg(F.min("label").alias("x0"), F.max("label").alias("x1")).where("x0 <> x1").select("key")
    ours = named.join(open_, "key", "left_semi").select("key", "node", "label", "n", "hi", "pn", "x", *masks)
    theirs = ours.select("key", *(F.col(c).alias(f"{c}_") for c in ("node", "label", "n", "hi", "x", *masks)))
    missed = " + ".join(f"bit_count({m} | {m}_)" for m in masks)
    fit = f"node < node_ and label <> label_ and n <= hi_ and n_ <= hi and (pn - ({missed}) + least(x, x_)) * {100 + p} >= (n + n_) * {p}"
    pairs = ours.join(theirs, "key").where(fit)
    return pairs.groupBy(F.col("node").alias("a"), F.col("node_").alias("b")).agg(F.max("n").alias("n"), F.max("n_").alias("m"))


def _joined_rows(docs: DataFrame, like: Similarity, id_col: str, text_col: str) -> DataFrame:
    """Per row: _id, _x (text hash), _n, and _least, the first row of its
    component as (id is null, id, text hash); null for the empty set."""
    summary = staged(summaries(docs, like, id_col, text_col), "shingle-summaries")
    live = live_classes(summary, like)
    rows = staged(summary.select("_id", "_x", "_n", F.col("_node").alias("node")), "classes")
    drop(summary)
    label = joined(docs, like, id_col, text_col, live)
    if label is not None:
        names = live.select(F.col("node").alias("label"), F.col("class").alias("_label"))
        label = staged(label.join(live, "node").select("class", "label").join(names, "label").drop("label"), "class-labels")
    drop(live)
    rows = rows.withColumn("_label", F.col("node"))
    if label is not None:
        rows = rows.drop("_label").join(label, F.col("node") == F.col("class"), "left").withColumn("_label", F.coalesce("_label", "node"))
    rows = rows.withColumn("_first", F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("_x").alias("x")))
    least = rows.where("_n > 0").groupBy(F.col("_label").alias("_of")).agg(F.min("_first").alias("_least"))
    return rows.join(least, F.col("_label") == F.col("_of"), "left").select("_id", "_x", "_n", "_first", "_least")


def classes(docs: DataFrame, like: Similarity = Similarity(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_shingles and component_id (the least id of its component)."""
    out = _joined_rows(docs, like, id_col, text_col)
    return out.select(F.col("_id").alias(id_col), F.col("_n").alias("n_shingles"), F.when(F.col("_n") > 0, F.col("_least.id")).otherwise(F.col("_id")).alias("component_id"))


def apply(docs: DataFrame, like: Similarity = Similarity(5, 80), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents but those that a document before them is linked with, in
    the order of id (null last), then text hash; rows equal in both are one."""
    found = _joined_rows(docs, like, id_col, text_col)
    gone = found.where("_least < _first").select(F.col("_id").alias("_gone"), F.col("_x").alias("_gone_x")).distinct()
    return docs.join(gone, docs[id_col].eqNullSafe(gone["_gone"]) & (F.xxhash64(docs[text_col]) == gone["_gone_x"]), "left_anti")


def op9(spark, sf_dir: str) -> DataFrame:
    return classes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
