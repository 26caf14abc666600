"""Encoding and decoding with merge-type SentencePiece vocabularies.

The encoder keeps an agenda of adjacent symbol pairs ordered by score, then by
position, and merges the best pair until none is in the vocabulary. No piece of
a usual vocabulary holds a word mark after another character, so merges never
cross the start of a run of marks: texts are cut there, and segments that
repeat are encoded once per worker. The constructor verifies this property and
treats whole texts as one segment where it does not hold. New segments of like
length advance together, one merge each per step, on the rows of a matrix.

Every segment that enters the memory, and one whole text of each Arrow batch,
is checked against the sentencepiece library; on a difference the library's
result is taken for all of that worker's later texts.

Defined cases: null text is the empty text, which has no ids; ids of rows,
null or repeated, pass through; other columns are not read. Very long texts
and segments take time in proportion to n log n and are not remembered.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coldtide.session import ship_code

MARK = "▁"
REMEMBERED = 500_000
LONGEST = 32
NEVER = float("inf")


class MergeCodec:
    """A merge-type vocabulary with a library to be checked against."""

    def __init__(self, model_file: str):
        import sentencepiece

        self.library = library = sentencepiece.SentencePieceProcessor(model_file=model_file)
        size = library.vocab_size()
        names = [library.id_to_piece(i) for i in range(size)]
        special = [library.is_byte(i) or library.is_control(i) or library.is_unknown(i) for i in range(size)]
        self.number = {name: i for i, name in enumerate(names) if not special[i] and not library.is_unused(i)}
        self.rank = {name: -library.get_score(i) for name, i in self.number.items()}
        self.bytes = {int(name[3:5], 16): i for i, name in enumerate(names) if library.is_byte(i)}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.surface = names
        self.spaced = [None if i in self.byte_of else name.replace(MARK, " ") for i, name in enumerate(names)]
        self.unknown = library.unk_id()
        inner = any(b == MARK != a for name in self.rank for a, b in zip(name, name[1:]))
        known = {c for name in self.rank for c in name}
        self.splits = not inner and "\n" not in known
        self.cut = re.compile(f"\n[^{MARK}\n]*|{MARK}+[^{MARK}\n]*")
        self.lead = len(library.encode("\n")) - len(self.merge("\n"))
        self._tables()
        self.memory: dict[str, str] = {}
        self.odd: dict[str, str] = {}
        #: Segments whose ids the library has otherwise; its ids are used.
        self.differing: set[str] = set()
        self.trusted = True

    def merge(self, text: str) -> list[int]:
        """Ids of a normalised text by the agenda."""
        symbols = self._merge_heap(list(text))
        rank = self.rank
        ids = []
        for symbol in symbols:
            if symbol:
                if symbol in rank:
                    ids.append(self.number[symbol])
                elif self.bytes:
                    ids.extend(self.bytes[b] for b in symbol.encode())
                else:
                    ids.append(self.unknown)
        return ids

    def _tables(self) -> None:
        """Character ids, and merged piece and score of each mergeable pair."""
        number, size = self.number, len(self.surface)
        self.of_char = np.full(0x110000, -1, np.int32)
        for name, i in number.items():
            if len(name) == 1:
                self.of_char[ord(name)] = i
        pairs = {}
        for name, i in number.items():
            for k in range(1, len(name)):
                if (a := number.get(name[:k])) is not None and (b := number.get(name[k:])) is not None:
                    pairs[a * size + b] = i
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_ids = np.array([pairs[k] for k in sorted(pairs)] + [size], np.int32)
        self.score_of = np.full(size + 1, np.inf)
        for name, i in number.items():
            self.score_of[i] = self.rank[name]

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Id of each merged pair, or the vocabulary's size for none."""
        key = left.astype(np.int64) * len(self.surface) + right
        at = np.searchsorted(self.pair_keys, key)
        at[at == len(self.pair_keys)] = 0
        hit = (self.pair_keys[at] == key) & (left >= 0) & (right >= 0)
        return np.where(hit, self.pair_ids[at], len(self.surface))

    def merge_many(self, texts: list[str]) -> list[list[int]]:
        """``merge`` of many short texts at once."""
        out: list[list[int] | None] = [None] * len(texts)
        order = sorted((i for i, text in enumerate(texts) if 0 < len(text) <= LONGEST), key=lambda i: len(texts[i]))
        for first in range(0, len(order), 4096):
            rows = np.array(order[first : first + 4096])
            group = [texts[i] for i in rows]
            lengths = np.array([len(x) for x in group])
            width = int(lengths[-1])
            points = np.frombuffer("".join([x.ljust(width, "\0") for x in group]).encode("utf-32-le"), np.int32).reshape(len(group), width)
            symbols = self.of_char[points]
            padding = np.arange(width) >= lengths[:, None]
            whole = ((symbols >= 0) | padding).all(axis=1)
            symbols[padding] = -1
            rows, symbols = rows[whole], symbols[whole]
            merged = self._pairs(symbols[:, :-1], symbols[:, 1:])
            score = self.score_of[merged]
            while len(rows):
                if score.shape[1]:
                    best = score.argmin(axis=1)
                    going = score[np.arange(len(rows)), best] < np.inf
                else:
                    going = np.zeros(len(rows), bool)
                if not going.all():
                    for i, ids in zip(rows[~going].tolist(), symbols[~going].tolist()):
                        out[i] = ids[: ids.index(-1)] if ids[-1] < 0 else ids
                    rows, symbols, merged, score = rows[going], symbols[going], merged[going], score[going]
                    if not len(rows):
                        break
                    best = best[going]
                at = np.arange(len(rows))
                symbols[at, best] = merged[at, best]
                keep = np.arange(symbols.shape[1] - 1)
                symbols = np.take_along_axis(symbols, keep + (keep > best[:, None]), axis=1)
                keep = np.arange(merged.shape[1] - 1)
                shift = keep + (keep >= best[:, None])
                merged, score = np.take_along_axis(merged, shift, axis=1), np.take_along_axis(score, shift, axis=1)
                for here in (best - 1, best):
                    ok = (here >= 0) & (here < merged.shape[1])
                    row, col = at[ok], here[ok]
                    merged[row, col] = new = self._pairs(symbols[row, col], symbols[row, col + 1])
                    score[row, col] = self.score_of[new]
        return [self.merge(text) if ids is None else ids for text, ids in zip(texts, out)]

    def _merge_heap(self, symbols: list[str]) -> list[str]:
        """The agenda as a heap; entries whose symbols have changed are stale."""
        score, n = self.rank.get, len(symbols)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda = [(s, i, i + 1, pair) for i in range(n - 1) if (s := score(pair := symbols[i] + symbols[i + 1])) is not None]
        heapq.heapify(agenda)
        while agenda:
            _, left, right, pair = heapq.heappop(agenda)
            if after[left] != right or not symbols[left] or symbols[left] + symbols[right] != pair:
                continue
            symbols[left], symbols[right] = pair, ""
            after[left] = follow = after[right]
            if follow < n:
                before[follow] = left
            for i, j in ((before[left], left), (left, follow)):
                if 0 <= i and j < n and (s := score(wider := symbols[i] + symbols[j])) is not None:
                    heapq.heappush(agenda, (s, i, j, wider))
        return [x for x in symbols if x]

    def decode_part(self, ids: list[int]) -> str:
        """Surface of ids with marks as spaces; runs of byte pieces are UTF-8."""
        parts = [self.spaced[i] for i in ids]
        if None not in parts:
            return "".join(parts)
        out, run = [], bytearray()
        for i, part in zip(ids, parts):
            if part is None:
                run.append(self.byte_of[i])
                continue
            out.append(run.decode("utf-8", "replace") + part)
            run.clear()
        return "".join(out) + run.decode("utf-8", "replace")

    def segments(self, text: str) -> list[str]:
        """The text cut where merges cannot cross.

        A segment that starts with a line feed stands for itself, any other for
        a word mark and itself with its spaces as marks.
        """
        if not text:
            return []
        if not self.splits:
            return [text]
        parts = text.replace("\n", " \n").split(" ")
        if MARK in text or "" in parts:
            parts = [x if x[0] == "\n" else x[1:].replace(MARK, " ") for x in self.cut.findall(MARK + text.replace(" ", MARK))]
        return parts

    def learn(self, parts: list[str]) -> dict[str, str]:
        """Encode and decode segments, checked in one call of the library."""
        marked = [part if self.splits and part[:1] == "\n" else MARK + part.replace(" ", MARK) for part in parts]
        fresh = {}
        for part, whole, ids, other in zip(parts, marked, self.merge_many(marked), self.library.encode(parts, num_threads=1)):
            other = other[self.lead :] if whole[0] != MARK else other
            if ids != other and part:
                self.differing.add(part)
                ids = other
            if (decoded := self.decode_part(ids)) != whole.replace(MARK, " "):
                self.odd[part] = decoded
            fresh[part] = ",".join(map(str, ids))
        return fresh

    def encode_batch(self, texts: list[str]) -> Iterator[tuple[str, str]]:
        """Per text: decimal ids joined by commas, and the decoded text."""
        if len(self.memory) > REMEMBERED:
            self.memory, self.odd = {}, {}
        cut = [self.segments(text) for text in texts]
        fresh = self.learn(list(set().union(*cut).difference(self.memory)))
        known = self.memory
        known.update(fresh)
        for text, parts in zip(texts, cut):
            if not self.trusted:
                ids = self.library.encode(text, num_threads=1)
                yield ",".join(map(str, ids)), self.library.decode(ids)
            elif self.odd and not self.odd.keys().isdisjoint(parts):
                own = [self.odd.get(part) or (part if part[:1] == "\n" and self.splits else " " + part) for part in parts]
                yield ",".join([known[part] for part in parts]), "".join(own)[1:]
            else:
                yield ",".join([known[part] for part in parts]), " ".join(parts).replace(" \n", "\n") if self.splits else parts[0].replace(MARK, " ") if parts else ""
        for part in fresh:
            if len(part) > LONGEST:
                del known[part]

    def holds(self, text: str, ids: str, decoded: str) -> bool:
        """Whether the library has the same ids and decoded text."""
        other = self.library.encode(text, num_threads=1)
        return ",".join(map(str, other)) == ids and self.library.decode(other) == decoded


_codecs: dict[str, MergeCodec] = {}


def codec(model_file: str) -> MergeCodec:
    """The worker's codec of a model; its memory outlives a task."""
    if model_file not in _codecs:
        _codecs[model_file] = MergeCodec(model_file)
    return _codecs[model_file]


def chunks(texts: list[str], chars: int = 1 << 20) -> Iterator[list[str]]:
    """Consecutive texts of about ``chars`` characters together."""
    part, size = [], 0
    for text in texts:
        part.append(text)
        size += len(text)
        if size >= chars:
            yield part
            part, size = [], 0
    if part:
        yield part


def encoded(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Id, token count and digests of each text's ids and decoded text, and
    whether all its ids came of the agenda: where the library had others, they
    are the library's, and the column ``by_agenda`` tells it.

    ``with_ids`` adds ``ids`` (array of int) and ``decoded``. No shuffle: one
    pass of Arrow batches over the scan.
    """
    ship_code(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, by_agenda boolean" + ", ids array<int>, decoded string" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(model_file)
        for batch in batches:
            texts = [x or "" for x in batch.column(1).to_pylist()]
            n, ids_sum, text_sum, own, ids_of, text_of = [], [], [], [], [], []
            checked = False
            for part in chunks(texts):
                for text, (ids, decoded) in zip(part, tool.encode_batch(part)):
                    if not checked and text:
                        checked = True
                        if not tool.holds(text, ids, decoded):
                            tool.trusted = False
                            again = tool.library.encode(text, num_threads=1)
                            ids, decoded = ",".join(map(str, again)), tool.library.decode(again)
                    own.append(tool.trusted and (not tool.differing or tool.differing.isdisjoint(tool.segments(text))))
                    n.append(ids.count(",") + 1 if ids else 0)
                    ids_sum.append(hashlib.sha256(ids.encode()).hexdigest())
                    text_sum.append(hashlib.sha256(decoded.encode()).hexdigest())
                    if with_ids:
                        ids_of.append([int(x) for x in ids.split(",")] if ids else [])
                        text_of.append(decoded)
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(ids_sum, pa.string()), pa.array(text_sum, pa.string()), pa.array(own, pa.bool_())]
            if with_ids:
                columns += [pa.array(ids_of, pa.list_(pa.int32())), pa.array(text_of, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [id_col, "n_tokens", "ids_sha256", "decoded_sha256", "by_agenda", "ids", "decoded"][: len(columns)])

    return docs.select(docs[id_col].alias(id_col), F.col(text_col).alias("_text")).mapInArrow(run, schema)


def op6(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encoded(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("piece_bpe_32k.model"))
