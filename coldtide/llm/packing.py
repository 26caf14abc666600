"""Best-two-fit packing of tokenized documents into fixed-length sequences.

Documents are tokenized in Arrow batches; each becomes one piece, or several
where it is longer than a sequence. Only a narrow row per piece is shuffled,
by a hash of the piece, to tasks that pack it. A task sorts its pieces by that
hash, so results do not depend on the order in which blocks arrive and a lost
task's repetition gives the same sequences, and packs them in windows of a
fixed number of pieces, which bounds memory at any partition size.

Best-two-fit: a sequence is filled greedily, each time with the longest piece
that fits. Then, if it has a gap, its smallest
piece gives way to the two unpacked pieces that fill the widened gap best, if
they fill more of it.

Defined cases: null text is the empty text, which is one piece of one end
token; null or repeated ids pass through; other columns are not read; an empty
table gives no piece. Equal lengths are taken in the order of the piece hash.
"""

from __future__ import annotations

import json
import os
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coldtide.session import ship_code

WINDOW = 1 << 18
#: Words remembered in each of two generations, and parts of words in all.
REMEMBERED = 400_000
LONGEST = 64
#: Bytes of text that are cut and looked up at a time.
GROUP = 1 << 23

#: The rules of a tokenizer file under which words and their parts stand alone.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
RULES = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": SPLIT}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
    "post_processor": None,
}
#: Characters that lower() and normalization change one by one, if at all.
PLAIN = regex.compile("[ -~\u00a1-\u00ac\u00ae-\u00ff]*")
PARTS = regex.compile(SPLIT + "| ")
#: Bytes that do not print are shown as the next characters from 256 on.
SHOWN = {byte: 256 + n for n, byte in enumerate(b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174))}


class WordTokenizer:
    """A tokenizer of the tokenizers library whose ids of words are remembered.

    With a file of RULES no token reaches across a space, a tab or a line
    break, so a text's ids are those of its words, one after the other, and the
    ids of a plain word are those of the parts that the rules cut it into.
    Special tokens hold no blank either; in a text they give their own ids, as
    in the library's plain ``encode``. Texts under other rules, and words of
    other characters or with special tokens, are left to the library whole.
    """

    def __init__(self, file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tool = Tokenizer.from_file(file)
        with open(file, encoding="utf-8") as held:
            rules = json.load(held)
        added = rules["added_tokens"]
        self.special = [x["content"] for x in added]
        apart = not any(x["lstrip"] or x["rstrip"] or x["single_word"] or x["normalized"] or regex.search(r"\s", x["content"]) for x in added)
        self.by_words = apart and all(rules[k] == v for k, v in RULES.items())
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [np.array(out.ids, "<u4").tobytes() for out in self.tool.encode_batch_fast(texts, add_special_tokens=False)]

    def _plain(self, words: list[str]) -> list[bytes]:
        """Ids of words of plain characters without special tokens: their parts
        go straight to the model, by the characters that stand for their bytes."""
        found = PARTS.findall(" ".join(words).lower())
        if len(self.parts) > REMEMBERED:
            self.parts = {}
        model = self.tool.model
        for part in set(found).difference(self.parts):
            shown = part if part.isascii() else part.encode().decode("latin-1").translate(SHOWN)
            self.parts[part] = array("I", [x.id for x in model.tokenize(shown)]).tobytes()
        self.parts[" "] = b""
        ids, ends = [self.parts[x] for x in found], [i for i, x in enumerate(found) if x == " "]
        return [ids[a] if b - a == 1 else b"".join(ids[a:b]) for a, b in zip([0, *(e + 1 for e in ends)], [*ends, len(ids)])]

    def _learn(self, words: list[str]) -> None:
        if len(self.words) > REMEMBERED:
            self.older, self.words = self.words, {}
        known = {w: ids for w in words if (ids := self.older.get(w)) is not None}
        new = [w for w in words if w not in known]
        odd: list[str] = []
        joined = " ".join(new)
        if not PLAIN.fullmatch(joined) or any(x in joined for x in self.special):
            odd = [w for w in new if not PLAIN.fullmatch(w) or any(x in w for x in self.special)]
            new = list(set(new).difference(odd))
        if new:
            known.update(zip(new, self._plain(new)))
        for first in range(0, len(odd), 1024):
            known.update(zip(odd[first : first + 1024], self._encode(odd[first : first + 1024])))
        self.words.update(known)

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The 32-bit ids of all texts, and how many there are up to each one's
        end. Null is the empty text."""
        if not self.by_words:
            each = self._encode([x or "" for x in texts.to_pylist()])
            return np.frombuffer(b"".join(each), "<u4"), np.cumsum([len(x) // 4 for x in each])
        texts = pc.fill_null(texts, "")
        for blank in "\n\t\r":
            texts = pc.replace_substring(texts, blank, " ")
        cut = pc.split_pattern(texts, " ")
        coded = cut.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        get = self.words.get
        found = [get(w) for w in words]
        if None in found:
            new = [w for w, ids in zip(words, found) if ids is None]
            self._learn(new)
            get = self.words.__getitem__
            found = [get(w) if ids is None else ids for w, ids in zip(words, found)]
            for w in new:
                if len(w) > LONGEST:
                    del self.words[w]
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        at = np.cumsum(size) - size
        number = coded.indices.to_numpy()
        each = size[number]
        ends = np.cumsum(each)
        total = int(ends[-1]) if len(ends) else 0
        place = np.arange(total) + np.repeat(at[number] - ends + each, each)
        before = np.concatenate([[0], ends])
        return np.frombuffer(b"".join(found), "<u4")[place], before[cut.offsets.to_numpy()[1:] - cut.offsets[0].as_py()]


_tokenizers: dict[str, WordTokenizer] = {}


def _groups(texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """Runs of texts of about GROUP bytes, with the row of the first."""
    size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    first = 0
    while first < len(texts):
        done = int(size[first - 1]) if first else 0
        last = max(first + 1, int(np.searchsorted(size, done + GROUP)))
        yield first, texts.slice(first, last - first)
        first = last


def pieces(docs: DataFrame, tokenizer_file: str, end_id: int, length: int = 4096, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Id, piece, start, length and ids_crc32 (and ids) of every piece.

    The columns' names are those of the result, whatever others ``docs`` has.
    """
    ship_code(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer_file not in _tokenizers:
            _tokenizers[tokenizer_file] = WordTokenizer(tokenizer_file)
        tool, end = _tokenizers[tokenizer_file], np.array([end_id], "<u4")
        for batch in batches:
            row, piece, start, size, crc, ids_of = [], [], [], [], [], []
            for first, part in _groups(batch.column(1)):
                flat, ends = tool.ids(part)
                flat = np.insert(flat, ends, end)
                ends = (ends + np.arange(1, len(ends) + 1)).tolist()
                begin = 0
                for k, stop in enumerate(ends, first):
                    for n, at in enumerate(range(begin, stop, length)):
                        cut = flat[at : min(at + length, stop)]
                        row.append(k)
                        piece.append(n)
                        start.append(at - begin)
                        size.append(len(cut))
                        crc.append(zlib.crc32(cut))
                        if with_ids:
                            ids_of.append(cut.view("<i4"))
                    begin = stop
            columns = [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(size, pa.int64()), pa.array(crc, pa.int64())]
            if with_ids:
                columns.append(pa.array(ids_of, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, [id_col, "piece", "start", "length", "ids_crc32", "ids"][: len(columns)])

    return docs.select(docs[id_col].alias(id_col), docs[text_col].alias("_text")).mapInArrow(run, schema)


class BestTwoFit:
    """Packs lengths of 1 to ``capacity`` that are known by their counts."""

    def __init__(self, lengths: np.ndarray, capacity: int):
        self.capacity = capacity
        order = np.argsort(lengths, kind="stable")
        self.stacks: dict[int, list[int]] = {}
        values, first = np.unique(lengths[order], return_index=True)
        for value, items in zip(values.tolist(), np.split(order, first[1:]) if len(order) else []):
            self.stacks[value] = items[::-1].tolist()
        #: Bit v: a piece of length v is unpacked; in mirror, bit capacity - v.
        self.present = sum(1 << v for v in self.stacks)
        self.mirror = sum(1 << (capacity - v) for v in self.stacks)

    def _take(self, value: int) -> int:
        stack = self.stacks[value]
        item = stack.pop()
        if not stack:
            self.present ^= 1 << value
            self.mirror ^= 1 << (self.capacity - value)
        return item

    def _give(self, value: int, item: int) -> None:
        stack = self.stacks[value]
        if not stack:
            self.present |= 1 << value
            self.mirror |= 1 << (self.capacity - value)
        stack.append(item)

    def _longest(self, most: int) -> int:
        return (self.present & ((2 << most) - 1)).bit_length() - 1

    def _pair(self, gap: int, over: int) -> tuple[int, int] | None:
        """The two unpacked lengths of the largest sum in (over, gap]."""
        for total in range(gap, over, -1):
            both = self.present & (self.mirror >> (self.capacity - total)) & ((1 << total) - 1)
            if total % 2 == 0 and both >> (total // 2) & 1 and len(self.stacks[total // 2]) < 2:
                both ^= 1 << (total // 2)
            if both:
                a = both.bit_length() - 1
                return a, total - a
        return None

    def sequences(self) -> Iterator[list[int]]:
        """Item numbers of one sequence after the other."""
        while self.present:
            gap, held = self.capacity, []
            while gap and self.present and (value := self._longest(gap)) > 0:
                held.append((value, self._take(value)))
                gap -= value
            if gap and held and self.present:
                smallest, item = held[-1]
                if pair := self._pair(gap + smallest, smallest):
                    held.pop()
                    held += [(v, self._take(v)) for v in pair]
                    self._give(smallest, item)
            yield [item for _, item in held]


def packed(parts: DataFrame, capacity: int = 4096, window: int = WINDOW, length_col: str = "length") -> DataFrame:
    """``parts`` with ``sequence_id`` and ``offset``; other columns pass through.

    The number of tasks is that of the shuffle: few enough rows for one task to
    hold, many enough for gaps at a task's end not to count.
    """
    ship_code(parts.sparkSession)
    names = list(parts.columns)
    schema = T.StructType([*parts.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    at = names.index(length_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        next_id = (task.partitionId() if task else 0) << 40
        held: list[pa.RecordBatch] = []
        rows = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal next_id
            table = pa.Table.from_batches(held).combine_chunks()
            lengths = table.column(at).to_numpy()
            number, place = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
            for items in BestTwoFit(lengths, capacity).sequences():
                sizes = lengths[items]
                number[items] = next_id
                place[items] = np.cumsum(sizes) - sizes
                next_id += 1
            table = table.drop_columns([table.column_names[-1]])
            table = table.append_column("sequence_id", pa.array(number)).append_column("offset", pa.array(place))
            yield from table.to_batches(max_chunksize=10_000)

        for batch in batches:
            while batch.num_rows:
                cut = batch.slice(0, window - rows)
                batch = batch.slice(cut.num_rows)
                held.append(cut)
                rows += cut.num_rows
                if rows == window:
                    yield from flush()
                    held, rows = [], 0
        if rows:
            yield from flush()

    key = F.xxhash64(*names)
    dealt = parts.withColumn("_key", key).repartition("_key").sortWithinPartitions("_key", *names)
    return dealt.mapInArrow(run, schema)


def op5(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return packed(pieces(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1))
