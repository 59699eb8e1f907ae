"""Token ids of documents as binary blocks whose document boundaries are Elias-Fano coded.

A block is one value of ``payload`` in a Parquet table (so Spark's committers write it, to any store,
and a lost task writes it anew). It is, in little-endian bytes:

    header   4 bytes "OWT1", id width (2 or 4) as u32, documents as u64, ids as u64
    ends     Elias-Fano code of the documents' end offsets in the block
    doc ids  smallest id as i64, Elias-Fano code of the ids less the smallest
    ids      all ids, one after the other

An Elias-Fano code is: low bits per value as u32, count as u64, words of the high part as u64, the low bits packed,
the high parts in unary, and the bit position of every 256th one as u32. ``EliasFano.select`` finds one
value from there by counting ones; no table of 64-bit offsets exists.

Documents are in ascending order of id over (part, block): rows are dealt by ranges of the id, so no
task sees more than its range, and blocks end after ``block_ids`` ids (a longer document is a block).

Defined cases: a missing text is empty and gives the end id alone. A missing doc_id drops the row.
Rows that share an id are all written, in the order of their texts. An empty table writes no block and
reads back as no rows. Other columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orewright.llm.base import kept_by_worker
from orewright.llm.words import slices

SAMPLE = 256
BLOCK_IDS = 1 << 19
BLOCKS = "part int, block int, n_docs long, n_ids long, payload binary"


class EliasFano:
    """A non-decreasing sequence of non-negative integers in about 2 + log2(highest / count) bits each."""

    def __init__(self, count: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.count, self.low_bits, self.low, self.high, self.samples = count, low_bits, low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n, top = len(values), int(values[-1]) if len(values) else 0
        low_bits = max(0, (top // n).bit_length() - 1) if n else 0
        ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros(((int(ones[-1]) if n else 0) // 64 + 1) * 64, np.uint8)
        bits[ones] = 1
        kept = (values[:, None] >> np.arange(low_bits, dtype=np.uint64)).astype(np.uint8) & 1
        low = np.packbits(kept.ravel(), bitorder="little")
        high = np.packbits(bits, bitorder="little").view("<u8")
        return cls(n, low_bits, low, high, ones[::SAMPLE].astype("<u4"))

    def select(self, i: int) -> int:
        """Value number i: from the nearest sample, count ones word by word."""
        if not 0 <= i < self.count:
            raise IndexError(i)
        word, bit = divmod(int(self.samples[i // SAMPLE]), 64)
        left, bits = i % SAMPLE, int(self.high[word]) >> bit << bit
        while (here := bits.bit_count()) <= left:
            left, word = left - here, word + 1
            bits = int(self.high[word])
        for _ in range(left):
            bits &= bits - 1
        at = word * 64 + (bits & -bits).bit_length() - 1
        return (at - i << self.low_bits) | self._low(i)

    def _low(self, i: int) -> int:
        first, shift = divmod(i * self.low_bits, 8)
        taken = int.from_bytes(self.low[first : first + (shift + self.low_bits + 7) // 8].tobytes(), "little")
        return taken >> shift & ((1 << self.low_bits) - 1)

    def all(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(self.high.view(np.uint8), bitorder="little"))
        values = (ones - np.arange(self.count)).astype(np.uint64) << np.uint64(self.low_bits)
        if self.low_bits and self.count:
            bits = np.unpackbits(self.low, bitorder="little")[: self.count * self.low_bits].reshape(self.count, -1)
            values |= (bits.astype(np.uint64) << np.arange(self.low_bits, dtype=np.uint64)).sum(1, dtype=np.uint64)
        return values.astype(np.int64)

    def to_bytes(self) -> bytes:
        head = np.array([self.low_bits], "<u4").tobytes() + np.array([self.count, len(self.high)], "<u8").tobytes()
        return head + self.low.tobytes() + self.high.tobytes() + self.samples.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes, at: int) -> tuple[EliasFano, int]:
        """The code that begins at a position, and the position behind it."""
        low_bits = int(np.frombuffer(data, "<u4", 1, at)[0])
        count, words = (int(x) for x in np.frombuffer(data, "<u8", 2, at + 4))
        at += 20
        low = np.frombuffer(data, np.uint8, (count * low_bits + 7) // 8, at)
        high = np.frombuffer(data, "<u8", words, at := at + len(low))
        samples = np.frombuffer(data, "<u4", (count + SAMPLE - 1) // SAMPLE, at := at + 8 * words)
        return cls(count, low_bits, low, high, samples), at + 4 * len(samples)


def block_bytes(doc_ids: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> bytes:
    """One block: documents in ascending order of id, their numbers of ids, all ids."""
    width = 2 if not len(ids) or int(ids.max()) < 1 << 16 else 4
    head = b"OWT1" + np.array([width], "<u4").tobytes() + np.array([len(doc_ids), len(ids)], "<u8").tobytes()
    names = EliasFano.of((doc_ids - doc_ids[0]).astype(np.uint64)).to_bytes()
    ends = EliasFano.of(np.cumsum(lengths)).to_bytes()
    return head + ends + np.array([doc_ids[0]], "<i8").tobytes() + names + ids.astype(f"<u{width}").tobytes()


class Block:
    """A block read back: ``ends`` and ``names`` answer by select, ``ids`` is a view of the bytes."""

    def __init__(self, data: bytes):
        if data[:4] != b"OWT1":
            raise ValueError("not a block of token ids")
        width = int(np.frombuffer(data, "<u4", 1, 4)[0])
        self.n_docs, self.n_ids = (int(x) for x in np.frombuffer(data, "<u8", 2, 8))
        self.ends, at = EliasFano.from_bytes(data, 24)
        self.first = int(np.frombuffer(data, "<i8", 1, at)[0])
        self.names, at = EliasFano.from_bytes(data, at + 8)
        self.ids = np.frombuffer(data, f"<u{width}", self.n_ids, at)

    def document(self, i: int) -> np.ndarray:
        """The ids of document number i of the block."""
        return self.ids[self.ends.select(i - 1) if i else 0 : self.ends.select(i)]


# --- encoding -----------------------------------------------------------------------------------------------

# The normalizer and the splitting of a tokenizer whose texts can be cut at white space.
_NORMALIZER = {
    "type": "Sequence",
    "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}],
}
_SPLITTING = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}

# Texts of printable ASCII and Latin-1 letters can be cut into the tokenizer's own pieces here, so that a piece
# that comes again is looked up. All others are encoded whole by the library.
_SIMPLE = re.compile(r"[!-~\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]+")
_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00DF-\u00F6\u00F8-\u00FF]+|[0-9]|[^\sa-z0-9\u00DF-\u00F6\u00F8-\u00FF]+|\n")
_CACHE = 250_000  # chunks, and pieces, that an encoder keeps: about 100 MB of a worker's memory
_TOGETHER = 4096  # pieces that are encoded at once


def _gathered(ids: array, ends: array, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the entries with these numbers of a store, one after the other, and where each entry begins and the last ends."""
    ends = np.array(ends)
    first, n = ends[at], ends[at + 1] - ends[at]
    upto = np.concatenate(([0], np.cumsum(n)))
    places = np.repeat(first - upto[:-1], n)
    places += np.arange(len(places))
    return np.array(ids, np.uint32)[places], upto


class ChunkEncoder:
    """Ids of chunks between white space under a tokenizer that drops white space and ends words.

    The normalizer and the splitting pattern of such a tokenizer never look across white space, so a
    text's ids are its chunks' ids in turn; ``tests/llm`` compares with whole texts. Chunks met before
    are looked up, in stores of bounded size that start anew when they are full. Under any other tokenizer, by what its file says,
    whole texts are encoded by the library.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.words = Tokenizer(self.tokenizer.model)
        self.words.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        with open(path, encoding="utf-8") as f:
            said = json.load(f)
        self.by_chunk = said.get("normalizer") == _NORMALIZER and said.get("pre_tokenizer") == _SPLITTING
        to_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        # Lower-case letters become an upper-case letter or sign and another sign, so none is replaced twice.
        self.letters = {chr(c): to_bytes.pre_tokenize_str(chr(c))[0][0] for c in range(0xDF, 0x100)}
        self.pieces: dict[str, int] = {"\n": 0}
        self.piece_ids, self.piece_ends = array("I"), array("q", [0, 0])
        self._renew()

    def _renew(self) -> None:
        """Begin a new store of chunks; pieces, which cost most to encode, stay until they are too many themselves."""
        if len(self.pieces) > _CACHE:
            # The line feed between chunks is a piece without ids.
            self.pieces, self.piece_ids, self.piece_ends = {"\n": 0}, array("I"), array("q", [0, 0])
        # The first entry is the end of a text, whose id is put in afterwards.
        self.numbers: dict[str, int] = {}
        self.ids, self.ends = array("I", [0]), array("q", [0, 1])

    def _enter(self, chunks: list[str]) -> None:
        """Give new chunks their numbers in the store, those of pieces all at once."""
        simple = [c for c in chunks if _SIMPLE.fullmatch(c) and "<|" not in c]
        if simple:
            pieces = _PIECES.findall("\n".join(simple).lower() + "\n")
            self._enter_pieces([p for p in dict.fromkeys(pieces) if p not in self.pieces])
            at = np.fromiter(map(self.pieces.__getitem__, pieces), np.int64, len(pieces))
            taken, upto = _gathered(self.piece_ids, self.piece_ends, at)
            self._extend(simple, taken, upto[1:][at == 0])
        if len(simple) < len(chunks):
            among = set(simple)
            for chunk in chunks:
                if chunk not in among:
                    ids = self.tokenizer.encode(chunk, add_special_tokens=False).ids
                    self._extend([chunk], np.array(ids, np.uint32), np.array([len(ids)]))

    def _extend(self, chunks: list[str], ids: np.ndarray, ends: np.ndarray) -> None:
        first = len(self.ends) - 1
        self.numbers.update(zip(chunks, range(first, first + len(chunks)), strict=True))
        self.ends.frombytes((ends + len(self.ids)).astype(np.int64).tobytes())
        self.ids.frombytes(ids.astype(np.uint32).tobytes())

    def _enter_pieces(self, pieces: list[str]) -> None:
        """Encode pieces by the tokenizer's model, as words of one text in its alphabet of bytes."""
        for begin in range(0, len(pieces), _TOGETHER):
            some = pieces[begin : begin + _TOGETHER]
            text = " ".join(some)
            for letter, in_bytes in self.letters.items():
                text = text.replace(letter, in_bytes)
            made = self.words.encode(text, add_special_tokens=False)
            n = np.bincount(np.array(made.word_ids, np.int64), minlength=len(some))
            first = len(self.piece_ends) - 1
            self.pieces.update(zip(some, range(first, first + len(some)), strict=True))
            self.piece_ends.frombytes((np.cumsum(n) + len(self.piece_ids)).astype(np.int64).tobytes())
            self.piece_ids.extend(made.ids)

    def texts(self, column: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a column of texts, each text followed by the end id, and the number of ids of each text."""
        if not self.by_chunk:
            return self._whole(column, end)
        if len(self.numbers) > _CACHE:
            self._renew()
        lists = pc.ascii_split_whitespace(pc.fill_null(column, "").cast(pa.large_string()))
        bounds = lists.offsets.to_numpy()
        codes = pc.dictionary_encode(pc.list_flatten(lists))
        words = codes.indices.to_numpy()
        chunks = codes.dictionary.to_pylist()
        at = np.fromiter(map(self.numbers.get, chunks, repeat(-1)), np.int64, len(chunks))
        new = np.flatnonzero(at < 0)
        self._enter(missing := [chunks[i] for i in new])
        at[new] = np.fromiter(map(self.numbers.__getitem__, missing), np.int64, len(new))
        at = at[words]
        bounds = bounds - bounds[0]
        out, upto = _gathered(self.ids, self.ends, np.insert(at, bounds[1:], 0))
        behind = upto[bounds[1:] + np.arange(1, len(bounds))]
        out[behind - 1] = end
        return out, np.diff(behind, prepend=0)

    def _whole(self, column: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """The same by the library, text by text."""
        found = [
            np.array([*self.tokenizer.encode(t or "", add_special_tokens=False).ids, end], np.uint32) for t in column.to_pylist()
        ]
        return np.concatenate([np.zeros(0, np.uint32), *found]), np.array([len(f) for f in found], np.int64)


def _encoder(path: str) -> ChunkEncoder:
    """One encoder for all tasks of a worker process, until another operator's tasks begin there."""
    return kept_by_worker(f"tokens of {path}", lambda: ChunkEncoder(path))


def token_blocks(docs: DataFrame, tokenizer: str, end_id: int = 1, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Blocks of the documents (doc_id, text) in ascending order of id over (part, block); see the module.

    ``tokenizer`` is the path of the file, the same on every machine.
    """

    def encode(batches):
        from pyspark import TaskContext

        part, block, encoder = TaskContext.get().partitionId(), 0, _encoder(tokenizer)
        names, lengths, ids, held = [], [], [], 0

        def flush():
            nonlocal block, names, lengths, ids, held
            n, i = np.concatenate(lengths), np.concatenate(ids)
            made = [part, block, len(n), len(i), block_bytes(np.concatenate(names), n, i)]
            block, names, lengths, ids, held = block + 1, [], [], [], 0
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(made, [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()], strict=True)],
                ["part", "block", "n_docs", "n_ids", "payload"],
            )

        for batch in batches:
            for some in slices(batch, "text", 3 << 20):
                i, n = encoder.texts(some.column(1), end_id)
                names.append(some.column(0).to_numpy())
                lengths.append(n)
                ids.append(i)
                held += len(i)
                if held >= block_ids:
                    yield flush()
        if held:
            yield flush()

    dealt = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
        .filter("doc_id is not null").withColumn("tie", F.xxhash64("text"))
        .repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    )
    return dealt.select("doc_id", "text").mapInArrow(encode, BLOCKS)


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1) -> None:
    token_blocks(docs, tokenizer, end_id).write.mode("overwrite").parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 of every document in the files.

    Starts are sums over totals of parts, then of blocks in a part, then of documents in a block; only
    the first goes through one task, with a row for each part.
    """
    blocks = spark.read.schema(BLOCKS).parquet(path)

    def decode(batches):
        for batch in batches:
            for part, block, payload in zip(batch.column(0), batch.column(1), batch.column(4), strict=True):
                b = Block(payload.as_py())
                ends = b.ends.all()
                begins = np.concatenate(([0], ends[:-1]))
                ids = b.ids.astype("<u4")
                crc = [zlib.crc32(ids[x:y]) for x, y in zip(begins, ends, strict=True)]
                n = len(ends)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, part.as_py(), np.int32)), pa.array(np.full(n, block.as_py(), np.int32)),
                        pa.array(b.names.all() + b.first), pa.array(begins), pa.array(ends - begins), pa.array(crc, pa.int64()),
                    ],
                    ["part", "block", "doc_id", "begin", "n_tokens", "ids_crc32"],
                )

    docs = blocks.mapInArrow(decode, "part int, block int, doc_id long, begin long, n_tokens long, ids_crc32 long")
    sizes = blocks.select("part", "block", "n_ids")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start")
    )
    inside = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("block_start", F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).join(parts, "part")
    starts = starts.select("part", "block", (F.col("part_start") + F.col("block_start")).alias("at"))
    return docs.join(starts, ["part", "block"]).select(
        "doc_id", (F.col("at") + F.col("begin")).alias("start"), "n_tokens", "ids_crc32"
    )
