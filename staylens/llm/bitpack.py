"""Fixed-width bit packing of token ids.

A file is a sequence of blocks, each followed by a sync marker::

    "BPK1"  u8 width  3 zero bytes  u32 documents  u64 ids
    i64 document ids   u8 id-is-null flags   u64 first id of each document, and the end
    the ids, ``width`` bits each, least significant bit first

and ends with a footer holding the block count, the byte offset and the first
id of every block, then the footer's own length, so a reader finds any id with
two seeks.  ``width`` is the number of bits the largest vocabulary id needs.

Documents are written in ascending order of their id (null first; equal ids by
a hash of the text), one file per range of ids.  The texts are dealt and sorted
first, so each is encoded once, in the task that packs it.

Defined cases: null text is the empty text (one end id); repeated rows are
encoded each; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import os
import string
import struct
import unicodedata
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.llm.common import cut, load, read_binary, shuffle_parts, write_binary
from staylens.session import scratch_path

END_ID = 1
SYNC = b"\xf5BPKsync\r\n\x00\x1a\xa9\xc3\x5e\x96"
BLOCK_IDS = 1 << 18
CACHED_WORDS = 300_000   # words, and as many pieces, per Python worker and cache generation
HEAD = "<4sB3xIQ"


def min_width(vocabulary: int) -> int:
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    if width in (8, 16, 32):
        return ids.astype(f"<u{width // 8}").tobytes()
    bits = (ids.astype(np.uint32)[:, None] >> np.arange(width, dtype=np.uint32)) & 1
    return np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(data, width: int, start: int, stop: int) -> np.ndarray:
    """Ids ``start`` to ``stop`` of a packed run; reads only their bytes."""
    if width in (8, 16, 32):
        size = width // 8
        return np.frombuffer(data, f"<u{size}", stop - start, start * size).astype(np.uint32)
    first = start * width
    raw = np.frombuffer(data, np.uint8, (stop * width + 7) // 8 - first // 8, first // 8)
    bits = np.unpackbits(raw, bitorder="little")[first % 8:first % 8 + (stop - start) * width]
    return bits.reshape(-1, width).astype(np.uint32) @ (np.uint32(1) << np.arange(width, dtype=np.uint32))


def make_block(doc_ids: list, arrays: list[np.ndarray], width: int) -> bytes:
    ids = np.concatenate(arrays) if arrays else np.zeros(0, np.uint32)
    starts = np.cumsum([0] + [len(a) for a in arrays])
    return b"".join([
        struct.pack(HEAD, b"BPK1", width, len(doc_ids), len(ids)),
        np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes(),
        np.array([d is None for d in doc_ids], np.uint8).tobytes(),
        starts.astype("<u8").tobytes(), pack(ids, width)])


def make_footer(offsets: list[int], starts: list[int]) -> bytes:
    body = struct.pack("<4sI", b"BPKF", len(offsets)) + np.array([offsets, starts], "<u8").tobytes()
    return body + struct.pack("<I", len(body))


class PackedFile:
    """Random access to one file's bytes."""

    def __init__(self, data):
        self.data = memoryview(data)
        end = len(self.data) - len(SYNC)
        size = struct.unpack_from("<I", self.data, end - 4)[0]
        magic, n = struct.unpack_from("<4sI", self.data, end - 4 - size)
        if magic != b"BPKF" or bytes(self.data[end:]) != SYNC:
            raise ValueError("not a packed id file, or cut off")
        table = np.frombuffer(self.data, "<u8", 2 * n, end - 4 - size + 8).reshape(2, n)
        self.offsets, self.starts = table[0].astype(np.int64), table[1].astype(np.int64)

    def block(self, k: int):
        """Document ids (None for null), first ids, width and packed ids of block k."""
        at = int(self.offsets[k])
        magic, width, docs, n = struct.unpack_from(HEAD, self.data, at)
        if magic != b"BPK1":
            raise ValueError("block marker missing")
        at += struct.calcsize(HEAD)
        ids = np.frombuffer(self.data, "<i8", docs, at)
        null = np.frombuffer(self.data, np.uint8, docs, at + 8 * docs)
        starts = np.frombuffer(self.data, "<u8", docs + 1, at + 9 * docs).astype(np.int64)
        packed = self.data[at + 9 * docs + 8 * (docs + 1):]
        return [None if z else int(i) for i, z in zip(ids, null)], starts, width, packed

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of the file; only the blocks they lie in are read."""
        out = []
        k = max(0, int(np.searchsorted(self.starts, start, "right")) - 1)
        while k < len(self.starts) and self.starts[k] < stop:
            _, starts, width, packed = self.block(k)
            a, b = max(0, start - self.starts[k]), min(int(starts[-1]), stop - self.starts[k])
            if a < b:
                out.append(unpack(packed, width, int(a), int(b)))
            k += 1
        return np.concatenate(out) if out else np.zeros(0, np.uint32)


class _Memo(dict):
    """word -> ids as bytes; a miss asks the older generation, then ``make``."""

    def __init__(self, make, old: dict):
        super().__init__()
        self.make, self.old = make, old

    def __missing__(self, key):
        out = dict.get(self.old, key)
        if out is None:
            out = self.make(key)
        self[key] = out
        return out


class WordEncoder:
    """Token ids of a text, word by word, for BPE tokenizers that drop white
    space, normalise by NFC and lower case and pre-split by ``PIECES``.  Such a
    tokenizer never merges across white space or pieces, so the ids of a text
    are those of its pieces in order, and frequent words and pieces are encoded
    once.  Words that hold special-token strings, or letters whose lower case
    depends on the context, go through the whole tokenizer.

    Both caches have two generations: when the young one is full it becomes the
    old one, and words still in use move up again."""

    PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+"
    WHOLE = ("<|", "\u03a3", "\u0130")

    def __init__(self, spec: str, cached: int = CACHED_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(spec)
        self.model = self.tokenizer.model
        self.pieces = regex.compile(self.PIECES).findall
        self.cached = cached
        self.words = _Memo(self._word, {})
        self.parts: dict[str, bytes] = {}
        self.old_parts: dict[str, bytes] = {}
        # byte-level alphabet: printable bytes stand for themselves, the rest for 256 and up
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [x for x in range(256) if x not in shown]
        self.letters = {x: chr(256 + i) for i, x in enumerate(rest)}

    @classmethod
    def shared(cls, spec: str) -> WordEncoder:
        """The encoder of this Python worker for ``spec``: Spark runs many
        tasks in one worker, and its caches serve them all.  It is kept beside
        the tokenizer library, as code sent with a task is new in every task."""
        import tokenizers
        held = tokenizers.__dict__.setdefault("_word_encoders", {})
        key = (zlib.crc32(spec.encode("utf-8")), len(spec))
        if key not in held:
            held[key] = cls(spec)
        return held[key]

    def _part(self, piece: str) -> bytes:
        out = self.parts.get(piece)
        if out is None:
            out = self.old_parts.get(piece)
            if out is None:
                text = piece if piece.isascii() else piece.encode("utf-8").decode("latin-1").translate(self.letters)
                out = array("I", [t.id for t in self.model.tokenize(text)]).tobytes()
            if len(self.parts) >= self.cached:
                self.parts, self.old_parts = {}, self.parts
            self.parts[piece] = out
        return out

    def _word(self, word: bytes) -> bytes:
        text = word.decode("utf-8")
        if not text.isprintable() or any([x in text for x in self.WHOLE]):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
        text = text.lower()
        if text.isalpha():  # letters alone, or with punctuation after them: no search for pieces
            return self._part(text)
        head = text.rstrip(string.punctuation)
        if head.isalpha():
            return self._part(head) + self._part(text[len(head):])
        return b"".join(map(self._part, self.pieces(text)))

    def __call__(self, text: str | None) -> np.ndarray:
        return self.lowered((text or "").encode("utf-8").split())  # the six ASCII white-space bytes

    def lowered(self, ws: list[bytes]) -> np.ndarray:
        """Ids of a list of words."""
        if len(self.words) >= self.cached:
            self.words.old = {}
            self.words = _Memo(self._word, self.words)
        return np.frombuffer(b"".join(map(self.words.__getitem__, ws)), "<u4")


def write_packed(docs: DataFrame, path: str, spec: str, vocabulary: int, end_id: int = END_ID,
                 block_ids: int = BLOCK_IDS) -> None:
    """Encodes every whole text of ``docs`` (doc_id, text) and writes the files."""
    width = min_width(vocabulary)
    spec_b = docs.sparkSession.sparkContext.broadcast(spec)
    order = ["doc_id", "tie"]
    ranges = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
              .withColumn("tie", F.xxhash64("text"))
              .repartitionByRange(shuffle_parts(docs.sparkSession), *order).sortWithinPartitions(*order))

    def run(batches):
        encoder = WordEncoder.shared(spec_b.value)
        end = np.array([end_id], "<u4")
        offsets, starts, at, first, size = [], [], 0, 0, 0
        doc_ids, arrays = [], []

        def flush():
            nonlocal at, first, size, doc_ids, arrays
            block = make_block(doc_ids, arrays, width)
            offsets.append(at)
            starts.append(first)
            at += len(block) + len(SYNC)
            first += size
            doc_ids, arrays, size = [], [], 0
            return pa.RecordBatch.from_arrays([pa.array([block], pa.binary())], names=["block"])

        for b in batches:
            for d, t in zip(b.column("doc_id").to_pylist(), b.column("text")):
                ids = np.concatenate([encoder(t.as_py()), end])
                doc_ids.append(d)
                arrays.append(ids)
                size += len(ids)
                if size >= block_ids:
                    yield flush()
        if doc_ids:
            yield flush()
        if offsets:
            yield pa.RecordBatch.from_arrays([pa.array([make_footer(offsets, starts)], pa.binary())], names=["block"])

    write_binary(ranges.select("doc_id", "text").mapInArrow(run, "block binary"), path, "block", SYNC)


def read_packed(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: doc_id, file, part (file number), in_file
    (first id within the file), n_tokens, ids_crc32."""

    def run(batches):
        for b in batches:
            for name, data in zip(b.column("file").to_pylist(), b.column("content")):
                f = PackedFile(data.as_buffer())
                part = int(name.split("-")[1])
                for k in range(len(f.offsets)):
                    docs, starts, width, packed = f.block(k)
                    ids = unpack(packed, width, 0, int(starts[-1])).astype("<u4")
                    crc = [zlib.crc32(ids[x:y].tobytes()) for x, y in zip(starts, starts[1:])]
                    n = len(docs)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(docs, pa.int64()), pa.array([name] * n), pa.array([part] * n, pa.int32()),
                         pa.array(starts[:-1] + f.starts[k]), pa.array(np.diff(starts)), pa.array(crc, pa.int64())],
                        names=["doc_id", "file", "part", "in_file", "n_tokens", "ids_crc32"])

    return read_binary(spark, path).mapInArrow(
        run, "doc_id long, file string, part int, in_file long, n_tokens long, ids_crc32 long")


def with_starts(rows: DataFrame) -> DataFrame:
    """Adds ``start``: ids of all documents before, over all files (one sum
    per file reaches the driver)."""
    rows = cut(rows, "packed-rows")
    sums = {r[0]: r[1] for r in rows.groupBy("part").agg(F.sum("n_tokens")).collect()}
    before, total = [], 0
    for p in sorted(sums):
        before.append((p, total))
        total += sums[p]
    offsets = rows.sparkSession.createDataFrame(before, "part int, _before long")
    return rows.join(offsets, "part").withColumn("start", F.col("_before") + F.col("in_file")).drop("_before")


def op10_bitpack(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    if tokenizer is None:
        import public_tokenizers
        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    from tokenizers import Tokenizer
    with open(tokenizer, encoding="utf-8") as f:
        spec = f.read()
    path = scratch_path(spark, "packed-ids")
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    write_packed(docs, path, spec, Tokenizer.from_str(spec).get_vocab_size(with_added_tokens=True))
    return with_starts(read_packed(spark, path)).select("doc_id", "start", "n_tokens", "ids_crc32", "file")
