"""BPE encoding by segment trees, and decoding.

A piece of text starts as a row of symbols.  A segment tree over its adjacent
pairs holds, per pair, (merge rank, position); the smaller entry goes up, so the
root is the leftmost pair of lowest rank.  Merging it changes one symbol, takes
one out of the linked row, and updates the three leaves next to them and their
paths to the root; the piece is done when the root holds no rank.  The trees of
all pieces of a batch that are not yet in the cache are worked on together, one
merge of each at a time, as rows of one array (pieces of like size together).

The tokenizer's file gives vocabulary, merges and the rules before and after
them.  Normalising and cutting into pieces follow that file's rules; where they
are the ones under ``WORD_RULES``, which never look across white space, words
are looked up on their own, and each different word of a task is worked out
once.  Other rules see the whole text.

Defined cases: null text is the empty text (no ids, decoded empty); strings of
added tokens become their ids, as the file says; repeated rows and ids are each
returned; an empty table gives no rows; other columns are kept, but those named
like a result are replaced.  A file whose model is not plain BPE (dropout,
unknown token, byte fallback, prefixes, whole words first) or whose added tokens
have matching options is refused with ValueError.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staylens.llm.common import load

CACHED_WORDS = 200_000      # words, and as many pieces, per task and cache generation
TEXT_BYTES = 4 << 20        # text cut into words together (one text is never split)
OUT_IDS = 1 << 18           # ids decoded together
FOREST = 1 << 20            # leaves worked on together
NONE = np.int64(1) << 62    # a leaf without a mergeable pair
SETTLED_SCRIPTS = "\u0590"  # letters below are the same in every Unicode version of the libraries
SIGMA = "\u03a3"            # the one letter whose lower case depends on its neighbours in Python

# ---------------------------------------------------------------------------
# fixed values: rules of a tokenizer file that never look across white space
# ---------------------------------------------------------------------------
WORD_RULES = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
         "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
}
# the same cut for words of printable ASCII in lower case
ASCII_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+"

# byte-level alphabet: printable bytes stand for themselves, the rest for 256 and up
SHOWN_BYTES = [*range(33, 127), *range(161, 173), *range(174, 256)]
HIDDEN_BYTES = [b for b in range(256) if b not in SHOWN_BYTES]


class Merges:
    """Pair ranks of a vocabulary: arrays only."""

    def __init__(self, model: dict):
        vocab = model["vocab"]
        pairs = [m.split(" ", 1) if isinstance(m, str) else m for m in model["merges"]]
        self.size = max(vocab.values()) + 1
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.ranks = np.append(order.astype(np.int64), 0)
        self.made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        suffix = model.get("end_of_word_suffix") or ""
        single = {ord(c): i for c, i in vocab.items() if len(c) == 1}
        self.first = np.full(max(single) + 2, -1, dtype=np.int64)   # code point -> symbol; the last entry: none
        self.last = self.first.copy()                               # ... at the end of a piece
        for c, i in single.items():
            self.first[c] = i
            self.last[c] = vocab.get(chr(c) + suffix, -1)

    def leaves(self, left: np.ndarray, right: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Entries (rank, position) of symbol pairs."""
        key = left * self.size + right
        k = np.searchsorted(self.keys, key)
        return np.where(self.keys[k] == key, (self.ranks[k] << 32) | at, NONE)

    def symbols(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all pieces in a row, and where each piece starts (and the
        end).  Characters the vocabulary lacks are left out, as no unknown
        token is set."""
        codes = np.frombuffer("".join(pieces).encode("utf-32-le"), "<u4")
        codes = np.minimum(codes, len(self.first) - 1)
        ends = np.cumsum(np.array([0, *map(len, pieces)]))
        out = self.first[codes]
        last = ends[1:][np.diff(ends) > 0] - 1
        out[last] = self.last[codes[last]]
        known = np.concatenate([[0], np.cumsum(out >= 0)])
        return out[out >= 0], known[ends]

    def encode(self, pieces: list[str]) -> list[bytes]:
        """Ids of each piece as little-endian 32-bit numbers."""
        flat, ends = self.symbols(pieces)
        sizes = np.diff(ends)
        out = np.full(len(pieces), b"", dtype=object)
        bits = np.maximum(1, np.ceil(np.log2(np.maximum(sizes, 1)))).astype(np.int64)
        for n in np.unique(bits[sizes > 0]).tolist():
            members = np.flatnonzero((bits == n) & (sizes > 0))
            step = max(1, FOREST >> n)
            for s in range(0, len(members), step):
                part = members[s:s + step]
                within = np.arange(1 << n) < sizes[part][:, None]
                sym = np.full(within.shape, -1, dtype=np.int64)
                sym[within] = flat[(ends[part][:, None] + np.arange(1 << n))[within]]
                out[part] = self._forest(sym, sizes[part])
        return out.tolist()

    def _forest(self, sym: np.ndarray, sizes: np.ndarray) -> list[bytes]:
        """Merges rows of ``sizes`` symbols until no pair is left."""
        n, width = sym.shape
        at = np.arange(width)
        nxt = np.where(at + 1 < sizes[:, None], at + 1, -1)
        prv = np.broadcast_to(at - 1, (n, width)).copy()
        tree = np.full((n, 2 * width), NONE)
        tree[:, width:-1] = np.where(nxt[:, :-1] >= 0, self.leaves(sym[:, :-1], sym[:, 1:], at[:-1]), NONE)
        level = width >> 1
        while level:
            tree[:, level:2 * level] = np.minimum(tree[:, 2 * level:4 * level:2], tree[:, 2 * level + 1:4 * level:2])
            level >>= 1
        gone = np.zeros((n, width), dtype=bool)
        live = np.arange(n)
        while True:
            root = tree[live, 1]
            more = root < NONE
            live, root = live[more], root[more]
            if not len(live):
                break
            i = root & 0xFFFFFFFF
            j = nxt[live, i]
            after, before = nxt[live, j], prv[live, i]
            made = self.made[root >> 32]
            sym[live, i] = made
            gone[live, j] = True
            nxt[live, i] = after
            has_next, has_prev = after >= 0, before >= 0
            prv[live[has_next], after[has_next]] = i[has_next]
            # a missing neighbour's write goes to the removed leaf j, which is empty anyway
            tree[live, width + i] = np.where(has_next, self.leaves(made, sym[live, after], i), NONE)
            prev = np.where(has_prev, before, j)
            tree[live, width + prev] = np.where(has_prev, self.leaves(sym[live, before], made, before), NONE)
            tree[live, width + j] = NONE
            paths = [width + i, width + j, width + prev]
            for _ in range(width.bit_length() - 1):
                paths = [p >> 1 for p in paths]
                for p in paths:
                    tree[live, p] = np.minimum(tree[live, 2 * p], tree[live, 2 * p + 1])
        keep = (at < sizes[:, None]) & ~gone
        flat = sym[keep].astype("<u4").tobytes()
        ends = (4 * np.cumsum(keep.sum(axis=1))).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]


class Cache:
    """key -> bytes in two generations: a full young one becomes the old one,
    and entries still in use move up again."""

    def __init__(self, room: int):
        self.room, self.young, self.old = room, {}, {}

    def turn(self) -> None:
        if len(self.young) >= self.room:
            self.young, self.old = {}, self.young

    def missing(self, keys) -> list:
        """The keys that no generation holds; the others are young afterwards."""
        young, out = self.young, []
        for k in keys:
            if k not in young:
                held = self.old.get(k)
                if held is None:
                    out.append(k)
                else:
                    young[k] = held
        return out


class Encoder:
    """Ids of whole texts by the rules of one tokenizer file."""

    def __init__(self, spec: str, cached: int = CACHED_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        rules = check(spec)
        self.merges = Merges(rules["model"])
        tokenizer = Tokenizer.from_str(spec)
        self.normalizer, self.pre_tokenizer = tokenizer.normalizer, tokenizer.pre_tokenizer
        self.by_word = all(rules.get(k) == v for k, v in WORD_RULES.items())
        self.added = {t["content"]: np.array([t["id"]], "<u4").tobytes() for t in rules.get("added_tokens") or []}
        longest = sorted(self.added, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if longest else None
        self.marks = sorted({a[:2] for a in self.added})
        self.ascii = re.compile(ASCII_PIECES).findall
        self.letters = {b: chr(256 + k) for k, b in enumerate(HIDDEN_BYTES)}
        self.words, self.pieces = Cache(cached), Cache(cached)

    def _split(self, text: str) -> list[str]:
        if self.normalizer is not None:
            text = self.normalizer.normalize_str(text)
        if self.pre_tokenizer is None:
            return [text] if text else []
        return [p for p, _ in self.pre_tokenizer.pre_tokenize_str(text)]

    def marked(self, text: str) -> bool:
        for m in self.marks:
            if m in text:
                return True
        return False

    def parts(self, text: str) -> list:
        """Pieces (str) and ids of added tokens (bytes), in order."""
        if not self.marked(text):
            return self._split(text)
        out = []
        for k, part in enumerate(self.cut.split(text)):
            if k % 2:
                out.append(self.added[part])
            elif part:
                out += self._split(part)
        return out

    def _word(self, word: bytes) -> list:
        text = word.decode("utf-8")
        if self.marked(text):
            return self.parts(text)
        if text.isascii():
            if text.isalpha():
                return [text.lower()]
            if text.isprintable():
                return self.ascii(text.lower())
        elif text.isalpha() and max(text) < SETTLED_SCRIPTS and SIGMA not in text:
            text = unicodedata.normalize("NFC", text).lower()
            if text.isalpha():    # letters alone are one piece
                return [text.encode("utf-8").decode("latin-1").translate(self.letters)]
        return self.parts(text)

    def _merge(self, lists: list[list]) -> list[bytes]:
        """Ids of lists of pieces; pieces not held yet are merged together."""
        self.pieces.turn()
        new = self.pieces.missing({p for ps in lists for p in ps if type(p) is str})
        if new:
            self.pieces.young.update(zip(new, self.merges.encode(new)))
        held = self.pieces.young
        return [held[ps[0]] if len(ps) == 1 and type(ps[0]) is str else
                b"".join([held[p] if type(p) is str else p for p in ps]) for ps in lists]

    def __call__(self, texts: list[bytes]) -> list[np.ndarray]:
        if not self.by_word:
            return [np.frombuffer(b, "<u4") for b in self._merge([self.parts(t.decode("utf-8")) for t in texts])]
        split = [t.split() for t in texts]      # the six ASCII white-space bytes
        self.words.turn()
        new = self.words.missing(set().union(*split))
        if new:
            self.words.young.update(zip(new, self._merge([self._word(w) for w in new])))
        held = self.words.young.__getitem__
        return [np.frombuffer(b"".join(map(held, ws)), "<u4") for ws in split]


class Decoder:
    """Texts of ids: tokens joined by a space where the file names no decoder,
    bytes put together again where it names the byte-level one."""

    def __init__(self, spec: str):
        rules = check(spec)
        table = {**{i: t for t, i in rules["model"]["vocab"].items()},
                 **{t["id"]: t["content"] for t in rules.get("added_tokens") or []}}
        self.tokens = np.array([table.get(i, "") for i in range(max(table) + 1)], dtype=object)
        self.spaced = not rules.get("decoder")
        self.bytes = {**{chr(b): b for b in SHOWN_BYTES}, **{chr(256 + k): b for k, b in enumerate(HIDDEN_BYTES)}}

    def __call__(self, ids: np.ndarray) -> str:
        tokens = self.tokens[ids].tolist()
        if self.spaced:
            return " ".join(tokens)
        out = bytearray()
        for t in tokens:
            try:
                out += bytes([self.bytes[c] for c in t])
            except KeyError:  # an added token outside the byte alphabet
                out += t.encode("utf-8")
        return out.decode("utf-8", "replace")


def check(spec: str) -> dict:
    """The rules of a tokenizer file; ValueError where this module lacks one."""
    rules = json.loads(spec)
    model = rules["model"]
    odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "fuse_unk", "byte_fallback", "ignore_merges") if model.get(k)]
    odd += [t["content"] for t in rules.get("added_tokens") or [] if any(t.get(k) for k in ("single_word", "lstrip", "rstrip", "normalized"))]
    if (rules.get("decoder") or {"type": "ByteLevel"})["type"] != "ByteLevel":
        odd.append("decoder")
    if model.get("type", "BPE") != "BPE" or odd:
        raise ValueError(f"tokenizer rules not covered: {model.get('type')} {odd}")
    return rules


def encode(docs: DataFrame, spec: str, text: str = "text") -> DataFrame:
    """The rows without ``text``, with ``ids`` (array of int)."""
    check(spec)
    given = docs.sparkSession.sparkContext.broadcast(spec)
    kept = [c for c in docs.columns if c not in (text, "ids")]
    source = docs.select(*kept, F.coalesce(F.col(text).cast("string"), F.lit("")).alias("ids"))
    schema = T.StructType([*source.schema.fields[:-1], T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches):
        encoder = Encoder(given.value)
        for b in batches:
            texts = b.column("ids").cast(pa.binary())
            for rows in slices(pc.binary_length(texts).to_numpy(zero_copy_only=False), TEXT_BYTES):
                lists = encoder([t.as_py() for t in texts.slice(rows.start, len(rows))])
                ends = np.cumsum([0, *map(len, lists)]).astype(np.int32)
                values = np.concatenate([np.zeros(0, "<u4"), *lists]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [b.column(c).slice(rows.start, len(rows)) for c in range(b.num_columns - 1)]
                    + [pa.ListArray.from_arrays(pa.array(ends), pa.array(values))], names=b.schema.names)

    return source.mapInArrow(run, schema)


def slices(sizes: np.ndarray, most: int):
    """Runs of rows whose sizes add up to about ``most``."""
    start, total = 0, 0
    for k, size in enumerate(sizes.tolist()):
        total += size
        if total >= most or k == len(sizes) - 1:
            yield range(start, k + 1)
            start, total = k + 1, 0


def decode(rows: DataFrame, spec: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """The rows with ``out``, the text of their ids (null: empty)."""
    check(spec)
    given = rows.sparkSession.sparkContext.broadcast(spec)
    source = rows.select(*[c for c in rows.columns if c != out],
                         F.coalesce(F.col(ids).cast("array<int>"), F.array().cast("array<int>")).alias(out))
    schema = T.StructType([*source.schema.fields[:-1], T.StructField(out, T.StringType())])

    def run(batches):
        decoder = Decoder(given.value)
        for b in batches:
            lists = b.column(b.num_columns - 1)
            ends = lists.offsets.to_numpy()
            values = lists.values.to_numpy(zero_copy_only=False)
            for rows in slices(np.diff(ends), OUT_IDS):
                texts = [decoder(values[ends[k]:ends[k + 1]]) for k in rows]
                yield pa.RecordBatch.from_arrays([c.slice(rows.start, len(rows)) for c in b.columns[:-1]]
                                                 + [pa.array(texts, pa.string())], names=b.schema.names)

    return source.mapInArrow(run, schema)


def op13_segment_bpe(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    if tokenizer is None:
        import public_tokenizers
        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    with open(tokenizer, encoding="utf-8") as f:
        spec = f.read()
    rows = decode(encode(load(spark, sf_dir, "documents").select("doc_id", "text"), spec), spec)
    ids = F.array_join("ids", " ")
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(ids.cast("binary"), 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
