"""Byte-pair encoding and decoding with a pair occurrence index.

A vocabulary file of the tokenizers format (BPE with an end-of-word suffix, byte-level alphabet) is
read by the driver, from a path that is a parameter, and its text is sent to the workers.  New word pieces of a batch are laid out in one linked sequence, an
index maps every adjacent pair to all its positions, and the active pairs are applied in ascending
rank: each merge relinks its neighbours and updates the lists of the pairs that it breaks and makes.
Results per whitespace-free chunk are remembered in the worker, in a bounded store.

Cases: a null text is encoded as empty (no ids, empty decoded text); texts of any length are used
whole; special tokens inside a text become their ids, as in the tokenizers library; repeated rows
give repeated results; other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import small_batches, table, text_chunks, tidy

BITS = 20  # of an id in a pair
LONGEST_VOCABULARY = 64 << 20
STORE_CHUNKS = 500_000  # chunks that a worker remembers before it starts afresh
# White_Space of Unicode, which \s means in the tokenizers library; str.split() also takes \x1c-\x1f.
SPACE = regex.compile("[\t-\r \x85\xa0  -     　]+")
ODD = regex.compile("[\x1c-\x1f]")


def byte_letters() -> list[str]:
    """The printable stand-in of each byte: itself where it is printable, else the next code point from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


class Codec:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str | None = None, text: str | None = None):
        spec = json.loads(vocabulary(path) if text is None else text)
        model = spec["model"]
        if model["type"] != "BPE" or model["byte_fallback"] or model["continuing_subword_prefix"] or model["ignore_merges"]:
            raise ValueError(f"{path or 'the file'}: not a plain BPE vocabulary")
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"] if not t["normalized"]}
        self.tokens = {i: t for t, i in [*self.vocab.items(), *self.special.items()]}
        self.marks = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        pieces = spec["pre_tokenizer"]["pretokenizers"][0]
        self.pieces = regex.compile(pieces["pattern"]["Regex"])
        letters = byte_letters()
        # Ids of each byte inside and at the end of a word; a byte that the vocabulary lacks vanishes.
        self.inside = [self.vocab.get(c, -1) for c in letters]
        self.last = [self.vocab.get(c + self.suffix, -1) for c in letters]
        self.gaps = -1 in self.inside or -1 in self.last
        # pair a << 20 | b -> (rank, merged id)
        self.merges: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[self.vocab[a] << BITS | self.vocab[b]] = (rank, self.vocab[a + b])
        self.store: dict[str, bytes] = {}  # ids as little-endian unsigned 32-bit integers
        # Each token's text and a space, end to end, by id.
        spelled = [(self.tokens[i] + " ").encode() if i in self.tokens else b"" for i in range(max(self.tokens) + 1)]
        self.letters = np.frombuffer(b"".join(spelled), np.uint8)
        self.ends = np.cumsum([0, *map(len, spelled)])

    def normalise(self, text: str) -> str:
        if not text.isascii():
            if not unicodedata.is_normalized("NFC", text):
                text = unicodedata.normalize("NFC", text)
            text = text.replace("Σ", "σ")  # one letter at a time: no final sigma
        return text.lower()

    def chunks(self, text: str) -> list[str]:
        """Whitespace-free chunks of the normalised text; a special token is a chunk of its own."""
        out: list[str] = []
        at = 0
        for m in self.marks.finditer(text) if self.marks and "<" in text else ():
            out += self.plain(text[at : m.start()])
            out.append(m[0])
            at = m.end()
        return out + self.plain(text[at:] if at else text)

    def plain(self, text: str) -> list[str]:
        text = self.normalise(text)
        if ODD.search(text):
            return [c for c in SPACE.split(text) if c]
        return text.split()

    def symbols(self, piece: str) -> list[int]:
        raw = piece.encode("utf-8", "replace")
        ids = [self.inside[b] for b in raw[:-1]]
        ids.append(self.last[raw[-1]])
        return [i for i in ids if i >= 0] if self.gaps else ids

    def merge(self, words: list[list[int]]) -> list[list[int]]:
        """Apply all merges to the words, through one index of pair occurrences.

        A pair that becomes active with a rank below the one being applied goes first, and the rest of
        the list waits: each word then sees its merges in the order that it would alone.
        """
        sym: list[int] = []
        after: list[int] = []
        before: list[int] = []
        starts = []
        merges = self.merges
        index: dict[int, list[int]] = {}
        for w in words:
            n = len(sym)
            starts.append(n)
            sym += w
            after += range(n + 1, n + len(w) + 1)
            after[-1 if w else len(after) :] = [-1] if w else []
            before += range(n - 1, n + len(w) - 1)
            if w:
                before[n] = -1
            for i in range(len(w) - 1):
                pair = w[i] << BITS | w[i + 1]
                if pair in merges:
                    if pair in index:
                        index[pair].append(n + i)
                    else:
                        index[pair] = [n + i]
        active = [(merges[p][0], p) for p in index]
        heapq.heapify(active)
        while active:
            rank, pair = heapq.heappop(active)
            where = index.pop(pair, None)
            if not where:
                continue
            where.sort()
            a, b, made = pair >> BITS, pair & ((1 << BITS) - 1), merges[pair][1]
            for k, i in enumerate(where):
                j = after[i]
                if j < 0 or sym[i] != a or sym[j] != b:  # broken by an earlier merge
                    continue
                sym[i], sym[j] = made, -1
                far, left = after[j], before[i]
                after[i] = far
                sooner = False
                if far >= 0:
                    before[far] = i
                    new = made << BITS | sym[far]
                    if new in merges:
                        if new in index:
                            index[new].append(i)
                        else:
                            index[new] = [i]
                            heapq.heappush(active, (merges[new][0], new))
                        sooner = merges[new][0] < rank
                if left >= 0:
                    new = sym[left] << BITS | made
                    if new in merges:
                        if new in index:
                            index[new].append(left)
                        else:
                            index[new] = [left]
                            heapq.heappush(active, (merges[new][0], new))
                        sooner = sooner or merges[new][0] < rank
                if sooner and k + 1 < len(where):
                    index[pair] = index.get(pair, []) + where[k + 1 :]
                    heapq.heappush(active, (rank, pair))
                    break
        out = []
        for n, w in zip(starts, words, strict=True):
            # Merged-away symbols are -1, and no other symbol is.
            out.append([x for x in sym[n : n + len(w)] if x >= 0])
        return out

    def learn_chunks(self, chunks: Iterable[str]) -> None:
        """Encode the chunks not yet in the store; their pieces are stored too."""
        store = self.store
        new = [c for c in dict.fromkeys(chunks) if c not in store]
        if not new:
            return
        pieces = [[] if c in self.special else self.pieces.findall(c) for c in new]
        distinct = [p for p in dict.fromkeys(p for ps in pieces for p in ps) if p not in store]
        for p, ids in zip(distinct, self.merge([self.symbols(p) for p in distinct]), strict=True):
            store[p] = array("I", ids).tobytes()
        for c, ps in zip(new, pieces, strict=True):
            if c in self.special:
                store[c] = array("I", [self.special[c]]).tobytes()
            elif len(ps) != 1 or ps[0] != c:
                store[c] = b"".join([store[p] for p in ps])

    def decode(self, ids: Iterable[int]) -> str:
        """The tokens joined by spaces: the vocabulary files of this kind name no decoder.  Unknown ids are skipped."""
        tokens = self.tokens
        return " ".join([tokens[i] for i in ids if i in tokens])

    def encode_batch(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """For each text its ids as little-endian unsigned 32-bit integers, and the decoded text in UTF-8."""
        if len(self.store) > STORE_CHUNKS:
            self.store.clear()
        split = [self.chunks(t) for t in texts]
        self.learn_chunks(c for s in split for c in s)
        get = self.store.__getitem__
        ids = [b"".join(map(get, s)) for s in split]
        return list(zip(ids, map(self.decoded, ids), strict=True))

    def decoded(self, raw: bytes) -> bytes:
        """What decode() gives for packed known ids, in UTF-8; a gather of bounded size."""
        parts = []
        for lo in range(0, len(raw), 1 << 18):
            own = np.frombuffer(raw, np.uint32, min(1 << 16, (len(raw) - lo) // 4), lo)
            first, size = self.ends[own], self.ends[own + 1] - self.ends[own]
            end = np.cumsum(size)
            parts.append(self.letters[np.repeat(first - end + size, size) + np.arange(end[-1])].tobytes())
        return b"".join(parts)[:-1]

    def encode(self, text: str) -> list[int]:
        raw = self.encode_batch([text])[0][0]
        return [int.from_bytes(raw[i : i + 4], "little") for i in range(0, len(raw), 4)]


@lru_cache(maxsize=2)
def codec(text: str) -> Codec:
    """The codec of a vocabulary file's text, which a worker keeps."""
    return Codec(text=text)


def vocabulary(path: str) -> str:
    """The text of a vocabulary file, which is broadcast and so may not be longer than LONGEST_VOCABULARY."""
    with open(path, encoding="utf-8") as f:
        text = f.read(LONGEST_VOCABULARY + 1)
    if len(text) > LONGEST_VOCABULARY:
        raise ValueError(f"{path}: longer than {LONGEST_VOCABULARY} characters")
    return text


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encode(docs: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",), text: str = "text", back: bool = False) -> DataFrame:
    """The columns keep, with ids (array of int) of the whole text, and if back with the digest of the decoded ids."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary(path))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in text_chunks(batch.column(0), 1 << 21, 1024):
                got = codec(shared.value).encode_batch([(t or b"").decode("utf-8", "replace") for t in texts])
                ids = [pa.array(memoryview(g[0]).cast("I").tolist() if g[0] else [], pa.int32()) for g in got]
                column = pa.ListArray.from_arrays(
                    pa.array([0, *_running(len(i) for i in ids)], pa.int32()), pa.concat_arrays(ids) if ids else pa.array([], pa.int32())
                )
                more = [pa.array([hashlib.sha256(g[1]).hexdigest() for g in got], pa.string())] if back else []
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(start, len(texts)) for c in batch.columns[1:]), column, *more],
                    names=[*batch.schema.names[1:], "ids", *(["decoded_sha256"] if back else [])],
                )

    rows = docs.select(F.col(text).cast("string").alias("__text"), *keep)
    schema = rows.drop("__text").schema.add("ids", T.ArrayType(T.IntegerType()))
    return rows.mapInArrow(tidy(each), schema.add("decoded_sha256", "string") if back else schema)


def decode(encoded: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",), ids: str = "ids") -> DataFrame:
    """The columns keep, with text_decoded from an array of ids; null ids decode to the empty text."""
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary(path))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [codec(shared.value).decode(x for x in (i.as_py() or []) if x is not None) for i in batch.column(0)]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(out, pa.string())], names=[*batch.schema.names[1:], "text_decoded"])

    rows = encoded.select(F.col(ids).cast("array<int>").alias("__ids"), *keep)
    return rows.mapInArrow(tidy(each), rows.drop("__ids").schema.add("text_decoded", "string"))


def _running(lengths: Iterable[int]) -> Iterator[int]:
    total = 0
    for n in lengths:
        total += n
        yield total


def digests(docs: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """The columns keep, with n_tokens and the digests of ids and decoded text, without moving either out of the worker."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary(path))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, ids, back = [], [], []
            for _, texts in text_chunks(batch.column(0), 1 << 21, 1024):
                for raw, decoded in codec(shared.value).encode_batch([(t or b"").decode("utf-8", "replace") for t in texts]):
                    n.append(len(raw) // 4)
                    ids.append(hashlib.sha256(raw).hexdigest())
                    back.append(hashlib.sha256(decoded).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(back, pa.string())],
                names=[*batch.schema.names[1:], "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = docs.select(F.col(text).cast("string").alias("__text"), *keep)
    schema = rows.drop("__text").schema.add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string")
    return rows.mapInArrow(tidy(each), schema)


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document."""
    return digests(table(spark, sf_dir, "documents"), vocabulary_path())


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The last stage: each document with its token ids and the digest of the text that they decode to."""
    del sf_dir
    small_batches(spark)
    return encode(docs, vocabulary_path(), keep=("doc_id", "lang", "source"), back=True)
