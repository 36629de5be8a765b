"""Language-model scores by cross-entropy difference.

Two bigram models of words are counted from the corpus: a target model from chosen documents and a background model from
the whole corpus.  They share one vocabulary, every distinct word of either, so no word is unknown and the models grow
with the corpus.  Words are runs of ASCII letters (without case), digits and non-ASCII bytes; any other character that
is no white space is a word of its own; each text ends with one more.  In a model with n words, of which c(w) are w,
  p(w) = (c(w) + 1) / (n + vocabulary),  p(w | u) = (c(u, w) + PRIOR * p(w)) / (c(u) + PRIOR)
and a document's score is the mean over its words and its end of target loss - background loss, in nats: lower is closer to the target.

The models are tables of counts by the 64-bit hash of a word or pair, never held whole anywhere.  Texts are taken in groups
of GROUP_ROWS neighbours.  Each group sends its distinct hashes with their counts to the shard that a hash's top bits
name, packed as one row for each group and shard; a shard adds up the counts of all groups and answers each group with the
totals for its hashes, in order.  A group's texts then meet its answers and are scored.  Shards grow in number with the corpus,
and what moves is a number of hashes at most that of words and pairs.

Cases: null and empty texts, and those of white space, have no words, are not counted and score 0.0; texts of any length are
scored whole; a document is counted once in each row it has; without any target word the scores are 0.0; null ids are no
target; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import HashFilter, cut, table, text_chunks, tidy, word_hashes

PRIOR = 4.0  # words that a single word's probability weighs beside its context's own
GROUP_ROWS = 2048  # texts that a task holds at once
SHARD_BYTES = 1 << 23  # of text for each shard
FILTER_LOG = 24  # bits, as a power of 2, of the filter of target ids: 2 MB
SEGMENT = 1 << 21  # bytes that are hashed at once

_SPACE, _WORD, _OTHER = 0, 1, 2
_KIND = np.full(256, _OTHER, np.uint8)
_KIND[list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")] = _WORD
_KIND[0x80:] = _WORD
_KIND[list(b" \t\n\v\f\r")] = _SPACE
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_PAIR, _LOW = np.uint64(0x100), np.uint64(0x1FF)  # the bit that tells pairs from words, and what a key has below its 55 bits
_EDGE = np.uint64(0x2545F4914F6CDD1D)  # the end of a text, and what stands before its first word


def words(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of the words of all texts, and how many words each has."""
    hashes, count = [np.empty(0, np.uint64)], np.zeros(len(texts), np.int64)
    for start, part in _segments(texts):
        raw = b"\n".join(part) + b"\n"
        x = np.frombuffer(raw, np.uint8)
        kind = _KIND[x]
        word = kind == _WORD
        opens = word & ~np.concatenate([[False], word[:-1]])
        lo = np.flatnonzero(opens | (kind == _OTHER))
        hi = lo + 1
        hi[word[lo]] = np.flatnonzero(word & ~np.concatenate([word[1:], [False]])) + 1
        hashes.append(word_hashes(_LOWER[x], lo, hi))
        ends = np.cumsum([len(t) + 1 for t in part])
        count[start : start + len(part)] += np.diff(np.searchsorted(lo, np.concatenate([[0], ends])))
    return np.concatenate(hashes), count


def _segments(texts: list[bytes | None]) -> Iterator[tuple[int, list[bytes]]]:
    """(first text, texts) of about SEGMENT bytes each; a longer text comes in pieces that end in white space."""
    held: list[bytes] = []
    start = size = 0
    for i, t in enumerate(texts):
        t = t or b""
        if held and size + len(t) > SEGMENT:
            yield start, held
            held, start, size = [], i, 0
        at = 0
        while len(t) - at > SEGMENT:
            spaces = np.flatnonzero(_KIND[np.frombuffer(t, np.uint8, min(SEGMENT, len(t) - at - SEGMENT), at + SEGMENT)] == _SPACE)
            if not len(spaces):
                break
            yield i, [t[at : (at := at + SEGMENT + int(spaces[0]))]]
        held.append(t[at:])
        size += len(t) - at
    if held:
        yield start, held


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h * np.uint64(0x9FB21C651E98DF25)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def keys(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The key of each word, that of the pair of it with the word before, text after text, and how
    many words each text has; a text with words has its end as one more."""
    h, n = words(texts)
    seen = n > 0
    line = np.full(len(h) + int(seen.sum()), _EDGE)
    line[np.arange(len(h)) + np.repeat(np.cumsum(seen) - 1, n)] = h
    before = np.roll(line, 1)  # the first word of a text comes after an end
    return _mixed(line) & ~_LOW, _mixed(before * np.uint64(0xD1342543DE82EF95) + line) & ~_LOW | _PAIR, n


def packed(values: np.ndarray) -> bytes:
    """Unsigned numbers as compressed bytes, all first bytes before all second ones."""
    raw = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()
    return len(values).to_bytes(4, "little") + pa.compress(raw, "zstd", asbytes=True)


def unpacked(blob: bytes, kind: type) -> np.ndarray:
    n, size = int.from_bytes(blob[:4], "little"), np.dtype(kind).itemsize
    raw = pa.decompress(blob[4:], n * size, "zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, n).T).view(kind).ravel()


def numbered(docs: DataFrame, keep: tuple[str, ...], text: str) -> DataFrame:
    """(row, text, group): row holds the columns keep, and group is the same long for GROUP_ROWS neighbours of a file.  What
    is no scan of files is written first."""

    def of(scan: DataFrame) -> DataFrame:
        where = scan.metadataColumn("_metadata")
        group = F.xxhash64(where["file_path"], F.floor(where["row_index"] / GROUP_ROWS)).alias("group")
        return scan.select(F.struct(*keep).alias("row"), F.col(text).cast("string").alias("text"), group)

    try:
        return of(docs)
    except AnalysisException:
        return of(cut(docs.select(*dict.fromkeys((*keep, text))), "texts"))


def contributions(rows: DataFrame, log: int, target: int, background: int, asks: bool) -> DataFrame:
    """(shard, group, keys, target, background) of rows (text, group): the distinct keys of each group by shard, the top log bits of
    a key; the counts are multiplied by the factors.  group is null where no answer is wanted."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes | None] = []
        own: int | None = None

        def flush() -> pa.RecordBatch:
            found, n = np.unique(np.concatenate(keys(held)[:2]), return_counts=True)
            shard = (found >> np.uint64(64 - log) if log else np.zeros_like(found)).astype(np.int32)
            edges = np.concatenate([np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]])) if len(found) else [], [len(found)]]).astype(int)
            parts = list(zip(edges[:-1], edges[1:], strict=True))
            steps = [np.diff(found[a:b], prepend=np.uint64(0)) for a, b in parts]
            columns = [
                pa.array(shard[edges[:-1]]),
                pa.array([own if asks else None] * len(parts), pa.int64()),
                pa.array([packed(s) for s in steps], pa.binary()),
                *(pa.array([packed((n[a:b] * k).astype(np.uint32)) for a, b in parts], pa.binary()) for k in (target, background)),
            ]
            return pa.RecordBatch.from_arrays(columns, names=["shard", "group", "keys", "target", "background"])

        for batch in batches:
            groups = batch.column(1).to_pylist()
            for text, group in zip(batch.column(0).cast(pa.large_binary()), groups, strict=True):
                if held and (group != own or len(held) >= GROUP_ROWS):
                    yield flush()
                    held = []
                own = group
                held.append(text.as_py())
        if held:
            yield flush()

    return rows.select("text", "group").mapInArrow(tidy(each), "shard int, group long, keys binary, target binary, background binary")


def merged(parts: pa.Table) -> pa.Table:
    """The answers of one shard: (group, shard, target, background), packed totals for the group's keys in order; and one row
    without group, with the shard's words (kinds) and their numbers in both models."""
    found = [np.cumsum(unpacked(k.as_py(), np.uint64), dtype=np.uint64) for k in parts["keys"]]
    ends = np.cumsum([0, *map(len, found)])
    all_keys, place = np.unique(np.concatenate(found), return_inverse=True)
    totals = []
    for side in ("target", "background"):
        n = np.concatenate([unpacked(c.as_py(), np.uint32) for c in parts[side]])
        totals.append(np.bincount(place, n, len(all_keys)).astype(np.int64))
    single = (all_keys & _PAIR == 0) & (totals[0] + totals[1] > 0)
    asked: dict[int, list[np.ndarray]] = {}
    for group, lo, hi in zip(parts["group"].to_pylist(), ends[:-1], ends[1:], strict=True):
        if group is not None:
            asked.setdefault(group, []).append(place[lo:hi])
    at = [x[0] if len(x) == 1 else np.unique(np.concatenate(x)) for x in asked.values()]
    n, none = len(asked), [None] * len(asked)
    columns = [
        pa.array([*asked, None], pa.int64()),
        pa.array([parts["shard"][0].as_py()] * (n + 1), pa.int32()),
        *(pa.array([*(packed(t[x].astype(np.uint64)) for x in at), None], pa.binary()) for t in totals),
        pa.array([*none, int(single.sum())], pa.int64()),
        *(pa.array([*none, int(t[single].sum())], pa.int64()) for t in totals),
    ]
    return pa.Table.from_arrays(columns, names=["group", "shard", "target", "background", "kinds", "n_target", "n_background"])


def scores(docs: DataFrame, target: DataFrame, background: DataFrame | None = None, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """The columns keep of docs, with n_tokens and ce_difference; without background, docs are the background."""
    source = F.col(text).cast("string").alias("text")
    rows = numbered(docs, keep, text)
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    log = max(0, int(np.ceil(np.log2(max(1.0, size / SHARD_BYTES)))))
    parts = contributions(rows, log, 0, 0 if background is not None else 1, True)
    parts = parts.unionByName(contributions(target.select(source, F.lit(0).cast("long").alias("group")), log, 1, 0, False))
    if background is not None:
        parts = parts.unionByName(contributions(background.select(source, F.lit(0).cast("long").alias("group")), log, 0, 1, False))
    schema = "group long, shard int, target binary, background binary, kinds long, n_target long, n_background long"
    answers = cut(parts.groupBy("shard").applyInArrow(merged, schema), "model")
    kinds, *n = (x or 0 for x in answers.where("group is null").agg(F.sum("kinds"), F.sum("n_target"), F.sum("n_background")).first())
    out = rows.select("row").schema.add("n_tokens", "long").add("ce_difference", "double")

    def score(texts: pa.Table, totals: pa.Table) -> pa.Table:
        totals = totals.sort_by("shard")
        single, pair, count = keys(texts["text"].cast(pa.large_binary()).to_pylist())
        mean = np.zeros(len(count))
        if len(single) and all(n):
            found, place = np.unique(np.concatenate([single, pair]), return_inverse=True)
            loss = np.zeros(len(single))
            for side, total, sign in (("target", n[0], -1.0), ("background", n[1], 1.0)):
                c = np.concatenate([unpacked(x.as_py(), np.uint64) for x in totals[side]]).astype(np.float64)
                if len(c) != len(found):
                    raise ValueError(f"{len(found)} keys of a group have {len(c)} answers")
                own, both = c[place[: len(single)]], c[place[len(single) :]]
                alone = (own + 1.0) / (total + kinds)
                loss += sign * np.log((both + PRIOR * alone) / (np.roll(own, 1) + PRIOR))
            sums = np.concatenate([[0.0], np.cumsum(loss)])
            ends = np.cumsum(count + (count > 0))
            mean = (sums[ends] - sums[ends - count - (count > 0)]) / (count + 1)
        columns = [texts["row"], pa.array(count), pa.array(mean)]
        return pa.Table.from_arrays(columns, names=["row", "n_tokens", "ce_difference"])

    met = rows.groupBy("group").cogroup(answers.where("group is not null").select("group", "shard", "target", "background").groupBy("group"))
    return met.applyInArrow(score, out).select("row.*", "n_tokens", "ce_difference")


def chosen(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of docs whose doc_id is in ids.  A filter of fixed size takes out most other rows before the join, so
    that their texts do not move; of a great many ids it is full, and the join does all the work."""
    ids = ids.select("doc_id").where("doc_id is not null").distinct()
    hashed = F.xxhash64(F.col("doc_id").cast("string"))
    shared = docs.sparkSession.sparkContext.broadcast(HashFilter.of(ids.select(hashed.alias("hash")), FILTER_LOG))

    @F.pandas_udf("boolean")
    def known(h: pd.Series) -> pd.Series:
        return pd.Series(shared.value.bitmap()(h.to_numpy(np.int64).view(np.uint64)))

    return docs.where(known(hashed)).join(ids, "doc_id", "left_semi")


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cross-entropy difference of every document; the target is the documents labelled quality 1, the background all documents."""
    docs = table(spark, sf_dir, "documents")
    target = chosen(docs.select("doc_id", "text"), table(spark, sf_dir, "labels").where("quality = 1"))
    return scores(docs, target).withColumn("ce_difference", F.round("ce_difference", 6))


def op10_sql() -> str:
    """The scores in DuckDB SQL."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    letters = r"a-z0-9\x{80}-\x{10FFFF}"
    found = f"regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[{letters}]+|[^{letters}\\x20\\x09-\\x0D]')"
    p = lambda both, own, before, n: f"(({both} + {PRIOR} * ({own} + 1.0) / ({n} + kinds)) / ({before} + {PRIOR}))"
    return f"""
WITH docs AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL), false) AS good, {found} AS ws
  FROM documents
),
pairs AS (SELECT r, good, unnest(list_concat([''], ws)) AS u, unnest(list_concat(ws, [''])) AS w FROM docs WHERE len(ws) > 0),
ones AS (SELECT w, count(*) AS b, count(*) FILTER (WHERE good) AS t FROM pairs GROUP BY w),
twos AS (SELECT u, w, count(*) AS b, count(*) FILTER (WHERE good) AS t FROM pairs GROUP BY u, w),
totals AS (SELECT count(*) AS kinds, sum(b) AS n_b, sum(t) AS n_t FROM ones),
scored AS (
  SELECT r, avg(CASE WHEN n_t = 0 THEN 0.0 ELSE ln({p("twos.b", "own.b", "prev.b", "n_b")}) - ln({p("twos.t", "own.t", "prev.t", "n_t")}) END) AS d
  FROM pairs JOIN twos USING (u, w) JOIN ones AS own ON own.w = pairs.w JOIN ones AS prev ON prev.w = pairs.u, totals
  GROUP BY r
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_tokens, round(coalesce(d, 0.0), 6) AS ce_difference FROM docs LEFT JOIN scored USING (r)"""
