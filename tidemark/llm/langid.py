"""Language identification with hyperdimensional profiles.

Every letter has a random +-1 vector drawn from its code point.  A trigram's vector binds its
letters after permuting them by position: rho(rho(x)) * rho(y) * z.  A document is the bundle (sum)
of its trigram vectors, a language the bundle of its training documents; the predicted language
has the prototype of highest cosine.

Memory: texts are bundled in parts of about CHUNK_BYTES, longer ones in pieces that end beside a character that is no letter, and
the counts of STEP trigrams and the vectors of BLOCK are held at a time; only a single word longer than that is held whole.

Cases: null texts and texts without a letter give ("und", 0.0); any text is used whole; equal
cosines go to the alphabetically first language; repeated rows give repeated predictions (and count
again in learning); without any usable training row all documents are "und"; other columns of the
input are not read.  Rows with a null label are not learned from, by the query also those with a null id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import cut, key_bucket, release, small_batches, table, text_chunks, tidy

DIM = 1024
SEED = 20
CHUNK_BYTES = 1 << 20
CHUNK_ROWS = 384
WIDTH = 16  # dimensions in one row of a partial prototype
DENSE_GRAMS = 1 << 22
STEP = 1 << 14  # trigrams whose counts are held at once
BLOCK = 1 << 11  # trigram vectors that are held at once
MOST_VECTORS = 1 << 15  # letter vectors that a worker remembers
MAX_LANGUAGES = 4096
BEGINNINGS_ROWS = 64  # texts whose beginnings are bundled at once
ACCURACY = 10_000  # of approximate percentiles: they are off by n / ACCURACY ranks at most
LEAST_SAMPLES = 64  # beginnings of one length that make a bar
BAR_QUANTILE, BAR_SHARE = 0.01, 0.5


@dataclass(frozen=True)
class Profiles:
    langs: tuple[str, ...]
    matrix: np.ndarray  # languages x DIM, unit length
    dim: int = DIM
    seed: int = SEED


_letters: np.ndarray | None = None
_vectors: dict[tuple[int, int, int], np.ndarray] = {}


def is_letter() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _letters


def letter_vector(code: int, dim: int, seed: int) -> np.ndarray:
    key = (code, dim, seed)
    if key not in _vectors:
        if len(_vectors) >= MOST_VECTORS:
            _vectors.clear()
        _vectors[key] = (np.random.default_rng([seed, code]).integers(0, 2, dim, np.int8) * 2 - 1).astype(np.int8)
    return _vectors[key]


def grams(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Code points of the alphabet (0 is the word boundary), the distinct trigrams as rows of three
    alphabet positions, and for each trigram occurrence its document and its distinct trigram."""
    lowered = [(t or b"").decode("utf-8", "replace").lower() for t in texts]
    codes = np.frombuffer(("\n" + "\n".join(lowered) + "\n").encode("utf-32-le", "replace"), np.uint32)
    doc = np.repeat(np.arange(len(lowered)), [len(t) + 1 for t in lowered])
    here = np.zeros(0x110000, bool)
    here[codes] = True
    alphabet = np.concatenate([[0], np.flatnonzero(here & is_letter())])
    lut = np.zeros(0x110000, np.int64)
    lut[alphabet] = np.arange(len(alphabet))
    x, n = lut[codes], len(alphabet)
    middle = np.flatnonzero(x[1:-1])
    gram = (x[middle] * n + x[middle + 1]) * n + x[middle + 2]
    if n**3 <= DENSE_GRAMS:
        here = np.zeros(n**3, bool)
        here[gram] = True
        distinct = np.flatnonzero(here)
        place = np.zeros(n**3, np.int64)
        place[distinct] = np.arange(len(distinct))
        which = place[gram]
    else:
        distinct, which = np.unique(gram, return_inverse=True)
    return alphabet, np.stack([distinct // (n * n), distinct // n % n, distinct % n], 1), doc[middle], which


def gram_vectors(alphabet: np.ndarray, distinct: np.ndarray, dim: int, seed: int) -> np.ndarray:
    used, place = np.unique(distinct, return_inverse=True)
    place = place.reshape(distinct.shape)
    single = np.stack([letter_vector(int(c), dim, seed) for c in alphabet[used]])
    twice, once = np.roll(single, 2, 1), np.roll(single, 1, 1)
    return twice[place[:, 0]] * once[place[:, 1]] * single[place[:, 2]]


def weighed(counts: np.ndarray, alphabet: np.ndarray, distinct: np.ndarray, dim: int, seed: int) -> np.ndarray:
    """The sums of the trigrams' vectors by each row of counts.  They are whole numbers, so blocks change nothing."""
    out = np.zeros((len(counts), dim))
    for lo in range(0, len(distinct), BLOCK):
        out += counts[:, lo : lo + BLOCK].astype(np.float32) @ gram_vectors(alphabet, distinct[lo : lo + BLOCK], dim, seed).astype(np.float32)
    return out


def parts(texts: list[bytes | None], groups: np.ndarray) -> Iterator[tuple[list[bytes | None], np.ndarray]]:
    """Texts and their groups, about CHUNK_BYTES at a time.  A longer text comes in pieces, cut beside characters that are no
    letters and so stand for word boundaries just as the ends of a text do: no trigram changes."""
    held: list[int] = []
    size = 0
    for i, t in enumerate(texts):
        n = len(t or b"")
        if held and size + n > CHUNK_BYTES:
            yield [texts[k] for k in held], groups[held]
            held, size = [], 0
        if n <= CHUNK_BYTES:
            held.append(i)
            size += n
            continue
        whole = t.decode("utf-8", "replace").lower()
        at = 0
        while at < len(whole):
            end = at + CHUNK_BYTES // 4
            while end < len(whole) and whole[end].isalpha():
                end += 1
            yield [whole[at:end].encode("utf-8", "replace")], groups[[i]]
            at = end
    if held:
        yield [texts[k] for k in held], groups[held]


def bundles(texts: list[bytes | None], groups: np.ndarray, n_groups: int, dim: int, seed: int) -> np.ndarray:
    """The bundle of the texts of each group: n_groups x dim."""
    out = np.zeros((n_groups, dim))
    step = max(1, min(STEP, (1 << 22) // max(1, n_groups)))
    for part, own_groups in parts(texts, groups):
        alphabet, distinct, doc, which = grams(part)
        if len(distinct) > step:
            order = np.argsort(which, kind="stable")
            doc, which = doc[order], which[order]
        for lo in range(0, len(distinct), step):
            some = distinct[lo : lo + step]
            own = slice(*np.searchsorted(which, [lo, lo + len(some)])) if len(distinct) > step else slice(None)
            counts = np.bincount(own_groups[doc[own]] * len(some) + which[own] - lo, minlength=n_groups * len(some))
            out += weighed(counts.reshape(n_groups, len(some)), alphabet, some, dim, seed)
    return out


def learn(docs: DataFrame, text: str = "text", label: str = "lang", dim: int = DIM, seed: int = SEED) -> Profiles:
    """Prototypes of all labels of docs.  Each partition bundles its own documents per language; the
    partial prototypes are summed by Spark, and only languages x dim numbers reach the driver."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            names = batch.column(1).to_pylist()
            for start, texts in text_chunks(batch.column(0), CHUNK_BYTES, CHUNK_ROWS):
                own = names[start : start + len(texts)]
                langs = sorted(set(own))
                at = {k: i for i, k in enumerate(langs)}
                sums = bundles(texts, np.array([at[k] for k in own]), len(langs), dim, seed)
                for k, v in zip(langs, sums, strict=True):
                    total[k] = total.get(k, 0) + v
        for k, v in sorted(total.items()):
            rows = np.rint(v).astype(np.int64).reshape(-1, WIDTH)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k] * len(rows)), pa.array(np.arange(len(rows), dtype=np.int32)), *(pa.array(c) for c in rows.T.copy())],
                names=["label", "part", *(f"d{i}" for i in range(WIDTH))],
            )

    schema = "label string, part int, " + ", ".join(f"d{i} long" for i in range(WIDTH))
    rows = docs.select(F.col(text).alias("text"), F.col(label).cast("string").alias("label")).where("label is not null and text is not null")
    sums = rows.mapInArrow(tidy(partial), schema).groupBy("label", "part").agg(*(F.sum(f"d{i}").alias(f"d{i}") for i in range(WIDTH)))
    got = sums.limit(MAX_LANGUAGES * (dim // WIDTH) + 1).collect()
    if len(got) > MAX_LANGUAGES * (dim // WIDTH):
        raise ValueError(f"more than {MAX_LANGUAGES} distinct labels: not a language column")
    langs = sorted({r["label"] for r in got})
    matrix = np.zeros((len(langs), dim))
    for r in got:
        matrix[langs.index(r["label"]), r["part"] * WIDTH : (r["part"] + 1) * WIDTH] = r[2:]
    length = np.linalg.norm(matrix, axis=1)
    keep = np.flatnonzero(length > 0)  # a language whose texts have no letter has no prototype
    return Profiles(tuple(langs[i] for i in keep), (matrix[keep] / length[keep, None]), dim, seed)


def letters(text: bytes | None) -> np.ndarray:
    """Positions of the letters of the text, each the middle of a trigram."""
    codes = np.frombuffer((text or b"").decode("utf-8", "replace").encode("utf-32-le", "replace"), np.uint32)
    return np.flatnonzero(is_letter()[codes])


def beginnings(texts: list[bytes | None], profiles: Profiles) -> list[list[float]]:
    """For each text the scores that its beginnings of 1, 2, 4 ... letters have; each trigram is bundled once for all of them."""
    found = [letters(t) for t in texts]
    n = [len(at).bit_length() for at in found]
    # What lies behind the longest beginning is not needed.
    heads = [t.decode("utf-8", "replace")[: at[(1 << (k - 1)) - 1] + 1].encode() if k else b"" for t, at, k in zip(texts, found, n, strict=True)]
    sums, seen = [np.zeros((k, profiles.dim)) for k in n], [0] * len(texts)
    for part, owners in parts(heads, np.arange(len(texts))):
        alphabet, distinct, doc, which = grams(part)
        edges = np.searchsorted(doc, np.arange(len(part) + 1))
        for i, lo, hi in zip(owners, edges[:-1], edges[1:], strict=True):
            number = np.arange(seen[i] + 1, seen[i] + 1 + hi - lo)
            seen[i] += hi - lo
            first = np.frexp(number)[1]  # the letter of this number is inside the beginnings of 2**first letters and more
            inside = first < n[i]
            used, place = np.unique(which[lo:hi][inside], return_inverse=True)
            for at in range(0, len(used), STEP):
                some = used[at : at + STEP]
                own = (place >= at) & (place < at + len(some))
                counts = np.bincount(first[inside][own] * len(some) + place[own] - at, minlength=n[i] * len(some)).reshape(n[i], len(some)).cumsum(0)
                sums[i] += weighed(counts, alphabet, distinct[some], profiles.dim, profiles.seed)
            last = np.flatnonzero(number & (number - 1) == 0)  # letters that end a beginning, before a word boundary
            if len(last):
                sums[i][first[last] - 1] += gram_vectors(alphabet, distinct[which[lo:hi][last]] * [1, 1, 0], profiles.dim, profiles.seed)
    return [nearest(s, profiles)[1].tolist() for s in sums]


def bars(docs: DataFrame, profiles: Profiles, text: str = "text", label: str = "lang") -> list[float]:
    """The least score of a text of 2**k to 2**(k + 1) - 1 letters, for each k: BAR_SHARE of the BAR_QUANTILE of
    the scores that beginnings of all distinct learning texts have at 2**k letters, found exactly.  Lengths that too few texts
    have take the bar of the length before; the first ones have 0."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in text_chunks(batch.column(0), CHUNK_BYTES, BEGINNINGS_ROWS):
                scores = pa.array(beginnings(texts, profiles), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(start, len(texts)), scores], names=["hash", "scores"])

    rows = docs.where(F.col(label).isNotNull() & F.col(text).isNotNull()).select(F.col(text).cast("string").alias("text"), F.xxhash64(F.col(text).cast("string")).alias("hash"))
    # Scores move, not texts.
    scored = rows.mapInArrow(tidy(each), "hash long, scores array<double>").dropDuplicates(["hash"])
    scored = cut(scored.select(F.posexplode("scores").alias("k", "score")), "beginnings")
    found = {k: x * BAR_SHARE for k, (n, x) in quantiles(scored, BAR_QUANTILE).items() if n >= LEAST_SAMPLES}
    release(scored)
    out: list[float] = []
    for k in range(max(found, default=0) + 1):
        out.append(found.get(k, out[-1] if out else 0.0))
    return out


def quantiles(scored: DataFrame, share: float) -> dict[int, tuple[int, float]]:
    """n and the quantile of the scores (0 or more) of each k = 0, 1, 2 ..., exact, between two ranks on the line.  Approximate percentiles
    bracket it; of what lies in the bracket, some thousandths, distinct scores and their counts reach the driver."""
    ends = F.percentile_approx("score", [max(0.0, share - 10 / ACCURACY), min(1.0, share + 10 / ACCURACY)], ACCURACY)
    got = scored.groupBy("k").agg(F.count("*").alias("n"), F.array(F.min("score"), F.max("score")).alias("all"), ends.alias("ends")).orderBy("k").collect()
    if not got:
        return {}
    brackets = [r["all"] if r["n"] <= ACCURACY else r["ends"] for r in got]
    low, high = (F.get(F.array(*(F.lit(b[i]) for b in brackets)), F.col("k")) for i in (0, 1))
    below = F.when(F.col("score") < low, -1.0).otherwise(F.col("score"))
    counts = scored.where(F.col("score") <= high).groupBy("k", below.alias("score")).agg(F.count("*").alias("n")).toPandas().sort_values(["k", "score"])
    out = {}
    for r in got:
        mine, rank = counts[counts["k"] == r["k"]], (r["n"] - 1) * share
        at = np.searchsorted(mine["n"].cumsum().to_numpy(), [np.floor(rank), np.ceil(rank)], side="right")
        a, b = mine["score"].to_numpy()[at]
        out[r["k"]] = (r["n"], float(a + (b - a) * (rank - np.floor(rank))))
    return out


def recognised(docs: DataFrame, profiles: Profiles, least: list[float], keep: tuple[str, ...]) -> DataFrame:
    """The columns keep and lang_pred of the documents whose score is above 0 and at least the bar of their length."""
    out = predict(docs, profiles, keep=keep, counted=True)
    place = F.least(F.floor(F.log2(F.greatest(F.col("n_letters"), F.lit(1)))).cast("int"), F.lit(len(least) - 1))
    bar = F.get(F.array(*map(F.lit, least)), place)
    return out.where((F.col("lang_pred") != "und") & (F.col("score") > 0) & (F.col("score") >= bar)).drop("score", "n_letters")


def nearest(hv: np.ndarray, profiles: Profiles) -> tuple[np.ndarray, np.ndarray]:
    """Place of the language nearest to each bundle, -1 for an empty one, and the cosine, at least 0."""
    length = np.linalg.norm(hv, axis=1)
    if not profiles.langs:
        return np.full(len(hv), -1), np.zeros(len(hv))
    cos = hv @ profiles.matrix.T / np.where(length, length, 1)[:, None]
    best = np.round(cos, 12).argmax(1)
    return np.where(length > 0, best, -1), np.where(length > 0, np.clip(cos[np.arange(len(best)), best], 0, 1), 0.0)


def guesses(texts: list[bytes | None], profiles: Profiles) -> tuple[list[str], list[float]]:
    """Language and score of each text."""
    if not profiles.langs:
        return ["und"] * len(texts), [0.0] * len(texts)
    best, scores = nearest(bundles(texts, np.arange(len(texts)), len(texts), profiles.dim, profiles.seed), profiles)
    return [profiles.langs[b] if b >= 0 else "und" for b in best], scores.tolist()


def predict(docs: DataFrame, profiles: Profiles, keep: tuple[str, ...] = ("doc_id",), text: str = "text", counted: bool = False) -> DataFrame:
    """The columns keep of docs, with lang_pred and score (the cosine, at least 0), and if counted n_letters."""

    def guess(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores, n = [], [], []
            for _, texts in text_chunks(batch.column(0), CHUNK_BYTES, CHUNK_ROWS):
                if counted:
                    n += [len(letters(t)) for t in texts]
                found = guesses(texts, profiles)
                langs += found[0]
                scores += found[1]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(langs, pa.string()), pa.array(scores, pa.float64()), *([pa.array(n, pa.int64())] if counted else [])],
                names=[*batch.schema.names[1:], "lang_pred", "score", *(["n_letters"] if counted else [])],
            )

    rows = docs.select(F.col(text).cast("string").alias("__text"), *keep)
    schema = rows.drop("__text").schema.add("lang_pred", "string").add("score", "double")
    return rows.mapInArrow(tidy(guess), schema.add("n_letters", "long") if counted else schema)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lang_pred and score of every document, learned from the rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    rest = key_bucket("doc_id", 4)
    profiles = learn(docs.where(rest != 2))
    out = predict(docs.select("doc_id", "text"), profiles)
    return out.select("doc_id", F.coalesce(rest == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a recognised language: "und", and texts less like any than the bar of their length, go; a null
    lang gets the prediction.  Nothing is held out: profiles and bars are of all rows that have a lang."""
    del sf_dir
    small_batches(spark)
    columns = docs.columns
    profiles = learn(docs)
    rows = docs.select(F.struct(*columns).alias("__row"), "text")
    out = recognised(rows, profiles, bars(docs, profiles), keep=("__row",))
    got = {c: F.col("__row")[c] for c in columns}
    return out.select(*(F.coalesce(got[c], "lang_pred").alias(c) if c == "lang" else got[c].alias(c) for c in columns))
