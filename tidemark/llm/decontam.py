"""Benchmark decontamination by template canonicalisation.

Texts become templates: words lose case and outer punctuation; numbers, names (capitalised words
inside a sentence, at most NAME_WORDS in a row: passages in capitals or title case keep their words) and units (after a number) become typed placeholders.  Windows of WINDOW template
tokens of the benchmark items are hashed; document windows are hash-joined with them.

Evidence is weighed row by row and alignment by alignment.  Windows whose shifts against the item lie within SHIFT words
(a name may have more words than the one that it replaces) are one alignment; its slots are consistent if each value
of the item stands for one value of the document (two values of the item may become the same one).  A re-parameterised
question so matches with other slot values.  Of an alignment with inconsistent slots the windows with unchanged values
count; those of all alignments also count together, as copies of parts that were moved.  An item is found in a row where
the windows of one alignment, or the unchanged ones, cover at least MIN_COVERAGE of it or hold a run of MIN_RUN of its
windows, however long it is.

Items too short or too poor in literal words for such a window (short sums, say) are compared word for word, slots
included, in windows of their own length or WINDOW; items of fewer than SHORT words only with rows that are nothing else.

One filter at every size spares the join windows that no item has: 16 bits for each of FILTER_WINDOWS benchmark windows,
a fixed 32 MB.  A larger benchmark fills it, which lets more windows through to the join and loses none.

Cases: null or empty texts have no windows, and items without a word are never found; rows are told apart by doc_id and
text, so repeated rows count once, and rows of one id (or of none) are judged each by itself and reported under their id
with the best one's figures; items that share an id likewise; texts of any length are used whole; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import HashFilter, cut, small_batches, table, text_chunks, tidy, word_hashes

WINDOW = 8
MIN_LITERALS = 4
MIN_COVERAGE = 0.5
MIN_RUN = 16  # consecutive windows of an item, 23 words or more, that suffice
NAME_WORDS = 4  # a longer run of capitalised words is a heading or shouting and holds no name
FILTER_WINDOWS = 1 << 24  # benchmark windows that the filter has 16 bits for
SHIFT = 4  # words that windows of one alignment may be shifted against each other
SHORT = 3  # items of fewer words are found only in rows that are nothing else

NUMBER = re.compile(rb"[+-]?[\d.,:/]*\d[\d.,:/]*(?:st|nd|rd|th)?")
QUANTITY = re.compile(rb"[+-]?\d[\d.,]*([a-z/%]{1,5})")
# Fixed values.
NUMBER_WORDS = (
    b"zero two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen "
    b"twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion dozen"
).split()
UNITS = (
    b"mm cm m km in ft yd mi inch inches foot feet yard yards mile miles metre metres meter meters kilometre kilometres kilometer "
    b"kilometers mg g kg t oz lb lbs gram grams kilogram kilograms ounce ounces pound pounds ton tons ml l litre litres liter liters "
    b"gallon gallons s sec secs min mins h hr hrs second seconds minute minutes hour hours day days week weeks month months year years "
    b"mph kmh km/h m/s hz khz mhz ghz w kw mw kwh v a j kj cal kcal n pa kpa k c f percent dollar dollars cent cents euro euros "
    b"usd eur gbp degree degrees"
).split()

_LITERAL, _NUM, _NAME, _UNIT = 0, 1, 2, 3
_TYPE_HASH = np.array([0, 0x51ED2705A1B3C7D9, 0x3C6EF372FE94F82B, 0x9B05688C2B3E6C1F], np.uint64)
_BASE = 0x9E3779B97F4A7C15

_SPACE = np.zeros(256, bool)
_SPACE[list(b" \t\n\v\f\r")] = True
_OUTER = np.zeros(256, bool)  # punctuation that is stripped off a word
_OUTER[list(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[list(b"0123456789")] = True
_LETTER = np.zeros(256, bool)  # ASCII letters, and the lead byte of Latin-1 letters
_LETTER[list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ\xc3")] = True
_STOP = np.zeros(256, bool)
_STOP[list(b".!?:|")] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def _before(mask: np.ndarray) -> np.ndarray:
    """How many are true before each position."""
    return np.concatenate([[0], np.cumsum(mask, dtype=np.int32)])


class Templates:
    """The words of a batch of texts as templates: for each word its text, its place, its hash (of the
    placeholder, where it is a slot) and its kind.  The case of ASCII and Latin-1 letters is folded."""

    def __init__(self, texts: list[bytes | None], names: bool = True):
        self.raw = b"\n".join(t or b"" for t in texts) + b"\n"
        x = np.frombuffer(self.raw, np.uint8)
        first = np.cumsum([0, *(len(t or b"") + 1 for t in texts[:-1])])
        low = _LOWER[x]
        latin = np.concatenate([[False], (x[:-1] == 0xC3) & (x[1:] >= 0x80) & (x[1:] <= 0x9E) & (x[1:] != 0x97)])
        low[latin] += 32
        space, core = _SPACE[x], ~_SPACE[x] & ~_OUTER[x]
        edge = np.flatnonzero(np.diff(np.concatenate([[True], space]).astype(np.int8)))
        self.start, self.end = start, end = edge[0::2], edge[1::2]
        n = len(start)
        self.doc = np.searchsorted(first, start, "right") - 1
        self.hash, self.word, self.kind = np.zeros(n, np.uint64), np.zeros(n, np.uint64), np.zeros(n, np.int8)
        self.core = np.stack([start, start])
        if not n:
            return
        at = np.append(np.flatnonzero(core), len(x))
        lo = at[np.searchsorted(at, start)]
        hi = at[np.searchsorted(at, end) - 1] + 1
        bare = lo >= end  # nothing but punctuation: the word is its own core
        lo, hi = np.where(bare, start, lo), np.where(bare, end, hi)
        self.core = np.stack([lo, hi])
        self.hash = self.word = word_hashes(low, lo, hi)
        number = np.isin(self.hash, _hash_words(NUMBER_WORDS))
        digits = _before(_DIGIT[x])
        for i in np.flatnonzero(digits[hi] > digits[lo]).tolist():
            word = low[lo[i] : hi[i]].tobytes()
            number[i] = bool(NUMBER.fullmatch(word)) or bool((m := QUANTITY.fullmatch(word)) and m[1] in UNITS)
        stops, lines = _before(_STOP[x]), _before(x == 10)
        ends = (stops[end] > stops[hi]) | (bare & (stops[end] > stops[start]))
        opens = np.concatenate([[True], ends[:-1] | (lines[start[1:]] > lines[end[:-1]])])
        capital = (low[lo] != x[lo]) | (latin[np.minimum(lo + 1, len(x) - 1)] & (x[lo] == 0xC3))
        if names:
            self.kind[capital & ~opens & ~self.headings(capital, _LETTER[x[lo]])] = _NAME
        self.kind[number] = _NUM
        follows = np.flatnonzero(np.concatenate([[False], number[:-1] & (self.doc[1:] == self.doc[:-1])]) & ~number)
        self.kind[follows[np.isin(self.hash[follows], _hash_words(UNITS))]] = _UNIT
        self.hash = np.where(self.kind == _LITERAL, self.hash, _TYPE_HASH[self.kind])

    def headings(self, capital: np.ndarray, lettered: np.ndarray) -> np.ndarray:
        """Which words lie in a run of more than NAME_WORDS capitalised words of one text; words without a letter
        at their start neither count nor end a run."""
        at = np.flatnonzero(lettered)
        out = np.zeros(len(capital), bool)
        if len(at):
            turns = (capital[at[1:]] != capital[at[:-1]]) | (self.doc[at[1:]] != self.doc[at[:-1]])
            run = np.concatenate([[0], np.cumsum(turns)])
            out[at] = capital[at] & (np.bincount(run)[run] > NAME_WORDS)
        return out

    def windows(self, size: int, verbatim: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """First words and hashes of the windows of that size inside one text: of templates with enough literal words, or
        if verbatim of the words themselves."""
        n = len(self.hash) - size + 1
        if n < 1:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        own = self.word if verbatim else self.hash
        total = np.full(n, 2 * size + verbatim, np.uint64)
        for k in range(size):
            total = total * np.uint64(_BASE) + own[k : k + n]
        total ^= total >> np.uint64(29)
        good = self.doc[:n] == self.doc[size - 1 :]
        if not verbatim:
            literal = _before(self.kind == _LITERAL)
            good &= literal[size:] - literal[:-size] >= MIN_LITERALS
        good = np.flatnonzero(good)
        return good, total[good]

    def slots(self, word: int, size: int) -> list[str]:
        lo, hi = self.core
        return [self.raw[lo[i] : hi[i]].decode("utf-8", "replace").casefold() for i in range(word, word + size) if self.kind[i]]


def _hash_words(words: list[bytes]) -> np.ndarray:
    ends = np.cumsum([len(w) for w in words])
    return word_hashes(np.frombuffer(b"".join(words), np.uint8), np.concatenate([[0], ends[:-1]]), ends)


def benchmark_windows(items: DataFrame, id_col: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, item, total, size, verbatim, whole, hash, at, place, slots) for each window of each item; item is the digest
    of its text.  A window with names is there a second time with their words, as a passage in capitals or title case has them."""
    arrow = pa.schema(
        [("item_id", pa.int64()), ("item", pa.int64()), ("total", pa.int32()), ("size", pa.int32()), ("verbatim", pa.bool_()), ("whole", pa.bool_())]
        + [("hash", pa.int64()), ("at", pa.int32()), ("place", pa.int32()), ("slots", pa.list_(pa.string()))]
    )

    def of(item: int | None, digest: int, value: bytes) -> pa.RecordBatch:
        t = Templates([value])
        size, verbatim = min(WINDOW, len(t.hash)), False
        starts, found = t.windows(size) if size >= MIN_LITERALS else ((), np.empty(0, np.uint64))
        if not len(found) and size:
            verbatim = True
            starts, found = t.windows(size, verbatim)
        place = {s: i for i, s in enumerate(starts)}
        rows = [(s, h, t) for s, h in zip(starts, found.view(np.int64).tolist(), strict=True)]
        if not verbatim:
            own, plain = {s: h for s, h, _ in rows}, Templates([value], names=False)
            rows += [(s, h, plain) for s, h in zip(*(x.tolist() for x in _signed(plain.windows(size))), strict=True) if own.get(s, h) != h]
        columns = [
            *([v] * len(rows) for v in (item, digest, len(place), size, verbatim, len(t.hash) < SHORT)),
            [h for _, h, _ in rows], [s for s, _, _ in rows], [place[s] for s, _, _ in rows], [x.slots(s, size) for s, _, x in rows],
        ]
        return pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(columns, arrow, strict=True)], schema=arrow)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, digest, value in zip(batch.column(0), batch.column(1), batch.column(2).cast(pa.large_binary()), strict=True):
                yield of(item.as_py(), digest.as_py(), value.as_py())

    source = F.col(text).cast("string")
    rows = items.select(F.col(id_col).cast("long").alias("item_id"), F.xxhash64(source).alias("item"), source.alias("text")).where("text is not null").distinct()
    schema = "item_id long, item long, total int, size int, verbatim boolean, whole boolean, hash long, at int, place int, slots array<string>"
    return rows.mapInArrow(tidy(each), schema)


def _signed(windows: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return windows[0], windows[1].view(np.int64)


def filter_bits() -> int:
    """Binary logarithm of the bits of the filter."""
    return max(10, (FILTER_WINDOWS - 1).bit_length() + 4)


def row_matches(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text: str = "text", min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """(doc_id, digest, item_id, total, n_matched, changed) of each item found in a row, which doc_id and the digest of its text name."""
    windows = cut(benchmark_windows(items), "benchmark-windows")
    kinds = sorted((r["size"], r["verbatim"]) for r in windows.select("size", "verbatim").distinct().collect())  # WINDOW of each kind at most
    shared = docs.sparkSession.sparkContext.broadcast(HashFilter.of(windows, filter_bits()))
    arrow = pa.schema(
        [("doc_id", pa.int64()), ("digest", pa.int64()), ("size", pa.int32()), ("hash", pa.int64()), ("pos", pa.int32()), ("alone", pa.bool_()), ("doc_slots", pa.list_(pa.string()))]
    )

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value.bitmap()
        for batch in batches:
            for start, texts in text_chunks(batch.column(2), 1 << 20, 4096):
                t = Templates(texts)
                opens = np.searchsorted(t.doc, np.arange(len(texts) + 1))
                words = np.diff(opens)
                for size, verbatim in kinds:
                    starts, found = t.windows(size, verbatim)
                    hit = known(found)
                    starts, found = starts[hit], found[hit]
                    if len(found):
                        doc = t.doc[starts]
                        columns = [
                            batch.column(0).take(pa.array(doc + start)),
                            batch.column(1).take(pa.array(doc + start)),
                            pa.array(np.full(len(found), size, np.int32)),
                            pa.array(found.view(np.int64)),
                            pa.array((starts - opens[doc]).astype(np.int32)),
                            pa.array(words[doc] == size),
                            pa.array([t.slots(s, size) for s in starts.tolist()], pa.list_(pa.string())),
                        ]
                        yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    source = F.col(text).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(source).alias("digest"), source.alias("text"))
    seen = rows.mapInArrow(tidy(each), "doc_id long, digest long, size int, hash long, pos int, alone boolean, doc_slots array<string>")
    slots = F.arrays_zip(F.col("slots").alias("own"), F.col("doc_slots").alias("other"))
    key = ["doc_id", "digest", "item_id", "item", "total"]
    pairs = seen.join(windows, ["size", "hash"]).where("alone or not whole").select(*key, "verbatim", "place", (F.col("pos") - F.col("at")).alias("shift"), slots.alias("pairs"))
    same = F.forall("pairs", lambda p: p["own"] == p["other"])
    # Two rows of bands, half a band apart: shifts of SHIFT words or less share one.  The null band is for unchanged windows of all shifts.
    low, high = (F.floor((F.col("shift") + k * SHIFT) / (2 * SHIFT)) * 2 + k for k in (0, 1))
    null = F.lit(None).cast("long")
    pairs = pairs.where(same | ~F.col("verbatim")).withColumn("band", F.explode(F.when(same, F.array(low, high, null)).otherwise(F.array(low, high))))
    # A band holds 2 * SHIFT windows at each place of the item at most, and the null band one, so the item bounds what is collected.
    aligned = pairs.groupBy(*key, "band").agg(F.collect_set(F.struct("place", "pairs")).alias("held"))
    aligned = aligned.withColumn("values", F.array_distinct(F.flatten("held.pairs")))
    consistent = F.size("values") == F.size(F.array_distinct("values.own"))
    unchanged = F.filter("held", lambda w: F.forall(w["pairs"], lambda p: p["own"] == p["other"]))
    kept = aligned.withColumn("held", F.when(consistent, F.col("held")).otherwise(unchanged))
    changed = F.size(F.filter(F.array_distinct(F.flatten("held.pairs")), lambda p: p["own"] != p["other"]))
    judged = kept.select(*key, F.size(F.array_distinct("held.place")).alias("n_matched"), longest_run(F.col("held.place")).alias("run"), changed.alias("changed"))
    judged = judged.where((F.col("n_matched") / F.col("total") >= min_coverage) | (F.col("run") >= MIN_RUN))
    best = F.max(F.struct("n_matched", (-F.col("changed")).alias("less"))).alias("best")
    return judged.groupBy(*key).agg(best).select("doc_id", "digest", "item_id", "total", "best.n_matched", (-F.col("best.less")).alias("changed"))


def matches(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text: str = "text", min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """(doc_id, item_id, n_windows, n_matched, coverage, changed_slots) of each item found in a document."""
    found = row_matches(docs, items, id_col, text, min_coverage).withColumn("coverage", F.col("n_matched") / F.col("total"))
    best = F.max(F.struct("coverage", "n_matched", (-F.col("changed")).alias("less"), "total")).alias("best")
    return (
        found.groupBy("doc_id", "item_id")
        .agg(best)
        .select("doc_id", "item_id", F.col("best.total").cast("long").alias("n_windows"), F.col("best.n_matched").cast("long").alias("n_matched"), "best.coverage", (-F.col("best.less")).cast("long").alias("changed_slots"))
    )


def longest_run(places: Column) -> Column:
    """The length of the longest run of consecutive numbers in an array."""
    start = F.struct(F.lit(-2).alias("last"), F.lit(0).alias("n"), F.lit(0).alias("best"))

    def step(a: Column, x: Column) -> Column:
        n = F.when(x == a["last"] + 1, a["n"] + 1).otherwise(F.lit(1))
        return F.struct(x.alias("last"), n.alias("n"), F.greatest(a["best"], n).alias("best"))

    return F.aggregate(F.array_sort(F.array_distinct(places)), start, step, lambda a: a["best"])


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that hold benchmark items, one row per document and item."""
    return matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; rows are told apart by doc_id, which may be null, and text."""
    small_batches(spark)
    # One column holds the row, so that no name of the input can clash with the names here.
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("id"), F.xxhash64(F.col("text").cast("string")).alias("own_digest"))
    bad = cut(row_matches(docs, table(spark, sf_dir, "benchmark")).select("doc_id", "digest").distinct(), "contaminated")
    return rows.join(bad, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("own_digest") == F.col("digest")), "left_anti").select("row.*")
