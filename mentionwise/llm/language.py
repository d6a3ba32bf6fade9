"""Language identification with bit-sliced Bloom filters over letter trigrams.

Each language has a Bloom filter of the trigrams that are typical of it. The filters
are stored sliced: a slot holds one bit for each language, so a trigram is looked up
in all filters at once and the bitwise AND of its slots is the set of languages that
contain it. A text's score for a language is the share of its trigrams found in that
filter, corrected for the filter's rate of false positives.

A trigram belongs to a language if it makes up at least ``MIN_RATE`` of the
language's trigrams there (so at most ``1 / MIN_RATE`` trigrams a language, whatever
the corpus) and at least ``MIN_SHARE`` of its rate in the language where it is most
frequent. Counts cover every training row. Rows whose crc32(doc_id) mod 5 is 0 are
held out; a null doc_id counts as held out.

Edge cases: null, empty or letterless text is ``und`` with score 0; so is any text
if nothing could be learned. Ties go to the language that sorts first. Repeated rows
are predicted one by one. Long texts are read in overlapping slices. Columns other
than doc_id, text and lang are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from mentionwise.llm.memory import tidy
from mentionwise.session import freeze

MIN_RATE = 1e-5
MIN_SHARE = 0.3
SLOTS = 1 << 20
HASHES = 4
SLICE_CHARS = 1_000_000
# distinct (language, trigram) pairs a task holds before it passes its counts on
HELD = 500_000
# trigrams that wait to be counted together, whatever the Arrow batch holds
WAITING = 2_000_000
FOLDS = 5
UNKNOWN = "und"
# share of trigrams, after correction, under which the filter rejects a text
MIN_FIT = 0.3
SPACE = 32


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """For each code point: is it a letter?"""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def trigrams(text: str | None) -> Iterator[np.ndarray]:
    """Trigrams of the lower-cased words, a space before and after each, as 63-bit keys, slice by slice."""
    for at in range(0, len(text or ""), SLICE_CHARS):
        # slices overlap by the two characters that a trigram needs
        part = text[max(at - 2, 0):at + SLICE_CHARS]
        if at + SLICE_CHARS >= len(text):
            part += " "
        c = np.frombuffer(((" " if at == 0 else "") + part.lower()).encode("utf-32-le", "surrogatepass"), np.uint32)
        c = np.where(letters()[c], c, SPACE).astype(np.uint64)
        keys = c[:-2] << np.uint64(42) | c[1:-1] << np.uint64(21) | c[2:]
        yield keys[c[1:-1] != SPACE]


def count_trigrams(docs: DataFrame) -> DataFrame:
    """``lang, gram, n``: occurrences in ``docs`` (``text, lang``), summed within tasks first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: dict[str, int] = {}
        sums: dict[int, tuple[np.ndarray, np.ndarray]] = {}

        def flush() -> pa.RecordBatch:
            listed = list(names)
            lang = [listed[i] for i, (g, _) in sums.items() for _ in range(len(g))]
            gram = np.concatenate([g for g, _ in sums.values()]).view(np.int64)
            n = np.concatenate([c for _, c in sums.values()])
            sums.clear()
            return pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(gram), pa.array(n)], ["lang", "gram", "n"])

        def add(waiting: dict[int, list[np.ndarray]]) -> None:
            for i, parts in waiting.items():
                gram, n = np.unique(np.concatenate(parts), return_counts=True)
                if i in sums:
                    gram, where = np.unique(np.concatenate([sums[i][0], gram]), return_inverse=True)
                    n = np.bincount(where, np.concatenate([sums[i][1], n])).astype(np.int64)
                sums[i] = gram, n
            waiting.clear()

        waiting: dict[int, list[np.ndarray]] = {}
        held = 0
        for batch in batches:
            for text, lang in zip(batch.column("text"), batch.column("lang"), strict=True):
                i = names.setdefault(lang.as_py(), len(names))
                for keys in trigrams(text.as_py()):
                    waiting.setdefault(i, []).append(keys)
                    held += len(keys)
                    if held > WAITING:
                        add(waiting)
                        held = 0
                        if sum(len(g) for g, _ in sums.values()) > HELD:
                            yield flush()
        add(waiting)
        if sums:
            yield flush()

    rows = docs.select("text", "lang").mapInArrow(tidy(count), "lang string, gram long, n long")
    return rows.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """Slots of keys under one of the hash functions."""
    x = (keys ^ np.uint64(seed * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x94D049BB133111EB)
    return (x >> np.uint64(20)) % np.uint64(SLOTS)


class Filters:
    """The sliced filters: ``planes[p][slot]`` holds the bits of languages 64 p to 64 p + 63."""

    def __init__(self, names: list[str], planes: np.ndarray, sizes: list[int]):
        self.names, self.planes = names, planes
        filled = 1 - np.exp(-HASHES * np.array(sizes, float) / SLOTS)
        self.false_positive = filled ** HASHES

    def fits(self, texts: Iterable[str | None], rows: int) -> tuple[np.ndarray, np.ndarray]:
        """Corrected share of each text's trigrams for each language; number of trigrams."""
        n = np.zeros(rows, np.int64)
        hits = np.zeros((rows, len(self.names)))
        for row, text in enumerate(texts):
            for keys in trigrams(text):
                n[row] += len(keys)
                for p, plane in enumerate(self.planes):
                    found = plane[mix(keys, 1)]
                    for seed in range(2, HASHES + 1):
                        found &= plane[mix(keys, seed)]
                    for lang in range(64 * p, min(64 * p + 64, len(self.names))):
                        hits[row, lang] += np.count_nonzero(found >> np.uint64(lang - 64 * p) & np.uint64(1))
        rate = hits / np.maximum(n, 1)[:, None]
        return np.clip((rate - self.false_positive) / (1 - self.false_positive), 0, 1), n


def learn(docs: DataFrame) -> Filters:
    """Filters from every row of ``docs`` (``doc_id, text, lang``) that has a lang and is not held out.

    The driver receives the slots, at most ``SLOTS`` for each 64 languages, and the names.
    """
    spark = docs.sparkSession
    counts = freeze(count_trigrams(docs.where(F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))), "trigrams")
    totals = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    names = sorted(totals)
    if not names:
        return Filters([], np.zeros((0, SLOTS), np.uint64), [])
    known = F.broadcast(spark.createDataFrame([(n, i, totals[n]) for i, n in enumerate(names)], "lang string, i int, total long"))
    rates = counts.join(known, "lang").select("i", "gram", (F.col("n") / F.col("total")).alias("rate"))
    best = F.max("rate").alias("best")
    typical = rates.where(F.col("rate") >= MIN_RATE)
    gathered = typical.groupBy("gram").agg(best, F.collect_list(F.struct("i", "rate")).alias("rates"))
    chosen = gathered.select("gram", "best", F.inline("rates")).where(F.col("rate") >= F.col("best") * MIN_SHARE)
    chosen = freeze(chosen.select("gram", "i"), "typical")
    sizes = {r["i"]: r["n"] for r in chosen.groupBy("i").agg(F.count(F.lit(1)).alias("n")).collect()}

    @arrow_udf("array<int>")
    def slots(grams: pa.Array) -> pa.Array:
        keys = np.asarray(grams).view(np.uint64)
        made = np.stack([mix(keys, s) for s in range(1, HASHES + 1)], axis=1).astype(np.int32)
        return pa.array(list(made), pa.list_(pa.int32()))

    bits = chosen.select(
        F.explode(slots("gram")).alias("slot"), F.floor(F.col("i") / 64).cast("int").alias("plane"),
        F.call_function("shiftleft", F.lit(1).cast("long"), F.col("i") % 64).alias("bit"),
    )
    sliced = bits.groupBy("plane", "slot").agg(F.bit_or("bit").alias("mask")).toArrow()
    planes = np.zeros((-(-len(names) // 64), SLOTS), np.uint64)
    planes[sliced["plane"].to_numpy(), sliced["slot"].to_numpy()] = sliced["mask"].to_numpy().view(np.uint64)
    return Filters(names, planes, [sizes.get(i, 0) for i in range(len(names))])


def identify(text: Column, filters: Filters) -> Column:
    """Struct ``lang_pred, score, fit`` of a text.

    ``score``: the best language's part of all fits, 0 to 1. ``fit``: its corrected share.
    """

    @arrow_udf("lang_pred string, score double, fit double")
    def run(texts: pa.Array) -> pa.Array:
        fits, n = filters.fits((t.as_py() for t in texts), len(texts))
        if not filters.names:
            names, best, part = [UNKNOWN] * len(n), np.zeros(len(n)), np.zeros(len(n))
        else:
            top = fits.argmax(axis=1)
            best = fits[np.arange(len(n)), top]
            part = best / np.maximum(fits.sum(axis=1), 1e-12)
            names = [filters.names[i] if k else UNKNOWN for i, k in zip(top.tolist(), n.tolist(), strict=True)]
        return pa.StructArray.from_arrays(
            [pa.array(names, pa.string()), pa.array(np.clip(part, 0, 1)), pa.array(best)], ["lang_pred", "score", "fit"]
        )

    return run(text)


def predict(docs: DataFrame, filters: Filters | None = None) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, fit`` for every row of ``docs``."""
    filters = filters or learn(docs)
    found = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), identify(F.col("text"), filters).alias("p"))
    return found.select("doc_id", "held_out", "p.*")


def keep_identified(docs: DataFrame) -> DataFrame:
    """``docs`` without those of no language, or of too small a share in the best one."""
    judged = docs.withColumn("__language", identify(F.col("text"), learn(docs)))
    fits = (F.col("__language.lang_pred") != UNKNOWN) & (F.col("__language.fit") >= MIN_FIT)
    return judged.where(fits).select(*docs.columns)
