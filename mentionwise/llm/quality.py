"""Quality rules: counts of a text, and perplexity under modified Kneser-Ney bigram models.

One model for each value of ``lang`` (null is one) is counted by Spark over all texts;
there is no limit on the vocabulary. Texts are tokenised once, into blocks of documents:
a block holds its words as numbers by falling frequency, the hashes of its vocabulary and
nothing else of the texts. It then asks shards, dealt by ranges of hashes, for what it
lacks: of each of its distinct word pairs the count in the corpus, and whether it is the
block that stands for the pair (a pair has one such block, so kinds of pairs are counted
there), and of each of its words the sums of all blocks. Hashes are sent sorted, as
differences, and answers come back in the same order, without keys. A pair or word is one
entry of a block in one shard, however frequent it is.

Pairs are asked for in ``SLICES`` parts one after the other, and blocks meet their answers
in as many, so only a part of the pairs or of the blocks is shuffled at once; a finished
part leaves its answers only.

A text is kept if its base counts pass and its log perplexity lies within the band
of its language: the quartiles of all texts that pass, widened by ``SPREAD`` times
the distance between them.

Edge cases: a null or empty text has no words, all counts 0 and fails; a text of one
word has one pair (the start of a text counts as a word); rows equal in doc_id, lang
and text fare alike; a null doc_id is judged like any; other columns are not read. Words
and pairs of words are compared by 64-bit hashes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from mentionwise.llm.scratch import Scratch
from mentionwise.session import shuffle_partitions

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = "#*$%&|<>"
WINDOW = 3
MIN_WORDS = 50
MAX_REPEATED = 50
SPREAD = 4.0
# words of a block of documents, about; a document is never split
BLOCK_WORDS = 2_000_000
# entries of a shard, about
SHARD = 2_000_000
# parts of pairs, of blocks, and of words, that are handled one after the other
SLICES, WORD_SLICES = 6, 2
# distinct pairs a task holds before it passes its counts on
HELD = 1_000_000
# words whose hash a Python worker keeps
WORDS_KEPT = 500_000
_hashes: dict[str, int] = {}


def hashed(words: list[str], seed: int = 0) -> np.ndarray:
    """64-bit hashes of words."""
    if len(_hashes) > WORDS_KEPT:
        _hashes.clear()
    for w in set(words).difference(_hashes):
        _hashes[w] = xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass"))
    return np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))


def pair_hash(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """One hash for a word after another."""
    x = (left * np.uint64(0x9E3779B97F4A7C15)) ^ (right + np.uint64(0xD1B54A32D192ED03))
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def language_seed(lang: str | None) -> np.uint64:
    """Start of a text of a language, as the hash of a word that no text has."""
    return np.uint64(xxhash.xxh64_intdigest(b"" if lang is None else b" " + lang.encode(), 7))


def text_pairs(text: str | None, lang: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of a text, each with the word before; both bound to the language."""
    seed = language_seed(lang)
    words = hashed(WORD.findall(text or "")) ^ seed
    return np.concatenate([[seed], words[:-1]]).astype(np.uint64) if len(words) else words, words


def measured(text: str | None) -> tuple[tuple[int, int, int, int, int], np.ndarray]:
    """Words, their characters, symbols, repeated lines, words in repeated windows; and the words' hashes."""
    text = text or ""
    words = WORD.findall(text)
    seen: set[str] = set()
    repeated = 0
    for line in text.split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    covered = 0
    h = hashed(words)
    if len(words) >= WINDOW:
        w = pair_hash(pair_hash(h[:-2], h[1:-1]), h[2:])
        _, where, n = np.unique(w, return_inverse=True, return_counts=True)
        again = n[where] > 1
        cover = np.zeros(len(words), bool)
        for k in range(WINDOW):
            cover[k:len(again) + k] |= again
        covered = int(cover.sum())
    return (len(words), sum(map(len, words)), sum(map(text.count, SYMBOLS)), repeated, covered), h


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """The base counts of a text."""
    return measured(text)[0]


COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def count_pairs(docs: DataFrame) -> DataFrame:
    """``lang, before, word, n`` over all ``docs`` (``lang, text``), summed within tasks first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[str | None, list[np.ndarray]] = {}
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, parts in kept.items():
                before, word = (np.concatenate(p) for p in zip(*parts, strict=True))
                order = np.lexsort((word, before))
                before, word = before[order], word[order]
                first = np.flatnonzero(np.r_[True, (before[1:] != before[:-1]) | (word[1:] != word[:-1])])
                n = np.diff(np.r_[first, len(word)])
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * len(first), pa.string()), pa.array(before[first].view(np.int64)),
                    pa.array(word[first].view(np.int64)), pa.array(n, pa.int64()),
                ], ["lang", "before", "word", "n"])
            kept.clear()

        for batch in batches:
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
                before, word = text_pairs(text, lang)
                if len(word):
                    kept.setdefault(lang, []).append((before, word))
                    held += len(word)
                if held > HELD:
                    yield from flush()
                    held = 0
        yield from flush()

    rows = docs.select("lang", "text").mapInArrow(count, "lang string, before long, word long, n long")
    return rows.groupBy("lang", "before", "word").agg(F.sum("n").alias("n"))


def discounts(spread: DataFrame) -> DataFrame:
    """``lang, kinds, d1, d2, d3`` of ``lang, kinds`` and the counts of counts ``c1`` to ``c4``; one row for each language."""
    y = F.when(F.col("c1") + 2 * F.col("c2") > 0, F.col("c1") / (F.col("c1") + 2 * F.col("c2"))).otherwise(0.5)

    def discount(k: int) -> Column:
        up, here = F.col(f"c{k + 1}"), F.col(f"c{k}")
        d = F.when(here > 0, k - (k + 1) * y * up / here).otherwise(F.lit(0.5))
        return F.greatest(F.least(d, F.lit(float(k))), F.lit(0.05)).alias(f"d{k}")

    return spread.select("lang", "kinds", *[discount(k) for k in (1, 2, 3)])


def model(pairs: DataFrame) -> DataFrame:
    """``before, word, log_p``: interpolated modified Kneser-Ney of every counted pair.

    The model by joins of whole tables, against which the blocks are held.

    p(w | v) = max(n(vw) - D, 0) / n(v.) + (D1 N1 + D2 N2 + D3 N3+)(v.) / n(v.) * N(.w) / N(..)
    with the discounts D1, D2, D3+ of the language from its counts of counts.
    """
    of = lambda k: F.sum((F.col("n") == k).cast("long"))
    spread = pairs.groupBy("lang").agg(*[of(k).alias(f"c{k}") for k in range(1, 5)], F.count(F.lit(1)).alias("kinds"))
    spread = discounts(spread)
    before = pairs.groupBy("lang", "before").agg(
        F.sum("n").alias("total"), of(1).alias("n1"), of(2).alias("n2"),
        F.sum((F.col("n") > 2).cast("long")).alias("n3"),
    )
    after = pairs.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("kinds_before"))
    # words carry their language, so the hash alone is the key
    joined = pairs.join(before.drop("lang"), "before").join(after.drop("lang"), "word")
    joined = joined.join(F.broadcast(spread.withColumnRenamed("lang", "l")), F.col("lang").eqNullSafe(F.col("l")))
    d = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
    left = F.col("d1") * F.col("n1") + F.col("d2") * F.col("n2") + F.col("d3") * F.col("n3")
    p = F.greatest(F.col("n") - d, F.lit(0.0)) / F.col("total")
    p = p + left / F.col("total") * F.col("kinds_before") / F.col("kinds")
    return joined.select("before", "word", F.log(p).alias("log_p"))


def packed(x: np.ndarray) -> bytes:
    """Numbers as compressed planes of their bytes."""
    planes = np.ascontiguousarray(x.view(np.uint8).reshape(-1, x.itemsize).T)
    return len(x).to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpacked(data: pa.Scalar, kind: type) -> np.ndarray:
    data, size = data.as_buffer(), np.dtype(kind).itemsize
    n = int.from_bytes(data[:8].to_pybytes(), "little")
    planes = np.frombuffer(pa.decompress(data[8:], n * size, codec="zstd"), np.uint8).reshape(size, n)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def packed_hashes(h: np.ndarray) -> bytes:
    """Hashes as differences, which are short where they ascend."""
    return packed(np.diff(h, prepend=np.uint64(0)))


def unpacked_hashes(data: pa.Scalar) -> np.ndarray:
    return np.cumsum(unpacked(data, np.uint64), dtype=np.uint64)


def by_shard(h: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Shards, ranges of sorted hashes, and where they begin."""
    to = ((h >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)
    starts = np.flatnonzero(np.r_[True, to[1:] != to[:-1]][:len(to)])
    return to[starts].astype(np.int32), starts


# a block's first row holds the words of its documents
WORDS = "tokens binary, vocabulary binary, lengths binary, lang_of binary, langs array<string>, n_kinds long"


class Block:
    """Words of the documents with any: numbers into the hashes, each document behind the start of its language."""

    def __init__(self, row: pa.Table):
        self.ids, self.lengths = unpacked(row["tokens"][0], np.uint32), unpacked(row["lengths"][0], np.int64)
        self.hashes = unpacked_hashes(row["vocabulary"][0])
        starts = np.cumsum(self.lengths + 1) - self.lengths - 1
        inside = np.ones(len(self.ids), bool)
        inside[starts] = False
        self.first = np.cumsum(self.lengths) - self.lengths
        # the pairs of all documents, in order
        self.before, self.word = self.ids[np.flatnonzero(inside) - 1], self.ids[inside]
        part = (self.hashes >> np.uint64(11)).astype(np.uint8)
        self.slices = (part[self.before] + part[self.word]) % np.uint8(SLICES)

    @staticmethod
    def columns(texts: list[np.ndarray], langs: list[str | None]) -> list[tuple[object, pa.DataType]]:
        """WORDS of texts (hashes with the start)."""
        found, which, n = np.unique(np.concatenate(texts), return_inverse=True, return_counts=True)
        # equally frequent words by hash
        order = np.argsort(-n, kind="stable")
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order), dtype=np.uint32)
        names = list(dict.fromkeys(langs))
        number = {x: k for k, x in enumerate(names)}
        lengths = np.array([len(x) - 1 for x in texts], np.int64)
        return [
            (packed(rank[which]), pa.binary()), (packed_hashes(found[order]), pa.binary()), (packed(lengths), pa.binary()),
            (packed(np.array([number[x] for x in langs], np.int64)), pa.binary()), (names, pa.list_(pa.string())),
            (len(found), pa.int64()),
        ]

    def per_word(self, values: np.ndarray) -> np.ndarray:
        """Values of documents at their words; a word is of one language."""
        out = np.zeros(len(self.hashes), values.dtype)
        out[self.ids] = np.repeat(values, self.lengths + 1)
        return out

    def pairs(self, part: int | None = None) -> tuple[np.ndarray, ...]:
        """Distinct pairs of a slice, or of all by slice, in the order of their hashes: words before, words, counts and hashes.

        Last, for all slices: at which of them each pair of the texts is.
        """
        inside = slice(None) if part is None else self.slices == part
        key = self.before[inside].astype(np.int64) << 32 | self.word[inside]
        if part is None:
            key, which, n = np.unique(key, return_inverse=True, return_counts=True)
        else:
            key, n = np.unique(key, return_counts=True)
        before, word = key >> 32, key & 0xFFFFFFFF
        h = pair_hash(self.hashes[before], self.hashes[word])
        if part is not None:
            order = np.argsort(h, kind="stable")
            return before[order], word[order], n[order], h[order]
        of = np.empty(len(key), np.uint8)
        of[which] = self.slices
        order = np.lexsort((h, of))
        place = np.empty(len(key), np.int64)
        place[order] = np.arange(len(key))
        return before[order], word[order], n[order], h[order], place[which]


def blocks(docs: DataFrame, block_words: int) -> DataFrame:
    """``block, at, doc_id, lang``, the base counts, and WORDS in one row of a block, of ``docs`` (``doc_id, lang, text``)."""
    read = docs.select("doc_id", "lang", "text")
    schema = StructType([
        *StructType.fromDDL("block long, at int"), *list(read.schema)[:2], *StructType.fromDDL(f"{COUNTS}, {WORDS}"),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        given: list[pa.RecordBatch] = []
        counted: list[tuple] = []
        texts: list[np.ndarray] = []
        langs: list[str | None] = []
        held = 0

        def flush() -> pa.RecordBatch:
            own = pa.Table.from_batches(given).combine_chunks()
            n = own.num_rows
            words = Block.columns(texts, langs) if texts else [(None, t) for _, t in Block.columns([np.zeros(1, np.uint64)], [None])]
            columns = [
                pa.array(np.full(n, number), pa.int64()), pa.array(np.arange(n), pa.int32()),
                *[c.chunk(0) for c in own.columns], *[pa.array(c, pa.int64()) for c in zip(*counted, strict=True)],
                *[pa.array([x] + [None] * (n - 1), t) for x, t in words],
            ]
            for kept in (given, counted, texts, langs):
                kept.clear()
            return pa.RecordBatch.from_arrays(columns, schema.names)

        for batch in batches:
            start, own = 0, batch.select(["doc_id", "lang"])
            for k, (text, lang) in enumerate(zip(batch.column("text"), batch.column("lang").to_pylist(), strict=True)):
                counts, words = measured(text.as_py())
                counted.append(counts)
                if len(words):
                    seed = language_seed(lang)
                    texts.append(np.concatenate([[seed], words ^ seed]))
                    langs.append(lang)
                    held += len(words)
                if held >= block_words:
                    given.append(own.slice(start, k + 1 - start))
                    yield flush()
                    start, held, number = k + 1, 0, number + 1
            if start < batch.num_rows:
                given.append(own.slice(start))
        if given:
            yield flush()

    return read.mapInArrow(run, schema)


def answers(part: pa.Table, name: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the hashes in all rows of a shard: their order, and of these the groups of equal ones and where they begin."""
    h = np.concatenate([unpacked_hashes(x) for x in part[name]])
    order = np.argsort(h, kind="stable")
    h = h[order]
    new = np.r_[True, h[1:] != h[:-1]]
    return order, np.cumsum(new) - 1, np.flatnonzero(new)


ANSWER = "block long, slice int, shard int, answer binary"
# the slice of answers about words
OF_WORDS = SLICES


def answered(part: pa.Table, number: int, sizes: list[int], values: np.ndarray) -> pa.Table:
    """ANSWER to each row of a shard; ``values``: what stands at its hashes, row after row."""
    ends = np.cumsum(sizes)[:-1]
    return pa.table({
        "block": part["block"], "slice": pa.array(np.full(part.num_rows, number), pa.int32()), "shard": part["shard"],
        "answer": pa.array([packed(np.ascontiguousarray(x).ravel()) for x in np.split(values, ends, axis=-1)], pa.binary()),
    })


def pair_counts(words: DataFrame, part: int, shards: int) -> DataFrame:
    """ANSWER for the distinct pairs of a slice: twice the count in the corpus, and 1 more for the block that stands for it."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                _, _, n, h = Block(pa.Table.from_batches([batch.slice(row, 1)])).pairs(part)
                to, starts = by_shard(h, shards)
                yield pa.RecordBatch.from_arrays([
                    pa.array(to), pa.array([batch.column("block")[row].as_py()] * len(to), pa.int64()),
                    pa.array([packed_hashes(x) for x in np.split(h, starts[1:])][:len(to)], pa.binary()),
                    pa.array([packed(x) for x in np.split(n, starts[1:])][:len(to)], pa.binary()),
                ], ["shard", "block", "hashes", "counts"])

    def count(asked: pa.Table) -> pa.Table:
        order, group, starts = answers(asked, "hashes")
        parts = [unpacked(x, np.int64) for x in asked["counts"]]
        total = np.add.reduceat(np.concatenate(parts)[order], starts)
        out = np.empty(len(order), np.int64)
        out[order] = 2 * total[group]
        out[order[starts]] += 1
        return answered(asked, part, list(map(len, parts)), out)

    sent = words.mapInArrow(ask, "shard int, block long, hashes binary, counts binary")
    return sent.repartition(shuffle_partitions(words.sparkSession), "shard").groupBy("shard").applyInArrow(count, ANSWER)


def of_slices(found: pa.Table, words: bool) -> list[np.ndarray]:
    """The answers about words or about pairs, by slice and shard."""
    rows = found.filter(pc.equal(found["slice"], OF_WORDS) if words else pc.less(found["slice"], OF_WORDS))
    rows = rows.sort_by([("slice", "ascending"), ("shard", "ascending")])
    return [unpacked(x, np.int64) for x in rows["answer"]]


# of a word v: occurrences before a word, kinds of pairs vw of count 1, 2 and more, kinds of pairs uv
FACTS = 5


def word_facts(words: DataFrame, found: DataFrame, number: int, shards: int) -> DataFrame:
    """``shard, block, hashes, facts`` of the blocks' words in a slice of shards.

    Rows without a shard, in the first slice: ``lang``, counts of counts and ``kinds``.
    """
    schema = "shard int, block long, hashes binary, facts binary, lang string, c1 long, c2 long, c3 long, c4 long, kinds long"
    kept = pa.schema([
        ("shard", pa.int32()), ("block", pa.int64()), ("hashes", pa.binary()), ("facts", pa.binary()), ("lang", pa.string()),
        *[(c, pa.int64()) for c in ("c1", "c2", "c3", "c4", "kinds")],
    ])

    def ask(row: pa.Table, found: pa.Table) -> pa.Table:
        block = Block(row)
        # slice by slice no pair of the texts is looked up again
        before, word, n, _ = map(np.concatenate, zip(*map(block.pairs, range(SLICES)), strict=True))
        answer = np.concatenate(of_slices(found, words=False))
        total, own = answer >> 1, (answer & 1).astype(bool)
        size = len(block.hashes)
        facts = np.zeros((FACTS, size), np.int64)
        facts[0] = np.bincount(before, n, size)
        for k, of in enumerate((total == 1, total == 2, total > 2)):
            facts[k + 1] = np.bincount(before[own & of], minlength=size)
        facts[4] = np.bincount(word[own], minlength=size)
        order = np.argsort(block.hashes)
        h, facts = block.hashes[order], facts[:, order]
        to, starts = by_shard(h, shards)
        split = zip(to.tolist(), *[np.split(x, starts[1:], axis=-1) for x in (h, facts)], strict=True)
        name = row["block"][0].as_py()
        rows = [
            (shard, name, packed_hashes(x), packed(np.ascontiguousarray(y).ravel()), None, *[None] * 5)
            for shard, x, y in split if shard % WORD_SLICES == number
        ]
        if number == 0:
            langs = row["langs"][0].as_py()
            lang = block.per_word(unpacked(row["lang_of"][0], np.int64))[before]
            kinds = [np.bincount(lang[own & of], minlength=len(langs)).tolist() for of in (*[total == k for k in range(1, 5)], total > 0)]
            rows += [(None, name, None, None, *x) for x in zip(langs, *kinds, strict=True)]
        columns = zip(*rows, strict=True) if rows else [[]] * len(kept)
        return pa.table([pa.array(x, t) for x, t in zip(columns, kept.types, strict=True)], schema=kept)

    return cogrouped(words, found, ask, schema)


def cogrouped(rows: DataFrame, found: DataFrame, run, schema) -> DataFrame:
    """``run`` over the rows of each block and the answers to it."""
    n = shuffle_partitions(rows.sparkSession)
    rows, found = (x.repartition(n, "block").groupBy("block") for x in (rows, found))
    return rows.cogroup(found).applyInArrow(run, schema)


def word_sums(asked: DataFrame) -> DataFrame:
    """ANSWER with the facts of the blocks' words, over all blocks."""

    def add(asked: pa.Table) -> pa.Table:
        order, group, starts = answers(asked, "hashes")
        parts = [unpacked(x, np.int64).reshape(FACTS, -1) for x in asked["facts"]]
        total = np.add.reduceat(np.concatenate(parts, axis=1)[:, order], starts, axis=1)
        out = np.empty((FACTS, len(order)), np.int64)
        out[:, order] = total[:, group]
        return answered(asked, OF_WORDS, [p.shape[1] for p in parts], out)

    sent = asked.select("shard", "block", "hashes", "facts")
    return sent.repartition(shuffle_partitions(asked.sparkSession), "shard").groupBy("shard").applyInArrow(add, ANSWER)


def scored(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``doc_id, lang``, the base counts and ``log_ppl`` of the blocks' documents; ``rows`` with the discounts."""
    names = ["doc_id", "lang", *[c.split()[0] for c in COUNTS.split(", ")]]
    schema = StructType([*[rows.schema[c] for c in names], *StructType.fromDDL("log_ppl double")])

    def score(docs: pa.Table, found: pa.Table) -> pa.Table:
        docs = docs.sort_by("at")
        log_ppl = np.full(docs.num_rows, np.nan)
        if docs["tokens"][0].is_valid:
            block = Block(docs)
            has = docs["n_words"].to_numpy() > 0
            before, word, _, _, which = block.pairs()
            n = np.concatenate(of_slices(found, words=False)) >> 1
            facts = np.empty((FACTS, len(block.hashes)), np.int64)
            facts[:, np.argsort(block.hashes)] = np.concatenate([x.reshape(FACTS, -1) for x in of_slices(found, words=True)], axis=1)
            total, n1, n2, n3, kinds_before = facts
            d1, d2, d3, kinds = (block.per_word(docs[c].to_numpy()[has]) for c in ("d1", "d2", "d3", "kinds"))
            left = d1 * n1 + d2 * n2 + d3 * n3
            d = np.where(n == 1, d1[before], np.where(n == 2, d2[before], d3[before]))
            p = np.maximum(n - d, 0) / total[before]
            p += left[before] / total[before] * kinds_before[word] / kinds[before]
            log_ppl[has] = -np.add.reduceat(np.log(p)[which], block.first) / block.lengths
        return docs.select(names).append_column("log_ppl", pa.array(log_ppl, pa.float64(), mask=np.isnan(log_ppl)))

    return cogrouped(rows, found, score, schema)


def perplexity(docs: DataFrame, block_words: int = BLOCK_WORDS, shard: int = SHARD) -> DataFrame:
    """``doc_id, lang``, the base counts and ``log_ppl`` (null without words) for every row of ``docs`` (``doc_id, lang, text``)."""
    steps = Scratch(docs.sparkSession)
    held = steps.write(blocks(docs, block_words), "blocks")
    words = held.where("tokens is not null").select("block", *[f.name for f in StructType.fromDDL(WORDS)][:-1])
    total, kinds = held.agg(F.coalesce(F.sum("n_words"), F.lit(0)), F.coalesce(F.sum("n_kinds"), F.lit(0))).first()

    def part(table: DataFrame, k: int) -> DataFrame:
        return table.where(F.pmod(F.xxhash64("block"), F.lit(SLICES)) == k)

    def union(tables: list[DataFrame]) -> DataFrame:
        return reduce(DataFrame.unionByName, tables)

    shards = int(total // (SLICES * shard)) + 1
    of_pairs = [steps.write(pair_counts(words, k, shards), "pair-counts") for k in range(SLICES)]
    # an entry of a word has several numbers
    shards = int(kinds // max(shard // 4, 1)) + 1
    of_words, spread = [], None
    for number in range(min(shards, WORD_SLICES)):
        asked = [steps.write(word_facts(part(words, k), part(union(of_pairs), k), number, shards), "word-facts") for k in range(SLICES)]
        sent = union(asked)
        if spread is None:
            own = sent.where("shard is null").groupBy("lang").agg(*[F.sum(c).alias(c) for c in ("c1", "c2", "c3", "c4", "kinds")])
            spread = steps.write(discounts(own), "discounts").withColumnRenamed("lang", "l")
        # a slice is summed in two runs
        of_words += [
            steps.write(word_sums(sent.where(f"shard is not null and shard div {WORD_SLICES} % 2 = {k}")), "word-sums")
            for k in range(min((shards - 1) // WORD_SLICES + 1, 2))
        ]
        steps.drop(*asked)
    found = union([*of_pairs, *of_words])
    # one row for each language
    rows = held.join(F.broadcast(spread), F.col("lang").eqNullSafe(F.col("l")), "left").drop("l")
    done = [steps.write(scored(part(rows, k), part(found, k)), "perplexity") for k in range(SLICES)]
    steps.drop(held, *of_pairs, *of_words)
    return union(done)


def judge(docs: DataFrame, spread: float = SPREAD, block_words: int = BLOCK_WORDS, shard: int = SHARD) -> DataFrame:
    """``doc_id``, the base counts, ``base_failed, log_ppl, kept`` for every row of ``docs`` (``doc_id, lang, text``)."""
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    names = ["doc_id", "lang", *[c.split()[0] for c in COUNTS.split(", ")]]
    scored = perplexity(docs, block_words, shard).select(*names, failed.alias("base_failed"), "log_ppl")
    # one row for each language
    bands = scored.where("not base_failed").groupBy(F.col("lang").alias("l")).agg(
        F.percentile_approx("log_ppl", [0.25, 0.75], 10_000).alias("q")
    )
    widen = spread * (F.col("q")[1] - F.col("q")[0])
    bands = bands.select("l", (F.col("q")[0] - widen).alias("low"), (F.col("q")[1] + widen).alias("high"))
    judged = scored.join(F.broadcast(bands), F.col("lang").eqNullSafe(F.col("l")), "left")
    kept = ~F.col("base_failed") & F.coalesce(F.col("log_ppl").between(F.col("low"), F.col("high")), F.lit(False))
    return judged.withColumn("kept", kept).drop("l", "low", "high", "lang")
