"""Line dedup by an exact set-similarity join on parts of the word sets, then Jaccard.

A line is the set of its words (runs of anything but ASCII white space, A-Z
lower-cased). Equal sets are one class, which stands at its first line. Two sets of
Jaccard similarity ``threshold`` differ in few words, ``most_different`` of their sizes.
So words are dealt by hash into more parts than that (``parts``; sets of an octave of
sizes have the same number, and a set that may resemble one of the next octave is dealt
there too): of m parts all but d are equal. Parts are ordered by the rarity of the words in
them, as counted over all lines in a table of ``COUNTERS`` counters (any order that is the
same for all lines gives whole results), and of a set its d + 1 rarest are kept as
signatures: similar sets share one. Several words of a kind together are rare however long
the corpus is, so most signatures stand alone and go at once; the others are lists.
A line is removed if an earlier line of the corpus, removed or not, is similar enough.
Lists of more than ``CELL`` classes are dealt out as cells of two blocks. Classes have a
sketch of ``SKETCH`` bits of the set, by which pairs go that share little else; a class
first verifies its ``FIRST`` nearest candidates in its own block of a list, and
only classes that all of them fail are compared further and with other blocks, so a
group of near copies is not all its pairs.

Order: documents by doc_id (null last), then by text, then lines as they stand.
Edge cases: rows of equal doc_id and text are the same document and fare alike;
lines without words stay; a null text stays null, an empty one empty; a text that
loses all lines becomes empty; other columns pass through. Words are compared by
64-bit hashes, sets by one of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from mentionwise.llm.components import join_counted
from mentionwise.llm.memory import release, tidy
from mentionwise.llm.scratch import Scratch

COUNTERS = 1 << 20
# a list longer than this is dealt out as cells of two blocks; the size does not grow with the corpus
CELL = 8192
# candidates of a class in a cell that are verified before the rest
FIRST = 4
# postings a task compares at once, at least; a run is never split
HELD = 100_000
# bits of a set's sketch
SKETCH = 256
# slices of the counters, which are summed one by one
COUNTER_SLICES = 64
# signatures of a shard, about; and those a task holds before it passes them on
SHARD, SENT = 300_000, 500_000
# in lists up to this length a class stays only if a short sketch and size fit another one's
CLOSE = 64
# sizes from here on are not sent
NO_SIZE = 255
# lines are split and hashed together up to so many characters; a longer line goes alone
SLICE = 500_000
# a counted side of at most so many classes of a few numbers is broadcast
BROADCAST_ROWS = 1_000_000
AT = ["doc_id", "text_hash", "line"]


# bytes as random numbers, A-Z as a-z; and which of them end a word
BYTES = np.array([xxhash.xxh64_intdigest(bytes([b]).lower()) for b in range(256)], np.uint64)
SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
ODD = np.uint64(0x9E3779B97F4A7C15)
# a longer word is hashed by itself
LONG_WORD = 64


def hash_words(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64-bit hashes of the lower-cased words that stand in ``data``, all words at once, byte by byte."""
    by = np.argsort(np.minimum(lengths, LONG_WORD + 1).astype(np.uint8), kind="stable")[::-1]
    at, size = starts[by], lengths[by]
    # words by falling length: those that have a byte k come first
    reach = np.searchsorted(-size, -np.arange(1, LONG_WORD + 1), side="right")
    h = size.astype(np.uint64) * ODD
    for k, n in enumerate(reach):
        if not n:
            break
        x = (h[:n] ^ BYTES[data[at[:n] + k]]) * ODD
        h[:n] = x ^ (x >> np.uint64(29))
    for i in range(int(np.count_nonzero(size > LONG_WORD))):
        h[i] = xxhash.xxh64_intdigest(data[at[i]:at[i] + size[i]].tobytes().lower())
    out = np.empty_like(h)
    out[by] = h
    return out


def word_sets(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct words of each line: numbers of lines, and hashes, sorted by both."""
    data = np.frombuffer("\n".join(lines).encode(), np.uint8)
    inside = np.r_[False, ~SPACE[data], False]
    starts, ends = np.flatnonzero(inside[1:] & ~inside[:-1]), np.flatnonzero(inside[:-1] & ~inside[1:])
    row = np.searchsorted(np.flatnonzero(data == 0x0A), starts)
    found = hash_words(data, starts, ends - starts)
    by = np.argsort(found)
    by = by[by_line(row[by])]
    row, found = row[by], found[by]
    new = np.r_[True, (row[1:] != row[:-1]) | (found[1:] != found[:-1])][:len(row)]
    return row[new], found[new]


def by_line(row: np.ndarray) -> np.ndarray:
    """The order that sorts numbers of lines, equal ones as they stand; short numbers sort without comparisons."""
    short = len(row) == 0 or row.max() < 1 << 16
    return np.argsort(row.astype(np.uint16) if short else row, kind="stable")


def slices(lines: list[str]) -> Iterator[tuple[int, list[str]]]:
    """``lines`` in parts of at most SLICE characters, each with its start."""
    start = held = 0
    for k, line in enumerate(lines):
        if held and held + len(line) > SLICE:
            yield start, lines[start:k]
            start, held = k, 0
        held += len(line)
    if start < len(lines):
        yield start, lines[start:]


def small(df: DataFrame) -> DataFrame:
    """``df``, broadcast if a count puts it under the bound."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def parts_of(texts: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[int], list[int], list[str]]]:
    """Lines of texts, about SLICE characters at once: the batch, and of each line its row, number and words."""
    for batch in texts:
        row, number, lines, held = [], [], [], 0
        for r, text in enumerate(batch.column("text")):
            of_text = (text.as_py() or "").split("\n")
            row += [r] * len(of_text)
            number += range(len(of_text))
            lines += of_text
            held += sum(map(len, of_text))
            if held > SLICE:
                yield batch, row, number, lines
                row, number, lines, held = [], [], [], 0
        if lines:
            yield batch, row, number, lines


def classes_of(lines: list[str]) -> tuple[np.ndarray, ...]:
    """``used, class, size`` of the lines with words, and their words: numbers among ``used``, and hashes."""
    of, words = word_sets(lines)
    edges = np.searchsorted(of, np.arange(len(lines) + 1))
    size = np.diff(edges)
    used = np.flatnonzero(size)
    cls = [xxhash.xxh64_intdigest(words[edges[k]:edges[k + 1]].tobytes()) for k in used]
    return used, np.array(cls, np.uint64), size[used], np.repeat(np.arange(len(used)), size[used]), words


def sketches(n: int, of: np.ndarray, words: np.ndarray) -> np.ndarray:
    """SKETCH bits of each of ``n`` sets, as rows of 64-bit numbers."""
    bit = (words >> np.uint64(24)) % np.uint64(SKETCH)
    out = np.zeros(n * (SKETCH // 64), np.uint64)
    np.bitwise_or.at(out, of * (SKETCH // 64) + (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63)))
    return out.reshape(n, SKETCH // 64)


def cut(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, line, class, size, sketch`` of every line with words.

    Rows without a line hold a task's counts of words: ``slice``, and its used ``counters`` and their ``counts``.
    """
    kind = docs.schema["doc_id"].dataType
    fields = [*AT, "class", "size", "sketch", "slice", "counters", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, held, n_held, like = np.zeros(COUNTERS, np.int64), [], 0, None
        for batch, row, number, lines in parts_of(batches):
            like = batch.schema.field("doc_id").type
            used, cls, size, of, words = classes_of(lines)
            held.append((words & np.uint64(COUNTERS - 1)).astype(np.int64))
            n_held += len(words)
            if n_held > COUNTERS:
                sums += np.bincount(np.concatenate(held), minlength=COUNTERS)
                held, n_held = [], 0
            n = len(used)
            taken = batch.select(["doc_id", "text_hash"]).take(pa.array(np.array(row, np.int64)[used]))
            bits = sketches(n, of, words)
            at = pa.array(np.arange(n + 1, dtype=np.int32) * bits.itemsize * bits.shape[1])
            sketch = pa.Array.from_buffers(pa.binary(), n, [None, at.buffers()[1], pa.py_buffer(bits.tobytes())])
            yield pa.RecordBatch.from_arrays(
                [*taken.columns, pa.array(np.array(number, np.int32)[used]), pa.array(cls.view(np.int64)),
                 pa.array(size.astype(np.int32)), sketch, pa.nulls(n, pa.int32()), *[pa.nulls(n, pa.binary())] * 2], fields,
            )
        if like is None:
            return
        if held:
            sums += np.bincount(np.concatenate(held), minlength=COUNTERS)
        for k, part in enumerate(np.split(sums, COUNTER_SLICES)):
            found = np.flatnonzero(part)
            own = [pa.nulls(1, t) for t in (like, pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary())]
            counts = [pa.array([x.tobytes()], pa.binary()) for x in (found.astype(np.uint16), part[found].astype(np.uint32))]
            yield pa.RecordBatch.from_arrays([*own, pa.array([k], pa.int32()), *counts], fields)

    read = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return read.mapInArrow(
        tidy(run), f"doc_id {kind.simpleString()}, text_hash long, line int, class long, size int, sketch binary, "
        "slice int, counters binary, counts binary",
    )


def order(prefix: str = ""):
    """Place in the corpus: doc_id (null last), text, line."""
    doc_id, text_hash, line = (F.col(prefix + c) for c in AT)
    return F.struct(doc_id.isNull().alias("unnamed"), doc_id.alias("doc_id"), text_hash.alias("text_hash"), line.alias("line"))


def rarity(counted: DataFrame) -> np.ndarray:
    """The level of the word occurrences on each counter; COUNTERS numbers, whatever the corpus."""

    def add(part: pa.Table) -> pa.Table:
        sums = np.zeros(COUNTERS // COUNTER_SLICES, np.int64)
        for at, n in zip(part["counters"], part["counts"], strict=True):
            sums[np.frombuffer(at.as_buffer(), np.uint16)] += np.frombuffer(n.as_buffer(), np.uint32)
        return pa.table({"slice": part["slice"][:1], "levels": pa.array([levels(sums).tobytes()], pa.binary())})

    rows = counted.select("slice", "counters", "counts").groupBy("slice").applyInArrow(add, "slice int, levels binary")
    found = np.zeros((COUNTER_SLICES, COUNTERS // COUNTER_SLICES), np.uint16)
    for row in rows.collect():
        found[row["slice"]] = np.frombuffer(row["levels"], np.uint16)
    return found.ravel()


def levels(counts: np.ndarray) -> np.ndarray:
    """Counts on a scale of 16 bits: 0 up to one, rising above; close large counts may be one level."""
    return np.minimum(np.log2(np.maximum(counts, 1)) * 1500, 0xFFFF).astype(np.uint16)


def least_overlap(a, b, threshold: float):
    """The overlap that sets of these sizes need."""
    return np.ceil(threshold / (1 + threshold) * (a + b) - 1e-9)


def octave(size: np.ndarray) -> np.ndarray:
    """0 for sizes up to 7, then one more for each doubling."""
    return np.maximum(np.frexp(size)[1].astype(np.int64) - 3, 0)


def most_different(a, b, threshold: float):
    """In how many words similar sets of these sizes may differ, of both together."""
    return np.floor((1 - threshold) / (1 + threshold) * (a + b) + 1e-9).astype(np.int64)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * ODD
    return x ^ (x >> np.uint64(29))


def signatures(size: np.ndarray, of: np.ndarray, words: np.ndarray, rare: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """The sets' numbers and signatures; ``words`` of the sets ``of``, sorted by both."""
    own, found = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
    largest = np.floor(size / threshold + 1e-9)
    level = octave(size)
    chosen = np.ones(len(size), bool)
    while chosen.any():
        last = 2 ** (level + 3) - 1
        parts = np.ceil(1.2 * (most_different(last, last, threshold) + 1)).astype(np.uint64)
        keep = most_different(size, np.minimum(last, largest), threshold) + 1
        inside = chosen[of]
        r, w = of[inside], words[inside]
        # in the order of the hashes, so equal parts are next to each other
        part = ((w >> np.uint64(32)) * parts[r]) >> np.uint64(32)
        starts = np.flatnonzero(np.r_[True, (r[1:] != r[:-1]) | (part[1:] != part[:-1])])
        total = np.add.reduceat(mixed(w), starts)
        rarest = np.add.reduceat(0x10000 - rare[w & np.uint64(COUNTERS - 1)].astype(np.int64), starts)
        r, part = r[starts], part[starts]
        by = np.argsort(-rarest, kind="stable")
        by = by[by_line(r[by])]
        r, part, total = r[by], part[by], total[by]
        n = np.bincount(r, minlength=len(size))
        place = np.arange(len(r)) - (np.cumsum(n) - n)[r]
        used = place < keep[r]
        # few sets have fewer parts with words than they keep: empty ones come last, the first of them first
        lacking = np.flatnonzero(chosen & (n < keep))
        empty = [
            np.setdiff1d(np.arange(min(int(parts[k]), int(keep[k] + n[k])), dtype=np.uint64), part[r == k])[:keep[k] - n[k]]
            for k in lacking
        ]
        r = np.concatenate([r[used], np.repeat(lacking, [len(x) for x in empty]).astype(np.int64)])
        part, total = np.concatenate([part[used], *empty]), np.r_[total[used], np.zeros(sum(map(len, empty)), np.uint64)]
        own.append(r)
        found.append(mixed(total + part * BYTES[1] + (level[r].astype(np.uint64) + np.uint64(1)) * BYTES[2]))
        # a larger set of a later octave meets it there
        level = level + 1
        chosen = chosen & (largest >= 2 ** (level + 2))
    return np.concatenate(own), np.concatenate(found)


def near_another(sig: np.ndarray, size: np.ndarray, sketch: np.ndarray, threshold: float) -> np.ndarray:
    """Which of the classes, sorted by ``sig``, may resemble another one of their list; all of a list over CLOSE."""
    starts = np.flatnonzero(np.r_[True, sig[1:] != sig[:-1]][:len(sig)])
    lengths = np.diff(np.r_[starts, len(sig)])
    first = np.repeat(starts, lengths)
    near = np.repeat(lengths > CLOSE, lengths)
    size = size.astype(np.int64)
    at, step = np.flatnonzero(~near), 1
    while len(at := at[at - step >= first[at]]):
        a, b = at, at - step
        need = least_overlap(size[a], size[b], threshold)
        fits = size[a] - np.bitwise_count(sketch[a] & ~sketch[b]) >= need
        fits &= size[b] - np.bitwise_count(sketch[b] & ~sketch[a]) >= need
        fits |= (size[a] == NO_SIZE) | (size[b] == NO_SIZE)
        near[a[fits]] = near[b[fits]] = True
        step += 1
    return near


def postings(docs: DataFrame, rare: np.ndarray, threshold: float, shards: int) -> DataFrame:
    """``sig, class`` of the signatures that several classes have which may be similar; ``n``: how many have this one."""
    # within a shard 32 bits of a signature do: lists that fall together only give more candidates
    kinds = {"sigs": np.uint32, "classes": np.int64, "sizes": np.uint8, "sketches": np.uint64}

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def flush() -> pa.RecordBatch:
            sig, *rest = (np.concatenate(x) for x in zip(*held, strict=True))
            to = (sig >> np.uint64(32)) % np.uint64(shards)
            by = np.argsort(to, kind="stable")
            to = to[by]
            starts = np.flatnonzero(np.r_[True, to[1:] != to[:-1]])
            packed = [
                pa.array([p.tobytes() for p in np.split(x[by].astype(k), starts[1:])], pa.binary())
                for x, k in zip((sig & np.uint64(0xFFFFFFFF), *rest), kinds.values(), strict=True)
            ]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(to[starts].astype(np.int32)), *packed], ["shard", *kinds])

        for _, _, _, lines in parts_of(batches):
            _, cls, size, of, words = classes_of(list(dict.fromkeys(lines)))
            if len(cls):
                own, sig = signatures(size, of, words, rare, threshold)
                short = np.bitwise_or.reduceat(np.uint64(1) << (words >> np.uint64(58)), np.cumsum(size) - size)
                held.append((sig, cls.view(np.int64)[own], np.minimum(size, NO_SIZE)[own], short[own]))
            if sum(len(x[0]) for x in held) > SENT:
                yield flush()
        if held:
            yield flush()

    def several(sig: np.ndarray) -> np.ndarray:
        same = np.r_[False, sig[1:] == sig[:-1], False]
        return (same[1:] | same[:-1])[:len(sig)]

    def shared(part: pa.Table) -> pa.Table:
        sig, *rest = (np.frombuffer(b"".join(part[c].to_pylist()), k) for c, k in kinds.items())
        by = np.argsort(sig)
        # most signatures stand alone
        by = by[several(sig[by])]
        by = by[np.lexsort((rest[0][by], sig[by]))]
        s, cls = sig[by], rest[0][by]
        by = by[np.r_[True, (s[1:] != s[:-1]) | (cls[1:] != cls[:-1])][:len(by)]]
        by = by[several(sig[by])]
        sig, cls, size, sketch = (x[by] for x in (sig, *rest))
        near = near_another(sig, size, sketch, threshold)
        whole = (np.int64(part["shard"][0].as_py()) << np.int64(32)) | sig[near].astype(np.int64)
        n = np.bincount(found := np.cumsum(np.r_[True, sig[1:] != sig[:-1]][:len(sig)]))[found].astype(np.int32)
        out = pa.table({"sig": pa.array(whole), "class": pa.array(cls[near]), "n": pa.array(n[near])})
        release()
        return out

    sent = docs.select("text").mapInArrow(tidy(send), "shard int, sigs binary, classes binary, sizes binary, sketches binary")
    return sent.groupBy("shard").applyInArrow(shared, "sig long, class long, n int")


def cells(index: DataFrame, whole: bool) -> DataFrame:
    """Postings with ``i, j, block``: lists of more than CELL as all pairs of blocks, the rest as one cell.

    Not ``whole``: the blocks of a long list by themselves, so that a posting stands in one cell only.
    """
    blocks = F.ceil(F.col("n") / CELL)
    dealt = index.withColumn("block", F.pmod(F.xxhash64("class"), blocks).cast("int"))
    if not whole:
        return dealt.drop("n").select("*", F.col("block").alias("i"), F.col("block").alias("j"))
    other = F.explode(F.sequence(F.lit(0), blocks.cast("int") - 1))
    dealt = dealt.withColumn("other", other).drop("n")
    return dealt.select("*", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")).drop("other")


def earlier_candidates(run, size, sketch, block, asked, threshold: float, skip: int, most: int | None):
    """Pairs (``asked`` row, earlier row) that may be similar, and the rows with more than ``most`` left.

    Rows stand in runs, in corpus order within each; all runs are compared at once, at
    distance 1, 2, ... The first ``skip`` candidates of a row are passed over, not across two blocks.
    """
    starts = np.flatnonzero(np.r_[True, run[1:] != run[:-1]])
    lengths = np.diff(np.r_[starts, len(run)])
    first = np.repeat(starts, lengths)
    # a run of one block is compared whole; in one of two blocks only across
    across = np.repeat(np.minimum.reduceat(block, starts) != np.maximum.reduceat(block, starts), lengths)
    skipped = np.where(across, 0, skip)
    seen = np.zeros(len(run), np.int64)
    rows, others, cut_off = ([np.empty(0, np.int64)] for _ in range(3))
    at, step = np.flatnonzero(asked), 1
    while len(at := at[at - step >= first[at]]):
        a, b = at, at - step
        need = least_overlap(size[a], size[b], threshold)
        maybe = np.minimum(size[a], size[b]) >= need
        maybe &= ~across[a] | (block[a] != block[b])
        a, b, need = a[maybe], b[maybe], need[maybe]
        fits = size[a] - np.bitwise_count(sketch[a] & ~sketch[b]).sum(axis=1, dtype=np.int64) >= need
        fits &= size[b] - np.bitwise_count(sketch[b] & ~sketch[a]).sum(axis=1, dtype=np.int64) >= need
        a, b = a[fits], b[fits]
        seen[a] += 1
        taken = seen[a] > skipped[a]
        if most is not None:
            over = seen[a] > skipped[a] + most
            cut_off.append(a[over])
            taken &= ~over
            at = at[seen[at] <= skipped[at] + most]
        rows.append(a[taken])
        others.append(b[taken])
        step += 1
    return np.concatenate(rows), np.concatenate(others), np.concatenate(cut_off)


def candidates(index: DataFrame, threshold: float, skip: int, most: int | None, whole: bool) -> DataFrame:
    """Classes ``a``, open, and an earlier ``b``; ``more`` (b null): ``a`` has further ones."""
    key = ["sig", "i", "j"]
    ordered = cells(index, whole).repartition(*key).sortWithinPartitions(*key, order())

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def runs(table: pa.Table) -> np.ndarray:
            k = [table[c].to_numpy() for c in key]
            return np.cumsum(np.r_[True, np.any([c[1:] != c[:-1] for c in k], axis=0)])

        def flush(table: pa.Table) -> Iterator[pa.RecordBatch]:
            if len(table) < 2:
                return
            size, block = (table[c].to_numpy() for c in ("size", "block"))
            sketch = np.frombuffer(b"".join(table["sketch"].to_pylist()), np.uint64).reshape(len(size), -1)
            rows, others, cut_off = earlier_candidates(
                runs(table), size, sketch, block, table["open"].to_numpy(), threshold, skip, most
            )
            if len(rows) or len(cut_off):
                cls = table["class"].to_numpy()
                a = pa.array(cls[np.concatenate([rows, cut_off])])
                open_ended = np.r_[np.zeros(len(others), bool), np.ones(len(cut_off), bool)]
                b = pa.array(np.r_[cls[others], np.zeros(len(cut_off), np.int64)], mask=open_ended)
                yield pa.RecordBatch.from_arrays([a, b, pa.array(open_ended)], ["a", "b", "more"])

        held: list[pa.RecordBatch] = []
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
            if sum(h.num_rows for h in held) < HELD:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            found = runs(table)
            # the last run may go on in the next batch
            end = int(np.searchsorted(found, found[-1]))
            yield from flush(table.slice(0, end))
            held = table.slice(end).combine_chunks().to_batches()
        if held:
            yield from flush(pa.Table.from_batches(held).combine_chunks())

    return ordered.mapInArrow(tidy(compare), "a long, b long, more boolean").distinct()


def line_texts(docs: DataFrame, places: DataFrame) -> DataFrame:
    """``class, words``: the line that stands at the place of each class."""
    read = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").alias("d")
    at = [F.col(f"d.{c}").eqNullSafe(F.col(f"p.{c}")) for c in AT[:2]]
    asked = places.groupBy(*AT[:2]).agg(F.collect_list(F.struct("class", "line")).alias("asked"))
    asked = F.broadcast(asked) if places.count() <= BROADCAST_ROWS else asked
    met = read.join(asked.alias("p"), at).select("asked", F.split("text", "\n").alias("lines"))
    found = F.transform("asked", lambda x: F.struct(x["class"].alias("class"), F.get("lines", x["line"]).alias("words")))
    words = met.select(F.inline(found))
    # rows of equal doc_id and text hold the line again
    return words.dropDuplicates(["class"])


def verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, threshold: float, scratch: Scratch) -> DataFrame:
    """``class``: ``a`` of the pairs whose lines have the similarity. Only lines of a pair are shuffled."""

    @arrow_udf("boolean")
    def similar(a: pa.Array, b: pa.Array) -> pa.Array:
        out = [np.empty(0, bool)]
        # a slice at a time of both sides
        for start, part in slices([f"{x}\n{y}" for x, y in zip(a.to_pylist(), b.to_pylist(), strict=True)]):
            sides = [x.split("\n") for x in part]
            (p, left), (q, right) = (word_sets([x[k] for x in sides]) for k in (0, 1))
            row, words = np.r_[p, q], np.r_[left, right]
            by = np.lexsort((words, row))
            row, words = row[by], words[by]
            both = (row[1:] == row[:-1]) & (words[1:] == words[:-1])
            shared = np.bincount(row[1:][both], minlength=len(part))
            sizes = (np.bincount(x, minlength=len(part)) for x in (p, q))
            out.append(shared >= least_overlap(*sizes, threshold))
        return pa.array(np.concatenate(out), pa.bool_())

    ends = scratch.write(pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct(), "line-ends")
    places = scratch.write(classes.select("class", *AT).join(small(ends), "class", "left_semi"), "line-ends")
    texts = scratch.write(line_texts(docs, places), "line-texts")
    met = pairs.join(texts.toDF("a", "p"), "a").join(texts.toDF("b", "q"), "b")
    return met.where(similar("p", "q")).select(F.col("a").alias("class")).distinct()


def matched(docs: DataFrame, lines: DataFrame, classes: DataFrame, threshold: float, scratch: Scratch) -> DataFrame:
    """``class``: those of which an earlier one is similar enough."""
    rare = rarity(lines.where("slice is not null"))
    n, words = lines.agg(F.count("line"), F.coalesce(F.sum("size"), F.lit(0))).first()
    # a set has about a signature for each four of its words, and some a second set of them
    met = scratch.write(postings(docs, rare, threshold, int((n + words / 3) // SHARD) + 1), "line-signatures")
    index = scratch.write(met.join(classes.drop("n"), "class"), "line-postings")
    scratch.drop(met)
    pairs = scratch.write(candidates(index.withColumn("open", F.lit(True)), threshold, 0, FIRST, False), "line-candidates")
    found = scratch.write(verified(pairs.where("not more").drop("more"), classes, docs, threshold, scratch), "line-matches")
    # a class of a dealt list has met its own block only
    dealt = index.where(F.col("n") > CELL).select("class")
    left = pairs.where("more").select(F.col("a").alias("class")).union(dealt).distinct().join(found, "class", "left_anti")
    left = scratch.write(left, "line-undecided")
    scratch.drop(pairs)
    if not left.isEmpty():
        # only lists with an undecided class are compared again
        lists = scratch.write(index.join(small(left), "class", "left_semi").select("sig").distinct(), "line-lists")
        again = index.join(small(lists), "sig", "left_semi")
        marked = again.join(small(left.withColumn("open", F.lit(True))), "class", "left")
        marked = marked.withColumn("open", F.coalesce("open", F.lit(False)))
        rest = scratch.write(candidates(marked, threshold, FIRST, None, True), "line-candidates")
        more = scratch.write(verified(rest.drop("more"), classes, docs, threshold, scratch), "line-matches")
        scratch.drop(rest, lists)
        found = found.union(more)
    scratch.drop(index)
    return found


def removed_lines(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """``doc_id, text_hash, removed``: the numbers of the lines that go, for documents with any."""
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be over 0 and at most 1")
    scratch = Scratch(docs.sparkSession)
    written = scratch.write(cut(docs), "line-places")
    lines = written.where("slice is null")
    first = F.min(F.struct(order().alias("at"), "size", "sketch")).alias("first")
    classes = lines.groupBy("class").agg(first, F.count(F.lit(1)).alias("n"))
    classes = classes.select("class", "n", *[f"first.at.{c}" for c in AT], "first.size", "first.sketch")
    classes = scratch.write(classes, "line-classes")
    later = scratch.write(matched(docs, written, classes, threshold, scratch).withColumn("later", F.lit(True)), "line-later")
    facts = classes.drop("size", "sketch").join(later, "class", "left")
    # a class of one line without a match removes nothing
    facts = facts.where("n > 1 or later").select("class", "n", order().alias("first"), "later")
    facts = scratch.write(facts, "line-facts")
    total = classes.agg(F.sum("n")).first()[0] or 0
    scratch.drop(classes)
    marked = join_counted(lines.select(*AT, "class"), facts, "class", "n", total)
    gone = marked.where(F.col("later") | (order() > F.col("first")))
    return gone.groupBy("doc_id", "text_hash").agg(F.collect_set("line").alias("removed"))


def remove_repeated(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """``docs`` with ``text`` rid of later similar lines, and ``__n_removed``."""
    gone = removed_lines(docs.select("doc_id", "text"), threshold).alias("g")
    read = docs.alias("d")
    same = F.col("d.doc_id").eqNullSafe(F.col("g.doc_id")) & (F.xxhash64("d.text") == F.col("g.text_hash"))
    kept = F.filter(
        F.transform(F.split("d.text", "\n"), lambda x, i: F.when(~F.array_contains("g.removed", i), x)),
        lambda x: x.isNotNull(),
    )
    # the side with the texts need not be sorted
    joined = read.join(gone.hint("shuffle_hash"), same, "left").withColumn("__n_removed", F.coalesce(F.size("g.removed"), F.lit(0)))
    text = F.when(F.col("g.removed").isNull(), F.col("d.text")).otherwise(F.array_join(kept, "\n"))
    columns = [text.alias(c) if c == "text" else F.col(f"d.`{c}`") for c in docs.columns]
    return joined.select(*columns, F.greatest("__n_removed", F.lit(0)).alias("__n_removed"))
