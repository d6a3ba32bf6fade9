"""SimHash near-duplicates by an inverted index over fingerprint bytes.

A fingerprint has eight bytes, each with its position. Fingerprints that differ in
at most k bits agree in at least 8 - k positional bytes, so at least half of that
many, rounded up, fall into one half of the fingerprint. The index therefore lists
fingerprints by every combination of that many positional bytes within a half; for
each pair met in a list the shared positional bytes are tallied, pairs below the
guaranteed minimum go, and the Hamming distance of the rest is verified. No link
is missed.

Equal fingerprints are one node, lists of more than a bounded share are dealt out
as cells of two blocks, and a cell returns only as many links as connect what it
found, so no group of copies becomes all its pairs.

Edge cases: a text without words (null, empty, blank) has fingerprint zero and is
linked like any other; fewer words than a shingle make one shingle; repeated rows
stay; a null doc_id is kept and takes part, but names a component only if all are
null (then null).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from mentionwise.llm.components import connected_components, join_counted
from mentionwise.llm.memory import tidy
from mentionwise.session import freeze

BYTES = 8
SEED = 42
# a list longer than this, and longer than one in HEAVY_LISTS postings, is dealt out as cells
CELL = 1024
HEAVY_LISTS = 50_000


def fingerprint_of(text: str | None, shingle: int) -> int:
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    width = min(shingle, len(words))
    shingles = map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False))
    hashed = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), np.uint64, len(words) - width + 1)
    ones = np.unpackbits(hashed.view(np.uint8).reshape(-1, BYTES), axis=1, bitorder="little").sum(0, np.int64)
    bits = np.packbits(2 * ones > len(hashed), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprint(text: Column, shingle: int = 3) -> Column:
    """64-bit SimHash of the word shingles of a text, as a (signed) long.

    Words are runs of anything but ASCII white space, A-Z lower-cased; a shingle
    counts as often as it occurs.
    """

    @arrow_udf("long")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint_of(t.as_py(), shingle) for t in texts], pa.int64())

    return run(text)


def positional_keys(max_bits: int) -> list[tuple[int, ...]]:
    """The combinations of byte positions of which two linked fingerprints share one."""
    if not 0 <= max_bits < BYTES:
        raise ValueError("max_bits must be from 0 to 7")
    width = -(-(BYTES - max_bits) // 2)
    halves = range(BYTES // 2), range(BYTES // 2, BYTES)
    return [c for half in halves for c in combinations(half, width)]


def postings(fingerprints: DataFrame, max_bits: int) -> DataFrame:
    """The index: ``list`` (which positions), ``bytes`` (what stands there), ``fp``."""
    entries = [
        F.struct(F.lit(n).alias("list"), F.col("fp").bitwiseAND(_mask(c)).alias("bytes"))
        for n, c in enumerate(positional_keys(max_bits))
    ]
    return fingerprints.select("fp", F.inline(F.array(*entries)))


def _mask(positions: tuple[int, ...]) -> Column:
    mask = sum(0xFF << 8 * p for p in positions)
    return F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("long")


def cells(index: DataFrame) -> DataFrame:
    """Postings with ``cell`` and ``block``: long lists as all pairs of blocks, the rest as one cell."""
    total = index.count()
    longest = max(CELL, total // HEAVY_LISTS)
    sizes = index.groupBy("list", "bytes").agg(F.count(F.lit(1)).alias("n"))
    # at most HEAVY_LISTS rows, as each has more than its share of the postings
    heavy = sizes.where(F.col("n") > longest).withColumn("blocks", F.ceil(F.col("n") / longest).cast("int"))
    dealt = index.join(F.broadcast(heavy.drop("n")), ["list", "bytes"], "left")
    block = F.coalesce(F.pmod(F.xxhash64("fp"), F.col("blocks")), F.lit(0)).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("blocks"), F.lit(1)) - 1))
    dealt = dealt.withColumn("block", block).withColumn("other", other)
    cell = F.struct(F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    return dealt.select("list", "bytes", cell.alias("cell"), "block", "fp")


def linked_in_runs(fp: np.ndarray, block: np.ndarray, run: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect all linked fingerprints within each run of equal ``run``.

    Compares at distance 1, 2, ... within the runs; a link between what is already
    connected is left out.
    """
    n = len(fp)
    last = np.searchsorted(run, run, side="right")
    # a run of one block is compared whole; in one of two blocks only across
    mixed = np.minimum.reduceat(block, starts := np.flatnonzero(np.r_[True, run[1:] != run[:-1]])) \
        != np.maximum.reduceat(block, starts)
    across = np.repeat(mixed, np.diff(np.r_[starts, n]))
    root = np.arange(n)
    found_a, found_b = [], []
    at, step = np.arange(n), 1
    while len(at := at[at + step < last[at]]):
        a, b = at, at + step
        differ = fp[a] ^ fp[b]
        spread = differ | differ >> np.uint64(4)
        spread |= spread >> np.uint64(2)
        spread |= spread >> np.uint64(1)
        shared = BYTES - np.bitwise_count(spread & np.uint64(0x0101010101010101))
        hit = (shared >= BYTES - max_bits) & (np.bitwise_count(differ) <= max_bits)
        hit &= ~across[a] | (block[a] != block[b])
        a, b = a[hit], b[hit]
        new = root[a] != root[b]
        a, b = a[new], b[new]
        if len(a):
            found_a.append(a)
            found_b.append(b)
            _unite(root, a, b)
        step += 1
    if not found_a:
        return fp[:0], fp[:0]
    return fp[np.concatenate(found_a)], fp[np.concatenate(found_b)]


def _unite(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    while True:
        x, y = root[a], root[b]
        if (x == y).all():
            return
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root != (up := root[root])).any():
            root[:] = up


def links(fingerprints: DataFrame, max_bits: int = 3) -> DataFrame:
    """``a, b``: links between distinct fingerprints ``fp`` that connect all within ``max_bits`` bits."""
    index = freeze(postings(fingerprints, max_bits), "postings")
    key = ["list", "bytes", "cell"]
    sorted_cells = cells(index).repartition(*key).sortWithinPartitions(*key)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None

        def flush(columns: list[np.ndarray], end: int) -> pa.RecordBatch:
            part = [c[:end] for c in columns]
            edges = np.r_[True, np.any([c[1:] != c[:-1] for c in part[:4]], axis=0)]
            a, b = linked_in_runs(part[5].view(np.uint64), part[4], np.cumsum(edges), max_bits)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for batch in batches:
            cell = batch.column("cell")
            new = [
                np.asarray(c) for c in (
                    batch.column("list"), batch.column("bytes"), cell.field("i"), cell.field("j"),
                    batch.column("block"), batch.column("fp"),
                )
            ]
            if not len(new[0]):
                continue
            held = new if held is None else [np.concatenate(x) for x in zip(held, new, strict=True)]
            # the last run may go on in the next batch
            same = np.all([c == c[-1] for c in held[:4]], axis=0)
            end = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
            if end:
                yield flush(held, end)
                held = [c[end:] for c in held]
        if held is not None:
            yield flush(held, len(held[0]))

    return sorted_cells.mapInArrow(tidy(compare), "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """``doc_id, fp, root, component_id`` for every row of ``docs`` (``doc_id, text``).

    ``root`` identifies a group; ``component_id`` is its smallest doc_id.
    """
    rows = freeze(docs.select("doc_id", fingerprint(F.col("text"), shingle).alias("fp")), "fingerprints")
    nodes = freeze(
        rows.groupBy("fp").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first")), "nodes"
    )
    roots = connected_components(links(nodes.select("fp"), max_bits)).withColumnRenamed("node", "fp")
    grouped = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    grouped = freeze(grouped, "grouped")
    named = grouped.groupBy("root").agg(F.count(F.lit(1)).alias("nodes"), F.min("first").alias("component_id"))
    facts = join_counted(grouped, named, "root", "nodes", nodes.count())
    facts = freeze(facts.select("fp", "n", "root", "component_id"), "facts")
    return join_counted(rows, facts, "fp", "n", rows.count()).select("doc_id", "fp", "root", "component_id")


def keep_first(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """``docs`` with one row of each group: the one with the smallest doc_id (null last).

    Rows that share both doc_id and fingerprint are the same document; one stays.
    """
    groups = near_duplicates(docs, shingle, max_bits)
    rank = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "fp")
    first = groups.groupBy("root").agg(F.min(rank).alias("first")).select("first.*")
    marked = docs.withColumn("__fp", fingerprint(F.col("text"), shingle))
    same = (F.col("d.doc_id").eqNullSafe(F.col("f.doc_id"))) & (F.col("d.__fp") == F.col("f.fp"))
    kept = marked.alias("d").join(first.alias("f"), same).select("d.*")
    return kept.dropDuplicates(["doc_id", "__fp"]).select(*docs.columns)
