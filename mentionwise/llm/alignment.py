"""Alignment of two tokenizers' tokens over the bytes of a text.

A is a byte-level vocabulary file of the tokenizers library, B a sentencepiece model
that puts a space before a text; A gets the same space, so both cut the same bytes.
The libraries' own spans - character offsets of A, spans of the proto of B - are the
coarse cuts. A token whose span is as long as its bytes, and starts where the one
before ends, keeps it; tokens that split a character, or stand for a single byte of
one, are cut by their decoded bytes. Places where tokens of both end cut a text into
groups. Every A token is linked with every B token of its group, and every id pair is
weighed by the number of documents that hold it linked.

Neither tokenizer has a token, nor a cut that depends on one, across a space behind a
visible character (this is checked of the files; where it does not hold, a text is one
word). So a text is its words' groups in a row, each word with the space before it, and of
a slice of texts only the distinct words go through the libraries, many at once.

Counting goes by blocks of documents: a block holds each of its pairs once, with the
number of its documents that hold it, so only distinct pairs of blocks are shuffled,
and a block's documents meet its pairs' counts in one group. A group of very many
tokens is paired by its distinct ids, not token by token.

Edge cases: special tokens' strings in a text are plain text. A null or empty text, or
one that either tokenizer does not give back byte by byte, has no tokens and no links:
zeros and an empty ``groups``. Rows are independent, so repeated rows and null doc_ids
count as documents of their own. Carried columns of other names pass through; one named
like a result column gives way to it. An empty table gives an empty result. The counts
of an A id are a row each at most, so the table of the highest counts is bounded by A's
vocabulary and may be broadcast.
"""

from __future__ import annotations

import json
import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import StructType

from mentionwise.llm.bpe import byte_alphabet
from mentionwise.llm.scratch import Scratch

# a block of documents is closed beyond so many pairs of its documents
BLOCK_PAIRS = 400_000
# texts are handled in slices of about so many characters
SLICE_CHARS = 4_000_000
# words are kept for later slices, up to so many
WORDS_KEPT = 120_000
# words of up to so many characters go through the libraries together, so many characters at once
SHORT_WORD, JOINED_CHARS = 64, 100_000
# a group with more links than this is paired by distinct ids
PAIRED_AT_ONCE = 4096

# a space at which a text is not cut: letters, digits and ASCII signs before one are no white space to either library
UNCUT_SPACE = re.compile(r" (?:(?<![!-~\w] )|$)").search

MARKS = np.frombuffer(b",|;\n", np.uint8)
SPANS = "a_ids array<int>, a_ends array<int>, b_ids array<int>, b_ends array<int>, cuts array<int>"
LINKED = (
    "n_a long, n_b long, n_groups long, n_links long, groups string, "
    "block long, pairs array<int>, weights array<long>, block_pairs array<long>, block_docs array<int>"
)
SCORED = "n_best long, count_sum long"


def refined(begins: np.ndarray, ends: np.ndarray, widths: np.ndarray) -> np.ndarray:
    """Byte ends of tokens: the library's span where it covers whole characters, else by decoded bytes."""
    starts = np.concatenate([ends[:1] * 0, ends[:-1]])
    whole = (begins == starts) & (ends - begins == widths)
    if whole.all():
        return ends
    summed = np.cumsum(widths)
    last = np.maximum.accumulate(np.where(whole, np.arange(len(ends)), -1))
    base = np.where(last >= 0, ends[last] - summed[last], 0)
    return summed + base


def char_starts(text: str) -> np.ndarray:
    """The byte at which each character of a text starts in UTF-8, and its length at the end."""
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    widths = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
    return np.concatenate([[0], np.cumsum(widths)])


class Aligner:
    """Spans and groups of one text at a time."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer, processors

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.a.post_processor = processors.ByteLevel(trim_offsets=False)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        alphabet, vocab = byte_alphabet(), self.a.get_vocab()
        self.bytes_a = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            if all(c in alphabet for c in token):
                self.bytes_a[i] = bytes(map(alphabet.__getitem__, token))
        self.bytes_b = [
            bytes([int(piece[1:-1], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()
            for i in range(self.b.get_piece_size()) for piece in [self.b.id_to_piece(i)]
        ]
        self.apart = self._words_stand_alone(path_a)
        self.width_a, self.width_b = (np.fromiter(map(len, t), np.int64, len(t)) for t in (self.bytes_a, self.bytes_b))

    def _words_stand_alone(self, path_a: str) -> bool:
        """Whether both tokenizers cut a text before each space that follows a visible character."""
        with open(path_a, encoding="utf-8") as f:
            spec = json.load(f)
        cutter = spec.get("pre_tokenizer") or {}
        a_cuts = (
            cutter.get("type") == "ByteLevel" and cutter.get("use_regex", True) and not spec.get("normalizer")
            and all(t.get("special") for t in spec.get("added_tokens", []))
        )
        pieces = map(self.b.id_to_piece, range(self.b.get_piece_size()))
        return bool(a_cuts) and not any("▁" in piece.lstrip("▁") for piece in pieces)

    def words(self, text: str) -> list[str]:
        """Space + text, cut before each space that follows a visible character."""
        if not self.apart:
            return [" " + text]
        if not UNCUT_SPACE(text):
            return [" " + part for part in text.split(" ")]
        words: list[str] = []
        joins = False
        for part in text.split(" "):
            if joins:
                words[-1] += " " + part
            else:
                words.append(" " + part)
            joins = bool(UNCUT_SPACE(part + " x"))
        if len(words) > 1 and words[-1] == " ":
            # B puts no space before nothing
            words[-2:] = [words[-2] + " "]
        return words

    def table(self, words: list[str], at_once: int = PAIRED_AT_ONCE) -> Words:
        """The groups of distinct words, in their order."""
        made = Words(len(words))
        # a word that ends in white space would run on into the next one
        short = [i for i, w in enumerate(words) if len(w) <= SHORT_WORD and self.apart and not w[-1].isspace()]
        start, size = 0, 0
        for k, i in enumerate(short):
            size += len(words[i])
            if size >= JOINED_CHARS or k == len(short) - 1:
                self._put(made, words, short[start:k + 1], at_once)
                start, size = k + 1, 0
        for i in set(range(len(words))).difference(short):
            self._put(made, words, [i], at_once)
        made.close()
        return made

    def _put(self, made: Words, words: list[str], at: list[int], at_once: int) -> None:
        """Cuts the words numbered ``at`` as one text; if that does not come back, in halves."""
        found = self._cut("".join([words[i] for i in at]))
        if found is None:
            if len(at) > 1:
                self._put(made, words, at[:len(at) // 2], at_once)
                self._put(made, words, at[len(at) // 2:], at_once)
            return
        a_ids, a_ends, b_ids, b_ends, cuts = found
        ga, gb = np.searchsorted(cuts, a_ends), np.searchsorted(cuts, b_ends)
        # each word ends with a group
        last = np.searchsorted(cuts, np.cumsum([len(words[i].encode()) for i in at]))
        by_a, by_b = np.searchsorted(last, ga), np.searchsorted(last, gb)
        texts = groups_text(a_ids, ga, b_ids, gb, last).split("\n")
        if len(at) == 1:
            pairs, weights = links(a_ids, ga, b_ids, gb, len(cuts), at_once)
            of = np.zeros(len(pairs), np.int64)
        else:
            left, right = paired(ga, gb, np.bincount(ga), np.bincount(gb))
            pairs, weights, of = a_ids[left] << 32 | b_ids[right], np.ones(len(left), np.int64), by_a[left]
        n = len(at)
        counts = np.bincount(by_a, minlength=n), np.bincount(by_b, minlength=n), np.diff(last, prepend=-1)
        made.put(at, counts, texts, np.bincount(of, minlength=n), pairs, weights)

    def spans(self, text: str | None) -> tuple[np.ndarray, ...] | None:
        """``a_ids, a_ends, b_ids, b_ends, cuts`` over the bytes of space + text; none if they do not give it back."""
        return self._cut(" " + text) if text else None

    def _cut(self, text: str) -> tuple[np.ndarray, ...] | None:
        raw = text.encode()
        coded = self.a.encode(text, add_special_tokens=False)
        ids = coded.ids
        if b"".join(map(self.bytes_a.__getitem__, ids)) != raw:
            return None
        a_ids = np.array(ids, np.int64)
        a_spans = np.fromiter(chain.from_iterable(coded.offsets), np.int64, 2 * len(ids))
        if len(raw) > len(text):
            a_spans = char_starts(text)[a_spans]
        pieces = self.b.encode(text[1:], return_type="proto", num_threads=1).pieces
        pieces = list(pieces)
        ids = list(map(attrgetter("id"), pieces))
        if b"".join(map(self.bytes_b.__getitem__, ids)) != raw:
            return None
        b_ids = np.array(ids, np.int64)
        # the spans of B lack the space before the text
        b_begins = np.fromiter(map(attrgetter("begin"), pieces), np.int64, len(ids)) + 1
        b_ends = np.fromiter(map(attrgetter("end"), pieces), np.int64, len(ids)) + 1
        b_begins[0] = 0
        a_ends = refined(a_spans[0::2], a_spans[1::2], self.width_a[a_ids])
        b_ends = refined(b_begins, b_ends, self.width_b[b_ids])
        return a_ids, a_ends, b_ids, b_ends, np.intersect1d(a_ends, b_ends, assume_unique=True)


class Words:
    """Counts, groups and links of distinct words."""

    def __init__(self, n: int):
        self.good = np.zeros(n, bool)
        self.counts = np.zeros((3, n), np.int64)
        self.texts = [""] * n
        self.first, self.size = np.zeros((2, n), np.int64)
        self._pairs: list[np.ndarray] = []
        self._weights: list[np.ndarray] = []
        self._held = 0

    def put(
        self, at: list[int], counts: tuple[np.ndarray, ...], texts: list[str], size: np.ndarray, pairs: np.ndarray,
        weights: np.ndarray,
    ) -> None:
        self.good[at] = True
        for own, n in zip(self.counts, counts, strict=True):
            own[at] = n
        for i, text in zip(at, texts, strict=True):
            self.texts[i] = text
        self.size[at] = size
        self.first[at] = self._held + np.cumsum(size) - size
        self._held += len(pairs)
        self._pairs.append(pairs)
        self._weights.append(weights)

    def close(self) -> None:
        none = np.zeros(0, np.int64)
        self.pairs, self.weights = np.concatenate([none, *self._pairs]), np.concatenate([none, *self._weights])

    def chosen(self, at: np.ndarray) -> Words:
        """Some of the words, in this order."""
        made, size = Words(len(at)), self.size[at]
        made.good, made.counts, made.texts = self.good[at], self.counts[:, at], [self.texts[i] for i in at.tolist()]
        ends = np.cumsum(size)
        made.first, made.size = ends - size, size
        links_at = np.repeat(self.first[at] - made.first, size) + np.arange(size.sum())
        made.pairs, made.weights = self.pairs[links_at], self.weights[links_at]
        return made

    def followed_by(self, other: Words) -> Words:
        made = Words(0)
        made.good, made.counts = np.concatenate([self.good, other.good]), np.hstack([self.counts, other.counts])
        made.texts = self.texts + other.texts
        made.first = np.concatenate([self.first, other.first + len(self.pairs)])
        made.size = np.concatenate([self.size, other.size])
        made.pairs = np.concatenate([self.pairs, other.pairs])
        made.weights = np.concatenate([self.weights, other.weights])
        return made

    def document(self, words: np.ndarray) -> tuple[tuple, np.ndarray, np.ndarray] | None:
        """Facts, distinct pairs and their links of a text of these words."""
        if not len(words) or not self.good[words].all():
            return None
        distinct, times = np.unique(words, return_counts=True)
        size = self.size[distinct]
        ends = np.cumsum(size)
        at = np.repeat(self.first[distinct] - ends + size, size) + np.arange(ends[-1])
        pairs, weights = summed(self.pairs[at], self.weights[at] * np.repeat(times, size))
        n_a, n_b, n_groups = self.counts[:, words].sum(axis=1).tolist()
        text = ";".join(map(self.texts.__getitem__, words.tolist()))
        return (n_a, n_b, n_groups, int(weights.sum()), text), pairs, weights


def paired(ga: np.ndarray, gb: np.ndarray, na: np.ndarray, nb: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the A and B tokens that share a group, of A tokens whose groups ``nb`` has not set to 0."""
    partners = nb[ga]
    left = np.repeat(np.arange(len(ga)), partners)
    within = np.arange(len(left)) - np.repeat(np.cumsum(partners) - partners, partners)
    first_b = np.searchsorted(gb, np.arange(len(na)))
    return left, first_b[ga[left]] + within


def links(
    a_ids: np.ndarray, ga: np.ndarray, b_ids: np.ndarray, gb: np.ndarray, groups: int, at_once: int = PAIRED_AT_ONCE
) -> tuple[np.ndarray, np.ndarray]:
    """Distinct id pairs (A id in the high half) of linked tokens, sorted, and their numbers of links."""
    na, nb = np.bincount(ga, minlength=groups), np.bincount(gb, minlength=groups)
    large = na * nb > at_once
    first_a, first_b = np.cumsum(na) - na, np.cumsum(nb) - nb
    left, right = paired(ga, gb, na, np.where(large, 0, nb))
    pairs = [a_ids[left] << 32 | b_ids[right]]
    weights = [np.ones(len(left), np.int64)]
    for g in np.flatnonzero(large).tolist():
        a, n = np.unique(a_ids[first_a[g]:first_a[g] + na[g]], return_counts=True)
        b, m = np.unique(b_ids[first_b[g]:first_b[g] + nb[g]], return_counts=True)
        pairs.append((a[:, None] << 32 | b).ravel())
        weights.append((n[:, None] * m).ravel())
    return summed(np.concatenate(pairs), np.concatenate(weights))


def summed(pairs: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs, sorted, and the sums of their weights."""
    order = np.argsort(pairs, kind="stable")
    pairs, weights = pairs[order], weights[order]
    edges = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]]))
    return pairs[edges], np.add.reduceat(weights, edges)


def groups_text(
    a_ids: np.ndarray, ga: np.ndarray, b_ids: np.ndarray, gb: np.ndarray, last: np.ndarray | None = None
) -> str:
    """``a1,a2|b1;a3|b2,b3``: the ids of each group in order; a line end instead behind the groups in ``last``."""
    ids = np.empty(len(a_ids) + len(b_ids), np.int64)
    # which of the marks , | ; and line end follows a token
    marks = np.zeros(len(ids), np.int64)
    at_a = np.arange(len(ga)) + np.searchsorted(gb, ga, side="left")
    at_b = np.arange(len(gb)) + np.searchsorted(ga, gb, side="right")
    ids[at_a], ids[at_b] = a_ids, b_ids
    marks[at_a] = np.concatenate([ga[1:] != ga[:-1], [True]])
    ends = np.flatnonzero(np.concatenate([gb[1:] != gb[:-1], [True]]))
    marks[at_b[ends]] = 2
    if last is not None:
        marks[at_b[ends[last]]] = 3
    return decimals(ids, MARKS[marks])[:-1]


def decimals(ids: np.ndarray, marks: np.ndarray) -> str:
    """Each id in decimal with its mark behind it; digits of all ids at once, leading zeros left out."""
    width = len(str(int(ids.max(initial=0))))
    out = np.empty((len(ids), width + 1), np.uint8)
    out[:, width] = marks
    left = ids.astype(np.uint32)
    for k in range(width - 1, -1, -1):
        rest = left // 10
        out[:, k] = left - rest * 10 + ord("0")
        if k < width - 1:
            out[left == 0, k] = 0
        left = rest
    return out[out > 0].tobytes().decode("ascii")


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """One aligner for each pair of files and Python worker."""
    key = path_a, path_b
    if key not in _aligners:
        _aligners[key] = Aligner(*key)
    return _aligners[key]


def spans(text: Column, path_a: str, path_b: str) -> Column:
    """Struct SPANS of a text: ids and byte ends of both tokenizers, and the cuts; null without tokens."""

    @arrow_udf(SPANS)
    def run(texts: pa.Array) -> pa.Array:
        model = aligner(path_a, path_b)
        found = [s and [x.tolist() for x in s] for s in map(model.spans, texts.to_pylist())]
        ints = pa.list_(pa.int32())
        names = [f.split()[0] for f in SPANS.split(", ")]
        return pa.array([s and dict(zip(names, s, strict=True)) for s in found], pa.struct([(n, ints) for n in names]))

    return run(text)


class Block:
    """Documents of one Arrow batch up to about BLOCK_PAIRS pairs."""

    def __init__(self) -> None:
        self.facts: list[tuple[int, int, int, int, str]] = []
        self.pairs: list[np.ndarray] = []
        self.weights: list[np.ndarray] = []
        self.size = 0

    def add(self, found: tuple[tuple, np.ndarray, np.ndarray] | None) -> None:
        none = np.zeros(0, np.int64)
        facts, pairs, weights = found or ((0, 0, 0, 0, ""), none, none)
        self.facts.append(facts)
        self.pairs.append(pairs)
        self.weights.append(weights)
        self.size += len(pairs)

    def columns(self, number: int) -> list[pa.Array]:
        """LINKED; the block's own table of pairs stands in its first row."""
        n = len(self.facts)
        every, which, docs = np.unique(np.concatenate(self.pairs), return_inverse=True, return_counts=True)
        ends = np.concatenate([[0], np.cumsum(list(map(len, self.pairs)))])

        def lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
            return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, kind))

        def first(values: np.ndarray, kind: pa.DataType) -> pa.Array:
            at = np.r_[0, np.full(n, len(values))]
            return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(values, kind))

        kinds = [pa.int64()] * 4 + [pa.string()]
        return [pa.array(x, k) for x, k in zip(zip(*self.facts), kinds, strict=True)] + [
            pa.array(np.full(n, number), pa.int64()),
            lists(which.ravel(), pa.int32()), lists(np.concatenate(self.weights), pa.int64()),
            first(every, pa.int64()), first(docs, pa.int32()),
        ]


class Documents:
    """Facts, pairs and links of texts (see ``Words.document``), slice by slice."""

    def __init__(self, model: Aligner, at_once: int = PAIRED_AT_ONCE, words_kept: int = WORDS_KEPT):
        self.model, self.at_once, self.words_kept = model, at_once, words_kept
        self.index: dict[str, int] = {}
        self.known = Words(0)
        self.known.close()

    def of(self, texts: pa.Array) -> Iterator[tuple | None]:
        start, size = 0, 0
        for at, length in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
            size += length
            if size >= SLICE_CHARS or at == len(texts) - 1:
                yield from self._slice(texts[start:at + 1].to_pylist())
                start, size = at + 1, 0

    def _slice(self, texts: list[str | None]) -> Iterator[tuple | None]:
        held = len(self.index)
        # a new word takes the next number
        index = defaultdict(None, self.index)
        index.default_factory = index.__len__
        cut = [np.array(list(map(index.__getitem__, self.model.words(t))) if t else [], np.int64) for t in texts]
        words = list(index)
        table = self.known.followed_by(self.model.table(words[held:], self.at_once))
        yield from map(table.document, cut)
        times = np.bincount(np.concatenate(cut), minlength=len(words))
        # words that came again go first, then those known for longest
        kept = np.sort(np.argsort(times < 2, kind="stable")[:self.words_kept])
        self.known = table.chosen(kept)
        self.index = {words[i]: k for k, i in enumerate(kept.tolist())}


def carried(docs: DataFrame, text: str, results: str) -> list[str]:
    taken = {f.name for f in StructType.fromDDL(results)} | {text}
    return [c for c in docs.columns if c not in taken]


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def numbered(names: list[str]) -> list[Column]:
    """Columns under plain names on their way through Python, which cannot take every name."""
    return [quoted(c).alias(f"c{i}") for i, c in enumerate(names)]


def named(df: DataFrame, names: list[str]) -> DataFrame:
    own = [F.col(f"c{i}").alias(c) for i, c in enumerate(names)]
    return df.select(*own, *df.columns[len(names):])


def linked(
    docs: DataFrame, path_a: str, path_b: str, text: str = "text", block_pairs: int = BLOCK_PAIRS,
    paired_at_once: int = PAIRED_AT_ONCE,
) -> DataFrame:
    """The columns of ``docs`` but its text, with LINKED.

    ``groups`` holds the ids of each group; ``pairs`` point into the table of the
    document's ``block``, whose pairs and their numbers of documents stand in one of its rows.
    """
    names = carried(docs, text, f"{LINKED}, {SCORED}")
    rows = docs.select(*numbered(names), quoted(text).alias("text"))
    schema = StructType(list(rows.schema)[:-1] + list(StructType.fromDDL(LINKED)))
    fields = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        documents = Documents(aligner(path_a, path_b), paired_at_once)
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            block, start = Block(), 0
            for at, found in enumerate(documents.of(texts)):
                block.add(found)
                if block.size >= block_pairs or at == batch.num_rows - 1:
                    kept = batch.slice(start, at + 1 - start).columns[:-1]
                    yield pa.RecordBatch.from_arrays([*kept, *block.columns(number)], fields)
                    block, start, number = Block(), at + 1, number + 1

    return named(rows.mapInArrow(run, schema), names)


def scored(found: DataFrame) -> DataFrame:
    """The rows of ``linked`` with SCORED, without the columns of blocks.

    ``n_best``: links whose pair is held by the most documents of all pairs of its A
    id, ties included; ``count_sum``: over all links, the documents that hold the pair.
    """
    steps = Scratch(found.sparkSession)
    held = steps.write(found, "linked")
    entries = held.where(F.size("block_pairs") > 0).select(
        "block", F.posexplode(F.arrays_zip("block_pairs", "block_docs")).alias("at", "entry")
    ).select("block", "at", F.col("entry.block_pairs").alias("pair"), F.col("entry.block_docs").alias("docs"))
    counts = steps.write(entries.groupBy("pair").agg(F.sum("docs").alias("n")), "pair-counts")
    token = F.shiftright("pair", 32).alias("a")
    # a row for each id of A's vocabulary at most
    highest = counts.groupBy(token).agg(F.max("n").alias("highest"))
    facts = counts.withColumn("a", token).join(F.broadcast(highest), "a").select(
        "pair", "n", (F.col("n") == F.col("highest")).alias("best")
    )
    met = entries.drop("docs").join(facts, "pair").select(F.col("block").alias("of_block"), "at", "n", "best")

    names = [c for c in held.columns if c not in ("block", "pairs", "weights", "block_pairs", "block_docs")]
    documents = held.select(*numbered(names), "block", "pairs", "weights")
    schema = StructType(list(documents.schema)[:len(names)] + list(StructType.fromDDL(SCORED)))
    fields = schema.names

    def score(documents: pa.Table, met: pa.Table) -> pa.Table:
        documents, met = documents.combine_chunks(), met.combine_chunks()
        n, best = (np.zeros(met.num_rows, np.int64) for _ in range(2))
        at = met["at"].to_numpy()
        n[at] = met["n"].to_numpy()
        best[at] = met["best"].to_numpy(zero_copy_only=False)
        sums = np.zeros((2, documents.num_rows), np.int64)
        row = 0
        for chunk in documents.select(["pairs", "weights"]).to_batches():
            pairs, weights = chunk.columns
            ends = np.concatenate([[0], np.cumsum(np.asarray(pc.list_value_length(pairs), np.int64))])
            which, by = pairs.flatten().to_numpy(), weights.flatten().to_numpy()
            for k, value in enumerate((best, n)):
                total = np.concatenate([[0], np.cumsum(value[which] * by)])
                sums[k, row:row + chunk.num_rows] = total[ends[1:]] - total[ends[:-1]]
            row += chunk.num_rows
        kept = documents.columns[:len(names)]
        return pa.Table.from_arrays([*kept, *map(pa.array, sums)], names=fields)

    return named(documents.groupBy("block").cogroup(met.groupBy("of_block")).applyInArrow(score, schema), names)
