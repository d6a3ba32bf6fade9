"""Edit-aware token counts: a segment tree of pre-tokens for each document.

The leaves of a tree are runs of ``LEAF`` pre-tokens with their characters and
tokens; each level above sums ``FANOUT`` nodes of the one below. An edit replaces
some characters. It is located by descending the sums, and only the leaves that it
touches are read again, with the pre-tokens before that might look ahead into it and
as far behind as the new cut takes to meet an old leaf's start. The tree's other
sums stay; those above changed leaves are updated.

A cut depends only on the text from its start on, and looks at most ``LOOK_AHEAD``
characters past its end, so the count always equals that of the whole new text.
Marks of the vocabulary file such as an end-of-text count as ordinary text.

Edits are ``(at, drop, insert)`` in characters of the text as the edits before left
it; a place beyond the end means the end. Edge cases: a null text is an empty one;
null edits are none, null parts of an edit are 0 or empty; repeated rows are counted
one by one; a null doc_id is as good as any; other columns pass through.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from mentionwise.llm.bpe import Encoder, encoder, runs

LEAF = 32
FANOUT = 16
# characters past its end that a pre-token's cut may depend on
LOOK_AHEAD = 2
# a text is cut anew in pieces that grow from this many characters
PIECE = 512

# so many new words of an edit are merged one by one
FEW = 16

EDITS = "array<struct<at: long, drop: long, insert: string>>"
TREE = "leaf_chars array<int>, leaf_tokens array<int>"


class Tree:
    """Character and token sums over the leaves of one document."""

    def __init__(self, leaves: list[tuple[int, int]]):
        self.levels: list[list[tuple[int, int]]] = [leaves]
        self._rebuild(0)

    def _rebuild(self, first: int) -> None:
        """Sums above the leaves from number ``first`` on."""
        level = 0
        while len(self.levels[level]) > 1:
            below = self.levels[level]
            first //= FANOUT
            if level + 1 == len(self.levels):
                self.levels.append([])
            above = self.levels[level + 1]
            del above[first:]
            for i in range(first * FANOUT, len(below), FANOUT):
                part = below[i:i + FANOUT]
                above.append((sum(c for c, _ in part), sum(t for _, t in part)))
            level += 1
        del self.levels[level + 1:]

    def _update(self, leaf: int) -> None:
        """Sums above one changed leaf."""
        for below, above in zip(self.levels, self.levels[1:]):
            leaf //= FANOUT
            part = below[leaf * FANOUT:(leaf + 1) * FANOUT]
            above[leaf] = sum(c for c, _ in part), sum(t for _, t in part)

    def tokens(self) -> int:
        return sum(t for _, t in self.levels[-1])

    def find(self, at: int) -> tuple[int, int]:
        """The leaf that holds character ``at`` (the last one beyond the end) and where it starts."""
        node, start = 0, 0
        for level in range(len(self.levels) - 1, -1, -1):
            nodes = self.levels[level]
            last = min(node + FANOUT, len(nodes)) - 1
            while node < last and start + nodes[node][0] <= at:
                start += nodes[node][0]
                node += 1
            if level:
                node *= FANOUT
        return node, start

    def replace(self, first: int, end: int, leaves: list[tuple[int, int]]) -> None:
        own = self.levels[0]
        if len(leaves) == end - first:
            for i, leaf in enumerate(leaves, first):
                own[i] = leaf
                self._update(i)
        else:
            own[first:end] = leaves
            self._rebuild(first)


def pack(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


def leaves_of(words: list[str], model: Encoder) -> list[tuple[int, int]]:
    known = model.known
    new = set(words).difference(known)
    if len(new) <= FEW:
        # the array checks cost more than merging a few words
        for w in new:
            known[w] = pack(model.merge(w.encode()))
    else:
        known = model.know([words])
    parts = (words[i:i + LEAF] for i in range(0, len(words), LEAF))
    return [(sum(map(len, p)), sum(len(known[w]) for w in p) // 4) for p in parts]


def grow(text: str, model: Encoder) -> Tree:
    return Tree(leaves_of(model.words.cut(text), model))


def edit(text: str, tree: Tree, at: int, drop: int, insert: str, model: Encoder) -> tuple[str, int]:
    """The new text, and how many of its characters were encoded again; ``tree`` is brought up to date."""
    at = min(max(at, 0), len(text))
    drop = min(max(drop, 0), len(text) - at)
    new = text[:at] + insert + text[at + drop:]
    own = tree.levels[0]
    first, start = tree.find(max(at - LOOK_AHEAD, 0))
    if first and start > at - LOOK_AHEAD - 1:
        first -= 1
        start -= own[first][0]
    # the leaf before may end in a cut that looks into the edit; starts of old leaves behind it, in the new text
    end, old_start = tree.find(at + drop)
    shift = len(insert) - drop
    pattern = model.words.pattern(new)
    if pattern is not model.words.pattern(text):
        # letters newer than the vocabulary's library change the cut of the whole text
        tree.levels = grow(new, model).levels
        return new, len(new)
    starts = {}
    while end < len(own):
        if old_start >= at + drop:
            starts[old_start + shift] = end
            if len(starts) >= 64:
                break
        old_start += own[end][0]
        end += 1
    cut: list[str] = []
    stop, met = start, len(own)
    for m in pattern.finditer(new, start):
        if m.start() in starts and m.start() >= at + len(insert):
            met = starts[m.start()]
            break
        cut.append(m[0])
        stop = m.end()
    tree.replace(first, met, leaves_of(cut, model))
    return new, stop - start


def grown(texts: pa.Array, model: Encoder) -> Iterator[tuple[str, Tree]]:
    """Texts and their trees; the new words of a run of texts are learnt together."""
    for start, end in runs(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
        part = [t or "" for t in texts[start:end].to_pylist()]
        cut = [model.words.cut(t) for t in part]
        model.know(cut)
        for text, words in zip(part, cut, strict=True):
            yield text, Tree(leaves_of(words, model))


def build(text: Column, path: str) -> Column:
    """The leaves of a text's tree, to be stored with it."""

    @arrow_udf(TREE)
    def run(texts: pa.Array) -> pa.Array:
        leaves = [tree.levels[0] for _, tree in grown(texts, encoder(path))]
        ints = pa.list_(pa.int32())
        return pa.StructArray.from_arrays(
            [pa.array([[leaf[k] for leaf in g] for g in leaves], ints) for k in (0, 1)], ["leaf_chars", "leaf_tokens"]
        )

    return run(text)


EDITED = f"text string, {TREE}, n_before long, n_tokens long, n_read long"


def edited(pairs: Iterator[tuple[str, Tree]], edits: pa.Array, model: Encoder) -> pa.Array:
    """EDITED of texts with their trees, after each one's edits, in order."""
    rows = []
    for (now, own), changes in zip(pairs, edits, strict=True):
        before, read = own.tokens(), 0
        for e in changes.as_py() or []:
            now, n = edit(now, own, e["at"] or 0, e["drop"] or 0, e["insert"] or "", model)
            read += n
        leaves = own.levels[0]
        rows.append((now, [c for c, _ in leaves], [k for _, k in leaves], before, own.tokens(), read))
    ints = pa.list_(pa.int32())
    types = [pa.string(), ints, ints, pa.int64(), pa.int64(), pa.int64()]
    columns = zip(*rows) if rows else [[]] * 6
    return pa.StructArray.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, types, strict=True)],
        ["text", "leaf_chars", "leaf_tokens", "n_before", "n_tokens", "n_read"],
    )


def apply_edits(text: Column, tree: Column, edits: Column, path: str) -> Column:
    """Struct EDITED: a text and its stored tree after ``edits``, in order.

    ``n_read``: characters encoded again for the edits.
    """

    @arrow_udf(EDITED)
    def run(texts: pa.Array, trees: pa.Array, edits: pa.Array) -> pa.Array:
        held = ((t.as_py() or "", s.as_py()) for t, s in zip(texts, trees, strict=True))
        pairs = ((t, Tree(list(zip(s["leaf_chars"], s["leaf_tokens"], strict=True)))) for t, s in held)
        return edited(pairs, edits, encoder(path))

    return run(text, tree, edits)


def build_and_edit(text: Column, edits: Column, path: str) -> Column:
    """Struct EDITED of a text without a stored tree: built and edited in one pass."""

    @arrow_udf(EDITED)
    def run(texts: pa.Array, edits: pa.Array) -> pa.Array:
        model = encoder(path)
        return edited(grown(texts, model), edits, model)

    return run(text, edits)


def edited_counts(docs: DataFrame, edits: Column, path: str) -> DataFrame:
    """``docs`` with ``edited``: its texts after ``edits`` (EDITS) and their counts."""
    return docs.withColumn("edited", build_and_edit(F.col("text"), edits.cast(EDITS), path))
