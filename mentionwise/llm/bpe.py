"""BPE encoding and decoding by speculation: propose greedily, verify pairs, merge what fails.

A text is cut into pre-tokens ("words"). For each word not seen before, greedy
longest match proposes tokens. A proposal is the true encoding exactly when each
token encodes to itself and no merge would ever cross the seam of two neighbours;
the seams of all words of a batch are checked at once with arrays. Only words with
a bad seam go through the merges one by one.

Edge cases: a null or empty text has no tokens and decodes to the empty text. The
added tokens of the vocabulary file (such as an end-of-text mark) are matched in a
text as one token, as the file's own library does by default; ``specials=False``
treats them as ordinary text. Ids that the vocabulary lacks decode to nothing.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from mentionwise.llm.memory import give_back

# texts are pre-tokenised in slices of about so many characters, whatever the Arrow batch holds
SLICE_CHARS = 1_000_000
# words kept with their tokens in each Python worker; beyond, the table starts anew
WORDS_KEPT = 200_000

# fixed values: how the byte-level vocabularies cut a text, and which bytes stand for themselves
CONTRACTIONS = r"'s|'t|'re|'ve|'m|'ll|'d"
PLAIN_BYTES = [(0x21, 0x7E), (0xA1, 0xAC), (0xAE, 0xFF)]


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in a vocabulary file, to the byte."""
    plain = [b for low, high in PLAIN_BYTES for b in range(low, high + 1)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


@lru_cache(maxsize=1)
def newer_letters() -> str:
    """Code points that ``regex`` calls letters or digits and the tokenizers library does not know yet.

    The two libraries follow different Unicode versions. Only code points that are
    unassigned in Python's own table can differ, so only those are tried.
    """
    from tokenizers import pre_tokenizers

    cut = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
    newer: list[int] = []
    # block by block: a list of all letters would stay with the worker
    for first in range(0x80, 0x110000, 0x400):
        block = "".join(chr(c) for c in range(first, min(first + 0x400, 0x110000)) if not 0xD800 <= c < 0xE000)
        newer += [
            ord(c) for c in regex.findall(r"[\p{L}\p{N}]", block)
            if unicodedata.category(c) == "Cn" and len(cut.pre_tokenize_str(f"a{c}1{c}")) == 4
        ]
    return ranges(newer)


def ranges(points: list[int]) -> str:
    """Sorted code points as the inside of a character class."""
    runs: list[list[int]] = []
    for c in points:
        if runs and runs[-1][1] == c - 1:
            runs[-1][1] = c
        else:
            runs.append([c, c])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in runs)


def word_patterns(newer: str) -> tuple[regex.Pattern, regex.Pattern | None]:
    """The pattern for usual texts, and the one for texts with letters of ``newer``."""

    def pattern(letter: str, digit: str, other: str) -> regex.Pattern:
        runs = f" ?{letter}+| ?{digit}+| ?{other}+"
        return regex.compile(rf"(?V1){CONTRACTIONS}|{runs}|\s+(?!\S)|\s+")

    usual = pattern(r"\p{L}", r"\p{N}", r"[^\s\p{L}\p{N}]")
    if not newer:
        return usual, None
    old = (rf"[\p{{L}}--[{newer}]]", rf"[\p{{N}}--[{newer}]]", rf"[[^\s\p{{L}}\p{{N}}]||[{newer}]]")
    return usual, pattern(*old)


class Words:
    """Cuts texts into pre-tokens."""

    def __init__(self, newer: str):
        self.usual, self.older = word_patterns(newer)
        # a plain range first: large classes are slow to search for
        self.may_be_newer = re.compile(f"[{newer[:10]}-\U0010ffff]").search if newer else None
        self.newer = re.compile(f"[{newer}]").search if newer else None

    def pattern(self, text: str) -> regex.Pattern:
        if self.newer and not text.isascii() and self.may_be_newer(text) and self.newer(text):
            return self.older
        return self.usual

    def cut(self, text: str) -> list[str]:
        return self.pattern(text).findall(text)


class Encoder:
    """Words to token ids; ids are bytes of little-endian unsigned 32-bit integers."""

    def __init__(self, source: str, newer: str = "", kept: int = WORDS_KEPT):
        self.kept = kept
        import ahocorasick

        spec = json.loads(source)
        alphabet = byte_alphabet()
        vocab = spec["model"]["vocab"]
        size = max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])], default=-1) + 1
        self.words = Words(newer)
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of: list[bytes] = [b""] * size
        for token, i in vocab.items():
            if token not in self.specials:
                self.bytes_of[i] = bytes(map(alphabet.__getitem__, token))
        for token, i in self.specials.items():
            self.bytes_of[i] = token.encode()
        self.special_pattern = re.compile("|".join(map(re.escape, sorted(self.specials, key=len, reverse=True))))
        self.byte_id = [vocab[c] for c, _ in sorted(alphabet.items(), key=lambda x: x[1])]
        self._merges(spec["model"]["merges"], vocab, size)

        self.proposer = ahocorasick.Automaton()
        for token, i in vocab.items():
            if token not in self.specials:
                self.proposer.add_word(self.bytes_of[i].decode("latin-1"), i)
        self.proposer.add_word("Ā", -1)
        self.proposer.make_automaton()
        self.known: dict[str, bytes] = {}

    def _merges(self, merges: list, vocab: dict[str, int], size: int) -> None:
        left, right, made = np.zeros((3, len(merges)), np.int64)
        for rank, pair in enumerate(merges):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            left[rank], right[rank], made[rank] = vocab[a], vocab[b], vocab[a + b]
        keys = left << 32 | right
        self.rank_of = dict(zip(keys.tolist(), range(len(merges)), strict=True))
        self.made = made.tolist()
        self.pair_order = np.argsort(keys)
        self.pair_keys = keys[self.pair_order]
        # the merge that makes a token, and the chain of its outermost parts
        self.made_by = np.full(size, -1, np.int64)
        self.made_by[made] = np.arange(len(merges))
        self.last_part, self.first_part = np.full((2, size), -1, np.int64)
        self.last_part[made], self.first_part[made] = right, left
        # tokens that their own bytes do not encode to never stand in a true encoding
        self.reachable = np.zeros(size, bool)
        self.reachable[self.byte_id] = True
        holds = self._seams_hold(left, right, inside=True).tolist()
        for rank, token in enumerate(self.made):
            self.reachable[token] = holds[rank] and self.reachable[left[rank]] and self.reachable[right[rank]]

    def _seams_hold(self, a: np.ndarray, b: np.ndarray, inside: bool = False) -> np.ndarray:
        """For each pair of tokens: does no merge ever cross the seam between them?

        ``inside``: the pairs are the halves of a token, whose own merge is meant to cross.

        Merges happen in order of rank. A part at the seam exists until the merge of
        its parent; a crossing merge happens if it ranks before the parents of both
        parts. On a tie the merge further left is first.
        """
        never = len(self.made)
        holds = np.ones(len(a), bool)
        at = np.arange(len(a))
        part_a, until_a = a, np.full(len(a), never)
        while len(at):
            i, part_b, until_b = np.arange(len(at)), b[at], np.full(len(at), never)
            while len(i):
                key = part_a[i] << 32 | part_b
                slot = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
                rank = np.where(self.pair_keys[slot] == key, self.pair_order[slot], never)
                crossed = (rank < until_a[i]) & (rank <= until_b) & (rank < never)
                if inside:
                    crossed &= (until_a[i] < never) | (until_b < never)
                holds[at[i[crossed]]] = False
                until_b = self.made_by[part_b]
                part_b = self.first_part[part_b]
                go = (part_b >= 0) & ~crossed
                i, part_b, until_b = i[go], part_b[go], until_b[go]
            until_a = self.made_by[part_a]
            part_a = self.last_part[part_a]
            go = (part_a >= 0) & holds[at]
            at, part_a, until_a = at[go], part_a[go], until_a[go]
        return holds

    def merge(self, data: bytes) -> list[int]:
        """The tokens of one word by the merges themselves: lowest rank first, leftmost on a tie."""
        if len(data) > 64:
            return self._merge_long(data)
        ids = [self.byte_id[b] for b in data]
        rank_of, made, never = self.rank_of.get, self.made, len(self.made)
        ranks = [rank_of(a << 32 | b, never) for a, b in zip(ids, ids[1:])]
        while ranks and (rank := min(ranks)) < never:
            i = ranks.index(rank)
            ids[i:i + 2] = [made[rank]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank_of(ids[i - 1] << 32 | ids[i], never)
            if i < len(ranks):
                ranks[i] = rank_of(ids[i] << 32 | ids[i + 1], never)
        return ids

    def _merge_long(self, data: bytes) -> list[int]:
        """The same with a heap, for words where scanning all pairs each time would be slow."""
        ids = [self.byte_id[b] for b in data]
        rank_of, end = self.rank_of, len(ids)
        after = list(range(1, end + 1))
        before = list(range(-1, end - 1))
        heap = [
            (r, i, ids[i], ids[i + 1]) for i in range(end - 1)
            if (r := rank_of.get(ids[i] << 32 | ids[i + 1])) is not None
        ]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= end or ids[j] != b:
                continue
            ids[i], ids[j] = self.made[rank], -1
            after[i] = after[j]
            if after[j] < end:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < end and (r := rank_of.get(ids[x] << 32 | ids[y])) is not None:
                    heapq.heappush(heap, (r, x, ids[x], ids[y]))
        return [t for t in ids if t >= 0]

    def learn(self, words: list[str]) -> int:
        """Adds words to the table of known ones; how many of them needed merging."""
        if not words:
            return 0
        raw = [w.encode() for w in words]
        text = "Ā".join([b.decode("latin-1") for b in raw]) + "Ā"
        ids = np.fromiter((i for _, i in self.proposer.iter_long(text)), np.int64)
        ends = np.flatnonzero(ids < 0)
        if len(ends) != len(words):
            raise ValueError("a word holds the mark between words")
        starts = np.concatenate([[0], ends[:-1] + 1])
        lengths = self._lengths[np.maximum(ids, 0)] * (ids >= 0)
        covered = np.add.reduceat(lengths, starts) == np.fromiter(map(len, raw), np.int64, len(raw))
        seam = np.flatnonzero((ids[:-1] >= 0) & (ids[1:] >= 0))
        pairs, which = np.unique(ids[seam] << 32 | ids[seam + 1], return_inverse=True)
        bad = np.zeros(len(ids), bool)
        bad[seam] = ~self._seams_hold(pairs >> 32, pairs & 0xFFFFFFFF)[which]
        bad |= (ids >= 0) & ~self.reachable[np.maximum(ids, 0)]
        good = covered & ~np.logical_or.reduceat(bad, starts)
        packed = ids.astype("<u4").tobytes()
        for word, data, start, end, fits in zip(words, raw, starts.tolist(), ends.tolist(), good.tolist(), strict=True):
            if fits:
                self.known[word] = packed[4 * start:4 * end]
            else:
                self.known[word] = np.array(self.merge(data), "<u4").tobytes()
        return int((~good).sum())

    @property
    def _lengths(self) -> np.ndarray:
        if not hasattr(self, "_token_lengths"):
            self._token_lengths = np.fromiter(map(len, self.bytes_of), np.int64, len(self.bytes_of))
        return self._token_lengths

    def know(self, cut: Iterable[list[str]]) -> dict[str, bytes]:
        """The table of words, with all words of these texts in it."""
        wanted = set().union(*cut)
        new = wanted.difference(self.known)
        if len(self.known) + len(new) > self.kept:
            self.known.clear()
            new = wanted
        self.learn(list(new))
        return self.known

    def encode(self, texts: list[str | None], specials: bool = True) -> list[bytes]:
        out: list[bytes] = []
        for part in slices(texts):
            if specials and self.specials and any(t and self.special_pattern.search(t) for t in part):
                out += [self._encode_around(t or "") for t in part]
                continue
            cut = [self.words.cut(t) if t else [] for t in part]
            known = self.know(cut)
            out += [b"".join(map(known.__getitem__, c)) for c in cut]
        return out

    def _encode_around(self, text: str) -> bytes:
        found, at = [], 0
        for m in [*self.special_pattern.finditer(text), None]:
            cut = self.words.cut(text[at:m.start() if m else len(text)])
            known = self.know([cut])
            found += map(known.__getitem__, cut)
            if m:
                found.append(self.specials[m[0]].to_bytes(4, "little"))
                at = m.end()
        return b"".join(found)

    def decode(self, ids: bytes) -> str:
        size = len(self.bytes_of)
        found = (self.bytes_of[i] for i in np.frombuffer(ids, "<u4").tolist() if i < size)
        return b"".join(found).decode("utf-8", errors="replace")


def slices(texts: list[str | None]) -> Iterable[list[str | None]]:
    """Runs of texts of about SLICE_CHARS characters; a longer text stands alone."""
    part: list[str | None] = []
    size = 0
    for text in texts:
        length = len(text) if text else 0
        if part and size + length > SLICE_CHARS:
            yield part
            part, size = [], 0
        part.append(text)
        size += length
    if part:
        yield part


_encoders: dict[str, Encoder] = {}


def encoder(path: str, kept: int = WORDS_KEPT) -> Encoder:
    """One encoder for each vocabulary file and Python worker; ``kept``: words it holds from now on."""
    if path not in _encoders:
        give_back()
        with open(path, encoding="utf-8") as f:
            _encoders[path] = Encoder(f.read(), newer_letters(), kept)
        give_back()
    _encoders[path].kept = kept
    return _encoders[path]


def forget(path: str) -> None:
    """Free this worker's encoder of a vocabulary file."""
    if _encoders.pop(path, None) is not None:
        give_back()


def encode(text: Column, path: str, specials: bool = True) -> Column:
    """Token ids of a text as bytes, four little-endian ones for each id."""

    @arrow_udf("binary")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array(encoder(path).encode(texts.to_pylist(), specials), pa.binary())

    return run.asNondeterministic()(text)


def decode(ids: Column, path: str) -> Column:
    """The text that token ids, packed as ``encode`` does, stand for; null for null."""

    @arrow_udf("string")
    def run(packed: pa.Array) -> pa.Array:
        model = encoder(path)
        return pa.array([None if p is None else model.decode(p) for p in packed.to_pylist()], pa.string())

    return run.asNondeterministic()(ids)


def round_trip(text: Column, path: str, kept: int = WORDS_KEPT, keep_encoder: bool = True) -> Column:
    """Struct ``ids, decoded``: a text's tokens and the text decoded from them, by one encoder in one pass.

    ``kept``: words a worker holds with their tokens; fewer take less memory and more time.
    ``keep_encoder``: a worker keeps its encoder for its next task; without, each task builds one and
    frees it at its end, so that workers that wait for other stages hold none.
    """

    def coded(texts: pa.Array) -> pa.Array:
        model, ids, decoded = encoder(path, kept), [], []
        for start, end in runs(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
            found = model.encode(texts[start:end].to_pylist())
            ids.append(pa.array(found, pa.binary()))
            decoded.append(pa.array([model.decode(f) for f in found], pa.string()))
        empty = pa.array([], pa.binary()), pa.array([], pa.string())
        columns = [pa.concat_arrays([e, *parts]) for e, parts in zip(empty, (ids, decoded), strict=True)]
        return pa.StructArray.from_arrays(columns, ["ids", "decoded"])

    @arrow_udf("ids binary, decoded string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        try:
            yield from map(coded, batches)
        finally:
            if not keep_encoder:
                forget(path)

    return run.asNondeterministic()(text)


def runs(lengths: list[int]) -> Iterable[tuple[int, int]]:
    """Bounds of runs of texts of about SLICE_CHARS bytes, so that few texts are Python objects at once."""
    start, size = 0, 0
    for at, length in enumerate(lengths, 1):
        size += length
        if size >= SLICE_CHARS or at == len(lengths):
            yield start, at
            start, size = at, 0


def n_tokens(ids: Column) -> Column:
    return (F.octet_length(ids) / 4).cast("long")
