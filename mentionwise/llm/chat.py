"""Chat formatting with a loss mask aligned by offsets.

A conversation is rendered whole: each turn is ``### role: text</turn>`` and a
newline. Backslashes and the beginnings of control strings inside roles and texts
get a backslash before them, so the rendering reads back exactly. It is encoded
once; the spans of the assistant's texts, sorted, meet the sorted token spans by
binary search, and a token that touches one is under the loss mask.

A conversation is one row, so it is held by one task: turns of it, not rows of the
table, bound that. Order: turn (null first), role, text.

Edge cases: null text or role is empty; a null conv_id is one conversation; repeated
turns stay, each a turn; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

# fixed values of the template
OPEN, SEP, CLOSE, END = "### ", ": ", "</turn>", "\n"
TO_ESCAPE = re.compile(r"\\|#(?=##)|<(?=/turn>)|:(?= )")
ESCAPED = re.compile(r"\\(.)", re.DOTALL)
TURN = re.compile(
    r"### ((?:[^\\:]++|\\.|:(?! ))*+): ((?:[^\\<]++|\\.|<(?!/turn>))*+)</turn>\n", re.DOTALL
)
TRAINED_ROLE = "assistant"


def escape(text: str) -> str:
    return TO_ESCAPE.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


def render(turns: list[tuple[str, str]]) -> str:
    """The rendering of (role, text) turns."""
    return "".join(f"{OPEN}{escape(r)}{SEP}{escape(t)}{CLOSE}{END}" for r, t in turns)


def parse(formatted: str) -> list[tuple[str, str, int, int]]:
    """(role, text, start, end) of each turn; the span is that of the escaped text."""
    found, at = [], 0
    while at < len(formatted):
        m = TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at character {at}")
        found.append((unescape(m[1]), unescape(m[2]), *m.span(2)))
        at = m.end()
    return found


@lru_cache(maxsize=4)
def tokenizer(path: str):
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(path)
    made.no_padding()
    made.no_truncation()
    made.encode_special_tokens = True
    return made


def loss_mask(offsets: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """For each token: does it touch one of the spans? Both sorted, spans apart from each other."""
    if not len(spans) or not len(offsets):
        return np.zeros(len(offsets), bool)
    # the first span that ends after the token starts
    nearest = np.searchsorted(spans[:, 1], offsets[:, 0], side="right")
    inside = np.minimum(nearest, len(spans) - 1)
    return (nearest < len(spans)) & (spans[inside, 0] < offsets[:, 1])


def masked_text(formatted: str, offsets: np.ndarray, mask: np.ndarray, spans: np.ndarray) -> list[str]:
    """What the masked tokens cover of each span, unescaped."""
    out = []
    for start, end in spans.tolist():
        first, last = np.searchsorted(offsets[:, 1], start, side="right"), np.searchsorted(offsets[:, 0], end)
        covered = np.zeros(end - start, np.int8)
        for a, b in offsets[first:last][mask[first:last]].tolist():
            covered[max(a - start, 0):b - start] = 1
        piece = formatted[start:end]
        out.append(unescape(piece if covered.all() else "".join(c for c, k in zip(piece, covered) if k)))
    return out


RESULT = (
    "formatted string, n_tokens long, n_loss_tokens long, mask binary, n_turns long, turns_sha256 string, "
    "loss_chars long, loss_sha256 string, formatted_chars long"
)


def digest(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def format_one(turns: list[tuple[str, str]], path: str) -> tuple:
    formatted = render(turns)
    offsets = np.array(tokenizer(path).encode(formatted, add_special_tokens=False).offsets, np.int64).reshape(-1, 2)
    read = parse(formatted)
    # a text without characters has no span
    spans = np.array([(a, b) for r, _, a, b in read if r == TRAINED_ROLE and b > a], np.int64).reshape(-1, 2)
    mask = loss_mask(offsets, spans)
    loss = "".join(masked_text(formatted, offsets, mask, spans))
    shown = "".join(f"{r}\n{t}\n" for r, t, _, _ in read)
    return (
        formatted, len(offsets), int(mask.sum()), np.packbits(mask).tobytes(), len(read), digest(shown),
        len(loss), digest(loss), len(formatted),
    )


def formatted(turns: Column, path: str) -> Column:
    """Struct of the rendering, its mask (packed bits, one for each token) and digests read back from them."""

    @arrow_udf(RESULT)
    def run(conversations: pa.Array) -> pa.Array:
        rows = [format_one([(t["role"], t["text"]) for t in c.as_py()], path) for c in conversations]
        types = [tuple(c.split()) for c in RESULT.split(", ")]
        kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
        columns = zip(*rows) if rows else [[]] * len(types)
        arrays = [pa.array(c, kinds[k]) for c, (_, k) in zip(columns, types, strict=True)]
        return pa.StructArray.from_arrays(arrays, [n for n, _ in types])

    return run(turns)


def format_conversations(turns: DataFrame, path: str) -> DataFrame:
    """One row for each conversation of ``turns`` (``conv_id, turn, role, text``): ``conv_id`` and RESULT."""
    empty = F.lit("")
    row = F.struct("turn", F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text"))
    whole = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(row)).alias("turns"))
    return whole.select("conv_id", formatted(F.col("turns"), path).alias("f")).select("conv_id", "f.*")
