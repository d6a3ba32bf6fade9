"""Perplexity by blocks of documents: equal to plain counting, and small on disk."""

import math
import random
from collections import Counter, defaultdict
from pathlib import Path

import pytest

from mentionwise.llm import quality

SCHEMA = "doc_id long, lang string, text string"


def plain(rows):
    """log perplexity of each text by counting in dicts."""
    texts = [(lang, ["", *(text or "").split()]) for _, lang, text in rows]
    out = []
    models = {}
    for lang in {x for x, _ in texts}:
        pairs = Counter(p for x, w in texts if x == lang for p in zip(w, w[1:]))
        total, back, kinds = Counter(), Counter(), defaultdict(Counter)
        for (v, w), n in pairs.items():
            total[v] += n
            back[w] += 1
            kinds[v][min(n, 3)] += 1
        c = Counter(pairs.values())
        y = c[1] / (c[1] + 2 * c[2]) if c[1] + 2 * c[2] else 0.5
        d = {k: max(min(k - (k + 1) * y * c[k + 1] / c[k] if c[k] else 0.5, k), 0.05) for k in (1, 2, 3)}
        models[lang] = pairs, total, back, kinds, d
    for lang, words in texts:
        pairs, total, back, kinds, d = models[lang]
        logs = []
        for v, w in zip(words, words[1:]):
            n = pairs[v, w]
            left = sum(d[k] * kinds[v][k] for k in d)
            logs.append(math.log(max(n - d[min(n, 3)], 0) / total[v] + left / total[v] * back[w] / len(pairs)))
        out.append(-sum(logs) / len(logs) if logs else None)
    return out


def texts():
    rng = random.Random(8)
    words = [f"w{int(rng.paretovariate(0.6)) % 400}" for _ in range(3000)]
    rows = [(i % 70, rng.choice(["en", "de", None]), " ".join(rng.choices(words, k=rng.randrange(1, 90)))) for i in range(90)]
    hot = " ".join(["same"] * 300 + ["end"])
    return rows + [rows[0], rows[0], (None, "en", hot), (None, "en", hot), (5, "fr", "one"), (6, "fr", None), (6, None, " \n")]


@pytest.mark.parametrize("block_words, shard", [(100, 40), (quality.BLOCK_WORDS, quality.SHARD)])
def test_perplexity_equals_plain_counting(spark, block_words, shard):
    rows = texts()
    order = lambda r: (str(r[0]), str(r[1]), r[2] or 0, r[3] or 0)
    want = sorted(((d, x, len((t or "").split()), p) for (d, x, t), p in zip(rows, plain(rows))), key=order)
    found = quality.perplexity(spark.createDataFrame(rows, SCHEMA).repartition(3), block_words, shard)
    got = sorted(((r["doc_id"], r["lang"], r["n_words"], r["log_ppl"]) for r in found.collect()), key=order)
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert [r[3] is None for r in got] == [r[3] is None for r in want]
    assert [r[3] or 0 for r in got] == pytest.approx([r[3] or 0 for r in want], rel=1e-12)


def test_steps_are_small_and_go(spark):
    rng = random.Random(9)
    rows = [(i, "en", " ".join(f"{rng.randrange(3000):x}" for _ in range(500))) for i in range(100)]
    size = sum(len(t) for _, _, t in rows)
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.rglob("*.parquet"))
    kept = {r["doc_id"] for r in quality.judge(spark.createDataFrame(rows, SCHEMA)).collect()}
    left = sum(f.stat().st_size for f in set(shared.rglob("*.parquet")) - before if f.is_file())
    # every word pair as a row of hashes and counts is several times the texts
    assert len(kept) == 100 and left < size / 2
