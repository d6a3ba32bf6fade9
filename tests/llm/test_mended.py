"""Calibration with very many steps, and both directions of BPE in one pass."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from mentionwise.llm import bpe, decontamination, lines, token_counts, toxicity
from mentionwise.llm.queries import op1_token_counts, op3_bpe, tokenizer_path


def test_calibration_of_five_thousand_steps(spark):
    rows = [(float(x), float(x * x)) for x in np.linspace(0, 1, 5000)]
    fitted = toxicity.calibration(spark.createDataFrame(rows, "raw double, label double"))
    bounds, values = np.array(fitted.boundaries), np.array(fitted.predictions)
    assert len(bounds) == 5000
    asked = [(float(x),) for x in np.linspace(-0.2, 1.2, 333)]
    got = fitted.transform(spark.createDataFrame(asked, "raw double")).collect()
    for r in got:
        assert abs(r["score"] - np.interp(r["raw"], bounds, values)) < 1e-12


@pytest.mark.parametrize("keep_encoder", [True, False])
def test_round_trip_over_edges(spark, tmp_path, keep_encoder):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path())
    texts = [None, "", " ", "a<|endoftext|>b", "日本 é" * 300, "same", "same", "x" * 1_200_000, "\x00\n", *[f"w{i} " * 50 for i in range(200)]]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    found = docs.select("doc_id", bpe.round_trip(F.col("text"), tokenizer_path(), keep_encoder=keep_encoder).alias("c")).collect()
    assert len(found) == len(texts)
    for r in found:
        text = texts[r["doc_id"]] or ""
        assert np.frombuffer(r["c"]["ids"], "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
        assert r["c"]["decoded"] == text
    docs.where("false").write.parquet(f"{tmp_path}/documents.parquet")
    assert op3_bpe(spark, str(tmp_path)).count() == 0


def test_token_counts_over_edges(spark, tmp_path):
    texts = [None, "", " ", "don't stop", "日本 é" * 300, "same", "same", "x" * 100_000, *[f"w{i} it's {i}\n\n  " * 40 for i in range(200)]]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    model = bpe.encoder(tokenizer_path())
    count = lambda t: len(model.encode([t], specials=False)[0]) // 4
    edits = F.array(
        F.struct(F.lit(3).alias("at"), F.lit(2).alias("drop"), F.lit(" it's").alias("insert")),
        F.struct(F.lit(10**9).alias("at"), F.lit(None).cast("long").alias("drop"), F.lit(None).cast("string").alias("insert")),
    )
    for edits_of in (edits, F.lit(None).cast(token_counts.EDITS)):
        for r in token_counts.edited_counts(docs, edits_of, tokenizer_path()).collect():
            old = texts[r["doc_id"]] or ""
            new = old[:3] + " it's" + old[5:] if edits_of is edits else old
            e = r["edited"]
            same = (e["text"], e["n_before"], e["n_tokens"], sum(e["leaf_tokens"])) == (new, count(old), count(new), count(new))
            assert same, r["doc_id"]
    stored = docs.withColumn("tree", token_counts.build(F.col("text"), tokenizer_path()))
    again = stored.select("doc_id", token_counts.apply_edits(F.col("text"), F.col("tree"), edits.cast(token_counts.EDITS), tokenizer_path()).alias("e"))
    assert all(r["e"]["n_tokens"] == count(r["e"]["text"]) for r in again.collect())
    assert op1_token_counts(spark, str(tmp_path)).count() == len(texts)
    docs.where("false").write.parquet(f"{tmp_path}/none/documents.parquet")
    assert op1_token_counts(spark, f"{tmp_path}/none").count() == 0


def brute_contamination(docs, items, size=10, span=10):
    """Exact and proximity matches by scanning every text, row by row."""
    import re
    from collections import Counter

    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    texts = [split(t) for _, t in docs]
    n = Counter(w for t in texts for w in t)
    cut = []
    for item, text in items:
        w = split(text)
        cut += [(item, w[i:i + size]) for i in range(max(len(w) - size + 1, 1))] if w else []
    out = []
    for (doc_id, _), t in zip(docs, texts, strict=True):
        hit, found, near = set(), set(), set()
        for item, phrase in cut:
            for i in range(len(t) - len(phrase) + 1):
                if t[i:i + len(phrase)] == phrase:
                    hit |= set(range(i, i + len(phrase)))
                    found.add(item)
            rare = sorted(set(phrase), key=lambda w: (n[w], w))[:2]
            at = [[i for i, w in enumerate(t) if w == r] for r in rare]
            if n[rare[0]] and any(abs(a - b) <= span for a in at[0] for b in at[-1]):
                near.add(item)
        names = [sorted(str(i) for i in s if i is not None) for s in (found, near)]
        out.append((doc_id, len(t), len(hit), *names))
    return sorted(out, key=str)


def test_decontamination_equals_brute_force(spark):
    rng = np.random.default_rng(6)
    word = lambda: f"w{rng.integers(12)}"
    items = [(i, " ".join(word() for _ in range(rng.choice([1, 4, 10, 13])))) for i in range(12)]
    items += [(None, "w1 w2 W3"), (90, None), (91, " "), (92, "never seen words"), (3, items[3][1])]
    docs = [(i if i % 5 else None, " ".join(word() for _ in range(rng.integers(60)))) for i in range(60)]
    docs += [(100 + i, f"x {items[i][1].upper()}, y {items[i][1]}") for i in range(6)] * 2
    docs += [(None, None), (None, None), (7, ""), (8, "z " * 30_000 + items[4][1])]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    for size, span in ((10, 10), (4, 6)):
        got = sorted((tuple(r) for r in decontamination.contamination(table, bench, size, span).collect()), key=str)
        assert got == brute_contamination(docs, items, size, span)
    clean = {(d, t) for (d, t), r in zip(docs, [brute_contamination([x], items)[0] for x in docs], strict=True) if not r[2]}
    odd = table.select("*", F.lit(1).alias("a.b"), F.lit(2).alias("key"), F.lit(3).alias("found"))
    kept = decontamination.keep_clean(odd, bench)
    assert kept.columns == odd.columns and {(r["doc_id"], r["text"]) for r in kept.collect()} == clean
    assert decontamination.contamination(table.limit(0), bench).count() == 0
    untouched = decontamination.contamination(table, bench.limit(0)).collect()
    assert len(untouched) == len(docs) and not any(r["n_hit"] or r["near_ids"] for r in untouched)


def test_line_dedup_over_edges(spark):
    rows = [(None, None), (None, "a b c\na b c"), (None, "a b c\na b c"), (1, ""), (1, "w " * 1_000_000 + "\nnew"), (2, "C a b"), (2, "C a b"), (3, "\n\n x")]
    table = spark.createDataFrame(rows, "doc_id long, text string").withColumn("a.b", F.lit(1)).withColumn("class", F.lit(2))
    got = lines.remove_repeated(table)
    assert got.columns == [*table.columns, "__n_removed"]
    kept = sorted(((r["doc_id"], r["text"], r["__n_removed"]) for r in got.collect()), key=str)
    want = [(None, None, 0), (None, "", 2), (None, "", 2), (1, "", 0), (1, rows[4][1], 0), (2, "C a b", 0), (2, "C a b", 0), (3, "\n\n x", 0)]
    assert kept == sorted(want, key=str)
    assert lines.remove_repeated(table.limit(0)).count() == 0


def test_word_sets_equal_plain_sets():
    given = [
        "Ab b\tAB é É x", "", " ", "x" * 64 + " " + "x" * 65 + " " + "X" * 65 + "\x0b" + "x" * 66, "\xa0a a\u2028b", "日本 é" * 30,
        *[f"w{i % 7} W{i % 5} {'v' * (i % 70)}" for i in range(300)],
    ]
    rows, hashes = lines.word_sets(given)
    plain = [set(x.encode().lower().split()) for x in given]
    assert np.bincount(rows, minlength=len(given)).tolist() == list(map(len, plain))
    # one hash for a word wherever it stands, another for another
    of = {w: int(lines.word_sets([w.decode()])[1][0]) for w in set().union(*plain)}
    assert len(set(of.values())) == len(of)
    for k, words in enumerate(plain):
        assert set(hashes[rows == k].tolist()) == {of[w] for w in words}
    many = ["a b"] * 70_000
    assert np.array_equal(lines.word_sets(many)[0], np.repeat(np.arange(70_000), 2))
    assert [len(x) for x in lines.word_sets([])] == [0, 0]


def test_levels_keep_the_order_of_counts():
    found = lines.levels(np.array([0, 1, 2, 3, 100, 101, 1 << 50])).tolist()
    assert found[:2] == [0, 0] and 0 < found[2] < found[3] < found[4] < found[5] < found[6]


def test_line_dedup_verifies_few_pairs_of_long_unlike_lines(spark, monkeypatch):
    rng = np.random.default_rng(2)
    texts = [" ".join(f"w{k}" for k in rng.choice(3000, 150, replace=False)) for _ in range(400)]
    # a near copy of each eighth line, at the end
    texts += [x + " more" for x in texts[::8]]
    real, asked = lines.verified, []

    def counted(pairs, *rest):
        asked.append(pairs.count())
        return real(pairs, *rest)

    monkeypatch.setattr(lines, "verified", counted)
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    gone = sorted(r["doc_id"] for r in lines.remove_repeated(table).where("__n_removed > 0").collect())
    assert gone == list(range(400, 450))
    assert sum(asked) <= len(texts)


def test_similar_sets_share_a_signature():
    rng = np.random.default_rng(4)
    rare = rng.integers(0, 0xFFFF, lines.COUNTERS).astype(np.uint16)
    for threshold in (0.4, 0.8, 1.0):
        for _ in range(200):
            n = int(rng.choice([1, 2, 4, 5, 7, 8, 15, 16, 30, 33, 60, 64, 130]))
            first = rng.integers(0, 1 << 63, n).astype(np.uint64)
            second = first.copy()
            keep = int(rng.integers(int(np.ceil(threshold * n - 1e-9)), n + 1))
            second = second[:keep]
            while rng.random() < 0.7:
                grown = np.append(second, rng.integers(0, 1 << 63, dtype=np.uint64))
                if keep / (n + len(grown) - keep) < threshold:
                    break
                second = grown
            assert keep / (n + len(second) - keep) >= threshold - 1e-9
            sets = [np.sort(first), np.sort(second)]
            size = np.array(list(map(len, sets)))
            own, sig = lines.signatures(size, np.repeat([0, 1], size), np.concatenate(sets), rare, threshold)
            assert set(sig[own == 0].tolist()) & set(sig[own == 1].tolist())
