"""The operators against brute force, exact round trips and held-out accuracy, on small tables."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from mentionwise.llm import (
    bpe, chat, decontamination, language, lines, quality, simhash, token_counts, toxicity, urls,
)
from mentionwise.llm.queries import CONTROL_STRINGS, tokenizer_path

DOCS = "doc_id long, text string, lang string, n int"
LONG = " ".join(f"word{k % 977}" for k in range(30_000))
EDGE = [
    (None, "alpha beta gamma", None, 1), (1, None, "en", 2), (2, "", "en", 3), (3, " \n\t ", "en", 4), (4, LONG, "en", 5),
    (5, "same row here", "en", 6), (5, "same row here", "en", 6), (6, "$$$ ### 12", None, 7),
]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(EDGE, DOCS)


def test_token_counts_after_edits_equal_those_of_the_new_text():
    model, rng = bpe.encoder(tokenizer_path()), random.Random(1)
    parts = ["a", "é", "'s", " ", "  ", "\n", "7", "!", " the", "word", "日本", "'", "\n\n   "]
    for _ in range(300):
        text = "".join(rng.choices(parts, k=rng.choice([0, 1, 100, 600])))
        tree = token_counts.grow(text, model)
        for _ in range(4):
            insert = "".join(rng.choices(parts, k=rng.choice([0, 1, 30])))
            text, _ = token_counts.edit(text, tree, rng.randint(0, len(text) + 2), rng.choice([0, 1, 40]), insert, model)
            assert tree.tokens() == sum(len(b) // 4 for b in model.encode([text], specials=False))


def test_bpe_equals_the_library_and_round_trips():
    from tokenizers import Tokenizer

    library, model = Tokenizer.from_file(tokenizer_path()), bpe.encoder(tokenizer_path())
    texts = ["", "Hello  world's\n\n 12", "日本語 éà", "x" * 300, "a<|endoftext|>b", LONG]
    for text, ids in zip(texts, model.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
        assert model.decode(ids) == text


def brute_lines(docs, hashes, threshold=0.8):
    placed = sorted(
        (d is None, d or 0, hashes[d, t], k, line) for d, t in docs for k, line in enumerate((t or "").split("\n"))
    )
    seen, gone = [], set()
    for *at, line in placed:
        words = frozenset(line.lower().split())
        if words and any(len(words & o) / len(words | o) >= threshold and p != at for p, o in seen):
            gone.add(tuple(at))
        if words:
            seen.append((at, words))
    return gone


@pytest.mark.parametrize("first, cell", [(4, 1024), (1, 8)])
def test_line_dedup_equals_brute_force(spark, monkeypatch, first, cell):
    monkeypatch.setattr(lines, "FIRST", first)
    monkeypatch.setattr(lines, "CELL", cell)
    rng = random.Random(3)
    base = [[f"w{rng.randrange(60)}" for _ in range(rng.choice([1, 3, 9, 14]))] for _ in range(25)]

    def changed():
        line = list(rng.choice(base))
        for _ in range(rng.choice([0, 1, 2])):
            line[rng.randrange(len(line))] = f"w{rng.randrange(80)}"
        return " ".join(line)

    docs = [(i if i % 17 else None, "\n".join(changed() for _ in range(rng.randint(0, 6)))) for i in range(100)]
    docs += [(5, None), (6, ""), (7, " \n ")]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    hashes = {(r[0], r[1]): r[2] for r in table.select("doc_id", "text", F.xxhash64("text")).collect()}
    gone = brute_lines(docs, hashes)
    want = []
    for d, t in docs:
        kept = [x for k, x in enumerate((t or "").split("\n")) if (d is None, d or 0, hashes[d, t], k) not in gone]
        want.append((d, None if t is None else "\n".join(kept)))
    got = [(r["doc_id"], r["text"]) for r in lines.remove_repeated(table).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_contamination_of_edge_rows(spark, edge):
    items = spark.createDataFrame([(1, "same row"), (2, None), (3, ""), (None, "alpha beta gamma")], "item_id long, text string")
    got = {r["doc_id"]: r for r in decontamination.contamination(edge, items).collect()}
    assert got[5]["n_hit"] == 2 and got[5]["item_ids"] == ["1"]
    assert got[None]["n_hit"] == 3 and got[None]["item_ids"] == []
    assert got[1]["n_words"] == got[2]["n_words"] == got[4]["n_hit"] == 0
    clashing = edge.withColumn("w", F.lit(8))
    kept = decontamination.keep_clean(clashing, items)
    assert kept.columns == clashing.columns and {r["w"] for r in kept.collect()} == {8} and kept.count() == 5


def test_language_of_held_out_rows(spark, edge):
    rng, words = random.Random(2), {"aa": ["kolo", "mira", "tanu"], "bb": ["gwex", "zhyp", "quif"]}
    rows = [(i, " ".join(rng.choices(words[lang], k=20)), lang, 0) for i in range(60) for lang in words]
    got = language.predict(spark.createDataFrame(rows, DOCS).withColumn("doc_id", F.col("doc_id") * 2 + (F.col("lang") == "bb").cast("int")))
    for r in got.collect():
        assert r["lang_pred"] == ("bb" if r["doc_id"] % 2 else "aa") and 0 <= r["score"] <= 1
    odd = {r["doc_id"]: r["lang_pred"] for r in language.predict(edge).collect()}
    assert odd[1] == odd[2] == odd[3] == odd[6] == "und"
    assert language.predict(edge.limit(0)).count() == 0


def test_url_rules(spark):
    rules = spark.createDataFrame([("net", "/", "block"), ("a.net", "/en/", "allow")], "host string, path string, verdict string")
    urls_ = ["http://X.NET/p?q", "https://b.a.net/en/1#t", "http://a.net/enx", "http://net", None, "net/x", "http://planet/a"]
    pages = spark.createDataFrame(list(enumerate(urls_)), "page_id long, url string").withColumn("rule", F.lit("clash"))
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.judge(pages, rules).collect()}
    assert got == {
        0: ("x.net", "/p", "net/", "block"), 1: ("b.a.net", "/en/1", "a.net/en/", "allow"),
        2: ("a.net", "/enx", "net/", "block"), 3: ("net", "", None, "allow"), 4: ("", "", None, "allow"),
        5: ("", "", None, "allow"), 6: ("planet", "/a", None, "allow"),
    }


def test_simhash_components_equal_brute_force(spark, edge):
    rng = random.Random(4)
    base = " ".join(f"w{rng.randrange(300)}" for _ in range(400))
    rows = [(i, base.replace(f"w{i} ", "") if i % 2 else " ".join(f"v{rng.randrange(99)}" for _ in range(9)), "x", 0) for i in range(80)]
    table = spark.createDataFrame(rows, DOCS).unionByName(edge.where("doc_id is not null").withColumn("doc_id", F.col("doc_id") + 1000))
    found = simhash.near_duplicates(table).collect()
    mark = {r["doc_id"]: r["fp"] & (1 << 64) - 1 for r in found}
    root = {d: d for d in mark}
    for _ in mark:
        for a in mark:
            root[a] = min(root[b] for b in mark if (mark[a] ^ mark[b]).bit_count() <= 3)
    assert {r["doc_id"]: r["component_id"] for r in found} == root


def test_quality_counts_and_model(spark, edge):
    assert quality.base_counts("a b c a b c\n#x\n#x") == (8, 10, 2, 1, 6)
    pairs = quality.count_pairs(edge.select("lang", "text"))
    total = quality.model(pairs).groupBy("before").agg(F.sum(F.exp("log_p")).alias("p")).agg(F.max("p")).first()[0]
    assert total <= 1 + 1e-9
    got = {r["doc_id"]: r for r in quality.judge(edge).collect()}
    assert got[1]["n_words"] == got[2]["n_words"] == 0 and got[1]["base_failed"] and not got[1]["kept"]
    assert quality.judge(edge).count() == len(EDGE) and quality.judge(edge.limit(0)).count() == 0


def test_chat_reads_back_and_masks_assistant_texts(spark):
    texts = [CONTROL_STRINGS, None, "####", "a\\", "<</turn>", "é: 日本\n### x", "</turn>\n### assistant: "]
    rows = [(1, k, "assistant" if k % 2 == 0 else "us: er", t) for k, t in enumerate(texts)]
    got = chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), tokenizer_path()).first()
    assert [(r, t) for r, t, _, _ in chat.parse(got["formatted"])] == [(r, t or "") for _, _, r, t in rows]
    loss = "".join(t or "" for _, _, r, t in rows if r == "assistant")
    assert got["loss_chars"] == len(loss) and got["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()


def test_toxicity_on_held_out_rows(spark, edge):
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        words = [f"w{rng.randrange(200)}q" for _ in range(30)] + (["You", "grunk", "zarf!"] if bad else [])
        rows.append((i, " ".join(words), "en", 0))
        labels.append((i, int(bad)))
    docs = spark.createDataFrame(rows, DOCS)
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = [r for r in toxicity.predict(docs, marks).collect() if r["held_out"]]
    assert all(r["predicted"] == (r["doc_id"] % 4 == 0) for r in got)
    none = toxicity.predict(edge, marks.limit(0)).collect()
    assert len(none) == len(EDGE) and {r["score"] for r in none} == {0.0}
