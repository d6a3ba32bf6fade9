"""Alignment, Merkle manifest and WARC archives against plain code, with their edge cases."""

import bisect
import hashlib
import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from mentionwise.llm import alignment, merkle, warc
from mentionwise.llm.bpe import byte_alphabet
from mentionwise.llm.queries import op11_alignment, op12_merkle, op13_warc, tokenizer_path

PATHS = tokenizer_path(), tokenizer_path("piece_bpe_32k.model")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
BIG = 9223372036854775807


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


# ---- alignment

def plain_alignment(texts):
    """Per text: n_a, n_b, n_groups, n_links, groups, n_best, count_sum; all from decoded bytes."""
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(PATHS[0]), sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    a.encode_special_tokens = True
    alphabet = byte_alphabet()
    rows, held = [], Counter()
    for text in texts:
        a_ids = a.encode(" " + (text or ""), add_special_tokens=False).ids
        b_ids = b.encode(text or "")
        a_bytes = [bytes(alphabet[c] for c in a.id_to_token(i)) for i in a_ids]
        b_bytes = [
            bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()
            for i in b_ids for p in [b.id_to_piece(i)]
        ]
        raw = (" " + (text or "")).encode()
        if not text or b"".join(a_bytes) != raw or b"".join(b_bytes) != raw:
            rows.append(None)
            continue
        ends = [list(itertools.accumulate(map(len, x))) for x in (a_bytes, b_bytes)]
        cuts = sorted(set(ends[0]) & set(ends[1]))
        groups = [([], []) for _ in cuts]
        for side, (ids, own) in enumerate(zip((a_ids, b_ids), ends)):
            for i, e in zip(ids, own):
                groups[bisect.bisect_left(cuts, e)][side].append(i)
        pairs = Counter((i, j) for x, y in groups for i in x for j in y)
        held.update(set(pairs))
        rows.append((len(a_ids), len(b_ids), groups, pairs))
    highest = defaultdict(int)
    for (i, _), n in held.items():
        highest[i] = max(highest[i], n)
    out = []
    for row in rows:
        if row is None:
            out.append((0, 0, 0, 0, "", 0, 0))
            continue
        n_a, n_b, groups, pairs = row
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        best = sum(n for p, n in pairs.items() if held[p] == highest[p[0]])
        out.append((n_a, n_b, len(groups), sum(pairs.values()), text, best, sum(n * held[p] for p, n in pairs.items())))
    return out


def odd_texts():
    rng = random.Random(5)
    parts = [
        "the", " ", "  ", "naïve", "日本語", "\U0001F9FF", "\U0001F468‍\U0001F469", "é", "é", "\n\n", "\t", "12345", "ß", "<|endoftext|>",
        "<unk>", "<0x41>", "Übergröße", "▁", "\x00", "don't", "ЖЖ", "กขค", "𝔘𝔫𝔦", "aaaaaaa", "...", "　", "ﬁ",
    ]
    texts = ["".join(rng.choices(parts, k=rng.choice([1, 2, 8, 40]))) for _ in range(200)]
    return [None, "", " ", "  a  ", "x" * 5000, "=" * 3000 + "日" * 500, " ".join(f"word{k % 977}" for k in range(20_000)), *texts,
            *["one text many times over"] * 60]


@pytest.mark.parametrize("block_pairs, at_once", [(400_000, 4096), (50, 3)])
def test_alignment_equals_plain_code(spark, block_pairs, at_once):
    texts = odd_texts()
    docs = spark.createDataFrame([(i if i % 9 else None, t, i) for i, t in enumerate(texts)], "doc_id long, text string, row int")
    found = alignment.scored(alignment.linked(docs, *PATHS, block_pairs=block_pairs, paired_at_once=at_once))
    got = {r["row"]: r for r in found.collect()}
    for i, want in enumerate(plain_alignment(texts)):
        r = got[i]
        same = (r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["groups"], r["n_best"], r["count_sum"]) == want
        assert same, i
        assert r["doc_id"] == (i if i % 9 else None)


def test_spans_cut_whole_characters_and_single_bytes():
    model = alignment.aligner(*PATHS)
    for text in odd_texts():
        found = model.spans(text)
        if found:
            a_ids, a_ends, b_ids, b_ends, cuts = (x.tolist() for x in found)
            held = [
                a_ends == list(itertools.accumulate(len(model.bytes_a[i]) for i in a_ids)),
                b_ends == list(itertools.accumulate(len(model.bytes_b[i]) for i in b_ids)),
                cuts == sorted(set(a_ends) & set(b_ends)),
            ]
            assert all(held)


@pytest.mark.parametrize("words_kept", [100, 100_000])
def test_words_cut_alone_give_the_cuts_of_the_whole_text(words_kept):
    model = alignment.aligner(*PATHS)
    assert model.apart
    read = alignment.Documents(model, words_kept=words_kept)
    rng = random.Random(8)
    parts = ["a", "B", " ", "  ", "\n", "\t", "\u3000", "\x85", "\x1c", "\u200b", "\u180e", "1", "!", "'s", "é", "日", "\u0301", "½", "\xa0"]
    texts = ["".join(rng.choices(parts, k=rng.randint(1, 12))) for _ in range(3000)] + ["", " ", "a▁b c", "x" * 300 + " b"]
    for text, found in zip(texts * 2, [*read.of(pa.array(texts)), *read.of(pa.array(texts))], strict=True):
        whole = model.spans(text)
        if whole is None:
            assert found is None, repr(text)
            continue
        a_ids, a_ends, b_ids, b_ends, cuts = whole
        ga, gb = np.searchsorted(cuts, a_ends), np.searchsorted(cuts, b_ends)
        pairs, weights = alignment.links(a_ids, ga, b_ids, gb, len(cuts))
        same = found[0][:3] == (len(a_ids), len(b_ids), len(cuts)) and found[0][4] == alignment.groups_text(a_ids, ga, b_ids, gb)
        assert same and found[1].tolist() == pairs.tolist() and found[2].tolist() == weights.tolist(), repr(text)


def test_alignment_clashing_columns_and_empty_table(spark):
    schema = "doc_id long, text string, n_a string, block string, `a.b` int, `at` int"
    found = alignment.scored(alignment.linked(spark.createDataFrame([(1, "two words", "x", "y", 3, 4)], schema), *PATHS))
    row = found.first()
    assert row["n_a"] == 2 and row["a.b"] == 3 and row["at"] == 4 and "block" not in found.columns
    assert alignment.scored(alignment.linked(spark.createDataFrame([], schema), *PATHS)).count() == 0


def test_op11_query(spark, tmp_path):
    texts = odd_texts()[:40]
    spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    want = plain_alignment(texts)
    for r in op11_alignment(spark, str(tmp_path)).collect():
        groups = want[r["doc_id"]][4]
        assert r["groups_sha256"] == (sha(groups) if groups else "") and r["n_links"] == want[r["doc_id"]][3]


# ---- Merkle

def plain_tree(hashes, fanout=2):
    """Root, and each leaf's siblings from bottom to top."""
    proofs, at, nodes = [[] for _ in hashes], list(range(len(hashes))), list(hashes)
    while len(nodes) > 1:
        for k, i in enumerate(at):
            run = range(i - i % fanout, min(len(nodes), i - i % fanout + fanout))
            proofs[k] += [nodes[j] for j in run if j != i]
        nodes = [sha(*nodes[i:i + fanout]) for i in range(0, len(nodes), fanout)]
        at = [i // fanout for i in at]
    return nodes[0], proofs


def plain_leaf(values):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def plain_manifest(docs, fanout=2):
    """Rows (doc_id, leaf, subroot, root, proof) in any order."""
    if not docs:
        return []
    groups = defaultdict(list)
    for doc_id, text, lang, source, n in docs:
        groups[lang].append((doc_id is not None, doc_id or 0, plain_leaf((doc_id, source, lang, n, text)), doc_id))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = [plain_tree([x[2] for x in sorted(groups[g], key=lambda x: x[:3])], fanout) for g in order]
    root, tops = plain_tree([t[0] for t in trees], fanout)
    return [
        (x[3], x[2], subroot, root, "".join(p) + "".join(top))
        for g, (subroot, proofs), top in zip(order, trees, tops)
        for x, p in zip(sorted(groups[g], key=lambda x: x[:3]), proofs)
    ]


def some_docs():
    rng = random.Random(7)
    docs = [
        (i, "text é " * rng.randint(0, 4) or None, rng.choice(["en", "de", "é", "zz", None, ""]), rng.choice(["web", None]), rng.choice([5, None, BIG]))
        for i in range(300)
    ]
    return docs + [(None, None, "en", None, None)] * 3 + [(9000, "same", "en", "web", 4)] * 90 + [(1, "only", "lone", "x", 1)]


@pytest.mark.parametrize("fanout, at_once, broadcast", [(2, 9, 1 << 24), (2, 2, 0), (3, 2, 0)])
def test_manifest_equals_plain_code(spark, monkeypatch, fanout, at_once, broadcast):
    monkeypatch.setattr(merkle, "LEVELS_AT_ONCE", at_once)
    monkeypatch.setattr(merkle, "BROADCAST_BYTES", broadcast)
    docs = some_docs()
    table = spark.createDataFrame(docs, DOCS)
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    changed = {"n_chars": F.when(F.col("doc_id") % 5 == 0, F.col("n_chars").cast("decimal(38,0)") + 1)}
    rows = merkle.verified(merkle.manifest(table, fields, changed=changed, fanout=fanout), fanout).collect()
    got = [(r["doc_id"], r["leaf"], r["subroot"], r["root"], r["proof"] + r["group_proof"]) for r in rows]
    assert Counter(got) == Counter(plain_manifest(docs, fanout))
    by_id = {d[0]: d for d in docs[:300]}
    for r in rows:
        d = by_id.get(r["doc_id"])
        if d and r["lang"] == d[2] and d[0] % 5 == 0 and d[4] is not None:
            assert not r["verified"] and r["folded_root"] != r["root"]
            assert r["changed_leaf"] == plain_leaf((d[0], d[3], d[2], d[4] + 1, d[1]))
        elif d and r["lang"] == d[2]:
            assert r["verified"] and r["changed_leaf"] is None


@pytest.mark.parametrize("sizes", [[], [1], [1, 2, 3, 8, 9]])
def test_manifest_sizes(spark, sizes):
    docs = [(i, f"t{i}", f"group{n}", "s", 1) for n in sizes for i in range(n)]
    made = merkle.manifest(spark.createDataFrame(docs, DOCS), ["doc_id", "source", "lang", "n_chars", "text"])
    got = [(r["doc_id"], r["leaf"], r["subroot"], r["root"], r["proof"] + r["group_proof"]) for r in merkle.verified(made).where("verified").collect()]
    assert Counter(got) == Counter(plain_manifest(docs))


def test_manifest_ignores_other_columns(spark):
    rows = [(1, "a", "en", 1, 2, 3), (2, "b", None, 1, 2, 3)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, `row` int, `a.b` int, tree int")
    assert merkle.verified(merkle.manifest(table, ["doc_id", "a.b", "text"])).where("verified").count() == 2


def test_op12_query_tells_tampered_rows(spark, tmp_path):
    import zlib

    docs = some_docs()
    spark.createDataFrame(docs, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    rows = op12_merkle(spark, str(tmp_path)).collect()
    want = Counter((d, leaf, sub, root, sha(p)) for d, leaf, sub, root, p in plain_manifest(docs))
    assert Counter((r["doc_id"], r["leaf"], r["subroot"], r["root"], r["proof_sha256"]) for r in rows) == want
    chars = {plain_leaf((d[0], d[3], d[2], d[4], d[1])): d[4] for d in docs}
    for r in rows:
        tampered = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0 and chars[r["leaf"]] is not None
        assert r["verified"] is (not tampered) and r["verified"] is (r["folded_root"] == r["root"])


# ---- WARC

def plain_digest(body):
    import base64

    return base64.b32encode(hashlib.sha1(body.encode()).digest()).decode()


def plain_records(pages, min_bytes=0):
    first = {}
    for i, _, html in pages:
        first[html or ""] = max(first.get(html or "", -1), -1 if i is None else i)
    out = []
    for i, _, html in pages:
        body = html or ""
        target = first[body] if first[body] >= 0 else None
        again = len(body.encode()) >= min_bytes and i != target
        out.append((i, len(body.encode()), plain_digest(body), "revisit" if again else "response", target if again else None))
    return Counter(out)


def trap_pages():
    inner = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x:1>\r\nContent-Type: text/plain\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    pages = [(i, f"http://a.example/{i}", f"<p>{i}</p>" * (i % 7)) for i in range(60)]
    pages += [(100, "u\r\nContent-Length: 5", inner * 3), (101, None, inner), (102, "", "x" + inner + "WARC/1.1\r\n"), (103, "v", "WARC/1.1\r\n" * 40)]
    pages += [(104, "w", "WARC/1.1\r\nContent-Length: 99999\r\nWARC-Record-ID: <x>\r\n\r\nshort"), (105, "é", "日本" * 3000), (106, "q", inner + "y" * 5000 + inner)]
    pages += [(107, "w", "WARC/1.1\r\nContent-Length: 9" + "9" * 30 + "\r\nWARC-Record-ID: <x>\r\n\r\n"), (108, "big", "line\r\n\r\n" * 4000 + inner)]
    pages += [(None, "n", "none"), (None, None, "none"), (None, "n", "other"), (200, "r", "rep"), (200, "r", "rep"), (7, "r", "rep"), (8, None, None)]
    return pages + [(1000 + i, "hot", "the same page") for i in range(60)]


@pytest.mark.parametrize("split, broadcast", [("128m", 200_000), ("6k", 0)])
def test_archives_equal_plain_code(spark, tmp_path, monkeypatch, split, broadcast):
    monkeypatch.setattr(warc, "BROADCAST_ROWS", broadcast)
    pages = trap_pages()
    random.Random(2).shuffle(pages)
    table = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(2)
    held = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1b" if split == "6k" else "4m")
    try:
        warc.write_archives(warc.records_of(table), f"{tmp_path}/w")
        found = warc.read_archives(spark, f"{tmp_path}/w").cache()
        facts = found.withColumns({"n": F.octet_length("payload").cast("long"), "sha1": F.sha1("payload")})
        got = warc.resolved(facts, ["n", "sha1"]).withColumn("digest", warc.base32(F.col("sha1"))).collect()
        back = {r["page_id"]: bytes(r["payload"]).decode() for r in found.select(warc.field(F.col("head"), "Page-ID").alias("page_id"), "payload", "head").where(
            warc.field(F.col("head"), "WARC-Type") == "response").collect()}
        said = found.select(warc.field(F.col("head"), "WARC-Payload-Digest").alias("d"), "payload").where(F.length("payload") > 0).collect()
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    as_int = lambda x: None if x is None else int(x)
    rows = Counter((as_int(r["page_id"]), r["n"], r["digest"], r["record_type"], as_int(r["refers_to"])) for r in got)
    assert rows == plain_records(pages)
    for i, _, html in pages:
        if i is not None and 100 <= i < 150:
            same = back[str(i)] == (html or "")
            assert same, i
    assert all(r["d"] == "sha1:" + plain_digest(bytes(r["payload"]).decode()) for r in said)


def test_files_are_whole_warc_records(spark, tmp_path):
    pages = [(1, "http://a", "x"), (2, "http://b", "x"), (3, None, "yé")]
    warc.write_archives(warc.records_of(spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1)), f"{tmp_path}/w")
    data = b"".join(p.read_bytes() for p in sorted((tmp_path / "w").glob("part-*")))
    at, kinds = 0, []
    while at < len(data):
        head = re.match(rb"WARC/1\.1\r\n(.*?)\r\n\r\n", data[at:], re.S)
        lines = dict(line.split(b": ", 1) for line in head[1].split(b"\r\n"))
        at += head.end() + int(lines[b"Content-Length"])
        assert data[at:at + 4] == b"\r\n\r\n"
        at += 4
        kinds.append((lines[b"WARC-Type"], lines[b"Page-ID"]))
    assert sorted(kinds) == [(b"response", b"2"), (b"response", b"3"), (b"revisit", b"1")]


def test_broken_and_foreign_files(spark, tmp_path):
    good = b"WARC/1.1\r\nWARC-Record-ID: <a>\r\nContent-Length: 2\r\n\r\n\xff\xfe\r\n\r\n"
    folder = tmp_path / "w"
    folder.mkdir()
    (folder / "a.warc").write_bytes(good * 3 + b"junk" + good)
    (folder / "b.warc").write_bytes(b"junk" + good)
    (folder / "c.warc").write_bytes(good + good[:-3])
    (folder / "d.warc").write_bytes(b"")
    rows = warc.read_archives(spark, str(folder)).collect()
    assert Counter(r["file"].rsplit("/", 1)[1] for r in rows) == {"a.warc": 3, "c.warc": 1}
    assert {bytes(r["payload"]) for r in rows} == {b"\xff\xfe"}


def test_min_bytes_and_empty_table(spark, tmp_path):
    pages = [(1, "a", "xy"), (2, "b", "xy"), (3, "c", "long enough"), (4, "d", "long enough")]
    table = spark.createDataFrame(pages, "page_id long, url string, html string")
    warc.write_archives(warc.records_of(table, min_bytes=5), f"{tmp_path}/w")
    got = warc.resolved(warc.read_archives(spark, f"{tmp_path}/w", {"n": F.octet_length}), ["n"])
    assert sorted(r["page_id"] for r in got.where("record_type = 'revisit'").collect()) == ["3"]
    warc.write_archives(warc.records_of(table.where("false")), f"{tmp_path}/e")
    assert warc.read_archives(spark, f"{tmp_path}/e").count() == 0


def test_op13_query(spark, tmp_path):
    pages = trap_pages()
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    rows = op13_warc(spark, str(tmp_path)).collect()
    assert Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in rows) == plain_records(pages)
