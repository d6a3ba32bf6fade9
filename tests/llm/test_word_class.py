"""Words of the decontamination: a class without ranges that holds the same characters as the ranges."""

import re

from pyspark.sql import functions as F

from mentionwise.llm.decontamination import WORD, words

RANGES = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def test_class_is_spelled_out_and_holds_the_same_characters(spark):
    assert "-" not in WORD
    every = [chr(c) for c in [*range(0x300), 0x2028, 0xD7FF, 0xE000, 0xFFFD, 0xFFFF, 0x10000, 0x1F600, 0x10FFFF]]
    texts = [f"a{c}b" for c in every] + ["", None, "".join(every), "É1 x-Y_z 日本 don't"]
    lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    rows = spark.createDataFrame(list(enumerate(texts)), "i INT, text STRING").select("i", words(F.col("text")).alias("w"))
    found = {r["i"]: r["w"] for r in rows.collect()}
    assert found == {i: re.findall(RANGES, lower(t)) for i, t in enumerate(texts)}
