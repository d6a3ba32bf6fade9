"""The second comparison of lines, workers that wait, and ids written as text."""

import numpy as np
import pytest

from mentionwise.llm import alignment, lines, memory


def test_only_lists_with_an_undecided_class_are_compared_again(spark, monkeypatch):
    # lines that resemble each other as far as sketches of so many words tell, but not enough, and pairs that match at once
    shared = " ".join(f"w{i}" for i in range(300))
    apart = [" ".join([shared, *(f"own{k}x{i}" for i in range(100))]) for k in range(12)]
    pairs = [line for k in range(60) for line in (f"{k} " + " ".join(f"p{k}x{i}" for i in range(10)), " ".join(f"p{k}x{i}" for i in range(10)))]
    table = spark.createDataFrame(list(enumerate(apart + pairs)), "doc_id long, text string")
    real, seen = lines.candidates, []

    def spied(index, *rest):
        seen.append((index.count(), index.select("sig").distinct().count(), index.where("open").select("sig").distinct().count()))
        return real(index, *rest)

    monkeypatch.setattr(lines, "candidates", spied)
    monkeypatch.setattr(lines, "FIRST", 1)
    gone = {r["doc_id"] for r in lines.remove_repeated(table).where("__n_removed > 0").collect()}
    sets = [set(x.split()) for x in apart + pairs]
    plain = {
        i for i, a in enumerate(sets) if any(len(a & b) >= 0.8 * len(a | b) - 1e-9 for b in sets[:i])
    }
    assert gone == plain
    assert len(seen) == 2 and seen[1][0] < seen[0][0]
    assert seen[1][1] == seen[1][2]


def test_a_worker_gives_back_memory_when_its_task_ends(monkeypatch):
    calls = []
    monkeypatch.setattr(memory, "release", lambda: calls.append(1))

    def broken(batches):
        yield from batches
        raise ValueError("broken")

    assert list(memory.tidy(iter)([1, 2])) == [1, 2] and len(calls) == 1
    with pytest.raises(ValueError, match="broken"):
        list(memory.tidy(broken)([1]))
    assert len(calls) == 2


def test_ids_are_written_in_decimal():
    rng = np.random.default_rng(3)
    for high in (1, 10, 11, 1000, 50_257, 4_000_000_000):
        ids, marks = rng.integers(0, high, 200), rng.integers(0, 4, 200)
        plain = "".join(f"{i}{',|;'[m] if m < 3 else chr(10)}" for i, m in zip(ids.tolist(), marks.tolist(), strict=True))
        assert alignment.decimals(ids, alignment.MARKS[marks]) == plain
