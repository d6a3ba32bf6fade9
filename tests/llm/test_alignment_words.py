"""Words of earlier slices of texts are not cut again while there is room for them."""

import pyarrow as pa
import pytest

from mentionwise.llm import alignment
from mentionwise.llm.queries import tokenizer_path


@pytest.mark.parametrize("words_kept, cut", [(1000, 200), (150, 250), (0, 400)])
def test_words_seen_once_are_kept(monkeypatch, words_kept, cut):
    monkeypatch.setattr(alignment, "SLICE_CHARS", 1)
    model = alignment.aligner(tokenizer_path(), tokenizer_path("piece_bpe_32k.model"))
    given = []
    table = model.table
    monkeypatch.setattr(model, "table", lambda words, *more: given.extend(words) or table(words, *more))
    text = " ".join(f"word{i}" for i in range(200))
    first, second = alignment.Documents(model, words_kept=words_kept).of(pa.array([text, text]))
    assert len(given) == cut
    assert first[0] == second[0] and first[1].tolist() == second[1].tolist()


@pytest.mark.parametrize("text, uncut", [
    (" a", True), ("a ", True), ("a  b", True), ("a. b", False), ("é b", False), ("　 b", True), ("a\n b", True), ("", False),
])
def test_space_at_which_a_text_is_not_cut(text, uncut):
    assert bool(alignment.UNCUT_SPACE(text)) == uncut
