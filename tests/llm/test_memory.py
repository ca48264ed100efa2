"""What workers hold between the stages of the pipeline."""

from __future__ import annotations

import pyarrow as pa
import pytest

from linkloom.llm import _text, packing, queries


def test_freed_memory_goes_back_around_a_task(monkeypatch):
    calls = []
    monkeypatch.setattr(_text, "trim", lambda: calls.append(1))
    b = pa.RecordBatch.from_pydict({"text": ["a", None, "b c"]})
    it = _text.pieces([b, b])
    assert next(it).num_rows == 3 and calls == [1]
    assert sum(x.num_rows for x in it) == 3 and calls == [1, 1]


def test_trim_returns():
    assert _text.trim() is None


def test_few_remembered_words_change_no_ids():
    pytest.importorskip("public_tokenizers")
    path = queries.word_vocabulary()
    docs = [" ".join(f"wort{i * k % 977}, Ab{i}" for i in range(300)).encode() for k in range(1, 9)]
    few = packing.encoder(path, 50)
    assert few.recent.most == 50 and few is not packing.encoder(path)
    assert [few.encode([d])[0] for d in docs] == packing.encoder(path).encode(docs)
    assert len(few.recent.old) < 2000
