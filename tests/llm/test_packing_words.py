"""Words are remembered in lower case, as the tokenizer reads them."""

from __future__ import annotations

from linkloom.llm import packing, queries


def test_case_does_not_make_a_new_word(monkeypatch):
    words = packing.WordTokenizer(queries.word_vocabulary())
    texts = ["The Cat's HAT, Été Á İs KELVIN'S 12A".encode(), "ONE two".encode()]
    want = [words.ids(x.decode()).tobytes() for x in texts]
    assert words.encode(texts) == want
    monkeypatch.setattr(words, "fresh", lambda missing: [].index(missing) if missing else iter(()))  # nothing is new
    assert words.encode([texts[0].replace(b"Cat", b"cAT").replace(b"HAT", b"Hat"), b"one TWO"]) == want
