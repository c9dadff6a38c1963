from __future__ import annotations

from shopfunnel.llm import common, quality, tokens


def test_a_worker_forgets_what_other_operators_left():
    encoder = tokens.encoder(tokens.vocabulary_path())
    encoder.encode(["a text"])
    quality.features("a text")
    common.only("tokens")
    assert tokens.encoder(tokens.vocabulary_path()) is encoder and len(encoder.memo) and not quality._memo
    common.only()
    assert not tokens._encoders


def test_the_library_is_given_few_texts_at_once(monkeypatch):
    encoder = tokens.Encoder(tokens.vocabulary_path())
    texts = [" ".join(f"word{k}x{n}" for k in range(n, n + 60)) for n in range(40)]
    expected, sizes = encoder.encode(texts), []
    encoder = tokens.Encoder(tokens.vocabulary_path())
    monkeypatch.setattr(tokens, "_CALL_BYTES", 2_000)
    monkeypatch.setattr(tokens, "_JOINED_BYTES", 500)
    call = encoder._ids
    monkeypatch.setattr(encoder, "_ids", lambda some: sizes.append(sum(map(len, some))) or call(some))
    assert encoder.encode(texts) == expected
    assert len(sizes) > 5 and max(sizes) < 4_000


def test_texts_are_looked_up_in_small_chunks(monkeypatch):
    """Working arrays take some sixty times a chunk, in each of an executor's workers."""
    encoder, sizes = tokens.Encoder(tokens.vocabulary_path()), []
    texts = [" ".join(f"word{k % 50}" for k in range(n, n + 2_000)) for n in range(200)]
    flat = encoder.flat
    monkeypatch.setattr(encoder, "flat", lambda data, offsets: sizes.append(len(data)) or flat(data, offsets))
    assert len(encoder.encode(texts)) == 200
    assert sum(sizes) == sum(map(len, texts)) > 2 << 20
    assert max(sizes) <= 1 << 20
