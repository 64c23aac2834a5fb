"""What a worker remembers of pieces stays within its bound, and the collector is as before after encoding."""

import gc

import public_tokenizers
from tokenizers import Tokenizer

from fieldlens.llm.token_files import ENTRY_BYTES, Encoder


def test_memo_forgets_the_longest_and_marks_join_words():
    path = public_tokenizers.path("byte_bpe_50k.json")
    library, coder = Tokenizer.from_file(path), Encoder(path, plain_special=False, memo_bytes=60 * ENTRY_BYTES)
    for k in range(20):
        texts = [" ".join(f"{chr(97 + i)}{'x' * (i + k % 3)}{',.;:!?'[i % 6]} wor{chr(97 + k)}d" for i in range(25)), "", "né. e!"]
        got = coder.encode(texts)
        assert [len(g) // 4 for g in got] == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
        assert b"".join(got) == b"".join(i.to_bytes(4, "little") for t in texts for i in library.encode(t, add_special_tokens=False).ids)
        assert len(coder.known) * ENTRY_BYTES == coder.held <= 60 * ENTRY_BYTES
    assert gc.isenabled()


def test_collector_rests_while_texts_are_encoded(monkeypatch):
    coder, seen = Encoder(public_tokenizers.path("byte_bpe_50k.json")), []
    make = coder._library
    monkeypatch.setattr(coder, "_library", lambda texts: (seen.append(gc.isenabled()), make(texts))[1])
    coder.encode(["some words, here."])
    assert seen and not any(seen) and gc.isenabled()


def test_texts_are_encoded_few_at_a_time():
    from fieldlens.llm.token_files import ENCODE_CHARS, _missing

    assert ENCODE_CHARS <= 100_000   # the pieces of a batch fit a core's cache
    assert _missing([None, b"a", None, None]) == [0, 2, 3] and _missing([b"a"]) == _missing([]) == []
