"""Whole tokens and the table of chunks of the byte-level encoder."""

import base64

import public_tokenizers
import tiktoken

from faultline.llm import byte_bpe


def test_a_piece_that_is_a_token_has_its_id(tmp_path):
    # No pair of tokens makes up "abc", so merges alone never reach it.
    ranks = {bytes([b]): b for b in range(256)} | {b"abc": 256, b"de": 257}
    path = tmp_path / "ranks"
    path.write_bytes(b"\n".join(base64.b64encode(t) + b" %d" % r for t, r in ranks.items()))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    own = byte_bpe.Encoder(str(path), public_tokenizers.PATTERN)
    texts = ["abc", "abc abc", "abcd", "de", "xdey", "", "a", "Ă", "deabcde" * 9, "a\0b"]
    found = [byte_bpe.array("H", p).tolist() for p in own.packed(texts)]
    assert found == [library.encode_ordinary(t) for t in texts]
    assert found[0] == [256]


def test_a_full_table_keeps_chunks_of_the_texts_at_hand(monkeypatch):
    monkeypatch.setattr(byte_bpe, "MAX_CHUNKS", 3)
    own = byte_bpe.Encoder(byte_bpe.default_ranks(), public_tokenizers.PATTERN)
    first = own.packed(["one two three four five"])
    learned = []
    learn = own.learn
    monkeypatch.setattr(own, "learn", lambda new: (learned.append(set(new)), learn(learned[-1])))
    again = own.packed(["one two three four five six"])
    assert learned == [{" six"}] and again[0].startswith(first[0])
    assert sorted(own.ids_of) == [" five", " four", " six", " three", " two", "one"]
    own.packed(["seven"])
    assert list(own.ids_of) == ["seven"]
