import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from stayline.llm import bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def peer():
    ranks = {token: i for i, token in enumerate(bpe.read_ranks(PATH)) if token}
    return tiktoken.Encoding("peer", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def random_texts(n):
    rng = random.Random(8)
    letters = "ab 's\n\t\r  \u0085 　​\x1c\x0b日本語éßÜ🙂१२³Ⅷ½'llREVE'd’.,;!?<|endoftext|>́العไทย\U0010ffff"
    pools = [letters, [chr(c) for c in range(32, 0x2FFF)], [chr(c) for c in range(0x10000, 0x20000)]]
    return ["".join(rng.choice(pools[k % 3]) for _ in range(rng.randint(0, 40))) for k in range(n)]


def test_byte_table_is_one_to_one():
    table = bpe.byte_characters()
    assert len(set(table)) == 256 and all(c.isprintable() and not c.isspace() for c in table)
    assert table[ord("A")] == "A" and table[ord(" ")] == "Ġ"


def test_ids_equal_the_peer_library_and_decode_back(peer):
    texts = [*random_texts(4000), "", "a" * 3000, "ab" * 2000, "<|endoftext|>", "x " * 40_000]
    _, tokens, _ = bpe.load(PATH, PATTERN)
    for text, ids in zip(texts, bpe.encode_texts(texts, PATH, PATTERN), strict=True):
        assert ids == peer.encode_ordinary(text)
        assert bpe.decode_ids(ids, tokens) == text.encode()
        assert "".join(bpe.decode_stream(ids, tokens)) == text


def test_long_text_is_cut_where_matches_end(peer):
    rng = random.Random(3)
    text = " ".join(rng.choice(["word", "can't", "  two", "\n", "12", "é"]) for _ in range(60_000))
    assert len(bpe.segments(text)) > 2 and "".join(bpe.segments(text)) == text
    assert next(bpe.encode_texts([text], PATH, PATTERN)) == peer.encode_ordinary(text)


def test_offsets_touch_each_character(peer):
    _, tokens, _ = bpe.load(PATH, PATTERN)
    for text in ["plain words", "é日本🙂 split", "\U0001f468‍\U0001f469", ""]:
        ids = peer.encode_ordinary(text)
        spans, done = bpe.char_offsets(ids, tokens), 0
        for i, (a, b) in zip(ids, spans, strict=True):
            before, done = done, done + len(tokens[i])
            raw = text.encode()
            assert a == len(raw[:before].decode(errors="ignore")) and b == len(raw[:done].decode(errors="replace"))


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, ids string, key int")


def test_digests_of_nulls_empties_repeats(spark, peer):
    rows = [(1, None), (2, ""), (3, "Hello  wörld"), (3, "Hello  wörld"), (None, "x"), (4, "🙂" * 500)]
    got = bpe.digests(frame(spark, rows), PATH, PATTERN).collect()
    told = sorted((r.doc_id or 0, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got)
    hexed = lambda b: hashlib.sha256(b).hexdigest()
    want = []
    for key, text in rows:
        ids = peer.encode_ordinary(text or "")
        want.append((key or 0, len(ids), hexed(",".join(map(str, ids)).encode()), hexed((text or "").encode())))
    assert told == sorted(want)
    assert bpe.digests(frame(spark, []), PATH, PATTERN).count() == 0


def test_encode_and_decode_frames(spark):
    docs = frame(spark, [(1, "héllo 🙂"), (2, None)])
    coded = bpe.encode(docs, PATH, PATTERN)
    assert coded.columns == ["doc_id", "ids", "starts", "ends"]
    back = {r.doc_id: bytes(r.bytes).decode() for r in bpe.decode(coded, PATH, PATTERN).collect()}
    assert back == {1: "héllo 🙂", 2: ""}
