import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from cases import documents, odd_rows

from tallyframe.llm import byte_bpe as B
from tallyframe.llm import queries as Q

TEXTS = [
    "", " ", "a", "the cat's hat they'LL we'll", "  two  spaces \n\n and\tmore ", "x" * 5000, " " * 5000, "aab" * 700 + "  b", "= " * 99,
    "naïve façade über ÀÉ 北京市 ありがとう 😀👍🏽     ١٢٣ ²½", "՘࢏Ᲊ \U00011de1", "\x00\x1c\x85", "1234567890" * 30,
]


@pytest.fixture(scope="module")
def vocab():
    return B.vocabulary()


@pytest.fixture(scope="module")
def library(vocab):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocab.ranks, special_tokens={})


def test_as_the_library(vocab, library):
    encoder, r = B.Encoder(vocab), random.Random(7)
    letters = [chr(c) for c in [*range(9, 14), *range(32, 127), 0xA0, 0xE9, 0x558, 0x88F, 0xC5C, 0x1C89, 0x2028, 0x3000, 0x4E00, 0x1F600, 0x11DE1, 0x660]]
    made = ["".join(r.choice(letters if k % 3 else "ab th'se  \n1") for _ in range(r.randrange(50))) for k in range(2000)]
    for text in [*TEXTS, *made]:
        assert encoder.encode(text).tolist() == library.encode_ordinary(text)


def test_every_token_is_itself(vocab):
    transducer = B.Transducer(vocab)
    assert all(transducer.encode(token) == [rank] for token, rank in vocab.ranks.items() if token not in vocab.whole)


def test_blocks_and_a_full_memory_change_nothing(vocab, library, monkeypatch):
    text = " ".join(TEXTS) * 3
    want = library.encode_ordinary(text)
    for name, value in (("BLOCK_CHARS", 10), ("PAIRS", 50), ("PIECES", 40), ("EMIT", 130), ("WALK_BYTES", 60), ("PIECE_CHARS", 6)):
        monkeypatch.setattr(B, name, value)
    encoder = B.Encoder(vocab)
    assert len(list(encoder.blocks(text))) > 50 and "".join(encoder.blocks(text)) == text
    assert encoder.encode(text).tolist() == want
    assert len(encoder.number) <= 40 and len(encoder.transducer.met) <= 50 and encoder.transducer.pairs.n <= 64


def plain_bpe(data, ranks):
    """One merge at a time over the whole piece."""
    parts = [data[i : i + 1] for i in range(len(data))]
    while True:
        found = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in ranks]
        if not found:
            return [ranks[p] for p in parts]
        i = min(found)[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def test_any_vocabulary():
    """Small vocabularies in random order, where merges need not come after those they need and some tokens are out of reach."""
    r = random.Random(3)
    kinds = set()
    for _ in range(150):
        order = sorted({bytes(r.choice(b"abc") for _ in range(r.randrange(2, 5))) for _ in range(r.randrange(1, 14))})
        r.shuffle(order)
        if r.random() < 0.5:
            order.sort(key=len)
        ranks = {bytes([i]): i for i in range(256)} | {t: 256 + i for i, t in enumerate(order)}
        vocab = B.Vocabulary(ranks)
        kinds.add((vocab.rising, bool(vocab.whole)))
        transducer = B.Transducer(vocab)
        for _ in range(40):
            data = bytes(r.choice(b"abc") for _ in range(r.randrange(1, 25)))
            want = plain_bpe(data, ranks)
            assert transducer.encode(data) == want, (order, data)
            ids, counts = transducer.encode_many([data, b"a", data])
            assert ids.tolist() == [*want, ranks[b"a"], *want] and counts.tolist() == [len(want), 1, len(want)]
    assert {rising for rising, _ in kinds} == {whole for _, whole in kinds} == {True, False}


def test_lookahead_is_bounded(vocab, monkeypatch):
    """Whenever tokens are emitted, what waits is a few longest tokens at most; and no control state beyond the trie's nodes."""
    waiting = []

    class Watched(B.Transducer):
        def _agreed(self, border, open_at):
            agreed = super()._agreed(border, open_at)
            waiting.append(len(border) - 1 - agreed)
            return agreed

    longest = max(map(len, vocab.ranks))
    monkeypatch.setattr(B, "EMIT", 3 * longest)
    transducer = Watched(vocab)
    for piece in (b"a" * 9000, b"abab" * 2500, b"\xf0\x9f\x98\x80" * 900, b" " * 9000, b"0123456789" * 900, b"supercalifragilistic" * 300):
        transducer.encode(piece)
    assert len(waiting) > 40 and max(waiting) < 2 * longest
    assert len(transducer.places) <= len(transducer.token_at)


def test_streaming_decode(vocab):
    tokens, encoder, r = B.Tokens(vocab), B.Encoder(vocab), random.Random(5)
    for text in TEXTS:
        ids, stream = encoder.encode(text), B.StreamDecoder(tokens)
        cuts = sorted(r.randrange(len(ids) + 1) for _ in range(6))
        assert "".join(stream.feed(x) for x in np.split(ids, cuts)) + stream.finish() == text
    parts = [0x41, 0xC3, 0xA9, 0xE2, 0x82, 0xAC, 0xF0, 0x9F, 0x98, 0x80, 0xED, 0xA0, 0xE0, 0xF4, 0x90, 0xFF, 0xC0, 0x9F]
    for _ in range(3000):  # bytes that are no text
        data = bytes(r.choice(parts) for _ in range(r.randrange(12)))
        ids, stream = np.array([vocab.ranks[bytes([b])] for b in data], np.int32), B.StreamDecoder(tokens)
        cuts = sorted(r.randrange(len(ids) + 1) for _ in range(3))
        assert "".join(stream.feed(x) for x in np.split(ids, cuts)) + stream.finish() == data.decode(errors="replace")
    with pytest.raises(ValueError):
        tokens.bytes_of(np.array([60000]))


def test_characters_come_as_soon_as_they_are_whole(vocab):
    stream = B.StreamDecoder(B.Tokens(vocab))
    data = "é😀x".encode()
    got = [stream.feed(np.array([vocab.ranks[bytes([b])]], np.int32)) for b in data]
    assert got == ["", "é", "", "", "", "😀", "x"] and stream.finish() == ""


def test_query(spark, library, tmp_path):
    documents(spark, clashing=True).write.parquet(f"{tmp_path}/documents.parquet")
    sha = lambda x: hashlib.sha256(x).hexdigest()
    want = []
    for i, t, *_ in odd_rows():
        ids = library.encode_ordinary(t or "")
        want.append((i, len(ids), sha(" ".join(map(str, ids)).encode()), sha((t or "").encode())))
    got = [tuple(r) for r in Q.op12_byte_bpe(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_tables(spark):
    empty = documents(spark, [])
    assert B.decode(B.encode(empty)).collect() == [] and B.encode(empty).columns == ["id", "ids"]
    rows = spark.createDataFrame([(1, None, "x", "y"), (2, [64, 65], "x", "y")], "id long, ids array<int>, text string, `a.b` string")
    assert [tuple(r) for r in B.decode(rows).orderBy("id").collect()] == [(1, "y", ""), (2, "y", "ab")]
    for text in ("benchmark", "conversations"):
        table = spark.read.parquet(f"/root/testdata/sf0.001/{text}.parquet").select("text")
        back = B.decode(B.encode(table, "text").drop("id").withColumn("n", B.F.size("ids")))
        assert sorted(r["text"] for r in back.collect()) == sorted(r["text"] or "" for r in table.collect())
