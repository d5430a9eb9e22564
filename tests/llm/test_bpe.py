import base64
import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken

from vaultscope.llm import bpe

RANKS = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def tik():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def own():
    return bpe.Encoder(bpe.read_ranks(RANKS), P.PATTERN)


def test_lowest_rank_and_then_leftmost_first():
    """Against merging one pair at a time, over vocabularies whose merges can lower a neighbour's rank."""
    rng = random.Random(3)
    for _ in range(300):
        tokens = list({bytes(rng.choices(b"abc", k=rng.randrange(2, 5))) for _ in range(12)})
        ranks = {x: k for k, x in enumerate(rng.sample([b"a", b"b", b"c", *tokens], len(tokens) + 3))}
        ranks = {x: 300 * k for x, k in ranks.items()}  # several words of the bitmap
        piece = bytes(rng.choices(b"abc", k=rng.randrange(1, 30)))
        parts = [piece] if piece in ranks else [piece[i : i + 1] for i in range(len(piece))]
        while True:
            pairs = [(ranks[parts[i] + parts[i + 1]], i) for i in range(len(parts) - 1) if parts[i] + parts[i + 1] in ranks]
            if not pairs:
                break
            i = min(pairs)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        assert list(bpe.encode_piece(piece, ranks, bpe.bitmap_words(ranks))) == [ranks[x] for x in parts]


def test_white_space_as_the_library_sees_it(tik, own):
    for c in range(0x3100):
        for text in (f"a{chr(c)}b", f"{chr(c)}{chr(c)} x", f" {chr(c)}1"):
            assert list(own.encode(text)) == tik.encode_ordinary(text), hex(c)


def test_random_texts_equal_the_library(tik, own):
    rng = random.Random(5)
    kinds = ["ab", "aAbB 01'st\n\t", "éüñ日本語🙂 a", "".join(map(chr, range(1, 300)))]
    for k in range(400):
        text = "".join(rng.choice(kinds[k % 4]) for _ in range(rng.randrange(0, 200)))
        assert list(own.encode(text)) == tik.encode_ordinary(text)


def test_very_long_pieces(tik, own):
    for text in ("a" * 30_000, "ab" * 20_000, "".join(random.Random(1).choice("etaoin") for _ in range(60_000))):
        assert list(own.encode(text)) == tik.encode_ordinary(text)


def test_special_token_text_is_ordinary(tik, own):
    assert list(own.encode("<|endoftext|>")) == tik.encode_ordinary("<|endoftext|>")


def test_documents_round_trip(spark, tik):
    from vaultscope.llm.queries import op9_byte_bpe

    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    rows = op9_byte_bpe(spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = tik.encode_ordinary(docs[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()


def test_nulls_repeats_and_empty_tables(spark):
    rows = [(1, None, "x"), (2, "", "x"), (None, "a b", "x"), (3, "hi hi", "x"), (3, "hi hi", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = sorted(((r.doc_id, r.ids, bytes(r.bytes)) for r in bpe.decode(bpe.encode(df, RANKS, P.PATTERN), RANKS).collect()), key=str)
    assert [o[2] for o in out] == [b"", b"", b"hi hi", b"hi hi", b"a b"]
    assert out[0][1] == [] and out[2][1] == out[3][1]
    assert bpe.encode(df.limit(0), RANKS, P.PATTERN).count() == 0
