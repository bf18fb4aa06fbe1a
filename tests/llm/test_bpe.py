import base64
import random

import public_tokenizers as P
import pytest
import tiktoken

from skywarden.llm.bpe import PrefixBPE, decode_documents, encode_documents, read_ranks, text_encoder

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def bpe():
    return PrefixBPE(read_ranks(PATH))


def _strings():
    rng = random.Random(3)
    for alphabet in ("ab", "aaab", "the ing", "erstonhaxyz", "0123", "éèß", "=-_*", "日本語あ", "\U0001f600a"):
        for n in (1, 2, 3, 5, 9, 17, 40, 120):
            for _ in range(12):
                yield "".join(rng.choice(alphabet) for _ in range(n)).encode()


def test_prefixes_give_the_merges(bpe, library):
    for data in _strings():
        last = bpe.extend(data, [])
        assert bpe.ids(data, last) == library._core_bpe.encode_single_piece(data)


def test_append_and_edit(bpe):
    rng = random.Random(5)
    for data in _strings():
        cut = rng.randrange(len(data) + 1)
        last = bpe.extend(data, bpe.extend(data[:cut], []))
        assert last == bpe.extend(data, [])
        a, b = sorted(rng.randrange(len(data) + 1) for _ in range(2))
        new, edited = bpe.edited(data, last, a, b, b"xin ")
        assert new == data[:a] + b"xin " + data[b:] and edited == bpe.extend(new, [])


def test_documents(spark, library):
    texts = [None, "", " ", "  a  b\n\n c \t d", "it's 3 o'clock　  x", "a" * 3000, "x \n \n y <|endoftext|>",
             " lead", "trail ", "same", "same", "日本 語 ​", "\x1c \x1d a"]
    docs = spark.createDataFrame([(i if i % 5 else None, t, i) for i, t in enumerate(texts)],
                                 "doc_id long, text string, n_tokens int")
    out = encode_documents(docs, PATH, P.PATTERN)
    got = [r["ids"] for r in out.collect()]
    assert got == [library.encode_ordinary(t or "") for t in texts]
    assert [r["text"] for r in decode_documents(out, PATH).collect()] == [t or "" for t in texts]
    assert encode_documents(docs.limit(0), PATH, P.PATTERN).count() == 0


def test_many_words_together(bpe, library):
    words = [*_strings(), b"", b" ", "日本".encode(), b"x" * 64, b"x" * 65, b"x" * 500]
    assert bpe.ids_many(words) == [library._core_bpe.encode_single_piece(w) if w else [] for w in words]
    assert bpe.ids_many(words[:9]) == [bpe.ids(w) for w in words[:9]]
    # Few places for remembered pairs: what was forgotten is found anew.
    bpe._arrays[5][:] = bpe._arrays[5][0]
    assert bpe.ids_many(words) == [bpe.ids(w) for w in words]


def test_new_words_of_all_texts_go_at_once(library):
    rng = random.Random(8)
    texts = [" ".join("".join(rng.choice("abéo.,'1") for _ in range(rng.randrange(1, 9))) for _ in range(60)) for _ in range(20)]
    texts += ["", " ", "a\n b \n c", "\n", "x" * 100 + " y", "a  b", "<|endoftext|> a"]
    bpe, encoder = text_encoder.__wrapped__(PATH, P.PATTERN)
    calls, encode_many = [], encoder.encode_many
    encoder.encode_many = lambda new: calls.append(len(new)) or encode_many(new)
    shown = [b"".join([f[0] for f in found]) for found in encoder.many(texts)]
    assert [list(map(int, s.split())) for s in shown] == [library.encode_ordinary(t) for t in texts]
    assert len(calls) == 1 and calls[0] > 500
