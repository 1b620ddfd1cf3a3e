from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from niimble.llm import bpe
from niimble.llm.queries import vocabulary_path
from niimble.llm.runs import prefix_sums, slices
from tests.llm.cases import clashing, edge_docs, empty_docs, rows_of

tokenizers = pytest.importorskip("tokenizers")

PIECES = [
    " ", "  ", "\n", "\n\n", "'s", "'", "re", "'re", "a", "the", "ABC", "12", "é", "ß", " ", "　", "漢字", "!", "...",
    "<|endoftext|>", "<|", "\t", "\x1c", "x" * 50, "\U0001f600", "\x85", "ll", " word", " word word word word",
]


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.read_vocabulary(vocabulary_path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def tokenizer():
    return tokenizers.Tokenizer.from_file(vocabulary_path("byte_bpe_50k.json"))


def encoded(frame):
    return sorted(((r[0], np.frombuffer(r["ids"], "<u4").tolist()) for r in frame.collect()), key=repr)


def test_both_files_hold_one_vocabulary(vocabulary):
    assert vocabulary.ranks == bpe.vocabulary_of_ranks(vocabulary_path("byte_bpe_50k.tiktoken")).ranks


def slice_ids(encoder, texts, chunk_bytes=1024, limit=20_000):
    found = []
    for part in slices(pa.array(texts), limit):
        found += [np.frombuffer(x, "<u4").tolist() for x in bpe.encode_slice(encoder, part, chunk_bytes)]
    return found


def prose(rng, n, letters, signs):
    """Sentences without blanks."""
    return "".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 25))) + rng.choice(signs) for _ in range(n))


HAN, KANA = [chr(0x4E00 + 7 * i) for i in range(900)], [chr(0x3042 + i) for i in range(160)]


@pytest.mark.parametrize("chunk_bytes", [16, 100, 1024])
def test_joined_chunks_give_the_tokens_of_the_whole(vocabulary, tokenizer, chunk_bytes):
    rng = random.Random(chunk_bytes)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 300))) for _ in range(300)]
    texts += [prose(rng, 40, HAN, "，。、！") for _ in range(40)] + [prose(rng, 40, KANA + ["ー", "々"], "。」「・") for _ in range(40)]
    texts += ["".join(rng.choice("\U0001f600\U0001f468\u200d\U0001f469é ") for _ in range(400)) for _ in range(20)]
    texts += [" " * 700 + "a" + "\n" * 500 + " b", "x" * 3000, "漢" * 2000, "1234 " * 300, "don't we're 'tis" * 60]
    encoder = bpe.Encoder(vocabulary)
    expected = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert slice_ids(encoder, texts, chunk_bytes) == expected
    assert slice_ids(encoder, texts, chunk_bytes) == expected  # from its cache


def test_every_firm_place_is_one_whatever_stands_around(vocabulary, tokenizer):
    rng = random.Random(9)
    for _ in range(200):
        text = "".join(rng.choice([p for p in PIECES if p != "<|endoftext|>"] + HAN[:9]) for _ in range(40))
        raw = text.encode()
        whole = tokenizer.encode(text, add_special_tokens=False).ids
        for place in bpe.firm_places(raw, 0, len(raw)):
            halves = [tokenizer.encode(h.decode(), add_special_tokens=False).ids for h in (raw[:place], raw[place:])]
            assert halves[0] + halves[1] == whole


def test_a_passage_without_blanks_is_encoded_once(vocabulary, tokenizer):
    """In a hundred different texts: its chunks are encoded once, only windows at its two ends are new."""
    rng = random.Random(2)
    passage = prose(rng, 700, HAN, "，。、！")
    encoder = bpe.Encoder(vocabulary)
    texts = [prose(rng, 3, HAN, "，。") + passage + prose(rng, 3, HAN, "，。") for _ in range(100)]
    one = slice_ids(encoder, texts[:1], limit=1 << 20)
    first = encoder.encoded
    assert first > 20
    found = one + slice_ids(encoder, texts[1:], limit=1 << 20)
    assert found == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert encoder.encoded - first <= 6 * 99


def test_a_join_that_does_not_agree_is_widened_and_at_last_given_up(vocabulary, tokenizer, monkeypatch):
    rng = random.Random(5)
    text = " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 9))) for _ in range(900))
    expected = tokenizer.encode(text, add_special_tokens=False).ids
    real, calls = np.array_equal, []
    monkeypatch.setattr(np, "array_equal", lambda a, b: calls.append(1) is None and len(calls) % 3 != 1 and real(a, b))
    assert slice_ids(bpe.Encoder(vocabulary), [text], 200) == [expected]  # every other first try is refused
    widened = len(calls)
    monkeypatch.setattr(np, "array_equal", lambda a, b: False)
    assert slice_ids(bpe.Encoder(vocabulary), [text], 200) == [expected]
    assert widened > 10


def test_long_runs_of_blanks(vocabulary, tokenizer):
    text = "a" + " " * 1_500_000 + "b" + "\n" * 1_200_000 + "<|endoftext|>"
    encoder = bpe.Encoder(vocabulary)
    assert encoder(text.encode()).ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_shared_text_is_cut_alike():
    rng = random.Random(1)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(20_000))
    texts = pa.array(["start " + passage, "another, longer beginning " + passage + " end"])
    chunks = []
    for part in slices(texts):
        cuts = bpe.chunk_cuts(part, prefix_sums(part.data))
        edges = np.unique(np.concatenate([part.bounds, cuts]))
        raw = part.data.tobytes()
        for k in range(2):
            inside = edges[(edges >= part.bounds[k]) & (edges <= part.bounds[k + 1])]
            chunks.append({raw[a:b] for a, b in zip(inside, inside[1:], strict=False)})
    assert len(chunks[0] & chunks[1]) >= 0.7 * len(chunks[0])


def test_round_trip_and_edges(spark, vocabulary, tokenizer):
    docs = edge_docs(spark)
    found = bpe.encode(docs, vocabulary)
    expected = sorted(((r["doc_id"], tokenizer.encode(r["text"] or "", add_special_tokens=False).ids) for r in docs.collect()), key=repr)
    assert encoded(found) == expected
    assert encoded(bpe.encode(clashing(docs), vocabulary)) == expected
    assert rows_of(bpe.decode(found, vocabulary)) == sorted(((r["doc_id"], r["text"] or "") for r in docs.collect()), key=repr)
    assert bpe.encode(empty_docs(spark), vocabulary).collect() == []


def test_decoding_of_torn_and_added_tokens(spark, vocabulary, tokenizer):
    smile = tokenizer.encode("\U0001f600", add_special_tokens=False).ids
    rows = [(1, smile[:1]), (2, smile[1:]), (3, [50256, *smile, 50256]), (4, [])]
    frame = spark.createDataFrame([(i, np.array(x, "<u4").tobytes()) for i, x in rows], "doc_id long, ids binary")
    got = dict(rows_of(bpe.decode(frame, vocabulary)))
    assert got == {i: tokenizer.decode(x, skip_special_tokens=False) for i, x in rows}
    unknown = spark.createDataFrame([(1, np.array([60_000], "<u4").tobytes())], "doc_id long, ids binary")
    with pytest.raises(Exception, match="not in the vocabulary"):
        bpe.decode(unknown, vocabulary).collect()
