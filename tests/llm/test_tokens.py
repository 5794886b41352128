"""Operators 1 and 5 against the tokenizer libraries."""

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from llm_helpers import edge_rows, edge_table, empty_table
from tabulon.llm import piece_codec, token_counts

WORDS, PIECES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")


def odd_texts(n, seed):
    rng = random.Random(seed)
    letters = list("ab S'<|>the startoftextend \n\t\x00\x1c\x85\u00a0é\u0301Σσς1٣²🙂中\u3000\u2028\u200bĀﬁŅ▁_-")
    return ["", " ", "  ", "\n", "a  b", "▁", "<|endoftext|>", "a<|startoftext|>b", "<|ENDOFTEXT|>", "x" * 500,
            "ΑΣ ΟΔΟΣ Σ"] + ["".join(rng.choices(letters, k=rng.randint(0, 40))) for _ in range(n)]


@pytest.fixture(scope="module")
def counter():
    with open(WORDS, "rb") as f:
        return token_counts.WordCounter(f.read())


@pytest.fixture(scope="module")
def codec():
    with open(PIECES, "rb") as f:
        return piece_codec.PieceCodec(f.read())


def test_every_code_point_counts_as_in_the_library(counter):
    library = Tokenizer.from_file(WORDS)
    points = [chr(i) for i in range(0x32000) if not 0xD800 <= i < 0xE000]
    texts = [form for c in points for form in (c, f"a{c}b")]
    counts = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [t for t, n in zip(texts, counts, strict=True) if counter.count(t) != n] == []


def test_counts_equal_the_library(counter):
    library = Tokenizer.from_file(WORDS)
    for text in odd_texts(2000, 1):
        assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids), repr(text)


def test_heap_merges_in_rank_order():
    ranks = {("a", "b"): 1, ("b", "c"): 0, ("a", "bc"): 2}
    assert token_counts.merge_count(list("abc"), ranks) == 2
    assert token_counts.merge_count(list("abab"), {("a", "b"): 0}) == 2
    assert token_counts.merge_count([], ranks) == token_counts.merge_count(["a"], ranks) == 0


def test_count_query_on_edge_rows(spark):
    library = Tokenizer.from_file(WORDS)
    want = []
    for row in edge_rows():
        text = row[1] or ""
        n = len(library.encode(text, add_special_tokens=False).ids)
        want.append((row[0], len(text.encode()), n, n > 2048))
    got = token_counts.token_counts(edge_table(spark), WORDS)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert token_counts.token_counts(empty_table(spark), WORDS).count() == 0


def test_pieces_spans_and_decoding_equal_the_library(codec):
    from sentencepiece import sentencepiece_pb2

    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for text in odd_texts(2000, 2):
        ids, bounds = codec.encode(text)
        proto = sentencepiece_pb2.SentencePieceText()
        proto.ParseFromString(library.encode(text, out_type="serialized_proto"))
        assert ids.tolist() == [p.id for p in proto.pieces], repr(text)
        assert list(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)) == \
            [(p.begin, p.end) for p in proto.pieces], repr(text)
        assert codec.decode(ids.tolist()) == library.decode(ids.tolist())
    rng = random.Random(3)
    for _ in range(2000):  # any ids, byte pieces and control pieces among them
        ids = rng.choices([0, 1, 2, *range(3, 400)], k=rng.randint(0, 8))
        assert codec.decode(ids) == library.decode(ids), ids


@pytest.mark.parametrize("rule", ["nfkc", "nmt_nfkc", "nfkc_cf"])
def test_compiled_character_map_equals_the_library(codec, rule):
    library = sentencepiece.SentencePieceNormalizer(
        rule_name=rule, add_dummy_prefix=True, escape_whitespaces=True, remove_extra_whitespaces=True)
    spec = dict(piece_codec._fields(dict(piece_codec._fields(library.serialized_model_proto()))[3]))
    mapped = piece_codec.PieceCodec.__new__(piece_codec.PieceCodec)
    mapped.map, mapped.trim, mapped.dummy = piece_codec.CharMap(spec[2]), 1, 1
    rng = random.Random(4)
    letters = list("abAÀ Å①ﬁ½㌀ｶﾞ가각\u0301\u0302 \t\n\u3000  ΣA\u200bẛ\u0323ＡＢ▁")
    for _ in range(1500):
        text = "".join(rng.choices(letters, k=rng.randint(0, 15)))
        want, places = library.normalize(text, with_offsets=True)
        got = mapped.normalise(text)
        at = [0]
        for c in got.text:
            at.append(at[-1] + len(c.encode()))
        chars = [len(text.encode()[:b].decode("utf-8", "ignore")) for b in got.origin]
        assert (got.text, [chars[i] for i in at]) == (want, list(places)), repr(text)


def test_codec_query_on_edge_rows(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    encoded = piece_codec.encode(edge_table(spark), PIECES, decoded=True)
    want = []
    for row in edge_rows():
        ids = library.encode(row[1] or "")
        want.append((row[0], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(library.decode(ids).encode()).hexdigest(), len((row[1] or "").encode())))
    assert sorted(map(tuple, piece_codec.digests(encoded).collect()), key=repr) == sorted(want, key=repr)
    assert encoded.limit(0).count() == piece_codec.encode(empty_table(spark), PIECES).count() == 0
    apart = piece_codec.decode(piece_codec.encode(edge_table(spark), PIECES), PIECES)
    assert sorted(map(tuple, apart.collect()), key=repr) == \
        sorted(((r[0], r[1] or "") for r in edge_rows()), key=repr)
    spans = encoded.select(piece_codec.piece_spans().alias("s"), "ids").collect()
    assert all(len(r.s) == len(r.ids) for r in spans)
