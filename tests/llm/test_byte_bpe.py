import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from corpweave.llm import bpe_pieces

from .conftest import AWKWARD, pairs

FILE = open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb").read()
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def plain():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe_pieces.read_ranks(FILE), special_tokens={})


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80))
def test_ids_equal_the_rank_encoder_and_round_trip(plain, text):
    codec = bpe_pieces.codec(FILE, PATTERN)
    ids = codec.encode(text)
    assert np.frombuffer(ids, "<u4").tolist() == plain.encode_ordinary(text)
    assert codec.decode(ids) == text.encode()


def test_model_holds_the_vocabulary():
    codec = bpe_pieces.codec(FILE, PATTERN)
    assert codec.model.get_piece_size() == len(codec.ranks) + 1
    token, rank = min(codec.ranks.items(), key=lambda x: x[1])
    assert codec.model.id_to_piece(1) == bpe_pieces.mapped(token) and codec.model.get_score(1) == -rank


def test_small_cache_changes_nothing(monkeypatch):
    text = " ".join(f"word{i} éa{i}" for i in range(50))
    wanted = bpe_pieces.Codec(FILE, PATTERN).encode(text)
    monkeypatch.setattr(bpe_pieces, "CACHE", 3)
    codec = bpe_pieces.Codec(FILE, PATTERN)
    assert codec.encode("a b c d") and codec.encode(text) == wanted


def test_awkward_rows(plain, awkward, nothing):
    wanted = []
    for i, text in AWKWARD:
        ids = np.array(plain.encode_ordinary(text or ""), "<u4")
        wanted.append((i, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    columns = ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert pairs(bpe_pieces.round_trip_digests(awkward, FILE, PATTERN), *columns) == sorted(wanted, key=repr)
    encoded = bpe_pieces.encode_texts(awkward, FILE, PATTERN)
    decoded = bpe_pieces.decode_ids(encoded, FILE, PATTERN)
    assert pairs(decoded, "doc_id", "decoded") == sorted([(i, bytearray((t or "").encode())) for i, t in AWKWARD], key=repr)
    assert bpe_pieces.round_trip_digests(nothing, FILE, PATTERN).count() == 0
