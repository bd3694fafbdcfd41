import os

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shapeloom.llm import pieces, queries

pytestmark = pytest.mark.skipif(not os.path.exists(pieces.DEFAULT_MODEL), reason="vocabulary file is not here")
TEXTS = st.lists(st.one_of(st.text(max_size=60), st.text("ab ▁e\n", max_size=80)), max_size=6)


@pytest.fixture(scope="module")
def model():
    return pieces.load_model()


def encoded(model, texts, keys, rate):
    ids, at = pieces.encode_texts(model, texts, np.array(keys), rate)
    return [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])]


def reference(model, text, key, rate):
    """One chunk after the other with a plain list of candidates."""
    t = pieces._tables_of(model)
    codes = [ord(c) for c in " " + text] if text else []
    chunks: list[list[int]] = []
    for i, c in enumerate(codes):
        odd = t.of_char[c] < 0
        if i == 0 or odd or t.of_char[codes[i - 1]] < 0 or (c == 32 and codes[i - 1] != 32):
            chunks.append([])
        chunks[-1].append(c)
    out = []
    for chunk in chunks:
        if t.of_char[chunk[0]] < 0:
            out += [int(t.byte_ids[b]) for b in chr(chunk[0]).encode()]
            continue
        values = np.array(chunk, np.uint64) + np.uint64(1)
        content = pieces.mix(np.add.reduce(values * pieces.powers(len(chunk)), keepdims=True))
        salted = pieces.mix(content ^ pieces.mix(np.array([key], np.int64).view(np.uint64))) if rate else content
        spans, ids = [(i, i + 1) for i in range(len(chunk))], [int(t.of_char[c]) for c in chunk]
        while True:
            best = None
            for i in range(len(ids) - 1):
                made = int(t.pair(np.array([ids[i]], np.int32), np.array([ids[i + 1]], np.int32))[0])
                a, b, c = spans[i][0], spans[i + 1][0], spans[i + 1][1]
                if made < 0 or (rate and pieces._skipped(salted, *(np.array([x]) for x in (a, b, c)), rate)[0]):
                    continue
                if best is None or t.rank[made] < best[0]:
                    best = (t.rank[made], i, made)
            if best is None:
                break
            _, i, made = best
            ids[i : i + 2], spans[i : i + 2] = [made], [(spans[i][0], spans[i + 1][1])]
        out += ids
    return out


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_without_dropout_it_is_the_models_own_encoding(texts):
    import sentencepiece

    model = pieces.load_model()
    own = sentencepiece.SentencePieceProcessor(model_file=pieces.DEFAULT_MODEL)
    plain = [t for t in texts if "▁" not in t]
    assert encoded(model, plain, range(len(plain)), 0.0) == [own.encode(t) for t in plain]


@settings(max_examples=60, deadline=None)
@given(TEXTS, st.sampled_from([0.0, 0.1, 0.5, 1.0]))
def test_round_trip(texts, rate):
    model = pieces.load_model()
    ids, at = pieces.encode_texts(model, texts, np.arange(len(texts)), rate)
    data, bounds = pieces.decode_pieces(model, ids, at)
    assert [data[a:b].tobytes().decode() for a, b in zip(bounds[:-1], bounds[1:])] == texts


@pytest.mark.parametrize("rate", [0.1, 0.4])
def test_dropout_against_a_plain_agenda(model, rate):
    texts = ["the quick brown fox", "internationalization  of text", "é▁𝄞 ok", "aaaaaaaaaaaaaaaa" * 5, ""]
    for key in (1, 2):
        assert encoded(model, texts, [key] * 5, rate) == [reference(model, t, key, rate) for t in texts]


def test_keys_vary_the_pieces_and_repeat_them(model):
    text = "internationalization of segmentations"
    many = encoded(model, [text] * 50, range(50), 0.3)
    assert len({tuple(x) for x in many}) > 10
    assert many == encoded(model, [text] * 50, range(50), 0.3)
    assert {len(x) for x in encoded(model, [text], [0], 1.0)} == {len(text) + 1}


def test_odd_rows(odd_docs, no_docs, model):
    rows = pieces.with_pieces(odd_docs.withColumnRenamed("source", "pieces"), model).withColumn("back", pieces.decode("pieces", model)).collect()
    assert len(rows) == odd_docs.count() and all(r.back == r.text for r in rows)
    assert [r.pieces for r in rows if r.text is None] == [None, None] and [r.pieces for r in rows if r.text == ""] == [[]]
    assert pieces.with_pieces(no_docs, model).count() == 0


def test_query_is_lossless(spark):
    rows = queries.op5_sentencepiece(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 200 and all(r.lossless and r.n_pieces == len(r.pieces) for r in rows)


def test_texts_are_decoded_as_buffers(monkeypatch):
    model = pieces.load_model()
    texts = ["", "a", "ÄÖ 漢字 🙂", " two  spaces ", "▁"] * 400
    gone = np.arange(len(texts) + 1) % 7 == 3
    gone[-1] = False
    ids, at = pieces.encode_texts(model, ["" if g else t for t, g in zip(texts, gone)], np.arange(len(texts)), 0.1)
    lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32), mask=gone), pa.array(ids))
    expected = [None if g else t for t, g in zip(texts, gone)]
    monkeypatch.setattr(pieces, "_PIECES", 100)
    assert pieces.decode_lists(model, lists).to_pylist() == expected
    assert pieces.decode_lists(model, lists.slice(5, 40)).to_pylist() == expected[5:45]
    assert pieces.decode_lists(model, lists[:0]).to_pylist() == []
    mark, *most, last = pieces.encode_texts(model, ["\U0001f9ff"], np.zeros(1), 0.0)[0].tolist()
    with pytest.raises(ValueError):
        pieces.decode_lists(model, pa.array([[mark, *most], [mark, last]], pa.list_(pa.int32())))


@pytest.mark.parametrize("rate", [2.0**-53, 1e-9, 0.1, 1 / 3, 0.5, 1 - 2.0**-53, 1.0])
def test_skips_are_those_of_the_53_upper_bits(rate):
    key = pieces.mix(np.arange(20_000, dtype=np.uint64))
    place = np.arange(20_000) % 29
    span = place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + (place + 1).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    drawn = pieces.mix(key + span + (place + 2).astype(np.uint64) * np.uint64(0x165667B19E3779F9))
    expected = (drawn >> np.uint64(11)).astype(np.float64) < rate * 2.0**53
    np.testing.assert_array_equal(pieces._skipped(key, place, place + 1, place + 2, rate), expected)
