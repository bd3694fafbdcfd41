import hashlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from check import compare, connect
from shapeloom.llm import chat, queries
from shapeloom.llm.common import text_buffers

SF_DIR = "/root/testdata/sf0.001"
WORDS = st.sampled_from(["</s>", "[INST]", "\\", "<", "/s>", "[", "é", "<|turn|>", "<|end|>\n", "a", "", "<<SYS>>", "\n"])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(WORDS).map("".join), max_size=5))
def test_escaping_is_reversible_and_leaves_no_control_string(texts):
    data, at = chat.escape(*text_buffers(pa.array(texts, pa.string())))
    for i, text in enumerate(texts):
        raw = data[at[i] : at[i + 1]].tobytes()
        assert chat.unescape(raw).decode() == text
        assert not any(mark in raw for mark in chat.CONTROL)


def rows_of(frame):
    return {r.conv_id: r for r in frame.collect()}


def test_order_nulls_ties_and_blocks(spark):
    rows = [(1, t, "assistant" if t % 2 else "user", f"t{t} </s>", "x") for t in range(300)]
    rows += [(2, None, None, None, None), (2, 0, "user", "", "y"), (2, 0, "assistant", "b", "y"), (2, 0, "assistant", "b", "y"), (None, 5, "user", "no id", "z")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string").repartition(5)
    got = rows_of(chat.format_chats(turns))
    assert set(got) == {1, 2, None} and got[1].n_turns == 300 and got[2].n_turns == 4
    assert [t for _, t in chat.read_turns(got[1].formatted.encode())] == [f"t{t} </s>".encode() for t in range(300)]
    assert list(chat.read_turns(got[2].formatted.encode())) == [(b"assistant", b"b"), (b"assistant", b"b"), (b"user", b""), (b"", b"")]
    raw = got[1].formatted.encode()
    learned = [chat.unescape(raw[a:b]).decode() for a, b in zip(got[1].loss_start, got[1].loss_end)]
    assert learned == [f"t{t} </s>" for t in range(1, 300, 2)]
    digest = {r.conv_id: r for r in chat.chat_digests(chat.format_chats(turns)).collect()}
    assert digest[2].turns_sha256 == hashlib.sha256(b"assistant\nb\nassistant\nb\nuser\n\n\n\n").hexdigest()
    assert chat.format_chats(turns.limit(0)).count() == 0


def test_very_long_turn(spark):
    turns = spark.createDataFrame([(1, 0, "assistant", "[INST]\\" * 200_000)], "conv_id long, turn long, role string, text string")
    assert chat.chat_digests(chat.format_chats(turns)).first().loss_chars == 1_400_000


def test_query_matches_sql(spark):
    assert compare(queries.op1_chat_format(spark, SF_DIR), connect(SF_DIR), queries.ORACLE["op1_chat_format"]) == ""


def test_offsets_add_up():
    data, at, begin, end = chat.assemble(pa.array(["user", None]), pa.array(["<s>", "é"]))
    assert data.tobytes() == b"<|turn|>user<|text|><\\s><|end|>\n<|turn|><|text|>" + "é".encode() + b"<|end|>\n"
    assert at[-1] == len(data) and np.all(end - begin == [4, 2])
    assert pytest.approx(at[1]) == 4 + 4 + 24
