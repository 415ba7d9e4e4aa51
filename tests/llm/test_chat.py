"""Chat formatting: exact round trips and the order of roles."""

import hashlib
import random

import pytest

from folioscope.llm import chat as C
from folioscope.llm import queries as Q
from folioscope.llm.common import table


def test_round_trip_of_random_texts():
    rng, parts = random.Random(2), [*C.INSTRUCT.controls, "\\", "]", "[", "<", "/", "s>", "a", "\n", "é", "INST]"]
    for _ in range(2000):
        turns = [(rng.choice(["user", "assistant", "system", "", "t]o\\ol", "x[/TURN]"]), "".join(rng.choice(parts) for _ in range(rng.randrange(8)))) for _ in range(rng.randrange(4))]
        text = "".join(s for r, t in turns for s, _ in C.INSTRUCT.segments(r, t))
        found = []
        while got := C.INSTRUCT.take(text):
            found.append(got[:2])
            text = text[got[2] :]
        assert found == turns and not text


def test_escaped_text_has_no_control_string():
    for c in C.INSTRUCT.controls:
        assert not any(x in C.INSTRUCT.escape(c * 2 + "\\" + c) for x in C.INSTRUCT.controls)


def test_template_needs_clear_marks():
    with pytest.raises(ValueError):
        C.Template("<s>", {}, C.Turn("[a", "b]["), "]", {}, ())


def test_query(spark, sf):
    rows = [r for r in table(spark, sf, "conversations").collect()]
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in rows] + [(-7, i, w, "</s>[INST] ok [/INST]") for i, w in enumerate(("user", "assistant"))]
    want = {}
    for conv in {r[0] for r in rows}:
        own = sorted(r for r in rows if r[0] == conv)
        loss = "".join(r[3] for r in own if r[2] == "assistant")
        want[conv] = (len(own), hashlib.sha256("".join(f"{r[2]}\n{r[3]}\n" for r in own).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    got = Q.QUERIES["op1_chat_formatting"](spark, sf).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == want
    assert all(r.formatted_chars > r.loss_chars for r in got)


def test_order_nulls_and_repeats(spark):
    rows = [(1, 0, "system", "s", 1), (1, 1, "user", "u", 1), (1, 2, "assistant", None, 1), (2, 0, "assistant", "a", 1), (3, 0, "user", "u", 1), (3, 0, "user", "u", 1), (4, None, None, "x", 1), (None, 0, "user", "long " * 50_000, 1), (None, 1, "assistant", "ok", 1)]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, segment int")
    got = {r.conv_id: (r.n_turns, r.valid, r.first_bad_turn) for r in C.read_back(C.format_chats(turns)).collect()}
    assert got == {1: (3, True, None), 2: (1, False, 0), 3: (2, False, 1), 4: (1, False, 0), None: (2, True, None)}
    assert C.read_back(C.format_chats(turns.limit(0))).count() == 0


def test_a_conversation_of_very_many_turns(spark):
    n = 60_000
    turns = spark.range(n).selectExpr("1L AS conv_id", "id AS turn", "if(id % 2 = 0, 'user', 'assistant') AS role", "concat('[INST] ', id, ' </s>') AS text").repartition(8)
    row = C.read_back(C.format_chats(turns)).first()
    said = [("user", "assistant")[i % 2] + f"\n[INST] {i} </s>\n" for i in range(n)]
    loss = "".join(f"[INST] {i} </s>" for i in range(1, n, 2))
    assert (row.conv_id, row.n_turns, row.loss_chars) == (1, n, len(loss))
    assert row.turns_sha256 == hashlib.sha256("".join(said).encode()).hexdigest() and row.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
