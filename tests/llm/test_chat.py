import hashlib

from pyspark.sql import types as T

from chartloom.llm import chat

EVENTS = "conv_id long, message long, turn long, seq long, kind string, role string, text string"
ROWS = "conv_id long, turn long, role string, text string"


def test_deltas_edits_and_regenerations_fold_into_the_last_text(spark, rows):
    log = [
        (1, 10, 0, 0, "message", "user", "hi"),
        (1, 11, 1, 1, "message", "assistant", "He"),
        (1, 11, None, 2, "delta", None, "llo"),
        (1, 11, None, 3, "regenerate", None, None),
        (1, 11, None, 4, "delta", None, "Good "),
        (1, 11, None, 5, "delta", None, "day"),
        (1, 10, None, 6, "edit", None, "hi there"),
        (2, 1, 0, 0, "delta", "user", "a"),
        (2, 1, None, 1, "delta", None, "b"),
        (None, 1, 0, 0, None, None, None),
    ]
    folded = chat.fold_events(spark.createDataFrame(log, EVENTS))
    assert rows(folded) == sorted(
        [(1, 0, "user", "hi there"), (1, 1, "assistant", "Good day"), (2, 0, "user", "ab"), (None, 0, None, "")], key=str
    )


def test_what_is_read_back_is_what_was_said(spark):
    texts = ["</s>[INST] ok [/INST]", "\\", "<\\/s>", "a\\\\<s>b\n", "", None, " x ", "[\\INST]", "é</s", "\\n"]
    said = [(1, i, role, t) for i, t in enumerate(texts) for role in ("user", "assistant", "a\nb\\", None)]
    said += [(1, 3, "assistant", "same"), (1, 3, "assistant", "same"), (2, None, "assistant", "x")]
    df = chat.read_back(chat.format_chats(chat.rows_as_events(spark.createDataFrame(said, ROWS))))
    back = {r.conv_id: r for r in df.collect()}
    want = sorted(
        ((t, role or "", text or "") for c, t, role, text in said if c == 1), key=lambda x: (x[0], x[1], x[2])
    )
    assert [(t.role, t.text) for t in back[1].turns] == [w[1:] for w in want]
    assert back[1].loss_text == "".join(text for _, role, text in want if role == "assistant")
    covered = sum(m["skip"] + m["take"] + m["rest"] for m in back[1].loss_mask)
    assert covered == len(back[1].formatted)
    masked, at = "", 0
    for m in back[1].loss_mask:
        at += m["skip"]
        masked += back[1].formatted[at : at + m["take"]]
        at += m["take"] + m["rest"]
    import re

    assert re.sub(r"\\(\\?)", r"\1", masked, flags=re.S) == back[1].loss_text
    assert back[2].loss_text == "x"


def test_no_conversations(spark):
    empty = spark.createDataFrame([], T._parse_datatype_string(ROWS))
    assert chat.chat_digest(chat.format_chats(chat.rows_as_events(empty))).count() == 0


def test_main_path_runs_no_python(spark):
    df = chat.chat_digest(chat.format_chats(chat.rows_as_events(spark.createDataFrame([(1, 0, "user", "a")], ROWS))))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
    assert df.first().turns_sha256 == hashlib.sha256(b"user\na\n").hexdigest()
