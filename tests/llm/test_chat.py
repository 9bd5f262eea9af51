import hashlib
import random

from pyspark.sql import functions as F

from corpweave.llm import chat

from .conftest import pairs

SCHEMA = "conv_id bigint, turn bigint, role string, text string, example int, upto string"
CONTROLS = ["<|im_start|>", "<|im_end|>", "<|im_end|>\n", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<\\|im_end|>", "[\\\\INST]",
            "\\", "<", "[", "|im_end|>", "\n", "é漢\U0001f600", "$1", "word", "", "assistant", "&lt;"]


def made_turns(n=120):
    rng = random.Random(6)
    text = lambda: "".join(rng.choice(CONTROLS) for _ in range(rng.randrange(6)))
    rows = []
    for conv in range(n):
        for turn in range(rng.randrange(1, 7)):
            role = rng.choice(["user", "assistant", "system", "assistant", None, "odd\nrole", "back\\n", "<|im_end|>"])
            rows.append((conv, turn, role, rng.choice([text(), text(), None]), 1, "x"))
    rows += [(-1, None, "user", "a", 1, "x"), (-1, 0, "assistant", "b", 1, "x"), (None, 0, "user", "n", 1, "x")]
    rows += [(-2, 1, "assistant", "tie", 1, "x"), (-2, 1, "assistant", "tie", 1, "x"), (-2, 1, "user", "tie", 1, "x")]
    return rows


def ordered(rows):
    talks = {}
    for conv, turn, role, text, *_ in rows:
        talks.setdefault(conv, []).append((float("-inf") if turn is None else turn, role or "", text or ""))
    return {conv: sorted(turns) for conv, turns in talks.items()}


def test_everything_reads_back(spark):
    rows = made_turns()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    examples = chat.expand_examples(df)
    got = {r["conv_id"]: r for r in chat.digests(examples).collect()}
    for conv, turns in ordered(rows).items():
        whole = "".join(f"{role}\n{text}\n" for _, role, text in turns)
        loss = "".join(text for _, role, text in turns if role == "assistant")
        r = got[conv]
        assert r["n_turns"] == len(turns)
        assert r["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest(), (conv, turns)
        assert r["loss_chars"] == len(loss) and r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    assert len(got) == len(ordered(rows))


def test_each_assistant_turn_is_one_example_with_its_past(spark):
    rows = [(1, i, role, f"text {i}", 1, "") for i, role in enumerate(["system", "user", "assistant", "user", "assistant", "user"])]
    found = pairs(chat.expand_examples(spark.createDataFrame(rows, SCHEMA)), "example", "text", "loss_start", "loss_end", "is_last")
    turn = lambda i: f"<|im_start|>{rows[i][2]}\ntext {i}<|im_end|>\n"
    texts = ["".join(map(turn, range(n))) for n in (3, 5, 6)]
    assert [f[1] for f in found] == texts
    assert [f[1][f[2] : f[3]] for f in found[:2]] == ["text 2", "text 4"]
    assert found[2][2:] == (None, None, True) and not found[0][4]


def test_no_raw_control_strings_inside(spark):
    examples = chat.expand_examples(spark.createDataFrame(made_turns(), SCHEMA))
    turns = F.size(F.split("text", r"<\|im_end\|>\n")) - 1
    starts = F.size(F.split("text", r"<\|im_start\|>")) - 1
    assert examples.where(turns != starts).count() == 0
    assert examples.where(F.col("text").rlike(r"</s>|\[INST\]|\[/INST\]")).count() == 0


def test_plan_is_native_and_empty_tables_pass(spark):
    df = spark.createDataFrame(made_turns(3), SCHEMA)
    out = chat.digests(chat.expand_examples(df))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert chat.digests(chat.expand_examples(df.where("false"))).count() == 0
