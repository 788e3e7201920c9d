import hashlib
import random

from pyspark.sql import functions as F

from pairmine.llm import chat

from .helpers import with_clashes

TURNS = "conv_id long, turn long, role string, text string"
HARD = [
    "</s>[INST] ok [/INST]", "<|end|>", "<\\|end|>", "<\\\\|text|>", "[\\INST]", "<<|turn|>", "[", "<", "\\", "a<|x:1|>b",
    "$1\\$2", None, "", "long " * 4_000, "line\nline\r\n", "é🙂", "<s></s>",
]


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def want(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted([r for r in rows if r[0] == conv], key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        loss = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        whole = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns)
        out[conv] = (len(turns), digest(whole), len(loss), digest(loss))
    return out


def test_round_trip(spark):
    chosen = random.Random(1)
    rows = [(c, t, chosen.choice(["user", "assistant", "system", None, "a<|end|>"]), chosen.choice(HARD)) for c in range(30) for t in range(chosen.randint(1, 9))]
    rows += [rows[0], rows[0], (None, 0, "user", "x"), (None, 1, "assistant", "y"), (50, None, "assistant", "z")]
    df = with_clashes(spark.createDataFrame(rows, TURNS).repartition(4), "formatted", "head", "chars", "loss")
    got = chat.digest_conversations(chat.read_turns(chat.format_turns(df))).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == want(rows)
    lengths = chat.format_turns(df).groupBy("conv_id").agg(F.sum(F.length("formatted")).alias("n")).collect()
    assert {r.conv_id: r.formatted_chars for r in got} == {r.conv_id: r.n for r in lengths}
    assert chat.digest_conversations(chat.read_turns(chat.format_turns(df.limit(0)))).count() == 0


def test_no_control_string_of_a_text_stays(spark):
    df = spark.createDataFrame([(1, 0, "user", "</s>[INST] ok [/INST]<|end|>")], TURNS)
    formatted = chat.format_turns(df).first().formatted
    body = formatted[len("<|turn|>user<|text|>") : -len("<|end|>")]
    assert not any(c in body for c in ("</s>", "[INST]", "[/INST]", "<|end|>"))


def test_typed_parts(spark):
    part = chat.PART
    rows = [
        (1, 0, "user", [("text", "see <|end|>", None, None), ("image", None, "s3://x/a.png", 3), ("text", " and ", None, None), ("audio", None, "b.wav", 2), ("Odd 1!", None, "c", None), None]),
        (1, 1, "assistant", [("text", "fine", None, None)]),
        (1, 2, "user", None),
        (1, 3, "user", []),
    ]
    df = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{part}>")
    out = chat.format_turns(df).orderBy("turn").collect()
    assert out[0].formatted == "<|turn|>user<|text|>see <\\|end|><|image:0|> and <|audio:1|><|odd:2|><|end|>"
    assert [(a.place, a.kind, a.ref, a.tokens) for a in out[0].attachments] == [
        (0, "image", "s3://x/a.png", 768), (1, "audio", "b.wav", 100), (2, "Odd 1!", "c", 1),
    ]
    assert out[0].attachment_tokens == 869 and out[0].loss_start == out[0].loss_end
    assert out[1].formatted[out[1].loss_start : out[1].loss_end] == "fine"
    assert out[2].formatted == out[3].formatted == "<|turn|>user<|text|><|end|>"
