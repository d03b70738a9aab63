import hashlib
import random

from pyspark.sql import functions as F

from rowtide.llm import chat

PARTS = f"conv_id long, turn int, role string, parts {chat.PARTS}, loss int, n string"


def formatted(spark, rows):
    messages = spark.createDataFrame([(*r, 1, "x") for r in rows], PARTS)
    return {r["conv_id"]: r for r in chat.format_chats(messages).collect()}


def text(t):
    return [("text", t, None, None)]


def brute_escape(t):
    t = t.replace("\\", "\\\\")
    return "".join(c + "\\" if any(t.startswith(s, i) for s in chat.CONTROL) else c for i, c in enumerate(t))


def test_parts_become_placeholders(spark):
    parts = [("text", "see <|image|> ", None, None), ("image", None, "a.png", 2.5), ("text", None, None, None), ("audio", "x", "b.wav", 0.0),
             (None, "[INST]", None, None), ("document", None, "c.pdf", None), ("film", None, "d.mp4", -1.0)]
    got = formatted(spark, [(1, 2, "assistant", parts), (1, 1, "user", None), (1, None, "a<|text|>", [])])[1]
    content = "see <\\|image|> <|image|><|audio|>[\\INST]<|document|><|document|>"
    assert got["formatted"] == f"<|turn|>a<\\|text|><|text|><|end|><|turn|>user<|text|><|end|><|turn|>assistant<|text|>{content}<|end|>"
    assert [tuple(a) for a in got["attachments"]] == [
        (2, "image", "a.png", 640), (2, "audio", "b.wav", 1), (2, "document", "c.pdf", 512), (2, "film", "d.mp4", 512)]
    assert got["expanded_tokens"] == 1665 and got["n_turns"] == 3
    assert [got["formatted"][s["start"] : s["end"]] for s in got["loss_spans"]] == [content]
    assert "".join(s["text"] for s in got["segments"]) == got["formatted"]
    assert [s["text"] for s in got["segments"] if s["loss"]] == [content]


def test_escapes_against_brute_force_and_back(spark):
    rng = random.Random(9)
    bits = [*chat.CONTROL, "\\", "<", "|", ">", "[", "é😀", "\n", "turn", "a "]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(12))) for _ in range(500)]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in frame.select("t", chat.escape(F.col("t")).alias("e"), chat.unescape(chat.escape(F.col("t"))).alias("u")).collect():
        assert r["e"] == brute_escape(r["t"]) and r["u"] == r["t"]
        assert not any(s in r["e"] for s in chat.CONTROL)


def test_digests_against_brute_force(spark):
    rng = random.Random(10)
    rows = []
    for conv in (1, 2, None):
        for turn in range(5):
            said = rng.choice(["", "hi \\", "</s>[INST] ok [/INST]", "a<|end|>\n<|turn|>user", "é" * 30])
            rows.append((conv, turn, rng.choice(["user", "assistant", None]), said))
    rows += [rows[0], (3, 0, "assistant", None), (4, None, "assistant", "x" * 200_000)]
    frame = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    chats = chat.format_chats(frame.withColumn("parts", chat.text_parts(F.col("text"))))
    got = {r["conv_id"]: tuple(r)[1:] for r in chat.digests(chats).collect()}
    for conv in {r[0] for r in rows}:
        key = lambda r: (r[1] is not None, r[1], brute_escape(r[2] or ""), brute_escape(r[3] or ""))
        turns = sorted((r for r in rows if r[0] == conv), key=key)
        said = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns)
        loss = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        size = sum(len(brute_escape(r[2] or "")) + len(brute_escape(r[3] or "")) + 23 for r in turns)
        assert got[conv] == (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss),
                             hashlib.sha256(loss.encode()).hexdigest(), size)


def test_empty_table_and_plan(spark):
    assert formatted(spark, []) == {}
    frame = spark.createDataFrame([(1, 1, "user", text("a"), 1, "x")], PARTS)
    assert "Python" not in chat.digests(chat.format_chats(frame))._jdf.queryExecution().toString()
