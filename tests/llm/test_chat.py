import hashlib
import random

from quire.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def formatted(turns):
    esc = lambda t: t.replace("\\", "\\\\").replace("<|", "<\\|")
    return "".join(f"<|im_start|>{esc(r)}".replace("\n", "\\n") + "\n" + esc(t) + "<|im_end|>\n" for r, t in turns)


def expected(rows):
    by = {}
    for c, n, r, t in sorted(rows, key=lambda x: (str(x[0]), x[1] is not None, x[1] or 0, x[2] or "", x[3] or "")):
        by.setdefault(c, []).append((r or "", t or ""))
    out = {}
    for c, turns in by.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        out[c] = (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss), len(formatted(turns)))
    return out


def got(turns):
    return {r.conv_id: tuple(r)[1:] for r in chat.digest(chat.render(chat.fold(chat.events_of_turns(turns)))).collect()}


def test_round_trip(spark):
    rng = random.Random(2)
    parts = ["<|im_end|>", "<|im_start|>", "assistant", "\n", "\\", "<\\|", "|", "<", "é", "🙂", " ", "\\n", "user\n", "x"]
    text = lambda: "".join(rng.choices(parts, k=rng.randint(0, 8)))
    rows = [(c, t, rng.choice(["user", "assistant", "system", text()]), text()) for c in range(40) for t in range(rng.randint(1, 7))]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert got(frame) == expected(rows)
    one = chat.render(chat.fold(chat.events_of_turns(frame))).where("conv_id = 3").first()
    assert one.formatted == formatted([(r, t) for c, _, r, t in sorted(rows) if c == 3])


def test_live_log_folds_to_the_turns(spark):
    rng = random.Random(6)
    rows = [(c, rng.choice([t, t, None]), rng.choice(["user", "assistant", "system"]), rng.choice(["", "a", "bcd", "é🙂x y z", "w " * 50])) for c in range(30) for t in range(rng.randint(1, 6))]
    events = chat.events_of_turns(spark.createDataFrame(rows, SCHEMA).repartition(3))
    log = chat.streamed(events)
    assert {r.kind for r in log.select("kind").distinct().collect()} == {"message", "delta", "edit", "regenerate"}
    assert {r.conv_id: tuple(r)[1:] for r in chat.digest(chat.render(chat.fold(log))).collect()} == expected(rows)
    told: dict = {}
    for r in log.collect():
        told.setdefault(r.conv_id, []).append((r.seq, r.kind, r.message, r.role, r.text))
    found: dict = {}
    for r in chat.fold(log).collect():
        found.setdefault(r.conv_id, []).append((r.message, r.role, r.text))
    assert {c: sorted(v) for c, v in found.items()} == {c: fold(v) for c, v in told.items()}


def test_odd_rows(spark):
    rows = [(1, 0, "user", None), (1, 1, "assistant", ""), (1, 1, "assistant", ""), (None, None, None, None), (2, None, "assistant", "a" * 200_000), (2, 0, "assistant", "b"), (2, 0, "ASSISTANT", "c")]
    from pyspark.sql import functions as F

    frame = spark.createDataFrame(rows, SCHEMA).withColumn("message", F.lit(1)).withColumn("piece", F.lit("x"))
    assert got(frame) == expected(rows)
    assert got(frame.limit(0)) == {}


def fold(rows):
    """Events one by one."""
    messages: dict[int, list] = {}
    opened = 0
    for _, kind, target, role, text in sorted(rows, key=lambda r: r[0]):
        if kind == "message":
            messages[opened] = [role, text]
            opened += 1
            continue
        m = opened - 1 if target is None else target
        if not 0 <= m < opened:
            continue
        if m in messages:
            messages[m][1] = messages[m][1] + text if kind == "delta" else text
        if kind == "regenerate":
            for later in [k for k in messages if k > m]:
                del messages[later]
    return [(m, r, t) for m, (r, t) in sorted(messages.items())]


def test_deltas_edits_regenerations(spark):
    rng = random.Random(4)
    logs = {}
    for c in range(60):
        rows, n = [], 0
        for seq in range(rng.randint(1, 25)):
            kind = rng.choice(["message", "message", "delta", "delta", "delta", "edit", "regenerate"])
            n += kind == "message"
            target = None if kind == "message" or rng.random() < 0.6 else rng.randrange(max(1, n) + 1)
            rows.append((seq, kind, target, rng.choice(["user", "assistant"]), rng.choice(["a", "bc", "", "d "])))
        logs[c] = rows
    flat = [(c, s, k, m, r, t) for c, rows in logs.items() for s, k, m, r, t in rows]
    frame = spark.createDataFrame(flat, "conv_id long, seq long, kind string, message long, role string, text string").repartition(3)
    found: dict = {c: [] for c in logs}
    for r in chat.fold(frame).collect():
        found[r.conv_id].append((r.message, r.role, r.text))
    assert {c: sorted(v) for c, v in found.items()} == {c: fold(v) for c, v in logs.items()}


def test_no_python(spark):
    frame = spark.createDataFrame([(1, 0, "user", "x")], SCHEMA)
    turns = spark.sql("select 1L conv_id, 0L turn, 'user' role, 'x' text")
    plan = chat.digest(chat.render(chat.fold(chat.streamed(chat.events_of_turns(turns)))))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and frame
