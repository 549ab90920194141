import hashlib

from pyspark.sql import functions as F

from timeward.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, piece string"
TEXTS = [
    "", "plain", None, "</turn>", "</turn>\n### assistant: more</turn>\n", "\\", "\\\\", "\\</turn>", "<\\/turn>", "</turn", "### user: x",
    "a: b # c", "\n", "\n### x: y", "é\U0001f600</turn>ß", "$1 \\1 $", "x" * 30_000, "\\### Assistant: </turn> ok", "\\:\\#",
]
ROLES = ["user", "assistant", "system", "a:b", "", None, "\\", "x</turn>", "assis\ntant", "assistant "]


def _turns():
    return [(k % 7, k // 7, role, text, "old") for k, (role, text) in enumerate((r, t) for r in ROLES for t in TEXTS)]


def _source(rows):
    held = {}
    for c, turn, role, text, *_ in rows:
        held.setdefault(c, []).append((turn, role or "", text or ""))
    return {c: [t[1:] for t in sorted(v)] for c, v in held.items()}


def test_every_turn_comes_back(spark):
    rows = _turns()
    made = chat.conversations(spark.createDataFrame(rows, SCHEMA))
    for r in made.withColumn("turns", chat.parse(F.col("formatted"))).collect():
        want = _source(rows)[r["conv_id"]]
        assert [tuple(t) for t in r["turns"]] == want
        pieces = r["formatted"].split(chat.END)[:-1]
        assert len(pieces) == len(want)
        learned = [t for role, t in want if role == "assistant"]
        under = [r["formatted"][s["start"] : s["end"]] for s in r["loss_spans"]]
        assert len(under) == len(learned)
        for shown, text in zip(under, learned):
            assert shown == text or shown.replace("\\/", "/").replace("\\:", ":").replace("\\#", "#").replace("\\\\", "\\") == text
            assert (shown == text) == (chat.END not in text)


def test_digests_of_what_is_read_back(spark):
    rows = _turns()
    found = chat.read_back(chat.conversations(spark.createDataFrame(rows, SCHEMA))).collect()
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    for r in found:
        want = _source(rows)[r["conv_id"]]
        loss = "".join(t for role, t in want if role == "assistant")
        assert r["n_turns"] == len(want)
        assert r["turns_sha256"] == sha("".join(f"{a}\n{b}\n" for a, b in want))
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), sha(loss))


def test_only_conflicts_are_escaped(spark):
    rows = [(1, 0, "user", "a: b # c \\ d", ""), (1, 1, "assistant", "x </turn> y", "")]
    turns = chat.rendered_turns(spark.createDataFrame(rows, SCHEMA)).orderBy("turn").collect()
    assert [t["escaped"] for t in turns] == [False, True]
    assert turns[0]["piece"] == "### user: a: b # c \\ d</turn>\n"
    assert turns[1]["piece"] == "### assistant:\\ x <\\/turn> y</turn>\n"


def test_order_ties_and_nulls(spark):
    rows = [(None, 1, "user", "b", ""), (None, None, "user", "a", ""), (2, 0, "user", "y", ""), (2, 0, "user", "x", ""), (2, 0, "user", "x", "")]
    made = {r["conv_id"]: r["formatted"] for r in chat.conversations(spark.createDataFrame(rows, SCHEMA)).collect()}
    turn = "### user: {}</turn>\n".format
    assert made == {None: turn("a") + turn("b"), 2: turn("x") + turn("x") + turn("y")}


def test_one_conversation_of_many_turns(spark):
    rows = [(1, k, "assistant" if k % 2 else "user", f"turn {k}", "") for k in range(3000)]
    r = chat.read_back(chat.conversations(spark.createDataFrame(rows, SCHEMA))).first()
    assert r["n_turns"] == 3000
    assert r["loss_chars"] == sum(len(t[3]) for t in rows if t[2] == "assistant")


def test_no_rows(spark):
    assert chat.read_back(chat.conversations(spark.createDataFrame([], SCHEMA))).count() == 0
