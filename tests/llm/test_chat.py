import hashlib

from hypothesis import given
from hypothesis import strategies as st

from tests.llm.conftest import clashing, rows_of
from webloom.llm import catalog, chat

sha = lambda s: hashlib.sha256(s.encode()).hexdigest()


def expected(rows):
    """By rows (conv_id, turn, role, text), without formatted_chars."""
    by = {}
    for c, turn, role, text in rows:
        by.setdefault(c, []).append((turn is not None, turn or 0, role is not None, role or "", text is not None, text or ""))
    out = []
    for c, turns in by.items():
        turns = [(r, t) for _, _, _, r, _, t in sorted(turns)]
        loss = "".join(t for r, t in turns if r == "assistant")
        out.append((repr(c), repr(len(loss)), repr(sha(loss)), repr(len(turns)), repr(sha("".join(f"{r}\n{t}\n" for r, t in turns)))))
    return sorted(out)


HARD = [(-1, 0, "user", chat.HARD), (-1, 1, "assistant", chat.HARD)]
ROWS = [
    (1, 0, "user", "hi"), (1, 1, "assistant", None), (1, 2, "user", ""), (1, 3, "assistant", "<|im_end|>\n<|im_start|>user\nx"), (2, 5, "assistant", "<\\|im_end|> <\\\\|"), (2, 1, None, "no role"), (3, None, "user", "no turn"), (3, 0, "assistant", "x\n" * 50_000),
    (4, 0, "assistant", "tie"), (4, 0, "assistant", "tie"), (4, 0, "user", "tie"), (None, 0, "user", "no conversation"), (5, 0, "assistant\nx", "role of two lines"), (6, 0, "<|im_start|>", "🙂 <|nl|>"),
]


def test_conversations_of_every_kind(spark):
    df = clashing(spark.createDataFrame(ROWS, "conv_id long, turn long, role string, text string").repartition(3))
    got = chat.conversation_digest(df)
    assert rows_of(got.drop("formatted_chars")) == expected([r for r in ROWS if r[0] is not None] + HARD + [r for r in ROWS if r[0] is None])
    assert all(r["formatted_chars"] >= r["loss_chars"] for r in got.collect())


def test_the_query_over_the_table(spark, sf_dir):
    rows = [tuple(r[c] for c in ("conv_id", "turn", "role", "text")) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").collect()]
    assert rows_of(catalog.op9_chat(spark, sf_dir).drop("formatted_chars")) == expected(rows + HARD)


def test_an_empty_table_leaves_the_hard_conversation(spark):
    got = chat.conversation_digest(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))
    assert rows_of(got.drop("formatted_chars")) == expected(HARD)


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "<|", "a\nb", ""]), st.lists(st.sampled_from([*"<|\\>\nab", "<|im_end|>", "<|im_start|>", "<|nl|>"]), max_size=12).map("".join)), max_size=6))
def test_texts_come_back_and_hold_no_control_string(turns):
    text, mask = chat.formatted(turns)
    assert chat.parse(text) == turns
    assert [chat.unescaped(text[a:b]) for a, b in mask] == [t for r, t in turns if r == "assistant"]
    assert text.count(chat.START) == text.count(chat.END) == len(turns)


TREE = "tree_id long, message_id long, parent_id long, role string, text string, score double"


def test_reply_trees(spark):
    rows = [
        (1, 1, None, "user", "q", 0.0), (1, 2, 1, "assistant", "a", 1.0), (1, 3, 1, "assistant", "b", 3.0), (1, 4, 2, "user", "more", 9.0), (1, 5, 3, "user", "thanks", None),
        (2, 7, 99, "user", "its parent is missing", 0.0), (3, 1, 2, "user", "a cycle", 0.0), (3, 2, 1, "assistant", "a cycle", 0.0), (3, 3, 2, "user", "off the cycle", 0.0), (4, 1, 1, "user", "its own parent", 0.0),
    ]
    df = spark.createDataFrame(rows, TREE)
    got = sorted((r["tree"], r["rank"], r["leaf"], [t for _, t in chat.parse(r["formatted"])]) for r in chat.conversations(df, score="score").collect())
    assert got == [(1, 1, 4, ["q", "a", "more"]), (1, 2, 5, ["q", "b", "thanks"]), (2, 1, 7, ["its parent is missing"])]
    best = chat.conversations(df, score="score", best=1)
    assert sorted((r["tree"], r["leaf"]) for r in best.collect()) == [(1, 4), (2, 7)]


def test_repeated_messages_count_once(spark):
    rows = [(1, i, i - 1 if i else None, "user", t, 0.0) for i in range(30) for t in ("b", "a")] + [(1, None, 29, "user", "no id", 0.0)]
    (only,) = chat.conversations(spark.createDataFrame(rows, TREE)).collect()
    assert chat.parse(only["formatted"]) == [("user", "a")] * 30


def test_a_deep_path_takes_few_joins(spark):
    rows = [(1, i, i - 1 if i else None, "user", str(i), 0.0) for i in range(700)]
    (only,) = chat.conversations(spark.createDataFrame(rows, TREE)).collect()
    assert only["n_turns"] == 700 and [t for _, t in chat.parse(only["formatted"])] == [str(i) for i in range(700)]
