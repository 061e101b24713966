"""Spans, escapes and digests read back from formatted conversations."""

import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from tillwise.llm import chat_format as chat

TEXTS = st.lists(st.sampled_from(["[", "]", "<", ">", "\\", "s", "/", "[END]</s>\n", "<s>[ROLE]", "é", "", "\n", "🙂", "\\(", "ok "]), max_size=8).map("".join)
TURNS = st.lists(st.tuples(TEXTS, TEXTS), max_size=6)


@settings(max_examples=300, deadline=None)
@given(TURNS)
def test_escapes_and_spans(turns):
    out, rewritten, spans = chat.locate(turns, chat.BRACKETS)
    assert rewritten is None and chat.read_back(out) == turns
    at = 0
    for (_, text), (start, first, last, end) in zip(turns, spans):
        assert start == at and chat.unescape(out[first:last]) == text and out[first:last] == chat.escape(text)
        at = end
    assert at == len(out)


def test_other_templates():
    trimmed = lambda turns: "".join(f"{role}: {text.strip()} |" for role, text in turns)
    out, _, spans = chat.locate([("user", "  hi  "), ("assistant", "| | x |")], trimmed)
    assert [out[a:b] for _, a, b, _ in spans] == ["hi", "| | x |"]
    silent = lambda turns: "".join(f"<{role}>" for role, _ in turns)
    _, _, spans = chat.locate([("user", "hi")], silent)
    assert spans == [(0, 6, 6, 6)]  # a template that shows no text


def test_templates_that_rewrite_history():
    last_only = lambda turns: "".join(f"[{r}]{t if i == len(turns) - 1 else '...'}" for i, (r, t) in enumerate(turns))
    out, rewritten, spans = chat.locate([("user", "a"), ("assistant", "b"), ("user", "c")], last_only)
    assert rewritten == 1 and spans == [None] * 3 and out == "[user]...[assistant]...[user]c"


def test_format_and_digest(spark):
    said = "</s>[INST] ok [/INST]"
    rows = [
        (-1, 0, "user", said, 1), (-1, 1, "assistant", said, 1), (7, 1, "assistant", "b" * 30_000, 1), (7, 0, "user", None, 1), (7, 1, "assistant", "a", 1),
        (8, None, None, "x", 1), (8, 0, "assistant", "", None), (None, 0, "assistant", "n", 1), (7, 1, "assistant", "a", 1),
    ]
    talks = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, spans int").repartition(4)
    formatted = chat.format_conversations(talks)
    found = {r.conv_id: r for r in chat.digest(formatted).collect()}
    texts = {r.conv_id: r.formatted for r in formatted.collect()}
    wanted = {
        -1: [("user", said), ("assistant", said)], 7: [("user", ""), ("assistant", "a"), ("assistant", "a"), ("assistant", "b" * 30_000)],
        8: [("", "x"), ("assistant", "")], None: [("assistant", "n")],
    }
    assert found.keys() == wanted.keys()
    for conv, turns in wanted.items():
        r, loss = found[conv], "".join(text for role, text in turns if role == "assistant")
        every = "".join(f"{role}\n{text}\n" for role, text in turns)
        assert (r.n_turns, r.loss_chars, r.formatted_chars) == (len(turns), len(loss), len(texts[conv]))
        assert r.turns_sha256 == hashlib.sha256(every.encode()).hexdigest() and r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert chat.digest(chat.format_conversations(talks.limit(0))).count() == 0


def test_rewriting_template_in_spark(spark):
    talks = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "user", "b"), (2, 0, "user", "c")], "conv_id bigint, turn bigint, role string, text string")
    newest = lambda turns: turns[-1][1] if turns else ""
    found = {r.conv_id: (r.formatted, r.rewritten_at, r.spans) for r in chat.format_conversations(talks, newest).collect()}
    assert found[1] == ("b", 1, None) and found[2][:2] == ("c", None) and found[2][2][0].text_end == 1
