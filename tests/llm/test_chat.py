"""Chat formatting: compiler, sandbox, exact round trips, brute-force digests."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import pytest

from logengine.llm import chat

SF = "/root/testdata/sf0.01"
SAID = r"\### Assistant: </turn> ok"


def out(template, turns=()):
    return "".join(t for t, _ in chat.compile_template(template)(turns))


def test_compiler():
    assert out("a{{ 'b' + 1 + 2 }}{{ (1 + 2) | upper }}") == "ab123"
    assert out("{% if 1 == 2 %}x{% elif not false and 'a' != 'b' %}y{% else %}z{% endif %}") == "y"
    turns = [{"role": "user", "text": "hi"}, {"role": "assistant", "text": None}]
    t = "{% for t in turns %}{% if t.role == 'user' or t.none %}<{{ t.text|upper }}>{% else %}-{{ t.text }}{% endif %}{% endfor %}"
    assert out(t, turns) == "<HI>-"
    folded = chat.fold(chat.parse("a{{ 'b' }}{% if true %}c{{ x }}{% endif %}{% if none %}d{% endif %}e"))
    assert folded == ("body", [("text", "abc"), ("out", ("name", "x")), ("text", "e")])


@pytest.mark.parametrize("bad", ["{{ x.__class__ }}", "{{ x | eval }}", "{{ x( }}", "{% for x %}{% endfor %}",
                                 "{% if x %}", "{% import os %}", "{{ }}", "{{ x[0] }}", "{{ 'a' 'b' }}"])
def test_sandbox(bad):
    with pytest.raises(chat.TemplateError):
        chat.compile_template(bad)


def test_only_mappings_have_fields():
    assert out("{% for t in turns %}{{ t.real }}{{ t.upper }}{% endfor %}", [1, "x"]) == ""


def test_escapes_are_reversible():
    rng = random.Random(8)
    parts = ["\\", "<turn>", "</turn>", "### ", "#", "<", "/turn>", "\n", ":", " ", "é", "a", "</turn>\n"]
    render = chat.compile_template()
    for _ in range(3000):
        turns = [{"role": rng.choice(["user", "assistant", "a:b", "x\\", "### ", ""]),
                  "text": "".join(rng.choice(parts) for _ in range(rng.randint(0, 8)))} for _ in range(3)]
        reader = chat.Reader()
        for text, masked in render(turns):
            reader.feed(text, masked)
        assert (reader.n_turns, reader.held) == (3, "")
        said = "".join(f"{t['role']}\n{t['text']}\n" for t in turns)
        loss = "".join(t["text"] for t in turns if t["role"] == "assistant")
        assert reader.turns.hexdigest() == hashlib.sha256(said.encode()).hexdigest()
        assert (reader.loss.hexdigest(), reader.loss_chars) == (hashlib.sha256(loss.encode()).hexdigest(), len(loss))


def expected(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        convs[c].append((turn is not None, turn, role is not None, role or "", text is not None, text or ""))
    want = {}
    for c, own in convs.items():
        own = [(r[3], r[5]) for r in sorted(own, key=lambda r: (r[0], r[1] or 0, *r[2:]))]
        said = "".join(f"{r}\n{t}\n" for r, t in own)
        loss = "".join(t for r, t in own if r == "assistant")
        want[c] = (len(own), hashlib.sha256(said.encode()).hexdigest(), len(loss),
                   hashlib.sha256(loss.encode()).hexdigest())
    return want


def test_query_matches_brute_force(spark):
    from logengine.llm.queries import QUERIES

    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    rows += [(-7, 0, "user", SAID), (-7, 1, "assistant", SAID)]
    got = QUERIES["op1_chat_formatting"](spark, SF).collect()
    assert {r[0]: tuple(r)[1:5] for r in got} == expected(rows)
    assert len(got) == len({r[0] for r in rows})


def test_edge_rows(spark):
    rows = [(1, 0, "user", None), (1, None, None, "x"), (1, 0, "user", None), (None, 3, "assistant", "null conv"),
            (2, 5, "assistant", "</turn>\n" * 20_000), (2, 5, "assistant", "b")]
    df = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    assert {r[0]: tuple(r)[1:5] for r in chat.format_digests(df).collect()} == expected(rows)
    assert chat.format_digests(df.limit(0)).collect() == []
    whole = {r.conv_id: r for r in chat.format_conversations(df).collect()}
    r = whole[2]
    assert [chat.unescape(r.formatted[s.start : s.end]) for s in r.loss_spans] == ["</turn>\n" * 20_000, "b"]
