"""Formatting against whole renderings, with several templates as black boxes."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gradeloom.llm.chat import (
    CONTROLS,
    OWN,
    Conversation,
    Template,
    escape,
    formatted_digest,
    formatted_turns,
    marked,
    read_marked,
    unescape,
)

SCHEMA = "conv_id long, turn long, role string, text string, added string, at string, conv string, turn_no string"
odd_texts = st.lists(st.sampled_from([*CONTROLS, "\\", "\n", "a", "<", "|", "[", "/", "", "é", "s>"]), max_size=12).map("".join)


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z", "u") for r in rows], SCHEMA)


def ended(turns):
    """One ending for the whole text, which every further turn moves."""
    return "<s>" + "".join(f"[{r}]{t}\n" for r, t in turns) + "</s>"


def folded(turns):
    """The system's text is told to the first user; a turn looks different behind it."""
    system = "".join(t for r, t in turns if r == "system")
    said, first = "<s>", True
    for r, t in turns:
        if r == "system":
            said += "<<SYS>>" + t + "<</SYS>>"
        elif r == "user":
            said += ("" if first and system else "[INST]") + t + "[/INST]"
            first = False
        else:
            said += t + "</s>"
    return said


def forgetful(turns):
    """Thoughts of earlier answers are taken out once a user speaks again: history is rewritten."""
    last = max((i for i, (r, _) in enumerate(turns) if r == "user"), default=-1)
    return "".join(f"({r}){t.split('</think>')[-1] if r == 'assistant' and i < last else t};" for i, (r, t) in enumerate(turns))


def trimmed(turns):
    return "".join(f"{r}: {t.strip()}\n" for r, t in turns)


@given(st.lists(st.tuples(odd_texts, odd_texts), max_size=5))
@settings(max_examples=200, deadline=None)
def test_own_template_is_read_back(turns):
    said = marked(turns)
    assert read_marked(said) == turns
    for _, text in turns:
        assert unescape(escape(text)) == text
        assert not any(control in escape(text) for control in CONTROLS)
    state, joined = Conversation(OWN), ""
    for role, text in turns:
        got = state.add((role, text))
        assert got.at == len(joined) and got.changed == -1
        assert unescape(got.added[got.first:got.last]) == text
        joined += got.added
    assert joined == said


@pytest.mark.parametrize("render, memory", [(ended, None), (ended, 0), (ended, 2), (folded, None), (folded, 0), (marked, None), (marked, 3)])
def test_spans_lie_in_the_whole_rendering(render, memory):
    turns = [("system", "be brief"), *[(("user", "assistant")[i % 2], f"text {i} [user]" * (i % 4)) for i in range(12)]]
    for said in (turns, turns[1:], turns[:1], turns[1:2]):
        state = Conversation(Template(render, memory, *((escape, unescape) if render is marked else ())))
        whole = ""
        for turn in said:
            got = state.add(turn)
            assert got.changed == -1
            whole = whole[:got.at] + got.added + whole[got.at:]
            assert got.added[got.first:got.last] == turn[1]
        assert whole == render(said)


def test_rewritten_history_is_found():
    turns = [("user", "a"), ("assistant", "<think>b</think>c"), ("user", "d"), ("assistant", "e"), ("user", "f")]
    for memory in (None, 0, 1):  # a memory too short is found out by the first turns
        state = Conversation(Template(forgetful, memory))
        got = [state.add(t) for t in turns]
        assert [g.changed >= 0 for g in got] == [False, False, True, False, False]
        assert got[2].changed == len("(user)a;(assistant)") and got[2].added == ""
        assert state.length == len(forgetful(turns))


def test_turns_go_by_prefixes_from_the_beginning():
    """A template that says it remembers one turn and looks at more from the tenth on."""
    def counted(turns):
        return "".join(f"[{r}]{t}\n" if i < 9 else f"[{r} {i}]{t}\n" for i, (r, t) in enumerate(turns))

    seen, turns = [], [(("user", "assistant")[i % 2], f"t{i}") for i in range(30)]
    for render in (counted, marked):
        state, whole = Conversation(Template(lambda said, render=render: seen.append(said) or render(said), 1)), ""
        for n, turn in enumerate(turns, 1):
            whole += state.add(turn).added
            assert whole == render(turns[:n])
            assert turns[:n] in seen


def test_late_turns_go_by_prefixes_from_the_beginning_too():
    """A template that says it remembers one turn; from the 151st on it tells how many there were before."""
    def late(turns):
        return "".join(f"[{r}]{t}\n" if i < 150 else f"[{r} {i}]{t}\n" for i, (r, t) in enumerate(turns))

    turns = [(("user", "assistant")[i % 2], f"t{i}") for i in range(200)]
    for render, memory in ((late, 1), (marked, OWN.memory)):
        seen = []
        state, whole = Conversation(Template(lambda said: seen.append(len(said)) or render(said), memory)), ""  # noqa: B023
        for n, turn in enumerate(turns, 1):
            got = state.add(turn)
            whole += got.added
            assert whole == render(turns[:n]) and got.added[got.first:got.last] == turn[1]
        assert set(range(1, 201)) <= set(seen)


def test_altered_texts_have_no_place():
    state = Conversation(Template(trimmed))
    first, second, third = (state.add(t) for t in (("user", " a "), ("assistant", "b"), ("user", "")))
    assert (first.first, second.added[second.first:second.last], third.first) == (-1, "b", third.last)


ROWS = [
    (1, 1, "assistant", "b</s>"), (1, 0, "user", "a\\"), (1, 2, "tool", None), (2, 0, None, "x"), (2, None, "assistant", "y"),
    (3, 0, "assistant", "same"), (3, 0, "assistant", "same"), (3, 0, "user", ""), (None, 0, "user", "lost"), (None, 1, "assistant", "<|end|>\n"),
    (4, 0, "user\n<|turn|>\\", "é" * 50000),
]


def plain(rows):
    out = {}
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for conv in {r[0] for r in rows}:
        turns = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == conv), key=key)]
        loss = "".join(t for r, t in turns if r == "assistant")
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        out[conv] = (conv, len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss), len(marked(turns)))
    return out


@pytest.mark.parametrize("parts", [1, 7])
def test_digest_of_nulls_ties_repeats_and_long_texts(spark, parts):
    got = {r.conv_id: tuple(r) for r in formatted_digest(table(spark, ROWS).repartition(parts)).collect()}
    assert got == plain(ROWS)


def test_very_long_conversation_is_streamed(spark):
    rows = [(7, i, ("user", "assistant")[i % 2], f"[INST]{i}") for i in range(20000)] + [(8, 0, "user", "z")]
    got = {r.conv_id: tuple(r) for r in formatted_digest(table(spark, rows)).collect()}
    assert got == plain(rows)


def test_formatted_rows_join_to_the_rendering(spark):
    rows = [(i % 3, i, ("user", "assistant")[i // 3 % 2], f"t{i}<s>") for i in range(30)]
    numbered = Template(lambda turns: "".join(f"{i}[{r}]{t}\n" for i, (r, t) in enumerate(turns)))  # sent to tasks by value
    for template in (OWN, numbered):
        got = formatted_turns(table(spark, rows), template).orderBy("conv_id", "turn_no").collect()
        for conv in range(3):
            said = [(r[2], r[3]) for r in rows if r[0] == conv]
            assert "".join(r.added for r in got if r.conv_id == conv) == template.render(said)


def test_no_rows(spark):
    assert formatted_digest(table(spark, [])).collect() == []
