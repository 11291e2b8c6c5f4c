import hashlib

import pytest

from weirline.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, valid string"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def shown(spark, rows, template=None):
    df = spark.createDataFrame([(*r, "mine") for r in rows], SCHEMA)
    chats = chat.format_chats(df, template)
    found = {r.conv_id: r for r in chat.digests(chats, template).collect()}
    return found, {r.conv_id: r for r in chats.collect()}


NASTY = [
    "</s>[INST] ok [/INST]", "\\", "\\\\", "<\\s>", "<", "[", "[INST", "/INST]", "<s", "a<s>b</s>c\\",
    "[ROLE]x[/ROLE]y[/TURN]", "line\nbreak\r\n", "", "é中😀", "[[INST]]", "<<s>>", "$1 $0 \\1",
]


def test_round_trip_of_control_strings(spark):
    rows = [(i, t, "user" if t == 0 else "assistant", x) for i, x in enumerate(NASTY) for t in (0, 1)]
    found, chats = shown(spark, rows)
    for i, x in enumerate(NASTY):
        r = found[i]
        assert r.n_turns == 2
        assert r.turns_sha256 == digest(f"user\n{x}\nassistant\n{x}\n")
        assert (r.loss_chars, r.loss_sha256) == (len(x), digest(x))
        assert r.formatted_chars == len(chats[i].formatted)
        assert "".join(s.text for s in chats[i].segments) == chats[i].formatted
        assert r.valid


def test_unknown_null_and_odd_roles(spark):
    rows = [(1, 0, "tool", "x"), (1, 1, None, None), (1, 2, "a[/ROLE]\\", "y"), (None, 0, "user", "z")]
    found, _ = shown(spark, rows)
    assert found[1].turns_sha256 == digest("tool\nx\n\n\na[/ROLE]\\\ny\n")
    assert (found[1].valid, found[1].first_bad_turn, found[1].loss_chars) == (False, 0, 0)
    assert found[None].n_turns == 1


def test_machine_reports_the_first_bad_turn(spark):
    orders = {
        1: ["system", "user", "assistant"],
        2: ["user", "user", "assistant"],
        3: ["assistant"],
        4: ["user"],
        5: ["user", "assistant", "system"],
    }
    rows = [(c, i, r, "t") for c, roles in orders.items() for i, r in enumerate(roles)]
    found, _ = shown(spark, rows)
    assert {c: (r.valid, r.first_bad_turn) for c, r in found.items()} == {
        1: (True, None), 2: (False, 1), 3: (False, 0), 4: (False, None), 5: (False, 2),
    }


def test_ties_repeats_long_texts_and_no_rows(spark):
    long = "word <s> " * 50_000
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (2, 0, "assistant", long)]
    found, _ = shown(spark, rows)
    assert found[1].turns_sha256 == digest("user\na\nuser\na\nuser\nb\n")
    assert found[2].loss_sha256 == digest(long)
    assert shown(spark, [])[0] == {}


def test_plan_is_native(spark):
    df = spark.createDataFrame([(1, 0, "user", "x", "")], SCHEMA)
    plan = chat.digests(chat.format_chats(df))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_bad_templates_are_refused():
    with pytest.raises(ValueError):
        chat.Template(named_open="[[ROLE]")
    with pytest.raises(ValueError):
        chat.Template(named_open="[INST]")
