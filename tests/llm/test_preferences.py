from __future__ import annotations

import pytest
from conftest import rows

from statewise.llm.preferences import preference_pairs, with_other_answers

SCHEMA = "conv_id long, turn long, role string, text string, at string, prompt string"


@pytest.fixture
def talk(spark):
    def make(data):
        return spark.createDataFrame([(*row, "x", "y") for row in data], SCHEMA)

    return make


def shown(role, text):
    return f"<|im_start|>{role}\n{text}<|im_end|>\n"


CHOSEN = [
    (1, 0, "system", "be kind"), (1, 1, "user", "hi"), (1, 2, "assistant", "hello"), (1, 3, "user", "more"), (1, 4, "assistant", "yes"),
    (2, 0, "user", "same"), (2, 1, "assistant", "same"),
    (3, 0, "user", "a"), (3, 1, "assistant", "b"),
    (4, 0, None, None), (4, 1, "assistant", ""),
    (5, 0, "user", "only here"), (None, 0, "user", "no id"),
]
REJECTED = [
    (1, 0, "system", "be kind"), (1, 1, "user", "hi"), (1, 2, "assistant", "no"),
    (2, 0, "user", "same"), (2, 0, "user", "same"), (2, 1, "assistant", "same"),
    (3, 0, "user", "a"),
    (4, 0, "", ""), (4, 1, "assistant", "x"),
    (6, 0, "user", "only there"),
]


def test_prefix_completions_and_masks(talk):
    found = {r.conv_id: r for r in preference_pairs(talk(CHOSEN), talk(REJECTED)).collect()}
    assert set(found) == {1, 2, 3, 4}
    one = found[1]
    assert one.n_prompt_turns == 2 and one.prompt == shown("system", "be kind") + shown("user", "hi")
    assert one.chosen == shown("assistant", "hello") + shown("user", "more") + shown("assistant", "yes")
    assert one.rejected == shown("assistant", "no")
    assert [one.chosen[s["from"] : s.below] for s in one.chosen_mask] == ["hello<|im_end|>\n", "yes<|im_end|>\n"]
    assert [one.rejected[s["from"] : s.below] for s in one.rejected_mask] == ["no<|im_end|>\n"]
    assert found[2].chosen == found[2].rejected == "" and found[2].n_prompt_turns == 2
    assert found[3].rejected == "" and found[3].rejected_mask == []
    assert found[3].chosen == shown("assistant", "b")
    assert found[4].n_prompt_turns == 1 and found[4].chosen == shown("assistant", "")


def test_a_turn_is_not_common_after_a_difference(talk):
    a = talk([(1, 0, "user", "x"), (1, 1, "assistant", "a"), (1, 2, "user", "same")])
    b = talk([(1, 0, "user", "x"), (1, 1, "assistant", "b"), (1, 2, "user", "same")])
    [pair] = preference_pairs(a, b).collect()
    assert pair.n_prompt_turns == 1 and pair.chosen.endswith(shown("user", "same"))


def test_twins(talk):
    data = [(2, 0, "user", "q"), (2, 1, "assistant", "two"), (3, 0, "user", "r"), (3, 1, "assistant", "three"), (4, 0, "user", "s"), (4, 1, "assistant", "four"), (5, 0, "user", "t")]
    twins = with_other_answers(talk(data))
    assert rows(twins.where("role = 'assistant'").select("conv_id", "text")) == [(2, "three"), (3, "two"), (4, "")]


def test_empty(talk):
    assert preference_pairs(talk([]), talk([])).count() == 0
    assert preference_pairs(talk(CHOSEN), talk([])).count() == 0
