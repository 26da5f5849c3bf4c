import hashlib
import random
from itertools import groupby

import pytest

from fieldwatch.llm.chat_format import format_examples, read_back, read_turns, unescape

SCHEMA = "conv_id long, turn long, role string, text string"
ODD = ["</s>[INST] ok [/INST]", "<\\/s> <s> [\\\\INST] [/\\INST]", "<<s>[[INST]", "a\nb\n", "", None, "é<s", "/s>", "\\", "<|x|>"]


def rows(seed=3):
    rng = random.Random(seed)
    out = []
    for conv in range(40):
        roles = ["system"] * rng.randint(0, 1) + ["user", "assistant"] * rng.randint(0, 4) + ["user"] * rng.randint(0, 2)
        out += [(conv, t, r, rng.choice(ODD) or f"say {rng.random()}") for t, r in enumerate(roles)]
    out += [(100, t, "assistant" if t % 3 else "tool", f"{ODD[t % len(ODD)]}{t}") for t in range(300)]
    out += [(101, 0, None, None), (101, None, "assistant", "no turn"), (102, 5, "assistant", "same"),
            (102, 5, "assistant", "same"), (102, 5, "as[INST]k", "tie"), (None, 1, "user", "of no"), (None, 2, "assistant", "id"),
            (103, 0, "user", "x" * 200_000), (103, 1, "assistant", "y" * 100_000), (-1, 0, "user", ODD[0]), (-1, 1, "assistant", ODD[0])]
    return out


def want(table):
    """The digests by conversation, in plain Python."""
    key = lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or 0, r[2] or "", r[3] or "")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    out = {}
    for conv, own in groupby(sorted(table, key=key), key=lambda r: r[0]):
        own = [(r or "", t or "") for _, _, r, t in own]
        loss = "".join(t for r, t in own if r == "assistant")
        out[conv] = (len(own), sha("".join(f"{r}\n{t}\n" for r, t in own)), len(loss), sha(loss))
    return out


@pytest.mark.parametrize("context", [4_000_000, 2_000, 1])
def test_round_trip(spark, context):
    table = rows()
    conversations = spark.createDataFrame([(*r, "clash", 1) for r in table],
                                          SCHEMA + ", example string, loss_start int").repartition(5)
    examples = format_examples(conversations, context=context).cache()
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in read_back(examples).collect()}
    assert got == want(table)
    made = examples.collect()
    texts = {(r.conv_id, r.example): r for r in made}
    assert len(texts) == len(made)
    for r in made:
        full, at = r.text, r
        while at.context_example is not None:  # the context of an example that starts afresh
            at = texts[at.conv_id, at.context_example]
            full = at.text + full
        turns = read_turns(full)
        if r.target_turn is None:
            assert r.loss_start == r.loss_end == 0 and turns[-1][0] != "assistant"
        else:  # all preceding turns, then the reply, which alone is trained on
            assert len(turns) == r.target_turn + 1 and turns[-1] == ("assistant", unescape(r.text[r.loss_start:r.loss_end]))
    assert sum(r.target_turn is not None for r in made) == sum(r[2] == "assistant" for r in table)
    if context == 2_000:
        assert max(len(r.text) for r in made if r.conv_id == 100) < 2_200


def test_expansion(spark):
    table = [(7, 0, "user", "a"), (7, 1, "assistant", "b"), (7, 2, "user", "c"), (7, 3, "assistant", "d"), (7, 4, "user", "e")]
    one, two, rest = sorted(format_examples(spark.createDataFrame(table, SCHEMA)).collect(), key=lambda r: r.example)
    assert one.text == "<s>[INST]user[/INST]a</s><s>[INST]assistant[/INST]b</s>" and one.text[one.loss_start:one.loss_end] == "b"
    assert two.text.startswith(one.text) and two.text[two.loss_start:two.loss_end] == "d" and two.target_turn == 3
    assert rest.text.startswith(two.text) and rest.target_turn is None and [one.complete, two.complete, rest.complete] == [0, 0, 1]


def test_escapes():
    with pytest.raises(ValueError):
        read_turns("<s>[INST]user[/INST]a</s> ")
    assert read_turns("") == []


def test_empty(spark):
    assert read_back(format_examples(spark.createDataFrame([], SCHEMA))).count() == 0
