"""Chats built in groups: what is read back, whatever the groups are."""

import random

import pytest
from pyspark.sql import functions as F

from skyledger.llm import chat
from skyledger.llm.queries import vocabulary_path

VOCABULARY = "byte_bpe_50k.json"


@pytest.mark.parametrize("group", [1, 400, 1 << 20])
def test_read_back_is_what_was_said(spark, monkeypatch, group):
    monkeypatch.setattr(chat, "GROUP", group)
    say = random.Random(2)
    bits = ["<|end|>", "</s>[INST] ok [/INST]", "<\\|text|>", "é\u4e2d\U0001f600", "plain words", "", "\n", "a" * 300, "<<SYS>> x <</SYS>>"]
    said = {c: [(say.choice(["user", "assistant", "assistant", "<|turn|>"]), " ".join(say.choices(bits, k=say.randrange(4))))
                for _ in range(say.randrange(1, 6))] for c in range(60)}
    said[60] = [("assistant", "long <|end|> é " * 40_000)]
    rows = [(c, i, r, t, "x") for c, turns in said.items() for i, (r, t) in enumerate(turns)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, ids string")
    formatted = chat.format_chats(frame, vocabulary_path(VOCABULARY))
    assert formatted.where(F.expr("size(ids) != size(loss) OR size(ids) != size(starts) OR size(ids) != size(stops)")).count() == 0
    back = {r["conv_id"]: r for r in chat.read_back(formatted).collect()}
    assert set(back) == set(said)
    for c, turns in said.items():
        assert [(t["role"], t["text"]) for t in back[c]["turns"]] == turns
        assert back[c]["learned"] == "".join(t for r, t in turns if r == "assistant")


def test_empty_table(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.read_back(chat.format_chats(none, vocabulary_path(VOCABULARY))).count() == 0
