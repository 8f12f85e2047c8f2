"""Steps that the encoder and the component search no longer take, with the same results."""

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tessera.llm import components, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_units_are_encoded_from_their_bytes():
    units = [" a", "b", " é", " x\n y", "  z", " 中文", "\n", " <|endoftext|>", " word" * 3, " end."]
    ids, length, order = token_counts.Encoder(PATH)._encode_units([u.encode() for u in units])
    cut = np.split(ids, np.cumsum(length)[:-1])
    tok = Tokenizer.from_file(PATH)
    assert sorted(order.tolist()) == list(range(len(units)))
    assert [x.tolist() for x in cut] == [tok.encode(units[i], add_special_tokens=False).ids for i in order]


def rounds(spark, monkeypatch, pairs, parts):
    """The components of the pairs, and how often edges were written."""
    steps = []
    plain = components.written
    monkeypatch.setattr(components, "written", lambda df, name: steps.append(name) or plain(df, name))
    found = components.components(spark.createDataFrame(pairs, "a long, b long").repartition(parts)).collect()
    assert len(found) == len({r.node for r in found})
    return {r.node: r["class"] for r in found}, len(steps)


def test_stars_take_no_round(spark, monkeypatch):
    found, steps = rounds(spark, monkeypatch, [(1, x) for x in range(2, 60)] + [(100, 101)], 1)
    assert found == {1: 1, 100: 100, 101: 100} | {x: 1 for x in range(2, 60)}
    assert steps == 1  # was three: a round of joins, and another to see that nothing changed


def test_paths_and_two_centres_are_joined(spark, monkeypatch):
    path = [(x, x + 1) for x in range(200, 300)]
    found, _ = rounds(spark, monkeypatch, path + [(1, 9), (2, 9), (2, 8), (5, 6), (-3, 7)], 8)
    assert found == {x: 200 for x in range(200, 301)} | {1: 1, 2: 1, 8: 1, 9: 1, 5: 5, 6: 5, -3: -3, 7: -3}
    found, steps = rounds(spark, monkeypatch, [(4, 4)], 2)
    assert (found, steps) == ({}, 1)
