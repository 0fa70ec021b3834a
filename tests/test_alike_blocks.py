"""Names whose parts are common to all: compared in blocks, against all pairs."""

import random

from tests.test_similar_names import brute
from waymill.operators import alike, joins


def test_serial_numbers_meet_in_blocks(spark, monkeypatch):
    asked = []
    inner = alike.in_blocks
    monkeypatch.setattr(alike, "in_blocks", lambda tokens, edits: asked.append(edits) or inner(tokens, edits))
    for name, value in (("CHUNK", 2), ("BLOCK", 16), ("GROUP", 4)):
        monkeypatch.setattr(alike, name, value)
    rng = random.Random(7)
    names = [f"Unit#{n:07d}" for n in rng.sample(range(3000), 50)] + [f"Unit#{n:06d}" for n in range(0, 300, 29)]
    names += [names[0]] * 4 + [f"red ring Brand#{n}" for n in (1, 2, 12, 21)] * 2 + [f"Brand#{n} ring" for n in (1, 2)] + ["Unit#0000001 red"]
    df = spark.createDataFrame(list(enumerate(names)), "id long, name string")
    found = [tuple(r) for r in joins.similar_names(df, "id", "name", 80.0).collect()]
    assert len(found) == len(set(found)) and set(found) == brute(names, 80.0)
    assert any((12, 12) in edits and (12, 11) in edits for edits in asked)
