"""Names alike by tokens, against all pairs."""

import random

import pytest

from waymill.operators import joins


def edits(s: str, t: str) -> int:
    row = list(range(len(t) + 1))
    for i, x in enumerate(s, 1):
        row, last = [i], row
        for j, y in enumerate(t, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def brute(names: list[str | None], threshold: float) -> set:
    tokens = [None if n is None else list(dict.fromkeys(n.lower().strip(" ").split())) or [""] for n in names]
    out = set()
    for a in range(len(names)):
        for b in range(a + 1, len(names)):
            if tokens[a] is not None and tokens[b] is not None:
                u, v = sorted((tokens[a], tokens[b]), key=len)
                score = round(sum(max(100 * (1 - edits(s, t) / max(len(s), len(t), 1)) for t in v) for s in u) / len(u), 6)
                out |= {(a, b, score)} if score > threshold else set()
    return out


@pytest.mark.parametrize("threshold", [95.0, 80.0, 50.0, 0.0])
def test_names_equal_all_pairs(spark, threshold):
    rng = random.Random(4)
    names = ["Philippe", "Pilippe", "Jean Philippe", "hPilippe", None, "", "é", "Ée", "Jean philippe", "a", "b"]
    for _ in range(15):
        base = ["".join(rng.choices("abcde", k=rng.randint(1, 12))) for _ in range(rng.randint(1, 3))]
        names.append(" ".join(base))
        for _ in range(2):
            letters = list(" ".join(base))
            letters[rng.randrange(min(2, len(letters)))] = rng.choice("xyz")
            names.append("".join(letters))
    df = spark.createDataFrame(list(enumerate(names)), "id long, name string")
    found = [tuple(r) for r in joins.similar_names(df, "id", "name", threshold).collect()]
    assert len(found) == len(set(found)) and set(found) == brute(names, threshold)
    assert threshold > 80 or (0, 1) in {f[:2] for f in found}
