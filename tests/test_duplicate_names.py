"""Partial ratios and the join by them, against all pairs by plain recursion."""

import random
import re

import pytest

from waymill.operators import names


def common(a: str, b: str) -> int:
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b):
            before, row[j + 1] = row[j + 1], (before + 1 if x == y else max(row[j], row[j + 1]))
    return row[-1]


def plain_ratio(a: str, b: str) -> float:
    def one(s: str, t: str) -> float:
        return max(200 * common(s, w) / (len(s) + len(w)) for i in range(1 - len(s), len(t)) for w in [t[max(i, 0) : i + len(s)]])

    if not a or not b:
        return 0.0
    return max(one(a, b), one(b, a)) if len(a) == len(b) else one(a, b) if len(a) < len(b) else one(b, a)


def text(rng: random.Random, most: int, letters: str = "abcé ") -> str:
    return "".join(rng.choice(letters) for _ in range(rng.randrange(most)))


def test_ratios_equal_all_windows():
    rng = random.Random(2)
    a, b = [text(rng, 12) for _ in range(400)] + ["x" * 70, "ab", ""], [text(rng, 20) for _ in range(400)] + ["xy" * 60, "ba", "a"]
    assert names.partial_ratios(a, b).tolist() == pytest.approx([plain_ratio(x, y) for x, y in zip(a, b)], abs=1e-9)


@pytest.mark.parametrize("cutoff", [80.0, 66.0, 91.0])
def test_a_part_is_unchanged_in_every_window_over_the_cutoff(cutoff):
    rng, met = random.Random(5), 0
    for _ in range(6000):
        a = text(rng, 11, "abcd") or "a"
        b = list(text(rng, 4, "abcd") + a + text(rng, 4, "abcd"))
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(b))
            b[at : at + 1] = rng.choice([[], [rng.choice("abcd")], [b[at], "x"]]) or ["y"]
        if len(a) <= len(b) and plain_ratio(a, "".join(b)) > cutoff:
            met += 1
            assert any(p in "".join(b) for p in names.parts_of(a, cutoff))
    assert met > 500


def folded(name: str) -> str:
    return " ".join(sorted(re.sub(r"\W", " ", name.lower()).split()))


def plain_duplicates(rows: list[tuple], cutoff: float) -> dict[tuple, float]:
    out: dict[tuple, float] = {}
    for name, _ in rows:
        for other, alternative in rows:
            if name is None or other is None or alternative is None or name == other or not folded(alternative):
                continue
            scores = [s for t in name.split(" ") if folded(t) and (s := plain_ratio(folded(t), folded(alternative))) > 0]
            if scores and sum(scores) / len(scores) > cutoff:
                out[name, other] = max(out.get((name, other), 0), sum(scores) / len(scores))
    return out


ODD = [(None, "Jean Dupont"), ("No Alternative", None), ("", "x"), ("  ", "  "), ("Jean-Luc  Picard", "PICARD, Jean Luc"), ("Jean-Luc  Picard", "picard j.l."), ("X", "Q z"), ("zz X", "x"), ("Al", "Alexandra de la Very Long Name Indeed"), ("A" * 90, "a" * 85), ("-", "-")]


def test_duplicates_equal_all_pairs(spark):
    rng = random.Random(8)
    firsts, lasts = ["Jean", "Jeanne", "Marie", "Marc", "José", "Li"], ["Dupont", "Dupond", "Durand", "Martin", "Martinez", "Le Goff"]
    rows = list(ODD)
    for _ in range(60):
        a, b = rng.choice(firsts), rng.choice(lasts)
        rows.append((f"{a} {b}", rng.choice([f"{b} {a}", f"{b.upper()}, {a[:3]}", f"{a}{b}", b])))
    rows += rows[-5:]
    df = spark.createDataFrame([(*r, 1) for r in rows], "key string, alt string, name int").select("key", "alt", "name")
    got = {(r.name, r.other): r.score for r in names.duplicate_names(df, "key", "alt").collect()}
    want = plain_duplicates(rows, 80.0)
    assert set(got) == set(want) and len(want) > 50
    assert [got[k] for k in want] == pytest.approx(list(want.values()))
    report = {r.name: r for r in names.duplicate_report(df, "key", "alt").collect()}
    assert set(report) == {k for k, _ in rows if k is not None}
    for name, r in report.items():
        own = sorted(k for k in want if k[0] == name)
        assert r.matched_names == ", ".join(o for _, o in own)
        assert [float(x) for x in r.scores.split(", ") if x] == pytest.approx([want[k] for k in own], abs=0.051)
    assert names.duplicate_names(df.limit(0), "key", "alt").count() == 0
