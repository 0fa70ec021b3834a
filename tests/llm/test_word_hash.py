"""Word hashes without built-in collisions, and rows of equal ids judged each by its own text."""

import random
import zlib

import pytest

from waymill.llm import lm, shingles, simhash, substrings
from waymill.llm.wordhash import LONG, words_of


def thue_morse(letters: int) -> tuple[str, str]:
    word, swap = "a", str.maketrans("ab", "ba")
    while len(word) < letters:
        word += word.translate(swap)
    return word, word.translate(swap)


@pytest.mark.parametrize("letters", [8, 64, 256, 512, 1024, 2048, 1 << 15])
def test_a_word_and_its_complement_differ(letters):
    one, other = thue_morse(letters)
    found, counts = words_of([f"{one} {other}", f"x\t{one}\n", None])
    assert counts.tolist() == [2, 2, 0] and len(set(found.tolist())) == 3 and found[0] == found[3]


def test_hashes_depend_on_words_alone():
    rng = random.Random(1)
    words = list({"".join(rng.choice("abé𐍈") for _ in range(rng.choice([1, 5, 8, 9, 17, LONG, LONG + 1]))) for _ in range(3000)})
    found, _ = words_of([" ".join(words)])
    again, _ = words_of(["\n".join(reversed(words)) + "  "])
    assert len(set(found.tolist())) == len(words) and (again[::-1] == found).all()


@pytest.mark.parametrize("letters", [1024, 2048])
def test_operators_tell_such_words_apart(spark, letters):
    one, other = thue_morse(letters)
    frame = " ".join(f"w{k}" for k in range(6))
    rows = [(1, f"{frame} {other} {frame}"), (2, f"{frame} {one} {frame}"), (3, f"{frame} {one} {frame}")]
    got = {r.doc_id: r.n_removed for r in substrings.removal_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 0, 2: 0, 3: 13}
    held, trained = ([k for k in range(20) if (zlib.crc32(str(k).encode()) % 5 == 1) == x] for x in (True, False))
    docs = [(k, f"a {one}") for k in trained] + [(held[0], f"a {other}")]
    score = {r.doc_id: r for r in lm.score_report(spark.createDataFrame(docs, "doc_id long, text string")).collect()}[held[0]]
    assert score.held_out and score.n_known == 2 and score.n_tokens == 3
    twins = [(k, " ".join(f"{w}{j}" for j in range(20))) for k, w in ((1, one), (2, other))]
    assert {r.doc_id for r in shingles.keep_first(spark.createDataFrame(twins, "doc_id long, text string")).collect()} == {1, 2}


def plain_first(rows: list[tuple], root: dict[str, int]) -> list[tuple]:
    """Of each root the row of least (id, text's root number)."""
    best: dict[int, tuple] = {}
    for r in rows:
        key = (r[0] is None, r[0] or 0)
        if root[r[1]] not in best or key < best[root[r[1]]][0]:
            best[root[r[1]]] = (key, r)
    return sorted((r for _, r in best.values()), key=str)


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("operator", [shingles, simhash])
def test_first_rows_of_equal_and_null_ids(spark, operator, seed):
    rng = random.Random(seed)
    base = [" ".join(rng.choice("abcdefghijklmnopqrstuvwxyz") * 3 + str(rng.randrange(999)) for _ in range(60)) for _ in range(4)]
    texts = {t: k for k, t in enumerate(base)}
    rows = [(3, base[0]), (5, base[0]), (5, base[1]), (5, base[1]), (None, base[2]), (None, base[2]), (None, base[1]), (7, base[3]), (8, base[3]), (None, base[3])]
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, fp string").repartition(4)
    got = sorted(((r.doc_id, r.text) for r in operator.keep_first(df).collect()), key=str)
    assert got == plain_first(rows, texts)
