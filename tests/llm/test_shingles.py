"""Near copies by shingle similarity, against all pairs."""

import random
from collections import Counter
from fractions import Fraction

import pytest

import corpus_pipeline
from waymill.llm import shingles, simhash

SCHEMA = "doc_id long, text string, source string"


def brute_set(text: str | None) -> set:
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_components(texts: list[str | None]) -> tuple[list[int], list[Fraction]]:
    """The least index of each text's component, and the similarities of the pairs of different sets that link."""
    sets, label, met = [brute_set(t) for t in texts], list(range(len(texts))), []
    for i in range(len(sets)):
        for j in range(i):
            size = len(sets[i] | sets[j])
            alike = Fraction(len(sets[i] & sets[j]), size) if size else Fraction(1)
            if alike >= Fraction(4, 5):
                met += [alike] * (alike < 1)
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    return label, met


def planted(seed: int = 3) -> list[str]:
    """Texts with copies of which some words are other ones: about 0.7 to 0.95 alike, in groups, and one of exactly 0.8."""
    rng = random.Random(seed)
    common = [f"w{k}" for k in range(300)]
    notice = " ".join(rng.choices(common, k=60))
    out = []
    for _ in range(12):
        base = rng.choices(common, k=rng.randint(25, 400))
        out.append(" ".join(base) + (" " + notice if rng.random() < 0.5 else ""))
        for _ in range(rng.choice([1, 3, 8])):
            words = list(out[-1].split())
            for at in rng.sample(range(len(words)), max(1, round(len(words) * rng.uniform(0.005, 0.05)))):
                words[at] = rng.choice(common).upper()
            out.append(" ".join(words))
    row = [f"e{k}" for k in range(40)]  # 36 and 36 shingles, 32 of them in both: 32 of 40
    return [*out, " ".join(row), " ".join([*row[:36], "x", "x1", "x2", "x3"]), "One two", "one TWO", "one", "", " ", None]


@pytest.mark.parametrize("share", [1 << 24, 3000])
def test_links_equal_all_pairs(spark, monkeypatch, share):
    monkeypatch.setattr(shingles, "PIECE", 5000)
    texts = planted()
    want, met = brute_components(texts)
    assert min(met) == Fraction(4, 5) and sum(x < Fraction(19, 20) for x in met) > 20
    df = spark.createDataFrame([(k, t, "s") for k, t in enumerate(texts)], SCHEMA).repartition(3)
    found = {r.id: r.component_id for r in shingles.marked(df, share=share).collect()}
    assert [found[k] for k in range(len(texts))] == want
    assert sorted(r.doc_id for r in shingles.keep_first(df, share=share).collect()) == sorted(set(want))


def test_stage_drops_copies_that_fingerprints_miss(spark):
    texts = planted(5)
    df = spark.createDataFrame([(k, t, "s") for k, t in enumerate(texts)], SCHEMA)
    want = set(brute_components(texts)[0])
    assert {r.doc_id for r in corpus_pipeline.near_duplicates(spark, df, "").collect()} == want
    assert len(want) < simhash.keep_first(df).count()


def test_given_documents_equal_all_pairs(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = sorted(docs.select("doc_id", "text").collect())
    want = {rows[k].doc_id for k in brute_components([r.text for r in rows])[0]}
    kept = shingles.keep_first(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == want


def test_odd_rows(spark):
    rows = [(None, None, None), (None, "", "s"), (7, "", None), (7, "", None), (8, "one two", "s"), (9, "One TWO", "t"), (10, "x" * 5000, "t"), (None, "a b c d e f", "t"), (None, "a b c d e f", "t")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert Counter(r.doc_id for r in shingles.keep_first(df).collect()) == Counter([7, 8, 10, None])
    assert shingles.keep_first(df.limit(0)).count() == 0
