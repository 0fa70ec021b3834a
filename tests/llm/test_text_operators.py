"""Operators that work text by text, against the libraries, brute force and exact round trips."""

import base64
import hashlib
import math
import random
import struct
import time
import unicodedata
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from waymill.llm import byte_bpe, png_media, quality, word_tokens
from waymill.llm.byte_bpe import Encoder

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
LETTERS = ["a", "b", " ", "\n", "é", "É", "1", "'s", "'S", "the", "!", "\u3000", "\t", "\x1c", "\x85", "日本", "😀", "ing", "=", "-", "Σ", "İ", "ß", "½", "<|endoftext|>"]
ODD = [None, "", " ", "\n\n", "a", "a" * 3000, "ab " * 5000, "<|endoftext|>", "\x00", "x\r\ny"]


def texts(n: int, seed: int = 1) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choices(LETTERS[: rng.randint(1, len(LETTERS))], k=rng.randint(0, 90))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_tree_encoding_equals_the_library_and_decodes(library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "TEXT_BLOCK", 16)
    monkeypatch.setattr(byte_bpe, "PIECE_BLOCK", 4)
    encoder = Encoder(RANKS)
    for text in texts(3000) + [t for t in ODD if t]:
        ids = encoder.encode(text)
        assert ids == library.encode_ordinary(text), text
        assert encoder.decode(np.array(ids)) == text.encode()


def test_long_runs_need_wide_windows(library):
    encoder = Encoder(RANKS)
    for text in ("a" * 5001, "ab" * 3000, "".join(random.Random(3).choices("abcdef", k=9000))):
        assert encoder.encode(text) == library.encode_ordinary(text)


def test_encoding_digest_on_odd_rows(spark, library):
    df = spark.createDataFrame([(k if k else None, t, "clash") for k, t in enumerate(ODD)], "doc_id long, text string, token_ids string")
    rows = byte_bpe.encoding_digest(df).collect()
    assert len(rows) == len(ODD)
    want = Counter()
    for k, t in enumerate(ODD):
        ids = library.encode_ordinary(t or "")
        want[k or None, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()] += 1
    assert Counter(map(tuple, rows)) == want
    assert byte_bpe.encoding_digest(df.limit(0)).count() == 0


def test_token_counts_equal_the_library(spark):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    counter = word_tokens.counter(public_tokenizers.path("word_bpe_49k.json"))
    for text in texts(3000, 2) + [t for t in ODD if t]:
        assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids), text
    df = spark.createDataFrame([(k, t) for k, t in enumerate(ODD)] + [(1, "")], "doc_id long, text string")
    rows = word_tokens.token_counts(df, limit=2048).collect()
    assert len(rows) == len(ODD) + 1
    for r in rows:
        n = len(library.encode(ODD[r.doc_id] or "", add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((ODD[r.doc_id] or "").encode()), n, n > 2048)


def test_long_pre_tokens_take_time_in_proportion():
    counter = word_tokens.counter(public_tokenizers.path("word_bpe_49k.json"))
    rng = random.Random(6)
    for n in (49, 200, 3000):
        word = "".join(rng.choices("abcdefgh", k=n))
        short = word_tokens.Counter.merge
        long, word_tokens.LONG = word_tokens.LONG, 10**9
        want = short(counter, word)
        word_tokens.LONG = long
        assert counter.merge(word) == want
    began = time.monotonic()
    assert counter.count("".join(rng.choices("abcdefgh", k=1_000_000))) > 100_000
    assert time.monotonic() - began < 60


def test_token_counts_of_no_rows_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a b", 7), (1, "a b", 7)], "doc_id long, text string, n_tokens int")
    assert [tuple(r) for r in word_tokens.token_counts(df).collect()] == [(1, 3, 2, False)] * 2
    assert word_tokens.token_counts(df.limit(0)).count() == 0


def test_any_bytes_are_read_or_refused(spark):
    rng = random.Random(9)
    good = png_media.encode_png(np.arange(640, dtype=np.uint32).astype(np.uint8).reshape(-1, 64))
    head = lambda data: png_media.SIGNATURE + png_media.chunk(b"IHDR", data) + png_media.chunk(b"IDAT", zlib.compress(bytes(65))) + png_media.chunk(b"IEND", b"")
    size = lambda w, h: head(struct.pack(">IIBBBBB", w, h, 8, 0, 0, 0, 0))
    odd = [head(b""), head(bytes(13)), head(bytes(14)), size(64, 0), size(0, 1), size(1 << 31, 1 << 31), size(64, 2), size(32, 1), png_media.SIGNATURE, b"", png_media.SIGNATURE + png_media.chunk(b"IEND", b""), good[:-1]]
    for _ in range(300):
        image = bytearray(good)
        for _ in range(rng.randint(1, 4)):
            image[rng.randrange(len(image))] = rng.randrange(256)
        at = rng.randrange(8, len(image))
        odd += [bytes(image), good[:at], png_media.SIGNATURE + rng.randbytes(60), png_media.SIGNATURE + png_media.chunk(b"IHDR", rng.randbytes(13)) + png_media.chunk(b"IDAT", zlib.compress(rng.randbytes(130)))+ png_media.chunk(b"IEND", b"")]
    rows = spark.createDataFrame([(x,) for x in [*odd, size(64, 1), good]], "media binary").select(png_media.from_png(F.col("media")).alias("x")).select("x.*").collect()
    assert all((r.error is None) != (r.payload is None) for r in rows)
    assert sum(r.error is None for r in rows[: len(odd)]) < 10 and all(r.error is None for r in rows[-2:])


def test_shortcut_strings_are_single_tokens():
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    single = sorted(word_tokens.counter(public_tokenizers.path("word_bpe_49k.json")).single)
    lower = [s for s in single if s == s.lower()]
    assert all(len(e.ids) == 1 for e in library.encode_batch(lower, add_special_tokens=False))


def test_png_round_trip_and_damage(spark):
    rng = np.random.default_rng(1)
    for payload in [b"", b"x", bytes(64), rng.bytes(64 * 33), b"abc" * 5000]:
        samples = np.frombuffer(png_media.padded(payload), dtype=np.uint8).reshape(-1, 64)
        image = png_media.encode_png(samples)
        assert (png_media.decode_png(image) == samples).all()
        for at in (0, 20, len(image) // 2, len(image) - 6):
            broken = bytearray(image)
            broken[at] ^= 1
            with pytest.raises(ValueError):
                png_media.decode_png(bytes(broken))
        with pytest.raises(ValueError):
            png_media.decode_png(image[:-3])


def test_png_average_and_paeth_filters():
    rng = np.random.default_rng(2)
    want = rng.integers(0, 256, (7, 9), dtype=np.uint8).astype(int)
    for kind in (3, 4):
        lines = np.zeros((7, 10), dtype=np.uint8)
        lines[:, 0] = kind
        for y in range(7):
            for x in range(9):
                a, b, c = want[y, x - 1] if x else 0, want[y - 1, x] if y else 0, want[y - 1, x - 1] if x and y else 0
                p = a + b - c
                guess = (a + b) // 2 if kind == 3 else min(((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c)))[2]
                lines[y, x + 1] = (want[y, x] - guess) % 256
        assert (png_media.unfilter(lines) == want).all()


def test_media_digest(spark):
    df = spark.createDataFrame([(k, t, b"x") for k, t in enumerate([*ODD, "a"])], "doc_id long, text string, media binary")
    rows = {r.doc_id: r for r in png_media.media_digest(df).collect()}
    for k, t in enumerate([*ODD, "a"]):
        raw = (t or "").encode()
        full = raw + bytes(-len(raw) % 64 if raw else 64)
        r = rows[k]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(full), hashlib.sha256(full).hexdigest(), zlib.crc32(full[-64:]))
    assert rows[4].media_sha256 == rows[len(ODD)].media_sha256 and len(rows[4].feature) == 16
    assert png_media.media_digest(df.limit(0)).count() == 0


def test_hash_is_stable_under_small_changes():
    rng = np.random.default_rng(3)
    y, x = np.mgrid[0:96, 0:64] / 64
    waves = sum(rng.normal() * np.cos(np.pi * (a * y + b * x)) for a in range(6) for b in range(6))
    x = np.uint8(127 + 100 * waves / np.abs(waves).max())
    other = (x + rng.integers(0, 3, x.shape)).astype(np.uint8)
    near = int(png_media.cosine_hash(x), 16) ^ int(png_media.cosine_hash(other), 16)
    far = int(png_media.cosine_hash(x), 16) ^ int(png_media.cosine_hash(x[::-1].copy()), 16)
    assert near.bit_count() < far.bit_count()


def brute_quality(text: str) -> tuple:
    raw = (text or "").encode()
    words = raw.split()
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)}
    lines = [x for x in raw.split(b"\n") if x.split()]
    return len(words), sum(len(w.decode()) for w in words), sum(raw.count(c) for c in b"#*$%&|<>"), sum(x in lines[:i] for i, x in enumerate(lines)), len(covered)


def test_quality_base_counts(spark, sf_dir):
    rng = random.Random(5)
    made = ["\n".join(" ".join(rng.choices("abc", k=rng.randint(0, 12))) for _ in range(rng.randint(0, 9))) for _ in range(300)] + ODD
    df = spark.createDataFrame([(k, t, rng.choice(["en", None, "xx"]), 1) for k, t in enumerate(made)], "doc_id long, text string, lang string, quality int")
    for r in quality.quality_report(df).collect():
        want = brute_quality(made[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (r.base_failed and r.kept)
    assert quality.quality_report(df.limit(0)).count() == 0


def kind(char: str) -> tuple:
    if char in "\t\n\v\f\r ":
        return ("break",)
    group = unicodedata.category(char)
    if group[0] != "L":
        return (group[0],)
    return ("L", "Ll" if group == "Ll" else "capital" if group in ("Lu", "Lt") else "none", sum(ord(char) >= end for end in (0x80, 0x250, 0x2E80)))


def divergence(p: Counter, q: Counter) -> float:
    """The root of the entropy of the middle beyond the mean of the entropies, in bits."""
    if not sum(p.values()) or not sum(q.values()):
        return 0.0
    shares = [{k: v / sum(x.values()) for k, v in x.items() if v} for x in (p, q)]
    middle = Counter({k: (shares[0].get(k, 0) + shares[1].get(k, 0)) / 2 for k in shares[0].keys() | shares[1].keys()})
    entropy = lambda x: -sum(v * math.log2(v) for v in x.values() if v)
    return math.sqrt(max(0.0, entropy(middle) - (entropy(shares[0]) + entropy(shares[1])) / 2))


def test_quality_verdicts_equal_an_independent_divergence(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(quality, "HELD", 500)
    rng = random.Random(8)
    russian = ["и", "Привет", "мир", "не", "длинноеслово", "которые", "на", "что", "был", "ключ1"]
    japanese = ["日本", "の", "東京", "です", "これは", "テスト", "漢字", "カナ"]
    rows = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rows += [(first + k, " ".join(rng.choices(w, weights=range(1, len(w) + 1), k=rng.randint(30, 90))), lang) for k in range(60) for first, w, lang in ((5000, russian, "ru"), (6000, japanese, "ja"))]
    rows += [(9001, " ".join(rng.choices(japanese, k=200)), "ru"), (9002, " ".join(x.upper() for x in rng.choices(russian, k=200)), "ru"), (9003, " ".join(rng.choices(["qzx", "vvk"], k=200)), "en"), (9004, "ЫЫЫ " * 30, "few"), (9005, None, "ru")]
    words, chars = {}, {}
    low = lambda t: (t or "").lower().encode().split()
    for _, t, lang in rows:
        words.setdefault(lang, Counter()).update(low(t))
        chars.setdefault(lang, Counter()).update(map(kind, t or ""))
    found = {r.doc_id: r for r in quality.quality_report(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)).collect()}
    for d, t, lang in rows:
        r, n = found[d], len(low(t))
        if sum(words[lang].values()) < 1000:
            assert r.class_distance is None and r.word_distance is None and r.kept == (not r.base_failed)
            continue
        common = sorted(words[lang].items(), key=lambda x: (-x[1], x[0]))[:32]
        share = lambda c: Counter({w: c[w] for w, _ in common} | {None: sum(c.values()) - sum(c[w] for w, _ in common)})  # noqa: B023, E731
        far, word_far = divergence(Counter(map(kind, t or "")), chars[lang]), divergence(share(Counter(low(t))), share(words[lang]))
        assert (r.class_distance, r.word_distance) == pytest.approx((far, word_far), abs=1e-6)
        over = n and (far > 0.25 + 0.5 / math.sqrt(n) or word_far > 0.30 + 1 / math.sqrt(n))
        assert r.kept == (not r.base_failed and not over)
    assert {d for d in (9001, 9002, 9003) if found[d].class_distance > 0.25 or found[d].word_distance > 0.3} == {9001, 9002, 9003}


def test_quality_keeps_clean_and_drops_foreign_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = quality.quality_report(docs).join(labels, "doc_id").collect()
    good, bad = [r for r in rows if r.quality == 1 and not r.base_failed], [r for r in rows if r.quality == 0]
    assert all(r.kept for r in good)
    assert sum(not r.kept for r in bad) > 0.8 * len(bad)


def test_filter_keeps_columns_of_clashing_names(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    df = docs.selectExpr("*", "1 AS common_words", "2 AS ref_lang", "doc_id * 2 AS quality")
    kept = quality.filter_documents(df)
    assert kept.columns == df.columns and 0 < kept.count() < df.count()
    assert kept.where("quality <> doc_id * 2").count() == 0
