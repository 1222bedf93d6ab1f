from __future__ import annotations

import random
import zlib
from collections import Counter

import pytest

from cartorio.llm.spellings import _neighbours, minimised, variants
from cartorio.llm.spelling_queries import damaged_words


def _near(one, two):
    if len(one) == len(two):
        return sum(a != b for a, b in zip(one, two)) == 1
    short, long = sorted((one, two), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def _brute(counts, factor=10):
    forms, out = {}, {}
    for word, n in counts.items():
        near = [w for w in counts if w != word and _near(word, w)]
        best = min(near, key=lambda w: (-counts[w], w), default=None)
        if best is not None and counts[best] >= factor * n:
            forms[word] = best
        out[word] = len(near)
    rows = set()
    for word, n in counts.items():
        root = word
        while root in forms:
            root = forms[root]
        form = forms.get(word)
        rows.add((word, n, out[word], form, counts[form] if form else None, root))
    return rows


def _found(spark, counts, **settings):
    table = spark.createDataFrame(sorted(counts.items()), "word string, n bigint")
    rows = variants(table, **settings).select("word", "n", "n_near", "form", "form_n", "root").collect()
    assert len(rows) == len(counts)
    return set(map(tuple, rows))


def test_the_acceptor_is_minimal_and_numbers_its_words():
    words = sorted({"tap", "taps", "top", "tops", "stop", "stops"})
    machine = minimised([tuple(map(ord, w)) for w in words])
    assert len(machine.final) == 7  # one for each different future
    for number, word in enumerate(words):
        state, at = len(machine.final) - 1, 0
        for letter in word:
            edges = range(machine.first[state], machine.first[state + 1])
            edge = next(e for e in edges if machine.symbols[e] == ord(letter))
            state, at = machine.targets[edge], at + machine.before[edge]
        assert machine.final[state] and at == number


@pytest.mark.parametrize("pairs", [1 << 20, 3])
def test_parts_against_brute_force(monkeypatch, pairs):
    monkeypatch.setattr("cartorio.llm.spellings.PAIRS", pairs)
    rng = random.Random(3)
    for turn in range(60):
        short, may_end = rng.randint(1, 5), rng.random() < 0.5
        words = sorted({"".join(rng.choice("abcñ"[: 2 + turn % 3]) for _ in range(rng.choice([short, short + 1])))
                        for _ in range(rng.randint(2, 30))})
        want = Counter()
        for one in words:
            for two in words:
                if not _near(one, two) or len(one) == len(two) != short:
                    continue
                low, high = sorted((one, two), key=len)
                if len(one) != len(two) and not may_end and high.startswith(low):
                    continue
                want[one] += 1
        got = _neighbours(words, [1] * len(words), words, [[short, "", "", may_end]] * len(words)).to_pydict()
        assert dict(zip(got["word"], got["near"])) == dict(want)


@pytest.mark.parametrize("crowded", [5000, 4])
def test_variants_against_brute_force(spark, crowded):
    rng = random.Random(crowded)
    stems = ["".join(rng.choice("abß") for _ in range(rng.randint(5, 9))) for _ in range(12)]
    counts = {}
    for stem in stems:  # a third of all words share a beginning
        for _ in range(25):
            word = list("anfang" * (rng.random() < 0.4) + stem)
            if rng.random() < 0.8:
                at = rng.randrange(len(word))
                word[at : at + rng.choice([0, 1])] = rng.choice(["", "a", "ab"])
            counts["".join(word)] = rng.choice([2, 3, 25, 300, 4000])
    assert _found(spark, counts, crowded=crowded) == _brute(counts)


def test_runs_of_one_letter_ties_and_chains(spark):
    counts = {"a" * n: 10**max(0, 9 - n) for n in range(1, 9)}
    counts |= {"ccccccc": 5, "ccccccd": 50, "cccccce": 50, "x": 2, "": 3}
    assert _found(spark, counts, crowded=2) == _brute(counts)


def test_no_words(spark):
    assert _found(spark, {}) == set()


def test_runs_of_documents(spark):
    texts = {1: "Straße straße STRAßE, naïveté×2 Ünicode ünicode", 2: None, 3: "", 4: "abcdefg " * 40 + "abcdefé" * 3,
             5: "a" * 50_000 + " " + "é" * 9, None: "abcdefgh abcdefgh"}
    want = Counter()
    for key, text in texts.items():
        run = ""
        for c in (text or "") + " ":
            if c.isascii() and c.isalpha() or "À" <= c <= "ÿ":
                run += c.lower() if c.isascii() else c
                continue
            if run:
                h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
                if h % 31 == 0:
                    run = run[: h % len(run)] + run[h % len(run) + 1 :]
                want[run] += len(run) >= 7
            run = ""
    docs = spark.createDataFrame([(k, t, "w") for k, t in texts.items()], "doc_id bigint, text string, word string")
    got = {row.word: row.n for row in damaged_words(docs).collect()}
    assert got == {word: n for word, n in want.items() if n >= 2} and got


def test_parts_are_cut_until_they_fit(spark, tmp_path):
    from pyspark.sql import functions as F

    from cartorio.llm.spellings import KEY, _parts

    words = spark.createDataFrame([(f"vorne{i:06d}hinten", 2) for i in range(3000)], "word string, n bigint")
    parts = _parts(words, str(tmp_path), 50)
    left = F.col("size") - F.length("pre") - F.length("suf")
    assert parts.filter(left >= 2).groupBy(*KEY).count().filter("count > 50").isEmpty()
