from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartorio.llm.perplexity import ORDER, counts_of, discounts_of, model_of, quartiles, rows_of
from cartorio.llm.quality_queries import op13_quality_rules
from cartorio.llm.quality_rules import QualitySettings, figures, judged

SCHEMA = "doc_id bigint, text string, lang string, n_words string, fold string"
BLANK = " \t\n\v\f\r"


def _split(text, marks):
    out = [""]
    for c in text:
        if c in marks:
            out.append("")
        else:
            out[-1] += c
    return [x for x in out if x]


def _figures(text):
    words = _split(text, BLANK)
    seen = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {i + j for i in range(len(words) - 7) if seen[tuple(words[i : i + 8])] > 1 for j in range(8)}
    lines = [line for line in text.split("\n") if _split(line, BLANK)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), len(covered))


def _symbols(text):
    out = []
    for c in text:
        n = ord(c)
        n = 0xE000 | n & 0xFFF if n > 0xFFFF else n
        if c == "\0":
            n = 0xFFFD
        if "A" <= c <= "Z":
            n += 32
        if "0" <= c <= "9":
            n = ord("0")
        if c in BLANK + " ":
            n = 32
            if out and out[-1] == 32:
                continue
        out.append(n)
    return out


class _Model:
    """Interpolated modified Kneser-Ney by definition, over tuples."""

    def __init__(self, texts):
        self.counts = {ORDER: Counter()}
        for text in texts:
            line = [0] * (ORDER - 1) + _symbols(text)
            self.counts[ORDER].update(tuple(line[i : i + ORDER]) for i in range(len(line) - ORDER + 1))
        for size in range(ORDER - 1, 0, -1):
            self.counts[size] = Counter(gram[1:] for gram in self.counts[size + 1])
        self.cut, self.after = {}, {}
        for size, counts in self.counts.items():
            n = Counter(counts.values())
            self.cut[size] = discounts_of(n[1], n[2], n[3], n[4])
            self.after[size] = defaultdict(list)
            for gram, count in counts.items():
                self.after[size][gram[:-1]].append(count)

    def p(self, gram):
        size = len(gram)
        if not size:
            following = self.after[1][()]
            return 1 / (len(following) + 1)
        following = self.after[size].get(gram[:-1])
        lower = self.p(gram[1:])
        if not following:
            return lower
        cut = self.cut[size]
        left = sum(cut[min(n, 3) - 1] for n in following)
        n = self.counts[size].get(gram, 0)
        return ((n - cut[min(n, 3) - 1] if n else 0) + left * lower) / sum(following)


def _brute(docs):
    """Log perplexities by the other fold's model; the folds as the library deals them."""
    models = [_Model([text for text, fold in docs if fold == number]) for number in (0, 1)]
    out = []
    for text, fold in docs:
        line = [0] * (ORDER - 1) + _symbols(text)
        model = models[1 - fold]
        grams = [tuple(line[i : i + ORDER]) for i in range(len(line) - ORDER + 1)]
        out.append(-sum(math.log(model.p(gram)) for gram in grams) / len(grams) if grams else None)
    return out


def _texts():
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 7))) for _ in range(60)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(5, 60))) for _ in range(60)]
    return texts + [
        None, "", " \n\t ", "A  b\n\nA  b\nA  b", "\0\0 日本語 🙂🙂 1999 2024", "x", "the same line\n" * 40,
        "eins zwei drei vier fünf sechs sieben acht " * 3, texts[0], texts[0].upper(), "ab " * 30_000,
    ]


def _docs(spark, texts, copies=1):
    rows = [(i, text, ["de", "fr", None][i % 3], "x", "y") for i, text in enumerate(texts)]
    return spark.createDataFrame(rows * copies, SCHEMA)


@pytest.mark.parametrize("block_bytes", [32 << 20, 2000])
def test_perplexities_against_the_definition(spark, block_bytes):
    texts = _texts()
    docs = _docs(spark, texts)
    folds = {r.doc_id: r.fold for r in docs.select(
        "doc_id", F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(2)).cast("int").alias("fold")
    ).collect()}
    got = {r.doc_id: r for r in judged(docs, settings=QualitySettings(block_bytes=block_bytes)).collect()}
    assert len(got) == len(texts)
    want = _brute([(text or "", folds[i]) for i, text in enumerate(texts)])
    for i, value in enumerate(want):
        found = got[i].log_perplexity
        assert (found is None) == (value is None)
        assert value is None or found == pytest.approx(value, abs=1e-5)


def test_probabilities_after_a_context_sum_to_one(spark, tmp_path):
    def write(df, name):
        df.write.parquet(f"{tmp_path}/{name}")
        return spark.read.schema(df.schema).parquet(f"{tmp_path}/{name}")

    named = spark.createDataFrame([(text,) for text in _texts()], "words string")
    rows = [r for r in model_of(counts_of(rows_of(named)), write).collect() if r.fold == 0]
    p = {(r["size"], r.gram): math.exp(r.logp) for r in rows if r.logp is not None}
    back = {(r["size"], r.gram): math.exp(r.back) for r in rows if r.back is not None}
    alphabet = [gram for size, gram in p if size == 1]
    assert p[0, 0] + sum(p[1, a] for a in alphabet) == pytest.approx(1, abs=1e-5)
    for context in [gram for size, gram in back if size == 1][:10]:
        total = sum(p.get((2, context << 16 | a), back[1, context] * p[1, a]) for a in alphabet)
        assert total + back[1, context] * p[0, 0] == pytest.approx(1, abs=1e-4)


def test_figures_against_brute_force(spark):
    texts = [text or "" for text in _texts()] + ["a\nb\na\n b\nb\n\n\n", "\n", "|#| <> **\r\n**\r\n"]
    got = judged(_docs(spark, texts)).collect()
    for row in got:
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == _figures(
            texts[row.doc_id]
        )
        assert row.base_failed == (row.n_words < 20 or 100 * row.n_repeat_words > 30 * row.n_words)
        assert not (row.base_failed and row.kept)


def test_bands_by_language_and_kept(spark):
    rng = random.Random(2)
    words = ["haus", "baum", "garten", "strasse", "licht", "wasser", "feuer", "stein"]
    prose = [" ".join(rng.choice(words) for _ in range(80)) for _ in range(120)]
    junk = ["".join(chr(rng.randint(0x21, 0x7E)) for _ in range(400)) for _ in range(2)]
    junk = [" ".join(x[i : i + 9] for i in range(0, 400, 9)) for x in junk]
    rows = judged(spark.createDataFrame(
        [(i, text, "de", "", "") for i, text in enumerate(prose + junk)], SCHEMA
    )).collect()
    kept = {r.doc_id for r in rows if r.kept}
    assert not kept & {120, 121} and len(kept) >= 115


def test_quartiles_of_any_group(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["a", "b", None]), rng.choice([None, rng.gauss(2, 0.3)])) for _ in range(4000)]
    table = spark.createDataFrame(rows, "lang string, x double")
    for row in quartiles(table.repartition(7), "x", "lang").collect():
        values = sorted(x for lang, x in rows if lang == row.lang and x is not None)
        for quarter, found in ((1, row.q1), (2, row.q2), (3, row.q3)):
            assert found == pytest.approx(values[-(-quarter * len(values) // 4) - 1], abs=0.001)
    assert sorted(map(str, quartiles(table, "x", "lang").collect())) == sorted(map(str, quartiles(table.repartition(3), "x", "lang").collect()))


def test_poor_documents_go_and_good_ones_stay(spark):
    """Of the labelled documents that pass the plain rules."""
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality")
    rows = op13_quality_rules(spark, folder).filter("not base_failed").join(labels, "doc_id")
    found = {(r.quality, r.kept): r["count"] for r in rows.groupBy("quality", "kept").count().collect()}
    assert found[1, False] <= 0.005 * (found[1, False] + found[1, True])
    assert found[0, False] >= 0.2 * (found[0, False] + found[0, True])


def test_many_rows_alike(spark, setting):
    texts = _texts()[:20]
    docs = _docs(spark, texts).unionAll(spark.createDataFrame([(7, "gleich " * 30, "de", "", "")] * 500, SCHEMA))
    rows = judged(docs, settings=QualitySettings(block_bytes=4000)).filter("n_words = 30").collect()
    assert len([r for r in rows if r.doc_id == 7 and r.n_repeat_words == 30]) == 500


def test_empty_table(spark):
    assert judged(_docs(spark, [])).collect() == []


def test_one_text_beyond_a_block(spark):
    long = " ".join(random.Random(1).choice(["ja", "nein", "doch", "wohl"]) for _ in range(200_000))
    rows = judged(_docs(spark, [long, "kurz"]), settings=QualitySettings(block_bytes=1000)).collect()
    assert {r.n_words for r in rows} == {200_000, 1}


def test_the_query_covers_all_documents(spark):
    rows = op13_quality_rules(spark, "/root/testdata/sf0.001")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert rows.count() == docs.count()
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet").filter("quality = 1")
    good = rows.filter("not base_failed").join(labels, "doc_id", "left_semi")
    assert good.filter("kept").count() >= 0.98 * good.count()
    docs = {r.doc_id: r.text or "" for r in docs.collect()}
    for row in rows.collect()[:80]:
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == _figures(docs[row.doc_id])
    assert figures(np.zeros(0, np.uint8), np.zeros(1, np.int64))["n_words"].tolist() == []
