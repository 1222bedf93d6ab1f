from __future__ import annotations

import hashlib
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from cartorio.llm import edit_embedding, edit_queries, in_order
from cartorio.llm.edit_embedding import (
    STRIDE, bands, ended, fingerprinted, flat_codes, likeness, likeness_of, near_documents,
    sampled_steps, walk, _coins, _levels,
)


def _fingerprints(texts):
    parts = [text.encode() for text in texts]
    ends = np.concatenate([[0], np.cumsum([len(part) for part in parts])])
    codes, starts, _ = flat_codes(np.frombuffer(b"".join(parts), np.uint8), ends)
    lengths = np.diff(starts)
    return walk(ended(codes, starts[:-1], lengths), lengths)


def _plain(text):
    """The walk of one text, step by step."""
    codes, _, _ = flat_codes(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text.encode())]))
    level = int(max(0, np.floor(np.log2(max(2 * len(text) / 128, 1)))))
    at = step = 0
    out = ""
    while True:
        block, inside = divmod(step, STRIDE)
        if inside == 0 and at == len(text) and (step or False):
            return f"{block:x}.{level:x}.{out}"
        code = int(codes[at]) if at < len(text) else 64
        if _levels(block)[inside] >= level:
            out += "-" if code == 64 else chr(48 + code)
        at += int(_coins(block)[inside, code])
        step += 1


def _texts():
    rng = random.Random(5)
    return ["", "a", "é", "short text", "漢字 😀", *(
        "".join(rng.choice("abcdefgh éß\n") for _ in range(n)) for n in (63, 64, 65, 200, 1000, 5000)
    )]


def test_walks_side_by_side_equal_walks_alone():
    texts = _texts()
    assert _fingerprints(texts) == [_plain(t) for t in texts]
    assert _fingerprints(texts[::-1]) == [_plain(t) for t in texts[::-1]]


def test_likeness():
    rng = random.Random(6)
    texts = [t for t in _texts() if len(t) > 150]
    for text in texts:
        at = rng.randrange(len(text))
        near = text[:at] + "XY" + text[at:]
        far = "".join(rng.choice("ijklmnopqrst") for _ in text)
        a, b, c = _fingerprints([text, near, far])
        assert likeness(a, a) == 1.0 and likeness(a, b) == likeness(b, a)
        assert likeness(a, b) > likeness(a, c) and likeness(a, c) < 0.3
    empty, some = _fingerprints(["", texts[0]])
    assert likeness(empty, empty) == 1.0 and likeness(empty, some) == 0.0


def test_levels_share_steps():
    assert set(sampled_steps(3, 50)) <= set(sampled_steps(2, 50)) <= set(sampled_steps(0, 50).tolist())
    assert len(sampled_steps(0, 50)) == 50 * STRIDE


def test_bands_find_near_texts():
    rng = random.Random(8)
    found = 0
    for _ in range(60):
        text = "".join(rng.choice("abcdefghij ") for _ in range(rng.randrange(300, 3000)))
        at = int(len(text) * 0.9)
        a, b, c = _fingerprints([text, text[:at] + "zz" + text[at:], "".join(rng.sample(text, len(text)))])
        found += not set(bands(a)).isdisjoint(bands(b))
        assert set(bands(a)) == set(bands(a))
    assert found >= 58


@pytest.mark.parametrize("place", [0.0, 0.45, 0.9])
def test_bands_find_edits_anywhere(place):
    """A twelfth of the text is replaced; pairs of likeness 0.8 or more share a band."""
    rng = random.Random(11)
    alike = found = chance = 0
    for _ in range(220):
        letters = [rng.choice("abcdefghijklmnop ") for _ in range(rng.randrange(150, 6000))]
        at, n = int(place * len(letters)), len(letters) // 12
        other = letters[:at] + [rng.choice("qrstuvwxyz") for _ in range(n)] + letters[at + n :]
        a, b, c = _fingerprints(["".join(x) for x in (letters, other, rng.sample(letters, len(letters)))])
        chance += not set(bands(a)).isdisjoint(bands(c))
        if likeness(a, b) >= 0.8:
            alike += 1
            found += not set(bands(a)).isdisjoint(bands(b))
    assert alike >= 100 and found >= 0.99 * alike and chance <= 2


def _edited(rows):
    """Plain pairing of (key, text): descending keys, null last."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for at, (key, text) in enumerate(order):
        text, after = text or "", order[(at + 1) % len(order)][1] or ""
        cut = len(text) // 3
        out.append((key, len(text), text[: len(text) - cut] + after[:cut], text, after))
    return out


@pytest.mark.parametrize("run_bytes", [1 << 22, 3000])
def test_edits_against_plain_pairing(spark, monkeypatch, run_bytes):
    monkeypatch.setattr(in_order, "RUN_BYTES", run_bytes)
    rng = random.Random(9)
    rows = [(i * 7 - 40, "".join(rng.choice("abcé 漢\n") for _ in range(rng.randrange(0, 900)))) for i in range(60)]
    rows += [(3, None), (None, "text without a key"), (1000, "end")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, run string")
    got = {r.doc_id: r for r in edit_queries.with_edits(docs.repartition(3)).collect()}
    assert len(got) == len(rows)
    for key, n, edited, text, after in _edited(rows):
        row = got[key]
        a, b, c = _fingerprints([text, edited, after])
        assert (row.n_chars, row.edited_sha256) == (n, hashlib.sha256(edited.encode()).hexdigest())
        assert (row.fingerprint, row.edited_fingerprint) == (a, b)
        assert (row.near_edited, row.near_next) == (likeness(a, b), likeness(a, c))


def test_repeated_rows_one_row_and_none(spark):
    schema = "doc_id bigint, text string"
    rows = [(1, "abc"), (1, "abc"), (1, "abc"), (1, "xyz"), (0, "last")]
    got = edit_queries.with_edits(spark.createDataFrame(rows, schema)).collect()
    assert sorted(r.doc_id for r in got) == [0, 1, 1, 1, 1]
    assert sorted(r.near_next for r in got).count(1.0) == 2  # two of the three are followed by a copy
    one = edit_queries.with_edits(spark.createDataFrame([(5, "abcdef")], schema)).first()
    assert one.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest() and one.near_next == 1.0
    assert edit_queries.with_edits(spark.createDataFrame([], schema)).collect() == []


def test_groups_of_near_documents(spark):
    rng = random.Random(10)
    rows = []
    for group in range(20):
        text = "".join(rng.choice("abcdefghij ") for _ in range(1200))
        rows += [(10 * group + k, text + "!" * k) for k in range(4)]
    docs = spark.createDataFrame([*rows, (500, None), (501, "")], "doc_id bigint, text string")
    got = {r.key: r.group_key for r in near_documents(docs, 0.9).collect()}
    assert len(got) == 82 and got[501] == 500
    assert sum(got[i] == i // 10 * 10 for i, _ in rows) >= 78
    pairs = fingerprinted(docs).limit(2).select(likeness_of("fingerprint", F.col("fingerprint")).alias("x"))
    assert [r.x for r in pairs.collect()] == [1.0, 1.0]


@pytest.mark.parametrize("block", [400, 7])
def test_links_against_all_pairs(spark, monkeypatch, block):
    """Chains of copies, each a little further from the first: no link of a shared band is lost."""
    monkeypatch.setattr(edit_embedding, "BLOCK", block)
    rng = random.Random(12)
    rows = [(900, None), (901, ""), (902, ""), (None, "a text without a key")]
    for chain in range(4):
        letters = [rng.choice("abcdefghijklmnop ") for _ in range(900 + 60 * chain)]
        for k in range(25):
            at = rng.randrange(len(letters) - 45)
            letters[at : at + 45] = [rng.choice("qrstuvwxyz") for _ in range(45)]
            rows += [(100 * chain + k, "".join(letters))] * (1 + k % 2)
    marks = _fingerprints([text or "" for _, text in rows])
    root, links = list(range(len(rows))), [0] * len(rows)
    for i, one in enumerate(marks):
        for j, other in enumerate(marks[:i]):
            if not set(bands(one)).isdisjoint(bands(other)) and likeness(one, other) >= 0.8:
                links[i] += 1
                links[j] += 1
                a, b = root[i], root[j]
                root = [b if r == a else r for r in root]
    least = {}
    for (key, _), r in zip(rows, root):
        least[r] = min(x for x in (key, least.get(r)) if x is not None) if key is not None else least.get(r)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted(((r.key, r.group_key, r.n_links) for r in near_documents(docs).collect()), key=str)
    assert got == sorted(((key, least[r], n) for (key, _), r, n in zip(rows, root, links)), key=str)


def test_query_groups(spark):
    folder = "/root/testdata/sf0.001"
    rows = edit_queries.op4_edit_fingerprints(spark, folder).collect()
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    want = {(r.key, r.group_key, r.n_links) for r in near_documents(docs).collect()}
    assert {(r.doc_id, r.group_key, r.n_links) for r in rows} == want and len(rows) == docs.count()


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: r for r in edit_queries.op4_edit_fingerprints(spark, folder).collect()}
    want = _edited(docs)
    assert len(got) == len(want)
    closer = 0
    for key, n, edited, text, _ in want:
        row = got[key]
        assert (row.n_chars, row.edited_sha256) == (n, hashlib.sha256(edited.encode()).hexdigest())
        closer += row.near_edited > row.near_next
    assert closer >= 0.97 * len(want)
    by_text = {}
    for key, text in docs:
        assert by_text.setdefault(text, got[key].fingerprint) == got[key].fingerprint


def test_few_unlike_texts_share_a_band():
    """Real texts, near copies among them: what shares a band by chance stays few."""
    import pyarrow.parquet as pq

    texts = pq.read_table("/root/testdata/sf0.1/documents.parquet")["text"].to_pylist()[:3000]
    marks = sorted(set(_fingerprints([text or "" for text in texts])))
    buckets = {}
    for at, mark in enumerate(marks):
        for key in bands(mark):
            buckets.setdefault(key, []).append(at)
    pairs = {(a, b) for held in buckets.values() for a in held for b in held if a < b}
    unlike = sum(likeness(marks[a], marks[b]) < 0.5 for a, b in pairs)
    assert unlike <= len(marks) / 100 and pairs


def test_levels_of_texts_nearly_alike_meet():
    """One of a pair just below, the other just above the length at which the level changes."""
    rng = random.Random(15)
    alike = found = 0
    for n in (120, 240, 500, 1000, 4000):
        for _ in range(30):
            letters = [rng.choice("abcdefghijklmnop ") for _ in range(int(n * rng.uniform(0.85, 1.0)))]
            longer = letters + [rng.choice("abcdefghijklmnop ") for _ in range(len(letters) // 6)]
            a, b = _fingerprints(["".join(letters), "".join(longer)])
            if likeness(a, b) >= 0.8:
                alike += 1
                found += not set(bands(a)).isdisjoint(bands(b))
    assert alike >= 50 and found >= 0.98 * alike


def test_one_very_long_text(spark):
    rng = random.Random(16)
    long = " ".join(rng.choice(["eins", "zwei", "drei", "vier"]) for _ in range(60_000))
    rows = [(1, long), (2, long + " noch"), (3, "kurz"), (4, long[: len(long) // 2])]
    got = {r.key: r.group_key for r in near_documents(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4}


def test_memory_of_a_group_of_texts():
    # Before, places and codepoints of all texts at once took 33 times the bytes of a group (now 10).
    texts = [f"{n:06d} ação ".encode() * 120 for n in range(2_000)]
    packed = [zstandard.ZstdCompressor().compress(text) for text in texts]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([0] * 2_000, pa.int32()), pa.array([False] * 1_999 + [True]), pa.array(range(2_000), pa.int64()),
         pa.array(packed, pa.binary())], names=["run", "extra", "key", "packed"],
    )
    tracemalloc.start()
    try:
        rows = sum(found.num_rows for found in edit_queries._compared(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows == 1_999 and peak < 14 * sum(map(len, texts))
