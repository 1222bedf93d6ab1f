from __future__ import annotations

import base64
import hashlib
import random

import public_tokenizers as P
import pytest
import regex
import tiktoken
from tokenizers import Tokenizer

import numpy as np

from cartorio.llm import byte_bpe, pairs, queries, ragged
from cartorio.llm.byte_bpe import Encoder, decode, encode, read_ranks
from cartorio.llm.pretokens import pretoken_starts
from cartorio.llm.token_counts import Counter, read_merges, token_counts

RANKS, MERGES = P.path("byte_bpe_50k.tiktoken"), P.path("byte_bpe_50k.json")
LETTERS = "aés1٢'''strevmdl  \n\t !.-　 \u0085漢字😀RE²=="


@pytest.fixture(scope="module")
def library():
    ranks = {
        base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))
    }
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _texts(seed: int, n: int = 60) -> list[str]:
    rng = random.Random(seed)
    made = [
        "".join(rng.choice(LETTERS) for _ in range(rng.choice([0, 1, 2, 3, 5, 20, 200, 2000])))
        for _ in range(n)
    ]
    return [*made, "a" * 301, "=" * 500, "ab" * 150, "it's 'tis we'll'd <|endoftext|>\n"]


def _flat(texts):
    parts = [text.encode() for text in texts]
    ends = np.concatenate([[0], np.cumsum([len(part) for part in parts])])
    return np.frombuffer(b"".join(parts), np.uint8), ends


@pytest.mark.parametrize("seed", range(20))
def test_pretokens_are_the_pattern_s_matches(seed):
    texts = _texts(seed)
    data, ends = _flat(texts)
    starts = pretoken_starts(data, ends).tolist()
    found = [data[a:b].tobytes().decode() for a, b in zip(starts, [*starts[1:], len(data)])]
    assert found == [match for text in texts for match in regex.findall(P.PATTERN, text)]


def test_ids_survive_a_memory_that_forgets(library):
    encoder = Encoder(read_ranks(RANKS))
    encoder.memo.limit = len(encoder.memo.seed[0]) + 50
    for seed in range(5):
        texts = _texts(seed)
        ids, counts = encoder.encode(*_flat(texts))
        ends = np.concatenate([[0], np.cumsum(counts)])
        got = [ids[a:b].tolist() for a, b in zip(ends, ends[1:])]
        assert got == [library.encode_ordinary(text) for text in texts]


def _docs(spark, texts):
    """Null text, repeated rows, and columns named like the results."""
    rows = [(i, text, "x", 7) for i, text in enumerate(texts)]
    return spark.createDataFrame(
        [*rows, rows[0], (None, "null id", "x", 7), (-1, None, None, None)],
        "doc_id bigint, text string, ids string, n_tokens int",
    )


def test_encode_and_decode(spark, library):
    docs = _docs(spark, _texts(99))
    coded = encode(docs, RANKS)
    assert coded.columns == ["doc_id", "ids", "token_begins"]
    want = sorted((row.doc_id or 0, row.text or "") for row in docs.collect())
    got = sorted((row.doc_id or 0, bytes(row.decoded).decode()) for row in decode(coded, RANKS).collect())
    assert got == want
    texts = {row.doc_id: row.text or "" for row in docs.collect()}
    for row in coded.collect():
        assert row.ids == library.encode_ordinary(texts[row.doc_id])
        pieces = [len(library.decode_single_token_bytes(i)) for i in row.ids]
        assert row.token_begins == [sum(pieces[:k]) for k in range(len(pieces))]


def test_counts(spark):
    docs = _docs(spark, _texts(5))
    tokenizer = Tokenizer.from_file(MERGES)
    texts = {row.doc_id: row.text or "" for row in docs.collect()}
    rows = token_counts(docs, MERGES, limit=100).collect()
    assert len(rows) == docs.count()
    for row in rows:
        n = len(tokenizer.encode(texts[row.doc_id], add_special_tokens=False).ids)
        assert (row.n_tokens, row.over_limit) == (n, n > 100)
        assert row.n_bytes == len(texts[row.doc_id].encode())


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert token_counts(none, MERGES).collect() == []
    assert decode(encode(none, RANKS), RANKS).collect() == []


def test_pair_table_holds_what_it_was_given():
    rng = random.Random(1)
    given = {(rng.randrange(300), rng.randrange(300)): (k, k + 1) for k in range(5000)}
    table = pairs.PairTable(given)
    left, right = np.meshgrid(np.arange(300), np.arange(300))
    slots = table.find(left.ravel(), right.ravel())
    for a, b, slot in zip(left.ravel().tolist(), right.ravel().tolist(), slots.tolist()):
        assert int(table.ranks[slot]) == given.get((a, b), (int(pairs.NONE),))[0]


def test_queries_over_whole_tables(spark, library):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = queries.op8_byte_bpe(spark, folder).collect()
    assert len(rows) == len(texts)
    tokenizer = Tokenizer.from_file(MERGES)
    for row in rows:
        ids = library.encode_ordinary(texts[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(texts[row.doc_id].encode()).hexdigest()
    for row in queries.op10_token_counts(spark, folder).collect():
        assert row.n_tokens == len(tokenizer.encode(texts[row.doc_id], add_special_tokens=False).ids)


def _thue_morse(n=1024):
    word = "".join("ab"[bin(i).count("1") % 2] for i in range(n))
    return word, word.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("groups", [1, 2])
@pytest.mark.parametrize("turn", [1, -1])
def test_long_slices_that_polynomials_take_for_one(library, groups, turn):
    words = _thue_morse()[::turn]
    vocabulary = read_ranks(RANKS)
    encoder, counter = Encoder(vocabulary), Counter(read_merges(MERGES))
    found, counts = [], []
    for texts in ([words] if groups == 1 else [[word] for word in words]):
        ids, lengths = encoder.encode(*_flat(texts))
        found += np.split(ids, np.cumsum(lengths)[:-1])
        counts += counter.count(*_flat(texts)).tolist()
    assert [ids.tolist() for ids in found] == [library.encode(word, disallowed_special=()) for word in words]
    assert counts == [len(Tokenizer.from_file(MERGES).encode(word, add_special_tokens=False).ids) for word in words]


@pytest.mark.parametrize("kept", [0, 3])
def test_any_slices_of_one_hash_stay_apart(library, monkeypatch, kept):
    """Hashes of which only a few bits are left: slices meet all the time, in a group and in the memory."""
    whole = ragged.slice_hashes
    for module in (ragged, byte_bpe):
        monkeypatch.setattr(module, "slice_hashes", lambda *given: whole(*given) & np.uint64((1 << kept) - 1))
    encoder, counter = Encoder(read_ranks(RANKS)), Counter(read_merges(MERGES))
    reference = Tokenizer.from_file(MERGES)
    for seed in range(4):
        texts = [text for text in _texts(seed, 25) if "<|" not in text]
        ids, lengths = encoder.encode(*_flat(texts))
        assert [x.tolist() for x in np.split(ids, np.cumsum(lengths)[:-1])] == [
            library.encode(text, disallowed_special=()) for text in texts
        ]
        assert counter.count(*_flat(texts)).tolist() == [
            len(reference.encode(text, add_special_tokens=False).ids) for text in texts
        ]


def test_hashes_do_not_depend_on_the_place():
    data = np.frombuffer(b"xyz" * 3 + b"\0\0abc" + b"xyz", np.uint8)
    starts = np.array([0, 3, 6, 14, 9, 10])
    ends = np.array([3, 6, 9, 17, 10, 11])
    hashes = ragged.slice_hashes(data, starts, ends)
    assert len(set(hashes[:4].tolist())) == 1 and hashes[4] == hashes[5] != hashes[0]
