"""Similarity join on word shingles by a MinHash LSH forest (operator 7).

Every set of shingles has one signature, cut into trees of eight hashes each. In a tree the signatures
are a prefix trie, held sorted: texts that share a prefix are neighbours, and how much any two share is
the least that neighbours between them share. A match is sought from the longest prefix on, and each
class shortens it only as far as its recall needs: to the depth at which a pair at the lowest similarity
that a set of its size can have with another, and still reach the threshold, is found with the target
probability. A set of five shingles can't be four fifths like another without being more than that, so
it stops earlier than one of five hundred. What two classes share at the deeper of their depths makes
them candidates; candidates are verified exactly, on their whole shingle sets.

Texts with the same set form a class, represented once. A pair of classes is judged in the first tree
in which it meets and nowhere else, so links are counted without listing pairs: tasks return how many
links each class has and the edges of a spanning forest. A subtree at the shortest depth any class needs
is a bucket; one of more than ``block`` classes is cut into blocks, and every pair of blocks is a piece
of work of its own; nothing is capped.

Defined results: a null or empty text, or one without words, has no shingles, so it is alone and has no
links; a text of fewer than five words is one shingle; repeated rows are copies of each other, linked;
the smallest key is a group's id, null keys come last; an empty table gives an empty table. Only the
key and the text are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartorio.llm.components import components
from cartorio.llm.ragged import bytes_of, groups
from cartorio.llm.shingles import set_keys, shingles_of, signatures
from cartorio.sources.scratch import fresh_folder


@dataclass(frozen=True)
class JoinSettings:
    """``longest``: hashes of a tree at most; ``block``: classes that are compared in one piece."""

    shingle: int = 5
    threshold: float = 0.8
    trees: int = 12
    longest: int = 8
    recall: float = 0.995
    block: int = 400

    def recall_at(self, prefix: int) -> float:
        """How likely a pair at the threshold shares a prefix of that length in some tree."""
        return 1 - (1 - self.threshold**prefix) ** self.trees

    @property
    def prefix(self) -> int:
        """The longest prefix that reaches the target recall at the threshold, or one hash if none does."""
        return self._depth(self.threshold)

    def _depth(self, similarity: float) -> int:
        length = self.longest
        while length > 1 and 1 - (1 - similarity**length) ** self.trees < self.recall:
            length -= 1
        return length

    def depths(self, most: int) -> np.ndarray:
        """To what depth sets of 0, 1, ... shingles shorten their prefix; larger sets to ``prefix``."""
        return np.array([self._depth(self.lowest_similarity(size)) for size in range(most)], np.int8)

    def lowest_similarity(self, size: int) -> float:
        """The least similarity at or over the threshold that a set of ``size`` has with another set."""
        found = 1.0
        for other in range(max(1, int(size * self.threshold)), int(size / self.threshold) + 2):
            for common in range(int(self.threshold * (size + other) / (1 + self.threshold)), min(size, other) + 1):
                similarity = common / (size + other - common)
                if self.threshold <= similarity < found:
                    found = similarity
                    break
        return found


def _shingled(rows: DataFrame, settings: JoinSettings, sets: bool) -> DataFrame:
    """``rows`` (any columns and ``__text``) with class, size and either signature or set instead of the text.

    With ``sets`` the column ``expected`` tells the class that is wanted of a row; others are left out.
    """
    others = [name for name in rows.columns if name != "__text"]
    hashes = settings.trees * settings.longest
    out = T.StructType([
        *rows.select(*others).schema, T.StructField("class", T.BinaryType()), T.StructField("size", T.IntegerType()),
        T.StructField("shingles" if sets else "signature", T.BinaryType()),
    ])

    def cut(data: np.ndarray, ends: np.ndarray, empty: np.ndarray) -> pa.Array:
        whole = np.ascontiguousarray(data).tobytes()
        parts = zip(ends[:-1].tolist(), ends[1:].tolist(), empty.tolist())
        return pa.array([None if none else whole[a:b] for a, b, none in parts], pa.binary())

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()  # rows alike lie side by side after the join; one set of a class is enough
        for group in groups(batches, "__text"):
            found, bounds = shingles_of(*bytes_of(group.column("__text")), settings.shingle)
            empty = np.diff(bounds) == 0
            rank = np.arange(len(bounds))
            more = (
                cut(found, bounds * 8, empty) if sets
                else cut(signatures(found, bounds, hashes), rank * 4 * hashes, empty)
            )
            made = pa.RecordBatch.from_arrays(
                [*(group.column(name) for name in others),
                 cut(set_keys(found, bounds), rank * 16, empty), pa.array(np.diff(bounds), pa.int32()), more],
                names=out.names,
            )
            if sets:
                kept = []
                for row, pair in enumerate(zip(made.column("class").to_pylist(), made.column("expected").to_pylist())):
                    if pair[0] == pair[1] and pair[0] not in seen:
                        seen.add(pair[0])
                        kept.append(row)
                made = made.take(pa.array(kept, pa.int64()))
            yield made

    return rows.mapInArrow(task, out)


def _text(column: str) -> Column:
    return F.lower(F.coalesce(F.col(column), F.lit(""))).alias("__text")


def _buckets(signature: Column, settings: JoinSettings) -> Column:
    """The subtree of each tree: a hash of the tree's number and the shortest prefix."""
    whole, short = 4 * settings.longest, 4 * settings.prefix
    return F.transform(
        F.sequence(F.lit(0), F.lit(settings.trees - 1)),
        lambda tree: F.xxhash64(tree, F.substring(signature, tree * F.lit(whole) + 1, F.lit(short))),
    )


def _written(df: DataFrame, folder: str, name: str) -> DataFrame:
    df.write.parquet(f"{folder}/{name}")
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}")


# --- pieces of work: one block of a bucket, or two, side by side ----------------------------------


def _pieces(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.Table]:
    """Rows sorted by (bucket, low, high) as tables that hold whole pieces only, many small ones each."""
    waiting: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        waiting.append(batch)
        rows += batch.num_rows
        if rows < limit:
            continue
        table = pa.Table.from_batches(waiting)
        cuts = _piece_bounds(table)
        if len(cuts) > 2:
            yield table.slice(0, cuts[-2])
            table = table.slice(cuts[-2])
        waiting, rows = table.to_batches(), table.num_rows
    if waiting:
        yield pa.Table.from_batches(waiting)


def _piece_bounds(table: pa.Table) -> np.ndarray:
    keys = np.column_stack([table[name].to_numpy() for name in ("bucket", "low", "high")])
    return np.concatenate([[0], np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1, [len(keys)]])


@dataclass
class Piece:
    """The classes of a piece, each once, and which pairs of them are judged here."""

    rows: np.ndarray
    asked: np.ndarray


Shares = Callable[[np.ndarray, int], np.ndarray]


def _same_keys(table: pa.Table) -> Shares:
    """Classes share a tree where their keys in it (``trees``) are the same."""
    met = table["trees"].combine_chunks().flatten().to_numpy().reshape(table.num_rows, -1)
    return lambda rows, tree: met[rows, tree][:, None] == met[rows, tree][None, :]


class _Forest:
    """The sorted tries of the classes of a table, a few at a time."""

    def __init__(self, table: pa.Table, settings: JoinSettings, depths: np.ndarray) -> None:
        whole = b"".join(table["signature"].to_pylist())
        self.hashes = np.frombuffer(whole, ">u4").reshape(table.num_rows, settings.trees, settings.longest)
        size = table["size"].to_numpy()
        self.depth = np.where(size < len(depths), depths[np.minimum(size, len(depths) - 1)], settings.prefix)

    def __call__(self, rows: np.ndarray, tree: int) -> np.ndarray:
        """Which of the rows share a prefix as long as the deeper of both asks for."""
        needed = np.maximum(self.depth[rows][:, None], self.depth[rows][None, :])
        return self.shared(rows, tree) >= needed

    def shared(self, rows: np.ndarray, tree: int) -> np.ndarray:
        """How many hashes of a tree any two of the rows share from the first on."""
        hashes = self.hashes[rows, tree]
        order = np.lexsort(hashes.T[::-1])
        apart = hashes[order[1:]] != hashes[order[:-1]]
        next_ = np.where(apart.any(axis=1), apart.argmax(axis=1), hashes.shape[1])
        out = np.full((len(rows), len(rows)), hashes.shape[1], np.int8)
        for place in range(len(rows) - 1):
            least = np.minimum.accumulate(next_[place:])
            out[order[place], order[place + 1 :]] = least
            out[order[place + 1 :], order[place]] = least
        return out


def _judged_here(table: pa.Table, shares: Shares | None = None) -> Iterator[Piece]:
    """Pairs of classes of a piece that share its tree and haven't met in an earlier one.

    Two blocks are compared across, a block alone with itself.
    """
    shares = shares or _same_keys(table)
    buckets = table["bucket"].to_numpy()
    block, tree = table["block"].to_numpy(), table["tree"].to_numpy()
    low, high = table["low"].to_numpy(), table["high"].to_numpy()
    keys = np.frombuffer(b"".join(table["class"].to_pylist()), "S16") if len(buckets) else np.zeros(0, "S16")
    keys = keys.view(np.uint64).reshape(-1, 2) if len(buckets) else np.zeros((0, 2), np.uint64)
    bounds = _piece_bounds(table)
    for begin, end in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if end - begin < 2:
            continue
        rows = np.arange(begin, end)
        order = np.lexsort((block[rows], keys[rows, 1], keys[rows, 0]))
        rows = rows[order]
        once = np.ones(len(rows), bool)  # a class may come twice if its key does
        once[1:] = (keys[rows[1:]] != keys[rows[:-1]]).any(axis=1)
        rows = rows[once]
        if len(rows) < 2:
            continue
        asked = np.triu(shares(rows, int(tree[begin])), 1)
        if low[begin] != high[begin]:
            asked &= block[rows][:, None] != block[rows][None, :]
        for earlier in range(int(tree[begin])):
            if not asked.any():
                break
            asked &= ~shares(rows, earlier)
        if asked.any():
            yield Piece(rows, asked)


#: Sets of more shingles have the depth of the largest ones: what they can share lies close enough.
_SIZES = 400


def _wanted(batches: Iterator[pa.RecordBatch], settings: JoinSettings) -> Iterator[pa.RecordBatch]:
    """Of each piece the classes with a pair to judge; no shingles are needed to tell."""
    names, depths = ("bucket", "tree", "low", "high", "block", "class"), settings.depths(_SIZES)
    for table in _pieces(batches, 10_000):
        shares = _Forest(table, settings, depths)
        kept = [piece.rows[(piece.asked.any(0) | piece.asked.any(1))] for piece in _judged_here(table, shares)]
        if kept:
            yield from table.select(names).take(pa.array(np.concatenate(kept))).combine_chunks().to_batches()


def _links(batches: Iterator[pa.RecordBatch], settings: JoinSettings) -> Iterator[pa.RecordBatch]:
    threshold, depths = settings.threshold, settings.depths(_SIZES)
    for table in _pieces(batches, 4_000):
        shares = _Forest(table, settings, depths)
        sets = [np.frombuffer(found, np.uint64) for found in table["shingles"].to_pylist()]
        copies = table["copies"].to_numpy()
        names = table["class"].to_pylist()
        out: tuple[list[bytes], list[int], list[bytes | None]] = ([], [], [])
        for piece in _judged_here(table, shares):
            rows = piece.rows.tolist()
            pairs = _linked([sets[row] for row in rows], piece.asked, threshold)
            if not len(pairs):
                continue
            links = np.zeros(len(rows), np.int64)
            np.add.at(links, pairs[:, 0], copies[piece.rows][pairs[:, 1]])
            np.add.at(links, pairs[:, 1], copies[piece.rows][pairs[:, 0]])
            for place in np.flatnonzero(links).tolist():
                out[0].append(names[rows[place]])
                out[1].append(int(links[place]))
                out[2].append(None)
            for place, root in _forest(pairs, len(rows)):
                out[0].append(names[rows[place]])
                out[1].append(0)
                out[2].append(names[rows[root]])
        if out[0]:
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.binary()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary())],
                names=["class", "links", "other"],
            )


def _forest(pairs: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Each linked place with the first place of its component in this piece."""
    root = np.arange(n)
    while True:
        lower = np.minimum(root[pairs[:, 0]], root[pairs[:, 1]])
        new = root.copy()
        np.minimum.at(new, pairs[:, 0], lower)
        np.minimum.at(new, pairs[:, 1], lower)
        new = new[new]
        if (new == root).all():
            return [(place, int(r)) for place, r in enumerate(root) if r != place]
        root = new


def _linked(sets: list[np.ndarray], asked: np.ndarray, threshold: float) -> np.ndarray:
    """The asked pairs whose sets are similar enough, by exact intersections."""
    sizes = np.array([len(s) for s in sets])
    if len(sets) == 2:
        both = len(np.intersect1d(*sets, assume_unique=True))
        good = both / (sizes.sum() - both) >= threshold
        return np.array([[0, 1]] if good else [], int).reshape(-1, 2)
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, which, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = held >= 2
    place = (np.cumsum(shared) - 1)[which]
    some = shared[which]
    common = np.zeros(asked.shape, np.int64)
    for begin in range(0, int(shared.sum()), 1 << 15):  # so many shingles at a time
        here = some & (place >= begin) & (place < begin + (1 << 15))
        width = min(1 << 15, int(shared.sum()) - begin)
        bits = np.zeros((len(sets), -(-width // 64) * 64), bool)
        bits[owner[here], place[here] - begin] = True
        packed = np.packbits(bits, axis=1).view(np.uint64)
        for row in range(len(sets) - 1):
            others = np.flatnonzero(asked[row])
            if len(others):
                common[row, others] += np.bitwise_count(packed[row] & packed[others]).sum(1, dtype=np.int64)
    first, second = np.nonzero(asked)
    both = common[first, second]
    good = both / (sizes[first] + sizes[second] - both) >= threshold
    return np.column_stack([first[good], second[good]])


# --- the join --------------------------------------------------------------------------------------


def similar(
    docs: DataFrame,
    settings: JoinSettings = JoinSettings(),
    key: str | Column = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row for each row of ``docs``: ``key``, ``class_key``, ``group_key`` and ``n_links``.

    ``class_key`` is the smallest key with the same shingles, ``group_key`` that of the connected
    group, ``n_links`` the number of other rows whose similarity reaches the threshold.
    """
    spark = docs.sparkSession
    folder = fresh_folder(spark, "ngram")
    source = docs.select((F.col(key) if isinstance(key, str) else key).alias("key"), _text(text))
    signed = _written(_shingled(source, settings, sets=False), folder, "signed")
    classes = _written(
        signed.filter("class is not null").groupBy("class").agg(
            F.min("key").alias("class_key"), F.count("*").alias("copies"),
            F.first("signature").alias("signature"), F.first("size").alias("size"),
        ), folder, "classes",
    )
    # Subtrees of at least two classes, and the blocks of large ones.
    entries = classes.select("class", F.posexplode(_buckets(F.col("signature"), settings)).alias("tree", "bucket"))
    crowded = entries.groupBy("bucket").agg(F.count("*").alias("held")).filter("held > 1")
    blocks = F.ceil(F.col("held") / settings.block)
    block = F.pmod(F.xxhash64("class"), blocks).cast("int")
    members = entries.join(crowded, "bucket").select(
        "class", "tree", "bucket", block.alias("block"),
        F.explode(F.sequence(F.lit(0), (blocks - 1).cast("int"))).alias("other"),
    ).withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")}).drop("other")
    members = members.join(classes.select("class", "signature", "size"), "class")
    work = ("bucket", "low", "high")
    wanted = members.repartition(*work).sortWithinPartitions(*work).mapInArrow(
        lambda batches: _wanted(batches, settings),
        "bucket bigint, tree int, low int, high int, block int, class binary",
    )
    wanted = _written(wanted, folder, "wanted")

    # The shingles of the classes in question, made again from one text of each.
    asked = wanted.groupBy("class").agg(F.collect_list(
        F.struct("bucket", "tree", "low", "high", "block")  # at most one for each tree and block
    ).alias("places")).join(classes, "class")
    texts = source.join(
        asked.select(F.col("class_key"), F.col("class").alias("expected"), "copies", "signature", "places"),
        F.col("key").eqNullSafe(F.col("class_key")),
    )
    sets = _shingled(texts.drop("key", "class_key"), settings, sets=True)
    pieces = sets.select("class", "copies", "signature", "size", "shingles", F.inline("places"))
    links = _written(
        pieces.repartition(*work).sortWithinPartitions(*work).mapInArrow(
            lambda batches: _links(batches, settings), "class binary, links bigint, other binary"
        ), folder, "links",
    )
    counted = links.filter("other is null").groupBy("class").agg(F.sum("links").alias("links"))
    roots = components(links.filter("other is not null").select("class", "other"), "class", "other", folder)
    known = (
        classes.select("class", "class_key", "copies").join(counted, "class", "left")
        .join(roots.select(F.col("node").alias("class"), "root"), "class", "left")
        .withColumn("root", F.coalesce("root", "class"))
    )
    known = _written(known, folder, "known")
    heads = known.groupBy("root").agg(F.min("class_key").alias("group_key"))
    found = known.join(heads, "root").select(
        "class", "class_key", "group_key",
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
    )
    alone = F.col("class").isNull()
    return signed.join(found, "class", "left").select(
        "key", F.when(alone, F.col("key")).otherwise(F.col("class_key")).alias("class_key"),
        F.when(alone, F.col("key")).otherwise(F.col("group_key")).alias("group_key"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )


def deduplicated(
    docs: DataFrame, settings: JoinSettings = JoinSettings(), key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row of each group, that of the smallest key; all columns of the table."""
    names = [f"`{name}`" for name in docs.columns]
    mark = F.xxhash64(*map(F.col, names))
    # The content tells rows of one key apart; null keys come last.
    whole = F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("id"), mark.alias("mark"))
    kept = similar(docs, settings, whole, text).filter("key = group_key").select("key").distinct()
    rows = docs.select(whole.alias("__key"), F.struct(*names).alias("__row"))
    return rows.join(kept, rows["__key"] == kept["key"], "left_semi").dropDuplicates(["__key"]).select("__row.*")
