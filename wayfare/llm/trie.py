"""The trie of the turns that conversations share, from sorted shards and a skeleton."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.session import written

#: Characters of a turn in a path: 32 of its digest, 8 of its length.
TOKEN = 40
#: SHA-256 of nothing.
NO_ENDS = hashlib.sha256(b"").hexdigest()
_NODES = (
    "node binary, parent binary, depth bigint, token string, conv_id bigint, n_convs bigint, "
    "n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string, above array<binary>"
)


def turn_token(role: Column, text: Column) -> Column:
    """A turn as ``TOKEN`` characters: of role and text a digest, and the text's length.

    Turns of equal role and text, null counting as empty, have equal tokens.
    """
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    return F.concat(F.left(digest, F.lit(32)), F.lower(F.lpad(F.hex(F.length(text)), 8, "0")))


def sequences(turns: DataFrame, key: str = "conv_id", order: str = "turn") -> DataFrame:
    """``conv_id`` and its ``tokens`` along ``order``, nulls first, ties by token.

    Texts become tokens before they are shuffled. A conversation of any number of turns
    is one row of ``TOKEN`` bytes a turn. Rows without a key belong to no conversation.
    """
    token = turn_token(F.col("role"), F.col("text"))
    said = turns.where(F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("conv_id"), F.col(order).alias("at"), token.alias("token")
    )
    held = F.sort_array(F.collect_list(F.struct("at", "token")))
    return said.groupBy("conv_id").agg(F.transform(held, lambda t: t["token"]).alias("tokens"))


def branched(own: DataFrame, block: int = 100, most: int = 6) -> DataFrame:
    """Conversations that begin like the first of their block.

    The first ``h`` turns are those of conversation ``c - c % block``, ``h`` being the
    CRC-32 of the decimal ``c`` modulo ``most``: all of its turns if it has fewer,
    none if there is no such conversation. Then come the own turns after the first ``h``.
    """
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    starts = own.where(F.col("conv_id") % block == 0).select(
        F.col("conv_id").alias("base"), F.slice("tokens", 1, most - 1).alias("start")
    )
    none = F.array().cast("array<string>")
    return (
        own.withColumns({"h": h, "base": F.col("conv_id") - F.col("conv_id") % block})
        .join(starts, "base", "left")
        .select(
            "conv_id",
            F.concat(
                F.slice(F.coalesce("start", none), F.lit(1), F.col("h")),
                F.slice("tokens", F.col("h") + 1, F.greatest(F.size("tokens") - F.col("h"), F.lit(0))),
            ).alias("tokens"),
        )
    )


def endings(paths: DataFrame) -> DataFrame:
    """One row per distinct path: how many conversations are it, the least, and their digest.

    Ids are joined in runs of at most 1024 first, so copies of a conversation
    are split over tasks; a digest is made of the runs in order, one at a time.
    """
    runs = paths.groupBy(F.unhex(F.md5("path")).alias("said"), F.shiftright("conv_id", 10).alias("run")).agg(
        F.sort_array(F.collect_list("conv_id")).alias("ids")
    )
    runs = runs.select(
        "said", "run", F.size("ids").alias("n"), F.get("ids", 0).alias("least"), F.array_join("ids", ",").alias("ids")
    )

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, n, least, sha, done = None, 0, 0, None, []

        def batch() -> pa.RecordBatch:
            columns = list(zip(*done)) or [[], [], []]
            kinds = (pa.int64(), pa.int64(), pa.string())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["least", "n", "ends_sha256"]
            )

        for part in batches:
            for said, count, first, ids in zip(*[part[c].to_pylist() for c in ("said", "n", "least", "ids")]):
                if said != now:
                    if now is not None:
                        done.append((least, n, sha.hexdigest()))
                    now, n, least, sha = said, 0, first, hashlib.sha256()
                sha.update(f",{ids}".encode() if n else ids.encode())
                n += count
            yield batch()
            done = []
        if now is not None:
            done.append((least, n, sha.hexdigest()))
        yield batch()

    return (
        runs.repartition("said")
        .sortWithinPartitions("said", "run")
        .mapInArrow(digests, "least bigint, n bigint, ends_sha256 string")
    )


def _step(parent: bytes, token: str) -> bytes:
    """The id of a node from its parent's; the root's is empty."""
    return hashlib.blake2b(parent + token.encode(), digest_size=16).digest()


def skeleton(splitters: list[str]) -> frozenset[bytes]:
    """The ids of all nodes on the ways to the splitters, the root with them."""
    found = {b""}
    for path in splitters:
        node = b""
        for at in range(0, len(path), TOKEN):
            node = _step(node, path[at : at + TOKEN])
            found.add(node)
    return frozenset(found)


class _Open:
    """A node whose subtree is being read."""

    __slots__ = ("children", "ends", "least", "leaves", "n", "node", "saved", "token")

    def __init__(self, node: bytes, token: str):
        self.node, self.token = node, token
        self.n = self.children = self.leaves = self.saved = 0
        self.least, self.ends = None, None


class _Shard:
    """Walks sorted distinct paths; holds the nodes of one path only."""

    def __init__(self, shared: frozenset[bytes]):
        self.shared = shared
        self.way: list[_Open] = []
        self.done: list[tuple] = []

    def add(self, path: str, n: int, least: int, ends: str) -> None:
        tokens = [path[at : at + TOKEN] for at in range(0, len(path), TOKEN)]
        if not self.way:
            self.way.append(_Open(b"", ""))
        same = 0
        for token, held in zip(tokens, self.way[1:]):
            if token != held.token:
                break
            same += 1
        self.close(same + 1)
        for token in tokens[same:]:
            self.way.append(_Open(_step(self.way[-1].node, token), token))
        last = self.way[-1]
        last.n, last.least, last.ends = n, least, ends

    def close(self, keep: int) -> None:
        """Finish all nodes beyond the first ``keep`` of the way."""
        while len(self.way) > keep:
            node = self.way.pop()
            above = self.way[-1] if self.way else None
            local = node.node not in self.shared
            if local:
                node.leaves += not node.children
                node.saved += (node.n - 1) * int(node.token[-8:], 16)
            self.done.append(
                (
                    node.node,
                    above.node if above else None,
                    len(self.way),
                    node.token,
                    node.least,
                    node.n,
                    node.children,
                    node.leaves,
                    node.saved,
                    node.ends,
                    None if local else [*[a.node for a in self.way], node.node],
                )
            )
            if above:
                above.n += node.n
                above.least = node.least if above.least is None else min(above.least, node.least)
                if local:
                    above.children += 1
                    above.leaves += node.leaves
                    above.saved += node.saved

    def batch(self) -> pa.RecordBatch:
        kinds = (
            pa.binary(), pa.binary(), pa.int64(), pa.string(), pa.int64(), pa.int64(),
            pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.binary()),
        )
        columns = list(zip(*self.done)) or [[] for _ in kinds]
        self.done = []
        names = [field.split()[0] for field in _NODES.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _walked(sharded: DataFrame, shared: frozenset[bytes]) -> DataFrame:
    """Finished nodes, and of shared ones what each shard has seen (``above`` is set)."""
    held = sharded.sparkSession.sparkContext.broadcast(shared)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk, now = _Shard(held.value), None
        for part in batches:
            columns = [part[c].to_pylist() for c in ("shard", "path", "n", "least", "ends_sha256")]
            for shard, *path in zip(*columns):
                if shard != now:
                    walk.close(0)
                    now = shard
                walk.add(*path)
                if len(walk.done) >= 10_000:
                    yield walk.batch()
        walk.close(0)
        yield walk.batch()

    return sharded.repartition("shard").sortWithinPartitions("shard", "path").mapInArrow(rows, _NODES)


def _reduced(seen: DataFrame) -> DataFrame:
    """The shared nodes, from what the shards have seen of them.

    Each gives what it has itself to all nodes above it; there are at most
    as many shared nodes as splitters times their depth.
    """
    whole = seen.groupBy("node", "parent", "depth", "token", "above").agg(
        F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.max("ends_sha256").alias("ends_sha256"),
    )
    below = whole.groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("shared_children"))
    chars = F.coalesce(F.conv(F.right("token", F.lit(8)), 16, 10).cast("long"), F.lit(0))
    whole = whole.join(below, "node", "left").withColumns(
        {
            "n_children": F.col("n_children") + F.coalesce("shared_children", F.lit(0)),
            "saved_tokens": F.col("saved_tokens") + (F.col("n_convs") - 1) * chars,
        }
    )
    whole = whole.withColumn("n_leaves", F.col("n_leaves") + F.when(F.col("n_children") == 0, 1).otherwise(0))
    sums = whole.select(F.explode("above").alias("node"), "n_leaves", "saved_tokens")
    sums = sums.groupBy("node").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    return whole.drop("n_leaves", "saved_tokens").join(sums, "node")


def prefix_trie(seqs: DataFrame, shards: int | None = None, depth: int = 32) -> DataFrame:
    """One row per distinct sequence of first turns: a node of the trie.

    ``seqs`` has one row per ``conv_id`` (a long) with its ``tokens`` (see `turn_token`). Rows:
    ``node`` and ``parent``, 16-byte ids (the root's is empty and it has no parent),
    ``depth``, ``token`` of the last turn, ``conv_id`` the least member, ``parent_conv_id``
    that of the parent, ``n_convs`` the members, ``n_children``, ``n_leaves``
    below or at the node, ``saved_tokens`` the characters that members share, summed over
    the subtree, and ``ends_sha256``, the SHA-256 of the ids that end there.

    Equal conversations become one path. Paths are range-partitioned by their first
    ``depth`` turns. A node that two shards have lies on the way to the first path
    of a later one, a splitter; the trie of the splitters is broadcast, at most ``shards
    * depth`` ids of 16 bytes, whatever the number and length of conversations. Each shard is
    read in order and holds one path; it finishes all nodes that are not in that trie, and what
    shards have seen of the others is added up. ``shards`` is the session's number of
    shuffle partitions by default; a ``depth``-long start that most conversations share
    is one shard, read in a stream.

    A conversation of no turns is a member of the root. No conversations, no rows.
    """
    paths = written(seqs.select("conv_id", F.array_join("tokens", "").alias("path")), "paths")
    ends = endings(paths)
    distinct = paths.join(ends, F.col("conv_id") == F.col("least")).select("path", "n", "least", "ends_sha256")
    start = F.left("path", F.lit(TOKEN * depth))
    cut = distinct.repartitionByRange(shards, start) if shards else distinct.repartitionByRange(start)
    sharded = written(cut.withColumn("shard", F.spark_partition_id()), "shards")
    # One row per shard, of a bounded length each.
    firsts = sharded.groupBy("shard").agg(F.min(start).alias("first")).orderBy("shard").collect()
    seen = written(_walked(sharded, skeleton([row["first"] for row in firsts[1:]])), "nodes")
    nodes = seen.where("above IS NULL").drop("above")
    shared = _reduced(seen.where("above IS NOT NULL"))
    nodes = nodes.unionByName(shared.select(nodes.columns))
    parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return nodes.join(parents, "parent", "left").withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.lit(NO_ENDS))
    )


def with_turns(nodes: DataFrame, turns: DataFrame) -> DataFrame:
    """``role`` and ``text`` of each node's last turn, each shared turn once; null at the root.

    Nulls of the turns are empty, as in their tokens.
    """
    said = turns.select(
        turn_token(F.col("role"), F.col("text")).alias("token"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    return nodes.join(said.dropDuplicates(["token"]), "token", "left")
