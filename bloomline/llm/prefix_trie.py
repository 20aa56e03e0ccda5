"""The trie of common beginnings of conversations, from ternary search trees over ranges of them."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from bloomline.llm import ragged
from bloomline.session import materialize

DIGEST = 16               # bytes that stand for a turn in a path
SHARD_BYTES = 4 << 20     # paths in one tree
LEAST_SHARDS = 8
LAST_BYTES = 64 << 20     # paths of boundary nodes that one task may merge; more are merged by ranges first
ROOT_KEY = bytes(DIGEST)
NO_CONV = np.iinfo(np.int64).max


def encode_turns(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Every turn's place in its conversation (from 1), the digest of role and text, and the text's bytes.

    Turns are ordered by ``turn``, null first, then role and text; a null role or
    text is empty; equal rows are turns of their own; rows without a conversation
    are left out. Texts are shuffled once and don't go further.
    """
    word = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    chosen = conversations.select(F.col(conv).cast("long").alias("conv_id"), F.col(turn).alias("turn"), word(role).alias("role"),
                                  word(text).alias("text")).where("conv_id IS NOT NULL")
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    named = F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text")
    return chosen.select("conv_id", F.row_number().over(order).alias("pos"),
                         F.substring(F.sha2(named.cast("binary"), 256), 1, 2 * DIGEST).alias("digest"),
                         F.octet_length("text").cast("long").alias("size"))


def head_turns(conv: Column) -> Column:
    """Turns that a conversation takes from the first one of its group of five: crc32 of the decimal number, modulo 9."""
    return F.crc32(conv.cast("string").cast("binary")) % 9


def own_sequences(turns: DataFrame) -> DataFrame:
    """One row per conversation: conv_id and its turns (pos, digest, size) in order."""
    return turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("pos", "digest", "size"))).alias("turns"))


def shared_sequences(turns: DataFrame) -> DataFrame:
    """Conversations whose first ``head_turns`` turns are replaced by those of conversation c - c mod 5, as far as it has them.

    At most five conversations share a head of at most eight turns, so the join has no hot key.
    """
    item = F.struct("pos", "digest", "size")
    listed = lambda condition: F.sort_array(F.collect_list(F.when(condition, item)))
    own = turns.groupBy("conv_id").agg(listed(F.col("pos") > head_turns(F.col("conv_id"))).alias("own"))
    heads = turns.where((F.pmod("conv_id", F.lit(5)) == 0) & (F.col("pos") <= 8)).groupBy(F.col("conv_id").alias("base")).agg(
        listed(F.lit(True)).alias("head"))
    joined = own.withColumn("base", F.col("conv_id") - F.pmod("conv_id", F.lit(5))).join(heads, "base", "left")
    head = F.filter("head", lambda t: t["pos"] <= head_turns(F.col("conv_id")))
    return joined.select("conv_id", F.when(F.col("head").isNull(), F.col("own")).otherwise(F.concat(head, "own")).alias("turns"))


class SearchTree:
    """Ternary search tree over sequences of turn numbers; node 0 is the empty sequence.

    Node i stands for the sequence that ends with ``turn[i]`` below ``parent[i]``;
    ``lower`` and ``higher`` lead to its siblings, ``inner`` to its continuations.
    """

    def __init__(self) -> None:
        self.turn, self.parent, self.depth = [-1], [-1], [0]
        self.lower, self.inner, self.higher = [-1], [-1], [-1]

    def _new(self, turn: int, parent: int) -> int:
        for column, value in ((self.turn, turn), (self.parent, parent), (self.depth, self.depth[parent] + 1),
                              (self.lower, -1), (self.inner, -1), (self.higher, -1)):
            column.append(value)
        return len(self.turn) - 1

    def insert(self, sequence: list[int]) -> list[int]:
        """Nodes of all beginnings of a sequence, the empty one first."""
        at, nodes = 0, [0]
        for turn in sequence:
            child = self.inner[at]
            if child < 0:
                child = self.inner[at] = self._new(turn, at)
            while self.turn[child] != turn:
                links = self.lower if turn < self.turn[child] else self.higher
                if links[child] < 0:
                    links[child] = self._new(turn, at)
                child = links[child]
            at = child
            nodes.append(at)
        return nodes

    def preorder(self) -> list[int]:
        """All nodes, each after its parent."""
        order, stack = [], [0]
        while stack:
            node = stack.pop()
            order.append(node)
            stack += [n for n in (self.lower[node], self.higher[node], self.inner[node]) if n >= 0]
        return order


def medians(n: int) -> Iterator[int]:
    """0 to n - 1, the middle of each range before its halves, so that sorted sequences make balanced trees."""
    stack = [(0, n)]
    while stack:
        low, high = stack.pop()
        if low < high:
            middle = (low + high) // 2
            yield middle
            stack += [(middle + 1, high), (low, middle)]


#: Values of a node that add up, or whose least counts: members that are in no node handed on below it, the smallest of its
#: members, finished children, and the finished children's leaves and savings.
VALUES = ["ends", "conv", "kids", "leaves", "saved"]
RECORD = "path binary, sizes array<long>, at array<int>, " + ", ".join(f"{v} array<long>" for v in VALUES)
NODE = ("key binary, parent binary, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
        "saved_tokens long")


def tree_nodes(table: pa.Table, last: bool) -> tuple[list[dict], list[dict]]:
    """Nodes of one range of paths: finished ones, and records of those that other ranges may have too.

    ``table`` has the range's records by path. All sequences that begin alike
    are neighbours, so only beginnings of the first and of the last path can be
    in another range; in the ``last`` merge none is.
    """
    paths = table["path"].to_pylist()
    if not paths:
        return [], []
    flat = np.frombuffer(b"".join(paths), dtype=f"V{DIGEST}") if any(paths) else np.zeros(0, f"V{DIGEST}")
    digests, numbers = ragged.dictionary(pa.Array.from_buffers(pa.binary(DIGEST), len(flat), [None, pa.py_buffer(flat.tobytes())]))
    # Turn numbers in the digests' own order, which is the paths'.
    names = digests.to_pylist()
    ordered = sorted(range(len(names)), key=names.__getitem__)
    rank = np.empty(len(names), np.int64)
    rank[ordered] = np.arange(len(names))
    names = [names[i] for i in ordered]
    turns = rank[numbers].tolist()
    stops = np.cumsum([len(p) // DIGEST for p in paths]).tolist()
    starts = [0, *stops[:-1]]

    tree, nodes_of = SearchTree(), {}
    sizes_of = table["sizes"].to_pylist()
    marks = {v: table[v].to_pylist() for v in ("at", *VALUES)}
    sums = {v: [0] for v in VALUES}
    sums["conv"] = [NO_CONV]
    size = [0]
    ends = {0, len(paths) - 1}
    for row in medians(len(paths)):
        nodes = tree.insert(turns[starts[row]:stops[row]])
        for _ in range(len(tree.turn) - len(size)):
            size.append(0)
            for v in VALUES:
                sums[v].append(NO_CONV if v == "conv" else 0)
        for node, n in zip(nodes[1:], sizes_of[row]):
            size[node] = n
        for i, depth in enumerate(marks["at"][row]):
            node = nodes[depth]
            for v in VALUES:
                value = marks[v][row][i]
                sums[v][node] = min(sums[v][node], value) if v == "conv" else sums[v][node] + value
        if row in ends:
            nodes_of[row] = nodes
    shared = set() if last else {n for nodes in nodes_of.values() for n in nodes}

    order = tree.preorder()
    members, conv, kids, leaves, saved = (list(sums[v]) for v in VALUES)
    handed = [0] * len(order)  # members in children that are handed on
    for node in reversed(order):
        if node not in shared:
            if not kids[node]:
                leaves[node] = 1
            saved[node] += (members[node] - 1) * size[node]
        up = tree.parent[node]
        if up >= 0:
            members[up] += members[node]
            conv[up] = min(conv[up], conv[node])
            if node in shared:
                handed[up] += members[node]
            else:
                kids[up] += 1
                leaves[up] += leaves[node]
                saved[up] += saved[node]

    key = [ROOT_KEY] * len(order)
    for node in order[1:]:
        key[node] = hashlib.sha256(key[tree.parent[node]] + names[tree.turn[node]]).digest()[:DIGEST]
    finished = []
    for node in order:
        if node not in shared:
            up = tree.parent[node]
            finished.append({
                "key": key[node], "parent": key[up] if up >= 0 else None, "depth": tree.depth[node], "conv_id": conv[node],
                "parent_conv_id": conv[up] if up >= 0 and up not in shared else None, "n_convs": members[node], "n_children": kids[node],
                "n_leaves": leaves[node], "saved_tokens": saved[node]})
    records, told = [], set()
    for row in sorted(nodes_of) if not last else []:
        listed = [(d, n) for d, n in enumerate(nodes_of[row]) if n not in told]
        told.update(n for _, n in listed)
        records.append({
            "path": paths[row], "sizes": sizes_of[row], "at": [d for d, _ in listed], "ends": [members[n] - handed[n] for _, n in listed],
            "conv": [conv[n] for _, n in listed], "kids": [kids[n] for _, n in listed], "leaves": [leaves[n] for _, n in listed],
            "saved": [saved[n] for _, n in listed]})
    return finished, records


LONGS = pa.list_(pa.int64())
RECORD_TYPE = pa.schema([("path", pa.binary()), ("sizes", LONGS), ("at", pa.list_(pa.int32())), *[(v, LONGS) for v in VALUES]])
NODE_TYPE = pa.schema([("key", pa.binary()), ("parent", pa.binary()), *[(c.split()[0], pa.int64()) for c in NODE.split(", ")[2:]]])


def merge_ranges(records: DataFrame, last: bool) -> DataFrame:
    """Trees of the frame's partitions, which are ranges of paths in order: rows of a node, or of a record to merge further."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        finished, left = tree_nodes(pa.Table.from_batches(held), last)
        nodes, rest = pa.Table.from_pylist(finished, NODE_TYPE), pa.Table.from_pylist(left, RECORD_TYPE)
        blank = lambda fields, n: [pa.nulls(n, f.type) for f in fields]
        whole = pa.schema([*NODE_TYPE, *RECORD_TYPE])
        yield from pa.Table.from_arrays([*nodes.columns, *blank(RECORD_TYPE, len(nodes))], schema=whole).to_batches(max_chunksize=10_000)
        yield from pa.Table.from_arrays([*blank(NODE_TYPE, len(rest)), *rest.columns], schema=whole).to_batches()

    return records.sortWithinPartitions("path").mapInArrow(build, f"{NODE}, {RECORD}")


def prefix_trie(sequences: DataFrame, shard_bytes: int = SHARD_BYTES, last_bytes: int = LAST_BYTES) -> DataFrame:
    """Nodes of the trie of conversations' beginnings: key, conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256.

    ``sequences`` has conv_id and turns (digest, size), a row per conversation;
    equal ones are members of the same nodes, one without turns only of the root.
    ``key`` names the node, ``conv_id`` its smallest member, ``parent_conv_id``
    that of its parent. ``saved_tokens`` sums, over the node and all below it,
    the bytes of a node's last text times its members but one. ``ends_sha256`` is
    the SHA-256 of the decimal numbers, ascending and joined by commas, of the
    members that end there. An empty table gives no node.

    Equal sequences are folded first, so that copies cost one row. Sorted ranges
    of about ``shard_bytes`` become search trees; nodes that a neighbouring range
    may have too go on to a merge of the same kind, by wider ranges, until they
    fit into ``last_bytes`` or are few. A conversation's digests are one row: 24 bytes a turn.
    """
    path = F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), ""))
    paths = materialize(sequences.select("conv_id", path.alias("path"), F.transform("turns", lambda t: t["size"]).alias("sizes")), "paths")
    records = paths.groupBy("path").agg(F.first("sizes").alias("sizes"), F.count("*").alias("n"), F.min("conv_id").alias("c"))
    none = F.array(F.lit(0).cast("long"))
    one = lambda c: F.array(c)
    records = materialize(records.select("path", "sizes", one((F.octet_length("path") / DIGEST).cast("int")).alias("at"), one("n").alias("ends"),
                                         one("c").alias("conv"), none.alias("kids"), none.alias("leaves"), none.alias("saved")), "records")
    finished = []
    columns = [c.split()[0] for c in NODE.split(", ")]
    while True:
        count, size = records.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("path").cast("long") + 64), F.lit(0))).first()
        last = bool(finished) and (size <= last_bytes or count <= 4 * LEAST_SHARDS)
        if last:
            ranges = records.coalesce(1)
        else:
            # Two records at most come out of a range, so that their number falls whatever their length.
            ranges = records.repartitionByRange(max(LEAST_SHARDS, min(-(-size // shard_bytes), count // 8)), "path")
        built = materialize(merge_ranges(ranges, last), "trie")
        finished.append(built.where("key IS NOT NULL").select(*columns))
        if last:
            break
        records = built.where("key IS NULL").select(*records.columns)
    nodes = finished[0]
    for more in finished[1:]:
        nodes = nodes.unionByName(more)
    # Parents that were finished in a later merge than their children.
    late = finished[1]
    for more in finished[2:]:
        late = late.unionByName(more)
    open_parent = (F.col("depth") > 0) & F.col("parent_conv_id").isNull()
    salts = 16
    found = late.select(F.col("key").alias("parent"), F.col("conv_id").alias("found"), F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    settled = nodes.where(open_parent).withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(salts)).cast("int")).join(found, ["parent", "salt"])
    nodes = nodes.where(~open_parent).unionByName(settled.withColumn("parent_conv_id", F.col("found")).select(*columns))
    empty = F.sha2(F.lit("").cast("binary"), 256)
    return nodes.join(end_members(paths), "key", "left").select(
        F.hex("key").alias("key"), "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", empty).alias("ends_sha256"))


def end_members(paths: DataFrame) -> DataFrame:
    """(key, ends_sha256) of every node where conversations end.

    A node's members are hashed in ascending order as they stream through its
    partition: a hash is sequential by nature, but no list of them is held.
    """
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, None

        def done() -> pa.RecordBatch:
            key = ROOT_KEY
            for i in range(0, len(current), DIGEST):
                key = hashlib.sha256(key + current[i:i + DIGEST]).digest()[:DIGEST]
            return pa.RecordBatch.from_arrays([pa.array([key]), pa.array([state.hexdigest()])], names=["key", "ends_sha256"])

        for batch in batches:
            for path, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if path == current:
                    state.update(b",%d" % conv)
                else:
                    if state is not None:
                        yield done()
                    current, state = path, hashlib.sha256(b"%d" % conv)
        if state is not None:
            yield done()

    return (paths.select("path", "conv_id").repartition("path").sortWithinPartitions("path", "conv_id")
            .mapInArrow(digest, "key binary, ends_sha256 string"))


#: The same in SQL: checksum bit by bit, beginnings as lists, savings and leaves summed over all beginnings of a node.
SQL = """
WITH RECURSIVE ordered AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos,
         {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS item
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT DISTINCT conv_id FROM ordered),
crc(conv_id, digits, place, bit, value) AS (
  SELECT conv_id, CAST(conv_id AS VARCHAR), 1, 8, CAST(4294967295 AS BIGINT) FROM ids
  UNION ALL
  SELECT conv_id, digits, CASE bit WHEN 8 THEN place ELSE place + CASE bit WHEN 7 THEN 1 ELSE 0 END END, CASE bit WHEN 8 THEN 0 WHEN 7 THEN 8 ELSE bit + 1 END,
         CASE bit WHEN 8 THEN xor(value, CAST(ascii(substr(digits, place, 1)) AS BIGINT))
         ELSE CASE value & 1 WHEN 1 THEN xor(value >> 1, CAST(3988292384 AS BIGINT)) ELSE value >> 1 END END
  FROM crc WHERE place <= length(digits)),
heads AS (SELECT conv_id, CAST(xor(value, CAST(4294967295 AS BIGINT)) % 9 AS INTEGER) AS h FROM crc WHERE place > length(digits)),
lists AS (SELECT conv_id, list(item ORDER BY pos) AS items FROM ordered GROUP BY conv_id),
built AS (
  SELECT l.conv_id, list_concat(coalesce(b.items[1:h], []), l.items[h + 1:]) AS items
  FROM lists AS l JOIN heads USING (conv_id) LEFT JOIN lists AS b ON b.conv_id = l.conv_id - l.conv_id % 5),
begun AS (SELECT conv_id, items[1:d] AS node, d, d = len(items) AS is_end FROM (SELECT conv_id, items, unnest(range(0, len(items) + 1)) AS d FROM built)),
nodes AS (
  SELECT node, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE is_end), '')) AS ends_sha256
  FROM begun GROUP BY node),
children AS (SELECT node[1:depth - 1] AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
counted AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes AS n LEFT JOIN children AS c ON c.node = n.node),
above AS (
  SELECT node[1:up] AS node, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves,
         sum(CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * octet_length(encode(node[depth].text)) END) AS saved_tokens
  FROM (SELECT *, unnest(range(0, depth + 1)) AS up FROM counted) GROUP BY 1)
SELECT c.conv_id, CAST(c.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children,
       CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, c.ends_sha256
FROM counted AS c JOIN above AS a ON a.node = c.node LEFT JOIN counted AS p ON c.depth > 0 AND p.node = c.node[1:c.depth - 1]
"""
