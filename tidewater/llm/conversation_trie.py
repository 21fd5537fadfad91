"""Prefix trie of conversations in balanced parentheses.

Every conversation is a sequence of turns; conversations that begin with the
same turns share the nodes of those turns.  The trie is never built as objects:

1. Each conversation becomes one row with a 16-byte digest and the code points
   of each turn (texts stay behind).  The rows are range-partitioned and sorted by
   (digests, id), so a node's conversations are neighbours, and a conversation
   that a third of all rows repeat spans many shards.
2. One task takes one shard.  From the longest common prefixes of neighbours it
   writes the shard's trie as balanced parentheses (`Parens`): one bit for each
   opening and closing, with a range min-max tree over blocks of excess.
   `find_close` delimits subtrees, the rank of the pair "()" counts leaves, and
   cumulative arrays over the preorder give members and savings of any subtree.
3. Only nodes on the paths of a shard's first and last conversation (its spine)
   can go on in a neighbouring shard.  They leave the shard with the sums of what
   hangs beside the spine, are merged by node, and form one small trie in
   parentheses again: at most two paths for each shard.  All other nodes are
   final where they are.

Defined results: turns are ordered by turn (null first), equal turns by role and
text digest; null role or text is empty; rows without a conversation id are left
out; a repeated row is a repeated turn; an empty table has no root and gives an
empty table; other columns are ignored.  A conversation of n turns is one row of
20 n bytes, whatever its texts hold.  The digest of the ids that end at a node is
fed in order, shard by shard, so no list of them is held as a whole.
"""

from __future__ import annotations

import hashlib
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import saved

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK = 256  # parentheses of one block of the range min-max tree
DIGEST = 16  # bytes of a turn's digest
ROOT = b"\0" * DIGEST


class Parens:
    """A forest in balanced parentheses, made from the depths of its preorder."""

    def __init__(self, depths: np.ndarray):
        depths = depths.astype(np.int64)
        n = len(depths)
        closes = np.empty(n, np.int64)  # behind each opening: up to the next node's depth
        closes[:-1] = depths[:-1] - depths[1:] + 1
        closes[-1:] = depths[-1:] - (depths.min() if n else 0) + 1
        self.opens = np.arange(n) + np.concatenate([[0], np.cumsum(closes)[:-1]]) if n else np.zeros(0, np.int64)
        self.bits = np.zeros(2 * n, bool)
        self.bits[self.opens] = True
        self.excess = np.cumsum(np.where(self.bits, 1, -1))
        # block minima and maxima, and a binary tree over them
        blocks = max(1, -(-2 * n // BLOCK))
        self.leaves = 1 << (blocks - 1).bit_length()
        low, high = (np.full(2 * self.leaves, x, np.int64) for x in (np.iinfo(np.int64).max, np.iinfo(np.int64).min))
        if n:
            cuts = np.arange(0, 2 * n, BLOCK)
            low[self.leaves:self.leaves + blocks] = np.minimum.reduceat(self.excess, cuts)
            high[self.leaves:self.leaves + blocks] = np.maximum.reduceat(self.excess, cuts)
        at = self.leaves
        while at > 1:
            low[at // 2:at] = np.minimum(low[at:2 * at:2], low[at + 1:2 * at:2])
            high[at // 2:at] = np.maximum(high[at:2 * at:2], high[at + 1:2 * at:2])
            at //= 2
        self.low, self.high = low, high
        pairs = np.zeros(2 * n, np.int64)  # rank of "()" up to each place
        pairs[1:] = self.bits[:-1] & ~self.bits[1:]
        self.pairs = np.cumsum(pairs)

    def _scan(self, at: np.ndarray, target: np.ndarray, out: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Look for `target` from `at` to the end of its block; the rows without one."""
        left = rows
        end = np.minimum((at // BLOCK + 1) * BLOCK, len(self.excess))
        while len(left):
            left = left[at[left] < end[left]]
            hit = self.excess[at[left]] == target[left]
            out[left[hit]] = at[left[hit]]
            left = left[~hit]
            at[left] += 1
        return rows[out[rows] < 0]

    def find_close(self, opens: np.ndarray) -> np.ndarray:
        """The place of the closing parenthesis of each opening one."""
        out = np.full(len(opens), -1, np.int64)
        target = self.excess[opens] - 1
        at = opens + 1
        rest = self._scan(at, target, out, np.arange(len(opens)))
        # up the tree until a right neighbour's range holds the target, then down to its first block
        node = self.leaves + opens[rest] // BLOCK
        goal = target[rest]
        going = np.ones(len(rest), bool)
        while going.any():
            left_child = going & (node % 2 == 0)
            here = left_child.copy()
            here[left_child] = self._holds(node[left_child] + 1, goal[left_child])
            node = np.where(here, node + 1, np.where(going, node // 2, node))
            going &= ~here
        down = node < self.leaves
        while down.any():
            child = 2 * node[down]
            node[down] = np.where(self._holds(child, goal[down]), child, child + 1)
            down = node < self.leaves
        at[rest] = (node - self.leaves) * BLOCK
        self._scan(at, target, out, rest)
        return out

    def _holds(self, node: np.ndarray, goal: np.ndarray) -> np.ndarray:
        return (self.low[node] <= goal) & (goal <= self.high[node])

    def subtrees(self) -> tuple[np.ndarray, np.ndarray]:
        """For each node in preorder: the preorder number behind its subtree, and its leaves."""
        close = self.find_close(self.opens)
        after = np.arange(len(close)) + (close - self.opens + 1) // 2
        return after, self.pairs[close] - self.pairs[self.opens]


def _parents(depths: np.ndarray) -> np.ndarray:
    """Preorder number of each node's parent (-1: none): the last node before it one depth higher."""
    n = len(depths)
    keys = depths.astype(np.int64) * n + np.arange(n)
    order = np.sort(keys)
    up = np.searchsorted(order, keys - n) - 1
    found = order[np.maximum(up, 0)]
    return np.where((up >= 0) & (found // max(n, 1) == depths - 1), found % max(n, 1), -1)


def _sums(values: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Sum of `values` over each subtree, from one cumulative array."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[after] - total[np.arange(len(after))]


# --- a shard ---------------------------------------------------------------------
NODES = ("shard int, edge long, node binary, parent binary, depth long, chars long, conv_id long, parent_conv_id long, "
         "n_convs long, n_children long, n_leaves long, saved_tokens long, ends binary, ends_sha256 string")


def _decimal(ids: np.ndarray) -> bytes:
    return ",".join(map(str, ids.tolist())).encode()


def _shard_nodes(shard: int, ids: np.ndarray, offsets: np.ndarray, digests: np.ndarray, chars: np.ndarray):
    """Rows of `NODES` of a shard's sorted conversations.  `digests` (turns x 2
    numbers) and `chars` hold conversation i at offsets[i]:offsets[i + 1]."""
    n = len(ids)
    depth = np.diff(offsets)
    # longest common prefix with the conversation before
    turn = np.arange(len(chars)) - np.repeat(offsets[:-1], depth)
    row = np.repeat(np.arange(n), depth)
    has = (row > 0) & (turn < np.concatenate([[0], depth[:-1]])[row])
    before = np.where(has, np.concatenate([[0], offsets[:-2]])[row] + turn, 0)
    equal = has & (digests == digests[before]).all(axis=1) if len(chars) else has
    stop = np.where(equal, np.iinfo(np.int64).max, turn)
    lcp = depth.copy()
    full = depth > 0
    lcp[full] = np.minimum(np.minimum.reduceat(stop, offsets[:-1][full]), depth[full])
    # nodes in preorder: the root, then each conversation's turns behind its common prefix
    new = turn >= lcp[row]
    depths = np.concatenate([[0], turn[new] + 1])
    first = np.concatenate([[0], row[new]])  # the first conversation of each node
    lengths = np.concatenate([[0], chars[new]])
    trie = Parens(depths)
    after, leaves = trie.subtrees()
    parent = _parents(depths)
    # sorted rows end at the last node made so far: a row without new turns repeats the row before
    ends_at = np.cumsum(np.bincount(row[new], minlength=n))
    ending = np.bincount(ends_at, minlength=len(depths))
    convs = _sums(ending, after)
    last = first + convs  # members are neighbours
    bounds = np.empty(2 * len(depths), np.int64)
    bounds[::2], bounds[1::2] = first, last
    low = np.minimum.reduceat(np.append(ids, np.iinfo(np.int64).max), bounds)[::2]
    own = (convs - 1) * lengths
    # the spine: the first and the last conversation's path
    edge = np.full(len(depths), -1, np.int64)
    for side, leaf in ((1, ends_at[-1]), (0, ends_at[0])):
        while leaf >= 0:
            edge[leaf] = 2 * shard + side
            leaf = parent[leaf]
    spine = edge >= 0
    beside = ~spine
    children = np.bincount(parent[1:], minlength=len(depths))
    # sums of a spine node: only what hangs beside the spine, under it and not under a later spine node
    leaf_beside = beside & (children == 0)
    hang_leaves, hang_saved = _sums(leaf_beside, after), _sums(np.where(beside, own, 0), after)
    hang_children = np.bincount(parent[1:][beside[1:]], minlength=len(depths))
    on = np.flatnonzero(spine[1:]) + 1
    np.subtract.at(hang_leaves, parent[on], _sums(leaf_beside, after)[on])
    np.subtract.at(hang_saved, parent[on], _sums(np.where(beside, own, 0), after)[on])
    n_leaves = np.where(spine, hang_leaves, leaves)
    n_saved = np.where(spine, hang_saved, _sums(own, after))
    n_children = np.where(spine, hang_children, children)
    # names of spine nodes: a digest chained along the path
    names: dict[int, bytes] = {0: ROOT}
    turn_of = np.concatenate([[0], np.flatnonzero(new)])
    for v in on:
        names[v] = hashlib.blake2b(names[parent[v]] + digests[turn_of[v]].tobytes(), digest_size=DIGEST).digest()
    # conversations that end at a node are neighbours as well
    by_end = np.argsort(ends_at, kind="stable")
    cut = np.concatenate([[0], np.cumsum(ending)])
    nothing = hashlib.sha256(b"").hexdigest()
    for lo in range(0, len(depths), 65536):
        part = np.arange(lo, min(lo + 65536, len(depths)))
        up = parent[part]
        texts = [_decimal(ids[by_end[cut[v]:cut[v + 1]]]) if ending[v] else b"" for v in part]
        yield pa.RecordBatch.from_arrays([
            pa.array(np.full(len(part), shard), pa.int32()),
            pa.array(edge[part], mask=beside[part]),
            pa.array([names.get(v) for v in part], pa.binary()),
            pa.array([names.get(v) for v in up], pa.binary()),
            pa.array(depths[part]), pa.array(lengths[part]), pa.array(low[part]),
            pa.array(low[np.maximum(up, 0)], mask=(up < 0) | spine[np.maximum(up, 0)]),
            pa.array(convs[part]), pa.array(n_children[part]), pa.array(n_leaves[part]), pa.array(n_saved[part]),
            pa.array([t if s else None for t, s in zip(texts, spine[part])], pa.binary()),
            pa.array([None if s else (hashlib.sha256(t).hexdigest() if t else nothing)
                      for t, s in zip(texts, spine[part])], pa.string()),
        ], schema=_ARROW)


_ARROW = pa.schema([("shard", pa.int32()), ("edge", pa.int64()), ("node", pa.binary()), ("parent", pa.binary()),
                    *[(c, pa.int64()) for c in ("depth", "chars", "conv_id", "parent_conv_id", "n_convs", "n_children",
                                                "n_leaves", "saved_tokens")],
                    ("ends", pa.binary()), ("ends_sha256", pa.string())])


def _shards(batches):
    """A task's whole shard: ids, digests and lengths, 28 bytes for each conversation and turn."""
    ids, paths, chars, shard = [], [], [], None
    for b in batches:
        if not b.num_rows:
            continue
        shard = b["shard"][0].as_py()
        ids.append(b["conv_id"].to_numpy())
        paths.extend(b["path"].to_pylist())
        chars.append(b["chars"].flatten().to_numpy(zero_copy_only=False))
    if shard is None:
        return
    offsets = np.concatenate([[0], np.cumsum([len(p) // DIGEST for p in paths])]).astype(np.int64)
    digests = np.frombuffer(b"".join(paths), np.uint64).reshape(-1, 2)
    yield from _shard_nodes(shard, np.concatenate(ids), offsets, digests, np.concatenate(chars).astype(np.int64))


# --- merging the spines ------------------------------------------------------------
def _merge_spine(batches):
    """One task over the merged spine in preorder: subtree sums in parentheses again."""
    tables = [b for b in batches if b.num_rows]
    if not tables:
        return
    t = pa.Table.from_batches(tables)
    get = lambda c: t[c].to_numpy()
    depths, convs, chars = get("depth"), get("n_convs"), get("chars")
    after, _ = Parens(depths).subtrees()
    parent = _parents(depths)
    children = get("n_children") + np.bincount(parent[1:], minlength=len(depths))
    own = (convs - 1) * chars
    low = get("conv_id")
    yield pa.RecordBatch.from_arrays([
        t["node"].combine_chunks(), pa.array(low), pa.array(depths), pa.array(low[np.maximum(parent, 0)], mask=parent < 0),
        pa.array(convs), pa.array(children), pa.array(_sums(get("n_leaves") + (children == 0), after)),
        pa.array(_sums(get("saved_tokens") + own, after)),
    ], names=["node", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"])


def _digest_ends(batches):
    """Rows sorted by (node, edge): one running SHA-256 per node, fed in order."""
    node = running = None
    done = []
    for b in batches:
        for name, text in zip(b["node"].to_pylist(), b["ends"].to_pylist()):
            if name != node:
                if running is not None:
                    done.append((node, running.hexdigest()))
                node, running, begun = name, hashlib.sha256(), False
            if text:
                running.update(b"," + text if begun else text)
                begun = True
        if done:
            yield pa.RecordBatch.from_pylist([{"node": n, "ends_sha256": s} for n, s in done], _ENDS)
            done = []
    if running is not None:
        yield pa.RecordBatch.from_pylist([{"node": node, "ends_sha256": running.hexdigest()}], _ENDS)


_ENDS = pa.schema([("node", pa.binary()), ("ends_sha256", pa.string())])
OUTPUT = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def trie_nodes(sequences: DataFrame, partitions: int | None = None) -> DataFrame:
    """One row per node of the trie over `sequences` (conv_id, path: the turns'
    digests one behind the other, chars: code points of each turn)."""
    spark = sequences.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (sequences.repartitionByRange(n, "path", "conv_id").sortWithinPartitions("path", "conv_id")
               .select(F.spark_partition_id().alias("shard"), "conv_id", "path", "chars"))
    nodes = saved(ordered.mapInArrow(_shards, NODES), "trie-nodes")
    spine = nodes.where("edge is not null")
    merged = (spine.groupBy("node").agg(
        F.min("edge").alias("edge"), F.first("depth").alias("depth"), F.first("chars").alias("chars"),
        F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")])
        .repartition(1).sortWithinPartitions("edge", "depth"))
    merged = saved(merged.mapInArrow(_merge_spine, "node binary, conv_id long, depth long, parent_conv_id long, n_convs long, "
                                     "n_children long, n_leaves long, saved_tokens long"), "trie-spine")
    ends = (spine.select("node", "edge", "ends").repartition("node").sortWithinPartitions("node", "edge")
            .mapInArrow(_digest_ends, "node binary, ends_sha256 string"))
    top = merged.join(ends, "node").select(*OUTPUT)
    inner = nodes.where("edge is null")
    under = (inner.where("parent is not null").drop("parent_conv_id")
             .join(merged.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id")), "parent"))
    return (inner.where("parent is null").select(*OUTPUT).unionByName(under.select(*OUTPUT)).unionByName(top))


# --- sequences from turn rows --------------------------------------------------------
def turn_digest(role: Column, text: Column) -> Column:
    """32 hexadecimal digits for a role and a text; the length keeps them apart."""
    both = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.left(F.sha2(both.cast("binary"), 256), F.lit(2 * DIGEST))


def turn_lists(conversations: DataFrame) -> DataFrame:
    """conv_id and its turns in order, as (digest, chars) without texts."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(F.col("turn").cast("long").alias("turn"), role.alias("role"), turn_digest(role, text).alias("digest"),
                 F.length(text).alias("chars")).alias("t"))
    return turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns")).select(
        "conv_id", F.transform("turns", lambda t: F.struct(t["digest"].alias("digest"), t["chars"].alias("chars"))).alias("turns"))


def sequences(lists: DataFrame) -> DataFrame:
    """Turn lists as the rows that `trie_nodes` takes."""
    return lists.select(
        "conv_id", F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), "")).alias("path"),
        F.transform("turns", lambda t: t["chars"]).alias("chars"))


def prefix_trie(conversations: DataFrame, partitions: int | None = None) -> DataFrame:
    """The trie over `conversations` (conv_id, turn, role, text) as they are."""
    return trie_nodes(sequences(turn_lists(conversations)), partitions)


# --- fixed values: how the query rebuilds conversations -----------------------------
FAMILY = 100  # conversation c continues conversation c - c % FAMILY
HEADS = 6     # from its first crc32(c) % HEADS turns
# -------------------------------------------------------------------------------------


def rebuilt(lists: DataFrame) -> DataFrame:
    """Every conversation with its family's first h turns in place of its own.
    A family's first conversation hands on at most HEADS - 1 turns."""
    lists = saved(lists, "trie-turns")
    c = F.col("conv_id")
    heads = lists.where(c % FAMILY == 0).select(c.alias("family"), F.slice("turns", 1, HEADS - 1).alias("head"))
    h = (F.crc32(c.cast("string").cast("binary")) % HEADS).cast("int")
    own = lists.select("conv_id", "turns", (c - c % FAMILY).alias("family"), h.alias("h"))
    joined = own.join(heads, "family", "left")
    head = F.slice(F.coalesce("head", F.array().cast(lists.schema["turns"].dataType)), F.lit(1), F.col("h"))
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1)))
    return joined.select("conv_id", F.concat(head, rest).alias("turns"))


def trie_rows(conversations: DataFrame, partitions: int | None = None) -> DataFrame:
    """Query form over `conversations`: the trie of the rebuilt conversations."""
    return trie_nodes(sequences(rebuilt(turn_lists(conversations))), partitions)
