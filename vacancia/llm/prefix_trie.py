"""Prefix trie of conversations, as double arrays of prefix shards.

A conversation is its turns in order. A turn is an element of 24 bytes: half of the SHA-256 of role and
text, and the text's length; so texts are never shuffled, and the elements in a row are a sequence whose
order as bytes is that of its prefixes. Equal sequences are one row with their number of members and
least identifier. Distinct sequences are range-partitioned and sorted, which splits a prefix of any
share of all rows over as many tasks as it deserves.

Every ``SHARD_TURNS`` turns in that order are one prefix shard. Its turns get dense ids, and its trie is
packed in two arrays: a child by turn id t of node s stands at BASE[s] + t and has CHECK s. All sequences
are then led through the arrays together, one turn a step, and leave their counts at the nodes.

A shard is an interval of the order. Only nodes on the path of its first or of its last sequence can
also be in another shard; what hangs beside these paths is complete and leaves the shard as a result.
Nodes on the paths, at most two for each depth, carry a digest of their prefix as their key; their
members, children, leaves and saved bytes are added over all shards by that key, and each is counted
for itself in one shard only.

Identifiers of members that end at a node are sorted by range partitioning and hashed as a stream of
text chunks, so that no task holds a whole list.

Order of turns: turn (null first), then role, then digest of the text. A null role or text is empty; rows
without a conversation are left out. A repeated row is a turn of its own. An empty table has no node. A
conversation's elements, like a document's text, are held as one value. Further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import whole_text

#: Turns of one shard, at most (or one longer conversation), and bytes of an element.
SHARD_TURNS, ELEMENT = 1 << 16, 24
#: Identifiers in one chunk of text.
CHUNK = 4096
NODE = (
    "shard string, depth long, side int, key binary, parent_key binary, conv_id long, parent_conv_id long, "
    "n_convs long, n_children long, n_leaves long, saved_tokens long, last_bytes long, ends string"
)


def turn_elements(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, turns``: the elements of every conversation in order, as hexadecimal digits."""
    role_text, body = whole_text(role), whole_text(text)
    digest = F.sha2(F.concat(F.octet_length(role_text).cast("string"), F.lit(":"), role_text, body), 256)
    element = F.concat(F.substring(digest, 1, 32), F.lpad(F.hex(F.octet_length(body).cast("long")), 16, "0"))
    rows = conversations.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"),
        F.struct(F.col(turn).cast("long").alias("turn"), role_text.alias("role"), element.alias("element")).alias("turn"),
    )
    # Null comes first in a sorted array's structs.
    turns = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    return turns.select("conv_id", F.col("turns.element").alias("turns"))


def sequences(conversations: DataFrame) -> DataFrame:
    """``conv_id, sequence``: each conversation's elements as bytes."""
    return conversations.select("conv_id", F.unhex(F.array_join("turns", "")).alias("sequence"))


def end_digests(members: DataFrame) -> DataFrame:
    """``sid, ends``: SHA-256 of the ascending decimal ``conv_id`` of each ``sid``, joined by commas."""

    def chunk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sids, ids = batch["sid"].to_numpy(), batch["conv_id"].to_numpy()
            cuts = np.flatnonzero(np.append(True, sids[1:] != sids[:-1])).tolist() + [len(sids)]
            out = []
            for a, b in zip(cuts, cuts[1:]):
                out += [(sids[a], int(ids[i]), ",".join(map(str, ids[i : min(b, i + CHUNK)].tolist()))) for i in range(a, b, CHUNK)]
            yield pd.DataFrame(out, columns=["sid", "at", "ids"])

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, state = None, None
        for batch in batches:
            out = []
            for sid, ids in zip(batch["sid"], batch["ids"]):
                if sid == name:
                    state.update(b"," + ids.encode())
                    continue
                if name is not None:
                    out.append((name, state.hexdigest()))
                name, state = sid, hashlib.sha256(ids.encode())
            yield pd.DataFrame(out, columns=["sid", "ends"])
        if name is not None:
            yield pd.DataFrame([(name, state.hexdigest())], columns=["sid", "ends"])

    ordered = members.select("sid", "conv_id").repartitionByRange("sid", "conv_id").sortWithinPartitions("sid", "conv_id")
    chunks = ordered.mapInPandas(chunk, "sid string, at long, ids string")
    return chunks.repartition("sid").sortWithinPartitions("sid", "at").mapInPandas(digest, "sid string, ends string")


class DoubleArray:
    """Trie over sorted distinct sequences of dense ids, packed in BASE and CHECK; node 0 is the root.

    ``BASE[s] + id`` is the child of s by an id if its CHECK is s. A node without children has BASE 0.
    """

    def __init__(self, codes: np.ndarray, lengths: np.ndarray, n_codes: int):
        self.base = np.zeros(1, np.int64)
        self.check = np.full(1, -1, np.int64)
        # A free place links to itself, another towards the next free one.
        self.link: list[int] = [1]
        starts, state = np.cumsum(lengths) - lengths, np.zeros(len(lengths), np.int64)
        on, depth, self.top = np.arange(len(lengths)), 0, 1
        self._grow(2 * n_codes + 2)
        while len(on := on[lengths[on] > depth]):
            parent, code = state[on], codes[starts[on] + depth]
            new = np.append(True, (parent[1:] != parent[:-1]) | (code[1:] != code[:-1]))
            groups = np.flatnonzero(new)
            parents, children = parent[groups], code[groups]
            cuts = np.flatnonzero(np.append(True, parents[1:] != parents[:-1])).tolist() + [len(parents)]
            for a, b in zip(cuts, cuts[1:]):
                self._place(int(parents[a]), children[a:b])
            place = self.base[parents] + children
            state[on] = place[np.cumsum(new) - 1]
            depth += 1

    def _grow(self, size: int) -> None:
        if size > len(self.base):
            more = max(size, 2 * len(self.base)) - len(self.base)
            self.base = np.append(self.base, np.zeros(more, np.int64))
            self.check = np.append(self.check, np.full(more, -1, np.int64))
        self.link += range(len(self.link), len(self.base) + 1)

    def _free(self, at: int) -> int:
        """The first free place from ``at`` on."""
        link = self.link
        while link[at] != at:
            link[at] = link[link[at]]
            at = link[at]
        return at

    def _place(self, parent: int, children: np.ndarray) -> None:
        """Give the children of a node the first places that fit; after some trials, places at the end."""
        first, last = int(children[0]), int(children[-1])
        at = first + 1
        for _ in range(16 if len(children) > 1 else 1):
            at = self._free(at)
            base = at - first
            self._grow(base + last + 1)
            if (self.check[base + children] < 0).all():
                break
            at += 1
        else:
            base = max(1, self.top - first)
            self._grow(base + last + 1)
        self.base[parent] = base
        self.check[base + children] = parent
        for place in (base + children).tolist():
            self.link[place] = place + 1
        self.top = max(self.top, base + last + 1)

    def paths(self, codes: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Lead all sequences through the arrays: for each depth the sequences that reach it, and their nodes."""
        starts, state, on = np.cumsum(lengths) - lengths, np.zeros(len(lengths), np.int64), np.arange(len(lengths))
        yield on, state.copy()
        depth = 0
        while len(on := on[lengths[on] > depth]):
            child = self.base[state[on]] + codes[starts[on] + depth]
            if (self.check[child] != state[on]).any():
                raise ValueError("a sequence is not in the trie")
            state[on] = child
            depth += 1
            yield on, child


def dense_ids(elements: np.ndarray) -> tuple[np.ndarray, int]:
    """Dense ids from 1 of elements of two 64-bit numbers, in their order."""
    order = np.lexsort((elements[:, 1], elements[:, 0]))
    some = elements[order]
    new = np.append(False, (some[1:] != some[:-1]).any(1)) if len(some) else np.zeros(0, bool)
    ids = np.empty(len(some), np.int64)
    ids[order] = np.cumsum(new) + 1
    return ids, int(new.sum()) + min(1, len(some))


def shard_nodes(name: str, rows: pd.DataFrame) -> pd.DataFrame:
    """Nodes of one shard (sorted distinct ``sequence, n, first, ends``).

    ``side`` is null for nodes that are in this shard alone, 0 on the path of the first and of the last
    sequence, 1 and 2 on one of them. On paths children, leaves and bytes are those beside the paths.
    """
    raw = [bytes(s) for s in rows["sequence"]]
    lengths = np.array([len(s) // ELEMENT for s in raw], np.int64)
    words = np.frombuffer(b"".join(raw), ">u8").reshape(-1, 3).astype(np.uint64)
    codes, n_codes = dense_ids(words[:, :2])
    trie = DoubleArray(codes, lengths, n_codes)
    starts = np.cumsum(lengths) - lengths
    n, first = rows["n"].to_numpy(np.int64), rows["first"].to_numpy(np.int64)
    size = len(trie.base)
    members, conv = np.zeros(size, np.int64), np.full(size, np.iinfo(np.int64).max)
    depth, last = np.full(size, -1, np.int64), np.zeros(size, np.int64)
    ends = np.full(size, None, object)
    levels, side = [], np.full(size, -1, np.int64)
    for level, (on, node) in enumerate(trie.paths(codes, lengths)):
        np.add.at(members, node, n[on])
        np.minimum.at(conv, node, first[on])
        depth[node] = level
        if level:
            last[node] = words[starts[on] + level - 1, 2].astype(np.int64)
        stop = lengths[on] == level
        ends[node[stop]] = rows["ends"].to_numpy(object)[on[stop]]
        levels.append(np.unique(node))
        for sequence, mark in ((0, 1), (len(raw) - 1, 2)):
            place = np.searchsorted(on, sequence)
            if place < len(on) and on[place] == sequence:
                here = node[place]
                side[here] = 0 if side[here] >= 0 else mark
    parent = trie.check
    alone = (depth >= 0) & (side < 0)
    children = np.zeros(size, np.int64)
    np.add.at(children, parent[alone], 1)
    leaves, saved = np.zeros(size, np.int64), np.zeros(size, np.int64)
    for nodes in levels[:0:-1]:
        nodes = nodes[side[nodes] < 0]
        leaves[nodes] += children[nodes] == 0
        saved[nodes] += (members[nodes] - 1) * last[nodes]
        np.add.at(leaves, parent[nodes], leaves[nodes])
        np.add.at(saved, parent[nodes], saved[nodes])
    keys = np.full(size, None, object)
    for sequence in (raw[0], raw[-1]):
        node, state, at = 0, hashlib.sha256(), 0
        keys[0] = state.digest()
        while at < len(sequence):
            state.update(sequence[at : at + ELEMENT])
            code = codes[(starts[-1] if sequence is raw[-1] else 0) + at // ELEMENT]
            node, at = int(trie.base[node] + code), at + ELEMENT
            keys[node] = state.copy().digest()
    out = np.flatnonzero(depth >= 0)
    above = parent[out]
    inner = (above >= 0) & (side[above] < 0)
    masked = pd.arrays.IntegerArray
    return pd.DataFrame({
        "shard": name, "depth": depth[out], "side": masked(side[out].astype(np.int32), side[out] < 0), "key": keys[out],
        "parent_key": np.where(above >= 0, keys[above], None), "conv_id": conv[out],
        "parent_conv_id": masked(conv[above], ~inner), "n_convs": members[out], "n_children": children[out],
        "n_leaves": leaves[out], "saved_tokens": saved[out], "last_bytes": last[out], "ends": ends[out],
    })


def _shards(shard_turns: int):
    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        task, number, held, turns = TaskContext.get().partitionId(), 0, [], 0

        def done() -> pd.DataFrame:
            return shard_nodes(f"{task}-{number}", pd.concat(held, ignore_index=True))

        for batch in batches:
            sizes = batch["sequence"].map(len).to_numpy() // ELEMENT
            at, total = 0, np.append(0, np.cumsum(sizes))
            while at < len(batch):
                to = int(np.searchsorted(total, total[at] + shard_turns - turns, "right")) - 1
                to = max(to, at if held else at + 1)
                if to > at:
                    held.append(batch.iloc[at:to])
                    turns += int(total[to] - total[at])
                if to < len(batch):
                    yield done()
                    number, held, turns = number + 1, [], 0
                at = to
        if held:
            yield done()

    return make


def prefix_nodes(conversations: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The trie of conversations (conv_id, turns as hexadecimal elements): one row for each distinct prefix.

    ``conv_id`` (least member), ``depth, parent_conv_id`` (the parent's least member), ``n_convs`` (members),
    ``n_children, n_leaves, saved_tokens, ends`` (digest of the identifiers that end here; null if none do).
    """
    members = cut_lineage(sequences(conversations).withColumn("sid", F.sha2("sequence", 256)))
    whole = members.groupBy("sequence").agg(F.count("*").alias("n"), F.min("conv_id").alias("first"))
    digests = end_digests(members)
    rows = whole.withColumn("sid", F.sha2("sequence", 256)).join(digests, "sid").select("sequence", "n", "first", "ends")
    ordered = rows.repartitionByRange("sequence").sortWithinPartitions("sequence")
    nodes = cut_lineage(ordered.mapInPandas(_shards(shard_turns), NODE))
    alone, paths = nodes.where("side IS NULL"), nodes.where("side IS NOT NULL")

    # Nodes that several shards may share: at most two for each shard and depth.
    upper = paths.groupBy("key").agg(
        F.first("parent_key").alias("parent_key"), F.first("depth").alias("depth"), F.sum("n_convs").alias("n_convs"),
        F.min("conv_id").alias("conv_id"), F.sum("n_children").alias("beside"), F.max("ends").alias("ends"),
        F.min("shard").alias("owner"), F.first("last_bytes").alias("last_bytes"),
    )
    upper = cut_lineage(upper)
    below = upper.where("parent_key IS NOT NULL").groupBy(F.col("parent_key").alias("key")).agg(F.count("*").alias("shared"))
    upper = upper.join(below, "key", "left").withColumn("n_children", F.col("beside") + F.coalesce("shared", F.lit(0)))
    own = upper.select(
        "key", "owner", (F.col("n_children") == 0).cast("long").alias("own_leaf"),
        ((F.col("n_convs") - 1) * F.col("last_bytes")).alias("own_saved"), F.col("conv_id").alias("least"),
    )
    own = cut_lineage(own)
    # In each shard what is below a path's node: the rest of that path, or of both.
    held = paths.select("shard", "side", "depth", "key", "n_leaves", "saved_tokens").join(own, "key")
    mine = (F.col("owner") == F.col("shard")).cast("long")
    held = held.withColumns({"n_leaves": F.col("n_leaves") + mine * F.col("own_leaf"), "saved_tokens": F.col("saved_tokens") + mine * F.col("own_saved")})

    def below_paths(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("depth", ascending=False)
        for name in ("n_leaves", "saved_tokens"):
            value = rows[name].copy()
            for side in (1, 2, 0):
                here = rows["side"] == side
                rest = value[rows["side"] > 0].sum() if side == 0 else 0
                rows.loc[here, name] = value[here].cumsum() + rest
        return rows[["key", "n_leaves", "saved_tokens"]]

    summed = held.select("shard", "side", "depth", "key", "n_leaves", "saved_tokens").groupBy("shard").applyInPandas(
        below_paths, "key binary, n_leaves long, saved_tokens long"
    )
    summed = summed.groupBy("key").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    above = own.select(F.col("key").alias("parent_key"), F.col("least").alias("parent_conv_id"))
    columns = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends")
    tops = upper.select("key", "parent_key", "conv_id", "depth", "n_convs", "n_children", "ends").join(summed, "key").join(above, "parent_key", "left")
    # Nodes right below a path find their parent through the shard: a parent's rows are dealt by shard.
    links = held.select("shard", F.col("key").alias("parent_key"), F.col("least").alias("found"))
    hung = alone.where("parent_key IS NOT NULL").join(links, ["shard", "parent_key"]).withColumn("parent_conv_id", F.col("found"))
    rest = alone.where("parent_key IS NULL")
    return tops.select(*columns).union(hung.select(*columns)).union(rest.select(*columns))


def spliced(conversations: DataFrame, group: int = 5, spread: int = 9) -> DataFrame:
    """``conv_id, turns`` rebuilt: the first h turns of conversation ``c - c % group``, then c's own turns after
    its first h, with h the CRC-32 of c modulo ``spread``. A group has the conversations of one base only."""
    base = F.expr(f"conv_id - conv_id % {group}")
    groups = conversations.groupBy(base.alias("base")).agg(F.collect_list(F.struct("conv_id", "turns")).alias("all"))
    rows = groups.select("base", F.explode("all").alias("c"), F.expr("filter(all, x -> x.conv_id = base)").alias("found"))
    h = F.expr(f"CAST(crc32(CAST(c.conv_id AS string)) % {spread} AS int)")
    rows = rows.select("c.conv_id", F.col("c.turns").alias("own"), F.coalesce(F.get("found", F.lit(0))["turns"], F.array().cast("array<string>")).alias("first"), h.alias("h"))
    return rows.selectExpr("conv_id", "concat(slice(first, 1, h), slice(own, h + 1, greatest(size(own), 1))) AS turns")
