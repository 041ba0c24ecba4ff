"""Conversation prefix trie by vertical bitmaps: postings (position, turn) -> bitset of conversations, per shard.

Conversations are dealt to shards by their id, so a first turn that very many share is no group of its own: each shard
walks the part of the trie its conversations make, and counts of a node that several shards meet are added up.

A node's owner is its smallest member.  Whoever owns a node owns all deeper nodes of its own path, so one number a
conversation, the least depth it owns, says everything about what is counted once per node instead of once per member.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from textsignal.llm.common import store

ROOT = hashlib.md5(b"").digest()
SHARD_CONVERSATIONS = 1024  # on average; the width of a bitset
FIRST_PASS = "node binary, depth long, n long, least long, ends array<long>"
SECOND_PASS = "node binary, parent binary, depth long, n long, least long, n_leaves long, saved long"


class Shard:
    """Postings of the conversations of one shard; bit i of every bitset is the i-th id in ascending order."""

    def __init__(self, turns: pd.DataFrame):
        """``turns`` (conv_id, place, turn, chars) with place 0 for the conversation itself."""
        self.ids = sorted(turns.loc[turns["place"] == 0, "conv_id"].tolist())
        bit = {c: 1 << i for i, c in enumerate(self.ids)}
        self.all = (1 << len(self.ids)) - 1
        self.postings: dict[tuple[int, bytes], int] = defaultdict(int)
        self.reach: dict[int, int] = defaultdict(int)  # depth -> conversations with a turn at that place
        self.at: dict[tuple[int, int], bytes] = {}  # (place, bit number) -> turn
        self.chars: dict[bytes, int] = {}
        for c, place, turn, chars in turns.loc[turns["place"] > 0, ["conv_id", "place", "turn", "chars"]].itertuples(index=False):
            self.postings[place, turn] |= bit[c]
            self.reach[place] |= bit[c]
            self.at[place, bit[c].bit_length() - 1] = turn
            self.chars[turn] = chars

    def children(self, members: int, depth: int) -> Iterator[tuple[bytes, int]]:
        """(turn, members) of each child: the members left over pick the posting of their least, until none is left."""
        rest = members & self.reach[depth + 1]
        while rest:
            turn = self.at[depth + 1, (rest & -rest).bit_length() - 1]
            child = members & self.postings[depth + 1, turn]
            yield turn, child
            rest &= ~child

    def walk(self) -> Iterator[tuple[bytes, bytes | None, int, int, int, bool]]:
        """(node, parent, depth, code points of the last text, members, done), depth-first; each node twice: done is False
        before its children and True after them."""
        stack = [(ROOT, None, 0, 0, self.all, False)]
        while stack:
            node, parent, depth, chars, members, done = stack.pop()
            yield node, parent, depth, chars, members, done
            if not done:
                stack.append((node, parent, depth, chars, members, True))
                for turn, child in self.children(members, depth):
                    stack.append((hashlib.md5(node + turn).digest(), node, depth + 1, self.chars[turn], child, False))

    def named(self, members: int) -> list[int]:
        out = []
        while members:
            low = members & -members
            out.append(self.ids[low.bit_length() - 1])
            members ^= low
        return out


def _nodes(turns: pd.DataFrame) -> pd.DataFrame:
    """First pass over a shard: members, smallest member and who ends at each node."""
    shard = Shard(turns)
    rows = [
        (node, depth, members.bit_count(), shard.ids[(members & -members).bit_length() - 1], shard.named(members & ~shard.reach[depth + 1]))
        for node, _, depth, _, members, done in shard.walk()
        if not done
    ]
    return pd.DataFrame(rows, columns=["node", "depth", "n", "least", "ends"])


def _sums(turns: pd.DataFrame) -> pd.DataFrame:
    """Second pass, knowing the owners: what a shard adds to the sums of its nodes.

    ``turns`` has a row (place -1) per owner: ``owned`` is its least depth, ``leaf`` whether its last node is a leaf.
    """
    owners = turns[turns["place"] == -1]
    shard = Shard(turns[turns["place"] >= 0])
    number = {c: i for i, c in enumerate(shard.ids)}
    leaves, starts = 0, defaultdict(int)
    for c, owned, leaf in owners[["conv_id", "owned", "leaf"]].itertuples(index=False):
        starts[int(owned)] |= 1 << number[c]
        leaves |= bool(leaf) << number[c]
    owning = [0]
    for depth in range(max([0, *shard.reach]) + 1):  # owning[d + 1]: who owns the own node of depth d, if there is one
        owning.append(owning[-1] | starts[depth])
    rows, saved = [], defaultdict(int)
    for node, parent, depth, chars, members, done in shard.walk():
        if done:
            saved[node] += (members.bit_count() - (members & owning[depth + 1]).bit_count()) * chars
            least = shard.ids[(members & -members).bit_length() - 1]
            rows.append((node, parent, depth, members.bit_count(), least, (members & leaves).bit_count(), saved[node]))
            saved[parent] += saved.pop(node)
    return pd.DataFrame(rows, columns=[c.split()[0] for c in SECOND_PASS.split(", ")])


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(node, digest of its ids) from rows sorted by node and id, as a stream."""
    node, digest = None, None
    for batch in batches:
        out = []
        for at, conv_id in zip(batch["node"], batch["conv_id"], strict=True):
            if at != node:
                if node is not None:
                    out.append((node, digest.hexdigest()))
                node, digest = at, hashlib.sha256(str(conv_id).encode())
            else:
                digest.update(f",{conv_id}".encode())
        if out:
            yield pd.DataFrame(out, columns=["node", "ends_sha256"])
    if node is not None:
        yield pd.DataFrame([(node, digest.hexdigest())], columns=["node", "ends_sha256"])


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, turn, chars) of each conversation's own turns: place 1, 2, … by turn, nulls first, and for rows
    that share a turn by role, then text.  ``turn`` is a digest of role and text, nulls being empty."""
    filled = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("no"), filled("role").alias("role"), filled("text").alias("text"))
    rows = rows.filter(F.col("conv_id").isNotNull())
    order = Window.partitionBy("conv_id").orderBy(F.col("no").asc_nulls_first(), "role", "text")
    content = F.unhex(F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text").cast("binary")))
    return rows.select(
        "conv_id", F.row_number().over(order).cast("long").alias("place"), content.alias("turn"), F.char_length("text").cast("long").alias("chars")
    )


def rebuilt(conversations: DataFrame, family: int = 100, heads: int = 6) -> DataFrame:
    """(conv_id, place, turn, chars): every conversation with the beginning of its family's first, and a row of place 0 for each.

    Conversation c takes the first h turns of conversation c - c % ``family``, h being crc32 of c modulo ``heads``, and
    goes on with its own turns after its first h.  At most ``heads`` - 1 turns of a family's first are
    taken by at most 2 ``family`` conversations, so no join key is large.
    """
    turns = store(ordered_turns(conversations), "turns")
    ids = turns.select("conv_id").distinct()
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads
    first = turns.filter(F.col("place") < heads)
    first = first.select(F.col("conv_id").alias("first_id"), "place", "turn", "chars")
    taken = ids.withColumn("first_id", F.col("conv_id") - F.col("conv_id") % family).join(first, "first_id")
    taken = taken.filter(F.col("place") <= h).select("conv_id", "place", "turn", "chars")
    length = taken.groupBy("conv_id").agg(F.max("place").alias("given"))
    own = turns.filter(F.col("place") > h).join(length, "conv_id", "left")
    place = F.coalesce("given", F.lit(0)) + F.col("place") - h
    own = own.select("conv_id", place.alias("place"), "turn", "chars")
    marks = ids.select("conv_id", F.lit(0).cast("long").alias("place"), F.lit(ROOT).alias("turn"), F.lit(0).cast("long").alias("chars"))
    return taken.unionByName(own).unionByName(marks)


def trie(turns: DataFrame) -> DataFrame:
    """A row per node of the trie over sequences of turns: see ``prefix_trie``; ``turns`` as ``rebuilt`` gives them."""
    turns = store(turns, "rebuilt")
    shards = max(1, turns.filter("place = 0").count() // SHARD_CONVERSATIONS)
    shard = F.pmod(F.xxhash64("conv_id"), F.lit(shards))
    long = lambda x: F.lit(x).cast("long")
    dealt = turns.withColumns({"shard": shard, "owned": long(0), "leaf": F.lit(False)})

    walked = store(dealt.groupBy("shard").applyInPandas(lambda part: _nodes(part), FIRST_PASS), "nodes")
    owners = walked.groupBy("node").agg(F.min("least").alias("conv_id"), F.max("depth").alias("depth"), F.sum("n").alias("n"), F.sum(F.size("ends")).alias("stay"))
    last = F.max_by(F.col("n") == F.col("stay"), "depth")  # all members of its deepest node end there
    owners = owners.groupBy("conv_id").agg(F.min("depth").alias("owned"), last.alias("leaf"))
    owners = owners.select(
        "conv_id", long(-1).alias("place"), F.lit(ROOT).alias("turn"), long(0).alias("chars"), shard.alias("shard"), "owned", "leaf"
    )
    summed = dealt.unionByName(owners).groupBy("shard").applyInPandas(lambda part: _sums(part), SECOND_PASS)
    nodes = summed.groupBy("node").agg(
        F.first("parent").alias("parent"),
        F.first("depth").alias("depth"),
        F.min("least").alias("conv_id"),
        F.sum("n").alias("n_convs"),
        F.sum("n_leaves").alias("n_leaves"),
        F.sum("saved").alias("saved_tokens"),
    )
    nodes = store(nodes, "trie")

    ends = walked.select("node", F.explode("ends").alias("conv_id")).repartition("node").sortWithinPartitions("node", "conv_id")
    ends = ends.mapInPandas(_digests, "node binary, ends_sha256 string")
    births = nodes.groupBy("parent").agg(F.count(F.lit(1)).alias("n_children")).select(F.col("parent").alias("node"), "n_children")
    parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    named = nodes.join(parents, "parent", "left").join(births, "node", "left").join(ends, "node", "left")
    return named.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        F.coalesce("n_children", F.lit(0)).alias("n_children"),
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """A row per node of the trie of rebuilt conversations: each distinct sequence of their first d turns, the empty one too.

    ``conv_id`` is the smallest member, ``n_convs`` the members, ``n_leaves`` the childless nodes at and below,
    ``saved_tokens`` the sum at and below of (members - 1) times the code points of the node's last text, and
    ``ends_sha256`` the digest of the ids that end here, ascending, joined by commas.

    A null role or text is empty; rows without a ``conv_id`` belong to no conversation and are left out.  Rows that share
    a turn stand by role, then text; repeated rows are turns of their own.  An empty table gives an empty table.  Other
    columns are ignored; only the results are returned.  Turns are compared by 128-bit digests.

    A shard holds some 1,000 conversations; a conversation's own turns stay in one task, some 1 KB each.
    """
    return trie(rebuilt(conversations))
