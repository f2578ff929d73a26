"""Prefix trie of conversations by burst tries.

Every conversation is a path of turn ids from the root. A container holds the
suffixes of all conversations below one trie head. A container with more than
``cap`` turns bursts by its next turn id into one container for each child, and so
on; rounds look at one depth, then two, four and so on, so their number grows with
the logarithm of the deepest burst. Heads that burst become the upper trie, built by
aggregates, so a turn that a third of all conversations share is never one task's
group. What is left is bounded: each container goes to one task, where its suffixes
are sorted and swept, opening and closing nodes by the common prefix of neighbours.
Containers with a single conversation need no sweep: each of its turns is a node.

A node is known by its depth and a 128-bit sum of hashes of (depth, turn id) along the
path, which running sums give without gathering a conversation in one place. Totals of the
upper trie run along the paths of the smallest members.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.prefix import ordered_positions
from .common import stored

CAP = 512
_MASK = (1 << 32) - 1
_NODE = ["d", "k1", "k2"]
_EMPTY_SHA = hashlib.sha256(b"").hexdigest()
_RESULT = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
           "n_leaves long, saved_tokens long, ends_sha256 string")


def _tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """``c, t, words, rank, group_count``: turns in order, with the 128-bit id of
    (role, text) and the words of the text. Texts go no further than this."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turn_id = F.unhex(F.substring(F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("c"), "turn", turn_id.alias("t"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"))
    return stored(ordered_positions(rows, [F.col("turn").asc_nulls_first(), F.col("t")], ["c"],
                                    num_partitions=_tasks(rows)).drop("turn"), "trie-turns")


def rebuilt_turns(turns: DataFrame, group: int = 20, heads: int = 4) -> DataFrame:
    """``c, d, t, words, n_turns``: one row for depth 0 and for each rebuilt turn.

    Conversation c starts with the first h turns of conversation c - c % group and goes on
    with its own turns after its first h, where h = crc32(c) % heads."""
    convs = turns.groupBy("c").agg(F.max("group_count").alias("own")) \
        .withColumn("h", (F.crc32(F.col("c").cast("string").cast("binary")) % heads).cast("int")) \
        .withColumn("base", F.col("c") - F.col("c") % group)
    first = turns.where((F.col("rank") < heads) & (F.col("c") % group == 0)).groupBy("c") \
        .agg(F.sort_array(F.collect_list(F.struct("rank", "t", "words"))).alias("lent")) \
        .withColumnRenamed("c", "base")  # fewer than ``heads`` turns each
    convs = stored(convs.join(first, "base", "left").select(
        "c", "h", F.coalesce(F.expr("slice(lent, 1, h)"), F.expr("array()").cast(
            "array<struct<rank:bigint,t:binary,words:bigint>>")).alias("lent"), "own")
        .withColumn("n_turns", F.size("lent") + F.greatest(F.col("own") - F.col("h"), F.lit(0))), "trie-convs")
    root = convs.select("c", F.lit(0).cast("long").alias("d"), F.lit(b"").alias("t"),
                        F.lit(0).cast("long").alias("words"), "n_turns")
    lent = convs.select("c", "n_turns", F.posexplode("lent").alias("i", "x")) \
        .select("c", (F.col("i") + 1).cast("long").alias("d"), "x.t", "x.words", "n_turns")
    own = turns.join(convs.select("c", "h", F.size("lent").alias("m"), "n_turns"), "c") \
        .where(F.col("rank") > F.col("h")) \
        .select("c", (F.col("m") + F.col("rank") - F.col("h")).alias("d"), "t", "words", "n_turns")
    return root.unionByName(lent).unionByName(own)


def _joined(high: Column, low: Column) -> Column:
    return F.shiftleft(high.bitwiseAND(F.lit(_MASK)), 32).bitwiseOR(low.bitwiseAND(F.lit(_MASK)))


def paths(rebuilt: DataFrame) -> DataFrame:
    """Adds the node of every row, ``d, k1, k2``, and its parent's ``p1, p2``."""
    a, b = F.xxhash64("t", "d"), F.xxhash64("d", "t", F.lit(1))
    parts = {"a1": F.shiftrightunsigned(a, 32), "a2": a.bitwiseAND(F.lit(_MASK)),
             "b1": F.shiftrightunsigned(b, 32), "b2": b.bitwiseAND(F.lit(_MASK))}
    rows = rebuilt.withColumns({n: F.when(F.col("d") > 0, v).otherwise(F.lit(0)).cast("long")
                                for n, v in parts.items()})
    summed = ordered_positions(rows, [F.col("d")], ["c"], sums=list(parts), num_partitions=_tasks(rows))
    before = {n: F.col(f"cum_{n}") - F.col(n) for n in parts}
    return stored(summed.select(
        "c", "d", "t", "words", "n_turns",
        _joined(F.col("cum_a1"), F.col("cum_a2")).alias("k1"), _joined(F.col("cum_b1"), F.col("cum_b2")).alias("k2"),
        _joined(before["a1"], before["a2"]).alias("p1"), _joined(before["b1"], before["b2"]).alias("p2")),
        "trie-paths")


def burst(path: DataFrame, cap: int) -> tuple[DataFrame, DataFrame]:
    """(heads that burst: ``d, k1, k2, p1, p2, n, first, words``; conversations with
    their container: ``c, s, k1, k2, p1, p2, n``, s being the depth of its head)."""
    heads, sealed, alive = [], [], None
    lo, width = 0, 1
    while True:
        rows = path.where(F.col("d").between(lo, lo + width - 1))
        if alive is not None:
            rows = rows.join(alive, "c", "left_semi")
        nodes = stored(rows.groupBy(*_NODE).agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.col("n_turns") - F.col("d") + 1).alias("turns"),
            F.min("c").alias("first"), F.max("words").alias("words"), F.max("p1").alias("p1"), F.max("p2").alias("p2")),
            "trie-nodes")
        held = (F.col("n") == 1) | (F.col("turns") <= cap)
        heads.append(nodes.where(~held).select(*_NODE, "p1", "p2", "n", "first", "words"))
        top = F.struct(F.col("d").alias("s"), "k1", "k2", "p1", "p2", "n")
        marks = stored(rows.select("c", "n_turns", *_NODE).join(
            nodes.withColumn("top", F.when(held, top)).select(*_NODE, "top"), _NODE)
            .groupBy("c").agg(F.min("top").alias("top"), F.max("n_turns").alias("n_turns")), "trie-marks")
        sealed.append(marks.where(F.col("top").isNotNull()).select("c", "top.*"))
        lo, width = lo + width, max(1, 2 * width if lo else 1)
        alive = marks.where(F.col("top").isNull() & (F.col("n_turns") >= lo)).select("c")
        if alive.isEmpty():
            break
    for found in (heads, sealed):
        for more in found[1:]:
            found[0] = found[0].unionByName(more)
    return heads[0], sealed[0]


def sweep(suffixes, top: int = 0) -> list[tuple]:
    """Nodes of a container from (turn ids, words, conversation) suffixes, the head first
    in every suffix: (conversation, depth, parent's, n, children, leaves, saved, ends)."""
    out: list[list] = []
    stack: list[dict] = []

    def close() -> None:
        node = stack.pop()
        node["ends"].sort()
        if node["ends"]:
            node["first"] = min(node["first"], node["ends"][0]) if node["first"] is not None else node["ends"][0]
        node["n"] += len(node["ends"])
        saved = node["saved"] + (node["n"] - 1) * node["words"]
        leaves = node["leaves"] or 1
        out[node["at"]] = [node["first"], node["depth"], stack[-1]["at"] if stack else None, node["n"],
                           node["children"], leaves, saved, node["ends"]]
        if stack:
            up = stack[-1]
            up["n"] += node["n"]
            up["children"] += 1
            up["leaves"] += leaves
            up["saved"] += saved
            up["first"] = node["first"] if up["first"] is None else min(up["first"], node["first"])

    before: tuple = ()
    for turns, words, conv in sorted(suffixes, key=lambda s: (s[0], s[2])):
        common = 0
        for x, y in zip(before, turns):
            if x != y:
                break
            common += 1
        while len(stack) > common:
            close()
        for k in range(common, len(turns)):
            stack.append({"at": len(out), "depth": top + k, "first": None, "n": 0, "children": 0, "leaves": 0,
                          "saved": 0, "ends": [], "words": words[k]})
            out.append([])
        stack[-1]["ends"].append(conv)
        before = turns
    while stack:
        close()
    return [(first, depth, None if up is None else out[up][0], *rest) for first, depth, up, *rest in out]


def _sha_of(ids: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest() if ids else _EMPTY_SHA


def _swept(key, group):
    """One container, at most ``cap`` turns: the suffixes of its conversations."""
    convs: dict[int, list] = {}
    for c, d, t, w in zip(*(group[x].to_pylist() for x in ("c", "d", "t", "words"))):
        convs.setdefault(c, []).append((d, t, w))
    suffixes = []
    for c, rows in convs.items():
        rows.sort()
        suffixes.append((tuple(r[1] for r in rows), [r[2] for r in rows], c))
    s = key[0].as_py()
    nodes = sweep(suffixes, s)
    cols = list(zip(*nodes))
    data = [pa.array(x, pa.int64()) for x in cols[:7]] + [pa.array([_sha_of(e) for e in cols[7]], pa.string())]
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return pa.table(data, names)


def _list_chunks(batches):
    """Joins runs of one node's sorted ids to text, at most 65,536 ids each."""
    node, ids = None, []

    def row():
        return pa.RecordBatch.from_pylist([{"d": node[0], "k1": node[1], "k2": node[2], "at": ids[0],
                                            "ids": ",".join(map(str, ids))}],
                                          pa.schema([("d", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()),
                                                     ("at", pa.int64()), ("ids", pa.string())]))
    for batch in batches:
        for *key, c in zip(*(col.to_pylist() for col in batch.columns)):
            if ids and (key != node or len(ids) >= 1 << 16):
                yield row()
                ids = []
            node = key
            ids.append(c)
    if ids:
        yield row()


def _list_digests(batches):
    """SHA-256 of each node's chunks, read in order and never held together."""
    node, sha = None, None
    schema = pa.schema([("d", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("ends_sha256", pa.string())])

    def row():
        return pa.RecordBatch.from_pylist([dict(zip(("d", "k1", "k2"), node)) | {"ends_sha256": sha.hexdigest()}], schema)
    for batch in batches:
        for r in batch.to_pylist():
            key = (r["d"], r["k1"], r["k2"])
            if key != node:
                if node:
                    yield row()
                node, sha = key, hashlib.sha256(r["ids"].encode())
            else:
                sha.update(b"," + r["ids"].encode())
    if node:
        yield row()


def list_digests(ends: DataFrame) -> DataFrame:
    """``d, k1, k2, ends_sha256`` from ``d, k1, k2, c``: the ids of a node are sorted over
    all tasks and joined to pieces of text there; one task reads a node's pieces as a stream."""
    n = _tasks(ends)
    chunks = ends.select(*_NODE, "c").repartitionByRange(n, *_NODE, "c").sortWithinPartitions(*_NODE, "c") \
        .mapInArrow(_list_chunks, "d long, k1 long, k2 long, at long, ids string")
    return chunks.repartition(n, *_NODE).sortWithinPartitions(*_NODE, "at") \
        .mapInArrow(_list_digests, "d long, k1 long, k2 long, ends_sha256 string")


def upper_trie(path: DataFrame, heads: DataFrame, below: DataFrame, ended: DataFrame) -> DataFrame:
    """Result rows of the heads that burst. ``below``: ``d, k1, k2, leaves, saved`` of the
    containers, keyed by their parent; ``ended``: ``d, k1, k2, c`` of conversations that
    end at a burst head."""
    children = below.select(*_NODE, F.lit(1).alias("one"), "leaves", "saved").unionByName(
        heads.where("d > 0").select((F.col("d") - 1).alias("d"), F.col("p1").alias("k1"), F.col("p2").alias("k2"),
                                    F.lit(1).alias("one"), F.lit(0).cast("long").alias("leaves"),
                                    F.lit(0).cast("long").alias("saved"))) \
        .groupBy(*_NODE).agg(F.sum("one").alias("children"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    own = stored(heads.join(children, _NODE, "left").select(
        *_NODE, "p1", "p2", "n", "first", F.coalesce("children", F.lit(0)).alias("children"),
        F.when(F.col("children").isNull(), 1).otherwise(F.col("leaves")).cast("long").alias("leaves"),
        (F.coalesce("saved", F.lit(0)) + (F.col("n") - 1) * F.col("words")).alias("saved")), "trie-heads")
    # every head counts once on the path of its smallest member, up to the root
    deepest = own.groupBy(F.col("first").alias("c")).agg(F.max("d").alias("deepest"))
    rows = path.join(deepest, "c").where(F.col("d") <= F.col("deepest")).select("c", *_NODE)
    counts = own.select(F.col("first").alias("c"), "d", "leaves", "saved")
    rows = rows.join(counts, ["c", "d"], "left").fillna(0, ["leaves", "saved"])
    summed = ordered_positions(rows, [F.col("d").desc()], ["c"], sums=["leaves", "saved"], num_partitions=_tasks(rows))
    totals = summed.groupBy(*_NODE).agg(F.sum("cum_leaves").alias("n_leaves"), F.sum("cum_saved").alias("saved_tokens"))
    up = own.select((F.col("d") + 1).alias("d"), F.col("k1").alias("p1"), F.col("k2").alias("p2"),
                    F.col("first").alias("parent_conv_id"))
    return own.join(totals, _NODE).join(list_digests(ended), _NODE, "left") \
        .join(up, ["d", "p1", "p2"], "left").select(
            F.col("first").alias("conv_id"), F.col("d").alias("depth"), "parent_conv_id", F.col("n").alias("n_convs"),
            F.col("children").cast("long").alias("n_children"), "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", F.lit(_EMPTY_SHA)).alias("ends_sha256"))


def conversation_trie(conversations: DataFrame, cap: int = CAP) -> DataFrame:
    """``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256`` for each node of the trie of rebuilt conversations.

    Turns go by ``turn``, null first; equal turns by the digest of role and text, and
    repeated rows are turns of their own. Null roles and texts are empty; a row without
    conv_id belongs to no conversation. A turn may be of any length: only its digest and
    word count go on. A conversation may be of any length, and any number of them may be
    alike. An empty table gives no rows; other columns are ignored.

    ``ends_sha256`` of a node where very many conversations end is one stream of sorted ids
    through one task, as the digest of a list has no parallel form."""
    path = paths(rebuilt_turns(numbered_turns(conversations)))
    heads, sealed = burst(path, cap)
    inside = stored(path.join(sealed.select("c", "s", F.col("k1").alias("s1"), F.col("k2").alias("s2"),
                                            F.col("p1").alias("u1"), F.col("p2").alias("u2"), "n"), "c")
                    .where(F.col("d") >= F.col("s"))
                    .select("c", "d", "t", "words", "n_turns", "s", "s1", "s2", "u1", "u2", "n"), "trie-inside")
    lone = inside.where("n = 1").select(
        F.col("c").alias("conv_id"), F.col("d").alias("depth"), F.when(F.col("d") > F.col("s"), F.col("c")).alias("parent_conv_id"),
        F.lit(1).cast("long").alias("n_convs"), (F.col("d") < F.col("n_turns")).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"),
        F.when(F.col("d") == F.col("n_turns"), F.sha2(F.col("c").cast("string").cast("binary"), 256))
        .otherwise(F.lit(_EMPTY_SHA)).alias("ends_sha256"))
    swept = inside.where("n > 1").select("c", "d", "t", "words", "s", "s1", "s2") \
        .groupBy("s", "s1", "s2").applyInArrow(_swept, _RESULT)
    lower = stored(lone.unionByName(swept), "trie-lower")
    # the head of a container is the only node at its depth whose smallest member is this one
    tops = inside.groupBy("s", "s1", "s2").agg(F.min("c").alias("conv_id"), F.min("u1").alias("p1"), F.min("u2").alias("p2")) \
        .withColumnRenamed("s", "depth").drop("s1", "s2")
    tops = stored(lower.where(F.col("parent_conv_id").isNull()).join(tops, ["conv_id", "depth"]), "trie-tops")
    up = heads.select((F.col("d") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"),
                      F.col("first").alias("up_conv_id"))
    columns = lower.columns
    tops_named = tops.join(up, ["depth", "p1", "p2"], "left").withColumn("parent_conv_id", F.col("up_conv_id")).select(*columns)
    below = tops.where("depth > 0").select((F.col("depth") - 1).alias("d"), F.col("p1").alias("k1"), F.col("p2").alias("k2"),
                                           F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved"))
    ended = path.where(F.col("d") == F.col("n_turns")).select(*_NODE, "c").join(sealed.select("c"), "c", "left_anti")
    return lower.where(F.col("parent_conv_id").isNotNull()).unionByName(tops_named) \
        .unionByName(upper_trie(path, heads, below, ended).select(*columns))
