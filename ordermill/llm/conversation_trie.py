"""Trie of conversation prefixes, by the Euler-tour technique.

A node is a distinct sequence of first turns.  Its key is the exclusive or, over its turns, of hashes of each
turn at its depth, 128 bits; prefixes of a conversation are running values, a node's parent is its key without
the last turn, and a node on which two different last turns fall stops the run.  The tree of nodes becomes a
tour that enters and leaves every node; the tour's list of arcs is ranked distributedly, and with running sums
over the arcs' places the leaves and savings below a node are the difference between its two arcs.

No group is gathered: conversations of any length are cut into blocks of turns, children of one node are linked
to their next sibling by places in a global order, and the ids that end at a node are hashed as a stream of
short pieces.

Defined results: rows without ``conv_id`` take no part; a null role or text is empty; turns are ordered by
``turn``, null first, equal turns by a hash of role and text, so repeated rows stay as repeated turns.  Texts of
any length are hashed and counted whole.  An empty table has no nodes, not even the root.  Other columns play no
part.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.llm import list_ranking
from ordermill.llm.ordering import ordered, running
from ordermill.llm.tables import written
from ordermill.operators.lookup import splittable_left_join

WORD = r"[^\x20\x09-\x0D]+"
#: Conversations share first turns with the one whose id is their own rounded down to a multiple of this.
FAMILY = 20
#: At most one turn less than this is taken from there.
GRAFT = 4
#: Ids in a piece of what is hashed for the conversations that end at a node.
PIECE = 512
_KEY = ("depth", "h1", "h2")
_TURN = ("t1", "t2")


def _turn_hashes() -> list[Column]:
    """120 bits of the SHA-256 of role and text, as two numbers."""
    role, text = (F.coalesce(F.col(name), F.lit("")) for name in ("role", "text"))
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    sha = F.sha2(F.encode(whole, "UTF-8"), 256)
    return [F.conv(F.substring(sha, at, 15), 16, 10).cast("long").alias(name) for at, name in ((1, "t1"), (16, "t2"))]


def sequences(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns as ``conv_id``, ``depth`` from 1, turn hashes and ``words``; conversations with their ``length``."""
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        *_turn_hashes(),
        F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD)).cast("long").alias("words"),
        F.monotonically_increasing_id().alias("read"),
    )
    # written, as a sort by ranges reads its input twice: texts are hashed once
    placed = ordered(written(turns, "hashed-turns"), "conv_id", F.col("turn").asc_nulls_first(), *_TURN, "read", name="place")
    starts = written(
        placed.groupBy("conv_id").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("length")), "starts"
    )
    rows = splittable_left_join(placed, starts.select("conv_id", "first"), "conv_id", "conv_id")
    depth = (F.col("place") - F.col("first") + 1).alias("depth")
    return written(rows.select("conv_id", depth, *_TURN, "words"), "turns"), starts.select("conv_id", "length")


def grafted(turns: DataFrame, lengths: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt: the first h turns of the family's first conversation (all if it has fewer, none
    if there is no such conversation), then the own turns after the first h, with h = crc32(id) mod 4."""
    heads = turns.where(F.col("depth") < GRAFT).groupBy("conv_id").agg(
        *(
            F.max(F.when(F.col("depth") == d, F.struct("depth", *_TURN, "words"))).alias(f"turn_{d}")
            for d in range(1, GRAFT)
        )
    )
    families = lengths.join(heads, "conv_id").select(
        F.col("conv_id").alias("family"),
        F.col("length").alias("family_length"),
        F.array(*(f"turn_{d}" for d in range(1, GRAFT))).alias("first_turns"),
    )
    plan = written(
        lengths.withColumns(
            {
                "family": F.col("conv_id") - F.col("conv_id") % FAMILY,
                "left_out": (F.crc32(F.col("conv_id").cast("string").cast("binary")) % GRAFT).cast("long"),
            }
        )
        .join(families, "family", "left")
        .withColumn("taken", F.least("left_out", F.coalesce("family_length", F.lit(0)))),
        "plan",
    )
    rebuilt = F.col("taken") + F.greatest(F.col("length") - F.col("left_out"), F.lit(0))
    own = splittable_left_join(turns, plan.select("conv_id", "left_out", "taken"), "conv_id", "conv_id")
    tails = own.where("depth > left_out").select(
        "conv_id", (F.col("depth") - F.col("left_out") + F.col("taken")).alias("depth"), *_TURN, "words"
    )
    first = plan.where("taken > 0").select("conv_id", F.inline(F.slice("first_turns", F.lit(1), F.col("taken").cast("int"))))
    return tails.unionByName(first), plan.select("conv_id", rebuilt.alias("length"))


def _paths(turns: DataFrame) -> DataFrame:
    """Turns with the key ``h1``, ``h2`` of their prefix and the hashes ``f1``, ``f2`` that they add to it."""
    hashed = written(
        turns.withColumns({f"f{i}": F.xxhash64(*_TURN, F.col("depth"), F.lit(i)) for i in (1, 2)}), "hashed"
    )
    return running(
        hashed,
        "depth",
        {"h1": "f1", "h2": "f2"},
        total=F.bit_xor,
        add=lambda a, b: a.bitwiseXOR(b),
        within=("conv_id",),
    )


def _nodes(paths: DataFrame, lengths: DataFrame) -> DataFrame:
    """One row a node: smallest member, members, parent's key, last turn and its words."""
    same = (F.min("t1") == F.max("t1")) & (F.min("t2") == F.max("t2"))
    found = paths.groupBy(*_KEY).agg(
        F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        F.when(same, F.max("words")).otherwise(F.raise_error(F.lit("two prefixes share a key"))).alias("words"),
        *(F.max(name).alias(name) for name in ("f1", "f2", *_TURN)),
    )
    above = F.struct(
        (F.col("depth") - 1).alias("depth"), *(F.col(f"h{i}").bitwiseXOR(F.col(f"f{i}")).alias(f"h{i}") for i in (1, 2))
    )
    zero = F.lit(0).cast("long")
    root = (
        lengths.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"))
        .where("n_convs > 0")
        .select(
            *(zero.alias(name) for name in _KEY),
            "conv_id",
            "n_convs",
            zero.alias("words"),
            *(F.lit(None).cast("long").alias(name) for name in _TURN),
            F.lit(None).cast("struct<depth:bigint,h1:bigint,h2:bigint>").alias("above"),
        )
    )
    return found.withColumn("above", above).drop("f1", "f2").unionByName(root)


def _linked(nodes: DataFrame) -> DataFrame:
    """Nodes numbered by smallest member and depth, with their parent's number and smallest member."""
    placed = ordered(nodes, "conv_id", "depth", name="node").withColumn("key", F.struct(*_KEY))
    parents = placed.select(
        F.col("key").alias("parent_key"), F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id")
    )
    return written(
        splittable_left_join(placed.drop("key"), parents, "above", "parent_key").drop("above"), "linked"
    )


def _tour(linked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Arcs of the tour with the one after each, and the children of nodes that have some.

    Node v is entered by arc 2v and left by arc 2v + 1; children follow each other by number.
    """
    below = linked.where("parent IS NOT NULL").select("parent", "node")
    children = written(
        below.groupBy("parent").agg(F.count(F.lit(1)).alias("n_children"), F.min("node").alias("first_child")),
        "children",
    )
    siblings = ordered(below, "parent", "node", name="place")
    following = siblings.select(
        (F.col("place") - 1).alias("place"), F.col("parent").alias("next_parent"), F.col("node").alias("next_node")
    )
    sibling = F.when(F.col("next_parent") == F.col("parent"), F.col("next_node") * 2)
    leave = siblings.join(following, "place", "left").select(
        (F.col("node") * 2 + 1).alias("item"), F.coalesce(sibling, F.col("parent") * 2 + 1).alias("after")
    )
    enter = linked.join(children.withColumnRenamed("parent", "node"), "node", "left").select(
        (F.col("node") * 2).alias("item"),
        F.coalesce(F.col("first_child") * 2, F.col("node") * 2 + 1).alias("after"),
    )
    end = linked.where("parent IS NULL").select(
        (F.col("node") * 2 + 1).alias("item"), F.lit(None).cast("long").alias("after")
    )
    arcs = written(leave.unionByName(enter).unionByName(end), "arcs")
    return arcs, children.select(F.col("parent").alias("node"), "n_children")


def _below(arcs: DataFrame, own: DataFrame) -> DataFrame:
    """``n_leaves`` and ``saved_tokens`` of each node's subtree, from running sums over the ranked tour."""
    ranked = list_ranking.ranks(arcs)
    entering = F.col("item") % 2 == 0
    placed = written(
        ranked.withColumn("node", F.expr("item div 2"))
        .join(own.select("node", "leaf", "saved"), "node")
        .select(
            "node",
            "rank",
            entering.alias("entering"),
            *(F.when(entering, F.col(name)).otherwise(0).alias(name) for name in ("leaf", "saved")),
        ),
        "tour",
    )
    sums = running(placed, "rank", {"leaves": "leaf", "savings": "saved"})

    def between(total: str, value: str) -> Column:
        before = F.max(F.when(F.col("entering"), F.col(total) - F.col(value)))
        return F.max(F.when(~F.col("entering"), F.col(total))) - before

    return sums.groupBy("node").agg(
        between("leaves", "leaf").alias("n_leaves"), between("savings", "saved").alias("saved_tokens")
    )


def _streamed_sha256(batches):
    """Hash the pieces of each key, which follow each other in order."""
    key, state = None, None
    for batch in batches:
        out = []
        columns = [batch.column(i).to_pylist() for i in range(4)]
        for *own, text in zip(*columns, strict=True):
            if own != key:
                if key is not None:
                    out.append((*key, state.hexdigest()))
                key, state = own, hashlib.sha256(text.encode())
            else:
                state.update(b"," + text.encode())
        if out:
            yield _hashes(out)
    if key is not None:
        yield _hashes([(*key, state.hexdigest())])


def _hashes(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(values) for values in zip(*rows, strict=True)]
    return pa.RecordBatch.from_arrays(columns, [*_KEY, "ends_sha256"])


def _ends(paths: DataFrame, lengths: DataFrame) -> DataFrame:
    """For each key the hash of the ids of the conversations that end there, ascending, joined by commas.

    A hash is made of one stream, so the pieces of a key meet in one task; it keeps the state of the hash only.
    """
    last = paths.select("conv_id", *_KEY).join(
        lengths.select("conv_id", F.col("length").alias("depth")), ["conv_id", "depth"], "left_semi"
    )
    zero = F.lit(0).cast("long")
    turnless = lengths.where("length = 0").select("conv_id", *(zero.alias(name) for name in _KEY))
    placed = ordered(last.unionByName(turnless), *_KEY, "conv_id", name="place")
    ids = F.transform(F.sort_array(F.collect_list("conv_id")), lambda x: x.cast("string"))
    texts = placed.groupBy(*_KEY, F.expr(f"place div {PIECE}").alias("piece")).agg(F.array_join(ids, ",").alias("ids"))
    streams = texts.repartition(*_KEY).sortWithinPartitions(*_KEY, "piece").select(*_KEY, "ids")
    return streams.mapInArrow(_streamed_sha256, "depth long, h1 long, h2 long, ends_sha256 string")


def trie(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """The nodes of conversations given as :func:`sequences` gives them (or :func:`grafted`).

    Besides the counts, each node has the hashes ``t1`` and ``t2`` of its last turn, for :func:`with_texts`.
    """
    paths = written(_paths(turns), "paths")
    linked = _linked(_nodes(paths, lengths))
    arcs, children = _tour(linked)
    own = linked.join(children, "node", "left").withColumns(
        {
            "leaf": F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long"),
            "saved": (F.col("n_convs") - 1) * F.col("words"),
        }
    )
    nothing = hashlib.sha256(b"").hexdigest()
    return (
        own.join(_below(arcs, own), "node")
        .join(_ends(paths, lengths), list(_KEY), "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
            *_TURN,
        )
    )


def with_texts(nodes: DataFrame, conversations: DataFrame) -> DataFrame:
    """Nodes with ``role`` and ``text`` of their last turn (null for the root)."""
    turns = conversations.select(
        *_turn_hashes(), *(F.coalesce(F.col(name), F.lit("")).alias(name) for name in ("role", "text"))
    )
    distinct = turns.groupBy(*_TURN).agg(F.first("role").alias("role"), F.first("text").alias("text"))
    return nodes.join(distinct, list(_TURN), "left")


def comparison_sql() -> str:
    """The trie of rebuilt conversations over the table ``conversations`` in SQL."""
    prefix = "list_slice(seq, 1, {})"
    return f"""
        WITH RECURSIVE own AS (
            SELECT conv_id, list(struct_pack(role := COALESCE(role, ''), text := COALESCE(text, ''))
                                 ORDER BY turn NULLS FIRST) AS seq
            FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
        crc AS (
            SELECT conv_id, CAST(conv_id AS VARCHAR) AS name, 0 AS bit, CAST(4294967295 AS BIGINT) AS v FROM own
            UNION ALL
            SELECT conv_id, name, bit + 1,
                   CASE WHEN xor(v, CASE WHEN bit % 8 = 0 THEN ascii(name[bit // 8 + 1]) ELSE 0 END) % 2 = 1
                        THEN xor(xor(v, CASE WHEN bit % 8 = 0 THEN ascii(name[bit // 8 + 1]) ELSE 0 END) >> 1, 3988292384)
                        ELSE xor(v, CASE WHEN bit % 8 = 0 THEN ascii(name[bit // 8 + 1]) ELSE 0 END) >> 1 END
            FROM crc WHERE bit < 8 * len(name)),
        plan AS (SELECT conv_id, (4294967295 - v) % 4 AS h FROM crc WHERE bit = 8 * len(name)),
        conv AS (
            SELECT own.conv_id, list_concat(COALESCE(list_slice(base.seq, 1, h), []),
                                            list_slice(own.seq, h + 1, len(own.seq))) AS seq
            FROM own JOIN plan USING (conv_id) LEFT JOIN own AS base ON base.conv_id = own.conv_id - own.conv_id % 20),
        path AS (SELECT conv_id, len(seq) AS length, d AS depth, {prefix.format("d")} AS prefix
                 FROM conv, unnest(generate_series(0, len(seq))) AS steps(d)),
        node AS (SELECT depth, prefix, MIN(conv_id) AS conv_id, COUNT(*) AS n_convs,
                        sha256(COALESCE(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)
                                        FILTER (WHERE length = depth), '')) AS ends_sha256
                 FROM path GROUP BY depth, prefix),
        valued AS (
            SELECT *, CASE WHEN depth = 0 THEN NULL ELSE list_slice(prefix, 1, depth - 1) END AS above,
                   CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * len(regexp_extract_all(prefix[depth].text, '{WORD}'))
                   END AS saved
            FROM node),
        child AS (SELECT above AS prefix, COUNT(*) AS n_children FROM valued WHERE depth > 0 GROUP BY above),
        counted AS (SELECT valued.*, COALESCE(n_children, 0) AS n_children FROM valued LEFT JOIN child USING (prefix)),
        below AS (SELECT a.depth, a.prefix, SUM(CASE WHEN b.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves,
                         SUM(b.saved) AS saved_tokens
                  FROM counted AS a JOIN counted AS b
                  ON b.depth >= a.depth AND list_slice(b.prefix, 1, a.depth) = a.prefix
                  GROUP BY a.depth, a.prefix)
        SELECT c.conv_id, CAST(c.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, c.n_convs,
               CAST(c.n_children AS BIGINT) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
               CAST(saved_tokens AS BIGINT) AS saved_tokens, c.ends_sha256
        FROM counted AS c JOIN below USING (depth, prefix)
        LEFT JOIN counted AS p ON p.depth = c.depth - 1 AND p.prefix = c.above"""
