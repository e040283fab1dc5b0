"""The digest index, the conversation trie and ranked search against brute force, on small tables."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ordermill.llm import conversation_trie, digest_index, list_ranking, ordering, term_ranking
from ordermill.llm.tables import written
from ordermill.session import shared_folder

DOCS = "doc_id long, text string, row string, digest string"


# --- digest index -------------------------------------------------------------------------------


def spaced(text: str | None) -> str:
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def same_texts(rows):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[spaced(text)].append(doc_id)
    return groups


ROWS = [
    (5, "a  b", "x", "y"),
    (3, "a\t\nb", "x", "y"),
    (9, "a b", "x", "y"),
    (1, None, "x", "y"),
    (2, "", "x", "y"),
    (4, " ", "x", "y"),
    (8, " a b", "x", "y"),  # an outer space stays
    (6, "a b", "x", "y"),  # no-break spaces are no spaces here
    (7, "z" * 200_000, "x", "y"),
    (11, "z" * 200_000, "x", "y"),
    (12, "twice", "x", "y"),
    (12, "twice", "x", "y"),
    (None, "only without id", "x", "y"),
    (None, "a b", "x", "y"),
] + [(100 + i, "hot text", "x", "y") for i in range(40)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS)


def indexed(spark, docs, parts):
    rows = digest_index.digests(docs)
    index = digest_index.DigestIndex(spark, shared_folder(spark, "index"), buckets=4)
    for part in parts(rows):
        index.add(part)
    return index, rows


@pytest.mark.parametrize("parts", [digest_index.in_two_deliveries, lambda rows: [rows]])
def test_one_row_of_each_text_stays(spark, docs, parts):
    index, rows = indexed(spark, docs, parts)
    found = digest_index.report(rows, index).collect()
    assert len(found) == len(ROWS)
    groups = {hashlib.sha256(text.encode()).hexdigest(): ids for text, ids in same_texts(ROWS).items()}
    for row in found:
        ids = groups[row["text_sha256"]]
        known = [i for i in ids if i is not None]
        assert row["group_size"] == len(ids)
        assert row["keep_id"] == (min(known) if known else None)
        assert not row["kept"] or row["doc_id"] == row["keep_id"]
    kept = [row["text_sha256"] for row in found if row["kept"]]
    assert sorted(kept) == sorted(groups)  # one of each, also among equal ids and without any


def test_index_lasts_and_is_added_to_once(spark, docs):
    index, rows = indexed(spark, docs, lambda rows: [rows])
    size = index.entries().count()
    index.add(rows)  # again, as after a failure
    assert index.entries().count() == size == len(same_texts(ROWS))
    path = spark.sql(f"DESCRIBE FORMATTED {index.table}").where("col_name = 'Location'").first()["data_type"]
    spark.sql(f"DROP TABLE {index.table}")  # the files stay
    again = digest_index.DigestIndex(spark, path.removesuffix("/entries").removeprefix("file:"), buckets=9)
    assert again.buckets == 4 and again.entries().count() == size
    later = spark.createDataFrame([(0, "a b", "", ""), (1000, "new", "", "")], DOCS)
    new = digest_index.kept_documents(later, again)
    assert [tuple(r) for r in new.collect()] == [(1000, "new", "", "")] and new.columns == later.columns
    assert again.entries().count() == size + 1


def test_anti_join_reads_the_index_as_it_lies(spark, docs):
    index, rows = indexed(spark, docs, digest_index.in_two_deliveries)
    plan = index.unseen(rows)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "LeftAnti" in plan
    scan = next(line for line in plan.splitlines() if index.table in line or "Bucketed: true" in line)
    assert "Bucketed: true" in plan or "SelectedBucketsCount: 4 out of 4" in plan, scan


def test_empty_table_of_documents(spark):
    none = spark.createDataFrame([], DOCS)
    index, rows = indexed(spark, none, digest_index.in_two_deliveries)
    assert digest_index.report(rows, index).count() == 0 and index.entries().count() == 0
    assert digest_index.kept_documents(none, index).count() == 0


# --- places, running values, list ranking -------------------------------------------------------


def test_places_and_running_values(spark):
    rng = random.Random(3)
    rows = [(rng.choice("abc") if rng.random() < 0.5 else "a", rng.randrange(50), rng.randrange(1, 99)) for _ in range(500)]
    df = spark.createDataFrame(rows, "k string, v long, w long").repartition(5)
    placed = written(ordering.ordered(df, "k", "v", name="place"), "test")
    got = placed.orderBy("place").collect()
    assert [r["place"] for r in got] == list(range(500))
    assert [(r["k"], r["v"]) for r in got] == sorted((k, v) for k, v, _ in rows)
    out = ordering.running(placed, "place", {"s": "w"}, block=7).orderBy("place").collect()
    assert [r["s"] for r in out] == list(np.cumsum([r["w"] for r in out]))
    out = ordering.running(
        placed, "place", {"x": "w"}, total=F.bit_xor, add=lambda a, b: a.bitwiseXOR(b), within=("k",), block=7
    )
    for key in "abc":
        mine = out.where(F.col("k") == key).orderBy("place").collect()
        assert [r["x"] for r in mine] == list(np.bitwise_xor.accumulate([r["w"] for r in mine]))


@pytest.mark.parametrize("shuffled", [False, True])
def test_list_ranks_with_small_blocks(spark, shuffled):
    items = list(range(300))
    if shuffled:
        random.Random(1).shuffle(items)
    links = written(
        spark.createDataFrame(list(zip(items, [*items[1:], None], strict=True)), "item long, after long"), "test"
    )
    got = {r["item"]: r["rank"] for r in list_ranking.ranks(links, block=16, last=20).collect()}
    assert [got[item] for item in items] == list(range(300))


def test_empty_list(spark):
    assert list_ranking.ranks(spark.createDataFrame([], "item long, after long")).count() == 0


# --- conversation trie --------------------------------------------------------------------------

TALK = "conv_id long, turn long, role string, text string, depth string, h1 string, node string"


def talks():
    rng = random.Random(7)
    rows = []
    for c in range(130):
        if c in (40, 77):
            continue  # an absent first conversation of a family, and another one
        length = 60 if c == 33 else rng.choice([0, 1, 1, 2, 3, 4, 6])
        for turn in range(length):
            text = rng.choice(["hi", "hi there  you", "", None, "same words again"])
            rows.append((c, turn * 2, rng.choice(["user", "user", None]), text))
    rows += [(200, None, "user", "null first"), (200, 0, "user", "hi"), (200, 0, "user", "hi")]  # null and repeated
    rows += [(300, 0, "user", "word " * 50_000), (301, 0, "user", "word " * 50_000)]
    rows += [(None, 0, "user", "no id"), (2**40, 0, "us", "er"), (2**40 + 1, 0, "use", "r")]
    return [(*row, "x", "y", "z") for row in rows]


def brute_trie(rows):
    own = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            own[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [(role, text) for _, role, text in sorted(turns, key=lambda t: t[0])] for c, turns in own.items()}
    conv = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        conv[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in conv.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    out = {}
    for node in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        ends = ",".join(str(c) for c in sorted(members[node]) if len(conv[c]) == len(node))
        leaves = sum(out[k][5] for k in kids[node]) if kids[node] else 1
        saved = (len(members[node]) - 1) * words + sum(out[k][6] for k in kids[node])
        parent = min(members[node[:-1]]) if node else None
        out[node] = (
            min(members[node]), len(node), parent, len(members[node]), len(kids[node]), leaves, saved,
            hashlib.sha256(ends.encode()).hexdigest(),
        )
    return sorted(out.values(), key=str)


def trie_of(df):
    return conversation_trie.trie(*conversation_trie.grafted(*conversation_trie.sequences(df)))


@pytest.mark.parametrize("small", [False, True])
def test_trie_is_as_by_brute_force(spark, monkeypatch, small):
    if small:  # blocks, pieces and lists of a few rows, so that every step has several
        monkeypatch.setattr(conversation_trie, "PIECE", 3)
        ranks = list_ranking.ranks
        monkeypatch.setattr(list_ranking, "ranks", lambda links: ranks(links, block=8, last=8))
        run = ordering.running
        monkeypatch.setattr(conversation_trie, "running", lambda *a, **b: run(*a, block=5, **b))
    rows = talks()
    nodes = trie_of(spark.createDataFrame(rows, TALK).repartition(3))
    got = sorted((tuple(r) for r in nodes.drop("t1", "t2").collect()), key=str)
    assert got == brute_trie(rows)


def test_texts_of_nodes(spark):
    df = spark.createDataFrame(talks(), TALK)
    nodes = conversation_trie.with_texts(conversation_trie.trie(*conversation_trie.sequences(df)), df)
    found = {(r["conv_id"], r["depth"]): (r["role"], r["text"]) for r in nodes.collect()}
    assert found[(2**40, 1)] == ("us", "er") and found[(2**40 + 1, 1)] == ("use", "r")
    assert found[(200, 1)] == ("user", "null first") and found[(0 if (0, 0) in found else 1, 0)] == (None, None)


def test_no_conversations(spark):
    assert trie_of(spark.createDataFrame([], TALK)).count() == 0
    assert trie_of(spark.createDataFrame([(None, 0, "a", "b", "", "", "")], TALK)).count() == 0


# --- ranked search ------------------------------------------------------------------------------

SIGNS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return SIGNS.findall((text or "").translate(UPPER))


def brute_ranking(docs, items, k):
    held = [(doc_id, terms(text)) for doc_id, text in docs]
    held = [(doc_id, found) for doc_id, found in held if found]
    n_docs, length = len(held), sum(len(found) for _, found in held)
    df = defaultdict(int)
    for _, found in held:
        for term in set(found):
            df[term] += 1
    asked = defaultdict(set)
    for item, text in items:
        asked[item] |= set(terms(text))
    out = []
    for item, words in asked.items():
        scores = []
        for doc_id, found in held:
            m = 10 + (90 * len(found) * n_docs) // length
            score = 0
            for term in words & set(found):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                tf = found.count(term)
                score += w * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0))
        out += [
            (item, rank + 1, None if empty else doc_id, -score)
            for rank, (score, empty, doc_id) in enumerate(sorted(scores)[:k])
        ]
    return sorted(out, key=str)


def corpus():
    rng = random.Random(11)
    names = [f"w{i}" for i in range(300)]
    pick = lambda n: " ".join(rng.choices(names, weights=[1 / (i + 1) for i in range(300)], k=n))
    docs = [(i, pick(rng.randrange(1, 60))) for i in range(400)]
    docs += [(1000 + i, "Equal equal W7") for i in range(15)] + [(1000, "Equal equal W7")]  # ties, a repeated row
    docs += [(None, "equal w7 w8"), (None, None), (2000, None), (2001, ""), (2002, "?! \n"), (2003, "ÄB äb Äb日本 É")]
    docs += [(2004, "w250," * 30_000)]
    items = [(i, pick(25)) for i in range(30)]
    items += [(50, "EQUAL w7"), (51, None), (52, "..."), (53, "äb Äb日本"), (54, "nowhere"), (None, "w3 w299")]
    items += [(55, "w1 w2"), (55, "w9 w200")]  # rows of one item
    return docs, items


def ranked(spark, docs, items, k=10, parts=3):
    docs = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, term string, n long")
    items = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, score string")
    found = term_ranking.ranking(docs.repartition(parts), items, k)
    return sorted((tuple(r) for r in found.collect()), key=str)


@pytest.mark.parametrize("k", [1, 10])
def test_ranking_is_as_by_brute_force(spark, k):
    docs, items = corpus()
    assert ranked(spark, docs, items, k) == brute_ranking(docs, items, k)


def test_ranking_in_blocks_of_items_and_pieces_of_texts(spark, monkeypatch):
    monkeypatch.setattr(term_ranking, "BLOCK_TERMS", 60)
    docs, items = corpus()
    assert ranked(spark, docs, items) == brute_ranking(docs, items, 10)
    text = b"ab cd," * 1000 + b"x" * 500 + b" end"
    for size in (1, 7, 64, 10_000):
        assert b"".join(term_ranking.pieces(text, size)) == text
        found = [term for piece in term_ranking.pieces(text, size) for term in term_ranking.TERM.findall(piece)]
        assert found == term_ranking.TERM.findall(text)


def test_accumulators_are_limited(spark):
    """Once the terms to come cannot lift a new document among the best, none is created any more."""
    documents = 2000
    rare, common = np.arange(20), np.arange(documents)
    doc = np.concatenate([rare, rare, common])
    term = np.concatenate([np.zeros(20, int), np.ones(20, int), np.full(documents, 2)])
    work = term_ranking.Accumulators([np.array([0, 1, 2])], np.array([5000, 5000, 10]), 10)
    work.index(np.full(documents, 100), doc, term, np.ones(len(doc), np.int64))
    found, scores = work.best(0)
    assert work.created == 40 and work.updated == 20
    part = 1_000_000_000 // 1800
    assert sorted(found) == list(rare) and set(scores) == {10_010 * part}


def test_ranking_of_empty_tables(spark):
    docs, items = corpus()
    assert ranked(spark, [], items) == [] and ranked(spark, docs, []) == []
    assert ranked(spark, [(1, None)], items) == []
