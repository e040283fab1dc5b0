"""Whole results of language identification, quality and the pipeline against plain Python over the smallest tables."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from ordermill.llm import bin_packing, language_filters, ordinal_quality, queries
from ordermill.llm.tables import read

FOLDER = "/root/testdata/sf0.001"
ALL = (1 << 64) - 1
ROOT = 0x9E3779B97F4A7C15


def rows_of(df) -> list[tuple]:
    return [tuple(r) for r in df.collect()]


# language identification


def plain_grams(text: str | None) -> list[tuple]:
    signs = ["", *(x if x.isalpha() else "" for x in (text or "").lower()), ""]
    windows = (tuple(signs[i : i + 4]) for i in range(len(signs) - 3))
    return [w for w in windows if w[1] and w[2]]


class PlainLanguages:
    """Sets of n-grams in place of filters."""

    def __init__(self, training: list[tuple[str | None, str | None]]):
        counts, self.texts = defaultdict(Counter), Counter()
        for lang, text in training:
            if lang is not None:
                counts[lang].update(plain_grams(text))
                self.texts[lang] += 1
        self.langs, self.held, self.covered = sorted(self.texts), {}, {}
        for lang in self.langs:
            total = sum(counts[lang].values())
            own = {g: n for g, n in counts[lang].items() if n >= total * language_filters.LEAST_SHARE}
            self.held[lang], self.covered[lang] = set(own), sum(own.values()) / total if total else 1.0

    def predict(self, text: str | None) -> tuple[str, float, int, float]:
        """Language, score, number of n-grams and lead over the second language."""
        found = plain_grams(text)
        if not self.langs or not any(x.isalpha() for x in (text or "").lower()):
            return "und", 0.0, len(found), 1.0
        hits = {lang: sum(g in self.held[lang] for g in found) / self.covered[lang] for lang in self.langs}
        if not any(hits.values()):
            return max(self.langs, key=lambda x: self.texts[x]), 0.0, len(found), 1.0
        best = max(self.langs, key=lambda x: hits[x])
        second = max([n for lang, n in hits.items() if lang != best], default=0)
        return best, min(1.0, hits[best] / len(found)), len(found), (hits[best] - second) / len(found)


def test_languages_of_every_document_are_as_by_sets_of_grams(spark):
    docs = rows_of(read(spark, FOLDER, "documents").select("doc_id", "lang", "text"))
    apart = {i for i, _, _ in docs if i is not None and zlib.crc32(str(i).encode()) % 5 == 0}
    plain = PlainLanguages([(lang, text) for i, lang, text in docs if i not in apart])
    found = {r["doc_id"]: r for r in queries.op6_language_id(spark, FOLDER).collect()}
    assert len(found) == len(docs) and apart
    for i, _, text in docs:
        name, score, _, lead = plain.predict(text)
        assert found[i]["held_out"] == (i in apart)
        assert abs(found[i]["score"] - score) < 0.01
        assert found[i]["lang_pred"] == name or lead < 0.01


def test_languages_with_empty_tables_ties_long_texts_and_clashing_columns(spark):
    training = spark.createDataFrame([("b", "abcd"), ("a", "abcd"), ("c", "xyzw " * 50)], "lang string, text string")
    filters = language_filters.learn(training)
    assert filters.predict(["abcd"])[0] == ["a"]  # a tie goes to the first by name
    names, scores, _ = filters.predict(["xyzw " * 300_000, "", "日"])
    assert names == ["c", "und", "a"] and scores[0] > 0.9 and scores[1:] == [0.0, 0.0]
    assert language_filters.learn(training.limit(0)).predict(["abcd", None])[0] == ["und", "und"]
    rows = [(1, "abcd abcd", 5, "q", "w"), (1, "abcd abcd", 5, "q", "w"), (None, "abcd", 6, None, None), (2, None, 7, "q", "w")]
    table = spark.createDataFrame(rows, "doc_id long, text string, gram long, lang_pred string, slot string")
    kept = language_filters.accepted(table, filters, 0.3)
    assert kept.columns == table.columns and sorted(r["gram"] for r in kept.collect()) == [5, 5, 6]
    assert language_filters.predicted(table, filters).count() == 4
    assert language_filters.predicted(table.limit(0), filters).count() == 0


# quality


def plain_hash(data: bytes) -> int:
    mixed = sum((b + 1) * pow(ROOT, k, 1 << 64) for k, b in enumerate(data)) & ALL
    mixed = (mixed ^ mixed >> 31) * 0xBF58476D1CE4E5B9 & ALL
    return mixed ^ mixed >> 29


def plain_features(text: str | None) -> tuple[list[int], int]:
    """Places of a text's features and its number of words."""
    data = (text or "").encode()
    lower = bytes(b + 32 if 65 <= b <= 90 else b for b in data)
    words = re.findall(rb"[0-9a-z\x80-\xff]+", lower)
    hashes = [plain_hash(w) for w in words]
    distinct = {h >> 24 for h in hashes}
    found = list(distinct)
    for size in ordinal_quality.STEMS:
        found += {((plain_hash(w[:size]) + size) & ALL) >> 24 for w in words if len(w) > size}
    kinds = bytes(
        65 if 65 <= b <= 90 else 97 if 97 <= b <= 122 or b >= 128 else 48 if 48 <= b <= 57 else 32 if b in b"\t\n\x0b\x0c\r " else b
        for b in data
    )
    shapes = re.sub(rb"(.)\1+", rb"\1", kinds, flags=re.DOTALL).split(b" ")
    for shape, times in Counter(plain_hash(s) >> 24 for s in shapes if s).items():
        for step in range(times.bit_length()):
            found.append(((shape + step * 7919 + 1) * ROOT & ALL) >> 24)
    size, number = max(len(data), 1), max(len(words), 1)
    shares = [sum(b in kind for b in kinds) / size for kind in ordinal_quality._KINDS.values()]
    shares += [len(distinct) / number, sum(a == b for a, b in zip(hashes, hashes[1:])) / number]
    for k, share in enumerate(shares):
        found.append(((1_000_003 * (k + 1) + min(int(share * 20), 20)) * ROOT & ALL) >> 24)
    return [f % ordinal_quality.FEATURES for f in found], len(words)


def logistic(x: float) -> float:
    return 1 / (1 + math.exp(-max(-50.0, min(50.0, x))))


def plain_fit(rows: list[list[int]], grades: list[int]) -> tuple[dict[int, float], list[float]]:
    """The model's steps, one document and one weight at a time."""
    weights, squares, below = defaultdict(float), defaultdict(lambda: 1e-8), []
    for k in range(2):
        share = (sum(g <= k for g in grades) + 1) / (len(grades) + 3)
        below.append(math.log(share / (1 - share)))
    below_squares, rng = [1e-8, 1e-8], np.random.default_rng(20)
    for epoch in range(ordinal_quality.EPOCHS):
        rate, order = ordinal_quality.RATE / (1 + 0.3 * epoch), rng.permutation(len(rows))
        for low in range(0, len(order), 64):
            part, slopes, moves = order[low : low + 64], defaultdict(float), [0.0, 0.0]
            for i in part:
                score, y = sum(weights[f] for f in rows[i]), grades[i]
                up_to = [0.0, *(logistic(b - score) for b in below), 1.0]
                chance = max(up_to[y + 1] - up_to[y], 1e-9)
                steep = [p * (1 - p) for p in up_to]
                for f in rows[i]:
                    slopes[f] += (steep[y + 1] - steep[y]) / chance / len(part)
                for k in range(2):
                    moves[k] += ((y == k + 1) - (y == k)) * steep[k + 1] / chance / len(part)
            for f, slope in slopes.items():
                squares[f] += slope**2
                step = rate / math.sqrt(squares[f])
                moved = weights[f] - step * slope
                weights[f] = math.copysign(max(abs(moved) - step * ordinal_quality.DECAY, 0.0), moved)
            for k in range(2):
                below_squares[k] += moves[k] ** 2
                below[k] -= rate * moves[k] / math.sqrt(below_squares[k])
            below[1] = max(below)
    return weights, below


def plain_ratings(docs: list[tuple], labels: list[tuple]) -> list[tuple[float, float]]:
    """Expected grade and probability of the top grade of each (doc_id, text)."""
    features = [plain_features(text) for _, text in docs]
    by_id = {i: k for k, (i, _) in enumerate(docs)}
    graded = sorted(
        {(i, 0 if quality == 0 else 1 if toxic == 1 else 2) for i, quality, toxic in labels if None not in (i, quality, toxic) and i in by_id}
    )
    own = [features[by_id[i]][0] for i, _ in graded]
    times = Counter(f for row in own for f in set(row))
    weights, below = plain_fit([[f for f in row if times[f] >= ordinal_quality.OCCURS] for row in own], [g for _, g in graded])
    out = []
    for places, number in features:
        score = sum(weights.get(f, 0.0) for f in places)
        tails = [logistic(score - b) for b in below] if number else [0.0, 0.0]
        out.append((sum(tails), tails[1]))
    return out


def test_ratings_of_every_document_are_as_by_plain_steps(spark):
    docs = rows_of(read(spark, FOLDER, "documents").select("doc_id", "text"))
    plain = plain_ratings(docs, rows_of(read(spark, FOLDER, "labels").select("doc_id", "quality", "toxic")))
    found = {r["doc_id"]: r for r in queries.op9_ordinal_quality(spark, FOLDER).collect()}
    assert len(found) == len(docs)
    for (i, _), (expected, top) in zip(docs, plain, strict=True):
        assert abs(found[i]["expected_grade"] - expected) < 0.02 and abs(found[i]["top_probability"] - top) < 0.02
        assert found[i]["keep"] == (top >= ordinal_quality.LEAST) or abs(top - ordinal_quality.LEAST) < 0.02


def test_features_of_odd_texts(spark):
    texts = [None, "", " ", "!!", "Aa1 é É a a a", "##  ##\t##", "x" * 70_000, "abcdefg abcdefh", "aA" * 500]
    flat = "".join(t or "" for t in texts).encode()
    offsets = np.concatenate([[0], np.cumsum([len((t or "").encode()) for t in texts])])
    row, place, number = ordinal_quality.features(np.frombuffer(flat, np.uint8), offsets)
    for i, text in enumerate(texts):
        places, words = plain_features(text)
        assert number[i] == words and sorted(place[row == i].tolist()) == sorted(places)


def test_ratings_of_empty_tables_repeated_labels_and_clashing_columns(spark):
    rows = [(1, "fine words here", 1, 2, "s"), (1, "fine words here", 1, 2, "s"), (None, "no id", 3, 4, None), (2, None, 5, 6, "s")]
    table = spark.createDataFrame(rows, "doc_id long, text string, grade int, same long, places string")
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (1, 0, 0), (2, 1, 1), (9, 1, 0), (None, 1, 0), (1, None, 0)], "doc_id long, quality int, toxic int")
    model = ordinal_quality.learn(table, labels)
    rated = ordinal_quality.rated(table, model).collect()
    assert len(rated) == 4 and len({(r["expected_grade"], r["keep"]) for r in rated if r["doc_id"] == 1}) == 1
    assert ordinal_quality.kept(table, model).columns == table.columns
    assert ordinal_quality.rated(table.limit(0), model).count() == 0
    nothing = ordinal_quality.learn(table.limit(0), labels)
    assert sorted(str(r["doc_id"]) for r in ordinal_quality.kept(table, nothing).collect()) == ["1", "1", "None"]
    unlabelled = ordinal_quality.learn(table, labels.limit(0))
    assert ordinal_quality.kept(table, unlabelled).count() == 3


# the pipeline


def smallest_of_classes(texts: dict[int, str], size: int, per_cent: int) -> set[int]:
    """Ids without a smaller one among those they reach by links."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets, root = {}, {i: i for i in texts}
    for i, text in texts.items():
        found = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(lower))
        sets[i] = {tuple(found[k : k + size]) for k in range(max(1, len(found) - size + 1))} if found else set()

    def top(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    for i in sorted(texts):
        for j in sorted(texts):
            if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= per_cent * len(sets[i] | sets[j]):
                a, b = sorted((top(i), top(j)))
                root[b] = a
    return {i for i in texts if root[i] == i}


def test_pipeline_is_as_by_brute_force(spark):
    from tokenizers import Tokenizer

    docs = read(spark, FOLDER, "documents")
    rows = rows_of(docs.select("doc_id", "lang", "text"))
    text = {i: t for i, _, t in rows}

    plain = PlainLanguages([(lang, t) for _, lang, t in rows])
    guesses = {i: plain.predict(t) for i, t in text.items()}
    known = {i for i, (name, score, number, _) in guesses.items() if name != "und" and (score >= corpus_pipeline.KNOWN or not number)}
    close = {i for i, g in guesses.items() if abs(g[1] - corpus_pipeline.KNOWN) < 0.01 and g[2]}
    some = corpus_pipeline.language_id(spark, docs, FOLDER)
    after = {r["doc_id"] for r in some.collect()}
    assert after ^ known <= close

    order = sorted(after)
    labels = rows_of(read(spark, FOLDER, "labels").select("doc_id", "quality", "toxic"))
    tops = dict(zip(order, (top for _, top in plain_ratings([(i, text[i]) for i in order], labels)), strict=True))
    some = corpus_pipeline.quality(spark, some, FOLDER)
    after = {r["doc_id"] for r in some.collect()}
    assert after ^ {i for i, top in tops.items() if top >= 0.5} <= {i for i, top in tops.items() if abs(top - 0.5) < 0.02}

    alone = smallest_of_classes({i: text[i] for i in after}, 5, 80)
    some = corpus_pipeline.near_duplicates(spark, some, FOLDER)
    assert sorted(r["doc_id"] for r in some.collect()) == sorted(alone)

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces, lengths = [], Counter()
    for i in alone:
        ids, low, number = [*library.encode(text[i], add_special_tokens=False).ids, 2], 0, 0
        while low < len(ids):
            size = (len(ids) - low - 1) % 1024 + 1 if not number else 1024
            pieces.append((i, number, low, size, zlib.crc32(np.array(ids[low : low + size], "<u4").tobytes())))
            lengths[size] += 1
            low, number = low + size, number + 1
    found = corpus_pipeline.run(spark, FOLDER).collect()
    assert sorted(tuple(r)[:5] for r in found) == sorted(pieces)
    sequences = defaultdict(list)
    for r in found:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        places.sort()
        assert all(a + n == b for (a, n), (b, _) in zip(places, [*places[1:], (sum(n for _, n in places), 0)], strict=True))
        assert places[0][0] == 0 and sum(n for _, n in places) <= 1024
    counts = np.array([lengths[n] for n in range(1025)])
    assert len(sequences) <= 1.02 * bin_packing.lower_bound(counts, 1024) + 1


@pytest.mark.parametrize("rows", [[], [(1, None, None, None, 1, "x"), (None, None, "en", None, 2, None), (2, "", "en", "s", 3, "")]])
def test_pipeline_of_empty_and_null_tables(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, row long, sequence_id string")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, FOLDER)
        assert after.columns == docs.columns and after.count() == 0
        docs = after
    assert corpus_pipeline.packing(spark, docs, FOLDER).count() == 0


def test_pipeline_of_repeated_rows_and_clashing_columns(spark):
    words = " ".join(f"harvest{i % 7} stone light river" for i in range(40))
    rows = [(i, words if i % 2 else words + " end", "en", i, "x", i) for i in (1, 1, 2, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, row long, sequence_id string, grade long")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER)
        assert docs.columns == ["doc_id", "text", "lang", "row", "sequence_id", "grade"]
    assert docs.count() <= 1  # quality may reject it, copies never stay
    assert corpus_pipeline.packing(spark, docs, FOLDER).select("doc_id").distinct().count() == docs.count()
