"""The training-data operators against the libraries, brute force and exact round trips, on small tables."""

from __future__ import annotations

import hashlib
import random
import re
import struct
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from ordermill.llm import (
    bin_packing,
    chat_grammar,
    imatch,
    jaccard_regions,
    language_filters,
    license_rules,
    onebit_search,
    ordinal_quality,
    segments,
    sentencepiece_rounds,
    token_records,
)
from ordermill.session import shared_folder

WORDS = "the of and reading thing under stone river light maple copper signal harvest violet engine".split()
HARD = [
    None,
    "",
    " ",
    "don't 's 'tis ..'s",
    "a<|endoftext|>b",
    " 1 <|endoftext|> \n<|startoftext|><|endoftext|><|endoftext|>'s <|EndOfText|> <|endoftext",
    "|>begins as the one before ended <|",
    "École Ünï ΣΣ \n\n x ​ 日本",
    "tail \n ",
    "a" * 5000 + " b" * 300,
    "\r\n\t a.b,c d12",
]


def words(n: int, seed: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, text, "en", "extra") for i, text in enumerate(HARD)]
    rows += [(100 + i, words(30 + i, i), "en", "extra") for i in range(20)]
    rows += [(100, words(30, 0), "en", "extra"), (None, "no id", None, "extra")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, ids string")


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, ids string")


def test_segments_give_the_ids_of_whole_texts():
    import pyarrow as pa
    from tokenizers import Tokenizer

    texts = HARD + [words(50, 7)]
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        whole = Tokenizer.from_file(public_tokenizers.path(name))
        table = segments.library_table(public_tokenizers.path(name))
        flat, offsets = segments.utf8(pa.array(texts))
        for _ in range(2):  # from the library, then from the table
            ids, starts = table.gather(*table.slots(flat, offsets))
            for i, text in enumerate(texts):
                expected = whole.encode(text or "", add_special_tokens=False).ids
                assert ids[starts[i] : starts[i + 1]].tolist() == expected


def test_token_records_round_trip(spark, docs, no_docs):
    from tokenizers import Tokenizer

    path = shared_folder(spark, "test-records")
    file = public_tokenizers.path("word_bpe_49k.json")
    token_records.write_records(docs, path, file, end_id=2)
    rows = token_records.read_records(spark, path).orderBy("start").collect()
    whole = Tokenizer.from_file(file)
    assert [r["doc_id"] for r in rows][:3] == [None, 0, 1] and len(rows) == docs.count()
    start, texts = 0, dict(enumerate(HARD))
    for row in rows:
        ids = np.frombuffer(row["ids"], "<u4").tolist()
        assert row["start"] == start and row["n_tokens"] == len(ids) and ids[-1] == 2
        if row["doc_id"] in texts:
            assert ids[:-1] == whole.encode(texts[row["doc_id"]] or "", add_special_tokens=False).ids
        start += len(ids)
    again = token_records.shuffled_records(spark, path, seed=3).collect()
    assert sorted(bytes(r["ids"]) for r in again) == sorted(bytes(r["ids"]) for r in rows)
    empty = shared_folder(spark, "test-records")
    token_records.write_records(no_docs, empty, file, end_id=2)
    assert token_records.read_records(spark, empty).count() == 0


def test_broken_frames_are_found():
    import io

    data = bytearray(token_records.frame(token_records.payload(7, np.arange(5), 2)))
    assert token_records.parse(token_records.read_frame(io.BytesIO(data)))[0] == 7
    data[20] ^= 1
    with pytest.raises(ValueError):
        token_records.read_frame(io.BytesIO(data))


def test_sentencepiece_equals_the_library(spark, docs):
    import sentencepiece

    file = public_tokenizers.path("piece_bpe_32k.model")
    lib = sentencepiece.SentencePieceProcessor(model_file=file)
    rows = {r["doc_id"]: r for r in sentencepiece_rounds.round_trip(docs, file).collect()}
    for i, text in enumerate(HARD):
        ids = lib.encode(text or "")
        assert rows[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert rows[i]["decoded_sha256"] == hashlib.sha256(lib.decode(ids).encode()).hexdigest()
    pairs, rng = sentencepiece_rounds.model(file), random.Random(1)
    for _ in range(300):
        text = "".join(rng.choice([" ", "  ", "a", "the", "é", "\n", "▁", "日", "aaa"]) for _ in range(30))
        import pyarrow as pa

        ids = next(sentencepiece_rounds.encode_column(pa.array([text]), file)).tolist()
        assert ids == lib.encode(text) and pairs.decode(ids) == lib.decode(ids)
        some = [rng.choice([3 + rng.randrange(256), rng.randrange(32000)]) for _ in range(8)]
        assert pairs.decode(some) == lib.decode(some)


def test_imatch_edits_and_equal_texts(spark, docs, no_docs):
    table = docs.where("doc_id >= 100").unionByName(docs.where("doc_id < 3"))
    rows = sorted(imatch.near_report(table, band=(0.0, 1.0)).collect(), key=lambda r: r["doc_id"])
    # rows that repeat id and text each have their row, with the same results
    assert [r["n_rows"] for r in rows if r["doc_id"] == 100] == [2, 2]
    assert len(set(rows)) == len(rows) - 1
    rows = sorted(set(rows), key=lambda r: r["doc_id"])
    texts = {r["doc_id"]: r["text"] or "" for r in table.collect()}
    for row, after in zip(rows, [*rows[1:], rows[0]], strict=True):
        text, half = texts[row["doc_id"]], len(texts[row["doc_id"]]) // 2
        edited = text[: len(text) - half] + texts[after["doc_id"]][:half]
        assert row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert (row["near_edited"] == 1) == (row["fingerprint"] == row["edited_fingerprint"])
    assert rows[0]["fingerprint"] == rows[1]["fingerprint"]  # null and empty
    assert imatch.near_report(no_docs).count() == 0


def test_nearest_finds_most_and_leaves_bad_vectors_out(spark):
    rng = np.random.default_rng(5)
    vectors = rng.standard_normal((1500, 16))
    vectors[700:900] = vectors[700]  # a third of a list in one place
    rows = [(i, v.tolist(), "x") for i, v in enumerate(vectors)]
    rows += [(5000, None, "x"), (5050, [0.0] * 16, "x"), (5100, [float("nan")] * 16, "x"), (5150, [1.0], "x"), (None, [1.0] * 16, "x")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")
    found = onebit_search.nearest(table, F.col("vec_id") % 50 == 0).collect()
    assert {r["query_id"] for r in found} == set(range(0, 1500, 50))
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    hits = 0
    for q in range(0, 1500, 50):
        close = unit @ unit[q]
        close[q] = -9
        own = sorted((r for r in found if r["query_id"] == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == [1, 2, 3, 4, 5]
        hits += sum(close[r["vec_id"]] >= np.sort(close)[-5] - 1e-9 for r in own if r["vec_id"] is not None)
    assert hits >= 0.9 * 150
    assert onebit_search.nearest(table.limit(0), F.lit(True)).count() == 0


def test_license_rules_in_order(spark):
    head = "Licensed under the Apache License, Version 2.0 (the \"License\");\nyou may not use this file except in compliance with the License.\nYou may obtain a copy of the License at\nhttp"
    rows = [(1, head), (2, "x. RELEASED  under the MIT-license!"), (3, "this is licence"), (4, None), (4, ""), (5, "All rights reserved.\nAll rights reserved."), (5, "All rights reserved.\nAll rights reserved.")]
    found = {r["doc_id"]: r for r in license_rules.licences(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {k: r["licences"] for k, r in found.items()} == {1: "Apache-2.0", 2: "MIT", 5: "proprietary"}
    assert found[5]["times"] == 2 and found[5]["n_rules"] == 2


def test_license_notices_are_found_when_wrapped(spark):
    import textwrap

    known = license_rules.SENTENCES
    notices = {
        "Apache-2.0": [known["apache_header"] + ";", known["apache_comply"] + ".", known["apache_copy"] + "\n\n    http://x\n\n", known["apache_as_is"] + "."],
        "MIT": [known["mit_grant"] + ":\n\n", known["mit_notice"] + "."],
        "GPL-2.0-or-later": [known["gpl_free"] + ";", known["gpl_terms2"] + ".\n\n", known["gpl_hope"] + "; without even"],
        "GPL-3.0-or-later": [known["gpl_free"] + ":", known["gpl_terms3"] + ".\n\n", known["gpl_hope"] + "; without even"],
        "BSD": ["Copyright 2020 Somebody\n\n" + known["bsd_grant"] + ":\n\n", "1. Redistributions"],
    }
    cases, rows = [], []
    for licence, parts in notices.items():
        for mark in ("", " * ", "// ", "# ", "; ", "-- ", "| "):
            for width in (30, 72, 80):
                for end in ("\n", "\r\n"):
                    lines = [x for block in " ".join(parts).split("\n\n") for x in [*textwrap.wrap(block, width), ""]]
                    rows.append((len(rows), end.join(f"{mark}{x}" for x in ["int x = 1", "", *lines])))
                    cases.append(licence)
    grant = textwrap.wrap(known["bsd_grant"], 40)
    apart = ["\n\n".join(grant), ".\n".join(grant), "\nx\n".join(grant), "\n".join(grant[::-1]), "\n".join(grant[:-1])]
    rows += [(1000 + i, text) for i, text in enumerate(apart)]
    found = license_rules.licences(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["licences"] for r in found} == dict(enumerate(cases))


def test_fingerprints_have_a_row_for_every_row(spark, monkeypatch):
    monkeypatch.setattr(imatch, "REPEATED", 3)
    rows = [(i, words(40, i)) for i in range(6)] + [(3, words(40, 3))] * 7 + [(None, "none"), (None, "none")]
    rows += [(4, "another text of this id"), (9, "long " * 40_000)]
    found = imatch.near_report(spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n_rows long"))
    got = found.groupBy("doc_id", "n_chars", "n_rows").count().collect()
    assert found.count() == len(rows)
    assert all(r["n_rows"] == r["count"] for r in got)
    assert {(r["doc_id"], r["n_chars"], r["n_rows"]) for r in got} >= {(3, len(words(40, 3)), 8), (None, 4, 2), (9, 200_000, 1)}


def _signed(data: bytes, seed: int = 42) -> int:
    """Spark's xxhash64 of one value, whose seed is the value before it."""
    value = xxhash.xxh64_intdigest(data, seed % (1 << 64))
    return value - (1 << 64) if value >> 63 else value


def _fingerprint(text: str, lexicon: set[int]) -> list[int]:
    def folded(seed: int, values: list[int]) -> int:
        for value in values:
            seed = _signed(struct.pack("<q", value), seed)
        return seed

    every = sorted({_signed(w.encode()) for w in re.findall("[a-z0-9]+", text.lower())})
    kept = [t for t in every if t in lexicon]
    subsets, low = [kept], imatch.SLOT_BITS
    for one_in, number in imatch.SUBSETS:
        subsets += [[t for t in kept if t >> low & (one_in - 1) == k] for k in range(number)]
        low += one_in.bit_length() - 1
    whole = folded(_signed(b"all"), every)
    return [folded(_signed(struct.pack("<i", k)), own) if own else whole for k, own in enumerate(subsets)]


@pytest.mark.parametrize("slot_bits", [24, 8])
def test_fingerprints_are_as_by_brute_force(spark, monkeypatch, slot_bits):
    """With slots for 256 terms only, the terms of a slot are still counted one by one."""
    band = (0.1, 0.3)
    texts = {3 * i: words(5 + 17 * (i % 9), i) for i in range(40)} | {7: "", 8: words(60, 1) + " Extra", 200: words(60, 1)}
    held = {i: {_signed(w.encode()) for w in re.findall("[a-z0-9]+", t.lower())} for i, t in texts.items()}
    times = Counter(t for own in held.values() for t in own)
    lexicon = {t for t, n in times.items() if band[0] <= n / len(texts) <= band[1]}
    assert 20 < len(lexicon) < len(times)
    table = spark.createDataFrame([(i, t or None) for i, t in texts.items()], "doc_id long, text string")
    monkeypatch.setattr(imatch, "SLOT_BITS", slot_bits)
    found = {r["term"] for r in imatch.band_terms(imatch.keyed(table), band).collect()}
    assert found == lexicon
    if slot_bits < 24:
        return
    shown = lambda parts: "-".join(f"{h % (1 << 64):016x}" for h in parts)
    alike = lambda a, b: sum(x == y for x, y in zip(a, b, strict=True)) / imatch.PARTS
    rows = {r["doc_id"]: r for r in imatch.near_report(table, band).collect()}
    ids = sorted(texts)
    for i, after in zip(ids, [*ids[1:], ids[0]], strict=True):
        half = len(texts[i]) // 2
        own, following = _fingerprint(texts[i], lexicon), _fingerprint(texts[after], lexicon)
        edited = _fingerprint(texts[i][: len(texts[i]) - half] + texts[after][:half], lexicon)
        assert rows[i]["fingerprint"] == shown(own) and rows[i]["edited_fingerprint"] == shown(edited)
        assert rows[i]["near_edited"] == alike(own, edited) and rows[i]["near_next"] == alike(own, following)


def test_nearest_answers_every_query(spark):
    """A lone vector far from all others, huge and tiny components, ties and repeated ids."""
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((9, 8))
    some = (centres[rng.integers(0, 9, 3000)] + 0.01 * rng.standard_normal((3000, 8))).tolist()
    rows = [(i + 1, v) for i, v in enumerate(some)]
    rows += [(50_000, [0.0] * 7 + [-5.0]), (50_050, [1e200] * 8), (50_100, [1e-200] * 8), (50_100, [1e-200] * 8)]
    rows += [(60_001, [1.0] * 8), (60_002, [2.0] * 8), (60_003, [1.0] * 8)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = onebit_search.nearest(table, F.col("vec_id") % 50 == 0).collect()
    answers = {}
    for r in found:
        answers.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(answers) == {i for i, _ in rows if i % 50 == 0}
    assert all(sorted(x[0] for x in a) == [1, 2, 3, 4, 5] and all(np.isfinite(x[2]) for x in a) for a in answers.values())
    matrix = np.array([v for _, v in rows])
    unit = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    ids, right, total = np.array([i for i, _ in rows]), 0, 0
    for query, got in answers.items():
        close = unit @ unit[np.flatnonzero(ids == query)[0]]
        close[ids == query] = -2
        least = np.sort(close)[-5] - 1e-9
        right += sum(score >= least for _, _, score in got)
        total += 5
    assert right / total >= 0.9
    same = sorted(answers[50_050])
    assert [x[1] for x in same[:3]] == [50_100, 50_100, 60_001] or [x[1] for x in same[:3]][-1] == 60_001


def test_packing_does_not_depend_on_order_or_partitions(spark, monkeypatch):
    file = public_tokenizers.path("byte_bpe_50k.json")
    monkeypatch.setattr(bin_packing, "ROUND", 500)
    texts = [" the" * 699 for _ in range(600)] + [" the" * 299 for _ in range(600)]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    lengths = bin_packing.pieces(table.limit(1), file, 2, 1024).first()["length"]
    assert lengths == 700
    for parts in (1, 6):
        rows = bin_packing.packed(table.coalesce(1).repartitionByRange(parts, "doc_id"), file).collect()
        filled = {}
        for r in rows:
            filled.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        assert len(rows) == 1200 and len(filled) <= 606  # bound 600
        for places in filled.values():
            ends = [0, *np.cumsum([n for _, n in sorted(places)])]
            assert [at for at, _ in sorted(places)] == ends[:-1] and ends[-1] <= 1024


def test_packing_pieces_are_the_documents(spark):
    import zlib

    from tokenizers import Tokenizer

    file = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(file)
    texts = {1: words(900, 1), 2: None, 3: "", 4: words(30, 4), 5: words(3000, 5), 6: "a <|endoftext|> b" * 200}
    table = spark.createDataFrame([(i, t, 0) for i, t in texts.items()], "doc_id long, text string, row long")
    rows = bin_packing.packed(table, file, capacity=256).collect()
    for i, text in texts.items():
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        mine = sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["piece"])
        assert [r["piece"] for r in mine] == list(range(-(-len(ids) // 256)))
        assert all(r["length"] == 256 for r in mine[1:]) and sum(r["length"] for r in mine) == len(ids)
        for r in mine:
            part = ids[r["start"] : r["start"] + r["length"]]
            assert r["ids_crc32"] == zlib.crc32(part.tobytes())


def test_language_filters(spark, docs):
    def text(alphabet: str, seed: int) -> str:
        rng = random.Random(seed)
        return " ".join("".join(rng.choice(alphabet) for _ in range(rng.randint(2, 7))) for _ in range(60))

    rows = [("xx", text("abcdefgh", i)) for i in range(40)] + [("yy", text("efghijklé", i)) for i in range(40)]
    filters = language_filters.learn(spark.createDataFrame([*rows, (None, "zz"), ("xx", None)], "lang string, text string"))
    names, scores, _ = filters.predict([text("abcdefgh", 99), text("efghijklé", 98), None, " 12 ", "a"])
    assert names == ["xx", "yy", "und", "und", "xx"] and all(0 <= s <= 1 for s in scores)
    found = language_filters.predicted(docs, filters)
    assert found.count() == docs.count()
    nothing = language_filters.learn(docs.where("lang is null").select("lang", "text"))
    assert nothing.predict(["abc"])[0] == ["und"]
    assert language_filters.accepted(docs, filters, 0.0).columns == docs.columns


def test_chat_round_trip(spark):
    rng = random.Random(2)
    bits = ["<|im_end|>", "<|im_start|>", "<", "\\", "|", "assistant", "\n", "\r", "é", "<\\|", "<|nl|>", "<\\\\|", "user"]
    rows = [(c, t, rng.choice(["user", "assistant", "a\nb", "<|im_end|>"]), "".join(rng.choice(bits) for _ in range(9))) for c in range(60) for t in range(3)]
    rows += [(90, None, None, None), (90, 1, "assistant", ""), (91, 1, "user", "x"), (91, 1, "user", "x"), (None, 0, "user", "y")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for row in chat_grammar.read_back(chat_grammar.formatted(table)).collect():
        own = sorted(((t if t is not None else -(2**63), r or "", x or "") for c, t, r, x in rows if c == row["conv_id"]))
        said = "".join(f"{r}\n{x}\n" for _, r, x in own)
        loss = "".join(x for _, r, x in own if r == "assistant")
        assert row["n_turns"] == len(own) and row["loss_chars"] == len(loss)
        assert row["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert row["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    assert chat_grammar.formatted(table.limit(0)).count() == 0


def test_packing_is_exact_and_tight(spark, docs, no_docs):
    file = public_tokenizers.path("byte_bpe_50k.json")
    rows = bin_packing.packed(docs, file, capacity=64).collect()
    by_sequence: dict = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for own in by_sequence.values():
        own.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in own] == np.cumsum([0] + [r["length"] for r in own])[:-1].tolist()
        assert sum(r["length"] for r in own) <= 64
    assert bin_packing.packed(no_docs, file).count() == 0


def test_bin_completion_against_brute_force():
    def fewest(lengths: list[int], capacity: int) -> int:
        best = len(lengths)

        def place(i: int, rooms: list[int]) -> None:
            nonlocal best
            if len(rooms) >= best:
                return
            if i == len(lengths):
                best = len(rooms)
                return
            for j in {r: j for j, r in enumerate(rooms) if r >= lengths[i]}.values():
                place(i + 1, [r - lengths[i] if j == k else r for k, r in enumerate(rooms)])
            place(i + 1, [*rooms, capacity - lengths[i]])

        place(0, [])
        return best

    rng = np.random.default_rng(8)
    for _ in range(60):
        lengths = sorted(rng.integers(1, 18, rng.integers(1, 11)).tolist(), reverse=True)
        counts = np.bincount(lengths, minlength=21)
        bins = bin_packing.pack(counts, 20)
        assert sorted(x for b in bins for x in b) == sorted(lengths) and max(map(sum, bins)) <= 20
        assert bin_packing.lower_bound(counts, 20) <= fewest(lengths, 20) <= len(bins) <= fewest(lengths, 20) + 1


def test_ordinal_quality_held_out(spark):
    from ordermill.llm.tables import read

    folder = "/root/testdata/sf0.1"
    table, labels = read(spark, folder, "documents"), read(spark, folder, "labels")
    model = ordinal_quality.learn(table, labels.where("doc_id % 2 = 0"))
    others = labels.where("doc_id % 2 = 1 and quality is not null and toxic is not null")
    good = (F.col("quality") == 1) & (F.col("toxic") == 0)
    right = ordinal_quality.rated(table, model).join(others, "doc_id").select((F.col("keep") == good).cast("int").alias("right"))
    assert right.agg(F.avg("right")).first()[0] > 0.9
    rated = ordinal_quality.rated(spark.createDataFrame([(1, None), (2, ""), (None, "fine")], "doc_id long, text string"), model)
    assert {r["doc_id"]: r["keep"] for r in rated.collect() if r["doc_id"]} == {1: False, 2: False}


def brute_components(texts: dict[int, str | None], size: int, per_cent: int) -> dict[int, int]:
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for i, text in texts.items():
        found = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(lower))
        sets[i] = {tuple(found[k : k + size]) for k in range(max(1, len(found) - size + 1))} if found else set()
    root = {i: i for i in texts}
    for _ in texts:
        for i in texts:
            for j in texts:
                if sets[i] and 100 * len(sets[i] & sets[j]) >= per_cent * len(sets[i] | sets[j]):
                    root[i] = root[j] = min(root[i], root[j])
    return root


def test_jaccard_components_against_brute_force(spark, docs):
    rng, texts = random.Random(4), {i: t for i, t in enumerate(HARD)}
    for family in range(4):
        base = words(60, 50 + family).split()
        for k in range(40):
            copy = list(base)
            for _ in range(rng.randrange(4)):
                copy[rng.randrange(len(copy))] = f"w{rng.randrange(10**6)}"
            texts[100 * family + 100 + k] = " ".join(copy)
    texts |= {900: "one two", 901: "ONE two", 902: "one two three", 903: words(2000, 9), 904: words(2000, 9)}
    table = spark.createDataFrame([(i, t, "x") for i, t in texts.items()] + [(None, "one two", "x")], "doc_id long, text string, name string")
    found = jaccard_regions.classes(table, 4, 85).collect()
    assert {r["doc_id"]: r["component_id"] for r in found if r["doc_id"] is not None} == brute_components(texts, 4, 85)
    assert [r["component_id"] for r in found if r["doc_id"] is None] == [None]
    assert jaccard_regions.classes(table.limit(0), 4, 85).count() == 0
    kept = jaccard_regions.one_of_each(docs.where("doc_id >= 100"))
    assert kept.count() == 20 and kept.columns == docs.columns


@pytest.mark.parametrize("clusters", [1, 3])
def test_jaccard_rounds_are_exact(spark, monkeypatch, clusters):
    """Regions, pivots, cells and parts of a few sets, so that all kinds of rounds are run."""
    for name, value in {"WHOLE": 8, "PIVOTS": 4, "BLOCK": 16, "PART": 8, "VISITORS": 8, "SHORT": 4}.items():
        monkeypatch.setattr(jaccard_regions, name, value)
    rng, texts = random.Random(clusters), {}
    base = words(60, 77).split()
    for c in range(clusters):
        centre = list(base)
        for k in range(3 * c):  # clusters at distances about the radius
            centre[4 + 5 * k] = f"c{c}x{k}"
        for k in range(60):
            copy = list(centre)
            for _ in range(rng.randrange(5)):
                copy[rng.randrange(len(copy))] = f"w{rng.randrange(10**6)}"
            texts[1000 * c + k] = " ".join(copy)
    table = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in jaccard_regions.classes(table, 4, 85).collect()}
    assert found == brute_components(texts, 4, 85)


def test_jaccard_rounds_have_short_plans(spark, monkeypatch, capsys):
    """The driver holds every plan of a round while it runs: none has a column for each pivot, or a step twice."""
    monkeypatch.setattr(jaccard_regions, "WHOLE", 8)
    plans, write = [], jaccard_regions.written

    def written(df, purpose):
        df.explain()
        plans.append((len(capsys.readouterr().out), purpose))
        return write(df, purpose)

    monkeypatch.setattr(jaccard_regions, "written", written)
    rng, base, texts = random.Random(5), words(60, 78).split(), {}
    for k in range(100):
        copy = list(base)
        for _ in range(rng.randrange(5)):
            copy[rng.randrange(len(copy))] = f"w{rng.randrange(10**6)}"
        texts[k] = " ".join(copy)
    table = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in jaccard_regions.classes(table, 4, 85).collect()}
    assert found == brute_components(texts, 4, 85)
    assert max(plans)[0] < 30_000, max(plans)


def test_near_duplicates_keep_clashing_columns(spark):
    rows = [(1, words(40, 1), 7, "x"), (2, words(40, 1), 8, "y"), (1, words(40, 1), 7, "x"), (3, None, 9, None)]
    table = spark.createDataFrame(rows, "doc_id long, text string, __row long, row_0 string")
    kept = jaccard_regions.one_of_each(table)
    assert kept.columns == table.columns
    assert sorted((r["doc_id"], r["__row"]) for r in kept.collect()) == [(1, 7), (3, 9)]


def test_fewest_shared_shingles_of_all_close_sizes(spark):
    for per_cent in (50, 80, 85, 90, 100):
        sizes = spark.range(1, 900).withColumnRenamed("id", "n")
        for n, fewest in sizes.select("n", jaccard_regions.shared_fewest(F.col("n"), per_cent)).collect():
            close = np.arange(-(-n * per_cent // 100), n * 100 // per_cent + 1)
            assert fewest == jaccard_regions.shared_least(close, per_cent).min(), (per_cent, n)


def test_jaccard_links_sets_of_just_close_sizes(spark):
    texts = {}
    for i, size in enumerate(range(60, 131)):
        for j in range(2):
            own = [f"s{i}x{j}x{k}" for k in range(size * 100 // 85 + 3)]  # size + 3 words have size shingles
            texts |= {10 * i + 2 * j: " ".join(own[: size + 3]), 10 * i + 2 * j + 1: " ".join(own)}
    table = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in jaccard_regions.classes(table, 4, 85).collect()}
    pairs = [{i: texts[i], i + 1: texts[i + 1]} for i in texts if i % 2 == 0]
    assert found == {k: v for pair in pairs for k, v in brute_components(pair, 4, 85).items()}
    assert found == {i: i // 2 * 2 for i in texts}


def test_pipeline_keeps_columns_and_removes_copies(spark):
    import corpus_pipeline
    from ordermill.llm.tables import read

    folder = "/root/testdata/sf0.01"
    table = read(spark, folder, "documents")
    kept = table
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, kept, folder)
        assert after.columns == table.columns, name
        assert after.join(kept, "doc_id", "left_anti").count() == 0
        kept = after
    assert kept.groupBy("text").count().where("count > 1").count() == 0
    rows = corpus_pipeline.packing(spark, kept, folder)
    assert rows.select("doc_id").distinct().count() == kept.count()


def test_written_lets_go_of_unreachable_plans(spark):
    """Plans that only a cycle of Python objects holds are let go with the next written table."""
    import gc
    import weakref

    from ordermill.llm import tables

    class Step:
        pass

    gc.disable()
    try:
        step = Step()
        step.frame, step.itself = spark.range(10), step
        held = weakref.ref(step.frame)
        del step
        assert held() is not None
        assert tables.written(spark.range(3).toDF("n"), "let-go").count() == 3
        assert held() is None
    finally:
        gc.enable()
