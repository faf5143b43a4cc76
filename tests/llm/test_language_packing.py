import random
import struct
import zlib

import numpy as np
import pytest
from llm.frames import clashing, documents, nothing, odd

from brasstally.llm import packing
from brasstally.llm.language_id import UNSEEN, Lattice, fit, identify, keep_identified, predict, public_pieces

PIECES = ["▁a", "▁ab", "b", "c", "bc", "abc", "▁", "x"]


def segmentations(text, pieces):
    if not text:
        yield []
    for k in range(1, len(text) + 1):
        if text[:k] in pieces or k == 1:
            for rest in segmentations(text[k:], pieces):
                yield [text[:k], *rest]


@pytest.mark.parametrize("word", ["a", "ab", "abc", "abcbc", "xyx", "cabcabcabc"])
def test_scores_sum_over_segmentations(word):
    pieces = [p for p in PIECES if p != "▁"]
    lattice = Lattice(pieces)
    probs = np.random.default_rng(0).dirichlet(np.ones(len(pieces)), 3).T
    probs = np.vstack([probs, np.full(3, UNSEEN)])
    want = np.zeros(3)
    for parts in segmentations("▁" + word, set(pieces)):
        want += np.prod([probs[lattice.index.get(p, len(pieces))] for p in parts], axis=0)
    assert np.allclose(lattice.score([word, word], probs), np.log(want))


def test_long_words_stay_finite():
    lattice = Lattice(public_pieces())
    probs = np.full((len(lattice.index) + 1, 2), 1e-5)
    assert np.isfinite(lattice.score(["ab" * 5000, "é" * 100], probs)).all()


def test_expected_uses_are_those_of_all_segmentations():
    pieces = [p for p in PIECES if p != "▁"]
    lattice, uses = Lattice(pieces), {}
    column = [0.1 + 0.01 * k for k in range(len(pieces))] + [UNSEEN]
    lattice.expected("abcbc", column, 2.0, uses)
    total, want = 0.0, {}
    for parts in segmentations("▁abcbc", set(pieces)):
        ids = [lattice.index.get(p, len(pieces)) for p in parts]
        weight = np.prod([column[i] for i in ids])
        total += weight
        for i in ids:
            want[i] = want.get(i, 0) + 2 * weight
    assert {k: pytest.approx(v) for k, v in uses.items()} == {k: v / total for k, v in want.items() if k < len(pieces)}


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = identify(docs).toPandas().merge(documents(spark, folder), on="doc_id")
    held = got[got.held_out]
    assert all(h == (zlib.crc32(str(i).encode()) % 5 == 0) for i, h in zip(got.doc_id, got.held_out))
    assert (held.lang == held.lang_pred).mean() > 0.98 and got.score.between(0, 1).all()


def test_language_of_odd_rows(spark):
    for frame in (odd, clashing):
        got = {(r["doc_id"], r["lang_pred"]) for r in identify(frame(spark)).collect()}
        assert {(3, "und"), (4, "und"), (5, "und"), (6, "und"), (7, "en")} <= got
        kept = keep_identified(frame(spark))
        assert kept.columns == frame(spark).columns and sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 2, 2, 7]
    assert identify(nothing(spark)).count() == 0
    unlabelled = odd(spark).selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert {r["lang_pred"] for r in identify(unlabelled).collect()} == {"und"}
    assert predict(odd(spark), fit(odd(spark))).columns == [*odd(spark).columns, "lang_pred", "score"]


def test_word_ids_are_the_tokenizers(spark):
    words = packing.WordIds(packing.word_vocabulary(), remember=50)
    texts = [*documents(spark, "/root/testdata/sf0.001").text[:60], "", " \n", "I'm ΣΑΣ e ́ f́ \x85 日本 12.5 ﬁ İ <|endoftext|>x <| ª º. µ it's. 's. a.b. é."]
    for text in texts:
        ids = words.tokenizer.encode(text, add_special_tokens=False).ids
        assert words.ids(text) == struct.pack(f"<{len(ids)}I", *ids)


def test_first_fit_decreasing_by_scan():
    r = random.Random(5)
    lengths = sorted((r.randint(1, 100) for _ in range(500)), reverse=True)
    room, bins = [], []
    for n in lengths:
        k = next((k for k, x in enumerate(room) if x >= n), len(room))
        if k == len(room):
            room.append(100)
        room[k] -= n
        bins.append(k)
    got, offsets, used = packing.first_fit_decreasing(lengths, 100)
    assert got == bins and used == len(room)
    ends = {}
    for k, o, n in zip(got, offsets, lengths):
        assert o == ends.get(k, 0)
        ends[k] = o + n


@pytest.mark.parametrize("group_rows", [4096, 20])
def test_packing_is_a_round_trip(spark, small, group_rows):
    pdf = documents(spark, small)
    got = packing.pack(spark.createDataFrame(pdf), group_rows=group_rows, with_ids=True).toPandas()
    words = packing.WordIds(packing.word_vocabulary())
    for doc_id, pieces in got.sort_values("start").groupby("doc_id"):
        ids = [i for p in pieces.ids for i in p]
        text = pdf.text[pdf.doc_id == doc_id].iloc[0]
        assert struct.pack(f"<{len(ids)}I", *ids) == words.ids(text) + struct.pack("<I", 1)
        assert list(pieces.start) == [0, *np.cumsum(pieces.length)[:-1]] and set(pieces.doc_tokens) == {len(ids)}
        assert all(zlib.crc32(struct.pack(f"<{len(p)}I", *p)) == c for p, c in zip(pieces.ids, pieces.ids_crc32))
    assert set(got.doc_id) == set(pdf.doc_id)
    for _, bin_ in got.sort_values("offset").groupby("sequence_id"):
        assert list(bin_.offset) == [0, *np.cumsum(bin_.length)[:-1]] and bin_.length.sum() <= 2048


def test_packing_of_odd_rows(spark):
    got = packing.pack(clashing(spark)).toPandas()
    assert len(got[got.doc_id == 2]) == 2 and got[got.doc_id == 3].doc_tokens.tolist() == [1]
    assert got.groupby("sequence_id").length.sum().max() <= 2048
    assert packing.pack(nothing(spark)).count() == 0
