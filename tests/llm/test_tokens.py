"""Token counts, pieces and packing against plain versions."""

import random
import time
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from headway.llm.packing import LENGTHS, best_fit, best_fit_packing, mixes, pack
from headway.llm.pieces import BYTE_SCORE, Encoder, Vocabulary, decode, piece_counts
from headway.llm.token_counts import token_counts

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
PARTS = [*"ab  \n\n\t.'5,", "’", "é", "é ", "　", "\u0085", "\xa0", "中文", "<|endoftext|>", " the", "'s", "é", "𝄞", " word" * 9]


def texts(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 120))) for _ in range(n)] + ["", None, "x" * 9000, " " * 3000]


@pytest.mark.parametrize(("chunk", "overlap"), [(1 << 16, 1 << 10), (64, 8), (20, 2)])
def test_token_counts(spark, chunk, overlap):
    own = texts(chunk, 300)
    tokenizer = Tokenizer.from_file(BPE)
    docs = spark.createDataFrame([(i, t, 0) for i, t in enumerate(own)], "doc_id bigint, text string, n_tokens int")
    for r in token_counts(docs, BPE, chunk=chunk, overlap=overlap).collect():
        text = own[r["doc_id"]] or ""
        expected = len(tokenizer.encode(text, add_special_tokens=False))
        assert (r["n_tokens"], r["n_bytes"], r["over_limit"]) == (expected, len(text.encode()), expected > 512), text[:80]


def test_token_counts_of_another_kind(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    own = [t or "" for t in texts(2, 60)]
    docs = spark.createDataFrame(list(enumerate(own)), "doc_id bigint, text string")
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts(docs, path, chunk=50, overlap=5).collect()}
    assert got == {i: len(tokenizer.encode(t, add_special_tokens=False)) for i, t in enumerate(own)}
    assert token_counts(docs.limit(0), path).collect() == []


def brute(words, text, n):
    text = words.normalize(text)
    found = []

    def walk(at, score, ids):
        if at == len(text):
            found.append((score, tuple(ids)))
            return
        single = False
        for end in range(at + 1, len(text) + 1):
            known = words.score.get(text[at:end])
            if known:
                single |= end == at + 1
                walk(end, score + known[0], [*ids, known[1]])
        if not single:
            own = [words.byte[b] for b in text[at].encode()]
            walk(at + 1, score + BYTE_SCORE * len(own), ids + own)

    walk(0, 0.0, [])
    return sorted(found, key=lambda x: (-x[0], x[1]))[:n]


def test_best_segmentations_and_decoding(spark):
    encoder = Encoder(PIECES, 4)
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rng = random.Random(6)
    own = ["".join(rng.choice([*"aethno  \né中", " the", "ing"]) for _ in range(rng.randint(0, 7))) for _ in range(150)]
    for text, (count, scores, ids, whole) in zip(own, encoder.batch(own), strict=True):
        found, expected = encoder.encode(text), brute(encoder.words, text, 4)
        assert [s for s, _ in found] == [s for s, _ in expected] == scores
        assert (count, ids, whole) == (len(found[0][1]), np.array(found[0][1], "<i4").tobytes(), True)
        for _, x in found:
            assert encoder.words.decode(x) == library.decode(x) == text
    rows = [(i, library.encode(t)) for i, t in enumerate(own)] + [(-1, None)]
    back = {r["doc_id"]: r["text"] for r in decode(spark.createDataFrame(rows, "doc_id bigint, ids array<int>"), PIECES).collect()}
    assert back == {-1: None, **dict(enumerate(own))}


def test_piece_counts_of_odd_rows(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (2, ""), (3, "word " * 40_000)], "doc_id bigint, text string")
    found = sorted(tuple(r) for r in piece_counts(docs, PIECES).collect())
    assert [(r[0], r[1], r[4]) for r in found][:3] == [(1, 0, True), (2, 0, True), (2, 0, True)] and found[0][2] == [0.0]
    assert found[3][1] >= 40_000 and found[3][4] and len(found[3][2]) == 3
    assert piece_counts(docs.limit(0), PIECES).collect() == []


def plain_cost(c, first, later, lengths, overhead):
    """Cost a token of a bin of length c that takes every later piece that still fits, long ones first."""
    used = first
    for size in later:
        if used + size <= c:
            used += size
    return (min(x for x in lengths if x >= used) + overhead) / used


def plain_best_fit(sizes, mix, lengths, overhead):
    bins = []
    for i, size in enumerate(sizes):
        fits = [b for b in bins if b["room"] >= size]
        if fits:
            least = min(b["room"] for b in fits)
            own = min((b for b in fits if b["room"] == least), key=lambda b: b["since"])
        else:
            room = min((c for c in mix if c >= size), key=lambda c: (plain_cost(c, size, sizes[i + 1 :], lengths, overhead), c))
            own = {"room": room, "own": []}
            bins.append(own)
        own["own"].append(i)
        own["room"] -= size
        own["since"] = i
    final = [min(c for c in lengths if c >= sum(sizes[i] for i in b["own"])) for b in bins]
    return [next(k for k, b in enumerate(bins) if i in b["own"]) for i in range(len(sizes))], final


def cost_of(final, overhead):
    return sum(final) + overhead * len(final)


def least_cost(sizes, lengths, overhead):
    """The least cost of any packing, by trying every way to deal the pieces to bins."""
    best = [10**9]

    def deal(i, used):
        if i == len(sizes):
            best[0] = min(best[0], cost_of([min(c for c in lengths if c >= u) for u in used], overhead))
            return
        for k in range(len(used)):
            if used[k] + sizes[i] <= lengths[-1]:
                deal(i + 1, [*used[:k], used[k] + sizes[i], *used[k + 1 :]])
        deal(i + 1, [*used, sizes[i]])

    deal(0, [])
    return best[0]


def random_pieces(rng, most):
    lengths = tuple(sorted(rng.sample(range(5, 60), 3)))
    return lengths, sorted((rng.randint(1, lengths[-1]) for _ in range(rng.randint(1, most))), reverse=True)


def test_best_fit_against_plain_version():
    rng = random.Random(8)
    for _ in range(60):
        lengths, sizes = random_pieces(rng, 60)
        tried = []
        for mix in mixes(lengths):
            bins, _, final = best_fit(sizes, mix, lengths, 3)
            assert (bins, final) == plain_best_fit(sizes, mix, lengths, 3)
            tried.append(cost_of(final, 3))
        assert cost_of(pack(sizes, lengths, 3)[2], 3) == min(tried)


def test_mixes_beat_the_largest_length():
    rng = random.Random(10)
    better = 0
    for _ in range(200):
        lengths, sizes = random_pieces(rng, 40)
        one = cost_of(plain_best_fit(sizes, lengths[-1:], lengths, 3)[1], 3)
        mine = cost_of(pack(sizes, lengths, 3)[2], 3)
        assert mine <= one
        better += mine < one
    assert better >= 20


def test_cost_near_the_least_possible():
    rng = random.Random(11)
    mine = least = 0
    for _ in range(60):
        lengths, sizes = random_pieces(rng, 7)
        own, best = cost_of(pack(sizes, lengths, 3)[2], 3), least_cost(sizes, lengths, 3)
        assert own >= best
        mine, least = mine + own, least + best
    assert mine <= 1.05 * least


def test_packing_spreads_rows_of_equal_id_and_length(spark):
    own = [(None, "w w w")] * 400 + [(5, "x y")] * 3 + [(i, "w " * (1 + i % 40)) for i in range(100, 300)]
    rows = best_fit_packing(spark.createDataFrame(own, "doc_id bigint, text string"), shard_rows=50).collect()
    assert sorted((r["doc_id"] or 0, r["length"]) for r in rows) == sorted((d or 0, len(t.split())) for d, t in own)
    shards = Counter(r["bin_id"] >> 32 for r in rows)
    hot = Counter(r["bin_id"] >> 32 for r in rows if r["doc_id"] is None)
    assert max(shards.values()) < 100 and len(hot) == len(shards)


def test_packing_ignores_columns_with_names_of_its_own(spark):
    docs = spark.createDataFrame([(1, "a b c", 9, 9, 9, 9, 9)], "doc_id bigint, text string, length int, piece int, shard int, tokens int, bin_id int")
    assert [r["length"] for r in best_fit_packing(docs).collect()] == [3]


def test_packing_keeps_every_token(spark):
    rng = random.Random(9)
    own = [(i, "w " * rng.choice([0, 1, 3, 700, 5000, 9000])) for i in range(300)] + [(7, "w"), (7, "w"), (None, "w w"), (301, None)]
    rows = best_fit_packing(spark.createDataFrame(own, "doc_id bigint, text string"), shard_rows=100).collect()
    held = {}
    for r in rows:
        held[r["doc_id"]] = held.get(r["doc_id"], 0) + r["length"]
        assert (r["bin_id"] is None) == (r["length"] == 0)
    expected = {}
    for d, t in own:
        expected[d] = expected.get(d, 0) + len((t or "").split())
    assert held == expected
    bins = {}
    for r in rows:
        if r["length"]:
            bins.setdefault(r["bin_id"], []).append(r)
    for inside in bins.values():
        inside.sort(key=lambda r: r["offset"])
        ends = [0, *(r["offset"] + r["length"] for r in inside)]
        assert [r["offset"] for r in inside] == ends[:-1]
        assert inside[0]["capacity"] == min(c for c in LENGTHS if c >= ends[-1])
    assert best_fit_packing(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []


def tied(seed, n):
    """A vocabulary of a few short pieces with few different scores, and all segmentations of a text."""
    rng = random.Random(seed)
    words = Vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    pieces = {"a", "b", "-"} | {"".join(rng.choice("ab-") for _ in range(rng.randint(2, 4))) for _ in range(8)}
    words.score = {p: (-float(rng.randint(1, 3)), (i,)) for i, p in enumerate(sorted(pieces, key=lambda _: rng.random()))}
    words.prefix = {p[:i]: None for p in words.score for i in range(1, len(p))} | words.score

    def every(text):
        if not text:
            return [(0.0, ())]
        return [(s + words.score[text[:i]][0], words.score[text[:i]][1] + ids) for i in range(1, min(4, len(text)) + 1) if text[:i] in words.score for s, ids in every(text[i:])]

    text = "".join(rng.choice("ab--") for _ in range(rng.randint(1, 9)))
    return words.nbest(text, n), sorted(every(text), key=lambda x: (-x[0], x[1]))[:n]


@pytest.mark.parametrize("n", [1, 2, 3, 5])
def test_equal_scores_by_ids(n):
    for seed in range(60):
        found, expected = tied(seed * 7 + n, n)
        assert found == expected


def test_long_runs_end():
    """Runs that can be cut in very many equally good ways."""
    words = Vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    for text in ("-" * 400, "-" * 20_000, "a" * 20_000, "=" * 5_000, " " * 5_000):
        began = time.time()
        found = words.nbest(text.replace(" ", "▁"), 3)
        assert len(found) == 3 and words.bytes_of(found[0][1]).decode() == text
        assert time.time() - began < 60
