"""Near-duplicate documents against a plain comparison of all pairs, and the sketches by themselves."""

import random
from fractions import Fraction

import numpy as np

from headway.llm.hyperminhash import BAND, BUCKETS, bands, collisions, filled, near_dedup, plausible, registers, similarity
from headway.llm.shared import table


def sets(text, size):
    words = [w for w in (text or "").translate({i: i + 32 for i in range(65, 91)}).translate({i: 32 for i in range(9, 14)}).split(" ") if w]
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def brute(rows, size=4, percent=80):
    """(doc_id, n, component, kept) of every row; rows without an id come last."""
    own = [sets(t, size) for _, t, *_ in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(own):
        for j, b in enumerate(own[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[find(i)] = find(j)
    top = float("inf")
    ids = [top if d is None else d for d, *_ in rows]
    least = {}
    for i, d in enumerate(ids):
        least[find(i)] = min(least.get(find(i), top), d)
    return sorted((d, len(own[i]), least[find(i)], d == least[find(i)]) for i, d in enumerate(ids))


def check(spark, rows, **more):
    docs = spark.createDataFrame([(*r, 1, 2, "x", 3) for r in rows], "doc_id bigint, text string, node int, band int, registers string, n int")
    top = float("inf")
    got = near_dedup(docs, **more).collect()
    assert sorted((top if r[0] is None else r[0], r[1], top if r[2] is None else r[2], r[3]) for r in got) == brute(rows)


def family(rng, words, copies, changes):
    """Copies of a text with some words replaced."""
    base = [rng.choice("abcdefghij") + str(rng.randrange(5000)) for _ in range(words)]
    for _ in range(copies):
        own = list(base)
        for k in rng.sample(range(words), changes):
            own[k] = f"x{rng.randrange(10**6)}"
        yield " ".join(own)


def test_families_near_the_limit(spark):
    rng = random.Random(4)
    texts = [t for words, changes in ((12, 1), (30, 1), (40, 2), (90, 3), (90, 4), (300, 9), (300, 12)) for t in family(rng, words, 14, changes)]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    check(spark, rows)
    check(spark, rows, chunk=3)


def test_large_group_with_outsiders(spark):
    """One large component in every band, and texts that share much with it, or little, or one partner of their own."""
    rng = random.Random(5)
    texts = list(family(rng, 120, 120, 2)) + list(family(rng, 120, 5, 3))
    base = texts[0].split()
    texts += [" ".join(base[:k] + [f"y{k}w{i}" for i in range(120 - k)]) for k in range(60, 120, 4)]
    rng.shuffle(texts)
    check(spark, list(enumerate(texts)), chunk=8)


def test_odd_rows(spark):
    same, other = "one two three four five six", "Seven eight NINE ten"
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "one two"), (None, same), (None, same.upper()), (9, same), (9, other), (9, other.lower()),
        (None, "alone here and there"), (10, " ".join(map(str, range(60_000)))), (11, " ".join(map(str, range(1, 60_000)))), (12, " a b"),
    ]
    check(spark, rows)


def test_documents(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    check(spark, rows)
    check(spark, rows, chunk=4)


def test_empty_table(spark):
    assert near_dedup(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []


def test_registers_hold_zeros_and_mantissa():
    """Against the definition, in whole numbers."""
    from headway.llm.blocks import mixed

    rng = np.random.default_rng(3)
    value = rng.integers(0, 1 << 63, 500, np.uint64)
    doc = np.repeat(np.arange(5), 100)
    found = registers(doc, value, 6)
    least = {}
    for d, h in zip(doc.tolist(), mixed(value ^ np.uint64(0x5851F42D4C957F2D)).tolist(), strict=True):
        key = d, h >> 57
        least[key] = min(least.get(key, 1 << 57), h & (1 << 57) - 1)
    for d in range(6):
        for b in range(BUCKETS):
            h = least.get((d, b))
            expected = 0
            if h is not None:
                zeros = 57 - h.bit_length()
                part = Fraction(h, 1 << (h.bit_length() - 1)) - 1
                expected = (zeros + 1 << 10) + int(part * 1024)
            assert found[d, b] == expected
    full = filled(found)
    assert (full[:5] > 0).all() and not full[5].any() and (full[:5][found[:5] > 0] == found[:5][found[:5] > 0]).all()


def test_estimate_and_bands():
    """The estimate is near the similarity, corrected for collisions; similar sets share a band, however short."""
    rng = np.random.default_rng(6)
    trials = 2000
    for union in (5, 20, 25, 40, 400):
        both = -(-4 * union // 5)
        values = rng.integers(0, 1 << 63, (trials, union), np.uint64)
        first = rng.integers(0, union - both + 1, trials)[:, None]
        place = np.arange(union)[None, :]
        in_a, in_b = place < both + first, (place < both) | (place >= both + first)
        a, b = (registers(np.nonzero(x)[0], values[x], trials) for x in (in_a, in_b))
        n, m = in_a.sum(axis=1), in_b.sum(axis=1)
        own = slice(None) if union < 2 * BUCKETS else slice(BUCKETS // BAND)
        assert (bands(a)[:, own] == bands(b)[:, own]).any(axis=1).all()
        assert plausible(a, b, n, m, 80).all()
        estimate, used = similarity(a, b, n, m)
        assert abs(estimate.mean() - both / union) < 0.01 and (used <= BUCKETS).all()
    # Sets that share nothing: equal registers are chance, as often as expected.
    a, b = (registers(np.repeat(np.arange(trials), 1000), rng.integers(0, 1 << 63, trials * 1000, np.uint64), trials) for _ in range(2))
    chance = collisions(np.array([1000.0]), np.array([1000.0]))[0]
    assert abs((a == b).mean() / chance - 1) < 0.3
