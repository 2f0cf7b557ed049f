"""Operators on documents: odd rows, and brute force over small random corpora."""

import hashlib
import random
import re
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from headway.llm import jaccard_join as jaccard
from headway.llm.blocks import Block
from headway.llm.exact_dedup import RadixTrie, exact_dedup, text_owners
from headway.llm.jaccard_join import jaccard_join
from headway.llm.line_dedup import BANDS, line_dedup, shingle_set
from headway.llm.shared import shared_folder
from headway.llm.substring_dedup import Repeats, Words, heavy_prefixes, nodes_in, prefix_groups, substring_dedup

WORDS = re.compile(rb"[^\x20\x09-\x0d]+")
# Extra columns carry names that the operators use themselves.
SCHEMA = "doc_id bigint, text string, lang string, kept string, keep_id string, block int, component_id string, n int"


def corpus(seed: int) -> list[tuple]:
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(40)]
    texts: list[str | None] = [None, "", "   ", "one", "one", "two words", "Two words", "ünï çödé\ttext\x1cx", "x" * 5000]
    for _ in range(50):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(1, 120))]
        if rng.random() < 0.4:
            at = rng.randint(0, len(words))
            words[at:at] = passage[: rng.randint(10, 40)]
        texts.append(rng.choice([" ", "  ", "\n"]).join(words))
        if rng.random() < 0.5:
            for _ in range(rng.randint(0, len(words) // 8)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            texts.append(" ".join(words).upper() if rng.random() < 0.2 else " ".join(words))
        if rng.random() < 0.3:
            texts.append(texts[-1])
    texts.append(" ".join(rng.choice(vocabulary) for _ in range(20_000)))
    ids = rng.sample(range(-50, 1000), len(texts))
    return [(i, t, None, "a", "b", 7, "c", 1) for i, t in zip(ids, texts, strict=True)]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def words_of(text):
    return WORDS.findall((text or "").encode())


def roots(n, links):
    parent = list(range(n))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        parent[find(a)] = find(b)
    return [find(i) for i in range(n)]


def brute_substring(rows, k=13):
    words = {d: words_of(t) for d, t, *_ in rows}
    first: dict = {}
    for d in sorted(words):
        for i in range(len(words[d]) - k + 1):
            first.setdefault(tuple(words[d][i : i + k]), d)
    out = {}
    for d, w in words.items():
        gone = [False] * len(w)
        for i in range(len(w) - k + 1):
            if first[tuple(w[i : i + k])] < d:
                gone[i : i + k] = [True] * k
        out[d] = (len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone, strict=True) if not g)).hexdigest())
    return out


def brute_jaccard(rows, k=5):
    sets = []
    for _, t, *_ in rows:
        w = words_of(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    n = len(sets)
    links = [
        (i, j) for i in range(n) for j in range(i)
        if (both := len(sets[i] & sets[j])) and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both)
    ]
    root = roots(n, links)
    least: dict = {}
    for (d, *_), r in zip(rows, root, strict=True):
        least[r] = min(least.get(r, d), d)
    return {d: (len(s), least[r]) for (d, *_), s, r in zip(rows, sets, root, strict=True)}


def brute_lines(rows):
    first: dict = {}
    for d, t, *_ in sorted(rows, key=lambda r: r[0]):
        for i, line in enumerate((t or "").encode().split(b"\n")):
            if own := line.strip(b" \t\r\x0b\x0c"):
                first.setdefault(own, (d, i))
    texts = list(first)
    sets = [set(shingle_set(t).tolist()) for t in texts]
    links = [
        (i, j) for i in range(len(texts)) for j in range(i)
        if 100 * (both := len(sets[i] & sets[j])) >= 75 * (len(sets[i]) + len(sets[j]) - both)
    ]
    root = roots(len(texts), links)
    keep: dict = {}
    for t, r in zip(texts, root, strict=True):
        keep[r] = min(keep.get(r, first[t]), first[t])
    keeper = {t: keep[r] for t, r in zip(texts, root, strict=True)}
    out = {}
    for d, t, *_ in rows:
        lines = (t or "").split("\n")
        kept = [x for i, x in enumerate(lines) if keeper.get(x.encode().strip(b" \t\r\x0b\x0c"), (d, i)) == (d, i)]
        out[d] = (len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest())
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rows = corpus(seed)
    docs = frame(spark, rows)
    cut = {r[0]: tuple(r[1:4]) for r in substring_dedup(docs, block_bytes=40_000).collect()}
    assert cut == brute_substring(rows)
    linked = {r[0]: tuple(r[1:]) for r in jaccard_join(docs, block_bytes=40_000, chunk=4).collect()}
    assert linked == brute_jaccard(rows)
    lines = {r[0]: tuple(r[1:4]) for r in line_dedup(docs, block_bytes=40_000, chunk=4).collect()}
    assert lines == brute_lines(rows)


def test_many_near_copies_in_small_chunks(spark):
    """One group of near copies, larger than several chunks, and outsiders that share its prefix."""
    rng = random.Random(4)
    base = [f"b{i}" for i in range(60)]
    rows = []
    for i in range(150):
        words = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 9])):
            words[rng.randrange(60)] = f"r{rng.randrange(99)}"
        rows.append((i, " ".join(words), None, "", "", 0, "", 0))
    got = {r[0]: tuple(r[1:]) for r in jaccard_join(frame(spark, rows), block_bytes=4_000, chunk=8).collect()}
    assert got == brute_jaccard(rows)


def test_outsiders_of_a_group_travel_once(spark, monkeypatch):
    """Copies beyond the threshold share many prefix shingles with a group: they meet it once, not once a shingle."""
    rng = random.Random(5)
    base = [f"b{i}" for i in range(200)]
    rows = []
    for i in range(120):
        words = list(base)
        for _ in range(rng.choice([0, 1, 2, 3, 7, 8, 9])):
            words[rng.randrange(200)] = f"r{rng.randrange(9999)}"
        rows.append((i, " ".join(words), None, "", "", 0, "", 0))
    sent = []

    def counted(met, keys, work, edges=jaccard._edges):
        sent.append(met.count())
        return edges(met, keys, work)

    monkeypatch.setattr(jaccard, "_edges", counted)
    got = {r[0]: tuple(r[1:]) for r in jaccard_join(frame(spark, rows), block_bytes=4_000, chunk=64).collect()}
    assert got == brute_jaccard(rows)
    assert 10 < len({c for _, c in got.values()}) < 110
    assert sum(sent) < 5 * len(rows), sent


@pytest.mark.parametrize("seed", range(6))
def test_links_at_a_hub(seed):
    """Sets of several components, by one chunk or two: what the edges connect is what all links between them connect."""
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 1 << 62, 40).astype(np.uint64)
    rows = []
    for i in range(300):
        own = base[rng.random(40) < rng.choice([0.6, 0.85, 1])] if i % 3 else rng.choice(base, 5)
        own = np.unique(np.concatenate([own, rng.integers(0, 1 << 62, rng.integers(0, 30)).astype(np.uint64)]))
        component = int(rng.choice([0, 1, i + 2], p=[0.4, 0.1, 0.5]))
        rows.append({"doc_id": i, "n": len(own) + int(rng.integers(0, 3)), "shared": own.tobytes(), "component": component, "side": i % 2})
    sets = [set(np.frombuffer(r["shared"], np.uint64).tolist()) for r in rows]
    for second in (0, 1):
        links = [
            (i, j) for i in range(300) for j in range(i)
            if (second == 0 or i % 2 != j % 2) and rows[i]["component"] != rows[j]["component"]
            and 175 * len(sets[i] & sets[j]) >= 75 * (rows[i]["n"] + rows[j]["n"])
        ]
        first_of: dict = {}
        known = [(i, first_of.setdefault(r["component"], i)) for i, r in enumerate(rows)]
        edges = list(jaccard.linked_hub([r | {"first": 0, "second": second} for r in rows], 75, jaccard.fingerprints))
        assert set(edges) <= set(links)
        one, two = roots(300, known + edges), roots(300, known + links)
        assert [one.index(x) for x in one] == [two.index(x) for x in two]
        assert len(edges) < len(first_of)


def test_similar_lines_by_five_characters(spark):
    """One changed letter inside a line of 39 to 70 characters: alike by shingles of 5, not by longer ones."""
    rng = random.Random(6)
    rows, expected = [], {}
    for i in range(64):
        size = 37 + i % 34  # two sizes below the threshold, and all from 39 on
        one = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=size))
        two = one[: size // 2] + "#" + one[size // 2 + 1 :]
        x, y = ({t[j : j + 5] for j in range(size - 4)} for t in (one, two))
        rows += [(2 * i, one, None, "", "", 0, "", 0), (2 * i + 1, two, None, "", "", 0, "", 0)]
        expected |= {2 * i: 0, 2 * i + 1: int(100 * len(x & y) >= 75 * len(x | y))}
    assert sum(expected.values()) == sum(37 + i % 34 >= 39 for i in range(64))
    assert {r["doc_id"]: r["n_removed"] for r in line_dedup(frame(spark, rows)).collect()} == expected


def test_lines_are_stored_without_what_their_texts_give(spark):
    """Pairs of near copies in small chunks: found whole, and the tables in between hold text and keys only."""
    rng = random.Random(4)
    rows = []
    for i in range(600):
        line = "".join(rng.choice("abcdefghijklmnop") for _ in range(60))
        rows += [(d, t, None, "", "", 0, "", 0) for d, t in ((2 * i, line), (2 * i + 1, line[:-1] + "!"))]
    folder = Path(shared_folder(spark).removeprefix("file:"))
    before = set(folder.rglob("*.parquet"))
    removed = {r["doc_id"] for r in line_dedup(frame(spark, rows), chunk=4).collect() if r["n_removed"]}
    made = sum(f.stat().st_size for f in set(folder.rglob("*.parquet")) - before)
    assert removed == {2 * i + 1 for i in range(600)}
    assert made < 400 * len(rows), made / len(rows)


def test_equal_lines_and_unlike_ones_travel_without_text(spark):
    """Lines of the same syllables share many shingles: neither these nor equal copies are stored with text or bands."""
    rng = random.Random(8)
    syllables = ["".join(rng.choices("abcdefghijklmnop", k=4)) for _ in range(60)]
    lines = ["".join(rng.choice(syllables) + rng.choice([" ", "", ""]) for _ in range(90)).strip() for _ in range(300)]
    rows = [(d, t, None, "", "", 0, "", 0) for i, t in enumerate(lines) for d in (i, 1000 + i)]
    folder = Path(shared_folder(spark).removeprefix("file:"))
    before = set(folder.rglob("*.parquet"))
    removed = {r["doc_id"] for r in line_dedup(frame(spark, rows), block_bytes=20_000).collect() if r["n_removed"]}
    made = sum(f.stat().st_size for f in set(folder.rglob("*.parquet")) - before)
    assert removed == {1000 + i for i in range(300)}
    assert made < 150 * len(rows), made / len(rows)


def test_similar_lines_of_different_kinds(spark):
    """Pairs at the threshold whose sizes lie on both sides of the edges of the kinds."""
    rng = random.Random(9)
    rows, linked = [], set()
    for i in range(120):
        edge = BANDS[1 + i % 3][0]
        size = edge + 3 - rng.randrange(edge // 4)
        one = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=size + 4))
        two = one + "".join(rng.choices("ABCDEFGHIJ", k=size // 3 if i % 2 else size // 2))
        rows += [(2 * i, one, None, "", "", 0, "", 0), (2 * i + 1, two, None, "", "", 0, "", 0)]
        x, y = (len({t[j : j + 5] for j in range(len(t) - 4)}) for t in (one, two))
        if 4 * x >= 3 * y:
            linked.add(2 * i + 1)
    assert len(linked) == 60
    assert {r["doc_id"] for r in line_dedup(frame(spark, rows), block_bytes=9_000).collect() if r["n_removed"]} == linked


@pytest.mark.parametrize("operator", [exact_dedup, substring_dedup, jaccard_join, line_dedup])
def test_empty_table(spark, operator):
    assert operator(frame(spark, [])).collect() == []


@pytest.mark.parametrize("operator", [exact_dedup, substring_dedup, jaccard_join, line_dedup])
def test_null_and_repeated_ids(spark, operator):
    text = " ".join(f"t{i}" for i in range(30))
    rows = [(None, text, None, "", "", 0, "", 0), (3, text, None, "", "", 0, "", 0), (3, text, None, "", "", 0, "", 0), (4, None, None, "", "", 0, "", 0)]
    found = operator(frame(spark, rows)).orderBy("doc_id").collect()
    assert [r["doc_id"] for r in found] == [None, 3, 3, 4]


def test_one_id_does_not_connect(spark):
    """Rows that share an id, or have none, link no documents through it."""
    one, two, three, four = (" ".join(f"{name}{i}" for i in range(60)) for name in "abcd")
    near = lambda text: text + " more"
    texts = [(1, one), (2, two), (None, near(one)), (None, near(two)), (3, three), (4, four), (9, near(three)), (9, near(four)), (9, "else")]
    found = jaccard_join(frame(spark, [(d, t, None, "", "", 0, "", 0) for d, t in texts])).collect()
    got = sorted((r["doc_id"] or 99, r["component_id"]) for r in found)
    assert got == [(1, 1), (2, 2), (3, 3), (4, 4), (9, 3), (9, 4), (9, 9), (99, 1), (99, 2)]


def test_spans_and_text_of_repeats(spark):
    one = [f"a{i}" for i in range(20)]
    two = ["x", *one[2:18], "y"]
    rows = [(1, " ".join(one), None, "", "", 0, "", 0), (2, "\n".join(two), None, "", "", 0, "", 0)]
    found = {r["doc_id"]: r for r in substring_dedup(frame(spark, rows)).collect()}
    assert found[1]["repeats"] == [] and found[1]["kept_text"] == " ".join(one)
    assert [tuple(x) for x in found[2]["repeats"]] == [(1, 17)] and found[2]["kept_text"] == "x y"


def test_exact_dedup_against_grouping(spark):
    rows = corpus(3)
    groups: dict = {}
    for d, t, *_ in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0d]+", " ", t or ""), []).append(d)
    found = {r["doc_id"]: r for r in exact_dedup(frame(spark, rows), budget=2_000).collect()}
    assert len(found) == len(rows)
    for text, ids in groups.items():
        for d in ids:
            r = found[d]
            assert (r["keep_id"], r["group_size"], r["kept"]) == (min(ids), len(ids), d == min(ids))
            assert r["text_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_trie_spills_and_merges():
    rng = random.Random(5)
    texts = [bytes(rng.choices(b"ab", k=rng.randint(0, 8))) for _ in range(500)]
    trie, out = RadixTrie(), []
    for i, t in enumerate(texts):
        if not trie.insert(t, i, 1):
            out.append((t, i, 1))
        if i % 100 == 99:
            out += trie.spill()
    out += trie.entries(trie.root, b"")
    total: dict = {}
    for t, keep, n in out:
        k, m = total.get(t, (keep, 0))
        total[t] = (min(k, keep), m + n)
    assert total == {t: (texts.index(t), texts.count(t)) for t in texts}


def test_spilled_texts_take_more_rounds(spark):
    rows = [(f"text number {i % 300}".encode(), i, 1) for i in range(900)]
    entries = spark.createDataFrame(rows, "text binary, keep_id bigint, group_size bigint").coalesce(1)
    found = text_owners(entries, 5_000).withColumn("key", F.hex("digest")).collect()
    assert sorted((r["keep_id"], r["group_size"]) for r in found) == [(i, 3) for i in range(300)]


def hot_beginnings(seed: int) -> list[tuple]:
    """Texts full of one beginning with many different continuations, each of which occurs in several documents."""
    rng = random.Random(seed)
    tails = [[f"t{rng.randrange(60)}" for _ in range(14)] for _ in range(60)]
    texts = [" ".join(w for _ in range(rng.randint(1, 12)) for w in ("licence", "granted", "under", *rng.choice(tails))) for _ in range(80)]
    ids = rng.sample(range(1000), len(texts))
    return [(i, t, None, "a", "b", 7, "c", 1) for i, t in zip(ids, texts, strict=True)]


def test_hot_beginning_lands_in_several_groups(spark):
    rows = hot_beginnings(3)
    docs = frame(spark, rows)
    size = sum(len(t) + 1 for _, t, *_ in rows)
    heavy = heavy_prefixes(docs, 13, size, 20)
    block = Block.of(pa.array([t.encode() for _, t, *_ in rows], pa.large_binary()))
    starts, _ = block.windows(13)
    words = np.array([block.data[a:b].tobytes() for a, b in zip(block.starts, block.ends, strict=True)])
    hot = starts[words[starts] == b"licence"]
    assert len(set(prefix_groups(block, hot, 13, 64, np.empty(0, np.uint64)).tolist())) == 1
    assert len(set(prefix_groups(block, hot, 13, 64, heavy).tolist())) > 10
    expected = brute_substring(rows)
    for most in (1, 20, 1 << 18):
        found = substring_dedup(docs, block_bytes=1500, group_suffixes=most).collect()
        assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in found} == expected


@pytest.mark.parametrize("most", [1, 7, 1 << 17])
def test_trees_of_a_block(most):
    rows = hot_beginnings(5)
    block = Block.of(pa.array([t.encode() for _, t, *_ in rows], pa.large_binary()))
    starts, _ = block.windows(13)
    words = [block.data[a:b].tobytes() for a, b in zip(block.starts, block.ends, strict=True)]
    node = nodes_in(Words(block).code, starts, 13, most)
    number: dict = {}
    for at, own in zip(starts.tolist(), node.tolist(), strict=True):
        assert number.setdefault(tuple(words[at : at + 13]), own) == own
    assert len(set(number.values())) == len(number)


def test_equal_fingerprints_of_different_words():
    block = Block.of(pa.array([b"a b c d e", b"f g h i j", b"x a b c d"], pa.large_binary()))
    block.hashes[:] = 7
    repeats = Repeats(block, 4)
    of = dict(zip(repeats.first_word.tolist(), repeats.of.tolist(), strict=True))
    assert of[0] == of[11] and len(set(of.values())) == 5
    assert repeats.leader[of[11]] == 0
