"""The pipeline's stages on a small corpus, each against what its operator decides."""

import corpus_pipeline
from headway.llm.shared import stored, table
from tests.llm.test_documents import brute_jaccard, brute_substring

FOLDER = "/root/testdata/sf0.001"


def test_stages_one_by_one(spark):
    documents = table(spark, FOLDER, "documents")
    odd = spark.createDataFrame([(7000, None, None, "s", 0), (7001, "1 2 3", "en", "s", 5), (7002, "", "en", "s", 0)], documents.schema)
    repeated = documents.filter("doc_id = 5")
    docs = stored(documents.unionByName(odd).unionByName(repeated))
    frames = [docs]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frames.append(stored(stage(spark, frames[-1], FOLDER)))
        assert frames[-1].columns == docs.columns, name
    rows = [{r["doc_id"]: r["text"] for r in f.collect()} for f in frames]
    assert set(rows[0]) - set(rows[1]) == {7000, 7001, 7002}
    first = {}
    for d in sorted(rows[1]):
        first.setdefault(" ".join(rows[1][d].split()), d)
    assert set(rows[2]) == set(first.values()) and frames[2].count() == len(rows[2])
    near = brute_jaccard(list(rows[2].items()))
    assert set(rows[3]) == {d for d, (_, c) in near.items() if c == d}
    assert set(rows[4]) == set(rows[3])
    cut = brute_substring(list(rows[3].items()))
    assert {d: len(t.split()) for d, t in rows[4].items()} == {d: n - gone for d, (n, gone, _) in cut.items()}
    packed = corpus_pipeline.STAGES[-1][1](spark, frames[-1], FOLDER).collect()
    assert {r["doc_id"] for r in packed} == set(rows[4])
    assert sum(r["length"] for r in packed) == sum(len(t.split()) for t in rows[4].values())


def test_one_id_of_several_texts(spark):
    """Rows without an id, or under one id, are documents of their own: only copies of a text that stays may go."""
    words = lambda name: " ".join(f"{name}{i}" for i in range(30))
    schema = table(spark, FOLDER, "documents").schema
    texts = [(1, "a"), (5, "a"), (5, "b"), (5, "c"), (None, "d"), (None, "e"), (None, "e"), (None, "b"), (9, "e"), (9, "d")]
    docs = stored(spark.createDataFrame([(d, words(t), "en", "s", len(words(t))) for d, t in texts], schema))
    exact = stored(corpus_pipeline.exact_stage(spark, docs, FOLDER))
    expected = sorted((d, words(t)) for d, t in [(1, "a"), (5, "b"), (5, "c"), (9, "d"), (9, "e")])
    got = lambda df: sorted((r["doc_id"] or 0, r["text"]) for r in df.collect())
    assert got(exact) == expected
    # A near copy under an id of its own goes; other rows without an id stay.
    more = [(None, words("c") + " x"), (None, words("f")), (None, words("g"))]
    docs = stored(exact.unionByName(spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in more], schema)))
    near = stored(corpus_pipeline.near_stage(spark, docs, FOLDER))
    expected = sorted([*expected, (0, words("f")), (0, words("g"))])
    assert got(near) == expected
    assert got(corpus_pipeline.passage_stage(spark, near, FOLDER)) == expected


def test_run_on_whole_table(spark):
    assert corpus_pipeline.run(spark, FOLDER).count() > 100


CLASHING = ("own_id", "own_digest", "own_number", "kept_id", "cut_id", "cut_text", "doc", "kept", "component_id", "many", "id", "block", "length")


def test_clashing_columns_null_and_long_texts(spark):
    """Columns with the names that stages use come out of each stage as they went in."""
    words = lambda name, n=40: " ".join(f"{name}word{i}" for i in range(n))
    texts = [(1, words("a")), (2, words("a")), (3, words("b")), (4, words("b") + " end"), (5, None), (6, ""), (7, words("long", 50_000)), (None, words("c")), (None, None)]
    rows = [(d, t, "en", "s", len(t or ""), *range(111, 111 + len(CLASHING))) for d, t in texts]
    ddl = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"{c} int" for c in CLASHING)
    docs = stored(spark.createDataFrame(rows, ddl))
    left = []
    for _, stage in corpus_pipeline.STAGES[1:-1]:
        out = stored(stage(spark, docs, FOLDER))
        assert out.schema.simpleString() == docs.schema.simpleString()
        found = out.collect()
        assert all(r[c] == 111 + i for r in found for i, c in enumerate(CLASHING))
        left.append(sorted((r["doc_id"] or 0, len(r["text"] or "")) for r in found))
    size = {d: len(t or "") for d, t in texts}
    assert left[0] == sorted([(d, size[d]) for d in (1, 3, 4, 5, 7)] + [(0, len(words("c")))])
    assert [d for d, _ in left[1]] == [0, 0, 1, 3, 5, 6, 7] and len(left[2]) == len(texts)
    assert corpus_pipeline.language_stage(spark, docs, FOLDER).columns == docs.columns
    assert corpus_pipeline.packing_stage(spark, docs, FOLDER).filter("length = 0").count() == 3


def test_empty_table(spark):
    docs = table(spark, FOLDER, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, FOLDER).collect() == []
