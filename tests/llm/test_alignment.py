"""Alignment of two tokenizers against a plain version that tokenises every text as a whole."""

import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from headway.llm.alignment import align, byte_letters
from headway.llm.shared import table

PATH_A, PATH_B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ZERO = (0, 0, 0, 0, 0, 0, "")


def brute(texts):
    """Measures of each text, from byte ranges of whole texts' tokens and all overlapping pairs."""
    a, b = Tokenizer.from_file(PATH_A), sentencepiece.SentencePieceProcessor(model_file=PATH_B)
    a.encode_special_tokens = True
    letter = byte_letters()

    def ranges(ids, pieces):
        at, found = 0, []
        for i, p in zip(ids, pieces, strict=True):
            found.append((i, at, at + len(p)))
            at += len(p)
        return found, b"".join(pieces)

    parts, held = [], Counter()
    for text in texts:
        if not text:
            parts.append(None)
            continue
        ids_a = a.encode(" " + text, add_special_tokens=False).ids
        ids_b = b.encode(text)
        own_a, whole_a = ranges(ids_a, [bytes(letter[c] for c in a.id_to_token(i)) for i in ids_a])
        of = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
        own_b, whole_b = ranges(ids_b, [of(i) for i in ids_b])
        if whole_a != (" " + text).encode() or whole_b != whole_a:
            parts.append(None)
            continue
        ends = sorted({e for *_, e in own_a} & {e for *_, e in own_b})
        groups, start = [], 0
        for end in ends:
            inside = lambda own: ",".join(str(i) for i, p, q in own if start <= p and q <= end)  # noqa: E731, B023
            groups.append(f"{inside(own_a)}|{inside(own_b)}")
            start = end
        links = [(i, j) for i, p, q in own_a for j, r, s in own_b if p < s and r < q]
        held.update(set(links))
        parts.append((len(ids_a), len(ids_b), groups, links))
    most = defaultdict(int)
    for (i, _), n in held.items():
        most[i] = max(most[i], n)
    return [
        ZERO if p is None else (
            p[0], p[1], len(p[2]), len(p[3]), sum(held[x] == most[x[0]] for x in p[3]), sum(held[x] for x in p[3]),
            hashlib.sha256(";".join(p[2]).encode()).hexdigest(),
        )
        for p in parts
    ]


def rows(df):
    return sorted((r[0] is None, r[0] or 0, *r[1:]) for r in df.collect())


def check(spark, texts, **more):
    docs = spark.createDataFrame(texts, "doc_id bigint, text string, block int, digest string, copies int, codes int")
    got = rows(align(docs, PATH_A, PATH_B, **more))
    expected = sorted((d is None, d or 0, *m) for (d, *_), m in zip(texts, brute([t for _, t, *_ in texts]), strict=True))
    assert got == expected


ODD = [
    None, "", " ", "\n", "a", "  two  blanks  ", "tabs\tand\nlines\r\n", "naïve café — “quoted” … 中文字符 한국어 😀👩‍👩‍👧", "x▁y", "▁", "<s> </s> <unk> <|endoftext|> <0x41>",
    "a\x00b \x01", "don't  they've we'll", "A" * 3000, "- " * 400 + "end", "ﬁ ① é é ́ x", "ß" * 5 + " Ω мир", " leading", "trailing ", " em space",
]


def test_odd_texts_rows_without_id_and_clashing_columns(spark):
    texts = [(i if i % 7 else None, t, 1, "x", 2, 3) for i, t in enumerate(ODD + ODD[4:9] + ["the cat sat"] * 5 + ["the cat"])]
    check(spark, texts)
    check(spark, texts, batch_bytes=64)


def test_documents_and_block_sizes(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    texts = [(r["doc_id"], r["text"], 0, "", 0, 0) for r in docs.collect() if len(r["text"]) < 6000]
    check(spark, texts, batch_bytes=20_000)


def test_one_very_long_text(spark):
    long = " ".join(f"word{i % 977} and, then; (more) {i}" for i in range(60_000))
    docs = spark.createDataFrame([(1, long), (2, "word1 and")], "doc_id bigint, text string")
    (one, two) = sorted(align(docs, PATH_A, PATH_B).collect())
    a, b = Tokenizer.from_file(PATH_A), sentencepiece.SentencePieceProcessor(model_file=PATH_B)
    assert (one["n_a"], one["n_b"]) == (len(a.encode(" " + long).ids), len(b.encode(long)))
    assert two["n_links"] > 0 and two["count_sum"] > two["n_links"]


def test_empty_table(spark):
    assert align(spark.createDataFrame([], "doc_id bigint, text string"), PATH_A, PATH_B).collect() == []
