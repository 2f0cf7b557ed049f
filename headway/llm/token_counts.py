"""Token counts of whole texts, as a tokenizer file's own library gives them.

Documents longer than a chunk are encoded in overlapping chunks with offsets. Two neighbouring
chunks are spliced at a token boundary that both have and that is proven stable: a place where the
tokenizer's pattern cuts whatever surrounds it. Where an overlap holds no such place it is widened,
at last to the end of the document.

Shorter documents are cut at the same stable places into small units, usually a word with the space
before it; each distinct unit of a batch is encoded once. Counting needs no shuffle.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from headway.llm.blocks import distinct
from headway.llm.shared import sliced, tidy

# A single space or line feed between two characters that are certainly no white space. The
# byte-level pattern gives the space to what follows it, and makes the line feed a token of its own.
STABLE = re.compile(r"(?<=[!-~À-߿])(?=[ \n][!-~À-߿])|(?<=[!-~À-߿]\n)(?=[!-~À-߿])")
COUNTS = pa.schema(
    [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())]
)
BATCH_BYTES = 16 << 20


def cuts_bytes(data: np.ndarray) -> np.ndarray:
    """Positions in UTF-8 bytes where STABLE matches."""
    if len(data) < 3:
        return np.empty(0, np.int64)
    plain = (data > 0x20) & (data < 0x7F)
    lead = (data >= 0xC3) & (data <= 0xDF)
    ends = plain.copy()  # a safe character ends here
    ends[1:] |= lead[:-1]
    begins = plain | lead
    gap = (data == 0x20) | (data == 0x0A)
    alone = np.flatnonzero(gap[1:-1] & ends[:-2] & begins[2:]) + 1
    return distinct(np.concatenate([alone, alone[data[alone] == 0x0A] + 1]))


class Counter:
    """Counts with one tokenizer file; `stable` says whether STABLE holds for its pattern."""

    def __init__(self, path: str, chunk: int, overlap: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.chunk, self.overlap = chunk, overlap
        parts = json.loads(self.tokenizer.to_str())
        split = parts["pre_tokenizer"] or {}
        self.stable = (
            split.get("type") == "ByteLevel"
            and split["use_regex"]
            and not split["add_prefix_space"]
            and parts["normalizer"] is None
            and not any(x["lstrip"] or x["rstrip"] or x["single_word"] or set(" \n") & set(x["content"]) for x in parts["added_tokens"])
        )

    def lengths(self, texts: list[str]) -> np.ndarray:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return np.fromiter(map(len, found), np.int64, len(texts))

    def boundaries(self, text: str, start: int, end: int) -> np.ndarray:
        """Where tokens of text[start:end] end; inside a character split over tokens, its end."""
        spans = self.tokenizer.encode(text[start:end], add_special_tokens=False).offsets
        return start + np.fromiter((e for _, e in spans), np.int64, len(spans))

    def huge(self, text: str) -> int:
        """Tokens of a text longer than a chunk, by spliced overlapping chunks."""
        if not self.stable:
            return int(self.lengths([text])[0])
        total = begin = start = 0  # begin: what is counted; start: where the chunk starts
        end = min(len(text), self.chunk)
        left = self.boundaries(text, start, end)
        while end < len(text):
            overlap = self.overlap
            while True:
                after = max(begin, end - overlap)
                stop = min(len(text), after + self.chunk)
                right = self.boundaries(text, after, stop)
                both = np.intersect1d(left, right)
                stable = [m.start() for m in STABLE.finditer(text, after, end)]
                both = both[np.isin(both, stable) & (both > begin)]
                if len(both):
                    break
                if end == len(text):
                    return total + int((left > begin).sum())
                # No common boundary: the left chunk grows, and so does the overlap.
                overlap *= 2
                end = min(len(text), end + overlap)
                left = self.boundaries(text, start, end)
                if end == len(text):
                    return total + int((left > begin).sum())
            at = int(both[len(both) // 2])
            total += int(((left > begin) & (left <= at)).sum())
            begin, start, end, left = at, after, stop, right
        return total + int((left > begin).sum())

    def short(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Tokens of texts that lie behind one another in data."""
        cut = cuts_bytes(data) if self.stable else np.empty(0, np.int64)
        edges = distinct(np.concatenate([cut, offsets]))
        if len(edges) < 2:
            return np.zeros(len(offsets) - 1, np.int64)
        units = pa.Array.from_buffers(
            pa.large_binary(), len(edges) - 1, [None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(data)]
        ).dictionary_encode()
        texts = [x.decode("utf-8", "replace") for x in units.dictionary.to_pylist()]
        sums = np.concatenate([[0], np.cumsum(self.lengths(texts)[units.indices.to_numpy()])])
        return np.diff(sums[np.searchsorted(edges, offsets)])

    def counts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, tokens) of each text; null counts as empty."""
        texts = texts.cast(pa.large_binary()).fill_null(b"")
        n = len(texts)
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
        size = np.diff(offsets)
        tokens = np.zeros(n, np.int64)
        large = size > self.chunk
        for i in np.flatnonzero(large):
            tokens[i] = self.huge(texts[int(i)].as_py().decode("utf-8", "replace"))
        few = texts.filter(pa.array(~large))
        if len(few):
            few = pa.concat_arrays([few])
            at = np.frombuffer(few.buffers()[1], np.int64)[few.offset : few.offset + len(few) + 1]
            raw = few.buffers()[2]
            data = np.frombuffer(raw, np.uint8)[at[0] : at[-1]] if raw is not None else np.empty(0, np.uint8)
            tokens[~large] = self.short(data, at - at[0])
        return size, tokens


def token_counts(
    docs: DataFrame, path: str, limit: int = 512, chunk: int = 1 << 16, overlap: int = 1 << 10
) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (n_tokens > limit) of each row's whole text.

    `path` is a file of the `tokenizers` library, present on all machines; no special tokens are
    added, special strings inside texts are treated as the library does by default, and nothing is
    truncated or padded. Null counts as empty (0 tokens). Only doc_id and text are read. Repeated
    rows each give a row; an empty table gives none. `chunk` and `overlap` (characters) bound the
    work of one call and do not change the counts. Tokenizers without the byte-level pattern are
    given whole texts.
    """

    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(path, chunk, overlap)
        for batch in sliced(batches, "text", BATCH_BYTES):
            size, tokens = counter.counts(batch.column("text"))
            yield pa.record_batch([batch.column("doc_id"), pa.array(size), pa.array(tokens), pa.array(tokens > limit)], schema=COUNTS)

    rows = docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "CAST(text AS STRING) AS text")
    return rows.mapInArrow(run, "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean")
