"""Token counts with overlap resynchronisation for huge documents.

A text up to ``chunk`` characters is counted word by word: white space ends
every pre-token, so the words between white space have counts of their own,
which a bounded memo keeps. A longer text is encoded in overlapping chunks with
offsets. Two neighbouring chunks are spliced at a position of their overlap
that is proven stable:

* both encodings have a token boundary there, and none of them reads across
  it at a special token;
* the text says that no pre-token and no normalised character can reach over
  it: it is the end of white space, or a letter followed by a character that
  is neither letter, digit, white space nor mark, or it touches a digit, and
  lower-casing leaves both characters of their kind.

Where the overlap holds no such position, the overlap is widened and the left
chunk is encoded again, up to the whole rest of the text.

This holds for files that normalise and split as ``STEPS`` says; others are
refused.
"""

from __future__ import annotations

import itertools
import json
import os
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ready

#: Characters of a chunk and of the first overlap.
CHUNK = 1 << 16
OVERLAP = 1 << 10
#: Texts that are counted at once, and words that a worker remembers.
CALL = 256
MEMO = 1 << 19
#: White space of every definition of it.
WHITE = re.compile(r"[ \t\n\r]+")
#: The normalisers and the pattern of pre-tokens that the splices are proven for.
STEPS = ["NFC", "Replace", "Lowercase"]
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def stable(text: str, p: int) -> bool:
    """No pre-token and no normalisation of ``STEPS`` and ``PATTERN`` reaches over ``p``."""
    a, b = text[p - 1], text[p]
    ca, cb = unicodedata.category(a), unicodedata.category(b)
    if cb[0] == "M" or "Cn" in (ca, cb):
        return False
    for c in (a, b):  # a capital may become a letter and a mark, which joins what follows
        low = c.lower()
        if len(low) != 1 or unicodedata.category(low)[0] != unicodedata.category(c)[0]:
            return False
    if a.isspace():
        return not b.isspace()
    if b.isspace():
        return False
    return (ca[0] == "N" and cb[0] != "N") or (cb[0] == "N" and ca[0] == "L") or (ca[0] == "L" and cb[0] not in "LN")


def splice(text: str, left: list, right: list, low: int, high: int) -> int | None:
    """The last proven common boundary of two encodings in [low, high), as a
    position in ``text``; offsets are positions in ``text``."""
    both = {a for a, _ in left if low < a < high} & {a for a, _ in right if low < a < high}
    ends = {b for _, b in left} | {b for _, b in right}
    for p in sorted(both, reverse=True):
        inner = any(a < p < b for a, b in left) or any(a < p < b for a, b in right)
        if not inner and stable(text, p) and (text[p - 1].isspace() or p in ends):
            return p
    return None


def count_long(text: str, offsets, chunk: int = CHUNK, overlap: int = OVERLAP, longest: int = 16) -> int:
    """Tokens of a long text; ``offsets(part)`` encodes a part and gives its
    tokens' (begin, end). ``longest``: characters of the longest special token;
    what both chunks hold of it must show on both sides of a splice."""
    if overlap < 4 * longest or chunk < 2 * overlap:
        raise ValueError(f"an overlap of {overlap} in chunks of {chunk} is too small for special tokens of {longest} characters")
    total, begin, size = 0, 0, len(text)
    left = None
    end = min(size, begin + chunk)
    while True:
        if left is None:
            left = [(a + begin, b + begin) for a, b in offsets(text[begin:end])]
        if end == size:
            return total + len(left)
        width, p = overlap, None
        while p is None:
            start = max(begin + 1, end - width)
            until = min(size, start + max(chunk, 2 * width))
            # the last tokens of the left chunk may end early, the first of the right may begin late
            guard = max(longest, width // 8)
            right = [(a + start, b + start) for a, b in offsets(text[start:until])]
            p = splice(text, left, right, start + guard, end - guard)
            if p is None:
                if until == size and end == size:
                    break
                width *= 4
                end = min(size, end + width)
                left = [(a + begin, b + begin) for a, b in offsets(text[begin:end])]
                if end == size:
                    return total + len(left)
        total += sum(1 for a, _ in left if a < p)
        left = [x for x in right if x[0] >= p]
        begin, end = p, until


class Counter:
    """A ``tokenizers`` file with the counts of words seen before."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = tok = Tokenizer.from_file(path)
        tok.no_truncation()
        tok.no_padding()
        told = json.loads(tok.to_str())
        steps = (told["normalizer"] or {}).get("normalizers", [])
        first = (told["pre_tokenizer"] or {}).get("pretokenizers", [{}])[0]
        if [n["type"] for n in steps] != STEPS or steps[1]["pattern"] != {"Regex": r"\s+"} or first.get("pattern") != {"Regex": PATTERN}:
            raise ValueError(f"{path}: the stable boundaries are not proven for its normaliser and pre-tokens")
        added = told["added_tokens"]
        if any(WHITE.search(t["content"]) for t in added):
            raise ValueError(f"{path}: special tokens with white space")
        self.longest = max([1, *(len(t["content"]) for t in added)])
        self.memo: dict[str, int] = {}

    def offsets(self, part: str) -> list:
        return self.tok.encode(part, add_special_tokens=False).offsets

    def words(self, texts: list[str]) -> list[int]:
        """Counts of whole texts, word by word."""
        split = [WHITE.split(t) for t in texts]
        new = list(set(itertools.chain.from_iterable(split)) - self.memo.keys())
        if len(self.memo) + len(new) > MEMO:
            self.memo.clear()
            new = list(set(itertools.chain.from_iterable(split)))
        self.memo.update(zip(new, map(len, self.tok.encode_batch_fast(new, add_special_tokens=False))))
        return [sum(map(self.memo.__getitem__, s)) for s in split]


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    """One a worker process, kept from task to task."""
    return Counter(path)


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 2048, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row of ``docs``
    (doc_id, text), by the ``tokenizers`` file at ``vocabulary`` (a path that
    every worker has), without added special tokens; special strings inside a
    text are handled as the library does by default. A chunk must hold two
    overlaps and an overlap four of the longest special tokens (ValueError).

    A null text counts as empty (0 bytes, 0 tokens). Repeated rows and null
    doc_ids are counted row by row. An empty table gives an empty result.
    Other columns are not read.
    """
    ready(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from rawline.llm.tokens import counter

        own = counter(vocabulary)
        for batch in batches:
            for b in (batch.slice(k, CALL) for k in range(0, batch.num_rows, CALL)):
                texts = [t or "" for t in b["text"].to_pylist()]
                n = np.zeros(len(texts), np.int64)
                short = [i for i, t in enumerate(texts) if len(t) <= chunk]
                n[short] = own.words([texts[i] for i in short])
                for i, t in enumerate(texts):
                    if len(t) > chunk:
                        n[i] = count_long(t, own.offsets, chunk, overlap, own.longest)
                size = np.array([len(t.encode("utf-8", "surrogatepass")) for t in texts], np.int64)
                yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(size), pa.array(n), pa.array(n > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
