"""SentencePiece BPE encoding by backtracking, and decoding.

The library merges, again and again, the neighbouring pair whose joined piece
scores best (leftmost first). The same tokens come without a queue of merges:

* an Aho-Corasick automaton gives the longest piece that begins at each place;
* two pieces may stand side by side only if merging their joined text anew
  gives the two back; a sequence whose neighbours all may is the library's;
* a piece that may not follow, or leads nowhere, gives way to the next shorter
  piece there is, else the piece before it does; a bitfield marks the places
  from which no way leads on, so that none is tried twice.

A text is cut first where no piece can reach over: between two characters that
stand side by side in no piece. The parts between the cuts are independent,
and a bounded memo keeps the bytes of the ids of parts seen before.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ready

SPACE = "▁"
#: Parts and pairs that a worker remembers; full memos start anew.
MEMO = 1 << 18
#: Bits of the table of neighbouring characters (a wrong hit only leaves a cut out).
NEIGHBOURS = 22


class PieceModel:
    """A BPE model with byte fallback and the identity normaliser."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        probe = " Å  ﬁ "  # a normaliser other than the identity would change one of these
        if sp.normalize(probe) != (SPACE + probe).replace(" ", SPACE):
            raise ValueError(f"{path}: only models with the identity normaliser and a dummy prefix are encoded here")
        self.score: dict[str, float] = {}
        self.ids: dict[str, bytes] = {}
        for i in range(sp.get_piece_size()):
            if not (sp.is_control(i) or sp.is_byte(i) or sp.is_unknown(i)):
                if sp.is_unused(i):
                    raise ValueError(f"{path}: unused pieces are not supported")
                self.score[sp.id_to_piece(i)] = sp.get_score(i)
                self.ids[sp.id_to_piece(i)] = i.to_bytes(4, "little")
        self.byte = [sp.piece_to_id(f"<0x{b:02X}>").to_bytes(4, "little") for b in range(256)]
        if any(sp.is_unknown(int.from_bytes(b, "little")) for b in self.byte):
            raise ValueError(f"{path}: no byte fallback")
        self.begin, self.end = sp.bos_id().to_bytes(4, "little"), sp.eos_id().to_bytes(4, "little")
        self.joined = np.zeros(1 << NEIGHBOURS, bool)
        automaton = ahocorasick.Automaton()
        for piece in self.score:
            if self.merge(piece) == [piece]:  # others are never the outcome of merges
                automaton.add_word(piece, piece)
                if len(piece) > 1:
                    self.joined[self._slots(piece)] = True
        automaton.make_automaton()
        self.automaton = automaton
        self.known = set().union(*self.score)
        self.fits: dict[tuple[str, str], bool] = {}
        self.memo: dict[str, bytes] = {}

    @staticmethod
    def _slots(text: str) -> np.ndarray:
        c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        return (c[:-1] * np.uint32(2654435761) ^ c[1:] * np.uint32(2246822519)) >> np.uint32(32 - NEIGHBOURS)

    def merge(self, text: str) -> list[str]:
        """The pieces of a short text, by merging the best pair, leftmost first."""
        parts, score = list(text), self.score
        while True:
            best, at = None, -1
            for k in range(len(parts) - 1):
                s = score.get(parts[k] + parts[k + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, k
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def may_follow(self, a: str, b: str) -> bool:
        ok = self.fits.get((a, b))
        if ok is None:
            if len(self.fits) >= MEMO:
                self.fits.clear()
            ok = self.fits[a, b] = self.merge(a + b) == [a, b]
        return ok

    def pieces(self, text: str) -> list[str]:
        """The pieces of a part, by backtracking over longest matches. A
        character that is no piece stands for itself."""
        size = len(text)
        longest: list[str] = list(text)
        for last, piece in self.automaton.iter(text):  # at one start, longer pieces end later
            longest[last + 1 - len(piece)] = piece
        dead = bytearray(size // 8 + 1)
        out: list[str] = []
        at, piece, score = 0, longest[0], self.score
        while True:
            to = at + len(piece)
            if not dead[to >> 3] >> (to & 7) & 1 and (not out or self.may_follow(out[-1], piece)):
                out.append(piece)
                if to == size:
                    return out
                at, piece = to, longest[to]
                continue
            n = len(piece) - 1
            while n > 1 and (piece[:n] not in score):
                n -= 1
            if n >= 1:
                piece = piece[:n]
                continue
            dead[at >> 3] |= 1 << (at & 7)
            piece = out.pop()  # an empty stack is impossible: the merges of the text are one way
            at -= len(piece)

    def part_ids(self, part: str) -> bytes:
        """Ids of a part, four bytes each, characters without a piece by their bytes."""
        if part in self.ids and self.merge(part) == [part]:
            out = self.ids[part]
        else:
            out = b"".join(
                self.ids[p] if p in self.ids else b"".join(self.byte[b] for b in p.encode("utf-8", "surrogatepass"))
                for p in self.pieces(part)
            )
        if len(self.memo) >= MEMO:
            self.memo.clear()
        if len(part) <= 64:
            self.memo[part] = out
        return out

    def encode(self, text: str) -> bytes:
        """All ids of a text with begin and end, as unsigned 32-bit little-endian integers."""
        if not text:
            return self.begin + self.end
        text = SPACE + text.replace(" ", SPACE)
        cuts = np.flatnonzero(~self.joined[self._slots(text)]) + 1
        bounds = [0, *cuts.tolist(), len(text)]
        memo, new = self.memo.get, self.part_ids
        return b"".join(
            [self.begin, *[memo(p) or new(p) for p in [text[a:b] for a, b in zip(bounds, bounds[1:])]], self.end]
        )

    def decode(self, ids: bytes) -> str:
        return self.library.decode(np.frombuffer(ids, "<u4").tolist())


@lru_cache(maxsize=2)
def piece_model(path: str) -> PieceModel:
    """One model a worker process, kept from task to task with its memos."""
    return PieceModel(path)


def encode_decode(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded) of every row of ``docs`` (doc_id,
    text): the ids as packed unsigned 32-bit little-endian integers with begin
    and end, and the text that they decode to, by the SentencePiece BPE file
    at ``model`` (a path that every worker has).

    A null text counts as empty (begin and end only, decoded to the empty
    text). Repeated rows and null doc_ids are encoded row by row; an empty
    table gives an empty result; other columns are not read.
    """
    ready(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from rawline.llm.pieces import piece_model

        own = piece_model(model)
        for batch in batches:
            for b in (batch.slice(k, 256) for k in range(0, batch.num_rows, 256)):
                ids = [own.encode(t or "") for t in b["text"].to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        b["doc_id"],
                        pa.array([len(i) // 4 for i in ids], pa.int64()),
                        pa.array(ids, pa.binary()),
                        pa.array([own.decode(i) for i in ids], pa.string()),
                    ],
                    ["doc_id", "n_tokens", "ids", "decoded"],
                )

    return docs.select(F.col("doc_id"), "text").mapInArrow(
        run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids binary, decoded string"
    )
