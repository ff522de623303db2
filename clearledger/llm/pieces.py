"""SentencePiece encoding and decoding: exact merge-type encoding by backtracking.

A text is cut where no piece of the vocabulary can span: before a run of spaces and around line feeds.
Each part is encoded alone. One Aho-Corasick pass finds the longest piece that starts at each position;
the encoder walks from left to right taking the longest piece whose junction with the piece before it is
stable, that is, re-merging the two pieces' text by the model's own merge order gives the two back. Where
no piece fits it steps back one piece and marks the position as failed in a bitfield, so that no
position is tried twice with the same outcome. The result is the merge order's own segmentation.

Texts: null and empty give the begin and end ids alone. There is no limit on a text's length; the cache of
parts is emptied when it is full and when a task ends, and holds short parts only, so a Python worker that waits for its next task keeps little.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

SPACE = "▁"
#: Parts up to so many characters are remembered, so many at a time; junctions of pieces.
CACHED_CHARS, CACHED_PARTS, CACHED_PAIRS = 48, 100_000, 200_000


class Pieces:
    """Encoder and decoder over the piece table of a merge-type model with byte fallback."""

    def __init__(self, model: bytes):
        table = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = table.vocab_size()
        self.begin, self.end = table.bos_id(), table.eos_id()
        self.ids: dict[str, int] = {}
        self.score: dict[str, float] = {}
        self.byte_ids = [0] * 256
        self.raw: list[bytes] = [b""] * n
        self.is_byte = np.zeros(n, dtype=bool)
        for i in range(n):
            piece = table.id_to_piece(i)
            if table.is_byte(i):
                self.byte_ids[int(piece[1:-1], 16)] = i
                self.raw[i] = bytes([int(piece[1:-1], 16)])
                self.is_byte[i] = True
            elif not (table.is_control(i) or table.is_unknown(i) or table.is_unused(i)):
                self.ids[piece], self.score[piece] = i, table.get_score(i)
                self.raw[i] = piece.replace(SPACE, " ").encode()
        self.packed = {p: i.to_bytes(4, "little") for p, i in self.ids.items()}
        self.find = ahocorasick.Automaton()
        for piece in self.ids:
            self.find.add_word(piece, piece)
        self.find.make_automaton()
        if any("\n" in p or re.search(f"[^{SPACE}]{SPACE}", p) for p in self.ids):
            raise ValueError("the vocabulary has pieces that span words; texts can't be cut at spaces")
        self.parts = re.compile(f"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+")
        self.stable: dict[tuple[str, str], bool] = {}
        self.shorter: dict[str, str] = {}
        self.known: dict[str, bytes] = {}

    def merged(self, text: str) -> list[str]:
        """The segmentation that merging gives: the best-scored pair first, the leftmost of equals."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fits(self, left: str, right: str) -> bool:
        """Whether merging the two pieces' text gives the two back; left is empty at the start of a part."""
        key = (left, right)
        known = self.stable.get(key)
        if known is None:
            if len(self.stable) >= CACHED_PAIRS:
                self.stable.clear()
            known = self.stable[key] = self.merged(left + right) == ([left, right] if left else [right])
        return known

    def prefix(self, piece: str) -> str:
        """The longest shorter piece that starts this one, or its first character; empty if there is none."""
        found = self.shorter.get(piece)
        if found is None:
            found = next((piece[:n] for n in range(len(piece) - 1, 1, -1) if piece[:n] in self.ids), piece[:1])
            self.shorter[piece] = found = "" if len(piece) == 1 else found
        return found

    def segment(self, part: str) -> list[str]:
        longest = list(part)
        for last, piece in self.find.iter(part):
            longest[last - len(piece) + 1] = piece  # later ends are longer
        stable, shorter = self.stable, self.shorter
        failed = 0  # a bit for each position
        out: list[str] = []
        at, n, piece, left = 0, len(part), longest[0], ""
        while at < n:
            while piece:
                to = at + len(piece)
                if not (failed and failed >> to & 1):
                    ok = stable.get((left, piece))
                    if ok or ok is None and self.fits(left, piece):
                        break
                found = shorter.get(piece)
                piece = self.prefix(piece) if found is None else found
            if piece:
                out.append(piece)
                at, left = to, piece
                piece = longest[at] if at < n else ""
            else:
                if not out:
                    raise AssertionError(f"no segmentation of {part[:40]!r}")
                failed |= 1 << at
                piece = out.pop()
                at -= len(piece)
                left = out[-1] if out else ""
                piece = self.prefix(piece)  # tried already from here: go on with the next shorter one
        return out

    def part_ids(self, part: str) -> bytes:
        get, fallback = self.packed.get, self.bytes_of
        packed = b"".join([get(piece) or fallback(piece) for piece in self.segment(part)])
        if len(part) <= CACHED_CHARS:
            if len(self.known) >= CACHED_PARTS:
                self.known.clear()
            self.known[part] = packed
        return packed

    def bytes_of(self, char: str) -> bytes:
        """The byte pieces of a character that is no piece."""
        return np.array([self.byte_ids[b] for b in char.encode()], dtype="<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """All ids of the text, begin and end included, as little-endian unsigned 32-bit integers."""
        known, work = self.known, []
        if text:
            get, slow = known.get, self.part_ids
            work = [get(p) or slow(p) for p in self.parts.findall(SPACE + text.replace(" ", SPACE))]
        ends = np.array([self.begin, self.end], dtype="<u4").tobytes()
        return b"".join([ends[:4], *work, ends[4:]])

    def forget(self) -> None:
        """Let go of the parts, of which the next task has others; junctions stay."""
        self.known.clear()

    def decode(self, packed: bytes) -> str:
        """The text of the ids: the first space stands for the model's own prefix and goes; bytes that are no UTF-8 become U+FFFD."""
        ids = np.frombuffer(packed, dtype="<u4")
        ids = ids[(ids != self.begin) & (ids != self.end)]
        joined = b"".join(map(self.raw.__getitem__, ids.tolist()))
        if len(ids) and not self.is_byte[ids[0]] and joined[:1] == b" ":
            joined = joined[1:]
        return joined.decode("utf-8", errors="replace")


@lru_cache(maxsize=2)
def pieces(model: bytes) -> Pieces:
    """One table per Python worker."""
    return Pieces(model)


def encoder(model: bytes):
    """A column function: text -> struct(ids binary, n_tokens, decoded). Null texts count as empty."""

    @pandas_udf("ids binary, n_tokens long, decoded string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        p = pieces(model)
        for texts in batches:
            ids = [p.encode(t or "") for t in texts]
            yield pd.DataFrame({"ids": ids, "n_tokens": [len(x) // 4 for x in ids], "decoded": [p.decode(x) for x in ids]})
        p.forget()

    return run


def digests(model: bytes):
    """As encoder, but the SHA-256 of the ids and of the decoded text instead of the two themselves."""

    @pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        p = pieces(model)
        for texts in batches:
            rows = []
            for t in texts:
                x = p.encode(t or "")
                rows.append((len(x) // 4, hashlib.sha256(x).hexdigest(), hashlib.sha256(p.decode(x).encode()).hexdigest()))
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
        p.forget()

    return run


def read_model(path: str) -> bytes:
    """The model file (half a megabyte); it travels with the function, so executors need no file."""
    with open(path, "rb") as f:
        return f.read()


def encode_documents(docs: DataFrame, model_path: str, text: str = "text", into: str = "tokens") -> DataFrame:
    """docs with a struct column `into`: ids, n_tokens, decoded. Repeated rows and all other columns stay."""
    return docs.withColumn(into, encoder(read_model(model_path))(F.col(text).cast("string")))


def token_digests(docs: DataFrame, model_path: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of docs: its id, number of ids, and the digests of ids and of the decoded text."""
    one: Column = digests(read_model(model_path))(F.col(text).cast("string"))
    return docs.select(F.col(id_col), one.alias("_t")).select(id_col, "_t.n_tokens", "_t.ids_sha256", "_t.decoded_sha256")
