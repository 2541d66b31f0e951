"""Encoding of whole texts by a merge-type piece model (SentencePiece BPE with byte fallback), by backtracking, and decoding.

The model merges, again and again, the neighbours whose union has the best score, the leftmost first among equals. The
same pieces are found from left to right: a sequence is the model's exactly if every two neighbours in it would stay
apart when their text is merged by itself. An Aho-Corasick automaton gives the longest piece at each place; a piece
that its left neighbour would merge with gives way to its longest proper prefix, and where none is left, the place is
marked as failed in a bitfield and the piece before gives way. Every place fails at most once, so time is linear.
Pieces that the model itself would never keep together are left out of the automaton. Single characters outside the
vocabulary are pieces as well and become their bytes' ids.

Texts are cut first where the vocabulary has no piece that reaches over (before a space mark, around characters that no
longer piece holds, and between letters and others, if its pieces allow that); equal units are encoded once in a task as long as ``remember`` of them are kept.
Long texts are worked on in parts of about ``part`` characters, cut between units.

The library (``sentencepiece``) normalises texts before and decodes ids after; merging is done here. Null and empty
texts have no ids. Repeated rows and keys are encoded row by row. Models without byte pieces are refused. Of the input
only ``key`` and ``text`` are read, so other columns never clash.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seatplan.llm import common

SPACE = "▁"
EVERYTHING = "(?s:.+)"


@dataclass(frozen=True)
class Settings:
    #: Units, and pairs of pieces, that a task remembers.
    remember: int = 1 << 19
    #: Longer units are not remembered.
    unit: int = 48
    #: Characters worked on at once.
    part: int = 1 << 18


class Model:
    """The vocabulary of a model file, and exact encoding of units with it."""

    def __init__(self, path: str, settings: Settings):
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.settings = settings
        lib = self.library
        plain = [i for i in range(lib.vocab_size()) if not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i) or lib.is_unused(i))]
        self.id_of = {lib.id_to_piece(i): i for i in plain}
        self.score = {lib.id_to_piece(i): lib.get_score(i) for i in plain}
        self.bytes = [lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if not all(lib.is_byte(i) for i in self.bytes):
            raise ValueError(f"{path} has no byte pieces")
        kept = {p for p in self.id_of if len(p) == 1 or self.merged(p) == [p]}
        self.automaton = ahocorasick.Automaton()
        for p in kept:
            if len(p) > 1:
                self.automaton.add_word(p, (len(p) - 1, p))
        self.automaton.make_automaton()
        #: Of each longer piece: the longest proper prefix that is a piece (one character always is).
        self.shorter = {p: next(p[:n] for n in range(len(p) - 1, 0, -1) if n == 1 or p[:n] in kept) for p in kept if len(p) > 1}
        self.units = re.compile(self._cuts())
        self.known: dict[str, tuple[int, ...]] = {}
        self.apart: dict[tuple[str, str], bool] = {}

    def _cuts(self) -> str:
        """The pattern of units: where one ends, no piece reaches over the border."""
        pairs = {p[i : i + 2] for p in self.id_of for i in range(len(p) - 1)}
        if any(y == SPACE != x for x, y in pairs):
            return EVERYTHING
        inner = {c for pair in pairs for c in pair} - {SPACE}
        letters = {c for c in inner if c.isalpha()}
        mixed = any((x in letters) != (y in letters) for x, y in pairs if x != SPACE)
        groups = [inner] if mixed else [letters, inner - letters]
        return "|".join([f"{SPACE}*[{re.escape(''.join(sorted(g)))}]+" for g in groups if g] + [f"{SPACE}+", "(?s:.)"])

    def merged(self, text: str) -> list[str]:
        """The pieces of a short text by merging."""
        parts, score = list(text), self.score
        while len(parts) > 1:
            best, at = None, 0
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fits(self, pair: tuple[str, str]) -> bool:
        """Whether two pieces stay apart when their text is merged anew."""
        if len(self.apart) >= self.settings.remember:
            self.apart.clear()
        found = self.apart[pair] = self.merged(pair[0] + pair[1]) == [*pair]
        return found

    def pieces(self, unit: str) -> list[str]:
        longest = list(unit)
        for end, (more, piece) in self.automaton.iter(unit):
            longest[end - more] = piece
        size, failed = len(unit), None
        apart, shorter_of = self.apart, self.shorter
        stack: list[str] = []
        at, before, piece = 0, None, longest[0]
        while at < size:
            end = at + len(piece)
            if failed is None or not failed[end >> 3] >> (end & 7) & 1:
                if before is None:
                    fits = True
                else:
                    fits = apart.get((before, piece))
                    if fits is None:
                        fits = self.fits((before, piece))
                if fits:
                    stack.append(piece)
                    at, before = end, piece
                    if at < size:
                        piece = longest[at]
                    continue
            shorter = shorter_of.get(piece)
            while shorter is None:
                if failed is None:
                    failed = bytearray((size >> 3) + 1)
                failed[at >> 3] |= 1 << (at & 7)
                piece = stack.pop()
                at -= len(piece)
                before = stack[-1] if stack else None
                shorter = shorter_of.get(piece)
            piece = shorter
        return stack

    def ids(self, unit: str) -> tuple[int, ...]:
        found = self.pieces(unit)
        try:
            out = tuple([self.id_of[p] for p in found])
        except KeyError:
            out = tuple([i for p in found for i in ([self.id_of[p]] if p in self.id_of else [self.bytes[b] for b in p.encode()])])
        if len(unit) <= self.settings.unit:
            if len(self.known) >= self.settings.remember:
                self.known.clear()
            self.known[unit] = out
        return out

    def parts(self, text: str) -> Iterator[str]:
        """The normalised text in parts that end where a unit ends."""
        at, size = 0, self.settings.part
        border = re.compile(f"(?<=[^{SPACE}]){SPACE}")
        while at < len(text):
            to = len(text)
            if to - at > size and self.units.pattern != EVERYTHING:
                found = border.search(text, at + size)
                to = found.start() if found else to
            yield text[at:to]
            at = to

    def encode(self, text: str) -> Iterator[list[int]]:
        """The ids, part by part."""
        known = self.known
        for part in self.parts(self.library.normalize(text)):
            out: list[int] = []
            for unit in self.units.findall(part):
                found = known.get(unit)
                out += self.ids(unit) if found is None else found
            yield out

    def decode(self, parts: list[list[int]]) -> Iterator[str]:
        """The text of ids given in parts. Only a text's beginning loses a space, so later parts are read behind a letter."""
        for k, ids in enumerate(parts):
            yield self.library.decode(ids) if not k else self.library.decode([self._letter, *ids])[1:]

    @property
    def _letter(self) -> int:
        return self.id_of["a"] if "a" in self.id_of else self.bytes[ord("a")]


@lru_cache(maxsize=2)
def model(path: str, settings: Settings) -> Model:
    return Model(path, settings)


def _decimals(parts: list[list[int]]) -> Iterator[str]:
    for k, ids in enumerate(x for x in parts if x):
        yield ("," if k else "") + str(ids)[1:-1].replace(" ", "")


def _run(docs: DataFrame, path: str, settings: Settings, key: str, names: list[str], kinds: str, row, types: list[pa.DataType]) -> DataFrame:
    common.small_batches(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = model(path, settings)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = [row(of, list(of.encode(t)) if t else []) for t in part.column("_text").to_pylist()]
                cells = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
                yield pa.record_batch([part.column("_key"), *cells], names=[key, *names])

    given = docs.select(F.col(key).alias("_key"), F.col("text").cast("string").alias("_text"))
    return given.mapInArrow(run, f"`{key}` {kind}, {kinds}")


def encode(docs: DataFrame, path: str, settings: Settings | None = None, key: str = "doc_id") -> DataFrame:
    """``key``, ``n_tokens``, ``ids`` and ``decoded`` (the text of the ids) of every row."""

    def row(of: Model, parts: list[list[int]]) -> tuple[int, list[int], str]:
        return sum(map(len, parts)), [i for p in parts for i in p], "".join(of.decode(parts))

    return _run(docs, path, settings or Settings(), key, ["n_tokens", "ids", "decoded"], "n_tokens long, ids array<int>, decoded string", row, [pa.int64(), pa.list_(pa.int32()), pa.string()])


def digests(docs: DataFrame, path: str, settings: Settings | None = None, key: str = "doc_id") -> DataFrame:
    """``key``, ``n_tokens`` and the sha256 of the ids as decimals joined by commas, and of the decoded text."""

    def row(of: Model, parts: list[list[int]]) -> tuple[int, str, str]:
        ids, text = hashlib.sha256(), hashlib.sha256()
        for x in _decimals(parts):
            ids.update(x.encode())
        for x in of.decode(parts):
            text.update(x.encode())
        return sum(map(len, parts)), ids.hexdigest(), text.hexdigest()

    return _run(docs, path, settings or Settings(), key, ["n_tokens", "ids_sha256", "decoded_sha256"], "n_tokens long, ids_sha256 string, decoded_sha256 string", row, [pa.int64(), pa.string(), pa.string()])
