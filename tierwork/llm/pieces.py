"""SentencePiece encoding and decoding with a table of the last token of every prefix.

A merge-type vocabulary gives every text one encoding. Two neighbouring tokens are compatible if the
text of both, encoded alone, gives just these two; an encoding is a row of tokens whose neighbours are
all compatible, and every prefix of a text ends, in its own encoding, with one token that follows
from the prefixes before. So the table is filled from left to right: an automaton names the pieces
that end at each character, and the one that is compatible with the last token of the prefix before
it is stored. The tokens are then read backwards from the end. Merging itself is only done on
two tokens at a time, and its outcome is remembered.

Texts are cut first where no piece of the vocabulary can lie across: before a blank that follows
another character, and between characters that no chain of pieces connects, such as letters and
commas. Each part has its own encoding, and those of frequent parts are remembered, in memory of a
fixed size.

Runs of blanks are the exception to the rule above: their pieces have no order of merging among
each other, so what a merge gives is not decided by pairs alone. A run is encoded by merging from the
left, which is what all equal ranks mean.

At scale: one pass over the documents, nothing is shuffled; the vocabulary file travels as a broadcast
of its bytes, half a megabyte.

Defined cases: a null text is the empty one, which has only the begin and end ids; texts of any
length are encoded whole; rows that repeat a doc_id give a row each; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import pairwise
from struct import pack, unpack

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from tierwork.llm.words import by_slices

BLANK = "▁"
NO_PIECE = float("-inf")
#: Parts of texts whose encodings are remembered at a time: the newer half and the older half.
REMEMBERED = 400_000
REMEMBERED_PAIRS = 600_000
#: Characters of a part that is not remembered.
LONG_PART = 64


class Pieces:
    """Encoder and decoder of one merge-type vocabulary with byte pieces, an added first blank and
    texts taken as they are."""

    def __init__(self, model: bytes):
        vocabulary = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.begin, self.end, self.unknown = vocabulary.bos_id(), vocabulary.eos_id(), vocabulary.unk_id()
        self.id_of: dict[str, int] = {}
        self.rank: dict[str, float] = {}
        self.byte_ids = [0] * 256
        self.bytes_of: dict[int, int] = {}
        self.text_of: dict[int, str] = {}
        for number in range(vocabulary.get_piece_size()):
            piece = vocabulary.id_to_piece(number)
            if vocabulary.is_byte(number):
                value = int(piece[3:5], 16)
                self.byte_ids[value], self.bytes_of[number] = number, value
            elif not (vocabulary.is_control(number) or vocabulary.is_unknown(number)):
                self.id_of[piece] = number
                self.rank[piece] = vocabulary.get_score(number)
                self.text_of[number] = piece.replace(BLANK, " ")
        self._longest_run = max((len(x) for x in self.id_of if not x.strip(BLANK)), default=1)
        self._cut = re.compile(self._parts())
        self._known_pairs = 0
        self._fits: dict[str, dict[str, bool]] = {}
        self._build_automaton([x for x in self.id_of if len(x) == 1 or self.merged(x) == [x]])
        self.remembered = _Remembered(self)
        self._first, self._last = pack("<I", self.begin), pack("<I", self.end)

    def _parts(self) -> str:
        """A pattern for parts of a text that no piece reaches beyond. Characters that stand side by
        side in some piece are of one kind, and so are those of the same kind as a third one."""
        across = set()
        for piece in self.id_of:
            across.update(pairwise(piece))
        if any(right == BLANK != left for left, right in across):
            return r"(?s).+"
        kind: dict[str, set[str]] = {}
        for left, right in across:
            if left != BLANK:
                one, other = kind.setdefault(left, {left}), kind.setdefault(right, {right})
                if one is not other:
                    one |= other
                    kind.update(dict.fromkeys(other, one))
        kinds = sorted({id(x): x for x in kind.values()}.values(), key=len, reverse=True)
        runs = [f"{BLANK}*[{''.join(map(re.escape, sorted(x)))}]+" for x in kinds]
        return "(?s)" + "|".join([*runs, f"{BLANK}+.?" if self._takes_blank(kind) else f"{BLANK}+", "."])

    def _takes_blank(self, kind: dict[str, set[str]]) -> bool:
        """Whether some piece is a blank before a character that occurs in no other longer piece."""
        return any(len(x) > 1 and x[0] == BLANK and x[-1] != BLANK and x[-1] not in kind for x in self.id_of)

    def _build_automaton(self, pieces: list[str]) -> None:
        """States are the beginnings of pieces. ``_next`` leads from a state over a character,
        ``_fall`` to the longest shorter state the text also ends with, and ``_ends`` has the pieces the
        text ends with in a state, longest first, with their lengths and the tokens they are known
        to fit."""
        self._next: list[dict[str, int]] = [{}]
        self._fall, self._ends = [0], [()]
        for piece in pieces:
            state = 0
            for character in piece:
                following = self._next[state].get(character)
                if following is None:
                    following = self._next[state][character] = len(self._next)
                    self._next.append({})
                    self._fall.append(0)
                    self._ends.append(())
                state = following
            self._ends[state] = ((piece, len(piece), self._fits.setdefault(piece, {})),)
        front = list(self._next[0].values())
        while front:
            behind = []
            for state in front:
                for character, following in self._next[state].items():
                    self._fall[following] = self._step(self._fall[state], character)
                    self._ends[following] += self._ends[self._fall[following]]
                    behind.append(following)
            front = behind

    def _step(self, state: int, character: str) -> int:
        following = self._next[state].get(character)
        while following is None and state:
            state = self._fall[state]
            following = self._next[state].get(character)
        return following or 0

    def merged(self, text: str) -> list[str]:
        """The text as merging gives it: the best-ranked neighbours first, the leftmost of equal
        ones. For short texts: pairs of tokens, and runs of blanks."""
        parts, rank = list(text), self.rank
        ranks = [rank.get(left + right, NO_PIECE) for left, right in pairwise(parts)]
        while ranks:
            best = max(ranks)
            if best == NO_PIECE:
                break
            at = ranks.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del ranks[at]
            if at < len(ranks):
                ranks[at] = rank.get(parts[at] + parts[at + 1], NO_PIECE)
            if at:
                ranks[at - 1] = rank.get(parts[at - 1] + parts[at], NO_PIECE)
        return parts

    def compatible(self, left: str, right: str) -> bool:
        """Whether two tokens are what merging makes of their text; remembered."""
        fits = self._fits.setdefault(right, {})
        known = fits.get(left)
        if known is None:
            if self._known_pairs >= REMEMBERED_PAIRS:
                for seen in self._fits.values():
                    seen.clear()
                self._known_pairs = 0
            self._known_pairs += 1
            known = fits[left] = self.merged(left + right) == [left, right]
        return known

    def tokens(self, part: str) -> list[str]:
        """The encoding of a part, as pieces; a character of its own that is no piece stays as it is.
        Of a run of blanks before a word the last one goes with the word, if a piece takes it."""
        blanks = len(part) - len(part.lstrip(BLANK))
        if blanks < 2 and blanks < len(part):
            return self._by_prefixes(part)
        if blanks == len(part):
            return self._run(blanks)
        found = self._by_prefixes(part[blanks - 1 :])
        if found[0] == BLANK:
            return self._run(blanks) + found[1:]
        return self._run(blanks - 1) + found

    def _run(self, blanks: int) -> list[str]:
        """A run of blanks. Merging from the left fills the longest piece of blanks and begins
        anew behind it, so a long run is that piece again and again."""
        longest = BLANK * self._longest_run
        if blanks <= 4 * len(longest) or self.merged(4 * longest)[0] != longest:
            return self.merged(BLANK * blanks)
        whole = blanks // len(longest) - 2
        return [longest] * whole + self.merged(BLANK * (blanks - whole * len(longest)))

    def _by_prefixes(self, part: str) -> list[str]:
        last = [""]
        state = stop = 0
        for character in part:
            state = self._next[state].get(character) or self._step(state, character)
            stop += 1
            for token, length, fits in self._ends[state]:
                before = last[stop - length]
                if not before or fits.get(before) or self.compatible(before, token):
                    last.append(token)
                    break
            else:
                last.append(character)
        found = []
        while stop:
            token = last[stop]
            found.append(token)
            stop -= len(token)
        return found[::-1]

    def ids(self, part: str) -> list[int]:
        found: list[int] = []
        for token in self.tokens(part):
            number = self.id_of.get(token)
            if number is None:
                found += [self.byte_ids[value] for value in token.encode()]
            else:
                found.append(number)
        return found

    def encode(self, text: str) -> bytes:
        """The ids of a text between the begin and end ids, as little-endian 32-bit numbers."""
        return self.encode_and_decode(text)[0]

    def encode_and_decode(self, text: str) -> tuple[bytes, str]:
        """The ids as ``encode`` gives them, and the text that ``decode`` makes of them."""
        marked = BLANK + text.replace(" ", BLANK) if text else ""
        parts = self._cut.findall(marked)
        odd = self.remembered.odd
        odd.clear()
        ids = b"".join([self._first, *map(self.remembered.newer.__getitem__, parts), self._last])
        if odd:
            decoded = "".join([odd[part] if part in odd else part.replace(BLANK, " ") for part in parts])
        else:
            decoded = marked.replace(BLANK, " ")
        return ids, decoded.removeprefix(" ")

    def decode_ids(self, ids: list[int]) -> str:
        """The text of ids, with its first blank: byte ids together make characters, where they do."""
        text, pending = [], bytearray()
        for number in ids:
            if number in self.bytes_of:
                pending.append(self.bytes_of[number])
                continue
            text.append(_characters(pending))
            pending.clear()
            text.append(" ⁇ " if number == self.unknown else self.text_of.get(number, ""))
        text.append(_characters(pending))
        return "".join(text)

    def decode(self, ids: bytes) -> str:
        return self.decode_ids(list(unpack(f"<{len(ids) // 4}I", ids))).removeprefix(" ")


def _characters(values: bytearray) -> str:
    return bytes(values).decode("utf-8", "replace") if values else ""


class _Remembered:
    """The ids of parts that decode to themselves, which is nearly all of them. When the newer half
    is full it becomes the older one; parts still in use move over again. ``odd`` has the decoded
    text of the other parts of the text at hand."""

    def __init__(self, pieces: Pieces):
        self.older: dict[str, bytes] = {}
        self.odd: dict[str, str] = {}
        self.newer = _Half(self, pieces)


class _Half(dict):
    def __init__(self, both: _Remembered, pieces: Pieces):
        super().__init__()
        self.both, self.pieces = both, pieces

    def __missing__(self, part: str) -> bytes:
        known = self.both.older.get(part)
        if known is None:
            ids = self.pieces.ids(part)
            known, decoded = pack(f"<{len(ids)}I", *ids), self.pieces.decode_ids(ids)
            if decoded != part.replace(BLANK, " "):
                self.both.odd[part] = decoded
                return known
            if len(part) > LONG_PART:
                return known
        if len(self) >= REMEMBERED // 2:
            self.both.older = dict(self)
            self.clear()
        self[part] = known
        return known


_loaded: dict[bytes, Pieces] = {}


def loaded(model: bytes) -> Pieces:
    """The encoder, made once in a worker process."""
    key = hashlib.sha256(model).digest()
    if key not in _loaded:
        _loaded[key] = Pieces(model)
    return _loaded[key]


def encoded_and_decoded(documents: DataFrame, model: bytes) -> DataFrame:
    """Per document ``doc_id``, ``ids`` (little-endian unsigned 32-bit numbers) and ``decoded``."""
    sent = documents.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = loaded(sent.value)

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [pieces.encode_and_decode(x or "") for x in batch.column("text").to_pylist()]
            return pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([x[0] for x in found], pa.binary()),
                    pa.array([x[1] for x in found], pa.string()),
                ],
                ["doc_id", "ids", "decoded"],
            )

        return by_slices(batches, "text", one)

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(
        work, f"doc_id {kind}, ids binary, decoded string"
    )
