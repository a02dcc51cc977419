"""Encoding to the ids of a SentencePiece BPE model, and decoding them.

BPE merges the best-scored neighbours first, and yet the last token of the
encoding of every prefix of a text is unique.  So the encoder keeps a table with
one entry per prefix: among the vocabulary entries that an automaton finds to end
there, the one that is compatible with the last token of the prefix before it.
Two tokens are compatible if their joined text encodes to just these two.  Ids
are then recovered backwards from the end.  The time is linear in the text, also
where a text has no spaces.
"""

from __future__ import annotations

import codecs
import hashlib
import re
from array import array

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.common import add_from_text, table
from tidemark.llm.registry import query

SPACE = "▁"
#: Units that a Python process keeps with their ids (twice as many at most), and their length at most.
MEMO_UNITS, MEMO_CHARS, MEMO_PAIRS = 200_000, 48, 200_000


def read_model(path: str) -> dict:
    """The vocabulary of a model: scored pieces, and the ids of the 256 byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, byte_ids = {}, [0] * 256
    for i in range(model.get_piece_size()):
        if model.is_byte(i):
            byte_ids[int(model.id_to_piece(i)[3:5], 16)] = i
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            pieces[model.id_to_piece(i)] = (i, model.get_score(i))
    letters = {c for p in pieces for c in p}
    if not letters <= pieces.keys() or any(a != SPACE and b == SPACE for p in pieces for a, b in zip(p, p[1:])):
        raise ValueError("pieces must be made of letters that are pieces, with spaces only in front")
    name = hashlib.sha256(repr((sorted(pieces.items()), byte_ids)).encode()).hexdigest()
    return {"name": name, "pieces": pieces, "bytes": byte_ids}


# Every byte that is part of no letter becomes a replacement character of its own.
codecs.register_error("each_byte", lambda e: ("\ufffd" * (e.end - e.start), e.end))


class PrefixTable:
    """Encoder and decoder over the vocabulary that ``read_model`` gives."""

    def __init__(self, model: dict):
        import ahocorasick

        self.pieces, self.byte_ids = model["pieces"], model["bytes"]
        size = 1 + max([*(i for i, _ in self.pieces.values()), *self.byte_ids])
        self.text_of, self.length_of, self.byte_of = [""] * size, [0] * size, {}
        self.automaton = ahocorasick.Automaton()
        for piece, (i, _) in self.pieces.items():
            self.text_of[i], self.length_of[i] = piece, len(piece)
            self.automaton.add_word(piece, i)
        self.automaton.make_automaton()
        for b, i in enumerate(self.byte_ids):
            self.byte_of[i] = bytes([b])
            self.text_of[i] = chr(b) if b < 128 else ""
        self.high_bytes = frozenset(self.byte_ids[128:])
        self.letters = frozenset(p for p in self.pieces if len(p) == 1)
        known = "".join(map(re.escape, self.letters))
        self.runs = re.compile(f"[{known}]+|[^{known}]")
        self.neighbours = {p[k:k + 2] for p in self.pieces for k in range(len(p) - 1)}
        # No merge crosses the place before a space that follows something else, nor an unknown line end.
        end = "" if "\n" in self.pieces else "\n"
        self.units = re.compile(f"{SPACE}*[^{SPACE}{end}]+|{SPACE}+" + (f"|{end}" if end else ""))
        self.pairs: dict[int, bool] = {}
        #: Units whose ids decode to another text than the unit; there need not be any.
        self.different: dict[str, str] = {}
        self.encoded = _Memo(self.encode_and_decode_unit)

    def merge(self, text: str) -> list[str]:
        """The pieces of a short text by merging, best score first, leftmost on ties."""
        parts = list(text)
        while True:
            best, at = None, -1
            for k in range(len(parts) - 1):
                found = self.pieces.get(parts[k] + parts[k + 1])
                if found and (best is None or found[1] > best):
                    best, at = found[1], k
            if at < 0:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def compatible(self, left: int, right: int) -> bool:
        """Whether two tokens stay as they are side by side; with ``left`` -1, whether one does alone."""
        a, b = self.text_of[left] if left >= 0 else "", self.text_of[right]
        if len(self.pairs) > MEMO_PAIRS:
            self.pairs.clear()
        known = self.pairs[(left + 1) << 20 | right] = self.merge(a + b) == ([a, b] if a else [b])
        return known

    def _encode_run(self, run: str) -> list[int]:
        last, known, length_of = [-1] * (len(run) + 1), self.pairs.get, self.length_of
        for end, token in self.automaton.iter(run):
            end += 1
            if last[end] < 0:
                before = end - length_of[token]
                left = last[before] if before else -1
                if left >= 0 or not before:
                    fits = known((left + 1) << 20 | token)
                    if self.compatible(left, token) if fits is None else fits:
                        last[end] = token
        ids, at = [], len(run)
        while at:
            ids.append(last[at])
            at -= length_of[last[at]]
        return ids[::-1]

    def encode_unit(self, unit: str) -> bytes:
        """Ids as 32-bit integers.  No merge joins two letters that are neighbours in no piece, so a unit may be cut there."""
        if 1 < len(unit) <= MEMO_CHARS and unit[-2:] not in self.neighbours:  # as before a full stop
            return self.encoded[unit[:-1]] + self.encoded[unit[-1]]
        if self.letters.issuperset(unit):
            return array("i", self._encode_run(unit)).tobytes()
        return array("i", [i for run in self.runs.findall(unit) for i in (
            self._encode_run(run) if run[0] in self.letters else [self.byte_ids[b] for b in run.encode()])]).tobytes()

    def encode_and_decode_unit(self, unit: str) -> bytes:
        """A unit's ids; they are decoded as well, and a text other than the unit is kept."""
        ids = self.encode_unit(unit)
        text = self.joined(array("i", ids).tolist())
        if text != unit:
            self.different[unit] = text
        return ids

    def split(self, text: str) -> list[str]:
        """Parts of a text that encode one by one; the text gets a space in front."""
        return self.units.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def joined(self, ids: list[int]) -> str:
        """Pieces and bytes of ids in order, with the space signs of the pieces."""
        if self.high_bytes.isdisjoint(ids):
            return "".join(map(self.text_of.__getitem__, ids))
        out, pending = [], []
        for i in ids:
            if i in self.byte_of:
                pending.append(self.byte_of[i])
                continue
            if pending:
                out.append(b"".join(pending).decode("utf-8", "each_byte"))
                pending = []
            out.append(self.text_of[i])
        return "".join(out) + b"".join(pending).decode("utf-8", "each_byte")

    @staticmethod
    def spaced(text: str) -> str:
        """Joined pieces as text: without the space in front."""
        return (text[1:] if text.startswith(SPACE) else text).replace(SPACE, " ")

    def decode(self, ids: list[int]) -> str:
        """The text of ids."""
        return self.spaced(self.joined(ids))

    def encode(self, text: str) -> bytes:
        """The ids of a text as 32-bit integers."""
        return b"".join(map(self.encoded.__getitem__, self.split(text)))

    def encode_and_decode(self, text: str) -> tuple[bytes, str]:
        """The ids of a text, and the text that they decode to.

        Units are decoded one by one, each from its ids when it comes into the
        memo; the bytes of a letter are always in one unit.
        """
        units = self.split(text)
        ids = b"".join(map(self.encoded.__getitem__, units))
        if self.different:
            units = [self.different.get(unit, unit) for unit in units]
        return ids, self.spaced("".join(units))


class _Memo(dict):
    """Ids of units met before, as bytes.  When full, the older half is forgotten."""

    def __init__(self, make):
        super().__init__()
        self.make, self.older = make, {}

    def __missing__(self, unit: str) -> bytes:
        found = self.older.get(unit)
        if found is None:
            found = self.make(unit)
        if len(unit) <= MEMO_CHARS:
            if len(self) >= MEMO_UNITS:
                self.older = dict(self)
                self.clear()
            self[unit] = found
        return found


#: The coder of this Python process, with what it has learned from earlier tasks.
_CODER: dict[str, PrefixTable] = {}


def coder_for(model: dict) -> PrefixTable:
    if model["name"] not in _CODER:
        _CODER.clear()
        _CODER[model["name"]] = PrefixTable(model)
    return _CODER[model["name"]]


def encode_texts(docs: DataFrame, model_path: str, decode: bool = True) -> DataFrame:
    """``docs`` with ``ids`` (array of int) and, if asked for, ``decoded`` text.

    Ids are those of the SentencePiece library without begin and end ids and
    without sampling.  A null or empty text has no ids and decodes to an empty
    text.  Letters outside the vocabulary become byte ids.  A text may be of any
    length and need not have spaces.  Columns named ``ids`` or ``decoded`` are
    replaced; repeated rows are encoded like any other.
    """
    model = docs.sparkSession.sparkContext.broadcast(read_model(model_path))

    def start():
        import numpy as np
        import pyarrow as pa

        coder = coder_for(model.value)

        def work(texts: list[str | None]):
            both = [coder.encode_and_decode(text or "") for text in texts] if decode else [(coder.encode(text or ""), "") for text in texts]
            raw = [ids for ids, _ in both]
            values = pa.array(np.frombuffer(b"".join(raw), dtype=np.int32))
            ends = np.cumsum([0, *(len(r) // 4 for r in raw)])
            lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), values)
            return [lists, pa.array([text for _, text in both], pa.string())] if decode else [lists]

        return work

    return add_from_text(docs, "ids array<int>" + (", decoded string" if decode else ""), start)


@query("op5_sentencepiece")
def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents and the texts decoded from them, as digests."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = encode_texts(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return out.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
                      F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))
