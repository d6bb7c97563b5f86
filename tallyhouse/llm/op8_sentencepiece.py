"""SentencePiece encoding and decoding as a weighted finite-state transducer.

Compiled once per worker from the model file: the normaliser (a leading space, spaces as U+2581), the
pieces, and byte fallback for characters that no piece has. Composed with an input, a state is (place,
last piece); an arc reads one more piece. The model is of the BPE kind, so the weight of an arc is not a
piece score: it is 0 if the two pieces stand side by side when their joined text is encoded alone, and
infinite otherwise. Byte-pair merging is local: a sequence of pieces is the encoding of its text exactly if
every two neighbours are so. Hence every place has one state of finite weight, and the encoding is the one path
of finite weight, which is the shortest in the (min, +) semiring. It is searched depth first, longest piece
first; a place left behind is never reached again, so the work is linear. Arc weights are found when first
needed and kept.

No piece has a space inside or at its end, so the path can be cut before each run of spaces, and before the
marks at a word's end where no piece has the two letters side by side. The parts, which repeat, are kept in a
bounded table: a full one becomes the older one, whose parts come back when they are met again. Workers outlive
their task, and idle ones hold their tables beside later stages, so the tables are small.

Decoding runs the inverse: pieces to bytes, U+2581 to spaces, the leading space off. Bytes are gathered for a whole
batch at once. ``encode_and_decode`` does both in one worker, so that ids don't travel between two.

Defined results: null and empty texts have no ids and decode to the empty text (null: null).
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.tables import bounded_batches, read, widened, without
from tallyhouse.llm.wordspans import chunks

MODEL = "piece_bpe_32k.model"
#: Parts that a worker keeps (as many again in the older table), the longest part that is kept, and arcs.
KEPT, KEPT_LENGTH, ARCS = 100_000, 48, 250_000
#: Letters by which the longest piece at a place is looked up first, and how many such windows are kept.
WINDOWS, WINDOWS_KEPT = (4, 8), 100_000
SPACE = "▁"
#: Marks that may be cut off the end of a word.
MARKS = ".,:;!?'\"()*#$%&|<>-"
_NONE, _LONGER = -1, -2


class Transducer(dict):
    """Part of a normalised text -> its ids as int32 bytes."""

    def __init__(self, file: str):
        model = sentencepiece.SentencePieceProcessor(model_file=file)
        size = model.get_piece_size()
        skip = [i for i in range(size) if model.is_control(i) or model.is_unknown(i) or model.is_byte(i)]
        usable = sorted(set(range(size)) - set(skip))
        self.text = {i: model.id_to_piece(i) for i in usable}
        self.ids = {t: i for i, t in self.text.items()}
        self.score = {t: model.get_score(i) for t, i in self.ids.items()}
        self.bytes = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        #: What each id stands for when decoded.
        surface = [b""] * size
        for i, t in self.text.items():
            surface[i] = t.replace(SPACE, " ").encode("utf-8")
        for b, i in enumerate(self.bytes):
            surface[i] = bytes([b])
        # A second time as the first of a text, without a leading space; a space that came as a byte is none.
        led = [x[i in self.text and x[:1] == b" " :] for i, x in enumerate(surface)]
        self.n_ids, self.surface = size, pa.array(surface + led, pa.large_binary())
        self.letters = set("".join(self.ids))
        # Both are true of this model and make the cut at spaces and at unknown letters exact.
        if any(SPACE in t.lstrip(SPACE) for t in self.ids) or not self.letters <= self.ids.keys():
            raise ValueError("the model has pieces with inner spaces, or letters that are no pieces")
        #: Letters that stand side by side in a piece. No merge crosses any other two, so the path may be cut there.
        self.pairs = {t[k : k + 2] for t in self.ids for k in range(len(t) - 1)}
        #: Each piece and each beginning of one; its id, or _NONE if it is no piece itself.
        self.known = {t[:k]: self.ids.get(t[:k], _NONE) for t in self.ids for k in range(1, len(t) + 1)}
        #: For each id its letters and the next shorter piece that begins it.
        self.size = [len(self.text.get(i, "")) for i in range(size)]
        self.shorter = [_NONE] * size
        for i, t in self.text.items():
            self.shorter[i] = next((self.ids[t[:k]] for k in range(len(t) - 1, 0, -1) if t[:k] in self.ids), _NONE)
        alone = "".join(c for c in "\n\r\t" if c not in self.letters)
        stop = re.escape(SPACE + alone)
        self.parts = re.compile(f"{SPACE}*[^{stop}]+|{SPACE}+" + (f"|[{re.escape(alone)}]+" if alone else ""))
        self.arcs: dict[int, bool] = {}
        #: Letters that stand at a place -> its longest piece, or _LONGER if more letters decide.
        self.near: dict[str, int] = {}
        self.older: dict[str, bytes] = {}

    def side_by_side(self, a: int, b: int) -> bool:
        """Whether the joined text of two pieces is encoded as these two: the arc's weight is finite."""
        left, right = self.text[a], self.text[b]
        symbols, score = list(left + right), self.score
        while True:
            best, at = None, -1
            for i in range(len(symbols) - 1):
                s = score.get(symbols[i] + symbols[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                return symbols == [left, right]
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]

    def longest(self, part: str, at: int) -> int:
        """The longest piece that stands at a place, or _NONE."""
        near = self.near
        for width in WINDOWS:
            window = part[at : at + width]
            piece = near.get(window)
            if piece is None:
                if len(near) >= WINDOWS_KEPT:
                    near.clear()
                # Letters that begin a longer piece decide nothing, unless the part ends with them: then they are no full window.
                piece = near[window] = _LONGER if len(window) == width and window in self.known else self.walked(window, 0)
            if piece != _LONGER:
                return piece
        return self.walked(part, at)

    def walked(self, part: str, at: int) -> int:
        """``longest``, letter by letter."""
        known, found = self.known.get, _NONE
        for end in range(at + 1, len(part) + 1):
            piece = known(part[at:end])
            if piece is None:
                break
            if piece >= 0:
                found = piece
        return found

    def path(self, part: str) -> list[int]:
        """Ids of the shortest path; a letter without a piece is an arc of its own and what follows it is free."""
        arcs, shorter, size, n, near, width = self.arcs, self.shorter, self.size, len(part), self.near.get, WINDOWS[0]
        out: list[int] = []  # pieces, and ~ letter for each byte fallback
        at, before, fallback = 0, _NONE, False
        piece = near(part[:width], _LONGER)
        if piece == _LONGER:
            piece = self.longest(part, 0)
        while at < n:
            if piece == _NONE and part[at] not in self.letters:
                out.append(~ord(part[at]))
                at, before, fallback = at + 1, _NONE, True
                piece = self.longest(part, at)
                continue
            while piece >= 0 and before >= 0:
                arc = before << 20 | piece
                ok = arcs.get(arc)
                if ok is None:
                    if len(arcs) >= ARCS:
                        arcs.clear()
                    ok = arcs[arc] = self.side_by_side(before, piece)
                if ok:
                    break
                piece = shorter[piece]
            if piece >= 0:
                out.append(piece)
                at, before = at + size[piece], piece
                piece = near(part[at : at + width], _LONGER)
                if piece == _LONGER:
                    piece = self.longest(part, at)
            else:  # no arc leads on: take the last one back and try the next shorter piece
                last = out.pop()
                at -= size[last]
                before = out[-1] if out and out[-1] >= 0 else _NONE
                piece = shorter[last]
        if fallback:
            return [i for x in out for i in ([x] if x >= 0 else [self.bytes[b] for b in chr(~x).encode("utf-8")])]
        return out

    def __missing__(self, part: str) -> bytes:
        raw = self.older.get(part)
        if raw is None:
            word = part.rstrip(MARKS)
            if word and len(word) < len(part) and part[len(word) - 1 : len(word) + 1] not in self.pairs:
                raw = self[word] + self[part[len(word) :]]
            else:
                raw = array("i", self.path(part)).tobytes()
        if len(part) <= KEPT_LENGTH:
            if len(self) >= KEPT:
                self.older = dict(self)
                self.clear()
            self[part] = raw
        return raw

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        return b"".join(map(self.__getitem__, self.parts.findall(SPACE + text.replace(" ", SPACE))))

    def decode(self, lists: pa.ListArray) -> pa.Array:
        """Ids to text, for each list. Bytes that are no UTF-8 become replacement characters, as the library does."""
        flat = lists.flatten()
        if flat.null_count:
            raise ValueError("an id is null")
        ids, counts = flat.to_numpy().astype(np.int64), lists.value_lengths().fill_null(0).to_numpy()
        if len(ids) and not 0 <= ids.min() <= ids.max() < self.n_ids:
            raise ValueError("an id is not of the model")
        ends = np.cumsum(counts, dtype=np.int64)
        ids[(ends - counts)[counts > 0]] += self.n_ids
        raw = self.surface.take(pa.array(ids))
        at = np.frombuffer(raw.buffers()[1], np.int64)[np.concatenate(([0], ends))]
        nulls = pa.array(lists.is_valid()).buffers()[1] if lists.null_count else None
        texts = pa.Array.from_buffers(pa.large_binary(), len(lists), [nulls, pa.py_buffer(at), raw.buffers()[2]])
        try:
            return texts.cast(pa.string())
        except pa.ArrowInvalid:
            return pa.array([x if x is None else x.decode("utf-8", errors="replace") for x in texts.to_pylist()], pa.string())


_MODELS: dict[str, Transducer] = {}


def transducer(model: str) -> Transducer:
    if model not in _MODELS:
        _MODELS[model] = Transducer(public_tokenizers.path(model))
    return _MODELS[model]


def _worked(docs: DataFrame, text: str, model: str, fields: str) -> DataFrame:
    """``docs`` with ids, n_ids and, if ``fields`` ends with it, the text that the ids stand for."""
    bounded_batches(docs.sparkSession)
    added = T.StructType.fromDDL(fields).names
    docs = without(docs, added)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(model)
        for batch in chunks(batches, text):
            raw = [machine.encode(t) for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]
            at = np.cumsum([0, *map(len, raw)]) // 4
            ids = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(np.frombuffer(b"".join(raw), np.int32)))
            more = [machine.decode(ids)] if len(added) == 3 else []
            yield pa.RecordBatch.from_arrays([*batch.columns, ids, pa.array(np.diff(at), pa.int64()), *more], names=[*names, *added])

    return docs.mapInArrow(run, widened(docs, fields))


def encode(docs: DataFrame, text: str = "text", model: str = MODEL) -> DataFrame:
    """``docs`` with ids (array<int>) and n_ids (long), which replace columns of the same name."""
    return _worked(docs, text, model, "ids array<int>, n_ids long")


def encode_and_decode(docs: DataFrame, text: str = "text", name: str = "decoded", model: str = MODEL) -> DataFrame:
    """``decode(encode(docs))`` in one pass: a null text has no ids, which decode to the empty text."""
    return _worked(docs, text, model, f"ids array<int>, n_ids long, `{name}` string")


def decode(rows: DataFrame, ids: str = "ids", name: str = "decoded", model: str = MODEL) -> DataFrame:
    """``rows`` with the text of their ids; null ids give null, no ids the empty text."""
    bounded_batches(rows.sparkSession)
    rows = without(rows, [name])
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(model)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = machine.decode(part.column(part.schema.get_field_index(ids)))
                yield pa.RecordBatch.from_arrays([*part.columns, texts], names=[*names, name])

    return rows.mapInArrow(run, widened(rows, f"{name} string"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_ids, ids, the SHA-256 of the decoded text, and whether it equals the text."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    both = encode_and_decode(docs)
    return both.select(
        "doc_id",
        "n_ids",
        "ids",
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
        (F.coalesce("decoded", F.lit("")) == F.coalesce("text", F.lit(""))).alias("lossless"),
    )
