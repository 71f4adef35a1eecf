"""SentencePiece encoding and decoding with an Aho-Corasick automaton.

The automaton over all pieces reads a text once. At each position its output links name the pieces that end there, and each relaxes
the best score of that position; the best segmentation is then read backwards. A character that is no piece may stand alone at
a penalty and is written as byte pieces. Pieces never go from a word into the next word's mark, so words are segmented
one by one and remembered; the result is that of the whole text.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession

from triagegrid.llm.common import Local, unused

SPACE = "▁"
#: Below the lowest score of any piece: what a character that is no piece costs.
PENALTY = 10.0
#: Segmented words that a worker remembers.
REMEMBERED = 200_000
MODEL = "/opt/tokenizers/piece_bpe_32k.model"


@dataclass
class Vocabulary:
    """Pieces and scores of a model file, as plain values that travel to the executors."""

    pieces: list[str]
    scores: list[float]
    bytes_from: dict[int, int]
    special: set[int]

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        every = range(model.get_piece_size())
        of_byte = {int(model.id_to_piece(i)[3:5], 16): i for i in every if model.is_byte(i)}
        special = {i for i in every if model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i)}
        return cls([model.id_to_piece(i) for i in every], [model.get_score(i) for i in every], of_byte, special)


class Codec:
    """Encoder and decoder of one vocabulary; a worker builds it once."""

    def __init__(self, vocabulary: Vocabulary):
        v = self.vocabulary = vocabulary
        if len(v.bytes_from) != 256:
            raise ValueError("the vocabulary has no piece for every byte")
        self.automaton = ahocorasick.Automaton()
        usable = [i for i in range(len(v.pieces)) if i not in v.special and v.pieces[i]]
        for i in usable:
            self.automaton.add_word(v.pieces[i], (len(v.pieces[i]), v.scores[i], i))
        self.automaton.make_automaton()
        self.single = {v.pieces[i] for i in usable if len(v.pieces[i]) == 1}
        self.lone = min((v.scores[i] for i in usable), default=0.0) - PENALTY
        across = any(SPACE in v.pieces[i].lstrip(SPACE) for i in usable)
        self.cut = re.compile("(?s).+" if across else f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        self.raw = [v.pieces[i].replace(SPACE, " ").encode() for i in range(len(v.pieces))]
        for b, i in v.bytes_from.items():
            self.raw[i] = bytes([b])
        for i in v.special - set(v.bytes_from.values()):
            self.raw[i] = b""
        self.shown = [str(i) for i in range(len(v.pieces))]
        self.known: dict[str, list[int]] = {}

    def segment(self, text: str) -> list[int]:
        """The segmentation with the highest sum of scores; of equal ones, that with the longer last piece."""
        n = len(text)
        best, back = [0.0] + [-np.inf] * n, [None] * (n + 1)
        single, lone = self.single, self.lone
        # where every character is a piece, none stands alone
        at = n if single.issuperset(text) else 0

        def alone(end: int) -> None:
            if text[end - 1] not in single and best[end - 1] + lone > best[end]:
                best[end], back[end] = best[end - 1] + lone, (1, lone, -1)

        for last, hit in self.automaton.iter(text):
            end = last + 1
            while at < end - 1:
                at += 1
                alone(at)
            total = best[end - hit[0]] + hit[1]
            if total > best[end]:
                best[end] = total
                back[end] = hit
        while at < n:
            at += 1
            alone(at)
        out, end, of_byte = [], n, self.vocabulary.bytes_from
        while end:
            size, _, piece = back[end]
            if piece >= 0:
                out.append(piece)
            else:
                out += [of_byte[b] for b in reversed(text[end - size : end].encode("utf-8", "surrogatepass"))]
            end -= size
        return out[::-1]

    def encode(self, text: str | None) -> list[int]:
        """Ids of a whole text; null and empty texts have none. A mark of the model in the text itself is written as bytes."""
        if not text:
            return []
        mark = [self.vocabulary.bytes_from[b] for b in SPACE.encode()]
        ids: list[int] = []
        known = self.known
        for i, part in enumerate(text.split(SPACE)):
            if i:
                ids += mark
            marked = part.replace(" ", SPACE)
            for word in self.cut.findall(marked if i else SPACE + marked):
                found = known.get(word)
                if found is None:
                    found = self.segment(word)
                    if len(word) < 64:
                        if len(known) >= REMEMBERED:
                            known.clear()
                        known[word] = found
                ids += found
        return ids

    def decode(self, ids: list[int]) -> str:
        """The text of ids, without the blank that encoding puts first."""
        raw = self.raw
        text = b"".join([raw[i] for i in ids]).decode("utf-8", "surrogatepass")
        return text[1:] if text[:1] == " " else text


_codecs = Local()


def _codec(held) -> Codec:
    if held.id not in _codecs:
        _codecs.clear()
        _codecs[held.id] = Codec(held.value)
    return _codecs[held.id]


class _Held:
    """A broadcast vocabulary with a name under which a worker finds the codec it has built."""

    def __init__(self, spark: SparkSession, path: str):
        self.broadcast = spark.sparkContext.broadcast(Vocabulary.load(path))
        self.id = self.broadcast._jbroadcast.id()

    def __getstate__(self):
        return self.broadcast, self.id

    def __setstate__(self, state):
        self.broadcast, self.id = state

    @property
    def value(self) -> Vocabulary:
        return self.broadcast.value


def encode_documents(docs: DataFrame, model: str = MODEL, column: str = "text") -> DataFrame:
    """``docs`` with two more columns, ``ids`` array<int> and ``n_tokens`` int, in place of a text column; null and empty texts have no ids.

    The new names get underscores in front while ``docs`` has columns of those names, which stay. Each row gives one row, repeated
    ones too; no rows give none. Texts are read whole, however long.
    """
    held, at = _Held(docs.sparkSession, model), docs.columns.index(column)
    keep = [i for i in range(len(docs.columns)) if i != at]
    made = [unused(docs, "ids"), unused(docs, "n_tokens")]

    def run(batches):
        codec = _codec(held)
        for batch in batches:
            for begin in range(0, max(1, batch.num_rows), 500):
                part = batch.slice(begin, 500)
                every = [np.array(codec.encode(t.as_py()), np.int32) for t in part.column(at)]
                sizes = np.array([len(x) for x in every], np.int32)
                flat = np.concatenate(every) if every else np.zeros(0, np.int32)
                ids = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)), pa.array(flat))
                columns = [part.column(i) for i in keep]
                yield pa.RecordBatch.from_arrays([*columns, ids, pa.array(sizes)], names=[*(part.schema.names[i] for i in keep), *made])

    schema = "".join(f"`{docs.columns[i]}` {docs.schema[i].dataType.simpleString()}, " for i in keep)
    return docs.mapInArrow(run, f"{schema}`{made[0]}` array<int>, `{made[1]}` int")


def decode_documents(docs: DataFrame, model: str = MODEL, column: str = "ids") -> DataFrame:
    """``docs`` with one more column, ``text``, in place of a column of ids; null ids give a null text.

    The new name gets underscores in front while ``docs`` has a column of that name, which stays.
    """
    held, at = _Held(docs.sparkSession, model), docs.columns.index(column)
    keep = [i for i in range(len(docs.columns)) if i != at]
    made = unused(docs, "text")

    def run(batches):
        codec = _codec(held)
        for batch in batches:
            texts = [None if x.as_py() is None else codec.decode(x.as_py()) for x in batch.column(at)]
            columns = [batch.column(i) for i in keep]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], names=[*(batch.schema.names[i] for i in keep), made])

    schema = "".join(f"`{docs.columns[i]}` {docs.schema[i].dataType.simpleString()}, " for i in keep)
    return docs.mapInArrow(run, f"{schema}`{made}` string")


def token_digests(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (ids comma-joined) and whether decoding gives the text back, for every row."""
    held = _Held(docs.sparkSession, model)

    def run(batches):
        codec = _codec(held)
        for batch in batches:
            rows = []
            for text in batch.column(1):
                text = text.as_py()
                ids = codec.encode(text)
                rows.append((len(ids), hashlib.sha256(",".join([codec.shown[i] for i in ids]).encode()).hexdigest(), codec.decode(ids) == (text or "")))
            n, digest, back = zip(*rows) if rows else ((), (), ())
            made = [pa.array(n, pa.int32()), pa.array(digest, pa.string()), pa.array(back, pa.bool_())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made], names=["doc_id", "n_tokens", "ids_sha256", "round_trip"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_tokens int, ids_sha256 string, round_trip boolean")
