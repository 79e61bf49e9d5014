"""Sentencepiece encoding and decoding by a table of distinct marked words.

The library marks every space with U+2581 and puts one mark before the text. A chunk is a run of
marks and the unmarked characters after it. Where no piece of the vocabulary has a mark after
another character, pieces cannot cross the start of a chunk, so chunks are segmented one by one:
each distinct chunk of a task is segmented once, and the ids are joined back by position.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import package_file, slices

MARK = "▁"
CHUNK = re.compile(" +[^ ]*")
#: Distinct chunks remembered in a task, and the longest chunk remembered: a bound of memory, not of results.
TABLE_ROWS, TABLE_CHARS = 100_000, 64


def check_model(model) -> None:
    """Refuse a model whose pieces may cross the start of a chunk, or that changes text first."""
    from sentencepiece import sentencepiece_model_pb2 as schema

    spec = schema.ModelProto.FromString(model.serialized_model_proto())
    plain = spec.normalizer_spec
    crossing = next((p.piece for p in spec.pieces if p.type in (1, 4) and MARK in p.piece.lstrip(MARK)), None)
    if crossing is not None or plain.precompiled_charsmap or plain.remove_extra_whitespaces or not plain.add_dummy_prefix:
        raise ValueError("chunks of this model are not independent")
    if any(p.type == 4 for p in spec.pieces) or model.piece_to_id(MARK) == model.unk_id():
        raise ValueError("user-defined pieces and models without a lone mark are not supported")


class ChunkTable:
    """Ids (int32 bytes) and decoded text of each distinct chunk met so far."""

    def __init__(self, model) -> None:
        self.model = model
        self.rows: dict[str, tuple[bytes, str]] = {}
        self.lone_mark = model.piece_to_id(MARK)

    def add(self, chunks: set[str]) -> None:
        if len(self.rows) > TABLE_ROWS:
            self.rows.clear()
        missing = [c for c in chunks if c not in self.rows]
        # the library puts one mark before what it encodes: it stands for the chunk's first one
        ids = self.model.encode([c[1:] for c in missing], num_threads=1)
        ids = [found or [self.lone_mark] for found in ids]
        texts = self.model.decode(ids, num_threads=1)
        for chunk, found, text in zip(missing, ids, texts):
            self.rows[chunk] = np.array(found, np.int32).tobytes(), " " + text

    def forget_long(self) -> None:
        for chunk in [c for c in self.rows if len(c) > TABLE_CHARS]:
            del self.rows[chunk]

    def encode(self, text: str) -> tuple[bytes, str]:
        if not text:
            return b"", ""
        found = list(map(self.rows.__getitem__, CHUNK.findall(" " + text)))
        return b"".join([f[0] for f in found]), "".join([f[1] for f in found])[1:]


def _load(proto: bytes):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_proto=proto)
    check_model(model)
    return model


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", end_id: bool = True) -> DataFrame:
    """(id, ids array<int>, decoded string) of every whole text, as the library's ``encode`` and
    ``decode`` give them; with ``end_id`` the end id follows.

    Null texts count as empty: no id but the end id, empty decoded text. Repeated rows stay
    repeated; other columns are left out, so their names cannot clash. Narrow: nothing is shuffled.
    """
    proto = package_file(model_path)
    _load(proto)
    key = docs.schema[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _load(proto)
        table = ChunkTable(model)
        end = np.array([model.eos_id()] if end_id else [], np.int32).tobytes()
        for batch in batches:
            for part in slices(batch, 1):
                texts = [(t or "").replace(MARK, " ") for t in part.column(1).to_pylist()]
                distinct: set[str] = set()
                for text in texts:
                    if text:
                        distinct.update(CHUNK.findall(" " + text))
                table.add(distinct)
                coded = [table.encode(t) for t in texts]
                table.forget_long()
                raw = [c[0] + end for c in coded]
                offsets = np.zeros(len(raw) + 1, np.int32)
                np.cumsum([len(r) // 4 for r in raw], out=offsets[1:])
                values = pa.Array.from_buffers(pa.int32(), int(offsets[-1]), [None, pa.py_buffer(b"".join(raw))])
                ids = pa.ListArray.from_arrays(pa.array(offsets), values)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), ids, pa.array([c[1] for c in coded], pa.string())], [id_col, "ids", "decoded"]
                )

    schema = f"`{id_col}` {key.dataType.simpleString()}, ids array<int>, decoded string"
    return docs.select(id_col, text_col).mapInArrow(run, schema)
