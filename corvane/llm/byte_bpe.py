"""Byte-level BPE: encoding and decoding with a public rank file.

The rank file (token bytes and rank per line) becomes a BPE model of the
tokenizers library: every split of a token into two known tokens is a merge of
that token's rank, and a piece that is itself a token is taken whole, which is
how rank files are meant. Text is cut into pieces by the published pattern; each
distinct piece is encoded once per Python worker. Rows pass through as Arrow
batches, without a shuffle.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from corvane.llm.tables import id_and_text, named, ship

REMEMBERED_PIECES = 1 << 18  # a memory bound; the memo is emptied when full, results do not change


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies.

    Printable Latin-1 characters stand for themselves; the others take the
    characters from U+0100 on, in order of their bytes.
    """
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(byte) if byte in plain else chr(next(rest)) for byte in range(256)]


class Codec:
    """Encoder and decoder of one rank file and pattern."""

    def __init__(self, rank_file: bytes, pattern: str):
        import regex
        from tokenizers.models import BPE

        ranks = {}
        for line in rank_file.splitlines():
            if line.strip():
                token, rank = line.split()
                ranks[base64.b64decode(token)] = int(rank)
        self._characters = byte_characters()
        ordered = sorted(ranks, key=ranks.get)
        merges = [
            (self._shown(token[:cut]), self._shown(token[cut:]))
            for token in ordered
            for cut in range(1, len(token))
            if token[:cut] in ranks and token[cut:] in ranks
        ]
        vocabulary = {self._shown(token): rank for token, rank in ranks.items()}
        self._model = BPE(vocab=vocabulary, merges=merges, ignore_merges=True)
        self._pieces = regex.compile(pattern).findall
        self._memo = _Memo(self._encode_piece)
        size = max(ranks.values()) + 1
        self._bytes = [None] * size
        for token, rank in ranks.items():
            self._bytes[rank] = token
        self._digits = [str(rank) for rank in range(size)]
        self._lengths = np.array([len(token or b"") for token in self._bytes])

    def _shown(self, data: bytes) -> str:
        return "".join(map(self._characters.__getitem__, data))

    def _encode_piece(self, piece: str) -> tuple[int, ...]:
        return tuple(token.id for token in self._model.tokenize(self._shown(piece.encode())))

    def encode(self, text: str) -> list[int]:
        self._memo.trim()
        return list(chain.from_iterable(map(self._memo.__getitem__, self._pieces(text))))

    def decode_bytes(self, ids) -> bytes:
        """The bytes of the ids; an id outside the vocabulary is an error."""
        return b"".join(map(self._bytes.__getitem__, ids))

    def id_text(self, ids) -> str:
        return ",".join(map(self._digits.__getitem__, ids))

    def offsets(self, text: str, ids) -> tuple[np.ndarray, np.ndarray]:
        """Start and end code point of each token; tokens that hold part of a
        character span the whole of it."""
        data = np.frombuffer(text.encode(), dtype=np.uint8)
        character = np.cumsum((data & 0xC0) != 0x80) - 1
        lengths = self._lengths[np.asarray(ids, dtype=np.int64)]
        ends = np.cumsum(lengths)
        return character[ends - lengths], character[ends - 1] + 1


class _Memo(dict):
    """Token ids by piece, computed at the first request."""

    def __init__(self, encode):
        super().__init__()
        self._encode = encode

    def __missing__(self, piece):
        ids = self[piece] = self._encode(piece)
        return ids

    def trim(self):
        if len(self) > REMEMBERED_PIECES:
            self.clear()


_codecs: dict[tuple[bytes, str], Codec] = {}


def codec(rank_file: bytes, pattern: str) -> Codec:
    """The codec of this worker process, built at the first request."""
    key = (hashlib.sha256(rank_file).digest(), pattern)
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(rank_file, pattern)
    return _codecs[key]


def _shared(docs: DataFrame, rank_file: bytes, pattern: str):
    """The rank file as a broadcast: its size is that of the vocabulary, whatever the input."""
    files = docs.sparkSession.sparkContext.broadcast(rank_file)
    return lambda: codec(files.value, pattern)


def _mapped(rows: DataFrame, make, build, schema: str) -> DataFrame:
    """``build`` turns (codec, record batch) into columns; the first column is passed on."""
    ship(rows.sparkSession)
    arrow_names = [field.split()[0] for field in schema.split(", ")]

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = make()
        for batch in source:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                yield pa.RecordBatch.from_arrays([part.column(0), *build(coder, part)], names=arrow_names)

    return rows.mapInArrow(batches, schema)


def encode(
    docs: DataFrame, rank_file: bytes, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, ids (array of int), starts and ends (code points of each token) per row.

    A null or empty text has no tokens; repeated rows are encoded each; an
    empty table gives an empty result; ids may be null.
    """
    rows = id_and_text(docs, id_col, text_col)
    integers = pa.list_(pa.int32())

    def build(coder, batch):
        ids, starts, ends = [], [], []
        for text in batch.column(1).to_pylist():
            found = coder.encode(text)
            first, last = coder.offsets(text, found)
            ids.append(found), starts.append(first.astype(np.int32)), ends.append(last.astype(np.int32))
        return [pa.array(column, integers) for column in (ids, starts, ends)]

    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, ids array<int>, starts array<int>, ends array<int>"
    return _mapped(rows, _shared(docs, rank_file, pattern), build, schema)


def decode(
    encoded: DataFrame, rank_file: bytes, pattern: str, id_col: str = "doc_id", ids_col: str = "ids"
) -> DataFrame:
    """doc_id, the bytes of the ids and their text, per row.

    Ids that end inside a character still give their exact bytes; in the text
    such a rest reads U+FFFD. Null ids count as none.
    """
    rows = encoded.select(named(id_col).alias("doc_id"), named(ids_col).alias("ids"))

    def build(coder, batch):
        data = [coder.decode_bytes(ids or ()) for ids in batch.column(1).to_pylist()]
        return [pa.array(data, pa.binary()), pa.array([each.decode("utf-8", "replace") for each in data])]

    kind = rows.schema["doc_id"].dataType.simpleString()
    return _mapped(
        rows, _shared(encoded, rank_file, pattern), build, f"doc_id {kind}, data binary, text string"
    )


def round_trip(
    docs: DataFrame, rank_file: bytes, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Encode each text and decode its ids in one pass, without passing ids through the JVM.

    Per row: doc_id, n_tokens, ids_sha256 (decimal ids joined by commas) and
    decoded_sha256 (the decoded bytes), digests in lowercase hex. Nulls, empty
    texts and repeated rows as in :func:`encode`.
    """
    rows = id_and_text(docs, id_col, text_col)

    def build(coder, batch):
        counts, of_ids, of_bytes = [], [], []
        for text in batch.column(1).to_pylist():
            ids = coder.encode(text)
            counts.append(len(ids))
            of_ids.append(hashlib.sha256(coder.id_text(ids).encode()).hexdigest())
            of_bytes.append(hashlib.sha256(coder.decode_bytes(ids)).hexdigest())
        return [pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())]

    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return _mapped(rows, _shared(docs, rank_file, pattern), build, schema)


def tokenised(
    docs: DataFrame, rank_file: bytes, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, ids, n_tokens and exact: whether decoding the ids gives the text's bytes again.

    Nulls, empty texts and repeated rows as in :func:`encode`.
    """
    rows = id_and_text(docs, id_col, text_col)

    def build(coder, batch):
        texts = batch.column(1).to_pylist()
        ids = [coder.encode(text) for text in texts]
        return [
            pa.array(ids, pa.list_(pa.int32())),
            pa.array([len(each) for each in ids], pa.int64()),
            pa.array([coder.decode_bytes(each) == text.encode() for each, text in zip(ids, texts, strict=True)]),
        ]

    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, ids array<int>, n_tokens bigint, exact boolean"
    return _mapped(rows, _shared(docs, rank_file, pattern), build, schema)
