"""Byte-level BPE encoding and decoding over Arrow batches with the tokenizers library.

Null and empty texts have no ids and decode to no bytes. Repeated rows give
repeated rows; an empty table gives an empty one. Other columns pass through,
whatever their names; the result's names are parameters.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalograph.llm.pieces import batches, byte_characters, gather, piece_encoder, tokenizer_of
from catalograph.llm.support import text_column, unused

BATCH_BYTES = 1 << 20


@functools.cache
def byte_table(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes of all tokens, start, length) by id: the character table read backwards."""
    value = {c: b for b, c in enumerate(byte_characters())}
    names = tokenizer_of(path).get_vocab(with_added_tokens=True)
    tokens = [b""] * (max(names.values()) + 1)
    for name, i in names.items():
        tokens[i] = bytes(value[c] for c in name) if all(c in value for c in name) else name.encode()
    lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
    return np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(lengths) - lengths, lengths


def int_lists(ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids, pa.int32()))


def joined(parts: list[pa.Array], kind: pa.DataType) -> pa.Array:
    return pa.concat_arrays(parts) if parts else pa.array([], kind)


def ids_of(texts: pa.Array, path: str) -> pa.Array:
    """Ids of each whole text of a batch."""
    encoder = piece_encoder(path)
    return joined([int_lists(*encoder.encode(part)) for part in batches(texts, BATCH_BYTES)], pa.list_(pa.int32()))


def bytes_of(lists: pa.Array, path: str) -> pa.Array:
    """Bytes behind each list of ids, about ``BATCH_BYTES`` at a time."""
    lists = pa.array(lists.to_pylist(), pa.list_(pa.int32())).fill_null([]) if lists.null_count else lists
    bounds = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.values.slice(bounds[0], bounds[-1] - bounds[0]).to_numpy(zero_copy_only=False)
    bounds, (data, starts, lengths), parts = bounds - bounds[0], byte_table(path), []
    begin = 0
    while begin < len(lists):
        end = int(np.searchsorted(bounds, bounds[begin] + BATCH_BYTES // 4, "right")) - 1
        end = min(max(end, begin + 1), len(lists))
        own = flat[bounds[begin]:bounds[end]]
        sizes = lengths[own]
        found = gather(data, starts[own], sizes)
        cuts = np.concatenate([[0], np.cumsum(sizes)])[bounds[begin:end + 1] - bounds[begin]]
        parts.append(pa.Array.from_buffers(pa.binary(), end - begin, [
            None, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(found)]))
        begin = end
    return joined(parts, pa.binary())


def encode(text: Column, path: str) -> Column:
    """``array<int>``: the ids of each whole text."""
    return F.arrow_udf(lambda texts: ids_of(texts, path), "array<int>")(text)


def decode(ids: Column, path: str) -> Column:
    """``binary``: the bytes behind each row's ids. Null has none; an unknown id is an error."""
    return F.arrow_udf(lambda lists: bytes_of(lists, path), "binary")(ids)


def token_offsets(text: bytes, ids: np.ndarray, path: str) -> tuple[np.ndarray, np.ndarray]:
    """First character and end character of each token of one text.

    A token that starts or ends inside a character covers the whole character,
    so neighbours that share a split character overlap on it.
    """
    _, _, lengths = byte_table(path)
    ends = np.cumsum(lengths[ids])
    begins_char = (np.frombuffer(text, np.uint8) & 0xC0) != 0x80
    upto = np.concatenate([[0], np.cumsum(begins_char)])
    starts = ends - lengths[ids]
    inside = np.zeros(len(ids), np.int64)
    if len(text):
        inside = (~begins_char[np.minimum(starts, len(text) - 1)]).astype(np.int64)
    return upto[starts] - inside, upto[ends]


def decode_text(ids, path: str) -> str:
    """Text of a run of ids; a character cut at an end of the run shows as U+FFFD."""
    data, starts, lengths = byte_table(path)
    ids = np.asarray(ids, np.int64)
    return gather(data, starts[ids], lengths[ids]).tobytes().decode("utf-8", "replace")


def encode_offsets(text: Column, path: str) -> Column:
    """``struct<ids, starts, ends>``: ids of each text with the characters each one covers."""

    @F.arrow_udf("struct<ids:array<int>,starts:array<int>,ends:array<int>>")
    def spans_of(texts: pa.Array) -> pa.Array:
        encoder, columns = piece_encoder(path), ([], [], [])
        for part in batches(texts, BATCH_BYTES):
            ids, bounds = encoder.encode(part)
            spans = [token_offsets((t or "").encode(), ids[a:b], path)
                     for t, a, b in zip(part.to_pylist(), bounds[:-1], bounds[1:])]
            for column, values in zip(columns, (ids, *(np.concatenate(s) for s in zip(*spans)))):
                column.append(int_lists(values, bounds))
        return pa.StructArray.from_arrays([joined(c, pa.list_(pa.int32())) for c in columns],
                                          ["ids", "starts", "ends"])

    return spans_of(text)


def round_trip(documents: DataFrame, path: str, text: str = "text", ids: str = "ids",
               decoded: str = "decoded") -> DataFrame:
    """``documents`` with the ids of each text and the bytes that these ids decode to."""

    def both(texts: pa.Array) -> pa.Array:
        coded = ids_of(texts, path)
        return pa.StructArray.from_arrays([coded, bytes_of(coded, path)], ["ids", "decoded"])

    coded = F.arrow_udf(both, "struct<ids:array<int>,decoded:binary>")(text_column(documents, text))
    name = unused(documents, "__coded")
    return (documents.withColumn(name, coded)
            .withColumns({ids: F.col(name)["ids"], decoded: F.col(name)["decoded"]}).drop(name))


def with_ids(documents: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``documents`` with ``token_ids``, ``n_tokens`` and whether the ids give the text back."""
    ids, decoded = unused(documents, "token_ids"), unused(documents, "__decoded")
    coded = round_trip(documents, path, text, ids, decoded)
    same = F.col(decoded) == text_column(documents, text).cast("binary")
    return coded.withColumns({unused(documents, "n_tokens"): F.size(ids).cast("long"),
                              unused(documents, "round_trip"): same}).drop(decoded)


def digests(coded: DataFrame) -> DataFrame:
    """doc_id, number of ids, and SHA-256 of the decimal ids and of the decoded bytes."""
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
