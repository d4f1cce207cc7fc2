"""SentencePiece encoding with byte offsets, and decoding.

A text is normalised by longest prefix through the character map compiled into the
model, and each normalised byte remembers the byte it came from; so every piece is
projected to a span of bytes of the original text.  Ids are those of the library.

Merges of a BPE model never cross a place where white space follows something else,
nor a line feed, unless some piece of the model does.  Where none does (this is looked
up in the model), a text is encoded unit by unit, and units seen before come from a
bounded memo; otherwise the text is encoded as a whole.

Defined cases: a null text is an empty one, which has no tokens and decodes to the
empty text; every text is encoded whole, however long.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickroll.llm.common import carried, encoded, groups_of, Memo, per_worker, query, table

MARK = "▁"
_MARK = MARK.encode()


class CharacterMap:
    """A compiled map: a double-array trie over prefixes, then their replacements."""

    def __init__(self, blob: bytes) -> None:
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = struct.unpack_from(f"<{size // 4}I", blob, 4) if size else ()
        self.strings = blob[4 + size:]
        self.starts = bytes(c for c in range(256) if self._step(self._root(), c) is not None) if size else b""

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)

    def _root(self) -> int:
        return self._offset(self.units[0])

    def _step(self, at: int, byte: int) -> tuple[int, int] | None:
        """Children's base and unit after one more byte, if the trie has it."""
        at ^= byte
        if at >= len(self.units) or self.units[at] & 0x800000FF != byte:
            return None
        return at ^ self._offset(self.units[at]), self.units[at]

    def longest(self, raw: bytes, start: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest prefix at ``start`` that the map holds."""
        at, found = self._root(), None
        for i in range(start, len(raw)):
            step = self._step(at, raw[i])
            if step is None:
                break
            at, unit = step
            if unit >> 8 & 1:
                value = self.units[at] & 0x7FFFFFFF
                found = i + 1 - start, self.strings[value:self.strings.index(b"\0", value)]
        return found


class Normaliser:
    """The normalisation a model asks for, with the source of every byte."""

    def __init__(self, blob: bytes, dummy_prefix: bool, squeeze: bool, escape: bool, suffix: bool = False) -> None:
        self.map = CharacterMap(blob)
        self.dummy, self.squeeze, self.escape, self.suffix = dummy_prefix, squeeze, escape, suffix
        # bytes that may begin a mapped prefix; what lies between is copied
        starts = self.map.starts
        self.plain = re.compile(rb"[^" + re.escape(starts) + rb"]+" if starts else rb"(?s:.)+")

    def __call__(self, raw: bytes) -> tuple[bytes, np.ndarray]:
        """Normalised bytes, and for each the offset of its source (one more for the end)."""
        parts: list[bytes] = []
        sources: list[np.ndarray] = []
        at = 0
        while at < len(raw):
            run = self.plain.match(raw, at)
            if run:
                parts.append(run[0])
                sources.append(np.arange(at, run.end()))
                at = run.end()
                continue
            found = self.map.longest(raw, at) if self.map.starts else None
            size, value = found or (_char_size(raw[at]), raw[at:at + _char_size(raw[at])])
            parts.append(value)
            sources.append(np.full(len(value), at))
            at += size
        out = b"".join(parts)
        source = np.concatenate([*sources, [len(raw)]]).astype(np.int64) if sources else np.zeros(1, np.int64)
        if self.squeeze:
            out, source = _squeezed(out, source)
        if not out:
            return b"", source[-1:]
        if self.dummy:
            first = source[:1]
            out, source = (out + b" ", np.append(source, source[-1])) if self.suffix else (
                b" " + out, np.concatenate([first, source]))
        return (_escaped(out, source)) if self.escape else (out, source)


def _char_size(byte: int) -> int:
    return 1 if byte < 0xC0 else 2 if byte < 0xE0 else 3 if byte < 0xF0 else 4


def _squeezed(out: bytes, source: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Blanks at the ends go, and of a run of blanks the first stays."""
    b = np.frombuffer(out, np.uint8)
    blank = b == 32
    keep = ~(blank & np.concatenate([[True], blank[:-1]])) if len(b) else blank
    kept = np.flatnonzero(keep)
    if len(kept) and blank[kept[-1]]:
        kept = kept[:-1]
    end = source[kept[-1] + 1:kept[-1] + 2] if len(kept) else source[-1:]
    return b[kept].tobytes(), np.concatenate([source[kept], end])


def _escaped(out: bytes, source: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Blanks become the three bytes of the mark, all with the source of the blank."""
    times = np.where(np.frombuffer(out, np.uint8) == 32, len(_MARK), 1)
    return out.replace(b" ", _MARK), np.append(np.repeat(source[:-1], times), source[-1])


class Codec:
    """Encoding with spans, and decoding, by one model."""

    _UNITS = re.compile(r"\n[^ \n]*| +[^ \n]*|[^ \n]+")

    def __init__(self, model: bytes, memo: int = 150_000) -> None:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto.FromString(model)
        spec, trainer = proto.normalizer_spec, proto.trainer_spec
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.normalise = Normaliser(spec.precompiled_charsmap, spec.add_dummy_prefix, spec.remove_extra_whitespaces,
                                    spec.escape_whitespaces, trainer.treat_whitespace_as_suffix)
        bytes_of = sentencepiece_model_pb2.ModelProto.SentencePiece.BYTE
        self.sizes = [1 if p.type == bytes_of else len(p.piece.encode()) for p in proto.pieces]
        self.lengths = np.array(self.sizes, "<i4")
        self.named = [b"%d," % i for i in range(len(self.sizes))]
        self.begins = np.array([p.piece.startswith(MARK) for p in proto.pieces])
        self.unknown = self.library.unk_id()
        self.mark = self.library.piece_to_id(MARK)
        normal = [p.piece for p in proto.pieces if p.type == 1]
        # user-defined pieces (type 4) are cut out before merging, so they rule units out
        self.by_unit = (
            trainer.model_type == 2 and trainer.byte_fallback and not spec.precompiled_charsmap
            and spec.add_dummy_prefix and spec.escape_whitespaces and not spec.remove_extra_whitespaces
            and not trainer.treat_whitespace_as_suffix and self.mark != self.unknown
            and not any(p.type == 4 for p in proto.pieces)
            and not any("\n" in p or " " in p or (MARK in p[1:] and p.strip(MARK)) for p in normal))
        self.units = Memo(self._unit, memo)

    def _unit(self, unit: str) -> tuple:
        """Ids of a unit, the same as text, and its decoded text if that is not the unit."""
        if unit == " ":
            ids = [self.mark]
        elif unit[0] == " ":
            ids = self.library.encode(unit[1:])      # the library adds the first blank
        else:
            ids = self.library.encode(unit)[1:]
        # behind a mark that goes, as the library drops one blank at the begin
        text = self.library.decode([self.mark, *ids])
        packed = np.array(ids, "<i4").tobytes(), b"".join(map(self.named.__getitem__, ids))
        return packed if text == unit else (*packed, text)

    def _units(self, units: list[str]) -> list[tuple]:
        """The same of many: words behind a blank are encoded as one text, which is cut where words begin."""
        words = [u for u in units if len(u) > 1 and u[0] == " " and u[1] != " " and "\n" not in u]
        found: dict[str, tuple] = {}
        for at in range(0, len(words), 64):
            some = words[at:at + 64]
            text = "".join(some)[1:]
            listed = self.library.encode(text)
            ids = np.array(listed, "<i4")
            cuts = np.flatnonzero(self.begins[ids]).tolist()
            # a word of odd bytes spoils the check, and its neighbours go one by one as well
            if len(cuts) == len(some) and self.library.decode(listed) == text:
                packed, names = ids.tobytes(), list(map(self.named.__getitem__, listed))
                found.update((u, (packed[4 * a:4 * b], b"".join(names[a:b])))
                             for u, a, b in zip(some, cuts, [*cuts[1:], len(listed)], strict=True))
        return [found.get(u) or self._unit(u) for u in units]

    def split(self, texts: list[str]) -> list[list[str] | None]:
        """Units of texts; those that are new are encoded together."""
        if not self.by_unit:
            return [None] * len(texts)
        units = [self._UNITS.findall(" " + t.replace(MARK, " ")) if t else [] for t in texts]
        self.units.fill(set(chain.from_iterable(units)), self._units)
        return units

    def coded(self, text: str, units: list[str] | None = None) -> tuple[np.ndarray, bytes, np.ndarray, str]:
        """Ids, the same as text with commas behind, bytes of each piece as normalised, and the decoded text."""
        if not text:
            return np.zeros(0, "<i4"), b"", np.zeros(0, "<i4"), ""
        if not self.by_unit:
            ids = self.library.encode(text)
            return (np.array(ids, "<i4"), b"".join(map(self.named.__getitem__, ids)),
                    np.array(self._piece_sizes(text, ids), "<i4"), self.library.decode(ids))
        if units is None:
            (units,) = self.split([text])
        found = list(map(self.units.__getitem__, units))
        ids = np.frombuffer(b"".join([f[0] for f in found]), "<i4")
        plain = text.replace(MARK, " ")
        if max(map(len, found)) > 2:
            plain = "".join([f[2] if len(f) > 2 else u for f, u in zip(found, units, strict=True)])[1:]
        return ids, b"".join([f[1] for f in found]), self.lengths[ids], plain

    def ids(self, text: str) -> tuple[np.ndarray, bytes, np.ndarray]:
        """Ids, the same as text with commas behind, and bytes of each piece as normalised."""
        return self.coded(text)[:3]

    def _piece_sizes(self, text: str, ids: list[int]) -> list[int]:
        pieces = self.library.encode(text, out_type=str) if self.unknown in ids else None
        return [len(pieces[k].encode()) if pieces and i == self.unknown else self.sizes[i] for k, i in enumerate(ids)]

    def spans(self, text: str, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last-but-one byte of the original text for pieces of these sizes."""
        raw = encoded(text)
        out, source = self.normalise(raw)
        ends = np.cumsum(sizes, dtype=np.int64)
        if len(ends) and ends[-1] != len(out):
            raise ValueError("pieces do not add up to the normalised text")
        edges = source[np.concatenate([[0], ends])] if len(ends) else np.zeros(1, np.int64)
        return edges[:-1], edges[1:]

    def decode(self, ids: np.ndarray) -> str:
        return self.library.decode(ids.tolist())


def worker_codec(model: bytes) -> Codec:
    """The codec of a model, kept for the later tasks of a worker."""
    return per_worker(f"pieces-{hashlib.sha256(model).hexdigest()}", lambda: Codec(model))


_FIELDS = {"n_tokens": "long", "ids": "array<int>", "begins": "array<int>", "ends": "array<int>",
           "ids_sha256": "string", "spans_crc32": "long", "decoded": "string", "decoded_sha256": "string"}


def encode(text: Column, model: bytes, *fields: str) -> Column:
    """A struct of the named ``fields`` for each text.

    ``ids``; ``begins`` and ``ends`` (byte spans of the original text); ``decoded``
    (the ids decoded again); or their numbers and digests.
    """
    fields = fields or ("n_tokens", "ids", "begins", "ends")
    need_spans = bool({"begins", "ends", "spans_crc32"} & set(fields))
    need_text = bool({"decoded", "decoded_sha256"} & set(fields))

    @F.pandas_udf(", ".join(f"{f} {_FIELDS[f]}" for f in fields))
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        codec = worker_codec(model)
        for texts in batches:
            rows = []
            for group in groups_of(texts.array):
                for t, units in zip(group, codec.split(group), strict=True):
                    ids, names, sizes, plain = codec.coded(t, units)
                    row = {"n_tokens": len(ids), "ids": ids}
                    if "ids_sha256" in fields:
                        row["ids_sha256"] = hashlib.sha256(names[:-1]).hexdigest()
                    if need_spans:
                        row["begins"], row["ends"] = codec.spans(t, sizes)
                        both = np.stack([row["begins"], row["ends"]], axis=1).astype("<u4")
                        row["spans_crc32"] = zlib.crc32(both.tobytes())
                    if need_text:
                        row["decoded"] = plain
                        row["decoded_sha256"] = hashlib.sha256(encoded(plain)).hexdigest()
                    rows.append([row[f] for f in fields])
            yield pd.DataFrame(rows, columns=list(fields))

    return run(F.coalesce(text, F.lit("")))


def decode(ids: Column, model: bytes) -> Column:
    """Text of an array of ids; null is no ids."""
    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = worker_codec(model)
        for arrays in batches:
            yield pd.Series([codec.decode(np.asarray(a, np.int32)) for a in arrays.array], dtype="object")

    return run(F.coalesce(ids, F.array().cast("array<int>")))


def read_model(path: str) -> bytes:
    """A model file, read on the driver and sent along with the tasks."""
    with open(path, "rb") as file:
        return file.read()


def with_pieces(documents: DataFrame, model: bytes, *fields: str, text: str = "text") -> DataFrame:
    """The rows of ``documents`` with the named fields as columns; clashing ones are replaced."""
    kept = [F.col(f"_row.`{c}`").alias(c) for c in documents.columns if c not in fields]
    rows = carried(documents, _pieces=encode(F.col(text), model, *fields))
    return rows.select(*kept, *[F.col(f"_pieces.{f}").alias(f) for f in fields])


@query("op5_sentencepiece")
def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    model = read_model(public_tokenizers.path("piece_bpe_32k.model"))
    fields = ("n_tokens", "ids_sha256", "decoded_sha256", "spans_crc32")
    return with_pieces(table(spark, sf_dir, "documents", "doc_id", "text"), model, *fields).select("doc_id", *fields)
