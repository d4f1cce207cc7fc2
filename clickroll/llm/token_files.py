"""Token ids in binary shards with a minimal perfect hash index.

A shard holds the ids of a range of keys, in ascending order of the keys:

* ``shard-N.ids``: the ids of its texts, one after the other, little-endian, two bytes
  each if the vocabulary fits, else four; nothing else.
* ``shard-N.idx``: the header, the minimal perfect hash over the keys (levels of bits; a
  key's slot is the rank of its bit), per slot a fingerprint of the key, the first row
  and the number of rows; then per row its offset in ids, and the keys.

A lookup takes a fixed number of steps whatever the number of keys, and a key that is not
there is told by its fingerprint, then surely by the stored key.

Shards are written under a name of the attempt and then moved, so a task that runs
again leaves the same two files.  They go through the file system the folder's URI
names; the folder lies below ``spark.checkpoint.dir``, which all executors reach.

Defined cases: a null text is an empty one and holds the end id alone; rows of equal
key stand side by side, ordered by their text, and a lookup gives all of them; a null
key comes first and is looked up by None; no rows at all give no shard.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
import zlib
from collections.abc import Iterator
from itertools import chain, filterfalse

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickroll.llm.common import Memo, groups_of, per_worker, query, rows_of, table
from clickroll.session import stored, work_dir

END_ID = 0
MAGIC = b"CRTI"
_LEVELS = 48
_GAMMA = 2.0


# --- encoding -------------------------------------------------------------------------
class ByteEncoder:
    """Ids of the tokenizers library, packed as little-endian numbers of ``width`` bytes.

    A byte-level BPE with the usual split never joins across the blank before a word, nor
    across the end of a run of letters, so a text goes word by word through a bounded memo.
    Texts with strings or characters that would be split elsewhere go to the library whole,
    as do all texts of a tokenizer of another kind.
    """

    # A run of plain letters, if no letter of another kind follows; else all up to the next
    # white space.  A blank belongs to what follows it, of more white space only the last one.
    _UNITS = re.compile(r" ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]++(?![^\W\d_])| ?\S+|\s+(?!\S)|\s+")

    # What the usual split never cuts: plain letters, digits, or ASCII signs but the apostrophe, behind a blank or not.
    _PIECE = re.compile(r" ?(?:[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+|[0-9]+|[!-&(-/:-@\[-`{-~]+)")

    def __init__(self, blob: bytes, memo: int = 450_000, width: int | None = None) -> None:
        from tokenizers import Tokenizer

        spec = json.loads(blob)
        self.library = Tokenizer.from_buffer(blob)
        self.size = self.library.get_vocab_size(with_added_tokens=True)
        self.width = width or (2 if self.size <= 1 << 16 else 4)
        split = spec.get("pre_tokenizer") or {}
        self.by_unit = (
            split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
            and not spec.get("normalizer") and spec["model"].get("type") == "BPE" and not spec["model"].get("dropout"))
        # separators 1c-1f are white space here, but not to the library
        self.added = [t["content"] for t in spec.get("added_tokens", [])]
        self.odd = re.compile("[\x1c-\x1f]")
        self.model = self.library.model
        self.letters = byte_letters()
        blank = self.letters[32]
        self.begins = np.zeros(max(self.library.get_vocab().values(), default=0) + 1, bool)
        self.begins[[i for t, i in self.library.get_vocab().items() if t.startswith(blank)]] = True
        self.units = Memo(self._unit, memo)

    def pack(self, ids: list[int]) -> bytes:
        return np.array(ids, self.kind).tobytes()

    @property
    def kind(self) -> str:
        return "<u2" if self.width == 2 else "<u4"

    def _unit(self, unit: str) -> bytes:
        if unit[unit[0] == " ":].isalpha():
            # a single piece, which needs no split: straight to the library's model
            found = self.model.tokenize(unit.encode().decode("latin-1").translate(self.letters))
            return self.pack([t.id for t in found])
        return self.pack(self.library.encode(unit, add_special_tokens=False).ids)

    def _many(self, units: list[str]) -> list[bytes]:
        """The same of many: single pieces go straight to the library's model, letters of bytes made for all at once.

        Other words behind a blank are encoded as one text, which is cut where words begin.
        """
        found: dict[str, bytes] = {}
        w, single = self.width, [u for u in units if self._PIECE.fullmatch(u)]
        if single:
            pieces = "\n".join(single).encode().decode("latin-1").translate(self.letters).split(self.letters[10])
            ids = [[t.id for t in self.model.tokenize(p)] for p in pieces]
            packed, at = self.pack(list(chain.from_iterable(ids))), 0
            for u, x in zip(single, ids, strict=True):
                found[u] = packed[at:(at := at + len(x) * w)]
        words = [u for u in units if u not in found and u[0] == " " and u[1:].isalpha()]
        for at in range(0, len(words), 1024):
            some = words[at:at + 1024]
            ids = np.array(self.library.encode("".join(some), add_special_tokens=False).ids, np.int64)
            cuts = np.flatnonzero(self.begins[ids])
            if len(cuts) == len(some):
                packed = ids.astype(self.kind).tobytes()
                ends = [*cuts[1:].tolist(), len(ids)]
                found.update((u, packed[a * w:b * w]) for u, a, b in zip(some, cuts.tolist(), ends, strict=True))
        return [found.get(u) or self._unit(u) for u in units]

    def split(self, texts: list[str]) -> list[list[str] | None]:
        """Units of texts, none for those that go whole; units that are new are encoded together."""
        whole = lambda t: not self.by_unit or any(a in t for a in self.added) or self.odd.search(t)
        units = [None if whole(t) else self._UNITS.findall(t) for t in texts]
        # most are held already: only the others are gathered
        self.units.fill(set(filterfalse(self.units.__contains__, chain.from_iterable(u for u in units if u))), self._many)
        return units

    def encode(self, text: str, units: list[str] | None = None) -> bytes:
        """Packed ids of a text."""
        if units is None:
            (units,) = self.split([text])
        if units is None:
            return self.pack(self.library.encode(text, add_special_tokens=False).ids)
        return b"".join(map(self.units.__getitem__, units))


def byte_letters() -> dict[int, str]:
    """The visible character that stands for each byte in a byte-level vocabulary.

    Printable bytes stand for themselves, the others for the characters from 256 on.
    """
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def worker_encoder(blob: bytes) -> ByteEncoder:
    return per_worker(f"bytes-{hashlib.sha256(blob).hexdigest()}", lambda: ByteEncoder(blob))


# --- minimal perfect hash -------------------------------------------------------------
def key_hashes(keys: list[str | None]) -> np.ndarray:
    return np.array([0 if k is None else xxhash.xxh3_64_intdigest(k, 1) for k in keys], np.uint64)


def _mixed(hashes: np.ndarray, level: int) -> np.ndarray:
    x = hashes + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Slots 0 to n-1 for n distinct hashes; other hashes get any slot or none (-1)."""

    def __init__(self, levels: list[np.ndarray]) -> None:
        self.levels = levels
        words = np.concatenate(levels) if levels else np.zeros(0, np.uint64)
        self.ranks = np.concatenate([[0], np.cumsum(np.bitwise_count(words).astype(np.int64))])
        self.firsts = np.concatenate([[0], np.cumsum([len(x) for x in levels])]).astype(np.int64)

    @classmethod
    def build(cls, hashes: np.ndarray) -> PerfectHash:
        levels, left = [], hashes
        while len(left):
            if len(levels) == _LEVELS:
                raise ValueError("keys with equal hashes")
            words = max(1, int(len(left) * _GAMMA) // 64 + 1)
            at = _mixed(left, len(levels)) % np.uint64(words * 64)
            found, inverse, counts = np.unique(at, return_inverse=True, return_counts=True)
            alone = counts == 1
            bits = np.zeros(words, np.uint64)
            np.bitwise_or.at(bits, (found[alone] >> np.uint64(6)).astype(np.int64),
                             np.uint64(1) << (found[alone] & np.uint64(63)))
            levels.append(bits)
            left = left[~alone[inverse]]
        return cls(levels)

    def slots(self, hashes: np.ndarray) -> np.ndarray:
        out = np.full(len(hashes), -1, np.int64)
        for level, bits in enumerate(self.levels):
            open_ = np.flatnonzero(out < 0)
            if not len(open_):
                break
            at = _mixed(hashes[open_], level) % np.uint64(len(bits) * 64)
            word, bit = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            hit = (bits[word] >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(bits[word] & ((np.uint64(1) << bit) - np.uint64(1))).astype(np.int64)
            out[open_[hit]] = (self.ranks[self.firsts[level] + word] + below)[hit]
        return out


# --- shards ---------------------------------------------------------------------------
def _arrays(*arrays: np.ndarray) -> bytes:
    return b"".join(struct.pack("<Q", a.nbytes) + a.tobytes() for a in arrays)


def index_bytes(keys: list[str | None], offsets: np.ndarray, width: int) -> bytes:
    """The index of a shard: ``keys`` in row order, equal ones together; offsets with the end."""
    starts = [i for i, k in enumerate(keys) if i == 0 or k != keys[i - 1]]
    hashes = key_hashes([keys[i] for i in starts])
    table_ = PerfectHash.build(hashes)
    slots = table_.slots(hashes)
    prints, first = np.zeros(len(starts), "<u4"), np.zeros(len(starts), "<u4")
    counts = np.zeros(len(starts), "<u4")
    prints[slots] = (hashes >> np.uint64(32)).astype("<u4")
    first[slots] = starts
    counts[slots] = np.diff([*starts, len(keys)])
    raw = [b"" if k is None else k.encode() for k in keys]
    sizes = np.array([-1 if k is None else len(r) for k, r in zip(keys, raw, strict=True)], "<i4")
    head = MAGIC + struct.pack("<III", 1, width, len(table_.levels))
    return head + _arrays(*table_.levels, prints, first, counts, offsets.astype("<u8"), sizes,
                          np.frombuffer(b"".join(raw), np.uint8))


class Shard:
    """A shard opened for reading; only the index is held."""

    def __init__(self, folder: str, number: int) -> None:
        from pyarrow import fs

        self.files, path = fs.FileSystem.from_uri(folder)
        with self.files.open_input_stream(f"{path}/{name(number)}.idx") as f:
            blob = f.read()
        if blob[:4] != MAGIC:
            raise ValueError(f"no token index: {folder}/{name(number)}.idx")
        _, self.width, n_levels = struct.unpack_from("<III", blob, 4)
        at, parts = 16, []
        while at < len(blob):
            (size,) = struct.unpack_from("<Q", blob, at)
            parts.append(blob[at + 8:at + 8 + size])
            at += 8 + size
        self.hash = PerfectHash([np.frombuffer(p, "<u8") for p in parts[:n_levels]])
        self.prints, self.first, self.counts = (np.frombuffer(p, "<u4") for p in parts[n_levels:n_levels + 3])
        self.offsets = np.frombuffer(parts[n_levels + 3], "<u8")
        self.sizes = np.frombuffer(parts[n_levels + 4], "<i4")
        self.ends = np.concatenate([[0], np.cumsum(np.maximum(self.sizes, 0))]).astype(np.int64)
        self.keys = parts[n_levels + 5] if len(parts) > n_levels + 5 else b""
        self.payload = self.files.open_input_file(f"{path}/{name(number)}.ids")

    def __len__(self) -> int:
        return len(self.sizes)

    def key(self, row: int) -> str | None:
        return None if self.sizes[row] < 0 else self.keys[self.ends[row]:self.ends[row + 1]].decode()

    def rows_of(self, key: str | None) -> range:
        """Rows of a key, none if the shard does not hold it."""
        return self.rows_of_each([key])[0]

    def rows_of_each(self, keys: list[str | None]) -> list[range]:
        """The same for many keys, which are hashed together."""
        hashed = key_hashes(keys)
        slots, out = self.hash.slots(hashed), []
        known = slots >= 0
        known[known] = self.prints[slots[known]] == (hashed[known] >> np.uint64(32)).astype(np.uint32)
        for key, slot, like in zip(keys, slots.tolist(), known.tolist(), strict=True):
            row = int(self.first[slot]) if like else -1
            out.append(range(row, row + int(self.counts[slot])) if like and self.key(row) == key else range(0))
        return out

    def ids(self, row: int) -> np.ndarray:
        """The ids of a row, read from its place in the payload."""
        a, b = int(self.offsets[row]), int(self.offsets[row + 1])
        raw = self.payload.read_at((b - a) * self.width, a * self.width)
        return np.frombuffer(raw, "<u2" if self.width == 2 else "<u4").astype("<u4")


def name(number: int) -> str:
    return f"shard-{number:06d}"


def write_shards(documents: DataFrame, folder: str, tokenizer: bytes, *, key: str = "doc_id", text: str = "text",
                 end_id: int | None = END_ID) -> DataFrame:
    """Write the shards of ``documents`` below ``folder`` and return their manifest.

    Manifest: ``shard, n_rows, n_ids, first_key, last_key, start``; ``start`` counts the
    ids in all shards before.  Shards follow ``spark.sql.shuffle.partitions``.
    """
    rows = documents.select(F.col(key).alias("_k"), F.coalesce(text, F.lit("")).alias("_t")).withColumn(
        "_h", F.xxhash64("_t"))
    ordered = rows.repartitionByRange("_k", "_h").sortWithinPartitions("_k", "_h", "_t").select(
        F.col("_k").cast("string").alias("_k"), "_t")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        encoder = worker_encoder(tokenizer)
        end = b"" if end_id is None else encoder.pack([end_id])
        files, path = fs.FileSystem.from_uri(folder)
        task = TaskContext.get()
        shard, attempt = name(task.partitionId()), task.taskAttemptId()
        keys: list[str | None] = []
        ends = [0]
        out = None

        def texts() -> Iterator[str]:
            for k, t in rows_of(batches, "_k", "_t"):
                keys.append(k)
                yield t

        for group in groups_of(texts()):
            if out is None:
                files.create_dir(path, recursive=True)
                out = files.open_output_stream(f"{path}/_{shard}-{attempt}.ids", buffer_size=1 << 20)
            for t, units in zip(group, encoder.split(group), strict=True):
                ids = encoder.encode(t, units) + end
                out.write(ids)
                ends.append(ends[-1] + len(ids) // encoder.width)
        if out is None:
            return
        out.close()
        with files.open_output_stream(f"{path}/_{shard}-{attempt}.idx") as index:
            index.write(index_bytes(keys, np.array(ends), encoder.width))
        for kind in ("ids", "idx"):
            files.move(f"{path}/_{shard}-{attempt}.{kind}", f"{path}/{shard}.{kind}")
        yield pa.RecordBatch.from_pydict({
            "shard": pa.array([task.partitionId()], pa.int32()), "n_rows": pa.array([len(keys)], pa.int64()),
            "n_ids": pa.array([ends[-1]], pa.int64()), "first_key": pa.array([keys[0]], pa.string()),
            "last_key": pa.array([keys[-1]], pa.string())})

    shards = stored(ordered.mapInArrow(
        write, "shard int, n_rows long, n_ids long, first_key string, last_key string"), "manifest")
    # one row per shard
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return shards.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_shards(manifest: DataFrame, folder: str) -> DataFrame:
    """One row per text, from the files: ``key, start, n_tokens, ids_crc32``.

    Each key is looked up through the hash of its shard.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, start in rows_of(batches, "shard", "start"):
            shard = Shard(folder, number)
            for at in range(0, len(shard), 4_096):
                rows, out = range(at, min(at + 4_096, len(shard))), []
                keys = [shard.key(row) for row in rows]
                for row, key, found in zip(rows, keys, shard.rows_of_each(keys), strict=True):
                    if row not in found:
                        raise ValueError(f"the index of shard {number} does not lead to row {row}")
                    ids = shard.ids(row)
                    out.append((key, start + int(shard.offsets[row]), len(ids), zlib.crc32(ids.tobytes())))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, kind) for column, kind in zip(
                        zip(*out, strict=True), (pa.string(), pa.int64(), pa.int64(), pa.int64()), strict=True)],
                    names=["key", "start", "n_tokens", "ids_crc32"])

    # a task for each shard, however small its row here
    return manifest.select("shard", "start").repartition(max(1, manifest.count()), "shard").mapInArrow(
        read, "key string, start long, n_tokens long, ids_crc32 long")


class TokenStore:
    """Keyed access to the ids below a folder; opens the shards a lookup needs."""

    def __init__(self, manifest: DataFrame, folder: str) -> None:
        self.folder = folder
        self.rows = manifest.orderBy("shard").collect()      # one row per shard

    def ids(self, key: str | None) -> list[np.ndarray]:
        """The ids of each text of a key.  Keys compare as numbers where all are."""
        def rank(k: str | None) -> tuple:
            return (0,) if k is None else (1, int(k)) if re.fullmatch(r"-?\d+", k) else (2, k)

        out = []
        for row in self.rows:
            if rank(row.first_key) <= rank(key) <= rank(row.last_key):
                shard = Shard(self.folder, row.shard)
                out += [shard.ids(r) for r in shard.rows_of(key)]
        return out


@query("op9_token_files")
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), "rb") as file:
        tokenizer = file.read()
    folder = work_dir(spark, "tokens")
    manifest = write_shards(table(spark, sf_dir, "documents", "doc_id", "text"), folder, tokenizer)
    return read_shards(manifest, folder).select(F.col("key").cast("long").alias("doc_id"), "start", "n_tokens", "ids_crc32")
