"""Token ids as length-delimited binary records with masked checksums and a separate offset index.

Data file (little-endian): for each document, in ascending order of ids,

    uint64 length of the payload | uint32 masked crc32 of those 8 bytes | payload | uint32 masked crc32 of the payload

    payload: uint8 flags (1: has an id, 2: ids take 4 bytes, else 2) | int64 id | the token ids

The mask rotates a checksum right by 15 bits and adds 0xA282EAD8, so that
checksums of data that hold checksums stay useful.  Index file: the uint64
offset of each record, for reads in any order.  A file holds one range of ids
and is named after its place and the task attempt that wrote it; only files
named in the committed listing are read.

Null and empty texts have the end id only; rows without an id come first;
repeated rows are records of their own, in order of a hash of their texts.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moldwise.llm.eliasfano import filesystem
from moldwise.llm.textbytes import SPACED, U64, Words, expand, run_hashes, slices, text_bytes
from moldwise.session import checkpoint_dir

END = 2
MASK = 0xA282EAD8
HELD = 1 << 20  # distinct units whose ids a worker keeps (more while one text alone has more)


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK) & 0xFFFFFFFF


def record(doc_id: int | None, ids: np.ndarray) -> bytes:
    wide = bool(len(ids)) and int(ids.max()) > 0xFFFF
    payload = struct.pack("<Bq", (doc_id is not None) + 2 * wide, doc_id or 0) + ids.astype("<u4" if wide else "<u2").tobytes()
    size = struct.pack("<Q", len(payload))
    return size + struct.pack("<I", masked(size)) + payload + struct.pack("<I", masked(payload))


def parse(data: memoryview, at: int) -> tuple[int | None, np.ndarray, int]:
    """The document and ids of the record at an offset, and where the next one begins."""
    size = bytes(data[at : at + 8])
    if len(size) < 8 or struct.unpack("<I", data[at + 8 : at + 12])[0] != masked(size):
        raise ValueError(f"damaged length at byte {at}")
    to = at + 12 + struct.unpack("<Q", size)[0]
    payload = bytes(data[at + 12 : to])
    if len(data) < to + 4 or struct.unpack("<I", data[to : to + 4])[0] != masked(payload):
        raise ValueError(f"damaged record at byte {at}")
    flags, doc_id = struct.unpack_from("<Bq", payload)
    return (doc_id if flags & 1 else None), np.frombuffer(payload, "<u4" if flags & 2 else "<u2", offset=9), to + 4


_BYTES = np.arange(256)
LETTER = ((_BYTES | 0x20) >= 0x61) & ((_BYTES | 0x20) <= 0x7A) & (_BYTES < 0x80)
OTHER = (_BYTES > 0x20) & (_BYTES < 0x7F) & ~LETTER & (_BYTES != 0x27)


def units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of bytes that are encoded by themselves: start, end, whether letter case matters, and each text's bounds.

    Words between white space, cut where ASCII letters meet other ASCII marks.
    An apostrophe joins (contractions are tokens), and a word with `<|` stays
    whole, as it may hold a special token.
    """
    words = Words(data, offsets, SPACED)
    letter, other = LETTER[data], OTHER[data]
    cut = np.zeros(len(data), bool)
    cut[1:] = (letter[1:] & other[:-1]) | (other[1:] & letter[:-1])
    cut[words.start] = False
    special = np.zeros(len(words), bool)
    special[np.searchsorted(words.start, np.flatnonzero((data[:-1] == 0x3C) & (data[1:] == 0x7C)), "right") - 1] = True
    inside = np.flatnonzero(cut & SPACED[data])
    inside = inside[~special[np.searchsorted(words.start, inside, "right") - 1]]
    start = np.sort(np.concatenate([words.start, inside]))
    word = np.searchsorted(words.start, start, "right") - 1
    end = np.minimum(np.append(start[1:], len(data)), words.end[word])
    foreign = np.append(0, np.cumsum(data >= 0x80))
    return start, end, special[word] | (foreign[end] > foreign[start]), np.searchsorted(start, offsets)


class UnitIds:
    """Ids of a text as those of its units, each distinct unit encoded once.

    Right for tokenizers that drop white space, ignore the case of ASCII
    letters and keep letters and other marks in separate tokens.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.clear()

    def clear(self, held: int = HELD) -> None:
        self.have = self.used = 0
        self.held = held
        slots = 1 << (2 * held - 1).bit_length()
        self.flat = np.empty(1 << 16, np.uint32)
        self.start, self.count = np.empty(1 << 14, np.int64), np.empty(1 << 14, np.int64)
        self.slots = np.full(slots, -1, np.int32)  # open addressing: the unit that has a slot, its hash beside it
        self.keys = np.zeros(slots, U64)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Numbers of units by their hashes; -1 for those not known."""
        out = np.full(len(h), -1, np.int64)
        todo, at = np.arange(len(h)), (h & U64(len(self.keys) - 1)).view(np.int64)
        while len(todo):
            unit = self.slots[at]
            same = (unit >= 0) & (self.keys[at] == h[todo])
            out[todo[same]] = unit[same]
            on = (unit >= 0) & ~same
            todo, at = todo[on], (at[on] + 1) & (len(self.keys) - 1)
        return out

    def enter(self, h: np.ndarray) -> None:
        """Give the next numbers to units that aren't known."""
        todo, at = np.arange(len(h)), (h & U64(len(self.keys) - 1)).view(np.int64)
        while len(todo):
            free = np.flatnonzero(self.slots[at] < 0)
            slot, first = np.unique(at[free], return_index=True)
            placed = free[first]
            self.keys[slot], self.slots[slot] = h[todo[placed]], self.have + todo[placed]
            left = np.ones(len(todo), bool)
            left[placed] = False
            todo, at = todo[left], (at[left] + 1) & (len(self.keys) - 1)
        self.have += len(h)

    def _encoded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and how many each text has.  Runs of letters are one word each: joined by blanks they are encoded at one go."""
        if texts[0].isalpha():
            found = self.tokenizer.encode(" ".join(texts), add_special_tokens=False)
            count = np.bincount(np.array(found.word_ids, np.int64))
            if len(count) == len(texts) and count.all():
                return np.array(found.ids, np.uint32), count
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.array([i for x in ids for i in x], np.uint32), np.array([len(x) for x in ids], np.int64)

    def _learn(self, hashes: np.ndarray, texts: list[str]) -> None:
        alpha = np.array([text.isalpha() for text in texts])
        for run in (np.flatnonzero(~alpha), np.flatnonzero(alpha)):
            for at in range(0, len(run), 2000):
                mine = run[at : at + 2000]
                flat, count = self._encoded([texts[i] for i in mine.tolist()])
                while self.used + len(flat) > len(self.flat):
                    self.flat = np.concatenate([self.flat, np.empty_like(self.flat)])
                while self.have + len(mine) > len(self.start):
                    self.start, self.count = (np.concatenate([x, np.empty_like(x)]) for x in (self.start, self.count))
                self.flat[self.used : self.used + len(flat)] = flat
                self.count[self.have : self.have + len(mine)] = count
                self.start[self.have : self.have + len(mine)] = self.used + np.cumsum(count) - count
                self.used += len(flat)
                self.enter(hashes[mine])

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of some texts, and how many are of each."""
        start, end, exact, at = units(data, offsets)
        if not len(start):
            return np.empty(0, np.uint32), np.zeros(len(offsets) - 1, np.int64)
        h = run_hashes(data, start, end, 0)
        if exact.any():
            size = (end - start)[exact]
            to = np.cumsum(size)
            h[exact] = run_hashes(data[expand(start[exact], size)], to - size, to, 2)
        place = self.find(h)
        missed = np.flatnonzero(place < 0)
        if len(missed):
            new, first, which = np.unique(h[missed], return_index=True, return_inverse=True)
            if self.have + len(new) > self.held:  # begin anew, with room for all units of these texts
                self.clear(max(HELD, len(start)))
                return self.encode(data, offsets)
            raw, spot = data.tobytes(), missed[first]
            texts = [raw[a:b].decode() if whole else raw[a:b].lower().decode() for a, b, whole in zip(start[spot].tolist(), end[spot].tolist(), exact[spot].tolist())]
            self._learn(new, texts)
            place[missed] = self.find(new)[which]
        count = self.count[place]
        total = np.zeros(len(start) + 1, np.int64)
        np.cumsum(count, out=total[1:])
        return self.flat[expand(self.start[place], count)], np.diff(total[at])


_encoders: dict[str, UnitIds] = {}


def write_records(docs: DataFrame, folder: str, tokenizer: str, end: int = END) -> DataFrame:
    """Write the records of all documents to a shared folder; (place, file, n, tokens) of each file.

    One file for each partition of a range partitioning by (id, hash of text),
    as many as ``spark.sql.shuffle.partitions``.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches):
        where, base = filesystem(folder)
        context = TaskContext.get()
        place = context.partitionId()
        name = f"{place:06d}-{context.taskAttemptId()}-{uuid.uuid4().hex[:8]}"
        encoder = _encoders.setdefault(tokenizer, None) or UnitIds(tokenizer)
        _encoders[tokenizer] = encoder
        n = tokens = at = 0
        offsets = []
        with where.open_output_stream(f"{base}/{name}.rec") as out:
            for batch in slices(batches):
                ids, count = encoder.encode(*text_bytes(batch.column(1)))
                bounds = np.append(0, np.cumsum(count)).tolist()
                for i, doc_id in enumerate(batch.column(0).to_pylist()):
                    framed = record(doc_id, np.append(ids[bounds[i] : bounds[i + 1]], np.uint32(end)))
                    offsets.append(at)
                    at += len(framed)
                    out.write(framed)
                n += batch.num_rows
                tokens += len(ids) + batch.num_rows
        with where.open_output_stream(f"{base}/{name}.idx") as out:
            out.write(np.array(offsets, "<u8").tobytes())
        yield pa.RecordBatch.from_arrays([pa.array([place], pa.int32()), pa.array([name]), pa.array([n], pa.int64()), pa.array([tokens], pa.int64())], names=["place", "file", "n", "tokens"])

    where, base = filesystem(folder)
    where.create_dir(base, recursive=True)
    mark = F.xxhash64("text").alias("mark")
    ordered = docs.select("doc_id", "text", mark).repartitionByRange(parts, "doc_id", "mark").sortWithinPartitions("doc_id", "mark")
    return ordered.select("doc_id", "text").mapInArrow(run, "place int, file string, n long, tokens long")


def read_records(spark: SparkSession, folder: str, files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every record, with all lengths and checksums verified.

    ``files`` is the listing of write_records; its rows (one for each file)
    give each file's start.
    """
    listing = sorted((r["place"], r["file"], r["n"], r["tokens"]) for r in files.collect() if r["n"])
    before, todo = 0, []
    for _, name, n, tokens in listing:
        todo.append((name, before, n, tokens))
        before += tokens

    def run(batches):
        where, base = filesystem(folder)
        for batch in batches:
            for name, before, n, tokens in zip(*(c.to_pylist() for c in batch.columns)):
                with where.open_input_file(f"{base}/{name}.idx") as source:
                    offsets = np.frombuffer(source.read(), "<u8").tolist()
                if len(offsets) != n:
                    raise ValueError(f"{name}: {len(offsets)} records in the index, {n} written")
                out, start = [[], [], [], []], before
                with where.open_input_file(f"{base}/{name}.rec") as source:
                    size = source.size()
                    for k, at in enumerate(offsets):
                        data = memoryview(source.read_at((offsets[k + 1] if k + 1 < n else size) - at, at))
                        doc_id, ids, to = parse(data, 0)
                        if to != len(data):
                            raise ValueError(f"{name}: the index doesn't match the record at byte {at}")
                        for column, value in zip(out, (doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()))):
                            column.append(value)
                        start += len(ids)
                if start - before != tokens:
                    raise ValueError(f"{name}: {start - before} ids read, {tokens} written")
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    if not todo:
        return spark.createDataFrame([], schema)
    return spark.createDataFrame(todo, "file string, start long, n long, tokens long").repartition(len(todo)).mapInArrow(run, schema)


def read_at(folder: str, file: str, k: int) -> tuple[int | None, np.ndarray]:
    """The k-th record of a file, by its index."""
    where, base = filesystem(folder)
    with where.open_input_file(f"{base}/{file}.idx") as index, where.open_input_file(f"{base}/{file}.rec") as source:
        at = int(np.frombuffer(index.read_at(8, 8 * k), "<u8")[0])
        size = struct.unpack("<Q", source.read_at(8, at))[0]
        return parse(memoryview(source.read_at(size + 16, at)), 0)[:2]


def token_report(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    spark = docs.sparkSession
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    folder = f"{checkpoint_dir(spark)}/records-{uuid.uuid4().hex}"
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    listing = f"{folder}/files"
    write_records(slim, f"{folder}/data", tokenizer).write.parquet(listing)
    return read_records(spark, f"{folder}/data", spark.read.parquet(listing))
