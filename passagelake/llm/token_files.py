"""Token ids in seekable files of independent zstandard frames.

Documents are range-partitioned and sorted by doc_id; every task encodes its range and
writes one file:

* *frames* of ``FRAME_TOKENS`` ids each (the last shorter), little-endian unsigned
  integers of 2 or 4 bytes, each a zstandard frame of its own;
* a *document index* in a skippable frame: item width, then doc_ids and token counts;
* a *seek table* in the last skippable frame, in the layout of the Zstandard Seekable
  Format: compressed size, decompressed size and checksum (low 32 bits of the XXH64
  of the content) per frame, then the number of frames.

A reader takes the seek table and the index from the end of a file, finds the tokens
of the documents it wants, and reads and decompresses only the frames that hold
them, checking each one's checksum.  Files are written under a name of the attempt and
renamed when whole.  No task holds more than a batch of texts, the index of its range and a
frame.

With ``by_words`` a text is encoded word by word (runs without blanks) and words are
remembered, which is many times faster; it is exact for tokenizers that never join
characters across blanks.  Null texts count as empty: they have the end id alone.  Rows are
ordered by doc_id (null last), repeated ids by a hash of their text; repeated rows are
documents of their own.  An empty table gives no file and an empty result.  Other
columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from passagelake.llm.common import Words, file_store, partitions, pieces, stored, text_bytes
from passagelake.session import scratch_path

FRAME_TOKENS = 1 << 16
INDEX_MAGIC, SEEK_MAGIC, SEEKABLE = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
FILES = "path string, documents long, tokens long"
TOKENS = "doc_id long, start long, n_tokens long, ids_crc32 long"
#: Words a worker remembers before it forgets those not met since it last did (for pieces
#: likewise), and the longest of them in bytes.
REMEMBERED, LONGEST = 200_000, 48
#: Words (and pieces) that a worker goes on remembering when its task has ended.
CARRIED = 1 << 14
#: Bytes of text encoded at once.
PIECE = 4 << 20
#: Words whose ids are looked up at once; each takes some forty bytes.
AT_ONCE = 1 << 16


class Encoder:
    """Ids of texts by a tokenizer file; ``end_id`` follows every text.

    Words are encoded once and remembered.  If the file's normaliser only composes,
    folds blanks and lower-cases, and its pieces are the matches of a pattern, words of
    printable ASCII are cut by that pattern, and their pieces are remembered too.
    """

    def __init__(self, path: str, end_id: int, by_words: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallelism
        import tokenizers

        self.end, self.by_words = struct.pack("<I", end_id), by_words
        # Functions travel by value and have no module on executors; what a worker
        # process has loaded and encoded is kept on the library's, for its later tasks.
        held = tokenizers.__dict__.setdefault("_encoders", {})
        if path not in held:
            with open(path, encoding="utf-8") as file:
                spec = json.load(file)
            added = b"|".join(re.escape(t["content"].encode()) for t in spec["added_tokens"])
            fits = re.compile((rb"(?!.*(?:%s))" % added if added else b"") + rb"[!-~]+").fullmatch
            held[path] = tokenizers.Tokenizer.from_file(path), self._pattern(spec), fits, {}, {}, {}, {}
        self.tokenizer, self.pattern, self.fits, self.known, self.pieces, self.earlier, self.earlier_pieces = held[path]

    @staticmethod
    def _pattern(spec: dict) -> regex.Pattern | None:
        steps = (spec["normalizer"] or {}).get("normalizers", [])
        cuts = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        fits = (
            [n["type"] for n in steps] == ["NFC", "Replace", "Lowercase"]
            and steps[1]["pattern"] == {"Regex": r"\s+"} and steps[1]["content"] == " "
            and [c["type"] for c in cuts] == ["Split", "ByteLevel"]
            and cuts[0]["behavior"] == "Removed" and cuts[0]["invert"] and "Regex" in cuts[0]["pattern"]
            and not cuts[1]["use_regex"] and not cuts[1]["add_prefix_space"]
        )
        return regex.compile(cuts[0]["pattern"]["Regex"] + "|\n") if fits else None

    def _encoded(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    @staticmethod
    def _forget(known: dict, earlier: dict) -> None:
        """Of too much that is known, keep what was met since the last time as ``earlier``."""
        if len(known) > REMEMBERED:
            earlier.clear()
            earlier.update(known)
            known.clear()

    def carry(self) -> None:
        """When a task has ended: of what is known, keep what was met first, which the next task
        most likely meets; the worker may go on with another step that needs the memory."""
        for known, earlier in ((self.known, self.earlier), (self.pieces, self.earlier_pieces)):
            kept = dict(islice(chain(known.items(), earlier.items()), CARRIED))
            known.clear()
            earlier.clear()
            earlier.update(kept)

    def _piece(self, piece: str) -> bytes:
        code = self.earlier_pieces.get(piece)
        if code is None:
            code = array("I", [t.id for t in self.tokenizer.model.tokenize(piece)]).tobytes()
        if len(piece) <= LONGEST:
            self.pieces[piece] = code
        return code

    def _plain(self, words: list[bytes]) -> list[bytes]:
        """Codes of words of printable ASCII, by the pieces of the pattern."""
        known, codes, code = self.pieces, [], b""
        self._forget(known, self.earlier_pieces)
        for piece in self.pattern.findall((b"\n".join(words) + b"\n").decode().lower()):
            if piece == "\n":
                codes.append(code)
                code = b""
            else:
                code += known.get(piece) or self._piece(piece)
        return codes

    def _words(self, words: list[bytes]) -> list[bytes]:
        known, earlier = self.known, self.earlier
        self._forget(known, earlier)
        codes, new = list(map(known.get, words)), []
        for i in [i for i, c in enumerate(codes) if c is None]:
            codes[i] = earlier.get(words[i])
            if codes[i] is None:
                new.append(i)
            else:
                known[words[i]] = codes[i]
        plain, others = [], []
        for i in new:
            (plain if self.pattern and self.fits(words[i]) else others).append(i)
        found = self._plain([words[i] for i in plain]) if plain else []
        found += self._encoded([words[i].decode() for i in others])
        for i, code in zip(plain + others, found, strict=True):
            codes[i] = code
            if len(words[i]) <= LONGEST:
                known[words[i]] = code
        return codes

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and how many each text has."""
        if not self.by_words:
            codes = [c + self.end for c in self._encoded(pc.fill_null(texts, "").to_pylist())]
            return np.frombuffer(b"".join(codes), "<u4"), np.array([len(c) // 4 for c in codes], np.int64)
        words = Words(texts)
        codes = [*self._words(words.vocabulary), self.end]
        sizes = np.fromiter(map(len, codes), np.int64, len(codes)) // 4
        pool = np.frombuffer(b"".join(codes), "<u4")
        del codes
        order = np.insert(words.ids, words.starts[1:], len(sizes) - 1)  # each text, then the end
        ends = np.cumsum(sizes[order])
        first = np.cumsum(sizes) - sizes
        ids = np.empty(ends[-1] if len(ends) else 0, "<u4")
        for at in range(0, len(order), AT_ONCE):
            part = order[at : at + AT_ONCE]
            start, stop = ends[at] - sizes[part[0]], ends[at + len(part) - 1]
            shift = first[part] - ends[at : at + len(part)] + sizes[part]
            ids[start:stop] = pool[np.repeat(shift, sizes[part]) + np.arange(start, stop)]
        last = ends[words.starts[1:] + np.arange(len(words))]
        return ids, np.diff(last, prepend=0)


def _skippable(magic: int, data: bytes) -> bytes:
    return struct.pack("<II", magic, len(data)) + data


class TokenFile:
    """Writes one file; ``out`` is any object with ``write``."""

    def __init__(self, out, width: int):
        self.out, self.kind = out, f"<u{width}"
        self.press = zstandard.ZstdCompressor(level=3)
        self.rest, self.ids, self.counts, self.table = np.empty(0, self.kind), [], [], []

    def _frame(self, tokens: np.ndarray) -> None:
        data = tokens.tobytes()
        packed = self.press.compress(data)
        self.out.write(packed)
        self.table.append((len(packed), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))

    def add(self, doc_ids: list[int | None], tokens: np.ndarray, counts: np.ndarray) -> None:
        self.ids.append(np.array([0 if i is None else i for i in doc_ids], "<i8"))
        self.counts.append(np.where([i is None for i in doc_ids], -counts, counts).astype("<i8"))
        self.rest = np.concatenate([self.rest, tokens.astype(self.kind)])
        whole = len(self.rest) // FRAME_TOKENS * FRAME_TOKENS
        for start in range(0, whole, FRAME_TOKENS):
            self._frame(self.rest[start : start + FRAME_TOKENS])
        self.rest = self.rest[whole:]

    def close(self) -> tuple[int, int]:
        """Write what is left, the index and the seek table; documents and tokens."""
        if len(self.rest):
            self._frame(self.rest)
        ids, counts = np.concatenate(self.ids), np.concatenate(self.counts)
        # A count is negative where the doc_id is null; every document has a token.
        index = bytes([int(self.kind[2:])]) + self.press.compress(ids.tobytes() + counts.tobytes())
        index = _skippable(INDEX_MAGIC, index)
        self.out.write(index)
        self.table.append((len(index), 0, xxhash.xxh64_intdigest(b"") & 0xFFFFFFFF))
        rows = b"".join(struct.pack("<III", *row) for row in self.table)
        self.out.write(_skippable(SEEK_MAGIC, rows + struct.pack("<IBI", len(self.table), 1 << 7, SEEKABLE)))
        return len(ids), int(np.abs(counts).sum())


class TokenReader:
    """Reads one file; ``source`` has ``read``, ``seek`` and ``size``."""

    def __init__(self, source):
        self.source, size = source, source.size()
        frames, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEKABLE or flags != 1 << 7:
            raise ValueError("no seek table of the layout written here")
        table = np.frombuffer(self._at(size - 9 - 12 * frames, 12 * frames), "<u4").reshape(-1, 3).astype(np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(table[:, 0])])
        index = self._at(int(self.offsets[-2]), int(table[-1, 0]))[8:]
        self.kind = np.dtype(f"<u{index[0]}")
        both = np.frombuffer(zstandard.decompress(index[1:]), "<i8").reshape(2, -1)
        self.table = table[:-1]
        self.null, self.counts = both[1] < 0, np.abs(both[1])
        self.doc_ids = both[0]
        self.starts = np.cumsum(self.counts) - self.counts
        self.frame_ends = np.cumsum(self.table[:, 1]) // self.kind.itemsize
        self.held: tuple[int, np.ndarray] = (-1, np.empty(0, self.kind))
        self.frames_read = 0

    def _at(self, offset: int, size: int) -> bytes:
        self.source.seek(offset)
        return self.source.read(size)

    def _frame(self, i: int) -> np.ndarray:
        if self.held[0] != i:
            data = zstandard.decompress(self._at(int(self.offsets[i]), int(self.table[i, 0])))
            if len(data) != self.table[i, 1] or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != self.table[i, 2]:
                raise ValueError(f"frame {i} doesn't have its checksum")
            self.held = i, np.frombuffer(data, self.kind)
            self.frames_read += 1
        return self.held[1]

    def parts(self, document: int) -> Iterator[np.ndarray]:
        """The ids of a document, frame by frame."""
        start, stop = int(self.starts[document]), int(self.starts[document] + self.counts[document])
        i = int(np.searchsorted(self.frame_ends, start, side="right"))
        while start < stop:
            base = int(self.frame_ends[i - 1]) if i else 0
            end = min(stop, int(self.frame_ends[i]))
            yield self._frame(i)[start - base : end - base]
            start, i = end, i + 1


def _writer(folder: str, path: str, end_id: int, by_words: bool, width: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, out, file = Encoder(path, end_id, by_words), None, None
        store, root = file_store(folder)
        store.create_dir(root, recursive=True)
        context = TaskContext.get()
        name = f"{root}/tokens-{context.partitionId():06d}.zst"
        attempt = f"{name}.{context.taskAttemptId()}"
        for batch in batches:
            for part in pieces(batch, size=PIECE):
                if out is None:
                    out = store.open_output_stream(attempt, compression=None)
                    file = TokenFile(out, width)
                file.add(part["doc_id"].to_pylist(), *encode(part["text"]))
        if out is not None:
            documents, tokens = file.close()
            out.close()
            store.move(attempt, name)
            encode.carry()
            yield pa.RecordBatch.from_pylist([{"path": name, "documents": documents, "tokens": tokens}])

    return write


def write_tokens(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int, by_words: bool = False, width: int = 4
) -> DataFrame:
    """Encode ``docs (doc_id, text)`` into ``folder``; ``(path, documents, tokens)`` of the files.

    Paths ascend with the doc_ids they hold.  ``width`` is the bytes of an id in the
    files, 2 if all ids are below 65,536.
    """
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("tie"))
    order = [F.asc_nulls_last("doc_id"), F.asc("tie")]
    count = partitions(docs.sparkSession, text_bytes(docs), 64 << 20)
    ranged = rows.repartitionByRange(count, *order).sortWithinPartitions(*order).select("doc_id", "text")
    return stored(ranged.mapInArrow(_writer(folder, tokenizer, end_id, by_words, width), FILES), "token-files")


def _reader(folder: str):
    kinds = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = file_store(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with store.open_input_file(row["path"]) as source:
                    file = TokenReader(source)
                    sums = np.zeros(len(file.counts), np.int64)
                    for i in range(len(sums)):
                        crc = 0
                        for part in file.parts(i):
                            crc = zlib.crc32(part.astype("<u4").tobytes(), crc)
                        sums[i] = crc
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(file.doc_ids, mask=file.null), pa.array(file.starts + row["base"]), pa.array(file.counts), pa.array(sums)],
                        schema=kinds,
                    )

    return read


def read_tokens(spark: SparkSession, files: DataFrame, folder: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document in the files.

    ``start`` counts the ids of all documents before it, over all files in order.
    """
    before = Window.orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    placed = files.select("path", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base"))
    return placed.repartition(max(1, files.count())).mapInArrow(_reader(folder), TOKENS)


def token_roundtrip(
    docs: DataFrame, tokenizer: str, end_id: int, by_words: bool = False, width: int = 4
) -> DataFrame:
    """Write the token files of ``docs`` and read them back."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "tokens")
    return read_tokens(spark, write_tokens(docs, folder, tokenizer, end_id, by_words, width), folder)
