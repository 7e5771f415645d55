"""Operator 9: best-two-fit packing of tokenised documents into sequences of fixed length."""

from __future__ import annotations

import bisect
import os
import re
import zlib
from array import array
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slumptrace.llm.common import Staging, in_slices, lean, tidy

LIMIT = 2048
TOKENIZER = "word_bpe_49k.json"
END_ID = 0


# Bytes by what they are in UTF-8: blanks, letters, signs that may follow them, and all others. Letters beyond ASCII have two
# bytes, _LATIN and one that is neither of those in _NO_LETTER.
_BLANK, _LETTER, _SIGN, _OTHER = range(4)
_KINDS = np.full(256, _OTHER, np.uint8)
_KINDS[[10, 32]] = _BLANK
_KINDS[[*range(65, 91), *range(97, 123)]] = _LETTER
_KINDS[[*range(33, 39), *range(40, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = _SIGN
_LATIN, _NO_LETTER = 0xC3, (0x97, 0xB7)
# A piece that goes to the model without the pre-tokenizer.
_PLAIN = re.compile(r"[a-zà-öø-ÿß]+|[!-&(-/:-@\[-`{-~]+")


def byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: itself where it prints, else one from 256 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in prints]
    return {b: chr(b) for b in prints} | {b: chr(256 + k) for k, b in enumerate(rest)}


def split_pieces(texts: list[str]) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The pieces of all texts in order, each with the blank behind it, and how many there are up to each text's end.

    Chunks are cut at blanks. One that is a word, letters of ASCII and Latin-1, and maybe signs, is put in lower case and its
    signs are a piece of their own; all others stay as they are. Only arrays over bytes are made.
    """
    data = np.frombuffer(bytearray("".join([t.replace("\n", " ") + "\n" for t in texts]).encode()), np.uint8)
    kind = _KINDS[data]
    second = np.flatnonzero(data == _LATIN) + 1
    second = second[~np.isin(data[second], _NO_LETTER)]
    kind[second] = kind[second - 1] = _LETTER
    before = np.roll(kind, 1)  # the last byte is a blank
    blank = kind == _BLANK
    chunk = np.cumsum(blank, dtype=np.int32)
    chunk -= blank
    odd = np.zeros(chunk[-1] + 1, bool)
    odd[chunk[(kind == _OTHER) | (kind == _SIGN) & (before == _BLANK) | (kind == _LETTER) & (before == _SIGN)]] = True
    large = np.concatenate([np.flatnonzero((data >= 65) & (data <= 90)), second[data[second] < 0x9F]])
    data[large[~odd[chunk[large]]]] += 32
    signs = np.flatnonzero((kind == _SIGN) & (before == _LETTER))
    data = np.insert(data, signs[~odd[chunk[signs]]], 32)
    cuts = np.concatenate([[0], np.flatnonzero((data == 32) | (data == 10)) + 1])
    ends = np.flatnonzero(data[cuts[1:] - 1] == 10) + 1
    data[data == 10] = 32
    return pa.LargeStringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts), pa.py_buffer(data)).dictionary_encode(), ends


class Pieces:
    """Token ids of what was seen before: of words, of the signs after them, and of chunks that are neither.

    The tokenizer cuts at white space and no token spans it, so a text's ids are those of its chunks in order. A chunk
    that is one word, or a word and signs, is two pieces to the pre-tokenizer; these are looked up or encoded by the
    model itself. All other chunks go through the whole tokenizer. Texts are cut, and their ids put together, as arrays:
    only the distinct pieces of a slice are looked at one by one. The memory is emptied when it has grown large.
    """

    def __init__(self, path: str, most: int = 400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.letters, self.most = self.tokenizer.model, byte_letters(), most
        self.forget()

    def forget(self) -> None:
        """Nothing is known but the empty piece, of code 0. The ids of code ``k`` are those from ``ends[k]`` to ``ends[k + 1]``."""
        self.codes: dict[str, int] = {"": 0}
        self.ids, self.ends = array("I"), array("q", [0, 0])

    def learn(self, pieces: list[str]) -> list[int]:
        """The codes of distinct pieces; what is new among them is encoded."""
        found = list(map(self.codes.get, pieces))
        new = [piece for piece, code in zip(pieces, found, strict=True) if code is None]
        if not new:
            return found
        if len(self.codes) + len(new) > self.most:
            self.forget()
            new = [piece for piece in pieces if piece]
        tokenize, ids, ends, done, odd = self.model.tokenize, self.ids, self.ends, [], []
        for piece in new:
            if not _PLAIN.fullmatch(piece):
                odd.append(piece)
                continue
            text = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.letters)
            for token in tokenize(text):
                ids.append(token.id)
            ends.append(len(ids))
            done.append(piece)
        for whole in self.tokenizer.encode_batch_fast(odd, add_special_tokens=False):
            ids.extend(whole.ids)
            ends.append(len(ids))
        self.codes.update(zip(done + odd, range(len(self.codes), len(ends) - 1), strict=True))
        return list(map(self.codes.__getitem__, pieces))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit numbers, with the end id."""
        if not texts:
            return []
        pieces, last = split_pieces([t or "" for t in texts])
        # A blank is the end of a piece and nowhere else.
        distinct = "".join(pieces.dictionary.to_numpy(zero_copy_only=False)).split(" ")[:-1]
        codes = np.array(self.learn(distinct), np.int64)[pieces.indices.to_numpy()]
        bounds = np.array(self.ends)
        starts, sizes = bounds[codes], bounds[codes + 1] - bounds[codes]
        stops = np.cumsum(sizes)
        # The ids of all pieces, one after the other.
        ids = np.array(self.ids, "<u4")[np.repeat(starts - stops + sizes, sizes) + np.arange(stops[-1])]
        stops = stops[last - 1].tolist()
        end = array("I", [END_ID]).tobytes()
        return [ids[low:high].tobytes() + end for low, high in zip([0, *stops], stops)]


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def cut(documents: DataFrame, path: str | None = None, limit: int = LIMIT, with_ids: bool = False) -> DataFrame:
    """Tokenise and cut: one row per piece of at most ``limit`` ids; only longer documents are cut.

    ``part`` and ``place`` number the pieces of one length within the task that made them.
    """
    path = path or tokenizer_path()

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, part = Pieces(path), TaskContext.get().partitionId()
        seen = np.zeros(limit + 1, np.int64)
        for batch in lean(batches):
            texts, ids = batch.column("text").to_pylist(), batch.column("doc_id").to_pylist()
            rows: list[list] = [[] for _ in range(7)]
            blobs = []
            for low, high in in_slices(texts, 4_000_000):
                for doc, blob in zip(ids[low:high], pieces.encode(texts[low:high]), strict=True):
                    for k, at in enumerate(range(0, len(blob), 4 * limit)):
                        chunk = blob[at:at + 4 * limit]
                        n = len(chunk) // 4
                        for column, value in zip(rows, (doc, k, at // 4, n, zlib.crc32(chunk), part, int(seen[n])), strict=True):
                            column.append(value)
                        seen[n] += 1
                        blobs.append(chunk)
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "place"]
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            arrays = [pa.array(r, k) for r, k in zip(rows, kinds, strict=True)]
            if with_ids:
                arrays.append(pa.array(blobs, pa.binary()))
            yield pa.RecordBatch.from_arrays(arrays, names + ["ids"] * with_ids)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, place long" + ", ids binary" * with_ids
    return documents.select("doc_id", "text").mapInArrow(run, schema)


def plan(counts: Mapping[int, int], limit: int = LIMIT) -> list[tuple[list[int], int]]:
    """Bins as ``(lengths, how many such bins)``, from how many pieces there are of each length.

    Best-two-fit: the largest piece left opens a bin, which is filled greedily with the largest that fits. Then its
    smallest piece is taken out again if two pieces left over fit the wider gap more tightly. A bin found is repeated
    as long as pieces last, so the work depends on the number of lengths, not of pieces. Pieces are used once each.
    """
    left = {length: n for length, n in counts.items() if n}
    lengths = sorted(left)  # those with pieces left

    def take(length: int) -> None:
        left[length] -= 1
        if not left[length]:
            lengths.pop(bisect.bisect_left(lengths, length))

    def put(length: int) -> None:
        if not left[length]:
            bisect.insort(lengths, length)
        left[length] += 1

    def best_two(least: int, most: int) -> tuple[int, int] | None:
        """Two pieces of more than ``least`` and at most ``most`` together, as much as possible."""
        best, found = least, None
        for i in range(bisect.bisect_right(lengths, most) - 1, -1, -1):
            a = lengths[i]
            if 2 * a <= best:
                break
            j = bisect.bisect_right(lengths, min(a, most - a)) - 1
            if j >= 0 and lengths[j] == a and left[a] < 2:
                j -= 1
            if j >= 0 and a + lengths[j] > best:
                best, found = a + lengths[j], (a, lengths[j])
                if best == most:
                    break
        return found

    bins = []
    while lengths:
        bin_, gap = [lengths[-1]], limit - lengths[-1]
        take(lengths[-1])
        while gap and lengths and lengths[0] <= gap:
            length = lengths[bisect.bisect_right(lengths, gap) - 1]
            bin_.append(length)
            take(length)
            gap -= length
        while gap and len(bin_) > 1:
            smallest = bin_[-1]
            pair = best_two(smallest, gap + smallest)
            if not pair:
                break
            bin_.pop()
            put(smallest)
            for length in pair:
                take(length)
            gap += smallest - sum(pair)
            bin_ = sorted(bin_ + list(pair), reverse=True)
        each = {x: bin_.count(x) for x in bin_}
        more = min(left[x] // n for x, n in each.items())
        for x, n in each.items():
            if more:
                left[x] -= n * more
                if not left[x]:
                    lengths.pop(bisect.bisect_left(lengths, x))
        bins.append((bin_, 1 + more))
    return bins


def places(bins: list[tuple[list[int], int]]) -> dict[int, tuple[list[int], list[int], list[int], list[int]]]:
    """Where the pieces of each length go: from which rank on, into which sequences, at which offset, how many a bin."""
    out: dict[int, tuple[list[int], list[int], list[int]]] = {}
    used: dict[int, int] = {}
    first = 0
    for bin_, times in bins:
        at = 0
        for length in bin_:
            ranks, sequences, offsets = out.setdefault(length, ([], [], []))
            rank = used.get(length, 0)
            ranks.append(rank)
            sequences.append(first)
            offsets.append(at)
            used[length] = rank + times
            at += length
        first += times
    return out


def pack(pieces: DataFrame, staging: Staging, limit: int = LIMIT) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to stored pieces.

    Only the histogram of lengths (at most ``limit`` numbers) comes to the driver and only the plan (a few thousand
    ranges) goes back. Pieces of one length are alike, so any numbering of them will do: a task's own count, shifted
    by those of the tasks before. No length is gathered in one task, however many pieces share it.
    """
    spark = pieces.sparkSession
    sizes = staging.keep(pieces.groupBy("length", "part").agg(F.count("*").alias("n")), "sizes")
    counts = {r.length: r.n for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = spark.sparkContext.broadcast(places(plan(counts, limit)))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = staging.keep(
        sizes.withColumn("shift", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n"), "shifts")
    ranked = pieces.join(shifts, ["length", "part"]).withColumn("rank", F.col("place") + F.col("shift")).drop("place", "shift", "part")

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = {k: tuple(map(np.array, v)) for k, v in table.value.items()}
        for batch in lean(batches):
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            order = np.argsort(length, kind="stable")
            for rows in np.split(order, np.flatnonzero(np.diff(length[order])) + 1):
                if len(rows):
                    ranks, sequences, offsets = lookup[int(length[rows[0]])]
                    at = np.searchsorted(ranks, rank[rows], "right") - 1
                    sequence[rows] = sequences[at] + rank[rows] - ranks[at]
                    offset[rows] = offsets[at]
            rest = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])

    names = [c for c in ranked.columns if c != "rank"]
    kinds = dict(ranked.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in names) + ", sequence_id long, offset long"
    return ranked.mapInArrow(run, schema)


def pack_documents(
    documents: DataFrame, staging: Staging | None = None, path: str | None = None, limit: int = LIMIT, with_ids: bool = False
) -> DataFrame:
    """Pack whole documents: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` (and ``ids``).

    A null or empty text is the end id alone. Rows with equal or null ids are packed as rows of their own. An empty
    table gives no rows. Sequence numbers are gapless from 0; places in a sequence are gapless from 0.
    """
    staging = staging or Staging(documents.sparkSession, "packing")
    pieces = staging.keep(cut(documents, path, limit, with_ids), "pieces")
    packed = pack(pieces, staging, limit)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", *["ids"] * with_ids)
