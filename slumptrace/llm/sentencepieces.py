"""Operator 11: SentencePiece BPE in vectorised merge rounds, and back to text."""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from slumptrace.llm.common import in_slices

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
# Types of pieces in a model file.
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6
_NONE = np.int64(2**62)
# Words of up to this many characters are remembered, and this many of them.
WORD_LENGTH, REMEMBERED = 64, 400_000


def model_path(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class MergeTable:
    """What merging needs of a model: which two symbols make which piece, and how good that piece is.

    A symbol is the id of a piece or, for a character that is none, the vocabulary's size plus its code point. Pieces
    of equal score have equal rank.
    """

    def __init__(self, pieces: list[tuple[str, float, int]], bos: int, eos: int):
        self.size, self.bos, self.eos = len(pieces), bos, eos
        self.wide = np.int64(self.size + 0x110000)
        known = {p: i for i, (p, _, kind) in enumerate(pieces) if kind == _NORMAL}
        self.byte_ids = np.zeros(256, np.int64)
        for i, (piece, _, kind) in enumerate(pieces):
            if kind == _BYTE:
                self.byte_ids[int(piece[3:5], 16)] = i
        self.letters = np.arange(0x110000, dtype=np.int64) + self.size
        for piece, i in known.items():
            if len(piece) == 1:
                self.letters[ord(piece)] = i

        def symbol(text: str) -> int | None:
            return int(self.letters[ord(text)]) if len(text) == 1 else known.get(text)

        rank_of = {s: r for r, s in enumerate(sorted({-s for _, s, kind in pieces if kind == _NORMAL}))}
        rows, beside = [], set()
        for piece, i in known.items():
            rank = rank_of[-pieces[i][1]]
            for k in range(1, len(piece)):
                a, b = symbol(piece[:k]), symbol(piece[k:])
                beside.add(symbol(piece[k - 1]) * int(self.wide) + symbol(piece[k]))
                if a is not None and b is not None:
                    rows.append((a * int(self.wide) + b, rank, i))
        rows.sort()
        self.keys, self.ranks, self.targets = (np.array(c, np.int64) for c in zip(*rows, strict=True)) if rows else [np.zeros(0, np.int64)] * 3
        # Characters that no piece holds side by side never come together: words are cut there.
        self.beside = np.array(sorted(beside), np.int64)
        # White space stands only at the front of pieces, as a rule; then texts can be cut before it.
        spans = any(SPACE in p.lstrip(SPACE) for p in known)
        self.word = r"(?s).+" if spans else r" +[^ ]*"
        # What each id gives when read back: control pieces nothing, byte pieces their byte.
        self.surfaces = [
            b"" if kind == _CONTROL else " ⁇ ".encode() if kind == _UNKNOWN else bytes([int(p[3:5], 16)]) if kind == _BYTE
            else p.replace(SPACE, " ").encode() for p, _, kind in pieces]
        self.is_byte = [kind == _BYTE for _, _, kind in pieces]

    def find(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and target of each pair of neighbours; where they make no piece, the rank is beyond all others."""
        keys = a * self.wide + b
        if not len(self.keys):
            return np.full(len(keys), _NONE), np.zeros(len(keys), np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        found = self.keys[at] == keys
        return np.where(found, self.ranks[at], _NONE), self.targets[at]

    def one_by_one(self, symbols: list[int]) -> list[tuple[int, int]]:
        """The best pair first, the leftmost of equal ones, one at a time: ``(place, symbol)`` of what remains."""
        if not hasattr(self, "pairs"):
            self.pairs = {k: (r, t) for k, r, t in zip(self.keys.tolist(), self.ranks.tolist(), self.targets.tolist(), strict=True)}
        wide, pairs, n = int(self.wide), self.pairs, len(symbols)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heap: list[tuple[int, int, int, int, int]] = []

        def propose(i: int) -> None:
            j = after[i] if i >= 0 else -1
            if j >= 0 and (hit := pairs.get(symbols[i] * wide + symbols[j])):
                heapq.heappush(heap, (hit[0], i, symbols[i], symbols[j], hit[1]))

        for i in range(n):
            propose(i)
        while heap:
            _, i, a, b, target = heapq.heappop(heap)
            j = after[i]
            if symbols[i] != a or j < 0 or symbols[j] != b:
                continue
            symbols[i], symbols[j], after[i] = target, -1, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            propose(before[i])
            propose(i)
        return [(i, s) for i, s in enumerate(symbols) if s >= 0]

    def merge(self, symbols: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Merge the symbols of many words at once; ``first`` marks where a word begins.

        Returns, at the place of its first character, each symbol that is left, and -1 elsewhere. Every round takes
        the best rank of each word and merges its pairs at once, from the left and without overlap; words without any
        pair leave. One at a time, a merge could make a pair that is as good or better, which would come next; a word
        in which a round makes such a pair leaves as well and is merged one by one.
        """
        out = np.full(len(symbols), -1, np.int64)
        if not len(symbols):
            return out
        place = np.arange(len(symbols))
        last = np.append(first[1:], True)
        rank, target = np.full(len(symbols), _NONE), np.zeros(len(symbols), np.int64)
        inner = np.flatnonzero(~last)
        rank[inner], target[inner] = self.find(symbols[inner], symbols[inner + 1])
        while True:
            starts = np.flatnonzero(first)
            sizes = np.diff(np.append(starts, len(symbols)))
            best = np.minimum.reduceat(rank, starts)
            live = best < _NONE
            if not live.all():
                stay = np.repeat(live, sizes)
                out[place[~stay]] = symbols[~stay]
                if not live.any():
                    return out
                symbols, place, first, rank, target = (x[stay] for x in (symbols, place, first, rank, target))
                best, sizes = best[live], sizes[live]
            word = np.repeat(np.arange(len(sizes)), sizes)
            hits = np.flatnonzero(rank == best[word])
            order = np.arange(len(hits))
            run = np.maximum.accumulate(np.where(np.append(True, np.diff(hits) != 1), order, 0))
            at = hits[(order - run) % 2 == 0]
            made, own, size = target[at], word[at], len(symbols)
            # The neighbours that a merge meets when merges go from the left.
            left = symbols[np.maximum(at - 1, 0)]
            follows = np.flatnonzero(np.append(False, np.diff(at) == 2))
            left[follows] = made[follows - 1]
            right = symbols[np.minimum(at + 2, size - 1)]
            has_left, has_right = ~first[at], (at + 2 < size) & (word[np.minimum(at + 2, size - 1)] == own)
            new = np.minimum(np.where(has_left, self.find(left, made)[0], _NONE), np.where(has_right, self.find(made, right)[0], _NONE))
            odd = new <= best[own]
            if odd.any():
                strange = np.zeros(len(sizes), bool)
                strange[own[odd]] = True
                ends = np.cumsum(sizes)
                for w in np.flatnonzero(strange):
                    low, high = ends[w] - sizes[w], ends[w]
                    for k, s in self.one_by_one(symbols[low:high].tolist()):
                        out[place[low + k]] = s
                stay, regular = ~strange[word], ~strange[own]
                moved = np.cumsum(stay) - 1
                at, made = moved[at[regular]], made[regular]
                symbols, place, first, rank, target = (x[stay] for x in (symbols, place, first, rank, target))
                if not len(symbols):
                    return out
            alive, changed = np.ones(len(symbols), bool), np.zeros(len(symbols), bool)
            alive[at + 1] = False
            symbols[at], changed[at] = made, True
            symbols, place, first, rank, target, changed = (x[alive] for x in (symbols, place, first, rank, target, changed))
            last = np.append(first[1:], True)
            rank[last] = _NONE
            again = np.flatnonzero((changed | np.append(changed[1:], False)) & ~last)
            rank[again], target[again] = self.find(symbols[again], symbols[again + 1])

    def encode_words(self, words: list[str]) -> list[bytes]:
        """The ids of each word, as little-endian unsigned 32-bit integers."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        points = np.frombuffer("".join(words).replace(" ", SPACE).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        symbols = self.letters[points]
        first = np.zeros(len(symbols), bool)
        begins = np.cumsum(lengths) - lengths
        first[begins[lengths > 0]] = True
        if len(symbols) > 1:
            keys = symbols[:-1] * self.wide + symbols[1:]
            first[1:] |= ~np.isin(keys, self.beside)
        out = self.merge(symbols, first)
        kept = np.flatnonzero(out >= 0)
        ids = out[kept]
        ends = np.searchsorted(kept, begins + lengths)
        strange = np.flatnonzero(ids >= self.size)
        if len(strange):
            # A character without a piece becomes the pieces of its bytes.
            spelled = [chr(c).encode("utf-8", "surrogatepass") for c in (ids[strange] - self.size).tolist()]
            times = np.ones(len(ids), np.int64)
            times[strange] = [len(s) for s in spelled]
            spread = np.append(0, np.cumsum(times))
            wide = np.repeat(ids, times)
            wide[np.repeat(ids >= self.size, times)] = self.byte_ids[np.frombuffer(b"".join(spelled), np.uint8)]
            ids, ends = wide, spread[ends]
        blob = ids.astype("<u4").tobytes()
        bounds = [0, *(4 * ends).tolist()]
        return [blob[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]


def load_table(path: str | None = None) -> MergeTable:
    """Read a model file. Only BPE models with byte fallback and without normalisation are accepted."""
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(path or model_path(), "rb") as file:
        model.ParseFromString(file.read())
    trained, norm = model.trainer_spec, model.normalizer_spec
    if trained.model_type != 2 or not trained.byte_fallback or trained.treat_whitespace_as_suffix:
        raise ValueError("only BPE models with byte fallback are supported")
    if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix or not norm.escape_whitespaces:
        raise ValueError("only models that leave the text as it is, behind one space, are supported")
    if model.denormalizer_spec.precompiled_charsmap or any(p.type not in (_NORMAL, _UNKNOWN, _CONTROL, _BYTE) for p in model.pieces):
        raise ValueError("models with denormalisation, user-defined or unused pieces are not supported")
    return MergeTable([(p.piece, p.score, p.type) for p in model.pieces], trained.bos_id, trained.eos_id)


class Encoder:
    """Whole texts to ids, remembering the ids of short words."""

    def __init__(self, table: MergeTable):
        self.table, self.word = table, re.compile(table.word)
        self.known: dict[str, bytes] = {}
        self.ends = [np.array([i], "<u4").tobytes() if i >= 0 else b"" for i in (table.bos, table.eos)]

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        """The ids of each text, begin and end included."""
        for low, high in in_slices(texts, 4_000_000):
            rows = [self.word.findall(" " + t.replace(SPACE, " ")) if t else [] for t in texts[low:high]]
            if len(self.known) > REMEMBERED:
                self.known = {}
            fresh = list({w for row in rows for w in row if w not in self.known})
            found, long = self.known, {}
            for a, b in in_slices(fresh, 1_000_000):
                for w, blob in zip(fresh[a:b], self.table.encode_words(fresh[a:b]), strict=True):
                    (found if len(w) <= WORD_LENGTH else long)[w] = blob
            for row in rows:
                if long:
                    body = b"".join([found[w] if w in found else long[w] for w in row])
                else:
                    body = b"".join(map(found.__getitem__, row))
                yield self.ends[0] + body + self.ends[1]


def decode(table: MergeTable, ids: Iterable[int]) -> str:
    """The text of some ids, as the library's ``decode`` gives it.

    Control pieces give nothing, one space at the very front goes, and byte pieces are read as UTF-8; each byte that
    is no part of a character becomes U+FFFD.
    """
    ids = list(ids)
    front = next((i for i in ids if table.surfaces[i]), None)
    drop = front is not None and not table.is_byte[front] and table.surfaces[front][:1] == b" " and table.surfaces[front] != " ⁇ ".encode()
    whole = b"".join(map(table.surfaces.__getitem__, ids))
    try:
        text = whole.decode()
    except UnicodeDecodeError:
        parts, run = [], bytearray()
        for i in [*ids, None]:
            if i is not None and table.is_byte[i]:
                run += table.surfaces[i]
                continue
            parts.append(_lenient(bytes(run)))
            run.clear()
            parts.append(table.surfaces[i].decode() if i is not None else "")
        text = "".join(parts)
    return text[1:] if drop else text


def _lenient(run: bytes) -> str:
    out, at = [], 0
    while at < len(run):
        size = 1 if run[at] < 0xC0 else 2 if run[at] < 0xE0 else 3 if run[at] < 0xF0 else 4
        try:
            out.append(run[at:at + size].decode())
            at += size
        except UnicodeDecodeError:
            out.append("�")
            at += 1
    return "".join(out)


def encode_documents(
    documents: DataFrame, table: MergeTable | None = None, with_ids: bool = False, with_text: bool = False
) -> DataFrame:
    """Encode every whole text and decode it again: ``doc_id, n_tokens, ids_sha256, decoded_sha256``, and on request the
    ``ids`` and the ``decoded`` text.

    Ids are those of the library with begin and end ids. A null or empty text is these two alone and decodes to an
    empty text. Rows with equal or null ids are rows of their own; an empty table gives no rows; other columns are not
    looked at. The table of merges is as large as the vocabulary, whatever the corpus; a text's words are merged
    together, so a very long text is cut only where no piece can reach over.
    """
    shared = documents.sparkSession.sparkContext.broadcast(table or load_table())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = shared.value
        encoder = Encoder(merges)
        for batch in batches:
            texts, names = batch.column("text").to_pylist(), batch.column("doc_id").to_pylist()
            for low, high in in_slices(texts, 4_000_000):
                counts, sums, back_sums, ids, backs = [], [], [], [], []
                for blob in encoder.encode(texts[low:high]):
                    row = np.frombuffer(blob, "<u4")
                    back = decode(merges, row.tolist())
                    counts.append(len(row))
                    sums.append(hashlib.sha256(blob).hexdigest())
                    back_sums.append(hashlib.sha256(back.encode("utf-8", "surrogatepass")).hexdigest())
                    if with_ids:
                        ids.append(row.astype(np.int64))
                    if with_text:
                        backs.append(back)
                columns = {"doc_id": pa.array(names[low:high], batch.column("doc_id").type), "n_tokens": pa.array(counts, pa.int64()),
                           "ids_sha256": pa.array(sums), "decoded_sha256": pa.array(back_sums)}
                if with_ids:
                    columns["ids"] = pa.array(ids, pa.list_(pa.int64()))
                if with_text:
                    columns["decoded"] = pa.array(backs)
                yield pa.RecordBatch.from_pydict(columns)

    schema = f"doc_id {dict(documents.dtypes)['doc_id']}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return documents.select("doc_id", "text").mapInArrow(
        run, schema + ", ids array<bigint>" * with_ids + ", decoded string" * with_text)


def decode_ids(encoded: DataFrame, table: MergeTable | None = None) -> DataFrame:
    """``doc_id, text`` from rows with ``doc_id, ids``. Null ids give a null text, no ids an empty one."""
    shared = encoded.sparkSession.sparkContext.broadcast(table or load_table())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = shared.value
        for batch in batches:
            texts = [None if row is None else decode(merges, row) for row in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {dict(encoded.dtypes)['doc_id']}, text string")
