"""Operator 1: secrets found by fixed patterns, and more of them by a linear-chain conditional random field."""

from __future__ import annotations

import hashlib
import math
import random
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, reduce
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slumptrace.llm.common import Staging, in_slices, lean, sample_rows, tidy

KINDS = ("assign", "access", "hex", "crf")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
_TOKEN = re.compile(r"[\w+/.-]+|[^\w\s]")
_KEYWORD = re.compile(r"pass|secret|token|key|auth|cred|bearer|private", re.IGNORECASE)

O, B, I = range(3)
# A token's code: one of 512 shapes, one of 1024 words.
SHAPES, WORDS, FILES = 512, 1024, 64
OFFSETS = (-3, -2, -1, 0, 1, 2)
# The classifier is fitted on windows of a sample of documents: around up to so many hits in each, and one elsewhere.
SAMPLE_DOCUMENTS, HITS_PER_DOCUMENT, CONTEXT = 6_000, 8, 12
# At most so many windows of each kind are kept: hits as they are, hits rewritten, decoys, and other places.
MOST_WINDOWS = {"hit": 400, "rewritten": 1_200, "decoy": 600, "other": 800}
# The share of short tokens that are hidden in a window, drawn for each, so that no neighbour is relied on.
HIDDEN = (0.0, 0.5, 0.9)
# The field's spans hold a token of at least so many characters, a digit among them; plain words are no secrets by themselves.
LEAST_LENGTH = 12
# What a rewritten hit may be introduced and joined by. Half have no name at all.
NAMES = ("pwd", "pass", "auth", "credentials", "access", "login", "key", "value", "sig", "Authorization", "AUTH_KEY", "x", "my", "the")
SIGNS = ("=", " = ", ":", ": ", " -> ", " => ", " ", " := ", " is ", ", ", "=>", '": ')
QUOTES = ("", "", "", "", '"', "'", "`")
ALPHABETS = (
    "0123456789abcdef", "0123456789ABCDEF", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "abcdefghijklmnopqrstuvwxyz0123456789",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_")


def base_spans(text: str) -> list[tuple[int, int, int, int, int]]:
    """The matches of the fixed patterns: ``(start, kind, end, secret start, secret end)``, ordered."""
    found = []
    if ":" in text or "=" in text:
        found += [(m.start(), 0, m.end(), m.start(2), m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m.start(), m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end(), m.start(), m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def shape_of(token: str) -> int:
    """What a token is made of, how long and how varied it is, and whether it names a secret."""
    n = len(token)
    digits = sum(c.isdigit() for c in token)
    if n == 1 and not token.isalnum():
        kind = {'"': 0, "'": 0, "=": 1, ":": 2}.get(token, 3)
    elif not token.isascii():
        kind = 4
    elif token.isalpha():
        kind = 5 if token.islower() else 6 if token.isupper() else 7 if token[1:].islower() else 8
    elif digits == n:
        kind = 9
    elif all(c in "0123456789abcdef" for c in token):
        kind = 10
    elif token.isalnum():
        kind = 11 if token.islower() else 12 if token.isupper() else 13
    else:
        kind = 14 if digits else 15
    size = 0 if n < 6 else 1 if n < 12 else 2 if n < 20 else 3
    varied = len(set(token)) * 4 // max(1, min(n, 16)) > 2
    return ((kind * 4 + size) * 2 + varied) * 2 + bool(_KEYWORD.search(token))


class Codes(dict):
    """Codes of tokens seen before; emptied when it has grown large."""

    def __missing__(self, token: str) -> int:
        if len(self) >= 100_000:
            self.clear()
        # The hash of a long mixed token says nothing about the next one.
        mixed = len(token) >= 12 and any(c.isdigit() for c in token)
        word = 0 if mixed else 1 + xxhash.xxh64_intdigest(token.lower()) % (WORDS - 1)
        self[token] = code = (1 + shape_of(token)) * WORDS + word
        return code


def file_code(text: str, n_tokens: int) -> int:
    """Features of the whole text: its length, and how much of it is digits and assignment signs."""
    signs = text.count("=") + text.count(":")
    return min(7, int(math.log2(n_tokens + 1)) // 2) * 8 + min(7, int(64 * signs / (n_tokens + 1)))


@dataclass
class Field:
    """Weights of the chain: per offset and shape or word, per file code, and per pair of tags."""

    weights: np.ndarray
    files: np.ndarray
    transition: np.ndarray

    @cached_property
    def emission(self) -> np.ndarray:
        """One weight per offset, code and tag. These are some 40 MB, so tasks add up the weights of shape and word instead."""
        shapes, words = self.weights[:, :SHAPES], self.weights[:, SHAPES:]
        return (shapes[:, :, None, :] + words[:, None, :, :]).reshape(len(OFFSETS), SHAPES * WORDS, 3)


def _tags(tokens: list[tuple[int, int]], secrets: list[tuple[int, int]]) -> np.ndarray:
    tags = np.zeros(len(tokens), np.int8)
    starts = np.fromiter((s for s, _ in tokens), np.int64, len(tokens))
    for start, end in secrets:
        a, b = np.searchsorted(starts, (start, end))
        if a and tokens[a - 1][1] > start:
            a -= 1
        tags[a:b] = I
        tags[a:a + 1] = B
    return tags


def rewritten(text: str, span: tuple[int, int], rng: random.Random) -> tuple[str, tuple[int, int]]:
    """The surroundings of a hit with another secret in its place, and where that is.

    Name, sign, quotes, alphabet, case and length are drawn anew, so that none of them tells a secret by itself: what is
    left to learn is the look of the token and of the words around it.
    """
    letters, size = rng.choice(ALPHABETS), rng.choice((16, 20, 24, 32, 36, 40, 48, 64, rng.randint(14, 70)))
    value = "".join(rng.choice(letters) for _ in range(size))
    if not any(c.isdigit() for c in value):
        value = value[:-1] + rng.choice("0123456789")
    if rng.random() < 0.15:
        value = ".".join((value, value[::-1], value[3:]))
    quote = rng.choice(QUOTES)
    lead = (rng.choice(NAMES) + rng.choice(SIGNS) if rng.random() < 0.5 else "") + quote
    # Quotes around the old one would give the new one away.
    before, after = text[max(0, span[0] - 200):span[0]].rstrip("\"'`"), text[span[1]:span[1] + 200].lstrip("\"'`")
    start = len(before) + len(lead)
    return before + lead + value + quote + after, (start, start + len(value))


def decoy(text: str, at: int, rng: random.Random) -> str:
    """A place of a text where something stands that only looks like a secret: a name and a sign before a plain word,
    a date, a number, a version, an address."""
    words = text[max(0, at - 400):at + 400].split() or ["word"]
    plain = "".join(c for c in rng.choice(words) if c.isalpha()) or "word"
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    look = rng.choice((
        plain, plain.upper(), plain.title() + rng.choice(words).title(), digits(rng.randint(1, 16)), f"{digits(4)}-{digits(2)}-{digits(2)}",
        f"v{digits(1)}.{digits(2)}.{digits(1)}", f"https://{plain}.example.com/{plain}/{digits(4)}.html?page={digits(1)}", f"{plain}.{plain}@example.com",
        f"+{digits(2)} {digits(3)} {digits(7)}", f"/usr/{plain}/{plain}.{plain[:3]}", f"{plain}_{plain}_{digits(2)}", f"{plain}-{plain}-{plain}",
        "-" * rng.randint(3, 40), "=" * rng.randint(3, 40), plain * rng.randint(2, 5)))
    lead = rng.choice((*NAMES, "password", "token", "secret", "api key", "Bearer")) + rng.choice(SIGNS) if rng.random() < 0.6 else ""
    return f"{text[max(0, at - 200):at]} {lead}{look} {text[at:at + 200]}"


@tidy
def _training_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows of codes and tags of each kind in ``MOST_WINDOWS``."""
    codes_of, pad = Codes(), max(map(abs, OFFSETS))
    for batch in lean(batches):
        rows = {"codes": [], "tags": [], "file": [], "kind": []}

        def add(kind: str, text: str, secrets: list[tuple[int, int]], places: list[int] | None, file: int | None = None) -> None:
            matches = list(_TOKEN.finditer(text))
            if not matches:
                return
            codes = np.zeros(len(matches) + 2 * pad, np.int32)
            codes[pad:-pad] = [codes_of[m[0]] for m in matches]
            tags = _tags([m.span() for m in matches], secrets)
            if places is None:
                places = np.flatnonzero(tags == B)[:HITS_PER_DOCUMENT].tolist()
            if kind != "hit":
                draw = np.random.default_rng(xxhash.xxh64_intdigest(text))
                seen = draw.random(len(matches)) >= draw.choice(HIDDEN)
                codes[pad:-pad] *= (tags > 0) | seen | np.array([len(m[0]) >= 8 for m in matches])
            for at in places:
                low, high = max(0, at - CONTEXT), min(len(matches), at + CONTEXT + 1)
                rows["codes"].append(codes[low:high + 2 * pad].tolist())
                rows["tags"].append(tags[low:high].tolist())
                rows["file"].append(file_code(text, len(matches)) if file is None else file)
                rows["kind"].append(kind)

        for text in batch.column("text").to_pylist():
            n_tokens = len(_TOKEN.findall(text or ""))
            if not n_tokens:
                continue
            seed = xxhash.xxh64_intdigest(text)
            rng, file = random.Random(seed), file_code(text, n_tokens)
            base = base_spans(text)
            secrets = [(start, end) for _, _, _, start, end in base]
            add("hit", text, secrets, None)
            add("other", text, secrets, [seed % n_tokens])
            for a, _, b, _, _ in base[:HITS_PER_DOCUMENT]:
                for _ in range(3):
                    new, place = rewritten(text, (a, b), rng)
                    add("rewritten", new, [place, *((s, e) for _, _, _, s, e in base_spans(new) if e <= place[0] or s >= place[1])], None, file)
            new = decoy(text, rng.randrange(len(text)), rng)
            if not base_spans(new):
                middle = len(_TOKEN.findall(new)) // 2
                add("decoy", new, [], [middle], file)
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows["codes"], pa.list_(pa.int32())), pa.array(rows["tags"], pa.list_(pa.int32())),
             pa.array(rows["file"], pa.int32()), pa.array(rows["kind"], pa.string())], ["codes", "tags", "file", "kind"])


def fit(rows: list, rounds: int = 120, rate: float = 0.15, ridge: float = 2e-5) -> Field:
    """Maximise the likelihood of the tagged windows by forward-backward and Adam; outside a window the tag is O.

    The rows are few by the bound on the sample. Without rows the field tags nothing.
    """
    pad = max(map(abs, OFFSETS))
    weights = np.zeros((len(OFFSETS), SHAPES + WORDS, 3), np.float32)
    files, transition = np.zeros((FILES, 3), np.float32), np.zeros((3, 3), np.float32)
    weights[OFFSETS.index(0), :, O] = 0.5
    if not rows:
        files[:, O] = 50
        return Field(weights, files, transition)
    width = max(len(r.tags) for r in rows)
    n = len(rows)
    codes, tags, real = np.zeros((n, width + 2 * pad), np.int32), np.zeros((n, width), np.int8), np.zeros((n, width), bool)
    for k, r in enumerate(rows):
        codes[k, :len(r.codes)], tags[k, :len(r.tags)], real[k, :len(r.tags)] = r.codes, r.tags, True
    shape, word, file = codes // WORDS, codes % WORDS + SHAPES, np.array([r.file for r in rows])
    gold = (np.arange(3) == tags[:, :, None]) & real[:, :, None]
    before = np.concatenate([np.zeros((n, 1), np.int8), tags], 1)
    after = np.concatenate([tags, np.zeros((n, 1), np.int8)], 1)
    last = real.sum(1) - 1
    links = np.concatenate([real, np.zeros((n, 1), bool)], 1)  # into each token, and out of the last
    links[np.arange(n), last + 1] = True
    gold_pairs = np.zeros((3, 3))
    np.add.at(gold_pairs, (before[links], after[links]), 1)
    params, first, second = [weights, files, transition], [], []
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]

    def total(a: np.ndarray, axis: int) -> np.ndarray:
        top = a.max(axis, keepdims=True)
        return np.log(np.exp(a - top).sum(axis)) + top.squeeze(axis)

    for step in range(1, rounds + 1):
        score = np.repeat(files[file][:, None, :], width, 1).astype(np.float64)
        for o, offset in enumerate(OFFSETS):
            cut = slice(pad + offset, pad + offset + width)
            score += weights[o][shape[:, cut]] + weights[o][word[:, cut]]
        # Beyond the window the only tag is O, at no score.
        score[~real] = (0, -1e4, -1e4)
        forward = np.empty((n, width, 3))
        forward[:, 0] = score[:, 0] + transition[O]
        for t in range(1, width):
            forward[:, t] = score[:, t] + total(forward[:, t - 1][:, :, None] + transition, 1)
        backward = np.empty((n, width, 3))
        backward[:, -1] = transition[:, O]
        for t in range(width - 2, -1, -1):
            backward[:, t] = total(transition + (score[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
        z = total(forward[:, -1] + transition[:, O], 1)
        share = np.exp(forward + backward - z[:, None, None])
        error = (share - gold) * real[:, :, None] / n
        pair = np.exp(forward[:, :-1, :, None] + transition + (score[:, 1:] + backward[:, 1:])[:, :, None, :] - z[:, None, None, None])
        pairs = (pair * real[:, 1:, None, None]).sum((0, 1))
        pairs[O] += share[:, 0].sum(0)
        pairs[:, O] += share[np.arange(n), last].sum(0)
        slopes = [np.zeros_like(weights), np.zeros_like(files), ((pairs - gold_pairs) / n).astype(np.float32)]
        flat = error[real]
        for o, offset in enumerate(OFFSETS):
            cut = slice(pad + offset, pad + offset + width)
            for ids in (shape[:, cut][real], word[:, cut][real]):
                for tag in range(3):
                    slopes[0][o, :, tag] += np.bincount(ids, flat[:, tag], SHAPES + WORDS)
        for tag in range(3):
            slopes[1][:, tag] = np.bincount(np.repeat(file, real.sum(1)), flat[:, tag], FILES)
        for p, g, m, v in zip(params, slopes, first, second, strict=True):
            g += ridge * p
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Field(weights, files, transition)


def viterbi(score: np.ndarray, transition: np.ndarray) -> np.ndarray:
    """The best tags of many chains at once, from scores ``[chain, time, tag]``; each begins and ends next to O."""
    n, width, _ = score.shape
    best, back = score[:, 0] + transition[O], np.zeros((n, width, 3), np.int8)
    for t in range(1, width):
        ways = best[:, :, None] + transition
        back[:, t] = ways.argmax(1)
        best = ways.max(1) + score[:, t]
    tags = np.zeros((n, width), np.int8)
    tags[:, -1] = (best + transition[:, O]).argmax(1)
    for t in range(width - 1, 0, -1):
        tags[:, t - 1] = back[np.arange(n), t, tags[:, t]]
    return tags


def certain_margin(transition: np.ndarray) -> float:
    """If O beats B and I by more than this at a token, no neighbours can make another tag part of the best path."""
    gain = transition[:, :, None] + transition[None, :, :]  # into the token, out of it
    return float((gain[:, 1:, :] - gain[:, :1, :]).max())


def tag(codes: np.ndarray, files: np.ndarray, field: Field) -> np.ndarray:
    """Viterbi tags of all tokens. ``codes`` has zeros around each text; ``files`` is the file code per position.

    Tokens that are O on every best path cut the chain, so only the short runs between them are decoded. The result
    is the same as that of decoding whole texts.
    """
    pad = max(map(abs, OFFSETS))
    tags = np.zeros(len(codes), np.int8)
    score = field.files[files]
    padded = np.concatenate([np.zeros(pad, codes.dtype), codes, np.zeros(pad, codes.dtype)])
    shapes, words = padded // WORDS, padded % WORDS + SHAPES
    for o, offset in enumerate(OFFSETS):
        cut = slice(pad + offset, pad + offset + len(codes))
        score += field.weights[o][shapes[cut]] + field.weights[o][words[cut]]
    open_ = (score[:, O] - score[:, 1:].max(1) <= certain_margin(field.transition)) & (codes > 0)
    places = np.flatnonzero(open_)
    if not len(places):
        return tags
    breaks = np.flatnonzero(np.diff(places) > 1) + 1
    starts, ends = places[np.r_[0, breaks]], places[np.r_[breaks - 1, len(places) - 1]] + 1
    lengths = ends - starts
    for size in np.unique(1 << np.ceil(np.log2(lengths)).astype(int)):
        runs = np.flatnonzero((lengths <= size) & (lengths > size // 2))
        for part in np.array_split(runs, max(1, len(runs) * size // 2_000_000)):
            at = starts[part, None] + np.arange(size)
            inside = at < ends[part, None]
            chain = score[np.minimum(at, len(codes) - 1)].astype(np.float64)
            chain[~inside] = (0, -1e9, -1e9)
            found = viterbi(chain, field.transition)
            tags[at[inside]] = found[inside]
    return tags


def crf_spans(tokens: list[tuple[int, int]], tags: np.ndarray) -> list[tuple[int, int]]:
    """Spans of B and the I that follow; an I after O begins a span as well."""
    spans = []
    for k in np.flatnonzero(tags):
        if tags[k] == I and spans and spans[-1][2] == k - 1:
            spans[-1] = (spans[-1][0], tokens[k][1], k)
        else:
            spans.append((tokens[k][0], tokens[k][1], k))
    return [(a, b) for a, b, _ in spans]


def plausible(span: str) -> bool:
    return any(len(t) >= LEAST_LENGTH and any(c.isdigit() for c in t) for t in _TOKEN.findall(span))


def find_all(texts: list[str], field: Field, codes_of: Codes) -> Iterator[list[tuple[int, int, int]]]:
    """For each text all spans ``(start, kind, end)``: the patterns', and the field's that touch none of them and hold a
    token that can be a secret (``LEAST_LENGTH``)."""
    for low, high in in_slices(texts):
        part = [t or "" for t in texts[low:high]]
        found = [_TOKEN.findall(t) for t in part]
        sizes = np.array([len(f) for f in found])
        gap = max(map(abs, OFFSETS))
        starts = np.cumsum(np.r_[gap, sizes[:-1] + gap])
        codes = np.zeros(int(sizes.sum()) + gap * (len(part) + 1), np.int32)
        files = np.zeros(len(codes), np.int8)
        for text, tokens, at in zip(part, found, starts, strict=True):
            codes[at:at + len(tokens)] = list(map(codes_of.__getitem__, tokens))
            files[at:at + len(tokens)] = file_code(text, len(tokens))
        tags = tag(codes, files, field)
        for text, tokens, at in zip(part, found, starts, strict=True):
            base = base_spans(text)
            spans = [(a, kind, b) for a, kind, b, _, _ in base]
            mine = tags[at:at + len(tokens)]
            if mine.any():
                places = [m.span() for m in _TOKEN.finditer(text)]
                begins = [s for s, *_ in base]
                # How far the patterns' spans that begin up to here reach.
                reach = [0, *accumulate((e for _, _, e, _, _ in base), max)]
                spans += [(a, 3, b) for a, b in crf_spans(places, mine) if reach[bisect_left(begins, b)] <= a and plausible(text[a:b])]
            yield sorted(spans)


def digest(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{a}:{b}" for a, kind, b in spans)


def train(documents: DataFrame, sample: int = SAMPLE_DOCUMENTS) -> Field:
    """Fit the field on windows of at most ``sample`` documents, chosen by hash of id.

    What the patterns find is tagged as it is, and again with its secret, name and signs replaced (:func:`rewritten`), so
    that the field finds forms that no pattern knows; decoys and other places are tagged O. Documents without id are
    not trained on; without any hit the field tags nothing.
    """
    staging = Staging(documents.sparkSession, "secret-windows")
    windows = staging.keep(sample_rows(documents.select("doc_id", "text"), "doc_id", sample).select("text").mapInArrow(
        _training_windows, "codes array<int>, tags array<int>, file int, kind string"), "windows")
    # The windows of each kind with the smallest hashes: the same whatever the partitions.
    parts = [
        windows.where(F.col("kind") == kind).orderBy(F.xxhash64("codes", "tags"), "codes", "tags", "file").limit(most)
        for kind, most in MOST_WINDOWS.items()]
    rows = reduce(DataFrame.union, parts).collect()
    staging.drop("windows")
    return fit(rows if any(any(r.tags) for r in rows) else [])


def scan(documents: DataFrame, field: Field) -> DataFrame:
    """All secrets of every whole text: ``doc_id, n_assign, n_access, n_hex, n_crf, base_sha256, spans``.

    One row per input row; null and empty texts have no spans; offsets are code points. Texts are read one batch at
    a time, and the field (about 0.1 MB, fixed by its parameters) is broadcast.
    """
    shared = documents.sparkSession.sparkContext.broadcast((field.weights, field.files, field.transition))

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes_of, model = Codes(), Field(*shared.value)
        for batch in lean(batches):
            spans = list(find_all(batch.column("text").to_pylist(), model, codes_of))
            base = [[s for s in row if s[1] < 3] for row in spans]
            counts = [pa.array([sum(s[1] == k for s in row) for row in spans], pa.int64()) for k in range(4)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *counts,
                 pa.array([hashlib.sha256(digest(row).encode()).hexdigest() for row in base], pa.string()),
                 pa.array([digest(row) for row in spans], pa.string())],
                ["doc_id", "n_assign", "n_access", "n_hex", "n_crf", "base_sha256", "spans"])

    return documents.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_assign long, n_access long, n_hex long, n_crf long, base_sha256 string, spans string")


def redact(documents: DataFrame, field: Field, mark: str = "[SECRET]") -> DataFrame:
    """The documents with every secret replaced by ``mark``; all rows and columns stay. Null texts stay null.

    A column ``n_chars`` of whole numbers is set to the new text's length where the text changed; one of another kind is
    left as it is, like all other columns. Rows with equal or null ids are rows of their own.
    """
    shared = documents.sparkSession.sparkContext.broadcast((field.weights, field.files, field.transition))

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes_of, model = Codes(), Field(*shared.value)
        for batch in lean(batches):
            texts = batch.column("text").to_pylist()
            out = []
            for text, spans in zip(texts, find_all(texts, model, codes_of), strict=True):
                end, parts = 0, []
                for a, _, b in spans:
                    if a >= end:
                        parts += [text[end:a], mark]
                    end = max(end, b)
                out.append("".join(parts) + text[end:] if spans else text)
            changed = {"text": out}
            if "n_chars" in batch.schema.names and pa.types.is_integer(batch.schema.field("n_chars").type):
                lengths = batch.column("n_chars").to_pylist()
                changed["n_chars"] = [n if new == old else len(new) for n, new, old in zip(lengths, out, texts, strict=True)]
            for name, values in changed.items():
                at = batch.schema.get_field_index(name)
                batch = batch.set_column(at, batch.schema.field(at), pa.array(values, batch.schema.field(at).type))
            yield batch

    return documents.mapInArrow(run, documents.schema)
