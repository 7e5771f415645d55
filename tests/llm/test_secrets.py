import hashlib
import pickle
import re

import numpy as np
import pytest

from slumptrace.llm import secrets as S

KEY = "AKIA" + "ABCDEFGH12345678"
HEX = "0123456789abcdef01234567"


def brute(text):
    """The fixed patterns, straight from their description."""
    text, found = text or "", []
    letters = lambda w: "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in w)
    words = "|".join([*map(letters, ("password", "passwd", "secret", "token")), letters("api") + "_?" + letters("key")])
    for m in re.finditer(rf"""({words})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 6:
            found.append((m.start(), 0, m.end()))
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(found))


TEXTS = [
    None, "", "nothing here", f"token = \"{HEX}\" and more", f"x {KEY} y", "AKIASHORT", f"PassWord:'hunter22' passwd=short secret=a_b/c+d==",
    "api_key=abcdef apikey: 123456 api__key=abcdef", f"é{HEX}é {HEX}{HEX}", "token=abc token=abcdef", "ſecret=abcdefg toKen=abcdefg",
    f"token={HEX} token={HEX}", "word " * 30_000 + f"token={HEX}", "password = = abcdefg", "secret:token=abcdefgh",
]


def test_patterns_match_their_description():
    for text in TEXTS:
        assert S.digest([(a, k, b) for a, k, b, _, _ in S.base_spans(text or "")]) == brute(text)


def test_scan_keeps_base_spans_and_adds_disjoint_ones(documents):
    df = documents(*enumerate(TEXTS), (0, TEXTS[3]), (None, TEXTS[3]))
    rows = S.scan(df, S.train(df)).collect()
    assert len(rows) == len(TEXTS) + 2
    for row in rows:
        if row.doc_id is None or row.doc_id == 0 and row.n_assign:
            text = TEXTS[3]
        else:
            text = TEXTS[row.doc_id]
        spans = [s for s in row.spans.split(",") if s]
        base = [s for s in spans if not s.startswith("crf")]
        assert ",".join(base) == brute(text)
        assert row.base_sha256 == hashlib.sha256(brute(text).encode()).hexdigest()
        assert (row.n_assign, row.n_access, row.n_hex, row.n_crf) == tuple(
            sum(s.startswith(k) for s in spans) for k in ("assign", "access", "hex", "crf"))
        places = lambda s: tuple(map(int, s.split(":")[1:]))
        for extra in set(spans) - set(base):
            a, b = places(extra)
            assert all(b <= c or a >= d for c, d in map(places, base))
    assert S.scan(df.limit(0), S.train(df.limit(0))).count() == 0


PROSE = ["alpha", "beta", "gamma", "delta", "of", "the", "and", "Running", "house", "2021", "river", "it", "was", "Paris", "17", "slowly"]


def prose(rng, n=12):
    return " ".join(rng.choice(PROSE, n))


@pytest.fixture(scope="module")
def field(spark):
    """Trained on texts in which every secret follows a key word of the patterns and is lower-case hexadecimal."""
    rng = np.random.default_rng(1)
    make = lambda: "".join(rng.choice(list("abcdef0123456789"), 40))
    rows = [(i, f'{prose(rng)} token = "{make()}" {prose(rng)}' if i % 2 else f"{prose(rng)}. {prose(rng)}") for i in range(600)]
    return S.train(spark.createDataFrame(rows, "doc_id long, text string"))


def planted(rng, size):
    """Forms that no pattern knows, with names and signs that no training window holds."""
    upper, lower, digit = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
    value = lambda letters, n=size: "".join(rng.choice(list(letters), n - 1)) + "7"
    return [
        ("passphrase = {}", value(upper + lower + digit)), ("Bearer {}", "eyJ" + value(upper + lower + digit + "-_")),
        ("private_key: {}", "MII" + value(upper + lower + digit + "+/")), ("DB_PASS={}", value(lower + digit)),
        ('token -> "{}"', value(upper + digit)), ("client credentials are {}", value("0123456789ABCDEF")), ("{}", value(upper + lower + digit)),
    ]


def test_chain_finds_what_the_patterns_miss(spark, field):
    rng, rows, secrets = np.random.default_rng(11), [], {}
    for k in range(60):
        for form, value in planted(rng, int(rng.integers(18, 50))):
            text = f"{prose(rng)} {form.format(value)} {prose(rng)}"
            # Only what no pattern finds is counted.
            if not S.base_spans(text):
                secrets[len(rows)] = (text.index(value), text.index(value) + len(value), form)
                rows.append((len(rows), text))
    clean = [(10_000 + k, f"{prose(rng, 30)}") for k in range(300)]
    clean += [(20_000 + k, f"{prose(rng)} {x} {prose(rng)}") for k, x in enumerate(
        ("the token of the house", "password: the", "see http://a.example.com/b/c.html", "v1.2.3", "2021-03-04", "RIVERSIDE", "key = Paris", "+49 170 1234567"))]
    found = {r.doc_id: r for r in S.scan(spark.createDataFrame(rows + clean, "doc_id long, text string"), field).collect()}
    caught = {}
    for k, (a, b, form) in secrets.items():
        spans = [tuple(map(int, s.split(":")[1:])) for s in found[k].spans.split(",") if s.startswith("crf")]
        caught.setdefault(form, []).append(any(x <= a and y >= b for x, y in spans))
    assert len(caught) >= 7 and sum(len(v) for v in caught.values()) > 300
    # A bare token, without a name or sign, is found less often.
    bare = caught.pop("{}")
    assert {f: sum(v) / len(v) for f, v in caught.items() if sum(v) < 0.9 * len(v)} == {}
    assert sum(bare) >= 0.3 * len(bare)
    assert sum(found[k].n_crf > 0 for k, _ in clean) <= 0.01 * len(clean)


def test_cut_chains_decode_like_whole_ones(field):
    rng = np.random.default_rng(3)
    for _ in range(20):
        codes = rng.integers(1, S.SHAPES * S.WORDS, 300).astype(np.int32)
        files = np.full(300, 3, np.int8)
        score = field.files[files].astype(np.float64)
        pad = max(map(abs, S.OFFSETS))
        padded = np.concatenate([np.zeros(pad, np.int32), codes, np.zeros(pad, np.int32)])
        for o, offset in enumerate(S.OFFSETS):
            score += field.emission[o][padded[pad + offset:pad + offset + 300]]
        whole = S.viterbi(score[None], field.transition)[0]
        assert (S.tag(codes, files, field) == whole).all()


def test_viterbi_beats_every_path():
    from itertools import product

    rng = np.random.default_rng(5)
    score, transition = rng.normal(size=(4, 5, 3)), rng.normal(size=(3, 3))

    def worth(k, path):
        steps = zip([0, *path], [*path, 0], strict=True)
        return sum(score[k, t, s] for t, s in enumerate(path)) + sum(transition[a, b] for a, b in steps)

    found = S.viterbi(score, transition)
    for k in range(4):
        best = max(product(range(3), repeat=5), key=lambda p: worth(k, p))
        assert tuple(found[k]) == best


def test_one_window_is_learnt():
    """One window, two tags: the fitted field must prefer the tagged path to all others."""
    class Row:
        codes, tags, file = [0, 0, 0, 1025, 2050, 1025, 0, 0, 0], [0, 1, 0], 0

    field = S.fit([Row()] * 4, rounds=150)
    assert S.tag(np.array([1025, 2050, 1025], np.int32), np.zeros(3, np.int8), field).tolist() == [0, 1, 0]


def test_base_spans_win_over_the_chain(field):
    """The field's spans touch none of the patterns', however many there are."""
    text = " ".join(f'token = "{HEX}" passphrase {HEX.upper()}{k}' for k in range(400))
    spans = next(S.find_all([text], field, S.Codes()))
    base, extra = [s for s in spans if s[1] < 3], [s for s in spans if s[1] == 3]
    assert len(base) >= 400 and extra
    assert all(b <= c or a >= d for a, _, b in extra for c, _, d in base)


def test_redaction(documents, field):
    df = documents((1, f"a token={HEX} b"), (2, None), (3, "clean"), (4, f"{HEX}"))
    rows = {r.doc_id: r for r in S.redact(df, field).collect()}
    assert rows[1].text == "a [SECRET] b" and rows[1].n_chars == len("a [SECRET] b")
    assert rows[2].text is None and rows[3].text == "clean" and rows[4].text == "[SECRET]"
    assert S.redact(df, field).columns == df.columns
    text_counts = df.withColumn("n_chars", df["n_chars"].cast("string"))
    assert {r.doc_id: r.n_chars for r in S.redact(text_counts, field).collect()}[4] == str(len(HEX))


def test_tasks_get_the_weights_of_shapes_and_words_only(spark, documents, field, monkeypatch):
    """Each of an executor's workers holds a copy of what is broadcast: weights per code would be some 40 MB."""
    sizes, broadcast = [], type(spark.sparkContext).broadcast
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, value: sizes.append(len(pickle.dumps(value))) or broadcast(self, value))
    df = documents((1, f"token={HEX}"))
    assert S.scan(df, field).first().n_assign == 1 and S.redact(df, field).first().text == "[SECRET]"
    assert len(sizes) == 2 and max(sizes) < 1_000_000


def test_codes_of_many_tokens_stay_few():
    codes, tokens = S.Codes(), [f"t{k}" for k in range(150_000)]
    found = [codes[t] for t in tokens]
    assert len(codes) <= 100_000
    assert found[::5_000] == [S.Codes()[t] for t in tokens[::5_000]]
