from __future__ import annotations

import hashlib
import random
import re

import numpy as np

from reviewmill.llm import secrets

DRAW = random.Random(4)
HEX32 = "".join(DRAW.choices("0123456789abcdef", k=32))
KEY = "".join(DRAW.choices(secrets.ENCODINGS["base62"], k=40))


def _brute(text):
    """The three patterns as stated, by themselves."""
    text, spans = text or "", []
    assign = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    rules = [("assign", assign, lambda m: len(m[2]) >= 8), ("access", "AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 16)]
    rules.append(("hex", "[0-9a-f]+", lambda m: len(m[0]) >= 32))
    for order, (kind, pattern, keep) in enumerate(rules):
        spans += [(m.start(), order, kind, m.end()) for m in re.finditer(pattern, text, re.ASCII) if keep(m)]
    return [f"{kind}:{start}:{end}" for start, _, kind, end in sorted(spans)]


def _texts():
    words = "the of and ontion erth ingwhat über den la niño tion".split()
    plain = [" ".join(DRAW.choices(words, k=DRAW.randint(20, 200))) for _ in range(150)]
    odd = [
        f'é PassWord = "{KEY[:9]}" and token:short secret: {HEX32}',
        f"api_key='{KEY}' AKIA{'Z9' * 8} AKIA12 {HEX32}{HEX32} x{HEX32}",
        "toKen=abcdefgh passwd:::: ſecret=abcdefghij toKen=abcdefghij",
        f"😀 see {KEY} here",
        "incomprehensibilitiesincomprehensibilities of the ontionontionontionontionontionontion",
        None,
        "",
    ]
    return plain + odd


def test_scan_against_plain_patterns(spark):
    rows = list(enumerate(_texts()))
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, spans string")
    got = {r.doc_id: r for r in secrets.span_digests(secrets.secrets(docs)).collect()}
    assert len(got) == len(rows)
    for i, text in rows:
        want = _brute(text)
        row = got[i]
        assert row.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), text
        assert [row.n_assign, row.n_access, row.n_hex] == [
            sum(w.startswith(k) for w in want) for k in ("assign", "access", "hex")
        ]
        assert [s for s in row.spans.split(",") if s and not s.startswith("random")] == want
    start = rows[153][1].index(KEY)
    assert got[153].spans == f"random:{start}:{start + 40}"
    assert got[154].spans == ""


def test_battery_is_fair_on_random_tokens():
    for letters in ("decimal", "hex", "base32", "base64"):
        tokens = ["".join(DRAW.choices(secrets.ENCODINGS[letters], k=DRAW.choice([20, 32, 64]))) for _ in range(800)]
        low = np.mean([secrets.randomness(t) < 0.05 for t in tokens])
        assert low < 0.1, letters
    assert secrets.randomness("ab" * 20) < 1e-6
    assert secrets.randomness("0123456789" * 4) < 1e-4
    assert secrets.randomness("a" * 40) < 1e-6


def test_false_discoveries_are_controlled_per_length():
    draw = np.random.default_rng(1)
    counts = np.zeros((2, secrets.BINS), np.int64)
    null = np.minimum(secrets.BINS - 1, (-np.log10(draw.uniform(size=100_000)) * secrets.BINS_PER_DECADE).astype(int))
    np.add.at(counts[0], null, 1)
    np.add.at(counts[1], np.full(50, 400), 1)
    cuts = secrets.cut_bins(counts, 0.001)
    assert (null >= cuts[0]).sum() <= 2
    assert cuts[1] <= 400


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert secrets.span_digests(secrets.secrets(docs)).count() == 0


def test_very_long_text():
    model = secrets.TextModel(secrets.pair_counts(_texts()), secrets.text_randomness(_texts()))
    text = "word " * 100_000 + HEX32 + " word" * 100_000
    assert secrets.scan(text, model)[0] == [("hex", 500_000, 500_032, None, None)]


def test_rest_of_a_token_beside_a_pattern():
    model = secrets.TextModel(secrets.pair_counts(_texts()), secrets.text_randomness(_texts()))
    for text in (f"{HEX32}/{KEY}", f"a AKIA{'Z9' * 8}_{KEY} b", f"{KEY}-{HEX32}-{KEY}"):
        base, candidates = secrets.scan(text, model)
        covered = {i for _, start, end, *_ in base for i in range(start, end)}
        assert len(base) == 1 and len(candidates) == text.count(KEY)
        for _, start, end, p_text, p_random in candidates:
            assert KEY in text[start:end] and not covered & set(range(start, end))
            assert end - start <= len(KEY) + 1 and p_text < 0.005 and p_random > 0.001
    assert secrets.uncovered(0, 9, [(0, 2, 9), (3, 0, 5)]) == []
    assert secrets.uncovered(2, 20, [(0, 0, 4), (3, 2, 6), (8, 1, 9), (20, 2, 30)]) == [(6, 8), (9, 20)]


def test_many_tokens_as_one_by_one():
    letters = [*secrets.ENCODINGS.values(), "aab", "a", "Zz9", "abcdefgh", "XYZ"]
    for n in (20, 28, 41):
        tokens = ["".join(DRAW.choices(one, k=n)) for one in letters for _ in range(30)]
        codes = np.array([[secrets.SYMBOLS.index(c) for c in t] for t in tokens], np.int8)
        want = [secrets.randomness(t) for t in tokens]
        np.testing.assert_allclose(secrets.randomness_of(codes), want, rtol=1e-9, atol=1e-300)


def _plain_null(texts):
    """Per class the battery's p-values of all stretches, by loops."""
    found = [[] for _ in secrets.LENGTHS]
    for text in texts:
        words = [w for w in re.findall("[A-Za-z0-9+/_-]+", text or "") if len(w) < 20]
        whole = "".join(words)
        for i, n in enumerate(secrets.LENGTHS):
            found[i] += [secrets.randomness(whole[a : a + n]) for a in range(0, len(whole) - n + 1, n)]
    return found


def test_added_spans_against_plain_loops(spark):
    keys = ["".join(DRAW.choices(secrets.ENCODINGS[e], k=k)) for e in ("hex_upper", "base32", "base62", "base64") for k in (22, 30, 45, 70, 140)]
    texts = _texts() + [f"see {k} in {DRAW.choice(_texts())}" for k in keys] + [f"a {'ontion' * DRAW.randint(4, 30)} b" for _ in range(12)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: [tuple(s)[:3] for s in r.spans if s.kind == "random"] for r in secrets.secrets(docs).collect()}
    null = _plain_null(texts)
    table = secrets.text_randomness(texts)
    assert [len(p) for p in null] == table.sum(axis=1).tolist()
    pairs = secrets.TextModel(secrets.pair_counts(texts), table)
    candidates = []
    for i, text in enumerate(texts):
        text = text or ""
        base = [(int(a), int(b)) for _, a, b in (s.split(":") for s in _brute(text))]
        covered = {x for a, b in base for x in range(a, b)}
        rest = "".join(" " if x in covered else c for x, c in enumerate(text))
        tokens = [m.span() for m in re.finditer("[A-Za-z0-9+/_-]{20,}", rest)]
        for a, b in tokens:
            if any(m.start() <= a and b <= m.end() for m in re.finditer("[A-Za-z0-9+/_-]{20,}", text)):
                own = int(secrets.randomness(text[a:b]) * 1000)
                kind = max(k for k, n in enumerate(secrets.LENGTHS) if b - a >= n)
                as_random = sum(int(p * 1000) >= own or p >= 1 for p in null[kind])
                p_text = (1 + as_random) / (1 + len(null[kind]))
                if pairs.p_value(text[a:b]) > 0.001:
                    p_text = 1.0
                candidates.append((kind, p_text, i, a, b))
    want = {i: [] for i in range(len(texts))}
    for kind in range(len(secrets.LENGTHS)):
        own = [c for c in candidates if c[0] == kind]
        binned = {c: int(-np.log10(c[1]) * 20) for c in own}
        passing = [v for v in set(binned.values()) if 10 ** (-v / 20) * len(own) <= 0.01 * sum(x >= v for x in binned.values())]
        for c, v in binned.items():
            if passing and v >= min(passing):
                want[c[2]].append(("random", c[3], c[4]))
    assert got == {i: sorted(s, key=lambda x: x[1]) for i, s in want.items()}
    assert sum(map(len, got.values())) >= 10
    assert not any(got[i] for i in range(len(texts) - 12, len(texts)))
