from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from reviewmill.llm import divergence as dv

SCHEMA = "lang string, source string, text string, s string, term string, count int"


def _brute(rows):
    docs = defaultdict(list)
    for lang, source, text in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        docs[lang or ""].append((source or "", re.findall(dv.TERM, low)))
    found = []
    for lang, own in docs.items():
        seen = Counter(t for _, terms in own for t in set(terms))
        kept = sorted(t for t, n in seen.items() if n >= 3)
        counts = defaultdict(Counter)
        for source, terms in own:
            counts[source].update(t for t in terms if seen[t] >= 3)
        whole = sum(counts.values(), Counter())

        def shares(count):
            total = sum(count.values())
            return {t: 1 + 10**9 * (count[t] + 1) // (total + len(kept)) for t in kept}

        of_lang = shares(whole)
        p = {s: shares(c) for s, c in counts.items()}
        for s in p:
            pairs = [(sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in p if o != s]
            above = [t for t in kept if counts[s][t] > 0 and p[s][t] > of_lang[t]]
            terms = [((p[s][t] - of_lang[t]) ** 2 // of_lang[t], t) for t in above]
            for part, items, most in (("pair", pairs, None), ("term", terms, 200)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                found += [(lang, s, part, i, v, r) for r, (v, i) in enumerate(items[:most], 1)]
    return sorted(found)


def _got(spark, rows, **options):
    frame = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], SCHEMA)
    columns = ("lang", "source", "part", "item", "value", "rank")
    return sorted(tuple(r[c] for c in columns) for r in dv.divergence(frame, **options).collect())


def _rows(count, seed):
    draw = np.random.default_rng(seed)
    words = ["Ab", "aB", "é", "É", "日本", "x1y", "cde", "f-g", *[f"w{chr(97 + i)}" for i in range(20)]]
    rows = []
    for _ in range(count):
        text = " ".join(draw.choice(words, draw.integers(0, 30)))
        rows.append((str(draw.choice(["en", "de"])), str(draw.choice(["a", "b", "c", "d", "e"])), text))
    return rows


def test_equals_plain_loops(spark):
    rows = _rows(60, 1)
    assert _got(spark, rows) == _brute(rows)


def test_odd_rows(spark):
    rows = _rows(25, 2) + [
        (None, None, "one two one"),
        ("", None, "one two"),
        (None, "", "one three"),
        ("xx", "alone", "seldom"),
        ("xx", "none", None),
        ("xx", "other", ""),
        ("yy", "only", "a a a"),
        ("de", "a", "long " * 50_000),
        ("de", "b", "long"),
        ("de", "b", "long"),
        ("en", "empty", "12 34 ..."),
    ]
    assert _got(spark, rows) == _brute(rows)


def test_empty_table(spark):
    assert _got(spark, []) == []


@pytest.mark.parametrize("slice_terms", [3, 11])
def test_slices(spark, slice_terms):
    rows = _rows(40, 5)
    assert _got(spark, rows, slice_terms=slice_terms) == _brute(rows)


def test_blocks_and_tiles(spark, monkeypatch):
    monkeypatch.setattr(dv, "BLOCK_ENTRIES", 30)
    monkeypatch.setattr(dv, "TILE_PAIRS", 10)
    rows = _rows(60, 6)
    assert _got(spark, rows) == _brute(rows)


@pytest.mark.parametrize("step", [1, 7, 1 << 20])
def test_pair_matrix(monkeypatch, step):
    monkeypatch.setattr(dv, "STEP", step)
    draw = np.random.default_rng(step)
    sources, terms = 9, 40
    counts = draw.integers(0, 5, (sources, terms)) * (draw.random((sources, terms)) < 0.4)
    totals = counts.sum(1)
    shares = 1 + 10**9 * (counts + 1) // (totals + terms)[:, None]
    absent = 1 + 10**9 // (totals + terms)
    s, t = np.nonzero(counts)
    mix = draw.permutation(len(s))
    s, t = s[mix], t[mix]
    want = np.array([[sum((a - b) ** 2 // b) for b in shares] for a in shares])
    neither = terms * dv._gap(absent[:, None], absent)
    got = [dv.pair_matrix(s, t, shares[s, t], absent, a, min(a + 4, sources)) for a in range(0, sources, 4)]
    got = neither + np.concatenate(got)
    off = ~np.eye(sources, dtype=bool)
    assert (got[off] == want[off]).all()


@pytest.mark.parametrize("most", [1, 3, 7])
def test_a_fit_sees_a_term_in_so_many_rows(most):
    rows = _rows(50, 9) + [("en", "a", ""), ("xx", "a", "ab ab")]
    columns = {"gid": [0] * len(rows), "lang": [r[0] for r in rows], "text": [r[2] for r in rows]}
    batch = pa.RecordBatch.from_pydict(columns)
    terms, begins = dv.terms_of(batch, most)
    seen, want = Counter(), []
    for lang, _, text in rows:
        found = dict.fromkeys(re.findall(dv.TERM, re.sub("[A-Z]", lambda m: m[0].lower(), text)))
        found = {f"{lang}\0{t}" for t in found}
        want.append({t for t in found if seen[t] < most})
        seen.update(found)
    got = [terms.slice(a, b - a).to_pylist() for a, b in zip(begins[:-1], begins[1:], strict=True)]
    assert [set(g) for g in got] == want and sum(map(len, got)) == sum(map(len, want))
    assert dv.terms_of(batch.slice(0, 0), most)[0].to_pylist() == []


def test_vectors_see_a_term_of_a_group_once():
    """A group's distinct terms, dealt by how often they occur; before, each occurrence was sent."""
    rows = _rows(80, 12) + [("en", "a", ""), ("xx", "a", "ab ab"), ("xx", "b", None)]
    names = sorted({r[:2] for r in rows})
    gids = [7 * names.index(r[:2]) for r in rows]
    columns = {"gid": gids, "lang": [r[0] for r in rows], "text": [r[2] for r in rows]}
    batch = pa.RecordBatch.from_pydict(columns)
    want = defaultdict(Counter)
    for gid, (lang, _, text) in zip(gids, rows, strict=True):
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        want[gid].update(f"{lang}\0{t}" for t in re.findall(dv.TERM, low))
    got, lists = defaultdict(Counter), dv.repeats_of(batch).to_pylist()
    for row in lists:
        assert row["terms"] and not got[row["gid"]].keys() & set(row["terms"])
        got[row["gid"]] |= dict.fromkeys(row["terms"], row["times"])
    assert got == {gid: c for gid, c in want.items() if c}
    assert len({(r["gid"], r["times"]) for r in lists}) == len(lists)
    assert dv.repeats_of(batch.slice(0, 0)).num_rows == 0


def test_hashes_tell_terms_and_languages_apart():
    """The estimate of distinct terms sends one number for each; before, the strings themselves."""
    rows = _rows(80, 13) + [("", "a", "ab ba abc b" + "a" * 5000), (None, "a", ""), ("xx", "a", "ab Ab  aB")]
    batch = pa.RecordBatch.from_pydict({"lang": [r[0] or "" for r in rows], "text": [r[2] for r in rows]})
    terms = {(lang or "", t.lower() if t.isascii() else t) for lang, _, text in rows for t in re.findall(dv.TERM, text)}
    found = [dv.term_hashes(batch.slice(a, 9)).tolist() for a in range(0, len(rows), 9)]
    assert {h for hashes in found for h in hashes} == set(dv.term_hashes(batch).tolist())
    assert len(dv.term_hashes(batch)) == len(terms)
    assert dv.term_hashes(batch.slice(0, 0)).tolist() == dv.term_hashes(batch.slice(len(rows) - 2, 1)).tolist() == []


@pytest.mark.parametrize("buckets", [1, 7, 1 << 12])
def test_sums_leave_a_task_as_a_row_per_bucket(spark, monkeypatch, buckets):
    """Before, each number of a sum was a row of the shuffle."""
    monkeypatch.setattr(dv, "BUCKETS", buckets)
    monkeypatch.setattr(dv, "VECTOR_ENTRIES", 50)
    draw = np.random.default_rng(buckets)
    key = np.unique(draw.integers(0, 300, 200)) << 32 | 5
    rows = dv.bucket_rows(key, key * 2)
    assert rows.num_rows == len(set((key >> 32) % buckets))
    assert sorted(dv.numbers_in(rows.column("keys"))) == key.tolist()
    assert (dv.numbers_in(rows.column("keys").slice(1)) * 2 == dv.numbers_in(rows.column("counts").slice(1))).all()
    want, vectors = defaultdict(Counter), []
    for _ in range(120):
        gid, times = int(draw.integers(0, 6)), int(draw.integers(1, 4))
        at = np.flatnonzero(draw.random(40) < 0.3)
        n = draw.integers(1, 5, len(at))
        vectors.append((gid, times, (at.tolist(), n.astype(float).tolist())))
        want[gid].update({int(a): int(c) * times for a, c in zip(at, n, strict=True)})
    whole = sum(want.values(), Counter())
    frame = spark.createDataFrame(vectors, "gid long, times long, v struct<indices:array<int>,values:array<double>>")
    got = [tuple(r) for r in dv.add_vectors(frame.repartition(5)).collect()]
    assert sorted(got) == sorted((g, a, n, whole[a]) for g, c in want.items() for a, n in c.items())
