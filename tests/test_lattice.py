from __future__ import annotations

from reviewmill.operators import lattice

SURFACES = ["맛있", "맛있는", "커피", "커", "피자", "가", "는", "ab", "abc", "c", "bc", "a", "bcd"]


def _brute(word, known):
    """All paths: fewest unknown characters, fewest pieces, longest first."""
    best = {len(word): (0, 0, [])}
    for at in range(len(word) - 1, -1, -1):
        ways = [(best[at + 1][0] + 1, best[at + 1][1] + 1, [0, *best[at + 1][2]])]
        for size in range(1, len(word) - at + 1):
            if word[at : at + size] in known:
                rest = best[at + size]
                ways.append((rest[0], rest[1] + 1, [-size, *rest[2]]))
        best[at] = min(ways)
    pieces, at, unknown = [], 0, ""
    for step in best[0][2]:
        size = max(1, -step)
        if step:
            pieces += [unknown] * bool(unknown) + [word[at : at + size]]
            unknown = ""
        else:
            unknown += word[at]
        at += size
    return pieces + [unknown] * bool(unknown)


def _cut(spark, words, surfaces):
    dictionary = spark.createDataFrame([(s, s, "Noun") for s in surfaces], "surface string, lemma string, pos string")
    frame = spark.createDataFrame([(w,) for w in words], "word string")
    return {r.word: r.pieces for r in lattice.cut_words(frame, dictionary).collect()}


def test_equals_brute_force(spark):
    words = ["맛있는커피", "커피자가", "커피는맛있는", "xyz", "abcbcd", "xabcx", "aabbcc", "c", "피", "abcd" * 9, "z" * 30]
    got = _cut(spark, [*words, words[0], None, ""], SURFACES)
    assert got == {w: _brute(w, set(SURFACES)) for w in words}
    assert got["맛있는커피"] == ["맛있는", "커피"] and got["xyz"] == ["xyz"]


def test_long_words_and_empty_dictionary(spark):
    long = "abx" * 200
    got = _cut(spark, [long], SURFACES)[long]
    assert "".join(got) == long and "ab" in got
    assert _cut(spark, ["abc", "가는"], []) == {"abc": ["abc"], "가는": ["가는"]}


def test_tagged_pieces(spark):
    dictionary = spark.createDataFrame([("ab", "AB", "Verb"), ("c", "c", "Josa")], "surface string, lemma string, pos string")
    tokens = spark.createDataFrame([("u", "abcx", 3), ("u", "12", 1), ("v", "!?", 2), ("v", "x\x01y", 1)], "g string, word string, n long")
    rows = lattice.tagged_pieces(tokens, dictionary).orderBy("word", "piece_no").collect()
    assert [(r.word, r.piece, r.lemma, r.pos, r.n) for r in rows] == [
        ("!?", "!?", "!?", "Punctuation", 2),
        ("12", "12", "12", "Number", 1),
        ("abcx", "ab", "AB", "Verb", 3),
        ("abcx", "c", "c", "Josa", 3),
        ("abcx", "x", "x", "Unknown", 3),
        ("x\x01y", "x\x01y", "x\x01y", "Unknown", 1),
    ]
