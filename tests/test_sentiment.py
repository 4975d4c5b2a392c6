"""Scoring definitions against plain Python on small frames."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest

from reviewmill.operators import sentiment as st
from reviewmill.operators import tokens as tk
from reviewmill.plans import jobs

LEXICON = {"좋다": 2, "맛있다": 1, "나쁘다": -1, "비싸다": -2, "보통": 0}
WORDS = [*LEXICON, "커피", "빵"]


@pytest.fixture(scope="module")
def lexicon(spark):
    return spark.createDataFrame(list(LEXICON.items()), "word string, polarity int")


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    made = []
    for i in range(400):
        # one shop holds most of the reviews
        shop = "hot" if rng.random() < 0.6 else f"s{rng.randrange(6)}"
        made.append((i, "u", shop, " ".join(rng.choices(WORDS, k=rng.randrange(0, 6)))))
    made += [(1000, "u", "pure", "좋다 나쁘다 좋다"), (1001, "u", "pure", "커피")]
    made += [(1002, "u", "bad", "나쁘다 비싸다 좋다"), (1003, "u", "none", "커피 빵"), (1004, "u", "void", None)]
    return made


@pytest.fixture(scope="module")
def reviews(spark, rows):
    return spark.createDataFrame(
        rows, "review_id long, university_name string, shop_name string, review_text string"
    )


def sign(n):
    return "Positive" if n > 0 else "Negative" if n < 0 else "Neutral"


def top(counter, k):
    return ", ".join(w for w, _ in sorted(counter.items(), key=lambda x: (-x[1], x[0]))[:k])


def result(frame):
    return {
        r.shop_name: (
            r.positive_pct, r.neutral_pct, r.negative_pct,
            r.top_positive, r.top_neutral, r.top_negative,
        )
        for r in frame.collect()
    }


ORDER = ("Positive", "Neutral", "Negative")


@pytest.mark.parametrize("suppress", [False, True])
def test_by_review(reviews, rows, lexicon, suppress):
    classes, words = defaultdict(Counter), defaultdict(lambda: defaultdict(Counter))
    for _, _, shop, text in rows:
        seen = Counter()
        for w in (text or "").split():
            if w in LEXICON:
                seen[sign(LEXICON[w])] += 1
                words[shop][sign(LEXICON[w])][w] += 1
        best = max(("Positive", "Negative", "Neutral"), key=lambda c: seen[c])
        classes[shop][best] += 1
    want = {}
    for shop, counts in classes.items():
        total = sum(counts.values())
        shares = {c: round(counts[c] / total * 100, 2) for c in ORDER}
        lists = {c: top(words[shop][c], 3) for c in ORDER}
        if suppress:
            for pure in ("Positive", "Negative"):
                if shares[pure] == 100:
                    lists = {c: lists[c] if c == pure else "" for c in ORDER}
        want[shop] = (*[shares[c] for c in ORDER], *[lists[c] for c in ORDER])
    got = st.sentiment_by_review(
        reviews, "review_text", "review_id", lexicon, ["shop_name"], suppress_pure=suppress
    )
    assert result(got) == want


@pytest.mark.parametrize("unmatched", ["drop", "neutral", "keep"])
def test_by_token(reviews, rows, lexicon, unmatched):
    words = defaultdict(lambda: defaultdict(Counter))
    for _, _, shop, text in rows:
        if text is None:
            continue
        for w in text.split(" "):
            if w in LEXICON or unmatched == "neutral":
                words[shop][sign(LEXICON.get(w, 0))][w] += 1
            elif unmatched == "keep":
                words[shop]
    want = {}
    for shop, classes in words.items():
        total = sum(sum(c.values()) for c in classes.values())
        shares = [sum(classes[c].values()) / total * 100 if total else None for c in ORDER]
        want[shop] = (*shares, *[top(classes[c], 5) for c in ORDER])
    tokens = tk.explode_tokens(reviews, "review_text", ["shop_name"])
    got = result(st.sentiment_by_token(tokens, lexicon, ["shop_name"], unmatched))
    assert got == want
    assert ("none" in got) == (unmatched != "drop")


def test_merged_text_keeps_groups_without_match(reviews, lexicon):
    got = result(st.sentiment_by_merged_text(reviews, "review_text", lexicon, ["shop_name"]))
    assert got["none"][:3] == (None, None, None)
    assert got["void"][:3] == (None, None, None)
    assert got["bad"] == (33.33, 0.0, 66.67, "좋다", "", "나쁘다, 비싸다")


def test_report_order(reviews, lexicon):
    base = jobs.sentiment_report(reviews, "review_text", lexicon)
    for ascending in (False, True):
        shares = [float(r.positive_pct) for r in st.report_table(base, "shop_name", ascending).collect()]
        assert shares == sorted(shares, reverse=not ascending)


def test_hot_word_is_counted_before_the_join(spark, monkeypatch):
    """One (shop, word) pair in nine rows of ten reaches a shuffled lookup as a single row."""
    from reviewmill.operators import skew

    monkeypatch.setattr(skew, "fits_broadcast", lambda small: False)
    tokens = spark.range(20_000).selectExpr(
        "IF(id % 10 > 0, 'hot', concat('s', id % 7)) AS shop_name",
        "IF(id % 10 > 0, 'the', concat('w', id % 50)) AS word",
    )
    words = spark.createDataFrame([("the", 1), ("w0", -1)], "word string, polarity int")
    seen = []
    join = skew.lookup_join
    monkeypatch.setattr(st, "lookup_join", lambda left, *rest: seen.append(left.count()) or join(left, *rest))
    for unmatched in ("drop", "keep", "neutral"):
        counts = st.count_class_words(tokens, words, ["shop_name"], unmatched)
        hot = counts.filter("shop_name = 'hot' AND word = 'the'").first()
        assert hot.n == 18_000
    assert st.polarity_counts(tokens, words, ["shop_name"]).filter("shop_name = 'hot'").first()[1] == 18_000
    assert max(seen) <= 1 + 7 * 50


def test_reports_are_built_without_a_job(spark, reviews):
    from reviewmill.session import local_table

    words = local_table(spark, [("좋다", 1), ("나쁘다", -1)], "word string, polarity int")
    context = spark.sparkContext
    context.setJobGroup("plan-only", "no job may run")
    for mode in ("token", "review", "merged"):
        jobs.sentiment_report(reviews, "review_text", words, mode)
    assert not context.statusTracker().getJobIdsForGroup("plan-only")
    context.setLocalProperty("spark.jobGroup.id", None)


def test_large_lexicon_is_joined_by_shuffle(spark, reviews, lexicon, monkeypatch):
    from reviewmill.operators import skew

    tokens = tk.explode_tokens(reviews, "review_text", ["shop_name"])
    plain = result(st.sentiment_by_token(tokens, lexicon, ["shop_name"], "neutral"))
    monkeypatch.setattr(skew, "fits_broadcast", lambda small: False)
    assert result(st.sentiment_by_token(tokens, lexicon, ["shop_name"], "neutral")) == plain
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")  # salted then
    try:
        assert result(st.sentiment_by_token(tokens, lexicon, ["shop_name"], "neutral")) == plain
    finally:
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")


def test_review_scores(spark, lexicon):
    frame = spark.createDataFrame(
        [(1, "좋다 나쁘다 커피"), (2, "커피"), (3, ""), (4, None)], "review_id long, words string"
    )
    got = {r.review_id: r.sent_score for r in st.review_scores(frame, "words", "review_id", lexicon).collect()}
    assert got == {1: 0.5, 2: 0.0, 3: 0.0, 4: 0.0}
